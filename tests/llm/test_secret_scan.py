from __future__ import annotations

import random
import re

from granary.llm import secret_scan

PATTERNS = {
    "assign": (r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A),
    "access": (r"AKIA[A-Z0-9]+", 0),
    "hex": (r"[0-9a-f]+", 0),
}


def brute(text: str) -> list[tuple]:
    spans = []
    for order, (kind, (pattern, flags)) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text, flags):
            long_enough = {"assign": lambda: len(m[2]) >= 6, "access": lambda: len(m[0]) >= 20, "hex": lambda: len(m[0]) >= 24}
            if long_enough[kind]():
                spans.append((m.start(), order, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(spans)]


def base(text: str) -> list[tuple]:
    return [(s["kind"], s["start"], s["end"]) for s in secret_scan.scan(text) if not s["linked"]]


def test_base_spans_against_brute_force():
    draw = random.Random(5)
    parts = ["password", "Token", "secret", "api_key", "APIKEY", "=", ": ", '"', "'", " ", "abc", "abcdef12", "AKIA", "Z9" * 8,
             "0123456789abcdef" * 2, "é", "\n", "ſecret", "a" * 23, "F"]
    for _ in range(20_000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 9)))
        assert base(text) == brute(text), repr(text)


def test_a_dropped_match_still_takes_its_text():
    assert base("secret=token: abcdefgh") == []
    assert base("x secret=token abcdefgh token: abcdefgh") == [("assign", 24, 39)]


MATERIAL = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY9"


def kinds(text: str) -> list[str]:
    return [s["kind"] for s in secret_scan.scan(text) if s["linked"]]


def test_weak_candidates_need_their_complement():
    assert kinds(MATERIAL) == [] and kinds("user: admin_1") == [] and kinds("https://a.example/x") == []
    assert kinds(f"user: admin_1 {MATERIAL}") == ["identity", "material"]
    assert kinds(f"{MATERIAL} at https://a.example/x") == ["material", "endpoint"]
    assert kinds("https://a.example/x password=abcdef1") == ["endpoint"]


def test_scope_ends_with_distance_and_paragraph():
    near, far = " " * 20, " x" * secret_scan.REACH
    assert kinds("user: admin_1" + near + MATERIAL) == ["identity", "material"]
    assert kinds("user: admin_1" + far + MATERIAL) == []
    assert kinds("user: admin_1\n\n" + MATERIAL) == []


def brute_linked(text: str) -> list[tuple]:
    """Every pattern over every text, and every candidate against every part."""
    strong = brute(text)
    weak = [(kind, *m.span()) for kind, pattern in (("identity", secret_scan.IDENTITY), ("endpoint", secret_scan.ENDPOINT))
            for m in pattern.finditer(text)]
    ends = [w for w in weak if w[0] == "endpoint"]
    weak += [
        ("material", *m.span())
        for m in secret_scan.MATERIAL.finditer(text)
        if secret_scan._random_looking(m[0])
        and not re.fullmatch("[0-9A-Fa-f-]+", m[0])
        and not any(m.start() < e and s < m.end() for _, s, e in ends)
    ]
    weak = [w for w in weak if not any(w[1] < s[2] and s[1] < w[2] for s in strong)]
    breaks = [m.start() for m in secret_scan.PARAGRAPH.finditer(text)]
    linked = []
    for kind, start, end in weak:
        low = max([start - secret_scan.REACH, *(b for b in breaks if b < start)])
        high = min([end + secret_scan.REACH, len(text), *(b for b in breaks if b >= start)])
        roles = secret_scan.NEEDS[kind]
        if any(secret_scan.ROLE[k] in roles and s < high and low < e for k, s, e in strong + weak):
            linked.append((start, secret_scan.KINDS.index(kind), kind, end))
    return [(kind, start, end) for start, _, kind, end in sorted(linked)]


def test_linked_spans_against_brute_force():
    draw = random.Random(11)
    parts = ["user: admin_1", "username: svc_app", "host 10.0.0.5:5432", "192.168.1.20:80", "10.0.0.5", ":6379", "12:30", "v1.2:3",
             MATERIAL, "https://a.example/x", "redis://10.0.0.5:6379", "password=abcdef1", "AKIA" + "Z9" * 8, "0123456789abcdef" * 2,
             "\n", "\n\n", " x" * 130, "é", "٣.٣.٣.٣:٣٣"]
    alone = 0
    for _ in range(20_000):
        text = draw.choice([" ", "\n", ""]).join(draw.choice(parts) for _ in range(draw.randint(0, 6)))
        expected = brute_linked(text)
        assert [(s["kind"], s["start"], s["end"]) for s in secret_scan.scan(text) if s["linked"]] == expected, repr(text)
        alone += "://" not in text and not brute(text) and any(kind == "endpoint" for kind, _, _ in expected)
    assert alone > 100


def test_an_address_with_a_port_needs_no_scheme():
    assert kinds("username: svc_app\nhost 10.0.0.5:5432") == ["endpoint"]
    assert kinds(f"{MATERIAL} 10.0.0.5:6379") == ["material", "endpoint"]
    assert kinds("host 10.0.0.5:5432 at 12:30") == []


def test_odd_rows_and_columns(odd_documents, no_documents):
    rows = secret_scan.find_secrets(odd_documents).collect()
    assert len(rows) == odd_documents.count() and all(r.spans == [] for r in rows)
    assert secret_scan.find_secrets(no_documents).count() == 0


def test_checksums_and_links_are_no_credentials():
    digest = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b2b0b822cd15d6c15b0f00a08"
    for text in (f"sha256 checksum {digest} Download https://mirror.example/file.iso", f"SHA256 {digest.upper()} https://mirror.example/x",
                 f"commit {digest[:40]} see https://git.example/r/c/{digest[:40]}", f"https://cdn.example/{MATERIAL}/app.js",
                 "Licensed under https://licenses.example/by/4.0/", "id 123e4567-e89b-12d3-a456-426614174000 at https://a.example/x"):
        assert kinds(text) == [], text


def test_precision_and_recall_on_made_credentials():
    """Whole credentials in prose, parts alone, and decoys, told apart by their planted spans."""
    draw = random.Random(21)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    word = lambda n: "".join(draw.choice(letters) for _ in range(n))
    hexes = lambda n: "".join(draw.choice("0123456789abcdef") for _ in range(n))
    prose = lambda n: " ".join(draw.choice(["the", "of", "service", "runs", "on", "and", "host", "with"]) for _ in range(n))
    hits = wrong = missed = 0
    for _ in range(4000):
        kind, planted = draw.choice(["identity+material", "material+endpoint", "identity+assign", "alone", "decoy"]), []
        identity, endpoint = f"user: {word(8)}", f"postgres://db{draw.randint(1, 99)}.example:5432/app"
        if kind == "identity+material":
            planted = [identity, word(40)]
        elif kind == "material+endpoint":
            planted = [word(40), endpoint]
        elif kind == "identity+assign":
            planted = [identity, endpoint]
        pieces = list(planted)
        if kind == "identity+assign":
            pieces.append(f"password={word(12)}")
        if kind == "alone":
            pieces = [draw.choice([identity, word(40), endpoint])]
        if kind == "decoy":
            pieces = draw.choice([[hexes(64), "https://mirror.example/a.iso"], [hexes(40), "https://git.example/r/" + hexes(40)],
                                  ["https://licenses.example/by/4.0/", "https://b.example/" + word(36)]])
        draw.shuffle(pieces)
        text = prose(8)
        for piece in pieces:
            text += f" {piece} " + prose(draw.randint(1, 6))
        found = [text[s["start"] : s["end"]] for s in secret_scan.scan(text) if s["linked"]]
        hits += sum(piece in found for piece in planted)
        missed += sum(piece not in found for piece in planted)
        wrong += sum(piece not in planted for piece in found)
    assert hits / (hits + missed) > 0.99 and hits / (hits + wrong) > 0.99, (hits, missed, wrong)
