from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from granary.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows: list[tuple]) -> list[tuple]:
    """The trie's rows, from conversations rebuilt and compared one by one."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        own[conv].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {conv: [row[3:] for row in sorted(turns)] for conv, turns in own.items()}
    rebuilt = {}
    for conv, turns in own.items():
        h = 0 if conv is None else zlib.crc32(str(conv).encode()) % 4
        base = [] if conv is None else own.get(int(conv - (abs(conv) % 20) * (1 if conv >= 0 else -1)), [])
        rebuilt[conv] = tuple(base[:h] + turns[h:])
    members = defaultdict(list)
    for conv, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv)
    nodes = sorted(members, key=len, reverse=True)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    least = lambda node: min((c for c in members[node] if c is not None), default=None)
    found = []
    for node in nodes:
        if node:
            saved[node] += (len(members[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1]))
        leaves[node] += not children[node]
        ended = sorted((c is not None, c or 0) for c in members[node] if len(rebuilt[c]) == len(node))
        joined = ",".join(str(c) if named else "" for named, c in ended)
        parent = least(node[:-1]) if node else None
        found.append((least(node), len(node), parent, len(members[node]), children[node], leaves[node], saved[node],
                      hashlib.sha256(joined.encode()).hexdigest()))
        if node:
            children[node[:-1]] += 1
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    return sorted(found, key=repr)


def result(frame) -> list[tuple]:
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(row) for row in frame.select(*names).collect()), key=repr)


def conversations(seed: int, count: int, longest: int) -> list[tuple]:
    draw, rows = random.Random(seed), []
    for conv in range(-30, count - 30):
        for turn in range(draw.randint(1, longest)):
            said = " ".join(draw.choice(["a", "b c", "Ä d"]) for _ in range(draw.choice([1, 1, 1, 2])))
            rows.append((conv, turn, ("user", "assistant")[turn % 2], said))
    return rows


@pytest.mark.parametrize("height", [None, 1, 2, 3])
def test_against_brute_force(spark, height):
    rows = conversations(5, 130, 7) + [(400, turn, "user", "a") for turn in range(23)] + [(401, turn, "user", "a") for turn in range(20)]
    rows += [(c, t, r, x) for c in range(500, 560) for t, r, x in ((0, "user", "a"), (1, "assistant", "b c"), (2, "user", "end"))]
    turns = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert result(prefix_trie.trie(turns, height)) == brute(rows)


def test_ends_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    rows = [(c, t, "user", f"t{t}") for c in range(300) for t in range(5)]
    assert result(prefix_trie.trie(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "x"), (None, 0, None, None), (3, None, "user", "x"), (3, 0, None, "y"), (3, 0, None, "y"), (3, 0, "b", None),
        (4, 1, "user", "w " * 50_000), (21, 0, "a", ""), (0, 0, "a", ""), (0, 5, "", "a"), (40, 2, "user", " \t\n"), (41, 2, "user", " "),
    ]
    turns = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("z") for n in ("depth", "node", "_none", "d", "words")})
    assert result(prefix_trie.trie(turns)) == brute(rows)


def test_rows_that_leave_no_turns(spark):
    turnless = [c for c in range(1, 200) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3][:3]
    rows = [(c, t, "user", "x") for c in turnless for t in range(2)]
    turns = spark.createDataFrame(rows, SCHEMA)
    assert result(prefix_trie.trie(turns)) == brute(rows)
    assert len(brute(rows)) == 1


def test_empty_table(spark):
    frame = prefix_trie.trie(spark.createDataFrame([], SCHEMA))
    assert frame.count() == 0 and [t for _, t in frame.dtypes] == ["bigint"] * 7 + ["string"]


def test_rounds_and_explosion_stay_below_the_root_of_the_depth():
    for deepest in (1, 8, 64, 65, 400, 1_000_000):
        height = prefix_trie.band_height(deepest)
        assert height >= prefix_trie.LEAST_HEIGHT and height <= max(prefix_trie.LEAST_HEIGHT, deepest**0.5 + 1)
        assert deepest // height <= height
