"""Secret scans with multipart credential linking.

Three kinds of text are reported wherever they stand: assignments of secrets,
access identifiers and long hexadecimal runs. Others say little alone: a user
name, a random-looking string, an address. These weak candidates are joined
with the parts that complete a credential (identity, secret, endpoint): each
candidate's scope, ``REACH`` characters either way inside its own paragraph, is
an interval, and a candidate is reported only if a complementary part overlaps
it. Parts of one role are disjoint and sorted, so the interval join is a binary
search per candidate, linear in the text.

Whole texts are scanned in the scan's own stage, one row at a time, without a
shuffle. Offsets are code points, ends exclusive.

Defined results: null and empty texts have no spans; texts of any length are
scanned whole; of spans that start at one place the kinds stand in fixed order;
repeated rows are scanned alike; an empty table gives an empty result. An input column named ``spans`` is
replaced.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import text as T
from granary.llm.frames import without

# The patterns of the base kinds, whose failing matches are dropped.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]+")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
HEX_MARKS = bytes(120 if chr(i) in "0123456789abcdef" else 32 for i in range(256))

IDENTITY = re.compile(
    r"""(?:user(?:_?name)?|login|account(?:_?id)?|client_?id|access_?key_?id|tenant_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._+-]{3,})""",
    re.IGNORECASE | re.ASCII,
)
IDENTITY_WORDS = (b"user", b"login", b"account", b"client", b"access", b"tenant")
MATERIAL = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"""[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]{4,}|(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}:\d{2,5}(?!\d)""")
HEX_LIKE = re.compile(r"[0-9A-Fa-f-]+")
PORT = re.compile(r"\.\d{1,3}:\d{2}")  # in every endpoint without ://
PARAGRAPH = re.compile(r"\n[\x20\t]*\n")
REACH = 240
LEAST_BITS = 3.5

KINDS = ("assign", "access", "hex", "identity", "material", "endpoint")
ROLE = {"assign": "secret", "hex": "digest", "material": "secret", "access": "identity", "identity": "identity", "endpoint": "endpoint"}
# what completes a weak candidate; a bare run of hex digits may be a checksum, so it completes no endpoint
NEEDS = {"identity": ("secret", "digest"), "material": ("identity", "endpoint"), "endpoint": ("secret", "identity")}

SPAN = "array<struct<kind:string,start:int,end:int,linked:boolean>>"
ARROW_SPAN = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("linked", pa.bool_())])
)

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Assignments, access identifiers and hexadecimal runs, leftmost and disjoint within a kind."""
    raw = text.encode("utf-8", "surrogatepass")
    lower, found = raw.lower(), []
    if any(word in lower for word in KEYWORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if b"AKIA" in raw:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    if b"x" * LEAST_HEX in raw.translate(HEX_MARKS):
        found += [("hex", *m.span()) for m in HEX.finditer(text) if len(m[0]) >= LEAST_HEX]
    return found


def _random_looking(token: str) -> bool:
    classes = any(c.islower() for c in token) + any(c.isupper() for c in token) + any(c.isdigit() for c in token)
    if classes < 3:
        return False
    shares = [n / len(token) for n in Counter(token).values()]
    return -sum(p * math.log2(p) for p in shares) >= LEAST_BITS


def _overlaps(sorted_spans: list[Span], low: int, high: int) -> bool:
    """Whether any of the disjoint spans overlaps [low, high)."""
    at = bisect_right(sorted_spans, low, key=lambda span: span[2])
    return at < len(sorted_spans) and sorted_spans[at][1] < high


def linked_spans(text: str, base: list[Span]) -> list[Span]:
    """Weak candidates whose scope holds a part that completes them."""
    lower = text.lower()
    weak = []
    if any(word.decode() in lower for word in IDENTITY_WORDS):
        weak += [("identity", *m.span()) for m in IDENTITY.finditer(text)]
    if "://" in text or PORT.search(text):
        weak += [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    if not base and not weak:
        return []
    # checksums and ids in hex digits are no material, nor is a part of an address
    ends = [w for w in weak if w[0] == "endpoint"]
    weak += [
        ("material", *m.span())
        for m in MATERIAL.finditer(text)
        if _random_looking(m[0]) and not HEX_LIKE.fullmatch(m[0]) and not _overlaps(ends, *m.span())
    ]

    parts: dict[str, list[Span]] = {"secret": [], "digest": [], "identity": [], "endpoint": []}
    strong = sorted(base, key=lambda span: span[1:])
    by_kind = {kind: [s for s in strong if s[0] == kind] for kind in KINDS[:3]}
    # a weak candidate that repeats a reported span is not a part of its own
    weak = [w for w in weak if not any(_overlaps(spans, w[1], w[2]) for spans in by_kind.values())]
    for span in sorted(strong + weak, key=lambda span: span[1:]):
        role = parts[ROLE[span[0]]]
        if role and span[1] < role[-1][2]:  # keep a role's parts disjoint: join what overlaps
            role[-1] = (role[-1][0], role[-1][1], max(role[-1][2], span[2]))
        else:
            role.append(span)
    breaks = [m.start() for m in PARAGRAPH.finditer(text)]
    linked = []
    for span in weak:
        at = bisect_left(breaks, span[1])
        low = max(span[1] - REACH, breaks[at - 1] if at else 0)
        high = min(span[2] + REACH, breaks[at] if at < len(breaks) else len(text))
        if any(_overlaps(parts[role], low, high) for role in NEEDS[span[0]]):
            linked.append(span)
    return linked


def scan(text: str) -> list[dict]:
    """All spans by start, then kind."""
    base = base_spans(text)
    spans = [(*span, False) for span in base] + [(*span, True) for span in linked_spans(text, base)]
    spans.sort(key=lambda span: (span[1], KINDS.index(span[0])))
    return [{"kind": k, "start": s, "end": e, "linked": linked} for k, s, e, linked in spans]


def _scanned(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array([scan(text.as_py() or "") for text in texts], ARROW_SPAN)


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: kind, start, end and whether the span was reported by linking."""
    return without(docs, *({"spans"} - {text})).withColumn("spans", F.arrow_udf(_scanned, SPAN)(T.whole(text)))
