"""Token counts with a map-side two-tier lookup.

A text's token count is the sum of its pre-tokens' counts, and a few ten
thousand pre-tokens make up most text. Their counts go to every worker as one
compact broadcast table (at most ``FREQUENT`` entries, whatever the input);
other pre-tokens are encoded by the library once per worker and kept in its
bounded cache. Documents never move: there is no shuffle of pre-tokens or text.

The frequent ones come from a sample of about ``SAMPLE_TEXTS`` documents. The
sample decides what is looked up fast, never a count.

The pattern below cuts text as the byte-level tokenizers' library does, but for
characters unassigned in one Unicode version and assigned in another; a text
with such a character, or with one of the tokenizer's added special strings, is
encoded whole by the library.

Defined results: null and empty texts have 0 bytes and 0 tokens; texts of any length are
counted whole, in pieces cut where no pre-token goes across; ties in frequency change no count; repeated rows
are counted alike; an empty table gives an empty result. Input columns named
like an added one are replaced.
"""

from __future__ import annotations

import os
import unicodedata
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm import text as T
from granary.llm.frames import shielded, without

FREQUENT = 65_536
SAMPLE_TEXTS = 4_000
CACHED = 400_000
LONGEST_CACHED = 64
PIECE = 1 << 20

# The pre-token pattern of byte-level tokenizers.
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# A pre-token always ends before a space between two letters.
SEAM = regex.compile(r"(?<=\p{L})(?= \p{L})")

# Larger than any sum of counts: the text has to go to the library whole.
ODD = 1 << 50

_workers: dict[str, Lookup] = {}


def pieces(text: str) -> Iterator[str]:
    """The text in runs of about ``PIECE`` characters, cut only where pre-tokens end anyway."""
    start = 0
    while len(text) - start > PIECE:
        seam = SEAM.search(text, start + PIECE)
        if not seam:
            break
        yield text[start : seam.start()]
        start = seam.start()
    yield text[start:]


class Lookup:
    """The two tiers of one worker."""

    def __init__(self, tokenizer: str, frequent: tuple[str, bytes, bytes]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(tokenizer)
        self.special = [token.content for token in self.library.get_added_tokens_decoder().values()]
        joined, ends, counts = frequent
        self.frequent, start = {}, 0
        for end, count in zip(array("I", ends), array("H", counts)):
            self.frequent[joined[start:end]] = count
            start = end
        self.known = dict(self.frequent)

    def learn(self, tokens: set[str]) -> dict[str, int]:
        """Encode the pre-tokens not known; the long ones are returned, the rest kept."""
        if len(self.known) + len(tokens) > FREQUENT + CACHED:
            self.known = dict(self.frequent)
        missing = [token for token in tokens if token not in self.known]
        encoded = self.library.encode_batch(missing, add_special_tokens=False)
        passing: dict[str, int] = {}
        for token, found in zip(missing, encoded):
            odd = not token.isascii() and any(unicodedata.category(c) == "Cn" for c in token)
            kept = self.known if len(token) <= LONGEST_CACHED else passing
            kept[token] = ODD if odd else len(found)
        return passing

    def count(self, text: str) -> int:
        if any(special in text for special in self.special):
            return len(self.library.encode(text, add_special_tokens=False))
        total = 0
        for piece in pieces(text):
            tokens = PRE_TOKEN.findall(piece)
            try:
                total += sum(map(self.known.__getitem__, tokens))
            except KeyError:
                passing = self.learn(set(tokens))
                known = self.known | passing if passing else self.known
                total += sum(map(known.__getitem__, tokens))
        return total if total < ODD else len(self.library.encode(text, add_special_tokens=False))


def _counted(tokenizer, frequent):
    """Arrow function from texts to token counts; the lookup lives as long as its worker."""
    key = uuid.uuid4().hex

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if key not in _workers:
            _workers.clear()
            _workers[key] = Lookup(tokenizer.value, frequent.value)
        lookup = _workers[key]
        for texts in batches:
            yield pa.array([lookup.count(text.as_py() or "") for text in texts], pa.int64())

    return F.arrow_udf(count, "long")


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0):
            for piece in pieces(text.as_py() or ""):
                tally.update(token for token in PRE_TOKEN.findall(piece) if len(token) <= LONGEST_CACHED)
    common = tally.most_common(FREQUENT)
    yield pa.record_batch([pa.array([t for t, _ in common], pa.string()), pa.array([n for _, n in common], pa.int64())], ["token", "n"])


def frequent_table(texts: DataFrame, tokenizer: str) -> tuple[str, bytes, bytes]:
    """The commonest pre-tokens of a sample of ``texts`` (one string column) with their counts, packed."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    rows = texts.count()
    sample = texts.sample(min(1.0, SAMPLE_TEXTS / max(1, rows)), seed=7)
    top = (
        sample.mapInArrow(_tally, "token string, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "token")
        .limit(FREQUENT)
        .collect()
    )
    tokens = [row.token for row in top if not any(unicodedata.category(c) == "Cn" for c in row.token)]
    encoded = Tokenizer.from_str(tokenizer).encode_batch(tokens, add_special_tokens=False)
    ends, place = array("I"), 0
    for token in tokens:
        place += len(token)
        ends.append(place)
    return "".join(tokens), ends.tobytes(), array("H", map(len, encoded)).tobytes()


@shielded
def count_tokens(docs: DataFrame, tokenizer_file: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit``."""
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as file:  # on the driver; workers get it by broadcast
        tokenizer = file.read()
    table = frequent_table(docs.select(T.whole(text).alias("text")), tokenizer)
    counted = _counted(spark.sparkContext.broadcast(tokenizer), spark.sparkContext.broadcast(table))
    docs = without(docs, *({"n_bytes", "n_tokens", "over_limit"} - {text}))
    whole = T.whole(text)
    return docs.withColumns({"n_bytes": F.octet_length(whole).cast("long"), "n_tokens": counted(whole)}).withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
