"""Quality rules: a threshold table compiled into one Spark projection.

Every measure and every rule is a built-in column expression, so a document is
judged in the scan's own stage: no shuffle, no Python, nothing collected.

Defined results: a null text counts as empty; texts of any length are measured
whole and none is rejected for its length; an empty text has no words and
fails the shortest-length rule; texts mostly in a script that no listed language
uses are not judged by stop words; of equal lines or windows the later ones are the repeats; repeated rows are judged alike; an empty table
gives an empty result. The input's other columns stay; a column named like a
measure is replaced by the measure.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm import text as T
from granary.llm.frames import shielded, without

WINDOW = 5

# Frequent function words of the languages the rules know.
STOP_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on",
           "not", "he", "this", "are", "or", "at", "from", "have", "which", "you"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par",
           "au", "sur", "pas", "plus", "ce", "avec"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im",
           "dem", "nicht", "ein", "eine", "als"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para", "con", "una",
           "su", "es", "al", "lo"],
    "pt": ["de", "a", "o", "que", "e", "do", "da", "em", "um", "para", "com", "não", "uma", "os", "no", "se", "na",
           "por", "mais", "as", "dos", "como", "ao", "das"],
    "it": ["di", "e", "il", "la", "che", "in", "a", "per", "un", "è", "del", "non", "una", "i", "le", "con", "si",
           "da", "della", "al"],
    "nl": ["de", "het", "een", "van", "en", "in", "is", "dat", "op", "te", "zijn", "met", "voor", "niet", "aan",
           "er", "om", "ook", "als", "door"],
    "sv": ["och", "i", "att", "det", "som", "en", "på", "är", "av", "för", "med", "till", "den", "har", "de",
           "inte", "om", "ett"],
    "pl": ["i", "w", "na", "z", "się", "do", "nie", "to", "że", "o", "jest", "a", "jak", "po", "co", "za", "od",
           "przez"],
}


# Letters of scripts none of those languages is written in (Greek, Cyrillic, Arabic, Thai, Han and so on),
# without the punctuation, symbols and pictures that stand between them.
OTHER_SCRIPT = r"[\u0370-\u1DFF\u2C80-\u2DFF\u3040-\uD7FF\uF900-\uFDFF\x{20000}-\x{3FFFF}]"


@dataclass(frozen=True)
class Rule:
    """``measure`` / ``per`` must lie within [low, high] in texts of ``from_words`` words or more.

    A ratio over nothing is within any limits. A rule on words of certain languages (``latin``)
    does not judge texts that are by more than half in a script those languages don't use.
    """

    name: str
    measure: str
    per: str | None = None
    low: float | None = None
    high: float | None = None
    from_words: int = 0
    latin: bool = False


# Measures a rule may name: the columns of ``measures``. Ratios are per word or per line.
RULES = (
    Rule("too_short", "n_words", low=10),
    Rule("word_length", "word_chars", per="n_words", low=2.0, high=16.0),
    Rule("symbols", "n_symbols", per="n_words", high=0.10),
    Rule("stop_words", "n_stop_words", per="n_words", low=0.06, from_words=30, latin=True),
    Rule("repeated_lines", "n_dup_lines", per="n_lines", high=0.50),
    Rule("list_lines", "n_bullet_lines", per="n_lines", high=0.90),
    Rule("cut_lines", "n_cut_lines", per="n_lines", high=0.30),
)


def _repeat_words(windows: Column) -> Column:
    """Words covered by windows that occur twice or more; ``windows`` holds one hash per start."""

    def covered(starts: Column) -> Column:
        steps = F.transform(
            starts,
            lambda p, i: F.least(F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)),
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    def repeated(order: Column) -> Column:
        twice = F.filter(
            order,
            lambda x, i: F.coalesce(F.get(order, i - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(order, i + 1)["h"] == x["h"], F.lit(False)),
        )
        return T.let(F.sort_array(F.transform(twice, lambda x: x["p"])), covered)

    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), T.let(placed, repeated)).otherwise(
        F.lit(0).cast("long")
    )


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures the rules speak of.

    A window of five words is told within its own document by a 64-bit hash of its words' hashes.
    """
    whole = T.whole(text)
    stop = sorted({word for listed in STOP_WORDS.values() for word in listed})
    lines = F.filter(F.split(whole, "\n"), lambda line: F.btrim(line, F.lit(T.SPACES)) != "")
    starts = F.slice(
        F.transform(
            F.col("_hashes"),
            lambda h, i: F.xxhash64(h, *[F.get("_hashes", i + step) for step in range(1, WINDOW)]),
        ),
        F.lit(1),
        F.size("_hashes") - (WINDOW - 1),
    )
    none = F.array().cast("array<bigint>")
    return (
        docs.withColumns({"_words": T.words(whole), "_lines": lines})
        .withColumn("_hashes", F.transform("_words", lambda word: F.xxhash64(word)))
        .withColumn("_windows", F.when(F.size("_words") >= WINDOW, starts).otherwise(none))
        .withColumns(
            {
                "n_words": F.size("_words").cast("long"),
                "word_chars": F.length(F.array_join("_words", "")).cast("long"),
                "n_symbols": F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long"),
                "n_lines": F.size("_lines").cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "n_repeat_words": _repeat_words(F.col("_windows")),
                "n_stop_words": F.size(F.filter("_words", lambda word: word.isin(stop))).cast("long"),
                "n_other_script": F.regexp_count(whole, F.lit(OTHER_SCRIPT)).cast("long"),
                "n_bullet_lines": F.size(F.filter("_lines", lambda line: line.rlike("^\\s*[-*•‣]"))).cast("long"),
                "n_cut_lines": F.size(F.filter("_lines", lambda line: line.rlike("(\\.\\.\\.|…)\\s*$"))).cast("long"),
            }
        )
        .drop("_words", "_lines", "_hashes", "_windows")
    )


def compiled(rules: tuple[Rule, ...] = RULES) -> Column:
    """Array of the names of the rules a row of ``measures`` breaks."""
    broken = []
    for rule in rules:
        value = F.col(rule.measure).cast("double")
        if rule.per:
            value = value / F.nullif(F.col(rule.per).cast("double"), F.lit(0.0))
        outside = F.lit(False)
        if rule.low is not None:
            outside = outside | (value < rule.low)
        if rule.high is not None:
            outside = outside | (value > rule.high)
        if rule.from_words:
            outside = outside & (F.col("n_words") >= rule.from_words)
        if rule.latin:
            outside = outside & (F.col("n_other_script") * 2 <= F.col("word_chars"))
        broken.append(F.when(outside, F.lit(rule.name)))
    return F.array_compact(F.array(*broken))


def base_failed() -> Column:
    """Too few words, or more than a fifth of them in repeated windows."""
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


@shielded
def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with measures, ``broken_rules``, ``base_failed`` and ``kept``."""
    docs = without(docs, *({"broken_rules", "base_failed", "kept"} - {text}))
    return measures(docs, text).withColumns({"broken_rules": compiled(rules), "base_failed": base_failed()}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("broken_rules") == 0)
    )
