from __future__ import annotations

import re
from collections import Counter

from granary.llm import quality_rules
from tests.llm.conftest import odd_rows, prose


def brute(text: str | None) -> tuple:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
        len(covered), failed,
    )


def test_measures_against_brute_force(spark):
    texts = [row[1] for row in odd_rows()]
    texts += ["a b c d e a b c d e", "a a a a a a", "x\nx\n \nx\ny", "a#b *** |c| <d>", prose(5, 30) + " " + prose(5, 30)]
    texts += [" ".join("ab"[i * i % 7 % 2] for i in range(n)) for n in range(4, 40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in quality_rules.judge(docs).collect():
        got = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed)
        assert got == brute(texts[row.doc_id]), texts[row.doc_id]
        assert not (row.kept and row.base_failed)
        assert row.kept == (not row.base_failed and not row.broken_rules)


def test_odd_rows_and_columns(odd_documents, no_documents):
    judged = quality_rules.judge(odd_documents)
    assert judged.count() == odd_documents.count()
    assert set(odd_documents.columns) <= set(judged.columns)
    assert [r._unit for r in judged.collect()] == [7] * judged.count()
    assert quality_rules.judge(no_documents).count() == 0


def test_plan_is_one_native_projection(odd_documents):
    plan = quality_rules.judge(odd_documents)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


PLAIN = {
    "pt": "Os moradores da aldeia foram ao mercado de manhã e compraram pão, queijo e fruta para o almoço de domingo, "
    "porque a família vinha da cidade e não havia nada em casa para comer com os primos.",
    "it": "La nonna è andata al mercato con il nipote e ha comprato del pane, un formaggio e le mele per il pranzo "
    "della domenica, che non si fa in casa senza una torta e un bicchiere di vino.",
    "nl": "De boer is vroeg in de ochtend met het paard naar de markt gegaan om een nieuwe kar te kopen, maar hij had "
    "niet genoeg geld bij zich en moest ook aan de kinderen denken.",
    "ru": "Старый рыбак вышел рано утром к реке и долго смотрел на воду, где над камнями стоял туман, а на другом "
    "берегу уже горел костёр и слышались голоса детей, которые приехали из города вчера вечером к бабушке в гости",
    "el": "Ο γέρος ψαράς βγήκε νωρίς το πρωί στο ποτάμι και κοίταζε για ώρα το νερό εκεί που η ομίχλη στεκόταν πάνω "
    "από τις πέτρες και στην άλλη όχθη άναβε κιόλας μια φωτιά και ακούγονταν φωνές παιδιών από την πόλη",
}


def test_plain_prose_of_many_languages_is_kept(spark):
    docs = spark.createDataFrame(list(PLAIN.items()), "doc_id string, text string")
    for row in quality_rules.judge(docs).collect():
        assert row.n_words >= 30 and row.kept, (row.doc_id, row.broken_rules)


def test_word_lists_without_stop_words_still_fail(spark):
    listed = [" ".join(f"keyword{n}x" for n in range(40)), " ".join(f"keyword{n}x слово" for n in range(40))]
    docs = spark.createDataFrame(list(enumerate(listed)), "doc_id long, text string")
    assert [row.broken_rules for row in quality_rules.judge(docs).collect()] == [["stop_words"]] * 2


def test_letters_of_other_scripts(spark):
    text = "aé “x” 12 😀 ω ж ก 漢 ア ﷲ 𠀀 — … ü"
    row = quality_rules.measures(spark.createDataFrame([(text,), (None,)], "text string")).collect()
    assert [r.n_other_script for r in row] == [7, 0]
