from __future__ import annotations

import hashlib
import random
from itertools import groupby

import pytest

from granary.llm import chat_format, template
from granary.llm.template import TemplateError, compile_template, fold, parse

SOUP = ["<", "s>", "</s>", "[INST]", "[/INST]", "[", "/", "\\", "\n", "n", "a", " ", "INST]", "<s>", "assistant"]


def rendered(source: str, turns=(), filters=None) -> str:
    return "".join(text for text, _, _ in compile_template(source, filters or {})(turns))


def test_guarding_is_reversible_and_leaves_no_control_string():
    draw = random.Random(2)
    for _ in range(20_000):
        text = "".join(draw.choice(SOUP) for _ in range(draw.randint(0, 9)))
        guarded = chat_format.guard(text)
        assert chat_format.unguard(guarded) == text
        assert not any(control in guarded for control in ("<s>", "</s>", "[INST]", "[/INST]"))
        assert chat_format.unline(chat_format.line(text)) == text and "\n" not in chat_format.line(text)


def test_templates():
    turns = [{"role": "a", "n": 1}, {"role": "b", "n": 2}]
    assert rendered("{% for t in turns %}{{ loop.index0 }}{{ t.role }}{% if not loop.last %},{% endif %}{% endfor %}", turns) == "0a,1b"
    assert rendered("{% if 1 < 2 and 'a' in 'cat' %}y{% elif true %}z{% else %}n{% endif %}") == "y"
    assert rendered("{{ 'it\\'s ' + \"ok\" | up }}", filters={"up": str.upper}) == "it's OK"
    assert rendered("{{ none }}{{ 3 }}") == "3"
    pieces = list(compile_template("x{% generation %}y{{ 'z' }}{% endgeneration %}", {})([]))
    assert pieces == [("x", False, False), ("yz", True, False)]


def test_constants_are_folded():
    assert fold(parse("a{{ 'b' + 'c' }}{% if 1 == 1 %}d{% else %}{{ x }}{% endif %}e"), {}) == ("block", (("text", "abcde"),))


@pytest.mark.parametrize(
    "source",
    ["{{ turns.__class__ }}", "{{ _x }}", "{% for t in turns %}", "{% endif %}", "{{ 'a' | nofilter }}", "{{ ( 1 }}",
     "{% if x %}{% endfor %}", "{{ 1 1 }}", "{{ a ~ b }}"],
)
def test_bad_templates_are_refused(source):
    with pytest.raises(TemplateError):
        rendered(source, [])


def test_fields_are_looked_up_in_mappings_only():
    with pytest.raises(TemplateError):
        rendered("{% for t in turns %}{{ t.upper }}{% endfor %}", ["text"])
    assert not hasattr(template, "eval")


def test_conversations_come_back(spark):
    draw = random.Random(6)
    rows = [
        (draw.choice([1, 2, 3, None]), draw.choice([0, 1, 2, None]), draw.choice(["user", "assistant", "<s>\n", None]),
         "".join(draw.choice(SOUP) for _ in range(draw.randint(0, 9))) or None)
        for _ in range(400)
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    pieces = chat_format.format_conversations(turns)
    got = {r.conv_id: r for r in chat_format.read_back(pieces).collect()}
    whole = {}
    for row in pieces.collect():
        whole.setdefault(row.conv_id, []).append((row.piece, row.text))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conversation, group in groupby(sorted(rows, key=key), key=lambda r: r[0]):
        said = [(r[2] or "", r[3] or "") for r in group]
        loss = "".join(text for role, text in said if role == "assistant")
        row = got.pop(conversation)
        assert row.n_turns == len(said)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        formatted = "".join(text for _, text in sorted(whole[conversation]))
        assert row.formatted_chars == len(formatted) and list(chat_format.turns_of(formatted)) == said
    assert not got


def test_empty_table_and_more_columns(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.read_back(chat_format.format_conversations(none)).count() == 0
    more = spark.createDataFrame([(1, 0, "user", "hi", "x")], "conv_id long, turn long, role string, text string, piece string")
    assert chat_format.format_conversations(more).collect()[0].text == "<s>user\n[INST] hi [/INST]</s>"


def test_text_around_the_loop_and_no_rounds():
    pieces = list(chat_format._pieces(iter([(1, "user", "hi")]), "A{% for t in turns %}{{ t.text }}{% endfor %}B"))
    assert [p[2] for p in pieces] == ["Ahi", "B"]
    assert [p[2] for p in chat_format._pieces(iter([(1, "user", "hi")]), "A")] == ["A"]
