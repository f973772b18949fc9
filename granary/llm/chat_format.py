"""Chat formatting with a compiled template.

Turns of a conversation are brought together and put in order by one hash
shuffle and a sort; each task then streams its turns through the compiled
template. At most two turns are in memory, so a conversation may have any
number of them; its pieces leave as rows, one for each round of the template's
outermost loop. A conversation is rendered by one task, since its text is a
sequence and is read back as one.

Control strings inside texts are broken up by a backslash after their first
character, and backslashes are doubled; ``unguard`` undoes both.

Defined results: a null text or role counts as empty; turns come in order of
``turn``, nulls first, ties by role and text; repeated rows are turns of their
own; a null conversation id is one conversation; an empty table gives an empty
result. Other input columns are not needed and are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame

from granary.llm import text as T
from granary.llm.template import compile_template

# The control strings of the template.
BEGIN, END, ASK, ASKED = "<s>", "</s>", "[INST] ", " [/INST]"

TEMPLATE = (
    "{% for turn in turns %}{{ '<s>' + (turn.role | line) + '\\n' }}"
    "{% if turn.role == 'assistant' %}{% generation %}{{ turn.text | guard }}{% endgeneration %}"
    "{% else %}{{ '[INST] ' }}{{ turn.text | guard }}{{ ' [/INST]' }}{% endif %}{{ '</s>' }}{% endfor %}"
)

CONTROL = re.compile(r"(\\)|([<\[])(?=/?(?:s>|INST\]))")
BATCH_CHARS = 1 << 20

PIECES = "conv_id long, piece long, text string, generated array<struct<start:int,end:int>>"
ARROW_PIECES = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("piece", pa.int64()),
        ("text", pa.string()),
        ("generated", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
    ]
)


def guard(text: str) -> str:
    """``text`` without control strings."""
    if "\\" not in text and "s>" not in text and "INST]" not in text:
        return text
    return CONTROL.sub(lambda m: "\\\\" if m[1] else m[2] + "\\", text)


def unguard(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def line(text: str) -> str:
    """``text`` guarded and without line breaks."""
    return guard(text).replace("\n", "\\n")


def unline(text: str) -> str:
    return re.sub(r"\\([\\n]?)", lambda m: "\n" if m[1] == "n" else m[1], text)


FILTERS = {"guard": guard, "line": line, "trim": str.strip, "upper": str.upper, "lower": str.lower}


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batched(rows: Iterator[tuple], schema: pa.Schema, weight: int) -> Iterator[pa.RecordBatch]:
    """Batches of about BATCH_CHARS characters in the column at ``weight``."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += 64 + len(row[weight] or "")
        if chars >= BATCH_CHARS:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _pieces(rows: Iterator[tuple], template: str) -> Iterator[tuple]:
    render = compile_template(template, FILTERS)
    for conversation, turns in groupby(rows, key=lambda row: row[0]):
        text, spans, chars, number = [], [], 0, 0
        for part, generated, ends in render({"role": role, "text": said} for _, role, said in turns):
            if generated and not ends:
                spans.append({"start": chars, "end": chars + len(part)})
            text.append(part)
            chars += len(part)
            if ends:
                yield conversation, number, "".join(text), spans
                text, spans, chars, number = [], [], 0, number + 1
        if chars or not number:
            yield conversation, number, "".join(text), spans


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Rows ``conv_id, piece, text, generated``: a conversation's pieces in order, and what in each was generated.

    Pieces of one conversation follow each other in one partition, in order.
    ``turns`` may be walked once by the template.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(_pieces(_rows(batches), template), ARROW_PIECES, 2)

    compile_template(template, FILTERS)  # a bad template fails here, not in a task
    return (
        turns.select("conv_id", "turn", T.whole("role").alias("role"), T.whole("text").alias("text"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
        .mapInArrow(write, PIECES)
    )


def turns_of(text: str) -> Iterator[tuple[str, str]]:
    """Roles and texts read back from formatted text."""
    start = 0
    while (end := text.find(END, start)) >= 0:
        role, body = text[start + len(BEGIN) : end].split("\n", 1)
        role = unline(role)
        yield role, unguard(body if role == "assistant" else body[len(ASK) : -len(ASKED)])
        start = end + len(END)


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)
ARROW_DIGESTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def _digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conversation, pieces in groupby(rows, key=lambda row: row[0]):
        said, loss = hashlib.sha256(), hashlib.sha256()
        n_turns = loss_chars = chars = 0
        for _, _, text, generated in pieces:
            chars += len(text)
            for role, words in turns_of(text):
                n_turns += 1
                said.update(f"{role}\n{words}\n".encode())
            for span in generated:
                masked = unguard(text[span["start"] : span["end"]])
                loss_chars += len(masked)
                loss.update(masked.encode())
        yield conversation, n_turns, said.hexdigest(), loss_chars, loss.hexdigest(), chars


def read_back(pieces: DataFrame) -> DataFrame:
    """One row per conversation, from the output of ``format_conversations`` alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(_digests(_rows(batches)), ARROW_DIGESTS, 2)

    return pieces.mapInArrow(read, DIGESTS)
