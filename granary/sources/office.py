"""Rows of XLSX sheets and DOCX documents.

Office files are zip archives of XML that no Spark reader opens. They cannot
be split, so the unit of work is one file: Spark spreads the files over tasks
and a small generator walks the XML of each without building a tree.
"""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree.ElementTree import iterparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.text import strip_whitespace

CHUNK = 5_000
DAY_ZERO = datetime(1899, 12, 30)  # workbook serial 0
BUILT_IN_DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _elements(archive: zipfile.ZipFile, member: str, wanted: str) -> Iterator:
    """Each ``wanted`` element in turn, emptied again once it has been handled."""
    with archive.open(member) as stream:
        for _, element in iterparse(stream):
            if _local(element.tag) == wanted:
                yield element
                element.clear()


def _text(element) -> str:
    return "".join(node.text or "" for node in element.iter() if _local(node.tag) == "t")


def _date_styles(archive: zipfile.ZipFile) -> set[int]:
    """Indexes of cell styles that show a number as a date."""
    if "xl/styles.xml" not in archive.namelist():
        return set()
    custom, styles = set(), set()
    for element in _elements(archive, "xl/styles.xml", "numFmt"):
        code = re.sub(r'"[^"]*"|\[[^\]]*\]', "", element.get("formatCode", ""))
        if re.search(r"[ymdhs]", code, re.IGNORECASE):
            custom.add(int(element.get("numFmtId")))
    for formats in _elements(archive, "xl/styles.xml", "cellXfs"):
        for index, cell_format in enumerate(formats):
            if int(cell_format.get("numFmtId", 0)) in BUILT_IN_DATE_FORMATS | custom:
                styles.add(index)
    return styles


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - ord("A") + 1
    return index - 1


def _cell_value(cell, shared: list[str], date_styles: set[int]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return _text(cell)
    raw = next((node.text for node in cell if _local(node.tag) == "v"), None)
    if raw is None:
        return None
    if kind == "s":
        return shared[int(raw)]
    if kind == "n" and int(cell.get("s", 0)) in date_styles:
        moment = DAY_ZERO + timedelta(days=float(raw))
        return moment.date().isoformat() if moment.time() == datetime.min.time() else moment.isoformat()
    return raw


def _sheet_rows(archive: zipfile.ZipFile) -> Iterator[list[str | None]]:
    shared = []
    if "xl/sharedStrings.xml" in archive.namelist():
        shared = [_text(item) for item in _elements(archive, "xl/sharedStrings.xml", "si")]
    date_styles = _date_styles(archive)
    sheets = [n for n in archive.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)]
    first = min(sheets, key=lambda name: int(re.search(r"\d+", name).group()))
    for row in _elements(archive, first, "row"):
        values: list[str | None] = []
        for position, cell in enumerate(c for c in row if _local(c.tag) == "c"):
            index = _column_index(cell.get("r")) if cell.get("r") else position
            values.extend([None] * (index + 1 - len(values)))
            values[index] = _cell_value(cell, shared, date_styles)
        yield values


def _at_table_depth(archive: zipfile.ZipFile, wanted: str, depth: int) -> Iterator:
    """``wanted`` elements of a document that lie inside ``depth`` tables.

    None ends each outermost table.
    """
    nesting = 0
    with archive.open("word/document.xml") as stream:
        for event, element in iterparse(stream, ("start", "end")):
            name = _local(element.tag)
            if name == "tbl":
                nesting += 1 if event == "start" else -1
                if nesting == 0:
                    yield None
            elif name == wanted and event == "end" and nesting == depth:
                yield element
                element.clear()


def _document_rows(archive: zipfile.ZipFile) -> Iterator[list[str | None]]:
    for row in _at_table_depth(archive, "tr", depth=1):
        if row is None:
            return  # only the first table counts
        cells = [cell for cell in row if _local(cell.tag) == "tc"]
        yield ["\n".join(_text(p) for p in cell if _local(p.tag) == "p") for cell in cells]


def _records(content: bytes, suffix: str) -> Iterator[str]:
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        rows = _sheet_rows(archive) if suffix == "xlsx" else _document_rows(archive)
        header = [str(name) for name in next(rows, [])]
        for values in rows:
            padded = values + [None] * (len(header) - len(values))
            yield json.dumps(dict(zip(header, padded)), ensure_ascii=False)


def _paragraphs(content: bytes) -> Iterator[str]:
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for paragraph in _at_table_depth(archive, "p", depth=0):
            if paragraph is not None:
                yield _text(paragraph)


def _numbered(items: Iterator[str], path: str, column: str) -> Iterator[pd.DataFrame]:
    """Items of one file as frames of bounded size, counted from 1."""
    chunk: list[str] = []
    start = 1
    for item in items:
        chunk.append(item)
        if len(chunk) == CHUNK:
            yield pd.DataFrame({"path": path, "row_number": range(start, start + len(chunk)), column: chunk})
            start += len(chunk)
            chunk = []
    if chunk:
        yield pd.DataFrame({"path": path, "row_number": range(start, start + len(chunk)), column: chunk})


def _expand_tables(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for path, content in zip(frame["path"], frame["content"]):
            yield from _numbered(_records(content, path.rpartition(".")[2].lower()), path, "raw_json")


def _expand_paragraphs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for path, content in zip(frame["path"], frame["content"]):
            yield from _numbered(_paragraphs(content), path, "text")


def _contents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def table_rows(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path, row_number, raw_json`` of every record below the header row."""
    return _contents(spark, path).mapInPandas(_expand_tables, "path string, row_number bigint, raw_json string")


def paragraphs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path, row_number, text`` of every paragraph in DOCX files."""
    return _contents(spark, path).mapInPandas(_expand_paragraphs, "path string, row_number bigint, text string")


def keyed_paragraphs(
    lines: DataFrame, pattern: str, names: list[str], column: str = "text", marker: str = ""
) -> DataFrame:
    """Regex groups of the lines that match, trimmed; other lines are dropped.

    ``marker`` is text that every match contains. Looking for it is far
    cheaper than the pattern and spares most lines the regex.
    """
    groups = [
        strip_whitespace(F.regexp_extract(column, pattern, i)).alias(name)
        for i, name in enumerate(names, start=1)
    ]
    kept = [c for c in lines.columns if c != column]
    candidates = lines.filter(F.col(column).contains(marker)) if marker else lines
    return candidates.filter(F.col(column).rlike(pattern)).select(*kept, *groups)
