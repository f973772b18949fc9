"""Split readers against readers of whole files, at many split sizes."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from granary.operators.keys import file_positions
from granary.sources import files, splits

FIELDS = ["a", "b", "c"]


@pytest.fixture(params=[150, 1 << 20])
def split_bytes(spark, request):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(name) for name in names]
    spark.conf.set(names[0], str(request.param))
    spark.conf.set(names[1], "0")
    yield request.param
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def rows(records):
    placed = file_positions(records).select("source_file", "source_row", "raw_json", *FIELDS)
    return sorted(tuple(r) for r in placed.collect())


def unsplit_csv(spark, path):
    raw = files.read_delimited(spark, path)
    return raw.select(*files._origin(), files._as_json(raw.columns).alias("raw_json"), *files._conformed(raw, FIELDS))


def unsplit_json(spark, path):
    raw = spark.read.options(**files.JSON_OPTIONS).option("multiLine", True).json(path)
    return raw.select(*files._origin(), files._as_json(raw.columns).alias("raw_json"), *files._conformed(raw, FIELDS))


def test_csv(spark, tmp_path, split_bytes):
    draw = random.Random(split_bytes)
    values = ["x", "", "plain words", "a,b", "line\nbreak", "two\n\nbreaks,\n", 'quo"te', '""', '"\n"', " pad ", "Ä\nß", "\n", "1.5"]
    for name in ("one.csv", "two.csv"):
        text = "\ufeffa,b,more\n"
        for _ in range(30):
            fields = []
            for _ in range(3):
                value = draw.choice(values)
                must = any(mark in value for mark in ',"\n')
                fields.append('"' + value.replace('"', '""') + '"' if must or draw.random() < 0.3 else value)
            text += ",".join(fields) + "\n" + "\n" * (draw.random() < 0.1)
        (tmp_path / name).write_text(text)
    got, expected = rows(files.csv_records(spark, str(tmp_path), FIELDS)), rows(unsplit_csv(spark, str(tmp_path)))
    assert got == expected and len(got) > 50


def test_csv_with_carriage_returns_and_stray_quotes(spark, tmp_path, split_bytes):
    lines = ['a,b,c', '1,2,3', '"x\ny",5" pipe,z', 'p "q" r,s,"t ""u""\n"', "", "last,one,"] * 1
    (tmp_path / "one.csv").write_bytes("\r\n".join(lines).encode())
    got = file_positions(files.csv_records(spark, str(tmp_path), FIELDS)).orderBy("source_row").collect()
    assert [(r.source_row, r.a, r.b, r.c) for r in got] == [
        (1, "1", "2", "3"), (2, "x\ny", '5" pipe', "z"), (3, 'p "q" r', "s", 't "u"\n'), (4, "last", "one", None),
    ]


def test_json_arrays(spark, tmp_path, split_bytes):
    draw = random.Random(split_bytes)
    values = ["x", 'q"uote', "back\\slash", "brace } inside", "{[", "]}", '\\"', "", 1, 2.50, None, True, {"n": {"d": "}"}}, ["v", "{"], "Ä€"]
    for name, style in (("one.json", {"indent": 2}), ("two.json", {}), ("three.json", {"ensure_ascii": False, "separators": (",", ":")})):
        records = [{key: draw.choice(values) for key in draw.sample(["a", "b", "more"], draw.randint(1, 3))} for _ in range(14)]
        (tmp_path / name).write_text("\ufeff" * (name[0] == "o") + json.dumps([r | {"a": str(r.get("a"))} for r in records if not isinstance(r.get("b"), (dict, list))], **style) + "\n")
    got, expected = rows(files.json_array_records(spark, str(tmp_path), FIELDS)), rows(unsplit_json(spark, str(tmp_path)))
    assert got == expected and len(got) > 15


def test_nested_values_and_single_objects(spark, tmp_path, split_bytes):
    (tmp_path / "one.json").write_text('[{"a": {"x": [{"y": "}"}, {"y": "]"}]}, "b": "1"}, {"a": {"x": []}, "b": "2"}]')
    assert rows(files.json_array_records(spark, str(tmp_path), FIELDS)) == rows(unsplit_json(spark, str(tmp_path)))
    (tmp_path / "one.json").write_text('  {"a": "only", "b": {"c": "}"}}\n')
    got = rows(files.json_array_records(spark, str(tmp_path), FIELDS))
    assert [r[:2] + r[3:4] for r in got] == [("one.json", 1, "only")]


@pytest.mark.parametrize("text, count", [("[]", 0), ("[ ]\n", 0), ("", 0), ('[{"a": 1}]', 1)])
def test_short_arrays(spark, tmp_path, text, count):
    (tmp_path / "one.json").write_text(text)
    assert files.json_array_records(spark, str(tmp_path), FIELDS).count() == count


@pytest.mark.parametrize("text", ['[{"a": 1}, {"a": ', '[{"a": 1}, {"a": "x}]'])
def test_a_file_cut_short_fails(spark, tmp_path, text):
    (tmp_path / "one.json").write_text(text)
    with pytest.raises(Exception, match="broken JSON array|MALFORMED"):
        files.json_array_records(spark, str(tmp_path), FIELDS).count()


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    (tmp_path / "one.csv").write_text("a,b\n" + '"x\ny",z\n' * 20_000)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        lines = splits._pieces(spark, str(tmp_path), "\n")
        assert lines.select("_block").distinct().count() >= 8
        assert splits.csv_texts(spark, str(tmp_path)).agg(F.max("_record")).first()[0] == 20_001
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_lines_of_very_many_quotes(spark):
    frame = spark.createDataFrame([('"' + 'x""' * 100_000 + '"',), ('"' + 'x""' * 100_000,), ("a," * 100_000 + '"b"',)], "value string")
    outside, inside = splits._ends(",")
    assert [r[0] for r in frame.select(outside).collect()] == [0, 1, 0]
