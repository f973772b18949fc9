"""Landing-file readers: CSV, JSON array, JSON Lines, pipe text, Office files.

Every reader of order files returns the same shape, still tagged with where a
row came from:

``source_file, _file, _block, _seq, raw_json`` and the declared text fields

``(_file, _block)`` is one input split and ``_seq`` counts up by one within
it, which is all that :func:`granary.operators.keys.file_positions` needs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.session import exists
from granary.sources import office, splits

ORIGIN = ["source_file", "_file", "_block", "_seq"]
CSV_OPTIONS = {"quote": '"', "escape": '"', "nullValue": "\u0000", "emptyValue": ""}
JSON_OPTIONS = {"primitivesAsString": "true", "mode": "FAILFAST"}


def _origin() -> list[Column]:
    return [
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
    ]


def _conformed(df: DataFrame, fields: list[str]) -> list[Column]:
    """Declared fields as text; a field the file lacks becomes NULL."""
    return [
        (F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast("string").alias(name) for name in fields
    ]


def _as_json(columns: list[str]) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"})


def read_delimited(
    spark: SparkSession, path: str | list[str], sep: str = ",", quoted_newlines: bool = True
) -> DataFrame:
    """Delimited text with a header, everything as text.

    The byte order mark is dropped; an empty field reads as NULL, one in quotes
    as the empty string. With ``quoted_newlines`` one task reads a file;
    ``csv_records`` reads it with many.
    """
    return (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("multiLine", quoted_newlines)
        .options(**CSV_OPTIONS)
        .option("enforceSchema", False)
        .csv(path)
    )


def csv_records(
    spark: SparkSession, path: str | list[str], fields: list[str], sep: str = ",", quoted_newlines: bool = True
) -> DataFrame:
    """Records of CSV files with one header; line breaks inside quotes are told from others over all splits."""
    raw = read_delimited(spark, path, sep, quoted_newlines)
    if not quoted_newlines:
        return raw.select(*_origin(), _as_json(raw.columns).alias("raw_json"), *_conformed(raw, fields))
    return _placed(splits.csv_rows(spark, path, raw.columns, CSV_OPTIONS, sep), fields)


def _placed(rows: DataFrame, fields: list[str]) -> DataFrame:
    """Records numbered within their file, in the readers' shape."""
    named = [name for name in rows.columns if name not in ("source_file", "_file", "_record")]
    payload = _as_json(named) if named else F.lit("{}")
    return rows.select(
        "source_file", "_file", F.lit(0).cast("bigint").alias("_block"), F.col("_record").alias("_seq"),
        payload.alias("raw_json"), *_conformed(rows.select(*[f"`{n}`" for n in named]), fields),
    )


def _from_raw_json(df: DataFrame, fields: list[str]) -> DataFrame:
    schema = T.StructType([T.StructField(name, T.StringType()) for name in fields])
    parsed = df.withColumn("_record", F.from_json("raw_json", schema, {"mode": "FAILFAST"}))
    return parsed.select(*ORIGIN, "raw_json", *[F.col(f"_record.{name}").alias(name) for name in fields])


def jsonl_records(spark: SparkSession, path: str | list[str], fields: list[str]) -> DataFrame:
    """One JSON object per line; blank lines are skipped, a broken line fails."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return _from_raw_json(lines.select(*_origin(), F.trim("value").alias("raw_json")), fields)


def json_array_records(spark: SparkSession, path: str | list[str], fields: list[str]) -> DataFrame:
    """Files that hold one JSON array each; their elements are found over all splits.

    The elements are written as lines once, since the payload keeps fields
    outside the contract and those have to be known first; values keep their text.
    """
    return _placed(splits.json_rows(spark, path, JSON_OPTIONS), fields)


def office_records(spark: SparkSession, path: str | list[str], fields: list[str]) -> DataFrame:
    """First sheet of workbooks or first table of documents, one file per task."""
    rows = office.table_rows(spark, path)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in fields])
    return rows.withColumn("_record", F.from_json("raw_json", schema)).select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("source_file"),
        F.col("path").alias("_file"),
        F.lit(0).cast("bigint").alias("_block"),
        F.col("row_number").alias("_seq"),
        "raw_json",
        *[F.col(f"_record.{name}").alias(name) for name in fields],
    )


READERS = {
    ".csv": csv_records,
    ".json": json_array_records,
    ".txt": jsonl_records,
    ".xlsx": office_records,
    ".docx": office_records,
}


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Paths, names and lengths of the files in a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .load(folder)
        .select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "length")
    )


def missing_files(spark: SparkSession, folder: str, required: tuple[str, ...]) -> DataFrame:
    """Required file names that the folder lacks."""
    wanted = spark.createDataFrame([(name,) for name in required], "name string")
    return wanted.join(list_files(spark, folder).select("name"), "name", "left_anti")


def read_records(
    spark: SparkSession, suffix: str, path: str | list[str], fields: list[str], quoted_newlines: bool = True
) -> DataFrame:
    """Records of files with one suffix; CSV whose quotes hold no line breaks takes one pass less."""
    if suffix == ".csv":
        return csv_records(spark, path, fields, quoted_newlines=quoted_newlines)
    return READERS[suffix](spark, path, fields)


def landing_records(
    spark: SparkSession, folder: str, allowed: tuple[str, ...], fields: list[str], quoted_newlines: bool = True
) -> DataFrame:
    """Union of all allowed files in a folder, each read by its suffix.

    A landing name may also be a directory of shards, which count as one file
    in path order.
    """
    present = [name for name in sorted(allowed) if exists(spark, f"{folder}/{name}")]
    if not present:
        raise FileNotFoundError(f"no supported landing file in {folder}")
    parts = [
        read_records(spark, name[name.rindex("."):], f"{folder}/{name}", fields, quoted_newlines).withColumn(
            "source_file", F.lit(name)
        )
        for name in present
    ]
    return reduce(lambda left, right: left.unionByName(right), parts)
