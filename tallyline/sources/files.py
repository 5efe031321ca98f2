"""Batch readers. Raw files are read as text only; types come in when records are conformed."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def string_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_batch_csv(spark: SparkSession, path: str | list[str], columns: Iterable[str] | None = None) -> DataFrame:
    """CSV with a header, every column a string.

    Give ``columns`` for large loads: with a schema Spark does not open files on the driver to
    learn their header. Point ``path`` at the files (``.../batch_date=*/*.csv``) so that the
    directory name does not turn into a column and change the record hash.
    """
    reader = spark.read.option("header", True)
    if columns is not None:
        reader = reader.schema(string_schema(columns)).option("enforceSchema", False)
    return reader.csv(path)


#: What a checked reader adds: why a line could not be parsed (NULL if it could), and the line itself then.
PARSE_ERROR, RAW_LINE = "parse_error", "raw_line"
BAD_QUOTE, TOO_FEW, TOO_MANY, NOT_JSON = "bad_quote", "too_few_fields", "too_many_fields", "not_a_json_object"
_LINE = "_line"


def _csv_error(line: Column, fields: int, sep: str) -> Column:
    """Why a line does not split into so many fields, by its quotes and separators.

    Escaped characters and well-quoted fields are taken out first; a field that still starts with a quote
    is not closed, or goes on behind its closing quote.
    """
    cut = re.escape(sep)
    bare = F.regexp_replace(line, r"\\.", "")
    bare = F.regexp_replace(F.regexp_replace(bare, '""', ""), f'(^|{cut})"[^"]*"(?={cut}|$)', "$1")
    bare = F.when(line.contains('"'), bare).otherwise(line)
    found = F.length(bare) - F.length(F.replace(bare, F.lit(sep))) + 1
    return (
        F.when(line.contains('"') & bare.rlike(f'(^|{cut})"'), BAD_QUOTE).when(found < fields, TOO_FEW).when(found > fields, TOO_MANY)
    )


def read_checked_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str], sep: str = ",") -> DataFrame:
    """``read_batch_csv`` that tells broken lines apart: ``columns``, ``parse_error`` and ``raw_line``.

    A line with a quote that does not close, or with too few or too many fields, has a reason, its whole
    text and no values; other lines have neither reason nor text. Every line of a file but the header and
    blank ones comes out once, so counts add up. A record is a line. The files are read once.
    """
    # one column up to the end of the line; the reader leaves out the headers
    lines = spark.read.schema(f"{_LINE} string").option("header", True).option("sep", "\u0001").option("quote", "").option("escape", "").csv(path)
    error = _csv_error(F.col(_LINE), len(columns), sep)
    places = string_schema(f"_{i}" for i in range(len(columns)))  # headers may repeat a name
    record = F.from_csv(F.when(error.isNull(), F.col(_LINE)), places.simpleString()[len("struct<") : -1].replace(":", " "), {"sep": sep})
    parsed = lines.select(_LINE, error.alias(PARSE_ERROR), record.alias("_record"))
    values = [F.col(f"_record._{i}").alias(c) for i, c in enumerate(columns)]
    return parsed.select(*values, PARSE_ERROR, F.when(F.col(PARSE_ERROR).isNotNull(), F.col(_LINE)).alias(RAW_LINE))


def read_checked_json(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """``read_json`` that tells broken lines apart; see ``read_checked_csv``. Fields beside ``columns`` are left out."""
    lines = spark.read.text(path).where(F.trim("value") != "").withColumnRenamed("value", _LINE)
    schema = string_schema([*columns, _LINE])
    record = F.from_json(_LINE, schema, {"columnNameOfCorruptRecord": _LINE})
    parsed = lines.select(_LINE, record.alias("_record"))
    broken = F.col("_record").isNull() | F.col(f"_record.{_LINE}").isNotNull()
    values = [F.when(~broken, F.col(f"_record.`{c}`")).alias(c) for c in columns]
    return parsed.select(*values, F.when(broken, NOT_JSON).alias(PARSE_ERROR), F.when(broken, F.col(_LINE)).alias(RAW_LINE))


def malformed(checked: DataFrame) -> DataFrame:
    """The broken lines of a checked read or of what was stored from one, with their reason and what else was added."""
    return checked.where(F.col(PARSE_ERROR).isNotNull())


def well_formed(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(PARSE_ERROR).isNull()).drop(PARSE_ERROR, RAW_LINE)


def read_json(spark: SparkSession, path: str | list[str], columns: Iterable[str]) -> DataFrame:
    """JSON lines with every named field kept as text."""
    return spark.read.schema(string_schema(columns)).json(path)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A layer table: Parquet when given a path, otherwise a table of the session catalog.

    Files written with added columns are merged on read.
    """
    if "/" in name_or_path:
        return spark.read.option("mergeSchema", True).parquet(name_or_path)
    return spark.table(name_or_path)


def read_labels(spark: SparkSession, path: str, keys: Iterable[str], label: str = "expected_match") -> DataFrame:
    """Labelled pairs whose label is the text TRUE or FALSE."""
    return read_batch_csv(spark, path, [*keys, label]).withColumn(label, F.col(label) == F.lit("TRUE"))
