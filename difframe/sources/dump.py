"""Tab-separated table dumps: \\N is null, backslashes escape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from difframe.sources.ddl import read_ddl


def _unescaped(c: Column) -> Column:
    """Text of an escaped field; a doubled backslash is kept apart while the others are read."""
    mark = "\x00"
    c = F.replace(c, F.lit("\\\\"), F.lit(mark))
    for code, char in (("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r"), ("\\b", "\b"), ("\\f", "\f"), ("\\v", "\x0b")):
        c = F.replace(c, F.lit(code), F.lit(char))
    c = F.regexp_replace(c, r"\\(.)", "$1")
    return F.replace(c, F.lit(mark), F.lit("\\"))


def parse_dump(lines: DataFrame, schema: T.StructType, line: str = "value") -> DataFrame:
    """Typed rows and ``reason``: null, ``column_count`` or the first column whose value doesn't fit its type."""
    f = F.split(F.col(line), "\t", -1)
    raw = lines.select(F.transform(f, lambda x: F.when(x != "\\N", _unescaped(x))).alias("__f"))
    enough = F.size("__f") == len(schema.fields)
    text = [F.try_element_at("__f", F.lit(i + 1)) for i in range(len(schema.fields))]
    typed = [t.try_cast(x.dataType) if not isinstance(x.dataType, T.StringType) else t for t, x in zip(text, schema.fields, strict=True)]
    reason = F.when(~enough | F.col("__f").isNull(), "column_count")
    for t, v, x in zip(text, typed, schema.fields, strict=True):
        reason = reason.when(t.isNotNull() & v.isNull(), x.name)
    return raw.select(*[v.alias(x.name) for v, x in zip(typed, schema.fields, strict=True)], reason.alias("reason"))


def read_dump(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, refused rows with reasons) of a dump file."""
    rows = parse_dump(spark.read.text(path), schema)
    return rows.where("reason IS NULL").drop("reason"), rows.where("reason IS NOT NULL")


def load_if_empty(target: DataFrame | None, rows: DataFrame) -> DataFrame:
    """``rows`` unless the target already holds any: a repeated initial load changes nothing."""
    return rows if target is None or target.isEmpty() else target


def read_schemas(spark: SparkSession, path: str) -> tuple[dict[str, T.StructType], dict[str, list[str]]]:
    """(schemas, primary keys) by table from the table definitions of a MySQL dump's text files: what ``read_dump`` and
    incremental loads need.  Definitions are small; data files do not belong to ``path``."""
    texts = [r["value"] for r in spark.read.text(path, wholetext=True).collect()]
    tables = {name: t for text in texts for name, t in read_ddl(text).items()}
    return {n: t.schema for n, t in tables.items()}, {n: t.primary_key for n, t in tables.items()}
