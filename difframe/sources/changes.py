"""Change feeds: listings of a folder, compared; the log of loaded revisions; dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path, length, modified`` of files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """``path, change`` (added, changed, removed) between two listings."""
    b = before.select("path", F.struct("length", "modified").alias("b"))
    a = after.select("path", F.struct("length", "modified").alias("a"))
    change = F.when(F.col("b").isNull(), "added").when(F.col("a").isNull(), "removed").when(F.col("a") != F.col("b"), "changed")
    return b.join(a, "path", "full").select("path", change.alias("change")).where("change IS NOT NULL")


def tables_of(changes: DataFrame, folder: str = "mysql") -> DataFrame:
    """Distinct table names of changed dump files (.sql, .txt) in a folder."""
    name = F.regexp_extract("path", rf"{folder}/([^/]+)\.(?:sql|txt)$", 1)
    return changes.where("change <> 'removed'").select(name.alias("table_name")).where("table_name <> ''").distinct()


def revision_row(spark: SparkSession, revision: int, tables: list[str], notes: str | None = None) -> DataFrame:
    """One row for the log of loaded revisions."""
    return spark.createDataFrame([(revision, tables, notes)], "svn_revision int, tables_done array<string>, notes string").withColumn("synced_at", F.current_timestamp())


def last_revision(log: DataFrame) -> int | None:
    """The revision of the latest entry; None for an empty log."""
    row = log.agg(F.max_by("svn_revision", F.struct("synced_at", "svn_revision")).alias("r")).first()
    return row["r"]


def failure_rows(results: DataFrame) -> DataFrame:
    """Dead letters of a run's results (``cod_id, status, error_msg``): TIMEOUT if the message says so, else FAILED."""
    bad = results.where("status = 'error'")
    return bad.select("cod_id", F.when(F.contains("error_msg", F.lit("TimeoutError")), "TIMEOUT").otherwise("FAILED").alias("status"), "error_msg")
