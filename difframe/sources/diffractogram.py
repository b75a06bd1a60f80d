"""Measured scans from text files: three columns (.xye) or two with decimal commas (.asc)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Fewest points of a scan.
MIN_POINTS = 10


def parse_lines(files: DataFrame) -> DataFrame:
    """``scan_id, i, tth, iobs, sigma`` from ``path, value`` (the whole text of a file).

    Files ending in .asc have decimal commas and two columns; others have up to three.  Blank lines, comments (#),
    lines of fewer than two fields and lines that aren't numbers are skipped.  A missing or non-positive sigma is the
    root of the counts, at least 1.  Points are numbered by angle, equal angles by line.
    """
    line = files.select(F.col("path").alias("scan_id"), F.posexplode(F.split("value", r"\r\n|\r|\n")).alias("at", "line"))
    asc = F.lower("scan_id").endswith(".asc")
    text = F.trim(F.when(asc, F.translate("line", ",", ".")).otherwise(F.col("line")))
    f = F.split(text, r"\s+")
    num = lambda i: F.try_element_at(F.col("f"), F.lit(i)).try_cast("double")
    rows = line.select("scan_id", "at", asc.alias("asc"), text.alias("text"), f.alias("f")).where(~F.col("text").startswith("#") & (F.size("f") >= 2))
    rows = rows.select("scan_id", "at", num(1).alias("tth"), num(2).alias("iobs"), F.when(~F.col("asc"), num(3)).alias("s"), (F.col("asc") | (F.size("f") < 3) | num(3).isNotNull()).alias("ok"))
    rows = rows.where("ok AND tth IS NOT NULL AND iobs IS NOT NULL")
    sigma = F.when(F.col("s") > 0, F.col("s")).otherwise(F.sqrt(F.greatest("iobs", F.lit(1.0))))
    order = F.row_number().over(Window.partitionBy("scan_id").orderBy("tth", "at")) - 1
    return rows.select("scan_id", order.alias("i"), "tth", "iobs", sigma.alias("sigma"))


def read_scans(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The points of all scan files under ``paths``."""
    files = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return parse_lines(files)


def short_scans(files: DataFrame) -> DataFrame:
    """``scan_id, n_points`` of files with too few points to be a scan."""
    n = files.select(F.col("path").alias("scan_id")).distinct().join(parse_lines(files).groupBy("scan_id").agg(F.count(F.lit(1)).alias("n_points")), "scan_id", "left")
    return n.select("scan_id", F.coalesce("n_points", F.lit(0)).alias("n_points")).where(F.col("n_points") < MIN_POINTS)
