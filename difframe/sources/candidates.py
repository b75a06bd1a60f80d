"""Candidate phases from CSV with a JSON column, sample lists, and reflections kept as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REFLECTIONS = "array<struct<h:int,k:int,l:int,d_hkl:double,two_theta:double,multiplicity:int,F_sq:double,intensity_rel:double>>"


def parse_reflections(text) -> Column:
    """Reflections from JSON text; a text torn by a blank inside a number is mended and read again; else null."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.from_json(c, REFLECTIONS), F.from_json(F.regexp_replace(c, r"(\d) (\d)", "$1$2"), REFLECTIONS))


def read_candidates(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(candidates ``cod_id, peak_matches, reflections``, refused rows) of a CSV with header.

    Rows whose reflections stay unreadable are refused, not loaded half.
    """
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    missing = {"cod_id", "reflections"} - set(raw.columns)
    if missing:
        raise ValueError(f"columns missing: {sorted(missing)}")
    matches = F.col("peak_matches").try_cast("int") if "peak_matches" in raw.columns else F.lit(0)
    rows = raw.select(F.col("cod_id").try_cast("int").alias("cod_id"), F.coalesce(matches, F.lit(0)).alias("peak_matches"), parse_reflections("reflections").alias("reflections"), F.col("reflections").alias("text"))
    good = F.col("cod_id").isNotNull() & F.col("reflections").isNotNull()
    return rows.where(good).drop("text"), rows.where(~good)


def read_samples(spark: SparkSession, path: str, n: int, seed: int = 42) -> DataFrame:
    """A seeded sample of ``n`` rows of a semicolon-separated list ``n_reflections;min`` (the second is the cod_id)."""
    rows = spark.read.csv(path, header=True, sep=";").select(F.col("min").try_cast("int").alias("cod_id"), F.col("n_reflections").try_cast("int").alias("n_reflections")).where("cod_id IS NOT NULL")
    return rows.orderBy(F.xxhash64(F.lit(seed), "cod_id"), "cod_id").limit(n)
