"""Sinks: pattern results and failures, JSON lines, fingerprint tables; one batch or continuously."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from difframe.operators.relational import insert_new, upsert
from difframe.operators.search import LINES, LOG_D_BIN, fingerprints
from difframe.sources.changes import failure_rows


def append_jsonl(results: DataFrame, path: str, columns: list[str]) -> None:
    """Appends ``columns`` of every result as JSON lines."""
    results.select(*columns).write.mode("append").json(path)


def settle(results: DataFrame, patterns: DataFrame, failures: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(patterns, failures) after a run: new patterns by ``keys`` (the first write wins), failures by structure (the
    last one wins).  ``results`` has ``status`` ok or error beside the columns of both."""
    good = results.where("status = 'ok'").select(*patterns.columns)
    bad = failure_rows(results).withColumn("failed_at", F.current_timestamp()).select(*failures.columns)
    return insert_new(patterns, good.dropDuplicates(keys), keys), upsert(failures, bad.dropDuplicates(["cod_id"]), ["cod_id"])


def result_stream(results: DataFrame, path: str, checkpoint: str, seconds: int = 60) -> StreamingQuery:
    """Writes a stream of results as parquet, at the latest every ``seconds`` seconds also when few arrive."""
    return results.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()


def write_fingerprints(patterns: DataFrame, path: str, lines: int = LINES) -> None:
    """Rebuilds the fingerprint table as a whole, range-partitioned by spacing: a search window reads few files, and
    row-group statistics skip the rest."""
    prints = fingerprints(patterns, lines).withColumn("d_bin", F.floor(F.log("d_hkl") / LOG_D_BIN).cast("int"))
    prints.repartitionByRange("d_bin", "d_hkl").sortWithinPartitions("d_bin", "d_hkl").write.mode("overwrite").parquet(path)


def progress(spark: SparkSession, done: DataFrame, failed: DataFrame, total: int, seconds: float) -> DataFrame:
    """``n_ok, n_failed, rate, eta_s`` of a run."""
    n = done.agg(F.count(F.lit(1)).alias("n_ok")).join(F.broadcast(failed.agg(F.count(F.lit(1)).alias("n_failed"))))
    rate = (F.col("n_ok") + F.col("n_failed")) / F.lit(float(max(seconds, 1e-9)))
    return n.withColumn("rate", rate).withColumn("eta_s", F.try_divide(F.lit(float(total)) - F.col("n_ok") - F.col("n_failed"), F.col("rate")))
