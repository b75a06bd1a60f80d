"""Continuous upserts of arriving files into a bucketed table; versioned parquet snapshots of batch loads."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from difframe.operators.relational import best_row
from difframe.runtime import staged, unstage

#: Buckets of a stored table, and their column.
BUCKETS, BUCKET = 64, "__bucket"


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, base: str) -> list[int]:
    """Finished versions below ``base``, ascending."""
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    found = []
    for s in fs.listStatus(p):
        m = re.fullmatch(r"v(\d+)", s.getPath().getName())
        done = spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")
        if m and fs.exists(done):
            found.append(int(m[1]))
    return sorted(found)


def latest(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """The newest finished version, or an empty table."""
    v = versions(spark, base)
    return spark.read.schema(schema).parquet(f"{base}/v{v[-1]}") if v else spark.createDataFrame([], schema)


def stored(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """The rows of a table in buckets, with their ``bucket``; empty if nothing is stored yet."""
    whole = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    try:
        return spark.read.schema(whole).parquet(base)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], whole)


def upsert_buckets(spark: SparkSession, delta: DataFrame, base: str, keys: list[str], order: list[str], buckets: int = BUCKETS) -> int:
    """Puts ``delta`` into the table at ``base``, which is partitioned by a hash of the keys: only buckets that hold a key
    of ``delta`` are read and written again.  Of the rows of a key the greatest by ``order`` stays, then by the other
    columns, so the same rows again, or older ones, change nothing.  Returns the number of buckets written."""
    schema = delta.schema
    rest = [c for c in schema.names if c not in keys]
    marked = staged(delta.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")), "upsert-delta")
    touched = sorted(r[0] for r in marked.select(BUCKET).distinct().collect())  # at most ``buckets``
    if touched:
        old = stored(spark, base, schema).where(F.col(BUCKET).isin(touched))
        best = [*order, *(c for c in rest if c not in order)]
        merged = staged(best_row(old.unionByName(marked), [*keys, BUCKET], best, rest).select(*schema.names, BUCKET), "upsert-merged")
        merged.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(base)
        unstage(merged)
    unstage(marked)
    return len(touched)


def upsert_stream(spark: SparkSession, source: str, schema: T.StructType, base: str, keys: list[str], order: list[str], checkpoint: str, fmt: str = "json", max_files: int = 100, trigger: dict | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Starts upserting files that arrive in ``source`` into the bucketed table at ``base`` (``upsert_buckets``).

    A repeated batch changes nothing, and offsets advance only after the write, so a failed batch is never recorded as
    loaded.  ``order`` decides between rows of a key, within a batch and against stored ones.
    """

    def write(batch: DataFrame, _: int) -> None:
        upsert_buckets(batch.sparkSession, batch, base, keys, order, buckets)

    stream = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files).load(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
