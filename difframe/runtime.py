"""Session helpers shared by every operator: table access, the shared folder, size-checked broadcasts."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when it is measured to hold at most this many rows and this many bytes (as JSON text).
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20

_STAGED: dict[str, None] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``).

    Only a local master may do without: it gets a folder of its own.  On a cluster an unset folder is an error, since
    a machine's own folder would lose what is written there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` once as parquet into the shared folder and reads it back.

    It cuts the lineage: a lost executor costs a re-read of files every executor can reach, not a recomputation.
    ``unstage`` deletes a table that nothing reads any more; the rest goes with ``clear_staged``, at the latest when
    the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/difframe-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _STAGED:
        atexit.unregister(clear_staged)
        atexit.register(clear_staged)
    _STAGED[path] = None
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def _delete(path: str) -> None:
    sc = SparkContext._active_spark_context
    if sc is not None:
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def unstage(df: DataFrame) -> None:
    """Deletes the table behind a DataFrame that ``staged`` returned."""
    path = getattr(df, "_staged_at", None)
    if path in _STAGED:
        _delete(path)
        del _STAGED[path]


def clear_staged(spark: SparkSession | None = None) -> int:
    """Deletes all tables this process has staged, once no result that reads them is needed; returns how many."""
    n = len(_STAGED)
    for path in list(_STAGED):
        _delete(path)
        del _STAGED[path]
    return n


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is measured to have at most ``rows`` rows and ``size`` bytes; the measure stops after ``rows + 1``
    rows.  ``df`` should be cheap to read (a staged or tiny table)."""
    n, b = df.limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0))).first()
    return n <= rows and b <= size


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if ``is_small``, else as it is (the join shuffles, AQE splits hot keys)."""
    return F.broadcast(df) if is_small(df, rows, size) else df
