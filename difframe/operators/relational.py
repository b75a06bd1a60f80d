"""Relational building blocks: latest rows, ranked rows, range joins, resume-safe anti-joins, upserts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from difframe.runtime import small


def best_row(df: DataFrame, keys: list[str], order: list[str], keep: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order`` (nulls lowest, earlier columns first; ``-x`` orders x ascending).

    An aggregate, not a window: rows combine before the shuffle, so a hot key costs one row per task.
    """
    by = [(-F.col(c[1:])).alias(f"o{i}") if c.startswith("-") else F.col(c).alias(f"o{i}") for i, c in enumerate(order)]
    top = df.groupBy(*keys).agg(F.max_by(F.struct(*keep), F.struct(*by)).alias("__r"))
    return top.select(*keys, "__r.*")


def top_ranked(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of every key with their rank; ``order`` should be total.  Spark prunes before the shuffle."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= n)


def first_seen(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of every key in visiting order."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__r")).select(*keys, "__r.*")


def range_join(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, width: float, bin_by: Callable[[Column], Column] | None = None) -> DataFrame:
    """All pairs with ``low <= point <= high``: an equi-join on bins of ``width`` instead of a nested loop.

    Each range goes to the bins it touches, so ``width`` should be near a typical range; ``bin_by``, an increasing
    function, makes ranges that grow with their position alike (a logarithm for relative widths).  The ranges are
    broadcast only when they are measured to be small; otherwise both sides shuffle by bin and AQE splits hot bins.  Null
    points and empty ranges match nothing.
    """
    place = bin_by or (lambda c: c)
    bin_of = lambda c: F.floor(place(F.col(c)) / F.lit(width)).cast("long")
    cut = ranges.where(F.col(low) <= F.col(high)).withColumn("__bin", F.explode(F.sequence(bin_of(low), bin_of(high))))
    own = points.where(F.col(point).isNotNull()).withColumn("__bin", bin_of(point))
    return own.join(small(cut), "__bin").where(F.col(point).between(F.col(low), F.col(high))).drop("__bin")


def by_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in the first column of ``ids``: an IN-list of any length.  Null and repeated ids
    add nothing (they combine before the shuffle), an empty list gives no rows."""
    return df.join(ids.select(F.col(ids.columns[0]).alias(key)).distinct(), key, "left_semi").select(*df.columns)


def next_jobs(jobs: DataFrame, size: str, key: str, limit: int | None = None) -> DataFrame:
    """Jobs from small to large by their estimated ``size`` (a missing one is 0), then by ``key``; the first ``limit``."""
    ordered = jobs.orderBy(F.coalesce(F.col(size), F.lit(0)), key)
    return ordered if limit is None else ordered.limit(limit)


def pending(jobs: DataFrame, done: list[DataFrame], keys: list[str]) -> DataFrame:
    """Jobs that none of ``done`` holds (by ``keys``): what a run still has to do, also after a restart."""
    return reduce(lambda a, d: a.join(d.select(*keys).distinct(), keys, "left_anti"), done, jobs)


def upsert(base: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """``base`` with the rows of ``delta`` put in by ``keys``: the last write wins; nothing is deleted."""
    return base.join(delta.select(*keys).distinct(), keys, "left_anti").select(*base.columns).unionByName(delta)


def insert_new(base: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """``base`` plus rows of ``delta`` with new keys: the first write wins."""
    return base.unionByName(delta.join(base.select(*keys).distinct(), keys, "left_anti").select(*base.columns))


def replace_groups(base: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """``base`` in which every group that ``delta`` mentions is replaced as a whole."""
    return base.join(delta.select(*keys).distinct(), keys, "left_anti").select(*base.columns).unionByName(delta)


def size_tier(n, missing: int = 0) -> Column:
    """SMALL up to 500 lines, MEDIUM up to 2000, else LARGE; a missing estimate counts as ``missing``."""
    c = F.coalesce(F.col(n) if isinstance(n, str) else n, F.lit(missing))
    return F.when(c <= 500, "SMALL").when(c <= 2000, "MEDIUM").otherwise("LARGE")
