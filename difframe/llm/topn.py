"""The N best rows of every group, by descending score bands.

The leading order column is cut into bands at quantiles taken over all rows.  Bands are worked from the best one
down: a band is a range of the raw column, so the scan skips row groups outside it; rows of groups that are already
full are anti-joined away before anything is shuffled or ranked; within a band an exact tie ranking gives the open
places.  Ranking inside a band keeps at most N distinct rows of a group per task *before* the shuffle (Spark's
WindowGroupLimit), so a group with a third of all rows sends N rows per task and no more.  Copies of one row combine in
their tasks before that, so a row repeated a billion times is one row per task and then one row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from difframe.runtime import is_small, staged

#: Shares of the rows above the band boundaries: most groups fill in the first band.
BAND_SHARES = (0.3,)
#: Full groups, those of most rows first, whose rows are dropped before the shuffle; the sent table has their keys only
#: (if these are wide, fewer of them).  Rows of further full groups fall after it, when the open places are counted.
SENT_GROUPS, SENT_WIDE_GROUPS = 500_000, 10_000


def top_n_per_group(
    df: DataFrame,
    group: list[str],
    score: str,
    ties: list[Column],
    n: int,
    keep: list[str],
    shares: tuple[float, ...] = BAND_SHARES,
    tie_columns: list[str] | None = None,
) -> DataFrame:
    """The first ``n`` distinct rows of every ``group`` by ``score`` descending (nulls last), then by ``ties``.

    ``score`` is numeric, a date or a timestamp; ``ties`` are ordered columns (``F.col("x").asc()``) that, with
    ``group`` and ``score``, tell different rows apart; ``keep`` are the result's columns.  ``tie_columns`` names the
    columns that ``ties`` read: with it copies of a row combine before any of them is ranked or sent; without it they
    combine after the ranking, which gives the same rows.

    Defined results: rows equal in all columns used count once; a null score ranks behind every other; NaN ranks
    above every number; null group keys form one group; groups of fewer than ``n`` rows come out whole; an empty table gives an empty
    table.  Columns outside ``group``, ``score``, ``ties`` and ``keep`` are never read.
    """
    used = list(dict.fromkeys([*group, score, *keep]))
    place, have = "__place", "__have"
    s = F.col(score)
    cuts = df.select(F.percentile_approx(s, [1 - x for x in shares], F.lit(10_000)).alias("c")).first()["c"] or []
    cuts = sorted({c for c in cuts if c is not None and c == c}, reverse=True)
    order = Window.partitionBy(*group).orderBy(s.desc_nulls_last(), *ties)

    at = [F.lit(c).cast(df.schema[score].dataType) for c in cuts]
    bands = [(s >= low) if i == 0 else (s >= low) & (s < at[i - 1]) for i, low in enumerate(at)]
    bands.append((s < at[-1]) | s.isNull() if at else F.lit(True))

    alias = [F.col(g).alias(f"__{g}") for g in group]
    on = reduce(lambda x, y: x & y, [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group])
    kept: list[DataFrame] = []
    for i, band in enumerate(bands):
        rows = df.where(band)
        if kept:
            so_far = reduce(DataFrame.unionByName, kept).groupBy(*group).agg(F.count(F.lit(1)).cast("int").alias(have)).select(*alias, have)
            rows = rows.join(F.broadcast(_largest(df, group, so_far.where(F.col(have) >= n).drop(have), on)), on, "left_anti")
        if tie_columns is not None:
            rows = rows.select(*dict.fromkeys([*used, *tie_columns])).distinct()
        top = rows.withColumn(place, F.dense_rank().over(order)).where(F.col(place) <= n).select(*used, place).distinct()
        if kept:
            top = top.join(so_far, on, "left").where(F.col(place) + F.coalesce(F.col(have), F.lit(0)) <= n)
        kept.append(staged(top.select(*used), f"band{i}"))
    return reduce(DataFrame.unionByName, kept).select(*keep)


def _largest(df: DataFrame, group: list[str], full: DataFrame, on: Column) -> DataFrame:
    """The full groups whose keys are sent: all, or the ``SENT_GROUPS`` of most rows, or ``SENT_WIDE_GROUPS``, or none."""
    if is_small(full, SENT_GROUPS):
        return full
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"))
    keys = staged(sizes.join(full, on, "left_semi").orderBy(F.desc("__n"), *group).limit(SENT_GROUPS).select("__n", *[F.col(g).alias(f"__{g}") for g in group]), "full-groups")
    most = (keys, keys.orderBy(F.desc("__n")).limit(SENT_WIDE_GROUPS))
    return next((k for k in most if is_small(k, SENT_GROUPS)), keys.limit(0)).drop("__n")
