"""Changes between full snapshots, by comparing hash trees.

The rows of a snapshot are put into hash ranges of their key (the leaves), each leaf has a digest of its rows, each
inner node a digest of its children.  Consecutive snapshots are compared from the root down: below a node whose
digests agree nothing is looked at, and only rows of differing leaves are compared one by one.  Digests are XORs of
128 bits per row, so they combine on the map side and do not depend on row order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from difframe.runtime import small, staged

#: Rows a leaf should hold on average; a leaf is the unit in which rows are read again.
LEAF_ROWS = 8
#: Children of an inner node, as bits.
FANOUT_BITS = 6


def _marked(df: DataFrame, cols: list[str]) -> list[Column]:
    # xxhash64 skips nulls, so each column is joined by a mark of its own being null; nested values by their JSON text.
    plain = lambda c: F.col(c) if isinstance(df.schema[c].dataType, T.AtomicType) else F.to_json(F.struct(F.col(c).alias("v")), {"ignoreNullFields": "false"})
    return [x for c in cols for x in (plain(c), F.col(c).isNull())]


def row_digest(df: DataFrame, cols: list[str]) -> tuple[Column, Column]:
    """Two independent 64-bit digests of a row; null equals null, 0.0 equals -0.0, texts count exactly."""
    marked = _marked(df, cols)
    return F.xxhash64(F.lit(1), *marked), F.xxhash64(F.lit(2), *reversed(marked))


def current_rows(df: DataFrame, snapshot: str, key: str, version: str, ignore: list[str]) -> DataFrame:
    """One row per snapshot and key: the one of the greatest ``version`` (nulls lowest, equal ones by digest)."""
    cols = sorted(c for c in df.columns if c not in {snapshot, key, version, *ignore})
    d1, d2 = row_digest(df, cols)
    rows = df.where(F.col(snapshot).isNotNull()).select(F.col(snapshot).alias("s"), F.col(key).alias("k"), F.struct(F.col(version).alias("v"), d1.alias("d1"), d2.alias("d2")).alias("r"))
    return rows.groupBy("s", "k").agg(F.max("r").alias("r")).select("s", "k", "r.d1", "r.d2")


def snapshot_changes(df: DataFrame, snapshot: str, key: str, version: str, ignore: list[str], leaf_rows: int = LEAF_ROWS, fanout_bits: int = FANOUT_BITS) -> DataFrame:
    """``snapshot, key, change`` (added, removed, changed) for each snapshot against the next smaller one that occurs.

    ``version`` decides between several rows of a key in one snapshot; ``ignore`` are columns that are no content.

    Defined results: rows delivered late count for the snapshot they name; rows without a snapshot number are left
    out; a null key is a key; repeated rows count once; a snapshot is compared with the one before it even if numbers
    are skipped; the first snapshot, a single snapshot and an empty table give no rows.
    """
    hash_bits = F.xxhash64(F.lit(3), F.col("k"), F.col("k").isNull())
    rows = staged(current_rows(df, snapshot, key, version, ignore), "snapshot-rows")
    sizes = rows.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    # One row per delivery: a handful, so one task orders them.
    order = staged(sizes.select(F.lag("s").over(Window.orderBy("s")).alias("before"), F.col("s").alias("now"), F.max("n").over(Window.partitionBy()).alias("n")), "snapshot-order")
    most = (order.select("n").first() or [0])[0]
    levels = 1
    while (1 << (fanout_bits * levels)) * leaf_rows < most and (levels + 1) * fanout_bits <= 62:
        levels += 1
    leaf = F.shiftrightunsigned(hash_bits, 64 - fanout_bits * levels)
    digest = [F.bit_xor("d1").alias("d1"), F.bit_xor("d2").alias("d2"), F.sum("n").alias("n")]
    leaves = staged(rows.groupBy("s", leaf.alias("node")).agg(F.bit_xor(F.xxhash64("k", "d1")).alias("d1"), F.bit_xor(F.xxhash64("d2", "k")).alias("d2"), F.count(F.lit(1)).alias("n")), "snapshot-leaves")
    tree = [leaves]
    for _ in range(levels):
        tree.insert(0, tree[0].groupBy("s", F.shiftright("node", fanout_bits).alias("node")).agg(*digest))
    pairs = small(order.where(F.col("before").isNotNull()).select("before", "now"))

    def sides(t: DataFrame, *cols: str) -> DataFrame:
        """Each row once as the later and once as the earlier side of a pair of snapshots."""
        now = t.join(pairs.select(F.col("now").alias("s"), F.col("now").alias("pair")), "s").withColumn("later", F.lit(True))
        before = t.join(pairs.select(F.col("before").alias("s"), F.col("now").alias("pair")), "s").withColumn("later", F.lit(False))
        return now.unionByName(before).select("pair", "later", *cols)

    differing: DataFrame | None = None
    for level, nodes in enumerate(tree):
        both = sides(nodes, "node", "d1", "d2", "n")
        if differing is not None:
            above = small(differing.select("pair", F.col("node").alias("up")))
            both = both.withColumn("up", F.shiftright("node", fanout_bits)).join(above, ["pair", "up"], "left_semi")
        # A node differs if one side lacks it or the digests differ.
        whole = both.groupBy("pair", "node").agg(F.count(F.lit(1)).alias("c"), *[F.min(x).alias(f"lo_{x}") for x in ("d1", "d2", "n")], *[F.max(x).alias(f"hi_{x}") for x in ("d1", "d2", "n")])
        same = reduce(lambda a, b: a & b, [F.col(f"lo_{x}") == F.col(f"hi_{x}") for x in ("d1", "d2", "n")])
        differing = staged(whole.where((F.col("c") < 2) | ~same).select("pair", "node"), f"snapshot-level{level}")

    suspects = sides(rows.withColumn("node", leaf), "node", "k", "d1", "d2").join(small(differing), ["pair", "node"], "left_semi")
    side = lambda later: F.max(F.when(F.col("later") == later, F.struct("d1", "d2")))
    compared = suspects.groupBy("pair", "k").agg(side(True).alias("now"), side(False).alias("before"))
    change = F.when(F.col("before").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("now") != F.col("before"), "changed")
    return compared.select(F.col("pair").alias(snapshot), F.col("k").alias(key), change.alias("change")).where("change IS NOT NULL")
