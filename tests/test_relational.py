import random
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from difframe.operators import relational as rel
from difframe.operators.search import match_phases, peak_windows, prefilter
from difframe.streaming.upsert import BUCKET, stored, upsert_buckets, upsert_stream


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_best_row_and_first_seen(spark):
    df = spark.createDataFrame([(1, 5, 1, "a"), (1, 7, 2, "b"), (1, 7, 1, "c"), (2, None, 9, "d"), (None, 1, 1, "e")], "k int, o int, id int, v string")
    assert _rows(rel.best_row(df, ["k"], ["o", "-id"], ["v"])) == _rows(spark.createDataFrame([(1, "c"), (2, "d"), (None, "e")], "k int, v string"))
    assert _rows(rel.first_seen(df.select("k", "id", "v"), ["k"], ["id", "v"])) == [(1, 1, "a"), (2, 9, "d"), (None, 1, "e")]
    assert rel.best_row(df.limit(0), ["k"], ["o"], ["v"]).count() == 0


def test_range_join_equals_nested_loop(spark):
    rnd = random.Random(0)
    p = spark.createDataFrame([(i, rnd.uniform(-2, 2)) for i in range(300)] + [(900, None)], "i int, x double")
    w = spark.createDataFrame([(j, a := rnd.uniform(-2, 2), a + rnd.choice([0.0, 0.01, 0.3, -0.1])) for j in range(60)] + [(99, None, 1.0)], "j int, lo double, hi double")
    got = _rows(rel.range_join(p, w, "x", "lo", "hi", 0.05).select("i", "j"))
    want = sorted(((a.i, b.j) for a in p.collect() for b in w.collect() if None not in (a.x, b.lo) and b.lo <= a.x <= b.hi), key=str)
    assert got == want
    plan = rel.range_join(p, w, "x", "lo", "hi", 0.05)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_upserts(spark):
    kind = "k int, g string, v int"
    base, delta = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 3)], kind), spark.createDataFrame([(2, "a", 20), (4, "c", 40)], kind)
    up = rel.upsert(base, delta, ["k"])
    assert _rows(up) == [(1, "a", 1), (2, "a", 20), (3, "b", 3), (4, "c", 40)]
    assert _rows(rel.upsert(up, delta, ["k"])) == _rows(up)
    assert _rows(rel.insert_new(base, delta, ["k"])) == [(1, "a", 1), (2, "a", 2), (3, "b", 3), (4, "c", 40)]
    assert _rows(rel.replace_groups(base, delta, ["g"])) == [(2, "a", 20), (3, "b", 3), (4, "c", 40)]
    assert _rows(rel.pending(base, [delta, base.where("k = 3")], ["k"])) == [(1, "a", 1)]
    tiers = {0: "SMALL", 500: "SMALL", 501: "MEDIUM", 2000: "MEDIUM", 2001: "LARGE", None: "SMALL"}
    df = spark.createDataFrame([(n,) for n in tiers], "n int")
    assert {r.n: r.t for r in df.select("n", rel.size_tier("n").alias("t")).collect()} == tiers


def test_search_counts_distinct_peaks(spark):
    peaks = spark.createDataFrame([("s", i, t) for i, t in enumerate((30.0, 30.1, 40.0, 50.0))], "scan_id string, peak_no int, two_theta double")
    w = peak_windows(peaks)
    d = {r.peak_no: (r.d_lo + r.d_hi) / 2 for r in w.collect()}
    prints = spark.createDataFrame([(1, d[0]), (1, d[2]), (1, d[2]), (1, d[3]), (2, d[2]), (2, 9.9), (3, None)], "cod_id int, d_hkl double")
    got = {r.cod_id: r.n_matched for r in match_phases(prints, w, min_matches=1).collect()}
    assert got == {1: 4, 2: 1}
    cand = prints.where("d_hkl IS NOT NULL").groupBy("cod_id").agg(F.collect_list(F.struct("d_hkl", F.lit(1.0).alias("intensity_rel"))).alias("reflections"))
    assert {r.cod_id for r in prefilter(cand, peaks, min_matches=2).collect()} == {1}
    assert match_phases(prints, w.limit(0)).count() == 0


def test_stream_is_idempotent(spark, tmp_path):
    schema = T.StructType.fromDDL("k int, rev int, v string")
    src, base, cp = (str(tmp_path / x) for x in ("in", "table", "cp"))
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(src)
    run = lambda check=cp: upsert_stream(spark, src, schema, base, ["k"], ["rev"], check).awaitTermination()
    table = lambda: _rows(stored(spark, base, schema).drop(BUCKET))
    files = lambda: {str(x) for x in (tmp_path / "table").rglob("*.parquet")}
    put([(1, 1, "a"), (2, 1, "b"), (1, 2, "c")])
    run()
    assert table() == [(1, 2, "c"), (2, 1, "b")]
    before = files()
    run()
    assert files() == before  # nothing new, nothing done
    put([(2, 5, "z"), (3, 1, "n")])
    run()
    want = [(1, 2, "c"), (2, 5, "z"), (3, 1, "n")]
    assert table() == want and len(files() & before) == 1  # the bucket of key 1 was left alone
    run(f"{cp}-{uuid.uuid4().hex}")  # everything again from the start: the same table
    assert table() == want


def test_older_rows_change_nothing(spark, tmp_path):
    base, schema = str(tmp_path / "t"), "k int, rev int, v string"
    put = lambda *rows: upsert_buckets(spark, spark.createDataFrame(rows, schema), base, ["k"], ["rev"], 4)
    assert put((1, 5, "a"), (None, 1, "n"), (1, 5, "b")) == 2 and put((1, 4, "old")) == 1 and put() == 0
    assert sorted(map(tuple, stored(spark, base, spark.createDataFrame([], schema).schema).drop(BUCKET).collect()), key=str) == [(1, 5, "b"), (None, 1, "n")]


def test_in_list_and_job_order(spark):
    df = spark.createDataFrame([(1, 9), (2, None), (3, 4), (4, 4)], "k int, n int")
    ids = spark.createDataFrame([(3,), (3,), (None,), (8,)], "x int")
    assert _rows(rel.by_ids(df, ids, "k")) == [(3, 4)] and rel.by_ids(df, ids.limit(0), "k").count() == 0
    assert [r.k for r in rel.next_jobs(df, "n", "k").collect()] == [2, 3, 4, 1] and [r.k for r in rel.next_jobs(df, "n", "k", 2).collect()] == [2, 3]
