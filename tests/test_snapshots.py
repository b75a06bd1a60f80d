import random

from difframe.operators.snapshots import snapshot_changes


def _brute(rows):
    best = {}
    for s, k, v, *content in rows:
        if s is not None and ((s, k) not in best or (v if v is not None else -1) > best[s, k][0]):
            best[s, k] = (v if v is not None else -1, content)
    order = sorted({s for s, _ in best})
    out = set()
    for before, now in zip(order, order[1:], strict=False):
        for k in {k for s, k in best if s in (before, now)}:
            a, b = best.get((before, k)), best.get((now, k))
            if a is None or b is None or a[1] != b[1]:
                out.add((now, k, "added" if a is None else "removed" if b is None else "changed"))
    return out


def _run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "s int, k int, v int, x string, y double")
    return sorted(map(tuple, snapshot_changes(df, "s", "k", "v", [], **kw).collect()), key=str)


def test_against_brute_force(spark):
    rnd = random.Random(1)
    rows = []
    for s in (3, 4, 9):
        for k in range(300):
            if rnd.random() < 0.9:
                rows.append((s, k if k else None, s * 10 + k % 3, rnd.choice(["a", "b", "", None]) if k % 5 == 0 else "same", float(k)))
    rows += [(4, 7, 1, "older", 0.0), (4, 7, None, "oldest", 0.0)] + rows[:50]
    rows += [(None, 1, 1, "lost", 1.0)]
    assert _run(spark, rows) == sorted(_brute(rows), key=str)
    assert _run(spark, rows, leaf_rows=1, fanout_bits=2) == sorted(_brute(rows), key=str)


def test_nulls_do_not_shift(spark):
    rows = [(1, 1, 1, None, 0.0), (2, 1, 1, "", 0.0), (1, 2, 1, "a", -0.0), (2, 2, 1, "a", 0.0), (1, 3, 1, None, None), (2, 3, 1, None, None)]
    assert _run(spark, rows) == [(2, 1, "changed")]


def test_empty_and_single(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(5, 1, 1, "a", 1.0)]) == []


def test_hot_leaf(spark):
    rows = [(s, 1, 1, "a", 1.0) for s in (1, 2) for _ in range(500)] + [(2, 2, 1, "b", 1.0)]
    assert _run(spark, rows) == [(2, 2, "added")]


def test_nested_values_and_clashing_names(spark):
    kind = "s int, file int, k int, pair array<int>, node map<string,int>, d1 struct<a:int,b:string>"
    rows = [(1, 1, 1, [1, None], {"x": 1}, (1, None)), (2, 1, 1, [1], {"x": 1}, (1, None)), (1, 2, 1, [None], {"x": 1}, (None, "q")), (2, 2, 1, [None], {"x": 1}, (None, "q")), (1, 3, 1, None, None, None), (2, 3, 1, [], None, None)]
    df = spark.createDataFrame(rows, kind)
    assert sorted(map(tuple, snapshot_changes(df, "s", "file", "k", []).collect())) == [(2, 1, "changed"), (2, 3, "changed")]
