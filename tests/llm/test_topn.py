import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from difframe.llm.topn import top_n_per_group

TIES = ("m", "id")


def _top(df, n=3, shares=(0.25, 0.6)):
    ties = [F.col(TIES[0]).desc_nulls_last(), F.col(TIES[1]).asc_nulls_last()]
    return sorted((tuple(r) for r in top_n_per_group(df, ["g"], "s", ties, n, ["g", "id"], shares).collect()), key=str)


def _brute(rows, n=3):
    groups = {}
    for r in set(rows):
        groups.setdefault(r[0], []).append(r)
    low = lambda x: (x is None, -x if x is not None else 0)
    return sorted(((g, r[1]) for g, v in groups.items() for r in sorted(v, key=lambda r: (low(r[2]), low(r[3]), r[1]))[:n]), key=str)


def test_equals_brute_force(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([1, 1, 1, 1, 2, 3, None, *range(10, 60)]), i, rnd.choice([None, rnd.randint(0, 20)]), rnd.choice([None, 1, 2])) for i in range(3000)]
    rows += rows[:500]
    df = spark.createDataFrame(rows, "g int, id int, s int, m int").repartition(5)
    for n, shares in ((1, (0.5,)), (3, (0.25, 0.6)), (7, (0.01, 0.1, 0.5, 0.9)), (5000, (0.3,))):
        assert _top(df, n, shares) == _brute(rows, n)


def test_copies_combine_before_they_are_ranked(spark):
    """One row holds a third of all rows: the ranking sees it once, and the result stays the same."""
    rnd = random.Random(6)
    rows = [(rnd.choice([1, 2, None]), i, rnd.choice([None, rnd.randint(0, 9)]), rnd.choice([None, 1, 2])) for i in range(400)]
    rows += [(1, 999, 30, 1)] * 200 + [(None, 998, None, None)] * 100
    df = spark.createDataFrame(rows, "g int, id int, s int, m int").withColumn("wide", F.lit("x")).repartition(5)
    ties = [F.col("m").desc_nulls_last(), F.col("id").asc_nulls_last()]
    for n in (1, 3, 50):
        got = top_n_per_group(df, ["g"], "s", ties, n, ["g", "id"], (0.25, 0.6), tie_columns=["m", "id"])
        assert sorted((tuple(r) for r in got.collect()), key=str) == _brute(rows, n)


def test_all_equal_and_all_null(spark):
    rows = [(1, i, 5, 1) for i in range(50)] + [(2, i, None, None) for i in range(50)]
    df = spark.createDataFrame(rows, "g int, id int, s int, m int")
    assert _top(df) == _brute(rows)
    assert _top(df.where("g = 2")) == [(2, 0), (2, 1), (2, 2)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "double"])
def test_score_types_and_clashing_columns(spark, kind):
    at = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, i, at + timedelta(days=i), 1, "x", 7) for i in range(9)], "g int, id int, s timestamp_ntz, m int, __place string, n int")
    s = F.col("s").cast("timestamp").cast("double") if kind == "double" else F.col("s").cast(kind)
    assert _top(df.withColumn("s", s)) == [(1, 6), (1, 7), (1, 8)]


def test_full_groups_fall_before_the_shuffle(spark, sf, monkeypatch):
    """The second band filters the raw column in the scan, and the anti-join is below the exchange."""
    from difframe.llm import topn
    from difframe.llm.queries import QUERIES

    plans = []
    real = topn.staged
    monkeypatch.setattr(topn, "staged", lambda df, label: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, label))
    QUERIES["p2_found"](spark, sf)
    lines = plans[1].splitlines()
    depth = lambda word: next(x.index(word) for x in lines if word in x)
    anti = next(i for i, x in enumerate(lines) if "LeftAnti" in x)
    assert any("Exchange hashpartitioning(cod_id" in x for x in lines[:anti]) and not any("Exchange hashpartitioning(cod_id" in x for x in lines[anti : anti + 4])
    assert "LessThan(calculated_at" in plans[1] and depth("Exchange") < depth("LeftAnti")


def test_more_full_groups_than_are_sent(spark, monkeypatch):
    from difframe.llm import topn

    monkeypatch.setattr(topn, "SENT_GROUPS", 2)
    rnd = random.Random(5)
    rows = [(rnd.choice([None, *range(9)]), i, rnd.randint(0, 20), 1) for i in range(2000)]
    df = spark.createDataFrame(rows, "g int, id int, s int, m int").repartition(3)
    assert _top(df) == _brute(rows)


def test_empty(spark):
    assert _top(spark.createDataFrame([], "g int, id int, s int, m int")) == []
