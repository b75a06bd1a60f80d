from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from difframe import incremental
from difframe.operators import catalogue as c
from difframe.plans.catalogue import QUERIES
from difframe.runtime import clear_staged, small, staged, table
from difframe.sources import sinks
from difframe.streaming.upsert import latest, versions
import difframe.plans.reference  # noqa: F401


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_functions_equal_the_registered_queries(spark):
    sf = "/root/testdata/sf0.01"
    d = table(spark, sf, "cod_data")
    assert _rows(c.quality_listing(d).select("file")) == _rows(QUERIES["catalog_quality"](spark, sf).select("file"))
    assert _rows(c.powder_structures(d).select("file", c.doi_link())) == _rows(QUERIES["catalog_powder"](spark, sf).select("file", "link"))
    assert _rows(c.by_system(d, "cubic").groupBy().count()) == _rows(QUERIES["catalog_by_system"](spark, sf).where("system = 'cubic'").select("n"))
    both = c.text_search(d, "title", "crystals structure").select("file").unionAll(c.text_search(d, "title", "powder cooling").select("file"))
    assert _rows(both) == _rows(QUERIES["title_search"](spark, sf).select("file"))


def test_names_and_links(spark):
    d = spark.createDataFrame([(1, "Quartz", None, None), (2, None, "quarTZite", None), (3, None, None, None)], "file int, mineral string, commonname string, chemname string")
    assert _rows(c.name_search(d, "QUARTZ").select("file")) == [(1,), (2,)]
    x = spark.createDataFrame([("77", 1, 0), ("78", 9, 0)], "ext_id string, cod_id int, relation_id int")
    assert _rows(c.cross_links(d, x, "https://x.org/")) == [(1, "77", "https://x.org/77")]


def test_similar_bits(spark):
    d = spark.createDataFrame([(1, 0b1111, 0), (2, 0b1110, 0), (3, 0, -1), (4, 0, 0)], "id int, a long, b long")
    got = _rows(c.similar_bits(d, d.where("id = 1").withColumnRenamed("id", "q"), ["a", "b"], 2))
    assert got == [(1, 2, 0.75), (1, 3, 0.0)]


def test_settle_and_jsonl(spark, tmp_path):
    results = spark.createDataFrame([Row(cod_id=1, wavelength=1.5, n=9, status="ok", error_msg=None), Row(cod_id=2, wavelength=1.5, n=5, status="ok", error_msg=None), Row(cod_id=3, wavelength=1.5, n=None, status="error", error_msg="TimeoutError")], "cod_id int, wavelength double, n int, status string, error_msg string")
    patterns = spark.createDataFrame([(1, 1.5, 7)], "cod_id int, wavelength double, n int")
    failures = spark.createDataFrame([(3, "FAILED", "x", None), (4, "FAILED", "y", None)], "cod_id int, status string, error_msg string, failed_at timestamp")
    p, f = sinks.settle(results, patterns, failures, ["cod_id", "wavelength"])
    assert _rows(p) == [(1, 1.5, 7), (2, 1.5, 5)]
    assert _rows(f.select("cod_id", "status")) == [(3, "TIMEOUT"), (4, "FAILED")]
    for _ in range(2):
        sinks.append_jsonl(results, str(tmp_path / "log"), ["cod_id", "n"])
    assert spark.read.json(str(tmp_path / "log")).count() == 6
    assert sinks.progress(spark, p, f, 10, 2.0).first().asDict() == {"n_ok": 2, "n_failed": 2, "rate": 2.0, "eta_s": 3.0}


def test_fingerprint_table(spark, sf, tmp_path):
    path = str(tmp_path / "prints")
    for _ in range(2):
        sinks.write_fingerprints(table(spark, sf, "reference_patterns"), path)
    assert spark.read.parquet(path).count() == QUERIES["fingerprint_top30"](spark, sf).count()


def test_incremental_updates(spark, tmp_path):
    base = str(tmp_path / "base")
    schemas = {"data": T.StructType.fromDDL("file int, v string"), "other": T.StructType.fromDDL("id int, v string")}
    keys = {"data": ["file"], "other": ["id"]}
    (tmp_path / "data.txt").write_text("1\ta\n2\tb\nx\tc\n")
    dumps = {"data": str(tmp_path / "data.txt")}
    run = lambda n, d=dumps, **kw: incremental.update(spark, d, schemas, keys, base, n, **kw)
    dry = run(5, dry_run=True)
    assert dry.loaded == ["data"] and not dry.recorded and versions(spark, f"{base}/data") == [] and incremental.loaded_revision(spark, base) is None
    first = run(5)
    assert first.recorded and first.refused_rows == {"data": 1} and _rows(latest(spark, f"{base}/data", schemas["data"])) == [(1, "a"), (2, "b")]
    assert run(5).loaded == [] and run(4).loaded == [] and versions(spark, f"{base}/data") == [1]
    (tmp_path / "data.txt").write_text("2\tB\n3\tn\n")
    failed = run(6, {**dumps, "other": str(tmp_path / "missing.txt")})
    assert "other" in failed.errors and not failed.recorded and incremental.loaded_revision(spark, base) == 5
    assert _rows(latest(spark, f"{base}/data", schemas["data"])) == [(1, "a"), (2, "B"), (3, "n")]
    again = run(6)
    assert again.recorded and _rows(latest(spark, f"{base}/data", schemas["data"])) == [(1, "a"), (2, "B"), (3, "n")]


def test_a_cluster_needs_a_shared_folder():
    import pytest

    from difframe.runtime import shared_dir

    class Context:
        master = "spark://somewhere:7077"
        getConf = lambda self: {}
        getCheckpointDir = lambda self: None

    class Session:
        conf, sparkContext = {}, Context()

    with pytest.raises(RuntimeError):
        shared_dir(Session())
    Session.conf = {"spark.checkpoint.dir": "/shared/x/"}
    assert shared_dir(Session()) == "/shared/x"


def test_cell_search_and_settings(spark):
    from difframe.operators.catalogue import cell_search, with_spacegroups

    d = spark.createDataFrame([(1, 5.0, 6.0, 7.0, 19), (2, 5.04, 6.05, 6.94, 19), (3, 5.06, 6.0, 7.0, 20), (4, None, 6.0, 7.0, None), (5, 5.0, 0.0, 7.0, 19)], "file int, a double, b double, c double, sgnumber int")
    q = d.select(d.file.alias("q"), "a", "b", "c")
    got = _rows(cell_search(d, q))
    lim = lambda x, y: all(u and v and 0.99 * u <= v <= 1.01 * u for u, v in zip(x, y, strict=True))
    rows = [tuple(r) for r in d.collect()]
    assert got == sorted((x[0], y[0]) for x in rows for y in rows if lim(x[1:4], y[1:4]))
    settings = spark.createDataFrame([(19, "P 21 21 21"), (19, "other"), (None, "none")], "itcn int, hm string")
    assert with_spacegroups(d, settings).count() == 6


def test_runtime_helpers(spark):
    df = staged(spark.range(10), "test")
    assert df.count() == 10 and small(df, 20).count() == 10 and small(df, 5) is df and small(df, 20, 10) is df
    assert clear_staged(spark) >= 1
