import json

from pyspark.sql import Row
from pyspark.sql import functions as F

from difframe.operators.nested import dewey_nodes, distinct_rows, node_table, read_json, reflection_nodes, reflection_tables, refused_patterns
from difframe.plans.catalogue import QUERIES
from difframe.runtime import table
import difframe.plans.problems  # noqa: F401


def _triple(e):
    """h, k, l of an entry by plain case distinction (the brute-force side)."""
    if isinstance(e, dict):
        e = [e[x] for x in "hkl"] if "h" in e else e.get("hkl")
        if isinstance(e, dict):
            e = [e[x] for x in "hkl"]
    if isinstance(e, str):
        e = e.split()
    if e is None:
        return None, None, None
    n = [int(float(x)) for x in e]
    return (n[0], n[1], n[3]) if len(n) == 4 else tuple(n)


def _brute(rows):
    out = set()
    for i, text in rows:
        v = read_json(text)
        if isinstance(v, dict):
            v = v.get("pattern", v)
            v = v.get("lines")
        for a, line in enumerate(v or []):
            if line is None:
                continue
            out.add((i, a, -1, -1, *_triple(line)))
            fams = line.get("families", line.get("hkl_families"))
            for b, fam in enumerate([fams] if isinstance(fams, dict) else fams or []):
                if fam is None:
                    continue
                out.add((i, a, b, -1, *_triple(fam)))
                for c, m in enumerate(fam.get("equivalents", fam.get("members")) or []):
                    if m is not None:
                        out.add((i, a, b, c, *_triple(m)))
    return out


def test_found_equals_brute_force(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        rows = [tuple(r) for r in table(spark, sf, "reference_patterns_pymatgen").select("id", "reflections").distinct().collect()]
        got = [tuple(r) for r in QUERIES["p1_found"](spark, sf).collect()]
        assert len(got) == len(set(got)) and set(got) == _brute(rows)


def test_shapes(spark):
    line = {"h": 1, "k": 0, "l": -1, "families": {"hkl": "1 0 -1 2", "equivalents": [None, [1, 0, -1, 2], {"h": "3", "k": 2.0, "l": 1}]}}
    texts = [
        json.dumps([None, line]),
        json.dumps(json.dumps({"pattern": {"lines": [line]}})),
        "[{]",
        "[] tail",
        '{"lines": [{"h": NaN, "k": 1, "l": 1}]}',
        None,
        "",
        "3",
        "null",
        "[]",
        "[" * 100_000,
        json.dumps({"lines": json.dumps([line]), "notes": ["x"]}),
    ]
    df = spark.createDataFrame([Row(id=i, cod_id=9, reflections=t) for i, t in enumerate(texts)], "id long, cod_id int, reflections string")
    got = {tuple(r) for r in reflection_nodes(df.union(df)).select("id", "line_no", "family_no", "member_no", "h", "k", "l").collect()}
    want = set()
    for i, a in ((0, 1), (1, 0), (11, 0)):
        want |= {(i, a, -1, -1, 1, 0, -1), (i, a, 0, -1, 1, 0, 2), (i, a, 0, 1, 1, 0, 2), (i, a, 0, 2, 3, 2, 1)}
    assert got == want


def test_parent_links_and_extra_columns(spark):
    df = spark.createDataFrame([(1, 7, '{"a": [{"x": 1, "b": [{"y": 2}, {"y": null}]}, {"c": {"d": 5}}]}', "k")], "id int, label int, t string, attrs string")
    nodes = dewey_nodes(df, ["id"], "t", {"a", "b"})
    b = {tuple(r["label"]): (tuple(r["parent"]), r["attrs"]) for r in node_table(nodes, r"\$\.a\[\]\.b\[\]").collect()}
    assert b == {(0, 0): ((0,), {"y": "2"}), (0, 1): ((0,), {})}
    clash = dewey_nodes(df, ["id", "label"], "t", {"a", "b"})
    assert clash.columns == ["id", "label", "schema_path", "label_node", "attrs"] and {r["label"] for r in clash.collect()} == {7}
    a = {tuple(r["label"]): r["attrs"] for r in node_table(nodes, r"\$\.a\[\]").collect()}
    assert a == {(0,): {"x": "1"}, (1,): {"c.d": "5"}}


def test_tables_keep_their_way_back(spark, sf):
    t = reflection_tables(table(spark, sf, "reference_patterns_pymatgen"))
    keys = ["id", "cod_id", "label"]
    for child, above in (("families", "lines"), ("equivalents", "families")):
        c = t[child].select("id", "cod_id", F.col("parent").alias("label"))
        assert c.join(t[above].select(*keys), keys, "left_anti").count() == 0
        assert t[child].select(*keys).distinct().count() == t[child].count()


def test_distinct_rows(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, "a", 1), (1, "b", 2), (2, "c", 3), (None, "d", 4), (None, "d", 5)], "id int, t string, extra int")
    assert sorted(map(tuple, distinct_rows(df, ["id", "t"]).collect()), key=str) == sorted([(1, "a"), (1, "b"), (2, "c"), (None, "d")], key=str)
    assert distinct_rows(df.limit(0), ["id", "t"]).count() == 0


def test_poison_rows_harm_no_others(spark):
    """Deep nesting, unpaired surrogates, huge numbers and clashing names, in one table with good rows."""
    line = {"h": 1, "k": 0, "l": 2}
    deep = "[" * 1500 + "]" * 1500
    texts = [
        json.dumps([line]),
        f'[{{"h": 1, "k": 0, "l": 2, "deep": {deep}}}]',
        '[{"h": 1, "k": 0, "l": 2, "note": "\\ud800 \\ud83d\\ude00", "\\udc00": 1}]',
        f'[{{"h": 1, "k": 0, "l": 2, "n": {"7" * 5000}, "list": [1, {"8" * 5000}, "x", null, true]}}]',
        '[{"h": 1, "k": 0, "l": 2, "a": {"b": 1}, "a.b": 2, "a[]": 3, "": 4, "\\\\": 5}]',
        "[" * 200_000,
        "[1",
        None,
        json.dumps([line]),
    ]
    df = spark.createDataFrame([(i, 9, t) for i, t in enumerate(texts)], "id long, cod_id int, reflections string").coalesce(1)
    rows = {r.id: r for r in reflection_nodes(df).where("level = 'line'").collect()}
    assert {i: (r.line_no, r.h, r.k, r.l) for i, r in rows.items()} == {i: (0, 1, 0, 2) for i in (0, 1, 2, 3, 4, 8)}
    assert rows[2].attrs["note"] == "\ufffd \U0001f600" and rows[2].attrs["\ufffd"] == "1"
    assert rows[3].attrs["n"] == "7" * 5000 and rows[3].attrs["list"] == f'[1, {"8" * 5000}, "x", null, true]'
    assert {k: v for k, v in rows[4].attrs.items() if k not in "hkl"} == {"a.b": "1", "a\\.b": "2", "a\\[\\]": "3", "\\\\": "5", "\\": "4"}
    assert sorted((r.id, r.reason) for r in refused_patterns(df).collect()) == [(5, "too_deep"), (6, "not_json")]
    assert dewey_nodes(df.where("id = 1"), ["id"], "reflections", set()).count() == 1501
