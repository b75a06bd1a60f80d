import random

from pyspark.sql import Row

from difframe.plans.catalogue import QUERIES
from difframe.runtime import table
from difframe.sources.delimited import ATOM_SITE, load_lines, read_strictly
import difframe.plans.problems  # noqa: F401


def _brute(line):
    """The reason against a line, character by character."""
    if line is None:
        return "column_count"
    cells, i, n = [], 0, len(line)
    while True:
        cell = ""
        if i < n and line[i] == '"':
            i += 1
            while True:
                if i >= n:
                    return "quoting"
                if line[i] == '"':
                    if line[i + 1 : i + 2] == '"':
                        cell, i = cell + '"', i + 2
                        continue
                    i += 1
                    break
                cell, i = cell + line[i], i + 1
            if i < n and line[i] != ",":
                return "quoting"
        else:
            while i < n and line[i] != ",":
                if line[i] == '"':
                    return "quoting"
                cell, i = cell + line[i], i + 1
        cells.append(cell)
        if i >= n:
            break
        i += 1
    if len(cells) != 10:
        return "column_count"
    for at, name in ((3, "fract_x"), (6, "occupancy"), (7, "u_iso_or_equiv")):
        s = cells[at].strip()
        if s in ("", ".", "?"):
            continue
        t = s
        if t.endswith(")"):
            t, _, u = t[:-1].rpartition("(")
            if not (u and all(c in "0123456789" for c in u)):
                return name
        if any(c not in "0123456789+-.eE" for c in t):
            return name
        try:
            x = float(t)
        except ValueError:
            return name
        if (at == 6 and not 0 <= x <= 1) or (at == 7 and x < 0):
            return name
    return None


def test_found_equals_brute_force(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        want = sorted((r.raw_id, b) for r in table(spark, sf, "atomic_sites_raw").collect() if (b := _brute(r.line)))
        assert sorted(map(tuple, QUERIES["p4_found"](spark, sf).collect())) == want
        assert QUERIES["p4_loaded"](spark, sf).count() + len(want) == table(spark, sf, "atomic_sites_raw").count()


def test_random_lines(spark):
    rnd = random.Random(3)
    pieces = ["1", "0.5", "-.5", "+1.", "1e3", "2E-1(3)", ".", "?", "", " ", '"', '""', '"0.1"', '"a,b"', '"x""y"', "..", "1(", "nan", "inf", "٣", "\n", "0,1", "1.5"]
    lines = [",".join("".join(rnd.choices(pieces, k=rnd.choice([1, 1, 1, 2]))) for _ in range(rnd.choice([10, 10, 10, 9, 11]))) for _ in range(4000)]
    good = "7,A1,Na,0.1(2),+.5,1.,0.5,0.01,a,m"
    lines += [good, good, "", ",,,,,,,,,", None, "x" * 1_000_000, good.replace("A1", '"' + "z" * 500_000 + '"'), good + "\r"]
    df = spark.createDataFrame([Row(raw_id=i, line=x) for i, x in enumerate(lines)], "raw_id long, line string").repartition(3)
    rows = {r.raw_id: r for r in load_lines(df, "line", ["raw_id"], block=64).collect()}
    assert len(rows) == len(lines)
    for i, x in enumerate(lines):
        assert rows[i].reason == _brute(x) == read_strictly(x, ATOM_SITE)[1], x
    r = rows[4000]
    assert (r.cod_id, r.label, r.fract_x, r.fract_y, r.fract_z, r.occupancy) == (7, "A1", 0.1, 0.5, 1.0, 0.5)
    assert [rows[i].fract_x for i in range(4000) if rows[i].reason is None] == [read_strictly(lines[i], ATOM_SITE)[0][3] for i in range(4000) if rows[i].reason is None]


def test_clashing_names_and_empty(spark):
    df = spark.createDataFrame([(1, "r", "7,A,B,1,1,1,1,1,a,m", 3)], "label int, reason string, line string, extra int")
    out = load_lines(df, "line", ["label", "reason"])
    assert {"label", "reason", "label_field", "reason_field"} <= set(out.columns) and out.first()["label_field"] == "A"
    assert load_lines(df.limit(0), "line", ["label"]).count() == 0
