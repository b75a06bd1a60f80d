import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from difframe.sources import candidates, changes, cif, diffractogram, dump
from difframe.sources.ddl import read_ddl


def test_scans(spark, tmp_path):
    (tmp_path / "a.xye").write_text("# head\n\n20.2 5 1\n20.0 4 0\nx y z\n20.1 0\n7\n" + "\n".join(f"{21 + i} {i} 2" for i in range(9)))
    (tmp_path / "b.ASC").write_text("10,5 100,0\r\n10,0 50,0\r\n")
    rows = [r.asDict() for r in diffractogram.read_scans(spark, [str(tmp_path / "a.xye"), str(tmp_path / "b.ASC")]).collect()]
    a = sorted((r["i"], r["tth"], r["iobs"], r["sigma"]) for r in rows if r["scan_id"].endswith("a.xye"))
    assert a[:3] == [(0, 20.0, 4.0, 2.0), (1, 20.1, 0.0, 1.0), (2, 20.2, 5.0, 1.0)] and len(a) == 12
    b = sorted((r["i"], r["tth"], r["iobs"], r["sigma"]) for r in rows if r["scan_id"].endswith("b.ASC"))
    assert b == [(0, 10.0, 50.0, 50.0**0.5), (1, 10.5, 100.0, 10.0)]
    files = spark.read.text(str(tmp_path), wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    assert [os.path.basename(r.scan_id) for r in diffractogram.short_scans(files).collect()] == ["b.ASC"]


def test_candidates(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text('cod_id,peak_matches,reflections\n7,3,"[{""h"":1,""k"":0,""l"":0,""d_hkl"":2.5,""two_theta"":3 5.5}]"\n8,,"[]"\n9,1,"nope"\nx,1,"[]"\n')
    good, bad = candidates.read_candidates(spark, str(p))
    got = {r.cod_id: r for r in good.collect()}
    assert set(got) == {7, 8} and got[7].reflections[0].two_theta == 35.5 and got[8].peak_matches == 0
    assert bad.count() == 2
    (tmp_path / "d.csv").write_text("a\n1\n")
    with pytest.raises(ValueError):
        candidates.read_candidates(spark, str(tmp_path / "d.csv"))
    (tmp_path / "s.csv").write_text("n_reflections;min\n" + "\n".join(f"{i};{i + 100}" for i in range(50)))
    s = [r.cod_id for r in candidates.read_samples(spark, str(tmp_path / "s.csv"), 5).collect()]
    assert len(set(s)) == 5 and s == [r.cod_id for r in candidates.read_samples(spark, str(tmp_path / "s.csv"), 5).collect()]


CIF = """data_1000007
_cell_length_a 5.0 # comment
loop_
_symmetry_equiv_pos_as_xyz
'x, y, z'
loop_
_atom_site_label
_atom_site_type_symbol
_atom_site_fract_x
_atom_site_fract_y
_atom_site_B_iso_or_equiv
_atom_site_note
Na1 Na+ 0.2513(3) . 0.79 '_odd it''s'
;O1
; O ? 0.5 ? "a b"
. Cl 0 0 0 x
_next_item 3
"""


def test_cif(spark):
    sites = cif.atom_sites(CIF)
    assert [s["label"] for s in sites] == ["Na1", "O1"]
    assert sites[0]["fract_x"] == 0.2513 and sites[0]["fract_y"] is None and sites[0]["u_iso_or_equiv"] == pytest.approx(0.79 / 78.9568) and sites[0]["occupancy"] == 1.0
    df = spark.createDataFrame([(7, CIF), (8, ""), (9, None), (10, "loop_\n_a\n1")], "cod_id long, value string")
    assert {(r.cod_id, r.pos, r.label) for r in cif.parse_sites(df).collect()} == {(7, 0, "Na1"), (7, 1, "O1")}
    r = spark.range(1).select(cif.cif_path(F.lit(1000007)).alias("p"), cif.cif_path(F.lit(77)).alias("q"), cif.cif_number(F.lit("0.5(12)")).alias("n"), cif.cif_number(F.lit("?")).alias("m")).first()
    assert r.p == "cif/1/00/00/1000007.cif" and r.q == "cif/0/00/00/0000077.cif" and r.n == 0.5 and r.m is None


DDL = """/*!40101 SET x */; -- note
CREATE TABLE `data` (
  `file` mediumint(7) unsigned NOT NULL DEFAULT '0' COMMENT 'id (with, comma) and ) bracket',
  `a` double DEFAULT NULL, `n` int(10) unsigned, `big` bigint(20) unsigned NOT NULL,
  `method` enum('single crystal','powder, fine','it''s') DEFAULT NULL,
  `flags` set('a','b'), `year` year(4), `t` timestamp NOT NULL, `d` decimal(8,3), `x` blob, `ok` bool,
  PRIMARY KEY (`file`), UNIQUE KEY `u` (`a`,`n`), KEY `k` (`method`(10)), FULLTEXT KEY `f` (`flags`), CONSTRAINT `c` FOREIGN KEY (`a`) REFERENCES `o` (`id`)
) ENGINE=MyISAM;
CREATE TABLE IF NOT EXISTS other (id int PRIMARY KEY, name varchar(5) NOT NULL);
"""


def test_ddl():
    t = read_ddl(DDL)
    d = t["data"]
    assert {f.name: f.dataType.simpleString() for f in d.schema} == {"file": "int", "a": "double", "n": "bigint", "big": "decimal(20,0)", "method": "string", "flags": "string", "year": "smallint", "t": "timestamp_ntz", "d": "decimal(8,3)", "x": "binary", "ok": "boolean"}
    assert not d.schema["file"].nullable and d.schema["a"].nullable and d.primary_key == ["file"] and d.unique == [["a", "n"]] and d.indexes == [["method"]] and d.fulltext == [["flags"]]
    assert d.allowed["method"] == ["single crystal", "powder, fine", "it's"]
    assert t["other"].primary_key == ["id"] and not t["other"].schema["name"].nullable


def test_dump(spark, tmp_path):
    (tmp_path / "t.txt").write_text("1\ta\\tb\\\\n\t2.5\n2\t\\N\t\\N\n3\tx\n4\tx\tbad\n\\N\t\t1\n")
    schema = T.StructType.fromDDL("id int, s string, v double")
    rows, bad = dump.read_dump(spark, str(tmp_path / "t.txt"), schema)
    assert {tuple(r) for r in rows.collect()} == {(1, "a\tb\\n", 2.5), (2, None, None), (None, "", 1.0)}
    assert sorted(r.reason for r in bad.collect()) == ["column_count", "v"]
    assert dump.load_if_empty(rows, bad) is rows and dump.load_if_empty(None, rows) is rows and dump.load_if_empty(rows.limit(0), bad) is bad


def test_changes(spark):
    kind = "path string, length long, modified string"
    a = spark.createDataFrame([("mysql/data.sql", 1, "x"), ("mysql/old.txt", 1, "x"), ("cif/1.cif", 1, "x")], kind)
    b = spark.createDataFrame([("mysql/data.sql", 2, "y"), ("cif/1.cif", 1, "x"), ("mysql/new.txt", 5, "z")], kind)
    c = changes.changed_files(a, b)
    assert {tuple(r) for r in c.collect()} == {("mysql/data.sql", "changed"), ("mysql/old.txt", "removed"), ("mysql/new.txt", "added")}
    assert {r.table_name for r in changes.tables_of(c).collect()} == {"data", "new"}
    log = changes.revision_row(spark, 5, ["data"]).union(changes.revision_row(spark, 7, [], "late"))
    assert changes.last_revision(log) == 7 and changes.last_revision(log.limit(0)) is None
    f = changes.failure_rows(spark.createDataFrame([Row(cod_id=1, status="error", error_msg="TimeoutError: x"), Row(cod_id=2, status="error", error_msg="Bad"), Row(cod_id=3, status="ok", error_msg="")]))
    assert {(r.cod_id, r.status) for r in f.collect()} == {(1, "TIMEOUT"), (2, "FAILED")}
