"""Queries of the general data problems: nested records, broken lines, snapshot changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from difframe.operators.nested import reflection_nodes, reflection_tables, refused_patterns
from difframe.operators.snapshots import snapshot_changes
from difframe.plans.catalogue import query
from difframe.runtime import table
from difframe.sources.delimited import load_lines


_UNWRAP = "CASE WHEN json_type({0}) = 'VARCHAR' AND json_valid({0} ->> '$') THEN CAST({0} ->> '$' AS JSON) ELSE {0} END"
_INDICES = """list_transform(regexp_extract_all({0}, '-?[0-9]+(?:\\.[0-9]+)?'), lambda x: CAST(CAST(x AS DOUBLE) AS INTEGER))"""
_HKL = _INDICES.format("CASE WHEN json_type(e) = 'OBJECT' AND (e -> '$.h') IS NOT NULL THEN concat_ws(' ', e ->> '$.h', e ->> '$.k', e ->> '$.l') WHEN json_type(e) = 'OBJECT' THEN CAST(e -> '$.hkl' AS VARCHAR) ELSE CAST(e AS VARCHAR) END")


@query(
    "p1_found",
    f"""WITH t AS (SELECT DISTINCT id, cod_id, CAST(reflections AS JSON) AS j FROM reference_patterns_pymatgen WHERE json_valid(reflections)),
         u AS (SELECT id, {_UNWRAP.format("j")} AS j FROM (SELECT id, {_UNWRAP.format("j")} AS j FROM t)),
         a AS (SELECT id, CASE WHEN json_type(j) = 'ARRAY' THEN j ELSE coalesce(j -> '$.lines', j -> '$.pattern.lines') END AS j FROM u),
         l AS (SELECT id, i AS line_no, j -> ('$[' || i || ']') AS e FROM (SELECT id, j, unnest(range(CAST(json_array_length(j) AS BIGINT))) AS i FROM a WHERE json_type(j) = 'ARRAY')),
         fa AS (SELECT id, line_no, CASE WHEN json_type(f) = 'OBJECT' THEN json_array(f) ELSE f END AS f FROM (SELECT id, line_no, coalesce(e -> '$.families', e -> '$.hkl_families') AS f FROM l WHERE json_type(e) = 'OBJECT')),
         f AS (SELECT id, line_no, i AS family_no, f -> ('$[' || i || ']') AS e FROM (SELECT *, unnest(range(CAST(json_array_length(f) AS BIGINT))) AS i FROM fa WHERE json_type(f) = 'ARRAY')),
         ma AS (SELECT id, line_no, family_no, coalesce(CASE WHEN json_type(e -> '$.equivalents') <> 'NULL' THEN e -> '$.equivalents' END, e -> '$.members') AS m FROM f WHERE json_type(e) = 'OBJECT'),
         m AS (SELECT id, line_no, family_no, i AS member_no, m -> ('$[' || i || ']') AS e FROM (SELECT *, unnest(range(CAST(json_array_length(m) AS BIGINT))) AS i FROM ma WHERE json_type(m) = 'ARRAY')),
         nodes AS (SELECT id, line_no, -1 AS family_no, -1 AS member_no, e FROM l UNION ALL SELECT id, line_no, family_no, -1, e FROM f UNION ALL SELECT id, line_no, family_no, member_no, e FROM m)
       SELECT id, CAST(line_no AS INTEGER) AS line_no, CAST(family_no AS INTEGER) AS family_no, CAST(member_no AS INTEGER) AS member_no, x[1] AS h, x[2] AS k, x[len(x)] AS l
       FROM (SELECT *, {_HKL} AS x FROM nodes WHERE json_type(e) <> 'NULL')""",
)
def p1_found(spark, sf_dir):
    """Every line, family and equivalent triple of the nested reflections, with its places."""
    return reflection_nodes(table(spark, sf_dir, "reference_patterns_pymatgen")).select("id", "line_no", "family_no", "member_no", "h", "k", "l")


@query(
    "p1_refused",
    """WITH RECURSIVE t AS (SELECT DISTINCT id, cod_id, reflections AS j FROM reference_patterns_pymatgen WHERE reflections IS NOT NULL
         UNION ALL SELECT id, cod_id, CAST(j AS JSON) ->> '$' FROM t WHERE json_valid(j) AND json_type(j) = 'VARCHAR')
       SELECT id, cod_id, 'not_json' AS reason FROM t WHERE NOT json_valid(j)""",
)
def p1_refused(spark, sf_dir):
    """Pattern rows whose text can't be read, with the reason."""
    return refused_patterns(table(spark, sf_dir, "reference_patterns_pymatgen"))


_NUMBERS_OF_LINES = ", ".join(f"TRY_CAST(e ->> '$.{path}' AS DOUBLE) AS {name}" for name, path in (("d_hkl", "d_hkl"), ("two_theta", "two_theta"), ("intensity_rel", "intensity_rel"), ("fwhm", "profile.fwhm"), ("eta", "profile.shape.eta")))


@query(
    "p1_lines",
    f"""WITH t AS (SELECT DISTINCT id, cod_id, CAST(reflections AS JSON) AS j FROM reference_patterns_pymatgen WHERE json_valid(reflections)),
         u AS (SELECT id, cod_id, {_UNWRAP.format("j")} AS j FROM (SELECT id, cod_id, {_UNWRAP.format("j")} AS j FROM t)),
         a AS (SELECT id, cod_id, CASE WHEN json_type(j) = 'ARRAY' THEN j ELSE coalesce(j -> '$.lines', j -> '$.pattern.lines') END AS j FROM u),
         l AS (SELECT id, cod_id, i AS line_no, j -> ('$[' || i || ']') AS e FROM (SELECT *, unnest(range(CAST(json_array_length(j) AS BIGINT))) AS i FROM a WHERE json_type(j) = 'ARRAY'))
       SELECT id, cod_id, CAST(line_no AS INTEGER) AS line_no, x[1] AS h, x[2] AS k, x[len(x)] AS l, {_NUMBERS_OF_LINES}, CAST(TRY_CAST(e ->> '$.multiplicity' AS DOUBLE) AS INTEGER) AS multiplicity
       FROM (SELECT *, {_HKL} AS x FROM l WHERE json_type(e) <> 'NULL')""",
)
def p1_lines(spark, sf_dir):
    """The flat table of lines, keyed by Dewey label."""
    t = reflection_tables(table(spark, sf_dir, "reference_patterns_pymatgen"))["lines"]
    return t.drop("label", "parent")


_QUOTED = '"(?:[^"]|"")*"'
_CELL = f'(?:[^",]*|{_QUOTED})'
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


_NUMBER = "[+-]?(?:[0-9]+\\.?[0-9]*|\\.[0-9]+)(?:[eE][+-]?[0-9]+)?(?:\\([0-9]+\\))?"


def _as_double(i: int) -> str:
    return f"CAST(regexp_replace(regexp_replace(v[{i}], '\\(.*', ''), '^\\+', '') AS DOUBLE)"


def _bad(i: int, name: str, extra: str) -> str:
    good = f"regexp_full_match(v[{i}], '{_NUMBER}')"
    return f"WHEN v[{i}] NOT IN ('', '.', '?') AND (NOT {good} OR CASE WHEN {good} THEN {_as_double(i)} {extra} END) THEN '{name}'"


_SITE_CELLS = f"""SELECT *, regexp_full_match(line, '{_CELL}(?:,{_CELL})*') AS ok, len(regexp_replace(regexp_replace(line, '{_QUOTED}', 'q', 'g'), '[^,]', '', 'g')) + 1 AS n,
  list_transform(regexp_extract_all(line, '({_CELL})(?:,|$)', 1), lambda f: trim(CASE WHEN f[1] = '"' THEN replace(f[2:-2], '""', '"') ELSE f END, {_BLANKS})) AS v FROM atomic_sites_raw"""
_SITE_REASONS = f"""SELECT *, CASE WHEN line IS NULL THEN 'column_count' WHEN NOT ok THEN 'quoting' WHEN n <> 10 THEN 'column_count'
  {_bad(4, "fract_x", "IS NULL")} {_bad(7, "occupancy", "NOT BETWEEN 0 AND 1")} {_bad(8, "u_iso_or_equiv", "< 0")} END AS reason FROM ({_SITE_CELLS})"""


def _value(i: int) -> str:
    return f"CASE WHEN regexp_full_match(v[{i}], '{_NUMBER}') THEN {_as_double(i)} END"


@query("p4_found", f"SELECT raw_id, reason FROM ({_SITE_REASONS}) WHERE reason IS NOT NULL")
def p4_found(spark, sf_dir):
    """Lines that cannot be loaded, with the first reason."""
    return load_lines(table(spark, sf_dir, "atomic_sites_raw"), "line", ["raw_id"]).where(F.col("reason").isNotNull()).select("raw_id", "reason")


@query(
    "p4_loaded",
    f"""SELECT raw_id, batch, received_at, CASE WHEN {_value(1)} = floor({_value(1)}) AND abs({_value(1)}) < 2147483648 THEN CAST({_value(1)} AS INTEGER) END AS cod_id,
        {", ".join(f"CASE WHEN v[{i}] NOT IN ('', '.', '?') THEN v[{i}] END AS {n}" for i, n in ((2, "label"), (3, "type_symbol"), (9, "wyckoff_symbol"), (10, "site_symmetry")))},
        {", ".join(f"{_value(i)} AS {n}" for i, n in ((4, "fract_x"), (5, "fract_y"), (6, "fract_z"), (7, "occupancy"), (8, "u_iso_or_equiv")))}
        FROM ({_SITE_REASONS}) WHERE reason IS NULL""",
)
def p4_loaded(spark, sf_dir):
    """The good lines as typed site rows."""
    return load_lines(table(spark, sf_dir, "atomic_sites_raw"), "line", ["raw_id", "batch", "received_at"]).where(F.col("reason").isNull()).drop("reason")


_CONTENT = "formula mineral sg sgnumber a b c alpha beta gamma vol z celltemp status journal year doi".split()


@query(
    "p5_found",
    f"""WITH cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY snapshot_no, file ORDER BY svnrevision DESC NULLS LAST) AS rn FROM cod_data_snapshots) WHERE rn = 1),
         ord AS (SELECT snapshot_no AS now, lag(snapshot_no) OVER (ORDER BY snapshot_no) AS before FROM (SELECT DISTINCT snapshot_no FROM cod_data_snapshots)),
         n AS (SELECT o.now, c.* FROM ord o JOIN cur c ON c.snapshot_no = o.now WHERE o.before IS NOT NULL),
         b AS (SELECT o.now, c.* FROM ord o JOIN cur c ON c.snapshot_no = o.before)
       SELECT coalesce(n.now, b.now) AS snapshot_no, coalesce(n.file, b.file) AS file,
              CASE WHEN b.file IS NULL THEN 'added' WHEN n.file IS NULL THEN 'removed' ELSE 'changed' END AS change
       FROM n FULL JOIN b ON n.now = b.now AND n.file = b.file
       WHERE b.file IS NULL OR n.file IS NULL OR {" OR ".join(f"n.{c} IS DISTINCT FROM b.{c}" for c in _CONTENT)}""",
)
def p5_found(spark, sf_dir):
    """Files added, removed or changed since the delivery before."""
    return snapshot_changes(table(spark, sf_dir, "cod_data_snapshots"), "snapshot_no", "file", "svnrevision", ["delivered_at"])
