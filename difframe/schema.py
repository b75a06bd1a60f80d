"""Schemas of the catalogue's tables: never inferred, so a text count stays text and an empty table has its types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CELL = "a double, b double, c double, alpha double, beta double, gamma double"
_LINE = "h int, k int, l int, d_hkl double, two_theta double, multiplicity int, f_sq double, intensity_rel double"
_RUN = f"id bigint, cod_id int, {_CELL}, sg_number smallint, sg_symbol string, sg_hall string"

# Names and types of the tables' columns.
TABLES = {
    "cod_data": f"file int, formula string, calcformula string, mineral string, chemname string, commonname string, sg string, sgnumber smallint, sghall string, {_CELL}, vol double, sigvol double, "
    "z smallint, zprime double, wavelength double, radsymbol string, radiation string, method string, status string, flags string, onhold date, duplicateof int, optimal int, celltemp double, cellpressure double, "
    "robs double, rfsqd double, ri double, gofall double, nel string, authors string, title string, journal string, year smallint, doi string, svnrevision int",
    "reference_patterns": f"{_RUN}, wavelength double, rad_symbol string, wavelength_source string, two_theta_min double, two_theta_max double, hkl_max smallint, has_intensities boolean, "
    f"reflections array<struct<{_LINE.replace(' ', ':').replace(',:', ',')}>>, n_reflections int, calculated_at timestamp_ntz",
    "reference_patterns_pymatgen": f"{_RUN}, formula string, wavelength double, rad_symbol string, reflections string, n_reflections int, t_load_s double, t_calc_s double, rss_delta_mb double, calculated_at timestamp_ntz",
    "atomic_sites": "cod_id int, label string, type_symbol string, fract_x double, fract_y double, fract_z double, occupancy double, u_iso_or_equiv double, wyckoff_symbol string, site_symmetry string",
    "failed_patterns_pymatgen": "cod_id int, status string, error_msg string, failed_at timestamp_ntz",
    "peak_fingerprints": "cod_id int, d_hkl double, intensity_rel double, two_theta_src double, wavelength double, rad_symbol string, rank int",
    "spacegroups": "id int, itcn smallint, hall string, schoenflies string, hm string, hmu string, class string, nau smallint",
    "cross_references": "source string, id int, ext_id string, cod_id int, relation_id int",
    "relations": "id int, name string",
    "smiles": "id int, cod_id int, value string",
    "fingerprints": "smiles_id int, " + ", ".join(f"fp{i} bigint" for i in range(32)),
    "scans": "scan_id string, i int, tth double, iobs double, sigma double",
}


def schema(name: str) -> T.StructType:
    """The schema of a table."""
    return T.StructType.fromDDL(TABLES[name])


def empty(spark: SparkSession, name: str) -> DataFrame:
    """The table without rows."""
    return spark.createDataFrame([], schema(name))


def differences(df: DataFrame, name: str) -> list[str]:
    """Columns of a table that ``df`` lacks or has in another type; extra columns are no difference."""
    have = {f.name: f.dataType for f in df.schema}
    return [f"{f.name}: {have[f.name].simpleString() if f.name in have else 'missing'}, not {f.dataType.simpleString()}" for f in schema(name) if have.get(f.name) != f.dataType]


def conformed(df: DataFrame, name: str) -> DataFrame:
    """``df`` with exactly a table's columns: missing ones null, others cast (null where a value doesn't fit)."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema(name)])
