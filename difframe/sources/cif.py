"""Atom sites from CIF texts."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SITE = "cod_id int, pos int, label string, type_symbol string, fract_x double, fract_y double, fract_z double, occupancy double, u_iso_or_equiv double, wyckoff_symbol string, site_symmetry string"

# CIF data names of a site's fields.
_FIELDS = {
    "_atom_site_label": "label",
    "_atom_site_type_symbol": "type_symbol",
    "_atom_site_fract_x": "fract_x",
    "_atom_site_fract_y": "fract_y",
    "_atom_site_fract_z": "fract_z",
    "_atom_site_occupancy": "occupancy",
    "_atom_site_u_iso_or_equiv": "u_iso_or_equiv",
    "_atom_site_b_iso_or_equiv": "b_iso",
    "_atom_site_wyckoff_symbol": "wyckoff_symbol",
    "_atom_site_site_symmetry_symbol": "site_symmetry",
    "_atom_site_symmetry_multiplicity": "multiplicity",
}
_TEXT = ("label", "type_symbol", "wyckoff_symbol", "site_symmetry")
_NUMBERS = ("fract_x", "fract_y", "fract_z", "occupancy", "u_iso_or_equiv", "b_iso")
# A semicolon block at a line's start, quoted texts, comments, bare words.
_TOKEN = re.compile(r"^;(?P<block>.*?)(?:^;|\Z)|'(?P<one>.*?)'(?=\s|\Z)|\"(?P<two>[^\"\n]*)\"|(?P<comment>\#[^\n]*)|(?P<bare>\S+)", re.S | re.M)


def cif_path(cod_id) -> Column:
    """Relative path of a structure's file: digits of the zero-padded number as folders."""
    s = F.lpad((F.col(cod_id) if isinstance(cod_id, str) else cod_id).cast("string"), 7, "0")
    return F.concat_ws("/", F.lit("cif"), F.substring(s, 1, 1), F.substring(s, 2, 2), F.substring(s, 4, 2), F.concat(s, F.lit(".cif")))


def cif_number(text) -> Column:
    """A CIF number without its uncertainty; null for ``.``, ``?``, empty and unreadable ones."""
    c = F.trim(F.col(text) if isinstance(text, str) else text)
    return F.regexp_replace(c, r"\(\d+\)$", "").try_cast("double")


def tokens(text: str) -> list[tuple[bool, str]]:
    """(quoted, token) in order, without comments."""
    out = []
    for m in _TOKEN.finditer(text):
        kind = m.lastgroup
        if kind != "comment":
            out.append((kind != "bare", m[kind]))
    return out


def _number(t: str | None) -> float | None:
    try:
        return float(re.sub(r"\(\d+\)$", "", t.strip())) if t is not None else None
    except ValueError:
        return None


def atom_sites(text: str) -> list[dict]:
    """Sites of the first loop that holds any atom-site field; rows without a label are left out.

    Where only B is given, U is B / (8 pi^2).  An absent occupancy column means full occupancy.  Quoted values never
    end a loop, also if they look like data names.
    """
    tok = tokens(text)
    i = 0
    while i < len(tok):
        if tok[i] != (False, tok[i][1]) or tok[i][1].lower() != "loop_":
            i += 1
            continue
        i += 1
        names = []
        while i < len(tok) and not tok[i][0] and tok[i][1].startswith("_"):
            names.append(_FIELDS.get(tok[i][1].lower()))
            i += 1
        values = []
        while i < len(tok) and (tok[i][0] or not (tok[i][1].startswith("_") or re.match(r"(?i)(loop_|data_|save_|global_|stop_)", tok[i][1]))):
            values.append(tok[i][1])
            i += 1
        if not any(names):
            continue
        sites = []
        for at in range(0, len(values) - len(names) + 1, len(names)):
            raw = {n: v.strip() for n, v in zip(names, values[at : at + len(names)], strict=True) if n}
            site = {k: None if raw.get(k) in (None, "", ".", "?") else raw[k] for k in _TEXT} | {k: _number(raw.get(k)) for k in _NUMBERS}
            if "occupancy" not in raw:
                site["occupancy"] = 1.0
            b = site.pop("b_iso")
            if site["u_iso_or_equiv"] is None and b is not None:
                site["u_iso_or_equiv"] = b / (8 * math.pi**2)
            if site["label"]:
                sites.append(site)
        return sites
    return []


def parse_sites(files: DataFrame) -> DataFrame:
    """Typed site rows from ``cod_id, value`` (whole CIF texts): one narrow map, then plain columns."""

    def run(batches):
        import pandas as pd

        cols = [x.split()[0] for x in SITE.split(", ")]
        for pdf in batches:
            rows = [(c, i, *(s[k] for k in cols[2:])) for c, t in zip(pdf.cod_id, pdf.value, strict=True) if t for i, s in enumerate(atom_sites(t))]
            yield pd.DataFrame(rows, columns=cols)

    return files.select(F.col("cod_id").cast("int").alias("cod_id"), "value").mapInPandas(run, SITE)


def read_sites(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Sites of all CIF files under ``paths``; the structure's number is the file's name."""
    files = spark.read.text(paths, wholetext=True).select(F.regexp_extract("_metadata.file_path", r"(\d+)\.cif$", 1).try_cast("int").alias("cod_id"), "value")
    return parse_sites(files)
