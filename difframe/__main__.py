"""Command line: identify or quantify measured scans against a table of patterns or a list of candidates."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from difframe.functions.crystal import CU_KA
from difframe.pipeline import dropped, identify, identify_listed, quantify, quantify_listed
from difframe.sources.candidates import read_candidates
from difframe.sources.diffractogram import read_scans


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="difframe", description=__doc__)
    p.add_argument("scans", nargs="+", help="scan files (.xye, .asc)")
    p.add_argument("--patterns", help="parquet table of reference patterns")
    p.add_argument("--candidates", help="CSV list of candidates (cod_id, reflections as JSON) instead of a table")
    p.add_argument("--structures", help="parquet table of structures, for weight fractions")
    p.add_argument("--top", type=int, default=50, help="candidates per scan that are fitted: those that explain most peaks")
    p.add_argument("--min-matches", type=int, default=3, help="peaks that a candidate must explain")
    p.add_argument("--phases", type=int, default=0, help="quantify this many phases")
    p.add_argument("--wavelength", type=float, default=CU_KA)
    a = p.parse_args(argv)
    if bool(a.patterns) == bool(a.candidates):
        p.error("one of --patterns and --candidates is needed")
    if a.phases and not a.structures:
        p.error("--phases needs --structures")
    spark = SparkSession.builder.appName("difframe").getOrCreate()
    points, options = read_scans(spark, a.scans), {"top": a.top, "min_matches": a.min_matches, "wavelength": a.wavelength}
    source, refused = read_candidates(spark, a.candidates) if a.candidates else (spark.read.parquet(a.patterns), None)
    if a.phases:
        structures = spark.read.parquet(a.structures).withColumnRenamed("file", "cod_id")
        out = (quantify_listed if a.candidates else quantify)(points, source, structures, a.phases, **options).orderBy("scan_id", "weight_pct", ascending=[True, False])
    else:
        out = (identify_listed if a.candidates else identify)(points, source, **options).orderBy("scan_id", "rank")
    out.show(200, truncate=False)
    lost = refused if a.candidates else dropped(points, source, **options).orderBy("scan_id", "rank")
    if not lost.isEmpty():
        print("Candidates that could not be read:" if a.candidates else "Hits without a Cu pattern, not fitted:")
        lost.show(200, truncate=a.candidates is not None)


if __name__ == "__main__":
    main()
