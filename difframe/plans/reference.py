"""Queries of the catalogue, search, pattern and fit operators, each with its SQL equivalent where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from difframe import pipeline
from difframe.functions import chemistry as ch
from difframe.functions import crystal as cr
from difframe.operators import catalogue as cat
from difframe.operators import fit, relational, search
from difframe.operators.nested import family_multiplicities
from difframe.operators.pattern import MAX_VOLUME, calculate_patterns, lines_of, refusals, scaled_to_100, structure_factors
from difframe.plans.catalogue import query
from difframe.runtime import shared_dir, staged, table
from difframe.sources import cif, diffractogram, dump
from difframe.streaming.upsert import BUCKET, stored, upsert_stream


def structures(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "cod_data").withColumnRenamed("file", "cod_id")


def r(x, n: int = 6):
    return F.round(x, n)


# ---- fingerprints and search ----------------------------------------------------------------------------------------

_BEST = """best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cod_id ORDER BY wavelength DESC NULLS LAST, n_reflections DESC NULLS LAST, id) AS k
             FROM (SELECT DISTINCT id, cod_id, wavelength, rad_symbol, n_reflections, has_intensities, reflections FROM reference_patterns) WHERE has_intensities) WHERE k = 1)"""
_BESTS = """any_best AS (SELECT cod_id, has_intensities FROM (SELECT *, row_number() OVER (PARTITION BY cod_id ORDER BY calculated_at DESC NULLS LAST, id DESC) AS k
             FROM (SELECT DISTINCT id, cod_id, has_intensities, calculated_at FROM reference_patterns)) WHERE k = 1)"""
_GRID = tuple(range(10, 90, 5))
_PRINT = f"""{_BEST},
       flat AS (SELECT cod_id, wavelength, rad_symbol, unnest(reflections) AS x FROM best),
       prints AS (SELECT cod_id, x.d_hkl AS d_hkl, x.intensity_rel AS intensity_rel, x.two_theta AS two_theta_src, wavelength, rad_symbol, x.h AS h, x.k AS k, x.l AS l,
                  CAST(row_number() OVER (PARTITION BY cod_id ORDER BY x.intensity_rel DESC, x.d_hkl DESC, x.h, x.k, x.l) AS INTEGER) AS rank
                  FROM flat WHERE x.intensity_rel > 0 AND x.d_hkl > 0)"""


@query("best_pattern", f"WITH {_BEST} SELECT cod_id, id, wavelength, rad_symbol FROM best")
def best_pattern(spark, sf_dir):
    return search.best_patterns(table(spark, sf_dir, "reference_patterns")).drop("reflections")


@query("fingerprint_top30", f"WITH {_PRINT} SELECT cod_id, d_hkl, intensity_rel, two_theta_src, wavelength, rad_symbol, h, k, l, rank FROM prints WHERE rank <= 30")
def fingerprint_top30(spark, sf_dir):
    return search.fingerprints(table(spark, sf_dir, "reference_patterns"))


@query(
    "hanawalt_search",
    f"""WITH {_PRINT},
       win AS (SELECT cod_id AS scan_id, rank AS peak_no,
                      round(1.54056 / (2 * sin(radians((t + 0.2) / 2))), 6) AS d_lo, round(1.54056 / (2 * sin(radians(greatest(t - 0.2, 1e-6) / 2))), 6) AS d_hi
               FROM (SELECT cod_id, rank, degrees(2 * asin(1.54056 / (2 * d_hkl))) AS t FROM prints WHERE rank <= 30 AND cod_id % 20 = 0 AND 1.54056 <= 2 * d_hkl)),
       hits AS (SELECT w.scan_id, p.cod_id, CAST(count(DISTINCT w.peak_no) AS INTEGER) AS n_matched FROM (SELECT * FROM prints WHERE rank <= 30) p JOIN win w ON p.d_hkl BETWEEN w.d_lo AND w.d_hi GROUP BY ALL)
       SELECT scan_id, cod_id, n_matched, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY scan_id ORDER BY n_matched DESC, cod_id) AS rank FROM hits WHERE n_matched >= 2) WHERE rank <= 50""",
)
def hanawalt_search(spark, sf_dir):
    """Structures whose number is divisible by 20, as unknown scans, against the 30-line fingerprints of all."""
    prints = staged(search.fingerprints(table(spark, sf_dir, "reference_patterns")), "fingerprints")
    peaks = prints.where("cod_id % 20 = 0").select(F.col("cod_id").alias("scan_id"), F.col("rank").alias("peak_no"), cr.bragg_two_theta("d_hkl").alias("two_theta")).where("two_theta IS NOT NULL")
    windows = search.peak_windows(peaks).select("scan_id", "peak_no", r("d_lo").alias("d_lo"), r("d_hi").alias("d_hi"))
    return search.match_phases(prints, windows, min_matches=2, top=50)


@query(
    "gaussian_sum",
    f"""WITH {_BEST}, f AS (SELECT cod_id, x.two_theta AS c, x.intensity_rel AS i FROM (SELECT cod_id, unnest(reflections) AS x FROM best) WHERE x.intensity_rel > 0),
         g AS (SELECT CAST(unnest(range(10, 90, 5)) AS DOUBLE) AS tth), y AS (SELECT cod_id, tth, sum(i * exp(-4 * ln(2) * ((tth - c) / 4.0)**2)) AS y FROM f, g GROUP BY cod_id, tth)
       SELECT cod_id, tth, round(CASE WHEN top > 0 THEN 100 * y / top ELSE y END, 4) AS y FROM (SELECT *, max(y) OVER (PARTITION BY cod_id) AS top FROM y)""",
)
def gaussian_sum(spark, sf_dir):
    """Gaussian lines of every structure's best pattern on a coarse grid, scaled to a highest point of 100."""
    lines = search.best_patterns(table(spark, sf_dir, "reference_patterns")).select("cod_id", F.explode("reflections").alias("x")).where("x.intensity_rel > 0")
    lines = lines.select("cod_id", F.col("x.two_theta").alias("c"), F.col("x.intensity_rel").alias("i"), F.explode(F.array(*[F.lit(float(g)) for g in _GRID])).alias("tth"))
    y = lines.groupBy("cod_id", "tth").agg(F.sum(F.col("i") * cr.gaussian("tth", "c", F.lit(4.0))).alias("y"))
    return scaled_to_100(y, "cod_id", "y").withColumn("y", r("y", 4))


@query(
    "pattern_flags",
    f"""WITH {_BESTS} SELECT cod_id, CASE WHEN has_intensities THEN '' WHEN NOT has_intensities THEN '[!sem F2]' ELSE '' END AS flag FROM any_best""",
)
def pattern_flags(spark, sf_dir):
    """The warning that a structure's newest pattern lacks structure factors."""
    newest = relational.best_row(table(spark, sf_dir, "reference_patterns"), ["cod_id"], ["calculated_at", "id"], ["has_intensities"])
    return newest.select("cod_id", cr.reliability_flag("has_intensities").alias("flag"))


# ---- latest rows, metadata, jobs ------------------------------------------------------------------------------------

_LATEST = """latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cod_id ORDER BY calculated_at DESC NULLS LAST, id DESC) AS k FROM
              (SELECT DISTINCT id, cod_id, wavelength, n_reflections, has_intensities, calculated_at FROM reference_patterns)
              WHERE has_intensities AND wavelength BETWEEN 1.535 AND 1.546) WHERE k = 1)"""


@query("latest_cu_pattern", f"WITH {_LATEST} SELECT cod_id, id, wavelength, n_reflections FROM latest")
def latest_cu_pattern(spark, sf_dir):
    """The newest Cu pattern with intensities of every structure."""
    p = table(spark, sf_dir, "reference_patterns").where("has_intensities AND wavelength BETWEEN 1.535 AND 1.546")
    return relational.best_row(p, ["cod_id"], ["calculated_at", "id"], ["id", "wavelength", "n_reflections"])


#: Fields of a structure's metadata, beside the angles and those of its pattern.
_META = "formula calcformula mineral chemname commonname sg sgnumber sghall a b c z zprime wavelength radsymbol method status flags authors title journal year doi".split()
_META_SQL = ", ".join(f"d.{c}" for c in _META)


@query(
    "metadata_left_join",
    f"""WITH {_LATEST} SELECT d.file AS cod_id, {_META_SQL}, coalesce(d.alpha, 90.0) AS alpha, coalesce(d.beta, 90.0) AS beta, coalesce(d.gamma, 90.0) AS gamma, l.id AS pattern_id, l.n_reflections, l.has_intensities
       FROM cod_data d LEFT JOIN latest l ON l.cod_id = d.file""",
)
def metadata_left_join(spark, sf_dir):
    """Structures with right angles filled in and their newest Cu pattern, if any."""
    return _metadata(spark, sf_dir)


def _metadata(spark, sf_dir) -> DataFrame:
    ninety = [F.coalesce(F.col(x), F.lit(90.0)).alias(x) for x in ("alpha", "beta", "gamma")]
    newest = latest_cu_pattern(spark, sf_dir).select("cod_id", F.col("id").alias("pattern_id"), "n_reflections", F.lit(True).alias("has_intensities"))
    return structures(spark, sf_dir).select("cod_id", *_META, *ninety).join(newest, "cod_id", "left")


def _failed_ids(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "failed_patterns_pymatgen").select("cod_id")


@query(
    "fetch_metadata",
    f"""WITH {_LATEST} SELECT d.file AS cod_id, {_META_SQL}, coalesce(d.alpha, 90.0) AS alpha, coalesce(d.beta, 90.0) AS beta, coalesce(d.gamma, 90.0) AS gamma, l.id AS pattern_id, l.n_reflections, l.has_intensities
       FROM cod_data d LEFT JOIN latest l ON l.cod_id = d.file WHERE d.file IN (SELECT cod_id FROM failed_patterns_pymatgen WHERE cod_id IS NOT NULL)""",
)
def fetch_metadata(spark, sf_dir):
    """Metadata of a list of structures: those whose second-generation pattern failed."""
    return relational.by_ids(_metadata(spark, sf_dir), _failed_ids(spark, sf_dir), "cod_id")


@query(
    "fetch_reflections",
    f"""WITH {_LATEST} SELECT l.cod_id, l.id, x.h AS h, x.k AS k, x.l AS l, x.d_hkl AS d_hkl, x.two_theta AS two_theta, x.intensity_rel AS intensity_rel
       FROM latest l JOIN (SELECT DISTINCT id, cod_id, unnest(reflections) AS x FROM (SELECT DISTINCT id, cod_id, reflections FROM reference_patterns)) p ON p.id = l.id AND p.cod_id = l.cod_id
       WHERE l.cod_id IN (SELECT cod_id FROM failed_patterns_pymatgen WHERE cod_id IS NOT NULL)""",
)
def fetch_reflections(spark, sf_dir):
    """Lines of the newest Cu pattern with intensities of a list of structures."""
    p = relational.by_ids(table(spark, sf_dir, "reference_patterns").where("has_intensities AND wavelength BETWEEN 1.535 AND 1.546"), _failed_ids(spark, sf_dir), "cod_id")
    newest = relational.best_row(p, ["cod_id"], ["calculated_at", "id"], ["id", "reflections"])
    return newest.select("cod_id", "id", F.explode("reflections").alias("x")).select("cod_id", "id", *[f"x.{c}" for c in ("h", "k", "l", "d_hkl", "two_theta", "intensity_rel")]).distinct()


_JOBS = """jobs AS (SELECT d.file AS cod_id, e.n AS estimate FROM cod_data d LEFT JOIN (SELECT cod_id, n FROM (SELECT cod_id, n_reflections AS n, row_number() OVER (PARTITION BY cod_id ORDER BY calculated_at DESC NULLS LAST, id DESC) AS k
              FROM (SELECT DISTINCT id, cod_id, n_reflections, calculated_at FROM reference_patterns)) WHERE k = 1) e ON e.cod_id = d.file
            WHERE d.status IS NULL AND d.a IS NOT NULL AND d.b IS NOT NULL AND d.c IS NOT NULL AND d.sgnumber IS NOT NULL
              AND NOT EXISTS (SELECT 1 FROM reference_patterns_pymatgen p WHERE p.cod_id = d.file) AND NOT EXISTS (SELECT 1 FROM failed_patterns_pymatgen f WHERE f.cod_id = d.file))"""


@query("pending_jobs", f"WITH {_JOBS} SELECT cod_id, estimate, CASE WHEN coalesce(estimate, 0) <= 500 THEN 'SMALL' WHEN estimate <= 2000 THEN 'MEDIUM' ELSE 'LARGE' END AS tier FROM jobs")
def pending_jobs(spark, sf_dir):
    """Structures fit for a pattern that have none and have not failed, with size tier by their latest estimate."""
    fit_for = structures(spark, sf_dir).where("status IS NULL AND a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL AND sgnumber IS NOT NULL").select("cod_id")
    todo = relational.pending(fit_for, [table(spark, sf_dir, "reference_patterns_pymatgen"), table(spark, sf_dir, "failed_patterns_pymatgen")], ["cod_id"])
    estimate = relational.best_row(table(spark, sf_dir, "reference_patterns"), ["cod_id"], ["calculated_at", "id"], ["n_reflections"])
    return todo.join(estimate, "cod_id", "left").select("cod_id", F.col("n_reflections").alias("estimate"), relational.size_tier("n_reflections").alias("tier"))


@query(
    "next_jobs",
    f"""WITH {_JOBS}, files AS (SELECT DISTINCT cod_id FROM atomic_sites WHERE cod_id IS NOT NULL)
       SELECT cod_id, path, estimate FROM (SELECT j.cod_id, 'cif/' || substr(lpad(CAST(j.cod_id AS VARCHAR), 7, '0'), 1, 1) || '/' || substr(lpad(CAST(j.cod_id AS VARCHAR), 7, '0'), 2, 2) || '/' || substr(lpad(CAST(j.cod_id AS VARCHAR), 7, '0'), 4, 2) || '/' || lpad(CAST(j.cod_id AS VARCHAR), 7, '0') || '.cif' AS path,
         coalesce(j.estimate, 0) AS estimate FROM jobs j JOIN files f ON f.cod_id = j.cod_id ORDER BY coalesce(j.estimate, 0), j.cod_id LIMIT 200)""",
)
def next_jobs(spark, sf_dir):
    """The 200 smallest pending jobs among structures that have a file: here those whose sites are loaded."""
    files = table(spark, sf_dir, "atomic_sites").where("cod_id IS NOT NULL").select("cod_id").distinct().select("cod_id", cif.cif_path("cod_id").alias("path"))
    jobs = pending_jobs(spark, sf_dir).join(files, "cod_id").select("cod_id", "path", F.coalesce("estimate", F.lit(0)).alias("estimate"))
    return relational.next_jobs(jobs, "estimate", "cod_id", 200)


@query(
    "pending_per_radiation",
    """SELECT DISTINCT r.cod_id, r.wavelength FROM reference_patterns r WHERE r.cod_id IS NOT NULL AND r.wavelength IS NOT NULL
       AND NOT EXISTS (SELECT 1 FROM reference_patterns_pymatgen p WHERE p.cod_id = r.cod_id AND p.wavelength = r.wavelength)""",
)
def pending_per_radiation(spark, sf_dir):
    """Radiations of a structure that have no second-generation pattern yet."""
    want = table(spark, sf_dir, "reference_patterns").select("cod_id", "wavelength").where("cod_id IS NOT NULL AND wavelength IS NOT NULL").distinct()
    return relational.pending(want, [table(spark, sf_dir, "reference_patterns_pymatgen")], ["cod_id", "wavelength"])


# ---- crystallography ------------------------------------------------------------------------------------------------

_SYSTEM = "CASE WHEN {0} IS NULL OR {0} < 1 THEN 'unknown' " + " ".join(f"WHEN {{0}} <= {n} THEN '{s}'" for n, s in cr.SYSTEMS) + " ELSE 'unknown' END"
_LATTICE = "CASE WHEN upper(substr(trim({0}), 1, 1)) IN ('P','I','F','C','A','B','R') THEN upper(substr(trim({0}), 1, 1)) ELSE 'P' END"
_VOLUME = "(a * b * c * sqrt(greatest(1 - cos(radians(alpha))**2 - cos(radians(beta))**2 - cos(radians(gamma))**2 + 2 * cos(radians(alpha)) * cos(radians(beta)) * cos(radians(gamma)), 1e-12)))"
_INV = """CASE system WHEN 'cubic' THEN (h*h + k*k + l*l) / (a*a) WHEN 'tetragonal' THEN (h*h + k*k) / (a*a) + l*l / (c*c)
          WHEN 'orthorhombic' THEN h*h / (a*a) + k*k / (b*b) + l*l / (c*c)
          WHEN 'hexagonal' THEN 4.0/3 * (h*h + h*k + k*k) / (a*a) + l*l / (c*c) WHEN 'trigonal' THEN 4.0/3 * (h*h + h*k + k*k) / (a*a) + l*l / (c*c)
          WHEN 'monoclinic' THEN (h*h / (a*a) + l*l / (c*c) - 2*h*l*cos(radians(beta)) / (a*c)) / sin(radians(beta))**2 + k*k / (b*b)
          WHEN 'triclinic' THEN (h*h*(b*c*sin(radians(alpha)))**2 + k*k*(a*c*sin(radians(beta)))**2 + l*l*(a*b*sin(radians(gamma)))**2
             + 2*h*k*a*b*c*c*(cos(radians(alpha))*cos(radians(beta)) - cos(radians(gamma))) + 2*k*l*a*a*b*c*(cos(radians(beta))*cos(radians(gamma)) - cos(radians(alpha)))
             + 2*h*l*a*b*b*c*(cos(radians(alpha))*cos(radians(gamma)) - cos(radians(beta)))) / (vol*vol) END"""
_CELLS = f"""cells AS (SELECT file AS cod_id, a, b, c, coalesce(alpha, 90.0) AS alpha, coalesce(beta, 90.0) AS beta, coalesce(gamma, 90.0) AS gamma, {_SYSTEM.format("sgnumber")} AS system, {_LATTICE.format("sg")} AS lattice
           FROM cod_data WHERE a > 0 AND b > 0 AND c > 0 AND sgnumber IS NOT NULL),
         vols AS (SELECT *, {_VOLUME} AS vol FROM cells WHERE system <> 'unknown')"""
_ALLOWED = """CASE lattice WHEN 'I' THEN (h+k+l+60) % 2 = 0 WHEN 'F' THEN (h+60) % 2 = (k+60) % 2 AND (k+60) % 2 = (l+60) % 2 WHEN 'C' THEN (h+k+60) % 2 = 0
             WHEN 'A' THEN (k+l+60) % 2 = 0 WHEN 'B' THEN (h+l+60) % 2 = 0 WHEN 'R' THEN (-h+k+l+60) % 3 = 0 ELSE true END"""


@query(
    "structure_geometry",
    f"""SELECT file AS cod_id, {_SYSTEM.format("sgnumber")} AS system, {_LATTICE.format("sg")} AS lattice, round({_VOLUME}, 4) AS volume FROM cod_data""",
)
def structure_geometry(spark, sf_dir):
    """Crystal system, centring and cell volume of every structure."""
    s = structures(spark, sf_dir)
    return s.select("cod_id", cr.crystal_system("sgnumber").alias("system"), cr.lattice_type("sg").alias("lattice"), r(cr.cell_volume("a", "b", "c", "alpha", "beta", "gamma"), 4).alias("volume"))


_GRID_LINES = f"""grid AS (SELECT h, k, l FROM (SELECT unnest(range(0, 16)) AS h), (SELECT unnest(range(-15, 16)) AS k), (SELECT unnest(range(-15, 16)) AS l) WHERE h > 0 OR k > 0 OR (k = 0 AND l > 0)),
         d AS (SELECT *, CASE WHEN inv > 1e-12 THEN 1 / sqrt(inv) END AS d FROM (SELECT *, {_INV} AS inv FROM vols, grid WHERE {_ALLOWED})),
         t AS (SELECT *, CASE WHEN 1.54056 / (2 * d) <= 1 THEN degrees(2 * asin(1.54056 / (2 * d))) END AS tt FROM d WHERE d >= 0.4),
         f AS (SELECT *, row_number() OVER (PARTITION BY cod_id, round_even(d * 1000, 0) ORDER BY h, k, l) AS n FROM t WHERE tt BETWEEN 5 AND 90)"""


@query(
    "pattern_lines",
    f"""WITH {_CELLS}, {_GRID_LINES}
       SELECT cod_id, CAST(count(*) AS BIGINT) AS n_lines, round(sum(d), 4) AS sum_d FROM f WHERE n = 1 GROUP BY cod_id""",
)
def pattern_lines(spark, sf_dir):
    """Lines of every structure over the whole index grid: number and summed spacings."""
    lines = lines_of(structures(spark, sf_dir), cr.CU_KA)
    return lines.groupBy("cod_id").agg(F.count(F.lit(1)).alias("n_lines"), r(F.sum("d"), 4).alias("sum_d"))


@query(
    "refused_structures",
    f"""WITH t AS (SELECT file AS cod_id, a, b, c, sgnumber, {_SYSTEM.format("sgnumber")} AS system, a > 0 AND b > 0 AND c > 0 AS cell, {_VOLUME.replace("(alpha)", "(coalesce(alpha, 90.0))").replace("(beta)", "(coalesce(beta, 90.0))").replace("(gamma)", "(coalesce(gamma, 90.0))")} AS volume FROM cod_data)
       SELECT cod_id, status FROM (SELECT cod_id, CASE WHEN NOT coalesce(cell, false) THEN 'NoCell' WHEN sgnumber IS NULL THEN 'NoSpaceGroup' WHEN system = 'unknown' THEN 'UnknownSystem' WHEN volume > 20000 THEN 'StructureTooLarge' END AS status FROM t) WHERE status IS NOT NULL""",
)
def refused_structures(spark, sf_dir):
    """Structures that a second-generation calculator refuses, with the reason."""
    return refusals(structures(spark, sf_dir), MAX_VOLUME).select("cod_id", "status")


@query(
    "d_spacings",
    f"""WITH {_CELLS}, g AS (SELECT * FROM (VALUES (1,0,0), (0,1,1), (1,-1,2), (2,1,1)) t(h, k, l))
       SELECT cod_id, CAST(h AS INTEGER) AS h, CAST(k AS INTEGER) AS k, CAST(l AS INTEGER) AS l, round(CASE WHEN {_INV} > 1e-12 THEN 1 / sqrt({_INV}) END, 5) AS d FROM vols, g WHERE system <> 'triclinic' OR vol > 1""",
)
def d_spacings(spark, sf_dir):
    """Spacings of a few lines in all crystal systems."""
    s = structures(spark, sf_dir).where("a > 0 AND b > 0 AND c > 0 AND sgnumber IS NOT NULL").withColumn("system", cr.crystal_system("sgnumber"))
    angles = {x: F.coalesce(F.col(x), F.lit(90.0)) for x in ("alpha", "beta", "gamma")}
    s = s.withColumns(angles).where(F.col("system") != "unknown").where((F.col("system") != "triclinic") | (cr.cell_volume("a", "b", "c", "alpha", "beta", "gamma") > 1))
    s = s.select("cod_id", cr.reciprocal_metric("a", "b", "c", "alpha", "beta", "gamma", "system").alias("metric"))
    hkl = F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(t, "hkl", strict=True)]) for t in ((1, 0, 0), (0, 1, 1), (1, -1, 2), (2, 1, 1))]))
    return s.withColumn("x", hkl).select("cod_id", "x.h", "x.k", "x.l", r(cr.d_spacing(F.col("x.h"), F.col("x.k"), F.col("x.l"), "metric"), 5).alias("d"))


_FLAT = "SELECT DISTINCT id, cod_id, wavelength, sg_number, unnest(reflections) AS x FROM (SELECT DISTINCT id, cod_id, wavelength, sg_number, reflections FROM reference_patterns)"


def _flat(spark, sf_dir):
    p = table(spark, sf_dir, "reference_patterns").select("id", "cod_id", "wavelength", "sg_number", F.explode("reflections").alias("x")).distinct()
    return p.select("id", "cod_id", "wavelength", "sg_number", "x.*")


@query(
    "line_optics",
    f"""SELECT id, x.h AS h, x.k AS k, x.l AS l, round(CASE WHEN wavelength / (2 * x.d_hkl) <= 1 THEN degrees(2 * asin(wavelength / (2 * x.d_hkl))) END, 5) AS two_theta,
              round((1 + cos(radians(x.two_theta))**2) / (sin(radians(x.two_theta / 2))**2 * cos(radians(x.two_theta / 2))), 5) AS lp,
              round(sqrt(greatest(0.01 * tan(radians(x.two_theta / 2))**2 - 0.002 * tan(radians(x.two_theta / 2)) + 0.005, 1e-8)), 6) AS fwhm
       FROM ({_FLAT})""",
)
def line_optics(spark, sf_dir):
    """Angle, Lorentz-polarisation factor and width of every stored line."""
    return _flat(spark, sf_dir).select("id", "h", "k", "l", r(cr.bragg_two_theta("d_hkl", "wavelength"), 5).alias("two_theta"), r(cr.lorentz_polarization("two_theta"), 5).alias("lp"), r(cr.caglioti_fwhm("two_theta")).alias("fwhm"))


_MULT = """CASE system WHEN 'cubic' THEN CASE WHEN z = 0 THEN CASE WHEN h = k AND k = l THEN 8 WHEN h = k OR k = l OR h = l THEN 24 ELSE 48 END WHEN z = 1 THEN CASE WHEN (h = k OR k = l OR h = l) THEN 12 ELSE 24 END ELSE 6 END
   WHEN 'tetragonal' THEN CASE WHEN z = 0 THEN CASE WHEN h = k THEN 8 ELSE 16 END WHEN l = 0 THEN CASE WHEN h = 0 OR k = 0 OR h = k THEN 4 ELSE 8 END ELSE CASE WHEN h = 0 OR k = 0 THEN 4 ELSE 8 END END
   WHEN 'orthorhombic' THEN CASE z WHEN 0 THEN 8 WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 1 END WHEN 'hexagonal' THEN CASE WHEN z = 0 THEN 24 ELSE 12 END WHEN 'trigonal' THEN CASE WHEN z = 0 THEN 12 ELSE 6 END
   WHEN 'monoclinic' THEN CASE WHEN k = 0 THEN 2 ELSE 4 END WHEN 'triclinic' THEN 2 ELSE 1 END"""


@query(
    "multiplicities",
    f"""SELECT id, h, k, l, CAST({_MULT} AS INTEGER) AS multiplicity FROM (SELECT id, x.h AS h, x.k AS k, x.l AS l, {_SYSTEM.format("sg_number")} AS system, CAST(x.h = 0 AS INT) + CAST(x.k = 0 AS INT) + CAST(x.l = 0 AS INT) AS z
       FROM ({_FLAT}))""",
)
def multiplicities(spark, sf_dir):
    return _flat(spark, sf_dir).select("id", "h", "k", "l", cr.multiplicity("h", "k", "l", cr.crystal_system("sg_number")).alias("multiplicity"))


@query(
    "intensity_norm",
    f"""SELECT id, h, k, l, CASE WHEN top > 0 THEN round(100 * raw / top, 2) ELSE 0.0 END AS intensity_norm FROM (SELECT *, max(raw) OVER (PARTITION BY id) AS top FROM
       (SELECT id, x.h AS h, x.k AS k, x.l AS l, x.multiplicity * x.f_sq AS raw FROM ({_FLAT}))) WHERE raw IS NOT NULL""",
)
def intensity_norm(spark, sf_dir):
    """Line weights of a run scaled to its strongest line."""
    raw = F.col("multiplicity") * F.col("f_sq")
    flat = _flat(spark, sf_dir).withColumn("raw", raw).where("raw IS NOT NULL")
    # A run has at most tens of lines, so the window's partitions are small.
    from pyspark.sql import Window

    top = F.max("raw").over(Window.partitionBy("id"))
    return flat.select("id", "h", "k", "l", F.when(top > 0, r(100.0 * F.col("raw") / top, 2)).otherwise(0.0).alias("intensity_norm"))


@query(
    "profile_sum",
    f"""WITH {_BEST}, f AS (SELECT cod_id, x.two_theta AS c, x.intensity_rel AS i, sqrt(greatest(0.01 * tan(radians(x.two_theta / 2))**2 - 0.002 * tan(radians(x.two_theta / 2)) + 0.005, 1e-8)) AS w
              FROM (SELECT cod_id, unnest(reflections) AS x FROM best) WHERE x.intensity_rel > 0),
         g AS (SELECT CAST(unnest([{", ".join(map(str, _GRID))}]) AS DOUBLE) AS tth)
       SELECT cod_id, tth, round(sum(i * (0.5 / (1 + (2 * (tth - c) / w)**2) + 0.5 * exp(-ln(2) * (2 * (tth - c) / w)**2))), 5) AS icalc FROM f, g GROUP BY cod_id, tth""",
)
def profile_sum(spark, sf_dir):
    """Calculated intensity of every structure's best pattern on a coarse grid, without Python."""
    lines = search.best_patterns(table(spark, sf_dir, "reference_patterns")).select("cod_id", F.explode("reflections").alias("x")).where("x.intensity_rel > 0")
    lines = lines.select("cod_id", F.col("x.two_theta").alias("c"), F.col("x.intensity_rel").alias("i"), F.explode(F.array(*[F.lit(float(g)) for g in _GRID])).alias("tth"))
    return lines.groupBy("cod_id", "tth").agg(r(F.sum(F.col("i") * cr.pseudo_voigt("tth", "c", cr.caglioti_fwhm("c"))), 5).alias("icalc"))


_WEIGHTS = ", ".join(f"('{e}', {w})" for e, w in zip(ch.ELEMENTS, ch.WEIGHTS, strict=False))
_MASS = f"""w(e, m) AS (VALUES {_WEIGHTS}), tok AS (SELECT file AS cod_id, unnest(regexp_extract_all(formula, '[A-Z][a-z]?\\d*\\.?\\d*')) AS t FROM cod_data),
   mass AS (SELECT cod_id, sum(coalesce(try_cast(regexp_extract(t, '(\\d*\\.?\\d*)$', 1) AS DOUBLE), 1.0) * m) AS mass FROM tok LEFT JOIN w ON e = regexp_extract(t, '^([A-Z][a-z]?)', 1) GROUP BY cod_id HAVING bool_and(m IS NOT NULL))"""


@query("molar_mass", f"WITH {_MASS} SELECT d.file AS cod_id, round(mass, 4) AS mass, round(CAST(d.z AS DOUBLE) * mass / (d.vol * 0.602214076), 5) AS density FROM cod_data d LEFT JOIN mass ON mass.cod_id = d.file")
def molar_mass(spark, sf_dir):
    """Molar mass and density of every structure."""
    s = structures(spark, sf_dir).withColumn("mass", ch.molar_mass("formula"))
    return s.select("cod_id", r("mass", 4).alias("mass"), r(ch.density("z", "mass", "vol"), 5).alias("density"))


_CM = ", ".join(f"('{e}', {', '.join(map(str, c))})" for e, c in ch.CROMER_MANN.items())
_Z = ", ".join(f"('{e}', {i + 1})" for i, e in enumerate(ch.ELEMENTS))


_SITES = """st AS (SELECT DISTINCT cod_id, label, regexp_extract(coalesce(trim(type_symbol), ''), '^([A-Z][a-z]?)', 1) AS e, coalesce(fract_x, 0) AS x, coalesce(fract_y, 0) AS y, coalesce(fract_z, 0) AS z,
                CASE WHEN coalesce(occupancy, 0) = 0 THEN 1.0 ELSE occupancy END AS occ, greatest(coalesce(u_iso_or_equiv, 0), 0) AS u FROM atomic_sites)"""
_AMPLITUDES = """SELECT ln.*, 2 * pi() * (h * st.x + k * st.y + l * st.z) AS ph, st.occ * exp(-8 * pi() * pi() * st.u / (4 * d * d)) *
                 CASE WHEN st.e = '' THEN 1.0 WHEN cm.e IS NOT NULL THEN a1 * exp(-b1 / (4*d*d)) + a2 * exp(-b2 / (4*d*d)) + a3 * exp(-b3 / (4*d*d)) + a4 * exp(-b4 / (4*d*d)) + c0 ELSE coalesce(zz.z, 1) * exp(-3 / (4*d*d)) END AS f
                 FROM ln JOIN st ON st.cod_id = ln.cod_id LEFT JOIN cm ON cm.e = st.e LEFT JOIN zz ON zz.e = st.e"""


@query(
    "structure_factor",
    f"""WITH cm(e, a1, a2, a3, a4, b1, b2, b3, b4, c0) AS (VALUES {_CM}), zz(e, z) AS (VALUES {_Z}), {_BEST},
         ln AS (SELECT cod_id, x.h AS h, x.k AS k, x.l AS l, x.d_hkl AS d FROM (SELECT cod_id, unnest(reflections) AS x FROM best) WHERE x.d_hkl > 0),
         {_SITES},
         amp AS ({_AMPLITUDES})
       SELECT cod_id, h, k, l, d, round(sum(f * cos(ph))**2 + sum(f * sin(ph))**2, 3) AS f_sq FROM amp GROUP BY cod_id, h, k, l, d""",
)
def structure_factor(spark, sf_dir):
    """Squared structure factors of the lines of every structure that has sites."""
    lines = search.best_patterns(table(spark, sf_dir, "reference_patterns")).select("cod_id", F.explode("reflections").alias("x")).select("cod_id", "x.h", "x.k", "x.l", F.col("x.d_hkl").alias("d")).where("d > 0").distinct()
    return structure_factors(lines, table(spark, sf_dir, "atomic_sites")).where("f_sq IS NOT NULL").withColumn("f_sq", r("f_sq", 3))


_LP = "(1 + cos(radians(tt))**2) / (sin(radians(tt / 2))**2 * cos(radians(tt / 2)))"


@query(
    "calculated_patterns",
    f"""WITH cm(e, a1, a2, a3, a4, b1, b2, b3, b4, c0) AS (VALUES {_CM}), zz(e, z) AS (VALUES {_Z}), {_CELLS}, {_GRID_LINES},
         ln AS (SELECT cod_id, h, k, l, d, tt, system, CAST(h = 0 AS INT) + CAST(k = 0 AS INT) + CAST(l = 0 AS INT) AS z FROM f WHERE n = 1),
         {_SITES},
         fs AS (SELECT cod_id, h, k, l, sum(f * cos(ph))**2 + sum(f * sin(ph))**2 AS f_sq FROM ({_AMPLITUDES}) GROUP BY cod_id, h, k, l),
         w AS (SELECT ln.*, fs.f_sq * {_MULT} * {_LP} AS raw FROM ln LEFT JOIN fs USING (cod_id, h, k, l)),
         x AS (SELECT *, max(raw) OVER (PARTITION BY cod_id) AS top FROM w)
       SELECT cod_id, CAST(count(*) AS INTEGER) AS n_reflections, coalesce(bool_or(raw IS NOT NULL), false) AS has_intensities, CAST(max(CASE WHEN raw IS NULL THEN 0.0 WHEN top > 0 THEN round(100 * raw / top, 2) ELSE 0.0 END) AS DOUBLE) AS strongest,
         round(sum(CASE WHEN top > 0 THEN 100 * raw / top END), 3) AS total FROM x GROUP BY cod_id""",
)
def calculated_patterns(spark, sf_dir):
    """Patterns with intensities of every structure over the whole index grid, from cells and sites."""
    out = calculate_patterns(structures(spark, sf_dir), table(spark, sf_dir, "atomic_sites"), cr.CU_KA, exact=True)
    strongest = F.aggregate("reflections", F.lit(0.0), lambda m, x: F.greatest(m, F.coalesce(x["intensity_rel"], F.lit(0.0))))
    return out.select("cod_id", "n_reflections", "has_intensities", r(strongest, 2).alias("strongest"), r("total_intensity", 3).alias("total"))


@query(
    "wavelengths",
    """SELECT file AS cod_id, CASE WHEN wavelength > 0.1 THEN wavelength ELSE 1.54056 END AS wavelength, CASE WHEN wavelength > 0.1 THEN coalesce(nullif(radsymbol, ''), printf('%.5fÅ', wavelength)) ELSE 'CuKα' END AS rad_symbol,
       CASE WHEN wavelength > 0.1 THEN 'cod' ELSE 'default_CuKa' END AS source FROM cod_data""",
)
def wavelengths(spark, sf_dir):
    """Wavelength, label and source used for every structure's pattern."""
    return structures(spark, sf_dir).select("cod_id", cr.resolve_wavelength("wavelength", "radsymbol").alias("w")).select("cod_id", "w.*")


# ---- fits -----------------------------------------------------------------------------------------------------------

_HOURS = "SELECT event_type AS scan_id, CAST(epoch(date_trunc('hour', ts)) / 3600 - epoch(TIMESTAMP '2024-01-01') / 3600 AS DOUBLE) / 10 AS tth, CAST(count(*) AS DOUBLE) AS iobs FROM events WHERE ts IS NOT NULL GROUP BY 1, 2"


def event_points(spark, sf_dir) -> DataFrame:
    """Hourly event counts per type, seen as scans: angle = tenth of the hour, sigma = root of the count."""
    hours = (F.unix_timestamp(F.date_trunc("hour", F.col("ts").cast("timestamp"))) - F.lit(1704067200)) / 3600
    p = table(spark, sf_dir, "events").where("ts IS NOT NULL").groupBy(F.col("event_type").alias("scan_id"), (hours / 10).alias("tth")).agg(F.count(F.lit(1)).cast("double").alias("iobs"))
    return p.withColumn("sigma", F.sqrt(F.greatest("iobs", F.lit(1.0))))


@query(
    "fom_per_scan",
    f"""WITH p AS ({_HOURS}), q AS (SELECT *, greatest(iobs, 1) AS s2, avg(iobs) OVER (PARTITION BY scan_id) AS icalc FROM p),
         a AS (SELECT scan_id, sum((iobs - icalc)**2 / s2) AS chi, sum(iobs**2 / s2) AS wi, sum(abs(iobs - icalc)) AS ad, sum(iobs) AS ai, count(*) AS n FROM q GROUP BY scan_id)
       SELECT scan_id, round(sqrt(chi / wi), 6) AS rwp, round(ad / ai, 6) AS rp, round(sqrt((n - 5) / wi), 6) AS rexp, round(chi / (n - 5), 6) AS chi2, n AS n_points FROM a""",
)
def fom_per_scan(spark, sf_dir):
    """Figures of merit of a flat model of every scan."""
    p = event_points(spark, sf_dir)
    model = p.groupBy("scan_id").agg(F.avg("iobs").alias("icalc"))
    f = fit.figures_of_merit(p.join(model, "scan_id"), ["scan_id"], 5)
    return f.select("scan_id", *[r(c).alias(c) for c in ("rwp", "rp", "rexp", "chi2")], "n_points")


@query(
    "wls_line",
    f"""WITH p AS (SELECT *, 1 / greatest(iobs, 1) AS w FROM ({_HOURS})), s AS (SELECT scan_id, sum(w) AS w, sum(w * tth) AS x, sum(w * tth * tth) AS xx, sum(w * iobs) AS y, sum(w * tth * iobs) AS xy FROM p GROUP BY scan_id)
       SELECT scan_id, round((w * xy - x * y) / (w * xx - x * x), 6) AS slope, round((xx * y - x * xy) / (w * xx - x * x), 6) AS level FROM s""",
)
def wls_line(spark, sf_dir):
    """Weighted straight line through every scan, from the sums of the normal equations."""
    p = event_points(spark, sf_dir).withColumn("w", 1.0 / F.greatest(F.col("sigma") * F.col("sigma"), F.lit(1e-10)))
    t, i, w = F.col("tth"), F.col("iobs"), F.col("w")
    s = p.groupBy("scan_id").agg(F.sum(w).alias("w"), F.sum(w * t).alias("x"), F.sum(w * t * t).alias("xx"), F.sum(w * i).alias("y"), F.sum(w * t * i).alias("xy"))
    det = F.col("w") * F.col("xx") - F.col("x") * F.col("x")
    return s.select("scan_id", r((F.col("w") * F.col("xy") - F.col("x") * F.col("y")) / det).alias("slope"), r((F.col("xx") * F.col("y") - F.col("x") * F.col("xy")) / det).alias("level"))


@query(
    "scan_statistics",
    f"SELECT scan_id, round(avg(iobs), 6) AS mean, round(stddev_pop(iobs), 6) AS spread, round(quantile_cont(sqrt(greatest(iobs, 1)), 0.5), 6) AS noise FROM ({_HOURS}) GROUP BY scan_id",
)
def scan_statistics(spark, sf_dir):
    """Mean, population spread and median error of every scan."""
    p = event_points(spark, sf_dir)
    return p.groupBy("scan_id").agg(r(F.avg("iobs")).alias("mean"), r(F.stddev_pop("iobs")).alias("spread"), r(F.median("sigma")).alias("noise"))


@query("scan_peaks")
def scan_peaks(spark, sf_dir):
    """Peaks of the event scans."""
    return fit.find_peaks(fit.scan_rows(event_points(spark, sf_dir)), prominence_sigma=2.0)


def simulated_scans(spark, sf_dir, every: int = 20, step: float = 0.05) -> DataFrame:
    """Scans calculated from the newest Cu pattern of every structure whose number is divisible by ``every``."""
    own = pipeline.radiation_patterns(table(spark, sf_dir, "reference_patterns")).where(F.col("cod_id") % every == 0)
    n = int(85 / step)
    lines = own.select(F.col("cod_id").alias("scan_id"), "reflections").withColumn("tth", F.explode(F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: 5.0 + i * step)))
    height = F.aggregate("reflections", F.lit(0.0), lambda s, x: s + F.coalesce(x["intensity_rel"], F.lit(0.0)) * cr.pseudo_voigt(F.col("tth"), x["two_theta"], cr.caglioti_fwhm(x["two_theta"])))
    points = lines.select("scan_id", "tth", (height * 50 + 100 + 2 * F.col("tth")).alias("iobs"))
    return points.withColumn("sigma", F.sqrt(F.greatest("iobs", F.lit(1.0))))


@query("identify_scans")
def identify_scans(spark, sf_dir):
    """Simulated scans identified against all patterns: fits of the candidates, ranked.

    One match is enough: a simulated scan has as many lines as its stored pattern, mostly one or two.
    """
    out = pipeline.identify(simulated_scans(spark, sf_dir), table(spark, sf_dir, "reference_patterns"), min_matches=1)
    return out.select("scan_id", "cod_id", "n_matched", r("rwp", 4).alias("rwp"), r("chi2", 3).alias("chi2"), cr.fit_quality("rwp", "chi2").alias("quality"), "n_peaks", "rank")


@query("quantify_scans")
def quantify_scans(spark, sf_dir):
    """Weight fractions of the phases found in the simulated scans."""
    out = pipeline.quantify(simulated_scans(spark, sf_dir), table(spark, sf_dir, "reference_patterns"), structures(spark, sf_dir), min_matches=1)
    return out.select("scan_id", "cod_id", r("weight_pct", 3).alias("weight_pct"))


@query("dropped_scan_hits")
def dropped_scan_hits(spark, sf_dir):
    """Hits of the simulated scans that have no Cu pattern, so that identify_scans cannot fit them."""
    return pipeline.dropped(simulated_scans(spark, sf_dir), table(spark, sf_dir, "reference_patterns"), min_matches=1)


@query(
    "weight_fractions",
    f"""WITH {_MASS}, s AS (SELECT d.sgnumber AS scan_id, d.file AS cod_id, coalesce(d.gofall, 1.0) AS scale, d.z, m.mass, {_VOLUME.replace("(a *", "(d.a *")} AS volume FROM cod_data d LEFT JOIN mass m ON m.cod_id = d.file WHERE d.sgnumber IS NOT NULL),
         q AS (SELECT *, greatest(coalesce(CASE WHEN z > 0 THEN scale * z * mass * volume END, 0), 0) AS zmv FROM s)
       SELECT scan_id, cod_id, round(CASE WHEN t > 0 THEN 100 * zmv / t ELSE 0 END, 6) AS weight_pct FROM (SELECT *, sum(zmv) OVER (PARTITION BY scan_id) AS t FROM q)""",
)
def weight_fractions(spark, sf_dir):
    """Hill-Howard fractions of all structures of a space group, with their goodness of fit as scale."""
    s = structures(spark, sf_dir).where("sgnumber IS NOT NULL")
    scales = s.select(F.col("sgnumber").alias("scan_id"), "cod_id", F.coalesce("gofall", F.lit(1.0)).alias("scale"))
    return fit.weight_fractions(scales, s).select("scan_id", "cod_id", r("weight_pct").alias("weight_pct"))


@query(
    "dominant_phase",
    f"""WITH {_MASS}, s AS (SELECT d.sgnumber AS scan_id, d.file AS cod_id, coalesce(d.gofall, 1.0) AS scale, d.z, m.mass, {_VOLUME.replace("(a *", "(d.a *")} AS volume FROM cod_data d LEFT JOIN mass m ON m.cod_id = d.file WHERE d.sgnumber IS NOT NULL),
         q AS (SELECT *, greatest(coalesce(CASE WHEN z > 0 THEN scale * z * mass * volume END, 0), 0) AS zmv FROM s)
       SELECT scan_id, cod_id, round(CASE WHEN t > 0 THEN 100 * zmv / t ELSE 0 END, 6) AS weight_pct FROM (SELECT *, sum(zmv) OVER (PARTITION BY scan_id) AS t, row_number() OVER (PARTITION BY scan_id ORDER BY zmv DESC, cod_id) AS k FROM q) WHERE k = 1""",
)
def dominant_phase(spark, sf_dir):
    """The structure of most weight of every space group, by the fractions of weight_fractions."""
    s = structures(spark, sf_dir).where("sgnumber IS NOT NULL")
    scales = s.select(F.col("sgnumber").alias("scan_id"), "cod_id", F.coalesce("gofall", F.lit(1.0)).alias("scale"))
    return fit.dominant_phase(fit.weight_fractions(scales, s)).withColumn("weight_pct", r("weight_pct"))


# ---- catalogue queries ----------------------------------------------------------------------------------------------

_GOOD = "status IS NULL AND onhold IS NULL AND radiation = 'X-ray' AND (method IS NULL OR method <> 'theoretical') AND flags LIKE '%has coordinates%'"


@query("catalog_quality", f"SELECT file, formula, sg, a, b, c, vol, robs FROM cod_data WHERE {_GOOD} AND (robs < 0.08 OR (robs IS NULL AND rfsqd < 0.10))")
def catalog_quality(spark, sf_dir):
    return cat.quality_listing(table(spark, sf_dir, "cod_data")).select("file", "formula", "sg", "a", "b", "c", "vol", "robs")


@query("catalog_by_system", f"SELECT {_SYSTEM.format('sgnumber')} AS system, count(*) AS n, round(avg(vol), 4) AS mean_vol, min(robs) AS best_robs FROM cod_data WHERE status IS NULL AND radiation = 'X-ray' GROUP BY 1")
def catalog_by_system(spark, sf_dir):
    d = table(spark, sf_dir, "cod_data").where("status IS NULL AND radiation = 'X-ray'")
    return d.groupBy(cr.crystal_system("sgnumber").alias("system")).agg(F.count(F.lit(1)).alias("n"), r(F.avg("vol"), 4).alias("mean_vol"), F.min("robs").alias("best_robs"))


@query(
    "catalog_phase_search",
    f"""SELECT q, file, k FROM (SELECT q.file AS q, d.file, CAST(row_number() OVER (PARTITION BY q.file ORDER BY d.robs ASC NULLS LAST, d.file) AS INTEGER) AS k
        FROM (SELECT file, sgnumber, vol FROM cod_data WHERE file % 20 = 0) q JOIN cod_data d ON d.sgnumber = q.sgnumber AND d.vol BETWEEN q.vol * 0.98 AND q.vol * 1.02
        WHERE {_GOOD} AND (d.celltemp IS NULL OR d.celltemp BETWEEN 250 AND 320) AND (d.cellpressure IS NULL OR d.cellpressure < 200)) WHERE k <= 20""",
)
def catalog_phase_search(spark, sf_dir):
    """For every structure whose number is divisible by 20: the 20 best ambient structures of its space group with a
    volume within 2 %, by R factor (nulls last)."""
    d = table(spark, sf_dir, "cod_data")
    return cat.phase_search(d, d.where("file % 20 = 0").select(F.col("file").alias("q"), "sgnumber", "vol"))


@query("catalog_name_search", "SELECT file, mineral, commonname, chemname FROM cod_data WHERE mineral ILIKE '%lite%' OR commonname ILIKE '%lite%' OR chemname ILIKE '%oxide%'")
def catalog_name_search(spark, sf_dir):
    return table(spark, sf_dir, "cod_data").where("mineral ILIKE '%lite%' OR commonname ILIKE '%lite%' OR chemname ILIKE '%oxide%'").select("file", "mineral", "commonname", "chemname")


@query("catalog_powder", "SELECT file, formula, sg, wavelength, doi, CASE WHEN doi IS NOT NULL THEN 'https://doi.org/' || doi END AS link FROM cod_data WHERE method = 'powder diffraction' AND status IS NULL AND wavelength BETWEEN 1.5 AND 1.6")
def catalog_powder(spark, sf_dir):
    d = cat.powder_structures(table(spark, sf_dir, "cod_data"))
    return d.select("file", "formula", "sg", "wavelength", "doi", cat.doi_link().alias("link"))


@query("density_proxy", "SELECT file, round(CAST(z AS DOUBLE) / nullif(vol, 0), 8) AS proxy FROM cod_data WHERE mineral LIKE '%ite'")
def density_proxy(spark, sf_dir):
    return table(spark, sf_dir, "cod_data").where("mineral LIKE '%ite'").select("file", r(cat.density_proxy(), 8).alias("proxy"))


@query("canonical_structures", "SELECT d.file, coalesce(o.file, d.file) AS canonical FROM cod_data d LEFT JOIN cod_data o ON o.file = coalesce(d.duplicateof, d.optimal)")
def canonical_structures(spark, sf_dir):
    """The record that stands for each structure: the one it duplicates or its better one, if that exists."""
    return cat.canonical(table(spark, sf_dir, "cod_data"))


_STEM = "regexp_replace(w, '(ing|ed|es|s)$', '')"


@query(
    "title_search",
    f"""SELECT file FROM (SELECT file, list_transform(regexp_extract_all(lower(title), '[a-z]+'), lambda w: {_STEM}) AS t FROM cod_data WHERE title IS NOT NULL) WHERE list_contains(t, 'crystal') AND list_contains(t, 'structure')
        UNION ALL SELECT file FROM (SELECT file, list_transform(regexp_extract_all(lower(title), '[a-z]+'), lambda w: {_STEM}) AS t FROM cod_data WHERE title IS NOT NULL) WHERE list_contains(t, 'powder') AND list_contains(t, 'cool')""",
)
def title_search(spark, sf_dir):
    """Titles that hold all words of a question, after cutting common endings (approximate stemming)."""
    d = table(spark, sf_dir, "cod_data")
    return cat.text_search(d, "title", "crystals structure").select("file").unionAll(cat.text_search(d, "title", "powder cooling").select("file"))


@query(
    "peaks_near_angle",
    f"SELECT cod_id, id, x.h || ' ' || x.k || ' ' || x.l AS hkl, x.two_theta AS two_theta, x.intensity_rel AS intensity_rel FROM ({_FLAT}) WHERE x.two_theta BETWEEN 26.4 AND 26.8 AND x.intensity_rel >= 50",
)
def peaks_near_angle(spark, sf_dir):
    """Strong lines near an angle."""
    return _flat(spark, sf_dir).where("two_theta BETWEEN 26.4 AND 26.8 AND intensity_rel >= 50").select("cod_id", "id", F.concat_ws(" ", "h", "k", "l").alias("hkl"), "two_theta", "intensity_rel")


@query("sites_by_element", "SELECT cod_id, regexp_extract(coalesce(trim(type_symbol), ''), '^([A-Z][a-z]?)', 1) AS element, count(*) AS n, round(sum(occupancy), 6) AS occupancy, count(DISTINCT wyckoff_symbol) AS n_wyckoff FROM (SELECT DISTINCT * FROM atomic_sites) GROUP BY 1, 2")
def sites_by_element(spark, sf_dir):
    s = table(spark, sf_dir, "atomic_sites").distinct()
    return s.groupBy("cod_id", ch.element_symbol("type_symbol").alias("element")).agg(F.count(F.lit(1)).alias("n"), r(F.sum("occupancy")).alias("occupancy"), F.countDistinct("wyckoff_symbol").alias("n_wyckoff"))


@query(
    "sites_first_seen",
    "SELECT cod_id, label, fract_x, fract_y, fract_z FROM (SELECT *, row_number() OVER (PARTITION BY cod_id, label ORDER BY fract_x NULLS FIRST, fract_y NULLS FIRST, fract_z NULLS FIRST) AS k FROM atomic_sites) WHERE k = 1",
)
def sites_first_seen(spark, sf_dir):
    """One row per site label of a structure."""
    s = table(spark, sf_dir, "atomic_sites").select("cod_id", "label", "fract_x", "fract_y", "fract_z")
    return relational.first_seen(s, ["cod_id", "label"], ["fract_x", "fract_y", "fract_z"])


@query("diag_tiers", "SELECT CASE WHEN coalesce(n_reflections, 0) <= 500 THEN 'SMALL' WHEN n_reflections <= 2000 THEN 'MEDIUM' ELSE 'LARGE' END AS tier, count(*) AS n, round(avg(t_calc_s), 2) AS calc_s, round(avg(rss_delta_mb), 2) AS rss_mb FROM reference_patterns_pymatgen GROUP BY 1")
def diag_tiers(spark, sf_dir):
    p = table(spark, sf_dir, "reference_patterns_pymatgen")
    return p.groupBy(relational.size_tier("n_reflections").alias("tier")).agg(F.count(F.lit(1)).alias("n"), r(F.avg("t_calc_s"), 2).alias("calc_s"), r(F.avg("rss_delta_mb"), 2).alias("rss_mb"))


@query(
    "peaks_with_names",
    f"""SELECT p.cod_id, d.formula, d.mineral, x.h AS h, x.k AS k, x.l AS l, x.two_theta AS two_theta, x.intensity_rel AS intensity_rel FROM ({_FLAT}) p JOIN cod_data d ON d.file = p.cod_id
       WHERE p.wavelength BETWEEN 1.535 AND 1.546 AND x.intensity_rel >= 90""",
)
def peaks_with_names(spark, sf_dir):
    """Strong lines of Cu patterns with the names of their structures."""
    flat = _flat(spark, sf_dir).where("wavelength BETWEEN 1.535 AND 1.546 AND intensity_rel >= 90")
    return flat.join(structures(spark, sf_dir).select("cod_id", "formula", "mineral"), "cod_id").select("cod_id", "formula", "mineral", "h", "k", "l", "two_theta", "intensity_rel")


@query(
    "family_multiplicity",
    """WITH t AS (SELECT DISTINCT id, cod_id, CAST(reflections AS JSON) AS j FROM reference_patterns_pymatgen WHERE json_valid(reflections)),
         u AS (SELECT id, CASE WHEN json_type(j) = 'VARCHAR' AND json_valid(j ->> '$') THEN CAST(j ->> '$' AS JSON) ELSE j END AS j FROM t),
         a AS (SELECT id, CASE WHEN json_type(j) = 'ARRAY' THEN j ELSE coalesce(j -> '$.lines', j -> '$.pattern.lines') END AS j FROM u),
         l AS (SELECT id, i AS line_no, j -> ('$[' || i || ']') AS e FROM (SELECT *, unnest(range(CAST(json_array_length(j) AS BIGINT))) AS i FROM a WHERE json_type(j) = 'ARRAY')),
         fa AS (SELECT id, line_no, CASE WHEN json_type(f) = 'OBJECT' THEN json_array(f) ELSE f END AS f FROM (SELECT id, line_no, coalesce(e -> '$.families', e -> '$.hkl_families') AS f FROM l WHERE json_type(e) = 'OBJECT')),
         f AS (SELECT id, line_no, f -> ('$[' || i || ']') AS e FROM (SELECT *, unnest(range(CAST(json_array_length(f) AS BIGINT))) AS i FROM fa WHERE json_type(f) = 'ARRAY'))
       SELECT id, CAST(line_no AS INTEGER) AS line_no, count(*) AS n_families, CAST(sum(CAST(TRY_CAST(e ->> '$.multiplicity' AS DOUBLE) AS INTEGER)) AS BIGINT) AS multiplicity FROM f WHERE json_type(e) <> 'NULL' GROUP BY 1, 2""",
)
def family_multiplicity(spark, sf_dir):
    """Multiplicity of every line that has families: the sum over them."""
    return family_multiplicities(table(spark, sf_dir, "reference_patterns_pymatgen")).select("id", "line_no", "n_families", "multiplicity")


@query(
    "catalog_cell_search",
    """SELECT q.file AS q, d.file FROM (SELECT file, a, b, c FROM cod_data WHERE file % 20 = 0 AND a > 0 AND b > 0 AND c > 0) q
       JOIN cod_data d ON d.a BETWEEN q.a * (1 - 0.01) AND q.a * (1 + 0.01) AND d.b BETWEEN q.b * (1 - 0.01) AND q.b * (1 + 0.01) AND d.c BETWEEN q.c * (1 - 0.01) AND q.c * (1 + 0.01)""",
)
def catalog_cell_search(spark, sf_dir):
    """For every structure whose number is divisible by 20: structures of cell lengths within 1 %."""
    d = table(spark, sf_dir, "cod_data")
    return cat.cell_search(d, d.where("file % 20 = 0").select(F.col("file").alias("q"), "a", "b", "c"))


@query("catalog_recent", "SELECT file, year, sigvol, vol, gofall FROM cod_data WHERE year > 1990 AND (sigvol / nullif(vol, 0) < 0.005 OR sigvol IS NULL) AND gofall < 2.0")
def catalog_recent(spark, sf_dir):
    """Recent, consistent structures of a small or untold error of the volume."""
    d = table(spark, sf_dir, "cod_data")
    return d.where(cat.since() & (cat.well_determined() | F.col("sigvol").isNull()) & cat.consistent()).select("file", "year", "sigvol", "vol", "gofall")


@query(
    "spacegroup_settings",
    """SELECT d.file, s.hm, s.class FROM cod_data d JOIN (SELECT DISTINCT sgnumber AS itcn, sg AS hm, """
    + _SYSTEM.format("sgnumber")
    + """ AS class FROM cod_data WHERE sgnumber IS NOT NULL AND sg IS NOT NULL) s ON d.sgnumber = s.itcn WHERE s.class = 'cubic' AND d.status IS NULL AND d.radiation = 'X-ray'""",
)
def spacegroup_settings(spark, sf_dir):
    """Clean cubic structures with every setting of their space group that the catalogue uses."""
    d = table(spark, sf_dir, "cod_data")
    settings = d.where("sgnumber IS NOT NULL AND sg IS NOT NULL").select(F.col("sgnumber").alias("itcn"), F.col("sg").alias("hm"), cr.crystal_system("sgnumber").alias("class")).distinct()
    return cat.with_spacegroups(cat.by_system(d, "cubic").select("file", "sgnumber"), settings).select("file", "hm", "class")


@query("diag_buckets", "SELECT CAST(floor(n_reflections / 10.0) * 10 AS INTEGER) AS bucket, count(*) AS n, max(n_reflections) AS largest FROM reference_patterns GROUP BY 1")
def diag_buckets(spark, sf_dir):
    return table(spark, sf_dir, "reference_patterns").groupBy((F.floor(F.col("n_reflections") / 10.0) * 10).cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.max("n_reflections").alias("largest"))


@query("diag_failures", "SELECT status, left(error_msg, 12) AS message, count(*) AS n FROM failed_patterns_pymatgen GROUP BY 1, 2")
def diag_failures(spark, sf_dir):
    return table(spark, sf_dir, "failed_patterns_pymatgen").groupBy("status", F.left("error_msg", F.lit(12)).alias("message")).agg(F.count(F.lit(1)).alias("n"))


@query("json_extract_agg", "SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS k FROM events GROUP BY 1")
def json_extract_agg(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.get_json_object("props", "$.k").try_cast("int")).alias("k"))


@query(
    "fingerprint_tanimoto",
    """WITH b AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits FROM embeddings),
         p AS (SELECT q.vec_id AS q, o.vec_id AS other, list_sum(list_transform(list_zip(q.bits, o.bits), lambda z: z[1] * z[2])) AS inter, list_sum(q.bits) + list_sum(o.bits) AS total FROM b q JOIN b o ON q.vec_id % 20 = 0 AND o.vec_id <> q.vec_id)
       SELECT q, other, round(inter / (total - inter), 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY inter / (total - inter) DESC, other) AS k FROM p) WHERE k <= 5""",
)
def fingerprint_tanimoto(spark, sf_dir):
    """For every vector whose id is divisible by 20: the five most similar others by Tanimoto over sign bits.

    Sign bits are packed into a 64-bit word.
    """
    word = F.expr("aggregate(transform(embedding, (x, i) -> CASE WHEN x > 0 THEN shiftleft(1L, i) ELSE 0L END), 0L, (a, x) -> a | x)")
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), word.alias("w"))
    return cat.similar_bits(e, e.where("id % 20 = 0").withColumnRenamed("id", "q"), ["w"]).withColumn("similarity", r("similarity"))


# ---- upserts --------------------------------------------------------------------------------------------------------

_CUR = "cur AS (SELECT DISTINCT ON (snapshot_no, file) snapshot_no, file, svnrevision, formula, vol, journal FROM (SELECT DISTINCT snapshot_no, file, svnrevision, formula, vol, journal FROM cod_data_snapshots) ORDER BY snapshot_no, file, svnrevision DESC)"
_ENDS = "ends AS (SELECT min(snapshot_no) AS lo, max(snapshot_no) AS hi FROM cod_data_snapshots)"


def _ends(spark, sf_dir):
    t = table(spark, sf_dir, "cod_data_snapshots")
    lo, hi = t.agg(F.min("snapshot_no"), F.max("snapshot_no")).first()
    one = lambda n: relational.best_row(t.where(F.col("snapshot_no") == n), ["file"], ["svnrevision"], ["formula", "vol", "journal"])
    return one(lo), one(hi)


@query("upsert_snapshot", f"WITH {_CUR}, {_ENDS} SELECT file, formula, vol, journal FROM cur, ends WHERE snapshot_no = hi UNION ALL SELECT file, formula, vol, journal FROM cur, ends WHERE snapshot_no = lo AND file NOT IN (SELECT file FROM cur, ends WHERE snapshot_no = hi)")
def upsert_snapshot(spark, sf_dir):
    """The first delivery with the last one put in: the last write wins."""
    lo, hi = _ends(spark, sf_dir)
    return relational.upsert(lo, hi, ["file"])


@query("insert_ignore", f"WITH {_CUR}, {_ENDS} SELECT file, formula, vol, journal FROM cur, ends WHERE snapshot_no = lo UNION ALL SELECT file, formula, vol, journal FROM cur, ends WHERE snapshot_no = hi AND file NOT IN (SELECT file FROM cur, ends WHERE snapshot_no = lo)")
def insert_ignore(spark, sf_dir):
    """The first delivery and new files of the last one: the first write wins."""
    lo, hi = _ends(spark, sf_dir)
    return relational.insert_new(lo, hi, ["file"])


@query("replace_groups", f"WITH {_CUR}, {_ENDS} SELECT file, formula, vol, journal FROM cur, ends WHERE snapshot_no = hi UNION ALL SELECT file, formula, vol, journal FROM cur, ends WHERE snapshot_no = lo AND (journal IS NULL OR journal NOT IN (SELECT journal FROM cur, ends WHERE snapshot_no = hi AND journal IS NOT NULL))")
def replace_groups(spark, sf_dir):
    """The first delivery in which every journal that the last one mentions is replaced as a whole."""
    lo, hi = _ends(spark, sf_dir)
    return relational.replace_groups(lo, hi, ["journal"])


@query("stream_upsert", "SELECT file, snapshot_no, svnrevision, formula, vol, journal FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY snapshot_no DESC, svnrevision DESC) AS k FROM cod_data_snapshots) WHERE k = 1")
def stream_upsert(spark, sf_dir):
    """All deliveries, arriving as files, upserted by a stream; equals the batch result."""
    rows = table(spark, sf_dir, "cod_data_snapshots").select("file", "snapshot_no", "svnrevision", "formula", "vol", "journal")
    import uuid

    base = f"{shared_dir(spark)}/difframe-stream-{uuid.uuid4().hex}"
    rows.repartitionByRange(4, "snapshot_no").sortWithinPartitions("snapshot_no").write.parquet(f"{base}/in")
    upsert_stream(spark, f"{base}/in", rows.schema, f"{base}/table", ["file"], ["snapshot_no", "svnrevision"], f"{base}/checkpoint", fmt="parquet").awaitTermination()
    return stored(spark, f"{base}/table", rows.schema).drop(BUCKET)


# ---- sources, as round trips over the tables ------------------------------------------------------------------------


@query(
    "cif_sites",
    """SELECT cod_id, label, type_symbol, fract_x, fract_y, fract_z, occupancy, u_iso_or_equiv, wyckoff_symbol, site_symmetry FROM (SELECT DISTINCT cod_id, label, nullif(nullif(nullif(trim(type_symbol), ''), '.'), '?') AS type_symbol, fract_x, fract_y, fract_z, occupancy, u_iso_or_equiv,
       nullif(nullif(nullif(trim(wyckoff_symbol), ''), '.'), '?') AS wyckoff_symbol, nullif(nullif(nullif(trim(site_symmetry), ''), '.'), '?') AS site_symmetry FROM atomic_sites WHERE label IS NOT NULL AND cod_id IS NOT NULL AND trim(label) NOT IN ('', '.', '?'))""",
)
def cif_sites(spark, sf_dir):
    """Sites written as CIF texts and read back."""
    s = table(spark, sf_dir, "atomic_sites").where("label IS NOT NULL AND cod_id IS NOT NULL")
    names = ["label", "type_symbol", "fract_x", "fract_y", "fract_z", "occupancy", "u_iso_or_equiv", "wyckoff_symbol", "site_symmetry"]
    quoted = lambda c: F.coalesce(F.concat(F.lit("'"), F.col(c).cast("string"), F.lit("'")), F.lit("?"))
    head = "data_x\n# written by a query\nloop_\n" + "\n".join("_atom_site_" + {"wyckoff_symbol": "Wyckoff_symbol", "u_iso_or_equiv": "U_iso_or_equiv", "site_symmetry": "site_symmetry_symbol"}.get(n, n) for n in names) + "\n"
    line = F.concat_ws(" ", *[quoted(n) if n in ("label", "type_symbol", "wyckoff_symbol", "site_symmetry") else F.coalesce(F.col(n).cast("string"), F.lit(".")) for n in names])
    text = s.groupBy("cod_id").agg(F.concat(F.lit(head), F.array_join(F.sort_array(F.collect_set(line)), "\n"), F.lit("\nloop_\n_other\n1\n")).alias("value"))
    return cif.parse_sites(text).drop("pos")


@query("xye_points", f"SELECT scan_id || '.xye' AS scan_id, tth, iobs, sqrt(greatest(iobs, 1)) AS sigma FROM ({_HOURS}) WHERE scan_id IS NOT NULL")
def xye_points(spark, sf_dir):
    """The event scans written as text files' contents and read back."""
    line = F.concat_ws(" ", F.col("tth").cast("string"), F.col("iobs").cast("string"))
    text = event_points(spark, sf_dir).where("scan_id IS NOT NULL").groupBy("scan_id").agg(F.concat(F.lit("# tth iobs\n\nbad line here\n"), F.array_join(F.collect_list(line), "\n")).alias("value"))
    return diffractogram.parse_lines(text.select(F.concat("scan_id", F.lit(".xye")).alias("path"), "value")).drop("i")


@query("dump_rows", "SELECT file, formula, authors, journal, year, vol, title FROM cod_data")
def dump_rows(spark, sf_dir):
    """Catalogue rows written as a tab-separated dump and read back."""
    d = table(spark, sf_dir, "cod_data").select("file", "formula", "authors", "journal", "year", "vol", "title")
    out = lambda c: F.coalesce(F.replace(F.replace(F.replace(F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("\t"), F.lit("\\t")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")), F.lit("\\N"))
    return dump.parse_dump(d.select(F.concat_ws("\t", *[out(c) for c in d.columns]).alias("value")), d.schema).where("reason IS NULL").drop("reason")
