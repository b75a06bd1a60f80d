"""Queries of the readers, sinks and loads: rows of the given tables go out in a foreign form, are loaded again by the
engine's readers and compared with what SQL says about the tables; and of the fit of phases to scans."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from difframe import incremental, pipeline
from difframe.functions import crystal as cr
from difframe.operators import catalogue as cat
from difframe.operators import fit, relational, search
from difframe.plans.catalogue import query
from difframe.plans.reference import _BEST, _CUR, _ENDS, _HOURS, _LATEST, _PRINT, event_points, r, structures
from difframe.runtime import shared_dir, table
from difframe.sources import candidates, diffractogram, dump, sinks
from difframe.streaming.upsert import latest


def _folder(spark, label: str) -> str:
    return f"{shared_dir(spark)}/difframe-{label}-{uuid.uuid4().hex}"


# ---- readers --------------------------------------------------------------------------------------------------------


@query(
    "scan_files",
    f"""SELECT scan_id || ext AS scan_id, CAST(row_number() OVER (PARTITION BY scan_id, ext ORDER BY tth) - 1 AS INTEGER) AS i, tth, iobs, CASE WHEN ext = '.xye' THEN 0.5 + iobs ELSE sqrt(greatest(iobs, 1)) END AS sigma
       FROM ({_HOURS}), (SELECT unnest(['.xye', '.ASC', '.dat']) AS ext) WHERE scan_id IS NOT NULL""",
)
def scan_files(spark, sf_dir):
    """The event scans in three text forms: three columns, two with decimal commas and two, read by the file's name."""
    p = event_points(spark, sf_dir).where("scan_id IS NOT NULL")
    num = lambda c, comma=False: F.translate(F.col(c).cast("string"), ".", "," if comma else ".")
    forms = {
        ".xye": ("# tth iobs sigma\n", F.concat_ws("\t", num("tth"), num("iobs"), (F.col("iobs") + 0.5).cast("string"))),
        ".ASC": ("Sample 12 of\n\n", F.concat_ws("  ", num("tth", True), num("iobs", True))),
        ".dat": ("# two columns\nno numbers\n", F.concat_ws(" ", num("tth"), num("iobs"))),
    }
    files = None
    for ext, (head, line) in forms.items():
        text = p.groupBy("scan_id").agg(F.concat(F.lit(head), F.array_join(F.collect_list(line), "\r\n")).alias("value")).select(F.concat("scan_id", F.lit(ext)).alias("path"), "value")
        files = text if files is None else files.unionByName(text)
    return diffractogram.parse_lines(files)


@query(
    "candidates_csv",
    f"WITH {_BEST} SELECT cod_id, CAST(len(reflections) AS INTEGER) AS peak_matches, x.h AS h, x.k AS k, x.l AS l, x.d_hkl AS d_hkl, x.intensity_rel AS intensity_rel FROM (SELECT cod_id, reflections, unnest(reflections) AS x FROM best)",
)
def candidates_csv(spark, sf_dir):
    """The best patterns as a list of candidates in CSV, their lines as JSON, and read again; every seventh is torn."""
    best = search.best_patterns(table(spark, sf_dir, "reference_patterns"))
    text = F.to_json("reflections")
    torn = F.when(F.col("cod_id") % 7 == 0, F.regexp_replace(text, r'("h":-?\d)(\d)', "$1 $2")).otherwise(text)
    path = _folder(spark, "candidates")
    best.select("cod_id", F.size("reflections").alias("peak_matches"), torn.alias("reflections")).write.csv(path, header=True, escape='"')
    good, _ = candidates.read_candidates(spark, path)
    return good.select("cod_id", "peak_matches", F.explode("reflections").alias("x")).select("cod_id", "peak_matches", "x.h", "x.k", "x.l", "x.d_hkl", "x.intensity_rel")


@query(
    "prefilter_candidates",
    f"""WITH {_PRINT},
       win AS (SELECT cod_id AS scan_id, rank AS peak_no, 1.54056 / (2 * sin(radians((t + 0.2) / 2))) AS d_lo, 1.54056 / (2 * sin(radians(greatest(t - 0.2, 1e-6) / 2))) AS d_hi
               FROM (SELECT cod_id, rank, degrees(2 * asin(1.54056 / (2 * d_hkl))) AS t FROM prints WHERE rank <= 30 AND cod_id % 20 = 0 AND 1.54056 <= 2 * d_hkl)),
       hits AS (SELECT w.scan_id, p.cod_id, CAST(count(DISTINCT w.peak_no) AS INTEGER) AS n_matched FROM prints p JOIN win w ON p.d_hkl BETWEEN w.d_lo AND w.d_hi GROUP BY ALL)
       SELECT scan_id, cod_id, n_matched, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY scan_id ORDER BY n_matched DESC, -cod_id) AS rank FROM hits WHERE n_matched >= 2) WHERE rank <= 20""",
)
def prefilter_candidates(spark, sf_dir):
    """A list of candidates searched in the order it came in: here by descending number."""
    patterns = table(spark, sf_dir, "reference_patterns")
    listed = search.best_patterns(patterns).select("cod_id", "reflections", (-F.col("cod_id")).alias("position"))
    peaks = search.fingerprints(patterns).where("cod_id % 20 = 0").select(F.col("cod_id").alias("scan_id"), F.col("rank").alias("peak_no"), cr.bragg_two_theta("d_hkl").alias("two_theta")).where("two_theta IS NOT NULL")
    return search.prefilter(listed, peaks, min_matches=2, top=20).select("scan_id", "cod_id", "n_matched", "rank")


@query("cross_links", "SELECT d.file, p.id AS ext_id, 'https://example.org/p/' || p.id AS link FROM cod_data d JOIN (SELECT DISTINCT id, cod_id FROM reference_patterns_pymatgen) p ON p.cod_id = d.file WHERE d.mineral IS NOT NULL")
def cross_links(spark, sf_dir):
    """Links from minerals to their entries elsewhere: here the second-generation patterns."""
    minerals = table(spark, sf_dir, "cod_data").where("mineral IS NOT NULL")
    references = table(spark, sf_dir, "reference_patterns_pymatgen").select(F.col("id").alias("ext_id"), "cod_id").distinct()
    return cat.cross_links(minerals, references, "https://example.org/p/")


# ---- sinks and loads ------------------------------------------------------------------------------------------------


@query("fingerprint_table", f"WITH {_PRINT} SELECT cod_id, d_hkl, intensity_rel, two_theta_src, wavelength, rad_symbol, h, k, l, rank FROM prints WHERE rank <= 30")
def fingerprint_table(spark, sf_dir):
    """The fingerprint table written as a whole, in order of spacing, and read again."""
    path = _folder(spark, "fingerprints")
    sinks.write_fingerprints(table(spark, sf_dir, "reference_patterns"), path)
    return spark.read.parquet(path).drop("d_bin")


@query("results_jsonl", "SELECT cod_id, formula, n_reflections, t_calc_s FROM (SELECT DISTINCT id, cod_id, formula, n_reflections, t_calc_s FROM reference_patterns_pymatgen)")
def results_jsonl(spark, sf_dir):
    """Results appended as JSON lines in two steps and read again."""
    columns, path = ["cod_id", "formula", "n_reflections", "t_calc_s"], _folder(spark, "results")
    rows = table(spark, sf_dir, "reference_patterns_pymatgen").select("id", *columns).distinct()
    for part in (F.col("id") % 2 == 0, (F.col("id") % 2 != 0) | F.col("id").isNull()):
        sinks.append_jsonl(rows.where(part), path, columns)
    return spark.read.schema(T.StructType([rows.schema[c] for c in columns])).json(path)


@query(
    "settled_failures",
    """WITH bad AS (SELECT file AS cod_id, CASE WHEN title LIKE '%TimeoutError%' THEN 'TIMEOUT' ELSE 'FAILED' END AS status, title AS error_msg FROM cod_data WHERE status = 'errors' OR status = 'retracted')
       SELECT * FROM bad UNION ALL SELECT DISTINCT cod_id, status, error_msg FROM failed_patterns_pymatgen WHERE cod_id NOT IN (SELECT cod_id FROM bad)""",
)
def settled_failures(spark, sf_dir):
    """The failures after another run, in which all flagged structures fail: the last failure of a structure stays."""
    failures = table(spark, sf_dir, "failed_patterns_pymatgen").dropDuplicates(["cod_id", "status", "error_msg"])
    results = structures(spark, sf_dir).where("status = 'errors' OR status = 'retracted'").select("cod_id", F.lit("error").alias("status"), F.col("title").alias("error_msg"))
    patterns = table(spark, sf_dir, "reference_patterns_pymatgen").select("cod_id")
    return sinks.settle(results, patterns, failures, ["cod_id"])[1].select("cod_id", "status", "error_msg")


@query(
    "run_progress",
    """SELECT n_ok, n_failed, (n_ok + n_failed) / 600.0 AS rate, round((total - n_ok - n_failed) / ((n_ok + n_failed) / 600.0), 3) AS eta_s
       FROM (SELECT count(DISTINCT id) AS n_ok FROM reference_patterns_pymatgen), (SELECT count(DISTINCT cod_id) AS n_failed FROM failed_patterns_pymatgen), (SELECT count(*) AS total FROM cod_data)""",
)
def run_progress(spark, sf_dir):
    """Counters, rate and remaining time of a run that has taken ten minutes."""
    done = table(spark, sf_dir, "reference_patterns_pymatgen").where("id IS NOT NULL").select("id").distinct()
    failed = table(spark, sf_dir, "failed_patterns_pymatgen").where("cod_id IS NOT NULL").select("cod_id").distinct()
    return sinks.progress(spark, done, failed, table(spark, sf_dir, "cod_data").count(), 600.0).withColumn("eta_s", r("eta_s", 3))


@query(
    "incremental_load",
    f"WITH {_CUR}, {_ENDS} SELECT file, formula, vol, journal FROM cur, ends WHERE snapshot_no = hi UNION ALL SELECT file, formula, vol, journal FROM cur, ends WHERE snapshot_no = lo AND file NOT IN (SELECT file FROM cur, ends WHERE snapshot_no = hi)",
)
def incremental_load(spark, sf_dir):
    """The first and the last delivery as dumps, loaded as two revisions: after a dry run, and the second one twice; types
    and key come from a table definition."""
    t = table(spark, sf_dir, "cod_data_snapshots")
    lo, hi = t.agg(F.min("snapshot_no"), F.max("snapshot_no")).first()
    base, columns = _folder(spark, "incremental"), ["file", "formula", "vol", "journal"]
    ddl = "-- data; (catalogue)\nCREATE TABLE IF NOT EXISTS `data` (\n `file` int(11) NOT NULL COMMENT 'number (unique), 7 digits',\n `formula` varchar(255) DEFAULT NULL,\n `vol` double, `journal` text,\n PRIMARY KEY (`file`), KEY `v` (`vol`)\n) ENGINE=MyISAM;"
    spark.createDataFrame([(ddl,)], "value string").coalesce(1).write.text(f"{base}-ddl")
    schemas, keys = dump.read_schemas(spark, f"{base}-ddl")
    for revision, n in enumerate((lo, hi, hi), 1):
        rows = relational.best_row(t.where(F.col("snapshot_no") == n), ["file"], ["svnrevision"], columns[1:])
        path = f"{base}-dump{revision}"
        _dump_lines(rows.select(*columns)).write.text(path)
        for dry in (True, False):
            incremental.update(spark, {"data": path}, schemas, keys, base, min(revision, 2), dry_run=dry)
    return latest(spark, f"{base}/data", schemas["data"])


def _dump_lines(df: DataFrame) -> DataFrame:
    """Rows as lines of a tab-separated dump."""
    escaped = lambda c: F.replace(F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\t"), F.lit("\\t")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    return df.select(F.concat_ws("\t", *[F.coalesce(escaped(F.col(c).cast("string")), F.lit("\\N")) for c in df.columns]).alias("value"))


# ---- fits -----------------------------------------------------------------------------------------------------------


@query(
    "scan_maxima",
    f"""WITH p AS (SELECT scan_id, tth, iobs AS y, row_number() OVER (PARTITION BY scan_id ORDER BY tth) - 1 AS i, sqrt(greatest(iobs, 1)) AS e FROM ({_HOURS}) WHERE scan_id IS NOT NULL),
         g AS (SELECT *, sum(new) OVER (PARTITION BY scan_id ORDER BY i) AS run FROM (SELECT *, CASE WHEN y = lag(y) OVER (PARTITION BY scan_id ORDER BY i) THEN 0 ELSE 1 END AS new FROM p)),
         u AS (SELECT *, lag(y) OVER (PARTITION BY scan_id ORDER BY s) AS before, lead(y) OVER (PARTITION BY scan_id ORDER BY s) AS after FROM (SELECT scan_id, run, min(i) AS s, max(i) AS t, any_value(y) AS y FROM g GROUP BY scan_id, run)),
         m AS (SELECT scan_id, (s + t) // 2 AS i, y FROM u WHERE y > before AND y > after),
         h AS (SELECT m.*, (SELECT coalesce(max(p.i), -1) FROM p WHERE p.scan_id = m.scan_id AND p.i < m.i AND p.y > m.y) AS l, (SELECT coalesce(min(p.i), 1000000000) FROM p WHERE p.scan_id = m.scan_id AND p.i > m.i AND p.y > m.y) AS r FROM m),
         b AS (SELECT h.*, (SELECT min(p.y) FROM p WHERE p.scan_id = h.scan_id AND p.i > h.l AND p.i <= h.i) AS lo, (SELECT min(p.y) FROM p WHERE p.scan_id = h.scan_id AND p.i >= h.i AND p.i < h.r) AS hi FROM h)
       SELECT b.scan_id, CAST(row_number() OVER (PARTITION BY b.scan_id ORDER BY b.i) - 1 AS INTEGER) AS peak_no, p.tth AS two_theta, p.y AS intensity FROM b JOIN p ON p.scan_id = b.scan_id AND p.i = b.i
       JOIN (SELECT scan_id, median(e) AS e FROM p GROUP BY scan_id) n ON n.scan_id = b.scan_id WHERE b.y - greatest(b.lo, b.hi) >= 2.0 * n.e""",
)
def scan_maxima(spark, sf_dir):
    """Peaks of the event scans by their prominence, however near to each other."""
    return fit.find_peaks(fit.scan_rows(event_points(spark, sf_dir).where("scan_id IS NOT NULL")), prominence_sigma=2.0, min_distance=0.0)


def _freed(of: str, by: int, keys: str) -> str:
    """SQL: ``of`` without its weighted share of the polynomial ``p{by}``, within ``keys``."""
    return f"{of} - p{by} * sum(w * {of} * p{by}) OVER ({keys}) / sum(w * p{by} * p{by}) OVER ({keys})"


_BY_SCAN, _BY_FIT = "PARTITION BY scan_id", "PARTITION BY scan_id, cod_id"
_FIT_SQL = f"""WITH {_LATEST}, lines AS (SELECT cod_id, x.two_theta AS c, x.intensity_rel AS i, sqrt(greatest(0.01 * tan(radians(x.two_theta / 2))**2 - 0.002 * tan(radians(x.two_theta / 2)) + 0.005, 1e-8)) AS g
         FROM (SELECT l.cod_id, unnest(p.reflections) AS x FROM latest l JOIN (SELECT DISTINCT id, cod_id, reflections FROM reference_patterns) p ON p.id = l.id AND p.cod_id = l.cod_id WHERE l.cod_id % 20 = 0) WHERE x.intensity_rel > 0),
     pts AS (SELECT scan_id, tth, iobs AS y, 1 / greatest(iobs, 1) AS w, tth - avg(tth) OVER ({_BY_SCAN}) AS t, min(tth) OVER ({_BY_SCAN}) AS lo, max(tth) OVER ({_BY_SCAN}) AS hi FROM ({_HOURS}) WHERE scan_id IS NOT NULL),
     q1 AS (SELECT *, 1.0 AS p0, {_freed("t", 0, _BY_SCAN).replace("p0", "1.0")} AS p1 FROM pts),
     q2a AS (SELECT *, {_freed("t*t", 0, _BY_SCAN).replace("t*t", "(t*t)")} AS s2, {_freed("(t*t*t)", 0, _BY_SCAN)} AS s3 FROM q1),
     q2b AS (SELECT *, {_freed("s2", 1, _BY_SCAN)} AS p2, {_freed("s3", 1, _BY_SCAN)} AS s33 FROM q2a),
     q3 AS (SELECT *, {_freed("s33", 2, _BY_SCAN)} AS p3 FROM q2b),
     u AS (SELECT q.*, l.cod_id, sum(CASE WHEN l.c + 10 * l.g >= q.lo AND l.c - 10 * l.g <= q.hi THEN l.i * (0.5 / (1 + (2 * (q.tth - l.c) / l.g)**2) + 0.5 * exp(-ln(2) * (2 * (q.tth - l.c) / l.g)**2)) ELSE 0 END) AS u,
            count(*) FILTER (WHERE l.c + 10 * l.g >= q.lo AND l.c - 10 * l.g <= q.hi) AS used FROM q3 q, lines l GROUP BY ALL),
     r0 AS (SELECT *, {_freed("y", 0, _BY_FIT)} AS y0, {_freed("u", 0, _BY_FIT)} AS u0 FROM u),
     r1 AS (SELECT *, {_freed("y0", 1, _BY_FIT)} AS y1, {_freed("u0", 1, _BY_FIT)} AS u1 FROM r0),
     r2 AS (SELECT *, {_freed("y1", 2, _BY_FIT)} AS y2, {_freed("u1", 2, _BY_FIT)} AS u2 FROM r1),
     r3 AS (SELECT *, {_freed("y2", 3, _BY_FIT)} AS y3, {_freed("u2", 3, _BY_FIT)} AS u3 FROM r2),
     s AS (SELECT scan_id, cod_id, max(used) AS used, sum(w * u3 * y3) AS uy, sum(w * u3 * u3) AS uu, sum(w * y3 * y3) AS yy, sum(w * y * y) AS wi, count(*) AS n FROM r3 GROUP BY scan_id, cod_id),
     f AS (SELECT *, CASE WHEN used > 0 THEN uy / uu ELSE 0 END AS scale, CASE WHEN used > 0 THEN yy - uy * uy / uu ELSE yy END AS chi FROM s)
   SELECT scan_id, cod_id, round(scale, 3) AS scale, round(sqrt(chi / wi), 5) AS rwp, round(chi / (n - 5), 3) AS chi2, round(sqrt((n - 5) / wi), 5) AS rexp, CAST(used AS INTEGER) AS n_peaks, sqrt(chi / wi) < 0.15 AND chi / (n - 5) < 3.0 AS viable FROM f"""


@query("fit_scans", _FIT_SQL)
def fit_scans(spark, sf_dir):
    """Each event scan fitted by the newest Cu pattern of every structure whose number is divisible by 20: scale, figures of
    merit, lines used, and whether the fit is good enough to report."""
    scans = fit.scan_rows(event_points(spark, sf_dir).where("scan_id IS NOT NULL"))
    lines = pipeline.radiation_patterns(table(spark, sf_dir, "reference_patterns")).where("cod_id % 20 = 0").where("exists(reflections, x -> x.intensity_rel > 0)").select("cod_id", "reflections")
    # A stated set of structures for every scan.
    fits = fit.fit_candidates(scans, scans.select("scan_id").join(lines))
    good = pipeline.viable(fits).select("scan_id", "cod_id", F.lit(True).alias("viable"))
    out = fits.join(good, ["scan_id", "cod_id"], "left")
    return out.select("scan_id", "cod_id", r("scale", 3).alias("scale"), r("rwp", 5).alias("rwp"), r("chi2", 3).alias("chi2"), r("rexp", 5).alias("rexp"), "n_peaks", F.coalesce("viable", F.lit(False)).alias("viable"))
