"""Peak search: fingerprints of reference patterns and the d-window search over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from difframe.functions.crystal import CU_KA, d_window
from difframe.operators.relational import best_row, range_join, top_ranked

#: Strongest lines a fingerprint keeps.
LINES = 30
#: Bin of the logarithm of spacings: a search window is 0.35 % of the spacing at 90 degrees and 2 % at 20.
LOG_D_BIN = 0.004


def best_patterns(patterns: DataFrame) -> DataFrame:
    """One pattern with intensities per structure: longest wavelength (it keeps the large spacings), most lines."""
    return best_row(patterns.where("has_intensities"), ["cod_id"], ["wavelength", "n_reflections", "-id"], ["id", "wavelength", "rad_symbol", "reflections"])


def fingerprints(patterns: DataFrame, lines: int | None = LINES) -> DataFrame:
    """The strongest ``lines`` lines of every structure's best pattern, ranked; all of them if None."""
    line = best_patterns(patterns).select("cod_id", "wavelength", "rad_symbol", F.explode("reflections").alias("r"))
    flat = line.select("cod_id", F.col("r.d_hkl").alias("d_hkl"), F.col("r.intensity_rel").alias("intensity_rel"), F.col("r.two_theta").alias("two_theta_src"), "wavelength", "rad_symbol", F.col("r.h").alias("h"), F.col("r.k").alias("k"), F.col("r.l").alias("l")).where("intensity_rel > 0 AND d_hkl > 0")
    order = [F.desc("intensity_rel"), F.desc("d_hkl"), F.asc("h"), F.asc("k"), F.asc("l")]
    return top_ranked(flat, ["cod_id"], order, lines if lines is not None else 2**31 - 1)


def peak_windows(peaks: DataFrame, wavelength: float = CU_KA, tolerance: float = 0.2) -> DataFrame:
    """``scan_id, peak_no, d_lo, d_hi`` of observed peaks (``scan_id, peak_no, two_theta``)."""
    w = d_window("two_theta", wavelength, tolerance)
    return peaks.select("scan_id", "peak_no", w["d_lo"].alias("d_lo"), w["d_hi"].alias("d_hi"))


def match_phases(prints: DataFrame, windows: DataFrame, min_matches: int = 3, top: int = 50, ties: bool = False) -> DataFrame:
    """``scan_id, cod_id, n_matched, rank``: phases by the number of distinct peaks of a scan they explain.

    Every scan is searched at once.  Lines are spread by cod_id: while the windows are small enough
    to be sent, the lines of a structure stay in one task, so (scan, structure) pairs are counted there and
    never shuffled; what is shuffled are each task's ``top`` phases of a scan.  The count is exact; ties go to the smaller cod_id or, with ``ties``, share a rank,
    so that every phase that ties at the last place is kept.
    """
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hits = range_join(prints.select("cod_id", "d_hkl").repartition(tasks, "cod_id"), windows, "d_hkl", "d_lo", "d_hi", LOG_D_BIN, F.log)
    counts = hits.groupBy("scan_id", "cod_id").agg(F.countDistinct("peak_no").cast("int").alias("n_matched")).where(F.col("n_matched") >= min_matches)
    if ties:
        return counts.withColumn("rank", F.rank().over(Window.partitionBy("scan_id").orderBy(F.desc("n_matched")))).where(F.col("rank") <= top)
    return top_ranked(counts, ["scan_id"], [F.desc("n_matched"), F.asc("cod_id")], top)


def prefilter(candidates: DataFrame, peaks: DataFrame, min_matches: int = 3, top: int = 50, wavelength: float = CU_KA, tolerance: float = 0.2) -> DataFrame:
    """The same search over a list of candidates (``cod_id, reflections``): every positive line counts.  If they have a
    ``position``, candidates of as many matches keep that order."""
    flat = candidates.select("cod_id", F.explode("reflections").alias("r")).select("cod_id", F.col("r.d_hkl").alias("d_hkl"), F.col("r.intensity_rel").alias("i")).where("i > 0 AND d_hkl > 0")
    windows = peak_windows(peaks, wavelength, tolerance)
    if "position" not in candidates.columns:
        return match_phases(flat, windows, min_matches, top).join(candidates, "cod_id")
    all_ = match_phases(flat, windows, min_matches, 2**31 - 1, ties=True).drop("rank")
    return top_ranked(all_.join(candidates, "cod_id"), ["scan_id"], [F.desc("n_matched"), F.asc_nulls_last("position"), F.asc("cod_id")], top)


def dropped_hits(found: DataFrame, kept: DataFrame) -> DataFrame:
    """Hits for which no pattern of the asked radiation exists: reported, not silently lost."""
    return found.join(kept.select("cod_id").distinct(), "cod_id", "left_anti")
