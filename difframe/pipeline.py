"""Phase identification and quantification of many scans, from points to ranked phases and weight fractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from difframe.functions.crystal import CU_KA
from difframe.operators.fit import find_peaks, fit_candidates, fit_mixtures, scan_rows, weight_fractions
from difframe.operators.relational import best_row
from difframe.operators.search import dropped_hits, fingerprints, match_phases, peak_windows, prefilter
from difframe.runtime import staged

#: Wavelengths that count as Cu K-alpha.
CU_RANGE = (1.535, 1.546)


def _of_radiation(patterns: DataFrame, low: float = CU_RANGE[0], high: float = CU_RANGE[1]) -> DataFrame:
    return patterns.where(F.col("has_intensities") & F.col("wavelength").between(low, high))


def radiation_patterns(patterns: DataFrame, low: float = CU_RANGE[0], high: float = CU_RANGE[1]) -> DataFrame:
    """The latest pattern with intensities of every structure for one radiation."""
    return best_row(_of_radiation(patterns, low, high), ["cod_id"], ["calculated_at", "id"], ["wavelength", "reflections", "n_reflections"])


def _search(scans: DataFrame, patterns: DataFrame, wavelength: float = CU_KA, top: int = 50, min_matches: int = 3, tolerance: float = 0.2, prominence_sigma: float = 5.0, fitted_only: bool = True) -> DataFrame:
    # Read more than once below: detected and ranked once, then kept.
    peaks = staged(find_peaks(scans, prominence_sigma), "peaks")
    prints = fingerprints(patterns)
    if fitted_only:  # before ranking: a structure that cannot be fitted takes no place
        prints = prints.join(_of_radiation(patterns).select("cod_id").distinct(), "cod_id", "left_semi")
    return match_phases(prints, peak_windows(peaks, wavelength, tolerance), min_matches, top, ties=True)


def _fitted(scans: DataFrame, found: DataFrame, lines: DataFrame) -> DataFrame:
    found = staged(found.select("scan_id", "cod_id", "n_matched"), "candidates")
    fits = fit_candidates(scans, found.join(lines, "cod_id").select("scan_id", "cod_id", "reflections"))
    return fits.join(found, ["scan_id", "cod_id"])


def _identify(scans: DataFrame, patterns: DataFrame, **options) -> DataFrame:
    return _fitted(scans, _search(scans, patterns, **options), radiation_patterns(patterns).select("cod_id", "reflections"))


def _once(candidates: DataFrame) -> DataFrame:
    """A list's candidates, each once: of several rows of one number the one of most lines (then the greatest)."""
    lines = candidates.where("cod_id IS NOT NULL AND reflections IS NOT NULL").select("cod_id", "reflections", F.size("reflections").alias("n"))
    return best_row(lines, ["cod_id"], ["n", "reflections"], ["reflections"])


def _identify_listed(scans: DataFrame, listed: DataFrame, wavelength: float = CU_KA, top: int = 50, min_matches: int = 3, tolerance: float = 0.2, prominence_sigma: float = 5.0) -> DataFrame:
    peaks = staged(find_peaks(scans, prominence_sigma), "peaks")
    return _fitted(scans, prefilter(listed, peaks, min_matches, top, wavelength, tolerance), listed)


def search(points: DataFrame, patterns: DataFrame, **options) -> DataFrame:
    """``scan_id, cod_id, n_matched, rank``: candidate phases of every scan; scans without peaks have none.

    Only structures with a pattern of the radiation are ranked, and all that tie at the place ``top`` are kept.
    Options: ``wavelength``, ``top``, ``min_matches``, ``tolerance`` (degrees), ``prominence_sigma``.
    """
    return _search(staged(scan_rows(points), "scans"), patterns, **options)


def identify(points: DataFrame, patterns: DataFrame, **options) -> DataFrame:
    """Candidates of every scan, fitted and ranked by Rwp; options as in ``search``."""
    return _identify(staged(scan_rows(points), "scans"), patterns, **options)


def identify_listed(points: DataFrame, candidates: DataFrame, **options) -> DataFrame:
    """The same for a list of candidates (``cod_id, reflections``, as ``read_candidates`` gives it) in place of a
    catalogue: of every scan the ``top`` that explain most of its peaks, fitted and ranked by Rwp.

    Candidates without a number or lines are left out; of one number's rows the one of most lines counts; candidates
    that explain fewer than ``min_matches`` peaks are not fitted; an empty list gives no rows.
    """
    return _identify_listed(staged(scan_rows(points), "scans"), staged(_once(candidates), "listed"), **options)


def dropped(points: DataFrame, patterns: DataFrame, **options) -> DataFrame:
    """``scan_id, cod_id, n_matched, rank``: hits among all structures that ``identify`` cannot fit, for want of a
    pattern of the radiation; options as in ``search``."""
    found = _search(staged(scan_rows(points), "scans"), patterns, fitted_only=False, **options)
    return dropped_hits(found, _of_radiation(patterns))


def viable(fits: DataFrame, rwp: float = 0.15, chi2: float = 3.0) -> DataFrame:
    """Fits good enough to report."""
    return fits.where((F.col("rwp") < rwp) & (F.col("chi2") < chi2))


def quantify(points: DataFrame, patterns: DataFrame, structures: DataFrame, top_k: int = 4, **options) -> DataFrame:
    """Weight fractions of each scan's ``top_k`` best phases, fitted together on the absolute basis."""
    scans = staged(scan_rows(points), "scans")
    return _shares(scans, _identify(scans, patterns, **options), radiation_patterns(patterns).select("cod_id", "reflections"), structures, top_k)


def quantify_listed(points: DataFrame, candidates: DataFrame, structures: DataFrame, top_k: int = 4, **options) -> DataFrame:
    """The same with a list of candidates in place of a catalogue, as in ``identify_listed``."""
    scans, listed = staged(scan_rows(points), "scans"), staged(_once(candidates), "listed")
    return _shares(scans, _identify_listed(scans, listed, **options), listed, structures, top_k)


def _shares(scans: DataFrame, fits: DataFrame, lines: DataFrame, structures: DataFrame, top_k: int) -> DataFrame:
    best = fits.where(F.col("rank") <= top_k).select("scan_id", "cod_id")
    return weight_fractions(fit_mixtures(scans, best.join(lines, "cod_id")), structures)
