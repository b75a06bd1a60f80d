"""Peak detection and fits over many scans: scans are rows with arrays, candidates are joined to them, kernels run in
Arrow batches.  A scan is bounded (thousands of points); no group is ever collected beyond one scan's phases."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from difframe.functions.chemistry import molar_mass
from difframe.functions.crystal import cell_volume
from difframe.operators.kernels import INSTRUMENT, absolute_weights, detect_peaks, figures, line_profile, mixture_fit, weighted_fit


#: Candidates that are fitted to one copy of their scan.
PHASES_A_ROW = 64


def scan_rows(points: DataFrame) -> DataFrame:
    """``scan_id, tth, iobs, sigma`` with one row per scan (arrays by angle) from points ``scan_id, tth, iobs, sigma``."""
    p = points.where("tth IS NOT NULL AND iobs IS NOT NULL").groupBy("scan_id").agg(F.array_sort(F.collect_list(F.struct("tth", "iobs", "sigma"))).alias("p"))
    part = lambda c: F.transform("p", lambda x: x[c].cast("double")).alias(c)
    return p.select("scan_id", part("tth"), part("iobs"), part("sigma"))


def find_peaks(scans: DataFrame, prominence_sigma: float = 5.0, min_distance: float = 0.3) -> DataFrame:
    """``scan_id, peak_no, two_theta, intensity`` of every scan's peaks."""

    def run(batches):
        import numpy as np
        import pandas as pd

        for pdf in batches:
            out = []
            for s, t, i, e in zip(pdf.scan_id, pdf.tth, pdf.iobs, pdf.sigma, strict=True):
                at = detect_peaks(np.asarray(t), np.asarray(i), np.asarray(e), prominence_sigma, min_distance)
                out += [(s, k, float(t[j]), float(i[j])) for k, j in enumerate(at)]
            yield pd.DataFrame(out, columns=["scan_id", "peak_no", "two_theta", "intensity"])

    kind = scans.schema["scan_id"].dataType.simpleString()
    return scans.select("scan_id", "tth", "iobs", "sigma").mapInPandas(run, f"scan_id {kind}, peak_no int, two_theta double, intensity double")


_LINES = "two_theta double, intensity_rel double, multiplicity double, f_sq double"


def _line_arrays(c: DataFrame) -> DataFrame:
    names = ["two_theta", "intensity_rel", "multiplicity", "f_sq"]
    num = lambda n: F.transform(F.filter("reflections", lambda r: r["two_theta"].isNotNull()), lambda r: F.coalesce(r[n].cast("double"), F.lit(0.0))).alias(f"r_{n}")
    return c.select("scan_id", "cod_id", *[num(n) for n in names])


def fit_candidates(scans: DataFrame, candidates: DataFrame, absolute: bool = False, **instrument) -> DataFrame:
    """``scan_id, cod_id, scale, rwp, rp, rexp, chi2, n_peaks, rank`` of every candidate (``scan_id, cod_id,
    reflections``) fitted alone to its scan; rank by rwp, then cod_id.  A candidate without usable lines gets scale 0.

    A scan travels once for every ``PHASES_A_ROW`` candidates, not with each of them.
    """
    opt = {**INSTRUMENT, **instrument}
    line = F.struct("cod_id", *[f"r_{n}" for n in ("two_theta", "intensity_rel", "multiplicity", "f_sq")])
    place = F.row_number().over(Window.partitionBy("scan_id").orderBy("cod_id")) - 1
    groups = _line_arrays(candidates).withColumn("chunk", F.floor(place / PHASES_A_ROW)).groupBy("scan_id", "chunk").agg(F.collect_list(line).alias("phases"))

    def run(batches):
        import numpy as np
        import pandas as pd

        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                t, i, e = (np.asarray(x, float) for x in (r.tth, r.iobs, r.sigma))
                for x in r.phases:
                    pos = np.asarray(x["r_two_theta"], float)
                    w = absolute_weights(pos, np.asarray(x["r_multiplicity"], float), np.asarray(x["r_f_sq"], float)) if absolute else np.asarray(x["r_intensity_rel"], float)
                    unit, used = line_profile(t, pos, w, **opt)
                    scale, calc = weighted_fit(t, i, e, unit, opt["n_bg"])
                    f = figures(i, calc, e, 1 + opt["n_bg"])
                    out.append((r.scan_id, x["cod_id"], scale if used else 0.0, f["rwp"], f["rp"], f["rexp"], f["chi2"], used))
            yield pd.DataFrame(out, columns=["scan_id", "cod_id", "scale", "rwp", "rp", "rexp", "chi2", "n_peaks"])

    s, c = scans.schema["scan_id"].dataType.simpleString(), candidates.schema["cod_id"].dataType.simpleString()
    fits = groups.join(scans.where(F.size("tth") > 0), "scan_id").mapInPandas(run, f"scan_id {s}, cod_id {c}, scale double, rwp double, rp double, rexp double, chi2 double, n_peaks int")
    return fits.withColumn("rank", F.row_number().over(Window.partitionBy("scan_id").orderBy("rwp", "cod_id")))


def fit_mixtures(scans: DataFrame, phases: DataFrame, **instrument) -> DataFrame:
    """``scan_id, cod_id, scale, rwp, chi2``: all phases of a scan fitted together, scales never negative, on the
    absolute intensity basis.  ``phases`` (``scan_id, cod_id, reflections``) should be a scan's few best candidates."""
    opt = {**INSTRUMENT, **instrument}
    line = F.struct("cod_id", "r_two_theta", "r_multiplicity", "r_f_sq")
    groups = _line_arrays(phases).groupBy("scan_id").agg(F.array_sort(F.collect_list(line)).alias("phases"))

    def run(batches):
        import numpy as np
        import pandas as pd

        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                t, i, e = (np.asarray(x, float) for x in (r.tth, r.iobs, r.sigma))
                units = [line_profile(t, p := np.asarray(x["r_two_theta"], float), absolute_weights(p, np.asarray(x["r_multiplicity"], float), np.asarray(x["r_f_sq"], float)), **opt)[0] for x in r.phases]
                scales, calc = mixture_fit(t, i, e, units, opt["n_bg"])
                f = figures(i, calc, e, len(units) + opt["n_bg"])
                out += [(r.scan_id, x["cod_id"], float(s), f["rwp"], f["chi2"]) for x, s in zip(r.phases, scales, strict=True)]
            yield pd.DataFrame(out, columns=["scan_id", "cod_id", "scale", "rwp", "chi2"])

    s, c = scans.schema["scan_id"].dataType.simpleString(), phases.schema["cod_id"].dataType.simpleString()
    return groups.join(scans.where(F.size("tth") > 0), "scan_id").mapInPandas(run, f"scan_id {s}, cod_id {c}, scale double, rwp double, chi2 double")


def figures_of_merit(df: DataFrame, keys: list[str], n_params: int, observed: str = "iobs", calculated: str = "icalc", sigma: str = "sigma") -> DataFrame:
    """Rwp, Rp, Rexp and chi2 per key as one aggregate over points."""
    w = 1.0 / F.greatest(F.col(sigma) * F.col(sigma), F.lit(1e-10))
    diff = F.col(observed) - F.col(calculated)
    sums = df.groupBy(*keys).agg(F.sum(w * diff * diff).alias("chi"), F.sum(w * F.col(observed) * F.col(observed)).alias("wi"), F.sum(F.abs(diff)).alias("ad"), F.sum(F.abs(F.col(observed))).alias("ai"), F.count(F.lit(1)).alias("n"))
    wi, free = F.greatest("wi", F.lit(1e-20)), F.greatest(F.col("n") - n_params, F.lit(1)).cast("double")
    return sums.select(*keys, F.sqrt(F.col("chi") / wi).alias("rwp"), (F.col("ad") / F.greatest("ai", F.lit(1e-20))).alias("rp"), F.sqrt(free / wi).alias("rexp"), (F.col("chi") / free).alias("chi2"), F.col("n").alias("n_points"))


def weight_fractions(scales: DataFrame, structures: DataFrame) -> DataFrame:
    """``scan_id, cod_id, scale, z, mass, volume, zmv, weight_pct``: shares of the crystalline part of each scan.

    A phase without cell, formula units or a readable formula, or with a negative scale, has weight 0 and keeps its id.
    """
    s = structures.select("cod_id", "z", molar_mass("formula").alias("mass"), cell_volume("a", "b", "c", "alpha", "beta", "gamma").alias("volume"))
    j = scales.join(s, "cod_id", "left")
    zmv = F.greatest(F.coalesce(F.when(F.col("z") > 0, F.col("scale") * F.col("z") * F.col("mass") * F.col("volume")), F.lit(0.0)), F.lit(0.0))
    j = j.withColumn("zmv", zmv)
    # Totals by an aggregate, so that a scan with very many phases is no single window.
    totals = j.groupBy("scan_id").agg(F.sum("zmv").alias("total")).select(F.col("scan_id").alias("of"), "total")
    j = j.join(totals, F.col("scan_id").eqNullSafe(F.col("of")))
    return j.withColumn("weight_pct", F.when(F.col("total") > 0, 100.0 * F.col("zmv") / F.col("total")).otherwise(0.0)).select("scan_id", "cod_id", "scale", "z", "mass", "volume", "zmv", "weight_pct")


def dominant_phase(fractions: DataFrame) -> DataFrame:
    """``scan_id, cod_id, weight_pct`` of each scan's phase of most weight (the smaller cod_id of equal ones)."""
    top = fractions.groupBy("scan_id").agg(F.max_by(F.struct("cod_id", "weight_pct"), F.struct("weight_pct", -F.col("cod_id"))).alias("r"))
    return top.select("scan_id", "r.*")
