"""Theoretical powder patterns as a relational plan: structures x index grid, filters, first-seen spacing, site sums."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from difframe.functions.chemistry import element_symbol, scattering_at, scattering_law
from difframe.functions.crystal import SYSTEMS, bragg_two_theta, cell_volume, centering_allowed, crystal_system, d_spacing, lattice_type, lorentz_polarization, multiplicity, reciprocal_metric

#: Cells larger than this (cubic angstrom) are refused by second-generation calculators.
MAX_VOLUME = 20_000.0
#: Smallest spacing listed.
MIN_D = 0.4


#: Sites of a structure that travel in one row.
SITES_A_ROW = 500
#: Tasks of the grid per shuffle partition: lines are many more than structures.
GRID_TASKS = 8


def _systems():
    return F.array(*[F.lit(name) for _, name in SYSTEMS], F.lit("unknown"))


def _reach(cell: list, system, wavelength: float, two_theta_max: float, hkl_max: int) -> list:
    """``h_max, k_max, l_max``: the largest indices that a line within the limits can have, at most ``hkl_max``."""
    a, b, c, alpha, beta, gamma = (F.col(x) if isinstance(x, str) else x for x in cell)
    shortest = max(MIN_D, wavelength / (2 * math.sin(math.radians(min(two_theta_max, 180.0) / 2))))
    x, y, z = (F.cos(F.radians(v)) for v in (alpha, beta, gamma))
    # Nearly flat cells, whose metric is not exact, get the full grid.
    sound = F.when(system == "triclinic", 1.0 - x * x - y * y - z * z + 2.0 * x * y * z > 1e-6).when(system == "monoclinic", 1.0 - y * y > 1e-6).otherwise(True)
    axes = (a, F.when(system.isin("cubic", "tetragonal", "hexagonal", "trigonal"), a).otherwise(b), F.when(system == "cubic", a).otherwise(c))
    most = lambda v: F.when(sound, F.least(F.lit(float(hkl_max)), F.floor(v / shortest * 1.000001).cast("double"))).otherwise(float(hkl_max)).cast("int")
    return [most(v).alias(n) for v, n in zip(axes, ("h_max", "k_max", "l_max"), strict=True)]


def lines_of(structures: DataFrame, wavelength: float, two_theta_min: float = 5.0, two_theta_max: float = 90.0, hkl_max: int = 15, physical: bool = False) -> DataFrame:
    """``cod_id, h, k, l, d, two_theta, multiplicity`` of every structure: one half space of indices, centring and
    angle limits applied, the first of lines that share a spacing to 0.001.  Cells of any volume have lines; structures
    that have none are told by ``refusals``.

    Structures, not lines, are shuffled: spread by cod_id before the index grid is expanded, so that the first-seen
    aggregate and all that follows by cod_id happens in place.  A structure's grid ends where its axes allow no line
    within the limits (an index is at most axis / spacing), so that long axes alone cost the full grid.
    """
    s = structures.where("a > 0 AND b > 0 AND c > 0 AND sgnumber IS NOT NULL")
    cell = ["a", "b", "c", *[F.coalesce(F.col(x), F.lit(90.0)) for x in ("alpha", "beta", "gamma")]]
    system = crystal_system("sgnumber")
    s = s.select("cod_id", reciprocal_metric(*cell, system).alias("metric"), F.array_position(_systems(), system).cast("int").alias("system"), lattice_type("sg").alias("lattice"), *_reach(cell, system, wavelength, two_theta_max, hkl_max))
    s = s.repartition(GRID_TASKS * int(s.sparkSession.conf.get("spark.sql.shuffle.partitions")), "cod_id")
    span = lambda n: F.explode(F.sequence(-F.col(n), F.col(n)))
    s = s.withColumn("h", F.explode(F.sequence(F.lit(0), F.col("h_max")))).withColumn("k", span("k_max")).withColumn("l", span("l_max"))
    s = s.where("h > 0 OR k > 0 OR (k = 0 AND l > 0)").where(centering_allowed("h", "k", "l", "lattice"))
    # Through a generator, so that the spacing is computed once and not again in every later expression.
    s = s.select("cod_id", "system", "h", "k", "l", F.explode(F.array(d_spacing("h", "k", "l", "metric"))).alias("d")).where(F.col("d") >= MIN_D)
    s = s.withColumn("two_theta", bragg_two_theta("d", wavelength)).where(F.col("two_theta").between(two_theta_min, two_theta_max))
    # The visiting order as one number: numbers alone are aggregated by hash.
    side = 2 * hkl_max + 1
    order = (F.col("h") * side + F.col("k") + hkl_max) * side + F.col("l") + hkl_max
    lines = s.select("cod_id", "system", "d", "two_theta", F.bround(F.col("d") * 1000).cast("long").alias("d_key"), order.alias("o"))
    kept = lines.groupBy("cod_id", "d_key").agg(F.min("o").alias("o"), *[F.min_by(c, "o").alias(c) for c in ("system", "d", "two_theta")])
    whole = lambda x: F.floor(x).cast("int")
    kept = kept.select("cod_id", "d", "two_theta", F.element_at(_systems(), F.col("system")).alias("system"), whole(F.col("o") / (side * side)).alias("h"), (whole(F.col("o") / side) % side - hkl_max).alias("k"), (F.col("o") % side - hkl_max).alias("l"))
    return kept.withColumn("multiplicity", multiplicity("h", "k", "l", "system", physical)).select("cod_id", "h", "k", "l", "d", "two_theta", "multiplicity")


def refusals(structures: DataFrame, max_volume: float | None = None) -> DataFrame:
    """``cod_id, status, error_msg`` of structures without a pattern, and why: ``NoCell`` (a missing or non-positive
    axis), ``NoSpaceGroup``, ``UnknownSystem`` (no number of a space group) or, with ``max_volume``, ``StructureTooLarge``.

    A structure without sites is none of them: it has lines without intensities.
    """
    angles = [F.coalesce(F.col(x), F.lit(90.0)) for x in ("alpha", "beta", "gamma")]
    volume = cell_volume("a", "b", "c", *angles)
    cell = reduce(lambda x, y: x & y, [F.coalesce(F.col(x) > 0, F.lit(False)) for x in "abc"])
    status = F.when(~cell, "NoCell").when(F.col("sgnumber").isNull(), "NoSpaceGroup").when(crystal_system("sgnumber") == "unknown", "UnknownSystem")
    told = {
        "NoCell": F.concat_ws(" ", F.lit("cell axes"), *[F.coalesce(F.col(x).cast("string"), F.lit("missing")) for x in "abc"]),
        "NoSpaceGroup": F.lit("space group missing"),
        "UnknownSystem": F.concat(F.lit("space group "), F.col("sgnumber").cast("string")),
    }
    if max_volume is not None:
        status = status.when(volume > max_volume, "StructureTooLarge")
        told["StructureTooLarge"] = F.concat(F.lit("cell volume "), F.round(volume).cast("long").cast("string"))
    message = reduce(lambda w, kv: w.when(F.col("status") == kv[0], kv[1]), told.items(), F.when(F.lit(False), ""))
    return structures.withColumn("status", status).where("status IS NOT NULL").select("cod_id", "status", message.alias("error_msg"))


def structure_factors(lines: DataFrame, sites: DataFrame, table: dict | None = None) -> DataFrame:
    """``lines`` (distinct rows with ``cod_id, h, k, l, d``) with ``f_sq``: the squared structure factor over the listed
    sites (null without sites).

    Sites travel as arrays of about ``SITES_A_ROW``, so a structure of any number of sites is no single row; lines and
    arrays meet by cod_id, and cosine and sine parts are summed in place.  A site that occurs twice counts once.  Zero
    occupancy counts as full and missing coordinates as 0, as in the catalogue's own patterns.
    """
    nz = lambda c, d: F.when(F.col(c).isNull() | (F.col(c) == 0), d).otherwise(F.col(c))
    own = sites.select("cod_id", "label", element_symbol("type_symbol").alias("e"), *[nz(f"fract_{x}", 0.0).alias(x) for x in "xyz"], nz("occupancy", 1.0).alias("occ"), F.greatest(nz("u_iso_or_equiv", 0.0), F.lit(0.0)).alias("u")).distinct()
    counts = own.groupBy("cod_id").agg(F.ceil(F.count(F.lit(1)) / SITES_A_ROW).alias("rows"))
    site = F.struct("x", "y", "z", "occ", "u", "label", scattering_law("e", table).alias("law"))
    by = own.join(counts, "cod_id").withColumn("part", F.pmod(F.xxhash64("label", "x", "y", "z"), F.col("rows"))).groupBy("cod_id", "part").agg(F.array_sort(F.collect_list(site)).alias("sites")).drop("part")
    joined = lines.join(by, "cod_id", "left")
    s = 1.0 / (2.0 * F.col("d"))

    def wave(x):
        amplitude = scattering_at(x["law"], s) * x["occ"] * F.exp(-8.0 * F.lit(9.869604401089358) * x["u"] * s * s)
        phase = 2.0 * F.lit(3.141592653589793) * (F.col("h") * x["x"] + F.col("k") * x["y"] + F.col("l") * x["z"])
        return F.struct(amplitude.alias("f"), phase.alias("p"))

    # In two steps, so that every site's amplitude is computed once for both parts.
    part = lambda f: F.aggregate("sites", F.lit(0.0), lambda t, x: t + x["f"] * f(x["p"]))
    parts = joined.withColumn("sites", F.transform("sites", wave)).select(*lines.columns, part(F.cos).alias("re"), part(F.sin).alias("im"))
    sums = parts.groupBy(*lines.columns).agg(F.sum("re").alias("re"), F.sum("im").alias("im"))
    return sums.select(*lines.columns, (F.col("re") * F.col("re") + F.col("im") * F.col("im")).alias("f_sq"))


def with_intensity(lines: DataFrame, exact: bool = False) -> DataFrame:
    """``intensity_rel`` 0 to 100 within each pattern, from multiplicity, f_sq and the Lorentz-polarisation factor; with
    ``exact`` also ``intensity``, the same before rounding (null in patterns without intensity)."""
    raw = F.col("multiplicity") * F.col("f_sq") * lorentz_polarization("two_theta")
    top = F.max("__raw").over(Window.partitionBy("cod_id"))
    share = F.when(top > 0, 100.0 * F.col("__raw") / top)
    out = lines.withColumn("__raw", raw).withColumn("intensity", share)
    out = out.withColumn("intensity_rel", F.when(F.col("__raw").isNotNull(), F.coalesce(F.round("intensity", 2), F.lit(0.0))))
    return out.drop("__raw") if exact else out.drop("__raw", "intensity")


def scaled_to_100(df: DataFrame, key: str, value: str) -> DataFrame:
    """``df`` with ``value`` scaled so that its greatest of a ``key`` is 100; keys without a positive one stay as they are."""
    top = F.max(value).over(Window.partitionBy(key))
    return df.withColumn(value, F.when(top > 0, 100.0 * F.col(value) / top).otherwise(F.col(value)))


def calculate_patterns(structures: DataFrame, sites: DataFrame, wavelength: float, exact: bool = False, **limits) -> DataFrame:
    """``cod_id, reflections, n_reflections, has_intensities``: one row per structure with lines, sorted by angle; with
    ``exact`` also ``total_intensity``, the sum of the intensities before they are rounded."""
    lines = with_intensity(structure_factors(lines_of(structures, wavelength, **limits), sites), exact)
    line = F.struct(F.round("two_theta", 4).alias("two_theta"), "h", "k", "l", F.round("d", 5).alias("d_hkl"), "multiplicity", F.round("f_sq", 4).alias("f_sq"), "intensity_rel")
    extra = [F.sum("intensity").alias("total_intensity")] if exact else []
    return lines.groupBy("cod_id").agg(F.array_sort(F.collect_list(line)).alias("reflections"), F.count(F.lit(1)).cast("int").alias("n_reflections"), F.max(F.col("intensity_rel").isNotNull()).alias("has_intensities"), *extra)
