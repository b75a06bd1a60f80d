"""Crystallography as Column expressions: everything stays inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Wavelengths (angstrom) by radiation.
WAVELENGTHS = {"Cu": 1.54056, "Mo": 0.71073, "Co": 1.78897, "Cr": 2.28970, "Ag": 0.56086, "Fe": 1.93604}
CU_KA = 1.54056

#: Last space-group number of each crystal system.
SYSTEMS = ((2, "triclinic"), (15, "monoclinic"), (74, "orthorhombic"), (142, "tetragonal"), (167, "trigonal"), (194, "hexagonal"), (230, "cubic"))


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x)) if isinstance(x, float) else F.col(x) if isinstance(x, str) else F.lit(x)


def two_theta_to_d(two_theta, wavelength=CU_KA) -> Column:
    """Bragg spacing of an angle in degrees; null at angle 0."""
    return F.try_divide(_c(wavelength), 2.0 * F.sin(F.radians(_c(two_theta) / 2.0)))


def d_window(two_theta, wavelength=CU_KA, tolerance: float = 0.2) -> Column:
    """struct(d_lo, d_hi): spacings between which a line matches a peak within ``tolerance`` degrees."""
    t = _c(two_theta)
    return F.struct(two_theta_to_d(t + tolerance, wavelength).alias("d_lo"), two_theta_to_d(F.greatest(t - tolerance, F.lit(1e-6)), wavelength).alias("d_hi"))


def bragg_two_theta(d, wavelength=CU_KA) -> Column:
    """Angle in degrees of a spacing; null where the wavelength can't reach it."""
    r = F.try_divide(_c(wavelength), 2.0 * _c(d))
    return F.when(r <= 1.0, F.degrees(2.0 * F.asin(r)))


def crystal_system(sg_number) -> Column:
    n = _c(sg_number)
    out = F.when(n.isNull() | (n < 1), "unknown")
    for last, name in SYSTEMS:
        out = out.when(n <= last, name)
    return out.otherwise("unknown")


def lattice_type(symbol) -> Column:
    """Centring letter of a Hermann-Mauguin symbol, P where it has none (also for blank symbols)."""
    first = F.upper(F.substring(F.trim(_c(symbol)), 1, 1))
    return F.when(first.isin(*"PIFCABR"), first).otherwise("P")


def centering_allowed(h, k, l, lattice) -> Column:  # noqa: E741
    """Whether a centring lets the reflection through."""
    h, k, l, t = _c(h), _c(k), _c(l), _c(lattice)  # noqa: E741
    even = lambda x: F.pmod(x, F.lit(2)) == 0
    return (
        F.when(t == "I", even(h + k + l))
        .when(t == "F", (F.pmod(h, F.lit(2)) == F.pmod(k, F.lit(2))) & (F.pmod(k, F.lit(2)) == F.pmod(l, F.lit(2))))
        .when(t == "C", even(h + k))
        .when(t == "A", even(k + l))
        .when(t == "B", even(h + l))
        .when(t == "R", F.pmod(-h + k + l, F.lit(3)) == 0)
        .otherwise(True)
    )


def cell_volume(a, b, c, alpha, beta, gamma) -> Column:
    """Volume of a cell; angles in degrees, impossible angles give the floor."""
    x, y, z = (F.cos(F.radians(_c(v))) for v in (alpha, beta, gamma))
    return _c(a) * _c(b) * _c(c) * F.sqrt(F.greatest(1.0 - x * x - y * y - z * z + 2.0 * x * y * z, F.lit(1e-12)))


def reciprocal_metric(a, b, c, alpha, beta, gamma, system) -> Column:
    """What ``d_spacing`` needs of a cell: struct(kind, aa, bb, cc, hh, kk, ll, hk, hl, kl).

    Orthogonal and hexagonal systems (``kind`` 1 to 4) go by their squared axes; for the others 1/d^2 of (hkl) is the sum
    of the six products with h*h, k*k, l*l, h*k, h*l, k*l.  Null for degenerate cells and unknown systems; trigonal cells
    are taken on hexagonal axes.  Compute it once per structure, before indices are expanded.
    """
    a, b, c = (_c(v).cast("double") for v in (a, b, c))
    s = _c(system)
    ca, cb, cg = (F.cos(F.radians(_c(v))) for v in (alpha, beta, gamma))
    sb2 = 1.0 - cb * cb
    per, zero = F.try_divide, F.lit(0.0)
    one = lambda x: per(F.lit(1.0), x * x)
    # Triclinic: the adjugate of the metric matrix over its determinant.
    g11, g22, g33, g12, g13, g23 = a * a, b * b, c * c, a * b * cg, a * c * cb, b * c * ca
    det = g11 * (g22 * g33 - g23 * g23) - g12 * (g12 * g33 - g13 * g23) + g13 * (g12 * g23 - g22 * g13)
    adj = [g22 * g33 - g23 * g23, g11 * g33 - g13 * g13, g11 * g22 - g12 * g12, 2.0 * (g13 * g23 - g12 * g33), 2.0 * (g12 * g23 - g13 * g22), 2.0 * (g12 * g13 - g11 * g23)]
    names = ("hh", "kk", "ll", "hk", "hl", "kl")

    def pack(kind: int, six: list[Column]) -> Column:
        return F.struct(F.lit(kind).alias("kind"), (a * a).alias("aa"), (b * b).alias("bb"), (c * c).alias("cc"), *[x.alias(n) for x, n in zip(six, names, strict=True)])

    by_axes = F.when(F.least(a, b, c) > 0, F.lit(True))
    return (
        F.when(s == "cubic", F.when(by_axes, pack(1, [zero] * 6)))
        .when(s == "tetragonal", F.when(by_axes, pack(2, [zero] * 6)))
        .when(s == "orthorhombic", F.when(by_axes, pack(3, [zero] * 6)))
        .when(s.isin("hexagonal", "trigonal"), F.when(by_axes, pack(4, [zero] * 6)))
        .when((s == "monoclinic") & (sb2 > 1e-20), pack(0, [per(one(a), sb2), one(b), per(one(c), sb2), zero, per(-2.0 * cb, a * c * sb2), zero]))
        .when((s == "triclinic") & (det > 0), pack(0, [per(x, det) for x in adj]))
    )


def d_spacing(h, k, l, metric) -> Column:  # noqa: E741
    """Spacing of (hkl) from a cell's ``reciprocal_metric``; null where that is null or gives none."""
    h, k, l, m = _c(h), _c(k), _c(l), _c(metric)  # noqa: E741
    # Index sums stay whole numbers, so lines of one spacing get the very same number.
    inv = (
        F.when(m["kind"] == 1, (h * h + k * k + l * l) / m["aa"])
        .when(m["kind"] == 2, (h * h + k * k) / m["aa"] + l * l / m["cc"])
        .when(m["kind"] == 3, h * h / m["aa"] + k * k / m["bb"] + l * l / m["cc"])
        .when(m["kind"] == 4, F.lit(4.0 / 3.0) * (h * h + h * k + k * k) / m["aa"] + l * l / m["cc"])
        .otherwise(h * h * m["hh"] + k * k * m["kk"] + l * l * m["ll"] + h * k * m["hk"] + h * l * m["hl"] + k * l * m["kl"])
    )
    return F.when(inv > 1e-12, 1.0 / F.sqrt(inv))


def lorentz_polarization(two_theta, monochromator: float | None = None) -> Column:
    """Lorentz-polarisation factor of powder diffraction, 0 at its poles; ``monochromator`` is its own 2-theta."""
    t = F.radians(_c(two_theta) / 2.0)
    s, c = F.sin(t), F.cos(t)
    p = F.pow(F.cos(2.0 * t), F.lit(2.0))
    if monochromator is None:
        top = 1.0 + p
    else:
        m = F.pow(F.cos(F.radians(F.lit(float(monochromator)))), F.lit(2.0))
        top = (1.0 + m * p) / (1.0 + m)
    return F.when((F.abs(s) < 1e-10) | (F.abs(c) < 1e-10), 0.0).otherwise(F.try_divide(top, s * s * c))


def caglioti_fwhm(two_theta, u: float = 0.01, v: float = -0.002, w: float = 0.005) -> Column:
    """Width of a line at an angle."""
    t = F.tan(F.radians(_c(two_theta) / 2.0))
    return F.sqrt(F.greatest(u * t * t + v * t + w, F.lit(1e-8)))


def pseudo_voigt(x, centre, fwhm, eta: float = 0.5) -> Column:
    """Pseudo-Voigt profile of height 1."""
    z = F.pow(2.0 * (_c(x) - _c(centre)) / _c(fwhm), F.lit(2.0))
    return eta / (1.0 + z) + (1.0 - eta) * F.exp(-F.lit(0.6931471805599453) * z)


def gaussian(x, centre, fwhm) -> Column:
    """Gaussian profile of height 1."""
    return F.exp(-4.0 * F.lit(0.6931471805599453) * F.pow((_c(x) - _c(centre)) / _c(fwhm), F.lit(2.0)))


def multiplicity(h, k, l, system, physical: bool = False) -> Column:  # noqa: E741
    """Approximate multiplicity from zeros and equalities of the indices.

    By default equalities are taken on signed indices, which counts (1,-1,-1) of a cubic cell as a general one;
    ``physical`` takes absolute values.
    """
    h, k, l = (F.abs(_c(v)) if physical else _c(v) for v in (h, k, l))  # noqa: E741
    s = _c(system)
    zeros = reduce(lambda x, y: x + y, [(v == 0).cast("int") for v in (h, k, l)])
    same = (h == k) & (k == l)
    pair = ((h == k) | (k == l) | (h == l)) & ~same
    return (
        F.when(s == "cubic", F.when(zeros == 0, F.when(same, 8).when(pair, 24).otherwise(48)).when(zeros == 1, F.when(pair, 12).otherwise(24)).otherwise(6))
        .when(s == "tetragonal", F.when(zeros == 0, F.when(h == k, 8).otherwise(16)).when(l == 0, F.when((h == 0) | (k == 0) | (h == k), 4).otherwise(8)).otherwise(F.when((h == 0) | (k == 0), 4).otherwise(8)))
        .when(s == "orthorhombic", F.when(zeros == 0, 8).when(zeros == 1, 4).when(zeros == 2, 2).otherwise(1))
        .when(s == "hexagonal", F.when(zeros == 0, 24).otherwise(12))
        .when(s == "trigonal", F.when(zeros == 0, 12).otherwise(6))
        .when(s == "monoclinic", F.when(k == 0, 2).otherwise(4))
        .when(s == "triclinic", 2)
        .otherwise(1)
        .cast("int")
    )


def resolve_wavelength(own, symbol, forced: float | None = None, use_own: bool = True) -> Column:
    """struct(wavelength, rad_symbol, source): the forced one, else the record's own (above 0.1), else Cu K-alpha."""
    w = _c(own).cast("double")
    named = lambda value, label, source: F.struct(value.alias("wavelength"), label.alias("rad_symbol"), F.lit(source).alias("source"))
    label = lambda value: F.format_string("%.5fÅ", value)
    if forced is not None:
        return named(F.lit(float(forced)), label(F.lit(float(forced))), "custom")
    default = named(F.lit(CU_KA), F.lit("CuKα"), "default_CuKa")
    if not use_own:
        return default
    return F.when(w > 0.1, named(w, F.coalesce(F.nullif(_c(symbol), F.lit("")), label(w)), "cod")).otherwise(default)


def fit_quality(rwp, chi2) -> Column:
    """good, medium or bad."""
    r, x = _c(rwp), _c(chi2)
    return F.when((r < 0.10) & (x < 2.0), "good").when((r < 0.20) & (x < 5.0), "medium").otherwise("bad")


def reliability_flag(has_intensities) -> Column:
    """A warning where a pattern is known to lack structure factors, so that its fit can't be relied on."""
    return F.when(~_c(has_intensities), "[!sem F2]").otherwise("")
