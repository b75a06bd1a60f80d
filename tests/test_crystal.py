import math

import pytest
from pyspark.sql import functions as F

from difframe.functions import chemistry as ch
from difframe.functions import crystal as cr
from difframe.operators.pattern import calculate_patterns, lines_of, refusals


def _one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def _spacings(spark, rows):
    """Spacings of (system, cell, hkl) rows, in order."""
    df = spark.createDataFrame([(i, s, *map(float, c), *t) for i, (s, c, t) in enumerate(rows)], "i int, s string, a double, b double, c double, al double, be double, ga double, h int, k int, l int")
    m = df.select("i", "h", "k", "l", cr.reciprocal_metric("a", "b", "c", "al", "be", "ga", "s").alias("m"))
    return [r.d for r in m.select("i", cr.d_spacing("h", "k", "l", "m").alias("d")).orderBy("i").collect()]


def test_spacings_agree_with_the_triclinic_form(spark):
    cells = (("cubic", (4, 4, 4, 90, 90, 90)), ("tetragonal", (4, 4, 6, 90, 90, 90)), ("orthorhombic", (4, 5, 6, 90, 90, 90)), ("hexagonal", (4, 4, 6, 90, 90, 120)), ("trigonal", (4, 4, 6, 90, 90, 120)), ("monoclinic", (4, 5, 6, 90, 104, 90)))
    own = [(s, c, t) for s, c in cells for t in ((1, 0, 0), (1, 2, -3), (0, 1, 1), (2, -1, 1))]
    assert _spacings(spark, own) == pytest.approx(_spacings(spark, [("triclinic", c, t) for _, c, t in own]), rel=1e-9)
    odd = [("cubic", (4, 4, 4, 90, 90, 90), (2, 0, 0)), ("triclinic", (4, 4, 4, 130, 130, 130), (1, 0, 0)), ("cubic", (0, 0, 0, 90, 90, 90), (1, 0, 0)), ("unknown", (4, 4, 4, 90, 90, 90), (1, 0, 0))]
    assert _spacings(spark, odd) == [2.0, None, None, None]


def test_angles(spark):
    r = _one(spark, a=cr.bragg_two_theta(F.lit(2.087)), b=cr.bragg_two_theta(F.lit(0.5)), c=cr.two_theta_to_d(cr.bragg_two_theta(F.lit(2.0))), lp=cr.lorentz_polarization(F.lit(90.0)), lp0=cr.lorentz_polarization(F.lit(0.0)), w=cr.d_window(F.lit(40.0)), far=cr.d_window(F.lit(120.0)))
    assert r.a == pytest.approx(43.32, abs=0.02) and r.b is None and r.c == pytest.approx(2.0) and r.lp == pytest.approx(2.828, abs=1e-3) and r.lp0 == 0.0
    assert r.w.d_lo < r.w.d_hi and r.w.d_hi - r.w.d_lo > r.far.d_hi - r.far.d_lo


def test_profiles(spark):
    r = _one(spark, top=cr.pseudo_voigt(F.lit(5.0), F.lit(5.0), F.lit(0.1)), half=cr.pseudo_voigt(F.lit(5.05), F.lit(5.0), F.lit(0.1)), other=cr.pseudo_voigt(F.lit(4.95), F.lit(5.0), F.lit(0.1)), g=cr.gaussian(F.lit(5.05), F.lit(5.0), F.lit(0.1)), w=cr.caglioti_fwhm(F.lit(30.0)), w2=cr.caglioti_fwhm(F.lit(90.0)))
    assert r.top == 1.0 and r.half == pytest.approx(0.5) and r.half == pytest.approx(r.other) and r.g == pytest.approx(0.5) and 0 < r.w < r.w2


def test_systems_lattices_and_multiplicity(spark):
    numbers = {0: "unknown", 1: "triclinic", 15: "monoclinic", 16: "orthorhombic", 142: "tetragonal", 143: "trigonal", 194: "hexagonal", 195: "cubic", 231: "unknown", None: "unknown"}
    df = spark.createDataFrame([(n,) for n in numbers], "n int")
    assert {r.n: r.s for r in df.select("n", cr.crystal_system("n").alias("s")).collect()} == numbers
    symbols = {"F m -3 m": "F", " i 4": "I", "": "P", "   ": "P", None: "P", "X": "P"}
    df = spark.createDataFrame([(s,) for s in symbols], "s string")
    assert {r.s: r.t for r in df.select("s", cr.lattice_type("s").alias("t")).collect()} == symbols
    r = _one(spark, f=cr.centering_allowed(F.lit(1), F.lit(-1), F.lit(1), F.lit("F")), i=cr.centering_allowed(F.lit(-1), F.lit(0), F.lit(0), F.lit("I")), a=cr.multiplicity(F.lit(1), F.lit(-1), F.lit(-1), F.lit("cubic")), b=cr.multiplicity(F.lit(1), F.lit(-1), F.lit(-1), F.lit("cubic"), physical=True))
    assert r.f and not r.i and (r.a, r.b) == (24, 8)


def test_volume_and_mass(spark):
    r = _one(spark, v=cr.cell_volume(*[F.lit(x) for x in (5.0, 5.0, 5.0, 90.0, 90.0, 90.0)]), w=cr.cell_volume(*[F.lit(x) for x in (4.913, 4.913, 5.405, 90.0, 90.0, 120.0)]))
    assert r.v == pytest.approx(125) and r.w == pytest.approx(112.99, abs=0.01)
    masses = {"Si O2": 60.083, "CaCO3": 100.086, "- Br0.5 -": 39.952, "Xx2": None, "": None, None: None, "Co": 58.933}
    df = spark.createDataFrame([(f,) for f in masses], "f string")
    for x in df.select("f", ch.molar_mass("f").alias("m")).collect():
        assert (x.m is None) if masses[x.f] is None else x.m == pytest.approx(masses[x.f], abs=1e-3)


def test_scattering_factors(spark):
    e = lambda t: ch.scattering_factor(ch.element_symbol(F.lit(t)), F.lit(0.0))
    r = _one(spark, fe=e("Fe3+"), o=e("O2-"), blank=e("  "), unknown=e("Pu"), own=ch.scattering_factor(F.lit("Pb"), F.lit(0.0), {"Pb": (1, 2, 3, 4, 0, 0, 0, 0, 72)}))
    assert r.fe == pytest.approx(26, abs=0.1) and r.o == pytest.approx(8, abs=0.1) and r.blank == 1.0 and r.unknown == 94 and r.own == 82


def _structures(spark, rows):
    return spark.createDataFrame(rows, "cod_id int, a double, b double, c double, alpha double, beta double, gamma double, sgnumber int, sg string")


def test_copper_lines(spark):
    cu = _structures(spark, [(1, 3.615, 3.615, 3.615, None, 90.0, 90.0, 225, "F m -3 m"), (3, None, 1.0, 1.0, 90.0, 90.0, 90.0, 225, "F"), (4, 4.0, 4.0, 4.0, 90.0, 90.0, 90.0, 0, "P")])
    got = sorted((r.two_theta, abs(r.h), abs(r.k), abs(r.l)) for r in lines_of(cu, cr.CU_KA, hkl_max=3).collect())
    assert [x[1:] for x in got[:3]] == [(1, 1, 1), (0, 0, 2), (0, 2, 2)]
    for (t, *_), want in zip(got, (43.3, 50.4, 74.1), strict=False):
        assert t == pytest.approx(want, abs=0.1)


def test_refusals(spark):
    s = _structures(spark, [(1, 3.6, 3.6, 3.6, None, 90.0, 90.0, 225, "F"), (2, 30.0, 30.0, 30.0, 90.0, 90.0, 90.0, 225, "F"), (3, None, 1.0, -1.0, 90.0, 90.0, 90.0, 225, "F"), (4, 4.0, 4.0, 4.0, 90.0, 90.0, 90.0, 0, "P"), (5, 4.0, 4.0, 4.0, 90.0, 90.0, 90.0, None, "P")])
    rows = {r.cod_id: (r.status, r.error_msg) for r in refusals(s, 20_000.0).collect()}
    assert rows == {2: ("StructureTooLarge", "cell volume 27000"), 3: ("NoCell", "cell axes missing 1.0 -1.0"), 4: ("UnknownSystem", "space group 0"), 5: ("NoSpaceGroup", "space group missing")}
    assert 2 not in {r.cod_id for r in refusals(s).collect()} and {r.cod_id for r in lines_of(s, cr.CU_KA, hkl_max=2).select("cod_id").distinct().collect()} == {1, 2}


def test_sites_in_several_rows(spark, monkeypatch):
    """Structure factors are the same however few sites travel in one row; a repeated site counts once."""
    from difframe.operators import pattern

    rows = [(1, f"A{i}", "Ti" if i % 3 else "Pb2+", i / 17, i / 23, i / 29, None if i % 2 else 0.5, 0.01 * i, "a", "m") for i in range(25)]
    sites = spark.createDataFrame(rows + rows[:7], "cod_id int, label string, type_symbol string, fract_x double, fract_y double, fract_z double, occupancy double, u_iso_or_equiv double, wyckoff_symbol string, site_symmetry string")
    lines = spark.createDataFrame([(1, 1, 0, 2, 2.5), (1, 2, 1, -1, 1.5), (2, 1, 1, 1, 2.0)], "cod_id int, h int, k int, l int, d double")
    got = {}
    for n in (500, 4):
        monkeypatch.setattr(pattern, "SITES_A_ROW", n)
        got[n] = {(r.cod_id, r.h): r.f_sq for r in pattern.structure_factors(lines, sites).collect()}
    assert got[500][2, 1] is None and got[4][2, 1] is None
    for (i, h), f in got[500].items():
        if f is None:
            continue
        k, l, d = next((r.k, r.l, r.d) for r in lines.collect() if (r.cod_id, r.h) == (i, h))  # noqa: E741
        s2, total = (1 / (2 * d)) ** 2, 0
        for _, _, e, x, y, z, occ, u, *_ in rows:
            c = ch.CROMER_MANN[e.rstrip("2+")]
            fj = sum(c[j] * math.exp(-c[j + 4] * s2) for j in range(4)) + c[8]
            total += fj * (occ or 1.0) * math.exp(-8 * math.pi**2 * u * s2) * complex(math.cos(p := 2 * math.pi * (h * x + k * y + l * z)), math.sin(p))
        assert f == pytest.approx(abs(total) ** 2) and got[4][i, h] == pytest.approx(f)


def test_scattering_factors_at_zero():
    """At angle 0 a factor is near the number of electrons."""
    for z, e in enumerate(ch.ELEMENTS, 1):
        if e in ch.CROMER_MANN:
            assert sum(ch.CROMER_MANN[e][:4]) + ch.CROMER_MANN[e][8] == pytest.approx(z, abs=0.12), e
    assert len(ch.CROMER_MANN) == 85


def _numpy_lines(cell, system, lattice, n):
    a, b, c, al, be, ga = cell
    x, y, z = (math.cos(math.radians(v)) for v in (al, be, ga))
    import numpy as np

    g = np.linalg.inv(np.array([[a * a, a * b * z, a * c * y], [a * b * z, b * b, b * c * x], [a * c * y, b * c * x, c * c]]))
    seen, out = set(), []
    for h in range(n + 1):
        for k in range(-n, n + 1):
            for m in range(-n, n + 1):
                if (h == 0 and k < 0) or (h == 0 and k == 0 and m <= 0) or (lattice == "I" and (h + k + m) % 2):
                    continue
                d = 1 / math.sqrt(np.array([h, k, m]) @ g @ np.array([h, k, m]))
                r = cr.CU_KA / 2 / d
                if d < 0.4 or r > 1 or not 5 <= 2 * math.degrees(math.asin(r)) <= 90 or round(d * 1000) in seen:
                    continue
                seen.add(round(d * 1000))
                out.append(round(d, 6))
    return sorted(out)


def test_lines_equal_brute_force(spark):
    cells = {1: ((5.1, 6.3, 7.7, 81.0, 95.0, 103.0), 2, "P -1", "triclinic", "P"), 2: ((5.1, 6.3, 7.7, 90.0, 101.0, 90.0), 15, "I 2/a", "monoclinic", "I")}
    df = _structures(spark, [(i, *c, n, s) for i, (c, n, s, _, _) in cells.items()])
    got = lines_of(df, cr.CU_KA, hkl_max=4).select("cod_id", F.round("d", 6).alias("d")).collect()
    for i, (c, _, _, system, lattice) in cells.items():
        assert sorted(r.d for r in got if r.cod_id == i) == _numpy_lines(c, system, lattice, 4)


def test_patterns_with_and_without_sites(spark):
    st = _structures(spark, [(1, 4.0, 4.0, 4.0, 90.0, 90.0, 90.0, 221, "P m -3 m"), (2, 4.0, 4.0, 4.0, 90.0, 90.0, 90.0, 221, "P m -3 m")])
    sites = spark.createDataFrame([(1, "Na1", "Na", 0.0, 0.0, 0.0, None, 0.01), (1, "Cl1", "Cl", 0.5, 0.5, 0.5, 0.0, None)], "cod_id int, label string, type_symbol string, fract_x double, fract_y double, fract_z double, occupancy double, u_iso_or_equiv double")
    r = {x.cod_id: x for x in calculate_patterns(st, sites, cr.CU_KA, hkl_max=3).collect()}
    assert r[1].has_intensities and max(x.intensity_rel for x in r[1].reflections) == 100.0
    assert not r[2].has_intensities and r[2].n_reflections == r[1].n_reflections
    angles = [x.two_theta for x in r[1].reflections]
    assert angles == sorted(angles)


def test_registered_patterns_use_the_whole_grid(spark, tmp_path):
    """Every line of the full grid, also of long and of flat cells, against brute force."""
    from difframe.plans.reference import calculated_patterns

    cells = {1: ((5.1, 6.3, 7.7, 81.0, 95.0, 103.0), 2, "P -1", "triclinic", "P"), 2: ((14.2, 6.3, 17.7, 90.0, 131.0, 90.0), 15, "I 2/a", "monoclinic", "I"), 3: ((4.0, 5.0, 24.0, 35.0, 40.0, 70.0), 2, "P -1", "triclinic", "P")}
    df = _structures(spark, [(i, *c, n, s) for i, (c, n, s, _, _) in cells.items()])
    want = {i: _numpy_lines(c, system, lattice, 15) for i, (c, _, _, system, lattice) in cells.items()}
    got = lines_of(df, cr.CU_KA).select("cod_id", F.round("d", 6).alias("d")).collect()
    assert all(sorted(r.d for r in got if r.cod_id == i) == want[i] for i in cells)
    df.withColumnRenamed("cod_id", "file").write.parquet(str(tmp_path / "cod_data.parquet"))
    spark.createDataFrame([], "cod_id int, label string, type_symbol string, fract_x double, fract_y double, fract_z double, occupancy double, u_iso_or_equiv double").write.parquet(str(tmp_path / "atomic_sites.parquet"))
    assert {r.cod_id: r.n_reflections for r in calculated_patterns(spark, str(tmp_path)).collect()} == {i: len(w) for i, w in want.items()}


def test_large_cells_have_patterns(spark):
    st = _structures(spark, [(1, 30.0, 30.0, 30.0, 90.0, 90.0, 90.0, 225, "F")])
    sites = spark.createDataFrame([(1, "Na1", "Na", 0.0, 0.0, 0.0, None, 0.01)], "cod_id int, label string, type_symbol string, fract_x double, fract_y double, fract_z double, occupancy double, u_iso_or_equiv double")
    r = calculate_patterns(st, sites, cr.CU_KA, hkl_max=3).first()
    assert r is not None and r.has_intensities and r.n_reflections > 0
