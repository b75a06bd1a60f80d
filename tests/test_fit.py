import numpy as np
import pytest
from pyspark.sql import Row

from difframe import pipeline
from difframe.operators import kernels as k
from difframe.operators.fit import find_peaks, fit_candidates, fit_mixtures, figures_of_merit, scan_rows, weight_fractions

T = np.arange(20, 80, 0.05)


def _lines(*pairs, f=100.0):
    return [Row(h=1, k=0, l=0, d_hkl=float(1.54056 / 2 / np.sin(np.radians(t / 2))), two_theta=float(t), multiplicity=8, f_sq=f * i, intensity_rel=float(i)) for t, i in pairs]


A, B, C = _lines((25, 100), (38, 40), (61, 20)), _lines((30, 100), (45, 60), (70, 30)), _lines((22, 100), (52, 50))
KIND = "scan_id string, cod_id int, reflections array<struct<h:int,k:int,l:int,d_hkl:double,two_theta:double,multiplicity:int,f_sq:double,intensity_rel:double>>"


def _unit(lines, absolute=False):
    t, i = np.array([x.two_theta for x in lines]), np.array([x.intensity_rel for x in lines])
    w = k.absolute_weights(t, np.array([x.multiplicity for x in lines]), np.array([x.f_sq for x in lines])) if absolute else i
    return k.line_profile(T, t, w, **k.INSTRUMENT)[0]


def _points(spark, y, scan="s"):
    return spark.createDataFrame([Row(scan_id=scan, tth=float(t), iobs=float(v), sigma=float(max(v, 1) ** 0.5)) for t, v in zip(T, y, strict=True)])


def test_local_maxima_and_plateaus():
    assert k.local_maxima(np.array([0, 1, 0, 2, 2, 2, 0, 3])).tolist() == [1, 4]
    assert k.local_maxima(np.array([1.0, 1.0])).tolist() == [] and k.local_maxima(np.array([5, 5, 5, 5])).tolist() == []
    y = np.array([0, 5, 1, 6, 0, 4, 3, 4, 0.0])
    p = k.local_maxima(y)
    assert p.tolist() == [1, 3, 5, 7] and k.prominences(y, p).tolist() == [4, 6, 4, 4]
    assert k.thin_out(y, p, 3).tolist() == [3, 7]


def test_detect_peaks(spark):
    y = 100 + 50 * _unit(A)
    got = find_peaks(scan_rows(_points(spark, y))).collect()
    assert [r.two_theta for r in got] == pytest.approx([25, 38, 61], abs=0.06)
    assert find_peaks(scan_rows(_points(spark, np.full(len(T), 7.0)))).count() == 0
    assert find_peaks(scan_rows(_points(spark, y).limit(2))).count() == 0


def test_scale_is_recovered(spark):
    y = 10 * _unit(A) + 50 + 2 * T
    cand = spark.createDataFrame([("s", 1, A), ("s", 2, B), ("s", 3, [])], KIND)
    r = {x.cod_id: x for x in fit_candidates(scan_rows(_points(spark, y)), cand).collect()}
    assert r[1].scale == pytest.approx(10, rel=1e-6) and r[1].rwp < 1e-6 and r[1].rank == 1 and r[1].n_peaks == 3
    assert r[3].scale == 0.0 and r[3].n_peaks == 0 and r[2].rwp > 0.01


def test_non_negative_fit():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, y = rng.normal(size=(60, 5)), rng.normal(size=60)
        x = k.non_negative(a, y)
        slope = a.T @ (y - a @ x)
        assert (x >= 0).all() and (slope <= 1e-8).all() and np.abs(slope[x > 0]).max(initial=0) < 1e-8
    with pytest.raises(ValueError):
        k.mixture_fit(T, T, T, [], 4)


def test_mixture_and_fractions(spark):
    y = 0.003 * _unit(A, True) + 0.007 * _unit(B, True) + 80 + T
    phases = spark.createDataFrame([("s", 1, A), ("s", 2, B), ("s", 3, C)], KIND)
    got = {r.cod_id: r for r in fit_mixtures(scan_rows(_points(spark, y)), phases).collect()}
    assert [got[i].scale for i in (1, 2, 3)] == pytest.approx([0.003, 0.007, 0], abs=1e-6)
    st = spark.createDataFrame([(1, 4, "Si O2", 5.0, 5.0, 5.0, 90.0, 90.0, 90.0), (2, 4, "Si O2", 5.0, 5.0, 5.0, 90.0, 90.0, 90.0), (3, None, "Si O2", 5.0, 5.0, 5.0, 90.0, 90.0, 90.0)], "cod_id int, z int, formula string, a double, b double, c double, alpha double, beta double, gamma double")
    w = {r.cod_id: r.weight_pct for r in weight_fractions(fit_mixtures(scan_rows(_points(spark, y)), phases), st).collect()}
    assert w[1] == pytest.approx(30, abs=0.1) and w[2] == pytest.approx(70, abs=0.1) and w[3] == 0 and sum(w.values()) == pytest.approx(100)


def test_figures_native_equal_numpy(spark):
    rng = np.random.default_rng(1)
    o, c, s = rng.uniform(1, 9, 50), rng.uniform(1, 9, 50), rng.uniform(0, 2, 50)
    df = spark.createDataFrame([Row(g=1, iobs=float(a), icalc=float(b), sigma=float(e)) for a, b, e in zip(o, c, s, strict=True)])
    got, want = figures_of_merit(df, ["g"], 5).first(), k.figures(o, c, s, 5)
    for n, v in want.items():
        assert got[n] == pytest.approx(v)
    assert k.figures(o, o, s, 5)["rwp"] == 0 and k.figures(o, 0 * o, s, 5)["rwp"] == pytest.approx(1)


def test_identify_end_to_end(spark):
    pat = [Row(id=i, cod_id=i, wavelength=1.54056, rad_symbol="CuKa", has_intensities=True, n_reflections=3, calculated_at=None, reflections=x) for i, x in ((1, A), (2, B), (3, C))]
    kind = "id long, cod_id int, wavelength double, rad_symbol string, has_intensities boolean, n_reflections int, calculated_at timestamp, " + KIND.split(", ", 2)[2]
    patterns = spark.createDataFrame(pat, kind)
    points = _points(spark, 20 * _unit(B) + 100, "x").union(_points(spark, 20 * _unit(A) + 100, "y"))
    best = {r.scan_id: r for r in pipeline.identify(points, patterns, min_matches=2).where("rank = 1").collect()}
    assert best["x"].cod_id == 2 and best["y"].cod_id == 1 and best["x"].rwp < 1e-3
    assert pipeline.viable(pipeline.identify(points, patterns, min_matches=2)).count() >= 2


def test_ties_and_unfittable_hits(spark):
    """Every phase that ties at the last place is fitted, and one without a Cu pattern takes no place."""
    kind = "id long, cod_id int, wavelength double, rad_symbol string, has_intensities boolean, n_reflections int, calculated_at timestamp, " + KIND.split(", ", 2)[2]
    pat = [Row(id=i, cod_id=i, wavelength=w, rad_symbol="x", has_intensities=True, n_reflections=3, calculated_at=None, reflections=x) for i, w, x in ((1, 0.71073, A), (2, 1.54056, A), (3, 1.54056, A), (4, 1.54056, C))]
    patterns, points = spark.createDataFrame(pat, kind), _points(spark, 20 * _unit(A) + 100)
    assert {r.cod_id for r in pipeline.identify(points, patterns, top=1).collect()} == {2, 3}
    assert [(r.cod_id, r.n_matched) for r in pipeline.dropped(points, patterns, top=1).collect()] == [(1, 3)]


def test_list_of_candidates(spark, tmp_path, capsys):
    """A list in place of the catalogue: repeated, empty and null candidates, and the command line over its CSV form."""
    from difframe.__main__ import main

    kind = KIND.split(", ", 1)[1]
    listed = spark.createDataFrame([(1, A), (2, B), (2, B[:1]), (3, C), (4, []), (5, None), (None, A)], kind)
    points = _points(spark, 20 * _unit(B) + 100)
    fits = pipeline.identify_listed(points, listed, min_matches=2).collect()
    best = next(r for r in fits if r["rank"] == 1)
    assert best.cod_id == 2 and best.rwp < 1e-3 and len({r.cod_id for r in fits}) == len(fits) <= 3
    assert pipeline.identify_listed(points, listed.limit(0)).count() == 0
    assert [r.cod_id for r in pipeline.identify_listed(points, listed, top=1).collect()] == [2]
    st = spark.createDataFrame([(i, 4, "Si O2", 5.0, 5.0, 5.0, 90.0, 90.0, 90.0) for i in (1, 2, 3)], "file int, z int, formula string, a double, b double, c double, alpha double, beta double, gamma double")
    shares = pipeline.quantify_listed(points, listed, st.withColumnRenamed("file", "cod_id"), top_k=1, min_matches=2).collect()
    assert [(r.cod_id, round(r.weight_pct)) for r in shares] == [(2, 100)]

    (tmp_path / "x.xye").write_text("\n".join(f"{r.tth} {r.iobs} {r.sigma}" for r in points.orderBy("tth").collect()))
    listed.where("cod_id > 0").selectExpr("cod_id", "coalesce(replace(to_json(reflections), 'f_sq', 'F_sq'), '?') reflections").coalesce(1).write.csv(str(tmp_path / "list"), header=True, escape='"')
    st.write.parquet(str(tmp_path / "st"))
    capsys.readouterr()
    main([str(tmp_path / "x.xye"), "--candidates", str(tmp_path / "list"), "--min-matches", "2", "--phases", "1", "--structures", str(tmp_path / "st")])
    said = capsys.readouterr().out
    assert "100.0" in said and "could not be read" in said
    with pytest.raises(SystemExit):
        main(["x.xye"])


def test_many_candidates_of_one_scan(spark):
    cand = spark.createDataFrame([("s", i, A) for i in range(150)], KIND)
    r = fit_candidates(scan_rows(_points(spark, 10 * _unit(A) + 50 + 2 * T)), cand).collect()
    assert sorted(x.cod_id for x in r) == list(range(150)) and all(x.scale == pytest.approx(10, rel=1e-6) for x in r)


def test_registered_scan_queries_cut_nothing(spark, sf, monkeypatch):
    from difframe.plans import catalogue, reference

    seen = []
    keep = lambda *a, top=50, top_k=4, **o: seen.append((top, top_k)) or spark.range(0).selectExpr("id scan_id", "id cod_id", "0 n_matched", "0d rwp", "0d chi2", "0 n_peaks", "0 rank", "0d weight_pct")
    monkeypatch.setattr(reference.pipeline, "identify", keep)
    monkeypatch.setattr(reference.pipeline, "quantify", keep)
    for n in ("identify_scans", "quantify_scans"):
        catalogue.QUERIES[n](spark, sf)
    assert seen == [(50, 4), (50, 4)]
