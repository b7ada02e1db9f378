"""Gain solves, clusters, low-pass filters, source fits, transits, timing and lookups against numpy and brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meridian.operators import clusters as C
from meridian.operators import eigen as E
from meridian.operators import inputs as I
from meridian.operators import lookup as L
from meridian.operators import lowpass as P
from meridian.operators import masks as D
from meridian.operators import sources as S
from meridian.operators import timing as T
from meridian.operators import transits as U
from meridian.operators import windows as W
from meridian.operators.rounds import components
from meridian.sources import products
from meridian.streaming import groups as G


def no_diagonal(a, rounds=5):
    a = a.copy()
    np.fill_diagonal(a, 0)
    value, vector = np.linalg.eigh(a)
    for _ in range(rounds):
        np.fill_diagonal(a, value[-1] * np.abs(vector[:, -1]) ** 2)
        value, vector = np.linalg.eigh(a)
    return value, vector


def test_leading_gain_equals_eigh(spark):
    rng, rows, want = np.random.default_rng(1), [], {}
    for f, n in ((0, 9), (1, 14)):
        g = rng.normal(size=n) + 1j * rng.normal(size=n) + 1
        noise = rng.normal(size=(n, n)) + 1j * rng.normal(size=(n, n))
        a = np.outer(g, g.conj()) + 0.1 * (noise + noise.conj().T) + np.diag(rng.uniform(1, 3, n))
        size = np.sqrt(a.diagonal().real)
        value, vector = no_diagonal(a / np.outer(size, size))
        gain = size * vector[:, -1] * np.sqrt(value[-1])
        want[f] = (gain / gain[3], value[-1], value[-2], 1.4826 * np.median(np.abs(value[:-1] - np.median(value[:-1]))))
        rows += [(f, i, j, float(a[i, j].real), float(a[i, j].imag)) for i in range(n) for j in range(i, n)]
    rows += [(2, 0, 0, 1.0, 0.0), (2, 0, 1, float("nan"), 0.0), (2, 1, 1, 1.0, 0.0), (3, 0, 0, 0.0, 0.0), (3, 0, 1, 0.0, 0.0), (3, 1, 1, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "freq_id int, input_a int, input_b int, re double, im double")
    got = E.leading_gain(df, ["freq_id"], reference=3).toPandas().sort_values("input_id")
    assert set(got.freq_id) <= {0, 1, 3} and (got[got.freq_id == 3][["re", "im", "error", "value1"]] == 0).all().all()
    for f, (gain, one, two, scatter) in want.items():
        x = got[got.freq_id == f]
        assert np.abs(x.re.to_numpy() + 1j * x.im.to_numpy() - gain).max() < 1e-4
        assert math.isclose(x.value1.iloc[0], one, rel_tol=1e-6) and math.isclose(x.value2.iloc[0], two, rel_tol=0.05)
        assert math.isclose(x.dynamic_range.iloc[0], x.value1.iloc[0] / x.value2.iloc[0], rel_tol=1e-9)
    with pytest.raises(ValueError):
        E.leading_gain(df, ["freq_id"], norm="other")


def test_scatter_of_noise_is_its_eigenvalues():
    """The law behind the error: the MAD of a noise matrix's eigenvalues follows from its summed squares."""
    rng, n = np.random.default_rng(3), 400
    a = rng.normal(size=(n, n)) + 1j * rng.normal(size=(n, n))
    a = (a + a.conj().T) / 2
    value = np.linalg.eigvalsh(a)
    mad = np.median(np.abs(value - np.median(value)))
    assert math.isclose(E.SEMICIRCLE * 2 * math.sqrt((np.abs(a) ** 2).sum() / n), mad, rel_tol=0.03)


def test_eigen_gains_equal_numpy(spark):
    rng, n = np.random.default_rng(4), 8
    pol = ["X", "Y"] * (n // 2)
    evec = rng.normal(size=(2, n)) + 1j * rng.normal(size=(2, n))
    evec /= np.exp(1j * np.angle(evec[:, :1]))
    evec[1] *= -1
    value = np.array([5.0, 3.0])
    rows = [(0, 0, i, *(float(x) for k in (0, 1) for x in (evec[k, i].real, evec[k, i].imag)), 2.0, 1.0) for i in range(n)]
    vectors = spark.createDataFrame(rows, "freq_id int, t int, input_id int, re1 double, im1 double, re2 double, im2 double, auto double, w double")
    values = spark.createDataFrame([(0, 0, 5.0, 3.0, 0.1), (0, 1, 0.5, 0.2, 0.1)], "freq_id int, t int, value1 double, value2 double, rms double")
    inputs = spark.createDataFrame([(i, pol[i], float(i), float(2 * i)) for i in range(n)], "input_id int, pol string, x double, y double")
    call = lambda v: E.eigen_gains(vectors, v, inputs, {"X": 0, "Y": 1}, 0, F.col("t") == 1, F.lit(False), F.lit(600.0), F.lit(4.0), F.lit(0.2), 0.7, 0.86)
    got = {r["input_id"]: r for r in call(values).collect()}
    sign = 1 - 2.0 * (evec[:, 0].real < 0)
    resp = sign[:, None] * evec * np.sqrt(value)[:, None]
    for which in ("X", "Y"):
        mask = np.array([p == which for p in pol])
        mu, v = np.linalg.eigh(resp.conj() @ (mask[:, None] * resp.T))
        full = mu[-1] * (resp.T @ (v[:, -1] / value))
        first = 0 if which == "X" else 1
        for i in np.flatnonzero(mask):
            u, w = (i - first) * 600 / 299.792458, 2 * (i - first) * 600 / 299.792458
            phase = 2 * np.pi * (np.cos(0.7) * np.sin(0.2) * -u + (np.cos(0.86) * np.sin(0.7) - np.sin(0.86) * np.cos(0.7) * np.cos(0.2)) * w)
            want = full[i] * np.exp(-1j * np.angle(full[first])) * np.exp(1j * phase) / 2
            assert abs(got[i]["re"] + 1j * got[i]["im"] - want) < 1e-9
            assert math.isclose(got[i]["w"], mu[-1] * 4 / (0.01 * 2.0), rel_tol=1e-9)
    assert all(r["w"] == 0 for r in call(values.withColumn("rms", F.lit(0.0))).collect())


def test_components_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    df = spark.createDataFrame(edges, "a long, b long")
    vertices = spark.createDataFrame([(i,) for i in [*range(41), *range(100, 130), 200, 201, 300]], "v long")
    got = {r["v"]: r["component"] for r in components(df, vertices, "v").collect()}
    assert all(got[i] == (0 if i < 50 else 100 if i < 150 else 200 if i < 250 else 300) for i in got) and len(got) == 74


def linked(points, cut):
    near = ((points[:, None] - points[None]) ** 2).sum(-1) <= cut * cut
    label = -np.ones(len(points), int)
    for i in range(len(points)):
        todo = [i] if label[i] < 0 else []
        label[todo] = i
        while todo:
            new = np.flatnonzero(near[todo.pop()] & (label < 0))
            label[new] = i
            todo += new.tolist()
    return label


def test_single_linkage_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    points = np.vstack([rng.uniform(0, 9, (220, 3)), rng.normal(4, 0.03, (400, 3)), np.full((60, 3), -2.5), -rng.uniform(0, 3, (20, 3))])
    rows = [(i, *map(float, x)) for i, x in enumerate(points)]
    df = spark.createDataFrame([*rows, (9999, None, 1.0, 1.0)], "i long, x double, y double, z double")
    got = {r["i"]: r["cluster"] for r in C.single_linkage(df, "i", ["x", "y", "z"], 0.9).collect()}
    want = linked(points, 0.9)
    assert got.pop(9999) == 9999 and [got[i] for i in range(len(points))] == want.tolist()
    assert C.single_linkage(df.limit(0), "i", ["x", "y", "z"], 0.9).count() == 0


def test_single_linkage_at_the_cut(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 0.0), (3, 2.0000001, 0.0), (4, 2.0, 1.0)], "i long, x double, y double")
    assert {r["i"]: r["cluster"] for r in C.single_linkage(df, "i", ["x", "y"], 1.0).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}


def test_spectral_lines(spark):
    at = [(1, 600.0, 10.0, 0.0, 5.0), (2, 600.4, 10.0, 0.0, -9.0), (3, 600.4, 10.4, 0.0, 9.0), (4, 650.0, 90.0, 0.1, 3.0), (5, 600.2, 10.2, 0.0, 50.0)]
    pixels = spark.createDataFrame([(*x, p) for x in at for p in (0, 1)], "pixel long, mhz double, ra double, el double, val double, pol int")
    pixels = pixels.withColumn("w", F.lit(0.5)).withColumn("bad", (F.col("pixel") != 5) | (F.col("pol") == 0))
    mean = C.polarisation_mean(pixels, ["pixel", "mhz", "ra", "el"])
    got = C.spectral_lines(mean, "pixel", "mhz", "ra", "el", (F.lit(0.5), F.lit(0.5), F.lit(0.5)), 49.0, 0.4, 1.0).orderBy("line").collect()
    assert [(r["line"], r["depth"], r["s2n"], r["n_pixels"]) for r in got] == [(1, -9.0, 9.0, 3), (4, 3.0, 3.0, 1)]
    assert math.isclose(got[1]["dec"], 49 + math.degrees(math.asin(0.1))) and math.isclose(got[0]["z"], 1420.40575 / 600.4 - 1)


def filtered(gain, mhz, good, half_width, nsigma, rounds):
    """The filter of gain errors once more, with plain loops and solves."""
    cov = np.array([[np.sinc(2 * half_width * (a - b)) for b in mhz] for a in mhz])
    value, vector = np.linalg.eigh(cov)
    modes = vector[:, value > 1e-12 * value.max()]
    good = good.copy()
    for turn in range(rounds):
        kept = modes[good]
        smooth = modes @ np.linalg.lstsq(kept, gain[good], rcond=None)[0]
        if turn == rounds - 1:
            break
        ratio = gain / smooth
        n = gain.shape[1]
        mean = sum(ratio[:, i] * ratio[:, j].conj() for i in range(n) for j in range(i, n)) / (n * (n + 1) / 2)
        size = np.abs(mean - 1)
        above = [c for c in np.flatnonzero(good) if size[c] > nsigma * 1.48625 * np.median(size[good])]
        if not above:
            break
        good[max(above, key=lambda c: size[c])] = False
    return smooth, good


def test_gain_error_forty_rounds(spark):
    rng = np.random.default_rng(8)
    mhz = {c: 800 - 0.390625 * 4 * c for c in range(96)}
    f = np.array(list(mhz.values()))
    smooth = np.stack([(1 + 0.2 * k) * np.exp(2j * np.pi * 0.05 * f + 0.3j * k) for k in range(3)], axis=1)
    gain = smooth * (1 + 1e-3 * (rng.normal(size=smooth.shape) + 1j * rng.normal(size=smooth.shape)))
    spikes = rng.choice(np.arange(5, 90), 12, replace=False)
    gain[spikes] *= 1 + 0.05 * rng.uniform(1, 3, (12, 1))
    rows = [(7, c, i, float(gain[c, i].real), float(gain[c, i].imag), 0.0 if c in (2, 60) else 2.0) for c in mhz for i in range(3)]
    rows += [(7, c, 9, 1.0, 0.0, 0.0) for c in mhz] + [(8, c, 0, 1.0, 0.0, 0.0) for c in mhz]
    df = spark.createDataFrame(rows, "update_id long, freq_id int, input_id int, re double, im double, w double")
    got = P.gain_error(df, ["update_id"], mhz, half_width=0.1, rounds=40).toPandas()
    good = np.array([c not in (2, 60) for c in mhz])
    want, kept = filtered(gain, f, good, 0.1, 4.0, 40)
    assert not kept[spikes].any() and kept.sum() >= 96 - 2 - 12 - 6
    one = got[got.update_id == 7]
    assert one.rounds.iloc[0] > 12 and (got[got.update_id == 8][["re", "w", "smooth_re"]] == 0).all().all()
    for i in range(3):
        x = one[one.input_id == i].sort_values("freq_id")
        assert np.allclose(x.smooth_re + 1j * x.smooth_im, want[:, i], atol=1e-7) and (x.kept.to_numpy() == kept).all()
        assert np.allclose(x.re + 1j * x.im, gain[:, i] / want[:, i], atol=1e-7)
        assert np.allclose(x.w, np.where(kept, 2.0 * np.abs(want[:, i]) ** 2, 0.0))
    assert (one[one.input_id == 9][["re", "im", "w"]] == 0).all().all()


def test_narrowband_features(spark):
    rng = np.random.default_rng(9)
    mhz = {c: 800 - 0.390625 * 4 * c for c in range(64)}
    size = 2 + 0.3 * np.cos(np.arange(64) / 20) + 1e-3 * rng.normal(size=64)
    size[[10, 11, 40]] += (0.1, 0.2, -0.15)
    rows = [(1, c, float(size[c]), 0.0, 0.0 if c == 30 else 1.0) for c in range(64)] + [(2, c, 1.0, 0.0, 0.0) for c in range(64)]
    df = spark.createDataFrame(rows, "input_id int, freq_id int, re double, im double, w double")
    got = P.narrowband_features(df, ["input_id"], mhz, tau_cut=0.05, window=31).toPandas()
    zero = set(got[(got.input_id == 1) & (got.w == 0)].freq_id)
    assert {10, 11, 30, 40} <= zero and len(zero) <= 6 and (got[got.input_id == 2].w == 0).all()


def test_templates_equal_least_squares(spark):
    rng, k, n = np.random.default_rng(2), 3, 60
    s = rng.normal(size=(k, n)) + 1j * rng.normal(size=(k, n))
    a = np.array([1 + 2j, -0.5j, 3.0])
    v, w = a @ s + 0.1 * rng.normal(size=n), rng.uniform(0, 2, n)
    rows = [(0, *(float(x) for j in range(k) for x in (s[j, i].real, s[j, i].imag)), float(v[i].real), float(v[i].imag), float(w[i])) for i in range(n)] + [(1, *[1.0] * 6, 5.0, 5.0, None)]
    df = spark.createDataFrame(rows, "g int, " + ", ".join(f"x{j} double, y{j} double" for j in range(k)) + ", re double, im double, w double")
    templates = [(F.col(f"x{j}"), F.col(f"y{j}")) for j in range(k)]
    found = S.solve_templates(df, ["g"], templates)
    got = {r["g"]: np.array(r["a_re"]) + 1j * np.array(r["a_im"]) for r in found.collect()}
    want = np.linalg.lstsq(np.sqrt(w)[:, None] * s.T, np.sqrt(w) * v, rcond=None)[0]
    assert np.allclose(got[0], want) and np.allclose(got[1], 0)
    left = S.subtract_templates(df.where("g = 0"), ["g"], found, templates).toPandas()
    assert np.isclose(np.abs(left.re + 1j * left.im).sum(), np.abs(v - want @ s).sum())


def test_extended_sources_recover_planted(spark):
    rng, times, baselines = np.random.default_rng(6), 12, 25
    u = rng.uniform(-1, 1, baselines)
    phase = rng.uniform(0, 6, (2, times, baselines))
    amp = rng.normal(size=(2, times)) + 1j * rng.normal(size=(2, times)) + 2
    shape = np.array([0.4 - 0.2j, -0.7])
    rows = []
    for t in range(times):
        for b in range(baselines):
            v = sum(amp[s, t] * (1 + shape[s] * u[b] ** (s + 1)) * np.exp(1j * phase[s, t, b]) for s in (0, 1))
            rows.append((0, t, float(u[b]), float(phase[0, t, b]), float(phase[1, t, b]), float(v.real), float(v.imag), 1.0))
    df = spark.createDataFrame(rows, "f int, t int, u double, p double, q double, re double, im double, w double")
    wave = lambda c, k=None: (F.cos(c) * (1 if k is None else F.pow("u", F.lit(k))), F.sin(c) * (1 if k is None else F.pow("u", F.lit(k))))
    amps, shapes, progress = S.solve_extended(df, ["f"], "t", [[wave("p"), wave("p", 1)], [wave("q"), wave("q", 2)]], rounds=5)
    found = shapes.first()
    assert abs(complex(found["c_re"][1], found["c_im"][1]) - shape[0]) < 0.02 and abs(complex(found["c_re"][3], found["c_im"][3]) - shape[1]) < 0.02
    chisq = [r["chisq"] for r in progress.orderBy("round").collect()]
    assert chisq == sorted(chisq, reverse=True) and chisq[-1] < 0.01 * chisq[0]
    assert amps.count() == times


def kz(y, flag, windows, rounds, modes, least):
    """The filter by padding and one convolution with the whole kernel."""
    c = []
    for m, k in zip(windows, rounds):
        one = np.ones(1)
        for _ in range(k):
            one = np.convolve(one, np.ones(m) / m)
        c.append(one)
    half = [len(x) // 2 for x in c]
    v, f = np.where(flag, y, 0.0), flag.astype(float)
    for d in (0, 1):
        pad = [(half[d], half[d]) if k == d else (0, 0) for k in (0, 1)]
        v, f = np.pad(v, pad, mode=modes[d]), np.pad(f, pad, mode=modes[d])
    out = np.zeros((2, *y.shape))
    for i in range(y.shape[0]):
        for j in range(y.shape[1]):
            cut = np.s_[i : i + len(c[0]), j : j + len(c[1])]
            out[0, i, j], out[1, i, j] = (np.outer(*c) * v[cut]).sum(), (np.outer(*c) * f[cut]).sum()
    ok = out[1] >= least
    return np.where(ok, out[0] / np.where(ok, out[1], 1), 0.0), ok


@pytest.mark.parametrize("modes, windows, rounds", [(("reflect", "wrap"), (3, 5), (12, 8)), (("wrap", "reflect"), (3, 3), (2, 4))])
def test_kz_equals_convolution(spark, modes, windows, rounds):
    rng = np.random.default_rng(7)
    y, flag = rng.normal(size=(6, 11)), rng.uniform(size=(6, 11)) > 0.5
    rows = [(0, i, j, float(y[i, j]), 1.0 if flag[i, j] else 0.0) for i in range(6) for j in range(11) if flag[i, j] or (i + j) % 2]
    df = spark.createDataFrame(rows, "g int, i long, j long, val double, w double")
    got = W.kz_low_pass(df, ["g"], ("i", "j"), (6, 11), "val", windows, rounds, modes, 0.45).toPandas().sort_values(["i", "j"])
    want, ok = kz(y, flag, windows, rounds, modes, 0.45)
    assert np.allclose(got.val, want.ravel()) and (got.w.to_numpy() == ok.ravel()).all()
    kept = W.kz_low_pass(df, ["g"], ("i", "j"), (6, 11), "val", windows, rounds, modes, 0.45, F.lit(True)).toPandas().sort_values(["i", "j"])
    assert np.allclose(kept.val, np.where(flag, y, want).ravel())
    with pytest.raises(ValueError):
        W.kz_low_pass(df, ["g"], ("i", "j"), (6, 11), "val", modes=("mirror", "wrap"))


def test_transit_fit_equals_numpy(spark):
    rng, x = np.random.default_rng(10), np.linspace(-1.2, 1.2, 90)
    v = np.exp(2 - x**2 + 0.1 * x**3) * np.exp(1j * (2.9 + 0.8 * x - 0.5 * x**2)) + 0.02 * (rng.normal(size=90) + 1j * rng.normal(size=90))
    w = rng.uniform(0.5, 2, 90)
    rows = [(0, float(a), float(b.real), float(b.imag), float(c)) for a, b, c in zip(x, v, w)] + [(1, 0.0, 0.0, 0.0, 1.0), (1, 0.1, 1.0, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "g int, x double, re double, im double, w double")
    fit = U.transit_fit(df, ["g"], F.col("x"), F.lit(1.0))
    got = fit.toPandas().iloc[0]
    use = np.abs(x) <= 1
    a, y, s = x[use], v[use], w[use]
    turn = np.angle(y[np.argmin(np.abs(a))])
    phase = np.angle(y * np.exp(-1j * turn))
    weight = s * np.abs(y) ** 2
    design = np.vander(a, 6, increasing=True)
    for _ in range(5):
        solve = lambda z: np.linalg.lstsq(np.sqrt(weight)[:, None] * design, np.sqrt(weight) * z, rcond=None)[0]  # noqa: E731, B023
        amp, phi = solve(np.log(np.abs(y))), solve(phase)
        last, weight = weight, s * np.exp(2 * design @ amp)
    assert np.allclose(got.c_amp, amp, atol=1e-7) and np.allclose(np.array(got.c_phase) - [turn, 0, 0, 0, 0, 0], phi, atol=1e-7)
    covariance = np.linalg.inv(design.T @ (last[:, None] * design))
    assert np.allclose(np.array(got.cov_amp).reshape(6, 6), covariance, rtol=1e-5) and fit.count() == 1
    assert math.isclose(got.chisq_amp, (last * (np.log(np.abs(y)) - design @ amp) ** 2).sum(), rel_tol=1e-6) and got.ndof_amp == use.sum() - 6
    gain = U.gain_from_fit(fit).first()
    assert abs(complex(gain["re"], gain["im"]) - 1 / (np.exp(amp[0]) * np.exp(1j * (phi[0] + turn)))) < 1e-8
    assert math.isclose(gain["w"], np.exp(2 * amp[0]) / (2 * covariance[0, 0]), rel_tol=1e-5)
    assert U.gain_from_fit(fit, threshold=1e-9).first()["w"] == 0
    peak = fit.select(U.transit_peak(5, F.lit(1.0)).alias("x")).first()["x"]
    grid = np.linspace(-1, 1, 201)
    assert math.isclose(peak, grid[np.argmax(np.vander(grid, 6, increasing=True) @ amp)], abs_tol=1e-9)


def test_closest_ancestors(spark):
    chain = [(k, k + 1 if k < 40 else None, "map" if k == 40 else "gain", k) for k in range(41)]
    loop = [(100, 101, "gain", 0), (101, 102, "gain", 0), (102, 100, "gain", 0)]
    parents = spark.createDataFrame([*chain, *loop, (200, None, "gain", 5), (201, 999, "gain", 5), (300, None, "map", 6)], "dataset_id long, parent_id long, kind string, state long")
    starts = spark.createDataFrame([(x,) for x in (0, 39, 40, 100, 200, 201, 300, 777)], "dataset_id long")
    got = {r["dataset_id"]: (r["depth"], r["state"], r["known"]) for r in L.closest_ancestors(starts, parents, F.col("kind") == "map", "state").collect()}
    assert got == {0: (40, 40, True), 39: (1, 40, True), 40: (0, 40, True), 100: (None, None, True), 200: (None, None, True), 201: (None, None, True), 300: (0, 6, True), 777: (None, None, False)}
    with pytest.raises(RuntimeError):
        L.closest_ancestors(starts, parents, F.col("kind") == "map", "state", max_depth=10)
    find = lambda rows: {r["group"]: r["map"] for r in L.frequency_map_of(spark.createDataFrame(rows, "group string, dataset_id long"), parents, F.col("kind") == "map", "state", [300], "std").collect()}
    assert find([("a", 0), ("a", 39), ("a", None), ("b", 200), ("c", 300), ("c", None), ("d", 0), ("d", 777)]) == {"a": "40", "b": "std", "c": "std", "d": "40"}
    for rows, said in (([("x", 0), ("x", 200)], "multiple frequency maps"), ([("y", 777)], "no dataset is known")):
        with pytest.raises(Exception, match=said):
            find(rows)


def test_timing_corrections(spark):
    vis = spark.createDataFrame([(s, 0, 1, t, 1.0, 0.0, 1.0) for s, t0 in ((1, 10.0), (2, 60.0), (3, 200.0)) for t in (t0, t0 + 5)], "stream int, input_a int, input_b int, t double, re double, im double, w double")
    flags = spark.createDataFrame([(0.0, 50.0), (55.0, 90.0)], "start_t double, finish_t double")
    table = [(k, i, t, (i + 1) * k * t * 1e-9, 1.0) for k, lo, hi in ((1, 0.0, 30.0), (2, 0.0, 100.0), (3, 0.0, 100.0)) for i in (0, 1) for t in (lo, hi)]
    tables = spark.createDataFrame(table, "table_id int, input_id int, t double, delay double, w double")
    got = {(r["stream"], r["t"]): r for r in T.apply_timing_correction(vis, "stream", flags, tables, F.lit(600.0)).collect()}
    for (s, t), r in got.items():
        tau = 0.0 if s == 3 else (1 if s == 1 else 2) * -t * 1e-9
        assert abs(complex(r["re"], r["im"]) - np.exp(2j * np.pi * 600e6 * tau)) < 1e-9 and r["w"] == 1.0
    transits = spark.createDataFrame([(1, 12.0), (2, 62.0), (3, 3.0)], "stream int, transit_t double")
    at = {(r["stream"], r["t"]): r for r in T.apply_timing_correction(vis, "stream", flags, tables, F.lit(600.0), transits=transits).collect()}
    assert abs(complex(at[1, 15.0]["re"], at[1, 15.0]["im"]) - np.exp(-2j * np.pi * 0.6 * 3)) < 1e-9
    short = tables.where("table_id = 1")
    with pytest.raises(Exception, match="no timing correction spans stream 2"):
        T.apply_timing_correction(vis, "stream", flags, short, F.lit(600.0)).collect()
    passed = {(r["stream"], r["t"]): r["im"] for r in T.apply_timing_correction(vis, "stream", flags, short, F.lit(600.0), True).collect()}
    assert passed[2, 60.0] == 0.0 and passed[1, 10.0] != 0.0
    partial = spark.createDataFrame([(0.0, 13.0)], "start_t double, finish_t double")
    with pytest.raises(Exception, match="stream 1 partially overlaps"):
        T.apply_timing_correction(vis, "stream", partial, tables, F.lit(600.0)).collect()


def test_acquisition_references_survive_a_restart(spark, tmp_path):
    source, sink, kept = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = "acq string, t double, phase double"
    batches = [[("a", 2.0, 5.0), ("a", 1.0, 3.0), ("b", 1.0, 7.0)], [("a", 0.5, 9.0), ("c", 4.0, 1.0)], [("b", 2.0, 8.0), ("c", 5.0, 4.0), ("a", 3.0, 3.5)]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = G.acquisition_references(spark.readStream.schema(schema).parquet(source), "acq", "t", "phase", "against")
        stream.writeStream.option("checkpointLocation", kept).trigger(availableNow=True).start(sink, format="parquet").awaitTermination()
    got = {(r["acq"], r["t"]): r["against"] for r in spark.read.parquet(sink).collect()}
    assert got == {("a", 2.0): 2.0, ("a", 1.0): 0.0, ("b", 1.0): 0.0, ("a", 0.5): 6.0, ("c", 4.0): 0.0, ("b", 2.0): 1.0, ("c", 5.0): 3.0, ("a", 3.0): 0.5}


def test_read_spectra_pushes_its_bounds_down(spark, tmp_path):
    rows = [(float(t), f, b, 1.0) for t in range(20) for f in range(6) for b in range(4)]
    where = str(tmp_path / "s")
    spark.createDataFrame(rows, "t double, freq_id int, beam int, x double").repartitionByRange(4, "t").write.parquet(where)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    df = products.read_spectra(spark, [where], (3.0, 9.0), (799.0, 799.7), beams=[2, 3])
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters:")[1].split("]")[0]
    assert all(x in pushed for x in ("GreaterThanOrEqual(t,3.0)", "LessThan(t,9.0)", "GreaterThanOrEqual(freq_id,1)", "LessThan(freq_id,3)", "In(beam, [2,3")), pushed
    assert {(r["t"], r["freq_id"], r["beam"]) for r in df.collect()} == {(float(t), f, b) for t in range(3, 9) for f in (1, 2) for b in (2, 3)}
    assert products.read_spectra(spark, [where], mhz_list=[799.2, 799.3]).select("freq_id").distinct().collect()[0]["freq_id"] == 2
    assert products.read_spectra(spark, [where], beams=[]).count() == 0
    dated = products.read_spectra(spark, [where], day_zero=0.0, day_seconds=5.0)
    assert {r["date"] for r in dated.select("date").distinct().collect()} == {"19700101"} and dated.select("lsd").distinct().count() >= 3


def test_channel_flags(spark):
    inputs = spark.createDataFrame([(0, True), (1, True), (2, False), (3, True), (4, True), (5, None)], "input_id int, on boolean")
    tests = [(0, 1, True, None, False), (1, 1, True, False, True), (3, 1, True, True, True), (0, 2, False, True, True), (3, 2, False, False, False)]
    df = spark.createDataFrame(tests, "input_id int, freq_id int, gains boolean, noise boolean, fit boolean")
    mhz = {1: 700.0, 2: 600.0}
    call = lambda **k: {r["input_id"]: r["good"] for r in I.channel_flags(inputs, df, [690.0], mhz, [4], **k).collect()}
    assert call() == {0: False, 1: False, 2: False, 3: True, 4: False, 5: False}
    assert call(ignore=("fit", "noise")) == {0: True, 1: True, 2: False, 3: True, 4: False, 5: False}
    rows = spark.createDataFrame([(0, 3, 2.0), (3, 3, 2.0), (3, 77, 2.0)], "input_a int, input_b int, w double")
    good = I.channel_flags(inputs, df, [690.0], mhz, [4])
    assert sorted(tuple(r) for r in I.flag_products(rows, good).collect()) == [(0, 3, 0.0), (3, 3, 2.0), (3, 77, 0.0)]


def test_merged_flags(spark):
    flags = spark.createDataFrame([(1, 0.0, 5.0), (1, 3.0, 12.0), (1, 4.0, 4.5), (None, 1.0, 2.0), (1, 14.0, 13.0)], "f int, start_t double, finish_t double")
    got = sorted(((r["f"] or 0), r["bucket"], r["start_t"], r["finish_t"]) for r in D.merged_flags(flags, "f", 10.0).collect())
    assert got == [(0, 0, 1.0, 2.0), (1, 0, 0.0, 10.0), (1, 1, 10.0, 12.0)]


def test_small_groups_take_the_same_steps_in_place(spark):
    rng, rows = np.random.default_rng(4), []
    for f, n in ((0, 5), (1, 9), (2, 2)):
        g = rng.normal(size=n) + 1j * rng.normal(size=n) + 1
        a = np.outer(g, g.conj()) + 0.1 * rng.normal(size=(n, n)) + 3 * np.eye(n)
        rows += [(f, 10 * i, 10 * j, float(a[i, j].real), float(a[i, j].imag) * (i != j)) for i in range(n) for j in range(i, n)]
    df = spark.createDataFrame(rows, "freq_id int, input_a int, input_b int, re double, im double")
    # 20 products: one group goes by joins, two in place; 0: all by joins
    wide, mixed, whole = (E.leading_gain(df, ["freq_id"], replacements=1, steps=1, in_place=n).toPandas().sort_values(["freq_id", "input_id"]).reset_index(drop=True) for n in (0, 20, 1000))
    for got in (mixed, whole):
        assert (got[["freq_id", "input_id"]] == wide[["freq_id", "input_id"]]).all().all() and len(got) == 16
        assert np.abs(got[["re", "im", "value1"]] - wide[["re", "im", "value1"]]).max().max() < 1e-9
        assert np.allclose(got[["error", "value2", "dynamic_range"]], wide[["error", "value2", "dynamic_range"]], rtol=1e-6, atol=1e-9)
