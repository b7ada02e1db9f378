"""Queries of gain solves, spectral lines, low-pass filters, source fits, timing corrections and lookups."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from meridian.functions import scalar as X
from meridian.operators import clusters as C
from meridian.operators import eigen as E
from meridian.operators import inputs as I
from meridian.operators import lookup as L
from meridian.operators import lowpass as P
from meridian.operators import sources as S
from meridian.operators import timing as T
from meridian.operators import transits as U
from meridian.operators import windows as W
from meridian.operators.rounds import shared_folder
from meridian.plans.registry import R, col, query, rounded
from meridian.sources import products

# --- leading gains -------------------------------------------------------------------------------------------


def block_products(vis, baseline):
    """Products of 16 neighbouring inputs by channel: gains of the mean samples, with some noise and autos beside."""
    gain = vis.groupBy("freq_id", "input_id").agg((1 + F.avg("re") / 200).alias("re"), (F.avg("im") / 100).alias("im"))
    side = lambda x: gain.select("freq_id", col("input_id").alias(f"input_{x}"), col("re").alias(f"r{x}"), col("im").alias(f"i{x}"))
    near = baseline.where("floor(input_a / 16) = floor(input_b / 16)").select("input_a", "input_b", F.floor(col("input_a") / 16).alias("block"))
    met = near.join(side("a"), "input_a").join(side("b"), ["input_b", "freq_id"])
    re, im = X.cmul((col("ra"), col("ia")), X.conj((col("rb"), col("ib"))))
    noise = 0.05 * F.sin(col("input_a") * 7.13 + col("input_b") * 3.7 + col("freq_id"))
    auto = col("input_a") == col("input_b")
    return met.select("freq_id", "block", "input_a", "input_b", F.when(auto, re + 1).otherwise(re + noise).alias("re"), F.when(auto, 0.0).otherwise(im + 0.7 * noise).alias("im"))


@query(vis="vis", baseline="baseline")
def m8_leading_gain(vis, baseline):
    out = E.leading_gain(block_products(vis, baseline), ["freq_id", "block"])
    return rounded(out.select("freq_id", "block", "input_id", "re", "im", "error", "value1"), 4)


_EIGEN = """base AS (SELECT freq_id, CAST(floor(lsd/6) AS BIGINT) AS t, input_id, avg(re)/100 AS re1, avg(im)/100 AS im1, 0.1e0+avg(im)/90 AS re2, avg(re)/-110 AS im2, 1+avg(frac_lost) AS auto, avg(w) AS w FROM fx_vis GROUP BY 1, 2, 3),
    val AS (SELECT freq_id, t, 2+sum(re1*re1+im1*im1) AS value1, 1+0.5e0*sum(re2*re2+im2*im2) AS value2, CASE WHEN count(*)%7=0 THEN 0.0e0 ELSE 0.1e0 END AS rms FROM base GROUP BY 1, 2)"""
_EIGEN_SQL = f"""WITH {_EIGEN},
    off AS (SELECT freq_id, quantile_cont(value1, 0.5) FILTER (t%3 <> 1) AS off FROM val GROUP BY 1),
    alive AS (SELECT val.*, rms > 0 AND value2/coalesce(off, 1e300) > 0.4e0 AND freq_id <> 3 AS good FROM val LEFT JOIN off USING (freq_id)),
    sg AS (SELECT freq_id, t, CASE WHEN re1 < 0 THEN -1.0e0 ELSE 1.0e0 END AS s1, CASE WHEN re2 < 0 THEN -1.0e0 ELSE 1.0e0 END AS s2 FROM base WHERE input_id = 8),
    u AS (SELECT b.*, i.pol, i.x, i.y, a.value1, a.value2, a.rms, a.good, coalesce(s1, 1)*sqrt(value1)*re1 AS p1, coalesce(s1, 1)*sqrt(value1)*im1 AS q1, coalesce(s2, 1)*sqrt(value2)*re2 AS p2, coalesce(s2, 1)*sqrt(value2)*im2 AS q2
      FROM base b JOIN fx_input i USING (input_id) JOIN alive a ON a.freq_id=b.freq_id AND a.t=b.t LEFT JOIN sg ON sg.freq_id=b.freq_id AND sg.t=b.t),
    m AS (SELECT freq_id, t, pol, sum(p1*p1+q1*q1) AS a, sum(p2*p2+q2*q2) AS d, sum(p1*p2+q1*q2) AS br, sum(p1*q2-q1*p2) AS bi FROM u GROUP BY 1, 2, 3),
    e AS (SELECT *, (a+d)/2+sqrt((a-d)*(a-d)/4+br*br+bi*bi) AS mu FROM m),
    v AS (SELECT *, sqrt((mu-a)*(mu-a)+br*br+bi*bi) AS n FROM e),
    r AS (SELECT u.*, mu, mu*(p1*(br/n)/value1-q1*(bi/n)/value1+p2*((mu-a)/n)/value2) AS rr, mu*(p1*(bi/n)/value1+q1*(br/n)/value1+q2*((mu-a)/n)/value2) AS ri FROM u JOIN v ON u.freq_id=v.freq_id AND u.t=v.t AND u.pol=v.pol),
    f AS (SELECT freq_id, t, pol, rr AS fr, ri AS fi, x AS fx, y AS fy FROM r WHERE input_id = CASE pol WHEN 'X' THEN 8 ELSE 12 END),
    z AS (SELECT r.*, fr, fi, 2*pi()*(cos(0.7e0)*sin((t-4)*0.1e0)*(fx-x)*(800-400*r.freq_id/1024.0e0)/299.792458e0+(cos(0.86e0)*sin(0.7e0)-sin(0.86e0)*cos(0.7e0)*cos((t-4)*0.1e0))*(y-fy)*(800-400*r.freq_id/1024.0e0)/299.792458e0) AS ph
      FROM r JOIN f USING (freq_id, t, pol)),
    g AS (SELECT *, (rr*fr+ri*fi)/sqrt(fr*fr+fi*fi) AS gr, (ri*fr-rr*fi)/sqrt(fr*fr+fi*fi) AS gi, 1/sqrt(10.0e0+freq_id) AS k FROM z)
    SELECT freq_id, t, input_id, pol, {R('(gr*cos(ph)-gi*sin(ph))*k', 5)} AS re, {R('(gr*sin(ph)+gi*cos(ph))*k', 5)} AS im,
    {R('CASE WHEN good AND rr*rr+ri*ri > 0 AND w > 0 THEN mu/(rms*rms*auto*k*k) ELSE 0 END', 4)} AS w FROM g"""


@query(_EIGEN_SQL, vis="vis", inputs="input")
def m9_eigen_gains(vis, inputs):
    t = F.floor(col("lsd") / 6).cast("long").alias("t")
    base = vis.groupBy("freq_id", t, "input_id").agg(
        (F.avg("re") / 100).alias("re1"), (F.avg("im") / 100).alias("im1"), (0.1 + F.avg("im") / 90).alias("re2"), (F.avg("re") / -110).alias("im2"), (1 + F.avg("frac_lost")).alias("auto"), F.avg("w").alias("w")
    )
    square = lambda n: F.sum(X.abs2((col(f"re{n}"), col(f"im{n}"))))
    values = base.groupBy("freq_id", "t").agg((2 + square(1)).alias("value1"), (1 + 0.5 * square(2)).alias("value2"), F.when(F.count("*") % 7 == 0, 0.0).otherwise(0.1).alias("rms"))
    out = E.eigen_gains(
        base, values, inputs.select("input_id", "pol", "x", "y"), {"X": 8, "Y": 12}, 8, col("t") % 3 != 1, col("freq_id") == 3, X.channel_mhz(col("freq_id")), 10.0 + col("freq_id"),
        (col("t") - 4) * 0.1, 0.7, 0.86, 0.4,
    )
    return rounded(out, 5, w=4)


# --- spectral lines ------------------------------------------------------------------------------------------

_SCALE = {"freq": 1 / (2.35482 * 0.2), "el": 0.85 * 299.792458 / 600.0 / (2.35482 * 7.2)}
_PIXEL = """WITH RECURSIVE m AS (SELECT freq_id*100000+ra_id*100+el_id AS pixel, 600-2.0e0*freq_id AS mhz, 2.0e0*ra_id AS ra, -0.9e0+0.2e0*el_id AS el, sum(w*val)/sum(w) AS val, sum(w) AS w, bool_and(abs(val)*sqrt(w) > 16.0137e0) AS bad
    FROM fx_polmap GROUP BY freq_id, ra_id, el_id)"""


@query(
    f"""{_PIXEL}, o AS (SELECT *, mhz/{_SCALE['freq']!r} AS f, ra/2.1e0 AS r, el/{_SCALE['el']!r} AS e FROM m WHERE bad),
    n AS (SELECT a.pixel AS a, b.pixel AS b FROM o a JOIN o b ON (a.f-b.f)*(a.f-b.f)+(a.r-b.r)*(a.r-b.r)+(a.e-b.e)*(a.e-b.e) <= 2.9e0*2.9e0),
    reach(a, b) AS (SELECT a, b FROM n UNION SELECT reach.a, n.b FROM reach JOIN n ON reach.b = n.a), c AS (SELECT a AS pixel, min(b) AS line FROM reach GROUP BY a),
    p AS (SELECT o.*, line, abs(val)*sqrt(w) AS s2n, count(*) OVER (PARTITION BY line) AS n_pixels, row_number() OVER (PARTITION BY line ORDER BY abs(val)*sqrt(w) DESC, o.pixel) AS k FROM o JOIN c USING (pixel))
    SELECT line, {R('mhz')} AS mhz, {R('2.0e0')} AS mhz_error, {R('ra')} AS ra, {R('degrees(asin(el))+49.32e0', 4)} AS dec, {R('1420.40575e0/mhz-1')} AS z, {R('1420.40575e0*2/(mhz*mhz)')} AS z_error,
    {R('val', 4)} AS depth, {R('s2n', 4)} AS s2n, n_pixels FROM p WHERE k = 1""",
    polmap="polmap",
)
def m10_spectral_lines(polmap):
    pixels = polmap.withColumn("bad", F.abs("val") * F.sqrt("w") > 16.0137)
    mean = C.polarisation_mean(pixels, ["freq_id", "ra_id", "el_id"]).withColumns({
        "pixel": col("freq_id") * 100000 + col("ra_id") * 100 + col("el_id"), "mhz": 600 - 2.0 * col("freq_id"), "ra": 2.0 * col("ra_id"), "el": -0.9 + 0.2 * col("el_id"),
    })
    lines = C.spectral_lines(mean, "pixel", "mhz", "ra", "el", (F.lit(_SCALE["freq"]), F.lit(2.1), F.lit(_SCALE["el"])), 49.32, 2.0, 2.9)
    return rounded(lines, 6, dec=4, depth=4, s2n=4)


# --- low-pass filters ----------------------------------------------------------------------------------------

WIDE = {c: 800.0 - 0.390625 * c for c in range(64)}


@query(wide="wide")
def m11_gain_error(wide):
    out = P.gain_error(wide, ["update_id"], WIDE, half_width=0.2, nsigma=4.0, rounds=40)
    return rounded(out, 4)


@query(wide="wide")
def m12_delay_filter(wide):
    out = P.narrowband_features(wide, ["update_id", "input_id"], WIDE, tau_cut=0.3, window=21, nsigma=4.0)
    return rounded(out.select("update_id", "input_id", "freq_id", "w"), 4)


def _kernel_sql(window: int, rounds: int) -> str:
    from meridian.operators.spectra import kz_coefficients

    c = kz_coefficients(window, rounds)
    return f"(VALUES {', '.join(f'({k - len(c) // 2}, {x!r}::DOUBLE)' for k, x in enumerate(c))})"


@query(
    f"""WITH g AS (SELECT freq_id, e.range AS el_id, r.range AS ra_id FROM (SELECT DISTINCT freq_id FROM fx_map), range(10) e, range(180) r),
    s AS (SELECT g.*, CASE WHEN m.w > 6 THEN m.val ELSE 0.0e0 END AS v, CASE WHEN m.w > 6 THEN 1.0e0 ELSE 0.0e0 END AS f FROM g LEFT JOIN fx_map m USING (freq_id, el_id, ra_id)),
    x AS (SELECT g.freq_id, g.el_id, g.ra_id, sum(k.c*s.v) AS v, sum(k.c*s.f) AS f FROM g, {_kernel_sql(3, 12)} k(k, c), s
      WHERE s.freq_id=g.freq_id AND s.ra_id=g.ra_id AND s.el_id = 9-abs((g.el_id+k.k+180)%18-9) GROUP BY 1, 2, 3),
    y AS (SELECT g.freq_id, g.el_id, g.ra_id, sum(k.c*x.v) AS v, sum(k.c*x.f) AS f FROM g, {_kernel_sql(5, 8)} k(k, c), x
      WHERE x.freq_id=g.freq_id AND x.el_id=g.el_id AND x.ra_id = (g.ra_id+k.k+360)%180 GROUP BY 1, 2, 3)
    SELECT y.freq_id, y.el_id, y.ra_id, {R('CASE WHEN s.f > 0 AND abs(CASE WHEN y.f >= 0.4013e0 THEN y.v/y.f ELSE 0 END) >= 12.0137e0 THEN s.v WHEN y.f >= 0.4013e0 THEN y.v/y.f ELSE 0 END', 4)} AS val,
    CASE WHEN y.f >= 0.4013e0 OR (s.f > 0 AND 0 >= 12.0137e0) THEN 1.0e0 ELSE 0.0e0 END AS w FROM y JOIN s USING (freq_id, el_id, ra_id)""",
    map="map",
)
def w7_kz_two_axes(map):
    some = map.withColumn("w", F.when(col("w") > 6, col("w")).otherwise(0.0))
    out = W.kz_low_pass(some, ["freq_id"], ("el_id", "ra_id"), (10, 180), "val", (3, 5), (12, 8), ("reflect", "wrap"), 0.4013, F.abs("val") >= 12.0137)
    return rounded(out, 4)


# --- sources -------------------------------------------------------------------------------------------------


def _fringe(k: float):
    return X.cis(k * F.radians("ra") * (1 + col("input_id") % 16 / 16))


@query(vis="vis")
def m5_three_sources(vis):
    out = S.solve_templates(vis, ["freq_id"], [(F.lit(1.0), F.lit(0.0)), _fringe(1.0), _fringe(2.5)])
    return rounded(out.select("freq_id", *(F.get(f"a_{p}", s).alias(f"{p}{s}") for s in range(3) for p in ("re", "im"))), 5)


@query(vis="vis")
def m7_subtract_three_sources(vis):
    templates = [(F.lit(1.0), F.lit(0.0)), _fringe(1.0), _fringe(2.5)]
    out = S.subtract_templates(vis, ["freq_id"], S.solve_templates(vis, ["freq_id"], templates), templates)
    return rounded(out.select("sample_id", "re", "im"), 4)


def extended_bases():
    u = col("input_id") % 16 / 16
    flat, tilted = _fringe(1.0), _fringe(2.5)
    return [[flat, (flat[0] * u * u, flat[1] * u * u)], [tilted, (tilted[0] * u, tilted[1] * u)]]


@query(vis="vis")
def m6_extended_sources(vis):
    _, shapes, progress = S.solve_extended(vis, ["freq_id"], "lsd", extended_bases())
    last = progress.where("round = 4").select("freq_id", "chisq")
    out = shapes.join(last, "freq_id").select("freq_id", *(F.get(f"c_{p}", k).alias(f"{p}{k}") for k in (1, 3) for p in ("re", "im")), "chisq")
    return rounded(out, 3, chisq=1)


# --- transits ------------------------------------------------------------------------------------------------

_TRANSIT = """WITH s AS (SELECT freq_id, stack_id, lsd, (ra-180)/90 AS x, sqrt(re*re+im*im) AS v, atan2(im, re) AS a, w FROM fx_day WHERE w > 0 AND re*re+im*im > 0 AND abs((ra-180)/90) <= 1.5e0),
    m AS (SELECT freq_id, stack_id, lsd, arg_min(a, struct_pack(d := abs(x), x := x, a := a)) AS turn FROM s GROUP BY 1, 2, 3),
    p AS (SELECT s.*, turn, ln(v) AS l, a-turn-2*pi()*round((a-turn)/(2*pi())) AS f FROM s JOIN m USING (freq_id, stack_id, lsd))"""


def _line_sql(name: str, rows: str, weight: str) -> str:
    cells = ", ".join(f"sum({weight}*{e}) AS {n}" for n, e in {"s0": "1", "s1": "x", "s2": "x*x", "l0": "l", "l1": "x*l", "f0": "f", "f1": "x*f"}.items())
    return f"""{name}_m AS (SELECT freq_id, stack_id, lsd, turn, count(*) AS n, {cells} FROM {rows} GROUP BY 1, 2, 3, 4),
    {name} AS (SELECT freq_id, stack_id, lsd, turn, n, s0*s2-s1*s1 AS det, (s2*l0-s1*l1)/(s0*s2-s1*s1) AS a0, (s0*l1-s1*l0)/(s0*s2-s1*s1) AS a1, (s2*f0-s1*f1)/(s0*s2-s1*s1) AS b0, (s0*f1-s1*f0)/(s0*s2-s1*s1) AS b1, s2/(s0*s2-s1*s1) AS v0 FROM {name}_m
      WHERE n >= 5)"""


@query(
    f"""{_TRANSIT}, {_line_sql('one', 'p', 'w*v*v')}, q AS (SELECT p.*, w*exp(2*(a0+a1*x)) AS g FROM p JOIN one USING (freq_id, stack_id, lsd, turn)), {_line_sql('two', 'q', 'g')},
    c AS (SELECT freq_id, stack_id, lsd, t.turn, n, a0, b0, v0, sum(g*(l-a0-a1*x)*(l-a0-a1*x))/(n-2) AS ca, sum(g*(f-b0-b1*x)*(f-b0-b1*x))/(n-2) AS cf FROM q JOIN two t USING (freq_id, stack_id, lsd) GROUP BY freq_id, stack_id, lsd, t.turn, n, a0, b0, v0)
    SELECT freq_id, stack_id, lsd, {R('CASE WHEN ca <= 900.0137e0 AND cf <= 900.0137e0 THEN exp(-a0)*cos(b0+turn) ELSE 0 END', 5)} AS re, {R('CASE WHEN ca <= 900.0137e0 AND cf <= 900.0137e0 THEN -exp(-a0)*sin(b0+turn) ELSE 0 END', 5)} AS im,
    {R('CASE WHEN ca <= 900.0137e0 AND cf <= 900.0137e0 THEN exp(2*a0)/(2*v0)/1e6 ELSE 0 END', 4)} AS w FROM c""",
    day="day",
)
def m2_transit_gain(day):
    group = ["freq_id", "stack_id", "lsd"]
    fit = U.transit_fit(day.withColumn("x", (col("ra") - 180) / 90), group, col("x"), F.lit(1.5), 1, 1, 2).where("ndof_amp >= 3")
    gain = U.gain_from_fit(fit, None, 900.0137, 1, 1)
    return rounded(gain.select(*group, "re", "im", (col("w") / 1e6).alias("w")), 5, w=4)


@query(day="day")
def m1_transit_fit(day):
    fit = U.transit_fit(day.withColumn("x", (col("ra") - 180) / 180), ["freq_id", "stack_id"], col("x"), F.lit(1.0), 5, 5, 5)
    return rounded(fit.select("freq_id", "stack_id", "chisq_amp", "chisq_phase", "ndof_amp"), 1)


# --- timing and lookups --------------------------------------------------------------------------------------

_SPAN = "SELECT user_id%5 AS stream, CAST(floor(EPOCH(ts)/21600) AS BIGINT) AS span FROM events"


def timing_inputs(vis, delay, flags):
    """Streams of a quarter of a day and channel, product of an input with the next, flags that hold them whole."""
    stream = F.floor(col("t") / 21600).cast("long") * 8 + col("freq_id")
    rows = vis.select("sample_id", "freq_id", stream.alias("stream"), (col("input_id") % 8).alias("input_a"), ((col("input_id") + 3) % 8).alias("input_b"), "t", "re", "im", "w")
    spans = flags.where("flag_type = 'rain1mm'").select((F.floor(col("start_t") / 86400) * 86400.0).alias("start_t")).distinct().withColumn("finish_t", col("start_t") + 86401.0)
    return rows, spans


_TIMING = f"""WITH v AS (SELECT sample_id, freq_id, CAST(floor(t/21600) AS BIGINT)*8+freq_id AS stream, input_id%8 AS input_a, (input_id+3)%8 AS input_b, t, re, im, w FROM fx_vis),
    fl AS (SELECT DISTINCT floor(start_t/86400)*86400 AS s, floor(start_t/86400)*86400+86401 AS f FROM fx_flag_vis WHERE flag_type='rain1mm'),
    sp AS (SELECT stream, min(t) AS t0, max(t) AS t1 FROM v GROUP BY 1), need AS (SELECT DISTINCT stream, t0, t1 FROM sp JOIN fl ON t0 >= s AND t0 <= f),
    tb AS (SELECT table_id, min(t) AS a, max(t) AS b FROM fx_delay GROUP BY 1), ch AS (SELECT stream, min(table_id) AS table_id FROM need JOIN tb ON t0 >= a AND t1 <= b GROUP BY 1),
    r AS (SELECT v.*, ch.table_id FROM v LEFT JOIN ch USING (stream)),
    sp2 AS (SELECT DISTINCT table_id, t, input_a AS input_id FROM r WHERE table_id IS NOT NULL UNION SELECT DISTINCT table_id, t, input_b FROM r WHERE table_id IS NOT NULL),
    lo AS (SELECT s.*, d.t AS lt, d.delay AS ld FROM sp2 s ASOF LEFT JOIN fx_delay d ON s.table_id=d.table_id AND s.input_id=d.input_id AND s.t >= d.t),
    hi AS (SELECT lo.*, d.t AS ht, d.delay AS hd FROM lo ASOF LEFT JOIN fx_delay d ON lo.table_id=d.table_id AND lo.input_id=d.input_id AND lo.t <= d.t),
    tau AS (SELECT table_id, t, input_id, CASE WHEN ht > lt THEN ld*(ht-t)/(ht-lt)+hd*(t-lt)/(ht-lt) ELSE hd END AS tau FROM hi WHERE lt IS NOT NULL AND ht IS NOT NULL),
    z AS (SELECT r.*, a.tau-b.tau AS d FROM r LEFT JOIN tau a ON a.table_id=r.table_id AND a.t=r.t AND a.input_id=r.input_a LEFT JOIN tau b ON b.table_id=r.table_id AND b.t=r.t AND b.input_id=r.input_b),
    p AS (SELECT *, 2e6*pi()*(800-400*freq_id/1024.0e0)*coalesce(d, 0) AS ph FROM z)
    SELECT sample_id, {R('re*cos(ph)-im*sin(ph)', 5)} AS re, {R('re*sin(ph)+im*cos(ph)', 5)} AS im, CASE WHEN table_id IS NOT NULL AND d IS NULL THEN 0.0e0 ELSE w END AS w FROM p"""


@query(_TIMING, vis="vis", delay="delay", flags="flag_vis")
def m4_timing_correction(vis, delay, flags):
    rows, spans = timing_inputs(vis, delay, flags)
    out = T.apply_timing_correction(rows, "stream", spans, delay, X.channel_mhz(col("freq_id")), True, take_partial=True)
    return rounded(out.select("sample_id", "re", "im", "w"), 5)


@query(
    """WITH RECURSIVE w AS (SELECT DISTINCT dataset_id, dataset_id AS here, 0 AS depth FROM fx_dataset WHERE dataset_id%4=1),
    up(dataset_id, here, depth) AS (SELECT * FROM w UNION ALL SELECT up.dataset_id, d.parent_id, up.depth+1 FROM up JOIN fx_dataset d ON d.dataset_id = up.here WHERE d.kind <> 'map' AND d.parent_id IS NOT NULL),
    hit AS (SELECT up.dataset_id, up.depth, d.state FROM up JOIN fx_dataset d ON d.dataset_id = up.here WHERE d.kind = 'map')
    SELECT w.dataset_id, CAST(hit.depth AS INT) AS depth, coalesce(CAST(hit.state AS VARCHAR), 'default') AS map FROM w LEFT JOIN hit USING (dataset_id)""",
    dataset="dataset",
)
def q14_frequency_map(dataset):
    starts = dataset.where("dataset_id % 4 = 1").select("dataset_id")
    found = L.closest_ancestors(starts, dataset, col("kind") == "map", "state")
    depths = found.select("dataset_id", "depth")
    maps = L.frequency_map_of(starts.select(col("dataset_id").alias("group"), "dataset_id"), dataset, col("kind") == "map", "state", [], "default", found=found)
    return depths.join(maps.withColumnRenamed("group", "dataset_id"), "dataset_id").select("dataset_id", "depth", "map")


@query(
    f"""SELECT freq_id, beam, t_id, {R('sum(w*x)/sum(w)')} AS x FROM fx_spec WHERE t_id >= 3 AND t_id < 20 AND freq_id >= 1 AND freq_id < 3 AND beam IN (1, 2, 5) GROUP BY 1, 2, 3""",
    spec="spec",
)
def s7_read_spectra(spec):
    """Written as many files, read back by bounds."""
    import uuid

    where = f"{shared_folder(spec.sparkSession)}/meridian-{uuid.uuid4().hex}"
    spec.withColumn("t", col("t_id").cast("double")).repartitionByRange(8, "t_id").write.parquet(where)
    rows = products.read_spectra(spec.sparkSession, [where], time_range=(3.0, 20.0), mhz_range=(798.9, 799.6), beams=[1, 2, 5])
    return rounded(rows.groupBy("freq_id", "beam", "t_id").agg((F.sum(col("w") * col("x")) / F.sum("w")).alias("x")))


# --- channels ------------------------------------------------------------------------------------------------

_CHANNEL = "SELECT input_id, freq_id, avg(CASE WHEN re > 5 THEN 1.0e0 ELSE 0.0e0 END) >= 0.4e0 AS gains, avg(abs(im)) < 40.0137e0 AS noise, CASE WHEN count(*) > 3 THEN avg(w) > 0.8e0 END AS fit FROM fx_vis GROUP BY 1, 2"


@query(
    f"""WITH t AS ({_CHANNEL}), m AS (SELECT i.input_id, i.good AND i.input_id NOT IN (5, 9) AND coalesce(b.ok, true) AS good FROM fx_input i
      LEFT JOIN (SELECT input_id, bool_and(gains AND coalesce(noise, true)) AS ok FROM t WHERE freq_id IN (1, 3) GROUP BY 1) b USING (input_id))
    SELECT v.sample_id, CASE WHEN a.good AND b.good THEN v.w ELSE 0.0e0 END AS w FROM fx_vis v JOIN m a ON a.input_id = v.input_id LEFT JOIN m b ON b.input_id = v.input_id//2""",
    vis="vis", inputs="input",
)
def a10_channel_flagger(vis, inputs):
    tests = vis.groupBy("input_id", "freq_id").agg(
        (F.avg((col("re") > 5).cast("double")) >= 0.4).alias("gains"), (F.avg(F.abs("im")) < 40.0137).alias("noise"), F.when(F.count("*") > 3, F.avg("w") > 0.8).alias("fit")
    )
    good = I.channel_flags(inputs.select("input_id", col("good").alias("on")), tests, [X_MHZ[1], X_MHZ[3]], X_MHZ, [5, 9], ignore=("fit",))
    rows = vis.withColumns({"input_a": col("input_id"), "input_b": F.floor(col("input_id") / 2).cast("int")})
    return I.flag_products(rows, good).select("sample_id", "w")


X_MHZ = {k: 800.0 - 400.0 * k / 1024.0 for k in range(5)}
