"""Queries of maps, flattened spectra, holographic beams and masks over the fixture relations."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.functions import scalar as X
from meridian.operators import amplitudes as P
from meridian.operators import maps as M
from meridian.plans.gain_queries import _AT, _in_force
from meridian.plans.registry import R, col, query, rounded

_SHAPE = "(1+0.5e0*cos(2*pi()*subfreq/64.0e0))"
_LEFT = "(1/(1+1e8*ww))"
_BAND = f"(SELECT freq_id, beam, t_id, subfreq, w, x*{_SHAPE} AS x FROM fx_spec)"


@query(
    f"""WITH s AS (SELECT freq_id, beam, t_id, sum({_SHAPE}*{_SHAPE}*w) AS ww, sum({_SHAPE}*w) AS zw, sum(w) AS zz, sum({_SHAPE}*w*x) AS wd, sum(w*x) AS zd FROM {_BAND} GROUP BY freq_id, beam, t_id),
    c AS (SELECT freq_id, beam, sum(ww*{_LEFT})+1e-8 AS c00, sum(zw*{_LEFT}) AS c01, sum(zz-1e8*{_LEFT}*zw*zw)+1e-8 AS c11, sum(wd*{_LEFT}) AS d0, sum(zd-1e8*{_LEFT}*zw*wd) AS d1 FROM s GROUP BY freq_id, beam),
    f AS (SELECT freq_id, beam, (d0*c11-d1*c01)/(c00*c11-c01*c01) AS a, (c00*d1-c01*d0)/(c00*c11-c01*c01) AS b FROM c)
    SELECT v.freq_id, v.beam, v.t_id, v.subfreq, {R(f'(x-b)/(a*{_SHAPE})', 5)} AS x, {R(f'w*(a*{_SHAPE})*(a*{_SHAPE})', 5)} AS w FROM {_BAND} v JOIN f ON v.freq_id=f.freq_id AND v.beam=f.beam""",
    spec="spec",
)
def a22_flatten_spectra(spec):
    shape = 1 + 0.5 * F.cos(2 * F.pi() * col("subfreq") / 64.0)
    band = spec.withColumn("x", col("x") * shape)
    return rounded(M.flatten_spectra(band, ["freq_id", "beam"], "t_id", shape).select("freq_id", "beam", "t_id", "subfreq", "x", "w"), 5)


_Y = "(0.3e0*stack_id*(800-400*freq_id/1024.0e0)/299.792458e0)"
_EL = "(-0.6e0+0.3e0*el_id)"
_SKY = f"""(SELECT lsd-lsd%4 AS block, freq_id, ra_id, CASE lsd%4 WHEN 0 THEN 'XX' WHEN 1 THEN 'XY' WHEN 2 THEN 'YX' ELSE 'YY' END AS pol, beam, el_id, (1+stack_id)/10.0e0 AS weight, re, im,
 -2*pi()*{_Y}*{_EL}+2*pi()/3*(stack_id%2)*beam AS ph FROM fx_day, (SELECT range AS beam FROM range(3)) b, (SELECT range AS el_id FROM range(5)) e)"""


@query(
    f"""WITH s AS (SELECT block, freq_id, ra_id, pol, beam, el_id, sum(weight*(re*cos(ph)-im*sin(ph))) AS vr, sum(weight*(re*sin(ph)+im*cos(ph))) AS vi, sum(weight*cos(ph)) AS dr, sum(weight*sin(ph)) AS di
      FROM {_SKY} GROUP BY block, freq_id, ra_id, pol, beam, el_id),
    p AS (SELECT block, freq_id, ra_id, pol, beam, el_id, 2*vr AS v, 2*dr AS d FROM s WHERE pol IN ('XX','YY')
      UNION ALL SELECT block, freq_id, ra_id, 'reXY', beam, el_id, vr, dr FROM s WHERE pol IN ('XY','YX')
      UNION ALL SELECT block, freq_id, ra_id, 'imXY', beam, el_id, CASE pol WHEN 'XY' THEN vi ELSE -vi END, CASE pol WHEN 'XY' THEN di ELSE -di END FROM s WHERE pol IN ('XY','YX'))
    SELECT block, freq_id, ra_id, pol, beam, el_id, {R('sum(v)', 5)} AS value, {R('sum(d)', 5)} AS dirty FROM p GROUP BY block, freq_id, ra_id, pol, beam, el_id""",
    day="day",
)
def a24_ring_map(day):
    pol = F.element_at(F.array(*map(F.lit, ("XX", "XY", "YX", "YY"))), (col("lsd") % 4 + 1).cast("int"))
    block = (col("lsd") - col("lsd") % 4).alias("block")
    vis = day.select(block, "freq_id", "ra_id", pol.alias("pol"), (col("stack_id") % 2).alias("xind"), "stack_id", "re", "im", ((1 + col("stack_id")) / 10.0).alias("weight"))
    y = 0.3 * col("stack_id") / X.wavelength(X.channel_mhz(col("freq_id")))
    return rounded(M.ring_map(vis, ["block", "freq_id", "ra_id"], y, [-0.6 + 0.3 * k for k in range(5)], 3), 5)


@query(
    f"""SELECT CASE WHEN p.input_a IN (3,4) THEN p.input_a ELSE p.input_b END AS reference, CASE WHEN p.input_a IN (3,4) THEN p.input_b ELSE p.input_a END AS input_id,
    CASE WHEN i.pol = CASE WHEN p.input_a = 3 OR (p.input_b = 3 AND p.input_a <> 4) THEN 'X' ELSE 'Y' END THEN 'co' ELSE 'cross' END AS pol, p.freq_id,
    {R('p.cr')} AS re, {R('CASE WHEN p.input_a IN (3,4) THEN -p.ci ELSE p.ci END')} AS im, {R('p.pw')} AS w
    FROM (SELECT b.input_a, b.input_b, g.freq_id, g.re*h.re+g.im*h.im AS cr, g.im*h.re-g.re*h.im AS ci, g.w*h.w AS pw FROM fx_baseline b
      JOIN {_AT} g ON b.input_a = g.input_id JOIN {_AT} h ON b.input_b = h.input_id AND g.freq_id = h.freq_id) p
    JOIN fx_input i ON i.input_id = CASE WHEN p.input_a IN (3,4) THEN p.input_b ELSE p.input_a END WHERE (p.input_a IN (3,4)) <> (p.input_b IN (3,4))""",
    baseline="baseline", inputs="input", gain="gain",
)
def d44_holography_beam(baseline, inputs, gain):
    side = lambda x: _in_force(gain).select(col("input_id").alias(f"input_{x}"), "freq_id", *(col(c).alias(f"{c}{x}") for c in ("re", "im", "w")))
    pairs = baseline.join(side("a"), "input_a").join(side("b"), ["input_b", "freq_id"])
    re, im = X.cmul((col("rea"), col("ima")), X.conj((col("reb"), col("imb"))))
    products = pairs.select("input_a", "input_b", "freq_id", re.alias("re"), im.alias("im"), (col("wa") * col("wb")).alias("w"))
    return rounded(M.holography_beam(products, inputs, {3: "X", 4: "Y"}, ["freq_id"]))


_TRANSITION = 864000.0


@query(
    f"""WITH e AS (SELECT freq_id, update_t, coalesce(sum(w*(re-1.5e0))/nullif(sum(w),0),0) AS err FROM fx_gain GROUP BY freq_id, update_t
      UNION ALL SELECT DISTINCT freq_id, 0.0e0, 0.0e0 FROM fx_gain),
    c AS (SELECT DISTINCT freq_id, t FROM fx_cell),
    n AS (SELECT c.freq_id, c.t, e.err AS now FROM c ASOF JOIN e ON c.freq_id=e.freq_id AND c.t >= e.update_t),
    b AS (SELECT n.freq_id, n.t, n.now, e.err AS past FROM n ASOF LEFT JOIN e ON n.freq_id=e.freq_id AND n.t-{_TRANSITION} >= e.update_t)
    SELECT freq_id, CAST(t/86400 AS BIGINT)%7 AS slot, {R('avg(CASE WHEN abs(now) > abs(coalesce(past,0)) THEN now ELSE coalesce(past,now) END)')} AS error,
    abs(avg(CASE WHEN abs(now) > abs(coalesce(past,0)) THEN now ELSE coalesce(past,now) END)) > 1.4513e0 AS bad FROM b GROUP BY freq_id, CAST(t/86400 AS BIGINT)%7""",
    cell="cell", gain="gain",
)
def a14_gain_error_mask(cell, gain):
    points = cell.select("freq_id", "t").distinct().withColumn("slot", (col("t") / 86400).cast("long") % 7)
    errors = gain.select("freq_id", "update_t", (col("re") - 1.5).alias("error"), "w")
    # The instrument starts without an error, so no cell comes before the first update.
    start = gain.select("freq_id", F.lit(0.0).alias("update_t"), F.lit(0.0).alias("error"), F.lit(1.0).alias("w")).distinct()
    return rounded(M.gain_error_mask(points, errors.union(start), ["freq_id"], "t", "update_t", _TRANSITION, ["freq_id", "slot"], 1.4513))


@query(
    f"""WITH s AS (SELECT source_id, ra, dec/90-0.5e0 AS el FROM fx_catalog),
    d AS (SELECT s.source_id, (k+180)%180 AS ra_id, j AS el_id, min(sqrt(power((2.0e0*k-ra)/3,2)+power((-0.9e0+0.2e0*j-el)/0.1e0,2))) AS d FROM s, range(-8, 192) r(k), range(0, 10) e(j) GROUP BY 1, 2, 3),
    q AS (SELECT ra_id, el_id, product(1-CASE WHEN d <= 1 THEN 1.0e0 ELSE 0.5e0*(1+cos(pi()*(d-1))) END) AS kept FROM d WHERE d < 2 GROUP BY ra_id, el_id)
    SELECT m.freq_id, m.ra_id, m.el_id, {R('m.w*coalesce(q.kept,1)')} AS w FROM fx_map m LEFT JOIN q ON m.ra_id=q.ra_id AND m.el_id=q.el_id""",
    map="map", catalog="catalog",
)
def d25_taper_from_catalog(map, catalog):
    sources = catalog.select("source_id", "ra", (col("dec") / 90 - 0.5).alias("el"))
    return rounded(M.taper_sources(map, sources, 2.0, 0.2, -0.9, 3.0, 0.1, 180).select("freq_id", "ra_id", "el_id", "w"))


_OF = "(1+(2+freq_id)*1e-3*(n.temp-{}.temp))"
_PAST = "power(cos(pi()/2*least(1.0e0,(t-change_t)/36000.0e0)),2)"


@query(
    f"""WITH h AS (SELECT CAST(floor(t/3600) AS BIGINT) AS hour, avg(temperature) AS temp FROM fx_weather GROUP BY 1),
    v AS (SELECT *, 1704067200+lsd*86164.0989e0 AS change_t FROM fx_vis),
    g AS (SELECT v.*, CASE WHEN r.temp IS NULL THEN 1.0e0 ELSE coalesce(CASE WHEN p.temp IS NULL THEN {_OF.format('r')} ELSE {_OF.format('p')}*{_PAST}+{_OF.format('r')}*(1-{_PAST}) END, 0) END AS gain
      FROM v LEFT JOIN h n ON n.hour = CAST(floor(t/3600) AS BIGINT) LEFT JOIN h r ON r.hour = CAST(floor(change_t/3600) AS BIGINT) LEFT JOIN h p ON p.hour = CAST(floor((change_t-86164.0989e0)/3600) AS BIGINT))
    SELECT sample_id, {R('gain')} AS gain, {R('CASE WHEN gain=0 THEN 0 ELSE re/gain END', 5)} AS re, {R('w*gain*gain', 5)} AS w FROM g""",
    vis="vis", weather="weather",
)
def w16_thermal_calibration(vis, weather):
    # The calibrator passes once a sidereal day: each day's start changes the reference.
    hour = lambda t: F.floor(t / 3600).cast("long")
    hourly = weather.groupBy(hour(col("t")).alias("_h")).agg(F.avg("temperature").alias("_temp"))
    known = vis.withColumn("change_t", 1704067200 + col("lsd") * X.SIDEREAL_DAY)
    for name, at in (("temperature", col("t")), ("reference", col("change_t")), ("previous", col("change_t") - X.SIDEREAL_DAY)):
        known = known.withColumn("_h", hour(at)).join(hourly.withColumnRenamed("_temp", name), "_h", "left").drop("_h")
    out = M.thermal_gain(known, "t", 36000.0, (2 + col("freq_id")) * 1e-3)
    return rounded(out.select("sample_id", "gain", "re", "w"), 5, gain=6)


_BETWEEN = "CASE WHEN hx=lx THEN 0 ELSE (hx-ex)/(hx-lx) END AS p"
_VALUE = "CASE WHEN lw>0 AND hw>0 THEN p*ly+(1-p)*hy ELSE 0 END"
_WEIGHT = "CASE WHEN lw>0 AND hw>0 THEN 1/(p*p/lw+(1-p)*(1-p)/hw) ELSE 0 END"
_HA = "(0.37e0*(el_id-4.5e0))"


@query(
    f"""WITH r AS (SELECT freq_id, el_id, (ra-{_HA}) - 360*floor((ra-{_HA})/360) AS x, val AS y, w FROM fx_map),
    s AS (SELECT freq_id, el_id, x+turn AS x, y, w FROM r, (SELECT unnest([-360.0e0, 0.0e0, 360.0e0]) AS turn) t),
    b AS (SELECT m.freq_id, m.el_id, m.ra_id, m.ra AS ex, s.x AS lx, s.y AS ly, s.w AS lw FROM fx_map m ASOF LEFT JOIN s ON m.freq_id=s.freq_id AND m.el_id=s.el_id AND m.ra >= s.x),
    f AS (SELECT b.*, s.x AS hx, s.y AS hy, s.w AS hw FROM b ASOF LEFT JOIN s ON b.freq_id=s.freq_id AND b.el_id=s.el_id AND b.ex <= s.x), a AS (SELECT *, {_BETWEEN} FROM f)
    SELECT freq_id, el_id, ra_id, {R(_VALUE, 5)} AS val, {R(_WEIGHT, 5)} AS w FROM a""",
    map="map",
)
def w10_align_beams(map):
    rows = map.select("freq_id", "el_id", "ra_id", "ra", "val", "w")
    return rounded(M.align_beams(rows, ["freq_id", "el_id"], "ra", "val", 0.37 * (col("el_id") - 4.5)).drop("ra"), 5)


@query(
    f"""WITH s AS (SELECT *, 600-0.4e0*freq_id+subfreq*0.006e0 AS f FROM fx_spec), g AS (SELECT *, f*(1-(10.0e0+t_id%7)/299792.458e0) AS ex FROM s),
    b AS (SELECT g.freq_id, g.beam, g.t_id, g.subfreq, g.ex, s.f AS lx, s.x AS ly, s.w AS lw FROM g ASOF LEFT JOIN s ON g.freq_id=s.freq_id AND g.beam=s.beam AND g.t_id=s.t_id AND g.ex >= s.f),
    f AS (SELECT b.*, s.f AS hx, s.x AS hy, s.w AS hw FROM b ASOF LEFT JOIN s ON b.freq_id=s.freq_id AND b.beam=s.beam AND b.t_id=s.t_id AND b.ex <= s.f), a AS (SELECT *, {_BETWEEN} FROM f)
    SELECT freq_id, beam, t_id, subfreq, {R(_VALUE, 5)} AS x, {R(_WEIGHT, 5)} AS w FROM a""",
    spec="spec",
)
def w11_doppler_shift(spec):
    rows = spec.withColumn("mhz", 600 - 0.4 * col("freq_id") + col("subfreq") * 0.006)
    return rounded(M.doppler_shift(rows, ["freq_id", "beam", "t_id"], "mhz", "x", 10.0 + col("t_id") % 7).drop("mhz"), 5)


@query(
    f"""WITH m AS (SELECT el_id, ra_id, avg(val) > 0 AS m FROM fx_map GROUP BY el_id, ra_id),
    s AS (SELECT *, CAST(m AS INT) - lag(CAST(m AS INT)) OVER (PARTITION BY el_id ORDER BY ra_id) AS d FROM m),
    r AS (SELECT el_id, (CASE WHEN d > 0 THEN ra_id-1+j ELSE ra_id-j END + 180)%180 AS ra_id, product(CASE WHEN j >= 3 THEN 1.0e0 ELSE 0.5e0*(1-cos(pi()*j/3.0e0)) END) AS f FROM s, range(4) t(j) WHERE d <> 0 GROUP BY 1, 2)
    SELECT m.el_id, m.ra_id, {R('CAST(m AS INT)*coalesce(f, 1)')} AS taper FROM m LEFT JOIN r ON m.el_id=r.el_id AND m.ra_id=r.ra_id""",
    map="map",
)
def d11_taper_mask(map):
    mask = map.groupBy("el_id", "ra_id").agg((F.avg("val") > 0).alias("m"))
    return rounded(M.taper_mask(mask, ["el_id"], "ra_id", 180, "m", 4).drop("m"))


@query(
    """WITH p AS (SELECT min(b.prod_id) AS prod_id, b.pol, CAST(round(b.dy/0.3e0) AS BIGINT) AS yind, ia.cyl AS cyl_a, ib.cyl AS cyl_b FROM fx_baseline b JOIN fx_input ia ON b.input_a=ia.input_id JOIN fx_input ib ON b.input_b=ib.input_id
      WHERE b.xind=1 AND ia.cyl < ib.cyl GROUP BY ALL),
    q AS (SELECT * FROM p QUALIFY count(*) OVER (PARTITION BY pol, yind) = 3),
    v AS (SELECT b.prod_id, c.freq_id, CAST(floor(c.t/2592000) AS BIGINT) AS month, sqrt(c.re*c.re+c.im*c.im) AS a, c.w-10 > 0 AS ok FROM fx_cell c JOIN fx_baseline b ON c.input_id=b.input_a WHERE b.xind=1),
    g AS (SELECT freq_id, month, pol, yind, k, avg(CASE WHEN ok AND k IN (cyl_a, cyl_b) THEN a END) AS yes, avg(CASE WHEN ok AND k NOT IN (cyl_a, cyl_b) THEN a END) AS no FROM v JOIN q USING (prod_id), range(4) t(k) GROUP BY ALL),
    h AS (SELECT freq_id, month, k, median(no/yes) AS m FROM g WHERE yes IS NOT NULL AND no IS NOT NULL GROUP BY ALL),
    f AS (SELECT freq_id, month, bool_or(m > 1.8013e0) AS bad FROM h GROUP BY ALL),
    a AS (SELECT d.freq_id, d.month, coalesce(f.bad, false) AS bad FROM (SELECT DISTINCT freq_id, month FROM v) d LEFT JOIN f ON d.freq_id=f.freq_id AND d.month=f.month)
    SELECT freq_id, month, bad OR avg(CAST(bad AS INT)) OVER (PARTITION BY month, freq_id%2) > 0.7e0 AS bad FROM a""",
    cell="cell", baseline="baseline", inputs="input",
)
def d26_decorrelated_cylinders(cell, baseline, inputs):
    side = lambda x: inputs.select(col("input_id").alias(f"input_{x}"), col("cyl").alias(f"cyl_{x}"))
    near = baseline.where("xind = 1")
    pairs = near.join(side("a"), "input_a").join(side("b"), "input_b").where("cyl_a < cyl_b").withColumn("yind", F.round(col("dy") / 0.3).cast("long"))
    products = pairs.groupBy("pol", "yind", "cyl_a", "cyl_b").agg(F.min("prod_id").alias("prod_id"))
    month = F.floor(col("t") / 2592000).cast("long").alias("month")
    vis = cell.select(col("input_id").alias("input_a"), "freq_id", month, "re", "im", (col("w") - 10).alias("w"))
    # Products of one input have its samples: summed by input, before each meets its products.
    sizes = M.valid_sizes(vis, ["input_a", "freq_id", "month"]).join(near.select("prod_id", "input_a"), "input_a")
    bad = M.decorrelated_cylinders(sizes, products, ["freq_id", "month"], 4, 1.8013)
    return M.spread_to_slots(bad.withColumn("slot", col("freq_id") % 2), ["month", "slot"], 0.7).drop("slot")


@query("SELECT freq_id, t_id, count(*) AS n FROM fx_spec WHERE freq_id >= 1 AND freq_id < 3 GROUP BY freq_id, t_id", spec="spec")
def s6_channel_range(spec):
    return M.channel_range(spec, "freq_id", 798.9, 799.5).groupBy("freq_id", "t_id").agg(F.count("*").alias("n"))


@query(
    f"""WITH s AS (SELECT lsd, freq_id, stack_id, ra-100+180 - 360*floor((ra-100+180)/360) - 180 AS x, re AS y, im AS z, w FROM fx_day),
    g AS (SELECT lsd, freq_id, stack_id, sample, 180*((sample+0.5e0)/16-0.5e0) AS ex FROM (SELECT DISTINCT lsd, freq_id, stack_id FROM fx_day), range(16) t(sample)),
    b AS (SELECT g.*, s.x AS lx, s.y AS ly, s.z AS lz, s.w AS lw FROM g ASOF LEFT JOIN s ON g.lsd=s.lsd AND g.freq_id=s.freq_id AND g.stack_id=s.stack_id AND g.ex >= s.x),
    f AS (SELECT b.*, s.x AS hx, s.y AS hy, s.z AS hz, s.w AS hw FROM b ASOF LEFT JOIN s ON b.lsd=s.lsd AND b.freq_id=s.freq_id AND b.stack_id=s.stack_id AND b.ex <= s.x), a AS (SELECT *, {_BETWEEN} FROM f)
    SELECT lsd, freq_id, stack_id, CAST(sample AS INT) AS sample, {R(_VALUE, 5)} AS re, {R(_VALUE.replace('ly', 'lz').replace('hy', 'hz'), 5)} AS im, {R(_WEIGHT, 5)} AS w FROM a""",
    day="day",
)
def w14_regrid_transit(day):
    return rounded(M.regrid_transit(day, ["lsd", "freq_id", "stack_id"], "ra", 100.0, 16).drop("ha"), 5)


def _fit(name: str, before: str) -> str:
    """CTEs of one weighted line fit over the samples that `before` keeps."""
    over = "OVER (PARTITION BY input_id, month)"
    mean = lambda e: f"coalesce(sum(CASE WHEN kept THEN w*({e}) ELSE 0 END) {over}/nullif(sum(CASE WHEN kept THEN w ELSE 0 END) {over}, 0), 0)"
    return f"""{name}m AS (SELECT * EXCLUDE (mx, my), {mean('x')} AS mx, {mean('y')} AS my FROM {before}),
    {name}c AS (SELECT *, {mean('(x-mx)*(y-my)')} AS cov, {mean('(x-mx)*(x-mx)')} AS vr FROM {name}m),
    {name}l AS (SELECT * EXCLUDE (cov, vr, delay), CASE WHEN vr > 1e-12*mx*mx THEN cov/vr ELSE 0 END AS delay FROM {name}c)"""


def _cut(name: str, before: str, most: float) -> str:
    over = "OVER (PARTITION BY input_id, month)"
    return f"""{name}r AS (SELECT *, y-(my-delay*mx)-delay*x AS r FROM {before}),
    {name} AS (SELECT * EXCLUDE (r, kept), kept AND abs(r) <= {most}*sqrt(coalesce(sum(CASE WHEN kept THEN w*r*r ELSE 0 END) {over}/nullif(sum(CASE WHEN kept THEN w ELSE 0 END) {over}, 0), 0)) AS kept FROM {name}r)"""


_FITS = f"""WITH z AS (SELECT update_t, input_id, freq_id, CAST(floor(update_t/2592000) AS BIGINT) AS month, w, w > 0 AS kept, 0.8e0-0.4e0*freq_id/1024.0e0 AS x, atan2(im, re) AS y, 0.0e0 AS mx, 0.0e0 AS my, 0.0e0 AS delay FROM fx_gain),
    {_fit('a', 'z')}, {_cut('ak', 'al', 2.47)}, {_fit('b', 'ak')}, {_cut('bk', 'bl', 1.97)}, {_fit('c', 'bk')}"""


def _delays(gain):
    rows = gain.select("update_t", "input_id", "freq_id", F.floor(col("update_t") / 2592000).cast("long").alias("month"), "w", (0.8 - 0.4 * col("freq_id") / 1024.0).alias("x"), F.atan2("im", "re").alias("y"))
    return M.fit_delays(rows, ["input_id", "month"], "x", "y", [2.47, 1.97])


@query(f"{_FITS} SELECT update_t, input_id, freq_id, {R('my-delay*mx+delay*x')} AS fitted, kept FROM cl", gain="gain")
def m3_delay_fit(gain):
    return rounded(_delays(gain).select("update_t", "input_id", "freq_id", (col("offset") + col("delay") * col("x")).alias("fitted"), "kept"))


@query(
    f"""{_FITS}, s AS (SELECT input_id, month, avg(CAST(kept AS INT)) AS s FROM cl GROUP BY input_id, month)
    SELECT input_id, avg(CASE WHEN s >= 0.85e0 THEN 1 ELSE 0 END) > 0.3503e0 AS good FROM s GROUP BY input_id""",
    gain="gain",
)
def m3_good_inputs(gain):
    return M.good_fits(_delays(gain), ["input_id", "month"], ["input_id"], 0.85, 0.3503)


_AMP = """SELECT g.*, CASE WHEN input_id%8<4 THEN 'X' ELSE 'Y' END AS pol, CAST(floor(update_t/2592000) AS BIGINT) AS month, sqrt(re*re+im*im) AS a FROM fx_gain g"""


def _amplitudes(gain):
    return gain.withColumns({"pol": F.when(col("input_id") % 8 < 4, "X").otherwise("Y"), "month": F.floor(col("update_t") / 2592000).cast("long")})


@query(
    f"""WITH r0 AS (SELECT *, w > 0 AS k FROM ({_AMP})), m AS (SELECT month, median(a) FILTER (k) AS m FROM r0 GROUP BY month),
    r1 AS (SELECT r0.* EXCLUDE (k), k AND a >= 0.3e0*m AND a <= 1.9e0*m AS k FROM r0 JOIN m USING (month)),
    n AS (SELECT month, freq_id, pol, median(a) FILTER (k) AS m FROM r1 GROUP BY ALL), r2 AS (SELECT r1.*, m FROM r1 JOIN n USING (month, freq_id, pol)),
    d AS (SELECT month, freq_id, pol, median(m-a) FILTER (k AND a < m) AS lo, median(a-m) FILTER (k AND a > m) AS hi FROM r2 GROUP BY ALL),
    r3 AS (SELECT r2.* EXCLUDE (k, m), k AND a-m >= -2.5131e0*1.4826e0*coalesce(lo,0) AND a-m <= 2.5131e0*1.4826e0*coalesce(hi,0) AS k FROM r2 JOIN d USING (month, freq_id, pol)),
    c AS (SELECT month, freq_id, pol, median(a) FILTER (k) AS m FROM r3 GROUP BY ALL HAVING m IS NOT NULL),
    c1 AS (SELECT *, abs(m - quantile_cont(m, 0.5) OVER u) AS r FROM c WINDOW u AS (PARTITION BY month, pol ORDER BY freq_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
    c2 AS (SELECT month, freq_id, pol, r > 4.0131e0*1.4826e0*quantile_cont(r, 0.5) OVER u AS bad FROM c1 WINDOW u AS (PARTITION BY month, pol ORDER BY freq_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
    r4 AS (SELECT r3.* EXCLUDE (k), k AND NOT coalesce(bad, true) AS k FROM r3 LEFT JOIN c2 USING (month, freq_id, pol)),
    f AS (SELECT month, freq_id, avg(CAST(k AS INT)) > 0.5e0 AS fine FROM r4 GROUP BY ALL), e AS (SELECT month FROM f GROUP BY month HAVING avg(CAST(fine AS INT)) >= 0.3e0),
    r5 AS (SELECT r4.*, fine FROM r4 JOIN f USING (month, freq_id) JOIN e USING (month)), i AS (SELECT month, input_id, avg(CAST(k AS INT)) > 0.4e0 AS kept FROM r5 WHERE fine GROUP BY ALL)
    SELECT update_t, input_id, freq_id, CASE WHEN k AND fine AND coalesce(kept, false) THEN w ELSE 0.0e0 END AS w FROM r5 LEFT JOIN i USING (month, input_id)""",
    gain="gain",
)
def d27_flag_amplitudes(gain):
    out = P.flag_amplitudes(_amplitudes(gain), ["month"], 0.3, 1.9, 2.5131, 4.0131, 3, 0.5, 0.4, 0.3)
    return out.select("update_t", "input_id", "freq_id", "w")


@query(
    f"""WITH a AS (SELECT * EXCLUDE (a), CASE WHEN w > 0 THEN a END AS a FROM ({_AMP})),
    b AS (SELECT *, abs(a - quantile_cont(a, 0.5) OVER u) AS r FROM a WINDOW u AS (PARTITION BY input_id, month ORDER BY freq_id, update_t ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING))
    SELECT update_t, input_id, freq_id, CASE WHEN coalesce(r > 3.0131e0*1.4826e0*quantile_cont(r, 0.5) OVER u, false) THEN 0.0e0 ELSE w END AS w FROM b
    WINDOW u AS (PARTITION BY input_id, month ORDER BY freq_id, update_t ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING)""",
    gain="gain",
)
def m12_narrowband_features(gain):
    rows = _amplitudes(gain).withColumn("at", F.struct("freq_id", "update_t"))
    return P.narrowband_features(rows, ["input_id", "month"], "at", 4, 3.0131).select("update_t", "input_id", "freq_id", "w")
