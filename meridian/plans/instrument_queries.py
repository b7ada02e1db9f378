"""Queries of inputs, products, sub-channels and kernels over the fixture relations."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.functions import scalar as X
from meridian.operators import inputs as I
from meridian.operators import masks as D
from meridian.operators import spectra as P
from meridian.operators.joins import interval_join
from meridian.plans.queries import ALT, CELL, CKEY, INV, SUN
from meridian.plans.registry import R, col, query, rounded

SPEC = ["freq_id", "beam", "t_id", "subfreq"]
_GOODS = """(SELECT p.*, coalesce(a.good, false) AND coalesce(b.good, false) AS good FROM fx_baseline p
 LEFT JOIN fx_input a ON p.input_a=a.input_id LEFT JOIN fx_input b ON p.input_b=b.input_id)"""


@query("SELECT f.freq_id, f.beam, f.t_id, f.subfreq, CASE WHEN (f.freq_id+f.t_id)%3=0 THEN 0.0e0 ELSE w END AS w FROM fx_spec f", spec="spec")
def d2_apply_mask(spec):
    mask = spec.select("freq_id", "t_id").distinct().withColumn("bad", (col("freq_id") + col("t_id")) % 3 == 0)
    return D.apply_mask(spec, mask, ["freq_id", "t_id"]).select(*SPEC, "w")


@query(f"SELECT prod_id, good FROM {_GOODS}", baseline="baseline", inputs="input")
def d3_input_mask(baseline, inputs):
    return I.product_mask(baseline, inputs).select("prod_id", "good")


@query(f"SELECT sample_id, CASE WHEN {ALT} > -0.833e0 THEN 0.0e0 ELSE w END AS w FROM {SUN}", vis="vis")
def d7_mask_day(vis):
    return vis.select("sample_id", F.when(X.daytime(col("t"), 49.3, -119.6), 0.0).otherwise(col("w")).alias("w"))


_SIGMA = "degrees(14.87857614e0/(800-400*v.freq_id/1024.0e0)/cos(radians(c.dec)))"


@query(
    f"""SELECT v.sample_id, CASE WHEN EXISTS (SELECT 1 FROM fx_catalog c WHERE c.flux > 500 AND least(abs(v.ra-c.ra), 360-abs(v.ra-c.ra)) <= 2*{_SIGMA}) THEN 0.0e0 ELSE v.w END AS w
    FROM fx_vis v""",
    vis="vis", catalog="catalog",
)
def d8_mask_source(vis, catalog):
    freqs = vis.select("freq_id").distinct().withColumn("_half", X.channel_mhz(col("freq_id")))
    bright = catalog.where("flux > 500").select("ra", "dec")
    # Channels are a fixed axis of the instrument: each source has one window for each of them.
    windows = bright.crossJoin(F.broadcast(freqs)).withColumn("_half", F.degrees(2 * X.beam_sigma(col("_half"), col("dec"), F.lit("X"))))
    windows = windows.select(col("freq_id").alias("_f"), "_half", F.explode(F.array(*(col("ra") + x for x in (-360.0, 0.0, 360.0)))).alias("_c"))
    windows = windows.select("_f", (col("_c") - col("_half")).alias("_low"), (col("_c") + col("_half")).alias("_high")).where("_low <= 360 AND _high >= 0")
    hit = interval_join(vis, windows, "ra", "_low", "_high", 5.0, "left_semi", col("_f") == col("freq_id")).select("sample_id", F.lit(True).alias("bad"))
    return D.apply_mask(vis, hit, ["sample_id"]).select("sample_id", "w")


@query("SELECT v.sample_id, EXISTS (SELECT 1 FROM fx_flag_vis b WHERE b.freq_id = v.freq_id AND v.t BETWEEN b.start_t AND b.finish_t) AS bad FROM fx_vis v", vis="vis", bands="flag_vis")
def d14_static_bands(vis, bands):
    bands = bands.where("freq_id is not null").select(col("freq_id").alias("_f"), "start_t", "finish_t")
    hit = interval_join(vis, bands, "t", "start_t", "finish_t", 3600.0, "left_semi", col("_f") == col("freq_id")).select("sample_id", F.lit(True).alias("_bad"))
    return vis.join(hit, "sample_id", "left").select("sample_id", F.coalesce("_bad", F.lit(False)).alias("bad"))


@query("SELECT freq_id, beam, t_id, subfreq, CASE WHEN subfreq=32 THEN 0.0e0 ELSE w END AS w FROM fx_spec", spec="spec")
def d29_cut_centre(spec):
    return P.cut_centre(spec, 32).select(*SPEC, "w")


_METRIC = f"2*({INV.format('(x*x/(0.390625e0*1e6/64*10*0.9e0)*w)')})"


@query(f"SELECT freq_id, t_id, avg({_METRIC}) > 67000 AS bad FROM fx_spec GROUP BY freq_id, t_id", spec="spec")
def d30_radiometer_mask(spec):
    return P.sensitivity(spec, ["freq_id", "t_id"], 0.390625, 64, 10.0, 0.1).select("freq_id", "t_id", (col("metric") > 67000).alias("bad"))


_BEAMS = "(SELECT freq_id, t_id, beam, count(*) FILTER (x > 1.2e0) >= 3 AS hit FROM fx_spec GROUP BY freq_id, t_id, beam)"


@query(f"SELECT freq_id, t_id, count(*) FILTER (hit) >= 4 AS bad FROM {_BEAMS} GROUP BY freq_id, t_id", spec="spec")
def d31_crowded_beams(spec):
    return P.crowded_times(spec, col("x") > 1.2, 3, 4)


@query(f"SELECT freq_id, t_id, beam, hit AND NOT (avg(CASE WHEN hit THEN 1.0e0 ELSE 0.0e0 END) OVER (PARTITION BY freq_id, beam) > 0.5e0) AS bad FROM {_BEAMS}", spec="spec")
def d32_persistent_beams(spec):
    mask = spec.groupBy("freq_id", "t_id", "beam").agg((F.count(F.when(col("x") > 1.2, 1)) >= 3).alias("bad"))
    return P.clear_persistent(mask, ["freq_id", "beam"], 0.5)


@query(
    """SELECT lsd, freq_id, source_id FROM (SELECT i.lsd, i.freq_id, c.source_id, row_number() OVER (PARTITION BY i.lsd, i.freq_id ORDER BY c.flux DESC, c.source_id DESC) AS k
    FROM (SELECT lsd, freq_id, min(ra) AS a, max(ra) AS b FROM fx_vis GROUP BY lsd, freq_id) i JOIN fx_catalog c ON c.ra BETWEEN i.a AND i.b) WHERE k = 1""",
    vis="vis", catalog="catalog",
)
def d33_source_transit(vis, catalog):
    items = vis.groupBy("lsd", "freq_id").agg(F.min("ra").alias("a"), F.max("ra").alias("b"))
    return I.transiting_source(items, ["lsd", "freq_id"], catalog, col("a"), col("b"), 90.0)


_CK = ", ".join(f"c.{x}" for x in CKEY)


@query(
    f"""SELECT {_CK}, {R('c.re*coalesce(g.re,0)-c.im*coalesce(g.im,0)', 4)} AS re, {R('c.re*coalesce(g.im,0)+c.im*coalesce(g.re,0)', 4)} AS im,
    {R('CASE WHEN coalesce(g.re*g.re+g.im*g.im,0)=0 THEN 0 ELSE c.w/(g.re*g.re+g.im*g.im) END', 4)} AS w
    FROM fx_cell c LEFT JOIN (SELECT input_id, freq_id, avg(re) AS re, avg(im) AS im FROM fx_gain GROUP BY input_id, freq_id) g ON c.input_id=g.input_id AND c.freq_id=g.freq_id""",
    cell="cell", gain="gain",
)
def d34_apply_gain(cell, gain):
    mean = gain.groupBy("input_id", "freq_id").agg(F.avg("re").alias("re"), F.avg("im").alias("im"))
    return rounded(I.apply_gain(cell, mean, ["input_id", "freq_id"]).select(*CKEY, "re", "im", "w"), 4)


@query(
    f"""SELECT m.freq_id, m.ra_id, m.el_id, {R(INV.format('r.rms*r.rms'))} AS w FROM fx_map m
    JOIN (SELECT freq_id, ra_id, sqrt(avg(val*val)) AS rms FROM fx_map GROUP BY freq_id, ra_id) r ON m.freq_id=r.freq_id AND m.ra_id=r.ra_id""",
    map="map",
)
def d40_convert_ring_map(map):
    rms = map.groupBy("freq_id", "ra_id").agg(F.sqrt(F.avg(col("val") * col("val"))).alias("rms"))
    return rounded(map.join(rms, ["freq_id", "ra_id"]).select("freq_id", "ra_id", "el_id", X.inv0(col("rms") * col("rms")).alias("w")))


@query(f"SELECT freq_id, beam, t_id, subfreq, {R('x/(1+0.01e0*subfreq)')} AS x, {R('w*(1+0.01e0*subfreq)*(1+0.01e0*subfreq)')} AS w FROM fx_spec", spec="spec")
def d42_divide_by_shape(spec):
    return rounded(P.divide_by_shape(spec, 1 + 0.01 * col("subfreq")).select(*SPEC, "x", "w"))


@query(
    f"""SELECT d.lsd, d.freq_id, d.stack_id, d.ra_id, {R('d.re-coalesce(m.re,0)')} AS re, CASE WHEN m.re IS NULL THEN 0.0e0 ELSE d.w END AS w FROM fx_day d
    LEFT JOIN (SELECT lsd, freq_id, stack_id, sum(w*re)/sum(w) AS re FROM fx_day WHERE w>0 GROUP BY lsd, freq_id, stack_id) m ON d.lsd=m.lsd AND d.freq_id=m.freq_id AND d.stack_id=m.stack_id""",
    day="day",
)
def a4_change_sidereal_mean(day):
    series = ["lsd", "freq_id", "stack_id"]
    mean = day.where("w > 0").groupBy(*series).agg((F.sum(col("w") * col("re")) / F.sum("w")).alias("_m"))
    joined = day.join(mean, series, "left")
    return rounded(joined.select(*CELL, (col("re") - F.coalesce("_m", F.lit(0.0))).alias("re"), F.when(col("_m").isNull(), 0.0).otherwise(col("w")).alias("w")))


@query(f"SELECT freq_id, beam, subfreq, {R('CASE WHEN sum(w)=0 THEN 0 ELSE sum(w*x)/sum(w) END')} AS x, {R('sum(w)')} AS w, count(*) FILTER (w>0) AS nsample FROM fx_spec GROUP BY freq_id, beam, subfreq", spec="spec")
def a5_stack_spectra(spec):
    sums = spec.groupBy("freq_id", "beam", "subfreq").agg(F.sum(col("w") * col("x")).alias("s"), F.sum("w").alias("w"), F.count(F.when(col("w") > 0, 1)).alias("nsample"))
    return rounded(sums.select("freq_id", "beam", "subfreq", (col("s") * X.inv0(col("w"))).alias("x"), "w", "nsample"))


_TESTS = "(SELECT input_id, test, CASE test WHEN 'level' THEN re > 5 WHEN 'phase' THEN im > -45 ELSE w > 0 END AS passed FROM fx_vis, (SELECT unnest(['level', 'phase', 'weight']) AS test))"


def _tests(vis):
    named = {"level": col("re") > 5, "phase": col("im") > -45, "weight": col("w") > 0}
    return vis.select("input_id", F.explode(F.array(*(F.struct(F.lit(k).alias("test"), v.alias("passed")) for k, v in named.items()))).alias("x")).select("input_id", "x.*")


@query(f"SELECT input_id, bool_and(share >= 0.8e0) AND input_id NOT IN (1, 2) AS good FROM (SELECT input_id, test, avg(CASE WHEN passed THEN 1.0e0 ELSE 0.0e0 END) AS share FROM {_TESTS} GROUP BY input_id, test) GROUP BY input_id", vis="vis")
def a9_test_inputs(vis):
    return I.test_inputs(_tests(vis), 0.8, [1, 2], ["level", "phase", "weight"])


@query(f"SELECT input_id, bool_and(passed) AND input_id NOT IN (3) AS good FROM {_TESTS} WHERE test <> 'weight' GROUP BY input_id", vis="vis")
def a10_flag_channels(vis):
    return I.test_inputs(_tests(vis), 1.0, [3], ["level", "phase"])


@query(f"SELECT freq_id, beam, t_id, {R(f'avg({_METRIC})', 3)} AS metric FROM fx_spec GROUP BY freq_id, beam, t_id", spec="spec")
def a18_sensitivity(spec):
    return rounded(P.sensitivity(spec, ["freq_id", "beam", "t_id"], 0.390625, 64, 10.0, 0.1), 3)


@query(
    f"""SELECT pol, xind, yind, {R('w/(2*sum(w) OVER (PARTITION BY pol))')} AS weight FROM (SELECT pol, xind, yind, count(*)*CASE WHEN xind=0 AND yind=0 THEN 0.5e0 ELSE 1.0e0 END AS w
    FROM (SELECT pol, xind, CAST(round(dy/0.3e0) AS BIGINT) AS yind FROM {_GOODS} WHERE good) GROUP BY pol, xind, yind)""",
    baseline="baseline", inputs="input",
)
def a23_grid_weights(baseline, inputs):
    return rounded(I.grid_weights(I.product_mask(baseline, inputs), 0.3))


@query(f"SELECT pol, xind, count(*) FILTER (good) AS redundancy FROM {_GOODS} GROUP BY pol, xind", baseline="baseline", inputs="input")
def a25_redundancy(baseline, inputs):
    return I.redundancy(I.product_mask(baseline, inputs), ["pol", "xind"])


@query(
    f"""SELECT c.source_id, m.freq_id, {R('sum(m.w*m.val)/sum(m.w)', 4)} AS flux, {R('sqrt(1/sum(m.w))', 4)} AS rms FROM fx_catalog c, range(-1, 2) o(k), fx_map m
    WHERE m.ra_id = (CAST(floor(c.ra/2) AS BIGINT)+k+180)%180 AND m.el_id = CAST(floor(c.dec/9) AS BIGINT) GROUP BY c.source_id, m.freq_id""",
    map="map", catalog="catalog",
)
def a27_photometry(map, catalog):
    ra = F.explode(F.array(*(F.pmod(F.floor(col("ra") / 2) + k, F.lit(180)) for k in (-1, 0, 1))))
    boxes = catalog.select("source_id", F.floor(col("dec") / 9).alias("el_id"), ra.alias("ra_id"))
    return rounded(P.photometry(map, boxes, "val"), 4)


@query(f"SELECT lsd, freq_id, {R('CASE WHEN count(*) FILTER (w>0)=0 THEN 0 ELSE sum(w*(re*re+im*im))/count(*) FILTER (w>0) END')} AS chisq, count(*) FILTER (w>0) AS n FROM fx_day GROUP BY lsd, freq_id", day="day")
def a28_reduced_chisq(day):
    return rounded(I.reduced_chisq(day, ["lsd", "freq_id"]))


@query(
    """SELECT lsd, ra_id, bool_or(bad) AS bad FROM (SELECT lsd, ra_id, w < 0.5e0*quantile_cont(w, 0.5) OVER (PARTITION BY freq_id, stack_id) AS bad FROM fx_day) GROUP BY lsd, ra_id""",
    day="day",
)
def a28_collapsed_low_weight(day):
    return I.collapse(I.low_weight(day, ["freq_id", "stack_id"], 0.5), ["lsd", "ra_id"])


@query("SELECT decision, toxic, CAST(lsd//90 AS BIGINT) AS quarter, count(*) AS n FROM fx_opinion GROUP BY GROUPING SETS ((), (decision), (decision, toxic), (lsd//90))", opinion="opinion")
def a29_grouping_sets(opinion):
    rows = opinion.withColumn("quarter", F.floor(col("lsd") / 90))
    keys = [col("decision"), col("toxic"), col("quarter")]
    return rows.groupingSets([[], keys[:1], keys[:2], keys[2:]], *keys).agg(F.count("*").alias("n"))


# --- windows and kernels -------------------------------------------------------------------------------------


@query(
    """SELECT sample_id, coalesce(w > 0 AND gap = max(CASE WHEN i = mid AND w > 0 THEN gap END) OVER (PARTITION BY freq_id, lsd), false) AS keep FROM
    (SELECT *, sum(CASE WHEN w=0 THEN 1 ELSE 0 END) OVER (PARTITION BY freq_id, lsd ORDER BY i ROWS UNBOUNDED PRECEDING) AS gap FROM
    (SELECT *, row_number() OVER (PARTITION BY freq_id, lsd ORDER BY t, sample_id) AS i, count(*) OVER (PARTITION BY freq_id, lsd)//2 + 1 AS mid FROM fx_vis))""",
    vis="vis",
)
def w6_contiguous_flag(vis):
    return P.run_round_centre(vis.withColumn("at", F.struct("t", "sample_id")), ["freq_id", "lsd"], "at").select("sample_id", "keep")


_KZ = {k - 2: c for k, c in enumerate(P.kz_coefficients(3, 2))}


@query(
    f"""SELECT m.freq_id, m.el_id, (m.ra_id+k.k+180)%180 AS ra_id, {R('sum(k.c*m.val)/sum(k.c)', 4)} AS val FROM fx_map m, (VALUES {', '.join(f'({k}, {c!r}::DOUBLE)' for k, c in _KZ.items())}) k(k, c)
    WHERE m.w > 0 GROUP BY 1, 2, 3 HAVING sum(k.c) >= 0.4e0""",
    map="map",
)
def w7_kz_low_pass(map):
    return rounded(P.spread_kernel(map, ["freq_id", "el_id"], "ra_id", _KZ, "val", 180, 0.4), 4)


@query(f"SELECT freq_id, lsd, CAST(floor(ra/15) AS BIGINT) AS bin, {R('sum(w*re)/sum(w)')} AS re, {R('sum(w)')} AS w FROM fx_vis WHERE w > 0 GROUP BY 1, 2, 3", vis="vis")
def w12_regrid_bins(vis):
    return rounded(P.regrid_bins(vis, ["freq_id", "lsd"], F.floor(col("ra") / 15), "re"))


_L = "3*sin(pi()*x)*sin(pi()*x/3)/(pi()*x*pi()*x)"


@query(
    f"""SELECT freq_id, el_id, ra_id, {R('sum(l*val)')} AS val, {R('1/sum(l*l/w)')} AS w FROM (SELECT freq_id, el_id, (ra_id+k+180)%180 AS ra_id, val, w, {_L} AS l
    FROM (SELECT *, k+0.4e0 AS x FROM fx_map, range(-3, 4) r(k)) WHERE abs(x) < 3) GROUP BY 1, 2, 3 HAVING count(*) >= 6""",
    map="map",
)
def w13_lanczos(map):
    return rounded(P.lanczos_shift(map, ["freq_id", "el_id"], "ra_id", 0.4, 3, "val", 180))


@query(
    f"""SELECT update_t, input_id, freq_id, {R('CASE WHEN w>0 THEN re ELSE coalesce(ly+(freq_id-lx)*(hy-ly)/(hx-lx), re) END', 9)} AS re FROM (SELECT *,
    last_value(CASE WHEN w>0 THEN freq_id END IGNORE NULLS) OVER b AS lx, last_value(CASE WHEN w>0 THEN re END IGNORE NULLS) OVER b AS ly,
    first_value(CASE WHEN w>0 THEN freq_id END IGNORE NULLS) OVER a AS hx, first_value(CASE WHEN w>0 THEN re END IGNORE NULLS) OVER a AS hy FROM fx_gain
    WINDOW b AS (PARTITION BY update_t, input_id ORDER BY freq_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    a AS (PARTITION BY update_t, input_id ORDER BY freq_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))""",
    gain="gain",
)
def w17_fill_channels(gain):
    return rounded(P.fill_between(gain, ["update_t", "input_id"], "freq_id", "re").select("update_t", "input_id", "freq_id", "re"), 9)
