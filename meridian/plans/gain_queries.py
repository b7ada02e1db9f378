"""Queries of gain errors, stacked beams, interval corrections and acquisition references over the fixture relations."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.functions import scalar as X
from meridian.operators import calibration as C
from meridian.operators import gains as G
from meridian.plans.calibration_queries import LONGITUDE, _SUN_HA
from meridian.plans.queries import SUN
from meridian.plans.registry import R, col, off_ties, query, rounded

AT = 883612800.0
_AT = "(SELECT input_id, freq_id, arg_max(re, update_t) AS re, arg_max(im, update_t) AS im, arg_max(w, update_t) AS w FROM fx_gain WHERE update_t <= 883612800 GROUP BY input_id, freq_id)"
_PAIRS = f"""(SELECT p.xind, p.pol, a.freq_id, a.re*b.re+a.im*b.im AS cr, a.im*b.re-a.re*b.im AS ci, a.w AS wa, b.w AS wb, a.re*a.re+a.im*a.im AS na, b.re*b.re+b.im*b.im AS nb
 FROM fx_baseline p JOIN fx_input ia ON p.input_a=ia.input_id AND ia.good JOIN fx_input ib ON p.input_b=ib.input_id AND ib.good
 JOIN {_AT} a ON p.input_a=a.input_id JOIN {_AT} b ON p.input_b=b.input_id AND a.freq_id=b.freq_id)"""


def _in_force(gain):
    return C.inputs_at(gain, ["input_id", "freq_id"], "update_t", AT, ["re", "im", "w"])


@query(
    f"""WITH c AS (SELECT xind, freq_id, avg(cr) AS cr, avg(ci) AS ci FROM {_PAIRS} GROUP BY xind, freq_id)
    SELECT v.sample_id, {R('coalesce((v.re*cr+v.im*ci)/(cr*cr+ci*ci), 0)')} AS re, {R('coalesce((v.im*cr-v.re*ci)/(cr*cr+ci*ci), 0)')} AS im, {R('coalesce(v.w*(cr*cr+ci*ci), 0)')} AS w
    FROM fx_vis v LEFT JOIN c ON v.input_id%4=c.xind AND v.freq_id=c.freq_id""",
    vis="vis", baseline="baseline", inputs="input", gain="gain",
)
def a13_correct_gain_error(vis, baseline, inputs, gain):
    error = G.stack_gain_error(baseline, inputs, _in_force(gain), ["xind"], ["freq_id"])
    stacked = vis.withColumn("xind", col("input_id") % 4)
    return rounded(G.correct_gain_error(stacked, error, ["xind", "freq_id"]).select("sample_id", "re", "im", "w"))


@query(
    f"""WITH p AS (SELECT *, CASE WHEN wa>0 AND wb>0 AND na>0 AND nb>0 THEN 1/((cr*cr+ci*ci)*(1/(wa*na)+1/(wb*nb))) ELSE 0 END AS pw FROM {_PAIRS})
    SELECT pol, xind, freq_id, {R('coalesce(sum(pw*cr)/nullif(sum(pw),0),0)')} AS re, {R('coalesce(sum(pw*ci)/nullif(sum(pw),0),0)')} AS im, {R('sum(pw)')} AS w FROM p GROUP BY pol, xind, freq_id""",
    baseline="baseline", inputs="input", gain="gain",
)
def a15_stacked_beam(baseline, inputs, gain):
    return rounded(G.stacked_beam(baseline, inputs, _in_force(gain), ["pol", "xind"], ["freq_id"]))


_NARROW = "(g.w > 0 AND g.update_kind = 'transition' AND g.freq_id <> 3)"
_NORM = "(s.re*s.re+s.im*s.im)"


@query(
    f"""WITH s AS (SELECT input_id, freq_id, avg(re) AS re, avg(im) AS im FROM fx_gain GROUP BY input_id, freq_id)
    SELECT g.update_t, g.input_id, g.freq_id, {R(f'CASE WHEN {_NARROW} THEN (g.re*s.re+g.im*s.im)/{_NORM} ELSE 1 END')} AS re,
    {R(f'CASE WHEN {_NARROW} THEN (g.im*s.re-g.re*s.im)/{_NORM} ELSE 0 END')} AS im, CASE WHEN {_NARROW} THEN 1.0e0 ELSE 0.0e0 END AS w
    FROM fx_gain g JOIN s ON g.input_id=s.input_id AND g.freq_id=s.freq_id""",
    gain="gain",
)
def d37_narrowband_gain_error(gain):
    smooth = gain.groupBy("input_id", "freq_id").agg(F.avg("re").alias("re"), F.avg("im").alias("im"))
    masked = (col("update_kind") == "transition") & (col("freq_id") != 3)
    out = G.narrowband_gain_error(gain, smooth, ["input_id", "freq_id"], ["update_t", "input_id"], masked)
    return out.select("update_t", "input_id", "freq_id", off_ties(col("re"), 6).alias("re"), off_ties(col("im"), 6).alias("im"), "w")


_DELAY = "(2*pi()*1e6*(800-400*v.freq_id/1024.0e0)*coalesce(d.delay, 0))"


@query(
    f"""WITH d AS (SELECT v.sample_id, sum(f.delay) AS delay FROM fx_vis v JOIN (SELECT start_t, finish_t, (k-50)*1e-10 AS delay FROM fx_flag_meta WHERE k <> 50) f
    ON v.t BETWEEN f.start_t AND f.finish_t GROUP BY v.sample_id)
    SELECT v.sample_id, {R(f'v.re*cos({_DELAY})-v.im*sin({_DELAY})')} AS re, {R(f'v.re*sin({_DELAY})+v.im*cos({_DELAY})')} AS im FROM fx_vis v LEFT JOIN d ON v.sample_id=d.sample_id""",
    vis="vis", flags="flag_meta",
)
def d38_correct_time_offset(vis, flags):
    delays = G.flag_delays(flags, "$.k", 50.0, 1e-10)
    return rounded(G.correct_delays(vis, "sample_id", delays, X.channel_mhz(col("freq_id")), 6000.0).select("sample_id", "re", "im"))


@query("SELECT flag_id, k FROM fx_flag_meta", flags="flag_meta")
def x17_json(flags):
    return flags.select("flag_id", F.from_json("metadata", "k int")["k"].alias("k"))


@query("SELECT file_id, acq_id, (finish_t-start_t) - first_value(finish_t-start_t) OVER (PARTITION BY acq_id ORDER BY start_t, file_id) AS longer FROM fx_file", file="file")
def t7_acquisition_reference(file):
    spans = file.select("file_id", "acq_id", "start_t", (col("finish_t") - col("start_t")).alias("span"))
    return G.against_first(spans, "acq_id", ["start_t", "file_id"], "span", "longer").select("file_id", "acq_id", "longer")


@query(f"SELECT sample_id, CASE WHEN abs({_SUN_HA}) < 90 THEN w < 0.5e0 ELSE frac_lost > 0.03e0 END AS bad FROM {SUN}", vis="vis")
def d15_context_flags(vis):
    day = F.abs(C.sun_distance(col("t"), LONGITUDE)) < 90
    return vis.select("sample_id", G.context_mask(day, col("w") < 0.5, col("frac_lost") > 0.03).alias("bad"))


@query(
    """WITH b AS (SELECT freq_id, t_id, beam, count(CASE WHEN w = 0 AND x > 1 THEN 1 END) > 2 AS bad FROM fx_spec GROUP BY freq_id, t_id, beam)
    SELECT freq_id, t_id, el_id, bool_or(bad) AS bad FROM b JOIN (SELECT range AS el_id FROM range(32)) g ON abs((-0.484375e0+el_id/32.0e0) - (beam-3.5e0)/8) <= 0.1e0 GROUP BY freq_id, t_id, el_id""",
    spec="spec",
)
def w18_spread_mask(spec):
    beams = spec.groupBy("freq_id", "t_id", "beam").agg((F.count(F.when((col("w") == 0) & (col("x") > 1), 1)) > 2).alias("bad"))
    return G.spread_mask(beams, ["freq_id", "t_id"], (col("beam") - 3.5) / 8, 0.1, -0.484375, 1 / 32, 32)
