"""Queries of calibration operators over the fixture relations."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.functions import scalar as X
from meridian.operators import calibration as C
from meridian.operators import fits as M
from meridian.plans.queries import CELL, CKEY, LSA, SUN
from meridian.plans.registry import R, col, query, rounded

RA, DEC, LATITUDE, LONGITUDE = 83.6, 22.0, 49.3, -119.6
_MHZ = "(800-400*v.freq_id/1024.0e0)"
_HA = f"radians({LSA} - {RA!r}::DOUBLE)"
_PHASE = f"""(-2*pi()*(i.x/(299.792458e0/{_MHZ})*(-cos(radians({DEC!r}::DOUBLE))*sin({_HA}))
 + i.y/(299.792458e0/{_MHZ})*(cos(radians({LATITUDE!r}::DOUBLE))*sin(radians({DEC!r}::DOUBLE)) - sin(radians({LATITUDE!r}::DOUBLE))*cos(radians({DEC!r}::DOUBLE))*cos({_HA}))))"""
_TURNED = f"(SELECT v.*, {_PHASE} AS p FROM fx_vis v JOIN fx_input i ON v.input_id = i.input_id)"
_STOPPED = f"(SELECT *, re*cos(p)+im*sin(p) AS sr, im*cos(p)-re*sin(p) AS si FROM {_TURNED})"


def _phased(vis, inputs):
    return C.source_phase(vis, inputs, "input_id", RA, DEC, LATITUDE, LONGITUDE, X.wavelength(X.channel_mhz(col("freq_id"))))


@query(f"SELECT sample_id, {R('sr')} AS re, {R('si')} AS im, w FROM {_STOPPED}", vis="vis", inputs="input")
def d39_fringestop(vis, inputs):
    return rounded(C.fringestop(_phased(vis, inputs), col("phase")).select("sample_id", "re", "im", "w"))


@query(f"SELECT sample_id, {R('cos(p)')} AS c, {R('sin(p)')} AS s FROM {_TURNED}", vis="vis", inputs="input")
def x3_fringe_phase(vis, inputs):
    return rounded(_phased(vis, inputs).select("sample_id", F.cos("phase").alias("c"), F.sin("phase").alias("s")))


_BEAM = f"(SELECT freq_id, lsd, sum(w*sr)/sum(w) AS br, sum(w*si)/sum(w) AS bi, sum(w) AS bw FROM {_STOPPED} GROUP BY freq_id, lsd HAVING sum(w) > 0)"


@query(f"SELECT freq_id, lsd, {R('br')} AS re, {R('bi')} AS im, {R('bw')} AS w FROM {_BEAM}", vis="vis", inputs="input")
def a16_beamform(vis, inputs):
    return rounded(C.beamform(_phased(vis, inputs), ["freq_id", "lsd"], col("phase")).where("w > 0"))


@query(
    f"""SELECT s.sample_id, {R('s.re - coalesce(b.br*cos(s.p)-b.bi*sin(s.p), 0)')} AS re, {R('s.im - coalesce(b.br*sin(s.p)+b.bi*cos(s.p), 0)')} AS im
    FROM {_TURNED} s LEFT JOIN {_BEAM} b ON s.freq_id = b.freq_id AND s.lsd = b.lsd""",
    vis="vis", inputs="input",
)
def a17_project_out(vis, inputs):
    return rounded(C.project_out(_phased(vis, inputs), ["freq_id", "lsd"], col("phase")).select("sample_id", "re", "im"))


_TEMPERATURE = "(SELECT input_id, avg(abs(re)) AS temperature FROM fx_vis WHERE w > 0 GROUP BY input_id)"


@query(
    f"""SELECT p.prod_id, {R('CASE WHEN coalesce(a.temperature*b.temperature, 0) = 0 THEN 0 ELSE 1000/a.temperature/b.temperature END')} AS w FROM fx_baseline p
    LEFT JOIN {_TEMPERATURE} a ON p.input_a = a.input_id LEFT JOIN {_TEMPERATURE} b ON p.input_b = b.input_id""",
    baseline="baseline", vis="vis",
)
def d5_radiometer_weight(baseline, vis):
    autos = vis.where("w > 0").groupBy("input_id").agg(F.avg(F.abs("re")).alias("temperature"))
    return rounded(C.radiometer_weight(baseline.withColumn("w", F.lit(1000.0)), autos).select("prod_id", "w"))


@query(
    f"""SELECT g.update_t, g.input_id, g.freq_id, {R('g.re*coalesce(d.re,0)-g.im*coalesce(d.im,0)')} AS re, {R('g.re*coalesce(d.im,0)+g.im*coalesce(d.re,0)')} AS im,
    {R('CASE WHEN coalesce(d.re*d.re+d.im*d.im, 0) = 0 THEN 0 ELSE g.w/(d.re*d.re+d.im*d.im) END')} AS w
    FROM (SELECT * FROM fx_gain WHERE update_kind = 'gain') g ASOF LEFT JOIN (SELECT * FROM fx_gain WHERE update_kind = 'transition') d
    ON g.input_id = d.input_id AND g.freq_id = d.freq_id AND g.update_t >= d.update_t""",
    gain="gain",
)
def d35_apply_digital_gain(gain):
    part = lambda kind: gain.where(col("update_kind") == kind).drop("update_kind")
    return rounded(C.apply_digital_gain(part("gain"), part("transition"), ["input_id", "freq_id"]))


_ON = "g.input_id={0}.input_id AND g.freq_id={0}.freq_id"


@query(
    f"""WITH b AS (SELECT c.*, g.update_t AS bt, g.re AS b FROM (SELECT {', '.join(CKEY)} FROM fx_cell) c ASOF LEFT JOIN fx_gain g ON {_ON.format('c')} AND c.t >= g.update_t),
    f AS (SELECT b.*, g.update_t AS nt, g.re AS a FROM b ASOF LEFT JOIN fx_gain g ON {_ON.format('b')} AND b.t <= g.update_t)
    SELECT {', '.join(CKEY)}, {R('CASE WHEN bt IS NULL THEN a WHEN nt IS NULL THEN b WHEN nt = bt THEN b ELSE b + (t-bt)/(nt-bt)*(a-b) END')} AS g_re FROM f""",
    cell="cell", gain="gain",
)
def w15_interpolate_gains(cell, gain):
    return rounded(C.interpolate_held(cell.select(*CKEY), gain, ["input_id", "freq_id"], "t", "update_t", "re", "g_re"))


@query(f"SELECT input_id, freq_id, {R('arg_max(re, update_t)', 8)} AS re, arg_max(update_kind, update_t) AS update_kind FROM fx_gain WHERE update_t <= 883612800 GROUP BY input_id, freq_id", gain="gain")
def q13_inputs_at(gain):
    return rounded(C.inputs_at(gain, ["input_id", "freq_id"], "update_t", 883612800.0, ["re", "update_kind"]), 8)


@query(f"SELECT lsd, freq_id, stack_id, ra_id, {R('re*(1+0.01e0*stack_id)')} AS re FROM fx_day", day="day")
def j11_aligned_join(day):
    scale = day.select(*CELL, (1 + 0.01 * col("stack_id")).alias("scale"))
    return rounded(C.aligned_join(day, scale, CELL, "scale").select(*CELL, (col("re") * col("scale")).alias("re")))


_SUN_HA = f"(({LSA}-sra+180) - 360*floor(({LSA}-sra+180)/360) - 180)"


@query(f"SELECT sample_id, CASE WHEN abs({_SUN_HA}) <= 2*degrees(14.87857614e0/(800-400*freq_id/1024.0e0)/cos(radians(degrees(sdec)))) THEN 0.0e0 ELSE w END AS w FROM {SUN}", vis="vis")
def d9_mask_sun(vis):
    return C.mask_sun(vis, X.channel_mhz(col("freq_id")), LONGITUDE).select("sample_id", "w")


@query(f"SELECT sample_id FROM {SUN} WHERE abs({_SUN_HA})/360*86164.0989e0 > 3600", vis="vis")
def q5_exclude_sun(vis):
    return C.exclude_sun(vis, LONGITUDE, 3600.0).select("sample_id")


@query("SELECT file_id FROM fx_file WHERE acq_id = 3 AND start_t < (SELECT max(finish_t) FROM fx_file WHERE acq_id = 3) - 31536000 AND finish_t >= (SELECT min(start_t) FROM fx_file WHERE acq_id = 3) + 31536000", file="file")
def q10_run_files(file):
    spans = file.groupBy("acq_id").agg((F.min("start_t") + 31536000).alias("run_start"), (F.max("finish_t") - 31536000).alias("run_finish"))
    runs = spans.select("acq_id", "run_start", "run_finish", F.concat(F.lit("run"), "acq_id").alias("run_name"), F.lit(True).alias("active"))
    return C.run_files(runs, file, "run3").select("file_id")


@query("SELECT file_id, acq_id, CASE WHEN acq_id%2=0 THEN 'corr' ELSE 'weather' END AS acqtype, file_id%8 IN (1, 2) OR (file_id+3)%8 IN (1, 2) AS online FROM fx_file WHERE has_file", file="file")
def q21_index_files(file):
    node = F.explode(F.array(col("file_id") % 8, (col("file_id") + 3) % 8)).alias("node")
    copies = file.select("file_id", "has_file", node)
    acqs = file.select("acq_id", F.when(col("acq_id") % 2 == 0, "corr").otherwise("weather").alias("acqtype"))
    return C.index_files(copies, file.select("file_id", "acq_id"), acqs, [1, 2])


@query(
    """SELECT freq_id, beam, t_id, subfreq, CASE WHEN abs(subfreq-32) < 12 AND x >= 0.6e0*max(CASE WHEN abs(subfreq-32) < 12 THEN x END) OVER (PARTITION BY freq_id, beam, t_id) THEN w ELSE 0.0e0 END AS w FROM fx_spec""",
    spec="spec",
)
def d28_select_transit(spec):
    return C.select_transit(spec, ["freq_id", "beam", "t_id"], col("subfreq") - 32, F.lit(24.0)).select("freq_id", "beam", "t_id", "subfreq", "w")


@query(f"SELECT freq_id, beam, t_id, subfreq, {R('(800-400*freq_id/1024.0e0)*(1-30*(subfreq-32)/299792.458e0)')} AS mhz FROM fx_spec", spec="spec")
def x8_doppler(spec):
    return rounded(spec.select("freq_id", "beam", "t_id", "subfreq", C.doppler(X.channel_mhz(col("freq_id")), 30 * (col("subfreq") - 32)).alias("mhz")))


_SCALE = "power(10.0e0, 2-floor(log10(abs(CASE WHEN re=0 THEN NULL ELSE re END))))"


@query(f"SELECT sample_id, {R(f'CASE WHEN re=0 THEN 0 ELSE round_even(re*{_SCALE}, 0)/{_SCALE} END')} AS re FROM fx_vis", vis="vis")
def x11_round_significant(vis):
    return rounded(vis.select("sample_id", X.round_sig(col("re"), 3).alias("re")))


_D = "((abs(el)-0.25e0)/0.4e0)"


@query(f"SELECT freq_id, ra_id, el_id, {R(f'CASE WHEN {_D} <= 0 THEN 1 WHEN {_D} >= 1 THEN 0 ELSE 0.5e0*(1+cos(pi()*{_D})) END')} AS taper, {R('CASE WHEN el_id >= 4 THEN 1 ELSE 0.5e0*(1-cos(pi()*el_id/4)) END')} AS edge FROM fx_map", map="map")
def x12_tapers(map):
    return rounded(map.select("freq_id", "ra_id", "el_id", X.cosine_taper((F.abs("el") - 0.25) / 0.4).alias("taper"), C.half_hanning(col("el_id"), 5).alias("edge")))


@query(
    """WITH g AS (SELECT prod_id, pol, CAST(round(dx/22+1e-9) AS BIGINT) AS xi, CAST(round(dy/0.3e0+1e-9) AS BIGINT) AS yi FROM fx_baseline)
    SELECT prod_id, xi, yi, dense_rank() OVER (PARTITION BY pol ORDER BY xi, yi) AS unique_id FROM g""",
    baseline="baseline",
)
def x20_grid_indices(baseline):
    return C.grid_indices(baseline, 22.0, 0.3).select("prod_id", "xi", "yi", "unique_id")


_M5 = """(SELECT freq_id, (g22*h1-g12*h2)/(g11*g22-g12*g12) AS a1, (g11*h2-g12*h1)/(g11*g22-g12*g12) AS a2 FROM (SELECT freq_id, sum(w) AS g11, sum(w*cos(radians(ra))) AS g12, sum(w) AS g22,
 sum(w*re) AS h1, sum(w*(re*cos(radians(ra))+im*sin(radians(ra)))) AS h2 FROM fx_vis GROUP BY freq_id))"""


@query(f"SELECT v.sample_id, {R('v.re - m.a1 - m.a2*cos(radians(v.ra))')} AS re, {R('v.im - m.a2*sin(radians(v.ra))')} AS im FROM fx_vis v JOIN {_M5} m ON v.freq_id = m.freq_id", vis="vis")
def m7_subtract_sources(vis):
    second = X.cis(F.radians("ra"))
    amps = M.two_source_amplitudes(vis, ["freq_id"], (F.lit(1.0), F.lit(0.0)), second)
    joined = vis.join(amps, "freq_id")
    return rounded(joined.select("sample_id", (col("re") - col("amp1") - col("amp2") * second[0]).alias("re"), (col("im") - col("amp2") * second[1]).alias("im")))
