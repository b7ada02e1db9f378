"""Queries of the sky-stream operators over the fixture relations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window

from meridian.functions import scalar as X
from meridian.operators import aggregates as A
from meridian.operators import fits as M
from meridian.operators import index as Q
from meridian.operators import masks as D
from meridian.operators import windows as W
from meridian.operators.joins import asof_join, interval_join, interval_pairs, nearest_key, overlap_join
from meridian.plans.quarter_stack import quarter_stack as _quarter_stack
from meridian.plans.registry import R, col, query, rounded
from meridian.streaming import groups as T

VIS = ["sample_id", "freq_id", "input_id"]
CELL = ["lsd", "freq_id", "stack_id", "ra_id"]
INV = "CASE WHEN {0} = 0 THEN 0.0e0 ELSE 1.0e0/({0}) END"
_FLAGGED = """SELECT d.lsd, d.freq_id, d.stack_id, d.ra_id, d.re, d.im,
  CASE WHEN EXISTS (SELECT 1 FROM fx_flag_day f WHERE f.flag_type IN ('rain1mm','acjump') AND d.t >= f.start_t AND d.t <= f.finish_t
    AND (f.freq_id IS NULL OR f.freq_id = d.freq_id)) THEN 0.0e0 ELSE d.w END AS w FROM fx_day d"""


# --- sources -------------------------------------------------------------------------------------------------


@query(f"SELECT sample_id, freq_id, t, {R('re')} AS re, {R('im')} AS im, CASE WHEN re=0 AND im=0 THEN 0.0e0 ELSE 255.0e0 END AS w FROM fx_vis WHERE freq_id IN (1, 2, 3)", vis="vis")
def s1_read_vis(vis):
    weight = F.when((col("re") == 0) & (col("im") == 0), 0.0).otherwise(255.0)
    return rounded(vis.where(col("freq_id").between(1, 3)).select("sample_id", "freq_id", "t", "re", "im", weight.alias("w")))


@query(f"SELECT update_t, input_id, freq_id, {R('re')} AS re, {R('im')} AS im, w FROM fx_gain WHERE update_kind NOT LIKE '%transition%'", gain="gain")
def s3_gain_updates(gain):
    return rounded(T.gain_updates(gain).select("update_t", "input_id", "freq_id", "re", "im", "w"))


@query(f"SELECT freq_id, beam, t_id, subfreq, {R('x')} AS x, w FROM fx_spec WHERE beam//4 IN (0, 1) AND beam%4 BETWEEN 1 AND 2", spec="spec")
def s8_select_beam(spec):
    return rounded(spec.where(F.floor(col("beam") / 4).isin(0, 1) & (col("beam") % 4).between(1, 2)))


@query("SELECT v.sample_id, (SELECT min(c.source_id) FROM fx_catalog c WHERE c.dec = arg_min) AS source_id FROM (SELECT sample_id, (SELECT arg_min(c.dec, abs(c.dec - v.im)*1000 + c.dec) FROM (SELECT DISTINCT dec FROM fx_catalog) c) AS arg_min FROM fx_vis v) v", vis="vis", catalog="catalog")
def s9_nearest_beam(vis, catalog):
    return nearest_key(vis.select("sample_id", "im"), catalog.select("dec", "source_id"), "im", "dec", "source_id", 5.0).select("sample_id", "source_id")


@query(
    """SELECT day, count(*) AS n_files, min(file_id) AS first_file, max(file_id) AS last_file FROM fx_file f,
    (SELECT DISTINCT CAST(floor(start_t/864000) AS BIGINT) AS day FROM fx_file) d
    WHERE f.finish_t >= (d.day-0.005e0)*864000 AND f.start_t < (d.day+1-0.005e0)*864000 GROUP BY day HAVING count(*) > 1""",
    file="file",
)
def s10_assign_files_to_days(file):
    days = file.select(F.floor(col("start_t") / 864000).alias("day")).distinct()
    days = days.select("day", ((col("day") - 0.005) * 864000).alias("start"), ((col("day") + 1 - 0.005) * 864000).alias("finish"))
    met = Q.files_of_days(days, file, 864000.0).groupBy("day")
    return met.agg(F.count("*").alias("n_files"), F.min("file_id").alias("first_file"), F.max("file_id").alias("last_file")).where("n_files > 1")


@query("SELECT lsd, freq_id, count(*) AS n, min(t) AS first_t, max(t) AS last_t FROM fx_vis GROUP BY lsd, freq_id", vis="vis")
def s11_file_spans(vis):
    return vis.groupBy("lsd", "freq_id").agg(F.count("*").alias("n"), F.min("t").alias("first_t"), F.max("t").alias("last_t"))


# --- file index ----------------------------------------------------------------------------------------------

START, FINISH = 820454400.0, 852076800.0


@query(f"SELECT file_id, start_t FROM fx_file WHERE acqtype='corr' AND has_file AND start_t < {FINISH} AND finish_t >= {START}", file="file")
def q1_find_files(file):
    return Q.find_files(file, START, FINISH).select("file_id", "start_t")


_RUNS = """(SELECT *, sum(CASE WHEN reached IS NULL OR start_t - reached > 43200 THEN 1 ELSE 0 END) OVER (PARTITION BY acq_id ORDER BY start_t, file_id ROWS UNBOUNDED PRECEDING) AS island
  FROM (SELECT *, max(finish_t) OVER (PARTITION BY acq_id ORDER BY start_t, file_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM fx_file))"""


@query(f"SELECT acq_id, CAST(island AS BIGINT) AS island, count(*) AS n_files, min(start_t) AS start_t, max(finish_t) AS finish_t FROM {_RUNS} GROUP BY acq_id, island", file="file")
def q2_intervals(file):
    return Q.contiguous_runs(file, ["acq_id"], 43200.0)


LSA = "(360*(0.7790572732640e0+1.00273781191135448e0*(t/86400-10957.5e0) - floor(0.7790572732640e0+1.00273781191135448e0*(t/86400-10957.5e0))) - 119.6e0)"


@query(f"SELECT sample_id FROM (SELECT *, {LSA} - 360*floor({LSA}/360) AS lsa FROM fx_vis) WHERE lsa >= 300 OR lsa < 40", vis="vis")
def q3_include_ra(vis):
    lsa = X.stellar_angle(col("t"), -119.6)
    return vis.where((lsa >= 300) | (lsa < 40)).select("sample_id")


SUN = """(SELECT *, degrees(atan2(cos(eps)*sin(lam), cos(lam))) AS sra, asin(sin(eps)*sin(lam)) AS sdec FROM
 (SELECT *, radians(280.460e0+0.9856474e0*n+1.915e0*sin(g)+0.020e0*sin(2*g)) AS lam, radians(23.439e0-4e-7*n) AS eps FROM
  (SELECT *, radians(357.528e0+0.9856003e0*n) AS g FROM (SELECT *, t/86400-10957.5e0 AS n FROM fx_vis))))"""
ALT = f"degrees(asin(sin(sdec)*sin(radians(49.3e0))+cos(sdec)*cos(radians(49.3e0))*cos(radians({LSA}-sra))))"


@query(f"SELECT sample_id, {ALT} > -0.833e0 AS day FROM {SUN}", vis="vis")
def q4_daytime(vis):
    return vis.select("sample_id", X.daytime(col("t"), 49.3, -119.6).alias("day"))


@query(
    """SELECT v.sample_id FROM fx_vis v WHERE NOT EXISTS (SELECT 1 FROM fx_flag_vis f WHERE f.flag_type='rain1mm' AND v.t BETWEEN f.start_t AND f.finish_t)""",
    vis="vis", flags="flag_vis",
)
def q8_exclude_data_flags(vis, flags):
    # However many flags cover a time, one run of them holds it: samples meet runs, not flags.
    runs = D.merged_flags(flags.where("flag_type = 'rain1mm'").select(F.lit(0).alias("_all"), "start_t", "finish_t"), "_all", 86400.0)
    return interval_join(vis, runs.select("start_t", "finish_t"), "t", "start_t", "finish_t", 86400.0, "left_anti").select("sample_id")


@query(
    """WITH RECURSIVE n AS (SELECT acq_id, count(*) AS n FROM fx_file GROUP BY acq_id),
    walk AS (SELECT acq_id, n, 1 AS k FROM n WHERE n > 12 AND n % 12 >= 1
      UNION ALL SELECT acq_id, n, k + 1 FROM walk WHERE n % (12 - k) > 1 AND n % (12 + k) > 1 AND k < 11),
    e AS (SELECT acq_id, n, max(k) AS k FROM walk GROUP BY acq_id, n),
    s AS (SELECT n.acq_id, n.n, CASE WHEN n.n <= 12 THEN n.n WHEN k IS NULL THEN 12 WHEN n.n % (12 - k) < n.n % (12 + k) THEN 12 - k ELSE 12 + k END AS m FROM n LEFT JOIN e ON n.acq_id = e.acq_id),
    r AS (SELECT f.file_id, f.acq_id, row_number() OVER (PARTITION BY f.acq_id ORDER BY start_t, file_id) - 1 AS i, s.n, s.m FROM fx_file f JOIN s ON f.acq_id = s.acq_id)
    SELECT file_id, acq_id, CAST(least(greatest(floor((i - floor((n % m)/2.0e0))/m), 0), greatest(floor(n/m), 1) - 1) AS BIGINT) AS group_id FROM r""",
    file="file",
)
def q12_group_acquisitions(file):
    return Q.group_acquisitions(file, 12)


@query(
    """WITH d AS (SELECT file_id, unnest(list_distinct([floor(start_t/86400), floor(finish_t/86400)])) AS day FROM fx_file),
    k AS (SELECT * FROM d WHERE day NOT IN (SELECT floor(start_t/86400) FROM fx_file WHERE NOT has_file)),
    c AS (SELECT day FROM k GROUP BY day HAVING count(*) >= 6) SELECT DISTINCT file_id FROM k WHERE day IN (SELECT day FROM c)""",
    file="file",
)
def q15_filter_existing(file):
    done = file.where("NOT has_file").select(F.floor(col("start_t") / 86400).alias("day"))
    return Q.filter_existing(file, done, 6, 86400.0)


@query("SELECT acq_id, CAST((rn-1)//10 AS BIGINT) AS chunk, count(*) AS n, min(start_t)-3600 AS start_t, max(finish_t)+3600 AS finish_t FROM (SELECT *, row_number() OVER (PARTITION BY acq_id ORDER BY start_t, file_id) AS rn FROM fx_file) GROUP BY 1, 2", file="file")
def q17_chunk_observations(file):
    rows = file.withColumn("chunk", F.floor((F.row_number().over(Window.partitionBy("acq_id").orderBy("start_t", "file_id")) - 1) / 10))
    return rows.groupBy("acq_id", "chunk").agg(F.count("*").alias("n"), (F.min("start_t") - 3600).alias("start_t"), (F.max("finish_t") + 3600).alias("finish_t"))


@query("SELECT DISTINCT unnest(generate_series(lsd, lsd + 2)) AS day FROM fx_day", day="day")
def q18_expand_days(day):
    return day.select("lsd").distinct().select(F.explode(F.sequence("lsd", col("lsd") + 2)).alias("day")).distinct()


_DAYS = "(SELECT DISTINCT CAST(floor(start_t/86400) AS BIGINT) AS day, floor(start_t/86400)*86400 AS start, floor(start_t/86400)*86400+86400 AS finish FROM fx_file)"


def _days(file):
    day = F.floor(col("start_t") / 86400)
    return file.select(day.alias("day")).distinct().withColumns({"start": col("day") * 86400.0, "finish": col("day") * 86400.0 + 86400.0})


@query(
    f"""SELECT day, sum(f.finish_t-f.start_t) AS all_s, sum(CASE WHEN online THEN f.finish_t-f.start_t ELSE 0 END) AS online_s, count(*) AS n_files,
    sum(CASE WHEN online THEN f.finish_t-f.start_t ELSE 0 END) > 0.5e0*86400 AS online
    FROM fx_file f JOIN {_DAYS} d ON f.start_t < d.finish AND f.finish_t >= d.start GROUP BY day HAVING sum(f.finish_t-f.start_t) > 0.5e0*86400""",
    file="file",
)
def q20_available_days(file):
    return Q.available_days(_days(file), file, 0.5)


@query(
    """WITH d AS (SELECT DISTINCT lsd AS day, lsd*5184000.0e0 AS a, (lsd+1)*5184000.0e0 AS b FROM fx_day),
    c AS (SELECT day, flag_type, a AS da, greatest(start_t, a) AS s, least(finish_t, b) AS e FROM fx_flag_day JOIN d ON start_t < b AND finish_t >= a),
    i AS (SELECT *, sum(CASE WHEN reached IS NULL OR s > reached THEN 1 ELSE 0 END) OVER (PARTITION BY day, flag_type ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g
      FROM (SELECT *, max(e) OVER (PARTITION BY day, flag_type ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM c))
    SELECT day, flag_type, sum(l) AS flagged_s FROM (SELECT day, flag_type, max(e)-min(s) AS l FROM i GROUP BY day, flag_type, g) GROUP BY day, flag_type HAVING sum(l) > 0.1e0*5184000""",
    day="day", flags="flag_day",
)
def q25_flagged_days(day, flags):
    days = day.select(col("lsd").alias("day")).distinct().withColumns({"start": col("day") * 5184000.0, "finish": (col("day") + 1) * 5184000.0})
    return Q.flagged_days(days, flags, 0.1, 5184000.0)


@query(
    """SELECT file_id AS tag, CASE WHEN online THEN 'finished' WHEN finish_t-start_t > 18000 THEN 'running' WHEN acqtype='weather' THEN 'pending' WHEN NOT has_file THEN 'failed'
    ELSE 'not_submitted' END AS status FROM fx_file""",
    file="file",
)
def q28_job_status(file):
    part = lambda c: file.where(c).select(col("file_id").alias("tag"))
    return Q.job_status(part("has_file"), part("online"), part("acqtype = 'weather'"), part("finish_t - start_t > 18000"), part("NOT has_file"))


_FITS = "lambda k: strlen(right(log, k)) <= 30000"
_TAIL = f"""(SELECT tag, log FROM fx_log WHERE strlen(log) <= 30000 UNION ALL SELECT tag, right(log, list_max(list_filter(range(k, k + 151), {_FITS}))) AS log
  FROM (SELECT tag, log, list_max(list_filter(range(0, 30001, 150), {_FITS})) AS k FROM fx_log WHERE strlen(log) > 30000))"""


@query(f"""SELECT tag, CASE WHEN regexp_matches(log, 'password|token') THEN 'secret' WHEN regexp_matches(log, 'Licen[sc]ed') THEN 'license'
    WHEN regexp_matches(log, '[0-9]{{3}}') THEN 'number' ELSE 'unknown' END AS class FROM {_TAIL}""", log="log")
def q29_classify_logs(log):
    return Q.classify_logs(log, {"secret": "password|token", "license": "Licen[sc]ed", "number": "[0-9]{3}"})


@query(
    """SELECT job_id, name, state FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY CASE state WHEN 'running' THEN 0 ELSE 1 END, CASE state WHEN 'running' THEN left_s END, submit_t, job_id) AS k
    FROM (SELECT file_id AS job_id, acq_id AS name, CASE WHEN online THEN 'running' ELSE 'queued' END AS state, finish_t-start_t AS left_s, start_t AS submit_t FROM fx_file)) WHERE k > 1""",
    file="file",
)
def q31_duplicate_jobs(file):
    state = F.when(col("online"), "running").otherwise("queued")
    jobs = file.select(col("file_id").alias("job_id"), col("acq_id").alias("name"), state.alias("state"), (col("finish_t") - col("start_t")).alias("left_s"), col("start_t").alias("submit_t"))
    return Q.duplicate_jobs(jobs).select("job_id", "name", "state")


_PARTS = """(SELECT lsd, quarter, CAST((row_number() OVER (PARTITION BY quarter ORDER BY lsd) - 1) % 2 AS INTEGER) AS part, count(*) OVER (PARTITION BY quarter) AS n
 FROM (SELECT lsd, lsd//90 AS quarter FROM fx_opinion GROUP BY lsd HAVING bool_or(decision='good') AND NOT bool_or(decision='bad')))"""


@query(f"SELECT lsd, quarter, part FROM {_PARTS} WHERE n >= 10", opinion="opinion")
def q32_quarter_partitions(opinion):
    return Q.quarter_partitions(opinion, F.floor(col("lsd") / 90), 2, 5)


@query(
    f"""SELECT stack, count(*) AS n_days, min(lsd) AS first, max(lsd) AS last FROM (SELECT lsd, unnest(['all', 'part' || part, 'part' || part || '_' || (lsd//365)]) AS stack
    FROM {_PARTS} WHERE n >= 10) GROUP BY stack""",
    opinion="opinion",
)
def q33_fullstack_groups(opinion):
    return Q.fullstack_groups(Q.quarter_partitions(opinion, F.floor(col("lsd") / 90), 2, 5), F.floor(col("lsd") / 365))


# --- masks ---------------------------------------------------------------------------------------------------


@query(f"SELECT sample_id, {R('CASE WHEN ok THEN re ELSE 0 END')} AS re, {R('CASE WHEN ok THEN im ELSE 0 END')} AS im, CASE WHEN ok THEN w ELSE 0.0e0 END AS w FROM (SELECT *, sample_id%50<>0 AS ok FROM fx_vis)", vis="vis")
def d1_nan_to_num(vis):
    broken = F.when(col("sample_id") % 50 == 0, F.lit(float("nan"))).otherwise(col("re"))
    return rounded(D.nan_to_num(vis.withColumn("re", broken)).select("sample_id", "re", "im", "w"))


@query("SELECT lsd, count(*) AS n FROM fx_vis WHERE lsd NOT IN (SELECT lsd FROM fx_opinion WHERE decision='bad') GROUP BY lsd", vis="vis", opinion="opinion")
def d4_day_flag(vis, opinion):
    bad = opinion.where("decision = 'bad'").select("lsd")
    return D.drop_bad_days(vis, bad).groupBy("lsd").agg(F.count("*").alias("n"))


@query(
    """SELECT v.lsd, v.freq_id, v.stack_id, v.ra_id, CASE WHEN v.freq_id%16 = 3 OR coalesce(a.m, 0) = 0 THEN 0.0e0 ELSE w END AS w FROM fx_day v
    LEFT JOIN (SELECT freq_id, t, max(CASE WHEN re > 30 THEN 1 ELSE 0 END) AS m FROM fx_day WHERE stack_id=0 GROUP BY freq_id, t) a ON a.freq_id = v.freq_id AND a.t = v.t""",
    day="day",
)
def d6_flag_nodes(day):
    return D.flag_nodes(day.withColumn("re", col("re") - 30), [3], col("stack_id") == 0).select(*CELL, "w")


@query(f"SELECT {', '.join(CELL)}, w FROM ({_FLAGGED})", day="day", flags="flag_day")
def d16_apply_data_flags(day, flags):
    return D.apply_data_flags(day, flags, ["rain1mm", "acjump"], 86400.0).select(*CELL, "w")


_RA_S = "(ra-90 - 360*floor((ra-90)/360))"
_RA_M = f"(CASE WHEN {_RA_S} > 120 AND {_RA_S} <= 180 THEN 0.5e0*(1+cos(pi()*({_RA_S}-180)/60)) WHEN {_RA_S} < 60 THEN 0.5e0*(1+cos(pi()*{_RA_S}/60)) WHEN {_RA_S} > 180 THEN 1 ELSE 0 END)"


@query(
    f"""SELECT {', '.join(CELL)}, {R(f'(re-coalesce(m,0))*{_RA_M}')} AS re, {R(f'w*{_RA_M}*{_RA_M}')} AS w FROM fx_day
    LEFT JOIN (SELECT lsd, freq_id, stack_id, quantile_cont(re, 0.5) AS m FROM fx_day WHERE {_RA_S} > 180 GROUP BY ALL) USING (lsd, freq_id, stack_id)""",
    day="day",
)
def d10_mask_ra(day):
    return rounded(D.mask_ra(day, ["lsd", "freq_id", "stack_id"]).select(*CELL, "re", "w"))


_RAIN = """(SELECT t, sum(rain) OVER (ORDER BY t, event_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS total FROM fx_weather)"""


@query(
    f"""SELECT v.sample_id, CASE WHEN coalesce(r.total, (SELECT arg_max(total, t) FROM {_RAIN})) + 1e-7 >= 30.0e0 THEN 0.0e0 ELSE v.w END AS w
    FROM fx_vis v ASOF LEFT JOIN {_RAIN} r ON v.t <= r.t""",
    vis="vis", weather="weather",
)
def d21_flag_rainfall(vis, weather):
    readings = weather.select(col("event_id").alias("reading_id"), "t", "rain")
    return D.flag_rainfall(vis, readings, 30, 30.0 - 1e-7, 86400.0).select("sample_id", "w")


@query("SELECT prod_id, NOT (xind = 0 OR pol <> 'XX') AS good FROM fx_baseline", baseline="baseline")
def d12_mask_products(baseline):
    return baseline.select("prod_id", (~((col("xind") == 0) | (col("pol") != "XX"))).alias("good"))


@query(
    f"""SELECT l_orderkey, l_linenumber, t, count(*) AS n, {R('sum(w)')} AS w FROM (SELECT *, 800 - 400*(freq_id*16)/1024.0e0 + 5 AS f FROM fx_cell)
    WHERE NOT (abs(f - 10*floor(f/10) - 5) <= 2 OR freq_id*16 IN (48)) GROUP BY ALL""",
    cell="cell",
)
def d13_mask_channels(cell):
    out = D.mask_channels(cell.withColumn("freq_id", col("freq_id") * 16), 4.0, [48]).where("w > 0")
    return rounded(out.groupBy("l_orderkey", "l_linenumber", "t").agg(F.count("*").alias("n"), F.sum("w").alias("w")))


_FORCE = """SELECT c.*, (SELECT max(update_t) FROM fx_gain g WHERE g.input_id=c.input_id AND g.freq_id=c.freq_id AND g.update_t <= c.t) AS at FROM fx_cell c"""
CKEY = ["l_orderkey", "l_linenumber", "t", "input_id", "freq_id"]
_CKEY = ", ".join(f"c.{x}" for x in CKEY)
_ASOF = "FROM fx_cell c ASOF LEFT JOIN fx_gain g ON c.input_id=g.input_id AND c.freq_id=g.freq_id AND c.t >= g.update_t"


@query(f"SELECT {_CKEY}, {R('c.w*coalesce(g.w, 0)')} AS w {_ASOF}", cell="cell", gain="gain")
def d17_apply_input_flags(cell, gain):
    return rounded(D.apply_input_flags(cell, gain.withColumn("flag", col("w")), ["input_id", "freq_id"]).select(*CKEY, "w"))


@query("SELECT freq_id, lsd, ra_id, stack_id, CASE WHEN sum(CASE WHEN w=0 THEN 1 ELSE 0 END) OVER (PARTITION BY freq_id, lsd, ra_id) > 2 THEN 0.0e0 ELSE w END AS w FROM fx_day", day="day")
def d18_mask_many_bad_inputs(day):
    return D.mask_many_bad_inputs(day, ["freq_id", "lsd", "ra_id"], 2).select(*CELL, "w")


@query("SELECT sample_id, frac_lost > 0.02e0 AS bad FROM fx_vis", vis="vis")
def d19_mask_high_frac_lost(vis):
    return vis.select("sample_id", (col("frac_lost") > 0.02).alias("bad"))


@query("SELECT sample_id, freq_id, max(bad) OVER (PARTITION BY freq_id ORDER BY t, sample_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS bad FROM (SELECT *, w=0 AS bad FROM fx_vis)", vis="vis")
def d20_expand_mask(vis):
    order = vis.select("sample_id", "freq_id", F.struct("t", "sample_id").alias("at"), (col("w") == 0).alias("bad"))
    return D.expand_mask(order, ["freq_id"], "at", 2).select("sample_id", "freq_id", "bad")


@query(
    """SELECT lsd, freq_id, stack_id, ra_id, CASE WHEN i < first + 2 OR i > last - 2 THEN 0.0e0 ELSE w END AS w FROM (SELECT *, min(CASE WHEN w>0 THEN i END) OVER p AS first,
    max(CASE WHEN w>0 THEN i END) OVER p AS last FROM (SELECT *, row_number() OVER (PARTITION BY lsd, freq_id, stack_id ORDER BY ra_id) AS i FROM fx_day) WINDOW p AS (PARTITION BY lsd, freq_id, stack_id))""",
    day="day",
)
def d22_flag_edges(day):
    return D.flag_edges(day, ["lsd", "freq_id", "stack_id"], "ra_id", 2, 2).select(*CELL, "w")


@query("SELECT freq_id, ra_id, el_id, CASE WHEN abs(el) >= 299.792458e0/((600-10*freq_id)*0.3e0) - 1 THEN 0.0e0 ELSE w END AS w FROM fx_map", map="map")
def d23_mask_aliased(map):
    return D.mask_aliased(map, 600 - 10 * col("freq_id"), 0.3).select("freq_id", "ra_id", "el_id", "w")


@query(
    """SELECT m.freq_id, m.ra_id, m.el_id, CASE WHEN EXISTS (SELECT 1 FROM (SELECT ra, dec/90-0.5e0 AS el FROM fx_catalog) s,
      range(-4, 190) r(k), range(-5, 15) e(j) WHERE k BETWEEN floor((s.ra-3)/2) AND ceil((s.ra+3)/2) AND j BETWEEN floor((s.el-0.1e0+0.9e0)/0.2e0) AND ceil((s.el+0.1e0+0.9e0)/0.2e0)
      AND (k+180)%180 = m.ra_id AND j = m.el_id) THEN 0.0e0 ELSE w END AS w FROM fx_map m""",
    map="map", catalog="catalog",
)
def d24_mask_from_catalog(map, catalog):
    sources = catalog.select("ra", (col("dec") / 90 - 0.5).alias("el"))
    return D.mask_sources(map, sources, 2.0, 0.2, -0.9, 3.0, 0.1, 180).select("freq_id", "ra_id", "el_id", "w")


_ABS2 = "(re*re+im*im)"


@query(f"SELECT update_t, input_id, freq_id, {R(f'CASE WHEN {_ABS2}=0 THEN 0 ELSE re/{_ABS2} END')} AS re, {R(f'CASE WHEN {_ABS2}=0 THEN 0 ELSE -im/{_ABS2} END')} AS im, {R(f'w*{_ABS2}*{_ABS2}')} AS w FROM fx_gain", gain="gain")
def d36_invert_gain(gain):
    return rounded(D.invert_gain(gain.drop("update_kind")))


@query(
    f"""SELECT s.freq_id, s.beam, s.t_id, s.subfreq, {R('s.x*(' + INV.format('m.x') + ')')} AS x, {R('s.w*m.x*m.x')} AS w FROM fx_spec s
    JOIN (SELECT freq_id, subfreq, CASE WHEN sum(w)=0 THEN 0 ELSE sum(w*x)/sum(w) END AS x FROM fx_spec GROUP BY freq_id, subfreq) m USING (freq_id, subfreq)""",
    spec="spec",
)
def d41_divide_by_template(spec):
    template = A.average(spec, ["freq_id", "subfreq"])
    return rounded(D.divide_by_template(spec, template, ["freq_id", "subfreq"]).select("freq_id", "beam", "t_id", "subfreq", "x", "w"))


@query(f"SELECT beam, t_id, freq_id*64+subfreq AS freq_id, {R('800-400*(freq_id+(subfreq-31.5e0)/64)/1024')} AS mhz, {R('x')} AS x FROM fx_spec", spec="spec")
def d43_high_resolution_frequency(spec):
    mhz = X.channel_mhz(col("freq_id") + (col("subfreq") - 31.5) / 64)
    return rounded(spec.select("beam", "t_id", (col("freq_id") * 64 + col("subfreq")).alias("freq_id"), mhz.alias("mhz"), "x"))


# --- joins ---------------------------------------------------------------------------------------------------


@query(f"SELECT {_CKEY}, g.update_t AS update_t, {R('g.re')} AS g_re, {R('c.re*g.re-c.im*g.im')} AS re {_ASOF}", cell="cell", gain="gain")
def j2_asof_backward(cell, gain):
    found = asof_join(cell, gain, ["input_id", "freq_id"], "t", "update_t", {"update_t": "update_t", "g_re": "re", "g_im": "im"})
    return rounded(found.select(*CKEY, "update_t", "g_re", (col("re") * col("g_re") - col("im") * col("g_im")).alias("re")))


@query(f"SELECT {_CKEY}, g.update_t AS update_t FROM fx_cell c ASOF LEFT JOIN fx_gain g ON c.input_id=g.input_id AND c.freq_id=g.freq_id AND c.t <= g.update_t", cell="cell", gain="gain")
def j3_asof_forward(cell, gain):
    return asof_join(cell, gain, ["input_id", "freq_id"], "t", "update_t", {"update_t": "update_t"}, "forward").select(*CKEY, "update_t")


@query(
    f"""WITH c AS (SELECT {', '.join(CKEY)} FROM fx_cell),
    b AS (SELECT c.*, g.update_t AS b FROM c ASOF LEFT JOIN fx_gain g ON c.input_id=g.input_id AND c.freq_id=g.freq_id AND c.t >= g.update_t),
    f AS (SELECT b.*, g.update_t AS a FROM b ASOF LEFT JOIN fx_gain g ON b.input_id=g.input_id AND b.freq_id=g.freq_id AND b.t <= g.update_t)
    SELECT {', '.join(CKEY)}, CASE WHEN b IS NOT NULL AND (a IS NULL OR t-b <= a-t) THEN b ELSE a END AS update_t FROM f""",
    cell="cell", gain="gain",
)
def j4_nearest(cell, gain):
    return asof_join(cell, gain, ["input_id", "freq_id"], "t", "update_t", {"update_t": "update_t"}, "nearest").select(*CKEY, "update_t")


@query("SELECT v.sample_id, f.flag_id FROM fx_vis v JOIN fx_flag_vis f ON v.t >= f.start_t AND v.t <= f.finish_t AND (f.freq_id IS NULL OR f.freq_id = v.freq_id)", vis="vis", flags="flag_vis")
def j5_interval_contains(vis, flags):
    flags = flags.select("flag_id", "start_t", "finish_t", col("freq_id").alias("_f"))
    samples = vis.select("sample_id", "freq_id", "t")
    return interval_pairs(samples, flags, "t", "start_t", "finish_t", 3600.0, ("freq_id",), col("_f").isNull() | (col("_f") == col("freq_id"))).select("sample_id", "flag_id")


@query("SELECT f.file_id, g.flag_id FROM fx_file f JOIN fx_flag_day g ON f.start_t < g.finish_t AND f.finish_t >= g.start_t", file="file", flags="flag_day")
def j6_interval_overlaps(file, flags):
    other = flags.select("flag_id", col("start_t").alias("a"), col("finish_t").alias("b"))
    return overlap_join(file.select("file_id", "start_t", "finish_t"), other, "start_t", "finish_t", "a", "b", 28800.0).select("file_id", "flag_id")


# --- aggregations --------------------------------------------------------------------------------------------


@query(
    f"SELECT freq_id, beam, subfreq, {R('CASE WHEN sum(w)=0 THEN 0 ELSE sum(w*x)/sum(w) END')} AS x, {R('sum(w)')} AS w FROM fx_spec GROUP BY freq_id, beam, subfreq",
    spec="spec",
)
def a1_average_inverse_variance(spec):
    return rounded(A.average(spec, ["freq_id", "beam", "subfreq"]))


@query(
    f"""SELECT freq_id, beam, {R('coalesce(avg(x) FILTER (w>0), 0)')} AS x, {R('CASE WHEN sum(v)=0 THEN 0 ELSE n*n/sum(v) END')} AS w FROM (SELECT *, {INV.format('w')} AS v,
    sum(CASE WHEN w>0 THEN 1.0e0 ELSE 0.0e0 END) OVER (PARTITION BY freq_id, beam) AS n FROM fx_spec) GROUP BY freq_id, beam, n""",
    spec="spec",
)
def a1_average_uniform(spec):
    return rounded(A.average(spec, ["freq_id", "beam"], "uniform"))


@query(
    f"""SELECT lsd, freq_id, stack_id, {R('avg(re) FILTER (ra_id<=11 AND w>0)')} AS re, {R('avg(im) FILTER (ra_id<=11 AND w>0)')} AS im, count(*) FILTER (ra_id<=11 AND w>0) AS n FROM fx_day
    GROUP BY lsd, freq_id, stack_id HAVING avg(CASE WHEN w>0 THEN 1.0e0 ELSE 0.0e0 END) FILTER (ra_id<=11) > 0.3e0""",
    day="day",
)
def a2_sidereal_mean(day):
    return rounded(A.sidereal_mean(day, ["lsd", "freq_id", "stack_id"], col("ra_id") <= 11, False, 0.3))


@query(
    f"""SELECT lsd, freq_id, stack_id, {R('quantile_cont(re, 0.5) FILTER (ra_id<=11 AND w>0)')} AS re, {R('quantile_cont(im, 0.5) FILTER (ra_id<=11 AND w>0)')} AS im,
    count(*) FILTER (ra_id<=11 AND w>0) AS n FROM fx_day GROUP BY lsd, freq_id, stack_id HAVING avg(CASE WHEN w>0 THEN 1.0e0 ELSE 0.0e0 END) FILTER (ra_id<=11) > 0.3e0""",
    day="day",
)
def a3_sidereal_median(day):
    return rounded(A.sidereal_mean(day, ["lsd", "freq_id", "stack_id"], col("ra_id") <= 11, True, 0.3))


_STACK = f"""{R('CASE WHEN sum(w)=0 THEN 0 ELSE sum(w*re)/sum(w) END')} AS re, {R('CASE WHEN sum(w)=0 THEN 0 ELSE sum(w*im)/sum(w) END')} AS im, {R('sum(w)')} AS w,
 count(*) FILTER (w>0) AS nsample, count(DISTINCT lsd) FILTER (w>0) AS n_days"""


@query(f"SELECT freq_id, stack_id, ra_id, {_STACK} FROM fx_day GROUP BY freq_id, stack_id, ra_id", day="day")
def a6_stack_days(day):
    return rounded(A.stack_days(day, ["freq_id", "stack_id", "ra_id"]))


@query(
    f"""WITH m AS ({_FLAGGED}), med AS (SELECT lsd, freq_id, stack_id, quantile_cont(re, 0.5) FILTER (ra_id<=11 AND w>0) AS mr, quantile_cont(im, 0.5) FILTER (ra_id<=11 AND w>0) AS mi
      FROM m GROUP BY lsd, freq_id, stack_id HAVING avg(CASE WHEN w>0 THEN 1.0e0 ELSE 0.0e0 END) FILTER (ra_id<=11) > 0.3e0),
    s AS (SELECT m.lsd, m.freq_id, m.stack_id, m.ra_id, m.re-coalesce(mr,0) AS re, m.im-coalesce(mi,0) AS im, CASE WHEN mr IS NULL THEN 0.0e0 ELSE m.w END AS w
      FROM m LEFT JOIN med ON m.lsd=med.lsd AND m.freq_id=med.freq_id AND m.stack_id=med.stack_id)
    SELECT freq_id, stack_id, ra_id, {_STACK} FROM s GROUP BY freq_id, stack_id, ra_id""",
    day="day", flags="flag_day",
)
def quarter_stack(day, flags):
    return rounded(_quarter_stack(day, flags, ["rain1mm", "acjump"], 11))


@query(
    f"""SELECT freq_id, stack_id, ra_id, {R('a/c')} AS re, {R('b/c')} AS im, {R('c*c/v')} AS w, {R('rr/c-(a/c)*(a/c)')} AS var_re, {R('ii/c-(b/c)*(b/c)')} AS var_im, {R('ri/c-(a/c)*(b/c)')} AS cov, nsample
    FROM (SELECT freq_id, stack_id, ra_id, sum(w) AS c, sum(w*re) AS a, sum(w*im) AS b, sum(w) AS v, sum(w*re*re) AS rr, sum(w*im*im) AS ii, sum(w*re*im) AS ri, count(*) AS nsample
      FROM fx_day WHERE w > 0 GROUP BY freq_id, stack_id, ra_id)""",
    day="day",
)
def a7_stack_transits(day):
    return rounded(A.stack_transits(day.where("w > 0"), ["freq_id", "stack_id", "ra_id"]))


_GOOD = "(SELECT stack_id AS input_id, lsd, bool_and((lsd*7+stack_id*3+freq_id)%41<>0) AS good FROM fx_day GROUP BY stack_id, lsd)"


@query(
    f"""WITH g AS {_GOOD}, n AS (SELECT *, count(*) FILTER (NOT good) OVER (PARTITION BY input_id) AS n FROM g),
    d AS (SELECT lsd FROM n GROUP BY lsd HAVING count(*) FILTER (NOT good AND n = 1) <= 1) SELECT input_id, bool_and(good) AS good FROM g WHERE lsd IN (SELECT lsd FROM d) GROUP BY input_id""",
    day="day",
)
def a8_consensus_mask(day):
    ok = (col("lsd") * 7 + col("stack_id") * 3 + col("freq_id")) % 41 != 0
    good = day.groupBy(col("stack_id").alias("input_id"), "lsd").agg(F.min(ok).alias("good"))
    return A.consensus_mask(good, 1)


@query(f"SELECT update_t, freq_id, {R('quantile_cont(re, 0.5) FILTER (w>0)')} AS re, {R('quantile_cont(im, 0.5) FILTER (w>0)')} AS im, max(CASE WHEN w>0 THEN 1.0e0 ELSE 0.0e0 END) AS w FROM fx_gain GROUP BY update_t, freq_id", gain="gain")
def a11_common_mode(gain):
    return rounded(A.common_mode(gain, ["update_t", "freq_id"]))


@query(
    f"""SELECT a.lsd, a.freq_id, a.ra_id, {R('avg(a.re*b.re+a.im*b.im)')} AS re, {R('avg(a.im*b.re-a.re*b.im)')} AS im, count(DISTINCT a.stack_id) AS n FROM fx_day a
    JOIN fx_day b ON a.lsd=b.lsd AND a.freq_id=b.freq_id AND a.ra_id=b.ra_id AND a.stack_id<=b.stack_id GROUP BY a.lsd, a.freq_id, a.ra_id""",
    day="day",
)
def a12_pair_mean(day):
    return rounded(A.pair_mean(day, ["lsd", "freq_id", "ra_id"], "stack_id"))


@query("SELECT freq_id, beam, t_id, " + " + ".join(f"CAST(least(count(*) FILTER (x > 1+0.1e0*{s}), 255) AS BIGINT)*{1 << 8 * k}" for k, s in enumerate((1, 2, 3, 4))) + " AS bitmap FROM fx_spec GROUP BY freq_id, beam, t_id", spec="spec")
def a19_rfi_counts(spec):
    return A.rfi_counts(spec, ["freq_id", "beam", "t_id"], [1, 2, 3, 4], 0.1)


@query("SELECT freq_id, beam, t_id, CAST(count(*) FILTER (x > 1.2e0) AS BIGINT) AS n, count(*) FILTER (x > 1.2e0) >= 2 AS bad FROM fx_spec GROUP BY freq_id, beam, t_id", spec="spec")
def a20_rfi_bitmap_mask(spec):
    n = A.bitmap_count(col("bitmap"), 1)
    return A.rfi_counts(spec, ["freq_id", "beam", "t_id"], [1, 2, 3, 4], 0.1).select("freq_id", "beam", "t_id", n.alias("n"), (n >= 2).alias("bad"))


@query(f"SELECT freq_id, beam, t_id, subfreq, {R('x - coalesce(quantile_cont(CASE WHEN w>0 THEN x END, 0.5) OVER (PARTITION BY freq_id, t_id, subfreq), 0)')} AS x FROM fx_spec", spec="spec")
def a21_median_subtract(spec):
    return rounded(A.median_subtract(spec, ["freq_id", "t_id", "subfreq"]).select("freq_id", "beam", "t_id", "subfreq", "x"))


@query(
    f"""SELECT freq_id, CAST(i//4 AS BIGINT) AS fold, {R('avg(re) FILTER (i%4=1) - avg(re) FILTER (i%4<>1)')} AS re, {R('avg(im) FILTER (i%4=1) - avg(im) FILTER (i%4<>1)')} AS im
    FROM (SELECT *, row_number() OVER (PARTITION BY freq_id ORDER BY t, sample_id) - 1 AS i FROM fx_vis) GROUP BY freq_id, i//4""",
    vis="vis",
)
def a26_fold(vis):
    return rounded(A.fold(vis.withColumn("at", F.struct("t", "sample_id")), ["freq_id"], "at", 4, 1))


# --- windows -------------------------------------------------------------------------------------------------

_SIDES = " OR ".join(f"(b.ra_id - a.ra_id + 360) % 180 BETWEEN {x} AND {y}" for x, y in ((3, 6), (174, 177)))


@query(
    f"""SELECT freq_id, el_id, ra_id, {R('CASE WHEN w>0 AND ow>0 THEN val - owx/ow ELSE 0 END')} AS val, {R('CASE WHEN w>0 AND ow>0 THEN 1/(1/w+1/ow) ELSE 0 END')} AS w FROM
    (SELECT a.freq_id, a.el_id, a.ra_id, a.val, a.w, coalesce(sum(b.w),0) AS ow, coalesce(sum(b.w*b.val),0) AS owx FROM fx_map a LEFT JOIN fx_map b ON a.freq_id=b.freq_id AND a.el_id=b.el_id AND ({_SIDES}) GROUP BY ALL)""",
    map="map",
)
def w1_on_off(map):
    return rounded(W.on_off(map, ["freq_id", "el_id"], "ra_id", 180, 2, 4, "val").select("freq_id", "el_id", "ra_id", "val", "w"))


@query(
    f"""SELECT a.freq_id, a.el_id, a.ra_id, {R('a.val - (b.val + c.val)/2')} AS diff FROM fx_map a LEFT JOIN fx_map b ON a.freq_id=b.freq_id AND a.el_id=b.el_id AND b.ra_id = (a.ra_id+177)%180
    LEFT JOIN fx_map c ON a.freq_id=c.freq_id AND a.el_id=c.el_id AND c.ra_id = (a.ra_id+3)%180""",
    map="map",
)
def w2_circular_difference(map):
    return rounded(W.circular_difference(map, ["freq_id", "el_id"], "ra_id", 180, 3, "val").select("freq_id", "el_id", "ra_id", "diff"))


@query("SELECT event_id, round(sum(rain) OVER (ORDER BY t, event_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) + 3.7e-9, 6) AS total FROM fx_weather", weather="weather")
def w4_cumulative_rain(weather):
    return rounded(W.trailing_sum(weather, "t", "event_id", "rain", 30, 86400.0).select("event_id", "total"))


@query(
    """SELECT input_id, CAST(island AS BIGINT) AS island, count(*) AS n, min(t)-3600 AS start_t, max(t)+3600 AS finish_t FROM (SELECT *, sum(CASE WHEN p IS NULL OR t-p > 7200 THEN 1 ELSE 0 END)
    OVER (PARTITION BY input_id ORDER BY t, sample_id ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT *, lag(t) OVER (PARTITION BY input_id ORDER BY t, sample_id) AS p FROM fx_vis)) GROUP BY input_id, island""",
    vis="vis",
)
def w5_contiguous_ranges(vis):
    rows = W.islands(vis, ["input_id"], "t", 7200.0)
    return rows.groupBy("input_id", "island").agg(F.count("*").alias("n"), (F.min("t") - 3600).alias("start_t"), (F.max("t") + 3600).alias("finish_t"))


@query(
    f"""WITH c AS (SELECT freq_id, stack_id, re, w, sum(w) OVER (PARTITION BY freq_id, stack_id ORDER BY re, w ROWS UNBOUNDED PRECEDING) AS cum, sum(w) OVER (PARTITION BY freq_id, stack_id) AS total,
      lead(re) OVER (PARTITION BY freq_id, stack_id ORDER BY re, w) AS nx FROM fx_day WHERE w > 0)
    SELECT freq_id, stack_id, {R('arg_min(CASE WHEN cum*2=total THEN (re+nx)/2 ELSE re END, cum)')} AS median FROM c WHERE cum*2 >= total GROUP BY freq_id, stack_id""",
    day="day",
)
def w8_weighted_median(day):
    return rounded(W.weighted_median(day, ["freq_id", "stack_id"], "re"))


@query(
    f"""WITH g AS (SELECT freq_id, el_id, unnest(range(0, 45)) AS k FROM (SELECT DISTINCT freq_id, el_id FROM fx_map)), x AS (SELECT *, 8.0e0*k+1 AS ra FROM g),
    b AS (SELECT x.*, m.ra AS lx, m.val AS ly, m.w AS lw FROM x ASOF LEFT JOIN fx_map m ON x.freq_id=m.freq_id AND x.el_id=m.el_id AND x.ra >= m.ra),
    f AS (SELECT b.*, m.ra AS hx, m.val AS hy, m.w AS hw FROM b ASOF LEFT JOIN fx_map m ON b.freq_id=m.freq_id AND b.el_id=m.el_id AND b.ra <= m.ra),
    a AS (SELECT *, CASE WHEN hx=lx THEN 0 ELSE (hx-ra)/(hx-lx) END AS p FROM f)
    SELECT freq_id, el_id, ra, {R('CASE WHEN lw>0 AND hw>0 THEN p*ly+(1-p)*hy ELSE 0 END')} AS val, {R('CASE WHEN lw>0 AND hw>0 THEN 1/(p*p/lw+(1-p)*(1-p)/hw) ELSE 0 END')} AS w FROM a""",
    map="map",
)
def w9_interpolate(map):
    grid = map.select("freq_id", "el_id").distinct().select("freq_id", "el_id", F.explode(F.sequence(F.lit(0), F.lit(44))).alias("k"))
    grid = grid.select("freq_id", "el_id", (8.0 * col("k") + 1).alias("ra"))
    return rounded(W.interpolate(grid, map, ["freq_id", "el_id"], "ra", "val"))


@query(
    """SELECT sample_id, abs(re-m) > 3*1.4826e0*quantile_cont(abs(re-m), 0.5) OVER (PARTITION BY freq_id, lsd) AS bad FROM (SELECT *, quantile_cont(re, 0.5) OVER (PARTITION BY freq_id, lsd) AS m FROM fx_vis)""",
    vis="vis",
)
def w3_block_outliers(vis):
    return W.block_outliers(vis, {"_f": col("freq_id"), "_d": col("lsd")}, 3.0, "re").select("sample_id", "bad")


@query(
    """SELECT sample_id, r > 3*1.4826e0*quantile_cont(r, 0.5) OVER v AS bad FROM (SELECT *, abs(re - quantile_cont(re, 0.5) OVER u) AS r FROM fx_vis
    WINDOW u AS (PARTITION BY freq_id, lsd ORDER BY t, sample_id ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)) WINDOW v AS (PARTITION BY freq_id, lsd ORDER BY t, sample_id ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)""",
    vis="vis",
)
def w19_rolling_outliers(vis):
    return W.rolling_outliers(vis.withColumn("at", F.struct("t", "sample_id")), ["freq_id", "lsd"], "at", 5, 3.0, "re").select("sample_id", "bad")


# --- top-k, sets, scalars ------------------------------------------------------------------------------------


@query(f"SELECT source_id, {R('flux')} AS flux FROM fx_catalog ORDER BY flux DESC, source_id LIMIT 20", catalog="catalog")
def k2_brightest_sources(catalog):
    return rounded(catalog.orderBy(col("flux").desc(), "source_id").limit(20).select("source_id", "flux"))


@query("SELECT freq_id, sample_id FROM (SELECT *, row_number() OVER (PARTITION BY freq_id, lsd ORDER BY abs(re) DESC, sample_id) AS k FROM fx_vis) WHERE k <= 3", vis="vis")
def k3_largest_outliers(vis):
    order = Window.partitionBy("freq_id", "lsd").orderBy(F.abs("re").desc(), "sample_id")
    return vis.withColumn("_k", F.row_number().over(order)).where("_k <= 3").select("freq_id", "sample_id")


@query("SELECT DISTINCT acq_id FROM fx_file WHERE acqtype='corr' AND online INTERSECT SELECT acq_id FROM fx_file WHERE acqtype='weather'", file="file")
def u2_intersect(file):
    return file.where("acqtype = 'corr' AND online").select("acq_id").intersect(file.where("acqtype = 'weather'").select("acq_id"))


@query("SELECT file_id FROM fx_file WHERE has_file EXCEPT SELECT file_id FROM fx_file WHERE online", file="file")
def u3_except(file):
    return file.where("has_file").select("file_id").subtract(file.where("online").select("file_id"))


@query(
    f"""SELECT a.freq_id, a.stack_id, a.ra_id, a.lsd, {R('a.re-b.re')} AS re, {R('CASE WHEN a.w=0 OR b.w=0 THEN ' + INV.format('(CASE WHEN a.w=0 THEN 0 ELSE 1/a.w END)+(CASE WHEN b.w=0 THEN 0 ELSE 1/b.w END)') + ' ELSE 1/(1/a.w+1/b.w) END')} AS w
    FROM fx_day a JOIN fx_day b ON a.lsd+1=b.lsd AND a.freq_id=b.freq_id AND a.stack_id=b.stack_id AND a.ra_id=b.ra_id""",
    day="day",
)
def u4_difference(day):
    other = day.select((col("lsd") - 1).alias("lsd"), "freq_id", "stack_id", "ra_id", col("re").alias("re2"), col("w").alias("w2"))
    joined = day.join(other, CELL)
    w = X.inv0(X.inv0(col("w")) + X.inv0(col("w2")))
    return rounded(joined.select("freq_id", "stack_id", "ra_id", "lsd", (col("re") - col("re2")).alias("re"), w.alias("w")))


@query(
    f"""SELECT sample_id, {R('re*cos(ra)-im*sin(ra)')} AS rot_re, {R('sqrt(re*re+im*im)')} AS amp, {R('(ra+180)-360*floor((ra+180)/360)-180')} AS wrapped,
    {R(f'{LSA}-360*floor({LSA}/360)', 4)} AS lsa, {R('(t-1704067200)/86164.0989e0')} AS lsd_f, {R('800-400*freq_id/1024.0e0')} AS mhz, {R('299.792458e0/(800-400*freq_id/1024.0e0)')} AS lambda FROM fx_vis""",
    vis="vis",
)
def x1_scalar_functions(vis):
    v = (col("re"), col("im"))
    rot = X.cmul(v, X.cis(col("ra")))
    mhz = X.channel_mhz(col("freq_id"))
    out = vis.select(
        "sample_id", rot[0].alias("rot_re"), F.sqrt(X.abs2(v)).alias("amp"), X.wrap(col("ra")).alias("wrapped"), X.stellar_angle(col("t"), -119.6).alias("lsa"),
        X.sidereal_day(col("t"), 1704067200.0).alias("lsd_f"), mhz.alias("mhz"), X.wavelength(mhz).alias("lambda"),
    )
    return rounded(out, lsa=4)


@query(f"SELECT source_id, {R('1420.40575e0/(1+z)')} AS mhz, {R('14.87857614e0/(1420.40575e0/(1+z))/cos(radians(dec))')} AS sigma, CAST(round((800-1420.40575e0/(1+z))/400*1024) AS BIGINT) AS channel FROM fx_catalog", catalog="catalog")
def x9_redshift_and_beam(catalog):
    mhz = X.redshifted(col("z"))
    return rounded(catalog.select("source_id", mhz.alias("mhz"), X.beam_sigma(mhz, col("dec"), F.lit("X")).alias("sigma"), X.channel_of(mhz).alias("channel")))


# --- streams in batch form, fits -----------------------------------------------------------------------------


@query(
    f"""SELECT day, count(*) AS n, min(t) AS first_t, max(t) AS last_t, {R('sum(w)')} AS w FROM (SELECT t, w, unnest(list_distinct([floor(d), floor(d-0.005e0), floor(d+0.005e0)]))::BIGINT AS day
    FROM (SELECT *, (t-1704067200)/86164.0989e0 AS d FROM fx_vis)) GROUP BY day HAVING max(t)-min(t) >= 3600""",
    vis="vis",
)
def t1_day_groups(vis):
    return rounded(T.day_groups(vis, X.sidereal_day(col("t"), 1704067200.0), 0.005, 3600.0))


@query(
    f"""SELECT input_id, count(*) AS n, {R('sum(w)')} AS w, {R('sum(w*re)')} AS wx FROM (SELECT *, sum(CASE WHEN p IS NULL OR t-p >= 7200 THEN 1 ELSE 0 END) OVER (PARTITION BY input_id ORDER BY t, sample_id ROWS UNBOUNDED PRECEDING) AS s
    FROM (SELECT *, lag(t) OVER (PARTITION BY input_id ORDER BY t, sample_id) AS p FROM fx_vis)) GROUP BY input_id, s""",
    vis="vis",
)
def t4_transit_sessions(vis):
    return rounded(T.sessions(vis.withColumn("ts", F.timestamp_micros(F.round(col("t") * 1e6).cast("long"))), ["input_id"], 7200).drop("start"))


@query(
    f"""SELECT freq_id, stack_id, {R('(s2*t0-s1*t1)/(s0*s2-s1*s1)', 4)} AS "offset", {R('(s0*t1-s1*t0)/(s0*s2-s1*s1)', 4)} AS slope, n-2 AS ndof FROM (SELECT freq_id, stack_id, sum(w) AS s0, sum(w*ra_id) AS s1,
    sum(w*ra_id*ra_id) AS s2, sum(w*re) AS t0, sum(w*ra_id*re) AS t1, count(*) FILTER (w>0) AS n FROM fx_day GROUP BY freq_id, stack_id)""",
    day="day",
)
def m1_line_fit(day):
    return rounded(M.line_fit(day, ["freq_id", "stack_id"], col("ra_id"), col("re"), col("w")).select("freq_id", "stack_id", "offset", "slope", "ndof"), 4)


@query(day="day")
def m1_polynomial_fit(day):
    fit = M.polynomial_fit(day, ["freq_id", "stack_id"], col("ra_id") / 24.0, col("re"), col("w"), 3)
    return rounded(fit.select("freq_id", "stack_id", *(F.get("coeff", k).alias(f"c{k}") for k in range(4))), 4)


@query(
    f"""SELECT freq_id, {R('(g22*h1-g12*h2)/(g11*g22-g12*g12)')} AS amp1, {R('(g11*h2-g12*h1)/(g11*g22-g12*g12)')} AS amp2 FROM (SELECT freq_id, sum(w) AS g11, sum(w*cos(radians(ra))) AS g12, sum(w) AS g22,
    sum(w*re) AS h1, sum(w*(re*cos(radians(ra))+im*sin(radians(ra)))) AS h2 FROM fx_vis GROUP BY freq_id)""",
    vis="vis",
)
def m5_two_sources(vis):
    return rounded(M.two_source_amplitudes(vis, ["freq_id"], (F.lit(1.0), F.lit(0.0)), X.cis(F.radians("ra"))))


@query(
    f"""SELECT source_id, CAST(k AS BIGINT) AS channel, {R('CASE WHEN f >= lo AND f < lo+2 THEN 2-exp(-abs(f-lo)/1.5e0)-exp(-abs(f-lo-2)/1.5e0) ELSE abs(exp(-abs(f-lo)/1.5e0)-exp(-abs(f-lo-2)/1.5e0)) END')} AS share FROM
    (SELECT source_id, k, f, 700+2.0e0*k AS lo FROM (SELECT *, 1420.40575e0/(1+z) AS f FROM fx_catalog) c, range(0, 10) r(k) WHERE k BETWEEN floor((f-6-700)/2) AND floor((f+6-700)/2))""",
    catalog="catalog",
)
def m13_deposit_catalog(catalog):
    return rounded(M.deposit_catalog(catalog, 700.0, 2.0, 10, 1.5, 4.0))
