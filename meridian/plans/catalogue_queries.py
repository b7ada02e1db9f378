"""Queries of file discovery, set operations, small joins, scalar functions and day groups over the fixture relations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from meridian.functions import scalar as X
from meridian.operators import index as Q
from meridian.operators.joins import first_overlap, interval_join
from meridian.plans.queries import CELL
from meridian.plans.registry import R, col, query, rounded

DAY_S = 86400.0
SIDEREAL_S, EPOCH_T = 86164.0989, 1704067200.0
#: Right ascensions (degrees) of the sources whose transits are asked for, and the time round each in seconds.
TRANSITS, ROUND_S = (83.6, 187.7, 299.9, 350.9), 1800.0


# --- discovery -----------------------------------------------------------------------------------------------


def _transit_windows(vis):
    """One window round each listed source's transit on each sidereal day of the samples."""
    at = F.explode(F.array(*(F.lit(x / 360.0) for x in TRANSITS)))
    rows = vis.select("lsd").distinct().select("lsd", at.alias("_p"))
    t = EPOCH_T + SIDEREAL_S * (col("lsd") + col("_p"))
    return rows.select((t - ROUND_S).alias("_start"), (t + ROUND_S).alias("_finish"))


_NEAR = f"""EXISTS (SELECT 1 FROM (SELECT DISTINCT lsd FROM fx_vis) d, (VALUES {', '.join(f'({x!r}::DOUBLE)' for x in TRANSITS)}) s(ra)
 WHERE v.t BETWEEN {EPOCH_T!r}::DOUBLE+{SIDEREAL_S!r}::DOUBLE*(d.lsd+s.ra/360)-1800 AND {EPOCH_T!r}::DOUBLE+{SIDEREAL_S!r}::DOUBLE*(d.lsd+s.ra/360)+1800)"""


@query(f"SELECT v.sample_id FROM fx_vis v WHERE {_NEAR}", vis="vis")
def q6_include_transits(vis):
    return interval_join(vis, _transit_windows(vis), "t", "_start", "_finish", 7200.0, "left_semi").select("sample_id")


@query(f"SELECT v.sample_id FROM fx_vis v WHERE NOT {_NEAR}", vis="vis")
def q7_exclude_transits(vis):
    return interval_join(vis, _transit_windows(vis), "t", "_start", "_finish", 7200.0, "left_anti").select("sample_id")


@query("SELECT file_id FROM fx_file WHERE acqtype = 'corr' AND has_file AND online", file="file")
def q9_only_attributes(file):
    return file.where("acqtype = 'corr' AND has_file AND online").select("file_id")


RANGES = ((820454400.0, 823132800.0), (852076800.0, 854755200.0), (883612800.0, 886291200.0))


@query("SELECT file_id FROM fx_file WHERE acqtype = 'corr' AND (" + " OR ".join(f"(start_t < {b!r} AND finish_t >= {a!r})" for a, b in RANGES) + ")", file="file")
def q11_dataspec_files(file):
    inside = reduce(lambda a, b: a | b, ((col("start_t") < b) & (col("finish_t") >= a) for a, b in RANGES))
    return file.where((col("acqtype") == "corr") & inside).select("file_id")


@query(
    """SELECT flag_id, file_id FROM (SELECT g.flag_id, f.file_id, f.online, row_number() OVER (PARTITION BY g.flag_id ORDER BY f.start_t, f.file_id) AS k
    FROM fx_flag_day g JOIN fx_file f ON f.start_t < g.finish_t AND f.finish_t >= g.start_t WHERE f.acqtype = 'corr') WHERE k = 1 AND NOT online""",
    file="file", flags="flag_day",
)
def q16_filter_processed(file, flags):
    spans = flags.select("flag_id", col("start_t").alias("a"), col("finish_t").alias("b"))
    first = first_overlap(spans, file.where("acqtype = 'corr'"), "a", "b", "start_t", "finish_t", ["file_id", "online"], 86400.0)
    first = first.groupBy("flag_id").agg(F.min("_first").alias("_first"))
    return first.where("NOT _first.online").select("flag_id", "_first.file_id")


@query("SELECT file_id FROM fx_file WHERE start_t < 854755200 AND finish_t >= 852076800", file="file")
def q19_files_in_timespan(file):
    return file.where((col("start_t") < 854755200) & (col("finish_t") >= 852076800)).select("file_id")


_FILE_DAYS = """(SELECT DISTINCT f.file_id, d.day FROM fx_file f JOIN (SELECT DISTINCT CAST(floor(start_t/86400) AS BIGINT) AS day FROM fx_file) d
 ON f.start_t < (d.day+1)*86400 AND f.finish_t >= d.day*86400)"""


def _file_days(file, chosen=None):
    days = file.select(F.floor(col("start_t") / DAY_S).alias("day")).distinct()
    days = days.where(chosen) if chosen is not None else days
    return Q.files_of_days(days.select("day", (col("day") * DAY_S).alias("start"), ((col("day") + 1) * DAY_S).alias("finish")), file, DAY_S)


@query(f"SELECT DISTINCT file_id FROM {_FILE_DAYS} WHERE day % 7 = 3", file="file")
def q22_files_of_days(file):
    return _file_days(file, col("day") % 7 == 3).select("file_id").distinct()


@query(f"SELECT DISTINCT file_id FROM {_FILE_DAYS} WHERE day % 7 = 3 EXCEPT SELECT file_id FROM fx_file WHERE online", file="file")
def q23_files_to_retrieve(file):
    return _file_days(file, col("day") % 7 == 3).select("file_id").subtract(file.where("online").select("file_id"))


@query(f"SELECT file_id FROM {_FILE_DAYS} GROUP BY file_id HAVING bool_and(day % 7 = 3)", file="file")
def q24_files_to_clear(file):
    return _file_days(file).groupBy("file_id").agg(F.min(col("day") % 7 == 3).alias("only")).where("only").select("file_id")


@query("SELECT DISTINCT lsd, max(lsd) OVER () - lsd <= 5 AS recent FROM fx_day", day="day")
def q26_recent_days(day):
    days = day.select("lsd").distinct()
    last = days.agg(F.max("lsd").alias("_last"))  # one row
    return days.join(F.broadcast(last)).select("lsd", (col("_last") - col("lsd") <= 5).alias("recent"))


@query("SELECT lsd FROM fx_opinion WHERE lsd NOT IN (SELECT lsd FROM fx_opinion WHERE decision='bad') AND lsd IN (SELECT file_id FROM fx_file WHERE online) GROUP BY lsd", opinion="opinion", file="file")
def q27_runnable_tags(opinion, file):
    bad = opinion.where("decision = 'bad'").select("lsd")
    there = file.where("online").select(col("file_id").alias("lsd"))
    return opinion.select("lsd").distinct().join(bad, "lsd", "left_anti").join(there, "lsd", "left_semi")


@query(
    """SELECT file_id, retry FROM (SELECT file_id, NOT has_file AS retry, start_t FROM fx_file WHERE NOT online AND start_t < 900000000)
    ORDER BY CASE WHEN retry THEN 0 ELSE 1 END, start_t, file_id LIMIT 50""",
    file="file",
)
def q30_next_jobs(file):
    waiting = file.where("NOT online").select("file_id", (~col("has_file")).alias("retry"), "start_t")
    return Q.next_jobs(waiting, 900086400.0, 50).select("file_id", "retry")


@query("SELECT lsd, CAST(2000+lsd//360 AS BIGINT) AS year, CAST(1+(lsd//90)%4 AS BIGINT) AS quarter, CAST(lsd%2 AS BIGINT) AS part FROM fx_opinion", opinion="opinion")
def q34_parse_tags(opinion):
    year, quarter = 2000 + F.floor(col("lsd") / 360), 1 + F.floor(col("lsd") / 90) % 4
    tag = F.concat(year.cast("string"), F.lit("q"), quarter.cast("string"), F.lit("p"), (col("lsd") % 2).cast("string"))
    tagged = opinion.select("lsd", tag.alias("tag"))
    return tagged.select("lsd", *(F.regexp_extract("tag", r"^(\d{4})q([1-4])p(\d)$", k).cast("long").alias(n) for k, n in ((1, "year"), (2, "quarter"), (3, "part"))))


@query(
    """WITH y AS (SELECT DISTINCT lsd, lsd//10 AS year FROM fx_day), t AS (SELECT DISTINCT year FROM y WHERE year % 2 = 0)
    SELECT lsd, coalesce(t.year, (SELECT max(year) FROM t)) AS template FROM y LEFT JOIN t ON y.year = t.year""",
    day="day",
)
def q35_template_by_year(day):
    years = day.select("lsd", F.floor(col("lsd") / 10).alias("year")).distinct()
    have = years.where("year % 2 = 0").select("year", col("year").alias("_t")).distinct()
    last = have.agg(F.max("_t").alias("_last"))  # one row
    return years.join(have, "year", "left").join(F.broadcast(last)).select("lsd", F.coalesce("_t", "_last").alias("template"))


@query("SELECT source_id, name FROM fx_catalog WHERE regexp_matches(name, '0[1-5]$')", catalog="catalog")
def q36_list_products(catalog):
    return catalog.where(col("name").rlike("0[1-5]$")).select("source_id", "name")


# --- joins and sets ------------------------------------------------------------------------------------------


@query("SELECT p.prod_id, a.cyl AS cyl_a, b.cyl AS cyl_b FROM fx_baseline p JOIN fx_input a ON p.input_a=a.input_id JOIN fx_input b ON p.input_b=b.input_id", baseline="baseline", inputs="input")
def j1_dimension_join(baseline, inputs):
    side = lambda x: inputs.select(col("input_id").alias(f"input_{x}"), col("cyl").alias(f"cyl_{x}"))
    return baseline.join(side("a"), "input_a").join(side("b"), "input_b").select("prod_id", "cyl_a", "cyl_b")


@query(
    f"""SELECT a.update_t, a.freq_id, a.input_id AS input_a, b.input_id AS input_b, {R('a.re*b.re+a.im*b.im', 4)} AS re FROM fx_gain a
    JOIN fx_gain b ON a.update_t=b.update_t AND a.freq_id=b.freq_id AND a.input_id<=b.input_id""",
    gain="gain",
)
def j8_product_pairs(gain):
    a, b = (gain.select("update_t", "freq_id", col("input_id").alias(f"input_{x}"), col("re").alias(f"re_{x}"), col("im").alias(f"im_{x}")) for x in "ab")
    pairs = a.join(b, ["update_t", "freq_id"]).where("input_a <= input_b")
    return rounded(pairs.select("update_t", "freq_id", "input_a", "input_b", (col("re_a") * col("re_b") + col("im_a") * col("im_b")).alias("re")), 4)


@query("SELECT acq_id, file_id FROM fx_file WHERE acq_id IN (SELECT lsd FROM fx_opinion) AND file_id NOT IN (SELECT lsd FROM fx_opinion WHERE decision='bad')", file="file", opinion="opinion")
def j9_semi_anti(file, opinion):
    kept = file.join(opinion.select(col("lsd").alias("acq_id")), "acq_id", "left_semi")
    return kept.join(opinion.where("decision = 'bad'").select(col("lsd").alias("file_id")), "file_id", "left_anti").select("acq_id", "file_id")


@query(
    f"""SELECT lsd, freq_id, ra_id, e.el AS el, {R('sum(w*(re*cos(2*pi()*stack_id*el)+im*sin(2*pi()*stack_id*el)))', 4)} AS re FROM fx_day, (VALUES (-0.43e0), (0.13e0), (0.31e0), (0.91e0)) e(el)
    GROUP BY lsd, freq_id, ra_id, e.el""",
    day="day",
)
def j10_small_grid(day):
    angle = F.radians(360 * col("stack_id") * col("el"))
    rows = day.withColumn("el", F.explode(F.array(*map(F.lit, (-0.43, 0.13, 0.31, 0.91)))))
    beam = F.sum(col("w") * (col("re") * F.cos(angle) + col("im") * F.sin(angle)))
    return rounded(rows.groupBy("lsd", "freq_id", "ra_id", "el").agg(beam.alias("re")), 4)


@query("SELECT file_id AS tag FROM fx_file WHERE online UNION SELECT lsd FROM fx_opinion", file="file", opinion="opinion")
def u1_union_distinct(file, opinion):
    return file.where("online").select(col("file_id").alias("tag")).unionByName(opinion.select(col("lsd").alias("tag"))).distinct()


_NEXT = "fx_day a JOIN fx_day b ON a.lsd+1=b.lsd AND a.freq_id=b.freq_id AND a.stack_id=b.stack_id AND a.ra_id=b.ra_id"


@query(f"SELECT a.lsd, a.freq_id, a.stack_id, a.ra_id, {R('0.271828e0*a.re+0.728172e0*b.re', 4)} AS re, {R('CASE WHEN a.w=0 OR b.w=0 THEN 0 ELSE 1/(0.271828e0*0.271828e0/a.w+0.728172e0*0.728172e0/b.w) END')} AS w FROM {_NEXT}", day="day")
def u5_mix_two(day):
    other = day.select((col("lsd") - 1).alias("lsd"), "freq_id", "stack_id", "ra_id", col("re").alias("re2"), col("w").alias("w2"))
    weight = F.when((col("w") > 0) & (col("w2") > 0), X.inv0(0.271828 * 0.271828 * X.inv0(col("w")) + 0.728172 * 0.728172 * X.inv0(col("w2")))).otherwise(0.0)
    mixed = day.join(other, CELL).select(*CELL, (0.271828 * col("re") + 0.728172 * col("re2")).alias("re"), weight.alias("w"))
    return rounded(mixed, re=4)


_STACKED = "(SELECT freq_id, stack_id, ra_id, CASE WHEN sum(w)=0 THEN 0 ELSE sum(w*re)/sum(w) END AS re, sum(w) AS w FROM fx_day GROUP BY freq_id, stack_id, ra_id)"


@query(
    f"""SELECT d.lsd, d.freq_id, d.stack_id, d.ra_id, {R('CASE WHEN d.w+0.1e0*s.w=0 THEN 0 ELSE (d.w*d.re+0.1e0*s.w*s.re)/(d.w+0.1e0*s.w) END', 4)} AS re, {R('d.w+0.1e0*s.w')} AS w
    FROM fx_day d JOIN {_STACKED} s ON d.freq_id=s.freq_id AND d.stack_id=s.stack_id AND d.ra_id=s.ra_id""",
    day="day",
)
def u6_blend_stack(day):
    cell = ["freq_id", "stack_id", "ra_id"]
    stack = day.groupBy(*cell).agg((F.sum(col("w") * col("re"))).alias("_s"), (0.1 * F.sum("w")).alias("_w"))
    w = col("w") + col("_w")
    blended = day.join(stack, cell).select(*CELL, ((col("w") * col("re") + 0.1 * col("_s")) * X.inv0(w)).alias("re"), w.alias("w"))
    return rounded(blended, re=4)


@query(
    f"""SELECT i.input_id, f.freq_id, {R('coalesce(m.re, 1)')} AS re, CASE WHEN m.re IS NULL THEN 0.0e0 ELSE 1.0e0 END AS w FROM fx_input i, (SELECT DISTINCT freq_id FROM fx_vis) f
    LEFT JOIN (SELECT freq_id, user_cyl, max(re) AS re FROM (SELECT v.*, input_id%4 AS user_cyl FROM fx_vis v) WHERE w > 2 AND user_cyl < 3 GROUP BY freq_id, user_cyl) m ON m.freq_id = f.freq_id AND m.user_cyl = i.cyl""",
    vis="vis", inputs="input",
)
def u7_expand_common_mode(vis, inputs):
    common = vis.where("w > 2 AND input_id % 4 < 3").groupBy("freq_id", (col("input_id") % 4).alias("cyl")).agg(F.max("re").alias("_re"))
    freqs = vis.select("freq_id").distinct()
    members = inputs.select("input_id", "cyl").join(F.broadcast(freqs))  # channels are a fixed axis
    joined = members.join(common, ["freq_id", "cyl"], "left")
    return rounded(joined.select("input_id", "freq_id", F.coalesce("_re", F.lit(1.0)).alias("re"), col("_re").isNotNull().cast("double").alias("w")))


@query("SELECT 'vis' AS kind, freq_id, count(*) AS n FROM fx_vis GROUP BY freq_id UNION ALL SELECT 'day', freq_id, count(*) FROM fx_day GROUP BY freq_id", vis="vis", day="day")
def u8_accumulate(vis, day):
    part = lambda df, kind: df.groupBy(col("freq_id").cast("long").alias("freq_id")).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "freq_id", "n")
    return part(vis, "vis").unionByName(part(day, "day"))


@query(
    f"SELECT update_t, input_id, freq_id, {R('re', 8)} AS re, update_kind FROM fx_gain WHERE update_kind='gain' UNION ALL SELECT 0.0e0, input_id, freq_id, {R('max(re)', 8)}, 'static' FROM fx_gain GROUP BY input_id, freq_id",
    gain="gain",
)
def k1_concatenate_gains(gain):
    static = gain.groupBy("input_id", "freq_id").agg(F.max("re").alias("re")).withColumns({"update_t": F.lit(0.0), "update_kind": F.lit("static")})
    both = gain.where("update_kind = 'gain'").select("update_t", "input_id", "freq_id", "re", "update_kind").unionByName(static)
    return rounded(both.orderBy("update_t", "input_id", "freq_id"), 8)


@query("SELECT freq_id, ra_id, el_id, row_number() OVER (PARTITION BY freq_id ORDER BY abs(val) DESC, ra_id, el_id) AS place FROM fx_map", map="map")
def k4_catalogue_order(map):
    order = Window.partitionBy("freq_id").orderBy(F.abs("val").desc(), "ra_id", "el_id")
    return map.select("freq_id", "ra_id", "el_id", F.row_number().over(order).cast("long").alias("place"))


@query("SELECT file_id FROM fx_file WHERE NOT online ORDER BY start_t, file_id LIMIT 25", file="file")
def k5_job_limit(file):
    return file.where("NOT online").orderBy("start_t", "file_id").limit(25).select("file_id")


@query("SELECT source_id, CAST(arg_min(b, abs(dec-(10*b+3))*1000+b) AS BIGINT) AS beam FROM fx_catalog, range(0, 9) r(b) GROUP BY source_id", catalog="catalog")
def k6_nearest_beam(catalog):
    beams = F.transform(F.sequence(F.lit(0), F.lit(8)), lambda b: F.struct((F.abs(col("dec") - (10 * b + 3)) * 1000 + b).alias("d"), b.cast("long").alias("b")))
    return catalog.select("source_id", F.array_min(beams)["b"].alias("beam"))


# --- scalars -------------------------------------------------------------------------------------------------


@query(
    f"""SELECT source_id, {R('14.87857614e0/600/cos(radians(dec))', 8)} AS sigma_x, {R('9.95746878e0/600/cos(radians(dec))', 8)} AS sigma_y, {R('exp(-power(abs((dec-49.3e0)/40), 6))')} AS north_south FROM fx_catalog""",
    catalog="catalog",
)
def x10_beam_widths(catalog):
    width = lambda p: X.beam_sigma(F.lit(600.0), col("dec"), F.lit(p))
    flat = F.exp(-F.pow(F.abs((col("dec") - 49.3) / 40), F.lit(6)))
    return rounded(catalog.select("source_id", width("X").alias("sigma_x"), width("Y").alias("sigma_y"), flat.alias("north_south")), 8, north_south=6)


@query("SELECT sample_id, CAST(freq_id*4096+(input_id%16)*256+(sample_id%16)*16+(lsd+16)%16 AS BIGINT) AS stream, sample_id%16 AS slot FROM fx_vis", vis="vis")
def x13_stream_ids(vis):
    code = col("freq_id").cast("long") * 4096 + (col("input_id") % 16) * 256 + (col("sample_id") % 16) * 16 + (col("lsd") + 16) % 16
    return vis.select("sample_id", code.alias("stream")).select("sample_id", "stream", F.shiftright("stream", 4).bitwiseAND(F.lit(15)).cast("long").alias("slot"))


@query("SELECT file_id, strftime(make_timestamp(CAST(start_t*1000000 AS BIGINT)), '%Y-%m-%d') AS date, CAST(quarter(make_timestamp(CAST(start_t*1000000 AS BIGINT))) AS BIGINT) AS quarter FROM fx_file", file="file")
def x15_dates(file):
    at = F.timestamp_micros((col("start_t") * 1e6).cast("long"))
    return file.select("file_id", F.date_format(at, "yyyy-MM-dd").alias("date"), F.quarter(at).cast("long").alias("quarter"))


@query("SELECT file_id, concat('lsd_', CAST(acq_id AS VARCHAR)) AS tag, concat(CAST(acq_id AS VARCHAR), '_to_', CAST(file_id AS VARCHAR)) AS span, concat(acqtype, '.h5') AS base FROM fx_file", file="file")
def x16_strings(file):
    path = F.concat_ws("/", F.lit("data"), col("acq_id").cast("string"), F.concat("acqtype", F.lit(".h5")))
    return file.select("file_id", F.format_string("lsd_%d", "acq_id").alias("tag"), F.concat_ws("_to_", col("acq_id").cast("string"), col("file_id").cast("string")).alias("span"), F.element_at(F.split(path, "/"), -1).alias("base"))


@query(f"SELECT freq_id, beam, t_id, {R('max(x)')} AS top, {R('sum(CASE WHEN x > 1 THEN x ELSE 0 END)')} AS above FROM fx_spec GROUP BY freq_id, beam, t_id", spec="spec")
def x18_arrays(spec):
    packed = spec.groupBy("freq_id", "beam", "t_id").agg(F.collect_list("x").alias("xs"))  # a spectrum: a fixed number of sub-channels
    above = F.aggregate(F.filter("xs", lambda v: v > 1), F.lit(0.0), lambda a, v: a + v)
    return rounded(packed.select("freq_id", "beam", "t_id", F.array_max("xs").alias("top"), above.alias("above")))


@query(f"SELECT prod_id, {R('exp(-x*x)*2*x')} AS h1, {R('exp(-x*x)*(4*x*x-2)')} AS h2, {R('exp(-x*x)*(8*x*x*x-12*x)')} AS h3 FROM (SELECT prod_id, dy AS x FROM fx_baseline)", baseline="baseline")
def x19_hermite(baseline):
    x = col("dy")
    terms = [F.lit(1.0), 2 * x]
    for n in (1, 2):
        terms.append(2 * x * terms[-1] - 2 * n * terms[-2])
    return rounded(baseline.select("prod_id", *((F.exp(-x * x) * t).alias(f"h{k}") for k, t in enumerate(terms) if k)))


@query(f"SELECT freq_id, beam, t_id, CAST(subfreq//8 AS BIGINT) AS bin, {R('avg(x)')} AS x, count(*) AS n FROM fx_spec GROUP BY 1, 2, 3, 4", spec="spec")
def x21_channel_bins(spec):
    return rounded(spec.groupBy("freq_id", "beam", "t_id", F.floor(col("subfreq") / 8).alias("bin")).agg(F.avg("x").alias("x"), F.count("*").alias("n")))


# --- day groups ----------------------------------------------------------------------------------------------


@query(f"SELECT CAST(floor(t/86400) AS BIGINT) AS day, count(*) AS n, {R('sum(rain)', 4)} AS rain FROM fx_weather GROUP BY 1 HAVING max(t)-min(t) >= 82800", weather="weather")
def t2_weather_days(weather):
    days = weather.groupBy(F.floor(col("t") / DAY_S).alias("day")).agg(F.count("*").alias("n"), F.sum("rain").alias("rain"), (F.max("t") - F.min("t")).alias("_span"))
    return rounded(days.where("_span >= 82800").drop("_span"), 4)


@query("SELECT CAST(floor((t-28800)/86400) AS BIGINT) AS local_day, count(*) AS n, min(t) AS first_t FROM fx_vis GROUP BY 1 HAVING max(t)-min(t) >= 7200", vis="vis")
def t3_solar_days(vis):
    days = vis.groupBy(F.floor((col("t") - 28800) / DAY_S).alias("local_day")).agg(F.count("*").alias("n"), F.min("t").alias("first_t"), F.max("t").alias("_last"))
    return days.where("_last - first_t >= 7200").drop("_last")


@query(f"SELECT update_t, input_id, freq_id, {R('CASE WHEN p=0 THEN 0 ELSE re/p END', 4)} AS re, {R('w*p*p', 4)} AS w FROM (SELECT *, re*re+im*im AS p FROM fx_gain)", gain="gain")
def m2_gain_from_fit(gain):
    power = col("re") * col("re") + col("im") * col("im")
    return rounded(gain.select("update_t", "input_id", "freq_id", (col("re") * X.inv0(power)).alias("re"), (col("w") * power * power).alias("w")), 4)


