"""Queries over file streams, acquisition files and the keyed sink; each writes its input to the shared folder first."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.operators.calibration import apply_digital_gain
from meridian.operators.joins import box_join
from meridian.operators.rounds import shared_folder
from meridian.plans.registry import R, col, query, rounded
from meridian.sources import products
from meridian.streaming import groups as T


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/meridian-{name}-{uuid.uuid4().hex}"


def arrivals(df: DataFrame, batch: str, batches: int) -> tuple[DataFrame, str]:
    """A stream of df's rows in `batches` micro-batches by the number in column `batch`, and a folder for its state."""
    spark = df.sparkSession
    where = _folder(spark, "in")
    for k in range(batches):  # one append a micro-batch, so that files are in order of time
        df.where(col(batch) == k).coalesce(1).write.mode("append").parquet(where)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(where), _folder(spark, "state")


def finished(stream: DataFrame, state: str, mode: str, put: Callable[[DataFrame, int], None]) -> None:
    """Run a stream over all its files with a checkpoint in `state`, each micro-batch through put(frame, number)."""
    stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def last_table(stream: DataFrame, state: str) -> DataFrame:
    """The whole result after the last micro-batch of a stream of aggregates."""
    spark = stream.sparkSession
    where = _folder(spark, "out")
    done: list[int] = []

    def put(frame: DataFrame, number: int) -> None:
        frame.write.mode("overwrite").parquet(f"{where}/{number}")
        done.append(number)

    finished(stream, state, "complete", put)
    return spark.read.schema(stream.schema).parquet(f"{where}/{done[-1]}")


_BATCH = "CAST(CASE WHEN sample_id%5=0 THEN least(3, floor(day/8)+1) ELSE least(3, floor(day/8)) END AS INT)"
_ARRIVED = f"(SELECT *, {_BATCH} AS batch FROM (SELECT *, floor((t-1704067200)/86400) AS day FROM fx_vis))"


def _arrived(vis: DataFrame) -> DataFrame:
    day = F.least(F.lit(3), F.floor(F.floor((col("t") - 1704067200) / 86400) / 8))
    return vis.withColumn("batch", F.least(F.lit(3), F.when(col("sample_id") % 5 == 0, day + 1).otherwise(day)).cast("int"))


@query(f"SELECT freq_id, lsd, {R('sum(w*re)/sum(w)')} AS re, {R('sum(w)')} AS w, count(*) AS n FROM fx_vis GROUP BY 1, 2 HAVING sum(w) > 0", vis="vis")
def t5_running_stack(vis):
    stream, state = arrivals(_arrived(vis).select("freq_id", "lsd", "re", "w", "batch"), "batch", 4)
    return rounded(last_table(T.running_stack(stream, ["freq_id", "lsd"]), state).where("w > 0"))


@query(f"SELECT input_id, count(*) AS n, {R('sum(re)', 4)} AS re_sum, {R('max(re)', 4)} AS re_max, {R('sum(frac_lost)', 4)} AS frac_lost_sum, {R('max(frac_lost)', 4)} AS frac_lost_max FROM fx_vis GROUP BY 1", vis="vis")
def t6_accumulate(vis):
    stream, state = arrivals(_arrived(vis).select("input_id", "re", "frac_lost", "batch"), "batch", 4)
    return rounded(last_table(T.accumulate(stream, ["input_id"], ["re", "frac_lost"]), state), 4)


@query(
    f"""WITH b AS (SELECT update_t, input_id, freq_id, {R('first_re')} AS against FROM (SELECT g.*, re - arg_min(re, struct_pack(t := update_t, f := freq_id)) OVER (PARTITION BY input_id) AS first_re FROM
      (SELECT update_t, input_id, freq_id, re FROM fx_gain) g)) SELECT * FROM b""",
    gain="gain",
)
def t7_acquisition_stream(gain):
    """Each input as an acquisition, whose first sample comes in its first micro-batch: the stream agrees with the batch."""
    order = (col("update_t") * 8 + col("freq_id")).alias("at")
    batch = F.least(F.lit(2), F.floor((col("update_t") - 694224000) / 86400 / 900)).cast("int").alias("batch")
    rows = gain.select("update_t", "input_id", "freq_id", "re", order, batch)
    stream, state = arrivals(rows, "batch", 3)
    where = _folder(gain.sparkSession, "out")
    out = T.acquisition_references(stream, "input_id", "at", "re", "against")
    finished(out, state, "append", lambda frame, number: frame.write.mode("overwrite").parquet(f"{where}/batch={number}"))
    return rounded(gain.sparkSession.read.parquet(where).select("update_t", "input_id", "freq_id", "against"))


@query(f"SELECT update_t, input_id, freq_id, {R('re')} AS re, w FROM fx_gain WHERE update_kind NOT LIKE '%transition%'", gain="gain")
def t8_gain_update_stream(gain):
    stream, state = arrivals(gain.withColumn("batch", (col("freq_id") % 3).cast("int")), "batch", 3)
    where = _folder(gain.sparkSession, "out")
    finished(T.gain_updates(stream), state, "append", lambda frame, number: frame.write.mode("overwrite").parquet(f"{where}/batch={number}"))
    return rounded(gain.sparkSession.read.parquet(where).select("update_t", "input_id", "freq_id", "re", "w"))


@query(
    f"""WITH a AS (SELECT sample_id, t, batch FROM {_ARRIVED}), m AS (SELECT batch, max(t) AS m FROM a GROUP BY 1), p AS (SELECT x.batch, max(y.m) AS before FROM m x LEFT JOIN m y ON y.batch < x.batch GROUP BY 1)
    SELECT sample_id, coalesce(t < before-86400, false) AS late FROM a JOIN p USING (batch)""",
    vis="vis",
)
def t9_late_samples(vis):
    spark = vis.sparkSession
    stream, state = arrivals(_arrived(vis).select("sample_id", "t", "batch"), "batch", 4)
    where, latest = _folder(spark, "out"), [float("-inf")]

    def put(frame: DataFrame, number: int) -> None:
        kept, late = T.on_time_and_late(frame, col("t"), latest[0], 86400.0)
        kept.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True))).write.mode("overwrite").parquet(f"{where}/batch={number}")
        latest[0] = max(latest[0], frame.agg(F.max("t")).first()[0] or latest[0])

    finished(stream, state, "append", put)
    return spark.read.parquet(where).select("sample_id", "late")


@query(f"SELECT CAST(floor(t/86400) AS BIGINT) AS day, {R('avg(rain)')} AS rain, {R('max(temperature)')} AS temperature, count(*) AS n FROM fx_weather GROUP BY 1", weather="weather")
def s2_read_acquisitions(weather):
    """Weather files by kind, columns beyond the kind's left out."""
    where = _folder(weather.sparkSession, "acq")
    weather.repartitionByRange(4, "t").write.parquet(where)
    rows = products.read_acq(weather.sparkSession, [where], "weather")
    return rounded(rows.groupBy(F.floor(col("t") / 86400).cast("long").alias("day")).agg(F.avg("rain").alias("rain"), F.max("temperature").alias("temperature"), F.count("*").alias("n")))


@query(f"SELECT pol, cyl, count(*) AS n, {R('avg(v.re)')} AS re FROM fx_vis v JOIN fx_input i USING (input_id) GROUP BY 1, 2", vis="vis", inputs="input")
def s4_read_side_table(vis, inputs):
    where = _folder(vis.sparkSession, "dim")
    inputs.write.parquet(where)
    side = products.read_dim(vis.sparkSession, where)
    return rounded(vis.join(side, "input_id").groupBy("pol", "cyl").agg(F.count("*").alias("n"), F.avg("re").alias("re")))


@query(f"SELECT lsd, freq_id, {R('sum(re)', 4)} AS re FROM fx_day WHERE lsd IN (SELECT DISTINCT lsd FROM fx_day WHERE stack_id=0 AND freq_id=1 AND lsd%3=1) GROUP BY 1, 2", day="day")
def s5_read_by_tag(day):
    where = _folder(day.sparkSession, "tagged")
    products.write_product(day, where)
    wanted = day.where("stack_id = 0 AND freq_id = 1 AND lsd % 3 = 1").select("lsd")
    return rounded(products.read_by_tag(wanted, where).groupBy("lsd", "freq_id").agg(F.sum("re").alias("re")), 4)


@query(f"SELECT lsd, count(*) AS n, {R('sum(CASE WHEN lsd%2=0 THEN 2*re ELSE re END)', 4)} AS re FROM fx_day WHERE lsd%2=1 OR freq_id > 2 GROUP BY 1", day="day")
def s12_write_product(day):
    """Written by day, then the even days once more with other rows: those days are replaced, the rest stay."""
    where = _folder(day.sparkSession, "product")
    products.write_product(day, where)
    products.write_product(day.where("lsd % 2 = 0 AND freq_id > 2").withColumn("re", 2 * col("re")), where)
    return rounded(day.sparkSession.read.parquet(where).groupBy(col("lsd").cast("long").alias("lsd")).agg(F.count("*").alias("n"), F.sum("re").alias("re")), 4)


@query(
    """SELECT m.freq_id, m.ra_id, m.el_id, c.source_id FROM fx_map m JOIN fx_catalog c ON m.ra BETWEEN c.ra-2.03e0 AND c.ra+2.03e0 AND 40+50*m.el BETWEEN c.dec-(1+c.z) AND c.dec+(1+c.z)""",
    map="map", catalog="catalog",
)
def j7_box_join(map, catalog):
    boxes = catalog.select("source_id", (col("ra") - 2.03).alias("x0"), (col("ra") + 2.03).alias("x1"), (col("dec") - (1 + col("z"))).alias("y0"), (col("dec") + (1 + col("z"))).alias("y1"))
    return box_join(map.withColumn("y", 40 + 50 * col("el")), boxes, "ra", "y", ("x0", "x1", "y0", "y1"), (4.0, 4.0)).select("freq_id", "ra_id", "el_id", "source_id")


@query(
    f"""SELECT freq_id, t, input_a, {R('re')} AS re, CASE WHEN re=0 AND im=0 THEN 0.0e0 ELSE 255.0e0 END AS w FROM (SELECT *, input_id AS input_a, CASE WHEN sample_id%3=0 THEN input_id ELSE input_id+1 END AS input_b FROM fx_vis)
    WHERE freq_id IN (1, 4) AND input_a = input_b""",
    vis="vis",
)
def s1_choose_channels(vis):
    """Channels nearest to three frequencies, autocorrelations alone, no weights in the files."""
    where = _folder(vis.sparkSession, "vis")
    other = F.when(col("sample_id") % 3 == 0, col("input_id")).otherwise(col("input_id") + 1)
    vis.select("freq_id", col("input_id").alias("input_a"), other.alias("input_b"), "t", "re", "im").repartitionByRange(4, "t").write.parquet(where)
    rows = products.read_vis(vis.sparkSession, [where], mhz=[799.6, 799.5, 798.4], channel_index=[2], only_autos=True)
    return rounded(rows.select("freq_id", "t", "input_a", "re", "w"))


@query(
    f"""WITH d AS (SELECT g.* EXCLUDE (re, im, w), g.re/m AS re, g.im/m AS im FROM fx_gain g JOIN (SELECT update_t, median(sqrt(re*re+im*im)) FILTER (re*re+im*im > 0) AS m FROM fx_gain WHERE update_kind='transition' GROUP BY 1) USING (update_t) WHERE update_kind='transition'),
    i AS (SELECT update_t, input_id, freq_id, CASE WHEN re*re+im*im > 0 THEN re/(re*re+im*im) ELSE 0 END AS re, CASE WHEN re*re+im*im > 0 THEN -im/(re*re+im*im) ELSE 0 END AS im FROM d)
    SELECT g.update_t, g.input_id, g.freq_id, {R('g.re*coalesce(d.re,0)-g.im*coalesce(d.im,0)', 5)} AS re, {R('g.re*coalesce(d.im,0)+g.im*coalesce(d.re,0)', 5)} AS im,
    {R('CASE WHEN coalesce(d.re*d.re+d.im*d.im, 0) = 0 THEN 0 ELSE g.w/(d.re*d.re+d.im*d.im) END', 5)} AS w
    FROM (SELECT * FROM fx_gain WHERE update_kind = 'gain') g ASOF LEFT JOIN i d ON g.input_id = d.input_id AND g.freq_id = d.freq_id AND g.update_t >= d.update_t""",
    gain="gain",
)
def d35_normalised_digital_gain(gain):
    part = lambda kind: gain.where(col("update_kind") == kind).drop("update_kind")
    return rounded(apply_digital_gain(part("gain"), part("transition"), ["input_id", "freq_id"], invert=True, normalize=True), 5)


@query(
    f"""WITH r AS (SELECT CAST(floor(lsd/3) AS BIGINT) AS run_id, min(t) AS start_t, max(t) AS finish_t FROM fx_vis WHERE lsd%3 <> 2 GROUP BY 1),
    x AS (SELECT c.source_id AS source, 1704067200+(l.lsd+c.ra/360)*86164.0989e0 AS transit_t FROM (SELECT * FROM fx_catalog WHERE source_id%7=0) c, (SELECT DISTINCT lsd FROM fx_vis) l),
    h AS (SELECT source, transit_t, min(run_id) AS run_id FROM x JOIN r ON transit_t BETWEEN start_t AND finish_t GROUP BY 1, 2),
    w AS (SELECT source, transit_t, run_id, greatest(transit_t-5000, start_t) AS s, least(transit_t+5000, finish_t) AS f FROM h JOIN r USING (run_id))
    SELECT source, run_id, {R('transit_t', 3)} AS transit_t, {R('f-s', 3)} AS span, count(*) AS n, {R('sum(w)', 4)} AS w, {R('sum(w*re)', 3)} AS wx FROM w JOIN fx_vis v ON v.t BETWEEN s AND f WHERE f-s >= 6000 GROUP BY source, run_id, w.transit_t, f, s""".replace("sum(w)", "sum(v.w)").replace("sum(w*re)", "sum(v.w*re)"),
    vis="vis", catalog="catalog",
)
def t4_transit_groups(vis, catalog):
    runs = vis.where("lsd % 3 <> 2").groupBy(F.floor(col("lsd") / 3).cast("long").alias("run_id")).agg(F.min("t").alias("start_t"), F.max("t").alias("finish_t"))
    days = vis.select("lsd").distinct()
    sources = catalog.where("source_id % 7 = 0").select(col("source_id").alias("source"), "ra")
    low, high = days.agg(F.min("lsd"), F.max("lsd")).first()
    spread = sources.withColumn("lsd", F.explode(F.sequence(F.lit(low), F.lit(high)))).join(days, "lsd")
    transits = spread.select("source", (1704067200 + (col("lsd") + col("ra") / 360) * 86164.0989).alias("transit_t"))
    out = T.transit_groups(vis, transits, runs, 5000.0, 6000.0)
    return rounded(out.select("source", "run_id", "transit_t", (col("finish_t") - col("start_t")).alias("span"), "n", "w", "wx"), 3, w=4)
