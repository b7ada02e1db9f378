"""Masks as weight algebra: w = 0 means missing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.scalar import C_M_MHZ, abs2, channel_mhz, inv0, modulo
from meridian.operators.joins import asof_join
from meridian.operators.windows import islands, trailing_sum

FINITE = "isnotnull({0}) AND NOT isnan({0}) AND abs({0}) < double('infinity')"


def _zero_weight(df: DataFrame, bad: Column) -> DataFrame:
    return df.withColumn("w", F.when(F.coalesce(bad, F.lit(False)), 0.0).otherwise(F.col("w")))


def nan_to_num(df: DataFrame) -> DataFrame:
    ok = lambda c: F.expr(FINITE.format(c))
    good = ok("re") & ok("im")
    return df.withColumns({"w": F.when(good & ok("w"), F.col("w")).otherwise(0.0), "re": F.when(good, F.col("re")).otherwise(0.0), "im": F.when(good, F.col("im")).otherwise(0.0)})


def apply_mask(df: DataFrame, mask: DataFrame, on: list[str], values: list[str] = ()) -> DataFrame:
    """w, and values, times 1 - bad of a mask on any of the axes; a missing mask row is good."""
    joined = df.join(mask.select(*on, F.col("bad").alias("_bad")), on, "left").withColumn("_bad", F.coalesce("_bad", F.lit(False)))
    zero = lambda c: F.when(F.col("_bad"), 0.0).otherwise(F.col(c))
    return joined.withColumns({c: zero(c) for c in ("w", *values)}).select(*df.columns)


def drop_bad_days(df: DataFrame, bad_days: DataFrame) -> DataFrame:
    """Days flagged good or unknown stay."""
    return df.join(bad_days.select("lsd").distinct(), "lsd", "left_anti")


def merged_flags(flags: DataFrame, channel: str, width: float) -> DataFrame:
    """channel, bucket, start_t, finish_t: flags cut at multiples of `width` and, within each bucket and channel, laid
    together to runs that don't overlap; however many flags cover a time, one run holds it."""
    first, last = F.floor(F.col("start_t") / width), F.floor(F.col("finish_t") / width)
    pieces = flags.where("finish_t >= start_t").select(channel, "start_t", "finish_t", F.explode(F.sequence(first, last)).alias("bucket"))
    cut = pieces.select(channel, "bucket", F.greatest(F.col("start_t"), F.col("bucket") * width).alias("start_t"), F.least(F.col("finish_t"), (F.col("bucket") + 1) * width).alias("finish_t")).distinct()
    runs = islands(cut, [channel, "bucket"], "start_t", 0.0, "finish_t")
    return runs.groupBy(channel, "bucket", "island").agg(F.min("start_t").alias("start_t"), F.max("finish_t").alias("finish_t")).drop("island")


def apply_data_flags(df: DataFrame, flags: DataFrame, types: list[str], width: float) -> DataFrame:
    """w = 0 inside flag intervals of the types; a flag without freq_id holds for all.

    One row per distinct (freq_id, t) meets the runs of its bucket of `width`, so samples are joined by key alone and
    many flags over one time cost no more than one.
    """
    spots = df.select("freq_id", "t").distinct().withColumn("_pb", F.floor(F.col("t") / width))
    chosen = merged_flags(flags.where(F.col("flag_type").isin(types)).select(F.col("freq_id").alias("_f"), "start_t", "finish_t"), "_f", width)
    inside = (F.col("_pb") == F.col("bucket")) & (F.col("t") >= F.col("start_t")) & (F.col("t") <= F.col("finish_t"))
    own = spots.join(chosen.where("_f is not null"), inside & (F.col("_f") == F.col("freq_id")), "left_semi")
    general = spots.join(chosen.where("_f is null"), inside, "left_semi")
    hit = own.unionByName(general).select("freq_id", "t").distinct()
    return apply_mask(df, hit.withColumn("bad", F.lit(True)), ["freq_id", "t"])


def mask_ra(df: DataFrame, axis: list[str], start: float = 90.0, end: float = 270.0, width: float = 60.0, zero_data: bool = True, remove_average: bool = True) -> DataFrame:
    """A cosine-tapered weight m of the right ascension: w times m squared, values times m if zero_data.

    With remove_average each series (axis) first loses the median of its samples where the untapered mask is 1.
    Where the ramps overlap the closing one holds.
    """
    s, e = modulo(F.col("ra") - start, 360.0), (end - start) % 360.0
    ramp = lambda x: 0.5 * (1 + F.cos(math.pi * x / width))
    base = s > e
    m = F.when((s > e - width) & (s <= e), ramp(s - e)).when(s < width, ramp(s)).otherwise(base.cast("double"))
    if remove_average:
        middle = df.where(base).groupBy(*axis).agg(*(F.percentile(c, F.lit(0.5)).alias(f"_{c}") for c in ("re", "im")))
        joined = df.join(middle, axis, "left")
        df = joined.withColumns({c: F.col(c) - F.coalesce(F.col(f"_{c}"), F.lit(0.0)) for c in ("re", "im")}).select(*df.columns)
    values = {c: F.col(c) * m for c in ("re", "im")} if zero_data else {}
    return df.withColumns(values | {"w": F.col("w") * m * m})


def mask_channels(df: DataFrame, clock_width: float = 0.5, freqs: list[int] = ()) -> DataFrame:
    mhz = channel_mhz(F.col("freq_id"))
    clock = F.abs(modulo(mhz + 5.0, 10.0) - 5.0) <= clock_width / 2
    return _zero_weight(df, clock | F.col("freq_id").isin(list(freqs)))


def flag_nodes(df: DataFrame, nodes: list[int], autos: Column) -> DataFrame:
    """w = 0 for listed nodes and where no autocorrelation of a (freq_id, t) has a positive real part."""
    alive = df.where(autos).groupBy("freq_id", "t").agg(F.max((F.col("re") > 0).cast("int")).alias("_alive"))
    joined = df.join(alive, ["freq_id", "t"], "left")
    bad = (F.coalesce("_alive", F.lit(0)) == 0) | (F.col("freq_id") % 16).isin(nodes)
    return _zero_weight(joined, bad).select(*df.columns)


def apply_input_flags(df: DataFrame, updates: DataFrame, on: list[str]) -> DataFrame:
    """w times the flag of the last update at or before t; samples before any update lose their weight."""
    found = asof_join(df, updates, on, "t", "update_t", {"_flag": "flag"})
    return found.withColumn("w", F.col("w") * F.coalesce("_flag", F.lit(0.0))).select(*df.columns)


def mask_many_bad_inputs(df: DataFrame, time: list[str], threshold: int) -> DataFrame:
    bad = df.groupBy(*time).agg(F.sum((F.col("w") == 0).cast("int")).alias("_n")).where(F.col("_n") > threshold)
    return apply_mask(df, bad.withColumn("bad", F.lit(True)), time)


def expand_mask(mask: DataFrame, axis: list[str], order: str, n: int = 1) -> DataFrame:
    window = Window.partitionBy(*axis).orderBy(order).rowsBetween(-n, n)
    return mask.withColumn("bad", F.max("bad").over(window))


def flag_rainfall(df: DataFrame, rain: DataFrame, samples: int, threshold: float, width: float = 864000.0) -> DataFrame:
    """w = 0 where the rain of the last `samples` readings reaches the threshold; samples read the first reading at
    or after them, the last one if there is none.

    rain: reading_id, t, rain. Both sides meet in ranges of t of `width`: the first reading of a later range stands
    at the end of a range that has none behind its samples.
    """
    summed = trailing_sum(rain, "t", "reading_id", "rain", samples, width)
    ranges = summed.select(F.floor(F.col("t") / width).cast("long").alias("_r"), "t", "total")
    first = ranges.groupBy("_r").agg(F.min_by("total", "t").alias("_first"), F.max_by("total", "t").alias("_last"))
    grid = first.unionByName(df.select(F.floor(F.col("t") / width).cast("long").alias("_r")).distinct(), allowMissingColumns=True)
    grid = grid.groupBy("_r").agg(F.max("_first").alias("_first"), F.max("_last").alias("_last"))
    after = F.last("_first", ignorenulls=True).over(Window.orderBy(F.desc("_r")).rowsBetween(Window.unboundedPreceding, -1))
    before = F.last("_last", ignorenulls=True).over(Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, 0))
    ends = grid.select("_r", F.coalesce(after, before).alias("_end"))
    rows = df.withColumn("_r", F.floor(F.col("t") / width).cast("long")).join(ends, "_r")
    found = asof_join(rows, ranges, ["_r"], "t", "t", {"_rain": "total"}, "forward")
    return _zero_weight(found, F.coalesce("_rain", "_end") >= threshold).select(*df.columns)


def flag_edges(df: DataFrame, axis: list[str], order: str, begin: int, end: int) -> DataFrame:
    """Of each series the first and last samples, counted from its first and last valid ones, lose their weight."""
    rows = df.withColumn("_i", F.row_number().over(Window.partitionBy(*axis).orderBy(order)))
    valid, all_rows = F.when(F.col("w") > 0, F.col("_i")), Window.partitionBy(*axis)
    first, last = F.min(valid).over(all_rows), F.max(valid).over(all_rows)
    return _zero_weight(rows, (F.col("_i") < first + begin) | (F.col("_i") > last - end)).select(*df.columns)


def mask_aliased(df: DataFrame, mhz: Column, min_separation: float) -> DataFrame:
    return _zero_weight(df, F.abs("el") >= C_M_MHZ / (mhz * min_separation) - 1)


def mask_sources(pixels: DataFrame, catalog: DataFrame, ra_step: float, el_step: float, el_start: float, dra: float, del_: float, n_ra: int) -> DataFrame:
    """w = 0 in a box round each source (ra, el): boxes become pixel numbers, so the join is by key."""
    low, high = F.floor((F.col("ra") - dra) / ra_step), F.ceil((F.col("ra") + dra) / ra_step)
    boxes = catalog.select(
        F.explode(F.sequence(low, high)).alias("_r"), F.floor((F.col("el") - del_ - el_start) / el_step).alias("_l"), F.ceil((F.col("el") + del_ - el_start) / el_step).alias("_h")
    )
    hit = boxes.select(F.pmod("_r", F.lit(n_ra)).alias("ra_id"), F.explode(F.sequence("_l", "_h")).alias("el_id")).distinct()
    return apply_mask(pixels, hit.withColumn("bad", F.lit(True)), ["ra_id", "el_id"])


def invert_gain(df: DataFrame) -> DataFrame:
    g = (F.col("re"), F.col("im"))
    k = inv0(abs2(g))
    return df.select(*(c for c in df.columns if c not in ("re", "im", "w")), (g[0] * k).alias("re"), (-g[1] * k).alias("im"), (F.col("w") * abs2(g) * abs2(g)).alias("w"))


def divide_by_template(df: DataFrame, template: DataFrame, on: list[str]) -> DataFrame:
    joined = df.join(template.select(*on, F.col("x").alias("_tpl")), on)
    return joined.withColumns({"x": F.col("x") * inv0(F.col("_tpl")), "w": F.col("w") * F.col("_tpl") * F.col("_tpl")}).select(*df.columns)
