"""Timing corrections of streams: which need one, which table serves, delays turned back."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions.scalar import cis, cmul
from meridian.operators.windows import interpolate


def streams_to_correct(vis: DataFrame, stream: str, flags: DataFrame, tables: DataFrame, pass_if_missing: bool = False, take_partial: bool = False) -> DataFrame:
    """stream, table_id: the streams that need a timing correction, and the table that serves each.

    A stream needs one if its first sample lies in one of the flags (start_t, finish_t): in the one that starts first
    (then ends first), as in a list of flags in order of time. If it doesn't end before that flag does, it overlaps in
    part, which is an error, or with take_partial needs one all the same. The table is the first (least table_id) whose times (table_id, input_id, t, delay) span
    the stream; without one the stream is left out if pass_if_missing, else that is an error. Errors are raised where
    the column is computed, with the stream's name."""
    spans = vis.groupBy(stream).agg(F.min("t").alias("_t0"), F.max("t").alias("_t1"))
    within = flags.select("start_t", "finish_t").distinct()
    # Streams meet flags, and tables, by the day of their first sample.
    day = 86400.0
    held = within.withColumn("_d", F.explode(F.sequence(F.floor(F.col("start_t") / day), F.floor(F.col("finish_t") / day))))
    met = spans.withColumn("_d", F.floor(F.col("_t0") / day)).join(held, "_d").where((F.col("_t0") >= F.col("start_t")) & (F.col("_t0") <= F.col("finish_t")))
    first = met.groupBy(stream, "_t0", "_t1").agg(F.min(F.struct("start_t", "finish_t")).alias("_flag"))
    part = F.col("_t1") >= F.col("_flag.finish_t")
    said = F.concat(F.lit("stream "), F.col(stream).cast("string"), F.lit(" partially overlaps a flag that needs a timing correction"))
    needing = first.withColumn("_ok", F.lit(True) if take_partial else F.when(part, F.raise_error(said)).otherwise(F.lit(True)))
    reach = tables.groupBy("table_id").agg(F.min("t").alias("_from"), F.max("t").alias("_to"))
    reach = reach.withColumn("_d", F.explode(F.sequence(F.floor(F.col("_from") / day), F.floor(F.col("_to") / day))))
    spanned = needing.withColumn("_d", F.floor(F.col("_t0") / day)).join(reach, "_d").where((F.col("_t0") >= F.col("_from")) & (F.col("_t1") <= F.col("_to")))
    found = spanned.groupBy(stream).agg(F.min("table_id").alias("table_id"))
    if pass_if_missing:
        return needing.where("_ok").select(stream).join(found, stream)
    missing = F.raise_error(F.concat(F.lit("no timing correction spans stream "), F.col(stream).cast("string")))
    all_of = needing.where("_ok").select(stream).join(found, stream, "left")
    return all_of.select(stream, F.when(F.col("table_id").isNull(), missing).otherwise(F.col("table_id")).alias("table_id"))


def apply_timing_correction(
    vis: DataFrame, stream: str, flags: DataFrame, tables: DataFrame, mhz: Column, pass_if_missing: bool = False, transits: DataFrame | None = None,
    take_partial: bool = False,
) -> DataFrame:
    """vis (stream, input_a, input_b, t, re, im, w) with phases turned by the difference of both inputs' delays.

    Streams that streams_to_correct() names are turned by exp(2 pi i f (tau_a - tau_b)), tau (seconds) interpolated
    to t from the stream's table (table_id, input_id, t, delay, w). With transits (stream, transit_t) delays count from
    that at the transit. Where a delay is unknown (no samples of weight on both sides) w becomes 0; all other streams
    stay as they are."""
    chosen = streams_to_correct(vis, stream, flags, tables, pass_if_missing, take_partial)
    rows = vis.join(chosen, stream, "left")
    spots = rows.where("table_id is not null").select("table_id", "t", F.explode(F.array("input_a", "input_b")).alias("input_id")).distinct()
    delays = interpolate(spots, tables.select("table_id", "input_id", "t", "delay", "w"), ["table_id", "input_id"], "t", "delay").where("w > 0").drop("w")
    if transits is not None:
        of = rows.where("table_id is not null").select(stream, "table_id", F.explode(F.array("input_a", "input_b")).alias("input_id")).distinct()
        at = of.join(transits.select(stream, F.col("transit_t").alias("t")), stream)
        zero = interpolate(at, tables.select("table_id", "input_id", "t", "delay", "w"), ["table_id", "input_id"], "t", "delay").where("w > 0")
        zero = zero.select(stream, "input_id", F.col("delay").alias("_zero"))
    for side in ("a", "b"):
        rows = rows.join(delays.select("table_id", "t", F.col("input_id").alias(f"input_{side}"), F.col("delay").alias(f"_tau_{side}")), ["table_id", "t", f"input_{side}"], "left")
        if transits is not None:
            rows = rows.join(zero.select(stream, F.col("input_id").alias(f"input_{side}"), F.col("_zero").alias(f"_zero_{side}")), [stream, f"input_{side}"], "left")
            rows = rows.withColumn(f"_tau_{side}", F.col(f"_tau_{side}") - F.col(f"_zero_{side}"))
    tau = F.col("_tau_a") - F.col("_tau_b")
    known, served = tau.isNotNull(), F.col("table_id").isNotNull()
    re, im = cmul((F.col("re"), F.col("im")), cis(2 * math.pi * 1e6 * mhz * tau))
    new = {"re": F.when(served & known, re).otherwise(F.col("re")), "im": F.when(served & known, im).otherwise(F.col("im")), "w": F.when(served & ~known, 0.0).otherwise(F.col("w"))}
    return rows.withColumns(new).select(*vis.columns)
