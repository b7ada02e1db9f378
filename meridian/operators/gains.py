"""Gain errors of stacks and beams, corrections inside flagged intervals, references of acquisitions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.scalar import abs2, cinv0, cis, cmul, conj, inv0
from meridian.operators.inputs import apply_gain, product_mask
from meridian.operators.joins import interval_join


def _pairs(products: DataFrame, gain: DataFrame, on: list[str]) -> DataFrame:
    """products beside both inputs' gains: on, _rea, _ima, _wa, _reb, _imb, _wb."""
    side = lambda x: gain.select(*on, F.col("input_id").alias(f"input_{x}"), *(F.col(c).alias(f"_{c}{x}") for c in ("re", "im", "w")))
    return products.join(side("a"), "input_a").join(side("b"), ["input_b", *on])


def _cross() -> tuple[Column, Column]:
    return cmul((F.col("_rea"), F.col("_ima")), conj((F.col("_reb"), F.col("_imb"))))


def stack_gain_error(products: DataFrame, inputs: DataFrame, gain: DataFrame, stack: list[str], on: list[str]) -> DataFrame:
    """Per stack and `on` the mean of g_a conj(g_b) over the stack's good products: re, im."""
    good = product_mask(products, inputs).where("good")
    re, im = _cross()
    return _pairs(good, gain, on).groupBy(*stack, *on).agg(F.avg(re).alias("re"), F.avg(im).alias("im"))


def correct_gain_error(df: DataFrame, error: DataFrame, on: list[str]) -> DataFrame:
    """(re, im) over the stack's gain error, w times its square; no error known, or a zero one, gives zeros."""
    re, im = cinv0((F.col("re"), F.col("im")))
    return apply_gain(df, error.select(*on, re.alias("re"), im.alias("im")), on)


def stacked_beam(products: DataFrame, inputs: DataFrame, beam: DataFrame, stack: list[str], on: list[str]) -> DataFrame:
    """Per stack and `on` the mean of b_a conj(b_b) over good products, weighted by its inverse variance: re, im, w."""
    good = product_mask(products, inputs).where("good")
    re, im = _cross()
    relative = lambda x: inv0(F.col(f"_w{x}") * abs2((F.col(f"_re{x}"), F.col(f"_im{x}"))))
    known = (F.col("_wa") > 0) & (F.col("_wb") > 0)
    rows = _pairs(good, beam, on).select(*stack, *on, re.alias("_re"), im.alias("_im"), F.when(known, inv0(abs2((re, im)) * (relative("a") + relative("b")))).otherwise(0.0).alias("_w"))
    total = F.sum("_w")
    mean = lambda c: F.sum(F.col("_w") * F.col(c)) * inv0(total)
    return rows.groupBy(*stack, *on).agg(mean("_re").alias("re"), mean("_im").alias("im"), total.alias("w"))


def narrowband_gain_error(gain: DataFrame, smooth: DataFrame, on: list[str], series: list[str], masked: Column) -> DataFrame:
    """gain over its smooth form (on, re, im) where it has weight and `masked` holds, 1 elsewhere; w is 1 there if any
    row of its series has weight."""
    joined = gain.join(smooth.select(*on, F.col("re").alias("_sr"), F.col("im").alias("_si")), on)
    narrow = (F.col("w") > 0) & masked
    re, im = cmul((F.col("re"), F.col("im")), cinv0((F.col("_sr"), F.col("_si"))))
    alive = F.max(F.col("w") > 0).over(Window.partitionBy(*series))
    return joined.select(
        *(c for c in gain.columns if c not in ("re", "im", "w")), F.when(narrow, re).otherwise(1.0).alias("re"), F.when(narrow, im).otherwise(0.0).alias("im"),
        F.when(narrow & alive, 1.0).otherwise(0.0).alias("w"),
    )


def flag_delays(flags: DataFrame, path: str, zero: float, seconds: float) -> DataFrame:
    """flags with `delay` read from their JSON metadata, (number - zero) * seconds; flags without effect go."""
    number = F.get_json_object("metadata", path).cast("double")
    return flags.withColumn("delay", (number - zero) * seconds).where(F.col("delay") != 0)


def correct_delays(df: DataFrame, key: str, flags: DataFrame, mhz: Column, width: float) -> DataFrame:
    """Samples turned by 2 pi f delay for each flag (start_t, finish_t, delay) whose interval holds their t."""
    met = interval_join(df.select(key, "t"), flags.select("start_t", "finish_t", "delay"), "t", "start_t", "finish_t", width)
    total = met.groupBy(key).agg(F.sum("delay").alias("_delay"))
    re, im = cmul((F.col("re"), F.col("im")), cis(2 * math.pi * 1e6 * mhz * F.coalesce("_delay", F.lit(0.0))))
    return df.join(total, key, "left").withColumns({"re": re, "im": im}).select(*df.columns)


def against_first(df: DataFrame, acquisition: str, order: list[str], value: str, name: str) -> DataFrame:
    """df with `name`: the value less that of its acquisition's first row; the first row's own key breaks ties."""
    first = df.groupBy(acquisition).agg(F.min_by(value, F.struct(*order)).alias("_first"))
    return df.join(first, acquisition).withColumn(name, F.col(value) - F.col("_first")).select(*df.columns, name)


def context_mask(context: Column, inside: Column, outside: Column) -> Column:
    """One mask where the context holds, another elsewhere; an unknown context counts as elsewhere."""
    return F.when(context, inside).otherwise(outside)


def spread_mask(df: DataFrame, keep: list[str], at: Column, reach: float, low: float, step: float, size: int) -> DataFrame:
    """keep, el_id, bad: the pixels low + step * el_id of each `keep` that lie within `reach` of a row; bad if any such
    row is. Each row goes to its own few pixels, so nothing meets all others."""
    first = F.greatest(F.ceil((at - reach - low) / step), F.lit(0))
    last = F.least(F.floor((at + reach - low) / step), F.lit(size - 1))
    pixels = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    return df.select(*keep, "bad", F.explode(pixels).alias("el_id")).groupBy(*keep, "el_id").agg(F.max("bad").alias("bad"))
