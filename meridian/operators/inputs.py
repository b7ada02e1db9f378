"""Inputs and the products made of them: masks, tests, redundancy, grid weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.scalar import inv0


def product_mask(products: DataFrame, inputs: DataFrame) -> DataFrame:
    """products (input_a, input_b) with `good`: both inputs are good; an input without a row is bad."""
    side = lambda x: inputs.select(F.col("input_id").alias(f"input_{x}"), F.col("good").alias(f"_{x}"))
    joined = products.join(side("a"), "input_a", "left").join(side("b"), "input_b", "left")
    good = F.coalesce("_a", F.lit(False)) & F.coalesce("_b", F.lit(False))
    return joined.select(*products.columns, good.alias("good"))


def redundancy(products: DataFrame, stack: list[str]) -> DataFrame:
    """Number of good products of each stack."""
    return products.groupBy(*stack).agg(F.count(F.when(F.col("good"), 1)).alias("redundancy"))


def test_inputs(tests: DataFrame, threshold: float, known_bad: list[int], use: list[str]) -> DataFrame:
    """input_id, good from (input_id, test, passed): at least `threshold` of the rows of every test in use pass.

    Known bad inputs are never good.
    """
    share = tests.where(F.col("test").isin(use)).groupBy("input_id", "test").agg(F.avg(F.col("passed").cast("double")).alias("share"))
    good = F.min(F.col("share") >= threshold) & ~F.col("input_id").isin(known_bad)
    return share.groupBy("input_id").agg(good.alias("good"))


def grid_weights(products: DataFrame, min_separation: float, weight: str = "natural", zero: float = 0.5) -> DataFrame:
    """pol, xind, yind, weight: products on the grid of separations, each polarisation's weights summing to a half.

    natural: the number of products; uniform: 1. The zero spacing counts `zero` times.
    """
    yind = F.round(F.col("dy") / min_separation).cast("long")
    cells = products.where("good").groupBy("pol", "xind", yind.alias("yind")).agg(F.count("*").cast("double").alias("n"))
    value = F.col("n") if weight == "natural" else F.lit(1.0)
    cells = cells.withColumn("_w", value * F.when((F.col("xind") == 0) & (F.col("yind") == 0), zero).otherwise(1.0))
    total = F.sum("_w").over(Window.partitionBy("pol"))
    return cells.select("pol", "xind", "yind", (F.col("_w") * inv0(2 * total)).alias("weight"))


def low_weight(df: DataFrame, group: list[str], relative: float) -> DataFrame:
    """df with bad: the weight is under `relative` times its group's median weight."""
    median = df.groupBy(*group).agg(F.percentile("w", F.lit(0.5)).alias("_median"))
    return df.join(median, group).withColumn("bad", F.col("w") < relative * F.col("_median")).drop("_median")


def collapse(df: DataFrame, group: list[str]) -> DataFrame:
    """bad per group if any of its rows is."""
    return df.groupBy(*group).agg(F.max("bad").alias("bad"))


def reduced_chisq(df: DataFrame, group: list[str]) -> DataFrame:
    """Weighted mean square of the residuals (re, im) per group over the samples with weight."""
    n = F.count(F.when(F.col("w") > 0, 1))
    square = F.sum(F.col("w") * (F.col("re") * F.col("re") + F.col("im") * F.col("im")))
    return df.groupBy(*group).agg((square * inv0(n.cast("double"))).alias("chisq"), n.alias("n"))


def apply_gain(df: DataFrame, gain: DataFrame, on: list[str]) -> DataFrame:
    """(re, im) times the complex gain, w over its square; a missing or zero gain gives zero weight."""
    joined = df.join(gain.select(*on, F.col("re").alias("_gr"), F.col("im").alias("_gi")), on, "left")
    gr, gi = F.coalesce("_gr", F.lit(0.0)), F.coalesce("_gi", F.lit(0.0))
    re, im = F.col("re") * gr - F.col("im") * gi, F.col("re") * gi + F.col("im") * gr
    return joined.select(*(c for c in df.columns if c not in ("re", "im", "w")), re.alias("re"), im.alias("im"), (F.col("w") * inv0(gr * gr + gi * gi)).alias("w"))


def transiting_source(items: DataFrame, key: list[str], catalog: DataFrame, low: Column, high: Column, width: float) -> DataFrame:
    """The brightest source whose right ascension lies in an item's range: key, source_id; items without one go."""
    from meridian.operators.joins import interval_join

    ranges = items.select(*key, low.alias("_low"), high.alias("_high"))
    met = interval_join(catalog, ranges, "ra", "_low", "_high", width)
    return met.groupBy(*key).agg(F.max_by("source_id", F.struct("flux", "source_id")).alias("source_id"))


def channel_flags(inputs: DataFrame, tests: DataFrame, test_mhz: list[float], mhz: dict[int, float], known_bad: list[int], ignore: tuple[str, ...] = ()) -> DataFrame:
    """input_id, good: inputs (input_id, on) that are on, not known bad, and pass every test at every test frequency.

    tests (input_id, freq_id, gains, noise, fit); a frequency stands for its nearest channel among `mhz`. Tests in
    `ignore` don't count; an unknown (null) result passes, as does an input that was not tested there."""
    channels = sorted({min(mhz, key=lambda c: (abs(mhz[c] - f), c)) for f in test_mhz})
    used = [t for t in ("gains", "noise", "fit") if t not in ignore]
    passed = F.lit(True)
    for t in used:
        passed = passed & F.coalesce(F.col(t), F.lit(True))
    results = tests.where(F.col("freq_id").isin(channels)).groupBy("input_id").agg(F.bool_and(passed).alias("_ok"))
    good = F.coalesce("on", F.lit(False)) & ~F.col("input_id").isin(known_bad) & F.coalesce("_ok", F.lit(True))
    return inputs.join(results, "input_id", "left").select("input_id", good.alias("good"))


def flag_products(df: DataFrame, inputs: DataFrame) -> DataFrame:
    """w = 0 where either input (input_a, input_b) is not good, or not known."""
    side = lambda x: inputs.select(F.col("input_id").alias(f"input_{x}"), F.col("good").alias(f"_{x}"))
    met = df.join(side("a"), "input_a", "left").join(side("b"), "input_b", "left")
    both = F.coalesce(F.col("_a") & F.col("_b"), F.lit(False))
    return met.withColumn("w", F.when(both, F.col("w")).otherwise(0.0)).select(*df.columns)
