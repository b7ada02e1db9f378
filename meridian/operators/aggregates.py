"""Weighted averages, robust statistics and stacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.scalar import inv0


def average(df: DataFrame, keep: list[str], weighting: str = "inverse_variance", value: str = "x") -> DataFrame:
    x, w = F.col(value), F.col("w")
    if weighting == "inverse_variance":
        return df.groupBy(*keep).agg((F.sum(w * x) * inv0(F.sum(w))).alias(value), F.sum(w).alias("w"))
    used = F.when(w > 0, x)
    n = F.sum((w > 0).cast("double"))
    return df.groupBy(*keep).agg(F.coalesce(F.avg(used), F.lit(0.0)).alias(value), (n * n * inv0(F.sum(inv0(w)))).alias("w"))


def sidereal_mean(df: DataFrame, axis: list[str], quiet: Column, median: bool = True, missing_threshold: float = 0.0) -> DataFrame:
    """Per series the median (or mean) of re and im over quiet samples with weight, and how many there are.

    Series of which no more than missing_threshold of the quiet samples are present are dropped.
    """
    used = quiet & (F.col("w") > 0)
    of = (lambda c: F.percentile(F.when(used, F.col(c)), F.lit(0.5))) if median else (lambda c: F.avg(F.when(used, F.col(c))))
    share = F.avg(F.when(quiet, (F.col("w") > 0).cast("double")))
    out = df.groupBy(*axis).agg(of("re").alias("re"), of("im").alias("im"), F.sum(used.cast("long")).alias("n"), share.alias("_share"))
    return out.where(F.col("_share") > missing_threshold).drop("_share")


def subtract_mean(df: DataFrame, mean: DataFrame, axis: list[str]) -> DataFrame:
    """Samples less their series' mean; w = 0 where there is none."""
    joined = df.join(mean.select(*axis, F.col("re").alias("_re"), F.col("im").alias("_im")), axis, "left")
    change = {c: F.col(c) - F.coalesce(F.col(f"_{c}"), F.lit(0.0)) for c in ("re", "im")}
    return joined.withColumns(change | {"w": F.when(F.col("_re").isNull(), 0.0).otherwise(F.col("w"))}).select(*df.columns)


def stack_days(df: DataFrame, cell: list[str]) -> DataFrame:
    w = F.col("w")
    return df.groupBy(*cell).agg(
        *((F.sum(w * F.col(c)) * inv0(F.sum(w))).alias(c) for c in ("re", "im")),
        F.sum(w).alias("w"),
        F.sum((w > 0).cast("long")).alias("nsample"),
        F.countDistinct(F.when(w > 0, F.col("lsd"))).alias("n_days"),
    )


def stack_transits(df: DataFrame, cell: list[str]) -> DataFrame:
    """Mean weighted by w, its weight, and the real sample covariance of real and imaginary parts."""
    c, re, im = F.col("w"), F.col("re"), F.col("im")
    sums = df.groupBy(*cell).agg(
        F.sum(c).alias("c"), F.sum(c * re).alias("a"), F.sum(c * im).alias("b"), F.sum(c * c * inv0(c)).alias("v"),
        F.sum(c * re * re).alias("rr"), F.sum(c * im * im).alias("ii"), F.sum(c * re * im).alias("ri"), F.count(F.when(c > 0, 1)).alias("nsample"),
    )
    k = inv0(F.col("c"))
    mean_re, mean_im = F.col("a") * k, F.col("b") * k
    return sums.select(
        *cell, mean_re.alias("re"), mean_im.alias("im"), (F.col("c") * F.col("c") * inv0(F.col("v"))).alias("w"),
        (F.col("rr") * k - mean_re * mean_re).alias("var_re"), (F.col("ii") * k - mean_im * mean_im).alias("var_im"),
        (F.col("ri") * k - mean_re * mean_im).alias("cov"), "nsample",
    )


def consensus_mask(day_mask: DataFrame, n_cut: int, least_days: int = 3) -> DataFrame:
    """input_id, good: inputs good on all days on which no more than n_cut inputs are bad that day alone."""
    bad = (~F.col("good")).cast("int")
    rows = day_mask.withColumn("_n", F.sum(bad).over(Window.partitionBy("input_id")))
    days = rows.groupBy("lsd").agg(F.sum(F.when((bad == 1) & (F.col("_n") == 1), 1).otherwise(0)).alias("_alone"))
    total = days.agg(F.count("*").alias("_days"))
    fine = days.crossJoin(F.broadcast(total)).where((F.col("_alone") <= n_cut) | (F.col("_days") < max(2, least_days)))
    return rows.join(fine.select("lsd"), "lsd", "left_semi").groupBy("input_id").agg(F.min(F.col("good")).alias("good"))


def common_mode(df: DataFrame, group: list[str]) -> DataFrame:
    used = lambda c: F.percentile(F.when(F.col("w") > 0, F.col(c)), F.lit(0.5))
    return df.groupBy(*group).agg(used("re").alias("re"), used("im").alias("im"), F.max((F.col("w") > 0).cast("double")).alias("w"))


def median_subtract(df: DataFrame, group: list[str]) -> DataFrame:
    middle = F.percentile(F.when(F.col("w") > 0, F.col("x")), F.lit(0.5)).over(Window.partitionBy(*group))
    return df.withColumn("x", F.col("x") - F.coalesce(middle, F.lit(0.0)))


def pair_mean(df: DataFrame, group: list[str], order: str) -> DataFrame:
    """Mean of g_i conj(g_j) over pairs i <= j of a group, with running sums in place of pairs."""
    window = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = df.withColumns({"_a": F.sum("re").over(window), "_b": F.sum("im").over(window)})
    re, im = F.col("re"), F.col("im")
    real, imag = F.col("_a") * re + F.col("_b") * im, F.col("_b") * re - F.col("_a") * im
    n = F.count("*") * (F.count("*") + 1) / 2
    return rows.groupBy(*group).agg((F.sum(real) / n).alias("re"), (F.sum(imag) / n).alias("im"), F.count("*").alias("n"))


def rfi_counts(df: DataFrame, group: list[str], sigmas: list[float], spread: float) -> DataFrame:
    """How many sub-frequencies pass 1 + spread * sigma, for up to four sigmas, 8 bits each in one number."""
    counts = [F.least(F.sum((F.col("x") > 1 + spread * s).cast("long")), F.lit(255)) for s in sigmas]
    packed = counts[0]
    for k, c in enumerate(counts[1:], 1):
        packed = packed + c * (1 << 8 * k)
    return df.groupBy(*group).agg(packed.cast("long").alias("bitmap"))


def bitmap_count(bitmap: Column, k: int) -> Column:
    return F.shiftright(bitmap, 8 * k).bitwiseAND(255)


def fold(df: DataFrame, group: list[str], order: str, period: int, phase: int) -> DataFrame:
    """Per period the mean on phase less the mean off phase."""
    rows = df.withColumn("_i", F.row_number().over(Window.partitionBy(*group).orderBy(order)) - 1)
    on = F.col("_i") % period == phase
    rows = rows.withColumn("fold", F.floor(F.col("_i") / period))
    part = lambda c: (F.avg(F.when(on, F.col(c))) - F.avg(F.when(~on, F.col(c)))).alias(c)
    return rows.groupBy(*group, "fold").agg(part("re"), part("im"))
