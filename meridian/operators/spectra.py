"""Spectra of fine sub-channels, and kernels laid along an axis."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.scalar import inv0


def cut_centre(df: DataFrame, centre: int) -> DataFrame:
    """w = 0 at the central sub-channel."""
    return df.withColumn("w", F.when(F.col("subfreq") == centre, 0.0).otherwise(F.col("w")))


def divide_by_shape(df: DataFrame, shape: Column) -> DataFrame:
    """x over a fixed shape of the sub-channels, w times its square."""
    return df.withColumns({"x": F.col("x") * inv0(shape), "w": F.col("w") * shape * shape})


def sensitivity(df: DataFrame, group: list[str], width_mhz: float, n_sub: int, seconds: float, lost: float) -> DataFrame:
    """Mean over the group of 2 / (x^2 w / (bandwidth * seconds * (1 - lost))), 0 where that has no inverse."""
    samples = width_mhz * 1e6 / n_sub * seconds * (1 - lost)
    metric = 2 * inv0(F.col("x") * F.col("x") / samples * F.col("w"))
    return df.groupBy(*group).agg(F.avg(metric).alias("metric"))


def crowded_times(df: DataFrame, over: Column, sub_threshold: int, beam_threshold: int) -> DataFrame:
    """freq_id, t_id, bad: at least beam_threshold beams have sub_threshold or more sub-channels that are over."""
    beams = df.groupBy("freq_id", "t_id", "beam").agg((F.count(F.when(over, 1)) >= sub_threshold).alias("_hit"))
    return beams.groupBy("freq_id", "t_id").agg((F.count(F.when(F.col("_hit"), 1)) >= beam_threshold).alias("bad"))


def clear_persistent(mask: DataFrame, group: list[str], share: float) -> DataFrame:
    """mask with bad cleared for groups that are bad in more than `share` of their rows."""
    often = F.avg(F.col("bad").cast("double")).over(Window.partitionBy(*group)) > share
    return mask.withColumn("bad", F.col("bad") & ~often)


def lanczos(x: Column, a: int) -> Column:
    """The Lanczos kernel: sinc(x) sinc(x / a) within a samples."""
    px = math.pi * x
    return F.when(x == 0, 1.0).when(F.abs(x) < a, a * F.sin(px) * F.sin(px / a) / (px * px)).otherwise(0.0)


def kz_coefficients(window: int, rounds: int) -> list[float]:
    """A box of `window` samples laid over itself `rounds` times; the coefficients sum to 1."""
    out = [1.0]
    for _ in range(rounds):
        out = [sum(out[max(0, i - window + 1) : i + 1]) / window for i in range(len(out) + window - 1)]
    return out


def spread_kernel(df: DataFrame, axis: list[str], position: str, kernel: dict[int, float], value: str, size: int | None = None, least: float = 0.0) -> DataFrame:
    """Weighted moving mean of value along an axis of whole positions, at the positions that have rows near.

    Each sample goes to the positions its kernel reaches and one aggregation adds up: no self join. Samples without
    weight don't count; below `least` of the kernel's sum the cell is left out. With a size the axis is a ring.
    """
    cells = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(float(c)).alias("c")) for k, c in kernel.items()))
    rows = df.where("w > 0").withColumn("_cell", F.explode(cells))
    at = F.col(position) + F.col("_cell.k")
    rows = rows.select(*axis, (F.pmod(at, F.lit(size)) if size else at).alias(position), F.col("_cell.c").alias("_c"), F.col(value).alias("_v"))
    sums = rows.groupBy(*axis, position).agg(F.sum("_c").alias("_n"), F.sum(F.col("_c") * F.col("_v")).alias("_s"))
    return sums.where(F.col("_n") >= least).select(*axis, position, (F.col("_s") * inv0(F.col("_n"))).alias(value))


def lanczos_shift(df: DataFrame, axis: list[str], position: str, shift: float, a: int, value: str, size: int) -> DataFrame:
    """value on a ring at whole positions plus `shift`, by the Lanczos sum of the samples within a; w by its inverse
    variances. Cells with fewer than 2 a samples in reach are left out."""
    near = F.sequence(F.lit(-a), F.lit(a))
    rows = df.withColumn("_k", F.explode(near)).withColumn("_l", lanczos(F.col("_k") + shift, a)).where(F.abs(F.col("_k") + shift) < a)
    rows = rows.withColumn(position, F.pmod(F.col(position) + F.col("_k"), F.lit(size)))
    sums = rows.groupBy(*axis, position).agg(
        F.count("*").alias("_n"), F.sum(F.col("_l") * F.col(value)).alias(value), F.sum(inv0(F.col("w")) * F.col("_l") * F.col("_l")).alias("_v")
    )
    return sums.where(F.col("_n") >= 2 * a).select(*axis, position, value, inv0(F.col("_v")).alias("w"))


def run_round_centre(df: DataFrame, axis: list[str], order: str) -> DataFrame:
    """df with keep: the row is in the run of rows with weight that holds the middle row of its series."""
    series = Window.partitionBy(*axis)
    rows = df.withColumn("_i", F.row_number().over(series.orderBy(order))).withColumn("_mid", F.floor(F.count("*").over(series) / 2) + 1)
    rows = rows.withColumn("_gap", F.sum((F.col("w") == 0).cast("int")).over(series.orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)))
    middle = F.max(F.when((F.col("_i") == F.col("_mid")) & (F.col("w") > 0), F.col("_gap"))).over(series)
    return rows.withColumn("keep", F.coalesce((F.col("w") > 0) & (F.col("_gap") == middle), F.lit(False))).drop("_i", "_mid", "_gap")


def fill_between(df: DataFrame, axis: list[str], position: str, value: str) -> DataFrame:
    """Samples without weight filled linearly between the nearest ones with weight along the axis, else left.

    A filled sample's weight is that of the linear combination: 1 / (p1^2 / w1 + p2^2 / w2).
    """
    good = F.when(F.col("w") > 0, F.struct(F.col(position).alias("x"), F.col(value).alias("y"), F.col("w").alias("w")))
    seen = lambda order: F.last(good, ignorenulls=True).over(Window.partitionBy(*axis).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    rows = df.withColumns({"_low": seen(F.col(position)), "_high": seen(F.desc(position))})
    p = (F.col(position) - F.col("_low.x")) / (F.col("_high.x") - F.col("_low.x"))
    between = F.col("_low.y") + p * (F.col("_high.y") - F.col("_low.y"))
    weight = inv0((1 - p) * (1 - p) * inv0(F.col("_low.w")) + p * p * inv0(F.col("_high.w")))
    ok = F.col("w") > 0
    return rows.withColumns({
        value: F.when(ok, F.col(value)).otherwise(F.coalesce(between, F.col(value))),
        "w": F.when(ok, F.col("w")).otherwise(F.coalesce(weight, F.lit(0.0))),
    }).drop("_low", "_high")


def regrid_bins(df: DataFrame, axis: list[str], position: Column, value: str) -> DataFrame:
    """Inverse-variance mean of value in each bin: axis, bin, value, w; bins without weight are left out."""
    sums = df.where("w > 0").groupBy(*axis, position.alias("bin")).agg(F.sum(F.col("w") * F.col(value)).alias("_s"), F.sum("w").alias("w"))
    return sums.select(*axis, "bin", (F.col("_s") * inv0(F.col("w"))).alias(value), "w")


def photometry(pixels: DataFrame, boxes: DataFrame, value: str) -> DataFrame:
    """source_id, freq_id, flux, rms: weighted mean of the pixels in each source's box and its error.

    boxes: source_id and the pixel numbers (ra_id, el_id) in its box, so that the join is by key.
    """
    sums = pixels.join(boxes, ["ra_id", "el_id"]).groupBy("source_id", "freq_id").agg(F.sum(F.col("w") * F.col(value)).alias("_s"), F.sum("w").alias("_w"))
    return sums.select("source_id", "freq_id", (F.col("_s") * inv0(F.col("_w"))).alias("flux"), F.sqrt(inv0(F.col("_w"))).alias("rms"))
