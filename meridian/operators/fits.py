"""Small fits: moments in Spark, closed forms or tiny solves per group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions.scalar import LINE_MHZ, inv0


def line_fit(df: DataFrame, group: list[str], x: Column, y: Column, w: Column) -> DataFrame:
    """Weighted straight line per group by Cramer's rule: offset, slope, their variances, chisq and ndof."""
    s = df.withColumns({"_x": x, "_y": y, "_w": w}).groupBy(*group).agg(
        *(F.sum(F.expr(e)).alias(n) for n, e in {"s0": "_w", "s1": "_w*_x", "s2": "_w*_x*_x", "t0": "_w*_y", "t1": "_w*_x*_y", "yy": "_w*_y*_y"}.items()),
        F.count(F.when(F.col("_w") > 0, 1)).alias("n"),
    )
    k = inv0(F.col("s0") * F.col("s2") - F.col("s1") * F.col("s1"))
    a, b = (F.col("s2") * F.col("t0") - F.col("s1") * F.col("t1")) * k, (F.col("s0") * F.col("t1") - F.col("s1") * F.col("t0")) * k
    fitted = s.withColumns({"offset": a, "slope": b, "var_offset": F.col("s2") * k, "var_slope": F.col("s0") * k})
    chisq = F.col("yy") - F.col("offset") * F.col("t0") - F.col("slope") * F.col("t1")
    return fitted.select(*group, "offset", "slope", "var_offset", "var_slope", chisq.alias("chisq"), (F.col("n") - 2).alias("ndof"))


def polynomial_fit(df: DataFrame, group: list[str], x: Column, y: Column, w: Column, degree: int) -> DataFrame:
    """Weighted polynomial per group: moments by one aggregation, then a (degree + 1) solve per group."""
    powers = [F.sum(F.col("_w") * F.pow("_x", F.lit(k))).alias(f"m{k}") for k in range(2 * degree + 1)]
    sides = [F.sum(F.col("_w") * F.col("_y") * F.pow("_x", F.lit(k))).alias(f"b{k}") for k in range(degree + 1)]
    moments = df.withColumns({"_x": x, "_y": y, "_w": w}).groupBy(*group).agg(*powers, *sides)

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = np.add.outer(np.arange(degree + 1), np.arange(degree + 1))
        for frame in frames:
            m = frame[[f"m{k}" for k in range(2 * degree + 1)]].to_numpy()[:, at]
            b = frame[[f"b{k}" for k in range(degree + 1)]].to_numpy()
            found = np.einsum("nij,nj->ni", np.linalg.pinv(m, rcond=1e-12), b) if len(frame) else b
            yield frame[group].assign(coeff=list(found))

    kinds = ", ".join(f"{g} {df.schema[g].dataType.simpleString()}" for g in group)
    return moments.mapInPandas(solve, f"{kinds}, coeff array<double>")


def two_source_amplitudes(df: DataFrame, group: list[str], a1: tuple[Column, Column], a2: tuple[Column, Column]) -> DataFrame:
    """Real least-squares amplitudes of two complex templates in (re, im, w), by the 2 x 2 normal equations."""
    dot = lambda p, q: F.sum(F.col("w") * (p[0] * q[0] + p[1] * q[1]))
    v = (F.col("re"), F.col("im"))
    s = df.groupBy(*group).agg(dot(a1, a1).alias("g11"), dot(a1, a2).alias("g12"), dot(a2, a2).alias("g22"), dot(a1, v).alias("h1"), dot(a2, v).alias("h2"))
    k = inv0(F.col("g11") * F.col("g22") - F.col("g12") * F.col("g12"))
    return s.select(*group, ((F.col("g22") * F.col("h1") - F.col("g12") * F.col("h2")) * k).alias("amp1"), ((F.col("g11") * F.col("h2") - F.col("g12") * F.col("h1")) * k).alias("amp2"))


def deposit_catalog(catalog: DataFrame, low_mhz: float, width: float, n_channels: int, scale: float, reach: float) -> DataFrame:
    """(source_id, channel, share): a double-exponential line of a scale in MHz laid over evenly spaced channels.

    A channel's share is the profile's integral over it: 2 - e^-a - e^-b around the line, else |e^-a - e^-b|, in
    units of half the line.
    """
    f = LINE_MHZ / (1 + F.col("z"))
    first = F.greatest(F.floor((f - reach * scale - low_mhz) / width), F.lit(0))
    last = F.least(F.floor((f + reach * scale - low_mhz) / width), F.lit(n_channels - 1))
    rows = catalog.withColumn("_f", f).where(first <= last).withColumn("channel", F.explode(F.sequence(first, last)))
    lower = low_mhz + F.col("channel") * width
    a, b = F.abs(F.col("_f") - lower) / scale, F.abs(F.col("_f") - lower - width) / scale
    inside = (F.col("_f") >= lower) & (F.col("_f") < lower + width)
    share = F.when(inside, 2 - F.exp(-a) - F.exp(-b)).otherwise(F.abs(F.exp(-a) - F.exp(-b)))
    return rows.select("source_id", "channel", share.alias("share"))
