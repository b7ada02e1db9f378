"""Fits of a transit's amplitude and phase by re-weighted polynomials, and gains from them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions.scalar import inv0


def _polynomial(coefficients: str, x: Column, degree: int) -> Column:
    out = F.get(coefficients, degree)
    for k in range(degree - 1, -1, -1):
        out = out * x + F.get(coefficients, k)
    return out


def _fit(rows: DataFrame, group: list[str], degrees: dict[str, int]) -> DataFrame:
    """For each name, polynomials of y_<name> in _x with weights _w: c_<name>, and their covariance cov_<name>."""
    powers = [F.sum(F.col("_w") * F.pow("_x", F.lit(k))).alias(f"m{k}") for k in range(2 * max(degrees.values()) + 1)]
    sides = [F.sum(F.col("_w") * F.col(f"_y_{n}") * F.pow("_x", F.lit(k))).alias(f"b_{n}{k}") for n, d in degrees.items() for k in range(d + 1)]
    moments = rows.groupBy(*group).agg(*powers, *sides)

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = frame[group].copy()
            for n, d in degrees.items():
                at = np.add.outer(np.arange(d + 1), np.arange(d + 1))
                m = np.nan_to_num(frame[[f"m{k}" for k in range(2 * d + 1)]].to_numpy()[:, at])
                inverse = np.linalg.pinv(m, rcond=1e-13, hermitian=True) if len(frame) else m
                b = np.nan_to_num(frame[[f"b_{n}{k}" for k in range(d + 1)]].to_numpy())
                out[f"c_{n}"] = list(np.einsum("nij,nj->ni", inverse, b))
                out[f"cov_{n}"] = list(inverse.reshape(len(frame), -1))
            yield out

    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in group)
    return moments.mapInPandas(solve, f"{kinds}, " + ", ".join(f"c_{n} array<double>, cov_{n} array<double>" for n in degrees))


def transit_fit(df: DataFrame, group: list[str], ha: Column, window: Column, degree_amp: int = 5, degree_phase: int = 5, rounds: int = 5) -> DataFrame:
    """group, c_amp, c_phase, cov_amp, cov_phase (row by row), chisq_amp, chisq_phase, ndof_amp, ndof_phase.

    Polynomials in the hour angle of log amplitude and of phase (turned by that at the smallest |ha|, so that it does
    not wrap near the transit), over the samples of weight within `window` of the transit. Weights are those of the
    logarithm, w |v|^2, at first with the measured amplitude, then `rounds` - 1 times with the model's. One shuffle
    brings a group's samples together; each round is an aggregate on the same keys and a solve of its moments. A
    group with fewer samples than coefficients has zero coefficients where nothing is known (least norm)."""
    v = F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im"))
    rows = df.withColumns({"_x": ha, "_v": v}).where((F.col("w") > 0) & (F.col("_v") > 0) & (F.abs("_x") <= window)).repartition(*group)
    middle = F.min_by(F.atan2("im", "re"), F.struct(F.abs("_x"), F.col("_x"), F.atan2("im", "re")))
    turn = rows.groupBy(*group).agg(middle.alias("_turn"))
    off = F.atan2("im", "re") - F.col("_turn")
    rows = rows.join(turn, group).withColumns({"_y_amp": F.log("_v"), "_y_phase": off - 2 * F.pi() * F.round(off / (2 * F.pi())), "_s": F.col("w")})
    degrees = {"amp": degree_amp, "phase": degree_phase}
    weighted = rows.withColumn("_w", F.col("_s") * F.col("_v") * F.col("_v"))
    for turn_no in range(rounds):
        fit = _fit(weighted, group, degrees)
        # Clipped so that a wild fit of a bad group cannot overflow.
        model = F.exp(F.least(F.greatest(_polynomial("c_amp", F.col("_x"), degree_amp), F.lit(-300.0)), F.lit(300.0)))
        met = rows.join(fit, group)
        if turn_no < rounds - 1:
            weighted = met.withColumn("_w", F.col("_s") * model * model).drop("c_amp", "c_phase", "cov_amp", "cov_phase")
    met = weighted.join(fit, group)
    left = {n: F.col(f"_y_{n}") - _polynomial(f"c_{n}", F.col("_x"), d) for n, d in degrees.items()}
    chisq = met.groupBy(*group).agg(*(F.sum(F.col("_w") * r * r).alias(f"chisq_{n}") for n, r in left.items()), F.count("*").alias("_n"))
    out = fit.join(chisq, group).join(turn, group)
    phase = F.transform("c_phase", lambda c, k: F.when(k == 0, c + F.col("_turn")).otherwise(c))
    return out.select(
        *group, "c_amp", phase.alias("c_phase"), "cov_amp", "cov_phase", "chisq_amp", "chisq_phase", (F.col("_n") - degree_amp - 1).alias("ndof_amp"), (F.col("_n") - degree_phase - 1).alias("ndof_phase")
    )


def gain_from_fit(fit: DataFrame, at: Column | None = None, threshold: float = 20.0, degree_amp: int = 5, degree_phase: int = 5) -> DataFrame:
    """fit with re, im, w: the gain that calibrates, one over the model's response at an hour angle (the transit).

    The weight is one over the response's variance, from both covariances, times its fourth power. Both are 0 where
    they are not finite or where either chi-squared per degree of freedom is over the threshold; without degrees of
    freedom it counts as 0."""
    x = F.lit(0.0) if at is None else at
    size = F.exp(_polynomial("c_amp", x, degree_amp))
    angle = _polynomial("c_phase", x, degree_phase)

    def variance(cov: str, degree: int) -> Column:
        total = F.lit(0.0)
        for i in range(degree + 1):
            for j in range(degree + 1):
                total = total + F.get(cov, i * (degree + 1) + j) * F.pow(x, F.lit(i + j))
        return total

    spread = size * size * (variance("cov_amp", degree_amp) + variance("cov_phase", degree_phase))
    rows = fit.withColumns({"_size": size, "_angle": angle, "_spread": spread})
    fine = lambda c: ~F.isnan(c) & (F.abs(c) < float("inf"))
    per = lambda n: F.col(f"chisq_{n}") * inv0(F.col(f"ndof_{n}").cast("double"))
    weight = inv0(F.col("_spread")) * F.pow("_size", F.lit(4))
    re, im = inv0(F.col("_size")) * F.cos("_angle"), -inv0(F.col("_size")) * F.sin("_angle")
    valid = F.coalesce(fine(re) & fine(im) & fine(weight) & (per("amp") <= threshold) & (per("phase") <= threshold), F.lit(False))
    return rows.withColumns({"re": F.when(valid, re).otherwise(0.0), "im": F.when(valid, im).otherwise(0.0), "w": F.when(valid, weight).otherwise(0.0)}).drop("_size", "_angle", "_spread")


def transit_peak(degree_amp: int, span: Column, samples: int = 201) -> Column:
    """The hour angle within `span` of the transit where a fit's amplitude is largest, on an even grid of samples."""
    steps = F.sequence(F.lit(0), F.lit(samples - 1))
    at = F.transform(steps, lambda k: span * (2.0 * k / (samples - 1) - 1.0))
    best = F.aggregate(
        at, F.struct(F.lit(float("-inf")).alias("v"), F.lit(0.0).alias("x")),
        lambda acc, x: F.when(_polynomial("c_amp", x, degree_amp) > acc["v"], F.struct(_polynomial("c_amp", x, degree_amp).alias("v"), x.alias("x"))).otherwise(acc),
    )
    return best["x"]
