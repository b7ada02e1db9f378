"""Calibration: phases, gains in time, formed beams, and what is looked up for them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.scalar import SIDEREAL_DAY, abs2, beam_sigma, cinv0, cis, cmul, conj, fringe_phase, inv0, stellar_angle, sun, wrap
from meridian.operators.joins import _found


def source_phase(df: DataFrame, inputs: DataFrame, on: str, ra: float, dec: float, latitude: float, longitude: float, wavelength: Column) -> DataFrame:
    """df with phase: the fringe phase in radians of a source at each row's input position (x, y in metres) and t."""
    placed = df.join(inputs.select(on, F.col("x").alias("_x"), F.col("y").alias("_y")), on)
    ha = stellar_angle(F.col("t"), longitude) - ra
    phase = fringe_phase(ha, F.lit(dec), latitude, F.col("_x") / wavelength, F.col("_y") / wavelength)
    return placed.withColumn("phase", phase).select(*df.columns, "phase")


def fringestop(df: DataFrame, phase: Column) -> DataFrame:
    """Samples turned by minus their source's phase, so that the source stands still; weights stay."""
    re, im = cmul((F.col("re"), F.col("im")), conj(cis(phase)))
    return df.withColumns({"re": re, "im": im})


def beamform(df: DataFrame, group: list[str], phase: Column) -> DataFrame:
    """Per group the weighted mean of the samples after fringestop(): re, im, w."""
    stopped = fringestop(df, phase)
    mean = lambda c: (F.sum(F.col("w") * F.col(c)) * inv0(F.sum("w"))).alias(c)
    return stopped.groupBy(*group).agg(mean("re"), mean("im"), F.sum("w").alias("w"))


def project_out(df: DataFrame, group: list[str], phase: Column) -> DataFrame:
    """Samples less the beam that their group forms, turned back to each sample's phase."""
    beam = beamform(df, group, phase).select(*group, F.col("re").alias("_br"), F.col("im").alias("_bi"))
    model = cmul((F.col("_br"), F.col("_bi")), cis(phase))
    joined = df.join(beam, group)
    return joined.withColumns({"re": F.col("re") - model[0], "im": F.col("im") - model[1]}).select(*df.columns)


def radiometer_weight(products: DataFrame, autos: DataFrame) -> DataFrame:
    """products (input_a, input_b, w) with w over both inputs' temperatures, their autocorrelations (input_id, temperature);
    0 for an input without one."""
    side = lambda x: autos.select(F.col("input_id").alias(f"input_{x}"), F.col("temperature").alias(f"_{x}"))
    joined = products.join(side("a"), "input_a", "left").join(side("b"), "input_b", "left")
    known = lambda x: inv0(F.coalesce(f"_{x}", F.lit(0.0)))
    return joined.withColumn("w", F.col("w") * known("a") * known("b")).select(*products.columns)


def samples_to_weight(df: DataFrame, max_samples: float, max_weight: float) -> DataFrame:
    """w from its stored scale (0 to max_weight) to a number of samples."""
    return df.withColumn("w", F.col("w") * (max_samples / max_weight))


def apply_digital_gain(gain: DataFrame, digital: DataFrame, on: list[str], invert: bool = False, normalize: bool = False) -> DataFrame:
    """gain times the digital gain in force at its update, w over its square; no digital gain leaves zero weight.

    normalize divides each update of digital gains by the median of its amplitudes that are not 0; invert takes one
    over them, after that."""
    if normalize:
        size = F.sqrt(abs2((F.col("re"), F.col("im"))))
        middle = digital.groupBy("update_t").agg(F.percentile(F.when(size > 0, size), F.lit(0.5)).alias("_middle"))
        scale = inv0(F.coalesce("_middle", F.lit(0.0)))
        digital = digital.join(middle, "update_t").withColumns({c: F.col(c) * scale for c in ("re", "im")}).drop("_middle")
    if invert:
        re, im = cinv0((F.col("re"), F.col("im")))
        digital = digital.withColumns({"re": re, "im": im})
    found = _found(gain, digital, on, "update_t", "update_t", ["re", "im"], True, False)
    d = (F.coalesce("_before.re", F.lit(0.0)), F.coalesce("_before.im", F.lit(0.0)))
    re, im = cmul((F.col("re"), F.col("im")), d)
    return found.select(*(c for c in gain.columns if c not in ("re", "im", "w")), re.alias("re"), im.alias("im"), (F.col("w") * inv0(abs2(d))).alias("w"))


def interpolate_held(df: DataFrame, updates: DataFrame, on: list[str], t: str, update_t: str, value: str, name: str) -> DataFrame:
    """df with the value interpolated linearly between the updates before and after t; the ends hold."""
    found = _found(df, updates, on, t, update_t, [value], True, True)
    a, b = F.col("_before"), F.col("_after")
    p = (F.col(t) - a["at"]) * inv0(b["at"] - a["at"])
    between = F.when(a.isNull(), b[value]).when(b.isNull(), a[value]).otherwise(a[value] + p * (b[value] - a[value]))
    return found.select(*df.columns, between.alias(name))


def inputs_at(layout: DataFrame, key: list[str], update_t: str, t: float, values: list[str]) -> DataFrame:
    """Per key the values of the layout row in force at t; keys without one are left out."""
    last = F.max_by(F.struct(*values), update_t).alias("_v")
    return layout.where(F.col(update_t) <= t).groupBy(*key).agg(last).select(*key, *(F.col(f"_v.{v}").alias(v) for v in values))


def aligned_join(a: DataFrame, b: DataFrame, on: list[str], name: str) -> DataFrame:
    """a joined to b's column `name` on identical axes; a cell that only one side has is an error when rows are read."""
    left = a.withColumn("_a", F.lit(True))
    both = left.join(b.select(*on, name).withColumn("_b", F.lit(True)), on, "full")
    same = F.when(F.col("_a") & F.col("_b"), F.lit(True)).otherwise(F.raise_error(F.lit("axes differ")).cast("boolean"))
    return both.where(same).drop("_a", "_b")


def sun_distance(t: Column, longitude: float) -> Column:
    """Degrees of hour angle from the Sun's transit, in [-180, 180)."""
    return wrap(stellar_angle(t, longitude) - sun(t)[0])


def mask_sun(df: DataFrame, mhz: Column, longitude: float, nsigma: float = 2.0) -> DataFrame:
    """w = 0 within nsigma beam widths of the Sun's transit."""
    sigma = F.degrees(beam_sigma(mhz, sun(F.col("t"))[1], F.lit("X")))
    near = F.abs(sun_distance(F.col("t"), longitude)) <= nsigma * sigma
    return df.withColumn("w", F.when(near, 0.0).otherwise(F.col("w")))


def exclude_sun(df: DataFrame, longitude: float, seconds: float) -> DataFrame:
    """Rows further than `seconds` from the Sun's transit."""
    return df.where(F.abs(sun_distance(F.col("t"), longitude)) / 360.0 * SIDEREAL_DAY > seconds)


def run_files(runs: DataFrame, files: DataFrame, name: str) -> DataFrame:
    """Files of the one active run of a name: those of its acquisition that overlap its span. No run, or several, is
    an error when rows are read."""
    chosen = runs.where((F.col("run_name") == name) & F.col("active"))
    one = F.when(F.count("*") == 1, F.min(F.struct("acq_id", "run_start", "run_finish"))).otherwise(F.raise_error(F.lit("not exactly one active run")).cast("struct<acq_id:bigint,run_start:double,run_finish:double>"))
    run = chosen.agg(one.alias("r")).select("r.*")
    return files.join(F.broadcast(run), "acq_id").where("start_t < run_finish AND finish_t >= run_start").select(*files.columns)


def index_files(copies: DataFrame, files: DataFrame, acquisitions: DataFrame, nodes: list[int]) -> DataFrame:
    """Distinct files with a copy, their acquisition's type, and whether one of the online nodes has a copy."""
    held = copies.where("has_file").groupBy("file_id").agg(F.max(F.col("node").isin(nodes)).alias("online"))
    return files.join(held, "file_id").join(acquisitions.select("acq_id", "acqtype").distinct(), "acq_id").select("file_id", "acq_id", "acqtype", "online")


def select_transit(df: DataFrame, axis: list[str], offset: Column, width: Column, on: float = 1.0, share: float = 0.6) -> DataFrame:
    """w kept within on * width / 2 of the beam centre and where x is `share` or more of its axis's largest there."""
    near = F.abs(offset) < on * width / 2
    most = F.max(F.when(near, F.col("x"))).over(Window.partitionBy(*axis))
    return df.withColumn("w", F.when(near & (F.col("x") >= share * most), F.col("w")).otherwise(0.0))


def doppler(mhz: Column, km_s: Column) -> Column:
    """A frequency seen from a frame that moves away at a speed."""
    return mhz * (1 - km_s / 299792.458)


def grid_indices(products: DataFrame, x_step: float, y_step: float) -> DataFrame:
    """products with whole separations (xi, yi) and `unique_id`, equal for equal separations of a polarisation."""
    rows = products.withColumns({"xi": F.round(F.col("dx") / x_step).cast("long"), "yi": F.round(F.col("dy") / y_step).cast("long")})
    keys = rows.select("pol", "xi", "yi").distinct()
    keys = keys.withColumn("unique_id", F.row_number().over(Window.partitionBy("pol").orderBy("xi", "yi")).cast("long"))
    return rows.join(keys, ["pol", "xi", "yi"])


def half_hanning(distance: Column, n: int) -> Column:
    """The rising half of a Hanning window of 2 n - 1 points: 0 at distance 0, 1 from n - 1 on."""
    return F.when(distance >= n - 1, 1.0).otherwise(0.5 * (1 - F.cos(math.pi * distance / (n - 1))))
