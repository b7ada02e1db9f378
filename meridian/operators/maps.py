"""Maps from stacked streams, flattened spectra, holographic beams, masks from gain errors and tapers round sources."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.scalar import cinv0, cis, cmul, cosine_taper, inv0, modulo
from meridian.operators.calibration import doppler, half_hanning
from meridian.operators.joins import asof_join
from meridian.operators.windows import interpolate


def flatten_spectra(df: DataFrame, channel: list[str], time: str, shape: Column, prior: float = 1e4, legacy_weight: bool = False) -> DataFrame:
    """Spectra x less their level and over their gain along a known shape, both fitted per channel over all times.

    Each time has a free amplitude of the shape with a variance of prior squared, which is marginalised out; gain and
    level have priors of the same width. w turns into w times (gain * shape) squared, or stays with legacy_weight.
    """
    rows = df.withColumn("_s", shape)
    s, w, x = F.col("_s"), F.col("w"), F.col("x")
    sums = rows.groupBy(*channel, time).agg(*(F.sum(e).alias(n) for n, e in (("ww", s * s * w), ("zw", s * w), ("zz", w), ("wd", s * w * x), ("zd", w * x))))
    # 1 - k ww as 1 / (1 + prior^2 ww), which loses no digits.
    left = 1 / (1 + prior**2 * F.col("ww"))
    k = prior**2 * left
    terms = {"c00": F.col("ww") * left, "c01": F.col("zw") * left, "c11": F.col("zz") - k * F.col("zw") * F.col("zw"), "d0": F.col("wd") * left, "d1": F.col("zd") - k * F.col("zw") * F.col("wd")}
    fit = sums.groupBy(*channel).agg(*(F.sum(e).alias(n) for n, e in terms.items()))
    c00, c11 = F.col("c00") + prior**-2, F.col("c11") + prior**-2
    scale = inv0(c00 * c11 - F.col("c01") * F.col("c01"))
    fit = fit.select(*channel, ((F.col("d0") * c11 - F.col("d1") * F.col("c01")) * scale).alias("_a"), ((c00 * F.col("d1") - F.col("c01") * F.col("d0")) * scale).alias("_b"))
    gain = F.col("_a") * s
    out = rows.join(fit, channel).withColumns({"x": (x - F.col("_b")) * inv0(gain), "w": w if legacy_weight else w * gain * gain})
    return out.select(*df.columns)


def ring_map(vis: DataFrame, group: list[str], y: Column, elevations: list[float], beams: int) -> DataFrame:
    """group, pol (XX, YY, reXY, imXY), beam, el_id, value, dirty: the map of a stacked stream and its dirty beam.

    vis: group, pol, xind, re, im, weight; y: north separation in wavelengths. Sums over y come first, one row per
    xind and elevation, then a Fourier sum over xind of `beams` east-west beams. Parallel hands are doubled for the
    baselines not stored; the two crossed ones join into one complex map.
    """
    els = F.explode(F.array(*(F.struct(F.lit(k).cast("long").alias("el_id"), F.lit(e).alias("el")) for k, e in enumerate(elevations)))).alias("_e")
    turn = cis(-2 * math.pi * y * F.col("_e.el"))
    v = cmul((F.col("re"), F.col("im")), turn)
    total = lambda e, n: F.sum(F.col("weight") * e).alias(n)
    columns = total(v[0], "vr"), total(v[1], "vi"), total(turn[0], "dr"), total(turn[1], "di")
    north = vis.select("*", els).groupBy(*group, "pol", "xind", F.col("_e.el_id").alias("el_id")).agg(*columns)

    east = north.withColumn("beam", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(beams - 1).cast("long"))))
    phase = cis(2 * math.pi / beams * F.col("xind") * F.col("beam"))
    map_, dirty = cmul((F.col("vr"), F.col("vi")), phase), cmul((F.col("dr"), F.col("di")), phase)
    row = lambda pol, a, b: F.struct(F.lit(pol).alias("pol"), a.alias("value"), b.alias("dirty"))
    own = F.array(F.struct(F.col("pol"), (2 * map_[0]).alias("value"), (2 * dirty[0]).alias("dirty")))
    sign = F.when(F.col("pol") == "XY", 1.0).otherwise(-1.0)
    crossed = F.array(row("reXY", map_[0], dirty[0]), row("imXY", sign * map_[1], sign * dirty[1]))
    parts = east.select(*group, "beam", "el_id", F.explode(F.when(F.col("pol").isin("XX", "YY"), own).otherwise(crossed)).alias("_p"))
    return parts.groupBy(*group, F.col("_p.pol").alias("pol"), "beam", "el_id").agg(F.sum("_p.value").alias("value"), F.sum("_p.dirty").alias("dirty"))


def holography_beam(products: DataFrame, inputs: DataFrame, references: dict[int, str], axis: list[str]) -> DataFrame:
    """reference, input_id, pol (co or cross), axis, re, im, w: the products with one of the reference inputs.

    references: polarisation by input, one of each. Values are conjugated where the reference comes first. Two
    products of one reference and input at one place of the axis are an error when rows are read.
    """
    if len(references) != 2:
        raise ValueError("exactly two reference inputs are needed")
    first, second = F.col("input_a").isin(list(references)), F.col("input_b").isin(list(references))
    rows = products.where(first != second).select(
        F.when(first, F.col("input_a")).otherwise(F.col("input_b")).alias("reference"), F.when(first, F.col("input_b")).otherwise(F.col("input_a")).alias("input_id"),
        *axis, "re", F.when(first, -F.col("im")).otherwise(F.col("im")).alias("im"), "w",
    )
    held = F.coalesce(*(F.when(F.col("reference") == k, F.lit(p)) for k, p in references.items()))
    named = rows.join(inputs.select("input_id", F.col("pol").alias("_pol")), "input_id").withColumn("pol", F.when(F.col("_pol") == held, "co").otherwise("cross"))
    copies = F.count("*").over(Window.partitionBy("reference", "input_id", *axis))
    one = F.when(copies == 1, F.lit(True)).otherwise(F.raise_error(F.lit("several products of one reference and input")).cast("boolean"))
    return named.withColumn("_one", one).where("_one").select("reference", "input_id", "pol", *axis, "re", "im", "w")


def gain_error_mask(points: DataFrame, errors: DataFrame, on: list[str], t: str, update_t: str, transition: float, slot: list[str], threshold: float) -> DataFrame:
    """slot, error, bad: points whose mean gain error over days is over a threshold.

    errors: on, update_t, error, w by input; an update's error is the weighted mean over its inputs. A point takes
    the larger in size of the updates in force at t and `transition` before it (the earlier one if they are equal),
    slots (such as channel and time of day) take the mean of their points. A point before the first update is an
    error when rows are read; one that only its transition puts before it takes the update in force.
    """
    mean = (F.sum(F.col("w") * F.col("error")) * inv0(F.sum("w"))).alias("error")
    updates = errors.groupBy(*on, update_t).agg(mean)
    now = asof_join(points, updates, on, t, update_t, {"_now": "error"})
    both = asof_join(now.withColumn("_t0", F.col(t) - transition), updates, on, "_t0", update_t, {"_then": "error"})
    known = F.when(F.col("_now").isNull(), F.raise_error(F.lit("a point comes before the first gain update")).cast("double")).otherwise(F.col("_now"))
    larger = F.when(F.abs(known) > F.abs(F.coalesce("_then", known * 0)), known).otherwise(F.coalesce("_then", known))
    return both.groupBy(*slot).agg(F.avg(larger).alias("error")).withColumn("bad", F.abs("error") > threshold)


def taper_sources(pixels: DataFrame, catalog: DataFrame, ra_step: float, el_step: float, el_start: float, dra: float, del_: float, n_ra: int, width: float = 1.0) -> DataFrame:
    """w times, for each source (source_id, ra, el), 1 less a cosine taper of the pixel's distance in units of the
    source's window (dra, del_): 0 up to 1, 1 from 1 + width on. Round the ring a pixel takes its nearest distance.

    Sources meet pixels by pixel numbers, so the join is by key.
    """
    reach = 1 + width
    boxes = catalog.select(
        "source_id", "ra", "el", F.explode(F.sequence(F.floor((F.col("ra") - reach * dra) / ra_step), F.ceil((F.col("ra") + reach * dra) / ra_step))).alias("_r"),
        F.sequence(F.floor((F.col("el") - reach * del_ - el_start) / el_step), F.ceil((F.col("el") + reach * del_ - el_start) / el_step)).alias("_l"),
    )
    cells = boxes.select("source_id", "ra", "el", "_r", F.explode("_l").alias("el_id"))
    dx, dy = (F.col("_r") * ra_step - F.col("ra")) / dra, (F.col("el_id") * el_step + el_start - F.col("el")) / del_
    near = cells.groupBy("source_id", F.pmod("_r", F.lit(n_ra)).alias("ra_id"), "el_id").agg(F.min(F.sqrt(dx * dx + dy * dy)).alias("_d"))
    kept = near.groupBy("ra_id", "el_id").agg(F.product(1 - cosine_taper((F.col("_d") - 1) / width)).alias("_kept"))
    return pixels.join(kept, ["ra_id", "el_id"], "left").withColumn("w", F.col("w") * F.coalesce("_kept", F.lit(1.0))).select(*pixels.columns)


def thermal_gain(df: DataFrame, t: str, transition: float, slope: Column) -> DataFrame:
    """df with gain, 1 + slope * (temperature - reference temperature), and samples divided by it.

    df has temperature, change_t, reference and previous: the temperatures now, at the reference transit in force
    since change_t, and at the one before (null: none). For `transition` after a change the gain goes from the
    previous one to the current one as a squared cosine. Without a reference the gain is 1; a gain that is not a
    number leaves zeros.
    """
    of = lambda c: 1 + slope * (F.col("temperature") - F.col(c))
    past = F.pow(F.cos(math.pi / 2 * F.least(F.lit(1.0), (F.col(t) - F.col("change_t")) / transition)), 2)
    blend = F.when(F.col("previous").isNull(), of("reference")).otherwise(of("previous") * past + of("reference") * (1 - past))
    gain = F.when(F.col("reference").isNull(), F.lit(1.0)).otherwise(blend)
    good = gain.isNotNull() & ~F.isnan(gain)
    out = df.withColumn("gain", F.when(good, gain).otherwise(0.0))
    k = cinv0((F.col("gain"), F.lit(0.0)))[0]
    return out.withColumns({"re": F.col("re") * k, "im": F.col("im") * k, "w": F.col("w") * F.col("gain") * F.col("gain")})


def align_beams(df: DataFrame, axis: list[str], ra: str, value: str, hour_angle: Column) -> DataFrame:
    """df with its value and w read at the same right ascensions once each beam's samples are moved by its hour angle.

    Linear between the moved samples, round the circle: of each series the first and the last also stand a turn away.
    """
    moved = df.select(*axis, modulo(F.col(ra) - hour_angle, 360.0).alias(ra), value, "w")
    row = F.struct(ra, value, "w")
    ends = moved.groupBy(*axis).agg(F.min(row).alias("_low"), F.max(row).alias("_high"))
    beyond = lambda c, turn: F.struct((F.col(c)[ra] + turn).alias(ra), F.col(c)[value].alias(value), F.col(c)["w"].alias("w"))
    copies = ends.select(*axis, F.explode(F.array(beyond("_low", 360.0), beyond("_high", -360.0))).alias("_c")).select(*axis, "_c.*")
    return interpolate(df.drop(value, "w"), moved.unionByName(copies), axis, ra, value).select(*df.columns)


def doppler_shift(df: DataFrame, axis: list[str], mhz: str, value: str, km_s: Column, day: str | None = None) -> DataFrame:
    """Spectra read at the frequencies that a frame moving at km_s sees, linear between channels; beyond them x and w are 0.

    With day, df must hold one day alone: one speed can't stand for several.
    """
    if day is not None:
        span = df.agg(F.min(day).alias("a"), F.max(day).alias("b")).first()
        if span["a"] != span["b"]:
            raise ValueError("several days need a time of their own for the speed")
    grid = df.withColumns({"_own": F.col(mhz), mhz: doppler(F.col(mhz), km_s)}).drop(value, "w")
    out = interpolate(grid, df.select(*axis, mhz, value, "w"), axis, mhz, value)
    return out.withColumn(mhz, F.col("_own")).select(*df.columns)


def taper_mask(df: DataFrame, axis: list[str], position: str, size: int, mask: str, n: int, outer: bool = False) -> DataFrame:
    """df with taper: the mask (1 or 0), on either side of each of its steps times half a Hanning window of n cells.

    The windows go into the mask, round the ring of `size` cells; with outer they go out of it.
    """
    on = ~F.col(mask) if outer else F.col(mask)
    rows = df.withColumn("_on", on.cast("double"))
    step = rows.withColumn("_d", F.col("_on") - F.lag("_on").over(Window.partitionBy(*axis).orderBy(position))).where("_d <> 0")
    # A rise at p is 0 at p - 1 and grows from there; a fall at p is 0 at p and grows backwards.
    at = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_j")
    ramps = step.select(*axis, position, "_d", at).withColumn("_p", F.when(F.col("_d") > 0, F.col(position) - 1 + F.col("_j")).otherwise(F.col(position) - F.col("_j")))
    factors = ramps.groupBy(*axis, F.pmod("_p", F.lit(size)).alias(position)).agg(F.product(half_hanning(F.col("_j"), n)).alias("_f"))
    taper = F.col("_on") * F.coalesce("_f", F.lit(1.0))
    return rows.join(factors, [*axis, position], "left").withColumn("taper", 1 - taper if outer else taper).select(*df.columns, "taper")


def valid_sizes(vis: DataFrame, key: list[str]) -> DataFrame:
    """key, size, n: the summed absolute values and the number of the valid samples (re, im, w) at each key."""
    size = F.when(F.col("w") > 0, F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im")))
    return vis.groupBy(*key).agg(F.sum(size).alias("size"), F.count(size).alias("n"))


def decorrelated_cylinders(sizes: DataFrame, products: DataFrame, on: list[str], cylinders: int, threshold: float) -> DataFrame:
    """on, bad: whether the samples without some cylinder are `threshold` times those with it, in the median.

    sizes: prod_id, on, size, n as of valid_sizes(), so that samples are summed before they meet their products and
    cylinders. products (prod_id, pol, yind, cyl_a, cyl_b) join neighbouring cylinders; those of one (pol, yind) are
    copies, and only such with cylinders - 1 of them count. The median is over (pol, yind) with valid samples on both
    sides; where there is none, bad is false.
    """
    copies = F.count("*").over(Window.partitionBy("pol", "yind"))
    whole = products.withColumn("_n", copies).where(F.col("_n") == cylinders - 1).drop("_n")
    each = F.when(F.col("cyl_a").isNotNull(), F.sequence(F.lit(0).cast("long"), F.lit(cylinders - 1).cast("long")))
    cells = sizes.join(whole, "prod_id", "left").withColumn("_c", F.explode_outer(each))
    held = (F.col("_c") == F.col("cyl_a")) | (F.col("_c") == F.col("cyl_b"))
    mean = lambda c: F.try_divide(F.sum(F.when(c, F.col("size"))), F.sum(F.when(c, F.col("n"))))
    means = cells.groupBy(*on, "pol", "yind", "_c").agg(mean(held).alias("_with"), mean(~held).alias("_without"))
    ratio = F.when(F.col("_with").isNotNull() & F.col("_without").isNotNull(), F.col("_without") * inv0(F.col("_with")))
    ratios = means.groupBy(*on, "_c").agg(F.percentile(ratio, F.lit(0.5)).alias("_m"))
    return ratios.groupBy(*on).agg(F.coalesce(F.max(F.col("_m") > threshold), F.lit(False)).alias("bad"))


def spread_to_slots(df: DataFrame, slot: list[str], most: float) -> DataFrame:
    """bad also for all rows of a slot of which more than a share `most` is bad."""
    share = F.avg(F.col("bad").cast("double")).over(Window.partitionBy(*slot))
    return df.withColumn("bad", F.col("bad") | (share > most))


def channel_range(df: DataFrame, freq_id: str, low: float, high: float) -> DataFrame:
    """Channels from the one nearest to the frequency `high` up to, not including, the one nearest to `low` (MHz)."""
    first, end = (round((800.0 - f) / 400.0 * 1024.0) for f in (high, low))
    return df.where((F.col(freq_id) >= first) & (F.col(freq_id) < end))


def regrid_transit(df: DataFrame, axis: list[str], ra: str, source_ra: float, samples: int = 1024, ha_span: float = 180.0) -> DataFrame:
    """axis, sample, ha, re, im, w: each series read at `samples` cell centres of hour angle round a source's transit.

    Linear between a series' samples; w and values are 0 outside its coverage.
    """
    ha = modulo(F.col(ra) - source_ra + 180.0, 360.0) - 180.0
    rows = df.select(*axis, ha.alias("ha"), "re", "im", "w")
    grid = rows.select(*axis).distinct().select(*axis, F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("sample"))
    grid = grid.withColumn("ha", ha_span * ((F.col("sample") + 0.5) / samples - 0.5))
    return interpolate(grid, rows, axis, "ha", ["re", "im"])


def fit_delays(df: DataFrame, series: list[str], x: str, phase: str, sigmas: list[float]) -> DataFrame:
    """df with delay, offset and kept: per series the weighted line phase = offset + delay * x, fitted once for each
    of `sigmas`, after which samples further off than so many weighted standard deviations lose their place.

    Passes are windows over one partitioning, so the table is shuffled once. Samples of no weight aren't kept; a
    series whose kept samples have one x has delay 0.
    """
    window = Window.partitionBy(*series)
    rows = df.withColumn("kept", F.col("w") > 0)
    for most in (*sigmas, None):
        w = F.when(F.col("kept"), F.col("w")).otherwise(0.0)
        mean = lambda e: F.sum(w * e).over(window) * inv0(F.sum(w).over(window))
        rows = rows.withColumns({"_mx": mean(F.col(x)), "_my": mean(F.col(phase))})
        dx, dy = F.col(x) - F.col("_mx"), F.col(phase) - F.col("_my")
        rows = rows.withColumns({"_cov": mean(dx * dy), "_var": mean(dx * dx)})
        rows = rows.withColumn("delay", F.when(F.col("_var") > 1e-12 * F.col("_mx") * F.col("_mx"), F.col("_cov") / F.col("_var")).otherwise(0.0)).withColumn("offset", F.col("_my") - F.col("delay") * F.col("_mx"))
        if most is not None:
            rows = rows.withColumn("_r", F.col(phase) - F.col("offset") - F.col("delay") * F.col(x))
            rows = rows.withColumn("kept", F.col("kept") & (F.abs("_r") <= most * F.sqrt(mean(F.col("_r") * F.col("_r")))))
    return rows.select(*df.columns, "delay", "offset", "kept")


def good_fits(fits: DataFrame, series: list[str], item: list[str], least_kept: float = 0.85, least_passed: float = 0.5) -> DataFrame:
    """item, good: whether more than least_passed of an item's series kept least_kept of their samples or more."""
    passed = fits.groupBy(*series, *(c for c in item if c not in series)).agg(F.avg(F.col("kept").cast("double")).alias("_s"))
    return passed.groupBy(*item).agg((F.avg((F.col("_s") >= least_kept).cast("double")) > least_passed).alias("good"))
