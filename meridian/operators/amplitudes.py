"""Which gains stand out by their amplitude, and narrowband features of one input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.operators.windows import rolling_outliers


def _median(x: Column | str) -> Column:
    return F.percentile(x, F.lit(0.5))


def flag_amplitudes(
    gain: DataFrame, update: list[str], least: float = 0.05, most: float = 20.0, nsigma: float = 10.0, nsigma_median: float = 10.0, half: int = 12,
    good_channel: float = 0.7, good_input: float = 0.8, least_channels: float = 0.0,
) -> DataFrame:
    """gain (update, freq_id, input_id, pol, re, im, w) with w = 0 for amplitudes that stand out, in this order:

    beyond `least` and `most` times the update's median; over nsigma scaled median deviations, of each side apart,
    from the median of the channel and polarisation; in a channel whose median stands out from `half` channels on
    both sides; in channels of which good_channel or less is left, and in inputs of which good_input or less of the
    good channels is left. An update of which less than least_channels of the channels are good gives no rows.
    Groups are one update of the instrument: channels times inputs, whatever the length of the table.
    """
    group = [*update, "freq_id", "pol"]
    rows = gain.withColumn("_a", F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im"))).withColumn("_ok", F.col("w") > 0)
    ok = lambda e=F.col("_a"): F.when(F.col("_ok"), e)

    middle = rows.groupBy(*update).agg(_median(ok()).alias("_m"))
    rows = rows.join(middle, update).withColumn("_ok", F.col("_ok") & (F.col("_a") >= least * F.col("_m")) & (F.col("_a") <= most * F.col("_m"))).drop("_m")

    cell = Window.partitionBy(*group)
    rows = rows.withColumn("_m", _median(ok()).over(cell))
    off = F.col("_a") - F.col("_m")
    rows = rows.withColumns({"_low": _median(ok(F.when(off < 0, -off))).over(cell), "_high": _median(ok(F.when(off > 0, off))).over(cell)})
    inside = (off >= -nsigma * 1.4826 * F.coalesce("_low", F.lit(0.0))) & (off <= nsigma * 1.4826 * F.coalesce("_high", F.lit(0.0)))
    rows = rows.withColumn("_ok", F.col("_ok") & inside).drop("_m", "_low", "_high")

    medians = rows.groupBy(*group).agg(_median(ok()).alias("_m")).where("_m IS NOT NULL")
    apart = rolling_outliers(medians, [*update, "pol"], "freq_id", half, nsigma_median, "_m").select(*group, "bad")
    rows = rows.join(apart, group, "left").withColumn("_ok", F.col("_ok") & ~F.coalesce("bad", F.lit(True))).drop("bad")

    share = F.avg(F.col("_ok").cast("double"))
    channels = rows.groupBy(*update, "freq_id").agg((share > good_channel).alias("_fine"))
    enough = channels.groupBy(*update).agg(F.avg(F.col("_fine").cast("double")).alias("_s")).where(F.col("_s") >= least_channels).drop("_s")
    rows = rows.join(channels, [*update, "freq_id"]).join(enough, update)
    inputs = rows.where("_fine").groupBy(*update, "input_id").agg((share > good_input).alias("_kept"))
    rows = rows.join(inputs, [*update, "input_id"], "left")
    good = F.col("_ok") & F.col("_fine") & F.coalesce("_kept", F.lit(False))
    return rows.withColumn("w", F.when(good, F.col("w")).otherwise(0.0)).select(*gain.columns)


def narrowband_features(gain: DataFrame, series: list[str], order: str, half: int = 75, threshold: float = 6.0) -> DataFrame:
    """gain with w = 0 where an amplitude stands out from the rolling median of its series; samples of no weight
    neither count nor change."""
    size = F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im"))
    rows = gain.withColumn("_a", F.when(F.col("w") > 0, size))
    out = rolling_outliers(rows, series, order, half, threshold, "_a")
    return out.withColumn("w", F.when(F.coalesce("bad", F.lit(False)), 0.0).otherwise(F.col("w"))).select(*gain.columns)
