"""Grouping by days and transits: the same functions take batch and streaming frames."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.scalar import inv0
from meridian.operators.joins import interval_join


def day_groups(df: DataFrame, day: Column, padding: float = 0.0, least_span: float = 0.0) -> DataFrame:
    """Samples by (fractional) day; with padding a sample counts in each day whose padded span holds it.

    On a stream give df a watermark on `ts`; state is one row of sums per day.
    """
    days = F.array_distinct(F.array(F.floor(day), F.floor(day - padding), F.floor(day + padding)))
    rows = df.withColumn("day", F.explode(F.transform(days, lambda x: x.cast("long"))))
    out = rows.groupBy("day").agg(F.count("*").alias("n"), F.min("t").alias("first_t"), F.max("t").alias("last_t"), F.sum("w").alias("w"))
    return out.where(F.col("last_t") - F.col("first_t") >= least_span)


def sessions(df: DataFrame, axis: list[str], gap_seconds: int) -> DataFrame:
    """Sessions of samples (column ts) no further apart than the gap, with weighted sums; works on streams."""
    window = F.session_window("ts", f"{gap_seconds} seconds")
    out = df.groupBy(*axis, window.alias("s")).agg(F.count("*").alias("n"), F.sum("w").alias("w"), F.sum(F.col("w") * F.col("re")).alias("wx"))
    return out.select(*axis, F.col("s.start").alias("start"), "n", "w", "wx")


def running_stack(df: DataFrame, cell: list[str]) -> DataFrame:
    """Weighted mean per cell; on a stream the state is its sums."""
    return df.groupBy(*cell).agg((F.sum(F.col("w") * F.col("re")) * inv0(F.sum("w"))).alias("re"), F.sum("w").alias("w"), F.count("*").alias("n"))


def on_time_and_late(batch: DataFrame, ts: Column, latest_before: float, allowed_seconds: float) -> tuple[DataFrame, DataFrame]:
    """A micro-batch's rows within and beyond the allowed lateness behind the latest event (epoch seconds) of the
    batches before it; for use inside foreachBatch, which keeps latest_before."""
    late = ts.cast("double") < latest_before - allowed_seconds
    return batch.where(~late), batch.where(late)


def gain_updates(gain: DataFrame, keep_transition: bool = False) -> DataFrame:
    """Gain updates as they come, those of transitions only if asked for; a missing weight is 1. Batch or stream."""
    kept = gain if keep_transition else gain.where(~F.col("update_kind").contains("transition"))
    return kept.withColumn("w", F.coalesce("w", F.lit(1.0)))


def accumulate(df: DataFrame, cell: list[str], values: list[str]) -> DataFrame:
    """Per cell the number of rows and each value's sum and largest; on a stream the state is those numbers."""
    return df.groupBy(*cell).agg(F.count("*").alias("n"), *(f(v).alias(f"{v}_{name}") for v in values for name, f in (("sum", F.sum), ("max", F.max))))


def acquisition_references(df: DataFrame, acquisition: str, order: str, value: str, name: str) -> DataFrame:
    """A stream's rows with `name`: the value less its acquisition's reference, which the acquisition's first
    micro-batch fixes (its row of the least `order`; ties to the least value) and state keeps for all later ones.

    State is one number per acquisition, so a new acquisition starts anew and a restart from the checkpoint goes on
    with what was fixed. Rows of a key are handled as they come in Arrow batches; the first of them are looked
    through for the reference before any is written."""
    fields = df.schema.fieldNames()

    def run(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.exists:
            (reference,) = state.get
        else:
            frames = list(frames)  # one acquisition's rows of one micro-batch
            first = min((tuple(x) for f in frames for x in f[[order, value]].itertuples(index=False)), default=None)
            if first is None:
                return
            reference = float(first[1])
            state.update((reference,))
        for frame in frames:
            yield frame.assign(**{name: frame[value] - reference})[[*fields, name]]

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    return df.groupBy(acquisition).applyInPandasWithState(run, f"{kinds}, {name} double", "reference double", "append", "NoTimeout")


def transit_groups(df: DataFrame, transits: DataFrame, runs: DataFrame, half_span: float, least_span: float = 0.0, day: float = 86400.0) -> DataFrame:
    """source, transit_t, run_id, start_t, finish_t, tag, n, w, wx: the samples (t, re, w) about each transit (source,
    transit_t), within half_span seconds and the observation run (run_id, start_t, finish_t) that holds the transit.

    A transit that no run holds is left out, as is one of which less than least_span remains; of several runs the
    least run_id serves. The tag is source and transit time. Sums come from running sums of the samples in each day,
    so that transits and samples that lie together cost no pairs."""
    held = interval_join(transits, runs.select("run_id", "start_t", "finish_t"), "transit_t", "start_t", "finish_t", day)
    first = held.groupBy("source", "transit_t").agg(F.min(F.struct("run_id", "start_t", "finish_t")).alias("_run"))
    start, finish = F.greatest(F.col("transit_t") - half_span, F.col("_run.start_t")), F.least(F.col("transit_t") + half_span, F.col("_run.finish_t"))
    windows = first.select("source", "transit_t", F.col("_run.run_id").alias("run_id"), start.alias("start_t"), finish.alias("finish_t"))
    windows = windows.where(F.col("finish_t") - F.col("start_t") >= least_span)
    tag = F.concat_ws("_", F.col("source").cast("string"), F.date_format(F.timestamp_seconds("transit_t"), "yyyyMMdd'T'HHmmss"))
    key = ["source", "transit_t", "run_id", "start_t", "finish_t"]
    sums = _sums_within(df.select("t", F.col("w").alias("w"), (F.col("w") * F.col("re")).alias("wx")), windows, key, ["w", "wx"], day)
    return sums.select(*key, "n", "w", "wx").withColumn("tag", tag)


def _sums_within(df: DataFrame, windows: DataFrame, key: list[str], values: list[str], day: float) -> DataFrame:
    """key, n and the sums of values (doubles) of the samples of df (t) within each of the windows (key, with start_t
    and finish_t among it); windows without samples are left out.

    A window asks each day it touches for the running sums at its two ends there, and takes their difference. Numbers
    that are not finite would stay in every later sum, so they are counted beside the others."""
    parts, odd = {"n": F.lit(1)}, [float("nan"), float("inf"), float("-inf")]
    for v in values:
        x = F.col(v).cast("double")
        finite = ~x.isin(*odd)
        parts |= {f"_sum_{v}": F.when(finite, x).otherwise(0.0), f"_some_{v}": x.isNotNull().cast("long")}
        parts |= {f"_{name}_{v}": F.coalesce((x == odd[k]).cast("long"), F.lit(0)) for k, name in enumerate(("nan", "up", "down"))}
    samples = df.where("t is not null AND NOT isnan(t)").select(F.floor(F.col("t") / day).alias("_b"), F.col("t").cast("double").alias("_t"), F.lit(1).alias("_side"), *(c.alias(n) for n, c in parts.items()))
    days = F.sequence(F.floor(F.col("start_t") / day), F.floor(F.col("finish_t") / day))
    asked = windows.where("start_t <= finish_t").select(F.struct(*key).alias("_key"), "start_t", "finish_t", F.explode(days).alias("_b"))
    # Ends are closed: a start comes before the samples of its time, a finish after them.
    ends = F.array(F.struct(F.col("start_t").cast("double").alias("_t"), F.lit(0).alias("_side")), F.struct(F.col("finish_t").cast("double").alias("_t"), F.lit(2).alias("_side")))
    asked = asked.select("_key", "_b", F.explode(ends).alias("_end")).select("_key", "_b", "_end.*")
    running = Window.partitionBy("_b").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = samples.unionByName(asked, allowMissingColumns=True)
    both = both.select("_key", "_side", *(F.coalesce(F.sum(n).over(running), F.lit(0)).alias(n) for n in parts)).where("_side <> 1")
    sign = F.when(F.col("_side") == 2, 1).otherwise(-1)
    met = both.groupBy("_key").agg(*(F.sum(sign * F.col(n)).alias(n) for n in parts)).where("n > 0")

    def whole(v: str) -> Column:
        mixed = (F.col(f"_nan_{v}") > 0) | ((F.col(f"_up_{v}") > 0) & (F.col(f"_down_{v}") > 0))
        out = F.when(mixed, odd[0]).when(F.col(f"_up_{v}") > 0, odd[1]).when(F.col(f"_down_{v}") > 0, odd[2]).otherwise(F.col(f"_sum_{v}"))
        return F.when(F.col(f"_some_{v}") > 0, out)

    return met.select("_key.*", "n", *(whole(v).alias(v) for v in values))
