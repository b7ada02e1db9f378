"""Readers of acquisitions and side tables by path, and the keyed sink of products."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The columns of each kind of acquisition file.
ACQUISITIONS = {
    "hk": "t double, sensor string, value double",
    "hkp": "t double, metric string, labels map<string,string>, value double",
    "weather": "t double, rain double, temperature double",
    "rawadc": "t double, input_id long, rms double",
    "gain": "update_t double, input_id long, freq_id long, re double, im double, w double, update_kind string",
    "digitalgain": "update_t double, input_id long, freq_id long, re double, im double",
    "flaginput": "update_t double, input_id long, good boolean",
}


def read_acq(spark: SparkSession, paths: list[str], kind: str) -> DataFrame:
    """Parquet files of one kind of acquisition with its columns; an unknown kind is a ValueError."""
    if kind not in ACQUISITIONS:
        raise ValueError(f"unknown acquisition type {kind!r}, known: {', '.join(ACQUISITIONS)}")
    return spark.read.schema(ACQUISITIONS[kind]).parquet(*paths)


def read_dim(spark: SparkSession, path: str, max_rows: int = 1_000_000) -> DataFrame:
    """A side table, marked for broadcast if it has max_rows rows or fewer."""
    dim = spark.read.parquet(path)
    return F.broadcast(dim) if dim.limit(max_rows + 1).count() <= max_rows else dim


def read_by_tag(df: DataFrame, root: str, tag: str = "lsd") -> DataFrame:
    """The rows of a side product, partitioned by tag under root, whose tag df has: partitions of other tags aren't read."""
    side = df.sparkSession.read.parquet(root)
    return side.join(df.select(tag).distinct(), tag, "left_semi")


def write_product(df: DataFrame, path: str, tag: str = "lsd") -> None:
    """Write df by tag, replacing the tags that df has and leaving all others."""
    df.write.partitionBy(tag).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_vis(
    spark: SparkSession, paths: list[str], mhz: list[float] | None = None, channel_range: list[int] | None = None, channel_index: list[int] | None = None, only_autos: bool = False,
    columns: list[str] | None = None, top_mhz: float = 800.0, width_mhz: float = 400.0 / 1024, channels: int = 1024,
) -> DataFrame:
    """Visibility files (freq_id, input_a, input_b, t, re, im, w): the channels nearest to some frequencies, or else a
    range (start, stop[, step]), or else numbers; autocorrelations alone if asked for; some columns if named.

    Files without w get 0 where the visibility is 0 and 255 elsewhere. Choices become predicates of the scan."""
    rows = spark.read.parquet(*paths)
    if mhz:
        rows = rows.where(F.col("freq_id").isin(sorted({min(max(round((top_mhz - x) / width_mhz), 0), channels - 1) for x in mhz})))
    elif channel_range:
        rows = rows.where(F.col("freq_id").isin(list(range(*channel_range)))) if len(channel_range) == 3 else rows.where((F.col("freq_id") >= channel_range[0]) & (F.col("freq_id") < channel_range[1]))
    elif channel_index:
        rows = rows.where(F.col("freq_id").isin(sorted(set(channel_index))))
    if only_autos:
        rows = rows.where(F.col("input_a") == F.col("input_b"))
    if "w" not in rows.columns:
        rows = rows.withColumn("w", F.when((F.col("re") == 0) & (F.col("im") == 0), 0.0).otherwise(255.0))
    return rows.select(*columns) if columns else rows


def read_spectra(
    spark: SparkSession, paths: list[str], time_range: tuple[float, float] | None = None, mhz_range: tuple[float, float] | None = None, mhz_list: list[float] | None = None,
    beams: list[int] | None = None, top_mhz: float = 800.0, width_mhz: float = 400.0 / 1024, channels: int = 1024, day_zero: float | None = None, day_seconds: float = 86164.0989,
) -> DataFrame:
    """Rows of many spectrum files (t, freq_id, beam, ...) within times, channels and beams; with day_zero also lsd and
    the calendar date of each file's middle.

    Bounds become plain comparisons with numbers, so files and row groups beyond them are not read: times are half
    open; a range of frequencies runs from the channel nearest its higher end up to, not including, that nearest its
    lower end; a list takes the nearest channel of each; the range goes before the list. An empty list of beams or
    frequencies reads nothing; a range in the wrong order is turned round."""
    rows = spark.read.option("mergeSchema", "false").parquet(*paths)
    nearest = lambda mhz: min(max(round((top_mhz - mhz) / width_mhz), 0), channels - 1)
    if time_range is not None:
        rows = rows.where((F.col("t") >= float(time_range[0])) & (F.col("t") < float(time_range[1])))
    if mhz_range is not None:
        low, high = nearest(max(mhz_range)), nearest(min(mhz_range))
        rows = rows.where((F.col("freq_id") >= low) & (F.col("freq_id") < high))
    elif mhz_list is not None:
        rows = rows.where(F.col("freq_id").isin(sorted({nearest(x) for x in mhz_list})))
    if beams is not None:
        rows = rows.where(F.col("beam").isin(sorted(set(beams))))
    if day_zero is None:
        return rows
    rows = rows.withColumn("_file", F.col("_metadata.file_path"))
    middle = rows.groupBy("_file").agg(((F.min("t") + F.max("t")) / 2).alias("_t"))
    lsd = F.floor((F.col("_t") - day_zero) / day_seconds).cast("long")
    date = F.date_format(F.timestamp_seconds("_t"), "yyyyMMdd")
    return rows.join(middle, "_file").withColumns({"lsd": lsd, "date": date}).drop("_file", "_t")
