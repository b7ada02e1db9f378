"""Bookkeeping queries over file, flag, day and job relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.operators.joins import overlap_join
from meridian.operators.windows import islands

DAY = 86400.0


def find_files(files: DataFrame, start: float, finish: float, acqtype: str = "corr") -> DataFrame:
    return files.where((F.col("acqtype") == acqtype) & F.col("has_file") & (F.col("start_t") < finish) & (F.col("finish_t") >= start))


def contiguous_runs(files: DataFrame, axis: list[str], gap: float) -> DataFrame:
    """Runs of files without a gap: their number and span."""
    runs = islands(files, axis, "start_t", gap, "finish_t")
    return runs.groupBy(*axis, "island").agg(F.count("*").alias("n_files"), F.min("start_t").alias("start_t"), F.max("finish_t").alias("finish_t"))


def group_acquisitions(files: DataFrame, most: int, least: int = 1) -> DataFrame:
    """file_id, acq_id, group_id: an acquisition's files in groups of a size near `most` whose rest is small.

    Over `most` files, the size is `most` if its rest is under accept = max(1, most / 10). Else both neighbours are
    tried, one step further out each time, until the rest of either is accept or less; of the two the one with the
    smaller rest holds, the larger size if they are equal. Half of the rest goes before the first group and the ends
    take what is over.
    """
    order = Window.partitionBy("acq_id").orderBy("start_t", "file_id")
    rows = files.withColumns({"_i": F.row_number().over(order) - 1, "_n": F.count("*").over(Window.partitionBy("acq_id"))}).where(F.col("_n") >= least)
    accept, n = max(1, most // 10), F.col("_n")
    steps = F.sequence(F.lit(1), F.lit(most - 1)) if most > 1 else F.array().cast("array<int>")
    fits = F.filter(steps, lambda k: (n % (most - k) <= accept) | (n % (most + k) <= accept))
    k = F.get(fits, F.lit(0))
    away = F.when(n % (most - k) < n % (most + k), most - k).otherwise(most + k)
    size = F.when(n <= most, n).when(n % most < accept, most).otherwise(F.coalesce(away, F.lit(most)))
    rows = rows.withColumn("_m", size)
    groups = F.greatest(F.floor(n / F.col("_m")), F.lit(1))
    at = F.floor((F.col("_i") - F.floor((n % F.col("_m")) / 2)) / F.col("_m"))
    return rows.select("file_id", "acq_id", F.least(F.greatest(at, F.lit(0)), groups - 1).alias("group_id"))


def files_of_days(days: DataFrame, files: DataFrame, width: float = DAY) -> DataFrame:
    """(day, file) pairs for days (day, start, finish) and the files that overlap them."""
    return overlap_join(files, days, "start_t", "finish_t", "start", "finish", width)


def available_days(days: DataFrame, files: DataFrame, coverage: float, width: float = DAY) -> DataFrame:
    """Days whose files, whole, and whose online files cover more than a share of a day."""
    length = F.col("finish_t") - F.col("start_t")
    sums = files_of_days(days, files, width).groupBy("day").agg(
        F.sum(length).alias("all_s"), F.sum(F.when(F.col("online"), length).otherwise(0.0)).alias("online_s"), F.count("*").alias("n_files")
    )
    return sums.where(F.col("all_s") > coverage * DAY).withColumn("online", F.col("online_s") > coverage * DAY)


def flagged_days(days: DataFrame, flags: DataFrame, share: float, width: float) -> DataFrame:
    """(day, flag_type) whose flags, clipped to the day and merged, cover more than a share of it."""
    met = overlap_join(flags, days, "start_t", "finish_t", "start", "finish", width)
    clipped = met.withColumns({"a": F.greatest("start_t", "start"), "b": F.least("finish_t", "finish")})
    runs = islands(clipped, ["day", "flag_type"], "a", 0.0, "b")
    spans = runs.groupBy("day", "flag_type", "start", "finish", "island").agg((F.max("b") - F.min("a")).alias("s"))
    total = spans.groupBy("day", "flag_type", "start", "finish").agg(F.sum("s").alias("flagged_s"))
    return total.where(F.col("flagged_s") > share * (F.col("finish") - F.col("start"))).select("day", "flag_type", "flagged_s")


def filter_existing(files: DataFrame, done: DataFrame, least: int, day: float) -> DataFrame:
    """Files of days that aren't done and have enough files; a file counts in its first and its last day."""
    days = files.withColumn("day", F.explode(F.array_distinct(F.array(F.floor(F.col("start_t") / day), F.floor(F.col("finish_t") / day)))))
    left = days.join(done.select("day").distinct(), "day", "left_anti")
    enough = left.groupBy("day").agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    return left.join(enough, "day", "left_semi").select("file_id").distinct()


def classify_logs(logs: DataFrame, patterns: dict[str, str], tail: int = 30000) -> DataFrame:
    """The first class whose pattern is in the log's last `tail` bytes; unknown without any.

    A character that the cut goes through counts as U+FFFD.
    """
    raw = F.col("log").cast("binary")
    text, found = F.substring(raw, F.greatest(F.octet_length(raw) - tail + 1, F.lit(1)), F.lit(tail)).cast("string"), F.lit("unknown")
    for name, pattern in reversed(patterns.items()):
        found = F.when(text.rlike(pattern), name).otherwise(found)
    return logs.select("tag", found.alias("class"))


def next_jobs(jobs: DataFrame, now: float, most: int, day: float = DAY, pad: float = 0.0) -> DataFrame:
    """The first `most` jobs to run: retries first, then new ones by start, of days older than 1 + pad days."""
    old = jobs.where(F.lit(now) - F.col("start_t") > (1 + pad) * day)
    return old.orderBy(F.when(F.col("retry"), 0).otherwise(1), "start_t", "file_id").limit(most)


def job_status(available: DataFrame, finished: DataFrame, pending: DataFrame, running: DataFrame, crashed: DataFrame) -> DataFrame:
    """(tag, status) by set algebra over tag relations, in one union and one aggregation."""
    names = ("available", "finished", "pending", "running", "crashed")
    sets = [d.select("tag", F.lit(n).alias("s")) for n, d in zip(names, (available, finished, pending, running, crashed))]
    rows = sets[0]
    for x in sets[1:]:
        rows = rows.unionByName(x)
    has = {n: F.max((F.col("s") == n).cast("int")).alias(n) for n in names}
    flags = rows.groupBy("tag").agg(*has.values())
    active = (F.col("finished") + F.col("pending") + F.col("running")) > 0
    status = F.when(F.col("finished") == 1, "finished").when(F.col("running") == 1, "running").when(F.col("pending") == 1, "pending")
    status = status.when((F.col("crashed") == 1) & ~active, "failed").when(F.col("available") == 1, "not_submitted").otherwise("not_available")
    return flags.select("tag", status.alias("status"))


def duplicate_jobs(jobs: DataFrame) -> DataFrame:
    """Jobs to cancel: of one name, running beats queued, less time left beats more, earlier beats later."""
    order = Window.partitionBy("name").orderBy(F.when(F.col("state") == "running", 0).otherwise(1), F.when(F.col("state") == "running", F.col("left_s")), "submit_t", "job_id")
    return jobs.withColumn("_k", F.row_number().over(order)).where("_k > 1").drop("_k")


def quarter_partitions(opinions: DataFrame, quarter: Column, n: int, least: int) -> DataFrame:
    """lsd, quarter, part of days with a good and no bad opinion; quarters of under least * n days go."""
    good = opinions.groupBy("lsd").agg(F.max((F.col("decision") == "good").cast("int")).alias("g"), F.max((F.col("decision") == "bad").cast("int")).alias("b"))
    days = good.where("g = 1 AND b = 0").select("lsd", quarter.alias("quarter"))
    order = Window.partitionBy("quarter")
    rows = days.withColumns({"_n": F.count("*").over(order), "part": (F.row_number().over(order.orderBy("lsd")) - 1) % n})
    return rows.where(F.col("_n") >= least * n).drop("_n")


def fullstack_groups(parts: DataFrame, year: Column) -> DataFrame:
    """Numbers of days for the whole stack, each part and each part and year."""
    rows = parts.withColumn("year", year)
    names = F.array(F.lit("all"), F.concat(F.lit("part"), "part"), F.concat(F.lit("part"), "part", F.lit("_"), "year"))
    return rows.select("lsd", F.explode(names).alias("stack")).groupBy("stack").agg(F.count("*").alias("n_days"), F.min("lsd").alias("first"), F.max("lsd").alias("last"))
