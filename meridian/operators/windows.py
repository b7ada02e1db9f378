"""Neighbourhoods along an axis: rings, differences, filters, interpolation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.scalar import inv0


def ring(df: DataFrame, position: str, size: int, margin: int) -> DataFrame:
    """df with the rows near either end of a circular axis repeated beyond the other; _real marks the true rows."""
    p = F.col(position)
    real = df.withColumn("_real", F.lit(True))
    before = df.where(p >= size - margin).withColumns({position: p - size, "_real": F.lit(False)})
    after = df.where(p < margin).withColumns({position: p + size, "_real": F.lit(False)})
    return real.unionByName(before).unionByName(after)


def on_off(df: DataFrame, axis: list[str], position: str, size: int, offset: int, samples: int, value: str) -> DataFrame:
    """Value less the weighted mean of `samples` cells on both sides beyond `offset`, round a ring."""
    rows = ring(df, position, size, offset + samples)
    order = Window.partitionBy(*axis).orderBy(position)
    sides = (order.rangeBetween(-(offset + samples), -(offset + 1)), order.rangeBetween(offset + 1, offset + samples))
    both = lambda x: sum((F.coalesce(F.sum(x).over(s), F.lit(0.0)) for s in sides), F.lit(0.0))
    rows = rows.withColumns({"_w": both(F.col("w")), "_wx": both(F.col("w") * F.col(value))}).where("_real")
    ok = (F.col("w") > 0) & (F.col("_w") > 0)
    off = F.col("_wx") * inv0(F.col("_w"))
    weight = inv0(inv0(F.col("w")) + inv0(F.col("_w")))
    return rows.withColumns({value: F.when(ok, F.col(value) - off).otherwise(0.0), "w": F.when(ok, weight).otherwise(0.0)}).select(*df.columns)


def circular_difference(df: DataFrame, axis: list[str], position: str, size: int, lag: int, value: str) -> DataFrame:
    """Value less the mean of its neighbours `lag` cells away on a ring; null where a neighbour is missing."""
    rows = ring(df, position, size, lag)
    order = Window.partitionBy(*axis).orderBy(position)
    at = lambda k: F.first(value).over(order.rangeBetween(k, k))
    return rows.withColumn("diff", F.col(value) - (at(-lag) + at(lag)) / 2).where("_real").select(*df.columns, "diff")


def islands(df: DataFrame, axis: list[str], t: str, gap: float, end: str | None = None) -> DataFrame:
    """df with `island`, a number that grows by one where a row starts more than `gap` after all before it end."""
    order = Window.partitionBy(*axis).orderBy(t)
    reached = F.max(end or t).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = (reached.isNull() | (F.col(t) - reached > gap)).cast("long")
    return df.withColumn("_new", new).withColumn("island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def rolling_outliers(df: DataFrame, axis: list[str], order: str, half: int, nsigma: float, value: str) -> DataFrame:
    """bad where a value is over nsigma scaled median deviations from its rolling median."""
    window = Window.partitionBy(*axis).orderBy(order).rowsBetween(-half, half)
    rows = df.withColumn("_residual", F.abs(F.col(value) - F.percentile(value, F.lit(0.5)).over(window)))
    mad = F.percentile("_residual", F.lit(0.5)).over(window)
    return rows.withColumn("bad", F.col("_residual") > nsigma * 1.4826 * mad).drop("_residual")


def block_outliers(df: DataFrame, block: dict[str, Column], nsigma: float, value: str) -> DataFrame:
    """bad where a value is over nsigma scaled median deviations from its block's median."""
    rows = df.withColumns(block)
    window = Window.partitionBy(*block)
    rows = rows.withColumn("_residual", F.abs(F.col(value) - F.percentile(value, F.lit(0.5)).over(window)))
    mad = F.percentile("_residual", F.lit(0.5)).over(window)
    return rows.withColumn("bad", F.col("_residual") > nsigma * 1.4826 * mad).drop("_residual", *block)


def interpolate(grid: DataFrame, samples: DataFrame, axis: list[str], x: str, value: str | list[str]) -> DataFrame:
    """grid rows with the value (or values) interpolated linearly between the samples before and at or after x, and
    its weight.

    Weight 0 outside the samples and where either sample has none. One shuffle: both sides go through one window.
    """
    values = [value] if isinstance(value, str) else value
    pair = F.struct(F.col(x).alias("x"), *(F.col(v).alias(f"y_{v}") for v in values), F.col("w").alias("w"))
    both = grid.withColumns({"_grid": F.lit(1)}).unionByName(samples.select(*axis, x, F.lit(0).alias("_grid"), pair.alias("_s")), allowMissingColumns=True)
    seen = lambda *order: F.last("_s", ignorenulls=True).over(Window.partitionBy(*axis).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    # A sample at x itself is both neighbours' candidate: it comes before the grid row in the one order and in the other.
    low, high = seen(x, "_grid"), seen(F.desc(x), "_grid")
    rows = both.withColumns({"_low": low, "_high": high}).where("_grid = 1")
    a1 = (F.col("_high")["x"] - F.col(x)) * inv0(F.col("_high")["x"] - F.col("_low")["x"])
    ok = F.coalesce((F.col("_low")["w"] > 0) & (F.col("_high")["w"] > 0), F.lit(False))
    between = lambda v: a1 * F.col("_low")[f"y_{v}"] + (1 - a1) * F.col("_high")[f"y_{v}"]
    weight = inv0(a1 * a1 * inv0(F.col("_low")["w"]) + (1 - a1) * (1 - a1) * inv0(F.col("_high")["w"]))
    return rows.select(*grid.columns, *(F.when(ok, between(v)).otherwise(0.0).alias(v) for v in values), F.when(ok, weight).otherwise(0.0).alias("w"))


def trailing_sum(df: DataFrame, t: str, tie: str, value: str, n: int, width: float) -> DataFrame:
    """df with total: the sum of value over the last n rows by (t, tie), the row itself included, of the whole table.

    Rows are dealt into ranges of t of `width`. Each range takes the n - 1 rows before it along: those it needs from
    earlier ranges are named by the ranges' row counts alone, so no task holds more than a range and its halo.
    """
    rows = df.withColumn("_r", F.floor(F.col(t) / width).cast("long"))
    back = Window.partitionBy("_r").orderBy(F.desc(t), F.desc(tie))
    # A range's last n - 1 rows may be wanted by later ranges, as long as the ranges between hold fewer rows.
    ends = rows.select("_r", t, tie, value, F.row_number().over(back).alias("_back")).where(F.col("_back") < n)
    order = Window.orderBy("_r")
    counts = rows.groupBy("_r").agg(F.count("*").alias("_c")).withColumn("_upto", F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    before = counts.select("_r", "_c", (F.col("_upto") - F.col("_c")).alias("_start"), F.collect_list(F.struct("_r", "_upto")).over(order.rowsBetween(-(n - 1), -1)).alias("_past"))
    halo = before.select("_r", "_start", F.explode("_past").alias("_p")).where(F.col("_start") - F.col("_p._upto") < n - 1)
    halo = halo.select(F.col("_r").alias("_to"), F.col("_p._r").alias("_r"), (F.col("_start") - F.col("_p._upto")).alias("_between"))
    taken = ends.join(halo, "_r").where(F.col("_back") + F.col("_between") < n).select(F.col("_to").alias("_r"), t, tie, value, F.lit(False).alias("_own"))
    both = rows.withColumn("_own", F.lit(True)).unionByName(taken, allowMissingColumns=True)
    total = F.sum(value).over(Window.partitionBy("_r").orderBy(t, tie).rowsBetween(-(n - 1), 0))
    return both.withColumn("total", total).where("_own").select(*df.columns, "total")


def weighted_median(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """First value at which the summed weight passes half; the mean with the next one where it is half exactly."""
    order = Window.partitionBy(*group).orderBy(value, "w")
    rows = df.where("w > 0").withColumns({
        "_cum": F.sum("w").over(order.rowsBetween(Window.unboundedPreceding, 0)),
        "_all": F.sum("w").over(Window.partitionBy(*group)),
        "_next": F.lead(value).over(order),
    })
    hit = F.when(F.col("_cum") * 2 == F.col("_all"), (F.col(value) + F.col("_next")) / 2).when(F.col("_cum") * 2 > F.col("_all"), F.col(value))
    return rows.groupBy(*group).agg(F.min_by(hit, F.when(hit.isNotNull(), F.struct("_cum", value))).alias("median"))


def _padded(df: DataFrame, position: str, size: int, margin: int, mode: str) -> DataFrame:
    """df with its axis of whole positions carried on beyond both ends by `margin`, wrapped or mirrored without the edge."""
    if mode not in ("wrap", "reflect"):
        raise ValueError(f"unknown mode {mode!r}")
    period = size if mode == "wrap" or size == 1 else 2 * (size - 1)
    p = F.col(position)
    turns = F.sequence(F.lit(-(margin // period) - 1), F.lit((size + margin) // period + 1))
    places = F.transform(turns, lambda k: p + k * period)
    if mode == "reflect" and size > 1:
        inner = (p > 0) & (p < size - 1)  # the ends are their own mirror images
        places = F.when(inner, F.concat(places, F.transform(turns, lambda k: k * period - p))).otherwise(places)
    places = F.filter(places, lambda x: (x >= -margin) & (x < size + margin))
    return df.withColumn(position, F.explode(F.transform(places, lambda x: x.cast("long"))))


def kz_low_pass(
    df: DataFrame, axis: list[str], positions: tuple[str, str], sizes: tuple[int, int], value: str, windows: tuple[int, int] = (3, 5), rounds: tuple[int, int] = (12, 8),
    modes: tuple[str, str] = ("reflect", "wrap"), least: float = 0.4, keep: Column | None = None,
) -> DataFrame:
    """axis, positions, value, w of every cell of a grid: a moving mean in two directions, `rounds` times each.

    Boxes of odd width (an even one is made wider by one) over positions 0 to size - 1, ends mirrored or wrapped;
    samples without weight or rows don't count, and a cell is 0 with w = 0 where less than `least` of the kernel falls
    on samples. Where `keep` (a condition on value and _original) holds, the cell keeps its own value, as inside a
    source's main lobe. Each direction is one shuffle: its boxes are window sums over one order, one upon another,
    whatever the number of rounds, and no cell meets its kernel's samples in a join."""
    a, b = positions
    cells = df.select(*axis).distinct() if axis else df.sparkSession.range(1).select()
    grid = cells.withColumn(a, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(sizes[0] - 1).cast("long")))).withColumn(b, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(sizes[1] - 1).cast("long"))))
    key = [*axis, a, b]
    sums = df.where((F.col("w") > 0) & F.col(value).isNotNull()).groupBy(*key).agg(F.sum(value).alias("_v"), F.count("*").cast("double").alias("_n"))
    rows = grid.join(sums, key, "left").select(*key, (F.coalesce("_v", F.lit(0.0)) * inv0(F.coalesce("_n", F.lit(0.0)))).alias("_s"), F.when(F.col("_n") > 0, 1.0).otherwise(0.0).alias("_f"))
    rows = rows.withColumn("_own", F.when(F.col("_f") > 0, F.col("_s")))
    for k, position in enumerate(positions):
        half = windows[k] // 2
        order = Window.partitionBy(*axis, positions[1 - k]).orderBy(position).rangeBetween(-half, half)
        rows = _padded(rows, position, sizes[k], half * rounds[k], modes[k])
        for _ in range(rounds[k]):
            rows = rows.withColumns({c: F.sum(c).over(order) / (2 * half + 1) for c in ("_s", "_f")})
        rows = rows.where((F.col(position) >= 0) & (F.col(position) < sizes[k]))
    enough = F.col("_f") >= least * (1 - 1e-12)
    out = rows.select(*key, F.when(enough, F.col("_s") * inv0(F.col("_f"))).otherwise(0.0).alias(value), F.when(enough, 1.0).otherwise(0.0).alias("w"), F.col("_own").alias("_original"))
    if keep is not None:
        kept = F.coalesce(keep & F.col("_original").isNotNull(), F.lit(False))
        out = out.withColumns({value: F.when(kept, F.col("_original")).otherwise(F.col(value)), "w": F.when(kept, 1.0).otherwise(F.col("w"))})
    return out.drop("_original")
