"""As-of, nearest and interval joins without nested loops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _found(left: DataFrame, right: DataFrame, on: list[str], left_t: str, right_t: str, values: list[str], before: bool, after: bool) -> DataFrame:
    """left with _before and _after: structs of right_t and values of the last right row at or before each left row
    and of the first at or after it. One shuffle on the keys; ties of right_t go to the largest values.

    Both are the last row seen in a running frame, one in rising and one in falling order of time: a frame that
    grows by a row at a time is linear, one that shrinks is not.
    """
    rows = F.struct(F.col(right_t).alias("at"), *(F.col(v).alias(v) for v in values))
    both = left.withColumns({"_t": F.col(left_t).cast("double"), "_side": F.lit(True)}).unionByName(
        right.select(*on, F.col(right_t).cast("double").alias("_t"), F.lit(False).alias("_side"), rows.alias("_right")), allowMissingColumns=True
    )
    seen = lambda *order: F.last("_right", ignorenulls=True).over(Window.partitionBy(*on).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    if before:
        both = both.withColumn("_before", seen("_t", "_side", "_right"))
    if after:
        both = both.withColumn("_after", seen(F.desc("_t"), "_side", "_right"))
    return both.where("_side").select(*left.columns, *["_before"] * before, *["_after"] * after)


def asof_join(left: DataFrame, right: DataFrame, on: list[str], left_t: str, right_t: str, values: dict[str, str], direction: str = "backward") -> DataFrame:
    """left with values {new name: right column} of the right row in force; null where there is none.

    direction: backward (last row at or before), forward (first at or after) or nearest (ties to the earlier).
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(f"unknown direction {direction!r}")
    found = _found(left, right, on, left_t, right_t, list(dict.fromkeys(values.values())), direction != "forward", direction != "backward")
    if direction == "nearest":
        earlier = F.col("_after").isNull() | (F.col(left_t) - F.col("_before")["at"] <= F.col("_after")["at"] - F.col(left_t))
        pick = F.when(F.col("_before").isNotNull() & earlier, F.col("_before")).otherwise(F.col("_after"))
    else:
        pick = F.col("_after" if direction == "forward" else "_before")
    return found.withColumn("_pick", pick).select(*left.columns, *(F.col("_pick")[c].alias(n) for n, c in values.items()))


def nearest_key(left: DataFrame, right: DataFrame, x: str, y: str, value: str, width: float) -> DataFrame:
    """left with the value of the right row whose y is nearest to x; ties go to the smaller y, then the smaller value.

    Right rows are kept once per bucket of y (the outermost two of each) so that a bucket without rows sees the next
    one that has some: the boundary rows alone pass through an ordered window, everything else meets by bucket.
    """
    buckets = right.withColumn("_b", F.floor(F.col(y) / width).cast("long"))
    edge = F.struct(F.col(y).alias("y"), F.col(value).alias("v"))
    # Largest y of each bucket with the smallest value there, and the smallest y likewise: two rows a bucket.
    tops = buckets.groupBy("_b").agg(F.min(edge).alias("low"), F.max(F.struct(F.col(y).alias("y"), (-F.col(value)).alias("v"))).alias("top"))
    tops = tops.select("_b", "low", F.struct(F.col("top")["y"].alias("y"), (-F.col("top")["v"]).alias("v")).alias("high"))
    spots = left.select(x).distinct().withColumn("_b", F.floor(F.col(x) / width).cast("long"))
    order = Window.orderBy("_b")
    grid = tops.select("_b", "low", "high").unionByName(spots.select("_b").distinct(), allowMissingColumns=True).groupBy("_b").agg(F.min("low").alias("low"), F.min("high").alias("high"))
    ends = grid.withColumns({
        "before": F.last("high", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)),
        "after": F.last("low", ignorenulls=True).over(Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)),
    })
    inside = spots.join(buckets.select("_b", edge.alias("c")), "_b")
    outside = spots.join(ends, "_b").select(x, F.explode(F.array("before", "after")).alias("c")).where("c is not null")
    best = inside.select(x, "c").union(outside).groupBy(x).agg(F.min(F.struct(F.abs(F.col("c")["y"] - F.col(x)).alias("d"), F.col("c")["y"].alias("y"), F.col("c")["v"].alias("v"))).alias("best"))
    return left.join(best.select(x, F.col("best")["v"].alias(value)), x, "left")


def _buckets(start: Column, finish: Column, width: float) -> Column:
    return F.explode(F.sequence(F.floor(start / width), F.floor(finish / width)))


def interval_join(points: DataFrame, intervals: DataFrame, t: str, start: str, finish: str, width: float, how: str = "inner", extra: Column | None = None) -> DataFrame:
    """Points joined to the closed intervals that hold them, by buckets of `width`; extra: a further condition.

    A point has one bucket, so no pair comes twice.
    """
    held = intervals.withColumn("_ib", _buckets(F.col(start), F.col(finish), width))
    on = (F.col("_pb") == F.col("_ib")) & (F.col(t) >= F.col(start)) & (F.col(t) <= F.col(finish))
    dealt = points.withColumn("_pb", F.floor(F.col(t) / width))
    return dealt.join(held, on if extra is None else on & extra, how).drop("_pb", "_ib")


def _chunk_pairs(
    points: DataFrame, intervals: DataFrame, t: str, start: str, finish: str, width: float, meets: Column, sure: Column, each: Column, by: tuple[str, ...] = (), least: str | None = None, chunk: int = 256
) -> DataFrame:
    """Columns of intervals and of points for the pairs that pass `each`, by buckets of `width`.

    The points of a bucket (and of equal `by`, whose columns the conditions may name) are laid in order of t and cut
    into chunks. An interval meets chunks, not points: `meets` and `sure` look at a chunk's _low and _high (of t) and
    _least (of `least`), and the points of one that is `sure` need no test. So the join's work is that of its chunks,
    and a pair costs no more than its row."""
    order = Window.partitionBy("_pb", *by).orderBy(t)
    inner = [c for c in points.columns if c not in by]
    dealt = points.where(F.col(t).isNotNull()).withColumn("_pb", F.floor(F.col(t) / width)).withColumn("_no", F.floor((F.row_number().over(order) - 1) / chunk))
    bounds = [F.min(t).alias("_low"), F.max(t).alias("_high"), F.min(least or t).alias("_least")]
    chunks = dealt.groupBy("_pb", *by, "_no").agg(*bounds, F.collect_list(F.struct(*inner)).alias("_rows"))
    held = intervals.withColumn("_ib", _buckets(F.col(start), F.col(finish), width))
    met = held.join(chunks, (F.col("_pb") == F.col("_ib")) & meets)
    met = met.select(*intervals.columns, *by, sure.alias("_sure"), F.explode("_rows").alias("_row"))
    return met.select(*intervals.columns, *by, "_sure", *(F.col(f"_row.{c}").alias(c) for c in inner)).where(F.col("_sure") | each).drop("_sure")


def interval_pairs(points: DataFrame, intervals: DataFrame, t: str, start: str, finish: str, width: float, by: tuple[str, ...] = (), extra: Column | None = None) -> DataFrame:
    """interval_join() for results of very many pairs; extra may name columns of the intervals and those of the points
    in `by`. No column may be in both tables."""
    within = F.col(t).between(F.col(start), F.col(finish))
    meets = (F.col("_low") <= F.col(finish)) & (F.col("_high") >= F.col(start))
    sure = (F.col(start) <= F.col("_low")) & (F.col("_high") <= F.col(finish))
    return _chunk_pairs(points, intervals, t, start, finish, width, meets if extra is None else meets & extra, sure, within, by)


def overlap_join(a: DataFrame, b: DataFrame, a_start: str, a_finish: str, b_start: str, b_finish: str, width: float) -> DataFrame:
    """Pairs with a_start < b_finish and a_finish >= b_start, each once; no column may be in both tables.

    Of a pair, either b starts within a, or a starts later than b and within it: two joins of starts with intervals."""
    a, b = a.where(F.col(a_start).isNotNull() & F.col(a_finish).isNotNull()), b.where(F.col(b_start).isNotNull() & F.col(b_finish).isNotNull())
    low, high, least = F.col("_low"), F.col("_high"), F.col("_least")
    a0, a1, b0, b1 = (F.col(c) for c in (a_start, a_finish, b_start, b_finish))
    meets, sure = (low <= a1) & (high >= a0), (a0 <= low) & (high <= a1) & (least > a0)
    later = _chunk_pairs(b, a, b_start, a_start, a_finish, width, meets, sure, (b0 >= a0) & (b0 <= a1) & (b1 > a0), least=b_finish)
    meets, sure = (low < b1) & (high > b0), (b0 < low) & (high < b1) & (least >= b0)
    sooner = _chunk_pairs(a, b, a_start, b_start, b_finish, width, meets, sure, (a0 > b0) & (a0 < b1) & (a1 >= b0), least=a_finish)
    return later.unionByName(sooner).select(*a.columns, *b.columns)


def box_join(points: DataFrame, boxes: DataFrame, x: str, y: str, bounds: tuple[str, str, str, str], widths: tuple[float, float], how: str = "inner") -> DataFrame:
    """Points joined to the closed boxes (bounds: names of x low and high, y low and high) that hold them.

    Boxes go to the cells of a grid (widths) that they touch, points have one cell each; so a pair comes once, and a
    box costs a row for each of its cells. Choose widths of about a box's size. Null coordinates or bounds meet nothing."""
    xl, xh, yl, yh = (F.col(b) for b in bounds)
    cells = boxes.where((xl <= xh) & (yl <= yh)).withColumn("_bx", F.explode(F.sequence(F.floor(xl / widths[0]), F.floor(xh / widths[0]))))
    cells = cells.withColumn("_by", F.explode(F.sequence(F.floor(yl / widths[1]), F.floor(yh / widths[1]))))
    dealt = points.withColumns({"_px": F.floor(F.col(x) / widths[0]), "_py": F.floor(F.col(y) / widths[1])})
    inside = (F.col(x) >= xl) & (F.col(x) <= xh) & (F.col(y) >= yl) & (F.col(y) <= yh)
    return dealt.join(cells, (F.col("_px") == F.col("_bx")) & (F.col("_py") == F.col("_by")) & inside, how).drop("_px", "_py", "_bx", "_by")


def first_overlap(spans: DataFrame, rows: DataFrame, a: str, b: str, start: str, finish: str, values: list[str], width: float) -> DataFrame:
    """spans with _first: of the rows with start < b and finish >= a the least struct (start, *values); null without one.

    Of all rows that end at or after a, the one that starts first overlaps the span if any does, so no pair is made:
    a running least in falling order of time within each bucket of `width`, and the least of the later buckets, of
    which there is one row each."""
    best = F.struct(start, *values)
    ends = rows.where(F.col(start).isNotNull()).select(F.floor(F.col(finish) / width).alias("_b"), F.col(finish).cast("double").alias("_t"), best.alias("_row")).where("_t is not null")
    asked = spans.withColumns({"_b": F.floor(F.col(a) / width), "_t": F.col(a).cast("double"), "_asked": F.lit(True)})
    both = asked.unionByName(ends.withColumn("_asked", F.lit(False)), allowMissingColumns=True)
    falling = Window.partitionBy("_b").orderBy(F.desc("_t"), "_asked").rowsBetween(Window.unboundedPreceding, 0)
    near = both.withColumn("_near", F.min("_row").over(falling)).where("_asked").drop("_row", "_asked", "_t")
    buckets = ends.select("_b", "_row").unionByName(asked.select("_b").distinct(), allowMissingColumns=True).groupBy("_b").agg(F.min("_row").alias("_row"))
    later = F.min("_row").over(Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1))
    met = near.join(buckets.select("_b", later.alias("_later")), "_b", "left").withColumn("_first", F.least("_near", "_later"))
    return met.select(*spans.columns, F.when(F.col(f"_first.{start}") < F.col(b), F.col("_first")).alias("_first"))
