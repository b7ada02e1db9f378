"""Single-linkage clusters of points in scaled space, and spectral lines as clusters of outlying map pixels."""

from __future__ import annotations

import math
from functools import reduce
from itertools import product as every

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions.scalar import LINE_MHZ, inv0
from meridian.operators.rounds import components, written


def _cell(axes: list[str], side: float) -> Column:
    return F.array(*(F.floor(F.col(a) / side).cast("long") for a in axes))


def _total(terms: list[Column]) -> Column:
    return reduce(lambda x, y: x + y, terms)


def _least_gap(axes: list[str]) -> Column:
    """Squared distance of two bounding boxes (low, high; _low, _high)."""
    gap = lambda a: F.greatest(F.col(f"_low_{a}") - F.col(f"high_{a}"), F.col(f"low_{a}") - F.col(f"_high_{a}"), F.lit(0.0))
    return _total([gap(a) * gap(a) for a in axes])


def _most_gap(axes: list[str]) -> Column:
    far = lambda a: F.greatest(F.col(f"_high_{a}") - F.col(f"low_{a}"), F.col(f"high_{a}") - F.col(f"_low_{a}"))
    return _total([far(a) * far(a) for a in axes])


def single_linkage(points: DataFrame, key: str, axes: list[str], cut: float, parts: int = 4) -> DataFrame:
    """key, cluster (its least key): points that a chain of steps of at most `cut` joins; axes are scaled coordinates.

    Points lie in cells whose diagonal is just under the cut, so a cell is one cluster by itself and only cells are
    linked. Cells near each other meet by the bounding boxes of their parts (parts per axis, so at most
    parts ** len(axes) boxes a cell, however many points): boxes wholly within the cut link their cells, boxes beyond
    it do not. Only where no box pair settles two cells, points of boxes that straddle the cut meet one by one, with
    repeated positions taken once. Null coordinates link nothing; an empty table gives no rows."""
    side = cut / math.sqrt(len(axes)) * (1 - 1e-12)
    known = _total([F.col(a).isNull().cast("int") for a in axes]) == 0
    placed = points.select(key, *(F.col(a).cast("double").alias(a) for a in axes)).withColumns({"cell": F.when(known, _cell(axes, side)), "part": F.when(known, _cell(axes, side / parts))})
    placed = written(placed)
    spots = placed.where("cell is not null").groupBy("cell", "part", *axes).agg(F.min(key).alias(key))
    boxes = written(spots.groupBy("cell", "part").agg(*(c for a in axes for c in (F.min(a).alias(f"low_{a}"), F.max(a).alias(f"high_{a}")))))
    reach = math.ceil(cut / side)
    steps = [s for s in every(range(-reach, reach + 1), repeat=len(axes)) if s > (0,) * len(axes)]
    near = F.explode(F.array(*(F.array(*(F.get("cell", k) + F.lit(d).cast("long") for k, d in enumerate(s))) for s in steps)))
    # Cells first, so that boxes meet only where both cells have any.
    cells = boxes.select("cell").distinct()
    pairs = cells.select("cell", near.alias("_cell")).join(cells.withColumnRenamed("cell", "_cell"), "_cell", "left_semi")
    other = boxes.select(F.col("cell").alias("_cell"), F.col("part").alias("_part"), *(F.col(f"{e}_{a}").alias(f"_{e}_{a}") for a in axes for e in ("low", "high")))
    met = pairs.join(boxes, "cell").join(other, "_cell").where(_least_gap(axes) <= cut * cut).withColumn("sure", _most_gap(axes) <= cut * cut)
    met = written(met.select("cell", "part", "_cell", "_part", "sure"))
    sure = met.where("sure").select("cell", "_cell").distinct()
    open_ = met.join(sure, ["cell", "_cell"], "left_anti")
    there = spots.select(F.col("cell").alias("_cell"), F.col("part").alias("_part"), *(F.col(a).alias(f"_{a}") for a in axes))
    apart = _total([(F.col(a) - F.col(f"_{a}")) * (F.col(a) - F.col(f"_{a}")) for a in axes])
    close = open_.join(spots, ["cell", "part"]).join(there, ["_cell", "_part"]).where(apart <= cut * cut).select("cell", "_cell").distinct()

    first = placed.where("cell is not null").groupBy("cell").agg(F.min(key).alias("least"))
    name = lambda cell, out: first.select(F.col("cell").alias(cell), F.col("least").alias(out))
    edges = sure.union(close).join(name("cell", "a"), "cell").join(name("_cell", "b"), "_cell").select("a", "b")
    groups = components(edges, first.select("least"), "least")
    found = placed.join(first, "cell", "left").join(groups, "least", "left")
    return found.select(key, F.coalesce("component", F.col(key)).alias("cluster"))


def polarisation_mean(pixels: DataFrame, pixel: list[str]) -> DataFrame:
    """pixel, val, w, bad: the inverse-variance mean over polarisations; bad where every polarisation's is."""
    mean = F.sum(F.col("w") * F.col("val")) * inv0(F.sum("w"))
    return pixels.groupBy(*pixel).agg(mean.alias("val"), F.sum("w").alias("w"), F.min("bad").alias("bad"))


def spectral_lines(
    pixels: DataFrame, key: str, mhz: str, ra: str, el: str, scales: tuple[Column, Column, Column], latitude: float, channel_mhz: float, nsigma: float = 2.0
) -> DataFrame:
    """line, mhz, mhz_error, ra, dec, z, z_error, depth, s2n, n_pixels: clusters of outlying pixels of a filtered map.

    pixels (key, mhz, ra, el, val, w, bad) are means over polarisations; those that are bad in all are clustered, each
    coordinate over its scale, with a cut of nsigma. A line stands where its pixel of the most |val| sqrt(w) is (ties:
    the least key), takes that pixel's value for its depth, and is named by its least key. Declination is the zenith
    angle's plus the latitude (degrees); redshift as of the 21 cm line."""
    axes = ["_f", "_r", "_e"]
    out = pixels.where("bad").withColumns({a: F.col(c) / s for a, c, s in zip(axes, (mhz, ra, el), scales)})
    out = written(out)
    members = out.join(single_linkage(out, key, axes, nsigma).withColumnRenamed("cluster", "line"), key)
    s2n = F.abs("val") * F.sqrt("w")
    peak = F.max_by(F.struct(F.col(mhz).alias("mhz"), F.col(ra).alias("ra"), F.col(el).alias("el"), "val", s2n.alias("s2n")), F.struct(s2n, -F.col(key)))
    lines = members.groupBy("line").agg(peak.alias("_p"), F.count("*").alias("n_pixels"))
    at = F.col("_p.mhz")
    return lines.select(
        "line", at.alias("mhz"), F.lit(channel_mhz).alias("mhz_error"), F.col("_p.ra").alias("ra"), (F.degrees(F.asin("_p.el")) + latitude).alias("dec"),
        (LINE_MHZ / at - 1).alias("z"), (LINE_MHZ * channel_mhz / (at * at)).alias("z_error"), F.col("_p.val").alias("depth"), F.col("_p.s2n").alias("s2n"), "n_pixels",
    )


def line_scales(mhz: Column, el: Column, latitude: float, delay_cutoff: float, beam_degrees: float, beam_mhz: float, max_y: float) -> tuple[Column, Column, Column]:
    """One standard deviation of a point source in MHz, right ascension and sine of zenith angle.

    In frequency that of a width of one over the delay cutoff (microseconds); in right ascension that of the primary
    beam (beam_degrees across at beam_mhz) at the source's declination; in elevation that of baselines up to max_y."""
    sigma = 2.35482
    dec = F.asin(el) + math.radians(latitude)
    return F.lit(1.0 / (sigma * delay_cutoff)), beam_degrees * beam_mhz / mhz / (sigma * F.cos(dec)), 0.85 * 299.792458 / mhz / (sigma * max_y)
