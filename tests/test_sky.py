"""Operators on hand-made rows, and registered queries against their SQL at the smallest scale."""

import cmath
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from meridian.functions import scalar as X
from meridian.operators import aggregates as A
from meridian.operators import maps as M
from meridian.operators import masks as D
from meridian.operators import windows as W
from meridian.operators import index as Q
from meridian.operators.joins import asof_join, interval_join, nearest_key, overlap_join
from meridian.plans import calibration_queries, catalogue_queries, gain_queries, instrument_queries, map_queries, queries, solver_queries, stream_queries  # noqa: F401
from meridian.plans.registry import ORACLES, QUERIES
from meridian.sources.fixtures import TABLES
from meridian.streaming import groups as T

DATA = "/root/testdata/sf0.001"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_inv0_and_complex(spark):
    df = spark.sql("SELECT 0.0D AS z, 4.0D AS x, 3.0D AS re, -4.0D AS im")
    g = X.cinv0((F.col("re"), F.col("im")))
    got = df.select(X.inv0(F.col("z")), X.inv0(F.col("x")), g[0], g[1], X.wrap(F.lit(190.0))).first()
    assert got[:2] == (0.0, 0.25) and math.isclose(got[2], 0.12) and math.isclose(got[3], 0.16) and got[4] == -170.0


def test_nan_to_num(spark):
    df = spark.createDataFrame([(1, float("nan"), 1.0, 2.0), (2, 1.0, float("inf"), 2.0), (3, 1.0, 1.0, float("nan")), (4, 1.0, 2.0, 3.0)], "i int, re double, im double, w double")
    assert rows(D.nan_to_num(df), "i", "re", "im", "w") == [(1, 0.0, 0.0, 0.0), (2, 0.0, 0.0, 0.0), (3, 1.0, 1.0, 0.0), (4, 1.0, 2.0, 3.0)]


def test_asof_directions(spark):
    left = spark.createDataFrame([(1, 0.5), (1, 1.0), (1, 1.6), (1, 9.0), (2, 1.0)], "k int, t double")
    right = spark.createDataFrame([(1, 1.0, "a"), (1, 2.0, "b")], "k int, u double, v string")
    find = lambda d: [r[2] for r in rows(asof_join(left, right, ["k"], "t", "u", {"v": "v"}, d), "k", "t", "v")]
    assert find("backward") == [None, "a", "a", "b", None]
    assert find("forward") == ["a", "a", "b", None, None]
    assert find("nearest") == ["a", "a", "b", "b", None]


def test_interval_edges(spark):
    points = spark.createDataFrame([(x,) for x in (0.0, 1.0, 2.5, 3.0, 3.1)], "t double")
    spans = spark.createDataFrame([(1, 1.0, 3.0), (2, 2.0, 2.6)], "id int, a double, b double")
    assert rows(interval_join(points, spans, "t", "a", "b", 0.7), "t", "id") == [(1.0, 1), (2.5, 1), (2.5, 2), (3.0, 1)]
    other = spark.createDataFrame([(7, 3.0, 4.0), (8, 2.9, 4.0), (9, 0.0, 1.0)], "o int, c double, d double")
    # half-open as documented: a span that ends where the other begins still meets it, not the other way round
    assert rows(overlap_join(spans, other, "a", "b", "c", "d", 0.7), "id", "o") == [(1, 7), (1, 8)]


def test_islands_and_expand(spark):
    df = spark.createDataFrame([(1, 0.0, False), (1, 1.0, True), (1, 5.0, False), (1, 5.5, False)], "k int, t double, bad boolean")
    assert [r[2] for r in rows(W.islands(df, ["k"], "t", 2.0), "k", "t", "island")] == [1, 1, 2, 2]
    assert [r[1] for r in rows(D.expand_mask(df, ["k"], "t", 1), "t", "bad")] == [True, True, True, False]


def test_weighted_median_ties(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0), (1, 2.0, 1.0), (2, 1.0, 1.0), (2, 2.0, 5.0), (2, 3.0, 1.0), (2, 9.0, 0.0)], "k int, x double, w double")
    assert rows(W.weighted_median(df, ["k"], "x"), "k", "median") == [(1, 1.5), (2, 2.0)]


def test_difference_ring_constant(spark):
    df = spark.range(24).select(F.lit(1).alias("k"), F.col("id").alias("i"), F.lit(3.0).alias("x"), F.lit(1.0).alias("w"))
    assert {r[0] for r in W.on_off(df, ["k"], "i", 24, 2, 3, "x").select("x").collect()} == {0.0}
    assert {r[0] for r in W.circular_difference(df, ["k"], "i", 24, 4, "x").select("diff").collect()} == {0.0}


def test_bitmap_round_trip(spark):
    df = spark.createDataFrame([(1, float(x)) for x in range(10)], "k int, x double")
    packed = A.rfi_counts(df, ["k"], [1.0, 2.0, 5.0, 20.0], 1.0)
    assert packed.select(*(A.bitmap_count(F.col("bitmap"), k) for k in range(4))).first() == (7, 6, 3, 0)


def test_masks_commute_and_never_add_weight(spark):
    df = spark.createDataFrame([(f, s, s * 1.0, 1.0 * s, 0.0, 2.0) for f in range(2) for s in range(6)], "freq_id int, stack_id int, t double, re double, im double, w double")
    one = spark.createDataFrame([(0, True)], "freq_id int, bad boolean")
    two = spark.createDataFrame([(3, True), (4, False)], "stack_id int, bad boolean")
    a = D.apply_mask(D.apply_mask(df, one, ["freq_id"]), two, ["stack_id"])
    b = D.apply_mask(D.apply_mask(df, two, ["stack_id"]), one, ["freq_id"])
    assert rows(a, "freq_id", "stack_id", "w") == rows(b, "freq_id", "stack_id", "w")
    assert sum(r[2] for r in rows(a, "freq_id", "stack_id", "w")) == 10.0


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{DATA}/{t}.parquet"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    want = duck.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    key = lambda r: tuple((x is None, x) for x in r)
    a = sorted((tuple(r) for r in got.select(*order).collect()), key=key)
    b = sorted(want.project(", ".join(f'"{c}"' for c in order)).fetchall(), key=key)
    assert len(a) == len(b)
    assert not [(x, y) for x, y in zip(a, b) if x != y][:3], name


def test_asof_is_linear_in_a_key(spark):
    """All three directions over one key, against brute force."""
    import bisect

    at = [k * 7919 % 5000 / 10 for k in range(400)]
    left = spark.createDataFrame([(1, t) for t in at], "k int, t double")
    right = spark.createDataFrame([(1, u, str(u)) for u in sorted({k * 104729 % 500 * 1.0 for k in range(90)})], "k int, u double, v string")
    us = sorted({k * 104729 % 500 * 1.0 for k in range(90)})
    low = lambda t: us[bisect.bisect_right(us, t) - 1] if us[0] <= t else None
    high = lambda t: us[bisect.bisect_left(us, t)] if us[-1] >= t else None
    near = lambda t: min((x for x in (low(t), high(t)) if x is not None), key=lambda x: (abs(x - t), x))
    for direction, want in (("backward", low), ("forward", high), ("nearest", near)):
        got = rows(asof_join(left, right, ["k"], "t", "u", {"u": "u"}, direction), "t", "u")
        assert got == sorted((t, want(t)) for t in at)


def test_nearest_key(spark):
    left = spark.createDataFrame([(k, float(k * 37 % 200 - 20)) for k in range(60)], "i int, x double")
    ys = [(5.0, 2), (5.0, 1), (60.0, 3), (61.5, 4), (170.0, 5)]
    right = spark.createDataFrame(ys, "y double, v int")
    for width in (1.0, 7.0, 500.0):
        got = dict(rows(nearest_key(left, right, "x", "y", "v", width), "i", "v"))
        assert got == {i: min((abs(y - x), y, v) for y, v in ys)[2] for i, x in rows(left, "i", "x")}


def test_trailing_sum_over_ranges(spark):
    at = [float(t) for t in (0, 1, 2, 2, 3, 50, 51, 52, 200, 900, 901, 902, 903, 904, 905)]
    df = spark.createDataFrame([(k, t, float(k + 1)) for k, t in enumerate(at)], "i int, t double, x double")
    for n in (1, 3, 6, 40):
        for width in (1.0, 10.0, 5000.0):
            got = dict(rows(W.trailing_sum(df, "t", "i", "x", n, width), "i", "total"))
            assert got == {k: sum(range(max(0, k - n + 1) + 1, k + 2)) for k in range(len(at))}


def test_group_sizes(spark):
    files = spark.createDataFrame([(k, 1, float(k)) for k in range(25)], "file_id int, acq_id int, start_t double")
    sizes = {}
    for _, g in rows(Q.group_acquisitions(files, 12), "file_id", "group_id"):
        sizes[g] = sizes.get(g, 0) + 1
    assert sorted(sizes.values()) == [8, 8, 9]  # 12 leaves 1 of 25, as do sizes out to 8, the first with a rest of 1


def test_streams_equal_batches(spark, tmp_path):
    """Running stacks and day groups over a file stream give the batch results."""
    df = spark.createDataFrame([(k % 3, 86400.0 * (k // 40) + 600.0 * (k % 40), float(k), 1.0 + k % 2) for k in range(160)], "cell int, t double, re double, w double")
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    plans = {"stack": lambda x: T.running_stack(x, ["cell"]), "days": lambda x: T.day_groups(x, F.col("t") / 86400.0, 0.01, 3600.0)}
    for name, plan in plans.items():
        done = plan(stream).writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        done.awaitTermination(120)
        want = plan(df)
        assert rows(spark.table(name), *want.columns) == rows(want, *want.columns)


def test_gain_updates_and_accumulators_stream(spark, tmp_path):
    """Gain updates, accumulated means and delay fits' verdicts over micro-batches equal the batch results."""
    gain = spark.createDataFrame([(float(k), k % 4, k % 3, 1.0 + k, 0.5, 1.0, "transition" if k % 5 == 0 else "gain") for k in range(60)], "update_t double, input_id int, freq_id int, re double, im double, w double, update_kind string")
    gain.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(gain.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    plans = {"updates": (T.gain_updates, "append"), "accumulated": (lambda x: T.accumulate(x, ["input_id"], ["re"]), "complete")}
    for name, (plan, mode) in plans.items():
        done = plan(stream).writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        done.awaitTermination(120)
        want = plan(gain)
        assert rows(spark.table(name), *want.columns) == rows(want, *want.columns)
    assert spark.table("updates").count() == 48


def test_ring_map_by_hand(spark):
    vis = spark.createDataFrame([(1, "XX", 0, 0.0, 1.0, 0.0, 0.5), (1, "XX", 1, 0.5, 0.0, 1.0, 1.0), (2, "XY", 0, 0.0, 2.0, 3.0, 1.0), (2, "YX", 0, 0.0, 1.0, 1.0, 1.0)], "g int, pol string, xind int, y double, re double, im double, weight double")
    got = {(r.g, r.pol, r.beam, r.el_id): (r.value, r.dirty) for r in M.ring_map(vis, ["g"], F.col("y"), [0.0, 1.0], 3).collect()}
    for beam in range(3):
        for el in range(2):
            turn = cmath.exp(-2j * math.pi * 0.5 * el + 2j * math.pi * beam / 3)
            value, dirty = got[1, "XX", beam, el]
            assert math.isclose(value, 2 * (0.5 + 1j * turn).real, abs_tol=1e-12) and math.isclose(dirty, 2 * (0.5 + turn).real, abs_tol=1e-12)
            assert got[2, "reXY", beam, el][0] == pytest.approx(3.0) and got[2, "imXY", beam, el][0] == pytest.approx(2.0)


def test_flattened_spectra_are_flat(spark):
    """x = (level + amplitude of the time) * shape + offset of the channel comes out without shape and offset."""
    shape = [1.0 + 0.3 * math.cos(k) for k in range(16)]
    df = spark.createDataFrame([(t, k, shape[k], 2.0 * shape[k] + 7.0, 1.0) for t in range(5) for k in range(16)], "t int, k int, s double, x double, w double").withColumn("c", F.lit(1))
    got = M.flatten_spectra(df, ["c"], "t", F.col("s"))
    spread = got.agg(F.max("x") - F.min("x"), F.min("w")).first()
    assert spread[0] < 1e-3 and spread[1] > 0


def test_several_products_of_a_reference_are_an_error(spark):
    inputs = spark.createDataFrame([(1, "X"), (2, "Y"), (3, "X")], "input_id int, pol string")
    products = spark.createDataFrame([(1, 3, 5.0, 2.0, 1.0), (2, 3, 1.0, 1.0, 1.0), (3, 3, 9.0, 9.0, 1.0)], "input_a int, input_b int, re double, im double, w double")
    got = rows(M.holography_beam(products, inputs, {1: "X", 2: "Y"}, []), "reference", "input_id", "pol", "re", "im")
    assert got == [(1, 3, "co", 5.0, -2.0), (2, 3, "cross", 1.0, -1.0)]
    with pytest.raises(Exception, match="several products"):
        M.holography_beam(products.union(products), inputs, {1: "X", 2: "Y"}, []).collect()
    with pytest.raises(ValueError):
        M.holography_beam(products, inputs, {1: "X"}, [])


def test_point_before_the_first_update_is_an_error(spark):
    points = spark.createDataFrame([(1, 5.0, 0)], "f int, t double, s int")
    errors = spark.createDataFrame([(1, 6.0, 0.5, 1.0)], "f int, u double, error double, w double")
    with pytest.raises(Exception, match="before the first gain update"):
        M.gain_error_mask(points, errors, ["f"], "t", "u", 1.0, ["f", "s"], 0.1).collect()


def test_one_speed_for_several_days_is_an_error(spark):
    df = spark.createDataFrame([(1, 1, 400.0, 1.0, 1.0), (2, 1, 401.0, 1.0, 1.0)], "lsd int, f int, mhz double, x double, w double")
    with pytest.raises(ValueError, match="several days"):
        M.doppler_shift(df, ["f"], "mhz", "x", F.lit(3.0), day="lsd")
