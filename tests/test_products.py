"""Readers and the sink of products, gain operators on hand-made rows."""

import math

import pytest
from pyspark.sql import functions as F

from meridian.operators import gains as G
from meridian.sources import products as P


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_sink_replaces_only_its_tags(spark, tmp_path):
    path = str(tmp_path / "out")
    P.write_product(spark.createDataFrame([(1, 1.0), (2, 2.0)], "lsd long, x double"), path)
    P.write_product(spark.createDataFrame([(2, 9.0), (3, 3.0)], "lsd long, x double"), path)
    assert rows(spark.read.parquet(path), "lsd", "x") == [(1, 1.0), (2, 9.0), (3, 3.0)]
    days = spark.createDataFrame([(1,), (3,), (3,), (7,)], "lsd int")
    assert rows(P.read_by_tag(days, path), "lsd", "x") == [(1, 1.0), (3, 3.0)]


def test_read_acq(spark, tmp_path):
    path = str(tmp_path / "weather")
    spark.createDataFrame([(1.0, 0.5, "extra")], "t double, rain double, other string").write.parquet(path)
    assert P.read_acq(spark, [path], "weather").collect() == [(1.0, 0.5, None)]
    with pytest.raises(ValueError):
        P.read_acq(spark, [path], "weathr")


def test_read_dim(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(5).write.parquet(path)
    assert P.read_dim(spark, path).count() == P.read_dim(spark, path, max_rows=3).count() == 5


def test_gain_error_is_taken_out(spark):
    products = spark.createDataFrame([(0, 1, 0), (0, 2, 0)], "input_a int, input_b int, stack int")
    inputs = spark.createDataFrame([(0, True), (1, True), (2, False)], "input_id int, good boolean")
    gain = spark.createDataFrame([(0, 5, 2.0, 0.0, 1.0), (1, 5, 0.0, 1.0, 1.0), (2, 5, 7.0, 7.0, 1.0)], "input_id int, freq_id int, re double, im double, w double")
    error = G.stack_gain_error(products, inputs, gain, ["stack"], ["freq_id"])
    assert rows(error, "stack", "freq_id", "re", "im") == [(0, 5, 0.0, -2.0)]
    vis = spark.createDataFrame([(0, 5, 0.0, -2.0, 1.0), (1, 5, 1.0, 1.0, 1.0)], "stack int, freq_id int, re double, im double, w double")
    assert rows(G.correct_gain_error(vis, error, ["stack", "freq_id"]), "stack", "re", "im", "w") == [(0, 1.0, 0.0, 4.0), (1, 0.0, 0.0, 0.0)]
    beam = G.stacked_beam(products, inputs, gain, ["stack"], ["freq_id"]).first()
    # |2 * 1|^2 (1 / 4 + 1 / 1) = 5
    assert (beam.re, beam.im) == (0.0, -2.0) and math.isclose(beam.w, 0.2)


def test_delays_add_up_inside_flags(spark):
    vis = spark.createDataFrame([(1, 0.0, 1.0, 0.0), (2, 5.0, 1.0, 0.0), (3, 20.0, 1.0, 0.0)], "id int, t double, re double, im double")
    flags = spark.createDataFrame([(0.0, 9.0, '{"k": 1}'), (4.0, 6.0, '{"k": 1}'), (0.0, 90.0, '{"k": 0}'), (0.0, 90.0, None)], "start_t double, finish_t double, metadata string")
    delays = G.flag_delays(flags, "$.k", 0.0, 0.25e-6)
    assert delays.count() == 2
    got = {r.id: (round(r.re, 9) + 0.0, round(r.im, 9) + 0.0) for r in G.correct_delays(vis, "id", delays, F.lit(1.0), 5.0).collect()}
    assert got == {1: (0.0, 1.0), 2: (-1.0, 0.0), 3: (1.0, 0.0)}


def test_spread_mask_against_all_pairs(spark):
    at = [(k, k / 7 - 0.5, k % 3 == 0) for k in range(8)]
    df = spark.createDataFrame(at, "k int, x double, bad boolean").withColumn("g", F.lit(1))
    got = rows(G.spread_mask(df, ["g"], F.col("x"), 0.11, -0.4, 0.05, 12), "el_id", "bad")
    want = {}
    for _, x, bad in at:
        for e in range(12):
            if abs(-0.4 + 0.05 * e - x) <= 0.11:
                want[e] = want.get(e, False) or bad
    assert got == sorted(want.items())
