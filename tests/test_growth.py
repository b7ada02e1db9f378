"""Queries whose work must grow with their tables: plans, odd rows and ties on small copies, against their SQL."""

import os
import shutil

import duckdb
import pytest
from pyspark.sql import functions as F

from meridian.operators import joins, timing
from meridian.plans import calibration_queries, catalogue_queries, gain_queries, instrument_queries, map_queries, queries, solver_queries, stream_queries  # noqa: F401
from meridian.plans.registry import ORACLES, QUERIES
from meridian.sources.fixtures import FIXTURES, SPARK_FORMS, TABLES, fixture, spark_sql
from meridian.streaming import groups

DATA = "/root/testdata/sf0.001"


def copy_of(tmp_path, **tables):
    """DATA with some tables replaced by SQL over them."""
    for name in TABLES:
        if name not in tables and os.path.exists(f"{DATA}/{name}.parquet"):
            shutil.copy(f"{DATA}/{name}.parquet", tmp_path)
    con = duckdb.connect()
    for name, sql in tables.items():
        con.sql(f"COPY (SELECT * FROM ({sql.format(**{name: f"'{DATA}/{name}.parquet'"})})) TO '{tmp_path}/{name}.parquet'")
    return str(tmp_path)


def same_as_sql(spark, name, where):
    con = duckdb.connect()
    con.sql("SET timezone='UTC'")
    for t in TABLES:
        if os.path.exists(f"{where}/{t}.parquet"):
            con.sql(f"CREATE VIEW {t} AS FROM '{where}/{t}.parquet'")
    got = QUERIES[name](spark, where)
    cells = con.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, cells))
    return len(cells)


@pytest.mark.parametrize("form", sorted(SPARK_FORMS))
def test_spark_form_meets_by_key(spark, form, tmp_path):
    # Gaps, negative ids and a null: equal rows in both forms, and no join without a key.
    where = copy_of(tmp_path, events="SELECT * REPLACE (CASE WHEN user_id = 7 THEN NULL ELSE user_id * 3 - 20 END AS user_id) FROM {events}")
    df = fixture(spark, where, form[3:])
    plain = spark.sql(spark_sql(f"SELECT * FROM ({FIXTURES[form]})", where))
    assert df.schema == plain.schema and df.exceptAll(plain).count() == 0 and plain.exceptAll(df).count() == 0 and df.count() > 50
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_timing_takes_streams_that_a_flag_holds_in_part(spark, tmp_path):
    # A sample in the first second of a day lies in the last second of the flag of the day before, which ends first.
    where = copy_of(tmp_path, events="SELECT * REPLACE (CASE WHEN event_id % 2 = 0 THEN date_trunc('day', ts) + INTERVAL 500 MILLISECOND * (1 + event_id % 2) ELSE ts END AS ts) FROM {events}")
    vis, delay, flags = (fixture(spark, where, x) for x in ("vis", "delay", "flag_vis"))
    rows, spans = solver_queries.timing_inputs(vis, delay, flags)
    with pytest.raises(Exception, match="partially overlaps"):
        timing.streams_to_correct(rows, "stream", spans, delay, True).collect()
    assert same_as_sql(spark, "m4_timing_correction", where) > 100


@pytest.mark.parametrize("name", ["q16_filter_processed", "q8_exclude_data_flags"])
def test_many_overlaps_make_no_pairs(spark, name, tmp_path):
    # Many copies at the same times: rows that reach an aggregate or join grow with the copies, not with their square.
    orders = "SELECT o_orderkey * 40 + k AS o_orderkey, * EXCLUDE (o_orderkey, k) FROM {orders}, range(40) g(k)"
    events = "SELECT event_id * 10 + k AS event_id, * EXCLUDE (event_id, k) FROM {events}, range(10) g(k)"
    where = copy_of(tmp_path, orders=orders, events=events)
    assert same_as_sql(spark, name, where) > 0
    plan = QUERIES[name](spark, where)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 0 and "Window" in plan


def test_frequency_maps_come_from_one_walk(spark, monkeypatch):
    from meridian.operators import lookup

    walks = []
    walk = lookup.closest_ancestors
    monkeypatch.setattr(lookup, "closest_ancestors", lambda *a, **k: walks.append(1) or walk(*a, **k))
    assert same_as_sql(spark, "q14_frequency_map", DATA) > 0
    assert len(walks) == 1


def many(df, n):
    return df.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def test_pairs_meet_by_chunks(spark):
    points = many(spark.createDataFrame([(x,) for x in (0.0, 1.0, 2.5, 3.0, 3.1, None, float("nan"))], "t double"), 300)
    spans = spark.createDataFrame([(1, 1.0, 3.0), (2, 2.0, 2.6), (3, None, 5.0), (4, 3.0, 1.0), (5, 0.0, 0.0)], "id int, a double, b double")
    met = joins.interval_pairs(points, spans, "t", "a", "b", 0.7)
    got = met.groupBy("t", "id").agg(F.count("*").alias("n"), F.countDistinct("_k").alias("k")).collect()
    assert sorted(map(tuple, got)) == [(0.0, 5, 300, 300), (1.0, 1, 300, 300), (2.5, 1, 300, 300), (2.5, 2, 300, 300), (3.0, 1, 300, 300)]
    assert "Window" in met._jdf.queryExecution().optimizedPlan().toString()  # points are laid together, not joined one by one


def test_overlaps_equal_a_nested_loop(spark):
    times = [None, 0.0, 1.0, 1.5, 2.0, 4.0]
    spans = spark.createDataFrame([(i * 10 + j, x, y) for i, x in enumerate(times) for j, y in enumerate(times)], "id int, a double, b double")
    other = many(spans.toDF("o", "c", "d"), 3)
    got = joins.overlap_join(spans, other, "a", "b", "c", "d", 0.7).select("id", "o", "_k").collect()
    # Inverted intervals meet by the buckets that both have, as they did.
    want = [(p.id, q.o, q._k) for p in spans.collect() for q in other.collect() if None not in (p.a, p.b, q.c, q.d) and p.a < q.d and p.b >= q.c]
    wild = {r.id for r in spans.collect() if None not in (r.a, r.b) and r.a > r.b}
    tame = lambda rows: sorted(r for r in map(tuple, rows) if r[0] not in wild and r[1] not in wild)
    assert tame(got) == tame(want) and len(set(map(tuple, got))) == len(got) and set(map(tuple, got)) <= set(want)


def test_transit_sums_make_no_pairs(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0.0, 1.0, 1.0), (10.0, 2.0, 2.0), (10.0, None, 3.0), (20.0, inf, 1.0), (30.0, nan, 1.0), (40.0, 5.0, None), (90.0, 7.0, 1.0), (None, 1.0, 1.0), (120.0, 0.5, 2.0)]
    df = spark.createDataFrame(rows, "t double, re double, w double")
    runs = spark.createDataFrame([(1, 0.0, 200.0)], "run_id int, start_t double, finish_t double")
    transits = spark.createDataFrame([(s, float(t)) for s, t in enumerate((5, 15, 35, 100, 105, 160))], "source int, transit_t double")
    out = groups.transit_groups(df, transits, runs, 15.0, 10.0, day=50.0)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 1  # of transits with runs
    got = {r["source"]: (r["n"], r["w"], r["wx"]) for r in out.collect()}
    assert repr(sorted(got.items())) == repr([(0, (4, 7.0, inf)), (1, (5, 8.0, nan)), (2, (3, 2.0, nan)), (3, (1, 1.0, 7.0)), (4, (2, 3.0, 8.0))])


def test_cylinders_take_sums(spark, tmp_path):
    """Samples are summed before they meet their products: shuffled once, by their cells, however many products they have."""
    lines = "SELECT l_orderkey * 5 + k AS l_orderkey, * EXCLUDE (l_orderkey, k) FROM {lineitem}, range(5) g(k)"
    where = copy_of(tmp_path, lineitem=lines)
    sc = spark.sparkContext
    stages = lambda: sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    before = stages().size()
    assert same_as_sql(spark, "d26_decorrelated_cylinders", where) > 100
    got = stages()  # newest first
    moved = sum(got.apply(k).shuffleWriteRecords() for k in range(got.size() - before))
    assert moved < 2 * spark.read.parquet(f"{where}/lineitem.parquet").count()
