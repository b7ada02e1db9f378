"""Joins of the near-duplicate operators are dealt out: no side of them is built on the driver."""

from pyspark.sql import functions as F

from meridian.llm import simhash


def test_links_build_nothing_on_the_driver(spark):
    fps = spark.range(50).select(F.expr("shiftleft(1L, cast(id AS int)) AS fp")).distinct()
    found = simhash.links(fps)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    # Any two single bits differ in two.
    assert found.distinct().count() == 50 * 49 // 2


def test_groups_build_nothing_on_the_driver(spark):
    docs = spark.createDataFrame([(k, f"one two three four five {k % 3}") for k in range(9)], "doc_id long, text string")
    got = simhash.near_groups(docs)
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
    groups = {r["doc_id"]: r["component_id"] for r in got.collect()}
    assert len(groups) == 9 and all(groups[k] == groups[k % 3] for k in range(9))
