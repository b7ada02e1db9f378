"""What iterated operators share: a table written between rounds, and components by least label."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. A session of one machine that names none gets a folder of its own; a cluster must name one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="spark-meridian-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def written(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back: lineage ends there, and a lost executor loses nothing of it."""
    path = f"{shared_folder(df.sparkSession)}/meridian-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, vertices: DataFrame, key: str, max_rounds: int = 60) -> DataFrame:
    """key, component (the least key reachable) of each vertex; edges (a, b), in either direction, ends among them.

    Each round a vertex takes the least label among its neighbours' and its own, then the label of its label, so
    chains shrink by more than half. The aggregate combines before the shuffle, so a hub is no hot key; the table is
    written each round. Raises if labels still change after max_rounds."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct())
    labels = written(vertices.select(F.col(key).alias("v"), F.col(key).alias("label")).distinct())
    for _ in range(max_rounds):
        near = both.join(labels, both["b"] == labels["v"]).select("a", "label").groupBy("a").agg(F.min("label").alias("near"))
        least = labels.join(near, labels["v"] == near["a"], "left").select("v", F.least("label", F.coalesce("near", "label")).alias("next"), "label")
        hop = least.select(F.col("v").alias("_v"), F.col("next").alias("_hop"))
        jumped = least.join(hop, least["next"] == hop["_v"]).select("v", F.col("_hop").alias("label"), (F.col("_hop") != F.col("label")).alias("moved"))
        jumped = written(jumped)
        labels = jumped.drop("moved")
        if not jumped.where("moved").limit(1).count():
            return labels.select(F.col("v").alias(key), F.col("label").alias("component"))
    raise RuntimeError(f"components still change after {max_rounds} rounds")
