"""Walks along parent links: the nearest ancestor of a type, and the one frequency map of a set of data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.operators.rounds import written


def closest_ancestors(starts: DataFrame, parents: DataFrame, is_type: Column, state: str, max_depth: int = 64) -> DataFrame:
    """dataset_id, depth, state of each of `starts` (dataset_id): of the nearest of itself and its ancestors in parents
    (dataset_id, parent_id) that is_type holds for; depth null if the chain ends without one, `known` false if the id
    itself is not in parents.

    Only ids that still look for theirs go on, each by one step a round. A chain that comes back to an id seen on it
    ends there. Longer chains than max_depth are an error, not an end."""
    nodes = parents.select(F.col("dataset_id").alias("_id"), F.col("parent_id").alias("_parent"), is_type.alias("_hit"), F.col(state).alias("_state"))
    looking = starts.select("dataset_id").distinct().select("dataset_id", F.col("dataset_id").alias("_at"), F.array("dataset_id").alias("_path"))
    done = None
    for depth in range(max_depth + 1):
        met = written(looking.join(nodes, F.col("_at") == F.col("_id"), "left"))
        back = F.array_contains("_path", F.col("_parent"))
        over = F.col("_id").isNull() | F.col("_hit") | F.col("_parent").isNull() | back
        hit = F.coalesce("_hit", F.lit(False))
        known = F.lit(depth > 0) | F.col("_id").isNotNull()
        ended = met.where(F.coalesce(over, F.lit(False))).select("dataset_id", F.when(hit, depth).alias("depth"), F.when(hit, F.col("_state")).alias(state), known.alias("known"))
        done = ended if done is None else done.unionByName(ended)
        looking = met.where(~F.coalesce(over, F.lit(False))).select("dataset_id", F.col("_parent").alias("_at"), F.array_append("_path", F.col("_parent")).alias("_path"))
        if not looking.limit(1).count():
            return done
    raise RuntimeError(f"a chain of parents is longer than {max_depth}")


def frequency_map_of(ids: DataFrame, parents: DataFrame, is_type: Column, state: str, unset: list, default, max_depth: int = 64, found: DataFrame | None = None) -> DataFrame:
    """group, map: the frequency map of each group's data (ids: group, dataset_id).

    Null ids and those in `unset` don't count. A group whose ids have no ancestor of the type, or none that counts,
    has the default; one whose ids are all unknown is an error; two different maps in a group (the default of one id
    and a map of another too) are an error, raised where the map is computed. found: what closest_ancestors() gave for these
    ids, if the walk has been made already."""
    wanted = ids.where(F.col("dataset_id").isNotNull() & ~F.coalesce(F.col("dataset_id").isin(unset), F.lit(False))).select("group", "dataset_id").distinct()
    found = closest_ancestors(wanted, parents, is_type, state, max_depth) if found is None else found
    each = wanted.join(found, "dataset_id")
    maps = F.collect_set(F.when(F.col("known"), F.coalesce(F.col(state).cast("string"), F.lit("default"))))
    sums = each.groupBy("group").agg(maps.alias("_maps"))
    # A set of more than a few maps is an error anyway; the set holds distinct maps, not rows.
    several = F.raise_error(F.concat(F.lit("multiple frequency maps found for "), F.col("group").cast("string")))
    unknown = F.raise_error(F.concat(F.lit("no dataset is known of "), F.col("group").cast("string")))
    one = F.when(F.col("_maps").isNull(), F.lit("default")).when(F.size("_maps") == 0, unknown).when(F.size("_maps") > 1, several).otherwise(F.get("_maps", F.lit(0)))
    all_groups = ids.select("group").distinct().join(sums, "group", "left").select("group", one.alias("map"))
    return all_groups.select("group", F.when(F.col("map") == "default", F.lit(str(default))).otherwise(F.col("map")).alias("map"))
