"""What operators leave on disk while they run, and what their plans make the driver hold."""

import random
import time

from pyspark.sql import functions as F

from meridian.llm import lines, mixing, suffixes
from meridian.llm.common import FILE_CLEANUP, materialise


def shuffle_files(spark) -> int:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(k).getName().startswith("shuffle_") for k in range(files.size()))


def settled(spark, at_most: int) -> bool:
    """Files are deleted behind the query's back; wait a little for that."""
    for _ in range(50):
        if shuffle_files(spark) <= at_most:
            return True
        time.sleep(0.1)
    return False


def test_materialise_leaves_no_shuffle_files(spark):
    before, option = shuffle_files(spark), spark.conf.get(FILE_CLEANUP)
    out = materialise(spark.range(1000).groupBy((F.col("id") % 900).alias("k")).count())
    assert settled(spark, before)
    assert out.count() == 900 and spark.conf.get(FILE_CLEANUP) == option


def test_anchors_are_gone_before_segments_come(spark):
    same = "a passage of well over fifty bytes that two of these rows have between them, word for word"
    docs = spark.createDataFrame([(k, f"{k} {same if k < 2 else k * 7} {k}") for k in range(9)], "doc_id long, text string")
    got = suffixes.remove_repeats(docs)
    # Of the three steps by group (anchors, shared, factors) one is left in the query's own plan.
    assert got._jdf.queryExecution().optimizedPlan().toString().count("FlatMapGroupsInArrow") == 1
    assert {r["doc_id"]: r["n_removed"] > 0 for r in got.collect()} == {k: k == 1 for k in range(9)}


def stages(spark) -> dict:
    """Rows that each stage so far wrote to a shuffle."""
    sc = spark.sparkContext
    got = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    return {got.apply(k).stageId(): got.apply(k).shuffleWriteRecords() for k in range(got.size())}


def test_anchor_cells_grow_with_the_blocks(spark):
    rng = random.Random(5)
    say = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    same = [say(90) for _ in range(40)]
    docs = spark.createDataFrame([(k, say(200) + rng.choice(same) + say(200) + rng.choice(same)) for k in range(240)], "doc_id long, text string")
    want = sorted(tuple(r) for r in suffixes.remove_repeats(docs).collect())
    before = max(stages(spark), default=-1)
    got = suffixes.remove_repeats(docs, block_bytes=600, most_even=8, most_rows=16)
    assert sorted(tuple(r) for r in got.collect()) == want and sum(r[2] > 0 for r in want) > 150
    # About 230 blocks send to 28 buckets of anchors, not to 230.
    assert sum(n for k, n in stages(spark).items() if k > before) < 230 * 100


def test_lines_shuffle_few_keys(spark):
    rng = random.Random(4)
    line = lambda: "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(60, 240)))
    docs = spark.createDataFrame([(k, "\n".join(line() for _ in range(5))) for k in range(400)], "doc_id long, text string")
    before = max(stages(spark), default=-1)
    assert lines.repeated_lines(docs).agg(F.sum("n_removed")).first()[0] == 0
    # Of 2,000 lines none is near another: a row each for its number, four or five for its keys.
    assert sum(n for k, n in stages(spark).items() if k > before) < 8 * 2000


def test_lines_at_many_keys_are_joined_alike(spark):
    rng = random.Random(6)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(10, 140))) for _ in range(60)]
    texts = [b[:k] + rng.choice("xyz") + b[k + rng.randint(0, 1) :] for b in base for k in (rng.randrange(len(b)), rng.randrange(len(b)))] + base
    rows = lines.lines_of(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    few, many = (set(map(tuple, lines.near_lines(rows, max_broadcast=n).collect())) for n in (500_000, 0))
    assert few == many and len(few) >= 100


def test_weights_of_words_are_a_small_part_of_the_plan(spark):
    texts = [(k, f"word{k % 7} plain sentence number {k} " + ("you vile fool" if k % 3 else "a calm and quiet day")) for k in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, int(k % 3 > 0)) for k in range(60)], "doc_id long, quality int, toxic int")
    rows = mixing.posteriors(docs, labels)
    assert len(rows._jdf.queryExecution().optimizedPlan().toString()) < 400_000
    assert all(abs(sum(r[f"p_{d}"] for d in mixing.DOMAINS) - 1) < 1e-9 for r in rows.collect())
