"""SimHash near-duplicates: fingerprints, multi-index hashing over Hamming balls, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import dealt, discard, materialise, pieces, text_of, unused

BITS = 64


def majority_bits(values: np.ndarray, owner: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each owner (0, 1, ... in order, with so many values) the bits that over half of its values have set."""
    out = np.zeros((len(counts), BITS), dtype=np.int64)
    step = 1 << 16
    for at in range(0, len(values), step):
        bits = np.unpackbits(np.ascontiguousarray(values[at : at + step]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[at : at + step]
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        np.add.at(out, own[first], np.add.reduceat(bits, first, axis=0, dtype=np.int32))
    return np.packbits(2 * out > counts[:, None], axis=1, bitorder="little").view("<i8").ravel()


def _fingerprints(texts: list[bytes], width: int) -> np.ndarray:
    """A 64-bit fingerprint per text, as signed numbers: a bit is set if set in over half the shingles' hashes."""
    from xxhash import xxh64_intdigest as digest

    hashes: list[int] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for k, text in enumerate(texts):
        words = text.lower().split()  # bytes: lower-cases A-Z and splits at ASCII blanks only
        if not words:
            continue
        joined = b" ".join(words)
        if len(words) <= width:
            hashes.append(digest(joined, 42))
            counts[k] = 1
            continue
        starts = np.cumsum([0, *(len(w) + 1 for w in words)])
        ends = starts[width:] - 1
        hashes += [digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends.tolist())]
        counts[k] = len(ends)
    return majority_bits(np.array(hashes, dtype="<u8"), np.repeat(np.arange(len(texts)), counts), counts)


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """doc_id and fp (the 64 bits as a long) of every row; a text without words, or a null one, has fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, max_bytes=4 << 20):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_fingerprints(texts, shingle_words))], ["doc_id", "fp"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def _segments(fp: Column, count: int) -> list[Column]:
    width = BITS // count
    return [F.shiftrightunsigned(fp, k * width).bitwiseAND(F.lit((1 << width) - 1)) for k in range(count)]


def links(fps: DataFrame, max_bits: int = 3, segments: int = 2) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints that differ in max_bits bits or fewer; a pair may come twice.

    Of `segments` equal parts at least one differs in max_bits // segments bits or fewer, so every fingerprint looks
    up that Hamming ball of each of its parts in a table of parts; the whole distance is checked in the join.
    """
    width, radius = BITS // segments, max_bits // segments
    # Each row becomes segments * len(masks) probes: deal the rows out, however few bytes they are.
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    masks = [reduce(lambda m, bit: m | 1 << bit, flips, 0) for r in range(radius + 1) for flips in combinations(range(width), r)]
    tag = lambda k, key: F.shiftleft(F.lit(k).cast("long"), width).bitwiseOR(key)
    parts = _segments(F.col("fp"), segments)
    index = fps.select(F.col("fp").alias("a"), F.explode(F.array(*(tag(k, p) for k, p in enumerate(parts)))).alias("key"))
    ball = F.array(*(F.lit(m).cast("long") for m in masks))
    probe = fps.select("fp", F.explode(F.array(*(tag(k, p) for k, p in enumerate(parts)))).alias("part"))
    probe = probe.select(F.col("fp").alias("b"), "part", F.explode(ball).alias("mask"))
    probe = probe.select("b", F.col("part").bitwiseXOR(F.col("mask")).alias("key"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    return probe.join(dealt(index), [probe["key"] == index["key"], near]).select("a", "b")


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """node, label (smallest node of its component) for every node of the edges (a, b), by large-star, small-star.

    Each round writes its edges to the shared folder; only their number and a checksum come to the driver.
    """
    edges = materialise(edges.select("a", "b").where("a <> b").distinct())
    seen = None
    for _ in range(max_rounds):
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(dealt(low), "a").where("b > a").select(F.col("b").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(dealt(low), "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        before, edges = edges, materialise(small.select(F.col("e.v").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct().select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        discard(before)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label")).union(edges.select("a", "a").distinct())


def labelled(docs: DataFrame, shingle_words: int = 3, max_bits: int = 3, segments: int = 2) -> tuple[DataFrame, DataFrame]:
    """doc_id, node (the fingerprint) of every row of docs; node, first, label of every node: its smallest doc_id and
    its component. Equal fingerprints meet once, before any link is looked for, so a large group of copies costs one row.
    """
    rows = materialise(fingerprints(docs, shingle_words).withColumnRenamed("fp", "node"))
    distinct = rows.groupBy("node").agg(F.min("doc_id").alias("first"))
    found = components(links(distinct.select(F.col("node").alias("fp")), max_bits, segments))
    return rows, distinct.join(dealt(found), "node", "left").select("node", "first", F.coalesce("label", "node").alias("label"))


def near_groups(docs: DataFrame, **params) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of docs (doc_id, text); params: those of labelled().

    Rows whose fingerprints are linked through others form a component, named by its smallest doc_id. Texts without
    words have fingerprint zero and link like any other. A null doc_id never names a component that has another;
    repeated rows each give a row; an empty table gives none.
    """
    rows, named = labelled(docs, **params)
    names = named.groupBy("label").agg(F.min("first").alias("component_id"))
    of_node = named.join(dealt(names), "label").select("node", "component_id")
    return rows.join(dealt(of_node), "node").select("doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")


def _with_nodes(rows: DataFrame, nodes_of: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """rows (doc_id, text) with the node of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, max_bytes=4 << 20):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes_of(batch.column(1)))], ["doc_id", "text", "node"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string, node long")


def keep_first(docs: DataFrame, similarity: float | None = None, shingle_words: int = 3, **params) -> DataFrame:
    """One row of docs, all columns, of each component: the one of smallest doc_id (a null one counts as largest).

    Without `similarity` components are those of near_groups(). With it two texts are linked if the Jaccard similarity
    of their shingles reaches it: fingerprints give the first candidates, a prefix-filter join all that their bits miss
    (shingle_join). Rows that share a doc_id, or have none, are told apart by their texts: each goes by its own.
    """
    if similarity is None:
        nodes_of = lambda texts: _fingerprints(texts.cast(pa.binary()).to_pylist(), shingle_words)
        rows, named = labelled(docs, shingle_words, **params)
    else:
        from meridian.llm import shingle_join

        nodes_of = lambda texts: shingle_join.nodes_of(texts, shingle_words)
        rows, named = shingle_join.labelled(docs, shingle_words, similarity, **params)
    key, body = unused(docs, "_kept_id"), unused(docs, "_kept_text")
    least = F.min(F.struct(F.col("first").isNull().alias("none"), "first", "node")).alias("least")
    best = materialise(named.groupBy("label").agg(least).select(F.col("least.first").alias(key), F.col("least.node").alias("node")))
    again = materialise(rows.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_again")))
    is_again, is_kept = F.col(key).eqNullSafe(F.col("_again")), docs["doc_id"].eqNullSafe(F.col(key))
    if again.isEmpty():
        return docs.join(best.select(key), is_kept, "left_semi")
    out = docs.join(best.join(dealt(again), is_again, "left_anti").select(key), is_kept, "left_semi")
    # Of the rows of one doc_id those with the component's node, of these one with the least text.
    wanted = materialise(best.join(dealt(again), is_again, "left_semi"))
    some = docs.join(wanted.select(key).distinct(), is_kept, "left_semi")
    texts = _with_nodes(some.select("doc_id", text_of().alias("text")).distinct(), nodes_of).withColumnRenamed("node", "_node")
    texts = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col("_node") == F.col("node")), "left_semi")
    texts = texts.groupBy("doc_id", "_node").agg(F.min("text").alias(body)).select(F.col("doc_id").alias(key), body)
    some = some.join(texts, is_kept & (text_of() == F.col(body)), "left_semi").withColumn(body, text_of())
    return out.unionByName(some.dropDuplicates(["doc_id", body]).drop(body))
