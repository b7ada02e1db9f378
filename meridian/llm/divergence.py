"""Source divergence audit: block postings in memory, runs sorted by term, merged by shard, corrections by pair."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.llm.common import materialise, pieces

#: What is no part of a term: ASCII but its letters. Its capitals and their small letters.
NO_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCALE = 1_000_000_000
POSTINGS = "lang string, term string, source string, n long, docs long"


class Block:
    """Counts by (term, group) and documents by (term, group) of the texts read so far, while memory lasts."""

    def __init__(self, max_entries: int):
        self.max_entries = max_entries
        self.terms: dict[str, int] = {}
        self.groups: dict[tuple[str, str], int] = {}
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, batch: pa.RecordBatch) -> None:
        """Texts as dictionary codes; each distinct (document, term) becomes one entry, then (term, group) sums."""
        group = np.array([self.groups.setdefault(g, len(self.groups)) for g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())], np.int64)
        lists = pa.compute.split_pattern_regex(batch.column(2), NO_TERM)
        lengths = np.diff(lists.offsets.to_numpy(zero_copy_only=False))
        codes = lists.values.slice(lists.offsets[0].as_py(), int(lengths.sum())).dictionary_encode()
        number = np.array([self.terms.setdefault(t, len(self.terms)) if t else -1 for t in codes.dictionary.to_pylist()], np.int64)
        term = number[codes.indices.to_numpy(zero_copy_only=False)] if len(number) else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(batch.num_rows), lengths)[term >= 0]
        pairs, n = np.unique(owner << 40 | term[term >= 0], return_counts=True)
        self._keep((pairs & ((1 << 40) - 1)) << 20 | group[pairs >> 40], n, np.ones(len(n), np.int64))

    def _keep(self, key: np.ndarray, n: np.ndarray, docs: np.ndarray) -> None:
        self.held.append((key, n.astype(np.int64), docs))
        self.size += len(key)
        if self.size > self.max_entries:
            self._sum()

    def _sum(self) -> None:
        key, n, docs = (np.concatenate([x[k] for x in self.held]) for k in range(3))
        order = np.argsort(key)
        begin = np.flatnonzero(np.diff(key[order], prepend=-1))
        self.held = [(key[order][begin], np.add.reduceat(n[order], begin), np.add.reduceat(docs[order], begin))] if len(begin) else []
        self.size = len(begin)

    @property
    def full(self) -> bool:
        return 2 * self.size > self.max_entries and len(self.held) == 1 or len(self.terms) > self.max_entries or len(self.groups) >= 1 << 19

    def run(self) -> Iterator[pa.RecordBatch]:
        """The block's postings by term, and a row with an empty term for each group; the block is empty then."""
        if self.groups:
            names = list(self.groups)
            langs, sources = ([g[k] for g in names] for k in (0, 1))
            zero = pa.array(np.zeros(len(names), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array([""] * len(names)), pa.array(sources, pa.string()), zero, zero], ["lang", "term", "source", "n", "docs"])
        if self.held:
            self._sum()
            key, n, docs = self.held[0]
            spelt = pa.array(list(self.terms), pa.string())
            rank = np.empty(len(spelt), np.int64)
            rank[pa.compute.sort_indices(spelt).to_numpy()] = np.arange(len(spelt))
            order = np.argsort(rank[key >> 20], kind="stable")
            langs, sources = pa.array(langs, pa.string()), pa.array(sources, pa.string())
            for at in range(0, len(order), 1 << 16):
                part = order[at : at + (1 << 16)]
                group = pa.array(key[part] & ((1 << 20) - 1))
                yield pa.RecordBatch.from_arrays([langs.take(group), spelt.take(pa.array(key[part] >> 20)), sources.take(group), pa.array(n[part]), pa.array(docs[part])], ["lang", "term", "source", "n", "docs"])
        self.__init__(self.max_entries)


def block_runs(docs: DataFrame, max_entries: int = 1_000_000) -> DataFrame:
    """lang, term, source, n, docs: runs sorted by term, one for each block of texts whose postings filled memory
    (max_entries of about 50 bytes); n occurrences in `docs` documents. A row with an empty term names each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(max_entries)
        for batch in pieces(batches, max_bytes=4 << 20):
            block.add(batch)
            if block.full:
                yield from block.run()
        yield from block.run()

    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    low = F.translate(text("text"), UPPER, LOWER).alias("text")
    return docs.select(text("lang"), text("source"), low).mapInArrow(run, POSTINGS)


def _starts(*columns: pa.Array) -> np.ndarray:
    """Where a row differs from the one before it in any column; the first row always does."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= pa.compute.not_equal(c.slice(1), c.slice(0, max(len(c) - 1, 0))).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _whole_terms(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...], least: int = 200_000) -> Iterator[pa.Table]:
    """Tables of at least so many rows, as far as there are, none of which cuts the rows of a term in two."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= least:
            table = pa.Table.from_batches(held).combine_chunks()
            last = int(_starts(*(table.column(c).chunk(0) for c in columns))[-1])
            if last:
                yield table.slice(0, last).combine_chunks()
            held = table.slice(last).to_batches()
            size = 0 if last else size // 2  # a term longer than this waits for its end
    if held and sum(x.num_rows for x in held):
        yield pa.Table.from_batches(held).combine_chunks()


def merge_runs(runs: DataFrame, least_docs: int) -> DataFrame:
    """lang, term, source, n, of_lang, first: the postings of terms in least_docs documents of their language or
    more, with the term's count in the language; `first` marks one posting of each term. Rows with an empty term
    name the groups.

    Shards by hash of language and term hold the runs merged in order of term (Spark's sort merges what it spills);
    one pass adds up like postings and holds little more than one term's rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_terms(batches, ("term", "lang")):
            term, lang, source = (table.column(c).chunk(0) for c in ("term", "lang", "source"))
            at = _starts(term, lang, source)
            n, docs = (np.add.reduceat(table.column(c).to_numpy(), at) for c in ("n", "docs"))
            term, lang, source = (c.take(pa.array(at)) for c in (term, lang, source))
            first = _starts(term, lang)
            size = np.diff(np.append(first, len(at)))
            keep = np.repeat(np.add.reduceat(docs, first) >= least_docs, size) | (pa.compute.binary_length(term).to_numpy() == 0)
            of_lang = np.repeat(np.add.reduceat(n, first), size)
            marks = np.zeros(len(at), bool)
            marks[first] = True
            some = pa.array(keep)
            arrays = [*(c.filter(some) for c in (lang, term, source)), *(pa.array(x[keep]) for x in (n, of_lang, marks))]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "term", "source", "n", "of_lang", "first"])

    shards = runs.repartition("lang", "term").sortWithinPartitions("term", "lang", "source")
    return shards.mapInArrow(run, "lang string, term string, source string, n long, of_lang long, first boolean")


def share(count: Column, total: Column, terms: Column) -> Column:
    """p = 1 + floor(SCALE * (count + 1) / (total + terms)), exact for counts beyond what a long takes times SCALE."""
    wide = lambda c: c.cast("decimal(19,0)")
    top = (wide(count) + 1) * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", top, wide(total) + wide(terms))


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q) of longs; shares stay under 1e9 + 2, so the square fits in a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def _shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """share() of counts in numpy; total includes the number of terms."""
    top = n.astype(object) + 1 if n.max(initial=0) > 9_000_000_000 else n + 1
    return np.array(1 + SCALE * top // total.astype(top.dtype), np.int64)


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def joint_corrections(postings: DataFrame, max_cells: int = 2_000_000) -> DataFrame:
    """lang, source, item, value: what terms that occur in both sources add to the sum over sources taken apart.

    postings (lang, term, source, n, total), total the count and number of the group's terms. Each task streams its
    shard by term; terms in equally many sources are taken together, max_cells source pairs at a time, and their
    corrections added up by pair before they are written: a pair comes once for so many cells, not once a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_terms(batches, ("term", "lang"), 1_000_000):
            term, lang, source = (table.column(c).chunk(0) for c in ("term", "lang", "source"))
            n, total = (table.column(c).to_numpy() for c in ("n", "total"))
            p, p0 = _shares(n, total), _shares(np.zeros(len(n), np.int64), total)
            coded = [c.dictionary_encode() for c in (lang, source)]
            names, sources = (c.dictionary for c in coded)
            owner, at = (c.indices.to_numpy().astype(np.int64) for c in coded)
            first = _starts(term, lang)
            size = np.diff(np.append(first, len(n)))
            wide = len(sources)
            for d in np.unique(size[size > 1]):
                begins = first[size == d]
                for some in np.array_split(begins, max(1, len(begins) * int(d) * int(d) // max_cells)):
                    # At least one term at a time; of a term in very many sources some rows of its table at a time.
                    for low in range(0, d, max(1, max_cells // int(d))):
                        rows = np.arange(low, min(d, low + max(1, max_cells // int(d))))
                        mine, all_of = some[:, None] + rows, some[:, None] + np.arange(d)
                        a, a0, b, b0 = p[mine][:, :, None], p0[mine][:, :, None], p[all_of][:, None, :], p0[all_of][:, None, :]
                        # As in the sums over sources apart, the other source's share stands below.
                        value = (_apart(a, b) - _apart(a, b0) - _apart(a0, b) + _apart(a0, b0)).ravel()
                        key = ((owner[mine] * wide + at[mine])[:, :, None] * wide + at[all_of][:, None, :]).ravel()
                        order = np.argsort(key, kind="stable")
                        begin = np.flatnonzero(np.diff(key[order], prepend=-1))
                        sums, key = np.add.reduceat(value[order], begin), key[order][begin]
                        taken = (names.take(pa.array(key // wide // wide)), sources.take(pa.array(key // wide % wide)), sources.take(pa.array(key % wide)))
                        yield pa.RecordBatch.from_arrays([*taken, pa.array(sums)], ["lang", "source", "item", "value"])

    ordered = postings.select("lang", "term", "source", "n", "total").repartition("lang", "term").sortWithinPartitions("term", "lang")
    return ordered.mapInArrow(run, "lang string, source string, item string, value long").where("source <> item")


def audit(docs: DataFrame, least_docs: int = 3, terms: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank over docs (text, lang, source).

    Part `pair`: for each group (lang, source), every other source of the language by the divergence of the group's
    term shares from that source's. Part `term`: its terms with a share over the language's, the `terms` of the
    largest divergence. Ranks go by value, largest first, then by item in UTF-8 order.

    The sum over all kept terms is taken apart, so that no term meets every pair of sources: where a term has no
    occurrence in either source its divergence is one number for all such terms; terms of one source count by their
    number of occurrences; only terms of both are looked at one by one (joint_corrections). Null text, lang and
    source are empty strings; repeated rows are documents of their own; a group without terms has shares of none,
    all alike; an empty table gives no rows; ids and other columns are not looked at.
    """
    runs = block_runs(docs)
    merged = materialise(merge_runs(runs, least_docs))
    postings = merged.where("term <> ''")
    langs = postings.groupBy("lang").agg(F.sum(F.col("first").cast("long")).alias("terms"), F.sum(F.when(F.col("first"), F.col("of_lang")).otherwise(0)).alias("lang_n"))
    groups = merged.groupBy("lang", "source").agg(F.sum("n").alias("group_n")).join(langs, "lang", "left")
    groups = materialise(groups.select("lang", "source", "group_n", F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("lang_n", F.lit(0)).alias("lang_n")))
    # What a share of no occurrence is in each group; without kept terms there is nothing to share.
    some = groups.where("terms > 0").withColumn("p0", share(F.lit(0), F.col("group_n"), F.col("terms")))

    met = postings.join(groups, ["lang", "source"])
    shares = met.withColumn("p", share(F.col("n"), F.col("group_n"), F.col("terms"))).withColumn("q", share(F.col("of_lang"), F.col("lang_n"), F.col("terms")))
    own = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= terms)

    other = some.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    pairs = some.select("lang", "source", "terms", "p0").join(other, "lang").where("source <> item")
    base = pairs.select("lang", "source", "item", (F.col("terms") * divergence(F.col("p0"), F.col("q0"))).alias("value"))
    counted = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("times")).join(some.select("lang", "source", "p0"), ["lang", "source"])
    against = counted.join(other, "lang").where("source <> item")
    without = divergence(F.col("p0"), F.col("q0"))
    here = against.select("lang", "source", "item", (F.col("times") * (divergence(F.col("p"), F.col("q0")) - without)).alias("value"))
    back = divergence(F.col("q0"), F.col("p")) - divergence(F.col("q0"), F.col("p0"))
    there = against.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), (F.col("times") * back).alias("value"))
    both = joint_corrections(met.withColumn("total", F.col("group_n") + F.col("terms")))
    none = groups.where("terms = 0").select("lang", "source")
    nothing = none.join(none.withColumnRenamed("source", "item"), "lang").where("source <> item").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))
    sums = base.unionByName(here).unionByName(there).unionByName(both).unionByName(nothing).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    ranked = sums.withColumn("rank", F.row_number().over(order))
    out = [df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank")) for part, df in (("pair", ranked), ("term", top))]
    return out[0].unionByName(out[1])


#: The same rows in DuckDB, each term against each pair of sources.
SQL = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT lang, source, id, unnest(words) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 3),
v AS (SELECT lang, count(*) AS terms, sum(n) AS n FROM k GROUP BY ALL),
t AS (SELECT g.lang, g.source, coalesce(sum(c.n) FILTER (WHERE k.term IS NOT NULL), 0) AS n FROM g LEFT JOIN c USING (lang, source) LEFT JOIN k ON k.lang = c.lang AND k.term = c.term GROUP BY ALL),
p AS (SELECT k.lang, t.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (t.n + v.terms) AS p, 1 + (1000000000::HUGEINT * (k.n + 1)) // (v.n + v.terms) AS q
    FROM k JOIN t USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = k.lang AND c.source = t.source AND c.term = k.term),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) s
    ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term AS (SELECT lang, source, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pair
    UNION ALL SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM term)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""
