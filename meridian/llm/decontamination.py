"""Benchmark decontamination by templates: numbers, names and units become typed slots, windows of templates meet
by hash, and slots must map consistently from the item to the document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meridian.llm.common import materialise, pieces, text_of, unused

#: Words for units of measure that become the slot <UNIT> (fixed values).
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons ounce "
    "ounces pound pounds ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day "
    "days week weeks month months year years percent dollar dollars euro euros cent cents degree degrees"
).split()
TRIM = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_NUMBER = r"^[+-]?[0-9]+([.,:/][0-9]+)*%?$"


class Templates:
    """Canonical words of texts: what each distinct word is when plain, and which slot it fills."""

    def __init__(self, texts: pa.Array):
        lists = pc.split_pattern_regex(texts, r"[\x20\x09-\x0D]+")
        lengths = np.diff(lists.offsets.to_numpy(zero_copy_only=False)).astype(np.int64)
        flat = lists.values.slice(lists.offsets[0].as_py(), int(lengths.sum())).dictionary_encode()
        codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        raw = flat.dictionary
        trimmed = pc.utf8_trim(raw, characters=TRIM)
        low = pc.utf8_lower(trimmed)
        self.values = low.to_pylist()
        held = lambda x: x.to_numpy(zero_copy_only=False).astype(bool)
        full = ~held(pc.equal(low, ""))
        number = held(pc.match_substring_regex(trimmed, _NUMBER))
        unit = held(pc.is_in(low, value_set=pa.array(UNITS, pa.string())))
        capital = held(pc.match_substring_regex(trimmed, r"^\p{Lu}\p{Ll}"))
        ends = held(pc.match_substring_regex(raw, r"[.!?:;|][^\p{L}\p{N}]*$"))
        owner = np.repeat(np.arange(len(lengths)), lengths)
        keep = full[codes]
        before = np.r_[True, (owner[1:] != owner[:-1]) | ends[codes[:-1]]] if len(codes) else np.zeros(0, bool)
        self.codes, self.owner = codes[keep], owner[keep]
        # A name is a capitalised word inside a sentence; at a sentence's start the case tells nothing: such a word
        # is plain, and in a second reading a name.
        name = capital[self.codes] & ~before[keep]
        kind = np.where(number[self.codes], 1, np.where(unit[self.codes], 2, np.where(name, 3, 0)))
        hashes = np.array([_word_hash(v) for v in self.values], dtype=np.uint64)
        self.plain = hashes[self.codes] if len(hashes) else np.zeros(0, np.uint64)
        self.kind = kind
        self.either = capital[self.codes] & before[keep] & (kind == 0)
        self.typed = np.where(kind > 0, _SLOTS[kind], self.plain)
        self.counts = np.bincount(self.owner, minlength=len(lengths))
        self.first = np.cumsum(self.counts) - self.counts

    def windows(self, size: int) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
        """Starts (in all words), mask and hashes of the windows of so many words inside a text, by template.

        A window comes once for each reading; bit k of the mask is set if word k, one of either kind, is a name.
        """
        n = len(self.typed) - size + 1
        if n <= 0:
            return
        inside = np.flatnonzero(self.owner[:n] == self.owner[size - 1 :])
        open_words = np.zeros(len(inside), np.int64)
        for k in range(size):
            open_words |= self.either[inside + k].astype(np.int64) << k
        ambiguous = open_words != 0
        for mask in range(1 << size):
            if mask == 1:  # from here on only windows with words of either kind
                inside, open_words = inside[ambiguous], open_words[ambiguous]
            if not len(inside):
                return
            at = inside[open_words & mask == mask]
            if not len(at):
                continue
            h = np.full(len(at), size, dtype=np.uint64)
            for k in range(size):
                h = (h ^ (_SLOTS[3] if mask >> k & 1 else self.typed[at + k])) * _PRIME
                h ^= h >> np.uint64(29)
            yield at, mask, h

    def valued(self, at: np.ndarray, size: int, mask: int, hashes: np.ndarray, least_plain: int) -> np.ndarray:
        """hashes, in which windows of under least_plain plain words take their slots' values along: templates of
        little more than slots are all alike and would meet everywhere."""
        slot = [(self.kind[at + k] > 0) | bool(mask >> k & 1) for k in range(size)]
        few = size - np.sum(slot, axis=0) < least_plain
        if not few.any():
            return hashes
        h = hashes.copy()
        for k in range(size):
            taken = few & slot[k]
            h[taken] = (h[taken] ^ self.plain[at[taken] + k]) * _PRIME
            h[taken] ^= h[taken] >> np.uint64(31)
        return h

    def slots(self, start: int, size: int, mask: int) -> list[str]:
        """The slots' values as kind and word, in order."""
        kinds = [3 if mask >> k & 1 else x for k, x in enumerate(self.kind[start : start + size].tolist())]
        return [f"{k}{self.values[c]}" for k, c in zip(kinds, self.codes[start : start + size].tolist()) if k]


_PRIME = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = np.array([0, 0x51ED270B5F3A1C29, 0x3C79AC492BA7B653, 0x1C69B3F74AC4AE35], dtype=np.uint64)


def _word_hash(word: str) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(word, 7)


def _template_rows(tables: Iterator[pa.RecordBatch], sizes: list[int], own_size: bool, wanted: np.ndarray | None, shortest: int, least_plain: int) -> Iterator[pa.RecordBatch]:
    """id, start, size, hash, slots of windows; own_size: an item shorter than the longest size has one of its own.
    Windows of under `shortest` words, or least_plain plain ones, meet by their slots' values too."""
    for batch in pieces(tables, max_bytes=4 << 20):
        t = Templates(batch.column(1))
        ids = batch.column(0).to_pylist()
        out: list[list] = [[], [], [], [], []]
        for size, (at, mask, hashes) in ((size, x) for size in sizes for x in t.windows(size)):
            hashes = t.valued(at, size, mask, hashes, least_plain if size >= shortest else size + 1)
            if own_size:
                ok = (size == sizes[-1]) | (t.counts[t.owner[at]] == size)
            elif wanted is not None:
                ok = wanted[np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)] == hashes if len(wanted) else np.zeros(len(at), bool)
            else:
                ok = np.ones(len(at), bool)
            for k, h in zip(at[ok].tolist(), hashes[ok].astype(np.int64).tolist()):
                text = int(t.owner[k])
                for column, x in zip(out, (ids[text], k - int(t.first[text]), size, h, t.slots(k, size, mask))):
                    column.append(x)
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(out, kinds)], ["id", "start", "size", "hash", "slots"])


_ROWS = "id long, start int, size int, hash long, slots array<string>"


def item_windows(benchmark: DataFrame, window: int = 8, shortest: int = 5, least_plain: int = 3) -> DataFrame:
    """Template windows of the items: `window` words each, or the whole of a shorter item."""
    rows = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("id"), text_of().alias("text"))
    return rows.mapInArrow(lambda b: _template_rows(b, list(range(1, window + 1)), True, None, shortest, least_plain), _ROWS)


def leaks(
    docs: DataFrame, benchmark: DataFrame, window: int = 8, shortest: int = 5, coverage: float = 0.5, max_broadcast: int = 1_000_000, shift: int = 4, least_plain: int = 3
) -> DataFrame:
    """(doc_id, item_id, matched, windows, coverage) for every document that holds an item, whole or in good part.

    A document holds an item if the windows of the item that match it, by template and with consistent slots, are
    at least `coverage` of all the item's windows. Slots are consistent if item values and document values stand for
    each other one to one throughout the document, or throughout one occurrence: windows whose places, document less
    item, follow each other by `shift` words or fewer. A template of under `shortest` words says too little, so an
    item that short must occur with its own values, as must a window of under least_plain plain words. Up to max_broadcast item windows are sent to all tasks, which
    then drop other windows before the join; beyond that all windows are shuffled and give the same rows. Case and
    marks around words don't count; a capitalised word at a sentence's start is read both as an ordinary word and as
    a name. Items without words or with null text match nothing; null and empty texts hold nothing; a null doc_id or
    item_id never joins a pair; rows of one doc_id count as one document; of equal item ids all texts count as one
    item; empty tables give no rows.
    """
    items = materialise(item_windows(benchmark, window, shortest, least_plain))
    few = items.limit(max_broadcast + 1).count() <= max_broadcast
    wanted = np.unique(np.array([r[0] for r in items.select("hash").distinct().collect()], dtype=np.int64).view(np.uint64)) if few else None
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())  # `window` numbers at most
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text_of().alias("text")).where("id is not null")
    found = rows.mapInArrow(lambda b: _template_rows(b, sizes, False, wanted, shortest, least_plain), _ROWS)
    left = items.select(F.col("id").alias("item_id"), F.col("start").alias("item_start"), "size", "hash", F.col("slots").alias("slots_item"))
    right = found.select(F.col("id").alias("doc_id"), F.col("start").alias("doc_start"), "size", "hash", F.col("slots").alias("slots_doc")).distinct()
    met = right.join(F.broadcast(left) if few else left, ["hash", "size"]).where("item_id is not null")
    met = met.where((F.col("size") >= shortest) | (F.col("slots_item") == F.col("slots_doc")))
    met = materialise(met.select("doc_id", "item_id", "item_start", (F.col("doc_start") - F.col("item_start")).alias("offset"), "slots_item", "slots_doc"))
    along = Window.partitionBy("doc_id", "item_id").orderBy("offset")
    met = met.withColumn("far", (F.col("offset") - F.lag("offset", 1).over(along) > shift).cast("int"))
    met = met.withColumn("occurrence", F.coalesce(F.sum("far").over(along), F.lit(0)))
    # Occurrence -1 is the whole document.
    met = met.withColumn("occurrence", F.explode(F.array(F.lit(-1).cast("long"), F.col("occurrence").cast("long")))).drop("far", "offset").distinct()
    # What a value stands for is what most of an occurrence's windows show, both ways.
    of = ["doc_id", "item_id", "occurrence"]
    pairs = met.select(*of, "item_start", F.explode(F.arrays_zip("slots_item", "slots_doc")).alias("p"))
    votes = pairs.groupBy(*of, F.col("p.slots_item").alias("a"), F.col("p.slots_doc").alias("b")).agg(F.countDistinct("item_start").alias("n"))

    def usual(x: str, y: str, name: str) -> DataFrame:
        most = votes.groupBy(*of, x).agg(F.max_by(y, F.struct("n", y)).alias(y))
        return most.groupBy(*of).agg(F.map_from_entries(F.collect_list(F.struct(x, y))).alias(name))

    joined = met.join(usual("a", "b", "to"), of, "left").join(usual("b", "a", "back"), of, "left")
    both_ways = lambda p: (F.col("to")[p["slots_item"]] == p["slots_doc"]) & (F.col("back")[p["slots_doc"]] == p["slots_item"])
    agree = F.coalesce(F.forall(F.arrays_zip("slots_item", "slots_doc"), both_ways), F.lit(True))
    good = joined.where(agree).groupBy(*of).agg(F.countDistinct("item_start").alias("matched"))
    good = good.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"))
    whole = items.groupBy(F.col("id").alias("item_id")).agg(F.countDistinct("start").alias("windows"))
    share = good.join(whole, "item_id").withColumn("coverage", F.col("matched") / F.col("windows"))
    return share.where(F.col("coverage") >= coverage).select("doc_id", "item_id", "matched", "windows", "coverage")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """The rows of docs, all columns, whose document holds no item of the benchmark; rows without doc_id stay."""
    key = unused(docs, "_held_id")
    held = leaks(docs, benchmark, **params).select(F.col("doc_id").alias(key)).distinct()
    return docs.join(held, docs["doc_id"] == held[key], "left_anti")
