"""Substring deduplication by suffix order: longest previous factors against documents with smaller ids.

A 50-byte string holds 35 grams of 16 bytes; the leftmost one of least hash is its anchor, so equal strings have
equal anchors at equal places. Only anchors that two rows share can lead to a repeat. The strings of one anchor in
one document form a segment of at most 84 bytes; segments meet by anchor. In suffix order, the common prefixes with
the previous and the next smaller id give the longest previous factor where a segment starts; it shrinks by one at
most from one start to the next, so it settles the starts that follow. The starts it leaves open get factors of their
own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import NO_ID, materialise, pieces, text_of

GRAM = 16
_BYTE = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of every GRAM bytes in a row, by doubling."""
    h, width = _BYTE[data], 1
    while width < GRAM:
        h = (h[:-width] * _MIX) ^ (h[width:] + (h[:-width] >> np.uint64(29)))
        width *= 2
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(32))


def segments(data: np.ndarray, bounds: np.ndarray, window: int, chunk: int = 1 << 20) -> tuple[np.ndarray, ...]:
    """Anchor hash, text number, first and last window start of every segment of texts data[bounds[i]:bounds[i+1]]."""
    span = window - GRAM + 1
    found: list[tuple[np.ndarray, ...]] = []
    for at in range(0, max(len(data) - window + 1, 0), chunk):
        part = data[at : at + chunk + window - 1]
        h = _gram_hashes(part)
        low, place, width = h, np.arange(len(h), dtype=np.int32), 1
        while width < span:
            step = min(width, span - width)
            left = low[:-step] <= low[step:]
            low, place = np.where(left, low[:-step], low[step:]), np.where(left, place[:-step], place[step:])
            width += step
        n = len(part) - window + 1
        starts = np.arange(at, at + n)
        own = np.searchsorted(bounds, starts, side="right") - 1
        fits = starts + window <= bounds[own + 1]
        new = np.r_[True, (place[1:n] != place[: n - 1]) | (own[1:] != own[:-1])] & fits
        first = np.flatnonzero(new)
        last = np.r_[first[1:], n] - 1
        # The last starts of a text that don't fit follow its last segment; cut them off.
        last = np.minimum(last, bounds[own[first] + 1] - window - at)
        found.append((low[first], own[first], starts[first], last + at))
    if not found:
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    return tuple(np.concatenate(x) for x in zip(*found))


def _nearest_smaller(values: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """For each place in suffix order the common prefix with the nearest earlier place of smaller value (0: none).

    lcp[i] is the common prefix of places i - 1 and i. Pointers jump over places of no smaller value, all at once;
    places whose common prefix falls under `least` stop.
    """
    point, near = np.arange(len(values)) - 1, lcp.copy()
    live = np.flatnonzero((near >= least) & (point >= 0))
    while len(live := live[(near[live] >= least) & (point[live] >= 0)]):
        live = live[values[point[live]] >= values[live]]
        to = point[live]
        near_to, point_to = near[to], point[to]
        near[live], point[live] = np.minimum(near[live], near_to), point_to
    return np.where(point >= 0, near, 0)


def previous_factors(rows: np.ndarray, lengths: np.ndarray, ids: np.ndarray, least: int = 1) -> np.ndarray:
    """Longest previous factor of each string: the longest prefix that it shares with one of smaller id.

    Strings are rows of a byte matrix, padded with zeros after their lengths. Factors under `least` may come out as 0.
    """
    n, size = rows.shape
    if not n:
        return np.zeros(0, np.int64)
    by_length = np.argsort(lengths, kind="stable")
    order = by_length[np.argsort(np.ascontiguousarray(rows[by_length]).view(f"S{size}").ravel(), kind="stable")]
    ranked, long = rows[order], lengths[order]
    differs = ranked[1:] != ranked[:-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), size)
    lcp = np.r_[0, np.minimum(common, np.minimum(long[1:], long[:-1]))]
    values = ids[order]
    before = _nearest_smaller(values, lcp, least)
    after = _nearest_smaller(values[::-1], np.r_[0, lcp[1:][::-1]], least)[::-1]
    out = np.empty(n, np.int64)
    out[order] = np.maximum(before, after)
    return out


def _block(table: pa.Table) -> tuple[list, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """A block's rows in a fixed order: ids, texts, ids as numbers, all bytes, bounds of the texts."""
    rows = []
    for numbers, texts in zip(table["numbers"].to_pylist(), table["texts"].to_pylist()):
        ids, known, lengths = _unpack(numbers, 3)
        ends, whole = np.cumsum(lengths).tolist(), _expand(texts)
        rows += [(i if k else None, whole[e - n : e]) for i, k, n, e in zip(ids.tolist(), known.tolist(), lengths.tolist(), ends)]
    rows.sort(key=lambda r: (NO_ID if r[0] is None else r[0], r[1]))
    texts = [r[1] for r in rows]
    numbers = np.array([NO_ID if r[0] is None else r[0] for r in rows], dtype=np.int64)
    bounds = np.cumsum([0, *map(len, texts)])
    return [r[0] for r in rows], texts, numbers, np.frombuffer(b"".join(texts), dtype=np.uint8), bounds


def _in_blocks(docs: DataFrame, n_blocks: int, most: int = 32 << 20) -> DataFrame:
    """block, numbers, texts: docs (doc_id, text as bytes) dealt into blocks, packed together by task and block."""

    def chunks(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        blocks, ids = table["block"].to_numpy(), table["doc_id"]
        known = ids.is_valid().to_numpy().astype(np.int64)
        ids, texts = ids.fill_null(0).to_numpy(), table["text"].to_pylist()
        for block, at in _split(blocks):
            some = [texts[k] for k in at]
            cells = ([block], [_pack(ids[at], known[at], np.array([len(x) for x in some]))], [_compress(b"".join(some))])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, (LONG, BLOB, BLOB))], ["block", "numbers", "texts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in pieces(batches, max_bytes=most):
            if held and size + batch.nbytes > most:
                yield from chunks(held)
                held, size = [], 0
            held, size = [*held, batch], size + batch.nbytes
        if held:
            yield from chunks(held)

    rows = docs.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)))
    return rows.mapInArrow(run, "block long, numbers binary, texts binary")


def _bytes_of(data: np.ndarray, first: np.ndarray, last: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The segments' bytes as rows padded with zeros, and their lengths."""
    size = 2 * window - GRAM
    lengths = last - first + window
    at = first[:, None] + np.arange(size)
    rows = data[np.minimum(at, len(data) - 1)]
    rows[np.arange(size) >= lengths[:, None]] = 0
    return rows, lengths


def _row_hashes(rows: np.ndarray) -> np.ndarray:
    """A hash of each row of a byte matrix."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    h = np.full(len(rows), rows.shape[1], np.uint64)
    for word in wide.view("<u8").T:
        h = (h ^ word) * _MIX
        h ^= h >> np.uint64(31)
    return h


def _split(owner: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each owner and the places it holds, after one sort."""
    order = np.argsort(owner, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(owner[order]) != 0]) if len(order) else []
    for a, b in zip(cuts, [*cuts[1:], len(order)]):
        yield int(owner[order[a]]), order[a:b]


def _table(names: list[str], rows: list[tuple], kinds: tuple) -> pa.Table:
    return pa.table([pa.array(c, type=k) for c, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)], names=names)


LONG, BLOB = pa.int64(), pa.binary()


def _compress(raw: bytes, level: int = 6) -> bytes:
    """Compressed bytes, with their size in front."""
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=level).compress(raw, asbytes=True)


def _expand(cell: bytes) -> bytes:
    return pa.decompress(cell[8:], int.from_bytes(cell[:8], "little"), codec="zstd", asbytes=True)


def _pack(*rows: np.ndarray) -> bytes:
    """Rows of numbers, equally many in each: the steps between neighbours, byte by byte of all, compressed."""
    steps = np.diff(np.stack(rows).astype(np.int64), axis=1, prepend=0)
    steps = np.ascontiguousarray((steps << 1) ^ (steps >> 63))
    return _compress(steps.view(np.uint8).reshape(len(rows), -1, 8).transpose(0, 2, 1).tobytes())


def _unpack(cell: bytes, rows: int) -> np.ndarray:
    planes = np.frombuffer(_expand(cell), np.uint8).reshape(rows, 8, -1).transpose(0, 2, 1)
    steps = np.ascontiguousarray(planes).view(np.uint64)[:, :, 0]
    return np.cumsum((steps >> np.uint64(1)).view(np.int64) ^ -(steps & np.uint64(1)).view(np.int64), axis=1)


def _key_bytes(keys: np.ndarray) -> bytes:
    """Keys of up to 48 bits, six bytes each."""
    return np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _keys(cell: bytes) -> np.ndarray:
    wide = np.zeros((len(cell) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(cell, np.uint8).reshape(-1, 6)
    return wide.view(np.uint64).ravel()


SHARED = "block long, keys binary"
SENT = "bucket long, block long, keys binary, numbers binary, bytes binary"
SPANS = "block long, numbers binary"


def remove_repeats(docs: DataFrame, window: int = 50, block_bytes: int = 4 << 20, hot_blocks: int = 256, most_even: int = 128, most_rows: int = 1 << 16) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes that stay) for every row of docs.

    Texts are UTF-8 bytes, a null one is empty. A byte goes if a string of `window` bytes that covers it also
    starts in a row of smaller doc_id; strings are judged on the input. A null doc_id counts as larger than all
    others; rows of one doc_id don't remove each other's bytes; an empty table gives no rows. Rows are dealt into
    blocks of about block_bytes by a hash of doc_id; a longer text makes its block longer. A segment that repeats
    one of its block is settled there, so a passage in many documents costs a row per block. Anchors of more than
    hot_blocks blocks don't meet in one task: their strings are dealt out one by one, by their own hashes. Up to
    most_even blocks there are as many buckets of anchors, beyond that an eighth as many at least; a bucket's
    segments are put in suffix order in parts of about most_rows. Texts, bytes and numbers are shuffled compressed.
    """
    if not GRAM < window <= 4096:
        raise ValueError(f"window must be over {GRAM}, and 4096 at most")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("binary").alias("text"))
    total = docs.agg(F.sum(F.octet_length(text_of()))).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    # Every block sends to every bucket: with as many buckets as blocks the cells would grow with the square.
    n_buckets = min(n_blocks, max(most_even, n_blocks // 8))
    short = lambda keys: keys >> np.uint64(17) << np.uint64(1)  # noqa: E731  47 bits, and one for a mark

    def by_bucket(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        return _split(((keys >> np.uint64(1)) % np.uint64(n_buckets)).astype(np.int64))

    def anchors(table: pa.Table) -> pa.Table:
        """The block's distinct anchors by bucket; the lowest bit of a key tells that two rows of the block have it."""
        block = table["block"][0].as_py()
        _, _, _, data, bounds = _block(table)
        keys, text, _, _ = segments(data, bounds, window)
        keys = short(keys)
        order = np.lexsort((text, keys))
        keys, text = keys[order], text[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        final = np.r_[first[1:], len(keys)] - 1 if len(keys) else first
        distinct = keys[first] | (text[first] != text[final]).astype(np.uint64)
        return _table(["bucket", "block", "keys"], [(b, block, _key_bytes(distinct[k])) for b, k in by_bucket(distinct)], (LONG, LONG, BLOB))

    def shared(table: pa.Table) -> pa.Table:
        """For each block those of its anchors that two rows have; the lowest bit of a key marks the hot ones."""
        parts = [_keys(x) for x in table["keys"].to_pylist()]
        keys, owner = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        flagged, keys = (keys & np.uint64(1)).astype(bool), keys >> np.uint64(1)
        _, same, held = np.unique(keys, return_inverse=True, return_counts=True)
        number = held + np.bincount(same, weights=flagged, minlength=len(held)).astype(np.int64)
        good = number[same] > 1
        marked = ((keys << np.uint64(1)) | (held[same] > hot_blocks).astype(np.uint64))[good]
        names = table["block"].to_pylist()
        return _table(["block", "keys"], [(names[k], _key_bytes(marked[at])) for k, at in _split(owner[good])], (LONG, BLOB))

    def candidates(key: tuple, table: pa.Table, known: pa.Table) -> pa.Table:
        """The block's segments at shared anchors; what repeats a segment of the block is settled here."""
        if not table.num_rows or not known.num_rows:
            return _table(SENT_NAMES, [], SENT_KINDS)
        block = table["block"][0].as_py()
        _, _, numbers, data, bounds = _block(table)
        wanted = np.sort(np.concatenate([_keys(x) for x in known["keys"].to_pylist()]))
        keys, text, first, last = segments(data, bounds, window)
        keys = short(keys)
        near = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
        hot = (wanted[near] & np.uint64(1)).astype(bool)
        keep = wanted[near] >> np.uint64(1) == keys >> np.uint64(1)
        keys, text, first, last, hot = keys[keep], text[keep], first[keep], last[keep], hot[keep]
        if not len(keys):
            return _table(SENT_NAMES, [], SENT_KINDS)
        rows, lengths = _bytes_of(data, first, last, window)
        settled = previous_factors(rows, lengths, numbers[text], window) >= lengths
        whole = np.flatnonzero(settled)
        out = [(-1, block, b"", _pack(text[whole], (first - bounds[text])[whole], lengths[whole]), b"")]
        single = np.flatnonzero(~settled & hot)
        left = np.flatnonzero(~settled & ~hot)
        parts = [(keys[left], text[left], first[left], lengths[left])]
        if len(single):
            windows = lengths[single] - window + 1
            which = np.repeat(single, windows)
            at = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(windows) - windows, windows)
            parts.append((short(_row_hashes(data[at[:, None] + np.arange(window)])), text[which], at, np.full(len(which), window)))
        keys, text, first, lengths = (np.concatenate(x) for x in zip(*parts))
        for bucket, k in by_bucket(keys):
            rows, _ = _bytes_of(data, first[k], first[k] + lengths[k] - window, window)
            held = rows[np.arange(rows.shape[1]) < lengths[k, None]]
            like = ((keys[k] >> np.uint64(1)) // np.uint64(n_buckets)).astype(np.uint32)
            out.append((bucket, block, like.tobytes(), _pack(numbers[text[k]], text[k], first[k] - bounds[text[k]], lengths[k]), _compress(held.tobytes())))
        return _table(SENT_NAMES, out, SENT_KINDS)

    def factors(key: tuple, table: pa.Table) -> pa.Table:
        """Repeats among a bucket's segments, as runs of window starts by block."""
        if key[0].as_py() < 0:
            return table.select(["block", "numbers"])
        keys = [np.frombuffer(x, np.uint32) for x in table["keys"].to_pylist()]
        owner, keys = np.repeat(np.arange(len(keys)), [len(x) for x in keys]), np.concatenate(keys)
        ids, text, first, lengths = np.concatenate([_unpack(x, 4) for x in table["numbers"].to_pylist()], axis=1)
        data = np.frombuffer(b"".join(map(_expand, table["bytes"].to_pylist())), np.uint8)
        offset = np.cumsum(lengths) - lengths
        spans = []
        # A bucket's anchors are settled some at a time, so that its arrays stay small.
        for _, part in _split(keys % np.uint32(-(-len(keys) // most_rows))):
            spans += [(owner[at], text[at], first[at] + step, long) for at, step, long in repeats(keys[part], ids[part], offset[part], lengths[part], data, part)]
        owner, text, first, long = (np.concatenate(x) for x in zip(*spans))
        names = table["block"].to_pylist()
        return _table(SPAN_NAMES, [(names[k], _pack(text[at], first[at], long[at])) for k, at in _split(owner)], (LONG, BLOB))

    def repeats(keys: np.ndarray, ids: np.ndarray, offset: np.ndarray, lengths: np.ndarray, data: np.ndarray, names: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Of segments data[offset : offset + length], named, those repeated: name, place in the segment, length."""
        rows, _ = _bytes_of(data, offset, offset + lengths - window, window)
        factor = previous_factors(rows, lengths, ids, window)
        hit = factor >= window
        yield names[hit], np.zeros(int(hit.sum()), np.int64), factor[hit]
        # A string of smallest id is never among the settled ones, so the starts left open meet it among their like.
        left = np.flatnonzero(factor < lengths)
        _, at, number = np.unique(keys[left], return_inverse=True, return_counts=True)
        left = left[number[at] > 1]
        if len(left):
            skip = np.maximum(factor[left] - window + 1, 0)
            windows = lengths[left] - window + 1 - skip
            which = np.repeat(left, windows)
            step = np.arange(len(which)) - np.repeat(np.cumsum(windows) - windows - skip, windows)
            size = np.full(len(which), window)
            again = previous_factors(data[(offset[which] + step)[:, None] + np.arange(window)], size, ids[which], window) >= window
            which, step = which[again], step[again]
            if len(which):
                new = np.flatnonzero(np.r_[True, (which[1:] != which[:-1]) | (step[1:] != step[:-1] + 1)])
                final = np.r_[new[1:], len(which)] - 1
                yield names[which[new]], step[new], step[final] - step[new] + window

    def cut(key: tuple, table: pa.Table, spans: pa.Table) -> pa.Table:
        """Each row without its repeated bytes."""
        ids, texts, _, data, bounds = _block(table)
        turn = np.zeros(len(data) + 1, np.int32)
        for text, first, length in (_unpack(x, 3) for x in spans["numbers"].to_pylist()):
            np.add.at(turn, bounds[text] + first, 1)
            np.add.at(turn, bounds[text] + first + length, -1)
        gone = np.cumsum(turn[:-1]) > 0
        out = []
        for k, text in enumerate(texts):
            mark = gone[bounds[k] : bounds[k + 1]]
            n = int(mark.sum())
            kept = data[bounds[k] : bounds[k + 1]][~mark].tobytes() if n else text
            n_spans = int(mark[0]) + int(np.sum(mark[1:] & ~mark[:-1])) if n else 0
            out.append((ids[k], len(text), n, n_spans, hashlib.sha256(kept).hexdigest(), kept))
        return _table(["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"], out, (LONG, LONG, LONG, LONG, pa.string(), BLOB))

    SENT_NAMES, SENT_KINDS = [x.split()[0] for x in SENT.split(", ")], (LONG, LONG, *[BLOB] * 3)
    SPAN_NAMES = [x.split()[0] for x in SPANS.split(", ")]
    by_block = _in_blocks(rows, n_blocks).groupBy("block")
    # Written, so that the anchors' shuffle is gone before the segments' begins: both together were the peak of disk.
    found = materialise(by_block.applyInArrow(anchors, "bucket long, block long, keys binary").groupBy("bucket").applyInArrow(shared, SHARED))
    sent = by_block.cogroup(found.groupBy("block")).applyInArrow(candidates, SENT)
    # Settled rows carry bucket -1; their own block number deals them out.
    salt = F.when(F.col("bucket") < 0, -1 - F.col("block")).otherwise(F.col("bucket"))
    spans = sent.withColumn("bucket", salt).groupBy("bucket").applyInArrow(factors, SPANS)
    return by_block.cogroup(spans.groupBy("block")).applyInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
