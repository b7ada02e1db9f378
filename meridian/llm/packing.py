"""Token ids packed into fixed rows: best-fit-decreasing with a segment tree over free capacities."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from meridian.llm.common import pieces, text_of

#: The cut of a text into pre-tokens that byte-level vocabularies of this family use (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: ASCII blanks before a word go with the word; no pre-token reaches from a word into the blanks after it.
UNIT = re.compile(r"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+\Z")
#: Blanks beyond ASCII, and what only some libraries take for blanks: such texts are encoded in one go.
ODD = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
SCHEMA = "bin_id long, n_tokens int, ids binary, position_ids binary, cu_seqlens array<int>, doc_ids array<long>, piece_starts array<int>"


class Encoder:
    """Ids of texts under a byte-level rank file; each distinct word with the blanks before it is encoded once."""

    def __init__(self, ranks_path: str, max_entries: int = 500_000):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.dtype = np.dtype("<u2" if max(ranks.values()) < 1 << 16 else "<u4")
        self.units: dict[str, bytes] = {}
        self.max_entries = max_entries

    def _encode(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), dtype=self.dtype).tobytes()

    def __call__(self, text: str) -> bytes:
        if ODD.search(text):
            return self._encode(text)
        units, known = UNIT.findall(text), self.units
        try:
            return b"".join([known[u] for u in units])
        except KeyError:
            if len(known) > self.max_entries:
                known.clear()
            for u in units:
                if u not in known:
                    known[u] = self._encode(u)
            return b"".join([known[u] for u in units])


class Capacities:
    """Open bins by free room; a segment tree over rooms finds the least room that still fits."""

    def __init__(self, room: int):
        self.size = 1 << room.bit_length()
        self.used = [0] * (2 * self.size)  # number of open bins below each node
        self.bins: list[list[int]] = [[] for _ in range(room + 1)]

    def put(self, room: int, which: int) -> None:
        self.bins[room].append(which)
        at = room + self.size
        while at:
            self.used[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The bin with the least room of need or more, and that room; None if no open bin has it."""
        at = need + self.size
        if not self.used[at]:
            while at > 1 and (at & 1 or not self.used[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.used[2 * at] else 2 * at + 1
        room = at - self.size
        while at:
            self.used[at] -= 1
            at >>= 1
        return self.bins[room].pop(), room


def best_fit_decreasing(lengths: list[int], room: int) -> list[list[int]]:
    """Bins of indices into lengths, each length between 1 and room; longest first, each to the tightest open bin."""
    tree, bins = Capacities(room), []
    for k in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        if found := tree.take(lengths[k]):
            which, free = found
        else:
            which, free = len(bins), room
            bins.append([])
        bins[which].append(k)
        if free > lengths[k]:
            tree.put(free - lengths[k], which)
    return bins


_ENCODERS: dict[str, Encoder] = {}


def pack_tokens(docs: DataFrame, ranks_path: str, seq_len: int = 2048, buffer_tokens: int = 1 << 20, pad_id: int = 0) -> DataFrame:
    """Packed rows of seq_len ids from docs (doc_id, text).

    One row per bin: bin_id, n_tokens in use, ids (seq_len little-endian numbers of 2 bytes, of 4 for vocabularies
    over 65,536; pad_id after n_tokens), position_ids (the same layout, 0 at each piece's start), cu_seqlens
    (0, end of each piece), doc_ids and piece_starts (each piece's document and place among its tokens).
    Documents over seq_len are cut into pieces; in order of piece_starts the pieces give all tokens again. Packing
    runs within each input partition over a buffer of buffer_tokens, so nothing is shuffled and a lost task is
    simply run again. A null or empty text has no tokens and so no piece; a null doc_id stays null; repeated rows
    are each packed; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _ENCODERS.get(ranks_path) or _ENCODERS.setdefault(ranks_path, Encoder(ranks_path))
        dtype = encode.dtype
        step = dtype.itemsize
        counting = np.arange(seq_len, dtype=dtype)
        context = TaskContext.get()
        next_bin = (context.partitionId() if context else 0) << 33
        held: list[tuple[int | None, int, bytes]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal next_bin
            rows: list[tuple] = []
            for members in best_fit_decreasing([len(x[2]) // step for x in held], seq_len):
                parts = [held[k] for k in members]
                ends = np.cumsum([0, *(len(x[2]) // step for x in parts)])
                ids = np.full(seq_len, pad_id, dtype=dtype)
                ids[: ends[-1]] = np.frombuffer(b"".join(x[2] for x in parts), dtype=dtype)
                places = np.zeros(seq_len, dtype=dtype)
                for a, b in zip(ends[:-1], ends[1:]):
                    places[a:b] = counting[: b - a]
                rows.append((next_bin, int(ends[-1]), ids.tobytes(), places.tobytes(), ends.tolist(), [x[0] for x in parts], [x[1] for x in parts]))
                next_bin += 1
            held.clear()
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()))
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in pieces(batches, max_bytes=2 << 20):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text)
                for at in range(0, len(ids), seq_len * step):
                    held.append((doc_id, at // step, ids[at : at + seq_len * step]))
                size += len(ids) // step
                if size >= buffer_tokens:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    if seq_len > 1 << 16:
        raise ValueError("seq_len must fit position ids of two bytes")
    import pyspark.sql.functions as F

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write packed rows: ids and position matrices as fixed-width binary cells, offsets as lists."""
    packed.write.mode("overwrite").parquet(path)
