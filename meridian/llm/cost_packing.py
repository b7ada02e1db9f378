"""Cost-balanced packing: pieces, largest first, to the sequence whose attention so far costs least and has room."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import pieces, text_of
from meridian.llm.packing import ODD

#: Texts that go to the library whole: blanks beyond ASCII's, and what may be a special token.
WHOLE = ODD.pattern + r"|<\|"
#: A plain unit has no blank in it but one space in front.
PLAIN = r"^ ?[^\t-\r ]"
#: Classes of bytes. All that is not ASCII is OTHER, but for Latin letters up to U+024F.
OTHER, SPACE, BLANK, LETTER, DIGIT, MARK, QUOTE = range(7)
CLASS = np.full(256, OTHER, np.uint8)
CLASS[[*range(33, 127)]] = MARK
CLASS[[*range(65, 91), *range(97, 123), *range(0xC3, 0xCA)]] = LETTER
CLASS[[*range(48, 58)]], CLASS[39], CLASS[[*range(9, 14)]], CLASS[32] = DIGIT, QUOTE, BLANK, SPACE
#: Where a unit starts, by the classes of the byte before and the byte itself: before blanks, and between letters, digits
#: and marks, which are never one pre-token but for a quote with the letters after it ("'s").
STARTS = np.zeros((8, 8), bool)
for before, after in ((OTHER, ()), (LETTER, (DIGIT, MARK, QUOTE)), (DIGIT, (LETTER, MARK, QUOTE)), (MARK, (LETTER, DIGIT)), (QUOTE, ())):
    STARTS[before, [SPACE, BLANK, *after]] = True
SCHEMA = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, sequence_cost double"


def units_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Units of all texts as one array over the texts' own bytes, and the number of units before each text and at the end.

    A unit is whole pre-tokens, the same alone as in its text: a word, number or run of marks with the blanks before it.
    """
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    low, size = int(offsets[0]), int(offsets[-1] - offsets[0])
    if not size:
        return pa.array([], pa.binary()), np.zeros(len(texts) + 1, np.int64)
    data, offsets = data.slice(low, size), offsets - low
    raw = np.frombuffer(data, np.uint8)
    kind = CLASS[raw]
    lead = np.flatnonzero((raw >= 0xC3) & (raw < 0xCA))
    lead = lead[lead < size - 1]
    follow = raw[lead + 1]
    odd = (raw[lead] == 0xC3) & ((follow == 0x97) | (follow == 0xB7)) | (raw[lead] == 0xC9) & (follow > 0x8F)
    kind[lead] = kind[lead + 1] = np.where(odd, OTHER, LETTER)
    start = np.zeros(size, bool)
    start[1:] = STARTS.ravel()[kind[:-1] << 3 | kind[1:]]
    # One blank that is no space stands alone before a word; of several, the last would not be cut off as it is here.
    line = np.flatnonzero(kind == BLANK)
    line = line[(line > 0) & (line < size - 1)]
    is_blank = lambda at: (kind[at] == SPACE) | (kind[at] == BLANK)
    start[line[~is_blank(line - 1) & ~is_blank(line + 1)] + 1] = True
    start[offsets[:-1][np.diff(offsets) > 0]] = True
    at = np.flatnonzero(start)
    bounds = np.append(at, size).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(bounds), data]), np.searchsorted(at, offsets)


class LibraryIds:
    """Ids of texts as the tokenizers library gives them under a byte-level file, special strings by its default.

    Each distinct unit goes to the library once, while it is known; texts with other blanks than ASCII's, or with "<|",
    go to it whole. Ids are native 32-bit numbers, little-endian where Spark runs. The unit at place k of `known` has
    the ids from bounds[k] to bounds[k + 1] of `ids`, and asked[k] batches had it."""

    def __init__(self, tokenizer_path: str, max_entries: int = 1_000_000, max_bytes: int = 32 << 20, lines: int = 1024):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.dtype = np.dtype("<u4")
        self.max_entries, self.max_bytes, self.lines = max_entries, max_bytes, lines
        self.known = pa.array([], pa.binary())
        self.ids, self.bounds, self.asked = np.zeros(0, self.dtype), np.zeros(1, np.int64), np.zeros(0, np.int64)
        self.line = self._encode(["\n"])[0]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_plain(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain units and how many each has. They go to the library as the lines of texts, as a line's end
        before a plain unit is a pre-token by itself, and its id is in no plain unit."""
        cuts = pa.array([*range(0, len(units), self.lines), len(units)], pa.int32())
        texts = pa.compute.binary_join(pa.ListArray.from_arrays(cuts, units), b"\n").cast(pa.string()).to_pylist()
        ids = np.concatenate([x for one in self._encode(texts) for x in (one, self.line)])
        ends = np.flatnonzero(ids == self.line[0])
        if len(self.line) != 1 or len(ends) != len(units):
            return self._encode_each(units)
        return ids[ids != self.line[0]], np.diff(ends, prepend=-1) - 1

    def _encode_each(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = self._encode(units.cast(pa.string()).to_pylist())
        return np.concatenate(found), np.array([len(x) for x in found])

    def _forget(self) -> None:
        """Keep what more than one batch had, if that is half of what may be known or less."""
        keep = self.asked > 1
        kept = self.known.filter(pa.array(keep))
        if 2 * len(kept) > self.max_entries or 2 * kept.nbytes > self.max_bytes:
            keep[:], kept = False, kept.slice(0, 0)
        n = np.diff(self.bounds)
        self.known, self.ids = kept, self.ids[np.repeat(keep, n)]
        self.bounds, self.asked = np.append(0, np.cumsum(n[keep])), np.zeros(len(kept), np.int64)

    def _places(self, distinct: pa.Array) -> np.ndarray:
        """Places of distinct units in `known`; those that are not there yet go to the library."""
        found = pa.compute.index_in(distinct, value_set=self.known)
        if len(self.known) + found.null_count > self.max_entries or self.known.nbytes + distinct.nbytes > self.max_bytes:
            self._forget()
            found = pa.compute.index_in(distinct, value_set=self.known)
        at = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        missing = np.flatnonzero(at < 0)
        plain = pa.compute.match_substring_regex(distinct.take(pa.array(missing)), PLAIN).to_numpy(zero_copy_only=False).astype(bool)
        for those, encode in ((missing[plain], self._encode_plain), (missing[~plain], self._encode_each)):
            if len(those):
                new = distinct.take(pa.array(those))
                ids, n = encode(new)
                at[those] = len(self.known) + np.arange(len(those))
                self.known, self.ids = pa.concat_arrays([self.known, new]), np.concatenate([self.ids, ids])
                self.bounds = np.append(self.bounds, self.bounds[-1] + np.cumsum(n))
        self.asked = np.append(self.asked, np.zeros(len(missing), np.int64))
        self.asked[at] += 1
        return at

    def __call__(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text (none of them null) as 4 little-endian bytes each."""
        apart = pa.compute.match_substring_regex(texts, WHOLE)
        whole = [x.tobytes() for x in self._encode(texts.filter(apart).to_pylist())]
        units, first = units_of(pa.compute.if_else(apart, pa.scalar("", texts.type), texts) if whole else texts)
        words = units.dictionary_encode()
        unit = self._places(words.dictionary)[words.indices.to_numpy(zero_copy_only=False)]
        length = np.diff(self.bounds)
        ids = [np.zeros(0, self.dtype)]
        for some in (unit[k : k + (1 << 16)] for k in range(0, len(unit), 1 << 16)):
            n = length[some]
            ends = np.cumsum(n)
            ids.append(self.ids[np.repeat(self.bounds[some] - ends + n, n) + np.arange(ends[-1])])
        ids = np.concatenate(ids)
        at = np.append(0, np.cumsum(length[unit]))[first].tolist()
        out = [ids[a:b].tobytes() for a, b in zip(at, at[1:])]
        for k, x in zip(np.flatnonzero(apart.to_numpy(zero_copy_only=False)), whole):
            out[k] = x
        return out


class Sequences:
    """Open sequences by free room, each room with the cheapest first; a segment tree over rooms has the least cost
    below each node, so that the cheapest sequence with room enough is found in the tree's depth."""

    def __init__(self, rooms: list[int]):
        most = max(rooms, default=0)
        self.size = 1 << most.bit_length()
        self.least = [float("inf")] * (2 * self.size)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(self.size)]
        for k, room in enumerate(rooms):
            self.put(room, 0.0, k)

    def _update(self, room: int) -> None:
        at = room + self.size
        self.least[at] = self.heaps[room][0][0] if self.heaps[room] else float("inf")
        while at > 1:
            at >>= 1
            self.least[at] = min(self.least[2 * at], self.least[2 * at + 1])

    def put(self, room: int, cost: float, which: int) -> None:
        if room:
            heapq.heappush(self.heaps[room], (cost, which))
            self._update(room)

    def take(self, need: int) -> tuple[int, float, int] | None:
        """Room, cost and number of the cheapest sequence with room for `need`; None if there is none."""
        best, found = float("inf"), 0
        low, high = need + self.size, 2 * self.size
        while low < high:
            if low & 1:
                if self.least[low] < best:
                    best, found = self.least[low], low
                low += 1
            if high & 1:
                high -= 1
                if self.least[high] < best:
                    best, found = self.least[high], high
            low, high = low >> 1, high >> 1
        if not found:
            return None
        while found < self.size:
            found = 2 * found if self.least[2 * found] == best else 2 * found + 1
        return self._pop(found - self.size)

    def roomiest(self) -> tuple[int, float, int]:
        at = 1
        while at < self.size:
            at = 2 * at + 1 if self.least[2 * at + 1] < float("inf") else 2 * at
        return self._pop(at - self.size)

    def _pop(self, room: int) -> tuple[int, float, int]:
        cost, which = heapq.heappop(self.heaps[room])
        self._update(room)
        return room, cost, which


def rooms_for(tokens: int, seq_len: int) -> list[int]:
    """Lengths of the sequences for so many tokens: full ones, and what is left in powers of two, which need no padding."""
    left = tokens % seq_len
    return [seq_len] * (tokens // seq_len) + [1 << k for k in reversed(range(left.bit_length())) if left >> k & 1]


def balance(lengths: list[int], seq_len: int, linear: float, quadratic: float) -> tuple[list[list[tuple[int, int, int]]], list[float]]:
    """Sequences of (document, start, length), all filled, and their costs.

    A piece costs linear * length + quadratic * length ** 2, as attention stays within a document. What is longer than
    a sequence fills whole ones first; then pieces go, longest first, to the cheapest sequence that has room for the
    whole piece. Where none has, the roomiest takes the piece's head and the rest waits its turn."""
    rooms = rooms_for(sum(lengths), seq_len)
    out: list[list[tuple[int, int, int]]] = [[] for _ in rooms]
    costs = [0.0] * len(rooms)
    cost_of = lambda n: linear * n + quadratic * n * n
    waiting, filled = [], 0
    for k, n in enumerate(lengths):
        whole = n // seq_len
        for j in range(whole):
            out[filled].append((k, j * seq_len, seq_len))
            costs[filled] = cost_of(seq_len)
            filled += 1
        if n % seq_len:
            waiting.append((-(n % seq_len), k, whole * seq_len))
    heapq.heapify(waiting)
    tree = Sequences(rooms[filled:])
    while waiting:
        n, k, start = heapq.heappop(waiting)
        need = -n
        room, cost, which = tree.take(need) or tree.roomiest()
        put = min(need, room)
        cost += cost_of(put)
        out[filled + which].append((k, start, put))
        costs[filled + which] = cost
        tree.put(room - put, cost, which)
        if put < need:
            heapq.heappush(waiting, (put - need, k, start + put))
    return out, costs


_IDS: dict[str, LibraryIds] = {}


def pack_balanced(docs: DataFrame, tokenizer_path: str, seq_len: int = 2048, end_id: int = 1, linear: float = 1.0, quadratic: float = 1 / 2048, buffer_tokens: int = 1 << 20) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset, sequence_cost: the pieces of docs (doc_id, text).

    A document is its ids (4 little-endian bytes each) and end_id; `start` counts its ids before the piece, `offset`
    the ids before it in its sequence. Sequences hold seq_len ids; each buffer's last few hold a power of two, so no
    sequence needs padding. Packing runs within each input partition over buffers of buffer_tokens (more only for a
    document that is longer itself), so nothing is shuffled, a lost task is simply run again, and memory does not
    grow with the input. A null or empty text is end_id alone; a null doc_id stays null; repeated rows are each
    packed; equal lengths go by place in the input; an empty table gives no rows; other columns are not looked at.
    The tokenizer file must be at the same path on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _IDS.get(tokenizer_path) or _IDS.setdefault(tokenizer_path, LibraryIds(tokenizer_path))
        end = np.array([end_id], dtype=encode.dtype).tobytes()
        step = encode.dtype.itemsize
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 33
        held: list[tuple[object, bytes]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal number
            rows: list[tuple] = []
            for members, cost in zip(*balance([len(ids) // step for _, ids in held], seq_len, linear, quadratic)):
                offset = 0
                for k, start, n in members:
                    doc_id, ids = held[k]
                    rows.append((doc_id, start, n, ids[start * step : (start + n) * step], len(ids) // step, number, offset, cost))
                    offset += n
                number += 1
            held.clear()
            kinds = (batch.schema.field(0).type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], ["doc_id", *(x.split()[0] for x in SCHEMA.split(", "))])

        for batch in pieces(batches):
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1))):
                held.append((doc_id, ids + end))
                size += len(held[-1][1]) // step
                if size >= buffer_tokens:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


def pieces_of(packed: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_cost")
