"""Chat formatting: conversations as budgeted, turn-aligned windows with a loss mask."""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meridian.llm.common import pieces
from meridian.llm.token_counts import PieceCounter

#: A turn is <s>[INST] text [/INST]</s> for users, with other marks for other roles. Marks stand after a blank or
#: a mark; inside texts a backslash comes before each.
MARKS = {"user": "INST", "assistant": "OUT", "system": "SYS"}
_CONTROL = r"</?s>|\[/?(?:INST|OUT|SYS|TURN)\]"
_ESCAPE = re.compile(rf"(\\*)({_CONTROL})")
_UNESCAPE = re.compile(rf"\\(\\*)({_CONTROL})")
_TURN = re.compile(r"<s>(?:\[(INST|OUT|SYS)\]|\[TURN\] (.*?) \[/TURN\]\[TURN\]) (.*?) \[/(?:INST|OUT|SYS|TURN)\]</s>", re.S)
WINDOWS = "conv_id long, window long, text string, n_tokens long, n_repeated int, loss_starts array<int>, loss_ends array<int>, over_budget boolean"


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: f"{m[1]}\\{m[2]}", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: f"{m[1]}{m[2]}", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn, and where its escaped text begins and ends in it."""
    body = escape(text)
    if role in MARKS:
        head, tail = f"<s>[{MARKS[role]}] ", f" [/{MARKS[role]}]</s>"
    else:
        head, tail = f"<s>[TURN] {escape(role)} [/TURN][TURN] ", " [/TURN]</s>"
    return head + body + tail, len(head), len(head) + len(body)


def parse(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a window, read back."""
    names = {v: k for k, v in MARKS.items()}
    return [(names[m[1]] if m[1] else unescape(m[2]), unescape(m[3])) for m in _TURN.finditer(text)]


def chat_windows(conversations: DataFrame, tokenizer_path: str, budget: int = 1024, history: int = 256) -> DataFrame:
    """Windows (conv_id, window, text, n_tokens, n_repeated, loss spans, over_budget) of conversations (conv_id,
    turn, role, text).

    Turns keep their order; prefix sums of their tokens choose spans of whole turns. Each window after the first
    begins with the system turn (a conversation's first turn of that role) and with as many of the last turns as
    `history` tokens hold, n_repeated turns in all; then new turns follow while the window stays within `budget`
    tokens. The loss spans are the code points of new assistant texts; what is repeated is masked. A turn that
    passes the budget by itself, after dropping history, has a window to itself and the system turn, marked
    over_budget: nothing is cut. Null roles and texts are empty; a null turn number comes first; equal turn numbers
    go by role and text; rows without conv_id are one conversation; an empty table gives no rows. Tasks read
    conversations in order as a stream and hold no more than a window's turns.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(tokenizer_path)
        for batch in pieces(batches):
            texts = [render(r, t)[0] for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            tokens = pa.array(counter.of_texts(pa.array(texts, pa.string())), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, tokens], ["conv_id", "turn", "role", "text", "tokens"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in WINDOWS.split(", ")]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.bool_())
        rows: list[tuple] = []
        conv: object = rows  # no conversation yet
        number, chars = 0, 0
        system: tuple | None = None
        past: list[tuple] = []  # turns that the next window may repeat
        repeated: list[tuple] = []
        fresh: list[tuple] = []

        def finish() -> None:
            """Write the window of repeated and fresh turns."""
            nonlocal number, chars
            at, starts, ends = 0, [], []
            for k, turn in enumerate([*repeated, *fresh]):
                if k >= len(repeated) and turn[0] == "assistant":
                    starts.append(at + turn[2])
                    ends.append(at + turn[3])
                at += len(turn[1])
            tokens = sum(x[4] for x in (*repeated, *fresh))
            rows.append((conv, number, "".join(x[1] for x in (*repeated, *fresh)), tokens, len(repeated), starts, ends, tokens > budget))
            number += 1
            chars += at

        def context(tokens: int) -> list[tuple]:
            """What a new window repeats before a turn of so many tokens: the system turn and limited history."""
            room = min(history, budget - tokens - (system[4] if system else 0))
            total = past[-1][5] if past else 0
            first = bisect.bisect_left(past, total - max(room, 0), key=lambda x: x[5] - x[4])
            return [*([system] if system else []), *(x for x in past[first:] if x is not system)]

        def batch_of() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows), kinds)], names)
            rows.clear()
            return out

        for batch in batches:
            for conv_id, role, text, tokens, prefix in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4, 5))):
                if conv is rows or conv_id != conv:
                    if fresh:
                        finish()
                    conv, number, system, past, repeated, fresh = conv_id, 0, None, [], [], []
                turn = (role, *render(role, text), tokens, prefix)
                used = sum(x[4] for x in repeated) + (fresh[-1][5] - fresh[0][5] + fresh[0][4] if fresh else 0)
                if fresh and used + tokens > budget:
                    finish()
                    repeated, fresh = context(tokens), []
                if system is None and not past and not fresh and role == "system":
                    system = turn
                fresh.append(turn)
                past.append(turn)
                while past and past[-1][5] - past[0][5] > history:
                    past.pop(0)
                if chars > 4 << 20:
                    yield batch_of()
                    chars = 0
        if fresh:
            finish()
        if rows:
            yield batch_of()

    empty = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), empty("role"), empty("text"))
    counted = turns.mapInArrow(count, "conv_id long, turn long, role string, text string, tokens long")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    return counted.withColumn("prefix", F.sum("tokens").over(order)).mapInArrow(cut, WINDOWS)


def read_back(windows: DataFrame) -> DataFrame:
    """Digests per conversation, from nothing but the windows: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, n_windows. Turns that a window repeats count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]
        state: list | None = None

        def row() -> tuple:
            return (state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5], state[6])

        for batch in batches:
            out = []
            for conv_id, text, repeated, starts, ends in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if state is None or conv_id != state[0]:
                    if state is not None:
                        out.append(row())
                    state = [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for role, said in parse(text)[repeated:]:
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for a, b in zip(starts, ends):
                    said = unescape(text[a:b])
                    state[3] += len(said)
                    state[4].update(said.encode("utf-8", "surrogatepass"))
                state[5] += len(text)
                state[6] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*out) if out else [[]] * len(kinds), kinds)], names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], type=k) for c, k in zip(row(), kinds)], names)

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"
    ordered = windows.select("conv_id", "text", "n_repeated", "loss_starts", "loss_ends", "window")
    return ordered.repartition("conv_id").sortWithinPartitions("conv_id", "window").mapInArrow(run, schema)
