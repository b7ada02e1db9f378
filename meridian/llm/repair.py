"""Conversation structure repair: a grammar over role and fault sequences, a min-plus transfer matrix per rule."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from meridian.llm.common import materialise

FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: A row is a character: four for each role initial, one for each fault. The first is of system rows without a fault.
INITIALS = "sua?"
FIRST = ord("A")
#: Where a conversation stands: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
REROLE = INSERT = BROKEN = 3
DELETE = 4
#: The state after a user or assistant turn that follows each state.
NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: A rope is a string or a pair of ropes; an entry is a cost and the rope of its edits; a matrix has entries by (from, to).
Rope = str | tuple
Matrix = dict[tuple[int, int], tuple[int, Rope]]


def leaves(rope: Rope) -> Iterator[str]:
    """The strings of a rope in order, without recursion."""
    todo = [rope]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            yield x
        else:
            todo += (x[1], x[0])


def text(rope: Rope) -> str:
    return "".join(leaves(rope))


def before(a: Rope, b: Rope) -> bool:
    """Whether a's text sorts before b's; parts that both share in the same place are passed over unread."""
    x, y = [a], [b]
    while x and y:
        if x[-1] is y[-1]:
            x.pop()
            y.pop()
            continue
        for stack in (x, y):
            while stack and not isinstance(stack[-1], str):
                left, right = stack.pop()
                stack += (right, left)
                if x and y and x[-1] is y[-1]:
                    break
        if x[-1] is y[-1] or not (isinstance(x[-1], str) and isinstance(y[-1], str)):
            continue
        p, q = x.pop(), y.pop()
        n = min(len(p), len(q))
        if p[:n] != q[:n]:
            return p < q
        if p[n:]:
            x.append(p[n:])
        if q[n:]:
            y.append(q[n:])
    return not x and any(any(leaves(r)) for r in y)


def better(new: tuple[int, Rope], old: tuple[int, Rope] | None) -> bool:
    return old is None or new[0] < old[0] or new[0] == old[0] and before(new[1], old[1])


def product(a: Matrix, b: Matrix) -> Matrix:
    """a then b: the cheapest edits between any two states, ties to the least text.

    Among edits of the same rows at the same cost none is a prefix of another (what it lacked would be inserts, which
    cost), so the least parts make the least whole."""
    out: Matrix = {}
    for (i, k), (c, r) in a.items():
        for j in STATES:
            if (y := b.get((k, j))) and better(new := (c + y[0], (r, y[1]) if r and y[1] else r or y[1]), out.get((i, j))):
                out[i, j] = new
    return out


def _inserts() -> Matrix:
    """Any number of inserted turns; from a state to itself none is cheapest."""
    out: Matrix = {(s, s): (0, "") for s in STATES}
    for s in STATES:
        at, n = NEXT[s], 1
        while (s, at) not in out:
            out[s, at] = (INSERT * n, "I" * n)
            at, n = NEXT[at], n + 1
    return out


INSERTS = _inserts()


def terminal(symbol: int) -> Matrix:
    """Inserted turns, if any, and the edit of one row."""
    initial, fault = INITIALS[symbol // 4], symbol % 4
    out: Matrix = {(s, s): (DELETE, "D") for s in STATES}
    if fault in (FINE, TRUNCATED):
        extra = BROKEN if fault == TRUNCATED else 0
        for s, to in NEXT.items():
            out[s, to] = (extra, "K") if initial == NAMES[to][0] else (REROLE + extra, "R")
        if initial == "s":
            out[START, SYSTEM] = (extra, "K")
    return product(INSERTS, out)


Rule = tuple[int, int]
TERMINALS = 4 * len(INITIALS)


def replaced(tokens: list[int], rules: dict[Rule, int]) -> list[int]:
    """Each pair that has a rule becomes the rule's symbol, from the left."""
    out, at, last = [], 0, len(tokens) - 1
    while at <= last:
        if at < last and (new := rules.get((tokens[at], tokens[at + 1]))) is not None:
            out.append(new)
            at += 2
        else:
            out.append(tokens[at])
            at += 1
    return out


def compressed(symbols: str, rounds: list[dict[Rule, int]]) -> list[int]:
    tokens = [ord(c) - FIRST for c in symbols]
    for rules in rounds:
        tokens = replaced(tokens, rules)
    return tokens


def grammar(sequences: DataFrame, max_rounds: int = 8, per_round: int = 64) -> list[dict[Rule, int]]:
    """Re-Pair rules over sequences (symbols), in rounds: the pairs seen most often in all sequences, as far as none
    begins with a symbol that another ends with, become symbols. At most max_rounds * per_round rules come to the
    driver; fewer rules would only leave longer sequences to multiply out."""
    rounds: list[dict[Rule, int]] = []
    new = TERMINALS
    for _ in range(max_rounds):

        def pairs(batches: Iterator[pa.RecordBatch], rounds=tuple(rounds)) -> Iterator[pa.RecordBatch]:
            seen: Counter[Rule] = Counter()
            for batch in batches:
                for symbols in batch.column(0).to_pylist():
                    tokens, previous = compressed(symbols, rounds), None
                    for pair in zip(tokens, tokens[1:]):
                        if pair == previous and pair[0] == pair[1]:
                            previous = None  # the middle of three like symbols counts once
                            continue
                        seen[pair] += 1
                        previous = pair
            columns = [[a for a, _ in seen], [b for _, b in seen], list(seen.values())]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "n"])

        counts = sequences.select("symbols").mapInArrow(pairs, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
        top = counts.where("n > 1").orderBy(F.desc("n"), "a", "b").limit(4 * per_round).collect()
        rules: dict[Rule, int] = {}
        begins: set[int] = set()
        ends: set[int] = set()
        for a, b, _ in top:
            if len(rules) < per_round and a not in ends and b not in begins and (a != b or a not in begins and b not in ends):
                rules[a, b] = new
                new += 1
                begins.add(a)
                ends.add(b)
        if not rules:
            break
        rounds.append(rules)
    return rounds


class Matrices:
    """Transfer matrices by symbol: of rows, then of each rule from its two parts, bottom-up."""

    def __init__(self, rounds: list[dict[Rule, int]]):
        self.rounds = rounds
        self.of = {s: terminal(s) for s in range(TERMINALS)}
        for rules in rounds:
            for (a, b), new in rules.items():
                self.of[new] = product(self.of[a], self.of[b])

    def __call__(self, symbols: str) -> Matrix:
        tokens = compressed(symbols, self.rounds)
        parts = [self.of[t] for t in tokens]
        while len(parts) > 1:
            parts = [product(*parts[k : k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
        return parts[0]


def finish(entries: dict[int, tuple[int, Rope]]) -> tuple[int, str]:
    """The cheapest end of edits that lead from START to states: trailing inserts, then START or ASSISTANT."""
    ends = product({(START, s): x for s, x in entries.items()}, INSERTS)
    return min((c, text(r)) for (_, s), (c, r) in ends.items() if s in (START, ASSISTANT))


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies of turns as by the test's rule: by crc32 of conv_id:turn modulo 20 a row
    is dropped (0), emptied (1), loses its end marks (2), stands twice (3) or becomes a user's (4). Nulls read as one
    space."""
    known = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    said = F.when(k == 1, "").when(k == 2, F.regexp_replace(known("text"), "[.!?]", "")).otherwise(known("text"))
    role = F.when(k == 4, "user").otherwise(known("role"))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), said.alias("text"), F.when(k == 3, 2).otherwise(1).alias("copies"), k.alias("k"))
    return rows.where("k <> 0").drop("k")


def _fault(said: Column) -> Column:
    """BLANK, TRUNCATED or FINE by the text alone."""
    last = F.substring(F.rtrim(said, F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    return F.when(last == "", BLANK).when(last.isin(".", "!", "?"), FINE).otherwise(TRUNCATED)


def segments(turns: DataFrame, longest: int = 4096) -> DataFrame:
    """conv_id, block, symbols: each conversation's rows in order as a string, cut after `longest` rows and between
    tasks; blocks are in order. Rows that are alike in everything meet in a count first, the earliest row of each
    role and text comes from an aggregate, and the order from a range partitioning, so a conversation of any length
    is spread over tasks."""
    key = F.unhex(F.md5(F.col("text").cast("binary")))
    start = F.instr(F.lit("sua"), F.substring("role", 1, 1))
    initial = F.when((F.col("role") == "") | (start == 0), 3).otherwise(start - 1)
    narrow = turns.select("conv_id", "turn", "role", key.alias("h"), initial.alias("initial"), _fault(F.col("text")).alias("fault"), "copies")
    rows = narrow.groupBy("conv_id", "turn", "role", "h", "initial", "fault").agg(F.sum("copies").alias("n"))
    earliest = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("earliest")
    seen = rows.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("h").alias("x")).agg(earliest, F.count("*").alias("places")).where("places > 1")
    rows = rows.join(seen, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("h") == F.col("x")), "left")
    late = F.col("earliest").isNotNull() & ~F.col("turn").eqNullSafe(F.col("earliest.turn"))
    fault = F.when(F.col("fault") == BLANK, BLANK).when(late, DUPLICATE).otherwise(F.col("fault"))
    rows = rows.select("conv_id", "turn", "role", "h", "initial", fault.alias("fault"), "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        block = (context.partitionId() if context else 0) << 32
        conv: object = run  # none yet
        held: list[str] = []
        out: list[tuple] = []

        def cut() -> None:
            nonlocal block
            if held:
                out.append((conv, block, "".join(held)))
                block += 1
                held.clear()

        for batch in batches:
            for conv_id, initial, fault, n in zip(*(batch.column(k).to_pylist() for k in (0, 4, 5, 6))):
                if conv is run or conv_id != conv:
                    cut()
                    conv = conv_id
                first = chr(FIRST + 4 * initial + fault)
                again = chr(FIRST + 4 * initial + (BLANK if fault == BLANK else DUPLICATE))
                while n:
                    take = min(n, longest - len(held))
                    held += [first, *[again] * (take - 1)]
                    first, n = again, n - take
                    if len(held) >= longest:
                        cut()
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) if k else pa.array(x, conv_type) for k, x in enumerate(zip(*out))], ["conv_id", "block", "symbols"])
                out.clear()
        cut()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x) if k else pa.array(x, conv_type) for k, x in enumerate(zip(*out))], ["conv_id", "block", "symbols"])

    conv_type = to_arrow_type(turns.schema["conv_id"].dataType)
    order = ("conv_id", "turn", "role", "h")
    kind = turns.schema["conv_id"].dataType.simpleString()
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, f"conv_id {kind}, block long, symbols string")


_MATRICES: dict[str, Matrices] = {}
ENTRIES = "array<struct<origin:int,target:int,cost:long,audit:string>>"


def transfers(sequences: DataFrame, rounds: list[dict[Rule, int]]) -> DataFrame:
    """symbols and entries, the transfer matrix of each sequence, from matrices of rules that all sequences share."""
    key = repr(rounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _MATRICES:
            _MATRICES.clear()
            _MATRICES[key] = Matrices(rounds)
        entry = pa.struct([("origin", pa.int32()), ("target", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
        for batch in batches:
            symbols = batch.column(0).to_pylist()
            for at in range(0, len(symbols), 256):
                part = symbols[at : at + 256]
                rows = [[{"origin": i, "target": j, "cost": c, "audit": text(r)} for (i, j), (c, r) in _MATRICES[key](s).items()] for s in part]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array(rows, pa.list_(entry))], ["symbols", "entries"])

    return sequences.select("symbols").mapInArrow(run, f"symbols string, entries {ENTRIES}")


class _Conversation:
    """One conversation as its segments and then its rows pass by."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.counts, self.illegal, self.last = Counter(), 0, ""
        self.entries: dict[int, tuple[int, Rope]] = {START: (0, "")}
        self.turns: list[int | None] = [None, None, 0]  # least, most and number of distinct turns
        self.cost: int | None = None
        self.hash, self.at, self.state, self.any = hashlib.sha256(), 0, START, False

    def segment(self, symbols: str, entries: list[dict]) -> None:
        codes = [ord(c) - FIRST for c in symbols]
        for fault, n in Counter(c % 4 for c in codes).items():
            self.counts[fault] += n
        roles = self.last + "".join(INITIALS[c // 4] for c in codes)
        self.illegal += len(roles) - 1 - sum(a + b in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        self.last = roles[-1]
        matrix = {(e["origin"], e["target"]): (e["cost"], e["audit"]) for e in entries}
        ends = product({(START, s): x for s, x in self.entries.items()}, matrix)
        self.entries = {s: x for (_, s), x in ends.items()}

    def _close(self) -> None:
        if self.cost is None:
            self.cost, self.audit = finish(self.entries) if self.last else (0, "")

    def _put(self, role: str, said: str) -> None:
        self.hash.update(f"{chr(10) if self.any else ''}{role}:{said}".encode("utf-8", "surrogatepass"))
        self.any = True

    def _insert(self) -> None:
        while self.audit.startswith("I", self.at):
            self.at += 1
            self.state = NEXT[self.state]
            self._put(NAMES[self.state], "")

    def row(self, turn: int | None, role: str, said: str, copies: int) -> None:
        self._close()
        if turn is not None:
            least, most, n = self.turns
            self.turns = [turn if least is None else least, turn, n + (turn != most)]
        for _ in range(copies):
            self._insert()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "D":
                continue
            self.state = SYSTEM if edit == "K" and role[:1] == "s" else NEXT[self.state]
            self._put(role if edit == "K" else NAMES[self.state], said)

    def result(self) -> tuple:
        self._close()
        self._insert()
        least, most, n = self.turns
        gaps = 0 if least is None else most - least + 1 - n
        return (self.conv_id, gaps, self.counts[BLANK], self.counts[DUPLICATE], self.counts[TRUNCATED], self.illegal, self.cost, self.audit, self.hash.hexdigest())


RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repair(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation of turns
    (conv_id, turn, role, text and, if rows stand several times, copies), and of each conv_id of `conversations`.

    The cheapest edits (keep, rerole, delete, insert) that give roles of the form s?(ua)+ or nothing; audit has their
    initials in order, ties go to the text that sorts first. Each distinct sequence of roles and faults is solved
    once, by the matrices of grammar rules that all conversations share. Rows of equal turn go by role, then by the
    MD5 of their text; null roles and texts read as one space; a null turn comes first; rows without conv_id are one
    conversation; a conversation without rows has zeros, an empty audit and the hash of nothing; an empty table gives
    no rows; other columns are not looked at. The segments of a conversation are combined and its texts hashed in one
    ordered stream, as SHA-256 takes bytes in order; the stream holds its audit (a byte a row) and no texts.
    """
    known = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)
    copies = F.coalesce(F.col("copies").cast("int"), F.lit(1)) if "copies" in turns.columns else F.lit(1)
    turns = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), known("role"), known("text"), copies.alias("copies"))
    cut = materialise(segments(turns))
    sequences = materialise(cut.select("symbols").distinct())
    solved = transfers(sequences, grammar(sequences))
    kind = turns.schema["conv_id"].dataType.simpleString()
    none = lambda t, name: F.lit(None).cast(t).alias(name)
    named = (turns if conversations is None else conversations).select("conv_id").distinct()
    stream = (
        named.select("conv_id", F.lit(0).alias("kind"), none("long", "place"), none("string", "role"), none("binary", "h"), none("string", "text"), none("int", "copies"), none(ENTRIES, "entries"))
        .unionByName(cut.join(solved, "symbols").select("conv_id", F.lit(1).alias("kind"), F.col("block").alias("place"), none("string", "role"), none("binary", "h"), F.col("symbols").alias("text"), none("int", "copies"), "entries"))
        .unionByName(turns.select("conv_id", F.lit(2).alias("kind"), F.col("turn").alias("place"), "role", F.unhex(F.md5(F.col("text").cast("binary"))).alias("h"), "text", "copies", none(ENTRIES, "entries")))
    )
    conv_type = to_arrow_type(turns.schema["conv_id"].dataType)
    names = ["conv_id", *(x.split()[0] for x in RESULT.split(", "))]
    kinds = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        for batch in batches:
            out = []
            for conv_id, kind, place, role, said, copies, entries in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 3, 5, 6, 7))):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        out.append(now.result())
                    now = _Conversation(conv_id)
                if kind == 1:
                    now.segment(said, entries)
                elif kind == 2:
                    now.row(place, role, said, copies)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*out), kinds)], names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], type=k) for c, k in zip(now.result(), kinds)], names)

    order = ("conv_id", "kind", "place", "role", "h")
    return stream.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, f"conv_id {kind}, {RESULT}")
