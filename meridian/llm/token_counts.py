"""Token counts: a table of distinct pre-tokens with their pieces, joined to each document's pre-token frequencies."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import materialise, pieces, text_of

#: ASCII marks that no letter or digit pattern takes; a run of them after a plain word is a pre-token of its own.
MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


class PieceCounter:
    """Pieces of blank-separated words under one tokenizer file, each distinct pre-token counted once.

    Pre-tokens never span blanks, so a text's count is the sum over its words. A word made of Latin letters with
    marks after it is its letters, lower-cased, and the marks; any other word is given to the library as it stands.
    """

    def __init__(self, tokenizer_path: str, max_entries: int = 400_000):
        self.path, self.max_entries = tokenizer_path, max_entries
        if tokenizer_path.endswith(".json"):
            import os

            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(tokenizer_path)
            tok.no_truncation()
            tok.no_padding()
            self.count = lambda xs: [len(e) for e in tok.encode_batch_fast(xs, add_special_tokens=False)]
            self.split_words = self.lower_case = self._drops_blanks(tok)
        else:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path)
            self.count = lambda xs: [len(x) for x in model.encode(xs, num_threads=1)]
            self.split_words = self.lower_case = False
        self.words: dict[str, int] = {}
        self.parts: dict[str, int] = {}

    @staticmethod
    def _drops_blanks(tok) -> bool:
        """True if the tokenizer drops blanks and lower-cases, which is what makes words independent."""
        one = lambda s: tok.encode(s, add_special_tokens=False).tokens
        return one("Qx  zv,\n") == one("qx zv,") == [*one("qx"), *one("zv"), *one(",")] and one(" ") == []

    @staticmethod
    def _pre_tokens(word: str) -> list[str]:
        letters = word.rstrip(MARKS)
        low = letters.lower()
        if low.isalpha() and max(low) < "ɐ" and letters.isalpha():
            return [low, word[len(letters):]] if len(letters) < len(word) else [low]
        return [word]

    def of_words(self, distinct: list[str]) -> list[int]:
        """Pieces of each of some distinct words."""
        new = [w for w in distinct if w not in self.words]
        if new:
            if len(self.words) + len(new) > self.max_entries:
                self.words.clear()
                self.parts.clear()
                new = distinct
            cut = {w: self._pre_tokens(w) for w in new}
            unknown = list({p for ps in cut.values() for p in ps if p not in self.parts})
            self.parts.update(zip(unknown, self.count(unknown)))
            self.words.update((w, sum(self.parts[p] for p in ps)) for w, ps in cut.items())
        return [self.words[w] for w in distinct]

    def of_texts(self, texts: pa.Array) -> np.ndarray:
        """Pieces of each text: words as dictionary codes, joined to the counts, summed by text."""
        if not self.split_words:
            return np.array(self.count(texts.to_pylist()), dtype=np.int64)
        lists = pa.compute.split_pattern_regex(texts, r"[\x20\x09-\x0D]+")
        lengths = np.diff(lists.offsets.to_numpy(zero_copy_only=False))
        codes = lists.values.slice(lists.offsets[0].as_py(), int(lengths.sum())).dictionary_encode()
        distinct = codes.dictionary.to_pylist()
        counts = np.array([n if w else 0 for w, n in zip(distinct, self.of_words(distinct))], dtype=np.int64)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        return np.bincount(owner, weights=counts[codes.indices.to_numpy(zero_copy_only=False)], minlength=len(lengths)).astype(np.int64)


_COUNTERS: dict[str, PieceCounter] = {}


def _counter(path: str) -> PieceCounter:
    return _COUNTERS.get(path) or _COUNTERS.setdefault(path, PieceCounter(path))


def _frequencies(counter: PieceCounter, texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Text number, pre-token and frequency of every distinct pre-token of each text, by text.

    A tokenizer whose pre-tokens cross blanks has whole texts for pre-tokens.
    """
    if counter.split_words:
        lists = pa.compute.split_pattern_regex(texts, r"[\x20\x09-\x0D]+")
        lengths = np.diff(lists.offsets.to_numpy(zero_copy_only=False))
        words = lists.values.slice(lists.offsets[0].as_py(), int(lengths.sum())).dictionary_encode()
        parts = [counter._pre_tokens(w) if w else [] for w in words.dictionary.to_pylist()]
        word, owner = words.indices.to_numpy(zero_copy_only=False), np.repeat(np.arange(len(texts)), lengths)
    else:
        parts = [[t] if t else [] for t in texts.to_pylist()]
        word = owner = np.arange(len(texts))
    known = pa.array([p for ps in parts for p in ps], pa.string()).dictionary_encode()
    number = np.array([len(ps) for ps in parts], np.int64)
    start, code = np.cumsum(number) - number, known.indices.to_numpy(zero_copy_only=False)
    n = number[word] if len(word) else np.zeros(0, np.int64)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    code = code[np.repeat(start[word] if len(word) else n, n) + step].astype(np.int64)
    size = max(len(known.dictionary), 1)
    pairs, count = np.unique(np.repeat(owner, n) * size + code, return_counts=True)
    return pairs // size, known.dictionary.take(pa.array(pairs % size)), count


def pre_token_frequencies(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """row (a number), doc_id, n_bytes, pre_tokens and counts (two lists) for every row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 33
        for batch in pieces(batches, max_bytes=1 << 20):
            owner, tokens, counts = _frequencies(_counter(tokenizer_path), batch.column(2))
            offsets = pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)), pa.int32())
            rows = pa.array(np.arange(row, row + batch.num_rows))
            row += batch.num_rows
            lists = (pa.ListArray.from_arrays(offsets, tokens), pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())))
            yield pa.RecordBatch.from_arrays([rows, batch.column(0), batch.column(1), *lists], ["row", "doc_id", "n_bytes", "pre_tokens", "counts"])

    text = text_of()
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(run, f"row long, doc_id {kind}, n_bytes long, pre_tokens array<string>, counts array<long>")


def count_pieces(pre_tokens: DataFrame, tokenizer_path: str) -> DataFrame:
    """pre_tokens (pre_token and other columns) with `pieces`; each row is given to the library once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "pre_token"):
            counts = pa.array(_counter(tokenizer_path).count(batch.column("pre_token").to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, counts], [*batch.schema.names, "pieces"])

    fields = ", ".join(f"{n} {t}" for n, t in pre_tokens.dtypes)
    return pre_tokens.mapInArrow(run, f"{fields}, pieces long")


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048, most_frequent: int = 200_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row of docs (doc_id, text).

    Each document becomes its distinct pre-tokens with their frequencies; the distinct pre-tokens of all documents
    make a table, in which each has its pieces counted once. The frequencies are joined to that table and summed by
    row: the most_frequent pre-tokens of 64 bytes at most, which may be in any number of documents, go to every task
    (at most most_frequent * 80 bytes or so), and what is left meets the rest of the table in a shuffle. No ids are
    made or kept. A null text counts as empty (0 bytes, 0 tokens); a null doc_id stays null; repeated rows each give
    a row; an empty table gives none. The whole text counts; begin and end tokens are not added; strings of special
    tokens inside a text are taken as the library takes them by default. The tokenizer file must be at the same path
    on every executor.
    """
    rows = materialise(pre_token_frequencies(docs, tokenizer_path))
    seen = rows.select(F.explode(F.arrays_zip("pre_tokens", "counts")).alias("x")).groupBy(F.col("x.pre_tokens").alias("pre_token")).agg(F.sum("x.counts").alias("seen"))
    table = materialise(count_pieces(seen, tokenizer_path))
    frequent = table.where(F.octet_length("pre_token") <= 64).orderBy(F.desc("seen"), "pre_token").limit(most_frequent).select("pre_token", "pieces")
    frequent = materialise(frequent)
    each = rows.select("row", F.explode(F.arrays_zip("pre_tokens", "counts")).alias("x")).select("row", F.col("x.pre_tokens").alias("pre_token"), F.col("x.counts").alias("n"))
    met = each.join(F.broadcast(frequent), "pre_token", "left")
    rare = met.where("pieces is null").select("row", "pre_token", "n").join(table.select("pre_token", "pieces"), "pre_token")
    total = lambda df: df.groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("n_tokens"))
    sums = total(met.where("pieces is not null"))
    if table.count() > frequent.count():  # or else nothing is rare, and the join would read all rows for nothing
        sums = sums.union(total(rare))
    sums = sums.union(rows.select("row", F.lit(0).cast("long"))).groupBy("row").agg(F.sum("n_tokens").alias("n_tokens"))
    out = rows.select("row", "doc_id", "n_bytes").join(sums, "row")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
