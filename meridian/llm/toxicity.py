"""Toxicity: a bidirectional gated recurrent network with attention pooling over words and their characters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.llm.common import pieces, text_of

WIDTH, STRIDE = 32, 16  # words in a window, and from one window's start to the next: a run of 17 words lies whole in one
UNITS, WORD_DIM, CHAR_DIM, BUCKETS = 8, 8, 8, 1 << 14
STEMS = (6, 8)  # bytes at a longer word's start that stand for its stem
LEAST = -6.0  # a lower logit proves no more
TRIM = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of all texts together: the number of words of each, their codes in order, the distinct words."""
    lists = pc.split_pattern_regex(texts, r"[\x20\x09-\x0D]+")
    lengths = np.diff(lists.offsets.to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = lists.values.slice(lists.offsets[0].as_py(), int(lengths.sum())).dictionary_encode()
    codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    plain = pc.utf8_trim(pc.utf8_lower(flat.dictionary), characters=TRIM)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    full = ~pc.equal(plain, "").to_numpy(zero_copy_only=False)[codes] if len(codes) else np.zeros(0, bool)
    counts = np.bincount(owner[full], minlength=len(lengths))
    return counts, codes[full], plain


def _windows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All overlapping windows over texts of so many words: text, first word and number of words of each."""
    number = np.maximum(1, 1 + -(-(counts - WIDTH) // STRIDE))
    owner = np.repeat(np.arange(len(counts)), number)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
    first = np.repeat(np.cumsum(counts) - counts, number) + place * STRIDE
    return owner, first, np.clip(counts[owner] - place * STRIDE, 0, WIDTH)


def _grams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all character triples of ^word$, and the word of each."""
    marked = pc.binary_join_element_wise("^", words, "$", "").cast(pa.large_string())
    offsets = np.frombuffer(marked.buffers()[1], dtype=np.int64)[marked.offset : marked.offset + len(marked) + 1]
    data = np.frombuffer(marked.buffers()[2], dtype=np.uint8).astype(np.int64) if len(words) else np.zeros(0, np.int64)
    number = np.maximum(np.diff(offsets) - 2, 0)
    word = np.repeat(np.arange(len(number)), number)
    at = offsets[:-1][word] + np.arange(len(word)) - np.repeat(np.cumsum(number) - number, number)
    return (data[at] * 961 + data[at + 1] * 31 + data[at + 2]) % BUCKETS, word


def _stems(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the starts of longer words, and the word of each, by word."""
    large = words.cast(pa.large_string())
    offsets = np.frombuffer(large.buffers()[1], dtype=np.int64)[large.offset : large.offset + len(large) + 1]
    data = np.frombuffer(large.buffers()[2], dtype=np.uint8).astype(np.int64) if len(words) else np.zeros(0, np.int64)
    found, owner = [], []
    for n in STEMS:
        longer = np.flatnonzero(np.diff(offsets) > n)
        code = np.full(len(longer), n, np.int64)
        for k in range(n):
            code = (code * 1_000_003 + data[offsets[longer] + k]) % 2_147_483_647
        found.append(code % BUCKETS)
        owner.append(longer)
    order = np.argsort(np.concatenate(owner), kind="stable")
    return np.concatenate(found)[order], np.concatenate(owner)[order]


#: The tables of character inputs, each a mean over what a word has of it.
CHARS = {"grams": _grams, "stems": _stems}


class Network:
    """Weights and passes. Row 0 of the word table stands for words outside the vocabulary."""

    def __init__(self, vocabulary: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *s, scale=0.2: (rng.standard_normal(s) * scale).astype(np.float32)
        self.vocabulary = vocabulary
        self.pooling = np.array([1.0, 0.0, 0.0, 0.0, 0.0])  # of evidence() and 1: the highest window alone
        d = WORD_DIM + CHAR_DIM * len(CHARS)
        self.w = {"words": draw(len(vocabulary) + 1, WORD_DIM, scale=0.02)} | {name: draw(BUCKETS, CHAR_DIM, scale=0.02) for name in CHARS}
        for side in "fb":
            self.w |= {f"x{side}": draw(d, 3 * UNITS), f"h{side}": draw(UNITS, 3 * UNITS), f"c{side}": np.zeros(3 * UNITS, np.float32)}
        self.w |= {"pool": draw(2 * UNITS), "out": draw(2 * UNITS), "bias": np.full(1, -1, np.float32)}

    def ids(self, words: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.index_in(words, value_set=pa.array(self.vocabulary, pa.string())), -1).to_numpy(zero_copy_only=False) + 1

    def inputs(self, words: pa.Array, ids: np.ndarray) -> np.ndarray:
        """Embeddings of distinct words, of their character triples and of their stems."""
        parts = [self.w["words"][ids]]
        for name, cut in CHARS.items():
            bucket, word = cut(words)
            chars = np.zeros((len(words), CHAR_DIM), np.float32)
            number = np.bincount(word, minlength=len(words))
            if len(bucket):
                first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                chars[word[first]] = np.add.reduceat(self.w[name][bucket], first, axis=0)
            parts.append(chars / np.maximum(number, 1)[:, None].astype(np.float32))
        return np.hstack(parts)

    def forward(self, x: dict[str, np.ndarray], codes: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows. x: projected inputs of the distinct words by direction; codes, mask: (windows, WIDTH)."""
        n, u = len(codes), UNITS
        states = np.zeros((n, WIDTH, 2 * u), np.float32)
        trace: dict = {"f": [], "b": []}
        for k, side in enumerate("fb"):
            h, recur = np.zeros((n, u), np.float32), self.w[f"h{side}"]
            for t in range(WIDTH) if side == "f" else range(WIDTH - 1, -1, -1):
                xt, m = x[side][codes[:, t]], mask[:, t, None]
                a = h @ recur
                gates = 0.5 + 0.5 * np.tanh(0.5 * (xt[:, : 2 * u] + a[:, : 2 * u]))
                z, r = gates[:, :u], gates[:, u:]
                new = np.tanh(xt[:, 2 * u :] + r * a[:, 2 * u :])
                if keep:
                    trace[side].append((t, h, z, r, new, a[:, 2 * u :], m))
                h = h + m * (1 - z) * (new - h)
                states[:, t, k * u : (k + 1) * u] = h
        weight = np.where(mask > 0, np.exp(np.clip(states @ self.w["pool"], -30, 30)), 0)
        weight /= np.maximum(weight.sum(1, keepdims=True), 1e-9)
        pooled = np.einsum("nt,ntu->nu", weight, states)
        logits = pooled @ self.w["out"] + self.w["bias"]
        return (logits, states, weight, pooled, trace) if keep else logits

    def project(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        return {side: inputs @ self.w[f"x{side}"] + self.w[f"c{side}"] for side in "fb"}

    def gradients(self, words: pa.Array, ids: np.ndarray, codes: np.ndarray, mask: np.ndarray, labels: np.ndarray, cost: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted log loss over some windows, by passing back through time."""
        u, g = UNITS, {k: np.zeros_like(v) for k, v in self.w.items()}
        inputs = self.inputs(words, ids)
        logits, states, weight, pooled, trace = self.forward(self.project(inputs), codes, mask, keep=True)
        d = ((1 / (1 + np.exp(-logits)) - labels) * cost / len(labels)).astype(np.float32)
        g["out"], g["bias"] = pooled.T @ d, d.sum(keepdims=True)
        d_pooled = d[:, None] * self.w["out"]
        d_score = weight * (np.einsum("nu,ntu->nt", d_pooled, states) - np.sum(d_pooled * pooled, axis=1)[:, None])
        g["pool"] = np.einsum("nt,ntu->u", d_score, states)
        d_states = weight[:, :, None] * d_pooled[:, None] + d_score[:, :, None] * self.w["pool"]
        d_inputs = np.zeros_like(inputs)
        for k, side in enumerate("fb"):
            recur, back = self.w[f"h{side}"], np.zeros((len(codes), u), np.float32)
            for t, h, z, r, new, a, m in reversed(trace[side]):
                dh = d_states[:, t, k * u : (k + 1) * u] + back
                d_new = dh * m * (1 - z) * (1 - new * new)
                d_z = dh * m * (h - new) * z * (1 - z)
                d_r = d_new * a * r * (1 - r)
                d_a = np.hstack([d_z, d_r, d_new * r])
                d_x = np.hstack([d_z, d_r, d_new])
                back = dh * (1 - m * (1 - z)) + d_a @ recur.T
                g[f"h{side}"] += h.T @ d_a
                g[f"c{side}"] += d_x.sum(0)
                g[f"x{side}"] += inputs[codes[:, t]].T @ d_x
                np.add.at(d_inputs, codes[:, t], d_x @ self.w[f"x{side}"].T)
        np.add.at(g["words"], ids, d_inputs[:, :WORD_DIM])
        for k, (name, cut) in enumerate(CHARS.items()):
            bucket, word = cut(words)
            number = np.maximum(np.bincount(word, minlength=len(words)), 1)[:, None]
            own = d_inputs[:, WORD_DIM + k * CHAR_DIM : WORD_DIM + (k + 1) * CHAR_DIM]
            np.add.at(g[name], bucket, (own / number)[word])
        return g

    def evidence(self, texts: pa.Array) -> np.ndarray:
        """For each whole text the highest logit over all its overlapping windows, then the three highest over its
        windows that don't overlap (LEAST where there are fewer): words that one window misses count in another."""
        counts, codes, words = _words(texts)
        owner, first, size = _windows(counts)
        x = self.project(self.inputs(words, self.ids(words))) if len(words) else {s: np.zeros((1, 3 * UNITS), np.float32) for s in "fb"}
        codes = np.r_[codes, np.zeros(WIDTH, np.int64)]
        logits, steps = np.zeros(len(owner), np.float32), np.arange(WIDTH)
        for at in range(0, len(owner), 4096):
            cut = slice(at, at + 4096)
            logits[cut] = self.forward(x, codes[first[cut, None] + steps], (steps < size[cut, None]).astype(np.float32))
        found = np.full((len(counts), 4), LEAST)
        np.maximum.at(found[:, 0], owner, logits)
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        apart = np.flatnonzero(place % -(-WIDTH // STRIDE) == 0)
        order = apart[np.lexsort((-logits[apart], owner[apart]))]
        rank = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
        top = order[rank < 3]
        found[owner[top], 1 + rank[rank < 3]] = np.maximum(logits[top], LEAST)
        return found

    def scores(self, texts: pa.Array) -> np.ndarray:
        """The probability of label 1 of each whole text, from the evidence of its windows."""
        logits = self.evidence(texts) @ self.pooling[:-1] + self.pooling[-1]
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))

    def fit_pooling(self, texts: pa.Array, labels: np.ndarray, prior: float | None = None, pull: float = 1.0) -> None:
        """What the windows of a text prove together: a logistic regression on texts the network has not seen, labels
        weighted to the share `prior` of label 1, with a pull towards the highest window alone."""
        x = np.hstack([self.evidence(texts), np.ones((len(labels), 1))])
        seen = np.bincount(labels, minlength=2)
        if seen.min() == 0:
            return
        share = np.array([1 - prior, prior]) if prior else seen / seen.sum()
        weight = (share / (seen / seen.sum()))[labels]
        start = w = np.array([1.0, 0.0, 0.0, 0.0, 0.0])
        loss = lambda w: (weight * np.logaddexp(0, np.where(labels == 1, -1, 1) * (x @ w))).sum() + pull / 2 * ((w - start) ** 2).sum()
        for _ in range(50):  # Newton steps on a convex loss of five numbers, halved while they overshoot
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (weight * (p - labels)) + pull * (w - start)
            step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + pull * np.eye(5), slope)
            while loss(w - step) > loss(w) and np.abs(step).max() > 1e-9:
                step = step / 2
            w = w - step
            if np.abs(step).max() < 1e-8:
                break
        self.pooling = w


def _log_odds(seen: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Of label 1 against 0, given how many texts of each label show a feature; near 0 unless well supported."""
    share = (seen + 1) / (sizes + 2)
    odds = np.log(share[:, 1] / share[:, 0])
    z = odds**2 / (1 / (seen[:, 0] + 1) + 1 / (seen[:, 1] + 1))
    return np.clip(odds * z / (z + 25), -3, 3)


def train(rows: list[tuple[int, str, int]], prior: float | None = None, **params) -> Network:
    """Fit on (doc_id, text, label) rows: the network on four fifths of them, the pooling of its windows on the rest.
    prior is the share of label 1 that scores are to hold for, if not that of the rows."""
    rows = sorted(rows)
    held = [k % 5 == 4 for k in range(len(rows))]
    net = train_windows([r for r, h in zip(rows, held) if not h], **params)
    rest = [r for r, h in zip(rows, held) if h]
    if rest:
        net.fit_pooling(pa.array([r[1] for r in rest], pa.string()), np.array([r[2] for r in rest]), prior)
    return net


def train_windows(rows: list[tuple[int, str, int]], max_vocabulary: int = 8192, rounds: int = 5, decay: float = 0.02, seed: int = 7) -> Network:
    """Fit on (doc_id, text, label) rows. A text is as toxic as its most toxic window, so each round scores all
    windows and learns from every text's highest one and one other window of each clean text."""
    rng = np.random.default_rng(seed)
    rows = sorted(rows)
    texts, labels = pa.array([r[1] for r in rows], pa.string()), np.array([r[2] for r in rows])
    if not len(rows):
        return Network([])
    counts, codes, words = _words(texts)
    plain = words.to_pylist()
    owner = np.repeat(np.arange(len(rows)), counts)
    pairs = np.unique(owner * len(plain) + codes)
    seen: dict[str, list[int]] = {}
    for k, y in zip((pairs % len(plain)).tolist(), labels[pairs // len(plain)].tolist()):
        seen.setdefault(plain[k], [0, 0])[y] += 1
    least = max(4, len(rows) / 100)
    common = [w for w, n in sorted(seen.items(), key=lambda x: (-sum(x[1]), x[0])) if sum(n) >= least]
    net = Network(common[:max_vocabulary])
    ids = net.ids(words)
    # The first cell of a word or triple starts at its log odds, so that the first round's highest windows mean something.
    sizes = np.bincount(labels, minlength=2)
    net.w["words"][:, 0] = _log_odds(np.array([[0, 0], *(seen[w] for w in net.vocabulary)]), sizes)
    for name, cut in CHARS.items():
        bucket, word = cut(words)
        by_word = np.searchsorted(word, np.arange(len(plain) + 1))
        hits = np.zeros((BUCKETS, 2), np.int64)
        for y in (0, 1):
            for k in np.flatnonzero(labels == y).tolist():
                own = np.unique(pairs[np.searchsorted(pairs, k * len(plain)) : np.searchsorted(pairs, (k + 1) * len(plain))] % len(plain))
                hits[np.unique(np.concatenate([bucket[by_word[j] : by_word[j + 1]] for j in own.tolist()] or [np.zeros(0, np.int64)])), y] += 1
        net.w[name][:, 0] = _log_odds(hits, sizes)
    w_owner, first, size = _windows(counts)
    codes, steps = np.r_[codes, np.zeros(WIDTH, np.int64)], np.arange(WIDTH)
    mean, square = ({k: np.zeros_like(v) for k, v in net.w.items()} for _ in range(2))
    step = 0
    heavy = np.clip((labels == 0).sum() / max((labels == 1).sum(), 1), 1, 4)
    rounds = max(rounds, min(24, 12_000 // len(rows)))
    for _ in range(rounds):
        x = net.project(net.inputs(words, ids))
        logits = np.concatenate([net.forward(x, codes[first[a : a + 4096, None] + steps], (steps < size[a : a + 4096, None]).astype(np.float32)) for a in range(0, len(first), 4096)])
        ranked = np.lexsort((-logits, w_owner))
        top = ranked[np.r_[True, w_owner[ranked][1:] != w_owner[ranked][:-1]]]
        others = rng.choice(len(first), min(len(rows), len(first)), replace=False)
        batch = rng.permutation(np.r_[top, others[labels[w_owner[others]] == 0]])
        for at in range(0, len(batch), 128):
            part = batch[at : at + 128]
            spots, mask = codes[first[part, None] + steps], (steps < size[part, None]).astype(np.float32)
            used, local = np.unique(spots, return_inverse=True)
            used_ids = np.where(rng.random(len(used)) < 0.1, 0, ids[used])
            y = labels[w_owner[part]]
            g = net.gradients(words.take(pa.array(used)), used_ids, local.reshape(spots.shape), mask, y, np.where(y == 1, heavy, 1))
            step += 1
            for k, w in net.w.items():
                mean[k] += 0.1 * (g[k] - mean[k])
                square[k] += 0.001 * (g[k] ** 2 - square[k])
                w *= 1 - 0.005 * decay
                w -= 0.005 * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return net


def sample(docs: DataFrame, labels: DataFrame, per_class: int = 1500, max_bytes: int = 64 << 20) -> DataFrame:
    """The bounded training sample: of each label per_class rows at most, in an order fixed by a hash of doc_id, and
    of these as many as come to max_bytes of text together, the shortest in any case.

    Rows of held_out() never enter. Of several labels of one doc_id the highest holds.
    """
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    part = lambda y: known.where(F.col("toxic") == y).orderBy(order, "doc_id").limit(per_class)
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(part(0).union(part(1))), "doc_id").dropDuplicates(["doc_id"])
    # Two partitions of per_class rows at most, by length alone; the texts stay out of the sort.
    sizes = rows.select("doc_id", "toxic", F.octet_length("text").alias("n"))
    total = F.sum("n").over(Window.partitionBy("toxic").orderBy(order, "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    first = F.row_number().over(Window.partitionBy("toxic").orderBy("n", order, "doc_id"))
    fits = sizes.withColumns({"total": total, "first": first}).where((F.col("total") <= max_bytes // 2) | (F.col("first") == 1)).select("doc_id")
    return rows.join(F.broadcast(fits), "doc_id").select("doc_id", "text", "toxic")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, per_class: int = 1500) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs (doc_id, text).

    The network is fitted on sample() alone and sees nothing but texts. A text scores by its highest windows; a null
    or empty text gets the score of a window without words. Scores hold for the share of label 1 among all labels
    that training may see. A null doc_id stays null and isn't held out; repeated
    rows each give a row; without labels every score comes from the untrained network's bias.
    """
    seen = labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior = seen.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    net = train([tuple(r) for r in sample(docs, labels, per_class).collect()], prior)  # 2 * per_class rows at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, max_bytes=4 << 20):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(net.scores(batch.column(1)), pa.float64())], ["doc_id", "score"])

    scored = docs.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
