"""Mixing documents to target weights: domain posteriors from a labelled table, rates by projected gradients."""

from __future__ import annotations

import warnings
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import materialise, text_of, unused

DOMAINS = ("clean", "low_quality", "toxic")
TARGETS = {"clean": 0.90, "low_quality": 0.05, "toxic": 0.05}
#: Upper bounds of the bins of each feature of a text's form; the last bin is open.
BINS = {
    "symbols": (0.0, 0.02, 0.10),
    "capitals": (0.02, 0.15, 0.40),
    "exclamations": (0.0, 0.05, 0.20),
    "length": (19, 99, 499),
    "same_lines": (0.0, 0.10, 0.30),
}
BUCKETS = 1 << 15
#: Numbers of first letters of a word that stand for its stem.
STEMS = (5, 7)
#: Characters that part words like blanks (fixed values).
_PARTS = "\t\n\x0b\x0c\r.,;:!?()[]{}<>|&*#%$\"'"


def domain_of(quality: Column, toxic: Column) -> Column:
    return F.when(toxic == 1, 2).when(quality == 0, 1).otherwise(0)


def features(rows: DataFrame) -> DataFrame:
    """rows (_text) with n_tokens (words), the bin number of every feature of form, and `buckets`: the distinct hash
    buckets of the text's words, lower-cased, and of the first letters of longer ones. All of the whole text."""
    words = F.regexp_count("_text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = rows.withColumn("n_tokens", words).withColumn("_lines", F.split("_text", "\n"))
    some = F.greatest(F.col("n_tokens"), F.lit(1))
    values = {
        "symbols": F.regexp_count("_text", F.lit(r"[#*$%&|<>]")) / some,
        "capitals": F.regexp_count("_text", F.lit(r"\p{Lu}")) / F.greatest(F.length("_text"), F.lit(1)),
        "exclamations": (F.octet_length("_text") - F.octet_length(F.replace("_text", F.lit("!")))) / some,
        "length": F.col("n_tokens"),
        "same_lines": 1 - F.size(F.array_distinct(F.transform("_lines", lambda x: F.xxhash64(x)))) / F.size("_lines"),
    }
    part = lambda v, bounds: reduce(lambda a, b: a + b, ((v > x).cast("int") for x in bounds))
    rows = rows.withColumns({f"_v_{k}": v for k, v in values.items()})
    rows = rows.withColumns({f"_b_{k}": part(F.col(f"_v_{k}"), BINS[k]) for k in BINS}).drop("_lines", *(f"_v_{k}" for k in BINS))
    plain = F.split(F.translate(F.lower("_text"), _PARTS, " " * len(_PARTS)), " ")
    # A column of its own, so that it is made once and not for each of its uses.
    rows = rows.withColumn("_distinct", F.array_distinct(plain))
    rows = rows.withColumn("_long", F.filter("_distinct", lambda w: F.length(w) > STEMS[0]))
    bucket = lambda *x: F.pmod(F.xxhash64(*x), F.lit(BUCKETS)).cast("int")
    stems = [F.transform("_long", lambda w: bucket(F.lit(n), F.substring(w, 1, n))) for n in STEMS]  # noqa: B023
    words = F.transform("_distinct", lambda w: bucket(w))
    return rows.withColumn("buckets", F.array_distinct(F.concat(words, *stems))).drop("_distinct", "_long")


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """At most max_rows labelled documents, in an order fixed by a hash of doc_id: _text and domain."""
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows).select(F.col("doc_id").alias("_id"), domain_of(F.col("q"), F.col("t")).alias("domain"))
    texts = docs.select("doc_id", text_of().alias("_text"))
    return texts.join(F.broadcast(chosen), texts["doc_id"] == chosen["_id"]).select("_text", "domain")


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def calibrate(form: np.ndarray, word: np.ndarray, size: np.ndarray, domain: np.ndarray, pull: float = 2.0) -> tuple[float, float, float, list[float]]:
    """How much evidence of form and of words counts: (a, b, c, bias) of logits a * form + b * (1 + size / 50) ** -c *
    word + bias that fit held-out texts best (log loss, with a pull towards 1, 1 and 0 worth `pull` texts).

    form, word: (texts, domains) summed log odds; size: distinct words. Words of one text are far from independent,
    so their sum grows with its length while what it proves doesn't; the exponent c takes that back."""
    best = None
    y = np.eye(len(DOMAINS))[domain] if len(domain) else np.zeros((0, len(DOMAINS)))
    for c in (0.0, 0.25, 0.5, 0.75, 1.0):
        scaled = word * ((1 + size / 50) ** -c)[:, None]
        x = np.array([1.0, 1.0, *[0.0] * len(DOMAINS)])
        logits = lambda x: x[0] * form + x[1] * scaled + x[2:]  # noqa: E731, B023

        def loss(x: np.ndarray) -> float:
            p = _softmax(logits(x)) if len(y) else y  # noqa: B023
            return -np.log(np.maximum((p * y).sum(1), 1e-12)).sum() + pull * (((x[:2] - 1) ** 2).sum() + (x[2:] ** 2).sum())

        for _ in range(60):  # Newton steps on a convex loss of five numbers, halved while they overshoot
            p = _softmax(logits(x)) if len(y) else y
            parts = np.stack([form, scaled, *(np.broadcast_to(e, form.shape) for e in np.eye(len(DOMAINS)))], axis=2)
            mean = np.einsum("nd,ndk->nk", p, parts)
            slope = np.einsum("nd,ndk->k", p - y, parts) + 2 * pull * (x - [1, 1, *[0] * len(DOMAINS)])
            curve = np.einsum("nd,ndk,ndl->kl", p, parts, parts) - mean.T @ mean + 2 * pull * np.eye(len(x))
            step = np.linalg.solve(curve, slope)
            while loss(x - step) > loss(x) and np.abs(step).max() > 1e-9:
                step = step / 2
            x = x - step
            if np.abs(step).max() < 1e-7:
                break
        if best is None or loss(x) < best[0] - 1e-9:
            best = (loss(x), (float(x[0]), float(x[1]), c, [float(v) for v in x[2:]]))
    return best[1]


#: Where each form feature's bins begin among the weights, after the word buckets.
_FORM = {f: BUCKETS + sum(len(BINS[g]) + 1 for g in list(BINS)[:k]) for k, f in enumerate(BINS)}
_WEIGHTS = BUCKETS + sum(len(b) + 1 for b in BINS.values())


def supported(texts: list[np.ndarray], domain: np.ndarray, least: float = 4.0) -> np.ndarray:
    """Whether a feature's share of the occurrences of some domain is over `least` standard errors from its share of
    the others'; of occurrences, not texts, as longer texts have more of every word, which says nothing of any."""
    own = np.zeros((_WEIGHTS, len(DOMAINS)))
    for x, d in zip(texts, domain.tolist()):
        own[x, d] += 1
    n = own.sum(axis=0)
    rest, n_rest = own.sum(axis=1, keepdims=True) - own, n.sum() - n
    odds = np.log((own + 0.5) / (n + 0.5 * _WEIGHTS)) - np.log((rest + 0.5) / (n_rest + 0.5 * _WEIGHTS))
    return (odds**2 / (1 / (own + 0.5) + 1 / (rest + 0.5)) > least**2).any(axis=1)


def fit_weights(texts: list[np.ndarray], domain: np.ndarray, rounds: int = 30, decay: float = 3e-4, rate: float = 0.1, seed: int = 5) -> np.ndarray:
    """(_WEIGHTS, domains) of a softmax regression on the features of each text, by adaptive gradient steps over
    batches of 64 texts in a fixed order. Only features of form and supported() ones have weights: hashes of rare
    words would fit the sample and nothing else."""
    keep = supported(texts, domain)
    keep[BUCKETS:] = True
    texts = [x[keep[x]] for x in texts]
    w, square = np.zeros((_WEIGHTS, len(DOMAINS))), np.full((_WEIGHTS, 1), 1e-3)
    bias = np.log((np.bincount(domain, minlength=len(DOMAINS)) + 1) / (len(domain) + len(DOMAINS)))
    rng, y = np.random.default_rng(seed), np.eye(len(DOMAINS))[domain]
    for _ in range(rounds if len(texts) else 0):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), 64):
            part = order[at : at + 64]
            flat = np.concatenate([texts[k] for k in part])
            owner = np.repeat(np.arange(len(part)), [len(texts[k]) for k in part])
            logits = np.stack([np.bincount(owner, w[flat, d], minlength=len(part)) for d in range(len(DOMAINS))], axis=1) + bias
            off = (_softmax(logits) - y[part]) / len(part)
            used, place = np.unique(flat, return_inverse=True)
            g = np.stack([np.bincount(place, off[owner, d], minlength=len(used)) for d in range(len(DOMAINS))], axis=1) + decay * w[used]
            square[used] += (g * g).sum(1, keepdims=True)
            w[used] -= rate * g / np.sqrt(square[used])
    w[_FORM["length"] : _FORM["length"] + len(BINS["length"]) + 1] += bias  # each text has one of these bins
    return w


def posteriors(docs: DataFrame, labels: DataFrame, train_rows: int = 6000) -> DataFrame:
    """docs with n_tokens and p_<domain>: a classifier over hashed words, their stems and features of form.

    It is fitted on a bounded sample of labelled rows: weights of words and of form features' bins on three quarters
    of them, how much either counts by calibrate() on the rest. The sample's features, at most BUCKETS a text, come to
    the driver; weights go into the plan as one literal.
    """
    sample = features(labelled_sample(docs, labels, train_rows)).withColumn("_held", F.pmod(F.xxhash64("_text"), F.lit(4)) == 0)
    got = sample.select("domain", "_held", *(F.col(f"_b_{f}").alias(f) for f in BINS), F.concat_ws(" ", "buckets").alias("words")).collect()
    got = sorted(map(tuple, got), key=repr)  # the order in which rows arrive is not fixed
    own = [np.array(r[-1].split(), np.int64) for r in got]
    bins = [np.array([_FORM[f] + r[2 + k] for k, f in enumerate(BINS)], np.int64) for r in got]
    held, domain = np.array([r[1] for r in got], bool), np.array([r[0] for r in got], np.int64)
    weights = np.round(fit_weights([np.concatenate([own[k], bins[k]]) for k in np.flatnonzero(~held)], domain[~held]), 4)
    total = lambda rows: np.array([weights[x].sum(axis=0) for x in rows]).reshape(-1, len(DOMAINS))
    tried = np.flatnonzero(held)
    a, b, c, bias = calibrate(total([bins[k] for k in tried]), total([own[k] for k in tried]), np.array([len(own[k]) for k in tried]), domain[held])
    # Words that tell nothing have no weights, so the plan holds a place for each bucket (0: none) and the weights of the others.
    # Strings become constant arrays when the plan is made, which every text of the plan spells out: three times all
    # weights were megabytes of it at once on the driver.
    telling = weights[:BUCKETS].any(axis=1)
    places = F.split(F.lit(",".join(map(str, np.where(telling, np.cumsum(telling), 0)))), ",").cast("array<int>")
    table = F.split(F.lit(",".join(f"{x:.4f}" if x else "0" for x in [*[0.0] * len(DOMAINS), *weights[:BUCKETS][telling].ravel()])), ",").cast("array<double>")

    def form(d: int) -> Column:
        score = F.lit(0.0)
        for f, bounds in BINS.items():
            score = score + F.get(F.array(*(F.lit(float(x)) for x in weights[_FORM[f] : _FORM[f] + len(bounds) + 1, d])), F.col(f"_b_{f}"))
        return score

    names = [f"s{d}" for d in range(len(DOMAINS))]
    start = F.struct(*(F.lit(0.0).alias(n) for n in names))
    step = lambda a, b: F.struct(*((a[n] + F.get(table, b * len(DOMAINS) + d)).alias(n) for d, n in enumerate(names)))
    rows = features(docs.withColumn("_text", text_of())).drop("_text")
    hits = F.filter(F.transform("buckets", lambda b: F.get(places, b)), lambda place: place > 0)
    rows = rows.withColumns({"_hits": hits, "_size": F.size("buckets")}).drop("buckets")
    rows = rows.withColumn("_w", F.aggregate("_hits", start, step)).drop("_hits")
    faded = b * F.pow(1 + F.col("_size") / 50, F.lit(-c))
    rows = rows.withColumns({f"_s{d}": a * form(d) + faded * F.col(f"_w.s{d}") + bias[d] for d in range(len(DOMAINS))})
    top = F.greatest(*(F.col(f"_s{d}") for d in range(len(DOMAINS))))
    rows = rows.withColumns({f"_e{d}": F.exp(F.col(f"_s{d}") - top) for d in range(len(DOMAINS))})
    norm = reduce(lambda x, y: x + y, (F.col(f"_e{d}") for d in range(len(DOMAINS))))
    rows = rows.withColumns({f"p_{name}": F.col(f"_e{d}") / norm for d, name in enumerate(DOMAINS)})
    return rows.drop("_w", "_size", *(f"_b_{k}" for k in BINS), *(f"_{x}{d}" for x in "se" for d in range(len(DOMAINS))))


def _step(gram: np.ndarray, goal: np.ndarray, total: float, miss: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """What moves the totals by -miss as nearly as the Gram matrix lets it, each miss relative to its goal, so that
    rare domains count alike; the ridge keeps rates still where domains can't be told apart, and leaves the fixed
    point alone."""
    size = np.maximum(goal, 1e-3 * max(total, 1.0))
    near = gram / size[:, None] ** 2
    normal = gram @ near + ridge / max(total, 1.0) * gram
    return np.linalg.pinv((normal + normal.T) / 2, rcond=1e-13, hermitian=True) @ (near.T @ miss)


def rates(
    rows: DataFrame, targets: dict[str, float] = TARGETS, most: float = float("inf"), anchor: str | None = None, protect: float | None = None, slack: float | None = None, rounds: int = 60,
    tolerance: float = 1e-6,
) -> DataFrame:
    """rows (n_tokens, p_<domain>) with `rate`, from 0 to `most`, so that expected domain tokens come to the targets.

    Least squares over all documents' rates, weighted by tokens and started from 1, by projected gradient steps: a
    step moves each rate by its posteriors times a vector of one number per domain and cuts it off at 0 and `most`,
    so rates stay as near to 1 as the targets let them. Targets are shares of the present tokens, or, with an anchor,
    of as many as leave that domain its present tokens; documents whose posterior of the anchor is `protect` or more
    never go below 1 then. The driver sees the domains' totals and their Gram matrix over
    the documents that can still go down, which scales the step; a step that made things worse is taken back and halved. A
    document's rate is the fold of the steps so far, so nothing per document is kept between passes. Steps end when
    each domain is within tolerance of its target, relative to it; if `rounds` steps don't come there, or eight gain
    less than 1 % (a domain no token is likely in, a bound in the way), the best steps so far stand and a
    RuntimeWarning gives what each domain misses. With slack, a domain that misses its target by more than that
    share of it leaves every rate at 1.
    """
    names = list(targets)
    p = [F.col(f"p_{x}") for x in names]
    start = rows.agg(F.sum("n_tokens"), *(F.sum(F.col("n_tokens") * a) for a in p)).first()
    total = start[0] or 0
    share_of = np.array([targets[x] for x in names]) / sum(targets.values())
    if anchor is not None:
        k = names.index(anchor)
        total = (start[1 + k] or 0) / share_of[k]
    goal = share_of * total
    least = F.lit(0.0) if anchor is None or protect is None else F.when(F.col(f"p_{anchor}") >= protect, float(min(1.0, most))).otherwise(0.0)
    steps: list[list[float]] = []
    best: tuple[float, list[list[float]], np.ndarray] | None = None
    share = 1.0
    record: list[float] = []

    def rate(steps: list[list[float]]) -> Column:
        first = F.lit(float(min(1.0, most)))
        if not steps:
            return first
        dot = lambda s: reduce(lambda a, b: a + b, (c * F.get(s, k) for k, c in enumerate(p)))
        path = F.array(*(F.array(*map(F.lit, s)) for s in steps))
        return F.aggregate(path, first, lambda r, s: F.least(F.greatest(r - dot(s), least), F.lit(float(most))))

    while True:
        moved = rows.withColumn("_rate", rate(steps))
        live = F.when(F.col("_rate") > least, F.col("n_tokens")).otherwise(0)
        sums = moved.agg(*(F.sum(F.col("n_tokens") * a * F.col("_rate")) for a in p), *(F.sum(live * a * b) for a in p for b in p)).first()
        now, gram = np.array([x or 0.0 for x in sums[: len(p)]]), np.array([x or 0.0 for x in sums[len(p) :]]).reshape(len(p), len(p))
        missed = np.abs(now - goal) / np.where(goal > 0, goal, max(total, 1))
        worse = best is not None and missed.max() > 1.5 * best[0]
        if best is None or missed.max() < best[0]:
            best = (missed.max(), [*steps], now)
        share = share / 2 if record and missed.max() > record[-1] else min(1.0, 1.5 * share)
        step = share * _step(gram, goal, total, now - goal)
        if missed.max() <= tolerance:
            break
        record.append(missed.max())
        stuck = len(record) > 8 and min(record[-8:]) > 0.99 * min(record[:-8])
        if len(record) > rounds or stuck or np.abs(step).max() <= 1e-12:
            said = ", ".join(f"{x} {a / max(total, 1):.6g} for {b / max(total, 1):.6g}" for x, a, b in zip(names, best[2], goal))
            warnings.warn(f"mixing targets not met after {len(best[1])} steps (share reached for share wanted): {said}", RuntimeWarning, stacklevel=2)
            break
        if worse and len(steps) > len(best[1]):
            steps = [*best[1]]  # back to the best, with a smaller step from there next time round
            steps.append([float(x) for x in share * _step(gram, goal, total, best[2] - goal)])
        else:
            steps.append([float(x) for x in step])
    if slack is not None and best[0] > slack:
        return rows.withColumn("rate", F.lit(1.0))
    return rows.withColumn("rate", rate(best[1]))


def mixture(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, most: float = 4.0, anchor: str | None = None, protect: float | None = None, slack: float | None = None, **params
) -> DataFrame:
    """doc_id, n_tokens, p_<domain>, rate, copies for every row of docs (doc_id, text).

    copies is the rate rounded up or down by a hash of doc_id, so that its mean is the rate; most, anchor, protect
    and slack as in rates(). A null or empty text has no tokens; a null doc_id stays null; repeated rows each give a row; equal
    texts have equal rates; without labels all domains are equally likely; an empty table gives no rows.
    """
    rows = materialise(posteriors(docs.select("doc_id", "text"), labels, **params).drop("text"))
    chance = F.shiftrightunsigned(F.xxhash64(F.lit("mix"), "doc_id"), 11) / float(1 << 53)
    return rates(rows, targets, most, anchor, protect, slack).withColumn("copies", F.floor(F.col("rate") + chance).cast("int"))


def mix(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """docs, all columns, each row as many times as mixture() says; rows that repeat one doc_id go by the largest."""
    key, copies, copy = (unused(docs, x) for x in ("_id", "_copies", "_copy"))
    found = mixture(docs, labels, **params).groupBy(F.col("doc_id").alias(key)).agg(F.max("copies").alias(copies))
    joined = docs.join(found, docs["doc_id"].eqNullSafe(found[key])).where(F.col(copies) > 0)
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)
