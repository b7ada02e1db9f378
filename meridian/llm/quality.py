"""Quality rules as weak supervision: rules vote or abstain, EM learns what votes are worth, a posterior decides."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import materialise, text_of, unused

WINDOW = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Each rule votes good (+) or bad (-) where its condition holds, and abstains elsewhere.
RULES = {
    "many_symbols": ("-", "n_symbols >= 0.10 * n_words"),
    "symbol_text": ("-", "n_symbols >= 0.03 * word_chars"),
    "few_letters": ("-", "n_letters < 0.82 * word_chars"),
    "shouting": ("-", "n_upper >= 0.40 * n_letters"),
    "exclaiming": ("-", "n_bangs >= 0.20 * n_words"),
    "same_lines": ("-", "n_dup_lines >= 0.30 * n_lines"),
    "same_windows": ("-", "n_repeat_words >= 0.20 * n_words"),
    "odd_words": ("-", "word_chars NOT BETWEEN 2.5 * n_words AND 12 * n_words"),
    "clean_prose": (
        "+",
        "n_letters >= 0.90 * word_chars AND n_upper <= 0.15 * n_letters"
        " AND n_repeat_words <= 0.05 * n_words AND n_dup_lines <= 0.05 * n_lines",
    ),
}


def features(docs: DataFrame) -> DataFrame:
    """doc_id, the five base counts and the rules' values of every row, from the whole text (null: no words)."""
    df = docs.select("doc_id", text_of().alias("_t"))
    spaced = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(" ")), "\t\n\x0b\x0c\r", F.col("_t"))
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("_w", F.array_remove(F.split(spaced, " "), "")).withColumn("_l", lines)
    df = df.select(
        "doc_id",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct(F.transform("_l", lambda x: F.xxhash64(x))))).cast("long").alias("n_dup_lines"),
        F.regexp_count("_t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace("_t", r"[^\p{L}]+", "")).cast("long").alias("n_letters"),
        F.regexp_count("_t", F.lit("!")).cast("long").alias("n_bangs"),
        F.transform("_w", lambda x: F.xxhash64(x)).alias("_h"),
    )
    # Hashes of 2, 4 and then 8 words in a row, each from two neighbours of half its length.
    df = df.withColumn("_h", F.when(F.col("n_words") > WINDOW, F.col("_h")).otherwise(F.array().cast("array<bigint>")))
    half = 1
    while half < WINDOW:
        later = F.slice("_h", half + 1, F.greatest(F.size("_h") - half, F.lit(0)))
        whole = F.slice("_h", 1, F.greatest(F.size("_h") - half, F.lit(0)))
        df = df.withColumn("_h", F.zip_with(whole, later, lambda a, b: F.xxhash64(a, b)))
        half *= 2
    df = df.withColumnRenamed("_h", "_v")
    df = df.withColumn("_twice", F.size(F.array_distinct("_v")) < F.size("_v"))
    # Only texts with a repeated window sort their windows; equal ones are then neighbours.
    ordered = F.sort_array(F.transform("_v", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_o", F.when(F.col("_twice"), ordered))
    same = lambda j, k: F.get("_o", j)["h"].eqNullSafe(F.get("_o", k)["h"])
    at = F.filter(F.sequence(F.lit(0), F.size("_o") - 1), lambda j: ((j > 0) & same(j, j - 1)) | same(j, j + 1))
    df = df.withColumn("_s", F.when(F.col("_twice"), F.sort_array(F.transform(at, lambda j: F.get("_o", j)["i"]))))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    grow = lambda a, s: F.struct((s + WINDOW).alias("end"), (a["n"] + s + WINDOW - F.greatest(s, a["end"])).alias("n"))
    covered = F.aggregate("_s", start, grow, lambda a: a["n"])
    df = df.withColumn("n_repeat_words", F.when(F.col("_twice"), covered).otherwise(0).cast("long"))
    return df.select("doc_id", *COUNTS, "n_lines", "n_upper", "n_letters", "n_bangs")


def votes(rules: dict[str, tuple[str, str]] = RULES) -> Column:
    """All rules' votes as one string: + good, - bad, 0 abstains."""
    return F.concat(*(F.when(F.expr(condition), vote).otherwise("0") for vote, condition in rules.values()))


def fit(patterns: list[tuple[str, int]], rounds: int = 200, prior: float = 0.7, accuracy: float = 0.9) -> dict[str, float]:
    """Posterior of good for each vote pattern, by expectation-maximisation over (pattern, number of documents).

    Each rule has an accuracy: how often it is right when it votes. A vote adds or takes its log odds; abstaining
    tells nothing. Accuracies start at 0.9, keep to [0.55, 0.995] and count 20 votes at the start value besides.
    """
    right = [accuracy] * max((len(p) for p, _ in patterns), default=0)
    total, start = sum(c for _, c in patterns), prior

    def posterior(p: str) -> float:
        worth = (math.log(a / (1 - a)) * ((v == "+") - (v == "-")) for v, a in zip(p, right))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, math.log(prior / (1 - prior)) + sum(worth)))))

    for _ in range(rounds):
        good = {p: posterior(p) for p, _ in patterns}
        prior = min(0.98, max(0.02, (sum(c * good[p] for p, c in patterns) + 20 * start) / (total + 20)))
        for j in range(len(right)):
            voted = [(c, good[p] if p[j] == "+" else 1 - good[p]) for p, c in patterns if p[j] != "0"]
            share = (sum(c * x for c, x in voted) + 20 * accuracy) / (sum(c for c, _ in voted) + 20)
            right[j] = min(0.995, max(0.55, share))
    return {p: posterior(p) for p, _ in patterns}


def quality(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, base counts, base_failed, posterior and kept for every row of docs (doc_id, text).

    Documents are counted by vote pattern (2 to the power of the number of rules at most), EM runs over those counts, and
    each pattern's posterior goes back to its documents. base_failed: under 20 words, or over 30 % of the words in
    repeated 8-word windows; such documents are never kept. Null and empty texts have no words and so fail; a null
    doc_id stays null; repeated rows each give a row; an empty table gives none.
    """
    rows = materialise(features(docs).withColumn("votes", votes()))
    counted = rows.groupBy("votes").count().collect()  # at most 2 ** len(RULES) rows
    found = fit(sorted((r["votes"], r["count"]) for r in counted))
    cells = ", ".join(f"('{p}', {x!r}D)" for p, x in sorted(found.items())) or "('', 0D)"
    known = docs.sparkSession.sql(f"SELECT * FROM VALUES {cells} AS known(votes, posterior)")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    scored = rows.join(F.broadcast(known), "votes", "left").withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & (F.coalesce("posterior", F.lit(0.0)) >= threshold)
    return scored.select("doc_id", *COUNTS, "base_failed", kept.alias("kept"), "votes", "posterior")


def keep_good(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, that quality() keeps. Rows that repeat one doc_id stay if one of them is kept."""
    key = unused(docs, "_kept_id")
    good = quality(docs, threshold).where("kept").select(F.col("doc_id").alias(key)).distinct()
    return docs.join(good, docs["doc_id"].eqNullSafe(good[key]), "left_semi")
