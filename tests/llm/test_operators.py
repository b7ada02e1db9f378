"""The training-data operators against brute force, round trips and held-out accuracy, odd inputs included."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meridian.llm import chat, decontamination, lines, mixing, packing, quality, shingle_join, simhash, suffixes, token_counts, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, block int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeéß日") for _ in range(rng.randint(1, 8)))
    long = "\n".join(" ".join(word() for _ in range(30)) for _ in range(60))
    near = long.replace(long[400:404], "zzzz", 1)
    texts = [None, "", " \n\t", "one", long, long, near, "x" * 3000, "a b " * 200, long[:300] + " tail", "<|endoftext|> it's \u00a0 ok\x1c!", "Licensed 10 km"]
    rows = [(k, t, None, "s", None, 1, 2) for k, t in enumerate(texts)] + [(None, long, "en", "s", 1, 1, 1), (3, "one", "en", None, 1, 1, 1), (3, "two", "en", None, 1, 1, 1)]
    return spark.createDataFrame(rows, SCHEMA)


def pairs(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def test_chat_round_trip(spark):
    said = ["</s>[INST] ok [/INST]", "\\", "\\</s>", "a\\\\[OUT]", None, "", "[/TURN] x <s>", "w " * 500, "end\\"]
    roles = ["system", "user", "assistant", "tool [/TURN]", None]
    rng = random.Random(2)
    turns = [(c, t, rng.choice(roles), rng.choice(said), "x") for c in (None, 1, 2, 3, 4) for t in range(12)] + [(5, None, "user", "hi", "x"), (5, 1, "assistant", "yo", "x"), (5, 1, "assistant", "yo", "x")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, tokens string")
    path = public_tokenizers.path("word_bpe_49k.json")
    windows = chat.chat_windows(df, path, budget=120, history=40)
    got = {r["conv_id"]: r for r in chat.read_back(windows).collect()}
    by = collections.defaultdict(list)
    for c, t, r, x, _ in turns:
        by[c].append((-1 if t is None else t, r or "", x or ""))
    assert set(got) == set(by)
    for c, rows in by.items():
        rows.sort()
        loss = "".join(x for _, r, x in rows if r == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in rows).encode()).hexdigest()
        assert (got[c]["n_turns"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(rows), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for w in windows.collect():
        turns = chat.parse(w["text"])
        assert w["over_budget"] or w["n_tokens"] <= 120
        assert not w["over_budget"] or len(turns) - w["n_repeated"] == 1
    assert chat.read_back(chat.chat_windows(df.limit(0), path)).count() == 0


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.mark.parametrize("edits, per, low, high", [(1, 10, 20, 30), (2, 10, 8, 26), (2, 5, 4, 14), (3, 4, 3, 20)])
def test_similar_lines(spark, edits, per, low, high):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(low, high))) for _ in range(12)]
    texts = []
    for _ in range(90):
        s = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            i, o = rng.randrange(len(s)), rng.random()
            if o < 0.4:
                s[i] = rng.choice("abx")
            elif o < 0.7 and len(s) > 1:
                del s[i]
            else:
                s.insert(i, rng.choice("abx"))
        texts.append("".join(s))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in lines.repeated_lines(df, edits, per).collect()}
    near = lambda p, q: p == q or edit(p, q) <= min(edits, min(len(p), len(q)) // per)
    assert got == {k: int(any(near(t, u) for u in texts[:k])) for k, t in enumerate(texts)}
    kept = dict(pairs(lines.drop_repeated_lines(df, edits=edits, per=per)))
    assert all((kept[k] == "") == bool(got[k] or not texts[k]) for k in got)


def test_lines_whole_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where(F.length("text") < 4000)
    rows, seen, want = sorted(pairs(docs)), {}, {}
    for doc, text in rows:
        gone = []
        for k, line in enumerate(text.split("\n")):
            # Candidates by length and by a third of the line, found by plain dictionaries.
            close = line in seen.get("whole", set())
            if not close and len(line) >= 10:
                close = any(edit(line, x) <= min(2, min(len(x), len(line)) // 10) for n in range(len(line) - 2, len(line) + 3) for x in seen.get(n, ()) if n >= 10 and len(set(line.split()) ^ set(x.split())) <= 8)
            if close:
                gone.append(k)
            seen.setdefault("whole", set()).add(line)
            seen.setdefault(len(line), set()).add(line)
        want[doc] = gone
    got = {r["doc_id"]: r["removed_lines"] for r in lines.repeated_lines(docs).collect()}
    assert got == want


def test_lines_hot(spark):
    """One line in most documents, one group of near copies: the salted join and the first-line round."""
    near = ["licence text of a product, version %02d, all rights reserved" % k for k in range(40)]
    docs = [(k, f"common line of all documents\n{near[k % 40]}\nown line {k * 7919} of {k * 104729}") for k in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["removed_lines"] for r in lines.repeated_lines(df).collect()}
    want = {k: [0, 1] if k else [] for k in range(200)}
    assert {k: [x for x in v if x < 2] for k, v in got.items()} == want
    cut = dict(pairs(lines.drop_repeated_lines(df)))
    assert cut[0] == docs[0][1] and not cut[5].startswith("common")


def test_lines_odd(spark, odd):
    got = lines.repeated_lines(odd).collect()
    assert len(got) == len({r[0] for r in pairs(odd)})
    assert lines.repeated_lines(odd.limit(0)).count() == 0 and lines.drop_repeated_lines(odd.limit(0)).count() == 0
    rows = [(1, "a repeated line of text", 0), (1, "a repeated line of text", 1), (2, "a repeated line of text", 2), (2, "a line that is nowhere else", 3), (3, None, 4), (None, "\na repeated line of text", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _gone int")
    kept = {r["_gone"]: r["text"] for r in lines.drop_repeated_lines(df).collect()}
    # Row 3 has no repeat, though its doc_id and line number are those of one; the empty line of the last row repeats that of doc 3.
    assert kept == {0: rows[0][1], 1: rows[1][1], 2: "", 3: rows[3][1], 4: None, 5: ""}
    assert lines.drop_repeated_lines(df).columns == df.columns


def brute_repeats(rows, window=50):
    big = 2**63 - 1
    rows = [(big if i is None else i, i, t.encode()) for i, t in rows]
    first = {}
    for i, _, t in rows:
        for p in range(len(t) - window + 1):
            first[t[p : p + window]] = min(first.get(t[p : p + window], i), i)
    out = []
    for i, real, t in rows:
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - window + 1):
            if first[t[p : p + window]] < i:
                gone[p : p + window] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((-1 if real is None else real, len(t), int(gone.sum()), int((gone & ~np.r_[False, gone[:-1]][: len(gone)]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_suffix_repeats(spark, odd):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rng = random.Random(8)
    near = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))  # noqa: E731  one passage, contexts that differ
    mixed = spark.createDataFrame([(k, near() + "a common passage of some length" + near() + "ab" * rng.randint(0, 40)) for k in range(80)], "doc_id long, text string")
    for df in (docs, odd, mixed):
        want = brute_repeats(pairs(df))
        for block, hot in ((20_000, 256), (4 << 20, 256), (500 if df is mixed else 20_000, 0)):
            got = suffixes.remove_repeats(df, block_bytes=block, hot_blocks=hot).drop("kept").collect()
            assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == want
    assert suffixes.remove_repeats(odd.limit(0)).count() == 0


def test_previous_factors():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 99, rng.integers(1, 9)).astype(np.uint8)) + b"\0" * int(rng.integers(0, 2)) for _ in range(120)]
    ids = rng.integers(0, 40, len(texts))
    size = max(map(len, texts))
    rows = np.frombuffer(b"".join(t.ljust(size, b"\0") for t in texts), np.uint8).reshape(-1, size)
    common = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    want = [max((common(t, u) for u, j in zip(texts, ids) if j < i), default=0) for t, i in zip(texts, ids)]
    assert suffixes.previous_factors(rows, np.array([len(t) for t in texts]), ids).tolist() == want


def test_packing_round_trip(spark, odd):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    got = packing.pack_tokens(odd, path, seq_len=256, buffer_tokens=2000).collect()
    found = collections.defaultdict(list)
    for r in got:
        ids, places, ends = np.frombuffer(r["ids"], "<u2"), np.frombuffer(r["position_ids"], "<u2"), r["cu_seqlens"]
        assert len(ids) == 256 and ends[-1] == r["n_tokens"] <= 256
        for a, b, doc, start in zip(ends, ends[1:], r["doc_ids"], r["piece_starts"]):
            assert places[a:b].tolist() == list(range(b - a))
            found[doc].append((start, ids[a:b].tolist()))
    encoder = packing.Encoder(path)
    want = collections.defaultdict(list)
    for doc, text in pairs(odd):
        ids = encoder.encoding.encode_ordinary(text)
        want[doc] += [(k, ids[k : k + 256]) for k in range(0, len(ids), 256)]
        assert np.frombuffer(encoder(text), "<u2").tolist() == ids
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items() if v}
    assert packing.pack_tokens(odd.limit(0), path).count() == 0


def test_best_fit():
    rng = random.Random(1)
    sizes = [rng.randint(1, 64) for _ in range(300)]
    bins, free = packing.best_fit_decreasing(sizes, 64), []
    assert sorted(k for b in bins for k in b) == list(range(300)) and all(sum(sizes[k] for k in b) <= 64 for b in bins)
    for n in sorted(sizes, reverse=True):
        fits = [f for f in free if f >= n]
        if fits:
            free[free.index(min(fits))] -= n
        else:
            free.append(64 - n)
    assert sorted(64 - sum(sizes[k] for k in b) for b in bins) == sorted(free)


def test_token_counts(spark, odd):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    n = lambda t: len(tok.encode(t, add_special_tokens=False))
    want = sorted((i is None, i or 0, len(t.encode()), n(t), n(t) > 2048) for i, t in pairs(docs))
    for most in (200_000, 5):
        got = token_counts.token_counts(docs, path, most_frequent=most).collect()
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == want
    assert token_counts.token_counts(docs.limit(0), path).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts_other_files(spark, name):
    path = public_tokenizers.path(name)
    counter = token_counts.PieceCounter(path)
    docs = spark.createDataFrame([(1, "Two  words\nhere"), (2, None), (3, "Two  words\nhere")], "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs, path).collect()}
    assert got == {1: counter.count(["Two  words\nhere"])[0], 2: 0, 3: counter.count(["Two  words\nhere"])[0]}


def test_pre_tokens_are_counted_once(spark):
    docs = spark.createDataFrame([(k, "the cat, the dog; the end") for k in range(9)], "doc_id long, text string")
    rows = token_counts.pre_token_frequencies(docs, public_tokenizers.path("word_bpe_49k.json"))
    first = rows.first()
    assert dict(zip(first["pre_tokens"], first["counts"])) == {"the": 3, "cat": 1, ",": 1, "dog": 1, ";": 1, "end": 1}


def base_counts(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = collections.Counter(windows)
    hit = {k for i, w in enumerate(windows) if often[w] > 1 for k in range(i, i + 8)}
    rows = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(rows) - len(set(rows)), len(hit))


def test_quality(spark, odd):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for df in (docs, odd):
        got = quality.quality(df).collect()
        key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
        assert sorted(((r["doc_id"], *(r[c] for c in quality.COUNTS)) for r in got), key=key) == sorted(((i, *base_counts(t)) for i, t in pairs(df)), key=key)
        assert all(r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]) and not (r["base_failed"] and r["kept"]) for r in got)
    judged = quality.quality(docs).join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").where("NOT base_failed")
    right = judged.select(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert right > 0.9
    assert quality.quality(odd.limit(0)).count() == 0 and quality.keep_good(odd).columns == odd.columns


def test_simhash(spark, odd):
    import xxhash

    def fingerprint(text):
        words = text.encode().lower().split()
        grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    for df in (docs, odd):
        rows = [(i, fingerprint(t)) for i, t in pairs(df)]
        label = list(range(len(rows)))
        for _ in rows:
            before = list(label)
            for x in range(len(rows)):
                label[x] = min(label[y] for y in range(len(rows)) if bin(rows[x][1] ^ rows[y][1]).count("1") <= 3)
            if label == before:
                break
        first = {}
        for (i, _), c in zip(rows, label):
            first[c] = min(x for x in (first.get(c), i) if x is not None) if (i is not None or c in first and first[c] is not None) else None
        want = sorted(((i is None, i or 0, f"{f:016x}", first[c]) for (i, f), c in zip(rows, label)), key=str)
        got = sorted(((r[0] is None, r[0] or 0, r[1], r[2]) for r in simhash.near_groups(df).collect()), key=str)
        assert got == want
    assert simhash.near_groups(odd.limit(0)).count() == 0 and simhash.keep_first(odd).columns == odd.columns


def test_links_equal_brute_force(spark):
    rng = random.Random(9)
    values = [rng.getrandbits(64) for _ in range(60)]
    values += [v ^ sum(1 << b for b in rng.sample(range(64), k)) for v in values for k in (1, 2, 3, 4)]
    signed = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 3}
    assert {tuple(r) for r in simhash.links(df).collect()} == want


def brute_groups(texts, width, threshold):
    sets = []
    for text in texts:
        words = text.encode().lower().split()
        sets.append({tuple(words[k : k + width]) for k in range(max(len(words) - width + 1, min(len(words), 1)))})
    label = list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            joint = len(sets[i] & sets[j])
            if sets[i] == sets[j] or joint and joint / (len(sets[i]) + len(sets[j]) - joint) >= threshold:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return dict(enumerate(label))


def test_near_groups_equal_brute_force(spark, odd):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(40)]
    texts = ["", "a b", "A  B\n", "a b c", None]
    for k in range(60):
        base = [word() for _ in range(rng.choice((8, 30, 60, 200)))] + passage * (k % 3 == 0)
        for _ in range(rng.choice((1, 2, 6))):
            near = list(base)
            for _ in range(rng.randrange(1 + len(near) // 25)):  # down to and past similarity 0.8
                near[rng.randrange(len(near))] = word()
            texts.append(" ".join(near))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute_groups([x or "" for x in texts], 5, 0.8)
    for params in ({}, {"share": 1, "max_broadcast": 1, "hubs": 1}):
        assert {r["doc_id"]: r["component_id"] for r in shingle_join.near_groups(docs, **params).collect()} == want
    import corpus_pipeline

    kept = corpus_pipeline.near_dedup(spark, docs, DATA)  # SimHash at 3 bits kept most of these near copies
    assert {r["doc_id"] for r in kept.collect()} == set(want.values())
    assert shingle_join.near_groups(odd).count() == odd.count()
    assert simhash.keep_first(odd, shingle_words=5, similarity=0.8).columns == odd.columns
    assert shingle_join.near_groups(odd.limit(0)).count() == 0


def test_decontamination(spark, odd):
    items = [(1, "Anna paid 12 dollars for Bob and then 12 dollars for the old red Bike again"), (2, "tiny one"), (3, None), (4, "six plain words stand here now")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [
        "so Maria paid 70 euros for Tom and then 70 euros for the old red Car again",
        "so Maria paid 70 euros for Tom and then 35 euros for the old red Car again",
        "before SIX plain words, stand here now. after",
        "nothing of the kind is in here at all",
        None,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for cap in (1_000_000, 1):
        got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in decontamination.leaks(docs, bench, coverage=0.8, max_broadcast=cap).collect()}
        assert (0, 1) in got and (2, 4) in got and (1, 1) not in got and len(got) == 2
    short = spark.createDataFrame([(1, "Say: tiny ONE, here"), (2, "a tiny two"), (3, "just 5 km now"), (4, "just 7 km now")], "doc_id long, text string")
    few = spark.createDataFrame([(1, "tiny one"), (2, "5 km")], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(short, few).collect()} == {(1, 1), (3, 2)}
    one = spark.createDataFrame([(1, "we had 12 red balls and then we had 35 green balls in the old box")], "item_id long, text string")
    same = spark.createDataFrame([(1, "we had 70 red balls and then we had 70 green balls in the old box"), (2, "we had 70 red balls and then we had 71 green balls in the old box")], "doc_id long, text string")
    # Two item values can't stand for one document value: the windows that hold both are lost.
    found = {r["doc_id"]: r["coverage"] for r in decontamination.leaks(same, one, coverage=0.0).collect()}
    assert found[2] == 1.0 and found.get(1, 0.0) < 0.8
    kept = decontamination.drop_leaks(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert decontamination.leaks(odd.limit(0), bench).count() == 0 and decontamination.leaks(odd, bench.limit(0)).count() == 0


def test_decontamination_starts_and_variants(spark):
    items = [
        (1, "Anna has 5 red apples in a bag. Bob gives her 3 more apples from the tree. Carol eats 2 of them after the lunch."),
        (2, "Seven plain words stand in here now"),
        (3, "a train of 5 cars goes along the old river for 5 hours and then it stops"),
    ]
    texts = [
        "Maria has 7 red apples in a bag. Peter gives her 4 more apples from the tree. Susan eats 6 of them after the lunch.",
        "and so Seven plain words stand in here now again",
        "a train of 9 cars goes along the old river for 9 hours and then it stops. a train of 8 cars goes along the old river for 8 hours and then it stops.",
        "a train of 9 cars goes along the old river for 8 hours and then it stops.",
        "seven plain words stand in here now and Anna is at home",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in decontamination.leaks(docs, bench, coverage=0.8).collect()}
    assert got == {(0, 1): 1.0, (1, 2): 1.0, (2, 3): 1.0, (4, 2): 1.0}


def test_mixing(spark, odd):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = mixing.mixture(docs, labels)
    total = got.agg(F.sum("n_tokens"), *(F.sum(F.col("n_tokens") * F.col(f"p_{x}") * F.col("rate")) for x in mixing.DOMAINS), F.min("rate")).first()
    for x, share in zip(mixing.DOMAINS, total[1:4]):
        assert abs(share / total[0] - mixing.TARGETS[x]) < 1e-3
    assert total[4] >= 0
    assert mixing.mixture(odd, labels).count() == odd.count() and mixing.mixture(odd, labels.limit(0)).count() == odd.count()
    assert mixing.mixture(odd.limit(0), labels).count() == 0 and mixing.mix(odd, labels).columns == odd.columns


def test_mixing_classifier_held_out(spark):
    """Domains of labelled documents that the classifier has not seen."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    seen = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(4)) > 0
    labelled = docs.join(labels.withColumn("domain", mixing.domain_of(F.col("quality"), F.col("toxic"))), "doc_id").select("doc_id", "text", "domain")
    found = mixing.posteriors(labelled, labels.where(seen)).where(~seen).collect()
    likeliest = [(r["domain"], int(np.argmax([r[f"p_{x}"] for x in mixing.DOMAINS]))) for r in found]
    assert sum(a == b for a, b in likeliest) / len(likeliest) > 0.8
    toxic = [b for a, b in likeliest if a == 2]
    assert sum(b == 2 for b in toxic) / len(toxic) > 0.7


def test_mixing_equals_plain_solver(spark):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([2, 1, 0.5], 50)
    tokens = rng.integers(1, 400, 50)
    rows = spark.createDataFrame([(int(n), *map(float, x)) for n, x in zip(tokens, p)], "n_tokens long, p_clean double, p_low_quality double, p_toxic double")
    got = np.array([r["rate"] for r in mixing.rates(rows).orderBy("n_tokens", "p_clean").collect()])
    order = np.lexsort((p[:, 0], tokens))
    p, tokens = p[order], tokens[order]
    goal = np.array([mixing.TARGETS[x] for x in mixing.DOMAINS]) * tokens.sum()
    rate, weight = np.ones(50), p * tokens[:, None]
    for _ in range(200_000):  # plain projected gradient on the squared misses, in small steps
        miss = weight.T @ rate - goal
        rate = np.maximum(rate - p @ miss / np.linalg.norm(p.T @ weight, 2), 0)
        if np.abs(miss).max() < 1e-9 * tokens.sum():
            break
    assert np.abs(weight.T @ rate - goal).max() < 1e-5 * tokens.sum() and np.abs(weight.T @ got - goal).max() < 1e-5 * tokens.sum()
    assert got.min() >= 0


def test_mix_clashing_names(spark):
    docs = spark.createDataFrame([(1, "some text", 1, 2, 3), (1, "some text", 1, 2, 3), (None, None, 1, 2, 3)], "doc_id long, text string, _copies int, _copy int, _id int")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    with pytest.warns(RuntimeWarning):
        assert mixing.mix(docs, labels).columns == docs.columns


def test_mixing_rare_domain(spark):
    likely = [(0.97, 0.029, 0.001)] * 950 + [(0.08, 0.919, 0.001)] * 48 + [(0.1, 0.1, 0.8)] * 2
    rows = spark.createDataFrame([(100, *p) for p in likely], "n_tokens long, p_clean double, p_low_quality double, p_toxic double")
    assert sum(p[2] for p in likely) / len(likely) < 0.003
    got = mixing.rates(rows).agg(F.sum("n_tokens"), *(F.sum(F.col("n_tokens") * F.col(f"p_{x}") * F.col("rate")) for x in mixing.DOMAINS), F.min("rate")).first()
    for x, share in zip(mixing.DOMAINS, got[1:4]):
        assert abs(share / got[0] - mixing.TARGETS[x]) < 1e-5
    assert got[4] >= 0
    none = rows.withColumns({"p_clean": F.col("p_clean") + F.col("p_toxic"), "p_toxic": F.lit(0.0)})
    with pytest.warns(RuntimeWarning, match="toxic 0 for 0.05"):
        assert mixing.rates(none).count() == 1000


def test_toxicity_held_out(spark, odd):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    insults = "idiot moron clown trash".split()
    rng = random.Random(4)
    prose = lambda n: [rng.choice("the of and er on in at ti re ed nd".split()) + rng.choice("abcdef") for _ in range(n)]
    rows = []
    for k in range(500):
        words = prose(rng.randint(20, 120))
        if k % 4 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(insults))
        rows.append((k, " ".join(words), int(k % 4 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity.toxicity(df.select("doc_id", "text"), df.select("doc_id", "toxic")).join(df, "doc_id").where("held_out").collect()
    assert got and sum(r["predicted"] == r["toxic"] for r in got) / len(got) > 0.95
    scored = toxicity.toxicity(odd, labels.limit(40)).collect()
    assert len(scored) == odd.count() and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.toxicity(odd, labels.limit(0)).count() == odd.count()


def test_toxicity_of_labelled_documents(spark, odd):
    """Held-out rows of the real labels: few are toxic, so recall is not held to more than it reaches."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    judged = docs.join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id")))
    found = toxicity.toxicity(docs.join(labels, "doc_id", "left_semi"), labels).join(judged.select("doc_id", "toxic"), "doc_id").collect()
    toxic, clean = [r["predicted"] for r in found if r["toxic"]], [r["predicted"] for r in found if not r["toxic"]]
    print("held out: recall", sum(toxic) / len(toxic), "false", sum(clean) / len(clean), len(toxic), len(clean))
    assert sum(toxic) / len(toxic) > 0.55 and sum(clean) / len(clean) < 0.06
    assert toxicity.toxicity(odd.limit(0), labels).count() == 0


def test_every_offset_is_seen_whole():
    """A run of 17 words lies whole in one window, at whatever place it starts."""
    owner, first, size = toxicity._windows(np.array([500]))
    assert all(any(f <= k and k + 17 <= f + n for f, n in zip(first.tolist(), size.tolist())) for k in range(500 - 16))


def test_gradients_match_differences():
    import pyarrow as pa

    rng = np.random.default_rng(0)
    net = toxicity.Network(["one", "two", "three"])
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    words = pa.array(["one", "two", "four", "x"])
    ids, codes = net.ids(words), rng.integers(0, 4, (3, toxicity.WIDTH))
    mask = (np.arange(toxicity.WIDTH) < np.array([[5], [32], [1]])).astype(float)
    y, cost = np.array([1, 0, 1]), np.ones(3)

    def loss():
        p = 1 / (1 + np.exp(-net.forward(net.project(net.inputs(words, ids)), codes, mask).astype(float)))
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    g = net.gradients(words, ids, codes, mask, y, cost)
    for name in ("pool", "out", "hf", "xb", "cf"):
        at = tuple(0 for _ in net.w[name].shape)
        old, step = net.w[name][at], 1e-2
        net.w[name][at] = old + step
        up = loss()
        net.w[name][at] = old - step
        down = loss()
        net.w[name][at] = old
        assert abs((up - down) / (2 * step) - g[name][at]) < 2e-4, name


def test_pipeline_stages(spark):
    import corpus_pipeline
    from meridian.llm.common import materialise

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs.count(), materialise(stage(spark, docs, DATA))
        assert docs.count() > 0, name
        if name != "token packing":
            assert docs.columns == columns
        if name in ("quality rules", "near dedup", "decontamination"):
            assert docs.count() <= before
