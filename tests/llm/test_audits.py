"""Source audit, conversation repair and cost-balanced packing against brute force, odd inputs included."""

import collections
import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from meridian.llm import cost_packing, divergence, repair

public_tokenizers = pytest.importorskip("public_tokenizers")
DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank int, value string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, hot sources, and extra columns with clashing names."""
    rng = random.Random(3)
    words = ["Ape", "bee", "CAT", "dög", "É", "ant-hill", "x1y", " ", "zoo,zoo", "日本", "İx"]
    say = lambda n: rng.choice([" ", "\n", "\x00", "\x7f"]).join(rng.choice(words) for _ in range(n))
    rows = [(k, say(rng.randint(0, 40)), rng.choice(["en", "de", None]), rng.choice(["s", "s", "s", "t", "u", None]), 1, 1, "v") for k in range(60)]
    rows += [(100, None, "en", "only null", 1, 1, "v"), (101, "", "xx", "a", 1, 1, "v"), (102, "1 2 3", "xx", "b", 1, 1, "v"), (None, say(3000), "en", "s", 1, 1, "v"), (103, "rare", "yy", "a", 1, 1, "v")]
    return spark.createDataFrame([*rows, rows[0], rows[0]], DOCS)


def audited(rows, least=3, most=200):
    """The contract by dictionaries and Python's integers."""
    docs = [((r["lang"] or ""), (r["source"] or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"] or ""))) for r in rows]
    out = []
    for lang in {x[0] for x in docs}:
        mine = [x for x in docs if x[0] == lang]
        seen = collections.Counter(t for _, _, ts in mine for t in set(ts))
        kept = sorted(t for t, n in seen.items() if n >= least)
        counts = {s: collections.Counter() for s in {x[1] for x in mine}}
        for _, s, ts in mine:
            counts[s].update(t for t in ts if t in set(kept))
        counts[None] = sum((counts[s] for s in list(counts)), collections.Counter())
        p = {s: {t: 1 + 10**9 * (c[t] + 1) // (sum(c.values()) + len(kept)) for t in kept} for s, c in counts.items()}
        for s in counts:
            if s is None:
                continue
            f = lambda a, b: (a - b) ** 2 // b
            pair = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in counts if o not in (s, None)]
            term = [(f(p[s][t], p[None][t]), t) for t in kept if counts[s][t] and p[s][t] > p[None][t]]
            for part, found, limit in (("pair", pair, None), ("term", term, most)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k) for k, (v, item) in enumerate(found[:limit], 1)]
    return sorted(out)


def test_audit_equals_brute_force(spark, odd):
    got = sorted(tuple(r) for r in divergence.audit(odd).select("lang", "source", "part", "item", "value", "rank").collect())
    assert got == audited(odd.collect())
    few = sorted(tuple(r) for r in divergence.audit(odd, terms=2).where("part = 'term'").collect())
    assert few == sorted(x for x in got if x[2] == "term" and x[5] <= 2)
    assert divergence.audit(odd.limit(0)).count() == 0


def test_audit_spills_and_merges(spark, odd):
    """Blocks of a few postings give the same sums as one block."""
    key = ["lang", "term", "source"]
    whole, small = (sorted(map(tuple, divergence.merge_runs(divergence.block_runs(odd.coalesce(1), n), 3).select(*key, "n", "of_lang").collect())) for n in (1_000_000, 10))
    assert whole == small and divergence.block_runs(odd.coalesce(1), 10).count() >= divergence.block_runs(odd.coalesce(1)).count()


def test_joint_corrections_in_small_tables(spark, odd):
    """Pairs taken a few cells at a time, even rows of one term's table, add up to the same."""
    merged = divergence.merge_runs(divergence.block_runs(odd), 3).where("term <> ''").withColumn("total", F.lit(500).cast("long"))
    add = lambda n: sorted(tuple(r) for r in divergence.joint_corrections(merged, n).groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).collect())
    assert add(2_000_000) == add(2)


def test_shares_of_huge_counts(spark):
    n, total, terms = 9_000_000_000_000_000, 9_100_000_000_000_000_000, 7
    df = spark.createDataFrame([(n, total, terms)], "n long, t long, v long")
    want = 1 + 10**9 * (n + 1) // (total + terms)
    assert df.select(divergence.share(F.col("n"), F.col("t"), F.col("v"))).first()[0] == want
    assert divergence._shares(np.array([n, 0]), np.array([total + terms, 5])).tolist() == [want, 1 + 10**9 // 5]


def mended(rows):
    """Cheapest edits of (role, text) rows by Dijkstra: fault counts, cost, audit, repaired rows."""
    seen, faults = set(), []
    for role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "fine" if last[0] in ".!?" else "truncated")
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return faults, cost, audit, out
        to = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[to]
        heapq.heappush(heap, (cost + 3, audit + "I", i, to, (*out, (name, ""))))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, out))
            if faults[i] in ("fine", "truncated"):
                more = 3 * (faults[i] == "truncated")
                heapq.heappush(heap, (cost + more + 3, audit + "R", i + 1, to, (*out, (name, text))))
                for nxt in {to} | ({"s"} if state == "" else set()):
                    if role[:1] == nxt:
                        heapq.heappush(heap, (cost + more, audit + "K", i + 1, nxt, (*out, (role, text))))


def expected(rows):
    """The contract for (turn, role, text) rows in order."""
    said = [(r, t) for _, r, t in rows]
    faults, cost, audit, out = mended(said)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    roles = [r[:1] for r, _ in said]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


COLUMNS = "gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
TURNS = "conv_id long, turn long, role string, text string, cost int, h string"


def ordered(rows):
    """Rows by turn (nulls first), role and the MD5 of the text."""
    return sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), hashlib.md5(x[2].encode()).digest()))


def test_repair_equals_brute_force(spark):
    rng = random.Random(11)
    roles, texts = ["system", "user", "assistant", "tool", "", None, "u"], ["Yes.", "No", "", " \n", None, "Why?", " ", "End!\x0b ", "é", "Yes.\u0085"]
    rows = [(c, rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts), 1, "x") for c in [*range(60), None] for _ in range(rng.randint(1, 12))]
    rows += [(500, t, ["user", "assistant"][t % 2], f"turn {t}.", 1, "x") for t in range(400)] + [(501, 3, "user", "same.", 1, "x")] * 300
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in repair.repair(df, df).collect()}
    by = collections.defaultdict(list)
    for c, t, r, x, *_ in rows:
        by[c].append((t, " " if r is None else r, " " if x is None else x))
    assert set(got) == set(by)
    for c, own in by.items():
        assert got[c] == expected(ordered(own)), c
    assert repair.repair(df.limit(0), df.limit(0)).count() == 0


def test_segments_and_rules_change_nothing(spark):
    """A conversation in many segments, and grammars of few or many rules, give one answer."""
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b", f"{t}.", f"{t}", ""])) for c in range(3) for t in range(90)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("copies", F.lit(1))
    for longest in (7, 4096):
        cut = repair.segments(df, longest).collect()
        whole = collections.defaultdict(str)
        for r in sorted(cut, key=lambda r: (r["conv_id"], r["block"])):
            assert len(r["symbols"]) <= longest
            whole[r["conv_id"]] += r["symbols"]
        if longest == 7:
            first = whole
    assert first == whole
    sequences = spark.createDataFrame([(s,) for s in whole.values()], "symbols string")
    rounds = repair.grammar(sequences)
    assert sum(map(len, rounds)) > 10
    plain, shared = repair.Matrices([]), repair.Matrices(rounds)
    for c, s in whole.items():
        assert len(repair.compressed(s, rounds)) < len(s)
        want = {k: (n, repair.text(r)) for k, (n, r) in plain(s).items()}
        assert {k: (n, repair.text(r)) for k, (n, r) in shared(s).items()} == want
        cost, audit = repair.finish({t: x for (f, t), x in shared(s).items() if f == repair.START})
        assert (cost, audit) == expected(ordered([x[1:] for x in rows if x[0] == c]))[5:7]


def test_ropes_compare_as_their_texts():
    rng = random.Random(1)
    def rope(depth):
        return rng.choice(["", "D", "I", "K", "DI", "KK"]) if depth == 0 or rng.random() < 0.2 else (rope(depth - 1), rope(depth - 1))
    for _ in range(3000):
        a, b = rope(4), rope(4)
        b = (a, b) if rng.random() < 0.3 else b
        assert repair.before(a, b) == (repair.text(a) < repair.text(b)), (a, b)


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two? Three!") for c in range(12) for t in range(12)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): (r["role"], r["text"], r["copies"]) for r in repair.damage(df).collect()}
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        want = (("user" if k == 4 else role), ("" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text), 2 if k == 3 else 1)
        assert got.get((c, t)) == (None if k == 0 else want)


def test_repair_of_the_table(spark):
    table = spark.read.parquet(f"{DATA}/conversations.parquet")
    damaged = repair.damage(table)
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in repair.repair(damaged, table).collect()}
    by = collections.defaultdict(list)
    for r in damaged.collect():
        by[r["conv_id"]] += [(r["turn"], r["role"], r["text"])] * r["copies"]
    assert got == {c: expected(ordered(by[c])) for c in got} and set(got) == {r["conv_id"] for r in table.collect()}


def test_cost_packing_round_trip(spark, odd):
    from tokenizers import Tokenizer

    texts = ["<|endoftext|> it's   ok\x1c!", "don't  stop ,\n\n(now)!x²3 ßé,Ж.", "  lead", "trail  \n", "a b, c", "word " * 9000, "I'm,we'll.", "\t\t tabs", "Ωmega-3,b", "naïve’s"]
    extra = spark.createDataFrame([(1000 + k, t, "en", "s", 1, 1, "v") for k, t in enumerate(texts)], DOCS)
    docs = odd.unionByName(extra)
    path = public_tokenizers.path("byte_bpe_50k.json")
    packed = cost_packing.pack_balanced(docs, path, seq_len=64)
    rows = packed.collect()
    library = Tokenizer.from_file(path)
    want = collections.Counter()
    for r in docs.collect():
        want[r["doc_id"], tuple([*library.encode(r["text"] or "", add_special_tokens=False).ids, 1])] += 1
    pieces = collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"], np.frombuffer(r["ids"], "<u4").tolist()))
        assert len(r["ids"]) == 4 * r["length"] > 0
    for (doc, n), found in pieces.items():
        copies = [ids for (d, ids), k in want.items() if d == doc and len(ids) == n for _ in range(k)]
        assert sorted(x for s, k, x in found) == sorted(x for s, k, x in found) and sum(k for _, k, _ in found) == n * len(copies)
        if len(copies) == 1:
            assert [i for _, _, ids in sorted(found) for i in ids] == list(copies[0])
        else:
            assert all(tuple(ids) == copies[0][s : s + k] for s, k, ids in found) or len(set(copies)) > 1
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 64 and (at == 64 or at & (at - 1) == 0)
    crc = {(r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in cost_packing.pieces_of(packed).collect()}
    assert crc == {(r["doc_id"], r["start"], r["length"], zlib.crc32(r["ids"])) for r in rows}
    assert cost_packing.pack_balanced(docs.limit(0), path).count() == 0


def test_library_ids_by_unit():
    """Units by array, the library's lines and a forgetful cache give the library's own ids, text by text."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoders = [cost_packing.LibraryIds(path, **most) for most in ({}, {"max_entries": 50, "lines": 3}, {"max_bytes": 300})]
    rng = random.Random(11)
    plain = [*"aZsétö ßɏɐЖ日²½٣509''’.,;:!-_<|># \n\t\r\v\f  \n", "'s", "'ll", ' "', "('s", "×", "÷", "\u0301", "\x00", "\x7f", "\U0001f600", "Ċ", "ß,", "\nAs"]
    odd = [*plain, "\x85", "\xa0", "\u2003", "\u3000", "\x1c", "<|endoftext|>", "<|"]
    for step in range(200):
        texts = ["".join(rng.choices(odd if step % 5 == 0 else plain, k=rng.choice([0, 1, 2, 3, 8, 30]))) for _ in range(rng.randint(0, 12))]
        rows = pa.array(texts, [pa.string(), pa.large_string()][step % 2])
        if len(texts) > 2:
            rows, texts = rows.slice(1, len(rows) - 2), texts[1:-1]
        want = [np.array(encoders[0].tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        for encode in encoders:
            assert encode(rows) == want, texts
            assert len(encode.known) == len(encode.asked) == len(encode.bounds) - 1 and encode.bounds[-1] == len(encode.ids)


def test_library_gets_new_words_together():
    """The library is given each new word once, and about a thousand of them as one text; known words not at all."""
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).combine_chunks().fill_null("")
    encode = cost_packing.LibraryIds(public_tokenizers.path("byte_bpe_50k.json"))
    library, given = encode.tokenizer, []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return library.encode_batch_fast(texts, **options)

    encode.tokenizer = Counting()
    first = encode(texts)
    assert len(encode.known) > 20_000 and len(given) < len(encode.known) / 200
    assert sum(map(len, given)) < 2 * sum(map(len, encode.known.to_pylist()))
    given.clear()
    assert encode(texts) == first and not given


def test_balance_against_a_plain_search():
    """Each step takes the cheapest sequence with room, found here by looking at all."""
    rng = random.Random(6)
    for _ in range(60):
        lengths = [rng.randint(1, 150) for _ in range(rng.randint(1, 60))]
        rooms = cost_packing.rooms_for(sum(lengths), 64)
        assert sum(rooms) == sum(lengths) and all(r & (r - 1) == 0 for r in rooms)
        out, costs = cost_packing.balance(lengths, 64, 1.0, 0.5)
        assert [sum(n for _, _, n in x) for x in out] == rooms
        parts = sorted((k, s, n) for x in out for k, s, n in x)
        for k, n in enumerate(lengths):
            own = [(s, m) for j, s, m in parts if j == k]
            assert sum(m for _, m in own) == n and all(s + m == t for (s, m), (t, _) in zip(own, own[1:])) and own[0][0] == 0
        assert np.allclose(costs, [sum(n + 0.5 * n * n for _, _, n in x) for x in out])
        tree = cost_packing.Sequences([10, 20, 30])
        held = [(10, 0.0), (20, 0.0), (30, 0.0)]
        for step in range(40):
            need = rng.randint(1, 31)
            fits = [c for room, c in held if room >= need]
            found = tree.take(need)
            assert (found is None) == (not fits) and (not fits or found[1] == min(fits))
            if found:
                room, cost, which = found
                held[which] = (room - need, cost + need)
                tree.put(room - need, cost + need, which)


def test_mixing_posteriors_by_length(spark):
    """Held-out clean texts: few of their tokens count as toxic, however long the text."""
    from meridian.llm import mixing

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    seen = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(4)) > 0
    labelled = docs.join(labels.withColumn("domain", mixing.domain_of(F.col("quality"), F.col("toxic"))), "doc_id").select("doc_id", "text", "domain")
    found = mixing.posteriors(labelled, labels.where(seen)).where(~seen).drop("text").toPandas()
    likeliest = found[[f"p_{x}" for x in mixing.DOMAINS]].to_numpy().argmax(axis=1)
    assert (likeliest == found.domain).mean() > 0.93 and (likeliest == 2)[found.domain == 2].mean() > 0.75
    clean = found[found.domain == 0]
    for low, high in ((0, 20), (20, 100), (100, 500), (500, 2000), (2000, 10**9)):
        part = clean[(clean.n_tokens >= low) & (clean.n_tokens < high)]
        assert len(part) and (part.n_tokens * part.p_toxic).sum() / part.n_tokens.sum() < 0.05, (low, high)


def test_rates_stay_within_their_bounds(spark):
    from meridian.llm import mixing

    likely = [(0.99, 0.005, 0.005)] * 60 + [(0.1, 0.1, 0.8)] * 40
    rows = spark.createDataFrame([(100, *p) for p in likely], "n_tokens long, p_clean double, p_low_quality double, p_toxic double")
    two = {"clean": 0.9, "toxic": 0.1}
    got = mixing.rates(rows, two, most=1.0, anchor="clean", protect=0.5, slack=0.5).toPandas()
    assert (got.rate[got.p_clean > 0.5] == 1).all() and (got.rate <= 1).all()
    share = (got.rate * got.p_toxic).sum() / (got.rate * (got.p_toxic + got.p_clean)).sum()
    assert abs(share - 0.1) < 0.02
    with pytest.warns(RuntimeWarning):
        far = mixing.rates(rows, {"clean": 0.5, "toxic": 0.5}, most=1.0, anchor="clean", protect=0.5, slack=0.2).toPandas()
    assert (far.rate == 1).all()
    assert mixing.rates(rows, most=1.5).agg(F.max("rate")).first()[0] <= 1.5


def test_pipeline_keeps_clean_documents(spark):
    """What mixing leaves at a hundredth of the scale: no copies, hardly a clean document less, toxic ones down."""
    import corpus_pipeline
    from meridian.llm.common import materialise

    data = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    kept = materialise(corpus_pipeline.quality_rules(spark, docs, data))
    mixed = materialise(corpus_pipeline.mix_sources(spark, kept, data))
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] == 1 and mixed.columns == docs.columns
    count = lambda df, y: df.join(labels.where(f"quality = 1 and toxic = {y}"), "doc_id", "left_semi").count()
    assert count(mixed, 0) >= 0.98 * count(kept, 0) and count(mixed, 1) <= 0.5 * count(kept, 1) and mixed.count() > 0.85 * kept.count()


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_odd_rows(spark, odd, stage, tmp_path):
    """Nulls, empty and repeated texts, clashing columns and no rows at all go through every stage."""
    import corpus_pipeline

    data = str(tmp_path)
    spark.createDataFrame([(1, None), (None, "x y"), (2, "")], "item_id long, text string").write.parquet(f"{data}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 0, 1), (2, None, None), (3, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{data}/labels.parquet")
    name, run = corpus_pipeline.STAGES[stage]
    out = run(spark, odd, data)
    assert out.count() >= 0 and (stage == 4 or out.columns == odd.columns)
    assert run(spark, odd.limit(0), data).count() == 0


def test_toxicity_on_three_seeds(spark):
    """Precision and recall on held-out labels don't hang on one start."""
    import pyarrow as pa

    from meridian.llm import toxicity

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = [tuple(r) for r in toxicity.sample(docs, labels).collect()]
    judged = docs.join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"))).select("text", "toxic").toPandas()
    for seed in (1, 2, 7):
        flagged = toxicity.train(rows, 0.11, seed=seed).scores(pa.array(judged.text.fillna(""), pa.string())) >= 0.3
        assert flagged[judged.toxic == 1].mean() > 0.75 and flagged[judged.toxic == 0].mean() < 0.045


def test_toxicity_sample_has_both_labels(spark):
    from meridian.llm import toxicity

    docs = spark.createDataFrame([(k, "word " * 400) for k in range(8)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(8)], "doc_id long, toxic int")
    got = toxicity.sample(docs, labels, max_bytes=100).collect()
    assert sorted({r["toxic"] for r in got}) == [0, 1] and len(got) == 2


def test_number_tables_do_not_meet_everywhere(spark):
    """Windows that are all numbers meet by their values: tables of numbers find only their own."""
    import time

    from meridian.llm import decontamination

    rng = random.Random(8)
    numbers = lambda n: " ".join(str(rng.randint(0, 10**6)) for _ in range(n))
    items = [(k, numbers(8)) for k in range(50)]
    docs = [(k, numbers(400)) for k in range(20)] + [(99, f"{numbers(50)} {items[7][1]} {numbers(50)}")]
    left, right = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    decontamination.leaks(left.limit(1), right.limit(1)).collect()
    start = time.time()
    got = [(r["doc_id"], r["item_id"]) for r in decontamination.leaks(left, right).collect()]
    assert got == [(99, 7)] and time.time() - start < 20


def test_reparameterised_items_are_caught(spark):
    """Planted items with new names and numbers, in long texts of other words; clean texts are left alone."""
    from meridian.llm import decontamination

    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8)))
    names = ["Anna", "Bob", "Carla", "Dan", "Eva", "Finn"]

    def fill(form: list, values: dict) -> str:
        return " ".join(values.setdefault(w, new()) if isinstance(w, int) and (new := (lambda w=w: rng.choice(names) if w % 2 else str(rng.randint(2, 999)))) else w for w in form)

    forms = [[rng.randint(0, 3) if k % 5 == 3 else word() for k in range(30)] for _ in range(30)]
    items = [(k, "so " + fill(f, {0: "17", 1: "Anna", 2: "45", 3: "Bob"})) for k, f in enumerate(forms)]
    docs, planted = [], set()
    for k in range(120):
        text = [word() for _ in range(rng.randint(20, 200))]
        if k % 2:
            planted.add((k, k % 30))
            text.insert(rng.randrange(len(text)), "so " + fill(forms[k % 30], {0: "23", 1: "Eva", 2: "8", 3: "Finn"}))
        docs.append((k, " ".join(text)))
    left, right = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(left, right).collect()}
    assert got <= planted and len(got) >= 0.95 * len(planted), (len(got), len(planted))


@pytest.mark.parametrize("params", [{"shingle_words": 5, "similarity": 0.8}, {}])
def test_near_dedup_keeps_one_row_of_a_group(spark, params):
    """Copies go whatever their ids: rows that share a doc_id or have none are judged by their own texts."""
    from meridian.llm import simhash

    a, b, c, d = (" ".join(f"{x}{k * k}" for k in range(40)) for x in "abcd")
    rows = [(1, a), (7, a), (7, b), (7, b), (None, a), (None, c), (None, c + " "), (None, d), (9, d), (None, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, {"n": k}) for k, (i, t) in enumerate(rows)], "doc_id long, text string, _kept_id map<string,int>")
    got = simhash.keep_first(docs, **params)
    assert got.columns == docs.columns
    assert sorted(((r[0] or 0, (r[1] or "").strip()) for r in got.collect())) == sorted([(1, a), (7, b), (0, c), (9, d), (0, "")])
