"""Line deduplication as a segment-partition edit join, in DataFrame operations alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.llm.common import NO_ID, materialise, text_of, unused

#: Characters whose parities of occurrence sift pairs: one edit changes two at most.
SIFT = " etaonirshdlucmfwgybpvkzj,."


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, line, h1, h2 (128 bits that stand for the line) of every \\n-separated line of docs.

    A null or empty text is one empty line.
    """
    rows = docs.select("doc_id", F.posexplode(F.split(text_of(), "\n")).alias("line_no", "line"))
    return rows.select("doc_id", "line_no", "line", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def allowed(length: Column, edits: int, per: int) -> Column:
    """Edits at which a line counts as near one of some length or more: one for each `per` characters, `edits` at most."""
    return F.least(F.floor(length / per), F.lit(edits)).cast("int")


def segment_keys(rows: DataFrame, edits: int, per: int, exact: bool = False) -> DataFrame:
    """rows (line, length) once for each of a few keys (four for 2 edits, some more for one line in many), of which
    lines that are near each other share one at least.

    Lengths count by classes, an eighth to a quarter of the length wide; a line has the keys of its own class and of
    those that shorter lines near it have. By the least length of a class and its edits e a line has e + 1 segments,
    half of them (`nth`, from 0) counted from its start and half from its end. Of lines that e edits part one segment
    stays whole that has nth edits on its near side, so it moves by nth at most: it is nth longer than a key's text,
    and a key begins at each of its first nth + 1 characters; one of the two lines has that text where its segment
    starts. exact: each key once for each length of the shorter line, as `fine`; the line `own`s those of its length.
    """
    least = lambda n: n - F.pmod(n, F.call_function("shiftleft", F.lit(1), F.greatest(F.floor(F.log2(n)).cast("int") - 2, F.lit(0))))
    length, d, e, size = F.col("length"), F.col("_d"), F.col("_e"), F.col("_size")
    shorter = F.array(*(F.lit(k) for k in range(edits + 1)))
    if not exact:
        one_class = (length - edits >= per * edits) & (least(length) == least(length - edits))
        shorter = F.when(one_class, F.array(F.lit(0))).otherwise(shorter)
    # Not explode(): Spark would first test that arrays are not empty, all keys spelt out once more, past what the JVM compiles.
    rows = rows.select("*", F.explode_outer(shorter).alias("_d"))
    rows = rows.withColumn("_least", least(length - d)).withColumn("_e", allowed(length - d, edits, per)).where((e >= 1) & (d <= e))
    rows = rows.withColumn("_size", F.greatest(F.floor((F.col("_least") - F.floor(e * e / 4)) / (e + 1)).cast("int"), F.lit(0)))

    def key(nth: int, begin: int, from_end: bool) -> Column:
        at = size * nth + (nth * (nth - 1) // 2 + begin)
        text = F.substring("line", (length - at - size if from_end else at) + 1, size)
        return F.when(e >= 2 * nth + from_end, F.xxhash64(F.lit(2 * nth + from_end), "_least", "_e", text))

    spots = [(nth, begin, end) for end in (False, True) for nth in range((edits - end) // 2 + 1) for begin in range(nth + 1)]
    rows = rows.withColumn("_keys", F.array(*(key(*x) for x in spots))).select("*", F.explode_outer("_keys").alias("key")).where("key is not null")
    if exact:
        rows = rows.withColumn("own", d == 0).withColumn("fine", F.xxhash64("key", length - d))
    return rows.drop("_d", "_least", "_e", "_size", "_keys")


def parities(line: Column) -> Column:
    """A bit for each character of SIFT: whether it occurs an odd number of times."""
    number = lambda c: F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c), F.lit("")))
    return reduce(lambda a, b: a.bitwiseOR(b), (F.shiftleft(number(c).bitwiseAND(1), k) for k, c in enumerate(SIFT)))


def pair_parities(line: Column) -> Column:
    """64 bits: how often pairs of neighbouring characters that hash to a bit occur, odd or not. One edit takes two
    pairs away and adds two at most."""
    flip = lambda bits, a, b: bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(a, b), F.lit(64)).cast("int")))
    start = F.struct(F.lit("").alias("last"), F.lit(0).cast("long").alias("bits"))
    step = lambda state, c: F.struct(c.alias("last"), flip(state["bits"], state["last"], c).alias("bits"))
    return F.aggregate(F.split(line, ""), start, step, lambda state: state["bits"])


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def banded_distance(a: Column, b: Column, edits: int) -> Column:
    """Edit distance of strings a and b if it is at most `edits`, else null.

    A band of 2 * edits + 1 cells round the diagonal is held as two bit words, the vertical differences of +1 and
    of -1, and moves down one row for each character of b. Its lowest cell lies on a diagonal, along which the
    distance grows or stays; once that leaves the table the last row is followed. Strings must be longer than
    `edits`; lengths that differ by more give null.
    """
    width = 2 * edits + 1
    every = (1 << width) - 1
    n, m = F.length(a), F.length(b)

    def merge(chars_a: Column):
        def step(state: Column, at: Column) -> Column:
            hit = lambda i: F.when(F.get(chars_a, at["j"] - edits + i).eqNullSafe(at["c"]), 1 << i).otherwise(0)
            equal = reduce(lambda x, y: x.bitwiseOR(y), (hit(i) for i in range(width)))
            vp, vn = state["vp"], state["vn"]
            flat = lambda eq: (((eq.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(eq).bitwiseOR(vn)).bitwiseAND(F.lit(every))

            def next_state(d0: Column) -> Column:
                hp = vn.bitwiseOR(d0.bitwiseOR(vp).bitwiseXOR(F.lit(every)))
                hn = d0.bitwiseAND(vp)
                low = at["j"] + edits  # the band's lowest row, from 0
                edge = F.greatest(F.lit(2 * edits - 1) - (low - n), F.lit(0))
                along = F.when(F.getbit(d0.cast("long"), F.lit(2 * edits)) == 0, 1).otherwise(0)
                across = F.getbit(hp.cast("long"), edge).cast("int") - F.getbit(hn.cast("long"), edge).cast("int")
                moved = F.shiftright(d0, 1)
                new_vp = hn.bitwiseOR(moved.bitwiseOR(hp).bitwiseXOR(F.lit(every)))
                score = state["score"] + F.when(low < n, along).otherwise(across)
                return F.struct(new_vp.alias("vp"), moved.bitwiseAND(hp).alias("vn"), score.alias("score"))

            return _let(equal, lambda eq: _let(flat(eq), next_state))

        return step

    start = F.struct(F.lit((every << edits) & every).alias("vp"), F.lit(0).alias("vn"), F.lit(edits).alias("score"))
    cells = F.transform(F.split(b, ""), lambda c, j: F.struct(c.alias("c"), j.alias("j")))
    distance = _let(F.split(a, ""), lambda chars: F.aggregate(cells, start, merge(chars))["score"])
    return F.when((F.abs(n - m) <= edits) & (distance <= edits), distance)


def _at_shared_keys(lines: DataFrame, edits: int, per: int, max_broadcast: int) -> tuple[DataFrame, DataFrame]:
    """The distinct lines of lines (line, h1, h2, doc_id, line_no) that share a key with a different one, so all that
    are near another: line, h1, h2, place (of their first), p, q (their parities); and their fine keys that another
    one has: key, h (h1), own, place, p, q.

    Equal lines give equal keys, which partial aggregation merges before the one shuffle of all keys; a common key
    costs one row per task.
    """
    few = lambda keys: keys.limit(max_broadcast + 1).count() <= max_broadcast
    length, ends = F.length("line"), (F.min("h1").alias("low"), F.max("h1").alias("high"))
    long = lines.where(length >= per).withColumn("length", length)
    keyed = segment_keys(long, edits, per)
    keys = materialise(keyed.groupBy("key").agg(*ends).where("low <> high").select("key"))
    small = F.broadcast(keys) if few(keys) else keys
    if small is keys:  # too many for every task: lines go through the shuffle once, not at each of their keys
        ids = keyed.select("h1", "key").join(keys, "key", "left_semi").select("h1").distinct()
        found = long.join(materialise(ids), "h1", "left_semi")
    else:
        found = keyed.join(small, "key", "left_semi")
    found = materialise(found.withColumn("place", _place()).groupBy("h1", "h2", "line").agg(F.min("place").alias("place")))
    fine = segment_keys(found.select("line", length.alias("length"), "h1"), edits, per, exact=True).join(small, "key", "left_semi")
    held = materialise(fine.groupBy(F.col("fine").alias("key"), "h1").agg(F.max("own").alias("own")))
    # A key stands for a segment of one of two lines, so one of them must own it.
    keys = materialise(held.groupBy("key").agg(*ends, F.max("own").alias("owned")).where("low <> high AND owned").select("key"))
    held = held.join(F.broadcast(keys) if few(keys) else keys, "key", "left_semi")
    texts = found.join(held.select("h1").distinct(), "h1", "left_semi")
    texts = materialise(texts.withColumn("p", parities(F.col("line"))).withColumn("q", pair_parities(F.col("line"))))
    held = held.join(texts.select("h1", "place", "p", "q"), "h1").withColumnRenamed("h1", "h")
    return texts, materialise(held)


def _near_earlier(pairs: DataFrame, texts: DataFrame, edits: int, per: int) -> DataFrame:
    """h1, h2 of the lines b of pairs (a, b), by h1, that are near their a."""
    pairs = materialise(pairs.distinct())
    side = lambda x: texts.select(F.col("h1").alias(x), F.col("h2").alias(f"{x}2"), F.col("line").alias(f"{x}_line"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    most = allowed(F.least(F.length("a_line"), F.length("b_line")), edits, per)
    return materialise(both.where(banded_distance(F.col("a_line"), F.col("b_line"), edits) <= most).select(F.col("b").alias("h1"), F.col("b2").alias("h2")).distinct())


def _place() -> Column:
    """What lines are ordered by: doc_id, nulls last, then line_no."""
    no_id = F.lit(str(NO_ID + 1)).cast("decimal(20,0)")
    place = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), no_id) * F.lit(1 << 31).cast("decimal(10,0)") + F.col("line_no")
    return place.cast("decimal(31,0)")


def near_lines(lines: DataFrame, edits: int = 2, per: int = 10, max_broadcast: int = 500_000) -> DataFrame:
    """(h1, h2) of the distinct lines that come after another line within allowed() edits of theirs.

    lines: line, h1, h2, doc_id, line_no. Counting first tells which keys different lines share, without making pairs.
    The lines at such a key (found by a broadcast of these keys if there are max_broadcast at most) are few; those that
    also share one with their exact length are first compared with the earliest line there alone. A line once found
    near an earlier one needs no other; the rest meet at each key in pairs, but for those that parities of characters
    or of character pairs show to be too far apart, and are verified. So a group of near copies of its earliest line
    costs no square.
    """
    texts, held = _at_shared_keys(lines, edits, per, max_broadcast)
    part = ("place", "h", "p", "q")
    side = lambda x: held.select("key", *(F.col(c).alias(f"{c}_{x}") for c in (*part, "own")))
    apart = lambda c: F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b")))
    near = (F.struct("place_a", "h_a") < F.struct("place_b", "h_b")) & (apart("p") <= 2 * edits) & (apart("q") <= 4 * edits)
    one = F.struct(*part)
    first = held.groupBy("key").agg(F.min(F.when(F.col("own"), one)).alias("own_first"), F.min(one).alias("any_first"))
    met = side("b").join(first, "key").select("*", F.explode(F.array("own_first", F.when(F.col("own_b"), F.col("any_first")))).alias("_a"))
    met = met.where("_a is not null").select("*", *(F.col(f"_a.{c}").alias(f"{c}_a") for c in part)).where(near)
    settled = _near_earlier(met.select(F.col("h_a").alias("a"), F.col("h_b").alias("b")), texts, edits, per)
    rest = side("b").join(settled.select(F.col("h1").alias("h_b")).distinct(), "h_b", "left_anti")
    met = rest.join(side("a"), "key").where(near & (F.col("own_a") | F.col("own_b")))
    return settled.union(_near_earlier(met.select(F.col("h_a").alias("a"), F.col("h_b").alias("b")), texts, edits, per))


def _removals(docs: DataFrame, edits: int, per: int, most_hot: int = 2000) -> DataFrame:
    """doc_id, n_lines, gone (array of line_no, h1: what goes) for every doc_id of docs."""
    lines = lines_of(docs)
    lines = lines.withColumn("place", _place())
    firsts = materialise(lines.groupBy("h1", "h2").agg(F.min("place").alias("first"), F.count("*").alias("n")))
    near = near_lines(lines, edits, per).distinct().withColumn("near", F.lit(True))
    marks = firsts.join(near, ["h1", "h2"], "left").where("near OR n > 1")
    marks = materialise(marks.select("h1", "h2", "n", F.when(F.col("near").isNull(), F.col("first")).alias("first")))
    # Lines that make up more than one in most_hot of all are most_hot at most; their marks go to every task.
    often = (firsts.agg(F.sum("n")).first()[0] or 0) / most_hot
    hot = marks.where(F.col("n") > often).select("h1", "h2", F.struct("first").alias("hot"))
    rows = lines.select("doc_id", "line_no", "h1", "h2", "place").join(F.broadcast(hot), ["h1", "h2"], "left")
    # Their rows are dealt out by place, to meet no mark in the join.
    rows = rows.withColumn("k1", F.when(F.col("hot").isNull(), F.col("h1")).otherwise(F.xxhash64("place")))
    rows = rows.join(marks.where(F.col("n") <= often).select(F.col("h1").alias("k1"), "h2", F.struct("first").alias("cold")), ["k1", "h2"], "left")
    mark = F.coalesce("hot", "cold")
    again = mark.isNotNull() & (mark["first"].isNull() | (F.col("place") != mark["first"]))
    gone = F.when(again, F.struct("line_no", "h1"))
    return rows.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sort_array(F.collect_list(gone)).alias("gone"))


def repeated_lines(docs: DataFrame, edits: int = 2, per: int = 10) -> DataFrame:
    """doc_id, n_lines, n_removed, removed_lines (sorted numbers from 0) for every doc_id of docs (doc_id, text).

    A line goes if an equal or a near line comes before it: in a smaller doc_id, or earlier in the document. Near
    are lines within one edit for each `per` characters of the shorter, `edits` edits at most; so a line under
    `per` characters goes only if equal to an earlier one. Lines are judged on the input: what goes still stands
    for those after it. A null or empty text is one empty line; a null doc_id comes after all others. Rows of one
    doc_id are one document whose lines bear their numbers in their row; equal lines at one number of one doc_id
    share a place, so neither goes for the other. An empty table gives no rows; other columns don't matter.
    """
    found = _removals(docs, edits, per)
    return found.select("doc_id", "n_lines", F.size("gone").cast("long").alias("n_removed"), F.col("gone.line_no").alias("removed_lines"))


def drop_repeated_lines(docs: DataFrame, edits: int = 2, per: int = 10) -> DataFrame:
    """docs, all columns, with every line that repeated_lines() names taken out of the text.

    Of rows that share a doc_id each loses its own lines only. A null text stays null; a text of which all lines go
    is empty.
    """
    key, gone = unused(docs, "_id"), unused(docs, "_gone")
    found = _removals(docs, edits, per).where(F.size("gone") > 0).select(F.col("doc_id").alias(key), F.col("gone").alias(gone))
    joined = docs.join(found, docs["doc_id"].eqNullSafe(found[key]), "left")
    # Lines by number and hash as strings, so that array_except() looks them up instead of comparing each with all.
    lines = F.split("text", "\n")
    name = lambda number, h1: F.concat(number.cast("string"), F.lit(":"), h1.cast("string"))
    names = F.transform(lines, lambda x, k: name(k, F.xxhash64(x)))
    kept = F.array_except(names, F.transform(F.col(gone), lambda g: name(g["line_no"], g["h1"])))
    kept = F.transform(kept, lambda n: F.get(lines, F.substring_index(n, ":", 1).cast("int")))
    text = F.when(F.col("text").isNotNull() & F.col(gone).isNotNull(), F.array_join(kept, "\n")).otherwise(F.col("text"))
    return joined.withColumn("text", text).select(*docs.columns)
