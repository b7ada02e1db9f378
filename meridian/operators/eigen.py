"""Gains from leading eigenvectors: a distributed subspace iteration, and closed forms of two by two matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions.scalar import abs2, cinv0, cis, cmul, conj, inv0
from meridian.operators.rounds import written

#: Of a semicircle law of radius r the median distance from the median is this times r (a fixed value).
SEMICIRCLE = 0.4039727532995172
MAD = 1.4826


def _vector(k: int) -> list[str]:
    return [f"{part}{j}" for j in range(k) for part in ("x", "y")]


def _independent(gram: np.ndarray, least: float = 1e-10) -> list[int]:
    """Columns of which more than `least` is left by those before; a group of fewer inputs than vectors has others."""
    kept: list[int] = []
    for j in range(len(gram)):
        left = gram[j, j].real
        if kept:
            left -= (gram[j, kept] @ np.linalg.solve(gram[np.ix_(kept, kept)], gram[kept, j])).real
        if left > least:
            kept.append(j)
    return kept


def _turned(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of stacked k x k matrices g = W* W and h = V* W: eigenvalues of h, largest first, and the turn of W to the next basis."""
    value, u = np.linalg.eigh(h)
    value, u = value[:, ::-1], u[:, :, ::-1]
    # W = A V has Gram matrix g; its columns turned by u follow the eigenvectors, largest first.
    gram = u.conj().transpose(0, 2, 1) @ g @ u
    turn = np.zeros_like(u)
    for n in range(len(g)):  # Gram-Schmidt by Cholesky; empty directions stay empty
        size = np.sqrt(np.maximum(gram[n].diagonal().real, 0))
        live = np.flatnonzero(size > 1e-12 * max(size.max(initial=0), 1e-300))
        if len(live):
            scaled = gram[n][np.ix_(live, live)] / np.outer(size[live], size[live])
            kept = _independent(scaled)
            scaled, live = scaled[np.ix_(kept, kept)], live[kept]
            inverse = np.linalg.inv(np.linalg.cholesky(scaled + 1e-13 * np.eye(len(live)))).conj().T / size[live, None]
            turn[n][:, live] = u[n][:, live] @ inverse
    return value, turn


def _project(sums: DataFrame, group: list[str], k: int) -> DataFrame:
    """Of each group's k x k sums: eigenvalues in the subspace and the matrix that makes the next basis orthonormal."""
    kinds = ", ".join(f"{g} {sums.schema[g].dataType.simpleString()}" for g in group)
    turn = ", ".join(f"t{i}{j}{p} double" for i in range(k) for j in range(k) for p in "xy")
    values = ", ".join(f"value{j} double" for j in range(k))

    def matrix(frame: pd.DataFrame, name: str) -> np.ndarray:
        m = np.zeros((len(frame), k, k), complex)
        for i in range(k):
            for j in range(k):
                m[:, i, j] = frame[f"{name}{i}{j}x"] + 1j * frame[f"{name}{i}{j}y"]
        return (m + m.conj().transpose(0, 2, 1)) / 2

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            g, h = matrix(frame, "g"), matrix(frame, "h")
            value, turn = _turned(g, h)
            out = frame[group].copy()
            for j in range(k):
                out[f"value{j}"] = value[:, j]
            for i in range(k):
                for j in range(k):
                    out[f"t{i}{j}x"], out[f"t{i}{j}y"] = turn[:, i, j].real, turn[:, i, j].imag
            yield out

    return sums.mapInPandas(solve, f"{kinds}, {values}, {turn}")


def _by_joins(upper: DataFrame, group: list[str], k: int, replacements: int, steps: int) -> DataFrame:
    """The basis that leading_gain() iterates to, each step a join of the products with it."""
    key = [*group, "input_id"]
    # Both triangles, by the input that a product's row belongs to.
    edges = written(upper.unionByName(upper.select(*group, F.col("input_b").alias("input_a"), F.col("input_a").alias("input_b"), "re", (-F.col("im")).alias("im"))))
    inputs = written(edges.select(*group, F.col("input_a").alias("input_id")).distinct())

    # A start that no gain pattern is likely to be orthogonal to, the same in every run.
    phase = lambda j: F.lit(float(j)) * (F.col("input_id") * 2.399963 + 0.7 * j)
    sizes = edges.groupBy(*group).agg(F.sum(F.col("re") ** 2 + F.col("im") ** 2).alias("squares"), F.countDistinct("input_a").alias("n"))
    basis = inputs.join(sizes, group).select(*key, *(c.alias(n) for j in range(k) for n, c in zip((f"x{j}", f"y{j}"), cis(phase(j)))), F.lit(0.0).alias("fill"), "squares", "n", F.lit(0.0).alias("value0"))
    total = lambda e, n: F.sum(e).alias(n)
    carried = ("fill", "squares", "n")

    def multiplied(basis: DataFrame) -> DataFrame:
        """basis with p, q: A V, the filled diagonal and a shift included."""
        near = basis.select(*group, F.col("input_id").alias("input_b"), *_vector(k))
        met = edges.join(near, [*group, "input_b"])
        parts = []
        for j in range(k):
            re, im = cmul((F.col("re"), F.col("im")), (F.col(f"x{j}"), F.col(f"y{j}")))
            parts += [total(re, f"p{j}"), total(im, f"q{j}")]
        sums = met.groupBy(*group, F.col("input_a").alias("input_id")).agg(*parts)
        # What value0 leaves has eigenvalues of both signs; shifted by their radius the largest come first.
        shift = 2 * F.sqrt(F.greatest(F.col("squares") - F.col("value0") ** 2 * (1 - 1 / F.col("n")), F.lit(0.0)) / F.col("n"))
        fill = lambda n, v, j: (F.col(f"{n}{j}") + (F.col("fill") + F.col("shift")) * F.col(f"{v}{j}")).alias(f"{n}{j}")
        return basis.withColumn("shift", shift).join(sums, key).select(*key, *carried, "shift", *_vector(k), *(c for j in range(k) for c in (fill("p", "x", j), fill("q", "y", j))))

    def projected(rows: DataFrame) -> DataFrame:
        """The next basis: A V turned to the eigenvectors and made orthonormal, beside the eigenvalues."""
        parts = []
        for i in range(k):
            for j in range(k):
                v, w, o = (F.col(f"x{i}"), F.col(f"y{i}")), (F.col(f"p{j}"), F.col(f"q{j}")), (F.col(f"p{i}"), F.col(f"q{i}"))
                for n, left in (("h", v), ("g", o)):
                    re, im = cmul(conj(left), w)
                    parts += [total(re, f"{n}{i}{j}x"), total(im, f"{n}{i}{j}y")]
        solved = _project(rows.groupBy(*group).agg(*parts), group, k)
        out = []
        for j in range(k):
            terms = [cmul((F.col(f"p{i}"), F.col(f"q{i}")), (F.col(f"t{i}{j}x"), F.col(f"t{i}{j}y"))) for i in range(k)]
            out += [sum((t[0] for t in terms), F.lit(0.0)).alias(f"x{j}"), sum((t[1] for t in terms), F.lit(0.0)).alias(f"y{j}")]
        return rows.join(solved, group).select(*key, *carried, *out, *((F.col(f"value{j}") - F.col("shift")).alias(f"value{j}") for j in range(k)))

    for turn in range(replacements + 1):
        for _ in range(steps if turn else 3 * steps):
            basis = projected(written(multiplied(basis)))
        if turn < replacements:
            basis = basis.withColumn("fill", F.greatest(F.col("value0"), F.lit(0.0)) * abs2((F.col("x0"), F.col("y0"))))
    return basis.select(*key, *_vector(k), *carried, *(f"value{j}" for j in range(k)))


def _in_place(upper: DataFrame, group: list[str], k: int, replacements: int, steps: int, deals: int) -> DataFrame:
    """The basis that leading_gain() iterates to, of groups with few products: many groups a task, edges in memory."""
    kinds = ", ".join(f"{c} {upper.schema[c].dataType.simpleString()}" for c in group)
    kinds += f", input_id {upper.schema['input_a'].dataType.simpleString()}, " + ", ".join(f"{v} double" for v in _vector(k))
    numbers = ("fill", "squares", "n")

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        re, im = frame["re"].fillna(0.0).to_numpy(float), frame["im"].fillna(0.0).to_numpy(float)
        own = frame.groupby(group, dropna=False).ngroup().to_numpy()
        a, b = frame["input_a"].to_numpy(), frame["input_b"].to_numpy()
        # Rows are both triangles' entries; nodes are inputs of groups, in order of group.
        row, col, of, value = np.r_[a, b], np.r_[b, a], np.r_[own, own], np.r_[re + 1j * im, re - 1j * im]
        nodes = pd.MultiIndex.from_arrays([of, row])
        index = nodes.unique().sort_values()
        at, to = index.get_indexer(nodes), index.get_indexer(pd.MultiIndex.from_arrays([of, col]))
        order = np.argsort(at, kind="stable")
        at, to, of, value = at[order], to[order], of[order], value[order, None]
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        group_of, inputs = index.get_level_values(0).to_numpy(), index.get_level_values(1).to_numpy()
        heads = np.flatnonzero(np.r_[True, group_of[1:] != group_of[:-1]])
        sizes = np.diff(np.r_[heads, len(group_of)])
        squares = np.bincount(of, (np.abs(value[:, 0]) ** 2), minlength=len(heads))
        v = np.exp(1j * np.arange(k) * (inputs[:, None] * 2.399963 + 0.7 * np.arange(k)))
        fill, first = np.zeros(len(v)), np.zeros(len(heads))
        for turn_no in range(replacements + 1):
            for _ in range(steps if turn_no else 3 * steps):
                shift = 2 * np.sqrt(np.maximum(squares - first**2 * (1 - 1 / sizes), 0) / sizes)
                w = np.add.reduceat(value * v[to], starts, axis=0) + (fill + shift[group_of])[:, None] * v
                outer = lambda x: np.add.reduceat(x.conj()[:, :, None] * w[:, None, :], heads, axis=0)  # noqa: B023, E731
                g, h = outer(w), outer(v)
                values, turn = _turned((g + g.conj().transpose(0, 2, 1)) / 2, (h + h.conj().transpose(0, 2, 1)) / 2)
                v = np.einsum("ni,nij->nj", w, turn[group_of])
                values = values - shift[:, None]
                first = values[:, 0]
            if turn_no < replacements:
                fill = np.maximum(first, 0)[group_of] * np.abs(v[:, 0]) ** 2
        out = frame[group].iloc[np.unique(own, return_index=True)[1]].iloc[group_of].reset_index(drop=True)
        out["input_id"] = inputs
        for j in range(k):
            out[f"x{j}"], out[f"y{j}"] = v[:, j].real, v[:, j].imag
        out["fill"], out["squares"], out["n"] = fill, squares[group_of], sizes[group_of]
        for j in range(k):
            out[f"value{j}"] = values[group_of, j]
        return out

    kinds += f", {numbers[0]} double, {numbers[1]} double, {numbers[2]} long, " + ", ".join(f"value{j} double" for j in range(k))
    dealt = upper.withColumn("_deal", F.pmod(F.xxhash64(*group), F.lit(deals)))
    return dealt.groupBy("_deal").applyInPandas(solve, kinds)


def leading_gain(
    products: DataFrame, group: list[str], norm: str | DataFrame = "auto", reference: int | None = None, replacements: int = 5, steps: int = 2, width: int = 4, in_place: int = 1 << 16,
) -> DataFrame:
    """group, input_id, re, im, error, value1, value2, dynamic_range: gains of all groups (freq, t) at once.

    products (group, input_a <= input_b, re, im) are Hermitian matrices with autocorrelations. They are scaled by
    `norm` ("auto": one over the root of the autos, "none", or a table group, input_id, norm); the diagonal is left
    out and replaced by the leading eigenvector's, `replacements` times. A basis of `width` vectors a group goes
    through `steps` products with the matrix between replacements, each one a join with the products and a sum, and
    a width x width solve of the group's sums; no task holds the matrix of a group of more than `in_place` products.
    Smaller groups take the same steps in memory, many of them in a task, and are shuffled once instead of each step. The gain is the scaled-back leading
    eigenvector times the root of its eigenvalue, turned so that the first input's (or divided by the gain of
    `reference`, which may be a noise channel) is real and positive. dynamic_range is value1 / value2; error is the
    scatter of the other eigenvalues, taken from the summed squares that the two leading ones leave: noise alone
    has a semicircle of eigenvalues, whose MAD is known from that sum. Groups without signal, with a leading value
    that is not positive, or with values that are not finite have zeros.
    """
    key = [*group, "input_id"]
    autos = products.where("input_a = input_b").select(*group, F.col("input_a").alias("input_id"), F.col("re").alias("auto"))
    if isinstance(norm, DataFrame):
        norms = norm.select(*key, "norm")
    elif norm == "auto":
        norms = autos.select(*key, inv0(F.sqrt(F.greatest("auto", F.lit(0.0)))).alias("norm"))
    elif norm == "none":
        norms = autos.select(*key, F.lit(1.0).alias("norm"))
    else:
        raise ValueError(f"unknown norm {norm!r}")
    side = lambda x: norms.select(*group, F.col("input_id").alias(f"input_{x}"), F.col("norm").alias(f"_n{x}"))
    scaled = products.where("input_a <> input_b").join(side("a"), [*group, "input_a"]).join(side("b"), [*group, "input_b"])
    scale = F.col("_na") * F.col("_nb")
    upper = scaled.select(*group, "input_a", "input_b", (F.col("re") * scale).alias("re"), (F.col("im") * scale).alias("im"))
    bad = F.isnan("re") | F.isnan("im") | (F.abs("re") == float("inf")) | (F.abs("im") == float("inf"))
    upper = upper.join(upper.where(bad).select(*group).distinct(), group, "left_anti")
    upper = written(upper)
    counts = upper.groupBy(*group).agg(F.count("*").alias("_products"))
    little, large = counts.agg(F.sum(F.when(F.col("_products") <= in_place, F.col("_products"))), F.count(F.when(F.col("_products") > in_place, 1))).first()
    if large:
        few = counts.where(F.col("_products") <= in_place).select(*group)
        small, upper = upper.join(few, group, "left_semi"), upper.join(few, group, "left_anti")
    else:
        small = upper
    basis = _in_place(small, group, width, replacements, steps, max(1, (little or 0) // 50_000))
    if large:
        basis = basis.unionByName(_by_joins(upper, group, width, replacements, steps))
    basis = written(basis)

    # The last basis holds the eigenvectors to the precision of the iteration; its values are those of one product before.
    filled = basis.groupBy(*group).agg(F.sum(F.col("fill") ** 2).alias("_filled"))
    rows = basis.join(filled, group)
    left = F.greatest(F.col("squares") + F.col("_filled") - F.col("value0") ** 2, F.lit(0.0))
    scatter = SEMICIRCLE * 2 * F.sqrt(left / F.greatest(F.col("n") - 1, F.lit(1)))
    rows = rows.join(norms, key).withColumns({"_back": inv0(F.col("norm")), "_root": F.sqrt(F.greatest("value0", F.lit(0.0)))})
    rows = rows.withColumns({"_re": F.col("_back") * F.col("_root") * F.col("x0"), "_im": F.col("_back") * F.col("_root") * F.col("y0")})
    first = F.struct(F.col("_re").alias("re"), F.col("_im").alias("im"))
    chosen = F.col("input_id") if reference is None else F.when(F.col("input_id") == reference, F.col("input_id"))
    against = rows.groupBy(*group).agg(F.min_by(first, F.when((F.col("_re") != 0) | (F.col("_im") != 0), chosen)).alias("_first"))
    size = F.sqrt(abs2((F.col("_first.re"), F.col("_first.im"))))
    to = (F.col("_first.re") * inv0(size), F.col("_first.im") * inv0(size)) if reference is None else (F.col("_first.re"), F.col("_first.im"))
    turned = cmul((F.col("_re"), F.col("_im")), cinv0(to))
    fine = (F.col("value0") > 0) & F.col("_first").isNotNull()
    or_zero = lambda c: F.when(fine, c).otherwise(0.0)
    error = F.col("_back") * MAD * scatter * inv0(F.col("_root"))
    if reference is not None:
        error = error * inv0(size)
    return rows.join(against, group).select(
        *key, or_zero(turned[0]).alias("re"), or_zero(turned[1]).alias("im"), or_zero(error).alias("error"),
        or_zero(F.col("value0")).alias("value1"), or_zero(F.col("value1")).alias("value2"),
        or_zero(F.when(F.col("value1") > 0, F.col("value0") * inv0(F.col("value1"))).otherwise(0.0)).alias("dynamic_range"),
    )


def _leading_pair(a: Column, d: Column, b: tuple[Column, Column]) -> tuple[Column, tuple[Column, Column], Column]:
    """Of the Hermitian [[a, b], [b*, d]] the larger eigenvalue and its unit eigenvector (complex first, real second
    entry turned so that the first is real and not negative): value, second entry, first entry."""
    half = (a - d) / 2
    value = (a + d) / 2 + F.sqrt(half * half + abs2(b))
    # (value - d, b*) is well away from zero where a >= d, (b, value - a) where not.
    upper, lower = value - d, value - a
    size_u, size_l = inv0(F.sqrt(upper * upper + abs2(b))), inv0(F.sqrt(lower * lower + abs2(b)))
    by_b = F.sqrt(abs2(b))
    first = F.when(a >= d, F.when(upper == 0, 1.0).otherwise(upper * size_u)).otherwise(by_b * size_l)
    # In the second form b is turned real: (|b|, (value - a) b* / |b|).
    turned = lambda c: F.when(by_b == 0, 1.0 if c is b[0] else 0.0).otherwise((c if c is b[0] else -c) * inv0(by_b))
    second = tuple(F.when(a >= d, (c if c is b[0] else -c) * size_u).otherwise(lower * size_l * turned(c)) for c in b)
    return value, second, first


def eigen_gains(
    vectors: DataFrame, values: DataFrame, inputs: DataFrame, reference: dict[str, int], eigen_reference: int, off_source: Column, mask: Column, mhz: Column, flux: Column,
    ha: Column, dec: float, latitude: float, threshold: float = 3.0,
) -> DataFrame:
    """freq_id, t, input_id, pol, re, im, w: responses of each polarisation to a calibrator, from two eigenvectors.

    vectors (freq_id, t, input_id, re1, im1, re2, im2, auto, w), values (freq_id, t, value1 >= value2, rms), inputs
    (input_id, pol, x, y in metres). An entry counts where the decomposition converged (rms > 0), value2 is over
    `threshold` times the channel's median of value1 off the source, `mask` is false, and the input has weight.
    Eigenvectors are turned so that eigen_reference is not negative, scaled by the roots of their values and split by
    polarisation: sums over its inputs give a Hermitian 2 x 2 matrix, whose leading eigenpair in closed form is the
    response to one polarisation. Phases are then those against the polarisation's `reference` input, stopped at the
    source (hour angle ha, declination and latitude in radians) and divided by the root of the flux. No group is ever
    held by a task: all is joins, sums and expressions.
    """
    base = values.groupBy("freq_id").agg(F.percentile(F.when(off_source, F.col("value1")), F.lit(0.5)).alias("_off"))
    alive = values.join(base, "freq_id", "left").withColumn("_good", (F.col("rms") > 0) & (F.col("value2") * inv0(F.coalesce("_off", F.lit(0.0))) > threshold) & ~mask)
    signs = vectors.where(F.col("input_id") == eigen_reference).select("freq_id", "t", *(F.when(F.col(f"re{n}") < 0, -1.0).otherwise(1.0).alias(f"_s{n}") for n in (1, 2)))
    rows = vectors.join(inputs, "input_id").join(alive, ["freq_id", "t"]).join(signs, ["freq_id", "t"], "left")
    root = lambda n: F.coalesce(F.col(f"_s{n}"), F.lit(1.0)) * F.sqrt(F.greatest(F.col(f"value{n}"), F.lit(0.0)))
    rows = rows.withColumns({f"_{part}{n}": F.col(f"{part}{n}") * root(n) for n in (1, 2) for part in ("re", "im")})
    u = {n: (F.col(f"_re{n}"), F.col(f"_im{n}")) for n in (1, 2)}
    key = ["freq_id", "t", "pol"]
    cross = cmul(conj(u[1]), u[2])
    sums = rows.groupBy(*key).agg(F.sum(abs2(u[1])).alias("_a"), F.sum(abs2(u[2])).alias("_d"), F.sum(cross[0]).alias("_br"), F.sum(cross[1]).alias("_bi"))
    value, second, first = _leading_pair(F.col("_a"), F.col("_d"), (F.col("_br"), F.col("_bi")))
    pairs = sums.select(*key, value.alias("_mu"), first.alias("_v1"), second[0].alias("_v2r"), second[1].alias("_v2i"))
    met = rows.join(pairs, key)
    one = tuple(c * F.col("_v1") * inv0(F.col("value1")) for c in u[1])
    two = tuple(c * inv0(F.col("value2")) for c in cmul(u[2], (F.col("_v2r"), F.col("_v2i"))))
    resp = tuple(F.col("_mu") * (p + q) for p, q in zip(one, two))
    met = met.withColumns({"_rr": resp[0], "_ri": resp[1]})
    at = F.create_map(*(F.lit(x) for pair in reference.items() for x in pair))[F.col("pol")]
    refs = met.where(F.col("input_id") == at).select(*key, F.col("_rr").alias("_fr"), F.col("_ri").alias("_fi"), F.col("x").alias("_fx"), F.col("y").alias("_fy"))
    met = met.join(refs, key)
    size = F.sqrt(abs2((F.col("_fr"), F.col("_fi"))))
    against = (F.col("_fr") * inv0(size), -F.col("_fi") * inv0(size))
    wave = 299.792458 / mhz
    eu, ev = (F.col("x") - F.col("_fx")) / wave, (F.col("y") - F.col("_fy")) / wave
    sin, cos = F.sin(F.lit(dec)), F.cos(F.lit(dec))
    phase = 2 * F.pi() * (cos * F.sin(ha) * -eu + (F.cos(F.lit(latitude)) * sin - F.sin(F.lit(latitude)) * cos * F.cos(ha)) * ev)
    stopped = cmul(cmul((F.col("_rr"), F.col("_ri")), against), cis(phase))
    scale = inv0(F.sqrt(flux))
    fine = F.col("_good") & (abs2((F.col("_rr"), F.col("_ri"))) > 0) & (F.col("w") > 0)
    error = F.col("rms") * F.sqrt(F.greatest("auto", F.lit(0.0))) * inv0(F.sqrt(F.col("_mu"))) * scale
    return met.select("freq_id", "t", "input_id", "pol", (stopped[0] * scale).alias("re"), (stopped[1] * scale).alias("im"), F.when(fine, inv0(error * error)).otherwise(0.0).alias("w"))
