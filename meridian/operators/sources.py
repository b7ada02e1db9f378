"""Amplitudes of any number of sources in visibilities, point-like or extended, and their removal."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions.scalar import abs2, cmul, conj
from meridian.operators.rounds import written

Complex = tuple[Column, Column]


def _sum(terms: Sequence[Complex]) -> Complex:
    re, im = F.lit(0.0), F.lit(0.0)
    for a, b in terms:
        re, im = re + a, im + b
    return re, im


def solve_templates(df: DataFrame, group: list[str], templates: Sequence[Complex], rcond: float = 1e-12) -> DataFrame:
    """group, a_re, a_im (arrays by template): complex amplitudes that leave the least w |v - sum a_s S_s|^2 in (re,
    im, w), for any number of templates. One aggregate makes the normal equations; only their small matrices are
    solved in Python. Templates that can't be told apart share the amplitude of least norm; a group of no weight has
    zeros."""
    k = len(templates)
    named = df.select(*group, "re", "im", F.coalesce("w", F.lit(0.0)).alias("w"), *(c.alias(f"_{p}{i}") for i, s in enumerate(templates) for p, c in zip("xy", s)))
    s = [(F.col(f"_x{i}"), F.col(f"_y{i}")) for i in range(k)]
    sums = []
    for i in range(k):
        for j in range(i, k):
            re, im = cmul(conj(s[i]), s[j])
            sums += [F.sum(F.col("w") * re).alias(f"g{i}_{j}x"), F.sum(F.col("w") * im).alias(f"g{i}_{j}y")]
        re, im = cmul(conj(s[i]), (F.col("re"), F.col("im")))
        sums += [F.sum(F.col("w") * re).alias(f"h{i}x"), F.sum(F.col("w") * im).alias(f"h{i}y")]

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            g, h = np.zeros((len(frame), k, k), complex), np.zeros((len(frame), k), complex)
            for i in range(k):
                h[:, i] = frame[f"h{i}x"] + 1j * frame[f"h{i}y"]
                for j in range(i, k):
                    g[:, i, j] = frame[f"g{i}_{j}x"] + 1j * frame[f"g{i}_{j}y"]
                    g[:, j, i] = g[:, i, j].conj()
            a = np.einsum("nij,nj->ni", np.linalg.pinv(g, rcond=rcond, hermitian=True), h) if len(frame) else h
            yield frame[group].assign(a_re=list(a.real), a_im=list(a.imag))

    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in group)
    return named.groupBy(*group).agg(*sums).mapInPandas(solve, f"{kinds}, a_re array<double>, a_im array<double>")


def _model(templates: Sequence[Complex], re: str = "a_re", im: str = "a_im", first: int = 0) -> Complex:
    return _sum([cmul((F.get(re, first + i), F.get(im, first + i)), s) for i, s in enumerate(templates)])


def subtract_templates(df: DataFrame, group: list[str], amplitudes: DataFrame, templates: Sequence[Complex]) -> DataFrame:
    """df with the templates times their amplitudes (group, a_re, a_im) taken out; groups without amplitudes stay."""
    re, im = _model(templates)
    known = F.col("a_re").isNotNull()
    met = df.join(amplitudes.select(*group, "a_re", "a_im"), group, "left")
    return met.withColumns({"re": F.when(known, F.col("re") - re).otherwise(F.col("re")), "im": F.when(known, F.col("im") - im).otherwise(F.col("im"))}).select(*df.columns)


def solve_extended(df: DataFrame, group: list[str], t: str, bases: Sequence[Sequence[Complex]], rounds: int = 4) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Amplitudes per time and shapes over all times of extended sources, by turns.

    Source s is a_s(t) * sum_k c_sk B_sk in df (group, t, re, im, w), with c_s0 = 1. Each round solves the amplitudes
    of every (group, t) for the present shapes, then the shapes of every group for these amplitudes; each half is one
    aggregate of normal equations and a small solve per group. Returns amplitudes (group, t, a_re, a_im by source),
    shapes (group, c_re, c_im by source and basis) and progress (group, round, chisq), from which convergence shows.
    A source whose first coefficient comes out as zero keeps its shape."""
    starts = np.cumsum([0, *(len(b) for b in bases)]).tolist()
    flat = [b for basis in bases for b in basis]
    shape = df.select(*group).distinct().withColumns({
        "c_re": F.array(*(F.lit(1.0 if k in starts[:-1] else 0.0) for k in range(len(flat)))), "c_im": F.array(*(F.lit(0.0) for _ in flat)),
    })
    shape = written(shape)
    progress = None
    whole = [_model(basis, "c_re", "c_im", starts[s]) for s, basis in enumerate(bases)]
    for turn in range(rounds + 1):
        rows = df.join(shape, group)
        amplitude = written(solve_templates(rows, [*group, t], whole))
        left = rows.join(amplitude, [*group, t])
        re, im = _model(whole)
        chisq = F.sum(F.col("w") * abs2((F.col("re") - re, F.col("im") - im)))
        seen = written(left.groupBy(*group).agg(chisq.alias("chisq")).select(*group, F.lit(turn).alias("round"), "chisq"))
        progress = seen if progress is None else progress.unionByName(seen)
        if turn == rounds:
            return amplitude, shape, progress
        scaled = [cmul((F.get("a_re", s), F.get("a_im", s)), b) for s, basis in enumerate(bases) for b in basis]
        found = solve_templates(df.join(amplitude, [*group, t]), group, scaled)
        before = shape.select(*group, F.col("c_re").alias("_pr"), F.col("c_im").alias("_pi"))
        parts: list[Complex] = []
        for s, basis in enumerate(bases):
            first = (F.get("a_re", starts[s]), F.get("a_im", starts[s]))
            size = abs2(first)
            for k in range(starts[s], starts[s] + len(basis)):
                q = cmul((F.get("a_re", k), F.get("a_im", k)), conj(first))
                parts.append(tuple(F.when(size > 0, x / F.when(size > 0, size)).otherwise(F.get(p, k)) for x, p in zip(q, ("_pr", "_pi"))))
        shape = written(found.join(before, group).select(*group, F.array(*(p[0] for p in parts)).alias("c_re"), F.array(*(p[1] for p in parts)).alias("c_im")))
