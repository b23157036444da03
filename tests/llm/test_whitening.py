from __future__ import annotations

import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm.whitening import count_above, exact_products, leading, whiten

SCHEMA = "vec_id long, embedding array<double>"


def spectrum(values, seed=0):
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    matrix = basis @ np.diag(values) @ basis.T
    return (matrix + matrix.T) / 2


@pytest.mark.parametrize(
    "values",
    [
        np.arange(1, 13.0),
        np.geomspace(1e-6, 1e6, 20),
        np.array([5.0, 5.0, 5.0, 3.0, 3.0, 1.0, 0.0, 0.0]),
        np.array([2.0, 2.0 + 1e-9, 1.0, 1.0 - 1e-12, 0.5]),
        np.array([7.0]),
        np.ones(6),
        np.zeros(4),
    ],
)
def test_leading_equals_a_full_decomposition(values):
    matrix = spectrum(values)
    got, vectors = leading(matrix, 6)
    wanted = np.sort(values)[::-1]
    wanted = wanted[wanted > 1e-12 * max(1e-300, wanted.max())][:6]
    assert len(got) == len(wanted) and np.allclose(got, wanted, rtol=1e-12, atol=1e-13 * values.max())
    assert np.allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-12)
    assert np.abs(matrix @ vectors - vectors * got).max(initial=0) <= 1e-13 * max(1.0, values.max()) * len(values)


def test_counts_are_those_of_the_eigenvalues():
    rnd = np.random.default_rng(3)
    for _ in range(50):
        matrix = rnd.standard_normal((9, 9))
        matrix = matrix + matrix.T
        if rnd.random() < 0.5:
            np.fill_diagonal(matrix, 0)  # needs blocks of two
        values = np.linalg.eigvalsh(matrix)
        for shift in (values[:-1] + values[1:]) / 2:
            assert count_above(matrix, shift) == (values > shift).sum()


def test_products_are_exact():
    big = np.array([[2**40 + 1, -3], [5, 2**40 - 7]])
    wanted = [[sum(int(r[i]) * int(r[j]) for r in big) for j in range(2)] for i in range(2)]
    assert exact_products(big).tolist() == wanted
    small = np.random.default_rng(1).integers(-(2**20), 2**20, (5000, 3))
    assert exact_products(small).tolist() == (small.astype(object).T @ small.astype(object)).tolist()


def brute(rows, components=32):
    """By exact fractions and numpy's own decomposition."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    longest = max((len(v) for _, v in kept), default=0)
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in kept if len(v) == longest]
    n = len(kept)
    total = [sum(x[d] for _, x in kept) for d in range(longest)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, total)] for _, x in kept])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(x, total)) for _, x in kept]
    return kept, n, deviations, values, centred @ vectors, np.trace(covariance)


def check(rows, got, components=32):
    kept, n, deviations, values, projected, trace = brute(rows, components)
    by_id = defaultdict(list)
    for r in got:
        by_id[r.vec_id].append(r)
    size = int((values > 1e-10 * trace).sum())
    assert len(got) == size * n and {r.n for r in got} == {n}
    signs = np.zeros(size)
    for (i, _), deviation, line in zip(kept, deviations, projected):
        own = sorted(by_id[i], key=lambda r: r.component)[:size]
        assert [r.component for r in own] == list(range(1, size + 1)) and {r.deviation for r in own} == {deviation}
        assert np.allclose([r.explained for r in own], values[:size] / trace, rtol=1e-9)
        whitened = np.array([r.whitened for r in own])
        assert np.allclose(np.abs(whitened), np.abs(line[:size] / np.sqrt(values[:size])), atol=1e-6)
        agree = np.sign(whitened * line[:size]) * (np.abs(whitened) > 1e-6)
        assert (agree * signs >= 0).all()
        signs = np.where(signs == 0, agree, signs)
    assert {r.identity_error <= 1e-9 for r in got} == {True}


def test_small_vectors(spark):
    rnd = np.random.default_rng(5)
    rows = [(i, (rnd.standard_normal(5) * [9, 5, 3, 2, 1]).tolist()) for i in range(60)]
    bad = [(100, None), (101, [1.0, None, 2.0, 3.0, 4.0]), (102, [float("nan")] * 5), (103, [float("inf")] + [0.0] * 4), (104, []), (105, [1.0, 2.0])]
    got = whiten(spark.createDataFrame(rows + bad, SCHEMA).repartition(5)).collect()
    check(rows + bad, got)
    check(rows, whiten(spark.createDataFrame(rows, SCHEMA), components=2).collect(), 2)


def test_repeated_rows_and_clashing_columns(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, -1.0]), (2, [0.5, 0.5])]
    frame = spark.createDataFrame([(*r, 1, 2.0, "x") for r in rows], SCHEMA + ", n long, whitened double, id string")
    got = whiten(frame).collect()
    assert len(got) == 2 * 4 and sum(r.vec_id == 1 for r in got) == 4 and sum(r.vec_id is None for r in got) == 2
    assert all(r.identity_error < 1e-9 for r in got)


def test_degenerate_tables(spark):
    assert whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whiten(spark.createDataFrame([(1, None)], SCHEMA)).collect() == []
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0])], SCHEMA)).collect() == []
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).collect() == []
    constant = spark.createDataFrame([(i, [float(i), 7.0, 7.0]) for i in range(4)], SCHEMA)
    assert {r.component for r in whiten(constant).collect()} == {1}
    huge = spark.createDataFrame([(i, [float(i), 1e13 * i]) for i in range(4)] + [(9, [1e300, 0.0])], SCHEMA)
    got = whiten(huge).collect()
    assert {r.vec_id for r in got} == {0, 1, 2, 3} and all(r.deviation is None for r in got)


def test_whole_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding) if r.embedding is not None else None) for r in frame.collect()]
    check(rows, whiten(frame).collect())
