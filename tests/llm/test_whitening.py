"""Whitening against plain integer and floating-point arithmetic over the whole table."""

import math
import random
from decimal import Decimal

import numpy as np
import pytest

from billscope.llm import catalog, whitening
from tests.llm.helpers import DATA


def brute_force(vectors, top=4):
    """n, x of each row, deviations, eigenvalues, covariance of the distinct x: Python integers and one eigh."""
    x = [tuple(math.floor(256 * float(c)) for c in v) for v in vectors]
    fit = sorted(set(x))
    n, dims = len(fit), len(fit[0])
    sums = [sum(v[d] for v in fit) for d in range(dims)]
    centred = [[n * v[d] - sums[d] for d in range(dims)] for v in fit]
    covariance = np.array([[sum(v[i] * v[j] for v in centred) / n**3 for j in range(dims)] for i in range(dims)])
    values, vectors = np.linalg.eigh(covariance)
    return n, x, sums, values[::-1][:top], vectors[:, ::-1][:, :top], np.trace(covariance)


def held(found, ids, vectors):
    n, x, sums, values, directions, total = brute_force(vectors)
    by_id = {}
    for row in found:
        by_id.setdefault(row.vec_id, {})[row.component] = row
    assert sorted(by_id) == sorted(ids)
    signs = {}
    for vec_id, v in zip(ids, x, strict=True):
        rows = by_id[vec_id]
        assert sorted(rows) == list(range(1, len(values) + 1))
        for k, row in rows.items():
            assert row.n == n
            assert row.deviation == sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True))
            expected = float(np.array([c - s / n for c, s in zip(v, sums, strict=True)]) @ directions[:, k - 1] / math.sqrt(values[k - 1]))
            if abs(expected) > 1e-6:
                signs.setdefault(k, math.copysign(1, expected * row.whitened))
            assert row.whitened == pytest.approx(expected * signs.get(k, 1), abs=1e-7)
            assert row.explained == pytest.approx(values[k - 1] / total, rel=1e-9)
            assert row.identity_error < 1e-9


def test_query_against_brute_force(spark):
    folder = f"{DATA}/sf0.01"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    found = catalog.op11_embedding_whitening(spark, folder)
    assert dict(found.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    held(found.collect(), [r.vec_id for r in rows], [r.embedding for r in rows])


@pytest.mark.parametrize("scale", [1, 300, 2**31, 2**62])
def test_scatter_is_exact(scale):
    draw = random.Random(scale)
    x = np.array([[draw.randrange(-scale, scale) if d else scale for d in range(5)] for _ in range(333)], np.int64)
    sums, cross = whitening.scatter(x)
    whole = [[int(v) for v in row] for row in x]
    assert sums == [sum(r[i] for r in whole) for i in range(5)]
    assert cross == [[sum(r[i] * r[j] for r in whole) for j in range(i, 5)] for i in range(5)]


def test_limbs_carry_any_sum():
    for value in (0, 1, -1, 2**150 + 12345, -(2**150) - 999, 2**63, -(2**40)):
        limbs = whitening._limbs(value)
        assert sum(v << (whitening.LIMB_BITS * k) for k, v in enumerate(limbs)) == value
        assert all(abs(v) < 2**40 for v in limbs)


def test_blocks_and_partitions_add_up(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 64)
    draw = np.random.default_rng(3)
    x = draw.integers(-500, 500, (1000, 7))
    frame = spark.createDataFrame([(r,) for r in x.tolist()], "x array<long>").repartition(5)
    n, sums, cross = whitening.exact_statistics(frame)
    assert n == 1000 and sums == x.sum(axis=0).tolist()
    assert cross == [(x.T @ x)[i, i:].tolist() for i in range(7)]


def test_bad_vectors_copies_and_clashing_columns(spark):
    nan, inf = float("nan"), float("inf")
    draw = random.Random(5)
    fine = [[draw.uniform(-1, 1) for _ in range(6)] for _ in range(40)]
    bad = [None, [], [None] * 6, [nan, *[0.0] * 5], [inf, *[0.0] * 5], [0.5] * 7, [0.5] * 2]
    rows = [(k, v, 1, "a", 0.5) for k, v in enumerate(fine + fine[:20])] + [(1000 + k, v, 1, "a", 0.5) for k, v in enumerate(bad)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, deviation string, whitened double")
    held(whitening.whitened_embeddings(frame).collect(), list(range(60)), fine + fine[:20])
    # Repeated rows and rows without id each give their rows.
    twice = whitening.whitened_embeddings(frame.unionByName(frame.selectExpr("cast(null as long) as vec_id", "embedding", "n", "deviation", "whitened")))
    assert twice.count() == 2 * 60 * 4 and twice.where("vec_id is null").count() == 60 * 4
    assert twice.select("n").distinct().collect()[0].n == 40


def test_few_directions_and_empty_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whitened_embeddings(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whitened_embeddings(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    line = whitening.whitened_embeddings(spark.createDataFrame([(k, [float(k), 2.0 * k, 0.0]) for k in range(9)], schema)).collect()
    assert {r.component for r in line} == {1} and all(r.explained == pytest.approx(1) and r.identity_error < 1e-9 for r in line)


def test_very_wide_entries_stay_exact(spark):
    vectors = [[1e15, -3.0], [-1e15, 5.0], [7e14, 1.0], [0.25, 0.5]]
    found = whitening.whitened_embeddings(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")).collect()
    n, x, sums, values, _, total = brute_force(vectors)
    for row in found:
        assert row.deviation == Decimal(sum((n * c - s) ** 2 for c, s in zip(x[row.vec_id], sums, strict=True)))
    # The end of the long range stands for what is beyond it, and what no decimal holds is null.
    huge = whitening.whitened_embeddings(spark.createDataFrame([(0, [1e300, 0.0]), (1, [-1e300, 1.0]), (2, [0.0, 0.0])], "vec_id long, embedding array<double>")).collect()
    assert {r.deviation for r in huge if r.vec_id == 0} == {None} and all(math.isfinite(r.whitened) for r in huge)
