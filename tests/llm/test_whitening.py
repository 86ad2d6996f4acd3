import math
from fractions import Fraction

import numpy as np
import pytest

from meterflow.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def spectrum(values, seed=0):
    """A symmetric matrix with these eigenvalues."""
    draw = np.random.default_rng(seed)
    basis, _ = np.linalg.qr(draw.standard_normal((len(values), len(values))))
    matrix = (basis * np.array(values, float)) @ basis.T
    return (matrix + matrix.T) / 2


@pytest.mark.parametrize("values", [
    [3.0], [5, 4, 3, 2, 1], list(range(40, 0, -1)), [1e6, 1, 1e-6], [2, 2, 2, 1], [7, 7, 5, 5, 5, 0],
    [1, 1 - 1e-9, 1 - 2e-9, 0.5], [1, 1 - 1e-13, 0.2], [10] + [0] * 8, [1.0] * 6, [0.0, 0.0],
    [1e300, 1e299], [1e-300, 1e-301], np.geomspace(1e4, 1e-4, 64).tolist(),
])
def test_leading_eigenvalues(values):
    matrix = spectrum(values)
    found, vectors = whitening.leading(matrix)
    wanted = np.sort(np.linalg.eigvalsh(matrix))[::-1]
    scale = np.abs(matrix).sum(axis=1).max()
    most = min(32, int((wanted > len(values) * whitening.EPS * scale).sum()))
    assert abs(len(found) - most) <= (0 if min(values) > 0 else 1)
    np.testing.assert_allclose(found, wanted[:len(found)], rtol=0, atol=64 * whitening.EPS * scale)
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-13)
    left = (matrix @ vectors - vectors * found) / (scale or 1)
    assert np.abs(left).max(initial=0) < 1e-13


@pytest.mark.parametrize("seed", range(8))
def test_inertia_counts(seed):
    draw = np.random.default_rng(seed)
    matrix = draw.standard_normal((9, 9))
    matrix = matrix + matrix.T
    values = np.linalg.eigvalsh(matrix)
    for shift in [*draw.uniform(-6, 6, 20), 0.0]:
        assert whitening.above(matrix, shift) == (values > shift).sum()
    swap = np.array([[0.0, 1.0], [1.0, 0.0]])
    assert [whitening.above(swap, s) for s in (-2, 0, 2)] == [2, 1, 0]


def plain(vectors):
    """(n, deviations, covariance) of vectors by exact fractions."""
    whole = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n, size = len(whole), len(whole[0])
    totals = [sum(v[d] for v in whole) for d in range(size)]
    off = [[Fraction(n * v[d] - totals[d], n) for d in range(size)] for v in whole]
    matrix = [[float(sum(v[i] * v[j] for v in off) / n) for j in range(size)] for i in range(size)]
    return n, [int(sum((n * c) ** 2 for c in v)) for v in off], np.array(matrix), off


def check(found, ids, vectors):
    n, deviations, matrix, off = plain(vectors)
    values, basis = np.linalg.eigh(matrix)
    values, basis = values[::-1], basis[:, ::-1]
    rows = {}
    for row in found:
        rows.setdefault((row.vec_id, row.deviation), {})[row.component] = row
    for vec_id, deviation, centred in zip(ids, deviations, off):
        mine = rows[vec_id, deviation]
        for component, row in mine.items():
            value = values[component - 1]
            wanted = np.array(centred, float) @ basis[:, component - 1] / value ** 0.5
            assert row.n == n and row.identity_error < 1e-9
            assert abs(row.explained - value / np.trace(matrix)) < 1e-9
            assert abs(abs(row.whitened) - abs(wanted)) < 1e-7
    return rows


def test_same_as_exact_fractions(spark):
    draw = np.random.default_rng(3)
    vectors = (draw.standard_normal((60, 6)) * [9, 5, 3, 2, 1, 0.5] + 100).tolist()
    rows = [(i, v) for i, v in enumerate(vectors)]
    spoiled = [(100, None), (101, [None] + vectors[0][1:]), (102, [float("nan")] + vectors[0][1:]),
               (103, [float("inf")] + vectors[0][1:]), (104, [1.0, 2.0]), (105, []), (106, [1e30] * 6)]
    frame = spark.createDataFrame(rows + spoiled, SCHEMA).repartition(3)
    from pyspark.sql import functions as F
    frame = frame.select("*", *[F.lit("own").alias(c) for c in ("n", "size", "dim", "component")])
    found = whitening.whiten(frame).collect()
    assert len(found) == 60 * 6 and {r.vec_id for r in found} == set(range(60))
    check(found, range(60), vectors)
    few = whitening.whiten(frame, most=2).collect()
    assert {r.component for r in few} == {1, 2} and len(few) == 120


def test_ties_repeats_and_null_ids(spark):
    rows = [(None, [1.0, 0.0])] * 3 + [(7, [0.0, 1.0])] * 3 + [(8, [0.0, 0.0]), (9, [1.0, 1.0])] * 2
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 20 and sum(r.vec_id is None for r in found) == 6
    check(found, [r[0] for r in rows], [r[1] for r in rows])


def test_no_variance_and_no_rows(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None)], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_large_entries_stay_exact(spark):
    vectors = [[2.0 ** 40, 1.0], [0.0, 2.0], [2.0 ** 39, 3.0], [5.0, 7.0]]
    rows = spark.createDataFrame(list(enumerate(vectors)), SCHEMA)
    deviations = [d if d < 1 << 63 else None for d in plain(vectors)[1]]
    found = {r.vec_id: r.deviation for r in whitening.whiten(rows).collect()}
    assert [found[i] for i in range(4)] == deviations
    small = [[v / 2 ** 20 for v in vector] for vector in vectors]
    found = whitening.whiten(spark.createDataFrame(list(enumerate(small)), SCHEMA)).collect()
    assert {r.vec_id: r.deviation for r in found} == dict(enumerate(plain(small)[1]))
