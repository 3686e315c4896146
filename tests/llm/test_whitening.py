"""Whitening against exact sums and a plain eigensolver."""

import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from gramloom.llm import whitening as w

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def plain_polynomial(matrix):
    """Coefficients of det(x - matrix) by traces of powers, in fractions."""
    d = len(matrix)
    a = np.array(matrix, object)
    power, coefficients = np.zeros((d, d), object), [Fraction(1)]
    for k in range(1, d + 1):
        power = a @ power + coefficients[-1] * np.eye(d, dtype=int).astype(object)
        product = a @ power
        coefficients.append(-Fraction(sum(product[i, i] for i in range(d)), k))
    return [int(c) for c in coefficients]


def gram(rng, d, rank, size=50):
    rows = rng.integers(-size, size, (rank, d)).astype(object)
    return (rows.T @ rows).tolist()


@pytest.mark.parametrize(("d", "rank"), [(1, 1), (2, 2), (5, 5), (7, 3), (9, 9)])
def test_polynomial_and_roots(spark, d, rank):
    matrix = gram(np.random.default_rng(d), d, rank)
    found = w.characteristic_polynomial(spark, matrix)
    assert found == plain_polynomial(matrix)
    roots, shift = w.highest_roots(found, d)
    expected = np.linalg.eigvalsh(np.array(matrix, float))[::-1][:rank]
    assert len(roots) == rank
    assert np.allclose([root / 2**shift for root in roots], expected, rtol=1e-9)


def test_polynomial_with_zero_columns_and_large_entries(spark):
    matrix = [[0, 0, 0, 0], [0, 10**40, 0, 3], [0, 0, 0, 0], [0, 3, 0, 10**39]]
    assert w.characteristic_polynomial(spark, matrix) == plain_polynomial(matrix)


def test_repeated_roots_get_an_orthonormal_basis(spark):
    matrix = np.diag([7, 7, 2, 2, 2, 0]).astype(object)
    turn = np.array([[1, 1, 0, 0, 0, 0], [1, -1, 0, 0, 0, 0]] + np.eye(6, dtype=int)[2:].tolist(), object)
    matrix = (turn.T @ matrix @ turn).tolist()
    roots, shift = w.highest_roots(w.characteristic_polynomial(spark, matrix), 6)
    assert [root / 2**shift for root in roots] == [14, 14, 2, 2, 2]
    with w.localcontext() as context:
        context.prec = w.DIGITS
        units = np.array([[float(x) for x in v] for v in w.null_vectors(matrix, roots, shift)])
    assert np.allclose(units @ units.T, np.eye(5), atol=1e-15)
    assert np.allclose(np.array(matrix, float) @ units.T, units.T * [14, 14, 2, 2, 2], atol=1e-12)


def rows_and_odd_ones():
    rng = np.random.default_rng(3)
    mixing = rng.standard_normal((6, 6))
    rows = [(i, (rng.standard_normal(6) @ mixing).tolist(), 1) for i in range(400)]
    rows += [(7, rows[7][1], 1), (None, rows[8][1], None), (None, rows[8][1], 2)]
    odd = [None, [None] + [1.0] * 5, [math.nan] * 6, [math.inf] * 6, [-math.inf] + [0.0] * 5]
    return rows, [(1000 + i, v, 0) for i, v in enumerate(odd)] + [(2000, [], 1)]


def test_whitening(spark):
    rows, odd = rows_and_odd_ones()
    other = [(3000 + i, [float(i * i), float(i % 3)], 1) for i in range(30)]
    frame = spark.createDataFrame(rows + odd + other, SCHEMA).withColumns({"length": F.lit("x"), "n": F.lit(1)})
    found = w.whiten(frame.repartition(5), components=4).collect()
    by_id = defaultdict(list)
    for r in found:
        by_id[r.vec_id].append(r)
    assert len(found) == 4 * len(rows) + 2 * len(other) and len(by_id[7]) == 8 and len(by_id[None]) == 8
    assert not any(vec_id is not None and 1000 <= vec_id <= 2000 for vec_id in by_id)
    numbers = np.array([[math.floor(1024 * x) + 100_000 for x in v] for _, v, _ in rows], object)
    n, sums = len(rows), numbers.sum(axis=0)
    centred = n * numbers - sums
    covariance = ((centred.T @ centred) / n**3).astype(float)
    values, units = np.linalg.eigh(covariance)
    for r in found:
        if r.vec_id is None or r.vec_id >= 3000:
            continue
        assert r.n == n and r.deviation == sum(x * x for x in centred[r.vec_id]) and r.identity_error < 1e-9
        assert math.isclose(r.explained, values[-r.component] / values.sum(), rel_tol=1e-9)
        expected = (centred[r.vec_id] / n).astype(float) @ units[:, -r.component] / math.sqrt(values[-r.component])
        assert math.isclose(abs(r.whitened), abs(expected), rel_tol=1e-8, abs_tol=1e-9)
    assert {r.n for r in found if (r.vec_id or 0) >= 3000} == {30}


def test_directions_without_variance_are_no_components(spark):
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0], 0) for i in range(10)], SCHEMA)
    found = w.whiten(line).collect()
    assert {r.component for r in found} == {1} and len(found) == 10
    assert math.isclose(sum(r.whitened**2 for r in found), 10) and found[0].explained == 1.0
    same = spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(5)], SCHEMA)
    assert w.whiten(same).collect() == [] and w.whiten(same.limit(0)).collect() == []
    with pytest.raises(ValueError):
        w.whiten(same, components=0)


def test_large_components_are_exact(spark):
    values = [[float(2**40 + i), float(-(i**5))] for i in range(40)] + [[1e300, -1e300]]
    frame = spark.createDataFrame([(i, v, 0) for i, v in enumerate(values[:-1])], SCHEMA)
    numbers = np.array([[int(1024 * x) for x in v] for v in values[:-1]], object)
    centred = len(numbers) * numbers - numbers.sum(axis=0)
    found = w.whiten(frame).collect()
    assert len(found) == 80
    assert all(r.deviation == min(2**63 - 1, sum(x * x for x in centred[r.vec_id])) for r in found)
    n, sums, matrix = w.scatter(frame.select(F.col("embedding")))[2]
    assert n == 40 and sums == numbers.sum(axis=0).tolist() and matrix == (centred.T @ centred // 40).tolist()
    bounded = spark.createDataFrame([(i, v, 0) for i, v in enumerate(values)], SCHEMA)
    assert len(w.whiten(bounded).collect()) == 82
