"""Whitening from exact polynomials, against numpy and against exact arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, count=4):
    """Per id: deviation, whitened up to sign, explained; from numpy on the distinct whole vectors."""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), dtype=np.float64)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    centred = fit - fit.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:count], axes[:, ::-1][:, :count]
    good = values > 1e-9 * max(values.max(), 1)
    out = []
    for i, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        white = (np.array(x) - fit.mean(axis=0)) @ axes[:, good] / np.sqrt(values[good])
        out.append((i, deviation, white, values[good] / (centred**2).sum() * n))
    return n, out


def compare(spark, rows, schema=SCHEMA, tolerance=1e-7):
    found = whitening.whiten(spark.createDataFrame(rows, schema).repartition(3)).collect()
    n, expected = brute([(r[0], r[1]) for r in rows])
    got = {}
    for r in found:
        got.setdefault(r["vec_id"], []).append(r)
    assert len(found) == sum(len(w) for _, _, w, _ in expected)
    sign = {}
    for i, deviation, white, explained in expected:
        own = sorted({r["component"]: r for r in got[i]}.values(), key=lambda r: r["component"])
        assert [r["component"] for r in own] == list(range(1, len(white) + 1))
        for r, w, e in zip(own, white, explained):
            assert (r["n"], r["deviation"]) == (n, deviation)
            assert r["identity_error"] < 1e-9 and abs(r["explained"] / e - 1) < 1e-9
            if abs(w) > 1e-6:
                assert sign.setdefault(r["component"], np.sign(w * r["whitened"])) == np.sign(w * r["whitened"])
            assert abs(abs(w) - abs(r["whitened"])) < tolerance
    assert len({r["identity_error"] for r in found}) <= 1
    return found


def test_random_vectors_with_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.normal(size=7) * [5, 3, 2, 1, 1, 0.5, 0.1]]) for i in range(120)]
    rows += [(500 + i, rows[0][1]) for i in range(40)] + [(0, rows[0][1]), (None, rows[1][1])]
    nan, inf = float("nan"), float("inf")
    odd = [(900, None), (901, [1.0] * 6 + [None]), (902, [nan] * 7), (903, [1.0] * 6 + [-inf]), (904, [])]
    found = compare(spark, rows + odd)
    assert {r["vec_id"] for r in found}.isdisjoint(range(900, 910))
    other = whitening.whiten(spark.createDataFrame(rows + [(950, [1.0, 2.0])], SCHEMA))  # of another length than most
    assert 950 not in {r["vec_id"] for r in other.collect()} and other.count() == len(found)


def test_extra_columns_and_types(spark):
    rows = [(f"v{i}", [float(i % 5), float(i % 3), 0.25 * i], "x", 1) for i in range(20)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id string, embedding array<double>, component string, n int"))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.count() == 60 and got.schema["vec_id"].dataType.simpleString() == "string"


def test_few_directions_and_none(spark):
    line = [(i, [float(i), 2.0 * i, -1.0 * i, 0.0, 3.0]) for i in range(9)]
    assert {r["component"] for r in compare(spark, line)} == {1}
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        empty = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
        assert empty.count() == 0 and empty.columns[0] == "vec_id"


def test_equal_roots_share_orthogonal_axes(spark):
    rows = [(2 * i + s, [float(s * 2 - 1) if j == i else 0.0 for j in range(6)]) for i in range(6) for s in (0, 1)]
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    white = np.zeros((12, 4))
    for r in found:
        white[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert abs(r["explained"] - 1 / 6) < 1e-12 and r["identity_error"] < 1e-12
    assert np.allclose(white.T @ white / 12, np.eye(4))


def test_large_entries_stay_exact(spark):
    rows = [(i, [1e9 * (i % 7) + i, -3e8 * (i % 4), 1.5 * i]) for i in range(30)]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    xs = [[math.floor(256 * c) for c in v] for _, v in rows]
    sums = [sum(x[j] for x in xs) for j in range(3)]
    for r in found:
        exact = sum((30 * a - s) ** 2 for a, s in zip(xs[r["vec_id"]], sums))
        assert r["deviation"] == (exact if exact < 1 << 63 else None)
    assert any(r["deviation"] is None for r in found) and max(r["identity_error"] for r in found) < 1e-6


def determinant_polynomial(matrix):
    """The characteristic polynomial by exact elimination at as many points as it has coefficients."""
    n = len(matrix)
    points = []
    for x in range(n + 1):
        m = [[Fraction((x if i == j else 0) - matrix[i][j]) for j in range(n)] for i in range(n)]
        value = Fraction(1)
        for k in range(n):
            pivot = next((i for i in range(k, n) if m[i][k]), None)
            if pivot is None:
                value = Fraction(0)
                break
            if pivot != k:
                m[k], m[pivot], value = m[pivot], m[k], -value
            value *= m[k][k]
            for i in range(k + 1, n):
                f = m[i][k] / m[k][k]
                m[i] = [a - f * b for a, b in zip(m[i], m[k])]
        points.append(value)
    coefficients = [Fraction(0)] * (n + 1)
    for i, y in enumerate(points):  # Lagrange
        basis, scale = [Fraction(1)], Fraction(1)
        for j in range(n + 1):
            if j != i:
                basis = [a - j * b for a, b in zip([Fraction(0), *basis], [*basis, Fraction(0)])]
                scale *= i - j
        coefficients = [c + y / scale * b for c, b in zip(coefficients, basis)]
    return [int(c) for c in coefficients]


@pytest.mark.parametrize("dim,low", [(1, 5), (2, 9), (5, 1000), (8, 10**12)])
def test_polynomial_is_exact(spark, dim, low):
    rng = np.random.default_rng(dim)
    a = rng.integers(-low, low, (dim + 2, dim)).astype(object)
    matrix = (a.T @ a).tolist()
    got = whitening.polynomial(spark, matrix)
    assert got == determinant_polynomial(matrix)
    assert whitening.roots_above(got, 0, 0) == dim
    roots = [Fraction(r[0], 1 << r[1]) for r in (whitening.isolate(got, k + 1, sum(matrix[i][i] for i in range(dim))) for k in range(dim))]
    assert roots == sorted(roots, reverse=True)
    assert abs(float(sum(roots) / sum(matrix[i][i] for i in range(dim))) - 1) < 1e-12


def test_polynomial_of_sparse_and_singular_matrices(spark):
    for matrix in ([[4, 0, 0], [0, 0, 0], [0, 0, 4]], [[0, 0], [0, 0]], [[2, 2, 0, 0], [2, 2, 0, 0], [0, 0, 9, 3], [0, 0, 3, 1]]):
        assert whitening.polynomial(spark, matrix) == determinant_polynomial(matrix)


def test_gram_takes_the_exact_way_at_any_size():
    rng = np.random.default_rng(1)
    for top in (3, 2**20, 2**27, 2**40, 2**61):
        x = rng.integers(-top, top, (50, 3))
        assert whitening.gram(x).tolist() == (x.astype(object).T @ x.astype(object)).tolist()
    assert whitening.gram(np.zeros((0, 2), np.int64)).tolist() == [[0, 0], [0, 0]]
    assert all(whitening.is_prime(p) for p in whitening.primes(300)) and not whitening.is_prime(2047 * 3)


def test_usable_vectors(spark):
    rows = [(1, [1.0]), (2, [None]), (3, []), (4, None), (5, [float("nan")]), (6, [float("-inf"), 1.0])]
    got = spark.createDataFrame(rows, SCHEMA).where(whitening.usable(F.col("embedding"))).collect()
    assert [r["vec_id"] for r in got] == [1]
