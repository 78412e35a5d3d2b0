import math
import random

import numpy as np
import pytest

from ledgerloom.llm import whitening
from tests.llm.frames import given

SCHEMA = "vec_id long, embedding array<double>"


def exact(rows):
    """n, covariance times n * n and deviations in Python's integers."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in rows]
    n, size = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(size)]
    scatter = [[n * sum(r[i] * r[j] for r in x) - sums[i] * sums[j] for j in range(size)] for i in range(size)]
    return n, scatter, [sum((n * r[j] - sums[j]) ** 2 for j in range(size)) for r in x], x, sums


def check(spark, rows, most=8, rank=99):
    """The query's rows against the eigenvectors that numpy finds."""
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(rows)], SCHEMA)
    out = whitening.whiten(df, most).collect()
    n, scatter, deviations, x, sums = exact(rows)
    values, vectors = np.linalg.eigh(np.array(scatter, dtype=float) / n / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = sum(scatter[i][i] for i in range(len(scatter))) / n / n
    count = min(most, rank, len(values))
    assert len(out) == count * n
    centred = np.array(x, dtype=float) - np.array(sums) / n
    for r in out:
        k = r["component"] - 1
        assert r["n"] == n and r["deviation_exact"] == deviations[r["vec_id"]]
        assert r["deviation"] == (deviations[r["vec_id"]] if deviations[r["vec_id"]] < 1 << 63 else None)
        assert abs(r["explained"] / (values[k] / trace) - 1) < 1e-6
        assert r["identity_error"] < 1e-9
        alone = all(abs(values[k] - v) > 1e-6 * values[0] for i, v in enumerate(values) if i != k)
        if alone:
            own = centred[r["vec_id"]] @ vectors[:, k] / math.sqrt(values[k])
            assert abs(abs(r["whitened"]) - abs(own)) < 1e-6
    return out


def test_given_vectors(spark):
    rows = [r["embedding"] for r in given(spark, "embeddings").orderBy("vec_id").collect()]
    assert len(check(spark, rows)) == 8 * len(rows)


def test_few_dimensions_low_rank_and_long_numbers(spark):
    rng = random.Random(3)
    check(spark, [[rng.gauss(0, 1) for _ in range(3)] for _ in range(40)])
    flat = [[a, b, a + b, 2 * a] for a, b in ((rng.randrange(-9, 9), rng.randrange(-9, 9)) for _ in range(30))]
    check(spark, flat, rank=2)  # two of four eigenvalues are 0
    check(spark, [[1e6 * rng.gauss(0, 1), rng.gauss(0, 1)] for _ in range(20)])
    check(spark, [[1e13 * rng.random(), 1e13 * rng.random()] for _ in range(20)])
    check(spark, [[5.0], [7.0]])


def test_equal_eigenvalues_give_an_orthogonal_set(spark):
    corners = [[s * (k == j) for j in range(5)] for k in range(5) for s in (-3, 3)]
    out = check(spark, corners, most=4)
    by_row = {}
    for r in out:
        by_row.setdefault(r["vec_id"], {})[r["component"]] = r["whitened"]
    w = np.array([[by_row[i][k] for k in range(1, 5)] for i in range(10)])
    assert np.abs(w.T @ w / 10 - np.eye(4)).max() < 1e-9


def test_awkward_rows(spark):
    schema = "vec_id long, embedding array<float>, label int, EMBEDDING string, Vec_ID int, n long"
    good = [(i, [float(i % 3), float(i % 5), 1.0 * i], None, None, None, 7) for i in range(12)]
    bad = [
        (50, None), (51, []), (52, [1.0, None, 2.0]), (53, [1.0, float("nan"), 2.0]),
        (54, [1.0, float("inf"), 2.0]), (55, [1.0, 2.0]), (None, [0.5, 0.25, 0.125]), (3, [0.0, 3.0, 3.0]),
    ]
    df = spark.createDataFrame(good + [(i, v, 1, "x", 2, 3) for i, v in bad], schema)
    rows = whitening.whiten(df).collect()
    ids = sorted((r["vec_id"] for r in rows if r["component"] == 1), key=str)
    assert ids == sorted([*range(12), 3, None], key=str)
    assert {r["n"] for r in rows} == {14} and max(r["identity_error"] for r in rows) < 1e-9
    assert whitening.whiten(df.limit(0)).collect() == []
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)
    assert whitening.whiten(same).collect() == [] and whitening.whiten(same.limit(1)).collect() == []
    assert whitening.whiten(same).dtypes == whitening.whiten(df).dtypes


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_characteristic_polynomial_of_any_matrix(size):
    """Also of matrices whose columns below the diagonal vanish."""
    p = np.array(whitening.primes(3))
    rng = np.random.default_rng(size)
    for zeros in (0.0, 0.5, 0.9):
        a = rng.integers(-4, 5, (size, size)) * (rng.random((size, size)) >= zeros)
        reduced = np.array([[[int(x) % q for x in row] for row in a] for q in p.tolist()], dtype=np.int64)
        found = whitening.characteristic(reduced, p)
        expected = [round(c) for c in np.poly(a.astype(float))[::-1]] if size > 1 else [-int(a[0, 0]), 1]
        for own, q in zip(found, p.tolist()):
            assert own.tolist() == [c % q for c in expected]


def test_roots_are_counted_with_their_multiplicity():
    polynomial = [1]
    for root in (0, 0, 2, 2, 2, 7):
        polynomial = [a - root * b for a, b in zip([0, *polynomial], [*polynomial, 0])]
    assert [whitening.roots_above(polynomial, x) for x in (-1, 0, 1, 2, 6, 7)] == [6, 4, 4, 1, 1, 0]
    assert whitening.roots_above(polynomial, 13, 1) == 1
    for k, (root, over) in enumerate([(7, 0), (2, 1), (2, 1), (2, 1)], 1):
        low, high, bits, above = whitening.isolated(polynomial, k)
        assert high == low + 1 and high == root << bits and above == over


def test_products_are_exact():
    rng = random.Random(8)
    for top in (1 << 5, 1 << 26, 1 << 45, 1 << 61):
        x = np.array([[rng.randrange(-top, top) for _ in range(3)] for _ in range(50)], dtype=np.int64)
        expected = [[sum(int(r[i]) * int(r[j]) for r in x) for j in range(3)] for i in range(3)]
        assert whitening._gram(x).tolist() == expected
