"""Whitening against eigenvectors by numpy, and its exact parts against whole-number algebra."""

import math
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pytest

from firmdyn.llm.exact_whitening import (characteristic_polynomial, gram, is_prime, polynomial_modulo, primes_for,
                                         root, roots_above, whiten_embeddings)

SCHEMA = "vec_id long, embedding array<double>, n string, whitened int, x int"
NAN, INF = float("nan"), float("inf")


def brute(rows, k=4):
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v, *_ in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    centred = np.array([[float(Fraction(n * x[j] - sums[j], n)) for j in range(d)] for x in fit])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    out = []
    for i, x in kept:
        own = np.array([float(Fraction(n * x[j] - sums[j], n)) for j in range(d)])
        for c in range(min(k, d)):
            if e[c] > 1e-9 * e[0]:
                out.append((i, c + 1, n, sum((n * a - s) ** 2 for a, s in zip(x, sums)), own @ v[:, c] / np.sqrt(e[c]), e[c] / e.sum()))
    return out


def check(got, want, ordered=True):
    assert len(got) == len(want)
    got, want = sorted(got, key=lambda r: (r[1], str(r[0]), r[3])), sorted(want, key=lambda r: (r[1], str(r[0]), r[3]))
    for c in {r[1] for r in want}:
        a, b = [r for r in got if r[1] == c], [r for r in want if r[1] == c]
        assert [(str(r[0]), r[1], r[2], int(r[3])) for r in a] == [(str(r[0]), r[1], r[2], r[3]) for r in b]
        assert np.allclose([r[5] for r in a], [r[5] for r in b], rtol=1e-9)
        x, y = np.array([r[4] for r in a]), np.array([r[4] for r in b])
        if ordered:  # either sign, one for all rows
            assert np.allclose(x, y, atol=1e-7) or np.allclose(x, -y, atol=1e-7)
    assert all(r[6] < 1e-9 for r in got)


def random_rows(d, n, seed=1):
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) / d
    return [(i, [float(c) for c in v], "x", 1, 2) for i, v in enumerate(data)]


def run(spark, rows, **options):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return [tuple(r) for r in whiten_embeddings(docs, **options).collect()]


def test_against_numpy(spark):
    rows = random_rows(12, 300)
    rows += [(1000 + i, rows[0][1], "x", 1, 2) for i in range(500)]  # a vector with most of the rows
    rows += [(7, rows[7][1], "x", 1, 2), (None, rows[3][1], "x", 1, 2), (None, [0.5] * 12, "x", 1, 2)]
    rows += [(2000, None, "x", 1, 2), (2001, [], "x", 1, 2), (2002, [None] + [0.1] * 11, "x", 1, 2),
             (2003, [NAN] + [0.1] * 11, "x", 1, 2), (2004, [0.1] * 11 + [INF], "x", 1, 2), (2005, [0.1] * 11 + [-INF], "x", 1, 2)]
    other = [(3000, [0.1] * 5, "x", 1, 2), (3001, [0.1] * 13, "x", 1, 2)]  # other lengths are left out
    check(run(spark, rows + other), brute(rows))


def test_many_components_and_other_names(spark):
    rows = [(r[0], r[1]) for r in random_rows(5, 60, 3)]
    docs = spark.createDataFrame(rows, "key string, v array<float>")
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in rows]
    check([tuple(r) for r in whiten_embeddings(docs, "key", "v", n_components=9).collect()], brute(rows, 9))


def test_zero_variance_has_no_component(spark):
    base = random_rows(3, 80, 5)
    rows = [(i, [*v, 2 * math.floor(256 * v[0]) / 256, 0.25], "x", 1, 2) for i, v, *_ in base]  # rank 3 of 5
    check(run(spark, rows), brute(rows))
    assert {r[1] for r in run(spark, rows)} == {1, 2, 3}
    assert run(spark, [(1, [0.5, 0.1], "x", 1, 2), (2, [0.5, 0.1], "x", 1, 2)]) == []


def test_equal_eigenvalues(spark):
    rows = [(i, [s if j == i // 2 else 0.0 for j in range(6)], "x", 1, 2) for i, s in
            ((i, 1.0 if i % 2 else -1.0) for i in range(12))]  # a cross: all six alike
    got = run(spark, rows)
    check(got, brute(rows), ordered=False)
    w = np.zeros((12, 4))
    for r in got:
        w[r[0], r[1] - 1] = r[4]
    assert np.allclose(w.T @ w / 12, np.eye(4), atol=1e-12)


def test_large_and_offset_entries(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [1e6 + 30 * float(a), -3e8 + 100 * float(b), 50 * float(c)], "x", 1, 2)
            for i, (a, b, c) in enumerate(rng.normal(size=(50, 3)))]
    check(run(spark, rows), brute(rows))
    huge = [(i, [float(a) * 1e300, 1.0 + i], "x", 1, 2) for i, a in enumerate(rng.normal(size=20))]
    got = run(spark, huge)  # entries beyond 64 bits are the nearest number of 64 bits
    assert len(got) == 40 and all(math.isfinite(r[4]) for r in got) and all(r[6] < 1e-6 for r in got)
    assert any(r[3] is None for r in got)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert whiten_embeddings(docs).collect() == []


def test_polynomial(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(-50, 50, (40, 7))
    x = np.hstack([x, x[:, :2]])  # zero eigenvalues
    matrix = [[int(v) for v in row] for row in x.T @ x]
    poly = characteristic_polynomial(spark, matrix)

    def det(rows):  # by fractions
        rows, out = [list(map(Fraction, r)) for r in rows], Fraction(1)
        for k in range(len(rows)):
            pivot = next((i for i in range(k, len(rows)) if rows[i][k]), None)
            if pivot is None:
                return Fraction(0)
            if pivot != k:
                rows[k], rows[pivot], out = rows[pivot], rows[k], -out
            out *= rows[k][k]
            for i in range(k + 1, len(rows)):
                f = rows[i][k] / rows[k][k]
                rows[i] = [a - f * b for a, b in zip(rows[i], rows[k])]
        return out

    for t in (0, 1, -3, 1000, 123456):
        assert sum(c * t**k for k, c in enumerate(poly)) == det(
            [[t * (i == j) - v for j, v in enumerate(row)] for i, row in enumerate(matrix)])
    trace, values = sum(matrix[i][i] for i in range(9)), np.linalg.eigvalsh(np.array(matrix, float))[::-1]
    for nth in range(1, 8):
        a, bits = root(poly, nth, trace)
        assert Decimal(a) / 2**bits == pytest.approx(Decimal(float(values[nth - 1])), rel=Decimal("1e-9"))
    assert roots_above(poly, -1, 0) == 9 and roots_above(poly, 0, 0) == 7 and roots_above(poly, trace, 0) == 0


def test_root_with_copies():
    poly = [1]
    for r in (3, 3, 1, 7):
        poly = [b - r * a for a, b in zip([*poly, 0], [0, *poly])]
    found = [float(Decimal(a) / 2**bits) for a, bits in (root(poly, nth, 14) for nth in range(1, 5))]
    assert found == pytest.approx([7, 3, 3, 1])


def test_modular_polynomial_of_awkward_matrices():
    p = primes_for(1)[0]
    assert p == 2**31 - 1 and not is_prime(2**31 - 3) and is_prime(2) and not is_prime(1)
    assert polynomial_modulo([[0, 0], [0, 0]], p) == [0, 0, 1]
    assert polynomial_modulo([[5]], p) == [p - 5, 1]
    swap = [[0, 0, 1], [0, 1, 0], [1, 0, 0]]  # needs a row exchange
    assert polynomial_modulo(swap, p) == [1, p - 1, p - 1, 1]


def test_gram_is_exact():
    big = np.array([[2**40 + 1, 3], [5, -2**35]], np.int64)
    want = [[sum(int(big[r, a]) * int(big[r, b]) for r in range(2)) for b in range(2)] for a in range(2)]
    assert gram(big).tolist() == want
