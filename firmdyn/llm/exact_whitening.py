"""Embedding whitening from the exact characteristic polynomial of the scatter matrix.

Entries become whole numbers, so the scatter n * sum(x x') - S S' of the distinct vectors (n squared
times their covariance) is an integer matrix, summed without rounding; as nothing is rounded,
it is the same number as the one centred before multiplying. Its characteristic polynomial is found
modulo as many primes as its coefficients can need (and one more, which must agree): each
prime is a row of a Spark job that reduces the matrix to Hessenberg form by similarity
steps modulo the prime and unrolls the recurrence of its leading minors; Chinese
remaindering joins the residues. All roots are real, so the sign variations of the polynomial
shifted by a number count the roots above it, copies included: bisection by that count isolates a
root, exact signs refine it to ROOT_BITS bits. Components are the null spaces of the
matrix less a root: inverse iteration in decimal arithmetic of DIGITS digits, with the vectors of
one multiple root orthogonal to each other.

Rows are read in Spark only: quantised and written, folded to distinct vectors by an aggregation,
summed in the tasks and whitened in the tasks. What the driver holds depends on the number
of dimensions alone.

Defined cases: a null vector, an empty one, and one with a null or non-finite entry give no row; of
vectors of several lengths those of the most frequent length (of equally frequent ones the
longest) are taken; entries beyond 64 bits are set to the nearest number of 64 bits; a null
id is carried along; rows that repeat an id or a vector each get their rows, but a vector is
fitted once; a component without variance gives no row, so there are as many as the rank
at most, and none for a single distinct vector; equal eigenvalues get an orthonormal basis of
their space; ``deviation`` beyond 38 digits is null; columns other than the id and the vector are
not read; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from itertools import count
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmdyn.session import stash

#: Entries are multiples of 1 / SCALE, rounded down.
SCALE = 256
#: Bits of a root relative to the trace, and decimal digits of the inverse iteration.
ROOT_BITS, DIGITS = 256, 160
#: Primes lie below 2^PRIME_BITS, so that a product of two residues fits 64 bits.
PRIME_BITS = 31
#: Rows that are multiplied at once, and bits of a limb of a partial sum.
BLOCK_ROWS, LIMB_BITS = 4096, 40

_WIDTHS = (np.dtype("<i2"), np.dtype("<i4"), np.dtype("<i8"))


# quantised vectors

def quantise(values: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        scaled = np.floor(values * SCALE)
    return np.clip(scaled, -float(2**63), float(2**63 - 1024)).astype(np.int64)


def _pack(x: np.ndarray) -> list[bytes]:
    """Rows as bytes of the smallest of 2, 4 and 8 bytes an entry that holds the row."""
    top = np.maximum(x.max(axis=1), ~x.min(axis=1)) if x.shape[1] else np.zeros(len(x), np.int64)
    out: list[bytes] = [b""] * len(x)
    for width, low in zip(_WIDTHS, (0, 1 << 15, 1 << 31)):
        rows = np.flatnonzero((top >= low) & (top < 1 << (8 * width.itemsize - 1) if width.itemsize < 8 else top >= low))
        for i, row in zip(rows.tolist(), x[rows].astype(width)):
            out[i] = row.tobytes()
    return out


def unpack(rows: pa.Array, d: int) -> np.ndarray:
    """Rows of packed vectors of ``d`` entries as one matrix."""
    out = np.empty((len(rows), d), np.int64)
    sizes = np.array([len(r.as_buffer()) if r.is_valid else 0 for r in rows]) // d
    for width in _WIDTHS:
        own = np.flatnonzero(sizes == width.itemsize)
        if len(own):
            out[own] = np.frombuffer(b"".join(rows.take(pa.array(own)).to_pylist()), width).reshape(len(own), d)
    return out


def _quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            vectors = part.column("vector").cast(pa.list_(pa.float64()))
            sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null entries are NaN
            owner = np.repeat(np.arange(len(sizes)), sizes)
            broken = np.bincount(owner, ~np.isfinite(flat), len(sizes)) > 0
            starts = np.cumsum(sizes) - sizes
            keep, packed = np.flatnonzero((sizes > 0) & ~broken), {}
            for d in np.unique(sizes[keep]).tolist():
                own = keep[sizes[keep] == d]
                packed |= zip(own.tolist(), _pack(quantise(flat[starts[own][:, None] + np.arange(d)])))
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(keep)), pa.array(sizes[keep].astype(np.int32)),
                 pa.array([packed[i] for i in keep.tolist()], pa.binary())], ["id", "d", "x"])


# the integer scatter

def gram(x: np.ndarray) -> np.ndarray:
    """x' x without rounding: in doubles while every sum is exact, else in whole numbers."""
    top = int(np.abs(x.astype(np.float64)).max(initial=0)) + 1
    if top * top * len(x) < 1 << 53:
        x = x.astype(np.float64)
        return (x.T @ x).astype(np.int64).astype(object)
    x = x.astype(object)
    return x.T.dot(x)


def _sums(d: int):
    """The task's sum of products of (1, x), in limbs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d + 1, d + 1), dtype=object)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                x = unpack(batch.column("x").slice(at, BLOCK_ROWS), d)
                total += gram(np.hstack([np.ones((len(x), 1), np.int64), x]))
        i, j, limb, value = [], [], [], []
        for a in range(d + 1):
            for b in range(a, d + 1):
                rest, sign = abs(int(total[a, b])), 1 if total[a, b] >= 0 else -1
                for nth in count():
                    if not rest:
                        break
                    i.append(a), j.append(b), limb.append(nth)
                    value.append(sign * (rest & ((1 << LIMB_BITS) - 1)))
                    rest >>= LIMB_BITS
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(limb, pa.int32()),
                                          pa.array(value, pa.int64())], ["i", "j", "limb", "value"])

    return run


def moments(distinct: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """The number of vectors, their sums by dimension, and n * sum(x x') - S S'."""
    parts = distinct.select("x").mapInArrow(_sums(d), "i int, j int, limb int, value long")
    total = np.zeros((d + 1, d + 1), dtype=object)
    for r in parts.groupBy("i", "j", "limb").agg(F.sum("value").alias("value")).collect():
        total[r.i, r.j] += r.value << (LIMB_BITS * r.limb)
    total = total + np.triu(total, 1).T
    n, sums = int(total[0, 0]), [int(v) for v in total[0, 1:]]
    return n, sums, [[n * int(total[a + 1, b + 1]) - sums[a] * sums[b] for b in range(d)] for a in range(d)]


# the characteristic polynomial

def is_prime(n: int) -> bool:
    """Exact below 3.3e24 (strong pseudoprimes to the first twelve primes start there)."""
    small = (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37)
    if n < 2 or any(n % p == 0 for p in small):
        return n in small
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for a in small:
        x = pow(a, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(limit: int) -> list[int]:
    """The largest primes below 2^PRIME_BITS whose product is beyond ``limit``."""
    found, product, p = [], 1, (1 << PRIME_BITS) + 1
    while product <= limit:
        p -= 2
        if is_prime(p):
            found.append(p)
            product *= p
    return found


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """An upper Hessenberg matrix similar to ``a`` modulo ``p``."""
    a, d = a.copy(), len(a)
    for k in range(d - 2):
        below = np.flatnonzero(a[k + 1:, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            a[[k + 1, pivot]] = a[[pivot, k + 1]]
            a[:, [k + 1, pivot]] = a[:, [pivot, k + 1]]
        factor = a[k + 2:, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2:] = (a[k + 2:] - factor[:, None] * a[k + 1] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2:] * factor % p).sum(axis=1)) % p
    return a


def polynomial_modulo(matrix: list[list[int]], p: int) -> list[int]:
    """det(t - matrix) modulo ``p``, from the constant term up to t^d."""
    d = len(matrix)
    h = hessenberg(np.array([[v % p for v in row] for row in matrix], np.int64).reshape(d, d), p)
    minors = np.zeros((d + 1, d + 1), np.int64)  # of the leading blocks
    minors[0, 0] = 1
    for k in range(d):
        weights = np.zeros(k + 1, np.int64)  # of the smaller minors
        product = 1
        for i in range(k, -1, -1):
            weights[i] = int(h[i, k]) * product % p
            if i:
                product = product * int(h[i, i - 1]) % p
        lower = (minors[:k + 1] * weights[:, None] % p).sum(axis=0) % p
        minors[k + 1, 1:] = minors[k, :-1]
        minors[k + 1] = (minors[k + 1] - lower) % p
    return minors[d].tolist()


def _residues(matrix: list[list[int]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            primes = batch["prime"].tolist()
            yield pd.DataFrame({"prime": primes, "residues": [polynomial_modulo(matrix, p) for p in primes]})

    return run


def remaindered(residues: dict[int, list[int]]) -> list[int]:
    """The smallest non-negative numbers with the given residues, by prime."""
    values, product = [0] * len(next(iter(residues.values()))), 1
    for p, found in residues.items():
        inverse = pow(product, -1, p)
        values = [v + product * ((r - v) * inverse % p) for v, r in zip(values, found)]
        product *= p
    return values


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """det(t - matrix) of a symmetric integer matrix without negative eigenvalues, from the constant
    term up. The k-th elementary symmetric sum of its eigenvalues is at most
    binomial(d, k) * (trace / d)^k, which bounds the primes that are needed."""
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    limit = max((comb(d, k) * trace**k // d**k + 1) for k in range(d + 1))
    primes = primes_for(limit << PRIME_BITS)  # one prime more than needed
    rows = spark.createDataFrame([(p,) for p in primes], "prime long").repartition(min(len(primes), 32))
    found = {r.prime: r.residues for r in rows.mapInPandas(_residues(matrix), "prime long, residues array<long>").collect()}
    # signs alternate, as no eigenvalue is negative
    signs = [1 if (d - k) % 2 == 0 else -1 for k in range(d + 1)]
    residues = {p: [s * r % p for s, r in zip(signs, found[p])] for p in primes}
    values = remaindered(residues)
    if max(values) > limit:
        raise ArithmeticError("residues of the characteristic polynomial do not agree")
    return [s * v for s, v in zip(signs, values)]


# its roots

def roots_above(poly: list[int], a: int, bits: int) -> int:
    """How many roots lie above a / 2^bits, copies included: sign variations of the polynomial
    moved there, exact as all roots are real."""
    d = len(poly) - 1
    c = [v << (bits * (d - k)) for k, v in enumerate(poly)]
    for low in range(d):
        for k in range(d - 1, low - 1, -1):
            c[k] += a * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _sign(poly: list[int], a: int, bits: int) -> int:
    """Of the value at a / 2^bits."""
    value = 0
    for k, v in enumerate(reversed(poly)):
        value = value * a + (v << (bits * k))
    return (value > 0) - (value < 0)


def root(poly: list[int], nth: int, trace: int) -> tuple[int, int]:
    """(a, bits): the nth largest root, copies included, is at most a / 2^bits and less than
    trace / 2^ROOT_BITS below it."""
    bits, low, high = 0, -1, 1 << trace.bit_length()
    above_low, above_high = len(poly) - 1, 0
    while (high - low) << ROOT_BITS > trace << bits:
        if above_low - above_high == 1:
            break
        bits, low, high = bits + 1, 2 * low, 2 * high
        middle = (low + high) // 2
        above = roots_above(poly, middle, bits)
        if above >= nth:
            low, above_low = middle, above
        else:
            high, above_high = middle, above
    at_high = _sign(poly, high, bits)
    while (high - low) << ROOT_BITS > trace << bits and at_high:
        bits, low, high = bits + 1, 2 * low, 2 * high
        middle = (low + high) // 2
        at_middle = _sign(poly, middle, bits)
        if at_middle in (0, at_high):
            high, at_high = middle, at_middle
        else:
            low = middle
    return high, bits


# components

def _factors(matrix: list[list[int]], shift: Decimal, tiny: Decimal) -> tuple[list[list[Decimal]], list[int]]:
    """LU factors of matrix - shift with row exchanges; a pivot that vanishes becomes ``tiny``."""
    d = len(matrix)
    a = [[Decimal(v) - (shift if i == j else 0) for j, v in enumerate(row)] for i, row in enumerate(matrix)]
    order = list(range(d))
    for k in range(d):
        best = max(range(k, d), key=lambda i: abs(a[i][k]))
        a[k], a[best], order[k], order[best] = a[best], a[k], order[best], order[k]
        if abs(a[k][k]) < tiny:
            a[k][k] = tiny
        top = a[k]
        for i in range(k + 1, d):
            row = a[i]
            if row[k]:
                f = row[k] = row[k] / top[k]
                for j in range(k + 1, d):
                    row[j] -= f * top[j]
    return a, order


def _solve(factors: list[list[Decimal]], order: list[int], b: list[Decimal]) -> list[Decimal]:
    d = len(b)
    y = [b[i] for i in order]
    for i in range(d):
        y[i] -= sum((factors[i][j] * y[j] for j in range(i)), Decimal(0))
    for i in range(d - 1, -1, -1):
        y[i] = (y[i] - sum((factors[i][j] * y[j] for j in range(i + 1, d)), Decimal(0))) / factors[i][i]
    return y


def _orthonormal(v: list[Decimal], others: list[list[Decimal]]) -> list[Decimal]:
    for _ in range(2):
        for u in others:
            along = sum(x * y for x, y in zip(u, v))
            v = [y - along * x for x, y in zip(u, v)]
        length = sum(x * x for x in v).sqrt()
        v = [x / length for x in v]
    return v


def components(matrix: list[list[int]], poly: list[int], n_components: int) -> list[tuple[Decimal, list[Decimal]]]:
    """(eigenvalue, unit eigenvector) by falling eigenvalue, those above zero alone."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    rank = d - next((k for k, v in enumerate(poly) if v), d)
    out: list[tuple[Decimal, list[Decimal]]] = []
    with localcontext() as context:
        context.prec = DIGITS
        near = Decimal(trace) / 2**(ROOT_BITS - 8)  # copies of one root are not told apart below it
        tiny = Decimal(max(trace, 1)).scaleb(10 - DIGITS)
        factors = order = None
        for nth in range(1, min(n_components, rank) + 1):
            a, bits = root(poly, nth, trace)
            value = Decimal(a) / 2**bits
            if not out or out[-1][0] - value > near:
                factors, order, same = *_factors(matrix, value, tiny), []
            rng = np.random.default_rng(nth)
            v = _orthonormal([Decimal(int(x)) for x in rng.integers(1, 1 << 30, d)], same)
            for _ in range(3):
                v = _orthonormal(_solve(factors, order, v), same)
            if v[max(range(d), key=lambda i: abs(v[i]))] < 0:
                v = [-x for x in v]
            same.append(v)
            out.append((value, v))
    return out


# the operator

@dataclass(frozen=True)
class Whitening:
    """What whitens a quantised vector: its sums, and the components as doubles."""
    n: int
    sums: list[int]
    eigenvalues: list[float]
    explained: list[float]
    vectors: np.ndarray  # d x components

    def whiten(self, x: np.ndarray) -> np.ndarray:
        with localcontext() as context:
            context.prec = DIGITS
            whole = [s // self.n for s in self.sums]
            rest = np.array([float(Decimal(s - w * self.n) / self.n) for s, w in zip(self.sums, whole)])
        small = max(map(abs, whole), default=0) < 1 << 62 and np.abs(x.astype(np.float64)).max(initial=0) < 1 << 62
        centred = x - np.array(whole, np.int64) if small else (x.astype(object) - np.array(whole, object)).astype(np.float64)
        return (centred - rest) @ self.vectors / np.sqrt(self.eigenvalues)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n * x - S)^2."""
        top = self.n * (int(np.abs(x.astype(np.float64)).max(initial=0)) + 1) + max(map(abs, self.sums), default=0)
        kind = np.int64 if top * top * x.shape[1] < 1 << 62 else object
        apart = self.n * x.astype(kind) - np.array(self.sums, kind)
        return [int(v) if int(v) < 10**38 else None for v in (apart * apart).sum(axis=1)]


def fit(distinct: DataFrame, d: int, n_components: int) -> Whitening | None:
    """The whitening of a table of distinct packed vectors (x), or None if nothing varies."""
    n, sums, matrix = moments(distinct, d)
    trace = sum(matrix[i][i] for i in range(d))
    if not trace:
        return None
    found = components(matrix, characteristic_polynomial(distinct.sparkSession, matrix), n_components)
    with localcontext() as context:
        context.prec = DIGITS
        return Whitening(n, sums, [float(e / n / n) for e, _ in found], [float(e / trace) for e, _ in found],
                         np.array([[float(x) for x in v] for _, v in found]).T)


def _whitened(model: Whitening, d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = unpack(part.column("x"), d)
                w, k = model.whiten(x), model.vectors.shape[1]
                row = pa.array(np.repeat(np.arange(len(x)), k))
                deviation = pa.array([None if v is None else Decimal(v) for v in model.deviation(x)], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(row), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     deviation.take(row), pa.array(w.ravel())], ["id", "component", "deviation", "whitened"])

    return run


def _identity_error(distinct: DataFrame, model: Whitening, d: int) -> float:
    """The largest entry of the whitened covariance of the fitted vectors less the identity."""
    k = model.vectors.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = model.whiten(unpack(batch.column("x"), d))
            yield pa.RecordBatch.from_arrays([pa.array(w[:, i]) for i in range(k)], [f"w{i}" for i in range(k)])

    w = stash(distinct.select("x").mapInArrow(run, ", ".join(f"w{i} double" for i in range(k))))
    means = w.agg(*[F.avg(f"w{i}") for i in range(k)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = w.agg(*[F.avg((F.col(f"w{i}") - means[i]) * (F.col(f"w{j}") - means[j])) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs))


def whiten_embeddings(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *,
                      n_components: int = 4) -> DataFrame:
    """One row per vector and component: id, component (from 1), n (distinct vectors), deviation
    (decimal), whitened, explained and identity_error."""
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType.simpleString()
    rows = stash(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")).mapInArrow(
        _quantised, f"id {id_type}, d int, x binary"))
    usual = rows.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    schema = f"id {id_type}, component int, deviation decimal(38,0), whitened double"
    model = None
    if usual:
        d = usual[0]["d"]
        rows = rows.where(F.col("d") == d)
        distinct = stash(rows.select("x").distinct())
        model = fit(distinct, d, n_components)
    if model is None:
        found, error = spark.createDataFrame([], schema), None
        n, explained = 0, [0.0]
    else:
        found, error = rows.select("id", "x").mapInArrow(_whitened(model, d), schema), _identity_error(distinct, model, d)
        n, explained = model.n, model.explained
    share = F.element_at(F.array(*[F.lit(v) for v in explained]), F.col("component"))
    return found.select(
        F.col("id").alias(id_col), "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        share.alias("explained"), F.lit(error).cast("double").alias("identity_error"))
