"""Embedding whitening by an exact characteristic polynomial.

The scatter of integer vectors is summed exactly. Its characteristic polynomial comes
from one Hessenberg reduction for each of many primes, run as Spark tasks and joined by
Chinese remaindering. As all roots are real, the signs of the polynomial's coefficients
about a point count the roots above it without error: bisection isolates each of the
largest roots, with its multiplicity. Inverse iteration in long fixed-point numbers then
finds the null space of the scatter minus the root.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.tables import by_place, place, stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
PRECISE = 128  # bits of a root beyond the largest root's
PRIMES_A_TASK = 32
_HALF = 60  # exact sums travel in two parts, the lower one of so many bits
_EXACT = 53  # integers that a double holds
_LIMB = 16

_SUMS = "dim int, i int, j int, high decimal(38,0), low decimal(38,0)"


# --- the exact scatter ------------------------------------------------------------


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, values): the usable rows of one length, and their entries as doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.values.cast(pa.float64()) if len(column.values) else pa.array([], pa.float64())
    values = flat.to_numpy(zero_copy_only=False)  # null entries become NaN
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    first = column.offsets.to_numpy()[:-1]
    good = (bad[first + lengths] == bad[first]) & (lengths > 0)
    if column.null_count:
        good &= column.is_valid().to_numpy(zero_copy_only=False)
    for size in np.unique(lengths[good]):
        rows = np.flatnonzero(good & (lengths == size))
        yield rows, values[first[rows][:, None] + np.arange(size)[None, :]]


def _integers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * value), as 64-bit integers, or as Python's where they are too long."""
    scaled = np.floor(values * SCALE)
    if not len(scaled) or np.abs(scaled).max() < 2.0**62:
        return scaled.astype(np.int64)
    if not np.isfinite(scaled).all():
        raise ValueError("an entry is too large for whitening")
    return np.array([[int(x) for x in row] for row in scaled], dtype=object)


def _gram(x: np.ndarray) -> np.ndarray:
    """x.T @ x, exact, as Python integers. Products run in double precision on limbs that
    are short enough for every sum to be exact."""
    top = int(np.abs(x).max()) if len(x) else 0
    if 2 * top.bit_length() + len(x).bit_length() <= _EXACT:
        own = x.astype(np.float64)
        return (own.T @ own).astype(np.int64).astype(object)
    limbs, rest = [], x
    while top:
        low = rest & ((1 << _LIMB) - 1)
        limbs.append(low.astype(np.float64))
        rest = rest >> _LIMB
        top >>= _LIMB
    limbs.append(rest.astype(np.float64))  # the sign: 0 or -1
    total = np.zeros((x.shape[1], x.shape[1]), dtype=object)
    for a, one in enumerate(limbs):
        for b, other in enumerate(limbs):
            total += (one.T @ other).astype(np.int64).astype(object) << (_LIMB * (a + b))
    return total


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each length of vector: the rows (i = j = -1), the sums (i = -1) and the sums of
    products (i <= j) of the integer vectors without SHIFT, which changes no scatter."""
    rows: dict[int, int] = {}
    sums: dict[int, np.ndarray] = {}
    products: dict[int, np.ndarray] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, 1 << 14):
            for _, values in _vectors(batch.column(0).slice(at, 1 << 14)):
                x = _integers(values)
                size = x.shape[1]
                rows[size] = rows.get(size, 0) + len(x)
                sums[size] = sums.get(size, 0) + x.astype(object).sum(axis=0)
                products[size] = products.get(size, 0) + _gram(x)
    out = []
    for size, n in rows.items():
        out.append((size, -1, -1, n))
        out += [(size, -1, j, int(s)) for j, s in enumerate(sums[size])]
        out += [(size, i, j, int(products[size][i, j])) for i in range(size) for j in range(i, size)]
    kind = pa.decimal128(38, 0)
    yield pa.RecordBatch.from_arrays(
        [
            *(pa.array([r[k] for r in out], pa.int32()) for k in range(3)),
            pa.array([r[3] >> _HALF for r in out], pa.int64()).cast(kind)
            if all(abs(r[3]) < 1 << 122 for r in out)
            else _too_large(),
            pa.array([r[3] & ((1 << _HALF) - 1) for r in out], pa.int64()).cast(kind),
        ],
        names=["dim", "i", "j", "high", "low"],
    )


def _too_large():
    raise ValueError("entries are too large for whitening")


class Fit(NamedTuple):
    """n vectors, the sums of their integer entries (without SHIFT), and the scatter
    n * sum(x x') - sum(x) sum(x)', which is n * n times the covariance."""

    n: int
    sums: list[int]
    scatter: list[list[int]]


def _fit(spark: SparkSession, vectors: DataFrame) -> Fit | None:
    """The exact sums. The space is that of most vectors (the longer of equals)."""
    found = stored(
        vectors.mapInArrow(_scatter, _SUMS)
        .groupBy("dim", "i", "j")
        .agg(F.sum("high").alias("high"), F.sum("low").alias("low")),
        "scatter",
    )
    value = lambda r: (int(r["high"]) << _HALF) + int(r["low"])
    most = found.where("i = -1 AND j = -1").orderBy(F.desc("low"), F.desc("dim")).head()
    if most is None:
        return None
    size, n = most["dim"], value(most)
    sums = [0] * size
    products = [[0] * size for _ in range(size)]
    for row in found.where((F.col("dim") == size) & (F.col("j") >= 0)).collect():  # size * size rows
        if row["i"] < 0:
            sums[row["j"]] = value(row)
        else:
            products[row["i"]][row["j"]] = products[row["j"]][row["i"]] = value(row)
    scatter = [[n * products[i][j] - sums[i] * sums[j] for j in range(size)] for i in range(size)]
    return Fit(n, sums, scatter)


# --- the characteristic polynomial -------------------------------------------------


def primes(count: int) -> list[int]:
    """The ``count`` largest primes below 2**31, so that products fit 64 bits."""
    out, at = [], (1 << 31) - 1
    small = [p for p in range(3, 1 << 16, 2) if all(p % q for q in range(3, math.isqrt(p) + 1, 2))]
    tests = np.array(small)
    while len(out) < count:
        if (at % tests != 0).all():
            out.append(at)
        at -= 2
    return out


def _powered(a: np.ndarray, exponent: np.ndarray, p: np.ndarray) -> np.ndarray:
    out, base, e = np.ones_like(a), a % p, exponent.copy()
    while e.any():
        out = np.where(e & 1, out * base % p, out)
        base = base * base % p
        e >>= 1
    return out


def characteristic(matrix: np.ndarray, p: np.ndarray) -> np.ndarray:
    """det(x - A) modulo each prime, coefficients by rising power. ``matrix`` is (primes,
    size, size), reduced; all primes go through the Hessenberg reduction together."""
    h = matrix.copy()
    count, size, _ = h.shape
    every = np.arange(count)
    one, two = p[:, None], p[:, None, None]
    for k in range(1, size - 1):
        below = h[:, k:, k - 1] != 0
        pivot = np.argmax(below, axis=1) + k
        for axis in (1, 2):  # the same exchange of rows and of columns
            a = h[every, pivot] if axis == 1 else h[every, :, pivot]
            b = (h[:, k] if axis == 1 else h[:, :, k]).copy()
            if axis == 1:
                h[every, pivot], h[:, k] = b, a
            else:
                h[every, :, pivot], h[:, :, k] = b, a
        inverse = _powered(h[:, k, k - 1], p - 2, p)  # 0 where nothing is left to remove
        factor = h[:, k + 1 :, k - 1] * inverse[:, None] % one
        h[:, k + 1 :, :] = (h[:, k + 1 :, :] - factor[:, :, None] * h[:, k, None, :] % two) % two
        back = np.zeros((count, size), dtype=np.int64)
        for at in range(size - k - 1):
            back = (back + h[:, :, k + 1 + at] * factor[:, at, None] % one) % one
        h[:, :, k] = (h[:, :, k] + back) % one
    polynomials = np.zeros((size + 1, count, size + 1), dtype=np.int64)
    polynomials[0, :, 0] = 1
    for k in range(1, size + 1):
        last = polynomials[k - 1]
        new = np.zeros_like(last)
        new[:, 1:] = last[:, :-1]
        new = (new - h[:, k - 1, k - 1, None] * last % one) % one
        product = np.ones(count, dtype=np.int64)
        for i in range(k - 1, 0, -1):
            product = product * h[:, i, i - 1] % p
            new = (new - (h[:, i - 1, k - 1] * product % p)[:, None] * polynomials[i - 1] % one) % one
        polynomials[k] = new
    return polynomials[size]


def _polynomial(spark: SparkSession, scatter: list[list[int]]) -> list[int]:
    """det(x - scatter) as integers, by rising power: residues for each prime come from
    Spark tasks, as many primes as the coefficients' bound needs."""
    size = len(scatter)
    # Roots are not negative and their sum is the trace, so a coefficient is at most
    # (1 + trace) ** size.
    bits = 2 + size * (1 + sum(scatter[i][i] for i in range(size))).bit_length()
    of = primes(-(-bits // 30))
    shared = spark.sparkContext.broadcast(scatter)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("prime").to_numpy()
            for at in range(0, len(own), PRIMES_A_TASK):
                p = own[at : at + PRIMES_A_TASK]
                reduced = np.array([[[x % q for x in row] for row in shared.value] for q in p.tolist()], dtype=np.int64)
                found = characteristic(reduced, p)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p), pa.array(found.tolist(), pa.list_(pa.int64()))], names=["prime", "residues"]
                )

    table = spark.createDataFrame([(q,) for q in of], "prime long")
    tasks = -(-len(of) // PRIMES_A_TASK)
    found = table.repartition(tasks).mapInArrow(run, "prime long, residues array<long>").collect()
    shared.unpersist()
    # Chinese remaindering, of neighbours until one modulus is left.
    parts = [(r["prime"], r["residues"]) for r in found]
    while len(parts) > 1:
        joined = []
        for (m, a), (q, b) in zip(parts[::2], parts[1::2]):
            inverse = pow(m, -1, q)
            joined.append((m * q, [x + m * ((y - x) * inverse % q) for x, y in zip(a, b)]))
        parts = joined + parts[2 * len(joined) :]
    modulus, values = parts[0]
    return [v - modulus if 2 * v > modulus else v for v in values]


# --- roots and null spaces ---------------------------------------------------------


def roots_above(polynomial: list[int], point: int, bits: int = 0) -> int:
    """How many roots, counted as often as they occur, lie above point / 2**bits. All
    roots are real, so it is the number of sign changes about the point (Descartes)."""
    size = len(polynomial) - 1
    shifted = [c << (bits * (size - k)) for k, c in enumerate(polynomial)]
    for i in range(size):
        for j in range(size - 1, i - 1, -1):
            shifted[j] += point * shifted[j + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def isolated(polynomial: list[int], k: int) -> tuple[int, int, int, int]:
    """The k-th largest root lies above low / 2**bits and not above high / 2**bits, which
    are 2**-bits apart; last, how many roots lie above high / 2**bits."""
    size = len(polynomial) - 1
    total = max(-polynomial[size - 1], 0)  # the sum of the roots, none of them negative
    bits = max(0, PRECISE - total.bit_length())
    low, high, over = -1, (total << bits) + 1, 0
    # Coarse steps first: few bits make short numbers.
    while high - low > 1:
        drop = max(0, (high - low).bit_length() - 24)
        middle = ((low + high) // 2 >> drop) << drop
        if not low < middle < high:
            middle = (low + high) // 2
        cut = min(bits, (middle & -middle).bit_length() - 1) if middle else bits
        n = roots_above(polynomial, middle >> cut, bits - cut)
        if n >= k:
            low = middle
        else:
            high, over = middle, n
    return low, high, bits, over


def _solved(matrix: np.ndarray, right: np.ndarray, one: int) -> np.ndarray:
    """matrix y = right in fixed-point numbers of ``one`` parts, with pivoting."""
    a = np.concatenate((matrix, right[:, None]), axis=1)
    size = len(matrix)
    for k in range(size):
        pivot = max(range(k, size), key=lambda i: abs(a[i, k]))
        a[[k, pivot]] = a[[pivot, k]]
        if a[k, k] == 0:
            a[k, k] = 1  # the root itself: any small pivot leads to the null space
        factor = a[k + 1 :, k] * one // a[k, k]
        a[k + 1 :, k:] -= factor[:, None] * a[k, None, k:] // one
    y = np.zeros(size, dtype=object)
    for k in range(size - 1, -1, -1):
        rest = a[k, size] - (sum(a[k, k + 1 : size] * y[k + 1 :]) // one if k + 1 < size else 0)
        y[k] = rest * one // a[k, k]
    return y


def _unit(y: np.ndarray, one: int) -> np.ndarray:
    length = math.isqrt(sum(v * v for v in y))
    return np.array([v * one // length for v in y], dtype=object) if length else y


def null_vector(scatter: list[list[int]], root: tuple[int, int], place: int) -> np.ndarray:
    """A unit vector that (scatter - root) makes nothing of, by inverse iteration; for a
    root that occurs several times the ``place``-th of an orthogonal set."""
    size = len(scatter)
    top, bits = root
    extra = 64
    largest = max(1, max(abs(x) for row in scatter for x in row)).bit_length()
    one = 1 << (2 * PRECISE + extra + 2 * size.bit_length())
    # Scaled so that entries are about 1.
    scaled = np.array(
        [[(((x << bits) - (top if i == j else 0)) * one) >> (bits + largest) for j, x in enumerate(row)] for i, row in enumerate(scatter)],
        dtype=object,
    )
    found: list[np.ndarray] = []
    for k in range(place + 1):
        # Starts differ in every entry and have no structure of their own.
        seed = np.random.default_rng(20240312 + k).integers(1, 1 << 30, size)
        y = np.array([int(v) * one >> 30 for v in seed], dtype=object)
        for _ in range(3):
            for other in found:
                y = y - other * (sum(y * other) // one) // one
            y = _unit(_solved(scaled, _unit(y, one), one), one)
        for other in found:
            y = y - other * (sum(y * other) // one) // one
        found.append(_unit(y, one))
    return np.array([v / one for v in found[-1]], dtype=np.float64)


class Component(NamedTuple):
    component: int
    root: float  # eigenvalue of the scatter over n * n: of the covariance
    share: float
    vector: list[float]


def _components(spark: SparkSession, fit: Fit, most: int) -> list[Component]:
    """The largest ``most`` components with a positive eigenvalue, each found by its own task."""
    trace = sum(fit.scatter[i][i] for i in range(len(fit.scatter)))
    if not trace:
        return []
    polynomial = _polynomial(spark, fit.scatter)
    positive = roots_above(polynomial, 0)
    shared = spark.sparkContext.broadcast((fit.n, fit.scatter, polynomial, trace))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, scatter, polynomial, trace = shared.value
            for k in batch.column("component").to_pylist():
                low, high, bits, over = isolated(polynomial, k)
                middle = low + high  # over 2 ** (bits + 1)
                vector = null_vector(scatter, (middle, bits + 1), k - 1 - over)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k], pa.int32()),
                        pa.array([middle / ((n * n) << (bits + 1))]),
                        pa.array([middle / (trace << (bits + 1))]),
                        pa.array([vector.tolist()], pa.list_(pa.float64())),
                    ],
                    names=["component", "root", "share", "vector"],
                )

    count = min(most, positive)
    wanted = spark.createDataFrame([(k + 1,) for k in range(count)], "component int").repartition(count, "component")
    rows = wanted.mapInArrow(run, "component int, root double, share double, vector array<double>").collect()
    shared.unpersist()
    return sorted(Component(*row) for row in rows)


# --- whitening ---------------------------------------------------------------------


def _centred(values: np.ndarray, fit: Fit) -> tuple[np.ndarray, list[int]]:
    """x - S / n as doubles, and the exact sum of (n * x - S) ** 2, of each row."""
    x = _integers(values)
    top = int(np.abs(x).max()) if len(x) else 0
    reach = fit.n * top + max(map(abs, fit.sums))
    if reach.bit_length() < _EXACT and x.shape[1] * reach * reach < 1 << 63:
        apart = fit.n * x - np.array(fit.sums, dtype=np.int64)
        return apart / fit.n, (apart * apart).sum(axis=1).tolist()
    apart = fit.n * x.astype(object) - np.array(fit.sums, dtype=object)
    return np.array([[v / fit.n for v in row] for row in apart], dtype=np.float64), [sum(v * v for v in row) for row in apart]


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error,
    deviation_exact): a row for each usable vector and component.

    ``vectors`` has vec_id and embedding. An entry c counts as floor(SCALE * c) + SHIFT,
    an integer. Rows whose embedding is null or empty, or has null or infinite entries or
    NaN, are dropped; so are those of another length than most. Every other row belongs to the
    fit, repeated rows as often as they stand there. Components are numbered from 1 by
    falling eigenvalue, at most ``most`` and only those with an eigenvalue above 0: equal
    vectors, one vector and an empty table give no rows. Of equal eigenvalues the
    components are an orthogonal set that depends on the scatter alone. ``deviation`` is
    null where it is beyond 64 bits, ``deviation_exact`` where beyond 38 digits.
    ``identity_error`` is measured on the whitened values of all rows. Entries whose exact
    sums need more than 122 bits end with an error.

    The driver gets the square of the vectors' length in sums and, for some 30 bits of the
    polynomial's coefficients, one residue each; tasks get the scatter.
    """
    spark = vectors.sparkSession
    plain = by_place(vectors)
    rows = plain.select(
        plain[place(vectors, "embedding")].cast("array<double>").alias("embedding"),
        plain[place(vectors, "vec_id")].cast("long").alias("vec_id"),
    )
    schema = (
        "vec_id long, deviation decimal(38,0), "
        "whitened array<double>"
    )
    fit = _fit(spark, rows.select("embedding"))
    found = _components(spark, fit, most) if fit else []
    shared = spark.sparkContext.broadcast((fit, found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, found = shared.value
        axes = np.array([[v / math.sqrt(c.root) for v in c.vector] for c in found]).T
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 14):
                part = batch.slice(at, 1 << 14)
                for rows, values in _vectors(part.column("embedding")):
                    if values.shape[1] != len(fit.sums):
                        continue
                    centred, deviations = _centred(values, fit)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("vec_id").take(pa.array(rows)),
                            pa.array([d if d < 10**38 else None for d in map(int, deviations)], pa.decimal128(38, 0)),
                            pa.array((centred @ axes).tolist(), pa.list_(pa.float64())),
                        ],
                        names=["vec_id", "deviation", "whitened"],
                    )

    result = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"
    if not found:
        return spark.createDataFrame([], result)
    whitened = stored(rows.mapInArrow(run, schema), "whitened")
    error = _identity_error(whitened, len(found))
    explained = F.lit([c.share for c in found])
    return whitened.select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "value")
    ).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(fit.n).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        F.col("value").alias("whitened"),
        explained[F.col("place")].alias("explained"),
        F.lit(error).alias("identity_error"),
        F.col("deviation").alias("deviation_exact"),
    )


def _identity_error(whitened: DataFrame, count: int) -> float:
    """The largest entry of the whitened rows' covariance minus the identity: one row of
    means, then one row of sums of centred products."""
    entry = [F.col("whitened")[k] for k in range(count)]
    means = whitened.agg(*(F.avg(e).alias(f"m{k}") for k, e in enumerate(entry))).first()
    pairs = [(a, b) for a in range(count) for b in range(a, count)]
    centred = [e - F.lit(m) for e, m in zip(entry, means)]
    products = whitened.agg(*(F.avg(centred[a] * centred[b]).alias(f"p{a}_{b}") for a, b in pairs)).first()
    return max(abs(v - (a == b)) for (a, b), v in zip(pairs, products))
