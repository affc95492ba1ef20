"""Whitening of vectors by exact arithmetic: the integer scatter's characteristic polynomial, its largest roots, their vectors.

Spark sums the scatter over all rows, and computes the polynomial modulo one prime per row; the driver sees only what the
dimension d bounds: d * d / 2 sums, and d + 1 residues per prime. All of that is integers of any length, so the eigenvalues and
components are exact to far below a double, whatever the entries' offset and however close or equal the eigenvalues are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tandem.llm.words import small
from tandem.workspace import settle

SCALE = 1024
#: Added to every scaled entry. It leaves all differences from the mean as they are, so sums are taken without it.
OFFSET = 100_000
#: Scaled entries lie within these bounds; larger ones, which no embedding has, are set to them.
LIMIT = 1 << 52
COMPONENTS = 8
#: Bits behind the point: of eigenvalues relative to the trace, and of the arithmetic that finds the vectors.
ROOT_BITS, VECTOR_BITS = 160, 320
LIMB = 1 << 62


# ---------------------------------------------------------------- rows


def usable(vector: Column, dimension: int) -> Column:
    """Vectors of this dimension without null, NaN or infinite entries."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce((F.size(vector) == dimension) & ~bad, F.lit(False))


def dimension_of(vectors: DataFrame, name: str) -> int:
    """The length most vectors have; of equally frequent ones the largest. 0 without vectors."""
    sizes = vectors.where(F.size(name) > 0).groupBy(F.size(name).alias("d")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return first["d"] if first else 0


def entries(column: pa.ListArray, d: int) -> np.ndarray:
    """floor(SCALE * c) per entry, without the offset: rows by dimensions."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.clip(np.floor(flat * SCALE), -LIMIT, LIMIT).astype(np.int64).reshape(-1, d)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a' b exactly, as Python integers: in doubles while every sum stays below 2^53, else in integers of any length."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * len(a)
    if most < 1 << 53:
        return (a.T.astype(np.float64) @ b.astype(np.float64)).astype(np.int64).astype(object)
    return a.T.astype(object) @ b.astype(object)


@dataclass(frozen=True)
class Scatter:
    """n, the sums per dimension, and n * sum(y y') - S S': n squared times the covariance, in integers."""

    n: int
    sums: list[int]
    matrix: list[list[int]]


def scatter(vectors: DataFrame, name: str, d: int) -> Scatter:
    """One pass: each task sends a row per pair of dimensions, which Spark adds up. Sums travel as two limbs."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros((d + 1, d + 1), object)
        for batch in small(batches):
            y = entries(batch.column(0), d)
            y = np.concatenate([np.ones((len(y), 1), np.int64), y], axis=1)
            total, n = total + products(y, y), n + len(y)
        if n:
            cells = [(i, j, int(total[i, j])) for i in range(d + 1) for j in range(i + 1)]
            columns = list(zip(*((i, j, v // LIMB, v % LIMB) for i, j, v in cells), strict=True))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["i", "j", "high", "low"])

    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    sent = vectors.select(name).mapInArrow(send, "i int, j int, high bigint, low bigint")
    rows = sent.groupBy("i", "j").agg(wide("high"), wide("low")).collect()
    total = {(r["i"], r["j"]): int(r["high"]) * LIMB + int(r["low"]) for r in rows}
    if not total:
        return Scatter(0, [0] * d, [[0] * d for _ in range(d)])
    n, sums = total[0, 0], [total[i + 1, 0] for i in range(d)]
    at = lambda i, j: total[max(i, j) + 1, min(i, j) + 1]
    return Scatter(n, sums, [[n * at(i, j) - sums[i] * sums[j] for j in range(d)] for i in range(d)])


# ---------------------------------------------------------------- characteristic polynomial


def primes_below(top: int, bits: int) -> list[int]:
    """Primes from `top` downwards until their product has more than `bits` bits. Products of two stay below 2^62."""
    found, product, n = [], 1, top | 1
    while product.bit_length() <= bits:
        n -= 2
        if is_prime(n):
            found.append(n)
            product *= n
    return found


def is_prime(n: int) -> bool:
    """Miller and Rabin's test, exact for odd numbers from 11 to 3.2 * 10^9 with these bases."""
    r = ((n - 1) & -(n - 1)).bit_length() - 1
    return all(any(pow(a, (n - 1) >> r, n) == 1 or pow(a, (n - 1) >> (k + 1), n) == n - 1 for k in range(r)) for a in (2, 3, 5, 7))


def hessenberg_mod(matrix: np.ndarray, p: int) -> np.ndarray:
    """A matrix modulo p that is similar to the given one and has zeros below its first subdiagonal."""
    h, d = matrix.copy(), len(matrix)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factor = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factor[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factor % p).sum(axis=1)) % p
    return h


def polynomial_mod(matrix: np.ndarray, p: int) -> list[int]:
    """Coefficients, constant first, of det(x - matrix) modulo p."""
    h, d = hessenberg_mod(matrix, p), len(matrix)
    minors = np.zeros((d + 1, d + 1), np.int64)
    minors[0, 0] = 1
    for k in range(d):
        row = np.roll(minors[k], 1) - h[k, k] * minors[k] % p
        chain = 1
        for i in range(k - 1, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            if not chain:
                break
            row = (row - chain * int(h[i, k]) % p * minors[i]) % p
        minors[k + 1] = row % p
    return minors[d].tolist()


def polynomial_of(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients, constant first, of det(x - matrix) for a symmetric matrix without negative eigenvalues.

    They are found modulo primes, one task row each, and put together by the Chinese remainder theorem. Their size is
    bounded by that of the elementary symmetric sums of d equal numbers with the same trace.
    """
    d, trace = len(matrix), sum(row[i] for i, row in enumerate(matrix))
    bits = 2 + max((math.comb(d, k) * trace**k // d**k + 1).bit_length() for k in range(d + 1))
    primes = primes_below((1 << 31) - 1, bits)
    flat = [int(v) for row in matrix for v in row]
    shared = spark.sparkContext.broadcast([str(v) for v in flat])

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = np.array([int(v) for v in shared.value], object).reshape(d, d)
        for batch in batches:
            for p in batch.column("p").to_pylist():
                row = polynomial_mod((values % p).astype(np.int64), p)
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([row], pa.list_(pa.int64()))], ["p", "c"])

    table = spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(min(len(primes), spark.sparkContext.defaultParallelism))
    found = {r["p"]: r["c"] for r in table.mapInArrow(residues, "p bigint, c array<bigint>").collect()}
    whole, product = [0] * (d + 1), 1
    for p in primes:
        inverse = pow(product, -1, p)
        whole = [w + product * ((r - w) * inverse % p) for w, r in zip(whole, found[p], strict=True)]
        product *= p
    return [w - product if 2 * w > product else w for w in whole]


# ---------------------------------------------------------------- roots


def _scaled(poly: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are 2^bits times as large."""
    d = len(poly) - 1
    return [c << bits * (d - k) for k, c in enumerate(poly)]


def roots_above(poly: list[int], at: int) -> int:
    """How many roots exceed `at`, with multiplicity: the sign changes of poly(x + at), which count exactly where all
    roots are real."""
    shifted, d = list(poly), len(poly) - 1
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            shifted[k] += at * shifted[k + 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def value_sign(poly: list[int], at: int) -> int:
    total = 0
    for c in reversed(poly):
        total = total * at + c
    return (total > 0) - (total < 0)


def largest_roots(poly: list[int], count: int, bits: int = ROOT_BITS) -> list[int]:
    """The `count` largest roots with multiplicity, falling, times 2^bits and rounded down to less than one unit.

    For polynomials whose roots are all real and not negative. Intervals are halved, by the number of roots above their
    middle, until each holds one root or has unit width; a root alone is then followed by the polynomial's sign.
    """
    scaled, d = _scaled(poly, bits), len(poly) - 1
    top = -poly[d - 1] << bits if d else 0
    found: list[int] = []
    # Intervals (low, high] with the number of roots above each end, the highest last.
    open_ = [(-1, top, d, 0)]
    while open_ and len(found) < count:
        low, high, above_low, above_high = open_.pop()
        n = above_low - above_high
        if not n:
            continue
        if high - low == 1:
            found += [high] * n
        elif n == 1:
            # A simple root, the sign changes there once.
            side = value_sign(scaled, high)
            while side and high - low > 1:
                middle = (low + high) // 2
                low, high = (low, middle) if value_sign(scaled, middle) in (0, side) else (middle, high)
            found.append(high)
        else:
            middle = (low + high) // 2
            above = roots_above(scaled, middle)
            open_ += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return found[:count]


# ---------------------------------------------------------------- components


def null_vectors(matrix: list[list[int]], roots: list[int], root_bits: int = ROOT_BITS, bits: int = VECTOR_BITS) -> list[list[int]]:
    """A unit vector per root, times 2^bits, each orthogonal to those before: inverse iteration in fixed-point integers.

    The matrix less the root is all but singular, so that solving with it turns any start into the null space, the
    better the more exact the root is. Equal roots give as many vectors, since each start is made orthogonal to the earlier.
    """
    d, one = len(matrix), 1 << bits
    trace = max(1, sum(row[i] for i, row in enumerate(matrix)))
    found: list[np.ndarray] = []
    for number, root in enumerate(roots):
        # In units of the trace, so that entries lie within one.
        a = np.array([[(v << bits) // trace for v in row] for row in matrix], object)
        shift = (root << bits - root_bits) // trace
        a[np.arange(d), np.arange(d)] -= shift
        solve = _elimination(a, bits)
        vector = np.array([one // (1 + (i * 7 + number * 3) % (d + 1)) for i in range(d)], object)
        for _ in range(3):
            vector = _unit(_orthogonal(vector, found, bits), bits)
            vector = _unit(_orthogonal(solve(vector), found, bits), bits)
        largest = max(range(d), key=lambda i: (abs(vector[i]) >> bits // 2, -i))
        found.append(vector if vector[largest] > 0 else -vector)
    return [list(v) for v in found]


def _orthogonal(vector: np.ndarray, others: list[np.ndarray], bits: int) -> np.ndarray:
    for _ in range(2):
        for other in others:
            vector = vector - other * int((vector * other).sum() >> bits) // (1 << bits)
    return vector


def _unit(vector: np.ndarray, bits: int) -> np.ndarray:
    norm = max(1, math.isqrt(int((vector * vector).sum())))
    return np.array([(int(v) << bits) // norm for v in vector], object)


def _elimination(a: np.ndarray, bits: int):
    """Gauss with the largest pivots; a pivot below one unit counts as one. Gives a function that solves for a vector."""
    a, d, steps = a.copy(), len(a), []
    for k in range(d):
        pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        a[[k, pivot]] = a[[pivot, k]]
        if a[k, k] == 0:
            a[k, k] = 1
        factor = np.array([(int(v) << bits) // int(a[k, k]) for v in a[k + 1 :, k]], object)
        steps.append((pivot, factor))
        if len(factor):
            a[k + 1 :, k:] = a[k + 1 :, k:] - (factor[:, None] * a[k, k:][None, :]) // (1 << bits)

    def solve(vector: np.ndarray) -> np.ndarray:
        x = vector.copy()
        for k, (pivot, factor) in enumerate(steps):
            x[[k, pivot]] = x[[pivot, k]]
            x[k + 1 :] = x[k + 1 :] - factor * x[k] // (1 << bits)
        for k in range(d - 1, -1, -1):
            rest = int(x[k]) - (int((a[k, k + 1 :] * x[k + 1 :]).sum()) >> bits if k + 1 < d else 0)
            x[k] = (rest << bits) // int(a[k, k])
        return x

    return solve


# ---------------------------------------------------------------- whitening


@dataclass(frozen=True)
class Basis:
    """What rows are projected with: plain numbers, bounded by the dimension."""

    n: int
    sums: tuple[int, ...]
    components: tuple[tuple[float, ...], ...]
    #: Standard deviation per component; 0 where the vectors don't vary.
    spread: tuple[float, ...]
    #: Eigenvalue over the trace per component; null for vectors that are all equal.
    explained: tuple[float | None, ...]


def _ratio(a: int, b: int) -> float:
    """a / b for integers of any length."""
    shift = max(0, max(a.bit_length(), b.bit_length()) - 1000)
    return (a >> shift) / (b >> shift) if b >> shift else 0.0


def fit(spark: SparkSession, total: Scatter, count: int = COMPONENTS) -> Basis:
    """Components of the covariance by falling eigenvalue, as unit vectors whose largest entry is positive."""
    d = len(total.sums)
    count = min(count, d)
    trace = sum(row[i] for i, row in enumerate(total.matrix))
    if not trace:
        unit = tuple(tuple(float(i == k) for i in range(d)) for k in range(count))
        return Basis(total.n, tuple(total.sums), unit, (0.0,) * count, (None,) * count)
    # A common divisor of all entries only lengthens the polynomial's coefficients.
    common = math.gcd(*(v for row in total.matrix for v in row))
    matrix = [[v // common for v in row] for row in total.matrix]
    poly = polynomial_of(spark, matrix)
    rank = d - next(k for k, c in enumerate(poly) if c)
    roots = largest_roots(poly, count)
    roots = [r if k < rank else 0 for k, r in enumerate(roots)]
    vectors = null_vectors(matrix, roots)
    scale = total.n * total.n << ROOT_BITS
    spread = tuple(math.sqrt(_ratio(r * common, scale)) for r in roots)
    explained = tuple(_ratio(r * common, trace << ROOT_BITS) for r in roots)
    components = tuple(tuple(_ratio(abs(v), 1 << VECTOR_BITS) * (1 if v > 0 else -1) for v in vector) for vector in vectors)
    return Basis(total.n, tuple(total.sums), components, spread, explained)


def projected(vectors: DataFrame, name: str, id: str, basis: Basis) -> DataFrame:
    """`id`, `deviation` and `z` (whitened entry per component; null where the spread is 0).

    Differences from the mean are taken in integers, n times too large. A deviation beyond a bigint is null.
    """
    shared = vectors.sparkSession.sparkContext.broadcast((basis.n, basis.sums, basis.components, basis.spread))
    kind = vectors.schema[id].dataType.simpleString()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, components, spread = shared.value
        d, axes = len(sums), np.array(components, np.float64).T
        scale = np.array([1 / (n * s) if s else np.nan for s in spread])
        most = max((abs(s) for s in sums), default=0)
        for batch in small(batches):
            y = entries(batch.column("v"), d)
            if (n * int(np.abs(y).max(initial=0)) + most) ** 2 * d < 1 << 63:
                centred = n * y - np.array(sums, np.int64)
                deviation = pa.array((centred * centred).sum(axis=1), pa.int64())
            else:
                centred = n * y.astype(object) - np.array(sums, object)
                far = [int(v) for v in (centred * centred).sum(axis=1)]
                deviation = pa.array([v if v < 1 << 63 else None for v in far], pa.int64())
            z = centred.astype(np.float64) @ axes * scale
            flat = pa.array(z.ravel(), mask=np.isnan(z.ravel()))
            edges = pa.array(np.arange(len(z) + 1) * len(spread), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id"), deviation, pa.ListArray.from_arrays(edges, flat)], ["id", "deviation", "z"])

    return vectors.select(F.col(f"`{id}`").alias("id"), F.col(name).alias("v")).mapInArrow(project, f"id {kind}, deviation bigint, z array<double>")


def identity_error(whitened: DataFrame, spread: tuple[float, ...]) -> float:
    """Largest entry of the whitened rows' covariance less the identity, over components that vary; from two passes, one
    for the means."""
    live = [k for k, s in enumerate(spread) if s]
    if not live:
        return 0.0
    means = whitened.agg(*(F.avg(F.get("z", F.lit(k))).alias(f"m{k}") for k in live)).first()
    centred = {k: F.get("z", F.lit(k)) - F.lit(means[f"m{k}"]) for k in live}
    cells = [(i, j) for i in live for j in live if j <= i]
    found = whitened.agg(*(F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in cells)).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in cells)


def whiten(table: DataFrame, id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per usable vector and component: `id`, component (from 1), n, deviation, whitened, explained, identity_error.

    Vectors that are null, hold null or non-finite entries, or differ in length from most, give no rows. Ids may repeat or
    be null; rows that repeat count as often. A component without variance has a null whitened value, and if no component
    has any, explained is null too. Columns beyond id and vector play no part. A table without vectors gives no rows.
    """
    spark = table.sparkSession
    named = table.select(F.col(f"`{id}`").alias("id"), F.col(f"`{vector}`").alias("v"))
    d = dimension_of(named, "v")
    rows = named.where(usable(F.col("v"), d)) if d else named.limit(0)
    basis = fit(spark, scatter(rows, "v", d), components)
    whitened = settle(projected(rows, "v", "id", basis), "whitened")
    error = identity_error(whitened, basis.spread) if basis.n else 0.0
    explained = F.array(*(F.lit(e).cast("double") for e in basis.explained)) if basis.explained else F.array().cast("array<double>")
    return whitened.select("id", "deviation", F.posexplode("z").alias("k", "whitened")).select(
        F.col("id").alias(id),
        (F.col("k") + 1).alias("component"),
        F.lit(basis.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("k")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
