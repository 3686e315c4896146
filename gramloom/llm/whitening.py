"""Whitening of embeddings from the exact characteristic polynomial of their scatter.

Components are quantised to integers, so the scatter of all vectors is an integer matrix, n times
the sum of squares less the square of the sums.  It is summed exactly: tasks add products of
integers and hand on their sums in limbs, which Spark adds up.  The polynomial of that
matrix is found modulo many primes, dealt over tasks, by reduction to Hessenberg form; the
remainders give its integer coefficients.  Its roots are all real, so the changes
of sign of a shifted polynomial count the roots above the shift without error.  The highest roots are
isolated that way and narrowed to PRECISION bits.  Their null spaces are found by inverse
iteration in decimals of more digits than that, each orthogonal to those before it, so roots that repeat
get an orthonormal basis.  What is left for doubles is one product per row.

All rows are read and written by tasks.  The driver holds the matrix, d squared numbers for vectors of d
components, and the polynomial.  The work on those grows with the fourth power of d; d of a few
hundred is meant.

Vectors that are null or hold null or non-finite components are left out.  Vectors of unequal
length have no covariance with each other, so each length is a table by itself; vectors
without components give no rows.  A component beyond 2^62 after quantising is taken as that bound.  Directions
without variance cannot be scaled to one: they are no components, so equal vectors, or a single one,
give no rows.  Repeated rows, with equal ids or none, count and are returned one by one.
Empty table: no rows.  Only vec_id and embedding are read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal, localcontext
from math import comb, prod

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gramloom.llm.common import shuffle_partitions, stage

SCALE = 1024
COMPONENTS = 8
#: Bits of the highest root; decimals hold a third more digits than these ask for.
PRECISION = 256
DIGITS = 110
_LIMB = 40
_LARGEST = 2**62
_LONG = 2**63 - 1
#: Products of numbers up to _PLAIN, this many added, are exact in doubles.
_PLAIN = 2**20
_ROWS = 2**12

Matrix = list[list[int]]


@dataclass(frozen=True)
class Whitening:
    """The fit over n vectors of one length: sums, and columns that turn a centred vector into components."""

    n: int
    sums: tuple[int, ...]
    columns: np.ndarray
    explained: tuple[float, ...]


def _finite(vector: Column) -> Column:
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def _by_length(column: pa.Array, scale: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, numbers) for each length."""
    sizes = column.value_lengths().to_numpy()
    for length in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == length)
        flat = column.take(pa.array(own)).flatten().to_numpy(zero_copy_only=False)
        whole = np.floor(np.clip(flat * scale, -float(_LARGEST), float(_LARGEST)))
        yield length, own, whole.astype(np.int64).reshape(len(own), length)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    sign, value, at = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield at, sign * (value & (2**_LIMB - 1))
        value >>= _LIMB
        at += 1


def _sums(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """(length, i, j, limb, value): of products of components i <= j, of components j (i = -1), of rows (j = -1)."""
    counts, sums, products = {}, {}, {}
    for batch in batches:
        for length, own, numbers in _by_length(batch.column(0), scale):
            counts[length] = counts.get(length, 0) + len(own)
            for top in range(0, len(own), _ROWS):
                part = numbers[top : top + _ROWS]
                if len(part) and length and np.abs(part).max() <= _PLAIN:
                    real = part.astype(np.float64)
                    product, total = (real.T @ real).astype(np.int64), part.sum(axis=0)
                else:
                    product, total = part.astype(object).T @ part.astype(object), part.astype(object).sum(axis=0)
                products[length] = products.get(length, 0) + product.astype(object)
                sums[length] = sums.get(length, 0) + total.astype(object)
    rows = []
    for length, count in counts.items():
        cells = [(-1, -1, count)]
        if length:
            cells += [(-1, j, sums[length][j]) for j in range(length)]
            cells += [(i, j, products[length][i, j]) for i in range(length) for j in range(i, length)]
        rows += [(length, i, j, at, value) for i, j, number in cells for at, value in _limbs(int(number))]
    types = [pa.int32()] * 4 + [pa.int64()]
    columns = list(zip(*rows, strict=True)) or [()] * 5
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["length", "i", "j", "limb", "value"]
    )


def scatter(vectors: DataFrame, scale: float = SCALE) -> dict[int, tuple[int, list[int], Matrix]]:
    """For each length of vectors: their number, the sums, and n^2 times their covariance, exactly."""
    parts = vectors.select("embedding").mapInArrow(
        lambda batches: _sums(batches, scale), "length int, i int, j int, limb int, value bigint"
    )
    cells: dict[int, dict[tuple[int, int], int]] = {}
    for row in parts.groupBy("length", "i", "j", "limb").agg(F.sum("value").alias("value")).collect():
        of_length = cells.setdefault(row["length"], {})
        at = row["i"], row["j"]
        of_length[at] = of_length.get(at, 0) + (row["value"] << (_LIMB * row["limb"]))
    found = {}
    for length, of_length in cells.items():
        n = of_length[-1, -1]
        sums = [of_length.get((-1, j), 0) for j in range(length)]
        matrix = [
            [n * of_length.get((min(i, j), max(i, j)), 0) - sums[i] * sums[j] for j in range(length)]
            for i in range(length)
        ]
        found[length] = n, sums, matrix
    return found


def _is_prime(n: int) -> bool:
    # These bases decide all numbers below 2^32.
    d, twos = n - 1, 0
    while d % 2 == 0:
        d, twos = d // 2, twos + 1
    for base in (2, 7, 61):
        x = pow(base, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def _primes(bound: int) -> list[int]:
    """The largest primes of 31 bits, enough for their product to exceed a bound."""
    found, product, at = [], 1, 2**31 - 1
    while product <= bound:
        if _is_prime(at):
            found.append(at)
            product *= at
        at -= 2
    return found


def polynomial_modulo(matrix: Matrix, p: int) -> list[int]:
    """Coefficients of det(x - matrix) modulo a prime of 31 bits, the highest first."""
    h = np.array([[x % p for x in row] for row in matrix], np.int64)
    d = len(h)
    for m in range(1, d - 1):
        below = np.flatnonzero(h[m:, m - 1])
        if not len(below):
            continue
        pivot = m + int(below[0])
        if pivot != m:
            h[[m, pivot]] = h[[pivot, m]]
            h[:, [m, pivot]] = h[:, [pivot, m]]
        factors = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - factors[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * factors % p).sum(axis=1)) % p
    # Row k holds the polynomial of the leading k rows and columns, the lowest coefficient first.
    of = np.zeros((d + 1, d + 1), np.int64)
    of[0, 0] = 1
    for k in range(1, d + 1):
        of[k, 1:] = of[k - 1, :-1]
        weights, below = np.zeros(k, np.int64), 1
        for i in range(k - 1, -1, -1):
            weights[i] = int(h[i, k - 1]) * below % p
            below = below * int(h[i, i - 1]) % p if i else 0
        of[k] = (of[k] - (weights[:, None] * of[:k] % p).sum(axis=0)) % p
    return of[d, ::-1].tolist()


def characteristic_polynomial(spark: SparkSession, matrix: Matrix) -> list[int]:
    """Coefficients of det(x - matrix), the highest first, of a matrix whose eigenvalues are none below 0.

    With trace t the coefficient of degree d - k has the sign of (-1)^k and is at most
    comb(d, k) * (t / d)^k, which says how many primes are needed.
    """
    d = len(matrix)
    level = sum(matrix[i][i] for i in range(d)) // d + 1
    primes = _primes(max(comb(d, k) * level**k for k in range(d + 1)))

    def remainders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = batch.column(0).to_pylist()
            found = [polynomial_modulo(matrix, p) for p in of]
            yield pa.RecordBatch.from_arrays([pa.array(of, pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["prime", "found"])

    dealt = spark.createDataFrame([(p,) for p in primes], "prime bigint")
    dealt = dealt.repartition(min(len(primes), shuffle_partitions(spark)))
    rows = dealt.mapInArrow(remainders, "prime bigint, found array<bigint>").collect()
    product = prod(primes)
    total = [0] * (d + 1)
    for p, found in rows:
        others = product // p
        weight = others * pow(others, -1, p)
        for k, value in enumerate(found):
            total[k] += weight * (value if k % 2 == 0 else -value)
    return [(-1) ** k * (value % product) for k, value in enumerate(total)]


def _roots_above(coefficients: Sequence[int], at: int) -> int:
    """How many roots exceed a number, of a polynomial whose roots are all real: changes of sign after a shift."""
    shifted = list(coefficients)
    for end in range(len(shifted), 1, -1):
        for k in range(1, end):
            shifted[k] += at * shifted[k - 1]
    signs = [x > 0 for x in shifted if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def _sign(coefficients: Sequence[int], at: int) -> int:
    value = 0
    for c in coefficients:
        value = value * at + c
    return (value > 0) - (value < 0)


def highest_roots(coefficients: Sequence[int], count: int, bits: int = PRECISION) -> tuple[list[int], int]:
    """The `count` highest positive roots, falling, each as often as it repeats: (root * 2^shift, rounded up), shift.

    All roots must be real and none negative.
    """
    top = -coefficients[1]
    shift = max(0, bits - top.bit_length())
    scaled = [c << (shift * k) for k, c in enumerate(coefficients)]
    found: list[int] = []
    high = top << shift
    waiting = [(0, high, _roots_above(scaled, 0), 0)]  # roots in (low, high], roots above low, above high
    while waiting:
        low, high, above_low, above_high = waiting.pop()
        inside = above_low - above_high
        if not inside or len(found) >= count:
            continue
        if high - low == 1:
            found += [high] * inside
        elif inside == 1:
            found.append(_narrowed(scaled, low, high))
        else:
            middle = (low + high) // 2
            above = _roots_above(scaled, middle)
            waiting += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return found[:count], shift


def _narrowed(coefficients: Sequence[int], low: int, high: int) -> int:
    """The only root in (low, high], rounded up."""
    side = _sign(coefficients, high)
    while side and high - low > 1:
        middle = (low + high) // 2
        at = _sign(coefficients, middle)
        if not at:
            return middle
        low, high = (low, middle) if at == side else (middle, high)
    return high


class _Solver:
    """Solves (matrix - root) x = b in decimals, by elimination with pivots from the column."""

    def __init__(self, matrix: Matrix, root: Decimal):
        d = len(matrix)
        self.rows = np.array([[Decimal(x) for x in row] for row in matrix], object).reshape(d, d)
        self.order = np.arange(d)
        for i in range(d):
            self.rows[i, i] -= root
        largest = max((abs(x) for x in self.rows.flat), default=Decimal(1)) or Decimal(1)
        tiny = largest.scaleb(-DIGITS)
        for k in range(d):
            pivot = k + max(range(d - k), key=lambda i: abs(self.rows[k + i, k]))
            if pivot != k:
                self.rows[[k, pivot]] = self.rows[[pivot, k]]
                self.order[[k, pivot]] = self.order[[pivot, k]]
            if abs(self.rows[k, k]) < tiny:  # the root itself: the matrix has no inverse
                self.rows[k, k] = tiny
            self.rows[k + 1 :, k] = self.rows[k + 1 :, k] / self.rows[k, k]
            self.rows[k + 1 :, k + 1 :] -= np.outer(self.rows[k + 1 :, k], self.rows[k, k + 1 :])

    def solve(self, b: np.ndarray) -> np.ndarray:
        x = b[self.order].copy()
        for k in range(len(x)):
            x[k + 1 :] -= self.rows[k + 1 :, k] * x[k]
        for k in range(len(x) - 1, -1, -1):
            x[k] = x[k] / self.rows[k, k]
            x[:k] -= self.rows[:k, k] * x[k]
        return x


def null_vectors(matrix: Matrix, roots: Sequence[int], shift: int) -> list[np.ndarray]:
    """Orthonormal eigenvectors in decimals for falling eigenvalues root / 2^shift; the largest entry is positive."""
    found: list[np.ndarray] = []
    seeded = random.Random(1)
    solver, solved = None, None
    for root in roots:
        if root != solved:
            solver, solved = _Solver(matrix, Decimal(root) / Decimal(1 << shift)), root
        x = np.array([Decimal(seeded.randint(1, 10**9)) for _ in matrix], object)
        for _ in range(4):
            x = solver.solve(x)
            for _ in range(2):
                x = x / max(abs(v) for v in x)
                for other in found:
                    x = x - other * (x @ other)
                x = x / (x @ x).sqrt()
        found.append(x if max(x, key=abs) > 0 else -x)
    return found


def fit(vectors: DataFrame, components: int = COMPONENTS, scale: float = SCALE) -> dict[int, Whitening]:
    """The whitening of each length of vectors, over all that have finite components."""
    spark = vectors.sparkSession
    models = {}
    for length, (n, sums, matrix) in scatter(vectors, scale).items():
        trace = sum(matrix[i][i] for i in range(length))
        if not trace:
            continue
        roots, shift = highest_roots(characteristic_polynomial(spark, matrix), min(components, length))
        with localcontext() as context:
            context.prec = DIGITS
            columns = np.zeros((length, len(roots)))
            explained = []
            for k, (root, unit) in enumerate(zip(roots, null_vectors(matrix, roots, shift), strict=True)):
                eigenvalue = Decimal(root) / Decimal(1 << shift)
                deviation = eigenvalue.sqrt() / n
                columns[:, k] = [float(x / deviation) for x in unit]
                explained.append(float(eigenvalue / trace))
        models[length] = Whitening(n, tuple(sums), columns, tuple(explained))
    return models


def _project(batches: Iterator[pa.RecordBatch], models: dict[int, Whitening], scale: float) -> Iterator[pa.RecordBatch]:
    """(vec_id, length, deviation, whitened) of each vector whose length has a model."""
    for batch in batches:
        for length, own, numbers in _by_length(batch.column(1), scale):
            if length not in models:
                continue
            model = models[length]
            largest = model.n * int(np.abs(numbers).max()) + max(map(abs, model.sums))
            if length * largest**2 <= _LONG:
                centred = model.n * numbers - np.array(model.sums, np.int64)
                deviations = (centred * centred).sum(axis=1)
            else:
                centred = model.n * numbers.astype(object) - np.array(model.sums, object)
                deviations = [min(int(x), _LONG) for x in (centred * centred).sum(axis=1)]
            whitened = (centred / model.n).astype(np.float64) @ model.columns
            flat = pa.array(whitened.ravel())
            ends = pa.array(np.arange(len(own) + 1, dtype=np.int32) * whitened.shape[1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(own)),
                    pa.array(np.full(len(own), length, np.int32)),
                    pa.array(deviations, pa.int64()),
                    pa.ListArray.from_arrays(ends, flat),
                ],
                ["vec_id", "length", "deviation", "whitened"],
            )


def _identity_errors(whitened: DataFrame, components: int) -> dict[int, float]:
    """For each length, the largest entry of the covariance of the components less the identity."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]

    def off(i: int, j: int) -> Column:
        covariance = F.covar_pop(F.get("whitened", F.lit(i)), F.get("whitened", F.lit(j)))
        return F.coalesce(F.abs(covariance - (1.0 if i == j else 0.0)), F.lit(0.0))

    rows = whitened.groupBy("length").agg(F.array_max(F.array(*[off(i, j) for i, j in pairs])).alias("error")).collect()
    return {row["length"]: row["error"] for row in rows}


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: float = SCALE) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a row per vector and component.

    Components are numbered from 1 by falling eigenvalue.  `deviation` is the sum of the squares of n x - S, exactly;
    past a long it is the largest long.  A number is floor(scale * component); adding a constant to all would
    change nothing that is returned.
    """
    spark = vectors.sparkSession
    if components < 1:
        raise ValueError("components must be at least 1")
    vector = vectors["embedding"].cast("array<double>")
    rows = vectors.select(vectors["vec_id"].cast("bigint").alias("vec_id"), vector.alias("embedding"))
    rows = rows.filter(F.coalesce(_finite(F.col("embedding")), F.lit(False)))
    models = fit(rows, components, scale)
    whitened = rows.mapInArrow(
        lambda batches: _project(batches, models, scale),
        "vec_id bigint, length int, deviation bigint, whitened array<double>",
    )
    whitened = stage(whitened, "whitened")
    errors = _identity_errors(whitened, components) if models else {}
    # One row per length of vectors.
    fits = spark.createDataFrame(
        [(length, m.n, list(m.explained), errors.get(length)) for length, m in models.items()],
        "length int, n bigint, shares array<double>, identity_error double",
    )
    each = whitened.join(F.broadcast(fits), "length").select(
        "vec_id", "n", "deviation", "shares", "identity_error", F.posexplode("whitened").alias("at", "whitened")
    )
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
        F.get("shares", F.col("at")).alias("explained"), "identity_error",
    )
