"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter.

Entries become whole numbers, floor(64 * c). Spark sums their products over the distinct vectors, exactly:
a task multiplies limbs of 20 bits in double precision, where no sum is rounded, and hands on chunks
of 32 bits that add up as longs. From these n * sum(x x') - S S' follows, n * n times the covariance and
the same for any shift of x. Its characteristic polynomial is found modulo enough primes, each by reduction to
Hessenberg form in a task, and put together by Chinese remaindering. All roots are real, so the changes of sign of the
polynomial shifted to a point count the roots above it, with multiplicity; halving isolates the
largest roots to hundreds of bits. Inverse iteration on the matrix less a root, in fixed point of the same precision,
gives the null space: a component for a simple root, an orthonormal basis for a multiple one.

What the driver and a task hold is bounded by the dimension: its square in numbers. With d dimensions and entries of the
scatter of b bits there are about d * b / 31 primes, each d cubed steps.

Defined results: vectors that are null, hold null or non-finite entries or have another length than most (of equally
frequent ones the larger) are left out. Rows without an id and rows that repeat one stay. Entries beyond the range of a
long count as its ends. A component without variance has null ``whitened`` and takes no part in ``identity_error``. A
deviation beyond the range of a long is null. Of components with equal eigenvalues any orthonormal basis is
taken, the same for all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import bounded_batches, partitions, pick, stored

COMPONENTS = 16

#: An entry counts in steps of one part in so many.
STEPS = 64

#: Roots are found to so many bits below the trace; nearer ones count as one multiple root.
ROOT_BITS = 320

#: Bits behind the point in inverse iteration.
POINT_BITS = 448

#: Limbs of products, and rows that are multiplied together: sums stay below 2 ** 52.
LIMB_BITS, ROWS = 20, 4096

#: Chunks of 32 bits of a sum of products of longs.
CHUNKS = 6

#: Where double precision could be off by more than this share of a component's deviation, rows are projected exactly.
PROJECTION_ERROR = 1e-9


def whole_numbers(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(id, y) rows that take part, y = floor(64 * c), and their dimension (0: no rows)."""
    sound = vectors.toDF("id", "vector").select("id", F.col("vector").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    sound = sound.where(F.col("vector").isNotNull() & finite)
    sizes = sound.groupBy(F.size("vector").alias("n")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    dimension = common[0].n if common else 0
    rows = sound.where(F.size("vector") == dimension)
    return rows.select("id", F.transform("vector", lambda c: F.floor(c * STEPS)).alias("y")), dimension


def matrix(column: pa.ListArray, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def products(rows: np.ndarray) -> np.ndarray:
    """rows' @ rows of a matrix of longs, as exact Python integers."""
    top = max(abs(int(rows.min(initial=0))), abs(int(rows.max(initial=0))))
    count = max(1, -(-(top.bit_length() + 1) // LIMB_BITS))
    limbs = [(rows >> (LIMB_BITS * k)) & (2**LIMB_BITS - 1) for k in range(count - 1)]
    limbs = [limb.astype(np.float64) for limb in [*limbs, rows >> (LIMB_BITS * (count - 1))]]
    out = np.zeros((rows.shape[1],) * 2, object)
    for k, one in enumerate(limbs):
        for m, two in enumerate(limbs):
            part = np.zeros(out.shape, np.int64)
            for a in range(0, len(rows), ROWS):
                part += (one[a : a + ROWS].T @ two[a : a + ROWS]).astype(np.int64)
            out += part.astype(object) << (LIMB_BITS * (k + m))
    return out


def _sums(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[pa.RecordBatch]:
    """The products of (1, y) with itself, summed over a task, in chunks."""
    total = np.zeros((dimension + 1,) * 2, object)
    for batch in batches:
        if batch.num_rows:
            rows = matrix(batch.column("y"), dimension)
            total += products(np.concatenate((np.ones((len(rows), 1), np.int64), rows), axis=1))
    i, j = np.triu_indices(dimension + 1)
    value = total[i, j]
    chunks = [(value >> (32 * k)) & 0xFFFFFFFF for k in range(CHUNKS - 1)] + [value >> (32 * (CHUNKS - 1))]
    columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *(pa.array(c.tolist(), pa.int64()) for c in chunks)]
    yield pa.RecordBatch.from_arrays(columns, names=["i", "j", *(f"c{k}" for k in range(CHUNKS))])


def scatter(rows: DataFrame, dimension: int) -> tuple[int, np.ndarray, np.ndarray]:
    """n, the sums S and n * sum(y y') - S S' over rows with a column ``y``; exact."""
    schema = ", ".join(["i int", "j int", *(f"c{k} long" for k in range(CHUNKS))])
    parts = bounded_batches(rows.select("y")).mapInArrow(lambda batches: _sums(batches, dimension), schema)
    total = np.zeros((dimension + 1,) * 2, object)
    for r in parts.groupBy("i", "j").agg(*(F.sum(f"c{k}").alias(f"c{k}") for k in range(CHUNKS))).collect():
        total[r.i, r.j] = total[r.j, r.i] = sum(r[f"c{k}"] << (32 * k) for k in range(CHUNKS))
    n, sums = int(total[0, 0]), total[0, 1:]
    return n, sums, n * total[1:, 1:] - np.outer(sums, sums)


def _is_prime(n: int) -> bool:
    """Miller and Rabin's test; these bases decide all n below 3.2e9."""
    if n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if n == base or x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes(bits: int) -> list[int]:
    """The largest primes below 2 ** 31 whose product has more than ``bits`` bits."""
    found, have, n = [], 0, 2**31 - 1
    while have <= bits:
        if _is_prime(n):
            found.append(n)
            have += 30
        n -= 2
    return found


def _inverse(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Inverses modulo primes by Fermat's theorem; 0 for 0."""
    out, power, square = np.ones_like(x), p - 2, x
    while power.any():
        out = np.where(power & 1, out * square % p, out)
        square = square * square % p
        power = power >> 1
    return np.where(x == 0, 0, out)


def characteristic_mod(residues: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Coefficients, the constant first, of det(xI - A) modulo each prime; ``residues`` has a matrix for each."""
    h, (count, n, _) = residues.copy(), residues.shape
    each = p[:, None]
    for m in range(1, n - 1):
        pivot = m + np.argmax(h[:, m:, m - 1] != 0, axis=1)
        for k in np.flatnonzero(pivot != m).tolist():
            a = int(pivot[k])
            h[k, [m, a]] = h[k, [a, m]]
            h[k][:, [m, a]] = h[k][:, [a, m]]
        factor = h[:, m + 1 :, m - 1] * _inverse(h[:, m, m - 1], p)[:, None] % each
        h[:, m + 1 :] = (h[:, m + 1 :] - factor[:, :, None] * h[:, m : m + 1]) % each[:, None]
        h[:, :, m] = (h[:, :, m] + (h[:, :, m + 1 :] * factor[:, None] % each[:, None]).sum(axis=2)) % each
    # Characteristic polynomials of the leading blocks, one from the earlier ones.
    polys = np.zeros((n + 1, count, n + 1), np.int64)
    polys[0, :, 0] = 1
    for k in range(1, n + 1):
        polys[k, :, 1:] = polys[k - 1, :, :-1]
        polys[k] = (polys[k] - h[:, k - 1, k - 1, None] * polys[k - 1]) % each
        below = np.ones(count, np.int64)
        for i in range(1, k):
            below = below * h[:, k - i, k - i - 1] % p
            polys[k] = (polys[k] - (below * h[:, k - 1 - i, k - 1] % p)[:, None] * polys[k - 1 - i]) % each
    return polys[n]


def characteristic(spark, square: np.ndarray) -> list[int]:
    """det(xI - A) of a symmetric matrix of integers without negative eigenvalues, the constant first."""
    n = len(square)
    trace = int(square.trace())
    # The k-th coefficient is at most that of (1 + trace / n) ** n, by Maclaurin's inequality.
    chosen = primes(n * (1 + trace // n + 1).bit_length() + 1)
    at_once = max(1, min(32, (1 << 22) // (n * n)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("prime").to_numpy()
            for a in range(0, len(own), at_once):
                p = own[a : a + at_once]
                residues = np.stack([(square % int(x)).astype(np.int64) for x in p])
                found = characteristic_mod(residues, p)
                yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(found.tolist(), pa.list_(pa.int64()))], names=["prime", "found"])

    rows = spark.createDataFrame([(p,) for p in chosen], "prime long").repartition(min(len(chosen), partitions(spark.range(1))))
    value, modulus = [0] * (n + 1), 1
    for r in rows.mapInArrow(run, "prime long, found array<long>").collect():
        inverse = pow(modulus, -1, r.prime)
        value = [v + modulus * ((f - v) * inverse % r.prime) for v, f in zip(value, r.found, strict=True)]
        modulus *= r.prime
    return [v - modulus if 2 * v > modulus else v for v in value]


class Roots:
    """The real roots, none negative, of a polynomial all of whose roots are real. Points are a / 2 ** f."""

    def __init__(self, coefficients: list[int]) -> None:
        self.zeros = next(k for k, c in enumerate(coefficients) if c)
        self.positive = coefficients[self.zeros :]
        self._scaled: dict[int, list[int]] = {}

    def scaled(self, f: int) -> list[int]:
        """The polynomial whose roots are 2 ** f times as large."""
        if f not in self._scaled:
            top = len(self.positive) - 1
            self._scaled = {f: [c << (f * (top - k)) for k, c in enumerate(self.positive)]}
        return self._scaled[f]

    def above(self, a: int, f: int) -> int:
        """How many positive roots, by multiplicity, are greater: changes of sign at the point."""
        c = list(self.scaled(f))
        for low in range(len(c) - 1):
            value = c[-1]
            for k in range(len(c) - 2, low - 1, -1):
                value = c[k] = c[k] + a * value
        signs = [x > 0 for x in c if x]
        return sum(x != y for x, y in zip(signs, signs[1:], strict=False))

    def sign(self, a: int, f: int) -> int:
        value = 0
        for c in reversed(self.scaled(f)):
            value = value * a + c
        return (value > 0) - (value < 0)

    def largest(self, count: int, bits: int = ROOT_BITS) -> list[tuple[int, int, int]]:
        """(a, f, multiplicity) of the largest positive roots, until ``count`` are there, from the largest on."""
        if len(self.positive) < 2 or count < 1:
            return []
        # No root is above the sum of all.
        top = (-self.positive[-2]).bit_length()
        found = []
        waiting = [(0, 1 << top, 0, len(self.positive) - 1, 0)]
        while waiting:
            low, high, f, above_low, above_high = waiting.pop()
            if above_low == above_high or above_high >= count:
                continue
            if (high - low) << bits <= 1 << (top + f):
                found.append((high, f, above_low - above_high))
                continue
            if above_low - above_high == 1:
                found.append((*self._refine(low, high, f, above_high, top, bits), 1))
                continue
            if high - low == 1:
                low, high, f = 2 * low, 2 * high, f + 1
            middle = (low + high) // 2
            above = self.above(middle, f)
            # The upper half comes next.
            waiting += [(low, middle, f, above_low, above), (middle, high, f, above, above_high)]
        return found

    def _refine(self, low: int, high: int, f: int, above: int, top: int, bits: int) -> tuple[int, int]:
        """A simple root in (low, high] by signs."""
        more = max(0, bits - top - f)
        low, high, f = low << more, high << more, f + more
        positive = 1 if above % 2 == 0 else -1
        while (high - low) << bits > 1 << (top + f) and high - low > 1:
            middle = (low + high) // 2
            if self.sign(middle, f) in (0, positive):
                high = middle
            else:
                low = middle
        return high, f


def _starts(n: int, count: int) -> list[np.ndarray]:
    draw = np.random.default_rng(n)
    return [draw.integers(-(2**30), 2**30, n).astype(object) << (POINT_BITS - 30) for _ in range(count)]


def null_space(square: np.ndarray, root: tuple[int, int, int]) -> list[np.ndarray]:
    """Orthonormal vectors, in units of 2 ** -POINT_BITS, that the matrix stretches by the root."""
    a, f, count = root
    n, point = len(square), POINT_BITS
    scale = point - int(square.trace()).bit_length()
    m = square << scale if scale >= 0 else square >> -scale
    value = a << (scale - f) if scale >= f else a >> (f - scale)
    m[np.arange(n), np.arange(n)] -= value
    order = np.arange(n)
    for k in range(n):
        p = k + max(range(n - k), key=lambda i: abs(m[k + i, k]))
        m[[k, p]], order[[k, p]] = m[[p, k]], order[[p, k]]
        if not m[k, k]:
            m[k, k] = 1
        m[k + 1 :, k] = (m[k + 1 :, k] << point) // m[k, k]
        m[k + 1 :, k + 1 :] -= np.outer(m[k + 1 :, k], m[k, k + 1 :]) >> point

    def solved(right: np.ndarray) -> np.ndarray:
        x = right[order].copy()
        for k in range(n):
            x[k + 1 :] -= (m[k + 1 :, k] * x[k]) >> point
        for k in range(n - 1, -1, -1):
            x[k] = (x[k] << point) // m[k, k]
            x[:k] -= (m[:k, k] * x[k]) >> point
        return x

    def unit(x: np.ndarray) -> np.ndarray:
        shift = max(0, max(abs(v) for v in x).bit_length() - 2 * point)
        x = x >> shift
        return (x << point) // max(1, isqrt(int((x * x).sum())))

    vectors = _starts(n, count)
    for _ in range(3):
        done: list[np.ndarray] = []
        for v in vectors:
            v = unit(solved(unit(v)))
            for _ in range(2):
                for other in done:
                    v = v - ((other * (int((other * v).sum()) >> point)) >> point)
                v = unit(v)
            done.append(v)
        vectors = done
    return vectors


@dataclass
class Model:
    """Of the distinct vectors: number, sums, trace of n * n * covariance; components (units of 2 ** -POINT_BITS) with eigenvalues."""

    dimension: int
    n: int
    sums: np.ndarray
    trace: int
    vectors: list[np.ndarray]
    values: list[float]
    shares: list[float | None]

    def centred(self, y: np.ndarray) -> np.ndarray:
        """n * y - S: longs if they surely suffice, else Python integers."""
        top = max(abs(int(y.min(initial=0))), abs(int(y.max(initial=0)))) * self.n + max(abs(int(s)) for s in self.sums)
        if top < 2**62:
            return y * np.int64(self.n) - self.sums.astype(np.int64)
        return y.astype(object) * self.n - self.sums

    def whitened(self, y: np.ndarray) -> np.ndarray:
        """A row for each vector, a column for each component with variance."""
        if not self.values:
            return np.zeros((len(y), 0))
        centred = self.centred(y)
        z = (centred / self.n).astype(np.float64)
        deviations = np.sqrt(self.values)
        axes = np.stack([np.array([int(x) / (1 << POINT_BITS) for x in v]) for v in self.vectors], axis=1)
        out = z @ axes / deviations
        # Long vectors lose the small components to rounding.
        for i in np.flatnonzero(np.sqrt((z * z).sum(axis=1)) * 2**-50 > PROJECTION_ERROR * deviations.min()):
            row = centred[i].astype(object)
            out[i] = [int((row * v).sum()) / (self.n << POINT_BITS) / s for v, s in zip(self.vectors, deviations, strict=True)]
        return out

    def deviation(self, y: np.ndarray) -> list[int | None]:
        centred = self.centred(y)
        if centred.dtype != object and len(centred):
            top = max(abs(int(centred.min())), abs(int(centred.max())))
            if self.dimension * top * top < 2**63:
                return (centred * centred).sum(axis=1).tolist()
            centred = centred.astype(object)
        return [x if x < 2**63 else None for x in (centred * centred).sum(axis=1)]


def fit(rows: DataFrame, dimension: int, components: int = COMPONENTS) -> Model | None:
    """The components of distinct rows with a column ``y``; None without rows."""
    spark = rows.sparkSession
    n, sums, square = scatter(rows, dimension)
    if not n:
        return None
    trace = int(square.trace())
    roots = Roots(characteristic(spark, square)).largest(min(components, dimension)) if trace else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column("root").to_pylist():
                found = [[str(x) for x in v] for v in null_space(square, roots[k])]
                yield pa.RecordBatch.from_arrays([pa.array([k] * len(found)), pa.array(found)], names=["root", "entries"])

    vectors, values, shares = [], [], []
    if roots:
        numbers = spark.createDataFrame([(k,) for k in range(len(roots))], "root int").repartition(len(roots))
        spaces: dict[int, list] = {}
        for r in numbers.mapInArrow(run, "root long, entries array<string>").collect():
            spaces.setdefault(r.root, []).append(np.array([int(x) for x in r.entries], object))
        for k, (a, f, _) in enumerate(roots):
            for v in spaces[k]:
                vectors.append(v)
                values.append(a / (n * n << f))
                shares.append(a / (trace << f))
    wanted = min(components, dimension)
    return Model(dimension, n, sums, trace, vectors[:wanted], values[:wanted], shares[:wanted])


def identity_error(rows: DataFrame, model: Model) -> float | None:
    """The largest absolute entry of the covariance of whitened ``y`` less the identity; None without components."""
    size = len(model.values)
    if not size:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            if batch.num_rows:
                w = model.whitened(matrix(batch.column("y"), model.dimension))
                w = np.concatenate((np.ones((len(w), 1)), w), axis=1)
                total += w.T @ w
        i, j = np.triu_indices(size + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "s"])

    # Vectors are centred as integers before they are projected, so the means are those of rounding.
    found = bounded_batches(rows.select("y")).mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    sums = {(r.i, r.j): r.s / model.n for r in found}
    return max(abs(sums[i, j] - sums[0, i] * sums[0, j] - (i == j)) for i in range(1, size + 1) for j in range(i, size + 1))


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """For each vector that takes part, and each component: vec_id and the columns of ``SCHEMA``.

    ``vectors`` has an id and an array of numbers.
    """
    spark = vectors.sparkSession
    rows, dimension = whole_numbers(vectors)
    if not dimension:
        return spark.createDataFrame([], SCHEMA)
    distinct = stored(rows.select("y").distinct(), "distinct-vectors")
    model = fit(distinct, dimension, components)
    if model is None:
        return spark.createDataFrame([], SCHEMA)
    error = identity_error(distinct, model)
    wanted = min(components, dimension)
    shares = [*model.shares, *[0.0 if model.trace else None] * (wanted - len(model.shares))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y = matrix(batch.column("y"), dimension)
            rows_in = len(y)
            w = model.whitened(y)
            missing = np.ones((rows_in, wanted), bool)
            missing[:, : w.shape[1]] = False
            w = np.concatenate((w, np.zeros((rows_in, wanted - w.shape[1]))), axis=1)
            each = pa.array(np.repeat(np.arange(rows_in), wanted))
            columns = [
                batch.column("id").take(each),
                pa.array(np.tile(np.arange(1, wanted + 1, dtype=np.int32), rows_in)),
                pa.array(np.full(rows_in * wanted, model.n)),
                pa.array(model.deviation(y), pa.int64()).take(each),
                pa.array(w.ravel(), mask=missing.ravel()),
                pa.array(shares * rows_in, pa.float64()),
                pa.array([error] * (rows_in * wanted), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCHEMA.split(", ")])

    return bounded_batches(rows.select(F.col("id").cast("long").alias("id"), "y")).mapInArrow(run, SCHEMA)


def embeddings_whitened(embeddings: DataFrame) -> DataFrame:
    """``whiten`` over a table with vec_id and embedding."""
    return whiten(pick(embeddings, "vec_id", "embedding"))
