"""Nearest neighbours by inner product from randomly rotated one-bit codes.

Vectors are scaled to length 1, padded to at least ``CODE_BITS`` dimensions and turned by a random rotation, and only the
signs of the turned components are kept, packed into words, with two correction scalars: the length,
and the inner product of the unit vector with its own code. A query is turned the same way and its components are rounded to
``QUERY_BITS`` bits, which lie in one plane of words for each bit: the inner product of query and code is then a sum of
numbers of bits set in both. Divided by the correction scalar it estimates the inner product without bias, with a bound
on the error that holds but for a small probability.

Codes alone meet: queries and candidates are dealt to blocks and each block of queries meets each
block of candidates in one task, twice. The first time each query gets a score that its ``k`` nearest must reach,
the ``k``-th greatest lower bound over all blocks. The second time the candidates whose upper bound reaches it are found. These
are joined with the original vectors and reranked exactly.

Lengths are kept apart from directions and in double precision, so very small and very large vectors are like any
others; where a bound overflows it rules nothing out.

Defined results: vectors that are null, zero or empty, hold null or non-finite components, have
another length than most, or have no id take no part. Of rows that repeat an id the
least vector counts. With fewer candidates than ``k`` all are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.common import bounded_batches, stored

K = 20

#: Bits of a code at least; more dimensions have a bit each.
CODE_BITS = 512

#: Bits of a rounded component of a query.
QUERY_BITS = 4

#: Rows that meet in one task, at most about so many.
QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 32768

#: Errors stay within this many times their scale, but for a chance of about 1 in 160 on the side that matters.
ERROR_FACTOR = 2.5

SEED = 20240607


def code_bits(dimension: int) -> int:
    return max(CODE_BITS, -(-dimension // 64) * 64)


def rotation(dimension: int, bits: int | None = None, seed: int = SEED) -> np.ndarray:
    """The rows of a random rotation of ``bits`` dimensions that turn vectors with zeros behind; the same in every task."""
    wide = bits or code_bits(dimension)
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((wide, dimension)))
    return (q * np.sign(np.diag(r))).T


def units(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and lengths; components are scaled first, so that no square is lost or overflows."""
    largest = np.abs(vectors).max(axis=1)
    scaled = vectors / largest[:, None]
    size = np.sqrt((scaled * scaled).sum(axis=1))
    with np.errstate(over="ignore"):
        return scaled / size[:, None], largest * size


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (words of 64 sign bits), lengths, and inner products of the unit vectors with their codes."""
    direction, length = units(vectors)
    turned = direction @ turn
    agreement = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
    return np.packbits(turned > 0, axis=1, bitorder="little").view(np.uint64), length, agreement


def rounded(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Queries as bit planes (query, bit, word), least values, steps between values, and sums of the components."""
    turned = units(vectors)[0] @ turn
    low = turned.min(axis=1)
    step = np.maximum((turned.max(axis=1) - low) / (2**QUERY_BITS - 1), 1e-300)
    number = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
    planes = [np.packbits((number >> b) & 1, axis=1, bitorder="little").view(np.uint64) for b in range(QUERY_BITS)]
    return np.stack(planes, axis=1), low, step, turned.sum(axis=1)


def cosines(planes: np.ndarray, low, step, total, codes: np.ndarray, ones: np.ndarray, agreement: np.ndarray) -> np.ndarray:
    """Estimated cosines of one query with coded vectors. ``codes`` has a row for each word, ``ones`` the bits set in a code."""
    both = np.zeros(codes.shape[1], np.int32)
    for b in range(QUERY_BITS):
        found = np.zeros(codes.shape[1], np.int32)
        for w in range(len(codes)):
            found += np.bitwise_count(codes[w] & planes[b, w])
        both += found << b
    bits = 64 * len(codes)
    return (2 * (low * ones + step * both) - total) / (np.sqrt(bits) * agreement)


def margins(step: float, bits: int, agreement: np.ndarray, factor: float = ERROR_FACTOR) -> np.ndarray:
    """How far the estimates may be off: by the code, and by the rounding of the query."""
    by_code = np.maximum(1 / agreement**2 - 1, 0) / max(bits - 1, 1)
    return factor * np.sqrt(by_code + step**2 / 12 / agreement**2)


def bounds(queries, codes: np.ndarray, length: np.ndarray, agreement: np.ndarray, factor: float = ERROR_FACTOR) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each rounded query the least and greatest values that its inner products with the coded vectors may have, over its length."""
    words = np.ascontiguousarray(codes.T)
    ones = np.bitwise_count(words).sum(axis=0, dtype=np.int64)
    for planes, low, step, total in zip(*queries, strict=True):
        found = cosines(planes, low, step, total, words, ones, agreement)
        off = margins(step, 64 * len(words), agreement, factor)
        with np.errstate(over="ignore", under="ignore"):
            yield (found - off) * length, (found + off) * length


def usable(vectors: DataFrame) -> DataFrame:
    """(id, vector) rows that take part, one for each id; the vector in double precision."""
    sound = vectors.toDF("id", "vector").select("id", F.col("vector").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = sound.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    return sound.groupBy("id").agg(F.min("vector").alias("vector"))


def coded(sound: DataFrame, dimension: int) -> DataFrame:
    """The index: every id with its code, length and agreement."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dimension)
        for batch in batches:
            if batch.num_rows:
                codes, length, agreement = encode(_matrix(batch.column("vector"), dimension), turn)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(map(bytes, codes), pa.binary()), pa.array(length), pa.array(agreement)],
                    names=["id", "code", "length", "agreement"],
                )

    return bounded_batches(sound).mapInArrow(run, "id long, code binary, length double, agreement double")


def asked(sound: DataFrame, dimension: int) -> DataFrame:
    """The queries: ids with their bit planes and what their values are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = rotation(dimension)
        for batch in batches:
            if batch.num_rows:
                planes, *values = rounded(_matrix(batch.column("vector"), dimension), turn)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(map(bytes, planes), pa.binary()), *map(pa.array, values)],
                    names=["query_id", "planes", "low", "step", "total"],
                )

    return bounded_batches(sound).mapInArrow(run, "query_id long, planes binary, low double, step double, total double")


def _matrix(column: pa.ListArray, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dimension)


def _words(column: pd.Series, *shape: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint64).reshape(len(column), *shape)


def _sides(left: pd.DataFrame, right: pd.DataFrame, words: int):
    queries = (_words(left["planes"], QUERY_BITS, words), left["low"].to_numpy(), left["step"].to_numpy(), left["total"].to_numpy())
    return queries, _words(right["code"], words), right["length"].to_numpy(), right["agreement"].to_numpy()


def search(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest of each query.

    ``vectors`` has an id and an array of numbers; ``is_query`` is a condition on ``id``.
    """
    sound = stored(usable(vectors), "vectors")
    common = sound.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    # Of equally frequent lengths the larger counts.
    dimension, number = (common[0].n, common[0]["count"]) if common else (1, 0)
    sound = sound.where(F.size("vector") == dimension)
    words = code_bits(dimension) // 64
    index = stored(coded(sound, dimension), "codes")
    queries = stored(asked(sound.where(is_query), dimension), "queries")
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    blocks = max(1, -(-number // CANDIDATE_BLOCK))

    def every(count: int, name: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))).alias(name)

    def dealt(rows: DataFrame):
        """Queries and candidates in their blocks, each beside every block of the other side."""
        own = F.pmod(F.xxhash64("query_id"), F.lit(query_blocks)).alias("qb")
        other = F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("cb")
        left = rows.select("*", own, every(blocks, "cb"))
        return left.groupBy("qb", "cb").cogroup(index.select("*", every(query_blocks, "qb"), other).groupBy("qb", "cb"))

    def lows(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids = right["id"].to_numpy()
            for query, (low, _) in zip(left["query_id"], bounds(*_sides(left, right, words)), strict=True):
                low = low[(ids != query) & ~np.isnan(low)]
                best = low if len(low) <= k else np.partition(low, -k)[-k:]
                out.append(pd.DataFrame({"query_id": np.full(len(best), query), "low": best}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": np.zeros(0, np.int64), "low": np.zeros(0)})

    nth = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("low")))
    lower = dealt(queries).applyInPandas(lows, "query_id long, low double").withColumn("nth", nth).where(F.col("nth") <= k)
    least = stored(lower.where(F.col("nth") == k).select("query_id", F.col("low").alias("least")), "least")

    def likely(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids = right["id"].to_numpy()
            values = zip(left["query_id"], left["least"], bounds(*_sides(left, right, words)), strict=True)
            for query, least_value, (_, high) in values:
                # With fewer candidates than k, or a bound that is no number, nothing is ruled out.
                found = ids[(ids != query) & ~(high < least_value)]
                out.append(pd.DataFrame({"query_id": np.full(len(found), query), "vec_id": found}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64)})

    bound = queries.join(least, "query_id", "left")
    pairs = stored(dealt(bound).applyInPandas(likely, "query_id long, vec_id long"), "likely")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(over="ignore", under="ignore", invalid="ignore"):
                score = (_matrix(batch.column("one"), dimension) * _matrix(batch.column("two"), dimension)).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("vec_id"), pa.array(score)], names=["query_id", "vec_id", "score"])

    sides = [sound.select(F.col("id").alias(c), F.col("vector").alias(v)) for c, v in (("query_id", "one"), ("vec_id", "two"))]
    both = pairs.join(sides[0], "query_id").join(sides[1], "vec_id").select("query_id", "vec_id", "one", "two")
    exact = bounded_batches(both).mapInArrow(scored, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return exact.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
