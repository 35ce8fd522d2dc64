"""Pairs of members of buckets, found inside tasks: what near-duplicate searches share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import bounded_batches, stored
from paylake.operators.keys import bit_set

#: Pairs that a task collects before it sends them.
AT_ONCE = 1 << 16

#: Nodes, parts (two if blocks of a bucket meet) and components of the members of one unit of work, and their other
#: columns; returns the pairs of nodes.
Joined = Callable[[np.ndarray, np.ndarray, np.ndarray, pa.Table], tuple[np.ndarray, np.ndarray]]


def repeated(rows: DataFrame) -> DataFrame:
    """(node, key, ...) rows of keys that several rows have, once each; stored.

    Most keys come once. Their rows are dropped by a bit set of the others where they are made, before a join
    shuffles them.
    """
    again = stored(rows.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "repeated")
    return stored(bit_set(again, "key").maybe(rows, "key").distinct().join(again, "key"), "members")


def with_pivots(members: DataFrame) -> DataFrame:
    """(key, node, pivot) of the buckets with several nodes; the pivot is the least."""
    several = members.groupBy("key").agg(F.count("*").alias("c"), F.min("node").alias("pivot")).where("c > 1").select("key", "pivot")
    return stored(members.select("key", "node").join(stored(several, "pivots"), "key"), "buckets")


def mixed(members: DataFrame, about: DataFrame, found: DataFrame) -> DataFrame:
    """The members of buckets that hold several components, with ``component`` and the columns of ``about``.

    ``found`` has nodes ``u`` with the least node ``v`` of their component.
    """
    named = members.select("key", "node").join(found.select(F.col("u").alias("node"), "v"), "node", "left")
    named = stored(named.select("key", "node", F.coalesce("v", "node").alias("component")), "named")
    several = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    return stored(named.join(stored(several.select("key"), "mixed"), "key").join(about, "node"), "open")


def join_members(rows: DataFrame, joined: Joined, block: int) -> DataFrame:
    """Pairs (u, v), u > v, that ``joined`` finds among the members of each bucket, each pair once.

    ``rows`` has key, node, component and what ``joined`` needs. Buckets of more members than a block are cut into
    blocks, and each two blocks meet in one unit of work, so no task holds more than two.
    """
    sizes = rows.groupBy("key").agg(F.ceil(F.count("*") / block).alias("blocks"))
    many = stored(sizes.where("blocks > 1"), "many")
    values = [c for c in rows.columns if c not in ("key", "node", "component")]
    zero = F.lit(0).cast("long")
    one = rows.join(many, "key", "left_anti").withColumns({"i": zero, "j": zero, "part": zero})
    cut = rows.join(many, "key").withColumn("part", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("long"))
    cut = cut.withColumn("other", F.explode(F.sequence(zero, F.col("blocks") - 1)))
    cut = cut.withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")})
    columns = ("key", "i", "j", "part", "node", "component", *values)
    units = one.select(*columns).unionByName(cut.select(*columns))
    dealt = units.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def unit(pieces: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
        whole = pa.Table.from_batches(pieces)
        part, node, component = (whole.column(c).to_numpy() for c in ("part", "node", "component"))
        if component.min() == component.max():
            return node[:0], node[:0]
        return joined(node, part, component, whole)

    def sent(found: list) -> pa.RecordBatch:
        u, v = (np.concatenate([*(f[k] for f in found), np.zeros(0, np.int64)]).astype(np.int64) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, key, found, pairs = [], None, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            names = np.stack([batch.column(c).to_numpy() for c in ("key", "i", "j")], axis=1)
            if not pairs:
                found = []
            edges = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1).tolist(), len(names)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if key != tuple(names[a]) and waiting:
                    found.append(unit(waiting))
                    waiting = []
                    pairs += len(found[-1][0])
                    if pairs > AT_ONCE:
                        yield sent(found)
                        found, pairs = [], 0
                key = tuple(names[a])
                waiting.append(batch.slice(a, b - a))
        if waiting:
            found.append(unit(waiting))
        yield sent(found)

    return bounded_batches(dealt).mapInArrow(run, "u long, v long").where("u > v").distinct()


def best_partners(node: np.ndarray, a: np.ndarray, b: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of places (a, b) those that are the best of one of their two, by the greatest score, then the least node."""
    mine, other, score = np.concatenate((a, b)), np.concatenate((b, a)), np.concatenate((score, score))
    order = np.lexsort((node[other], -score, mine))
    mine, other = mine[order], other[order]
    first = np.concatenate(([True], mine[1:] != mine[:-1]))[: len(mine)]
    return mine[first], other[first]
