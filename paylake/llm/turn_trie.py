"""The prefix trie of conversations: shared beginnings counted once, by double-array tries.

A node stands for a distinct sequence of first turns (role, text), the root for the empty one. A
conversation is cut into segments of ``SEGMENT`` turns at most, so a very long one is many rows. Equal
segments behind equal prefixes are combined, and what is left is dealt by range to shards of
neighbouring paths. A shard numbers its turns densely, packs BASE and CHECK arrays over
these numbers, walks its paths through them and hands on one row for each node that it
meets. A node is known globally by its depth and the exclusive or of 128 bits for each turn at
its place, so the aggregates of upper nodes, which several shards meet, are merged by one grouping.

Sums over subtrees take a second walk. A node belongs to its smallest member, the ``owner``; along the
owner's turns what is owned is summed from the end. A node's subtree is owned by members of the
node alone, so its sum is that of its members' sums at its depth.

Places of turns come from one sort by range and the numbers of rows before each partition, so a
conversation that holds a third of all turns is spread like any other rows. Texts go through that sort
and no further; after it a turn is two numbers and a length.

Defined results: null roles and texts are empty texts; turns of one number are ordered by role, then text,
and repeated rows are turns of their own. Rows without conv_id take no part. Without
conversations there is no node, not even the root. A negative conv_id c has c - c % 5 toward zero.
The digest of a node where very many conversations end is one SHA-256 over all their ids, which is
computed in order by one task, from a sorted stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.common import bounded_batches, pick, stored

#: Turns of a segment: no row holds more.
SEGMENT = 256

#: Free places that packing tries for the children of one node before it goes to the end of the arrays.
TRIES = 64

FREE, ROOT = -1, -2

NODE = ("depth", "x1", "x2")


class DoubleArray:
    """BASE and CHECK of a trie: from ``slot`` the symbol ``code`` leads to BASE[slot] + code if CHECK there is ``slot``.

    Slot 0 is the root.
    """

    def __init__(self) -> None:
        self.base = np.zeros(1024, np.int64)
        self.check = np.full(1024, FREE, np.int64)
        self.check[0] = ROOT
        self.end = 1

    def _room(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate((self.base, np.zeros(more, np.int64)))
            self.check = np.concatenate((self.check, np.full(more, FREE, np.int64)))

    def add(self, parents: np.ndarray, codes: np.ndarray) -> None:
        """Children of slots that have none yet: distinct pairs, sorted by parent, then code."""
        first = np.flatnonzero(np.concatenate(([True], parents[1:] != parents[:-1])))
        counts = np.diff(np.append(first, len(parents)))
        for at, count in zip(first[counts > 1].tolist(), counts[counts > 1].tolist(), strict=True):
            own = codes[at : at + count]
            shape = own - own[0]
            self._room(self.end + int(shape[-1]) + 1)
            place = self.end
            for free in np.flatnonzero(self.check[: self.end] == FREE)[:TRIES].tolist():
                if (self.check[free + shape] == FREE).all():
                    place = free
                    break
            self.base[parents[at]] = place - own[0]
            self.check[place + shape] = parents[at]
            self.end = max(self.end, place + int(shape[-1]) + 1)
        # Only children fill free places one after another.
        only = first[counts == 1]
        places = np.flatnonzero(self.check[: self.end] == FREE)[: len(only)]
        missing = len(only) - len(places)
        self._room(self.end + missing)
        places = np.concatenate((places, np.arange(self.end, self.end + missing)))
        self.base[parents[only]] = places - codes[only]
        self.check[places] = parents[only]
        self.end += missing

    def step(self, slots: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children of slots by codes; every one must be there."""
        found = self.base[slots] + codes
        if not (self.check[found] == slots).all():
            raise ValueError("a path left the trie")
        return found


def dense(*columns: np.ndarray) -> np.ndarray:
    """Numbers from 0 for equal tuples, in the order in which they first come."""
    rows = np.stack(columns, axis=1)
    _, first, number = np.unique(rows, axis=0, return_index=True, return_inverse=True)
    place = np.empty(len(first), np.int64)
    place[np.argsort(first)] = np.arange(len(first))
    return place[number.reshape(-1)]


class Shard:
    """The trie of some paths and, for each step, the live paths and the slots where they are."""

    def __init__(self, batch: pa.RecordBatch, segment: int) -> None:
        self.segment = segment
        turns = batch.column("turns")
        sizes = np.diff(turns.offsets.to_numpy())
        flat = turns.flatten()
        self.id1, self.id2, self.bytes = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("id1", "id2", "bytes"))
        self.offset = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        self.sizes = sizes
        self.level, start1, start2 = (batch.column(c).to_numpy() for c in ("level", "s1", "s2"))
        self.array = DoubleArray()
        # The first symbol is the prefix in front of the segment.
        at = self._descend(np.zeros(len(sizes), np.int64), dense(self.level, start1, start2))
        self.steps = []
        x1, x2 = start1.copy(), start2.copy()
        for step in range(int(sizes.max(initial=0))):
            live = np.flatnonzero(sizes > step)
            turn = self.offset[live] + step
            at[live] = self._descend(at[live], dense(self.id1[turn], self.id2[turn]))
            before1, before2 = x1[live], x2[live]
            x1[live] ^= self.id1[turn]
            x2[live] ^= self.id2[turn]
            self.steps.append((live, at[live], x1[live], x2[live], before1, before2, turn))

    def _descend(self, slots: np.ndarray, codes: np.ndarray) -> np.ndarray:
        pairs = np.unique(np.stack((slots, codes), axis=1), axis=0)
        self.array.add(pairs[:, 0], pairs[:, 1])
        return self.array.step(slots, codes)

    def each(self) -> Iterator[tuple]:
        """From the first turn on: live paths, and of their nodes: slots, depths, ids and parents' ids, bytes."""
        for step, (live, slots, x1, x2, p1, p2, turn) in enumerate(self.steps):
            yield live, slots, self.level[live] * self.segment + step + 1, x1, x2, p1, p2, self.bytes[turn]


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


def _count(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[pa.RecordBatch]:
    """Nodes of each shard: members and the smallest of them."""
    for batch in batches:
        if not batch.num_rows:
            continue
        shard = Shard(batch, segment)
        n, owner = (batch.column(c).to_numpy() for c in ("n", "owner"))
        for live, slots, depth, x1, x2, p1, p2, size in shard.each():
            at, first, inverse = np.unique(slots, return_index=True, return_inverse=True)
            members = np.zeros(len(at), np.int64)
            np.add.at(members, inverse, n[live])
            least = np.full(len(at), np.iinfo(np.int64).max)
            np.minimum.at(least, inverse, owner[live])
            made = {"depth": depth, "x1": x1, "x2": x2, "p1": p1, "p2": p2, "bytes": size}
            yield _batch({**{k: v[first] for k, v in made.items()}, "n_convs": members, "owner": least})


def _sum(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[pa.RecordBatch]:
    """Nodes of each shard with the sums of what their paths own from there on."""
    for batch in batches:
        if not batch.num_rows:
            continue
        shard = Shard(batch, segment)
        owned = batch.column("owned")
        path = np.repeat(np.arange(batch.num_rows), np.diff(owned.offsets.to_numpy()))
        entry = owned.flatten()
        turn = shard.offset[path] + entry.field("depth").to_numpy(zero_copy_only=False) - 1 - shard.level[path] * segment
        total = [batch.column(c).to_numpy().copy() for c in ("deeper_saved", "deeper_leaves")]
        value = [np.zeros(len(shard.bytes), np.int64) for _ in total]
        for v, c in zip(value, ("saved", "leaf"), strict=True):
            v[turn] = entry.field(c).to_numpy(zero_copy_only=False)
        for step, (live, slots, depth, x1, x2, *_) in reversed(list(enumerate(shard.each()))):
            at, first, inverse = np.unique(slots, return_index=True, return_inverse=True)
            sums = []
            for t, v in zip(total, value, strict=True):
                t[live] += v[shard.offset[live] + step]
                own = np.zeros(len(at), np.int64)
                np.add.at(own, inverse, t[live])
                sums.append(own)
            yield _batch({"depth": depth[first], "x1": x1[first], "x2": x2[first], "saved_tokens": sums[0], "n_leaves": sums[1]})


def placed(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their place in their conversation, and the runs (conv_id, part) that they lie in.

    Rows: conv_id, part, at (number in the order of all), turn (digest of role and text), bytes. Runs:
    conv_id, part, first (least ``at``), n (rows), before (rows of the conversation in earlier parts).
    """
    known = pick(turns, "conv_id", "turn", "role", "text").where("conv_id is not null")
    whole = known.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    ordered = whole.repartitionByRange(*order).sortWithinPartitions(*order)
    digest = F.md5(F.encode(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), "UTF-8"))
    rows = stored(
        ordered.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("at"),
            digest.alias("turn"),
            F.octet_length("text").cast("long").alias("bytes"),
        ),
        "turns",
    )
    runs = rows.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return rows, stored(runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "runs")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: turns (conv_id, place, turn, bytes), and conversations (conv_id, length).

    The first h turns come from conversation c - c % 5, the rest are c's own after its first h;
    h is crc32 of the decimal c modulo 9.
    """
    rows, runs = placed(turns)
    own = runs.groupBy("conv_id").agg(F.sum("n").alias("own"))
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(9))
    convs = own.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"), taken.alias("h"))
    bases = own.select(F.col("conv_id").alias("base"), F.col("own").alias("of_base"))
    head = F.least("h", F.coalesce("of_base", F.lit(0)))
    convs = convs.join(bases, "base", "left").withColumn("head", head)
    convs = stored(convs.withColumn("length", F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "conversations")
    place = F.col("at") - F.col("first") + F.col("before")
    numbered = stored(
        rows.join(runs.join(convs.select("conv_id", "h", "head"), "conv_id"), ["conv_id", "part"]).select(
            "conv_id", place.alias("place"), "turn", "bytes", "h", "head"
        ),
        "numbered",
    )
    later = numbered.where("place >= h").withColumn("place", F.col("head") + F.col("place") - F.col("h"))
    lent = numbered.where("place < 8 and conv_id % 5 = 0").select(F.col("conv_id").alias("base"), "place", "turn", "bytes")
    first = lent.join(convs.where("head > 0").select("base", "conv_id", "head"), "base").where("place < head")
    columns = ("conv_id", "place", "turn", "bytes")
    return first.select(*columns).unionByName(later.select(*columns)), convs.select("conv_id", "length")


def segments(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv_id, level, s1, s2 (id of the prefix in front), turns (at most ``segment``) and x1, x2 (of its turns)."""
    numbered = turns.select(
        "conv_id",
        F.floor(F.col("place") / segment).alias("level"),
        "place",
        F.xxhash64("turn", "place").alias("id1"),
        F.xxhash64("place", "turn").alias("id2"),
        "bytes",
    )
    listed = F.array_sort(F.collect_list(F.struct("place", "id1", "id2", "bytes")))
    plain = F.transform(listed, lambda t: F.struct(t["id1"].alias("id1"), t["id2"].alias("id2"), t["bytes"].alias("bytes")))
    made = numbered.groupBy("conv_id", "level").agg(plain.alias("turns"), F.bit_xor("id1").alias("x1"), F.bit_xor("id2").alias("x2"))
    made = stored(made, "segments")
    # Few conversations have a second segment.
    longer = made.where("level > 0").select("conv_id").distinct()
    earlier = Window.partitionBy("conv_id").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    front = made.select("conv_id", "level", "x1", "x2").join(longer, "conv_id", "left_semi")
    front = front.select("conv_id", "level", *(F.bit_xor(f"x{k}").over(earlier).alias(f"s{k}") for k in (1, 2))).where("level > 0")
    zero = F.lit(0).cast("long")
    head = made.where("level = 0").withColumns({"s1": zero, "s2": zero})
    return head.unionByName(made.where("level > 0").join(front, ["conv_id", "level"]))


def _shards(paths: DataFrame, *last: str) -> DataFrame:
    """Paths dealt by range, neighbours together; bounded batches of them are the shards."""
    order = ["level", "s1", "s2", "turns", *last]
    return bounded_batches(paths.repartitionByRange(*order).sortWithinPartitions(*order))


def _digests(ends: DataFrame) -> DataFrame:
    """For each node where conversations end the digest of their ids in order; a stream, so no group is in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            out = []
            for *key, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id")), strict=True):
                if key == node:
                    digest.update(b",%d" % conv)
                else:
                    if node:
                        out.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256(b"%d" % conv)
            yield rows_of(out)
        if node:
            yield rows_of([(*node, digest.hexdigest())])

    def rows_of(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*NODE, "ends_sha256"])

    dealt = ends.repartition(*NODE).sortWithinPartitions(*NODE, "conv_id")
    return bounded_batches(dealt).mapInArrow(run, "depth long, x1 long, x2 long, ends_sha256 string")


def _owned(nodes: DataFrame, segment: int) -> DataFrame:
    """What each owner has in each segment: the nodes' own values, and the sums of its later segments."""
    level = F.floor((F.col("depth") - 1) / segment).alias("level")
    entry = F.struct("depth", "saved", "leaf")
    own = nodes.groupBy(F.col("owner").alias("conv_id"), level).agg(
        F.collect_list(entry).alias("owned"), F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves")
    )
    return stored(own, "owned")


def _deeper(own: DataFrame, parts: DataFrame) -> DataFrame:
    """For conversations of several segments, the sums of what they own in later ones."""
    longer = parts.where("level > 0").select("conv_id").distinct()
    every = parts.select("conv_id", "level").join(longer, "conv_id", "left_semi").join(own.drop("owned"), ["conv_id", "level"], "left")
    later = Window.partitionBy("conv_id").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, -1)
    sums = (F.sum(c).over(later).alias(f"deeper_{c}") for c in ("saved", "leaves"))
    return every.select("conv_id", "level", *sums).where("deeper_saved > 0 or deeper_leaves > 0")


def trie(turns: DataFrame, convs: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The nodes of the trie of conversations.

    ``turns`` has conv_id, place (from 0, without gaps), turn (a digest) and bytes; ``convs`` every conv_id with
    its length, also those without turns.
    """
    parts = stored(segments(turns, segment), "parts")
    paths = parts.groupBy("level", "s1", "s2", "turns").agg(F.count("*").alias("n"), F.min("conv_id").alias("owner"))
    paths = stored(paths, "paths")
    met = _shards(paths).mapInArrow(lambda batches: _count(batches, segment), "depth long, x1 long, x2 long, p1 long, p2 long, bytes long, n_convs long, owner long")
    merged = met.groupBy(*NODE).agg(
        F.sum("n_convs").alias("n_convs"), F.min("owner").alias("owner"), *(F.min(c).alias(c) for c in ("p1", "p2", "bytes"))
    )
    zero = F.lit(0).cast("long")
    top = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("owner")).where("n_convs > 0")
    top = top.select(*(zero.alias(c) for c in NODE), "n_convs", "owner", *(zero.alias(c) for c in ("p1", "p2", "bytes")))
    merged = stored(merged.unionByName(top), "merged")
    below = merged.where("depth > 0")
    children = below.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2")).agg(
        F.count("*").alias("n_children")
    )
    nodes = merged.join(children, list(NODE), "left").withColumn("n_children", F.coalesce("n_children", zero))
    saved, leaf = (F.col("n_convs") - 1) * F.col("bytes"), F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    nodes = stored(nodes.withColumns({"saved": saved, "leaf": leaf}), "nodes")

    own = _owned(nodes.where("depth > 0"), segment)
    values = own.select("conv_id", "level", "owned").join(_deeper(own, parts), ["conv_id", "level"], "full")
    nothing = F.array().cast("array<struct<depth:bigint,saved:bigint,leaf:bigint>>")
    filled = {"owned": F.coalesce("owned", nothing), **{c: F.coalesce(c, zero) for c in ("deeper_saved", "deeper_leaves")}}
    walked = stored(parts.drop("x1", "x2").join(values, ["conv_id", "level"]).withColumns(filled), "walked")
    sums = _shards(walked, "conv_id").mapInArrow(lambda batches: _sum(batches, segment), "depth long, x1 long, x2 long, saved_tokens long, n_leaves long")
    sums = sums.groupBy(*NODE).agg(*(F.sum(c).alias(c) for c in ("saved_tokens", "n_leaves")))
    whole = nodes.agg(F.sum("saved").alias("saved_tokens"), F.sum("leaf").alias("n_leaves")).where("n_leaves > 0")
    sums = sums.unionByName(whole.select(*(zero.alias(c) for c in NODE), "saved_tokens", "n_leaves"))

    last = parts.groupBy("conv_id").agg(*(F.bit_xor(c).alias(c) for c in ("x1", "x2")))
    ends = convs.join(last, "conv_id", "left").select("conv_id", F.col("length").alias("depth"), *(F.coalesce(c, zero).alias(c) for c in ("x1", "x2")))
    parent = nodes.select(F.col("depth").alias("depth_of"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("owner").alias("parent_conv_id"))
    named = nodes.withColumn("depth_of", F.col("depth") - 1).join(parent, ["depth_of", "p1", "p2"], "left")
    full = named.join(sums, list(NODE)).join(_digests(ends), list(NODE), "left")
    return full.select(
        F.col("owner").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


#: The same in SQL: every node as the list of its turns.
SQL = """
WITH crc AS (
  SELECT list(v ORDER BY i) AS steps FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) t(i))
), own AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS seq
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), taken AS (
  SELECT conv_id, seq, conv_id - conv_id % 5 AS base,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda a, b: xor(a >> 8, steps[1 + (xor(a, b) & 255)])), 4294967295) % 9 AS h
  FROM own, crc
), rebuilt AS (
  SELECT t.conv_id, list_concat(coalesce(b.seq, [])[1:h], t.seq[h + 1:]) AS seq
  FROM taken t LEFT JOIN own b ON b.conv_id = t.base
), steps AS (
  SELECT conv_id, seq[1:d] AS node, d AS depth, len(seq) = d AS final
  FROM rebuilt, LATERAL (SELECT unnest(range(len(seq) + 1)) AS d)
), nodes AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (final), '')) AS ends_sha256
  FROM steps GROUP BY node, depth
), children AS (
  SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
), valued AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children,
    CASE WHEN n.depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(n.node[-1].text) END AS saved
  FROM nodes n LEFT JOIN children c ON c.node = n.node
), subtrees AS (
  SELECT node[1:d] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM valued, LATERAL (SELECT unnest(range(depth + 1)) AS d) GROUP BY 1
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, v.ends_sha256
FROM valued v JOIN subtrees s ON s.node = v.node
LEFT JOIN nodes p ON v.depth > 0 AND p.node = v.node[1:v.depth - 1]
"""


def conversation_trie(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The trie of the rebuilt conversations of a table with conv_id, turn, role and text."""
    return trie(*rebuilt(conversations), segment)
