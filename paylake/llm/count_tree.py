"""Jaccard join of word shingles by R-trees over vectors of counts.

A document's set holds the hashes of its word shingles; documents with equal sets are one class.
Hashes fall into groups, and the counts of the groups are a point. Two sets share at most the sum over all
coordinates of the lesser counts, and for two boxes of points, of the lesser upper corners. Points are packed
into leaves and leaves into nodes; pairs of nodes, then of leaves, then of points go on only
if that bound reaches what a link of their least sizes needs. Pairs of points that are left are verified
on full sets.

One tree over all documents would not prune: in so many dimensions boxes of different documents
overlap. So there is a forest. A link leaves room for a known number of elements that only one set has,
at most ``radius``. Hashes are cut into more slices than that, and of linked sets some slices are equal;
a bucket holds the sets that agree in the (finest) counts of a slice, and each bucket has its tree. The number of slices
depends on the size in powers of two; a set that may be the larger one of a pair across such a border is
also cut as its smaller partner is. Of linked sets at least 1 + ``margin`` slices are equal. That leaves
room to go without buckets that say little: a set with no more than ``margin`` empty slices goes without
these, and one with as few in crowded buckets as are left of its margin leaves all of its crowded buckets, while
another equal slice still joins it with every linked set. Nothing is lost by that; sets with more stay in all.

In a bucket the least member is first compared with the others, so a group of near copies
becomes a component by a comparison for each member. Then the trees of buckets that still hold several
components are joined, points of different components only: each point with its best partner, and, once
these are verified, all pairs that are left. Crowded buckets are cut into blocks, and
each task joins two blocks. Every linked pair of different components is compared, so the components are
those of all links.

Defined results: a document is its ``doc_id``; rows that repeat an id are one document
with several texts. Without words or text the set is empty and the document alone.
A row without an id takes no part and its component is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.buckets import best_partners, join_members, mixed, repeated, with_pivots
from paylake.llm.common import bounded_batches, map_texts, pick, ragged, stored
from paylake.llm.neardup import component_ids, components, halves, linked, mix, shingle_sets, told_apart

#: A link needs 100 * intersection >= PERCENT * union.
PERCENT = 85

#: Words of a shingle.
WORDS = 4

#: Coordinates of a point.
GROUPS = 256

#: Entries of a node of a tree.
FANOUT = 16

#: A bucket of more members is crowded; one of more than a block is joined block by block.
CROWDED, BLOCK = 128, 512


def radius(size: int) -> int:
    """The most elements that only one of two linked sets has, if the smaller set has ``size``."""
    return (100 - PERCENT) * (size + 100 * size // PERCENT) // (100 + PERCENT)


def slices(band: int) -> tuple[int, int]:
    """Number of slices and margin for sets of less than 2 ** band elements; linked sets have 1 + margin equal slices."""
    most = radius((1 << band) - 1)
    margin = max(1, most // 8)
    return most + 1 + margin, margin


def slice_keys(sets: list[np.ndarray], bands: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys of the slices of each set, cut as for its band, and how many crowded ones it may leave (-1: none at all).

    A band of 0 stands for no keys.
    """
    shape = np.array([(0, 0)] + [slices(b) for b in range(1, int(bands.max(initial=0)) + 1)])
    number, margin = shape[bands, 0], shape[bands, 1]
    sizes = np.where(bands > 0, np.fromiter(map(len, sets), np.int64, len(sets)), 0)
    element = np.concatenate([*(s for s, b in zip(sets, bands.tolist(), strict=True) if b), np.zeros(0, np.uint64)])
    if not len(element):
        return [np.zeros(0, np.int64)] * len(sets), np.full(len(sets), -1)
    owner = np.repeat(np.arange(len(sets)), sizes)
    # Elements are in order, so those of a slice are neighbours.
    own = ((element >> np.uint64(32)) * number[owner].astype(np.uint64)) >> np.uint64(32)
    named = (bands.astype(np.uint64)[owner] << np.uint64(40)) + own
    first = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (owner[1:] != owner[:-1]))))
    sums = np.add.reduceat(mix(element), first)
    keys = mix(sums ^ mix(named[first])).view(np.int64)
    full = np.bincount(owner[first], minlength=len(sets))
    empty = number - full
    out = np.split(keys, np.cumsum(full)[:-1])
    for i in np.flatnonzero((empty > margin) & (bands > 0)).tolist():
        there = own[first][owner[first] == i]
        without = np.setdiff1d(np.arange(number[i], dtype=np.uint64), there)
        out[i] = np.concatenate((out[i], mix(mix((np.uint64(bands[i]) << np.uint64(40)) + without)).view(np.int64)))
    return out, np.where(empty > margin, -1, margin - empty)


def bands_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The band of each size, and the one below if a smaller partner may lie there; 0 for none."""
    own = np.array([int(s).bit_length() if radius(int(s)) or _may_be_larger(int(s)) else 0 for s in sizes], np.int64)
    below = np.array([b - 1 if b > 1 and PERCENT * int(s) <= 100 * ((1 << (b - 1)) - 1) else 0 for s, b in zip(sizes, own.tolist(), strict=True)], np.int64)
    return own, below


def _may_be_larger(size: int) -> bool:
    """Whether a smaller set can be linked with one of this size."""
    return 100 * (size - 1) >= PERCENT * size


def points(sets: list[np.ndarray]) -> np.ndarray:
    """The counts of the groups of each set."""
    owner = np.repeat(np.arange(len(sets)), np.fromiter(map(len, sets), np.int64, len(sets)))
    element = np.concatenate([*sets, np.zeros(0, np.uint64)])
    flat = np.bincount(owner * GROUPS + (element & np.uint64(GROUPS - 1)).astype(np.int64), minlength=len(sets) * GROUPS)
    return flat.reshape(-1, GROUPS).astype(np.int32)


def packed(point: np.ndarray) -> bytes:
    """A point in bytes: one for each count, or four if one of them needs more."""
    return (point.astype(np.uint8) if point.max(initial=0) < 256 else point.astype("<u4")).tobytes()


def unpacked(column: list[bytes]) -> np.ndarray:
    """Points from bytes, a row for each; 16 bits suffice for most."""
    if all(len(p) == GROUPS for p in column):
        return np.frombuffer(b"".join(column), np.uint8).reshape(-1, GROUPS).astype(np.int16)
    kinds = {GROUPS: np.uint8, 4 * GROUPS: np.dtype("<u4")}
    return np.stack([np.frombuffer(p, kinds[len(p)]).astype(np.int64) for p in column])


def sign(docs: DataFrame, words: int) -> DataFrame:
    """Replaces the text by n_shingles, node and other (two halves of the set's fingerprint), point, and keys with the margin
    left, for the own and the lower band."""

    def lists(values) -> pa.Array:
        edges = ragged(np.fromiter(map(len, values), np.int64, len(values)))
        return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(np.concatenate([*values, np.zeros(0, np.int64)])))

    def work(texts):
        sets = shingle_sets(texts, words)
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        own, below = bands_of(sizes)
        keys, spare = slice_keys(sets, own)
        low_keys, low_spare = slice_keys(sets, below)
        return {
            "n_shingles": sizes,
            **halves(sets),
            "point": pa.array(map(packed, points(sets)), pa.binary()),
            "keys": lists(keys),
            "low_keys": lists(low_keys),
            "spare": spare,
            "low_spare": low_spare,
        }

    schema = "n_shingles long, node long, other long, point binary, keys array<bigint>, low_keys array<bigint>, spare long, low_spare long"
    return map_texts(docs, schema, lambda: work)


def needed(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Elements that linked sets of these sizes share at least."""
    return -(-PERCENT * (one + two) // (100 + PERCENT))


def may_link(point_one: np.ndarray, size_one: np.ndarray, point_two: np.ndarray, size_two: np.ndarray) -> np.ndarray:
    """For each row whether the summed lesser counts reach what a link needs."""
    out = PERCENT * np.maximum(size_one, size_two) <= 100 * np.minimum(size_one, size_two)
    at = np.flatnonzero(out)
    for a in range(0, len(at), 1 << 15):
        part = at[a : a + (1 << 15)]
        shared = np.minimum(point_one[part], point_two[part]).sum(axis=1, dtype=np.int64)
        out[part] = shared >= needed(size_one[part], size_two[part])
    return out


class Tree:
    """A packed R-tree: entries in order of size and then of a coordinate of their own, ``FANOUT`` to a node."""

    def __init__(self, point: np.ndarray, size: np.ndarray) -> None:
        # Slabs of entries of like size, each in the order of the coordinate that differs most.
        by_size = np.argsort(size, kind="stable")
        slab = FANOUT * max(1, int(np.sqrt(len(size) / FANOUT)))
        parts = [by_size[a : a + slab] for a in range(0, len(by_size), slab)]
        parts = [p[np.argsort(point[p, point[p].var(axis=0).argmax()], kind="stable")] for p in parts]
        self.order = np.concatenate([*parts, np.zeros(0, np.int64)])
        # From the entries up to one root: upper corners, least and greatest sizes.
        self.levels = [(point[self.order], size[self.order], size[self.order])]
        while len(self.levels[-1][1]) > 1:
            high, least, most = self.levels[-1]
            first = np.arange(0, len(least), FANOUT)
            self.levels.append((np.maximum.reduceat(high, first), np.minimum.reduceat(least, first), np.maximum.reduceat(most, first)))

    def _possible(self, other: Tree, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        (high_a, least_a, most_a), (high_b, least_b, most_b) = self.levels[level], other.levels[level]
        out = (PERCENT * least_a[a] <= 100 * most_b[b]) & (PERCENT * least_b[b] <= 100 * most_a[a])
        at = np.flatnonzero(out)
        for c in range(0, len(at), 1 << 15):
            part = at[c : c + (1 << 15)]
            shared = np.minimum(high_a[a[part]], high_b[b[part]]).sum(axis=1, dtype=np.int64)
            out[part] = shared >= needed(least_a[a[part]], least_b[b[part]])
        return out

    def join(self, other: Tree) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of entries that may be linked; of a tree with itself each once."""
        # Trees of different heights meet at the top that both have.
        top = min(len(self.levels), len(other.levels)) - 1
        a, b = (x.ravel() for x in np.indices((len(self.levels[top][1]), len(other.levels[top][1]))))
        for level in range(top, -1, -1):
            if self is other:
                half = a <= b if level else a < b
                a, b = a[half], b[half]
            fit = self._possible(other, level, a, b)
            a, b = a[fit], b[fit]
            if level:
                a, b = self._children(other, level - 1, a, b)
        return self.order[a], other.order[b]

    def _children(self, other: Tree, level: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i, j = (x.ravel() for x in np.indices((FANOUT, FANOUT)))
        a, b = (a[:, None] * FANOUT + i).ravel(), (b[:, None] * FANOUT + j).ravel()
        there = (a < len(self.levels[level][1])) & (b < len(other.levels[level][1]))
        return a[there], b[there]


def _share(point: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum(point[a], point[b]).sum(axis=1, dtype=np.int64) / (size[a] + size[b])


def _joined(node: np.ndarray, part: np.ndarray, component: np.ndarray, size: np.ndarray, point: np.ndarray, best: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of nodes of different components that one unit of work finds possible."""
    if len(node) <= FANOUT:
        a, b = np.triu_indices(len(node), 1)
        fit = (component[a] != component[b]) & ((part[a] != part[b]) | (part.min() == part.max()))
        a, b = a[fit], b[fit]
        fit = may_link(point[a], size[a], point[b], size[b])
        return node[a[fit]], node[b[fit]]
    if part.min() == part.max():
        tree = Tree(point, size)
        a, b = tree.join(tree)
    else:
        one, two = np.flatnonzero(part == part.min()), np.flatnonzero(part != part.min())
        a, b = Tree(point[one], size[one]).join(Tree(point[two], size[two]))
        a, b = one[a], two[b]
    apart = component[a] != component[b]
    a, b = a[apart], b[apart]
    if best and len(a):
        score = np.concatenate([_share(point, size, a[c : c + 4096], b[c : c + 4096]) for c in range(0, len(a), 4096)])
        a, b = best_partners(node, a, b, score)
    return node[a], node[b]


def _join_buckets(rows: DataFrame, best: bool) -> DataFrame:
    """Possible pairs (u, v), u > v, of different components in the buckets of ``rows``, each once.

    ``rows`` has key, node, component, n and point.
    """

    def joined(node, part, component, table):
        return _joined(node, part, component, table.column("n").to_numpy(), unpacked(table.column("point").to_pylist()), best)

    return join_members(rows, joined, BLOCK)


def _possible(pairs: DataFrame, about: DataFrame) -> DataFrame:
    """The pairs (u, v) whose points leave a link possible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            point = [unpacked(batch.column(f"point_{c}").to_pylist()) for c in "uv"]
            size = [batch.column(f"n_{c}").to_numpy() for c in "uv"]
            fit = may_link(point[0], size[0], point[1], size[1])
            yield batch.select(["u", "v"]).filter(pa.array(fit))

    sides = [about.select(F.col("node").alias(c), F.col("point").alias(f"point_{c}"), F.col("n").alias(f"n_{c}")) for c in "uv"]
    return bounded_batches(pairs.join(sides[0], "u").join(sides[1], "v")).mapInArrow(run, "u long, v long")


def _members(sets: DataFrame) -> DataFrame:
    """(key, node, pivot) of all buckets with several sets, without those that a set may leave.

    Copies of a set give equal rows, which are one before they are counted for good.
    """
    tagged = F.concat(
        F.transform("keys", lambda k: F.struct(k.alias("key"), F.lit(False).alias("low"))),
        F.transform("low_keys", lambda k: F.struct(k.alias("key"), F.lit(True).alias("low"))),
    )
    rows = sets.select("node", F.explode(tagged).alias("k")).select("node", "k.key", "k.low")
    found = repeated(rows)
    crowded = found.where(F.col("members") > CROWDED)
    spare = F.when(F.col("low"), F.col("low_spare")).otherwise(F.col("spare"))
    room = sets.join(crowded.select("node").distinct(), "node", "left_semi").groupBy("node")
    room = room.agg(F.min("spare").alias("spare"), F.min("low_spare").alias("low_spare"))
    leaving = crowded.groupBy("node", "low").count().join(room, "node").where(F.col("count") <= spare).select("node", "low")
    stay = crowded.join(stored(leaving, "leaving"), ["node", "low"], "left_anti")
    left = found.where(F.col("members") <= CROWDED).select("key", "node").union(stay.select("key", "node"))
    return with_pivots(stored(left, "staying"))


def group(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of all documents: the least id that links reach."""
    docs = pick(docs, "doc_id", "text")
    signed = told_apart(stored(sign(docs, words), "signed"))
    known = signed.where("doc_id is not null and n_shingles > 0")
    members = _members(known)
    shared = members.select("node").distinct()
    about = known.select("node", F.col("n_shingles").alias("n"), "point").join(shared, "node", "left_semi")
    about = stored(about.dropDuplicates(["node"]), "about")

    first = members.where("node > pivot").select(F.col("node").alias("u"), F.col("pivot").alias("v")).distinct()
    tried = stored(_possible(first, about), "pairs")
    found = components(linked(tried, docs, signed, words, PERCENT))
    for best in (True, False):
        possible = stored(_join_buckets(mixed(members, about, found), best), "possible")
        if possible.isEmpty():
            break
        pairs = stored(possible.join(tried, ["u", "v"], "left_anti"), "pairs")
        tried = tried.union(pairs)
        links = linked(pairs, docs, signed, words, PERCENT)
        if not links.isEmpty():
            # Links and stars have the same components.
            found = components(found.union(links))

    of_doc = component_ids(known.select("doc_id", "node"), found)
    return (
        signed.select("doc_id", "n_shingles")
        .join(of_doc, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    )
