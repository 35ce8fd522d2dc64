"""Near-duplicate documents by SuperMinHash signatures, banding, verification and union-find.

A document's set holds the hashes of its word shingles. Documents with equal sets are
one class, found by a fingerprint of the set; only classes go on. Every element of a set
goes through the slots of the signature in an order of its own and offers its rank and
a random fraction; a slot keeps the least offer. The orders are permutations by a small network keyed by the
element, which numpy makes for all elements of a rank at once. After some ranks all slots are filled,
and the rest is not looked at.

Classes that agree in a band of slots share a bucket. Sets of up to ``SMALL`` elements get exact keys
in place of bands: of elements in one common
order, the first ``SHARED`` that two linked sets share stand near the front of both, so each set
has a key for every choice of ``SHARED`` of its first elements. Pairs within a bucket are not
listed. First the least member is compared with the others, on their full sets, and what
is linked becomes one component: a group of copies costs a comparison for each
member. Then, in buckets that still hold several components, members of different ones are compared, first
each with its best partner and at last all pairs that are left, unless sizes or parities
prove that they are no link: a group of hashes of which one set has an odd and the other an
even number holds an element that only one has. That is a bound, no estimate, so no linked
pair of a bucket that could join two components is left out. The one error at the threshold: a
pair whose smaller set has more than ``SMALL`` elements shares no bucket with a probability of 1 in
8 million for independent slots (40 bands of 5 slots at 0.8).

Defined results: a document is its ``doc_id``; rows that repeat an id are one document
with several texts. Without words or text the set is empty and the document alone.
A row without an id takes no part: its component is null and it is kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.buckets import best_partners, join_members, mixed, repeated, with_pivots
from paylake.llm.common import binaries, bounded_batches, map_texts, pick, ragged, stored
from paylake.operators.keys import bit_set

#: Slots of a signature, a power of 4. Bands times rows of them make the buckets.
SLOTS = 256
BANDS = 40
ROWS = 5

#: Rounds of the network that permutes the slots.
ROUNDS = 6

#: 64-bit words of the parities of a set, a bit for each group of hashes, and of their first fold.
PARITY_WORDS, FOLDED_WORDS = 64, 8

#: A link needs 100 * intersection >= PERCENT * union.
PERCENT = 80

#: Sets of up to so many elements are found by exact keys, of so many shared elements each.
SMALL, SHARED = 24, 3

#: Links, two numbers each, that one task may join.
ONE_TASK = 500_000

#: A bucket of more members is joined block by block.
BLOCK = 1024

#: The largest set that may be linked with a small one.
LARGEST_PARTNER = 100 * SMALL // PERCENT

_UNSET = np.uint64(2**64 - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit integers evenly (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A-Z are lower-cased. A text of fewer words has its whole sequence as one shingle.
    """
    from xxhash import xxh3_64_intdigest

    found: list[bytes] = []
    edges = [0]
    for text in texts:
        if text:
            found += text.encode().lower().split()
        edges.append(len(found))
    hashes = np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))
    windows = np.full(max(len(hashes) - words + 1, 0), words, np.uint64)
    for k in range(words):
        windows = mix(windows + hashes[k : k + len(windows)])
    sets = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b - a >= words:
            own = np.sort(windows[a : b - words + 1])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        else:
            own = np.full(min(b - a, 1), b - a, np.uint64)
            for h in hashes[a:b]:
                own = mix(own + h)
        sets.append(own)
    return sets


def order(keys: np.ndarray, rank: int, slots: int = SLOTS) -> np.ndarray:
    """The slot that each element, by its mixed hash, visits at a rank: a permutation of the slots of its own."""
    half = np.uint64((slots.bit_length() - 1) // 2)
    mask = (np.uint64(1) << half) - np.uint64(1)
    a, b = (np.full(len(keys), part, np.uint64) for part in (np.uint64(rank) >> half, np.uint64(rank) & mask))
    for turn in range(ROUNDS):
        a, b = b, a ^ (mix(keys + (b << np.uint64(3)) + np.uint64(turn)) & mask)
    return (a << half) | b


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash: a row of ``slots`` values for each set; unset ones for an empty set."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    out = np.full(len(sets) * slots, _UNSET)
    element = np.concatenate([*sets, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(sets)), sizes)
    key = mix(element)
    for rank in range(slots):
        if not len(element):
            break
        slot = order(key, rank, slots)
        fraction = mix(element + np.uint64((rank + 1) * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(32)
        np.minimum.at(out, owner * slots + slot.astype(np.int64), np.uint64(rank << 32) | fraction)
        # A filled slot can only be offered more from the next rank on.
        open_sets = (out.reshape(-1, slots) == _UNSET).any(axis=1)
        left = open_sets[owner]
        element, owner, key = element[left], owner[left], key[left]
    return out.reshape(-1, slots)


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    used = signature[:, : bands * rows].reshape(-1, bands, rows)
    keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), used.shape[:2])
    for r in range(rows):
        keys = mix(keys + used[:, :, r])
    return keys.view(np.int64)


def exact_keys(sets: list[np.ndarray]) -> list[np.ndarray]:
    """For each set of up to ``LARGEST_PARTNER`` elements keys of which it has one in common with every linked set of such a size.

    Of n elements a linked set has at least PERCENT * n / 100. Behind the element that is the last of the
    first ``SHARED`` common ones stand all other common ones, which bounds its place. Sets
    of so few elements that only equal ones are linked have no keys.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    out = [np.zeros(0, np.int64)] * len(sets)
    for n in np.unique(sizes[sizes <= LARGEST_PARTNER]).tolist():
        fewest = -(-PERCENT * n // 100)
        # The smallest linked set that is not equal has an element less, or the largest one more.
        if 100 * n < PERCENT * (n + 1) and 100 * (n - 1) < PERCENT * n:
            continue
        front = n - fewest + SHARED
        at = np.flatnonzero(sizes == n)
        first = np.stack([sets[i][:front] for i in at])
        chosen = np.array(list(combinations(range(front), SHARED)))
        keys = np.full((len(at), len(chosen)), mix(np.full(1, BANDS + 1, np.uint64))[0])
        for k in range(SHARED):
            keys = mix(keys + first[:, chosen[:, k]])
        for i, own in zip(at, keys.view(np.int64), strict=True):
            out[i] = own
    return out


def bucket_keys(sets: list[np.ndarray]) -> list[np.ndarray]:
    """The keys of each set's buckets: bands, exact keys if it is small, or both if it may be linked with small ones."""
    out = exact_keys(sets)
    banded = [i for i, s in enumerate(sets) if len(s) > SMALL]
    for i, own in zip(banded, band_keys(signatures([sets[i] for i in banded])), strict=True):
        out[i] = np.concatenate((own, out[i]))
    return out


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """Whether a set has an odd number of each group of hashes; in front the same for fewer, larger groups."""
    element = np.concatenate([*sets, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(sets)), np.fromiter(map(len, sets), np.int64, len(sets)))
    out = np.zeros(len(sets) * PARITY_WORDS, np.uint64)
    word = (element >> np.uint64(6)) % np.uint64(PARITY_WORDS)
    np.bitwise_xor.at(out, owner * PARITY_WORDS + word.astype(np.int64), np.uint64(1) << (element & np.uint64(63)))
    out = out.reshape(-1, PARITY_WORDS)
    folded = np.bitwise_xor.reduce(out.reshape(len(sets), PARITY_WORDS // FOLDED_WORDS, FOLDED_WORDS), axis=1)
    return np.concatenate((folded, out), axis=1).view(np.int64)


def fingerprint(elements: np.ndarray) -> bytes:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest()


def halves(sets: list[np.ndarray]) -> dict[str, np.ndarray]:
    """``node`` and ``other``: 128 bits that tell sets apart."""
    both = np.frombuffer(b"".join(map(fingerprint, sets)), np.int64).reshape(-1, 2)
    return {"node": both[:, 0], "other": both[:, 1]}


def told_apart(signed: DataFrame) -> DataFrame:
    """Different sets have different nodes: where half a fingerprint is not enough, the other half counts.

    Of n sets about n * n / 2 ** 65 pairs agree in 64 bits; these few are collected.
    """
    narrow = signed.where("n_shingles > 0").groupBy("node").agg(F.min("other").alias("low"), F.max("other").alias("high"))
    same = [r.node for r in narrow.where("low <> high").select("node").collect()]
    return signed.withColumn("node", F.when(F.col("node").isin(same), F.col("other")).otherwise(F.col("node"))) if same else signed


def sign(docs: DataFrame, words: int) -> DataFrame:
    """Replaces the text by ``n_shingles``, ``node`` and ``other`` (two halves of the set's fingerprint), ``bands`` (keys of
    its buckets) and ``parity``."""

    def lists(values) -> pa.Array:
        edges = ragged(np.fromiter(map(len, values), np.int64, len(values)))
        return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(np.concatenate([*values, np.zeros(0, np.int64)])))

    def work(texts):
        sets = shingle_sets(texts, words)
        return {
            "n_shingles": np.fromiter(map(len, sets), np.int64, len(sets)),
            **halves(sets),
            "bands": lists(bucket_keys(sets)),
            "parity": lists(parities(sets)),
        }

    return map_texts(docs, "n_shingles long, node long, other long, bands array<bigint>, parity array<bigint>", lambda: work)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links that a task has: a link from each node to the least it reaches."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        path = []
        while (up := parent.get(x, x)) != x:
            path.append(x)
            x = up
        for p in path:
            parent[p] = x
        return x

    for batch in batches:
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), strict=True):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    for a in range(0, len(nodes), 10_000):
        part = nodes[a : a + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array([parent[x] for x in part], pa.int64())], names=["u", "v"])


def _least(links: DataFrame) -> DataFrame:
    """Each ``u`` with the least of its ``v``, beside every link of ``u``."""
    # Stored, so that the join has two plain sides and a node with very many links can be split.
    least = stored(links.groupBy("u").agg(F.min("v").alias("m")), "least")
    return links.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """Nodes ``u`` with the least node ``v`` of their component; that node itself is left out.

    Links are pairs (u, v) of numbers. Few links are joined by union-find in one task. Of more, every task first joins
    what it has; then large and small stars alternate until each component is one star.
    """
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    links = stored(links, "distinct")
    if links.count() <= ONE_TASK:
        return stored(links.coalesce(1).mapInArrow(_forest, "u long, v long"), "forest")
    links = stored(links.mapInArrow(_forest, "u long, v long"), "forest")
    while not _stars(links):
        both = stored(links.union(links.select("v", "u")), "both")
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        large = stored(large.distinct(), "large")
        beside = _least(large)
        small = beside.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(beside.select("u", F.col("m").alias("v")))
        links = stored(small.distinct(), "small")
    return links


def _stars(links: DataFrame) -> bool:
    """Whether every node has one link, and that to a node without one."""
    several = links.groupBy("u").count().where("count > 1").select("u")
    chained = links.join(links.select(F.col("v").alias("u")), "u", "left_semi").select("u")
    return several.union(chained).isEmpty()


def verify(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those pairs (u, v) that are linked. ``sets`` has the full set of every ``node``: its sorted hashes as ``elements``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine, other = batch.column("set_u"), batch.column("set_v")
            keep = []
            for i in range(batch.num_rows):
                a = np.frombuffer(mine[i].as_buffer(), np.uint64)
                b = np.frombuffer(other[i].as_buffer(), np.uint64)
                both = np.sort(np.concatenate((a, b)), kind="stable")
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * shared >= percent * (len(a) + len(b) - shared))
            found = pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], names=["u", "v"])
            yield found.filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("u"), F.col("elements").alias("set_u"))
    right = sets.select(F.col("node").alias("v"), F.col("elements").alias("set_v"))
    return bounded_batches(pairs.join(left, "u").join(right, "v")).mapInArrow(run, "u long, v long")


def linked(pairs: DataFrame, docs: DataFrame, signed: DataFrame, words: int, percent: int = PERCENT) -> DataFrame:
    """Those pairs of nodes that are links, by full sets, which are made from the texts of these nodes again; stored."""
    nodes = stored(pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct(), "nodes")
    # One document for each node; a bit set keeps other texts out of the join.
    narrow = signed.where("doc_id is not null and n_shingles > 0").select("doc_id", "node", "other")
    wanted = narrow.join(nodes, "node").groupBy("node", "other").agg(F.min("doc_id").alias("doc_id"))
    wanted = stored(wanted, "wanted")
    texts = bit_set(wanted, "doc_id").maybe(docs, "doc_id").join(wanted, "doc_id")

    def work(found: list[str | None]) -> dict:
        own = shingle_sets(found, words)
        counts = np.fromiter(map(len, own), np.int64, len(own))
        made = halves(own)
        return {
            "made": made["node"],
            "made_other": made["other"],
            "elements": binaries(np.concatenate([*own, np.zeros(0, np.uint64)]), counts, 8),
        }

    # A repeated id may have several texts: only that of the node counts. A node may be the other half.
    sets = map_texts(texts, "made long, made_other long, elements binary", lambda: work).where("made_other = other and node in (made, made_other)")
    sets = stored(sets.select("node", "elements").dropDuplicates(["node"]), "sets")
    return stored(verify(pairs, sets, percent), "links")


def component_ids(ids: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, component_id) of the documents that are not the least of their component.

    ``ids`` has a (doc_id, node) row for each document and each of its sets, ``found`` nodes ``u`` with the least node ``v`` of
    their component. The sets of a repeated id are linked by it.
    """
    several = ids.groupBy("doc_id").agg(F.min("node").alias("v"), F.max("node").alias("u")).where("v < u").select("doc_id", "v")
    both = stored(ids.join(several, "doc_id").select(F.col("node").alias("u"), "v").where("u <> v"), "both")
    every = found if both.isEmpty() else components(found.union(both))
    named = ids.join(every.withColumnRenamed("u", "node"), "node", "left").select("doc_id", F.coalesce("v", "node").alias("component"))
    named = stored(named.distinct(), "components")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "component").select("doc_id", "component_id").where("doc_id > component_id")


def group(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of all documents.

    Linked documents are a component; it is named for its least id, and that one is kept.
    """
    docs = pick(docs, "doc_id", "text")
    signed = told_apart(stored(sign(docs, words), "signed"))
    known = signed.where("doc_id is not null and n_shingles > 0")
    members = with_pivots(repeated(known.select("node", F.explode("bands").alias("key"))))
    about = known.select("node", F.col("n_shingles").alias("n"), "parity").join(members.select("node").distinct(), "node", "left_semi")
    about = stored(about.dropDuplicates(["node"]), "about")

    first = members.where("node > pivot").select(F.col("node").alias("u"), F.col("pivot").alias("v")).distinct()
    tried = stored(_possible(first, about), "pairs")
    found = components(linked(tried, docs, signed, words))
    for best in (True, False):
        possible = stored(join_members(mixed(members, about, found), _joined(best), BLOCK), "possible")
        if possible.isEmpty():
            break
        pairs = stored(possible.join(tried, ["u", "v"], "left_anti"), "pairs")
        tried = tried.union(pairs)
        links = linked(pairs, docs, signed, words)
        if not links.isEmpty():
            # Links and stars have the same components.
            found = components(found.union(links))
    of_doc = component_ids(known.select("doc_id", "node"), found)
    return (
        signed.select("doc_id", "n_shingles")
        .join(of_doc, "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component_id", "doc_id").alias("component_id"),
            F.col("component_id").isNull().alias("kept"),
        )
    )


def _sizes_fit(one: Column, two: Column) -> Column:
    """Sizes alone may rule a link out."""
    return 100 * F.least(one, two) >= PERCENT * F.greatest(one, two)


def may_link(one: Column, two: Column, parity_one: Column, parity_two: Column) -> Column:
    """Whether two sets, by their sizes and parities, may be linked; every linked pair may.

    Let the sets have S elements together and D that only one of them has. At least as many
    elements as groups with different parities are in D, and a link is (100 + PERCENT) * D <=
    (100 - PERCENT) * S. The fold, which is quick to compare, comes first.
    """
    first = sum((F.bit_count(parity_one[i].bitwiseXOR(parity_two[i])) for i in range(1, FOLDED_WORDS)), F.bit_count(parity_one[0].bitwiseXOR(parity_two[0])))
    each = F.zip_with(parity_one, parity_two, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    every = F.aggregate(each, F.lit(0), lambda a, x: a + x) - first
    most = (100 - PERCENT) * (one + two)
    return _sizes_fit(one, two) & ((100 + PERCENT) * first <= most) & ((100 + PERCENT) * every <= most)


def _possible(pairs: DataFrame, about: DataFrame) -> DataFrame:
    """The pairs that sizes and parities leave possible."""
    sides = [about.select(F.col("node").alias(c), F.struct("n", "parity").alias(f"of_{c}")) for c in ("u", "v")]
    both = pairs.join(sides[0], "u").join(sides[1], "v")
    fit = may_link(F.col("of_u.n"), F.col("of_v.n"), F.col("of_u.parity"), F.col("of_v.parity"))
    return both.where(fit).select("u", "v")


def differing(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """For each row of parities how many groups differ."""
    return np.bitwise_count(one ^ two).sum(axis=1, dtype=np.int64)


def _joined(best: bool):
    """Finds the pairs of members of different components that sizes and parities leave possible, a few rows at a time."""

    def joined(node, part, component, table):
        size = table.column("n").to_numpy()
        parity = table.column("parity").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
        fold, whole = np.ascontiguousarray(parity[:, :FOLDED_WORDS]), np.ascontiguousarray(parity[:, FOLDED_WORDS:])
        two_blocks = part.min() < part.max()
        rows, others, scores = [], [], []
        for a in range(0, len(node), 32):
            own = np.arange(a, min(a + 32, len(node)))
            fit = component[own][:, None] != component[None, :]
            fit &= (part[own][:, None] < part[None, :]) if two_blocks else (own[:, None] < np.arange(len(node))[None, :])
            fit &= 100 * np.minimum(size[own][:, None], size[None, :]) >= PERCENT * np.maximum(size[own][:, None], size[None, :])
            x, y = np.nonzero(fit)
            x = own[x]
            # A link has (100 + PERCENT) * differing elements <= (100 - PERCENT) * all.
            most = (100 - PERCENT) * (size[x] + size[y]) // (100 + PERCENT)
            near = differing(fold[x], fold[y]) <= most
            x, y, most = x[near], y[near], most[near]
            apart = np.concatenate([differing(whole[x[c : c + 8192]], whole[y[c : c + 8192]]) for c in range(0, len(x), 8192)] or [most[:0]])
            near = apart <= most
            rows.append(x[near])
            others.append(y[near])
            scores.append(-apart[near] / (size[x[near]] + size[y[near]]))
        x, y = np.concatenate(rows), np.concatenate(others)
        if best and len(x):
            x, y = best_partners(node, x, y, np.concatenate(scores))
        return node[x], node[y]

    return joined
