"""Packing pieces of documents into as few sequences of a fixed length as possible.

How pieces fit together depends on their lengths alone, and these are at most the
capacity. So the plan is made from the number of pieces of each length: first
Martello and Toth's dominance reduction, which fixes sequences that some optimal
packing must have, then best fit, longest first, for what is left. The plan lists
patterns: so many sequences of such lengths. Its size depends on the capacity,
not on the number of documents. Spark then numbers the pieces of each length and
looks up the place of each number.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.bpe import WORD_BPE, load
from paylake.llm.common import ROW, binaries, map_texts

CAPACITY = 4096

#: About so many pieces of one length are numbered in one group.
NUMBERED_TOGETHER = 2000

#: So many sequences, each of these lengths.
Pattern = tuple[int, tuple[int, ...]]


def _largest(have: int, most: int) -> int:
    """The largest length at hand that is at most ``most``; 0 if there is none."""
    return max((have & ((1 << (most + 1)) - 1)).bit_length() - 1, 0) if most > 0 else 0


def _smallest(have: int, above: int = 0) -> int:
    """The smallest length at hand over ``above``; 0 if there is none."""
    rest = have >> (above + 1)
    return (rest & -rest).bit_length() + above if rest else 0


class _Lengths:
    """Numbers of pieces by length, with the lengths at hand as bits of one integer."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {n: c for n, c in counts.items() if c}
        self.have = sum(1 << n for n in self.counts)

    def take(self, length: int, number: int) -> None:
        self.counts[length] -= number
        if not self.counts[length]:
            del self.counts[length]
            self.have &= ~(1 << length)

    def smallest(self, number: int) -> list[int]:
        """The ``number`` smallest pieces, or all."""
        out: list[int] = []
        length = 0
        while len(out) < number and (length := _smallest(self.have, length)):
            out += [length] * min(self.counts[length], number - len(out))
        return out


def _dominating(rest: _Lengths, space: int) -> tuple[int, ...] | None:
    """What to put beside a piece that leaves ``space``, if one choice is as good as any other.

    ``rest`` holds the other pieces. A choice dominates another if the pieces of
    the other can be swapped, in groups, for at most as long ones of the choice.
    """
    small = rest.smallest(3)
    fitting = 0
    while fitting < len(small) and sum(small[: fitting + 1]) <= space:
        fitting += 1
    if fitting == 0:
        return ()
    best = _largest(rest.have, space)
    if fitting == 1 or best == space:
        return (best,)
    if fitting == 3:
        return None
    pair = a = 0
    at = best
    while at and 2 * at > pair:
        other = _largest(rest.have, min(at if rest.counts[at] > 1 else at - 1, space - at))
        if other and at + other > pair:
            pair, a = at + other, at
        at = _largest(rest.have, at - 1)
    if best >= pair:
        return (best,)
    mate = _largest(rest.have, min(best if rest.counts[best] > 1 else best - 1, space - best))
    if not mate or not a:
        return None
    # Two pieces between the pair's lengths would be neither longer nor shorter than it.
    low = _smallest(rest.have, mate)
    high = low if low and rest.counts[low] > 1 else _smallest(rest.have, low) if low else 0
    between = bool(low and high) and high < best and low + high <= space
    return None if between else (best, mate)


def reduce(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Sequences that some optimal packing has, and the pieces that are left."""
    rest = _Lengths(counts)
    fixed: list[Pattern] = []
    changed = True
    while changed:
        changed = False
        length = _largest(rest.have, capacity)
        while length:
            # Without one piece of this length: the one that a sequence is sought for.
            rest.take(length, 1)
            beside = _dominating(rest, capacity - length)
            rest.counts[length] = rest.counts.get(length, 0) + 1
            rest.have |= 1 << length
            if beside is None:
                length = _largest(rest.have, length - 1)
                continue
            members = (length, *beside)
            needs = {n: members.count(n) for n in members}
            # The choice stays the best one as long as its pieces last.
            number = min(rest.counts[n] // need for n, need in needs.items())
            for n, need in needs.items():
                rest.take(n, need * number)
            fixed.append((number, members))
            changed = True
            if length not in rest.counts:
                length = _largest(rest.have, length)
    return fixed, rest.counts


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit, longest first, a whole length at a time: like sequences are one pattern."""
    open_at: dict[int, list[list]] = {}
    spaces = 0
    closed: list[Pattern] = []

    def put(space: int, number: int, members: tuple[int, ...]) -> None:
        nonlocal spaces
        if not space:
            closed.append((number, members))
            return
        open_at.setdefault(space, []).append([number, members])
        spaces |= 1 << space

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            space = _smallest(spaces, length - 1)
            if space:
                number, members = open_at[space].pop()
                if not open_at[space]:
                    del open_at[space]
                    spaces &= ~(1 << space)
            else:
                space, number, members = capacity, -(-left // (capacity // length)), ()
            # After one piece the same sequence has the smallest fitting space again.
            fits = space // length
            full = min(number, left // fits)
            if full:
                put(space - fits * length, full, (*members, *[length] * fits))
                left -= full * fits
            if full < number:
                more = left if left < fits else 0
                left -= more
                put(space - more * length, 1, (*members, *[length] * more))
                if number > full + 1:
                    put(space, number - full - 1, members)
    return closed + [(n, m) for groups in open_at.values() for n, m in groups if m]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    fixed, rest = reduce(counts, capacity)
    return fixed + best_fit(rest, capacity)


def _places(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """For runs of the numbered pieces of a length: first number, pieces a sequence, first sequence, first offset."""
    used: dict[int, int] = {}
    rows = []
    sequence = 0
    for number, members in patterns:
        offset = 0
        for length, group in groupby(members):
            together = len(list(group))
            first = used.get(length, 0)
            rows.append((length, first, together, sequence, offset))
            used[length] = first + together * number
            offset += together * length
        sequence += number
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "together", "sequence", "offset"), table.T, strict=True))


def pieces(docs: DataFrame, path: str = WORD_BPE, capacity: int = CAPACITY, end_id: int | None = 1) -> DataFrame:
    """The ids of every document, cut where they exceed the capacity.

    The other columns, then ``piece`` (from 0), ``start``, ``length`` and ``ids``
    (little-endian unsigned 32-bit integers). A null text is empty and has the end id alone; a
    document without any id (empty, and no end id asked for) has no piece.
    """

    def prepare():
        bpe = load(path)

        def work(texts):
            ids, counts = bpe.encode(texts)
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(counts), end_id)
                counts = counts + 1
            number = -(-counts // capacity)
            row = np.repeat(np.arange(len(counts)), number)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            start = piece * capacity
            length = np.minimum(counts[row] - start, capacity)
            return {
                ROW: row,
                "piece": piece.astype(np.int32),
                "start": start,
                "length": length,
                "ids": binaries(ids.astype("<u4"), length, 4),
            }

        return work

    return map_texts(docs, "piece int, start long, length long, ids binary", prepare)


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows that have a ``length`` from 1 to the capacity.

    ``rows`` is read more than once and should be a stored table. Sequences have no
    gaps; equal rows get places of their own; no rows give no sequences.
    """
    names = rows.columns
    # At most a row for each length.
    found = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    if bad := [n for n in found if n is None or not 1 <= n <= capacity]:
        raise ValueError(f"lengths outside 1 to {capacity}: {bad[:5]}")
    places = _places(plan(found, capacity))
    spark = rows.sparkSession
    groups = spark.createDataFrame([(n, 1 + c // NUMBERED_TOGETHER) for n, c in found.items()], "__length long, __groups long")

    dealt = (
        rows.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col("length").alias("__length"))
        .join(F.broadcast(groups), "__length")
        .withColumn("__group", F.pmod(F.xxhash64("row"), "__groups"))
        .select("__length", "__group", "row")
    )
    sizes = dealt.groupBy("__length", "__group").count()
    earlier = Window.partitionBy("__length").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("__length", "__group", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("__first"))
    inside = Window.partitionBy("__length", "__group").orderBy("row")
    numbered = (
        dealt.withColumn("__number", F.row_number().over(inside))
        .join(firsts, ["__length", "__group"])
        .select("row.*", (F.col("__first") + F.col("__number") - 1).alias("__number"))
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Lengths are at most the capacity, so a length and a number make one sortable key.
        step = int(places["first"].max(initial=0)) + 1
        keys = places["length"] * step + places["first"]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            number = batch.column("__number").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, length * step + np.minimum(number, step - 1), side="right") - 1
            inside = number - places["first"][at]
            sequence = places["sequence"][at] + inside // places["together"][at]
            offset = places["offset"][at] + inside % places["together"][at] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return numbered.mapInArrow(place, f"{schema}, sequence_id long, offset long")
