"""Distinct counts that can be merged: stored sets of ids as bitmaps.

A distinct count of one day cannot be added to that of another. The set of ids can: as bits, in words of 64
neighbouring ids, one long each. Sets of days or batches are stored once and merged by OR, without the ids being
shuffled or counted again. The result is exact. A word costs eight bytes however few of its ids a group has, so the
sets of many small groups are never larger than the facts; they are smaller where the ids are dense:
``numbered`` gives ids of any type dense numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET, BITS = "_bucket", "_bits"


def id_sets(facts: DataFrame, by: Sequence[str | Column], number: str) -> DataFrame:
    """The ids of each group as bits, a row for each word that has any; combined before the shuffle. NULL is no id."""
    known = facts.where(F.col(number).isNotNull())
    place = F.col(number).cast("bigint")
    placed = known.select(*by, F.shiftright(place, 6).alias(BUCKET), place.bitwiseAND(F.lit(63)).cast("int").alias("_bit"))
    return placed.groupBy(*placed.columns[:-1]).agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias(BITS))


def merged(sets: DataFrame, by: Sequence[str]) -> DataFrame:
    """The union of stored sets for each group."""
    return sets.groupBy(*by, BUCKET).agg(F.bit_or(BITS).alias(BITS))


def counts(sets: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """How many distinct ids the union of the stored sets of each group has."""
    return merged(sets, by).groupBy(*by).agg(F.sum(F.bit_count(BITS).cast("bigint")).alias(name))


def numbered(ids: DataFrame, column: str) -> DataFrame:
    """Distinct ids with numbers from 0 in their order, without gaps: a dictionary to join facts with.

    Ids are sorted by range; each partition numbers its own, and what earlier ones hold is added. Store the result
    before use: numbers hold for one evaluation.
    """
    known = ids.select(column).where(F.col(column).isNotNull()).distinct()
    ordered = known.repartitionByRange(column).sortWithinPartitions(column)
    # Rows of partition p are numbered from p * 2 ** 33 on.
    placed = ordered.withColumn("_place", F.monotonically_increasing_id()).persist()
    part = F.shiftright("_place", 33).alias("_part")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    # A row for each partition.
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(sizes.select("_part", before.alias("_before")))
    own = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.select(column, part, own.alias("_own")).join(offsets, "_part").select(column, (F.col("_before") + F.col("_own")).alias("number"))
