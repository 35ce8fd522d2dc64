"""Key sets and the reduction of facts to them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct values of one column without NULL."""
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def union_keys(sets: list[DataFrame], key: str) -> DataFrame:
    """Distinct union of several key sets."""
    if not sets:
        raise ValueError("no key sets given")
    stacked = reduce(lambda a, b: a.unionByName(b), [s.select(key) for s in sets])
    return distinct_keys(stacked, key)


def restrict(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in the set.

    A semi-join: it adds no columns, cannot multiply rows, and Spark turns it
    into a broadcast only if the set is measured to be small.
    """
    return df.join(keys, on, "left_semi")


@dataclass(frozen=True)
class BitSet:
    """Which of a fixed number of hash values some keys have: rows (word, bits) of 64 values each."""

    words: DataFrame
    size: int

    def maybe(self, df: DataFrame, *on: str) -> DataFrame:
        """The rows of ``df`` whose key may be in the set: all that are, and few others. No row is shuffled."""
        place = F.pmod(F.xxhash64(*on), F.lit(64 * self.size))
        marked = df.withColumns({"_word": F.floor(place / 64), "_bit": (place % 64).cast("int")})
        hit = F.expr("shiftrightunsigned(_bits, _bit) & 1") == 1
        return marked.join(F.broadcast(self.words), "_word").where(hit).drop("_word", "_bit", "_bits")


def bit_set(keys: DataFrame, *on: str, bits_per_key: int = 16, most_words: int = 1 << 20) -> BitSet:
    """A bit set of the hashes of ``keys``, to drop most other rows before an exact join shuffles them.

    ``most_words`` bounds what is broadcast, whatever the number of keys: 1,048,576 rows of two longs by default, that is
    64 million hash values. With more keys than that allows for, more other rows pass, none of the
    keys' own is lost. ``keys`` is read twice: store or persist it.
    """
    size = max(1, min(most_words, -(-keys.count() * bits_per_key // 64)))
    place = F.pmod(F.xxhash64(*on), F.lit(64 * size))
    bit = F.expr("shiftleft(1L, _bit)")
    words = keys.select(F.floor(place / 64).alias("_word"), (place % 64).cast("int").alias("_bit")).groupBy("_word")
    return BitSet(words.agg(F.bit_or(bit).alias("_bits")), size)


def restrict_large(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """``restrict`` for a key set that is too large to broadcast: only rows that may be in it are shuffled."""
    return restrict(bit_set(keys, on).maybe(df, on), keys, on)


def restrict_by(df: DataFrame, keys: DataFrame, value: Column, on: str) -> DataFrame:
    """Rows whose computed value is in the key set; the value is not kept."""
    return df.withColumn(on, value).join(keys, on, "left_semi").drop(on)
