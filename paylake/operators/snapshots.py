"""What differs between two loads of the same dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERTED, CHANGED, REMOVED = "inserted", "changed", "removed"


def row_digest(rows: DataFrame, keys: Sequence[str]) -> Column:
    """A number for the typed values of a row besides its keys.

    The hash leaves NULLs out, so where they are is hashed too.
    """
    others = sorted(c for c in rows.columns if c not in keys)
    return F.xxhash64(F.lit(len(others)), *others, *[F.col(c).isNull() for c in others])


def changed_keys(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys whose rows are not the same, with ``change``: inserted, changed or removed.

    Keys are unique on both sides and both have the same columns. Only keys and digests are shuffled. A
    NULL key equals nothing: such rows are removed and inserted each time.
    """
    keys = list(keys)
    sides = [rows.select(*keys, row_digest(rows, keys).alias(name)) for rows, name in ((old, "_old"), (new, "_new"))]
    joined = sides[0].join(sides[1], keys, "full").where(~F.col("_old").eqNullSafe(F.col("_new")))
    change = F.when(F.col("_old").isNull(), INSERTED).when(F.col("_new").isNull(), REMOVED).otherwise(CHANGED)
    return joined.select(*keys, change.alias("change"))


def version_of(table) -> str:
    """A name for the present content of a keyed table: its last write, or the sum of its rows' digests."""
    written = getattr(table, "version", None)
    if written is not None:
        return written()
    rows = table.read()
    total = F.sum(F.xxhash64(*sorted(rows.columns)).cast("decimal(20,0)"))
    return str(rows.agg(F.count(F.lit(1)).alias("n"), total.alias("s")).first()).translate({ord(c): "-" for c in "()=,' "})
