"""Keyed upsert as a plan: the state of a table after a set of changes.

This is what MERGE with update-all and insert-all leaves behind. Table formats
that have MERGE do it themselves (see ``paylake.sources.tables``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.operators.latest import keep_latest
from paylake.specs import ARRIVAL_ORDER

SIDE = "_side"


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    newer_wins: bool = False,
    order: Sequence[str] = ARRIVAL_ORDER,
) -> DataFrame:
    """``target`` with the rows of ``source`` put in its place or added.

    ``source`` holds at most one row per key (use ``keep_latest``). A NULL key
    equals nothing, so such rows are always added. By default the source
    replaces the target row whatever its age; with ``newer_wins`` the target
    row stays if it is later in ``order``. Of equals the source wins.

    Target rows with untouched keys are never shuffled when the source keys are
    small enough to broadcast.
    """
    keys = list(keys)
    source = source.select(*target.columns)
    touched = source.select(*keys)
    untouched = target.join(touched, keys, "left_anti")
    if not newer_wins:
        return untouched.unionByName(source)
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    old = target.join(touched, keys, "left_semi").withColumn(SIDE, F.lit(0))
    contested = old.unionByName(source.where(has_key).withColumn(SIDE, F.lit(1)))
    return (
        untouched.unionByName(keep_latest(contested, keys, [*order, SIDE]).drop(SIDE))
        .unionByName(source.where(~has_key))
    )
