"""Keep the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylake.specs import ARRIVAL_ORDER


def keep_latest(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[str] = ARRIVAL_ORDER,
) -> DataFrame:
    """One row per key: the greatest in ``order``, NULLs last.

    The filter on the row number lets Spark drop all but one row per key and
    task before the shuffle (a window group limit), so a hot key costs one row
    per task and not its whole history.
    """
    latest_first = [F.col(c).desc_nulls_last() for c in order]
    window = Window.partitionBy(*keys).orderBy(*latest_first)
    return (
        df.withColumn("_row_number", F.row_number().over(window))
        .where(F.col("_row_number") == 1)
        .drop("_row_number")
    )
