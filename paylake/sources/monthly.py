"""State tables laid out by the month that sets a row's day.

A batch names days, and days name months: these become a filter on the partitions, so a batch of one day reads
one month of facts, not all. (Dynamic pruning by the broadcast days was tried: the plan had it, but at run
time Spark did not find the broadcast again and read everything.)

The tables are plain Parquet folders partitioned by ``MONTH``; rows without a day are a partition of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.operators.keys import distinct_keys, restrict_by
from paylake.sources import files

MONTH = "_month"

def month_of(day: Column) -> Column:
    return F.trunc(day, "MM").alias(MONTH)


def write(rows: DataFrame, path: str, day: Column) -> None:
    """Replace the whole table. Rows are dealt by month and a hash, so a month is a few files and no single task."""
    by = rows.withColumn(MONTH, month_of(day))
    by.repartition(MONTH, F.pmod(F.xxhash64(*rows.columns), F.lit(8))).write.mode("overwrite").partitionBy(MONTH).parquet(path)


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows, with the month as a further column."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(MONTH, T.DateType())])).parquet(path)


def replace(spark: SparkSession, path: str, old: DataFrame, new: DataFrame, keys: Sequence[str], day: Column) -> None:
    """Take the rows of ``old`` away and put those of ``new`` in; only months that either names are written.

    ``old`` has the rows as they are stored. A month that loses its last row loses its folder, after the write:
    a driver that ends in between leaves rows there that the same call, run again, takes away.
    """
    schema = new.schema
    changed = [r.select(*keys, month_of(day)) for r in (old, new)]
    months = changed[0].unionByName(changed[1])
    stored = read(spark, path, schema)
    touched = months.select(MONTH).distinct()
    # A month that is not known (no day) is equal to itself here.
    near = stored.join(F.broadcast(touched.withColumnRenamed(MONTH, "_m")), F.col(MONTH).eqNullSafe(F.col("_m")), "left_semi")
    gone = months.select(*keys).distinct()
    after = near.join(gone, list(keys), "left_anti").unionByName(new.withColumn(MONTH, month_of(day)))
    after = after.persist()
    try:
        left = {r[0] for r in after.select(MONTH).distinct().collect()}
        after.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    finally:
        after.unpersist()
    for (month,) in touched.collect():
        if month not in left:
            name = "__HIVE_DEFAULT_PARTITION__" if month is None else month.isoformat()
            files.delete(spark, f"{path}/{MONTH}={name}")


def of_days(facts: DataFrame, days: DataFrame, day: Column, on: str) -> DataFrame:
    """The facts of some days, read from their months alone. ``days`` has a column ``on`` and fits a broadcast.

    The months come to the driver, twelve for a year, and become a filter on the partitions.
    """
    known = distinct_keys(days, on)
    months = [r[0] for r in known.select(F.trunc(on, "MM")).distinct().collect()]
    here = facts.where(F.col(MONTH).isin(months)).drop(MONTH)
    return restrict_by(here, F.broadcast(known), day, on)
