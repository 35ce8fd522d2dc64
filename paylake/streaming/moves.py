"""The log of changes: the images of rows before and after each batch replaced them.

The Silver job writes it before it updates a table, once for each batch name, so a batch that is run
again does not write its own result over it. It works with any kind of table, as it reads only the
current rows. Loads of static datasets write the rows that differ from the former load. The Gold job
reads the log: for the groups that rows have left, and as signed changes of sums. The pipeline empties
it when Gold is through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.operators.keys import restrict
from paylake.operators.latest import keep_latest
from paylake.operators.snapshots import changed_keys, version_of
from paylake.operators.upsert import upsert
from paylake.plans import deltas
from paylake.sources import files
from paylake.sources.tables import FolderTable, Lake, LostWriteError, MergeTable
from paylake.specs import PAYMENT_TOPICS, EntitySpec, StaticSpec

LAYER, TABLE = "silver", "moves"

SCHEMA = deltas.IMAGE_SCHEMA

#: Begins the names of entries that loads of static datasets write.
LOAD = "load-"

#: Static datasets that metric rows depend on.
LOADED = ("payment_attempts", "payment_events", "payment_gateways", "payment_methods")


def _write(lake: Lake, entry: str, images: DataFrame, again: bool = False) -> None:
    where = lake.location(LAYER, TABLE)
    if lake.fmt == "parquet":
        path = f"{where}/{entry}"
        if not again and files.exists(lake.spark, f"{path}/_SUCCESS"):
            return
        images.write.mode("overwrite").option("compression", files.CODEC).parquet(path)
        if not files.exists(lake.spark, f"{path}/_SUCCESS"):
            raise LostWriteError(f"no _SUCCESS marker in {path}")
        return
    if entry in entries(lake):
        return
    images.withColumn("entry", F.lit(entry)).write.format(lake.fmt).mode("append").saveAsTable(where)


def record(
    lake: Lake, spec: EntitySpec, table: FolderTable | MergeTable, rows: DataFrame, batch: str
) -> None:
    """Log the images of the stored rows that ``rows`` will replace, and of what will be there instead."""
    if spec.topic not in PAYMENT_TOPICS:
        return
    (key,) = spec.keys
    latest = keep_latest(rows, spec.keys).select(*spec.state_schema.fieldNames())
    old = restrict(table.read(), latest.select(key), key)
    # Every old row has its key in ``latest``: if the last arrival wins, nothing old remains.
    new = upsert(old, latest, spec.keys, True) if lake.newer_wins else latest
    _write(lake, f"{spec.table}-{batch}", deltas.changes(old, new, spec.topic))


def record_load(
    lake: Lake, spec: StaticSpec, table: FolderTable | MergeTable, rows: DataFrame
) -> None:
    """Log the images of the rows of a static dataset that a new load inserts, changes or removes.

    The entry is named for the stored rows that the load replaces, so a load that was cut short is logged
    anew by the next one.
    """
    if spec.table not in LOADED:
        return
    if table.exists():
        old = table.read()
        keys = changed_keys(old, rows, spec.keys).select(*spec.keys)
        changes = deltas.changes(
            old.join(keys, list(spec.keys), "left_semi"), rows.join(keys, list(spec.keys), "left_semi"), spec.table
        )
    else:
        # Every row is new: there is nothing to compare it with. A NULL key equals nothing, here as above.
        changes = deltas.images(rows.dropna(subset=list(spec.keys)), spec.table)
    _write(lake, f"{LOAD}{spec.table}-{version_of(table)}", changes, again=True)


def entries(lake: Lake) -> list[str]:
    """The names of what is in the log: a few for each batch."""
    where = lake.location(LAYER, TABLE)
    if lake.fmt != "parquet":
        if not lake.spark.catalog.tableExists(where):
            return []
        return sorted(r.entry for r in lake.spark.table(where).select("entry").distinct().collect())
    names = files.subfolders(lake.spark, where)
    return [n for n in names if files.exists(lake.spark, f"{where}/{n}/_SUCCESS")]


def changes(lake: Lake, names: Sequence[str]) -> DataFrame:
    """The signed images of the named entries."""
    where = lake.location(LAYER, TABLE)
    if not names:
        return lake.spark.createDataFrame([], SCHEMA)
    if lake.fmt != "parquet":
        return lake.spark.table(where).where(F.col("entry").isin(list(names))).select(*SCHEMA.fieldNames())
    return lake.spark.read.schema(SCHEMA).parquet(*[f"{where}/{n}" for n in names])


def read(lake: Lake) -> DataFrame | None:
    """What rows named before batches replaced them, or None if there is no log."""
    names = [n for n in entries(lake) if not n.startswith(LOAD)]
    return changes(lake, names).where("weight < 0") if names else None


def clear(lake: Lake) -> None:
    """Empty the log. Right only when Gold has processed all that Silver has."""
    where = lake.location(LAYER, TABLE)
    if lake.fmt == "parquet":
        files.delete(lake.spark, where)
    else:
        lake.spark.sql(f"DROP TABLE IF EXISTS {where}")
