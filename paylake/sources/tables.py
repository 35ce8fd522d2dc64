"""Tables with a business key, and plain table reads and writes.

``MergeTable`` hands the upsert to a catalog format with MERGE (Delta, Iceberg).
``FolderTable`` does with parquet alone: an upsert appends the changed rows as a
new folder, and a read resolves them against the last full copy. A microbatch
therefore writes only what changed, never the whole table.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.operators.latest import keep_latest
from paylake.operators.upsert import upsert
from paylake.sources import evolution, files
from paylake.specs import ARRIVAL_ORDER

SEQUENCE = "_sequence"
REMOVED = "_removed"


def with_removals(
    rows: DataFrame, remove: DataFrame | None, keys: Sequence[str]
) -> DataFrame:
    """``rows``, and the keys of ``remove`` that have no row, marked as removed.

    One full join on the keys, by which ``rows`` has been made as a rule: it is
    evaluated once and not shuffled again.
    """
    present = rows.withColumn(REMOVED, F.lit(False))
    if remove is None:
        return present
    named = remove.select(*keys).distinct()
    return present.join(named, list(keys), "full").withColumn(
        REMOVED, F.coalesce(REMOVED, F.lit(True))
    )


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows. Spark sees that by the filter and leaves out the joins and shuffles that it would take part in."""
    return spark.createDataFrame([], schema).where(F.lit(False))


_NAME = re.compile(r"\d{12}-(full|part)-.+")


class LostWriteError(RuntimeError):
    """A write ended without the marker by which readers know it."""


@dataclass(frozen=True)
class _Folder:
    name: str

    @property
    def sequence(self) -> int:
        return int(self.name.split("-", 1)[0])

    @property
    def is_full(self) -> bool:
        return "-full-" in self.name

    @property
    def batch(self) -> str:
        return self.name.split("-", 2)[2]


class FolderTable:
    """A keyed table in a folder of parquet folders. One writer at a time.

    Folder names are ``<sequence>-full-<batch>`` or ``<sequence>-part-<batch>``;
    the first write makes a full one. A folder counts once Spark has written its
    ``_SUCCESS`` marker, so a write cut short is invisible and is overwritten by
    the next attempt. A batch that is already there is not written again. A write
    that leaves no marker (``mapreduce.fileoutputcommitter.marksuccessfuljobs`` is
    off) raises. Folders of other names are left alone.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        schema: T.StructType | None = None,
        newer_wins: bool = False,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.newer_wins = newer_wins
        self._schema = schema

    def _folders(self) -> list[_Folder]:
        done = [
            _Folder(n)
            for n in files.subfolders(self.spark, self.path)
            if _NAME.fullmatch(n) and files.exists(self.spark, f"{self.path}/{n}/_SUCCESS")
        ]
        starts = [i for i, f in enumerate(done) if f.is_full]
        return done[starts[-1]:] if starts else []

    def exists(self) -> bool:
        return bool(self._folders())

    def version(self) -> str:
        """The last write that counts."""
        folders = self._folders()
        return folders[-1].name if folders else "none"

    def _paths(self, folders: Sequence[_Folder]) -> list[str]:
        return [f"{self.path}/{f.name}" for f in folders]

    def _stored_schema(self, folders: Sequence[_Folder]) -> T.StructType:
        stored = self.spark.read.parquet(*self._paths(folders[-1:])).schema
        return T.StructType([f for f in stored.fields if f.name not in (SEQUENCE, REMOVED)])

    @property
    def schema(self) -> T.StructType:
        if self._schema is None:
            folders = self._folders()
            if not folders:
                raise ValueError(f"no table at {self.path} and no schema given")
            self._schema = self._stored_schema(folders)
        return self._schema

    def _scan(self, folders: Sequence[_Folder]) -> DataFrame:
        stored = T.StructType(
            [
                *self.schema.fields,
                T.StructField(SEQUENCE, T.LongType()),
                T.StructField(REMOVED, T.BooleanType()),
            ]
        )
        if not folders:
            return empty_frame(self.spark, stored)
        return self.spark.read.schema(stored).parquet(*self._paths(folders))

    def pending(self) -> bool:
        """Whether a read must resolve changes against the full copy."""
        return any(not f.is_full for f in self._folders())

    def read(self) -> DataFrame:
        """The current state, one row per key."""
        folders = self._folders()
        columns = self.schema.fieldNames()
        parts = [f for f in folders if not f.is_full]
        if not parts:
            return self._scan(folders).select(*columns)
        changes = self._scan(parts)
        full = self._scan(folders[:1])
        # Rows with a NULL key equal nothing, so those of different batches stay apart.
        any_null = F.lit(False)
        for key in self.keys:
            any_null = any_null | F.col(key).isNull()
        apart = F.when(any_null, F.col(SEQUENCE))
        # Removals carry no arrival order, so a table has either them or ``newer_wins``.
        order = [*ARRIVAL_ORDER, SEQUENCE] if self.newer_wins else [SEQUENCE]
        latest = keep_latest(changes, [*self.keys, apart], order).select(*columns, REMOVED)
        stored = full.select(*columns).withColumn(REMOVED, F.lit(False))
        current = upsert(stored, latest, self.keys, self.newer_wins)
        return current.where(~F.coalesce(REMOVED, F.lit(False))).select(*columns)

    def upsert(
        self, rows: DataFrame, batch: str | None = None, remove: DataFrame | None = None
    ) -> bool:
        """Insert or replace ``rows`` (at most one per key).

        ``remove`` lists keys whose rows go unless ``rows`` has them. Returns
        False if the batch had been written before.
        """
        if remove is not None and self.newer_wins:
            raise ValueError("removals carry no arrival order; not possible with newer_wins")
        folders = self._folders()
        if batch is not None and any(f.batch == batch for f in folders):
            return False
        if not folders:
            self._write(rows.select(*(self._schema or rows.schema).fieldNames()), 0, "full", batch)
            return True
        evolution.check(self.path, self._stored_schema(folders), rows.select(*self.schema.fieldNames()).schema)
        names = self.schema.fieldNames()
        changed = with_removals(rows.select(*names), remove, self.keys).select(*names, REMOVED)
        sequence = folders[-1].sequence + 1
        changed = changed.withColumn(SEQUENCE, F.lit(sequence).cast("bigint"))
        self._write(changed, sequence, "part", batch)
        return True

    def overwrite(self, rows: DataFrame) -> None:
        """Replace the whole table; readers see the old one until the write is done."""
        folders = self._folders()
        sequence = folders[-1].sequence + 1 if folders else 0
        self._write(rows, sequence, "full", None)
        self._schema = None

    def compact(self) -> bool:
        """Fold the changes into a new full copy. Run it when its readers are through.

        Afterwards reads need no resolution. The batch of the newest change is kept in
        the name, so that a replay of it is still recognised.
        """
        folders = self._folders()
        if not any(not f.is_full for f in folders):
            return False
        sequence, batch = folders[-1].sequence + 1, folders[-1].batch
        self._write(self.read(), sequence, "full", batch)
        return True

    def clean(self) -> int:
        """Delete the folders that a later full copy has replaced; returns their number."""
        folders = self._folders()
        if not folders or not folders[0].is_full:
            return 0
        old = [
            n
            for n in files.subfolders(self.spark, self.path)
            if _NAME.fullmatch(n) and _Folder(n).sequence < folders[0].sequence
        ]
        for name in old:
            files.delete(self.spark, f"{self.path}/{name}")
        return len(old)

    def _write(self, rows: DataFrame, sequence: int, kind: str, batch: str | None) -> None:
        name = f"{sequence:012d}-{kind}-{batch or 'manual'}"
        rows.write.mode("overwrite").option("compression", files.CODEC).parquet(f"{self.path}/{name}")
        if not files.exists(self.spark, f"{self.path}/{name}/_SUCCESS"):
            raise LostWriteError(f"no _SUCCESS marker in {self.path}/{name}; readers would miss it")


class MergeTable:
    """A keyed table of a catalog whose format supports MERGE."""

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        keys: Sequence[str],
        schema: T.StructType | None = None,
        fmt: str = "delta",
        newer_wins: bool = False,
    ):
        self.spark = spark
        self.name = name
        self.keys = list(keys)
        self.fmt = fmt
        self.newer_wins = newer_wins
        self._schema = schema

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    @property
    def schema(self) -> T.StructType:
        return self.spark.read.table(self.name).schema if self.exists() else self._schema

    def read(self) -> DataFrame:
        if not self.exists() and self._schema is not None:
            return empty_frame(self.spark, self._schema)
        return self.spark.read.table(self.name)

    def pending(self) -> bool:
        return False

    def create_if_absent(self, schema: T.StructType) -> None:
        if not self.exists():
            empty = self.spark.createDataFrame([], schema)
            empty.write.format(self.fmt).mode("ignore").saveAsTable(self.name)

    def upsert(
        self, rows: DataFrame, batch: str | None = None, remove: DataFrame | None = None
    ) -> bool:
        """MERGE on the keys. Running the same batch twice leaves the same table."""
        self.create_if_absent(rows.schema)
        source = with_removals(rows, remove, self.keys)
        self.spark.sql(self.merge_statement(rows.columns), source=source)
        return True

    def merge_statement(self, columns: Sequence[str]) -> str:
        """The helper column of the source stays out, also where the schema may evolve."""
        on = " AND ".join(f"target.{k} = source.{k}" for k in self.keys)
        newer = ""
        if self.newer_wins:
            sides = [
                "struct(" + ", ".join(f"{side}.{c}" for c in ARRIVAL_ORDER) + ")"
                for side in ("source", "target")
            ]
            newer = f" AND {sides[0]} >= {sides[1]}"
        quoted = [f"`{c}`" for c in columns]
        update = ", ".join(f"target.{c} = source.{c}" for c in quoted)
        values = ", ".join(f"source.{c}" for c in quoted)
        return (
            f"MERGE INTO {self.name} AS target USING {{source}} AS source ON {on} "
            f"WHEN MATCHED AND source.{REMOVED} THEN DELETE "
            f"WHEN MATCHED AND NOT source.{REMOVED}{newer} THEN UPDATE SET {update} "
            f"WHEN NOT MATCHED AND NOT source.{REMOVED} "
            f"THEN INSERT ({', '.join(quoted)}) VALUES ({values})"
        )

    def overwrite(self, rows: DataFrame) -> None:
        overwrite_table(rows, self.name, self.fmt, replace_schema=True)

    def compact(self) -> bool:
        return False

    def clean(self) -> int:
        return 0


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def stream_table(spark: SparkSession, name: str, max_files: int | None = None) -> DataFrame:
    """A catalog table as a stream of its appended rows. ``max_files`` bounds a microbatch."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.table(name)


def stream_folder(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """A folder that receives files, as a stream. ``max_files`` bounds a microbatch."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def overwrite_table(
    df: DataFrame, name: str, fmt: str = "parquet", replace_schema: bool = False
) -> None:
    """Replace a catalog table, optionally with another schema."""
    writer = df.write.format(fmt).mode("overwrite")
    if replace_schema and fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    writer.saveAsTable(name)


class Lake:
    """Where the tables of the layers live: a folder root, or a catalog with MERGE.

    ``newer_wins`` tells how entity state resolves an event that arrives late:
    ignore it if a later one is stored, or (the default) let the last arrival win.
    """

    def __init__(
        self, spark: SparkSession, root: str, fmt: str = "parquet", newer_wins: bool = False
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt
        self.newer_wins = newer_wins

    def location(self, layer: str, table: str) -> str:
        separator = "/" if self.fmt == "parquet" else "."
        return separator.join([self.root, layer, table])

    def keyed(
        self,
        layer: str,
        table: str,
        keys: Sequence[str],
        schema: T.StructType | None = None,
        newer_wins: bool = False,
    ) -> FolderTable | MergeTable:
        where = self.location(layer, table)
        if self.fmt == "parquet":
            return FolderTable(self.spark, where, keys, schema, newer_wins)
        return MergeTable(self.spark, where, keys, schema, self.fmt, newer_wins)
