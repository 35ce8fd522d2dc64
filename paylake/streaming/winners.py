"""The latest row of each key kept in the state store, so a batch writes winners without reading the table.

The other Silver job resolves each batch against the stored table. Here the stream itself remembers the winning
row of every key: an aggregation in update mode whose result, after each microbatch, is the present winners of the keys
that the batch named. They go into the table as they are. State lives in RocksDB on the executors and in the checkpoint
folder, so it outgrows memory and survives a restart; a hot key costs one row, combined before the shuffle.

``last arrival`` puts the time of the microbatch before the order of events, as a table that lets the last
arrival win does; the time is in the checkpoint, so a batch that is run again has the same.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.operators import quality
from paylake.sources import events
from paylake.sources.tables import Lake
from paylake.specs import ARRIVAL_ORDER, EntitySpec
from paylake.streaming.silver import batch_name, entity_table

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def latest_per_key(rows: DataFrame, keys: list[str], last_arrival: bool = False) -> DataFrame:
    """The greatest row of each key in arrival order; NULLs last. For streams in update mode, and for tables."""
    order = ["_arrived", *ARRIVAL_ORDER] if last_arrival else ARRIVAL_ORDER
    best = F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("_row")
    has_keys = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return rows.where(has_keys).withColumn("_arrived", F.current_timestamp()).groupBy(*keys).agg(best).select("_row.*")


def winners(raw_log: DataFrame, spec: EntitySpec, last_arrival: bool, numbers: str = "strict") -> DataFrame:
    """The present winner of each key of an entity, from the raw log as a stream.

    Records with a reason to be refused take no part; ``quality.event_report`` counts them.
    """
    parsed = quality.judged(events.parse_all(raw_log, [spec], numbers), [spec], numbers)
    sound = parsed.where(F.size("errors") == 0)
    rows = events.entity_rows(sound, spec, numbers).select(*spec.state_schema.fieldNames())
    return latest_per_key(rows, list(spec.keys), last_arrival)


def use_rocksdb(spark: SparkSession) -> None:
    """Have streams that start from now on keep their state in RocksDB, changes first."""
    spark.conf.set(PROVIDER, ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def run(raw_log: DataFrame, lake: Lake, spec: EntitySpec, checkpoint: str, numbers: str = "strict") -> None:
    """Take what the raw log has gained into the table of the entity, then stop.

    The checkpoint holds the state: a new one starts from nothing and must be given the whole log.
    """
    use_rocksdb(lake.spark)
    table = entity_table(lake, spec)

    def step(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, batch_name(batch, batch_id))

    (
        winners(raw_log, spec, not lake.newer_wins, numbers)
        .writeStream.outputMode("update")
        .foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
