"""The steps of one scheduled run, in their order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from paylake.plans import deltas
from paylake.sources.events import prepare_bronze
from paylake.sources.tables import FolderTable, Lake, MergeTable, stream_folder, stream_table
from paylake.specs import BRONZE_SCHEMA, ENTITIES, STATIC
from paylake.streaming import bronze, gold, moves, silver, static
from paylake.streaming.parallel import run_together


def raw_log(lake: Lake, max_files: int | None = None) -> DataFrame:
    """The raw log as a stream."""
    where = lake.location("bronze", bronze.RAW_EVENTS)
    if lake.fmt == "parquet":
        return stream_folder(lake.spark, where, BRONZE_SCHEMA, max_files)
    return stream_table(lake.spark, where, max_files)


def run(
    lake: Lake,
    records: DataFrame,
    checkpoints: str,
    static_paths: Mapping[str, str] | None = None,
    silver_options: silver.SilverOptions | None = None,
    gold_options: gold.GoldOptions | None = None,
    max_files: int | None = None,
) -> None:
    """Raw log and static data, then entity state, then metrics.

    ``records`` is a stream of Kafka-shaped records. Each stage drains its
    source and keeps its own checkpoint, so a failed run is simply run again.
    """
    bronze.ingest(prepare_bronze(records), lake, f"{checkpoints}/bronze")
    if static_paths:
        static.ingest(lake, static_paths)
        static.process(lake, list(static_paths))
    silver.run(raw_log(lake, max_files), lake, f"{checkpoints}/silver", silver_options)
    gold.run(raw_log(lake, max_files), lake, f"{checkpoints}/gold", gold_options)
    moves.clear(lake)


def compact(lake: Lake) -> None:
    """Fold pending changes into full copies; run it between pipeline runs."""
    run_together(lake.spark, [table.compact for table in _upserted(lake)])


def clean(lake: Lake) -> None:
    """Delete the folders that a later full copy has replaced; run it between pipeline runs."""
    static_tables = [
        lake.keyed(layer, spec.table, spec.keys)
        for layer in ("bronze", "silver")
        for spec in STATIC
    ]
    for table in [*_upserted(lake), *static_tables]:
        table.clean()


def _upserted(lake: Lake) -> list[FolderTable | MergeTable]:
    entities = [silver.entity_table(lake, spec) for spec in ENTITIES]
    parts = [gold.parts_table(lake, name) for name in deltas.PARTS]
    return entities + [gold.gold_table(lake, name) for name in gold.GRAINS] + parts
