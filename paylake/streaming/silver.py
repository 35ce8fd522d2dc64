"""Raw log -> current state of the entities."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.operators import quality
from paylake.operators.latest import keep_latest
from paylake.session import keep
from paylake.sources import events
from paylake.sources.tables import FolderTable, Lake, MergeTable
from paylake.specs import ENTITIES, EntitySpec
from paylake.streaming import moves
from paylake.streaming.parallel import run_together

QUARANTINE = "quarantine"


@dataclass(frozen=True)
class SilverOptions:
    """``on_bad="fail"`` refuses the batch; ``"quarantine"`` sets bad records aside."""

    on_bad: str = "fail"
    numbers: str = "strict"
    specs: Sequence[EntitySpec] = ENTITIES

    def __post_init__(self) -> None:
        if self.on_bad not in ("fail", "quarantine"):
            raise ValueError(f"on_bad must be 'fail' or 'quarantine', not {self.on_bad!r}")


def batch_name(batch: DataFrame, batch_id: int) -> str:
    """Names a microbatch across restarts: id of the streaming query, then batch number.

    A new checkpoint gets a new query id, so its batch 0 is not mistaken for an
    earlier one.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query or 'manual'}-{batch_id}"


def warn(report: dict) -> None:
    """Log what a batch has that is no reason to refuse it: repeats and unreadable values."""
    odd = {
        c: n
        for c, n in report.items()
        if n and c.startswith(("duplicate_", "repeated_", "unreadable_"))
    }
    if odd:
        logging.getLogger(__name__).warning("%s: %s", report["topic"], odd)


def entity_table(lake: Lake, spec: EntitySpec) -> FolderTable | MergeTable:
    return lake.keyed("silver", spec.table, spec.keys, spec.state_schema, lake.newer_wins)


def write_silver(
    rows: DataFrame, lake: Lake, spec: EntitySpec, batch: str | None = None
) -> None:
    """Reduce the rows to the latest per key and upsert them; log what they replace first."""
    table = entity_table(lake, spec)
    latest = keep_latest(rows, spec.keys)
    if batch is None:
        table.upsert(latest, batch)
        return
    latest = keep(latest)
    try:
        moves.record(lake, spec, table, latest, batch)
        table.upsert(latest, batch)
    finally:
        latest.unpersist()


def process_batch(
    lake: Lake, options: SilverOptions, batch: DataFrame, batch_id: int,
    on_report: Callable[[dict], None] | None = None,
) -> None:
    """One microbatch: parse once, one report over all topics, one write per topic.

    In fail mode every topic passes its gate before any is written.
    """
    name = batch_name(batch, batch_id)
    parsed = events.parse_all(batch, options.specs, options.numbers)
    if options.on_bad == "fail":
        parsed = parsed.drop("raw_payload")  # only the quarantine needs the text
    else:
        parsed = quality.judged(parsed, options.specs, options.numbers)
    parsed = keep(parsed)
    try:
        report = quality.event_report(parsed, options.specs, options.numbers)
        by_topic = {row["topic"]: row.asDict() for row in report.collect()}  # a row per topic
        present = [s for s in options.specs if s.topic in by_topic]
        for spec in present:
            (on_report or warn)(by_topic[spec.topic])
            if options.on_bad == "fail":
                quality.refuse_batch(by_topic[spec.topic])

        def update(spec: EntitySpec) -> None:
            accepted = parsed
            if options.on_bad == "quarantine":
                accepted = _set_aside(lake, parsed, spec, by_topic[spec.topic], name)
            write_silver(events.entity_rows(accepted, spec, options.numbers), lake, spec, name)

        run_together(lake.spark, [partial(update, spec) for spec in present])
    finally:
        parsed.unpersist()


def _set_aside(
    lake: Lake, parsed: DataFrame, spec: EntitySpec, counts: dict, name: str
) -> DataFrame:
    """Write the topic's bad records to its quarantine table; return the others."""
    problems = counts["malformed"] + sum(
        n for c, n in counts.items() if c.startswith(("null_", "negative_", "unreadable_"))
    )
    if not problems:
        return parsed
    # Cached with its reasons: good and bad rows are two looks at the same column.
    judged = parsed.where(F.col("topic") == spec.topic)
    bad = judged.where(F.size("errors") > 0)
    table = lake.keyed(QUARANTINE, spec.table, ("topic", "partition", "offset"))
    columns = ("topic", "partition", "offset", "kafka_timestamp", "raw_payload", "errors")
    table.upsert(keep_latest(bad.select(*columns), table.keys), name)
    return judged.where(F.size("errors") == 0)


def run(
    bronze: DataFrame, lake: Lake, checkpoint: str, options: SilverOptions | None = None,
    on_report: Callable[[dict], None] | None = None,
) -> None:
    """Process what the raw log has gained since the last run, then stop."""
    chosen = options or SilverOptions()

    def step(batch: DataFrame, batch_id: int) -> None:
        process_batch(lake, chosen, batch, batch_id, on_report)

    (
        bronze.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
