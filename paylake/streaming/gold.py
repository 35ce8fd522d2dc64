"""Raw log + entity state -> metric tables, for the affected keys only.

Run it when the Silver job is through: the state is read inside the batch, so
it includes the records of the batch.

Payments and days are rebuilt for the affected keys. A merchant or a gateway may hold a third of all facts, so
its parts (sums and greatest values) are stored beside its metric row, and the log of changes updates them:
after the first run no facts are read for them, but where a greatest value went away. Parts
and the names of the log entries that they include are one table and one write, so no entry counts twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.operators.keys import restrict, union_keys
from paylake.plans import deltas, gold, incremental
from paylake.session import keep as persisted
from paylake.sources.tables import FolderTable, Lake, MergeTable
from paylake.specs import PAYMENT_TOPICS, entity_for_topic, static_for_table
from paylake.streaming import moves
from paylake.streaming.parallel import run_together
from paylake.streaming.silver import batch_name, entity_table

MERCHANTS = "merchant-events"

GRAINS = {
    "payment_performance": "payment_id",
    "merchant_performance": "merchant_id",
    "gateway_performance": "gateway_id",
    "financial_operations": "operation_date",
}


_FACTS = ("refunds", "chargebacks", "settlements")
# The state tables that the builder of each metric table takes, in order.
_INPUTS = {
    "payment_performance": (
        "payments", "merchants", "payment_gateways", "payment_methods", "payment_attempts",
        "payment_events", *_FACTS,
    ),
    "merchant_performance": ("merchants", "payments", *_FACTS),
    "gateway_performance": ("payment_gateways", "payments", "payment_attempts"),
    "financial_operations": ("payments", *_FACTS),
}


#: Keys of a batch beyond which facts pass a bit set of them before they are shuffled.
LARGE = 200_000


@dataclass(frozen=True)
class GoldOptions:
    """``track_moves``: follow the log of changes, also into the groups that a row has left; without it
    every affected key is rebuilt from its facts.
    ``follow_dimensions``: also rebuild payments whose merchant, gateway or method has changed.
    """

    tables: Sequence[str] = tuple(GRAINS)
    track_moves: bool = True
    follow_dimensions: bool = False


def gold_table(lake: Lake, name: str) -> FolderTable | MergeTable:
    return lake.keyed("gold", name, [GRAINS[name]])


def write_gold(
    rows: DataFrame, lake: Lake, name: str, batch: str | None = None,
    affected: DataFrame | None = None,
) -> None:
    """Upsert metric rows; affected keys without a row any more are removed."""
    gold_table(lake, name).upsert(rows, batch, remove=affected)


def _state(lake: Lake) -> dict[str, DataFrame]:
    topics = (*PAYMENT_TOPICS, MERCHANTS)
    state = {
        e.table: entity_table(lake, e).read() for e in (entity_for_topic(t) for t in topics)
    }
    for name in ("payment_gateways", "payment_methods", "payment_attempts", "payment_events"):
        spec = static_for_table(name)
        state[name] = lake.keyed("silver", name, spec.keys, spec.schema).read()
    return state


def _groups_left(lake: Lake, touched: DataFrame) -> DataFrame | None:
    """What the touched rows named before: the groups that they may have left."""
    log = moves.read(lake)
    if log is None:
        return None
    return log.join(touched.select("topic", "entity_id"), ["topic", "entity_id"], "left_semi").select(*touched.columns)


# --- parts of hot keys ---

ROW, ENTRY, BASE = "row", "entry", "base"


def parts_table(lake: Lake, name: str) -> FolderTable | MergeTable:
    """The parts of each key (kind ``row``) and the log entries that are in them (kind ``entry``)."""
    parts = deltas.PARTS[name]
    values = {n: "bigint" for n in parts.names()}
    if name == "merchant_performance":
        values["last_payment_completed_at"] = "timestamp"
    fields = ", ".join(["kind string", f"{parts.key} string", *(f"{n} {t}" for n, t in values.items())])
    schema = lake.spark.createDataFrame([], fields).schema
    return lake.keyed("gold", f"{name}_parts", ["kind", parts.key], schema)


def _parts_rows(lake: Lake, name: str, rows: DataFrame, entries: Sequence[str]) -> DataFrame:
    parts = deltas.PARTS[name]
    typed = parts_table(lake, name).schema
    full = rows.withColumn("kind", F.lit(ROW)).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in typed.fields])
    marks = lake.spark.createDataFrame([(ENTRY, e) for e in entries], f"kind string, {parts.key} string")
    return full.unionByName(marks, allowMissingColumns=True)


def _facts(name: str, state: dict[str, DataFrame], keys: DataFrame | None = None) -> DataFrame:
    """The images of the facts behind a metric table, all or those of some keys."""
    parts = deltas.PARTS[name]
    made = []
    for table, topic in deltas.FACTS.items():
        if topic in parts.topics():
            rows = state[table] if keys is None else restrict(state[table], keys, parts.key)
            made.append(deltas.images(rows, topic))
    return reduce(DataFrame.unionByName, made)


def _marks(lake: Lake, name: str) -> set[str]:
    stored = parts_table(lake, name).read().where(F.col("kind") == ENTRY)
    return {r[0] for r in stored.select(deltas.PARTS[name].key).collect()}


def refresh_parts(
    lake: Lake, name: str, state: dict[str, DataFrame], keep: Callable[[DataFrame], DataFrame]
) -> None:
    """Bring the parts up to date with the log; the first time, make them from all facts."""
    parts, table = deltas.PARTS[name], parts_table(lake, name)
    marks = _marks(lake, name)
    logged = moves.entries(lake)
    if BASE not in marks:
        table.overwrite(_parts_rows(lake, name, deltas.accumulate(_facts(name, state), parts), [BASE, *logged]))
        return
    new = [e for e in logged if e not in marks]
    if not new:
        return
    stored = table.read().where(F.col("kind") == ROW)
    rows = deltas.update(stored, moves.changes(lake, new), parts, partial(_facts, name, state), keep)
    # Names that have left the log need not be remembered.
    old = lake.spark.createDataFrame([(ENTRY, e) for e in marks - {BASE, *logged}], f"kind string, {parts.key} string")
    table.upsert(_parts_rows(lake, name, rows, new), None, remove=old)


def _from_parts(lake: Lake, name: str, keys: DataFrame, state: dict[str, DataFrame]) -> DataFrame:
    parts = deltas.PARTS[name]
    stored = parts_table(lake, name).read().where(F.col("kind") == ROW).drop("kind")
    dimension = restrict(state[parts.dimension], keys, parts.key)
    return deltas.metric_rows(dimension, restrict(stored, keys, parts.key), parts)


def _affected(
    table: str, touched: DataFrame, state: dict[str, DataFrame], options: GoldOptions
) -> DataFrame:
    if table == "merchant_performance":
        return incremental.affected_merchants(touched)
    if table == "gateway_performance":
        # Few rows, and a gateway without payments has one too.
        every = state["payment_gateways"].select("gateway_id")
        return union_keys([incremental.affected_gateways(touched), every], "gateway_id")
    if table == "financial_operations":
        return incremental.affected_days(touched)
    keys = incremental.affected_payments(touched)
    if not options.follow_dimensions:
        return keys
    moved = [
        incremental.payments_of(state["payments"], touched.where(F.col("topic") == topic), on)
        for topic, on in ((MERCHANTS, "merchant_id"), ("payment_gateways", "gateway_id"))
    ]
    methods = touched.where(F.col("topic") == "payment_methods").select(F.col("entity_id").alias("payment_method_id"))
    moved.append(incremental.payments_of(state["payments"], methods, "payment_method_id"))
    return union_keys([keys, *moved], "payment_id")


def process_batch(lake: Lake, options: GoldOptions, batch: DataFrame, batch_id: int) -> None:
    """One microbatch: parse the keys once, then update each table."""
    touched = persisted(incremental.touched_rows(batch, [*PAYMENT_TOPICS, MERCHANTS]))
    try:
        left = _groups_left(lake, touched) if options.track_moves else None
        _update(lake, options, touched, left, options.tables, batch_name(batch, batch_id))
    finally:
        touched.unpersist()


def process_loads(lake: Lake, options: GoldOptions) -> bool:
    """What loads of static datasets have changed; False if there is nothing.

    Payments follow their attempts and lifecycle events, gateways their attempts and their own rows. The names of
    the log entries name the batch.
    """
    entries = [e for e in moves.entries(lake) if e.startswith(moves.LOAD)]
    changed = moves.changes(lake, entries)
    if not entries or not options.track_moves or changed.isEmpty():
        return False
    touched = changed.select("topic", "entity_id", *incremental.KEY_COLUMNS, "operation_dates")
    tables = [t for t in options.tables if t in ("payment_performance", "gateway_performance")]
    name = "loads-" + hashlib.sha256(" ".join(entries).encode()).hexdigest()[:24]
    _update(lake, options, touched, None, tables, name)
    return True


def _update(
    lake: Lake, options: GoldOptions, touched: DataFrame, left: DataFrame | None, tables: Sequence[str], name: str
) -> None:
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(persisted(df))
        return kept[-1]

    try:
        touched = keep(touched if left is None else touched.unionByName(left))
        state = _state(lake)
        # The tables share the resolved payments; without pending changes they are read from the files as needed.
        pending = getattr(entity_table(lake, entity_for_topic(deltas.PAYMENT)), "pending", None)
        if pending is not None and pending():
            state["payments"] = keep(state["payments"].select(*gold.PAYMENT_COLUMNS))

        def update(table: str) -> None:
            keys = keep(_affected(table, touched, state, options))
            by_parts = options.track_moves and table in deltas.PARTS
            if by_parts:
                refresh_parts(lake, table, state, keep)
            # Counting fills the cache, so Spark knows the size of the key set
            # when it chooses how to join it.
            number = keys.count()
            if number > 0:
                # A table that is not there yet gets most of its keys from the first batch.
                exists = getattr(gold_table(lake, table), "exists", None)
                first = exists is not None and not exists()
                rows = _from_parts(lake, table, keys, state) if by_parts else _rebuild(table, keys, state, number > LARGE, first)
                write_gold(rows, lake, table, name, keys)

        run_together(lake.spark, [partial(update, table) for table in tables])
    finally:
        for df in kept:
            df.unpersist()


def _full(table: str, s: dict[str, DataFrame]) -> DataFrame:
    # The state tables hold one row per id, so plain counts equal distinct counts.
    return getattr(gold, table)(*[s[name] for name in _INPUTS[table]], ids_unique=True)


def _rebuild(table: str, keys: DataFrame, s: dict[str, DataFrame], large: bool = False, first: bool = False) -> DataFrame:
    inputs = [s[name] for name in _INPUTS[table]]
    return incremental.rebuild(table, keys, *inputs, prefilter=large, most=first, ids_unique=True)


def rebuild_all(lake: Lake, tables: Sequence[str] = tuple(GRAINS)) -> None:
    """Build metric tables from the whole state and replace the stored ones.

    For a first load or a repair: with most keys affected, one full build is
    cheaper than reducing every input to its affected keys.
    """
    state = _state(lake)
    logged = [BASE, *moves.entries(lake)]
    work = [partial(gold_table(lake, t).overwrite, _full(t, state)) for t in tables]
    for t in tables:
        if t in deltas.PARTS:
            rows = deltas.accumulate(_facts(t, state), deltas.PARTS[t])
            work.append(partial(parts_table(lake, t).overwrite, _parts_rows(lake, t, rows, logged)))
    run_together(lake.spark, work)


def run(
    bronze: DataFrame, lake: Lake, checkpoint: str, options: GoldOptions | None = None
) -> None:
    """Rebuild what the raw log has touched since the last run, then stop."""
    chosen = options or GoldOptions()
    # A first build reads the static data as they are.
    built = any(BASE in _marks(lake, name) for name in deltas.PARTS)

    def step(batch: DataFrame, batch_id: int) -> None:
        process_batch(lake, chosen, batch, batch_id)

    (
        bronze.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    if built:
        process_loads(lake, chosen)
