"""One query per operator, each over the whole test tables of a folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.checks.views import ACTIVITY, Views, cents
from paylake.functions.scalars import bad_timestamps
from paylake.operators import quality
from paylake.operators.latest import keep_latest
from paylake.operators.upsert import upsert
from paylake.functions import distinct
from paylake.functions import measures as M
from paylake.plans import deltas, gold, incremental, reports
from paylake.session import MIB, scratch_dir
from paylake.sources import bucketed, events, files, monthly
from paylake.sources.tables import Lake, stream_folder
from paylake.specs import ENTITIES, STATIC, EntitySpec, entity_for_table, static_for_table
from paylake.streaming import bronze as bronze_job
from paylake.streaming import gold as gold_job
from paylake.streaming import pipeline
from paylake.streaming import silver as silver_job
from paylake.streaming import static as static_job
from paylake.streaming import winners as winners_job

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _register(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    name = build.__name__
    QUERIES[name] = lambda spark, folder: build(Views.of(spark, folder))
    return build


def _add(name: str, build: Callable[[Views], DataFrame]) -> None:
    QUERIES[name] = lambda spark, folder: build(Views.of(spark, folder))


# --- aggregates ------------------------------------------------------------------

_add("attempts_by_payment", lambda v: M.rollup(v.attempts(), "payment_id", M.attempts))
_add(
    "events_by_payment", lambda v: M.rollup(v.payment_events(), "payment_id", M.lifecycle_events)
)
_add("refunds_by_payment", lambda v: M.rollup(v.refunds(), "payment_id", M.refunds))
_add("chargebacks_by_payment", lambda v: M.rollup(v.chargebacks(), "payment_id", M.chargebacks))
_add("settlements_by_payment", lambda v: M.rollup(v.settlements(), "payment_id", M.settlements))
_add(
    "payments_by_merchant", lambda v: M.rollup(v.payments(), "merchant_id", M.merchant_payments)
)
_add("refunds_by_merchant", lambda v: M.rollup(v.refunds(), "merchant_id", M.refunds))
_add(
    "chargebacks_by_merchant", lambda v: M.rollup(v.chargebacks(), "merchant_id", M.chargebacks)
)
_add(
    "settlements_by_merchant", lambda v: M.rollup(v.settlements(), "merchant_id", M.settlements)
)
_add("payments_by_gateway", lambda v: M.rollup(v.payments(), "gateway_id", M.gateway_payments))
_add("attempts_by_gateway", lambda v: M.rollup(v.attempts(), "gateway_id", M.attempts))
_add("payments_by_day", lambda v: gold.payments_by_day(v.payments()))
_add("refunds_by_day", lambda v: gold.refunds_by_day(v.refunds()))
_add("chargebacks_by_day", lambda v: gold.chargebacks_by_day(v.chargebacks()))
_add("settlements_by_day", lambda v: gold.settlements_by_day(v.settlements()))


# --- metric tables ---------------------------------------------------------------


@_register
def payment_performance(v: Views) -> DataFrame:
    return gold.payment_performance(
        v.payments(), v.merchants(), v.gateways(), v.payment_methods(), v.attempts(),
        v.payment_events(), v.refunds(), v.chargebacks(), v.settlements(),
    )


@_register
def merchant_performance(v: Views) -> DataFrame:
    return gold.merchant_performance(
        v.merchants(), v.payments(), v.refunds(), v.chargebacks(), v.settlements()
    )


@_register
def gateway_performance(v: Views) -> DataFrame:
    return gold.gateway_performance(v.gateways(), v.payments(), v.attempts())


@_register
def financial_operations(v: Views) -> DataFrame:
    return gold.financial_operations(
        v.payments(), v.refunds(), v.chargebacks(), v.settlements()
    )


# --- reports ---------------------------------------------------------------------

_add("payment_dataset", lambda v: reports.dataset(payment_performance(v)))
_add(
    "dataset_row_counts",
    lambda v: reports.dataset_row_counts(
        {
            "payment_performance": payment_performance(v),
            "merchant_performance": merchant_performance(v),
            "gateway_performance": gateway_performance(v),
            "financial_operations": financial_operations(v),
        }
    ),
)
_add("payment_count", lambda v: reports.payment_counter(payment_performance(v)))
_add("total_payment_amount", lambda v: reports.payment_total(payment_performance(v)))
_add("successful_payment_count", lambda v: reports.success_counter(payment_performance(v)))
_add("successful_payment_rate", lambda v: reports.success_rate(payment_performance(v)))
_add(
    "payment_status_distribution", lambda v: reports.status_distribution(payment_performance(v))
)
_add("weekly_payment_volume", lambda v: reports.weekly_volume(payment_performance(v)))
_add("merchant_volume", lambda v: reports.merchant_volume(payment_performance(v)))
_add("top_merchants", lambda v: reports.top_merchants(payment_performance(v), 10))
_add("gateway_payment_count", lambda v: reports.gateway_counts(payment_performance(v)))
_add("net_payment_trend", lambda v: reports.net_payment_trend(financial_operations(v)))
_add("net_payment_weekly", lambda v: reports.net_payment_weekly(financial_operations(v)))
_add("refund_total", lambda v: reports.refund_total(financial_operations(v)))
_add("chargeback_total", lambda v: reports.chargeback_total(financial_operations(v)))
_add("lifecycle_violations", lambda v: reports.lifecycle_violations(payment_performance(v)))


@_register
def merchant_account_pairs(v: Views) -> DataFrame:
    pairs = reports.merchant_account_pairs(v.merchants(), v.accounts())
    return pairs.select("merchant_id", "merchant_name", "account.account_id", "account.bank_name")


# --- events ----------------------------------------------------------------------


def _local_time(column: str):
    return F.col(column).cast("timestamp_ntz").alias(column)


@_register
def event_roundtrip(v: Views) -> DataFrame:
    """Encode to JSON, parse per topic, flatten, type: the source columns come back."""
    log = v.activity_log(cents("value"))
    parts = [events.read_entity(log, spec) for spec in ACTIVITY]
    return reduce(DataFrame.unionByName, parts).select(
        "topic", "partition", "offset", "event_id", "user_id", "value", "props",
        *[_local_time(c) for c in ("kafka_timestamp", "event_timestamp", "created_at")],
    )


@_register
def raw_records(v: Views) -> DataFrame:
    """Kafka-shaped records to raw log columns."""
    records = v.activity_log(cents("value")).select(
        "topic", "partition", "offset",
        F.col("kafka_timestamp").alias("timestamp"),
        F.col("raw_payload").cast("binary").alias("value"),
    )
    return events.prepare_bronze(records).select(
        "topic", "partition", "offset", _local_time("kafka_timestamp"),
        F.get_json_object("raw_payload", "$.payload.props").alias("props"),
    )


@_register
def tolerant_numbers(v: Views) -> DataFrame:
    """Amounts sent as floats: whole ones are kept, those with a fraction are NULL."""
    log = v.activity_log(F.col("value"))
    parts = [events.read_entity(log, spec, numbers="tolerant") for spec in ACTIVITY]
    return reduce(DataFrame.unionByName, parts).select("event_id", "value")


@_register
def strict_numbers(v: Views) -> DataFrame:
    """The same under the declared bigint type, every other amount a whole number.

    No float is read, and nothing else is lost.
    """
    even = F.col("offset") % 2 == 0
    whole, floats = v.activity_log(cents("value")), v.activity_log(F.col("value"))
    log = whole.where(even).unionByName(floats.where(~even))
    parts = [events.read_entity(log, spec) for spec in ACTIVITY]
    return reduce(DataFrame.unionByName, parts).select("event_id", "user_id", "value")


def _damaged_log(v: Views) -> DataFrame:
    """Errors carry text that is no JSON, views no payload, sign-ups a negative amount,
    purchases a time that is none."""
    kind = F.col("topic")
    log = v.activity_log(
        F.when(F.col("event_type") == "signup", -cents("value")).otherwise(cents("value"))
    )
    return log.withColumn(
        "raw_payload",
        F.when(kind == "error-events", F.lit("garbage"))
        .when(kind == "view-events", F.lit('{"timestamp":"t"}'))
        .when(
            kind == "purchase-events",
            F.regexp_replace(
                "raw_payload", '"created_at":"[^"]*"', '"created_at":"notadate"'
            ),
        )
        .otherwise(F.col("raw_payload")),
    )


@_register
def malformed_events(v: Views) -> DataFrame:
    """The report over a damaged log, a row per topic.

    Every tenth record comes twice, and every tenth again with another offset.
    """
    log = _damaged_log(v)
    log = log.unionByName(log.where(F.col("offset") % 10 == 0)).unionByName(
        log.where(F.col("offset") % 10 == 1).withColumn("offset", F.col("offset") + 10**9)
    )
    return quality.event_report(events.parse_all(log, ACTIVITY), ACTIVITY)


def _errors(log: DataFrame, numbers: str = "strict") -> DataFrame:
    judged = quality.judged(events.parse_all(log, ACTIVITY, numbers), ACTIVITY, numbers)
    bad = judged.select("topic", "offset", "errors").where(F.size("errors") > 0)
    return bad.select("topic", "offset", F.array_join("errors", ",").alias("errors"))


@_register
def refused_events(v: Views) -> DataFrame:
    """The records that quarantine mode sets aside, with the reasons."""
    return _errors(_damaged_log(v))


@_register
def unreadable_values(v: Views) -> DataFrame:
    """Amounts with a fraction where whole numbers are expected, and negative ones."""
    return _errors(v.activity_log(F.col("value") - 100), "tolerant")


@_register
def undeclared_fields(v: Views) -> DataFrame:
    """The fields of activity records that a narrower declaration would leave out, with their types."""
    narrow = tuple(
        EntitySpec(s.topic, s.table, s.keys, "event_id bigint, value bigint" + (", user_id bigint" if s.table == "click" else ""))
        for s in ACTIVITY
    )
    return events.undeclared_fields(v.activity_log(F.col("value")), narrow)


@_register
def bad_event_times(v: Views) -> DataFrame:
    """Texts that do not parse as a time, counted without failing."""
    rows = v.table("events").select(
        F.when(F.col("event_type") == "error", F.lit("notadate"))
        .otherwise(F.col("ts").cast("string"))
        .alias("created_at"),
        F.to_date("ts").cast("string").alias("due_date"),
    )
    return bad_timestamps(rows)


# --- quality ---------------------------------------------------------------------

_add(
    "required_nulls",
    lambda v: quality.required_nulls(
        v.payments(), ["payment_id", "merchant_id", "completed_at", "absent_column"]
    ),
)
_add(
    "negative_values",
    lambda v: quality.negative_values(
        v.table("customer").select(
            cents("c_acctbal").alias("amount"), F.col("c_custkey").alias("refund_amount")
        ),
        ["amount", "refund_amount", "settlement_amount"],
    ),
)
_add(
    "transport_duplicates",
    lambda v: quality.duplicates(
        v.refund_log().select("topic", "partition", F.to_date("kafka_timestamp").alias("offset")),
        ["topic", "partition", "offset"],
    ),
)
_add("key_duplicates", lambda v: quality.duplicates(v.attempts(), ["attempt_id"]))
_add("grain_check", lambda v: quality.grain(payment_performance(v), "payment_id"))
_add(
    "id_hygiene",
    lambda v: quality.id_hygiene(payment_performance(v), "payment_reference"),
)
_add(
    "id_pattern_matches",
    lambda v: quality.id_hygiene(payment_performance(v), "payment_reference", "%99%"),
)
_add("events_per_topic", lambda v: quality.events_per_topic(v.activity_log(cents("value"))))
_add("topic_counts", lambda v: quality.events_per_topic(v.raw_log()))


# --- state -----------------------------------------------------------------------

_LINE_KEY = ["l_orderkey", "l_linenumber"]
_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey"]


def _lines(v: Views, status: str | None = None) -> DataFrame:
    rows = v.table("lineitem")
    if status is not None:
        rows = rows.where(F.col("l_linestatus") == status)
    rows = rows.select(*_LINE_KEY, *_LINE_ORDER, "l_quantity", "l_linestatus")
    return keep_latest(rows, _LINE_KEY, _LINE_ORDER)


_add("keep_latest", _lines)
_add("upsert_snapshot", lambda v: upsert(_lines(v, "F"), _lines(v, "O"), _LINE_KEY))
_add(
    "upsert_newer_wins",
    lambda v: upsert(
        _lines(v, "F"), _lines(v, "O"), _LINE_KEY, newer_wins=True, order=_LINE_ORDER
    ),
)


_add(
    "upsert_ties",
    lambda v: upsert(
        _lines(v),
        _lines(v).where("l_orderkey % 2 = 0").withColumn("l_quantity", F.col("l_quantity") + 1),
        _LINE_KEY, newer_wins=True, order=_LINE_ORDER,
    ),
)


# --- incremental -----------------------------------------------------------------
# The batch: the events of all four topics that arrive in one month; for gateways the
# payments through those of one region. Keys in JSON are text; the views hold numbers.

MONTH = ("1995-03-01", "1995-04-01")
REGION = "ASIA"


def _touched(v: Views) -> DataFrame:
    logs = (v.payment_log(), v.refund_log(), v.chargeback_log(), v.settlement_log())
    start, end = (F.lit(day).cast("timestamp") for day in MONTH)
    arrived = F.col("kafka_timestamp")
    batch = reduce(DataFrame.unionByName, logs).where((arrived >= start) & (arrived < end))
    return incremental.touched_rows(batch)


def _gateways_of_region(v: Views) -> DataFrame:
    return v.gateways().where(F.col("provider") == REGION).select("gateway_id")


def _as_number(keys: DataFrame, kind: str) -> DataFrame:
    (name,) = keys.columns
    return keys.select(F.col(name).cast(kind).alias(name))


_add(
    "affected_payments",
    lambda v: _as_number(incremental.affected_payments(_touched(v)), "bigint"),
)
_add(
    "affected_merchants",
    lambda v: _as_number(incremental.affected_merchants(_touched(v)), "bigint"),
)


def _affected_gateways(v: Views) -> DataFrame:
    rows = v.payments().join(_gateways_of_region(v), "gateway_id", "left_semi")
    touched = incremental.touched_rows(v.log_of_payments(rows))
    return _as_number(incremental.affected_gateways(touched), "int")


_add("affected_gateways", _affected_gateways)
_add(
    "affected_days",
    lambda v: incremental.affected_days(_touched(v)),
)


@_register
def incremental_payment_performance(v: Views) -> DataFrame:
    return incremental.rebuild(
        "payment_performance",
        _as_number(incremental.affected_payments(_touched(v)), "bigint"),
        v.payments(), v.merchants(), v.gateways(), v.payment_methods(), v.attempts(),
        v.payment_events(), v.refunds(), v.chargebacks(), v.settlements(),
    )


@_register
def prefiltered_payment_performance(v: Views) -> DataFrame:
    """The same through a bit set of the keys, as for a key set that is too large to broadcast."""
    keys = _stored(v, _as_number(incremental.affected_payments(_touched(v)), "bigint"), "keys")
    return incremental.rebuild(
        "payment_performance", keys, v.payments(), v.merchants(), v.gateways(), v.payment_methods(), v.attempts(),
        v.payment_events(), v.refunds(), v.chargebacks(), v.settlements(), prefilter=True,
    )


@_register
def incremental_merchant_performance(v: Views) -> DataFrame:
    return incremental.rebuild(
        "merchant_performance",
        _as_number(incremental.affected_merchants(_touched(v)), "bigint"),
        v.merchants(), v.payments(), v.refunds(), v.chargebacks(), v.settlements(),
    )


@_register
def incremental_gateway_performance(v: Views) -> DataFrame:
    return incremental.rebuild(
        "gateway_performance", _affected_gateways(v), v.gateways(), v.payments(), v.attempts(),
    )


@_register
def incremental_financial_operations(v: Views) -> DataFrame:
    return incremental.rebuild(
        "financial_operations",
        incremental.affected_days(_touched(v)),
        v.payments(), v.refunds(), v.chargebacks(), v.settlements(),
    )


# --- state kept up, cut and merged -----------------------------------------------


def _stored(v: Views, rows: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(v.spark, name)
    rows.write.mode("overwrite").parquet(path)
    return v.spark.read.schema(rows.schema).parquet(path)


def _latest_facts(v: Views) -> dict[str, DataFrame]:
    """Facts with one row per id, as the state tables have them."""
    found = {"payments": v.payments()}
    for name, rows, key, time in (
        ("refunds", v.refund_lines(), "refund_id", "requested_at"),
        ("chargebacks", v.chargeback_lines(), "chargeback_id", "created_at"),
        ("settlements", v.settlement_lines(), "settlement_id", "initiated_at"),
    ):
        placed = rows.withColumn("_partition", F.col("_arrival") % 3)
        found[name] = keep_latest(placed, [key], [time, "_partition", "_arrival"]).drop("_partition", "_arrival")
    lines = v.table("lineitem").withColumn("attempt_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    found["payment_attempts"] = keep_latest(lines, ["attempt_id"], _LINE_ORDER).select(
        "attempt_id",
        F.col("l_orderkey").alias("payment_id"),
        (F.col("l_suppkey") % 25).alias("gateway_id"),
        F.col("l_linenumber").alias("attempt_number"),
        F.when(F.col("l_returnflag") == "R", "Failed").when(F.col("l_returnflag") == "A", "Success").otherwise("Pending").alias("attempt_status"),
    )
    return found


def _kept_up(v: Views, table: str, dimension: DataFrame) -> DataFrame:
    """The metric table from its stored parts and the changes of every fourth payment."""
    parts = deltas.PARTS[table]

    def images(facts: dict[str, DataFrame]) -> DataFrame:
        topics = {n: t for n, t in deltas.FACTS.items() if t in parts.topics()}
        return reduce(DataFrame.unionByName, [deltas.images(facts[n], t) for n, t in topics.items()])

    before = _latest_facts(v)
    moved = _stored(v, _moved_payments(v), "moved")
    stored = _stored(v, deltas.accumulate(images(before), parts), "parts")
    changed = deltas.changes(v.payments().where("payment_id % 4 = 0"), moved, deltas.PAYMENT)
    now = {**before, "payments": v.payments().where("payment_id % 4 <> 0").unionByName(moved)}
    updated = deltas.update(stored, changed, parts, lambda keys: images(now).join(keys, parts.key, "left_semi"))
    whole = deltas.merged(stored, updated, parts)
    typed = whole.withColumn(parts.key, F.col(parts.key).cast(dimension.schema[parts.key].dataType))
    rows = deltas.metric_rows(dimension, typed, parts)
    return rows.select(*[_local_time(c) if c == "last_payment_completed_at" else c for c in rows.columns])


_add("kept_up_merchant_performance", lambda v: _kept_up(v, "merchant_performance", v.merchants()))
_add("kept_up_gateway_performance", lambda v: _kept_up(v, "gateway_performance", v.gateways()))


_GRAINS = {"payments": gold.payment_day, "refunds": gold.refund_day, "chargebacks": gold.chargeback_day, "settlements": gold.settlement_day}


def _facts_of_days(v: Views) -> dict[str, DataFrame]:
    return {"payments": v.payments(), "refunds": v.refunds(), "chargebacks": v.chargebacks(), "settlements": v.settlements()}


def _monthly(v: Views) -> dict[str, DataFrame]:
    tables = {}
    for name, rows in _facts_of_days(v).items():
        path = scratch_dir(v.spark, f"monthly-{name}")
        monthly.write(rows, path, _GRAINS[name]())
        tables[name] = monthly.read(v.spark, path, rows.schema)
    return tables


@_register
def monthly_financial_operations(v: Views) -> DataFrame:
    """The days of one month of events rebuilt from facts that are laid out by month."""
    return incremental.rebuild("financial_operations", incremental.affected_days(_touched(v)), *_monthly(v).values())


@_register
def bucketed_payment_performance(v: Views) -> DataFrame:
    """The payment table from tables that are bucketed by the payment."""
    facts = {
        "payments": v.payments(), "attempts": v.attempts(), "events": v.payment_events(),
        "refunds": v.refunds(), "chargebacks": v.chargebacks(), "settlements": v.settlements(),
    }
    tables = {}
    # One task joins the buckets of all six tables; as rows they are many times larger than compressed.
    buckets = max(8, bucketed.buckets_for(v.fact_bytes(), 4 * MIB))
    for name, rows in facts.items():
        path = scratch_dir(v.spark, f"bucketed-{name}")
        tables[name] = bucketed.write(rows, f"bucketed_{name}_{path[-6:].lower().replace('-', '_')}", "payment_id", buckets, path)
    return gold.payment_performance(
        tables["payments"], v.merchants(), v.gateways(), v.payment_methods(), tables["attempts"], tables["events"],
        tables["refunds"], tables["chargebacks"], tables["settlements"], children_first=True,
    )


@_register
def attempts_by_merged_days(v: Views) -> DataFrame:
    """Distinct attempts of each gateway from stored sets of ids of each day, merged."""
    attempts = v.table("lineitem").select(
        (F.col("l_suppkey") % 25).cast("int").alias("gateway_id"),
        F.to_date("l_shipdate").alias("day"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("attempt_id"),
    )
    sets = _stored(v, distinct.id_sets(attempts, ["gateway_id", "day"], "attempt_id"), "id-sets")
    return distinct.counts(sets, ["gateway_id"], "attempt_count")


# --- streaming -------------------------------------------------------------------

_RUNS: dict[tuple[str, str, str], Lake] = {}


def _once(
    v: Views, kind: str, run: Callable[[Lake], None], newer_wins: bool = True
) -> Lake:
    """Run a job into a new folder, once per session and data folder."""
    key = (v.spark.sparkContext.applicationId, v.folder, kind)
    if key not in _RUNS:
        lake = Lake(v.spark, scratch_dir(v.spark, kind), newer_wins=newer_wins)
        run(lake)
        _RUNS[key] = lake
    return _RUNS[key]


def _records(lake: Lake, raw_log: DataFrame) -> DataFrame:
    """Drop the log as files of Kafka-shaped records; return the stream over all dropped so far."""
    records = raw_log.select(
        "topic", "partition", "offset",
        F.col("kafka_timestamp").alias("timestamp"),
        F.col("raw_payload").cast("binary").alias("value"),
    )
    folder = f"{lake.root}/drop"
    writer = records.write.mode("append").option("compression", files.CODEC).option(files.ROW_GROUP_SETTING, str(files.ROW_GROUP))
    writer.parquet(folder)
    return stream_folder(lake.spark, folder, records.schema)


def _static_csv(v: Views, lake: Lake) -> dict[str, str]:
    """The static datasets as CSV folders; attempts reduced to one row per id."""
    lines = v.table("lineitem").withColumn(
        "attempt_id", F.col("l_orderkey") * 10 + F.col("l_linenumber")
    )
    attempts = keep_latest(lines, ["attempt_id"], _LINE_ORDER).select(
        "attempt_id",
        F.col("l_orderkey").alias("payment_id"),
        (F.col("l_suppkey") % 25).alias("gateway_id"),
        F.when(F.col("l_returnflag") == "R", "Failed")
        .when(F.col("l_returnflag") == "A", "Success")
        .otherwise("Pending")
        .alias("attempt_status"),
        F.col("l_linenumber").alias("attempt_number"),
    )
    frames = {
        "payment_gateways": v.gateways(),
        "payment_methods": v.payment_methods().withColumns(
            {"provider": F.lit("Bank"), "status": F.lit("Active")}
        ),
        "payment_attempts": attempts,
        "payment_events": v.payment_events().withColumn(
            "event_timestamp", F.col("event_timestamp").cast("string")
        ),
        "merchant_bank_accounts": v.accounts().join(
            v.payments().select(
                F.concat(F.lit("ACC"), F.lpad("payment_reference", 12, "0")).alias("account_id"),
                F.col("payment_id").alias("account_number"),
                F.lit("IFSC").alias("ifsc_code"),
                F.lit("Current").alias("account_type"),
                F.lit("Active").alias("account_status"),
                F.date_format("initiated_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
            ),
            "account_id",
        ),
    }
    paths = {}
    for spec in STATIC:
        if spec.table in frames:
            paths[spec.table] = f"{lake.root}/csv/{spec.table}"
            rows = frames[spec.table].select(*spec.schema.fieldNames())
            rows.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(paths[spec.table])
    return paths


_MAX_FILES = 48
_GOLD_DONE: set[str] = set()


def _silver_run(v: Views) -> Lake:
    """Raw log, static data and entity state over all records, in several microbatches."""

    def run(lake: Lake) -> None:
        paths = _static_csv(v, lake)
        stream = events.prepare_bronze(_records(lake, v.raw_log()))
        bronze_job.ingest(stream, lake, f"{lake.root}/checkpoints/bronze")
        static_job.ingest(lake, paths)
        static_job.process(lake, list(paths))
        log = pipeline.raw_log(lake, _MAX_FILES)
        silver_job.run(log, lake, f"{lake.root}/checkpoints/silver")

    return _once(v, "pipeline", run)


def _whole_run(v: Views) -> Lake:
    """The metric tables on top of it; the first query that needs them pays for the job."""
    lake = _silver_run(v)
    if lake.root not in _GOLD_DONE:
        gold_job.run(pipeline.raw_log(lake, _MAX_FILES), lake, f"{lake.root}/checkpoints/gold")
        _GOLD_DONE.add(lake.root)
    return lake


@_register
def bronze_stream_counts(v: Views) -> DataFrame:
    def run(lake: Lake) -> None:
        stream = events.prepare_bronze(_records(lake, v.activity_log(cents("value"))))
        bronze_job.ingest(stream, lake, f"{lake.root}/checkpoints/bronze")

    lake = _once(v, "bronze", run)
    raw = v.spark.read.parquet(lake.location("bronze", bronze_job.RAW_EVENTS))
    return quality.events_per_topic(raw)


@_register
def silver_stream_state(v: Views) -> DataFrame:
    """Current state of four entities after the whole stream."""
    lake = _silver_run(v)
    parts = []
    for table in ("payments", "refunds", "chargebacks", "settlements"):
        spec = entity_for_table(table)
        rows = silver_job.entity_table(lake, spec).read()
        parts.append(
            rows.select(
                F.lit(table).alias("entity"),
                F.col(spec.keys[0]).alias("id"),
                "payment_id",
                "merchant_id",
                F.col(spec.money[0]).alias("amount"),
                "offset",
                _local_time("kafka_timestamp"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _entity(lake: Lake, table: str, *columns) -> DataFrame:
    """Entity, id and some columns of its current state."""
    spec = entity_for_table(table)
    rows = silver_job.entity_table(lake, spec).read()
    return rows.select(F.lit(table).alias("entity"), F.col(spec.keys[0]).alias("id"), *columns)


def _to_silver(lake: Lake, raw_log: DataFrame, checkpoint: str = "silver") -> None:
    """Drop the log, take it into the raw log and from there into the state."""
    stream = events.prepare_bronze(_records(lake, raw_log))
    bronze_job.ingest(stream, lake, f"{lake.root}/checkpoints/bronze")
    silver_job.run(pipeline.raw_log(lake), lake, f"{lake.root}/checkpoints/{checkpoint}")


@_register
def silver_all_entities(v: Views) -> DataFrame:
    """Current state of all seven entities, the last arrival winning."""

    def run(lake: Lake) -> None:
        _to_silver(
            lake, v.raw_log().unionByName(v.customer_log()).unionByName(v.invoice_log())
        )

    lake = _once(v, "entities", run, newer_wins=False)
    parts = []
    for spec in ENTITIES:
        amount = F.col(spec.money[0]) if spec.money else F.lit(None).cast("bigint")
        parts.append(_entity(lake, spec.table, amount.alias("amount"), _local_time("kafka_timestamp")))
    return reduce(DataFrame.unionByName, parts)


def _later_arrivals(v: Views) -> Lake:
    """All payments, and in a second drop every third one again, with an older event."""

    def run(lake: Lake) -> None:
        _to_silver(lake, v.payment_log())
        _to_silver(lake, v.log_of_payments(_older_payments(v)))

    return _once(v, "arrivals", run, newer_wins=False)


def _older_payments(v: Views) -> DataFrame:
    return v.payments().where("payment_id % 3 = 0").withColumns(
        {"amount": F.col("amount") + 1, "initiated_at": F.expr("initiated_at - INTERVAL 30 DAYS")}
    )


def _payment_state(lake: Lake) -> DataFrame:
    rows = _entity(lake, "payments", "amount", _local_time("kafka_timestamp"))
    return rows.drop("entity").withColumnRenamed("id", "payment_id")


_add("silver_last_arrival_state", lambda v: _payment_state(_later_arrivals(v)))


@_register
def silver_replay_state(v: Views) -> DataFrame:
    """The raw log of both drops once more, under a new checkpoint: one batch, so its latest
    event by arrival order wins."""

    def run(lake: Lake) -> None:
        log = v.payment_log().unionByName(v.log_of_payments(_older_payments(v)))
        _to_silver(lake, log)
        silver_job.run(pipeline.raw_log(lake), lake, f"{lake.root}/checkpoints/again")

    return _payment_state(_once(v, "replay", run, newer_wins=False))


@_register
def silver_added_column_state(v: Views) -> DataFrame:
    """Payments from two drops; the second, every third payment again, has a column that the first did not have."""

    def run(lake: Lake) -> None:
        spec = entity_for_table("payments")
        columns = [f for f in spec.payload.split(", ") if not f.startswith("processing_time_ms")]
        narrow = replace(spec, payload=", ".join(columns))
        first = lake, v.log_of_payments(v.payments().drop("processing_time_ms"))
        again = lake, v.log_of_payments(v.payments().where("payment_id % 3 = 0"))
        for (where, log), own in ((first, narrow), (again, spec)):
            stream = events.prepare_bronze(_records(where, log))
            bronze_job.ingest(stream, lake, f"{lake.root}/checkpoints/bronze")
            options = silver_job.SilverOptions(specs=(own,))
            silver_job.run(pipeline.raw_log(lake), lake, f"{lake.root}/checkpoints/silver", options)

    lake = _once(v, "added", run, newer_wins=False)
    return _entity(lake, "payments", "amount", "processing_time_ms").drop("entity")


@_register
def silver_winners_state(v: Views) -> DataFrame:
    """The same two drops as above, the winners kept in the state store; the second run resumes from the checkpoint."""

    def run(lake: Lake) -> None:
        spec = entity_for_table("payments")
        for log in (v.payment_log(), v.log_of_payments(_older_payments(v))):
            stream = events.prepare_bronze(_records(lake, log))
            bronze_job.ingest(stream, lake, f"{lake.root}/checkpoints/bronze")
            winners_job.run(pipeline.raw_log(lake), lake, spec, f"{lake.root}/checkpoints/winners")

    return _payment_state(_once(v, "winners", run, newer_wins=False))


@_register
def gold_after_loads(v: Views) -> DataFrame:
    """Payment metrics after a second load of the static data changes some attempts and lifecycle events and
    takes others away, without a new event."""

    def run(lake: Lake) -> None:
        paths = _static_csv(v, lake)
        pipeline.run(lake, _records(lake, v.payment_log()), f"{lake.root}/checkpoints", static_paths=paths)
        later = dict(paths)
        for name, number in (("payment_attempts", "attempt_number"), ("payment_events", "retry_count")):
            later[name] = f"{paths[name]}-later"
            rows = v.spark.read.option("header", True).csv(paths[name]).where("payment_id % 7 <> 0")
            more = F.when(F.expr("payment_id % 5 = 0"), F.col(number).cast("int") + 1).otherwise(F.col(number).cast("int"))
            rows.withColumn(number, more).write.mode("overwrite").option("header", True).option("compression", "gzip").csv(later[name])
        records = stream_folder(v.spark, f"{lake.root}/drop", v.spark.read.parquet(f"{lake.root}/drop").schema)
        pipeline.run(lake, records, f"{lake.root}/checkpoints", static_paths=later)

    rows = gold_job.gold_table(_once(v, "loads", run, newer_wins=False), "payment_performance").read()
    return rows.select("payment_id", "attempt_count", "failed_attempt_count", "max_attempt_number", "event_count", "total_retry_count")


@_register
def gold_following_merchants(v: Views) -> DataFrame:
    """The names in payment rows after merchants were renamed, with ``follow_dimensions``."""

    def run(lake: Lake) -> None:
        renamed = v.merchants().where("merchant_id % 3 = 0").withColumn("merchant_name", F.concat(F.lit("New "), "merchant_name"))
        log = events.table_to_events(
            renamed, "merchants", F.to_timestamp(F.lit("2021-01-01 00:00:00")), F.col("merchant_id") % 3, F.col("merchant_id") + 10**9,
            F.to_timestamp(F.lit("2021-01-01 00:00:00")),
        )
        options = gold_job.GoldOptions(tables=("payment_performance",), follow_dimensions=True)
        for drop in (v.merchant_log().unionByName(v.payment_log()), log):
            pipeline.run(lake, _records(lake, drop), f"{lake.root}/checkpoints", gold_options=options)

    rows = gold_job.gold_table(_once(v, "following", run, newer_wins=False), "payment_performance").read()
    return rows.select("payment_id", "merchant_id", "merchant_name", "amount")


@_register
def gold_after_moves(v: Views) -> DataFrame:
    """Metric rows after a second drop moves every fourth payment to another merchant,
    gateway and day."""

    def run(lake: Lake) -> None:
        gateways = lake.keyed("silver", "payment_gateways", ["gateway_id"])
        gateways.overwrite(v.gateways().withColumn("gateway_id", F.col("gateway_id").cast("string")))
        for log in (v.merchant_log().unionByName(v.payment_log()), v.log_of_payments(_moved_payments(v))):
            pipeline.run(lake, _records(lake, log), f"{lake.root}/checkpoints")

    lake = _once(v, "moves", run, newer_wins=False)
    parts = [
        gold_job.gold_table(lake, table).read().select(
            F.lit(table).alias("metric"),
            F.col(key).cast("string").alias("key"),
            "payment_count",
            "total_payment_amount",
        )
        for table, key in gold_job.GRAINS.items()
        if table != "payment_performance"
    ]
    return reduce(DataFrame.unionByName, parts)


def _moved_payments(v: Views) -> DataFrame:
    return v.payments().where("payment_id % 4 = 0").withColumns(
        {
            "merchant_id": F.lit(1).cast("bigint"),
            "gateway_id": F.lit(7),
            "initiated_at": F.expr("initiated_at + INTERVAL 10 DAYS"),
            "completed_at": F.expr("completed_at + INTERVAL 10 DAYS"),
        }
    )


def _static_state(v: Views) -> Lake:
    def run(lake: Lake) -> None:
        paths = _static_csv(v, lake)
        static_job.ingest(lake, paths)
        static_job.process(lake, list(paths))

    return _once(v, "static", run)


@_register
def static_silver_state(v: Views) -> DataFrame:
    """Lifecycle events after CSV -> raw table -> typed table."""
    rows = _static_state(v).keyed("silver", "payment_events", ["event_id"]).read()
    return rows.select("event_id", "payment_id", "retry_count", _local_time("event_timestamp"))


@_register
def static_typed_state(v: Views) -> DataFrame:
    """The other four datasets; their raw tables hold text alone."""
    lake = _static_state(v)
    shown = {
        "merchant_bank_accounts": ("merchant_id", "account_number", "created_at"),
        "payment_methods": ("category", None, None),
        "payment_gateways": ("provider", None, None),
        "payment_attempts": ("attempt_status", "attempt_number", None),
    }
    parts = []
    for table, (text, number, time) in shown.items():
        (key,) = static_for_table(table).keys
        parts.append(
            lake.keyed("silver", table, [key]).read().select(
                F.lit(table).alias("dataset"),
                F.col(key).alias("id"),
                F.col(text).alias("detail"),
                (F.col(number) if number else F.lit(None)).cast("bigint").alias("number"),
                (F.col(time) if time else F.lit(None)).cast("timestamp_ntz").alias("time"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _gold_state(v: Views, name: str) -> DataFrame:
    rows = gold_job.gold_table(_whole_run(v), name).read()
    times = {"initiated_at", "completed_at", "last_event_timestamp", "last_payment_completed_at"}
    return rows.select(*[_local_time(c) if c in times else c for c in rows.columns])


_add("gold_stream_state", lambda v: _gold_state(v, "payment_performance"))
_add("gold_stream_merchants", lambda v: _gold_state(v, "merchant_performance"))
_add("gold_stream_gateways", lambda v: _gold_state(v, "gateway_performance"))
_add("gold_stream_days", lambda v: _gold_state(v, "financial_operations"))
