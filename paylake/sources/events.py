"""The raw event log: records, JSON envelope, parsing.

Wire format of ``raw_payload``: ``{"timestamp": "<iso 8601>", "payload": {...}}``.

Numbers are read in one of two ways. ``strict`` lets Spark's JSON reader apply
the declared bigint type, so ``123.0`` and ``"77"`` become NULL. ``tolerant``
accepts whole numbers in either notation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.functions.scalars import transform_event, whole_number
from paylake.specs import ENTITIES, TRANSPORT, EntitySpec, entity_for_topic

CORRUPT = "_corrupt_record"
_WRITE_JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def prepare_bronze(records: DataFrame) -> DataFrame:
    """Kafka-shaped records (topic, partition, offset, timestamp, value) to the raw log."""
    return records.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("value").cast("string").alias("raw_payload"),
    )


def to_envelope(event_time: Column, payload: Sequence[str | Column]) -> Column:
    """The JSON text of one event; NULL fields are written as null."""
    return F.to_json(
        F.struct(event_time.alias("timestamp"), F.struct(*payload).alias("payload")),
        _WRITE_JSON,
    )


def table_to_events(
    df: DataFrame,
    table: str,
    event_time: Column,
    partition: Column,
    offset: Column,
    kafka_timestamp: Column,
    payload: Sequence[str] | None = None,
) -> DataFrame | None:
    """Replay a table as raw log records; None for a table that has no topic.

    ``payload`` names the columns to send, all by default.
    """
    spec = next((s for s in ENTITIES if s.table == table), None)
    if spec is None:
        return None
    return df.select(
        F.lit(spec.topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        kafka_timestamp.alias("kafka_timestamp"),
        to_envelope(event_time, payload or df.columns).alias("raw_payload"),
    )


def _json_schema(spec: EntitySpec, tolerant: bool, corrupt: bool) -> T.StructType:
    payload = [
        T.StructField(f.name, T.StringType() if tolerant else f.dataType)
        for f in spec.payload_schema.fields
    ]
    fields = [
        T.StructField("timestamp", T.StringType()),
        T.StructField("payload", T.StructType(payload)),
    ]
    if corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType()))
    return T.StructType(fields)


def _read_json(spec: EntitySpec, numbers: str, corrupt: bool) -> Column:
    if numbers not in ("strict", "tolerant"):
        raise ValueError(f"numbers must be 'strict' or 'tolerant', not {numbers!r}")
    schema = _json_schema(spec, numbers == "tolerant", corrupt)
    options = {"columnNameOfCorruptRecord": CORRUPT} if corrupt else {}
    return F.from_json("raw_payload", schema, options)


def _payload_columns(spec: EntitySpec, event: Column, numbers: str) -> list[Column]:
    columns = []
    for field in spec.payload_schema.fields:
        value = event["payload"][field.name]
        if numbers == "tolerant" and isinstance(field.dataType, T.LongType):
            value = whole_number(value)
        columns.append(value.alias(field.name))
    return columns


def parse_event(
    bronze: DataFrame, topic: str | EntitySpec, numbers: str = "strict"
) -> DataFrame:
    """Records of one topic with their JSON parsed into a column ``event``."""
    spec = topic if isinstance(topic, EntitySpec) else entity_for_topic(topic)
    records = bronze.where(F.col("topic") == spec.topic)
    event = _read_json(spec, numbers, corrupt=False)
    if numbers == "strict":
        return records.withColumn("event", event)
    raw = records.withColumn("_text", event)
    payload = F.struct(*_payload_columns(spec, F.col("_text"), numbers))
    typed = F.struct(
        F.col("_text.timestamp").alias("timestamp"),
        F.when(F.col("_text.payload").isNotNull(), payload).alias("payload"),
    )
    return raw.withColumn("event", typed).drop("_text")


def flatten_event(parsed: DataFrame) -> DataFrame:
    """Transport columns, event time and the payload fields as top-level columns."""
    return parsed.select(
        *TRANSPORT, F.col("event.timestamp").alias("event_timestamp"), "event.payload.*"
    )


def read_entity(
    bronze: DataFrame, topic: str | EntitySpec, numbers: str = "strict"
) -> DataFrame:
    """Parse, flatten and type the events of one topic."""
    return transform_event(flatten_event(parse_event(bronze, topic, numbers)))


def parse_all(
    bronze: DataFrame, specs: Sequence[EntitySpec] = ENTITIES, numbers: str = "strict"
) -> DataFrame:
    """Parse all topics in one pass.

    Adds one struct column per entity, named after its table and NULL for
    records of other topics. Each record is parsed once, with the schema of its
    own topic. One flat projection keeps the generated code small enough for the
    JVM to compile.
    """
    parsed = [
        F.when(F.col("topic") == s.topic, _read_json(s, numbers, corrupt=True)).alias(s.table)
        for s in specs
    ]
    known = bronze.where(F.col("topic").isin(*[s.topic for s in specs]))
    return known.select(*TRANSPORT, "raw_payload", *parsed)


def malformed(spec: EntitySpec) -> Column:
    """Whether a record of the entity is no JSON object of the declared types."""
    event = F.col(spec.table)
    return event["payload"].isNull() | event[CORRUPT].isNotNull()


def payload_field(spec: EntitySpec, name: str, numbers: str = "strict") -> Column:
    """A payload field of a record parsed by ``parse_all``, with its declared type."""
    value = F.col(spec.table)["payload"][name]
    if numbers == "tolerant" and isinstance(spec.payload_schema[name].dataType, T.LongType):
        return whole_number(value)
    return value


def entity_rows(parsed: DataFrame, spec: EntitySpec, numbers: str = "strict") -> DataFrame:
    """The typed rows of one entity out of a frame made by ``parse_all``."""
    names = spec.payload_schema.fieldNames()
    rows = parsed.where(F.col("topic") == spec.topic).select(
        *TRANSPORT,
        F.col(spec.table)["timestamp"].alias("event_timestamp"),
        *[payload_field(spec, c, numbers).alias(c) for c in names],
    )
    return transform_event(rows)


def undeclared_fields(bronze: DataFrame, specs: Sequence[EntitySpec] = ENTITIES) -> DataFrame:
    """How often payloads have fields that their topic does not declare, which parsing leaves out: a report of drift.

    Columns: topic, field, records, and ``kind``, the type that holds all its values. The text is parsed once, into
    a VARIANT; fields that come and go need no schema.
    """
    known = bronze.where(F.col("topic").isin(*[s.topic for s in specs]))
    payload = F.try_variant_get(F.try_parse_json("raw_payload"), "$.payload", "map<string,variant>")
    declared = F.lit(None).cast("array<string>")
    for s in specs:
        names = F.array(*map(F.lit, s.payload_schema.fieldNames()))
        declared = F.when(F.col("topic") == s.topic, names).otherwise(declared)
    each = known.select("topic", declared.alias("_declared"), F.explode(payload).alias("field", "value"))
    drift = each.where(~F.array_contains("_declared", F.col("field")))
    kind = F.schema_of_variant_agg("value").alias("kind")
    return drift.groupBy("topic", "field").agg(F.count(F.lit(1)).alias("records"), kind)
