"""What is known about each entity, in one registry.

An entity that arrives as events has a topic and a payload; a static entity
arrives as a CSV file. Both have a table name and a business key.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

from pyspark.sql import types as T

TRANSPORT = ("topic", "partition", "offset", "kafka_timestamp")
ARRIVAL_ORDER = ("kafka_timestamp", "partition", "offset")

BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("raw_payload", T.StringType()),
    ]
)

# The statuses that the metrics look for.
CAPTURED = "Captured"
ATTEMPT_FAILED = "Failed"
ATTEMPT_SUCCESS = "Success"

# Fields that hold points in time, for events and for static data.
EVENT_TIMESTAMPS = (
    "event_timestamp", "kafka_timestamp", "created_at", "updated_at", "initiated_at",
    "completed_at", "requested_at", "resolved_at", "paid_at", "due_date", "onboarding_date",
)
STATIC_TIMESTAMPS = (
    "created_at", "updated_at", "initiated_at", "completed_at",
    "requested_at", "resolved_at", "onboarding_date",
)


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampType(),
}


@cache
def flat_schema(columns: str) -> T.StructType:
    """Schema of ``"name type, name type, ..."``; needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class EntitySpec:
    """One entity fed by a topic. ``payload`` lists names and types."""

    topic: str
    table: str
    keys: tuple[str, ...]
    payload: str
    required: tuple[str, ...] = ()
    money: tuple[str, ...] = ()

    @property
    def payload_schema(self) -> T.StructType:
        return flat_schema(self.payload)

    @property
    def envelope_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField("timestamp", T.StringType()),
                T.StructField("payload", self.payload_schema),
            ]
        )

    @property
    def state_schema(self) -> T.StructType:
        """Columns of the current-state table: transport, event time, typed payload."""
        fields = [f for f in BRONZE_SCHEMA.fields if f.name in TRANSPORT]
        fields.append(T.StructField("event_timestamp", T.TimestampType()))
        for f in self.payload_schema.fields:
            kind = T.TimestampType() if f.name in EVENT_TIMESTAMPS else f.dataType
            fields.append(T.StructField(f.name, kind))
        return T.StructType(fields)


@dataclass(frozen=True)
class StaticSpec:
    """One entity fed by a CSV file. ``columns`` lists names and types."""

    table: str
    keys: tuple[str, ...]
    columns: str

    @property
    def schema(self) -> T.StructType:
        return flat_schema(self.columns)


# Topics, tables, keys, payload fields, required and money columns.
ENTITIES: tuple[EntitySpec, ...] = (
    EntitySpec(
        "merchant-events", "merchants", ("merchant_id",),
        "business_type string, city string, country string, created_at string, email string, "
        "industry string, merchant_id string, merchant_name string, onboarding_date string, "
        "phone bigint, risk_level string, settlement_cycle string, state string, "
        "updated_at string, verification_status string",
        required=("merchant_id",),
    ),
    EntitySpec(
        "customer-events", "customers", ("customer_id",),
        "city string, country string, created_at string, customer_id string, "
        "customer_name string, email string, phone bigint",
        required=("customer_id",),
    ),
    EntitySpec(
        "invoice-events", "invoices", ("invoice_id",),
        "created_at string, currency string, customer_id string, due_date string, "
        "invoice_amount bigint, invoice_id string, invoice_number string, "
        "invoice_status string, merchant_id string, paid_at string",
        required=("customer_id", "invoice_id", "merchant_id"),
        money=("invoice_amount",),
    ),
    EntitySpec(
        "payment-events", "payments", ("payment_id",),
        "amount bigint, completed_at string, currency string, customer_id string, "
        "gateway_id string, initiated_at string, invoice_id string, merchant_id string, "
        "payment_id string, payment_method_id string, payment_reference string, "
        "payment_status string, processing_time_ms bigint",
        required=("payment_id", "merchant_id", "customer_id", "gateway_id", "payment_method_id"),
        money=("amount",),
    ),
    EntitySpec(
        "refund-events", "refunds", ("refund_id",),
        "completed_at string, merchant_id string, payment_id string, refund_amount bigint, "
        "refund_id string, refund_reason string, refund_status string, requested_at string",
        required=("refund_id", "merchant_id", "payment_id"),
        money=("refund_amount",),
    ),
    EntitySpec(
        "chargeback-events", "chargebacks", ("chargeback_id",),
        "amount bigint, chargeback_id string, chargeback_reason string, created_at string, "
        "merchant_id string, payment_id string, resolved_at string, status string",
        required=("chargeback_id", "merchant_id", "payment_id"),
        money=("amount",),
    ),
    EntitySpec(
        "settlement-events", "settlements", ("settlement_id",),
        "account_id string, bank_reference string, completed_at string, initiated_at string, "
        "merchant_id string, payment_id string, settlement_amount bigint, "
        "settlement_id string, settlement_status string",
        required=("settlement_id", "account_id", "merchant_id", "payment_id"),
        money=("settlement_amount",),
    ),
)

# Static datasets, their keys and columns.
STATIC: tuple[StaticSpec, ...] = (
    StaticSpec(
        "merchant_bank_accounts", ("account_id",),
        "account_id string, merchant_id string, bank_name string, account_number bigint, "
        "ifsc_code string, account_type string, account_status string, created_at timestamp",
    ),
    StaticSpec(
        "payment_methods", ("payment_method_id",),
        "payment_method_id string, payment_method_name string, category string, "
        "provider string, status string",
    ),
    StaticSpec(
        "payment_gateways", ("gateway_id",),
        "gateway_id string, gateway_name string, provider string, gateway_type string, "
        "status string",
    ),
    StaticSpec(
        "payment_attempts", ("attempt_id",),
        "attempt_id string, payment_id string, gateway_id string, attempt_status string, "
        "attempt_number int",
    ),
    StaticSpec(
        "payment_events", ("event_id",),
        "event_id string, payment_id string, retry_count int, event_timestamp timestamp",
    ),
)

PAYMENT_TOPICS = ("payment-events", "refund-events", "chargeback-events", "settlement-events")

_BY_TOPIC = {e.topic: e for e in ENTITIES}
_BY_TABLE = {e.table: e for e in ENTITIES}
_STATIC_BY_TABLE = {s.table: s for s in STATIC}


def entity_for_topic(topic: str) -> EntitySpec:
    if topic not in _BY_TOPIC:
        raise ValueError(f"unknown topic {topic!r}; known: {sorted(_BY_TOPIC)}")
    return _BY_TOPIC[topic]


def entity_for_table(table: str) -> EntitySpec:
    if table not in _BY_TABLE:
        raise ValueError(f"unknown entity table {table!r}; known: {sorted(_BY_TABLE)}")
    return _BY_TABLE[table]


def static_for_table(table: str) -> StaticSpec:
    if table not in _STATIC_BY_TABLE:
        raise ValueError(f"unknown static table {table!r}; known: {sorted(_STATIC_BY_TABLE)}")
    return _STATIC_BY_TABLE[table]


def topic_to_table_name(topic: str) -> str:
    return entity_for_topic(topic).table


def topic_to_key_columns(topic: str) -> list[str]:
    return list(entity_for_topic(topic).keys)
