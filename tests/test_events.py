import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from paylake.functions.scalars import bad_timestamps, transform_event, transform_static
from paylake.operators import quality
from paylake.sources import events
from paylake.specs import (
    BRONZE_SCHEMA, ENTITIES, entity_for_topic, topic_to_key_columns, topic_to_table_name,
)

NOW = dt.datetime(2024, 1, 1, 12)


def log(spark, *records):
    """Records (topic, partition, offset, payload or raw text)."""
    made = []
    for topic, partition, offset, payload in records:
        text = payload
        if isinstance(payload, dict):
            text = json.dumps({"timestamp": "2024-01-01T10:00:00+00:00", "payload": payload})
        made.append((topic, partition, offset, NOW, text))
    return spark.createDataFrame(made, BRONZE_SCHEMA)


def payment(**fields):
    base = dict(payment_id="p", merchant_id="m", customer_id="c", gateway_id="g",
                payment_method_id="pm", amount=5)
    return {**base, **fields}


def test_registry():
    assert topic_to_table_name("refund-events") == "refunds"
    assert topic_to_key_columns("payment-events") == ["payment_id"]
    with pytest.raises(ValueError):
        topic_to_table_name("other")
    with pytest.raises(ValueError):
        entity_for_topic("other")
    assert len(ENTITIES) == 7
    assert entity_for_topic("merchant-events").envelope_schema["payload"].dataType.fieldNames()


def test_unknown_topic(spark):
    with pytest.raises(ValueError):
        events.parse_event(log(spark), "other")


def test_parse_flatten_and_type(spark):
    raw = log(spark, ("payment-events", 1, 7, payment(
        initiated_at="2024-01-02T03:04:05.678901+00:00", completed_at="2024-01-02 04:00:00",
        processing_time_ms=12, unknown="dropped")), ("refund-events", 0, 1, {}))
    row = events.read_entity(raw, "payment-events").collect()
    assert len(row) == 1
    row = row[0]
    assert row["event_timestamp"] == dt.datetime(2024, 1, 1, 10)
    assert row["initiated_at"] == dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    assert row["completed_at"] == dt.datetime(2024, 1, 2, 4)
    assert (row["topic"], row["partition"], row["offset"]) == ("payment-events", 1, 7)
    assert row["amount"] == 5 and row["processing_time_ms"] == 12
    assert "unknown" not in row.asDict()
    wanted = entity_for_topic("payment-events").state_schema
    assert events.read_entity(raw, "payment-events").schema.simpleString() == wanted.simpleString()


@pytest.mark.parametrize(
    "value,strict,tolerant",
    [(123, 123, 123), (123.0, None, 123), ("77", None, 77), (12.7, None, None),
     ("x", None, None), (None, None, None), (9007199254740993, 9007199254740993, 9007199254740993)],
)
def test_numbers(spark, value, strict, tolerant):
    raw = log(spark, ("payment-events", 0, 0, payment(amount=value)))
    assert events.read_entity(raw, "payment-events").first()["amount"] == strict
    assert events.read_entity(raw, "payment-events", "tolerant").first()["amount"] == tolerant
    spec = entity_for_topic("payment-events")
    for mode, wanted in (("strict", strict), ("tolerant", tolerant)):
        parsed = events.parse_all(raw, ENTITIES, mode)
        row = events.entity_rows(parsed, spec, mode).first()
        assert row["amount"] == wanted and row["payment_id"] == "p"


def test_unknown_number_mode(spark):
    with pytest.raises(ValueError):
        events.parse_event(log(spark), "payment-events", "loose")


def test_parse_all_equals_parse_per_topic(spark):
    raw = log(
        spark, ("payment-events", 0, 0, payment()), ("payment-events", 0, 1, "garbage"),
        ("refund-events", 0, 2, {"refund_id": "r", "refund_amount": 4}),
        ("merchant-events", 0, 3, {"merchant_id": "m", "phone": 919999}),
        ("unknown", 0, 4, {"a": 1}), ("payment-events", 0, 5, None),
    )
    parsed = events.parse_all(raw)
    assert parsed.count() == 5
    for spec in ENTITIES:
        one = events.read_entity(raw, spec.topic)
        many = events.entity_rows(parsed, spec)
        assert one.schema.simpleString() == many.schema.simpleString()
        assert sorted(map(repr, one.collect())) == sorted(map(repr, many.collect()))


def test_report_and_row_errors(spark):
    raw = log(
        spark, ("payment-events", 0, 0, payment()), ("payment-events", 0, 0, payment()),
        ("payment-events", 0, 1, "garbage"), ("payment-events", 0, 2, '{"timestamp":"t"}'),
        ("payment-events", 0, 3, None), ("payment-events", 0, 4, payment(amount=-1)),
        ("payment-events", 0, 5, payment(amount=0)),
        ("refund-events", 0, 0, {"refund_id": "r", "payment_id": "p", "merchant_id": None}),
    )
    parsed = events.parse_all(raw)
    report = {r["topic"]: r.asDict() for r in quality.event_report(parsed, ENTITIES).collect()}
    pay = report["payment-events"]
    assert pay["record_count"] == 7 and pay["duplicate_records"] == 1
    assert pay["malformed"] == 3 and pay["null_payment_id"] == 3 and pay["null_gateway_id"] == 3
    assert pay["repeated_keys"] == 3  # four records have the key "p"
    assert pay["negative_amount"] == 1 and pay["null_refund_id"] == 0
    assert report["refund-events"]["null_merchant_id"] == 1
    assert report["refund-events"]["malformed"] == 0
    spec = entity_for_topic("payment-events")
    judged = parsed.where("topic = 'payment-events'").select("offset", quality.row_errors(spec))
    errors = {r[0]: r[1] for r in judged.collect()}
    assert errors[0] == [] and errors[5] == [] and errors[4] == ["negative:amount"]
    assert errors[1][0] == "malformed" and "missing:payment_id" in errors[1]
    assert errors[3][0] == "malformed"
    with pytest.raises(quality.QualityError):
        quality.refuse_batch(pay)
    with pytest.raises(quality.QualityError):
        quality.refuse_batch(report["refund-events"])


def test_bad_timestamps_become_null(spark):
    df = spark.createDataFrame(
        [("notadate", "2024-02-30", "x"), ("2024-01-01", "2024-01-02T00:00:00Z", "y")],
        "created_at string, due_date string, other string",
    )
    typed = transform_event(df)
    assert dict(typed.dtypes) == {
        "created_at": "timestamp", "due_date": "timestamp", "other": "string"
    }
    assert {r["created_at"] for r in typed.collect()} == {None, dt.datetime(2024, 1, 1)}
    assert bad_timestamps(df).first().asDict() == {"bad_created_at": 1, "bad_due_date": 1}
    with pytest.raises(ValueError):
        bad_timestamps(df.select("other"))


def test_static_typing_leaves_due_date(spark):
    df = spark.createDataFrame([("2024-01-01", "2024-01-01")], "created_at string, due_date string")
    assert dict(transform_static(df).dtypes) == {"created_at": "timestamp", "due_date": "string"}


def test_envelope_keeps_nulls_and_routes_tables(spark):
    df = spark.createDataFrame([("r1", None)], "refund_id string, refund_amount bigint")
    args = (F.lit("2024-01-01T00:00:00+00:00"), F.lit(0), F.lit(1), F.current_timestamp())
    sent = events.table_to_events(df, "refunds", *args).first()
    assert sent["topic"] == "refund-events"
    assert json.loads(sent["raw_payload"]) == {
        "timestamp": "2024-01-01T00:00:00+00:00",
        "payload": {"refund_id": "r1", "refund_amount": None},
    }
    assert events.table_to_events(df, "payment_gateways", *args) is None


def test_prepare_bronze(spark):
    records = spark.createDataFrame(
        [("t", 1, 2, NOW, bytearray(b"{}"))],
        "topic string, partition int, offset bigint, timestamp timestamp, value binary",
    )
    assert events.prepare_bronze(records).first() == ("t", 1, 2, NOW, "{}")
