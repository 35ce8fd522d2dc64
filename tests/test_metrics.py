"""Hand-made rows for the rules that generated data does not reach."""

import datetime as dt
import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from paylake.functions import measures as M
from paylake.plans import gold, incremental, reports

PAYMENT = (
    "payment_id string, merchant_id string, customer_id string, invoice_id string, "
    "gateway_id string, payment_method_id string, amount bigint, currency string, "
    "payment_status string, payment_reference string, initiated_at timestamp, "
    "completed_at timestamp, processing_time_ms bigint"
)
REFUND = (
    "refund_id string, payment_id string, merchant_id string, refund_amount bigint, "
    "requested_at timestamp, completed_at timestamp"
)
CHARGEBACK = (
    "chargeback_id string, payment_id string, merchant_id string, amount bigint, "
    "created_at timestamp"
)
SETTLEMENT = (
    "settlement_id string, payment_id string, merchant_id string, settlement_amount bigint, "
    "initiated_at timestamp, completed_at timestamp"
)
ATTEMPT = (
    "attempt_id string, payment_id string, gateway_id string, attempt_status string, "
    "attempt_number int"
)
EVENT = "event_id string, payment_id string, retry_count int, event_timestamp timestamp"
MERCHANT = ", ".join(f"{c} string" for c in gold.MERCHANT_COLUMNS)
GATEWAY = ", ".join(f"{c} string" for c in gold.GATEWAY_COLUMNS)
METHOD = "payment_method_id string, payment_method_name string, category string"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour) if day else None


def payment(pid, status, amount, merchant="m1", gateway="g1", day=1, done=None, ms=None):
    return (pid, merchant, "c", "i", gateway, "pm", amount, "INR", status, "ref", at(day),
            at(done), ms)


class Tables:
    def __init__(self, spark, payments=(), refunds=(), chargebacks=(), settlements=(),
                 attempts=(), events=(), merchants=("m1",), gateways=("g1",)):
        make = spark.createDataFrame
        self.payments = make(list(payments), PAYMENT)
        self.refunds = make(list(refunds), REFUND)
        self.chargebacks = make(list(chargebacks), CHARGEBACK)
        self.settlements = make(list(settlements), SETTLEMENT)
        self.attempts = make(list(attempts), ATTEMPT)
        self.events = make(list(events), EVENT)
        self.merchants = make(
            [(m, f"name {m}", *["x"] * 7) for m in merchants], MERCHANT
        )
        self.gateways = make([(g, f"name {g}", "p", "t", "s") for g in gateways], GATEWAY)
        self.methods = make([("pm", "UPI", "Digital")], METHOD)

    def payment_inputs(self):
        return (self.payments, self.merchants, self.gateways, self.methods, self.attempts,
                self.events, self.refunds, self.chargebacks, self.settlements)

    def merchant_inputs(self):
        return (self.merchants, self.payments, self.refunds, self.chargebacks, self.settlements)

    def gateway_inputs(self):
        return (self.gateways, self.payments, self.attempts)

    def day_inputs(self):
        return (self.payments, self.refunds, self.chargebacks, self.settlements)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_null_status_is_neither_success_nor_failure(spark):
    t = Tables(spark, [payment("p1", None, 5), payment("p2", "Captured", 7),
                       payment("p3", "Failed", 9)])
    row = gold.merchant_performance(*t.merchant_inputs()).first()
    assert row["payment_count"] == 3 and row["total_payment_amount"] == 21
    assert row["successful_payment_count"] == 1
    assert row["non_successful_payment_count"] == 1


def test_captured_without_amount(spark):
    t = Tables(spark, [payment("p1", "Captured", None)])
    row = gold.merchant_performance(*t.merchant_inputs()).first()
    assert (row["successful_payment_count"], row["successful_payment_amount"]) == (1, 0)
    raw = M.rollup(t.payments, "merchant_id", M.merchant_payments).first()
    assert raw["successful_payment_amount"] is None
    day = gold.financial_operations(*t.day_inputs()).first()
    assert (day["captured_payment_count"], day["captured_payment_amount"]) == (1, 0)


def test_counts_are_distinct_and_sums_are_not(spark):
    refund = ("r1", "p1", "m1", 10, at(1), None)
    t = Tables(spark, [payment("p1", "Captured", 50)], refunds=[refund, refund])
    row = gold.payment_performance(*t.payment_inputs()).first()
    assert (row["refund_count"], row["total_refund_amount"]) == (1, 20)


def test_defaults_without_children(spark):
    t = Tables(spark, [payment("p1", "Captured", 50, merchant="unknown")])
    row = gold.payment_performance(*t.payment_inputs()).first()
    assert len(row) == 34
    assert row["merchant_name"] is None and row["last_event_timestamp"] is None
    assert row["attempt_count"] == 0 and row["max_attempt_number"] == 0
    merchant = gold.merchant_performance(*t.merchant_inputs()).first()
    assert len(merchant) == 22
    assert merchant["avg_processing_time_ms"] == 0.0
    assert merchant["last_payment_completed_at"] is None
    assert len(gold.gateway_performance(*t.gateway_inputs()).first()) == 14


def test_child_without_parent(spark):
    t = Tables(spark, refunds=[("r1", "gone", "m1", 10, at(3), None)])
    assert gold.payment_performance(*t.payment_inputs()).count() == 0
    assert gold.merchant_performance(*t.merchant_inputs()).first()["refund_count"] == 1
    assert rows(gold.refunds_by_day(t.refunds)) == [(dt.date(2024, 1, 3), 1, 10)]


def test_repeated_dimension_key_repeats_the_payment(spark):
    t = Tables(spark, [payment("p1", "Captured", 5)], merchants=("m1", "m1"))
    assert gold.payment_performance(*t.payment_inputs()).count() == 2


def test_null_dates(spark):
    t = Tables(spark, [payment("p1", "Captured", 5, day=None)],
               refunds=[("r1", "p1", "m1", 2, None, None)],
               chargebacks=[("c1", "p1", "m1", 1, at(4))])
    full = gold.financial_operations(*t.day_inputs())
    assert len(full.columns) == 12
    assert full.where("operation_date IS NULL").count() == 2
    merged = gold.financial_operations(*t.day_inputs(), one_null_date=True)
    row = merged.where("operation_date IS NULL").collect()
    assert len(row) == 1 and row[0]["net_payment_amount"] == 3
    days = spark.createDataFrame([(None,), (dt.date(2024, 1, 4),)], "operation_date date")
    part = incremental.rebuild("financial_operations", days, *t.day_inputs())
    assert [r["operation_date"] for r in part.collect()] == [dt.date(2024, 1, 4)]


def test_settlements_do_not_reduce_the_net_amount(spark):
    t = Tables(spark, [payment("p1", "Captured", 100)],
               settlements=[("s1", "p1", "m1", 60, at(1), None)])
    assert gold.financial_operations(*t.day_inputs()).first()["net_payment_amount"] == 100


def test_reports_on_empty_tables(spark):
    performance = gold.payment_performance(*Tables(spark).payment_inputs())
    assert reports.success_rate(performance).first()[0] is None
    assert reports.payment_counter(performance).first()[0] == 0
    assert reports.payment_total(performance).first()[0] is None
    assert reports.lifecycle_violations(performance).first()[0] == 0


def test_week_starts_on_monday(spark):
    t = Tables(spark, [payment("p1", "Captured", 1, day=7), payment("p2", "Captured", 2, day=8)])
    performance = gold.payment_performance(*t.payment_inputs())
    weeks = rows(reports.weekly_volume(performance))
    assert weeks == [(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 8), 2)]


def random_tables(spark, seed, unique):
    rng = random.Random(seed)

    def ids(prefix, n):
        return [f"{prefix}{i if unique else rng.randrange(n)}" for i in range(n)]

    def day():
        return rng.choice([None, *range(1, 8)])

    def pid():
        # One hot payment holds about a third of the children.
        return "p0" if rng.random() < 0.33 else f"p{rng.randrange(15)}"

    def merchant():
        return rng.choice(["m1", "m2", "m3", None])

    def money():
        return rng.choice([None, 0, 5, 9])

    return Tables(
        spark,
        payments=[payment(i, rng.choice(["Captured", "Failed", None]), money(), merchant(),
                          rng.choice(["g1", "g2", None]), day(), day(), money())
                  for i in ids("p", 15)],
        refunds=[(i, pid(), merchant(), money(), at(day()), at(day())) for i in ids("r", 30)],
        chargebacks=[(i, pid(), merchant(), money(), at(day())) for i in ids("c", 30)],
        settlements=[(i, pid(), merchant(), money(), at(day()), at(day()))
                     for i in ids("s", 30)],
        attempts=[(i, pid(), rng.choice(["g1", "g2"]), rng.choice(["Failed", "Success", None]),
                   rng.randrange(4)) for i in ids("a", 30)],
        events=[(i, pid(), money(), at(day())) for i in ids("e", 30)],
        merchants=("m1", "m2", "m3"),
        gateways=("g1", "g2"),
    )


@pytest.mark.parametrize("seed", range(2))
def test_incremental_equals_full_for_the_keys(spark, seed):
    t = random_tables(spark, seed, unique=False)
    cases = [
        ("payment_id", ["p0", "p3", "p7", None, "p3"], gold.payment_performance,
         partial(incremental.rebuild, "payment_performance"), t.payment_inputs()),
        ("merchant_id", ["m1", "m3"], gold.merchant_performance,
         partial(incremental.rebuild, "merchant_performance"), t.merchant_inputs()),
        ("gateway_id", ["g2"], gold.gateway_performance,
         partial(incremental.rebuild, "gateway_performance"), t.gateway_inputs()),
        ("operation_date", [dt.date(2024, 1, 2), dt.date(2024, 1, 5)],
         gold.financial_operations, partial(incremental.rebuild, "financial_operations"), t.day_inputs()),
    ]
    for key, values, full, part, inputs in cases:
        kind = "date" if key == "operation_date" else "string"
        keys = spark.createDataFrame([(v,) for v in values], f"{key} {kind}")
        wanted = full(*inputs).where(F.col(key).isin([v for v in values if v is not None]))
        assert rows(part(keys, *inputs)) == rows(wanted)


@pytest.mark.parametrize("seed", range(2))
def test_plain_counts_equal_distinct_counts_on_unique_ids(spark, seed):
    t = random_tables(spark, seed, unique=True)
    for full, inputs in [
        (gold.payment_performance, t.payment_inputs()),
        (gold.merchant_performance, t.merchant_inputs()),
        (gold.gateway_performance, t.gateway_inputs()),
        (gold.financial_operations, t.day_inputs()),
    ]:
        assert rows(full(*inputs)) == rows(full(*inputs, ids_unique=True))


def test_payments_of_changed_merchants(spark):
    t = Tables(spark, [payment("p1", "Captured", 1), payment("p2", "Captured", 1, merchant="m2")])
    changed = spark.createDataFrame([("m2",)], "merchant_id string")
    assert rows(incremental.payments_of(t.payments, changed, "merchant_id")) == [("p2",)]


def test_lifecycle_violations(spark):
    t = Tables(
        spark,
        [payment("p1", "Captured", 100), payment("p2", "Failed", 50),
         payment("p3", "Captured", 10)],
        refunds=[("r1", "p1", "m1", 30, at(1), None), ("r2", "p2", "m1", 1, at(1), None),
                 ("r3", "p3", "m1", 11, at(1), None)],
        chargebacks=[("c1", "p1", "m1", 20, at(1))],
        settlements=[("s1", "p1", "m1", 50, at(1), None), ("s3", "p3", "m1", 5, at(1), None)],
    )
    found = reports.lifecycle_violations(gold.payment_performance(*t.payment_inputs())).first()
    assert found.asDict() == {
        "children_without_capture": 1, "refund_over_amount": 1, "settlement_mismatch": 1,
    }
