"""The four metric tables, each with a declared grain.

Facts are aggregated to the grain before they are joined, so a join never
multiplies rows. Joins carry no hints: Spark broadcasts a side only if its
measured size is below ``spark.sql.autoBroadcastJoinThreshold``, otherwise it
shuffles, and adaptive execution splits skewed partitions.

``ids_unique=True`` states that every input holds one row per business key, as
the current-state tables do; see ``paylake.functions.measures``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.functions import measures as M
from paylake.functions.scalars import operation_date, or_zero

# The columns that the metric tables take from their inputs.
PAYMENT_COLUMNS = (
    "payment_id", "merchant_id", "customer_id", "invoice_id", "gateway_id",
    "payment_method_id", "amount", "currency", "payment_status", "payment_reference",
    "initiated_at", "completed_at", "processing_time_ms",
)
MERCHANT_COLUMNS = (
    "merchant_id", "merchant_name", "business_type", "country", "city", "industry",
    "risk_level", "settlement_cycle", "verification_status",
)
GATEWAY_COLUMNS = ("gateway_id", "gateway_name", "provider", "gateway_type", "status")

REVERSAL_COUNTS = (
    "refund_count", "total_refund_amount", "chargeback_count", "total_chargeback_amount",
    "settlement_count", "total_settlement_amount",
)


def payment_day() -> Column:
    return operation_date("completed_at", "initiated_at")


def refund_day() -> Column:
    return operation_date("completed_at", "requested_at")


def chargeback_day() -> Column:
    return operation_date("created_at")


def settlement_day() -> Column:
    return operation_date("completed_at", "initiated_at")


def _left_join_all(parent: DataFrame, key: str, children: list[DataFrame]) -> DataFrame:
    return reduce(lambda left, child: left.join(child, key, "left"), children, parent)


def payment_performance(
    payments: DataFrame,
    merchants: DataFrame,
    gateways: DataFrame,
    payment_methods: DataFrame,
    attempts: DataFrame,
    events: DataFrame,
    refunds: DataFrame,
    chargebacks: DataFrame,
    settlements: DataFrame,
    ids_unique: bool = False,
    children_first: bool = False,
) -> DataFrame:
    """One row per payment, 34 columns.

    Narrow dimensions come first: while a large dimension forces a shuffle of the
    payments, the rows do not carry the child measures yet. ``children_first`` is for payments and
    facts in tables bucketed by the payment: their joins need no shuffle as long as none comes before.
    """
    children = [
        M.rollup(attempts, "payment_id", M.attempts, ids_unique),
        M.rollup(events, "payment_id", M.lifecycle_events, ids_unique),
        M.rollup(refunds, "payment_id", M.refunds, ids_unique),
        M.rollup(chargebacks, "payment_id", M.chargebacks, ids_unique),
        M.rollup(settlements, "payment_id", M.settlements, ids_unique),
    ]
    start = payments.select(*PAYMENT_COLUMNS)
    if children_first:
        start = _left_join_all(start, "payment_id", children)
        children = []
    described = (
        start.join(
            merchants.select("merchant_id", "merchant_name", "industry", "risk_level"),
            "merchant_id",
            "left",
        )
        .join(
            gateways.select("gateway_id", "gateway_name", "provider", "gateway_type"),
            "gateway_id",
            "left",
        )
        .join(
            payment_methods.select("payment_method_id", "payment_method_name", "category"),
            "payment_method_id",
            "left",
        )
    )
    return _left_join_all(described, "payment_id", children).select(
        *PAYMENT_COLUMNS,
        "merchant_name", "industry", "risk_level",
        "gateway_name", "provider", "gateway_type",
        "payment_method_name", "category",
        or_zero("attempt_count"),
        or_zero("failed_attempt_count"),
        or_zero("successful_attempt_count"),
        or_zero("max_attempt_number"),
        or_zero("event_count"),
        or_zero("total_retry_count"),
        "last_event_timestamp",
        *[or_zero(c) for c in REVERSAL_COUNTS],
    )


def merchant_performance(
    merchants: DataFrame,
    payments: DataFrame,
    refunds: DataFrame,
    chargebacks: DataFrame,
    settlements: DataFrame,
    ids_unique: bool = False,
) -> DataFrame:
    """One row per merchant, 22 columns."""
    children = [
        M.rollup(payments, "merchant_id", M.merchant_payments, ids_unique),
        M.rollup(refunds, "merchant_id", M.refunds, ids_unique),
        M.rollup(chargebacks, "merchant_id", M.chargebacks, ids_unique),
        M.rollup(settlements, "merchant_id", M.settlements, ids_unique),
    ]
    return _left_join_all(merchants.select(*MERCHANT_COLUMNS), "merchant_id", children).select(
        *MERCHANT_COLUMNS,
        or_zero("payment_count"),
        or_zero("total_payment_amount"),
        or_zero("successful_payment_count"),
        or_zero("non_successful_payment_count"),
        or_zero("successful_payment_amount"),
        or_zero("avg_processing_time_ms"),
        *[or_zero(c) for c in REVERSAL_COUNTS],
        "last_payment_completed_at",
    )


def gateway_performance(
    gateways: DataFrame,
    payments: DataFrame,
    attempts: DataFrame,
    ids_unique: bool = False,
) -> DataFrame:
    """One row per gateway, 14 columns. Lifecycle events carry no gateway."""
    children = [
        M.rollup(payments, "gateway_id", M.gateway_payments, ids_unique),
        M.rollup(attempts, "gateway_id", M.attempts, ids_unique),
    ]
    return _left_join_all(gateways.select(*GATEWAY_COLUMNS), "gateway_id", children).select(
        *GATEWAY_COLUMNS,
        or_zero("payment_count"),
        or_zero("total_payment_amount"),
        or_zero("successful_payment_count"),
        or_zero("failed_or_other_payment_count"),
        or_zero("avg_processing_time_ms"),
        or_zero("attempt_count"),
        or_zero("failed_attempt_count"),
        or_zero("successful_attempt_count"),
        or_zero("max_attempt_number"),
    )


def payments_by_day(payments: DataFrame, ids_unique: bool = False) -> DataFrame:
    return M.rollup(
        payments, payment_day().alias("operation_date"), M.daily_payments, ids_unique
    )


def refunds_by_day(refunds: DataFrame, ids_unique: bool = False) -> DataFrame:
    return M.rollup(refunds, refund_day().alias("operation_date"), M.refunds, ids_unique)


def chargebacks_by_day(chargebacks: DataFrame, ids_unique: bool = False) -> DataFrame:
    return M.rollup(
        chargebacks, chargeback_day().alias("operation_date"), M.chargebacks, ids_unique
    )


def settlements_by_day(settlements: DataFrame, ids_unique: bool = False) -> DataFrame:
    return M.rollup(
        settlements, settlement_day().alias("operation_date"), M.settlements, ids_unique
    )


def financial_operations(
    payments: DataFrame,
    refunds: DataFrame,
    chargebacks: DataFrame,
    settlements: DataFrame,
    ids_unique: bool = False,
    one_null_date: bool = False,
) -> DataFrame:
    """One row per day, 12 columns.

    The result is that of full outer joins of the four daily aggregates on the
    date. Each has one row per date, so stacking them and grouping once more
    does the same with one small shuffle instead of one per join. An equi-join
    never matches NULL dates: each fact keeps its own NULL-date row. With
    ``one_null_date=True`` they are merged into one.
    """
    daily = [
        payments_by_day(payments, ids_unique),
        refunds_by_day(refunds, ids_unique),
        chargebacks_by_day(chargebacks, ids_unique),
        settlements_by_day(settlements, ids_unique),
    ]
    names = [c for day in daily for c in day.columns if c != "operation_date"]
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [day.withColumn("_fact", F.lit(i)) for i, day in enumerate(daily)],
    )
    keys = [F.col("operation_date")]
    if not one_null_date:
        keys.append(F.when(F.col("operation_date").isNull(), F.col("_fact")).alias("_apart"))
    joined = stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in names])
    return joined.select("operation_date", *[or_zero(c) for c in names]).withColumn(
        "net_payment_amount",
        F.col("captured_payment_amount")
        - F.col("total_refund_amount")
        - F.col("total_chargeback_amount"),
    )
