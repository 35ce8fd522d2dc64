"""Affected keys of a batch, and rebuilds of the metric tables for them only.

For any key set K an incremental rebuild gives the rows of the full build whose
key is in K. A rebuild may use the key set once per input: persist it first. A
persisted and counted set also has an exact size, by which Spark decides whether
to broadcast it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.operators.keys import bit_set, distinct_keys, restrict, restrict_by
from paylake.plans import gold
from paylake.sources import monthly
from paylake.specs import ENTITIES, PAYMENT_TOPICS

# Timestamps that may set the day of a payment, refund, chargeback or settlement.
DAY_SOURCES = {
    "payment-events": ("completed_at", "initiated_at"),
    "refund-events": ("completed_at", "requested_at"),
    "chargeback-events": ("created_at",),
    "settlement-events": ("completed_at", "initiated_at"),
}
KEY_COLUMNS = ("payment_id", "merchant_id", "gateway_id")
ENTITY_IDS = {
    e.topic: e.keys[0] for e in ENTITIES if e.topic in (*PAYMENT_TOPICS, "merchant-events")
}
_TIMES = ("completed_at", "initiated_at", "requested_at", "created_at")


def candidate_days(topic: str, day_of: Callable[[str], Column]) -> Column:
    """Days of all timestamps that may set the grain of a row of the topic."""
    days = F.array(*[day_of(c) for c in DAY_SOURCES.get(topic, ())])
    return F.array_compact(days.cast("array<date>"))


def touched_rows(bronze: DataFrame, topics: Sequence[str] = PAYMENT_TOPICS) -> DataFrame:
    """Per raw record of the topics: its id, payment, merchant, gateway and candidate days.

    One pass, and the JSON is read for these few fields only. ``operation_dates``
    holds the day of every timestamp that may set the grain, so that a record
    whose later timestamp has just been filled in also names the day it leaves.
    """
    names = dict.fromkeys([*KEY_COLUMNS, *_TIMES, *ENTITY_IDS.values()])
    fields = T.StructType([T.StructField(n, T.StringType()) for n in names])
    schema = T.StructType([T.StructField("payload", fields)])
    parsed = (
        bronze.where(F.col("topic").isin(*topics))
        .select("topic", F.from_json("raw_payload", schema).alias("event"))
        .select("topic", "event.payload.*")
    )
    entity_id, days = F.lit(None).cast("string"), candidate_days("", F.col)
    for topic in topics:
        here = F.col("topic") == topic
        entity_id = F.when(here, F.col(ENTITY_IDS[topic])).otherwise(entity_id)
        own_days = candidate_days(topic, lambda c: F.to_date(F.try_to_timestamp(F.col(c))))
        days = F.when(here, own_days).otherwise(days)
    return parsed.select(
        "topic", entity_id.alias("entity_id"), *KEY_COLUMNS, days.alias("operation_dates")
    )


def affected_payments(touched: DataFrame) -> DataFrame:
    return distinct_keys(touched, "payment_id")


def affected_merchants(touched: DataFrame) -> DataFrame:
    return distinct_keys(touched, "merchant_id")


def affected_gateways(touched: DataFrame) -> DataFrame:
    return distinct_keys(touched, "gateway_id")


def affected_days(touched: DataFrame) -> DataFrame:
    days = touched.select(F.explode_outer("operation_dates").alias("operation_date"))
    return distinct_keys(days, "operation_date")


def payments_of(payments: DataFrame, dimension_keys: DataFrame, on: str) -> DataFrame:
    """Payments that refer to a changed dimension row, as a key set.

    The dimension keys may repeat: a semi-join needs no distinct ones, and without an
    aggregate between shuffle and join a hot key can be split.
    """
    named = dimension_keys.select(on)
    return distinct_keys(restrict(payments.select("payment_id", on), named, on), "payment_id")


def rebuild(
    table: str, keys: DataFrame, *inputs: DataFrame, prefilter: bool = False, most: bool = False, **options
) -> DataFrame:
    """The rows of a metric table whose key is in ``keys``.

    ``inputs`` and ``options`` are those of the builder of the same name in ``gold``.

    Payments: facts are reduced to the keys first; a payment has few rows of each. For a key set beyond what Spark
    broadcasts, ``prefilter`` drops most other facts by a bit set of the keys before the shuffle; only the payments
    are then joined with the keys. With ``most``, for a set of nearly all keys, the facts are not reduced at all.
    Days: few and hot, so a shuffle on them would gather whole days in one task. The type
    bounds the set at 3.7 million four-byte values, so it always fits a broadcast, and the
    facts are filtered where they are read. Facts that are laid out by month are read from the months of the
    days alone.
    Merchants and gateways: one may hold a third of all facts, so the facts are rolled up,
    combined before the shuffle, and the rows of the result are reduced. Spark moves
    the semi-join below the roll-up only if the key set is small enough to broadcast. A batch
    touches nearly all gateways, so there the reduction saves little.
    """
    build = getattr(gold, table)
    if table == "payment_performance":
        on = "payment_id"
        # The three dimension tables behind the payments have no payment id.
        # The builder joins the facts to the payments, so it drops those of other keys.
        if most:
            return build(restrict(inputs[0], keys, on), *inputs[1:], **options)
        if not prefilter:
            return build(*[restrict(i, keys, on) if on in i.columns else i for i in inputs], **options)
        bits = bit_set(keys, on)
        payments, *others = [bits.maybe(i, on) if on in i.columns else i for i in inputs]
        return build(restrict(payments, keys, on), *others, **options)
    if table == "financial_operations":
        on = "operation_date"
        days = F.broadcast(distinct_keys(keys, on))
        grains = (gold.payment_day(), gold.refund_day(), gold.chargeback_day(), gold.settlement_day())
        inputs = [
            monthly.of_days(i, keys, g, on) if monthly.MONTH in i.columns else restrict_by(i, days, g, on)
            for i, g in zip(inputs, grains, strict=True)
        ]
        return build(*inputs, **options)
    on = "merchant_id" if table == "merchant_performance" else "gateway_id"
    return restrict(build(*inputs, **options), keys.select(on), on)
