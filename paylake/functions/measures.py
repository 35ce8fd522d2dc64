"""Measure lists, one per kind of fact.

A list does not know its grain: the same refund measures serve the payment,
merchant and day tables. ``rollup`` applies a list to a grouping key.

Counts are distinct counts of the fact's id, sums are over all rows. Where each
id is known to occur once (the current-state tables guarantee it), pass
``ids_unique=True``: the plain count gives the same number, and the aggregation
then needs no shuffle of (key, id) pairs, only of map-side combined rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.specs import ATTEMPT_FAILED, ATTEMPT_SUCCESS, CAPTURED

Measures = Callable[[bool], list[Column]]


def _ids(column: str, name: str, ids_unique: bool) -> Column:
    counted = F.count(column) if ids_unique else F.count_distinct(F.col(column))
    return counted.alias(name)


def _total(column: str, name: str) -> Column:
    return F.sum(F.coalesce(F.col(column), F.lit(0))).alias(name)


def _rows_where(condition: Column, name: str) -> Column:
    """Rows that meet the condition; a NULL condition does not count."""
    return F.sum(F.when(condition, 1).otherwise(0)).alias(name)


def attempts(ids_unique: bool = False) -> list[Column]:
    status = F.col("attempt_status")
    return [
        _ids("attempt_id", "attempt_count", ids_unique),
        _rows_where(status == ATTEMPT_FAILED, "failed_attempt_count"),
        _rows_where(status == ATTEMPT_SUCCESS, "successful_attempt_count"),
        F.max("attempt_number").alias("max_attempt_number"),
    ]


def lifecycle_events(ids_unique: bool = False) -> list[Column]:
    return [
        _ids("event_id", "event_count", ids_unique),
        _total("retry_count", "total_retry_count"),
        F.max("event_timestamp").alias("last_event_timestamp"),
    ]


def refunds(ids_unique: bool = False) -> list[Column]:
    return [
        _ids("refund_id", "refund_count", ids_unique),
        _total("refund_amount", "total_refund_amount"),
    ]


def chargebacks(ids_unique: bool = False) -> list[Column]:
    return [
        _ids("chargeback_id", "chargeback_count", ids_unique),
        _total("amount", "total_chargeback_amount"),
    ]


def settlements(ids_unique: bool = False) -> list[Column]:
    return [
        _ids("settlement_id", "settlement_count", ids_unique),
        _total("settlement_amount", "total_settlement_amount"),
    ]


def _payment_volume(ids_unique: bool) -> list[Column]:
    return [
        _ids("payment_id", "payment_count", ids_unique),
        _total("amount", "total_payment_amount"),
    ]


def _captured_amount(name: str) -> Column:
    """Sum of captured amounts; NULL if every row is captured without an amount."""
    captured = F.col("payment_status") == CAPTURED
    return F.sum(F.when(captured, F.col("amount")).otherwise(0)).alias(name)


def merchant_payments(ids_unique: bool = False) -> list[Column]:
    status = F.col("payment_status")
    return [
        *_payment_volume(ids_unique),
        _rows_where(status == CAPTURED, "successful_payment_count"),
        _rows_where(status != CAPTURED, "non_successful_payment_count"),
        _captured_amount("successful_payment_amount"),
        F.avg("processing_time_ms").alias("avg_processing_time_ms"),
        F.max("completed_at").alias("last_payment_completed_at"),
    ]


def gateway_payments(ids_unique: bool = False) -> list[Column]:
    status = F.col("payment_status")
    return [
        *_payment_volume(ids_unique),
        _rows_where(status == CAPTURED, "successful_payment_count"),
        _rows_where(status != CAPTURED, "failed_or_other_payment_count"),
        F.avg("processing_time_ms").alias("avg_processing_time_ms"),
    ]


def daily_payments(ids_unique: bool = False) -> list[Column]:
    return [
        *_payment_volume(ids_unique),
        _captured_amount("captured_payment_amount"),
        _rows_where(F.col("payment_status") == CAPTURED, "captured_payment_count"),
    ]


def rollup(
    facts: DataFrame,
    by: str | Column | Sequence[str | Column],
    measures: Measures,
    ids_unique: bool = False,
) -> DataFrame:
    """One row per value of ``by`` with the measures.

    Spark combines map-side, and counts distinct ids by first grouping on
    (by, id), so one hot value of ``by`` does not land in one task.
    """
    keys = list(by) if isinstance(by, (list, tuple)) else [by]
    return facts.groupBy(*keys).agg(*measures(ids_unique))
