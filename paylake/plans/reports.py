"""Reporting queries on the metric tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.functions.scalars import ratio, week_start
from paylake.specs import CAPTURED

# Measures of the payment dataset, usable with any grouping.


def row_count() -> Column:
    return F.count(F.lit(1)).alias("row_count")


def payment_count() -> Column:
    return F.count_distinct(F.col("payment_id")).alias("payment_count")


def total_payment_amount() -> Column:
    return F.sum("amount").alias("total_payment_amount")


def successful_payment_count() -> Column:
    return F.count_if(F.col("payment_status") == CAPTURED).alias("successful_payment_count")


def successful_payment_rate() -> Column:
    return ratio(successful_payment_count(), payment_count()).alias("successful_payment_rate")


# Queries.


def dataset(df: DataFrame) -> DataFrame:
    """All columns of a metric table."""
    return df.select("*")


def dataset_row_counts(datasets: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(row_count()).select(F.lit(name).alias("dataset"), "row_count")
        for name, df in datasets.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def payment_counter(payments: DataFrame) -> DataFrame:
    statuses = F.count_distinct(F.col("payment_status")).alias("payment_status_count")
    return payments.agg(payment_count(), statuses)


def payment_total(payments: DataFrame) -> DataFrame:
    return payments.agg(total_payment_amount())


def success_counter(payments: DataFrame) -> DataFrame:
    return payments.agg(successful_payment_count())


def success_rate(payments: DataFrame) -> DataFrame:
    """NULL, not an error, on an empty table."""
    return payments.agg(successful_payment_rate())


def status_distribution(payments: DataFrame) -> DataFrame:
    return payments.groupBy("payment_status").agg(payment_count())


def weekly_volume(payments: DataFrame) -> DataFrame:
    return payments.groupBy(week_start("initiated_at").alias("week")).agg(total_payment_amount())


def merchant_volume(payments: DataFrame) -> DataFrame:
    """Volume per merchant name; merchants of the same name are one row."""
    return payments.groupBy("merchant_name").agg(total_payment_amount())


def top_merchants(payments: DataFrame, k: int) -> DataFrame:
    """The ``k`` largest volumes, ties in order of name."""
    largest = [F.col("total_payment_amount").desc_nulls_last(), F.col("merchant_name")]
    return merchant_volume(payments).orderBy(*largest).limit(k)


def gateway_counts(payments: DataFrame) -> DataFrame:
    return payments.groupBy("gateway_name").agg(payment_count())


def net_payment_trend(operations: DataFrame) -> DataFrame:
    """A row per day, placed at the start of its week; not aggregated."""
    return operations.select(week_start("operation_date").alias("week"), "net_payment_amount")


def net_payment_weekly(operations: DataFrame) -> DataFrame:
    net = F.sum("net_payment_amount").alias("net_payment_amount")
    return operations.groupBy(week_start("operation_date").alias("week")).agg(net)


def refund_total(operations: DataFrame) -> DataFrame:
    return operations.agg(F.sum("total_refund_amount").alias("total_refund_amount"))


def chargeback_total(operations: DataFrame) -> DataFrame:
    return operations.agg(F.sum("total_chargeback_amount").alias("total_chargeback_amount"))


def merchant_account_pairs(merchants: DataFrame, accounts: DataFrame) -> DataFrame:
    """Each merchant that has accounts, with one of them: the smallest account id.

    The account is a struct column, since both sides share column names.
    """
    smallest = F.min_by(F.struct(*accounts.columns), "account_id").alias("account")
    return merchants.join(accounts.groupBy("merchant_id").agg(smallest), "merchant_id")


def lifecycle_violations(payment_performance: DataFrame) -> DataFrame:
    """One row: how many payments break a rule of the payment life cycle.

    Refunds, chargebacks and settlements belong to captured payments only; a
    refund is at most the amount; a settlement is what refund and chargeback
    leave of the amount, at least 0.
    """
    amount = F.col("amount")
    refund = F.col("total_refund_amount")
    chargeback = F.col("total_chargeback_amount")
    children = F.col("refund_count") + F.col("chargeback_count") + F.col("settlement_count")
    not_captured = F.coalesce(F.col("payment_status") != CAPTURED, F.lit(True))
    due = F.greatest(F.lit(0), amount - refund - chargeback)
    settled = F.col("settlement_count") > 0
    return payment_performance.agg(
        F.count_if(not_captured & (children > 0)).alias("children_without_capture"),
        F.count_if(refund > amount).alias("refund_over_amount"),
        F.count_if(settled & (F.col("total_settlement_amount") != due)).alias(
            "settlement_mismatch"
        ),
    )
