"""Payment-domain views over the TPC-H-like test tables.

Money is in cents (bigint). Natural ids built from line items repeat, so counts
of distinct ids differ from row counts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.session import fit_partitions
from paylake.sources import files
from paylake.sources.events import table_to_events, to_envelope
from paylake.specs import EntitySpec

FACT_TABLES = ("customer", "orders", "lineitem", "events")
EVENT_TYPES = ("click", "signup", "error", "purchase", "view")


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def days_after(column: str, days: int) -> Column:
    return F.col(column) + F.expr(f"INTERVAL {days} DAY")


def _built_once(method: Callable) -> Callable:
    """Keep the (lazy) frame that a method builds, per instance and arguments."""

    @wraps(method)
    def kept(self, *args):
        key = (method.__name__, args)
        if key not in self._frames:
            self._frames[key] = method(self, *args)
        return self._frames[key]

    return kept


class Views:
    """Lazy frames over one folder of test tables."""

    _instances: dict[tuple[str, str], "Views"] = {}

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> "Views":
        key = (spark.sparkContext.applicationId, folder)
        if key not in cls._instances:
            cls._instances[key] = cls(spark, folder)
        found = cls._instances[key]
        fit_partitions(spark, found.fact_bytes())
        return found

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._frames: dict[tuple, DataFrame] = {}
        self._bytes: int | None = None

    def fact_bytes(self) -> int:
        """The size of the tables that facts come from."""
        if self._bytes is None:
            self._bytes = sum(files.size(self.spark, f"{self.folder}/{name}.parquet") for name in FACT_TABLES)
        return self._bytes

    @_built_once
    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @_built_once
    def payments(self) -> DataFrame:
        key, status = F.col("o_orderkey"), F.col("o_orderstatus")
        return self.table("orders").select(
            key.alias("payment_id"),
            F.col("o_custkey").alias("merchant_id"),
            F.col("o_custkey").alias("customer_id"),
            key.alias("invoice_id"),
            (key % 25).cast("int").alias("gateway_id"),
            F.col("o_orderpriority").alias("payment_method_id"),
            cents("o_totalprice").alias("amount"),
            F.lit("INR").alias("currency"),
            F.when(status == "F", "Captured")
            .when(status == "O", "Pending")
            .otherwise("Failed")
            .alias("payment_status"),
            key.cast("string").alias("payment_reference"),
            F.col("o_orderdate").alias("initiated_at"),
            F.when(status == "F", days_after("o_orderdate", 1)).alias("completed_at"),
            ((key * 37) % 5000).alias("processing_time_ms"),
        )

    @_built_once
    def merchants(self) -> DataFrame:
        balance = F.col("c_acctbal")
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            self.table("customer")
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                F.col("c_custkey").alias("merchant_id"),
                F.col("c_name").alias("merchant_name"),
                F.col("c_mktsegment").alias("industry"),
                F.lit("Private Limited").alias("business_type"),
                F.col("r_name").alias("country"),
                F.col("n_name").alias("city"),
                F.when(balance < 0, "High")
                .when(balance < 5000, "Medium")
                .otherwise("Low")
                .alias("risk_level"),
                F.lit("T+1").alias("settlement_cycle"),
                F.lit("Verified").alias("verification_status"),
            )
        )

    @_built_once
    def gateways(self) -> DataFrame:
        return (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("n_nationkey").alias("gateway_id"),
                F.col("n_name").alias("gateway_name"),
                F.col("r_name").alias("provider"),
                F.lit("Card").alias("gateway_type"),
                F.lit("Active").alias("status"),
            )
        )

    @_built_once
    def payment_methods(self) -> DataFrame:
        return (
            self.table("orders")
            .select(
                F.col("o_orderpriority").alias("payment_method_id"),
                F.expr("substr(o_orderpriority, 3)").alias("payment_method_name"),
                F.lit("Card").alias("category"),
            )
            .distinct()
        )

    @_built_once
    def accounts(self) -> DataFrame:
        return self.table("orders").select(
            F.concat(F.lit("ACC"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias(
                "account_id"
            ),
            F.col("o_custkey").alias("merchant_id"),
            F.col("o_orderpriority").alias("bank_name"),
        )

    @_built_once
    def attempts(self) -> DataFrame:
        flag = F.col("l_returnflag")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("payment_id"),
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("attempt_id"),
            (F.col("l_suppkey") % 25).cast("int").alias("gateway_id"),
            F.col("l_linenumber").alias("attempt_number"),
            F.when(flag == "R", "Failed")
            .when(flag == "A", "Success")
            .otherwise("Pending")
            .alias("attempt_status"),
        )

    @_built_once
    def payment_events(self) -> DataFrame:
        return self.table("events").select(
            "event_id",
            F.col("user_id").alias("payment_id"),
            F.get_json_object("props", "$.k").cast("int").alias("retry_count"),
            F.col("ts").alias("event_timestamp"),
        )

    def _lines(self, condition: Column) -> DataFrame:
        return (
            self.table("lineitem")
            .where(condition)
            .join(
                self.table("orders").select("o_orderkey", "o_custkey"),
                F.col("l_orderkey") == F.col("o_orderkey"),
            )
            .withColumn("_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
            # Arrival order: ship date, then a number that no two lines share.
            .withColumn("_arrival", F.col("l_partkey") * 1000000000 + F.col("l_suppkey"))
        )

    @_built_once
    def refund_lines(self) -> DataFrame:
        return self._lines(F.col("l_returnflag") == "R").select(
            F.col("_id").alias("refund_id"),
            F.col("l_orderkey").alias("payment_id"),
            F.col("o_custkey").alias("merchant_id"),
            cents("l_extendedprice").alias("refund_amount"),
            F.col("l_shipdate").alias("requested_at"),
            F.when(F.col("l_linestatus") == "F", days_after("l_shipdate", 2)).alias(
                "completed_at"
            ),
            "_arrival",
        )

    @_built_once
    def refunds(self) -> DataFrame:
        return self.refund_lines().drop("_arrival")

    @_built_once
    def chargeback_lines(self) -> DataFrame:
        late = (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")
        return self._lines(late).select(
            F.col("_id").alias("chargeback_id"),
            F.col("l_orderkey").alias("payment_id"),
            F.col("o_custkey").alias("merchant_id"),
            cents("l_extendedprice").alias("amount"),
            F.col("l_shipdate").alias("created_at"),
            "_arrival",
        )

    @_built_once
    def chargebacks(self) -> DataFrame:
        return self.chargeback_lines().drop("_arrival")

    @_built_once
    def settlement_lines(self) -> DataFrame:
        return self._lines(F.col("l_returnflag") == "N").select(
            F.col("_id").alias("settlement_id"),
            F.col("l_orderkey").alias("payment_id"),
            F.col("o_custkey").alias("merchant_id"),
            F.col("l_suppkey").alias("account_id"),
            cents("l_extendedprice").alias("settlement_amount"),
            F.col("l_shipdate").alias("initiated_at"),
            F.when(F.col("l_linestatus") == "F", days_after("l_shipdate", 3)).alias(
                "completed_at"
            ),
            "_arrival",
        )

    @_built_once
    def settlements(self) -> DataFrame:
        return self.settlement_lines().drop("_arrival")

    # --- raw logs ---

    def _log(self, rows: DataFrame, table: str, time: str, offset: str) -> DataFrame:
        """The table replayed as events; its ``time`` column is also the arrival time."""
        return table_to_events(
            rows,
            table,
            event_time=F.col(time),
            partition=F.col(offset) % 3,
            offset=F.col(offset),
            kafka_timestamp=F.col(time).cast("timestamp"),
            payload=[c for c in rows.columns if c != "_arrival"],
        )

    def log_of_payments(self, rows: DataFrame) -> DataFrame:
        return self._log(rows, "payments", "initiated_at", "payment_id")

    @_built_once
    def payment_log(self) -> DataFrame:
        return self.log_of_payments(self.payments())

    @_built_once
    def customer_log(self) -> DataFrame:
        rows = self.table("customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name")
        )
        arrived = F.to_timestamp(F.lit("2020-01-02 00:00:00"))
        key = F.col("customer_id")
        return table_to_events(rows, "customers", arrived, key % 3, key, arrived)

    @_built_once
    def invoice_log(self) -> DataFrame:
        rows = self.payments().select(
            "invoice_id", "customer_id", "merchant_id", F.col("amount").alias("invoice_amount"),
            F.col("initiated_at").alias("created_at"),
        )
        return self._log(rows, "invoices", "created_at", "invoice_id")

    @_built_once
    def refund_log(self) -> DataFrame:
        return self._log(self.refund_lines(), "refunds", "requested_at", "_arrival")

    @_built_once
    def chargeback_log(self) -> DataFrame:
        return self._log(self.chargeback_lines(), "chargebacks", "created_at", "_arrival")

    @_built_once
    def settlement_log(self) -> DataFrame:
        return self._log(self.settlement_lines(), "settlements", "initiated_at", "_arrival")

    @_built_once
    def merchant_log(self) -> DataFrame:
        arrived = F.to_timestamp(F.lit("2020-01-01 00:00:00"))
        key = F.col("merchant_id")
        return table_to_events(self.merchants(), "merchants", arrived, key % 3, key, arrived)

    @_built_once
    def raw_log(self) -> DataFrame:
        """Merchants, payments, refunds, chargebacks and settlements as raw records."""
        return (
            self.merchant_log()
            .unionByName(self.payment_log())
            .unionByName(self.refund_log())
            .unionByName(self.chargeback_log())
            .unionByName(self.settlement_log())
        )

    def activity_log(self, value: Column) -> DataFrame:
        """The test table ``events`` as raw records, with ``value`` in the payload."""
        return self.table("events").select(
            F.concat("event_type", F.lit("-events")).alias("topic"),
            (F.col("user_id") % 3).cast("int").alias("partition"),
            F.col("event_id").alias("offset"),
            F.col("ts").cast("timestamp").alias("kafka_timestamp"),
            to_envelope(
                F.col("ts"),
                [
                    "event_id", "user_id", value.alias("value"), "props",
                    F.col("ts").alias("created_at"),
                ],
            ).alias("raw_payload"),
        )


ACTIVITY = tuple(
    EntitySpec(
        f"{kind}-events", kind, ("event_id",),
        "event_id bigint, user_id bigint, value bigint, props string, created_at string",
        required=("event_id",), money=("value",),
    )
    for kind in EVENT_TYPES
)
