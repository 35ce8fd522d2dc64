"""Metric tables of hot keys kept up by signed changes instead of by rebuilding.

A fact row is reduced to its image: who it names and the few values that measures use. A changed row
gives its old image with weight -1 and its new one with +1. What a metric row is made of splits into
parts that follow such changes: sums (counts and conditional counts are sums of 0 and 1, an
average is a sum and a count) add up with the weights, and a maximum grows with new values. Only
where the greatest value itself has been taken away and nothing as great has come must the facts of that key
be read again.

So an update costs the changes and one stored row for each key that they name, however many facts
stand behind the key. Changes of one row between two updates cancel out on the way.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.functions.scalars import or_zero
from paylake.plans.gold import GATEWAY_COLUMNS, MERCHANT_COLUMNS, REVERSAL_COUNTS
from paylake.plans.incremental import ENTITY_IDS, KEY_COLUMNS, candidate_days
from paylake.specs import ATTEMPT_FAILED, ATTEMPT_SUCCESS, CAPTURED, ENTITIES, STATIC

PAYMENT, REFUND, CHARGEBACK, SETTLEMENT = "payment-events", "refund-events", "chargeback-events", "settlement-events"
ATTEMPT, LIFECYCLE = "payment_attempts", "payment_events"

#: The name of the facts of a state table in images: the topic, or for static datasets the table.
FACTS = {
    **{e.table: e.topic for e in ENTITIES if e.topic in (PAYMENT, REFUND, CHARGEBACK, SETTLEMENT)},
    ATTEMPT: ATTEMPT,
    LIFECYCLE: LIFECYCLE,
}

IDS = {**ENTITY_IDS, **{s.table: s.keys[0] for s in STATIC}}

#: The columns of the facts that become ``amount``, ``status``, ``number`` and ``at`` of an image.
VALUES: Mapping[str, tuple[str | None, str | None, str | None, str | None]] = {
    PAYMENT: ("amount", "payment_status", "processing_time_ms", "completed_at"),
    REFUND: ("refund_amount", None, None, None),
    CHARGEBACK: ("amount", None, None, None),
    SETTLEMENT: ("settlement_amount", None, None, None),
    ATTEMPT: (None, "attempt_status", "attempt_number", None),
    LIFECYCLE: (None, None, "retry_count", "event_timestamp"),
}

IMAGE_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("entity_id", T.StringType()),
        *[T.StructField(c, T.StringType()) for c in KEY_COLUMNS],
        T.StructField("operation_dates", T.ArrayType(T.DateType())),
        T.StructField("weight", T.IntegerType()),
        T.StructField("amount", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("number", T.LongType()),
        T.StructField("at", T.TimestampType()),
    ]
)


def images(rows: DataFrame, topic: str, weight: int = 1) -> DataFrame:
    """The images of typed rows of one kind of facts, or of a dimension (then without values)."""

    def column(name: str | None) -> Column:
        return F.col(name) if name in rows.columns else F.lit(None)

    amount, status, number, at = (column(c) for c in VALUES.get(topic, (None,) * 4))
    made = {
        "topic": F.lit(topic),
        "entity_id": column(IDS[topic]),
        **{c: column(c) for c in KEY_COLUMNS},
        "operation_dates": candidate_days(topic, F.to_date),
        "weight": F.lit(weight),
        "amount": amount,
        "status": status,
        "number": number,
        "at": at,
    }
    return rows.select(*[made[f.name].cast(f.dataType).alias(f.name) for f in IMAGE_SCHEMA.fields])


def changes(old: DataFrame, new: DataFrame, topic: str) -> DataFrame:
    """Images of the rows before and after, one row for each id on either side."""
    return images(old, topic, -1).unionByName(images(new, topic, 1))


def net(changed: DataFrame) -> DataFrame:
    """Changes summed for each image; what a row was only between two updates is gone."""
    named = [c for c in IMAGE_SCHEMA.fieldNames() if c != "weight"]
    return changed.groupBy(*named).agg(F.sum("weight").alias("weight")).where("weight <> 0")


def _ones(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _number(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0))


def _counted() -> Column:
    return _ones(F.col("entity_id").isNotNull())


def _captured(yes: bool) -> Column:
    return _ones(F.col("status") == CAPTURED) if yes else _ones(F.col("status") != CAPTURED)


def _volume() -> dict[str, tuple[str, Column]]:
    return {"payment_count": (PAYMENT, _counted()), "total_payment_amount": (PAYMENT, _number("amount"))}


def _times() -> dict[str, tuple[str, Column]]:
    return {"timed_payments": (PAYMENT, _ones(F.col("number").isNotNull())), "processing_time_ms": (PAYMENT, _number("number"))}


def _reversals() -> dict[str, tuple[str, Column]]:
    out = {}
    for kind, topic in (("refund", REFUND), ("chargeback", CHARGEBACK), ("settlement", SETTLEMENT)):
        out[f"{kind}_count"] = (topic, _counted())
        out[f"total_{kind}_amount"] = (topic, _number("amount"))
    return out


@dataclass(frozen=True)
class Parts:
    """What the rows of a metric table are made of: sums, and greatest values, over images of one topic each."""

    key: str
    dimension: str
    columns: tuple[str, ...]
    sums: Callable[[], dict[str, tuple[str, Column]]]
    greatest: Callable[[], dict[str, tuple[str, Column]]]
    measures: tuple[str, ...] = field(default=())

    def topics(self) -> list[str]:
        return list(dict.fromkeys(t for t, _ in (*self.sums().values(), *self.greatest().values())))

    def names(self) -> list[str]:
        return [*self.sums(), *self.greatest()]


#: The metric tables that are kept up by changes.
PARTS: dict[str, Parts] = {
    "merchant_performance": Parts(
        "merchant_id",
        "merchants",
        MERCHANT_COLUMNS,
        lambda: {
            **_volume(),
            "successful_payment_count": (PAYMENT, _captured(True)),
            "non_successful_payment_count": (PAYMENT, _captured(False)),
            "successful_payment_amount": (PAYMENT, F.when(F.col("status") == CAPTURED, _number("amount")).otherwise(0)),
            **_times(),
            **_reversals(),
        },
        lambda: {"last_payment_completed_at": (PAYMENT, F.col("at"))},
        (
            "payment_count", "total_payment_amount", "successful_payment_count", "non_successful_payment_count",
            "successful_payment_amount", "avg_processing_time_ms", *REVERSAL_COUNTS, "last_payment_completed_at",
        ),
    ),
    "gateway_performance": Parts(
        "gateway_id",
        "payment_gateways",
        GATEWAY_COLUMNS,
        lambda: {
            **_volume(),
            "successful_payment_count": (PAYMENT, _captured(True)),
            "failed_or_other_payment_count": (PAYMENT, _captured(False)),
            **_times(),
            "attempt_count": (ATTEMPT, _counted()),
            "failed_attempt_count": (ATTEMPT, _ones(F.col("status") == ATTEMPT_FAILED)),
            "successful_attempt_count": (ATTEMPT, _ones(F.col("status") == ATTEMPT_SUCCESS)),
        },
        lambda: {"max_attempt_number": (ATTEMPT, F.col("number"))},
        (
            "payment_count", "total_payment_amount", "successful_payment_count", "failed_or_other_payment_count",
            "avg_processing_time_ms", "attempt_count", "failed_attempt_count", "successful_attempt_count", "max_attempt_number",
        ),
    ),
}


def _of(parts: Parts, facts: DataFrame) -> DataFrame:
    return facts.where(F.col("topic").isin(parts.topics()) & F.col(parts.key).isNotNull())


def accumulate(facts: DataFrame, parts: Parts) -> DataFrame:
    """The parts of each key, from the images of all facts; combined before the shuffle."""
    sums = [F.sum(F.when(F.col("topic") == t, v).otherwise(0).cast("long")).alias(n) for n, (t, v) in parts.sums().items()]
    tops = [F.max(F.when(F.col("topic") == t, v)).alias(n) for n, (t, v) in parts.greatest().items()]
    return _of(parts, facts).groupBy(parts.key).agg(*sums, *tops)


def _signed(changed: DataFrame, parts: Parts) -> DataFrame:
    """What changes add to each key: weighted sums, greatest value that came and that went."""
    sums = [
        F.sum(F.when(F.col("topic") == t, v * F.col("weight")).otherwise(0).cast("long")).alias(f"more_{n}")
        for n, (t, v) in parts.sums().items()
    ]
    tops = [
        F.max(F.when((F.col("topic") == t) & here, v)).alias(f"{side}_{n}")
        for n, (t, v) in parts.greatest().items()
        for side, here in (("came", F.col("weight") > 0), ("went", F.col("weight") < 0))
    ]
    return _of(parts, changed).groupBy(parts.key).agg(*sums, *tops)


def _kept(df: DataFrame) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def update(
    stored: DataFrame,
    changed: DataFrame,
    parts: Parts,
    facts: Callable[[DataFrame], DataFrame],
    keep: Callable[[DataFrame], DataFrame] = _kept,
) -> DataFrame:
    """New parts of the keys that changes name.

    ``stored`` has the parts so far, ``changed`` signed images. ``facts`` gets a set of keys and returns the
    images of their facts as they are now; it is called only if a greatest value went away. ``keep`` persists
    the result, which is looked at for that and then used.
    """
    key = parts.key
    delta = _signed(net(changed), parts)
    joined = delta.join(stored.select(key, *parts.names()), key, "left")
    sums = [(F.coalesce(n, F.lit(0)) + F.col(f"more_{n}")).alias(n) for n in parts.sums()]
    tops = [F.greatest(n, f"came_{n}").alias(n) for n in parts.greatest()]
    # The greatest is gone: nothing left is known to be as great as what went.
    gone = reduce(
        lambda a, b: a | b,
        [F.col(f"went_{n}").isNotNull() & F.coalesce(F.col(f"went_{n}") > F.col(f"came_{n}"), F.lit(True))
         & F.coalesce(F.col(f"went_{n}") >= F.col(n), F.lit(True)) for n in parts.greatest()],
    )
    made = keep(joined.select(key, *sums, *tops, gone.alias("_gone")))
    lost = made.where("_gone").select(key)
    if lost.isEmpty():
        return made.drop("_gone")
    again = accumulate(facts(lost), parts).select(key, *[F.col(n).alias(f"now_{n}") for n in parts.greatest()])
    whole = made.join(again, key, "left")
    exact = [F.when(F.col("_gone"), F.col(f"now_{n}")).otherwise(F.col(n)).alias(n) for n in parts.greatest()]
    return whole.select(key, *parts.sums(), *exact)


def merged(stored: DataFrame, updated: DataFrame, parts: Parts) -> DataFrame:
    """All parts after an update."""
    return stored.join(updated.select(parts.key), parts.key, "left_anti").select(parts.key, *parts.names()).unionByName(
        updated.select(parts.key, *parts.names())
    )


def metric_rows(dimension: DataFrame, stored: DataFrame, parts: Parts) -> DataFrame:
    """The rows of the metric table for the rows of its dimension."""
    joined = dimension.select(*parts.columns).join(stored, parts.key, "left")
    average = F.when(F.col("timed_payments") > 0, F.col("processing_time_ms") / F.col("timed_payments"))
    joined = joined.withColumn("avg_processing_time_ms", average)
    # An attempt's number is an int, as in the full build.
    joined = joined.withColumns({c: F.col(c).cast("int") for c in ("max_attempt_number",) if c in joined.columns})
    shown = [F.col(m) if m == "last_payment_completed_at" else or_zero(m) for m in parts.measures]
    return joined.select(*parts.columns, *shown)
