"""Data-quality measurements and gates.

Each measurement is one aggregate over the frame, whatever the number of
columns. The ``*_report`` and other DataFrame-valued functions stay lazy and
give one row (or one per topic); the gates collect only those rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.sources import events
from paylake.specs import EVENT_TIMESTAMPS, EntitySpec

MISSING_COLUMN = -1


class QualityError(ValueError):
    """A batch or dataset that a gate refuses."""


# --- measurements on one frame -------------------------------------------------


def required_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: NULL count per required column, -1 for a column that is absent."""
    counts = [
        F.count_if(F.col(c).isNull()).alias(c)
        if c in df.columns
        else F.lit(MISSING_COLUMN).cast("bigint").alias(c)
        for c in columns
    ]
    return df.agg(F.count(F.lit(1)).alias("_rows"), *counts).drop("_rows")


def negative_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: count of values below zero per column; absent columns are left out."""
    present = [c for c in columns if c in df.columns]
    return df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c) < 0).alias(c) for c in present]
    ).drop("_rows")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, distinct keys and their difference.

    The key is counted as a struct, so NULL parts count like any other value.
    """
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(F.struct(*keys)).alias("distinct_keys"),
    )
    return counted.withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_keys"))


def grain(df: DataFrame, key: str) -> DataFrame:
    """One row: rows and distinct non-NULL keys, equal if the grain holds."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct(F.col(key)).alias("distinct_keys")
    )


def id_hygiene(df: DataFrame, key: str, pattern: str = "%-batch-%") -> DataFrame:
    """One row: how many ids look like the pattern; 0 is expected."""
    return df.agg(F.count_if(F.col(key).like(pattern)).alias("bad_ids"))


def events_per_topic(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("topic").agg(F.count(F.lit(1)).alias("event_count")).orderBy("topic")


def check_required_columns(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    return required_nulls(df, columns).first().asDict() if columns else {}


def check_negative_values(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    return negative_values(df, columns).first().asDict()


def count_duplicates(df: DataFrame, keys: Sequence[str]) -> int:
    return duplicates(df, keys).first()["duplicate_rows"]


def check_duplicate_events(df: DataFrame) -> int:
    return count_duplicates(df, ["topic", "partition", "offset"])


# --- one report for a whole event batch ----------------------------------------


def event_report(
    parsed: DataFrame, specs: Sequence[EntitySpec], numbers: str = "strict"
) -> DataFrame:
    """One row per topic of a batch parsed by ``events.parse_all``.

    ``null_<column>`` and ``negative_<column>`` count within the topics that
    require the column; ``duplicate_records`` counts repeats of
    (topic, partition, offset) and ``repeated_keys`` those of a business key;
    ``malformed`` counts records that are no JSON object of the declared types;
    ``unreadable_<column>`` counts texts that should be a number or a time and are none.

    The counts combine map-side to a row per topic and task. The distinct counts
    run beside them on narrow columns, so the counters are not shuffled with
    every record.
    """
    required = sorted({c for s in specs for c in s.required})
    money = sorted({c for s in specs for c in s.money})

    def within(kind: str, column: str, test: Callable[[Column], Column]) -> Column:
        hits = F.lit(False)
        for s in specs:
            if column in getattr(s, kind):
                value = events.payload_field(s, column, numbers)
                hits = F.when(F.col("topic") == s.topic, test(value)).otherwise(hits)
        return hits

    lost: dict[str, Column] = {}
    for s in specs:
        for c, test in _unreadable(s, numbers).items():
            lost[c] = F.when(F.col("topic") == s.topic, test).otherwise(lost.get(c, F.lit(False)))

    broken = F.lit(False)
    for s in specs:
        broken = F.when(F.col("topic") == s.topic, events.malformed(s)).otherwise(broken)
    counts = parsed.groupBy("topic").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(broken).alias("malformed"),
        *[
            F.count_if(within("required", c, Column.isNull)).alias(f"null_{c}")
            for c in required
        ],
        *[
            F.count_if(within("money", c, lambda v: v < 0)).alias(f"negative_{c}")
            for c in money
        ],
        *[F.count_if(test).alias(f"unreadable_{c}") for c, test in sorted(lost.items())],
    )
    records = parsed.groupBy("topic").agg(
        F.count_distinct(F.struct("partition", "offset")).alias("_records")
    )
    key = F.lit(None).cast("string")
    for s in specs:
        parts = [events.payload_field(s, c, numbers) for c in s.keys]
        own = parts[0].cast("string") if len(parts) == 1 else F.to_json(F.struct(*parts))
        key = F.when(F.col("topic") == s.topic, own).otherwise(key)
    repeats = (
        parsed.select("topic", key.alias("_key"))
        .groupBy("topic")
        .agg((F.count("_key") - F.count_distinct(F.col("_key"))).alias("repeated_keys"))
    )
    return (
        counts.join(records, "topic")
        .withColumn("duplicate_records", F.col("record_count") - F.col("_records"))
        .drop("_records")
        .join(repeats, "topic")
    )


def row_errors(spec: EntitySpec, numbers: str = "strict") -> Column:
    """Reasons why a parsed record of the entity is refused, as an array of text."""
    reasons = [F.when(events.malformed(spec), F.lit("malformed"))]
    for c in spec.required:
        value = events.payload_field(spec, c, numbers)
        reasons.append(F.when(value.isNull(), F.lit(f"missing:{c}")))
    for c in spec.money:
        value = events.payload_field(spec, c, numbers)
        reasons.append(F.when(value < 0, F.lit(f"negative:{c}")))
    for c, test in _unreadable(spec, numbers).items():
        reasons.append(F.when(test, F.lit(f"unreadable:{c}")))
    return F.array_compact(F.array(*reasons))


def batch_errors(specs: Sequence[EntitySpec], numbers: str = "strict") -> Column:
    """``row_errors`` of each record's own topic, in one pass over a batch of all topics."""
    errors = F.array().cast("array<string>")
    for s in specs:
        errors = F.when(F.col("topic") == s.topic, row_errors(s, numbers)).otherwise(errors)
    return errors


def judged(
    parsed: DataFrame, specs: Sequence[EntitySpec], numbers: str = "strict", name: str = "errors"
) -> DataFrame:
    """The records with their reasons in one column, each parsed and judged once.

    Spark moves a filter on the reasons below the projection that makes them and below the parse, and writes
    the parse out anew for every field that they mention. It does not do so for a column that depends on where a
    row is; this one asks for the number of the partition, which is never below zero.
    """
    return parsed.withColumn(name, F.when(F.spark_partition_id() >= 0, batch_errors(specs, numbers)))


def _unreadable(spec: EntitySpec, numbers: str) -> dict[str, Column]:
    """For fields sent as text: whether there is text that gives no value."""
    tests = {}
    for field in spec.payload_schema.fields:
        text = F.col(spec.table)["payload"][field.name]
        if field.name in EVENT_TIMESTAMPS and isinstance(field.dataType, T.StringType):
            tests[field.name] = text.isNotNull() & F.try_to_timestamp(text).isNull()
        elif numbers == "tolerant" and isinstance(field.dataType, T.LongType):
            value = events.payload_field(spec, field.name, numbers)
            tests[field.name] = text.isNotNull() & value.isNull()
    return tests


# --- gates ----------------------------------------------------------------------


def refuse_bad_columns(name: str, counts: Mapping[str, int], strict: bool = False) -> None:
    """Raise if a required column has NULLs; in strict mode also if it is absent."""
    bad = {c: n for c, n in counts.items() if n > 0 or (strict and n != 0)}
    if bad:
        raise QualityError(f"{name}: required columns without value: {bad}")


def refuse_negative(name: str, counts: Mapping[str, int]) -> None:
    bad = {c: n for c, n in counts.items() if n > 0}
    if bad:
        raise QualityError(f"{name}: negative amounts: {bad}")


def refuse_unreadable(name: str, counts: Mapping[str, int]) -> None:
    bad = {c: n for c, n in counts.items() if n > 0}
    if bad:
        raise QualityError(f"{name}: cells that are no value of their type: {bad}")


def refuse_duplicates(name: str, duplicate_rows: int) -> None:
    if duplicate_rows > 0:
        raise QualityError(f"{name}: {duplicate_rows} rows repeat a key")


def refuse_batch(topic_report: Mapping[str, int]) -> None:
    """Gate one row of ``event_report``."""
    topic = topic_report["topic"]
    refuse_bad_columns(
        topic, {k[5:]: v for k, v in topic_report.items() if k.startswith("null_")}
    )
    refuse_negative(
        topic, {k[9:]: v for k, v in topic_report.items() if k.startswith("negative_")}
    )
    # A time that cannot be read is empty, as everywhere; an amount must not be lost.
    lost = {k[11:]: v for k, v in topic_report.items() if k.startswith("unreadable_") and v > 0}
    if lost := {c: n for c, n in lost.items() if c not in EVENT_TIMESTAMPS}:
        raise QualityError(f"{topic}: numbers that cannot be read: {lost}")
