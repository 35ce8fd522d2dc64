"""Scalar column expressions shared by the layers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.specs import EVENT_TIMESTAMPS, STATIC_TIMESTAMPS


def or_zero(column: str) -> Column:
    """The column, or 0 where it is NULL, under the same name."""
    return F.coalesce(F.col(column), F.lit(0)).alias(column)


def to_instant(column: str) -> Column:
    """Parse text as a timestamp; text that is none becomes NULL, never an error."""
    return F.try_to_timestamp(F.col(column))


def whole_number(text: Column) -> Column:
    """Read ``77``, ``77.0``, ``7.7E1`` or ``"77"`` as a bigint; NULL if there is a fraction.

    The fraction is judged in the text, where no cast has rounded it away; with an
    exponent, by a decimal of eighteen places.
    """
    plain = F.regexp_extract(text, r"^\s*([+-]?\d+)(\.0*)?\s*$", 1)
    number = text.try_cast("decimal(38,18)")
    exponent = F.when(text.rlike("[eE]") & (number == F.floor(number)), number.try_cast("bigint"))
    return F.when(plain != "", plain.try_cast("bigint")).otherwise(exponent)


def operation_date(*timestamps: str) -> Column:
    """Calendar date of the first timestamp that is not NULL."""
    return F.to_date(F.coalesce(*[F.col(t) for t in timestamps]))


def week_start(column: str) -> Column:
    """Date of the Monday on or before the timestamp or date."""
    return F.to_date(F.date_trunc("WEEK", F.col(column)))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, NULL for an empty whole."""
    return F.try_divide(part, whole)


def normalise_timestamps(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Turn those of ``names`` that the frame has into timestamps, in one projection."""
    wanted = set(names)
    typed = {}
    for field in df.schema.fields:
        if field.name not in wanted or isinstance(field.dataType, T.TimestampType):
            continue
        if isinstance(field.dataType, T.StringType):
            typed[field.name] = to_instant(field.name)
        else:
            typed[field.name] = F.col(field.name).cast("timestamp")
    return df.withColumns(typed) if typed else df


def transform_event(df: DataFrame) -> DataFrame:
    """Type the timestamps of a flattened event frame."""
    return normalise_timestamps(df, EVENT_TIMESTAMPS)


def transform_static(df: DataFrame) -> DataFrame:
    """Type the timestamps of a static frame."""
    return normalise_timestamps(df, STATIC_TIMESTAMPS)


def bad_timestamps(df: DataFrame, names: Iterable[str] = EVENT_TIMESTAMPS) -> DataFrame:
    """One row: per text column that should hold a timestamp, how many values do not parse."""
    wanted = set(names)
    columns = [
        f.name
        for f in df.schema.fields
        if f.name in wanted and isinstance(f.dataType, T.StringType)
    ]
    if not columns:
        raise ValueError("no text column that should hold a timestamp")
    return df.agg(
        *[
            F.count_if(F.col(c).isNotNull() & to_instant(c).isNull()).alias(f"bad_{c}")
            for c in columns
        ]
    )
