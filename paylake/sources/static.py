"""Static datasets: CSV scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake.functions.scalars import to_instant


def read_text_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file or folder with a header line: every column as text, by the names in the header."""
    return spark.read.option("header", True).csv(path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """A CSV file or folder with a header line.

    With a schema, columns are found by name, others in the file are left out, and a cell
    that is no value of its type is NULL (``unreadable_cells`` counts them). Without one
    Spark reads the data twice to infer types; pass the schema for anything large.
    """
    if schema is None:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    return typed(read_text_csv(spark, path), schema)


def _typed(text: DataFrame, field: T.StructField) -> Column:
    kind = text.schema[field.name].dataType
    if not isinstance(kind, T.StringType):
        return F.col(field.name).try_cast(field.dataType)
    if isinstance(field.dataType, T.TimestampType):
        return to_instant(field.name)
    return F.col(field.name).try_cast(field.dataType)


def typed(text: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns, with their types."""
    missing = [f.name for f in schema.fields if f.name not in text.columns]
    if missing:
        raise ValueError(f"columns {missing} are not in {text.columns}")
    return text.select(*[_typed(text, f).alias(f.name) for f in schema.fields])


def unreadable_cells(text: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: per declared column, how many cells hold text that is no value of its type."""
    return text.agg(
        *[
            F.count_if(F.col(f.name).isNotNull() & _typed(text, f).isNull()).alias(f.name)
            for f in schema.fields
        ]
    )
