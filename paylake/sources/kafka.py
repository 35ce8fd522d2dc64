"""Kafka as a stream source. Needs Spark's Kafka connector on the classpath."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    bootstrap_servers: str,
    username: str | None = None,
    password: str | None = None,
    login_module: str = "org.apache.kafka.common.security.plain.PlainLoginModule",
) -> dict[str, str]:
    """Connection options; with a username, SASL_SSL with the PLAIN mechanism.

    Platforms that shade the Kafka client pass their own ``login_module``.
    """
    options = {"kafka.bootstrap.servers": bootstrap_servers}
    if username is not None:
        options |= {
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": (
                f'{login_module} required username="{username}" password="{password}";'
            ),
        }
    return options


def stream_options(
    options: dict[str, str],
    topics: Sequence[str],
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """All options of the stream. ``max_offsets_per_trigger`` bounds a microbatch."""
    merged = {**options, "subscribe": ",".join(topics), "startingOffsets": starting_offsets}
    if max_offsets_per_trigger is not None:
        merged["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return merged


def read_kafka(
    spark: SparkSession,
    options: dict[str, str],
    topics: Sequence[str],
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    merged = stream_options(options, topics, starting_offsets, max_offsets_per_trigger)
    return spark.readStream.format("kafka").options(**merged).load()
