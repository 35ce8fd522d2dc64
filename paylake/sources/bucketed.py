"""Tables of the session catalog that are cut and sorted by a key, so joins and groupings by it need no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write(rows: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Replace the table ``name`` and return it.

    Tables that are to be joined need the same number of buckets: data divided by what one task should read,
    rounded up to a power of 2, so that a table that has outgrown its number can meet a finer one by coalescing.
    Each bucket is one file: rows are dealt by the key before the write.
    """
    writer = rows.repartition(buckets, key).write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return rows.sparkSession.table(name)


def buckets_for(total_bytes: int, bucket_bytes: int = 256 * 1024 * 1024) -> int:
    """The least power of 2 that keeps a bucket of evenly spread keys below ``bucket_bytes``."""
    return 1 << (max(1, -(-total_bytes // bucket_bytes)) - 1).bit_length()
