"""Helpers shared by the operators: columns by exact name, scratch tables, bounded batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paylake.session import scratch_dir

#: Characters of text that one step inside a task handles at once; a longer text goes alone.
STEP_CHARS = 1 << 20

#: What map_texts reads as the numbers of the texts that the new rows are of.
ROW = object()


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, matched by exact case.

    Other columns may have any names, also ones that differ in case only or repeat;
    of repeated names the first counts.
    """
    at: dict[str, int] = {}
    for i, name in enumerate(df.columns):
        at.setdefault(name, i)
    missing = [n for n in names if n not in at]
    if missing:
        raise ValueError(f"no column {missing} in {df.columns}")
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return plain.select(*(F.col(f"c{at[n]}").alias(n) for n in names))


def read(spark: SparkSession, sf_dir: str, table: str, *names: str) -> DataFrame:
    """The named columns of a table, matched by exact case.

    A table that has other columns with the same names in another case can be read by a
    case-sensitive session alone, also later when the rows are wanted. Its named columns are copied to the
    scratch folder under that setting, which is then put back.
    """
    setting = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        whole = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        if len({c.lower() for c in whole.columns}) < len(whole.columns):
            return stored(pick(whole, *names), table)
    finally:
        spark.conf.set("spark.sql.caseSensitive", setting)
    return pick(whole, *names)


#: Groups that a sample is drawn for: the most frequent ones.
MOST_GROUPS = 256


def sampled(rows: DataFrame, group: str, number: int) -> DataFrame:
    """About ``number`` rows of each group, or all if there are fewer, by a hash of ``doc_id``.

    Each group gets a bound for the hash from its number of rows, so no group is sorted or brought together. What
    comes out is bounded whatever the data: rows that repeat an id are in or out together, but no group has more than twice
    ``number``, and only the ``MOST_GROUPS`` most frequent groups have a sample. Rows without group or id are left out.
    """
    known = rows.where(F.col(group).isNotNull() & F.col("doc_id").isNotNull())
    sizes = known.groupBy(group).count().orderBy(F.desc("count"), group).limit(MOST_GROUPS).collect()
    within = F.lit(False)
    for name, size in sizes:
        share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(min(1, number / size) * (1 << 30))
        within = within | ((F.col(group) == name) & share)
    nth = F.row_number().over(Window.partitionBy(group).orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64(*rows.columns)))
    return known.where(within).withColumn("_nth", nth).where(F.col("_nth") <= 2 * number).drop("_nth")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read from there.

    Cuts the lineage: a lost executor costs no recomputation, and what follows may
    read the rows more than once.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(df: DataFrame) -> DataFrame:
    """Has Spark send rows to Python in batches of bounded size, however long the texts are.

    Files are read in smaller batches too: the reader holds the texts of a whole batch, by default 4096 rows, in one array.
    """
    conf = df.sparkSession.conf
    conf.set("spark.sql.parquet.columnarReaderBatchSize", "512")
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    return df


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def steps(texts: list[str | None], most: int = STEP_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``most`` characters; a longer text is a range of its own."""
    start, chars = 0, 0
    for i, text in enumerate(texts):
        size = len(text or "")
        if i > start and chars + size > most:
            yield start, i
            start, chars = i, 0
        chars += size
    if start < len(texts):
        yield start, len(texts)


def map_texts(
    df: DataFrame,
    schema: str,
    prepare: Callable[[], Callable[[list[str | None]], dict[str, Iterable]]],
    text: str = "text",
    keep_text: bool = False,
) -> DataFrame:
    """The other columns of ``df``, or all, followed by what a function makes of the text column.

    ``prepare`` runs once in each task and returns the function, which gets a list of
    texts, a bounded number of characters at a time, and returns new columns by name.
    ``schema`` is theirs. A further entry ``ROW`` makes other rows than one for each
    text: it says which text each is of.
    """
    kept = [c for c in df.columns if keep_text or c != text]
    full = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept), schema])
    made = [f.name for f in df.sparkSession.createDataFrame([], schema).schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare()
        for batch in batches:
            done = 0
            # Rows go to Python objects a slice at a time.
            while done < batch.num_rows:
                part = batch.slice(done, 512)
                done += part.num_rows
                texts = part.column(text).to_pylist()
                for a, b in steps(texts):
                    out = work(texts[a:b])
                    own = part.slice(a, b - a)
                    if ROW in out:
                        own = own.take(pa.array(out[ROW]))
                    yield pa.RecordBatch.from_arrays(
                        [own.column(c) for c in kept]
                        + [v if isinstance(v, pa.Array) else pa.array(v) for v in (out[m] for m in made)],
                        names=[*kept, *made],
                    )

    return bounded_batches(df).mapInArrow(run, full)


def ragged(counts) -> pa.Array:
    """Arrow offsets for runs of the given lengths."""
    import numpy as np

    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=offsets[1:])
    return offsets


def binaries(flat, counts, width: int = 1) -> pa.Array:
    """Binary values cut one after another from the bytes of a numpy array.

    ``counts`` has the items of each value and ``width`` the bytes of an item.
    """
    import numpy as np

    offsets = (ragged(counts) * width).astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))]
    ).cast(pa.binary())
