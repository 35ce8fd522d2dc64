"""From raw documents to packed token sequences: the stages of a training corpus.

Each stage gets all documents that the one before it kept, as a stored table, and returns
the columns of ``documents``; the last one returns packed pieces. Columns that
``documents`` does not have are left out by the first stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm import langid, neardup, packing, quality, secrets
from paylake.llm.common import pick, read, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Words of a shingle in the near-duplicate stage.
SHINGLE_WORDS = 5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie inside the bands of their language."""
    docs = pick(docs, *COLUMNS)
    bands = quality.fit_bands(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.judge(quality.measure(docs, keep_text=True), bands).where("kept").select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a clear margin; a missing language is filled in.

    Where no document has a language to learn from, nothing is rejected.
    """
    docs = pick(docs, *COLUMNS)
    dictionaries = langid.fit(docs.where(~langid.held_out()))
    if not dictionaries:
        return docs
    judged = langid.predict(docs, dictionaries, keep_text=True)
    clear = judged.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= langid.MIN_MARGIN))
    return clear.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the least id of each group of near copies, and rows without an id.

    Where an id has several texts, each of them is judged on its own: one that is no copy stays.
    """
    docs = pick(docs, *COLUMNS)
    known = docs.where("doc_id is not null")
    if known.groupBy("doc_id").count().where("count > 1").isEmpty():
        dropped = neardup.group(docs, SHINGLE_WORDS).where(~F.col("kept")).select("doc_id").distinct()
        return docs.join(dropped, "doc_id", "left_anti").select(*COLUMNS)
    # Numbers for the distinct (id, text) rows that rise with the id, so the least row of a group has its least id.
    ordered = known.dropDuplicates(["doc_id", "text"]).repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id")
    rows = stored(ordered.withColumn("row", F.monotonically_increasing_id()), "rows")
    kept = neardup.group(rows.select(F.col("row").alias("doc_id"), "text"), SHINGLE_WORDS).where("kept").select(F.col("doc_id").alias("row"))
    return rows.join(kept, "row").select(*COLUMNS).unionByName(docs.where("doc_id is null").select(*COLUMNS))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    masked = secrets.redact(pick(docs, *COLUMNS))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences of 4096 tokens."""
    cut = packing.pieces(pick(docs, "doc_id", "text"))
    rows = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(stored(rows, "pieces"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("MinHash near-dedup", near_dedup),
    ("secret scans", secret_scan),
    ("best-fit packing", best_fit_packing),
]

#: Tokenisers and compressors cannot be expressed in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", *COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
