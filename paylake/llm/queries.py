"""The queries over the test tables, each through its operator, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm import ann, bpe, chat, count_tree, langid, neardup, packing, quality, secrets, token_files, turn_trie, urlfilter, whitening
from paylake.llm.common import read, stored


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = bpe.round_trip(read(spark, sf_dir, "documents", "doc_id", "text"))
    return made.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(read(spark, sf_dir, "documents", "doc_id", "text"))
    rows = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(stored(rows, "pieces"))


def op3_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    bands = quality.fit_bands(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return quality.judge(quality.measure(docs), bands).select("doc_id", *counts, "base_failed", "kept", *quality.FITTED, "script")


def op4_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return chat.sequence(chat.calls_of_table(turns), chat.results_of_table(turns), chat.TURN_SCHEMA)


#: The rules of the query.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op5_url_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(urlfilter.prepare(read(spark, sf_dir, "pages", "page_id", "url"), URL_RULES), "urls")
    judged = urlfilter.score(rows, urlfilter.fit(rows))
    own = F.when(F.col("log_odds") >= urlfilter.THRESHOLD, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("action", own).alias("verdict"), "log_odds")


def op6_one_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("id") % 20 == 0)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    listed = token_files.write(docs, token_files.token_folder(docs))
    return token_files.read(listed).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.group(read(spark, sf_dir, "documents", "doc_id", "text"), words=2)


def op9_credential_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents", "doc_id", "text"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *(secrets.number(spans, k).alias(f"n_{k}") for k in secrets.BASE_KINDS),
        F.sha2(secrets.joined(spans, secrets.BASE_KINDS), 256).alias("base_sha256"),
        secrets.joined(spans).alias("spans"),
    )


def op10_compression_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    dictionaries = langid.fit(docs.where(~langid.held_out()))
    judged = langid.predict(docs.select("doc_id", "text"), dictionaries)
    accepted = F.col("score") >= langid.MIN_MARGIN
    return judged.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", accepted.alias("accepted"))


def op11_exact_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op12_count_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tree.group(read(spark, sf_dir, "documents", "doc_id", "text"))


def op13_double_array_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_trie.conversation_trie(read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_fertility_rules": op3_fertility_rules,
    "op4_tool_calls": op4_tool_calls,
    "op5_url_words": op5_url_words,
    "op6_one_bit_codes": op6_one_bit_codes,
    "op7_token_files": op7_token_files,
    "op8_superminhash": op8_superminhash,
    "op9_credential_linking": op9_credential_linking,
    "op10_compression_langid": op10_compression_langid,
    "op11_exact_whitening": op11_exact_whitening,
    "op12_count_tree": op12_count_tree,
    "op13_double_array_trie": op13_double_array_trie,
}

def shingle_groups_sql(words: int, percent: int, more: str = "") -> str:
    """Groups of documents by shingles that they share, in SQL: all pairs, then all that links reach."""
    return f"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
    lambda w: w <> '') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + {words} - 1], ' ') AS shingle
  FROM split, LATERAL (SELECT unnest(range(1, greatest(len(words) - {words} + 1, 1) + 1)) AS i)
  WHERE len(words) > 0
), sizes AS (
  SELECT d.doc_id, count(s.shingle) AS n FROM documents d LEFT JOIN shingles s ON s.doc_id = d.doc_id GROUP BY d.doc_id
), shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT u, v FROM shared JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v
  WHERE 100 * shared.n >= {percent} * (a.n + b.n - shared.n)
), sides AS (
  SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, s.v FROM reach r JOIN sides s ON s.u = r.other
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, n AS n_shingles, component_id{more} FROM sizes JOIN least USING (doc_id)
"""


#: The other operators use tokenizers, compressors, hashes or models that SQL does not have;
#: tests/llm compares them with brute force.
ORACLES: dict[str, str] = {
    "op4_tool_calls": chat.TURNS_SQL,
    "op8_superminhash": shingle_groups_sql(2, 80, ", doc_id = component_id AS kept"),
    "op12_count_tree": shingle_groups_sql(4, 85),
    "op13_double_array_trie": turn_trie.SQL,
}
