import test_neardup
import test_packing
import test_fertility
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from paylake.llm import langid, quality, secrets
from paylake.llm.common import read

TABLE = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.select(*corpus_pipeline.COLUMNS).collect()))


def test_stages_against_brute_force(spark):
    """Every stage on what the one before it kept, by plain Python over all rows."""
    docs = spark.read.parquet(f"{TABLE}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = rows_of(docs)

    bands = quality.fit_bands(read(spark, TABLE, "documents", "doc_id", "lang", "text"), read(spark, TABLE, "labels", "doc_id", "quality"))
    names = ["n_words", "n_repeat_words", "chars_per_token", "tokens_per_word", "byte_share", "token_entropy", "script"]

    def good(row):
        if test_fertility.brute(row[1])[5]:
            return False
        measured = quality._Measure(quality.PIECES)([row[1]])
        _, _, chars, words, in_bytes, entropy, script = (measured[n][0] for n in names)
        band = bands.get(("lang", row[2])) or bands.get(("script", script)) or quality.WIDE["latin" if script == "latin" else "other"]
        return band[0] <= chars <= band[1] and band[2] <= words <= band[3] and in_bytes <= band[4] and entropy >= band[5]

    kept = [r for r in rows if good(r)]
    out = stages["quality rules"](spark, docs, TABLE).cache()
    assert rows_of(out) == kept

    dictionaries = langid.fit(out.where(~langid.held_out()))
    predictor = langid._Predict(dictionaries)
    kept = [r for r in kept if (found := predictor.one(r[1]))[0] != "und" and found[1] >= langid.MIN_MARGIN]
    out = stages["language ID"](spark, out, TABLE).cache()
    assert rows_of(out) == kept

    groups = test_neardup.brute([r[:2] for r in kept], words=5)
    kept = [r for r, g in zip(kept, groups, strict=True) if g[3]]
    out = stages["MinHash near-dedup"](spark, out, TABLE).cache()
    assert rows_of(out) == kept

    kept = [(r[0], m := secrets.masked(r[1], secrets.spans_of(r[1])), r[2], r[3], len(m)) for r in kept]
    out = stages["secret scans"](spark, out, TABLE).cache()
    assert rows_of(out) == kept

    packed = stages["best-fit packing"](spark, out, TABLE)
    test_packing.check([r[:2] for r in kept], packed)
    again = queries()["pipeline"](spark, TABLE)
    assert sorted(map(tuple, again.select("doc_id", "piece", "ids_crc32").collect())) == sorted(
        map(tuple, packed.select("doc_id", "piece", "ids_crc32").collect())
    )


def test_good_documents_stay(spark):
    table = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{table}/labels.parquet")
    docs = spark.read.parquet(f"{table}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = docs.join(labels.where("quality = 1"), "doc_id").where(F.size(F.split("text", r"[\x20\x09-\x0D]+")) >= 60)
    first = stages["quality rules"](spark, docs, table).cache()
    second = stages["language ID"](spark, first, table)
    total = clean.count()
    assert clean.join(first, "doc_id", "left_semi").count() > 0.97 * total
    assert clean.join(second, "doc_id", "left_semi").count() > 0.97 * total


def test_unusual_rows(spark, documents, folder):
    long = ["".join(f"{kind}{a}{b} and " for a in "abcdefgh" for b in "mnopqrst") for kind in ("house", "garden", "window")]
    rows = [(1, None), (2, ""), (3, long[0]), (3, long[0]), (4, long[1] + "token=abcdefgh12"), (None, long[2]), (None, long[2]), (5, "short")]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    table = folder(documents=documents(rows), labels=labels)
    docs = spark.read.parquet(f"{table}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, table).cache()
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in docs.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    masked = long[1] + "[assign]"
    expected = [(3, long[0], len(long[0])), (4, masked, len(masked)), (None, long[2], len(long[2])), (None, long[2], len(long[2]))]
    assert got == expected
    assert corpus_pipeline.run(spark, table).count() == 4


def test_empty_tables(spark, documents, folder):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert corpus_pipeline.run(spark, folder(documents=documents([]), labels=labels)).collect() == []


def test_near_dedup_keeps_another_text_of_a_repeated_id(spark, documents):
    words = [f"w{i}" for i in range(80)]
    a, b, near = " ".join(words), " ".join(f"v{i}" for i in range(80)), " ".join([*words[:79], "x"])
    rows = [(1, a), (2, a), (2, b), (2, b), (3, near), (4, None), (4, ""), (None, a)]
    out = corpus_pipeline.near_dedup(spark, documents(rows), "")
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(map(tuple, out.select("doc_id", "text").collect()), key=key) == sorted([(1, a), (2, b), (4, None), (4, ""), (None, a)], key=key)
