import re
import zlib

from pyspark.sql import functions as F

from paylake.llm import common, langid
from paylake.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    table = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{table}/documents.parquet").select("doc_id", "lang", F.length("text").alias("n"))
    rows = QUERIES["op10_compression_langid"](spark, table).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    tested = [r for r in rows if r.held_out and r.lang]
    assert sum(r.lang == r.lang_pred for r in tested) / len(tested) > 0.97
    long = [r for r in rows if r.n >= 300]
    assert sum(r.accepted for r in long) / len(long) > 0.97


def make(spark, rows):
    schema = "doc_id long, text string, lang string, source string, score string"
    return spark.createDataFrame([(i, t, lang, "s", "x") for i, t, lang in rows], schema)


def test_query_on_unusual_rows(spark, folder):
    english, german = "the house and the garden are there " * 20, "das haus und der garten sind dort zu sehen " * 20
    train = [(i, english if i % 2 else german, "en" if i % 2 else "de") for i in range(100, 140)]
    odd = [(1, None, "en"), (2, "", "en"), (3, "123 !", None), (4, english, None), (4, english, None), (5, german * 300, None), (None, german, "yy"), (6, german, "xx")]
    got = QUERIES["op10_compression_langid"](spark, folder(documents=make(spark, train + odd))).collect()
    assert len(got) == len(train) + len(odd)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"}
    assert [r.lang_pred for r in got if r.doc_id == 4] == ["en", "en"]
    assert [r.lang_pred for r in got if r.doc_id == 5] == ["de"]
    assert [(r.held_out, r.lang_pred) for r in got if r.doc_id is None] == [(False, "de")]


def test_query_learns_from_documents_not_held_out(spark, folder):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 3 == 1)
    rows = [(held, "some words in a language", "aa"), (1000, "other words here", "bb")]
    got = QUERIES["op10_compression_langid"](spark, folder(documents=make(spark, rows))).collect()
    assert {r.lang_pred for r in got} == {"bb"}
    assert {r.score for r in got} == {1.0}


def test_query_on_empty_table(spark, folder):
    assert QUERIES["op10_compression_langid"](spark, folder(documents=make(spark, []))).collect() == []


def test_dictionaries_are_bounded(spark):
    rows = [(i, f"word{i} " * 500, "en") for i in range(60)]
    made = langid.fit(make(spark, rows), sample=20)
    assert list(made) == ["en"]
    assert 0 < len(made["en"]) <= langid.DICTIONARY_BYTES


def test_a_language_of_long_documents_has_a_dictionary(spark):
    german = "das haus und der garten sind dort zu sehen "
    rows = [(i, "the house and the garden are there " * 20, "en") for i in range(20)] + [(100 + i, "0 " * 5000 + german * 300, "de") for i in range(5)]
    made = langid.fit(make(spark, rows))
    assert sorted(made) == ["de", "en"]
    assert len(made["de"]) <= langid.SAMPLE_CHARS
    assert [r.lang_pred for r in langid.predict(make(spark, [(1, german * 300, None)]).select("doc_id", "text"), made).collect()] == ["de"]


def test_predictions_against_plain_sizes(spark):
    """Every text compressed piece by piece with each dictionary, a fresh compressor each time."""
    import zstandard

    table = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{table}/documents.parquet").select("doc_id", "text", "lang")
    made = langid.fit(docs.where(~langid.held_out()))

    def size(data, lang):
        content = zstandard.ZstdCompressionDict(made[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        options = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
        return len(zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=content, **options).compress(data))

    def expected(text):
        if not text or not any(c.isalpha() for c in text):
            return "und", 0.0
        data = " ".join(re.split(r"[\W\d_]+", text.lower())).encode()
        if len(data) < 512:
            step = max(1, len(data) // 8)
            parts = [data[a:] + data[:a] for a in range(0, len(data), step)]
        else:
            parts = [data[a : a + 2048] for a in range(0, len(data), 2048)]
        sizes = sorted((sum(size(p, lang) for p in parts), lang) for lang in made)
        return sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0]

    got = {r.doc_id: (r.lang_pred, r.score) for r in QUERIES["op10_compression_langid"](spark, table).collect()}
    for row in docs.collect():
        lang, score = expected(row.text)
        assert got[row.doc_id][0] == lang and abs(got[row.doc_id][1] - score) < 1e-12


def test_samples_are_bounded(spark, monkeypatch):
    rows = [(7, "the same words", "en")] * 900 + [(i, f"words {i}", "en") for i in range(100, 400)] + [(i, "worte", f"l{i % 40:02d}") for i in range(1000, 1200)]
    taken = common.sampled(make(spark, rows).select("doc_id", "text", "lang"), "lang", 20).groupBy("lang").count().collect()
    assert all(r["count"] <= 40 for r in taken)
    monkeypatch.setattr(common, "MOST_GROUPS", 3)
    found = common.sampled(make(spark, rows).select("doc_id", "text", "lang"), "lang", 20).select("lang").distinct().collect()
    assert {r.lang for r in found} <= {"en", "l00", "l01"}
