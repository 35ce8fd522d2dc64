import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paylake.llm import quality
from paylake.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen = 0, set()
    for line in text.split("\n"):
        lines += bool(WORD.search(line)) and line in seen
        seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(covered), failed


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t\x0b\x1c\x85é|", max_size=40), min_size=1, max_size=6))
def test_counts_of_any_text(texts):
    got = quality._Measure(quality.PIECES)(texts)
    for i, text in enumerate(texts):
        assert tuple(got[c][i] for c in COUNTS) == brute(text)[:5]


def test_many_different_words():
    # Word numbers too large to pack three into one integer.
    words = np.array([1 << 21, 5, 6, 1 << 21, 5, 6, 7, 8])
    assert quality.repeated_words(words, np.array([0, 6, 8])).tolist() == [6, 0]


def test_measures_are_those_of_the_vocabulary():
    pieces, is_byte = quality._vocabulary(quality.PIECES)
    text = "the cat the cat 日本 \U0001f9ff"
    got = quality._Measure(quality.PIECES)([text])
    ids = pieces.encode(text)
    share = np.array(list(Counter(ids).values())) / len(ids)
    assert got["n_tokens"][0] == len(ids)
    assert got["byte_share"][0] == pytest.approx(is_byte[ids].mean())
    assert got["token_entropy"][0] == pytest.approx(-(share * np.log2(share)).sum())
    assert got["chars_per_token"][0] == pytest.approx(15 / len(ids))


@pytest.mark.parametrize(
    ("text", "script"),
    [("abc é", "latin"), ("Привет abc", "cyrillic"), ("日本語", "han"), ("12 !", "none"), ("", "none"), ("ꓐꓑ", "other")],
)
def test_script(text, script):
    assert quality.script_of(text) == script


def test_query_on_unusual_rows(spark, documents, folder):
    line = " ".join(f"word{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, "a b c " * 5000), (4, line), (4, line), (None, line), (5, line + "\n" + line), (6, "x" * 100_000)]
    labels = spark.createDataFrame([(4, 1, 0), (None, 1, None), (5, None, None)], "doc_id long, quality int, toxic int")
    got = QUERIES["op3_fertility_rules"](spark, folder(documents=documents(rows, lang=None), labels=labels)).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r)[:7] for r in got), key=key) == sorted(((i, *brute(t)) for i, t in rows), key=key)
    assert {r.doc_id: r.kept for r in got} == {1: False, 2: False, 3: False, 4: True, 5: False, 6: False, None: True}


def test_query_on_empty_tables(spark, documents, folder):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert QUERIES["op3_fertility_rules"](spark, folder(documents=documents([]), labels=labels)).collect() == []


def test_query_keeps_good_documents(spark):
    table = "/root/testdata/sf0.01"
    got = QUERIES["op3_fertility_rules"](spark, table).join(spark.read.parquet(f"{table}/labels.parquet"), "doc_id").cache()
    texts = dict(spark.read.parquet(f"{table}/documents.parquet").select("doc_id", "text").collect())
    for r in got.collect():
        assert tuple(r[c] for c in (*COUNTS, "base_failed")) == brute(texts[r.doc_id])
    shares = {r.quality: r.kept for r in got.where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert shares[1] > 0.97
    assert shares[0] < 0.5


def test_bands_come_from_all_labelled_documents(spark):
    draw = np.random.default_rng(4)
    words = np.array([f"{a}{b}{n}" for a in "bcdfg" for b in ("at", "orium", "é", "日") for n in range(40)])
    rows = [(i, "xx" if i % 50 else None, " ".join(draw.choice(words[: 40 + i % 700], 60))) for i in range(5000)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(8).cache()
    labels = spark.createDataFrame([*((i, int(i % 10 > 0)) for i in range(5000)), (None, 1), (7, 1)], "doc_id long, quality int")
    got = quality.fit_bands(docs, labels)
    good = quality.measure(docs).where(~quality.base_failed()).where("doc_id % 10 > 0").collect()
    assert ("lang", "xx") in got and any(by == "script" for by, _ in got)
    for (by, name), band in got.items():
        of = {c: [r[c] for r in good if r[by] == name] for c in quality.FITTED}
        ends = {c: np.quantile(of[c], [quality.TAIL, 1 - quality.TAIL]) for c in quality.FITTED}
        want = (*ends["chars_per_token"], *ends["tokens_per_word"], ends["byte_share"][1], ends["token_entropy"][0])
        assert band == pytest.approx(want, rel=1e-12)
