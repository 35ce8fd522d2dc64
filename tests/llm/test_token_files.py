import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from paylake.llm import bpe, token_files
from paylake.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(bpe.WORD_BPE)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 2**16), st.integers(0, 2**64 - 1)), max_size=300), st.integers(1, 70))
def test_words_give_back_the_ids(values, block):
    ids = np.array(values, np.uint64)
    words, per_block = token_files.encode_words(ids, block)
    assert token_files.decode_words(words).tolist() == values
    edges = np.concatenate(([0], np.cumsum(per_block)))
    for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        assert token_files.decode_words(words[a:b]).tolist() == values[i * block : (i + 1) * block]


def test_words_are_as_few_as_the_widths_allow():
    words, _ = token_files.encode_words(np.array([1] * 60 + [2**15 - 1] * 8 + [2**60 - 1], np.uint64))
    assert len(words) == 1 + 2 + 1


def expected(rows):
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def check(rows, result):
    assert sorted((tuple(r) for r in result.collect()), key=lambda r: r[1]) == expected(rows)


def test_query_on_table(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    check([tuple(r) for r in rows], QUERIES["op7_token_files"](spark, SMALL))


@pytest.mark.parametrize("at_once", [1, 256])
def test_query_on_unusual_rows(spark, documents, folder, monkeypatch, at_once):
    monkeypatch.setattr(token_files, "BLOCKS_AT_ONCE", at_once)
    rows = [(9, None), (2, ""), (7, "twice"), (7, "twice"), (7, "other"), (None, "no id"), (-5, "word " * 9000), (4, "x" * 30_000)]
    rows += [(100 + i, "same few words") for i in range(300)]
    check(rows, QUERIES["op7_token_files"](spark, folder(documents=documents(rows))))


def test_query_on_empty_table(spark, documents, folder):
    check([], QUERIES["op7_token_files"](spark, folder(documents=documents([]))))


def first_fit(ids, block):
    """The selector of each word, one id after another."""
    chosen = []
    for a in range(0, len(ids), block):
        part = ids[a : a + block]
        while part:
            fits = [k for k, (c, w) in enumerate(zip(token_files.COUNTS, token_files.WIDTHS, strict=True), 1) if c <= len(part) and all(x >> int(w) == 0 for x in part[:c])]
            chosen.append(fits[0] if fits else token_files.ESCAPE)
            part = part[int(token_files.TAKEN[chosen[-1]]) :]
    return chosen


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 61), st.integers(1, 70)), max_size=12), st.integers(1, 150))
def test_each_word_takes_as_many_ids_as_fit(runs, block):
    ids = [(1 << bits) - 1 for bits, number in runs for _ in range(number)]
    words, _ = token_files.encode_words(np.array(ids, np.uint64), block)
    selectors, whole = [], False
    for word in words.tolist():
        if not whole:
            selectors.append(word >> 60)
        whole = not whole and word >> 60 == token_files.ESCAPE
    assert selectors == first_fit(ids, block)
