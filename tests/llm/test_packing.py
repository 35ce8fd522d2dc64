import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from paylake.llm import bpe, packing
from paylake.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(bpe.WORD_BPE)


def fewest(items, capacity):
    """The least number of sequences, by trying everything."""
    items = sorted(items, reverse=True)
    best = len(items)

    def search(i, spaces):
        nonlocal best
        if len(spaces) >= best and i < len(items):
            return
        if i == len(items):
            best = min(best, len(spaces))
            return
        for space in {s for s in spaces if s >= items[i]}:
            rest = list(spaces)
            rest.remove(space)
            search(i + 1, [*rest, space - items[i]])
        search(i + 1, [*spaces, capacity - items[i]])

    search(0, [])
    return best


@settings(max_examples=400, deadline=None)
@given(st.integers(6, 24).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=9))))
def test_reduction_keeps_the_optimum(case):
    capacity, items = case
    fixed, rest = packing.reduce(Counter(items), capacity)
    assert all(sum(m) <= capacity for _, m in fixed)
    left = list(Counter(rest).elements())
    assert Counter(n for k, m in fixed for n in m * k) + Counter(left) == Counter(items)
    assert sum(k for k, _ in fixed) + fewest(left, capacity) == fewest(items, capacity)


def one_by_one(items, capacity):
    spaces = []
    for n in sorted(items, reverse=True):
        fit = min((s for s in spaces if s >= n), default=None)
        if fit is None:
            spaces.append(capacity - n)
        else:
            spaces.remove(fit)
            spaces.append(fit - n)
    return sorted(spaces)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120))
def test_best_fit_by_length_is_best_fit(items):
    patterns = packing.best_fit(Counter(items), 50)
    assert sorted(50 - sum(m) for k, m in patterns for _ in range(k)) == one_by_one(items, 50)
    assert Counter(n for k, m in patterns for n in m * k) == Counter(items)


def check(rows, result, capacity=4096):
    expected = []
    for i, text in rows:
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]
        for p, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            expected.append((i, p, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = result.collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(expected, key=key)
    filled = defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for places in filled.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    assert len(filled) <= len(one_by_one([e[3] for e in expected], capacity))
    return len(filled), sum(e[3] for e in expected)


def test_query_on_table(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    number, total = check([tuple(r) for r in rows], QUERIES["op2_best_fit_packing"](spark, SMALL))
    assert number <= -(-total // 4096) + 1


def test_query_on_unusual_rows(spark, documents, folder, monkeypatch):
    monkeypatch.setattr(packing, "NUMBERED_TOGETHER", 3)
    rows = [(1, None), (2, ""), (3, "word " * 4095), (4, "word " * 4096), (5, "word " * 9000), (6, "x" * 20000)]
    rows += [(7, "twice"), (7, "twice"), (None, "no id"), *((10 + i, "same few words") for i in range(50))]
    check(rows, QUERIES["op2_best_fit_packing"](spark, folder(documents=documents(rows))))


def test_query_on_empty_table(spark, documents, folder):
    assert QUERIES["op2_best_fit_packing"](spark, folder(documents=documents([]))).collect() == []


def batches_read(plan):
    """The batches that came out of the files under a plan."""
    own = plan.metrics().get("numInputBatches")
    found = own.get().value() if own.isDefined() else 0
    below = plan.children()
    return found + sum(batches_read(below.apply(i)) for i in range(below.size()))


def test_texts_are_read_a_bounded_batch_at_a_time(spark, documents, folder):
    spark.conf.unset("spark.sql.parquet.columnarReaderBatchSize")
    path = folder(documents=documents([(i, "some words " * 50) for i in range(3000)]).coalesce(1))
    cut = packing.pieces(spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text"))
    assert len(cut.collect()) == 3000
    assert batches_read(cut._jdf.queryExecution().executedPlan()) >= 3000 // 512
