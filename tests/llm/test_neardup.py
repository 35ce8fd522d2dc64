import random
import re
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from paylake.llm import neardup
from paylake.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, words):
    found = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(max(len(found) - words + 1, 1)))


def brute(rows, words=2):
    """(doc_id, n_shingles, component_id, kept) by comparing all pairs of documents."""
    sets, parent = {}, {}
    for i, text in rows:
        if i is not None:
            sets.setdefault(i, set()).add(shingles(text, words))
            parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def linked(a, b):
        if not a or not b or 5 * min(len(a), len(b)) < 4 * max(len(a), len(b)):
            return False
        return 100 * len(a & b) >= 80 * len(a | b)

    for i, j in combinations(sorted(sets), 2):
        if root(i) != root(j) and any(linked(a, b) for a in sets[i] for b in sets[j]):
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    return [(i, len(shingles(t, words)), *((None, True) if i is None else (root(i), root(i) == i))) for i, t in rows]


KEY = lambda r: tuple((x is None, x or 0) for x in r)


def check(rows, result, words=2):
    assert sorted((tuple(r) for r in result.collect()), key=KEY) == sorted(brute(rows, words), key=KEY)


def test_query_on_table(spark):
    table = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{table}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, QUERIES["op8_superminhash"](spark, table))


def text_of(numbers):
    return " ".join(f"w{n}" for n in numbers)


def test_query_on_unusual_rows(spark, documents, folder):
    base = list(range(100))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, text_of(base)), (7, text_of(base))]
    rows += [(8, "changed " + text_of(base[1:])), (9, text_of(base[:80])), (None, text_of(base)), (10, "É a"), (11, "é a")]
    rows += [(20, "first text of a repeated id"), (20, text_of(range(500, 600))), (21, "FIRST text of a repeated id"), (15, text_of(range(500, 600)))]
    rows += [(30, text_of(i % 977 for i in range(200_000))), (31, text_of(i % 977 for i in range(100_000)))]
    check(rows, QUERIES["op8_superminhash"](spark, folder(documents=documents(rows))))


def test_members_linked_only_through_a_late_one(spark, documents):
    # Each of many documents differs from the one in the middle a little and from each other too much.
    draw = random.Random(5)
    base = list(range(120))

    def changed():
        out = list(base)
        for place in draw.sample(range(5, 115, 3), 5):
            out[place] += 100_000 + draw.randrange(10**6)
        return out

    rows = [(i, text_of(changed())) for i in range(60)] + [(1000, text_of(base))]
    # And one group of copies, near copies and a chain.
    rows += [(2000 + i, text_of(range(5000, 5200))) for i in range(40)]
    rows += [(3000 + i, text_of(range(9000 + 8 * i, 9200 + 8 * i))) for i in range(30)]
    check(rows, neardup.group(documents(rows), 2))
    check(rows, neardup.group(documents(rows), 5), 5)


def test_query_on_empty_table(spark, documents, folder):
    check([], QUERIES["op8_superminhash"](spark, folder(documents=documents([]))))


@pytest.mark.parametrize("shared", [20, 400])
def test_signatures_estimate_similarity(shared):
    draw = np.random.default_rng(3)
    errors = []
    for _ in range(60):
        common = draw.integers(0, 2**63, shared, dtype=np.uint64)
        a, b = (np.unique(np.concatenate((common, draw.integers(0, 2**63, shared // 4, dtype=np.uint64)))) for _ in range(2))
        one, two = neardup.signatures([a, b])
        errors.append((one == two).mean() - shared / (shared + 2 * (shared // 4)))
    assert abs(np.mean(errors)) < 0.01
    # No more spread than independent minima would have.
    assert np.std(errors) < 1.15 * np.sqrt((2 / 3) * (1 / 3) / neardup.SLOTS)


def test_orders_are_permutations():
    keys = np.random.default_rng(1).integers(0, 2**63, 300, dtype=np.uint64)
    visited = np.stack([neardup.order(keys, rank) for rank in range(neardup.SLOTS)])
    assert (np.sort(visited, axis=0) == np.arange(neardup.SLOTS)[:, None]).all()


def test_random_pairs_at_the_threshold_share_a_band():
    """Over 60,000 pairs at just 0.8, of which independent slots would let 0.008 share no band."""
    draw = np.random.default_rng(44)
    missed = 0
    for shared in (28, 32, 36, 40, 100, 160):
        own = shared // 4
        for _ in range(10):
            every = draw.integers(0, 2**63, (1000, shared + own), dtype=np.uint64)
            cut = draw.integers(0, own + 1, 1000)
            one = [np.concatenate((e[:shared], e[shared : shared + c])) for e, c in zip(every, cut, strict=True)]
            two = [np.concatenate((e[:shared], e[shared + c :])) for e, c in zip(every, cut, strict=True)]
            keys = [neardup.band_keys(neardup.signatures(s)) for s in (one, two)]
            missed += int((keys[0] != keys[1]).all(axis=1).sum())
    assert missed == 0


def pairs_at_threshold(draw, sizes):
    """Two word lists for each (shared, all) of ``sizes``: what only one has is dealt to the two at random."""
    out = []
    for shared, every in sizes:
        words = [f"w{draw.randrange(10**12)}" for _ in range(every)]
        side = [draw.random() < 0.5 for _ in words]
        out.append(tuple(words[:shared] + [w for w, s in zip(words[shared:], side, strict=False) if s == x] for x in (True, False)))
    return out


def linked_ids(spark, documents, pairs):
    rows = [(2 * i + k, " ".join(words)) for i, both in enumerate(pairs) for k, words in enumerate(both)]
    found = neardup.group(documents(rows), 1).where("not kept").collect()
    assert all((r.doc_id, r.component_id) == (r.component_id + 1, r.component_id) and r.component_id % 2 == 0 for r in found)
    return {r.component_id // 2 for r in found}


def test_pairs_of_a_bucket_at_the_threshold_are_linked(spark, documents):
    pairs = pairs_at_threshold(random.Random(21), [(4 * k, 5 * k) for k in range(1, 13)] * 700)
    keys = [neardup.band_keys(neardup.signatures(neardup.shingle_sets([" ".join(p[k]) for p in pairs], 1))) for k in (0, 1)]
    share = (keys[0] == keys[1]).any(axis=1)
    assert share.mean() > 0.99
    assert set(np.flatnonzero(share).tolist()) <= linked_ids(spark, documents, pairs)


def test_small_sets_at_the_threshold_are_all_found(spark, documents):
    # 4 of 5 elements shared, up to 24 of 30, also with one set inside the other; of 8 to 10 and more, the bands miss some.
    sizes = [(4 * k, 5 * k) for k in (1, 1, 1, 2, 2, 3, 4, 5, 6)] + [(5, 6), (9, 11), (23, 28)]
    pairs = pairs_at_threshold(random.Random(33), sizes * 700)
    assert linked_ids(spark, documents, pairs) == set(range(len(pairs)))


def test_linked_small_sets_share_an_exact_key():
    draw = np.random.default_rng(12)
    for small in range(1, neardup.SMALL + 1):
        for large in range(small, neardup.LARGEST_PARTNER + 1):
            for shared in range(1, small + 1):
                if 100 * shared < 80 * (small + large - shared) or small == large == shared:
                    continue
                for _ in range(5):
                    every = draw.integers(0, 2**63, small + large - shared, dtype=np.uint64)
                    one, two = neardup.bucket_keys([np.sort(every[:small]), np.sort(every[small - shared :])])
                    assert np.intersect1d(one, two).size


def test_parities_never_rule_out_a_link(spark):
    draw = np.random.default_rng(4)
    rows = []
    for shared, own in [(4, 1), (8, 2), (79, 20), (80, 20), (80, 21), (60, 40), (800, 200), (800, 300), (20_000, 5000)] * 20:
        common = draw.integers(0, 2**63, shared, dtype=np.uint64)
        extra = draw.integers(0, 2**63, own, dtype=np.uint64)
        cut = draw.integers(0, own + 1)
        a, b = (np.unique(np.concatenate((common, e))) for e in (extra[:cut], extra[cut:]))
        one, two = neardup.parities([a, b])
        rows.append((len(a), len(b), one.tolist(), two.tolist(), 100 * shared >= 80 * (shared + own), shared, own))
    df = spark.createDataFrame(rows, "n long, m long, a array<bigint>, b array<bigint>, linked boolean, shared int, own int")
    got = df.withColumn("may", neardup.may_link(F.col("n"), F.col("m"), F.col("a"), F.col("b"))).collect()
    assert all(r.may for r in got if r.linked)
    assert not any(r.may for r in got if (r.shared, r.own) in ((60, 40), (800, 300)))


@pytest.mark.parametrize("one_task", [0, neardup.ONE_TASK])
def test_components(spark, monkeypatch, one_task):
    monkeypatch.setattr(neardup, "ONE_TASK", one_task)
    draw = random.Random(1)
    links = [(i, i + 1) for i in range(100, 300)] + [(0, i) for i in range(400, 700)] + [(draw.randrange(1000, 3000), draw.randrange(1000, 3000)) for _ in range(900)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in links:
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    found = neardup.components(spark.createDataFrame(links, "u long, v long").repartition(7))
    assert sorted(map(tuple, found.collect())) == sorted((x, root(x)) for x in parent if root(x) != x)
