import random
import re
from itertools import combinations

import numpy as np

from paylake.llm import count_tree
from paylake.llm.queries import QUERIES

NAME = "op12_count_tree"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, words):
    found = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(max(len(found) - words + 1, 1)))


def linked(a, b):
    if not a or not b or 100 * min(len(a), len(b)) < 85 * max(len(a), len(b)):
        return False
    return 100 * len(a & b) >= 85 * len(a | b)


def brute(rows, words=4):
    sets, parent = {}, {}
    for i, text in rows:
        if i is not None:
            sets.setdefault(i, set()).add(shingles(text, words))
            parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(sorted(sets), 2):
        if root(i) != root(j) and any(linked(a, b) for a in sets[i] for b in sets[j]):
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    return [(i, len(shingles(t, words)), None if i is None else root(i)) for i, t in rows]


KEY = lambda r: tuple((x is None, x or 0) for x in r)


def check(rows, result, words=4):
    assert result.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, result.collect()), key=KEY) == sorted(brute(rows, words), key=KEY)


def text_of(numbers):
    return " ".join(f"w{n}" for n in numbers)


def test_query_on_table(spark):
    table = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{table}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, QUERIES[NAME](spark, table))


def test_query_on_unusual_rows(spark, documents, folder):
    base = list(range(100))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two three"), (7, text_of(base)), (7, text_of(base))]
    rows += [(8, "changed " + text_of(base[1:])), (9, text_of(base[:86])), (None, text_of(base)), (10, "É a b c"), (11, "é a b c"), (12, "É A B C")]
    rows += [(20, "first text of a repeated id"), (20, text_of(range(500, 600))), (21, "FIRST text of a repeated id"), (15, text_of(range(500, 599)))]
    rows += [(30, text_of(i % 977 for i in range(200_000))), (31, text_of(i % 977 for i in range(100_000)))]
    rows += [(40, text_of(range(9000, 40_000))), (41, text_of([*range(9000, 39_000), *range(60_000, 61_000)]))]
    check(rows, QUERIES[NAME](spark, folder(documents=documents(rows))))


def test_members_linked_only_through_a_late_one(spark, documents):
    draw = random.Random(5)
    base = list(range(300))

    def changed():
        out = list(base)
        for place in draw.sample(range(5, 290, 8), 5):
            out[place] += 100_000 + draw.randrange(10**6)
        return out

    rows = [(i, text_of(changed())) for i in range(60)] + [(1000, text_of(base))]
    # One group of copies, a chain, and documents that share a passage but are not alike.
    rows += [(2000 + i, text_of(range(5000, 5200))) for i in range(40)]
    rows += [(3000 + i, text_of(range(9000 + 8 * i, 9200 + 8 * i))) for i in range(30)]
    rows += [(4000 + i, text_of([*range(20_000, 20_060), *(10**6 * (i + 1) + k for k in range(25 + i % 30))])) for i in range(80)]
    check(rows, count_tree.group(documents(rows)))


def test_empty_table(spark, documents, folder):
    check([], QUERIES[NAME](spark, folder(documents=documents([]))))


def pair_at(draw, shared, every):
    """Two sets of hashes with as many elements together and apart, dealt at random."""
    element = draw.integers(0, 2**63, every, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    mine = draw.random(every) < draw.random()
    mine[:shared] = False
    one = np.concatenate((element[:shared], element[mine]))
    two = np.concatenate((element[:shared], element[shared:][~mine[shared:]]))
    return np.unique(one), np.unique(two)


def test_linked_sets_share_buckets_even_without_those_they_may_leave():
    """Every linked pair of random sets, from the smallest on, also where each leaves as many buckets as it may."""
    draw = np.random.default_rng(8)
    pairs = []
    for every in [*range(6, 60), 80, 100, 117, 118, 128, 129, 150, 256, 300, 512, 600, 1100, 3000]:
        shared = -(-85 * every // 100)
        for _ in range(60):
            one, two = pair_at(draw, shared, every)
            if 100 * min(len(one), len(two)) >= 85 * max(len(one), len(two)) and not np.array_equal(one, two):
                pairs.append((one, two))
    keys = []
    for k in (0, 1):
        sets = [p[k] for p in pairs]
        own, below = count_tree.bands_of(np.array([len(s) for s in sets]))
        keys.append([count_tree.slice_keys(sets, own), count_tree.slice_keys(sets, below)])
    assert len(pairs) > 2000
    for i in range(len(pairs)):
        # The worst case: all that one of them may leave are common buckets; the other leaves crowded ones alone, too.
        meets = [
            np.intersect1d(a[i], b[i]).size - max(0, spare_a[i], spare_b[i]) for a, spare_a in keys[0] for b, spare_b in keys[1]
        ]
        assert max(meets) > 0, (len(pairs[i][0]), len(pairs[i][1]))


def test_tree_finds_what_all_pairs_would():
    draw = np.random.default_rng(2)
    for count, mean in [(1, 3), (5, 3), (40, 2), (300, 3), (700, 12)]:
        centre = draw.poisson(mean, (max(1, count // 12), count_tree.GROUPS))
        point = (centre[draw.integers(0, len(centre), count)] + (draw.random((count, count_tree.GROUPS)) < 0.08)).astype(np.int32)
        size = point.sum(axis=1).astype(np.int64) + draw.integers(0, 2, count)
        a, b = np.triu_indices(count, 1)
        fit = count_tree.may_link(point[a], size[a], point[b], size[b])
        expected = set(zip(a[fit].tolist(), b[fit].tolist(), strict=True))
        tree = count_tree.Tree(point, size)
        got = [tuple(sorted(p)) for p in zip(*(x.tolist() for x in tree.join(tree)), strict=True)]
        assert len(got) == len(set(got)) and set(got) == expected
        half = count // 3
        one, two = np.arange(half), np.arange(half, count)
        if half:
            x, y = count_tree.Tree(point[one], size[one]).join(count_tree.Tree(point[two], size[two]))
            assert set(zip(one[x].tolist(), two[y].tolist(), strict=True)) == {p for p in expected if p[0] < half <= p[1]}


def test_bound_never_rules_out_a_link():
    draw = np.random.default_rng(3)
    for every in (6, 7, 20, 60, 200, 1000):
        for _ in range(100):
            one, two = pair_at(draw, -(-85 * every // 100), every)
            if 100 * np.intersect1d(one, two).size < 85 * np.union1d(one, two).size:
                continue
            p = count_tree.points([one, two])
            n = np.array([len(one), len(two)])
            assert count_tree.may_link(p[:1], n[:1], p[1:], n[1:])[0]


def test_radius():
    """By trial: the largest difference of a linked pair by the size of its smaller set."""
    for size in range(1, 400):
        largest = 0
        for other in range(size, 100 * size // 85 + 1):
            least = next(s for s in range(size + 1) if 100 * s >= 85 * (size + other - s))
            largest = max(largest, size + other - 2 * least)
        assert count_tree.radius(size) >= largest
        own, below = (int(x[0]) for x in count_tree.bands_of(np.array([size])))
        if largest:
            assert own == size.bit_length()
        # A larger partner across a border is cut for the lower band too.
        for other in range(size + 1, 100 * size // 85 + 1):
            if other.bit_length() > size.bit_length():
                assert int(count_tree.bands_of(np.array([other]))[1][0]) == size.bit_length()


def test_crowded_buckets_are_joined_in_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(count_tree, "BLOCK", 20)
    monkeypatch.setattr(count_tree, "CROWDED", 10)
    draw = random.Random(7)
    rows = []
    # A family in which no member is linked with all others.
    for i in range(150):
        out = list(range(200))
        for place in draw.sample(range(4, 196, 6), draw.choice([1, 2, 3, 4, 5, 6])):
            out[place] += 1000 * draw.choice([1, 2, 3])
        rows.append((i, text_of(out)))
    check(rows, count_tree.group(documents(rows)))
