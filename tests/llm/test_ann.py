import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from paylake.llm import ann
from paylake.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def brute(rows, k=20, step=20):
    vectors = {}
    lengths = [len(v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    common = max(lengths, key=lambda n: (lengths.count(n), n), default=0)
    for i, v in rows:
        if i is not None and v and len(v) == common and all(x is not None and math.isfinite(x) for x in v) and any(v):
            vectors[i] = min(vectors.get(i, v), v)
    out = []
    for q in sorted(vectors):
        if q % step == 0:
            scored = sorted((-float((np.array(vectors[q]) * np.array(v)).sum()), i) for i, v in vectors.items() if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1.0) for i, v in rows], "vec_id long, embedding array<float>, label int, score double")


def recall(got, expected):
    found = {(r[0], r[2]) for r in got}
    return sum((q, v) in found for q, _, v, _ in expected) / len(expected)


@pytest.mark.parametrize("table", [SMALL, "/root/testdata/sf0.1"])
def test_recall_on_table(spark, table):
    rows = [tuple(r) for r in spark.read.parquet(f"{table}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = sorted(map(tuple, QUERIES["op6_one_bit_codes"](spark, table).collect()))
    expected = brute(rows)
    assert len(got) == len(expected)
    assert recall(got, expected) > 0.99
    scores = {i: np.array(v, float) for i, v in rows}
    assert all(s == pytest.approx(float(scores[q] @ scores[v]), abs=1e-12) for q, _, v, s in got)


def test_query_on_unusual_rows(spark, folder, monkeypatch):
    monkeypatch.setattr(ann, "CANDIDATE_BLOCK", 30)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 3)
    draw = np.random.default_rng(2)
    rows = [(i, [float(x) for x in draw.integers(-9, 9, 5) * 3.5]) for i in range(100)]
    hot = [1.0, 2.0, 3.0, -4.0, 0.5]
    rows += [(200 + i, hot) for i in range(60)] + [(40, rows[40][1]), (20, hot)]
    rows += [(300, None), (320, []), (340, [0.0] * 5), (360, [1.0, None, 1.0, 1.0, 1.0]), (380, [float("nan")] * 5)]
    rows += [(400, [float("inf"), 1.0, 1.0, 1.0, 1.0]), (420, [1.0, 2.0]), (None, hot), (440, [1e6] * 5), (-20, [-1e6, 0.0, 0.0, 0.0, 0.0])]
    got = sorted(map(tuple, QUERIES["op6_one_bit_codes"](spark, folder(embeddings=frame(spark, rows))).collect()))
    expected = brute(rows)
    assert [r[:3] for r in got] == [r[:3] for r in expected]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in expected])


@pytest.mark.parametrize("rows", [[], [(0, [1.0])], [(0, [1.0]), (1, [-2.0])], [(20, None)]])
def test_query_on_few_rows(spark, folder, rows):
    got = QUERIES["op6_one_bit_codes"](spark, folder(embeddings=frame(spark, rows))).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_estimates_stay_in_their_bounds():
    draw = np.random.default_rng(4)
    vectors, queries = draw.standard_normal((4000, 64)) * draw.uniform(0.1, 9, (4000, 1)), draw.standard_normal((50, 64))
    turn = ann.rotation(64)
    assert turn.shape == (64, ann.CODE_BITS)
    assert turn @ turn.T == pytest.approx(np.eye(64))
    codes, length, agreement = ann.encode(vectors, turn)
    assert codes.shape == (4000, ann.CODE_BITS // 64) and length == pytest.approx(np.linalg.norm(vectors, axis=1))
    low, high = (np.stack(x) for x in zip(*ann.bounds(ann.rounded(queries, turn), codes, length, agreement), strict=True))
    exact = queries / np.linalg.norm(queries, axis=1)[:, None] @ vectors.T
    assert ((low <= exact) & (exact <= high)).mean() > 0.98
    assert abs(((low + high) / 2 - exact).mean() / length.mean()) < 0.002
    # Bounds that would rule out little are no use.
    assert ((high - low) / length).mean() < 0.25


def test_codes_are_counted_like_the_sums_they_stand_for():
    draw = np.random.default_rng(7)
    vectors, query = draw.standard_normal((300, 70)), draw.standard_normal((1, 70))
    turn = ann.rotation(70)
    codes, _, agreement = ann.encode(vectors, turn)
    planes, low, step, total = ann.rounded(query, turn)
    words = np.ascontiguousarray(codes.T)
    got = ann.cosines(planes[0], low[0], step[0], total[0], words, np.bitwise_count(words).sum(axis=0), agreement)
    turned = (query / np.linalg.norm(query) @ turn)[0]
    values = low[0] + step[0] * np.rint((turned - low[0]) / step[0])
    positive = (vectors / np.linalg.norm(vectors, axis=1)[:, None] @ turn) > 0
    expected = (2 * positive @ values - turned.sum()) / np.sqrt(turn.shape[1]) / agreement
    assert got == pytest.approx(expected)


def double_frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


@pytest.mark.parametrize("scale", [1e-150, 1e-24, 1.0, 1e18, 1e150, None])
def test_all_scales(spark, folder, scale):
    """None: vectors of very different scales beside each other."""
    draw = np.random.default_rng(11)
    rows = []
    for i in range(200):
        own = scale or float(10.0 ** draw.integers(-140, 140))
        rows.append((i, [float(x) for x in draw.standard_normal(16) * own]))
    got = sorted(map(tuple, QUERIES["op6_one_bit_codes"](spark, folder(embeddings=double_frame(spark, rows))).collect()))
    expected = brute(rows)
    assert len(got) == len(expected) == 200
    assert recall(got, expected) > 0.97
    scores = {i: np.array(v) for i, v in rows}
    assert all(s == pytest.approx(float((scores[q] * scores[v]).sum()), rel=1e-9) for q, _, v, s in got)


def test_blocks_hold_codes_alone(spark):
    plan = QUERIES["op6_one_bit_codes"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInPandas" not in plan  # Both passes are done and stored; what is left reranks.


def test_few_candidates_are_reranked(spark, monkeypatch):
    seen = []
    keep = ann.stored
    monkeypatch.setattr(ann, "stored", lambda df, name: seen.append((name, keep(df, name))) or seen[-1][1])
    table = "/root/testdata/sf0.1"
    QUERIES["op6_one_bit_codes"](spark, table).count()
    tables = dict(seen)
    assert not {"vector", "one", "two"} & {*tables["codes"].columns, *tables["queries"].columns}
    # A hundred queries against 2000 rows.
    assert tables["likely"].count() < 0.2 * 100 * 2000
