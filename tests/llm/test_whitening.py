import math
from fractions import Fraction

import numpy as np
import pytest

from paylake.llm import whitening
from paylake.llm.queries import QUERIES

NAME = "op11_exact_whitening"
SCHEMA = "vec_id long, embedding array<float>, label int, component string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)


def sound(rows):
    good = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    lengths = [len(v) for _, v in good]
    common = max(lengths, key=lambda n: (lengths.count(n), n), default=0)
    clamp = lambda x: max(-(2**63), min(2**63 - 1, math.floor(64 * float(np.float32(x))) ))
    return [(i, [clamp(x) + 1_000_000 for x in v]) for i, v in good if len(v) == common], common


def check(rows, got, exact_vectors=True):
    """Every column against plain numpy and exact fractions."""
    rows, d = sound(rows)
    k = min(16, d)
    assert len(got) == len(rows) * k
    fit = sorted({tuple(x) for _, x in rows})
    n = len(fit)
    sums = [sum(c) for c in zip(*fit, strict=True)]
    centred = {x: [n * a - s for a, s in zip(x, sums, strict=True)] for x in fit}
    by_id = {}
    for r in got:
        by_id.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    scaled = np.array([[float(Fraction(a, n)) for a in centred[x]] for x in fit])
    covariance = scaled.T @ scaled / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    trace = covariance.trace()
    assert {r.n for r in got} == {n}
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and max(errors) <= 1e-4
    for r in got:
        assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-4, abs=1e-12)
    axes = {}
    for i, x in rows:
        deviation = sum(a * a for a in centred[tuple(x)])
        own = by_id[i, deviation if deviation < 2**63 else None]
        assert sorted(own) == list(range(1, k + 1))
        z = np.array([float(Fraction(a, n)) for a in centred[tuple(x)]])
        for c in range(1, k + 1):
            if values[c - 1] <= 1e-9 * trace:
                assert all(r.whitened is None and r.explained == 0 for r in own[c])
                continue
            axes.setdefault(c, []).append((z, own[c][0].whitened * math.sqrt(values[c - 1])))
    if exact_vectors:
        for c, pairs in axes.items():
            z, w = (np.array(p) for p in zip(*pairs, strict=True))
            expected = z @ vectors[:, c - 1]
            sign = np.sign(expected @ w)
            assert np.allclose(w, sign * expected, atol=1e-8 * math.sqrt(trace))


@pytest.mark.parametrize("sf", ["0.001", "0.1"])
def test_query_on_table(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(rows, QUERIES[NAME](spark, folder).collect())


def test_query_on_unusual_rows(spark, folder):
    draw = np.random.default_rng(3)
    rows = [(i, [float(x) for x in draw.normal(size=20) * np.arange(1, 21)]) for i in range(150)]
    rows += [(1000 + i, rows[7][1]) for i in range(80)] + [(7, rows[7][1]), (None, rows[8][1]), (7, rows[9][1])]
    rows += [(300, None), (301, []), (302, [0.0] * 20), (303, [1.0, None] * 10), (304, [float("nan")] * 20), (305, [float("inf")] * 20), (306, [1.0] * 19)]
    table = frame(spark, rows)
    check(rows, QUERIES[NAME](spark, folder(embeddings=table)).collect())


def test_missing_variance_and_equal_eigenvalues(spark):
    # Three dimensions are constant or repeat others; four have the same variance.
    rows = [(i, [float((i >> k) & 1) for k in range(4)] + [5.0, float(i & 1), 0.0]) for i in range(16)]
    got = whitening.embeddings_whitened(frame(spark, rows)).collect()
    check(rows, got, exact_vectors=False)
    assert {r.component for r in got if r.whitened is None} == {5, 6, 7}
    w = np.array([[r.whitened for r in sorted(got, key=lambda r: (r.vec_id, r.component)) if r.vec_id == i and r.component < 5] for i in range(16)])
    assert np.allclose(w.T @ w / 16, np.eye(4), atol=1e-12)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    assert whitening.embeddings_whitened(frame(spark, rows)).collect() == []


def test_one_vector(spark):
    got = whitening.embeddings_whitened(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert sorted(map(tuple, got)) == [(i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)]


def test_huge_entries(spark):
    draw = np.random.default_rng(5)
    rows = [(i, [float(x) for x in draw.normal(size=6)]) for i in range(60)] + [(100, [1e15, -1e16, 3.0, 0.0, 1.0, 2.0]), (101, [1e30, 1.0, 0.0, 2.0, 0.0, 1.0])]
    got = whitening.embeddings_whitened(frame(spark, rows)).collect()
    assert len(got) == 62 * 6 and {r.identity_error < 1e-9 for r in got} == {True}
    # By the trace, exactly: the shares sum to one.
    assert sum({r.component: Fraction(r.explained) for r in got}.values()) == pytest.approx(1, abs=1e-12)
    assert all(r.whitened is not None for r in got)


def test_products_are_exact():
    draw = np.random.default_rng(1)
    for top in (5, 2**19, 2**20, 2**40, 2**63 - 1):
        rows = draw.integers(-top - 1, top, (50, 4), dtype=np.int64, endpoint=True)
        exact = rows.astype(object)
        assert (whitening.products(rows) == exact.T @ exact).all()


def test_characteristic_polynomial(spark):
    draw = np.random.default_rng(2)
    for n, rank in [(1, 1), (2, 2), (5, 5), (9, 4)]:
        b = draw.integers(-1000, 1000, (rank, n)).astype(object)
        square = b.T @ b
        got = whitening.characteristic(spark, square)
        # Newton's identities from traces of powers.
        power, sums = np.eye(n, dtype=int).astype(object), []
        for _ in range(n):
            power = power @ square
            sums.append(int(power.trace()))
        elementary = [Fraction(1)]
        for k in range(1, n + 1):
            elementary.append(sum((-1) ** (i - 1) * elementary[k - i] * sums[i - 1] for i in range(1, k + 1)) / k)
        assert got == [(-1) ** (n - k) * elementary[n - k] for k in range(n + 1)]


def test_roots_are_isolated():
    poly = [1]
    true = [0, 0, 3, 3, 3, 10, 10**9, 10**9 + 1, 10**30]
    for r in true:
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0], strict=True)]
    found = whitening.Roots(poly).largest(9)
    assert [m for *_, m in found] == [1, 1, 1, 1, 3]
    for (a, f, _), r in zip(found, (10**30, 10**9 + 1, 10**9, 10, 3), strict=True):
        assert abs(Fraction(a, 2**f) - r) < Fraction(1, 2**200)
    assert [m for *_, m in whitening.Roots(poly).largest(5)] == [1, 1, 1, 1, 3]
    assert [m for *_, m in whitening.Roots(poly).largest(2)] == [1, 1]
