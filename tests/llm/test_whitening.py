"""Operator 11 against plain integers and numpy."""

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from silverbrook.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, n int, X string, Component int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v and [None if c is None else float(c) for c in v], 1, "x", 2) for i, v in rows], SCHEMA).repartition(3)


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def brute(rows, components=4):
    """``[(vec_id, component, n, deviation, |whitened|, explained)]`` of vectors of one width."""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows if usable(v)]
    distinct = sorted({tuple(x) for _, x in kept})
    n, width = len(distinct), len(distinct[0])
    sums = [sum(x[j] for x in distinct) for j in range(width)]
    centred = [[Fraction(n * x[j] - sums[j], n) for j in range(width)] for x in distinct]
    cov = [[sum(c[i] * c[j] for c in centred) / n for j in range(width)] for i in range(width)]
    values, vectors = np.linalg.eigh(np.array([[float(v) for v in row] for row in cov]))
    trace, out = float(sum(cov[i][i] for i in range(width))), []
    for i, x in kept:
        y = np.array([float(Fraction(n * x[j] - sums[j], n)) for j in range(width)])
        deviation = sum((n * x[j] - sums[j]) ** 2 for j in range(width))
        for k in range(min(components, width)):
            e, d = values[-1 - k], vectors[:, -1 - k]
            out.append((i, k + 1, n, deviation, abs(y @ d) / math.sqrt(e), e / trace))
    return out


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(3)
    mix = draw.standard_normal((6, 6)) * np.array([3, 2, 1, 0.7, 0.4, 0.2])
    vectors = (draw.standard_normal((150, 6)) @ mix.T + 40).astype(np.float32).tolist()
    odd = [(900, None), (901, [0.0, None, 1, 1, 1, 1]), (902, [float("nan")] + [0.0] * 5), (903, [float("inf")] + [0.0] * 5)]
    copies = [(1000 + i, vectors[0]) for i in range(200)] + [(5, vectors[9]), (None, vectors[3])]
    return [*enumerate(vectors), *odd, *copies]


def test_whitening_equals_exact_arithmetic(spark, rows):
    found = whitening.whiten(frame(spark, rows)).collect()
    want = sorted(brute(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1], r[4]))
    have = sorted(found, key=lambda r: (r.vec_id is None, r.vec_id or 0, r.component, abs(r.whitened)))
    assert len(have) == len(want)
    for r, w in zip(have, want, strict=True):
        assert (r.vec_id, r.component, r.n, r.deviation) == w[:4]
        assert math.isclose(abs(r.whitened), w[4], rel_tol=1e-7, abs_tol=1e-7)
        assert math.isclose(r.explained, w[5], rel_tol=1e-9)
        assert 0 <= r.identity_error <= 1e-9
    # One sign a component: whitened values of the fit list sum to 0.
    fit = {}
    for r in found:
        fit.setdefault((r.component, r.deviation, round(r.whitened, 9)), r.whitened)
    for k in range(1, 5):
        assert abs(sum(v for (c, *_), v in fit.items() if c == k)) < 1e-6


def test_whitening_does_not_depend_on_partitions(spark, rows):
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained"]
    one = whitening.whiten(frame(spark, rows).coalesce(1)).select(columns).collect()
    many = whitening.whiten(frame(spark, rows).repartition(7)).select(columns).collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(-(2**62), 2**62), min_size=3, max_size=3), min_size=1, max_size=8))
def test_covariances_from_variances_are_exact(vectors):
    totals, squares = whitening.pair_sums(np.array(vectors, dtype=np.int64))
    n = len(vectors)
    found = whitening.covariance(n, [int(t) for t in totals], [int(s) for s in squares])
    mean = [Fraction(sum(v[i] for v in vectors), n) for i in range(3)]
    for i in range(3):
        for j in range(3):
            assert found[i][j] == sum((v[i] - mean[i]) * (v[j] - mean[j]) for v in vectors) / n


@given(st.integers(-(10**40), 10**40))
def test_digits_add_up(value):
    assert sum(d << (40 * place) for place, d in whitening.digits(value)) == value


def test_whitening_on_awkward_tables(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None), (2, []), (3, [None])])).collect() == []
    # One distinct vector: no component has variance.
    same = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same] == [(1, 0, 0.0, 0.0, 0.0)] * 4
    # Each width is a space of its own.
    mixed = whitening.whiten(frame(spark, [(1, [1.0]), (2, [3.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0])])).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation) for r in mixed) == [
        (1, 1, 2, 512**2), (2, 1, 2, 512**2), (3, 1, 2, 2 * 256**2), (3, 2, 2, 2 * 256**2), (4, 1, 2, 2 * 256**2), (4, 2, 2, 2 * 256**2)
    ]
    assert {round(abs(r.whitened), 12) for r in mixed} == {1.0, 0.0}
    # Entries near the ends of a long: deviations beyond it are null, nothing else is lost.
    large = whitening.whiten(frame(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 9.0])])).collect()
    assert len(large) == 6 and all(r.deviation is None or r.vec_id == 3 for r in large)
    assert all(math.isfinite(r.whitened) for r in large)
