"""Operator 11 against numpy and exact integers."""

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from pairforge.llm import whitening as W

SF = "/root/testdata/sf0.001"


def matrices():
    draw = np.random.default_rng(3)
    yield "random", draw.standard_normal((40, 40))
    yield "low rank", draw.standard_normal((40, 5)) @ draw.standard_normal((5, 40))
    q = np.linalg.qr(draw.standard_normal((30, 30)))[0]
    yield "clusters", q * np.repeat([5.0, 5.0 + 1e-12, 2.0], 10)
    yield "equal", np.eye(12)
    yield "apart", np.diag(np.arange(1.0, 9))
    yield "blocks", np.kron(np.eye(4), draw.standard_normal((3, 3)))
    yield "one", np.array([[2.0]])
    yield "two", np.array([[2.0, 1.0], [1.0, 3.0]])
    yield "tiny", draw.standard_normal((10, 10)) * 1e-150
    yield "far", np.diag(10.0 ** -np.arange(0, 20)) @ draw.standard_normal((20, 20))


@pytest.mark.parametrize("name,b", list(matrices()))
def test_leading_vectors(name, b):
    a = b @ b.T
    values, vectors = W.leading(a, 8)
    want = np.sort(np.linalg.eigvalsh(a))[::-1][: len(values)]
    size = max(want[0], 1e-300)
    assert np.abs(values - want).max() <= 1e-13 * size * len(a)
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
    assert np.abs(a @ vectors.T - vectors.T * values).max() <= 1e-12 * size


def test_zero_matrix():
    values, vectors = W.leading(np.zeros((3, 3)), 5)
    assert not values.any() and np.array_equal(vectors, np.eye(3))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.floats(-1e9, 1e9), min_size=2, max_size=2), min_size=1, max_size=6), st.integers(1, 5))
def test_moments_of_blocks_are_those_of_the_whole(rows, cut):
    z = np.array(rows)
    m = W.Moments(2)
    for part in (z[:cut], z[cut:]):
        if len(part):
            m.add(part)
    c = z - z.mean(axis=0)
    assert m.n == len(z)
    assert np.allclose(m.products, c.T @ c, rtol=1e-9, atol=1e-6 * max(1, np.abs(z).max()) ** 2)


def expected(rows, k=W.COMPONENTS):
    """Brute force over (id, vector): exact integers and numpy's own solver."""
    good = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) and abs(64 * c) < 2 ** 62 for c in v)]
    lengths = [len(v) for _, v in good]
    d = max(set(lengths), key=lambda x: (lengths.count(x), x))
    good = [(i, v) for i, v in good if len(v) == d]
    n = len(good)
    sums = [sum(v[j] for _, v in good) for j in range(d)]
    y = [[n * v[j] - sums[j] for j in range(d)] for _, v in good]
    z = np.array([[c / n for c in r] for r in y])
    values, vectors = np.linalg.eigh(z.T @ z / n)
    values, vectors = values[::-1][:k], vectors.T[::-1][:k]
    return {"n": n, "dev": [(i, sum(c * c for c in r)) for (i, _), r in zip(good, y)],
            "white": z @ vectors.T / np.sqrt(np.maximum(values, 1e-300)), "explained": values / (z ** 2).mean(axis=0).sum(), "ids": [i for i, _ in good]}


def test_query_equals_brute_force(spark):
    src = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = expected(src)
    got = W.op11_embedding_whitening(spark, SF).collect()
    assert len(got) == len(want["ids"]) * W.COMPONENTS
    by = {(r.vec_id, r.component): r for r in got}
    at = {i: k for k, i in enumerate(want["ids"])}
    signs = np.sign([by[want["ids"][0], c + 1].whitened * want["white"][0, c] for c in range(W.COMPONENTS)])
    for i, dev in want["dev"]:
        for c in range(W.COMPONENTS):
            r = by[i, c + 1]
            assert (r.n, r.deviation) == (want["n"], dev)
            assert abs(r.whitened * signs[c] - want["white"][at[i], c]) < 1e-7
            assert abs(r.explained / want["explained"][c] - 1) < 1e-9
            assert r.identity_error < 1e-9


def run(spark, rows, schema="vec_id long, embedding array<double>, n string"):
    df = spark.createDataFrame(rows, schema)
    model = W.fit_whitening(df)
    return W.whiten(df, model, error=W.identity_error(df, model))


def test_rows_of_every_kind(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], "a"), (1, [1.0, 2.0], "a"), (None, [-3.0, 0.5], "b"), (2, [0.25, 7.0], "c"), (3, None, "d"), (4, [], "e"),
            (5, [1.0, None], "f"), (6, [nan, 1.0], "g"), (7, [1.0, inf], "h"), (8, [1e300, 0.0], "i"), (9, [1.0, 2.0, 3.0], "j")]
    got = run(spark, rows).collect()
    want = expected([r[:2] for r in rows])
    assert sorted(((r.vec_id, r.deviation) for r in got if r.component == 1), key=str) == sorted(want["dev"], key=str)
    assert {r.n for r in got} == {4} and {r.component for r in got} == {1, 2}
    assert max(r.identity_error for r in got) < 1e-9


def test_large_entries_stay_exact(spark):
    rows = [(1, [2.0 ** 50, 1.0], ""), (2, [-(2.0 ** 50), 3.0], ""), (3, [5.0, -1.0], ""), (4, [2.0 ** 20, 8.0], "")]
    want = dict(expected([r[:2] for r in rows])["dev"])
    got = {r.vec_id: r.deviation for r in run(spark, rows).collect()}
    assert got == {i: v if v < 1 << 63 else None for i, v in want.items()}
    rows = [(i, [2.0 ** 20 * i, 1.0 * i * i], "") for i in range(1, 6)]
    assert {r.vec_id: r.deviation for r in run(spark, rows).collect()} == dict(expected([r[:2] for r in rows])["dev"])


def test_no_variance_and_empty_table(spark):
    got = run(spark, [(1, [1.0, 2.0, 5.0], ""), (2, [1.0, 2.0, 5.0], "")]).collect()
    assert len(got) == 6 and all(r.whitened is None and r.explained == 0 and r.identity_error is None and r.deviation == 0 for r in got)
    one_way = run(spark, [(1, [1.0, 2.0], ""), (2, [2.0, 4.0], ""), (3, [5.0, 10.0], "")]).collect()
    assert all((r.whitened is None) == (r.component == 2) and r.identity_error < 1e-9 for r in one_way)
    assert run(spark, []).collect() == []
    assert run(spark, [(1, None, "")]).collect() == []
