import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, components=16):
    """vec_id, x, and the model by a dense eigendecomposition of exactly centred vectors."""
    good = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(np.float32(c)) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    c = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for x in fit])
    values, vectors = np.linalg.eigh(c.T @ c / n)
    keep = [k for k in range(len(values))[::-1] if values[k] > 1e-12 * values[-1]][:components]
    return good, n, sums, values[keep], vectors[:, keep], np.trace(c.T @ c / n)


def check(out, rows, components=16):
    good, n, sums, values, vectors, trace = brute(rows, components)
    k = len(values)
    assert len(out) == len(good) * k
    want = {}
    for i, x in good:
        c = np.array([(n * a - s) / n for a, s in zip(x, sums)])
        dev = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        want.setdefault(i, []).append((dev if dev < 1 << 63 else None, c @ vectors / np.sqrt(values)))
    white = {}
    for r in out:
        assert r.n == n and r.identity_error <= 1e-4 and 1 <= r.component <= k
        assert abs(r.explained - values[r.component - 1] / trace) <= 1e-9 * r.explained
        assert r.deviation in {d for d, _ in want[r.vec_id]}
        white.setdefault(r.component, []).append((r.vec_id, r.deviation, r.whitened))
    for j in range(k):
        got = {}
        for i, d, w in white[j + 1]:
            got.setdefault((i, d), []).append(w)
        ours = np.concatenate([sorted(got[key], key=abs) for key in sorted(got, key=str)])
        theirs = {}
        for i, found in want.items():
            for d, w in found:
                theirs.setdefault((i, d), []).append(w[j])
        theirs = np.concatenate([sorted(theirs[key], key=abs) for key in sorted(theirs, key=str)])
        sign = np.sign(ours @ theirs)
        assert np.abs(ours - sign * theirs).max() < 1e-8, j + 1


@pytest.mark.parametrize("n, d", [(300, 48), (200, 20), (10, 24), (2, 3)])
def test_equals_dense_decomposition(spark, n, d):
    r = np.random.default_rng(n)
    data = (r.standard_normal((n, d)) * np.linspace(0.3, 1, d)).astype(np.float32).tolist()
    rows = list(enumerate(data)) + [(900 + i, data[0]) for i in range(n // 3)] + [(0, data[1]), (None, data[0])]
    check(W.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect(), rows)


def test_the_block_iteration_finds_close_eigenvalues():
    r = np.random.default_rng(3)
    q = np.linalg.qr(r.standard_normal((200, 200)))[0]
    values = np.sort(np.concatenate([1 + r.random(100) * 0.2, r.random(100)]))[::-1]
    a = (q * values) @ q.T
    calls = []
    got, vectors = W.subspace_iteration(lambda b: (calls.append(1), a @ b)[1], 200, 16)
    assert np.abs(got - values[:16]).max() < 1e-12
    assert np.abs(np.abs((vectors * q[:, :16]).sum(axis=0)) - 1).max() < 1e-9
    assert len(calls) < 1000


def test_equal_eigenvalues_and_low_rank():
    for a in (np.eye(100), np.zeros((100, 100)), np.diag([5.0, 5.0, 1.0] + [0.0] * 97)):
        values, vectors = W.subspace_iteration(lambda b: a @ b, 100, 16)
        assert np.abs(values - np.sort(np.diag(a))[::-1][:16]).max() < 1e-12
        assert np.abs(vectors.T @ vectors - np.eye(16)).max() < 1e-12


def test_edge_rows(spark):
    """Null vectors and entries, NaN, infinities, other lengths, huge entries, copies, null ids, clashing names."""
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (2, [0.25, -3.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 0.0]), (7, []),
            (None, [0.5, 1.0]), (2, [0.75, 0.1]), (8, [0.5, 1.0])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("x", F.lit("clash")).withColumn("n", F.lit("clash"))
    check(W.whiten(df).collect(), rows)
    odd = spark.createDataFrame(rows + [(9, [1.0, 2.0, 3.0])], SCHEMA)
    assert {r.vec_id for r in W.whiten(odd).collect()} == {1, 2, None, 8}
    huge = [(1, [1e30, 0.0]), (2, [0.0, 1.0]), (3, [-1e30, 1.0])]
    out = W.whiten(spark.createDataFrame(huge, SCHEMA)).collect()
    assert all(r.deviation is None or r.deviation >= 0 for r in out) and {r.n for r in out} == {3}


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert W.whiten(empty).collect() == []
    assert W.whiten(empty).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert W.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).collect() == []


def test_registered_query_over_the_whole_table(spark):
    from tillroll.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(QUERIES["op12_whitening"](spark, sf).collect(), rows)
