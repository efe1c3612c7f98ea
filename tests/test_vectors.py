"""Vectors and attention (V1, V2, T6, J6, N1-N3) against NumPy brute force and the
stated attention golden."""

import numpy as np
from pyspark.sql import functions as F

from quarry.functions import vectors as vf
from quarry.operators import vectors as vo


def test_attention_golden(spark):
    keys = spark.createDataFrame([(1, [-1.0, -1.0, 3.0]), (2, [1.0, 2.0, -5.0])], "k int, v array<double>")
    q = spark.createDataFrame([(0, [1.0, 2.0, 1.0])], "q int, v array<double>")
    w = {r.k: (r.score, r.weight) for r in vo.attention_weights(keys, "k", "v", q, "q", "v").collect()}
    assert w == {1: (0.0, 0.5), 2: (0.0, 0.5)}
    ctx = sorted((r.dim, r.value) for r in vo.attention_context(keys, "k", "v", q, "q", "v").collect())
    assert ctx == [(0, 0.0), (1, 0.5), (2, -1.0)]


def test_attention_and_topk_match_numpy(spark):
    rng = np.random.default_rng(7)
    K = rng.normal(size=(300, 16))
    Q = rng.normal(size=(4, 16))
    keys = spark.createDataFrame([(i, K[i].tolist()) for i in range(len(K))], "k int, v array<double>")
    qs = spark.createDataFrame([(j, Q[j].tolist()) for j in range(len(Q))], "q int, v array<double>")
    S = Q @ K.T / np.sqrt(16)
    W = np.exp(S - S.max(axis=1, keepdims=True))
    W /= W.sum(axis=1, keepdims=True)
    C = W @ K
    got = {(r.q, r.dim): r.value for r in vo.attention_context(keys, "k", "v", qs, "q", "v").collect()}
    for j in range(4):
        for d in range(16):
            assert abs(got[(j, d)] - C[j, d]) < 1e-9
    wsum = vo.attention_weights(keys, "k", "v", qs, "q", "v").groupBy("q").agg(F.sum("weight").alias("s"))
    assert all(abs(r.s - 1) < 1e-9 for r in wsum.collect())   # softmax sums to 1
    cos = (Q / np.linalg.norm(Q, axis=1, keepdims=True)) @ (K / np.linalg.norm(K, axis=1, keepdims=True)).T
    top = vo.cosine_top_k(keys, "k", "v", qs, "q", "v", 5).collect()
    for j in range(4):
        want = list(np.argsort(-cos[j], kind="stable")[:5])
        assert [r.k for r in sorted((r for r in top if r.q == j), key=lambda r: r.rank)] == want


def test_dot_cosine_and_centroids(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], [3.0, 4.0])], "g int, a array<float>, b array<float>")
    r = df.select(vf.dot("a", "b").alias("d"), vf.cosine("a", "b").alias("c")).first()
    assert r.d == 11.0 and abs(r.c - 11 / (5 ** 0.5 * 5)) < 1e-12
    pts = spark.createDataFrame([(0, [1.0, 3.0]), (0, [3.0, 5.0]), (1, [2.0, 2.0])], "g int, v array<double>")
    c = {r.g: r.centroid for r in vo.centroids(pts, "g", "v").collect()}
    assert c == {0: [2.0, 4.0], 1: [2.0, 2.0]}


def test_topk_plan_limits_before_shuffle(spark):
    keys = spark.range(100).select(F.col("id").alias("k"), F.array(F.rand(1), F.rand(2)).alias("v"))
    qs = spark.createDataFrame([(0, [1.0, 0.0])], "q int, v array<double>")
    plan = vo.cosine_top_k(keys, "k", "v", qs, "q", "v", 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_softmax_over_a_wide_range_of_scores(spark):
    K = np.array([[x, 1.0] for x in (-900.0, -70.0, -1.0, 0.0, 63.9, 64.1, 650.0, 700.0, 700.5, 700.5)])
    Q = np.array([[2.0, 0.0], [-3.0, 1.0], [0.0, 0.0]])
    keys = spark.createDataFrame([(i, v.tolist(), [float(i), 2.0]) for i, v in enumerate(K)], "k int, v array<double>, w array<double>")
    qs = spark.createDataFrame([(j, v.tolist()) for j, v in enumerate(Q)], "q int, v array<double>")
    S = Q @ K.T / np.sqrt(2)
    W = np.exp(S - S.max(axis=1, keepdims=True))
    W /= W.sum(axis=1, keepdims=True)
    got = {(r.q, r.k): r.weight for r in vo.attention_weights(keys, "k", "v", qs, "q", "v").collect()}
    assert all(abs(got[j, i] - W[j, i]) < 1e-12 for j in range(3) for i in range(10))
    C = W @ np.array([[float(i), 2.0] for i in range(10)])
    ctx = {(r.q, r.dim): r.value for r in vo.attention_context(keys, "k", "v", qs, "q", "v", "w").collect()}
    assert all(abs(ctx[j, d] - C[j, d]) < 1e-12 for j in range(3) for d in range(2))
    top = {(r.q, r["rank"]): (r.k, r.weight) for r in vo.attention_weights(keys, "k", "v", qs, "q", "v", k=3).collect()}
    assert len(top) == 9 and [top[0, n][0] for n in (1, 2, 3)] == [8, 9, 7] and top[0, 1][1] == got[0, 8]


def test_attention_of_null_keys_and_empty_tables(spark):
    keys = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "k int, v array<double>")
    qs = spark.createDataFrame([(0, [1.0, 1.0])], "q int, v array<double>")
    assert {r.k: r.weight for r in vo.attention_weights(keys, "k", "v", qs, "q", "v").collect()} == {1: 1.0, 2: None}
    assert sorted((r.dim, r.value) for r in vo.attention_context(keys, "k", "v", qs, "q", "v").collect()) == [(0, 1.0), (1, 0.0)]
    assert vo.attention_weights(keys.limit(0), "k", "v", qs, "q", "v").count() == 0


def test_context_scores_the_keys_once(spark):
    keys = spark.range(50).select(F.col("id").alias("k"), F.array(F.rand(1), F.rand(2)).alias("v"))
    qs = spark.createDataFrame([(0, [1.0, 0.0])], "q int, v array<double>")
    plan = vo.attention_context(keys, "k", "v", qs, "q", "v")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1 and "Join" not in plan
