"""The exact vector index against NumPy brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators.vector_index import VectorIndex, nearest

DDL = "id long, v array<double>"


def brute(keys, queries, k):
    """(query, rank) -> id, similarities summed in the order of the vector."""
    def dot(a, b):
        total = 0.0
        for x, y in zip(a, b):
            total += x * y
        return total
    out = []
    for q, u in queries:
        scored = sorted(((-dot(u, v) / (dot(u, u) ** 0.5 * dot(v, v) ** 0.5), i) for i, v in keys))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def rows(df):
    return sorted((r.q, r.rank, r.id, r.similarity) for r in df.collect())


@pytest.mark.parametrize("sizes", [{}, {"key_block": 7, "query_block": 3, "most_cells": 5}])
def test_equals_brute_force(spark, sizes):
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(6, 8))
    vectors = [(middles[i % 6] + 0.2 * rng.normal(size=8)).tolist() for i in range(240)]
    vectors[100:140] = [vectors[0]] * 40                       # copies, more than k
    vectors[140:145] = [[2 * x for x in vectors[1]]] * 5       # same direction, another length
    keys = list(enumerate(vectors))
    asked = [(i, v) for i, v in keys if i % 10 == 0] + [(900, rng.normal(size=8).tolist()), (901, vectors[0])]
    got = nearest(spark.createDataFrame(keys, DDL), "id", "v", spark.createDataFrame(asked, "q long, v array<double>"),
                  "q", "v", 7, **sizes)
    assert rows(got) == brute(keys, asked, 7)


def test_unusable_vectors_and_empty_tables(spark):
    keys = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, float("nan")]), (5, [float("inf"), 1.0]),
            (6, [1.0]), (7, [None, 1.0]), (None, [1.0, 0.0]), (8, [-1.0, -0.0]), (9, [-1.0, 0.0]), (9, [-1.0, 0.0])]
    ks = spark.createDataFrame(keys, DDL).withColumn("rank", F.lit("x")).withColumn("cell", F.lit(1))
    qs = spark.createDataFrame([(1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 0.0]), (3, None), (None, [-1.0, 0.0])], "q long, v array<double>")
    got = sorted(((r.q or 0, r.rank, r.id) for r in nearest(ks, "id", "v", qs, "q", "v", 3).collect()))
    assert got == sorted([(1, 1, 1), (1, 2, 8), (1, 3, 9)] * 2 + [(0, 1, 8), (0, 2, 9), (0, 3, 9)])
    assert nearest(ks.where("id = 2"), "id", "v", qs, "q", "v", 3).count() == 0
    assert nearest(ks, "id", "v", qs.where("q = 2"), "q", "v", 3).count() == 0
    assert nearest(ks.limit(0), "id", "v", qs, "q", "v", 3).columns == ["q", "id", "similarity", "rank"]


def test_text_ids_and_several_searches(spark):
    ks = spark.createDataFrame([("b", [1.0, 1.0]), ("a", [1.0, 1.0]), ("c", [1.0, 0.0])], "id string, v array<float>")
    index = VectorIndex(ks, "id", "v", depth=2)
    qs = spark.createDataFrame([("x", [3.0, 3.0])], "q string, v array<float>")
    assert [(r.id, r.rank) for r in index.search(qs, "q", "v", 2).orderBy("rank").collect()] == [("a", 1), ("b", 2)]
    assert [(r.id, r.rank) for r in index.search(qs, "q", "v", 1).collect()] == [("a", 1)]
    with pytest.raises(ValueError):
        index.search(qs, "q", "v", 3)


def test_far_cells_are_pruned(spark):
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(20, 16))
    keys = spark.createDataFrame([(i, (middles[i % 20] + 0.02 * rng.normal(size=16)).tolist()) for i in range(2000)], DDL)
    index = VectorIndex(keys, "id", "v", most_cells=30)   # the sample is drawn, not the whole
    index.search(keys.where("id % 50 = 0").withColumnRenamed("id", "q"), "q", "v", 10)
    assert 0 < index.compared < 0.3 * index.possible
