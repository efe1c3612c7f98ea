"""Vector operators: centroids, nearest vectors by cosine (top-k) and scaled
dot-product attention of a small query set over a table of key/value vectors.

Queries meet keys without a join: the stated query set is written once and dealt into
blocks of about ``QUERY_BLOCK`` rows; each block is turned into one array value by a scalar
subquery and ``inline``-d next to every key row, so each key row yields one row per query
(work linear in the keys, one scan per block).  Top-k uses ``row_number() <= k``, which Spark plans with a
partial group limit before the shuffle, so only k rows per query and map partition
move (``vector_index`` serves query sets as large as the table).  Softmax needs no pass for
the per-query maximum: scores are grouped by ranges of ``RANGE`` and each range sums
exp(s - start of the range), which neither overflows nor vanishes; the few ranges of a query
are then scaled to its highest one and added.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import vectors as vf
from quarry.operators.indexing import materialize

QUERY_BLOCK = 2048
RANGE = 64.0


def centroids(df: DataFrame, key: str, vec: str, out: str = "centroid") -> DataFrame:
    """Mean vector per key: (key, pos) averages, then the ordered array per key
    (its length is the dimension, not the group size)."""
    per_dim = (df.select(key, F.posexplode(vf.as_double_array(vec)).alias("pos", "x"))
                 .groupBy(key, "pos").agg(F.avg("x").alias("x")))
    return (per_dim.groupBy(key)
                   .agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("s"))
                   .select(key, F.transform("s", lambda e: e["x"]).alias(out)))


def _stated(queries: DataFrame, qid: str, qvec: str) -> DataFrame:
    """The query set with its vectors as doubles and their norms, computed and written once."""
    q = vf.as_double_array(qvec)
    return materialize(queries.select(F.col(qid).alias("__qid"), q.alias("__qvec"), vf.norm(q).alias("__qnorm")), "queries")


def _with_queries(keys: DataFrame, stated: DataFrame, block: int) -> DataFrame:
    blocks = max(1, math.ceil(stated.count() / block))
    part = F.pmod(F.xxhash64("__qid"), F.lit(blocks))
    out = None
    for b in range(blocks):
        packed = stated.where(part == b).select(F.collect_list(F.struct("__qid", "__qvec", "__qnorm"))).scalar()
        one = keys.select("*", F.inline(packed))
        out = one if out is None else out.unionByName(one)
    return out


def cosine_top_k(keys: DataFrame, key_id: str, key_vec: str, queries: DataFrame,
                 qid: str, qvec: str, k: int = 5, block: int = QUERY_BLOCK) -> DataFrame:
    """T6 + V2: the k keys most similar to each query, ties by key id."""
    normed = keys.select(key_id, key_vec, vf.norm(key_vec).alias("__knorm"))
    scored = _with_queries(normed, _stated(queries, qid, qvec), block).select(
        F.col("__qid").alias(qid), key_id,
        F.try_divide(vf.dot("__qvec", key_vec), F.col("__qnorm") * F.col("__knorm")).alias("similarity"))
    w = Window.partitionBy(qid).orderBy(F.col("similarity").desc(), F.col(key_id).asc())
    return (scored.withColumn("rank", F.row_number().over(w))
                  .where(F.col("rank") <= k))


def _scores(keys, key_id, key_vec, stated, qid, dim, block, *carry):
    return _with_queries(keys.select(key_id, *{key_vec, *carry}), stated, block).select(
        F.col("__qid").alias(qid), key_id, *carry,
        (vf.dot("__qvec", key_vec) / F.lit(math.sqrt(dim))).alias("score"))


def _softmax_sums(scores: DataFrame, qid: str, *terms) -> DataFrame:
    """Per query: ``__top`` (start of its highest range of scores), ``__z`` (sum of
    exp(score - __top)) and ``__c0``, ``__c1`` ... (the same sum, each row times a term).
    Mergeable: one aggregate over the scores, one over the few ranges of a query."""
    ranged = scores.withColumn("__r", F.floor(F.col("score") / RANGE).cast("double") * RANGE)
    e = F.exp(F.col("score") - F.col("__r"))
    sums = ranged.groupBy(qid, "__r").agg(F.sum(e).alias("__z"), *[F.sum(e * t).alias(f"__c{i}") for i, t in enumerate(terms)])
    names = ["__z", *[f"__c{i}" for i in range(len(terms))]]
    tops = sums.withColumn("__top", F.max("__r").over(Window.partitionBy(qid)))
    scale = F.exp(F.col("__r") - F.col("__top"))
    return tops.groupBy(qid).agg(F.max("__top").alias("__top"), *[F.sum(F.col(n) * scale).alias(n) for n in names])


def vector_dim(df: DataFrame, vec: str) -> int:
    """Largest vector length in ``df`` (used on the small query set)."""
    return df.select(F.max(F.size(vec))).first()[0] or 0


def attention_weights(keys: DataFrame, key_id: str, key_vec: str, queries: DataFrame,
                      qid: str, qvec: str, block: int = QUERY_BLOCK, k: int | None = None) -> DataFrame:
    """N1 + N3: softmax over the keys of each query of q.k / sqrt(d).

    The scores are computed and written once, then summed and read back for the weights.
    With ``k`` only the k heaviest keys of each query are returned (ties by key id, their
    place in ``rank``); the weights are still those among all keys."""
    stated = _stated(queries, qid, qvec)
    dim = vector_dim(stated, "__qvec")
    s = materialize(_scores(keys, key_id, key_vec, stated, qid, dim, block), "scores")
    z = _softmax_sums(s, qid)
    cols = [qid, key_id, "score"]
    if k is not None:
        w = Window.partitionBy(qid).orderBy(F.col("score").desc(), F.col(key_id).asc())
        s = s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        cols.append("rank")
    return s.join(z, qid).select(*cols, (F.exp(F.col("score") - F.col("__top")) / F.col("__z")).alias("weight"))


def attention_context(keys: DataFrame, key_id: str, key_vec: str, queries: DataFrame,
                      qid: str, qvec: str, value_vec: str | None = None,
                      block: int = QUERY_BLOCK) -> DataFrame:
    """N2 + N3: context_q = sum_k softmax_k(q.k / sqrt(d)) v_k, as (query, dim, value).

    One pass over the keys: the per-query sums are one aggregate with a sum per dimension;
    scores are computed once and weights per key are never materialised.  Values default to
    the keys (self-attention over the table); they have the length of the queries.
    """
    value_vec = value_vec or key_vec
    stated = _stated(queries, qid, qvec)
    dim = vector_dim(stated, "__qvec")
    s = _scores(keys, key_id, key_vec, stated, qid, dim, block, value_vec)
    v = vf.as_double_array(value_vec)
    sums = _softmax_sums(s, qid, *[F.get(v, F.lit(i)) for i in range(dim)])
    arr = F.array(*[F.struct(F.lit(i).alias("dim"), (F.col(f"__c{i}") / F.col("__z")).alias("value"))
                    for i in range(dim)])
    return sums.select(qid, F.inline(arr))
