"""Registered vector queries over ``embeddings``: label centroids are the queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import vector_index, vectors as vo
from quarry.plans.registry import DIGITS, register, rounded
from quarry.sources.tables import load

_CENTROIDS_SQL = """e AS (SELECT vec_id, label, embedding FROM embeddings),
u AS (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS pos FROM e),
c AS (SELECT label, pos, avg(x) AS cx FROM u GROUP BY label, pos),
k AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS pos FROM e)"""


def _centroids(spark, sf_dir):
    emb = load(spark, sf_dir, "embeddings")
    return emb, vo.centroids(emb, "label", "embedding")


@register("centroids", f"""WITH {_CENTROIDS_SQL}
SELECT label, CAST(pos - 1 AS INTEGER) AS dim, round(cx, {DIGITS}) AS value FROM c""")
def centroid_table(spark, sf_dir):
    """Mean embedding per label, long form (label, dim, value)."""
    _, c = _centroids(spark, sf_dir)
    return rounded(c.select("label", F.posexplode("centroid").alias("dim", "value")), "value")


@register("cosine_topk", f"""WITH {_CENTROIDS_SQL},
n AS (SELECT label, sqrt(sum(cx * cx)) AS nc FROM c GROUP BY label),
m AS (SELECT vec_id, sqrt(sum(x * x)) AS nk FROM k GROUP BY vec_id),
s AS (SELECT c.label, k.vec_id, sum(c.cx * k.x) AS d FROM c JOIN k USING (pos) GROUP BY c.label, k.vec_id),
sim AS (SELECT s.label, s.vec_id, d / (nc * nk) AS similarity FROM s JOIN n USING (label) JOIN m USING (vec_id))
SELECT label, vec_id, round(similarity, {DIGITS}) AS similarity, "rank" FROM (SELECT label, vec_id, similarity,
  CAST(row_number() OVER (PARTITION BY label ORDER BY similarity DESC, vec_id) AS INTEGER) AS "rank" FROM sim)
WHERE "rank" <= 5""")
def cosine_topk(spark, sf_dir):
    """T6 + V2: the five embeddings closest (cosine) to each label centroid."""
    emb, c = _centroids(spark, sf_dir)
    return rounded(vo.cosine_top_k(emb, "vec_id", "embedding", c, "label", "centroid", 5), "similarity")


@register("nearest_rows", f"""WITH k AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
n AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS size FROM k),
s AS (SELECT q.vec_id AS query_id, n.vec_id, list_dot_product(q.v, n.v) / (q.size * n.size) AS similarity
      FROM n q, n WHERE q.vec_id % 100 = 0)
SELECT query_id, vec_id, round(similarity, {DIGITS}) AS similarity, "rank" FROM (SELECT *,
  CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS INTEGER) AS "rank" FROM s)
WHERE "rank" <= 10""")
def nearest_rows(spark, sf_dir):
    """T6 + J6 + V2: the ten rows nearest to every row whose id is divisible by 100, among
    all rows, by the exact cell index."""
    emb = load(spark, sf_dir, "embeddings")
    asked = emb.where(F.col("vec_id") % 100 == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    return rounded(vector_index.nearest(emb, "vec_id", "embedding", asked, "query_id", "embedding", 10), "similarity")


_ATTN_SQL = f"""WITH {_CENTROIDS_SQL},
s AS (SELECT c.label, k.vec_id, sum(c.cx * k.x) / sqrt((SELECT max(len(embedding)) FROM embeddings)) AS score
      FROM c JOIN k USING (pos) GROUP BY c.label, k.vec_id),
w AS (SELECT label, vec_id, score, exp(score - max(score) OVER (PARTITION BY label)) AS ex FROM s),
a AS (SELECT label, vec_id, score, ex / sum(ex) OVER (PARTITION BY label) AS weight FROM w)"""


@register("attention_weights", _ATTN_SQL + f"\nSELECT label, vec_id, round(score, {DIGITS}) AS score, round(weight, {DIGITS}) AS weight FROM a")
def attention_weights(spark, sf_dir):
    """N1 + N3: softmax weights of every embedding for each label-centroid query."""
    emb, c = _centroids(spark, sf_dir)
    return rounded(vo.attention_weights(emb, "vec_id", "embedding", c, "label", "centroid"), "score", "weight")


@register("attention_top", _ATTN_SQL + f"""
SELECT label, vec_id, "rank", round(score, {DIGITS}) AS score, round(weight, {DIGITS}) AS weight FROM (SELECT *,
  CAST(row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS INTEGER) AS "rank" FROM a) WHERE "rank" <= 20""")
def attention_top(spark, sf_dir):
    """N1 + T6: the twenty heaviest embeddings of each label-centroid query, with their
    softmax weights among all."""
    emb, c = _centroids(spark, sf_dir)
    return rounded(vo.attention_weights(emb, "vec_id", "embedding", c, "label", "centroid", k=20), "score", "weight")


@register("attention", _ATTN_SQL + f"""
SELECT a.label, CAST(k.pos - 1 AS INTEGER) AS dim, round(sum(a.weight * k.x), {DIGITS}) AS value
FROM a JOIN k USING (vec_id) GROUP BY a.label, k.pos""")
def attention(spark, sf_dir):
    """N2 + N3: attention context vector per label-centroid query, long form."""
    emb, c = _centroids(spark, sf_dir)
    return rounded(vo.attention_context(emb, "vec_id", "embedding", c, "label", "centroid"), "value")
