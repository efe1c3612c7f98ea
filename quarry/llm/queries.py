"""Registered queries of the training-data operators, and SQL where it can state them.

Each runs over its whole table.  op2 (XXH64 and crc32), op8 (XXH64), the models and the
tokenizers have no counterpart in SQL; their tests compare them with plain versions."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (collocations, decontaminate, exact_dedup, hard_negatives, hash_tree, lang_rnn, piece_bpe,
                        pii, sequence_packing, simhash_vp, token_files, warc_bundles, wordpiece_counts)
from quarry.llm.common import shared_path
from quarry.sources.tables import load


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    token_files.write_tokens(load(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.digest(spark, path)


def op2_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.shard_documents(load(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_rnn.identify(load(spark, sf_dir, "documents"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_documents(load(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_bundles.archive_pages(spark, load(spark, sf_dir, "pages"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(load(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_vp.components(load(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece_counts.count_documents(load(spark, sf_dir, "documents"),
                                            public_tokenizers.path("word_bpe_49k.json"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.encode_documents(load(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence_packing.pack(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hard_negatives.floored(load(spark, sf_dir, "embeddings"))
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", shifted))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(load(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_token_files, op2_hash_tree, op3_language, op4_personal_data, op5_warc, op6_exact_dedup,
    op7_decontaminate, op8_simhash, op9_token_counts, op10_pieces, op11_best_fit_packing, op12_hard_negatives,
    op13_collocations)}

ORACLE = {
    "op6_exact_dedup": r"""
        WITH k AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
                   FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, text_sha256
        FROM k WINDOW g AS (PARTITION BY text_sha256)
    """.strip(),
    "op12_hard_negatives": r"""
        WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
                   FROM embeddings
                   WHERE label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS id, b.label,
                     list_inner_product(a.v, b.v)::BIGINT AS score
              FROM r a, r b WHERE a.vec_id % 100 = 0),
        p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE label = own AND id <> anchor_id
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT anchor_id, positive_id,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.id)::INTEGER AS rank,
               s.id AS negative_id, positive_score, s.score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE s.label <> s.own AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
        QUALIFY rank <= 10
    """.strip(),
    "op13_collocations": r"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
                   FROM documents),
        w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
        g AS (SELECT lang, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) AS phrase
              FROM w, range(1, 5) AS t(size) WHERE len(ws) >= size),
        f AS MATERIALIZED (SELECT lang, size, phrase, string_split(phrase, ' ') AS ws, count(*)::HUGEINT AS a
                           FROM g GROUP BY lang, size, phrase HAVING a >= 30),
        total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
        cut AS (SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS lp, array_to_string(ws[k + 1:], ' ') AS rp
                FROM f, range(1, 4) AS t(k) WHERE k < size),
        c AS (SELECT cut.lang, cut.phrase, cut.a, k, l.a AS l, r.a AS r, (2000000 * cut.a) // (l.a + r.a) AS score
              FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = cut.lp JOIN f r ON r.lang = cut.lang AND r.phrase = cut.rp
              QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY score, k) = 1),
        inside AS (SELECT lang, array_to_string(ws[i:i + s - 1], ' ') AS phrase, max(a) AS outer_a
                   FROM f, range(2, 4) AS t(s), range(1, 4) AS u(i) WHERE s < size AND i + s - 1 <= size GROUP BY ALL)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
               phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
        FROM c LEFT JOIN inside USING (lang, phrase) JOIN total USING (lang)
        WHERE outer_a IS NULL OR 100 * outer_a < 80 * a
        QUALIFY rank <= 2000
    """.strip(),
}
