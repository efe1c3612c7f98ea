"""Corpus pipeline over ``documents``.

language ID -> exact dedup -> SimHash near-dedup -> benchmark decontamination -> pieces.
Each stage reads what its predecessor kept, as a parquet table in the shared folder."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quarry.llm import decontaminate, exact_dedup, lang_rnn, piece_bpe, simhash_vp
from quarry.llm.common import written
from quarry.sources.tables import load


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that could be told, null labels filled; texts without letters
    and texts that score no better than chance go."""
    return lang_rnn.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.dedupe(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash_vp.dedupe(docs, words=3, radius=3)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontaminate.clean(docs, load(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, digests, language and source of what is left."""
    return piece_bpe.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), carry=("lang", "source"))


STAGES = [("language ID", language_id), ("exact dedup", exact), ("SimHash near-dedup", near),
          ("benchmark decontamination", decontaminated), ("SentencePiece encoding and decoding", pieces)]

# the language network, XXH64 and the tokenizer have no counterpart in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.split()[0])
    return docs
