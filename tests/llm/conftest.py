import json
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import types as T

DOC = "doc_id long, text string, lang string, source string, n_chars long"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) rows, with extra columns whose names clash with
    the operators' own."""
    def make(rows, lang="en", parts=3):
        schema = T.StructType.fromDDL(DOC + ", fp long, kept string, text_sha256 string, shard string, __id string, "
                                      "component_id string, n_tokens string, bits string, cut string, h string")
        full = [(i, t, lang, "s", len(t or "")) + ("x",) * 0 + (1,) + ("x",) * 9 for i, t in rows]
        return spark.createDataFrame(full, schema).repartition(parts)
    return make


@pytest.fixture(scope="session")
def small_docs():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet' ORDER BY doc_id").fetchall()


# nulls, empty and white texts, ties, repeats, odd white space, non-Latin, long
LONG = "Straße naïve 12 km — déjà vu. " * 4000
ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "hello  world"), (5, "hello world"), (5, "hello world"),
       (6, "hello\tworld\n\n"), (7, "<|endoftext|> </s> <0x0A> ▁x"), (8, "日本語 текст 🙂 áe b"),
       (9, LONG), (10, "x" * 5000), (None, "no id here"), (None, None), (11, "a\x1cb \x00 c\r\nd e.\nF g\n"),
       (12, "12345"), (13, " lead and trail "), (14, "don't we'll X's")]
