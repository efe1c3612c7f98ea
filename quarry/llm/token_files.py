"""Token ids in Parquet files: encode, write, read back.

Layout: one row per document, sorted by ``doc_id``, in files that hold disjoint, ascending
ranges.  ``ids`` is a list of 32-bit integers in dictionary encoding (token ids repeat, so
pages hold bit-packed dictionary indices); ``doc_id``, ``local_start`` and ``n_tokens``
use delta encoding.  Row groups and pages are small enough for the page index to serve
selective reads: ``read_metadata`` never touches the token pages and ``read_tokens`` skips
the row groups and pages outside its range of documents.

Encoding runs the tokenizers library on the distinct space-separated words of a batch, many
in one text, and gathers their ids in Arrow.  With the byte-level pattern a token never holds a non-space character
followed by a space, so every such place is a boundary; a line feed between two non-space
characters is a token of its own.  Texts with other or adjacent white space go to the
library whole.

Nulls: a null text counts as empty (only the end id); a null ``doc_id`` sorts first.
Repeated rows are all kept, ordered by (doc_id, hash of the text).  Other columns are
ignored.  An empty table gives an empty file set with the same schema.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from quarry.llm.common import ListMemo, broadcast_file, chunks, id_lists, per_worker, whole_text

SCHEMA = ("doc_id long, file_key int, local_start long, n_tokens long, "
          "ids array<int>")


def parquet_options(row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10,
                    page_rows: int = 1000) -> dict[str, str]:
    return {
        "compression": "lz4_raw",
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.size": str(page_bytes),
        "parquet.page.row.count.limit": str(page_rows),
        "parquet.writer.version": "PARQUET_2_0",
        "parquet.enable.dictionary": "true",
        "parquet.enable.dictionary#doc_id": "false",
        "parquet.enable.dictionary#local_start": "false",
        "parquet.enable.dictionary#n_tokens": "false",
    }


class WordEncoder:
    """Ids of whole texts, by way of their distinct words; all steps but the library's own
    run on Arrow arrays."""

    def __init__(self, vocabulary: bytes, limit: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary.decode())
        self.tokenizer.encode_special_tokens = True
        # a space or line feed only ever begins a token, and each word begins with one
        size = self.tokenizer.get_vocab_size()
        self.begins = np.array([(self.tokenizer.id_to_token(i) or "")[:1] in ("\u0120", "\u010a") for i in range(size)])
        self.words = ListMemo(self._encode_words, limit)

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.int32) for e in found]

    def _encode_words(self, words: list[str]) -> pa.ListArray:
        """Ids of distinct words that follow a space (or begin with a line feed), empty for
        one with other white space in it; the library gets many words in one text, which is
        cut where words begin."""
        plain = [i for i, w in enumerate(words) if (body := w[1:] if w[:1] == "\n" else w).split() == [body]]
        sizes, flat = np.zeros(len(words), np.int64), [np.array([], np.int32)]
        for at in range(0, len(plain), 512):
            part = plain[at:at + 512]
            ids = self._library(["".join([w if w[0] == "\n" else " " + w for w in map(words.__getitem__, part)])])[0]
            cuts = np.append(np.flatnonzero(self.begins[ids]), len(ids))
            if len(cuts) != len(part) + 1 or cuts[0]:
                raise ValueError("the vocabulary does not begin every word with a white-space token")
            sizes[part] = np.diff(cuts)
            flat.append(ids)
        return id_lists(np.concatenate(flat), sizes)

    def __call__(self, texts: pa.Array, end_id: int) -> pa.ListArray:
        """The ids of every text, ``end_id`` last."""
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        bounds = split.offsets.to_numpy().astype(np.int64)
        pieces = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        bounds = bounds - bounds[0]
        words, at = self.words.look(pieces.dictionary), pieces.indices.to_numpy().astype(np.int64)
        # a text whose words do not cut at single spaces or line feeds goes to the library whole
        heads = pieces.dictionary.take(pa.array(at[bounds[:-1]])).to_pylist()
        odd = (np.diff(words.offsets.to_numpy()) == 0)[at]
        odd[bounds[:-1]] = [h.split() != [h] for h in heads]
        whole = np.logical_or.reduceat(odd, bounds[:-1])
        own = [t if w else h for t, w, h in zip(texts.to_pylist(), whole.tolist(), heads)]
        none, end = len(words) + len(own), len(words) + len(own) + 1
        whole_ids = self._library(own)
        table = pa.concat_arrays([words, id_lists(np.concatenate(whole_ids), map(len, whole_ids)), id_lists([end_id], [0, 1])])
        at[np.repeat(whole, np.diff(bounds))] = none
        at[bounds[:-1]] = len(words) + np.arange(len(own))
        found = table.take(pa.array(np.insert(at, bounds[1:], end)))
        return pa.ListArray.from_arrays(found.offsets.take(pa.array(bounds + np.arange(len(bounds)))), found.values)


def encode(docs: DataFrame, vocabulary: str, end_id: int = 0) -> DataFrame:
    """``docs`` (doc_id, text) in ascending doc_id order with their token ids and
    ``end_id``; see SCHEMA.  ``file_key`` numbers the ranges in order and ``local_start``
    counts the ids before a document within its range."""
    held = broadcast_file(docs.sparkSession, vocabulary)
    rows = (docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
                .withColumn("h", F.xxhash64("text"))
                .repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, key, start = per_worker(WordEncoder, held.value), TaskContext.get().partitionId(), 0
        for batch in batches:
            at = 0
            for part in chunks(batch.column("text"), rows=1 << 16, nbytes=4 << 20):
                lists = encoder(part, end_id)
                ends = lists.offsets.to_numpy().astype(np.int64)
                counts = np.diff(ends)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(part)),
                     pa.array(np.full(len(part), key, np.int32)),
                     pa.array(start + ends[:-1]), pa.array(counts), lists],
                    names=["doc_id", "file_key", "local_start", "n_tokens", "ids"])
                at, start = at + len(part), start + int(ends[-1])

    return rows.mapInArrow(run, SCHEMA)


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0,
                 **layout: int) -> None:
    encode(docs, vocabulary, end_id).write.options(**parquet_options(**layout)).parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, file_key; reads no token
    page.  Offsets of files are summed over one row per file."""
    return _with_start(spark.read.schema(SCHEMA).parquet(path).drop("ids"))


def _with_start(rows: DataFrame) -> DataFrame:
    files = rows.groupBy("file_key").agg(F.sum("n_tokens").alias("__n"))
    before = Window.orderBy("file_key").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select("file_key", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return (rows.join(F.broadcast(offsets), "file_key")
                .withColumn("start", F.col("local_start") + F.col("__before")).drop("__before"))


def read_tokens(spark: SparkSession, path: str, first: int | None = None,
                last: int | None = None) -> DataFrame:
    """doc_id, file_key, local_start, n_tokens, ids of the documents from ``first`` to
    ``last``; the bounds reach the row-group and page statistics."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    if first is not None:
        rows = rows.filter(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.filter(F.col("doc_id") <= last)
    return rows


def _crc(lists: pa.Array) -> pa.Array:
    offsets = lists.offsets.to_numpy()
    ids = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<u4")
    raw = memoryview(ids).cast("B")
    return pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(offsets[:-1], offsets[1:])],
                    type=pa.int64())


def digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids, all read from the files."""
    def crc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            yield _crc(b)

    rows = _with_start(spark.read.schema(SCHEMA).parquet(path))
    return rows.select("doc_id", "start", F.size("ids").cast("long").alias("n_tokens"),
                       arrow_udf(crc, "long")(F.col("ids")).alias("ids_crc32"))
