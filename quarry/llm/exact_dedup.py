"""Exact duplicates by a two-pass Bloom filter, in DataFrame functions only.

Texts are equal when they are identical after every run of white space (space, tab, line
feed, vertical tab, form feed, carriage return) is replaced by one space; null counts as
empty.

Pass one reads the texts once and writes (doc_id, sha256) to the shared folder.  Every hash
names two slots of a filter of 2^k bits; slots named by more than one row make up the
filter, kept as 4 KB bitmaps of 32,768 slots.  Pass two probes it: a hash that is not in it
occurs once, and its row goes straight to the result.  Only possibly repeated rows are
shuffled by hash, pre-aggregated to (smallest doc_id, rows).  The filter has about 16 bits a
row at every size, so about 1.4 % of the lone rows pass as maybe repeated.  Up to 64 MB
(33 million rows) it is broadcast.  Beyond that it is joined by bitmap number, evenly spread
by the hash: ``groups`` then shuffles its written rows (id and hash) once for it, ``dedupe``
its documents, and the rows that it lets through still go to the exact pass alone.

Defined results: rows with a null ``doc_id`` stay only if their group has no other id;
repeated rows with the smallest ``doc_id`` of a group all read ``kept`` in ``groups``, and
``dedupe`` returns one of them.  Other columns pass through ``dedupe`` unread, whatever
their names.  An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import whole_text, written

BITS_PER_ROW, LEAST_BITS = 16, 16
BROADCAST_BITS = 29  # 64 MB


def text_key(name: str = "text") -> Column:
    """Lowercase hex sha256 of the normalised text."""
    return F.sha2(F.encode(F.regexp_replace(whole_text(name), "[\\x20\\x09-\\x0D]+", " "), "UTF-8"), 256)


def _slots(key: Column, bits: int) -> tuple[Column, Column, Column]:
    """Bitmap number and two positions in it, from separate parts of the hash."""
    h = F.xxhash64(key)
    bitmap = F.shiftrightunsigned(h, 64 - (bits - 15))
    return (bitmap, h.bitwiseAND(F.lit(32767)),
            F.shiftrightunsigned(h, 15).bitwiseAND(F.lit(32767)))


def repeated_filter(keys: DataFrame, bits: int) -> DataFrame:
    """(bitmap, bits): the slots that more than one row of ``keys`` names."""
    bitmap, first, second = _slots(F.col("text_sha256"), bits)
    slots = keys.select(bitmap.alias("bitmap"), F.explode(F.array_distinct(F.array(first, second))).alias("slot"))
    twice = (slots.groupBy("bitmap", "slot").agg(F.count(F.lit(1)).alias("n"))
                  .filter("n > 1"))
    return twice.groupBy("bitmap").agg(F.bitmap_construct_agg(F.col("slot")).alias("bits"))


def probe(rows: DataFrame, repeated: DataFrame, bits: int) -> DataFrame:
    """``rows`` with ``__maybe``: whether the hash may occur more than once.  ``repeated``
    has at most 2^bits / 8 bytes: up to 64 MB it is broadcast, beyond that joined by the
    number of the bitmap."""
    bitmap, first, second = _slots(F.col("text_sha256"), bits)

    def hit(slot: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col("bits"), (F.shiftright(slot, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, slot.bitwiseAND(F.lit(7)).cast("int")) == 1

    maps = repeated.withColumnRenamed("bitmap", "__bitmap")
    return (rows.join(F.broadcast(maps) if bits <= BROADCAST_BITS else maps, bitmap == F.col("__bitmap"), "left")
                .withColumn("__maybe", F.coalesce(hit(first) & hit(second), F.lit(False)))
                .drop("__bitmap", "bits"))


def filter_bits(n: int) -> int:
    return max(LEAST_BITS, math.ceil(math.log2(max(1, n) * BITS_PER_ROW)))


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    keys = written(docs.select(F.col("doc_id").cast("long"), text_key().alias("text_sha256")), "exact-keys")
    bits = filter_bits(keys.count())
    tested = probe(keys, written(repeated_filter(keys, bits), "exact-filter"), bits)
    alone = tested.filter(~F.col("__maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256")
    maybe = tested.filter("__maybe").select("doc_id", "text_sha256")
    sizes = maybe.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"),
                                             F.count(F.lit(1)).alias("group_size"))
    # read back, so that the join has plain exchanges whose hot partitions can be split
    sizes = written(sizes, "exact-sizes")
    again = maybe.join(sizes, "text_sha256").select("doc_id", "keep_id", "group_size", "text_sha256")
    return alone.unionByName(again).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256")


def dedupe(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns.  Texts of rows that are surely alone
    never shuffle; of the others, one row of each group comes back."""
    packed = docs.select(F.struct("*").alias("__row"), F.col("doc_id").cast("long").alias("__id"),
                         text_key().alias("text_sha256"))
    keys = written(packed.select("__id", "text_sha256"), "exact-keys")
    bits = filter_bits(keys.count())
    repeated = written(repeated_filter(keys, bits), "exact-filter")
    keepers = (probe(keys, repeated, bits).filter("__maybe").groupBy("text_sha256")
               .agg(F.min("__id").alias("__keep")))
    tested = probe(packed, repeated, bits)
    alone = tested.filter(~F.col("__maybe")).select("__row.*")
    again = (tested.filter("__maybe")
             .join(keepers.withColumnRenamed("text_sha256", "__key"),
                   (F.col("text_sha256") == F.col("__key")) & F.col("__id").eqNullSafe(F.col("__keep")),
                   "left_semi")
             .dropDuplicates(["text_sha256"]).select("__row.*"))
    return alone.unionByName(again)
