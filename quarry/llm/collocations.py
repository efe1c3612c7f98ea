"""Phrase collocations by prefix-free parsing.

Texts (A-Z lowered) are split at ``. , ; : ! ?`` and line breaks into pieces and those at
spaces and tabs into words.  Everything is counted per language (null: ``und``).

Parse.  A chunk begins where a text does and where the hash of a word and the one before it
falls on one of ``EVERY`` values, so that equal passages fall into equal chunks wherever they
stand; without such a place a chunk ends after ``LONGEST`` words.  Chunks overlap: each
carries the next words of its piece, one fewer than the longest phrase, behind its body.  The
distinct chunks with their frequencies are the dictionary, written once.  A phrase belongs to
the chunk in whose body it begins, so that overlaps count once, with the chunk's frequency
as its weight; copies of a passage are counted in one step.

Counts.  A phrase occurs no more often than its parts, so words are counted first, then
hashes of pairs of frequent words, then, as text and exactly, the phrases whose pairs may all
be frequent.  The two filters between these steps are bitmaps of at most ``MOST_BITS`` bits;
hash collisions and a full filter let more phrases through to the exact count and change no
result.  Every step aggregates in the task before its shuffle.

Defined results: a null text counts as empty; a text without words gives nothing; repeated
rows all count; ``doc_id`` and other columns are ignored.  An empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import chunks, whole_text, written

EVERY, LONGEST = 32, 128
LEAST_BITS, MOST_BITS = 16, 29
PARTS = 32
SLICE = 6 << 20
MARK = "\n"  # between pieces; no word holds a line break
MIX = np.uint64(0x9E3779B97F4A7C15)


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hashes of ordered pairs of hashes."""
    x = (a ^ (a >> np.uint64(29))) * MIX + b
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """first[0], ... last[0] - 1, first[1], ..."""
    sizes = last - first
    return np.arange(sizes.sum()) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the word of every place, and the places where texts begin (and the
    end); empty words are dropped."""
    split = pc.split_pattern(texts, " ")
    bounds = split.offsets.to_numpy().astype(np.int64)
    found = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
    codes = found.indices.to_numpy()
    empty = pc.index(found.dictionary, "").as_py()
    if empty < 0:
        return found.dictionary, codes, bounds - bounds[0]
    real = codes != empty
    return found.dictionary, codes[real], np.append(0, np.cumsum(real))[bounds - bounds[0]]


# -- the parse

def parse(texts: pa.Array, overlap: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Text number, words (with marks between pieces) and length of the body of all chunks."""
    spaced = pc.replace_substring_regex(pc.ascii_lower(texts), "[.,;:!?\\x0A-\\x0D]+", f" {MARK} ")
    words, code, bounds = split_words(pc.replace_substring(spaced, "\t", " "))
    if not len(code):
        return np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words.to_pylist()], np.uint64)[code]
    begins = np.append(True, text[1:] != text[:-1])
    begins[1:] |= mix(hashes[:-1], hashes[1:]) % np.uint64(EVERY) == 0
    place = np.arange(len(code))
    begins |= (place - np.maximum.accumulate(np.where(begins, place, 0))) % LONGEST == 0
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(code))
    # the next words of the piece: up to a mark or the end of the text
    mark = code == pc.index(words, MARK).as_py()
    stops = np.where(mark, place, len(code))
    stops = np.append(np.minimum.accumulate(stops[::-1])[::-1], len(code))
    stops = np.minimum(stops[last], bounds[1:][text[first]])
    ends = np.where(mark[last - 1], last, np.maximum(last, np.minimum(last + overlap, stops)))
    held = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(ends - first)), pa.int32()), words.take(pa.array(code[ranges(first, ends)])))
    return text[first], pc.binary_join(held, " "), last - first


def dictionary(docs: DataFrame, longest: int = 4) -> DataFrame:
    """lang, chunk, body (words that are its own), n (how often it occurs)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for part in chunks(b.column("text"), rows=1 << 16, nbytes=SLICE):
                text, held, body = parse(part, longest - 1)
                yield pa.RecordBatch.from_pydict({"lang": b.column("lang").slice(at, len(part)).take(pa.array(text)),
                                                  "chunk": held, "body": pa.array(body, pa.int32())})
                at += len(part)

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    found = docs.select(lang, whole_text().alias("text")).mapInArrow(run, "lang string, chunk string, body int")
    return found.groupBy("lang", "chunk", "body").agg(F.count(F.lit(1)).alias("n"))


class Slice:
    """Chunks of the dictionary, place by place: ``key`` numbers the distinct (language,
    word) pairs, ``own`` says whether a phrase may begin there, ``on`` whether the next place
    holds the next word of the piece, ``weight`` is the chunk's frequency."""

    def __init__(self, rows: pa.RecordBatch):
        words, code, bounds = split_words(rows.column("chunk"))
        sizes = np.diff(bounds)
        lang = rows.column("lang").dictionary_encode()
        chunk = np.repeat(np.arange(len(rows)), sizes)
        mark = code == pc.index(words, MARK).as_py()
        self.own = (np.arange(len(code)) - bounds[chunk] < rows.column("body").to_numpy()[chunk]) & ~mark
        self.on = np.append((chunk[1:] == chunk[:-1]) & ~mark[1:] & ~mark[:-1], False)
        self.weight = rows.column("n").to_numpy()[chunk]
        pairs, self.key = np.unique(lang.indices.to_numpy().astype(np.int64)[chunk] * len(words) + code, return_inverse=True)
        self.word, self.lang = words.take(pa.array(pairs % len(words))), lang.dictionary.take(pa.array(pairs // len(words)))
        seeds = [xxhash.xxh64_intdigest(x) for x in lang.dictionary.to_pylist()]
        self.hash = np.array([xxhash.xxh64_intdigest(w, seeds[i]) for w, i in zip(self.word.to_pylist(), (pairs // len(words)).tolist())], np.uint64)

    def pairs(self, frequent_words: "Filter") -> tuple[np.ndarray, np.ndarray]:
        """Places where a pair of frequent words begins, and the hashes of the pairs."""
        often = frequent_words.may_hold(self.hash)[self.key]
        at = np.flatnonzero(self.on & often & np.append(often[1:], False))
        return at, mix(self.hash[self.key[at]], self.hash[self.key[at + 1]])


def per_slice(rows: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` of a Slice gives the columns of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for part in chunks(b.column("chunk"), rows=1 << 17, nbytes=SLICE):
                for out in fn(Slice(b.slice(at, len(part)))):
                    yield pa.RecordBatch.from_pydict(out)
                at += len(part)

    return rows.mapInArrow(run, schema)


def total(codes: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(codes, weights=weight, minlength=size).astype(np.int64)


def word_counts(rows: DataFrame) -> DataFrame:
    """lang, phrase (a word), h (its hash), n."""
    def count(s: Slice):
        n = total(s.key, s.weight * s.own, len(s.hash))
        held = pa.array(n > 0)
        yield {"lang": s.lang.filter(held), "phrase": s.word.filter(held), "h": pa.array(s.hash.view(np.int64)[n > 0]), "n": pa.array(n[n > 0])}

    return (per_slice(rows, count, "lang string, phrase string, h long, n long")
            .groupBy("lang", "phrase").agg(F.first("h").alias("h"), F.sum("n").alias("n")))


# -- filters

def filter_bits(n: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, n) * 16))))


class Filter:
    """A Bloom filter of the hashes in a written table (column h), of at most 2^MOST_BITS
    bits: its bitmaps, at most 64 MB, are broadcast."""

    def __init__(self, hashes: DataFrame):
        self.bits = bits = filter_bits(hashes.count())
        places = F.explode(F.array(F.shiftrightunsigned("h", 64 - bits), F.col("h").bitwiseAND(F.lit((1 << bits) - 1)))).alias("p")
        maps = (hashes.select(places).groupBy(F.shiftright("p", 15).alias("at"))
                      .agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit(32767))).alias("map")))
        whole = bytearray(max(4096, 1 << bits >> 3))
        for r in maps.toLocalIterator():
            whole[r.at * 4096:(r.at + 1) * 4096] = r.map
        self.maps = hashes.sparkSession.sparkContext.broadcast(bytes(whole))

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        maps = np.frombuffer(self.maps.value, np.uint8)
        def hit(p):
            return (maps[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1
        return (hit(h >> np.uint64(64 - self.bits)) & hit(h & np.uint64((1 << self.bits) - 1))).astype(bool)


def frequent_pairs(rows: DataFrame, words: Filter, least: int) -> DataFrame:
    """h: hashes that pairs of frequent words give ``least`` times or more."""
    def count(s: Slice):
        at, h = s.pairs(words)
        at, h = at[s.own[at]], h[s.own[at]]
        distinct, code = np.unique(h, return_inverse=True)
        yield {"h": pa.array(distinct.view(np.int64)), "n": pa.array(total(code, s.weight[at], len(distinct)))}

    counts = per_slice(rows, count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= least).select("h")


def phrase_counts(rows: DataFrame, words: Filter, pairs: Filter, longest: int, least: int) -> DataFrame:
    """lang, size (2 to ``longest`` words), phrase, n of at least ``least``."""
    def count(s: Slice):
        at, h = s.pairs(words)
        at = at[pairs.may_hold(h)]
        good = np.zeros(len(s.key) + longest, bool)
        good[at] = True
        # number of the phrase that begins at a place; a phrase one word shorter first
        number = np.append(s.key, np.zeros(longest, np.int64))
        for size in range(2, longest + 1):
            at = at[good[at + size - 2]] if size > 2 else at
            seen, first, code = np.unique(number[at] * len(s.hash) + s.key[at + size - 1], return_index=True, return_inverse=True)
            n = total(code, s.weight[at] * s.own[at], len(seen))
            number[at] = code
            first = at[first[n > 0]]
            yield {"lang": s.lang.take(pa.array(s.key[first])), "size": pa.array(np.full(len(first), size, np.int32)),
                   "phrase": pc.binary_join_element_wise(*[s.word.take(pa.array(s.key[first + k])) for k in range(size)], " "), "n": pa.array(n[n > 0])}

    found = per_slice(rows, count, "lang string, size int, phrase string, n long")
    return found.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


# -- scores

def sub_phrase(first: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, size), " ")


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, scale: int = 2_000_000, share: int = 80, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of every language.  The
    cut of a phrase into two with the lowest scale * a / (l + r) counts; a phrase inside a
    longer one that has ``share`` percent of its occurrences goes."""
    rows = written(dictionary(docs, longest), "chunks")
    every_word = written(word_counts(rows), "chunk-words")
    often = every_word.filter(F.col("n") >= least)
    words = Filter(often)
    pairs = Filter(written(frequent_pairs(rows, words, least), "chunk-pairs"))
    found = written(phrase_counts(rows, words, pairs, longest, least), "phrases")

    counts = often.select("lang", "phrase", "n").unionByName(found.select("lang", "phrase", "n"))
    def part(name: str) -> DataFrame:
        return counts.select("lang", F.col("phrase").alias(f"{name}_part"), F.col("n").alias(name))
    cuts = (found.select("lang", "phrase", "size", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
                 .withColumns({"l_part": sub_phrase(F.lit(1), F.col("k")), "r_part": sub_phrase(F.col("k") + 1, F.col("size") - F.col("k"))})
                 .join(part("l"), ["lang", "l_part"]).join(part("r"), ["lang", "r_part"]))
    score = F.expr(f"(cast({scale} as decimal(10,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("c"))
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda s: F.transform(
        F.sequence(F.lit(1), F.col("size") - s + 1), lambda i: sub_phrase(i, s))))
    inside = (found.filter("size > 2").select("lang", "n", F.explode(inner).alias("phrase"))
                   .groupBy("lang", "phrase").agg(F.max("n").alias("outer")))
    kept = best.join(inside, ["lang", "phrase"], "left").filter(
        F.col("outer").isNull() | (F.col("outer").cast("decimal(19,0)") * 100 < F.col("a").cast("decimal(19,0)") * share))
    words_of = every_word.groupBy("lang").agg(F.sum("n").alias("words"))
    best_first = (F.desc("c.score"), F.desc("a"), F.col("phrase"))
    def ranked(rows: DataFrame, *by) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", *by).orderBy(*best_first))).filter(F.col("rank") <= top)
    # first within parts of a language, so that the last task of a language reads a fixed number of rows
    kept = ranked(ranked(kept, F.pmod(F.xxhash64("phrase"), F.lit(PARTS))))
    return kept.join(words_of, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"),
                                                F.col("words").alias("n"), F.col("c.score").cast("long").alias("score"))
