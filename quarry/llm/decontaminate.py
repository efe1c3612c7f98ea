"""Benchmark decontamination by q-gram lemma filtering.

Texts and items are compared as lower-case words joined by single spaces.  Items are read as
overlapping passages of half their length, 64 to 160 characters, a fifth apart (shorter
items: one passage), so that a quote of 60 % of an item, or of 192 characters of a long one,
holds a whole passage.  A passage of n characters is found in a text if some region of the
text lies within ``edits`` = n x rate edits (insertions, deletions, substitutions) of it.
By the q-gram lemma such a region shares at least n + 1 - q - q x edits character q-grams
with the passage, and all these matches lie on at most 2 x edits + 1 neighbouring diagonals
(text place minus item place).  Diagonals are dealt into bands of twice that width that
overlap by half, so some band holds all of them: shared q-grams are counted per item and
band; in bands that meet the bound they are counted per passage, and the passages that meet
it are verified by an alignment banded to the same diagonals.

The items are the stated query set.  They are read in blocks of bounded size; each block's
q-gram index is broadcast and its scan of the documents is one pass without a shuffle.

Every place of an item is reported, once: found passages that overlap in the text are one
place.  Its distance is that of the whole item where that lies within its own budget, else
the most edits of a passage there.  Where 8-grams leave no bound (some items under 32
characters) 4-grams are used, so that the same rate holds at every length; items shorter
than 8 characters are looked up as whole words.  Empty items match nothing.
Null texts count as empty and match nothing; null ids come through; repeated documents are
all reported, repeated items once; other columns are ignored.  Whole texts of any length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from quarry.llm.common import chunks, whole_text

WORD = re.compile(r"\w+")
Q, RATE, BLOCK_CHARS = 8, 0.1, 1_000_000
LEAST, MOST = 64, 160  # characters of a passage
BASE = 0x9E3779B97F4A7C15
FOUND = "array<struct<item_id:bigint,match_start:bigint,match_end:bigint,distance:bigint>>"
FOUND_TYPE = pa.list_(pa.struct([("item_id", pa.int64()), ("match_start", pa.int64()),
                                 ("match_end", pa.int64()), ("distance", pa.int64())]))


def plain(text: str) -> str:
    """Lower-case words joined by single spaces."""
    return " ".join(WORD.findall(text.lower()))


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def grams(c: np.ndarray, q: int = Q) -> np.ndarray:
    """Hashes of all q-grams (q a power of two), by doubling."""
    span, power = 1, BASE
    while span < q and len(c):
        c = c[:-span] * np.uint64(power) + c[span:] if len(c) > span else c[:0]
        span, power = span * 2, power * power % (1 << 64)
    return c


def budget(n: int, rate: float = RATE) -> int:
    """Edits allowed for n characters."""
    return int(n * rate)


def passages(n: int) -> tuple[int, list[int]]:
    """Length and starts of the passages of an item of n characters."""
    size = min(n, max(LEAST, min(n // 2, MOST)))
    step = max(1, size // 5)
    return size, sorted({*range(0, n - size + 1, step), n - size}) if n else []


def _edits(item: np.ndarray, region: np.ndarray, low: int, high: int, limit: int, free: bool) -> np.ndarray | None:
    """Edits of the whole ``item`` against the region up to place len(item) + diagonal, for
    the diagonals (region place minus item place) ``low`` to ``high``; None once all exceed
    ``limit``.  The match may begin anywhere if ``free``, else at the region's start.
    Places outside the region hold a character that equals none, which costs the same as
    skipping the item's."""
    n, width, before = len(item), high - low + 1, max(0, -low)
    after = max(0, high + n + 1 - len(region))
    outside = np.uint64(1 << 40)
    rows = sliding_window_view(np.pad(region, (before, after), constant_values=outside), width)[low + before:]
    step = np.arange(width, dtype=np.int32)
    diagonals = step + low
    cost = np.zeros(width, np.int32) if free else np.where(diagonals >= 0, diagonals, n + limit + 1).astype(np.int32)
    for at in range(0, n, 32):
        differ = (rows[at:at + 32][:len(item[at:at + 32])] != item[at:at + 32, None]).astype(np.int32)
        for d in differ:
            d += cost
            cost += 1  # skips a character of the item
            np.minimum(d[:-1], cost[1:], out=d[:-1])
            d -= step  # skips of the region's characters: a running minimum along the row
            np.minimum.accumulate(d, out=d)
            d += step
            cost = d
        if cost.min() > limit:
            return None
    return cost


def align(item: np.ndarray, region: np.ndarray, low: int, high: int, limit: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best match of the whole ``item`` inside ``region`` over
    alignments whose diagonals stay in [low, high], or None above ``limit`` edits."""
    cost = _edits(item, region, low, high, limit, True)
    if cost is None or cost.min() > limit:
        return None
    k = int(cost.argmin())
    end = min(len(region), max(0, len(item) + low + k))
    # the same match read backward from its end gives its start
    back = _edits(item[::-1], region[:end][::-1], -limit, limit, limit, False)
    length = len(item) - limit + int(back.argmin())
    return int(cost[k]), max(0, end - length), end


class GramIndex:
    """The q-grams of some items, by hash."""

    def __init__(self, items: list[int], codes_of: list[np.ndarray], q: int):
        self.q, hashes = q, [grams(codes_of[k], q) for k in items]
        allh = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        item = np.repeat(np.array(items, np.int64), [len(h) for h in hashes])
        place = np.concatenate([*(np.arange(len(h)) for h in hashes), np.zeros(0, np.int64)])
        order = np.argsort(allh, kind="stable")
        self.item, self.place = item[order], place[order]
        self.keys, self.first = np.unique(allh[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(order)))
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Item, place in the item, place in the text of all shared q-grams."""
        if not len(self.keys):
            return None
        h = grams(c, self.q)
        at = np.flatnonzero(self.seen[(h >> np.uint64(44)).astype(np.int64)])
        slot = np.searchsorted(self.keys, h[at])
        slot[slot == len(self.keys)] = 0
        hit = self.keys[slot] == h[at]
        at, slot = at[hit], slot[hit]
        n = self.count[slot]
        if not n.sum():
            return None
        entry = np.repeat(self.first[slot] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        return self.item[entry], self.place[entry], np.repeat(at, n)


class ItemIndex:
    """Q-gram indexes over a block of items (id, text)."""

    def __init__(self, items: list[tuple[int | None, str]], q: int = Q, rate: float = RATE):
        self.ids = [i for i, _ in items]
        self.texts = [plain(t) for _, t in items]
        self.codes = [codes(t) for t in self.texts]
        sizes = [len(t) for t in self.texts]
        self.size, self.starts = zip(*map(passages, sizes)) if sizes else ((), ())
        self.whole = [budget(n, rate) for n in sizes]
        self.edits = np.array([budget(n, rate) for n in self.size], np.int64)
        long, short = (np.array(self.size, np.int64) >= k * (self.edits + 1) for k in (q, q // 2))
        self.short = [k for k, n in enumerate(sizes) if 0 < n < q or n and not short[k]]
        grouped = {q: [k for k, n in enumerate(sizes) if n >= q and long[k]],
                   q // 2: [k for k, n in enumerate(sizes) if n >= q and not long[k] and short[k]]}
        self.q = np.where(long, q, q // 2)
        self.bound = np.array(self.size, np.int64) + 1 - self.q - self.q * self.edits
        self.grams = [GramIndex(own, self.codes, k) for k, own in grouped.items()]

    def bands(self, c: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
        """(item, lowest and highest diagonal, places in the item and in the text of the
        shared q-grams) of the bands that meet the bound, the fullest first; the diagonals
        reach one width past the band, since an alignment may stray there between its kept
        q-grams."""
        good = []
        for index in self.grams:
            if (found := index.hits(c)) is None:
                continue
            item, place, at = found
            # cells of one band width; a band is a cell and the next
            span = 1 << 32
            cell = item * span + (at - place) // (2 * self.edits[item] + 1) + (span >> 1)
            order = np.argsort(cell, kind="stable")
            cell, place, at = cell[order], place[order], at[order]
            first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
            key, last = cell[first], np.append(first[1:], len(cell))
            joined = np.append(key[1:] == key[:-1] + 1, False)
            last = np.where(joined, np.append(last[1:], 0), last)
            for k in np.flatnonzero(last - first >= self.bound[key // span]).tolist():
                i, mine = int(key[k] // span), slice(first[k], last[k])
                width = 2 * int(self.edits[i]) + 1
                low = int(key[k] % span - (span >> 1)) * width
                good.append((i, low - width, low + 3 * width, place[mine], at[mine]))
        return iter(sorted(good, key=lambda g: -len(g[3])))

    def passage(self, text: str, c: np.ndarray, k: int, start: int, size: int, limit: int, low: int, high: int) -> tuple[int, int, int] | None:
        """(edits, start, end) in the text of a part of item ``k``, near these diagonals."""
        begin, end = max(0, low + start), min(len(c), high + start + size + 1)
        if end <= begin:
            return None
        p = text.find(self.texts[k][start:start + size], begin, end)
        if p >= 0:
            return 0, p, p + size
        found = align(self.codes[k][start:start + size], c[begin:end], low + start - begin, high + start - begin, limit)
        return found and (found[0], begin + found[1], begin + found[2])

    def search(self, text: str) -> list[tuple]:
        """(item id, start, end, edits) of every place of every item found in the text."""
        text = plain(text)
        out = []
        for k in self.short:
            n, p = len(self.texts[k]), f" {text} ".find(f" {self.texts[k]} ")
            while p >= 0:
                out.append((self.ids[k], p, p + n, 0))
                p = f" {text} ".find(f" {self.texts[k]} ", p + n)
        c, places = codes(text), {}
        for k, low, high, place, at in self.bands(c):
            known, size, limit = places.setdefault(k, []), self.size[k], int(self.edits[k])
            before = list(known)
            # what lies in places already found is not counted again
            new = np.ones(len(at), bool)
            for a, b, _ in known:
                new &= (at < a) | (at >= b)
            place, at = place[new], at[new]
            order = np.argsort(place, kind="stable")
            place, at = place[order], at[order]
            starts = np.array(self.starts[k])
            from_, to = np.searchsorted(place, starts), np.searchsorted(place, starts + size - int(self.q[k]), "right")
            for j in np.flatnonzero(to - from_ >= self.bound[k]).tolist():
                mine = slice(from_[j], to[j])
                # each kept q-gram of the item meets a place of its own in the text
                if min(len(np.unique(place[mine])), len(np.unique(at[mine]))) < self.bound[k]:
                    continue
                if found := self.passage(text, c, k, int(starts[j]), size, limit, low, high):
                    d, a, b = found
                    if len(starts) > 1:
                        for other in [x for x in known if x[0] <= b and a <= x[1]]:
                            known.remove(other)
                            a, b, d = min(a, other[0]), max(b, other[1]), max(d, other[2])
                    elif any(x[0] < b and a < x[1] for x in known):
                        continue
                    known.append((a, b, d))
            # a place that holds the whole item within its own budget
            if len(starts) > 1:
                for at_place in [x for x in known if x not in before]:
                    a, b, d = at_place
                    if b - a >= len(self.texts[k]) - self.whole[k] and low <= a <= high:
                        if found := self.passage(text, c, k, 0, len(self.texts[k]), self.whole[k], low, high):
                            known.remove(at_place)
                            known.append((min(a, found[1]), max(b, found[2]), found[0]))
        out += [(self.ids[k], *p) for k, found in places.items() for p in found]
        return sorted(out, key=lambda m: (m[0] is None, m[0], m[1]))


def item_blocks(items: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple]]:
    """Distinct items (item_id, text) in blocks of about ``block_chars`` characters."""
    kept = items.select(F.col("item_id").cast("long"), F.col("text")).filter("text <> ''").distinct()
    total = kept.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    blocks = max(1, math.ceil(total / block_chars))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for b in range(blocks if total else 0):
        yield [(r.item_id, r.text) for r in kept.filter(part == b).orderBy("item_id", "text").collect()]


def matches(docs: DataFrame, items: DataFrame, q: int = Q, rate: float = RATE,
            block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, match_start, match_end (in the plain text), distance: one row per
    row of ``docs``, item found in it and place."""
    found = [_found(docs.select("doc_id", whole_text().alias("text")), block, q, rate)
             .select("doc_id", F.inline("__found")) for block in item_blocks(items, block_chars)]
    if not found:
        return docs.select("doc_id", F.inline(F.lit(None).cast(FOUND)))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _found(docs: DataFrame, block: list[tuple], q: int, rate: float) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(ItemIndex(block, q, rate))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [pa.array([[dict(zip(("item_id", "match_start", "match_end", "distance"), m))
                                for m in held.value.search(t)] for t in c.to_pylist()], type=FOUND_TYPE)
                     for c in chunks(batch)]
            yield pa.concat_arrays(parts) if parts else pa.array([], type=FOUND_TYPE)

    return docs.withColumn("__found", arrow_udf(run, FOUND)(F.col("text")))


def clean(docs: DataFrame, items: DataFrame, q: int = Q, rate: float = RATE,
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    for block in item_blocks(items, block_chars):
        packed = docs.select(F.struct("*").alias("__row"), whole_text().alias("text"))
        docs = _found(packed, block, q, rate).filter(F.size("__found") == 0).select("__row.*")
    return docs
