"""Documents packed into as few sequences of at most ``capacity`` tokens as we can.

Only documents longer than ``capacity`` are cut: every piece but the first is full.  Lengths
are small integers, so the packing problem is a histogram of at most ``capacity`` rows, and
the whole plan is made on it, whatever the number of documents:

* Dominance (Martello and Toth): a set with the longest piece left that dominates every
  other set with that piece is part of some best packing, so it is fixed, as often as its
  lengths last: a piece that nothing fits; the longest partner, if it fills the sequence, if
  no two other pieces fit, or if no pair that fits is longer; the longest partner and the
  longest that fits beside it, if at most two fit and no pair has two longer members.  This
  runs until nothing more can be fixed.
* Best fit, longest first, packs what is left; equal sequences are kept as one row with a
  number of copies.

The tasks that encode number their pieces among equal lengths; sums over (task, length) turn
this into the rank among all pieces of a length, and the rank is looked up in the plan's
slots of that length.  No text, token or piece goes to the driver; sequences are not sorted
or collected to be filled.

Defined results: a null text counts as empty (only the end id); a null ``doc_id`` is packed
like any other; repeated rows are all packed; ties are dealt in the order of the tasks.
Other columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from quarry.llm.common import broadcast_file, chunks, per_worker, whole_text, written
from quarry.llm.token_files import WordEncoder

Rows = list[tuple[tuple[tuple[int, int], ...], int]]  # ((length, copies), ...) and how many sequences


# -- the plan, on a histogram: counts[s] pieces of length s

def dominating(counts: np.ndarray, size: int) -> list[int] | None:
    """Lengths of a set with ``size`` that dominates all other sets with it, or None."""
    room, left = len(counts) - 1 - size, counts.copy()
    left[size] -= 1
    held = np.flatnonzero(left)
    least = np.repeat(held[:3], np.minimum(left[held[:3]], 3))[:3]
    if not len(least) or least[0] > room:
        return [size]
    longest = int(held[np.searchsorted(held, room, "right") - 1])
    if longest == room or len(least) < 2 or least[:2].sum() > room:
        return [size, longest]
    if len(least) == 3 and least.sum() <= room:
        return None
    # at most two pieces fit beside this one: the longest fitting partner of each length
    at = np.searchsorted(held, np.minimum(held, room - held), "right") - 1
    lone = (at >= 0) & (held[at] == held) & (left[held] < 2)  # no second piece of its own length
    at = np.where(lone, at - 1, at)
    pairs = (held + held[at])[at >= 0]
    if not len(pairs) or longest >= pairs.max():
        return [size, longest]
    left[longest] -= 1
    second = np.flatnonzero(left[:room - longest + 1])
    if not len(second):
        return None
    longer = np.flatnonzero(left[second[-1] + 1:])[:2] + second[-1] + 1
    two = np.repeat(longer, np.minimum(left[longer], 2))[:2]
    return [size, longest, int(second[-1])] if len(two) < 2 or two.sum() > room else None


def fix_dominating(counts: np.ndarray) -> tuple[Rows, np.ndarray]:
    """Sequences fixed by dominance, and the histogram of the pieces left."""
    counts, fixed, went_on = counts.copy(), [], True
    while went_on:
        went_on = False
        for size in np.flatnonzero(counts)[::-1].tolist():
            while counts[size] and (found := dominating(counts, size)):
                row = tuple(Counter(found).items())
                # with fewer pieces left there are fewer sets to dominate: it stays right
                times = min(int(counts[s]) // n for s, n in row)
                for s, n in row:
                    counts[s] -= n * times
                fixed.append((row, times))
                went_on = True
    return fixed, counts


def best_fit(counts: np.ndarray) -> Rows:
    """Best fit, longest first: every piece into the fullest sequence that takes it."""
    capacity, open_rows, rooms = len(counts) - 1, {}, []

    def put(row: tuple, times: int, room: int) -> None:
        if room not in open_rows:
            open_rows[room] = []
            insort(rooms, room)
        open_rows[room].append((row, times))

    for size in np.flatnonzero(counts)[::-1].tolist():
        n = int(counts[size])
        while n:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                each = capacity // size
                if n >= each:
                    put(((size, each),), n // each, capacity - each * size)
                if n % each:
                    put(((size, n % each),), 1, capacity - n % each * size)
                break
            room = rooms[at]
            row, times = open_rows[room].pop()
            if not open_rows[room]:
                del open_rows[room], rooms[at]
            each = room // size
            full = min(times, n // each)
            if full:
                put(row + ((size, each),), full, room - each * size)
                n, times = n - full * each, times - full
            if times and n:
                put(row + ((size, n),), 1, room - n * size)
                n, times = 0, times - 1
            if times:
                put(row, times, room)
    return [found for room in rooms for found in open_rows[room]]


def plan(counts: np.ndarray) -> Rows:
    fixed, left = fix_dominating(counts)
    return fixed + best_fit(left)


def least_sequences(counts: np.ndarray) -> int:
    """A lower bound on any packing (Martello and Toth's second): pieces longer than
    capacity - a stand apart from each other and from those of a or longer."""
    capacity, sizes = len(counts) - 1, np.arange(len(counts))
    best = 0
    for a in range(capacity // 2 + 1):
        alone = counts[capacity - a + 1:].sum()
        half = slice(capacity // 2 + 1, capacity - a + 1)
        middle = counts[half].sum()
        room = middle * capacity - (counts[half] * sizes[half]).sum()
        small = (counts * sizes)[a:capacity // 2 + 1].sum()
        best = max(best, int(alone + middle + max(0, -(-(small - room) // capacity))))
    return best


class Slots:
    """Where the piece of a length and a rank among its equals goes."""

    def __init__(self, counts: np.ndarray, rows: Rows):
        self.before = np.append(0, np.cumsum(counts))  # pieces of lesser lengths
        taken, found, sequence = np.zeros(len(counts), np.int64), [], 0
        for row, times in rows:
            place = 0
            for size, each in row:
                found.append((int(self.before[size] + taken[size]), size, each, sequence, place))
                taken[size] += each * times
                place += size * each
            sequence += times
        self.first, self.size, self.each, self.sequence, self.place = np.array(sorted(found), np.int64).reshape(-1, 5).T

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of every piece."""
        number = self.before[length] + rank
        at = np.searchsorted(self.first, number, "right") - 1
        inside = number - self.first[at]
        return self.sequence[at] + inside // self.each[at], self.place[at] + inside % self.each[at] * self.size[at]


# -- documents

def pieces(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (of the piece's ids) and, if asked for, ids;
    ``file_key`` and ``nth`` number the pieces of a length within a task."""
    held = broadcast_file(docs.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, key, seen = per_worker(WordEncoder, held.value), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            at = 0
            for part in chunks(batch.column("text"), rows=1 << 16, nbytes=4 << 20):
                lists = encoder(part, end_id)
                ends = lists.offsets.to_numpy().astype(np.int64)
                sizes = np.diff(ends)
                cuts = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(part)), cuts)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                # all pieces but the first are full
                stop = sizes[doc] - (cuts[doc] - 1 - number) * capacity
                start = np.maximum(stop - capacity, 0)
                length, first = stop - start, ends[doc] + start
                raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(), "<u4")).cast("B")
                crc = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist())]
                # the rank among equal lengths of this task
                order = np.argsort(length, kind="stable")
                counts = np.bincount(length, minlength=capacity + 1)
                nth = np.empty(len(doc), np.int64)
                nth[order] = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(seen, counts)
                seen += counts
                columns = {"doc_id": batch.column("doc_id").slice(at, len(part)).take(pa.array(doc)), "piece": pa.array(number, pa.int32()),
                           "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(crc, pa.int64()),
                           "file_key": pa.array(np.full(len(doc), key, np.int32)), "nth": pa.array(nth)}
                if with_ids:
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)), pa.int32()), lists.values.slice(ends[0], ends[-1] - ends[0]))
                yield pa.RecordBatch.from_pydict(columns)
                at += len(part)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, file_key int, nth long" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(run, schema)


def place(cut: DataFrame, capacity: int = 1024) -> DataFrame:
    """``cut`` (a written table of ``pieces``) with sequence_id and offset."""
    per_task = cut.groupBy("file_key", "length").agg(F.count(F.lit(1)).alias("__n"))
    counts = np.zeros(capacity + 1, np.int64)
    for r in per_task.groupBy("length").agg(F.sum("__n").alias("n")).collect():  # capacity rows at most
        counts[r.length] = r.n
    slots = Slots(counts, plan(counts))
    earlier = Window.partitionBy("length").orderBy("file_key").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("file_key", "length", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for length, rank in batches:
            sequence, offset = slots(length.to_numpy(), rank.to_numpy())
            yield pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], names=["sequence_id", "offset"])

    found = arrow_udf(run, "struct<sequence_id:long,offset:long>")(F.col("length"), F.col("nth") + F.col("__before"))
    return cut.join(before, ["file_key", "length"]).withColumn("__at", found).select(
        *[c for c in cut.columns if c not in ("file_key", "nth")], "__at.*")


def pack(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset of every piece."""
    return place(written(pieces(docs, vocabulary, capacity, end_id, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids and its parts (doc_id, piece, offset, length) in order, from
    ``pack(with_ids=True)``; a sequence holds ``capacity`` tokens at most."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "piece", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten("p.ids").alias("ids"),
                        F.transform("p", lambda x: x.dropFields("ids")).alias("parts"))
