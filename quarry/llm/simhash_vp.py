"""Near duplicates by SimHash fingerprints and a vantage-point tree.

Fingerprint: lower-case A-Z, words ``[^\\x20\\x09-\\x0D]+``, shingles of ``words`` words
joined by one space (repeats count; shorter texts are one shingle; a text without words has
fingerprint zero and links like any other).  Each shingle is hashed with XXH64 (UTF-8, seed
42); a bit is 1 if set in over half of the hashes.  Fingerprints link at ``radius`` or fewer
differing bits, and a component is what links reach.

Search: only distinct fingerprints take part.  Level i of the tree measures the Hamming
distance to a vantage code on its own slice of the bits and splits by that distance.  On
one slice the triangle bound says that two linked fingerprints differ by no more than their
differing bits there; slices are disjoint, so along a path these differences add up to at
most ``radius``.  The top levels cut the fingerprints into shards, named by the distances.
A fingerprint resides in its own shard and is sent as a query to the later ones (in the
order of names) that its distances reach within the radius, so the shards on both sides of
a boundary overlap and every linked pair meets in the shard of its later member.  A shard
is one task (one with more than ``GROUP`` rows, as a large family of near copies makes,
is counted and dealt to several): it prunes further with finer slices in the same way, compares what is left
exactly, joins links in a union-find and returns at most one link per fingerprint.  Stars
of links are merged by alternating large-star and small-star rounds, each written to the
shared folder; nothing of the corpus goes to the driver but a bounded sample for choosing
the vantage codes.

Defined results: null text as empty; rows with a null ``doc_id`` link like others but name
a component (with null) only if it has no id; repeated rows share a component.  Other columns pass through ``dedupe`` unread.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import text_udf, whole_text, written

SAMPLE = 2048  # fingerprints that choose the vantage codes
PAIRS = 1 << 21  # pairs compared at once in a shard
GROUP = 1 << 17  # rows of a shard, or of a block of a large one, in a task


# -- fingerprints

def fingerprint_bits(text: str, words: int) -> int:
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined, digest = b" ".join(parts), xxhash.xxh64_digest
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(words, len(parts))
    starts, ends = starts[:len(parts) - span + 1].tolist(), ends[span - 1:].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), 65536):
        raw = b"".join([digest(joined[a:b], 42) for a, b in zip(starts[at:at + 65536], ends[at:at + 65536])])
        counts += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(starts)).tobytes(), "big", signed=True)


def fingerprint(text: Column, words: int) -> Column:
    """The fingerprint as a signed 64-bit integer."""
    udf = text_udf(lambda: lambda texts: [(fingerprint_bits(t, words),) for t in texts], {"fp": "long"})
    return udf(text)["fp"]


# -- the tree

class Tree:
    """Slices of the 64 bits and a vantage code; ``levels`` slices name a shard."""

    def __init__(self, sample: np.ndarray, levels: int, radius: int):
        self.levels, self.radius = levels, radius
        self.top, self.fine = self._slices(levels), self._slices(16)
        self.vantage = self._choose(sample)
        self.steps = [s for s in self._signed(levels, radius) if s >= (0,) * levels]

    @classmethod
    def _signed(cls, levels: int, budget: int) -> list[tuple[int, ...]]:
        """Changes of the distances, one a level, that add up to ``budget`` at most."""
        if not levels:
            return [()]
        return [(j, *rest) for j in range(-budget, budget + 1) for rest in cls._signed(levels - 1, budget - abs(j))]

    @staticmethod
    def _slices(n: int) -> list[np.uint64]:
        cuts = [round(64 * i / n) for i in range(n + 1)]
        return [np.uint64(((1 << b) - 1) ^ ((1 << a) - 1)) for a, b in zip(cuts, cuts[1:])]

    def _choose(self, sample: np.ndarray) -> np.uint64:
        """Slice by slice, the sampled code whose distances spread most."""
        code = np.uint64(0)
        for mask in self.top:
            best, spread = np.uint64(0), -1.0
            for v in sample[:32]:
                s = float(np.bitwise_count((sample ^ v) & mask).std())
                if s > spread:
                    best, spread = v & mask, s
            code |= best
        return code

    def distances(self, codes: np.ndarray, mask: np.uint64) -> np.ndarray:
        return np.bitwise_count((codes ^ self.vantage) & mask).astype(np.int16)

    def route(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index, shard, resident) for each code's own shard and the later shards that
        the triangle bound lets it reach."""
        width = [int(np.bitwise_count(m)) for m in self.top]
        own = [self.distances(codes, m) for m in self.top]
        zero = (0,) * self.levels
        index, shard, home = [], [], []
        for s in self.steps:
            at = [d + j for d, j in zip(own, s)]
            fits = np.logical_and.reduce([(a >= 0) & (a <= w) for a, w in zip(at, width)])
            found = np.flatnonzero(fits)
            name = np.zeros(len(found), np.int64)
            for a in at:
                name = name * 65 + a[found]
            index.append(found)
            shard.append(name)
            home.append(np.full(len(found), s == zero))
        return np.concatenate(index), np.concatenate(shard), np.concatenate(home)


def join_links(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merges the classes of a[i] and b[i]; ``root`` points every item to its class's
    smallest item."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b = ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def shard_links(tree: Tree, codes: np.ndarray, residents: int) -> np.ndarray:
    """Class pointers among ``codes``, whose first ``residents`` live in this shard: links
    of residents with anyone, found through the finer slices."""
    root = np.arange(len(codes))
    dist = [tree.distances(codes, m) for m in tree.fine]

    def compare(own: np.ndarray, asks: np.ndarray) -> None:
        step = max(1, PAIRS // len(asks))
        for at in range(0, len(own), step):
            block = own[at:at + step]
            i, j = np.nonzero(np.bitwise_count(codes[block][:, None] ^ codes[asks][None, :]) <= tree.radius)
            join_links(root, block[i], asks[j])

    stack = [(np.arange(residents), np.arange(len(codes)), np.full(len(codes), tree.radius, np.int16), 0)]
    while stack:
        own, asks, left, level = stack.pop()
        if level == len(tree.fine) or len(own) * len(asks) <= 1 << 15:
            if len(own) and len(asks) > 1:
                compare(own, asks)
            continue
        d_own, d_asks = dist[level][own], dist[level][asks]
        for ring in np.unique(d_own):
            off = np.abs(d_asks - ring)
            near = off <= left
            stack.append((own[d_own == ring], asks[near], (left - off)[near], level + 1))
    return root


def tree_levels(n: int, most: int = 1_000_000) -> int:
    """Slices that name a shard: the fewest, two or more, for which evenly spread
    fingerprints put about ``most`` into the largest shard (that of the middle distances)."""
    def share(levels: int) -> float:
        widths = [int(np.bitwise_count(m)) for m in Tree._slices(levels)]
        return math.prod(math.comb(w, w // 2) / 2 ** w for w in widths)
    return next((k for k in range(2, 10) if n * share(k) <= most), 10)


def links(codes: DataFrame, radius: int, levels: int | None = None, group: int = GROUP) -> DataFrame:
    """(u, v), v < u: links that join the same classes as all pairs of distinct codes
    (column fp) within ``radius`` bits; at most one per code and shard."""
    n = codes.count()
    sample = np.array([r.fp for r in codes.orderBy(F.xxhash64("fp")).limit(SAMPLE).collect()], np.int64)
    tree = Tree(sample.view(np.uint64), levels or tree_levels(n), radius)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            all_codes = b.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(all_codes), 4096):
                part = all_codes[at:at + 4096]
                i, shard, home = tree.route(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(part[i]), pa.array(home)],
                                                 names=["shard", "fp", "home"])

    def search(group: pa.Table) -> pa.Table:
        fp = group.column("fp").to_numpy()
        home = group.column("home").to_numpy()
        order = np.argsort(~home, kind="stable")
        ordered = np.ascontiguousarray(fp[order]).astype(np.int64)
        root = shard_links(tree, ordered.view(np.uint64), int(home.sum()))
        u, v = ordered, ordered[root]
        u, v = u[u != v], v[u != v]
        return pa.table({"u": np.maximum(u, v), "v": np.minimum(u, v)})

    routed = written(codes.select("fp").mapInArrow(route, "shard long, fp long, home boolean"), "simhash-routed")
    # little data but much work per byte: keep all partitions instead of joining small ones
    tasks = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = in_blocks(routed, group).repartition(tasks, "shard", "own", "ask")
    return groups.groupBy("shard", "own", "ask").applyInArrow(search, "u long, v long")


def in_blocks(routed: DataFrame, group: int) -> DataFrame:
    """shard, own, ask, fp, home: the rows of a shard that holds more than ``group`` are
    dealt by hash, residents to blocks ``own`` and all members to blocks ``ask``, so that
    every resident meets every member in the group of their two blocks."""
    large = (routed.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.count_if("home").alias("residents"))
                   .filter(F.col("n") > group)
                   .select("shard", F.ceil(F.col("residents") / group).alias("owns"), F.ceil(F.col("n") / group).alias("asks")))
    # written first: a few rows, so that the planner knows its size
    rows = routed.join(written(large, "simhash-large-shards"), "shard", "left")
    h = F.xxhash64("fp")
    own, ask = F.pmod(h, F.col("owns")), F.pmod(h, F.col("asks"))

    def place(own, ask, home):
        return F.struct(own.cast("long").alias("own"), ask.cast("long").alias("ask"), home.alias("home"))

    lives = F.transform(F.sequence(F.lit(0), F.col("asks") - 1), lambda j: place(own, j, F.lit(True)))
    asks = F.transform(F.sequence(F.lit(0), F.col("owns") - 1), lambda i: place(i, ask, F.lit(False)))
    # visitors of a shard without residents have nothing to ask
    whole = F.array(place(F.lit(0), F.lit(0), F.col("home")))
    parts = (F.when(F.col("owns").isNull(), whole).when(F.col("owns") == 0, F.slice(whole, 1, 0))
              .when(F.col("home"), F.concat(lives, asks)).otherwise(asks))
    return rows.select("shard", "fp", F.explode(parts).alias("p")).select("shard", "fp", "p.*")


def stars(edges: DataFrame) -> DataFrame:
    """(node, root): every linked node with the smallest node of its component."""
    now, mark = written(edges.distinct(), "simhash-links"), None
    while True:
        seen = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if (seen.n, seen.h) == mark or not seen.n:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = (seen.n, seen.h)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "simhash-large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "simhash-stars")


# -- documents

def components(docs: DataFrame, words: int = 3, radius: int = 3, levels: int | None = None) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row."""
    marks = written(docs.select(F.col("doc_id").cast("long"), fingerprint(whole_text(), words).alias("fp")),
                    "simhash-fingerprints")
    return _components(marks, radius, levels)


def _classes(codes: DataFrame, radius: int, levels: int | None) -> DataFrame:
    """fp, first (a row's key), root: every fingerprint with the one that names its component."""
    roots = stars(links(codes, radius, levels)).withColumnRenamed("node", "fp")
    return codes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def _components(marks: DataFrame, radius: int, levels: int | None) -> DataFrame:
    known = _classes(written(marks.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-codes"), radius, levels)
    lowest = known.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = known.join(lowest, "root").select("fp", "component_id")
    return (marks.join(classes, "fp")
                 .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def dedupe(docs: DataFrame, words: int = 3, radius: int = 3, levels: int | None = None) -> DataFrame:
    """One row of each component, with all its columns: that with the smallest ``doc_id``
    (without any id, a nameless one), the smallest fingerprint among repeated ids, and any
    one of rows that agree in both.  Only rows whose id is null or repeated are
    fingerprinted again, to tell them apart."""
    marks = written(docs.select(F.col("doc_id").cast("long"), fingerprint(whole_text(), words).alias("fp")),
                    "simhash-fingerprints")
    key = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "fp")
    codes = written(marks.groupBy("fp").agg(F.min(key).alias("first")), "simhash-codes")
    kept = _classes(codes, radius, levels).groupBy("root").agg(F.min("first").alias("k"))
    kept = kept.select(F.col("k.doc_id").alias("__id"), F.col("k.fp").alias("__fp"))
    often = marks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("__n")).withColumnRenamed("doc_id", "__of")
    kept = written(kept.join(often, F.col("__id").eqNullSafe(F.col("__of"))).drop("__of"), "simhash-kept")
    packed = docs.select(F.struct("*").alias("__row"), F.col("doc_id").cast("long").alias("__doc"), whole_text().alias("__text"))
    single = (F.col("__n") == 1) & F.col("__id").isNotNull()
    plain = packed.join(kept.filter(single), F.col("__doc") == F.col("__id"), "left_semi").select("__row.*")
    # written: usually no or few rows, and the planner then knows it
    unclear = written(kept.filter(~single).select("__id", "__fp"), "simhash-unclear")
    again = (packed.join(unclear, F.col("__doc").eqNullSafe(F.col("__id")), "left_semi")
                   .withColumn("__own", fingerprint(F.col("__text"), words))
                   .join(unclear, F.col("__doc").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__fp")), "left_semi")
                   .dropDuplicates(["__doc", "__own"]).select("__row.*"))
    return plain.unionByName(again)
