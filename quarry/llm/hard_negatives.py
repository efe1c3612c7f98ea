"""Hard negatives by cover trees over norm-augmented vectors.

Components are floored multiples of 1/256; a score is the integer inner product.  For every
anchor and each of its best rows of the same label (its positives), the best rows of other
labels are searched whose score lies in a window set by the positive's score.

Search.  A coordinate sqrt(M^2 - |x|^2) is added to every candidate, so that all lie on one
sphere of radius M and a high inner product is a small angle.  Candidates are dealt to cells
(the nearest of at most 256 pivots), a large cell to several shards of bounded size by hash.
A shard is one task's cover tree: the root covers its rows, the children of a node are a net
of centres more than half of the node's covering radius apart, and so on; every node keeps
the true radius that covers its rows.  Centre and radius bound the angles, hence the inner
products, of all rows below a node from both sides.  A query descends best first: nodes
whose bounds lie outside its window, or below the k-th best score found, are skipped, and
leaves are verified with exact integer scores.  The same bounds decide which cells a query
visits at all; the k-th best score in a bounded sample of rows starts the lower end.

Scale.  Equal (vector, label) rows score alike and ties go to smaller ids, so only the
least ``negatives`` (or positives + 1) of them can ever be returned and the others are left
out before anything is compared; anchors with equal vector and label are one query.  Shards
hold about ``SHARD`` rows and blocks about ``BLOCK`` queries: a task joins one shard with
one block, and returns at most k rows per query.

Defined results: rows with a null label or vector or a null or non-finite component take no
part, nor do rows whose floored components have a squared length above 2^62 (their scores
fit no long).  Shorter vectors count as padded by zeros.  A null ``vec_id`` is no anchor and
comes last among ties.  Repeated rows are rows of their own: another copy of the anchor is
one of its positives.  Other columns are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import written

SAMPLE, PIVOTS, SHARD, BLOCK, LEAF = 2048, 256, 4096, 4096, 16
MOST = 2.0 ** 62


def floored(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label, v (integers, padded to one length) of the rows that take part."""
    x = F.col("embedding")
    scaled = F.transform(x, lambda c: c.cast("double") * scale)
    size = F.aggregate(scaled, F.lit(0.0), lambda s, c: s + F.floor(c).cast("double") * F.floor(c).cast("double"))
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * scale) < MOST))
    rows = (vectors.select("vec_id", F.col("label").cast("long").alias("label"), "embedding")
                   .filter(F.col("label").isNotNull() & x.isNotNull())
                   .filter(F.when(sound, size <= MOST).otherwise(False))
                   .select(F.col("vec_id").cast("long"), "label", F.transform(scaled, lambda c: F.floor(c).cast("long")).alias("v")))
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    return rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(longest) - F.size("v"))))


def matrix(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Equally long integer lists as rows."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def exact_type(*sets: np.ndarray) -> type:
    """The fastest type in which inner products of these rows are exact: every partial sum
    is bounded by the product of two lengths."""
    longest = max((float((s.astype(np.float64) ** 2).sum(1).max()) for s in sets if len(s)), default=0.0)
    return np.float64 if longest < 2.0 ** 52 else np.int64


class CoverTree:
    """Node i has the centre ``center[i]`` (a row), the angle ``angle[i]`` that covers its rows,
    and either children ``child[i]`` to ``child_end[i]`` or the rows ``order[first[i]:last[i]]``."""

    def __init__(self, rows: np.ndarray):
        self.rows, real = rows, rows.astype(np.float64)
        self.real, squares = real, (real ** 2).sum(1)
        self.norm = math.sqrt(squares.max()) if len(rows) else 0.0
        self.lift = np.sqrt(np.maximum(self.norm ** 2 - squares, 0.0))
        center, radius, spans, kids, order, held = [], [], [], [], [], 0
        level = [(np.arange(len(rows)), 0, self.distance(np.arange(len(rows)), 0))] if len(rows) else []
        while level:  # a level of the tree, its nodes in the order of their parents
            below = []
            for own, middle, far in level:
                reach = float(far.max())
                center.append(middle)
                radius.append(reach)
                if len(own) <= LEAF or reach == 0.0:
                    kids.append((0, 0))
                    spans.append((held, held + len(own)))
                    order.append(own)
                    held += len(own)
                else:
                    parts, at = self.net(own, middle, far), len(below)
                    kids.append((at, at + len(parts)))
                    spans.append((0, 0))
                    below += parts
            # children so far are numbered from the start of the next level
            base, done = len(center), len(center) - len(level)
            for i in range(done, base):
                if kids[i][1]:
                    kids[i] = (kids[i][0] + base, kids[i][1] + base)
            level = below
        self.center = rows[np.array(center, np.int64)]
        self.angle = cap_angle(np.array(radius), self.norm)
        self.child, self.child_end = np.array(kids, np.int64).reshape(-1, 2).T
        self.first, self.last = np.array(spans, np.int64).reshape(-1, 2).T
        self.leaf = self.child == self.child_end
        self.order = np.concatenate(order) if order else np.zeros(0, np.int64)

    def distance(self, own: np.ndarray, middle: int) -> np.ndarray:
        """On the sphere; below a millionth of its radius counts as none (see SLACK)."""
        inner = self.real[own] @ self.real[middle] + self.lift[own] * self.lift[middle]
        squares = 2 * (self.norm ** 2 - inner)
        return np.sqrt(np.where(squares < 1e-12 * self.norm ** 2, 0.0, squares))

    def net(self, own: np.ndarray, middle: int, far: np.ndarray) -> list[tuple[np.ndarray, int, np.ndarray]]:
        """Centres more than half the node's radius apart, the farthest row first, each with
        the rows nearest to it."""
        reach, near, owner, found = far.max() / 2, far.copy(), np.zeros(len(own), np.int64), [middle]
        while near[k := int(near.argmax())] > reach:
            d = self.distance(own, own[k])
            d[k] = 0.0
            closer = d < near
            owner[closer], near[closer] = len(found), d[closer]
            found.append(int(own[k]))
        by, cuts = np.argsort(owner, kind="stable"), np.cumsum(np.bincount(owner, minlength=len(found)))[:-1]
        return list(zip(np.split(own[by], cuts), found, np.split(near[by], cuts)))

    def leaf_rows(self, nodes: np.ndarray) -> np.ndarray:
        return self.order[ranges(self.first[nodes], self.last[nodes])]

    def search(self, query: np.ndarray, wanted: np.ndarray, low: int, high: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the wanted rows from ``low`` to ``high`` whose score is among the
        k best there; all that tie with the last of them are returned."""
        length = math.sqrt(float((query.astype(np.float64) ** 2).sum()))
        rows, scores, agenda = np.zeros(0, np.int64), np.zeros(0, self.rows.dtype), [(-math.inf, -1)]
        while agenda:
            bound, node = heapq.heappop(agenda)
            if -bound < low:
                break
            a, b = (0, min(1, len(self.center))) if node < 0 else (self.child[node], self.child_end[node])
            lower, upper = cap_bounds(self.center[a:b] @ query, self.angle[a:b], self.norm * length)
            inside = (upper >= low) & (lower <= high)
            for i in np.flatnonzero(inside & ~self.leaf[a:b]).tolist():
                heapq.heappush(agenda, (-float(upper[i]), int(a) + i))
            more = self.leaf_rows(a + np.flatnonzero(inside & self.leaf[a:b]))
            more = more[wanted[more]]
            exact = self.rows[more] @ query
            fits = (exact >= low) & (exact <= high)
            rows, scores = np.append(rows, more[fits]), np.append(scores, exact[fits])
            if len(rows) >= k:
                low = max(low, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
                rows, scores = rows[scores >= low], scores[scores >= low]
        return rows, scores


SLACK = 4e-6  # of the largest inner product: what rounding and the least distance can hide


def cap_angle(radius: np.ndarray, norm: float) -> np.ndarray:
    """The angle of a chord of this length on the sphere."""
    return 2 * np.arcsin(np.minimum(1.0, radius / (2 * norm))) if norm else np.zeros(len(radius))


def cap_bounds(score: np.ndarray, angle: np.ndarray, largest: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product with rows within ``angle`` of a centre of ``score``."""
    if not largest:
        return np.zeros(len(angle)) - 1, np.zeros(len(angle)) + 1
    off = np.arccos(np.clip(score / largest, -1.0, 1.0))
    slack = SLACK * largest + 1
    return (largest * np.cos(np.minimum(np.pi, off + angle)) - slack,
            largest * np.cos(np.maximum(0.0, off - angle)) + slack)


def least_rows(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` least ids of each (vector, label)."""
    order = Window.partitionBy("v", "label").orderBy(F.asc_nulls_last("vec_id"))
    return rows.withColumn("__r", F.row_number().over(order)).filter(F.col("__r") <= n).drop("__r")


class Cells:
    """Pivots, a sample of rows, and counts and radii of the cells: of fixed bound, on the
    driver and in every task."""

    def __init__(self, norm: float, sample: np.ndarray, labels: np.ndarray, pivots: int):
        self.norm, self.sample, self.labels = norm, sample, labels
        self.pivots = np.unique(sample[:pivots], axis=0).astype(np.float64)
        self.lift = np.sqrt(np.maximum(norm ** 2 - (self.pivots ** 2).sum(1), 0.0))

    def measure(self, found: list, shard_rows: int) -> None:
        """Takes (cell, rows, radius) of the cells that hold rows."""
        count, radius = np.zeros(len(self.pivots), np.int64), np.zeros(len(self.pivots))
        for cell, n, far in found:
            count[cell], radius[cell] = n, far
        self.angle = cap_angle(radius, self.norm)
        self.shards = np.maximum(-(-count // shard_rows), 1)
        self.first_shard = np.cumsum(self.shards) - self.shards

    def deal(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every row with its nearest pivot on the sphere and the distance to it."""
        for b in batches:
            x = matrix(b.column("v")).astype(np.float64)
            lift = np.sqrt(np.maximum(self.norm ** 2 - (x ** 2).sum(1), 0.0))
            inner = x @ self.pivots.T + lift[:, None] * self.lift
            cell = inner.argmax(1)
            far = np.sqrt(np.maximum(2 * (self.norm ** 2 - inner[np.arange(len(x)), cell]), 0.0))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32()), pa.array(far)], names=[*b.schema.names, "cell", "far"])

    def route(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every query once for each shard of the cells that its window reaches; the k-th
        best score in the sample raises the lower end."""
        for b in batches:
            for part in (b.slice(at, 512) for at in range(0, len(b), 512)):
                q = matrix(part.column("v"))
                kind = exact_type(q, self.sample)
                q, lows = q.astype(kind), part.column("low").to_pylist()
                known, first = q @ self.sample.astype(kind).T, q.astype(np.float64) @ self.pivots.T
                long = np.sqrt((q.astype(np.float64) ** 2).sum(1)) * self.norm
                rows, shard = [], []
                for i, (own, same, high, k) in enumerate(zip(*(part.column(c).to_pylist() for c in ("label", "same", "high", "k")))):
                    s = known[i][(self.labels == own) == same]
                    s = s[(s >= lows[i]) & (s <= high)]
                    if len(s) >= k:
                        lows[i] = int(np.partition(s, len(s) - k)[len(s) - k])
                    lower, upper = cap_bounds(first[i], self.angle, long[i])
                    cells = np.flatnonzero((upper >= lows[i]) & (lower <= high))
                    to = ranges(self.first_shard[cells], self.first_shard[cells] + self.shards[cells])
                    rows.append(np.full(len(to), i))
                    shard.append(to)
                part = part.set_column(part.schema.get_field_index("low"), "low", pa.array(lows, pa.int64())).take(pa.array(np.concatenate(rows)))
                yield part.append_column("shard", pa.array(np.concatenate(shard), pa.int64()))


def ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """first[0], ... last[0] - 1, first[1], ..."""
    sizes = last - first
    return np.arange(sizes.sum()) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)


class Index:
    """Candidates dealt to cells and shards of about ``shard_rows``."""

    def __init__(self, rows: DataFrame, shard_rows: int = SHARD, block_rows: int = BLOCK):
        self.block_rows = block_rows
        known = rows.agg(F.count(F.lit(1)), F.max(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c))).first()
        drawn = rows.orderBy(F.xxhash64("v", "vec_id"), "vec_id").limit(SAMPLE).select("label", "v").collect()
        sample = np.array([r.v for r in drawn], np.int64).reshape(len(drawn), -1 if drawn else 0)
        self.cells = Cells(math.sqrt(known[1] or 0.0), sample, np.array([r.label for r in drawn], np.int64), min(PIVOTS, -(-known[0] // shard_rows)))
        self.rows = written(rows.mapInArrow(self.cells.deal, "vec_id long, label long, v array<long>, cell int, far double"), "vector-cells")
        found = self.rows.groupBy("cell").agg(F.count(F.lit(1)), F.max("far")).collect()  # a row a cell
        self.cells.measure(found, shard_rows)

    def search(self, queries: DataFrame) -> DataFrame:
        """qid, win, vec_id, score, twin (the same vector), rank of the ``k`` best rows of
        ``queries`` (qid, win, v, label, same: of this label or of others, low, high, k)."""
        blocks = max(1, -(-queries.count() // self.block_rows))
        fields = "qid long, win long, v array<long>, label long, same boolean, low long, high long, k int, block int"
        asked = (queries.withColumn("block", F.pmod(F.xxhash64("qid", "win"), F.lit(blocks)).cast("int"))
                        .mapInArrow(self.cells.route, fields + ", shard long"))
        if len(self.cells.pivots):
            def of_cell(values: np.ndarray):
                return F.element_at(F.array(*[F.lit(int(x)) for x in values]), F.col("cell") + 1).cast("long")
            shard = of_cell(self.cells.first_shard) + F.pmod(F.xxhash64("v", "vec_id"), of_cell(self.cells.shards))
        else:
            shard = F.lit(0).cast("long")
        held = self.rows.select("vec_id", "label", "v", shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
        found = (held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block"))
                     .applyInArrow(shard_search, "qid long, win long, k int, vec_id long, score long, twin boolean"))
        best = Window.partitionBy("qid", "win").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
        return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= F.col("k")).drop("k")


def shard_search(held: pa.Table, asked: pa.Table) -> pa.Table:
    """The k best rows of one shard for every query of one block."""
    rows, queries, out = matrix(held.column("v")), matrix(asked.column("v")), []
    if len(rows) and len(queries):
        kind = exact_type(rows, queries)
        tree, queries, labels = CoverTree(rows.astype(kind)), queries.astype(kind), held.column("label").to_numpy()
        ids, unnamed = held.column("vec_id").fill_null(0).to_numpy(), held.column("vec_id").is_null().to_numpy()
        names = ("label", "same", "low", "high", "k")
        for i, (own, same, low, high, k) in enumerate(zip(*(asked.column(c).to_pylist() for c in names))):
            at, score = tree.search(queries[i], (labels == own) == same, low, high, k)
            first = np.lexsort((ids[at], unnamed[at], -score))[:k]
            twin = (tree.rows[at[first]] == queries[i]).all(1)
            out.append((np.full(len(first), i), at[first], score[first].astype(np.int64), twin))
    i, at, score, twin = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, t) for t in (np.int64, np.int64, np.int64, bool))
    asked = asked.select(["qid", "win", "k"]).take(pa.array(i, pa.int64()))
    return (asked.append_column("vec_id", held.column("vec_id").take(pa.array(at, pa.int64())))
                 .append_column("score", pa.array(score, pa.int64())).append_column("twin", pa.array(twin, pa.bool_())))


def mine(vectors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 3, high: int = 9, every: int = 100, **sizes: int) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.  ``vectors``:
    vec_id, label, v (``floored``).  Anchors are the rows whose id is divisible by ``every``;
    a negative's score is from ``low`` to ``high`` tenths of the positive's."""
    rows = written(vectors, "vectors")
    index = Index(written(least_rows(rows, max(negatives, positives + 1)), "vector-candidates"), **sizes)
    anchors = rows.filter(F.col("vec_id") % every == 0)
    asked = written(anchors.select("v", "label").distinct().withColumn("qid", F.monotonically_increasing_id()), "vector-queries")
    anchors = written(anchors.join(asked, ["v", "label"]).select("qid", F.col("vec_id").alias("anchor_id"), F.monotonically_increasing_id().alias("uid")), "vector-anchors")
    all_scores = (F.lit(-(1 << 62)).alias("low"), F.lit(1 << 62).alias("high"))
    close = written(index.search(asked.select("qid", F.lit(0).cast("long").alias("win"), "v", "label", F.lit(True).alias("same"),
                                              *all_scores, F.lit(positives + 1).alias("k"))), "vector-positives")
    # an anchor's own row, once, is no positive of its own
    pairs = anchors.join(close, "qid").withColumn("own", F.col("twin") & F.col("vec_id").eqNullSafe(F.col("anchor_id")))
    by = Window.partitionBy("uid").orderBy(F.desc("own"), "rank")
    pairs = pairs.withColumn("own", F.col("own") & (F.row_number().over(by) == 1)).filter(~F.col("own"))
    pairs = (pairs.withColumn("at", F.row_number().over(Window.partitionBy("uid").orderBy("rank"))).filter(F.col("at") <= positives)
                  .select("qid", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    # windows that hold nothing (negative positives) are left out; in whole numbers without overflow
    tens = F.expr("win div 10")
    windows = close.filter(F.col("score") >= 0).select("qid", F.col("score").alias("win")).distinct()
    windows = (windows.join(asked, "qid")
               .select("qid", "win", "v", "label", F.lit(False).alias("same"), (tens * low + F.expr(f"(win % 10 * {low} + 9) div 10")).alias("low"),
                       (tens * high + F.expr(f"(win % 10 * {high}) div 10")).alias("high"), F.lit(negatives).alias("k")))
    hard = index.search(written(windows, "vector-windows"))
    lists = hard.groupBy("qid", F.col("win").alias("positive_score")).agg(F.collect_list(F.struct("rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))).alias("__n"))
    return (pairs.join(lists, ["qid", "positive_score"])
                 .selectExpr("anchor_id", "positive_id", "positive_score", "inline(__n)")
                 .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
