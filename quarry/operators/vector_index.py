"""T6 + J6 + V2 for query sets as large as the table: an exact cosine search over a
partitioned index of centroid cells.

* Equal vectors are stored once with their ``k`` smallest ids (no other copy can be
  returned), and equal queries are searched once, so a vector that holds a third of all
  rows costs one row.
* Centroids are fitted to a bounded sample (``SAMPLE`` unit vectors a cell, at most
  ``MOST_CELLS`` cells, about the square root of the number of vectors).  Every vector is
  put into the cell of its nearest centroid; a cell keeps its size and the least and
  largest angle to its centroid.
* A query is answered in its own cells first (the nearest ones that hold ``k`` vectors
  together).  The k-th similarity found there bounds the answer: by the triangle
  inequality of angles, a cell can only hold a better vector if the query's angle to its
  centroid, give or take that bound, reaches the cell's ring of angles.  The query goes to
  those cells and to no others, so the result is exact.
* Work is dealt in blocks of a cell's vectors times blocks of its queries, both of bounded
  expected size, as a cogroup: a large cell becomes many groups.  In a group one matrix
  product finds what can matter; those pairs are then scored by sums in the order of the
  vector, as ``functions.vectors.cosine`` does, and only ``k`` rows a query leave it.

Vectors that are null, of another length than ``dim``, with a null or non-finite component,
or with a norm outside ``NORMS`` have no usable direction: they are neither found nor
answered.  Rows without an id are not found either.  Ties are ordered by id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import vectors as vf
from quarry.operators.indexing import materialize

MOST_CELLS = 1024
SAMPLE = 8
ROUNDS = 5
KEY_BLOCK = 8192
QUERY_BLOCK = 1024
NORMS = (1e-150, 1e150)
# what rounding may take from an angle or a similarity; bounds are widened by it
ANGLE_SLACK = 1e-6
SCORE_SLACK = 1e-9


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _in_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise dot products, summed from the first component to the last."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt(_in_order(vectors, vectors))[:, None]


def fit_centroids(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means from evenly spaced sample rows; a cell left empty keeps its centre."""
    points = _unit(sample)
    centres = points[np.linspace(0, len(points) - 1, min(cells, len(points))).astype(int)].copy()
    for _ in range(rounds):
        nearest = np.argmax(points @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        lengths = np.linalg.norm(sums, axis=1)
        centres[lengths > 0] = sums[lengths > 0] / lengths[lengths > 0, None]
    return centres


class _Router:
    """What a task needs to deal vectors and queries to cells: centroids, sizes and rings."""

    def __init__(self, centres: np.ndarray):
        self.centres = centres
        self.size = self.near = self.far = None

    def measure(self, rows: list) -> None:
        cells = len(self.centres)
        self.size, self.near, self.far = np.zeros(cells, dtype=np.int64), np.full(cells, 9.0), np.full(cells, -9.0)
        for cell, n, near, far in rows:
            self.size[cell], self.near[cell], self.far[cell] = n, near, far

    def angles(self, vectors: np.ndarray) -> np.ndarray:
        return np.arccos(np.clip(_unit(vectors) @ self.centres.T, -1.0, 1.0))

    def deal(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Vectors with the cell of their nearest centroid and the angle to it."""
        for b in batches:
            if b.num_rows:
                angle = self.angles(_matrix(b["vec"]))
                cell = np.argmin(angle, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(cell.astype(np.int32)), pa.array(angle[np.arange(len(cell)), cell])],
                    names=[*b.schema.names, "cell", "angle"])

    def own_cells(self, k: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    order = np.argsort(self.angles(_matrix(b["vec"])), axis=1, kind="stable")
                    held = np.cumsum(self.size[order], axis=1)
                    last = np.argmax(held >= min(k, held[0, -1]), axis=1)
                    cells = [o[:n + 1][self.size[o[:n + 1]] > 0].astype(np.int32) for o, n in zip(order, last)]
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells, pa.list_(pa.int32()))],
                                                     names=[*b.schema.names, "own"])
        return run

    def further_cells(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cells beside a query's own whose ring of angles the bound reaches."""
        for b in batches:
            if b.num_rows:
                angle = self.angles(_matrix(b["vec"]))
                reach = np.arccos(np.clip(b["least"].to_numpy(zero_copy_only=False), -1.0, 1.0))[:, None] + ANGLE_SLACK
                may = (self.size > 0) & (angle - reach <= self.far) & (angle + reach >= self.near)
                for i, own in enumerate(b["own"].to_pylist()):
                    may[i, own] = False
                yield pa.RecordBatch.from_arrays(
                    [b["query"], b["vec"], b["least"],
                     pa.array([np.flatnonzero(m).astype(np.int32) for m in may], pa.list_(pa.int32()))],
                    names=["query", "vec", "least", "cells"])


def _best_of_block(k: int):
    def run(keys: pa.Table, queries: pa.Table) -> pa.Table:
        parts = [pa.table({"query": pa.array([], pa.int64()), "held": pa.array([], pa.int64()),
                           "low": pa.array([], keys.schema.field("low").type), "similarity": pa.array([], pa.float64())})]
        if keys.num_rows and queries.num_rows:
            own, asked = _matrix(keys["vec"]), _matrix(queries["vec"])
            own_norm, asked_norm = np.sqrt(_in_order(own, own)), np.sqrt(_in_order(asked, asked))
            unit = own / own_norm[:, None]
            held, low = keys["held"].combine_chunks(), keys["low"].combine_chunks()
            query = queries["query"].to_numpy()
            least = queries["least"].to_numpy()
            for start in range(0, len(asked), 128):
                q = slice(start, start + 128)
                near = (asked[q] / asked_norm[q, None]) @ unit.T
                floor = least[q]
                if near.shape[1] > k:
                    floor = np.maximum(floor, np.partition(near, -k, axis=1)[:, -k])
                row, col = np.nonzero(near >= floor[:, None] - SCORE_SLACK)
                row += start
                exact = _in_order(asked[row], own[col]) / (asked_norm[row] * own_norm[col])
                t = pa.table({"query": pa.array(query[row]), "held": held.take(pa.array(col)),
                              "low": low.take(pa.array(col)), "similarity": pa.array(exact)})
                t = t.sort_by([("query", "ascending"), ("similarity", "descending"), ("low", "ascending")])
                name = t["query"].to_numpy()
                new = np.flatnonzero(np.r_[True, name[1:] != name[:-1]]) if len(name) else np.zeros(0, dtype=int)
                place = np.arange(len(name)) - np.repeat(new, np.diff(np.r_[new, len(name)]))
                parts.append(t.filter(pa.array(place < k)))
        return pa.concat_tables(parts)
    return run


def _usable(df: DataFrame, vec: str, dim: int) -> DataFrame:
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return (df.withColumn("vec", F.transform(vf.as_double_array(vec), lambda x: x + F.lit(0.0)))   # -0.0 becomes 0.0
              .where((F.size("vec") == dim) & finite)
              .where(vf.norm("vec").between(*NORMS)))


def _twins(df: DataFrame, keep: int | None) -> DataFrame:
    """(id, vec, held, twin): ``held`` numbers the distinct vectors; ``keep`` ids of each."""
    df = df.withColumn("__row", F.monotonically_increasing_id())
    group = Window.partitionBy("vec")
    if keep is None:
        return df.withColumn("held", F.min("__row").over(group)).withColumn("twin", F.col("__row") == F.col("held"))
    df = df.withColumn("__n", F.row_number().over(group.orderBy("id", "__row"))).where(F.col("__n") <= keep)
    first = F.min(F.struct("__n", "__row")).over(group)["__row"]
    return df.withColumn("held", first).withColumn("twin", F.col("__n") == 1)


class VectorIndex:
    """Exact cosine search; build once, ``search`` any number of query sets.

    ``depth`` is the largest ``k`` that can be asked for (ids kept of equal vectors).
    ``dim`` defaults to the largest length met in ``keys``."""

    def __init__(self, keys: DataFrame, key_id: str, key_vec: str, depth: int = 10, dim: int | None = None,
                 most_cells: int = MOST_CELLS, key_block: int = KEY_BLOCK, query_block: int = QUERY_BLOCK):
        self.key_id, self.depth, self.key_block, self.query_block = key_id, depth, key_block, query_block
        self.dim = dim if dim is not None else keys.select(F.max(F.size(key_vec))).first()[0] or 0
        rows = keys.select(F.col(key_id).alias("id"), F.col(key_vec).alias("vec")).where(F.col("id").isNotNull())
        self.rows = materialize(_twins(_usable(rows, "vec", self.dim), depth), "vectors")
        distinct = self.rows.where("twin").select("held", F.col("id").alias("low"), "vec")
        self.count = distinct.count()
        cells = max(1, min(most_cells, math.isqrt(self.count)))
        # at most SAMPLE * most_cells vectors, those of least hash; the filter leaves about twice
        # as many for the one task that orders them, however many partitions there are
        hashed, wanted = F.xxhash64("vec"), SAMPLE * cells
        few = distinct.select("vec")
        if self.count > 4 * wanted:
            few = few.where(hashed < int(2 ** 64 * (2 * wanted / self.count)) - 2 ** 63)
        sample = few.orderBy(hashed).limit(wanted).toArrow()["vec"]
        self.router = None
        if self.count:
            self.router = _Router(fit_centroids(_matrix(sample), cells))
            kind = self.rows.schema["id"].dataType.simpleString()
            self.cells = materialize(distinct.mapInArrow(
                self.router.deal, f"held long, low {kind}, vec array<double>, cell int, angle double"), "cells")
            self.router.measure(self.cells.groupBy("cell").agg(F.count("*"), F.min("angle"), F.max("angle")).collect())

    def _pairs(self, routed: DataFrame, k: int) -> tuple[DataFrame, int]:
        """Best ``k`` of each (block of a cell, query) over ``routed`` (query, vec, least, cell),
        and the number of vector pairs that this compares."""
        spark = routed.sparkSession
        size = self.router.size
        asked = routed.groupBy("cell").count().collect()   # one row a cell
        deal = F.broadcast(spark.createDataFrame(
            [(c, -(-int(size[c]) // self.key_block), -(-n // self.query_block)) for c, n in asked],
            "cell int, key_blocks int, query_blocks int"))
        def blocks(df, name, own, other, count_own, count_other):
            return (df.join(deal, "cell")
                      .withColumn(own, F.pmod(F.xxhash64(name), count_own).cast("int"))
                      .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(count_other) - 1))))
        keys = blocks(self.cells, "held", "kb", "qb", "key_blocks", "query_blocks").select("cell", "kb", "qb", "held", "low", "vec")
        queries = blocks(routed, "query", "qb", "kb", "query_blocks", "key_blocks").select("cell", "kb", "qb", "query", "vec", "least")
        kind = self.cells.schema["low"].dataType.simpleString()
        found = keys.groupBy("cell", "kb", "qb").cogroup(queries.groupBy("cell", "kb", "qb")).applyInArrow(
            _best_of_block(k), f"query long, held long, low {kind}, similarity double")
        return found, sum(n * int(size[c]) for c, n in asked)

    def search(self, queries: DataFrame, qid: str, qvec: str, k: int) -> DataFrame:
        """(qid, key id, similarity, rank): the ``k`` rows most similar to each query row; a
        query that is itself in the table finds itself too.  ``self.compared`` and
        ``self.possible`` then tell the vector pairs compared and those there are."""
        if not 1 <= k <= self.depth:
            raise ValueError(f"k must be from 1 to the index's depth {self.depth}")
        spark = queries.sparkSession
        rows = queries.select(F.col(qid).alias("id"), F.col(qvec).alias("vec"))
        asked = materialize(_twins(_usable(rows, "vec", self.dim), None), "asked")
        distinct = asked.where("twin").select(F.col("held").alias("query"), "vec")
        self.compared, self.possible = 0, distinct.count() * self.count
        types = f"{qid} {asked.schema['id'].dataType.simpleString()}, {self.key_id} {self.rows.schema['id'].dataType.simpleString()}"
        if not self.possible:
            return spark.createDataFrame([], f"{types}, similarity double, rank int")
        homes = materialize(distinct.mapInArrow(self.router.own_cells(k), "query long, vec array<double>, own array<int>"), "homes")
        best = Window.partitionBy("query").orderBy(F.col("similarity").desc(), "low")
        def top(df):
            return df.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k).drop("place")
        found, n = self._pairs(homes.select("query", "vec", F.lit(-2.0).alias("least"), F.explode("own").alias("cell")), k)
        first = materialize(top(found), "first")
        bound = first.groupBy("query").agg(F.when(F.count("*") >= k, F.min("similarity")).otherwise(-2.0).alias("least"))
        routed = materialize(
            homes.join(bound, "query")
                 .mapInArrow(self.router.further_cells, "query long, vec array<double>, least double, cells array<int>")
                 .select("query", "vec", "least", F.explode("cells").alias("cell")), "routed")
        found, more = self._pairs(routed, k)
        self.compared = n + more
        merged = top(first.unionByName(found))
        # each vector stands for its k smallest ids
        ids = merged.join(self.rows.select("held", F.col("id").alias("low_id")), "held")
        last = Window.partitionBy("query").orderBy(F.col("similarity").desc(), "low_id")
        ids = ids.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
        return (asked.select(F.col("id").alias(qid), F.col("held").alias("query"))
                     .join(ids, "query").select(qid, F.col("low_id").alias(self.key_id), "similarity", "rank"))


def nearest(keys: DataFrame, key_id: str, key_vec: str, queries: DataFrame, qid: str, qvec: str,
            k: int = 10, **sizes: int) -> DataFrame:
    """The ``k`` rows of ``keys`` most similar to each query, by an index built for it."""
    return VectorIndex(keys, key_id, key_vec, depth=k, **sizes).search(queries, qid, qvec, k)
