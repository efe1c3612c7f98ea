"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from quarry.session import ensure_checkpoint_dir

ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(),
         "double": pa.float64(), "boolean": pa.bool_()}


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new folder name under the shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a parquet table in the shared folder: cuts lineage, survives lost
    executors, and gives every later read the same rows."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(name: str = "text") -> Column:
    """The text column, null as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def chunks(values: pa.Array, rows: int = 512, nbytes: int = 4 << 20) -> Iterator[pa.Array]:
    """Slices of a string array of at most ``rows`` values, closed once they hold
    ``nbytes``; values are never cut."""
    sizes = pc.fill_null(pc.binary_length(values), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        held += n
        if held >= nbytes or i + 1 - start >= rows:
            yield values.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < len(values):
        yield values.slice(start)


def row_type(fields: dict[str, str]) -> pa.DataType:
    return pa.struct([(k, ARROW[t]) for k, t in fields.items()])


def give_back() -> None:
    """Returns unused memory to the system: worker processes outlive their tasks, and an
    executor holds idle ones."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def text_udf(setup: Callable[[], Callable[[list], list]], fields: dict[str, str], **slices: int):
    """A column function from whole texts to a struct of ``fields``.

    ``setup()`` runs once per task and returns a function from a list of texts to a list
    of tuples.  Texts travel in Arrow batches and are handled in slices of a few MB
    (``slices`` as for ``chunks``)."""
    kind = row_type(fields)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fn = setup()
        for batch in batches:
            parts = [pa.array(fn(c.to_pylist()), type=kind) for c in chunks(batch, **slices)]
            yield pa.concat_arrays(parts) if parts else pa.array([], type=kind)
        give_back()

    ddl = ", ".join(f"{k} {t}" for k, t in fields.items())
    # not to be repeated: a filter on a result would otherwise run the function once more
    return arrow_udf(run, f"struct<{ddl.replace(' ', ':').replace(',:', ',')}>").asNondeterministic()


class Memo:
    """Values of ``fn_many`` by key, for streams of words that often repeat.

    Two generations of at most ``limit`` keys each (and one call's keys) bound the memory:
    a full young generation becomes the old one, and keys still in use move back."""

    def __init__(self, fn_many: Callable[[list], Iterable], limit: int = 250_000):
        self.fn_many, self.limit, self.young, self.old = fn_many, limit, {}, {}

    def look(self, keys: list) -> list:
        """The value of every key; missing ones are computed in one call."""
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        # the call's own words first: a small table that stays in the processor's cache
        own = dict.fromkeys(keys)
        found = list(map(self.young.get, own))
        if None in found:
            missing, new = [k for k, v in zip(own, found) if v is None], []
            for k in missing:
                v = self.old.get(k)
                if v is None:
                    new.append(k)
                else:
                    self.young[k] = v
            if new:
                self.young.update(zip(new, self.fn_many(new), strict=True))
            found = list(map(self.young.__getitem__, own))
        own = dict(zip(own, found))
        return list(map(own.__getitem__, keys))


def id_lists(flat: np.ndarray, sizes: Iterable[int]) -> pa.ListArray:
    """Lists of 32-bit ids of the given sizes, one after another in ``flat``."""
    ends = np.cumsum(np.fromiter(sizes, np.int64))
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(flat, pa.int32()))


class ListMemo:
    """Id lists of ``fn`` by word, for streams of words that often repeat, in Arrow arrays.

    ``limit`` words are kept at most (and one call's); beyond that, the half used least
    recently goes."""

    def __init__(self, fn: Callable[[list[str]], pa.ListArray], limit: int = 1_000_000):
        self.fn, self.limit, self.clock = fn, limit, 0
        self.words, self.ids = pa.array([], pa.string()), id_lists(np.array([], np.int32), [])
        self.used = np.zeros(0, np.int64)

    def peek(self, words: pa.Array) -> pa.ListArray:
        """The lists of words met before, null for others."""
        return self.ids.take(pc.index_in(words, value_set=self.words))

    def look(self, words: pa.Array) -> pa.ListArray:
        """The lists of distinct words; missing ones are computed in one call."""
        self.clock += 1
        at = pc.index_in(words, value_set=self.words)
        if at.null_count:
            new = words.filter(at.is_null())
            if len(self.words) + len(new) > self.limit:
                keep = np.argsort(self.used, kind="stable")[len(self.used) // 2:]
                keep = np.union1d(keep, at.drop_null().to_numpy())
                self.words, self.ids, self.used = self.words.take(keep), self.ids.take(keep), self.used[keep]
            ids = self.fn(new.to_pylist())
            self.words, self.ids = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.ids, ids])
            self.used = np.append(self.used, np.zeros(len(new), np.int64))
            at = pc.index_in(words, value_set=self.words)
        self.used[at.to_numpy()] = self.clock
        return self.ids.take(at)


_KEPT: dict = {}


def per_worker(make: Callable, data: bytes):
    """``make(data)``, built once in each Python worker process and kept for its later
    tasks (with the memos inside), until another one is asked for."""
    key = (make.__module__, make.__qualname__, hashlib.sha256(data).digest())
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make(data)
    return _KEPT[key]


def broadcast_file(spark: SparkSession, path: str):
    """A vocabulary or model file of fixed size, read on the driver and broadcast, so
    that executors need no copy on their disks."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())
