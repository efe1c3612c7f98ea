"""Sharding by a weighted hash tree: regions, racks, shards.

A document descends from the root.  At each level every child draws an exponential
waiting time ``-ln(u) / weight`` with ``u`` from a hash of (key, child) and the shortest
wait wins, so children get rows in proportion to their weights.  When a child's weight
grows, the other children's draws stay as they are: rows move only into the subtrees whose
weights grew (and, when one shrinks, only out of it).  A shard added as a region of its own
therefore takes rows only into itself, which is how ``shard_tree`` grows.

Defined results: a null key is one key of its own; a null text has size 8 and crc32 0;
equal keys share a shard; slots number a shard's rows by (doc_id, text crc, size), equal
rows in any order.  Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import whole_text, written

# node path -> its children as (path, weight, shard or None)
Tree = dict[str, list[tuple[str, float, int | None]]]


def shard_tree(shards: int, base: int = 24, region: int = 12, rack: int = 4) -> Tree:
    """Shards below ``base`` fill regions of ``region`` shards in racks of ``rack``; what
    is left over and every later shard is a region with one rack and one shard.  For
    counts from ``base`` on, the tree of n + 1 shards is that of n and one more region."""
    full = min(shards, base) // region * region
    racks: dict[tuple[int, int], list[int]] = {}
    for s in range(shards):
        place = (s // region, s % region // rack) if s < full else (full // region + s - full, 0)
        racks.setdefault(place, []).append(s)
    tree: Tree = {"": []}
    for (g, r), members in racks.items():
        at, below = f"{g}", f"{g}/{r}"
        if at not in tree:
            tree[at] = []
        tree[at].append((below, float(len(members)), None))
        tree[below] = [(f"{below}/{s}", 1.0, s) for s in members]
    tree[""] = [(g, sum(w for _, w, _ in tree[g]), None) for g in dict.fromkeys(str(g) for g, _ in racks)]
    return tree


def _wait(key: Column, child: str, weight: float) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(child)), 11).cast("double") + 0.5) / float(1 << 53)
    return F.struct((-F.log(u) / weight).alias("wait"), F.lit(child).alias("child"))


def _descend(key: Column, tree: Tree, node: Column, parents: list[str]) -> Column:
    """The child drawn below ``node``, one of ``parents``."""
    out = None
    for p in parents:
        draws = [_wait(key, c, w) for c, w, _ in tree[p]]
        best = (F.least(*draws) if len(draws) > 1 else draws[0])["child"]
        out = F.when(node == p, best) if out is None else out.when(node == p, best)
    return out


def place(df: DataFrame, tree: Tree, key: str, name: str = "shard") -> DataFrame:
    """``df`` with the shard drawn for ``key``; three draws, no shuffle."""
    regions = [c for c, _, _ in tree[""]]
    racks = [c for g in regions for c, _, _ in tree[g]]
    shards = {c: s for r in racks for c, _, s in tree[r]}
    k = F.col(key)
    root = _descend(k, tree, F.lit(""), [""])
    out = df.withColumn("__node", root)
    out = out.withColumn("__node", _descend(k, tree, F.col("__node"), regions))
    out = out.withColumn("__node", _descend(k, tree, F.col("__node"), racks))
    last = F.element_at(F.split("__node", "/"), -1).cast("int")
    assert all(c.rpartition("/")[2] == str(s) for c, s in shards.items())
    return out.withColumn(name, last).drop("__node")


def numbered(df: DataFrame, group: str, order: list[str], name: str = "slot") -> DataFrame:
    """Numbers the rows of each group from 0 without gaps.  Rows are range-partitioned by
    (group, order), so a group of any size spreads over tasks; numbers are positions in
    that global order less the group's first position, from one row per (task, group)."""
    parted = df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    tagged = written(parted.withColumn("__mid", F.monotonically_increasing_id()), "slots")
    part = F.shiftright("__mid", 33)
    pieces = tagged.groupBy(group, part.alias("__part")).agg(
        F.count(F.lit(1)).alias("__n"), F.min("__mid").alias("__first"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(F.col(group).alias("__group"), "__part", "__first",
                            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return (tagged.join(offsets, (F.col(group) == F.col("__group")) & (part == F.col("__part")))
                  .withColumn(name, F.col("__mid") - F.col("__first") + F.col("__before"))
                  .drop("__mid", "__group", "__part", "__first", "__before"))


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (with one more shard)."""
    text = whole_text()
    rows = docs.select(F.col("doc_id").cast("long"), (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit("key").alias("law"))
    rows = place(rows, shard_tree(shards), "doc_id")
    rows = place(rows, shard_tree(shards + 1), "doc_id", "grown_shard")
    rows = numbered(rows, "shard", ["doc_id", "text_crc32", "size"])
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
