"""Exact and near duplicates against brute force."""

import hashlib
import re

import numpy as np
import pytest
import xxhash

from quarry.llm import exact_dedup, simhash_vp
from tests.llm.conftest import ODD, SMALL


def norm(t):
    return re.sub("[\x20\x09-\x0D]+", " ", t or "")


COPIES = [(100 + i, "the same text\tagain") for i in range(50)] + [(200, "the  same text again"), (201, "the same text  again "), (99, "Unique")]


def plain_groups(rows):
    out = []
    for i, t in rows:
        ids = [j for j, u in rows if norm(u) == norm(t)]
        keep = min((j for j in ids if j is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("bits", [None, 16, 18])
def test_groups(docs_of, small_docs, bits, monkeypatch):
    if bits:
        monkeypatch.setattr(exact_dedup, "filter_bits", lambda n: bits)
    rows = small_docs + ODD + COPIES
    got = [tuple(r) for r in exact_dedup.groups(docs_of(rows)).collect()]
    assert sorted(got, key=str) == sorted(plain_groups(rows), key=str)


def test_saturated_filter_changes_nothing(spark, docs_of, monkeypatch):
    rows = [(i, f"text {i // 2}") for i in range(3000)]
    keys = docs_of(rows).select("doc_id", exact_dedup.text_key().alias("text_sha256"))
    few = exact_dedup.probe(keys, exact_dedup.repeated_filter(keys, 16), 16)
    assert few.filter("__maybe").count() == 3000
    alone = docs_of([(i, f"text {i}") for i in range(3000)]).select("doc_id", exact_dedup.text_key().alias("text_sha256"))
    bits = exact_dedup.filter_bits(3000)
    assert exact_dedup.probe(alone, exact_dedup.repeated_filter(alone, bits), bits).filter("__maybe").count() < 150


def test_filter_beyond_its_broadcast_size(docs_of, small_docs, monkeypatch):
    assert exact_dedup.filter_bits(10 ** 9) >= 33  # 16 bits a row, however many rows
    rows = small_docs + ODD + COPIES
    docs = docs_of(rows)
    want = sorted(plain_groups(rows), key=str)
    monkeypatch.setattr(exact_dedup, "BROADCAST_BITS", 15)
    docs.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        groups = exact_dedup.groups(docs)
        assert "SortMergeJoin" in groups._jdf.queryExecution().executedPlan().toString()
        assert sorted((tuple(r) for r in groups.collect()), key=str) == want
        assert exact_dedup.dedupe(docs).count() == len({norm(t) for _, t in rows})
    finally:
        docs.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_exact_dedupe_keeps_columns_and_one_row(docs_of, small_docs):
    rows = small_docs + ODD + COPIES
    docs = docs_of(rows)
    out = exact_dedup.dedupe(docs)
    assert out.columns == docs.columns
    got = out.collect()
    assert len(got) == len({norm(t) for _, t in rows})
    keep = {(h, k) for _, k, _, _, h in plain_groups(rows)}
    assert {(hashlib.sha256(norm(r.text).encode()).hexdigest(), r.doc_id) for r in got} == keep
    assert exact_dedup.dedupe(docs.filter("doc_id < 0")).collect() == []
    assert exact_dedup.groups(docs.filter("doc_id < 0")).collect() == []


def test_exact_dedup_has_no_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for f in (exact_dedup.groups, exact_dedup.dedupe):
        plan = f(docs)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan


# -- SimHash

def plain_fingerprint(text, words=3):
    w = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(codes, radius):
    parent = list(range(len(codes)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= radius:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(codes))]


def check_components(rows, got, radius=3):
    codes = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(codes, radius)
    lowest = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            lowest[r] = min(lowest.get(r, i), i)
    want = [(i, f"{c:016x}", lowest.get(r)) for (i, _), c, r in zip(rows, codes, roots)]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def near_copies(seed, n):
    rng = np.random.default_rng(seed)
    base, out = [f"w{rng.integers(9999)}" for _ in range(120)], []
    for i in range(n):
        copy = list(base)
        for _ in range(rng.integers(0, 4)):
            copy[rng.integers(120)] = f"z{rng.integers(99)}"
        out.append((1000 + i, " ".join(copy)))
    return out


def test_components_on_texts(docs_of, small_docs):
    rows = small_docs + ODD + near_copies(1, 80)
    for levels in (1, 2, 4):
        check_components(rows, simhash_vp.components(docs_of(rows), levels=levels).collect())


@pytest.mark.parametrize("levels", [1, 2, 3, 4])
def test_links_of_close_codes_lose_none(spark, levels):
    rng = np.random.default_rng(levels)
    codes = set()
    for c in rng.integers(-2**63, 2**63 - 1, 120).tolist():
        codes.add(c)
        for _ in range(12):  # chains around each code
            for _ in range(rng.integers(1, 4)):
                c ^= 1 << int(rng.integers(63))
            codes.add(c)
    codes = sorted(codes)
    df = spark.createDataFrame([(c,) for c in codes], "fp long")
    pairs = {(r.node, r.root) for r in simhash_vp.stars(simhash_vp.links(df, 3, levels)).collect()}
    root = dict(pairs)
    want = plain_components([c & (2**64 - 1) for c in codes], 3)
    assert {c: codes[r] for c, r in zip(codes, want) if codes[r] != c} == root


def test_dense_shard_prunes_exactly():
    rng = np.random.default_rng(9)
    codes = np.unique(rng.integers(0, 1 << 14, 3000).astype(np.uint64) * np.uint64(0x0001000100010001) ^ np.uint64(5))
    tree = simhash_vp.Tree(codes, 2, 3)
    root = simhash_vp.shard_links(tree, codes, len(codes))
    assert root.tolist() == plain_components([int(c) for c in codes], 3)


def test_family_of_near_copies_is_split_over_tasks(spark):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(21)
    template, codes = int(rng.integers(2**62)), set()
    while len(codes) < 2500:  # a few bits from one template, and chains that leave it
        c = template
        for b in rng.integers(0, 63, rng.integers(0, 6)).tolist():
            c ^= 1 << b
        codes.add(c)
    codes |= set(rng.integers(-2**63, 2**63 - 1, 300).tolist())
    codes = sorted(codes)
    df = spark.createDataFrame([(c,) for c in codes], "fp long")
    want = plain_components([c & (2**64 - 1) for c in codes], 3)
    want = {c: codes[r] for c, r in zip(codes, want) if codes[r] != c}
    for levels in (1, 2):
        found = simhash_vp.stars(simhash_vp.links(df, 3, levels, group=150)).collect()
        assert {r.node: r.root for r in found} == want
    sizes = []
    routed = df.withColumns({"shard": F.lit(0).cast("long"), "home": F.col("fp") % 3 != 0})
    sizes = [r["count"] for r in simhash_vp.in_blocks(routed, 150).groupBy("shard", "own", "ask").count().collect()]
    assert len(sizes) > 100 and max(sizes) < 450
    alone = simhash_vp.in_blocks(routed.filter("not home"), 10)
    assert alone.collect() == []


def test_stars_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(300)] + [(1001, 1000)], "u long, v long")
    got = {r.node: r.root for r in simhash_vp.stars(edges).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {1001: 1000}


def test_simhash_dedupe_with_repeated_and_null_ids(docs_of):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(3, a), (5, a), (5, b), (None, b), (None, b + " more"), (None, a), (None, "alone here"), (None, "alone here"),
            (7, b + " more"), (8, "x y z"), (8, "x y z"), (9, "p q r"), (9, "s t u")]
    codes = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(codes, 3)
    want = []
    for r in set(roots):
        i, c = min(((i is None, i or 0), c) for (i, _), c, k in zip(rows, codes, roots) if k == r)
        want.append((None if i[0] else i[1], c))
    got = [(r.doc_id, plain_fingerprint(r.text)) for r in simhash_vp.dedupe(docs_of(rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_simhash_dedupe(docs_of, small_docs):
    rows = [(i + 500, t) for i, t in small_docs] + ODD + near_copies(2, 30)
    docs = docs_of(rows)
    out = simhash_vp.dedupe(docs)
    assert out.columns == docs.columns
    comp = {r.doc_id: r.component_id for r in simhash_vp.components(docs).collect()}
    got = [r.doc_id for r in out.collect()]
    assert {i for i in got if i is not None} == {c for i, c in comp.items() if i is not None and c is not None}
    assert len(got) == len(set(plain_components([plain_fingerprint(t) for _, t in rows], 3)))
    assert simhash_vp.dedupe(docs.filter("doc_id < 0")).collect() == []
    assert simhash_vp.components(docs.filter("doc_id < 0")).collect() == []
