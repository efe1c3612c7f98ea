"""Best-fit packing, hard negatives and collocations against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import collocations, hard_negatives, queries, sequence_packing
from tests.llm.conftest import ODD, SMALL

BYTES = public_tokenizers.path("byte_bpe_50k.json")


# -- packing

def fewest(items, capacity):
    """Exact, by branching over the open sequences."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, used):
        if len(used) >= best[0]:
            return
        if i == len(items):
            best[0] = len(used)
            return
        for k in {u: k for k, u in enumerate(used) if u + items[i] <= capacity}.values():
            used[k] += items[i]
            go(i + 1, used)
            used[k] -= items[i]
        go(i + 1, used + [items[i]])

    go(0, [])
    return best[0]


def test_dominance_keeps_the_optimum():
    random.seed(3)
    fixed_any = 0
    for t in range(1500):
        capacity = random.choice([10, 20, 30])
        items = [random.randint(1 if t % 2 else capacity // 4, capacity) for _ in range(random.randint(1, 9))]
        counts = np.bincount(items, minlength=capacity + 1)
        fixed, left = sequence_packing.fix_dominating(counts)
        number = sum(n for _, n in fixed)
        fixed_any += number
        best = fewest(items, capacity)
        assert number + fewest(np.repeat(np.arange(capacity + 1), left).tolist(), capacity) == best, items
        rows = sequence_packing.plan(counts)
        assert all(sum(s * k for s, k in row) <= capacity for row, _ in rows)
        assert sum((Counter({s: k * n for s, k in row}) for row, n in rows), Counter()) == Counter(items)
        assert sequence_packing.least_sequences(counts) <= best <= sum(n for _, n in rows) <= best + 1
    assert fixed_any > 1000


def test_large_histograms_come_near_the_bound():
    draw = np.random.default_rng(0)
    for sizes in (draw.integers(1, 1025, 300_000), np.minimum(1024, draw.lognormal(5, 1, 300_000).astype(int) + 1), np.full(5000, 1024)):
        counts = np.bincount(sizes, minlength=1025)
        found = sum(n for _, n in sequence_packing.plan(counts))
        assert found <= 1.002 * sequence_packing.least_sequences(counts) + 1
    assert sequence_packing.plan(np.zeros(1025, np.int64)) == []


@pytest.mark.parametrize("capacity", [16, 1024])
def test_pack(docs_of, small_docs, capacity):
    rows = small_docs[:120] + ODD + [(500 + i, "one two three " * (i % 9)) for i in range(60)]
    lib = Tokenizer.from_file(BYTES)
    lib.encode_special_tokens = True
    docs = docs_of(rows)
    packed = sequence_packing.pack(docs, BYTES, capacity, with_ids=True)
    got = packed.collect()
    parts, places = defaultdict(Counter), defaultdict(list)
    for r in got:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        parts[r.doc_id][r.piece, r.start, tuple(r.ids)] += 1
        places[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(Counter)
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        first = (len(ids) - 1) % capacity + 1
        for n, a in enumerate([0, *range(first, len(ids), capacity)]):
            b = first + n * capacity
            want[i][n, a, tuple(ids[a:b])] += 1
    assert parts == want
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
    counts = np.bincount([r.length for r in got], minlength=capacity + 1)
    assert sequence_packing.least_sequences(counts) <= len(places) <= 1.01 * sequence_packing.least_sequences(counts) + 1
    by_place = {(r.sequence_id, r.offset): r for r in got}
    for r in sequence_packing.sequences(packed).collect():
        assert [p.offset for p in r.parts] == sorted(p.offset for p in r.parts)
        assert r.ids == [x for p in r.parts for x in by_place[r.sequence_id, p.offset].ids]
    assert sequence_packing.pack(docs.filter("doc_id < 0"), BYTES).collect() == []


# -- hard negatives

def plain_negatives(rows, positives=5, negatives=10):
    rows = [(i, lab, np.array(v, object)) for i, lab, v in rows]
    d = max((len(v) for _, _, v in rows), default=0)
    rows = [(i, lab, np.append(v, [0] * (d - len(v)))) for i, lab, v in rows]
    key = lambda x: (-x[0], x[1] is None, x[1])
    out = []
    for n, (i, lab, v) in enumerate(rows):
        if i is None or i % 100:
            continue
        scores = [(int((v * w).sum()), j, other == lab, m) for m, (j, other, w) in enumerate(rows)]
        for p, j, *_ in sorted((s for s in scores if s[2] and s[3] != n), key=key)[:positives]:
            found = [s for s in scores if not s[2] and 30 * p <= 100 * s[0] <= 90 * p]
            out += [(i, j, k + 1, s[1], p, s[0]) for k, s in enumerate(sorted(found, key=key)[:negatives])]
    return sorted(out, key=str)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, cell int, v string, block long, qid string").repartition(3)


def ints(rows):
    """The rows that take part, with floored components."""
    good = [(i, lab, [math.floor(256 * np.float32(x).item()) for x in v]) for i, lab, v in rows
            if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    return [r for r in good if sum(x * x for x in r[2]) <= 2 ** 62]


def check_negatives(spark, rows, **sizes):
    df = vectors(spark, [(i, lab, v, 1, "x", 2, "q") for i, lab, v in rows])
    got = hard_negatives.mine(hard_negatives.floored(df), **sizes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_negatives(ints(rows))


def test_negatives_with_ties_copies_and_odd_rows(spark):
    random.seed(5)
    rows = [(i, i % 4, [random.choice([-0.25, 0.0, 0.25, 0.5]) for _ in range(6)]) for i in range(700)]
    rows += [(1000 + i, 1, [0.5] * 6) for i in range(300)] + [(1000, 1, [0.5] * 6), (100, 0, rows[100][2])]
    rows += [(3000, None, [1.0] * 6), (3100, 2, None), (3200, 2, [1.0, None]), (3300, 2, [float("nan")] * 6), (3400, 1, [float("inf")] * 6),
             (None, 2, [0.5] * 6), (None, 0, [0.25] * 6), (3500, 3, [0.5, 0.5]), (3600, 3, []), (3700, 0, [3e38] * 6)]
    check_negatives(spark, rows, shard_rows=90, block_rows=7)


def test_negatives_of_clusters_and_large_numbers(spark):
    draw = np.random.default_rng(1)
    centers = draw.normal(size=(12, 8))
    rows = [(i, int(draw.integers(3)), (centers[i % 12] + draw.normal(size=8) * 0.05).tolist()) for i in range(900)]
    check_negatives(spark, rows, shard_rows=100)
    # beyond the doubles' exact integers
    check_negatives(spark, [(i, lab, [x * 2.0 ** 18 for x in v]) for i, lab, v in rows[:250]], shard_rows=50)


def test_negatives_of_no_rows(spark):
    check_negatives(spark, [])
    check_negatives(spark, [(0, 1, [1.0])])


def test_cover_tree_bounds_and_skips():
    draw = np.random.default_rng(2)
    rows = np.floor((draw.normal(size=(40, 16)).repeat(50, 0) + draw.normal(size=(2000, 16)) * 0.02) * 256)
    tree = hard_negatives.CoverTree(rows)
    assert sorted(tree.order.tolist()) == list(range(2000)) and (~tree.leaf).sum() > 1
    seen = [0]
    plain = tree.leaf_rows
    tree.leaf_rows = lambda nodes: (lambda r: (seen.__setitem__(0, seen[0] + len(r)), r)[1])(plain(nodes))
    for q in rows[::100]:
        score = (rows @ q).astype(int)
        for low, high in ((-(1 << 62), 1 << 62), (int(score.max() * 0.3), int(score.max() * 0.9))):
            at, found = tree.search(q, np.ones(2000, bool), low, high, 10)
            want = sorted((s for s in score if low <= s <= high), reverse=True)[:10]
            assert sorted(found.astype(int).tolist(), reverse=True)[:10] == want and (score[at] == found).all()
    assert seen[0] < 40 * 2000 / 4  # most leaves are never read


# -- phrases

LOWER = {c: c + 32 for c in range(65, 91)}


def plain_phrases(rows, least=30, top=2000, longest=4, scale=2_000_000, share=80):
    f, n, out = Counter(), Counter(), []
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f.update((lang, *words[i:i + size]) for i in range(len(words) - size + 1))
    cands = {k: a for k, a in f.items() if len(k) > 2 and a >= least}
    inside = defaultdict(int)
    for k, a in cands.items():
        for size in range(2, len(k) - 1):
            for i in range(1, len(k) - size + 1):
                sub = (k[0], *k[i:i + size])
                inside[sub] = max(inside[sub], a)
    by = defaultdict(list)
    for k, a in cands.items():
        if 100 * inside[k] < share * a:
            score, _, left, right = min((scale * a // (f[k[:c + 1]] + f[k[0], *k[c + 1:]]), c, f[k[:c + 1]], f[k[0], *k[c + 1:]])
                                        for c in range(1, len(k) - 1))
            by[k[0]].append((-score, -a, " ".join(k[1:]).encode(), left, right))
    for lang, found in by.items():
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def phrase_docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0, "x", 1) for i, (lang, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long, chunk string, body long").repartition(3)


TEXTS = [("en", "The cat, sat on THE mat!  the cat\tsat on the mat; on the mat.") for _ in range(40)] + \
    [(None, "Ünder the mat\x0bthe mat \x1c the mat"), ("und", "the mat " * 60), ("de", None), ("de", ""), ("de", "...,,;"), (None, "a " * 5000),
     ("fr", "b c " * 300 + ". b c d" * 35), ("fr", "É é " * 40), ("en", "one two three four five " * 200), ("x\x00", "q r " * 40)]


@pytest.mark.parametrize("least,top", [(30, 2000), (2, 7)])
def test_collocations(spark, least, top):
    got = collocations.collocations(phrase_docs(spark, TEXTS), least=least, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain_phrases(TEXTS, least, top)


def test_collocations_with_full_filters(spark, monkeypatch):
    import duckdb
    rows = duckdb.sql(f"SELECT lang, text FROM '{SMALL}/documents.parquet'").fetchall() + TEXTS
    want = plain_phrases(rows, 5)
    assert len(want) > 300
    for bits in (None, 16):
        if bits:
            monkeypatch.setattr(collocations, "filter_bits", lambda n: bits)
        got = collocations.collocations(phrase_docs(spark, rows), least=5)
        assert sorted(map(tuple, got.collect())) == want


def test_equal_passages_fall_into_equal_chunks(spark):
    passage = " ".join(f"w{i}" for i in range(1500))
    rows = [("en", f"x{i} y{i} {passage} z{i}") for i in range(50)]
    found = collocations.dictionary(phrase_docs(spark, rows))
    total, distinct = found.agg(F.sum("n"), F.count("n")).first()
    assert distinct < total / 5
    assert found.agg(F.max("body")).first()[0] <= collocations.LONGEST


def test_no_documents(spark):
    empty = phrase_docs(spark, TEXTS).filter("doc_id < 0")
    assert collocations.collocations(empty).collect() == []


def test_product_beyond_64_bits(spark):
    big = 9_000_000_000_000
    one = spark.createDataFrame([("e", "a b", 2, big, big, big)], "lang string, phrase string, size int, a long, l long, r long")
    assert 2_000_000 * big > 2 ** 63
    score = F.expr("(cast(2000000 as decimal(10,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    assert one.select(score).first()[0] == 1_000_000


def test_registered(spark):
    for name in ("op11_best_fit_packing", "op12_hard_negatives", "op13_collocations"):
        assert name in queries.QUERIES
