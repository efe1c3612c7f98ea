"""Sharding, personal data and archives against plain versions."""

import base64
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import xxhash
import zstandard

from quarry.llm import hash_tree, pii, warc_bundles
from tests.llm.conftest import LONG, ODD

# -- sharding


def draw(key, node, tree):
    best = None
    for child, weight, shard in tree[node]:
        seed = 42 if key is None else xxhash.xxh64_intdigest(int(key).to_bytes(8, "little", signed=True), 42)
        u = ((xxhash.xxh64_intdigest(child.encode(), seed) >> 11) + 0.5) / 2**53
        best = min(best or (math.inf, "", None), (-math.log(u) / weight, child, shard))
    return best[1], best[2]


def plain_shard(key, tree):
    node, shard = "", None
    while shard is None:
        node, shard = draw(key, node, tree)
    return shard


def test_shards_sizes_and_slots(docs_of, small_docs):
    rows = small_docs + ODD
    got = hash_tree.shard_documents(docs_of(rows)).collect()
    t24, t25 = hash_tree.shard_tree(24), hash_tree.shard_tree(25)
    want = sorted((str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), plain_shard(i, t24), plain_shard(i, t25)) for i, t in rows)
    assert sorted((str(r.doc_id), r.size, r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    for s in range(24):
        mine = sorted((r.slot, r.doc_id or -1) for r in got if r.shard == s)
        assert [k for k, _ in mine] == list(range(len(mine)))
        assert [i for _, i in mine] == sorted(i for _, i in mine)


def test_growth_takes_rows_only_into_the_new_shard(spark):
    ids = spark.range(20000).withColumnRenamed("id", "doc_id")
    for n in (24, 25, 30):
        a = hash_tree.place(ids, hash_tree.shard_tree(n), "doc_id", "a")
        both = hash_tree.place(a, hash_tree.shard_tree(n + 1), "doc_id", "b")
        counts = {r.b: r["count"] for r in both.groupBy("b").count().collect()}
        assert both.filter(f"a <> b and b <> {n}").count() == 0
        assert len(counts) == n + 1 and min(counts.values()) > 0.75 * 20000 / (n + 1)


def test_a_grown_weight_moves_rows_only_into_its_subtree(spark):
    tree = hash_tree.shard_tree(24)
    grown = {k: list(v) for k, v in tree.items()}
    grown["0"] = [(c, w * (3 if c == "0/1" else 1), s) for c, w, s in grown["0"]]
    ids = spark.range(5000).withColumnRenamed("id", "doc_id")
    both = hash_tree.place(hash_tree.place(ids, tree, "doc_id", "a"), grown, "doc_id", "b")
    moved = both.filter("a <> b").collect()
    assert moved and all(4 <= r.b < 8 and r.a < 12 for r in moved)


def test_empty_shards(docs_of):
    assert hash_tree.shard_documents(docs_of([(1, "x")]).filter("doc_id > 5")).collect() == []


# -- personal data

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(s):
    d = [int(c) for c in s][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def plain_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    valid = {"email": lambda s: True, "ip": lambda s: all(int(p) <= 255 for p in s.split(".")),
             "card": lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s)), "phone": lambda s: 9 <= len(digits(s)) <= 15}
    return {k: [m.span() for m in re.finditer(p, text) if valid[k](m[0])]
            for k, p in (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))}


SCHEME = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-"
CUE = {"account": "iban|account|acct|passport|ssn", "secret": "token|secret|password|api_key|apikey"}
BEHIND = {"account": r"(?:[ _-]?(?:number|no|nr|id))?[\s:#=.\"']{1,4}([A-Za-z0-9](?:[ -]?[A-Za-z0-9]){5,33})(?![A-Za-z0-9])",
          "secret": r"[\s:=\"']{1,5}([A-Za-z0-9_+/=-]{16,})"}


def good(kind, s):
    if kind == "secret":
        return bool(re.search("[0-9]", s) and re.search("[A-Za-z]", s))
    s = re.sub("[ -]", "", s)
    digits = len(re.findall("[0-9]", s))
    turned = "".join(str(int(c, 36)) for c in s[4:] + s[:4])
    return digits >= 6 and 2 * digits >= len(s) or bool(re.fullmatch("[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", s)) and int(turned) % 97 == 1


def plain_added(text):
    """The added spans: every place tried from its start, no memory of failures."""
    out, past = {"url": [], "account": [], "secret": []}, 0
    for m in re.finditer("://", text):
        at = m.start()
        rest = re.match(r"[^\s<>\"'`]+", text[at + 3:])
        if at < past or not rest:
            continue
        left = re.search(f"[{re.escape(SCHEME)}]*$", text[past:at])[0]
        while left and not left[0].isalpha():
            left = left[1:]
        body = ("://" + rest[0]).rstrip(".,;:!?)]}")
        if left and len(body) > 3:
            out["url"].append((at - len(left), past := at + len(body)))
    for kind, cues in CUE.items():
        past = 0
        for m in re.finditer("|".join(f"(?={f})" for c in cues.split("|") for f in (c, c.upper(), c.capitalize())), text):
            for c in cues.split("|"):
                a, b = m.start(), m.start() + len(c)
                if a >= past and text[a:b] in (c, c.upper(), c.capitalize()) and not (a and text[a - 1].isalnum()):
                    found = re.compile(BEHIND[kind]).match(text, b)
                    if found and good(kind, found[1]):
                        out[kind].append(found.span(1))
                        past = found.end(1)
    return out


HARD = ["a@b.c@d.e.f g@h", "x..y%+-@a-b.c-d.", "@@a.b", "1.2.3.4.5.6.7.8.9", "1.2..3.4.5.6", "256.1.1.1 0255.0.0.1 1.1.1.1111",
        "4111 1111 1111 1111", "4111-1111-1111-1111-0", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "4111  1111", "5500005555555559 x 1",
        "+1 (415) 555-2671. +12 +1  2 ++49 30 123456-", "+1.2.3.4.5.6.7.8.9", "http://x.y/z?q=1, (https://é.de)", "IBAN: DE89 3704 0044 0532 0130 00!",
        "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\"### 4785380592391139$$$", "Account no: 1234-5678-90", "é@x.y ａ@b.c", ""]


def test_base_spans_equal_the_patterns():
    finder = pii.Finder()
    rng = np.random.default_rng(5)
    made = ["".join(rng.choice(list("a1.2@+- (3)9é\n0"), rng.integers(1, 60))) for _ in range(4000)]
    for text in HARD + made:
        got = finder(text)
        assert {k: got[k] for k in pii.BASE} == plain_spans(text), text


def test_added_spans():
    finder = pii.Finder()
    t = HARD[14]
    (a, b), = finder(t)["account"]
    assert t[a:b] == "DE89 3704 0044 0532 0130 00"
    (a, b), = finder(HARD[15])["secret"]
    assert HARD[15][a:b].startswith("24be")
    t = HARD[13]
    assert [t[a:b] for a, b in finder(t)["url"]] == ["http://x.y/z?q=1", "https://é.de"]


def test_added_spans_equal_plain_search():
    finder, rng = pii.Finder(), np.random.default_rng(11)
    parts = ["token", "secret", "password", "account", "iban", "=", ":", " ", "://", "http", "a", "a1b2c3d4", "0123456789", "_", "-", ".", "/", "DE89", "x" * 17, ",", "\""]
    for _ in range(6000):
        text = "".join(rng.choice(parts, rng.integers(1, 14)))
        got = finder(text)
        assert {k: got[k] for k in pii.ADDED} == plain_added(text), text


def test_junk_texts_take_linear_time():
    import time
    finder = pii.Finder()
    for junk in ("://", "token=", "a://", "://x", "secret token:", "@", "+1 ", "1.", "account id: ", "a@"):
        start = time.process_time()
        finder(junk * (1_000_000 // len(junk)))
        assert time.process_time() - start < 3, junk


def test_find_documents(docs_of, small_docs):
    rows = small_docs + ODD + [(100 + i, t) for i, t in enumerate(HARD)]
    got = sorted((tuple(r) for r in pii.find_documents(docs_of(rows)).collect()), key=str)
    want = []
    for i, t in rows:
        spans = plain_spans(t or "")
        said = ",".join(f"{k}:{a}:{b}" for k in pii.BASE for a, b in spans[k])
        want.append((i, *(len(spans[k]) for k in pii.BASE), hashlib.sha256(said.encode()).hexdigest()))
    assert [g[:6] for g in got] == sorted(want, key=str)
    spans = {}
    for i, t in rows:
        found = plain_spans(t or "") | plain_added(t or "")
        spans.setdefault(i, []).append(",".join(f"{k}:{a}:{b}" for k in pii.BASE + pii.ADDED for a, b in found[k]))
    told = {}
    for g in got:
        told.setdefault(g[0], []).append(g[6])
    assert {i: sorted(x) for i, x in told.items()} == {i: sorted(x) for i, x in spans.items()}
    assert pii.find_documents(docs_of(rows).filter("doc_id < 0")).collect() == []


# -- archives

PAGES = [(1, "http://a/ü x", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "u", None), (4, "u", ""), (5, "u", "two é"),
         (6, "u", LONG), (7, "u", LONG), (8, "u", "<p>one</p>"), (8, "u", "<p>one</p>"), (None, "u", "alone"), (None, "u", "two é")]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    pages = spark.createDataFrame([(*p, "x", "y", 1) for p in PAGES], "page_id long, url string, html string, payload string, digest string, size int")
    return warc_bundles.write_bundles(pages.repartition(3), f"file://{tmp_path_factory.mktemp('warc')}", frame_bytes=2000)


def test_archives_round_trip(index):
    got = sorted((tuple(r) for r in warc_bundles.read_bundles(index).collect()), key=str)
    want = []
    for i, _, html in PAGES:
        raw = (html or "").encode()
        ids = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        first = max(ids, default=None)
        refers = None if first == i else first
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if refers is None else "revisit", refers))
    assert got == sorted(want, key=str)


def test_index_offsets_frames_and_plain_readers(spark, index):
    rows = [r for r in index.collect() if r.page_id is not None]
    for r in rows:
        data = open(r.archive.removeprefix("file://"), "rb").read()
        frame = zstandard.ZstdDecompressor().decompress(data[r.frame_start:r.frame_start + r.frame_bytes])
        (headers, _), = warc_bundles.parse_records(frame[r.record_start:r.record_start + r.record_bytes])
        assert headers["warc-record-id"] == warc_bundles.record_id(r.page_id)
        whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert sum(1 for _ in warc_bundles.parse_records(whole)) == sum(x.archive == r.archive for x in index.collect())
    wanted = spark.createDataFrame([(5,), (7,)], "page_id long")
    got = {r.page_id: bytes(r.block) for r in warc_bundles.read_records(index, wanted).collect()}
    assert got[5].endswith("two é".encode()) and got[7].endswith(LONG.encode())


def test_reading_is_dealt_evenly_to_tasks(spark, tmp_dir):
    from pyspark.sql import functions as F
    pages = spark.range(4000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 40).alias("html"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = warc_bundles.write_bundles(pages.repartition(tasks), tmp_dir, frame_bytes=100_000)
    assert index.select("archive").distinct().count() == tasks
    read = warc_bundles.read_bundles(index)
    each = [r.n for r in read.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(each) == 4000 and len(each) > tasks and max(each) < 4000 / tasks


def test_least_bytes_and_empty_pages(spark, tmp_dir):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    index = warc_bundles.write_bundles(pages, f"{tmp_dir}/a", least_bytes=11)
    kinds = {(r.page_id, r.record_type) for r in warc_bundles.read_bundles(index).collect()}
    assert (1, "response") in kinds and (6, "revisit") in kinds
    none = warc_bundles.write_bundles(pages.filter("page_id > 99"), f"{tmp_dir}/b")
    assert none.collect() == [] and warc_bundles.read_bundles(none).collect() == []
