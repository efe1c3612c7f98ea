"""Text functions and operators
checked against plain-Python versions of the same rules."""

import re
import string

from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.operators import text as ops
from quarry.sources.tables import load

TRICKY = [
    "  Hello, World!  It's   (really) fine?\n",
    "Tabs\tand\nnewlines   nbsp em space",
    'He said "no"; then: <br />left... ok',
    "Café näive 3rd x2 well-known e-mail don't",
    "",
    "   ",
    "Ünïcödé ÉCOLE straße ÇA",
    'a<br;/>b <br "/>c <br ./>d it\'s<br />ok <br /><br />x <BR />y',
    "(a).b,c!d?e;f:g 'h' \"i\" <br/>j",
]


def py_basic_english(line):
    rules = [(r"\'", " '  "), (r"\"", ""), (r"\.", " . "), (r"<br \/>", " "), (r",", " , "),
             (r"\(", " ( "), (r"\)", " ) "), (r"\!", " ! "), (r"\?", " ? "), (r"\;", " "),
             (r"\:", " "), (r"\s+", " ")]
    line = line.lower()
    for p, r in rules:
        line = re.sub(p, r, line)
    return line.split()


def py_clean(line):
    table = str.maketrans("", "", string.punctuation)
    words = [w.lower() for w in line.split()]
    words = [w.translate(table) for w in words]
    words = [re.sub(r"\s+", " ", w) for w in words]
    return " ".join(w for w in words if w.isalpha())


def _texts(spark):
    docs = [r.text for r in load(spark, "/root/testdata/sf0.001", "documents").select("text").collect()]
    return TRICKY + docs[:60]


def _df(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")


def test_tokenizers_match_python(spark):
    texts = _texts(spark)
    got = _df(spark, texts).select(
        "i", tx.basic_english_tokens("t").alias("fast"),
        tx.basic_english_tokens_by_rules("t").alias("rules"),
        tx.split_whitespace("t").alias("ws"), tx.word_count("t").alias("wc"),
        tx.clean_sentence("t").alias("clean")).collect()
    for r in got:
        t = texts[r.i]
        assert r.fast == py_basic_english(t), t
        assert r.rules == r.fast
        assert r.ws == t.split(), t
        assert r.wc == len(t.split())
        assert r.clean == py_clean(t), t


def test_small_functions(spark):
    df = spark.createDataFrame([("a  b c",), ("x y x y",)], "s string")
    r = df.select(tx.split_space("s").alias("sp"),
                  tx.remove_stop_words(tx.split_whitespace("s"), ["y"]).alias("nostop"),
                  tx.truncate_words("s", 2).alias("tr"), tx.collapse_ws("s").alias("cw"),
                  tx.letters_only(F.lit("abc")).alias("lo1"), tx.letters_only(F.lit("a1")).alias("lo2"),
                  tx.strip_unicode(F.lit("  pad \t")).alias("st")).collect()
    assert r[0].sp == ["a", "", "b", "c"]
    assert r[1].nostop == ["x", "x"]                 # repeats kept (not array_except)
    assert r[0].tr == "a b" and r[0].cw == "a b c"
    assert r[0].lo1 and not r[0].lo2 and r[0].st == "pad"


def test_review_word_counts(spark):
    df = spark.createDataFrame([(1, "one"), (2, "two words"), (None, "x y z"), (3, None)],
                               "id int, text string")
    out = ops.review_word_counts(df, "id", "text", 1)
    assert [(r.id, r.word_num) for r in out.collect()] == [(2, 2)]


def test_vocabulary_order_and_round_trip(spark):
    texts = ["b a b c", "a b", "d"]
    df = _df(spark, texts)
    freq = ops.token_frequencies(df, tx.split_whitespace("t"))
    vocab = ops.build_vocabulary(freq)
    v = {r.token: r.idx for r in vocab.collect()}
    assert v == {"<unk>": 0, "<pad>": 1, "<bos>": 2, "<eos>": 3, "b": 4, "a": 5, "c": 6, "d": 7}
    probe = spark.createDataFrame([(0, "a d zz b")], "i int, t string")
    enc = ops.encode(probe, "i", tx.split_whitespace("t"), vocab).first()
    assert enc.ids == "5 7 0 4" and enc.n_unknown == 1 and enc.n_tokens == 4
    dec = ops.decode(ops.encode(probe, "i", tx.split_whitespace("t"), vocab), "i", vocab).first()
    assert dec.text == "a d <unk> b"


def test_dense_index_many_partitions(spark):
    from quarry.operators.indexing import dense_index
    df = spark.range(0, 50_000, numPartitions=7).select((F.col("id") * 7919 % 50_000).alias("v"))
    out = dense_index(df, [F.col("v").desc()], name="idx")
    bad = out.where(F.col("idx") != F.lit(49_999) - F.col("v")).count()
    assert bad == 0 and out.count() == 50_000


def test_naive_bayes_toy_golden(spark):
    train = spark.createDataFrame([
        ("D1", 1, "Chinese Beijing Chinese"), ("D2", 1, "Chinese Chinese Shanghai"),
        ("D3", 1, "Chinese Macao"), ("D4", 0, "Tokyo Japan Chinese")], "id string, label int, body string")
    test = spark.createDataFrame([
        ("D5", "Chinese Chinese Chinese Tokyo Japan"), ("D6", "Beijing Shanghai Trade"),
        ("D7", "Japan Macao Tokyo"), ("D8", "Tokyo Japan Trade")], "id string, body string")
    pred = ops.naive_bayes(train, "label", tx.letter_tokens("body"), test, "id",
                           tx.letter_tokens("body"))
    assert {r.id: r.predicted for r in pred.collect()} == {"D5": 1, "D6": 1, "D7": 0, "D8": 0}


def test_language_tags(spark):
    df = spark.createDataFrame([
        (1, "The cat and the dog are in the house"), (2, "Le chat et le chien sont dans la maison"),
        (3, "Der Hund und die Katze"), (4, "El perro y los gatos con la casa"), (5, "xyz 123")],
        "id int, text string")
    out = {r.id: r.language for r in ops.tag_language(df, "id", "text").collect()}
    assert out == {1: "en", 2: "fr", 3: "de", 4: "es", 5: "undetectable"}


def test_language_accuracy_on_documents(spark):
    d = load(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang", "text")
    t = ops.tag_language(d, "doc_id", "text")
    acc = t.agg(F.avg((F.col("lang") == F.col("language")).cast("double"))).first()[0]
    assert acc > 0.9


def test_turn_pairs_and_targets(spark):
    turns = spark.createDataFrame([
        (1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"),
        (1, 3, "user", "again"), (1, 4, "user", "hi"), (1, 5, "assistant", "hey"),
        (2, 0, "user", "hi"), (2, 1, "assistant", "hello")], "conv_id int, turn int, role string, text string")
    pairs = ops.next_turn_pairs(turns)
    got = sorted((r.conv_id, r.turn, r.source, r.target) for r in pairs.collect())
    assert got == [(1, 1, "hi", "hello"), (1, 4, "hi", "hey"), (2, 0, "hi", "hello")]
    n = {r.source: r.n_targets for r in ops.targets_per_source(pairs).collect()}
    assert n == {"hi": 2}


def test_vocabulary_head_equals_filtered_vocabulary(spark):
    d = load(spark, "/root/testdata/sf0.001", "documents")
    freq = ops.token_frequencies(d, tx.basic_english_tokens("text"))
    full = {(r.token, r.idx) for r in ops.build_vocabulary(freq).where(F.col("idx") < 25).collect()}
    head = {(r.token, r.idx) for r in ops.vocabulary_head(freq, 25).collect()}
    assert head == full and len(head) == 25
    assert {r.idx for r in ops.vocabulary_head(freq, 2).collect()} == {0, 1}


def test_trained_language_tags(spark):
    d = load(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang", "text")
    model = ops.language_model(d, "doc_id", "text", "lang")
    got = model.first()["model"]
    assert [m.lang for m in got] == ["de", "en", "es", "fr"] and {len(m.w) for m in got} == {ops.CODES ** 2}
    t = ops.tag_by_model(d, "text", model)
    held = t.where(ops.held_out_text("doc_id")).agg(F.count("*"), F.avg((F.col("lang") == F.col("language")).cast("double"))).first()
    assert held[0] > 150 and held[1] >= 0.97
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan.split("Subquery")[0]
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 ½ !"), (4, "z")], "id int, text string")
    assert {r.id: r.language for r in ops.tag_by_model(odd, "text", model).collect()}[4] in ("de", "en", "es", "fr")
    assert {r.language for r in ops.tag_by_model(odd.where("id < 4"), "text", model).collect()} == {"undetectable"}
    # without labels there is no model; a bounded sample decides, whatever else there is
    dark = ops.language_model(d.withColumn("lang", F.lit(None).cast("string")), "doc_id", "text", "lang")
    assert {r.language for r in ops.tag_by_model(odd, "text", dark).collect()} == {"undetectable"}


def test_language_model_counts(spark):
    import hashlib
    import math
    ids = [i for i in range(60) if hashlib.md5(str(i).encode()).hexdigest()[0] >= "4"][:3]
    rows = [(ids[0], "x", "ab, AB"), (ids[1], "x", None), (ids[2], "y", "b")]
    model = ops.language_model(spark.createDataFrame(rows, "id long, lang string, t string"), "id", "t", "lang").first()["model"]
    n = ops.CODES ** 2
    pairs = {97 * ops.CODES + 98: 2, 98 * ops.CODES + 32: 1, 32 * ops.CODES + 97: 1}
    assert [m.lang for m in model] == ["x"]  # one character has no pair
    assert model[0].w == [round(1000 * math.log((pairs.get(i, 0) + 0.5) / (4 + 0.5 * n))) for i in range(n)]


def test_encode_and_decode_beyond_the_head(spark):
    import random
    random.seed(1)
    texts = [" ".join(random.choice("abcdefghijklmnopqrst") * random.randint(1, 3) for _ in range(random.randint(0, 30))) for _ in range(120)]
    rows = list(enumerate(texts)) + [(7, "a b zzzz"), (7, None), (None, "c")]
    df = spark.createDataFrame(rows, "i int, t string").repartition(3)
    vocab = ops.build_vocabulary(ops.token_frequencies(df.where("t not like '%zzzz%'"), tx.split_whitespace("t"))).cache()
    idx = {r.token: r.idx for r in vocab.collect()}
    want = sorted(((i, " ".join(str(idx.get(w, 0)) for w in (t or "").split()), len((t or "").split())) for i, t in rows), key=str)
    back = sorted(((i, " ".join(w if w in idx else "<unk>" for w in (t or "").split())) for i, t in rows), key=str)
    for head in (1, 8, ops.HEAD):  # nothing, some and all tokens are looked up in the row
        enc = ops.encode(df, "i", tx.split_whitespace("t"), vocab, head=head)
        assert sorted(((r.i, r.ids, r.n_tokens) for r in enc.collect()), key=str) == want
        lists = ops.encode(df, "i", tx.split_whitespace("t"), vocab, as_text=False, head=head)
        for e in (enc, lists):
            assert sorted(map(tuple, ops.decode(e, "i", vocab, head=head).collect()), key=str) == back
    assert {r.n_unknown for r in enc.where("i = 7").collect()} >= {1}
    odd = spark.createDataFrame([(1, [4, 10 ** 9, -1, 0])], "i int, ids array<long>")
    assert ops.decode(odd, "i", vocab, head=8).first().text == {v: k for k, v in idx.items()}[4] + " <unk>"


def test_naive_bayes_frequent_tokens_do_not_move(spark):
    import math
    import random
    random.seed(2)
    words = [w * n for w in "abcdefghij" for n in (1, 2, 3)]
    texts = [" ".join(random.choices(words, [1 / (i + 1) for i in range(30)], k=random.randint(0, 20))) for _ in range(80)]
    rows = [(i, i % 3 == 0, t) for i, t in enumerate(texts)]
    train = spark.createDataFrame(rows[:50], "id int, label boolean, t string")
    score = spark.createDataFrame([r[::2] for r in rows] + [(7, "a zzz"), (None, "b b"), (81, None)], "id int, t string").repartition(3)
    seen = {c: [w for _, k, t in rows[:50] if k == c for w in t.split()] for c in (False, True)}
    v, n = len(set(seen[False] + seen[True])), {c: sum(r[1] == c for r in rows[:50]) for c in (False, True)}

    def best(text):
        s = [math.log(n[c] / 50) + sum(math.log((seen[c].count(w) + 1) / (len(seen[c]) + v)) for w in text.split() if w in seen[False] + seen[True])
             for c in (False, True)]
        return s[1] > s[0]

    whole = {i: t for i, _, t in rows} | {None: "b b", 81: ""}
    whole[7] += " a zzz"
    for head in (1, 5, ops.HEAD):
        got = ops.naive_bayes(train, "label", tx.letter_tokens("t"), score, "id", tx.letter_tokens("t"), head=head)
        assert {r.id: r.predicted for r in got.collect()} == {i: best(t) for i, t in whole.items()}
        assert "LeftAnti, BuildRight" in got._jdf.queryExecution().executedPlan().toString()
