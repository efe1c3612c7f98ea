"""Empty inputs and nulls across the operators."""

import pytest
from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.operators import density, profile, regress, relational as rel, text as ops, vectors as vo, weather
from quarry.operators.prices import unnest_prices, bad_price_lists


@pytest.fixture()
def empty_nums(spark):
    return spark.createDataFrame([], "a double, b double, id long")


def test_empty_profile(spark, empty_nums):
    d = profile.describe(empty_nums, ["a"]).first()
    assert d["count"] == 0 and d["mean"] is None and d["q50"] is None
    assert profile.histogram(empty_nums, ["a"], 30).count() == 0
    assert profile.pair_bins(empty_nums, ["a", "b"], 10).count() == 0
    assert profile.missing_report(empty_nums).where(F.col("rows") == 0).count() == 3
    c = profile.correlation_matrix(empty_nums, ["a", "b"]).collect()
    assert all(r.corr is None for r in c)
    assert profile.extreme_rows(empty_nums, "a", "id", 3).where(F.col("kind").isin("first", "last")).count() == 0


def test_all_null_column_quantiles(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    assert profile.exact_quantiles(df, ["a"], (0.5,)) == {("a", 0.5): None}
    one = spark.createDataFrame([(3.0,), (None,)], "a double")
    assert profile.exact_quantiles(one, ["a"], (0.25, 0.5)) == {("a", 0.25): 3.0, ("a", 0.5): 3.0}


def test_empty_pivot_and_stations(spark):
    m = spark.createDataFrame([], weather.MEASUREMENT_DDL)
    st = spark.createDataFrame([], "station_id string")
    out = weather.daily_table(m, st, ["PRCP"])
    assert out.count() == 0 and "PRCP_qc_flag" in out.columns


def test_empty_text(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ops.tag_language(docs, "doc_id", "text").count() == 0
    freq = ops.token_frequencies(docs, tx.basic_english_tokens("text"))
    vocab = ops.build_vocabulary(freq)
    assert sorted(r.idx for r in vocab.collect()) == [0, 1, 2, 3]
    assert ops.encode(docs, "doc_id", tx.split_whitespace("text"), vocab).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    r = nulls.select(tx.word_count("text").alias("w"), tx.clean_sentence("text").alias("c"),
                     tx.split_whitespace("text").alias("t")).collect()
    assert r[0].w is None and r[0].c is None and r[1].w == 0 and r[1].c == "" and r[1].t == []
    tagged = {x.doc_id: x.language for x in ops.tag_language(nulls, "doc_id", "text").collect()}
    assert tagged == {1: "undetectable", 2: "undetectable"}


def test_empty_vectors(spark):
    keys = spark.createDataFrame([], "k int, v array<double>")
    q = spark.createDataFrame([(0, [1.0, 0.0])], "q int, v array<double>")
    assert vo.cosine_top_k(keys, "k", "v", q, "q", "v", 3).count() == 0
    nq = spark.createDataFrame([], "q int, v array<double>")
    k2 = spark.createDataFrame([(1, [1.0, 0.0])], "k int, v array<double>")
    assert vo.attention_weights(k2, "k", "v", nq, "q", "v").count() == 0


def test_empty_models(spark):
    e = spark.createDataFrame([], "v double")
    k = density.gaussian_kde(e, "v", -10.0, 30.0, 1000, 0.1)
    assert k.count() == 1000 and k.where(F.col("density").isNotNull()).count() == 0
    r = regress.least_squares(spark.createDataFrame([], "x double, y double"), "x", "y").first()
    assert r.slope is None and r.n == 0


def test_prices_null_and_bad_lists(spark):
    df = spark.createDataFrame([
        (1, "[{'amountMax': 5.0, 'dateSeen': ['d1', 'd2'], 'sourceURLs': ['u1', 'u2', 'u3'], 'extra': 1}]"),
        (2, "[{'amountMax': 1.0, 'isSale': True, 'offer': 'True deal', 'warranty': None}]"),  # Python literals
        (3, None), (4, "not a list"),
        (5, "[{'amountMin': 2.0, 'dateSeen': [], 'sourceURLs': null}]"),
        (6, "[{'amountMax': 5.0, 'dateSeen': ['d1', 'd1'], 'sourceURLs': ['u1']}]")],
        "id int, prices string")
    out = unnest_prices(df, "id", "prices")
    got = sorted((r.id, r.dateSeen, r.sourceURLs) for r in out.collect())
    assert [g for g in got if g[0] == 1] == [(1, d, u) for d in ("d1", "d2") for u in ("u1", "u2", "u3")]
    assert [g for g in got if g[0] == 5] == [(5, None, None)]            # empty/null lists keep a row
    assert [g for g in got if g[0] == 6] == [(6, "d1", "u1")]            # exact duplicates dropped
    assert {g[0] for g in got} == {1, 2, 5, 6}
    assert "availability" not in out.columns and "amountMax" in out.columns
    full = {r.id: r for r in unnest_prices(df, "id", "prices", drop_sparse=False).collect()}
    assert full[2].isSale == "true" and full[2].offer == "True deal" and full[2].warranty is None
    assert sorted(r.id for r in bad_price_lists(df, "prices").collect()) == [4]


def test_relational_helpers(spark):
    df = spark.createDataFrame([(1, "a.b", None), (2, "c", 3.0)], "k int, `x.y` string, v double")
    assert rel.keep_columns(df, ["x.y"]).columns == ["x.y"]
    assert rel.drop_null_rows(df, ["v"]).count() == 1
    assert rel.first_value(rel.first_n(df, 1, "k")) == 1
    assert rel.first_value(rel.last_n(df, 1, "k")) == 2
    assert rel.first_value(spark.createDataFrame([], "k int")) is None
    u = rel.concat_rows(df.select("k"), df.select("k", "v"))
    assert u.columns == ["k", "v"] and u.where(F.col("v").isNull()).count() == 3


def test_drop_sparse_columns_and_current_year(spark, tmp_dir):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None), (3, 5.0, "c")], "k int, v double, s string")
    assert profile.drop_sparse_columns(df, 0.5).columns == ["k", "s"]
    import datetime
    import gzip
    import os
    y = datetime.date.today().year
    with gzip.open(os.path.join(tmp_dir, f"{y}.csv.gz"), "wt") as f:
        f.write("S1,20240101,PRCP,1.0,,,,\n")
    from quarry.operators.weather import MEASUREMENT_DDL
    from quarry.sources.files import read_years
    assert read_years(spark, tmp_dir, None, MEASUREMENT_DDL).first().file_year == y


def test_scale_conf():
    from quarry.session import scale_conf
    c = scale_conf(100 * 10**12, 8000)
    n = int(c["spark.sql.shuffle.partitions"])
    assert n % 8000 == 0 and 100 * 10**12 / n <= 256 * 2**20
    assert int(scale_conf(10**6, 8)["spark.sql.shuffle.partitions"]) == 16


def test_spread_only_below_a_fixed_split_count(spark):
    from quarry.sources.tables import SPREAD_SPLITS, spread
    wide = spark.range(0, 1000, numPartitions=SPREAD_SPLITS)
    assert "Exchange" not in spread(wide, 8000)._jdf.queryExecution().executedPlan().toString()
    narrow = spark.range(0, 1000, numPartitions=1)
    assert "RoundRobinPartitioning" in spread(narrow, 8)._jdf.queryExecution().executedPlan().toString()


def test_days_with_null_values_stay_in_their_table(spark):
    from quarry.operators import weather
    m = spark.createDataFrame([("a", "20200101", "PRCP", None, "T", None, None), ("a", "20200101", "TMAX", 5.0, None, None, None),
                               ("a", "20200102", "TMIN", 3e9, None, None, None)], weather.MEASUREMENT_DDL.replace(", hour string", ""))
    stations = spark.createDataFrame([("a",)], "station_id string")
    t = weather.daily_tables(m, stations)
    assert [r.PRCP_measurement_flag for r in t["precipitation"].collect()] == ["T"]
    assert {(r.date_key, r.TMIN_measurement_value) for r in t["temperature"].collect()} == {("20200101", None), ("20200102", None)}
    assert t["wind"].count() == 0 and "PRCP_present" not in t["precipitation"].columns


def test_empty_texts_keep_their_rows(spark):
    from quarry.functions import text as tx
    from quarry.operators import text as ops
    docs = spark.createDataFrame([(1, "a b a zzz"), (2, ""), (3, None)], "i long, t string")
    vocab = spark.createDataFrame([("a", 4), ("b", 5)], "token string, idx long")
    for as_text in (True, False):
        enc = ops.encode(docs, "i", tx.split_whitespace("t"), vocab, as_text)
        got = {r.i: (r.n_tokens, r.n_unknown) for r in enc.collect()}
        assert got == {1: (4, 1), 2: (0, 0), 3: (0, 0)}
        with_unk = vocab.unionByName(spark.createDataFrame([("<unk>", 0)], "token string, idx long"))
        assert {r.i: r.text for r in ops.decode(enc, "i", with_unk).collect()} == {1: "a b a <unk>", 2: "", 3: ""}


def test_price_literals_after_any_number_of_spaces(spark):
    from quarry.operators import prices
    rows = [(n, "[{'amountMax': 1.5, 'isSale':" + " " * n + "True}]") for n in (0, 1, 15, 17, 300)] + [(999, "[{'amountMax': 1"), (1000, None)]
    df = spark.createDataFrame(rows, "id long, p string")
    assert {r.id for r in prices.unnest_prices(df, "id", "p").collect()} == {0, 1, 15, 17, 300}
    assert tuple(prices.price_parse_report(df, "p").first()) == (6, 5, 1)


def test_many_queries_in_blocks(spark):
    from quarry.operators import vectors
    keys = spark.createDataFrame([(i, [float(i + 1), 1.0]) for i in range(4)], "k long, v array<double>")
    queries = spark.range(5000).select(F.col("id").alias("q"), F.array(F.col("id") + 1.0, F.lit(2.0)).alias("qv"))
    few = vectors.cosine_top_k(keys, "k", "v", queries.where("q < 50"), "q", "qv", 2)
    blocks = vectors.cosine_top_k(keys, "k", "v", queries.where("q < 50"), "q", "qv", 2, block=7)
    assert sorted(few.collect()) == sorted(blocks.collect())
    assert vectors.cosine_top_k(keys, "k", "v", queries, "q", "qv", 1).count() == 5000


def test_numbers_out_of_the_ordinary(spark):
    from quarry.operators import density, profile, regress
    odd = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 1e10, -1e300)] + [(float("nan"),), (float("inf"),), (None,)], "x double")
    plain = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 1e10, -1e300, 1e11)], "x double")
    a, b = ([round(r.density, 12) for r in density.gaussian_kde(d, "x", 0.0, 5.0, 21, 0.5).orderBy("grid_idx").collect()] for d in (odd, plain))
    assert a == b and max(a) > 0
    bins = profile.histogram(odd.where("x is null or isnan(x) or x < 10 and x > 0 or x > 1e300"), ["x"], 2)
    assert {(r.bin, r["count"]) for r in bins.collect()} == {(0, 1), (1, 2)}
    d = profile.describe(spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "x double"), ["x"], digits=0).first()
    assert (d["count"], d["mean"], d.q50, d["max"]) == (2, 2.0, 2.0, 3.0)
    rows = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0), (None, 9.0), (4.0, None)], "x double, y double")
    gram, passes = (regress.gradient_descent(rows, ["x"], "y", 0.1, 3, method=m) for m in ("gram", "passes"))
    assert all(abs(p[1] - q[1]) < 1e-9 for p, q in zip(gram, passes))


def test_language_needs_no_shuffle(spark):
    from quarry.operators import text as ops
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = ops.tag_language(docs.select("doc_id", "text"), "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_price_lists_of_a_hot_order_stay_short(spark):
    from quarry.plans import models
    line = (1, 2, 3, 10.0, 100.0, 0.1, "N", "O")
    rows = [(7, i % 7 + 1, *line[1:]) for i in range(5000)] + [(7, 1, *line[1:])] * 500 + [(8, 1, *line[1:])]
    li = spark.createDataFrame([r + (f"1994-01-{r[1]:02d}",) for r in rows],
                               "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
                               "l_discount double, l_returnflag string, l_linestatus string, l_shipdate string").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    from quarry.operators import prices
    lists = models.price_text_per_order(li.repartition(5)).select("id", F.size(prices.parse_price_list("prices")).alias("n"))
    n = {r.id: (r.most, r.all) for r in lists.groupBy("id").agg(F.max("n").alias("most"), F.sum("n").alias("all")).collect()}
    assert n[7][0] <= models.PRICE_LIST_LINES and (n[7][1], n[8][1]) == (5500, 1)


def test_scalars_in_list_fields_and_rejected_lists(spark):
    from quarry.operators import prices
    rows = [(1, "[{'dateSeen': 'd', 'sourceURLs': ['u', 'v'], 'merchant': 'm'}, {'sourceURLs': 'w'}]"), (2, "[{'dateSeen': [], 'sourceURLs': null}]"),
            (3, "[{'dateSeen': 5, 'isSale': True}]"), (4, "no list"), (5, None), (6, " "), (7, "[]")]
    df = spark.createDataFrame(rows, "id int, prices string")
    got = sorted((tuple(r) for r in prices.unnest_prices(df, "id", "prices").select("id", "dateSeen", "sourceURLs").collect()), key=str)
    assert got == sorted([(1, "d", "u"), (1, "d", "v"), (1, None, "w"), (2, None, None), (3, "5", None)], key=str)
    told = {r.id: r.reason for r in prices.read_prices(df, "id", "prices").collect()}
    assert told == {1: None, 2: None, 3: None, 4: "not a list of dicts", 5: "no text", 6: "empty text", 7: None}


def test_prices_move_as_elements_and_are_parsed_once(spark):
    from quarry.operators import prices
    e = "'amountMax': 1.0, 'merchant': 'm'"
    rows = [(1, f"[{{{e}, 'dateSeen': ['a', 'b', 'a'], 'sourceURLs': ['u']}}, {{{e}, 'dateSeen': ['b', 'c'], 'sourceURLs': ['u', 'v']}}]"),
            (1, f"[{{{e}, 'dateSeen': ['c'], 'sourceURLs': ['v']}}, {{{e}}}, {{{e}, 'dateSeen': []}}, {{'amountMax': -0.0}}, {{'amountMax': 0.0}}]"),
            (None, f"[{{{e}, 'offer': 'x'}}, {{{e}, 'offer': 'y'}}]"), (None, f"[{{{e}, 'offer': 'x'}}]"), (2, "[null, {'sourceURLs': ['w', null, null]}]")]
    out = prices.unnest_prices(spark.createDataFrame(rows, "id int, prices string").repartition(3), "id", "prices")
    got = sorted((r.id or 0, str(r.amountMax), str(r.dateSeen), str(r.sourceURLs)) for r in out.collect())
    one = [("a", "u"), ("b", "u"), ("b", "v"), ("c", "u"), ("c", "v"), ("None", "None")]
    assert got == sorted([(1, "1.0", *x) for x in one] + [(1, "0.0", "None", "None")] + [(0, "1.0", "None", "None")] * 2
                         + [(2, "None", "None", x) for x in ("None", "w")])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange") and "Filter ((size(coalesce" not in plan
