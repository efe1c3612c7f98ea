"""Registered queries: daily pivot, relational operators, profiling, nested prices."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import scalar
from quarry.operators import profile, relational as rel, reviews, weather
from quarry.plans.registry import register
from quarry.sources.tables import load

# ---------------------------------------------------------------- daily pivot (flagship)

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
SCALED_TYPES = ("purchase", "view")


def _measurements_sql(types) -> str:
    in_list = ", ".join(f"'{t}'" for t in types)
    return f"""
  m AS (
    SELECT user_id AS station_id, strftime(ts, '%Y%m%d') AS date_key,
           event_type AS measurement_type, value AS measurement_value,
           json_extract_string(props, '$.k') AS measurement_flag,
           CASE WHEN value < 1 THEN 'L' END AS qc_flag,
           upper(substr(event_type, 1, 1)) AS source_flag
    FROM events WHERE event_type IN ({in_list})),
  j AS (SELECT m.* FROM m JOIN (SELECT c_custkey AS station_id FROM customer) s USING (station_id))"""


def _pivot_sql(types, scaled=()) -> str:
    cols = []
    for t in types:
        for f in weather.MEASURE_FIELDS:
            e = f"max(CASE WHEN measurement_type = '{t}' THEN {f} END)"
            if f == "measurement_value" and t in scaled:
                e = f"CAST(trunc({e}) AS INTEGER) / 10"
            cols.append(f"{e} AS {t}_{f}")
    return f"""WITH {_measurements_sql(types)},
  p AS (SELECT station_id, trim(date_key) AS date_key, {', '.join(cols)}
        FROM j GROUP BY station_id, date_key)
SELECT p.*, substr(date_key, 1, 4) AS year, CAST(try_strptime(substr(date_key, 1, 4) || '-' || substr(date_key, 5, 2) || '-' || substr(date_key, 7, 2), '%Y-%m-%d') AS DATE) AS date
FROM p WHERE date_key IS NOT NULL"""


def daily_pivot(spark, sf_dir):
    m = weather.measurements_from_events(load(spark, sf_dir, "events"))
    stations = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("station_id"))
    return weather.daily_table(m, stations, EVENT_TYPES)


register("daily_pivot", _pivot_sql(EVENT_TYPES))(daily_pivot)


@register("pivot_scaled", _pivot_sql(SCALED_TYPES, SCALED_TYPES))
def pivot_scaled(spark, sf_dir):
    m = weather.measurements_from_events(load(spark, sf_dir, "events"))
    stations = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("station_id"))
    return weather.daily_table(m, stations, SCALED_TYPES, scaled=SCALED_TYPES)


# Event types standing for the published tables' types; values with one decimal are null,
# so that some (station, day) has rows of a type but no value of it.
TABLE_GROUPS = {"first": EVENT_TYPES[:1], "others": EVENT_TYPES[1:]}


def _with_null_values(m):
    return m.withColumn("measurement_value", F.when(F.col("measurement_value") >= 5, F.col("measurement_value")))


def _daily_split_sql() -> str:
    parts = []
    for name, types in TABLE_GROUPS.items():
        vals = ", ".join(_quoted(t) for t in types)
        parts.append(f"""SELECT '{name}' AS "table", count(*) AS days, count(v) AS days_with_value, count(f) AS days_with_flag
FROM (SELECT max(CASE WHEN value >= 5 THEN value END) AS v, max(json_extract_string(props, '$.k')) AS f
      FROM events JOIN customer ON c_custkey = user_id WHERE event_type IN ({vals})
      GROUP BY user_id, strftime(ts, '%Y%m%d'))""")
    return "\nUNION ALL\n".join(parts)


def _quoted(t: str) -> str:
    return "'" + t + "'"


@register("daily_split", _daily_split_sql())
def daily_split(spark, sf_dir):
    """The published tables split off one pivot; days whose values are all null
    stay in their table."""
    m = _with_null_values(weather.measurements_from_events(load(spark, sf_dir, "events")))
    stations = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("station_id"))
    tables = weather.daily_tables(m, stations, TABLE_GROUPS, scaled=())
    out = None
    for name, df in tables.items():
        types = TABLE_GROUPS[name]
        value = F.coalesce(*[F.col(f"{t}_measurement_value") for t in types])
        flag = F.coalesce(*[F.col(f"{t}_measurement_flag") for t in types])
        one = df.agg(F.count(F.lit(1)).alias("days"), F.count(value).alias("days_with_value"),
                     F.count(flag).alias("days_with_flag")).select(F.lit(name).alias("table"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@register("review_timestamps", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 3 THEN CAST(l_shipdate AS TIMESTAMP) END AS added FROM lineitem""")
def review_timestamps(spark, sf_dir):
    """X11: text in the review format parsed to timestamps; text in no known format (here
    every third line's) gives null."""
    text = F.when(F.col("l_linenumber") == 3, F.date_format("l_shipdate", "dd.MM.yyyy")) \
        .when(F.col("l_linenumber") == 2, F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")) \
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
    raw = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.alias("dateAdded"))
    stamped = reviews.with_timestamps(raw, ("dateAdded",))
    return stamped.select("l_orderkey", "l_linenumber", F.col("dateAdded").alias("added"))


@register("prepared_reviews", """
WITH r AS (SELECT *, CAST(DATE '2020-01-01' + CAST(doc_id % 1000 AS INTEGER) AS TIMESTAMP) AS day FROM documents)
SELECT doc_id AS id, source AS manufacturer, CASE WHEN doc_id % 7 <> 0 THEN day END AS "dateAdded", day AS "reviewsDate",
       CASE WHEN doc_id % 11 <> 0 THEN n_chars % 50 END AS helpfullness, CAST(doc_id % 5 + 1 AS DOUBLE) AS rating,
       lang AS "reviewsTitle", text AS "customerReviews",
       CAST(n_chars % 97 AS DOUBLE) * CASE doc_id % 3 WHEN 0 THEN CAST(0.0625 AS DOUBLE) WHEN 1 THEN CAST(0.00220462 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS weight_value,
       'lbs' AS units
FROM r""")
def prepared_reviews(spark, sf_dir):
    """P1 + X11 + D1 + P2, the whole preparation: documents in the raw review columns (names
    with dots, dates, weights and counts as text, some of them unreadable) made into typed ones."""
    d, n = load(spark, sf_dir, "documents"), F.col("doc_id")
    day = F.date_add(F.lit("2020-01-01").cast("date"), (n % 1000).cast("int"))
    unit = F.when(n % 3 == 0, "ounces").when(n % 3 == 1, "grams").otherwise("pounds")
    raw = d.select(n.alias("id"), F.col("source").alias("manufacturer"),
                   F.when(n % 7 == 0, "unknown").otherwise(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("dateAdded"),
                   F.date_format(day, "yyyy-MM-dd HH:mm:ss").alias("reviews.date"),
                   F.when(n % 11 == 0, "none").otherwise((F.col("n_chars") % 50).cast("string")).alias("reviews.numHelpful"),
                   (n % 5 + 1).cast("string").alias("reviews.rating"), F.col("lang").alias("reviews.title"),
                   F.col("text").alias("reviews.text"), F.concat_ws(" ", (F.col("n_chars") % 97).cast("string"), unit).alias("weight"))
    return reviews.prepare_reviews(raw).select("id", "manufacturer", "dateAdded", "reviewsDate", "helpfullness", "rating",
                                               "reviewsTitle", "customerReviews", "weight_value", "units")


@register("first_order", "SELECT min(o_orderkey) AS first_key, max(year(current_date)) AS this_year FROM orders")
def first_order(spark, sf_dir):
    """T3 + S8 + X13: the first field of the first row, as a table made from it, with the
    current year."""
    first = rel.first_value(load(spark, sf_dir, "orders").select("o_orderkey").orderBy("o_orderkey"))
    return spark.createDataFrame([(first,)], "first_key long").withColumn("this_year", scalar.current_year().cast("long"))


@register("distinct_types", "SELECT DISTINCT event_type FROM events")
def distinct_types(spark, sf_dir):
    return rel.distinct_values(load(spark, sf_dir, "events"), "event_type")


# ---------------------------------------------------------------- joins and decoding

@register("dim_join", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, l.l_extendedprice
FROM lineitem l JOIN (SELECT p_partkey AS l_partkey FROM part) p
USING (l_partkey)""")
def dim_join(spark, sf_dir):
    facts = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    dim = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"))
    return rel.join_on_dimension_keys(facts, dim, "l_partkey")


# Code tables for the return flag and the line status.  'N' is left out
# of the return codes on purpose: a left join keeps such rows with a null meaning.
RETURN_CODES = {"A": "accepted", "R": "returned"}
STATUS_CODES = {"F": "fulfilled", "O": "open"}


def _values_sql(codes):
    return ", ".join(f"('{k}', '{v}')" for k, v in sorted(codes.items()))


@register("flag_decode", f"""
SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag, r.meaning AS return_meaning,
       l.l_linestatus, s.meaning AS status_meaning
FROM lineitem l
LEFT JOIN (VALUES {_values_sql(RETURN_CODES)}) r(code, meaning) ON l.l_returnflag = r.code
LEFT JOIN (VALUES {_values_sql(STATUS_CODES)}) s(code, meaning) ON l.l_linestatus = s.code""")
def flag_decode(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    rc = weather.code_table(spark, RETURN_CODES, "code", "meaning")
    sc = weather.code_table(spark, STATUS_CODES, "code", "meaning")
    out = rel.decode_codes(li, "l_returnflag", rc, "code", "meaning", "return_meaning")
    out = rel.decode_codes(out, "l_linestatus", sc, "code", "meaning", "status_meaning")
    return out.select("l_orderkey", "l_linenumber", "l_returnflag", "return_meaning",
                      "l_linestatus", "status_meaning")


# ---------------------------------------------------------------- projections, filters

@register("group_count", 'SELECT lang, count(*) AS "count" FROM documents GROUP BY lang')
def group_count(spark, sf_dir):
    return rel.count_by(load(spark, sf_dir, "documents").select("lang"), "lang")


# Unit word by part type; PROMO parts carry a bare number (no unit).
UNIT_BY_TYPE = {"ECONOMY": "ounces", "SMALL": "grams", "LARGE": "pounds",
                "MEDIUM": "lbs", "STANDARD": "ounces"}


def _unit_case_sql():
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in UNIT_BY_TYPE.items())
    return f"CASE p_type {whens} END"


@register("conditional_units", f"""
WITH w AS (
  SELECT p_partkey,
         CASE WHEN {_unit_case_sql()} IS NULL THEN CAST(p_size AS VARCHAR)
              ELSE CAST(p_size AS VARCHAR) || ' ' || {_unit_case_sql()} END AS weight
  FROM part),
t AS (SELECT p_partkey, weight, TRY_CAST(string_split(weight, ' ')[1] AS DOUBLE) AS v,
             string_split(weight, ' ')[2] AS raw_units FROM w)
SELECT p_partkey, weight, raw_units,
       CASE WHEN raw_units = 'ounces' THEN v * 0.0625
            WHEN raw_units = 'grams' THEN v * 0.00220462 ELSE v END AS weight_value,
       'lbs' AS units
FROM t""")
def conditional_units(spark, sf_dir):
    from quarry.functions import scalar
    part = load(spark, sf_dir, "part")
    unit = F.lit(None).cast("string")
    for k, v in UNIT_BY_TYPE.items():
        unit = F.when(F.col("p_type") == k, F.lit(v)).otherwise(unit)
    size = F.col("p_size").cast("string")
    w = part.select("p_partkey", F.when(unit.isNull(), size)
                    .otherwise(F.concat_ws(" ", size, unit)).alias("weight"))
    return scalar.weight_in_pounds(w, "weight").select(
        "p_partkey", "weight", "raw_units", "weight_value", "units")


@register("rename_drop_project", """
SELECT c_custkey AS id, c_name AS name, c_nationkey, c_acctbal AS balance,
       c_acctbal / 1000 AS balance_k
FROM customer""")
def rename_drop_project(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    c = rel.rename_columns(c, {"c_custkey": "id", "c_name": "name", "c_acctbal": "balance"})
    c = rel.drop_columns(c, ["c_mktsegment", "not_a_column"])
    c = c.withColumn("balance_k", F.col("balance") / 1000)
    return rel.keep_columns(c, ["id", "name", "c_nationkey", "balance", "balance_k"])


@register("filter_modulo", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 5 = 0 AND o_orderkey % 7 = 0""")
def filter_modulo(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    # two chained filters; Catalyst merges them into one conjunction (F8)
    return (o.where(rel.multiple_of("o_orderkey", 5)).where(rel.multiple_of("o_orderkey", 7))
             .select("o_orderkey", "o_custkey"))


@register("intersect_ranges", """
SELECT o_orderkey FROM orders WHERE o_orderkey % 5 = 0
INTERSECT SELECT o_orderkey FROM orders WHERE o_orderkey % 7 = 0""")
def intersect_ranges(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey")
    return rel.intersect_distinct(o.where(rel.multiple_of("o_orderkey", 5)),
                                  o.where(rel.multiple_of("o_orderkey", 7)))


@register("square_pairs", """
SELECT o_orderkey, o_orderkey * o_orderkey AS key_squared, o_totalprice,
       o_totalprice * o_totalprice AS price_squared
FROM orders WHERE o_orderkey % 2 = 1""")
def square_pairs(spark, sf_dir):
    """P9 + X22 + F7: each odd order key mapped to the pair (x, x squared), the same for
    the order total."""
    o = load(spark, sf_dir, "orders").where(F.col("o_orderkey") % 2 == 1)
    return o.select("o_orderkey", (F.col("o_orderkey") * F.col("o_orderkey")).alias("key_squared"),
                    "o_totalprice", F.pow("o_totalprice", 2).alias("price_squared"))


@register("filter_regex", "SELECT n_nationkey, n_name FROM nation WHERE regexp_matches(n_name, '1')")
def filter_regex(spark, sf_dir):
    n = load(spark, sf_dir, "nation")
    return n.where(rel.contains_regex("n_name", "1")).select("n_nationkey", "n_name")


@register("open_range", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 10 AND l_quantity < 20""")
def open_range(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return (li.where(rel.open_range("l_quantity", 10, 20))
              .select("l_orderkey", "l_linenumber", "l_quantity"))


@register("dropna", """
SELECT d.doc_id, d.lang, l.quality, l.toxic
FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NOT NULL""")
def dropna(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = load(spark, sf_dir, "labels")
    return rel.drop_null_rows(docs.join(labels, "doc_id", "left"), ["quality"])


@register("union_concat", """
SELECT c_custkey AS "key", c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS segment, 'customer' AS source FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 'supplier' FROM supplier""")
def union_concat(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("source"))
    s = load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"),
        F.lit("supplier").alias("source"))
    return rel.concat_rows(c, s)


@register("json_key_count", """
SELECT "key", json_extract_string(props, '$."' || "key" || '"') AS value, count(*) AS "count"
FROM (SELECT props, unnest(json_keys(props)) AS "key" FROM events)
GROUP BY ALL""")
def json_key_count(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    kv = e.select(F.explode(F.from_json("props", "map<string,string>")).alias("key", "value"))
    return kv.groupBy("key", "value").count()


# ---------------------------------------------------------------- profiling

LINE_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _describe_sql():
    parts = []
    for c in LINE_NUMERIC:
        parts.append(f"""SELECT '{c}' AS "column", count({c}) AS "count",
  round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS "min",
  round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
  round(quantile_cont({c}, 0.75), 6) AS q75, max({c}) AS "max" FROM lineitem""")
    return "\nUNION ALL\n".join(parts)


@register("describe_numeric", _describe_sql())
def describe_numeric(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    d = profile.describe(li, LINE_NUMERIC)
    return d.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


@register("null_report", """
WITH j AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
           FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT c.*, r."rows", non_null / r."rows" AS non_null_share FROM (
  SELECT 'doc_id' AS "column", 'bigint' AS dtype, count(doc_id) AS non_null FROM j UNION ALL
  SELECT 'lang', 'string', count(lang) FROM j UNION ALL
  SELECT 'source', 'string', count(source) FROM j UNION ALL
  SELECT 'n_chars', 'bigint', count(n_chars) FROM j UNION ALL
  SELECT 'quality', 'int', count(quality) FROM j UNION ALL
  SELECT 'toxic', 'int', count(toxic) FROM j) c,
  (SELECT count(*) AS "rows" FROM j) r""")
def null_report(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    j = docs.join(load(spark, sf_dir, "labels"), "doc_id", "left")
    return profile.missing_report(j).select("column", "dtype", "non_null", "rows", "non_null_share")


@register("minmax_rows", """
WITH c AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer)
SELECT * FROM (
  SELECT 'first' AS kind, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS "rank", * FROM c)
  WHERE "rank" <= 3
UNION ALL
SELECT * FROM (
  SELECT 'last' AS kind, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS "rank", * FROM c)
  WHERE "rank" <= 3
UNION ALL
SELECT * FROM (SELECT 'argmin', 1, * FROM c ORDER BY c_acctbal, c_custkey LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'argmax', 1, * FROM c ORDER BY c_acctbal DESC, c_custkey LIMIT 1)""")
def minmax_rows(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    return profile.extreme_rows(c, "c_acctbal", "c_custkey", 3).withColumn(
        "rank", F.col("rank").cast("bigint"))


def _bin_sql(c, bins):
    return (f"least(floor(({c} - mn_{c}) / ((mx_{c} - mn_{c}) / {bins})), {bins - 1})")


def _histogram_sql(bins=30):
    mm = ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in LINE_NUMERIC)
    parts = [f"""SELECT '{c}' AS "column", CAST({_bin_sql(c, bins)} AS INTEGER) AS bin
  FROM lineitem, s""" for c in LINE_NUMERIC]
    return (f"WITH s AS (SELECT {mm} FROM lineitem), b AS (\n" + "\nUNION ALL\n".join(parts)
            + ')\nSELECT "column", bin, count(*) AS "count" FROM b GROUP BY ALL')


@register("histogram30", _histogram_sql(30))
def histogram30(spark, sf_dir):
    return profile.histogram(load(spark, sf_dir, "lineitem"), LINE_NUMERIC, 30)


def _corr_sql():
    parts = [f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 9) AS corr FROM lineitem"
             for a in LINE_NUMERIC for b in LINE_NUMERIC]
    return "\nUNION ALL\n".join(parts)


@register("corr_matrix", _corr_sql())
def corr_matrix(spark, sf_dir):
    m = profile.correlation_matrix(load(spark, sf_dir, "lineitem"), LINE_NUMERIC)
    return m.withColumn("corr", F.round("corr", 9))


PAIR_COLS = ("value", "user_id", "event_id")


def _pair_bins_sql(bins=10):
    mm = ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in PAIR_COLS)
    parts = []
    for i, a in enumerate(PAIR_COLS):
        for b in PAIR_COLS[i + 1:]:
            parts.append(f"""SELECT '{a}' AS col_a, '{b}' AS col_b,
  CAST({_bin_sql(a, bins)} AS INTEGER) AS bin_a, CAST({_bin_sql(b, bins)} AS INTEGER) AS bin_b
  FROM events, s""")
    return (f"WITH s AS (SELECT {mm} FROM events), b AS (\n" + "\nUNION ALL\n".join(parts)
            + ')\nSELECT col_a, col_b, bin_a, bin_b, count(*) AS "count" FROM b GROUP BY ALL')


@register("pair_bins", _pair_bins_sql(10))
def pair_bins(spark, sf_dir):
    return profile.pair_bins(load(spark, sf_dir, "events"), PAIR_COLS, 10)
