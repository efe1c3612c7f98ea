"""Every registered query against its DuckDB oracle on sf0.001, and plan checks."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from quarry import plans
from quarry.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
# the library's own queries; those of the optional training-data part have their own tests
QUERIES = {n: q for n, q in entry.queries().items() if n in plans.QUERIES}
ORACLE = {n: q for n, q in entry.oracle_sql().items() if n in plans.QUERIES}


def _norm(v):
    # floats must match bit for bit: registered outputs that come from sums are
    # rounded in the query and in its SQL alike
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "PRCP_measurement_value" not in df.columns and "view_measurement_value" in df.columns


def test_every_query_has_an_oracle_or_is_listed():
    no_sql = set(QUERIES) - set(ORACLE)
    assert not no_sql
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    order = [dcols.index(c) for c in cols]
    assert Counter(tuple(_norm(v) for v in r) for r in rows) == \
        Counter(tuple(_norm(r[i]) for i in order) for r in drows)


BAD_NODES = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_python_udf_or_cartesian(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in BAD_NODES:
        assert bad not in plan, f"{name}: {bad}"


@pytest.mark.parametrize("name,needle", [
    ("open_range", "GreaterThan(l_quantity,10.0)"),
    ("dim_join", "ReadSchema: struct<p_partkey:bigint>"),
    ("daily_pivot", "In(event_type"),
    ("filter_regex", "ReadSchema: struct<n_nationkey:int,n_name:string>"),
])
def test_filters_and_columns_reach_the_scan(spark, name, needle):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert needle in plan


# Every query registered so far; a later change may add queries but must not drop one.
REGISTERED = {
    "attention",
    "attention_top",
    "attention_weights",
    "cauchy_at_values",
    "centroids",
    "clean_text",
    "conditional_units",
    "corr_matrix",
    "cosine_topk",
    "daily_pivot",
    "decode_texts",
    "density_compare",
    "describe_numeric",
    "dim_join",
    "distinct_types",
    "dropna",
    "encode_texts",
    "english_only",
    "filter_modulo",
    "filter_regex",
    "flag_decode",
    "gmm_density",
    "gradient_epochs",
    "group_count",
    "histogram30",
    "intersect_ranges",
    "json_key_count",
    "kde_grid",
    "kde_interp",
    "lang_accuracy",
    "lang_counts",
    "lang_tag",
    "line_pairs",
    "minmax_rows",
    "naive_bayes_counts",
    "nearest_rows",
    "null_report",
    "ols_exact",
    "open_range",
    "pair_bins",
    "parallel_text",
    "prepared_reviews",
    "pivot_scaled",
    "price_unnest",
    "rename_drop_project",
    "square_pairs",
    "stop_words_removed",
    "targets_per_source",
    "token_freq",
    "truncate_315",
    "union_concat",
    "vocab",
    "vocab_top",
    "word_count_filter",
}


def test_no_registered_query_is_dropped():
    assert REGISTERED <= set(QUERIES)
