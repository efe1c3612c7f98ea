"""Profiling (A4, A5, A8-A11, A17) against NumPy / plain Python."""

import numpy as np
from pyspark.sql import functions as F

from quarry.operators import profile


def test_exact_quantiles_with_hot_value_and_nulls(spark):
    rng = np.random.default_rng(11)
    a = np.round(rng.normal(50, 20, 20_000), 3)
    a[:7000] = 42.0                                        # one value holds a third
    b = rng.integers(0, 5, 20_000).astype(float)
    rows = [(float(x), float(y) if i % 10 else None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double").repartition(6)
    qs = profile.exact_quantiles(df, ["a", "b"], (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0), k=64)
    bb = np.array([y for i, y in enumerate(b) if i % 10])
    for p in (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0):
        assert abs(qs[("a", p)] - np.quantile(a, p)) < 1e-9
        assert abs(qs[("b", p)] - np.quantile(bb, p)) < 1e-9


def test_describe_and_missing_report(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, "x"), (4.0, "y"), (None, "z")], "v double, s string")
    d = profile.describe(df, ["v"]).first()
    assert (d["count"], d["mean"], d["min"], d["max"]) == (3, 7 / 3, 1.0, 4.0)
    assert abs(d["std"] - np.std([1, 2, 4], ddof=1)) < 1e-12
    assert (d["q25"], d["q50"], d["q75"]) == (1.5, 2.0, 3.0)
    m = {r.column: (r.dtype, r.non_null, r.rows) for r in profile.missing_report(df).collect()}
    assert m == {"v": ("double", 3, 4), "s": ("string", 3, 4)}


def test_histogram_correlation_pairs_extremes(spark):
    vals = [float(i) for i in range(31)]
    df = spark.createDataFrame([(v, 2 * v + 1, -v) for v in vals], "a double, b double, c double")
    h = {r.bin: r["count"] for r in profile.histogram(df, ["a"], 30).collect()}
    assert sum(h.values()) == 31 and h[29] == 2 and set(h) == set(range(30))   # max in last bin
    c = {(r.col_a, r.col_b): r.corr for r in profile.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert abs(c[("a", "b")] - 1) < 1e-12 and abs(c[("a", "c")] + 1) < 1e-12
    pb = profile.pair_bins(df, ["a", "b"], 10)
    assert pb.agg(F.sum("count")).first()[0] == 31
    ex = profile.extreme_rows(df.withColumn("id", F.col("a").cast("long")), "c", "id", 2).collect()
    kinds = {(r.kind, r.rank): r.id for r in ex}
    assert kinds[("first", 1)] == 30 and kinds[("last", 1)] == 0
    assert kinds[("argmin", 1)] == 30 and kinds[("argmax", 1)] == 0


def test_quantiles_with_infinities_and_the_widest_range(spark):
    inf = float("inf")
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)
    a = [-inf] * 3 + [float(i) for i in range(40)] + [inf] * 2
    b = [-1e308, 1e308] + [float(i) for i in range(43)]
    c = [inf] * 45
    df = spark.createDataFrame(list(zip(a, b, c)), "a double, b double, c double").repartition(4)
    qs = profile.exact_quantiles(df, ["a", "b", "c"], probs)
    for p in probs:
        for name, values in (("a", a), ("b", b), ("c", c)):
            h = sorted(values)
            k, share = divmod((len(h) - 1) * p, 1)
            lo, hi = h[int(k)], h[min(int(k) + 1, len(h) - 1)]
            want = lo if lo == hi or not share else (1 - share) * lo + share * hi
            assert qs[(name, p)] == want or abs(qs[(name, p)] - want) < 1e-9, (name, p)


def test_describe_with_infinities(spark):
    inf = float("inf")
    df = spark.createDataFrame([(float(v),) for v in (-inf, 1, 2, 3, 4, 5, inf)], "x double")
    d = profile.describe(df, ["x"], digits=3).first()
    assert (d["count"], d["min"], d["q25"], d["q50"], d["q75"], d["max"]) == (7, -inf, 1.5, 3.0, 4.5, inf)


def test_quantiles_of_any_spread_take_two_passes(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = [10.0 ** e for e in range(-300, 300)] + [-(10.0 ** e) for e in range(-300, 300, 3)] + rng.normal(size=30_000).tolist()
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(5)
    probs = (0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0)
    passes, ranked = [], profile._ranked
    monkeypatch.setattr(profile, "_ranked", lambda *a: (passes.append(1), ranked(*a))[1])
    for k in (64, 4096):
        qs = profile.exact_quantiles(df, ["x"], probs, k=k)
        for p in probs:
            assert np.isclose(qs["x", p], np.quantile(x, p), rtol=1e-12, atol=0)
    assert len(passes) == 2  # one after each sketch


def test_quantiles_outside_their_brackets_are_found(spark):
    from pyspark.sql import Row
    df = spark.createDataFrame([(float(v),) for v in range(100)], "x double")
    wrong = [Row(n=100, ends=[[70.0, 80.0], [10.0, 20.0], [40.0, 60.0]])]
    got = profile.exact_quantiles(df, ["x"], (0.25, 0.75, 0.5), brackets=wrong)
    assert got == {("x", 0.25): 24.75, ("x", 0.75): 74.25, ("x", 0.5): 49.5}
