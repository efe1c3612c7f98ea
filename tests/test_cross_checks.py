"""Cross-checks against Spark's own MLlib implementations (second sources)."""

import numpy as np
from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.operators import density, regress, text as ops, weather


def test_kde_matches_mllib_kernel_density(spark):
    from pyspark.mllib.stat import KernelDensity
    rng = np.random.default_rng(9)
    x = [float(v) for v in np.round(rng.normal(5, 3, 2000), 2)]
    kd = KernelDensity()
    kd.setSample(spark.sparkContext.parallelize(x, 4))
    kd.setBandwidth(0.1)
    g = [-10.0 + i * (40.0 / 999) for i in range(1000)]
    want = kd.estimate(g)
    df = spark.createDataFrame([(v,) for v in x], "v double")
    got = {r.grid_idx: r.density for r in density.gaussian_kde(df, "v", -10.0, 30.0, 1000, 0.1).collect()}
    assert max(abs(got[i] - want[i]) for i in range(1000)) < 1e-9


def test_least_squares_matches_mllib(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    rng = np.random.default_rng(2)
    rows = [(float(a), float(b), float(3 * a - 2 * b + 1 + rng.normal())) for a, b in rng.normal(size=(500, 2))]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    one = regress.least_squares(df, "a", "y").first()
    m = LinearRegression(solver="normal", regParam=0.0, featuresCol="f", labelCol="y").fit(
        VectorAssembler(inputCols=["a"], outputCol="f").transform(df))
    assert abs(one.slope - m.coefficients[0]) < 1e-9 and abs(one.intercept - m.intercept) < 1e-9
    # gradient descent approaches the same fit on standardised data
    std = regress.standardize(df, ["a", "y"])
    hist = regress.gradient_descent(std, ["a"], "y", 0.5, 200)
    exact = regress.least_squares(std, "a", "y").first()
    assert abs(hist[-1][2][1] - exact.slope) < 1e-6 and abs(hist[-1][2][0] - exact.intercept) < 1e-6


def test_naive_bayes_agrees_with_mllib(spark):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import CountVectorizer
    train = spark.createDataFrame([
        ("D1", 1, "Chinese Beijing Chinese"), ("D2", 1, "Chinese Chinese Shanghai"),
        ("D3", 1, "Chinese Macao"), ("D4", 0, "Tokyo Japan Chinese")], "id string, label int, body string")
    test = spark.createDataFrame([
        ("D5", "Chinese Chinese Chinese Tokyo Japan"), ("D6", "Beijing Shanghai Trade"),
        ("D7", "Japan Macao Tokyo"), ("D8", "Tokyo Japan Trade")], "id string, body string")
    ours = {r.id: r.predicted for r in ops.naive_bayes(
        train, "label", tx.letter_tokens("body"), test, "id", tx.letter_tokens("body")).collect()}
    tt = train.withColumn("w", tx.letter_tokens("body"))
    cv = CountVectorizer(inputCol="w", outputCol="features").fit(tt)
    nb = NaiveBayes(smoothing=1.0, modelType="multinomial", labelCol="label").fit(
        cv.transform(tt).withColumn("label", F.col("label").cast("double")))
    theirs = {r.id: int(r.prediction) for r in nb.transform(
        cv.transform(test.withColumn("w", tx.letter_tokens("body")))).collect()}
    assert ours == theirs == {"D5": 1, "D6": 1, "D7": 0, "D8": 0}


def test_weather_tables_share_one_scan(spark, tmp_dir):
    rows = [("S1", "20240105", t, 5.0, None, None, "7", None)
            for t in ("PRCP", "TMIN", "TMAX", "AWND", "TSUN")]
    path = f"{tmp_dir}/m"
    spark.createDataFrame(rows, weather.MEASUREMENT_DDL).write.parquet(path)
    m = spark.read.parquet(path)
    st = spark.createDataFrame([("S1",)], "station_id string")
    for name, df in weather.daily_tables(m, st).items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1, name
        assert df.count() == 1
