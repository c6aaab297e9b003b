"""The boosted forecaster: features, trees as expressions, recursion, and what it can learn."""

import datetime

import pytest
from pyspark.sql import functions as F

from lampyris.operators import boosting
from lampyris.operators import forecast as fc

DAY = datetime.date(2024, 1, 1)


def rows(n, value, key=None):
    out = [(DAY + datetime.timedelta(i), float(value(i))) for i in range(n)]
    return [(key, *r) for r in out] if key is not None else out


@pytest.fixture(scope="module")
def weekly(spark):
    """Two series of very different size with the same week: busy on two days, quiet on the others."""
    shape = lambda i: 3 if i % 7 in (2, 5) else 1
    data = rows(200, lambda i: 100 * shape(i), "big") + rows(200, lambda i: 4 * shape(i), "small")
    return spark.createDataFrame(data, "k string, ts date, y double")


def test_features_of_arrays_equal_those_of_windows(spark):
    data = rows(60, lambda i: (i * 37) % 11)
    series = spark.createDataFrame(data, "ts date, y double")
    want = boosting.lagged_features(series).where(F.col("ts") == data[-1][0]).first()
    history = F.lit([y for _, y in data[-31:-1]][::-1])
    level, features = boosting._features_of(history, F.lit(data[-1][0]))
    got = spark.range(1).select(level.alias("level"), *[c.alias(n) for n, c in features.items()]).first()
    assert got.level == pytest.approx(want.level)
    for name in boosting.FEATURES:
        assert got[name] == pytest.approx(want[name]), name


def test_trees_as_an_expression_equal_the_library(spark, weekly):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    table = boosting.lagged_features(weekly, "y", ["k"]).withColumn("share", F.col("y") / F.col("level"))
    vectors = VectorAssembler(inputCols=boosting.FEATURES, outputCol="features").transform(table)
    model = GBTRegressor(labelCol="share", maxIter=4, maxDepth=3, seed=1).fit(vectors)
    trees = boosting.Trees(tuple(boosting._node(t._java_obj.rootNode()) for t in model.trees), tuple(model.treeWeights), 0.0)
    both = model.transform(vectors).select("prediction", trees.predict({c: F.col(c) for c in boosting.FEATURES}).alias("own")).collect()
    assert len(both) == 2 * 186 and all(r.own == pytest.approx(max(r.prediction, 0.0)) for r in both)


def test_one_model_learns_the_week_of_all_series(weekly):
    metrics = {r.k: r for r in fc.evaluation_metrics(weekly, keys=["k"], forecaster=boosting.forecast_series).collect()}
    assert {k: r.days for k, r in metrics.items()} == {"big": 30, "small": 30}
    assert metrics["big"].mae < 20 and metrics["small"].mae < 0.8


def test_beats_the_trend_where_the_level_jumps(spark):
    """After a jump the trend model runs between the two levels; lags see the new one."""
    series = spark.createDataFrame(rows(300, lambda i: 20 if i < 200 else 80), "ts date, y double")
    trend = fc.evaluation_metrics(series).first()
    boosted = fc.evaluation_metrics(series, forecaster=boosting.forecast_series).first()
    assert boosted.days == trend.days == 30 and boosted.mae < trend.mae / 2


def test_days_follow_each_series_own_end(spark):
    data = rows(40, lambda i: 5, "a") + rows(20, lambda i: 2, "b") + rows(1, lambda i: 9, "c")
    found = boosting.forecast_series(spark.createDataFrame(data, "k string, ts date, y double"), 3, keys=["k"]).collect()
    want = {(k, DAY + datetime.timedelta(n + i)) for k, n in (("a", 40), ("b", 20), ("c", 1)) for i in range(3)}
    assert {(r.k, r.ts) for r in found} == want and len(found) == 9
    assert all(r.lower_bound <= r.forecast <= r.upper_bound for r in found)


def test_short_and_empty_series(spark):
    series = spark.createDataFrame(rows(5, lambda i: 7), "ts date, y double")
    assert [r.forecast for r in boosting.forecast_series(series, 2).collect()] == [7.0, 7.0]
    assert boosting.forecast_series(series.limit(0), 2).collect() == []
    assert boosting.forecast_series(series.limit(0).withColumn("k", F.lit("x")), 2, keys=["k"]).collect() == []
