"""Boosted-tree forecasts: one model for many daily series, trained on their rolling features.

Each day is predicted from what was known the day before: lags, trailing means and the calendar, in units of the
series' own level, so that one model serves all series. Spark ML trains it on the rows of all series at once. The
fitted trees are a few hundred numbers; they become one expression, so a recursive forecast is a fold over the days
ahead inside each series' row: no model server, no loop of jobs, no Python per series.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from . import series as ts_ops
from .forecast import Z_VALUES

HISTORY = 30  # days that features look back
LEAST_LEVEL = 1.0  # a series' level in requests a day counts as this much at least
FEATURES = ["lag_1d", "lag_7d", "lag_14d", "rolling_7d_avg", "rolling_14d_avg", "rolling_7d_stddev", "day_of_week", "month", "is_weekend"]


def lagged_features(daily: DataFrame, value: str = "y", keys: list[str] | None = None) -> DataFrame:
    """(keys, ts, y, level, FEATURES) of each day with 14 days before it; lags and means are shares of ``level``.

    ``daily`` has one row for each day of a series, without gaps. ``level`` is the mean of the last 30 days before.
    """
    by = keys or []
    ordered = Window.partitionBy(*by).orderBy("ts")
    rolling = ts_ops.rolling_features(daily.select(*by, "ts", F.col(value).cast("double").alias("y")), "y", keys)
    before = {c: F.lag(c, 1).over(ordered) for c in ("rolling_7d_avg", "rolling_14d_avg", "rolling_30d_avg", "rolling_7d_stddev")}
    known = ts_ops.calendar_features(rolling.withColumns(before).where("lag_14d is not null"))
    level = F.greatest("rolling_30d_avg", F.lit(LEAST_LEVEL))
    return known.select(
        *by, "ts", "y", level.alias("level"), *[(F.col(c) / level).alias(c) for c in FEATURES[:6]], *[F.col(c).cast("double").alias(c) for c in FEATURES[6:]]
    )


@dataclass(frozen=True)
class Trees:
    """Fitted trees, each a leaf (a number) or (feature, threshold, at most, above), their weights and the residuals' deviation."""

    trees: tuple
    weights: tuple[float, ...]
    sd: float

    def predict(self, features: dict[str, Column]) -> Column:
        """The day's value as a share of the level; without trees the level itself."""
        if not self.trees:
            return F.lit(1.0)

        def value(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            name, threshold, low, high = node
            return F.when(features[name] <= threshold, value(low)).otherwise(value(high))

        total = F.lit(0.0)
        for tree, weight in zip(self.trees, self.weights):
            total = total + weight * value(tree)
        return F.greatest(total, F.lit(0.0))


def _node(java):
    if java.subtreeDepth() == 0:
        return float(java.prediction())
    split = java.split()
    return FEATURES[split.featureIndex()], float(split.threshold()), _node(java.leftChild()), _node(java.rightChild())


def fit_boosted(series: DataFrame, keys: list[str] | None = None, rounds: int = 20, depth: int = 3, step: float = 0.2, seed: int = 7) -> Trees:
    """Train on every day of every series of (keys, ts, y) rows; its size is bounded by ``rounds`` and ``depth`` alone."""
    rows = lagged_features(series, "y", keys).withColumn("share", F.col("y") / F.col("level")).select("share", *FEATURES)
    rows = rows.persist()
    try:
        if not rows.limit(1).count():
            return Trees((), (), 0.0)
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("share", "features")
        booster = GBTRegressor(labelCol="share", featuresCol="features", maxIter=rounds, maxDepth=depth, stepSize=step, seed=seed)
        model = booster.fit(vectors)
        trees = tuple(_node(t._java_obj.rootNode()) for t in model.trees)
        fitted = Trees(trees, tuple(float(w) for w in model.treeWeights), 0.0)
        error = F.col("share") - fitted.predict({c: F.col(c) for c in FEATURES})
        sd = rows.agg(F.sqrt(F.avg(error * error)).alias("sd")).first().sd
        return Trees(fitted.trees, fitted.weights, float(sd))
    finally:
        rows.unpersist()


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v) / F.size(values)


def _features_of(history: Column, day: Column) -> tuple[Column, dict[str, Column]]:
    """Level and features of ``day`` from the values of the days before it, the last one first."""
    level = F.greatest(_mean(history), F.lit(LEAST_LEVEL))
    week = F.slice(history, 1, 7)
    spread = F.aggregate(week, F.lit(0.0), lambda s, v: s + (v - _mean(week)) * (v - _mean(week)))
    values = [history[0], history[6], history[13], _mean(week), _mean(F.slice(history, 1, 14)), F.sqrt(spread / 6)]
    weekday = rules.day_of_week(day)
    calendar = [weekday.cast("double"), F.month(day).cast("double"), F.when(weekday.isin(0, 6), 1.0).otherwise(0.0)]
    return level, dict(zip(FEATURES, [*[v / level for v in values], *calendar]))


def forecast_boosted(model: Trees, series: DataFrame, periods: int, interval: float = 0.95, keys: list[str] | None = None) -> DataFrame:
    """(keys, ts, forecast, lower_bound, upper_bound) of the days after each series' end, each from those before it.

    A series of fewer than 30 days is taken to have run at its mean before. The band is that of one day's residuals.
    """
    by = keys or []
    whole = Window.partitionBy(*by)
    recent = series.withColumn("_end", F.max("ts").over(whole)).where(F.col("ts") > F.date_sub("_end", HISTORY))
    state = recent.groupBy(*by).agg(
        F.max("ts").alias("last_ts"),
        F.avg(F.col("y").cast("double")).alias("mean"),
        F.reverse(F.array_sort(F.collect_list(F.struct("ts", F.col("y").cast("double").alias("y"))))).alias("days"),
    )
    if not by:
        state = state.where(F.col("last_ts").isNotNull())
    history = F.slice(F.concat(F.transform("days", lambda d: d["y"]), F.array_repeat("mean", HISTORY)), 1, HISTORY)

    def ahead(seen: Column, i: Column) -> Column:
        # ``seen`` has the predicted days and before them the history, the last one first
        level, features = _features_of(F.slice(seen, 1, HISTORY), F.date_add("last_ts", i))
        return F.concat(F.array(model.predict(features) * level), seen)

    seen = F.aggregate(F.sequence(F.lit(1), F.lit(periods)), F.col("history"), ahead)
    levels = F.greatest(_mean(F.col("history")), F.lit(LEAST_LEVEL))
    rows = state.withColumn("history", history).select(*by, "last_ts", levels.alias("level"), seen.alias("seen"))
    point = F.posexplode(F.reverse(F.slice("seen", 1, periods))).alias("n", "forecast")
    band = F.lit(Z_VALUES[interval] * (model.sd if math.isfinite(model.sd) else 0.0)) * F.col("level")
    return rows.select(*by, "last_ts", "level", point).select(
        *by, F.date_add("last_ts", F.col("n") + 1).alias("ts"), "forecast", (F.col("forecast") - band).alias("lower_bound"), (F.col("forecast") + band).alias("upper_bound")
    )


def forecast_series(series: DataFrame, periods: int, interval: float = 0.95, keys: list[str] | None = None) -> DataFrame:
    """Train on ``series`` and forecast it."""
    return forecast_boosted(fit_boosted(series, keys), series, periods, interval, keys)
