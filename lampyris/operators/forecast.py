"""Forecasting many daily series in one job: linear trend + weekday effect + normal interval.

``boosting`` has the model of trees trained on rolling features; both are scored by ``evaluation_metrics``. Fitting is one aggregation over (series, day) rows; the model of a series is a handful of numbers, so
forecasting is a projection over the future days. No per-series Python, no loop over series.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from . import series as ts_ops

# Two-sided normal quantiles of the supported prediction intervals
Z_VALUES = {0.80: 1.2815515655446004, 0.90: 1.6448536269514722, 0.95: 1.959963984540054, 0.99: 2.5758293035489004}


def fit_forecast(series: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One model row per series: trend, seven weekday effects (a map), residual deviation, last day.

    The series is read once: per (series, weekday) its means, variances and covariance with the day number
    determine trend, weekday effects and residual spread. Seven rows per series remain to be combined.
    """
    by = keys or []
    x, y = ts_ops.day_index(F.col("ts")).cast("double"), F.col("y")
    weekday = series.groupBy(*by, rules.day_of_week(F.col("ts")).alias("dow")).agg(
        F.count("*").alias("n"),
        F.avg(x).alias("mx"),
        F.avg(y).alias("my"),
        F.var_pop(x).alias("vx"),
        F.var_pop(y).alias("vy"),
        F.covar_pop(x, y).alias("cxy"),
        F.max("ts").alias("last_ts"),
    )
    whole = Window.partitionBy(*by)
    n = F.col("n")
    total = F.sum(n).over(whole)
    centred = weekday.withColumn("days", total).withColumn("dx", F.col("mx") - F.sum(n * F.col("mx")).over(whole) / total).withColumn(
        "gy", F.sum(n * F.col("my")).over(whole) / total
    ).withColumn("dy", F.col("my") - F.col("gy"))
    sxx = F.sum(n * (F.col("vx") + F.col("dx") * F.col("dx"))).over(whole)
    sxy = F.sum(n * (F.col("cxy") + F.col("dx") * F.col("dy"))).over(whole)
    # a one-day series has no trend: it is forecast by its mean
    sloped = centred.withColumn("slope", F.when(sxx > 0, sxy / F.nullif(sxx, F.lit(0.0))).otherwise(F.lit(0.0)))
    slope = F.col("slope")
    within = n * F.greatest(F.col("vy") + slope * slope * F.col("vx") - 2 * slope * F.col("cxy"), F.lit(0.0))
    return sloped.groupBy(*by).agg(
        F.max("last_ts").alias("last_ts"),
        F.max("days").alias("days"),
        F.max(slope).alias("slope"),
        F.max(F.col("gy") - slope * (F.col("mx") - F.col("dx"))).alias("intercept"),
        F.map_from_entries(F.collect_list(F.struct("dow", (F.col("dy") - slope * F.col("dx")).alias("effect")))).alias("effects"),
        F.sqrt(F.sum(within) / F.greatest(F.max("days") - 1, F.lit(1))).alias("sd"),
    )


def forecast(models: DataFrame, periods: int, interval: float = 0.95, keys: list[str] | None = None) -> DataFrame:
    """(keys, ts, forecast, lower_bound, upper_bound) for the days after each series' end. Nothing is clipped."""
    z = Z_VALUES[interval]
    future = models.withColumn("ahead", F.explode(F.sequence(F.lit(1), F.lit(periods)))).withColumn(
        "ts", F.date_add("last_ts", F.col("ahead"))
    )
    effect = F.coalesce(F.try_element_at("effects", rules.day_of_week(F.col("ts"))), F.lit(0.0))
    point = F.col("intercept") + F.col("slope") * ts_ops.day_index(F.col("ts")) + effect
    return future.select(*(keys or []), "ts", point.alias("forecast"), "sd").select(
        *(keys or []), "ts", "forecast",
        (F.col("forecast") - z * F.col("sd")).alias("lower_bound"),
        (F.col("forecast") + z * F.col("sd")).alias("upper_bound"),
    )


def forecast_series(series: DataFrame, periods: int, interval: float = 0.95, keys: list[str] | None = None) -> DataFrame:
    return forecast(fit_forecast(series, keys), periods, interval, keys)


def evaluation_metrics(series: DataFrame, holdout: int = 30, keys: list[str] | None = None, forecaster: Callable[..., DataFrame] = forecast_series) -> DataFrame:
    """Fit without the last ``holdout`` days and score them: MAE, RMSE, MAPE (days with y = 0 left out).

    ``forecaster(train, periods, keys=keys)`` gives the forecast to be scored.
    """
    by = keys or []
    marked = series.withColumn("_end", F.max("ts").over(Window.partitionBy(*by)))
    cut = F.date_sub("_end", holdout)
    train = marked.where(F.col("ts") <= cut).drop("_end")
    test = marked.where(F.col("ts") > cut).drop("_end")
    scored = test.join(forecaster(train, holdout, keys=keys), [*by, "ts"])
    error = F.col("y") - F.col("forecast")
    return scored.groupBy(*by).agg(
        F.count("*").alias("days"),
        rules.round_half_up(F.avg(F.abs(error)), 4).alias("mae"),
        rules.round_half_up(F.sqrt(F.avg(error * error)), 4).alias("rmse"),
        rules.round_half_up(F.avg(F.abs(error) / F.nullif(F.abs("y"), F.lit(0.0))) * 100, 4).alias("mape"),
    )


def forecast_table(rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Rounded forecast with calendar columns."""
    day = F.col("ts")
    return rows.select(
        *(keys or []),
        day.alias("forecast_date"),
        rules.round_int(F.col("forecast")).alias("predicted"),
        rules.round_int(F.col("lower_bound")).alias("lower_bound"),
        rules.round_int(F.col("upper_bound")).alias("upper_bound"),
        rules.round_half_up(F.col("forecast"), 2).alias("predicted_precise"),
        rules.day_of_week(day).alias("day_of_week"),
        rules.season(day).alias("season"),
        rules.round_int(F.col("upper_bound") - F.col("lower_bound")).alias("prediction_range"),
        rules.week_start(day).alias("week_start"),
        rules.month_start(day).alias("month_start"),
    )
