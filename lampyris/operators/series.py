"""Daily and weekly request series.

Every operator takes optional ``keys``: with keys it builds one series per key value in a single job,
windows partition by the keys and nothing passes through one task. Without keys there is one series,
whose length is bounded by the calendar; the raw requests are counted per day (partial aggregation)
before any window or spine is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules

# Output column -> issue type
ISSUE_COLUMNS = {
    "bulb_failures": "bulb_failure",
    "wiring_issues": "wiring",
    "pole_damage": "pole_damage",
    "power_supply": "power_supply",
    "sensor_failures": "sensor_failure",
}
COUNT_COLUMNS = ["total", "unique_lights_affected", *ISSUE_COLUMNS]


def daily_counts(requests: DataFrame, issue: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """Requests per day with distinct lights and one count per issue type.

    Counting goes through (day, light) groups, so the distinct count needs no second copy of the rows and a
    light or an issue type that owns most requests is combined before the shuffle.
    """
    rows = requests.where(F.col("reported_at").isNotNull())
    if issue:
        rows = rows.where(F.col("issue_type") == issue)
    per_light = rows.groupBy(*(keys or []), F.to_date("reported_at").alias("ts"), "light_id").agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col("issue_type") == value).alias(name) for name, value in ISSUE_COLUMNS.items()],
    )
    return per_light.groupBy(*(keys or []), "ts").agg(
        F.sum("total").alias("total"),
        F.count("light_id").alias("unique_lights_affected"),
        *[F.sum(name).alias(name) for name in ISSUE_COLUMNS],
    )


def date_spine(daily: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Every day between each series' first and last day."""
    bounds = daily.groupBy(*(keys or [])).agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return bounds.where(F.col("a").isNotNull()).select(*(keys or []), F.explode(F.sequence("a", "b")).alias("ts"))


def gap_fill(daily: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The spine left-joined with the counts, missing days as 0.

    Each counted day is stretched over the gap up to the next one, so the counts are read once and the
    spine is never built or joined. A series holds at most one row per calendar day.
    """
    by = keys or []
    days = Window.partitionBy(*by).orderBy("ts")
    following = F.lead("ts").over(days)
    values = [c for c in daily.columns if c not in ("ts", *by)]
    stretched = daily.withColumn("_until", F.coalesce(F.date_sub(following, 1), F.col("ts")))
    filled = stretched.withColumn("_day", F.explode(F.sequence("ts", "_until")))
    return filled.select(
        *by, F.col("_day").alias("ts"), *[F.when(F.col("_day") == F.col("ts"), F.col(c)).otherwise(0).alias(c) for c in values]
    )


def calendar_features(df: DataFrame, day: str = "ts") -> DataFrame:
    d = F.col(day)
    return (
        df.withColumn("day_of_week", rules.day_of_week(d))
        .withColumn("day_of_month", F.dayofmonth(d))
        .withColumn("month", F.month(d))
        .withColumn("quarter", F.quarter(d))
        .withColumn("season", rules.season(d))
        .withColumn("is_weekend", F.when(rules.day_of_week(d).isin(0, 6), 1).otherwise(0))
    )


def daily_series(requests: DataFrame, issue: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """Gap-free daily series with calendar features."""
    return calendar_features(gap_fill(daily_counts(requests, issue, keys), keys))


def weekly_series(daily: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Monday weeks. Lights are summed per day, so one light on two days counts twice."""
    return daily.groupBy(*(keys or []), rules.week_start(F.col("ts")).alias("week_start")).agg(
        F.sum("total").alias("weekly_total"),
        F.sum("unique_lights_affected").alias("weekly_lights_affected"),
        *[F.sum(c).alias(f"weekly_{c}") for c in ISSUE_COLUMNS],
        F.avg("total").alias("avg_daily"),
        F.max("total").alias("max_daily"),
        F.min("season").alias("season"),
    )


def rolling_features(daily: DataFrame, value: str = "total", keys: list[str] | None = None) -> DataFrame:
    """Trailing means, volatility, running total and lags per series."""
    ordered = Window.partitionBy(*(keys or [])).orderBy("ts")

    def back(days: int):
        return ordered.rowsBetween(-(days - 1), 0)

    v = F.col(value)
    return (
        daily.withColumn("rolling_7d_avg", F.avg(v).over(back(7)))
        .withColumn("rolling_14d_avg", F.avg(v).over(back(14)))
        .withColumn("rolling_30d_avg", F.avg(v).over(back(30)))
        .withColumn("rolling_7d_stddev", F.stddev_samp(v).over(back(7)))
        .withColumn("cumulative", F.sum(v).over(ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
        .withColumn("lag_1d", F.lag(v, 1).over(ordered))
        .withColumn("lag_7d", F.lag(v, 7).over(ordered))
        .withColumn("lag_14d", F.lag(v, 14).over(ordered))
    )


def feature_stats(daily: DataFrame, daily_name: str, weekly_name: str) -> DataFrame:
    """Min, max, mean, deviation and count of the daily values and of their weekly sums.

    Weeks carry the moments of their days, so both rows come from one pass over the series.
    """
    v = F.col("total").cast("decimal(18,0)")
    weeks = daily.groupBy(rules.week_start(F.col("ts")).alias("w")).agg(
        F.min("total").alias("lo"), F.max("total").alias("hi"), F.sum(v).alias("s"), F.sum(v * v).alias("ss"), F.count("*").alias("n")
    )

    def stats(name: str, lo: Column, hi: Column, s1: Column, s2: Column, n: Column) -> Column:
        mean = s1.cast("double") / n
        spread = F.sqrt((s2 - s1 * s1 / n).cast("double") / F.nullif(n - 1, F.lit(0)))
        return F.struct(
            F.lit(name).alias("feature"),
            lo.cast("bigint").alias("min_val"),
            hi.cast("bigint").alias("max_val"),
            rules.round_half_up(mean, 2).alias("avg_val"),
            rules.round_half_up(spread, 2).alias("stddev_val"),
            n.alias("sample_count"),
        )

    s = F.col("s")
    one = weeks.agg(
        stats(daily_name, F.min("lo"), F.max("hi"), F.sum("s"), F.sum("ss"), F.sum("n")).alias("d"),
        stats(weekly_name, F.min("s"), F.max("s"), F.sum("s"), F.sum(s * s), F.count("*")).alias("w"),
    )
    return one.select(F.inline(F.array("d", "w")))


def issue_distribution(requests: DataFrame) -> DataFrame:
    """Share, first and last day and distinct lights per issue type."""
    day = F.to_date("reported_at")
    per_light = (
        requests.where(F.col("reported_at").isNotNull())
        .groupBy("issue_type", "light_id")
        .agg(F.count("*").alias("n"), F.min(day).alias("a"), F.max(day).alias("b"))
    )
    grouped = per_light.groupBy("issue_type").agg(
        F.sum("n").alias("total_count"),
        F.min("a").alias("first_reported"),
        F.max("b").alias("last_reported"),
        F.count("light_id").alias("unique_lights"),
    )
    return grouped.withColumn(
        "percentage", rules.ratio_pct(F.col("total_count"), F.sum("total_count").over(Window.partitionBy()), 2)
    ).orderBy(F.desc("total_count"))


def verification(daily: DataFrame, label: str) -> DataFrame:
    """Length, total and range of a daily series."""
    return daily.agg(
        F.count("*").alias("total_days"), F.sum("total").alias("total_requests"), F.min("ts").alias("start_date"), F.max("ts").alias("end_date")
    ).select(F.lit(label).alias("dataset"), "*")


def weekly_verification(weekly: DataFrame, label: str) -> DataFrame:
    return weekly.agg(
        F.count("*").alias("total_weeks"),
        F.sum("weekly_total").alias("total_requests"),
        rules.round_half_up(F.avg("weekly_total"), 2).alias("avg_weekly"),
    ).select(F.lit(label).alias("dataset"), "*")


def season_distribution(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy("season")
        .agg(F.count("*").alias("days"), F.sum("total").alias("total"), rules.round_half_up(F.avg("total"), 2).alias("avg_daily"))
        .orderBy(F.desc("avg_daily"))
    )


def target_series(requests: DataFrame) -> DataFrame:
    """The two forecast targets, all requests and bulb failures, as one keyed gap-free series.

    Both come from one count per day; each series runs from its own first to its own last day.
    """
    targets = {"all": F.col("total"), "bulb": F.col("bulb_failures")}
    rows = F.array(*[F.struct(F.lit(k).alias("target"), c.alias("total")) for k, c in targets.items()])
    daily = daily_counts(requests).select("ts", F.inline(rows)).where(F.col("total") > 0)
    return gap_fill(daily, ["target"])


def training_series(daily: DataFrame, value: str = "total", keys: list[str] | None = None) -> DataFrame:
    """(keys, ts, y) rows for the forecaster."""
    return daily.where(F.col("ts").isNotNull()).select(*(keys or []), "ts", F.col(value).cast("double").alias("y"))


def training_check(series: DataFrame, label: str) -> DataFrame:
    return series.agg(
        F.count("*").alias("total_records"),
        F.min("ts").alias("start_date"),
        F.max("ts").alias("end_date"),
        F.sum("y").cast("bigint").alias("total"),
        rules.round_half_up(F.avg("y"), 2).alias("avg_daily"),
    ).select(F.lit(label).alias("check_name"), "*")


def day_index(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date"))
