"""Registered time-series operators (TS family)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules
from ..operators import series
from ..plans import planning as pl
from .base import query, rnd

_COUNTS = "total, unique_lights_affected, bulb_failures, wiring_issues, pole_damage, power_supply, sensor_failures"


def _daily_sql(where: str, extra: str = "") -> str:
    return f"""select cast(reported_at as date) as ts, count(*) as total, count(distinct light_id) as unique_lights_affected{extra}
    from requests where {where} group by 1"""


_PIVOT = "".join(
    f", count(case when issue_type = '{v}' then 1 end) as {k}" for k, v in series.ISSUE_COLUMNS.items()
)

query("daily_counts", _daily_sql("issue_type = 'bulb_failure'"))(
    lambda t: series.daily_counts(t.requests, "bulb_failure").select("ts", "total", "unique_lights_affected")
)
query("daily_issue_pivot", _daily_sql("reported_at is not null", _PIVOT))(lambda t: series.daily_counts(t.requests))


@query(
    "daily_counts_by_zone",
    """select l.neighborhood_id, cast(r.reported_at as date) as ts, count(*) as total, count(distinct r.light_id) as unique_lights_affected
    from requests r join lights l on r.light_id = l.light_id where l.neighborhood_id is not null group by 1, 2""",
)
def daily_counts_by_zone(t):
    rows = t.requests.join(t.lights.select("light_id", "neighborhood_id"), "light_id").where("neighborhood_id is not null")
    return series.daily_counts(rows, keys=["neighborhood_id"]).select("neighborhood_id", "ts", "total", "unique_lights_affected")


query("date_spine", "select ts from all_series")(lambda t: series.date_spine(series.daily_counts(t.requests)))
query("gap_fill", f"select ts, {_COUNTS} from bulb_series")(
    lambda t: series.gap_fill(series.daily_counts(t.requests, "bulb_failure"))
)


@query(
    "gap_fill_events",
    """with c as (select event_type, cast(ts as date) as d, count(*) as n from events group by 1, 2)
    select s.event_type, s.ts, coalesce(c.n, 0) as total from (select event_type, cast(unnest(generate_series(min(d), max(d), interval 1 day)) as date) as ts
    from c group by 1) s left join c on c.event_type = s.event_type and c.d = s.ts""",
)
def gap_fill_events(t):
    """Several series at once: events per type and day."""
    daily = t.raw("events").groupBy("event_type", F.to_date("ts").alias("ts")).agg(F.count("*").alias("total"))
    return series.gap_fill(daily, ["event_type"])


_FEATURES = "day_of_week, day_of_month, month, quarter, season, is_weekend"
query("calendar_features", f"select ts, {_FEATURES} from all_series")(
    lambda t: pl.all_daily(t).select("ts", *_FEATURES.split(", "))
)
query("bulb_failure_timeseries", f"select ts, total, unique_lights_affected, {_FEATURES} from bulb_series")(
    lambda t: pl.bulb_daily(t).select("ts", "total", "unique_lights_affected", *_FEATURES.split(", "))
)
query("all_issues_timeseries", "select * from all_series")(pl.all_daily)


def _weekly(df):
    return df.withColumn("avg_daily", rules.round_half_up(F.col("avg_daily"), 6))


_WEEKLY = "week_start, weekly_total, weekly_lights_affected, avg_daily, max_daily, season"
query("weekly_failures", f"select {_WEEKLY} from bulb_weekly")(
    lambda t: _weekly(series.weekly_series(pl.bulb_daily(t))).select(*_WEEKLY.split(", "))
)
query("weekly_issues", "select * from all_weekly")(lambda t: _weekly(series.weekly_series(pl.all_daily(t))))


def _rolling_sql(table: str, part: str = "") -> str:
    over = f"({part} order by ts rows between {{n}} preceding and current row)"
    lag = f"over ({part} order by ts)"
    return f"""{rnd("avg(total) over " + over.format(n=6), 6)} as rolling_7d_avg, {rnd("avg(total) over " + over.format(n=13), 6)} as rolling_14d_avg,
    {rnd("avg(total) over " + over.format(n=29), 6)} as rolling_30d_avg, {rnd("stddev_samp(total) over " + over.format(n=6), 6)} as rolling_7d_stddev,
    cast(sum(total) over ({part} order by ts) as bigint) as cumulative, lag(total, 1) {lag} as lag_1d, lag(total, 7) {lag} as lag_7d,
    lag(total, 14) {lag} as lag_14d from {table}"""


def _rounded(df):
    for name in ("rolling_7d_avg", "rolling_14d_avg", "rolling_30d_avg", "rolling_7d_stddev"):
        df = df.withColumn(name, rules.round_half_up(F.col(name), 6))
    return df


_ROLL = ["rolling_7d_avg", "rolling_14d_avg", "rolling_30d_avg", "rolling_7d_stddev", "cumulative", "lag_1d", "lag_7d", "lag_14d"]
query(
    "rolling_features",
    f"select ts, total, unique_lights_affected, day_of_week, month, season, is_weekend, {_rolling_sql('bulb_series')}",
)(
    lambda t: _rounded(series.rolling_features(pl.bulb_daily(t))).select(
        "ts", "total", "unique_lights_affected", "day_of_week", "month", "season", "is_weekend", *_ROLL
    )
)


@query(
    "rolling_features_by_zone",
    f"""with c as (select l.neighborhood_id as z, cast(r.reported_at as date) as d, count(*) as n from requests r join lights l
    on r.light_id = l.light_id where l.neighborhood_id is not null group by 1, 2),
    s as (select z, cast(unnest(generate_series(min(d), max(d), interval 1 day)) as date) as ts from c group by 1),
    f as (select s.z, s.ts, coalesce(c.n, 0) as total from s left join c on c.z = s.z and c.d = s.ts)
    select z as neighborhood_id, ts, total, {_rolling_sql('f', 'partition by z')}""",
)
def rolling_features_by_zone(t):
    rows = t.requests.join(t.lights.select("light_id", "neighborhood_id"), "light_id").where("neighborhood_id is not null")
    daily = series.gap_fill(series.daily_counts(rows, keys=["neighborhood_id"]), ["neighborhood_id"])
    return _rounded(series.rolling_features(daily, keys=["neighborhood_id"])).select("neighborhood_id", "ts", "total", *_ROLL)


def _stats_sql(series_name: str, weekly_name: str, daily: str, weekly: str) -> str:
    def part(name, table, col):
        return f"""select '{name}' as feature, cast(min({col}) as bigint) as min_val, cast(max({col}) as bigint) as max_val,
        {rnd(f"avg({col})", 2)} as avg_val, {rnd(f"stddev_samp({col})", 2)} as stddev_val, count(*) as sample_count from {table}"""

    return part(series_name, daily, "total") + " union all " + part(weekly_name, weekly, "weekly_total")


query("feature_stats", _stats_sql("BULB_FAILURE_DAILY", "WEEKLY_BULB_FAILURES", "bulb_series", "bulb_weekly"))(
    lambda t: series.feature_stats(pl.bulb_daily(t), "BULB_FAILURE_DAILY", "WEEKLY_BULB_FAILURES")
)
query("feature_stats_all", _stats_sql("ALL_ISSUES_DAILY", "ALL_ISSUES_WEEKLY", "all_series", "all_weekly"))(
    lambda t: series.feature_stats(pl.all_daily(t), "ALL_ISSUES_DAILY", "ALL_ISSUES_WEEKLY")
)
query(
    "issue_distribution",
    f"""select issue_type, count(*) as total_count, {rnd("count(*)*100.0/sum(count(*)) over ()", 2)} as percentage,
    cast(min(reported_at) as date) as first_reported, cast(max(reported_at) as date) as last_reported,
    count(distinct light_id) as unique_lights from requests where reported_at is not null group by 1""",
)(lambda t: series.issue_distribution(t.requests))


def _verify_sql(table: str, label: str) -> str:
    return f"""select '{label}' as dataset, count(*) as total_days, cast(sum(total) as bigint) as total_requests,
    min(ts) as start_date, max(ts) as end_date from {table}"""


query("series_verification", _verify_sql("bulb_series", "Bulb Failure Time Series"))(
    lambda t: series.verification(pl.bulb_daily(t), "Bulb Failure Time Series")
)
query("series_verification_all", _verify_sql("all_series", "All Issues Time Series"))(
    lambda t: series.verification(pl.all_daily(t), "All Issues Time Series")
)
query(
    "series_verification_weekly",
    f"""select 'Weekly All Issues' as dataset, count(*) as total_weeks, cast(sum(weekly_total) as bigint) as total_requests,
    {rnd("avg(weekly_total)", 2)} as avg_weekly from all_weekly""",
)(lambda t: series.weekly_verification(series.weekly_series(pl.all_daily(t)), "Weekly All Issues"))


def _season_sql(table: str) -> str:
    return f"""select season, count(*) as days, cast(sum(total) as bigint) as total, {rnd("avg(total)", 2)} as avg_daily
    from {table} group by 1"""


query("season_distribution", _season_sql("bulb_series"))(lambda t: series.season_distribution(pl.bulb_daily(t)))
query("season_distribution_all", _season_sql("all_series"))(lambda t: series.season_distribution(pl.all_daily(t)))
