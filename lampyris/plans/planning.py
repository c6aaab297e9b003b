"""Schedules, stock, crews and budgets from the rounded forecast tables.

Inputs are forecast tables (``operators.forecast.forecast_table``): one row per future day, so every
figure here is computed on small data whatever the request volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..operators import forecast as fc
from ..operators import series
from ..sources.fixtures import Tables

# Prices per unit and per job
BULB_PRICE, KIT_PRICE, POLE_PRICE = 1000, 2000, 15000
LABOR, TRANSPORT, OVERHEAD = 500, 150, 100
JOB_FLAT, JOB_FLAT_WEEKLY = 1750, 1650
BULB_STAFF = ("Full crew (3+ technicians)", "Standard crew (2 technicians)", "Minimal crew (1 technician)")
ALL_STAFF = ("Full crew + backup (4+ technicians)", "Full crew (3 technicians)", "Standard crew (2 technicians)")
# Notes of the daily briefing
SEASON_NOTES = {"monsoon": "Monsoon season - expect weather delays", "summer": "Summer heat - schedule early morning/evening"}
OTHER_NOTE = "Favorable conditions"
# Short day names from Sunday on
DAY_NAMES = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]


def bulb_daily(t: Tables) -> DataFrame:
    return series.daily_series(t.requests, "bulb_failure")


def all_daily(t: Tables) -> DataFrame:
    return series.daily_series(t.requests)


def bulb_forecast(t: Tables, periods: int) -> DataFrame:
    return fc.forecast_table(fc.forecast_series(series.training_series(bulb_daily(t)), periods))


def all_forecast(t: Tables, periods: int) -> DataFrame:
    return fc.forecast_table(fc.forecast_series(series.training_series(all_daily(t)), periods))


def _ceil(value: Column) -> Column:
    return F.ceil(value).cast("bigint")


def forecast_30d(table: DataFrame, name: str) -> DataFrame:
    return table.select(
        "forecast_date", F.col("predicted").alias(name), "lower_bound", "upper_bound",
        F.col("predicted_precise").alias(f"{name}_precise"), "day_of_week", "season", "prediction_range",
    ).orderBy("forecast_date")


def forecast_90d(table: DataFrame, name: str) -> DataFrame:
    return table.select(
        "forecast_date", F.col("predicted").alias(name), "lower_bound", "upper_bound", "week_start", "month_start", "season"
    ).orderBy("forecast_date")


def bulb_schedule(table: DataFrame) -> DataFrame:
    n = F.col("predicted")
    return table.select(
        "forecast_date", n.alias("predicted_failures"), "lower_bound", "upper_bound", "season", "day_of_week",
        rules.tier(n, 5, 3).alias("priority"),
        rules.tier(n, 5, 3, BULB_STAFF).alias("staffing_recommendation"),
        _ceil(F.col("upper_bound") * 1.2).alias("bulbs_to_stock"),
        F.weekofyear("forecast_date").alias("week_number"),
        F.col("prediction_range").alias("uncertainty_range"),
    )


def maintenance_schedule(table: DataFrame) -> DataFrame:
    n = F.col("predicted")
    return table.select(
        "forecast_date", n.alias("predicted_requests"), "lower_bound", "upper_bound", "season", "day_of_week",
        rules.tier(n, 8, 5).alias("workload_level"),
        rules.tier(n, 8, 5, ALL_STAFF).alias("staffing_recommendation"),
        _ceil(n * 0.5 * 1.2).alias("bulbs_to_stock"),
        _ceil(n * 0.2 * 1.2).alias("wiring_kits_to_stock"),
        _ceil(n * 0.1 * 1.2).alias("poles_to_stock"),
        F.weekofyear("forecast_date").alias("week_number"),
        F.col("prediction_range").alias("uncertainty_range"),
    )


def weekly_forecast(table: DataFrame, noun: str) -> DataFrame:
    return (
        table.groupBy("week_start")
        .agg(
            F.sum("predicted").alias(f"total_predicted_{noun}"),
            F.sum("lower_bound").alias("total_lower_bound"),
            F.sum("upper_bound").alias("total_upper_bound"),
            rules.round_half_up(F.avg("predicted"), 1).alias(f"avg_daily_{noun}"),
            F.max("predicted").alias(f"peak_day_{noun}"),
            F.min("season").alias("primary_season"),
        )
        .orderBy("week_start")
    )


def both_forecasts(t: Tables, periods: int) -> DataFrame:
    """Forecast tables of both targets (column ``target``) from one pass over the requests."""
    rows = fc.forecast_series(series.training_series(series.target_series(t.requests), keys=["target"]), periods, keys=["target"])
    return fc.forecast_table(rows, ["target"])


def forecast_comparison(both: DataFrame) -> DataFrame:
    """Bulb failures against all requests on days forecast for both."""

    def of(target: str) -> Column:
        return F.max(F.when(F.col("target") == target, F.col("predicted")))

    return (
        both.groupBy("forecast_date", "season")
        .agg(of("bulb").alias("bulb_failures"), of("all").alias("all_issues"))
        .where(F.col("bulb_failures").isNotNull() & F.col("all_issues").isNotNull())
        .select(
            "forecast_date", "bulb_failures", "all_issues",
            (F.col("all_issues") - F.col("bulb_failures")).alias("other_issues"),
            rules.ratio_pct(F.col("bulb_failures"), F.col("all_issues"), 1).alias("bulb_percentage"),
            "season",
            rules.tier(F.col("all_issues"), 8, 5).alias("overall_workload"),
        )
        .orderBy("forecast_date")
    )


def model_summary(t: Tables, periods: int = 30) -> DataFrame:
    models = fc.fit_forecast(series.training_series(series.target_series(t.requests), keys=["target"]), ["target"])
    rows = fc.forecast(models, periods, keys=["target", "days"])
    label = F.when(F.col("target") == "bulb", F.lit("Bulb Failure Forecast")).otherwise(F.lit("All Issues Forecast"))
    return (
        fc.forecast_table(rows, ["target", "days"])
        .groupBy(label.alias("model"), F.col("days").alias("training_days"))
        .agg(F.count("*").alias("forecast_30d_days"), F.sum("predicted").alias("total_30d_predicted"))
    )


def next_7_days(schedule: DataFrame, as_of: rules.AsOf = None) -> DataFrame:
    """Up to a week ahead; earlier forecast rows are not cut off."""
    span = F.concat(F.col("lower_bound").cast("string"), F.lit(" - "), F.col("upper_bound").cast("string"))
    return (
        schedule.where(F.col("forecast_date") <= F.date_add(rules.as_of_date(as_of), 7))
        .select("forecast_date", "predicted_failures", span.alias("range"), "priority", "staffing_recommendation", "bulbs_to_stock")
        .orderBy("forecast_date")
    )


def today_briefing(schedule: DataFrame, as_of: rules.AsOf = None) -> DataFrame:
    note = F.lit(OTHER_NOTE)
    for season, text in SEASON_NOTES.items():
        note = F.when(F.col("season") == season, F.lit(text)).otherwise(note)
    return schedule.where(F.col("forecast_date") == rules.as_of_date(as_of)).select(
        F.col("forecast_date").alias("today"),
        F.col("predicted_failures").alias("expected_failures"),
        "staffing_recommendation",
        F.col("bulbs_to_stock").alias("bulbs_needed"),
        "priority",
        note.alias("weather_note"),
    )


def high_volume_alert(schedule: DataFrame) -> DataFrame:
    crews = rules.tier(F.col("predicted_failures"), 5, 3, ("3+ crews", "2 crews", "1 crew"))
    action = F.concat(
        F.lit("Deploy "), crews, F.lit(", stock "), _ceil(F.col("upper_bound") * 1.5).cast("string"), F.lit(" bulbs")
    )
    return (
        schedule.where(F.col("priority").isin("HIGH", "MEDIUM"))
        .select("forecast_date", "predicted_failures", F.col("upper_bound").alias("worst_case"), "season", action.alias("action_required"))
        .orderBy("forecast_date")
    )


def weekly_inventory_budget(weekly: DataFrame, weeks: int = 12) -> DataFrame:
    jobs = F.col("total_predicted_failures")
    bulbs = _ceil(F.col("total_upper_bound") * 1.2)
    return (
        weekly.orderBy("week_start")
        .limit(weeks)
        .select(
            "week_start",
            jobs.alias("predicted_bulb_failures"),
            F.col("total_upper_bound").alias("worst_case_estimate"),
            bulbs.alias("bulbs_to_order"),
            "primary_season",
            (bulbs * BULB_PRICE).alias("material_cost_inr"),
            (jobs * LABOR).alias("labor_cost_inr"),
            (jobs * TRANSPORT).alias("transport_cost_inr"),
            (bulbs * BULB_PRICE + jobs * (LABOR + TRANSPORT)).alias("total_weekly_budget_inr"),
        )
    )


def crew_schedule(schedule: DataFrame, as_of: rules.AsOf = None) -> DataFrame:
    today = rules.as_of_date(as_of)
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return (
        schedule.where(F.col("forecast_date").between(today, F.date_add(today, 7)))
        .select(
            "forecast_date",
            F.element_at(names, F.dayofweek("forecast_date")).alias("day"),
            "predicted_failures",
            "priority",
            rules.tier(F.col("predicted_failures"), 5, 3, ("Crew A + Crew B + Crew C", "Crew A + Crew B", "Crew A")).alias("assigned_crews"),
            (F.col("predicted_failures") * F.lit(1.5)).alias("estimated_work_hours"),
        )
        .orderBy("forecast_date")
    )


def monthly_forecast(table90: DataFrame) -> DataFrame:
    return (
        table90.groupBy(F.col("month_start").alias("month"))
        .agg(
            F.sum("predicted").alias("total_predicted_failures"),
            rules.round_half_up(F.avg("predicted"), 1).alias("avg_daily_failures"),
            F.max("predicted").alias("peak_day"),
            _ceil(F.sum("upper_bound") * 1.2).alias("bulbs_to_stock"),
        )
        .orderBy("month")
    )


def seasonal_risk(table90: DataFrame) -> DataFrame:
    mean = F.avg("predicted")
    risk = F.when(mean > 3, F.lit("HIGH RISK")).when(mean > 2, F.lit("MEDIUM RISK")).otherwise(F.lit("LOW RISK"))
    return (
        table90.groupBy("season")
        .agg(
            F.count("*").alias("forecast_days"),
            F.sum("predicted").alias("total_failures"),
            rules.round_half_up(mean, 2).alias("avg_daily_failures"),
            F.max("predicted").alias("peak_day_failures"),
            risk.alias("seasonal_risk"),
        )
        .orderBy(F.desc("avg_daily_failures"))
    )


def monthly_budget(table90: DataFrame) -> DataFrame:
    costs = table90.groupBy(F.col("month_start").alias("month")).agg(
        F.sum("predicted").alias("jobs"), _ceil(F.sum("upper_bound") * 1.2).alias("bulbs_needed")
    )
    bulbs, jobs = F.col("bulbs_needed"), F.col("jobs")
    return costs.select(
        "month", "jobs", "bulbs_needed",
        (bulbs * BULB_PRICE).alias("material_cost_inr"),
        (jobs * LABOR).alias("labor_cost_inr"),
        (jobs * TRANSPORT).alias("transport_cost_inr"),
        (jobs * OVERHEAD).alias("overhead_cost_inr"),
        (bulbs * BULB_PRICE + jobs * (LABOR + TRANSPORT + OVERHEAD)).alias("total_monthly_budget_inr"),
    ).orderBy("month")


def monthly_budget_all(schedule: DataFrame) -> DataFrame:
    costs = schedule.groupBy(rules.month_start(F.col("forecast_date")).alias("month")).agg(
        F.sum("predicted_requests").alias("total_jobs"),
        F.sum("bulbs_to_stock").alias("bulbs_needed"),
        F.sum("wiring_kits_to_stock").alias("wiring_kits_needed"),
        F.sum("poles_to_stock").alias("poles_needed"),
    )
    parts = F.col("bulbs_needed") * BULB_PRICE + F.col("wiring_kits_needed") * KIT_PRICE + F.col("poles_needed") * POLE_PRICE
    return costs.select(
        "*",
        (F.col("bulbs_needed") * BULB_PRICE).alias("bulb_cost_inr"),
        (F.col("wiring_kits_needed") * KIT_PRICE).alias("wiring_cost_inr"),
        (F.col("poles_needed") * POLE_PRICE).alias("pole_cost_inr"),
        (F.col("total_jobs") * LABOR).alias("labor_cost_inr"),
        (F.col("total_jobs") * TRANSPORT).alias("transport_cost_inr"),
        (parts + F.col("total_jobs") * (LABOR + TRANSPORT)).alias("total_monthly_budget_inr"),
    ).orderBy("month")


def _metric_rows(one_row: DataFrame, metrics: list[tuple[str, str, str]]) -> DataFrame:
    rows = [
        F.struct(F.lit(m).alias("metric"), F.col(c).cast("string").alias("value"), F.lit(d).alias("description"))
        for m, c, d in metrics
    ]
    return one_row.select(F.inline(F.array(*rows)))


def forecast_metrics(schedule: DataFrame, as_of: rules.AsOf = None) -> DataFrame:
    """Four dashboard figures as text, from one pass over the schedule."""
    week = F.col("forecast_date") <= F.date_add(rules.as_of_date(as_of), 7)
    one = schedule.agg(
        F.sum(F.when(week, F.col("predicted_failures"))).alias("a"),
        F.sum("predicted_failures").alias("b"),
        F.count_if(F.col("priority") == "HIGH").alias("c"),
        F.sum("bulbs_to_stock").alias("d"),
    )
    return _metric_rows(
        one,
        [
            ("FORECAST_NEXT_7_DAYS", "a", "Expected bulb failures in next 7 days"),
            ("FORECAST_NEXT_30_DAYS", "b", "Expected bulb failures in next 30 days"),
            ("HIGH_PRIORITY_DAYS", "c", "Days requiring extra staffing (next 30 days)"),
            ("BULBS_TO_ORDER_30D", "d", "Recommended bulb inventory for next 30 days"),
        ],
    )


def workload_metrics(schedule: DataFrame, as_of: rules.AsOf = None) -> DataFrame:
    week = F.col("forecast_date") <= F.date_add(rules.as_of_date(as_of), 7)
    one = schedule.agg(
        F.sum(F.when(week, F.col("predicted_requests"))).alias("a"),
        F.sum("predicted_requests").alias("b"),
        F.count_if(F.col("workload_level") == "HIGH").alias("c"),
        (F.sum("bulbs_to_stock") + F.sum("wiring_kits_to_stock") + F.sum("poles_to_stock")).alias("d"),
    )
    return _metric_rows(
        one,
        [
            ("TOTAL_REQUESTS_NEXT_7_DAYS", "a", "Expected total maintenance requests in next 7 days"),
            ("TOTAL_REQUESTS_NEXT_30_DAYS", "b", "Expected total maintenance requests in next 30 days"),
            ("HIGH_WORKLOAD_DAYS", "c", "Days with high workload (next 30 days)"),
            ("TOTAL_PARTS_NEEDED", "d", "Total parts to stock for next 30 days"),
        ],
    )


def flat_cost_by_month(table90: DataFrame) -> DataFrame:
    return (
        table90.groupBy(F.col("month_start").alias("month"))
        .agg(F.sum("predicted").alias("failures"), (F.sum("predicted") * JOB_FLAT).alias("estimated_cost_inr"))
        .orderBy("month")
    )


def flat_cost_by_week(schedule: DataFrame) -> DataFrame:
    return (
        schedule.groupBy(rules.week_start(F.col("forecast_date")).alias("week_start"))
        .agg(
            F.sum("predicted_failures").alias("total_failures"),
            (F.sum("predicted_failures") * JOB_FLAT_WEEKLY).alias("total_budget_inr"),
        )
        .orderBy("week_start")
    )


def season_totals(table: DataFrame) -> DataFrame:
    return (
        table.groupBy("season")
        .agg(F.sum("predicted").alias("total_failures"), rules.round_half_up(F.avg("predicted"), 1).alias("avg_daily"))
        .orderBy(F.desc("total_failures"))
    )


def forecast_filter(schedule: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Keep the listed priorities or workload levels; an empty list keeps everything."""
    return schedule.where(F.col(column).isin(values)) if values else schedule
