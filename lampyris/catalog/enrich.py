"""Registered enrichment joins (JN family) and calendar rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules
from ..operators import enrich
from ..sources.fixtures import AS_OF
from .base import query, rnd, season_sql

_DECIMALS = ["avg_temperature_c", "rainfall_mm", "failure_risk_score", "avg_load_percent"]


def _plain(df):
    for c in _DECIMALS:
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast("double"))
    return df


_LIGHT_COLS = (
    "light_id, lon, lat, status, wattage, installation_date, last_maintenance, neighborhood_id, created_at, updated_at, "
    "neighborhood_name, population, season, population_density, urban_classification, grid_zone, outage_history_count, "
    "age_months, days_since_maintenance, maintenance_urgency, predicted_failure_date"
)
_DOUBLES = ", ".join(f"cast({c} as double) as {c}" for c in _DECIMALS)
query(
    "lights_enriched",
    f"""select {_LIGHT_COLS}, {_DOUBLES}, cast(date '{AS_OF}' - cast(last_maintenance as date) as int) as days_since_maintenance_total
    from lights_enriched""",
)(
    lambda t: _plain(enrich.lights_enriched(t, AS_OF)).select(
        *_LIGHT_COLS.split(", "), *_DECIMALS, "days_since_maintenance_total"
    )
)
_FIXED = "light_id, status, lon, lat, neighborhood_name, population, season, predicted_failure_date, population_density, urban_classification, grid_zone"
query(
    "lights_enriched_fixed_season",
    """select l.light_id, l.status, l.lon, l.lat, n.name as neighborhood_name, n.population, w.season, w.predicted_failure_date,
    d.population_density, d.urban_classification, p.grid_zone, cast(w.failure_risk_score as double) as failure_risk_score,
    cast(p.avg_load_percent as double) as avg_load_percent
    from lights l left join zones n on l.neighborhood_id = n.neighborhood_id
    left join weather w on l.light_id = w.light_id and w.season = 'summer'
    left join demographics d on n.neighborhood_id = d.neighborhood_id left join power_grid p on l.light_id = p.light_id""",
)(
    lambda t: _plain(enrich.lights_enriched(t, AS_OF, season="summer")).select(
        *_FIXED.split(", "), "failure_risk_score", "avg_load_percent"
    )
)
query(
    "season_of_today_join",
    f"""select l.light_id, w.season, cast(w.failure_risk_score as double) as failure_risk_score from lights l left join weather w
    on l.light_id = w.light_id and w.season = {season_sql(f"month(date '{AS_OF}')")}""",
)(lambda t: _plain(enrich.lights_enriched(t, AS_OF)).select("light_id", "season", "failure_risk_score"))
_REQ = (
    "request_id, light_id, reported_at, resolved_at, issue_type, description, created_at, lon, lat, wattage, neighborhood_id, "
    "neighborhood_name, population, season, status"
)
query(
    "requests_enriched",
    f"""select {_REQ}, cast(failure_risk_score as double) as failure_risk_score, cast(avg_temperature_c as double) as avg_temperature_c,
    cast(rainfall_mm as double) as rainfall_mm, {rnd('resolution_hours', 6)} as resolution_hours from requests_enriched""",
)(
    lambda t: _plain(enrich.requests_enriched(t)).select(
        *_REQ.split(", "), "failure_risk_score", "avg_temperature_c", "rainfall_mm",
        rules.round_half_up(F.col("resolution_hours"), 6).alias("resolution_hours"),
    )
)
query("maintenance_searchable", "select * from searchable")(enrich.maintenance_searchable)
query(
    "spine_left_join",
    "select ts, unique_lights_affected, total from bulb_series",
)(lambda t: _spine(t))


def _spine(t):
    """The calendar joined with the daily counts, as an explicit left join."""
    from ..operators import series

    daily = series.daily_counts(t.requests, "bulb_failure").select("ts", "total", "unique_lights_affected")
    return series.date_spine(daily).join(daily, "ts", "left").na.fill(0, ["total", "unique_lights_affected"])


query(
    "rule_season",
    f"select request_id, {season_sql('month(reported_at)')} as season from requests",
)(lambda t: t.requests.select("request_id", rules.season(F.to_date("reported_at")).alias("season")))
query(
    "rule_urgency",
    f"""select light_id, season, case when predicted_failure_date <= date '{AS_OF}' + 7 then 'CRITICAL'
    when predicted_failure_date <= date '{AS_OF}' + 30 then 'HIGH' when predicted_failure_date <= date '{AS_OF}' + 90 then 'MEDIUM'
    else 'LOW' end as maintenance_urgency from weather""",
)(
    lambda t: t.weather.select(
        "light_id", "season", rules.urgency(F.col("predicted_failure_date"), AS_OF).alias("maintenance_urgency")
    )
)


@query(
    "rule_age",
    """select request_id, cast(date_part('year', age(cast(resolved_at as date), cast(installation_date as date)))*12 +
    date_part('month', age(cast(resolved_at as date), cast(installation_date as date))) as int) as age_months,
    cast(date_part('day', age(cast(cast(resolved_at as date) + 100 as timestamp), reported_at)) as int) as day_part
    from requests r join lights l on l.light_id = r.light_id where resolved_at is not null and resolved_at >= installation_date""",
)
def rule_age(t):
    """Ages at every repair date: many month ends and clock times."""
    rows = t.requests.join(t.lights.select("light_id", "installation_date"), "light_id").where(
        F.col("resolved_at") >= F.col("installation_date")
    )
    done = F.to_date("resolved_at")
    return rows.select(
        "request_id",
        rules.age_months(F.col("installation_date"), done).alias("age_months"),
        rules.age_day_part(F.col("reported_at"), F.date_add(done, 100)).alias("day_part"),
    )


query(
    "rule_hours_crossed",
    f"""select request_id, datediff('hour', reported_at, resolved_at) as hours_crossed,
    {rnd('epoch(resolved_at - reported_at)/3600.0', 4)} as elapsed_hours from requests""",
)(
    lambda t: t.requests.select(
        "request_id",
        rules.hours_crossed(F.col("reported_at"), F.col("resolved_at")).alias("hours_crossed"),
        rules.round_half_up(rules.elapsed_hours(F.col("reported_at"), F.col("resolved_at")), 4).alias("elapsed_hours"),
    )
)


@query(
    "rule_week_fields",
    """select request_id, cast(dayofweek(reported_at) as int) as day_of_week, cast(date_trunc('week', reported_at) as date) as week_start,
    cast(weekofyear(reported_at) as int) as iso_week, cast(quarter(reported_at) as int) as quarter,
    cast(date_trunc('month', reported_at) as date) as month_start from requests""",
)
def rule_week_fields(t):
    day = F.to_date("reported_at")
    return t.requests.select(
        "request_id",
        rules.day_of_week(day).alias("day_of_week"),
        rules.week_start(day).alias("week_start"),
        F.weekofyear(day).alias("iso_week"),
        F.quarter(day).alias("quarter"),
        rules.month_start(day).alias("month_start"),
    )


query(
    "rule_urban_class",
    """select neighborhood_id, case when population_density > 15000 then 'urban' when population_density > 5000 then 'suburban'
    else 'rural' end as urban_classification from demographics""",
)(lambda t: t.demographics.select("neighborhood_id", rules.urban_class(F.col("population_density")).alias("urban_classification")))
query(
    "rule_status_color",
    """select status, case status when 'operational' then '#2ecc71' when 'maintenance_required' then '#f39c12' else '#e74c3c' end as color,
    count(*) as n from lights group by 1""",
)(lambda t: _palette(t))


def _palette(t):
    from ..plans.dashboard import status_palette

    return status_palette(t)
