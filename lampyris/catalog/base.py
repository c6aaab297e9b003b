"""Registry of runnable queries, each with an independent SQL check where SQL can express it."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare
from ..sources import fixtures as fx
from ..sources.fixtures import Tables, scan_tables

A_EARTH = 6378137.0
FLATTENING = "(1/2.98257223563e2)"


@dataclass(frozen=True)
class Entry:
    key: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``key`` with its optional check SQL."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, path: str) -> DataFrame:
            return fn(scan_tables(prepare(spark), path))

        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Entry(key, run, with_ctes(sql) if sql else None)
        return fn

    return wrap


# --------------------------------------------------------------------------------------------
# Building blocks of the check SQL (DuckDB dialect). Written apart from the Spark operators.
# --------------------------------------------------------------------------------------------


def _domain_cte(name: str) -> str:
    source, key, columns, where = fx.PROJECTIONS[name]
    cols = ", ".join(f"{expr} as {col}" for col, expr in columns).replace("timestamp_ntz", "timestamp")
    cross = " cross join (values (0),(1),(2)) as seasons(s)" if name == "weather" else ""
    cond = f" where {where}" if where else ""
    return f"select {cols} from (select *, cast({key} as bigint) as k from {source}){cross}{cond}"


def season_sql(month: str) -> str:
    return (
        f"(case when {month} between 6 and 9 then 'monsoon' when {month} between 3 and 5 then 'summer'"
        " else 'winter' end)"
    )


def lambert_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """Geodesic metres (Lambert's long-line formula on WGS84)."""
    b1 = f"atan((1-{FLATTENING})*tan(radians({lat1})))"
    b2 = f"atan((1-{FLATTENING})*tan(radians({lat2})))"
    h = (
        f"(power(sin(({b2}-{b1})/2),2) + cos({b1})*cos({b2})*power(sin(radians({lon2}-({lon1}))/2),2))"
    )
    s = f"greatest(2*asin(sqrt({h})), 1e-15)"
    p, q = f"(({b1}+{b2})/2)", f"(({b2}-{b1})/2)"
    x = f"(({s})-sin({s}))*power(sin({p}),2)*power(cos({q}),2)/power(cos(({s})/2),2)"
    y = f"(({s})+sin({s}))*power(cos({p}),2)*power(sin({q}),2)/power(sin(({s})/2),2)"
    return f"({A_EARTH}*(({s}) - {FLATTENING}/2*({x}+{y})))"


def rnd(expr: str, digits: int) -> str:
    return f"cast(round(cast({expr} as decimal(28,9)), {digits}) as double)"


_OUTLINE = ", ".join(f"({i}, {dx}, {dy})" for i, (dx, dy) in enumerate(fx.ZONE_OUTLINE))

CTES: dict[str, str] = {name: _domain_cte(name) for name in fx.PROJECTIONS}
CTES.update(
    {
        "zone_points": (
            "select neighborhood_id, name, population, i, x0 + dx as x, y0 + dy as y "
            f"from zones cross join (values {_OUTLINE}) as o(i, dx, dy)"
        ),
        "zone_edges": (
            "select a.neighborhood_id, a.i, a.x as x1, a.y as y1, b.x as x2, b.y as y2 from zone_points a "
            "join zone_points b on a.neighborhood_id = b.neighborhood_id and b.i = a.i + 1"
        ),
        # light x zone pairs with the point strictly inside (even-odd rule)
        "inside": (
            "select l.light_id, e.neighborhood_id as zone_id from lights l cross join zone_edges e "
            "group by l.light_id, e.neighborhood_id "
            "having sum(case when (e.y1 > l.lat) <> (e.y2 > l.lat) and "
            "l.lon < (e.x2-e.x1)*(l.lat-e.y1)/nullif(e.y2-e.y1,0)+e.x1 then 1 else 0 end) % 2 = 1 "
            "and sum(case when (e.x2-e.x1)*(l.lat-e.y1)-(e.y2-e.y1)*(l.lon-e.x1) = 0 and l.lon between "
            "least(e.x1,e.x2) and greatest(e.x1,e.x2) and l.lat between least(e.y1,e.y2) and "
            "greatest(e.y1,e.y2) then 1 else 0 end) = 0"
        ),
        "pairs": (
            "select l.light_id, l.status, s.supplier_id, s.name, s.specialization, s.service_radius_km, "
            "s.contact_phone, s.avg_response_hours, "
            "(l.lon-s.lon)*(l.lon-s.lon)+(l.lat-s.lat)*(l.lat-s.lat) as deg2, "
            f"{lambert_sql('l.lon', 'l.lat', 's.lon', 's.lat')} as meters from lights l cross join suppliers s"
        ),
        "nearest_planar": (
            "select * from (select *, row_number() over (partition by light_id order by deg2, supplier_id) as rn "
            "from pairs) where rn = 1"
        ),
        "nearest_geodesic": (
            "select * from (select *, row_number() over (partition by light_id order by meters, supplier_id) as rn "
            "from pairs) where rn = 1"
        ),
        "lights_enriched": (
            "select l.*, n.name as neighborhood_name, n.population, w.season, w.avg_temperature_c, "
            "w.rainfall_mm, w.failure_risk_score, w.predicted_failure_date, d.population_density, "
            "d.urban_classification, p.grid_zone, p.avg_load_percent, p.outage_history_count, "
            f"cast(date_part('year', age(timestamp '{fx.AS_OF} 00:00:00', cast(l.installation_date as timestamp)))*12 + "
            f"date_part('month', age(timestamp '{fx.AS_OF} 00:00:00', cast(l.installation_date as timestamp))) as int) as age_months, "
            f"cast(date_part('day', age(timestamp '{fx.AS_OF} 00:00:00', l.last_maintenance)) as int) as days_since_maintenance, "
            f"case when w.predicted_failure_date <= date '{fx.AS_OF}' + 7 then 'CRITICAL' "
            f"when w.predicted_failure_date <= date '{fx.AS_OF}' + 30 then 'HIGH' "
            f"when w.predicted_failure_date <= date '{fx.AS_OF}' + 90 then 'MEDIUM' else 'LOW' end as maintenance_urgency "
            "from lights l left join zones n on l.neighborhood_id = n.neighborhood_id "
            "left join weather w on l.light_id = w.light_id and w.season = 'monsoon' "
            "left join demographics d on n.neighborhood_id = d.neighborhood_id "
            "left join power_grid p on l.light_id = p.light_id"
        ),
        "requests_enriched": (
            "select m.request_id, m.light_id, m.reported_at, m.resolved_at, m.issue_type, m.description, "
            "m.created_at, l.lon, l.lat, l.wattage, l.neighborhood_id, n.name as neighborhood_name, "
            "n.population, w.season, w.failure_risk_score, w.avg_temperature_c, w.rainfall_mm, "
            "epoch(m.resolved_at - m.reported_at)/3600.0 as resolution_hours, "
            "case when m.resolved_at is null then 'OPEN' else 'CLOSED' end as status "
            "from requests m join lights l on m.light_id = l.light_id "
            "left join zones n on l.neighborhood_id = n.neighborhood_id "
            "left join weather w on l.light_id = w.light_id "
            f"and w.season = {season_sql('month(m.reported_at)')}"
        ),
        "searchable": (
            "select m.request_id, m.light_id, m.reported_at, m.resolved_at, m.issue_type, "
            "concat(coalesce(m.description,''), ' Location: ', coalesce(n.name,'Unknown'), '.', ' Light ID: ', "
            "cast(m.light_id as varchar), '.', ' Issue type: ', coalesce(m.issue_type,'unknown'), '.') as search_description, "
            "m.description as original_description, l.status as light_status, l.wattage, "
            "n.name as neighborhood_name, n.population as neighborhood_population, l.lon as longitude, l.lat as latitude, "
            "case when l.lon is not null then 'https://www.google.com/maps?q=' || cast(l.lat as varchar) || ',' || "
            "cast(l.lon as varchar) end as google_maps_url, "
            "datediff('hour', m.reported_at, m.resolved_at) as resolution_hours, "
            "case when m.resolved_at is null then 'OPEN' else 'CLOSED' end as request_status "
            "from requests m left join lights l on m.light_id = l.light_id "
            "left join zones n on l.neighborhood_id = n.neighborhood_id"
        ),
    }
)


def _series_cte(where: str) -> str:
    counts = ", ".join(
        f"count(case when issue_type = '{t}' then 1 end) as {c}"
        for t, c in [
            ("bulb_failure", "bulb_failures"),
            ("wiring", "wiring_issues"),
            ("pole_damage", "pole_damage"),
            ("power_supply", "power_supply"),
            ("sensor_failure", "sensor_failures"),
        ]
    )
    zero = ", ".join(
        f"coalesce({c},0) as {c}"
        for c in [
            "total", "unique_lights_affected", "bulb_failures", "wiring_issues", "pole_damage",
            "power_supply", "sensor_failures",
        ]
    )
    return (
        f"select ts, {zero}, cast(dayofweek(ts) as int) as day_of_week, cast(dayofmonth(ts) as int) as day_of_month, cast(month(ts) as int) as month, "
        f"cast(quarter(ts) as int) as quarter, {season_sql('month(ts)')} as season, "
        "case when dayofweek(ts) in (0,6) then 1 else 0 end as is_weekend from ("
        f"select cast(unnest(generate_series(min(cast(reported_at as date)), max(cast(reported_at as date)), interval 1 day)) as date) as ts from requests where {where}) "
        f"left join (select cast(reported_at as date) as d, count(*) as total, count(distinct light_id) as unique_lights_affected, {counts} "
        f"from requests where {where} group by 1) on d = ts"
    )


CTES["bulb_series"] = _series_cte("issue_type = 'bulb_failure'")
CTES["all_series"] = _series_cte("reported_at is not null")


def _weekly_cte(series: str) -> str:
    return (
        "select cast(date_trunc('week', ts) as date) as week_start, cast(sum(total) as bigint) as weekly_total, "
        "cast(sum(unique_lights_affected) as bigint) as weekly_lights_affected, "
        "cast(sum(bulb_failures) as bigint) as weekly_bulb_failures, cast(sum(wiring_issues) as bigint) as weekly_wiring_issues, "
        "cast(sum(pole_damage) as bigint) as weekly_pole_damage, cast(sum(power_supply) as bigint) as weekly_power_supply, "
        "cast(sum(sensor_failures) as bigint) as weekly_sensor_failures, "
        f"{rnd('avg(total)', 6)} as avg_daily, max(total) as max_daily, min(season) as season from {series} group by 1"
    )


CTES["bulb_weekly"] = _weekly_cte("bulb_series")
CTES["all_weekly"] = _weekly_cte("all_series")


def forecast_cte(series: str, periods: int) -> str:
    """Trend line + weekday effect + normal band, one row per future day."""
    return (
        f"select ts, f as forecast, f - {Z_95} * sd as lower_bound, f + {Z_95} * sd as upper_bound from ("
        "select cast(m.last_ts + n as date) as ts, m.a + m.b * datediff('day', date '1970-01-01', cast(m.last_ts + n as date)) "
        "+ coalesce(w.effect, 0) as f, r.sd from "
        f"(select max(ts) as last_ts, regr_intercept(total, x) as a, regr_slope(total, x) as b from "
        f"(select ts, total, datediff('day', date '1970-01-01', ts) as x from {series})) m "
        f"cross join (select cast(range as int) as n from range(1, {periods + 1})) "
        f"left join {series}_dow w on w.dow = dayofweek(cast(m.last_ts + n as date)) cross join {series}_sd r)"
    )


Z_95 = "1.959963984540054e0"
for _s in ("bulb_series", "all_series"):
    CTES[f"{_s}_resid"] = (
        f"select s.ts, s.total - (m.a + m.b * datediff('day', date '1970-01-01', s.ts)) as resid, dayofweek(s.ts) as dow "
        f"from {_s} s cross join (select regr_intercept(total, x) as a, regr_slope(total, x) as b from "
        f"(select total, datediff('day', date '1970-01-01', ts) as x from {_s})) m"
    )
    CTES[f"{_s}_dow"] = f"select dow, avg(resid) as effect from {_s}_resid group by dow"
    CTES[f"{_s}_sd"] = (
        f"select coalesce(stddev_samp(e.resid - w.effect), 0) as sd from {_s}_resid e join {_s}_dow w on e.dow = w.dow"
    )


def _forecast_table(series: str, periods: int) -> str:
    r0 = lambda e: f"cast(round(cast({e} as decimal(28,9)), 0) as bigint)"
    return (
        f"select ts as forecast_date, {r0('forecast')} as predicted, {r0('lower_bound')} as lower_bound, "
        f"{r0('upper_bound')} as upper_bound, {rnd('forecast', 2)} as predicted_precise, "
        f"cast(dayofweek(ts) as int) as day_of_week, {season_sql('month(ts)')} as season, "
        f"{r0('upper_bound - lower_bound')} as prediction_range, "
        "cast(date_trunc('week', ts) as date) as week_start, cast(date_trunc('month', ts) as date) as month_start "
        f"from ({forecast_cte(series, periods)})"
    )


for _short, _s in (("bulb", "bulb_series"), ("all", "all_series")):
    for _p in (30, 90):
        CTES[f"{_short}_fc{_p}"] = _forecast_table(_s, _p)

CTES["bulb_schedule"] = (
    "select forecast_date, predicted as predicted_failures, lower_bound, upper_bound, season, day_of_week, "
    "case when predicted >= 5 then 'HIGH' when predicted >= 3 then 'MEDIUM' else 'LOW' end as priority, "
    "case when predicted >= 5 then 'Full crew (3+ technicians)' when predicted >= 3 then "
    "'Standard crew (2 technicians)' else 'Minimal crew (1 technician)' end as staffing_recommendation, "
    "cast(ceil(upper_bound * 1.2) as bigint) as bulbs_to_stock, cast(week(forecast_date) as int) as week_number, "
    "prediction_range as uncertainty_range from bulb_fc30"
)
CTES["all_schedule"] = (
    "select forecast_date, predicted as predicted_requests, lower_bound, upper_bound, season, day_of_week, "
    "case when predicted >= 8 then 'HIGH' when predicted >= 5 then 'MEDIUM' else 'LOW' end as workload_level, "
    "case when predicted >= 8 then 'Full crew + backup (4+ technicians)' when predicted >= 5 then "
    "'Full crew (3 technicians)' else 'Standard crew (2 technicians)' end as staffing_recommendation, "
    "cast(ceil(predicted * 0.5 * 1.2) as bigint) as bulbs_to_stock, "
    "cast(ceil(predicted * 0.2 * 1.2) as bigint) as wiring_kits_to_stock, "
    "cast(ceil(predicted * 0.1 * 1.2) as bigint) as poles_to_stock, cast(week(forecast_date) as int) as week_number, "
    "prediction_range as uncertainty_range from all_fc30"
)
for _short in ("bulb", "all"):
    CTES[f"{_short}_weekly_fc"] = (
        "select week_start, cast(sum(predicted) as bigint) as total_predicted, cast(sum(lower_bound) as bigint) as total_lower_bound, "
        f"cast(sum(upper_bound) as bigint) as total_upper_bound, {rnd('avg(predicted)', 1)} as avg_daily, "
        f"max(predicted) as peak_day, min(season) as primary_season from {_short}_fc90 group by week_start"
    )
CTES["current_state"] = (
    "select light_id, op, status, version, changed_at from "
    "(select *, row_number() over (partition by light_id order by version desc) as pos from feed) where pos = 1"
)


def with_ctes(sql: str) -> str:
    """Prefix ``sql`` with the building blocks it names, dependencies first."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in order and re.search(rf"(?<![\w.'])(?:from|join|,)\s*\(?\s*{name}\b", text, re.I):
                visit(CTES[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    if not order:
        return sql.strip()
    parts = ",\n".join(f"{name} as ({CTES[name]})" for name in order)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {parts},\n{body[5:]}"
    return f"with {parts}\n{body}"
