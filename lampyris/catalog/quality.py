"""Registered data-quality checks (DQ family) and the metric layer (SEM family)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules
from ..operators import enrich, metrics, quality
from ..plans import planning as pl
from ..plans.verified import VERIFIED
from .base import REGISTRY, query, rnd


def _in(values):
    return ", ".join(f"'{v}'" for v in values)


def _union(parts):
    return " union all ".join(parts)


query(
    "check_domain",
    _union(
        f"select '{tab}.{col}' as check_name, count(*) as violations from {tab} where {col} not in ({_in(vals)})"
        for (tab, col), vals in quality.DOMAINS.items()
    ),
)(quality.check_domain)
query(
    "check_range",
    """select 'weather.failure_risk_score' as check_name, count(*) as violations from weather
    where failure_risk_score < 0 or failure_risk_score > 1""",
)(quality.check_range)
query(
    "check_not_null",
    _union(
        f"select '{tab}.{c}' as check_name, count(*) as violations from {tab} where {'x0' if c == 'ring' else c} is null"
        for tab, cols in quality.REQUIRED.items()
        for c in cols
    ),
)(quality.check_not_null)
query(
    "check_unique",
    _union(
        f"select '{tab}' as check_name, count(*) as violations from (select 1 from {tab} group by {', '.join(key)} having count(*) > 1)"
        for tab, key in quality.PRIMARY_KEYS.items()
    ),
)(quality.check_unique)
query(
    "check_unique_lineitem",
    """select count(*) as repeated_keys, cast(sum(n) as bigint) as rows_affected from
    (select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having count(*) > 1)""",
)(
    lambda t: t.raw("lineitem")
    .groupBy("l_orderkey", "l_linenumber")
    .agg(F.count("*").alias("n"))
    .where(F.col("n") > 1)
    .agg(F.count("*").alias("repeated_keys"), F.sum("n").alias("rows_affected"))
)
query(
    "check_fk",
    _union(
        f"""select '{c}.{col}' as check_name, count(*) as violations from {c} where {col} is not null and {col} not in
        (select {col} from {p})"""
        for c, col, p in quality.FOREIGN_KEYS
    ),
)(quality.check_fk)
query(
    "check_spatial_integrity",
    """select (select count(*) from inside) as lights_within_neighborhoods,
    (select count(*) from lights where light_id not in (select light_id from inside)) as lights_outside_neighborhoods""",
)(quality.check_spatial_integrity)
query(
    "enrichment_coverage",
    """select (select count(distinct light_id) from weather) as lights_with_weather,
    (select count(distinct light_id) from power_grid) as lights_with_power_grid,
    (select count(distinct neighborhood_id) from demographics) as neighborhoods_with_demographics,
    (select count(*) from lights) as total_lights, (select count(*) from zones) as total_neighborhoods""",
)(quality.enrichment_coverage)
query(
    "history_length",
    """select cast(max(cast(reported_at as date)) - min(cast(reported_at as date)) + 1 as int) as days,
    max(cast(reported_at as date)) - min(cast(reported_at as date)) + 1 >= 30 as enough from requests""",
)(quality.history_length)
query(
    "polygon_validity",
    "select neighborhood_id, 7 as ring_points, true as is_closed, false as self_intersects from zones",
)(quality.polygon_validity)
query("name_duplicates", "select name, count(*) as zones from zones group by 1 having count(*) > 1")(quality.name_duplicates)


@query(
    "phase_status",
    """select 'Phase: CDC' as phase, case when (select count(*) from lights) > 0 then 'COMPLETE' else 'INCOMPLETE' end as status
    union all select 'Phase: Search', case when (select count(*) from searchable) > 0 then 'COMPLETE' else 'INCOMPLETE' end
    union all select 'Phase: ML Forecasting', case when (select count(*) from bulb_fc30) > 0 then 'COMPLETE' else 'PENDING' end""",
)
def phase_status(t):
    return quality.phase_status(
        {
            "CDC": (t.lights, "INCOMPLETE"),
            "Search": (enrich.maintenance_searchable(t), "INCOMPLETE"),
            "ML Forecasting": (pl.bulb_forecast(t, 30), "PENDING"),
        }
    )


query(
    "expected_counts",
    _union(
        f"select '{n}' as table_name, count(*) as actual_rows, cast({e} as bigint) as expected_rows, count(*) = {e} as matches from {n}"
        for n, e in quality.EXPECTED_ROWS.items()
    ),
)(quality.expected_counts)

# ---- metric layer


@query(
    "metric_query",
    f"""select n.name, l.status, count(*) as lights, cast(sum(l.wattage) as bigint) as total_wattage, {rnd('avg(l.wattage)', 4)} as avg_wattage,
    min(l.wattage) as min_wattage, count(distinct l.wattage) as wattages
    from lights l left join (select * from zones where not _deleted) n on l.neighborhood_id = n.neighborhood_id
    where not l._deleted group by 1, 2""",
)
def metric_query(t):
    out = metrics.metric_query(
        t,
        "street_lights",
        {
            "lights": ("count", "*"),
            "total_wattage": ("sum", "power_consumption"),
            "avg_wattage": ("avg", "watts"),
            "min_wattage": ("min", "wattage"),
            "wattages": ("count_distinct", "wattage"),
        },
        ["neighborhoods.area_name", "condition"],
    )
    return out.withColumn("avg_wattage", rules.round_half_up(F.col("avg_wattage"), 4))


@query(
    "metric_query_filtered",
    f"""select n.name, w.season, {rnd('avg(w.failure_risk_score)', 4)} as avg_risk, cast(max(w.rainfall_mm) as double) as max_rain
    from weather w join lights l on w.light_id = l.light_id
    left join (select * from zones where not _deleted) n on l.neighborhood_id = n.neighborhood_id
    where not w._deleted and not l._deleted and l.status in ('faulty', 'maintenance_required') and w.season <> 'winter'
    group by 1, 2""",
)
def metric_query_filtered(t):
    out = metrics.metric_query(
        t,
        "weather_enrichment",
        {"avg_risk": ("avg", "risk_score"), "max_rain": ("max", "precipitation")},
        ["neighborhoods.name", "time_of_year"],
        where={"street_lights.condition": ["faulty", "maintenance_required"], "season": ["monsoon", "summer"]},
    )
    return out.withColumn("avg_risk", rules.round_half_up(F.col("avg_risk"), 4)).withColumn("max_rain", F.col("max_rain").cast("double"))


@query(
    "metric_query_requests",
    """select n.name, r.issue_type, count(*) as requests from requests r
    left join (select * from lights where not _deleted) l on r.light_id = l.light_id
    left join (select * from zones where not _deleted) n on l.neighborhood_id = n.neighborhood_id where not r._deleted group by 1, 2""",
)
def metric_query_requests(t):
    return metrics.metric_query(t, "maintenance_requests", {"requests": ("count", "*")}, ["neighborhoods.name", "fault_type"])


@query(
    "metric_query_monthly",
    """select cast(date_trunc('month', r.reported_at) as date) as reported_at_month, cast(date_trunc('year', l.installation_date) as date) as
    installation_date_year, count(*) as requests, count(distinct r.issue_type) as issue_types from requests r
    left join (select * from lights where not _deleted) l on r.light_id = l.light_id where not r._deleted group by 1, 2""",
)
def metric_query_monthly(t):
    return metrics.metric_query(
        t,
        "maintenance_requests",
        {"requests": ("count", "*"), "issue_types": ("count_distinct", "issue_type")},
        ["opened_at:month", "street_lights.install_date:year"],
    )


@query(
    "metric_query_facts",
    """with l as (select l.light_id, n.name from lights l left join (select * from zones where not _deleted) n on l.neighborhood_id = n.neighborhood_id where not l._deleted),
    r as (select l.name, count(*) as requests, count(distinct r.issue_type) as issue_types from requests r left join l on l.light_id = r.light_id where not r._deleted group by 1),
    o as (select l.name, cast(sum(p.outage_history_count) as bigint) as outages from power_grid p left join l on l.light_id = p.light_id where not p._deleted group by 1),
    g as (select name from r union select name from o)
    select g.name, coalesce(requests, 0) as requests, coalesce(issue_types, 0) as issue_types, outages from g
    left join r on r.name is not distinct from g.name left join o on o.name is not distinct from g.name""",
)
def metric_query_facts(t):
    return metrics.facts_query(
        t,
        {"maintenance_requests": {"requests": ("count", "*"), "issue_types": ("count_distinct", "issue_type")}, "power_grid_enrichment": {"outages": ("sum", "blackouts")}},
        ["neighborhoods.name"],
    )


@query(
    "metric_query_deleted",
    "select _deleted, count(*) as lights, count(distinct lon || ' ' || lat) as places from lights group by 1",
)
def metric_query_deleted(t):
    wanted = {"lights": ("count", "*"), "places": ("count_distinct", "gps_location")}
    return metrics.metric_query(t, "street_lights", wanted, ["is_deleted"], deleted=True)


_stored_as = {"location": "lon", "boundary": "x0"}


def _synonyms_sql() -> str:
    words = ", ".join(f"('{w}', '{t}', '{c}', '{k}')" for w, t, c, k in metrics.synonym_rows())
    counts = _union(
        f"select '{t}' as table_name, '{c}' as column_name, count({_stored_as.get(c, c)}) as filled_rows from {spec.source} where not _deleted"
        for t, spec in metrics.MODEL.items()
        for c in spec.columns()
    )
    return f"""select w.business_name, w.table_name, w.column_name, w.kind, c.filled_rows
    from (values {words}) as w(business_name, table_name, column_name, kind)
    join ({counts}) c on c.table_name = w.table_name and c.column_name = w.column_name"""


query("resolve_synonyms", _synonyms_sql())(metrics.resolve_synonyms)


@query(
    "verified_queries",
    _union(
        f"select '{key}' as query_key, '{name}' as name, '{question}' as question, (select count(*) from ({REGISTRY[key].sql})) as result_rows"
        for key, (name, question) in VERIFIED.items()
    ),
)
def verified_queries(t):
    """Catalogue of verified questions with the row count each returns on the current data."""
    parts = [
        REGISTRY[key]
        .run(t.spark, t.path)
        .agg(F.count("*").alias("result_rows"))
        .select(F.lit(key).alias("query_key"), F.lit(name).alias("name"), F.lit(question).alias("question"), "result_rows")
        for key, (name, question) in VERIFIED.items()
    ]
    return quality.union_all(parts)
