"""Registered analytic questions (NQ family)."""

from __future__ import annotations

from ..plans import questions as nq
from ..sources.fixtures import AS_OF, AS_OF_TS
from .base import query, rnd, season_sql

_TS = f"timestamp '{AS_OF_TS}'"


def _like(column: str, patterns: list[str]) -> str:
    return "(" + " or ".join(f"{column} ilike '{p}'" for p in patterns) + ")"


query(
    "lights_by_zone_ranked",
    """select n.neighborhood_id, n.name as neighborhood_name, count(*) as light_count,
    cast(rank() over (order by count(*) desc) as int) as rank from lights l join zones n on l.neighborhood_id = n.neighborhood_id
    where not l._deleted and not n._deleted group by 1, 2""",
)(nq.lights_by_zone_ranked)
query("avg_wattage", f"select {rnd('avg(wattage)', 4)} as avg_wattage from lights where not _deleted")(nq.avg_wattage)
query(
    "resolved_vs_open",
    """select count(resolved_at) as resolved, count(*) - count(resolved_at) as still_open from requests where not _deleted""",
)(nq.resolved_vs_open)
query(
    "median_resolution_month",
    f"""select count(*) as resolved, {rnd("median(epoch(resolved_at - reported_at)/3600.0)", 4)} as median_hours from requests
    where not _deleted and date_trunc('month', resolved_at) = date_trunc('month', date '{AS_OF}')""",
)(lambda t: nq.median_resolution_month(t, AS_OF))
query(
    "risk_above_threshold",
    "select count(distinct light_id) as lights_above from weather where not _deleted and failure_risk_score > 0.7",
)(nq.risk_above_threshold)
query(
    "wettest_season",
    f"""select season, {rnd("avg(rainfall_mm)", 2)} as avg_rainfall from weather where not _deleted group by season
    order by avg(rainfall_mm) desc limit 1""",
)(nq.wettest_season)
query(
    "outage_risk_correlation",
    f"""select count(*) as lights, {rnd("corr(p.outage_history_count, cast(w.failure_risk_score as double))", 6)} as correlation
    from power_grid p join weather w on p.light_id = w.light_id and w.season = 'monsoon' where not p._deleted and not w._deleted""",
)(lambda t: nq.outage_risk_correlation(t, AS_OF))
query(
    "largest_coverage",
    """select supplier_id, name, specialization, service_radius_km from suppliers where not _deleted
    order by service_radius_km desc, supplier_id limit 10""",
)(nq.largest_coverage)
query(
    "population_per_light",
    f"""select n.neighborhood_id, n.name as neighborhood_name, n.population, count(l.light_id) as light_count,
    {rnd("n.population/nullif(count(l.light_id),0)", 2)} as population_per_light
    from zones n left join lights l on l.neighborhood_id = n.neighborhood_id and not l._deleted where not n._deleted group by 1, 2, 3""",
)(nq.population_per_light)
_DENSITY = """select d.neighborhood_id, d.population_density, n.name as neighborhood_name, count(r.request_id) as request_count
    from demographics d join zones n on d.neighborhood_id = n.neighborhood_id and not n._deleted
    left join lights l on l.neighborhood_id = n.neighborhood_id and not l._deleted
    left join requests r on r.light_id = l.light_id and not r._deleted where not d._deleted group by 1, 2, 3"""
query("density_vs_requests", _DENSITY)(nq.density_vs_requests)
query(
    "density_requests_correlation",
    f"select {rnd('corr(population_density, request_count)', 6)} as correlation from ({_DENSITY})",
)(nq.density_requests_correlation)
query(
    "high_risk_nearest_supplier",
    f"""with live_pairs as (select p.*, row_number() over (partition by p.light_id order by p.deg2, p.supplier_id) as pos
    from pairs p join suppliers s on p.supplier_id = s.supplier_id where not s._deleted)
    select l.light_id, cast(w.failure_risk_score as double) as failure_risk_score, p.name as supplier_name, p.contact_phone,
    {rnd("p.meters/1000", 2)} as distance_km from lights l join weather w on l.light_id = w.light_id and w.season = 'monsoon'
    join live_pairs p on p.light_id = l.light_id and p.pos = 1
    where not l._deleted and not w._deleted and w.failure_risk_score > 0.7""",
)(lambda t: nq.high_risk_nearest_supplier(t, AS_OF))
query(
    "urgent_in_populous_zones",
    f"""select r.request_id, r.light_id, r.issue_type, n.name as neighborhood_name, n.population from requests r
    join lights l on r.light_id = l.light_id join zones n on l.neighborhood_id = n.neighborhood_id
    where not r._deleted and not l._deleted and not n._deleted and n.population > 100000 and {_like('r.description', nq.URGENT_PATTERNS)}""",
)(nq.urgent_in_populous_zones)
query(
    "longest_waiting_faulty",
    f"""select l.light_id, min(r.reported_at) as waiting_since, count(*) as open_requests,
    {rnd(f"epoch({_TS} - min(r.reported_at))/3600.0", 2)} as wait_hours from lights l join requests r on r.light_id = l.light_id
    where l.status = 'faulty' and not l._deleted and not r._deleted and r.resolved_at is null group by 1
    order by waiting_since, l.light_id limit 20""",
)(lambda t: nq.longest_waiting_faulty(t, AS_OF_TS))
query(
    "weather_damage_outage_areas",
    f"""select p.grid_zone, cast(sum(coalesce(c.n,0)) as bigint) as weather_requests,
    cast(sum(p.outage_history_count) as bigint) as total_outages, {rnd("avg(p.outage_history_count)", 2)} as avg_outages
    from power_grid p left join (select light_id, count(*) as n from requests where not _deleted and
    {_like('description', nq.WEATHER_PATTERNS)} group by 1) c on c.light_id = p.light_id
    where not p._deleted group by 1 having avg(p.outage_history_count) >= 1""",
)(nq.weather_damage_outage_areas)
query(
    "repeat_failures",
    """with per as (select light_id, issue_type, count(*) as n from requests where not _deleted group by 1, 2),
    top as (select *, row_number() over (partition by light_id order by n desc, issue_type) as pos from per)
    select p.light_id, cast(sum(p.n) as bigint) as request_count, min(t.issue_type) as common_issue
    from per p join top t on t.light_id = p.light_id and t.pos = 1 group by 1 having sum(p.n) > 1""",
)(nq.repeat_failures)
query(
    "request_trend",
    """select cast(date_trunc('month', reported_at) as date) as month, count(*) as request_count
    from requests where not _deleted group by 1""",
)(nq.request_trend)
query(
    "maintenance_needed_pct",
    f"""select count(*) as total_lights, count(*) filter (where status = 'maintenance_required') as needing,
    {rnd("100.0*count(*) filter (where status = 'maintenance_required')/nullif(count(*),0)", 2)} as maintenance_pct
    from lights where not _deleted""",
)(nq.maintenance_needed_pct)
query(
    "light_history",
    "select request_id, light_id, reported_at, resolved_at, issue_type from requests where not _deleted and light_id = 70",
)(lambda t: nq.light_history(t, 70))
query(
    "issue_by_zone",
    """select n.neighborhood_id, n.name as neighborhood_name, count(*) as request_count from requests r
    join lights l on r.light_id = l.light_id join zones n on l.neighborhood_id = n.neighborhood_id
    where not r._deleted and not l._deleted and not n._deleted and r.issue_type = 'wiring' group by 1, 2""",
)(lambda t: nq.issue_by_zone(t, "wiring"))
query(
    "open_by_issue",
    """select count(*) as open_requests from requests where not _deleted and issue_type = 'pole_damage' and resolved_at is null""",
)(lambda t: nq.open_by_issue(t, "pole_damage"))
query(
    "requests_in_season",
    f"select count(*) as request_count from requests where not _deleted and {season_sql('month(reported_at)')} = 'monsoon'",
)(lambda t: nq.requests_in_season(t, "monsoon"))
query(
    "failing_this_month",
    f"""select w.light_id, w.predicted_failure_date, cast(w.failure_risk_score as double) as failure_risk_score, l.status
    from weather w join lights l on w.light_id = l.light_id where not w._deleted and not l._deleted and w.season = 'monsoon'
    and date_trunc('month', w.predicted_failure_date) = date_trunc('month', date '{AS_OF}')""",
)(lambda t: nq.failing_this_month(t, AS_OF))
query(
    "dispatch_supplier",
    f"""select light_id, supplier_id, name as supplier_name, avg_response_hours, {rnd("meters/1000", 2)} as distance_km from (
    select p.*, row_number() over (partition by p.light_id order by p.meters, p.supplier_id) as pos from pairs p
    join suppliers s on s.supplier_id = p.supplier_id join lights l on l.light_id = p.light_id
    where not s._deleted and not l._deleted and p.meters <= p.service_radius_km*1000) where pos = 1""",
)(nq.dispatch_supplier)
query(
    "parts_for_open_requests",
    """select case issue_type when 'bulb_failure' then 'bulb' when 'wiring' then 'wiring_kit' else 'pole' end as part,
    count(*) as quantity from requests where not _deleted and resolved_at is null
    and issue_type in ('bulb_failure', 'wiring', 'pole_damage') group by 1""",
)(nq.parts_for_open_requests)
query(
    "electrician_repairs",
    """select request_id, light_id, issue_type, reported_at from requests where not _deleted and resolved_at is null
    and issue_type in ('wiring', 'power_supply')""",
)(nq.electrician_repairs)
