"""Registered verified questions (VQ family) and their catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import verified as vq
from ..sources.fixtures import AS_OF
from .base import query, rnd

query(
    "lights_by_status", "select status, count(*) as light_count from lights where not _deleted group by status"
)(vq.lights_by_status)
query(
    "lights_per_zone",
    """select n.name as neighborhood_name, n.population, count(l.light_id) as light_count from lights l
    left join zones n on l.neighborhood_id = n.neighborhood_id where l._deleted = false and n._deleted = false group by 1, 2""",
)(vq.lights_per_zone)
query(
    "open_requests", "select count(*) as open_requests from requests where not _deleted and resolved_at is null"
)(vq.open_requests)
query(
    "issues_with_open",
    """select issue_type, count(*) as request_count, cast(sum(case when resolved_at is null then 1 else 0 end) as bigint) as still_open
    from requests where not _deleted group by 1""",
)(vq.issues_with_open)
query(
    "avg_resolution_by_issue",
    f"""select issue_type, count(*) as resolved_count, {rnd("avg(datediff('hour', reported_at, resolved_at))", 1)} as avg_resolution_hours
    from requests where not _deleted and resolved_at is not null group by 1""",
)(vq.avg_resolution_by_issue)
query(
    "requests_by_zone",
    """select n.name as neighborhood_name, count(m.request_id) as total_requests,
    cast(sum(case when m.resolved_at is null then 1 else 0 end) as bigint) as open_requests
    from requests m join lights l on m.light_id = l.light_id join zones n on l.neighborhood_id = n.neighborhood_id
    where not m._deleted and not l._deleted and not n._deleted group by 1""",
)(vq.requests_per_zone_name)
query(
    "high_risk_lights",
    """select w.light_id, l.status as current_status, n.name as neighborhood, w.season,
    cast(w.failure_risk_score as double) as risk_score, w.predicted_failure_date as predicted_failure
    from weather w join lights l on w.light_id = l.light_id left join zones n on l.neighborhood_id = n.neighborhood_id
    where not w._deleted and not l._deleted and w.failure_risk_score >= 0.7
    order by w.failure_risk_score desc, w.light_id, w.season limit 20""",
)(vq.high_risk_lights)
query(
    "risk_by_season",
    f"""select season, {rnd("avg(failure_risk_score)", 2)} as avg_risk_score, {rnd("avg(avg_temperature_c)", 1)} as avg_temperature,
    {rnd("avg(rainfall_mm)", 1)} as avg_rainfall, count(*) as light_count from weather where not _deleted group by 1""",
)(vq.risk_by_season)
query(
    "outages_by_grid_zone",
    f"""select grid_zone, count(*) as light_count, {rnd("avg(avg_load_percent)", 1)} as avg_load_pct,
    cast(sum(outage_history_count) as bigint) as total_outages from power_grid where not _deleted group by 1""",
)(vq.outages_by_grid_zone)
query(
    "supplier_response",
    "select name as supplier_name, specialization, service_radius_km, avg_response_hours from suppliers where not _deleted",
)(vq.supplier_response)
query(
    "suppliers_by_specialization",
    f"""select specialization, count(*) as supplier_count, {rnd("avg(avg_response_hours)", 1)} as avg_response_time,
    {rnd("avg(service_radius_km)", 1)} as avg_service_radius from suppliers where not _deleted group by 1""",
)(vq.suppliers_by_specialization)
query(
    "lights_by_urban_class",
    f"""select d.urban_classification as classification, count(distinct n.neighborhood_id) as neighborhood_count,
    cast(sum(n.population) as bigint) as total_population, {rnd("avg(d.population_density)", 0)} as avg_density,
    count(l.light_id) as total_lights
    from demographics d join zones n on d.neighborhood_id = n.neighborhood_id left join lights l on n.neighborhood_id = l.neighborhood_id
    where not d._deleted and not n._deleted and l._deleted = false group by 1""",
)(vq.lights_by_urban_class)
query(
    "lights_by_urban_class_dedup",
    f"""select d.urban_classification as classification, count(*) as neighborhood_count,
    cast(sum(n.population) as bigint) as total_population, {rnd("avg(d.population_density)", 0)} as avg_density,
    cast(sum(c.n) as bigint) as total_lights
    from demographics d join zones n on d.neighborhood_id = n.neighborhood_id
    join (select neighborhood_id, count(*) as n from lights where not _deleted group by 1) c on c.neighborhood_id = n.neighborhood_id
    where not d._deleted and not n._deleted group by 1""",
)(lambda t: vq.lights_by_urban_class(t, dedup=True))
query(
    "recent_changes",
    f"""select 'street_lights' as table_name, count(*) as records_modified from lights where cast(_updated_at as date) = date '{AS_OF}'
    union all select 'maintenance_requests', count(*) from requests where cast(_updated_at as date) = date '{AS_OF}'""",
)(lambda t: vq.recent_changes(t, AS_OF))
query(
    "power_by_zone",
    f"""select n.name as neighborhood_name, count(l.light_id) as light_count, cast(sum(l.wattage) as bigint) as total_wattage_w,
    {rnd("sum(l.wattage)/1000.0", 2)} as total_wattage_kw from lights l join zones n on l.neighborhood_id = n.neighborhood_id
    where not l._deleted and not n._deleted and l.status = 'operational' group by 1""",
)(vq.power_by_zone)
query(
    "faulty_locations",
    """select l.light_id, l.lon as longitude, l.lat as latitude, n.name as neighborhood_name from lights l
    left join zones n on l.neighborhood_id = n.neighborhood_id
    where l.status = 'faulty' and l._deleted = false and n._deleted = false""",
)(vq.faulty_locations)
query(
    "common_issues", "select issue_type, count(*) as issue_count from requests where not _deleted group by 1"
)(vq.common_issues)
query(
    "faulty_by_zone_fk",
    """select n.name as neighborhood_name, count(l.light_id) as faulty_light_count,
    count(distinct l.neighborhood_id) as neighborhoods_with_faulty_lights from lights l
    left join zones n on l.neighborhood_id = n.neighborhood_id
    where l.status = 'faulty' and l._deleted = false and (n._deleted = false or n._deleted is null) group by 1""",
)(vq.faulty_by_zone_fk)
query(
    "all_lights_status",
    """select light_id, status, neighborhood_id, lon as longitude, lat as latitude, installation_date, last_maintenance, wattage
    from lights where not _deleted""",
)(vq.all_lights_status)
query(
    "faulty_locations_nullsafe",
    """select l.light_id, l.lon as longitude, l.lat as latitude, n.name as neighborhood_name, l.status from lights l
    left join zones n on l.neighborhood_id = n.neighborhood_id
    where l.status = 'faulty' and l._deleted = false and (n._deleted = false or n._deleted is null)""",
)(vq.faulty_locations_nullsafe)
