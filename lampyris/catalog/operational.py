"""Registered operational queries (Q family)."""

from __future__ import annotations

from ..plans import operational as op
from ..sources.fixtures import AS_OF
from .base import lambert_sql, query, rnd, season_sql

_ASOF = f"date '{AS_OF}'"

query(
    "entity_counts",
    """select 'Neighborhoods' as entity, cast(count(*) as varchar) as count from zones
    union all select 'Street Lights', cast(count(*) as varchar) from lights
    union all select 'Suppliers', cast(count(*) as varchar) from suppliers
    union all select 'Maintenance Requests', cast(count(*) as varchar) from requests
    union all select '  └─ Open Requests', cast(count(*) as varchar) from requests where resolved_at is null
    union all select '  └─ Closed Requests', cast(count(*) as varchar) from requests where resolved_at is not null""",
)(op.entity_counts)

query(
    "entity_counts_wide",
    """select (select count(*) from zones) as neighborhoods, (select count(*) from lights) as street_lights,
    (select count(*) from suppliers) as suppliers, (select count(*) from requests) as maintenance_requests""",
)(op.entity_counts_wide)

query(
    "status_share",
    f"""select status, count(*) as count, {rnd("100.0*count(*)/sum(count(*)) over ()", 1)} as percentage
    from lights group by status""",
)(op.status_share)

query(
    "status_share_subquery",
    f"""select status, count(*) as count, {rnd("count(*)*100.0/(select count(*) from lights)", 2)} as percentage
    from lights group by status""",
)(lambda t: op.status_share(t, 2))

query(
    "faulty_by_zone_spatial",
    f"""select n.name as neighborhood, count(*) as faulty_lights, n.population,
    {rnd("n.population/count(*)", 0)} as residents_per_faulty_light
    from inside i join lights l on i.light_id = l.light_id and l.status = 'faulty'
    join zones n on i.zone_id = n.neighborhood_id
    group by n.neighborhood_id, n.name, n.population order by faulty_lights desc, n.neighborhood_id limit 10""",
)(op.faulty_by_zone_spatial)

query(
    "faulty_nearest_supplier",
    f"""select l.light_id, n.name as neighborhood, s.name as nearest_supplier, s.specialization,
    {rnd("s.meters/1000", 2)} as distance_km, s.avg_response_hours
    from lights l join zones n on l.neighborhood_id = n.neighborhood_id join nearest_planar s on l.light_id = s.light_id
    where l.status = 'faulty' order by distance_km desc, l.light_id limit 5""",
)(op.faulty_nearest_supplier)

query(
    "faulty_nearest_supplier_all",
    f"""select l.light_id, l.lon as longitude, l.lat as latitude, l.status, n.name as neighborhood,
    s.name as nearest_supplier, s.specialization, {rnd("s.meters/1000", 2)} as distance_km, s.avg_response_hours,
    s.contact_phone from lights l left join zones n on l.neighborhood_id = n.neighborhood_id
    join nearest_planar s on l.light_id = s.light_id where l.status = 'faulty'""",
)(op.faulty_nearest_supplier_all)

query(
    "highest_risk_lights",
    """select light_id, neighborhood_name, status, season, cast(failure_risk_score as double) as failure_risk_score,
    predicted_failure_date, maintenance_urgency, days_since_maintenance from lights_enriched
    where failure_risk_score is not null
    order by failure_risk_score desc, predicted_failure_date asc nulls last, light_id limit 10""",
)(lambda t: op.highest_risk_lights(t, AS_OF))

query(
    "supplier_coverage_counts",
    """select s.name as supplier, s.specialization, s.service_radius_km,
    count(distinct p.light_id) as lights_in_range,
    count(distinct p.light_id) filter (where p.status = 'faulty') as faulty_in_range,
    count(distinct p.light_id) filter (where p.status = 'maintenance_required') as maintenance_needed_in_range
    from suppliers s left join pairs p on s.supplier_id = p.supplier_id and p.meters <= s.service_radius_km*1000
    group by s.supplier_id, s.name, s.specialization, s.service_radius_km
    order by faulty_in_range desc, lights_in_range desc, s.supplier_id limit 10""",
)(op.supplier_coverage_counts)

query(
    "zone_infrastructure",
    f"""select n.name as neighborhood, d.urban_classification, d.population_density as pop_density_per_sqkm,
    count(l.light_id) as total_lights, count(l.light_id) filter (where l.status = 'operational') as operational,
    count(l.light_id) filter (where l.status <> 'operational') as needs_attention,
    {rnd("100.0*count(l.light_id) filter (where l.status = 'operational')/nullif(count(l.light_id),0)", 1)} as operational_pct
    from zones n left join demographics d on n.neighborhood_id = d.neighborhood_id
    left join lights l on l.neighborhood_id = n.neighborhood_id
    group by n.neighborhood_id, n.name, d.urban_classification, d.population_density
    order by operational_pct asc nulls last, n.neighborhood_id limit 10""",
)(op.zone_infrastructure)

query(
    "issue_resolution",
    f"""select issue_type, count(*) as total_requests, count(*) filter (where resolved_at is null) as open_requests,
    {rnd("avg(epoch(resolved_at - reported_at)/3600.0)", 1)} as avg_resolution_hours,
    {rnd("max(epoch(resolved_at - reported_at)/3600.0)", 1)} as max_resolution_hours from requests group by issue_type""",
)(op.issue_resolution)

query(
    "grid_zone_impact",
    f"""select p.grid_zone, count(l.light_id) as total_lights, {rnd("avg(p.avg_load_percent)", 1)} as avg_grid_load_pct,
    {rnd("avg(p.outage_history_count)", 1)} as avg_outages,
    count(l.light_id) filter (where l.status = 'faulty') as faulty_lights,
    {rnd("100.0*count(l.light_id) filter (where l.status = 'faulty')/nullif(count(l.light_id),0)", 1)} as faulty_pct
    from power_grid p join lights l on p.light_id = l.light_id group by p.grid_zone""",
)(op.grid_zone_impact)


def _keyword_sql(patterns: list[str], preview: int) -> str:
    cond = " or ".join(f"m.description ilike '{p}'" for p in patterns)
    return f"""select m.request_id, m.light_id, n.name as neighborhood, m.issue_type,
    left(m.description, {preview}) || '...' as description_preview,
    case when m.resolved_at is null then 'OPEN' else 'CLOSED' end as status
    from requests m join lights l on m.light_id = l.light_id left join zones n on l.neighborhood_id = n.neighborhood_id
    where {cond} order by m.reported_at desc, m.request_id limit 10"""


query("hazard_text_search", _keyword_sql(op.HAZARD_PATTERNS, 60))(lambda t: op.keyword_search(t, op.HAZARD_PATTERNS))
query("flicker_text_search", _keyword_sql(op.FLICKER_PATTERNS, 70))(
    lambda t: op.keyword_search(t, op.FLICKER_PATTERNS, preview=70)
)


def near_sql(lon: str, lat: str, radius: int, tail: str = "") -> str:
    d = lambert_sql("l.lon", "l.lat", lon, lat)
    return f"""select l.light_id, l.status, l.wattage, n.name as neighborhood, {rnd(d, 0)} as distance_meters
    from lights l left join zones n on l.neighborhood_id = n.neighborhood_id where {d} <= {radius}
    order by distance_meters, l.light_id {tail}"""


query("lights_near_center", near_sql("7.762e1", "1.293e1", 1000, "limit 10"))(op.lights_near)

query(
    "all_lights",
    """select light_id, lon as longitude, lat as latitude, status, neighborhood_name, wattage, season,
    cast(failure_risk_score as double) as failure_risk_score, predicted_failure_date, maintenance_urgency, age_months,
    days_since_maintenance from lights_enriched""",
)(lambda t: op.all_lights(t, AS_OF))

query(
    "all_suppliers",
    """select supplier_id, name, lon as longitude, lat as latitude, service_radius_km, avg_response_hours,
    specialization, contact_phone from suppliers""",
)(op.all_suppliers)

PREDICTED_SQL = f"""select light_id, lon as longitude, lat as latitude, status, neighborhood_name,
    predicted_failure_date, cast(failure_risk_score as double) as failure_risk_score, maintenance_urgency, age_months,
    days_since_maintenance, season from lights_enriched
    where predicted_failure_date is not null and predicted_failure_date <= {_ASOF} + 30 and status <> 'faulty'"""
query("predicted_failures", PREDICTED_SQL)(lambda t: op.predicted_failures(t, AS_OF))

ZONE_STATS_SQL = f"""select n.name as neighborhood, count(l.light_id) as total_lights,
    count(case when l.status = 'operational' then 1 end) as operational,
    count(case when l.status = 'maintenance_required' then 1 end) as maintenance_required,
    count(case when l.status = 'faulty' then 1 end) as faulty,
    {rnd("count(case when l.status = 'faulty' then 1 end)*100.0/nullif(count(l.light_id),0)", 2)} as faulty_percentage
    from zones n left join inside i on i.zone_id = n.neighborhood_id left join lights l on i.light_id = l.light_id
    group by n.name"""
query("zone_stats", ZONE_STATS_SQL)(op.zone_stats)

query(
    "seasonal_patterns",
    f"""select season, count(*) as request_count, {rnd("avg(resolution_hours)", 6)} as avg_resolution_hours
    from requests_enriched where resolved_at is not null group by season""",
)(op.seasonal_patterns)

BANDS_SQL = f"""select count(*) as total_lights, count(case when meters/1000 <= 5 then 1 end) as within_5km,
    count(case when meters/1000 <= 10 then 1 end) as within_10km, count(case when meters/1000 > 10 then 1 end) as beyond_10km,
    {rnd("avg(meters/1000)", 2)} as avg_distance_km from nearest_geodesic"""
query("supplier_coverage_bands", BANDS_SQL)(op.supplier_coverage_bands)

CENTROID_SQL = """select neighborhood_id, sum(cr) as a2,
    min(ox) + sum((x1-ox + x2-ox)*cr)/(3*nullif(sum(cr),0)) as cx, min(oy) + sum((y1-oy + y2-oy)*cr)/(3*nullif(sum(cr),0)) as cy
    from (select e.*, o.x as ox, o.y as oy, (e.x1-o.x)*(e.y2-o.y)-(e.x2-o.x)*(e.y1-o.y) as cr
      from zone_edges e join zone_points o on e.neighborhood_id = o.neighborhood_id and o.i = 0) group by neighborhood_id"""
ZONE_NEAREST_SQL = f"""with centers as ({CENTROID_SQL}),
    dist as (select c.neighborhood_id as zone_id, n.name as neighborhood, s.name as nearest_supplier, s.specialization,
      {rnd("min(" + lambert_sql("c.cx", "c.cy", "s.lon", "s.lat") + ")/1000", 2)} as distance_km
      from centers c join zones n on c.neighborhood_id = n.neighborhood_id cross join suppliers s group by 1,2,3,4),
    lit as (select zone_id, count(*) as lights_in_neighborhood from inside group by zone_id),
    best as (select zone_id, min(distance_km) as m from dist group by zone_id)
    select d.zone_id, d.neighborhood, d.nearest_supplier, d.specialization, d.distance_km,
    coalesce(c.lights_in_neighborhood, 0) as lights_in_neighborhood from dist d
    join best b on d.zone_id = b.zone_id and d.distance_km = b.m left join lit c on d.zone_id = c.zone_id"""
query("zone_nearest_supplier", ZONE_NEAREST_SQL)(op.zone_nearest_supplier)

query(
    "zone_light_counts_spatial",
    """select n.name, count(i.light_id) as light_count from zones n left join inside i on i.zone_id = n.neighborhood_id
    group by n.name order by light_count desc, n.name limit 10""",
)(op.zone_light_counts_spatial)

query(
    "request_summary",
    """select count(*) as total_requests, count(case when resolved_at is null then 1 end) as open_requests,
    count(case when resolved_at is not null then 1 end) as closed_requests from requests""",
)(op.request_summary)

query("specialization_counts", "select specialization, count(*) as count from suppliers group by 1")(op.specialization_counts)

query(
    "faulty_sample",
    """select light_id, status, neighborhood_name, season, cast(failure_risk_score as double) as failure_risk_score,
    maintenance_urgency from lights_enriched where status = 'faulty' order by light_id limit 5""",
)(lambda t: op.faulty_sample(t, AS_OF))

query(
    "table_row_counts",
    """select 'zones' as table_name, count(*) as row_count from zones union all select 'lights', count(*) from lights
    union all select 'requests', count(*) from requests union all select 'suppliers', count(*) from suppliers
    union all select 'weather', count(*) from weather union all select 'demographics', count(*) from demographics
    union all select 'power_grid', count(*) from power_grid""",
)(op.table_row_counts)

query(
    "high_risk_view",
    """select light_id, neighborhood_name, cast(failure_risk_score as double) as failure_risk_score, predicted_failure_date
    from lights_enriched where failure_risk_score > 0.7 order by predicted_failure_date asc nulls last, light_id limit 10""",
)(lambda t: op.high_risk_view(t, AS_OF))
