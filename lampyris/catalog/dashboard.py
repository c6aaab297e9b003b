"""Registered dashboard figures (DB family)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules
from ..operators import enrich
from ..plans import dashboard as db
from ..sources.fixtures import AS_OF
from .base import query, rnd
from .operational import BANDS_SQL, PREDICTED_SQL

query(
    "status_kpis",
    f"""select count(*) as total_lights, count(*) filter (where status = 'operational') as operational,
    count(*) filter (where status = 'faulty') as faulty, count(*) filter (where status = 'maintenance_required') as maintenance_required,
    {rnd("100.0*count(*) filter (where status = 'operational')/count(*)", 1)} as operational_pct,
    {rnd("100.0*count(*) filter (where status = 'faulty')/count(*)", 1)} as faulty_pct from lights""",
)(db.status_kpis)
query(
    "zone_filter",
    "select light_id, neighborhood_name, status from lights_enriched where neighborhood_name in ('NATION_3', 'NATION_6')",
)(
    lambda t: db.zone_filter(enrich.lights_enriched(t, AS_OF), ["NATION_3", "NATION_6"]).select(
        "light_id", "neighborhood_name", "status"
    )
)
_NEAR = f"""select l.light_id, n.name as neighborhood, p.name as nearest_supplier, {rnd("p.meters/1000", 2)} as distance_km
    from lights l left join zones n on l.neighborhood_id = n.neighborhood_id join nearest_planar p on p.light_id = l.light_id
    where l.status = 'faulty'"""
query(
    "faulty_kpis",
    f"""select count(*) as faulty_lights, {rnd("100.0*count(*)/(select count(*) from lights)", 2)} as faulty_pct,
    {rnd("avg(distance_km)", 2)} as avg_distance_km from ({_NEAR})""",
)(db.faulty_kpis)
query(
    "faulty_filtered",
    f"select * from ({_NEAR}) where neighborhood in ('NATION_3', 'NATION_6', 'NATION_11') and distance_km <= 1.5",
)(
    lambda t: db.faulty_filtered(t, ["NATION_3", "NATION_6", "NATION_11"], 1.5).select(
        "light_id", "neighborhood", "nearest_supplier", "distance_km"
    )
)
query(
    "faulty_per_zone",
    """select n.name as neighborhood, count(*) as count from lights l join zones n on l.neighborhood_id = n.neighborhood_id
    where l.status = 'faulty' group by 1""",
)(db.faulty_per_zone)
query(
    "urgency_counts",
    f"""select count(*) filter (where maintenance_urgency = 'CRITICAL') as critical, count(*) filter (where maintenance_urgency = 'HIGH') as high,
    count(*) filter (where maintenance_urgency = 'MEDIUM') as medium, count(*) filter (where maintenance_urgency = 'LOW') as low
    from ({PREDICTED_SQL}) where maintenance_urgency in ('CRITICAL', 'HIGH')""",
)(lambda t: db.urgency_counts(t, AS_OF, levels=["CRITICAL", "HIGH"]))
query(
    "failure_timeline", f"select predicted_failure_date, count(*) as count from ({PREDICTED_SQL}) group by 1"
)(lambda t: db.failure_timeline(t, AS_OF))
query(
    "distance_bands",
    f"""select 'Within 5km' as distance_range, within_5km as number_of_lights from ({BANDS_SQL})
    union all select '5-10km', within_10km - within_5km from ({BANDS_SQL}) union all select 'Beyond 10km', beyond_10km from ({BANDS_SQL})""",
)(db.distance_bands)
query(
    "radius_histogram",
    """select cast(least(floor((service_radius_km - lo)/((hi-lo)/10.0)), 9) as bigint) as bin, count(*) as suppliers from suppliers,
    (select min(service_radius_km) as lo, max(service_radius_km) as hi from suppliers) group by 1""",
)(db.radius_histogram)
query("sample_lights")(db.sample_lights)
query(
    "sample_lights_check",
    "select least(500, count(*)) as rows, least(500, count(*)) as different, least(500, count(*)) as known from lights",
)(
    lambda t: db.sample_lights(t)
    .join(t.lights.select(F.col("light_id").alias("known_id")), F.col("light_id") == F.col("known_id"), "left")
    .agg(F.count("*").alias("rows"), F.count_distinct("light_id").alias("different"), F.count("known_id").alias("known"))
)
