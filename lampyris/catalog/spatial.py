"""Registered spatial operators (GEO family)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, rules
from ..operators import spatial
from ..plans import dashboard as db
from ..plans import operational as op
from ..sources import geotext
from .base import lambert_sql, query, rnd
from .operational import CENTROID_SQL, ZONE_NEAREST_SQL, near_sql



def _r(column, digits):
    return rules.round_half_up(column, digits)


query("st_x_st_y", "select light_id, lon as longitude, lat as latitude from lights")(
    lambda t: t.lights.select("light_id", F.col("lon").alias("longitude"), F.col("lat").alias("latitude"))
)


@query("make_point", "select supplier_id, lon as x, lat as y, 4326 as srid from suppliers")
def make_point(t):
    point = F.struct(F.col("lon").alias("x"), F.col("lat").alias("y"), F.lit(4326).alias("srid"))
    return t.suppliers.select("supplier_id", point.alias("p")).select("supplier_id", "p.x", "p.y", "p.srid")


@query(
    "geo_distance_m",
    f"""select light_id, {rnd(lambert_sql('lon', 'lat', '7.762e1', '1.293e1'), 3)} as lambert_m,
    {rnd("2*6371008.8*asin(sqrt(power(sin(radians(1.293e1-lat)/2),2)+cos(radians(lat))*cos(radians(1.293e1))*power(sin(radians(7.762e1-lon)/2),2)))", 3)} as haversine_m
    from lights""",
)
def geo_distance_m(t):
    center = F.lit(op.CENTER_LON), F.lit(op.CENTER_LAT)
    return t.lights.select(
        "light_id",
        _r(geo.distance_m(F.col("lon"), F.col("lat"), *center), 3).alias("lambert_m"),
        _r(geo.distance_m(F.col("lon"), F.col("lat"), *center, method="haversine"), 3).alias("haversine_m"),
    )


@query(
    "planar_distance",
    f"select light_id, {rnd('sqrt((lon-7.762e1)*(lon-7.762e1)+(lat-1.293e1)*(lat-1.293e1))', 7)} as degrees from lights",
)
def planar_distance(t):
    d2 = geo.planar_sq(F.col("lon"), F.col("lat"), F.lit(op.CENTER_LON), F.lit(op.CENTER_LAT))
    return t.lights.select("light_id", _r(F.sqrt(d2), 7).alias("degrees"))


@query(
    "point_in_polygon",
    """select l.light_id, l.neighborhood_id, i.zone_id is not null as inside_own_zone from lights l
    join zones n on l.neighborhood_id = n.neighborhood_id left join inside i on i.light_id = l.light_id and i.zone_id = l.neighborhood_id""",
)
def point_in_polygon(t):
    zones = t.zones.select("neighborhood_id", "ring")
    return t.lights.join(zones, "neighborhood_id").select(
        "light_id", "neighborhood_id", geo.point_in_polygon(F.col("lon"), F.col("lat"), F.col("ring")).alias("inside_own_zone")
    )


@query(
    "polygon_centroid",
    f"select neighborhood_id, {rnd('cx', 6)} as lon, {rnd('cy', 6)} as lat from ({CENTROID_SQL})",
)
def polygon_centroid(t):
    return op.zone_centroids(t).select("neighborhood_id", _r(F.col("lon"), 6).alias("lon"), _r(F.col("lat"), 6).alias("lat"))


@query(
    "vertex_mean_center",
    f"select neighborhood_id, {rnd('avg(x)', 6)} as lon, {rnd('avg(y)', 6)} as lat from zone_points group by 1",
)
def vertex_mean_center(t):
    centers = t.zones.select("neighborhood_id", F.inline(F.array(geo.vertex_mean(F.col("ring")))))
    return centers.select("neighborhood_id", _r(F.col("lon"), 6).alias("lon"), _r(F.col("lat"), 6).alias("lat"))


@query(
    "segment_midpoint",
    f"""select l.light_id, {rnd('(l.lon + s.lon)/2', 6)} as mid_lon, {rnd('(l.lat + s.lat)/2', 6)} as mid_lat
    from lights l join nearest_planar p on p.light_id = l.light_id join suppliers s on s.supplier_id = p.supplier_id""",
)
def segment_midpoint(t):
    near = spatial.nearest_supplier(t.lights.select("light_id", "lon", "lat"), t.suppliers)
    return near.select(
        "light_id", _r((F.col("lon") + F.col("r_lon")) / 2, 6).alias("mid_lon"), _r((F.col("lat") + F.col("r_lat")) / 2, 6).alias("mid_lat")
    )


query("spatial_join_within", "select light_id, zone_id from inside")(
    lambda t: spatial.lights_in_zones(t.lights, t.zones).select("light_id", "zone_id")
)
query(
    "lights_outside_zones",
    "select light_id from lights where light_id not in (select light_id from inside)",
)(lambda t: spatial.lights_outside_zones(t.lights, t.zones).select("light_id"))


@query(
    "spatial_join_dwithin",
    f"select supplier_id, light_id, {rnd('meters', 2)} as distance_m from pairs where meters <= service_radius_km*1000",
)
def spatial_join_dwithin(t):
    centers = spatial.as_centers(t.suppliers, "supplier_id", "service_radius_km")
    lights = t.lights.select("light_id", "lon", "lat")
    pairs = spatial.spatial_join_dwithin(centers, lights, F.col("service_radius_km") * 1000, ["supplier_id", "light_id"])
    return pairs.select("supplier_id", "light_id", rules.round_many(F.col("distance_m"), 2).alias("distance_m"))


query("lights_near_point", near_sql("7.762e1", "1.293e1", 5000))(lambda t: op.lights_near(t, radius_m=5000, limit=None))


@query(
    "knn_join",
    f"""select light_id, supplier_id, cast(pos as int) as nn_rank, {rnd('meters', 2)} as distance_m from (
    select *, row_number() over (partition by light_id order by deg2, supplier_id) as pos from pairs) where pos <= 3""",
)
def knn_join(t):
    near = spatial.nearest_supplier(t.lights.select("light_id", "lon", "lat"), t.suppliers, k=3)
    return near.select("light_id", "supplier_id", "nn_rank", _r(F.col("distance_m"), 2).alias("distance_m"))


query(
    "nearest_by_rank",
    f"""select p.light_id, p.name as supplier_name, p.contact_phone, {rnd("p.meters/1000", 2)} as distance_km
    from nearest_geodesic p where p.status = 'faulty'""",
)(op.faulty_nearest_geodesic)


@query(
    "nearest_supplier",
    f"""select light_id, supplier_id, name as supplier_name, {rnd("meters/1000", 2)} as distance_km, contact_phone, avg_response_hours,
    specialization from nearest_planar""",
)
def nearest_supplier(t):
    return op.nearest_supplier_table(t)


@query(
    "nearest_supplier_function",
    f"""select supplier_id, name as supplier_name, {rnd("meters/1000", 2)} as distance_km, contact_phone, avg_response_hours,
    specialization from nearest_planar where light_id = 7""",
)
def nearest_supplier_function(t):
    """The lookup as a SQL table function."""
    name = op.register_nearest_supplier(t)
    return t.spark.sql(f"select * from {name}(7)")


query(
    "nearest_supplier_of_light",
    f"""select supplier_id, name as supplier_name, {rnd("meters/1000", 2)} as distance_km, contact_phone, avg_response_hours,
    specialization from nearest_planar where light_id = 7""",
)(lambda t: op.nearest_supplier_of(t, 7))
query("nearest_distance", f"select light_id, {rnd('min(meters)/1000', 4)} as nearest_supplier_km from pairs group by 1")(
    lambda t: op.nearest_km(t).select("light_id", _r(F.col("nearest_supplier_km"), 4).alias("nearest_supplier_km"))
)


@query(
    "distance_to_one",
    f"""select a.light_id as light_1, b.light_id as light_2, {rnd(lambert_sql('a.lon', 'a.lat', 'b.lon', 'b.lat'), 2)} as distance_meters
    from lights a join lights b on a.light_id = 1 and b.light_id <> 1
    order by {lambert_sql('a.lon', 'a.lat', 'b.lon', 'b.lat')}, b.light_id limit 5""",
)
def distance_to_one(t, light_id: int = 1, limit: int = 5):
    """The lights closest to one light. Its location enters as a scalar; the scan keeps a top-k heap."""
    here = t.lights.where(F.col("light_id") == light_id).agg(F.first(F.struct("lon", "lat"))).scalar()
    return (
        t.lights.where(F.col("light_id") != light_id)
        .select("light_id", "lon", "lat", here.alias("p"))
        .withColumn("_d", geo.lambert_m(F.col("p.lon"), F.col("p.lat"), F.col("lon"), F.col("lat")))
        .orderBy("_d", "light_id")
        .limit(limit)
        .select(F.lit(light_id).cast("bigint").alias("light_1"), F.col("light_id").alias("light_2"), _r(F.col("_d"), 2).alias("distance_meters"))
    )


query(
    "lights_in_named_zone",
    """select l.light_id, l.status, i.zone_id from inside i join lights l on l.light_id = i.light_id
    join zones n on n.neighborhood_id = i.zone_id where n.name = 'NATION_6'""",
)(lambda t: db.lights_in_named_zone(t, "NATION_6"))

query(
    "zone_supplier_links",
    f"""with near as (select * from ({ZONE_NEAREST_SQL})),
    mean as (select neighborhood_id, avg(x) as mx, avg(y) as my from zone_points group by 1)
    select d.zone_id, d.neighborhood, d.nearest_supplier, d.distance_km, {rnd('m.mx', 6)} as zone_lon, {rnd('m.my', 6)} as zone_lat,
    {rnd('s.lon', 6)} as supplier_lon, {rnd('s.lat', 6)} as supplier_lat, {rnd('(m.mx + s.lon)/2', 6)} as label_lon,
    {rnd('(m.my + s.lat)/2', 6)} as label_lat from near d join mean m on m.neighborhood_id = d.zone_id
    join suppliers s on s.name = d.nearest_supplier""",
)(db.zone_supplier_links)
query(
    "uncovered_lights",
    """select light_id from lights where light_id not in (select light_id from pairs where meters <= service_radius_km*1000)""",
)(lambda t: spatial.uncovered_lights(t.lights, t.suppliers).select("light_id"))
query(
    "uncovered_lights_tight",
    "select light_id from lights where light_id not in (select light_id from pairs where meters <= service_radius_km*10)",
)(
    lambda t: spatial.uncovered_lights(
        t.lights, t.suppliers.withColumn("service_radius_km", F.col("service_radius_km").cast("double") / 100)
    ).select("light_id")
)

query(
    "map_url",
    """select light_id, 'https://www.google.com/maps?q=' || cast(lat as varchar) || ',' || cast(lon as varchar) as url,
    'https://www.google.com/maps/search/?api=1&query=' || cast(lat as varchar) || ',' || cast(lon as varchar) as search_url from lights""",
)(
    lambda t: t.lights.select(
        "light_id",
        rules.map_url(F.col("lat"), F.col("lon")).alias("url"),
        rules.map_url(F.col("lat"), F.col("lon"), "https://www.google.com/maps/search/?api=1&query=").alias("search_url"),
    )
)
query(
    "boundary_geojson",
    """select neighborhood_id, name, population, '{"type":"Polygon","coordinates":[[' ||
    string_agg('[' || cast(x as varchar) || ',' || cast(y as varchar) || ']', ',' order by i) || ']]}' as boundary_geojson
    from zone_points group by 1, 2, 3""",
)(lambda t: t.zones.select("neighborhood_id", "name", "population", geo.geojson(F.col("ring")).alias("boundary_geojson")))
