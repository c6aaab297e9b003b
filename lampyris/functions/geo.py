"""Geometry as plain column math: points are two DOUBLEs, polygons a ring of (lon, lat) structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84 ellipsoid, mean earth radius
SEMI_MAJOR_M = 6378137.0
FLATTENING = 1 / 298.257223563
MEAN_RADIUS_M = 6371008.8
# Upper bound of the metres per degree of longitude or latitude anywhere on the ellipsoid.
MAX_M_PER_DEGREE = 111700.0
# Haversine and ellipsoidal distance differ by less than this share.
SPHERE_SLACK = 0.007


def planar_sq(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Squared distance in degrees; enough for ordering."""
    return (lon1 - lon2) * (lon1 - lon2) + (lat1 - lat2) * (lat1 - lat2)


def _sq(value: Column) -> Column:
    return value * value


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    h = _sq(F.sin((phi2 - phi1) / 2)) + F.cos(phi1) * F.cos(phi2) * _sq(F.sin(F.radians(lon2 - lon1) / 2))
    return 2 * MEAN_RADIUS_M * F.asin(F.least(F.sqrt(h), F.lit(1.0)))


def unit_vector(lon: Column, lat: Column) -> Column:
    """Direction of a point on the auxiliary sphere (reduced latitude), with the latitude's cosine.

    Worked out once per row before a join, it leaves one arc sine per pair.
    """
    beta = F.atan((1 - FLATTENING) * F.tan(F.radians(lat)))
    lam = F.radians(lon)
    c = F.cos(beta)
    return F.struct((c * F.cos(lam)).alias("x"), (c * F.sin(lam)).alias("y"), F.sin(beta).alias("z"), c.alias("c"))


def half_chord_sq(u: Column, v: Column) -> Column:
    """sin^2 of half the central angle between two unit vectors."""
    return (_sq(u["x"] - v["x"]) + _sq(u["y"] - v["y"]) + _sq(u["z"] - v["z"])) / 4


def vector_sphere_m(u: Column, v: Column) -> Column:
    """Distance on the auxiliary sphere; within SPHERE_SLACK of the ellipsoidal one."""
    return 2 * SEMI_MAJOR_M * F.asin(F.least(F.sqrt(half_chord_sq(u, v)), F.lit(1.0)))


def vector_m(u: Column, v: Column, half_chord: Column | None = None) -> Column:
    """Ellipsoidal metres (Lambert's long-line formula) between two unit vectors.

    With s the central angle, P and Q half sum and half difference of the reduced latitudes:
    d = a (s - f/2 ((s - sin s) sin^2 P cos^2 Q / cos^2(s/2) + (s + sin s) cos^2 P sin^2 Q / sin^2(s/2))),
    rearranged so that s is evaluated once. ``half_chord`` is ``half_chord_sq(u, v)`` where it is a column already.
    """
    raw = half_chord_sq(u, v) if half_chord is None else half_chord
    h = F.least(F.greatest(raw, F.lit(1e-30)), F.lit(1 - 1e-12))
    cos_sum = u["c"] * v["c"] - u["z"] * v["z"]
    sin2_q = (_sq(u["z"] - v["z"]) + _sq(u["c"] - v["c"])) / 4
    north = (1 - cos_sum) / 2 * (1 - sin2_q) / (1 - h)
    across = (1 + cos_sum) / 2 * sin2_q / h
    angle, sine = 2 * F.asin(F.sqrt(h)), 2 * F.sqrt(h * (1 - h))
    return SEMI_MAJOR_M * (angle * (1 - FLATTENING / 2 * (north + across)) + FLATTENING / 2 * sine * (north - across))


def lambert_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Ellipsoidal metres in closed form (within centimetres at city scale)."""
    return vector_m(unit_vector(lon1, lat1), unit_vector(lon2, lat2))


def distance_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column, method: str = "lambert") -> Column:
    return (lambert_m if method == "lambert" else haversine_m)(lon1, lat1, lon2, lat2)


def ring_edges(ring: Column) -> Column:
    """Consecutive vertex pairs of a closed ring."""
    n = F.size(ring)
    return F.zip_with(
        F.slice(ring, F.lit(1), n - 1),
        F.slice(ring, F.lit(2), n - 1),
        lambda a, b: F.struct(
            a["lon"].alias("x1"), a["lat"].alias("y1"), b["lon"].alias("x2"), b["lat"].alias("y2")
        ),
    )


def in_edges(lon: Column, lat: Column, edges: Column) -> Column:
    """Even-odd containment; points on the outline are outside."""

    def side(e: Column) -> Column:
        return (e["x2"] - e["x1"]) * (lat - e["y1"]) - (e["y2"] - e["y1"]) * (lon - e["x1"])

    def crosses(e: Column) -> Column:
        up = (e["y2"] > lat) & (e["y1"] <= lat)
        down = (e["y1"] > lat) & (e["y2"] <= lat)
        return (up & (side(e) > 0)) | (down & (side(e) < 0))

    def touches(e: Column) -> Column:
        return (
            (side(e) == 0)
            & lon.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & lat.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        )

    return (F.size(F.filter(edges, crosses)) % 2 == 1) & ~F.exists(edges, touches)


def point_in_polygon(lon: Column, lat: Column, ring: Column) -> Column:
    return in_edges(lon, lat, ring_edges(ring))


def ring_bbox(ring: Column) -> Column:
    lons, lats = F.transform(ring, lambda p: p["lon"]), F.transform(ring, lambda p: p["lat"])
    return F.struct(
        F.array_min(lons).alias("min_lon"),
        F.array_min(lats).alias("min_lat"),
        F.array_max(lons).alias("max_lon"),
        F.array_max(lats).alias("max_lat"),
    )


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def vertex_mean(ring: Column) -> Column:
    """Mean of all ring vertices, the closing one included."""
    n = F.size(ring)
    return F.struct(
        (_sum(F.transform(ring, lambda p: p["lon"])) / n).alias("lon"),
        (_sum(F.transform(ring, lambda p: p["lat"])) / n).alias("lat"),
    )


def centroid(ring: Column) -> Column:
    """Area-weighted centroid; the vertex mean when the ring has no area.

    Vertices are shifted to the first one so the shoelace terms keep their digits.
    """
    x0, y0 = ring[0]["lon"], ring[0]["lat"]
    edges = ring_edges(ring)

    def cross(e: Column) -> Column:
        return (e["x1"] - x0) * (e["y2"] - y0) - (e["x2"] - x0) * (e["y1"] - y0)

    area2 = _sum(F.transform(edges, cross))
    cx = _sum(F.transform(edges, lambda e: (e["x1"] + e["x2"] - 2 * x0) * cross(e)))
    cy = _sum(F.transform(edges, lambda e: (e["y1"] + e["y2"] - 2 * y0) * cross(e)))
    mean = vertex_mean(ring)
    return F.struct(
        F.when(area2 != 0, x0 + cx / (3 * F.nullif(area2, F.lit(0.0)))).otherwise(mean["lon"]).alias("lon"),
        F.when(area2 != 0, y0 + cy / (3 * F.nullif(area2, F.lit(0.0)))).otherwise(mean["lat"]).alias("lat"),
    )


def geojson(ring: Column) -> Column:
    """Polygon as GeoJSON text."""
    coords = F.array(F.transform(ring, lambda p: F.array(p["lon"], p["lat"])))
    return F.to_json(F.struct(F.lit("Polygon").alias("type"), coords.alias("coordinates")))


def ring_from_geojson(text: Column) -> Column:
    """Outer ring of a GeoJSON polygon, or of a multi-polygon's first part; NULL for anything else."""
    kind = F.get_json_object(text, "$.type")
    path = F.when(kind == "Polygon", F.get_json_object(text, "$.coordinates[0]")).when(
        kind == "MultiPolygon", F.get_json_object(text, "$.coordinates[0][0]")
    )
    points = F.from_json(path, "array<array<double>>")
    ring = F.transform(points, lambda p: F.struct(F.get(p, F.lit(0)).alias("lon"), F.get(p, F.lit(1)).alias("lat")))
    whole = F.forall(ring, lambda p: p["lon"].isNotNull() & p["lat"].isNotNull())
    return F.when(whole & (F.size(points) > 0), ring)
