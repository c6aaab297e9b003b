"""Registered sources, sinks and generators (SRC, SNK, GEN families)."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geo
from ..session import shared_dir
from ..sources import files, geotext
from ..sources import generate as gen
from ..sources.fixtures import AS_OF, AS_OF_TS
from .base import query


@query("scan_tables", "select * from lights")
def scan_tables(t):
    return t.lights


@query(
    "scan_csv",
    """select cast(light_id as varchar) as light_id, status, wattage, installation_date, last_maintenance,
    cast(neighborhood_id as varchar) as neighborhood_id, lon, lat from lights""",
)
def scan_csv(t):
    """Lights written in the CSV layout and scanned back with the explicit schema."""
    path = shared_dir(t.spark, "csv-lights")
    rows = t.lights.select(
        F.col("light_id").cast("string"), geotext.point_to_wkt(F.col("lon"), F.col("lat")).alias("location"), "status", "wattage",
        "installation_date", "last_maintenance", F.col("neighborhood_id").cast("string"),
    )
    files.write_csv(rows, path)
    return files.scan_layout(t.spark, path, "lights").drop("created_at", "updated_at")


query(
    "default_columns",
    f"""select light_id, grid_zone, coalesce(outage_history_count, 0) as outage_history_count, timestamp '{AS_OF_TS}' as created_at from power_grid""",
)(
    lambda t: files.default_columns(
        t.power_grid.select("light_id", "grid_zone", "outage_history_count"), "power_grid", F.lit(AS_OF_TS).cast("timestamp_ntz")
    )
)


@query("point_from_wkt", "select light_id, lon, lat from lights")
def point_from_wkt(t):
    text = t.lights.select("light_id", geotext.point_to_wkt(F.col("lon"), F.col("lat")).alias("location"))
    return text.withColumn("p", geotext.point_from_wkt(F.col("location"))).select("light_id", "p.lon", "p.lat")


_RING_SQL = """string_agg(cast(cast(x as decimal(18,6)) as varchar) || ' ' || cast(cast(y as decimal(18,6)) as varchar), ';' order by i)"""
_POLY_SQL = f"""select neighborhood_id, cast(count(*) as int) as ring_points, {_RING_SQL} as ring, min(x) as min_lon, max(y) as max_lat
    from zone_points group by 1"""


def _poly(df):
    box = geo.ring_bbox(F.col("r"))
    return df.select("neighborhood_id", F.size("r").alias("ring_points"), geotext.ring_to_text(F.col("r")).alias("ring"), box.alias("b")).select(
        "neighborhood_id", "ring_points", "ring", "b.min_lon", "b.max_lat"
    )


@query("polygon_from_wkt", _POLY_SQL)
def polygon_from_wkt(t):
    text = t.zones.select("neighborhood_id", geotext.polygon_to_wkt(F.col("ring")).alias("boundary"))
    return _poly(text.withColumn("r", geotext.polygon_from_wkt(F.col("boundary"))))


@query("polygon_from_geojson", _POLY_SQL)
def polygon_from_geojson(t):
    text = t.zones.select("neighborhood_id", geo.geojson(F.col("ring")).alias("boundary"))
    return _poly(text.withColumn("r", geo.ring_from_geojson(F.col("boundary"))))


@F.pandas_udf(T.StringType())
def _point_hex(lon: pd.Series, lat: pd.Series) -> pd.Series:
    head = struct.pack("<BII", 1, 0x20000001, 4326)
    return pd.Series([(head + struct.pack("<dd", x, y)).hex().upper() for x, y in zip(lon, lat)])


@F.pandas_udf(T.StringType())
def _ring_hex(lons: pd.Series, lats: pd.Series) -> pd.Series:
    head = struct.pack("<BIII", 1, 0x20000003, 4326, 1)
    return pd.Series(
        [
            (head + struct.pack("<I", len(x)) + b"".join(struct.pack("<dd", a, b) for a, b in zip(x, y))).hex().upper()
            for x, y in zip(lons, lats)
        ]
    )


@query("point_from_ewkb_hex", "select light_id, lon, lat from lights")
def point_from_ewkb_hex(t):
    text = t.lights.select("light_id", _point_hex("lon", "lat").alias("location"))
    return text.withColumn("p", geotext.point_from_ewkb_hex(F.col("location"))).select("light_id", "p.lon", "p.lat")


@query("polygon_from_ewkb_hex", _POLY_SQL)
def polygon_from_ewkb_hex(t):
    text = t.zones.select("neighborhood_id", _ring_hex(F.col("ring.lon"), F.col("ring.lat")).alias("boundary"))
    return _poly(text.withColumn("r", geotext.polygon_from_ewkb_hex(F.col("boundary"))))


@query(
    "try_geography",
    """select light_id, case when status = 'faulty' then null else lon end as lon, case when status = 'faulty' then null else lat end as lat from lights""",
)
def try_geography(t):
    """Locations in mixed notations: hex, WKT, and text that is neither."""
    mixed = (
        F.when(F.col("status") == "faulty", F.concat(F.lit("POINT ("), F.col("lon").cast("string"), F.lit(")")))
        .when(F.col("status") == "operational", geotext.point_to_wkt(F.col("lon"), F.col("lat")))
        .otherwise(_point_hex("lon", "lat"))
    )
    return t.lights.select("light_id", mixed.alias("location")).withColumn("p", geotext.try_point(F.col("location"))).select(
        "light_id", "p.lon", "p.lat"
    )


@query("materialize", "select issue_type, request_id, light_id from requests")
def materialize(t):
    rows = t.requests.select("request_id", "light_id", "issue_type")
    return files.materialize(rows, shared_dir(t.spark, "snapshot"), ["issue_type"])


@query(
    "register_views",
    "select neighborhood_name, count(*) as lights, cast(max(failure_risk_score) as double) as max_risk from lights_enriched group by 1",
)
def register_views(t):
    """Operators as named views, queried with plain SQL."""
    from ..operators import enrich

    files.register_views(
        {"v_lights_enriched": lambda: enrich.lights_enriched(t, AS_OF), "v_requests_enriched": lambda: enrich.requests_enriched(t)}
    )
    return t.spark.sql(
        """select neighborhood_name, count(*) as lights, cast(max(failure_risk_score) as double) as max_risk
        from v_lights_enriched group by neighborhood_name"""
    )


# ---- shares of the attributes that the generators imitate

query(
    "gen_summary",
    """select 'status' as attribute, status as value, count(*) as rows from lights group by 2
    union all select 'issue_type', issue_type, count(*) from requests group by 2
    union all select 'season', case when month(reported_at) between 6 and 9 then 'monsoon' when month(reported_at) between 3 and 5 then 'summer'
      else 'winter' end as value, count(*) from requests group by 2
    union all select 'grid_zone', grid_zone, count(*) from power_grid group by 2
    union all select 'urban_classification', urban_classification, count(*) from demographics group by 2""",
)(lambda t: gen.gen_summary(t.lights, t.requests, t.power_grid, t.demographics))

