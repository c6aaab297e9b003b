"""Operational analytics: overview counts, status, spatial rankings, issue statistics, text search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, rules
from ..operators import enrich, spatial
from ..session import stored
from ..sources.fixtures import DOMAIN_TABLES, Tables

# Search patterns of the two text searches, the reference location of the radius search
HAZARD_PATTERNS = ["%danger%", "%hazard%", "%urgent%", "%exposed wire%", "%fire%", "%spark%", "%leaning%"]
FLICKER_PATTERNS = ["%flicker%", "%blink%", "%intermittent%", "%on and off%"]
CENTER_LON, CENTER_LAT = 77.62, 12.93


def _km(meters: Column) -> Column:
    return rules.round_half_up(meters / 1000, 2)


def _is(status: str) -> Column:
    return F.col("status") == status


def zone_names(t: Tables, alias: str = "neighborhood") -> DataFrame:
    return t.zones.select("neighborhood_id", F.col("name").alias(alias))


def one_row_counts(t: Tables, names: list[str]) -> DataFrame:
    """Row counts of several tables, one labelled row each."""
    parts = [getattr(t, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("table_name"), "n") for n in names]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def entity_counts(t: Tables) -> DataFrame:
    counts = one_row_counts(t, ["zones", "lights", "suppliers"]).select(
        F.element_at(
            F.create_map(
                F.lit("zones"), F.lit("Neighborhoods"),
                F.lit("lights"), F.lit("Street Lights"),
                F.lit("suppliers"), F.lit("Suppliers"),
            ),
            F.col("table_name"),
        ).alias("entity"),
        F.col("n").cast("string").alias("count"),
    )
    open_requests = F.count_if(F.col("resolved_at").isNull())
    requests = (
        t.requests.agg(F.count("*").alias("total"), open_requests.alias("open"))
        .select(
            F.inline(
                F.array(
                    F.struct(F.lit("Maintenance Requests").alias("entity"), F.col("total").cast("string").alias("count")),
                    F.struct(F.lit("  └─ Open Requests").alias("entity"), F.col("open").cast("string").alias("count")),
                    F.struct(
                        F.lit("  └─ Closed Requests").alias("entity"),
                        (F.col("total") - F.col("open")).cast("string").alias("count"),
                    ),
                )
            )
        )
    )
    return counts.unionByName(requests)


def entity_counts_wide(t: Tables) -> DataFrame:
    """Four counts in one row."""
    counts = one_row_counts(t, ["zones", "lights", "suppliers", "requests"])
    return counts.groupBy().pivot("table_name", ["zones", "lights", "suppliers", "requests"]).agg(F.sum("n")).select(
        F.col("zones").alias("neighborhoods"),
        F.col("lights").alias("street_lights"),
        "suppliers",
        F.col("requests").alias("maintenance_requests"),
    )


def status_share(t: Tables, digits: int = 1) -> DataFrame:
    grouped = t.lights.groupBy("status").agg(F.count("*").alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return grouped.withColumn("percentage", rules.ratio_pct(F.col("count"), total, digits)).orderBy(F.desc("count"))


def faulty_by_zone_spatial(t: Tables, limit: int = 10) -> DataFrame:
    faulty = t.lights.where(_is("faulty"))
    counts = spatial.zone_light_counts(faulty, t.zones).select(F.col("zone_id").alias("neighborhood_id"), F.col("n").alias("faulty_lights"))
    return (
        t.zones.select("neighborhood_id", "name", "population")
        .join(counts, "neighborhood_id")
        .orderBy(F.desc("faulty_lights"), "neighborhood_id")
        .limit(limit)
        .select(
            F.col("name").alias("neighborhood"),
            "faulty_lights",
            "population",
            rules.round_half_up(F.col("population") / F.col("faulty_lights"), 0).alias("residents_per_faulty_light"),
        )
    )


def faulty_nearest_supplier(t: Tables, limit: int = 5) -> DataFrame:
    faulty = t.lights.where(_is("faulty")).select("light_id", "neighborhood_id", "lon", "lat")
    named = faulty.join(zone_names(t), "neighborhood_id")
    return (
        spatial.nearest_supplier(named, t.suppliers)
        .withColumn("distance_km", _km(F.col("distance_m")))
        .orderBy(F.desc("distance_km"), "light_id")
        .limit(limit)
        .select("light_id", "neighborhood", F.col("supplier_name").alias("nearest_supplier"), "specialization", "distance_km", "avg_response_hours")
    )


def faulty_nearest_supplier_all(t: Tables) -> DataFrame:
    faulty = t.lights.where(_is("faulty")).select("light_id", "neighborhood_id", "lon", "lat", "status")
    named = faulty.join(zone_names(t), "neighborhood_id", "left")
    return (
        spatial.nearest_supplier(named, t.suppliers)
        .select(
            "light_id",
            F.col("lon").alias("longitude"),
            F.col("lat").alias("latitude"),
            "status",
            "neighborhood",
            F.col("supplier_name").alias("nearest_supplier"),
            "specialization",
            _km(F.col("distance_m")).alias("distance_km"),
            "avg_response_hours",
            "contact_phone",
        )
        .orderBy("distance_km", "light_id")
    )


def faulty_nearest_geodesic(t: Tables) -> DataFrame:
    """Nearest supplier by metres instead of degrees."""
    faulty = t.lights.where(_is("faulty")).select("light_id", "lon", "lat")
    return spatial.nearest_supplier(faulty, t.suppliers, metric="geodesic").select(
        "light_id", "supplier_name", "contact_phone", _km(F.col("distance_m")).alias("distance_km")
    )


def nearest_supplier_table(t: Tables) -> DataFrame:
    """Nearest supplier of every light, with the columns of the lookup function."""
    return spatial.nearest_supplier(t.lights.select("light_id", "lon", "lat"), t.suppliers).select(
        "light_id", "supplier_id", "supplier_name", _km(F.col("distance_m")).alias("distance_km"),
        "contact_phone", "avg_response_hours", "specialization",
    )


def nearest_supplier_of(t: Tables, light_id) -> DataFrame:
    """The lookup for one light: its location is a scalar, the suppliers are read once for the best row.

    No light but the wanted one is read, and nothing depends on where the suppliers are. Ties go to the smaller id; an
    unknown light, or one without a location, has no row.
    """
    place = t.lights.where((F.col("light_id") == F.lit(light_id)) & F.col("lon").isNotNull() & F.col("lat").isNotNull())
    place = place.agg(F.first(F.struct("lon", "lat"))).scalar()
    there = t.suppliers.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).withColumn("_p", place).where(F.col("_p").isNotNull())
    apart = geo.planar_sq(F.col("_p.lon"), F.col("_p.lat"), F.col("lon"), F.col("lat"))
    best = there.orderBy(apart, "supplier_id").limit(1)
    meters = geo.lambert_m(F.col("_p.lon"), F.col("_p.lat"), F.col("lon"), F.col("lat"))
    return best.select(
        "supplier_id", F.col("name").alias("supplier_name"), _km(meters).alias("distance_km"), "contact_phone", "avg_response_hours", "specialization",
    )


def register_nearest_supplier(t: Tables, name: str = "nearest_supplier") -> str:
    """SQL table function ``name(light_id)`` with six output columns, for joins with many lights.

    It looks into the nearest supplier of every light; for one light use ``nearest_supplier_of``.
    """
    view = f"v_{name}"
    table = nearest_supplier_table(t)
    table.createOrReplaceTempView(view)
    columns = [f for f in table.schema if f.name != "light_id"]
    returns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns)
    key_type = table.schema["light_id"].dataType.simpleString()
    t.spark.sql(
        f"create or replace temporary function {name}(p_light_id {key_type}) returns table ({returns}) "
        f"return select {', '.join(f.name for f in columns)} from {view} where light_id = p_light_id"
    )
    return name


def highest_risk_lights(t: Tables, as_of: rules.AsOf = None, limit: int = 10) -> DataFrame:
    return (
        enrich.lights_enriched(t, as_of)
        .where(F.col("failure_risk_score").isNotNull())
        .orderBy(F.desc("failure_risk_score"), F.asc_nulls_last("predicted_failure_date"), "light_id")
        .limit(limit)
        .select(
            "light_id", "neighborhood_name", "status", "season",
            F.col("failure_risk_score").cast("double").alias("failure_risk_score"),
            "predicted_failure_date", "maintenance_urgency", "days_since_maintenance",
        )
    )


def supplier_coverage_counts(t: Tables, limit: int = 10) -> DataFrame:
    counts = spatial.coverage_counts(t.suppliers, t.lights)
    wide = counts.groupBy("supplier_id").agg(
        F.sum("n").alias("lights_in_range"),
        F.sum(F.when(_is("faulty"), F.col("n"))).alias("faulty_in_range"),
        F.sum(F.when(_is("maintenance_required"), F.col("n"))).alias("maintenance_needed_in_range"),
    )
    return (
        t.suppliers.select("supplier_id", F.col("name").alias("supplier"), "specialization", "service_radius_km")
        .join(wide, "supplier_id", "left")
        .na.fill(0, ["lights_in_range", "faulty_in_range", "maintenance_needed_in_range"])
        .orderBy(F.desc("faulty_in_range"), F.desc("lights_in_range"), "supplier_id")
        .limit(limit)
        .drop("supplier_id")
    )


def zone_infrastructure(t: Tables, limit: int = 10) -> DataFrame:
    per_zone = t.lights.groupBy("neighborhood_id").agg(
        F.count("light_id").alias("total_lights"),
        F.count_if(_is("operational")).alias("operational"),
        F.count_if(~_is("operational")).alias("needs_attention"),
    )
    zones = t.zones.select("neighborhood_id", F.col("name").alias("neighborhood")).join(
        t.demographics.select("neighborhood_id", "urban_classification", F.col("population_density").alias("pop_density_per_sqkm")),
        "neighborhood_id",
        "left",
    )
    return (
        zones.join(per_zone, "neighborhood_id", "left")
        .na.fill(0, ["total_lights", "operational", "needs_attention"])
        .withColumn("operational_pct", rules.ratio_pct(F.col("operational"), F.col("total_lights"), 1))
        .orderBy(F.asc_nulls_last("operational_pct"), "neighborhood_id")
        .limit(limit)
        .drop("neighborhood_id")
    )


def issue_resolution(t: Tables) -> DataFrame:
    hours = rules.elapsed_hours(F.col("reported_at"), F.col("resolved_at"))
    return (
        t.requests.groupBy("issue_type")
        .agg(
            F.count("*").alias("total_requests"),
            F.count_if(F.col("resolved_at").isNull()).alias("open_requests"),
            rules.round_half_up(F.avg(hours), 1).alias("avg_resolution_hours"),
            rules.round_half_up(F.max(hours), 1).alias("max_resolution_hours"),
        )
        .orderBy(F.desc("total_requests"))
    )


def grid_zone_impact(t: Tables) -> DataFrame:
    return (
        t.power_grid.join(t.lights.select("light_id", "status"), "light_id")
        .groupBy("grid_zone")
        .agg(
            F.count("light_id").alias("total_lights"),
            rules.round_half_up(F.avg("avg_load_percent"), 1).alias("avg_grid_load_pct"),
            rules.round_half_up(F.avg("outage_history_count"), 1).alias("avg_outages"),
            F.count_if(_is("faulty")).alias("faulty_lights"),
        )
        .withColumn("faulty_pct", rules.ratio_pct(F.col("faulty_lights"), F.col("total_lights"), 1))
        .orderBy(F.desc_nulls_first("faulty_pct"), "grid_zone")
    )


def keyword_search(t: Tables, patterns: list[str], limit: int = 10, preview: int = 60) -> DataFrame:
    """Newest requests whose description matches any pattern, case-insensitively.

    Requests without a known light do not qualify. Matches are cut to the newest ``limit`` before the
    zone names are attached.
    """
    hits = (
        t.requests.where(rules.ilike_any(F.col("description"), patterns))
        .join(t.lights.select("light_id", "neighborhood_id"), "light_id")
        .orderBy(F.desc_nulls_first("reported_at"), "request_id")
        .limit(limit)
    )
    return hits.join(zone_names(t), "neighborhood_id", "left").select(
        "request_id",
        "light_id",
        "neighborhood",
        "issue_type",
        rules.preview(F.col("description"), preview).alias("description_preview"),
        rules.request_status(F.col("resolved_at")).alias("status"),
    )


def lights_near(t: Tables, lon: float = CENTER_LON, lat: float = CENTER_LAT, radius_m: float = 1000, limit: int | None = 10) -> DataFrame:
    near = spatial.near_point(t.lights.select("light_id", "status", "wattage", "neighborhood_id", "lon", "lat"), lon, lat, radius_m)
    near = near.withColumn("distance_meters", rules.round_half_up(F.col("distance_m"), 0)).orderBy("distance_meters", "light_id")
    if limit:
        near = near.limit(limit)
    return near.join(zone_names(t), "neighborhood_id", "left").select(
        "light_id", "status", "wattage", "neighborhood", "distance_meters"
    )


def all_lights(t: Tables, as_of: rules.AsOf = None) -> DataFrame:
    return (
        enrich.lights_enriched(t, as_of)
        .select(
            "light_id", F.col("lon").alias("longitude"), F.col("lat").alias("latitude"), "status",
            "neighborhood_name", "wattage", "season",
            F.col("failure_risk_score").cast("double").alias("failure_risk_score"),
            "predicted_failure_date", "maintenance_urgency", "age_months", "days_since_maintenance",
        )
        .orderBy("light_id")
    )


def all_suppliers(t: Tables) -> DataFrame:
    return t.suppliers.select(
        "supplier_id", "name", F.col("lon").alias("longitude"), F.col("lat").alias("latitude"),
        "service_radius_km", "avg_response_hours", "specialization", "contact_phone",
    ).orderBy("name", "supplier_id")


def predicted_failures(t: Tables, as_of: rules.AsOf = None, days: int = 30) -> DataFrame:
    return (
        enrich.lights_enriched(t, as_of)
        .where(F.col("predicted_failure_date") <= F.date_add(rules.as_of_date(as_of), days))
        .where(~_is("faulty"))
        .select(
            "light_id", F.col("lon").alias("longitude"), F.col("lat").alias("latitude"), "status",
            "neighborhood_name", "predicted_failure_date",
            F.col("failure_risk_score").cast("double").alias("failure_risk_score"),
            "maintenance_urgency", "age_months", "days_since_maintenance", "season",
        )
        .orderBy("predicted_failure_date", "light_id")
    )


def zone_stats(t: Tables) -> DataFrame:
    """Spatial light counts by status, merged over zones that share a name."""
    counts = spatial.zone_light_counts(t.lights, t.zones)
    named = t.zones.select(F.col("neighborhood_id").alias("zone_id"), F.col("name").alias("neighborhood"))
    n = F.coalesce("n", F.lit(0))

    def by(status: str) -> Column:
        return F.sum(F.when(_is(status), n).otherwise(0))

    return (
        named.join(counts, "zone_id", "left")
        .groupBy("neighborhood")
        .agg(
            F.sum(n).alias("total_lights"),
            by("operational").alias("operational"),
            by("maintenance_required").alias("maintenance_required"),
            by("faulty").alias("faulty"),
        )
        .withColumn("faulty_percentage", rules.ratio_pct(F.col("faulty"), F.col("total_lights"), 2))
        .orderBy(F.desc("faulty"), F.desc("total_lights"))
    )


def seasonal_patterns(t: Tables) -> DataFrame:
    order = F.when(F.col("season") == "monsoon", 1).when(F.col("season") == "summer", 2).when(F.col("season") == "winter", 3)
    return (
        enrich.requests_enriched(t)
        .where(F.col("resolved_at").isNotNull())
        .groupBy("season")
        .agg(F.count("*").alias("request_count"), rules.round_half_up(F.avg("resolution_hours"), 6).alias("avg_resolution_hours"))
        .orderBy(order.asc_nulls_last())
    )


def nearest_km(t: Tables) -> DataFrame:
    """Kilometres from every light to its closest supplier."""
    lights = t.lights.select("light_id", "lon", "lat")
    return spatial.nearest_supplier(lights, t.suppliers, metric="geodesic").select(
        "light_id", (F.col("distance_m") / 1000).alias("nearest_supplier_km")
    )


def supplier_coverage_bands(t: Tables) -> DataFrame:
    km = F.col("nearest_supplier_km")
    return nearest_km(t).agg(
        F.count("*").alias("total_lights"),
        F.count_if(km <= 5).alias("within_5km"),
        F.count_if(km <= 10).alias("within_10km"),
        F.count_if(km > 10).alias("beyond_10km"),
        rules.round_half_up(F.avg(km), 2).alias("avg_distance_km"),
    )


def zone_centroids(t: Tables) -> DataFrame:
    """Area-weighted zone centres. ``inline`` keeps the ring arithmetic from being copied into every use."""
    return t.zones.select("neighborhood_id", "name", F.inline(F.array(geo.centroid(F.col("ring")))))


def zone_nearest_supplier(t: Tables) -> DataFrame:
    """Zone centroid to nearest supplier name; suppliers equal after rounding to 0.01 km all appear.

    The k-nearest join finds each zone's closest distance; a radius join of that distance plus the
    rounding step collects the ties.
    """
    centers = zone_centroids(t).withColumnRenamed("name", "neighborhood")
    nearest = spatial.knn_join(
        centers.withColumnRenamed("neighborhood_id", "zone_id"),
        t.suppliers.select("supplier_id", "lon", "lat"),
        "zone_id",
        "supplier_id",
        metric="geodesic",
    ).withColumn("_r", geo.lambert_m(F.col("lon"), F.col("lat"), F.col("r_lon"), F.col("r_lat")) + 11)
    # one row for each zone, which the radius join reads several times
    around = stored(spatial.as_centers(nearest, "zone_id", "neighborhood", "_r"), "nearest")
    ties = spatial.spatial_join_dwithin(
        around,
        t.suppliers.select(F.col("name").alias("nearest_supplier"), "specialization", "lon", "lat"),
        F.col("_r"),
    )
    per_name = ties.groupBy("zone_id", "neighborhood", "nearest_supplier", "specialization").agg(
        _km(F.min("distance_m")).alias("distance_km")
    )
    closest = F.rank().over(Window.partitionBy("zone_id").orderBy("distance_km"))
    lights = spatial.zone_light_counts(t.lights, t.zones).groupBy("zone_id").agg(F.sum("n").alias("lights_in_neighborhood"))
    return (
        per_name.withColumn("_rank", closest)
        .where(F.col("_rank") == 1)
        .drop("_rank")
        .join(lights, "zone_id", "left")
        .na.fill(0, ["lights_in_neighborhood"])
        .orderBy(F.desc("distance_km"))
    )


def zone_light_counts_spatial(t: Tables, limit: int = 10) -> DataFrame:
    counts = spatial.zone_light_counts(t.lights, t.zones)
    named = t.zones.select(F.col("neighborhood_id").alias("zone_id"), "name")
    return (
        named.join(counts, "zone_id", "left")
        .groupBy("name")
        .agg(F.sum(F.coalesce("n", F.lit(0))).alias("light_count"))
        .orderBy(F.desc("light_count"), "name")
        .limit(limit)
    )


def request_summary(t: Tables) -> DataFrame:
    return t.requests.agg(
        F.count("*").alias("total_requests"),
        F.count_if(F.col("resolved_at").isNull()).alias("open_requests"),
        F.count_if(F.col("resolved_at").isNotNull()).alias("closed_requests"),
    )


def specialization_counts(t: Tables) -> DataFrame:
    return t.suppliers.groupBy("specialization").agg(F.count("*").alias("count")).orderBy(F.desc("count"))


def faulty_sample(t: Tables, as_of: rules.AsOf = None, limit: int = 5) -> DataFrame:
    return (
        enrich.lights_enriched(t, as_of)
        .where(_is("faulty"))
        .orderBy("light_id")
        .limit(limit)
        .select(
            "light_id", "status", "neighborhood_name", "season",
            F.col("failure_risk_score").cast("double").alias("failure_risk_score"), "maintenance_urgency",
        )
    )


def table_row_counts(t: Tables) -> DataFrame:
    return one_row_counts(t, DOMAIN_TABLES).select("table_name", F.col("n").alias("row_count")).orderBy("table_name")


def high_risk_view(t: Tables, as_of: rules.AsOf = None, threshold: str = "0.7", limit: int = 10) -> DataFrame:
    return (
        enrich.lights_enriched(t, as_of)
        .where(F.col("failure_risk_score") > F.lit(threshold).cast("decimal(3,2)"))
        .orderBy(F.asc_nulls_last("predicted_failure_date"), "light_id")
        .limit(limit)
        .select(
            "light_id", "neighborhood_name",
            F.col("failure_risk_score").cast("double").alias("failure_risk_score"), "predicted_failure_date",
        )
    )
