"""Verified questions over the change-tracked tables. Soft-deleted rows are left out.

Fact-side rows are pre-aggregated on their key before they meet a dimension, so one busy light or zone
costs one row per task in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..operators.changes import live_rows
from ..sources.fixtures import Tables


def lights_by_status(t: Tables) -> DataFrame:
    return live_rows(t.lights).groupBy("status").agg(F.count("*").alias("light_count")).orderBy(F.desc("light_count"))


def _live_zones(t: Tables) -> DataFrame:
    return live_rows(t.zones).select("neighborhood_id", F.col("name").alias("neighborhood_name"), "population")


def _lights_per_fk(t: Tables) -> DataFrame:
    return live_rows(t.lights).groupBy("neighborhood_id").agg(F.count("light_id").alias("n"))


def lights_per_zone(t: Tables) -> DataFrame:
    """Lights without a live zone drop out, as the filter on the zone side demands."""
    return (
        _lights_per_fk(t)
        .join(_live_zones(t), "neighborhood_id")
        .groupBy("neighborhood_name", "population")
        .agg(F.sum("n").alias("light_count"))
        .orderBy(F.desc("light_count"))
    )


def open_requests(t: Tables) -> DataFrame:
    return live_rows(t.requests).where(F.col("resolved_at").isNull()).agg(F.count("*").alias("open_requests"))


def issues_with_open(t: Tables) -> DataFrame:
    return (
        live_rows(t.requests)
        .groupBy("issue_type")
        .agg(
            F.count("*").alias("request_count"),
            F.sum(F.when(F.col("resolved_at").isNull(), 1).otherwise(0)).alias("still_open"),
        )
        .orderBy(F.desc("request_count"))
    )


def avg_resolution_by_issue(t: Tables) -> DataFrame:
    hours = rules.hours_crossed(F.col("reported_at"), F.col("resolved_at"))
    return (
        live_rows(t.requests)
        .where(F.col("resolved_at").isNotNull())
        .groupBy("issue_type")
        .agg(F.count("*").alias("resolved_count"), rules.round_half_up(F.avg(hours), 1).alias("avg_resolution_hours"))
        .orderBy(F.desc("avg_resolution_hours"))
    )


def requests_per_zone_name(t: Tables) -> DataFrame:
    per_light = (
        live_rows(t.requests)
        .groupBy("light_id")
        .agg(F.count("request_id").alias("total"), F.count_if(F.col("resolved_at").isNull()).alias("open"))
    )
    return (
        per_light.join(live_rows(t.lights).select("light_id", "neighborhood_id"), "light_id")
        .groupBy("neighborhood_id")
        .agg(F.sum("total").alias("total"), F.sum("open").alias("open"))
        .join(_live_zones(t), "neighborhood_id")
        .groupBy("neighborhood_name")
        .agg(F.sum("total").alias("total_requests"), F.sum("open").alias("open_requests"))
        .orderBy(F.desc("total_requests"))
    )


def high_risk_lights(t: Tables, threshold: str = "0.7", limit: int = 20) -> DataFrame:
    risky = live_rows(t.weather).where(F.col("failure_risk_score") >= F.lit(threshold).cast("decimal(3,2)"))
    lights = live_rows(t.lights).select("light_id", F.col("status").alias("current_status"), "neighborhood_id")
    return (
        risky.select("light_id", "season", "failure_risk_score", "predicted_failure_date")
        .join(lights, "light_id")
        .orderBy(F.desc("failure_risk_score"), "light_id", "season")
        .limit(limit)
        .join(t.zones.select("neighborhood_id", F.col("name").alias("neighborhood")), "neighborhood_id", "left")
        .select(
            "light_id", "current_status", "neighborhood", "season",
            F.col("failure_risk_score").cast("double").alias("risk_score"),
            F.col("predicted_failure_date").alias("predicted_failure"),
        )
    )


def risk_by_season(t: Tables) -> DataFrame:
    return (
        live_rows(t.weather)
        .groupBy("season")
        .agg(
            rules.round_half_up(F.avg("failure_risk_score"), 2).alias("avg_risk_score"),
            rules.round_half_up(F.avg("avg_temperature_c"), 1).alias("avg_temperature"),
            rules.round_half_up(F.avg("rainfall_mm"), 1).alias("avg_rainfall"),
            F.count("*").alias("light_count"),
        )
        .orderBy(F.desc("avg_risk_score"))
    )


def outages_by_grid_zone(t: Tables) -> DataFrame:
    return (
        live_rows(t.power_grid)
        .groupBy("grid_zone")
        .agg(
            F.count("*").alias("light_count"),
            rules.round_half_up(F.avg("avg_load_percent"), 1).alias("avg_load_pct"),
            F.sum("outage_history_count").alias("total_outages"),
        )
        .orderBy(F.desc("total_outages"))
    )


def supplier_response(t: Tables) -> DataFrame:
    return (
        live_rows(t.suppliers)
        .select(F.col("name").alias("supplier_name"), "specialization", "service_radius_km", "avg_response_hours")
        .orderBy("avg_response_hours", "supplier_name")
    )


def suppliers_by_specialization(t: Tables) -> DataFrame:
    return (
        live_rows(t.suppliers)
        .groupBy("specialization")
        .agg(
            F.count("*").alias("supplier_count"),
            rules.round_half_up(F.avg("avg_response_hours"), 1).alias("avg_response_time"),
            rules.round_half_up(F.avg("service_radius_km"), 1).alias("avg_service_radius"),
        )
        .orderBy(F.desc("supplier_count"))
    )


def lights_by_urban_class(t: Tables, dedup: bool = False) -> DataFrame:
    """Zones, population and lights per urban class.

    The established figures count a zone's population and density once per light; the pre-aggregated
    light counts are used as weights to reproduce them. ``dedup`` counts each zone once instead.
    """
    zones = (
        live_rows(t.demographics)
        .select("neighborhood_id", "population_density", "urban_classification")
        .join(_live_zones(t), "neighborhood_id")
        .join(_lights_per_fk(t), "neighborhood_id")
    )
    weight = F.lit(1) if dedup else F.col("n")
    density = F.sum(F.col("population_density").cast("bigint") * weight) / F.sum(weight)
    return (
        zones.groupBy(F.col("urban_classification").alias("classification"))
        .agg(
            F.count_distinct("neighborhood_id").alias("neighborhood_count"),
            F.sum(F.col("population").cast("bigint") * weight).alias("total_population"),
            rules.round_half_up(density, 0).alias("avg_density"),
            F.sum("n").alias("total_lights"),
        )
        .orderBy(F.desc("total_lights"))
    )


def recent_changes(t: Tables, as_of: rules.AsOf = None) -> DataFrame:
    """Rows per table whose last change was synced on the reference day."""
    today = rules.as_of_date(as_of)

    def changed(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count_if(F.to_date("_updated_at") == today).alias("records_modified")).select(
            F.lit(name).alias("table_name"), "records_modified"
        )

    return (
        changed("street_lights", t.lights)
        .unionByName(changed("maintenance_requests", t.requests))
        .orderBy(F.desc("records_modified"))
    )


def power_by_zone(t: Tables) -> DataFrame:
    per_fk = (
        live_rows(t.lights)
        .where(F.col("status") == "operational")
        .groupBy("neighborhood_id")
        .agg(F.count("light_id").alias("n"), F.sum("wattage").alias("w"))
    )
    return (
        per_fk.join(_live_zones(t), "neighborhood_id")
        .groupBy("neighborhood_name")
        .agg(F.sum("n").alias("light_count"), F.sum("w").alias("total_wattage_w"))
        .withColumn("total_wattage_kw", rules.round_half_up(F.col("total_wattage_w") / 1000, 2))
        .orderBy(F.desc("total_wattage_kw"))
    )


def _faulty_with_zone(t: Tables, null_tolerant: bool) -> DataFrame:
    """Live faulty lights with their zone name.

    Strict: lights need a live zone. Null-tolerant: lights without any zone stay, lights of a deleted zone go.
    """
    faulty = live_rows(t.lights).where(F.col("status") == "faulty")
    if not null_tolerant:
        return faulty.join(_live_zones(t), "neighborhood_id")
    zones = t.zones.select("neighborhood_id", F.col("name").alias("neighborhood_name"), F.col("_deleted").alias("_gone"))
    joined = faulty.join(zones, "neighborhood_id", "left")
    return joined.where(F.col("_gone").isNull() | ~F.col("_gone")).drop("_gone")


def faulty_locations(t: Tables) -> DataFrame:
    return (
        _faulty_with_zone(t, null_tolerant=False)
        .select("light_id", F.col("lon").alias("longitude"), F.col("lat").alias("latitude"), "neighborhood_name")
        .orderBy(F.asc_nulls_last("neighborhood_name"), "light_id")
    )


def common_issues(t: Tables) -> DataFrame:
    return (
        live_rows(t.requests).groupBy("issue_type").agg(F.count("*").alias("issue_count")).orderBy(F.desc_nulls_last("issue_count"))
    )


def faulty_by_zone_fk(t: Tables) -> DataFrame:
    return (
        _faulty_with_zone(t, null_tolerant=True)
        .groupBy("neighborhood_name")
        .agg(
            F.count("light_id").alias("faulty_light_count"),
            F.count_distinct("neighborhood_id").alias("neighborhoods_with_faulty_lights"),
        )
        .orderBy(F.desc_nulls_last("faulty_light_count"), F.asc_nulls_last("neighborhood_name"))
    )


def all_lights_status(t: Tables) -> DataFrame:
    return (
        live_rows(t.lights)
        .select(
            "light_id", "status", "neighborhood_id", F.col("lon").alias("longitude"), F.col("lat").alias("latitude"),
            "installation_date", "last_maintenance", "wattage",
        )
        .orderBy("status", "light_id")
    )


def faulty_locations_nullsafe(t: Tables) -> DataFrame:
    return (
        _faulty_with_zone(t, null_tolerant=True)
        .select("light_id", F.col("lon").alias("longitude"), F.col("lat").alias("latitude"), "neighborhood_name", "status")
        .orderBy(F.asc_nulls_last("neighborhood_name"), "light_id")
    )


# key -> (short name, question), in our own words: nothing depends on them
VERIFIED = {
    "lights_by_status": ("Status totals", "For each status, how many lights have it?"),
    "lights_per_zone": ("Lights in each zone", "How are the lights spread over the zones?"),
    "open_requests": ("Unresolved requests", "Which number of repair requests has not been resolved yet?"),
    "issues_with_open": ("Issue types with open cases", "How often does each issue type occur, and how many cases are open?"),
    "avg_resolution_by_issue": ("Repair hours by issue type", "How long does a repair take on average, by issue type?"),
    "requests_by_zone": ("Zones by requests", "In which zones do requests pile up?"),
    "high_risk_lights": ("Riskiest lights", "Which lights are the likeliest to fail?"),
    "risk_by_season": ("Risk in each season", "How does the mean failure risk differ between seasons?"),
    "outages_by_grid_zone": ("Grid zones by outages", "Where in the power grid have outages been frequent?"),
    "supplier_response": ("Suppliers by reaction time", "How fast does each supplier react?"),
    "suppliers_by_specialization": ("Suppliers in each trade", "How are suppliers divided among the trades?"),
    "lights_by_urban_class": ("Lights by kind of area", "How many lights stand in urban, suburban and rural areas?"),
    "recent_changes": ("Latest changes", "Which rows has the change feed touched since yesterday?"),
    "power_by_zone": ("Wattage of each zone", "How much power do the lights of each zone draw together?"),
    "faulty_locations": ("Places of faulty lights", "At which coordinates do faulty lights stand?"),
    "common_issues": ("Issue types by frequency", "Which issue types are reported the most?"),
    "faulty_by_zone_fk": ("Zones by faulty lights", "Count the faulty lights of each zone, most first."),
    "all_lights_status": ("Every light with its status", "List all lights and their status, whatever the date."),
    "faulty_locations_nullsafe": ("Faulty lights with their zone", "List faulty lights with place and zone, also those without a zone."),
}
