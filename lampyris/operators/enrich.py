"""Enrichment star joins.

Lights and requests drive; every other side is joined by equality on its key. Zones and demographics
are small dimensions which Catalyst broadcasts while their files stay under the threshold; the
per-light sides shuffle on ``light_id``, and writers can bucket all of them by it.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..sources.fixtures import Tables

# Requests that a task of ``requests_enriched`` sorts, about, once there are many.
ROWS_PER_TASK = 250_000


def lights_enriched(t: Tables, as_of: rules.AsOf = None, season: str | None = None) -> DataFrame:
    """Lights with zone, weather of one season, demographics and grid context plus derived ages.

    ``season`` defaults to the season of ``as_of``.
    """
    today = rules.as_of_date(as_of)
    wanted = F.lit(season) if season else rules.season(today)
    zones = t.zones.select("neighborhood_id", F.col("name").alias("neighborhood_name"), "population")
    weather = t.weather.where(F.col("season") == wanted).select(
        "light_id", "season", "avg_temperature_c", "rainfall_mm", "failure_risk_score", "predicted_failure_date"
    )
    # demographics hang off the matched zone, not off the light's own key
    zones = zones.join(
        t.demographics.select("neighborhood_id", "population_density", "urban_classification"), "neighborhood_id", "left"
    )
    grid = t.power_grid.select("light_id", "grid_zone", "avg_load_percent", "outage_history_count")
    return (
        t.lights.join(weather, "light_id", "left")
        .join(grid, "light_id", "left")
        .join(zones, "neighborhood_id", "left")
        .withColumn("age_months", rules.age_months(F.col("installation_date"), today))
        .withColumn("days_since_maintenance", rules.age_day_part(F.col("last_maintenance"), today))
        .withColumn("days_since_maintenance_total", F.datediff(today, F.to_date("last_maintenance")))
        .withColumn("maintenance_urgency", rules.urgency(F.col("predicted_failure_date"), as_of))
    )


def requests_enriched(t: Tables) -> DataFrame:
    """Requests of known lights with zone and the weather of the season they were reported in.

    Each matching weather row gives a row, also if a light has several for one season.
    """
    lights = t.lights.select("light_id", "lon", "lat", "wattage", "neighborhood_id")
    zones = t.zones.select("neighborhood_id", F.col("name").alias("neighborhood_name"), "population")
    weather = t.weather.select(
        F.col("light_id").alias("_light"), "season", "failure_risk_score", "avg_temperature_c", "rainfall_mm"
    )
    requests = t.requests.drop("_deleted", "_updated_at").withColumn("_season", rules.season(F.to_date("reported_at")))
    # both joins sort; a task's share stays the same size however many requests there are
    tasks = math.ceil(t.requests.count() / ROWS_PER_TASK)
    many = tasks > int(t.requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lambda df, *keys: df.repartition(tasks, *keys) if many else df
    known = dealt(requests, "light_id").join(lights.join(zones, "neighborhood_id", "left"), "light_id")
    return (
        dealt(known, "light_id", "_season")
        .join(weather, (F.col("light_id") == F.col("_light")) & (F.col("_season") == F.col("season")), "left")
        .drop("_light", "_season")
        .withColumn("resolution_hours", rules.elapsed_hours(F.col("reported_at"), F.col("resolved_at")))
        .withColumn("status", rules.request_status(F.col("resolved_at")))
    )


def maintenance_searchable(t: Tables) -> DataFrame:
    """Search corpus: one row per request with a synthesised text and display attributes."""
    lights = t.lights.select(
        "light_id",
        "neighborhood_id",
        F.col("status").alias("light_status"),
        "wattage",
        F.col("lon").alias("longitude"),
        F.col("lat").alias("latitude"),
    )
    zones = t.zones.select(
        "neighborhood_id", F.col("name").alias("neighborhood_name"), F.col("population").alias("neighborhood_population")
    )
    text = F.concat(
        F.coalesce("description", F.lit("")),
        F.lit(" Location: "),
        F.coalesce("neighborhood_name", F.lit("Unknown")),
        F.lit("."),
        F.lit(" Light ID: "),
        F.col("light_id").cast("string"),
        F.lit("."),
        F.lit(" Issue type: "),
        F.coalesce("issue_type", F.lit("unknown")),
        F.lit("."),
    )
    return (
        t.requests.select("request_id", "light_id", "reported_at", "resolved_at", "issue_type", "description")
        .join(lights, "light_id", "left")
        .join(zones, "neighborhood_id", "left")
        .select(
            "request_id",
            "light_id",
            "reported_at",
            "resolved_at",
            "issue_type",
            text.alias("search_description"),
            F.col("description").alias("original_description"),
            "light_status",
            "wattage",
            "neighborhood_name",
            "neighborhood_population",
            "longitude",
            "latitude",
            rules.map_url(F.col("latitude"), F.col("longitude")).alias("google_maps_url"),
            rules.hours_crossed(F.col("reported_at"), F.col("resolved_at")).alias("resolution_hours"),
            rules.request_status(F.col("resolved_at")).alias("request_status"),
        )
    )
