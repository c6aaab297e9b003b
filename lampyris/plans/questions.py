"""Analytic questions over live rows, each a small operator."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, rules
from ..operators import enrich, spatial
from ..operators.changes import live_rows
from ..session import stored
from ..sources.fixtures import DOMAIN_TABLES, Tables

# Text patterns, parts per issue type
URGENT_PATTERNS = ["%urgent%", "%immediate%", "%danger%"]
WEATHER_PATTERNS = ["%rain%", "%storm%", "%flood%", "%water%", "%lightning%"]
PARTS = {"bulb_failure": "bulb", "wiring": "wiring_kit", "pole_damage": "pole"}


class LiveTables:
    """The domain tables without soft-deleted rows."""

    def __init__(self, t: Tables):
        self._t = t

    def __getattr__(self, name: str) -> DataFrame:
        if name in DOMAIN_TABLES:
            return live_rows(getattr(self._t, name))
        raise AttributeError(name)

    @cached_property
    def zone_names(self) -> DataFrame:
        return self.zones.select("neighborhood_id", F.col("name").alias("neighborhood_name"), "population")


def _requests_per_light(t: LiveTables) -> DataFrame:
    return t.requests.groupBy("light_id").agg(F.count("*").alias("n"))


def lights_by_zone_ranked(t: Tables) -> DataFrame:
    live = LiveTables(t)
    counts = live.lights.groupBy("neighborhood_id").agg(F.count("*").alias("light_count"))
    return live.zone_names.join(counts, "neighborhood_id").select(
        "neighborhood_id", "neighborhood_name", "light_count",
        F.rank().over(Window.orderBy(F.desc("light_count"))).alias("rank"),
    )


def avg_wattage(t: Tables) -> DataFrame:
    return LiveTables(t).lights.agg(rules.round_half_up(F.avg("wattage"), 4).alias("avg_wattage"))


def resolved_vs_open(t: Tables) -> DataFrame:
    return LiveTables(t).requests.agg(
        F.count_if(F.col("resolved_at").isNotNull()).alias("resolved"), F.count_if(F.col("resolved_at").isNull()).alias("still_open")
    )


def median_resolution_month(t: Tables, as_of: rules.AsOf = None) -> DataFrame:
    """Exact median hours of requests resolved in the reference month.

    Durations are whole minutes, so they are counted per minute first; the median then sees one weighted
    row per distinct duration instead of one row per request.
    """
    month = rules.month_start(rules.as_of_date(as_of))
    done = F.to_date("resolved_at")
    minutes = F.timestamp_diff("MINUTE", F.col("reported_at"), F.col("resolved_at"))
    return (
        LiveTables(t)
        .requests.where((done >= month) & (done < F.add_months(month, 1)))
        .groupBy(minutes.alias("minutes"))
        .agg(F.count("*").alias("n"))
        .agg(
            F.sum("n").alias("resolved"),
            rules.round_half_up(F.expr("percentile(minutes, 0.5, n)") / 60, 4).alias("median_hours"),
        )
    )


def risk_above_threshold(t: Tables, threshold: str = "0.7") -> DataFrame:
    return (
        LiveTables(t)
        .weather.where(F.col("failure_risk_score") > F.lit(threshold).cast("decimal(3,2)"))
        .agg(F.count_distinct("light_id").alias("lights_above"))
    )


def wettest_season(t: Tables) -> DataFrame:
    means = LiveTables(t).weather.groupBy("season").agg(F.avg("rainfall_mm").alias("rain"))
    return means.agg(F.max_by("season", "rain").alias("season"), rules.round_half_up(F.max("rain"), 2).alias("avg_rainfall"))


def outage_risk_correlation(t: Tables, as_of: rules.AsOf = None) -> DataFrame:
    live = LiveTables(t)
    weather = live.weather.where(F.col("season") == rules.as_of_season(as_of)).select("light_id", "failure_risk_score")
    joined = live.power_grid.select("light_id", "outage_history_count").join(weather, "light_id")
    return joined.agg(
        F.count("*").alias("lights"),
        rules.round_half_up(F.corr("outage_history_count", F.col("failure_risk_score").cast("double")), 6).alias("correlation"),
    )


def largest_coverage(t: Tables, limit: int = 10) -> DataFrame:
    return (
        LiveTables(t)
        .suppliers.select("supplier_id", "name", "specialization", "service_radius_km")
        .orderBy(F.desc("service_radius_km"), "supplier_id")
        .limit(limit)
    )


def population_per_light(t: Tables) -> DataFrame:
    live = LiveTables(t)
    counts = live.lights.groupBy("neighborhood_id").agg(F.count("*").alias("light_count"))
    return live.zone_names.join(counts, "neighborhood_id", "left").select(
        "neighborhood_id", "neighborhood_name", "population",
        F.coalesce("light_count", F.lit(0)).alias("light_count"),
        rules.round_half_up(F.col("population") / F.col("light_count"), 2).alias("population_per_light"),
    )


def density_vs_requests(t: Tables) -> DataFrame:
    live = LiveTables(t)
    per_zone = (
        _requests_per_light(live)
        .join(live.lights.select("light_id", "neighborhood_id"), "light_id")
        .groupBy("neighborhood_id")
        .agg(F.sum("n").alias("request_count"))
    )
    return (
        live.demographics.select("neighborhood_id", "population_density")
        .join(live.zone_names.select("neighborhood_id", "neighborhood_name"), "neighborhood_id")
        .join(per_zone, "neighborhood_id", "left")
        .na.fill(0, ["request_count"])
    )


def density_requests_correlation(t: Tables) -> DataFrame:
    return density_vs_requests(t).agg(
        rules.round_half_up(F.corr("population_density", "request_count"), 6).alias("correlation")
    )


def high_risk_nearest_supplier(t: Tables, as_of: rules.AsOf = None, threshold: str = "0.7") -> DataFrame:
    live = LiveTables(t)
    weather = live.weather.where(
        (F.col("season") == rules.as_of_season(as_of)) & (F.col("failure_risk_score") > F.lit(threshold).cast("decimal(3,2)"))
    ).select("light_id", "failure_risk_score")
    risky = live.lights.select("light_id", "lon", "lat").join(weather, "light_id")
    return spatial.nearest_supplier(risky, live.suppliers).select(
        "light_id", F.col("failure_risk_score").cast("double").alias("failure_risk_score"), "supplier_name", "contact_phone",
        rules.round_half_up(F.col("distance_m") / 1000, 2).alias("distance_km"),
    )


def urgent_in_populous_zones(t: Tables, min_population: int = 100000) -> DataFrame:
    live = LiveTables(t)
    crowded = live.zone_names.where(F.col("population") > min_population)
    lights = live.lights.select("light_id", "neighborhood_id").join(crowded, "neighborhood_id")
    return (
        live.requests.where(rules.ilike_any(F.col("description"), URGENT_PATTERNS))
        .select("request_id", "light_id", "issue_type")
        .join(lights, "light_id")
        .select("request_id", "light_id", "issue_type", "neighborhood_name", "population")
    )


def longest_waiting_faulty(t: Tables, as_of_ts: str, limit: int = 20) -> DataFrame:
    live = LiveTables(t)
    waiting = (
        live.requests.where(F.col("resolved_at").isNull())
        .groupBy("light_id")
        .agg(F.min("reported_at").alias("waiting_since"), F.count("*").alias("open_requests"))
    )
    return (
        live.lights.where(F.col("status") == "faulty")
        .select("light_id")
        .join(waiting, "light_id")
        .orderBy("waiting_since", "light_id")
        .limit(limit)
        .withColumn(
            "wait_hours", rules.round_half_up(rules.elapsed_hours(F.col("waiting_since"), F.lit(as_of_ts).cast("timestamp_ntz")), 2)
        )
    )


def weather_damage_outage_areas(t: Tables, min_avg_outages: float = 1.0) -> DataFrame:
    live = LiveTables(t)
    hits = (
        live.requests.where(rules.ilike_any(F.col("description"), WEATHER_PATTERNS))
        .groupBy("light_id")
        .agg(F.count("*").alias("n"))
    )
    grid = live.power_grid.select("light_id", "grid_zone", "outage_history_count").join(hits, "light_id", "left")
    return (
        grid.groupBy("grid_zone")
        .agg(
            F.sum(F.coalesce("n", F.lit(0))).alias("weather_requests"),
            F.sum("outage_history_count").alias("total_outages"),
            F.avg("outage_history_count").alias("_avg"),
        )
        .where(F.col("_avg") >= min_avg_outages)
        .withColumn("avg_outages", rules.round_half_up(F.col("_avg"), 2))
        .drop("_avg")
    )


def repeat_failures(t: Tables) -> DataFrame:
    """Lights with more than one request and their most common cause (ties: first in the alphabet)."""
    per_issue = LiveTables(t).requests.groupBy("light_id", "issue_type").agg(F.count("*").alias("n"))
    return (
        per_issue.groupBy("light_id")
        .agg(
            F.sum("n").alias("request_count"),
            F.min(F.struct((-F.col("n")).alias("neg"), F.col("issue_type"))).alias("top"),
        )
        .where(F.col("request_count") > 1)
        .select("light_id", "request_count", F.col("top.issue_type").alias("common_issue"))
    )


def request_trend(t: Tables) -> DataFrame:
    return (
        LiveTables(t)
        .requests.groupBy(rules.month_start(F.to_date("reported_at")).alias("month"))
        .agg(F.count("*").alias("request_count"))
        .orderBy("month")
    )


def maintenance_needed_pct(t: Tables) -> DataFrame:
    return (
        LiveTables(t)
        .lights.agg(F.count("*").alias("total_lights"), F.count_if(F.col("status") == "maintenance_required").alias("needing"))
        .withColumn("maintenance_pct", rules.ratio_pct(F.col("needing"), F.col("total_lights"), 2))
    )


def light_history(t: Tables, light_id) -> DataFrame:
    return (
        LiveTables(t)
        .requests.where(F.col("light_id") == F.lit(light_id))
        .select("request_id", "light_id", "reported_at", "resolved_at", "issue_type")
        .orderBy("reported_at", "request_id")
    )


def issue_by_zone(t: Tables, issue: str) -> DataFrame:
    live = LiveTables(t)
    per_light = live.requests.where(F.col("issue_type") == issue).groupBy("light_id").agg(F.count("*").alias("n"))
    return (
        per_light.join(live.lights.select("light_id", "neighborhood_id"), "light_id")
        .groupBy("neighborhood_id")
        .agg(F.sum("n").alias("request_count"))
        .join(live.zone_names.select("neighborhood_id", "neighborhood_name"), "neighborhood_id")
        .orderBy(F.desc("request_count"), "neighborhood_id")
    )


def open_by_issue(t: Tables, issue: str) -> DataFrame:
    return (
        LiveTables(t)
        .requests.where((F.col("issue_type") == issue) & F.col("resolved_at").isNull())
        .agg(F.count("*").alias("open_requests"))
    )


def requests_in_season(t: Tables, season: str) -> DataFrame:
    return LiveTables(t).requests.where(rules.season(F.to_date("reported_at")) == season).agg(F.count("*").alias("request_count"))


def failing_this_month(t: Tables, as_of: rules.AsOf = None) -> DataFrame:
    live = LiveTables(t)
    month = rules.month_start(rules.as_of_date(as_of))
    when = F.col("predicted_failure_date")
    due = live.weather.where(F.col("season") == rules.as_of_season(as_of)).where((when >= month) & (when < F.add_months(month, 1)))
    return due.select("light_id", "predicted_failure_date", F.col("failure_risk_score").cast("double").alias("failure_risk_score")).join(
        live.lights.select("light_id", "status"), "light_id"
    )


def dispatch_supplier(t: Tables, specialization: str | None = None) -> DataFrame:
    """Nearest supplier whose own radius covers the light.

    Mostly that is the nearest of all, which the k-nearest join finds without forming the pairs; the radius join goes on
    for lights whose nearest supplier does not reach them.
    """
    live = LiveTables(t)
    suppliers = live.suppliers.where(F.col("service_radius_km").isNotNull())
    if specialization:
        suppliers = suppliers.where(F.col("specialization").isin(specialization, "All"))
    columns = ["supplier_id", F.col("name").alias("supplier_name"), "avg_response_hours"]
    spot = F.struct("light_id", F.col("lon").alias("x"), F.col("lat").alias("y")).alias("spot")
    lights = live.lights.select(spot, "light_id", "lon", "lat")
    # whole rows are the keys: an id may come with several locations or radii
    right = suppliers.select(F.struct(*columns, "service_radius_km", F.col("lon").alias("x"), F.col("lat").alias("y")).alias("s"), "lon", "lat")
    nearest = spatial.knn_join(lights, right, "spot", "s", metric="geodesic")
    meters = geo.lambert_m(F.col("lon"), F.col("lat"), F.col("r_lon"), F.col("r_lat"))
    reached = nearest.select("spot", "s.*", meters.alias("distance_m")).where(F.col("distance_m") <= F.col("service_radius_km") * 1000)
    found = ["distance_m", "supplier_id", "supplier_name", "avg_response_hours"]
    settled = stored(reached.select("spot", *found), "dispatch")
    rest = lights.join(settled.select(F.col("spot").alias("_done")), F.col("spot").eqNullSafe(F.col("_done")), "left_anti").drop("spot")
    centers = spatial.as_centers(suppliers, *columns, "service_radius_km")
    pairs = spatial.spatial_join_dwithin(centers, rest, F.col("service_radius_km") * 1000)
    every = settled.select("spot.light_id", *found).unionByName(pairs.select("light_id", *found))
    best = every.groupBy("light_id").agg(F.min(F.struct(*found)).alias("b"))
    return best.select(
        "light_id", F.col("b.supplier_id").alias("supplier_id"), F.col("b.supplier_name").alias("supplier_name"),
        F.col("b.avg_response_hours").alias("avg_response_hours"),
        rules.round_half_up(F.col("b.distance_m") / 1000, 2).alias("distance_km"),
    )


def parts_for_open_requests(t: Tables) -> DataFrame:
    """Parts for pending repairs; issue types that need no part are left out."""
    return (
        LiveTables(t)
        .requests.where(F.col("resolved_at").isNull())
        .groupBy("issue_type")
        .agg(F.count("*").alias("quantity"))
        .withColumn("part", rules.lookup(F.col("issue_type"), PARTS))
        .where(F.col("part").isNotNull())
        .select("part", "quantity")
    )


def electrician_repairs(t: Tables) -> DataFrame:
    return (
        LiveTables(t)
        .requests.where(F.col("issue_type").isin("wiring", "power_supply") & F.col("resolved_at").isNull())
        .select("request_id", "light_id", "issue_type", "reported_at")
        .orderBy("reported_at", "request_id")
    )
