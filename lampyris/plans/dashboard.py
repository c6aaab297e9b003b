"""Figures behind the dashboard: KPIs, filters, bands, histograms, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo, rules
from ..operators import spatial
from ..sources.fixtures import Tables
from . import operational as op


def status_kpis(t: Tables) -> DataFrame:
    def n(status: str):
        return F.count_if(F.col("status") == status)

    return t.lights.agg(
        F.count("*").alias("total_lights"),
        n("operational").alias("operational"),
        n("faulty").alias("faulty"),
        n("maintenance_required").alias("maintenance_required"),
    ).select(
        "*",
        rules.ratio_pct(F.col("operational"), F.col("total_lights"), 1).alias("operational_pct"),
        rules.ratio_pct(F.col("faulty"), F.col("total_lights"), 1).alias("faulty_pct"),
    )


def zone_filter(df: DataFrame, names: list[str], column: str = "neighborhood_name") -> DataFrame:
    """Keep the listed zones; an empty list keeps everything."""
    return df.where(F.col(column).isin(names)) if names else df


def faulty_kpis(t: Tables) -> DataFrame:
    faulty = op.faulty_nearest_supplier_all(t).agg(
        F.count("*").alias("faulty_lights"), rules.round_half_up(F.avg("distance_km"), 2).alias("avg_distance_km")
    )
    total = t.lights.agg(F.count("*")).scalar()
    return faulty.select("faulty_lights", rules.ratio_pct(F.col("faulty_lights"), total, 2).alias("faulty_pct"), "avg_distance_km")


def faulty_filtered(t: Tables, names: list[str], max_km: float = 20.0) -> DataFrame:
    return zone_filter(op.faulty_nearest_supplier_all(t), names, "neighborhood").where(F.col("distance_km") <= max_km)


def faulty_per_zone(t: Tables) -> DataFrame:
    """Faulty lights per zone name. Lights without a zone have no bar."""
    faulty = t.lights.where(F.col("status") == "faulty").groupBy("neighborhood_id").agg(F.count("*").alias("n"))
    return (
        faulty.join(op.zone_names(t), "neighborhood_id")
        .groupBy("neighborhood")
        .agg(F.sum("n").alias("count"))
        .orderBy(F.desc("count"))
    )


def urgency_counts(t: Tables, as_of: rules.AsOf = None, days: int = 30, levels: list[str] | None = None) -> DataFrame:
    due = op.predicted_failures(t, as_of, days)
    if levels:
        due = due.where(F.col("maintenance_urgency").isin(levels))
    return due.agg(*[F.count_if(F.col("maintenance_urgency") == u).alias(u.lower()) for u in rules.URGENCIES])


def failure_timeline(t: Tables, as_of: rules.AsOf = None, days: int = 30) -> DataFrame:
    return (
        op.predicted_failures(t, as_of, days)
        .groupBy("predicted_failure_date")
        .agg(F.count("*").alias("count"))
        .orderBy("predicted_failure_date")
    )


def distance_bands(t: Tables) -> DataFrame:
    """Three exclusive bands from the cumulative coverage figures."""
    bands = [
        ("Within 5km", F.col("within_5km")),
        ("5-10km", F.col("within_10km") - F.col("within_5km")),
        ("Beyond 10km", F.col("beyond_10km")),
    ]
    rows = F.array(*[F.struct(F.lit(n).alias("distance_range"), c.alias("number_of_lights")) for n, c in bands])
    return op.supplier_coverage_bands(t).select(F.inline(rows))


def radius_histogram(t: Tables, bins: int = 10) -> DataFrame:
    """Suppliers per equal-width radius bin; radii are counted first, so only distinct values are binned."""
    per_radius = t.suppliers.groupBy("service_radius_km").agg(F.count("*").alias("n"))
    span = t.suppliers.agg(F.struct(F.min("service_radius_km").alias("lo"), F.max("service_radius_km").alias("hi"))).scalar()
    lo, hi = F.col("span.lo"), F.col("span.hi")
    width = (hi - lo) / bins
    raw = F.when(width == 0, 0).otherwise(F.floor((F.col("service_radius_km") - lo) / F.nullif(width, F.lit(0.0))))
    return (
        per_radius.withColumn("span", span)
        .withColumn("bin", F.least(raw, F.lit(bins - 1)).cast("bigint"))
        .groupBy("bin")
        .agg(F.sum("n").alias("suppliers"))
    )


def sample_lights(t: Tables, n: int = 500, seed: int = 42) -> DataFrame:
    """Fixed-seed sample: the same lights at any partitioning."""
    return (
        t.lights.select("light_id", "lon", "lat", "status")
        .orderBy(F.xxhash64("light_id", F.lit(seed)), "light_id")
        .limit(n)
    )


def status_palette(t: Tables) -> DataFrame:
    """Lights per status with the display colour."""
    return t.lights.groupBy("status").agg(F.count("*").alias("n")).withColumn(
        "color", rules.lookup(F.col("status"), rules.STATUS_COLORS)
    )


def metrics_wide(metrics: DataFrame, names: list[str]) -> DataFrame:
    """(metric, value) rows to one wide row."""
    return metrics.groupBy().pivot("metric", names).agg(F.first("value"))


def unpivot_totals(df: DataFrame, columns: dict[str, str], label: str = "component", value: str = "total") -> DataFrame:
    """Column sums as (label, value) rows."""
    totals = df.agg(*[F.sum(c).alias(c) for c in columns.values()])
    rows = F.array(*[F.struct(F.lit(k).alias(label), F.col(c).alias(value)) for k, c in columns.items()])
    return totals.select(F.inline(rows))


def zone_supplier_links(t: Tables) -> DataFrame:
    """Line from each zone's vertex mean to its nearest suppliers, with the label position and text."""
    centers = t.zones.select(F.col("neighborhood_id").alias("zone_id"), F.inline(F.array(geo.vertex_mean(F.col("ring"))))).select(
        "zone_id", F.col("lon").alias("zone_lon"), F.col("lat").alias("zone_lat")
    )
    sites = t.suppliers.select(
        F.col("name").alias("nearest_supplier"), F.col("lon").alias("supplier_lon"), F.col("lat").alias("supplier_lat")
    )
    return (
        op.zone_nearest_supplier(t)
        .join(centers, "zone_id")
        .join(sites, "nearest_supplier")
        .select(
            "zone_id", "neighborhood", "nearest_supplier", "distance_km",
            *[rules.round_half_up(F.col(c), 6).alias(c) for c in ("zone_lon", "zone_lat", "supplier_lon", "supplier_lat")],
            rules.round_half_up((F.col("zone_lon") + F.col("supplier_lon")) / 2, 6).alias("label_lon"),
            rules.round_half_up((F.col("zone_lat") + F.col("supplier_lat")) / 2, 6).alias("label_lat"),
        )
    )


def lights_in_named_zone(t: Tables, name: str) -> DataFrame:
    """Lights inside the zones of one name; the name filter goes first."""
    zones = t.zones.where(F.col("name") == name).select(F.col("neighborhood_id").alias("zone_id"), "ring")
    return spatial.spatial_join_within(t.lights.select("light_id", "status", "lon", "lat"), zones).select("light_id", "status", "zone_id")
