"""Data-quality checks as (check_name, violations) tables. One scan per table where rules allow it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..plans.operational import one_row_counts
from ..sources.fixtures import Tables
from . import rings, spatial

# Keys, references, required columns, allowed values
PRIMARY_KEYS = {
    "zones": ["neighborhood_id"],
    "lights": ["light_id"],
    "requests": ["request_id"],
    "suppliers": ["supplier_id"],
    "weather": ["light_id", "season"],
    "demographics": ["neighborhood_id"],
    "power_grid": ["light_id"],
}
FOREIGN_KEYS = [
    ("lights", "neighborhood_id", "zones"),
    ("requests", "light_id", "lights"),
    ("weather", "light_id", "lights"),
    ("power_grid", "light_id", "lights"),
    ("demographics", "neighborhood_id", "zones"),
]
REQUIRED = {
    "zones": ["name", "ring"],
    "lights": ["lon", "lat", "status"],
    "requests": ["light_id", "reported_at", "description"],
    "suppliers": ["name", "lon", "lat"],
}
DOMAINS = {
    ("lights", "status"): rules.STATUSES,
    ("suppliers", "specialization"): rules.SPECIALIZATIONS,
    ("weather", "season"): rules.SEASONS,
    ("demographics", "urban_classification"): rules.URBAN_CLASSES,
}
EXPECTED_ROWS = {
    "zones": 50,
    "lights": 5000,
    "suppliers": 25,
    "requests": 1500,
    "weather": 15000,
    "demographics": 50,
    "power_grid": 5000,
}


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _conditions(t: Tables, checks: dict[str, dict[str, Column]]) -> DataFrame:
    """Count rows per condition, all conditions of a table in one scan."""
    parts = []
    for table, conditions in checks.items():
        counts = getattr(t, table).agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])
        rows = F.array(
            *[F.struct(F.lit(n).alias("check_name"), F.col(f"`{n}`").alias("violations")) for n in conditions]
        )
        parts.append(counts.select(F.inline(rows)))
    return union_all(parts)


def check_domain(t: Tables) -> DataFrame:
    return _conditions(t, {tab: {f"{tab}.{col}": ~F.col(col).isin(vals)} for (tab, col), vals in DOMAINS.items()})


def check_range(t: Tables) -> DataFrame:
    score = F.col("failure_risk_score")
    return _conditions(t, {"weather": {"weather.failure_risk_score": (score < 0) | (score > 1)}})


def check_not_null(t: Tables) -> DataFrame:
    return _conditions(t, {tab: {f"{tab}.{c}": F.col(c).isNull() for c in cols} for tab, cols in REQUIRED.items()})


def check_unique(t: Tables) -> DataFrame:
    """Keys that occur more than once, per table."""
    parts = []
    for table, key in PRIMARY_KEYS.items():
        repeated = getattr(t, table).groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 1)
        parts.append(repeated.agg(F.count("*").alias("violations")).select(F.lit(table).alias("check_name"), "violations"))
    return union_all(parts)


def check_fk(t: Tables) -> DataFrame:
    """Rows whose reference has no target, per relationship. NULL references are allowed.

    References are counted per key before the anti join, so a hot key travels once per task.
    """
    parts = []
    for child, column, parent in FOREIGN_KEYS:
        used = getattr(t, child).where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
        orphans = used.join(getattr(t, parent).select(column), column, "left_anti")
        parts.append(
            orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
                F.lit(f"{child}.{column}").alias("check_name"), "violations"
            )
        )
    return union_all(parts)


def check_spatial_integrity(t: Tables) -> DataFrame:
    """(light, zone) containments and lights outside every zone."""
    inside = spatial.lights_in_zones(t.lights, t.zones)
    pairs = inside.agg(F.count("*").alias("n"), F.count_distinct("light_id").alias("lights"))
    total = t.lights.agg(F.count("*")).scalar()
    return pairs.select(
        F.col("n").alias("lights_within_neighborhoods"), (total - F.col("lights")).alias("lights_outside_neighborhoods")
    )


def enrichment_coverage(t: Tables) -> DataFrame:
    return t.weather.agg(F.count_distinct("light_id").alias("lights_with_weather")).select(
        "lights_with_weather",
        t.power_grid.agg(F.count_distinct("light_id")).scalar().alias("lights_with_power_grid"),
        t.demographics.agg(F.count_distinct("neighborhood_id")).scalar().alias("neighborhoods_with_demographics"),
        t.lights.agg(F.count("*")).scalar().alias("total_lights"),
        t.zones.agg(F.count("*")).scalar().alias("total_neighborhoods"),
    )


def history_length(t: Tables, min_days: int = 30) -> DataFrame:
    day = F.to_date("reported_at")
    return t.requests.agg((F.datediff(F.max(day), F.min(day)) + 1).alias("days")).withColumn("enough", F.col("days") >= min_days)


def polygon_validity(t: Tables) -> DataFrame:
    """Unclosed and self-intersecting rings. Edges of large rings are only tested against those they share a cell with."""
    ring = F.col("ring")
    closed = (ring[0]["lon"] == F.element_at(ring, -1)["lon"]) & (ring[0]["lat"] == F.element_at(ring, -1)["lat"])
    # by their own rows, so that rings without an edge and large ones have one too
    basic = t.zones.select("neighborhood_id", F.size("ring").alias("ring_points"), closed.alias("is_closed"))
    shaped = spatial.shaped_rings(t.zones.select("neighborhood_id", "ring"))
    few = F.size("_edges") <= rings.SMALL_RING
    crossing = shaped.where(few).where(rings.crosses_itself("_edges")).select("neighborhood_id")
    large = rings.crossing_rings(shaped.where(~few), "neighborhood_id")
    found = crossing.union(large).distinct().withColumn("self_intersects", F.lit(True))
    return basic.join(found, "neighborhood_id", "left").select(
        "neighborhood_id", "ring_points", "is_closed", F.coalesce("self_intersects", F.lit(False)).alias("self_intersects")
    )


def name_duplicates(t: Tables) -> DataFrame:
    return t.zones.groupBy("name").agg(F.count("*").alias("zones")).where(F.col("zones") > 1)


def phase_status(phases: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """COMPLETE when a stage's table has rows, else its given fallback word."""
    parts = []
    for phase, (df, otherwise) in phases.items():
        one = df.limit(1).agg(F.count("*").alias("n"))
        parts.append(
            one.select(
                F.lit(f"Phase: {phase}").alias("phase"), F.when(F.col("n") > 0, F.lit("COMPLETE")).otherwise(F.lit(otherwise)).alias("status")
            )
        )
    return union_all(parts)


def expected_counts(t: Tables, expected: dict[str, int] | None = None) -> DataFrame:
    wanted = expected or EXPECTED_ROWS
    table = F.create_map(*[F.lit(x) for kv in wanted.items() for x in kv])
    return (
        one_row_counts(t, list(wanted))
        .withColumn("expected_rows", F.element_at(table, F.col("table_name")).cast("bigint"))
        .select("table_name", F.col("n").alias("actual_rows"), "expected_rows", (F.col("n") == F.col("expected_rows")).alias("matches"))
    )


