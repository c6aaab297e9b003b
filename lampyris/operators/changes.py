"""Change-feed application on batch data: snapshot, latest version wins, soft deletes, freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def live_rows(df: DataFrame) -> DataFrame:
    """Rows not soft-deleted."""
    return df.where(~F.col("_deleted"))


def snapshot_load(df: DataFrame, loaded_at: Column) -> DataFrame:
    """Initial copy of a table with change metadata."""
    return df.withColumn("_deleted", F.lit(False)).withColumn("_updated_at", loaded_at)


def latest_changes(feed: DataFrame, key: str, version: str = "version") -> DataFrame:
    """The change with the highest version per key.

    ``max_by`` is combined map-side, so a key that owns a third of the feed sends one row per task; feed
    order and duplicates do not matter.
    """
    rest = [c for c in feed.columns if c not in (key, version)]
    return (
        feed.groupBy(key)
        .agg(F.max(F.struct(F.col(version), *[F.col(c) for c in rest])).alias("c"))
        .select(key, f"c.{version}", *[f"c.{c}" for c in rest])
    )


def apply_changes(state: DataFrame, feed: DataFrame, key: str = "light_id") -> DataFrame:
    """Fold a change feed into a table with change metadata.

    ``state`` carries ``_version``, ``_deleted``, ``_updated_at``; ``feed`` carries ``version``, ``op``
    (insert, update, delete), ``changed_at`` and some of the table's columns. The change with the highest
    version is the row's image for the columns the feed carries; other columns stay. A delete only marks
    the row, so its version still outranks late older changes. A change not newer than the row's version
    is ignored. Keys without a snapshot row appear as new rows. The result does not depend on how the
    feed is split or ordered.
    """
    latest = latest_changes(feed, key)
    payload = [c for c in feed.columns if c not in (key, "version", "op", "changed_at")]
    new = latest.select(
        key,
        F.col("version").alias("_n_version"),
        F.col("op").alias("_n_op"),
        F.col("changed_at").alias("_n_at"),
        *[F.col(c).alias(f"_n_{c}") for c in payload],
    )
    joined = state.join(new, key, "full")
    applies = F.col("_n_version").isNotNull() & (F.col("_version").isNull() | (F.col("_n_version") > F.col("_version")))
    columns: list[Column] = []
    for name in state.columns:
        if name == key:
            columns.append(F.col(key))
        elif name == "_version":
            columns.append(F.when(applies, F.col("_n_version")).otherwise(F.col("_version")).alias(name))
        elif name == "_deleted":
            columns.append(F.when(applies, F.col("_n_op") == "delete").otherwise(F.col("_deleted")).alias(name))
        elif name in ("_updated_at", "updated_at"):
            columns.append(F.when(applies, F.col("_n_at")).otherwise(F.col(name)).alias(name))
        elif name in payload:
            columns.append(F.when(applies, F.col(f"_n_{name}")).otherwise(F.col(name)).alias(name))
        else:
            columns.append(F.col(name))
    return joined.select(*columns)


def touch_updated_at(before: DataFrame, after: DataFrame, key: str, stamp: Column, watch: list[str]) -> DataFrame:
    """Set ``updated_at`` on rows of ``after`` whose watched columns differ from ``before``."""
    old = before.select(key, F.struct(*watch).alias("_old"))
    changed = F.col("_old").isNotNull() & ~F.struct(*watch).eqNullSafe(F.col("_old"))
    return (
        after.join(old, key, "left")
        .withColumn("updated_at", F.when(changed, stamp).otherwise(F.col("updated_at")))
        .drop("_old")
    )


def reconcile_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Join two (table_name, n) frames and flag differences."""
    return (
        source.select("table_name", F.col("n").alias("source_rows"))
        .join(target.select("table_name", F.col("n").alias("target_rows")), "table_name", "full")
        .withColumn("in_sync", F.col("source_rows").eqNullSafe(F.col("target_rows")))
    )


def pick_operational(lights: DataFrame, count: int, seed: int = 42) -> DataFrame:
    """``count`` operational lights in a seeded hash order: repeatable at any partitioning."""
    return (
        lights.where(F.col("status") == "operational")
        .orderBy(F.xxhash64("light_id", F.lit(seed)), "light_id")
        .limit(count)
    )


def fail_light(lights: DataFrame, now: Column, version: int, light_id=None, seed: int = 42) -> DataFrame:
    """One-row change set that sets a light to faulty; a random operational one when no id is given."""
    chosen = lights.where(F.col("light_id") == F.lit(light_id)) if light_id is not None else pick_operational(lights, 1, seed)
    return chosen.select(
        "light_id",
        F.lit(version).cast("bigint").alias("version"),
        F.lit("update").alias("op"),
        now.alias("changed_at"),
        F.lit("faulty").alias("status"),
        now.alias("last_maintenance"),
    )


def schedule_maintenance(lights: DataFrame, now: Column, version: int, count: int = 5, seed: int = 42) -> DataFrame:
    """Change set that marks random operational lights as needing maintenance."""
    return pick_operational(lights, count, seed).select(
        "light_id",
        F.lit(version).cast("bigint").alias("version"),
        F.lit("update").alias("op"),
        now.alias("changed_at"),
        F.lit("maintenance_required").alias("status"),
    )


def freshness(tables: dict[str, DataFrame], as_of_ts: Column) -> DataFrame:
    """Per table: rows changed on the reference day, in the last hour, and the latest change."""
    parts = [
        df.agg(
            F.count_if(F.to_date("_updated_at") == F.to_date(as_of_ts)).alias("changed_today"),
            F.count_if((F.col("_updated_at") > as_of_ts - F.expr("interval 1 hour")) & (F.col("_updated_at") <= as_of_ts)).alias(
                "changed_last_hour"
            ),
            F.max("_updated_at").alias("latest_change"),
        ).select(F.lit(name).alias("table_name"), "changed_today", "changed_last_hour", "latest_change")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
