"""File and database sources and sinks with explicit schemas."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import geotext

# Column order of the CSV layouts
CSV_SCHEMAS = {
    "zones": "neighborhood_id STRING, name STRING, boundary STRING, population INT",
    "lights": (
        "light_id STRING, location STRING, status STRING, wattage INT, installation_date DATE,"
        " last_maintenance TIMESTAMP_NTZ, neighborhood_id STRING"
    ),
    "requests": (
        "request_id STRING, light_id STRING, reported_at TIMESTAMP_NTZ, resolved_at TIMESTAMP_NTZ,"
        " issue_type STRING, description STRING"
    ),
    "suppliers": (
        "supplier_id STRING, name STRING, location STRING, contact_phone STRING, service_radius_km INT,"
        " avg_response_hours INT, specialization STRING"
    ),
    "weather": (
        "light_id STRING, season STRING, avg_temperature_c DECIMAL(5,2), rainfall_mm DECIMAL(6,2),"
        " failure_risk_score DECIMAL(3,2), predicted_failure_date DATE"
    ),
    "demographics": "neighborhood_id STRING, population_density INT, urban_classification STRING",
    "power_grid": "light_id STRING, grid_zone STRING, avg_load_percent DECIMAL(5,2), outage_history_count INT",
}
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def scan_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Headered CSV, empty text is NULL, nothing inferred."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", "")
        .option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .option("multiLine", False)
        .option("escape", '"')
        .csv(path)
    )


def scan_layout(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """One of the seven CSV layouts with geometry text parsed and default columns filled."""
    df = scan_csv(spark, path, CSV_SCHEMAS[layout])
    if layout in ("lights", "suppliers"):
        df = df.withColumn("_p", geotext.try_point(F.col("location"))).select(
            *[c for c in df.columns if c != "location"], F.col("_p.lon").alias("lon"), F.col("_p.lat").alias("lat")
        )
    elif layout == "zones":
        df = df.withColumn(
            "ring", F.coalesce(geotext.polygon_from_wkt(F.col("boundary")), geotext.polygon_from_ewkb_hex(F.col("boundary")))
        ).drop("boundary")
    return default_columns(df, layout)


def default_columns(df: DataFrame, layout: str, load_ts: Column | None = None) -> DataFrame:
    """Columns a load leaves to their defaults: created_at, updated_at and the outage counter."""
    stamp = load_ts if load_ts is not None else F.current_timestamp().cast("timestamp_ntz")
    defaults: dict[str, Column] = {"created_at": stamp}
    if layout == "lights":
        defaults["updated_at"] = stamp
    if layout == "power_grid":
        defaults["outage_history_count"] = F.lit(0)
    for name, value in defaults.items():
        df = df.withColumn(name, F.coalesce(F.col(name), value) if name in df.columns else value)
    return df


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("timestampNTZFormat", TIMESTAMP_FORMAT).option("escape", '"').csv(path)


def materialize(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Snapshot a plan to parquet and read it back; later plans start from the files."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def register_views(views: dict[str, Callable[[], DataFrame] | DataFrame]) -> list[str]:
    """Register operators as temporary views so plain SQL can use them by name."""
    for name, source in views.items():
        (source if isinstance(source, DataFrame) else source()).createOrReplaceTempView(name)
    return sorted(views)


def scan_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 16,
    schema_path: str | None = None,
    **options: str,
) -> DataFrame:
    """Parallel read from an external database.

    With ``partition_column`` and ``bounds`` every executor reads its own key range; without, the query
    runs as one task. ``schema_path`` is set as the session's search path before reading.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if schema_path:
        reader = reader.option("sessionInitStatement", f"SET search_path TO {schema_path}")
    if partition_column and bounds:
        reader = (
            reader.option("dbtable", f"({query}) AS q")
            .option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    else:
        reader = reader.option("query", query)
    return reader.load()
