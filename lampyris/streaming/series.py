"""Daily request counts kept current as requests arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.series import ISSUE_COLUMNS
from .changes import fold_log, read_log, run_batches

_COUNTS = ("total", *ISSUE_COLUMNS)


def stream_daily_counts(requests: DataFrame, path: str, interval: str | None = None) -> StreamingQuery:
    """Each micro-batch adds its counts by day and light to the log; nothing is dropped, however late it is.

    There is no keyed state: readers add the batches up, and ``fold_daily`` shortens what they read. A retried batch
    replaces its folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        timed = batch.where("reported_at is not null").withColumn("ts", F.to_date("reported_at"))
        counts = timed.groupBy("ts", "light_id").agg(
            F.count("*").alias("total"),
            *[F.count_if(F.col("issue_type") == value).alias(name) for name, value in ISSUE_COLUMNS.items()],
        )
        counts.write.mode("overwrite").parquet(f"{path}/log/batch={batch_id}")

    return run_batches(requests.select("reported_at", "light_id", "issue_type"), path, write, mode="append", interval=interval)


def _by_light(log: DataFrame) -> DataFrame:
    return log.groupBy("ts", "light_id").agg(*[F.sum(c).alias(c) for c in _COUNTS])


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    """Counts and distinct lights per day, over everything that has arrived."""
    days = _by_light(read_log(spark, path)).groupBy("ts")
    return days.agg(*[F.sum(c).alias(c) for c in _COUNTS], F.count("light_id").alias("unique_lights_affected"))


def fold_daily(spark: SparkSession, path: str) -> None:
    """Add the batches so far up into one folder."""
    fold_log(spark, path, _by_light)
