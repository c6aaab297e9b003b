"""Continuous change application with Structured Streaming.

Every micro-batch writes the highest version of each key it touched to its own folder, replacing that folder on a
retry, so the result is exactly-once after a restart. The stream keeps no keyed state: the highest version wins when the
log is read (which is insensitive to order and duplicates, and a delete stays as a tombstone with its version), and the
log is folded by the stream as it grows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import segments
from ..operators.changes import latest_changes
from ..sources.fixtures import PROJECTIONS, project


def read_table_stream(spark: SparkSession, path: str, name: str, max_files: int = 1000) -> DataFrame:
    """One raw table as an append-only file stream, schema taken from the stored files.

    The table may be a folder of files or a single file; the file source takes the latter only through a
    glob, hence the one-letter bracket.
    """
    table = f"{path.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(table).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(f"{table[:-1]}[t]")


def read_domain_stream(spark: SparkSession, path: str, name: str) -> DataFrame:
    return project(read_table_stream(spark, path, PROJECTIONS[name][0]), name)


def _drain_or_run(writer, interval: str | None) -> StreamingQuery:
    """Process what is there and stop, or keep running every ``interval``."""
    query = (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
    if not interval:
        query.awaitTermination()
    return query


def run_batches(
    stream: DataFrame, path: str, write: Callable[[DataFrame, int], None], mode: str = "update", interval: str | None = None
) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").foreachBatch(write)
    return _drain_or_run(writer, interval)


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Write each micro-batch to its own folder; a retried batch overwrites itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/log/batch={batch_id}")

    return write


def stream_apply(feed: DataFrame, path: str, key: str = "light_id", interval: str | None = None) -> StreamingQuery:
    """Maintain the latest change per key under ``path``.

    Each batch logs its own latest change per key and the stream keeps no state: the highest version wins when the log is
    read, however late it came. The stream folds the log itself (``fold_if_due``), so what is read is one row per key
    and a bounded number of batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        latest_changes(batch, key).write.mode("overwrite").parquet(f"{path}/log/batch={batch_id}")
        fold_if_due(batch.sparkSession, path, lambda log: latest_changes(log, key), below=batch_id)

    return run_batches(feed, path, write, mode="append", interval=interval)


def _batches(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def read_log(spark: SparkSession, path: str, last: int | None = None) -> DataFrame:
    """All that was logged under ``path`` (up to batch ``last``): the newest fold and the batches after it."""
    log, folds = spark.read.parquet(f"{path}/log"), _batches(spark, f"{path}/folds")
    if last is not None:
        log = log.where(F.col("batch") <= last)
    if folds is None:
        return log.drop("batch")
    upto = folds.agg(F.max("upto")).first()[0]
    rest = log.where(F.col("batch") > upto).drop("batch")
    return folds.where(F.col("upto") == upto).drop("upto").unionByName(rest)


def fold_if_due(
    spark: SparkSession, path: str, combine: Callable[[DataFrame], DataFrame], below: int, batches: int = 16, most: int = 256, share: float = 0.25
) -> bool:
    """Fold the batches under ``below`` when ``batches`` have gathered and hold ``share`` of the fold's rows, or ``most`` have.

    So a key is rewritten a number of times that grows with the logarithm of the log. What the fold before stood for
    is deleted then: readers of that one, which is still there, need it no more.
    """
    done, numbers = _folded(spark, path), segments.folder_numbers(spark, f"{path}/log", "batch")
    new = [n for n in numbers if done < n < below]
    if len(new) < batches:
        return False
    if len(new) < most and done >= 0:
        log = spark.read.parquet(*[f"{path}/log/batch={n}" for n in new])
        if log.count() < share * spark.read.parquet(f"{path}/folds/upto={done}").count():
            return False
    fold_log(spark, path, combine, below)
    for n in numbers:
        if n < done:
            segments.delete(spark, f"{path}/log/batch={n}")
    for n in segments.folder_numbers(spark, f"{path}/folds", "upto"):
        if n < done:
            segments.delete(spark, f"{path}/folds/upto={n}")
    return True


def _folded(spark: SparkSession, path: str) -> int:
    return max(segments.folder_numbers(spark, f"{path}/folds", "upto"), default=-1)


def fold_log(spark: SparkSession, path: str, combine: Callable[[DataFrame], DataFrame], below: int | None = None) -> None:
    """Combine the newest fold and the batches after it (under ``below``) into a fold of its own.

    Folds are added, never changed, so readers and a running stream are not disturbed. Batches below a fold are no
    longer read, and ``drop_folded`` deletes them.
    """
    numbers = [n for n in segments.folder_numbers(spark, f"{path}/log", "batch") if below is None or n < below]
    upto = max(numbers)
    combine(read_log(spark, path, upto)).write.mode("overwrite").parquet(f"{path}/folds/upto={upto}")


def drop_folded(spark: SparkSession, path: str) -> None:
    """Delete the batches and folds that the newest fold stands for; not while a reader still uses them.

    The newest folded batch stays, as the stream may repeat it after a failure.
    """
    upto = spark.read.parquet(f"{path}/folds").agg(F.max("upto")).first()[0]
    jvm = spark._jvm.org.apache.hadoop.fs
    for folder, column, below in ((f"{path}/log", "batch", upto), (f"{path}/folds", "upto", upto)):
        root = jvm.Path(folder)
        files = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        for status in files.listStatus(root):
            name = status.getPath().getName()
            if name.startswith(f"{column}=") and int(name.partition("=")[2]) < below:
                files.delete(status.getPath(), True)


def read_state(spark: SparkSession, path: str, key: str = "light_id") -> DataFrame:
    """Current state: the latest logged row per key. Tombstones are included (``op`` = delete)."""
    return latest_changes(read_log(spark, path), key)


def fold_state(spark: SparkSession, path: str, key: str = "light_id") -> None:
    """Keep only the latest row per key of the batches so far."""
    fold_log(spark, path, lambda log: latest_changes(log, key))
