"""Session helpers shared by tests, the bench and the query catalogue."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lampyris", cores: str | int = "*", **extra: str) -> SparkSession:
    """A local session with the settings the operators are tuned for."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # keyed stream state beyond the executors' heap
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """A session in UTC, in which calendar rules are defined; the caller's session stays as it is."""
    if spark.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "Z", "+00:00"):
        return spark
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.session.timeZone", "UTC")
    return own


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` wins, then a checkpoint folder already set on the context. Only a local session without
    either gets a folder of its own, which goes when the process ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _own_folder()
    return os.path.join(root.rstrip("/"), f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what follows reads it any number of times."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="lampyris-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
