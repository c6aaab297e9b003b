"""Parts of a stored search index, the runs they are merged into, and the manifest that readers follow.

A stream adds a part for each batch. When ``fanout`` parts have gathered they become a run; ``fanout`` runs of one tier
become a run of the next, so every document is rewritten once a tier and the number of folders grows with the logarithm
of the batches. A merge keeps each document's newest version and forgets removed ones once nothing older can hold them.

A manifest version lists the runs; parts behind the last run are read as they are. Runs and manifests are never changed,
and what a merge replaces stays until the merge after the next, so a reader that began before it ends undisturbed.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .changes import latest_changes

FANOUT = 8
MANIFEST = "position int, name string, first int, last int, tier int"
SPREAD = 8  # tasks that share a bucket's postings


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    place, files = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def marks(spark: SparkSession, path: str) -> tuple:
    """Name, size and time of every file below a folder: they change when its tables are replaced."""
    place, files = _files(spark, path)
    found, out = files.listFiles(place, True), []
    while found.hasNext():
        status = found.next()
        out.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(out))


def delete(spark: SparkSession, path: str) -> None:
    place, files = _files(spark, path)
    files.delete(place, True)


def folder_numbers(spark: SparkSession, path: str, column: str) -> list[int]:
    """The numbers in the names ``column=number`` of a folder's subfolders."""
    return sorted(int(n.partition("=")[2]) for n in folders(spark, path) if n.startswith(f"{column}="))


def manifest(spark: SparkSession, path: str) -> tuple[int, list]:
    """Number and runs, oldest first, of the newest whole version; 0 and none before the first merge."""
    for version in reversed(folder_numbers(spark, f"{path}/manifest", "version")):
        place, files = _files(spark, f"{path}/manifest/version={version}/_SUCCESS")
        if files.exists(place):
            return version, spark.read.schema(MANIFEST).parquet(f"{path}/manifest/version={version}").orderBy("position").collect()
    return 0, []


def parts_after(spark: SparkSession, path: str, last: int, below: int | None = None) -> list[int]:
    return [n for n in folder_numbers(spark, f"{path}/documents", "part") if n > last and (below is None or n < below)]


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def read(spark: SparkSession, path: str, key: str, runs: list, parts: list[int]) -> tuple[DataFrame, DataFrame]:
    """(postings, documents) of runs and parts, each row with its ``part``: the batch up to which it is known."""
    documents, postings = [], []
    for run in runs:
        documents.append(spark.read.parquet(f"{path}/runs/{run.name}/documents").withColumn("part", F.lit(run.last)))
    if parts:
        folder = f"{path}/documents"
        documents.append(spark.read.option("basePath", folder).parquet(*[f"{folder}/part={n}" for n in parts]))
    every = _union(documents)
    schema = f"term string, {key} {every.schema[key].dataType.simpleString()}, n_tokens int, tf bigint"
    for run in runs:
        postings.append(spark.read.schema(f"{schema}, bucket int").parquet(f"{path}/runs/{run.name}/postings").withColumn("part", F.lit(run.last)))
    if parts:
        folder = f"{path}/postings"
        postings.append(spark.read.schema(f"{schema}, part int, bucket int").option("basePath", folder).parquet(*[f"{folder}/part={n}" for n in parts]))
    return _union(postings), every


def read_live(spark: SparkSession, path: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Everything that the newest manifest stands for."""
    _, runs = manifest(spark, path)
    return read(spark, path, key, runs, parts_after(spark, path, runs[-1].last if runs else -1))


def pieces(spark: SparkSession, path: str) -> int:
    """How many runs and loose parts the newest manifest stands for."""
    _, runs = manifest(spark, path)
    return len(runs) + len(parts_after(spark, path, runs[-1].last if runs else -1))


def write_postings(postings: DataFrame, key: str, path: str) -> None:
    """Postings with their ``bucket``, in order of term; a common term's rows are written by several tasks."""
    write_sorted(postings.repartition("bucket", F.pmod(F.xxhash64(key), F.lit(SPREAD))), path)


def write_sorted(postings: DataFrame, path: str) -> None:
    """Postings as they are dealt, in order of bucket and term within each task."""
    postings.sortWithinPartitions("bucket", "term").write.mode("overwrite").partitionBy("bucket").parquet(path)


def _merge(spark: SparkSession, path: str, key: str, runs: list, parts: list[int], oldest: bool) -> tuple[str, int, int]:
    """Write one run of neighbouring runs or parts; with ``oldest`` nothing before it can hold a removed document."""
    postings, documents = read(spark, path, key, runs, parts)
    first, last = (runs[0].first, runs[-1].last) if runs else (parts[0], parts[-1])
    name = f"{first}-{last}-{uuid.uuid4().hex[:8]}"
    newest = latest_changes(documents, key, "part")
    kept = newest.where("not removed") if oldest else newest
    kept.drop("part").write.parquet(f"{path}/runs/{name}/documents")
    current = newest.where("not removed").select(key, "part")
    write_postings(postings.join(current, [key, "part"]).drop("part"), key, f"{path}/runs/{name}/postings")
    return name, first, last


def merge(spark: SparkSession, path: str, key: str, below: int | None = None, fanout: int = FANOUT) -> bool:
    """Merge what has gathered, parts under ``below`` only; whether there was anything to merge.

    One writer merges at a time. A batch that may still be repeated must not be under ``below``.
    """
    version, runs = manifest(spark, path)
    before = list(runs)
    loose = parts_after(spark, path, runs[-1].last if runs else -1, below)
    row = Row("position", "name", "first", "last", "tier")
    if len(loose) >= fanout:
        runs = [*runs, row(len(runs), *_merge(spark, path, key, [], loose, not runs), 0)]
    while len(runs) >= fanout and len({r.tier for r in runs[-fanout:]}) == 1:
        old, tail = runs[:-fanout], runs[-fanout:]
        runs = [*old, row(len(old), *_merge(spark, path, key, tail, [], not old), tail[0].tier + 1)]
    if runs == before:
        return False
    spark.createDataFrame([tuple(r) for r in runs], MANIFEST).coalesce(1).write.parquet(f"{path}/manifest/version={version + 1}")
    _forget(spark, path, version, {r.name for r in [*before, *runs]}, before[-1].last if before else -1)
    return True


def _forget(spark: SparkSession, path: str, version: int, named: set[str], last: int) -> None:
    """Delete what the version before the newest did not read any more."""
    for name in folders(spark, f"{path}/runs"):
        if name not in named:
            delete(spark, f"{path}/runs/{name}")
    for n in folder_numbers(spark, f"{path}/documents", "part"):
        if n <= last:
            delete(spark, f"{path}/documents/part={n}")
            delete(spark, f"{path}/postings/part={n}")
    for n in folder_numbers(spark, f"{path}/manifest", "version"):
        if n < version:
            delete(spark, f"{path}/manifest/version={n}")
