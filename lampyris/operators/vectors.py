"""A stored vector index: trained cells, one byte for each dimension of what a cell's centre leaves, exact re-ranking.

Vectors are brought to length one. Cells are the clusters of a bounded sample (Spark ML's k-means); every vector goes to
its nearest centre, and what is left is coded in steps of a 255th of the dimension's range, so a score worked out from
codes is off by a known bound. A search reads the probed cells only, takes every vector whose coded score comes within
that bound of the k-th best, and ranks these by their original values: what it returns are the exact nearest of the
probed cells, and of all vectors if all cells are probed.

How many cells a search has to probe depends on how the vectors lie: it is measured on a few of them when the index is
built, so that searches reach the wanted recall.

Vectors that are null, zero, of another length, or hold a null or non-finite component are not indexed.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions import rules
from .search import SCORE_DIGITS

SAMPLE_PER_CELL = 64  # vectors that a cell's centre is trained on, about
MOST_CELLS = 4096
STEPS = 255
TUNING = 64
TASKS_PER_CORE = 2
SCORE_BLOCK = 1 << 20  # scores that are worked out at once
LAYOUT = "dims int, centres array<array<double>>, low array<double>, step array<double>, probes int"


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def _unit(vectors: DataFrame, key: str, column: str, dims: int | None = None) -> DataFrame:
    """(key, v) of usable vectors, in double precision and of length one."""
    v = F.transform(F.col(column), lambda x: x.cast("double"))
    rows = vectors.select(key, F.inline(F.array(F.struct(v.alias("_v"))))).where(F.col("_v").isNotNull())
    if dims is not None:
        rows = rows.where(F.size("_v") == dims)
    whole = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    rows = rows.where(whole).select(key, F.inline(F.array(F.struct(F.col("_v"), F.sqrt(_dot(F.col("_v"), F.col("_v"))).alias("_n")))))
    return rows.where((F.col("_n") > 0) & (F.col("_n") < F.lit(math.inf))).select(key, F.transform("_v", lambda x: x / F.col("_n")).alias("v"))


def _cells_near(centres, probes: int):
    """An Arrow function from vectors to the numbers of their nearest cells, nearest first."""

    def run(vectors: pa.Array) -> pa.Array:
        import numpy as np

        if not len(vectors):
            return pa.array([], pa.list_(pa.int32()))
        own = np.stack(vectors.to_numpy(zero_copy_only=False))
        c = np.array(centres)
        out = []
        for at in range(0, len(own), 1024):
            part = own[at : at + 1024]
            far = (c * c).sum(axis=1)[None, :] - 2 * part @ c.T  # the vectors' own lengths are all one
            order = far.argmin(axis=1)[:, None] if probes == 1 else np.argsort(far, axis=1, kind="stable")[:, :probes]
            out += order.astype(np.int32).tolist()
        return pa.array(out, pa.list_(pa.int32()))

    return F.arrow_udf(run, "array<int>")


def _scored(codes: DataFrame, placed: DataFrame, query_key: str, key: str, limit: int, dims: int) -> DataFrame:
    """(query_key, key, about, off): of each query and each batch of a cell's codes, what may be among the ``limit`` best.

    Rows are dealt by cell. A task has the queries of one cell at a time and its codes in batches, and multiplies blocks of
    both; what comes within the bound of a batch's own ``limit``-th best goes on, so nothing is lost for the best of all.
    """
    one = placed.select("cell", F.lit(0).alias("_side"), F.struct(query_key, "w", "base", "off").alias("_q"))
    other = codes.select("cell", F.lit(1).alias("_side"), F.struct(key, "code").alias("_v"))
    tasks = TASKS_PER_CORE * codes.sparkSession.sparkContext.defaultParallelism
    rows = one.unionByName(other, allowMissingColumns=True).repartition(tasks, "cell").sortWithinPartitions("cell", "_side")
    block = SCORE_BLOCK

    def score(queries, batch):
        import numpy as np

        codes = batch.column("code").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), dims) + 128.0
        w = queries.column("w").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(queries), dims)
        base, off = (queries.column(c).to_numpy() for c in ("base", "off"))
        width = max(1, block // len(codes))
        for at in range(0, len(w), width):
            about = w[at : at + width] @ codes.T + base[at : at + width, None]
            if len(codes) > limit:
                kth = np.partition(about, len(codes) - limit, axis=1)[:, len(codes) - limit]
                i, j = np.nonzero(about >= (kth - 2 * off[at : at + width])[:, None])
            else:
                i, j = (x.ravel() for x in np.indices(about.shape))
            columns = [queries.column(query_key).combine_chunks().take(pa.array(i + at)), batch.column(key).take(pa.array(j)), pa.array(about[i, j]), pa.array(off[i + at])]
            yield pa.RecordBatch.from_arrays(columns, names=[query_key, key, "about", "off"])

    def run(batches):
        import numpy as np

        cell, held, queries = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "_side")], axis=1)
            cuts = (np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()
            for at, end in zip([0, *cuts], [*cuts, len(keys)]):
                if keys[at, 0] != cell:
                    cell, held, queries = keys[at, 0], [], None
                if keys[at, 1] == 0:
                    held.append(pa.RecordBatch.from_struct_array(batch.column("_q").slice(at, end - at)))
                elif held:
                    queries = queries or pa.Table.from_batches(held).combine_chunks()
                    yield from score(queries, pa.RecordBatch.from_struct_array(batch.column("_v").slice(at, end - at)))

    schema = StructType([placed.schema[query_key], codes.schema[key], StructField("about", DoubleType()), StructField("off", DoubleType())])
    return rows.mapInArrow(run, schema)


def write_vector_index(vectors: DataFrame, key: str, column: str, path: str, cells: int | None = None, recall: float = 0.95, seed: int = 5) -> None:
    """Train and store the index of ``vectors`` below ``path``; about as many cells as the root of their number.

    Training takes SAMPLE_PER_CELL vectors a cell, MOST_CELLS cells at most, and TUNING vectors find how many cells to
    probe for ``recall``, whatever the number of vectors.
    """
    spark = vectors.sparkSession
    dims = vectors.select(F.max(F.size(column)).alias("n")).first().n or 0
    # however few files the vectors come in, what follows is dealt to all cores
    _unit(vectors.repartition(TASKS_PER_CORE * spark.sparkContext.defaultParallelism), key, column, dims).write.mode("overwrite").parquet(f"{path}/units")
    units = spark.read.parquet(f"{path}/units")
    n = units.count()
    cells = max(1, min(cells or math.isqrt(n), MOST_CELLS, n))
    share = min(1.0, 1.5 * cells * SAMPLE_PER_CELL / max(n, 1))
    sample = units.where(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000) + 1).limit(cells * SAMPLE_PER_CELL)
    centres = [[0.0] * dims]
    if n:
        trained = KMeans(k=cells, seed=seed, maxIter=10).fit(sample.select(array_to_vector("v").alias("features")))
        centres = [[float(x) for x in c] for c in trained.clusterCenters()]
    rows = spark.createDataFrame(list(enumerate(centres)), "cell int, centre array<double>")
    near = _cells_near(centres, 1)
    left = units.withColumn("cell", near("v")[0]).join(F.broadcast(rows), "cell")
    left = left.withColumn("rest", F.zip_with("v", "centre", lambda a, b: a - b)).drop("centre")
    # the range of what is left, by dimension
    pos = left.select(F.posexplode("rest").alias("d", "x")).groupBy("d").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    ranges = {r.d: (r.low, r.high) for r in pos.collect()}  # one row for each dimension
    low = [ranges.get(d, (0.0, 0.0))[0] for d in range(dims)]
    step = [(ranges.get(d, (0.0, 0.0))[1] - ranges.get(d, (0.0, 0.0))[0]) / STEPS for d in range(dims)]
    coded = F.transform(
        "rest", lambda x, d: F.when(F.get(F.lit(step), d) > 0, F.round((x - F.get(F.lit(low), d)) / F.get(F.lit(step), d)) - 128).otherwise(-128).cast("tinyint")
    ) if dims else F.array().cast("array<tinyint>")
    codes = left.select("cell", key, coded.alias("code"))
    # rows in order of cell: a probe reads the row groups of its cells
    tasks = max(1, min(cells, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    codes.repartitionByRange(tasks, "cell", key).sortWithinPartitions("cell").write.mode("overwrite").parquet(f"{path}/codes")
    exact = vectors.select(F.col(key), F.transform(F.col(column), lambda x: x.cast("double")).alias("vector"))
    exact.repartitionByRange(tasks, key).sortWithinPartitions(key).write.mode("overwrite").parquet(f"{path}/vectors")


    def lay(probes: int) -> None:
        layout = spark.createDataFrame([(dims, centres, low, step, probes)], LAYOUT)
        layout.coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")

    lay(len(centres))
    if n:
        lay(_probes_for(spark, path, key, centres, units, recall, seed))


def _probes_for(spark: SparkSession, path: str, key: str, centres, units: DataFrame, recall: float, seed: int) -> int:
    """Cells to probe so that half of what may be missed is: the place of the true neighbours' cells in the order of probing."""
    own = units.orderBy(F.xxhash64(key, F.lit(seed))).limit(TUNING).select(F.col(key).alias("_query"), "v").persist()
    order = own.select("_query", F.posexplode(_cells_near(centres, len(centres))("v")).alias("at", "cell"))
    true = nearest_in_index(spark, path, key, own, "_query", "v", 11, None).where(F.col(key) != F.col("_query"))
    there = true.join(spark.read.parquet(f"{path}/codes").select(key, "cell"), key).join(order, ["_query", "cell"])
    places = sorted(r.at for r in there.select("at").collect())  # TUNING times 11 rows at most
    own.unpersist()
    return places[min(len(places) - 1, math.ceil((1 + recall) / 2 * len(places)))] + 1 if places else len(centres)


def nearest_in_index(spark: SparkSession, path: str, key: str, queries: DataFrame, query_key: str, column: str, limit: int = 10, probes: int | None = 0) -> DataFrame:
    """(query_key, key, score, rank): each query's ``limit`` nearest by cosine in its ``probes`` nearest cells.

    0 probes as many cells as were found to be needed when the index was built, None all of them.

    Ties go to the smaller key. A vector is found by a query with its own key too. Key columns must differ in name.
    """
    layout = spark.read.parquet(f"{path}/layout").first()
    probes = len(layout.centres) if probes is None else min(probes or layout.probes, len(layout.centres))
    own = _unit(queries, query_key, column, layout.dims)
    probed = own.select(query_key, "v", F.explode(_cells_near(layout.centres, probes)("v")).alias("cell"))
    centres = spark.createDataFrame(list(enumerate(layout.centres)), "cell int, centre array<double>")
    weight = F.zip_with("v", F.lit(layout.step), lambda q, s: q * s) if layout.dims else F.array().cast("array<double>")
    base = _dot(F.col("v"), F.col("centre")) + _dot(F.col("v"), F.lit(layout.low)) if layout.dims else F.lit(0.0)
    # half a step in each dimension, and what rounding may add
    off = F.aggregate(weight, F.lit(0.0), lambda s, w: s + F.abs(w)) * 0.5 + 1e-9
    placed = probed.join(F.broadcast(centres), "cell").select(query_key, "cell", F.inline(F.array(F.struct(weight.alias("w"), base.alias("base"), off.alias("off")))))
    codes = spark.read.parquet(f"{path}/codes")
    pairs = _scored(codes, placed, query_key, key, limit, layout.dims)
    best = Window.partitionBy(query_key).orderBy(F.desc("about"))
    kth = pairs.withColumn("n", F.row_number().over(best)).where(F.col("n") <= limit).groupBy(query_key).agg(
        F.when(F.count("*") == limit, F.min("about")).alias("kth")
    )
    close = pairs.join(kth, query_key).where(F.col("kth").isNull() | (F.col("about") >= F.col("kth") - 2 * F.col("off"))).select(query_key, key)
    mine = queries.select(query_key, F.transform(F.col(column), lambda x: x.cast("double")).alias("_q"))
    both = close.join(spark.read.parquet(f"{path}/vectors"), key).join(mine, query_key)
    norm = F.sqrt(_dot(F.col("vector"), F.col("vector"))) * F.sqrt(_dot(F.col("_q"), F.col("_q")))
    scored = both.select(query_key, key, rules.round_half_up(_dot(F.col("vector"), F.col("_q")) / norm, SCORE_DIGITS).alias("score"))
    rank = F.row_number().over(Window.partitionBy(query_key).orderBy(F.desc("score"), key))
    return scored.withColumn("rank", rank).where(F.col("rank") <= limit)


def search_vectors(spark: SparkSession, path: str, key: str, query_key, limit: int = 10, probes: int | None = 0) -> DataFrame:
    """``search.vector_search`` from the index: (key, score) nearest to the stored vector of ``query_key``, itself left out."""
    probe = spark.read.parquet(f"{path}/vectors").where(F.col(key) == F.lit(query_key)).select(F.col(key).alias("_query"), "vector")
    found = nearest_in_index(spark, path, key, probe, "_query", "vector", limit + 1, probes)
    return found.where(F.col(key) != F.lit(query_key)).select(key, "score").orderBy(F.desc("score"), key).limit(limit)
