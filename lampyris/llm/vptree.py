"""Nearest neighbours by cosine with vantage-point trees per shard.

On unit vectors the Euclidean distance d falls as the cosine grows (d * d = 2 - 2 * cosine) and obeys the triangle
inequality. A branch beyond a query's current k-th distance is skipped: exactly with ``factor`` 1; a larger factor
shrinks the distance that still counts, which skips more and may miss some.

1. Equal vectors become one entry with its smallest ids (as many as an answer can need), combined in each task first.
2. A tree over a bounded sample (``sample`` vectors, those with the smallest id hashes) splits space; its leaves are the
   shards. Only this tree goes to the driver and into tasks. Every vector is put into a shard.
3. Each query searches its own shard's tree, which bounds its distances; then only the shards within that bound.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no part, neither do rows
without an id or with another dimension than most. Rows that repeat an id and a vector count once; an id with several
vectors is a candidate with each, and a query with each has one answer list (the best over all). Ties go to the
smaller id. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import partitions, stored

LEAF = 64
NEAR = 1e-7  # distances within this of the k-th are kept for the exact comparison


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def distances(x: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ to.T), 0))


def build(x: np.ndarray, rows: np.ndarray, leaf: int, most: int = 64):
    """("leaf", rows) or (vantage point, radius, inside, outside); depth at most ``most``.

    The vantage point is the candidate that spreads a few distances most; equal distances may make halves uneven.
    """
    if len(rows) <= leaf or most == 0:
        return ("leaf", rows)
    step = max(1, len(rows) // 16)
    tried = rows[::step][:16]
    spread = distances(x[tried], x[rows[:: max(1, len(rows) // 256)]]).std(axis=1)
    point = x[tried[int(np.argmax(spread))]]
    d = distances(x[rows], point[None])[:, 0]
    radius = float(np.median(d))
    near = d <= radius
    if near.all():
        return ("leaf", rows)
    return (point, radius, build(x, rows[near], leaf, most - 1), build(x, rows[~near], leaf, most - 1))


class Best:
    """The k smallest distances of each query so far and everything close to them."""

    def __init__(self, queries: np.ndarray, bound: np.ndarray, k: int):
        self.q, self.k, self.bound = queries, k, bound.copy()
        self.least = np.full((len(queries), k), np.inf)
        self.hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def offer(self, who: np.ndarray, x: np.ndarray, rows: np.ndarray):
        d = distances(self.q[who], x[rows])
        every = np.concatenate([self.least[who], d], axis=1)
        self.least[who] = np.partition(every, self.k - 1, axis=1)[:, : self.k]
        self.bound[who] = np.minimum(self.bound[who], self.least[who].max(axis=1))
        a, b = np.nonzero(d <= self.bound[who][:, None] + NEAR)
        self.hits.append((who[a], rows[b], d[a, b]))

    def search(self, tree, x: np.ndarray, who: np.ndarray, factor: float):
        if not len(who):
            return
        if isinstance(tree[0], str):
            self.offer(who, x, tree[1])
            return
        point, radius, inside, outside = tree
        d = distances(self.q[who], point[None])[:, 0]
        for first in (True, False):  # the half that a query is in, then the other one if it still can matter
            for half, side in ((inside, d <= radius), (outside, d > radius)):
                own = side if first else ~side
                gap = np.abs(d - radius)
                go = own if first else own & (gap <= self.bound[who] / factor + NEAR)
                self.search(half, x, who[go], factor)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.hits:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        who, rows, d = (np.concatenate(x) for x in zip(*self.hits))
        keep = d <= self.bound[who] + NEAR
        return who[keep], rows[keep], d[keep]


def shards_of(tree, x: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf number) of every leaf within ``reach`` of each row; reach below 0: only the leaf that holds it."""
    out = []
    at = [0]

    def walk(node, who):
        if isinstance(node[0], str):
            out.append((who, np.full(len(who), at[0])))
            at[0] += 1
            return
        point, radius, inside, outside = node
        d = distances(x[who], point[None])[:, 0] if len(who) else np.zeros(0)
        walk(inside, who[d - radius <= np.maximum(reach[who], 0)])
        walk(outside, who[(radius - d <= reach[who]) & (reach[who] >= 0) | (d > radius)])

    walk(tree, np.arange(len(x)))
    return tuple(np.concatenate(c) for c in zip(*out))


def _matrix(column) -> np.ndarray:
    flat = np.frombuffer(b"".join(column.to_pylist()), np.float64)
    return flat.reshape(len(column), -1)


def _combined(dim: int, keep: int):
    """Within a batch: one row for each distinct vector, with its smallest ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("id").to_numpy()
            x = batch.column("v").flatten().to_numpy().reshape(-1, dim) + 0.0  # no negative zeros
            order = np.lexsort((ids, *x.T[::-1]))
            ids, x = ids[order], x[order]
            cuts = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]).any(axis=1)]))
            ends = np.append(cuts[1:], len(ids))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[a].tobytes() for a in cuts], pa.binary()),
                    pa.array([np.unique(ids[a:b])[:keep].tolist() for a, b in zip(cuts, ends)], pa.list_(pa.int64())),
                ],
                ["v", "ids"],
            )

    return run


def _housed(tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = unit(_matrix(batch.column("v")))
                row, shard = shards_of(tree, x, np.full(len(x), -1.0))
                back = np.empty(len(x), np.int64)
                back[row] = shard
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(back)], [*batch.schema.names, "shard"])

    return run


def _routed(tree, factor: float):
    """The other shards that each query still has to search."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = unit(_matrix(batch.column("v")))
                row, shard = shards_of(tree, x, batch.column("bound").to_numpy() / factor + NEAR)
                other = shard != batch.column("shard").to_numpy()[row]
                part = batch.select(["v", "bound"]).take(pa.array(row[other]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(shard[other])], ["v", "bound", "shard"])

    return run


_HITS = "q binary, v binary, ids array<long>, d double"


def _searched(k: int, factor: float):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        types = pa.schema([("q", pa.binary()), ("v", pa.binary()), ("ids", pa.list_(pa.int64())), ("d", pa.float64())])
        if not left.num_rows or not right.num_rows:
            return types.empty_table()
        x = unit(_matrix(left.column("v")))
        tree = build(x, np.arange(len(x)), LEAF)
        best = Best(unit(_matrix(right.column("v"))), right.column("bound").to_numpy().copy(), k)
        best.search(tree, x, np.arange(right.num_rows), factor)
        who, rows, d = best.found()
        return pa.Table.from_arrays(
            [right.column("v").take(pa.array(who)), left.column("v").take(pa.array(rows)), left.column("ids").take(pa.array(rows)), pa.array(d)],
            schema=types,
        )

    return run


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cosine in double precision, components added in order."""
    total = lambda x: np.add.accumulate(x, axis=1)[:, -1]
    for batch in batches:
        if batch.num_rows:
            a, b = _matrix(batch.column("q")), _matrix(batch.column("v"))
            score = total(a * b) / (np.sqrt(total(a * a)) * np.sqrt(total(b * b)))
            yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("ids"), pa.array(score)], ["q", "ids", "score"])


def nearest(
    vectors: DataFrame, queries: str, k: int = 5, factor: float = 1.0, id_col: str = "vec_id", vector_col: str = "embedding",
    sample: int = 8192, per_shard: int = 4096,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows of each query row, nearest first.

    ``queries`` is a condition on ``id`` that picks the query rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = "id is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x != 0)"
    rows = rows.where(fine)
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    answer = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], answer)
    dim = sizes[0].dim
    rows = rows.where(F.size("v") == dim)
    keep = k + 1
    combined = rows.mapInArrow(_combined(dim, keep), "v binary, ids array<long>")
    entries = combined.groupBy("v").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids"))
    entries = stored(entries, "vectors")
    count = entries.count()
    picked = entries.orderBy(F.xxhash64("v"), "v").limit(sample).select("v").toArrow().column("v")
    x = unit(_matrix(picked.combine_chunks()))
    leaves = max(1, -(-count // per_shard))
    tree = build(x, np.arange(len(x)), 8, int(np.ceil(np.log2(leaves))))

    parts = partitions(spark)
    shards = stored(entries.mapInArrow(_housed(tree), "v binary, ids array<long>, shard long"), "shards")
    asked = rows.where(F.expr(queries)).select("id", "v")
    asked = stored(asked.mapInArrow(_keyed(dim), "id long, v binary").distinct(), "queries")
    points = asked.select("v").distinct().withColumn("bound", F.lit(float("inf")))
    first = points.mapInArrow(_housed(tree), "v binary, bound double, shard long")
    search = lambda q: shards.groupBy("shard").cogroup(q.groupBy("shard")).applyInArrow(_searched(keep, factor), _HITS)
    home = stored(search(first), "hits")
    # the k-th distance of each query within its own shard bounds the rest
    ranked = home.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy("d")))
    bounds = ranked.where(F.col("n") == keep).select(F.col("q").alias("v"), F.col("d").alias("found"))
    rest = first.join(bounds, "v", "left").select("v", F.coalesce("found", "bound").alias("bound"), "shard")
    rest = rest.repartition(parts, "v").mapInArrow(_routed(tree, factor), "v binary, bound double, shard long")
    hits = home.union(search(rest))
    scored = hits.select("q", "v", "ids").mapInArrow(_scores, "q binary, ids array<long>, score double")
    pairs = asked.withColumnRenamed("v", "q").join(scored, "q").select(F.col("id").alias("query_id"), F.explode("ids").alias("vec_id"), "score")
    pairs = pairs.where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _keyed(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("v").flatten().to_numpy().reshape(-1, dim) + 0.0
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "v"])

    return run
