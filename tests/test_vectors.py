"""The vector index against exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lampyris.operators import search, vectors

SCHEMA = "id long, v array<float>"


def _clustered(n, dims=16, seed=1, clusters=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dims))
    return (centres[rng.integers(0, clusters, n)] + 0.25 * rng.normal(size=(n, dims))).astype(np.float32)


def _exact(v, queries, k):
    u = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    out = {}
    for q in queries:
        score = np.round(u @ u[q] + 0.0, 6)
        out[q] = sorted(range(len(u)), key=lambda i: (-score[i], i))[:k]
    return out


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    v, path = _clustered(3000), str(tmp_path_factory.mktemp("vectors"))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], SCHEMA)
    vectors.write_vector_index(df, "id", "v", path)
    return v, df, path


def test_recall_of_a_few_cells(spark, index):
    v, df, path = index
    queries = df.where("id % 50 = 0").select(F.col("id").alias("q"), "v")
    got = vectors.nearest_in_index(spark, path, "id", queries, "q", "v", 10).collect()
    want = _exact(v, range(0, 3000, 50), 10)
    layout = spark.read.parquet(f"{path}/layout").first()
    assert len(got) == 600 and layout.probes < len(layout.centres) / 2
    hits = sum(r.id in want[r.q] for r in got)
    assert hits / 600 >= 0.95


def test_all_cells_are_exact(spark, index):
    v, df, path = index
    queries = df.where("id % 300 = 7").select(F.col("id").alias("q"), "v")
    got = vectors.nearest_in_index(spark, path, "id", queries, "q", "v", 10, probes=None).collect()
    want = _exact(v, range(7, 3000, 300), 10)
    assert {q: [r.id for r in sorted(got, key=lambda r: r.rank) if r.q == q] for q in want} == want
    assert vectors.search_vectors(spark, path, "id", 5, 10, probes=None).collect() == search.vector_search(df, "id", "v", 5, 10).collect()


def test_a_probe_reads_few_codes(spark, index):
    _, _, path = index
    sizes = spark.read.parquet(f"{path}/codes").groupBy("cell").count().collect()
    assert len(sizes) > 30 and sum(r["count"] for r in sizes) == 3000
    assert sum(sorted((r["count"] for r in sizes), reverse=True)[:8]) < 1500


def test_unusable_vectors_and_empty_tables(spark, tmp_path):
    rows = [(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 0.0]), (4, None), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [1.0]), (8, [-1.0, 0.0]), (2, [0.9, 0.1])]
    df = spark.createDataFrame(rows, SCHEMA)
    path = str(tmp_path / "a")
    vectors.write_vector_index(df, "id", "v", path)
    got = vectors.nearest_in_index(spark, path, "id", df.select(F.col("id").alias("q"), "v").where("q in (1, 3, 4, 5)"), "q", "v", 10, None)
    assert {r.id for r in got.collect()} == {1, 2, 8} and {r.q for r in got.collect()} == {1}
    empty = str(tmp_path / "b")
    vectors.write_vector_index(df.limit(0), "id", "v", empty)
    assert vectors.nearest_in_index(spark, empty, "id", df.select(F.col("id").alias("q"), "v"), "q", "v").collect() == []


def test_blocks_of_any_size_keep_the_best(spark, index, monkeypatch):
    """One query at a time against each batch; only what may be among the best leaves the batch."""
    v, df, path = index
    monkeypatch.setattr(vectors, "SCORE_BLOCK", 1)
    queries = df.where("id % 500 = 3").select(F.col("id").alias("q"), "v")
    found = vectors.nearest_in_index(spark, path, "id", queries, "q", "v", 10, probes=None)
    assert "MapInArrow" in found._jdf.queryExecution().toString()
    want = _exact(v, range(3, 3000, 500), 10)
    assert {q: [r.id for r in sorted(found.collect(), key=lambda r: r.rank) if r.q == q] for q in want} == want
