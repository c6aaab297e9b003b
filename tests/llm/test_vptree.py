import numpy as np

from lampyris.llm import vptree


def table(spark, n=700, dim=12, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, dim))
    x = (centres[rng.integers(0, 9, n)] + 0.4 * rng.normal(size=(n, dim))).astype(np.float32)
    x[100:220] = x[100]  # one very common vector
    x[300:304] = 2 * x[299]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(2000, None), (2001, []), (2002, [0.0] * dim), (2003, [float("nan")] * dim), (2004, [None] * dim), (2005, [1.0] * (dim - 1)), (None, rows[5][1])]
    odd += [(2010, [float("inf")] + [0.0] * (dim - 1)), (7, rows[7][1]), (2050, [-v for v in rows[3][1]])]
    return spark.createDataFrame([(v, i, 4) for i, v in rows + odd], "embedding array<float>, vec_id long, v int").repartition(4), rows + odd[-1:]


def expected(rows, k=5):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    total = lambda z: np.add.accumulate(z, axis=-1)[..., -1]
    norm = np.sqrt(total(x * x))
    out = {}
    for q in np.flatnonzero(ids % 50 == 0):
        score = total(x[q] * x) / (norm[q] * norm)
        best = sorted((-score[j], ids[j]) for j in range(len(ids)) if j != q)[:k]
        out[int(ids[q])] = [(int(i), -s) for s, i in best]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_factor_one_is_exact(spark):
    vectors, rows = table(spark)
    got = answers(vptree.nearest(vectors, "id % 50 = 0", sample=300, per_shard=100))
    assert got == expected(rows)


def test_relaxed_search_keeps_most(spark):
    vectors, rows = table(spark)
    got, want = answers(vptree.nearest(vectors, "id % 50 = 0", factor=1.5, sample=300, per_shard=100)), expected(rows)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9


def test_few_or_no_vectors(spark):
    vectors, _ = table(spark)
    assert vptree.nearest(vectors.where("false"), "id % 50 = 0").count() == 0
    few = answers(vptree.nearest(vectors.where("vec_id in (0, 3, 50)"), "id % 50 = 0"))
    assert {q: len(x) for q, x in few.items()} == {0: 2, 50: 2}
