from pyspark.sql import functions as F

from lampyris.operators import search

DOCS = [
    (1, "Lamp FLICKER at night"),
    (2, "lamp blinking, lamp intermittent"),
    (3, "column leaning"),
    (4, None),
    (5, "lamp"),
    (6, "flicker flicker flicker in the long corridor of the old building near the lamp"),
]


def _docs(spark):
    return spark.createDataFrame(DOCS, "doc_id int, text string")


def test_scan_and_index_agree(spark, tmp_path):
    path = str(tmp_path / "ix")
    search.write_index(_docs(spark), "doc_id", "text", path, buckets=4)
    for phrase in ["flicker", "lamp flicker", "lamp", "absent"]:
        a = search.search(_docs(spark), "doc_id", "text", phrase, 10).collect()
        b = search.search_index(spark, path, "doc_id", phrase, 10).collect()
        assert a == b, phrase
    assert search.search(_docs(spark), "doc_id", "text", "absent").count() == 0


def test_synonyms_and_filters(spark):
    plain = {r.doc_id for r in search.search(_docs(spark), "doc_id", "text", "flicker").collect()}
    wide = {r.doc_id for r in search.search(_docs(spark), "doc_id", "text", "flicker", synonyms=True).collect()}
    assert plain == {1, 6} and wide == {1, 2, 6}
    only = search.search(_docs(spark), "doc_id", "text", "lamp", filters=F.col("doc_id") > 2).collect()
    assert {r.doc_id for r in only} == {5, 6}


def test_similar_excludes_itself(spark):
    got = [r.doc_id for r in search.similar_documents(_docs(spark), "doc_id", "text", 1, 5).collect()]
    assert 1 not in got and got[0] == 6


def test_vectors_and_fusion(spark):
    vectors = spark.createDataFrame([(0, [1.0, 0.0]), (1, [2.0, 0.1]), (2, [0.0, 1.0]), (3, [-1.0, 0.0]), (4, [0.0, 0.0])], "id int, v array<float>")
    rows = search.vector_search(vectors, "id", "v", 0, 10).collect()
    assert [r.id for r in rows][:3] == [1, 2, 3] and rows[2].score == -1.0
    lexical = spark.createDataFrame([(2, 5.0), (7, 4.0)], "id int, score double")
    fused = search.hybrid_search(lexical, search.vector_search(vectors, "id", "v", 0, 2), "id").collect()
    assert fused[0].id == 2 and {r.id for r in fused} == {1, 2, 7}


def test_topics(spark):
    got = {r.topic: r.documents for r in search.topic_counts(_docs(spark), "text").collect()}
    assert got["flicker"] == 3 and got["collision"] == 1 and got["sensor"] == 0


def test_queries_split_as_documents_do(spark):
    docs = spark.createDataFrame([(1, "m² lamps"), (2, "Ünder_score x٣y")], "doc_id int, text string")
    for phrase, found in [("m²", {1}), ("score", {2}), ("٣ lamps", {1}), ("x", {2})]:
        assert {r.doc_id for r in search.search(docs, "doc_id", "text", phrase).collect()} == found, phrase
