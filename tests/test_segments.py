"""Merging of index parts: few folders, the same answers, readers undisturbed."""

import random

import pytest

from lampyris.operators import search, segments

WORDS = ["lamp", "flicker", "pole", "wire", "storm", "dark", "corner", "switch"]


def _write(spark, path, rows, part):
    search.write_index(spark.createDataFrame(rows, "doc_id int, text string, gone boolean"), "doc_id", "text", path, buckets=2, part=part, removed="gone")


def _batches(n, seed):
    rnd = random.Random(seed)
    return [
        [(i, " ".join(rnd.choices(WORDS, k=rnd.randrange(1, 6))), rnd.random() < 0.3) for i in rnd.sample(range(30), 4)] for _ in range(n)
    ]


def _answers(spark, path):
    return [search.search_index(spark, path, "doc_id", phrase, 30).collect() for phrase in ("lamp flicker", "storm", "absent")]


@pytest.fixture(scope="module")
def merged(spark, tmp_path_factory):
    """Twenty-one batches merged three at a time, and the state that they leave."""
    path, state = str(tmp_path_factory.mktemp("ix") / "merged"), {}
    for part, rows in enumerate(_batches(21, 4)):
        _write(spark, path, rows, part)
        segments.merge(spark, path, "doc_id", below=part, fanout=3)
        state |= {i: (text, gone) for i, text, gone in rows}
    return path, state


def test_answers_equal_a_fresh_build(spark, merged, tmp_path):
    path, state = merged
    fresh = str(tmp_path / "fresh")
    _write(spark, fresh, [(i, text, gone) for i, (text, gone) in state.items()], 0)
    assert any(gone for _, gone in state.values())
    assert _answers(spark, path) == _answers(spark, fresh)
    postings, documents = search.read_index(spark, path, "doc_id")
    assert documents.count() == sum(not gone for _, gone in state.values())


def test_few_folders_are_left(spark, merged):
    path, _ = merged
    _, runs = segments.manifest(spark, path)
    loose = segments.parts_after(spark, path, runs[-1].last)
    assert len(runs) <= 4 and len(loose) <= 3
    assert max(r.tier for r in runs) >= 1 and runs[0].first == 0 and [a.last + 1 for a in runs[:-1]] == [b.first for b in runs[1:]]
    assert len(segments.folders(spark, f"{path}/documents")) <= 6 and len(segments.folders(spark, f"{path}/manifest")) == 2
    # removed documents are forgotten by the oldest run
    oldest = spark.read.parquet(f"{path}/runs/{runs[0].name}/documents")
    assert oldest.where("removed").count() == 0


def test_a_reader_that_began_before_a_merge_ends_undisturbed(spark, tmp_path):
    path = str(tmp_path / "ix")
    for part, rows in enumerate(_batches(4, 7)):
        _write(spark, path, rows, part)
    before = search.search_index(spark, path, "doc_id", "lamp flicker", 30)
    assert segments.merge(spark, path, "doc_id", below=3, fanout=3)
    assert before.collect() == search.search_index(spark, path, "doc_id", "lamp flicker", 30).collect()
    assert not segments.merge(spark, path, "doc_id", below=4, fanout=3)
    _write(spark, path, _batches(4, 7)[3], 3)  # the last batch comes again
    assert before.collect() == search.search_index(spark, path, "doc_id", "lamp flicker", 30).collect()


def test_a_half_written_manifest_is_not_followed(spark, tmp_path):
    path = tmp_path / "ix"
    for part, rows in enumerate(_batches(3, 8)):
        _write(spark, str(path), rows, part)
    want = _answers(spark, str(path))
    (path / "manifest" / "version=1").mkdir(parents=True)
    assert segments.manifest(spark, str(path)) == (0, []) and _answers(spark, str(path)) == want


def test_similar_from_the_index_equals_the_scan(spark, tmp_path):
    rows = [(i, text) for i, (text, *_) in enumerate([(" ".join(random.Random(i).choices(WORDS, k=5)),) for i in range(40)])] + [(99, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    path = str(tmp_path / "ix")
    search.write_index(docs, "doc_id", "text", path, buckets=2)
    for one in (0, 7, 99):
        got = search.similar_in_index(spark, path, "doc_id", docs.where(f"doc_id = {one}"), "text", 8).collect()
        assert got == search.similar_documents(docs, "doc_id", "text", one, 8).collect()


def test_marks_follow_the_files(spark, tmp_path):
    folder = str(tmp_path / "t")
    spark.range(3).write.parquet(f"{folder}/a")
    first = segments.marks(spark, folder)
    assert first == segments.marks(spark, folder)
    spark.range(4).write.mode("overwrite").parquet(f"{folder}/a")
    assert first != segments.marks(spark, folder)


def test_documents_of_one_key_and_without_a_key(spark, tmp_path):
    """Rows of one key are one document; a common term's postings are not dealt by term."""
    rows = [(1, "lamp lamp storm"), (1, "lamp wire dark"), (1, "pole"), (2, "lamp storm"), (3, "lamp lamp wire"), (None, "lamp dark"), (4, "corner")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    path = str(tmp_path / "ix")
    search.write_index(docs, "doc_id", "text", path, buckets=2)
    postings, _ = search.read_index(spark, path, "doc_id")
    assert {(r.term, r.doc_id, r.n_tokens): r.tf for r in postings.collect()}[("lamp", 1, 3)] == 3
    assert segments.folders(spark, f"{path}/texts") == []
    found = search.similar_in_index(spark, path, "doc_id", docs.where("doc_id = 2"), "text", 8)
    assert "SortMergeJoin [term" not in found._jdf.queryExecution().executedPlan().toString()
    assert [r.doc_id for r in found.collect()] == [1, 3]


def test_a_single_part_is_read_without_a_join(spark, tmp_path):
    path = str(tmp_path / "ix")
    docs = spark.createDataFrame([(i, "lamp storm") for i in range(5)], "doc_id int, text string")
    search.write_index(docs, "doc_id", "text", path, buckets=2)
    postings, _ = search.read_index(spark, path, "doc_id", ["lamp"])
    assert "Join" not in postings._jdf.queryExecution().executedPlan().toString() and postings.count() == 5
    _write(spark, path, [(1, "pole", False)], 1)
    assert search.read_index(spark, path, "doc_id", ["lamp"])[0].count() == 4


def test_a_single_part_has_each_document_once_and_reads_it_without_a_shuffle(spark, tmp_path):
    rows = [(1, "lamp storm", "b"), (1, "lamp", "c"), (1, "lamp wire dark pole", "a"), (2, "lamp", None), (None, "dark", "x"), (None, "dark pole", "y"), (3, None, "z")]
    path = str(tmp_path / "ix")
    search.write_index(spark.createDataFrame(rows, "doc_id int, text string, zone string"), "doc_id", "text", path, buckets=2, attributes=["zone"])
    _, documents = search.read_index(spark, path, "doc_id")
    plan = documents._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    assert {tuple(r) for r in documents.collect()} == {(1, "c", 1), (2, None, 1), (None, "y", 2), (3, "z", 0)} and documents.count() == 4
    assert spark.read.parquet(f"{path}/postings/part=0").where("doc_id is null").count() == 0
