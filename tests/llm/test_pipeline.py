import random
import re

import pytest

import corpus_pipeline
from lampyris.llm import registry

from . import brute
from .test_secrets import spans


def documents():
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(500)]
    passage = " ".join(rnd.choice(vocabulary) for _ in range(70))
    rows = []
    for i in range(60):
        text = " ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(25, 120)))
        if i % 5 == 0:
            text += "\n" + passage
        if i % 7 == 0:
            text += "\npassword=b7db7aa4a5fcc78305 done"
        if i % 9 == 0 and rows:
            text = rows[-1][1].replace("w1 ", "w2 ") + " tail"
        rows.append((i, text, "en", f"s{i % 2}", len(text)))
    rows += [(200, None, "en", "s0", 0), (201, "too short", None, None, 9), (202, rows[3][1], "en", "s1", 1), (202, rows[3][1], "en", "s1", 1), (None, rows[4][1], "en", "s0", 1), (203, passage, "en", "s0", 1)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_equal_plain_versions(spark, tmp_path):
    rows = documents()
    folder = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    # groups this small reject nothing beyond the fixed limits
    now = {(r[0], r[1]): r for r in rows if r[0] is not None and not brute.base_statistics(r[1])[5]}
    now = {i: t for i, t in now}
    linked = brute.near_duplicates(now.items())
    now = {i: t for i, t in now.items() if linked[i][1] == i}
    for i, (w, kept) in brute.repeats(list(now.items())).items():
        if len(kept) < len(w):
            now[i] = b" ".join(kept).decode()
    now = {i: t for i, t in now.items() if t}
    clean = {}
    for i, t in now.items():
        at, out = 0, ""
        for s, _, e in spans(t):
            out += t[at:s] + "[secret]" if s >= at else ""
            at = max(at, e)
        clean[i] = out + t[at:]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = registry_stored(stage(spark, docs, folder), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    got = {r.doc_id: r for r in docs.collect()}
    assert {i: r.text for i, r in got.items()} == clean
    assert docs.count() == len(clean) < len(rows) - 8
    assert any("[secret]" in t for t in clean.values()) and all(r.n_chars == len(r.text) or not re.search("secret|^$", r.text) for r in got.values())
    packed = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in packed} == set(clean)
    assert sum(r.length for r in packed) <= 2048 * len({r.sequence_id for r in packed})


def registry_stored(df, name):
    from lampyris.llm.storage import stored

    return stored(df, name)


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_an_empty_table(spark, stage):
    docs = spark.createDataFrame([], SCHEMA)
    assert corpus_pipeline.STAGES[stage][1](spark, docs, "").count() == 0


def test_registered():
    import __spark_entry__ as contract

    names = [k for k in contract.queries() if re.match(r"op\d+_", k)]
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in names) == list(range(1, 14))
    assert "pipeline" in contract.queries() and set(registry.SQL) <= set(contract.oracle_sql())
