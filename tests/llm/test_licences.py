import hashlib
import pathlib
import re

from lampyris.llm import licences

MIT = dict(licences.KNOWN)["MIT"]
CASES = {
    1: MIT, 2: MIT.upper().replace("\n", "\n  "), 3: "Copyright (c) 2020 Some One\nAll rights reserved.\n\n" + MIT, 4: "© 2019 x\n" + MIT.replace(",", " ;"),
    5: MIT + " more", 6: None, 7: "", 8: "Some prose.\nreleased under the MIT licence\nLicensed under CC BY-NC 4.0\nReleased under the MIT License.", 9: "Copyright 2020 x", 10: "é" * 40000,
    11: dict(licences.KNOWN)["BSD-2-Clause"].replace("HOLDER ", "OWNER "),
}


def test_texts_and_notices(spark):
    rows = list(CASES.items()) + [(1, MIT), (None, MIT)]
    docs = spark.createDataFrame([(t, i, "c") for i, t in rows], "text string, doc_id long, licence_id string").repartition(3)
    got = licences.scan(docs, licences.known_texts(spark)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert {i: by[i].licence_id for i in by} == {1: "MIT", 2: "MIT", 3: "MIT", 4: "MIT", 11: "BSD-2-Clause", None: "MIT"} | {i: None for i in (5, 6, 7, 8, 9, 10)}
    assert (by[8].n_notices, by[8].notices) == (3, "CC-BY-NC-4.0-notice,MIT-notice")
    assert by[6].canonical_sha256 == hashlib.sha256(b"").hexdigest()
    words = re.sub("[^a-z0-9]+", " ", MIT.lower()).strip()
    assert by[1].canonical_sha256 == hashlib.sha256(words.encode()).hexdigest()


def test_known_texts_are_a_parameter_and_tables_may_be_empty(spark):
    docs = spark.createDataFrame([(1, "My Own Terms!")], "doc_id long, text string")
    known = spark.createDataFrame([("b", "my own: terms"), ("a", "MY OWN TERMS"), ("none", "©"), ("null", None)], "licence_id string, text string")
    assert licences.scan(docs, known).head().licence_id == "a"
    assert licences.scan(docs, known.where("false")).head().licence_id is None
    assert licences.scan(docs.where("false"), known).count() == 0


def test_real_licence_files_are_known(spark):
    folder = pathlib.Path(__file__).parent / "licence_files"
    rows = [(i, p.name, p.read_text()) for i, p in enumerate(sorted(folder.iterdir()))]
    assert len(rows) > 10
    docs = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")
    got = {r.doc_id: r.licence_id for r in licences.scan(docs, licences.known_texts(spark)).collect()}
    assert {n: got[i] for i, n, _ in rows} == {n: n.split("_")[0] for _, n, _ in rows}
