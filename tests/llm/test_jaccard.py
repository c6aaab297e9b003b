import random

import pytest

from lampyris.llm import jaccard

from . import brute


def near_copies(seed=3):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    passage = [rnd.choice(vocabulary) for _ in range(60)]
    for _ in range(24):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randrange(6, 160))]
        if rnd.random() < 0.5:
            base = base + passage
        for _ in range(rnd.randrange(1, 9)):
            copy = list(base)
            for _ in range(rnd.randrange(0, max(2, len(base) // 20))):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            if rnd.random() < 0.3:
                copy = copy + [rnd.choice(vocabulary) for _ in range(rnd.randrange(1, max(2, len(base) // 6)))]
            text = " ".join(copy)
            rows.append((i, text.upper() if rnd.random() < 0.2 else text))
            i += 1
    return rows


HARD = [
    (1000, None), (1001, ""), (1002, " \n\t"), (1003, "a b c"), (1004, "A  B\nc"), (1005, "a b c d"), (1006, "x"), (1007, "É x y z w"), (1008, "é x y z w"),
    (1009, "long " * 30000), (1010, "LONG " * 29999 + "long"), (-5, "a b c"),
]


@pytest.mark.parametrize("percent", [80, 60])
def test_components_equal_brute_force(spark, percent):
    rows = near_copies() + HARD
    docs = spark.createDataFrame([(t, i, 1, "k") for i, t in rows], "text string, doc_id long, n int, key string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs, percent=percent).collect()}
    want = brute.near_duplicates(rows, percent)
    assert sum(c != i for i, (_, c) in want.items()) > 20
    assert got == want


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = "one two three four five six seven"
    rows = [(1, text), (1, text), (2, text), (None, text), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard.near_duplicates(docs).collect())) == [(1, 3, 1, 1), (2, 3, 1, 1), (3, 0, 3, 3)]
    assert jaccard.near_duplicates(docs.where("false")).count() == 0


@pytest.mark.parametrize("block", [3, 128])
def test_every_link_is_counted(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rnd = random.Random(5)
    base = [f"v{i}" for i in range(150)]
    rows = near_copies() + HARD
    for i in range(30):  # all led by one text, many near enough to each other too
        copy = list(base)
        copy[rnd.randrange(150)] = copy[rnd.randrange(150)] = "other"
        rows.append((2000 + i, " ".join(copy)))
    rows.append((3000, rows[-1][1]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.n_links for r in jaccard.near_duplicates(docs, with_links=True).collect()}
    sets = {i: brute.shingles(t) for i, t in rows}
    want = {a: sum(a != b and 100 * len(x & y) >= 80 * len(x | y) for b, y in sets.items() if x and y) for a, x in sets.items()}
    assert max(want.values()) > 20
    assert got == want


def test_long_words_of_one_pattern(spark):
    rows = [(10 * n + i, w) for n in (1024, 16_384, 20_000) for i, w in enumerate(brute.doubling_pair(n))]
    rows += [(7, rows[0][1])]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute.near_duplicates(rows)
