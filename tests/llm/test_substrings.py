import random

import numpy as np
import pytest

from lampyris.llm import substrings

from . import brute


def documents(seed=5):
    rnd = random.Random(seed)
    out = []
    small = ["a", "b", "c"]  # runs and repeats inside
    vocabulary = [f"w{i}" for i in range(300)]
    pool = [[rnd.choice(vocabulary) for _ in range(n)] for n in (49, 50, 51, 55, 80, 200)] + [["a"] * 70, [rnd.choice(small) for _ in range(90)]]
    for i in range(60):
        w = []
        for _ in range(rnd.randrange(1, 5)):
            w += [rnd.choice(vocabulary) for _ in range(rnd.randrange(0, 40))]
            part = rnd.choice(pool)
            a = rnd.randrange(0, 10) if rnd.random() < 0.4 else 0
            w += part[a:]
        out.append((i, rnd.choice([" ", "\n"]).join(w)))
    out += [(100 + i, t) for i, t in enumerate([out[3][1], out[3][1].replace(" ", "\t"), None, "", " ", "word", "a " * 300, "a " * 49, "A " * 300])]
    return out


def test_removals_equal_brute_force(spark):
    rows = documents()
    docs = spark.createDataFrame([(t, i, "x") for i, t in rows], "text string, doc_id long, spans string").repartition(4)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept, r.kept_sha256) for r in substrings.without_repeats(docs).collect()}
    want = {}
    for i, (w, kept) in brute.repeats(rows).items():
        text = b" ".join(kept)
        want[i] = (len(w), len(w) - len(kept), text.decode(), brute.sha(text))
    assert sum(x[1] > 0 for x in want.values()) > 30
    assert got == want


@pytest.mark.parametrize("letters", [2, 3, 20])
def test_phrases_of_equal_windows_agree_in_the_middle(letters):
    """The middle of a window has the same phrases wherever the window stands."""
    rng = np.random.default_rng(letters)
    margin = substrings.LIMITS[-1] - 1 + substrings.CONTEXT
    codes = rng.integers(1, 1 << 62, letters).astype(np.uint64)
    for _ in range(400):
        window = codes[rng.integers(0, letters, 50)]
        if rng.random() < 0.3:
            a = rng.integers(0, 45)
            window[a : a + rng.integers(2, 30)] = codes[0]
        seen = []
        for _ in range(2):
            before, after = (codes[rng.integers(0, letters, rng.integers(0, 30))] for _ in range(2))
            h = np.concatenate([before, window, after])
            name, length, at = substrings.phrases(h, np.array([0, len(h)]))
            assert length.sum() == len(h)
            by_word = np.repeat(name, length)[len(before) : len(before) + 50]
            seen.append(by_word[margin : 50 - margin])
        assert (seen[0] == seen[1]).all()


def test_repeated_rows_and_empty_table(spark):
    text = " ".join(f"t{i}" for i in range(60))
    docs = spark.createDataFrame([(7, text), (7, text), (9, text), (None, text)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed) for r in substrings.without_repeats(docs).collect()) == [(7, 0), (7, 0), (9, 60)]
    assert substrings.without_repeats(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        substrings.repeated_spans(docs, window=20)


def test_long_words_of_one_pattern(spark):
    rest = " ".join(f"w{i}" for i in range(30))
    rows = [(n + i, f"{rest} {w} {rest}") for n in (1024, 16_384, 20_000) for i, w in enumerate(brute.doubling_pair(n))]
    rows += [(7, rows[-1][1])]
    found = {r.doc_id: (r.n_words, r.kept_sha256) for r in substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {i: (len(w), brute.sha(b" ".join(kept))) for i, (w, kept) in brute.repeats(rows).items()}


def test_differing_texts_of_one_id(spark):
    rnd = random.Random(6)
    passage = [" ".join(f"{c}{rnd.randrange(40)}" for _ in range(60)) for c in "abc"]
    other = lambda n: " ".join(f"x{rnd.randrange(10**6)}" for _ in range(n))
    rows = [(1, passage[0]), (5, other(40)), (5, f"{other(20)} {passage[0]} {other(20)}"), (5, f"{passage[1]} {other(3)}"), (5, passage[1]), (5, None)]
    rows += [(7, f"{passage[1]} {other(5)}"), (7, f"{other(5)} {passage[2]}"), (3, passage[2]), (7, rows[2][1]), (9, passage[0]), (9, passage[0]), (5, rows[1][1])]
    docs = spark.createDataFrame([(t, i, "x", b"y") for i, t in rows], "text string, doc_id long, key string, variant binary").repartition(3)
    found = sorted((r.doc_id, r.n_words, r.kept_sha256) for r in substrings.without_repeats(docs).collect())
    want = []
    for i, text in rows:
        w = brute.words(text)
        earlier = {tuple(v[j : j + 50]) for k, t in rows if k < i for v in [brute.words(t)] for j in range(len(v) - 49)}
        covered = [False] * len(w)
        for j in range(len(w) - 49):
            if tuple(w[j : j + 50]) in earlier:
                covered[j : j + 50] = [True] * 50
        want.append((i, len(w), brute.sha(b" ".join(x for x, c in zip(w, covered) if not c))))
    assert found == sorted(want)
