"""Phrase collocations against plain counts."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lampyris.llm import collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, f string, n string"


def plain(rows, least, top=2000, covered=80):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        longer = [(p, a) for p, a in counts.items() if len(p) > 2 and a >= least]
        held = Counter()
        for p, a in longer:
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    held[p[i : i + k]] = max(held[p[i : i + k]], a)
        rows_ = []
        for p, a in counts.items():
            if len(p) < 2 or a < least or 100 * held[p] >= covered * a:
                continue
            cuts = [(2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows_.append((" ".join(p), a, counts[p[:k]], counts[p[k:]], n[lang], score))
        rows_.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i, *r) for i, r in enumerate(rows_[:top], 1)]
    return sorted(out)


def documents(seed):
    rnd = random.Random(seed)
    rows = []
    for lang, letters in (("en", "abc"), ("fr", "éàb"), (None, "xy"), ("und", "xy")):
        vocabulary = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 4))) for _ in range(30)]
        weights = [1 / (i + 1) for i in range(30)]
        fixed = [[rnd.choice(vocabulary) for _ in range(rnd.randrange(2, 7))] for _ in range(6)]
        for i in range(40):
            parts = []
            for _ in range(30):
                parts += rnd.choice(fixed) if rnd.random() < 0.3 else rnd.choices(vocabulary, weights, k=2)
                parts.append(rnd.choice(["", "", "", ".", ", ", "\n", "!?", "\t", "—"]))
            text = " ".join(parts)
            rows.append((i, text.upper() if i % 9 == 0 else text, lang, None, None, None))
    return rows + [(1, None, "en", None, None, None), (None, "", None, None, None, None), (2, ".,;", "de", None, None, None), rows[0], rows[0]]


def found(docs, **k):
    return sorted((r.lang, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in collocations.mine(docs, **k).collect())


@pytest.mark.parametrize("seed, least, shard", [(1, 30, 1 << 20), (2, 5, 3000), (3, 2, 700)])
def test_phrases_equal_plain_counts(spark, monkeypatch, seed, least, shard):
    rows = documents(seed)
    monkeypatch.setattr(collocations, "SHARD", shard)
    monkeypatch.setattr(collocations, "ENTRIES", 1000)
    want = plain(rows, least)
    assert len(want) > 50
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(3), least=least) == want


def test_only_the_best_are_kept(spark):
    rows = documents(4)
    assert found(spark.createDataFrame(rows, SCHEMA), least=3, top=7) == plain(rows, 3, top=7)


def test_empty_tables_and_none_frequent(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(1, "one two three", "en", None, None, None), (2, None, None, None, None, None)], SCHEMA)) == []


def test_counts_beyond_64_bits_stay_exact(spark):
    big = 3_000_000_000_000_000
    df = spark.createDataFrame([("en", "a b", big, big + 7, big + 9), ("en", "c d", 2, 2, 3)], "lang string, phrase string, f long, x long, y long")
    got = {r.phrase: r.score for r in collocations._scored(df, [("x", "y")]).collect()}
    assert got == {"a b": 2_000_000 * big // (2 * big + 16), "c d": 2_000_000 * 2 // 5}


def test_sequences_and_long_texts(monkeypatch):
    seq, known = collocations.sequence("B a,a  b\tA.\n\nx..b".encode())
    assert [0 if i == 0 else known[i - 1].decode() for i in seq] == [0, "b", "a", 0, "a", "b", "a", 0, "x", 0, "b", 0]
    assert collocations.sequence(b" ,. ")[0].tolist() == [0]
    monkeypatch.setattr(collocations, "SHARD", 10)
    text = b"aaa bbb ccc ddd, eee. fff ggg hhh iii jjj"
    assert list(collocations._cut(text)) == [b"aaa bbb ccc ddd,", b" eee. fff ggg hhh iii jjj"]
    assert b"".join(collocations._cut(b"x" * 70_000 + b"." + b"y" * 30)) == b"x" * 70_000 + b"." + b"y" * 30


def test_words_of_one_hash_are_told_apart(monkeypatch):
    hashes = collocations.words.word_hashes
    monkeypatch.setattr(collocations.words, "word_hashes", lambda *a, **k: hashes(*a, **k) & np.uint64(1))
    seq, known = collocations.sequence(b"one two three one four two five")
    assert [known[i - 1].decode() for i in seq if i] == "one two three one four two five".split()


def test_intervals_are_the_occurrences():
    rnd = random.Random(8)
    seq = np.array([0] + [rnd.choice([0, 1, 1, 2, 2, 3, 4]) for _ in range(600)] + [0])
    index = collocations.Index(seq)
    lo, hi = index.of_words()
    phrases = [(w,) for w in range(1, 5)]
    for k in range(2, 5):
        which, word, start, count = index.to_the_left(lo, hi)
        longer = [(int(w), *phrases[i]) for i, w in zip(which, word)]
        want = Counter(tuple(seq[i : i + k].tolist()) for i in range(len(seq) - k + 1))
        assert dict(zip(longer, count.tolist())) == {p: c for p, c in want.items() if 0 not in p}
        assert [phrases[i] for i in collocations.within(lo, hi, start)] == [p[:-1] for p in longer]
        lo, hi, phrases = start, start + count, longer
