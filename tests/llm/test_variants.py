"""Spelling variants against a plain comparison of all words."""

import random
import re
import zlib
from collections import Counter

import pytest

from lampyris.llm import variants

SCHEMA = "doc_id long, text string, word string, n string, key string"


def distance_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain(rows, drop_every=199):
    counts = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if drop_every and h % drop_every == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    out = {}
    for w, n in counts.items():
        near = [x for x in counts if distance_one(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form = best if best and counts[best] >= 5 * n else None
        out[w] = (n, len(near), form, counts.get(form))
    def root(w):
        return root(out[w][2]) if out[w][2] else w
    return {w: (*v, root(w)) for w, v in out.items()}


def documents(seed, letters, n_words=150, n_docs=60):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(4, 11))) for _ in range(n_words)]
    for w in list(vocabulary):
        i, kind = rnd.randrange(len(w)), rnd.randrange(4)
        if kind:
            vocabulary.append(w[:i] + rnd.choice(letters) * (kind > 1) + w[i + (kind < 3) :])
    weights = [1 / (i % 50 + 1) for i in range(len(vocabulary))]
    rows = [(i, " ".join(rnd.choices(vocabulary, weights, k=200)).title() if i % 7 == 0 else rnd.choice([" ", "1", "ł"]).join(rnd.choices(vocabulary, weights, k=200)), "x", "y", "z") for i in range(n_docs)]
    return rows + [(3, None, None, None, None), (None, rows[1][1], None, None, None), rows[2], rows[2], (4, "", None, None, None)]


@pytest.mark.parametrize("seed, letters, drop", [(1, "ab", 199), (2, "abcde", 199), (3, "aeintéÉ×", 11), (4, "abcdefghijklmnopqrstuvwxyzü", 3)])
def test_groups_equal_brute_force(spark, seed, letters, drop):
    rows = documents(seed, letters)
    found = variants.groups(spark.createDataFrame(rows, SCHEMA).repartition(3), drop_every=drop).collect()
    want = plain(rows, drop)
    assert len(want) > 50 and sum(v[1] > 0 for v in want.values()) > 10
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in found} == want and len(found) == len(want)


def test_chains_are_followed_to_the_root(spark):
    chain = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb"]
    rows = [(i, " ".join([w] * 5 ** (i + 1)), None, None, None) for i, w in enumerate(chain)]
    found = variants.groups(spark.createDataFrame(rows, SCHEMA), drop_every=0).collect()
    assert {r.word: (r.form, r.root) for r in found} == {w: (f, chain[-1]) for w, f in zip(chain, [*chain[1:], None])}


def test_long_texts_are_sliced_between_words(spark, monkeypatch):
    monkeypatch.setattr(variants, "SLICE", 10)
    assert [w for part in variants._parts("abcdefghijklmno pq r " * 4 + "z" * 50) for w in variants.RUN.findall(part)] == ["abcdefghijklmno", "pq", "r"] * 4 + ["z" * 50]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert variants.groups(docs).collect() == []


def test_pivots_are_disjoint_and_cheapest():
    rnd = random.Random(5)
    for _ in range(300):
        grams = [(rnd.randrange(1, 9), at, "") for at in sorted(rnd.sample(range(12), rnd.randrange(3, 7)))]
        cost = {at: n for n, at, _ in grams}
        chosen = variants.pivots(grams)
        best = min(cost[a] + cost[b] for a in cost for b in cost if b - a >= 2)
        assert chosen[1] - chosen[0] >= 2 and cost[chosen[0]] + cost[chosen[1]] == best
