"""Mixture-controlled packing against the library's ids and a plain count of every window."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lampyris.llm import mixture

SCHEMA = "doc_id long, text string, source string, sequence_id string, ids string"


def _docs(n=400):
    rng = np.random.default_rng(7)
    vocabulary = ["light", "zone", "repair", "Ärger", "l'été", "12345", "pole,", "東京"]
    rows = []
    for i in range(n):
        size = int(rng.integers(0, 400)) if i % 50 else 9000
        source = ["web", "web", "web", "books", "code", "", None][int(rng.integers(0, 7))]
        rows.append((i, " ".join(rng.choice(vocabulary, size)), source, "clash", "clash"))
    rows += [(5, "repeated id", "web", None, None), (5, "repeated id", "web", None, None), (None, "no id", "rare", None, None), (900, None, "web", None, None)]
    return rows


def _check(rows, pieces, capacity=2048):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = defaultdict(list)
    for doc, text, *_ in rows:
        want[doc].append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])
    # every id of every document lies in exactly one piece
    got = defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        got[p.doc_id].append(p)
    assert set(got) == set(want)
    for doc, texts in want.items():
        if len(texts) == 1:
            parts = sorted(got[doc], key=lambda p: p.start)
            assert [x for p in parts for x in p.ids] == texts[0]
            assert [p.start for p in parts] == [0, *np.cumsum([p.length for p in parts])[:-1].tolist()]
            assert {p.doc_tokens for p in parts} == {len(texts[0])}
        else:
            assert sum(p.length for p in got[doc]) == sum(map(len, texts))
    # sequences have no gaps; all but the last few are full, the others powers of two
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    sizes = {}
    for number, parts in sequences.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        sizes[number] = at
    assert all(n <= capacity and n & (n - 1) == 0 for n in sizes.values())
    total = sum(len(t) for texts in want.values() for t in texts)
    assert sorted(sizes) == list(range(len(sizes)))
    assert sum(n == capacity for n in sizes.values()) == total // capacity
    return sizes


def _shares(rows, pieces, sequences):
    source = {r[0]: r[2] for r in rows}
    out = defaultdict(lambda: defaultdict(int))
    for p in pieces:
        out[p.sequence_id][source[p.doc_id]] += p.length
    return {n: out[n] for n in sequences}


def test_every_window_has_the_corpus_mixture(spark):
    rows = _docs()
    pieces = mixture.pack(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    sizes = _check(rows, pieces)
    full = [n for n, size in sizes.items() if size == 2048]
    tokens = defaultdict(int)
    for p in pieces:
        tokens[{r[0]: r[2] for r in rows}[p.doc_id]] += p.length
    total = sum(tokens.values())
    assert len(full) > 20
    # the last full window may hold what no grain fills
    for number, window in _shares(rows, pieces, full[:-1]).items():
        for source, n in tokens.items():
            assert abs(window[source] - 2048 * n / total) < 4 * 8, (number, source)


def test_targets_hold_until_a_source_ends(spark):
    rows = [r for r in _docs() if r[2] in ("web", "books", "code")]
    pieces = mixture.pack(spark.createDataFrame(rows, SCHEMA), targets={"web": 0.5, "books": 0.3, "code": 0.2}, grain=1).collect()
    sizes = _check(rows, pieces)
    tokens = defaultdict(int)
    for p in pieces:
        tokens[{r[0]: r[2] for r in rows}[p.doc_id]] += p.length
    until = min(tokens["web"] / 0.5, tokens["books"] / 0.3, tokens["code"] / 0.2) // 2048
    windows = _shares(rows, pieces, [n for n in sizes if n < until])
    assert len(windows) > 5
    for window in windows.values():
        assert abs(window["web"] - 1024) < 4 and abs(window["books"] - 614.4) < 4 and abs(window["code"] - 409.6) < 4
    # deficits are carried: over all those windows no source is off by more than over one
    assert abs(sum(w["books"] for w in windows.values()) - 614.4 * len(windows)) < 4


def test_sources_without_a_target_follow(spark):
    rows = [r for r in _docs(120) if r[2] in ("web", "books", "code")]
    pieces = mixture.pack(spark.createDataFrame(rows, SCHEMA), targets={"code": 1.0}, grain=1).collect()
    _check(rows, pieces)
    source = {r[0]: r[2] for r in rows}
    last_code = max(p.sequence_id for p in pieces if source[p.doc_id] == "code")
    assert all(p.sequence_id >= last_code for p in pieces if source[p.doc_id] != "code")


def test_many_sources_share_queues(spark):
    rows = [(i, "some words of a text " * (i % 9), f"s{i}", None, None) for i in range(300)]
    _check(rows, mixture.pack(spark.createDataFrame(rows, SCHEMA), most=8).collect())


def test_other_sizes_and_an_empty_table(spark):
    rows = _docs(60)
    docs = spark.createDataFrame(rows, SCHEMA)
    _check(rows, mixture.pack(docs, capacity=256, grain=64).collect(), capacity=256)
    assert mixture.pack(docs.limit(0)).collect() == []
    _check(rows[:0] + [(1, None, None, None, None)], mixture.pack(spark.createDataFrame([(1, None, None, None, None)], SCHEMA)).collect())
    with pytest.raises(ValueError):
        mixture.pack(docs, capacity=2000)


def test_slots_are_a_permutation_with_bounded_deficits():
    rng = np.random.default_rng(3)
    for counts in ({0: 1}, {0: 5, 1: 5}, {i: int(n) for i, n in enumerate(rng.integers(1, 400, 23))}, {0: 10_000, 1: 1, 2: 1, 3: 7}):
        ways = mixture.paths(counts)
        total = sum(counts.values())
        assert sorted(mixture.slot_of(ways[q], k) for q, n in counts.items() for k in range(n)) == list(range(total))
        for upto in range(0, total, 37):
            for q, n in counts.items():
                _, lo, hi = mixture.served(ways[q], 0, upto)
                assert lo == 0 and abs(hi - upto * n / total) < 3
                assert hi == sum(mixture.slot_of(ways[q], k) < upto for k in range(n))
