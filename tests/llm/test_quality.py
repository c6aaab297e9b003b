import random

import numpy as np
import pytest

from lampyris.llm import quality

from . import brute


def grid_vector(text):
    n_words, chars, symbols, dups, repeated, _ = brute.base_statistics(text)
    lines = sum(bool(brute.words(x)) for x in (text or "").split("\n"))
    n = max(n_words, 1)
    x = [np.log(max(chars, 1) / n), np.log1p(symbols / n), dups / max(lines, 1), repeated / n]
    return np.array([np.floor(v / quality.GRID + 0.5) for v in x])


def distances(vectors, core=0.75, starts=None):
    """The estimate of one group in numpy, on grid values: scaled distances and the least log determinant."""
    floors = np.diag(np.square(quality.FLOORS))

    def far(mean, cov):
        d = vectors * quality.GRID - mean
        return (d @ np.linalg.inv(cov + floors) * d).sum(axis=1)

    def classes(d2):
        return np.minimum(quality.TOP, np.floor(np.log1p(d2) * 256))

    def concentrated(mean, cov):
        c = classes(far(mean, cov))
        near = vectors[c <= np.percentile(c, 100 * core)] * quality.GRID
        return near.mean(axis=0), np.cov(near.T, bias=True)

    log_det = lambda cov: np.linalg.slogdet(cov + floors)[1]
    middle = np.percentile(vectors, 50, axis=0)
    spread = np.percentile(np.abs(vectors - np.floor(middle + 0.5)), 50, axis=0) * quality.GRID * 1.4826
    starts = starts or [(np.percentile(vectors, 100 * q, axis=0) * quality.GRID, np.diag(spread**2)) for q in quality.STARTS]
    found = []
    for mean, cov in starts:
        mean, cov = concentrated(mean, cov)
        for _ in range(12):
            new = concentrated(mean, cov)
            if not log_det(new[1]) < log_det(cov) - 1e-9:
                break
            mean, cov = new
        found.append((log_det(cov), mean, cov))
    least, mean, cov = min(found, key=lambda f: round(f[0], 9))
    d2 = far(mean, cov)
    scale = max(1.0, np.expm1(np.percentile(classes(d2), 100 * core) / 256) / quality.CHI_CORE[core])
    return d2 / scale, least


def documents(seed=4):
    rnd = random.Random(seed)
    rows = []
    for i in range(160):
        size = rnd.randrange(20, 120)
        w = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 9))) for _ in range(size)]
        text = "".join(x + rnd.choice([" ", " ", " ", "\n"]) for x in w)
        if i % 16 == 0:
            text = text.replace(" ", "&&& ")
        elif i % 16 == 1:
            text = " ".join(x * 6 for x in w)
        rows.append((i, text, "en" if i % 4 else "de", "s"))
    rows += [(900, None, "en", "s"), (901, "", "en", "s"), (902, "few words only", None, "s"), (903, rows[2][1], None, None)]
    line = "one two three four five six seven eight nine ten"
    rows += [(904, f"{line}\n{line}\n \n{line} x", "en", "s"), (905, "ab " * 9000, "en", "s"), (906, "é| # x " * 8 + "more words " * 3, "en", "s")]
    return rows


def test_base_statistics_and_verdicts_equal_plain_versions(spark):
    rows = documents()
    docs = spark.createDataFrame([(t, i, a, s, 0) for i, t, a, s in rows], "text string, doc_id long, lang string, source string, x1 int").repartition(3)
    got = {r.doc_id: r for r in quality.judged(docs, least=30).collect()}
    assert len(got) == len(rows)
    for i, t, _, _ in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.base_statistics(t), i
    rejected = 0
    for lang in ("en", "de"):
        own = [(i, t) for i, t, a, s in rows if a == lang and s == "s" and not got[i].base_failed]
        d2, _ = distances(np.array([grid_vector(t) for _, t in own]))
        for (i, _), d in zip(own, d2):
            assert got[i].estimate == "group"
            assert got[i].d2 == pytest.approx(d, rel=1e-6, abs=1e-9)
            assert got[i].kept == (d <= quality.CHI_CUT)
            rejected += not got[i].kept
    assert 15 <= rejected <= 25
    assert got[903].estimate == "all" and got[903].d2 is not None  # too few like it
    assert got[902].estimate is None and not got[902].kept
    assert not got[900].kept


def test_one_text_many_times_rejects_nothing_ordinary(spark):
    rnd = random.Random(1)
    text = " ".join(f"word{i}" for i in range(50))
    rows = [(i, text) for i in range(100)] + [(200 + i, " ".join(f"{'other'[: rnd.randrange(3, 6)]}{j}" for j in range(60))) for i in range(20)]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows + rows[:1]], "doc_id long, text string, lang string, source string")
    got = quality.judged(docs).collect()
    assert len(got) == 121 and all(r.kept for r in got)
    assert quality.judged(docs.where("false")).count() == 0


def test_an_outlier_in_one_statistic_is_rejected(spark):
    rnd = random.Random(9)
    word = lambda size=5: "".join(rnd.choice("abcdefghij") for _ in range(size))
    clean = [" ".join(word() for _ in range(100)) + "\n" + " ".join(word() for _ in range(20)) for _ in range(120)]
    few, passage = [word() for _ in range(6)], " ".join(word() for _ in range(14))
    odd = {
        "x1": " ".join(word(8) for _ in range(100)),
        "x2": " ".join(word(4) + "#" for _ in range(100)),
        "x3": "\n".join(rnd.choice(few) for _ in range(60)),
        "x4": " ".join([passage, *(word() for _ in range(72)), passage]),
    }
    rows = list(enumerate([*clean, *odd.values()]))
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.judged(docs).collect()}
    assert all(got[i].kept for i in range(len(clean)))
    for i, name in enumerate(odd, len(clean)):
        near = [x for x in quality.STATISTICS if x != name and abs(got[i][x] - got[0][x]) > 100]
        assert not near and not got[i].base_failed and not got[i].kept, name


def test_small_groups_are_judged_by_their_language_or_by_all(spark):
    rows = documents()
    docs = spark.createDataFrame([(i, t, a, f"s{i % 9}") for i, t, a, _ in rows], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.judged(docs).collect()}
    assert {r.estimate for r in got.values()} == {"language", "all", None}
    for lang in ("en", "de"):
        own = [(i, t) for i, t, a, _ in rows if a == lang and not got[i].base_failed]
        own_all = [(i, t) for i, t, _, _ in rows if not got[i].base_failed]
        kind, used = ("language", own) if len(own) >= 40 else ("all", own_all)
        d2 = dict(zip([i for i, _ in used], distances(np.array([grid_vector(t) for _, t in used]))[0]))
        for i, _ in own:
            assert got[i].estimate == kind and got[i].d2 == pytest.approx(d2[i], rel=1e-6, abs=1e-9)
    assert not any(got[i].kept for i in range(0, 160, 16)) and got[2].kept


def test_the_least_determinant_of_several_starts(spark):
    """Two clusters: the determinant is as small as that from many random starts."""
    rnd = random.Random(3)
    word = lambda size: "".join(rnd.choice("abcdefghij") for _ in range(size))
    texts = [" ".join(word(rnd.choice([3, 4])) for _ in range(60)) for _ in range(90)]
    texts += [" ".join(word(rnd.choice([8, 9])) + rnd.choice(["", "#"]) for _ in range(60)) for _ in range(30)]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.judged(docs).collect()}
    vectors = np.array([grid_vector(t) for t in texts])
    d2, least = distances(vectors)
    assert all(got[i].d2 == pytest.approx(d, rel=1e-6, abs=1e-9) for i, d in enumerate(d2))
    pick = np.random.default_rng(5)
    tried = []
    for _ in range(200):
        own = vectors[pick.choice(len(vectors), 6, replace=False)] * quality.GRID
        tried.append((own.mean(axis=0), np.cov(own.T, bias=True)))
    assert least <= distances(vectors, starts=tried)[1] + 0.05
    assert all(got[i].kept for i in range(90)) and not any(got[i].kept for i in range(90, 120))
