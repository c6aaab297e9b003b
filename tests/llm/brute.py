"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
from collections import defaultdict


def words(text, lower=False):
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


def shingles(text, k=5):
    w = words(text, True)
    if len(w) < k:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def near_duplicates(docs, percent=80):
    """{doc_id: (set size, component)} of (doc_id, text) rows."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), root(i)) for i in sets}


def repeats(docs, window=50):
    """{doc_id: (words, kept words)}"""
    first, out = {}, {}
    for i, text in sorted(docs):
        w = words(text)
        covered = [False] * len(w)
        for j in range(len(w) - window + 1):
            if first.setdefault(tuple(w[j : j + window]), i) < i:
                covered[j : j + window] = [True] * window
        out[i] = (w, [x for x, c in zip(w, covered) if not c])
    return out


def base_statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"""
    text = text or ""
    w = words(text)
    places = defaultdict(list)
    for j in range(len(w) - 7):
        places[tuple(w[j : j + 8])].append(j)
    covered = {k for p in places.values() if len(p) > 1 for j in p for k in range(j, j + 8)}
    lines = [x for x in text.split("\n") if words(x)]
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return (
        len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed,
    )


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def doubling_pair(n):
    """Two different words of n letters whose byte sums times powers of any odd base agree modulo 2**64 for long n."""
    one = "a"
    while len(one) < n:
        one += one.translate(str.maketrans("ab", "ba"))
    return one[:n], one.translate(str.maketrans("ab", "ba"))[:n]
