"""Texts as sequences of units that a word BPE encodes on their own, with the ids of each distinct unit.

For a tokenizer that folds case, drops white space, splits letters, single digits and other signs, and merges inside
those pieces. In chunks between white space that hold ASCII and the Latin letters of U+00C0-U+00FF only, the pieces are
found here, on byte arrays. Any other chunk (other scripts, apostrophes, control characters, special tokens) is one
unit and goes to the tokenizers library as it is.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from . import words

VOCABULARY = "word_bpe_49k.json"
_LETTER, _DIGIT, _SIGN, _SPACE, _BAD, _LEAD = 1, 2, 3, 0, 4, 5


def _classes() -> np.ndarray:
    out = np.full(256, _BAD, np.uint8)
    out[33:127] = _SIGN
    out[48:58] = _DIGIT
    out[65:91] = out[97:123] = _LETTER
    out[words.separators()] = _SPACE
    out[39] = _BAD  # an apostrophe may start a contraction
    out[0xC3] = _LEAD
    return out


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    table = dict(zip(plain, plain)) | {b: 256 + i for i, b in enumerate(rest)}
    return [chr(table[b]) for b in range(256)]


def split(buf: np.ndarray, offsets: np.ndarray):
    """Folded bytes, starts, ends and kinds (True: pieces; False: for the library) of all units, and their text offsets."""
    starts, ends, _ = words.word_spans(buf, offsets)
    kind = _classes()[buf]
    prior = np.concatenate([[0], buf[:-1]]) if len(buf) else buf
    tail = (prior == 0xC3) & (buf >= 0x80) & (buf <= 0xBF) & (buf != 0x97) & (buf != 0xB7)
    kind[tail] = _LETTER
    lead = kind == _LEAD
    kind[lead] = np.where(np.concatenate([tail[1:], [False]])[lead], _LETTER, _BAD)
    special = np.flatnonzero((buf == 124) & (prior == 60))
    kind[special] = _BAD
    bad = np.concatenate([[0], np.cumsum(kind == _BAD)])
    odd = bad[ends] > bad[starts]
    step = np.zeros(len(buf) + 1, np.int8)
    step[starts[odd]] += 1
    step[ends[odd]] -= 1
    inside = np.cumsum(step[:-1], dtype=np.int8) > 0
    folded = buf.copy()
    upper = ((buf >= 65) & (buf <= 90)) | (tail & (buf >= 0x80) & (buf <= 0x9E))
    folded[upper & ~inside] += 32
    head = np.zeros(len(buf), bool)
    head[starts] = True
    change = np.concatenate([[True], kind[1:] != kind[:-1]]) if len(buf) else head
    start = np.flatnonzero((kind != _SPACE) & (head | (~inside & (change | (kind == _DIGIT)))))
    # a unit ends where the next one starts or at the first white space
    chunk = np.searchsorted(starts, start, side="right") - 1
    end = np.minimum(np.append(start[1:], len(buf)), ends[chunk]) if len(start) else start
    return folded, start, end, ~odd[chunk] if len(start) else np.zeros(0, bool), np.searchsorted(start, offsets)


class Library:
    """Ids from the library: pieces by its model, other chunks by the whole tokenizer."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.letters = byte_letters()

    def pieces(self, found: list[bytes]) -> list[list[int]]:
        spell, model = self.letters, self.tokenizer.model
        return [[t.id for t in model.tokenize("".join([spell[b] for b in x]))] for x in found]

    def chunks(self, found: list[bytes]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch([x.decode() for x in found], add_special_tokens=False)]


def same_bytes(x: np.ndarray, xs: np.ndarray, n: np.ndarray, y: np.ndarray, ys: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether the words of ``n`` bytes at ``xs`` equal those of ``m`` bytes at ``ys``."""
    same = n == m
    x, y, k, rows = words.lanes(x), words.lanes(y), 0, np.flatnonzero(same)
    while len(rows) and k < words.LONG:
        same[rows] = words.lane(x, xs[rows], n[rows], k) == words.lane(y, ys[rows], n[rows], k)
        k += 8
        rows = rows[same[rows] & (n[rows] > k)]
    for i in rows.tolist():
        a, b = xs[i] + n[i] - 8, ys[i] + n[i] - 8  # the last whole lanes
        same[i] = x[a] == y[b] and np.array_equal(x[xs[i] + k : a : 8], y[ys[i] + k : b : 8])
    return same


class Encoder:
    """Ids of whole texts; a worker keeps those of the units it has met, up to ``most`` of them or ``most_bytes``.

    Units are found by hash and then compared byte by byte; one whose hash belongs to another unit is kept by its bytes.
    """

    def __init__(self, source, most: int = 800_000, most_bytes: int = 1 << 25):
        self.source, self.most, self.most_bytes = source, most, most_bytes
        self.forget()

    def forget(self):
        self.known = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.n = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.bytes = np.zeros(0, np.uint8)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.others: dict[bytes, tuple[int, int]] = {}

    def _encoded(self, raw: list[bytes], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in ``ids`` and number of the ids of each unit."""
        ids: list = [None] * len(raw)
        for kind, encode in ((True, self.source.pieces), (False, self.source.chunks)):
            rows = np.flatnonzero(plain == kind)
            if len(rows):
                for i, x in zip(rows.tolist(), encode([raw[i] for i in rows])):
                    ids[i] = x
        n = np.array([len(x) for x in ids], np.int64)
        at = len(self.ids) + np.cumsum(n) - n
        self.ids = np.concatenate([self.ids, np.array([t for x in ids for t in x], np.uint32)])
        return at, n

    def _learn(self, keys, raw: list[bytes], plain):
        at, n = self._encoded(raw, plain)
        sizes = np.array([len(x) for x in raw], np.int64)
        starts = len(self.bytes) + np.cumsum(sizes) - sizes
        self.bytes = np.concatenate([self.bytes, np.frombuffer(b"".join(raw), np.uint8)])
        order = np.argsort(np.concatenate([self.known, keys]), kind="stable")
        for name, more in (("known", keys), ("at", at), ("n", n), ("starts", starts), ("sizes", sizes)):
            setattr(self, name, np.concatenate([getattr(self, name), more])[order])

    def __call__(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the n + 1 offsets of each text's ids."""
        buf, offsets = words.text_buffer(column)
        buf, start, end, plain, first = split(buf, offsets)
        size = end - start
        keys, row, back = np.unique(words.word_hashes(buf, start, end), return_index=True, return_inverse=True)
        if len(self.known) + len(keys) > self.most or len(self.bytes) > self.most_bytes:
            self.forget()
        raw = lambda i: buf[start[i] : end[i]].tobytes()
        at = np.searchsorted(self.known, keys)
        new = np.ones(len(keys), bool)
        there = at < len(self.known)
        new[there] = self.known[at[there]] != keys[there]
        if new.any():
            self._learn(keys[new], [raw(i) for i in row[new].tolist()], plain[row[new]])
        at = np.searchsorted(self.known, keys)[back]
        right = same_bytes(buf, start, size, self.bytes, self.starts[at], self.sizes[at])
        n, at = self.n[at], self.at[at]
        for i in np.flatnonzero(~right).tolist():
            found = self.others.get(raw(i))
            if found is None:
                where, count = self._encoded([raw(i)], plain[i : i + 1])
                found = self.others[raw(i)] = int(where[0]), int(count[0])
            at[i], n[i] = found
        total = np.concatenate([[0], np.cumsum(n)])
        return self.ids[np.repeat(at - total[:-1], n) + np.arange(total[-1])], total[first]


_KEPT: dict = {}


def encoder(path: str | None, make) -> Encoder:
    """One encoder for each worker process and kind of source."""
    path = path or public_tokenizers.path(VOCABULARY)
    key = (path, make.__name__)
    if key not in _KEPT:
        _KEPT[key] = Encoder(make(path))
    return _KEPT[key]
