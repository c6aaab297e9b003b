"""Words of whole texts as 64-bit hashes, a batch of documents at a time (numpy).

A word is a maximal run of bytes other than space and 0x09-0x0D. Its bytes are mixed eight at a time, those of very
long words by xxh3. Hashes of runs of words are sums of word hashes times powers of an odd base modulo 2**64, followed
by a bit mixer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

LONG = 256  # bytes; longer words are hashed one by one
_SEED = 0x9E3779B97F4A7C15
_WINDOW_BASE = 0xC2B2AE3D27D4EB4F
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one bit mixer on 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def separators() -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[9, 10, 11, 12, 13, 32]] = True
    return out


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most`` bytes of text (or one row)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the n + 1 offsets of each text's words."""
    word = ~separators()[buf]
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty_like(word)
    if len(word):
        before[0] = False
        before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.empty_like(word)
    if len(word):
        after[-1] = False
        after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lanes(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of ``buf`` on as one number; behind its end stand zeros."""
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    return np.ndarray(len(buf) + 1, "<u8", buffer=padded, strides=(1,))


def lane(eight: np.ndarray, starts: np.ndarray, n: np.ndarray, k: int) -> np.ndarray:
    """Bytes ``k`` to ``k + 8`` of the words at ``starts``, which have ``n`` > k bytes."""
    return eight[starts + k] & _MASKS[np.minimum(n - k, 8)]


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A hash of each word: its bytes mixed in eight by eight, so that no arithmetic pattern in them cancels out."""
    if lower:
        buf = _LOWER[buf]
    n, eight = ends - starts, lanes(buf)
    out = mix(n.astype(np.uint64) + np.uint64(_SEED))
    rows = np.arange(len(n))
    for k in range(0, LONG, 8):
        rows = rows[n[rows] > k]
        if not len(rows):
            return out
        out[rows] = mix(out[rows] * np.uint64(_WINDOW_BASE) + mix(lane(eight, starts[rows], n[rows], k) + np.uint64(_SEED)))
    for i in rows[n[rows] > LONG].tolist():
        out[i] = xxhash.xxh3_64_intdigest(buf[starts[i] : ends[i]].tobytes())
    return out


def window_hashes(h: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` consecutive words within one text, and the n + 1 offsets by text."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    if len(h) < size:
        return np.zeros(0, np.uint64), offsets
    n = len(h) - size + 1
    if size <= 8:
        out = h[:n].copy()
        for j in range(1, size):
            out = out * np.uint64(_WINDOW_BASE) + h[j : n + j]
    else:
        up = _powers(_WINDOW_BASE, len(h) + 1)
        total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * up[:-1], out=total[1:])
        out = (total[size:] - total[:-size]) * _powers(pow(_WINDOW_BASE, -1, 1 << 64), len(h) + 1)[:n]
    at = np.repeat(first[:-1] - offsets[:-1], counts) + np.arange(offsets[-1])
    return mix(out[at] + np.uint64(size)), offsets
