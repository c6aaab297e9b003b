"""Which tokens of a document occur in other documents too.

Tokens (64-bit hashes) travel in packed rows: a row holds one bucket of the token space for one slice of documents.
A token that a task meets very often is "heavy": it is known to be shared, so its postings are not gathered under
its key at all; they stay spread over buckets chosen by slice. That bounds what one key can add to a task to
1/256 of the documents, whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import mix

HEAVY = 255
# low bits that travel beside the bucket's: wide where tokens are compared later, narrow where a rare mix-up only keeps a
# document longer than needed
WIDE, NARROW = 48, 32

POSTINGS = "bucket int, ids binary, counts binary, low binary, mid binary"
_POSTINGS = pa.schema(
    [("bucket", pa.int32()), ("ids", pa.binary()), ("counts", pa.binary()), ("low", pa.binary()), ("mid", pa.binary())]
)


def bucket_count(parts: int) -> int:
    """A power of two, several buckets for each shuffle partition."""
    return 1 << max(4, min(16, int(np.ceil(np.log2(parts * 4)))))


def heavy_in_slice(tokens: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that at least 1/512 of a slice's documents hold (four at least), with their counts."""
    values, counts = np.unique(tokens, return_counts=True)
    keep = counts >= max(4, -(-docs // 512))
    return values[keep], counts[keep]


def heavy_tokens(found: DataFrame, docs: int) -> np.ndarray:
    """Tokens of ``found`` (token, n) held by 1/256 of all documents are all among the result.

    At most 512 times the mean number of tokens in a document, so the size is bounded whatever the input.
    """
    least = max(64, docs // 512)
    rows = found.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("token").toArrow()
    return np.sort(rows.column("token").to_numpy().astype(np.int64).view(np.uint64))


def pack(ids: np.ndarray, tokens: np.ndarray, offsets: np.ndarray, heavy: np.ndarray, buckets: int, bits: int = WIDE) -> pa.RecordBatch:
    """Rows of POSTINGS for one slice; ``offsets`` bound each document's tokens."""
    shift = np.uint64(64 - int(np.log2(buckets)))
    doc = np.repeat(np.arange(len(ids)), np.diff(offsets))
    bucket = (tokens >> shift).astype(np.int64)
    if len(heavy) and len(tokens):
        at = np.minimum(np.searchsorted(heavy, tokens), len(heavy) - 1)
        often = heavy[at] == tokens
        # heavy tokens keep their top bits in the bucket number, below zero, and are dealt by slice
        bucket = np.where(often, -1 - bucket, bucket)
    order = np.argsort(bucket, kind="stable")
    bucket, doc, tokens = bucket[order], doc[order], tokens[order]
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(bucket))
    names, packed, n_of, low, mid = [], [], [], [], []
    for a, b in zip(cuts, ends):
        there, n = np.unique(doc[a:b], return_counts=True)
        names.append(int(bucket[a]))
        packed.append(ids[there].astype(np.int64).tobytes())
        n_of.append(n.astype(np.uint32).tobytes())
        low.append((tokens[a:b] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes())
        mid.append(((tokens[a:b] >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.uint16).tobytes() if bits == WIDE else b"")
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.int32()), *(pa.array(x, pa.binary()) for x in (packed, n_of, low, mid))], schema=_POSTINGS
    )


def deal(postings: DataFrame, parts: int) -> DataFrame:
    """Buckets to partitions; heavy rows (below zero) by slice."""
    key = F.when(F.col("bucket") >= 0, F.col("bucket").cast("long")).otherwise(F.xxhash64("ids", "bucket"))
    return postings.repartition(parts, key)


def unpack(batches: Iterator[pa.RecordBatch], buckets: int, bits: int = WIDE) -> Iterator[tuple[bool, np.ndarray, np.ndarray]]:
    """(heavy, document ids, tokens) of each bucket of a partition, and of the heavy rows one by one.

    Tokens keep ``bits`` low bits and the bucket's bits on top.
    """
    shift = np.uint64(64 - int(np.log2(buckets)))
    mask = np.uint64((1 << bits) - 1)
    held: dict[int, list[tuple[bytes, bytes, bytes, bytes]]] = {}

    def rows(parts):
        ids = np.concatenate([np.frombuffer(x[0], np.int64) for x in parts])
        n = np.concatenate([np.frombuffer(x[1], np.uint32) for x in parts])
        low = np.concatenate([np.frombuffer(x[2], np.uint32) for x in parts]).astype(np.uint64)
        if bits == WIDE:
            mid = np.concatenate([np.frombuffer(x[3], np.uint16) for x in parts]).astype(np.uint64)
            low |= mid << np.uint64(32)
        return np.repeat(ids, n), low

    for batch in batches:
        for bucket, *rest in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if bucket < 0:
                ids, tokens = rows([rest])
                yield True, ids, (tokens & mask) | (np.uint64(-1 - bucket) << shift)
            else:
                held.setdefault(bucket, []).append(tuple(rest))
    while held:
        bucket, parts = held.popitem()
        ids, tokens = rows(parts)
        yield False, ids, (tokens & mask) | (np.uint64(bucket) << shift)


def cut(tokens: np.ndarray, buckets: int, bits: int = WIDE) -> np.ndarray:
    """Tokens as ``unpack`` gives them back: bits between the bucket's and the low ones are lost."""
    shift = np.uint64(64 - int(np.log2(buckets)))
    return (tokens & np.uint64((1 << bits) - 1)) | ((tokens >> shift) << shift)


def frequencies(ids: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Postings in order of token and the number of different documents that hold each one's token."""
    order = np.lexsort((ids, tokens))
    ids, tokens = ids[order], tokens[order]
    if not len(tokens):
        return ids, tokens, np.zeros(0, np.int64)
    fresh = np.concatenate([[True], tokens[1:] != tokens[:-1]])
    other = fresh | np.concatenate([[True], ids[1:] != ids[:-1]])
    run = np.cumsum(fresh) - 1
    return ids, tokens, np.bincount(run, weights=other).astype(np.int64)[run]


GROUPS = "g int, ids binary, counts binary, vals binary"


def to_groups(ids: np.ndarray, values: np.ndarray, groups: int) -> pa.RecordBatch:
    """Values by document in packed rows of GROUPS, one for each group of documents."""
    g = (mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(groups)).astype(np.int32)
    order = np.lexsort((ids, g))
    ids, values, g = ids[order], values[order], g[order]
    cuts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
    rows = []
    for a, b in zip(cuts, np.append(cuts[1:], len(g))):
        own, n = np.unique(ids[a:b], return_counts=True)
        rows.append((int(g[a]), own.astype(np.int64).tobytes(), n.astype(np.uint32).tobytes(), values[a:b].tobytes()))
    columns = list(zip(*rows)) if rows else [()] * 4
    types = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["g", "ids", "counts", "vals"])


def from_groups(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[tuple[int, np.ndarray]]:
    """(document, its sorted distinct values) of a partition of GROUPS rows."""
    parts = [x for batch in batches for x in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)))]
    if not parts:
        return
    ids = np.repeat(
        np.concatenate([np.frombuffer(x[0], np.int64) for x in parts]),
        np.concatenate([np.frombuffer(x[1], np.uint32) for x in parts]),
    )
    values = np.concatenate([np.frombuffer(x[2], kind) for x in parts])
    order = np.lexsort((values, ids))
    ids, values = ids[order], values[order]
    cuts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    for a, b in zip(cuts, np.append(cuts[1:], len(ids))):
        yield int(ids[a]), np.unique(values[a:b])
