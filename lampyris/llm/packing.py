"""Best-two-fit packing of documents into training sequences.

Only lengths matter to a packing, and there are at most ``capacity`` of them. So the plan is made from the histogram of
lengths (bounded, whatever the input), bin pattern by bin pattern, each used as often as the counts allow; rows are
then matched to the plan by their rank among the rows of equal length. Ranks come from a counter in each task and the
running totals of the tasks' counts, so that no length's rows meet in one task.

Best-two-fit: a bin is filled greedily, longest first; then its smallest document gives way to two unpacked ones if
those fit the gap so expanded more tightly, as long as that helps.

Defined results: a null text is empty: one piece, the closing id alone. Every row gives pieces, also rows that repeat
or lack a doc_id. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words
from .storage import stored
from .units import Library, encoder

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, rank long, ids array<int>"


def _pieces(capacity: int, path: str | None, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(path, Library), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in words.slices(batches, "text", 1 << 21):
            ids, at = encode(batch.column("text"))
            docs = batch.column("doc_id").to_pylist()
            rows = []
            for doc, a, b in zip(docs, at[:-1].tolist(), at[1:].tolist()):
                own = np.append(ids[a:b], np.uint32(0)).astype("<u4")
                for piece, start in enumerate(range(0, len(own), capacity)):
                    part = own[start : start + capacity]
                    rows.append((doc, piece, start, len(part), zlib.crc32(part.tobytes()), task, int(seen[len(part)]), part.tolist() if with_ids else None))
                    seen[len(part)] += 1
            types = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return run


def fill(counts: np.ndarray) -> list[int]:
    """The lengths of one bin, from ``counts`` of what is unpacked by length (index 0 unused)."""
    capacity, left, gap, bin_ = len(counts) - 1, counts.copy(), len(counts) - 1, []
    while gap:
        there = np.flatnonzero(left[1 : gap + 1])
        if not len(there):
            break
        length = int(there[-1]) + 1
        bin_.append(length)
        left[length] -= 1
        gap -= length
    while gap:
        least = min(bin_)
        left[least] += 1
        room = gap + least
        there = np.flatnonzero(left[: min(room, capacity) + 1])
        # for each first length the longest second one that fits beside it
        below = np.zeros(room + 1, np.int64)
        below[there] = there
        below = np.maximum.accumulate(below)
        second = below[room - there]
        same = second == there
        twice = same & (left[there] < 2)
        second[twice] = below[there[twice] - 1]
        total = np.where(second > 0, there + second, 0)
        best = int(np.argmax(total)) if len(total) else 0
        if not len(total) or total[best] <= least:
            left[least] -= 1
            break
        bin_.remove(least)
        for length in (int(there[best]), int(second[best])):
            bin_.append(length)
            left[length] -= 1
        gap = room - int(total[best])
    return bin_


def plan(counts: np.ndarray) -> list[tuple[int, list[int]]]:
    """(times, lengths) of the bins that take all documents."""
    counts, out = counts.copy(), []
    while counts.any():
        bin_ = fill(counts)
        length, used = np.unique(bin_, return_counts=True)
        times = int((counts[length] // used).min())
        counts[length] -= times * used
        out.append((times, bin_))
    return out


_RANKS = 40  # bits


def slots(bins: list[tuple[int, list[int]]], capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys (length, first rank) of the places, the sequence of that rank, and the offset there."""
    taken = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for times, lengths in bins:
        offset = 0
        for length in lengths:
            rows.append(((length << _RANKS) + int(taken[length]), sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


def _placed(keys: np.ndarray, sequences: np.ndarray, offsets: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = (batch.column("length").to_numpy() << _RANKS) + batch.column("rank").to_numpy()
            at = np.searchsorted(keys, key, side="right") - 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequences[at] + key - keys[at]), pa.array(offsets[at])],
                [*names, "sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset) of every piece.

    Sequences are numbered from 0; the pieces of one follow each other from offset 0. ``with_ids=False`` leaves the
    ids null.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = stored(rows.mapInArrow(_pieces(capacity, path, with_ids), _PIECES), "pieces")
    each = pieces.groupBy("task", "length").agg((F.max("rank") + 1).alias("c"))
    before = each.withColumn("before", F.sum("c").over(Window.partitionBy("length").orderBy("task")) - F.col("c"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in each.groupBy("length").agg(F.sum("c").alias("c")).collect():  # at most ``capacity`` rows
        counts[row.length] = row.c
    places = slots(plan(counts), capacity)
    ranked = pieces.join(before.drop("c"), ["task", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    return ranked.mapInArrow(
        _placed(*places),
        "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>, sequence_id long, offset long",
    )
