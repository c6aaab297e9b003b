"""Mixture-controlled packing: deficit round-robin over source queues, to the token, in every task at once.

The documents of a source form one queue of tokens. A window (sequence) is served round by round in ``grain`` tokens: each
queue is owed its target share of the window plus what rounding kept from it before (its deficit), and the whole grains of
that are cut from its queue. Queues are served along a binary tree: a node owes its left half
``floor(slots so far * share)``, the right half the rest, so a deficit never reaches a grain at any node and what is
carried into window w is known in closed form. Any task can therefore place any token without serving the windows
before it: deficits pass windows and partitions without a scan over them, and nothing is shuffled by source.

Without ``targets`` the shares are those of the corpus, and all queues end together. With targets, a queue that ends
early leaves its share to the others (a new phase); sources without a target follow at their own shares. What no
grain fills (less than one for each queue) comes last.

All sequences are full; the rest of the corpus fills sequences whose lengths are powers of two. Nothing is padded.

Defined results: a null text is empty: the closing id alone. Rows without a source have a queue of their own, as do rows
with an empty one. Every row gives pieces, also rows that repeat or lack a doc_id. Other columns are ignored. An
empty table gives an empty result. Sources beyond the ``most`` largest, each less than 1/most of the tokens, share
hashed queues; each still has every token in one place.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from fractions import Fraction
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words
from .storage import stored
from .units import Library, encoder

CLOSING = 1
SHARED = 1024  # queues for the sources beyond the largest
_TOKENS = "doc_id long, queue_of string, task long, begin long, doc_tokens long, ids binary"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids array<int>"


def _tokens(path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(path, Library), TaskContext.get().partitionId()
        served: dict[str, int] = {}
        for batch in words.slices(batches, "text", 1 << 21):
            ids, at = encode(batch.column("text"))
            queues = batch.column("queue_of").to_pylist()
            rows, begins, n = [], [], np.diff(at) + 1
            for queue, a, b in zip(queues, at[:-1].tolist(), at[1:].tolist()):
                rows.append(np.append(ids[a:b], np.uint32(CLOSING)).astype("<u4").tobytes())
                begins.append(served.get(queue, 0))
                served[queue] = begins[-1] + b - a + 1
            columns = [batch.column("doc_id"), batch.column("queue_of"), pa.array([task] * len(n)), pa.array(begins, pa.int64())]
            names = ["doc_id", "queue_of", "task", "begin", "doc_tokens", "ids"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(n), pa.array(rows, pa.binary())], names)

    return run


def paths(counts: dict[int, int]) -> dict[int, list[tuple[int, int, bool]]]:
    """For each queue the way from the root to it: (slots of a node, slots of its left half, whether the way goes left)."""
    order = sorted(counts, key=lambda q: (-counts[q], q))
    total = [0, *accumulate(counts[q] for q in order)]
    out: dict[int, list[tuple[int, int, bool]]] = {q: [] for q in order}
    open_ = [(0, len(order))]
    while open_:
        lo, hi = open_.pop()
        if hi - lo < 2:
            continue
        cut = min(max(bisect_left(total, (total[lo] + total[hi]) // 2), lo + 1), hi - 1)
        n, left = total[hi] - total[lo], total[cut] - total[lo]
        for i in range(lo, hi):
            out[order[i]].append((n, left, i < cut))
        open_ += [(lo, cut), (cut, hi)]
    return out


def slot_of(way: list[tuple[int, int, bool]], k: int) -> int:
    """The slot of the phase in which a queue's slot ``k`` is served."""
    for n, left, goes_left in reversed(way):
        k = -(-(k + 1) * n // left) - 1 if goes_left else k * n // (n - left)
    return k


def served(way: list[tuple[int, int, bool]], lo: int, hi: int) -> tuple[int, int, int]:
    """What a queue gets of the slots ``lo`` to ``hi``: slots served before its own there, its first slot, its end."""
    before = 0
    for n, left, goes_left in way:
        a, b = lo * left // n, hi * left // n
        if goes_left:
            lo, hi = a, b
        else:
            before, lo, hi = before + b - a, lo - a, hi - b
    return before, lo, hi


def phases(tokens: dict[int, int], weights: dict[int, int], grain: int) -> list[tuple[int, dict[int, int]]]:
    """(grain, slots by queue) of each phase; ``weights`` are positive, queues without one follow after the others."""
    slots = {q: n // grain for q, n in tokens.items() if n >= grain}
    ends = {q: Fraction(slots[q], weights[q]) for q in slots if q in weights}
    out, given = [], dict.fromkeys(ends, 0)
    for end in sorted(set(ends.values())):
        upto = {q: slots[q] if ends[q] <= end else weights[q] * end.numerator // end.denominator for q in given}
        out.append((grain, {q: n - given[q] for q, n in upto.items() if n > given[q]}))
        given = {q: n for q, n in upto.items() if ends[q] > end}
    out.append((grain, {q: n for q, n in slots.items() if q not in ends}))
    out.append((1, {q: n % grain for q, n in tokens.items() if n % grain}))
    return [(g, counts) for g, counts in out if counts]


class Schedule:
    """Where each token of each queue stands."""

    def __init__(self, tokens: dict[int, int], weights: dict[int, int] | None, capacity: int, grain: int):
        self.capacity = capacity
        weights = {q: n // grain for q, n in tokens.items() if n >= grain} if weights is None else weights
        self.runs: dict[int, list[tuple]] = {q: [] for q in tokens}
        self.until: dict[int, list[int]] = {q: [] for q in tokens}
        start = 0
        for grain, counts in phases(tokens, weights, grain):
            end = start + grain * sum(counts.values())
            for q, way in paths(counts).items():
                first = self.until[q][-1] if self.until[q] else 0
                self.runs[q].append((first, start, end, grain, way))
                self.until[q].append(first + grain * counts[q])
            start = end
        # full sequences, then what is left in lengths that are powers of two
        self.full, rest = divmod(start, capacity)
        sizes = [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
        self.tail = [self.full * capacity, *accumulate(sizes, initial=self.full * capacity)][1:]

    def sequence(self, token: int) -> tuple[int, int, int]:
        """Number, first token and end of the sequence that holds the ``token``-th one served."""
        number = token // self.capacity
        if number < self.full:
            return number, number * self.capacity, (number + 1) * self.capacity
        i = bisect_right(self.tail, token) - 1
        return self.full + i, self.tail[i], self.tail[i + 1]

    def pieces(self, queue: int, begin: int, end: int) -> Iterator[tuple[int, int, int, int]]:
        """(first token, end, sequence, offset) of the pieces of a queue's tokens ``begin`` to ``end``."""
        i = bisect_right(self.until[queue], begin)
        while begin < end:
            first, start, stop, grain, way = self.runs[queue][i]
            number, lo, hi = self.sequence(start + slot_of(way, (begin - first) // grain) * grain)
            since = max(lo, start)
            before, own, until = served(way, (since - start) // grain, (min(hi, stop) - start) // grain)
            to = min(end, first + until * grain)
            yield begin, to, number, since - lo + before * grain + begin - first - own * grain
            begin = to
            if begin == self.until[queue][i]:
                i += 1


def _placed(schedule: Schedule, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [*[pa.int64()] * 7, pa.list_(pa.int32())]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]

        def packed(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            rows: list[tuple] = []
            for doc, queue, begin, n, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "queue", "begin", "doc_tokens", "ids"))):
                for a, b, number, offset in schedule.pieces(queue, begin, begin + n):
                    part = raw[4 * (a - begin) : 4 * (b - begin)]
                    ids = np.frombuffer(part, "<u4").astype(np.int32) if with_ids else None
                    rows.append((doc, a - begin, b - a, zlib.crc32(part), n, number, offset, ids))
                if len(rows) >= 8192:
                    yield packed(rows)
                    rows = []
            if rows:
                yield packed(rows)

    return run


def pack(
    docs: DataFrame,
    targets: dict[str, float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    capacity: int = 2048,
    grain: int = 8,
    most: int = 4096,
    path: str | None = None,
    with_ids: bool = True,
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids) of every piece.

    ``targets`` maps sources to their wanted parts of each window's tokens (in any unit); ``capacity`` is a multiple of
    ``grain``, both powers of two. Sequences are numbered from 0 and have no gaps. ``with_ids=False`` leaves ids null.
    """
    if capacity % grain or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two and a multiple of grain")
    # a mark in front keeps rows without a source apart from those with an empty one
    key = F.when(F.col(source_col).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(source_col).cast("string")))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), key.alias("queue_of"))
    tokens = stored(rows.mapInArrow(_tokens(path), _TOKENS), "tokens")
    each = stored(tokens.groupBy("queue_of", "task").agg(F.sum("doc_tokens").alias("n")), "queues")
    wanted = {f"+{s}": round(w * 1_000_000) for s, w in (targets or {}).items()}
    found = each.groupBy("queue_of").agg(F.sum("n").alias("n"))
    first = F.col("queue_of").isin(list(wanted)) if wanted else F.lit(False)
    largest = [r.queue_of for r in found.orderBy(first.desc(), F.desc("n"), "queue_of").limit(most).collect()]
    if not largest:
        return docs.sparkSession.createDataFrame([], _PIECES)
    named = docs.sparkSession.createDataFrame(list(enumerate(largest)), "queue int, queue_of string")  # ``most`` rows at most
    shared = (F.lit(most) + F.pmod(F.xxhash64("queue_of"), F.lit(SHARED))).cast("int")
    queued = each.join(F.broadcast(named), "queue_of", "left").withColumn("queue", F.coalesce("queue", shared))
    before = F.sum("n").over(Window.partitionBy("queue").orderBy("queue_of", "task")) - F.col("n")
    queued = stored(queued.withColumn("before", before), "before")
    total = {r.queue: r.n for r in queued.groupBy("queue").agg(F.sum("n").alias("n")).collect()}  # most + SHARED rows at most
    weights = {i: wanted[q] for i, q in enumerate(largest) if wanted.get(q)} if targets else None
    schedule = Schedule(total, weights, capacity, grain)
    placed = tokens.join(queued.drop("n"), ["queue_of", "task"]).withColumn("begin", F.col("begin") + F.col("before"))
    return placed.select("doc_id", "queue", "begin", "doc_tokens", "ids").mapInArrow(_placed(schedule, with_ids), _PIECES)
