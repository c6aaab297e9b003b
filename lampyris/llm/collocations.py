"""Phrase collocations: n-grams of word ids from an FM-index of each shard, summed across shards.

1. A shard is a few megabytes of one language's texts. Its words become local numbers; pieces end in a break. Words
   are counted across shards, and only the frequent ones stay: no other can be part of a candidate.
2. The shard's sequence is indexed: suffixes in order of their first four words, the Burrows-Wheeler column and its ranks.
   The left extensions of an interval are the column's symbols in it, the place of each follows from its rank; the
   interval found lies in that of the n-gram without its last word. So every n-gram is met as the left extension of one
   shorter n-gram and the right extension of another, and is named by the numbers of these two: exact, without hashes.
3. Counts of pairs are summed across shards in packed rows, by bucket of their names; frequent ones get numbers, which go
   back to their shards. Three and four words are enumerated from intervals whose pairs are all frequent.
4. Cuts, scores and what longer phrases hold are joins of the frequent tables alone.

Defined results: null texts have no words; a null language counts as ``und``. Every row counts, also rows that repeat or
lack a doc_id. Other columns are ignored. An empty table, or one without candidates, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words
from .storage import partitions, stored
from .units import same_bytes

SHARD = 6 << 20  # bytes of text of one language in a shard
HELD = 3  # shards' worth of text that a task holds while it fills them
ENTRIES = 1 << 19  # n-grams of all shards that meet in one bucket, about
_WORD, _SPACE, _BREAK = 0, 1, 2


def _classes() -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[[9, 32]] = _SPACE
    out[[10, 11, 12, 13, *b".,;:!?"]] = _BREAK
    return out


def _packed(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.tobytes() for x in arrays))


def _unpacked(blob: bytes, *kinds: str) -> list[np.ndarray]:
    """Arrays of one length and the given kinds."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = len(raw) // sum(np.dtype(k).itemsize for k in kinds), 0, []
    for kind in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def sequence(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """The words of a text as numbers from 1 on, with a 0 before each piece and at the end; and the words by number."""
    buf = words._LOWER[np.frombuffer(text, np.uint8)]
    kind = _classes()[buf]
    word = np.concatenate([[False], kind == _WORD, [False]])
    starts, ends = np.flatnonzero(word[1:-1] & ~word[:-2]), np.flatnonzero(word[1:-1] & ~word[2:]) + 1
    if not len(starts):
        return np.zeros(1, np.uint32), []
    breaks = np.cumsum(kind == _BREAK)[starts]
    fresh = np.concatenate([[True], breaks[1:] != breaks[:-1]])
    _, row, number = np.unique(words.word_hashes(buf, starts, ends), return_index=True, return_inverse=True)
    known = [buf[starts[i] : ends[i]].tobytes() for i in row.tolist()]
    size = ends - starts
    other = np.flatnonzero(~same_bytes(buf, starts, size, buf, starts[row][number], size[row][number]))
    if len(other):  # words that share a hash are numbered by their bytes
        at = {w: i for i, w in enumerate(known)}
        for i in other.tolist():
            number[i] = at.setdefault(buf[starts[i] : ends[i]].tobytes(), len(at))
        known = list(at)
    out = np.zeros(len(starts) + int(fresh.sum()) + 1, np.uint32)
    out[np.arange(len(starts)) + np.cumsum(fresh)] = number + 1
    return out, known


def _cut(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end where a piece does."""
    at = 0
    while len(text) - at > SHARD:
        end = at + SHARD
        while end < len(text):
            found = np.flatnonzero(_classes()[np.frombuffer(text, np.uint8, min(65_536, len(text) - end), end)] == _BREAK)
            end += int(found[0]) + 1 if len(found) else min(65_536, len(text) - end)
            if len(found):
                break
        yield text[at:end]
        at = end
    if at < len(text):
        yield text[at:]


_SHARDS = "shard long, lang string, n long, seq binary, words array<string>, counts array<long>"


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, made = TaskContext.get().partitionId(), 0
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}

    def shard(lang: str) -> pa.RecordBatch:
        nonlocal made
        seq, known = sequence(b"\n".join(held.pop(lang)))
        size.pop(lang)
        counts = np.bincount(seq, minlength=len(known) + 1)[1:]
        made += 1
        columns = [[(task << 24) + made], [lang], [int(counts.sum())], [_packed(seq)], [[w.decode() for w in known]], [counts]]
        types = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["shard", "lang", "n", "seq", "words", "counts"])

    for batch in words.slices(batches, "text"):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            for part in _cut((text or "").encode()):
                held.setdefault(lang, []).append(part)
                size[lang] = size.get(lang, 0) + len(part) + 1
                if size[lang] >= SHARD:
                    yield shard(lang)
                elif sum(size.values()) >= HELD * SHARD:
                    yield shard(max(size, key=size.__getitem__))
    for lang in list(held):
        yield shard(lang)


class Index:
    """FM-index over a sequence of word numbers; 0 is a break and ends the sequence."""

    def __init__(self, seq: np.ndarray):
        seq = seq.astype(np.int64)
        self.symbols = int(seq.max(initial=0)) + 1
        # places of the suffixes in order of their first one, two, then four words
        rank = seq
        for step in (1, 2):
            after = np.concatenate([rank[step:], np.zeros(min(step, len(rank)), np.int64)])
            rank = np.unique(rank * (int(rank.max()) + 1) + after, return_inverse=True)[1]
        places = np.argsort(rank, kind="stable")
        self.column = seq[places - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=self.symbols))])
        order = np.argsort(self.column, kind="stable")
        self.rank = np.empty(len(seq), np.int64)
        self.rank[order] = np.arange(len(seq)) - self.first[self.column[order]]

    def of_words(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the intervals of the words 1, 2, .."""
        return self.first[1:-1], self.first[2:]

    def to_the_left(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all intervals' extensions by a word to the left: which was extended, the word, start and size; by start."""
        size = hi - lo
        total = np.cumsum(size)
        row = np.repeat(lo - total + size, size) + np.arange(int(size.sum()))
        which = np.repeat(np.arange(len(lo)), size)
        word = self.column[row]
        row, which, word = row[word > 0], which[word > 0], word[word > 0]
        _, at, count = np.unique(which * self.symbols + word, return_index=True, return_counts=True)
        start = self.first[word[at]] + self.rank[row[at]]
        order = np.argsort(start)
        at = at[order]
        return which[at], word[at], start[order], count[order]


def within(lo: np.ndarray, hi: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Number of the interval (in order and apart) that holds each start; -1 if none does."""
    at = np.searchsorted(lo, start, side="right") - 1
    return np.where((at >= 0) & (start < hi[np.maximum(at, 0)]), at, -1) if len(lo) else np.full(len(start), -1)


def _dealt(names: list[np.ndarray], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of n-grams by bucket and name, the buckets that occur, and where each starts (and the last ends)."""
    h = np.zeros(len(names[0]), np.uint64)
    for x in names:
        h = words.mix(h * np.uint64(0x9E3779B97F4A7C15) + x.view(np.uint64))
    bucket = (h % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((*names[::-1], bucket))
    there, at = np.unique(bucket[order], return_index=True)
    return order, there, np.append(at, len(order))


def _rows(shard: int, names: list[np.ndarray], counts: np.ndarray, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    order, there, at = _dealt(names, buckets)
    names, counts = [x[order] for x in names], counts[order].astype(np.int32)
    for bucket, a, b in zip(there.tolist(), at[:-1].tolist(), at[1:].tolist()):
        yield shard, bucket, _packed(np.diff(names[0][a:b], prepend=0), *(x[a:b] for x in names[1:]), counts[a:b])


def _pairs_of(index: Index, numbers: np.ndarray):
    """Names, starts and counts of a shard's pairs of frequent words."""
    right, left, start, count = index.to_the_left(*index.of_words())
    return [numbers[left - 1], numbers[right]], start, count


_PACKED = "shard long, bucket int, blob binary, seq binary, numbers binary"


def _pairs(buckets: int):
    """From a shard's sequence and the numbers of its frequent words: what is left of the sequence, and its pairs."""

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        blob = next(x for x in table.column("seq").to_pylist() if x is not None)
        frequent = table.filter(pa.compute.is_valid(table.column("place")))
        place, number = frequent.column("place").to_numpy(), frequent.column("number").to_numpy()
        order = np.argsort(number)
        (seq,) = _unpacked(blob, "u4")
        new = np.zeros(int(seq.max(initial=0)) + 1, np.uint32)
        new[place[order] + 1] = np.arange(1, len(place) + 1)
        seq = new[seq]
        seq = seq[np.concatenate([[True], (seq[1:] > 0) | (seq[:-1] > 0)])]
        numbers = number[order].astype(np.int64)
        rows = []
        if len(numbers):
            names, _, count = _pairs_of(Index(seq), numbers)
            rows = [(*r, None, None) for r in _rows(shard, names, count, buckets)]
        rows.append((shard, None, None, _packed(seq), numbers.tobytes()))
        types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["shard", "bucket", "blob", "seq", "numbers"])

    return run


_LONGER = "words int, shard long, bucket int, blob binary"


def _longer(buckets: int):
    """From a shard's sequence and the numbers of its frequent pairs: its n-grams of three and four words."""

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        rows: list[tuple] = []
        head = table.filter(pa.compute.is_valid(table.column("seq")))
        numbers = np.frombuffer(head.column("numbers")[0].as_py(), np.int64)
        if len(numbers) and table.num_rows > 1:
            (seq,) = _unpacked(head.column("seq")[0].as_py(), "u4")
            index = Index(seq)
            names, start, count = _pairs_of(index, numbers)
            order, there, at = _dealt(names, buckets)
            own = np.full(len(start), -1)
            for bucket, blob in zip(table.column("bucket").to_pylist(), table.column("blob").to_pylist()):
                if blob is not None:
                    place, number = _unpacked(blob, "u4", "i8")
                    a = int(at[np.searchsorted(there, bucket)])
                    own[order[a + place.astype(np.int64)]] = number
            keep = own >= 0
            lo, hi, own = start[keep], (start + count)[keep], own[keep]
            # three words: w1 w2 is where the extension lies, w2 w3 is what was extended
            right, _, start, count = index.to_the_left(lo, hi)
            left = within(lo, hi, start)
            keep = left >= 0
            left, right, lo3, n3 = own[left[keep]], own[right[keep]], start[keep], count[keep]
            rows += [(3, *r) for r in _rows(shard, [left, right], n3, buckets)]
            # four words, by their three pairs
            last, _, start, count = index.to_the_left(lo3, lo3 + n3)
            head3 = within(lo3, lo3 + n3, start)
            keep = head3 >= 0
            head3, last = head3[keep], last[keep]
            rows += [(4, *r) for r in _rows(shard, [left[head3], left[last], right[last]], count[keep], buckets)]
        types = [pa.int32(), pa.int64(), pa.int32(), pa.binary()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 4, types)], ["words", "shard", "bucket", "blob"])

    return run


_SUMMED = "shard long, bucket int, blob binary, a long, b long, c long, n long, number long"


def _summed(words_: int, least: int):
    """From packed rows in order of bucket: the frequent n-grams with their numbers, and for pairs what goes back to each shard."""
    parts = max(2, words_ - 1)

    def rows(batches):
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("bucket", "shard", "blob")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, group in groupby(rows(batches), key=lambda r: r[0]):
            shards, names, counts = [], [], []
            for _, shard, blob in group:
                *own, count = _unpacked(blob, *["i8"] * parts, "i4")
                own[0] = np.cumsum(own[0])
                shards.append(shard)
                names.append(own)
                counts.append(count)
            size = np.array([len(c) for c in counts])
            names, counts = [np.concatenate(x) for x in zip(*names)], np.concatenate(counts).astype(np.int64)
            order = np.lexsort(names[::-1])
            names, counts = [x[order] for x in names], counts[order]
            fresh = np.concatenate([[True], np.any([x[1:] != x[:-1] for x in names], axis=0)])
            at = np.flatnonzero(fresh)
            total = np.add.reduceat(counts, at)
            often = np.flatnonzero(total >= least)
            m, number = len(often), (bucket << 40) + np.arange(len(often))
            none = pa.nulls(m, pa.int64())
            found = [pa.array(x[at[often]]) for x in names] + [none] * (3 - parts)
            back = []
            if words_ == 2 and m:
                own = np.full(len(at), -1)
                own[often] = number
                named = np.full(len(order), -1)
                named[order] = own[np.cumsum(fresh) - 1]
                ends = np.cumsum(size)
                for shard, a, b in zip(shards, (ends - size).tolist(), ends.tolist()):
                    place = np.flatnonzero(named[a:b] >= 0)
                    if len(place):
                        back.append((shard, bucket, _packed(place.astype(np.uint32), named[a:b][place])))
            k = len(back)
            sent = [pa.array(c, t) for c, t in zip(zip(*back) if back else [()] * 3, (pa.int64(), pa.int32(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.concat_arrays([pa.nulls(m, x.type), x]) for x in sent),
                    *(pa.concat_arrays([x, pa.nulls(k, pa.int64())]) for x in (*found, pa.array(total[often]), pa.array(number))),
                ],
                ["shard", "bucket", "blob", "a", "b", "c", "n", "number"],
            )

    return run


def _sums(packed: DataFrame, words_: int, least: int, parts: int) -> DataFrame:
    rows = packed.select("bucket", "shard", "blob").repartition(parts, "bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(_summed(words_, least), _SUMMED)


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30) -> tuple[DataFrame, ...]:
    """What occurs ``least`` times: words (number, lang, word, f), pairs (number, a, b, f) by their words, triples
    (a, b, f) by their pairs and fours (a, b, c, f) by theirs; and (lang, n), all words of each language."""
    parts = partitions(docs.sparkSession)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang")
    rows = docs.select(lang, F.col(text_col).cast("string").alias("text"))
    shards = stored(rows.mapInArrow(_shards, _SHARDS), "shards")
    sizes = shards.groupBy("lang").agg(F.sum("n").alias("n"))
    total = shards.agg(F.sum("n")).head()[0] or 0
    buckets = min(1 << 16, max(parts, -(-total // ENTRIES)))

    each = shards.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w"))
    each = each.select("shard", "lang", "place", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    single = each.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    single = stored(single.withColumn("number", F.monotonically_increasing_id()), "words")

    seqs = shards.select("shard", "seq", F.lit(None).cast("int").alias("place"), F.lit(None).cast("long").alias("number"))
    known = each.join(single, ["lang", "word"]).select("shard", F.lit(None).cast("binary").alias("seq"), "place", "number")
    grouped = seqs.union(known).groupBy("shard")
    run = _pairs(buckets)
    packed = stored(grouped.applyInArrow(lambda table: run(table), _PACKED), "packed")

    summed = stored(_sums(packed.where("blob is not null"), 2, least, parts), "pairs")
    pairs = summed.where("number is not null").select("number", "a", "b", F.col("n").alias("f"))
    back = summed.where("blob is not null").select("shard", "bucket", "blob", F.lit(None).cast("binary").alias("seq"), F.lit(None).cast("binary").alias("numbers"))
    more = _longer(buckets)
    longer = packed.where("seq is not null").union(back).groupBy("shard").applyInArrow(lambda table: more(table), _LONGER)
    longer = stored(longer, "longer")
    triples = stored(_sums(longer.where("words = 3"), 3, least, parts).select("a", "b", F.col("n").alias("f")), "triples")
    fours = stored(_sums(longer.where("words = 4"), 4, least, parts).select("a", "b", "c", F.col("n").alias("f")), "fours")
    return single, pairs, triples, fours, sizes


def _scored(df: DataFrame, cuts: list[tuple]) -> DataFrame:
    """``df`` with the l, r and score of the cut that scores lowest, the first of equals."""
    score = lambda x, y: F.expr(f"(cast(f as decimal(25, 0)) * 2000000) div (cast({x} as decimal(25, 0)) + {y})")
    every = [F.struct(score(x, y).alias("score"), F.lit(k).alias("k"), F.col(x).alias("l"), F.col(y).alias("r")) for k, (x, y) in enumerate(cuts)]
    best = F.array_min(F.array(*every))
    return df.withColumn("best", best).select("lang", "phrase", F.col("f").alias("a"), "best.l", "best.r", "best.score")


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 30, covered: int = 80, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two to four words.

    ``a`` is the phrase's count, ``l`` and ``r`` those of its two parts at the lowest-scoring cut, ``n`` the language's words.
    A phrase is left out if one that holds it has ``covered`` hundredths of its occurrences.
    """
    single, pairs, triples, fours, sizes = frequent_phrases(docs, text_col, lang_col, least)
    left = single.select(F.col("number").alias("a"), "lang", F.col("word").alias("w1"), F.col("f").alias("f1"))
    right = single.select(F.col("number").alias("b"), F.col("word").alias("w2"), F.col("f").alias("f2"))
    two = pairs.join(left, "a").join(right, "b").withColumn("phrase", F.concat_ws(" ", "w1", "w2"))
    two = stored(two.select("number", "lang", "phrase", F.col("w2").alias("last"), "f", "f1", "f2"), "two")

    x = two.select(F.col("number").alias("a"), "lang", F.col("phrase").alias("head"), "f1", F.col("f").alias("f12"))
    y = two.select(F.col("number").alias("b"), "last", F.col("f").alias("f23"), F.col("f2").alias("f3"))
    three = triples.join(x, "a").join(y, "b").withColumn("phrase", F.concat_ws(" ", "head", "last"))
    three = stored(three.select("a", "b", "lang", "phrase", "last", "f", "f1", "f12", "f23", "f3"), "three")

    x = three.select("a", "b", "lang", F.col("phrase").alias("head"), "f1", "f12", F.col("f").alias("f123"))
    y = three.select(F.col("a").alias("b"), F.col("b").alias("c"), "last", F.col("f").alias("f234"), F.col("f23").alias("f34"), F.col("f3").alias("f4"))
    four = fours.join(x, ["a", "b"]).join(y, ["b", "c"]).withColumn("phrase", F.concat_ws(" ", "head", "last"))

    over = triples.select(F.col("a").alias("number"), "f").union(triples.select("b", "f")).groupBy("number").agg(F.max("f").alias("over"))
    over3 = fours.select("a", "b", "f").union(fours.select("b", "c", "f")).groupBy("a", "b").agg(F.max("f").alias("over"))
    free = F.col("over").isNull() | (100 * F.col("over") < covered * F.col("f"))
    two = _scored(two.join(over, "number", "left").where(free), [("f1", "f2")])
    three = _scored(three.join(over3, ["a", "b"], "left").where(free), [("f1", "f23"), ("f12", "f3")])
    four = _scored(four, [("f1", "f234"), ("f12", "f34"), ("f123", "f4")])
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = two.union(three).union(four).withColumn("rank", place).where(F.col("rank") <= top)
    return best.join(F.broadcast(stored(sizes, "sizes")), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
