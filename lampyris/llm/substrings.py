"""Substring dedup: words that an earlier document already has in a run of ``window`` words.

Recompression names phrases in rounds: first runs of one word, then pairs of neighbours. A name is a hash of what it
stands for, so it is the same in all documents without a dictionary. Whether two neighbours merge depends on
themselves alone (one hash bit each, and a limit on the length), so that equal substrings get equal phrases everywhere
but near their ends: after three rounds a phrase depends on at most ``CONTEXT`` words beyond it and has at most
``LIMITS[-1]`` words. Runs of three or more are one phrase that merges with nothing.

1. Phrases that no other text holds end a document's part in any repeat. Only phrases are gathered, not windows.
2. A window is a candidate if all phrases that its middle fixes are shared. Candidates of a slice of documents are
   reduced to their smallest document before they are dealt by their 96-bit name; that document wins everywhere.
3. Covered words of each document become spans, and the rest is kept.

Exact copies (equal word sequences) leave first: but for the smallest id all of a copy's words go, if they make a window.

Defined results: null or blank texts have no words; texts under ``window`` words lose none. Rows that repeat a doc_id and
a text count once; differing texts of one doc_id are judged each on its own and never against each other. Rows without
a doc_id are left out. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import exchange, words
from .storage import partitions, stored

LIMITS = (3, 5, 8)  # words in a phrase after each round of pairs
CONTEXT = 11  # words beyond a phrase that it depends on: 1 for runs, then 2, 3 and 5 more with the phrases so far
RUN = 3
SMALL_SPANS = 400_000  # up to here spans (24 bytes each) are broadcast; beyond it both sides are shuffled


def phrases(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names and lengths in words of the phrases of all texts, and the n + 1 offsets of each text's phrases."""
    n = len(h)
    head = np.zeros(n + 1, bool)
    head[first] = True
    start = np.flatnonzero(head[:-1] | np.concatenate([[True], h[1:] != h[:-1]])) if n else np.zeros(0, np.int64)
    length = np.diff(np.append(start, n))
    name = words.mix(h[start] + np.minimum(length, RUN).astype(np.uint64))
    frozen = length >= RUN
    for level, limit in enumerate(LIMITS, 1):
        left = words.mix(name ^ np.uint64(level * 0x9E3779B1)) >> np.uint64(63) == 0
        can = left[:-1] & ~left[1:] & ~frozen[:-1] & ~frozen[1:] & (length[:-1] + length[1:] <= limit) & ~head[start[1:]]
        joined = np.flatnonzero(can)
        name[joined] = words.mix(name[joined] * np.uint64(0xD6E8FEB86659FD93) + name[joined + 1] + np.uint64(level))
        length[joined] += length[joined + 1]
        keep = np.ones(len(name), bool)
        keep[joined + 1] = False
        name, length, start, frozen = name[keep], length[keep], start[keep], frozen[keep]
    return name, length, np.searchsorted(start, first)


def content(h: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(h.tobytes())


def _parsed(column):
    buf, offsets = words.text_buffer(column)
    starts, ends, first = words.word_spans(buf, offsets)
    return words.word_hashes(buf, starts, ends), first


_SIGNATURES = pa.schema(
    [("doc_id", pa.int64()), ("key", pa.binary()), ("n", pa.int64()), ("cid", pa.int64()), ("token", pa.int64()), ("docs", pa.int64())]
)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a text, and the digest of its words as their last column."""
    for batch in words.slices(batches, "_text"):
        h, first = _parsed(batch.column("_text"))
        keys = pa.array([content(h[a:b]) for a, b in zip(first[:-1], first[1:])], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns, keys], [*batch.schema.names, "_key"])


def _signatures():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "text"):
            h, first = _parsed(batch.column("text"))
            name, _, at = phrases(h, first)
            own = [np.unique(name[a:b]) for a, b in zip(at[:-1], at[1:])]
            tokens, docs = exchange.heavy_in_slice(np.concatenate(own), len(own))
            n, m = len(own), len(tokens)
            keys = [content(h[a:b]) for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column("doc_id"), pa.nulls(m, pa.int64())]),
                    pa.array(keys + [None] * m, pa.binary()),
                    pa.concat_arrays([pa.array(np.diff(first)), pa.nulls(m, pa.int64())]),
                    pa.array([_number(x) for x in keys] + [None] * m, pa.int64()),
                    pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(tokens.view(np.int64))]),
                    pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(docs.astype(np.int64))]),
                ],
                schema=_SIGNATURES,
            )

    return run


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in ``known``, which is sorted."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _number(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _packed(heavy: np.ndarray, buckets: int, window: int):
    """Postings of the phrases that are not heavy, under the content they stand in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "text"):
            h, first = _parsed(batch.column("text"))
            name, _, at = phrases(h, first)
            rare = ~_among(name, heavy)
            own = [
                np.unique(name[a:b][rare[a:b]]) if f - e >= window else name[:0]
                for a, b, e, f in zip(at[:-1], at[1:], first[:-1], first[1:])
            ]
            ids = np.array([_number(content(h[a:b])) for a, b in zip(first[:-1], first[1:])], np.int64)
            yield exchange.pack(ids, np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])]), heavy[:0], buckets, exchange.NARROW)

    return run


def _shared(buckets: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for _, ids, tokens in exchange.unpack(batches, buckets, exchange.NARROW):
            ids, tokens, df = exchange.frequencies(ids, tokens)
            found.append((ids[df > 1], tokens[df > 1]))
        if found:
            yield exchange.to_groups(*(np.concatenate(x) for x in zip(*found)), groups)

    return run


def _by_content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for cid, tokens in exchange.from_groups(batches, np.uint64):
        yield pa.RecordBatch.from_arrays([pa.array([cid], pa.int64()), pa.array([tokens.tobytes()], pa.binary())], ["cid", "shared"])


_WINDOWS = "bucket int, ids binary, counts binary, names binary, checks binary, places binary, variant int"


def _window_rows(bucket, ids, names, checks, places, cuts, variant):
    """Packed rows of candidates that are in order of bucket and id."""
    rows = []
    for a, b in zip(cuts, np.append(cuts[1:], len(ids))):
        fresh = np.flatnonzero(np.concatenate([[True], ids[a + 1 : b] != ids[a : b - 1]]))
        n = np.diff(np.append(fresh, b - a)).astype(np.uint32)
        rows.append((int(bucket[a]), ids[a:b][fresh].tobytes(), n.tobytes(), names[a:b].tobytes(), checks[a:b].tobytes(), places[a:b].tobytes(), variant))
    columns = list(zip(*rows)) if rows else [()] * 7
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, [pa.int32()] + [pa.binary()] * 5 + [pa.int32()])],
        ["bucket", "ids", "counts", "names", "checks", "places", "variant"],
    )


def _of_one_variant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        there = pc.unique(batch.column("variant"))
        if len(there) < 2:
            yield batch
        else:
            yield from (batch.filter(pc.equal(batch.column("variant"), v)) for v in there)


def _later(ids, names, checks):
    """Order by window and id, and which rows in it have a smaller id with the same window."""
    order = np.lexsort((ids, checks, names))
    a, b, c = ids[order], names[order], checks[order]
    fresh = np.concatenate([[True], (b[1:] != b[:-1]) | (c[1:] != c[:-1])])
    least = a[np.maximum.accumulate(np.where(fresh, np.arange(len(a)), 0))]
    return order, a > least


def _candidates(heavy: np.ndarray, buckets: int, window: int):
    margin = LIMITS[-1] - 1 + CONTEXT
    zone = window - 2 * margin
    shift = np.uint64(64 - int(np.log2(buckets)))
    often = np.unique(exchange.cut(heavy, buckets, exchange.NARROW))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(_of_one_variant(batches), "text"):
            h, first = _parsed(batch.column("text"))
            name, length, at = phrases(h, first)
            name = exchange.cut(name, buckets, exchange.NARROW)
            known = _among(name, often)
            keys = batch.column("key").to_pylist()
            for i, blob in enumerate(batch.column("shared").to_pylist()):
                a, b = at[i], at[i + 1]
                if content(h[first[i] : first[i + 1]]) != keys[i]:
                    known[a:b] = False
                elif blob:
                    known[a:b] |= _among(name[a:b], np.frombuffer(blob, np.uint64))
            total = np.concatenate([[0], np.cumsum(np.repeat(known, length))])
            names, offsets = words.window_hashes(h, first, window)
            doc = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            place = np.arange(len(names)) - offsets[doc]
            at_word = first[doc] + place
            hit = np.flatnonzero(total[at_word + margin + zone] - total[at_word + margin] == zone)
            if not len(hit):
                continue
            checks, _ = words.window_hashes(words.mix(h ^ np.uint64(0xA0761D6478BD642F)), first, window)
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)[doc[hit]]
            names, checks, places = names[hit], checks[hit].astype(np.uint32), place[hit].astype(np.uint32)
            order, later = _later(ids, names, checks)
            bucket = np.where(later, -1, (names[order] >> shift).astype(np.int64))
            order = order[np.lexsort((ids[order], bucket))]
            bucket = np.sort(bucket)
            ids, names, checks, places = ids[order], names[order], checks[order], places[order]
            cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            yield _window_rows(bucket, ids, names, checks, places, cuts, batch.column("variant")[0].as_py())

    return run


_PLACES = "g int, ids binary, counts binary, vals binary, variant int"


def _repeated(groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        found = []
        for batch in batches:
            for bucket, *rest, variant in zip(*(batch.column(i).to_pylist() for i in range(7))):
                ids = np.repeat(np.frombuffer(rest[0], np.int64), np.frombuffer(rest[1], np.uint32))
                names, checks, places = (np.frombuffer(x, t) for x, t in zip(rest[2:], (np.uint64, np.uint32, np.uint32)))
                row = (ids, names, checks, places, np.full(len(ids), variant, np.int32))
                if bucket < 0:
                    found.append((ids, places, row[4]))
                else:
                    held.setdefault(bucket, []).append(row)
        while held:
            ids, names, checks, places, variants = (np.concatenate(x) for x in zip(*held.popitem()[1]))
            order, later = _later(ids, names, checks)
            order = order[later]
            found.append((ids[order], places[order], variants[order]))
        if found:
            ids, places, variants = (np.concatenate(x) for x in zip(*found))
            for v in np.unique(variants).tolist():
                rows = exchange.to_groups(ids[variants == v], places[variants == v], groups)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([v] * rows.num_rows, pa.int32())], [*rows.schema.names, "variant"])

    return run


def _spans(window: int):
    """Covered words of each text as (start, end) pairs, in order and apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[int, list[pa.RecordBatch]] = {}
        for batch in _of_one_variant(batches):
            if batch.num_rows:
                by.setdefault(batch.column("variant")[0].as_py(), []).append(batch)
        for variant, own in by.items():
            for doc, places in exchange.from_groups(iter(own), np.uint32):
                places = places.astype(np.int64)
                fresh = np.flatnonzero(np.concatenate([[True], places[1:] > places[:-1] + window]))
                ends = places[np.append(fresh[1:] - 1, len(places) - 1)] + window
                spans = [{"start": int(a), "end": int(b)} for a, b in zip(places[fresh], ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc], pa.int64()), pa.array([variant], pa.int32()), pa.array([spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                    ["doc_id", "variant", "spans"],
                )

    return run


def _with_keys(docs: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` (with ``_text``) whose id is in the one column of ``ids``, and their ``_key``."""
    rows = docs.join(ids.toDF("_odd"), F.col(id_col).cast("long") == F.col("_odd"), "left_semi")
    return rows.mapInArrow(_keyed, T.StructType([*rows.schema.fields, T.StructField("_key", T.BinaryType())]))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """(doc_id, key, n_words, spans) of each text: word ranges [start, end) to remove; empty if none.

    ``key`` is null but for ids that have several texts: there it is the digest of the text's words. ``window`` must be more than twice the words that a phrase may depend on (38 at least).
    """
    if window < 2 * (LIMITS[-1] - 1 + CONTEXT) + 2:
        raise ValueError("window too short for the phrases")
    spark = docs.sparkSession
    parts = partitions(spark)
    buckets = exchange.bucket_count(parts)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    signatures = stored(docs.mapInArrow(_signatures(), "doc_id long, key binary, n long, cid long, token long, docs long"), "signatures")
    heavy = exchange.heavy_tokens(
        signatures.where("token is not null").select("token", F.col("docs").alias("n")),
        signatures.where("doc_id is not null").count(),
    )
    sig = signatures.where("doc_id is not null").groupBy("doc_id", "key").agg(F.first("n").alias("n"), F.first("cid").alias("cid"))
    # ids with several texts, each of which is judged: their texts are told apart by number
    odd = stored(sig.groupBy("doc_id").count().where("count > 1").select("doc_id"), "odd")
    some_odd = odd.limit(1).count() > 0
    one = sig.withColumn("variant", F.lit(0))
    if some_odd:
        number = F.row_number().over(Window.partitionBy("doc_id").orderBy("key"))
        one = one.join(odd, "doc_id", "left_anti").union(sig.join(odd, "doc_id", "left_semi").withColumn("variant", number))
    sig = stored(one, "texts") if some_odd else one
    smallest = F.min(F.struct("doc_id", "variant")).alias("s")
    firsts = sig.where(F.col("n") >= window).groupBy("key").agg(smallest, F.min("cid").alias("cid")).select("key", "s.*", "cid")

    postings = exchange.deal(docs.mapInArrow(_packed(heavy, buckets, window), exchange.POSTINGS), parts)
    shared = postings.mapInArrow(_shared(buckets, 4 * parts), exchange.GROUPS).repartition(parts, "g").mapInArrow(_by_content, "cid long, shared binary")
    known = firsts.join(shared, "cid", "left").select("doc_id", "key", "shared", "variant")
    if some_odd:
        known = stored(known, "known")
        parsed = _with_keys(docs.withColumn("_text", F.col("text")), odd, "doc_id").select("doc_id", "text", F.col("_key").alias("key"))
        rows = docs.join(known.where("variant = 0"), "doc_id").union(
            parsed.join(known.where("variant > 0"), ["doc_id", "key"]).select("doc_id", "text", "key", "shared", "variant")
        )
    else:
        rows = docs.join(known, "doc_id")
    names = rows.mapInArrow(_candidates(heavy, buckets, window), _WINDOWS)
    key = F.when(F.col("bucket") >= 0, F.col("bucket").cast("long")).otherwise(F.xxhash64("ids"))
    found = names.repartition(parts, key).mapInArrow(_repeated(4 * parts), _PLACES)
    spans = found.repartition(parts, "g").mapInArrow(_spans(window), "doc_id long, variant int, spans array<struct<start: long, end: long>>")

    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n").alias("end")))
    # heads of classes with copies, stored: a plain join, whose hot keys can be split
    first_of = stored(sig.where(F.col("n") >= window).groupBy("key").agg(F.min("doc_id").alias("head"), F.count("*").alias("c")).where("c > 1").drop("c"), "heads")
    copies = sig.join(first_of, "key", "left").join(spans, ["doc_id", "variant"], "left")
    return copies.select(
        "doc_id",
        F.when(F.col("variant") > 0, F.col("key")).alias("key"),
        F.col("n").alias("n_words"),
        F.when(F.col("head") < F.col("doc_id"), whole)
        .otherwise(F.coalesce("spans", F.array().cast("array<struct<start: long, end: long>>")))
        .alias("spans"),
    )


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a text and its spans: the spans' place is taken by the counts, the digest and the words kept."""
    for batch in batches:
        kept, n_words, n_removed = [], [], []
        for text, spans in zip(batch.column("_text").to_pylist(), batch.column("_spans").to_pylist()):
            own = (text or "").encode().split()
            left, at = [], 0
            for span in spans or ():
                left += own[at : span["start"]]
                at = span["end"]
            left += own[at:]
            n_words.append(len(own))
            n_removed.append(len(own) - len(left))
            kept.append(b" ".join(left))
        rest = [c for c in batch.schema.names if c not in ("_text", "_spans")]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in rest),
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            [*rest, "_n_words", "_n_removed", "_kept_sha256", "_kept"],
        )


def apply_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and _n_words, _n_removed, _kept_sha256, _kept (the kept words joined by one space).

    ``spans`` has (doc_id, key, spans) rows, stored; they are broadcast if they are few.
    """
    some = spans.where("size(spans) > 0").select(F.col("doc_id").alias("_id"), F.col("key").alias("_own"), F.col("spans").alias("_spans"))
    few = (some.agg(F.sum(F.size("_spans"))).head()[0] or 0) <= SMALL_SPANS
    sent = lambda df: F.broadcast(df) if few else df
    given, docs = docs.schema.fields, docs.withColumn("_text", F.col(text_col).cast("string"))
    same_id = F.col(id_col).cast("long") == F.col("_id")
    rows = docs.join(sent(some.where("_own is null").drop("_own")), same_id, "left").drop("_id")
    odd = spans.where("key is not null").select(F.col("doc_id").alias("_odd")).distinct()
    if odd.limit(1).count():
        plain = docs.join(odd, F.col(id_col).cast("long") == F.col("_odd"), "left_anti")
        several = _with_keys(docs, odd, id_col).join(sent(some.where("_own is not null")), same_id & (F.col("_key") == F.col("_own")), "left")
        plain = plain.join(sent(some.where("_own is null").drop("_own")), same_id, "left").drop("_id")
        rows = plain.union(several.drop("_id", "_own", "_key"))
    more = T.StructType().add("_n_words", "long").add("_n_removed", "long").add("_kept_sha256", "string").add("_kept", "string")
    schema = T.StructType(given + more.fields)
    return rows.mapInArrow(_kept, schema)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept): the words kept, joined by one space, and their SHA-256."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    spans = stored(repeated_spans(rows, window=window), "spans")
    found = apply_spans(rows, spans)
    return found.select("doc_id", *[F.col(f"_{c}").alias(c) for c in ("n_words", "n_removed", "kept_sha256", "kept")])
