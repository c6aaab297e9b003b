"""Near duplicates: an exact Jaccard join of shingle sets that skips by set relations.

1. One signature per document: the size of its set of distinct shingles and a digest of the set. Documents with
   one set form a class; only its smallest id goes on.
2. A set can only have a partner if enough of its smallest hashes occur in other documents (prefixes of the sets in
   hash order). All others leave before any set is gathered.
3. Of the remaining sets only tokens that at least two of them hold matter to any intersection. They are put in
   order from rare to frequent and the prefix that every partner must hit goes into the index lists.
4. Leaders: a set is compared with the smallest set that it meets most often in the lists. Groups of near copies
   collapse here, one comparison for each set.
5. Index skipping: what remains are lists with sets of different components. Lists are summarised in blocks by size
   and position; pairs of blocks whose bound on the intersection is too low are skipped unread.
6. Answer skipping: a pair is judged from its leaders' distance first. The Jaccard distance is a metric, so a
   leader pair that is too far or near enough settles its followers' pairs; only the rest are intersected.
7. Components of all links by star contraction.
8. If asked for, the number of links: those between leaders' components are known by then, those inside are counted
   from all pairs of a component's sets, in salted pairs of blocks; copies count by their number.

Shingles are compared as 64-bit hashes within a pair.

Defined results: null or blank texts have an empty set, n_shingles 0, and are linked with nothing. Rows that repeat
a doc_id count once (with different texts: the one whose set has the smallest digest). Rows without a doc_id are
left out. Other columns are ignored, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange, words
from .graph import components
from .storage import broadcast_up_to, partitions, stored

BLOCK = 128  # sets of a component that are intersected with each other or another block at once
COLUMNS = 4096  # tokens of two blocks that are counted at once
SMALL_ROWS = 400_000  # up to here an id list (32 bytes a row at most) is broadcast; beyond it both sides are shuffled


def need(n, percent: int):
    """Least size of an intersection with any partner of a set of n."""
    return -(-n * percent // 100)


def prefix_size(n, percent: int):
    return n - need(n, percent) + np.maximum(1, n // 4)


def prefix_need(n, percent: int):
    return np.maximum(1, need(n, percent) // 4)


def shingle_sets(texts, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    buf, offsets = words.text_buffer(texts)
    starts, ends, first = words.word_spans(buf, offsets)
    h = words.word_hashes(buf, starts, ends, lower=True)
    windows, at = words.window_hashes(h, first, k)
    out = []
    for i in range(len(offsets) - 1):
        if at[i + 1] > at[i]:
            out.append(np.unique(windows[at[i] : at[i + 1]]))
        elif first[i + 1] > first[i]:
            out.append(words.window_hashes(h[first[i] : first[i + 1]], np.array([0, first[i + 1] - first[i]]), int(first[i + 1] - first[i]))[0])
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_key(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


_SIGNATURES = pa.schema(
    [("doc_id", pa.int64()), ("key", pa.binary()), ("n", pa.int64()), ("token", pa.int64()), ("docs", pa.int64())]
)


def _signatures(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "text"):
            sets = shingle_sets(batch.column("text"), k)
            tokens, docs = exchange.heavy_in_slice(np.concatenate(sets), len(sets))
            n, m = len(sets), len(tokens)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column("doc_id"), pa.nulls(m, pa.int64())]),
                    pa.array([set_key(x) if len(x) else None for x in sets] + [None] * m, pa.binary()),
                    pa.array([len(x) for x in sets] + [None] * m, pa.int64()),
                    pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(tokens.view(np.int64))]),
                    pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(docs.astype(np.int64))]),
                ],
                schema=_SIGNATURES,
            )

    return run


def _packed(k: int, percent: int, heavy: np.ndarray, buckets: int, prefix: bool):
    """Postings of all documents' prefixes in hash order, or of the whole sets of the rows that bear their key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches, "text"):
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            sets = shingle_sets(batch.column("text"), k)
            if prefix:
                sets = [x[: prefix_size(len(x), percent)] if len(x) else x for x in sets]
            else:
                keys = batch.column("key").to_pylist()
                sets = [x if set_key(x) == key else x[:0] for x, key in zip(sets, keys)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
            yield exchange.pack(ids, np.concatenate(sets), offsets, heavy, buckets, exchange.NARROW if prefix else exchange.WIDE)

    return run


def _shared_counts(buckets: int, groups: int):
    """How many of a partition's shared tokens each document has, packed by group of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for often, ids, tokens in exchange.unpack(batches, buckets, exchange.NARROW):
            if not often:
                ids, tokens, df = exchange.frequencies(ids, tokens)
                ids = ids[df > 1]
            found.append(ids)
        if found:
            ids, c = np.unique(np.concatenate(found), return_counts=True)
            yield exchange.to_groups(ids, c.astype(np.uint32), groups)

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(a, b) for batch in batches for a, b in zip(*(batch.column(i).to_pylist() for i in (1, 3)))]
    if parts:
        ids, c = (np.concatenate([np.frombuffer(x, t) for x in col]) for col, t in zip(zip(*parts), (np.int64, np.uint32)))
        ids, at = np.unique(ids, return_inverse=True)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.bincount(at, weights=c).astype(np.int64))], ["doc_id", "c"])


def _groups(ids: np.ndarray, n: int) -> np.ndarray:
    return (words.mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(n)).astype(np.int32)


def _shared_postings(buckets: int, groups: int):
    """Shared tokens with a rank that grows with their frequency, by group of documents."""
    schema = pa.schema([("g", pa.int32()), ("ids", pa.binary()), ("tokens", pa.binary()), ("ranks", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for often, ids, tokens in exchange.unpack(batches, buckets):
            if often:
                found.append((ids, tokens, np.full(len(ids), exchange.HEAVY, np.uint8)))
            else:
                ids, tokens, df = exchange.frequencies(ids, tokens)
                keep = df > 1
                rank = np.minimum(exchange.HEAVY - 1, 6 * np.log2(df[keep])).astype(np.uint8)
                found.append((ids[keep], tokens[keep], rank))
        if not found:
            return
        ids, tokens, ranks = (np.concatenate(x) for x in zip(*found))
        g = _groups(ids, groups)
        order = np.lexsort((ids, g))
        ids, tokens, ranks, g = ids[order], tokens[order], ranks[order], g[order]
        cuts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
        rows = [
            (int(g[a]), ids[a:b].tobytes(), tokens[a:b].tobytes(), ranks[a:b].tobytes())
            for a, b in zip(cuts, np.append(cuts[1:], len(g)))
        ]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows) if rows else ([],) * 4, schema.types)], schema=schema)

    return run


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document: its shared tokens, rare ones first."""
    parts = [(a, b, c) for batch in batches for a, b, c in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)))]
    if not parts:
        return
    ids, tokens, ranks = (np.concatenate([np.frombuffer(x, t) for x in col]) for col, t in zip(zip(*parts), (np.int64, np.uint64, np.uint8)))
    order = np.lexsort((tokens, ranks, ids))
    ids, tokens = ids[order], tokens[order]
    once = np.concatenate([[True], (ids[1:] != ids[:-1]) | (tokens[1:] != tokens[:-1])])
    ids, tokens = ids[once], tokens[once]
    cuts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    ends = np.append(cuts[1:], len(ids))
    for a in range(0, len(cuts), 1024):
        some = list(zip(cuts[a : a + 1024], ends[a : a + 1024]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(ids[i]) for i, _ in some], pa.int64()), pa.array([tokens[i:j].tobytes() for i, j in some], pa.binary())],
            ["doc_id", "tokens"],
        )


def _index(percent: int):
    """Index postings: the tokens of a set that every partner must hit, with their position in the whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, n, blob in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "tokens"))):
                tokens = np.frombuffer(blob, np.int64)
                alone = n - len(tokens)
                take = tokens[: max(0, n - need(n, percent) + 1 - alone)]
                m = len(take)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(take), pa.array(np.full(m, i)), pa.array(np.full(m, n)), pa.array(alone + np.arange(m))],
                    ["token", "doc_id", "n", "pos"],
                )

    return run


def _intersections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("a_tokens", "b_tokens")))
        both = []
        for x, y in rows:
            x, y = np.sort(np.frombuffer(x, np.uint64)), np.sort(np.frombuffer(y, np.uint64))
            if len(x) > len(y):
                x, y = y, x
            at = np.minimum(np.searchsorted(y, x), max(len(y) - 1, 0))
            both.append(int(np.count_nonzero(y[at] == x)) if len(y) else 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), batch.column("a_n"), batch.column("b_n"), pa.array(both, pa.int64())],
            ["a", "b", "a_n", "b_n", "both"],
        )


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, a_n, b_n, both, distance) of the pairs (a, b), from their sets."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("a_n"), F.col("tokens").alias("a_tokens"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("b_n"), F.col("tokens").alias("b_tokens"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    out = joined.mapInArrow(_intersections, "a long, b long, a_n long, b_n long, both long")
    return out.withColumn("distance", 1 - F.col("both") / (F.col("a_n") + F.col("b_n") - F.col("both")))


def _linked(percent: int):
    return F.expr(f"100 * both >= {percent} * (a_n + b_n - both)")


def candidate_sets(docs: DataFrame, signatures: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Classes (key, doc_id, n) that may have a partner, and their sets (doc_id, n, tokens)."""
    spark = docs.sparkSession
    parts = partitions(spark)
    buckets = exchange.bucket_count(parts)
    heavy = exchange.heavy_tokens(
        signatures.where("token is not null").select("token", F.col("docs").alias("n")),
        signatures.where("doc_id is not null").count(),
    )
    sig = signatures.where("doc_id is not null and n > 0").groupBy("doc_id").agg(F.min(F.struct("key", "n")).alias("s")).select("doc_id", "s.*")
    postings = docs.mapInArrow(_packed(k, percent, heavy, buckets, True), exchange.POSTINGS)
    counts = exchange.deal(postings, parts).mapInArrow(_shared_counts(buckets, 4 * parts), exchange.GROUPS)
    counts = counts.repartition(parts, "g").mapInArrow(_summed, "doc_id long, c long")
    enough = F.expr(f"c >= greatest(1, ceil(n * {percent} / 100) div 4)")
    able = counts.join(sig, "doc_id").where(enough)
    classes = stored(able.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.min("n").alias("n")), "classes")
    rows = docs.join(broadcast_up_to(classes, SMALL_ROWS).select("doc_id", "key"), "doc_id")
    postings = rows.mapInArrow(_packed(k, percent, heavy, buckets, False), exchange.POSTINGS)
    shared = exchange.deal(postings, parts).mapInArrow(
        _shared_postings(buckets, 4 * parts), "g int, ids binary, tokens binary, ranks binary"
    )
    gathered = shared.repartition(parts, "g").mapInArrow(_gathered, "doc_id long, tokens binary")
    sets = gathered.join(classes.select("doc_id", "n"), "doc_id").where(f"length(tokens) div 8 >= ceil(n * {percent} / 100)")
    return classes, stored(sets.select("doc_id", "n", "tokens"), "sets")


def _counted(percent: int):
    """Links of each set with the sets of another block of its component, or of its own, by their copies."""

    def run(key, table):
        lo, hi = key[1].as_py(), key[2].as_py()
        ids, n, c, block = (table.column(x).to_numpy() for x in ("doc_id", "n", "c", "block"))
        tokens = [np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()]
        a, b = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        sums = np.zeros(len(ids), np.int64)
        if len(a) and len(b):
            names, column = np.unique(np.concatenate(tokens), return_inverse=True)
            row = np.repeat(np.arange(len(ids)), [len(x) for x in tokens])
            order = np.argsort(column, kind="stable")
            row, column = row[order], column[order]
            both = np.zeros((len(a), len(b)), np.int64)
            for first in range(0, len(names), COLUMNS):
                x, y = np.searchsorted(column, [first, first + COLUMNS])
                held = np.zeros((len(ids), min(COLUMNS, len(names) - first)), np.float32)
                held[row[x:y], column[x:y] - first] = 1
                both += (held[a] @ held[b].T).astype(np.int64)
            linked = 100 * both >= percent * (n[a][:, None] + n[b][None, :] - both)
            if lo == hi:
                np.fill_diagonal(linked, False)
            sums[a] = linked @ c[b]
            if lo != hi:
                sums[b] = linked.T @ c[a]
        return pa.table({"doc_id": pa.array(ids), "links": pa.array(sums)})

    return run


def link_counts(sets: DataFrame, copies: DataFrame, first: DataFrame, cross: DataFrame, percent: int) -> DataFrame:
    """(doc_id, links) of the sets with links: how many documents of other classes each is linked with.

    ``copies`` has (doc_id, c) of each class, ``first`` the leaders' components and ``cross`` all links between them.
    Inside a component every two sets are intersected, in pairs of salted blocks of about BLOCK sets.
    """
    blocks = stored(first.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "blocks")
    known = first.withColumnRenamed("node", "doc_id").join(blocks, "component").join(copies, "doc_id")
    known = known.withColumn("block", F.expr("cast(pmod(xxhash64(doc_id), blocks) as int)"))
    known = known.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    known = known.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
    met = sets.join(known, "doc_id").select("doc_id", "n", "tokens", "c", "block", "component", "lo", "hi")
    inside = met.groupBy("component", "lo", "hi").applyInArrow(_counted(percent), "doc_id long, links long")
    pairs = cross.select("u", "v").union(cross.select("v", "u"))
    outside = pairs.join(copies.select(F.col("doc_id").alias("v"), "c"), "v").select(F.col("u").alias("doc_id"), F.col("c").alias("links"))
    return inside.union(outside).groupBy("doc_id").agg(F.sum("links").alias("links"))


def links(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links (u, v) that connect every component of the similarity graph over ``sets``, all of them true links; the
    components (node, component) of the leaders' links alone; and all links (u, v) between different ones of these."""
    index = stored(sets.mapInArrow(_index(percent), "token long, doc_id long, n long, pos long"), "index")

    # leaders
    heads = index.groupBy("token").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a < z").select("token", "a")
    met = index.join(heads, "token").where("a < doc_id").groupBy("doc_id", "a").agg(F.count("*").alias("c"))
    best = met.groupBy("doc_id").agg(F.max(F.struct("c", -F.col("a"))).alias("m")).select((-F.col("m.col2")).alias("a"), F.col("doc_id").alias("b"))
    led = stored(compared(best, sets).where(_linked(percent)).select("a", "b", "distance"), "led")
    first = stored(components(led.select(F.col("a").alias("u"), F.col("b").alias("v"))), "components")

    # blocks of lists with several components
    known = index.join(first.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    size = F.floor(F.log(F.col("n")) / F.log(F.lit(1.25)))
    known = stored(known.withColumn("size", size).withColumn("part", F.expr("16 * pos div n")), "known")
    mixed = known.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("token")
    block = known.join(mixed, "token").groupBy("token", "component", "size", "part").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("pos").alias("at")
    )
    one = block.select("token", *(F.col(c).alias(f"a_{c}") for c in block.columns[1:]))
    two = block.select("token", *(F.col(c).alias(f"b_{c}") for c in block.columns[1:]))
    fit = F.expr(
        f"a_component < b_component and 100 * a_most >= {percent} * b_least and 100 * b_most >= {percent} * a_least and "
        f"(100 + {percent}) * least(a_most - a_at, b_most - b_at) >= {percent} * (a_least + b_least)"
    )
    met = one.join(two, "token").where(fit).select("token", "a_component", "a_size", "a_part", "b_component", "b_size", "b_part")
    left = known.select("token", *(F.col(c).alias(f"a_{c}") for c in ("component", "size", "part", "n", "pos")), F.col("doc_id").alias("a"))
    right = known.select("token", *(F.col(c).alias(f"b_{c}") for c in ("component", "size", "part", "n", "pos")), F.col("doc_id").alias("b"))
    bound = F.expr(
        f"100 * a_n >= {percent} * b_n and 100 * b_n >= {percent} * a_n and "
        f"(100 + {percent}) * least(a_n - a_pos, b_n - b_pos) >= {percent} * (a_n + b_n)"
    )
    pairs = (
        met.join(left, ["token", "a_component", "a_size", "a_part"])
        .join(right, ["token", "b_component", "b_size", "b_part"])
        .where(bound)
        .select("a", "b")
        .distinct()
    )

    # followers' pairs from their leaders' distance
    far, slack = 1 - percent / 100, 1e-9
    led_by = led.select(F.col("b").alias("id"), F.col("a").alias("leader"), "distance")
    for side in ("a", "b"):
        mine = led_by.select(F.col("id").alias(side), F.col("leader").alias(f"{side}_leader"), F.col("distance").alias(f"{side}_off"))
        pairs = pairs.join(mine, side, "left").withColumn(f"{side}_leader", F.coalesce(f"{side}_leader", side)).withColumn(f"{side}_off", F.coalesce(f"{side}_off", F.lit(0.0)))
    pairs = stored(pairs, "pairs")
    heads = compared(pairs.select(F.col("a_leader").alias("a"), F.col("b_leader").alias("b")).distinct(), sets)
    heads = heads.select(F.col("a").alias("a_leader"), F.col("b").alias("b_leader"), "distance")
    judged = pairs.join(heads, ["a_leader", "b_leader"]).withColumn("off", F.col("a_off") + F.col("b_off"))
    judged = stored(judged.where(F.col("distance") - F.col("off") <= far + slack), "judged")
    sure = F.col("distance") + F.col("off") <= far - slack
    rest = compared(judged.where(~sure), sets).where(_linked(percent))
    pieces = led.select(F.col("a").alias("u"), F.col("b").alias("v"))
    cross = stored(judged.where(sure).select("a", "b").union(rest.select("a", "b")).toDF("u", "v"), "cross")
    return pieces.union(cross), first, cross


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, with_links: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id) of each document, and n_links if asked for.

    Two documents are linked when 100 * intersection >= percent * union of their sets of k-word shingles; words are
    lower-cased in A-Z only. ``component_id`` is the smallest id reachable by links, ``class_id`` the smallest id with
    the same set, ``n_links`` the number of other documents that it is linked with, copies too. ``percent`` from 50 to 100.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    signatures = stored(docs.mapInArrow(_signatures(k), "doc_id long, key binary, n long, token long, docs long"), "signatures")
    classes, sets = candidate_sets(docs, signatures, k, percent)
    pieces, first, cross = links(sets, percent)
    found = components(pieces)
    sig = signatures.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("key", "n")).alias("s")).select("doc_id", "s.*")
    copies = sig.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("c"))
    own = F.lit(0).cast("long")
    if with_links:
        copies = stored(copies, "counts")
        several = link_counts(sets, copies.select(F.col("class_id").alias("doc_id"), "c"), first, cross, percent)
        copies = copies.join(several.withColumnRenamed("doc_id", "class_id"), "class_id", "left")
        own = F.coalesce("links", own) + F.col("c") - 1
    copies = copies.withColumn("n_links", own)
    copies = copies.join(found.select(F.col("node").alias("class_id"), "component"), "class_id", "left").where("c > 1 or component is not null")
    copies = stored(copies, "copies")  # a plain join, whose hot keys can be split
    out = sig.join(copies.select("key", "class_id", "component", "n_links"), "key", "left")
    mine = F.coalesce("class_id", "doc_id")
    out = out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", mine).alias("component_id"), mine.alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )
    return out if with_links else out.drop("n_links")
