"""Spelling variants: words one edit apart, found through pivotal grams, and the frequent form each belongs to.

1. Words are counted in each task before they are shuffled. ``drop_every`` takes one letter out of some occurrences, by a
   checksum of the document and the word, as misspellings to be found again.
2. Bigrams are ranked from rare to frequent. A word's gram prefix is its three rarest bigrams with their positions (one
   edit changes two at most), and all others of the last one's kind. Of these, dynamic programming chooses two disjoint
   ones with the fewest holders: the pivots. One edit leaves one of them whole, so of two near words one has a pivot
   in the other's prefix, at most one place off.
3. The edit lies on one side of that pivot: on the other side the words agree, pivot included, which fixes the place. On
   the side of the edit they agree in the first or the last half at least. Pivots and prefixes are therefore indexed
   under the agreeing side, the shorter word's length and a half of the rest; a gram that many words hold is thus dealt
   by its surroundings and no list of a gram is ever gathered.
4. Pairs that meet are verified by edit distance, counted once, and give each word its near words, its form and, by
   pointer jumping, its root.

Defined results: null texts have no words, a null doc_id counts as an empty one in the checksum; rows that repeat count as
often as they occur; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import stored

RUN = re.compile("[a-zÀ-ÿ]+")
HELD = 300_000  # distinct words a task counts before it passes them on
SLICE = 1 << 20  # characters of a text that are split at once
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _parts(text: str) -> Iterator[str]:
    """The text with A-Z lower-cased, in slices that no word crosses."""
    text = text.encode().translate(_LOWER).decode()
    at = 0
    while at < len(text):
        end = at + SLICE
        if end < len(text):
            tail = RUN.match(text, end)
            end = tail.end() if tail else end
        yield text[at:end]
        at = end


def _counts(least: int, drop_every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        flushed = lambda: pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                seed = zlib.crc32(b"%s:" % (b"" if doc is None else str(doc).encode()))
                for part in _parts(text.as_py() or ""):
                    for word, n in Counter(RUN.findall(part)).items():
                        if len(word) < least:
                            continue
                        if drop_every:
                            h = zlib.crc32(word.encode(), seed)
                            if h % drop_every == 0:
                                at = h % len(word)
                                word = word[:at] + word[at + 1 :]
                                if len(word) < least:
                                    continue
                        held[word] += n
                    if len(held) > HELD:
                        yield flushed()
                        held.clear()
        yield flushed()

    return run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, drop_every: int = 199) -> DataFrame:
    """(word, n) of the words of at least ``least`` letters; ``drop_every=0`` leaves them as they are."""
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_counts(least, drop_every), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def prefix_grams(word: str, holders: dict[str, int]) -> list[tuple[int, int, str]]:
    """(holders, position, bigram) of a word's three rarest bigrams, and of all others of the last one's kind."""
    grams = sorted((holders[word[i : i + 2]], word[i : i + 2], i) for i in range(len(word) - 1))
    last = grams[min(2, len(grams) - 1)][:2]
    return [(n, i, gram) for n, gram, i in grams if (n, gram) <= last]


def pivots(grams: list[tuple[int, int, str]], want: int = 2) -> list[int]:
    """Positions of ``want`` grams that share no letter, with the fewest holders in sum."""
    grams = sorted(grams, key=lambda g: g[1])
    # best[j][c]: the cheapest c disjoint grams among the first j
    best: list[list[tuple[int, list[int]] | None]] = [[(0, []), *[None] * want]]
    for j, (n, at, _) in enumerate(grams):
        apart = j
        while apart and grams[apart - 1][1] > at - 2:
            apart -= 1
        row = list(best[j])
        for c in range(1, want + 1):
            before = best[apart][c - 1]
            if before is not None and (row[c] is None or before[0] + n < row[c][0]):
                row[c] = (before[0] + n, [*before[1], at])
        best.append(row)
    return best[-1][want][1]


def keys(word: str, at: int) -> Iterator[int]:
    """Under what a gram at ``at`` is indexed: each side that may agree, with a half of the other, for both lengths."""
    n = len(word)
    for shorter in (n, n - 1):
        for side, same, rest in (("<", word[: at + 2], word[at + 2 :]), (">", word[at:], word[:at])):
            left = shorter - len(same)  # letters of the shorter word beside the part that agrees
            if left < 0:
                continue
            half = (left - 1) // 2 if left else 0
            halves = {"^" + rest[:half], "$" + rest[len(rest) - half :]} if half else {""}
            for h in halves:
                yield xxhash.xxh3_64_intdigest(f"{shorter} {side}{same} {h}") - (1 << 63)


def _indexed(holders: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                out_word, out_n, out_key, out_pivot = [], [], [], []
                for word, n in zip(part.column("word").to_pylist(), part.column("n").to_pylist()):
                    grams = prefix_grams(word, holders)
                    chosen = pivots(grams)
                    for _, at, _ in grams:
                        for key in keys(word, at):
                            out_word.append(word)
                            out_n.append(n)
                            out_key.append(key)
                            out_pivot.append(at in chosen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out_word, pa.string()), pa.array(out_n, pa.int64()), pa.array(out_key, pa.int64()), pa.array(out_pivot, pa.bool_())],
                    ["word", "n", "key", "pivot"],
                )

    return run


def near_words(counted: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n), a < b, of all pairs of words one edit apart; ``counted`` has (word, n), words of 5 letters or more."""
    grams = counted.select(F.explode(F.array_distinct(F.expr("transform(sequence(1, length(word) - 1), i -> substring(word, i, 2))"))).alias("gram"))
    holders = {r.gram: r.n for r in grams.groupBy("gram").agg(F.count("*").alias("n")).collect()}  # 90 letters: 8,100 rows at most
    index = stored(counted.select("word", "n").mapInArrow(_indexed(holders), "word string, n long, key long, pivot boolean"), "grams")
    one = index.where("pivot").select("key", F.col("word").alias("x"), F.col("n").alias("x_n"))
    two = index.select("key", F.col("word").alias("y"), F.col("n").alias("y_n"))
    met = one.join(two, "key").where("x <> y and abs(length(x) - length(y)) <= 1 and levenshtein(x, y, 1) = 1")
    low, high = F.expr("if(x < y, x, y)"), F.expr("if(x < y, y, x)")
    pairs = met.select(low.alias("a"), F.expr("if(x < y, x_n, y_n)").alias("a_n"), high.alias("b"), F.expr("if(x < y, y_n, x_n)").alias("b_n"))
    return pairs.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form) rows without cycles: forms are followed to the last, doubling the way each round."""
    links = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        more = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if links.join(more, "root", "left_semi").limit(1).count() == 0:
            return links
        links = stored(links.join(more, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "forms")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_n: int = 5, ratio: int = 5, drop_every: int = 199) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word of 6 letters or more that occurs ``least_n`` times.

    ``form`` is the most frequent near word (of equal ones the smallest) if that has ``ratio`` times the occurrences.
    """
    counted = stored(word_counts(docs, id_col, text_col, drop_every=drop_every).where(F.col("n") >= least_n), "words")
    pairs = stored(near_words(counted), "pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).union(
        pairs.select("b", F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    )
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    enough = -F.col("best.m") >= ratio * F.col("n")
    found = counted.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.m")).alias("form_n"),
    )
    found = stored(found, "found")
    last = roots(found.where("form is not null"))
    return found.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
