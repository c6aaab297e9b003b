"""Ranked text search: BM25 over an inverted index or a plain scan, synonyms, vectors, fusion.

A corpus is any DataFrame with an id and a text column. Scoring touches only postings of the query's
terms; per-query statistics (document count, mean length, document frequency per query term) are scalars,
so no join is keyed by a term and a term that occurs in every document does not form a hot partition.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules, text
from . import segments
from .changes import latest_changes

K1, B = 1.2, 0.75
# Bytes of text whose postings one task counts and sorts when an index is written.
TASK_BYTES = 16 << 20
RRF_K = 60
SCORE_DIGITS = 6

# Words that describe the same trouble
SYNONYMS = {
    "flicker": ["flickering", "flickers", "blinking", "blink", "intermittent", "unstable"],
    "fire": ["spark", "sparking", "burnt"],
    "leaning": ["tilted", "bent", "collision"],
}
SYNONYM_WEIGHT = 0.5

# Concepts asked for and the patterns that show them
CONCEPTS = {
    "water_weather": ["%rain%", "%storm%", "%flood%", "%water%", "%monsoon%", "%lightning%"],
    "safety": ["%danger%", "%hazard%", "%urgent%", "%immediate%", "%fire%", "%spark%", "%exposed wire%"],
    "flicker": ["%flicker%", "%blink%", "%intermittent%", "%on and off%", "%dim%", "%buzz%"],
    "collision": ["%collision%", "%vehicle%", "%truck%", "%accident%", "%leaning%", "%bent%", "%vandal%"],
    "electrical": ["%loose%", "%short circuit%", "%overheat%", "%arcing%", "%voltage%", "%transformer%", "%cable%", "%wire%"],
    "sensor": ["%sensor%", "%timer%", "%controller%", "%daytime%"],
    "structural": ["%corros%", "%rust%", "%termite%", "%foundation%", "%structur%"],
    "thermal": ["%heat%", "%thermal%", "%temperature%", "%cold%", "%fog%"],
    "complaints": ["%resident%", "%complain%", "%owner%"],
}


# -------------------------------------------------------------------------------- index


def tokenized(corpus: DataFrame, key: str, column: str) -> DataFrame:
    """(key, tokens, n_tokens) per document."""
    return corpus.select(key, _once(text.tokens(F.col(column)).alias("tokens"))).withColumn("n_tokens", F.size("tokens"))


def _once(*columns: Column) -> Column:
    """Columns that are worked out once per row. As plain expressions the optimizer would copy the
    tokenizer into every filter and projection that uses its result."""
    return F.inline_outer(F.array(F.struct(*columns)))


def build_index(corpus: DataFrame, key: str, column: str) -> DataFrame:
    """Postings: one row per (term, document) with term frequency and document length."""
    return (
        tokenized(corpus, key, column)
        .select(key, "n_tokens", _terms())
        .where(F.col("term").isNotNull())
        .groupBy("term", key, "n_tokens")
        .agg(F.count("*").alias("tf"))
    )


def _terms() -> Column:
    """One row per token. The outer form keeps the optimizer from adding an emptiness test that would
    tokenise every text a second time."""
    return F.explode_outer("tokens").alias("term")


def index_documents(corpus: DataFrame, key: str, column: str) -> DataFrame:
    return tokenized(corpus, key, column).select(key, "n_tokens")


def write_index(
    corpus: DataFrame, key: str, column: str, path: str, buckets: int = 32, part: int = 0, attributes: list[str] | None = None, removed: str | None = None
) -> None:
    """Store one part of the index: postings by term bucket and in order of term, lengths and attributes by document.

    A query reads only its terms' buckets, and in them the row groups with its terms. Writing a part again replaces
    it. A document in a later part replaces the one with its key in earlier parts; where ``removed`` (a boolean column)
    holds, it takes it out. ``buckets`` is stored with the index by part 0 and counts from then on: choose it from the
    size of the postings. Rows are dealt by document, and a task writes its documents' postings without another shuffle.
    A part holds each key's document once, the highest row of those that repeat it, so one part is read as it is.
    """
    gone = F.coalesce(F.col(removed), F.lit(False)) if removed else F.lit(False)
    spark, texts = corpus.sparkSession, f"{path}/texts/part={part}"
    # the corpus is worked out once; by its size it is dealt by document, so that what follows stays in its task
    corpus.select(key, F.col(column).alias("_text"), gone.alias("removed"), *(attributes or [])).write.mode("overwrite").parquet(texts)
    rows = spark.read.parquet(texts)
    volume = rows.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    tasks, named = max(1, math.ceil(volume / TASK_BYTES)), F.col(key).isNotNull()
    # no reader takes postings without a key
    dealt = rows.where(named & ~F.col("removed")).select(key, "_text").repartition(tasks, key)
    postings = build_index(dealt, key, "_text").withColumn("bucket", _bucket(F.col("term"), buckets))
    segments.write_sorted(postings, f"{path}/postings/part={part}")
    told = F.when(~F.col("removed"), F.col("_text"))
    lengths = rows.select(key, "removed", *(attributes or []), _once(text.tokens(told).alias("tokens"))).withColumn("n_tokens", F.size("tokens"))
    lengths = lengths.drop("tokens").withColumn("part", F.lit(part))
    # rows without a key are one document; they are not gathered in one task
    documents = latest_changes(lengths.where(named).repartition(tasks, key), key, "part").union(latest_changes(lengths.where(~named), key, "part"))
    documents.drop("part").write.mode("overwrite").parquet(f"{path}/documents/part={part}")
    segments.delete(spark, texts)
    if part == 0:
        spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.mode("overwrite").parquet(f"{path}/layout")


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def read_index(spark, path: str, key: str, terms: list[str] | DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(postings, documents) of the newest version of each document; with a list of ``terms`` only their buckets are scanned.

    A table of ``terms``, one for each row, is that of a document or two: it goes to every task. Parts that have been
    merged (``segments.merge``) are read from their runs. Where one part holds all and nothing was removed, its postings
    and documents are current as they are.
    """
    postings, documents = segments.read_live(spark, path, key)
    if isinstance(terms, DataFrame):
        postings = postings.join(F.broadcast(terms.distinct()), "term", "left_semi")
    elif terms is not None:
        buckets = spark.read.parquet(f"{path}/layout").first().buckets
        wanted = [_bucket(F.lit(t), buckets) for t in terms]
        postings = postings.where(F.col("bucket").isin(wanted) & F.col("term").isin(terms))
    simple = segments.pieces(spark, path) == 1 and not documents.where("removed").limit(1).count()
    if simple:
        return postings.drop("bucket", "part").where(F.col(key).isNotNull()), documents.drop("removed", "part")
    documents = latest_changes(documents, key, "part").where("not removed").drop("removed")
    current = documents.select(key, "part")
    return postings.drop("bucket").join(current, [key, "part"]).drop("part"), documents.drop("part")


# -------------------------------------------------------------------------------- ranking


def _corpus_stats(documents: DataFrame) -> Column:
    return documents.agg(F.struct(F.count("*").alias("n"), F.avg("n_tokens").alias("avgdl"))).scalar()


def _part() -> Column:
    """One term's share of a score, from ``tf``, ``df``, ``n_tokens`` and the corpus statistics ``s``."""
    idf = F.log(1 + (F.col("s.n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = K1 * (1 - B + B * F.col("n_tokens") / F.col("s.avgdl"))
    return idf * F.col("tf") * (K1 + 1) / (F.col("tf") + norm)


def bm25(matched: DataFrame, documents: DataFrame, key: str, weights: dict[str, float] | None = None) -> DataFrame:
    """(key, score) from the postings of the query's terms.

    ``documents`` holds (key, n_tokens) of the whole corpus. Scores are rounded so that equal documents tie.
    """
    # one entry per query term; the query bounds its size
    frequencies = (
        matched.groupBy("term")
        .agg(F.count("*").alias("df"))
        .agg(F.map_from_entries(F.collect_list(F.struct("term", "df"))))
        .scalar()
    )
    scored = matched.withColumn("s", _corpus_stats(documents)).withColumn(
        "df", F.element_at(frequencies, F.col("term"))
    )
    part = _part()
    if weights:
        part = part * F.element_at(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]), F.col("term"))
    return scored.groupBy(key).agg(rules.round_half_up(F.sum(part), SCORE_DIGITS).alias("score"))


def scan_hits(corpus: DataFrame, key: str, column: str, terms: list[str]) -> DataFrame:
    """(key, n_tokens, hits) per document; ``hits`` keeps only the tokens that are query terms."""
    wanted = F.array(*[F.lit(t) for t in terms])
    hits = F.filter("tokens", lambda w: F.array_contains(wanted, w)).alias("hits")
    return tokenized(corpus, key, column).select(key, _once(F.col("n_tokens"), hits))


def scan_scores(corpus: DataFrame, key: str, column: str, weights: dict[str, float]) -> DataFrame:
    """BM25 of every matching document straight from the text.

    A document's term counts are found inside its own row, so nothing is shuffled: one pass gathers the
    corpus statistics (a single row), a second one scores.
    """
    terms = list(weights)
    hits = scan_hits(corpus, key, column, terms)
    stats = hits.agg(
        F.struct(
            F.count("*").alias("n"),
            F.avg("n_tokens").alias("avgdl"),
            *[F.count_if(F.array_contains("hits", t)).alias(f"df{i}") for i, t in enumerate(terms)],
        )
    ).scalar()
    scored = hits.withColumn("s", stats).where(F.size("hits") > 0)
    norm = K1 * (1 - B + B * F.col("n_tokens") / F.col("s.avgdl"))
    total = F.lit(0.0)
    for i, term in enumerate(terms):
        df = F.col(f"s.df{i}")
        tf = F.size("hits") - F.size(F.array_remove("hits", term))
        total = total + weights[term] * F.log(1 + (F.col("s.n") - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + norm)
    return scored.select(key, rules.round_half_up(total, SCORE_DIGITS).alias("score"))


def top(scores: DataFrame, key: str, limit: int) -> DataFrame:
    return scores.orderBy(F.desc("score"), key).limit(limit)


def search_scores(
    corpus: DataFrame, key: str, column: str, query: str, filters: Column | None = None, synonyms: bool = False
) -> DataFrame:
    """(key, score) of every document that contains a query term.

    ``filters`` restricts the results by attributes; the statistics stay those of the whole corpus.
    """
    weights = expand(query) if synonyms else {t: 1.0 for t in text.query_terms(query)}
    scores = scan_scores(corpus, key, column, weights)
    if filters is not None:
        scores = scores.join(corpus.where(filters).select(key), key, "left_semi")
    return scores


def search(
    corpus: DataFrame,
    key: str,
    column: str,
    query: str,
    limit: int = 10,
    filters: Column | None = None,
    synonyms: bool = False,
) -> DataFrame:
    """Best documents for a phrase."""
    return top(search_scores(corpus, key, column, query, filters, synonyms), key, limit)


def index_scores(
    spark, path: str, key: str, query: str, filters: Column | None = None, synonyms: bool = False
) -> DataFrame:
    """(key, score) of every document that contains a query term, from a stored index; no text is read.

    ``filters`` is a condition on the attributes stored with the index.
    """
    weights = expand(query) if synonyms else {t: 1.0 for t in text.query_terms(query)}
    postings, documents = read_index(spark, path, key, list(weights))
    scores = bm25(postings, documents, key, weights if synonyms else None)
    if filters is not None:
        scores = scores.join(documents.where(filters).select(key), key, "left_semi")
    return scores


def search_index(
    spark, path: str, key: str, query: str, limit: int = 10, filters: Column | None = None, synonyms: bool = False
) -> DataFrame:
    """The ranking of ``search`` from a stored index."""
    return top(index_scores(spark, path, key, query, filters, synonyms), key, limit)


def expand(query: str) -> dict[str, float]:
    """Query terms at full weight plus their synonyms at reduced weight."""
    weights = {t: 1.0 for t in text.query_terms(query)}
    for term in list(weights):
        for group_key, words in SYNONYMS.items():
            group = [group_key, *words]
            if term in group:
                for word in group:
                    weights.setdefault(word, SYNONYM_WEIGHT)
    return weights


def similar_documents(corpus: DataFrame, key: str, column: str, doc_key, limit: int = 10) -> DataFrame:
    """Documents most like a given one: its distinct terms form the query.

    ``limit`` is what "similar" means to a caller that goes on with the result. The terms and their frequencies
    are joined as rows; no list of terms is gathered in one task.
    """
    words = tokenized(corpus, key, column)
    terms = words.where(F.col(key) == F.lit(doc_key)).select(F.explode_outer(F.array_distinct("tokens")).alias("term"))
    matched = (
        words.select(key, "n_tokens", _terms())
        .join(terms, "term")
        .groupBy(key, "n_tokens", "term")
        .agg(F.count("*").alias("tf"))
    )
    frequencies = matched.groupBy("term").agg(F.count("*").alias("df"))
    scored = matched.join(frequencies, "term").withColumn("s", _corpus_stats(words))
    scores = scored.groupBy(key).agg(rules.round_half_up(F.sum(_part()), SCORE_DIGITS).alias("score"))
    return top(scores.where(F.col(key) != F.lit(doc_key)), key, limit)


def similar_in_index(spark, path: str, key: str, text_of: DataFrame, column: str, limit: int = 10) -> DataFrame:
    """``similar_documents`` from a stored index: ``text_of`` has the one document that others are compared with.

    Only that document is tokenised; the others come as postings of its terms.
    """
    own = tokenized(text_of, key, column)
    terms = own.select(F.explode_outer(F.array_distinct("tokens")).alias("term")).where("term is not null")
    # rows with one key are one document: a term of several of them counts once for each
    times = terms.groupBy("term").agg(F.count("*").alias("_times"))
    matched, documents = read_index(spark, path, key, terms)
    frequencies = matched.groupBy("term").agg(F.count("*").alias("df")).join(times, "term")
    scored = matched.join(F.broadcast(frequencies), "term").withColumn("df", F.col("df") * F.col("_times")).withColumn("s", _corpus_stats(documents))
    scores = scored.groupBy(key).agg(rules.round_half_up(F.sum(_part() * F.col("_times")), SCORE_DIGITS).alias("score"))
    return top(scores.join(own.select(key), key, "left_anti"), key, limit)


def vector_search(vectors: DataFrame, key: str, column: str, query_key, limit: int = 10) -> DataFrame:
    """Exact cosine top-k against the stored vector of ``query_key``: one pass, one heap per task."""
    probe = vectors.where(F.col(key) == F.lit(query_key)).agg(F.first(column)).scalar()

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)

    v = F.col(column)
    scored = vectors.select(key, v, probe.alias("_q")).withColumn(
        "score", dot(v, F.col("_q")) / F.nullif(F.sqrt(dot(v, v)) * F.sqrt(dot(F.col("_q"), F.col("_q"))), F.lit(0.0))
    )
    ranked = scored.where(F.col(key) != F.lit(query_key)).select(key, rules.round_half_up(F.col("score"), SCORE_DIGITS).alias("score"))
    return top(ranked, key, limit)


def hybrid_search(lexical: DataFrame, vector: DataFrame, key: str, limit: int = 10, depth: int = 100) -> DataFrame:
    """Reciprocal rank fusion of two score tables (key, score).

    ``depth`` is part of the ranking's definition: a list counts down to that rank, and a document below it scores
    as absent there. It also bounds what the two rank windows hold.
    """

    def ranks(df: DataFrame, name: str) -> DataFrame:
        return top(df, key, depth).select(key, F.row_number().over(Window.orderBy(F.desc("score"), key)).alias(name))

    def share(name: str) -> Column:
        return F.coalesce(1.0 / (RRF_K + F.col(name)), F.lit(0.0))

    fused = ranks(lexical, "lexical_rank").join(ranks(vector, "vector_rank"), key, "full")
    return top(fused.withColumn("score", rules.round_half_up(share("lexical_rank") + share("vector_rank"), 8)), key, limit)


def topic_counts(corpus: DataFrame, column: str, concepts: dict[str, list[str]] | None = None) -> DataFrame:
    """Documents per concept, all concepts in one pass. A document may show several."""
    concepts = concepts or CONCEPTS
    counts = corpus.agg(*[F.count_if(rules.ilike_any(F.col(column), p)).alias(c) for c, p in concepts.items()])
    rows = F.array(*[F.struct(F.lit(c).alias("topic"), F.col(c).alias("documents")) for c in concepts])
    return counts.select(F.inline(rows))


def hits_by(scores: DataFrame, corpus: DataFrame, key: str, dimension: str) -> DataFrame:
    """Feed search results into an aggregate: hits and open hits per attribute value."""
    return (
        corpus.join(scores.select(key), key, "left_semi")
        .groupBy(dimension)
        .agg(F.count("*").alias("hits"), F.count_if(F.col("request_status") == "OPEN").alias("open_hits"))
        .orderBy(F.desc("hits"))
    )
