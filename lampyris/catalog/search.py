"""Registered text and vector search (TXT family)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules, text
from ..operators import enrich, search, segments, vectors
from ..operators.changes import live_rows
from ..plans import operational as op
from ..session import shared_dir
from .base import query, rnd
from .operational import _keyword_sql

PHRASE = "flickering lamp electrical problem, danger near exposed wire"
DOC_PHRASE = "thing with nicht nouvelle thble attion"

_SPLIT = r"regexp_split_to_array(lower(coalesce({col}, '')), '[^\p{{L}}0-9]+')"


def _postings(source: str, key: str, col: str) -> str:
    words = _SPLIT.format(col=col)
    return f"""words as (select {key} as id, unnest(list_filter({words}, lambda w: w <> '')) as term from {source}),
    lens as (select {key} as id, len(list_filter({words}, lambda w: w <> '')) as n_tokens from {source}),
    post as (select term, id, count(*) as tf from words group by 1, 2),
    n as (select count(*) as n, avg(n_tokens) as avgdl from lens)"""


def _bm25(terms: str, weight: str = "1") -> str:
    return f"""scores as (select p.id, {rnd(f"sum({weight} * ln(1+(n.n-d.df+0.5)/(d.df+0.5)) * p.tf*2.2/(p.tf+1.2*(0.25+0.75*l.n_tokens/n.avgdl)))", 6)} as score
    from post p join (select term, count(*) as df from post group by 1) d on d.term = p.term join lens l on l.id = p.id cross join n
    where p.term in ({terms}) group by p.id)"""


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def search_sql(source: str, key: str, col: str, phrase: str, limit: int, where: str = "true") -> str:
    return f"""with {_postings(source, key, col)}, {_bm25(_quoted(text.query_terms(phrase)))}
    select id as {key}, score from scores where {where} order by score desc, id limit {limit}"""


query("keyword_search", _keyword_sql(["%storm%", "%collision%"], 60))(lambda t: op.keyword_search(t, ["%storm%", "%collision%"]))
query("search_text", "select request_id, search_description from searchable")(
    lambda t: enrich.maintenance_searchable(t).select("request_id", "search_description")
)
query(
    "build_index",
    f"""with {_postings('documents', 'doc_id', 'text')} select p.term, p.id as doc_id, l.n_tokens as n_tokens, p.tf
    from post p join lens l on l.id = p.id""",
)(lambda t: search.build_index(t.raw("documents"), "doc_id", "text").withColumn("n_tokens", F.col("n_tokens").cast("bigint")))
query("search_scan", search_sql("searchable", "request_id", "search_description", PHRASE, 10))(
    lambda t: search.search(enrich.maintenance_searchable(t), "request_id", "search_description", PHRASE, 10)
)


_STORED: dict[tuple, str] = {}
_ATTRIBUTES = ["issue_type", "request_status", "neighborhood_name"]


def _stored_index(t, name: str) -> str:
    """The index of one corpus of a data folder, written once for the files that lie there and queried from then on."""
    known = (t.spark.sparkContext.applicationId, t.path, name, segments.marks(t.spark, t.path))
    if known not in _STORED:
        path = shared_dir(t.spark, f"index-{name}")
        if name == "documents":
            search.write_index(t.raw("documents"), "doc_id", "text", path)
        else:
            search.write_index(enrich.maintenance_searchable(t), "request_id", "search_description", path, attributes=_ATTRIBUTES)
        _STORED[known] = path
    return _STORED[known]


query("search", search_sql("searchable", "request_id", "search_description", PHRASE, 10))(
    lambda t: search.search_index(t.spark, _stored_index(t, "requests"), "request_id", PHRASE, 10)
)
query("search_documents", search_sql("documents", "doc_id", "text", DOC_PHRASE, 20))(
    lambda t: search.search_index(t.spark, _stored_index(t, "documents"), "doc_id", DOC_PHRASE, 20)
)
query("search_index", search_sql("documents", "doc_id", "text", DOC_PHRASE, 20))(
    lambda t: search.search_index(t.spark, _stored_index(t, "documents"), "doc_id", DOC_PHRASE, 20)
)


query(
    "search_filtered",
    search_sql(
        "searchable", "request_id", "search_description", PHRASE, 10,
        "id in (select request_id from searchable where issue_type = 'wiring' and request_status = 'OPEN' and neighborhood_name = 'NATION_3')",
    ),
)(
    lambda t: search.search_index(
        t.spark, _stored_index(t, "requests"), "request_id", PHRASE, 10,
        filters=(F.col("issue_type") == "wiring") & (F.col("request_status") == "OPEN") & (F.col("neighborhood_name") == "NATION_3"),
    )
)

_SYN_PHRASE = "lamp flicker near fire"


def _synonym_sql() -> str:
    # full weight for the phrase's own words, half for every other word of their groups
    weights = "case when p.term in ('lamp', 'flicker', 'near', 'fire') then 1 else 0.5 end"
    terms = _quoted(
        ["lamp", "flicker", "near", "fire", "flickering", "flickers", "blinking", "blink", "intermittent", "unstable", "spark", "sparking", "burnt"]
    )
    return f"""with {_postings('searchable', 'request_id', 'search_description')}, {_bm25(terms, weights)}
    select id as request_id, score from scores order by score desc, id limit 25"""


query("synonym_search", _synonym_sql())(
    lambda t: search.search_index(t.spark, _stored_index(t, "requests"), "request_id", _SYN_PHRASE, 25, synonyms=True)
)


def _vector_sql(limit: int) -> str:
    return f"""select e.vec_id, {rnd("list_cosine_similarity(cast(e.embedding as double[]), cast(q.embedding as double[]))", 6)} as score
    from embeddings e cross join (select embedding from embeddings where vec_id = 0) q where e.vec_id <> 0
    order by score desc, e.vec_id limit {limit}"""


query("vector_search", _vector_sql(10))(lambda t: search.vector_search(t.raw("embeddings"), "vec_id", "embedding", 0, 10))


def _stored_vectors(t) -> str:
    known = (t.spark.sparkContext.applicationId, t.path, "vectors", segments.marks(t.spark, t.path))
    if known not in _STORED:
        path = shared_dir(t.spark, "index-vectors")
        vectors.write_vector_index(t.raw("embeddings"), "vec_id", "embedding", path)
        _STORED[known] = path
    return _STORED[known]


query("vector_index_search", _vector_sql(10))(
    lambda t: vectors.search_vectors(t.spark, _stored_vectors(t), "vec_id", 0, 10, probes=None)
)


@query("vector_index_recall", "select count(*) * 10 as neighbours, true as enough from embeddings where vec_id % 20 = 0")
def vector_index_recall(t):
    """Share of the true ten nearest that the probed cells have, over many queries; ``enough`` from 0.95 on."""
    path = _stored_vectors(t)
    wanted = t.raw("embeddings").where("vec_id % 20 = 0").select(F.col("vec_id").alias("q"), "embedding")
    near = lambda probes: vectors.nearest_in_index(t.spark, path, "vec_id", wanted, "q", "embedding", 10, probes).select("q", "vec_id")
    both = near(None).withColumn("true", F.lit(1)).join(near(0).withColumn("found", F.lit(1)), ["q", "vec_id"], "left")
    return both.agg(F.count("*").alias("neighbours"), (F.sum(F.coalesce("found", F.lit(0))) >= 0.95 * F.count("*")).alias("enough"))


def _similar_sql(source: str, key: str, col: str, doc: str, limit: int) -> str:
    return f"""with {_postings(source, key, col)}, {_bm25(f"select term from post where id = {doc}")}
    select id as {key}, score from scores where id <> {doc} order by score desc, id limit {limit}"""


def _similar_requests(t, request_id: int, limit: int):
    one = enrich.maintenance_searchable(t).where(F.col("request_id") == request_id)
    return search.similar_in_index(t.spark, _stored_index(t, "requests"), "request_id", one, "search_description", limit)


query("similar_requests", _similar_sql("searchable", "request_id", "search_description", "8", 10))(lambda t: _similar_requests(t, 8, 10))
query("similar_documents", _similar_sql("documents", "doc_id", "text", "4", 10))(
    lambda t: search.similar_in_index(t.spark, _stored_index(t, "documents"), "doc_id", t.raw("documents").where("doc_id = 4"), "text", 10)
)


@query("search_merged", search_sql("documents", "doc_id", "text", DOC_PHRASE, 20))
def search_merged(t):
    """An index that came in seven parts, some documents several times, merged three at a time."""
    path, docs = shared_dir(t.spark, "index-parts"), t.raw("documents").select("doc_id", "text")
    for part in range(7):
        own = docs.where(F.col("doc_id") % 7 == part).withColumn("gone", F.lit(False))
        early = docs.where((F.col("doc_id") % 7 > part) & (F.col("doc_id") % 5 == 0)).withColumn("text", F.lit("thing thing early")).withColumn("gone", F.lit(part % 2 == 1))
        search.write_index(own.union(early), "doc_id", "text", path, buckets=4, part=part, removed="gone")
        segments.merge(t.spark, path, "doc_id", below=part, fanout=3)
    return search.search_index(t.spark, path, "doc_id", DOC_PHRASE, 20)

_HYBRID_DEPTH = 100


@query(
    "hybrid_search",
    f"""with lex as (select doc_id as id, row_number() over (order by score desc, doc_id) as r
      from ({search_sql('documents', 'doc_id', 'text', DOC_PHRASE, _HYBRID_DEPTH)})),
    vec as (select vec_id as id, row_number() over (order by score desc, vec_id) as r from ({_vector_sql(_HYBRID_DEPTH)}))
    select coalesce(a.id, b.id) as doc_id, cast(a.r as int) as lexical_rank, cast(b.r as int) as vector_rank,
    {rnd("coalesce(1.0/(60+a.r), 0) + coalesce(1.0/(60+b.r), 0)", 8)} as score
    from lex a full join vec b on a.id = b.id order by score desc, doc_id limit 10""",
)
def hybrid_search(t):
    lexical = search.index_scores(t.spark, _stored_index(t, "documents"), "doc_id", DOC_PHRASE)
    vector = search.vector_search(t.raw("embeddings"), "vec_id", "embedding", 0, _HYBRID_DEPTH)
    return search.hybrid_search(lexical, vector.withColumnRenamed("vec_id", "doc_id"), "doc_id", 10, _HYBRID_DEPTH)


query(
    "topic_counts",
    " union all ".join(
        f"select '{c}' as topic, count(*) filter (where " + " or ".join(f"description ilike '{p}'" for p in ps) + ") as documents from requests"
        for c, ps in search.CONCEPTS.items()
    ),
)(lambda t: search.topic_counts(t.requests, "description"))


@query(
    "search_then_aggregate",
    f"""with {_postings('searchable', 'request_id', 'search_description')}, {_bm25("'flicker', 'danger', 'spark'")}
    select neighborhood_name, count(*) as hits, count(*) filter (where request_status = 'OPEN') as open_hits
    from searchable where request_id in (select id from scores) group by 1""",
)
def search_then_aggregate(t):
    path = _stored_index(t, "requests")
    scores = search.index_scores(t.spark, path, "request_id", "flicker danger spark")
    _, documents = search.read_index(t.spark, path, "request_id")
    return search.hits_by(scores, documents, "request_id", "neighborhood_name")


@query(
    "similar_issue_fix_time",
    f"""with {_postings('searchable', 'request_id', 'search_description')}, {_bm25("select term from post where id = 8")},
    best as (select id from scores where id <> 8 order by score desc, id limit 50)
    select count(*) as similar_requests, {rnd("avg(epoch(r.resolved_at - r.reported_at)/3600.0)", 2)} as avg_hours
    from requests r join best b on b.id = r.request_id where not r._deleted and r.resolved_at is not null""",
)
def similar_issue_fix_time(t, request_id: int = 8, limit: int = 50):
    """Mean repair time of the requests most like a given one."""
    near = _similar_requests(t, request_id, limit)
    done = live_rows(t.requests).where(F.col("resolved_at").isNotNull())
    hours = rules.elapsed_hours(F.col("reported_at"), F.col("resolved_at"))
    return done.join(near.select("request_id"), "request_id", "left_semi").agg(
        F.count("*").alias("similar_requests"), rules.round_half_up(F.avg(hours), 2).alias("avg_hours")
    )
