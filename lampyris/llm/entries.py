"""One query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, collocations, jaccard, licences, mixture, packing, quality, secrets, substrings, trie, variants, vptree, warc
from .registry import query, table
from .storage import shared_folder


@query("op1_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"), with_links=True)


@query("op6_substring_dedup")
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeats(table(spark, folder, "documents")).drop("kept")


@query("op9_bpe_trie_round_trip")
def bpe_trie_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return trie.round_trip_digests(table(spark, folder, "documents"))


@query("op7_best_two_fit_packing")
def best_two_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), with_ids=False).drop("ids")


@query("op11_mixture_packing")
def mixture_packing(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.pack(table(spark, folder, "documents"), with_ids=False).drop("ids")


# crc32 byte by byte: a table of 256 remainders made from the polynomial, and a letter of the run is one byte or two
VARIANTS_SQL = r"""
with recursive t as (
  select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end, i)) as t
), r as (
  select coalesce(cast(doc_id as varchar), '') || ':' as d, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) as w from documents
), c as (select d, w, count(*) as n from r where length(w) >= 6 group by d, w),
b as (
  select d, w, n, list_transform(string_split(d, ''), lambda x: unicode(x)) || flatten(list_transform(string_split(w, ''),
    lambda x: case when unicode(x) < 128 then [unicode(x)] else [195, unicode(x) - 64] end)) as bytes from c
), h as (
  select w, n, xor(list_reduce(bytes, lambda s, x: xor(s // 256, t[cast(xor(s, x) % 256 as bigint) + 1]), 4294967295), 4294967295) as h
  from (select w, n, list_transform(bytes, lambda x: cast(x as bigint)) as bytes, t from b, t)
), v as (
  select case when h % 199 = 0 then substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) else w end as word, n from h
), k as (select word, cast(sum(n) as bigint) as n from v where length(word) >= 6 group by word having sum(n) >= 5),
x as (
  select word, n, -1 as i, word as cut from k
  union all select word, n, i, substr(word, 1, i) || substr(word, i + 2) from (select word, n, unnest(range(length(word))) as i from k)
), p as (
  select distinct a.word, a.n, b.word as near, b.n as near_n from x a join x b on a.cut = b.cut and a.word <> b.word
  where a.i = b.i or a.i = -1 or b.i = -1
), f as (
  select word, count(*) as n_near, first(near order by near_n desc, near) as near, max(near_n) as near_n from p group by word
), g as (
  select k.word, k.n, coalesce(n_near, 0) as n_near, case when near_n >= 5 * k.n then near end as form,
    case when near_n >= 5 * k.n then near_n end as form_n from k left join f on f.word = k.word
), o as (
  select word, word as root, form as next from g
  union all select o.word, g.word, g.form from o join g on g.word = o.next
)
select g.*, o.root from g join o on o.word = g.word and o.next is null
"""


@query("op12_spelling_variants", VARIANTS_SQL)
def spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.groups(table(spark, folder, "documents"))


PHRASES_SQL = r"""
with p as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as p from documents
), w as (select lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') as w from p),
g as (select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase from w, range(1, 5) as t(k)),
f as (select lang, cast(k as integer) as k, phrase, count(*) as f from g group by all),
c as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from f where k >= 2 and f >= 30),
u as (
  select lang, phrase, max(a) as over from (
    select lang, a, array_to_string(w[i:i + m - 1], ' ') as phrase
    from (select *, unnest(range(1, k - m + 2)) as i from (select *, unnest(range(2, k)) as m from c))) group by all
), s as (
  select c.lang, c.phrase, a, l.f as l, r.f as r, i, cast(2000000 * cast(a as hugeint) // (l.f + r.f) as bigint) as score
  from (select *, unnest(range(1, k)) as i from c) c
  join f l on l.lang = c.lang and l.phrase = array_to_string(w[1:i], ' ')
  join f r on r.lang = c.lang and r.phrase = array_to_string(w[i + 1:], ' ')
), b as (select * from (select *, row_number() over (partition by lang, phrase order by score, i) as o from s) where o = 1),
n as (select lang, cast(sum(f) as bigint) as n from f where k = 1 group by lang)
select * from (
  select b.lang, cast(row_number() over (partition by b.lang order by score desc, a desc, b.phrase) as integer) as rank, b.phrase, a, l, r, n, score
  from b join n on n.lang = b.lang left join u on u.lang = b.lang and u.phrase = b.phrase
  where over is null or 100 * cast(over as hugeint) < 80 * cast(a as hugeint)) where rank <= 2000
"""


@query("op13_phrase_collocations", PHRASES_SQL)
def phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(table(spark, folder, "documents"))


WARC_SQL = """
with p as (
  select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest
  from (select distinct page_id, html from pages)
), h as (select *, case when payload_bytes >= 1000 then max(page_id) over (partition by payload_digest) else page_id end as head from p)
select page_id, payload_bytes, payload_digest, case when page_id = head then 'response' else 'revisit' end as record_type,
  case when page_id <> head then head end as refers_to
from h
"""


@query("op8_warc_transactions", WARC_SQL)
def warc_transactions(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.round_trip(table(spark, folder, "pages"), with_payload=False)
    return found.select(
        "page_id",
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.digest").alias("payload_digest"),
        F.col("response.kind").alias("record_type"),
        F.col("refers_to_page").alias("refers_to"),
    )


def _total(a: str, b: str) -> str:
    return f"list_reduce(list_transform(list_zip({a}, {b}), lambda z: z[1] * z[2]), lambda s, z: s + z)"


NEAREST_SQL = f"""
with v as (
  select vec_id, cast(embedding as double[]) as e from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), n as (select vec_id, e, sqrt({_total("e", "e")}) as norm from v),
s as (
  select q.vec_id as query_id, c.vec_id, {_total("q.e", "c.e")} / (q.norm * c.norm) as score
  from n q join n c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0
)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 5
"""


@query("op5_vantage_point_search", NEAREST_SQL)
def vantage_point_search(spark: SparkSession, folder: str) -> DataFrame:
    return vptree.nearest(table(spark, folder, "embeddings"), "id % 50 = 0", k=5, factor=1.0)


def _canonical_sql(text: str) -> str:
    c = rf"lower(regexp_replace(replace(coalesce({text}, ''), '©', '(c)'), '[^\x00-\x7F]+', ' ', 'g'))"
    c = rf"regexp_replace({c}, '(^|\n)[^a-z0-9\n(]*(copyright[ \t]*(\(c\)|:|[0-9]{{4}}|<year>|\[year\])|\(c\)[ \t]*[0-9<\[])[^\n]*', '\1', 'g')"
    c = rf"regexp_replace({c}, '(^|\n)[^a-z0-9\n]*all rights reserved[^a-z0-9\n]*(\n|$)', chr(10), 'g')"
    c = f"regexp_replace({c}, '[^a-z0-9]+', ' ', 'g')"
    for old, new in licences.SPELLINGS:
        c = f"replace({c}, '{old}', '{new}')"
    return f"trim({c})"


_KNOWN_VALUES = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in licences.KNOWN)
LICENCE_SQL = f"""
with k as (
  select sha256(c) as known, min(licence_id) as licence_id
  from (select licence_id, {_canonical_sql("t")} as c from (values {_KNOWN_VALUES}) as v(licence_id, t)) where c <> '' group by c
), d as (select doc_id, text, sha256({_canonical_sql("text")}) as canonical_sha256 from documents),
l as (select doc_id, {_canonical_sql("line")} as c from (select doc_id, unnest(string_split(text, chr(10))) as line from documents)),
n as (select doc_id, count(*) as n_notices, string_agg(distinct licence_id, ',' order by licence_id) as notices
  from l join k on sha256(l.c) = k.known where l.c <> '' group by doc_id)
select d.doc_id, d.canonical_sha256, k.licence_id, coalesce(n.n_notices, 0) as n_notices, coalesce(n.notices, '') as notices
from d left join k on k.known = d.canonical_sha256 left join n on n.doc_id = d.doc_id
"""


@query("op10_licence_digests", LICENCE_SQL)
def licence_digests(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents"), licences.known_texts(spark))


_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _spans_sql(kind: str, number: int, pattern: str, group: int, least: int) -> str:
    ends = "list_sum(list_transform(gap[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x)))"
    return f"""select doc_id, {number} as number, '{kind}' as kind, e - length(m[i]) as s, e from (
      select doc_id, m, v, i, cast({ends} as bigint) as e from (
        select *, unnest(range(1, len(m) + 1)) as i from (
          select doc_id, string_split_regex(text, '{pattern}') as gap, regexp_extract_all(text, '{pattern}') as m,
            regexp_extract_all(text, '{pattern}', {group}) as v
          from documents where regexp_matches(text, '{pattern}')))) where length(v[i]) >= {least}"""


SECRETS_SQL = f"""
with f as ({_spans_sql("assign", 0, _ASSIGN, 2, 12)} union all {_spans_sql("access", 1, "AKIA[A-Z0-9]+", 0, 18)}
  union all {_spans_sql("hex", 2, "[0-9a-f]+", 0, 16)}),
g as (select doc_id, count(*) filter (number = 0) as n_assign, count(*) filter (number = 1) as n_access,
  count(*) filter (number = 2) as n_hex, string_agg(kind || ':' || s || ':' || e, ',' order by s, number) as spans from f group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from documents d left join g on g.doc_id = d.doc_id
"""


@query("op4_secret_blob_ledger", SECRETS_SQL)
def secret_blob_ledger(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents"), shared_folder(spark, "ledger"), path_col="doc_id")
    count = lambda i: F.size(F.filter("findings", lambda f: f["number"] == i)).cast("long")
    spans = secrets.span_text(F.col("findings"))
    return found.select(
        F.col("path").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(spans, 256).alias("base_sha256"),
        spans.alias("spans"),
    )


_ESCAPED = "{}"
for _plain, _code in chat.ESCAPES:
    _old = _plain.replace("\n", "' || chr(10) || '")
    _ESCAPED = f"replace({_ESCAPED}, '{_old}', '{_code}')"

CHAT_SQL = f"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as raw from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), r as (
  select *, '<|' || replace({_ESCAPED.format("role")}, chr(10), '\\m') || '|>' || chr(10) || {_ESCAPED.format("raw")} || '<|end|>' || chr(10) as line,
    row_number() over (partition by conv_id order by turn nulls first, role, raw) as i from t
), k as (
  select *, cast(ceil(strlen(line) / 4.0) as bigint) as tokens, i = 1 and role = 'system' as system from r
), s as (
  select *, sum(case when system then tokens else 0 end) over (partition by conv_id) as system_tokens,
    sum(case when system then 0 else tokens end) over (partition by conv_id order by i) as until from k
), p as (
  select *, until - case when system then 0 else tokens end as since,
    greatest(1, floor((512 - 96 - system_tokens) / 2.0)) as stride from s
), n as (select *, floor(since / stride) as w from p where not system),
g as (select conv_id, w, min(since) as first, min(i) as start, sum(length(line)) as chars,
  least(96, 512 - min(system_tokens) - sum(tokens)) as room from n group by conv_id, w),
h as (select g.conv_id, g.w, sum(length(n.line)) as chars from g join n on n.conv_id = g.conv_id and n.i < g.start and n.since >= g.first - g.room group by 1, 2),
f as (
  select g.conv_id, sum(g.chars + coalesce(h.chars, 0) + coalesce(y.chars, 0)) as chars from g
  left join h on h.conv_id = g.conv_id and h.w = g.w
  left join (select conv_id, length(line) as chars from p where system) y on y.conv_id = g.conv_id group by g.conv_id
  union all select conv_id, length(line) from p where system and conv_id not in (select conv_id from n)
)
select k.conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || raw || chr(10), '' order by i)) as turns_sha256,
  cast(coalesce(sum(length(raw)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(raw, '' order by i) filter (role = 'assistant'), '')) as loss_sha256,
  cast(min(f.chars) as bigint) as formatted_chars
from k join f on f.conv_id = k.conv_id group by k.conv_id
"""


@query("op3_budgeted_chat_windows", CHAT_SQL)
def budgeted_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    found = chat.read_back(chat.windows(rows.union(extra)))
    return found.select(
        "conv_id",
        "n_turns",
        F.sha2("turns", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query("op2_robust_outlier_rules")
def robust_outlier_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.judged(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("d2", 6).alias("distance2")
    )
