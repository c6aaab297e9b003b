"""Secret scans over every version of a set of paths, with a ledger of what has been scanned.

Texts are content-addressed (SHA-256): a blob that many paths or versions share is scanned once. The ledger holds one
row for each scanned pair of blob and rule version with the spans found. A run scans only the pairs that the ledger
lacks, appends them, and joins the ledger back to all paths. Raising a rule's version scans every blob for that rule
again and leaves the others alone. Everything here is DataFrame expressions.

Spans are whole matches, leftmost and not overlapping within a kind, in code points [start, end). A match whose value is
too short is dropped after matching, so it still takes its text.

Defined results: a null text is the empty blob. Rows that repeat or lack a path are rows like any other and get their
blob's findings. Other columns are ignored. An empty table gives an empty result. A run that fails half-way leaves the
ledger as it was, or with whole rows that the next run takes as scanned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import stored


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    group: int  # whose length counts
    least: int


# Fixed values. For access and hex the least length is in the pattern: a run that is too short matches nothing in either form.
RULES = [
    Rule("assign", 1, r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", 1, "AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", 1, "[0-9a-f]{16,}", 0, 16),
]

LEDGER = "blob string, kind string, version int, spans array<struct<start: long, end: long>>"
_SPANS = "array<struct<start: long, end: long>>"


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def read_ledger(spark, folder: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER).parquet(f"{folder}/*")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def matches(texts: DataFrame, rule: Rule) -> DataFrame:
    """(blob, kind, start, end) of one rule in rows (blob, text) of different blobs."""
    pattern = F.lit(rule.pattern)
    hit = texts.where(F.rlike("text", pattern))
    parts = hit.select(
        "blob",
        F.split("text", rule.pattern, -1).alias("between"),
        F.regexp_extract_all("text", pattern, F.lit(0)).alias("match"),
        F.regexp_extract_all("text", pattern, F.lit(rule.group)).alias("value"),
    )
    # what lies before, between and behind the matches has one part more than there are matches
    rows = parts.select("blob", F.posexplode(F.arrays_zip(F.expr("slice(between, 1, size(match))").alias("gap"), F.col("match").alias("match"), F.col("value").alias("value"))).alias("at", "m"))
    rows = rows.select("blob", "at", F.length("m.gap").alias("gap"), F.length("m.match").alias("n"), F.length("m.value").alias("value"))
    so_far = F.sum(F.col("gap") + F.col("n")).over(Window.partitionBy("blob").orderBy("at"))
    rows = rows.withColumn("end", so_far.cast("long"))
    return rows.where(F.col("value") >= rule.least).select("blob", F.lit(rule.kind).alias("kind"), (F.col("end") - F.col("n")).alias("start"), "end")


def scan(versions: DataFrame, ledger: str, path_col: str = "path", text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """(path, blob, findings) of every row; findings are (start, kind number, end) structs in order.

    ``ledger`` is a folder that all executors share; it need not exist yet. Reading and scanning end before this returns.
    """
    spark = versions.sparkSession
    rows = versions.select(F.col(path_col).alias("path"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("blob", blob_of(F.col("text")))
    seen = read_ledger(spark, ledger)
    pairs = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    places = stored(rows.select("path", "blob"), "places")
    blobs = places.groupBy("blob").agg(F.min("path").alias("first"))
    unseen = blobs.select("blob", "first", F.explode(pairs).alias("p")).select("blob", "first", "p.*")
    unseen = stored(unseen.join(seen.select("blob", "kind", "version").distinct(), ["blob", "kind", "version"], "left_anti"), "unseen")
    due = unseen.groupBy("blob").agg(F.min("first").alias("first"), F.array_sort(F.collect_set("kind")).alias("kinds"))
    due = due.select(F.col("blob").alias("due"), "first", "kinds")
    # one row has the text of each blob that is due; the smallest path may hold several versions or rows of it
    texts = rows.join(due, (F.col("blob") == F.col("due")) & F.col("path").eqNullSafe(F.col("first"))).select("blob", "text", "kinds")
    texts = texts.where(F.rlike("text", F.lit("|".join(f"(?:{r.pattern})" for r in rules)))).dropDuplicates(["blob"])
    texts = stored(texts, "texts")
    found = None
    for rule in rules:
        part = matches(texts.where(F.array_contains("kinds", rule.kind)).select("blob", "text"), rule)
        found = part if found is None else found.union(part)
    found = found.groupBy("blob", "kind").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    fresh = unseen.drop("first").join(found, ["blob", "kind"], "left")
    fresh = fresh.select("blob", "kind", "version", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"))
    fresh.write.mode("append").parquet(f"{ledger}/scans")

    number = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    known = read_ledger(spark, ledger).join(
        F.broadcast(spark.createDataFrame([(r.kind, r.version) for r in rules], "kind string, version int")), ["kind", "version"]
    ).where("size(spans) > 0").distinct()
    each = known.select("blob", number[F.col("kind")].alias("number"), F.explode("spans").alias("s"))
    each = each.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("s.start", "number", "s.end"))).alias("findings"))
    none = F.array().cast("array<struct<start: long, number: int, end: long>>")
    return places.join(each, "blob", "left").select("path", "blob", F.coalesce("findings", none).alias("findings"))


def span_text(findings: Column, rules: list[Rule] = RULES) -> Column:
    """kind:start:end of all findings, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(findings, lambda f: F.concat_ws(":", F.get(kinds, f["number"]), f["start"], f["end"])), ",")


def redact(docs: DataFrame, findings: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of ``findings`` (path, findings) replaced by ``mark``; overlapping spans get one mark."""
    some = findings.where("size(findings) > 0").select(F.col("path").alias("_path"), F.col("findings").alias("_findings")).dropDuplicates(["_path"])
    rows = docs.join(some, F.col(id_col).eqNullSafe(F.col("_path")), "left")
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    text = F.col(text_col)

    def step(acc: Column, f: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(f["start"] - acc["at"], F.lit(0)).cast("int"))
        more = F.when(f["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"])
        return F.struct(more.alias("out"), F.greatest(acc["at"], f["end"]).alias("at"))

    def rest(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))

    clean = F.when(F.col("_findings").isNull(), text).otherwise(F.aggregate("_findings", state, step, rest))
    return rows.withColumn(text_col, clean).drop("_path", "_findings")
