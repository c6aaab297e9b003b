"""Cleaning and packing of the documents table, stage by stage.

Every stage takes all rows that its predecessor kept, and all but the last return the columns of documents. Rows without
a doc_id leave in the first stage; of rows that repeat a doc_id one stays in the second.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lampyris.llm import jaccard, packing, quality, secrets, substrings
from lampyris.llm.registry import QUERIES, table
from lampyris.llm.storage import broadcast_up_to, shared_folder, stored

SMALL_ROWS = 400_000  # an id list of up to so many rows is broadcast; beyond it both sides are shuffled


def _without(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``key`` is not in the one column of ``gone``."""
    gone = broadcast_up_to(stored(gone.toDF("_gone"), "gone"), SMALL_ROWS)
    return docs.join(gone, F.col(key) == F.col("_gone"), "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that fail the fixed limits or are outliers of their language and source go."""
    rows = docs.where("doc_id is not null").withColumn("_row", F.xxhash64("doc_id", "text", "lang", "source"))
    rejected = quality.judged(rows, id_col="_row").where("not kept").select("doc_id").distinct()
    return _without(rows, "_row", rejected).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    found = jaccard.near_duplicates(docs)
    rest = _without(docs, "doc_id", found.where("component_id <> doc_id").select("doc_id"))
    again = stored(docs.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_again")), "again")
    if again.limit(1).count() == 0:
        return rest
    one = rest.join(again, F.col("doc_id") == F.col("_again"), "left_semi").groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("r"))
    return _without(rest, "doc_id", again).union(one.select("r.*"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in runs of 50 that an earlier document has go; a text that loses none stays as it is, an emptied one goes."""
    spans = stored(substrings.repeated_spans(docs), "spans")
    found = substrings.apply_spans(docs, spans).where("_n_removed = 0 or _kept <> ''")
    text = F.when(F.col("_n_removed") == 0, F.col("text")).otherwise(F.col("_kept"))
    return found.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts give way to a mark."""
    found = secrets.scan(docs, shared_folder(spark, "ledger"), path_col="doc_id")
    some = broadcast_up_to(stored(found.where("size(findings) > 0").select("path", "findings"), "findings"), SMALL_ROWS // 4)
    return secrets.redact(docs, some).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.pack(docs, with_ids=False).drop("ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can't express the outlier estimate, the component search or the packing; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


QUERIES["pipeline"] = run
