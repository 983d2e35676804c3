"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and
returns a DataFrame; all but the last keep the columns of documents. A row is
known by its id and its text, so rows that repeat an id are judged each by
their own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelsmith.llm import decontaminate, importance, jaccard_join, mixing, secret_ledger
from panelsmith.llm.queries import BLOCK_CHARS, MIX_WEIGHTS, OTHER_PARTS
from panelsmith.session import cut_lineage, read_table

#: Rows (an id and a text key) up to which a list of removals may be broadcast.
BROADCAST_ROWS = 1_000_000


def _without(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` less the rows in ``removed`` (doc_id, text_key)."""
    gone = cut_lineage(removed.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct(), "removed")
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    same = (F.xxhash64(docs["text"]) == F.col("__key")) & docs["doc_id"].eqNullSafe(F.col("__id"))
    return docs.join(gone, same, "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that importance resampling does not select."""
    judged = importance.select_quality(docs, read_table(spark, sf_dir, "labels"))
    return _without(docs, judged.where(~F.col("kept")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8
    and more), keep the document with the smallest id."""
    groups = cut_lineage(jaccard_join.jaccard_components(docs, n=5, num=80, den=100), "groups")
    losers = groups.where(F.col("component_id") != F.col("doc_id")).select("doc_id", "text_key")
    # of rows with the smallest id in one group, the least text key stays
    again = groups.where((F.col("component_id") == F.col("doc_id")) & (F.col("n_shingles") > 0)).groupBy("doc_id", "component_key")
    again = cut_lineage(
        again.agg(F.count(F.lit(1)).alias("rows"), F.min("text_key").alias("first")).where("rows > 1"), "repeated-ids"
    )
    if again.isEmpty():
        return _without(docs, losers)
    others = groups.join(again, ["doc_id", "component_key"]).where(F.col("text_key") != F.col("first")).select("doc_id", "text_key")
    kept = _without(docs, losers.unionByName(others))
    twice = again.select(F.col("doc_id").alias("__id"), F.col("first").alias("__first"))
    same = (kept["doc_id"] == F.col("__id")) & (F.xxhash64(kept["text"]) == F.col("__first"))
    return kept.join(twice, same, "left_anti").unionByName(kept.join(twice, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold four fifths of a benchmark item's shingles; an
    item of fewer than five words is too common to drop a document for."""
    rows = docs.select(F.struct("doc_id", F.xxhash64("text").alias("text_key")).alias("row"), "text")
    found = decontaminate.contaminated(rows, read_table(spark, sf_dir, "benchmark"), id_col="row", least_words=5)
    return _without(docs, found.select("row.doc_id", "row.text_key"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; n_chars follows."""
    clean = secret_ledger.redact_versions(docs, secret_ledger.scan_unseen(docs))
    return clean.withColumn("n_chars", F.length("text").cast("bigint"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their slots in the mix of sources."""
    return mixing.mix_sources(docs, MIX_WEIGHTS, BLOCK_CHARS, other_weight=OTHER_PARTS, keep=("text", "lang", "n_chars"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("mix", mix),
]

#: SQL cannot state the classifier; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not mix:
            docs = cut_lineage(docs, f"stage-{name}")
    return docs
