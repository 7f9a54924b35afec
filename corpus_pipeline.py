"""A training corpus from ``documents``, in stages that each write and read Parquet.

Every stage but the last returns the columns that it was given. What a stage
rejects is gone for the next; the last gives the documents that the mix takes,
with their sizes, their source's size and target, and how often each is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapfeed.llm.common import cut, cut_counted, only_rows_of, table, without
from snapfeed.llm.decontam import judge_contamination
from snapfeed.llm.mixing import mixed_documents
from snapfeed.llm.neardup import near_duplicates
from snapfeed.llm.pii import replace_entities
from snapfeed.llm.quality import judge_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = judge_quality(docs, table(spark, sf_dir, "labels"))
    return without(docs, judged.where("not kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the least id, none after all others, and one row of it.

    Here the hash of id and text is the id, so that rows without an id and those
    that share one are linked like others.
    """
    own = F.xxhash64("doc_id", "text")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), own.alias("key"))
    ids = ids.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))
    linked = near_duplicates(docs.select(own.alias("doc_id"), "text")).select(F.col("doc_id").alias("key"), "component_id")
    both = cut(linked.distinct().join(ids, "key"), "copies")
    least = F.min(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "key")).alias("least")
    stay = cut(both.groupBy("component_id").agg(least).select("least.key"), "stay")
    gone = both.join(stay, "key", "left_anti").select("doc_id", "key")
    again, n = cut_counted(both.where("n > 1").join(stay, "key", "left_semi").select("doc_id", "key"), "again")
    once = without(docs, gone.unionAll(again))
    if not n:
        return once
    rows = only_rows_of(docs.withColumn("own_key", own), again.select(F.col("key").alias("own_key")), ["own_key"], n)
    one = rows.groupBy("own_key").agg(F.min(F.struct(*docs.columns)).alias("row"))
    return once.unionAll(one.select("row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    judged = judge_contamination(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, judged.where("not kept"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates in place of personal data; ``n_chars`` follows the text."""
    replaced = replace_entities(docs)
    if "n_chars" in docs.columns:
        replaced = replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return replaced.select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with their number of copies."""
    return mixed_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_dedup),
    ("decontamination", decontamination),
    ("personal data", pii),
    ("mixing", mixing),
]

#: Forests, drawn copies and surrogates are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), "pipeline")
    return docs
