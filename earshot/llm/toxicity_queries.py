"""Queries of problem 7 over documents and doc_labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from earshot.functions.text import plain
from earshot.llm.toxicity import score_documents
from earshot.llm.toxicity_fit import fit
from earshot.plans.registry import Registry
from earshot.sources.tables import table

REGISTRY = Registry()


def _scored(spark: SparkSession, folder: str, keep: list[str], spans: bool) -> DataFrame:
    documents = table(spark, folder, "documents").select("text", *keep)
    model = fit(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "doc_labels"))
    return score_documents(documents, model, text="text", keep=keep, spans=spans)


@REGISTRY.add("p7_found")
def found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with at least one abusive, hateful or sexually explicit utterance."""
    return _scored(spark, folder, ["doc_id"], False).where("toxic").select("doc_id")


@REGISTRY.add("p7_scores")
def scores(spark: SparkSession, folder: str) -> DataFrame:
    """Score, verdict and offending spans of every document."""
    return _scored(spark, folder, ["doc_id", "source"], True).withColumn("score", F.round("score", 6))


@REGISTRY.add("p7_rates")
def rates(spark: SparkSession, folder: str) -> DataFrame:
    """Documents, toxic ones and their rate by source, spelling aside; documents without a source count under null."""
    name = F.nullif(F.regexp_replace(F.trim(F.regexp_replace(plain(F.col("source")), r"[\s_-]+", " ")), " ", "-"), F.lit(""))
    scored = _scored(spark, folder, ["doc_id", "source"], False).groupBy(name.alias("source")).agg(F.count(F.lit(1)).alias("n_docs"), F.count_if("toxic").alias("n_toxic"), F.round(F.avg("score"), 6).alias("mean_score"))
    return scored.withColumn("rate", F.col("n_toxic") / F.col("n_docs"))
