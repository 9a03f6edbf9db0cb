"""Queries of problem 5 over documents and eval_items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from earshot.llm.leaks import leaked_passages
from earshot.plans.registry import Registry
from earshot.sources.tables import table

REGISTRY = Registry()


def _leaks(spark: SparkSession, folder: str) -> DataFrame:
    return leaked_passages(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "eval_items").select("item_id", "text"))


@REGISTRY.add("p5_found")
def found(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that holds a passage of an evaluation text, and the text's item."""
    return _leaks(spark, folder).select("doc_id", "item_id")


@REGISTRY.add("p5_passages")
def spans(spark: SparkSession, folder: str) -> DataFrame:
    """The passages with their length in words and their offsets in the original text."""
    return _leaks(spark, folder)


@REGISTRY.add("p5_leaked_items")
def by_item(spark: SparkSession, folder: str) -> DataFrame:
    """Every evaluation item with the number of documents that it leaked into and the longest passage."""
    leaked = _leaks(spark, folder).groupBy(F.col("item_id").alias("leaked")).agg(F.count_distinct("doc_id").alias("n_docs"), F.max("n_words").alias("longest"))
    items = table(spark, folder, "eval_items").select("item_id", "suite")
    return items.join(leaked, F.col("item_id") == F.col("leaked"), "left").select("item_id", "suite", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("longest", F.lit(0)).alias("longest"))
