"""Queries of problem 6 over documents and mix_targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from earshot.llm.mixing import mix
from earshot.plans.registry import Registry
from earshot.sources.tables import table

REGISTRY = Registry()


def _mix(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return mix(table(spark, folder, "documents").select("doc_id", "source", "text"), table(spark, folder, "mix_targets"))


@REGISTRY.add("p6_mix")
def documents(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of the mix and how often each is used."""
    return _mix(spark, folder)[0]


@REGISTRY.add("p6_shares")
def shares(spark: SparkSession, folder: str) -> DataFrame:
    """The shares reached."""
    return _mix(spark, folder)[1]
