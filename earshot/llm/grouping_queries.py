"""Queries of problem 2 over sample_records, speaker_map, speaker_links and split_targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from earshot.functions.speakers import speaker, split_name
from earshot.llm.grouping import assign_splits, crossing_groups, resolved_speaker, with_component
from earshot.llm.paths import clip_path, folder_speaker
from earshot.llm.sql_forms import folder_sql, id_sql, path_sql, split_sql
from earshot.plans.registry import Registry
from earshot.session import cut
from earshot.sources.tables import table

REGISTRY = Registry()

FOUND_SQL = f"""
WITH RECURSIVE r AS (SELECT row_id, {path_sql('path')} AS file, {id_sql('speaker_id')} AS known, {split_sql('split')} AS split FROM sample_records),
m AS (SELECT {path_sql('path')} AS file, min({id_sql('speaker_id')}) AS spk FROM speaker_map GROUP BY 1),
n AS (SELECT row_id, split, coalesce(known, {folder_sql('r.file')}, m.spk) AS spk FROM r LEFT JOIN m ON r.file = m.file),
e AS (SELECT speaker_a AS a, speaker_b AS b FROM speaker_links WHERE confirmed UNION SELECT speaker_b, speaker_a FROM speaker_links WHERE confirmed),
reach AS (SELECT a AS id, a AS other FROM e UNION SELECT reach.id, e.b FROM reach JOIN e ON reach.other = e.a),
c AS (SELECT id, min(other) AS comp FROM reach GROUP BY id),
g AS (SELECT row_id, split, coalesce(comp, spk) AS grp FROM n LEFT JOIN c ON n.spk = c.id)
SELECT row_id FROM g WHERE split IS NOT NULL AND grp IN (SELECT grp FROM g WHERE split IS NOT NULL AND grp IS NOT NULL GROUP BY grp HAVING count(DISTINCT split) > 1)"""


def _links(spark: SparkSession, folder: str) -> DataFrame:
    links = table(spark, folder, "speaker_links").where(F.col("confirmed"))
    return links.select(speaker(F.col("speaker_a")).alias("a"), speaker(F.col("speaker_b")).alias("b"))


def _grouped(spark: SparkSession, folder: str) -> DataFrame:
    """(row_id, split as given, group) of every row."""
    rows = table(spark, folder, "sample_records").select("row_id", split_name(F.col("split")).alias("split"), speaker(F.col("speaker_id")).alias("known"), F.when(speaker(F.col("speaker_id")).isNull(), clip_path(F.col("path"))).alias("file"))
    speaker_map = table(spark, folder, "speaker_map")
    named = resolved_speaker(rows, F.col("known"), folder_speaker(F.col("file")), F.col("file"), speaker_map, clip_path(F.col("path")), speaker(F.col("speaker_id")))
    return cut(with_component(named, "speaker", _links(spark, folder), "a", "b").select("row_id", "split", "group"), "grouped")


@REGISTRY.add("p2_found", FOUND_SQL)
def found(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of every speaker whose rows lie in more than one split as given."""
    rows = _grouped(spark, folder)
    crossing = crossing_groups(rows, "group", "split").withColumnRenamed("group", "crossing")
    # A row whose split names none of the three is in no case.
    return rows.where(F.col("split").isNotNull()).join(crossing, F.col("group") == F.col("crossing"), "left_semi").select("row_id")


@REGISTRY.add("p2_splits")
def splits(spark: SparkSession, folder: str) -> DataFrame:
    """A new split for every row."""
    return assign_splits(_grouped(spark, folder), table(spark, folder, "split_targets"), group="group", row_id="row_id").select("row_id", "group", F.col("split").alias("given"), "assigned")


_GROUPS_SQL = FOUND_SQL[: FOUND_SQL.rindex("SELECT row_id FROM g")]


@REGISTRY.add("p2_split_check", f"{_GROUPS_SQL} SELECT count(*) AS n_rows, count(DISTINCT grp) AS n_groups, 0::BIGINT AS n_parted, true AS near FROM g")
def check(spark: SparkSession, folder: str) -> DataFrame:
    """What the new splits must fulfil: all rows and groups are there, no group lies in two splits, and every share is within 0.1 points of its target."""
    new = cut(splits(spark, folder), "splits")
    parted = new.where(F.col("group").isNotNull()).groupBy("group").agg((F.min("assigned") != F.max("assigned")).alias("parted"))
    groups = parted.agg(F.count(F.lit(1)).alias("n_groups"), F.count_if("parted").alias("n_parted"))
    sizes = new.groupBy(F.col("assigned").alias("split")).agg(F.count(F.lit(1)).alias("n"))
    both = table(spark, folder, "split_targets").select("split", "share").join(sizes, "split", "full").select(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("share", F.lit(0.0)).alias("share"))
    total = both.agg(F.sum("n").alias("n_rows"), F.sum("share").alias("shares"))
    near = both.crossJoin(F.broadcast(total)).agg(F.max("n_rows").alias("n_rows"), F.bool_and(F.abs(F.col("n") / F.col("n_rows") - F.col("share") / F.col("shares")) <= 0.001).alias("near"))  # a row per split and one row
    return near.crossJoin(F.broadcast(groups)).select("n_rows", "n_groups", "n_parted", "near")  # one row each


@REGISTRY.add("p2_split_shares")
def shares(spark: SparkSession, folder: str) -> DataFrame:
    """What shares of rows the new splits reach."""
    sizes = splits(spark, folder).groupBy(F.col("assigned").alias("split")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("group").alias("n_groups"))
    total = table(spark, folder, "sample_records").count()
    targets = table(spark, folder, "split_targets").groupBy("split").agg(F.max("share").alias("target_share"))
    return targets.join(sizes, "split", "left").select("split", "target_share", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), F.coalesce("n_groups", F.lit(0)).alias("n_groups"), (F.coalesce("n_rows", F.lit(0)) / max(1, total)).alias("share"))
