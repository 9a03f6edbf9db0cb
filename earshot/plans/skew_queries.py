"""Problem 4: per-speaker results although a handful of speakers hold about half of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from earshot.functions.speakers import speaker
from earshot.operators.skew import Agg, keys_above, salted_aggregate
from earshot.plans.registry import Registry
from earshot.sources.tables import table

REGISTRY = Registry()

FULL_WIDTH = "０１２３４５６７８９"
#: The plain form of a speaker id in DuckDB.
SPEAKER_SQL = f"""
  SELECT *, CASE WHEN d <> '' THEN 'spk_' || lpad(CASE WHEN ltrim(d, '0') = '' THEN '0' ELSE ltrim(d, '0') END, 9, '0') END AS spk FROM (
    SELECT *, replace(regexp_extract(s, '^\\s*(?:spk|speaker)?[\\s_.:#-]*([0-9o]*[0-9][0-9o]*)(?:\\.0+)?\\s*$', 1), 'o', '0') AS d FROM (
      SELECT *, lower(translate(speaker_id, '{FULL_WIDTH} ', '0123456789 ')) AS s FROM sample_records))"""

FOUND_SQL = f"""
WITH r AS ({SPEAKER_SQL})
SELECT spk AS speaker_id FROM r WHERE spk IS NOT NULL GROUP BY spk HAVING count(*) * 50 >= (SELECT count(*) FROM sample_records)"""

STATS_SQL = f"""
WITH r AS ({SPEAKER_SQL})
SELECT spk AS speaker_id, count(*) AS n_rows, count(duration_ms) AS n_timed, sum(duration_ms::DECIMAL(18, 3))::DOUBLE AS total_ms, round(min(duration_ms), 6) AS shortest_ms,
       round(max(duration_ms), 6) AS longest_ms, sum(weight::DECIMAL(18, 6))::DOUBLE AS total_weight, count(DISTINCT path) AS n_paths
FROM r GROUP BY spk"""


def _rows(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return table(spark, folder, "sample_records").select("row_id", speaker(F.col("speaker_id")).alias("speaker_id"), *columns)


@REGISTRY.add("p4_found", FOUND_SQL)
def found(spark: SparkSession, folder: str) -> DataFrame:
    """Speakers that `speaker_id` names in at least one in fifty of all rows."""
    return keys_above(_rows(spark, folder), "speaker_id", 50, salt_by=["row_id"]).select("speaker_id")


@REGISTRY.add("p4_speaker_stats", STATS_SQL)
def stats(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, hours, lengths and distinct files of every speaker, the missing one included."""
    # Sums of decimals don't depend on the order of the rows.
    rows = _rows(spark, folder, "path", "duration_ms", "weight").withColumns({"timed": F.col("duration_ms").isNotNull().cast("bigint"), "exact_ms": F.col("duration_ms").cast("decimal(18,3)"), "exact_weight": F.col("weight").cast("decimal(18,6)")})
    out = salted_aggregate(
        rows,
        "speaker_id",
        [Agg("n_rows", "count"), Agg("n_timed", "sum", "timed"), Agg("total_ms", "sum", "exact_ms"), Agg("shortest_ms", "min", "duration_ms"), Agg("longest_ms", "max", "duration_ms"), Agg("total_weight", "sum", "exact_weight"), Agg("n_paths", "distinct", "path")],
        salt_by=["row_id"],
    )
    r = lambda c: F.round(c, 6)
    return out.select("speaker_id", "n_rows", "n_timed", F.col("total_ms").cast("double").alias("total_ms"), r(F.col("shortest_ms")).alias("shortest_ms"), r(F.col("longest_ms")).alias("longest_ms"), F.col("total_weight").cast("double").alias("total_weight"), "n_paths")
