"""Queries of problem 3 over file_scores and keep_targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from earshot.llm.cutoffs import Cutoffs, below_cutoff, source_cutoffs
from earshot.plans.registry import Registry
from earshot.sources.tables import table

REGISTRY = Registry()

_COUNTED = """
t AS (SELECT dir_label AS source, keep_pct, regexp_replace(lower(dir_label), '[^a-z0-9]', '', 'g') AS k FROM keep_targets),
l AS (SELECT DISTINCT dir_label, regexp_replace(lower(regexp_extract(dir_label, '([^/]*?)[/\\s]*$', 1)), '[^a-z0-9]', '', 'g') AS k FROM file_scores WHERE dir_label IS NOT NULL),
m AS (SELECT dir_label, min(source) AS source, min(keep_pct) AS keep_pct FROM (
  SELECT l.dir_label, t.source, t.keep_pct, l.k = t.k AS exact, max(l.k = t.k) OVER (PARTITION BY l.dir_label) AS any_exact, count(*) OVER (PARTITION BY l.dir_label) AS n
  FROM l JOIN t ON l.k = t.k OR (length(l.k) >= 5 AND damerau_levenshtein(l.k, t.k) <= 1)) WHERE exact OR (NOT any_exact AND n = 1) GROUP BY dir_label),
r AS (SELECT s.score_id, m.source, m.keep_pct, s.wqi FROM file_scores s JOIN m USING (dir_label)
  WHERE coalesce(NOT s.discard, true) AND s.wqi IS NOT NULL AND NOT isnan(s.wqi) AND s.wqi BETWEEN 0 AND 1),
c AS (SELECT source, keep_pct, wqi, count(*) OVER (PARTITION BY source) AS n, count(*) OVER (PARTITION BY source ORDER BY wqi DESC RANGE UNBOUNDED PRECEDING) AS kept FROM r),
x AS (SELECT source, keep_pct, n AS n_rows, max(wqi) AS cutoff, arg_max(kept, wqi) AS n_kept FROM c WHERE kept * 100 >= keep_pct * n GROUP BY ALL)"""


def _cutoffs(spark: SparkSession, folder: str) -> Cutoffs:
    scores = table(spark, folder, "file_scores").select("score_id", "dir_label", "wqi", "discard")
    return source_cutoffs(scores, table(spark, folder, "keep_targets").select(F.col("dir_label"), F.col("keep_pct")), source="dir_label", value="wqi", keep=["score_id"], dropped="discard")


@REGISTRY.add("p3_found", f"WITH {_COUNTED} SELECT r.score_id FROM r JOIN x USING (source) WHERE r.wqi < x.cutoff")
def found(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of file_scores below their source's cutoff."""
    return below_cutoff(_cutoffs(spark, folder)).select("score_id")


@REGISTRY.add("p3_cutoffs", f"WITH {_COUNTED} SELECT source, keep_pct, n_rows, cutoff, n_kept FROM x")
def cutoffs(spark: SparkSession, folder: str) -> DataFrame:
    """The cutoff and kept size of every source."""
    return _cutoffs(spark, folder).table
