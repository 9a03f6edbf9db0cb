"""Queries of problem 1 over sample_records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from earshot.functions.speakers import split_name
from earshot.llm.paths import clip_path
from earshot.llm.sql_forms import folder_sql, id_sql, path_sql, split_sql
from earshot.llm.takes import overlapping_takes, take_classes
from earshot.plans.registry import Registry
from earshot.sources.tables import table

REGISTRY = Registry()

_STEM = "regexp_replace(regexp_replace(regexp_extract(p, '([^/]*)$', 1), '\\.(?:wave?|flac|mp3|ogg|m4a|aac|opus)(?:\\.bak|\\.old|\\.tmp)*\\s*$', ''), '[^a-z0-9]+', '_', 'g')"
_DATED, _NUMBERED, _UNCODED = "^(\\d{8})_([a-z0-9]{7,9})_(.+?)_take_?(\\d+)(?:_.*)?$", "^([a-z0-9]{7,9})_(\\d+)_(.+)$", "^(.+?)_t(?:ake)?_?(\\d+)(?:_.*)?$"
_CODED = "^(.+)_([a-z0-9]{7,9})_t(\\d+)(?:_.*)?$"


def _slip(a: str, b: str) -> str:
    letters = lambda x: f"list_sort(string_split({x}, ''))"
    return f"(levenshtein({a}, {b}) <= 1 OR (levenshtein({a}, {b}) = 2 AND length({a}) = length({b}) AND {letters(a)} = {letters(b)}))"


def _coverage(e: str, t: str) -> str:
    half, end = f"(length({e}) + 1) // 2", f"greatest(1, (length({e}) - 1) // 2)"
    side = lambda f: f"CASE WHEN {f}({t}, {half}) = {f}({e}, {half}) THEN {half} WHEN {f}({t}, {end}) = {f}({e}, {end}) THEN {end} ELSE 0 END"
    return f"CASE WHEN {e} = {t} THEN 1.0 ELSE least(1.0, least(length({t}), {side('left')} + {side('right')}) / length({e})) END"


#: The same pairs by joins of sessions, codes of one slip by Damerau's distance.
PAIRS_SQL = f"""
WITH a AS (SELECT row_id, {split_sql('split')} AS split, {id_sql('speaker_id')} AS known, {path_sql('path')} AS p FROM sample_records),
b AS (SELECT *, coalesce(known, {folder_sql('p')}) AS spk, {_STEM} AS f, regexp_extract(p, '/d(\\d{{8}})/', 1) AS d, contains(p, '/sp') AS sp FROM a),
c AS (SELECT *, CASE WHEN regexp_matches(f, '{_DATED}') THEN 1 WHEN regexp_matches(f, '{_NUMBERED}') THEN 2
  WHEN NOT (d <> '' AND sp) AND regexp_matches(f, '{_CODED}') AND (length(regexp_extract(f, '{_CODED}', 2)) = 8 OR regexp_matches(regexp_extract(f, '{_CODED}', 2), '[0-9]')) THEN 3 WHEN regexp_matches(f, '{_UNCODED}') THEN 4 END AS kind FROM b),
t AS (SELECT row_id, split, spk, d, sp, CASE kind WHEN 1 THEN regexp_extract(f, '{_DATED}', 2) WHEN 2 THEN regexp_extract(f, '{_NUMBERED}', 1) WHEN 3 THEN regexp_extract(f, '{_CODED}', 2) END AS code,
  nullif(CASE kind WHEN 1 THEN regexp_extract(f, '{_DATED}', 1) ELSE d END, '') AS day,
  CASE kind WHEN 1 THEN regexp_extract(f, '{_DATED}', 3) WHEN 2 THEN regexp_extract(f, '{_NUMBERED}', 3) WHEN 3 THEN regexp_extract(f, '{_CODED}', 1) WHEN 4 THEN regexp_extract(f, '{_UNCODED}', 1) END AS phrase,
  try_cast(CASE kind WHEN 1 THEN regexp_extract(f, '{_DATED}', 4) WHEN 2 THEN regexp_extract(f, '{_NUMBERED}', 2) WHEN 3 THEN regexp_extract(f, '{_CODED}', 3) WHEN 4 THEN regexp_extract(f, '{_UNCODED}', 2) END AS INT) AS take FROM c WHERE split IS NOT NULL),
w AS (SELECT *, CASE WHEN code IS NULL AND NOT (d <> '' AND sp) THEN nullif(regexp_extract(phrase, '_([a-z]{{7}}|[a-z]{{9}})$', 1), '') END AS tail FROM t WHERE take IS NOT NULL),
k AS (SELECT *, CASE WHEN code IS NOT NULL THEN 'c|' || code WHEN spk IS NOT NULL AND day IS NOT NULL AND phrase IS NOT NULL THEN 'u|' || spk || '|' || day || '|' || phrase END AS key FROM w
  UNION ALL SELECT * REPLACE (tail AS code), 'p|' || tail FROM w WHERE tail IS NOT NULL),
s AS (SELECT key, min(code) AS code, CASE WHEN min(spk) = max(spk) THEN min(spk) END AS spk, CASE WHEN min(day) = max(day) THEN min(day) END AS day, min(phrase) AS phrase, count(*) AS n, bool_or(split <> 'train') AS he, bool_or(split = 'train') AS ht FROM k WHERE key IS NOT NULL GROUP BY key),
q AS (SELECT phrase, count(*) AS n FROM s WHERE code IS NULL GROUP BY phrase),
m AS (SELECT key AS ke, key AS kt FROM s WHERE he AND ht AND NOT starts_with(key, 'p')
  UNION SELECT e.key, x.key FROM s e JOIN s x ON e.code[1:4] = x.code[1:4] AND e.key <> x.key WHERE e.he AND x.ht AND (e.key[1] || x.key[1] = 'cc' OR (e.key[1] || x.key[1] IN ('cp', 'pc') AND 8 IN (length(e.code), length(x.code)))) AND damerau_levenshtein(e.code, x.code) = 1 AND coalesce(e.spk = x.spk, true) AND coalesce(e.day = x.day, true)
  UNION SELECT e.key, x.key FROM s e JOIN s x ON right(e.code, 4) = right(x.code, 4) AND e.key <> x.key WHERE e.he AND x.ht AND (e.key[1] || x.key[1] = 'cc' OR (e.key[1] || x.key[1] IN ('cp', 'pc') AND 8 IN (length(e.code), length(x.code)))) AND damerau_levenshtein(e.code, x.code) = 1 AND coalesce(e.spk = x.spk, true) AND coalesce(e.day = x.day, true)
  UNION SELECT e.key, x.key FROM s e JOIN s x ON e.code[1:3] = x.code[1:3] AND right(e.code, 3) = right(x.code, 3) AND e.key <> x.key WHERE e.he AND x.ht AND (e.key[1] || x.key[1] = 'cc' OR (e.key[1] || x.key[1] IN ('cp', 'pc') AND 8 IN (length(e.code), length(x.code)))) AND damerau_levenshtein(e.code, x.code) = 1 AND coalesce(e.spk = x.spk, true) AND coalesce(e.day = x.day, true)
  UNION SELECT e.key, x.key FROM s e JOIN s x ON e.spk = x.spk AND e.day = x.day AND e.key <> x.key JOIN q qe ON qe.phrase = e.phrase JOIN q qx ON qx.phrase = x.phrase
    WHERE e.code IS NULL AND x.code IS NULL AND e.he AND x.ht AND damerau_levenshtein(e.phrase, x.phrase) = 1 AND (least(qe.n, qx.n) = 1 OR least(qe.n, qx.n) * 8 <= greatest(qe.n, qx.n))),
z AS (SELECT e.row_id AS row_id_eval, x.row_id AS row_id_train, {_coverage('substr(m.ke, 3)', 'substr(m.kt, 3)')} AS coverage FROM k e JOIN m ON e.key = m.ke JOIN k x ON x.key = m.kt AND x.take = e.take
WHERE e.split <> 'train' AND x.split = 'train' AND coalesce(e.spk = x.spk, true) AND (e.key = x.key OR x.code IS NULL OR starts_with(e.phrase, x.phrase) OR starts_with(x.phrase, e.phrase) OR {_slip('e.phrase', 'x.phrase')}))"""
FOUND_SQL = f"{PAIRS_SQL} SELECT least(row_id_eval, row_id_train) AS row_id_a, greatest(row_id_eval, row_id_train) AS row_id_b FROM z"


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "sample_records").select("row_id", "path", "split", "speaker_id")


@REGISTRY.add("p1_found", FOUND_SQL)
def found(spark: SparkSession, folder: str) -> DataFrame:
    """All pairs of a train row with a validation or test row that are the same take."""
    pairs = overlapping_takes(_records(spark, folder))
    return pairs.select(F.least("row_id_train", "row_id_eval").alias("row_id_a"), F.greatest("row_id_train", "row_id_eval").alias("row_id_b"))


COLLECTION = r"(?:^|/)(?:positive|negative|hard_negative|background)/([^/]+)/"


_HITS = "h AS (SELECT row_id_eval AS row_id, count(*) AS n, max(coverage) AS coverage FROM z GROUP BY 1)"


@REGISTRY.add("p1_overlap_by_split", f"""{PAIRS_SQL}, {_HITS},
r AS (SELECT row_id, {split_sql('split')} AS split, regexp_extract({path_sql('path')}, '{COLLECTION}', 1) AS collection FROM sample_records)
SELECT split, collection, count(*) AS n_rows, count(n) AS n_overlapping, coalesce(sum(n), 0)::BIGINT AS n_pairs FROM r LEFT JOIN h USING (row_id) WHERE split IN ('validation', 'test') GROUP BY split, collection""")
def by_split(spark: SparkSession, folder: str) -> DataFrame:
    """Evaluation rows with a train counterpart, their pairs, and all evaluation rows, by split and collection."""
    hit = overlapping_takes(_records(spark, folder)).groupBy("row_id_eval").agg(F.count(F.lit(1)).alias("n_pairs"))
    both = _evaluation(spark, folder).join(hit, F.col("row_id") == F.col("row_id_eval"), "left")
    return both.groupBy("split", "collection").agg(F.count(F.lit(1)).alias("n_rows"), F.count("n_pairs").alias("n_overlapping"), F.coalesce(F.sum("n_pairs"), F.lit(0)).alias("n_pairs"))


def _evaluation(spark: SparkSession, folder: str) -> DataFrame:
    rows = _records(spark, folder).select("row_id", split_name(F.col("split")).alias("split"), F.regexp_extract(clip_path(F.col("path")), COLLECTION, 1).alias("collection"))
    return rows.where(F.col("split").isin("validation", "test"))


@REGISTRY.add("p1_coverage", f"""{PAIRS_SQL}, {_HITS}, r AS (SELECT row_id, {split_sql('split')} AS split FROM sample_records)
SELECT row_id, split, coalesce(n, 0) AS n_pairs, round(coalesce(coverage, 0), 6)::DOUBLE AS coverage FROM r LEFT JOIN h USING (row_id) WHERE split IN ('validation', 'test')""")
def coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Every evaluation row with the number of its train counterparts and the largest share of its session's letters that matches in one of these cover."""
    hit = overlapping_takes(_records(spark, folder)).groupBy("row_id_eval").agg(F.count(F.lit(1)).alias("n_pairs"), F.max("coverage").alias("coverage"))
    both = _evaluation(spark, folder).join(hit, F.col("row_id") == F.col("row_id_eval"), "left")
    return both.select("row_id", "split", F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"), F.round(F.coalesce("coverage", F.lit(0.0)), 6).alias("coverage"))


@REGISTRY.add("p1_class_links")
def class_links(spark: SparkSession, folder: str) -> DataFrame:
    """The pairs without copies: links between classes of rows that are alike, with the rows in each."""
    _, sizes, links = take_classes(_records(spark, folder))
    return links.join(sizes.select(F.col("class_id").alias("class_train"), F.col("n").alias("n_train")), "class_train").join(sizes.select(F.col("class_id").alias("class_eval"), F.col("n").alias("n_eval")), "class_eval")
