"""Queries of corpus, quality, frontier and log aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from earshot.functions.speakers import split_name
from earshot.operators import frontier as fr
from earshot.operators.quantiles import exact_percentiles
from earshot.plans.registry import Registry
from earshot.plans.score_queries import S, r6, stream
from earshot.sources.tables import table

REGISTRY = Registry()

_SPLIT = "CASE trim(lower(replace(split, chr(10), ''))) WHEN 'train' THEN 'train' WHEN 'val' THEN 'validation' WHEN 'validation' THEN 'validation' WHEN 'test' THEN 'test' END"
R = f"r AS (SELECT row_id, path, {_SPLIT} AS split, lower(label) AS label, speaker_id, duration_ms AS ms, sample_rate, weight FROM sample_records)"
LABELS, SPLITS = ("positive", "negative", "hard_negative", "background"), ("train", "validation", "test")


def records(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "sample_records").select("row_id", "path", split_name(F.col("split")).alias("split"), F.lower("label").alias("label"), "speaker_id", F.col("duration_ms").alias("ms"), "sample_rate", "weight")


def exact_sum(c: str) -> F.Column:
    """A sum that doesn't depend on the order of the rows."""
    return F.sum(F.col(c).cast("decimal(18,3)")).cast("double")


@REGISTRY.add("AG1_corpus_stats", f"WITH {R}, g AS (SELECT s.split, l.label FROM (VALUES ('train'), ('validation'), ('test')) s(split) CROSS JOIN (VALUES ('positive'), ('negative'), ('hard_negative'), ('background')) l(label)) SELECT g.split, g.label, count(r.row_id) AS n, round(coalesce(sum(ms::DECIMAL(18, 3))::DOUBLE, 0) / 3600000.0::DOUBLE, 6) AS hours, min(ms) AS shortest, max(ms) AS longest, round(sum(ms::DECIMAL(18, 3))::DOUBLE / count(ms), 6) AS mean FROM g LEFT JOIN r ON r.split = g.split AND r.label = g.label GROUP BY ALL")
def corpus_stats(spark, folder):
    got = records(spark, folder).groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"), exact_sum("ms").alias("ms"), F.min("ms").alias("shortest"), F.max("ms").alias("longest"), (exact_sum("ms") / F.count("ms")).alias("mean"))
    domain = spark.createDataFrame([(s, x) for s in SPLITS for x in LABELS], "split string, label string")
    return domain.join(got, ["split", "label"], "left").select("split", "label", F.coalesce("n", F.lit(0)).alias("n"), F.round(F.coalesce("ms", F.lit(0.0)) / 3600000.0, 6).alias("hours"), "shortest", "longest", F.round("mean", 6).alias("mean"))


@REGISTRY.add("AG2_label_distribution", "SELECT CASE lower(label) WHEN 'positive' THEN 1 WHEN 'hard_negative' THEN 2 ELSE 0 END AS code, count(*) AS n FROM sample_records GROUP BY 1")
def label_distribution(spark, folder):
    return records(spark, folder).groupBy(F.when(F.col("label") == "positive", 1).when(F.col("label") == "hard_negative", 2).otherwise(0).alias("code")).agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add("AG3_class_ratio_guard", f"WITH {R} SELECT split, count(*) FILTER (label = 'positive') AS pos, count(*) FILTER (label <> 'positive') AS neg, CASE WHEN split = 'train' AND count(*) FILTER (label = 'positive') = 0 THEN 'error' WHEN count(*) FILTER (label <> 'positive') < 5 * count(*) FILTER (label = 'positive') THEN 'warn' ELSE 'ok' END AS status FROM r WHERE split IS NOT NULL GROUP BY split")
def class_ratio(spark, folder):
    pos, neg = F.count_if(F.col("label") == "positive"), F.count_if(F.col("label") != "positive")
    g = records(spark, folder).where("split IS NOT NULL").groupBy("split").agg(pos.alias("pos"), neg.alias("neg"))
    return g.withColumn("status", F.when((F.col("split") == "train") & (F.col("pos") == 0), "error").when(F.col("neg") < 5 * F.col("pos"), "warn").otherwise("ok"))


@REGISTRY.add("AG34_quality_summary", """SELECT dir_label, count(*) AS n, min(wqi) AS min_wqi, round(median(wqi), 6) AS med_wqi, round(avg(wqi), 6) AS mean_wqi, max(wqi) AS max_wqi, round(avg(snr_db), 6) AS mean_snr, count(*) FILTER (discard_reason LIKE '%clip%') AS n_clip, count(*) FILTER (discard_reason LIKE '%vad%') AS n_vad, count(*) FILTER (discard) AS n_discard
FROM file_scores WHERE NOT coalesce(isnan(wqi), false) GROUP BY GROUPING SETS ((dir_label), ())""")
def quality_summary(spark, folder):
    q = table(spark, folder, "file_scores").where(~F.coalesce(F.isnan("wqi"), F.lit(False)))
    has = lambda x: F.count_if(F.col("discard_reason").contains(x))
    every = F.array(F.struct(F.lit(True).alias("one"), F.col("dir_label").alias("dir_label")), F.struct(F.lit(False).alias("one"), F.lit(None).cast("string").alias("dir_label")))
    both = q.select("wqi", F.explode(every).alias("g")).select("wqi", "g.*")
    middle = exact_percentiles(both, ["one", "dir_label"], "wqi", {"med_wqi": 0.5}).select(F.col("one").alias("_one"), F.col("dir_label").alias("_d"), F.round("med_wqi", 6).alias("med_wqi"))
    g = q.rollup("dir_label").agg(F.grouping("dir_label").alias("_all"), F.count(F.lit(1)).alias("n"), F.min("wqi").alias("min_wqi"), F.round(F.avg("wqi"), 6).alias("mean_wqi"), F.max("wqi").alias("max_wqi"), F.round(F.avg("snr_db"), 6).alias("mean_snr"), has("clip").alias("n_clip"), has("vad").alias("n_vad"), F.count_if("discard").alias("n_discard"))
    return g.join(middle, F.col("dir_label").eqNullSafe(F.col("_d")) & ((F.col("_all") == 0) == F.col("_one")), "left").drop("_all", "_one", "_d")


@REGISTRY.add("AG35_cluster_summary", "WITH g AS (SELECT label, count(*) AS size, list_slice(list(vec_id ORDER BY vec_id), 1, 5) AS first_five FROM embeddings GROUP BY label) SELECT label, size, round(100.0 * size / sum(size) OVER (), 6) AS pct, array_to_string(first_five, ',') AS first_five, min(size) OVER () AS smallest, max(size) OVER () AS largest, round(avg(size) OVER (), 6) AS mean_size FROM g")
def cluster_summary(spark, folder):
    e = table(spark, folder, "embeddings").select("vec_id", "label")
    rank = e.withColumn("r", F.row_number().over(Window.partitionBy("label").orderBy("vec_id")))
    g = rank.groupBy("label").agg(F.count(F.lit(1)).alias("size"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("r") <= 5, F.col("vec_id")))).cast("array<string>"), ",").alias("first_five"))
    total = g.agg(F.sum("size").alias("t"), F.min("size").alias("smallest"), F.max("size").alias("largest"), F.round(F.avg("size"), 6).alias("mean_size"))
    return g.join(F.broadcast(total)).select("label", "size", F.round(100.0 * F.col("size") / F.col("t"), 6).alias("pct"), "first_five", "smallest", "largest", "mean_size")


P = "p AS (SELECT log_id, run_id, epoch, logged_at, fp_threshold, unnest(false_predictions) AS f FROM prediction_logs)"


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    logs = table(spark, folder, "prediction_logs")
    return logs.select("log_id", "run_id", "epoch", "logged_at", "fp_threshold", F.explode("false_predictions").alias("f")).select("*", "f.idx", "f.score", "f.file_path").drop("f")


@REGISTRY.add("AG36_false_positive_counter", f"WITH {P} SELECT f.file_path AS file_path, count(*) AS n FROM p WHERE f.file_path IS NOT NULL GROUP BY 1 ORDER BY n DESC, file_path LIMIT 20")
def fp_counter(spark, folder):
    return predictions(spark, folder).where("file_path IS NOT NULL").groupBy("file_path").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "file_path").limit(20)


@REGISTRY.add("AG37_group_keep_best", "SELECT lower(p_name) AS text, max(p_retailprice) AS best, arg_max(p_partkey, p_retailprice * 1000000 - p_partkey) AS partkey, count(*) AS n FROM part GROUP BY 1 HAVING max(p_retailprice) >= 950")
def keep_best(spark, folder):
    return table(spark, folder, "part").groupBy(F.lower("p_name").alias("text")).agg(F.max("p_retailprice").alias("best"), F.max_by("p_partkey", F.struct("p_retailprice", -F.col("p_partkey"))).alias("partkey"), F.count(F.lit(1)).alias("n")).where("best >= 950")


@REGISTRY.add("AG38_distinct_count", "SELECT count(DISTINCT text) AS texts, count(DISTINCT source) AS sources, count(DISTINCT author) AS authors FROM documents")
def distinct_count(spark, folder):
    # Texts are compared by their hash, so that whole texts aren't shuffled.
    d = table(spark, folder, "documents").select(F.sha2("text", 256).alias("h"), "source", "author")
    return d.agg(F.count_distinct("h").alias("texts"), F.count_distinct("source").alias("sources"), F.count_distinct("author").alias("authors"))


@REGISTRY.add("AG39_reason_counts", "SELECT regexp_replace(discard_reason, '[0-9.]+', '#', 'g') AS reason, count(*) AS n FROM file_scores WHERE discard_reason <> '' GROUP BY 1")
def reasons(spark, folder):
    return table(spark, folder, "file_scores").where("discard_reason <> ''").groupBy(F.regexp_replace("discard_reason", "[0-9.]+", "#").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add("AG40_op_frequency", "SELECT op, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[a-z]+_[0-9]+\\.wav')) AS f FROM documents), LATERAL (SELECT regexp_extract(f, '^[a-z]+') AS op) GROUP BY op")
def op_frequency(spark, folder):
    ops = table(spark, folder, "documents").select(F.explode(F.regexp_extract_all("text", F.lit(r"([a-z]+)_[0-9]+\.wav"), 1)).alias("op"))
    return ops.groupBy("op").agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add("AG41_agreement", f"WITH {S}, q AS (SELECT score AS a, floor(score * 255 + 0.5) / 255::DOUBLE AS b FROM s) SELECT round(avg(abs(a - b)), 9) AS mean_gap, round(max(abs(a - b)), 9) AS max_gap, round(median(abs(a - b)), 9) AS median_gap, round(avg(CASE WHEN (a > 0.5) = (b > 0.5) THEN 1.0 ELSE 0 END), 6) AS agreement, round(corr(a, b), 6) AS pearson FROM q")
def agreement(spark, folder):
    q = stream(spark, folder).select(F.col("score").alias("a"), (F.floor(F.col("score") * 255 + 0.5) / F.lit(255.0)).alias("b"))
    gap = F.abs(F.col("a") - F.col("b"))
    middle = exact_percentiles(q.select(gap.alias("gap")), [], "gap", {"m": 0.5}).select(F.round("m", 9).alias("median_gap"))
    return middle.join(F.broadcast(q.agg(F.round(F.avg(gap), 9).alias("mean_gap"), F.round(F.max(gap), 9).alias("max_gap"), F.round(F.avg(F.when((F.col("a") > 0.5) == (F.col("b") > 0.5), 1.0).otherwise(0.0)), 6).alias("agreement"), F.round(F.corr("a", "b"), 6).alias("pearson"))))


C = "c AS (SELECT p_partkey AS id, p_size::DOUBLE AS fah, (p_partkey * 7919 % 1000) / 1000::DOUBLE AS recall, (p_partkey * 104729 % 997) / 997::DOUBLE AS auc_pr FROM part)"


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, folder, "part").select(k.alias("id"), F.col("p_size").cast("double").alias("fah"), (k * 7919 % 1000 / F.lit(1000.0)).alias("recall"), (k * 104729 % 997 / F.lit(997.0)).alias("auc_pr"))


@REGISTRY.add("AG42_pareto_front", f"WITH {C} SELECT id, fah, recall, auc_pr FROM c a WHERE NOT EXISTS (SELECT 1 FROM c b WHERE b.fah <= a.fah AND b.recall >= a.recall AND b.auc_pr >= a.auc_pr AND (b.fah < a.fah OR b.recall > a.recall OR b.auc_pr > a.auc_pr))")
def pareto(spark, folder):
    return fr.skyline(candidates(spark, folder), "fah", "recall", "auc_pr")


@REGISTRY.add("AG42_pareto_front_2d", f"WITH {C} SELECT id, fah, recall FROM c a WHERE NOT EXISTS (SELECT 1 FROM c b WHERE b.fah <= a.fah AND b.recall >= a.recall AND (b.fah < a.fah OR b.recall > a.recall))")
def pareto_2d(spark, folder):
    return fr.skyline(candidates(spark, folder), "fah", "recall").select("id", "fah", "recall")


@REGISTRY.add("AG42_archive_pruned")
def archive(spark, folder):
    """The front, less its most crowded members until 10 are left; fronts of over 5,000 rows are refused."""
    rows = [r.asDict() for r in fr.skyline(candidates(spark, folder), "fah", "recall", "auc_pr").orderBy("id").limit(5001).collect()]
    if len(rows) > 5000:
        raise ValueError("the front is too large to prune")
    return spark.createDataFrame([tuple(r.values()) for r in fr.prune_by_crowding(rows, 10, "fah", "recall", "auc_pr")], "id bigint, fah double, recall double, auc_pr double")


@REGISTRY.add("AG43_hypervolume", f"WITH {C}, g AS (SELECT 60.0 - fah AS a, max(recall) AS b FROM c WHERE 60.0 - fah > 0 AND recall > 0 GROUP BY 1), h AS (SELECT a, max(b) OVER (ORDER BY a DESC ROWS UNBOUNDED PRECEDING) AS h, coalesce(lead(a) OVER (ORDER BY a DESC), 0) AS nx FROM g) SELECT round(sum((a - nx) * h), 6) AS hypervolume FROM h")
def hyper(spark, folder):
    return r6(fr.hypervolume(candidates(spark, folder), "fah", "recall", 60.0, 0.0))


@REGISTRY.add("AG44_best_candidate", f"WITH {C} SELECT id, fah, recall FROM c ORDER BY CASE WHEN fah <= 5 AND recall >= 0.9 THEN 0 ELSE 1 END, CASE WHEN fah <= 5 AND recall >= 0.9 THEN -recall ELSE 2 * greatest(0, fah - 5) / 5 + greatest(0, 0.9 - recall) / 0.9 END, id LIMIT 1")
def best(spark, folder):
    return fr.best_candidate(candidates(spark, folder), "fah", "recall", 5.0, 0.9, F.col("id")).select("id", "fah", "recall")


@REGISTRY.add("AG45_error_memory", f"""WITH {S}, h AS (SELECT clip, score, y, row_number() OVER (PARTITION BY clip ORDER BY ts DESC, row_id DESC) AS r FROM s)
SELECT clip, count(*) FILTER (score >= 0.65 AND y = 0) AS n_fa, count(*) FILTER (score < 0.65 AND y = 1) AS n_miss, count(*) FILTER (score >= 0.65 AND y = 0) >= 3 AS persistent_fa, abs(avg(score) FILTER (r <= 10) - 0.45) < 0.05 AS near_boundary FROM h GROUP BY clip""")
def error_memory(spark, folder):
    w = Window.partitionBy("clip").orderBy(F.desc("ts"), F.desc("row_id"))
    h = stream(spark, folder).withColumn("r", F.row_number().over(w))
    fa, miss = F.count_if((F.col("score") >= 0.65) & (F.col("y") == 0)), F.count_if((F.col("score") < 0.65) & (F.col("y") == 1))
    return h.groupBy("clip").agg(fa.alias("n_fa"), miss.alias("n_miss"), (fa >= 3).alias("persistent_fa"), (F.abs(F.avg(F.when(F.col("r") <= 10, F.col("score"))) - 0.45) < 0.05).alias("near_boundary"))


@REGISTRY.add("AG46_plateau_metrics", f"""WITH {S}, n AS (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY ts, row_id) - 1 AS i FROM s)
SELECT row_id, round(max(score) OVER w - min(score) OVER w, 6) AS gap, CASE WHEN row_number() OVER (PARTITION BY clip ORDER BY ts, row_id) = 1 THEN 0 ELSE round(regr_slope(score, i) OVER w, 6) END AS slope FROM n WINDOW w AS (PARTITION BY clip ORDER BY ts, row_id ROWS 4 PRECEDING)""")
def plateau(spark, folder):
    o = Window.partitionBy("clip").orderBy("ts", "row_id")
    n = stream(spark, folder).withColumn("i", (F.row_number().over(o) - 1).cast("double"))
    w = o.rowsBetween(-4, 0)
    return r6(n.select("row_id", (F.max("score").over(w) - F.min("score").over(w)).alias("gap"), F.coalesce(F.regr_slope("score", "i").over(w), F.lit(0.0)).alias("slope")))


@REGISTRY.add("AG47_composite_quality", f"WITH {C} SELECT id, round((0.7 * recall + 0.3 * coalesce(nullif(auc_pr, 0), recall)) / (1 + (fah / greatest(0.5, 0.01)) * (fah / greatest(0.5, 0.01))), 9) AS quality FROM c")
def composite(spark, folder):
    x = F.col("fah") / max(0.5, 0.01)
    return candidates(spark, folder).select("id", F.round((0.7 * F.col("recall") + 0.3 * F.coalesce(F.nullif("auc_pr", F.lit(0.0)), "recall")) / (1 + x * x), 9).alias("quality"))


@REGISTRY.add("AG50_clipping_ratio", "SELECT vec_id, len(list_filter(embedding, lambda v: abs(v) >= 0.2)) / len(embedding)::DOUBLE AS clip_ratio FROM embeddings")
def clipping(spark, folder):
    e = F.col("embedding")
    return table(spark, folder, "embeddings").select("vec_id", F.when(F.size(e) > 0, F.size(F.filter(e, lambda v: F.abs(v) >= F.lit(0.2))) / F.size(e)).otherwise(0.0).alias("clip_ratio"))


@REGISTRY.add("AG52_duration_stats", f"WITH {R} SELECT min(ms) AS shortest, max(ms) AS longest, round(sum(ms::DECIMAL(18, 3))::DOUBLE / count(ms), 6) AS mean, round(sum(ms::DECIMAL(18, 3))::DOUBLE / 3600000, 6) AS hours FROM r")
def durations(spark, folder):
    return records(spark, folder).agg(F.min("ms").alias("shortest"), F.max("ms").alias("longest"), F.round(exact_sum("ms") / F.count("ms"), 6).alias("mean"), F.round(exact_sum("ms") / 3600000, 6).alias("hours"))


@REGISTRY.add("AG53_arena_estimate", "SELECT p_type, round(sum(list_product([p_size::DOUBLE, 40.0, CASE WHEN p_size % 2 = 0 THEN 1.0 ELSE 4.0 END])) * 1.1, 3) AS bytes FROM part GROUP BY p_type")
def arena(spark, folder):
    shape = F.array(F.col("p_size").cast("double"), F.lit(40.0), F.when(F.col("p_size") % 2 == 0, 1.0).otherwise(4.0))
    return table(spark, folder, "part").groupBy("p_type").agg(F.round(F.sum(F.aggregate(shape, F.lit(1.0), lambda a, v: a * v)) * 1.1, 3).alias("bytes"))


@REGISTRY.add("AG54_dataset_duration", f"WITH {R} SELECT split, round(sum(0.01 * floor(ms / 10)) / 3600, 4) AS hours FROM r WHERE split IS NOT NULL GROUP BY split")
def dataset_duration(spark, folder):
    return records(spark, folder).where("split IS NOT NULL").groupBy("split").agg(F.round(F.sum(F.floor(F.col("ms") / 10)) * 0.01 / 3600, 4).alias("hours"))


@REGISTRY.add("AG55_gain_per_1k_steps", f"WITH {S}, n AS (SELECT *, event_id AS step FROM (SELECT *, row_id AS event_id FROM s)) SELECT row_id, round((score - lag(score) OVER w) * 1000.0 / (step - lag(step) OVER w), 6) AS gain, round((lag(w) OVER w - w) * 1000.0 / (step - lag(step) OVER w), 6) AS fah_gain FROM n WINDOW w AS (PARTITION BY clip ORDER BY step)")
def gain(spark, folder):
    w = Window.partitionBy("clip").orderBy("row_id")
    step = F.col("row_id") - F.lag("row_id").over(w)
    return r6(stream(spark, folder).select("row_id", ((F.col("score") - F.lag("score").over(w)) * 1000.0 / step).alias("gain"), ((F.lag("w").over(w) - F.col("w")) * 1000.0 / step).alias("fah_gain")))


@REGISTRY.add("AG56_io_profile", """WITH e AS (SELECT event_type AS op, event_id, value AS ms, length(props) AS bytes FROM events), k AS (SELECT *, row_number() OVER (PARTITION BY op ORDER BY ms DESC, event_id) AS r FROM e)
SELECT op, count(*) AS n, sum(bytes)::BIGINT AS bytes, round(sum(ms), 4) AS ms, round(sum(bytes) / sum(ms), 6) AS throughput, array_to_string(list(event_id ORDER BY r) FILTER (r <= 5), ',') AS slowest FROM k GROUP BY op""")
def io_profile(spark, folder):
    e = table(spark, folder, "events").select(F.col("event_type").alias("op"), "event_id", F.col("value").alias("ms"), F.length("props").cast("bigint").alias("bytes"))
    slow = e.withColumn("r", F.row_number().over(Window.partitionBy("op").orderBy(F.desc("ms"), "event_id"))).where("r <= 5").groupBy("op").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "event_id"))), lambda x: x["event_id"].cast("string")), ",").alias("slowest"))
    total = e.groupBy("op").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"), F.sum("ms").alias("ms"))
    return total.join(slow, "op").select("op", "n", "bytes", F.round("ms", 4).alias("ms"), F.round(F.col("bytes") / F.col("ms"), 6).alias("throughput"), "slowest")


@REGISTRY.add("AG58_curation_actions", """WITH a AS (SELECT CASE doc_id % 4 WHEN 0 THEN 'keep' WHEN 1 THEN 'trim' WHEN 2 THEN 'split' ELSE 'discard' END AS action, CASE WHEN doc_id % 3 = 0 THEN 'n/a' ELSE (doc_id % 5)::VARCHAR END AS reason FROM documents)
SELECT count(*) FILTER (action = 'keep') AS kept, count(*) FILTER (action = 'trim') AS trimmed, count(*) FILTER (action = 'split') AS split, count(*) FILTER (action = 'discard') AS discarded, count(*) FILTER (action IN ('keep', 'trim')) + coalesce(sum(try_cast(reason AS INT)) FILTER (action = 'split'), 0)::BIGINT AS output FROM a""")
def curation(spark, folder):
    m = F.col("doc_id") % 4
    a = table(spark, folder, "documents").select(F.when(m == 0, "keep").when(m == 1, "trim").when(m == 2, "split").otherwise("discard").alias("action"), F.when(F.col("doc_id") % 3 == 0, "n/a").otherwise((F.col("doc_id") % 5).cast("string")).alias("reason"))
    n = lambda *x: F.count_if(F.col("action").isin(*x))
    parts = F.coalesce(F.sum(F.when(F.col("action") == "split", F.col("reason").try_cast("int"))), F.lit(0))
    return a.agg(n("keep").alias("kept"), n("trim").alias("trimmed"), n("split").alias("split"), n("discard").alias("discarded"), (n("keep", "trim") + parts).alias("output"))


@REGISTRY.add("AG59_status_bands", f"WITH {C} SELECT id, CASE WHEN fah <= 0.5 THEN 'good' WHEN fah <= 2 THEN 'fair' ELSE 'poor' END AS fah_band, CASE WHEN recall >= 0.9 THEN 'good' WHEN recall >= 0.8 THEN 'fair' ELSE 'poor' END AS recall_band FROM c")
def bands(spark, folder):
    band = lambda c, g, f, up: F.when((F.col(c) >= g) if up else (F.col(c) <= g), "good").when((F.col(c) >= f) if up else (F.col(c) <= f), "fair").otherwise("poor")
    return candidates(spark, folder).select("id", band("fah", 0.5, 2, False).alias("fah_band"), band("recall", 0.9, 0.8, True).alias("recall_band"))


@REGISTRY.add("AG62_array_health", """SELECT vec_id, len(list_filter(embedding, lambda v: v = 0)) / 64::DOUBLE AS sparsity, len(list_filter(embedding, lambda v: abs(v) > 0.2)) / 64::DOUBLE AS saturation, round(list_avg(list_transform(embedding, lambda v: v::DOUBLE)), 5) AS mean,
round(sqrt(list_sum(list_transform(embedding, lambda v: v::DOUBLE * v::DOUBLE))), 5) AS norm, list_max(list_transform(embedding, lambda v: abs(v)))::DOUBLE AS max_abs FROM embeddings""")
def health(spark, folder):
    e = F.transform("embedding", lambda v: v.cast("double"))
    n = F.size(e)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, v: x + v)
    share = lambda f: F.size(F.filter(e, f)) / n
    return table(spark, folder, "embeddings").select("vec_id", share(lambda v: v == 0).alias("sparsity"), share(lambda v: F.abs(v) > F.lit(0.2).cast("float").cast("double")).alias("saturation"), F.round(total(e) / n, 5).alias("mean"), F.round(F.sqrt(total(F.transform(e, lambda v: v * v))), 5).alias("norm"), F.array_max(F.transform(e, lambda v: F.abs(v))).alias("max_abs"))
