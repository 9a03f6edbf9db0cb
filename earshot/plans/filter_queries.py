"""Queries of scans, filters, scalar functions and curation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from earshot.functions import arrays as ar, scalars as sf
from earshot.operators import curation as cu
from earshot.operators.splitting import draw, paired, uniform
from earshot.plans.aggregate_queries import P, R, exact_sum, predictions, records
from earshot.plans.registry import Registry
from earshot.plans.score_queries import S, stream
from earshot.sources import audio
from earshot.sources.tables import table

REGISTRY = Registry()


def _placed_sql(a: str) -> str:
    return f"round(list_sum(list_transform({a}, lambda v, i: v::DOUBLE * i)), 3)"


def _placed(c: F.Column) -> F.Column:
    return F.round(ar.placed(c), 3)


def draw_sql(*x: str) -> str:
    """`splitting.draw` in DuckDB's SQL."""
    return f"('0x' || left(md5(concat_ws(':', {', '.join(x)})), 13))::BIGINT"



@REGISTRY.add("PF1_range_inclusive", "SELECT row_id FROM sample_records WHERE duration_ms BETWEEN 300 AND 2000")
def pf1(spark, folder):
    return records(spark, folder).where(F.col("ms").between(300, 2000)).select("row_id")


@REGISTRY.add("PF2_range_exclusive", "SELECT row_id FROM sample_records WHERE duration_ms > 300 AND duration_ms < 2000")
def pf2(spark, folder):
    return records(spark, folder).where((F.col("ms") > 300) & (F.col("ms") < 2000)).select("row_id")


@REGISTRY.add("PF3_equality_filters", f"WITH {R} SELECT row_id FROM r WHERE split = 'train' AND label = 'positive'")
def pf3(spark, folder):
    return records(spark, folder).where((F.col("split") == "train") & (F.col("label") == "positive")).select("row_id")


@REGISTRY.add("PF4_clip_gate_reason", "SELECT score_id, CASE WHEN clip_ratio > 0.01 THEN printf('clipping %.4f%% > %.4f%%', clip_ratio * 100, 0.01::DOUBLE * 100) WHEN vad_conf < 0.55 THEN printf('vad %.4f < %.4f', vad_conf, 0.55::DOUBLE) END AS reason FROM file_scores")
def pf4(spark, folder):
    return table(spark, folder, "file_scores").select("score_id", cu.clip_gate(F.col("clip_ratio"), F.col("vad_conf"), 0.01, 0.55, digits=4).alias("reason"))


@REGISTRY.add("PF5_hard_samples", f"WITH {S} SELECT row_id, 'confidence' AS strategy FROM s WHERE y = 0 AND score >= 0.6 UNION ALL SELECT row_id, 'entropy' FROM s WHERE y = 0 AND abs(score - 0.5) < 0.1")
def pf5(spark, folder):
    s = stream(spark, folder).where("y = 0")
    by = lambda name, c: s.where(c).select("row_id", F.lit(name).alias("strategy"))
    return by("confidence", F.col("score") >= 0.6).unionByName(by("entropy", F.abs(F.col("score") - 0.5) < 0.1))


@REGISTRY.add("PF6_epoch_filter", "SELECT log_id, try_cast(epoch AS INT) AS epoch FROM prediction_logs WHERE regexp_matches(epoch, '^[0-9]+$') AND try_cast(epoch AS INT) >= 3")
def pf6(spark, folder):
    e = F.when(F.col("epoch").rlike("^[0-9]+$"), F.col("epoch").try_cast("int"))
    return table(spark, folder, "prediction_logs").select("log_id", e.alias("epoch")).where("epoch >= 3")


@REGISTRY.add("PF7_path_predicate", "SELECT row_id FROM sample_records WHERE NOT regexp_matches(path, '/speaker_[^/]*/') AND NOT regexp_matches(path, '_copy[0-9]*[.]')")
def pf7(spark, folder):
    return records(spark, folder).where(~F.col("path").rlike("/speaker_[^/]*/") & ~F.col("path").rlike(r"_copy[0-9]*[.]")).select("row_id")


@REGISTRY.add("PF8_risk_filter", f"WITH {S} SELECT row_id, CASE WHEN score >= 0.82 THEN 'HIGH' WHEN score >= 0.72 THEN 'MEDIUM' ELSE 'LOW' END AS risk FROM s WHERE score >= 0.72")
def pf8(spark, folder):
    wanted = [x.strip().upper() for x in "high, Medium".split(",")]
    if bad := set(wanted) - {"HIGH", "MEDIUM", "LOW"}:
        raise ValueError(f"unknown levels {bad}")
    return stream(spark, folder).select("row_id", sf.risk(F.col("score")).alias("risk")).where(F.col("risk").isin(wanted))


@REGISTRY.add("PF9_label_binarise", f"WITH {S} SELECT row_id, CASE WHEN raw = 1 THEN 1 ELSE 0 END AS by_value, raw & 1 AS by_bit FROM s")
def pf9(spark, folder):
    return stream(spark, folder).select("row_id", (F.col("raw") == 1).cast("int").alias("by_value"), F.col("raw").bitwiseAND(1).alias("by_bit"))


@REGISTRY.add("PF10_class_weights", f"WITH {S} SELECT row_id, w * CASE raw WHEN 1 THEN 2.0 WHEN 2 THEN 3.0 ELSE 1.0 END AS weight FROM s")
def pf10(spark, folder):
    return stream(spark, folder).select("row_id", (F.col("w") * F.when(F.col("raw") == 1, 2.0).when(F.col("raw") == 2, 3.0).otherwise(1.0)).alias("weight"))


_E = "SELECT vec_id, list_slice(embedding, 1, 20 + vec_id % 60) AS a FROM embeddings"


def _ragged(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select("vec_id", F.slice("embedding", F.lit(1), (20 + F.col("vec_id") % 60).cast("int")).alias("a"))


def _sums(df: DataFrame, c: F.Column, *keys: str) -> DataFrame:
    return df.select(*keys, F.size(c).alias("size"), F.round(ar.total(c), 4).alias("total"))


@REGISTRY.add("PF11_pad_truncate", f"SELECT vec_id, 40 AS size, round(list_sum(list_slice(a, 1, 40)), 4) AS total FROM ({_E})")
def pf11(spark, folder):
    return _sums(_ragged(spark, folder), ar.pad_or_cut(F.col("a"), 40), "vec_id")


@REGISTRY.add("PF12_fixed_length", f"SELECT vec_id, 40 AS size, round(list_sum(CASE WHEN len(a) <= 40 THEN a ELSE list_slice(a, len(a) - 39, len(a)) END), 4) AS total FROM ({_E})")
def pf12(spark, folder):
    return _sums(_ragged(spark, folder), ar.fixed_length(F.col("a"), 40, "truncate_start"), "vec_id")


@REGISTRY.add("PF13_error_tolerant_map", "SELECT log_id, try_cast(epoch AS INT) AS epoch, try_cast(epoch AS INT) IS NULL AS failed FROM prediction_logs WHERE regexp_matches(epoch, '^[0-9a-z]+$')")
def pf13(spark, folder):
    e = F.col("epoch").try_cast("int")
    return table(spark, folder, "prediction_logs").where(F.col("epoch").rlike("^[0-9a-z]+$")).select("log_id", e.alias("epoch"), e.isNull().alias("failed"))


@REGISTRY.add("PF15_pad_to_group", f"WITH e AS ({_E}), m AS (SELECT *, max(len(a)) OVER (PARTITION BY vec_id % 10) AS n FROM e) SELECT vec_id, n::INT AS size, round(list_sum(a), 4) AS total FROM m")
def pf15(spark, folder):
    e = _ragged(spark, folder)
    most = e.groupBy((F.col("vec_id") % 10).alias("_g")).agg(F.max(F.size("a")).alias("n"))
    return _sums(e.join(F.broadcast(most), F.col("vec_id") % 10 == F.col("_g")), ar.pad_or_cut(F.col("a"), F.col("n")), "vec_id")


@REGISTRY.add("PF16_constraint_issues", f"""WITH {R} SELECT row_id, array_to_string(list_filter([CASE WHEN ms < 300 THEN 'too short' END, CASE WHEN ms > 2000 THEN 'too long' END, CASE WHEN sample_rate <> 16000 THEN 'odd rate' END, CASE WHEN weight <= 0 THEN 'no weight' END], lambda x: x IS NOT NULL), '; ') AS issues FROM r""")
def pf16(spark, folder):
    found = cu.issues((F.col("ms") < 300, "too short"), (F.col("ms") > 2000, "too long"), (F.col("sample_rate") != 16000, "odd rate"), (F.col("weight") <= 0, "no weight"))
    return records(spark, folder).select("row_id", F.array_join(found, "; ").alias("issues"))


@REGISTRY.add("PF17_document_validation", "SELECT event_id, props::JSON->>'k' IS NOT NULL AND (props::JSON->>'k')::INT < 90 AS compatible, CASE WHEN (props::JSON->>'k')::INT >= 90 THEN 'k out of range' ELSE '' END AS errors FROM events")
def pf17(spark, folder):
    k = F.from_json("props", "k int")["k"]
    errors = cu.issues((k.isNull(), "k missing"), (k >= 90, "k out of range"))
    return table(spark, folder, "events").select("event_id", (F.size(errors) == 0).alias("compatible"), F.array_join(errors, "; ").alias("errors"))


@REGISTRY.add("PF18_variants_with_fallback", f"WITH {S} SELECT row_id, k::INT AS variant, CASE WHEN raw = 2 THEN score ELSE score * (1 + k) END AS value FROM s, range(3) r(k)")
def pf18(spark, folder):
    s = stream(spark, folder).withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(2))))
    changed = F.when(F.col("raw") != 2, F.col("score") * (1 + F.col("variant")))
    return s.select("row_id", "variant", F.coalesce(changed, "score").alias("value"))


_U = lambda step: f"{draw_sql('vec_id', repr(step), '42')} / 4503599627370496.0"


@REGISTRY.add("PF19_transform_chain", f"""WITH a AS (SELECT vec_id, CASE WHEN {_U('gain')} < 0.5 THEN list_transform(embedding, lambda v: (v * 1.5::DOUBLE)::FLOAT) ELSE embedding END AS a FROM embeddings),
b AS (SELECT vec_id, CASE WHEN {_U('drive')} < 0.3 THEN list_transform(a, lambda v: tanh(v::DOUBLE * 2)::FLOAT) ELSE a END AS a FROM a),
c AS (SELECT vec_id, CASE WHEN {_U('mask')} < 0.4 THEN list_transform(a, lambda v, i: CASE WHEN i BETWEEN 11 AND 20 THEN 0 ELSE v END) ELSE a END AS a FROM b),
d AS (SELECT vec_id, CASE WHEN {_U('shift')} < 0.2 THEN a[9:] || a[:8] ELSE a END AS a FROM c) SELECT vec_id, len(a)::INT AS size, {_placed_sql('a')} AS placed FROM d""")
def pf19(spark, folder):
    """Steps in order, each taken with its probability by a hash of row and step: gain, drive, mask, shift."""
    e = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("a"))
    steps = (("gain", 0.5, lambda a: F.transform(a, lambda v: (v * 1.5).cast("float"))), ("drive", 0.3, lambda a: F.transform(a, lambda v: F.tanh(v * 2).cast("float"))), ("mask", 0.4, lambda a: ar.masked(a, F.lit(10), F.lit(20))), ("shift", 0.2, lambda a: F.concat(F.slice(a, F.lit(9), F.size(a)), F.slice(a, 1, 8))))
    for name, p, f in steps:
        e = e.withColumn("a", F.when(uniform(F.col("vec_id"), F.lit(name), F.lit(42)) < p, f(F.col("a"))).otherwise(F.col("a")))
    return e.select("vec_id", F.size("a").alias("size"), _placed(F.col("a")).alias("placed"))


# ---- scalar functions

_WORDS = "SELECT vec_id, embedding AS a FROM embeddings"


#: The texts of names by the same patterns; the fifth, which looks ahead, by the parts between the marks.
TEXTS_SQL = """SELECT row_id, path, coalesce(nullif(trim(regexp_replace(lower(regexp_replace(array_to_string(list_filter(part, lambda x, i: i = 1 OR i = len(part) OR NOT (regexp_full_match(x, '[a-z0-9]{4,6}')
  AND regexp_matches(array_to_string(part[i:], '-'), '[0-9]') AND regexp_matches(array_to_string(part[i:], '-'), '[a-z]'))), '-'), '[-_][0-9]{1,3}$', '')), '[-_ ]+', ' ', 'g')), ''), 'unknown') AS text
FROM (SELECT row_id, path, string_split_regex(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_extract(path, '([^/]*)$', 1), '^(.+)[.][^.]*$', '\\1'), '[-_]v?[0-9]+$', ''),
  '(?i)[-_]?(sample|recording|clip|audio|rec|take|noise|ambient)[-_]?[0-9]*$', ''), '[-_]?[0-9]{8}[-_]?[0-9]{4,6}', '', 'g'), '[-_]?[0-9]{8}$', ''), '[-_]') AS part FROM sample_records)"""


@REGISTRY.add("SF1_filename_to_text", f"SELECT row_id, text FROM ({TEXTS_SQL})")
def sf1(spark, folder):
    return records(spark, folder).select("row_id", sf.spoken_text(F.col("path")).alias("text"))


@REGISTRY.add("SF2_snake_case", "SELECT p_partkey, regexp_replace(lower(trim(p_name || ' ' || p_brand)), '[^a-z0-9]+', '_', 'g') AS name FROM part")
def sf2(spark, folder):
    t = F.concat_ws(" ", "p_name", "p_brand")
    return table(spark, folder, "part").select("p_partkey", sf.snake_case(F.lower(t)).alias("name"))


@REGISTRY.add("SF3_speaker_patterns", f"""WITH {R}, x AS (SELECT row_id, nullif(regexp_extract(path, '([^/]*)$', 1), '') AS f, nullif(regexp_extract(path, '([^/]*)/[^/]*$', 1), '') AS d FROM r)
SELECT row_id, coalesce(nullif(regexp_extract(f, '^(hey_[a-zA-Z0-9]+)_[0-9]{{8}}', 1), ''), nullif(regexp_extract(f, '^([a-zA-Z][a-zA-Z0-9]+)_[0-9]{{8,}}', 1), ''), CASE WHEN d NOT IN ('positive', 'negative', 'hard_negative', 'background') THEN d END) AS speaker FROM x""")
def sf3(spark, folder):
    return records(spark, folder).select("row_id", sf.named_speaker(F.col("path"), ["positive", "negative", "hard_negative", "background"]).alias("speaker"))


@REGISTRY.add("SF6_risk_bucket", f"WITH {S} SELECT CASE WHEN score >= 0.82 THEN 'HIGH' WHEN score >= 0.72 THEN 'MEDIUM' ELSE 'LOW' END AS risk, count(*) AS n FROM s GROUP BY 1")
def sf6(spark, folder):
    return stream(spark, folder).groupBy(sf.risk(F.col("score")).alias("risk")).agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add("SF7_round_half_even", "SELECT event_id, round_even(event_id / 8::DOUBLE, 2) AS r FROM events")
def sf7(spark, folder):
    return table(spark, folder, "events").select("event_id", F.bround(F.col("event_id") / F.lit(8.0), 2).alias("r"))


@REGISTRY.add("SF8_sigmoid_logit", f"WITH {S} SELECT row_id, round(1 / (1 + exp(-(score * 10 - 5))), 9) AS sig, round(ln(greatest(1e-7, least(1 - 1e-7, score)) / (1 - greatest(1e-7, least(1 - 1e-7, score)))), 6) AS lgt FROM s")
def sf8(spark, folder):
    return stream(spark, folder).select("row_id", F.round(sf.sigmoid(F.col("score") * 10 - 5), 9).alias("sig"), F.round(sf.logit(F.col("score")), 6).alias("lgt"))


_LG = "ln(greatest(1e-7, least(1 - 1e-7, score)) / (1 - greatest(1e-7, least(1 - 1e-7, score))))"


@REGISTRY.add("SF9_temperature_scaling", f"WITH {S} SELECT row_id, round(1 / (1 + exp(-{_LG} / 1.7)), 9) AS p FROM s")
def sf9(spark, folder):
    return stream(spark, folder).select("row_id", F.round(sf.temperature_scaled(F.col("score"), 1.7), 9).alias("p"))


@REGISTRY.add("SF10_platt_scaling", f"WITH {S} SELECT row_id, round(1 / (1 + exp(-(1.3 * {_LG} - 0.4))), 9) AS p FROM s")
def sf10(spark, folder):
    return stream(spark, folder).select("row_id", F.round(sf.platt(F.col("score"), 1.3, -0.4), 9).alias("p"))


@REGISTRY.add("SF11_quantise", f"WITH {S} SELECT row_id, round_even(score * 255, 0)::INT AS u8, greatest(-128, least(127, round_even(score / 0.00390625 - 128, 0)::INT)) AS i8, greatest(-128, least(127, trunc(score / 0.00390625 - 128)::INT)) AS cut8 FROM s")
def sf11(spark, folder):
    s = F.col("score")
    return stream(spark, folder).select("row_id", sf.to_uint8(s).alias("u8"), sf.to_int8(s, 0.00390625, -128).alias("i8"), sf.to_int8(s, 0.00390625, -128, rounded=False).alias("cut8"))


@REGISTRY.add("SF12_quality_scores", "SELECT score_id, round(greatest(0, least(1, snr_db / 30)), 6) AS fast, round(0.5 * (dnsmos_ovrl - 1) / 4 + 0.3 * vad_conf + 0.2 * greatest(0, least(1, snr_db / 30)), 6) AS complete FROM file_scores WHERE snr_db IS NOT NULL")
def sf12(spark, folder):
    q = table(spark, folder, "file_scores").where("snr_db IS NOT NULL")
    return q.select("score_id", F.round(sf.quality_fast(F.col("snr_db")), 6).alias("fast"), F.round(sf.quality_full(F.col("dnsmos_ovrl"), F.col("vad_conf"), F.col("snr_db")), 6).alias("complete"))


@REGISTRY.add("SF13_gain", f"SELECT vec_id, {_placed_sql('list_transform(a, lambda v: v * pow(10, 6 / 20.0))')} AS placed FROM ({_WORDS})")
def sf13(spark, folder):
    return table(spark, folder, "embeddings").select("vec_id", _placed(F.transform("embedding", lambda v: v * sf.gain(F.lit(6.0)))).alias("placed"))


@REGISTRY.add("SF14_tanh_drive", f"SELECT vec_id, round(list_sum(list_transform(a, lambda v: tanh(v * 4::DOUBLE))), 4) AS total FROM ({_WORDS})")
def sf14(spark, folder):
    return table(spark, folder, "embeddings").select("vec_id", F.round(ar.total(F.transform("embedding", lambda v: F.tanh(v * 4.0))), 4).alias("total"))


@REGISTRY.add("SF15_linear_resample", "SELECT vec_id, round(list_sum(list_transform(range(32), lambda i: embedding[floor(i * 63 / 31.0)::INT + 1]::DOUBLE * (1 - (i * 63 / 31.0 - floor(i * 63 / 31.0))) + embedding[least(floor(i * 63 / 31.0)::INT + 2, 64)]::DOUBLE * (i * 63 / 31.0 - floor(i * 63 / 31.0)))), 4) AS total FROM embeddings")
def sf15(spark, folder):
    return table(spark, folder, "embeddings").select("vec_id", F.round(ar.total(ar.resampled(F.col("embedding"), 32)), 4).alias("total"))


@REGISTRY.add("SF16_stereo_to_mono", "SELECT event_id, ((event_id * 31 % 65536 - 32768) + (event_id * 17 % 65536 - 32768)) >> 1 AS mono, (event_id * 999 % 16777216 - 8388608) >> 8 AS s16, (event_id % 256 - 128) * 256 AS s8 FROM events")
def sf16(spark, folder):
    """Each event as three files of real PCM bytes: 16-bit stereo, 24-bit mono and 8-bit unsigned mono, read as 16-bit mono."""
    i = F.col("event_id")
    rows = table(spark, folder, "events").select("event_id", (i * 31 % 65536 - 32768).alias("l"), (i * 17 % 65536 - 32768).alias("r"), (i * 999 % 16777216 - 8388608).alias("w"), (i % 256).alias("b"))
    little = lambda c, n: F.concat(*[F.lpad(F.hex(F.shiftright(F.pmod(c, F.lit(1 << 8 * n)), 8 * k).bitwiseAND(F.lit(255))), 2, "0") for k in range(n)])

    def wav(data: F.Column, channels: int, bits: int) -> F.Column:
        frame = channels * bits // 8
        return F.unhex(F.concat(F.lit(audio.wav_header(frame, 16000, bits, channels).hex()), data))

    first = lambda c: F.element_at(audio.wav_ints(c), 1).cast("bigint")
    return rows.select("event_id", first(wav(F.concat(little(F.col("l"), 2), little(F.col("r"), 2)), 2, 16)).alias("mono"), first(wav(little(F.col("w"), 3), 1, 24)).alias("s16"), first(wav(little(F.col("b"), 1), 1, 8)).alias("s8"))


@REGISTRY.add("SF17_masking", f"SELECT vec_id, {_placed_sql('list_transform(embedding, lambda v, i: CASE WHEN i > vec_id % 50 AND i <= vec_id % 50 + 8 THEN 0 ELSE v END)')} AS placed FROM embeddings")
def sf17(spark, folder):
    s = (F.col("vec_id") % 50).cast("int")
    return table(spark, folder, "embeddings").select("vec_id", _placed(ar.masked(F.col("embedding"), s, s + 8)).alias("placed"))


@REGISTRY.add("SF19_tile_trim", f"SELECT vec_id, {_placed_sql('embedding || embedding[:36]')} AS placed, 100 AS size FROM embeddings")
def sf19(spark, folder):
    a = ar.tiled(ar.trimmed_zeros(ar.padded_both(F.col("embedding"), 5, 7)), 100)
    return table(spark, folder, "embeddings").select("vec_id", _placed(a).alias("placed"), F.size(a).alias("size"))


@REGISTRY.add("SF20_cosine", "SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)), 5) AS cosine FROM embeddings")
def sf20(spark, folder):
    e = table(spark, folder, "embeddings")
    first = e.where("vec_id = 0").select(F.col("embedding").alias("q")).limit(1)
    return e.join(F.broadcast(first)).select("vec_id", F.round(ar.cosine(F.col("embedding"), F.col("q")), 5).alias("cosine"))


@REGISTRY.add("SF21_hashes", "SELECT doc_id, md5(text) AS md5, sha1(text) AS sha1, sha256(text) AS sha256 FROM documents")
def sf21(spark, folder):
    return table(spark, folder, "documents").select("doc_id", F.md5("text").alias("md5"), F.sha1("text").alias("sha1"), F.sha2("text", 256).alias("sha256"))


@REGISTRY.add("SF22_pretty_print", "SELECT event_id, printf('%02d:%02d:%02d', floor(value / 3600)::INT, floor(floor(value) % 3600 / 60)::INT, (floor(value) % 60)::INT) AS duration FROM events")
def sf22(spark, folder):
    return table(spark, folder, "events").select("event_id", sf.pretty_duration(F.col("value")).alias("duration"))


@REGISTRY.add("SF24_rate_scaling", "SELECT p_partkey, 0.001 * sqrt(p_size / 32.0) AS by_root, 0.001 * (p_size / 32.0) AS by_line FROM part")
def sf24(spark, folder):
    return table(spark, folder, "part").select("p_partkey", sf.scaled_rate(0.001, F.col("p_size"), 32).alias("by_root"), sf.scaled_rate(0.001, F.col("p_size"), 32, "linear").alias("by_line"))


@REGISTRY.add("SF25_json_safe", "SELECT score_id, CASE WHEN isnan(wqi) THEN NULL ELSE wqi END AS wqi FROM file_scores")
def sf25(spark, folder):
    return table(spark, folder, "file_scores").select("score_id", sf.finite(F.col("wqi")).alias("wqi"))


@REGISTRY.add("SF26_path_parts", f"WITH {R} SELECT row_id, regexp_replace(regexp_extract(path, '([^/]*)$', 1), '^(.+)[.][^.]*$', '\\1') AS stem, regexp_extract(path, '[^/]([.][^./]*)$', 1) AS suffix, regexp_extract(path, '([^/]*)/[^/]*$', 1) AS parent FROM r")
def sf26(spark, folder):
    p = F.col("path")
    return records(spark, folder).select("row_id", sf.stem(p).alias("stem"), sf.suffix(p).alias("suffix"), sf.parent(p).alias("parent"))


_CROP = f"{draw_sql('vec_id', '27')} % greatest(len(a) - 29, 1)"


@REGISTRY.add("SF27_hash_crop", f"SELECT vec_id, 30 AS size, {_placed_sql(f'CASE WHEN len(a) <= 30 THEN list_transform(range(30 - len(a)), lambda x: 0::FLOAT) || a ELSE list_slice(a, {_CROP} + 1, {_CROP} + 30) END')} AS placed FROM ({_E})")
def sf27(spark, folder):
    a = ar.fixed_length(F.col("a"), 30, "random", draw(F.col("vec_id"), F.lit(27)))
    return _ragged(spark, folder).select("vec_id", F.size(a).alias("size"), _placed(a).alias("placed"))


@REGISTRY.add("SF28_iso_timestamps", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM events")
def sf28(spark, folder):
    return table(spark, folder, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"))


@REGISTRY.add("SF30_frame_count", "SELECT row_id, greatest(1, ceil((floor(duration_ms * 16) - 480) / 160.0)::INT + 1) AS frames FROM sample_records WHERE duration_ms IS NOT NULL")
def sf30(spark, folder):
    return records(spark, folder).where("ms IS NOT NULL").select("row_id", sf.frame_count(F.floor(F.col("ms") * 16), 480, 160).alias("frames"))


@REGISTRY.add("SF31_two_sided_pad", f"SELECT vec_id, 76 AS size, {_placed_sql('[0, 0, 0, 0, 0]::FLOAT[] || embedding || [0, 0, 0, 0, 0, 0, 0]::FLOAT[]')} AS placed FROM embeddings")
def sf31(spark, folder):
    a = ar.padded_both(F.col("embedding"), 5, 7)
    return table(spark, folder, "embeddings").select("vec_id", F.size(a).alias("size"), _placed(a).alias("placed"))


@REGISTRY.add("SF32_dequantise", "SELECT event_id, 0.00390625::DOUBLE * (event_id % 256 - 128 + 128) AS own, (1 / 255.0) * (event_id % 256) AS fixed FROM events")
def sf32(spark, folder):
    q = F.col("event_id") % 256
    return table(spark, folder, "events").select("event_id", sf.dequantised(q - 128, 0.00390625, -128).alias("own"), sf.dequantised(q, 1 / 255.0, 0).alias("fixed"))


@REGISTRY.add("SF33_parse_lists", "SELECT p_partkey, p_size + (p_size + 1) AS total, 2 AS n FROM part")
def sf33(spark, folder):
    text = F.when(F.col("p_partkey") % 2 == 0, F.format_string("%d,%d", "p_size", F.col("p_size") + 1)).otherwise(F.format_string("[%d],[%d]", "p_size", F.col("p_size") + 1))
    a = sf.parse_ints(text)
    return table(spark, folder, "part").select("p_partkey", F.aggregate(a, F.lit(0), lambda x, v: x + v).alias("total"), F.size(a).alias("n"))


@REGISTRY.add("SF34_receptive_field", "SELECT p_partkey, 5 + (1 + p_size % 2) * (greatest(5, p_size % 11 + 1) - 1) * (p_size % 3 + 1) + 3 * (greatest(7, p_size % 5 + 1) - 1) AS field FROM part")
def sf34(spark, folder):
    """Of a first kernel of 5 and two blocks: one of kernels 5 and by part, repeats and stride by part, one of kernels 7 and by part, repeated 3 times."""
    n = F.col("p_size")
    blocks = [(1 + n % 2, F.array(F.lit(5), (n % 11 + 1).cast("int")), n % 3 + 1), (F.lit(3), F.array(F.lit(7), (n % 5 + 1).cast("int")), F.lit(1))]
    return table(spark, folder, "part").select("p_partkey", sf.receptive_field(5, blocks).alias("field"))


# ---- curation composites

@REGISTRY.add("QG1_percentile_gate", """WITH q AS (SELECT score_id, dir_label, wqi, coalesce(discard, false) AS d, wqi IS NOT NULL AND NOT coalesce(isnan(wqi), false) AS ok FROM file_scores), c AS (SELECT dir_label, quantile_cont(wqi, 0.05) AS cutoff FROM q WHERE ok AND NOT d GROUP BY dir_label)
SELECT score_id, CASE WHEN d THEN 'already discarded' WHEN ok AND wqi <= cutoff THEN 'low percentile' WHEN ok AND wqi < 0.3 THEN 'below minimum' END AS gate FROM q LEFT JOIN c ON q.dir_label IS NOT DISTINCT FROM c.dir_label""")
def qg1(spark, folder):
    q = table(spark, folder, "file_scores").select("score_id", "dir_label", "wqi", "discard")
    return cu.percentile_gate(q, "dir_label", "wqi", "discard", 0.05, 0.3).select("score_id", "gate")


@REGISTRY.add("QG3_mine_from_logs", f"WITH {P}, e AS (SELECT f.file_path AS file_path, f.score AS score, run_id, try_cast(epoch AS INT) AS epoch, log_id FROM p WHERE regexp_matches(epoch, '^[0-9]+$') AND try_cast(epoch AS INT) >= 3 AND f.file_path IS NOT NULL), k AS (SELECT *, row_number() OVER (PARTITION BY run_id, epoch ORDER BY score DESC, file_path, log_id) AS r FROM e) SELECT file_path AS src, 'mined/' || regexp_extract(file_path, '([^/]*)$', 1) AS dst FROM k WHERE r <= 3 GROUP BY file_path")
def qg3(spark, folder):
    e = predictions(spark, folder).where(F.col("epoch").rlike("^[0-9]+$") & (F.col("epoch").try_cast("int") >= 3) & F.col("file_path").isNotNull()).withColumn("epoch", F.col("epoch").try_cast("int"))
    top = cu.top_per_group(e, ["run_id", "epoch"], 3, F.desc("score"), F.col("file_path"), F.col("log_id"))
    return top.select("file_path").distinct().select(F.col("file_path").alias("src"), F.concat(F.lit("mined/"), F.regexp_extract("file_path", r"([^/]*)$", 1)).alias("dst"))


@REGISTRY.add("QG4_consolidate_logs", f"WITH {P} SELECT coalesce(f.file_path, 'unknown_file_index_' || f.idx) AS file, count(*) AS n, count(DISTINCT epoch) AS n_epochs, max(f.score) AS best FROM p GROUP BY 1")
def qg4(spark, folder):
    file = F.coalesce("file_path", F.concat(F.lit("unknown_file_index_"), F.col("idx").cast("string")))
    return predictions(spark, folder).groupBy(file.alias("file")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("epoch").alias("n_epochs"), F.max("score").alias("best"))


@REGISTRY.add("QG5_top_false_positives", f"WITH {S} SELECT row_id, score FROM s WHERE y = 0 AND score >= 0.5 ORDER BY score DESC, row_id LIMIT (SELECT greatest(1, floor(count(*) * 0.05))::BIGINT FROM s)")
def qg5(spark, folder):
    return cu.top_share(stream(spark, folder), (F.col("y") == 0) & (F.col("score") >= 0.5), 0.05, F.desc("score"), F.col("row_id")).select("row_id", "score")


@REGISTRY.add("QG6_promotion_gate", "WITH m AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 7 <> 0 THEN p_size / 10.0 END AS fah, CASE WHEN p_partkey % 5 <> 0 THEN (p_partkey % 100) / 100.0 END AS recall FROM part) SELECT id, coalesce(fah <= 2, true) AND coalesce(recall >= 0.5, true) AS passes, coalesce(fah <= 2, false) AND coalesce(recall >= 0.5, false) AS passes_strict FROM m")
def qg6(spark, folder):
    k = F.col("p_partkey")
    fah, recall = F.when(k % 7 != 0, F.col("p_size") / 10.0), F.when(k % 5 != 0, (k % 100) / 100.0)
    gate = lambda missing: F.coalesce(fah <= 2, F.lit(missing)) & F.coalesce(recall >= 0.5, F.lit(missing))
    return table(spark, folder, "part").select(k.alias("id"), gate(True).alias("passes"), gate(False).alias("passes_strict"))


@REGISTRY.add("QG7_threshold_precedence", "SELECT log_id, coalesce(CASE WHEN fp_threshold > 0.7 AND fp_threshold <= 1 THEN fp_threshold END, CASE WHEN total_val_samples > 2000 THEN 0.6 END, 0.5)::DOUBLE AS threshold FROM prediction_logs")
def qg7(spark, folder):
    t = F.col("fp_threshold")
    return table(spark, folder, "prediction_logs").select("log_id", F.coalesce(F.when((t > 0.7) & (t <= 1), t), F.when(F.col("total_val_samples") > 2000, F.lit(0.6)), F.lit(0.5)).alias("threshold"))


@REGISTRY.add("QG11_sanity_warnings", f"WITH {S}, m AS (SELECT clip, avg(score) AS a, stddev_pop(score) AS d, count(*) FILTER (score > 0.5) AS k FROM s GROUP BY clip) SELECT clip, CASE WHEN d < 0.15 THEN 'scores hardly vary' WHEN k = 0 THEN 'never fires' WHEN a > 0.45 THEN 'fires often' ELSE 'ok' END AS warning FROM m")
def qg11(spark, folder):
    m = stream(spark, folder).groupBy("clip").agg(F.avg("score").alias("a"), F.stddev_pop("score").alias("d"), F.count_if(F.col("score") > 0.5).alias("k"))
    return m.select("clip", F.when(F.col("d") < 0.15, "scores hardly vary").when(F.col("k") == 0, "never fires").when(F.col("a") > 0.45, "fires often").otherwise("ok").alias("warning"))


@REGISTRY.add("QG2_trim_split_background", f"""WITH {R} SELECT row_id, CASE WHEN label = 'background' THEN 'split' WHEN ms > 2000 THEN 'trim' WHEN ms < 300 THEN 'discard' WHEN ms IS NULL THEN 'skip' ELSE 'keep' END AS action,
CASE WHEN label = 'background' THEN floor(ms / 1000)::INT WHEN ms < 300 OR ms IS NULL THEN 0 ELSE 1 END AS n_out, CASE WHEN label <> 'background' AND ms > 2000 THEN 2000.0 ELSE ms END AS new_ms FROM r WHERE label IS NOT NULL""")
def qg2(spark, folder):
    ms, back = F.col("ms"), F.col("label") == "background"
    r = records(spark, folder).where("label IS NOT NULL")
    return r.select("row_id", F.when(back, "split").when(ms > 2000, "trim").when(ms < 300, "discard").when(ms.isNull(), "skip").otherwise("keep").alias("action"), F.when(back, F.floor(ms / 1000).cast("int")).when((ms < 300) | ms.isNull(), 0).otherwise(1).alias("n_out"), F.when(~back & (ms > 2000), 2000.0).otherwise(ms).alias("new_ms"))


@REGISTRY.add("QG13_tuning_load", f"SELECT vec_id, label % 3 = 1 AS positive, CASE WHEN label % 3 = 2 THEN 2.0 ELSE 1.0 END AS weight, 40 AS size, round(list_sum(list_slice(a, 1, 40)), 4) AS total FROM (SELECT vec_id, label, list_slice(embedding, 1, 20 + vec_id % 60) AS a FROM embeddings) WHERE len(a) % 4 = 0")
def qg13(spark, folder):
    e = table(spark, folder, "embeddings").select("vec_id", "label", F.slice("embedding", F.lit(1), (20 + F.col("vec_id") % 60).cast("int")).alias("a")).where(F.size("a") % 4 == 0)
    a = ar.pad_or_cut(F.col("a"), 40)
    return e.select("vec_id", (F.col("label") % 3 == 1).alias("positive"), F.when(F.col("label") % 3 == 2, 2.0).otherwise(1.0).alias("weight"), F.size(a).alias("size"), F.round(ar.total(a), 4).alias("total"))


# ---- lookups, set operations, top-k

@REGISTRY.add("JN1_dimension_lookup", """WITH x AS (SELECT path, min(speaker_id) AS v FROM speaker_map GROUP BY path), b AS (SELECT regexp_extract(path, '([^/]*)$', 1) AS f, min(speaker_id) AS v FROM speaker_map GROUP BY 1 HAVING count(DISTINCT path) = 1)
SELECT s.row_id, coalesce(x.v, b.v, nullif(regexp_extract(s.path, '/(spk_[0-9]{9})/', 1), '')) AS speaker_id FROM sample_records s LEFT JOIN x ON s.path = x.path LEFT JOIN b ON regexp_extract(s.path, '([^/]*)$', 1) = b.f""")
def jn1(spark, folder):
    r = table(spark, folder, "sample_records").select("row_id", "path")
    folder_name = F.nullif(F.regexp_extract("path", "/(spk_[0-9]{9})/", 1), F.lit(""))
    return cu.lookup(r, F.col("path"), table(spark, folder, "speaker_map"), "path", "speaker_id", [folder_name]).select("row_id", "speaker_id")


@REGISTRY.add("JN2_zip_join", "SELECT vec_id, e.label, v.event_type FROM embeddings e JOIN events v ON e.vec_id = v.event_id")
def jn2(spark, folder):
    e, v = table(spark, folder, "embeddings").select("vec_id", "label"), table(spark, folder, "events").select("event_id", "event_type")
    return e.join(v, F.col("vec_id") == F.col("event_id")).select("vec_id", "label", "event_type")


@REGISTRY.add("JN3_split_overlap", "SELECT md5(text) AS key, count(DISTINCT source) AS n_splits, count(*) AS n_rows FROM documents WHERE text IS NOT NULL AND source IS NOT NULL GROUP BY 1 HAVING count(DISTINCT source) > 1")
def jn3(spark, folder):
    return cu.overlap(table(spark, folder, "documents").select("text", "source"), F.md5("text"), "source")


@REGISTRY.add("JN4_missing_keys", "SELECT DISTINCT f.path FROM file_scores f WHERE NOT EXISTS (SELECT 1 FROM sample_records s WHERE s.path = f.path)")
def jn4(spark, folder):
    return table(spark, folder, "file_scores").select("path").distinct().join(table(spark, folder, "sample_records").select("path"), "path", "left_anti")


@REGISTRY.add("JN7_threshold_grid", f"WITH {S} SELECT k::INT AS k, count(*) FILTER (score > k * 0.1) AS n FROM s, range(10) r(k) GROUP BY k")
def jn7(spark, folder):
    from earshot.operators import scores as sc

    return sc.sweep(stream(spark, folder), [k * 0.1 for k in range(10)]).select("k", (F.col("tp") + F.col("fp")).alias("n"))


@REGISTRY.add("JN8_variants_best", "WITH v(variant) AS (VALUES ('ring'), ('widget'), ('bolt'), ('gear')), x AS (SELECT p_partkey, variant, round(1 - levenshtein(p_name, variant) / greatest(length(p_name), length(variant))::DOUBLE, 4) AS s FROM part, v) SELECT p_partkey, max(s) AS score, CASE WHEN max(s) > 0 THEN min(variant) FILTER (s = m) ELSE '' END AS variant FROM (SELECT *, max(s) OVER (PARTITION BY p_partkey) AS m FROM x) GROUP BY p_partkey")
def jn8(spark, folder):
    """A fixed list of variants is part of the expression: no join."""
    n = F.col("p_name")
    each = [F.struct((-F.bround(1 - F.levenshtein(n, F.lit(v)) / F.greatest(F.length(n), F.lit(len(v))), 4)).alias("s"), F.lit(v).alias("v")) for v in ("ring", "widget", "bolt", "gear")]
    best = F.array_min(F.array(*each))
    return table(spark, folder, "part").select("p_partkey", (-best["s"]).alias("score"), F.when(best["s"] < 0, best["v"]).otherwise("").alias("variant"))


@REGISTRY.add("JN9_hash_pairing", f"WITH n AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS i FROM embeddings) SELECT event_id, vec_id FROM events JOIN n ON n.i = {draw_sql('event_id', '9')} % (SELECT count(*) FROM embeddings)")
def jn9(spark, folder):
    """Each event with one of all vectors, drawn by a hash."""
    return paired(table(spark, folder, "events").select("event_id"), "event_id", table(spark, folder, "embeddings").select("vec_id"), "vec_id", seed=9)


@REGISTRY.add("JN10_compare_models", f"""WITH {S}, m AS (SELECT clip % 2 AS model, avg(score) AS mean, max(score) AS top, avg(w) AS fah FROM s GROUP BY 1), a AS (SELECT unnest(['mean', 'top', 'fah']) AS metric, unnest([mean, top, fah]) AS v FROM m WHERE model = 0), b AS (SELECT unnest(['mean', 'top', 'fah']) AS metric, unnest([mean, top, fah]) AS v FROM m WHERE model = 1)
SELECT metric, round(a.v, 6) AS a, round(b.v, 6) AS b, round(b.v - a.v, 6) AS delta, CASE WHEN metric = 'fah' THEN b.v < a.v ELSE b.v > a.v END AS better FROM a FULL JOIN b USING (metric)""")
def jn10(spark, folder):
    m = stream(spark, folder).groupBy((F.col("clip") % 2).alias("model")).agg(F.avg("score").alias("mean"), F.max("score").alias("top"), F.avg("w").alias("fah"))
    long = m.unpivot("model", ["mean", "top", "fah"], "metric", "v")
    side = lambda i, n: long.where(F.col("model") == i).select("metric", F.col("v").alias(n))
    j = side(0, "a").join(side(1, "b"), "metric", "full")
    return j.select("metric", F.round("a", 6).alias("a"), F.round("b", 6).alias("b"), F.round(F.col("b") - F.col("a"), 6).alias("delta"), F.when(F.col("metric") == "fah", F.col("b") < F.col("a")).otherwise(F.col("b") > F.col("a")).alias("better"))


@REGISTRY.add("JN11_keyed_merge", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_size + 1 ELSE p_size END AS a, p_size * 2 AS b FROM part")
def jn11(spark, folder):
    base = F.create_map(F.lit("a"), F.col("p_size"), F.lit("b"), F.col("p_size") * 2)
    over = F.when(F.col("p_partkey") % 2 == 0, F.create_map(F.lit("a"), F.col("p_size") + 1)).otherwise(F.create_map().cast("map<string,int>"))
    merged = F.map_zip_with(base, over, lambda k, x, y: F.coalesce(y, x))
    return table(spark, folder, "part").select("p_partkey", merged["a"].alias("a"), merged["b"].alias("b"))


@REGISTRY.add("TK1_bounded_top_k", f"WITH {S} SELECT row_id, score FROM s WHERE y = 0 ORDER BY score DESC, row_id LIMIT 50")
def tk1(spark, folder):
    return stream(spark, folder).where("y = 0").orderBy(F.desc("score"), "row_id").limit(50).select("row_id", "score")


@REGISTRY.add("TK2_top_k_per_group", f"WITH {S} SELECT row_id, clip FROM (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY score DESC, row_id) AS r FROM s) WHERE r <= 3")
def tk2(spark, folder):
    return cu.top_per_group(stream(spark, folder), ["clip"], 3, F.desc("score"), F.col("row_id")).select("row_id", "clip")


@REGISTRY.add("TK3_top_percent", f"WITH {S} SELECT row_id FROM s WHERE y = 0 AND score >= 0.5 ORDER BY score DESC, row_id LIMIT (SELECT greatest(1, floor(count(*) * 0.02))::BIGINT FROM s)")
def tk3(spark, folder):
    return cu.top_share(stream(spark, folder), (F.col("y") == 0) & (F.col("score") >= 0.5), 0.02, F.desc("score"), F.col("row_id")).select("row_id")


@REGISTRY.add("TK4_ranked_names", f"WITH {P}, c AS (SELECT f.file_path AS p, count(*) AS n FROM p WHERE f.file_path IS NOT NULL GROUP BY 1), k AS (SELECT *, row_number() OVER (ORDER BY n DESC, p) AS r FROM c) SELECT lpad(r::VARCHAR, 3, '0') || '_' || regexp_extract(p, '([^/]*)$', 1) AS name, n FROM k WHERE r <= 10")
def tk4(spark, folder):
    top = predictions(spark, folder).where("file_path IS NOT NULL").groupBy("file_path").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "file_path").limit(10)
    r = F.row_number().over(Window.orderBy(F.desc("n"), "file_path"))  # ten rows
    return top.select(F.concat(F.lpad(r.cast("string"), 3, "0"), F.lit("_"), F.regexp_extract("file_path", r"([^/]*)$", 1)).alias("name"), "n")


@REGISTRY.add("TK5_sorted_desc", f"WITH {S} SELECT row_id, score FROM s WHERE score > 0.95 ORDER BY score DESC")
def tk5(spark, folder):
    return stream(spark, folder).where("score > 0.95").select("row_id", "score").orderBy(F.desc("score"))


@REGISTRY.add("TK6_preview", "SELECT doc_id FROM documents ORDER BY doc_id LIMIT 5")
def tk6(spark, folder):
    return table(spark, folder, "documents").select("doc_id").orderBy("doc_id").limit(5)


@REGISTRY.add("TK10_latest", "SELECT run_id, arg_max(log_id, logged_at) AS log_id FROM (SELECT * FROM prediction_logs WHERE logged_at IS NOT NULL ORDER BY log_id) GROUP BY run_id HAVING count(*) = count(DISTINCT logged_at)")
def tk10(spark, folder):
    g = table(spark, folder, "prediction_logs").where("logged_at IS NOT NULL").groupBy("run_id").agg(F.max_by("log_id", F.struct("logged_at", "log_id")).alias("log_id"), F.count(F.lit(1)).alias("a"), F.count_distinct("logged_at").alias("b"))
    return g.where("a = b").select("run_id", "log_id")


@REGISTRY.add("TK11_decimate", f"WITH {S}, u AS (SELECT score, row_number() OVER (ORDER BY score) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT score FROM s)) SELECT score FROM u WHERE i IN (SELECT floor(j * (n - 1) / 99.0)::BIGINT FROM range(100) r(j))")
def tk11(spark, folder):
    from earshot.operators import scores as sc

    return sc.decimate(stream(spark, folder).select("score").distinct(), "score", 100)


@REGISTRY.add("SET1_dedupe_keep_first", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS r, text FROM documents) WHERE r = 1 OR text IS NULL")
def set1(spark, folder):
    d = table(spark, folder, "documents").select("doc_id", F.md5("text").alias("h"))
    return cu.keep_first(d, F.col("h"), F.col("doc_id")).select("doc_id")


@REGISTRY.add("SET2_union_intersect_except", "SELECT 'union' AS op, count(*) AS n FROM (SELECT o_custkey FROM orders UNION SELECT c_custkey FROM customer) UNION ALL SELECT 'intersect', count(*) FROM (SELECT o_custkey FROM orders INTERSECT SELECT c_custkey FROM customer) UNION ALL SELECT 'except', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)")
def set2(spark, folder):
    a, b = table(spark, folder, "orders").select(F.col("o_custkey").alias("k")), table(spark, folder, "customer").select(F.col("c_custkey").alias("k"))
    n = lambda name, d: d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("op"), "n")
    return n("union", a.union(b).distinct()).unionByName(n("intersect", a.intersect(b))).unionByName(n("except", b.subtract(a)))


@REGISTRY.add("SC18_move_plan", "SELECT path AS src, 'discarded/' || coalesce(dir_label, 'unknown') || '/' || regexp_extract(path, '([^/]*)$', 1) AS dst FROM file_scores WHERE discard OR error <> ''")
def sc18(spark, folder):
    q = table(spark, folder, "file_scores").where(F.col("discard") | (F.col("error") != ""))
    return cu.move_plan(q, F.col("path"), "discarded", F.coalesce("dir_label", F.lit("unknown")))


@REGISTRY.add("SC18_undo_plan", "SELECT 'discarded/' || coalesce(dir_label, 'unknown') || '/' || regexp_extract(path, '([^/]*)$', 1) AS src, path AS dst FROM file_scores WHERE discard OR error <> ''")
def sc18_undo(spark, folder):
    return cu.undo_plan(sc18(spark, folder))


@REGISTRY.add("SC21_garbage_reasons", "SELECT CASE WHEN error <> '' THEN 'unreadable' WHEN isnan(wqi) THEN 'nan' WHEN wqi IS NULL THEN 'empty' WHEN wqi NOT BETWEEN 0 AND 1 THEN 'out of range' ELSE 'ok' END AS reason, count(*) AS n FROM file_scores GROUP BY 1")
def sc21(spark, folder):
    reason = F.when(F.col("error") != "", "unreadable").when(F.isnan("wqi"), "nan").when(F.col("wqi").isNull(), "empty").when(~F.col("wqi").between(0, 1), "out of range").otherwise("ok")
    return table(spark, folder, "file_scores").groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@REGISTRY.add("SC22_corpus_counters", f"WITH {R} SELECT label, count(*) AS files, round(sum(ms::DECIMAL(18, 3))::DOUBLE / 1000, 3) AS seconds, round(sum(ms::DECIMAL(18, 3))::DOUBLE / count(ms) / 1000, 6) AS mean_s FROM r GROUP BY ROLLUP (label)")
def sc22(spark, folder):
    return records(spark, folder).rollup("label").agg(F.count(F.lit(1)).alias("files"), F.round(exact_sum("ms") / 1000, 3).alias("seconds"), F.round(exact_sum("ms") / F.count("ms") / 1000, 6).alias("mean_s"))


@REGISTRY.add("SC8_batch_lookup", "SELECT i.pos::INT AS pos, e.vec_id, e.label FROM (SELECT unnest([7, 3, 99, 3, 250]) AS id, unnest(range(5)) AS pos) i JOIN embeddings e ON e.vec_id = i.id")
def sc8(spark, folder):
    ids = spark.createDataFrame([(i, k) for k, i in enumerate([7, 3, 99, 3, 250])], "id bigint, pos int")
    return table(spark, folder, "embeddings").select("vec_id", "label").join(F.broadcast(ids), F.col("vec_id") == F.col("id")).select("pos", "vec_id", "label")


def fingerprint(df: DataFrame, line: F.Column) -> DataFrame:
    """(fingerprint, n): the hash of the number of lines and of the sums of four parts of their hashes. Sums don't ask for an order, so lines are added up map-side."""
    h = df.select(F.sha2(line, 256).alias("h"))
    part = lambda i: F.sum(F.conv(F.substring("h", 16 * i + 1, 15), 16, 10).cast("decimal(38,0)")).cast("string")
    return h.agg(F.count(F.lit(1)).alias("n"), *[part(i).alias(f"p{i}") for i in range(4)]).select(F.sha2(F.concat_ws(":", F.col("n").cast("string"), "p0", "p1", "p2", "p3"), 256).alias("fingerprint"), "n")


@REGISTRY.add("SC11_content_fingerprint", """WITH h AS (SELECT sha256(path || '|' || score_id) AS h FROM file_scores), p AS (SELECT count(*) AS n, sum(('0x' || substr(h, 1, 15))::HUGEINT)::VARCHAR AS a, sum(('0x' || substr(h, 17, 15))::HUGEINT)::VARCHAR AS b,
sum(('0x' || substr(h, 33, 15))::HUGEINT)::VARCHAR AS c, sum(('0x' || substr(h, 49, 15))::HUGEINT)::VARCHAR AS d FROM h) SELECT sha256(n || ':' || a || ':' || b || ':' || c || ':' || d) AS fingerprint, n FROM p""")
def sc11(spark, folder):
    return fingerprint(table(spark, folder, "file_scores"), F.concat_ws("|", "path", "score_id"))


@REGISTRY.add("SC12_cache_keys", "SELECT score_id, md5(path || ':' || coalesce(epoch(scored_at)::BIGINT, 0)) AS key FROM file_scores")
def sc12(spark, folder):
    return table(spark, folder, "file_scores").select("score_id", F.md5(F.concat_ws(":", "path", F.coalesce(F.unix_seconds(F.col("scored_at").cast("timestamp")), F.lit(0)).cast("string"))).alias("key"))


@REGISTRY.add("SC14_nested_log_load", f"WITH {P} SELECT run_id, epoch, count(*) AS n, round(avg(f.score), 6) AS mean FROM p GROUP BY run_id, epoch")
def sc14(spark, folder):
    return predictions(spark, folder).groupBy("run_id", "epoch").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 6).alias("mean"))


@REGISTRY.add("SC16_json_report", "SELECT event_id, (props::JSON->>'k')::INT AS k FROM events")
def sc16(spark, folder):
    report = F.to_json(F.struct(F.from_json("props", "k int")["k"].alias("k"), sf.finite(F.lit(float("nan"))).alias("bad")))
    return table(spark, folder, "events").select("event_id", F.from_json(report, "k int")["k"].alias("k"))


@REGISTRY.add("SC24_run_fingerprint", "SELECT p_partkey, substr(sha256('{\"name\":\"' || p_name || '\",\"size\":' || p_size || '}'), 1, 12) AS run FROM part")
def sc24(spark, folder):
    return table(spark, folder, "part").select("p_partkey", F.substring(F.sha2(F.to_json(F.struct(F.col("p_name").alias("name"), F.col("p_size").alias("size"))), 256), 1, 12).alias("run"))


@REGISTRY.add("SC28_mapping_lists", f"WITH {R} SELECT label, count(*) AS n, min(path) AS first, max(path) AS last FROM r WHERE label IN ('negative', 'hard_negative') GROUP BY label")
def sc28(spark, folder):
    return records(spark, folder).where(F.col("label").isin("negative", "hard_negative")).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("first"), F.max("path").alias("last"))
