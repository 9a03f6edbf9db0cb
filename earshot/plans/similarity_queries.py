"""Queries of vector similarity and clusters over embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from earshot.functions import arrays as ar
from earshot.operators import similarity as sm
from earshot.operators.curation import top_per_group
from earshot.operators.graph import components
from earshot.plans.registry import Registry
from earshot.sources.tables import table

REGISTRY = Registry()

_V = "v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings)"
_K = {"vec_id": "vec_id", "vector": "embedding"}


@REGISTRY.add("JN5_best_match", f"WITH {_V} SELECT a.vec_id AS query_id, arg_max(b.vec_id, list_cosine_similarity(a.e, b.e)) AS match_id, round(max(list_cosine_similarity(a.e, b.e)), 5) AS similarity FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0 GROUP BY a.vec_id HAVING max(list_cosine_similarity(a.e, b.e)) >= 0.3")
def jn5(spark, folder):
    """Every row whose id is divisible by 100 against all rows."""
    e = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return sm.best_match(e.where("vec_id % 100 = 0"), e, threshold=0.3, **_K).withColumn("similarity", F.round("similarity", 5))


@REGISTRY.add("JN6_similarity_self_join", f"WITH {_V}, p AS (SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.e, b.e) AS s FROM v a JOIN v b ON a.vec_id < b.vec_id), l AS (SELECT unnest([a, b]) AS c FROM p WHERE s >= 0.4) SELECT vec_id AS id, count(c) AS n_links FROM v LEFT JOIN l ON v.vec_id = l.c GROUP BY vec_id")
def jn6(spark, folder):
    return sm.similarity_classes(table(spark, folder, "embeddings"), threshold=0.4, **_K).select("id", "n_links")


@REGISTRY.add("CL5_transitive_groups", f"""WITH RECURSIVE {_V}, p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.4), r AS (SELECT vec_id AS id, vec_id AS o FROM v UNION SELECT r.id, p.b FROM r JOIN p ON r.o = p.a) SELECT id, min(o) AS grp FROM r GROUP BY id""")
def cl5(spark, folder):
    return sm.similarity_classes(table(spark, folder, "embeddings"), threshold=0.4, **_K).select("id", F.col("group").alias("grp"))


@REGISTRY.add("CL5_link_components", "WITH RECURSIVE e AS (SELECT speaker_a AS a, speaker_b AS b FROM speaker_links UNION SELECT speaker_b, speaker_a FROM speaker_links), r AS (SELECT a AS id, a AS o FROM e UNION SELECT r.id, e.b FROM r JOIN e ON r.o = e.a) SELECT id, min(o) AS component FROM r GROUP BY id")
def links(spark, folder):
    found = components(table(spark, folder, "speaker_links"), "speaker_a", "speaker_b")
    # The least id of a component is in no pair of its own.
    return found.unionByName(found.select(F.col("component").alias("id"), "component")).distinct()


@REGISTRY.add("CL1_agglomerative")
def cl1(spark, folder):
    """One agglomeration over all rows."""
    return sm.cluster_blocks(table(spark, folder, "embeddings").withColumn("cell", F.lit(0)), block="cell", k=4, **_K)


@REGISTRY.add("CL2_density_clusters")
def cl2(spark, folder):
    return sm.density_clusters(table(spark, folder, "embeddings"), **_K).select("id", "cluster")


@REGISTRY.add("CL3_adaptive_selection")
def cl3(spark, folder):
    return sm.adaptive_clusters(table(spark, folder, "embeddings"), similarity=0.3, **_K)


@REGISTRY.add("CL4_two_stage")
def cl4(spark, folder):
    return sm.two_stage_clusters(table(spark, folder, "embeddings"), similarity=0.3, **_K)


@REGISTRY.add("CL6_leakage_audit", f"WITH {_V}, m AS (SELECT a.vec_id, max(list_cosine_similarity(a.e, b.e)) AS s FROM v a JOIN v b ON a.vec_id <> b.vec_id AND b.vec_id % 100 <> 0 WHERE a.vec_id % 100 = 0 GROUP BY 1) SELECT count(*) AS n_test, count(*) FILTER (s >= 0.35) AS n_leaking, round(max(s), 5) AS worst FROM m")
def cl6(spark, folder):
    e = table(spark, folder, "embeddings").select("vec_id", "embedding")
    m = sm.best_match(e.where("vec_id % 100 = 0"), e.where("vec_id % 100 <> 0"), threshold=-1.0, **_K)
    return m.agg(F.count(F.lit(1)).alias("n_test"), F.count_if(F.col("similarity") >= 0.35).alias("n_leaking"), F.round(F.max("similarity"), 5).alias("worst"))


@REGISTRY.add("CL7_exact_dedupe", "SELECT md5(text) AS h, min(doc_id) AS keep, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def cl7(spark, folder):
    d = table(spark, folder, "documents").where("text IS NOT NULL").select("doc_id", F.md5("text").alias("h"))
    return d.groupBy("h").agg(F.min("doc_id").alias("keep"), F.count(F.lit(1)).alias("copies")).where("copies > 1")


@REGISTRY.add("CL8_embedding_extraction", """WITH w AS (SELECT doc_id, n_row, ('0x' || left(md5(unnest(regexp_extract_all(lower(text), '[a-z0-9]+'))), 8))::BIGINT AS h FROM (SELECT doc_id, text, row_number() OVER () AS n_row FROM documents)),
x AS (SELECT n_row, doc_id, h % 64 AS i, sum(CASE WHEN (h >> 16) & 1 = 1 THEN 1 ELSE -1 END) AS x FROM w GROUP BY ALL), n AS (SELECT *, sqrt(sum(x * x) OVER (PARTITION BY n_row)) AS norm FROM x), v AS (SELECT n_row, doc_id, sum(CASE WHEN norm = 0 THEN 0 ELSE (x / norm)::FLOAT::DOUBLE * (i + 1) END) AS placed FROM n GROUP BY ALL)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN round(coalesce(placed, 0), 3) + 0.0 END AS placed FROM documents d LEFT JOIN v USING (doc_id)""")
def cl8(spark, folder):
    """Vectors of whole texts by a model run over batches, by the sum of their values times their places."""
    v = sm.vectors(table(spark, folder, "documents"), keep=["doc_id"], payload="text", model=sm.hashed_words(), width=64)
    return v.select("doc_id", (F.round(ar.placed(F.col("vector")), 3) + 0.0).alias("placed"))


@REGISTRY.add("TK7_closest_to_centroid", """WITH x AS (SELECT label, vec_id, unnest(embedding) AS x, unnest(range(64)) AS i FROM embeddings), c AS (SELECT label, i, avg(x::DOUBLE) AS m FROM x GROUP BY label, i), d AS (SELECT x.label, x.vec_id, round(sqrt(sum((x.x - c.m) * (x.x - c.m))), 6) AS d FROM x JOIN c USING (label, i) GROUP BY 1, 2)
SELECT label AS grp, vec_id AS id FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY d, vec_id) AS r FROM d) WHERE r <= 3""")
def tk7(spark, folder):
    return sm.closest_to_centroid(table(spark, folder, "embeddings"), group="label", k=3, **_K).select(F.col("group").alias("grp"), "id")


@REGISTRY.add("TK8_farthest_points", f"""WITH {_V}, a AS (SELECT label, min(vec_id) AS id FROM v GROUP BY label), ae AS (SELECT a.label, a.id, v.e FROM a JOIN v ON v.vec_id = a.id),
d1 AS (SELECT v.label, v.vec_id, v.e, list_distance(v.e, ae.e) AS d FROM v JOIN ae USING (label) WHERE v.vec_id <> ae.id), b AS (SELECT label, first(vec_id ORDER BY d DESC, vec_id) AS id FROM d1 GROUP BY label), be AS (SELECT b.label, b.id, v.e FROM b JOIN v ON v.vec_id = b.id),
d2 AS (SELECT d1.label, d1.vec_id, least(d1.d, list_distance(d1.e, be.e)) AS d FROM d1 JOIN be USING (label) WHERE d1.vec_id <> be.id), c AS (SELECT label, first(vec_id ORDER BY d DESC, vec_id) AS id FROM d2 GROUP BY label)
SELECT label AS grp, id, 0 AS rank FROM a UNION ALL SELECT label, id, 1 FROM b UNION ALL SELECT label, id, 2 FROM c""")
def tk8(spark, folder):
    return sm.farthest_points(table(spark, folder, "embeddings"), group="label", k=3, **_K).withColumnRenamed("group", "grp")


@REGISTRY.add("TK9_random_k_per_cluster", "SELECT vec_id, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(vec_id::VARCHAR), vec_id) AS r FROM embeddings) WHERE r <= 5")
def tk9(spark, folder):
    e = table(spark, folder, "embeddings").select("vec_id", "label")
    return top_per_group(e, ["label"], 5, F.md5(F.col("vec_id").cast("string")), F.col("vec_id"))
