from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from earshot.operators import curation as cu, frontier as fr, similarity as sm, splitting as sp
from earshot.operators.graph import components
from earshot.sources import audio, store


def test_percentile_gate(spark):
    r = random.Random(1)
    data = [(i, r.choice(["a", "b", None]), r.choice([None, float("nan"), round(r.random(), 2)]), r.choice([True, False, None])) for i in range(400)] + [(999, "gone", 0.5, True)]
    df = spark.createDataFrame(data, "id int, g string, v double, d boolean")
    got = {x.id: x.gate for x in cu.percentile_gate(df, "g", "v", "d", 0.05, 0.2).collect()}
    for i, g, v, d in data:
        ok = [x[2] for x in data if x[1] == g and not x[3] and x[2] is not None and x[2] == x[2]]
        number = v is not None and v == v
        want = "already discarded" if d else "low percentile" if number and ok and v <= np.percentile(ok, 5) else "below minimum" if number and v < 0.2 else None
        assert got[i] == want


def test_lookup_tiers(spark):
    t = spark.createDataFrame([("/a/x.wav", "s1"), ("/b/y.wav", "s2"), ("/c/y.wav", "s3"), ("/q/z.wav", "s4")], "path string, s string")
    d = spark.createDataFrame([(1, "/a/x.wav"), (2, "/other/y.wav"), (3, "/other/z.wav"), (4, None)], "i int, p string")
    assert rows(cu.lookup(d, F.col("p"), t, "path", "s", [F.lit("none")]).select("i", "s")) == [(1, "s1"), (2, "none"), (3, "s4"), (4, "none")]


def test_keep_first_and_overlap(spark):
    d = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (4, None), (5, "b")], "i int, k string")
    assert rows(cu.keep_first(d, F.col("k"), F.col("i")).select("i")) == [(1,), (2,), (4,), (5,)]
    s = spark.createDataFrame([("x", "train"), ("x", "test"), ("y", "test"), ("y", "test"), (None, "test"), ("z", None)], "k string, split string")
    assert rows(cu.overlap(s, F.col("k"), "split")) == [("x", 2, 2)]


def dominates(a, b):
    return a[0] <= b[0] and all(x >= y for x, y in zip(a[1:], b[1:])) and (a[0] < b[0] or any(x > y for x, y in zip(a[1:], b[1:])))


def test_skyline_against_pairs(spark):
    r = random.Random(4)
    data = [(i, r.randint(0, 9) / 2, r.randint(0, 9) / 10, r.randint(0, 9) / 10) for i in range(200)] + [(900, 0.0, 0.9, 0.9)] * 1
    df = spark.createDataFrame(data, "id int, fah double, recall double, pr double")
    want = sorted(d[0] for d in data if not any(dominates(e[1:], d[1:]) for e in data))
    assert sorted(x.id for x in fr.skyline(df, "fah", "recall", "pr").collect()) == want
    want = sorted(d[0] for d in data if not any(dominates(e[1:3], d[1:3]) for e in data))
    assert sorted(x.id for x in fr.skyline(df, "fah", "recall").collect()) == want
    assert fr.skyline(df.limit(0), "fah", "recall").count() == 0
    by_ranges = fr.skyline(df, "fah", "recall", "pr", alone=5)
    assert sorted(x.id for x in by_ranges.collect()) == sorted(x.id for x in fr.skyline(df, "fah", "recall", "pr").collect())


def test_hypervolume_and_best(spark):
    p = spark.createDataFrame([(1.0, 0.95)], "x double, y double")
    assert fr.hypervolume(p, "x", "y", 10.0, 0.0).first()[0] == pytest.approx(8.55)
    assert fr.hypervolume(p.limit(0), "x", "y", 10.0, 0.0).first()[0] == 0.0
    c = spark.createDataFrame([(1, 0.4, 0.90), (2, 0.2, 0.80), (3, 0.2, 0.92)], "id int, fah double, recall double")
    assert fr.best_candidate(c, "fah", "recall", 0.3, 0.85, F.col("id")).first().id == 3
    kept = fr.prune_by_crowding([{"fah": f, "recall": f} for f in (0.0, 0.1, 0.11, 0.5, 1.0)], 4, "fah", "recall")
    assert len(kept) == 4 and {k["fah"] for k in kept} >= {0.0, 1.0}


def test_components_against_search(spark):
    r = random.Random(8)
    links = [(r.randint(0, 80), r.randint(0, 80)) for _ in range(60)] + [(i, i + 1) for i in range(200, 240)] + [(5, 5), (None, 3)]
    got = {x.id: x.component for x in components(spark.createDataFrame(links, "a int, b int"), "a", "b").collect()}
    near = {}
    for a, b in links:
        if a is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for x in near:
        seen, todo = {x}, [x]
        while todo:
            for y in near[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        assert got.get(x, x) == min(seen)
    assert components(spark.createDataFrame([], "a int, b int"), "a", "b").count() == 0


def test_similar_pairs_lose_none(spark):
    r = np.random.default_rng(3)
    centres = r.standard_normal((6, 8))
    v = [(i, (centres[i % 6] + 0.25 * r.standard_normal(8)).tolist()) for i in range(150)] + [(500, [0.0] * 8), (501, None)]
    v += [(600 + i, v[0][1]) for i in range(3)]
    df = spark.createDataFrame(v, "id bigint, v array<double>")
    for pivots, chunk in ((4, 10), (1, 1000)):
        pairs, member = sm.similar_pairs(df, vec_id="id", vector="v", threshold=0.9, pivots=pivots, chunk=chunk)
        m = np.array([x[1] for x in v[:150]])
        m /= np.linalg.norm(m, axis=1, keepdims=True)
        s = m @ m.T
        want = sorted((i, j) for i in range(150) for j in range(i + 1, 150) if s[i, j] >= 0.9)
        assert sorted((x.a, x.b) for x in pairs.collect()) == want
        assert {x.id: x.class_id for x in member.collect()}[602] == 0
    assert sm.similarity_classes(df.limit(0), vec_id="id", vector="v", threshold=0.9).count() == 0


def test_best_match_in_blocks(spark):
    r = np.random.default_rng(5)
    v = r.standard_normal((60, 5))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id bigint, v array<double>")
    got = {x.query_id: x.match_id for x in sm.best_match(df.where("id < 20"), df, vec_id="id", vector="v", threshold=-1, block_bytes=200).collect()}
    m = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = m @ m.T
    np.fill_diagonal(s, -2)
    assert got == {i: int(s[i].argmax()) for i in range(20)}


def test_clusters(spark):
    pts = [(i, "b", [1.0, 0.01 * i, 0.0]) for i in range(4)] + [(10 + i, "b", [0.0, 1.0, 0.01 * i]) for i in range(4)]
    df = spark.createDataFrame(pts, "id bigint, g string, v array<double>")
    want = [("b", i, 0) for i in range(4)] + [("b", 10 + i, 10) for i in range(4)]
    key = lambda r: tuple(map(str, r))
    for kw in ({"similarity": 0.5}, {"k": 2}):
        assert rows(sm.cluster_blocks(df, vec_id="id", vector="v", block="g", **kw)) == sorted(want, key=key)
    far = sorted((x.rank, x.id) for x in sm.farthest_points(df, vec_id="id", vector="v", group="g", k=2).collect())
    assert far[0] == (0, 0) and far[1][1] >= 10


def test_up_to_5000_rows_are_clustered_whole(spark):
    r = np.random.default_rng(4)
    x = r.standard_normal((300, 4))
    v = np.concatenate([x, x + 0.01 * r.standard_normal(x.shape)])
    df = spark.createDataFrame([(i, y.tolist()) for i, y in enumerate(v)], "vec_id bigint, embedding array<double>")
    kw = {"vec_id": "vec_id", "vector": "embedding", "similarity": 0.3}
    whole = {y.id: y.cluster for y in sm.cluster_blocks(df.withColumn("b", F.lit(0)), block="b", **kw).collect()}
    got = {y.id: y.cluster for y in sm.adaptive_clusters(df, **kw).collect()}
    assert got == whole and len(got) == 600
    cells = sm.adaptive_clusters(df, whole=599, density=599, per_cell=20, **kw)
    assert cells.select("block").distinct().count() == 30


@pytest.mark.parametrize("kw", [{"k": 7, "distance": None, "method": "ward"}, {"k": None, "distance": 0.9, "method": "complete"}])
def test_linkage_merges_the_nearest_two_of_all(kw):
    m = np.random.default_rng(6).standard_normal((60, 3))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    d = np.sqrt(np.maximum(0, 2 - 2 * m @ m.T))
    groups = [[i] for i in range(60)]

    def far(a, b):
        if kw["method"] == "complete":
            return d[np.ix_(a, b)].max()
        return np.sqrt(2 * len(a) * len(b) / (len(a) + len(b))) * np.linalg.norm(m[a].mean(0) - m[b].mean(0))

    while len(groups) > (kw["k"] or 1):
        least, i, j = min((far(a, b), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        if kw["distance"] is not None and least > kw["distance"]:
            break
        groups[i] += groups.pop(j)
    got = sm._linkage(m, **kw)
    assert sorted(sorted(np.flatnonzero(got == c).tolist()) for c in set(got)) == sorted(sorted(g) for g in groups)


@pytest.mark.parametrize("kw", [{"k": 9}, {"similarity": 0.3}])
def test_large_blocks_and_copies(spark, kw):
    """Blocks beyond the matrix, and copies as rows with a weight, give the clusters of all rows by the matrix."""
    r = np.random.default_rng(8)
    x = r.standard_normal((250, 4))
    v = np.concatenate([x, x[:5].repeat(30, axis=0)])
    m = v / np.linalg.norm(v, axis=1, keepdims=True)
    d = None if "k" in kw else 0.7
    labels = sm._linkage(m, kw.get("k"), d, "ward" if d is None else "complete")
    want = sorted(sorted(np.flatnonzero(labels == c).tolist()) for c in set(labels))
    df = spark.createDataFrame([(i, 0, y.tolist()) for i, y in enumerate(v)], "id bigint, g int, v array<double>")
    for matrix in (1000, 10):
        groups: dict[int, list[int]] = {}
        for y in sm.cluster_blocks(df, vec_id="id", vector="v", block="g", matrix=matrix, **kw).collect():
            groups.setdefault(y.cluster, []).append(y.id)
        assert sorted(map(sorted, groups.values())) == want and all(c == min(g) for c, g in groups.items())


def test_agglomerative_query_is_one_agglomeration(spark, tmp_path):
    from earshot.plans.similarity_queries import REGISTRY

    v = np.random.default_rng(9).standard_normal((80, 4)).astype(np.float32)
    spark.createDataFrame([(i, "a", y.tolist()) for i, y in enumerate(v)], "vec_id bigint, label string, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert len({(x.block, x.cluster) for x in REGISTRY.queries["CL1_agglomerative"](spark, str(tmp_path)).collect()}) == 4


def test_long_arrays_are_read_whole(spark, tmp_path):
    from earshot.plans.filter_queries import REGISTRY as filters
    from earshot.plans.window_queries import REGISTRY as windows

    spark.createDataFrame([(i, [1.0] * 1000 + [float(i + 2)] * 1000) for i in range(60)], "vec_id bigint, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert {x.size for x in windows.queries["WN20_silence_compaction"](spark, str(tmp_path)).collect()} == {2000}
    assert {x.size for x in filters.queries["PF19_transform_chain"](spark, str(tmp_path)).collect()} == {2000}


def test_vectors(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None), (3, ""), (4, "b a")], "id int, t string")
    got = {r.id: r.vector for r in sm.vectors(df, keep=["id"], payload="t", model=sm.hashed_words(8), width=8).collect()}
    assert got[2] is None and got[3] == [0.0] * 8 and got[1] == got[4] and abs(np.linalg.norm(got[1]) - 1) < 1e-6
    assert sm.vectors(df.limit(0), keep=["id"], payload="t", model=sm.hashed_words(8), width=8).count() == 0


def test_group_split(spark):
    df = spark.createDataFrame([(i, f"g{i % 30}" if i % 7 else None) for i in range(700)], "id bigint, g string")
    out = sp.group_split(df, "g", "id", 0.8, 0.1)
    per = out.where("g is not null").groupBy("g").agg(F.count_distinct("assigned").alias("n"))
    assert per.where("n > 1").count() == 0 and out.count() == 700
    sizes = dict(out.where("g is not null").groupBy("assigned").agg(F.count_distinct("g")).collect())
    assert sizes == {"train": 24, "val": 3, "test": 3}
    assert dict(out.where("g is null").groupBy("assigned").count().collect()) == {"train": 80, "val": 10, "test": 10}
    assert sp.group_split(df.limit(0), "g", "id", 0.8, 0.1).count() == 0


def test_five_way_is_group_disjoint(spark):
    df = spark.range(180).selectExpr("id", "cast(id div 6 as string) as g")
    out = sp.five_way(df, "g")
    assert out.groupBy("g").agg(F.count_distinct("part").alias("n")).where("n > 1").count() == 0 and out.count() == 180 and out.select("part").distinct().count() == 5


def test_wav(spark):
    x = [i / 50 - 0.5 for i in range(50)]
    cases = [audio.wav_bytes(x), audio.wav_bytes(x, 8000), audio.wav_bytes(x, bits=8), audio.wav_bytes(x + x, channels=2), audio.wav_bytes([]), audio.wav_bytes(x)[:-10], b"RIFF", b"", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c binary")
    got = [r[1] for r in sorted(df.select("i", audio.wav_check(F.col("c"))).collect())]
    assert got == [None, "rate 8000", "8 bits", "2 channels", "no frames", "cut off", "no RIFF/WAVE header", "no RIFF/WAVE header", "missing"]
    frames = [r[1].frames for r in sorted(df.select("i", audio.wav_info(F.col("c"))).collect())]
    assert frames == [50, 50, 50, 50, 0, 45, None, None, None]
    for bits in (8, 16, 24, 32):
        assert np.abs(np.array(audio.pcm(audio.wav_bytes(x, bits=bits))) - x).max() < 0.01


def test_feature_store(spark, tmp_path):
    s = store.FeatureStore(spark, str(tmp_path / "s"), width=2)
    df = spark.createDataFrame([(1, [1.0, 2.0], 0, "a"), (2, [3.0, 4.0], 1, "b")], "row_id bigint, features array<float>, label int, path string")
    s.add(df, "train")
    s.add(df, "val")
    assert s.read().count() == 4 and rows(s.get([2, 2], "train").select("row_id", "pos")) == [(2, 0), (2, 1)]
    with pytest.raises(Exception, match="multiple"):
        s.add(df.withColumn("features", F.array(F.lit(1.0).cast("float"))), "train")


def plain_density(m, min_cluster, min_samples):
    """HDBSCAN by its definition over all pairs: clusters are components of the graph of core points at every distance, followed from the largest down."""
    n = len(m)
    d = np.sqrt(np.maximum(0, 2 - 2 * m @ m.T))
    np.fill_diagonal(d, 0)
    core = np.sort(d, axis=1)[:, min_samples]
    reach = np.maximum(d, np.maximum(core[:, None], core[None, :]))
    np.fill_diagonal(reach, core)

    def parts(points, at):
        """Components of what is joined below the distance, single points that are no core being left out."""
        left, out = set(points), []
        while left:
            seen, todo = set(), [left.pop()]
            while todo:
                x = todo.pop()
                seen.add(x)
                near = {y for y in left if reach[x, y] < at}
                left -= near
                todo += near
            out.append(seen)
        return out

    def walk(points, birth):
        """(stability, clusters) of the best choice within a cluster that begins at a density."""
        own, inside = 0.0, set(points)
        for at in sorted({x for x in reach[np.ix_(points, points)].ravel() if x > 0}, reverse=True):
            some = [p for p in parts(inside, at) if len(p) >= min_cluster]
            if len(some) == 1:
                own += (len(inside) - len(some[0])) * (1 / at - birth)
                inside = some[0]
                continue
            own += len(inside) * (1 / at - birth)
            if not some:
                return own, [set(points)]
            below = [walk(sorted(p), 1 / at) for p in some]
            total = sum(s for s, _ in below)
            return (own, [set(points)]) if own >= total else (total, [c for _, x in below for c in x])
        return own, [set(points)]

    found = walk(list(range(n)), 0.0)[1]
    return {frozenset(c) for c in found if len(c) < n}


@pytest.mark.parametrize("seed", range(6))
def test_density_clusters_by_definition(seed):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(4, 8))
    m = np.concatenate([*(c + 0.15 * (k + 1) * r.normal(size=(9, 8)) for k, c in enumerate(centres)), 3 * r.normal(size=(8, 8))])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    label = sm._density_labels(m, np.ones(len(m), int), 5, 3)
    got = {frozenset(np.flatnonzero(label == c)) for c in set(label) if c >= 0}
    assert got == plain_density(m, 5, 3) and got
    assert sm._spanning_tree(m, np.zeros(len(m)))[0][0] > 0


def test_density_clusters_of_tables(spark):
    r = np.random.default_rng(1)
    near = [[float(x) for x in c + 0.05 * r.normal(size=6)] for c in np.eye(6)[:2] for _ in range(12)]
    data = [(i, v) for i, v in enumerate(near)] + [(100 + i, [0.0, 0.0, 1.0, 0.0, 0.0, 0.0]) for i in range(7)] + [(200, [0.0, 0.0, 0.0, 1.0, -1.0, 0.0]), (None, near[0]), (201, None)]
    df = spark.createDataFrame(data, "id bigint, v array<double>")
    got = {x.id: x.cluster for x in sm.density_clusters(df, vec_id="id", vector="v").collect()}
    assert got == {**{i: 0 for i in range(12)}, **{i: 12 for i in range(12, 24)}, **{100 + i: 100 for i in range(7)}, 200: 200}
    assert sm.density_clusters(df.limit(0), vec_id="id", vector="v").count() == 0
    assert sm.density_clusters(df.where("id = 200"), vec_id="id", vector="v").count() == 1
    assert sm.adaptive_clusters(df, vec_id="id", vector="v", similarity=0.5, whole=5).count() == 32
