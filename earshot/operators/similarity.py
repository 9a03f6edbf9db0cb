"""Cosine similarity of vectors: search, self-join and clusters. Vectors meet in Arrow batches as matrix products."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from earshot.operators.graph import components
from earshot.session import cut


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit rows; zero vectors stay zero."""
    flat = column.flatten() if isinstance(column, (pa.ListArray, pa.LargeListArray)) else column
    m = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n == 0, 1.0, n)


def best_match(queries: DataFrame, base: DataFrame, *, vec_id: str, vector: str, threshold: float, block_bytes: int = 64_000_000) -> DataFrame:
    """(query_id, match_id, similarity): each query's most similar row of `base` by cosine, if it reaches the threshold; ties by the least id. A query isn't matched with its own id.

    Queries are taken in blocks by hash of about `block_bytes` bytes of single-precision values, one block at a time on the driver. A block goes to each executor once, and one scan of `base`
    keeps a best row per query and task, which are reduced by key and, with several blocks, written before the next. So there are as many scans as blocks. Null ids and vectors take no part."""
    known = lambda d: d.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull()).select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).alias("v"))
    q, b = known(queries), known(base)
    n_values = q.agg(F.coalesce(F.sum(F.size("v")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-n_values * 4 // block_bytes))
    parts = []
    for k in range(n_blocks):
        held = q.where(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == k).toArrow()  # a block
        sent = q.sparkSession.sparkContext.broadcast((held.column(0).to_numpy(), _matrix(held.column(1).combine_chunks()).astype(np.float32)))

        def scan(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, m = sent.value
            best, who = np.full(len(ids), -2.0), np.full(len(ids), -1, np.int64)
            for batch in batches:
                if not len(ids) or not batch.num_rows:
                    continue
                own = batch.column(0).to_numpy(zero_copy_only=False)
                order = np.argsort(own, kind="stable")
                own, x = own[order], _matrix(batch.column(1))[order].T
                for at in range(0, len(ids), 1024):  # some queries at a time, so that the products stay small
                    part = slice(at, at + 1024)
                    s = m[part].astype(np.float64) @ x
                    s[ids[part, None] == own[None, :]] = -2.0
                    i = s.argmax(1)
                    v = s[np.arange(len(i)), i]
                    better = (v > best[part]) | ((v == best[part]) & (own[i] < who[part]))
                    best[part], who[part] = np.where(better, v, best[part]), np.where(better, own[i], who[part])
            ok = best >= threshold
            yield pa.RecordBatch.from_arrays([pa.array(ids[ok]), pa.array(who[ok]), pa.array(best[ok])], ["query_id", "match_id", "similarity"])

        found = b.mapInArrow(scan, "query_id bigint, match_id bigint, similarity double")
        found = found.groupBy("query_id").agg(F.max(F.struct("similarity", -F.col("match_id"))).alias("x")).select("query_id", (-F.col("x.col2")).alias("match_id"), "x.similarity")
        parts.append(found if n_blocks == 1 else cut(found, "matches"))
    return reduce(DataFrame.unionByName, parts)


def similar_pairs(df: DataFrame, *, vec_id: str, vector: str, threshold: float, pivots: int = 64, chunk: int = 4096) -> tuple[DataFrame, DataFrame]:
    """(pairs, membership): pairs (a, b, similarity), a < b, of class representatives whose cosine reaches the threshold, and (id, class_id) of every row. No link between different vectors is
    lost; equal vectors are one class, named by its least id, and aren't paired with each other.

    Representatives go to the cell of the nearest of `pivots` pivots (a bounded sample: those of the least hashes), and by hash to one of as many chunks of about `chunk` as the cell's size asks for. By the triangle
    inequality of angles a row is also sent, as a guest, to the cells whose members can lie within the threshold's angle; each chunk is held as a matrix and its guests stream past."""
    rows = df.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull()).select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).alias("v"))
    hashed = rows.withColumn("h", F.sha2(F.to_json(F.struct("v")), 256))
    classes = hashed.groupBy("h").agg(F.min("id").alias("class_id"))
    membership = hashed.select("id", "h").join(classes, "h").select("id", "class_id")
    reps = cut(hashed.groupBy("h").agg(F.min_by(F.struct("id", "v"), "id").alias("r")).select("r.*"), "representatives")
    sample = [r["v"] for r in reps.orderBy(F.xxhash64("id"), "id").limit(pivots).collect()]
    if not sample:
        return reps.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("similarity")).limit(0), membership
    p = np.array(sample, np.float64)
    norms = np.linalg.norm(p, axis=1, keepdims=True)
    p = p / np.where(norms == 0, 1.0, norms)
    reach = float(np.arccos(np.clip(threshold, -1, 1))) + 1e-9

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            angle = np.arccos(np.clip(_matrix(batch.column(1)) @ p.T, -1, 1))
            home = angle.argmin(1)
            own = angle[np.arange(len(ids)), home]
            # x of cell c within reach of y: angle(y, c) - angle(y, home) <= 2 reach, as x is no further from c than from y's home.
            to = (angle - own[:, None]) <= 2 * reach
            r, c = np.nonzero(to)
            is_home = home[r] == c
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), pa.array(~is_home), pa.array(ids[r]), batch.column(1).take(pa.array(r))], ["cell", "guest", "id", "v"])

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = np.arccos(np.clip(_matrix(batch.column(1)) @ p.T, -1, 1)).argmin(1)
            yield pa.RecordBatch.from_arrays([pa.array(home.astype(np.int32))], ["home"])

    kind = reps.schema["v"].dataType.simpleString()
    sent = reps.mapInArrow(assign, f"cell int, guest boolean, id bigint, v {kind}")
    sizes = {r["home"]: r["n"] for r in reps.mapInArrow(at_home, "home int").groupBy("home").agg(F.count(F.lit(1)).alias("n")).collect()}  # `pivots` rows at most
    n_chunks = F.element_at(F.array(*[F.lit(max(1, -(-sizes.get(c, 0) // chunk))) for c in range(len(sample))]), F.col("cell") + 1)
    homes = sent.where(~F.col("guest")).withColumn("chunk", F.pmod(F.xxhash64("id"), n_chunks).cast("int")).withColumn("held", F.lit(0))
    # Within a cell a row passes by the chunks of its cell too; guests pass by all of them.
    passing = sent.withColumn("chunk", F.explode(F.sequence(F.lit(0), n_chunks - 1))).withColumn("held", F.lit(1))
    tasks = homes.unionByName(passing).repartition("cell", "chunk").sortWithinPartitions("cell", "chunk", "held", "id").select("cell", "chunk", "held", "id", "v")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, parts = None, np.zeros(0, np.int64), []
        m = None
        for batch in batches:
            cells, chunks, held = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            own = batch.column(3).to_numpy(zero_copy_only=False)
            x = _matrix(batch.column(4))
            change = np.flatnonzero(np.diff(cells) | np.diff(chunks) | np.diff(held)) + 1
            for lo, hi in zip([0, *change], [*change, len(own)]):
                if lo == hi:
                    continue
                k = (cells[lo], chunks[lo])
                if k != key:
                    key, ids, parts, m = k, np.zeros(0, np.int64), [], None
                if held[lo] == 0:
                    ids, m = np.concatenate([ids, own[lo:hi]]), None
                    parts.append(x[lo:hi])
                    continue
                if m is None:
                    m = np.concatenate(parts) if parts else np.zeros((0, x.shape[1]))
                for at in range(lo, hi, 1024):
                    s = x[at : min(at + 1024, hi)] @ m.T
                    i, j = np.nonzero(s >= threshold)
                    a, b = own[at + i], ids[j]
                    ok = a < b
                    yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok]), pa.array(s[i, j][ok])], ["a", "b", "similarity"])

    # A pair is seen where its greater row is at home: once.
    return tasks.mapInArrow(join, "a bigint, b bigint, similarity double"), membership


def similarity_classes(df: DataFrame, *, vec_id: str, vector: str, threshold: float) -> DataFrame:
    """(id, n_links, group): for every row the number of other classes that its class is linked to, and the least id that links lead to."""
    pairs, membership = similar_pairs(df, vec_id=vec_id, vector=vector, threshold=threshold)
    pairs = cut(pairs, "pairs")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n_links"))
    groups = components(pairs, "a", "b")
    out = membership.join(ends, F.col("class_id") == F.col("c"), "left").join(groups.withColumnRenamed("id", "_g"), F.col("class_id") == F.col("_g"), "left")
    return out.select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "class_id").alias("group"))


def _linkage(m: np.ndarray, k: int | None, distance: float | None, method: str, weight: np.ndarray | None = None) -> np.ndarray:
    """Agglomerative labels of unit rows by euclidean distance: complete linkage up to a distance, or Ward's to k clusters. A row of weight w stands for w equal rows."""
    n = len(m)
    labels = np.arange(n)
    if n < 2:
        return labels
    size = np.ones(n) if weight is None else weight.astype(np.float64)
    d = m @ m.T
    d *= -2
    d += 2
    np.maximum(d, 0, out=d)
    if method == "ward":
        d *= 2 * size
        d *= size[:, None]
        d /= size + size[:, None]
    else:
        np.sqrt(d, out=d)
    np.fill_diagonal(d, np.inf)
    # Each row's nearest, the first of several. Merged rows are no nearer than the nearer of the two was, so only the rows of which it was one of the two are looked through again.
    near = d.argmin(1)
    least = d[np.arange(n), near]
    alive = n
    while alive > 1:
        i = int(least.argmin())
        j = int(near[i])
        if (k is not None and alive <= k) or (distance is not None and least[i] > distance):
            break
        i, j = min(i, j), max(i, j)
        if method == "ward":
            t = size + size[i] + size[j]
            new = ((size + size[i]) * d[i] + (size + size[j]) * d[j] - size * d[i, j]) / t
        else:
            new = np.maximum(d[i], d[j])
        new[[i, j]] = np.inf
        d[i], d[:, i] = new, new
        d[j], d[:, j] = np.inf, np.inf
        size[i] += size[j]
        labels[labels == j] = i
        alive -= 1
        least[j] = np.inf
        again = np.flatnonzero((near == i) | (near == j))
        again = np.union1d(again[np.isfinite(least[again])], [i])
        near[again] = d[again].argmin(1)
        least[again] = d[again, near[again]]
        closer = (new < least) | ((new == least) & (i < near) & np.isfinite(new))
        near[closer], least[closer] = i, new[closer]
    return labels


def _chained_linkage(m: np.ndarray, k: int | None, distance: float | None, method: str, weight: np.ndarray | None = None) -> np.ndarray:
    """The clusters of `_linkage` without its matrix, by chains of nearest neighbours: memory in proportion to the rows, time to their square. Apart from ties of distance the clusters are the same.

    Both linkages are reducible, so two clusters that are each other's nearest are merged whatever happens elsewhere; the merges are then cut by their distance or number."""
    n = len(m)
    size = np.ones(n) if weight is None else weight.astype(np.float64)
    c, norm = m.copy(), (m * m).sum(1)  # centres, for Ward's method
    owner = np.arange(n)  # of rows, for complete linkage
    members = [[i] for i in range(n)]
    active = np.ones(n, bool)
    alive, n_alive = np.arange(n), n

    def distances(a: int) -> np.ndarray:
        """Of cluster a to each of `alive`; infinite to itself and to those that are gone."""
        if method == "ward":
            gap = np.maximum(0, norm[a] + norm[alive] - 2 * (c[alive] if len(alive) < n else c) @ c[a])
            d = 2 * size[a] * size[alive] / (size[a] + size[alive]) * gap
        else:
            least = np.full(n, np.inf)
            for at in range(0, len(members[a]), 256):
                np.minimum(least, (m[members[a][at : at + 256]] @ m.T).min(0), out=least)
            of = np.full(n, np.inf)
            np.minimum.at(of, owner, least)
            d = np.sqrt(np.maximum(0, 2 - 2 * of[alive]))
        d[~active[alive] | (alive == a)] = np.inf
        return d

    merges, chain, start = [], [], 0
    while n_alive > 0:
        if not chain:
            while not active[start]:
                start += 1
            chain.append((start, np.inf))
        if n_alive < len(alive) // 2:
            alive = np.flatnonzero(active)
        a, before = chain[-1]
        d = distances(a)
        at = int(d.argmin())
        b, gap = int(alive[at]), float(d[at])
        if len(chain) > 1 and before <= gap:
            b, gap = chain[-2][0], before
        if gap == np.inf or (distance is not None and gap > distance):
            # Nothing is near enough, and by complete linkage nothing will be.
            active[a] = False
            n_alive -= 1
            chain.pop()
        elif len(chain) > 1 and b == chain[-2][0]:
            i, j = min(a, b), max(a, b)
            merges.append((gap, len(merges), i, j))
            if method == "ward":
                c[i] = (size[i] * c[i] + size[j] * c[j]) / (size[i] + size[j])
                norm[i] = c[i] @ c[i]
            else:
                owner[members[j]] = i
            members[i] += members[j]
            members[j] = []
            size[i] += size[j]
            active[j] = False
            n_alive -= 1
            del chain[-2:]
        else:
            chain.append((b, gap))
    merges.sort()
    parent = np.arange(n)
    for _, _, i, j in merges if k is None else merges[: max(0, n - k)]:
        while parent[i] != i:
            i = parent[i]
        while parent[j] != j:
            j = parent[j]
        parent[max(i, j)] = min(i, j)
    for i in range(n):  # a parent is less than its row
        parent[i] = parent[parent[i]]
    return parent


def cluster_blocks(df: DataFrame, *, vec_id: str, vector: str, block: str, similarity: float | None = None, k: int | None = None, matrix: int = 5000) -> DataFrame:
    """(block, id, cluster): agglomerative clusters within each block, each named by its least id.

    With `similarity` s complete linkage up to the euclidean distance 1 - s, which is a cosine of 1 - (1 - s)^2 / 2; with `k` Ward's method to k clusters (as many as there are different
    vectors, if these are fewer). Equal vectors of a block are one row with a weight, however many there are. A block's different vectors go to one task; up to `matrix` of them are clustered
    by the matrix of their distances, and more by chains of nearest neighbours, in memory of the rows and time of their square."""
    kind = df.schema[block].dataType.simpleString()
    rows = df.select(F.col(block).alias("block"), F.col(vec_id).cast("bigint").alias("id"), F.col(vector).alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    hashed = rows.withColumn("h", F.sha2(F.to_json(F.struct("block", "v")), 256))
    reps = hashed.groupBy("h").agg(F.min_by(F.struct("block", "id", "v"), "id").alias("r"), F.count(F.lit(1)).alias("n")).select("r.*", "h", "n")

    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values("id")
        m = np.array(pdf["v"].tolist(), np.float64)
        nrm = np.linalg.norm(m, axis=1, keepdims=True)
        labels = (_linkage if len(m) <= matrix else _chained_linkage)(m / np.where(nrm == 0, 1, nrm), k, None if similarity is None else 1 - similarity, "ward" if k else "complete", pdf["n"].to_numpy())
        return pd.DataFrame({"h": pdf["h"].to_numpy(), "cluster": pdf["id"].to_numpy()[labels]})

    found = reps.groupBy("block").applyInPandas(run, "h string, cluster bigint")
    return hashed.join(found, "h").select(F.col("block").cast(kind).alias("block"), "id", "cluster")


def coarse_cells(df: DataFrame, *, vec_id: str, vector: str, k: int, seed: int = 42) -> DataFrame:
    """(id, v, cell): k-means cells by MLlib, the first of two stages."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    data = df.where(F.col(vector).isNotNull()).select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).alias("v"), array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    return KMeans(k=k, seed=seed, maxIter=10).fit(data).transform(data).select("id", "v", F.col("prediction").alias("cell"))


def two_stage_clusters(df: DataFrame, *, vec_id: str, vector: str, similarity: float, per_cell: int = 1000) -> DataFrame:
    """(block, id, cluster): clusters by complete linkage within k-means cells of `per_cell` rows in the mean, ten cells at least."""
    n = df.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull()).count()
    return cluster_blocks(coarse_cells(df, vec_id=vec_id, vector=vector, k=max(10, n // per_cell)), vec_id="id", vector="v", block="cell", similarity=similarity)


def adaptive_clusters(df: DataFrame, *, vec_id: str, vector: str, similarity: float, whole: int = 5000, density: int = 50_000, per_cell: int = 1000) -> DataFrame:
    """(block, id, cluster): up to `whole` rows are clustered whole by complete linkage, as one block 0, up to `density` by `density_clusters`, and more by `two_stage_clusters`."""
    n = df.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull()).count()
    if n <= whole:
        return cluster_blocks(df.withColumn("_block", F.lit(0)), vec_id=vec_id, vector=vector, block="_block", similarity=similarity)
    if n <= density:
        return density_clusters(df, vec_id=vec_id, vector=vector, whole=density)
    return two_stage_clusters(df, vec_id=vec_id, vector=vector, similarity=similarity, per_cell=per_cell)


def _core_distances(m: np.ndarray, weight: np.ndarray, neighbours: int) -> np.ndarray:
    """Of unit rows the distance within which lie `neighbours` other rows, equal ones counted by weight; infinite where there are fewer."""
    out = np.zeros(len(m))
    for at in range(0, len(m), 256):
        d = np.sqrt(np.maximum(0, 2 - 2 * m[at : at + 256] @ m.T))
        own = np.arange(len(d))
        d[own, at + own] = 0
        order = np.argpartition(d, min(neighbours, d.shape[1] - 1), axis=1)[:, : neighbours + 1]
        near = np.take_along_axis(d, order, 1)
        by = np.argsort(near, axis=1, kind="stable")
        count = np.cumsum(np.take_along_axis(weight[order], by, 1), axis=1) - 1  # without the row itself
        enough = count >= neighbours
        out[at : at + 256] = np.where(enough.any(1), np.take_along_axis(np.take_along_axis(near, by, 1), enough.argmax(1)[:, None], 1)[:, 0], np.inf)
    return out


def _spanning_tree(m: np.ndarray, core: np.ndarray) -> list[tuple[float, int, int]]:
    """The edges of a least spanning tree by mutual reachability, the greatest of two rows' distance and their core distances, sorted. Memory is in proportion to the rows, time to their square."""
    n = len(m)
    least, by, out = np.full(n, np.inf), np.zeros(n, np.int64), []
    waiting = np.ones(n, bool)
    at = 0
    for _ in range(n - 1):
        waiting[at] = False
        d = np.maximum(np.sqrt(np.maximum(0, 2 - 2 * m @ m[at])), np.maximum(core, core[at]))
        closer = waiting & ((d < least) | (by == at))
        closer |= waiting & ~np.isfinite(least)
        least[closer], by[closer] = d[closer], at
        at = int(np.where(waiting, least, np.inf).argmin()) if np.isfinite(least[waiting]).any() else int(np.flatnonzero(waiting)[0])
        out.append((float(least[at]), int(by[at]), at))
    return sorted(out)


def _density_labels(m: np.ndarray, weight: np.ndarray, min_cluster: int, min_samples: int) -> np.ndarray:
    """For unit rows of some weight the number of their cluster, or -1 for noise: the clusters of most stability in the tree of densities (HDBSCAN).

    A row of weight w stands for w equal rows, which are joined at their core distance. The whole is no cluster of its own."""
    n = len(m)
    core = _core_distances(m, weight, min_samples)
    density = lambda d: 1 / max(d, 1e-9)
    # The tree of merges: node n + i joins two nodes at the i-th shortest edge.
    size, top, joined = [*map(int, weight)], list(range(n)), []

    def root(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    for d, a, b in _spanning_tree(m, core):
        a, b = root(a), root(b)
        top[a] = top[b] = len(top)
        top.append(len(top))
        joined.append((a, b, d))
        size.append(size[a] + size[b])
    # From the top: a split into two parts of `min_cluster` makes two clusters; smaller parts leave theirs.
    birth, parent, stability, of = [0.0], [-1], [0.0], np.zeros(n, np.int64)

    def leave(node: int, cluster: int) -> None:
        todo = [node]
        while todo:
            x = todo.pop()
            if x < n:
                of[x] = cluster
            else:
                todo += joined[x - n][:2]

    stack = [(len(top) - 1, 0)]
    while stack:
        node, c = stack.pop()
        if node < n:
            stability[c] += size[node] * (density(core[node]) - birth[c])
            of[node] = c
            continue
        d = joined[node - n][2]
        parts, todo = [], list(joined[node - n][:2])
        while todo:  # what is joined at one distance falls apart at once
            x = todo.pop()
            if x >= n and joined[x - n][2] == d:
                todo += joined[x - n][:2]
            else:
                parts.append(x)
        large = [x for x in parts if size[x] >= min_cluster]
        for x in parts:
            if len(large) != 1 or x != large[0]:
                stability[c] += size[x] * (density(d) - birth[c])
            if x not in large:
                leave(x, c)
        if len(large) == 1:
            stack.append((large[0], c))
            continue
        for x in large:
            birth.append(density(d))
            parent.append(c)
            stability.append(0.0)
            stack.append((x, len(birth) - 1))
    best, chosen, below = list(stability), [False] * len(birth), [0.0] * len(birth)
    for c in range(len(birth) - 1, 0, -1):
        chosen[c] = stability[c] >= below[c]
        best[c] = max(stability[c], below[c])
        below[parent[c]] += best[c]
    label = [-1] * len(birth)
    for c in range(1, len(birth)):
        label[c] = label[parent[c]] if label[parent[c]] >= 0 else c if chosen[c] else -1
    return np.array([label[c] for c in of])


def density_blocks(df: DataFrame, *, vec_id: str, vector: str, block: str, min_cluster: int = 5, min_samples: int = 3) -> DataFrame:
    """(block, id, cluster): clusters by density (HDBSCAN) of unit vectors within each block, named by their least id; a row of no cluster is one of its own.

    Equal vectors of a block are one row with a weight, however many there are. A block's different vectors go to one task, whose memory grows with their number and whose time with its square.
    Null ids and vectors take no part."""
    kind = df.schema[block].dataType.simpleString()
    rows = df.select(F.col(block).alias("block"), F.col(vec_id).cast("bigint").alias("id"), F.col(vector).alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    hashed = rows.withColumn("h", F.sha2(F.to_json(F.struct("block", "v")), 256))
    reps = hashed.groupBy("h").agg(F.min_by(F.struct("block", "id", "v"), "id").alias("r"), F.count(F.lit(1)).alias("n")).select("r.*", "h", "n")

    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values("id")
        m = np.array(pdf["v"].tolist(), np.float64)
        norm = np.linalg.norm(m, axis=1, keepdims=True)
        ids = pdf["id"].to_numpy()
        label = _density_labels(m / np.where(norm == 0, 1, norm), pdf["n"].to_numpy(), min_cluster, min_samples)
        first = {c: ids[i] for i, c in reversed(list(enumerate(label)))}
        return pd.DataFrame({"h": pdf["h"].to_numpy(), "cluster": [None if c < 0 else first[c] for c in label]}).astype({"cluster": "Int64"})

    found = reps.groupBy("block").applyInPandas(run, "h string, cluster bigint")
    return hashed.join(found, "h").select(F.col("block").cast(kind).alias("block"), "id", F.coalesce("cluster", "id").alias("cluster"))


def density_clusters(df: DataFrame, *, vec_id: str, vector: str, min_cluster: int = 5, min_samples: int = 3, whole: int = 50_000, per_cell: int = 10_000) -> DataFrame:
    """(block, id, cluster): `density_blocks` over up to `whole` rows as one block 0, and within k-means cells of `per_cell` rows in the mean over more."""
    known = df.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull())
    n = known.count()
    if n <= whole:
        return density_blocks(known.withColumn("_block", F.lit(0)), vec_id=vec_id, vector=vector, block="_block", min_cluster=min_cluster, min_samples=min_samples)
    return density_blocks(coarse_cells(known, vec_id=vec_id, vector=vector, k=-(-n // per_cell)), vec_id="id", vector="v", block="cell", min_cluster=min_cluster, min_samples=min_samples)


def farthest_points(df: DataFrame, *, vec_id: str, vector: str, group: str, k: int) -> DataFrame:
    """(group, id, rank): k rows per group, the first by id and then each the one farthest from all chosen; ties by the least id.

    Each of the k rounds is a scan with map-side maxima, which measures every row against its group's chosen ones; only these, k a group, are written. A group is never gathered."""
    rows = df.where(F.col(vector).isNotNull() & F.col(vec_id).isNotNull()).select(F.col(group).alias("group"), F.col(vec_id).alias("id"), F.col(vector).alias("v"))
    square = lambda v, w: F.aggregate(F.zip_with(v, w, lambda a, b: F.pow(a.cast("double") - b.cast("double"), 2)), F.lit(0.0), lambda a, x: a + x)
    chosen = cut(rows.groupBy("group").agg(F.min_by(F.struct("id", "v"), "id").alias("t")).select("group", F.lit(0).alias("rank"), "t.id", "t.v"), "points")
    for r in range(1, k):
        held = chosen.groupBy(F.col("group").alias("_g")).agg(F.collect_list(F.struct("id", "v")).alias("c"))  # k a group at most
        met = rows.join(held, F.col("group").eqNullSafe(F.col("_g"))).where(~F.exists("c", lambda x: x["id"] == F.col("id")))
        far = met.withColumn("far", F.array_min(F.transform("c", lambda x: square(F.col("v"), x["v"]))))
        top = far.groupBy("group").agg(F.max_by(F.struct("id", "v"), F.struct("far", -F.col("id"))).alias("t")).select("group", F.lit(r).alias("rank"), "t.id", "t.v")
        chosen = cut(chosen.unionByName(top), "points")
    return chosen.select("group", "id", "rank")


def closest_to_centroid(df: DataFrame, *, vec_id: str, vector: str, group: str, k: int) -> DataFrame:
    """(group, id, distance): the k rows of each group nearest to its mean vector; ties by id."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    from earshot.operators.curation import top_per_group

    rows = df.where(F.col(vector).isNotNull()).select(F.col(group).alias("group"), F.col(vec_id).alias("id"), F.col(vector).alias("v"))
    mean = rows.groupBy(F.col("group").alias("_g")).agg(vector_to_array(Summarizer.mean(array_to_vector(F.col("v").cast("array<double>")))).alias("c"))
    d = F.sqrt(F.aggregate(F.zip_with("v", "c", lambda a, b: F.pow(a.cast("double") - b, 2)), F.lit(0.0), lambda a, x: a + x))
    near = rows.join(mean, F.col("group").eqNullSafe(F.col("_g"))).select("group", "id", F.round(d, 9).alias("distance"))
    return top_per_group(near, ["group"], k, F.col("distance"), F.col("id"))


def vectors(df: DataFrame, *, keep: list[str], payload: str, model, width: int) -> DataFrame:
    """The columns `keep` and `vector`: what `model`, a function of a list of payloads to a matrix of `width` columns, makes of each row's payload, a batch at a time. Null payloads give null."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields) + ", vector array<float>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(len(keep)).to_pylist()
            at = [i for i, v in enumerate(values) if v is not None]
            out: list = [None] * len(values)
            made = np.asarray(model([values[i] for i in at]), np.float32).reshape(len(at), width) if at else []
            for i, row in zip(at, made):
                out[i] = row
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(out, pa.list_(pa.float32()))], names=[*keep, "vector"])

    return df.select(*keep, F.col(payload).alias("_payload")).mapInArrow(run, schema)


def hashed_words(width: int = 64):
    """A model for `vectors`: counts of a text's words of plain letters and digits by hash, a sign from the hash, of length one."""

    def model(texts: list[str]) -> np.ndarray:
        import hashlib
        import re
        from collections import Counter

        m = np.zeros((len(texts), width))
        for i, t in enumerate(texts):
            for w, n in Counter(re.findall(r"[a-z0-9]+", t.lower())).items():
                h = int(hashlib.md5(w.encode()).hexdigest()[:8], 16)
                m[i, h % width] += n if h >> 16 & 1 else -n
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(n == 0, 1.0, n)

    return model
