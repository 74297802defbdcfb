"""Vectors and clustering against brute force in numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from postmill.functions.vectors import l2_norm, l2_normalise
from postmill.operators import clustering as K
from postmill.operators import embeddings as V


def frame(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id int, v array<double>")


def blobs(seed=5):
    """Three dense groups, one of them two that split further, copies of one point, and noise."""
    rng = np.random.default_rng(seed)
    parts = [rng.normal(c, s, (n, 3)) for c, s, n in [((0, 0, 0), 0.1, 30), ((5, 5, 5), 0.1, 25), ((5, 5, 7), 0.1, 20), ((-6, 6, 0), 0.2, 22)]]
    copies = np.repeat(np.array([[-6.0, 6.0, 0.05]]), 15, axis=0)
    return np.vstack([*parts, copies, rng.uniform(-12, 12, (25, 3))])


def brute_cut(x, radius, size, k):
    """Components of dense points at one radius, over all pairs."""
    apart = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    core = np.sort(apart, axis=1)[:, k]
    near = (np.maximum(apart, np.maximum(core[:, None], core[None])) <= radius) & (core <= radius)[:, None] & (core <= radius)[None]
    label = -np.ones(len(x), dtype=int)
    groups = []
    seen = set()
    for i in np.flatnonzero(core <= radius):
        if i in seen:
            continue
        todo, group = [i], {i}
        while todo:
            for j in np.flatnonzero(near[todo.pop()]):
                if j not in group:
                    group.add(j)
                    todo.append(j)
        seen |= group
        groups.append(group)
    for n, group in enumerate(g for g in groups if len(g) >= size):
        label[list(group)] = n
    return label


def partition(labels):
    """Labels as a set of groups, noise left out."""
    return {frozenset(np.flatnonzero(labels == n).tolist()) for n in set(labels.tolist()) if n != -1}


def labels_of(df, n):
    out = np.full(n, -9)
    for r in df.collect():
        out[r.id] = r.topic_id
    assert (out != -9).all()
    return out


@pytest.mark.parametrize("radius,block_rows,floor", [(0.3, 1000, 100_000), (2.5, 12, 100_000), (2.5, 60, 1)])
def test_density_cut(spark, radius, block_rows, floor):
    x = blobs()
    found = labels_of(K.density_cut(frame(spark, x), "id", "v", radius, block_rows=block_rows, floor=floor), len(x))
    assert partition(found) == partition(brute_cut(x, radius, K.MIN_CLUSTER_SIZE, K.MIN_SAMPLES))
    sizes = [(found == n).sum() for n in range(found.max() + 1)]
    assert sizes == sorted(sizes, reverse=True)


def test_density_cut_without_separation(spark, monkeypatch):
    """Blocks of one large component are not compared with each other; long chains and their gaps are still found."""
    monkeypatch.setattr(K, "_paired", None)
    x = np.random.default_rng(5).normal(size=(300, 20))
    x /= np.linalg.norm(x, axis=1)[:, None]
    found = labels_of(K.density_cut(frame(spark, x), "id", "v", 1.8, block_rows=10), len(x))
    assert partition(found) == partition(brute_cut(x, 1.8, K.MIN_CLUSTER_SIZE, K.MIN_SAMPLES)) == {frozenset(range(300))}
    line = np.arange(200) * 0.2 + 1.1 * (np.arange(200) >= 120)
    x = np.stack([line, np.zeros(200)], 1)
    found = labels_of(K.density_cut(frame(spark, x), "id", "v", 1.0, block_rows=2), len(x))
    assert partition(found) == partition(brute_cut(x, 1.0, K.MIN_CLUSTER_SIZE, K.MIN_SAMPLES)) == {frozenset(range(120)), frozenset(range(120, 200))}


def brute_topics(x, size, k):
    """The hierarchy over all pairs in plain Python; edges of one weight join all they touch at once."""
    part, power = np.frexp(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)))
    apart = np.ldexp(np.rint(np.ldexp(part, 40)), power - 40)
    core = np.sort(apart, axis=1)[:, k]
    reach = np.maximum(apart, np.maximum(core[:, None], core[None]))
    left, edges = {*range(1, len(x))}, []
    near, source = reach[0].copy(), np.zeros(len(x), dtype=int)
    while left:
        j = min(left, key=lambda i: near[i])
        edges.append((near[j], int(source[j]), j))
        left.discard(j)
        closer = reach[j] < near
        near[closer], source[closer] = reach[j][closer], j
    node = {i: (frozenset([i]), [], 0.0) for i in range(len(x))}  # of each point: points, sides, weight
    for w in sorted({e[0] for e in edges}):
        sides = {}
        for _, a, b in (e for e in edges if e[0] == w):
            own = {id(s): s for p in (a, b) for s in sides.get(id(node[p]), [node[p]])}
            groups = [own]
            for other in {id(s): sides[s_id] for s_id, s in own.items() if s_id in sides}.values():
                groups.append({id(s): s for s in other})
            whole = {i: s for g in groups for i, s in g.items()}
            for i in whole:
                sides[i] = list(whole.values())
        for group in {frozenset(map(id, g)): g for g in sides.values()}.values():
            new = (frozenset().union(*[s[0] for s in group]), group, w)
            for i in new[0]:
                node[i] = new

    def choose(top, birth, allowed=True):
        stability, at = -birth * len(top[0]), top
        while True:
            big = [s for s in at[1] if len(s[0]) >= size]
            density = 1 / max(at[2], 1e-12)
            stability += density * (len(at[0]) - (len(big[0][0]) if len(big) == 1 else 0))
            if len(big) != 1:
                break
            at = big[0]
        found = [choose(s, density) for s in big]
        total = sum(f[0] for f in found)
        if allowed and stability >= total:
            return stability, {frozenset(top[0])}
        return total, set().union(*[f[1] for f in found])

    return choose(node[0], 0.0, False)[1]


@pytest.mark.parametrize("block_rows,floor,task_edges", [(1000, 100_000, 200_000), (20, 100_000, 30)])
def test_topics(spark, block_rows, floor, task_edges):
    """In one task, and over many cells, spanning rounds and halved problems."""
    rng = np.random.default_rng(5)
    x = blobs()
    x[-40:-25] += rng.normal(0, 1e-3, (15, 3))  # no copies: the brute force breaks their ties otherwise
    found = labels_of(K.topics(frame(spark, x), "id", "v", block_rows=block_rows, floor=floor, task_edges=task_edges), len(x))
    want = brute_topics(x, K.MIN_CLUSTER_SIZE, K.MIN_SAMPLES)
    assert len(want) >= 4 and partition(found) == {frozenset(w) for w in want}
    sizes = [(found == n).sum() for n in range(found.max() + 1)]
    assert sizes == sorted(sizes, reverse=True)


def test_topics_of_unseparated_vectors(spark):
    """2,000 vectors of one cloud with denser places and noise: nothing separates them, labels are those of the exact method."""
    rng = np.random.default_rng(11)
    centres = rng.normal(0, 3, (12, 4))
    x = np.vstack([rng.normal(c, 0.5 + 0.1 * i, (140, 4)) for i, c in enumerate(centres)] + [rng.normal(0, 4, (320, 4))])
    found = labels_of(K.topics(frame(spark, x), "id", "v", block_rows=300), len(x))
    want = brute_topics(x, K.MIN_CLUSTER_SIZE, K.MIN_SAMPLES)
    assert len(want) > 3 and (found == -1).sum() > 100 and partition(found) == {frozenset(w) for w in want}


def far_apart(rng, sizes=(90, 70, 60), dims=12):
    """Clusters whose points are all about as far from each other, 0.3 times a unit vector beside the cluster's mark."""
    parts = []
    for i, n in enumerate(sizes):
        unit = rng.normal(size=(n, dims))
        marks = np.zeros((n, len(sizes)))
        marks[:, i] = 1
        parts.append(np.hstack([0.3 * unit / np.linalg.norm(unit, axis=1)[:, None], marks]))
    return np.vstack(parts)


@pytest.mark.parametrize("block_rows,close_rows", [(1000, 8000), (25, 20)])
def test_topics_far_apart_need_no_tree(spark, monkeypatch, block_rows, close_rows):
    monkeypatch.setattr(K, "CLOSE_ROWS", close_rows, raising=False)
    monkeypatch.setattr(K, "_spanning_tree", None)
    x = far_apart(np.random.default_rng(3))
    found = labels_of(K.topics(frame(spark, x), "id", "v", block_rows=block_rows), len(x))
    assert {frozenset(w) for w in brute_topics(x, K.MIN_CLUSTER_SIZE, K.MIN_SAMPLES)} == partition(found)
    copies = np.vstack([x, np.repeat(x[:3], 8, axis=0)])  # nine copies are no cluster
    found = labels_of(K.topics(frame(spark, copies), "id", "v", block_rows=block_rows), len(copies))
    assert sorted(map(len, partition(found))) == [60, 70, 114]


def _denser_inside(x, rng):
    """In each cluster two groups of near copies, more stable than what holds them."""
    near = [x[i] + rng.normal(0, 1e-4, (12, x.shape[1])) for i in (0, 5, 95, 99, 170, 175)]
    return np.vstack([x, *near])


@pytest.mark.parametrize("case", ["denser inside", "noise", "near", "nested"])
def test_topics_that_are_not_proved_are_drawn(spark, case):
    """Where clusters inside are more stable, a point is far from all, or clusters are not far apart, the tree decides."""
    rng = np.random.default_rng(8)
    x = far_apart(rng)
    if case == "denser inside":
        x = _denser_inside(x, rng)
    elif case == "noise":
        x = np.vstack([x, [[0.0] * 12 + [3.0, 3.0, 3.0]]])
    elif case == "near":
        x[:, 12:] *= 0.25
    else:  # pairs of clusters that are more stable together
        x[:, 12:] *= 0.4
        x = np.vstack([x, x + np.array([0.0] * 12 + [40.0, 0.0, 0.0])])
    points, cells = K._place(K._points(K._prepare(frame(spark, x), "id", "v"), "_v"), 1000)
    settled = K._settled(points, cells, K.MIN_SAMPLES, K.MIN_CLUSTER_SIZE, 1000, 100_000)
    found = labels_of(K.topics(frame(spark, x), "id", "v"), len(x))
    want = {frozenset(w) for w in brute_topics(x, K.MIN_CLUSTER_SIZE, K.MIN_SAMPLES)}
    assert partition(found) == want
    assert settled is None or case == "nested"


@pytest.mark.parametrize("rows,task_edges", [(3000, 200_000), (40, 60)])
def test_topics_with_near_copies_are_drawn_in_each_component(spark, monkeypatch, rows, task_edges):
    """Groups of near copies that are more stable than what holds them need no tree of all points, and give what it gives."""
    for name in ("TREE_ROWS", "CLOSE_ROWS"):
        monkeypatch.setattr(K, name, rows, raising=False)
    rng = np.random.default_rng(8)
    x = far_apart(rng, sizes=(150, 90, 70))
    x = np.vstack([x, *[x[i] + rng.normal(0, 3e-3, (n, x.shape[1])) * (np.arange(x.shape[1]) < 12) for i, n in ((0, 40), (155, 12), (170, 14))]])
    want = {frozenset(w) for w in brute_topics(x, K.MIN_CLUSTER_SIZE, K.MIN_SAMPLES)}
    whole = labels_of(K.topics(frame(spark, x), "id", "v", task_edges=task_edges), len(x))
    monkeypatch.setattr(K, "_core_distances", None)
    monkeypatch.setattr(K, "_spanning_tree", None)
    found = labels_of(K.topics(frame(spark, x), "id", "v", task_edges=task_edges), len(x))
    assert partition(found) == want and (found == whole).all() and 0 < (found == -1).sum() < len(x)


def test_components_whose_birth_decides_are_drawn_whole(spark, monkeypatch):
    """Where bounds of the distance between components choose differently, the tree of all points decides."""
    rng = np.random.default_rng(8)
    x = far_apart(rng, sizes=(150, 90, 70))
    x = np.vstack([x, x[0] + rng.normal(0, 3e-3, (40, x.shape[1])) * (np.arange(x.shape[1]) < 12)])
    homes = [[("a", "a")], [("b", "a")]]
    chosen = K._chosen
    monkeypatch.setattr(K, "_chosen", lambda c, *a: spark.createDataFrame(homes.pop(0), "cluster string, home string") if homes else chosen(c, *a))
    found = labels_of(K.topics(frame(spark, x), "id", "v"), len(x))
    assert not homes and partition(found) == {frozenset(w) for w in brute_topics(x, K.MIN_CLUSTER_SIZE, K.MIN_SAMPLES)}


def test_spanning_forest_in_rounds(spark):
    rng = np.random.default_rng(4)
    rows = [(f"n{a}", f"n{b}", float(rng.integers(0, 40))) for a, b in rng.integers(0, 60, (500, 2)) if a != b]
    rows += [("x", "y", 1.0), ("y", "z", 1.0), ("z", "x", 1.0)]
    edges = spark.createDataFrame(rows, "src string, dst string, weight double")
    whole = K.spanning_forest(edges).collect()
    parts = K.spanning_forest(edges, most=20).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, parts)) and len(whole) == 59 + 2


def test_topics_of_few_vectors(spark):
    assert K.topics(frame(spark, [(0, 0)]).limit(0), "id", "v").count() == 0
    assert [r.topic_id for r in K.topics(frame(spark, [(0, 0)]), "id", "v").collect()] == [-1]
    assert {r.topic_id for r in K.topics(frame(spark, np.arange(8).reshape(4, 2)), "id", "v").collect()} == {-1}
    copies = np.repeat(np.array([[0.0, 0.0], [9.0, 9.0]]), [12, 11], axis=0)
    found = labels_of(K.topics(frame(spark, copies), "id", "v"), 23)
    assert found.tolist() == [0] * 12 + [1] * 11


def test_topics_find_planted_groups_with_their_own_grid(spark):
    x = blobs()
    found = labels_of(K.topics(frame(spark, x), "id", "v"), len(x))
    planted = [range(0, 30), range(30, 55), range(55, 75), range(75, 112)]
    for group in planted:
        values, counts = np.unique(found[list(group)], return_counts=True)
        assert values[counts.argmax()] != -1 and counts.max() >= 0.8 * len(group)
    assert found.max() == 3


def test_core_distances_are_exact_over_many_cells(spark):
    x = np.random.default_rng(1).normal(size=(150, 4))
    points = K._points(K._prepare(frame(spark, x), "id", "v"), "_v")
    placed, cells = K._place(points, 10)
    got = sorted(r.core for r in K._core_distances(placed, cells, 5).collect())
    want = sorted(np.sort(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), axis=1)[:, 5])
    assert len(cells.blocks) == 15 and np.allclose(got, want)


def test_svd(spark):
    x = np.random.default_rng(2).normal(size=(60, 8)) + 1
    rows = V.truncated_svd(frame(spark, x), "id", "v", 3).orderBy("id").collect()
    _, _, vt = np.linalg.svd(x, full_matrices=False)
    basis = vt[:3].T
    basis = basis * np.where(basis[np.abs(basis).argmax(axis=0), range(3)] < 0, -1, 1)
    assert np.allclose([r.reduced for r in rows], x @ basis)
    assert len(V.truncated_svd(frame(spark, x), "id", "v", 50).first().reduced) == 8


def test_wide_svd(spark):
    """20,000 dimensions, rank 55, singular values down to 1e-9 of the largest."""
    random = np.random.default_rng(5)
    left, right = (np.linalg.qr(random.normal(size=(n, 55)))[0] for n in (200, 20_000))
    values = np.logspace(3, -6, 55)
    x = (left * values) @ right.T
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<double>").repartition(5)
    got = np.array([r.reduced for r in V.truncated_svd(rows, "id", "v", 50).orderBy("id").collect()])
    assert got.shape == (200, 50)
    assert np.allclose(np.linalg.norm(got, axis=0), np.linalg.svd(x, compute_uv=False)[:50], rtol=1e-6, atol=1e-9)
    assert np.allclose(got @ got.T, (left[:, :50] * values[:50] ** 2) @ left[:, :50].T, atol=1e-6)


def test_wide_svd_edges(spark, monkeypatch):
    """Sketch and Gram matrix agree where both apply; fewer rows than components, equal rows, zeros and nulls are no harm."""
    x = np.random.default_rng(6).normal(size=(40, 8)) * np.logspace(0, -3, 8)
    narrow = [r.reduced for r in V.truncated_svd(frame(spark, x), "id", "v", 3).orderBy("id").collect()]
    monkeypatch.setattr(V, "MAX_DIMENSIONS", 1)
    assert np.allclose([r.reduced for r in V.truncated_svd(frame(spark, x), "id", "v", 3).orderBy("id").collect()], narrow)
    same = [r.reduced for r in V.truncated_svd(frame(spark, [x[0], x[0], x[0] * 0]), "id", "v", 6).orderBy("id").collect()]
    assert np.allclose(np.linalg.norm(same, axis=1), np.linalg.norm([x[0], x[0], x[0] * 0], axis=1))
    empty = frame(spark, x).where("id < 0")
    assert V.truncated_svd(empty, "id", "v", 3).count() == 0
    assert V.wide_basis(frame(spark, x).withColumn("v", F.lit(None).cast("array<double>")), "v", 8, 3).shape == (8, 3)


def test_normalise(spark):
    got = frame(spark, [(3, 4), (0, 0)]).select(l2_normalise(F.col("v")), l2_norm(F.col("v"))).collect()
    assert [tuple(r) for r in got] == [([0.6, 0.8], 5.0), ([0.0, 0.0], 0.0)]


def test_store_grows_only_by_new_documents(spark, tmp_path):
    store = str(tmp_path / "store")
    docs = spark.createDataFrame([(f"m{i}", f"text number {i}") for i in range(6)], "message_id string, clean_text string")
    embed = lambda d: V.hashed_embeddings(d, "message_id", "clean_text", 16, idf=False)
    first = V.populate(docs.where("message_id < 'm3'"), store, embed)
    assert sorted(r.message_id for r in first.collect()) == ["m0", "m1", "m2"]
    counted = spark.sparkContext.accumulator(0)

    def factory():
        def encode(texts):
            counted.add(len(texts))
            return np.ones((len(texts), 16))

        return encode

    again = V.populate(docs, store, lambda d: V.encode(d, "message_id", "clean_text", factory))
    assert again.count() == 6 and counted.value == 3
    assert V.read_store(spark, store).count() == 6
    assert all(abs(np.linalg.norm(r.embedding) - 1) < 1e-6 for r in first.collect())


def test_a_batch_reads_its_buckets_only(spark, tmp_path):
    store = str(tmp_path / "store")
    docs = spark.range(400).selectExpr("concat('m', id) message_id", "concat('text number ', id) clean_text")
    embed = lambda d: V.hashed_embeddings(d, "message_id", "clean_text", 16, idf=False)
    V.populate(docs, store, embed)
    files = list((tmp_path / "store").glob("bucket=*/*.parquet"))
    assert 150 < len(files) <= V.BUCKETS  # one file per bucket, not one per task and bucket
    batch = docs.where("message_id in ('m1', 'm2', 'm399')").union(spark.createDataFrame([("new", "text")], docs.schema))
    got = V.populate(batch, store, embed)
    assert sorted(r.message_id for r in got.collect()) == ["m1", "m2", "m399", "new"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan or "PartitionFilters: [isnotnull(bucket" in plan
    buckets = {r[0] for r in batch.select(V.bucket_of(F.col("message_id"))).collect()}
    assert len(buckets) <= 4 and V.read_store(spark, store, sorted(buckets)).count() < 40
    assert V.read_store(spark, store).count() == 401 and V.read_store(spark, store, []).count() == 0
    assert V.populate(batch.limit(0), store, embed).count() == 0


def test_svd_keeps_wide_rows_in_small_row_groups(spark):
    import pyarrow.parquet as pq

    rows = spark.range(0, 1500, 1, 1).select("id", F.array_repeat(F.col("id") % 3 + 1.0, 600).alias("v"))  # values that repeat take no room as written
    reduced = V.truncated_svd(rows, "id", "v", k=2)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in reduced.inputFiles()]
    assert sum(f.num_rows for f in files) == 1500
    assert max(f.row_group(i).num_rows for f in files for i in range(f.num_row_groups)) <= 512
