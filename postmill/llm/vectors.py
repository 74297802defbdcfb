"""Near-duplicate vectors through robust-pruned flat graphs on overlapping cluster shards."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import saved, shuffles_removed, spread_lookup
from postmill.llm.graph import components

COSINE = 0.98
#: Vectors that one graph holds; a larger shard is cut into blocks, and its visitors search every block, so many to a task.
BLOCK, ASKERS = 1000, 4000
#: Vectors handed out for search at a time, times the table; the rest of the shards wait for the next round.
ROUND, MAX_ROUNDS = 1.5, 64
#: Centres are fitted on at most so many rows, and there are at most so many of them.
FIT_ROWS, MAX_CENTRES = 20_000, 4096
#: A vector also visits every shard whose boundary is nearer than this. Two linked vectors are at most
#: 0.2 apart, in a direction that is rarely that of the boundary's normal; the audit measures the loss.
OVERLAP = 0.1
POOL, RANDOM_POOL, DEGREE, ALPHA = 40, 12, 24, 1.2
BEAM, MEDOIDS, SLACK = 24, 8, 0.04
AUDIT = 256  # queries of the recall audit
NAME = ["_high", "_low"]


def unit(rows) -> np.ndarray:
    x = np.stack([np.asarray(r, dtype=np.float64) for r in rows])
    x = x / np.abs(x).max(1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.linalg.norm(x, axis=1, keepdims=True)


# --- graph --------------------------------------------------------------------------------------


def build_graph(x: np.ndarray, seed: int = 5) -> tuple[list[np.ndarray], np.ndarray]:
    """(neighbours of each row, medoids): a flat graph by robust pruning of nearest and random rows.

    Of a row's pool, nearest first, a row is kept unless a kept one is ALPHA times nearer to it than
    the row itself is. Every row is also a neighbour of its nearest one, so that it can be reached.
    """
    n = len(x)
    random = np.random.default_rng(seed)
    near = x @ x.T
    np.fill_diagonal(near, -2.0)
    k = min(POOL, n - 1)
    if k < 1:
        return [np.zeros(0, dtype=np.int64) for _ in range(n)], np.arange(n)
    pool = np.concatenate((np.argpartition(-near, k - 1, axis=1)[:, :k], random.integers(0, n, (n, min(RANDOM_POOL, n - 1)))), axis=1)
    row = np.arange(n)[:, None]
    pool = np.take_along_axis(pool, np.argsort(-near[row, pool], axis=1, kind="stable"), axis=1)
    distance = np.sqrt(np.maximum(0, 2 - 2 * near[row, pool]))
    alive = pool != row
    kept: list[list[int]] = [[] for _ in range(n)]
    for _ in range(DEGREE):
        some = np.flatnonzero(alive.any(1))
        if not len(some):
            break
        pick = pool[some, alive[some].argmax(1)]
        for i, j in zip(some.tolist(), pick.tolist(), strict=True):
            kept[i].append(j)
        between = np.sqrt(np.maximum(0, 2 - 2 * near[pick[:, None], pool[some]]))
        alive[some] &= (ALPHA * between > distance[some]) & (pool[some] != pick[:, None])
    for i, j in enumerate(near.argmax(1).tolist()):
        kept[j].append(i)
    medoids = [int((x @ x.mean(0)).argmax())]
    closest = x @ x[medoids[0]]
    while len(medoids) < min(MEDOIDS, n):
        medoids.append(int(closest.argmin()))
        closest = np.maximum(closest, x @ x[medoids[-1]])
    return [np.unique(a) for a in kept], np.array(medoids)


def range_search(x: np.ndarray, padded: np.ndarray, entries: np.ndarray, queries: np.ndarray, cosine: float = COSINE) -> np.ndarray:
    """found[q, i]: rows within range, by a greedy beam search that then spreads through the range.

    The beam walks from the medoids towards each query, all its open rows at a step. From then on all rows seen within the range,
    or by SLACK short of it, are expanded until no new ones turn up, so a range may hold any number. Cosines are computed
    pair by pair while few are looked at, by one matrix product once that is cheaper.
    """
    n, q = len(x), len(queries)
    seen = np.zeros((q, n), dtype=bool)
    expanded = np.zeros((q, n), dtype=bool)
    sims = np.full((q, n), -2.0)
    product: list[np.ndarray] = []

    def look(new: np.ndarray) -> None:
        new &= ~seen
        a, b = np.nonzero(new)
        if not product and len(a) > q * n // 20:
            product.append(queries @ x.T)
        for s in range(0, len(a), 200_000):
            i, j = a[s : s + 200_000], b[s : s + 200_000]
            sims[i, j] = product[0][i, j] if product else np.einsum("ij,ij->i", queries[i], x[j])
        seen[a, b] = True

    def neighbours(rows: np.ndarray, items: np.ndarray) -> np.ndarray:
        new = np.zeros((q, n + 1), dtype=bool)
        step = max(1, 2_000_000 // padded.shape[1])  # a row can be the neighbour of many
        for s in range(0, len(rows), step):
            new[rows[s : s + step, None], padded[items[s : s + step]]] = True
        return new[:, :n]

    first = np.zeros((q, n), dtype=bool)
    first[:, entries] = True
    look(first)
    beam = min(BEAM, n)
    for _ in range(n):
        floor = -np.partition(-sims, beam - 1, axis=1)[:, beam - 1]
        rows, items = np.nonzero(seen & ~expanded & (sims >= floor[:, None]))
        if not len(rows):
            break
        expanded[rows, items] = True
        look(neighbours(rows, items))
    while True:
        rows, items = np.nonzero((sims >= cosine - SLACK) & ~expanded)
        if not len(rows):
            break
        expanded[rows, items] = True
        look(neighbours(rows, items))
    return sims >= cosine


# --- jobs ---------------------------------------------------------------------------------------


def _comparable_vector() -> Column:
    big = F.lit(float("inf"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < big))
    return F.coalesce(F.col("label").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda v: v != 0), F.lit(False))


def comparable() -> Column:
    """Rows that can have links: a label, and a finite vector that is not zero."""
    return _comparable_vector() & F.col("vec_id").isNotNull()


def _named() -> tuple[Column, Column]:
    """128 bits of two hashes that stand for label and vector where rows meet their class, so that vectors are not shuffled again.

    Among n different vectors two agree with odds of n² / 2^129. Null where a row has no class.
    """
    return tuple(F.when(_comparable_vector(), F.xxhash64(F.lit(seed), "label", "embedding")) for seed in (1, 2))


def _centres(classes: DataFrame) -> dict[tuple, np.ndarray]:
    """Centres of the groups (label, dimensions) that need more than one shard, by a few steps of k-means.

    They are fitted on the rows with the smallest hashes of their id, so that every run finds the same ones.
    """
    sizes = classes.groupBy("label", "dims").count().where(F.col("count") > BLOCK)
    largest = sizes.orderBy(F.desc("count"), "label", "dims").limit(MAX_CENTRES // 2)
    large = {(r["label"], r["dims"]): r["count"] for r in largest.collect()}
    total = sum(large.values())
    if not total:
        return {}
    every = 1 << 20
    share = min(1.0, FIT_ROWS / total)
    chosen = classes.where(F.pmod(F.xxhash64("id"), F.lit(every)) < int(share * every)).join(F.broadcast(largest.select("label", "dims")), ["label", "dims"])
    rows = chosen.orderBy(F.xxhash64("id"), "id").limit(2 * FIT_ROWS).toPandas()
    out = {}
    for key, frame in rows.groupby(["label", "dims"]):
        x = unit(frame.sort_values("id")["embedding"])
        k = int(min(len(x), max(2, round(MAX_CENTRES * large[key] / total)), -(-2 * large[key] // BLOCK)))
        centre = x[np.random.default_rng(3).choice(len(x), k, replace=False)]
        for _ in range(5):
            nearest = (x @ centre.T - (centre**2).sum(1) / 2).argmax(1)
            centre = np.stack([x[nearest == c].mean(0) if (nearest == c).any() else centre[c] for c in range(k)])
        out[key] = centre
    return out


def _visits(classes: DataFrame, centres: dict[tuple, np.ndarray], overlap: float, rounds: int = 1, turn: int = 0, full: bool = True) -> DataFrame:
    """(label, dims, shard, own) and, if ``full``, (id, weight, embedding): one row per vector and shard of this turn; own in its nearest one."""
    schema = classes.select("label", "dims").schema.add("shard", "integer").add("own", "boolean")
    columns = ["id", "weight", "embedding"] if full else []
    for f in classes.select(*columns).schema:
        schema = schema.add(f)
    squares = {key: (centre**2).sum(1) for key, centre in centres.items()}
    gaps = {key: np.sqrt(np.maximum(0, squares[key][:, None] + squares[key][None, :] - 2 * centre @ centre.T)) for key, centre in centres.items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, dims = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            none = np.zeros(0, dtype=np.int64)
            row, shard, own = [none], [none], [none.astype(bool)]
            groups: dict[tuple, list[int]] = {}
            for i, key in enumerate(zip(label, dims, strict=True)):
                groups.setdefault(key, []).append(i)
            for key, items in groups.items():
                start = zlib.crc32(repr(key).encode())
                at = np.array(items)
                if key not in centres:
                    if start % rounds == turn:
                        row, shard, own = [*row, at], [*shard, np.zeros_like(at)], [*own, np.ones(len(at), dtype=bool)]
                    continue
                centre = centres[key]
                x = unit(batch.column(2).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1))
                score = x @ centre.T - squares[key] / 2
                first = score.argmax(1)
                margin = (score[np.arange(len(at)), first][:, None] - score) / np.maximum(gaps[key][first], 1e-12)
                a, b = np.nonzero((margin <= overlap) & ((start + np.arange(len(centre))) % rounds == turn))
                row, shard, own = [*row, at[a]], [*shard, b], [*own, b == first[a]]
            at = pa.array(np.concatenate(row))
            out = [batch.column(0).take(at), batch.column(1).take(at), pa.array(np.concatenate(shard), pa.int32()), pa.array(np.concatenate(own))]
            yield pa.RecordBatch.from_arrays(out + [batch.column(i).take(at) for i in (3, 4, 2)[: len(columns)]], names=schema.names)

    return classes.select("label", "dims", "embedding", "id", "weight").mapInArrow(assign, schema)


def _search_block(frame: pd.DataFrame) -> pd.DataFrame:
    """A graph on the block's own vectors, asked by its visitors: per query the weight found, and links to a root that connect all that is linked here."""
    index = frame[frame["indexed"]].sort_values("id", ignore_index=True)
    asked = frame[frame["asks"]].sort_values("id", ignore_index=True)
    if not len(index) or not len(asked):
        return pd.DataFrame({"id": [], "links": [], "root": []}).astype("int64")
    ids, queries = index["id"].to_numpy(), asked["id"].to_numpy()
    x, q = unit(index["embedding"]), unit(asked["embedding"])
    near, entries = build_graph(x)
    width = max(1, max(len(a) for a in near))
    padded = np.full((len(ids), width), len(ids), dtype=np.int64)
    for i, a in enumerate(near):
        padded[i, : len(a)] = a
    weight = index["weight"].to_numpy()
    links = np.zeros(len(queries), dtype=np.int64)
    every = np.unique(np.concatenate((ids, queries)))
    root = np.arange(len(every))
    place, asked_place = np.searchsorted(every, ids), np.searchsorted(every, queries)
    for s in range(0, len(q), 250):
        found = range_search(x, padded, entries, q[s : s + 250])
        found &= ids[None, :] != queries[s : s + 250, None]
        links[s : s + 250] = found @ weight
        for k in np.flatnonzero(found.any(1)).tolist():
            members = np.append(place[found[k]], asked_place[s + k])
            roots = np.unique(root[members])
            if len(roots) > 1:
                root[np.isin(root, roots)] = roots[0]
    out = pd.DataFrame({"id": every, "links": 0, "root": every[root]})
    out.loc[asked_place, "links"] = links
    return out[(out["links"] > 0) | (out["root"] != out["id"])]


def links(classes: DataFrame, overlap: float = OVERLAP) -> DataFrame:
    """(id, links, root) rows: links add up per id; each row with another root is an edge.

    A vector belongs to the graph of its nearest shard and visits all shards in reach, its own included, to search them. Shards
    take turns, so that the vectors handed out at a time are about ``ROUND`` times the table however many visits there are.
    """
    keys = ["label", "dims", "shard"]
    centres = _centres(classes)
    sizes = _visits(classes, centres, overlap, full=False).groupBy(*keys).agg(F.sum(F.col("own").cast("long")).alias("_own"), F.count(F.lit(1)).alias("_all"))
    sizes = sizes.select(*keys, (F.col("_own") / BLOCK).cast("int").alias("_blocks"), (F.col("_all") / ASKERS).cast("int").alias("_asks"), "_own", "_all")
    sizes = saved(sizes)
    total = sizes.agg(F.sum("_own"), F.sum(F.col("_all") * (F.col("_blocks") + 1) + F.col("_own") * F.col("_asks"))).first()
    rounds = min(MAX_ROUNDS, max(1, math.ceil((total[1] or 0) / (ROUND * (total[0] or 1)))))
    large = saved(sizes.where("_blocks > 0 or _asks > 0").drop("_own", "_all"))
    none = F.lit(False)
    out = None
    for turn in range(rounds):
        visits = _visits(classes, centres, overlap, rounds, turn).join(large, keys, "left").fillna(0, ["_blocks", "_asks"])
        place = lambda n: F.pmod(F.xxhash64("id"), F.col(n) + 1).cast("int")
        visits = visits.withColumn("block", place("_blocks")).withColumn("ask", place("_asks"))
        graph = F.transform(F.sequence(F.lit(0), F.col("_asks")), lambda a: F.struct(F.col("block").alias("block"), a.alias("ask"), F.lit(True).alias("indexed"), (a == F.col("ask")).alias("asks")))
        search = F.transform(F.sequence(F.lit(0), F.col("_blocks")), lambda b: F.struct(b.alias("block"), F.col("ask").alias("ask"), none.alias("indexed"), F.lit(True).alias("asks")))
        tasks = F.when(F.col("own"), F.concat(graph, F.filter(search, lambda t: t["block"] != F.col("block")))).otherwise(search)
        each = visits.select(*keys, "id", "weight", "embedding", F.explode(tasks).alias("t")).select(*keys, "t.*", "id", "weight", "embedding")
        found = saved(each.groupBy(*keys, "block", "ask").applyInPandas(_search_block, "id long, links long, root long"))
        out = found if out is None else out.unionByName(found)
    return out


def recall(classes: DataFrame, found: DataFrame, queries: int = AUDIT) -> float:
    """Mean over queries of the share of their links to other vectors that ``found`` holds, by brute force against all classes.

    A query is a class of equal vectors, and links within it do not count, so that copies, which need no search, hide no loss.
    Queries are the at most ``queries`` linked classes, of four times as many with the smallest hashes of their id; 1 if
    none has a link.
    """
    asked = classes.orderBy(F.xxhash64("id"), "id").limit(4 * queries).select("id", "label", "dims", "embedding").toPandas()
    if not len(asked):
        return 1.0
    groups = {key: (f["id"].to_numpy(), unit(f["embedding"])) for key, f in asked.groupby(["label", "dims"])}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for key, part in frame.groupby(["label", "dims"]):
                if key in groups:
                    ids, q = groups[key]
                    near = (q @ unit(part["embedding"]).T >= COSINE) & (ids[:, None] != part["id"].to_numpy()[None, :])
                    yield pd.DataFrame({"id": ids, "n": near @ part["weight"].to_numpy().astype("int64")})

    rows = classes.select("id", "label", "dims", "embedding", "weight")
    true = rows.mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).where("n > 0")
    ids = [int(i) for i in asked["id"]]
    held = found.where(F.col("id").isin(ids)).groupBy("id").agg(F.sum("links").alias("links"))
    both = true.join(held, "id", "left").orderBy(F.xxhash64("id"), "id").limit(queries)
    share = F.least(F.coalesce("links", F.lit(0)) / F.col("n"), F.lit(1.0))
    return both.agg(F.coalesce(F.avg(share), F.lit(1.0))).first()[0]


def near_duplicates(vectors: DataFrame, least_recall: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding, label).

    Rows are compared if their labels are equal and not null; rows with equal labels and vectors are
    one class, linked with each other. Cosines are verified in double precision. If the audit finds a
    recall below ``least_recall``, the search is repeated with twice the overlap, up to three times; a last search that is
    short, too, is an error, not a result.

    A row without a label or vec_id, or whose vector is null, empty, zero or has a null or non-finite
    component, is linked with nothing; its component is its vec_id, and it is kept. Vectors of
    different lengths are not compared. Repeated rows are linked like other copies. An empty table
    gives no rows; other columns are ignored.
    """
    rows = vectors.select("vec_id", "label", "embedding").withColumn("_ok", comparable())
    rows = rows.withColumns(dict(zip(NAME, _named(), strict=True)))
    classes = rows.where("_ok").groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"))
    with shuffles_removed(vectors.sparkSession):
        classes = saved(classes.withColumn("dims", F.size("embedding")))
        overlap = OVERLAP
        for _ in range(3):
            found = links(classes, overlap)
            measured = recall(classes, found)
            if measured >= least_recall:
                break
            overlap *= 2
        else:
            raise RuntimeError(f"recall of {measured:.3f} is below {least_recall}")
        edges = found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))
        counts = found.groupBy("id").agg(F.sum("links").alias("_links"))
        named = classes.select("id", "weight", *[name.alias(n) for n, name in zip(NAME, _named(), strict=True)])
        joined = named.join(counts, "id", "left").join(components(edges), "id", "left")
        about = saved(joined.select(*NAME, (F.col("weight") - 1 + F.coalesce("_links", F.lit(0))).alias("_n"), F.coalesce("component", "id").alias("_component")))
    out = spread_lookup(rows.select("vec_id", *NAME), about, NAME, [F.col("vec_id")])
    out = out.select("vec_id", F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("_component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
