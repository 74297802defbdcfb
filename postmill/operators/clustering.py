"""Density clustering with noise, hierarchical, over distributed vectors.

Follows the published method (Campello, Moulavi and Sander 2013): core distance, mutual
reachability, minimum spanning tree, hierarchy of components, selection by stability. All steps are exact.

How the work is spread:

* Identical vectors become one weighted point.
* Points go to the nearest of a bounded number of pivots; a cell too large for one task is split
  into blocks by hash. Two blocks are compared only if the triangle inequality leaves their cells
  within reach, in one task per pair of blocks, with at most ``2 * block_rows`` points.
* A task returns the nearest neighbours of its points, or a minimum spanning forest of its edges:
  never all pairs. The forests' union has the same components at every radius as all edges have.
* ``density_cut`` needs no forest: at one radius, what is joined already is not compared again.
* One tree is drawn from the forests by Borůvka rounds until what is left fits one task.
* The hierarchy of the tree's edges is built by halves: the lighter half of the edges makes components, which are
  problems of their own and single leaves for the heavier half, until every problem fits a task. Problems
  return clusters, sums and one label per leaf, not their hierarchies.

* Where components at a radius hold all points and lie far apart, ``topics`` proves at two radii that they are what the
  hierarchy would choose (``_settled``) and draws no tree. If that proof fails, as with groups of near copies, a tree is drawn in each component
  (``_drawn``); nothing is compared across components. Else the tree of all points is drawn.

The number of block pairs is what the data's density leaves in reach; without any separation it is
quadratic, as the exact method is.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postmill.operators.components import connected_components
from postmill.operators.skew import HOT_FLOOR, lookup
from postmill.sources.checkpoints import checkpointed

NOISE = -1
MIN_CLUSTER_SIZE = 10
MIN_SAMPLES = 5
BLOCK_ROWS = 1000
MAX_PIVOTS = 1024
TASK_EDGES = 200_000  # edges of a spanning tree that one task works on
SAMPLE = 1024  # points that propose a radius for the proof
MAX_SETTLED = 100  # clusters whose pairs are proved apart
CLOSE_ROWS = 8000  # points of a side where close neighbours are sought
TREE_ROWS = 3000  # points of a side where a component's tree is drawn
ROOT = "root"


@dataclass(frozen=True)
class Cells:
    """The pivots with, per cell, its radius and its number of blocks; at most ``MAX_PIVOTS`` rows."""

    pivots: np.ndarray
    radius: np.ndarray
    blocks: np.ndarray

    def gaps(self) -> np.ndarray:
        """Lower bound of the distance between points of two cells."""
        apart = _distances(self.pivots, self.pivots)
        return np.maximum(apart - self.radius[:, None] - self.radius[None, :], 0.0)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances, rounded to 40 bits so that one distance is the same number in whatever task it is computed."""
    return _rounded((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T))


def _rounded(squares: np.ndarray) -> np.ndarray:
    part, power = np.frexp(np.sqrt(np.maximum(squares, 0.0)))
    return np.ldexp(np.rint(np.ldexp(part, 40)), power - 40)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64)


# --- points, cells, block pairs -----------------------------------------------------------------


def _points(rows: DataFrame, vector: str) -> DataFrame:
    """(point, vector, weight): distinct vectors with their number of copies."""
    return rows.groupBy("point").agg(F.first(vector).alias("vector"), F.count(F.lit(1)).alias("weight"))


def _place(points: DataFrame, block_rows: int, most: int | None = None) -> tuple[DataFrame, Cells]:
    """Assign points to cells and blocks; blocks have ``most`` rows where that is given."""
    wanted = min(MAX_PIVOTS, max(1, -(-points.count() // block_rows)))
    chosen = points.orderBy("point").limit(wanted).select("vector").collect()
    pivots = np.array([r["vector"] for r in chosen], dtype=np.float64)

    @F.pandas_udf("cell int, reach double")
    def nearest(batch: pd.Series) -> pd.DataFrame:
        apart = _distances(_matrix(batch), pivots) if len(batch) else np.zeros((0, 1))
        return pd.DataFrame({"cell": apart.argmin(axis=1), "reach": apart.min(axis=1, initial=np.inf)})

    placed = checkpointed(points.withColumn("_c", nearest("vector")).select("point", "vector", "weight", "_c.*"))
    stats = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("radius")).collect()
    radius, blocks = np.zeros(len(pivots)), np.zeros(len(pivots), dtype=int)
    for r in stats:
        radius[r["cell"]], blocks[r["cell"]] = r["radius"] + 1e-9, -(-r["n"] // (most or block_rows))
    sizes = F.array(*[F.lit(int(b)) for b in blocks])
    block = F.pmod(F.xxhash64("point"), F.get(sizes, F.col("cell"))).cast("int")
    return placed.withColumn("block", block), Cells(pivots, radius, blocks)


def _paired(points: DataFrame, cells: Cells, in_reach: np.ndarray) -> DataFrame:
    """Points repeated for every pair of blocks they take part in (``pair``, ``side``).

    The partner table has one entry per pair of cells in reach, so its size is bounded by the
    number of pivots; blocks are enumerated from it in the tasks.
    """
    spark = points.sparkSession
    partners = [
        (int(i), [(int(j), int(cells.blocks[j])) for j in np.flatnonzero(in_reach[i]) if cells.blocks[j]])
        for i in range(len(cells.blocks))
        if cells.blocks[i]
    ]
    table = spark.createDataFrame(partners, "cell int, partners array<struct<other:int,blocks:int>>")
    each = points.join(F.broadcast(table), "cell").withColumn("_p", F.explode("partners")).drop("partners")
    each = each.withColumn("_b", F.explode(F.sequence(F.lit(0), F.col("_p.blocks") - 1)))
    own = F.struct(F.col("cell").alias("c"), F.col("block").alias("b"))
    other = F.struct(F.col("_p.other").alias("c"), F.col("_b").alias("b"))
    pair = F.struct(F.least(own, other).alias("low"), F.greatest(own, other).alias("high"))
    return each.select(
        *[c for c in points.columns if c not in ("cell", "block")],
        pair.cast("string").alias("pair"),
        (own > other).cast("int").alias("side"),
        (own == other).alias("same"),
    )


# --- core distances -----------------------------------------------------------------------------


def _neighbours(paired: DataFrame, k: int) -> DataFrame:
    """(point, distance, weight): for each pair of blocks, every point's k nearest on the other side."""

    def nearest(group: pd.DataFrame) -> pd.DataFrame:
        x, ids, weight = _matrix(group["vector"]), group["point"].to_numpy(), group["weight"].to_numpy()
        apart = _distances(x, x)
        if group["same"].iloc[0]:
            np.fill_diagonal(apart, np.inf)
        else:
            side = group["side"].to_numpy()
            apart[side[:, None] == side[None, :]] = np.inf
        most = min(k, len(x))
        near = np.argpartition(apart, most - 1, axis=1)[:, :most]
        rows = np.repeat(np.arange(len(x)), near.shape[1])
        out = pd.DataFrame(
            {"point": ids[rows], "distance": apart[rows, near.ravel()], "weight": weight[near.ravel()]}
        )
        return out[np.isfinite(out["distance"])]

    return paired.groupBy("pair").applyInPandas(nearest, "point string, distance double, weight long")


def _kth(points: DataFrame, neighbours: DataFrame, k: int) -> DataFrame:
    """(point, core): distance at which the copies and neighbours of a point add up to k.

    At most k rows per point are kept, already in the map tasks.
    """
    copies = points.where("weight > 1").select("point", F.lit(0.0).alias("distance"), (F.col("weight") - 1).alias("weight"))
    order = Window.partitionBy("point").orderBy("distance", F.desc("weight"))
    ranked = neighbours.unionByName(copies).withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)
    reached = ranked.withColumn("_sum", F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return reached.groupBy("point").agg(F.min(F.when(F.col("_sum") >= k, F.col("distance"))).alias("core"))


def _core_distances(points: DataFrame, cells: Cells, k: int) -> DataFrame:
    """Points with ``core``. Neighbours inside the own cell bound how far other cells matter."""
    inside = np.eye(len(cells.blocks), dtype=bool)
    local = checkpointed(_neighbours(_paired(points, cells, inside), k))
    bound = points.join(_kth(points, local, k), "point", "left")
    limits = np.zeros(len(cells.blocks))
    for r in bound.groupBy("cell").agg(F.max(F.coalesce("core", F.lit(float("inf")))).alias("m")).collect():
        limits[r["cell"]] = r["m"]
    gaps = cells.gaps()
    reach = (gaps <= np.maximum(limits[:, None], limits[None, :])) & ~inside
    found = local
    if reach.any():
        found = local.unionByName(_neighbours(_paired(points, cells, reach), k))
    return points.join(_kth(points, found, k), "point", "left")


# --- edges --------------------------------------------------------------------------------------


def _spanning_forest(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning forest of a dense weight matrix; infinite weights are no edges."""
    n = len(weights)
    best, source = np.full(n, np.inf), np.full(n, -1)
    outside = np.ones(n, dtype=bool)
    src, dst, cost = [], [], []
    for _ in range(n):
        node = int(np.where(outside, best, np.inf).argmin())
        if not outside[node] or not np.isfinite(best[node]):
            node = int(outside.argmax())
        else:
            src.append(source[node]), dst.append(node), cost.append(best[node])
        outside[node] = False
        closer = weights[node] < best
        best[closer], source[closer] = weights[node][closer], node
    return np.array(src, dtype=int), np.array(dst, dtype=int), np.array(cost)


def _edges(points: DataFrame, cells: Cells, radius: float) -> DataFrame:
    """(src, dst, weight): edges up to the radius that connect whatever all such edges connect."""

    def forest(group: pd.DataFrame) -> pd.DataFrame:
        x, ids, core = _matrix(group["vector"]), group["point"].to_numpy(), group["core"].to_numpy()
        weights = np.maximum(_distances(x, x), np.maximum(core[:, None], core[None, :]))
        weights[weights > radius] = np.inf
        if not group["same"].iloc[0]:
            side = group["side"].to_numpy()
            weights[side[:, None] == side[None, :]] = np.inf
        np.fill_diagonal(weights, np.inf)
        src, dst, cost = _spanning_forest(weights)
        return pd.DataFrame({"src": ids[src], "dst": ids[dst], "weight": cost})

    dense = points.where(F.col("core") <= radius)
    paired = _paired(dense.select("point", "vector", "core", "cell", "block"), cells, cells.gaps() <= radius)
    return paired.groupBy("pair").applyInPandas(forest, "src string, dst string, weight double")


# --- one radius ---------------------------------------------------------------------------------


def _prepare(rows: DataFrame, key: str, vector: str) -> DataFrame:
    typed = rows.select(F.col(key), F.col(vector).cast("array<double>").alias("_v"))
    return typed.withColumn("point", F.md5(F.col("_v").cast("string")))


def _largest_first(sizes: DataFrame, id_column: str) -> DataFrame:
    """(id_column, topic_id): 0, 1, … by descending size; the parts of a sorted table are numbered each by itself."""
    ordered = sizes.orderBy(F.desc("size"), id_column).withColumn("_part", F.spark_partition_id())
    ordered = checkpointed(ordered.select(id_column, "size", "_part"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(F.desc("size"), id_column))
    numbered = ordered.withColumn("_rank", rank).join(parts, "_part")
    return numbered.select(id_column, (F.col("_before") + F.col("_rank") - 1).cast("int").alias("topic_id"))


def _ask(askers: DataFrame, targets: DataFrame, cells: Cells, radius: float, most: int, answer, schema: str) -> DataFrame | None:
    """``answer`` for every group of askers and targets that may lie within the radius; null if there is none.

    Askers and targets have a ``rank``, -1 or from 0. A target's group is its cell and rank. Askers ask the
    groups of smaller ranks, those of rank -1 all, if the distance to the group's pivot leaves a target in reach. Groups
    number at most the cells times the ranks; both sides are cut into parts of about ``most``.
    """
    stats = targets.groupBy("cell", "rank").agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("reach")).orderBy("cell", "rank").collect()
    if not stats:
        return None
    cell, rank = np.array([r["cell"] for r in stats]), np.array([r["rank"] for r in stats])
    limit = radius + np.array([r["reach"] for r in stats]) + 1e-9
    pivots = cells.pivots

    @F.pandas_udf("array<int>")
    def asked(vectors: pd.Series, ranks: pd.Series) -> pd.Series:
        out = []
        for start in range(0, len(vectors), 500):
            own = ranks.iloc[start : start + 500].to_numpy()[:, None]
            apart = _distances(_matrix(vectors.iloc[start : start + 500]), pivots)[:, cell]
            wanted = (apart <= limit) & ((own == -1) | ((rank >= 0) & (rank < own)))
            out += [np.flatnonzero(w).astype(np.int32) for w in wanted]
        return pd.Series(out, dtype=object)

    asks = checkpointed(askers.withColumn("g", F.explode(asked("vector", "rank"))).select("point", "vector", "weight", "comp", "g"))
    chunks = [0] * len(stats)
    for r in asks.groupBy("g").count().collect():
        chunks[r["g"]] = -(-r["count"] // most)
    if not any(chunks):
        return None
    names = [(i, r["cell"], r["rank"], -(-r["n"] // most), chunks[i]) for i, r in enumerate(stats) if chunks[i]]
    groups = F.broadcast(targets.sparkSession.createDataFrame(names, "g int, cell int, rank int, blocks int, chunks int"))
    part = lambda n: F.pmod(F.xxhash64("point"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["point", "vector", "weight", "comp", "g", "block", "chunk"]
    left = asks.join(groups, "g").withColumn("chunk", part("chunks")).withColumn("block", every("blocks")).select(*columns, F.lit(True).alias("asks"))
    right = targets.drop("block").join(groups, ["cell", "rank"]).withColumn("block", part("blocks")).withColumn("chunk", every("chunks"))
    both = left.unionByName(right.select(*columns, F.lit(False).alias("asks")))
    return both.groupBy("g", "block", "chunk").applyInPandas(answer, schema)


def _dense(points: DataFrame, cells: Cells, radius: float, k: int, most: int) -> DataFrame:
    """The points whose copies and neighbours within the radius add up to k. Those that their own block does not settle ask all blocks in reach."""

    def count(group: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(group["vector"])
        near = _distances(x, x) <= radius
        np.fill_diagonal(near, True)
        return group.assign(near=near @ group["weight"].to_numpy() - 1)

    def asked(group: pd.DataFrame) -> pd.DataFrame:
        ask, own = group[group["asks"]], group[~group["asks"]]
        if not len(ask) or not len(own):
            return pd.DataFrame({"point": [], "near": []}, dtype=object).astype({"near": "int64"})
        near = _distances(_matrix(ask["vector"]), _matrix(own["vector"])) <= radius
        near[ask["point"].to_numpy()[:, None] == own["point"].to_numpy()[None, :]] = False
        return pd.DataFrame({"point": ask["point"].to_numpy(), "near": near @ own["weight"].to_numpy()})

    kinds = "point string, vector array<double>, weight long, cell int, reach double, block int, near long"
    found = checkpointed(points.select("point", "vector", "weight", "cell", "reach", "block").groupBy("cell", "block").applyInPandas(count, kinds))
    dense, open_ = found.where(F.col("near") >= k), found.where(F.col("near") < k)
    if open_.isEmpty():
        return dense.drop("near")
    marks = [F.lit(-1).alias("rank"), F.lit(None).cast("string").alias("comp")]
    more = _ask(open_.select("*", *marks), found.select("*", *marks), cells, radius, most, asked, "point string, near long")
    settled = more.groupBy("point").agg(F.sum("near").alias("_more")) if more is not None else None
    if settled is not None:
        late = open_.join(settled, "point").where(F.col("_more") + F.col("weight") - 1 >= k).drop("_more")
        dense = checkpointed(dense.unionByName(late))
    return dense.drop("near")


def _links(near: np.ndarray, own: np.ndarray, other: np.ndarray) -> pd.DataFrame:
    """Links (src, dst) that join whatever components the near pairs of rows join."""
    names, codes = np.unique(np.concatenate((own, other)).astype(str), return_inverse=True)
    a, b = codes[: len(own)], codes[len(own) :]
    label, out = np.arange(len(names)), []
    for i in range(len(own)):
        home = label[a[i]]
        for far in np.unique(label[b[near[i]]]):
            if far != home:
                out.append((names[home], names[far]))
                label[label == far] = home
    return pd.DataFrame(out, columns=["src", "dst"], dtype=object)


def _merged(members: DataFrame, links: DataFrame, floor: int) -> DataFrame:
    """The members with their components renamed to what the links join them to."""
    labels = checkpointed(connected_components(links, floor))
    n = labels.count()
    if not n:
        return members
    names = labels.select(F.col("id").alias("comp"), F.col("component").alias("_comp"))
    found = members.join(F.broadcast(names), "comp", "left") if n < floor else lookup(members, names, "comp", ["point"], floor=floor)
    return checkpointed(found.withColumn("comp", F.coalesce("_comp", "comp")).select(*members.columns))


def _joined(dense: DataFrame, cells: Cells, radius: float, most: int, floor: int) -> DataFrame:
    """Dense points with ``comp``, their component at the radius.

    Hubs, one dense point of each cell, join what lies within the radius of them. What a block's points join
    follows. Then points of components without hub, and those of the smaller ones of the components with hubs, are
    compared with the points of other components that they may reach: no link between two components is missed.
    """
    hubs = dense.groupBy("cell").agg(F.min(F.struct("reach", "point", "vector")).alias("hub")).select("hub.*").orderBy("point").collect()
    if not hubs:
        return dense.withColumn("comp", F.col("point"))
    centres, n = np.array([h["vector"] for h in hubs], dtype=np.float64), len(hubs)

    @F.pandas_udf("hub int, roots array<int>")
    def attached(vectors: pd.Series) -> pd.DataFrame:
        hub, root = np.zeros(len(vectors), dtype=np.int32), np.arange(n, dtype=np.int32)
        for start in range(0, len(vectors), 500):
            near = _distances(_matrix(vectors.iloc[start : start + 500]), centres) <= radius
            first = np.where(near.any(1), near.argmax(1), -1)
            hub[start : start + len(near)] = first
            for row in near[first >= 0]:
                if (old := np.unique(root[row])).size > 1:
                    root[np.isin(root, old)] = old[0]
        return pd.DataFrame({"hub": hub, "roots": [root if i == 0 else None for i in range(len(vectors))]})

    found = checkpointed(dense.withColumn("_h", attached("vector")).select(*dense.columns, "_h.*"))
    pairs = found.where("roots is not null").select(F.posexplode("roots").alias("a", "b")).where("a <> b").distinct().collect()
    root = np.arange(n)
    for a, b in ((int(r["a"]), int(r["b"])) for r in pairs):
        root[root == root[a]] = root[b]
    homes = F.array(*[F.lit(hubs[int(r)]["point"]) for r in root])
    found = found.withColumn("comp", F.when(F.col("hub") >= 0, F.get(homes, F.col("hub"))).otherwise(F.col("point"))).drop("hub", "roots")

    def inside(group: pd.DataFrame) -> pd.DataFrame:
        comp = group["comp"].to_numpy()
        if (comp == comp[0]).all():
            return _links(np.zeros((0, 0), dtype=bool), comp[:0], comp[:0])
        x = _matrix(group["vector"])
        return _links(_distances(x, x) <= radius, comp, comp)

    def between(group: pd.DataFrame) -> pd.DataFrame:
        ask, own = group[group["asks"]], group[~group["asks"]]
        if not len(ask) or not len(own):
            return _links(np.zeros((0, 0), dtype=bool), ask["comp"].to_numpy()[:0], own["comp"].to_numpy()[:0])
        near = _distances(_matrix(ask["vector"]), _matrix(own["vector"])) <= radius
        return _links(near, ask["comp"].to_numpy(), own["comp"].to_numpy())

    mixed = found.groupBy("cell", "block").agg(F.min("comp").alias("_a"), F.max("comp").alias("_b")).where("_a <> _b").select("cell", "block")
    links = found.join(F.broadcast(mixed), ["cell", "block"], "left_semi").groupBy("cell", "block").applyInPandas(inside, "src string, dst string")
    found = _merged(found, links, floor)

    points = [h["point"] for h in hubs]
    tops = found.where(F.col("point").isin(points)).select("comp").distinct()
    sizes = found.join(F.broadcast(tops), "comp", "left_semi").groupBy("comp").count().orderBy(F.desc("count"), "comp").collect()
    table = found.sparkSession.createDataFrame([(r["comp"], i) for i, r in enumerate(sizes)], "comp string, rank int")
    ranked = found.join(F.broadcast(table), "comp", "left").withColumn("rank", F.coalesce("rank", F.lit(-1)))
    askers = ranked.where("rank <> 0")  # none asks if all are one component
    links = _ask(askers, ranked, cells, radius, most, between, "src string, dst string")
    return found if links is None else _merged(found, links, floor)


def density_cut(
    rows: DataFrame,
    key: str,
    vector: str,
    radius: float,
    min_cluster_size: int = MIN_CLUSTER_SIZE,
    min_samples: int = MIN_SAMPLES,
    block_rows: int = BLOCK_ROWS,
    floor: int = HOT_FLOOR,
) -> DataFrame:
    """(key, topic_id) at one radius: components of dense points, small ones and the rest −1.

    At one radius no distance is needed beyond what settles a point or a component: a block's own points settle
    most, points near a common hub are joined by it, and only points that are still open, or that other components may
    reach, are compared further.
    """
    keyed = _prepare(rows, key, vector)
    most = max(block_rows, min(20 * block_rows, BLOCK_ROWS))
    points, cells = _place(_points(keyed, "_v"), block_rows, most)
    member = _joined(_dense(points, cells, radius, min_samples, most), cells, radius, most, floor)
    return _numbered(keyed, key, member.select("point", "weight", F.col("comp").alias("component")), min_cluster_size, floor)


# --- spanning tree ------------------------------------------------------------------------------


def _kruskal(ends: list[tuple[str, str]]) -> list[int]:
    """Which of the edges, in their order, join two components."""
    above: dict[str, str] = {}

    def root(x: str) -> str:
        while (up := above.get(x, x)) != x:
            above[x] = x = above.get(up, up)
        return x

    kept = []
    for i, (a, b) in enumerate(ends):
        a, b = root(a), root(b)
        if a != b:
            above[a] = b
            kept.append(i)
    return kept


def spanning_forest(edges: DataFrame, floor: int = HOT_FLOOR, most: int = TASK_EDGES) -> DataFrame:
    """The minimum spanning forest of edges (src, dst, weight); equal weights in the order of the ends.

    While there are more than ``most`` edges, each node takes its lightest edge, what these edges connect becomes
    one node, and inner edges vanish; every round at least halves the nodes and is written out. The
    rest is done in one task.
    """
    low, high = F.least("src", "dst"), F.greatest("src", "dst")
    open_ = checkpointed(edges.select(low.alias("src"), high.alias("dst"), "weight", low.alias("u"), high.alias("v")))
    order = F.struct("weight", "src", "dst", "u", "v")
    taken, left = [], open_.count()
    while left > most:
        both = open_.select("u", order.alias("e")).unionByName(open_.select(F.col("v").alias("u"), order.alias("e")))
        lightest = checkpointed(both.groupBy("u").agg(F.min("e").alias("e")).select("e.*").distinct())
        taken.append(lightest.select("src", "dst", "weight"))
        labels = checkpointed(connected_components(lightest.select(F.col("u").alias("src"), F.col("v").alias("dst")), floor))
        for end in ("u", "v"):
            names = labels.select(F.col("id").alias(end), "component")
            open_ = lookup(open_, names, end, ["src", "dst"], floor=floor, rows=left).withColumn(end, F.coalesce("component", end)).drop("component")
        open_ = checkpointed(open_.where("u <> v"))
        left = open_.count()

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["weight", "src", "dst"])
        kept = _kruskal(list(zip(group["u"], group["v"], strict=True)))
        return group.iloc[kept][["src", "dst", "weight"]]

    rest = open_.withColumn("_all", F.lit("all")).groupBy("_all").applyInPandas(finish, "src string, dst string, weight double")
    for part in taken:
        rest = rest.unionByName(part)
    return checkpointed(rest)


def _spanning_tree(points: DataFrame, n: int, cells: Cells, floor: int, most: int) -> DataFrame:
    """The minimum spanning tree of mutual reachability of n points. The radius within which cells are compared grows until it holds.

    A forest over the edges up to a radius is part of the tree, so later rounds only add to what the first one found.
    """
    found = None
    few = int(cells.blocks.sum()) ** 2 <= 64
    radius = np.inf if few else 2 * (points.agg(F.max("core")).first()[0] or np.inf)
    while True:
        edges = _edges(points, cells, radius)
        found = spanning_forest(edges if found is None else edges.unionByName(found), floor, most)
        if not np.isfinite(radius) or found.count() >= n - 1:
            return found
        radius = 4 * radius if radius < 2 * float(_distances(cells.pivots, cells.pivots).max() + cells.radius.max()) else np.inf


# --- hierarchy ----------------------------------------------------------------------------------


def _problems(tree: DataFrame, points: DataFrame, n: int, floor: int, most: int) -> tuple[DataFrame, DataFrame]:
    """The tree's edges (problem, a, b, weight, place) and leaves (problem, leaf, size, core), no problem with more than ``most`` edges.

    The lighter half of a problem's edges splits it into components. Each is a problem of its own, and a leaf of the
    problem that keeps the name and the heavier half. ``core`` is null for such leaves. Edges of one weight stay together
    unless they alone are more than ``most``.
    """
    ordered = tree.orderBy("weight", "src", "dst").withColumn("place", F.monotonically_increasing_id())
    edges = checkpointed(ordered.select(F.lit(ROOT).alias("problem"), F.col("src").alias("a"), F.col("dst").alias("b"), "weight", "place"))
    leaves = points.select(F.lit(ROOT).alias("problem"), F.col("point").alias("leaf"), F.col("weight").alias("size"), "core")
    depth = 0
    while n > most:
        middle = [F.percentile_approx(c, 0.5).alias(f"middle_{c}") for c in ("weight", "place")]
        large = edges.groupBy("problem").agg(F.count(F.lit(1)).alias("n"), F.min("weight").alias("low"), F.max("weight").alias("high"), *middle)
        large = checkpointed(large.where(F.col("n") > most).drop("n"))
        if large.isEmpty():
            break
        depth += 1
        light = (
            F.when(F.col("middle_weight") < F.col("high"), F.col("weight") <= F.col("middle_weight"))
            .when(F.col("low") < F.col("high"), F.col("weight") < F.col("high"))
            .otherwise(F.col("place") <= F.col("middle_place"))
        )
        marked = lookup(edges, large, "problem", ["a", "b"], floor=floor).withColumn("light", F.coalesce(light, F.lit(False)))
        marked = checkpointed(marked.select(*edges.columns, "light"))
        parts = connected_components(marked.where("light").select(F.col("a").alias("src"), F.col("b").alias("dst")), floor)
        parts = checkpointed(parts.select(F.col("id").alias("leaf"), F.concat("component", F.lit(f":{depth}")).alias("part")))
        for end in ("a", "b"):
            marked = lookup(marked, parts.withColumnRenamed("leaf", end).withColumnRenamed("part", f"part_{end}"), end, ["place"], floor=floor)
        light, heavy = marked.where("light"), marked.where("not light")
        light = light.select(F.col("part_a").alias("problem"), "a", "b", "weight", "place")
        heavy = heavy.select("problem", F.coalesce("part_a", "a").alias("a"), F.coalesce("part_b", "b").alias("b"), "weight", "place")
        edges = checkpointed(light.unionByName(heavy))
        placed = checkpointed(leaves.join(parts, "leaf", "left"))
        inner = placed.select(F.coalesce("part", "problem").alias("problem"), "leaf", "size", "core")
        outer = placed.where("part is not null").groupBy("problem", F.col("part").alias("leaf")).agg(F.sum("size").alias("size"), F.lit(None).cast("double").alias("core"))
        leaves = checkpointed(inner.unionByName(outer))
    return edges, leaves


_FOUND = "kind string, name string, label string, amount double"


def _condense(min_cluster_size: int):
    """One problem: the cluster of each leaf, the clusters born, and what every cluster's stability gains.

    Edges of one weight join their sides at once. Where two or more sides are large, each founds a cluster;
    otherwise the large side goes on. Small sides fall out. The problem's own top has the label ``^problem``, to be
    replaced by the cluster that holds the problem as a leaf.
    """

    def density(weight: float) -> float:
        return 1.0 / max(weight, 1e-12)

    def condense(key: tuple, edges: pd.DataFrame, leaves: pd.DataFrame) -> pd.DataFrame:
        edges = edges.sort_values("place")
        names, sizes = leaves["leaf"].tolist(), leaves["size"].tolist()
        number = {name: i for i, name in enumerate(names)}
        above, sides, weights = list(range(len(names))), [[] for _ in names], [0.0] * len(names)
        last, begin = None, 0
        for a, b, w, place in zip(*(edges[c].tolist() for c in ("a", "b", "weight", "place")), strict=True):
            if w != last:
                last, begin = w, len(names)  # nodes from here on are of this weight
            x, y = number[a], number[b]
            while above[x] != x:
                above[x] = x = above[above[x]]
            while above[y] != y:
                above[y] = y = above[above[y]]
            x, y = max(x, y), min(x, y)
            if x < begin:
                names.append(f"e{place}"), sizes.append(sizes[x]), weights.append(w), sides.append([x])
                above[x] = len(above)
                x = above[x]
                above.append(x)
            sides[x] += sides[y] if y >= begin else [y]
            if y >= begin:
                sides[y] = []  # this node is part of the other
            sizes[x] += sizes[y]
            above[y] = x
        label = [f"^{key[0]}"] * len(names)
        gains: dict[str, float] = {}
        out = []
        for node in range(len(names) - 1, len(leaves) - 1, -1):
            own, at = label[node], density(weights[node])
            split = sum(sizes[x] >= min_cluster_size for x in sides[node]) > 1
            for x in sides[node]:
                founds = split and sizes[x] >= min_cluster_size
                label[x] = names[x] if founds else own
                if founds:
                    out.append(("born", names[x], own, -sizes[x] * at))
                if founds or sizes[x] < min_cluster_size <= sizes[node]:
                    gains[own] = gains.get(own, 0.0) + sizes[x] * at
        for name, own, size, core in zip(names, label, leaves["size"].tolist(), leaves["core"].tolist(), strict=False):
            out.append(("problem" if core is None or core != core else "point", name, own, 0.0))
            if out[-1][0] == "point" and size >= min_cluster_size:  # copies that are a cluster by themselves
                gains[own] = gains.get(own, 0.0) + size * density(core)
        out += [("gain", None, own, gain) for own, gain in gains.items()]
        return pd.DataFrame(out, columns=["kind", "name", "label", "amount"])

    return condense


def _resolved(found: DataFrame, floor: int) -> DataFrame:
    """Labels ``^problem`` replaced by the cluster that the problem lies in; problems nest as often as they were halved."""
    if found.where("kind = 'problem'").isEmpty():
        return found.withColumn("label", F.when(F.col("label") == f"^{ROOT}", ROOT).otherwise(F.col("label")))
    outer = found.where("kind = 'problem'").select(F.concat(F.lit("^"), "name").alias("problem"), "label")
    top = found.sparkSession.createDataFrame([(f"^{ROOT}", ROOT)], "problem string, label string")
    outer = checkpointed(outer.unionByName(top))
    while not outer.where(F.col("label").startswith("^")).isEmpty():
        ahead = outer.select(F.col("problem").alias("label"), F.col("label").alias("_next"))
        outer = checkpointed(outer.join(ahead, "label", "left").select("problem", F.coalesce("_next", "label").alias("label")))
    whole = outer.select(F.col("problem").alias("label"), F.col("label").alias("_cluster"))
    return lookup(found, whole, "label", ["kind", "name"], floor=floor).withColumn("label", F.coalesce("_cluster", "label")).drop("_cluster")


# --- clusters that need no tree -----------------------------------------------------------------


def _proposed(vectors: np.ndarray, k: int) -> float | None:
    """A radius in the widest gap between the weights of a sample's tree; null if there is no wide one."""
    if len(vectors) < 2 * (k + 1):
        return None
    apart = _distances(vectors, vectors)
    core = np.partition(apart, k, axis=1)[:, k]
    reach = np.maximum(apart, np.maximum(core[:, None], core[None, :]))
    np.fill_diagonal(reach, np.inf)
    weights = np.sort(_spanning_forest(reach)[2])[-MAX_SETTLED:]
    wider = weights[1:] / np.maximum(weights[:-1], 1e-12)
    at = int(wider.argmax())
    return 1.1 * float(weights[at]) if wider[at] > 2.5 and weights[at] > 0 else None


def _apart(member: DataFrame, comps: list[str], centres: np.ndarray) -> float:
    """A lower bound of the distance between points of different components: the least gap along the line of two centres."""
    place = {c: i for i, c in enumerate(comps)}
    lines = centres[None, :, :] - centres[:, None, :]
    lengths = np.sqrt((lines * lines).sum(2))
    np.fill_diagonal(lengths, 1.0)
    if lengths.min() <= 0:
        return 0.0
    lines /= lengths[:, :, None]

    def furthest(batches):
        most = np.full(lengths.shape, -np.inf)
        for batch in batches:
            for comp, own in batch.groupby("comp"):
                i = place[comp]
                most[i] = np.maximum(most[i], (_matrix(own["vector"]) @ lines[i].T).max(0))
        a, b = np.nonzero(np.isfinite(most))
        yield pd.DataFrame({"a": a.astype(np.int32), "b": b.astype(np.int32), "most": most[a, b]})

    found = member.select("comp", "vector").mapInPandas(furthest, "a int, b int, most double")
    most = np.full(lengths.shape, np.inf)
    for r in found.groupBy("a", "b").agg(F.max("most").alias("most")).collect():
        most[r["a"], r["b"]] = r["most"]
    gaps = -most - most.T
    np.fill_diagonal(gaps, np.inf)
    return float(gaps.min()) - 1e-9 * (1.0 + float(np.abs(centres).max()))


def _inside(member: DataFrame, sizes: dict[str, int], rows: int, column: str) -> DataFrame:
    """Points repeated for every pair (``low``, ``high``) of blocks of their component ``c``."""
    names = [(c, i, -(-n // rows)) for i, (c, n) in enumerate(sizes.items())]
    table = F.broadcast(member.sparkSession.createDataFrame(names, "comp string, c int, blocks int"))
    each = member.select("point", "vector", column, "comp").join(table, "comp")
    each = each.withColumn("a", F.pmod(F.xxhash64("point"), F.col("blocks")).cast("int"))
    each = each.withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = [F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")]
    return each.select("point", "vector", column, "c", *pair, (F.col("a") > F.col("b")).cast("int").alias("side"), (F.col("a") == F.col("b")).alias("same"))


def _close(member: DataFrame, sizes: dict[str, int], radius: float, k: int) -> DataFrame:
    """(point, distance, weight): for each pair of a component's blocks, every point's k nearest within the radius."""

    def nearest(own: np.ndarray, other: np.ndarray, ids: np.ndarray, weight: np.ndarray, same: bool) -> pd.DataFrame:
        squares, out = (other * other).sum(1), []
        for start in range(0, len(own), 500):
            part = own[start : start + 500]
            square = (part * part).sum(1)[:, None] + squares[None, :] - 2.0 * (part @ other.T)
            if same:
                square[np.arange(len(part)), start + np.arange(len(part))] = np.inf
            a, b = np.nonzero(square <= limit)
            hits = pd.DataFrame({"at": a, "distance": np.sqrt(np.maximum(square[a, b] - slack, 0.0)), "weight": weight[b]})
            hits = hits.sort_values(["at", "distance"]).groupby("at").head(k)
            out.append(pd.DataFrame({"point": ids[start + hits["at"].to_numpy()], "distance": hits["distance"].to_numpy(), "weight": hits["weight"].to_numpy()}))
        return pd.concat(out) if out else pd.DataFrame({"point": [], "distance": [], "weight": []})

    slack = 1e-9 * (1.0 + radius * radius)
    limit = radius * radius + slack

    def search(group: pd.DataFrame) -> pd.DataFrame:
        x, ids, weight = _matrix(group["vector"]), group["point"].to_numpy(), group["weight"].to_numpy()
        x = x - x.mean(0)
        if group["same"].iloc[0]:
            return nearest(x, x, ids, weight, True)
        a = group["side"].to_numpy() == 0
        return pd.concat((nearest(x[a], x[~a], ids[a], weight[~a], False), nearest(x[~a], x[a], ids[~a], weight[a], False)))

    return _inside(member, sizes, CLOSE_ROWS, "weight").groupBy("c", "low", "high").applyInPandas(search, "point string, distance double, weight long")


@dataclass(frozen=True)
class Apart:
    """All points with ``comp``, their component at a radius, and the rows of each component.

    Points of different components are at least ``low`` apart, and from each component to some other it is at most ``high``.
    """

    member: DataFrame
    sizes: list
    radius: float
    low: float
    high: float

    def counts(self) -> dict[str, int]:
        return {r["comp"]: r["n"] for r in self.sizes}


def _separated(points: DataFrame, cells: Cells, k: int, min_cluster_size: int, most: int, floor: int) -> Apart | None:
    """The components at a radius r that a sample proposes, if all points are dense there and lie in at least two components of
    enough rows that are R >= 2r apart; else null.
    """
    sample = points.orderBy("point").limit(SAMPLE).select("vector").collect()
    radius = _proposed(np.array([r["vector"] for r in sample], dtype=np.float64), k)
    if radius is None:
        return None
    dense = checkpointed(_dense(points, cells, radius, k, most))
    if dense.count() < points.count():
        return None
    member = checkpointed(_joined(dense, cells, radius, most, floor))
    sizes = member.groupBy("comp").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("size")).orderBy("comp").limit(MAX_SETTLED + 1).collect()
    if not 2 <= len(sizes) <= MAX_SETTLED or min(r["size"] for r in sizes) < min_cluster_size:
        return None
    comps, some = [r["comp"] for r in sizes], {}
    for r in member.orderBy("point").limit(SAMPLE).select("comp", "vector").collect():
        some.setdefault(r["comp"], []).append(r["vector"])
    if len(some) < len(comps):
        return None
    low = _apart(member, comps, np.array([np.mean(some[c], axis=0) for c in comps]))
    if low < 2.01 * radius:
        return None
    vectors, owner = np.array([v for c in comps for v in some[c]]), np.repeat(np.arange(len(comps)), [len(some[c]) for c in comps])
    across = np.where(owner[:, None] == owner[None, :], np.inf, _distances(vectors, vectors)).min(1)
    return Apart(member, sizes, radius, low, max(float(across[owner == i].min()) for i in range(len(comps))) * (1 + 1e-9))


def _settled(points: DataFrame, cells: Cells, k: int, min_cluster_size: int, most: int, floor: int) -> DataFrame | None:
    """(point, weight, component) if separated components are provably the chosen clusters, with no noise; null if that is not proved."""
    apart = _separated(points, cells, k, min_cluster_size, most, floor)
    return _proved(apart, k, min_cluster_size) if apart else None


def _proved(apart: Apart, k: int, min_cluster_size: int) -> DataFrame | None:
    """(point, weight, component) if the components are provably the chosen clusters; null if that is not proved.

    A component is a cluster born beyond R that is whole down to r, so its
    stability is at least 1/r - 1/R per row. Clusters that hold several split beyond R: they have less than 1/R per row,
    which is no more. Clusters inside are born within r, and a row leaves them at its core distance at the latest (or, of
    less than a cluster's copies, at its nearest other point), so they have at most the mean of 1/core - 1/r together.
    Only close neighbours are needed to bound that mean from above.
    """
    member = apart.member
    allowed = 0.999 * (2 / apart.radius - 1 / apart.low)  # of the mean of 1/core
    close = 1.05 / allowed
    found = checkpointed(_close(member, apart.counts(), close, k))
    core = _kth(member, found, k).where(F.col("core").isNotNull())
    near = found.groupBy("point").agg(F.min("distance").alias("nearest"))
    least = F.when(F.col("weight") < min_cluster_size, F.greatest("core", F.coalesce("nearest", F.lit(close)))).otherwise(F.col("core"))
    some = member.select("point", "weight", "comp").join(core, "point").join(near, "point", "left")
    some = some.groupBy("comp").agg(F.sum("weight").alias("rows"), F.sum(F.col("weight") / F.greatest(least, F.lit(1e-12))).alias("most")).collect()
    counted = {r["comp"]: r for r in some}
    for r in apart.sizes:
        rows, total = (counted[r["comp"]]["rows"], counted[r["comp"]]["most"]) if r["comp"] in counted else (0, 0.0)
        if total + (r["size"] - rows) / close >= allowed * r["size"]:
            return None
    return member.select("point", "weight", F.col("comp").alias("component"))


# --- a tree in each component -------------------------------------------------------------------


def _nearest_inside(apart: Apart, k: int) -> DataFrame:
    """(point, distance, weight): for each pair of a component's blocks, every point's k nearest on the other side."""

    def nearest(own: np.ndarray, other: np.ndarray, ids: np.ndarray, weight: np.ndarray, same: bool) -> pd.DataFrame:
        squares, out = (other * other).sum(1), [pd.DataFrame({"point": [], "distance": [], "weight": []})]
        for start in range(0, len(own), 500):
            part = own[start : start + 500]
            square = (part * part).sum(1)[:, None] + squares[None, :] - 2.0 * (part @ other.T)
            if same:
                square[np.arange(len(part)), start + np.arange(len(part))] = np.inf
            near = np.argpartition(square, min(k, len(other)) - 1, axis=1)[:, :k] if len(other) else np.zeros((len(part), 0), dtype=int)
            found = np.take_along_axis(square, near, axis=1).ravel()
            hits = np.flatnonzero(np.isfinite(found))
            rows = np.repeat(np.arange(start, start + len(part)), near.shape[1])
            out.append(pd.DataFrame({"point": ids[rows[hits]], "distance": _rounded(found[hits]), "weight": weight[near.ravel()[hits]]}))
        return pd.concat(out[1:] or out)

    def search(group: pd.DataFrame) -> pd.DataFrame:
        x, ids, weight = _matrix(group["vector"]), group["point"].to_numpy(), group["weight"].to_numpy()
        if group["same"].iloc[0]:
            return nearest(x, x, ids, weight, True)
        a = group["side"].to_numpy() == 0
        return pd.concat((nearest(x[a], x[~a], ids[a], weight[~a], False), nearest(x[~a], x[a], ids[~a], weight[a], False)))

    return _inside(apart.member, apart.counts(), CLOSE_ROWS, "weight").groupBy("c", "low", "high").applyInPandas(search, "point string, distance double, weight long")


def _forest_between(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning forest of edges between rows and columns, which are numbered after the rows; infinite weights are no edges."""
    rows, columns = weights.shape
    best, source = np.full(rows + columns, np.inf), np.full(rows + columns, -1)
    outside = np.isfinite(np.concatenate((weights.min(1, initial=np.inf), weights.min(0, initial=np.inf))))
    src, dst, cost = [], [], []
    for _ in range(int(outside.sum())):
        node = int(np.where(outside, best, np.inf).argmin())
        if not outside[node] or not np.isfinite(best[node]):
            node = int(outside.argmax())
        else:
            src.append(source[node]), dst.append(node), cost.append(best[node])
        outside[node] = False
        own, far = (weights[node], slice(rows, None)) if node < rows else (weights[:, node - rows], slice(0, rows))
        closer = own < best[far]
        best[far][closer], source[far][closer] = own[closer], node
    return np.array(src, dtype=int), np.array(dst, dtype=int), np.array(cost)


def _trees_inside(apart: Apart, cores: DataFrame, floor: int, most: int) -> DataFrame:
    """(src, dst, weight): the minimum spanning tree of mutual reachability of each component, which needs no edge beyond the radius."""
    radius = apart.radius

    def forest(group: pd.DataFrame) -> pd.DataFrame:
        x, ids, core = _matrix(group["vector"]), group["point"].to_numpy(), group["core"].to_numpy()
        same = bool(group["same"].iloc[0])
        a = np.ones(len(x), dtype=bool) if same else group["side"].to_numpy() == 0
        b = a if same else ~a
        weights = np.empty((int(a.sum()), int(b.sum())))
        for start in range(0, len(weights), 500):
            part = slice(start, start + 500)
            weights[part] = np.maximum(_distances(x[a][part], x[b]), np.maximum(core[a][part, None], core[None, b]))
        weights[weights > radius] = np.inf
        if same:
            np.fill_diagonal(weights, np.inf)
        names = ids if same else np.concatenate((ids[a], ids[b]))
        src, dst, cost = _spanning_forest(weights) if same else _forest_between(weights)
        return pd.DataFrame({"c": group["c"].iloc[0], "src": names[src], "dst": names[dst], "weight": cost})

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        low = np.where(group["src"] < group["dst"], group["src"], group["dst"])
        group = group.assign(src=low, dst=np.where(group["src"] < group["dst"], group["dst"], group["src"]))
        group = group.sort_values(["weight", "src", "dst"])
        return group.iloc[_kruskal(list(zip(group["src"], group["dst"], strict=True)))][["src", "dst", "weight"]]

    kinds = "src string, dst string, weight double"
    paired = _inside(apart.member.drop("core").join(cores, "point"), apart.counts(), TREE_ROWS, "core")
    edges = checkpointed(paired.groupBy("c", "low", "high").applyInPandas(forest, f"c int, {kinds}"))
    largest = edges.groupBy("c").count().agg(F.max("count")).first()[0] or 0
    if largest > most:
        return spanning_forest(edges.drop("c"), floor, most)
    return checkpointed(edges.groupBy("c").applyInPandas(finish, kinds))


def _drawn(apart: Apart, k: int, min_cluster_size: int, floor: int, task_edges: int) -> DataFrame | None:
    """(point, weight, home): the chosen cluster of every point that has one, from the tree of each component alone.

    How components join matters only by the radius where each one is born, which lies between ``low`` and ``high``: a cluster
    that holds several splits beyond ``low``, so it has less than 1/low per row, and its components have at least 1/r - 1/low. Here all
    join at ``low``. If births at ``high`` would choose other clusters, the distances between components decide: null.
    """
    member = apart.member
    cores = checkpointed(_kth(member, checkpointed(_nearest_inside(apart, k)), k))
    dense = checkpointed(member.select("point", "weight", "comp").join(cores, "point"))
    hubs = [r["hub"] for r in dense.groupBy("comp").agg(F.min("point").alias("hub")).orderBy("hub").collect()]
    star = member.sparkSession.createDataFrame([(hubs[0], hub, apart.low) for hub in hubs[1:]], "src string, dst string, weight double")
    tree = checkpointed(_trees_inside(apart, cores, floor, task_edges).unionByName(star))
    found = _hierarchy(tree, dense.drop("comp"), min_cluster_size, floor, task_edges)
    clusters = _clusters(found)
    homes = checkpointed(_chosen(clusters, floor, task_edges))
    tops = found.where((F.col("kind") == "born") & (F.col("label") == ROOT)).select(F.col("name").alias("cluster"), (-F.col("amount") * (1 - apart.low / apart.high)).alias("_more"))
    later = clusters.join(tops, "cluster", "left").withColumn("stability", F.col("stability") + F.coalesce("_more", F.lit(0.0))).drop("_more")
    others = checkpointed(_chosen(checkpointed(later), floor, task_edges))
    if not homes.exceptAll(others).isEmpty() or not others.exceptAll(homes).isEmpty():
        return None
    return _housed(found, homes, dense, floor)


def _numbered(keyed: DataFrame, key: str, member: DataFrame, min_cluster_size: int, floor: int) -> DataFrame:
    """(key, topic_id) of points with their component: 0, 1, … by descending size, small ones and missing points −1."""
    sizes = member.groupBy("component").agg(F.sum("weight").alias("size")).where(F.col("size") >= min_cluster_size)
    numbers = _largest_first(sizes, "component")
    topics = lookup(member.select("point", "component"), numbers, "component", ["point"], how="inner", floor=floor)
    out = lookup(keyed, topics.select("point", "topic_id"), "point", [key], floor=floor)
    return out.select(key, F.coalesce("topic_id", F.lit(NOISE)).alias("topic_id"))


def topics(
    rows: DataFrame,
    key: str,
    vector: str,
    min_cluster_size: int = MIN_CLUSTER_SIZE,
    min_samples: int = MIN_SAMPLES,
    block_rows: int = BLOCK_ROWS,
    floor: int = HOT_FLOOR,
    task_edges: int = TASK_EDGES,
) -> DataFrame:
    """(key, topic_id): clusters 0, 1, … by descending size, −1 for noise.

    A cluster is a component of at least ``min_cluster_size`` rows that lives over a range of
    radii; clusters are chosen where splitting them further does not raise the total stability. The
    component that holds everything is not a cluster by itself.
    """
    keyed = _prepare(rows, key, vector)
    if rows.isEmpty():
        return keyed.select(key, F.lit(NOISE).alias("topic_id"))
    points, cells = _place(_points(keyed, "_v"), block_rows)
    apart = _separated(points, cells, min_samples, min_cluster_size, block_rows, floor)
    if apart:
        settled = _proved(apart, min_samples, min_cluster_size)
        if settled is not None:
            return _numbered(keyed, key, settled, min_cluster_size, floor)
        inside = _drawn(apart, min_samples, min_cluster_size, floor, task_edges)
        if inside is not None:
            return _labelled(keyed, key, inside, floor)
    points = points.drop("reach")
    points = checkpointed(_core_distances(points, cells, min_samples))
    # a point with fewer neighbours than asked for is no cluster's and joins nothing
    dense = checkpointed(points.where(F.col("core").isNotNull()))
    found = _hierarchy(_spanning_tree(dense, dense.count(), cells, floor, task_edges), dense, min_cluster_size, floor, task_edges)
    homes = _chosen(_clusters(found), floor, task_edges)
    return _labelled(keyed, key, _housed(found, homes, dense, floor), floor)


def _hierarchy(tree: DataFrame, dense: DataFrame, min_cluster_size: int, floor: int, task_edges: int) -> DataFrame:
    """What the problems of a tree over the dense points return, with all labels resolved."""
    edges, leaves = _problems(tree, dense, dense.count(), floor, task_edges)
    found = edges.groupBy("problem").cogroup(leaves.groupBy("problem"))
    return checkpointed(_resolved(checkpointed(found.applyInPandas(_condense(min_cluster_size), _FOUND)), floor))


def _housed(found: DataFrame, homes: DataFrame, dense: DataFrame, floor: int) -> DataFrame:
    """(point, weight, home) of the points in a chosen cluster."""
    inside = found.where("kind = 'point'").select(F.col("name").alias("point"), F.col("label").alias("cluster"))
    inside = lookup(inside, homes, "cluster", ["point"], how="inner", floor=floor)
    return checkpointed(inside.select("point", "home").join(dense.select("point", "weight"), "point"))


def _labelled(keyed: DataFrame, key: str, inside: DataFrame, floor: int) -> DataFrame:
    """(key, topic_id) from the home of each point: 0, 1, … by descending size, −1 for points without one."""
    numbers = _largest_first(inside.groupBy("home").agg(F.sum("weight").alias("size")), "home")
    labelled = lookup(inside, numbers, "home", ["point"], how="inner", floor=floor)
    out = lookup(keyed, labelled.select("point", "topic_id"), "point", [key], floor=floor)
    return out.select(key, F.coalesce("topic_id", F.lit(NOISE)).alias("topic_id"))


def _clusters(found: DataFrame) -> DataFrame:
    """(cluster, parent_cluster, stability); the root has no parent and no stability, so it is never chosen."""
    born = found.where("kind = 'born'").select(F.col("name").alias("cluster"), F.col("label").alias("parent_cluster"))
    changes = found.where("kind in ('born', 'gain')")
    sums = changes.groupBy(F.when(F.col("kind") == "born", F.col("name")).otherwise(F.col("label")).alias("cluster"))
    clusters = born.join(sums.agg(F.sum("amount").alias("stability")), "cluster", "left")
    top = found.sparkSession.createDataFrame([(ROOT, None, None)], "cluster string, parent_cluster string, stability double")
    return checkpointed(clusters.unionByName(top))


def _choose(clusters: pd.DataFrame) -> pd.DataFrame:
    """(cluster, home) of all clusters in one task."""
    stability = dict(zip(clusters["cluster"], clusters["stability"].astype(float), strict=True))
    inner: dict[str, list[str]] = {}
    for name, above in zip(clusters["cluster"], clusters["parent_cluster"], strict=True):
        if above is not None:
            inner.setdefault(above, []).append(name)
    order = clusters["cluster"][clusters["parent_cluster"].isna()].tolist()
    for name in order:  # grows while it is read
        order += inner.get(name, [])
    best, wanted = {}, {}
    for name in reversed(order):
        below, own = sum(best[x] for x in inner.get(name, [])), stability[name]
        best[name], wanted[name] = max(0.0 if own != own else own, below), own >= below
    home: dict[str, str | None] = {}
    for name in order:
        above = home.get(name)
        home[name] = above
        for x in inner.get(name, []):
            home[x] = above or (x if wanted[x] else None)
    out = [(name, at) for name, at in home.items() if at is not None]
    return pd.DataFrame(out, columns=["cluster", "home"], dtype=object)


def _chosen(clusters: DataFrame, floor: int, most: int = TASK_EDGES) -> DataFrame:
    """(cluster, home): the chosen cluster that each cluster is or lies in; those in none are left out.

    One task does up to ``most`` clusters. Beyond, loops run over cluster rows, as many times as clusters nest: upwards for
    the best sums, downwards for the choice.
    """
    rows = clusters.count()
    if rows <= most:
        return clusters.withColumn("_all", F.lit("all")).groupBy("_all").applyInPandas(_choose, "cluster string, home string")
    own = F.coalesce("stability", F.lit(0.0))
    state = clusters.withColumn("best", own)
    while True:
        sums = state.where("parent_cluster is not null").groupBy(F.col("parent_cluster").alias("cluster")).agg(F.sum("best").alias("_below"))
        update = state.join(sums, "cluster", "left").withColumn("below", F.coalesce("_below", F.lit(0.0)))
        update = update.select("cluster", "parent_cluster", "stability", F.greatest(own, "below").alias("best"), "below", F.col("best").alias("_old"))
        update = checkpointed(update)
        state = update.select("cluster", "parent_cluster", "stability", "best")
        if update.where("best <> _old").isEmpty():
            break
    wanted = F.col("stability").isNotNull() & (F.col("stability") >= F.col("below"))
    tree = update.select("cluster", "parent_cluster", wanted.alias("wanted"))
    front = tree.where("parent_cluster is null").select("cluster", F.lit(None).cast("string").alias("home"))
    homes = front.where("home is not null")
    while True:
        above = front.select(F.col("cluster").alias("parent_cluster"), "home")
        below = lookup(tree, above, "parent_cluster", ["cluster"], how="inner", floor=floor, rows=rows)
        front = checkpointed(below.select("cluster", F.coalesce("home", F.when(F.col("wanted"), F.col("cluster"))).alias("home")))
        if front.isEmpty():
            return homes
        homes = homes.unionByName(front.where("home is not null"))
