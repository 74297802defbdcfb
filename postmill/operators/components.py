"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.operators.skew import HOT_FLOOR, lookup
from postmill.sources.checkpoints import checkpointed


def connected_components(edges: DataFrame, floor: int = HOT_FLOOR) -> DataFrame:
    """(id, component) for every end of the edges (src, dst); ids are strings.

    Each round a node points to its smallest neighbour, pointers are followed twice, and the edges
    are renamed to the nodes pointed at; inner edges vanish. Ids should be in random order relative
    to the graph (hashes), so that the graph shrinks by a constant factor per round. A component
    that gathers most nodes becomes a hot key, which the look-ups handle. Every round's pointers and
    edges are written out, so a lost executor costs one round; the nodes themselves are renamed
    through all rounds at the end.
    """
    open_edges = checkpointed(edges.select("src", "dst").where("src <> dst").distinct())
    ends = F.explode(F.array(F.struct(F.col("src").alias("id")), F.struct(F.col("dst").alias("id"))))
    labels = open_edges.select(ends.alias("e")).select("e.id").distinct().withColumn("component", F.col("id"))
    left = open_edges.count()
    nodes = 2 * left  # at most
    steps = []
    while left:
        both = open_edges.unionByName(open_edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        step = both.groupBy("src").agg(F.min("dst").alias("_near"))
        step = checkpointed(step.select(F.col("src").alias("node"), F.least("src", "_near").alias("target")))
        near = _rename(step, "target", step, ["node"], floor, 2 * left)
        step = checkpointed(_rename(near, "target", step, ["node"], floor, 2 * left))
        renamed = _rename(open_edges, "src", step, ["dst"], floor, left)
        renamed = _rename(renamed, "dst", step, ["src"], floor, left)
        open_edges = checkpointed(renamed.where("src <> dst").distinct())
        left = open_edges.count()
        steps.append(step)
    for step in steps:
        labels = _rename(labels, "component", step, ["id"], floor, nodes)
        if nodes >= floor:  # a look-up for hot keys reads its rows twice
            labels = checkpointed(labels)
    return labels


def _rename(frame: DataFrame, column: str, step: DataFrame, spread: list[str], floor: int, rows: int) -> DataFrame:
    """Replace the column's nodes by what they point at."""
    targets = step.select(F.col("node").alias(column), F.col("target").alias("_new"))
    found = lookup(frame, targets, column, spread, floor=floor, rows=rows)
    return found.withColumn(column, F.coalesce("_new", column)).drop("_new")
