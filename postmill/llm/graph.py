"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of the links (a, b); the component is its smallest id.

    Large-star and small-star steps in turn: link every larger neighbour of a node to the node's
    smallest neighbour, then all smaller neighbours. Nodes number their neighbours by minima, which
    combine before they are shuffled; no list of neighbours is built, so a node may have any number.
    Every round is written out, so a lost executor costs one round. Ends when a round changes nothing.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = saved(edges)
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            break
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("_v")).select("u", F.least("u", "_v").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = saved(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        near = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))
        small = large.join(least, "u").select(F.explode(near).alias("e")).select("e.u", "e.v").where("u <> v")
        edges = saved(small.distinct())
    centres = edges.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(centres)
