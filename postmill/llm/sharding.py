"""Sharding by a hierarchical weighted hash tree: region, rack, shard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import blocks_for, numbered, text_or_empty

#: A tree: regions of racks of shard weights. The position of a weight, counted through the tree, is its shard.
Tree = Sequence[Sequence[Sequence[float]]]


def even_tree(shards: int, regions: int = 2, racks: int = 3, base: int = 24) -> list[list[list[float]]]:
    """``base`` shards of weight 1 dealt over regions and racks; every further shard opens a region of its own.

    So a tree with one more shard differs from the smaller one by one new subtree only.
    """
    first = min(shards, base)
    per_rack = -(-first // (regions * racks))
    flat = [1.0] * first
    cut = [flat[i : i + per_rack] for i in range(0, first, per_rack)]
    tree = [cut[i : i + racks] for i in range(0, len(cut), racks)]
    return tree + [[[1.0]] for _ in range(shards - first)]


def _literal(tree: Tree) -> Column:
    shard, regions = 0, []
    for r, racks in enumerate(tree):
        rack_columns, region_weight = [], 0.0
        for k, weights in enumerate(racks):
            leaves = []
            for w in weights:
                leaves.append(F.struct(F.lit(f"shard-{shard}").alias("name"), F.lit(float(w)).alias("weight"), F.lit(shard).alias("kids")))
                shard += 1
            total = float(sum(weights))
            region_weight += total
            rack_columns.append(F.struct(F.lit(f"rack-{r}-{k}").alias("name"), F.lit(total).alias("weight"), F.array(*leaves).alias("kids")))
        regions.append(F.struct(F.lit(f"region-{r}").alias("name"), F.lit(region_weight).alias("weight"), F.array(*rack_columns).alias("kids")))
    return F.array(*regions)


def _drawn(children: Column, key: Column) -> Column:
    """What the child with the least draw holds: -ln(u) / weight, u from a hash of key and child.

    A child wins with a probability in proportion to its weight. If one weight grows, no draw of
    another child changes, so keys move into that child only; if it shrinks, keys only leave it.
    Children of weight 0 never win.
    """

    def draw(child: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, child["name"]), 11) + F.lit(0.5)) / F.lit(float(2**53))
        score = F.when(child["weight"] > 0, -F.log(u) / child["weight"]).otherwise(F.lit(float("inf")))
        return F.struct(score.alias("score"), child["name"].alias("name"), child["kids"].alias("kids"))

    return F.array_min(F.transform(children, draw))["kids"]


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard of a key: three weighted draws, down from region to rack to shard."""
    racks = _drawn(_literal(tree), key)
    return _drawn(_drawn(racks, key), key).cast("int")


def with_shards(docs: DataFrame, shards: int = 24, tree: Tree | None = None, grown: Tree | None = None, block_rows: int = 1000) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``.

    The law is ``key``: shard and grown_shard depend on doc_id and the two trees alone. The text is
    only measured, never shuffled. Slots count a shard's rows from 0; a shard is numbered in blocks,
    so no task holds a whole shard. Null text counts as empty, a null doc_id is a key of its own
    (all such rows share a shard), repeated rows get a slot each, an empty table gives no rows,
    other columns are ignored.
    """
    tree = even_tree(shards) if tree is None else tree
    grown = even_tree(shards + 1) if grown is None else grown
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    text = text_or_empty()
    blocks = blocks_for(docs.count(), block_rows * shards)
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(key, tree).alias("shard"),
        shard_of(key, grown).alias("grown_shard"),
    )
    # The partition number spreads repeated rows; it is the same when a lost task runs again.
    block = F.pmod(F.xxhash64("doc_id", "text_crc32", F.spark_partition_id()), F.lit(blocks)).cast("int")
    out = numbered(rows.withColumn("_block", block), ["shard"], "_block", ["doc_id", "text_crc32"], "slot")
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
