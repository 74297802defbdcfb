"""Look-ups that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 1024
HOT_FLOOR = 100_000


def hot_keys(facts: DataFrame, key: str, floor: int = HOT_FLOOR) -> DataFrame:
    """The at most ``HOT_KEYS`` most frequent keys with at least ``floor`` rows.

    Counts are combined map-side, so a hot key costs one row per task. Every key left out holds
    less than 1/1024 of the rows or fewer than ``floor``.
    """
    counts = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.where(F.col("_rows") >= floor).orderBy(F.desc("_rows")).limit(HOT_KEYS).select(key)


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    spread: Sequence[str],
    how: str = "left",
    floor: int = HOT_FLOOR,
    rows: int | None = None,
) -> DataFrame:
    """``facts`` joined with ``dim`` on ``key``; ``dim`` has one row per key.

    Rows of the hot keys meet their (at most ``HOT_KEYS``) ``dim`` rows by broadcast. The rest is an
    ordinary join whose strategy Spark picks by size; null and hot keys are replaced there by values
    that match nothing and are spread by a hash of the ``spread`` columns and the number of the
    input partition, so they load no single partition, not even when they are copies of each other.
    (The partition number, unlike a random one, is the same when a lost task runs again.) ``how`` is ``left``, ``inner`` or ``left_semi``. Where the caller knows that ``facts``
    has fewer ``rows`` than the floor, no key can be hot and a plain join is enough.
    """
    if rows is not None and rows < floor:
        return facts.join(dim, key, how).select(*facts.columns, *[c for c in dim.columns if c != key and how != "left_semi"])
    values = [c for c in dim.columns if c != key]
    packed = dim.select(F.col(key), F.struct(F.lit(True).alias("_found"), *values).alias("_dim"))
    hot = hot_keys(facts, key, floor).join(packed, key, "left")  # hot keys that dim lacks are spread, too
    hot = hot.select(F.col(key).alias("_hot_key"), F.col("_dim").alias("_hot"))
    cold = packed.select(F.col(key).cast("string").alias("_cold_key"), F.col("_dim").alias("_cold"))

    unmatched = F.concat(F.lit("\u0000"), F.xxhash64(*spread, F.spark_partition_id()).cast("string"))
    own_key = F.when(F.col("_hot_key").isNull(), F.col(key).cast("string"))
    out = (
        facts.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
        .withColumn("_spread_key", F.coalesce(own_key, unmatched))
        .join(cold, F.col("_spread_key") == F.col("_cold_key"), "left")
    )
    found: Column = F.coalesce(F.col("_hot"), F.col("_cold"))
    if how != "left":
        out = out.where(found.isNotNull())
    if how == "left_semi":
        return out.select(*facts.columns)
    return out.select(*facts.columns, *[found[v].alias(v) for v in values])
