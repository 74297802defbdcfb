"""Mixing sources to target weights by Poisson replication and a global shuffle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.common import blocks_for, numbered, saved, text_or_empty

BITS = 52
MOST = 64.0  # the largest mean of one draw
CHUNK = 4096  # copies that one array holds


def _uniform(*parts: Column) -> Column:
    """A 52-bit integer from the MD5 of the parts, joined by colons."""
    digest = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long")


def source_key() -> Column:
    """The source as a join key; null is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))


def rates(docs: DataFrame, weights: Mapping[str, float] | None = None, budget: float = 1.0) -> DataFrame:
    """(source key, rate): how often each document of a source is to appear on average.

    A source's target is its share of the weights times ``budget`` times the bytes of all sources;
    the rate is that target over the source's own bytes. Without ``weights`` a source weighs the
    square root of its bytes, which lifts small sources. Sources that ``weights`` lacks weigh 0. A
    document counts at least one byte, so that rates stay finite.
    """
    bytes_ = F.greatest(F.octet_length(text_or_empty()), F.lit(1)).cast("long")
    sizes = docs.groupBy(source_key().alias("_source")).agg(F.sum(bytes_).alias("_bytes"))
    if weights is None:
        weight: Column = F.sqrt(F.col("_bytes").cast("double"))
    else:
        pairs = [F.lit(x) for name, w in weights.items() for x in ("=" + name, float(w))]
        weight = F.coalesce(F.create_map(*pairs)[F.col("_source")], F.lit(0.0)) if pairs else F.lit(0.0)
    weighed = saved(sizes.withColumn("_weight", weight))
    sums = weighed.agg(F.sum("_weight").alias("_weights"), F.sum("_bytes").alias("_total"))  # one row
    rate = F.col("_weight") / F.col("_weights") * F.lit(float(budget)) * F.col("_total") / F.col("_bytes")
    return weighed.crossJoin(F.broadcast(sums)).select("_source", F.when(F.col("_weight") > 0, rate).otherwise(0.0).alias("rate"))


def poisson_tables(rates_: DataFrame) -> DataFrame:
    """(source key, rate, draws, cdf): the distribution function of one draw at 0, 1, 2, … up to where it is 1 within rounding.

    A rate beyond ``MOST`` is the sum of ``draws`` equal means, so that no table has more than 200 entries.
    """
    split = rates_.where("rate > 0").withColumn("draws", F.ceil(F.col("rate") / MOST)).withColumn("mean", F.col("rate") / F.col("draws"))
    last = F.ceil(F.col("mean") + 12 * F.sqrt("mean") + 40).cast("int")
    steps = split.select("_source", "rate", "draws", "mean", F.explode(F.sequence(F.lit(0), last)).alias("k"))
    so_far = Window.partitionBy("_source").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    log_factorial = F.sum(F.log(F.greatest(F.col("k"), F.lit(1)).cast("double"))).over(so_far)
    mass = F.exp(F.col("k") * F.log("mean") - F.col("mean") - log_factorial)
    cdf = steps.withColumn("mass", mass).withColumn("cdf", F.sum("mass").over(so_far))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("k", "cdf"))), lambda x: x["cdf"])
    return cdf.groupBy("_source").agg(ordered.alias("cdf"), F.first("rate").alias("rate"), F.first("draws").alias("draws"))


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, budget: float = 1.0, seed: int = 7, block_rows: int = 2000) -> DataFrame:
    """Every column of ``docs`` plus rate, n_copies, copy (from 0) and position.

    A document's number of copies is the inverse Poisson distribution, with its source's rate as
    mean, at a uniform number hashed from seed and doc_id; so it does not depend on how the table is
    split, and a task that runs again gives the same rows. A rate beyond ``MOST`` is drawn in equal parts, each at
    a number of its own, and the parts are added, which has the same distribution. Copies are put in the order of a hash of
    seed, doc_id and copy, over all sources; ``position`` numbers that order from 0. Rows are
    shuffled once, in blocks of the hash, which no key can skew.

    Null source: a source of its own. Null text: one byte in the sizes. Null doc_id: hashed by its
    text. Repeated rows have equal copies each. An empty table gives no rows. Columns of ``docs``
    named like the added ones are replaced; those named like the helpers (``_mix_`` in front,
    ``_before``, ``_rank``) are left out.
    """
    docs = docs.drop("rate", "n_copies", "copy", "position", "_mix_source", "_mix_cdf", "_mix_draws", "_mix_first", "_mix_place", "_mix_block", "_before", "_rank")
    tables = saved(poisson_tables(rates(docs, weights, budget)).withColumnsRenamed({"_source": "_mix_source", "cdf": "_mix_cdf", "draws": "_mix_draws"}))
    # F.md5 of the text only where the id is null
    identity = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(text_or_empty().cast("binary"))))
    drawn = lambda *more: _uniform(F.lit(str(seed)), identity, *more) / F.lit(float(2**BITS))
    inverted = lambda u: F.size(F.filter("_mix_cdf", lambda c: c <= u)).cast("long")
    further = F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.col("_mix_draws") - 1), F.lit(0).cast("long"), lambda n, i: n + inverted(drawn(F.lit("draw"), i.cast("string")))
    )
    n_copies = inverted(drawn()) + F.when(F.col("_mix_draws") > 1, further).otherwise(F.lit(0))
    joined = docs.withColumn("_mix_source", source_key()).join(tables, "_mix_source")
    counted = joined.withColumn("n_copies", n_copies).drop("_mix_cdf", "_mix_source", "_mix_draws").where("n_copies > 0")
    # Two steps: no array holds more than CHUNK copies, or one number for each CHUNK of them.
    firsts = counted.withColumn("_mix_first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_copies") - 1, F.lit(CHUNK).cast("long"))))
    last = F.least(F.col("_mix_first") + CHUNK, F.col("n_copies")) - 1
    copies = firsts.withColumn("copy", F.explode(F.sequence(F.col("_mix_first"), last))).drop("_mix_first")
    place = _uniform(F.lit(str(seed)), identity, F.col("copy").cast("string"))
    blocks = blocks_for(int(docs.count() * max(budget, 1e-9)), block_rows)
    block = F.floor(F.col("_mix_place") / F.lit(float(2**BITS)) * blocks).cast("int")
    placed = copies.withColumn("_mix_place", place).withColumn("_mix_block", block)
    return numbered(placed, [], "_mix_block", ["_mix_place", "doc_id", "copy"], "position").drop("_mix_place", "_mix_block")
