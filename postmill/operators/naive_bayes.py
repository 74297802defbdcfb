"""Multinomial naive Bayes as joins and sums, used for language and spam."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.operators.skew import lookup
from postmill.sources.checkpoints import checkpointed

MAX_LABELS = 500
MAX_WEIGHTS = 1_000_000  # numbers of a model that every task holds
FIXED_POINT = 1_000_000  # log-probabilities are summed as integers, so no sum depends on row order


def letter_pairs(text: Column) -> Column:
    """Every pair of adjacent letters, lower-cased."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?=(\p{L}{2}))"), F.lit(1))


@dataclass(frozen=True)
class NaiveBayes:
    """Model parameters: one prior per label, and the whole vocabulary as a saved frame.

    ``table`` has ``feature`` and one fixed-point weight column ``w0``, ``w1``, … per label. The features for which the
    condition ``common`` holds are few enough for every task; None if all are.
    """

    labels: list[str]
    priors: list[int]
    table: DataFrame
    common: Column | None = None


def common_features(counts: DataFrame, times: Column, size: int, weights: int) -> Column | None:
    """The condition that picks the most frequent of ``size`` counted features, at most ``MAX_WEIGHTS`` / ``weights`` of them; None if that is all."""
    most = max(1, MAX_WEIGHTS // max(1, weights))
    if size <= most:
        return None
    least = counts.select(F.percentile_approx(times, 1 - 0.9 * most / size, 100_000)).first()[0]
    return times > least


def summed(features: DataFrame, key: str, table: DataFrame, common: Column | None, weights: int) -> DataFrame:
    """(key, s0, s1, …): the weights of all rows (key, feature) added up per key; a null feature or an unknown one adds nothing.

    Common features meet their weights by broadcast and are added up in the map tasks, so that of a document one row is
    shuffled. If the table has others, the features left are counted per document, and each meets it once; frequent
    ones among them, which the table then lacks, are spread by the look-up.
    """
    names = [f"w{i}" for i in range(weights)]
    few = table if common is None else table.where(common)
    met = features.join(F.broadcast(few.select("feature", F.lit(True).alias("_met"), *names)), "feature", "left")
    if common is None:
        return met.groupBy(key).agg(*[F.sum(w).alias(f"s{i}") for i, w in enumerate(names)])
    met = met.withColumn("feature", F.when(F.col("_met").isNull(), F.col("feature")))
    added = met.groupBy(key, "feature").agg(F.count(F.lit(1)).alias("_times"), *[F.sum(w).alias(f"_{w}") for w in names])
    rare = table.where(~common).select("feature", *names)
    found = lookup(added, rare, "feature", [key])
    return found.groupBy(key).agg(*[F.sum(F.coalesce(f"_{w}", F.col(w) * F.col("_times"))).alias(f"s{i}") for i, w in enumerate(names)])


def fit(examples: DataFrame, features: Column, label: str) -> NaiveBayes:
    """Count every feature per label; smoothing adds one to each count.

    One distributed count with map-side combining, written out as a table; the driver receives the
    labels with their priors (at most ``MAX_LABELS``) and one row of sums.
    """
    known = examples.where(F.col(label).isNotNull())
    label_rows = known.groupBy(label).count().orderBy(label).limit(MAX_LABELS + 1).collect()
    if not label_rows:
        raise ValueError("no labelled example")
    if len(label_rows) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    labels = [r[label] for r in label_rows]
    examples_total = sum(r["count"] for r in label_rows)

    exploded = known.select(F.col(label).alias("_label"), F.explode(features).alias("feature"))
    per_label = [F.count(F.when(F.col("_label") == v, True)).alias(f"n{i}") for i, v in enumerate(labels)]
    counts = checkpointed(exploded.groupBy("feature").agg(*per_label))
    ids = range(len(labels))
    sums = counts.agg(F.count(F.lit(1)).alias("size"), *[F.sum(f"n{i}").alias(f"t{i}") for i in ids]).first()
    weights = [
        F.round(F.log((F.col(f"n{i}") + 1) / F.lit(float((sums[f"t{i}"] or 0) + sums["size"]))) * FIXED_POINT).cast("bigint").alias(f"w{i}")
        for i in ids
    ]
    priors = [round(math.log(r["count"] / examples_total) * FIXED_POINT) for r in label_rows]
    times = sum((F.col(f"n{i}") for i in ids), F.lit(0))
    common = common_features(counts, times, sums["size"], len(labels))
    table = counts.select("feature", *weights, *([] if common is None else [common.alias("common")]))
    return NaiveBayes([str(v) for v in labels], priors, table, None if common is None else F.col("common"))


def classify(docs: DataFrame, key: str, features: Column, model: NaiveBayes, out: str) -> DataFrame:
    """(key, out): the label with the highest score, the first label on a tie.

    Common features are weighed where the text is read (see :func:`summed`). Documents without a
    known feature get the label with the highest prior.
    """
    exploded = docs.select(key, F.explode_outer(features).alias("feature"))
    ids = range(len(model.labels))
    sums = summed(exploded, key, model.table, model.common, len(model.labels))
    scores = F.array(
        *[
            F.struct((F.coalesce(F.col(f"s{i}"), F.lit(0)) + model.priors[i]).alias("score"), F.lit(-i).alias("order"))
            for i in ids
        ]
    )
    best = -F.array_max(scores)["order"]
    return sums.select(key, F.get(F.array(*map(F.lit, model.labels)), best).alias(out))
