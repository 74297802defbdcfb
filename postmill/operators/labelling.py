"""Labels learned from examples: one-against-rest naive Bayes over the words of a text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions.text import tokens
from postmill.operators.naive_bayes import FIXED_POINT, MAX_LABELS, common_features, summed
from postmill.operators.scoring import THRESHOLD, labels_above, sum_to_one
from postmill.sources.checkpoints import checkpointed


@dataclass(frozen=True)
class LabelModel:
    """One binary model per label, as log odds in fixed point.

    ``priors`` has one number per label; ``table``, a saved frame, one row per known word with a column ``w0``, ``w1``, …
    for each label, and ``common`` the condition for the words that every task may hold; None if it may hold all.
    """

    labels: list[str]
    priors: list[int]
    table: DataFrame
    common: Column | None = None


def _words(df: DataFrame, text: str, *columns: str) -> DataFrame:
    """One row per text and different word; a text without words keeps a row with a null."""
    return df.select(*columns, F.explode_outer(F.array_distinct(tokens(F.col(text)))).alias("_word"))


def fit(examples: DataFrame, text: str, labels_of: str, labels: Sequence[str]) -> LabelModel:
    """Learn ``labels`` from examples whose column ``labels_of`` lists all labels that apply.

    Per label the words of its examples stand against those of all others, each word once per example and one added to each
    count. One distributed count with map-side combining serves all labels; the driver receives one row of sums.
    Examples with a null list are left out; an empty list is an example against every label. A label without examples
    has the odds of its prior and of the added counts. Repeated rows count each.
    """
    if not labels:
        raise ValueError("no label")
    if len(labels) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    if len(set(labels)) < len(labels):
        raise ValueError("a label is given twice")
    ids = range(len(labels))
    has = [F.array_contains(labels_of, v).cast("int") for v in labels]
    known = examples.where(F.col(labels_of).isNotNull()).select(F.col(text).alias("_text"), *[h.alias(f"h{i}") for i, h in enumerate(has)])
    of_label = [f"h{i}" for i in ids]
    sizes = known.agg(F.count(F.lit(1)).alias("all"), *[F.sum(h).alias(h) for h in of_label]).first()
    if not sizes["all"]:
        raise ValueError("no labelled example")

    exploded = _words(known, "_text", *of_label).where("_word is not null")
    counts = checkpointed(exploded.groupBy("_word").agg(F.count(F.lit(1)).alias("all"), *[F.sum(f"h{i}").alias(f"n{i}") for i in ids]))
    sums = counts.agg(F.count(F.lit(1)).alias("size"), F.sum("all").alias("all"), *[F.sum(f"n{i}").alias(f"n{i}") for i in ids]).first()

    def weight(i: int):
        own, every = float((sums[f"n{i}"] or 0) + sums["size"]), float((sums["all"] or 0) + sums["size"])
        rest = every - own + sums["size"]
        odds = F.log((F.col(f"n{i}") + 1) / F.lit(own)) - F.log((F.col("all") - F.col(f"n{i}") + 1) / F.lit(rest))
        return F.round(odds * FIXED_POINT).cast("bigint").alias(f"w{i}")

    odds = F.array(*[F.round(F.log(F.lit((sizes[h] + 1) / (sizes["all"] - sizes[h] + 1))) * FIXED_POINT).cast("bigint") for h in of_label])
    priors = examples.sparkSession.range(1).select(odds).first()[0]
    common = common_features(counts, F.col("all"), sums["size"], len(labels))
    table = counts.select(F.col("_word").alias("feature"), *map(weight, ids), *([] if common is None else [common.alias("common")]))
    return LabelModel(list(labels), list(priors), table, None if common is None else F.col("common"))


def scored(docs: DataFrame, key: str, text: str, model: LabelModel) -> DataFrame:
    """(key, scores): each label's probability by its own model, as ``array<struct<label,score>>`` in the model's order.

    ``key`` is unique per row. Each different word of a text meets the vocabulary once (see :func:`naive_bayes.summed`), and
    sums are integers, so they do not depend on order. A text without known words has the priors' odds.
    """
    found = _words(docs, text, key).withColumnRenamed("_word", "feature")
    sums = summed(found, key, model.table, model.common, len(model.labels))

    def probability(i: int):
        odds = (F.coalesce(F.col(f"s{i}"), F.lit(0)) + F.lit(model.priors[i])) / F.lit(float(FIXED_POINT))
        return 1 / (1 + F.exp(-odds))

    scores = [F.struct(F.lit(v).alias("label"), probability(i).alias("score")) for i, v in enumerate(model.labels)]
    return sums.select(key, F.array(*scores).alias("scores"))


def categories(docs: DataFrame, key: str, text: str, model: LabelModel, threshold: float = THRESHOLD) -> DataFrame:
    """(key, category): labels compete, that is, their scores are scaled to sum 1; one row per label above the threshold."""
    return labels_above(scored(docs, key, text, model), key, sum_to_one(F.col("scores")), "category", threshold)


def products(docs: DataFrame, key: str, text: str, model: LabelModel, threshold: float = THRESHOLD) -> DataFrame:
    """(key, product): labels score independently; one row per label above the threshold, a null where there is none."""
    return labels_above(scored(docs, key, text, model), key, F.col("scores"), "product", threshold)
