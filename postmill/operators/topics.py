"""Topic reporting: describable topics, samples, descriptions, word frequencies."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.functions.text import ngrams, tokens
from postmill.operators.relate import NOISE_TOPIC
from postmill.operators.scoring import BatchModel, invoke_model
from postmill.operators.skew import HOT_FLOOR, lookup
from postmill.sources.checkpoints import checkpointed

# How many n-grams of each length a topic reports, and when it is described.
TOP_NGRAMS = {1: 12, 2: 4, 3: 2}
BUCKETS = 1 << 17  # counters of n-grams per topic and length
LEADERS = 4  # buckets counted first, per n-gram asked for
MIN_DESCRIBED = 5
SAMPLES = 3

DESCRIPTION_PROMPT_HEAD = (
    "The mails below belong to one topic. Name the topic in one short sentence and answer with that "
    "sentence only.\n\n"
)


def described_topics(assigned: DataFrame, minimum: int = MIN_DESCRIBED) -> DataFrame:
    """(topic_id, messages) of the topics with at least ``minimum`` messages, noise left out."""
    sizes = assigned.where(F.col("topic_id") != NOISE_TOPIC).groupBy("topic_id")
    return sizes.agg(F.count(F.lit(1)).alias("messages")).where(F.col("messages") >= minimum)


def describable(assigned: DataFrame, minimum: int = MIN_DESCRIBED, floor: int = HOT_FLOOR) -> DataFrame:
    """The messages of the describable topics; one topic may hold a third of all messages."""
    topics = described_topics(assigned, minimum).select("topic_id")
    return lookup(assigned, topics, "topic_id", ["message_id"], how="left_semi", floor=floor)


def topic_samples(assigned: DataFrame, n: int = SAMPLES, seed: int | None = 42) -> DataFrame:
    """n messages of each describable topic, by seeded hash (``seed=None``: by message id).

    ``message_id`` is unique. Ids are ranked without their texts, with the limit applied map-side, so
    a topic of any size reaches its reducer as n ids per task; the few samples then fetch their rows.
    """
    order = [F.col("message_id")] if seed is None else [F.xxhash64("message_id", F.lit(seed)), F.col("message_id")]
    ids = assigned.select("message_id", "topic_id").where(F.col("topic_id") != NOISE_TOPIC)
    ranked = ids.withColumn("sample", F.row_number().over(Window.partitionBy("topic_id").orderBy(*order)))
    picked = ranked.where(F.col("sample") <= n)
    picked = picked.join(described_topics(assigned).select("topic_id"), "topic_id", "left_semi")
    return assigned.join(picked.select("message_id", "sample"), "message_id")


def word_frequencies(assigned: DataFrame, text: str = "clean_text", top: dict[int, int] | None = None) -> DataFrame:
    """(topic_id, word, frequency): the most frequent n-grams of each topic, noise included.

    Ties go to the smaller gram. Distinct n-grams are far too many to shuffle, so they are counted by buckets of their hash first, at
    most ``BUCKETS`` per topic and length, with map-side combining. A bucket's total is no less than the count of any gram in it. The
    grams of each topic's largest buckets are counted exactly, which gives a frequency that the grams reported
    reach at least; then those of all other buckets that reach it, if there are such. The result is exact. ``assigned`` is read two or three times.
    """
    top = TOP_NGRAMS if top is None else top
    lengths = sorted(top)
    split = assigned.select("topic_id", tokens(F.col(text)).alias("_t"))
    each = split.select("topic_id", F.posexplode(F.array(*[ngrams(F.col("_t"), n) for n in lengths])).alias("_at", "_grams"))
    grams = each.select("topic_id", "_at", F.explode("_grams").alias("word"))
    grams = grams.withColumn("_bucket", F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int"))
    cap = F.get(F.array(*[F.lit(top[n]) for n in lengths]), F.col("_at"))
    group, bucket = ["topic_id", "_at"], ["topic_id", "_at", "_bucket"]

    def counted(buckets: DataFrame) -> DataFrame:
        found = grams.join(buckets, _same(grams, buckets, bucket), "left_semi")
        return checkpointed(found.groupBy(*group, "word").agg(F.count(F.lit(1)).alias("frequency")))

    totals = grams.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_total"))
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("_total"), "_bucket"))
    totals = checkpointed(totals.withColumn("_place", place))
    counts = counted(checkpointed(totals.where(F.col("_place") <= LEADERS * cap).select(*bucket)))
    order = Window.partitionBy(*group).orderBy(F.desc("frequency"), "word")
    least = counts.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == cap)
    least = checkpointed(least.select(*group, F.col("frequency").alias("_least")))
    others = totals.where(F.col("_place") > LEADERS * cap)
    reached = others.join(least, _same(others, least, group), "left").where(F.col("_total") >= F.coalesce("_least", F.lit(0)))
    others = checkpointed(reached.select(*[others[c] for c in bucket]))
    if not others.isEmpty():
        counts = counts.unionByName(counted(others))
    ranked = counts.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= cap)
    return ranked.select("topic_id", "word", "frequency")


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    """Whether two frames agree in the columns, nulls included."""
    return reduce(Column.__and__, [a[c].eqNullSafe(b[c]) for c in columns])


def topic_descriptions(assigned: DataFrame, text: str = "clean_text", words: int = 3) -> DataFrame:
    """Default describer: the most frequent single words of each describable topic, joined."""
    frequent = word_frequencies(assigned, text, {1: words})
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("frequency")).alias("f"), "word")))
    named = frequent.groupBy("topic_id").agg(
        F.array_join(F.transform(ordered, lambda w: w["word"]), ", ").alias("topic_description")
    )
    return described_topics(assigned).select("topic_id").join(named, "topic_id")


def model_topic_descriptions(
    assigned: DataFrame, factory: Callable[[], BatchModel], text: str = "clean_text"
) -> DataFrame:
    """Descriptions by a model from three sample messages per topic, trimmed."""
    samples = topic_samples(assigned)
    lines = F.array_sort(F.collect_list(F.struct("sample", F.col(text).alias("text"))))
    listed = F.transform(
        lines, lambda s: F.concat(F.lit("Mail "), s["sample"].cast("string"), F.lit(": "), s["text"])
    )
    prompts = samples.groupBy("topic_id").agg(
        F.concat(F.lit(DESCRIPTION_PROMPT_HEAD), F.array_join(listed, "\n"), F.lit("\n\nTopic:")).alias("prompt")
    )
    asked = invoke_model(prompts, "prompt", factory, "topic_description")
    return asked.select("topic_id", F.trim("topic_description").alias("topic_description"))
