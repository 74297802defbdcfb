"""Model-scored steps: prompts, batched inference, spam, labels, summaries.

A model is a picklable factory. It is called once per Python worker and returns a function from a
list of prompts to a list of responses. The default scorers are deterministic expressions: they
stand in for neural models and do not match their quality.
"""

from __future__ import annotations

import asyncio
from collections.abc import Awaitable, Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from postmill.functions.entities import entities_from_json, entities_from_text
from postmill.functions.text import tokens
from postmill.operators import naive_bayes as nb

BatchModel = Callable[[list[str]], list[str]]
AsyncModel = Callable[[str], Awaitable[str]]

# The message categories, the product names and the score a label must exceed.
CATEGORIES = [
    "customer_inquiry",
    "customer_complaint",
    "customer_feedback",
    "account_issue",
    "loan_application",
    "fraud_report",
    "technical_support",
    "product_information",
    "marketing_opt_out",
    "internal_communication",
    "partner_inquiry",
    "vendor_communication",
    "job_application",
    "press_inquiry",
    "regulatory_correspondence",
    "phishing_attempt",
    "spam",
    "service_request",
    "branch_information",
    "event_rsvp",
    "other",
]
PRODUCTS = [
    "Credit Card",
    "Family Shield",
    "Growing Deposit",
    "Misk Saving Account",
    "Personal Finance",
    "Supplementary Card",
    "Travel Takaful",
    "Credit Shield",
    "Auto Takaful",
    "Fixed Deposit",
    "Salary Transfer",
    "Saving Account",
    "Current Account",
    "Home Finance",
]
THRESHOLD = 0.09
TASK_BYTES = 4 << 20  # text whose words one task counts for summaries
PART_BYTES = 2 << 20  # prompts that a worker holds as Python strings

SPAM_PROMPT = (
    "Decide whether the mail below is unwanted bulk mail or wanted mail. "
    "Answer with the single word spam or ham.\n\nMail: {text}\n\nAnswer:"
)
ENTITY_PROMPT = (
    "List the personal and payment details that occur in the mail below as one JSON object. "
    "Use the detail's type as name and its text as value, or a list when there are several.\n\n{text}\n\nJSON:"
)
SUMMARY_PROMPT = (
    "Summarise the mail below in two or three English sentences: its purpose, its main points, "
    "what has to be done by when, and its tone.\n\n{text}\n\nSummary:"
)


def build_prompt(text: Column, template: str) -> Column:
    """The template with ``{text}`` replaced by the row's text."""
    before, after = template.split("{text}")
    return F.concat(F.lit(before), F.coalesce(text, F.lit("")), F.lit(after))


def _in_parts(batches: Iterator[pa.Array], ask: Callable[[list[str]], list[str]]) -> Iterator[pa.Array]:
    """The answers to each batch's prompts, asked for in parts of about ``PART_BYTES``, so that a worker holds few texts as Python strings.

    A null prompt has a null answer. Memory is given back after each part, as a worker lives on from task to task.
    """
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(batch):
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + PART_BYTES, "right")))
            prompts = batch.slice(start, end - start).to_pylist()
            asked = [p for p in prompts if p is not None]
            answers = list(ask(asked)) if asked else []
            if len(answers) != len(asked):
                raise ValueError(f"{len(answers)} answers to {len(asked)} prompts")
            left = iter(answers)
            yield pa.array([None if p is None else next(left) for p in prompts], pa.string(), from_pandas=True)
            del prompts, asked, answers, left
            pa.default_memory_pool().release_unused()
            start = end


def invoke_model(df: DataFrame, prompt: str, factory: Callable[[], BatchModel], out: str = "response") -> DataFrame:
    """Add the model's response to each prompt.

    Only the prompt column travels to the Python workers, in Arrow batches that are asked in parts; the model is built once
    per task. The function is marked non-deterministic so that no later filter evaluates it twice.
    Write the result out before using it more than once.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _in_parts(batches, factory())

    return df.withColumn(out, F.arrow_udf(run, "string", ArrowUDFType.SCALAR_ITER).asNondeterministic()(F.col(prompt)))


def invoke_model_concurrently(
    df: DataFrame,
    prompt: str,
    factory: Callable[[], AsyncModel],
    out: str = "response",
    in_flight: int = 16,
) -> DataFrame:
    """As :func:`invoke_model` for an async model: up to ``in_flight`` calls per task at once."""

    async def gather(model: AsyncModel, prompts: list[str]) -> list[str]:
        slots = asyncio.Semaphore(in_flight)

        async def one(p: str) -> str:
            async with slots:
                return await model(p)

        return await asyncio.gather(*map(one, prompts))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = factory()
        with asyncio.Runner() as runner:
            yield from _in_parts(batches, lambda prompts: runner.run(gather(model, prompts)))

    return df.withColumn(out, F.arrow_udf(run, "string", ArrowUDFType.SCALAR_ITER).asNondeterministic()(F.col(prompt)))


# --- spam -------------------------------------------------------------------------------------


def fit_spam(examples: DataFrame, text: str, is_spam: str) -> nb.NaiveBayes:
    """Train the default spam scorer on texts with a boolean label."""
    named = examples.select(text, F.when(F.col(is_spam), "spam").otherwise("ham").alias("_kind"))
    return nb.fit(named, tokens(F.col(text)), "_kind")


def spam_flags(docs: DataFrame, key: str, text: str, model: nb.NaiveBayes) -> DataFrame:
    """(key, is_spam): true when ``spam`` is the top label."""
    top = nb.classify(docs, key, tokens(F.col(text)), model, "_kind")
    return top.select(key, (F.col("_kind") == "spam").alias("is_spam"))


def spam_from_response(response: Column) -> Column:
    """True when the response says ``spam`` and does not say ``ham``."""
    return response.contains("spam") & ~response.contains("ham")


# --- labels -----------------------------------------------------------------------------------


def label_words(label: str) -> list[str]:
    """Lower-case words of a label."""
    return label.lower().replace("_", " ").split()


def label_shares(text: Column, labels: Sequence[str]) -> Column:
    """Default scorer: per label, the share of its words that occur in the text.

    The words of all labels are looked up in the text once. Returns ``array<struct<label,score>>``.
    """
    words = sorted({w for label in labels for w in label_words(label)})
    present = F.array_intersect(F.array(*map(F.lit, words)), tokens(text))

    def share(found: Column) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(label).alias("label"),
                    (
                        sum(F.array_contains(found, w).cast("int") for w in set(label_words(label)))
                        / F.lit(float(len(set(label_words(label)))))
                    ).alias("score"),
                )
                for label in labels
            ]
        )

    # one-element transform: binds the intersection to a variable, so it is evaluated once per row
    return F.element_at(F.transform(F.array(present), share), 1)


def sum_to_one(scores: Column) -> Column:
    """Scores of competing labels, scaled to sum 1 (all zero stays zero)."""
    total = F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + s["score"])
    return F.transform(
        scores,
        lambda s: F.struct(
            s["label"].alias("label"), F.coalesce(F.try_divide(s["score"], total), F.lit(0.0)).alias("score")
        ),
    )


def labels_above(df: DataFrame, key: str, scores: Column, out: str, threshold: float = THRESHOLD) -> DataFrame:
    """(key, out): one row per label above the threshold; a row without one keeps a null."""
    scored = df.select(key, scores.alias("_scores"))
    kept = F.filter("_scores", lambda s: s["score"] > threshold)
    return scored.select(key, F.explode_outer(F.transform(kept, lambda s: s["label"])).alias(out))


def categories(df: DataFrame, key: str, text: str, labels: Sequence[str] = CATEGORIES) -> DataFrame:
    """Message categories; scores compete (sum 1)."""
    return labels_above(
        df.select(key, label_shares(F.col(text), labels).alias("_shares")), key, sum_to_one(F.col("_shares")), "category"
    )


def products(df: DataFrame, key: str, text: str, labels: Sequence[str] = PRODUCTS) -> DataFrame:
    """Products mentioned; labels score independently."""
    return labels_above(df, key, label_shares(F.col(text), labels), "product")


# --- entities ---------------------------------------------------------------------------------


def explode_entities(df: DataFrame, key: str, entities: Column) -> DataFrame:
    """(key, entity_type, entity_value); a message without entities keeps one row of nulls."""
    rows = df.select(key, F.explode_outer(entities).alias("e"))
    return rows.select(key, "e.entity_type", "e.entity_value")


def entities(df: DataFrame, key: str, text: str = "clean_text") -> DataFrame:
    """Entities by pattern. Clean text has lost its hyphens, so dates need the raw body."""
    return explode_entities(df, key, entities_from_text(F.col(text)))


def model_entities(df: DataFrame, key: str, text: str, factory: Callable[[], BatchModel]) -> DataFrame:
    """Entities from a model that answers in JSON."""
    asked = invoke_model(df.select(key, build_prompt(F.col(text), ENTITY_PROMPT).alias("prompt")), "prompt", factory)
    return explode_entities(asked, key, entities_from_json(F.col("response")))


# --- summaries --------------------------------------------------------------------------------


def summaries(df: DataFrame, key: str, text: str, sentences: int = 3) -> DataFrame:
    """(key, summary): the sentences whose words are most frequent in the mail, in text order.

    The text is shuffled once by ``key`` (unique per row); everything after that groups and ranks
    within the same partitions, so no exploded word crosses the network. (The outer explode keeps
    both readers of the shuffled text alike, so that Spark shuffles it once for both.) A task's words take many times
    the room of its text, so there are as many partitions as the texts have ``TASK_BYTES``; ``df`` is read once more to know them.
    """
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))
    parts = F.filter(
        F.transform(F.split(text, r"[.!?]+"), lambda s: F.trim(F.regexp_replace(s, r"\s+", " "))), lambda s: s != ""
    )
    base = df.select(key, F.coalesce(parts, F.array().cast("array<string>")).alias("_parts")).repartition(tasks, key)
    words = base.select(key, F.posexplode_outer("_parts").alias("_pos", "_part")).select(
        key, "_pos", F.explode(tokens(F.col("_part"))).alias("_word")
    )
    counted = words.groupBy(key, "_pos", "_word").agg(F.count(F.lit(1)).alias("_n"))
    weighed = counted.withColumn("_freq", F.sum("_n").over(Window.partitionBy(key, "_word")))
    scored = weighed.groupBy(key, "_pos").agg((F.sum(F.col("_n") * F.col("_freq")) / F.sum("_n")).alias("_score"))
    order = Window.partitionBy(key).orderBy(F.desc("_score"), "_pos")
    best = scored.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= sentences)
    chosen = best.groupBy(key).agg(F.array_sort(F.collect_list("_pos")).alias("_chosen"))
    text_of = F.transform("_chosen", lambda p: F.concat(F.get("_parts", p), F.lit(".")))
    return base.join(chosen, key, "left").select(key, F.coalesce(F.array_join(text_of, " "), F.lit("")).alias("summary"))


def model_summaries(df: DataFrame, key: str, text: str, factory: Callable[[], BatchModel]) -> DataFrame:
    """Summaries written by a model."""
    asked = df.select(key, build_prompt(F.col(text), SUMMARY_PROMPT).alias("prompt"))
    return invoke_model(asked, "prompt", factory, "summary").select(key, "summary")


def model_spam(df: DataFrame, key: str, text: str, factory: Callable[[], BatchModel]) -> DataFrame:
    """Spam flags from a model's one-word answer."""
    asked = invoke_model(df.select(key, build_prompt(F.col(text), SPAM_PROMPT).alias("prompt")), "prompt", factory)
    return asked.select(key, spam_from_response(F.col("response")).alias("is_spam"))
