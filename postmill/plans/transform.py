"""Preprocessed mails → the ten tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.operators import clustering, embeddings, relate, scoring, topics
from postmill.operators.naive_bayes import NaiveBayes
from postmill.sources.checkpoints import Checkpoints
from postmill.sources.tables import null_normalise, project

Scorer = Callable[[DataFrame], DataFrame]


def _embed(docs: DataFrame) -> DataFrame:
    return embeddings.hashed_embeddings(docs, "message_id", "clean_text", idf=False)


@dataclass(frozen=True)
class Models:
    """The scorers of one run, each from mails (message_id, clean_text, …) to its rows.

    The defaults are the deterministic stand-ins; replace any of them by a function that applies a
    real model with :func:`postmill.operators.scoring.invoke_model`. ``spam`` is a trained model
    and optional: without it no mail counts as spam.
    """

    spam: NaiveBayes | None = None
    embed: Scorer = _embed
    categories: Scorer = field(default=lambda m: scoring.categories(m, "message_id", "clean_text"))
    products: Scorer = field(default=lambda m: scoring.products(m, "message_id", "clean_text"))
    entities: Scorer = field(default=lambda m: scoring.entities(m, "message_id"))
    summaries: Scorer = field(default=lambda m: scoring.summaries(m, "message_id", "clean_text"))
    describe: Scorer = field(default=topics.topic_descriptions)


def transform(
    mails: DataFrame,
    checkpoints: Checkpoints,
    embedding_store: str,
    own_address: str,
    models: Models = Models(),
    min_cluster_size: int = clustering.MIN_CLUSTER_SIZE,
    min_samples: int = clustering.MIN_SAMPLES,
) -> dict[str, DataFrame]:
    """Filter and de-duplicate first, then score, cluster and spread into the ten tables.

    Each step that runs a model or trains one is saved, so no later action repeats it.
    """
    customers = relate.dedupe(relate.drop_null_keys(relate.external_only(mails, own_address)))
    customers = checkpoints.save("customers", null_normalise(relate.with_defaults(customers)))
    if models.spam:
        flags = scoring.spam_flags(customers, "message_id", "clean_text", models.spam)
        customers = checkpoints.save("wanted", relate.drop_spam(customers, flags))

    embedded = embeddings.populate(customers.select("message_id", "clean_text"), embedding_store, models.embed)
    reduced = embeddings.truncated_svd(embedded, "message_id", "embedding")
    units = checkpoints.save("units", embeddings.normalised(reduced, "message_id", "reduced"))
    found = clustering.topics(units, "message_id", "unit", min_cluster_size, min_samples)
    assigned = checkpoints.save("assigned", relate.attach_topic(customers, found))
    described = checkpoints.save("described", models.describe(assigned))

    frames = {
        "topics": relate.topic_dimension(assigned, described),
        "messages": assigned,
        "addresses": relate.addresses(assigned),
        "references": relate.references(assigned),
        "domains": relate.domains(assigned),
        "word_frequencies": topics.word_frequencies(assigned),
        "classifications": models.categories(assigned),
        "products": models.products(assigned),
        "entities": models.entities(assigned),
        "summaries": models.summaries(assigned),
    }
    return {table: project(frame, table) for table, frame in frames.items()}
