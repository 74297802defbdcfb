"""Relational steps: filters, de-duplication, child tables, navigation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postmill.functions import headers as H
from postmill.operators.skew import HOT_FLOOR, lookup

NOISE_TOPIC = -1
ADDRESS_COLUMNS = {
    "from": "from_address",
    "to": "to_address",
    "cc": "cc_address",
    "bcc": "bcc_address",
}


def with_domains(mails: DataFrame, internal_pattern: str) -> DataFrame:
    """Add ``sender_domain``, ``all_domains`` and ``is_internal``."""
    return mails.withColumns(
        {
            "sender_domain": H.sender_domain(F.col("from_address")),
            "all_domains": H.all_domains(*map(F.col, ADDRESS_COLUMNS.values())),
            "is_internal": H.is_internal(H.sender_domain(F.col("from_address")), internal_pattern),
        }
    )


def external_only(mails: DataFrame, own_address: str) -> DataFrame:
    """Customer mails: not internal, and not sent by the own mailbox."""
    sender = F.coalesce(F.get("from_address", F.lit(0)), F.lit(""))
    return mails.where(~F.col("is_internal") & (sender != own_address))


def drop_null_keys(mails: DataFrame) -> DataFrame:
    """Rows without a message id go."""
    return mails.na.drop(subset=["message_id"])


def dedupe(mails: DataFrame) -> DataFrame:
    """One row per message id: the earliest submit time, then the smallest row hash.

    The limit on ``row_number`` is applied inside each map task before the shuffle, so copies of
    one mail arrive as one row per task however many there are.
    """
    order = [F.col("submit_time").asc_nulls_last(), F.xxhash64(*[c for c in mails.columns if c != "message_id"])]
    ranked = mails.withColumn("_rank", F.row_number().over(Window.partitionBy("message_id").orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def with_defaults(mails: DataFrame) -> DataFrame:
    """Before any model has run: noise topic, no spam."""
    return mails.withColumns({"topic_id": F.lit(NOISE_TOPIC), "is_spam": F.lit(False)})


def drop_empty_text(mails: DataFrame, column: str = "clean_text") -> DataFrame:
    """Mails whose clean text is empty (or null) go."""
    return mails.where(F.length(column) > 0)


def drop_spam(mails: DataFrame, flags: DataFrame) -> DataFrame:
    """Attach ``is_spam`` and keep the mails that are none. ``message_id`` is unique on both sides."""
    ham = flags.where(~F.col("is_spam")).select("message_id", "is_spam")
    return mails.drop("is_spam").join(ham, "message_id")


def attach_topic(mails: DataFrame, topics: DataFrame) -> DataFrame:
    """Attach ``topic_id`` by message id."""
    return mails.drop("topic_id").join(topics.select("message_id", "topic_id"), "message_id")


def topic_dimension(assigned: DataFrame, descriptions: DataFrame) -> DataFrame:
    """(topic_id, topic_description), one row per described topic in use.

    The topics are made distinct first, so the join sees one row per topic.
    """
    used = assigned.select("topic_id").distinct()
    return used.join(descriptions.select("topic_id", "topic_description").distinct(), "topic_id")


def addresses(mails: DataFrame) -> DataFrame:
    """Child table (message_id, address_type, address), all four kinds in one scan."""
    kinds = F.array(
        *[
            F.struct(F.lit(kind).alias("address_type"), F.col(column).alias("list"))
            for kind, column in ADDRESS_COLUMNS.items()
        ]
    )
    per_kind = mails.select("message_id", F.explode(kinds).alias("k"))
    rows = per_kind.select("message_id", "k.address_type", F.explode("k.list").alias("address"))
    return rows.where(F.trim("address") != "")


def references(mails: DataFrame) -> DataFrame:
    """Child table (message_id, reference_message_id)."""
    return mails.select("message_id", F.explode("references").alias("reference_message_id"))


def domains(mails: DataFrame) -> DataFrame:
    """Child table (message_id, domain)."""
    return mails.select("message_id", F.explode("all_domains").alias("domain"))


def children(parents: DataFrame, child: DataFrame, key: str = "message_id", floor: int = HOT_FLOOR) -> DataFrame:
    """Child rows of the given parents, with the parents' columns.

    Parent keys are unique. The child side is the large one and may lean on one parent, so it is
    looked up with the hot keys apart. Rows stay flat: no parent's children meet in one array.
    """
    spread = [c for c in child.columns if c != key] or [key]
    return lookup(child, parents, key, spread, how="inner", floor=floor)


def topic_messages(mails: DataFrame, topics: DataFrame, floor: int = HOT_FLOOR) -> DataFrame:
    """Messages with the columns of their topic; a topic may hold a third of all mails."""
    return lookup(mails, topics, "topic_id", ["message_id"], how="inner", floor=floor)


def topic_sizes(assigned: DataFrame) -> DataFrame:
    """(topic_id, messages)."""
    return assigned.groupBy("topic_id").agg(F.count(F.lit(1)).alias("messages"))


def top_topics(assigned: DataFrame, descriptions: DataFrame, n: int = 10) -> DataFrame:
    """The n largest topics with description and size."""
    sized = topic_sizes(assigned).join(descriptions.select("topic_id", "topic_description"), "topic_id")
    return sized.orderBy(F.desc("messages"), "topic_id").limit(n)
