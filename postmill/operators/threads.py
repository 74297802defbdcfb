"""Threading and response times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.functions.times import seconds_between
from postmill.operators.skew import HOT_FLOOR, lookup


def with_threading(mails: DataFrame) -> DataFrame:
    """Add ``first_in_thread``, ``num_previous_messages`` and ``thread_id``.

    Needs ``previous_message_id`` and ``references`` (array, null when absent). The first mail of a
    thread has a null thread id.
    """
    return mails.withColumns(
        {
            "first_in_thread": F.col("previous_message_id").isNull() & F.col("references").isNull(),
            "num_previous_messages": F.when(F.col("references").isNotNull(), F.size("references")),
            "thread_id": F.get("references", F.lit(0)),
        }
    )


def referenced_ids(mails: DataFrame) -> DataFrame:
    """Distinct ids that mails refer to; forwarded mails are skipped."""
    not_forwarded = ~F.coalesce(F.col("subject_prefix").contains("fw"), F.lit(False))
    none = F.array().cast("array<string>")
    wanted = F.array_union(
        F.filter(F.coalesce(F.col("references"), none), lambda x: x.isNotNull()),
        F.filter(F.array("previous_message_id"), lambda x: x.isNotNull()),
    )
    return mails.where(not_forwarded).select(F.explode(wanted).alias("message_id")).distinct()


def missing_message_ids(mails: DataFrame) -> DataFrame:
    """Distinct referenced ids that are no ``message_id`` of the frame.

    Forwarded mails are skipped. Duplicates are combined on both sides before the anti join, so an
    id that every mail refers to, or that many copies share, arrives there as one row.
    """
    present = mails.select("message_id").where(F.col("message_id").isNotNull()).distinct()
    return referenced_ids(mails).join(present, "message_id", "left_anti")


def with_response_time(mails: DataFrame, floor: int = HOT_FLOOR) -> DataFrame:
    """Add ``response_time``: seconds from the parent's submit time to the mail's own.

    Null when no parent is present; may be negative. Of several copies of a parent the earliest
    counts. Parents travel as two narrow columns, and a parent that very many mails answer is
    looked up by broadcast (see :func:`postmill.operators.skew.lookup`).
    """
    parents = (
        mails.where(F.col("message_id").isNotNull())
        .groupBy(F.col("message_id").alias("previous_message_id"))
        .agg(F.min("submit_time").alias("_parent_time"))
    )
    out = lookup(mails, parents, "previous_message_id", ["message_id", "submit_time"], floor=floor)
    waited = seconds_between(F.col("submit_time"), F.col("_parent_time"))
    return out.withColumn("response_time", waited).drop("_parent_time")
