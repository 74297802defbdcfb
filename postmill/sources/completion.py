"""Fetch referenced mails from a second source until none is missing."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.operators.relate import dedupe
from postmill.operators.threads import referenced_ids
from postmill.sources.checkpoints import checkpoint_folder, checkpointed
from postmill.sources.select import fetch_since, union_sources

IDS = "message_id string, round int"
ARCHIVE = -1  # the round of the ids that were there from the start


@dataclass(frozen=True)
class Completion:
    """``added``: what the second source gave; ``not_found``: (message_id, round) it lacks; ``rounds``: how deep the chains went."""

    added: DataFrame
    not_found: DataFrame
    rounds: int


class _Seen:
    """Ids by the round that asked for them first, one folder per round, so that a lost executor costs no earlier round."""

    def __init__(self, mails: DataFrame) -> None:
        self.spark = mails.sparkSession
        self.path = f"{checkpoint_folder(self.spark)}/postmill-{uuid.uuid4().hex}"
        self.add(mails.select("message_id").where("message_id IS NOT NULL").distinct(), ARCHIVE)

    def add(self, ids: DataFrame, number: int) -> None:
        ids.select("message_id").write.mode("overwrite").parquet(f"{self.path}/round={number}")

    def all(self) -> DataFrame:
        return self.spark.read.schema(IDS).parquet(self.path)

    def round(self, number: int) -> DataFrame:
        return self.all().where(F.col("round") == number).select("message_id")


def complete(mails: DataFrame, server: DataFrame, since: date | datetime | None = None) -> Completion:
    """The server's mails that the mails need: all on or after ``since``, and all they refer to, directly or not.

    Each round asks for the ids that the mails found last refer to and nobody asked for yet; forwarded
    mails ask for nothing. Rounds touch identifiers and references only: a saved table of new ids meets the server's columns
    in a semi-join, for which Spark picks a broadcast or a Bloom filter on the scan by the table's size. Bodies are read
    once, after the last round. The loop ends because no id is asked for twice; its rounds are as many as the longest chain of
    mails that only the server has, one for mails with full ``References``.

    ``server`` should be a table (its references are scanned once per round). An id the server holds several times is
    followed through all copies and added once; mails without an id come by ``since`` only. Copies of what ``mails`` hold are
    not added. Empty inputs give empty results. The result has the server's columns.
    """
    added = []
    if since is not None:
        known = mails.select("message_id").where("message_id IS NOT NULL").distinct()
        added.append(checkpointed(fetch_since(server, since).join(known, "message_id", "left_anti").select(*server.columns)))
    base = [m.select("message_id", "subject_prefix", "previous_message_id", "references") for m in (mails, *added)]
    base = union_sources(*base)
    seen = _Seen(base)
    wanted, number = referenced_ids(base), 0
    while True:
        candidates = checkpointed(wanted.withColumn("round", F.lit(number))).where(F.col("round") == number)
        # The few candidates pick what is seen of them; the table of all seen ids is never shuffled whole for them.
        old = seen.all().join(candidates, "message_id", "left_semi").select("message_id")
        seen.add(candidates.join(old, "message_id", "left_anti"), number)
        if seen.round(number).isEmpty():
            break
        found = server.select("message_id", "subject_prefix", "previous_message_id", "references")
        wanted, number = referenced_ids(found.join(seen.round(number), "message_id", "left_semi")), number + 1
    asked = seen.all().where(F.col("round") > ARCHIVE)
    ids = asked.select("message_id")
    added.append(dedupe(server.join(ids, "message_id", "left_semi").select(*server.columns)))
    present = server.select("message_id").join(ids, "message_id", "left_semi").distinct()
    return Completion(union_sources(*added), asked.join(present, "message_id", "left_anti"), number)
