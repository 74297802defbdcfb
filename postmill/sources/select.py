"""Selections over mail frames: by id, since a day, first n, union, counts."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.operators.relate import dedupe
from postmill.operators.skew import lookup


def bare_id(identifier: Column) -> Column:
    """The identifier without its angle brackets."""
    return F.regexp_replace(identifier, "^<+|>+$", "")


def fetch_by_ids(mails: DataFrame, requested: DataFrame) -> DataFrame:
    """One mail per requested id. ``requested`` has a column ``message_id``, brackets allowed.

    The requested mails are picked first, with hot ids apart, and only those are ranked.
    """
    wanted = requested.select(bare_id(F.col("message_id")).alias("message_id")).distinct()
    return dedupe(lookup(mails, wanted, "message_id", ["submit_time"], "left_semi"))


def ids_not_found(mails: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested ids without a mail."""
    wanted = requested.select(bare_id(F.col("message_id")).alias("message_id")).distinct()
    return wanted.join(mails.select("message_id").distinct(), "message_id", "left_anti")


def fetch_since(mails: DataFrame, since: date | datetime, column: str = "submit_time") -> DataFrame:
    """Mails on or after a calendar day.

    The bound is a literal of midnight against the bare column, so it reaches the Parquet scan (and
    prunes directories where the column is a partition column).
    """
    day = since.date() if isinstance(since, datetime) else since
    return mails.where(F.col(column) >= F.lit(f"{day:%Y-%m-%d} 00:00:00").cast("timestamp_ntz"))


def write_by_day(mails: DataFrame, path: str, column: str = "submit_time", key: str = "message_id", mode: str = "append") -> None:
    """A source in one folder per day. Rows without a time go to Spark's default partition.

    Rows are dealt by ranges of (day, key), so a day with very many mails is spread over tasks and files and
    a task writes few days. ``day`` replaces a column of that name.
    """
    dated = mails.withColumn("day", F.to_date(column))
    dated.repartitionByRange("day", key).write.mode(mode).partitionBy("day").parquet(path)


def read_by_day(spark: SparkSession, path: str, since: date | datetime | None = None) -> DataFrame:
    """A source written by day; with ``since`` only the folders from that calendar day on are listed and read."""
    mails = spark.read.parquet(path)
    if since is not None:
        day = since.date() if isinstance(since, datetime) else since
        mails = mails.where(F.col("day") >= F.lit(day))
    return mails.drop("day")


def union_sources(*sources: DataFrame) -> DataFrame:
    """UNION ALL by column name; columns a source lacks are null."""
    first, *rest = sources
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def first_n(mails: DataFrame, n: int, *order: str) -> DataFrame:
    """The first n rows by an explicit order."""
    return mails.orderBy(*order).limit(n)


def source_counts(mails: DataFrame, source: str) -> DataFrame:
    """(source, messages), the largest first."""
    counts = mails.groupBy(source).agg(F.count(F.lit(1)).alias("messages"))
    return counts.orderBy(F.desc("messages"), source)


def request_counts(mails: DataFrame, requested: DataFrame) -> DataFrame:
    """One row: how many ids were requested and how many of them were found."""
    wanted = requested.select(bare_id(F.col("message_id")).alias("message_id")).distinct()
    present = mails.select("message_id").distinct().withColumn("_found", F.lit(1))
    matched = wanted.join(present, "message_id", "left")
    return matched.agg(F.count(F.lit(1)).alias("requested"), F.count("_found").alias("found"))
