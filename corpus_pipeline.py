"""A training corpus from ``documents``: quality rules, near-dedup, secret scan, mixing, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm import minhash, mixing, packing, quality, secrets
from postmill.llm.common import saved, table
from postmill.llm.queries import RANKS, TOKENIZER

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and that the isolation forest, fitted here on labelled rows, accepts."""
    docs = docs.select(*COLUMNS)
    forest = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, forest, [*COLUMNS]).where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id.

    Rows that repeat a doc_id are one document and stay or go together, as do rows without doc_id.
    """
    kept = minhash.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return docs.select(*COLUMNS).join(kept, F.col("doc_id").eqNullSafe(F.col("_kept")), "left_semi")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts replaced by a mark, and n_chars to match."""
    scanned = secrets.scan(docs.select(*COLUMNS))
    clean = secrets.redact(F.col("text"), F.col("secret_spans"))
    n_chars = F.when(F.size("secret_spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return scanned.withColumn("text", clean).withColumn("n_chars", n_chars).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as Poisson replication to the target weights says, shuffled over all sources.

    ``copy`` numbers the copies of a document from 0, ``position`` all rows in their new order.
    """
    return mixing.mix(docs.select(*COLUMNS)).select(*COLUMNS, "copy", "position")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in sequences of 1024 tokens, with their ids.

    (position, piece) is unique, also where copies share a doc_id.
    """
    return packing.pack(docs, TOKENIZER, RANKS, keep_ids=True, keep=("copy", "position"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("secret scan", secret_scan),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: The forest's verdicts and the tokenizer's ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
