"""The registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm import chat, minhash, mixing, ngrams, packing, phrases, quality, runs, secrets, sharding, suffixes, vectors, windows
from postmill.llm.common import WORD_SPLIT, table, text_or_empty
from postmill.llm.sql import SQL

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SHARDS = 24


def op1_minhash_odd_sketches(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


def op2_weighted_hash_tree(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.with_shards(table(spark, folder, "documents"), SHARDS)


def op3_poisson_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "source", F.length("text").alias("text_chars"), "text", F.col("n_copies").cast("int").alias("n_copies"), F.col("copy").cast("int").alias("copy"), "position")


def op4_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    return ngrams.train_and_score(table(spark, folder, "documents"))


def op5_pruned_graph(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


def op6_isolation_forest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, folder, "labels")))


def op7_event_sourced_chat(spark: SparkSession, folder: str) -> DataFrame:
    said = F.lit("\\### Assistant: </turn> ok")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text"))
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    formatted = chat.format_conversations(rows)
    turns = chat.read_back(F.col("formatted"))
    read = formatted.select("conv_id", turns.alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op8_trigram_secrets(spark: SparkSession, folder: str) -> DataFrame:
    scanned = secrets.scan(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("secret_spans", lambda s: s["rank"] < secrets.BASE)
    count = lambda kind: F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    digest = F.sha2(secrets.joined(base).cast("binary"), 256).alias("base_sha256")
    return scanned.select("doc_id", count("assign"), count("access"), count("hex"), digest, secrets.joined(F.col("secret_spans")).alias("spans"))


def op9_induced_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    out = suffixes.remove_repeats(table(spark, folder, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), TOKENIZER, RANKS)


def op11_count_min_windows(spark: SparkSession, folder: str) -> DataFrame:
    out = windows.remove_repeats(table(spark, folder, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op12_de_bruijn_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the documents, by a hash of the id, the words from some place on repeat with a period."""
    words = F.filter(F.split(text_or_empty(), WORD_SPLIT, -1), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    n, g = F.size("w"), F.floor(F.col("h") / 10)
    start = (g % F.nullif(n, F.lit(0))).cast("int")
    period = (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    chosen = chosen.withColumns({"n": n, "g": g, "a": start}).withColumn("p", period)
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), times)), F.lit(1), F.col("n") - F.col("a"))
    changed = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")
    return chosen.select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))


def op13_lyndon_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.periodic_runs(with_periodic_tails(table(spark, folder, "documents")))
    ranked = F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    first = found.withColumn("top", F.get(ranked, F.lit(0)))
    return first.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        (-F.col("top.n")).alias("length"),
        F.col("top.period").alias("period"),
        F.floor(-1000 * F.col("top.n") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_minhash_odd_sketches, op2_weighted_hash_tree, op3_poisson_mixing, op4_kneser_ney, op5_pruned_graph,
    op6_isolation_forest, op7_event_sourced_chat, op8_trigram_secrets, op9_induced_suffixes, op10_best_fit,
    op11_count_min_windows, op12_de_bruijn_phrases, op13_lyndon_runs,
)}

__all__ = ["QUERIES", "SQL"]
