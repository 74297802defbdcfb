"""Raw mail → the preprocessed mail frame."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postmill.functions.text import clean_text, fill_plain_text_body
from postmill.operators import language, relate, threads
from postmill.operators.charsets import CharsetModel
from postmill.operators.naive_bayes import NaiveBayes
from postmill.operators.skew import lookup
from postmill.schemas import MAIL
from postmill.sources import raw_mail
from postmill.sources.checkpoints import Checkpoints
from postmill.sources.completion import complete
from postmill.sources.select import union_sources


def extract(
    spark: SparkSession,
    paths: str | list[str],
    checkpoints: Checkpoints,
    internal_pattern: str,
    glob: str = "*.eml",
    fill_html: bool = False,
    banners: Sequence[str] | None = None,
    languages: NaiveBayes | None = None,
    charsets: CharsetModel | None = None,
    server: DataFrame | None = None,
    since: date | None = None,
) -> DataFrame:
    """Read, parse, thread, clean, time and (with a model) name the language of each mail.

    The parsed mails are saved once as ``parsed`` and the ones set aside as ``quarantined``, so the
    Python parser runs once; all later steps are native and read only the columns they need. Bodies without
    a charset that fits are decoded by ``charsets``, which ``charsets.train`` learns from ``raw_mail.declared_bodies``.

    ``server`` is a second source, a table of parsed mails: what the mails refer to and the files lack is
    fetched from it until nothing is missing (see :func:`postmill.sources.completion.complete`), and with ``since`` all its
    mails from that day on. They are saved as ``fetched``, the ids it lacks as ``not_found``. The numbers of mails read, accepted and
    set aside are counted while parsing and saved as ``ingested``.
    """
    counts = Observation("ingest")
    parsed = raw_mail.parse_mails(raw_mail.read_mail_files(spark, paths, glob), model=charsets)
    everything = checkpoints.save("raw_parsed", raw_mail.counted(parsed, counts))
    checkpoints.save("ingested", spark.createDataFrame([counts.get], raw_mail.COUNTS))
    checkpoints.save("quarantined", raw_mail.quarantined(everything))
    mails = raw_mail.accepted(everything)
    if server is not None:
        done = complete(mails, server.select(*MAIL.names), since)
        mails = union_sources(mails, checkpoints.save("fetched", done.added))
        checkpoints.save("not_found", done.not_found)
    if fill_html:
        mails = fill_plain_text_body(mails)
    mails = checkpoints.save("preprocessed", preprocess(mails, internal_pattern, banners))
    return mails if languages is None else with_language(mails, languages)


def preprocess(mails: DataFrame, internal_pattern: str, banners: Sequence[str] | None = None) -> DataFrame:
    """The derived columns of parsed mails: threads, domains, response time, clean text.

    Response times are taken over all mails, before those without text are dropped.
    """
    timed = threads.with_response_time(relate.with_domains(threads.with_threading(mails), internal_pattern))
    cleaned = timed.withColumn("clean_text", clean_text(F.col("plain_text_body"), banners))
    return relate.drop_empty_text(cleaned)


def with_language(mails: DataFrame, model: NaiveBayes) -> DataFrame:
    """Add ``language``, that of each mail's own text: each different text is scored once and looked up by its digest.

    Mails without an id count too, and copies of an id may differ. Null text has no language.
    """
    digest = F.sha2(F.col("clean_text"), 256)
    texts = mails.where(F.col("clean_text").isNotNull()).groupBy(digest.alias("_text")).agg(F.min("clean_text").alias("text"))
    named = language.languages(texts, "_text", "text", model)
    return lookup(mails.withColumn("_text", digest), named, "_text", ["message_id", "submit_time"]).drop("_text")
