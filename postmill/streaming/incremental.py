"""New mail files as a stream, and an embedding store that follows a stream of mails."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from postmill.operators.charsets import CharsetModel
from postmill.operators.embeddings import populate
from postmill.operators.relate import dedupe, drop_null_keys
from postmill.sources.raw_mail import accepted, parse_mails, quarantined

FILES = "path string, modificationTime timestamp, length bigint, content binary"


def mail_stream(
    spark: SparkSession, path: str, glob: str = "*.eml", files_per_batch: int = 10_000, model: CharsetModel | None = None
) -> DataFrame:
    """Parsed mails of the files that arrive below a path. Those that did not parse have a ``parse_error``."""
    reader = spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", True)
    files = reader.option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_batch).load(path)
    return parse_mails(files.select("path", "content"), model=model)


def follow_embeddings(
    mails: DataFrame, store: str, embed: Callable[[DataFrame], DataFrame], checkpoint: str, set_aside: str
) -> StreamingQuery:
    """Embed the mails of each micro-batch that the store lacks, until the input is exhausted.

    Mails that did not parse are written below ``set_aside``, one folder per batch. A batch that is
    repeated after a failure overwrites its folder, finds its ids in the store and adds nothing.
    """

    def add(batch: DataFrame, number: int) -> None:
        quarantined(batch).write.mode("overwrite").parquet(f"{set_aside}/batch={number}")
        populate(dedupe(drop_null_keys(accepted(batch))), store, embed)

    writer = mails.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
