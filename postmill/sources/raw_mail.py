"""Raw RFC 822 files → the fourteen mail fields."""

from __future__ import annotations

import re
from collections.abc import Iterator
from email import message_from_bytes
from email.errors import HeaderParseError
from email.header import decode_header, make_header
from email.message import Message

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructField, StructType

from postmill.functions import headers as H
from postmill.operators import charsets
from postmill.operators.charsets import CharsetModel
from postmill.schemas import MAIL

# Raw parts of one mail as the Python worker returns them; all further parsing is native.
HEADERS = {
    "subject": "Subject",
    "date": "Date",
    "received": "Received",
    "message_id_header": "Message-ID",
    "in_reply_to": "In-Reply-To",
    "references_header": "References",
    "from_header": "From",
    "to_header": "To",
    "cc_header": "Cc",
    "bcc_header": "Bcc",
}
LEAF = StructType([StructField("body", BinaryType()), StructField("charset", StringType())])
PARTS_TYPE = StructType(
    [StructField(name, StringType()) for name in [*HEADERS, "parse_error"]]
    + [StructField(name, ArrayType(LEAF)) for name in ("plain_text", "html")]
)
PARTS = PARTS_TYPE.names


def read_mail_files(spark: SparkSession, paths: str | list[str], glob: str = "*.eml") -> DataFrame:
    """All matching files below the paths as (path, content); unreadable files are skipped."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", glob).option("ignoreCorruptFiles", True)
    return reader.load(paths).select("path", "modificationTime", "content")


def _header(mail: Message, name: str) -> str | None:
    """A header with folding undone and MIME words decoded, all chunks joined."""
    value = mail[name]
    return None if value is None else _decode_words(re.sub(r"\r?\n[ \t]*", " ", str(value)))


def _decode_words(value: str) -> str:
    if "=?" not in value:
        return value
    try:
        return str(make_header(decode_header(value)))
    except (LookupError, ValueError, HeaderParseError):
        return value


def _leaf(part: Message) -> dict[str, object]:
    """A part's bytes, its transfer encoding undone, and the charset it declares; decoding comes later."""
    return {"body": part.get_payload(decode=True) or b"", "charset": part.get_content_charset()}


def _parts_of(raw: bytes) -> dict[str, object]:
    """Headers and leaf parts of one mail; what cannot be parsed is named in ``parse_error``."""
    out: dict[str, object] = dict.fromkeys(PARTS)
    try:
        mail = message_from_bytes(raw)
        out |= {part: _header(mail, name) for part, name in HEADERS.items()}
        missing = [name for name in ("From", "Received") if mail[name] is None]
        if missing:
            out["parse_error"] = "no header " + ", ".join(missing)
        if mail.is_multipart():
            leaves = list(mail.walk())
            out["plain_text"] = [_leaf(p) for p in leaves if p.get_content_type() == "text/plain"]
            out["html"] = [_leaf(p) for p in leaves if p.get_content_type() == "text/html"]
        else:
            out["plain_text"] = [_leaf(mail)]
    except Exception as error:
        out["parse_error"] = f"{type(error).__name__}: {error}"
    return out


def _mail_parts(contents: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in contents:
        yield pd.DataFrame([_parts_of(raw) for raw in batch], columns=PARTS)


# MIME structure, MIME words and transfer encodings, by the standard library; bodies leave as bytes. Marked
# non-deterministic so that a later filter does not run it a second time.
mail_parts = F.pandas_udf(_mail_parts, PARTS_TYPE).asNondeterministic()


def parse_mails(files: DataFrame, content: str = "content", model: CharsetModel | None = None) -> DataFrame:
    """Add the mail fields to a frame of raw mails; ``parse_error`` marks the mails to set aside.

    Python only takes a mail apart; identifiers, addresses and times are native expressions. Each
    part is decoded by its own charset, natively where it is UTF-8; parts that declare none or a wrong one
    are decoded by the ``model``'s guess. An empty body is null.
    """
    parts = files.withColumn("_p", mail_parts(F.col(content))).drop(content)
    p = lambda name: F.col("_p")[name]
    fields = {
        "message_id": F.get(H.parse_identifiers(p("message_id_header")), F.lit(0)),
        "subject": F.coalesce(p("subject"), F.lit("")),
        "subject_prefix": H.subject_prefix(p("subject")),
        "submit_time": H.rfc2822_to_timestamp(p("date")),
        "delivery_time": H.received_to_timestamp(p("received")),
        "html_body": charsets.joined_text(p("html"), model),
        "plain_text_body": charsets.joined_text(p("plain_text"), model),
        "from_name": H.from_name(p("from_header")),
        "from_address": H.parse_addresses(p("from_header")),
        "to_address": H.parse_addresses(p("to_header")),
        "cc_address": H.parse_addresses(p("cc_header")),
        "bcc_address": H.parse_addresses(p("bcc_header")),
        "previous_message_id": F.get(H.parse_identifiers(p("in_reply_to")), F.lit(0)),
        "references": H.parse_identifiers(p("references_header")),
    }
    kept = [c for c in files.columns if c != content]
    typed = [fields[f.name].cast(f.dataType).alias(f.name) for f in MAIL.fields]
    return parts.select(*kept, *typed, p("parse_error").alias("parse_error"))


COUNTS = "read bigint, accepted bigint, set_aside bigint"


def counted(parsed: DataFrame, counts: Observation) -> DataFrame:
    """Parsed mails, counted while the next action reads them; ``counts.get`` has the ``COUNTS`` after it, without another scan."""
    good = F.col("parse_error").isNull()
    return parsed.observe(
        counts,
        F.count(F.lit(1)).alias("read"),
        F.count(F.when(good, 1)).alias("accepted"),
        F.count(F.when(~good, 1)).alias("set_aside"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    """The mails that parsed."""
    return parsed.where(F.col("parse_error").isNull()).select(*[f.name for f in MAIL.fields])


def quarantined(parsed: DataFrame) -> DataFrame:
    """The mails that did not parse, with the reason."""
    return parsed.where(F.col("parse_error").isNotNull())


@F.pandas_udf(StringType())
def decode_mime_words(headers: pd.Series) -> pd.Series:
    """``=?charset?Q?…?=`` words of a header decoded, all chunks joined."""
    return headers.map(lambda value: None if value is None else _decode_words(value))


def parse_body(body: Column, charset: Column, model: CharsetModel | None = None) -> Column:
    """Decode a body with its declared charset, or with the one detected; empty means null.

    UTF-8 bodies (declared or undeclared) stay native. Only the others are sent to Python, which
    knows more charsets than the JVM function and never fails on malformed bytes.
    """
    return charsets.detected(body, charset, model)["text"]


def declared_bodies(files: DataFrame, content: str = "content") -> DataFrame:
    """(body, charset) of all text parts of raw mails that declare a charset: what a charset model learns from."""
    parts = files.select(mail_parts(F.col(content)).alias("p"))
    both = F.concat(F.coalesce("p.plain_text", F.array()), F.coalesce("p.html", F.array()))
    return parts.select(F.explode(both).alias("p")).select("p.body", "p.charset").where("charset is not null")
