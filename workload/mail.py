"""A mail view over ``conversations``: raw headers for Spark to parse, and the expected SQL.

Every row of ``conversations`` is one mail. The Spark side builds headers as a mail server would
send them and parses those; the SQL side states the parsed values directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.functions import headers as H
from postmill.functions import text as X
from postmill.operators import relate as R
from postmill.schemas import MAIL
from postmill.sources.tables import spread

OWN_ADDRESS = "desk@corp.example"
INTERNAL = "corp"
ORGANISATION = "corp"

# Text appended to the bodies by turn, so that every cleaning rule and entity type occurs.
_DETAILS = (
    "concat('\\nPlease check account ', lpad(cast(conv_id as string), 10, '0'), ' of User', conv_id, "
    "'@ext.example and IBAN GB29NWBK', lpad(cast(conv_id as string), 14, '0'), "
    "'. USD 1,250.00 left on 2024-03-05. It is a customer complaint about my Credit Card, not my saving account.')"
)
_DETAILS_SQL = (
    "chr(10) || 'Please check account ' || lpad(cast(conv_id as varchar), 10, '0') || ' of User' || conv_id || "
    "'@ext.example and IBAN GB29NWBK' || lpad(cast(conv_id as varchar), 14, '0') || "
    "'. USD 1,250.00 left on 2024-03-05. It is a customer complaint about my Credit Card, not my saving account.'"
)


# The key of each table that goes through costly expressions.
KEYS = {
    "conversations": ["conv_id", "turn"],
    "documents": ["doc_id"],
    "pages": ["page_id"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows, *KEYS[name]) if name in KEYS else rows


def raw_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per mail with header text as received and the body."""
    base = table(spark, sf_dir, "conversations").selectExpr(
        "*",
        "concat('c', conv_id, 't', turn, '@mail') as message_id",
        "case when conv_id % 4 = 1 then array(concat('old', conv_id, '@mail')) else cast(array() as array<string>) end as _older",
        "case when turn > 0 then transform(sequence(0, cast(turn as int) - 1), k -> concat('c', conv_id, 't', k, '@mail'))"
        " else cast(array() as array<string>) end as _earlier",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(conv_id as int), 0, 0)"
        " + make_dt_interval(0, 0, cast(turn * (1 + conv_id % 30) as int), 0) as _sent",
        "element_at(array('+0000', '+0300', 'GMT', '-0500'), cast(conv_id % 4 as int) + 1) as _zone",
    )
    user = "concat('User', conv_id % 50, '@EXT', conv_id % 5, '.example')"
    return base.selectExpr(
        "conv_id",
        "turn",
        "role",
        "text",
        "concat('<', message_id, '>') as message_id_header",
        "case when size(concat(_older, _earlier)) > 0 then concat('<', element_at(concat(_older, _earlier), -1), '>') end"
        " as in_reply_to",
        "case when size(concat(_older, _earlier)) > 0 then"
        " array_join(transform(concat(_older, _earlier), r -> concat('<', r, '>')), '\\r\\n ') end as references_header",
        "concat(case when turn = 0 then '' when conv_id % 7 = 3 then 'Fw: ' else 'Re: ' end, 'Case ', conv_id) as subject",
        f"case role when 'user' then concat('\"User, ', conv_id % 50, '\" <', {user}, '>')"
        " when 'assistant' then 'Desk <Desk@Corp.example>' else 'noreply@corp.example' end as from_header",
        f"case role when 'user' then 'desk@corp.example' else concat('(home) ', {user}) end as to_header",
        "case when turn % 3 = 1 then concat('A <a', conv_id, '@corp.example>,\\r\\n  \"B, partner\" <b', turn,"
        " '@partner.example>') end as cc_header",
        "cast(null as string) as bcc_header",
        "concat(date_format(_sent + make_dt_interval(0, case _zone when '+0300' then 3 when '-0500' then -5 else 0 end, 0, 0),"
        " 'EEE, d MMM yyyy HH:mm:ss'), ' ', _zone, case when conv_id % 3 = 0 then ' (zone)' else '' end) as date_header",
        "concat(text, case cast(turn as int) % 4"
        f" when 0 then {_DETAILS}"
        " when 1 then '\\n-- \\nDesk team\\nPhone 44123456'"
        " when 2 then '\\nFrom: Someone | elsewhere\\nolder text'"
        " else '\\nOn Monday Ann wrote:\\n> older text' end) as body",
    )


def mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parsed mails (the fourteen fields) plus conv_id and turn."""
    raw = raw_headers(spark, sf_dir)
    c = F.col
    fields = {
        "message_id": F.get(H.parse_identifiers(c("message_id_header")), F.lit(0)),
        "subject": c("subject"),
        "subject_prefix": H.subject_prefix(c("subject")),
        "submit_time": H.rfc2822_to_timestamp(c("date_header")),
        "delivery_time": H.rfc2822_to_timestamp(c("date_header")),
        "html_body": F.lit(None),
        "plain_text_body": c("body"),
        "from_name": H.from_name(c("from_header")),
        "from_address": H.parse_addresses(c("from_header")),
        "to_address": H.parse_addresses(c("to_header")),
        "cc_address": H.parse_addresses(c("cc_header")),
        "bcc_address": H.parse_addresses(c("bcc_header")),
        "previous_message_id": F.get(H.parse_identifiers(c("in_reply_to")), F.lit(0)),
        "references": H.parse_identifiers(c("references_header")),
    }
    typed = [fields[f.name].cast(f.dataType).alias(f.name) for f in MAIL.fields]
    return raw.select("conv_id", "turn", *typed)


def with_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.with_domains(mails(spark, sf_dir), INTERNAL)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed mails with domains and clean text."""
    return with_domains(spark, sf_dir).withColumn("clean_text", X.clean_text(F.col("plain_text_body")))


def assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean mails with a topic: by conversation, noise included; topic 3 holds a third of all mails."""
    topic = F.when(F.col("conv_id") % 3 == 0, 3).otherwise(F.col("conv_id") % 12 - 1).cast("int")
    return cleaned(spark, sf_dir).withColumn("topic_id", topic)


# The same view in SQL; every text below is a chain of common table expressions.
MAIL_SQL = f"""
conv AS (
  SELECT conv_id, turn, role, text,
    'c' || conv_id || 't' || turn || '@mail' AS message_id,
    (CASE WHEN conv_id % 4 = 1 THEN ['old' || conv_id || '@mail'] ELSE CAST([] AS VARCHAR[]) END)
      || list_transform(range(0, turn), lambda k: 'c' || conv_id || 't' || k || '@mail') AS refs,
    'user' || (conv_id % 50) || '@ext' || (conv_id % 5) || '.example' AS usr
  FROM conversations
),
mail AS (
  SELECT conv_id, turn, message_id,
    CASE WHEN len(refs) > 0 THEN refs END AS refs,
    refs[len(refs)] AS previous_message_id,
    (CASE WHEN turn = 0 THEN '' WHEN conv_id % 7 = 3 THEN 'Fw: ' ELSE 'Re: ' END) || 'Case ' || conv_id AS subject,
    CASE WHEN turn = 0 THEN NULL WHEN conv_id % 7 = 3 THEN 'fw:' ELSE 're:' END AS subject_prefix,
    CASE role WHEN 'user' THEN '"User, ' || (conv_id % 50) || '"' WHEN 'assistant' THEN 'Desk'
      ELSE 'noreply@corp.example' END AS from_name,
    CASE role WHEN 'user' THEN usr WHEN 'assistant' THEN 'desk@corp.example' ELSE 'noreply@corp.example' END AS from_address,
    CASE role WHEN 'user' THEN 'desk@corp.example' ELSE usr END AS to_address,
    CASE WHEN turn % 3 = 1 THEN ['a' || conv_id || '@corp.example', 'b' || turn || '@partner.example'] END AS cc,
    TIMESTAMP '2024-01-01 00:00:00' + to_hours(conv_id) + to_minutes(turn * (1 + conv_id % 30)) AS submit_time,
    text || (CASE turn % 4
      WHEN 0 THEN {_DETAILS_SQL}
      WHEN 1 THEN chr(10) || '-- ' || chr(10) || 'Desk team' || chr(10) || 'Phone 44123456'
      WHEN 2 THEN chr(10) || 'From: Someone | elsewhere' || chr(10) || 'older text'
      ELSE chr(10) || 'On Monday Ann wrote:' || chr(10) || '> older text' END) AS body,
    CAST(CASE WHEN conv_id % 3 = 0 THEN 3 ELSE conv_id % 12 - 1 END AS INTEGER) AS topic_id
  FROM conv
),
dom AS (
  SELECT *, split_part(from_address, '@', 2) AS sender_domain,
    contains(split_part(from_address, '@', 2), '{INTERNAL}') AS is_internal,
    list_sort(list_distinct(list_transform([from_address, to_address] || coalesce(cc, CAST([] AS VARCHAR[])),
      lambda a: split_part(a, '@', 2)))) AS all_domains
  FROM mail
)"""
