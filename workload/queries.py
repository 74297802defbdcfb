"""One query per operator; each reads whole tables."""

from __future__ import annotations

import asyncio
import uuid
from collections.abc import Callable
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.functions import entities as E
from postmill.functions import headers as H
from postmill.functions import text as X
from postmill.functions.times import to_utc_ntz
from postmill.functions.vectors import l2_normalise
from postmill.operators import charsets, clustering, embeddings, labelling, language, scoring, threads, topics
from postmill.operators import relate as R
from postmill.sources import raw_mail, select, tables
from postmill.sources.checkpoints import checkpoint_folder, checkpointed
from postmill.sources.completion import complete
from workload import mail as M

c = F.col
DENSITY_RADIUS = 0.5


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per sender domain: external mails, mails in threads, answered mails, mean response time."""
    mails = threads.with_response_time(threads.with_threading(M.with_domains(spark, sf_dir)))
    external = R.external_only(mails, M.OWN_ADDRESS)
    return external.groupBy("sender_domain").agg(
        F.count(F.lit(1)).alias("mails"),
        F.count(F.when(~c("first_in_thread"), 1)).alias("in_thread"),
        F.count("response_time").alias("answers"),
        F.round(F.avg("response_time"), 4).alias("mean_response"),
    )


# --- sources ------------------------------------------------------------------------------------


#: The charset of a mail's parts by conv_id % 4; the first and third go undeclared every other time.
MAIL_CHARSETS = ("utf-8", "iso-8859-1", "utf-16", "utf-8")


def _raw_mail_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RFC 822 bytes for every conversation row: plain, or multipart with an HTML part; 8-bit or base64 bodies in four charsets."""
    raw = M.raw_headers(spark, sf_dir)
    line = lambda name, col: F.coalesce(F.concat(F.lit(f"{name}: "), col, F.lit("\r\n")), F.lit(""))
    head = F.concat(
        line("From", c("from_header")), line("To", c("to_header")), line("Cc", c("cc_header")),
        line("Subject", F.concat(F.lit("=?utf-8?B?"), F.base64(F.encode("subject", "utf-8")), F.lit("?="))),
        line("Date", c("date_header")), line("Received", F.concat(F.lit("from a by b; "), c("date_header"))),
        line("Message-ID", c("message_id_header")), line("In-Reply-To", c("in_reply_to")),
        line("References", c("references_header")), F.lit("MIME-Version: 1.0\r\n"),
    )
    latin = ~c("text").rlike(r"[^\x00-\xFF]")  # other texts cannot be written in Latin-1
    number = (c("conv_id") % 4).cast("int")
    charset = F.when((number == 1) & ~latin, "utf-8").otherwise(F.element_at(F.array(*map(F.lit, MAIL_CHARSETS)), number + 1))
    raw = raw.withColumn("charset", charset)

    def encoded(text: Column) -> Column:
        by_name = [F.when(c("charset") == name, F.encode(text, name)) for name in ("utf-8", "iso-8859-1", "utf-16")]
        return F.coalesce(*by_name)

    def part(kind: str, text: Column) -> Column:
        """Header and body of a part: UTF-16 in base64, the rest as 8-bit bytes; UTF-8 is declared every other time."""
        undeclared = (c("charset") == "utf-8") & (c("turn") % 4 < 2)
        named = F.when(undeclared, "").otherwise(F.concat(F.lit("; charset="), c("charset")))
        wide = c("charset") == "utf-16"
        header = F.concat(
            F.lit(f"Content-Type: text/{kind}"), named,
            F.lit("\r\nContent-Transfer-Encoding: "), F.when(wide, "base64").otherwise("8bit"), F.lit("\r\n\r\n"),
        )
        return F.concat(F.encode(header, "utf-8"), F.when(wide, F.encode(F.base64(encoded(text)), "utf-8")).otherwise(encoded(text)))

    ascii_ = lambda text: F.encode(text, "utf-8")
    plain = F.concat(ascii_(head), part("plain", c("text")))
    html = F.concat(F.lit("<p>"), c("text"), F.lit("</p>"))
    multi = F.concat(
        ascii_(F.concat(head, F.lit('Content-Type: multipart/alternative; boundary="cut"\r\n\r\n--cut\r\n'))),
        part("plain", c("text")), ascii_(F.lit("\r\n--cut\r\n")), part("html", html), ascii_(F.lit("\r\n--cut--\r\n")),
    )
    return raw.select("conv_id", "turn", F.when(c("turn") % 2 == 1, multi).otherwise(plain).alias("content"))


def raw_mail_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = raw_mail.accepted(raw_mail.parse_mails(_raw_mail_bytes(spark, sf_dir)))
    lists = {n: H.joined(c(n)) for n in ("from_address", "to_address", "cc_address", "references")}
    squeeze = lambda n: F.regexp_replace(n, r"\s+", " ")
    return parsed.withColumns(
        {**lists, "plain_text_body": squeeze("plain_text_body"), "html_body": squeeze("html_body")}
    ).drop("bcc_address", "from_name")


def fetch_by_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    mails = M.mails(spark, sf_dir)
    requested = M.raw_headers(spark, sf_dir).where("role = 'assistant'").select(c("in_reply_to").alias("message_id"))
    return select.fetch_by_ids(mails, requested.na.drop()).select("message_id", "subject", "submit_time")


def ids_not_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    requested = M.raw_headers(spark, sf_dir).select(c("in_reply_to").alias("message_id")).na.drop()
    return select.ids_not_found(M.mails(spark, sf_dir), requested)


def request_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    requested = M.raw_headers(spark, sf_dir).select(c("in_reply_to").alias("message_id")).na.drop()
    return select.request_counts(M.mails(spark, sf_dir), requested)


def fetch_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = M.table(spark, sf_dir, "events")
    return select.fetch_since(events, datetime(2024, 1, 10, 15, 30), "ts").select("event_id", "ts")


def fetch_since_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same question to a source written in folders by day."""
    path = f"{checkpoint_folder(spark)}/postmill-{uuid.uuid4().hex}"
    select.write_by_day(M.table(spark, sf_dir, "events"), path, "ts", "event_id")
    return select.read_by_day(spark, path, datetime(2024, 1, 10, 15, 30)).select("event_id", "ts")


def fetch_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive with every fourth mail, which names its predecessor only; a server with most of all mails completes it."""
    mails = M.mails(spark, sf_dir).withColumn("references", F.lit(None).cast("array<string>"))
    mails = checkpointed(mails.withColumn("n", c("conv_id") + c("turn")))
    archive, server = mails.where("n % 4 = 3"), mails.where("n % 11 <> 5")
    done = complete(archive, server)
    fetched = done.added.select("message_id", F.lit("fetched").alias("state"), "subject", "plain_text_body")
    return select.union_sources(fetched, done.not_found.select("message_id", F.lit("not found").alias("state")))


def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = M.mails(spark, sf_dir).select("message_id", "subject", F.lit("archive").alias("origin"))
    server = M.mails(spark, sf_dir).select("message_id", "submit_time", F.lit("server").alias("origin"))
    return select.union_sources(archive, server)


def sample_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    mails = M.mails(spark, sf_dir).select("message_id", "subject", "submit_time")
    return select.first_n(mails, 500, "submit_time", "message_id")


def load_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    mails = M.cleaned(spark, sf_dir)
    loaded = tables.project(threads.with_threading(R.with_defaults(mails)), "messages")
    return loaded.drop("delivery_time", "html_body", "language", "response_time")


def ensure_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = M.table(spark, sf_dir, "customer").where("c_acctbal > 0")
    parents = customers.select(c("c_custkey").alias("custkey"), "c_name", "c_mktsegment")
    child = M.table(spark, sf_dir, "orders").select(c("o_custkey").alias("custkey"))
    return tables.ensure_parents(child, parents, "custkey")


def _address_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Address rows of which some break a rule: unknown type, no key, text too long."""
    rows = R.addresses(M.mails(spark, sf_dir))
    return rows.select(
        F.when(c("address") != "noreply@corp.example", c("message_id")).alias("message_id"),
        F.when(c("address").startswith("b1@"), "copy").otherwise(c("address_type")).alias("address_type"),
        F.when(c("address").startswith("a1"), F.repeat("address", 40)).otherwise(c("address")).alias("address"),
    )


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.split_rejects(_address_rows(spark, sf_dir), "addresses")[1]


def load_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.split_rejects(_address_rows(spark, sf_dir), "addresses")[0]


def load_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with keys that repeat in the batch or are stored; the richer customers are stored."""
    stored = M.table(spark, sf_dir, "customer").where("c_acctbal > 5000").select(c("c_custkey").alias("topic_id"))
    batch = M.table(spark, sf_dir, "orders").select(c("o_custkey").alias("topic_id"), c("o_orderstatus").alias("topic_description"))
    return tables.mark_conflicts(batch, stored, "topic_id")


def null_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(c("event_type") == "error", "  ").otherwise(c("event_type")).alias("event_type"),
        F.when(c("value") > 50, F.lit(float("nan"))).otherwise(c("value")).alias("value"),
    )
    return tables.null_normalise(rows)


def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.source_counts(M.table(spark, sf_dir, "documents"), "source")


# --- headers ------------------------------------------------------------------------------------


def parse_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mails' lists; as ``bcc`` one with nested comments, a quoted local part and brackets in quotes."""
    names = ("from", "to", "cc", "bcc")
    odd = F.format_string('"Case (%d, <old>" (by (the, "desk) of) turn %d) <"User, %d"@ext.example>, x(y)@z.example', "conv_id", "turn", "conv_id")
    raw = M.raw_headers(spark, sf_dir).withColumn("bcc_header", odd)
    return raw.select("conv_id", "turn", *[H.joined(H.parse_addresses(c(f"{n}_header"))).alias(n) for n in names])


def parse_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = M.raw_headers(spark, sf_dir)
    names = {"message_id_header": "message_id", "in_reply_to": "previous", "references_header": "refs"}
    return raw.select("conv_id", "turn", *[H.joined(H.parse_identifiers(c(h))).alias(n) for h, n in names.items()])


def charset(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = M.table(spark, sf_dir, "documents")
    header = F.concat(
        F.lit("text/plain"),
        F.when(c("lang") == "en", "; charset=US-ASCII").when(c("lang") == "fr", '; charset = "UTF-8"; format=flowed')
        .when(c("lang") == "de", F.concat(F.lit(";charset="), c("source"))).otherwise("; format=flowed"),
    )
    return docs.select("doc_id", H.charset_from_content_type(header).alias("charset"))


def subject_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    subject = F.concat(
        F.element_at(F.array(*map(F.lit, ["RE: ", "  Fwd: ", "fw:", "FD: ", "Re ", "answer: re: "])), (c("turn") % 6 + 1).cast("int")),
        c("text"),
    )
    return M.table(spark, sf_dir, "conversations").select("conv_id", "turn", H.subject_prefix(subject).alias("prefix"))


def parse_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as bodies: UTF-8, UTF-16, an unknown name, real 8-bit Latin-1, and 8-bit bytes that name no charset."""
    docs = M.table(spark, sf_dir, "documents").withColumn("kind", (c("doc_id") % 5).cast("int"))
    latin = ~c("text").rlike(r"[^\x00-\x7F\xA0-\xFF]")  # the two 8-bit charsets differ between
    body = (
        F.when(c("kind") == 1, F.encode("text", "UTF-16"))
        .when((c("kind") >= 3) & latin, F.encode("text", "ISO-8859-1"))
        .otherwise(F.encode("text", "UTF-8"))
    )
    declared = F.when(c("kind") == 1, "utf-16").when(c("kind") == 2, "no-such-charset").when((c("kind") == 3) & latin, "iso-8859-1")
    return docs.select("doc_id", raw_mail.parse_body(body, declared).alias("body"))


# Letters of other scripts in place of the Latin ones, so that whole documents can be written in their charsets.
LATIN = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZéóèñüçäöêßíÉÈÑÓÇÊÜÖÄÍ"
CYRILLIC = "абцдефгхийклмнопщрстувшжызАБЦДЕФГХИЙКЛМНОПЩРСТУВШЖЫЗэоеньюяяёьиЭЕНОЦЁЮЯЯИ"
KATAKANA = "アベツデエフグヒイジクルムノオプキリストウヴワザヨゼアベツデエフグヒイジクルムノオプキリストウヴワザヨゼエオエノウツアオエスイエエノオツエウオアイ"
#: (name, letters) of the charsets, by doc_id / 2 modulo their number.
SCRIPTS = (("windows-1252", None), ("windows-1251", CYRILLIC), ("koi8-r", CYRILLIC), ("shift_jis", KATAKANA), ("utf-16-le", None), ("utf-16-be", CYRILLIC))


def bodies_in_charsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, charset, declared, body): whole documents in six charsets; those with even ids declare theirs."""
    docs = M.table(spark, sf_dir, "documents").where("text is not null")
    kind = (F.floor(c("doc_id") / 2) % len(SCRIPTS)).cast("int")
    docs = docs.select("doc_id", "text", kind.alias("kind"))
    text = F.coalesce(*[F.when(c("kind") == k, F.translate("text", LATIN, letters)) for k, (_, letters) in enumerate(SCRIPTS) if letters], c("text"))
    name = F.element_at(F.array(*[F.lit(n) for n, _ in SCRIPTS]), c("kind") + 1)

    @F.pandas_udf("binary")
    def encoded(texts: pd.Series, names: pd.Series) -> pd.Series:
        return pd.Series([t.encode(n) for t, n in zip(texts, names, strict=True)], dtype=object)

    docs = docs.select("doc_id", text.alias("text"), name.alias("charset"))
    declared = F.when(c("doc_id") % 2 == 0, c("charset"))
    return docs.select("doc_id", "charset", declared.alias("declared"), encoded("text", "charset").alias("body"))


def detect_charset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies that declare a charset teach the model, which names and decodes the others."""
    bodies = checkpointed(bodies_in_charsets(spark, sf_dir))
    names = [name for name, _ in SCRIPTS]
    model = charsets.train(bodies.where("declared is not null"), names, charset="declared")
    found = bodies.select("doc_id", charsets.detected(c("body"), c("declared"), model).alias("d"))
    return found.select("doc_id", c("d.charset").alias("charset"), c("d.text").alias("body"))


def filetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = F.when(c("value") > 50, 0).otherwise(c("event_id") * 987654321017 + 133380360000000005)
    return M.table(spark, sf_dir, "events").select("event_id", H.filetime_to_timestamp(ticks).alias("sent"))


def rfc2822_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = M.raw_headers(spark, sf_dir)
    received = F.concat(F.lit("from a (b; c) by d with e; "), c("date_header"))
    return raw.select(
        "conv_id",
        "turn",
        H.rfc2822_to_timestamp(c("date_header")).alias("submit_time"),
        H.received_to_timestamp(received).alias("delivery_time"),
        H.rfc2822_to_timestamp(F.concat(F.lit("soon, "), c("date_header"))).alias("broken"),
    )


def header_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = M.raw_headers(spark, sf_dir)
    block = F.concat(
        F.lit("From: first@x.example\r\nX-Case: "), c("conv_id").cast("string"), F.lit("\r\nSubject: "), c("subject"),
        F.lit("\r\nReferences: "), F.coalesce(c("references_header"), F.lit("")), F.lit("\r\nFROM: "), c("from_header"),
        F.lit("\r\n\r\nX-Case: body"),
    )
    found = raw.select("conv_id", "turn", H.header_map(block).alias("h"))
    return found.select(
        "conv_id",
        "turn",
        c("h")["x-case"].alias("x_case"),
        F.trim(c("h")["subject"]).alias("subject"),
        H.joined(H.parse_addresses(c("h")["from"])).alias("from_address"),
        H.joined(H.parse_identifiers(c("h")["references"])).alias("refs"),
        F.size("h").alias("names"),
    )


def from_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.raw_headers(spark, sf_dir).select("conv_id", "turn", H.from_name(c("from_header")).alias("from_name"))


def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.table(spark, sf_dir, "pages").select("page_id", X.html_to_text(c("html")).alias("body"))


def html_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page after a numbered list with a list inside, quotes within quotes, and references of all kinds."""
    number = c("page_id").cast("string")
    head = F.concat(
        F.lit('<p></p><ol start="3"><li>Item '), number, F.lit("<UL><li>"), c("url"), F.lit("</li><li>inner "), (c("page_id") % 7).cast("string"),
        F.lit("</li></UL></li><li>two &lt; 3 &amp; four</ol><blockquote><p>first &ldquo;quote&#x201D; of "), number,
        F.lit("</p><blockquote>deeper &eacute;</blockquote>after &#8217; &#119070; &unknown;</blockquote>"),
    )
    return M.table(spark, sf_dir, "pages").select("page_id", X.html_to_text(F.concat(head, "html")).alias("body"))


def fill_plain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as HTML bodies; those of secure addresses came with a plain body, which is kept."""
    pages = M.table(spark, sf_dir, "pages")
    rows = pages.select(
        "page_id",
        F.when(c("url").startswith("https"), c("url")).alias("plain_text_body"),
        F.when(~c("url").contains("example.org"), c("html")).alias("html_body"),
    )
    filled = X.fill_plain_text_body(rows)
    return filled.select("page_id", "plain_text_body", "plain_text_is_converted")


def sender_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.with_domains(spark, sf_dir).select("message_id", "sender_domain")


def all_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.with_domains(spark, sf_dir).select("message_id", H.joined(c("all_domains")).alias("all_domains"))


def is_internal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.with_domains(spark, sf_dir).select("message_id", "is_internal")


def ts_ntz(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+03:00"))
    return M.table(spark, sf_dir, "events").select("event_id", to_utc_ntz(written.cast("timestamp_ltz")).alias("ts_utc"))


# --- threads ------------------------------------------------------------------------------------


def threading(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("message_id", "first_in_thread", "num_previous_messages", "thread_id")
    return threads.with_threading(M.mails(spark, sf_dir)).select(*columns)


def missing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threads.missing_message_ids(M.mails(spark, sf_dir))


def response_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threads.with_response_time(M.mails(spark, sf_dir)).select("message_id", "response_time")


def response_time_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event answers the one a fixed distance earlier; every event of type error answers event 0."""
    events = M.table(spark, sf_dir, "events").select(
        c("event_id").cast("string").alias("message_id"),
        F.when(c("event_type") == "error", "0").otherwise((c("event_id") - 150).cast("string")).alias("previous_message_id"),
        c("ts").alias("submit_time"),
    )
    return threads.with_response_time(events).select("message_id", "response_time")


# --- text ---------------------------------------------------------------------------------------


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.cleaned(spark, sf_dir).select("message_id", "clean_text")


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = X.clean_text(c("text"), X.banners(M.ORGANISATION))
    return M.table(spark, sf_dir, "documents").select("doc_id", cleaned.alias("clean_text"))


def drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line of each document as a text; blank lines and rules go."""
    lines = M.table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\\n")).alias("line", "text"))
    cleaned = lines.select("doc_id", "line", X.clean_text(c("text")).alias("clean_text"))
    return R.drop_empty_text(cleaned)


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = M.table(spark, sf_dir, "documents")
    return language.languages(docs, "doc_id", "text", language.fit_languages(docs, "text", "lang"))


def ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total number of each bigram over all mail bodies."""
    words = M.table(spark, sf_dir, "conversations").select(X.tokens(c("text")).alias("t"))
    grams = words.select(F.explode(X.ngrams(c("t"), 2)).alias("gram"))
    return grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


# --- relations ----------------------------------------------------------------------------------


def external_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.external_only(M.with_domains(spark, sf_dir), M.OWN_ADDRESS).select("message_id", "sender_domain")


def dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive and a later delivery of the same mails, some without id: one row per id is left."""
    mails = M.mails(spark, sf_dir).select("message_id", "turn", "submit_time")
    later = mails.select(
        F.when(c("turn") != 2, c("message_id")).alias("message_id"),
        "turn",
        (c("submit_time") + F.make_dt_interval(F.lit(0), F.lit(1))).alias("submit_time"),
    )
    kept = R.dedupe(R.drop_null_keys(select.union_sources(later, mails)))
    return R.with_defaults(kept)


def _spam_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flag per mail, computed from the case number."""
    return M.mails(spark, sf_dir).select("message_id", (c("conv_id") % 5 == 2).alias("is_spam"))


def drop_spam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.drop_spam(M.mails(spark, sf_dir), _spam_by_rule(spark, sf_dir)).select("message_id", "subject", "is_spam")


def attach_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = R.attach_topic(M.mails(spark, sf_dir), M.assigned(spark, sf_dir))
    return joined.select("message_id", "subject", "topic_id")


def _described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One description per topic in use."""
    used = M.assigned(spark, sf_dir).select("topic_id").distinct()
    return used.select("topic_id", F.concat(F.lit("topic "), c("topic_id").cast("string")).alias("topic_description"))


def topic_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.topic_dimension(M.assigned(spark, sf_dir), _described(spark, sf_dir))


def topic_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = R.topic_messages(M.assigned(spark, sf_dir), _described(spark, sf_dir))
    return found.select("message_id", "topic_id", "topic_description")


def addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.addresses(M.mails(spark, sf_dir))


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.references(M.mails(spark, sf_dir))


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.domains(M.with_domains(spark, sf_dir))


def message_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of the external mails, with the subject of their mail."""
    mails = M.with_domains(spark, sf_dir)
    parents = R.external_only(mails, M.OWN_ADDRESS).select("message_id", "subject")
    return R.children(parents, R.addresses(mails))


def top_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.top_topics(M.assigned(spark, sf_dir), _described(spark, sf_dir))


# --- entities -----------------------------------------------------------------------------------



def entities_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, each with numbers and codes that stand alone, and others that touch a letter beyond ASCII."""
    text = F.format_string("%s É%08d %08d %08dß ñQ7%06d Q7%06d", "text", *["doc_id"] * 5)
    docs = M.table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    found = docs.select("doc_id", F.explode(E.entities_from_text(c("text"))).alias("e"))
    return found.select("doc_id", "e.entity_type", "e.entity_value")


def entities_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    mails = M.mails(spark, sf_dir).select("message_id", c("plain_text_body").alias("text"))
    return scoring.entities(mails, "message_id", "text")


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON answers of every shape, made of the values of each event."""
    kind, value = c("event_id") % 6, F.format_string("%.2f", c("value"))
    user = c("user_id").cast("string")
    answer = (
        F.when(kind == 0, F.concat(F.lit('{"Full Name": "user '), user, F.lit('", "Transaction Amount": ['), value, F.lit(', "'), value, F.lit('"]}')))
        .when(kind == 1, F.concat(F.lit('{"Age": '), user, F.lit(', "Note": {"a": "b"}, "IBAN": "X'), user, F.lit('", "None": null}')))
        .when(kind == 2, F.concat(F.lit('["user", '), user, F.lit("]")))
        .when(kind == 3, F.concat(F.lit("Sorry: "), user))
        .when(kind == 4, F.lit("{}"))
        .otherwise(F.concat(F.lit('{"Mobile Number": ["'), user, F.lit('", "'), c("event_type"), F.lit('"]}')))
    )
    return M.table(spark, sf_dir, "events").select("event_id", answer.alias("response"))


def entities_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.explode_entities(_answers(spark, sf_dir), "event_id", E.entities_from_json(c("response")))


# --- scoring ------------------------------------------------------------------------------------


def build_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = scoring.build_prompt(c("text"), scoring.SPAM_PROMPT)
    return M.table(spark, sf_dir, "documents").select("doc_id", prompt.alias("prompt"))


def echo_model() -> scoring.BatchModel:
    return lambda prompts: [f"{len(p)}: {p}" for p in prompts]


def async_echo_model() -> scoring.AsyncModel:
    async def answer(prompt: str) -> str:
        await asyncio.sleep(0)
        return f"{len(prompt)}: {prompt}"

    return answer


def invoke_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = M.table(spark, sf_dir, "documents").select("doc_id", "source", c("text").alias("prompt"))
    return scoring.invoke_model(prompts, "prompt", echo_model).select("doc_id", "source", "response")


def invoke_concurrently(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = M.table(spark, sf_dir, "documents").select("doc_id", "source", c("text").alias("prompt"))
    return scoring.invoke_model_concurrently(prompts, "prompt", async_echo_model).select("doc_id", "source", "response")


def spam_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = M.table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = M.table(spark, sf_dir, "labels").select("doc_id", (c("toxic") == 1).alias("is_spam"))
    model = scoring.fit_spam(docs.join(labels, "doc_id"), "text", "is_spam")
    return scoring.spam_flags(docs, "doc_id", "text", model)


def spam_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = M.table(spark, sf_dir, "events")
    answer = F.concat(F.element_at(F.array(*map(F.lit, ["spam", "It is ham", "spam or ham", "no spam"])), (c("event_id") % 4 + 1).cast("int")), F.lit(" "), c("event_type"))
    return events.select("event_id", scoring.spam_from_response(answer).alias("is_spam"))


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.categories(M.cleaned(spark, sf_dir), "message_id", "clean_text")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.products(M.cleaned(spark, sf_dir), "message_id", "clean_text")


def _labelled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All documents, and as examples the labelled ones, with all labels that apply."""
    docs = M.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rows = M.table(spark, sf_dir, "labels")
    marks = F.array_compact(F.array(F.concat(F.lit("lang_"), "lang"), F.when(c("toxic") == 1, "toxic"), F.when(c("quality") == 0, "junk")))
    return docs.select("doc_id", "text"), docs.join(rows, "doc_id").select("text", marks.alias("marks"))


LEARNED = ["lang_de", "lang_en", "lang_es", "lang_fr", "toxic", "junk", "never_seen"]


def categories_learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, examples = _labelled(spark, sf_dir)
    return labelling.categories(docs, "doc_id", "text", labelling.fit(examples, "text", "marks", LEARNED))


def products_learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, examples = _labelled(spark, sf_dir)
    return labelling.products(docs, "doc_id", "text", labelling.fit(examples, "text", "marks", LEARNED))


def summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.summaries(M.table(spark, sf_dir, "documents"), "doc_id", "text")


# --- vectors and topics -------------------------------------------------------------------------


def embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.hashed_embeddings(M.table(spark, sf_dir, "documents"), "doc_id", "text")


def populate_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = M.table(spark, sf_dir, "documents").select("doc_id")
    store = M.table(spark, sf_dir, "embeddings").select(c("vec_id").alias("doc_id"))
    return embeddings.not_embedded(docs, store, "doc_id")


def svd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.truncated_svd(M.table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def svd_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inner products of neighbouring vectors after a projection of full width, which keeps them."""
    reduced = embeddings.truncated_svd(M.table(spark, sf_dir, "embeddings"), "vec_id", "embedding", k=4096)
    after = reduced.select((c("vec_id") - 1).alias("vec_id"), c("reduced").alias("after"))
    product = F.aggregate(F.zip_with("reduced", "after", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return reduced.join(after, "vec_id").select("vec_id", (F.round(product, 4) + 0.0).alias("product"))


def svd_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for vectors beyond the Gram matrix: each is repeated 128 times, which keeps the rank."""
    wide = M.table(spark, sf_dir, "embeddings").select("vec_id", F.flatten(F.array_repeat("embedding", 128)).alias("wide"))
    reduced = embeddings.truncated_svd(wide, "vec_id", "wide", k=64)
    after = reduced.select((c("vec_id") - 1).alias("vec_id"), c("reduced").alias("after"))
    product = F.aggregate(F.zip_with("reduced", "after", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return reduced.join(after, "vec_id").select("vec_id", (F.round(product / 128, 4) + 0.0).alias("product"))


def embed_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without document frequencies, an embedding has length 1, or 0 if the text has no token."""
    rows = embeddings.hashed_embeddings(M.table(spark, sf_dir, "documents"), "doc_id", "text", idf=False)
    squares = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    return rows.select("doc_id", F.round(F.sqrt(squares), 3).alias("length"))


def l2_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.table(spark, sf_dir, "embeddings").select("vec_id", l2_normalise(c("embedding")).alias("v"))
    entries = rows.select("vec_id", F.posexplode("v").alias("pos", "x"))
    return entries.select("vec_id", "pos", F.round("x", 5).alias("x"))


def _separated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, v): 0.3 times the unit embedding, followed by the label's indicator, so that labels are clusters."""
    rows = M.table(spark, sf_dir, "embeddings")
    unit = F.transform(l2_normalise(c("embedding")), lambda x: F.lit(0.3) * x)
    marks = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.when(i == c("label"), 1.0).otherwise(0.0))
    return rows.select("vec_id", F.concat(unit, marks).alias("v"))


def _named_by_least(assigned: DataFrame) -> DataFrame:
    """Per vector the size and the smallest vec_id of its cluster, null for noise; numbers of equal sizes are arbitrary."""
    groups = assigned.where(c("topic_id") != clustering.NOISE).groupBy("topic_id")
    groups = groups.agg(F.count(F.lit(1)).alias("cluster_size"), F.min("vec_id").alias("cluster_id"))
    return assigned.join(groups, "topic_id", "left").select("vec_id", "cluster_id", "cluster_size")


def density_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Density clusters at one radius, over many cells and blocks."""
    vectors = _separated(spark, sf_dir)
    return _named_by_least(clustering.density_cut(vectors, "vec_id", "v", DENSITY_RADIUS, block_rows=50))


def topic_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors → truncated SVD of full width, which keeps all distances → hierarchical density clusters."""
    reduced = embeddings.truncated_svd(_separated(spark, sf_dir), "vec_id", "v", k=128)
    return _named_by_least(clustering.topics(reduced, "vec_id", "reduced"))


def describable_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.describable(M.assigned(spark, sf_dir).select("message_id", "topic_id"))


def topic_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = M.assigned(spark, sf_dir).select("message_id", "topic_id", "clean_text")
    return topics.topic_samples(rows, seed=None)


def topic_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.topic_descriptions(M.assigned(spark, sf_dir))


def _language_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = F.when(c("lang") == "de", -1).when(c("lang") == "en", 0).when(c("lang") == "es", 1).otherwise(2)
    return M.table(spark, sf_dir, "documents").select(topic.alias("topic_id"), c("text").alias("clean_text"))


def word_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.word_frequencies(_language_topics(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "entry": entry,
    "raw_mail": raw_mail_fields,
    "fetch_by_ids": fetch_by_ids,
    "ids_not_found": ids_not_found,
    "request_counts": request_counts,
    "fetch_since": fetch_since,
    "fetch_since_by_day": fetch_since_by_day,
    "fetch_missing": fetch_missing,
    "union_sources": union_sources,
    "sample_first_n": sample_first_n,
    "load_project": load_project,
    "ensure_parents": ensure_parents,
    "load_rejects": load_rejects,
    "load_accepted": load_accepted,
    "load_conflicts": load_conflicts,
    "null_normalise": null_normalise,
    "source_counts": source_counts,
    "parse_addresses": parse_addresses,
    "parse_identifiers": parse_identifiers,
    "charset": charset,
    "subject_prefix": subject_prefix,
    "parse_body": parse_body,
    "detect_charset": detect_charset,
    "filetime": filetime,
    "rfc2822_time": rfc2822_time,
    "header_map": header_map,
    "from_name": from_name,
    "html_to_text": html_to_text,
    "html_structure": html_structure,
    "fill_plain_text": fill_plain_text,
    "sender_domain": sender_domain,
    "all_domains": all_domains,
    "is_internal": is_internal,
    "ts_ntz": ts_ntz,
    "threading": threading,
    "missing_ids": missing_ids,
    "response_time": response_time,
    "response_time_events": response_time_events,
    "clean_text": clean_text,
    "clean_documents": clean_documents,
    "drop_empty": drop_empty,
    "language": languages,
    "ngrams": ngrams,
    "external_only": external_only,
    "dedupe": dedupe,
    "drop_spam": drop_spam,
    "attach_topic": attach_topic,
    "topic_dim": topic_dim,
    "topic_messages": topic_messages,
    "addresses": addresses,
    "references": references,
    "domains": domains,
    "message_children": message_children,
    "top_topics": top_topics,
    "entities_regex": entities_regex,
    "entities_exploded": entities_exploded,
    "entities_json": entities_json,
    "categories_learned": categories_learned,
    "products_learned": products_learned,
    "build_prompt": build_prompt,
    "invoke_model": invoke_model,
    "invoke_concurrently": invoke_concurrently,
    "spam_flag": spam_flag,
    "spam_response": spam_response,
    "categories": categories,
    "products": products,
    "summaries": summaries,
    "embed": embed,
    "populate_missing": populate_missing,
    "svd": svd,
    "svd_full": svd_full,
    "svd_wide": svd_wide,
    "embed_lengths": embed_lengths,
    "l2_normalise": l2_normalised,
    "density_cut": density_cut,
    "topics": topic_clusters,
    "describable_topics": describable_topics,
    "topic_samples": topic_samples,
    "topic_descriptions": topic_descriptions,
    "word_frequencies": word_frequencies,
}
