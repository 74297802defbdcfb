"""Chat formatting from an event log: fold deltas, edits and regenerations, then render, mask and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CLOSE = "</turn>\n"

#: Event kinds. ``open`` starts a message and names its role, ``delta`` appends text, ``edit`` and
#: ``regenerate`` replace all that the message held before.
KINDS = ("open", "delta", "edit", "regenerate")


def escape(text: Column) -> Column:
    """A backslash before every backslash, and inside every control string after its ``<``."""
    return F.regexp_replace(text, r"(\\|(?<=<)/?turn)", r"\\$1")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(escape(role), ">", r"\\>")


def unescape(text: Column) -> Column:
    """The inverse of both: drop each backslash that escapes, keep what follows."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text): final messages from (conv_id, seq, message, kind, role, text).

    Per message, the text is the concatenation, by ``seq``, of what came at or after the last edit
    or regeneration. The role is that of the last event that names one. Null text is empty, a null
    kind is a delta, a null conv_id is a conversation of its own. Folding is by message, so the
    events of one conversation are dealt over tasks; events with equal seq go by kind and text.
    """
    message = Window.partitionBy("conv_id", "message")
    replaced = F.max(F.when(F.col("kind").isin("edit", "regenerate"), F.col("seq"))).over(message)
    live = F.col("_from").isNull() | (F.col("seq") >= F.col("_from"))
    body = F.when(live, F.coalesce("text", F.lit(""))).otherwise(F.lit(""))
    parts = events.withColumn("_from", replaced).withColumn("_part", F.struct("seq", F.coalesce("kind", F.lit("delta")).alias("kind"), body.alias("text"), "role"))
    in_order = F.array_sort(F.collect_list("_part"))
    grouped = parts.groupBy("conv_id", "message").agg(in_order.alias("_parts"))
    roles = F.filter(F.transform("_parts", lambda p: p["role"]), lambda r: r.isNotNull())
    return grouped.select(
        "conv_id",
        "message",
        F.try_element_at(roles, F.lit(-1)).alias("role"),
        F.array_join(F.transform("_parts", lambda p: p["text"]), "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans): one text per conversation, messages in order.

    A turn is ``<turn ROLE>TEXT</turn>`` and a line end, with role and text escaped. ``loss_spans``
    has (begin, length) in code points of each assistant text, as it stands in ``formatted``. A null
    role is empty. A conversation is the unit of output, so its messages meet in one task here.
    """
    head = F.concat(F.lit("<turn "), escape_role(F.coalesce("role", F.lit(""))), F.lit(">"))
    body = escape(F.coalesce("text", F.lit("")))
    pieces = messages.withColumn("_head", head).withColumn("_body", body)
    pieces = pieces.withColumn("_piece", F.concat("_head", "_body", F.lit(CLOSE)))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.length("_piece").cast("long")).over(before), F.lit(0)) + F.length("_head")
    span = F.when(F.col("role") == "assistant", F.struct(begin.alias("begin"), F.length("_body").cast("long").alias("length")))
    placed = pieces.withColumn("_item", F.struct("message", "_piece", span.alias("span")))
    items = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list("_item")).alias("_items"))
    return items.select(
        "conv_id",
        F.array_join(F.transform("_items", lambda x: x["_piece"]), "").alias("formatted"),
        F.filter(F.transform("_items", lambda x: x["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def read_back(formatted: Column) -> Column:
    """The turns in a formatted text: an array of (role, text)."""
    turns = F.filter(F.split(formatted, CLOSE, -1), lambda t: t != "")
    header = r"(?s)^<turn ((?:[^\\>]|\\.)*+)>"
    return F.transform(
        turns,
        lambda t: F.struct(
            unescape(F.regexp_extract(t, header, 1)).alias("role"),
            unescape(F.regexp_replace(t, header, "")).alias("text"),
        ),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    pieces = F.transform(spans, lambda s: unescape(F.substr(formatted, (s["begin"] + 1).cast("int"), s["length"].cast("int"))))
    return F.array_join(pieces, "")


def events_of(conversations: DataFrame) -> DataFrame:
    """An event log from finished rows: a draft, its regeneration, then the text in two deltas.

    Rows with equal conv_id and turn stay turns of their own, ordered by role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    text = F.coalesce("text", F.lit(""))
    half = F.floor(F.length(text) / 2).cast("int")
    first, second = F.left(text, half), F.substr(text, half + 1, F.length(text))
    event = lambda step, kind, role, body: F.struct(
        (4 * F.col("message") + step).alias("seq"), F.lit(kind).alias("kind"), role.alias("role"), body.alias("text")
    )
    no_role = F.lit(None).cast("string")
    log = F.array(
        event(0, "open", F.coalesce("role", F.lit("")), F.lit("")),
        event(1, "delta", no_role, F.reverse(first)),
        event(2, "regenerate", no_role, first),
        event(3, "delta", no_role, second),
    )
    rows = conversations.select("conv_id", F.row_number().over(order).cast("long").alias("message"), "role", "text")
    return rows.select("conv_id", "message", F.explode(log).alias("e")).select("conv_id", "message", "e.*")


def format_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) for rows (conv_id, turn, role, text)."""
    return render(fold(events_of(conversations.select("conv_id", "turn", "role", "text"))))
