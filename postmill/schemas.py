"""Schemas of the parsed mail and of the ten target tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "strings": ArrayType(StringType()),
    "boolean": BooleanType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "time": TimestampNTZType(),
}


def _schema(columns: str) -> StructType:
    pairs = (c.split() for c in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


# The fourteen parsed fields of one mail.
MAIL = _schema(
    """
    message_id string, subject string, subject_prefix string,
    submit_time time, delivery_time time,
    html_body string, plain_text_body string, from_name string,
    from_address strings, to_address strings,
    cc_address strings, bcc_address strings,
    previous_message_id string, references strings
    """
)

TABLES: dict[str, StructType] = {
    name: _schema(columns)
    for name, columns in {
        "messages": """
            message_id string, topic_id int, is_spam boolean, subject string, subject_prefix string,
            submit_time time, delivery_time time, html_body string,
            plain_text_body string, from_name string, previous_message_id string,
            first_in_thread boolean, num_previous_messages int, thread_id string,
            sender_domain string, is_internal boolean, clean_text string, response_time double,
            language string
        """,
        "addresses": "message_id string, address_type string, address string",
        "references": "message_id string, reference_message_id string",
        "domains": "message_id string, domain string",
        "word_frequencies": "topic_id int, word string, frequency bigint",
        "topics": "topic_id int, topic_description string",
        "classifications": "message_id string, category string",
        "products": "message_id string, product string",
        "entities": "message_id string, entity_type string, entity_value string",
        "summaries": "message_id string, summary string",
    }.items()
}

# Parent of each child table: (parent table, key).
PARENTS: dict[str, tuple[str, str]] = {
    "messages": ("topics", "topic_id"),
    "word_frequencies": ("topics", "topic_id"),
    **{
        child: ("messages", "message_id")
        for child in ("addresses", "references", "domains", "classifications", "products", "entities", "summaries")
    },
}

# Tables with one row per key.
UNIQUE = {parent for parent, _ in PARENTS.values()}

# Natural key of each table: the columns a row must have, and the base of its surrogate id.
KEYS: dict[str, list[str]] = {
    "messages": ["message_id"],
    "addresses": ["message_id", "address_type", "address"],
    "references": ["message_id", "reference_message_id"],
    "domains": ["message_id", "domain"],
    "word_frequencies": ["topic_id", "word"],
    "topics": ["topic_id"],
    "classifications": ["message_id", "category"],
    "products": ["message_id", "product"],
    "entities": ["message_id", "entity_type", "entity_value"],
    "summaries": ["message_id"],
}

# Columns without the 255-character limit, and the allowed address types.
LONG_TEXT = {"html_body", "plain_text_body", "clean_text", "summary", "subject", "topic_description"}
MAX_LENGTH = 255
ADDRESS_TYPES = ["from", "to", "cc", "bcc"]
