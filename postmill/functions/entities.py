"""Entity extraction by pattern, and from a model's JSON answer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DATE = r"\b\d{4}-\d{2}-\d{2}\b"

# Entity types with their patterns, in output order. A date is reported under both
# date types.
ENTITY_PATTERNS = {
    "QID": r"\b\d{11}\b",
    "Mobile Number": r"\+?\d{1,4}[\s-]?\d{1,4}[\s-]?\d{6,10}",
    "Account Number": r"\b\d{8,12}\b",
    "Passport Number": r"\b[A-Z0-9]{5,9}\b",
    "Email Address": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "IBAN": r"\b[A-Z]{2}\d{2}[A-Z0-9]{1,30}\b",
    "Transaction Amount": r"\b[\$|QAR|USD|EUR]?\s?\d{1,3}(?:,\d{3})*(?:\.\d{2})?\b",
    "Transaction Date": _DATE,
    "Date of Birth": _DATE,
}

ENTITY_TYPE = "array<struct<entity_type:string,entity_value:string>>"


def entities_from_text(text: Column, patterns: dict[str, str] | None = None) -> Column:
    """All matches of every pattern, ordered by pattern and then position."""

    def matches(entity_type: str, pattern: str) -> Column:
        found = F.regexp_extract_all(text, F.lit("(?U)" + pattern), F.lit(0))
        return F.transform(
            found, lambda v: F.struct(F.lit(entity_type).alias("entity_type"), v.alias("entity_value"))
        )

    return F.concat(*[matches(t, p) for t, p in (patterns or ENTITY_PATTERNS).items()]).cast(ENTITY_TYPE)


def entities_from_json(response: Column) -> Column:
    """Entities of a JSON object: a string gives one pair, a list one pair per element.

    A repeated name keeps its first place and its last value. Other value types, text that is no JSON
    and top-level arrays give no entity.
    """
    every = F.map_entries(F.from_json(response, "map<string,variant>"))
    names = F.array_distinct(F.transform(every, lambda e: e["key"]))
    entries = F.transform(names, lambda n: F.element_at(F.filter(every, lambda e: e["key"] == n), -1))

    def pairs(entry: Column) -> Column:
        kind = F.schema_of_variant(entry["value"])
        pair = lambda v: F.struct(
            entry["key"].alias("entity_type"), F.try_variant_get(v, "$", "string").alias("entity_value")
        )
        return (
            F.when(kind == "STRING", F.array(pair(entry["value"])))
            .when(
                kind.startswith("ARRAY"),
                F.transform(F.try_variant_get(entry["value"], "$", "array<variant>"), pair),
            )
            .otherwise(F.array().cast(ENTITY_TYPE))
        )

    found = F.flatten(F.transform(entries, pairs))
    return F.coalesce(found, F.array().cast(ENTITY_TYPE)).cast(ENTITY_TYPE)
