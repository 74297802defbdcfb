"""Secret scans through a trigram inverted index: postings propose documents, regular expressions confirm spans."""

from __future__ import annotations

import re._constants as code
import re._parser as parser
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import folded, once, saved, text_or_empty


def either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token"))
_API_KEY = either_case("api") + "_?" + either_case("key")


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has at least ``least`` characters.

    Matches are leftmost and do not overlap; one that is too short is dropped, but not scanned again.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The first three are the base kinds; their order breaks ties between spans with equal starts.
RULES = (
    Rule("assign", rf"({_NAMES}|{_API_KEY})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]+", 0, 30),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
BASE = 3

#: A trigram query: every clause must hold; a clause holds if one of its sets of trigrams is present.
Query = list[list[frozenset[str]]]

_MOST_STRINGS = 64


def trigram_query(pattern: str) -> Query:
    """The trigrams that any match must have, in lower case; an empty list asks for a full scan.

    Runs of the expression with few possible strings give a clause each: one alternative per string,
    holding that string's trigrams. A string shorter than three characters makes its clause void.
    """
    clauses: Query = []

    def close(strings: set[str]) -> None:
        sets = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in sorted(strings)]
        if all(sets):
            clauses.append(list(dict.fromkeys(sets)))

    def strings_of(items) -> set[str] | None:
        """All strings that the items can match, or None if there are too many."""
        out = {""}
        for op, value in items:
            if op is code.LITERAL:
                own = {chr(value).lower()}
            elif op is code.IN and all(o is code.LITERAL for o, _ in value):
                own = {chr(v).lower() for _, v in value}
            elif op is code.SUBPATTERN:
                own = strings_of(value[3])
            elif op is code.BRANCH:
                parts = [strings_of(b) for b in value[1]]
                own = None if None in parts else set().union(*parts)
            elif op is code.MAX_REPEAT and value[1] <= 8:
                one = strings_of(value[2])
                own = None if one is None else {""} if value[0] == 0 else set()
                step = {""}
                for n in range(1, value[1] + 1):
                    if own is None or len(step) * len(one) > _MOST_STRINGS:
                        own = None
                        break
                    step = {a + b for a in step for b in one}
                    own = own | step if n >= value[0] else own
            else:
                own = None
            if own is None or len(out) * len(own) > _MOST_STRINGS:
                return None
            out = {a + b for a in out for b in own}
        return out

    run: set[str] = {""}
    for item in parser.parse(pattern):
        own = strings_of([item])
        if own is not None and len(run) * len(own) <= _MOST_STRINGS:
            run = {a + b for a in run for b in own}
        else:
            close(run)
            run = own if own is not None else {""}
    close(run)
    return clauses


# --- index --------------------------------------------------------------------------------------


def document_key() -> Column:
    """Names a document in the index. Documents that share a key only become candidates together."""
    return F.xxhash64("doc_id", "text")


def postings(docs: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """(trigram number, key) for every indexed trigram that a whole text has, in either case."""
    wanted = F.array(*[F.struct(F.lit(i).alias("n"), F.lit(t).alias("t")) for i, t in enumerate(trigrams)])
    low = docs.select(document_key().alias("_key"), F.lower(text_or_empty()).alias("_low"))
    present = F.filter(wanted, lambda x: F.contains(F.col("_low"), x["t"]))
    return low.select(F.explode(F.transform(present, lambda x: x["n"])).alias("trigram"), "_key")


def candidates(index: DataFrame, trigrams: Sequence[str], queries: dict[str, Query]) -> DataFrame:
    """(key, one flag per rule): documents whose postings satisfy a rule's query.

    Postings are intersected per document as bits, which are combined before they are shuffled.
    """
    number = {t: i for i, t in enumerate(trigrams)}
    words = 1 + len(trigrams) // 63
    bits = [F.bit_or(F.when(F.floor(F.col("trigram") / 63) == w, F.expr(f"shiftleft(1L, int(trigram % 63))")).otherwise(F.lit(0).cast("long"))).alias(f"_bits{w}") for w in range(words)]

    def has(trigram_set: frozenset[str]) -> Column:
        masks = [sum(1 << (number[t] % 63) for t in trigram_set if number[t] // 63 == w) for w in range(words)]
        hits = [F.col(f"_bits{w}").bitwiseAND(F.lit(m)) == F.lit(m) for w, m in enumerate(masks) if m]
        return _all(hits)

    flags = [_all([_any([has(s) for s in clause]) for clause in query]).alias(f"_may_{kind}") for kind, query in queries.items()]
    found = index.groupBy("_key").agg(*bits).select("_key", *flags)
    return found.where(_any([F.col(f"_may_{kind}") for kind in queries]))


def _all(columns: list[Column]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & c
    return out


def _any(columns: list[Column]) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | c
    return out


# --- verification -------------------------------------------------------------------------------

_ONE = "struct<begin:long,rank:int,kind:string,end:long,first_byte:long,last_byte:long>"
_SPAN = f"array<{_ONE}>"


def spans_of(text: Column, rule: Rule, rank: int) -> Column:
    """All spans of one rule, in code points and in bytes: the gaps between matches and the matches, added up."""
    hits = F.zip_with(
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)),
        F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)),
        lambda h, j: F.struct(F.length(h).alias("hit"), F.octet_length(h).alias("bytes"), (F.length(j) >= rule.least).alias("good")),
    )
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda g: F.struct(F.length(g).alias("gap"), F.octet_length(g).alias("bytes")))

    def add(at: Column, x: Column) -> tuple[Column, Column]:
        begin, first = at["at"] + x["g"]["gap"], at["byte"] + x["g"]["bytes"]
        end, last = begin + F.coalesce(x["h"]["hit"], F.lit(0)), first + F.coalesce(x["h"]["bytes"], F.lit(0))
        names = (begin.alias("begin"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        span = F.struct(*names, first.alias("first_byte"), last.alias("last_byte"))
        good = F.coalesce(x["h"]["good"], F.lit(False))
        return F.struct(end.alias("at"), last.alias("byte")), F.when(good, F.array(span).cast(_SPAN)).otherwise(F.array().cast(_SPAN))

    zero = F.lit(0).cast("long")
    both = F.zip_with(gaps, hits, lambda g, h: F.struct(g.alias("g"), h.alias("h")))
    return folded(both, F.struct(zero.alias("at"), zero.alias("byte")), add, _ONE)["out"]


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with ``secret_spans``: (begin, rank, kind, end) in code points, by begin, then by rule; and their bytes.

    Rules with mandatory trigrams are verified in the documents that the index proposes; the others
    scan every text. The index holds the trigrams that the rules ask for, over all whole texts.

    Null text counts as empty; a null doc_id is an id like any other; repeated rows are scanned each
    and get equal spans; an empty table gives no rows; a column named ``secret_spans`` is replaced, and columns with the names of helpers
    (``_key``, ``_may_`` and a kind) are left out.
    """
    docs = docs.drop("secret_spans", "_key", *[f"_may_{r.kind}" for r in rules])
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    trigrams = sorted({t for q in queries.values() for clause in q for s in clause for t in s})
    keyed, empty = docs.withColumn("_key", document_key()), F.array().cast(_SPAN)
    if queries:
        proposed = saved(candidates(postings(docs, trigrams), trigrams, queries))
        keyed = keyed.join(proposed, "_key", "left")
    text = text_or_empty()
    found = []
    for rank, rule in enumerate(rules):
        worth = F.col(f"_may_{rule.kind}") if rule.kind in queries else F.lit(True)
        found.append(F.when(F.coalesce(worth, F.lit(False)) & text.rlike(rule.pattern), spans_of(text, rule, rank)).otherwise(empty))
    return keyed.withColumn("secret_spans", F.array_sort(F.concat(*found))).select(*docs.columns, "secret_spans")


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by the mark.

    Pieces between runs are cut by bytes, which need no count of characters, and joined at the end.
    """
    data = text.cast("binary")

    def add(at: Column, x: Column) -> tuple[Column, Column]:
        fresh = x["first_byte"] >= at
        piece = F.struct(at.alias("begin"), x["first_byte"].alias("end"))
        kind = "array<struct<begin:long,end:long>>"
        return F.greatest(at, x["last_byte"]), F.when(fresh, F.array(piece).cast(kind)).otherwise(F.array().cast(kind))

    def cut(both: Column) -> Column:
        raw, found = both["raw"], both["found"]
        between = F.transform(found["out"], lambda p: F.substring(raw, (p["begin"] + 1).cast("int"), (p["end"] - p["begin"]).cast("int")).cast("string"))
        rest = F.substring(raw, (found["last"] + 1).cast("int"), F.length(raw)).cast("string")
        return F.array_join(F.concat(between, F.array(rest)), mark)

    found = folded(spans, F.lit(0).cast("long"), add, "struct<begin:long,end:long>")
    whole = once(F.struct(data.alias("raw"), found.alias("found")), cut)
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def joined(spans: Column) -> Column:
    """``kind:begin:end`` of every span, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
