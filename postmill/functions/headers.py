"""Header parsing as native column expressions.

Multi-valued headers become ``array<string>``; an empty result is null. The joined
text form (``", "``) is produced only at the sinks, by :func:`joined`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from postmill.functions.times import micros_to_ntz

# The formats of the headers.
SUBJECT_PREFIX = r"^\s*((?:re|fwd?|fw):)"
IDENTIFIER = r"<([^<>\s]+)>"
CHARSET = r"charset\s*=\s*([^\s;]+)"
FILETIME_EPOCH_MICROS = 11_644_473_600_000_000  # 1601-01-01 to 1970-01-01
EMPTY = "cast(array() as array<string>)"
DATE = (
    r"^\s*(?:[A-Za-z]+,?\s+)?(\d{1,2})[\s-]+([A-Za-z]{3})[A-Za-z]*[\s-]+(\d{2,4})\s+"
    r"(\d{1,2}):(\d{2})(?::(\d{2}))?\s*([+-]\d{4}|[A-Za-z]{1,4})?(?s:.*)$"
)
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
ZONE_OFFSETS = {
    "UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000",
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}

def joined(values: Column) -> Column:
    """``array<string>`` → the ``", "``-joined text form; null stays null."""
    return F.array_join(values, ", ")


def bound(value: Column, function: str) -> Column:
    """Apply a SQL function ``x -> …`` to a value, which is computed once however often x occurs."""
    return F.get(F.call_function("transform", F.array(value), F.expr(function)), F.lit(0))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def non_empty(values: Column) -> Column:
    """An empty array means "absent"."""
    return F.nullif(values, F.expr(EMPTY))


def unfold(header: Column) -> Column:
    """Join continuation lines of a folded header."""
    return F.regexp_replace(header, r"\r?\n[ \t]*", " ")


# Characters with a meaning in address lists, and the marks that stand for them inside quotes. Of the next four, two are its ends and two
# stand for an escaped quote and an escaped backslash.
_MEANT, _MARKS = ",;:<>()@ \t", "\x01\x02\x03\x04\x05\x06\x07\x08\x0e\x0f"
_BEGIN, _END, _QUOTE_MARK, _BACKSLASH_MARK = "\x10", "\x11", "\x12", "\x13"
_CHUNK = 64
_QUOTED = r'"[^"\\]*(?:\\.[^"\\]*)*"'
_ODD = r'(?s)\([^()]*\(|\(.*["\\]|["\\].*\(|"\s*[@.]|\.\s*"|\)\s*[@.]|[@.]\s*\('


def _without_comments(header: Column) -> Column:
    """The header without comments, and with marks for what quotes hold: a counter automaton over its tokens.

    The state is the depth of nested comments and whether a quote is open; quotes mean nothing in comments, nor
    brackets in quotes. Output is gathered per ``_CHUNK`` tokens, so that long lists do not grow token by token. Null
    where a quote or a comment stays open.
    """

    def step(state: Column, token: Column) -> Column:
        depth, quoted = state["depth"], state["quoted"]
        comment, opens, quote = depth > 0, token == "(", token == '"'
        bare = F.when(token.startswith("\\"), F.substr(token, F.lit(2))).otherwise(token)
        inside = F.when(token == '\\"', _QUOTE_MARK).when(token == "\\\\", _BACKSLASH_MARK).otherwise(F.translate(bare, _MEANT, _MARKS))
        out = F.when(comment | (~quoted & opens), "").when(quoted, F.when(quote, _END).otherwise(inside)).when(quote, _BEGIN).otherwise(token)
        return F.struct(
            F.when(quoted, depth).when(opens, depth + 1).when(comment & (token == ")"), depth - 1).otherwise(depth).alias("depth"),
            F.when(comment | ~quote, quoted).otherwise(~quoted).alias("quoted"),
            F.concat(state["out"], out).alias("out"),
        )

    def chunk(state: Column, part: Column) -> Column:
        start = F.struct(state["depth"].alias("depth"), state["quoted"].alias("quoted"), F.lit("").alias("out"))
        return let(
            F.aggregate(part, start, step),
            lambda done: F.struct(
                done["depth"].alias("depth"), done["quoted"].alias("quoted"), F.concat(state["parts"], F.array(done["out"])).alias("parts")
            ),
        )

    def over(tokens: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.size(tokens), F.lit(1)), F.lit(_CHUNK))
        start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("quoted"), F.expr(EMPTY).alias("parts"))
        closed = lambda s: F.when((s["depth"] == 0) & ~s["quoted"], F.array_join(s["parts"], ""))
        return F.aggregate(F.transform(places, lambda i: F.slice(tokens, i, F.lit(_CHUNK))), start, chunk, closed)

    plain = F.translate(header, _MARKS + _BEGIN + _END + _QUOTE_MARK + _BACKSLASH_MARK, "")
    return let(F.regexp_extract_all(plain, F.lit(r'(?s)\\.|[()"\\]|[^()"\\]+'), F.lit(0)), over)


def _specs(text: Column) -> Column:
    """The addr-spec of every piece of a list in which only separators separate."""

    def spec(piece: Column) -> Column:
        route = F.regexp_replace(F.regexp_extract(piece, "<([^<>]*)>", 1), r"\s+|^@[^:]*:", "")
        word = F.when(F.contains(piece, F.lit("@")), F.regexp_extract(piece, r"\S*@\S*", 0)).otherwise(F.regexp_extract(piece, r"\S+", 0))
        return F.when(F.contains(piece, F.lit("<")), route).otherwise(word)

    ungrouped = F.regexp_replace(text, r'(^|[,;])\s*[^,;:<>@"\x10\x11]*:', "$1")
    return F.filter(F.transform(F.split(F.translate(ungrouped, ";", ","), ",", -1), spec), lambda s: s != "")


def parse_addresses(header: Column) -> Column:
    """Address list → lower-case addr-specs in order; null without an ``@``.

    Comments go, quotes hide what they hold, and group labels go. A piece in angle brackets yields its content
    without route and blanks, another piece its first word that holds an ``@`` (or its first word). Plain comments and quoted
    names take two replacements; nested comments, quoted local parts, and quotes or escapes beside comments go through
    an automaton. Where a quote or a comment never ends, its mark is read as a letter.
    """

    def plain(h: Column) -> Column:
        return _specs(F.regexp_replace(F.regexp_replace(h, _QUOTED, " "), r"\([^()]*\)", " "))

    def marked(m: Column) -> Column:
        unnamed = F.regexp_replace(m, r"(?<!\.)\x10[^\x11]*\x11(?!\s*[@.])", " ")
        local = F.regexp_replace(unnamed, r"\s*@\s*", "@")
        quotes = lambda s: F.translate(s, _MARKS + _BEGIN + _END, _MEANT + '""')
        restored = lambda s: F.replace(F.replace(quotes(s), F.lit(_QUOTE_MARK), F.lit('\\"')), F.lit(_BACKSLASH_MARK), F.lit("\\\\"))
        return F.transform(_specs(local), restored)

    def parsed(h: Column) -> Column:
        odd = let(_without_comments(h), lambda m: F.coalesce(F.when(m.isNotNull(), marked(m)), plain(h)))
        return F.when(F.contains(h, F.lit("@")), F.when(h.rlike(_ODD), odd).otherwise(plain(h)))

    return non_empty(let(F.lower(unfold(header)), parsed))


def parse_identifiers(header: Column) -> Column:
    """All ``<…>`` captures; null when there are none."""
    return non_empty(F.regexp_extract_all(header, F.lit(IDENTIFIER), F.lit(1)))


def charset_from_content_type(content_type: Column) -> Column:
    """Declared charset, unquoted and lower-cased; null when undeclared."""
    value = F.regexp_extract(content_type, CHARSET, 1)
    return F.nullif(F.lower(F.translate(value, "\"'", "")), F.lit(""))


def subject_prefix(subject: Column) -> Column:
    """``re:``, ``fw:`` or ``fwd:`` at the start of the subject, else null."""
    return F.nullif(F.regexp_extract(F.lower(subject), "(?U)" + SUBJECT_PREFIX, 1), F.lit(""))


def filetime_to_timestamp(ticks: Column) -> Column:
    """100-ns ticks since 1601-01-01 → UTC timestamp; 0 and null give null."""
    micros = bound(ticks, f"t -> case when t <> 0 then cast(floor(t / 10BD) as bigint) - {FILETIME_EPOCH_MICROS} end")
    return micros_to_ntz(micros)


def rfc2822_to_timestamp(date: Column) -> Column:
    """``Fri, 1 Sep 2023 13:00:00 +0300`` → UTC timestamp; unparsable text gives null.

    Weekday, seconds and a trailing comment are optional; two-digit years follow the usual pivot
    (69-99 → 19xx). The offset is applied as an interval, so the session zone plays no part.
    """
    months = ", ".join(f"'{m}'" for m in MONTHS)
    zones = ", ".join(f"'{name}', '{offset}'" for name, offset in ZONE_OFFSETS.items())
    fields = bound(date, f"d -> case when d rlike r'{DATE}' then split(regexp_replace(d, r'{DATE}', '$1|$2|$3|$4|$5|$6|$7'), '[|]') end")
    typed = bound(
        fields,
        f"""f -> named_struct(
            'year', cast(f[2] as int),
            'digits', length(f[2]),
            'month', cast(nullif(array_position(array({months}), lower(f[1])), 0) as int),
            'day', cast(f[0] as int), 'hour', cast(f[3] as int), 'minute', cast(f[4] as int),
            'second', cast(case when f[5] = '' then '0' else f[5] end as decimal(16,6)),
            'zone', coalesce(case when f[6] rlike '^[+-]' then f[6] end, try_element_at(map({zones}), upper(f[6])), '+0000'))""",
    )
    return bound(
        typed,
        """t -> try_make_timestamp_ntz(
            case when t.digits > 2 then t.year when t.year >= 69 then t.year + 1900 else t.year + 2000 end,
            t.month, t.day, t.hour, t.minute, t.second)
          - make_dt_interval(0, cast(concat(left(t.zone, 1), substr(t.zone, 2, 2)) as int),
                                cast(concat(left(t.zone, 1), substr(t.zone, 4, 2)) as int), 0)""",
    )


def received_to_timestamp(received: Column) -> Column:
    """Delivery time: the date after the last ``;`` of a ``Received`` header."""
    return rfc2822_to_timestamp(F.substring_index(received, ";", -1))


def header_map(block: Column) -> Column:
    """Header block → ``map<string,string>`` with lower-cased names; the last duplicate wins.

    The block ends at the first blank line; continuation lines are joined to theirs.
    """
    head = r"regexp_replace(split(b, r'\r?\n\r?\n', 2)[0], r'\r?\n[ \t]+', ' ')"
    lines = rf"filter(split({head}, r'\r?\n'), l -> l rlike r'^[^\s:]+:')"
    entry = r"l -> struct(lower(substring_index(l, ':', 1)) as key, regexp_replace(l, r'^[^:]*:[ \t]*', '') as value)"
    entries = bound(block, f"b -> reverse(transform({lines}, {entry}))")
    last = bound(entries, "es -> filter(es, (e, i) -> array_position(transform(es, x -> x.key), e.key) = i + 1)")
    return F.map_from_entries(last)


def from_name(header: Column) -> Column:
    """Display name: the ``From`` text before the first ``<``, trimmed."""
    return F.trim(F.substring_index(header, "<", 1))


def domain_of(address: Column) -> Column:
    """The piece after the first ``@``; an address without one gives ``""``."""
    return F.coalesce(F.get(F.split(F.trim(address), "@"), F.lit(1)), F.lit(""))


def sender_domain(from_addresses: Column) -> Column:
    """Domain of the first sender address."""
    return domain_of(F.get(from_addresses, F.lit(0)))


def all_domains(*address_lists: Column) -> Column:
    """Sorted distinct domains over the given address lists, blanks dropped."""
    every = F.flatten(F.array_compact(F.array(*address_lists)))
    found = "filter(transform(l, a -> coalesce(get(split(trim(a), '@'), 1), '')), d -> d <> '')"
    return F.coalesce(bound(every, f"l -> array_sort(array_distinct({found}))"), F.expr(EMPTY))


def is_internal(domain: Column, pattern: str) -> Column:
    """True when the sender domain contains the organisation's token (case-sensitive)."""
    return domain.contains(pattern)
