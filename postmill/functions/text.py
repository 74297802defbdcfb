"""Body text: cleaning, HTML conversion, tokens and n-grams."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from html import unescape
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The seven line-start markers after which a mail is quoted text or a signature.
CUT_MARKERS = (
    r"-- \n",
    r"--\n",
    r"-----Original Message-----",
    r"________________________________",
    r"On .* wrote:",
    r"From: ",
    r"Sent from my iPhone",
)
# Separators of which a run becomes one space (pipes and hyphens are part of the set).
SEPARATORS = "\n\r\t| -"
# The two caution banners, as patterns; the first names the receiving organisation.
OUTSIDE_BANNER = (
    "CAUTION: This email originated from outside {organisation}. Do not click any links or open "
    "attachments unless you are sure of the safety of the contents."
)
EXTERNAL_BANNER = (
    "CAUTION: This email originated from outside of the organization. Do not click links or open "
    "attachments unless you recognize the sender and know the content is safe"
)

# Text-mode blanks, including the four information separators.
_BLANK = r"[\s\x1c-\x1f]"
_TRIM = rf"(?U)^{_BLANK}+|{_BLANK}+$"
_TOKEN_BREAK = r"[^\p{L}\p{N}_]+"

# Conversion from HTML to text, in order (pattern, replacement): before lists and quotes are marked, and after.
_HIDDEN = (
    (r"[\x01-\x03]", ""),
    (r"(?is)<!--.*?-->", ""),
    (r"(?is)<script\b.*?</script\s*>", ""),
    (r"(?is)<style\b.*?</style\s*>", ""),
    (r"(?is)<head\b.*?</head\s*>", ""),
    (r"[ \t\r\n]+", " "),
)
_STRUCTURE = r"(?i)</?(?:ol|ul|li|blockquote)\b[^>]*>"
_TAGS = (
    (r"(?i)<br\s*/?>", "\n"),
    (r"(?i)</?(?:p|div|section|article|header|footer|nav|table|tr|pre|body|html)\b[^>]*>", "\n\n"),
    *((rf"(?i)<h{n}\b[^>]*>", "\n\n" + "#" * n + " ") for n in range(1, 7)),
    (r"(?i)</h[1-6]\s*>", "\n\n"),
    (r"(?i)<hr\b[^>]*>", "\n\n* * *\n\n"),
    (r"(?i)</t[dh]\s*>", " "),
    (r"<[^>]*>", ""),
)
_BLANKS = ((r"[ \t]+\n", "\n"), (r"\n[ \t]+", "\n"), (r"\n{3,}", "\n\n"))
# Marks that no text keeps: quote begins, quote ends, one step of a list's indentation.
_QUOTE, _UNQUOTE, _STEP = "\x01", "\x02", "\x03"
_QUOTE_EDGES = (
    (f"{_QUOTE}\\s*{_UNQUOTE}", ""),
    (f"{_QUOTE}\\s+(?={_QUOTE})", _QUOTE),
    (f"\\s*({_QUOTE}+)\\s*", "\n\n$1"),
    (f"{_UNQUOTE}\\s+(?={_UNQUOTE})", _UNQUOTE),
    (f"\\s*({_UNQUOTE}+)\\s*", "$1\n\n"),
)
_REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def banners(organisation: str | None = None) -> list[str]:
    """The caution banners to remove; the first one needs the organisation's name."""
    first = [OUTSIDE_BANNER.format(organisation=organisation)] if organisation else []
    return [*first, EXTERNAL_BANNER]


def trim_blanks(text: Column) -> Column:
    """Trim every Unicode blank, not only spaces."""
    return F.regexp_replace(text, _TRIM, "")


def clean_text(text: Column, banner_patterns: Sequence[str] | None = None) -> Column:
    """Body without quoted mail, signature, separators and banners; null gives ``""``.

    Each marker removes everything from its line to the end, and only a cut text is trimmed.
    ``d`` keeps ``\\n`` the only line end, so a lone CR or U+2028 starts no line.
    """
    pattern = "(?dms)^(?:" + "|".join(CUT_MARKERS) + ").*"
    body = F.coalesce(text, F.lit(""))
    cut = F.regexp_replace(body, pattern, "")
    kept = F.when(F.length(cut) < F.length(body), trim_blanks(cut)).otherwise(body)
    clean = F.regexp_replace(F.translate(kept, SEPARATORS, " " * len(SEPARATORS)), " {2,}", " ")
    for banner in banners() if banner_patterns is None else banner_patterns:
        clean = F.regexp_replace(clean, banner, "")
    return F.when(clean.rlike(rf"(?U)^{_BLANK}*$"), F.lit("")).otherwise(clean)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _replaced(text: Column, steps: Sequence[tuple[str, str]]) -> Column:
    for pattern, replacement in steps:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def _references() -> Column:
    """All named references, and the numeric ones that do not stand for their own number, as a constant map."""
    odd = [*range(0x20), *range(0x7F, 0xA0), *range(0xD800, 0xE000)]
    table = {name[:-1]: value for name, value in html5.items() if name.endswith(";")}
    table |= {f"#{n}": unescape(f"&#{n};") for n in odd}
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def decode_references(text: Column) -> Column:
    """``&name;``, ``&#number;`` and ``&#xnumber;`` decoded once; what is no reference stays as it is."""

    def named(name: Column) -> Column:
        number = F.when(name.rlike("^#[xX]"), F.conv(F.substr(name, F.lit(3)), 16, 10)).when(name.startswith("#"), F.substr(name, F.lit(2)))
        common = F.when(name == "amp", "&").when(name == "lt", "<").when(name == "gt", ">").when(name == "quot", '"').when(name == "nbsp", "\u00a0")
        return F.coalesce(common, _let(number.cast("int"), lambda n: F.coalesce(
            F.element_at(_references(), F.coalesce(F.concat(F.lit("#"), n.cast("string")), name)),
            F.when(n > 0x10FFFF, "\ufffd").when(n.isNotNull(), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")),
        )))

    def decoded(piece: Column) -> Column:
        whole = lambda name: F.concat(named(name), F.substr(piece, F.length(name) + 2))
        return F.coalesce(_let(F.regexp_extract(piece, _REFERENCE, 1), whole), F.concat(F.lit("&"), piece))

    def joined(t: Column) -> Column:
        found = F.transform(F.split(t, "&", -1), lambda piece, i: F.when(i == 0, piece).otherwise(decoded(piece)))
        return F.when(F.contains(t, F.lit("&")), F.array_join(found, "")).otherwise(t)

    return _let(text, joined)


def _mark_structure(html: Column) -> Column:
    """Lists and quotes as marks: one fold over their tags with the open lists as a stack.

    The stack holds the last number of each open ordered list, -1 for an unordered one. Only the tags go
    through the fold; the text between them is joined to their marks afterwards.
    """

    def add(state: Column, tag: Column) -> Column:
        return _let(F.lower(F.regexp_extract(tag, "^</?([a-zA-Z]+)", 1)), lambda kind: step(state, tag, kind))

    def step(state: Column, tag: Column, kind: Column) -> Column:
        ends, is_list = tag.startswith("</"), kind.isin("ol", "ul")
        stack = state["stack"]
        depth, top = F.size(stack), F.try_element_at(stack, F.lit(-1))
        outer = F.slice(stack, F.lit(1), F.greatest(depth - 1, F.lit(0)))
        given = F.regexp_extract(tag, r"(?i)\bstart\s*=\s*[\"']?([0-9]{1,9})", 1)
        begin = F.when(kind == "ul", -1).when(given != "", given.try_cast("int") - 1).otherwise(0)
        item = (kind == "li") & ~ends
        next_stack = (
            F.when(is_list & ends, outer)
            .when(is_list, F.concat(stack, F.array(begin)))
            .when(item & (top >= 0), F.concat(outer, F.array(top + 1)))
            .otherwise(stack)
        )
        bullet = F.when(top >= 0, F.concat((top + 1).cast("string"), F.lit(". "))).otherwise("* ")
        outermost = F.when(ends, depth <= 1).otherwise(depth == 0)
        mark = (
            F.when(is_list & outermost, "\n\n")
            .when(item, F.concat(F.lit("\n"), F.repeat(F.lit(_STEP), F.greatest(depth, F.lit(1))), bullet))
            .when(kind == "blockquote", F.when(ends, _UNQUOTE).otherwise(_QUOTE))
            .otherwise("")
        )
        return F.struct(next_stack.alias("stack"), F.concat(state["marks"], F.array(mark)).alias("marks"))

    start = F.struct(F.array().cast("array<int>").alias("stack"), F.array().cast("array<string>").alias("marks"))

    def joined(t: Column) -> Column:
        marks = F.aggregate(F.regexp_extract_all(t, F.lit(_STRUCTURE), F.lit(0)), start, add, lambda s: s["marks"])
        pieces = F.zip_with(F.split(t, _STRUCTURE, -1), F.concat(marks, F.array(F.lit(""))), lambda x, m: F.concat(x, m))
        return F.when(t.rlike(_STRUCTURE), F.array_join(pieces, "")).otherwise(t)

    return _let(html, joined)


def _quote_lines(text: Column) -> Column:
    """``> `` before every line within quotes, once per level: a fold over the lines with the level as state."""

    def add(state: Column, line: Column) -> Column:
        plain = F.translate(line, _QUOTE + _UNQUOTE, "")
        level = state["level"] + F.length(line) - F.length(F.translate(line, _QUOTE, ""))
        quoted = F.when(level > 0, F.rtrim(F.concat(F.repeat(F.lit("> "), level), plain))).otherwise(plain)
        after = F.greatest(level - (F.length(line) - F.length(F.translate(line, _UNQUOTE, ""))), F.lit(0))
        return F.struct(after.alias("level"), F.concat(state["lines"], F.array(quoted)).alias("lines"))

    start = F.struct(F.lit(0).alias("level"), F.array().cast("array<string>").alias("lines"))

    def joined(t: Column) -> Column:
        lines = F.split(F.regexp_replace(_replaced(t, _QUOTE_EDGES), r"^\s+|\s+$", ""), "\n", -1)
        quoted = F.array_join(F.aggregate(lines, start, add, lambda s: s["lines"]), "\n")
        return F.when(F.contains(t, F.lit(_QUOTE)), quoted).otherwise(t)

    return _let(text, joined)


def html_to_text(html: Column) -> Column:
    """Visible text of an HTML body; links, images and emphasis leave only their text.

    Headings get ``#`` marks, list items a bullet or their number, indented by level, quoted lines ``> `` per
    level. References are decoded once, after the tags have gone.
    """
    text = _replaced(_mark_structure(_replaced(html, _HIDDEN)), _TAGS)
    text = F.translate(decode_references(text), "\u00a0", " ")
    text = F.regexp_replace(_quote_lines(_replaced(text, _BLANKS)), _STEP, "  ")
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def fill_plain_text_body(mails: DataFrame) -> DataFrame:
    """Where only an HTML body exists, fill the plain one from it and say so."""
    convert = F.col("html_body").isNotNull() & F.col("plain_text_body").isNull()
    filled = F.when(convert, html_to_text(F.col("html_body"))).otherwise(F.col("plain_text_body"))
    return mails.withColumns({"plain_text_is_converted": convert, "plain_text_body": filled})


def tokens(text: Column) -> Column:
    """Lower-case runs of at least two word characters."""
    return F.filter(F.split(F.lower(text), _TOKEN_BREAK), lambda t: F.length(t) >= 2)


def ngrams(words: Column, n: int) -> Column:
    """The n-grams of one token array, joined by a space; fewer than n tokens give an empty array.

    ``words`` should be a materialised column: the lambda reads it once per position.
    """
    if n == 1:
        return words
    starts = F.slice(words, 1, F.greatest(F.size(words) - (n - 1), F.lit(0)))
    return F.transform(starts, lambda w, i: F.concat_ws(" ", w, *[F.get(words, i + k) for k in range(1, n)]))
