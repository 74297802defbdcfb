"""Text and entity expressions against Python's own regular expressions."""

import re
from html import unescape
from html.entities import html5

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postmill.functions import entities as E
from postmill.functions import text as X
from tests.test_headers import column

MARKERS = [m + ".*" for m in X.CUT_MARKERS]


def cleaned(text):
    """What cleaning must give, in plain Python."""
    if not text:
        return ""
    found = re.search("|".join("^" + m for m in MARKERS), text, re.MULTILINE | re.DOTALL)
    kept = text[: found.start()].strip() if found else text
    kept = re.sub(r"[\n\r\t| -]+", " ", kept)
    for banner in X.banners("Acme"):
        kept = re.sub(banner, "", kept)
    return kept if kept.strip() else ""


CASES = [
    None,
    "",
    " \n\t ",
    "plain",
    " kept blank ",
    "a-b | c\n\nd\te",
    "text\n-- \nsignature",
    "text\n--\nsignature",
    "text -- \nno line start",
    "text\n-----Original Message-----\nold",
    "text\n" + "_" * 40 + "\nold",
    "text\nOn Monday Ann wrote:\n> old",
    "text\nOn Monday nothing follows",
    "text\nOn Monday\nBob wrote: old",
    "text  \nFrom: a\nold",
    "text\rFrom: a",
    "text From: a",
    "From: at the start",
    "text\nSent from my iPhone",
    "x\x1c\nFrom: a",
    X.EXTERNAL_BANNER + ". Hello",
    X.OUTSIDE_BANNER.format(organisation="Acme") + " Hello",
]


def test_clean_text(spark):
    clean = lambda c: X.clean_text(c, X.banners("Acme"))
    assert column(spark, CASES, clean) == [cleaned(c) for c in CASES]


piece = st.sampled_from(
    ["On ", " wrote:", "From: ", "-- ", "--", "\n", "\r", "\u2028", "\x85", "\u00a0", "|", "_" * 32, "é", "text", "\x0b", " "]
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(piece, max_size=12).map("".join), min_size=1, max_size=40))
def test_clean_text_matches_python(spark, texts):
    assert column(spark, texts, X.clean_text) == [cleaned(t) for t in texts]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<ol><li>a<li>b</ol>", "1. a\n  2. b"),
        ("x<ol start='9'><li>a</li></ol><ol><li>b</li></ol>", "x\n\n  9. a\n\n  1. b"),
        ("x<ul><li>a<ol><li>b</li><li>c<ul><li>d</li></ul></li></ol></li><li>e</li></ul>y", "x\n\n  * a\n    1. b\n    2. c\n      * d\n  * e\n\ny"),
        ("<li>loose</li></ol></ul>end", "* loose\n\nend"),
        ("a<blockquote>b<br>c</blockquote>d", "a\n\n> b\n> c\n\nd"),
        ("<blockquote>a<blockquote><p>b</p></blockquote></blockquote>c", "> a\n>\n> > b\n\nc"),
        ("<blockquote></blockquote>x</blockquote>y", "x\n\ny"),
        ("<blockquote>a<ol><li>b</ol></blockquote>", "> a\n>\n>   1. b"),
        ("<blockquote>open", "> open"),
        ("&amp;lt; &nope; &#xE9;&#233;&eacute;&Eacute; &#128; &#0; &#1114112; & &; &#; 5&6", "&lt; &nope; éééÉ € \ufffd \ufffd & &; &#; 5&6"),
        ("&NotEqualTilde;&AMP;&hearts;&#x1F600;", "≂̸&♥😀"),
        ("\x01\x02\x03 plain", "plain"),
        ("", ""),
        (None, None),
    ],
)
def test_html_structure(spark, html, want):
    assert column(spark, [html], X.html_to_text) == [want]


def test_references_are_decoded_as_python_does(spark):
    names = [n for n in html5 if n.endswith(";")]
    numbers = [*range(1, 0x250), *range(0x2000, 0x2100), 0xD800, 0xFFFD, 0x10000, 0x10FFFD, 0x110000]
    whole = "".join(f"<&{n}" for n in names) + "".join(f" &#{n};&#x{n:x};&#X{n:X};" for n in numbers if n < 0xFDD0 or n > 0xFFFC)
    got = column(spark, [whole], X.decode_references)[0]
    assert got == unescape(whole)


def test_html_to_text(spark):
    html = (
        "<html><head><title>t</title><style>p{}</style></head><body><!-- c --><script>x</script>"
        "<h2>Head</h2><p>One <b>two</b> &amp; <a href='u'>link</a><br>next</p><ul><li>item</li></ul>&lt;3</body></html>"
    )
    assert column(spark, [html], X.html_to_text) == ["## Head\n\nOne two & link\nnext\n\n  * item\n\n<3"]


def test_fill_plain_text(spark):
    rows = spark.createDataFrame([("<p>a</p>", None), ("<p>a</p>", "b"), (None, None)], "html_body string, plain_text_body string")
    got = X.fill_plain_text_body(rows).select("plain_text_body", "plain_text_is_converted").collect()
    assert [tuple(r) for r in got] == [("a", True), ("b", False), (None, False)]


def test_tokens_and_ngrams(spark):
    words = column(spark, ["The cat, a CAT_1 é ÉTÉ x"], X.tokens)[0]
    assert words == ["the", "cat", "cat_1", "été"]
    rows = spark.createDataFrame([(words,), (["one"],), ([],)], "t array<string>")
    got = rows.select(X.ngrams(F.col("t"), 1), X.ngrams(F.col("t"), 2), X.ngrams(F.col("t"), 3)).collect()
    assert got[0][1] == ["the cat", "cat cat_1", "cat_1 été"] and got[0][2] == ["the cat cat_1", "cat cat_1 été"]
    assert list(got[1]) == [["one"], [], []] and list(got[2]) == [[], [], []]


ENTITY_TEXTS = [
    "id 12345678901 and phone +974 5512 345678, account 123456789",
    "passport AB12345 mail John.Doe+x@mail.example.com IBAN QA58DOHB00001234567890ABCDEFG",
    "pay $1,250.00 or QAR 300 on 2024-03-05",
    "١٢٣٤٥٦٧٨٩٠١ arabic digits",
    "é12345678 no boundary, 7 8.50",
    "",
]


def python_entities(text):
    return [(t, m) for t, p in E.ENTITY_PATTERNS.items() for m in re.findall(p, text)]


def test_entities(spark):
    got = column(spark, ENTITY_TEXTS, E.entities_from_text)
    assert [[tuple(e) for e in row] for row in got] == [python_entities(t) for t in ENTITY_TEXTS]
    types = [t for t, v in python_entities(ENTITY_TEXTS[2]) if v == "2024-03-05"]
    assert types == ["Transaction Date", "Date of Birth"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("AB019é-+@., $Q١_", max_size=30), min_size=1, max_size=40))
def test_entities_match_python(spark, texts):
    got = column(spark, texts, E.entities_from_text)
    assert [[tuple(e) for e in row] for row in got] == [python_entities(t) for t in texts]


def test_entities_from_json(spark):
    cases = {
        '{"A": "x", "B": ["y", "z"]}': [("A", "x"), ("B", "y"), ("B", "z")],
        '{"A": 1, "B": {"c": "d"}, "C": null, "D": true}': [],
        '["a"]': [],
        '"a"': [],
        "no json": [],
        '{"A": "x"': [],
        "{}": [],
        None: [],
        '{"A": []}': [],
    }
    got = column(spark, list(cases), E.entities_from_json)
    assert [[tuple(e) for e in row] for row in got] == list(cases.values())
