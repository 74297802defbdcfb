"""Header expressions against the standard library and crafted rows."""

import random
from datetime import UTC, datetime
from email.utils import formataddr, format_datetime, getaddresses, parsedate_to_datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postmill.functions import headers as H
from postmill.functions.times import seconds_between, to_utc_ntz


def column(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.select("i", expression(F.col("v")).alias("r")).orderBy("i").select("r").collect()]


def test_addresses(spark):
    cases = {
        None: None,
        "": None,
        "undisclosed recipients": None,
        "A@B.example": ["a@b.example"],
        '"Doe, John" <John.Doe@X.example>': ["john.doe@x.example"],
        "a@x.example,\r\n  B <b@y.example>": ["a@x.example", "b@y.example"],
        "(home) a@x.example, C (at, work) <c@z.example>": ["a@x.example", "c@z.example"],
        "team: a@x.example, b@y.example;": ["a@x.example", "b@y.example"],
        "<>, a@x.example": ["a@x.example"],
        '"quo\\"te, d" <q@x.example>': ["q@x.example"],
        "john, a@x.example": ["john", "a@x.example"],
        "<@>": ["@"],
    }
    got = column(spark, list(cases), H.parse_addresses)
    del cases["<@>"]  # no valid address; only checked not to fail
    assert got[: len(cases)] == list(cases.values())


word = st.text("abcdefgXYZ0123456789.-_+", min_size=1, max_size=8).map(lambda s: "a" + s.replace("..", ".").rstrip(".") + "b")
name = st.text("abc ABC,;.()'-", max_size=10)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(name, word, word), min_size=1, max_size=4), min_size=1, max_size=20))
def test_addresses_match_the_standard_library(spark, batches):
    headers = [", ".join(formataddr((n.strip(), f"{u}@{d}")) for n, u, d in b) for b in batches]
    want = [[a for _, a in getaddresses([h.lower()]) if a.strip()] or None for h in headers]
    assert column(spark, headers, H.parse_addresses) == want


def odd_lists(n):
    """Address lists with nested comments, quoted local parts, and separators and escapes inside both."""
    r = random.Random(5)
    atom = lambda: "".join(r.choice("abcxyz019-_+") for _ in range(r.randint(1, 6)))

    def comment(depth=0):
        letters = (" ", ",", '"', "<", ">", "@", ";", ".", "\\)", "\\(", "\\\\", atom())
        return "(" + "".join(r.choice(letters) if depth > 3 or r.random() < 0.4 else comment(depth + 1) for _ in range(r.randint(0, 3))) + ")"

    def quoted():
        return '"' + "".join(r.choice(("a", "B", " ", ",", ";", "<", ">", "(", ")", "@", ":", ".", '\\"', "\\\\", "\\z")) for _ in range(r.randint(0, 6))) + '"'

    def local():
        return r.choice((atom, lambda: atom() + "." + atom(), quoted, lambda: atom() + "." + quoted(), lambda: quoted() + "." + atom()))()

    def address():
        aside = lambda: r.choice(("", "", f" {comment()} "))
        spec = f"{local()}@{atom()}.example"
        named = f"{aside()}{r.choice((quoted(), atom(), atom() + ' ' + quoted()))} {aside()}<{spec}>{aside()}"
        return r.choice((aside() + spec + aside(), named, f"<{spec}>", f"{local()}{comment()}@{atom()}.example"))

    return [", ".join(address() for _ in range(r.randint(1, 4))) for _ in range(n)]


def test_nested_comments_and_quoted_local_parts(spark):
    headers = odd_lists(1500)
    want = [[a for _, a in getaddresses([h.lower()], strict=False) if a.strip()] or None for h in headers]
    assert sum('"' in a for w in want for a in w or []) > 500
    assert column(spark, headers, H.parse_addresses) == want
    opened = ['"a <b@x.example>', "(a <b@x.example>", "(a (b) <b@x.example>", '"c.d"@x.example, "e']
    assert [g and len(g) for g in column(spark, opened, H.parse_addresses)] == [1, 1, 1, 2]
    long = ", ".join(f'"n, {i}" (a (b)) <"u {i}"@x.example>' for i in range(5000))
    assert column(spark, [long], H.parse_addresses) == [[f'"u {i}"@x.example' for i in range(5000)]]


def test_identifiers(spark):
    cases = {None: None, "": None, "no brackets": None, "<a@b> <c@d>\r\n <e@f>": ["a@b", "c@d", "e@f"], "<a b> <c>": ["c"]}
    assert column(spark, list(cases), H.parse_identifiers) == list(cases.values())


def test_charset_and_prefix(spark):
    charsets = {"text/plain": None, "text/plain; charset=utf-8; x=y": "utf-8", 'a; charset = "ISO-8859-1"': "iso-8859-1", "a; CHARSET=x": None, None: None}
    assert column(spark, list(charsets), H.charset_from_content_type) == list(charsets.values())
    prefixes = {"RE: x": "re:", " Fwd: x": "fwd:", "fw:x": "fw:", "FWD : x": None, "Re x": None, "x re: y": None, "\u00a0re: x": "re:", None: None, "fd: x": None}
    assert column(spark, list(prefixes), H.subject_prefix) == list(prefixes.values())


def test_filetime(spark):
    cases = {133380360000000000: datetime(2023, 9, 1, 10), 133380360000000019: datetime(2023, 9, 1, 10, 0, 0, 1), 0: None, None: None}
    assert column(spark, list(cases), H.filetime_to_timestamp, "bigint") == list(cases.values())


def test_rfc2822(spark):
    cases = {
        "Fri, 1 Sep 2023 13:00:00 +0300": datetime(2023, 9, 1, 10),
        "1 Sep 2023 10:00 GMT": datetime(2023, 9, 1, 10),
        "Fri,  01 Sep 2023 05:30:00 -0430 (VET)": datetime(2023, 9, 1, 10),
        "1 Sep 23 10:00:00 UT": datetime(2023, 9, 1, 10),
        "1 Sep 99 10:00:00 EST": datetime(1999, 9, 1, 15),
        "31 Feb 2023 10:00:00 +0000": None,
        "yesterday": None,
        "": None,
        None: None,
    }
    assert column(spark, list(cases), H.rfc2822_to_timestamp) == list(cases.values())
    received = ["from a (b; c) by d; Fri, 1 Sep 2023 13:00:00 +0300"]
    assert column(spark, received, H.received_to_timestamp) == [datetime(2023, 9, 1, 10)]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.datetimes(datetime(1971, 1, 1), datetime(2099, 1, 1), timezones=st.timezones()), min_size=1, max_size=30))
def test_rfc2822_matches_the_standard_library(spark, times):
    texts = [format_datetime(t.replace(microsecond=0)) for t in times]
    texts = [t for t in texts if len(t.rsplit(" ", 1)[1]) == 5]
    want = [parsedate_to_datetime(t).astimezone(UTC).replace(tzinfo=None) for t in texts]
    assert column(spark, texts or ["x"], H.rfc2822_to_timestamp) == (want or [None])


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert column(spark, ["Sun, 10 Mar 2024 02:30:00 +0000"], H.rfc2822_to_timestamp) == [datetime(2024, 3, 10, 2, 30)]
        instant = lambda v: to_utc_ntz(v.cast("timestamp_ltz"))
        assert column(spark, ["2024-03-10 05:30:00+03:00"], instant) == [datetime(2024, 3, 10, 2, 30)]
        gap = lambda v: seconds_between(v, F.lit("2024-03-09 23:00:00").cast("timestamp_ntz"))
        assert column(spark, ["2024-03-10 23:00:00.25"], lambda v: gap(v.cast("timestamp_ntz"))) == [86400.25]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_header_map(spark):
    block = "From: a\r\nX-Long: one\r\n\ttwo\r\nfrom: b\r\nEmpty:\r\n\r\nBody: c"
    assert column(spark, [block], H.header_map) == [{"from": "b", "x-long": "one two", "empty": ""}]


def test_domains(spark):
    rows = spark.createDataFrame(
        [(["a@x.example", "b@y.example"], ["c@x.example", "nodomain"], None), (None, None, None)],
        "f array<string>, t array<string>, c array<string>",
    )
    got = rows.select(H.sender_domain(F.col("f")), H.all_domains(F.col("f"), F.col("t"), F.col("c"))).collect()
    assert [tuple(r) for r in got] == [("x.example", ["x.example", "y.example"]), ("", [])]


def test_header_expressions_stay_in_the_jvm(spark):
    rows = spark.createDataFrame([("a@b",)], "v string")
    plan = rows.select(H.parse_addresses(F.col("v")), H.rfc2822_to_timestamp(F.col("v")), H.header_map(F.col("v")))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
