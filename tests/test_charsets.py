"""Charset detection and charset-aware parts, against Python's codecs."""

import random
from email.message import EmailMessage

import pytest
from pyspark.sql import functions as F

from postmill.operators import charsets
from postmill.sources import raw_mail

RUSSIAN = "привет это письмо о счете и карте которая была потеряна вчера вечером Пожалуйста ответьте нам до понедельника спасибо большое за помощь".split()
FRENCH = "bonjour ceci est une lettre à propos de l'élève été déjà reçu garçon où naïve Noël très bientôt merci être âgé".split()
JAPANESE = "こんにちは これは カード に ついて の メール です よろしく お願い します 明日 までに 返事 を ください".split()
WRITTEN = {"koi8-r": RUSSIAN, "windows-1251": RUSSIAN, "windows-1252": FRENCH, "shift_jis": JAPANESE, "utf-16-le": FRENCH, "utf-16-be": RUSSIAN}


def body(rng, words, size):
    return " ".join(rng.choices(words, k=size)).capitalize()


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(body(rng, words, 40).encode(name), name.upper()) for name, words in WRITTEN.items() for _ in range(15)]
    rows += [(b"\xff\xfe\xfd", "shift_jis"), (b"plain", "no-such"), (None, "koi8-r"), (b"x", None), ("é".encode(), "utf-8")]
    return charsets.train(spark.createDataFrame(rows, "body binary, charset string"))


def test_held_out_bodies_are_named_and_read(spark, model):
    rng = random.Random(2)
    rows = []
    for i in range(240):
        name = sorted(WRITTEN)[i % len(WRITTEN)]
        text = body(rng, WRITTEN[name], rng.randint(4, 60))
        text = text.upper() if i % 10 == 0 else text
        rows.append((i, text.encode(name), name, text))
    df = spark.createDataFrame(rows, "i int, b binary, name string, t string")
    got = df.select("name", "t", charsets.detected(F.col("b"), F.lit(None).cast("string"), model).alias("d")).collect()
    right = sum(r.d.charset == r["name"] and r.d.text == r.t for r in got)
    assert right >= 0.98 * len(rows)


def test_model_counts_only_what_decodes(spark, model):
    assert model.names == tuple(sorted(WRITTEN)) and model.logs.shape == (6, charsets.PAIRS)
    rows = spark.createDataFrame([(b"\xff\xfe\xfd", "shift_jis"), ("а".encode("koi8-r"), "KOI8-R")], "body binary, charset string")
    counts = {(r.charset, r.pair): r.n for r in charsets.pair_counts(rows).collect()}
    small, capital = "а".encode("koi8-r")[0], "А".encode("koi8-r")[0]
    want = [0x2000 + small, (small << 8) + 0x20, 0x2000 + capital, (capital << 8) + 0x20]
    assert counts == {("koi8-r", p): 1 for p in want}
    none = charsets.train(rows.limit(0))
    assert none.names == () and charsets.decode(b"\xe9", None, none) == ("windows-1252", "é")


def test_utf16_without_ascii_is_not_taken_for_utf8(spark, model):
    """Letters beyond Latin have no NUL in UTF-16: 04 3F 04 40 is valid UTF-8 as well. Control characters alone change nothing."""
    rows = [("привет".encode("utf-16-be"), "utf-16-be", "привет"), (b"bonjour \x04?", "utf-8", "bonjour \x04?"), ("été\x1f".encode(), "utf-8", "été\x1f")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, b binary, c string, w string")
    got = df.select("c", "w", charsets.detected(F.col("b"), F.lit(None).cast("string"), model).alias("d")).orderBy("i").collect()
    assert [(r.d.charset, r.d.text) for r in got] == [(r.c, r.w) for r in got]
    assert charsets.decode(rows[0][0], None) == ("utf-8", rows[0][0].decode())


def test_first_and_last_bytes_tell_short_bodies(spark):
    """Bodies begin with a capital letter, words do not: the bytes of "Со." in windows-1251 are "яН." in koi8-r."""
    words = "я он на со но да по от ты мы".split()
    rng = random.Random(7)
    rows = [(" ".join(rng.choices(words, k=30)).capitalize() + ".", n) for n in ("koi8-r", "windows-1251") for _ in range(40)]
    rows += [(" ".join(rng.choices(["12", "7", "305"], k=9)) + " é", n) for n in ("utf-16-le", "utf-16-be") for _ in range(5)]
    model = charsets.train(spark.createDataFrame([(t.encode(n), n) for t, n in rows], "body binary, charset string"))
    for text in ("Со.", "На.", "Я.", "Ты."):
        for name in ("koi8-r", "windows-1251"):
            assert charsets.decode(text.encode(name), None, model) == (name, text)
    for name in ("utf-16-le", "utf-16-be"):
        assert charsets.decode("7".encode(name), None, model) == (name, "7")


def test_declared_charset_comes_first(spark, model):
    koi = "письмо".encode("koi8-r")
    rows = [
        (koi, "koi8-r", "письмо"), (koi, "no-such", "письмо"), (koi, "utf-8", "письмо"), (koi, None, "письмо"),
        ("é".encode("utf-16-le"), "utf-16-le", "é"), ("Noël".encode("utf-16-le"), None, "Noël"), ("Noël".encode("utf-16"), "UTF-16", "Noël"),
        ("é".encode(), None, "é"), (b"", "koi8-r", None), (None, None, None), (b"\0", "us-ascii", "\0"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, b binary, c string, w string")
    got = df.select("w", raw_mail.parse_body(F.col("b"), F.col("c"), model).alias("t")).orderBy("i").collect()
    assert [r.t for r in got] == [r.w for r in got]


def mail(*parts):
    out = EmailMessage()
    out["From"], out["Received"] = "a@x.example", "from a by b; Fri, 1 Sep 2023 10:00:00 +0000"
    head = out.as_bytes().rstrip(b"\n").replace(b"\n", b"\r\n") + b"\r\nContent-Type: multipart/mixed; boundary=o\r\n\r\n"
    for kind, charset, data in parts:
        named = f"; charset={charset}" if charset else ""
        head += f"--o\r\nContent-Type: text/{kind}{named}\r\nContent-Transfer-Encoding: 8bit\r\n\r\n".encode() + data + b"\r\n"
    return head + b"--o--\r\n"


def test_each_part_is_decoded_by_its_own_charset(spark, model):
    russian, french = " ".join(RUSSIAN), " ".join(FRENCH)
    raw = mail(
        ("plain", "koi8-r", russian.encode("koi8-r")), ("plain", "iso-8859-1", french.encode("latin-1")), ("plain", None, french.encode("latin-1")),
        ("plain", "utf-8", russian.encode()), ("html", None, f"<p>{russian}</p>".encode("windows-1251")), ("html", "wrong", b"<b>x</b>"),
    )
    files = spark.createDataFrame([("one", raw), ("two", mail(("plain", "us-ascii", b"only ascii"))), ("none", mail())], "path string, content binary")
    got = {r.path: r for r in raw_mail.parse_mails(files, model=model).collect()}
    assert got["one"].plain_text_body == russian + french + french + russian and got["one"].html_body == f"<p>{russian}</p><b>x</b>"
    assert got["two"].plain_text_body == "only ascii" and got["two"].html_body is None
    assert got["none"].plain_text_body is None and all(r.parse_error is None for r in got.values())
    known = raw_mail.declared_bodies(files).collect()
    assert sorted(r.charset for r in known) == ["iso-8859-1", "koi8-r", "us-ascii", "utf-8", "wrong"]
