"""Raw mail, selections, checkpoints, table loading, CSV and the end-to-end jobs."""

import logging
from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from postmill.functions.headers import charset_from_content_type
from postmill.operators import naive_bayes
from postmill.operators.embeddings import hashed_embeddings, read_store
from postmill.plans import extract, load, transform
from postmill.schemas import KEYS, MAIL, TABLES
from postmill.sources import raw_mail, select, tables
from postmill.sources.checkpoints import Checkpoints, checkpoint_folder, checkpointed
from postmill.streaming import incremental

HEAD = "From: =?utf-8?q?Ann_=C3=84?= =?utf-8?q?_B?= <Ann@X.example>\r\nReceived: by d; Fri, 1 Sep 2023 13:00:05 +0300\r\nDate: Fri, 1 Sep 2023 13:00:00 +0300\r\n"


def eml(headers, body, charset="utf-8"):
    return (HEAD + headers + "\r\n").encode() + body.encode(charset)


MIXED = """Message-ID: <b@x>\r
In-Reply-To: <a@x>\r
References: <a@x>\r
Subject: Re: question\r
To: "Desk, The" <desk@corp.example>,\r
 c@y.example\r
Content-Type: multipart/mixed; boundary=o\r
"""
MIXED_BODY = """--o\r
Content-Type: multipart/alternative; boundary=i\r
\r
--i\r
Content-Type: text/plain; charset=utf-8\r
Content-Transfer-Encoding: base64\r
\r
cGxhaW4gw6k=\r
--i\r
Content-Type: text/html\r
\r
<p>html</p>\r
--i--\r
--o\r
Content-Type: text/plain\r
\r
second\r
--o--\r
"""


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("mails")
    (base / "inner" / "deep").mkdir(parents=True)
    (base / "a.eml").write_bytes(eml("Message-ID: <a@x>\r\nSubject: question\r\nTo: desk@corp.example\r\n", "Hello there\n-- \nsig"))
    (base / "inner" / "b.eml").write_bytes(eml(MIXED, MIXED_BODY))
    (base / "inner" / "deep" / "c.eml").write_bytes(eml("Message-ID: <c@x>\r\nContent-Type: text/html\r\n", "<p>only html</p> \xe9", "latin-1"))
    (base / "inner" / "broken.eml").write_bytes(b"Subject: no sender\r\n\r\nbody")
    (base / "note.txt").write_bytes(b"no mail")
    return str(base)


def test_raw_mail(spark, folder):
    files = raw_mail.read_mail_files(spark, folder)
    assert files.count() == 4
    parsed = raw_mail.parse_mails(files)
    bad = raw_mail.quarantined(parsed).collect()
    assert [(r.path.rsplit("/", 1)[1], r.parse_error) for r in bad] == [("broken.eml", "no header From, Received")]
    mails = raw_mail.accepted(parsed)
    assert mails.columns == [f.name for f in MAIL.fields]
    by_id = {r.message_id: r for r in mails.collect()}
    b = by_id["b@x"]
    assert b.from_name == "Ann Ä B" and b.from_address == ["ann@x.example"] and b.to_address == ["desk@corp.example", "c@y.example"]
    assert b.plain_text_body.split() == ["plain", "é", "second"] or b.plain_text_body.replace("\r\n", "") == "plain ésecond"
    assert b.html_body.strip() == "<p>html</p>" and b.subject_prefix == "re:"
    assert (b.previous_message_id, b.references, b.cc_address) == ("a@x", ["a@x"], None)
    assert b.submit_time == datetime(2023, 9, 1, 10) and b.delivery_time == datetime(2023, 9, 1, 10, 0, 5)
    assert by_id["c@x"].plain_text_body == "<p>only html</p> é" and by_id["c@x"].html_body is None


def test_mime_words(spark):
    rows = spark.createDataFrame([("=?iso-8859-1?q?caf=E9?= x",), ("plain",), (None,), ("=?bad?q?x?=",)], "h string")
    assert [r[0] for r in rows.select(raw_mail.decode_mime_words("h")).collect()] == ["café x", "plain", None, "=?bad?q?x?="]


def test_bodies(spark):
    rows = [
        ("é".encode(), None, "é"),
        ("é".encode("windows-1256"), "windows-1256", "é"),
        ("é".encode("latin-1"), None, "é"),
        ("é".encode("latin-1"), "utf-8", "é"),
        ("x".encode(), "unknown-charset", "x"),
        (b"\x81\x8d", "utf-8", "��"),
        (b"", None, None),
        (None, "utf-8", None),
    ]
    df = spark.createDataFrame([(i, b, f"text/plain; charset={c}" if c else None, w) for i, (b, c, w) in enumerate(rows)], "i int, b binary, c string, w string")
    got = df.select("i", raw_mail.parse_body(F.col("b"), charset_from_content_type(F.col("c"))).alias("t"), "w").orderBy("i").collect()
    assert [r.t for r in got] == [r.w for r in got]


def test_selections(spark):
    mails = spark.createDataFrame(
        [("a", datetime(2024, 1, 2, 1)), ("a", datetime(2024, 1, 1, 23)), ("b", datetime(2024, 1, 2))], "message_id string, submit_time timestamp_ntz"
    )
    asked = spark.createDataFrame([("<a>",), ("a",), ("<z>",)], "message_id string")
    assert [tuple(r) for r in select.fetch_by_ids(mails, asked).collect()] == [("a", datetime(2024, 1, 1, 23))]
    assert [r[0] for r in select.ids_not_found(mails, asked).collect()] == ["z"]
    assert tuple(select.request_counts(mails, asked).first()) == (2, 1)
    for since in (date(2024, 1, 2), datetime(2024, 1, 2, 18)):
        assert select.fetch_since(mails, since).count() == 2
    assert [r[0] for r in select.first_n(mails, 2, "submit_time", "message_id").collect()] == ["a", "b"]
    assert [tuple(r) for r in select.source_counts(mails, "message_id").collect()] == [("a", 2), ("b", 1)]


def test_day_filter_reaches_the_scan(spark, tmp_path):
    spark.range(3).select(F.lit("2024-01-02 00:00:00").cast("timestamp_ntz").alias("submit_time")).write.parquet(str(tmp_path / "m"))
    chosen = select.fetch_since(spark.read.parquet(str(tmp_path / "m")), date(2024, 1, 1))
    assert "PushedFilters: [IsNotNull(submit_time), GreaterThanOrEqual(submit_time" in chosen._jdf.queryExecution().executedPlan().toString()


def test_checkpoints(spark, tmp_path):
    store = Checkpoints(spark, str(tmp_path / "points"))
    assert store.pull("x") is None and store.pull_latest() is None
    store.save("x", spark.range(3))
    assert store.pull("x").count() == 3
    import os

    store.save("y", spark.range(5))
    os.utime(tmp_path / "points" / "x", (1, 1))
    assert store.pull_latest().count() == 5
    assert checkpointed(spark.range(4).where("id > 1")).count() == 2 and checkpoint_folder(spark)


def test_checkpoint_folder_comes_from_the_session():
    class Context:
        master, folder = "spark://cluster", None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    session = SimpleNamespace(conf={"spark.checkpoint.dir": "hdfs://shared/points"}, sparkContext=Context())
    assert checkpoint_folder(session) == session.sparkContext.folder == "hdfs://shared/points"
    with pytest.raises(RuntimeError):
        checkpoint_folder(SimpleNamespace(conf={}, sparkContext=Context()))


ROWS = {
    "topics": [(1, "loans")],
    "messages": [("m1", 1, False, "Sub, \"ject\"", None, datetime(2024, 1, 1, 1, 2, 3), None, None, "line\nbreak", "Ann", None, True, None, None, "x.example", False, "line break", None, "en")],
    "addresses": [("m1", "from", "a@x"), ("m2", "to", "b@x")],
    "references": [("m1", "m0")],
    "domains": [("m1", "x")],
    "word_frequencies": [(1, "loan", 3), (7, "card", 2)],
    "classifications": [("m1", "other"), ("m3", None)],
    "products": [("m1", "Credit Card")],
    "entities": [("m1", "IBAN", "GB1"), ("m1", None, None)],
    "summaries": [("m1", "short")],
}


def test_tables_round_trip(spark, tmp_path, caplog):
    store = tables.TableStore(spark, str(tmp_path / "tables"))
    assert {t: df.count() for t, df in store.read_all().items()} == dict.fromkeys(TABLES, 0)
    frames = {t: spark.createDataFrame(rows, TABLES[t]) for t, rows in ROWS.items()}
    rejected = load.load_all(frames, store)
    assert {t: r.count() for t, r in rejected.items() if r.count()} == {}
    assert sorted(r.message_id for r in store.read("messages").collect()) == ["m1", "m2", "m3"]
    assert sorted(r.topic_id for r in store.read("topics").collect()) == [1, 7]
    for table in TABLES:
        stored = {tuple(r) for r in store.read(table).collect()}
        assert {tuple(r) for r in frames[table].collect()} <= stored
        ids = [r.id for r in tables.with_surrogate_id(store.read(table), table).collect()]
        assert len(set(ids)) == len(ids) or table == "entities"
    with caplog.at_level(logging.ERROR):
        assert store.load(spark.range(1), "nowhere") is None
    assert "nowhere" in caplog.text and not (tmp_path / "tables" / "nowhere").exists()

    paths = load.export_all(store, str(tmp_path / "csv"), date(2024, 5, 6))
    assert paths["messages"].endswith("messages_2024-05-06")
    for table, path in paths.items():
        back = tables.read_csv(spark, path, TABLES[table])
        assert sorted(map(str, back.collect())) == sorted(map(str, store.read(table).collect()))


def test_conflicts_and_repeated_loads(spark, tmp_path):
    store = tables.TableStore(spark, str(tmp_path / "tables"))
    child = spark.createDataFrame([("m1", "from", "a@x")], TABLES["addresses"])
    store.load(child, "addresses")
    assert [(r.message_id, r.subject) for r in store.read("messages").collect()] == [("m1", None)]
    batch = spark.createDataFrame([("m1", "s"), ("m2", "t"), ("m2", "t"), ("m2", "u")], "message_id string, subject string")
    assert [r.reject_reason for r in store.load(batch, "messages").collect()] == ["message_id is repeated"]
    once = sorted((r.message_id, r.subject) for r in store.read("messages").collect())
    assert once[0] == ("m1", "s") and [k for k, _ in once] == ["m1", "m2"]
    assert {r.reject_reason for r in store.load(batch, "messages").collect()} == {"message_id is stored already"}
    assert sorted((r.message_id, r.subject) for r in store.read("messages").collect()) == once


LOADED = ("topics", "messages", "addresses", "references")


def stored(store):
    return {t: sorted(map(str, store.read(t).collect())) for t in LOADED}


@pytest.mark.parametrize("killed", ["messages", "references"])
def test_a_load_that_failed_half_way_is_repeated(spark, tmp_path, monkeypatch, killed):
    frames = {t: spark.createDataFrame(ROWS[t], TABLES[t]) for t in LOADED}
    whole = tables.TableStore(spark, str(tmp_path / "whole"))
    load.load_all(frames, whole, "day-1")
    expected = stored(whole)
    assert all(expected.values())

    store = tables.TableStore(spark, str(tmp_path / "tables"))
    replace = tables.TableStore._replace

    def fail(self, rows, path, **folders):
        if path.endswith(f"/{killed}"):  # after the stubs of the table's parents, before its rows
            raise RuntimeError("killed")
        replace(self, rows, path, **folders)

    monkeypatch.setattr(tables.TableStore, "_replace", fail)
    with pytest.raises(RuntimeError):
        load.load_all(frames, store, "day-1")
    monkeypatch.undo()
    for _ in range(2):
        rejected = load.load_all(frames, store, "day-1")
        assert stored(store) == expected and not any(r.count() for r in rejected.values())


def test_a_repeated_load_replaces_its_rows_only(spark, tmp_path):
    store = tables.TableStore(spark, str(tmp_path / "tables"))
    rows = lambda *r: spark.createDataFrame(list(r), TABLES["addresses"])
    store.load(rows(("m1", "from", "a@x"), ("m1", "from", "a@x")), "addresses", "1")
    store.load(rows(("m1", "from", "a@x"), ("m2", "to", "b@x")), "addresses", "2")
    assert store.read("addresses").count() == 4
    store.load(rows(("m3", "to", "c@x")), "addresses", "2")
    assert sorted(r.message_id for r in store.read("addresses").collect()) == ["m1", "m1", "m3"]
    assert sorted(r.message_id for r in store.read("messages").collect()) == ["m1", "m3"]  # the stub of m2 went with its row
    store.load(rows(), "addresses", "2")
    assert [r.message_id for r in store.read("messages").collect()] == ["m1"]
    for name in ("", "a/b", "a=b", "ä"):
        with pytest.raises(ValueError):
            store.load(rows(), "addresses", name)
    mail = spark.createDataFrame([("m1", "s")], "message_id string, subject string")
    assert store.load(mail, "messages", "3").count() == 0 == store.load(mail, "messages", "3").count()
    assert [r.reject_reason for r in store.load(mail, "messages", "4").collect()] == ["message_id is stored already"]
    assert [(r.message_id, r.subject) for r in store.read("messages").collect()] == [("m1", "s")]


def test_long_subject_loads(spark):
    row = spark.createDataFrame([("m", "s" * 300)], "message_id string, subject string")
    good, bad = tables.split_rejects(row, "messages")
    assert good.count() == 1 and bad.count() == 0


def test_rejects(spark):
    rows = [("m", "from", "a@x"), (None, "to", "a@x"), ("m", "reply", "a@x"), ("m", "to", "a" * 256), ("m", "to", " ")]
    good, bad = tables.split_rejects(spark.createDataFrame(rows, TABLES["addresses"]), "addresses")
    assert [tuple(r) for r in good.collect()] == [("m", "from", "a@x")]
    assert sorted(r.reject_reason for r in bad.collect()) == ["address is null", "address is too long", "address_type is unknown", "message_id is null"]
    assert set(KEYS) == set(TABLES)


def test_stub_parents_for_a_hot_key(spark):
    child = spark.createDataFrame([("hot",)] * 50 + [("p",), (None,), ("q",)], "message_id string")
    parents = spark.createDataFrame([("p", "s")], "message_id string, subject string")
    got = tables.ensure_parents(child, parents, "message_id").collect()
    assert sorted((r.message_id, r.subject or "") for r in got) == [("hot", ""), ("p", "s"), ("q", "")]


def test_null_normalise(spark):
    rows = spark.createDataFrame([(float("nan"), " ", 1), (1.5, "a ", None)], "d double, s string, i int")
    assert [tuple(r) for r in tables.null_normalise(rows).collect()] == [(None, None, 1), (1.5, "a ", None)]


def test_spread_only_small_sources(spark):
    assert tables.spread(spark.range(10).coalesce(1), "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(100, numPartitions=50)
    assert tables.spread(wide, "id") is wide


def test_jobs_end_to_end(spark, folder, tmp_path):
    points = Checkpoints(spark, str(tmp_path / "points"))
    model = naive_bayes.fit(
        spark.createDataFrame([("en", "hello there question"), ("de", "guten tag frage")], "l string, t string"),
        naive_bayes.letter_pairs(F.col("t")), "l",
    )
    mails = extract.extract(spark, folder, points, "corp", fill_html=True, languages=model)
    got = {r.message_id: r for r in mails.collect()}
    assert set(got) == {"a@x", "b@x", "c@x"} and got["a@x"].clean_text == "Hello there" and got["a@x"].language == "en"
    assert got["b@x"].response_time == 0.0 and got["b@x"].thread_id == "a@x" and not got["a@x"].is_internal
    assert points.pull("quarantined").count() == 1

    frames = transform.transform(mails, points, str(tmp_path / "vectors"), "desk@corp.example")
    store = tables.TableStore(spark, str(tmp_path / "tables"))
    load.load_all(frames, store)
    counts = {t: df.count() for t, df in store.read_all().items()}
    assert counts["messages"] == 3 and counts["addresses"] == 6 and counts["references"] == 1 and counts["summaries"] == 3
    assert {r.topic_id for r in store.read("messages").collect()} == {-1}
    assert read_store(spark, str(tmp_path / "vectors")).count() == 3


def test_stream(spark, folder, tmp_path):
    mails = incremental.mail_stream(spark, folder, files_per_batch=1)
    embed = lambda d: hashed_embeddings(d.withColumn("t", F.coalesce("plain_text_body", "html_body")), "message_id", "t", 16, idf=False)
    for _ in range(2):
        query = incremental.follow_embeddings(mails, str(tmp_path / "s"), embed, str(tmp_path / "ck"), str(tmp_path / "aside"))
        query.awaitTermination(120)
        assert query.exception() is None
    assert sorted(r.message_id for r in read_store(spark, str(tmp_path / "s")).collect()) == ["a@x", "b@x", "c@x"]
    assert [r.parse_error is None for r in spark.read.parquet(str(tmp_path / "aside")).collect()] == [False]
