"""Missing mails fetched from a second source, the source by day, and counters inline with parsing."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from postmill.operators import naive_bayes
from postmill.plans import extract
from postmill.schemas import MAIL
from postmill.sources import select
from postmill.sources.checkpoints import Checkpoints
from postmill.sources.completion import complete

SHAPE = "message_id string, subject_prefix string, previous_message_id string, references array<string>, submit_time timestamp_ntz, plain_text_body string"


def mail(key, previous=None, references=None, prefix=None, day=1, body=""):
    return (key, prefix, previous, references, datetime(2024, 1, day), body)


SERVER = [
    mail("b", "c", body="one hop"), mail("c", "d", ["e", None, "d"]), mail("d", "a"), mail("e", "lost", prefix="re:"),
    mail("f", "g"), mail("g", "f"),  # a circle
    mail("h", "i", prefix="fw:"), mail("i"),  # nobody asks for i: h was forwarded
    mail("b", "j", day=2, body="copy"), mail("j"),  # the copy's reference counts, the copy does not come
    mail("a", "x"), mail("new", "k", day=9), mail(None, "q", day=9), mail("k"), mail("other"),
]
ARCHIVE = [mail("a", "b"), mail("a", "b"), mail("z", "f", ["h", "gone"]), mail("y", "other", prefix="re: fw:"), mail(None, None)]


def reached(archive, server, start=()):
    """(found ids, missing ids) by plain search."""
    known = {m[0] for m in [*archive, *start]}
    todo, asked = [*archive, *start], set()
    while todo:
        ids = {i for m in todo if "fw" not in (m[1] or "") for i in [m[2], *(m[3] or [])] if i} - known - asked
        asked |= ids
        todo = [m for m in server if m[0] in ids]
    held = {m[0] for m in server}
    return asked & held, asked - held


def test_chains_are_complete(spark):
    archive, server = spark.createDataFrame(ARCHIVE, SHAPE), spark.createDataFrame(SERVER, SHAPE)
    done = complete(archive, server)
    got = {r.message_id: r for r in done.added.collect()}
    found, missing = reached(ARCHIVE, SERVER)
    assert found == {"b", "c", "d", "e", "f", "g", "h", "j"} and missing == {"lost", "gone"}
    assert set(got) == found and done.added.count() == len(got) and done.added.columns == server.columns
    assert got["b"].plain_text_body == "one hop"
    assert {r.message_id: r["round"] for r in done.not_found.collect()} == {"gone": 0, "lost": 3}
    assert done.rounds == 4  # a → b → c → e → lost


def test_since_brings_mails_that_ask_too(spark):
    done = complete(spark.createDataFrame(ARCHIVE, SHAPE), spark.createDataFrame(SERVER, SHAPE), date(2024, 1, 9))
    recent = [m for m in SERVER if m[4].day == 9]
    found, missing = reached(ARCHIVE, SERVER, recent)
    assert sorted(r.message_id or "" for r in done.added.collect()) == sorted(["", "new", *found]) and "k" in found
    assert {r.message_id for r in done.not_found.collect()} == missing and "q" in missing


@pytest.mark.parametrize("archive, server", [([], SERVER), (ARCHIVE, []), ([], [])])
def test_empty_sources(spark, archive, server):
    done = complete(spark.createDataFrame(archive, SHAPE), spark.createDataFrame(server, SHAPE))
    found, missing = reached(archive, server)
    assert {r.message_id for r in done.added.collect()} == found and {r.message_id for r in done.not_found.collect()} == missing


def test_a_long_chain_on_a_hot_mail(spark):
    archive = [mail(f"m{i}", "c0") for i in range(300)]
    server = [mail(f"c{i}", f"c{i + 1}") for i in range(8)] + [mail("c3", "c4")] * 200
    done = complete(spark.createDataFrame(archive, SHAPE), spark.createDataFrame(server, SHAPE))
    assert sorted(r.message_id for r in done.added.collect()) == [f"c{i}" for i in range(8)] and done.rounds == 9
    assert [r.message_id for r in done.not_found.collect()] == ["c8"]


def test_new_ids_filter_the_servers_scan(spark, tmp_path):
    """Past the broadcast limit, a Bloom filter of the new ids reaches the server's scan before its shuffle."""
    spark.createDataFrame(SERVER, SHAPE).write.parquet(str(tmp_path / "server"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        done = complete(spark.createDataFrame(ARCHIVE, SHAPE), spark.read.parquet(str(tmp_path / "server")))
        plan = done.added._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" in plan
        assert {r.message_id for r in done.added.collect()} == reached(ARCHIVE, SERVER)[0]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_source_by_day(spark, tmp_path):
    path = str(tmp_path / "server")
    rows = [mail(str(i), day=1 + i % 5) for i in range(50)] + [("none", None, None, None, None, "")]
    select.write_by_day(spark.createDataFrame(rows, SHAPE), path)
    chosen = select.read_by_day(spark, path, datetime(2024, 1, 4, 18))
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "day" not in chosen.columns
    assert sorted(r.message_id for r in chosen.collect()) == sorted(str(i) for i in range(50) if 1 + i % 5 >= 4)
    assert sorted(map(tuple, select.read_by_day(spark, path).collect())) == sorted(rows, key=lambda r: r[0])


def test_a_day_of_one_third_of_all_mails_is_spread(spark, tmp_path):
    rows = spark.range(3000).selectExpr("cast(id as string) message_id", "timestamp_ntz'2024-01-01 05:00:00' + make_dt_interval(int(if(id % 3 = 0, 0, id % 20))) submit_time")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as for partitions too large to merge
    try:
        select.write_by_day(rows.repartition(8), str(tmp_path / "d"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "d" / "day=2024-01-01").glob("*.parquet"))) >= 2
    assert select.read_by_day(spark, str(tmp_path / "d")).count() == 3000


def test_extract_with_a_server(spark, tmp_path):
    head = "From: a@x\r\nReceived: by d; Fri, 1 Sep 2023 13:00:05 +0300\r\nDate: Fri, 1 Sep 2023 13:00:00 +0300\r\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.eml").write_text(head + "Message-ID: <a@x>\r\nIn-Reply-To: <b@x>\r\n\r\nHello there")
    (tmp_path / "in" / "broken.eml").write_text("Subject: no sender\r\n\r\ntext")
    one = lambda key, previous: (key, "s", None, datetime(2023, 9, 1, 9), None, None, "Older text", "n", ["b@x"], [], [], [], previous, None)
    server = spark.createDataFrame([one("b@x", "c@x"), one("c@x", "lost@x"), one("a@x", None)], MAIL).withColumn("extra", F.lit(1))
    points = Checkpoints(spark, str(tmp_path / "points"))
    mails = {r.message_id: r for r in extract.extract(spark, str(tmp_path / "in"), points, "corp", server=server).collect()}
    assert set(mails) == {"a@x", "b@x", "c@x"} and mails["a@x"].response_time == 3600.0
    assert [r.message_id for r in points.pull("not_found").collect()] == ["lost@x"] and points.pull("fetched").count() == 2
    assert points.pull("ingested").first().asDict() == {"read": 2, "accepted": 1, "set_aside": 1}


def test_each_mail_has_the_language_of_its_own_text(spark):
    pairs = spark.createDataFrame([("en", "hello there question"), ("de", "guten tag frage")], "l string, t string")
    model = naive_bayes.fit(pairs, naive_bayes.letter_pairs(F.col("t")), "l")
    rows = [("a", "hello there"), ("a", "guten tag"), (None, "guten tag"), (None, "hello there"), ("b", None), ("c", "hello there")]
    mails = spark.createDataFrame([(k, datetime(2024, 1, 1), t) for k, t in rows], "message_id string, submit_time timestamp_ntz, clean_text string")
    got = extract.with_language(mails, model)
    assert got.columns == [*mails.columns, "language"]
    expected = [(k, t, {"h": "en", "g": "de"}[t[0]] if t else None) for k, t in rows]
    assert sorted(map(str, got.select("message_id", "clean_text", "language").collect())) == sorted(map(str, spark.createDataFrame(expected, "message_id string, clean_text string, language string").collect()))
