"""Frame operators on small frames, with hot keys forced where the plan differs for them."""

import random
import re
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from postmill.operators import components, naive_bayes, relate, scoring, threads, topics
from postmill.operators.skew import lookup

MAILS = (
    "message_id string, previous_message_id string, references array<string>, subject_prefix string, submit_time timestamp_ntz"
)


def at(hour):
    return datetime(2024, 1, 1, hour)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def mails(spark):
    return spark.createDataFrame(
        [
            ("a", None, None, None, at(1)),
            ("b", "a", ["a"], "re:", at(3)),
            ("b2", "a", ["a"], "re:", at(0)),
            ("a", None, None, None, at(2)),
            ("c", "gone", ["gone", "a"], "re:", at(5)),
            ("d", "away", ["away"], "fwd:", at(6)),
            (None, None, None, None, at(7)),
        ],
        MAILS,
    )


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("floor", [1, 3, 1000])
@pytest.mark.parametrize("rows", [None, 200])
def test_lookup_is_a_join_for_any_skew(spark, how, floor, rows):
    keys = ["hot"] * 100 + [f"k{i}" for i in range(40)] + [None] * 30 + ["lost"] * 30
    facts = spark.createDataFrame(list(enumerate(keys)), "id int, key string")
    dim = spark.createDataFrame([("hot", 0), *[(f"k{i}", i) for i in range(0, 40, 2)]], "key string, value int")
    want = sorted(tuple(r) for r in facts.join(dim, "key", how).select("id", "key", *([] if how == "left_semi" else ["value"])).collect())
    got = lookup(facts, dim, "key", ["id"], how, floor, rows)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_threading(mails):
    got = {r.message_id: (r.first_in_thread, r.num_previous_messages, r.thread_id) for r in threads.with_threading(mails).collect()}
    assert got["a"] == (True, None, None) and got["b"] == (False, 1, "a") and got["c"] == (False, 2, "gone")


def test_missing_ids_skip_forwards(mails):
    assert [r[0] for r in threads.missing_message_ids(mails).collect()] == ["gone"]


@pytest.mark.parametrize("floor", [1, 1000])
def test_response_time(mails, floor):
    got = threads.with_response_time(mails, floor)
    assert got.columns == [*mails.columns, "response_time"]
    times = {r.message_id: r.response_time for r in got.collect()}
    assert times == {"a": None, "b": 7200.0, "b2": -3600.0, "c": None, "d": None, None: None}
    assert got.count() == 7


def test_dedupe_keeps_the_earliest_and_limits_before_the_shuffle(mails):
    kept = relate.dedupe(relate.drop_null_keys(mails))
    assert sorted((r.message_id, r.submit_time.hour) for r in kept.collect()) == [("a", 1), ("b", 3), ("b2", 0), ("c", 5), ("d", 6)]
    assert "WindowGroupLimit" in plan(kept) and "Partial" in plan(kept)


def test_address_rows(spark):
    rows = spark.createDataFrame(
        [("m", ["a@x"], ["b@x", " "], None, ["c@x"])],
        "message_id string, from_address array<string>, to_address array<string>, cc_address array<string>, bcc_address array<string>",
    )
    got = sorted(tuple(r) for r in relate.addresses(rows).collect())
    assert got == [("m", "bcc", "c@x"), ("m", "from", "a@x"), ("m", "to", "b@x")]


def test_spam_and_topics(spark):
    mails = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "message_id string, clean_text string")
    flags = spark.createDataFrame([("a", True), ("b", False)], "message_id string, is_spam boolean")
    assert [tuple(r) for r in relate.drop_spam(relate.with_defaults(mails), flags).select("message_id", "is_spam").collect()] == [("b", False)]
    found = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "message_id string, topic_id int")
    described = spark.createDataFrame([(0, "zero"), (1, "one"), (2, "two")], "topic_id int, topic_description string")
    assigned = relate.attach_topic(relate.with_defaults(mails), found)
    assert sorted(tuple(r) for r in relate.topic_dimension(assigned, described).collect()) == [(0, "zero"), (1, "one")]
    top = relate.top_topics(assigned, described, 1).collect()
    assert [(r.topic_id, r.messages, r.topic_description) for r in top] == [(0, 2, "zero")]


@pytest.mark.parametrize("floor", [1, 10_000])
def test_components(spark, floor):
    import hashlib
    import random

    ids = [hashlib.md5(str(i).encode()).hexdigest() for i in range(120)]
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(60)] + [(70, j) for j in range(71, 100)] + [rng.sample(range(100, 120), 2) for _ in range(8)]
    group = list(range(120))
    for a, b in pairs:
        old, new = group[a], group[b]
        group = [new if g == old else g for g in group]
    found = components.connected_components(spark.createDataFrame([(ids[a], ids[b]) for a, b in pairs], "src string, dst string"), floor)
    got = {r.id: r.component for r in found.collect()}
    assert set(got) == {ids[i] for p in pairs for i in p}
    for i in range(120):
        for j in range(i):
            if ids[i] in got and ids[j] in got:
                assert (got[ids[i]] == got[ids[j]]) == (group[i] == group[j])


# --- scoring ------------------------------------------------------------------------------------


def test_naive_bayes(spark):
    rows = [("en", "the cat and the dog"), ("en", "and the end"), ("de", "der hund und die katze"), ("de", "und das ende")]
    model = naive_bayes.fit(spark.createDataFrame(rows, "label string, text string"), naive_bayes.letter_pairs(F.col("text")), "label")
    docs = spark.createDataFrame([(1, "the hand and the hat"), (2, "die hunde und der"), (3, ""), (4, None)], "id int, text string")
    got = naive_bayes.classify(docs, "id", naive_bayes.letter_pairs(F.col("text")), model, "found")
    assert {r.id: r.found for r in got.collect()} == {1: "en", 2: "de", 3: "de", 4: "de"}


def test_vocabulary_is_whole(spark):
    words = [f"w{i}" for i in range(30_000)]
    model = naive_bayes.fit(spark.createDataFrame([("a", " ".join(words))], "label string, text string"), F.split("text", " "), "label")
    assert model.table.count() == 30_000


def test_language_scores_need_no_python(spark):
    rows = spark.createDataFrame([("a", "one"), ("b", "two")], "label string, text string")
    pairs = naive_bayes.letter_pairs(F.col("text"))
    scored = plan(naive_bayes.classify(rows.withColumn("id", F.lit(1)), "id", pairs, naive_bayes.fit(rows, pairs, "label"), "x"))
    assert "ArrowEvalPython" not in scored


def test_models_run_once_per_row_and_once_in_the_plan(spark):
    def factory():
        return lambda prompts: [p[::-1] for p in prompts]

    def async_factory():
        import asyncio

        async def answer(prompt):
            await asyncio.sleep(0.001 * (len(prompt) % 3))
            return prompt[::-1]

        return answer

    rows = spark.range(200).select("id", F.concat(F.lit("p"), "id").alias("prompt"))
    want = {i: f"p{i}"[::-1] for i in range(200)}
    answered = scoring.invoke_model(rows, "prompt", factory)
    assert {r.id: r.response for r in answered.collect()} == want
    concurrent = scoring.invoke_model_concurrently(rows, "prompt", async_factory, in_flight=4)
    assert {r.id: r.response for r in concurrent.collect()} == want
    filtered = answered.where(F.col("response") != "x").select("id", "response")
    assert plan(filtered).count("ArrowEvalPython") == 1


def test_models_are_asked_in_parts_of_bounded_bytes(spark):
    def factory():
        return lambda prompts: [f"{p[0]} {sum(map(len, prompts))}" for p in prompts]

    def async_factory():
        async def answer(prompt):
            return None if prompt.startswith("3") else prompt[:1]

        return answer

    text = F.when(F.col("id") != 5, F.rpad(F.col("id").cast("string"), 700_000, "é"))
    rows = spark.range(0, 9, 1, 1).select("id", text.alias("prompt"))
    got = {r.id: r.response for r in scoring.invoke_model(rows, "prompt", factory).collect()}
    assert got.pop(5) is None and {i: int(v[0]) for i, v in got.items()} == {i: i for i in got}
    assert len(got) == 8 and max(int(v[2:]) for v in got.values()) * 2 <= scoring.PART_BYTES
    got = {r.id: r.response for r in scoring.invoke_model_concurrently(rows, "prompt", async_factory).collect()}
    assert got == {i: None if i in (3, 5) else str(i) for i in range(9)}


def test_spam_responses(spark):
    cases = {"spam": True, "It is ham": False, "spam, not ham": False, "": False}
    rows = spark.createDataFrame([(k,) for k in cases], "r string").select("r", scoring.spam_from_response(F.col("r")).alias("s"))
    assert {r.r: r.s for r in rows.collect()} == cases


def test_label_scores(spark):
    rows = spark.createDataFrame([(1, "a credit card and a fraud report"), (2, "nothing here"), (3, None)], "id int, text string")
    found = sorted((r.id, r.product) for r in scoring.products(rows, "id", "text").collect() if r.product)
    # every label with one of its words present scores at least a half
    assert found == [(1, "Credit Card"), (1, "Credit Shield"), (1, "Supplementary Card")]
    categories = sorted((r.id, r.category or "") for r in scoring.categories(rows, "id", "text").collect())
    assert categories == [(1, "fraud_report"), (2, ""), (3, "")]
    shares = rows.select(scoring.sum_to_one(scoring.label_shares(F.col("text"), scoring.CATEGORIES)).alias("s")).first().s
    assert abs(sum(s.score for s in shares) - 1) < 1e-9


def test_entities_keep_messages_without_any(spark):
    rows = spark.createDataFrame([("a", "mail x.y@z.example"), ("b", "none")], "message_id string, clean_text string")
    got = sorted((r.message_id, r.entity_type or "", r.entity_value or "") for r in scoring.entities(rows, "message_id").collect())
    assert got == [("a", "Email Address", "x.y@z.example"), ("b", "", "")]

    def factory():
        return lambda prompts: ['{"Full Name": "Ann"}' if "x.y" in p else "no" for p in prompts]

    got = scoring.model_entities(rows, "message_id", "clean_text", factory).collect()
    assert sorted(str(tuple(r)) for r in got) == ["('a', 'Full Name', 'Ann')", "('b', None, None)"]


def test_summaries(spark):
    text = "Rare words here. The cat saw the cat. The cat! Other stuff? The dog and the cat."
    rows = spark.createDataFrame([(1, text), (2, ""), (3, None)], "id int, text string")
    got = {r.id: r.summary for r in scoring.summaries(rows, "id", "text").collect()}
    assert got == {1: "The cat saw the cat. The cat. The dog and the cat.", 2: "", 3: ""}


def test_summaries_shuffle_the_text_once(spark):
    rows = spark.range(50).select("id", F.lit("one two. three two.").alias("text"))
    done = scoring.summaries(rows, "id", "text")
    done.collect()
    final = plan(done).split("Initial Plan")[0]
    assert final.count("Exchange hashpartitioning") - final.count("ReusedExchange") <= 1


def test_summaries_have_partitions_by_the_size_of_the_texts(spark, monkeypatch):
    monkeypatch.setattr(scoring, "TASK_BYTES", 50, raising=False)
    rows = spark.range(50).select("id", F.lit("one two. three two.").alias("text"))
    assert "19), REPARTITION_BY_NUM" in plan(scoring.summaries(rows, "id", "text"))


# --- topics -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def assigned(spark):
    rows = [(f"m{t}_{i}", t, f"common word{t} and only{i}") for t, n in {-1: 8, 0: 7, 1: 4, 2: 5}.items() for i in range(n)]
    return spark.createDataFrame(rows, "message_id string, topic_id int, clean_text string")


@pytest.mark.parametrize("floor", [1, 1000])
def test_describable(assigned, floor):
    assert Counter(r.topic_id for r in topics.describable(assigned, floor=floor).collect()) == {0: 7, 2: 5}


def test_samples_are_limited_before_the_shuffle(assigned):
    samples = topics.topic_samples(assigned)
    assert Counter(r.topic_id for r in samples.collect()) == {0: 3, 2: 3}
    assert "WindowGroupLimit" in plan(samples)


@pytest.mark.parametrize("buckets", [1, 2, 40, 1000])
def test_word_frequencies_over_few_buckets(spark, monkeypatch, buckets):
    monkeypatch.setattr(topics, "BUCKETS", buckets, raising=False)
    monkeypatch.setattr(topics, "LEADERS", 1, raising=False)
    rng = random.Random(buckets)
    rows = [(t, " ".join(f"w{int(rng.random() ** 2 * 30):02}" for _ in range(n))) for t in (None, 1, 2) for n in (40, 0, 3, 200)]
    got = topics.word_frequencies(spark.createDataFrame([*rows, (3, None), (4, "one")], "topic_id int, clean_text string"))
    want = {(4, "one", 1)}
    for t in (None, 1, 2):
        for n, cap in topics.TOP_NGRAMS.items():
            grams = [" ".join(w[i : i + n]) for k, text in rows if k == t for w in [text.split()] for i in range(len(w) - n + 1)]
            want |= {(t, g, c) for g, c in sorted(Counter(grams).items(), key=lambda kv: (-kv[1], kv[0]))[:cap]}
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)


def test_word_frequencies_shuffle_buckets_only(spark):
    rows = spark.range(2000).select(F.lit(1).alias("topic_id"), F.concat_ws(" ", F.lit("aa bb cc dd ee ff gg hh ii jj kk ll mm"), F.col("id") + 10_000, F.col("id") + 20_000).alias("clean_text"))
    files = topics.word_frequencies(rows).inputFiles()
    assert 0 < spark.read.parquet(*files).count() < 1000  # of 12,000 distinct n-grams


def test_word_frequencies(assigned):
    got = topics.word_frequencies(assigned).collect()
    want = {}
    for t in (-1, 0, 1, 2):
        counts = [Counter(), Counter(), Counter()]
        for row in (r for r in assigned.collect() if r.topic_id == t):
            words = re.findall(r"\w\w+", row.clean_text.lower())
            for n in (1, 2, 3):
                counts[n - 1].update(" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
        for n, cap in topics.TOP_NGRAMS.items():
            for word, c in sorted(counts[n - 1].items(), key=lambda kv: (-kv[1], kv[0]))[:cap]:
                want[t, word] = c
    assert {(r.topic_id, r.word): r.frequency for r in got} == want


def test_descriptions(assigned):
    got = {r.topic_id: r.topic_description for r in topics.topic_descriptions(assigned).collect()}
    assert got == {0: "and, common, word0", 2: "and, common, word2"}

    def factory():
        return lambda prompts: [f" {p.count('Mail ')} mails " for p in prompts]

    got = {r.topic_id: r.topic_description for r in topics.model_topic_descriptions(assigned, factory).collect()}
    assert got == {0: "3 mails", 2: "3 mails"}


def test_lookup_spreads_a_hot_key_that_is_missing(spark):
    from postmill.operators.skew import lookup

    facts = spark.range(20_000).select("id", F.when(F.col("id") % 5 > 0, "lost").otherwise(F.col("id").cast("string")).alias("k"))
    dim = spark.range(20_000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        sizes = [r["count"] for r in lookup(facts, dim, "k", ["id"], floor=1000).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 20_000 and max(sizes) < 2 * 20_000 / len(sizes)
