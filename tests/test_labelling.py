"""Learned labels against plain Python."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postmill.operators import labelling, naive_bayes, scoring

LABELS = ["card", "loan", "fraud", "none"]


def texts(n):
    r = random.Random(3)
    topic = {"card": "card limit pin chip", "loan": "loan rate term house", "fraud": "stolen fraud block police"}
    out = []
    for i in range(n):
        marks = [t for t in topic if r.random() < 0.4]
        words = [r.choice(topic[m].split()) for m in marks for _ in range(4)] + [r.choice("please thanks hello desk today".split()) for _ in range(5)]
        r.shuffle(words)
        out.append((i, " ".join(words), marks))
    return [*out, (n, None, []), (n + 1, "", None), (n + 2, "Card, CARD card!", ["card"]), (n + 3, "unheard words", None)]


def words(text):
    return set(re.findall(r"\w{2,}", (text or "").lower()))


def plain(examples, docs):
    """Per document the probability of each label."""
    known = [(words(t), m) for _, t, m in examples if m is not None]
    out = {i: [] for i, _, _ in docs}
    for label in LABELS:
        own = Counter(w for ws, m in known if label in m for w in ws)
        rest = Counter(w for ws, m in known if label not in m for w in ws)
        vocabulary = own.keys() | rest.keys()
        totals = [sum(x.values()) + len(vocabulary) for x in (own, rest)]
        yes = sum(label in m for _, m in known)
        for i, text, _ in docs:
            odds = math.log((yes + 1) / (len(known) - yes + 1))
            odds += sum(math.log((own[w] + 1) / totals[0] * totals[1] / (rest[w] + 1)) for w in words(text) & vocabulary)
            out[i].append(1 / (1 + math.exp(-odds)))
    return out


def test_scores_equal_plain_python(spark):
    rows = texts(120)
    df = spark.createDataFrame(rows, "id int, text string, marks array<string>")
    model = labelling.fit(df, "text", "marks", LABELS)
    want = plain(rows, rows)
    got = {r.id: r.scores for r in labelling.scored(df, "id", "text", model).collect()}
    assert got.keys() == want.keys()
    for i, scores in got.items():
        assert [s.label for s in scores] == LABELS
        assert [s.score for s in scores] == pytest.approx(want[i], abs=1e-4)
    above = lambda scaled: {(i, v) for i, p in want.items() for v in ([v for v, s in zip(LABELS, p, strict=True) if s / scaled(p) > 0.09] or [None])}
    assert {tuple(r) for r in labelling.products(df, "id", "text", model).collect()} == above(lambda p: 1)
    assert {tuple(r) for r in labelling.categories(df, "id", "text", model).collect()} == above(sum)


def test_held_out_labels(spark):
    rows = [r for r in texts(600) if r[2] is not None]
    df = spark.createDataFrame(rows, "id int, text string, marks array<string>")
    model = labelling.fit(df.where("id < 300"), "text", "marks", LABELS)
    found = labelling.products(df.where("id >= 300 and text is not null"), "id", "text", model, 0.5).groupBy("id").agg(F.collect_list("product").alias("p"))
    right = [sorted(r.p) == sorted(r.marks) for r in found.join(df, "id").collect()]
    assert len(right) > 250 and sum(right) / len(right) > 0.98


def test_labels_without_examples(spark):
    df = spark.createDataFrame([(1, "a word", ["x"]), (2, None, None)], "id int, text string, marks array<string>")
    model = labelling.fit(df, "text", "marks", ["x", "y"])
    assert model.priors == [round(math.log(2) * 1e6), -round(math.log(2) * 1e6)]
    assert labelling.scored(df.limit(0), "id", "text", model).count() == 0
    for labels in ([], ["x", "x"], [str(i) for i in range(501)]):
        with pytest.raises(ValueError):
            labelling.fit(df, "text", "marks", labels)
    with pytest.raises(ValueError):
        labelling.fit(df.where("id = 2"), "text", "marks", ["x"])


@pytest.mark.parametrize("most", [4, 40])
def test_rare_words_are_looked_up_and_common_ones_are_not_shuffled(spark, monkeypatch, most):
    monkeypatch.setattr(naive_bayes, "MAX_WEIGHTS", most)
    rows = texts(120)
    df = spark.createDataFrame(rows, "id int, text string, marks array<string>")
    model = labelling.fit(df, "text", "marks", LABELS)
    assert int(most > 4) <= model.table.where(model.common).count() <= most // len(LABELS)
    want = plain(rows, rows)
    got = {r.id: [s.score for s in r.scores] for r in labelling.scored(df, "id", "text", model).collect()}
    assert got.keys() == want.keys()
    assert all(got[i] == pytest.approx(want[i], abs=1e-4) for i in want)
    spam = df.select("id", "text", F.array_contains("marks", "fraud").alias("is_spam"))
    monkeypatch.setattr(naive_bayes, "MAX_WEIGHTS", most // 2)  # two labels
    few = scoring.fit_spam(spam, "text", "is_spam")
    monkeypatch.setattr(naive_bayes, "MAX_WEIGHTS", 1000)
    every = scoring.fit_spam(spam, "text", "is_spam")
    assert few.common is not None and every.common is None
    flags = [sorted(scoring.spam_flags(spam, "id", "text", m).collect()) for m in (few, every)]
    assert flags[0] == flags[1] and len(flags[0]) == len(rows)
    plan = scoring.spam_flags(spam, "id", "text", every)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # one row per document
