"""Columns named like results or helpers, and the forest's verdict against plain numpy."""

import numpy as np
from pyspark.sql import functions as F

from postmill.llm import mixing, quality

HELPERS = ("cdf", "_source", "_key", "k", "mass", "_bytes", "_weight", "_place", "_block", "_mix_cdf", "_mix_source", "_mix_place", "_mix_block", "_mix_draws", "_mix_first", "_before", "_rank", "rate", "copy", "position")


def test_mixing_with_clashing_names(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2], f"text {i}") for i in range(40)] + [(None, None, None)], "doc_id long, source string, text string")
    plain = mixing.mix(docs, {"a": 3.0, "b": 1.0}, budget=2.0)
    mixed = mixing.mix(docs.withColumns({n: F.lit("x") for n in HELPERS}), {"a": 3.0, "b": 1.0}, budget=2.0)
    rows = lambda df: sorted(map(tuple, df.select("position", "doc_id", "source", "text", "rate", "n_copies", "copy").collect()))
    assert rows(mixed) == rows(plain) and len(rows(plain)) > 20
    assert {"cdf", "_source", "_place", "_key"} <= set(mixed.columns)  # what is no helper's name stays
    assert mixed.select("cdf").distinct().collect() == [("x",)]


def test_mixing_rates_beyond_one_draw(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 100)
    docs = spark.createDataFrame([(i, "few", "ab") for i in range(60)] + [(100 + i, "many", "word " * 200) for i in range(60)], "doc_id long, source string, text string")
    rate = {r["_source"]: r["rate"] for r in mixing.rates(docs, {"few": 1.0, "many": 1.0}).collect()}
    tables = mixing.poisson_tables(mixing.rates(docs, {"few": 1.0, "many": 1.0})).collect()
    assert rate["=few"] > 200 and all(len(t.cdf) <= 200 and abs(t.cdf[-1] - 1) < 1e-9 for t in tables)
    rows = mixing.mix(docs, {"few": 1.0, "many": 1.0}).select("doc_id", "n_copies", "copy", "position").collect()
    assert sorted(r.position for r in rows) == list(range(len(rows)))
    copies = {}
    for r in rows:
        copies.setdefault((r.doc_id, r.n_copies), []).append(r.copy)
    assert all(sorted(c) == list(range(n)) for (_, n), c in copies.items())
    few = [n for (i, n) in copies if i < 100]
    assert len(few) == 60 and abs(np.mean(few) - rate["=few"]) < 5 * np.sqrt(rate["=few"] / 60)
    assert 0.5 < np.var(few) / rate["=few"] < 2


def test_threshold_uses_both_labels():
    good = np.linspace(0.3, 0.5, 2000)
    assert quality.threshold(good, np.array([0.2, 0.6, 0.9])) == (good[-3] + 0.6) / 2
    assert quality.threshold(good, np.array([0.2])) == good[-3] + 1e-9
    assert quality.threshold(np.array([0.4]), np.array([])) == 0.4 + 1e-9


def test_symbols_are_counted(spark):
    texts = ["#*$%&|<>", "a # b ** c", "", None, "é€£@!", "<x> " * 500, "|\n|\n&"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_symbols for r in quality.statistics(docs).collect()}
    assert got == {i: sum(ch in "#*$%&|<>" for ch in t or "") for i, t in enumerate(texts)}


def test_forest_verdict(spark):
    random = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    good = [" ".join(random.choice(words, 60)) for _ in range(120)]
    bad = ["#$%& " * 30 + " ".join(random.choice(words, 20)) for _ in range(12)]
    texts = [*good, *bad, "too short", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = docs.select("doc_id", F.when(F.col("doc_id") < len(good), 1).otherwise(0).alias("quality"))
    forest = quality.fit(docs, labels)
    got = {r.doc_id: r for r in quality.judge(docs, forest).collect()}
    stats = quality.statistics(docs).orderBy("doc_id").toPandas()
    score = forest.score(quality.features({n: stats[n].to_numpy() for n in (*quality.COUNTS, *quality.MORE)}))
    failed = np.array([len((t or "").split()) < 10 for t in texts]) | (100 * stats["n_repeat_words"] > 20 * stats["n_words"]).to_numpy()
    assert [got[i].base_failed for i in range(len(texts))] == failed.tolist()
    assert np.allclose([got[i].anomaly for i in range(len(texts))], score)
    kept = ~failed & (score <= np.sort(score[: len(good)][~failed[: len(good)]]).max() + 1e-9)  # fewer than 1,000 good rows: none is rejected
    assert [got[i].kept for i in range(len(texts))] == kept.tolist()
    assert kept[: len(good)].all() and not kept[len(good) :].any()
    clashing = quality.judge(docs.withColumns({"kept": F.lit(1), "n_words": F.lit(1)}), forest, ("doc_id", "kept", "n_words", "anomaly"))
    assert {(r.doc_id, r.kept, r.n_words) for r in clashing.collect()} == {(i, r.kept, r.n_words) for i, r in got.items()}
    assert quality.judge(docs.limit(0), forest).count() == 0
    assert quality.fit(docs.limit(0), labels).threshold >= quality.fit(docs, labels.limit(0)).threshold


def test_verdict_takes_one_python_step(spark):
    docs = spark.createDataFrame([(i, f"some {i} text " * 9) for i in range(20)], "doc_id long, text string")
    judged = quality.judge(docs, quality.fit(docs, docs.select("doc_id", F.lit(1).alias("quality"))), ["doc_id", "text"])
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1  # a second one would keep a second worker for every core
    assert {(r.doc_id, r.text, r.n_words) for r in judged.collect()} == {(i, f"some {i} text " * 9, 27) for i in range(20)}
