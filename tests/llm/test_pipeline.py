"""The corpus pipeline on small fixtures, stage by stage."""

import collections
import random

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as P


def check_packed(rows, mixed):
    """Ids of every copy in full and in its own piece order, and sequences without gaps or overlaps."""
    tokenizer = Tokenizer.from_file(P.TOKENIZER)
    assert {r.position for r in rows} == {d.position for d in mixed}
    for d in mixed:
        own = sorted((r for r in rows if r.position == d.position), key=lambda r: r.piece)
        assert {(r.doc_id, r.copy) for r in own} == {(d.doc_id, d.copy)}
        assert [r.piece for r in own] == list(range(len(own)))
        assert all(len(r.ids) == 4 * r.length for r in own)
        ids = np.frombuffer(b"".join(r.ids for r in own), dtype="<u4").tolist()
        assert ids == [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 2]
    for s in {r.sequence_id for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024


def test_packed_sequences_hold_the_ids_of_every_copy(spark):
    """Copies of a doc_id, one of them with another text, stay apart and keep their content."""
    texts = ["one two three " * 20, "one two three " * 20, "another text", None, "", "long words " * 900, "日本 é " * 50]
    ids = [1, 1, 1, None, 4, 5, 6]
    rows = [(i, t, "en", "a", len(t or ""), n % 2, n) for n, (i, t) in enumerate(zip(ids, texts))]
    mixed = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, copy int, position long")
    check_packed(P.pack_sequences(spark, mixed, "").collect(), mixed.collect())


def test_all_stages_against_plain_python(spark, tmp_path):
    """run() on copies, secrets, nulls, a rejected text and a hot source: every stage's rows, then the packed corpus."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    fresh = [" ".join(word() for _ in range(40)) for _ in range(24)]
    secret = "password=abcdef12"
    texts = [*fresh, fresh[0], fresh[1], f"{fresh[2]} {word()}", " ".join(word() for _ in range(20)) + f" {secret} end", None, "", "few words", "same same same same same " * 30]
    rows = [(i, t, "en", "hot" if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in range(28)], "doc_id long, quality long").write.parquet(f"{tmp_path}/labels.parquet")

    docs = P.table(spark, str(tmp_path), "documents")
    rules = P.saved(P.quality_rules(spark, docs, str(tmp_path)))
    judged = {r.doc_id for r in rules.collect()}
    assert set(range(28)) <= judged and not judged & {28, 29, 30, 31}  # null, empty, short and repeating texts go

    deduped = P.saved(P.near_dedup(spark, rules, str(tmp_path)))
    assert {r.doc_id for r in deduped.collect()} == judged - {24, 25, 26}

    scanned = P.saved(P.secret_scan(spark, deduped, str(tmp_path)))
    want = {i: (texts[i].replace(secret, "[secret]"), rows[i][3]) for i in judged - {24, 25, 26}}
    got = scanned.collect()
    assert {r.doc_id: (r.text, r.source) for r in got} == want and all(r.n_chars == len(r.text) for r in got)

    mixed = P.saved(P.mix_sources(spark, scanned, str(tmp_path)))
    copies = mixed.collect()
    assert sorted(r.position for r in copies) == list(range(len(copies)))
    assert all((r.text, r.source) == want[r.doc_id] for r in copies)
    by_id = collections.defaultdict(list)
    for r in copies:
        by_id[r.doc_id].append(r.copy)
    assert copies and all(sorted(c) == list(range(len(c))) for c in by_id.values())

    check_packed(P.run(spark, str(tmp_path)).collect(), copies)
