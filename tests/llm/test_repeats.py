"""Windows, phrases and periodic runs: the operators and their queries on small fixtures, against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from postmill.llm import phrases, queries, runs, windows

SEPARATED = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 4))) for _ in range(80)]
    passage = " ".join(rng.choices(words, k=45))
    out = [None, "", " \t\n\v\f\r", "one", "Same same " * 9, "é ü 日本 " * 40, passage, passage.upper(), passage, f"x {passage}\n\ny", "w" * 3000]
    out += [" ".join(rng.choices(words, k=rng.randint(1, 150))) for _ in range(40)]
    out += [f"{' '.join(rng.choices(words, k=8))} {passage[:150]}; {passage[60:]}, {' '.join(rng.choices(words[:6], k=60))}" for _ in range(20)]
    return out + [" ".join(rng.choices(words[:2], k=900)), " ".join(words[:40] * 30), "a, b. " * 200, out[-1], out[-1]]


@pytest.fixture(scope="module")
def folder(spark, texts, tmp_path_factory):
    """A folder with ``documents``: some ids far apart, languages with nulls, an extra column."""
    path = str(tmp_path_factory.mktemp("repeats"))
    rows = [(i * 7 + 3, t, None if i % 5 == 0 else ("en", "de")[i % 2], "x") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, runs string").repartition(5).write.parquet(f"{path}/documents.parquet")
    return path


def rows_of(frame, *columns):
    return {r[0]: tuple(r[1:]) for r in frame.select(*columns).collect()}


# --- periodic runs ------------------------------------------------------------------------------


def slow_runs(words, least):
    """All runs, period by period; a run whose period is a multiple of a smaller one's inside it does not count."""
    out = []
    for q in range(1, len(words) // 2 + 1):
        same = [words[i] == words[i + q] for i in range(len(words) - q)] + [False]
        start = None
        for i, s in enumerate(same):
            if s and start is None:
                start = i
            if not s and start is not None:
                length = i - start + q
                if length >= 2 * q and not any(b <= start and b + n >= start + length for b, n, _ in out):
                    out.append((start, length, q))
                start = None
    return sorted((r for r in out if r[1] >= least), key=lambda r: (r[0], r[2]))


def periodic(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_runs_query(spark, folder, texts):
    want, changed = {}, 0
    for i, t in enumerate(texts):
        doc_id = i * 7 + 3
        plain = SEPARATED.findall(t or "")
        words = periodic(doc_id, plain)
        changed += words != plain
        found = slow_runs(words, 12)
        gone = {k for b, n, q in found for k in range(b + q, b + n)}
        top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        listed = sha("".join(f"{b},{n},{q}\n" for b, n, q in found))
        want[doc_id] = (len(found), *((top + (1000 * top[1] // top[2],)) if top else (None,) * 4), listed, sha(kept))
    names = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert rows_of(queries.op13_lyndon_runs(spark, folder), *names) == want
    assert changed > 2 and sum(w[0] > 0 for w in want.values()) > 8


def test_lyndon_array_and_runs_of_random_strings():
    rng = random.Random(2)
    for _ in range(400):
        n, k = rng.randint(1, 40), rng.randint(1, 4)
        s = [rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.4:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 2))
            s = [s[i] if i < a else s[a + (i - a) % p] for i in range(n)]
        longest = [next((j for j in range(i + 1, n) if s[j:] < s[i:]), n) - i for i in range(n)]
        assert runs.lyndon_array(s, k) == longest
        for least in (2, 12):
            assert [tuple(r) for r in runs.find_runs(np.array(s), least).tolist()] == slow_runs(s, least)


def test_runs_of_odd_tables(spark):
    schema = "doc_id long, text string, n_words string"
    rows = [(None, "a b " * 10, "x"), (4, "a b " * 10, "x"), (4, "a b " * 10, "x"), (5, None, None)]
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(spark.createDataFrame(rows, schema)).collect()]
    one = (20, [(0, 20, 2)], "a b")
    assert got == [(None, *one), (4, *one), (4, *one), (5, 0, [], "")]
    assert runs.periodic_runs(spark.createDataFrame([], schema)).count() == 0


# --- windows ------------------------------------------------------------------------------------


def without_windows(texts, size=20):
    seen, want = set(), []
    for t in texts:
        words = SEPARATED.findall(t or "")
        gone = set()
        for i in range(len(words) - size + 1):
            key = tuple(words[i : i + size])
            if key in seen:
                gone.update(range(i, i + size))
            seen.add(key)
        want.append((len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return want


def test_windows_query(spark, folder, texts):
    want = {i * 7 + 3: (n, gone, sha(kept)) for i, (n, gone, kept) in enumerate(without_windows(texts))}
    assert rows_of(queries.op11_count_min_windows(spark, folder), "doc_id", "n_words", "n_removed", "kept_sha256") == want
    assert sum(gone > 0 for _, gone, _ in want.values()) > 20


@pytest.mark.parametrize("columns", [8, 1 << 12])
def test_windows_of_many_slices(spark, texts, monkeypatch, columns):
    """Small slices and groups, and counters that most windows share: the sketch lets more pass, the result is the same."""
    monkeypatch.setattr(windows, "COLUMNS", columns)
    monkeypatch.setattr(windows, "SLICE", 2000)
    monkeypatch.setattr(windows, "FLUSH", 300)
    monkeypatch.setattr(windows, "SEGMENT", 10_000)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = rows_of(windows.remove_repeats(rows), "doc_id", "n_words", "n_removed", "kept")
    assert got == dict(enumerate(without_windows(texts)))


def test_windows_without_answers(spark, texts, monkeypatch):
    """Slices that were cut otherwise when they were counted find no answer; all their windows are compared."""
    monkeypatch.setattr(windows, "get", lambda *_: (_ for _ in ()).throw(FileNotFoundError()))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = rows_of(windows.remove_repeats(rows), "doc_id", "n_words", "n_removed", "kept")
    assert got == dict(enumerate(without_windows(texts)))


def test_windows_of_odd_tables(spark):
    schema = "doc_id long, text string, ord string, kept long"
    passage = " ".join(f"w{i}" for i in range(25))
    rows = [(None, passage, "x", 1), (4, f"{passage} a", "x", 1), (4, f"{passage} b", "x", 1), (4, f"{passage} b", "x", 1), (5, None, None, None), (6, "short", "", 1)]
    got = sorted(tuple(r) for r in windows.remove_repeats(spark.createDataFrame(rows, schema)).where("doc_id is not null").collect())
    assert got == [(4, 26, 0, f"{passage} a"), (4, 26, 25, "b"), (4, 26, 26, ""), (5, 0, 0, ""), (6, 1, 0, "short")]
    assert windows.remove_repeats(spark.createDataFrame(rows, schema)).where("doc_id is null").collect()[0].n_removed == 25
    for few in ([], [(i, "few words", "", 1) for i in range(8)], [(i, None, "", 1) for i in range(8)]):
        out = windows.remove_repeats(spark.createDataFrame(few, schema).repartition(3)).collect()
        assert len(out) == len(few) and not any(r.n_removed for r in out)


# --- phrases ------------------------------------------------------------------------------------


def slow_collocations(rows, least, top):
    counts = collections.defaultdict(collections.Counter)
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    counts[lang or "und"][tuple(w[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(a for g, a in f.items() if len(g) == 1)
        often = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        most = collections.Counter()
        for g, a in often.items():
            for m in range(2, len(g)):
                for i in range(len(g) - m + 1):
                    most[g[i : i + m]] = max(most[g[i : i + m]], a)
        found = []
        for g, a in often.items():
            if 100 * most[g] >= 80 * a:
                continue
            score, _, l, r = min((2000000 * a // (f[g[:k]] + f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize(("least", "top", "slices"), [(30, 2000, 1 << 22), (3, 25, 700)])
def test_collocations(spark, folder, texts, monkeypatch, least, top, slices):
    """The query's parameters, and small ones with small slices, groups and flushes; the top cuts through ties."""
    monkeypatch.setattr(phrases, "SLICE", slices)
    if top < 2000:
        monkeypatch.setattr(phrases, "FLUSH", 500)
        monkeypatch.setattr(phrases, "GROUP", 5000)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = sorted(tuple(r) for r in phrases.collocations(docs, least, top).select(*COLUMNS).collect())
    rows = [(r.text, r.lang) for r in docs.collect()]
    assert got == slow_collocations(rows, least, top) and len({g[0] for g in got}) == 3


def test_paths_are_compacted(spark):
    """Passages of their own words are one path each; where two share a stretch, paths end at its ends."""
    word = [f"w{i}" for i in range(40)]
    lines = [" ".join(word[:12])] * 5 + [" ".join(word[20:26] + word[6:10] + word[30:34])] * 4 + ["en es de"] * 3
    graph = phrases.build(spark.createDataFrame([(t, "en") for t in lines], "text string, lang string"), 3)
    name = {r.id: r.word for r in graph.words.collect()}
    got = sorted((r.a, " ".join(name[i] for i in r.words)) for r in phrases.paths(graph).collect())
    # the shared stretch w6..w9 is one edge of weight 9
    want = [(4, word[20:26] + word[6:9]), (4, word[7:10] + word[30:34]), (5, word[:9]), (5, word[7:12]), (9, word[6:10])]
    assert got == sorted((a, " ".join(w)) for a, w in want)


def test_phrases_of_odd_tables(spark):
    schema = "text string, lang string, w1 string, n long, word long"
    docs = spark.createDataFrame([], schema)
    assert phrases.collocations(docs).count() == 0
    docs = spark.createDataFrame([(None, None, "x", 1, 1), ("", "en", "x", 1, 1), ("only once", None, "x", 1, 1)], schema)
    assert phrases.collocations(docs).count() == 0
    # words of one language are the names of another
    docs = spark.createDataFrame([("en es", "es", "x", 1, 1), ("es en", "en", "x", 1, 1)] * 2 + [("long " * 9000, None, "x", 1, 1)], schema)
    got = sorted(tuple(r) for r in phrases.collocations(docs, 2).select(*COLUMNS).collect())
    assert got == slow_collocations([(r.text, r.lang) for r in docs.collect()], 2, 2000)


def test_a_slice_of_text_takes_little_memory():
    import tracemalloc

    import pyarrow as pa

    from postmill.llm import phrases

    texts = ["some words of a text, repeated. " * 8000] * 32  # 8 MB
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["en"] * 32)], names=["text", "lang"])
    tracemalloc.start()
    n = sum(len(tokens.key) for tokens in phrases._slices(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 32 * 8000 * 6 and peak < 120 << 20, peak >> 20
