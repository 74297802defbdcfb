"""Phrase collocations from a weighted de Bruijn graph of words: longest grams counted, shorter counts from node flow."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.arrays import get, new_folder, put
from postmill.llm.common import _LOWER, blocks_for, give_back, mix, numbered, powers, prefix_hash, saved, slices_of, spread_lookup, text_or_empty
from postmill.llm.ngrams import _find, _ranges

SLICE = 1 << 20  # bytes of text that a worker handles at once; its arrays take some sixty times as much
GROUP = 16 << 20  # bytes of text whose grams one group adds up
FLUSH = 1_000_000  # grams, distinct in their slices, that a worker gathers before it passes them on
WORDS = 1 << 20  # frequent words per file of the dictionary
NO_LANG = "und"

_HARD = np.zeros(256, dtype=bool)  # ends a piece
_HARD[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_SOFT = np.zeros(256, dtype=bool)  # ends a word
_SOFT[[0x20, 0x09]] = True
_KEY = ["w1", "w2", "w3", "w4"]
_U32 = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)

# --- words --------------------------------------------------------------------------------------


def _cut(raw: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """(text, part): texts beyond a slice are cut where pieces end, which changes no count."""
    for k, text in enumerate(raw):
        while len(text) > SLICE:
            ends = np.flatnonzero(_HARD[np.frombuffer(text, dtype=np.uint8)[:SLICE]])
            if not len(ends):
                break
            yield k, text[: ends[-1]]
            text = text[ends[-1] + 1 :]
        yield k, text


class Tokens:
    """The words of a slice, lower-cased: hashes (with the language), pieces, and the bytes to read them from."""

    def __init__(self, raw: list[bytes], langs: list[str]) -> None:
        parts = list(_cut(raw))
        self.langs = sorted(set(langs))
        number = {lang: i for i, lang in enumerate(self.langs)}
        self.data = _LOWER[np.frombuffer(b"\n".join([p for _, p in parts] + [b""]), dtype=np.uint8)]
        hard = _HARD[self.data]
        inside = np.concatenate(([False], ~(hard | _SOFT[self.data]), [False]))
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = edge[::2], edge[1::2]
        self.piece = np.cumsum(hard)[self.start] if len(self.start) else self.start
        begin = np.cumsum([0] + [len(p) + 1 for _, p in parts])[:-1]
        part = np.searchsorted(begin, self.start, "right") - 1
        self.lang = np.array([number[langs[k]] for k, _ in parts], dtype=np.int64)[part]
        sums, (_, down) = prefix_hash(self.data), powers(len(self.data) + 1)
        plain = mix((sums[self.end] - sums[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))
        self.key = mix(plain ^ np.array([_lang_hash(lang) for lang in self.langs], dtype=np.uint64)[self.lang])


def _lang_hash(lang: str) -> np.uint64:
    """A hash of the language unlike that of the word with the same letters, as the two are combined symmetrically."""
    data = np.frombuffer(lang.encode(), dtype=np.uint8)
    return mix(mix(prefix_hash(data)[-1:] + np.uint64(len(data))) + np.uint64(0x510E527FADE682D1))[0]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Tokens]:
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for part, raw in slices_of(batch.column(0), SLICE):
            tokens = Tokens(raw, langs[part])
            if len(tokens.key):
                yield tokens


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(text_or_empty().alias("text"), F.coalesce(F.col("lang"), F.lit(NO_LANG)).alias("lang"))


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of every word: counted per slice in the workers, then added up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tokens in _slices(batches):
            _, first, n = np.unique(tokens.key, return_index=True, return_counts=True)
            data = tokens.data.tobytes()
            words = [data[a:b] for a, b in zip(tokens.start[first].tolist(), tokens.end[first].tolist(), strict=True)]
            columns = [pa.array([tokens.langs[k] for k in tokens.lang[first]]), pa.array(words, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "n"])

    return _texts(docs).mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


@dataclass
class Dictionary:
    """Ids (from 1) of the frequent words: sorted hashes in files of the shared folder, opened where they are asked for."""

    folder: str
    bits: int

    def ids(self, keys: np.ndarray) -> np.ndarray:
        """Ids of the words with these hashes; 0 for all others."""
        own, inverse = np.unique(keys, return_inverse=True)
        out = np.zeros(len(own), dtype=np.uint64)
        for bucket, (a, b) in _ranges(own >> np.uint64(64 - self.bits)):
            try:
                known = get(self.folder, f"keys-{bucket}", "<u8")
            except FileNotFoundError:  # no frequent word has such a hash
                continue
            at, hit = _find(known, own[a:b])
            out[a:b][hit] = get(self.folder, f"ids-{bucket}", "<u4")[at[hit]]
        return out[inverse]


def _write_dictionary(frequent: DataFrame, n: int) -> Dictionary:
    out = Dictionary(new_folder(frequent.sparkSession, "words"), max(3, int(np.ceil(np.log2(max(1, n / WORDS))))))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [
                mix(mix(prefix_hash(np.frombuffer(w, dtype=np.uint8))[-1:] + np.uint64(len(w))) ^ _lang_hash(lang))[0]
                for w, lang in zip((w.encode() for w in batch.column(1).to_pylist()), batch.column(0).to_pylist(), strict=True)
            ]
            bucket = [int(k >> np.uint64(64 - out.bits)) for k in keys]
            columns = [pa.array(bucket, pa.int32()), pa.array(np.array(keys, dtype=np.uint64).view(np.int64)), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "key", "id"])

    def write(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        keys, ids = frame["key"].to_numpy().view(np.uint64), frame["id"].to_numpy()
        order = np.argsort(keys)
        put(out.folder, f"keys-{key[0]}", keys[order].astype("<u8"))
        put(out.folder, f"ids-{key[0]}", ids[order].astype("<u4"))
        return pd.DataFrame({"bucket": [key[0]]})

    rows = frequent.select("lang", "word", "id").mapInArrow(keyed, "bucket int, key long, id long")
    rows.groupBy("bucket").applyInPandas(write, "bucket int").agg(F.count("bucket")).first()
    return out


# --- graph --------------------------------------------------------------------------------------


def _added(a: np.ndarray, b: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of equal grams (a, b) added up, in their order."""
    order = np.lexsort((b, a))
    a, b, counts = a[order], b[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    return a[first], b[first], np.add.reduceat(counts, first)


def _packed(values: np.ndarray, dtype: str) -> bytes:
    """Numbers with all low bytes first, which compress where the high ones are alike."""
    width = np.dtype(dtype).itemsize
    return values.astype(dtype).view(np.uint8).reshape(-1, width).T.tobytes()


def _unpacked(data: list[bytes], dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    parts = [np.ascontiguousarray(np.frombuffer(d, dtype=np.uint8).reshape(width, -1).T).view(dtype).ravel() for d in data]
    return np.concatenate(parts)


_RUNS = "bucket int, first binary, rest binary, counts binary"


def _as_runs(a: np.ndarray, b: np.ndarray, counts: np.ndarray, bucket: np.ndarray) -> list[tuple[int, bytes, bytes, bytes]]:
    order = np.argsort(bucket, kind="stable")
    return [(k, _packed(a[own], "<u8"), _packed(b[own], "<u8"), _packed(counts[own], "<u4")) for k, (i, j) in _ranges(bucket[order]) for own in [order[i:j]]]


def _count_grams(docs: DataFrame, words: Dictionary, buckets: int) -> DataFrame:
    """Every word starts one gram: four words, or what is left of its piece. Rare words end pieces, too.

    Grams are added up in the workers and dealt by their first three words, the node where they start.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def rows() -> pa.RecordBatch:
            a, b, counts = _added(*(np.concatenate(x) for x in zip(*pending, strict=True)))
            pending.clear()
            runs = _as_runs(a, b, counts, (mix(a ^ mix(b >> _U32)) % np.uint64(buckets)).astype(np.int64))
            give_back()
            columns = [pa.array([r[i] for r in runs], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary(), pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, names=["bucket", "first", "rest", "counts"])

        for tokens in _slices(batches):
            ids = words.ids(tokens.key)
            next_ = np.zeros((4, len(ids) + 4), dtype=np.uint64)
            next_[0, : len(ids)] = ids
            joined = np.concatenate((tokens.piece[1:] == tokens.piece[:-1], [False] * 4)) if len(ids) else np.zeros(4, dtype=bool)
            for k in range(1, 4):  # the k-th word after one, 0 once the piece or the run of frequent words has ended
                n = len(ids)
                next_[k, :n] = np.where(joined[k - 1 : k - 1 + n] & (next_[k - 1, :n] > 0), next_[0, k : k + n], 0)
            w = next_[:, : len(ids)][:, (next_[0, : len(ids)] > 0) & (next_[1, : len(ids)] > 0)]
            if w.shape[1]:
                a, b = (w[0] << _U32) | w[1], (w[2] << _U32) | w[3]
                pending.append(_added(a, b, np.ones(len(a), dtype=np.int64)))
            if sum(len(p[0]) for p in pending) >= FLUSH:
                yield rows()
        if pending:
            yield rows()

    return _texts(docs).mapInArrow(count, _RUNS)


@dataclass
class Graph:
    """Phrases of frequent words that occur ``least`` times or more; ids of words beyond a phrase's length are 0."""

    words: DataFrame  # id, lang, word, n
    totals: DataFrame  # lang, n: all words of a language
    counts: DataFrame  # w1..w4, a: edges (four words), nodes (three), pairs, and words themselves
    least: int

    def of_length(self, n: int) -> DataFrame:
        own = self.counts.where(F.col(f"w{n}") > 0)
        return own if n == 4 else own.where(F.col(f"w{n + 1}") == 0)


def build(docs: DataFrame, least: int = 30) -> Graph:
    """Count words, then the graph's edges between overlapping nodes of three words; shorter counts follow from flow.

    A node's count is the weight of the edges that leave it plus the number of pieces that end with it, which
    are counted as grams of three words; that of a pair is the flow of the nodes that begin with it
    plus the pieces that end with the pair. A phrase with a rare word (fewer than ``least`` times) is never
    frequent, so rare words end pieces, and the words' own counts are taken before.

    Edges are added up in groups by node, pairs in groups by pair, both from packed runs: a
    frequent gram costs one entry per ``FLUSH`` grams of a task. There are as many partitions as groups,
    so that a task's share does not grow with the text.
    """
    spark = docs.sparkSession
    n_bytes = docs.agg(F.sum(F.octet_length(text_or_empty()))).first()[0] or 0
    buckets = n_bytes // GROUP + 8
    words = saved(count_words(docs))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.where(F.col("n") >= least)
    n = frequent.count()
    if n >= 2**32 - 1:
        raise ValueError("more than four billion frequent words")
    blocks = blocks_for(n, 100_000)
    placed = frequent.withColumns({"_all": F.lit(0), "_block": F.pmod(F.xxhash64("lang", "word"), F.lit(blocks))})
    frequent = saved(numbered(placed, ["_all"], "_block", ["lang", "word"], "_id").select((F.col("_id") + 1).alias("id"), "lang", "word", "n"))
    grams = _count_grams(docs, _write_dictionary(frequent, n), buckets)

    def add(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        a, b, c = _added(_unpacked(frame["first"], "<u8"), _unpacked(frame["rest"], "<u8"), _unpacked(frame["counts"], "<u4").astype(np.int64))
        node = b >> _U32
        first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (node[1:] != node[:-1]))))
        flow = np.add.reduceat(c, first)  # edges out of the node, and pieces that end with it
        edges, nodes = ((b & _LOW) > 0) & (c >= least), (node[first] > 0) & (flow >= least)
        whole = np.concatenate((a[edges], a[first][nodes])), np.concatenate((b[edges], node[first][nodes] << _U32)), np.concatenate((c[edges], flow[nodes]))
        out = [(-1, _packed(whole[0], "<u8"), _packed(whole[1], "<u8"), _packed(whole[2], "<i8"))] if len(whole[0]) else []
        pair = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
        own, passing = a[pair], np.add.reduceat(c, pair)
        bucket = (mix(own) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        out += [(k, _packed(own[order[i:j]], "<u8"), b"", _packed(passing[order[i:j]], "<i8")) for k, (i, j) in _ranges(bucket[order])]
        give_back()
        return pd.DataFrame(out, columns=["bucket", "first", "rest", "counts"])

    flows = saved(grams.repartition(buckets, "bucket").groupBy("bucket").applyInPandas(add, _RUNS))
    row = "w1 long, w2 long, w3 long, w4 long, a long"

    def as_rows(a: np.ndarray, b: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
        ids = [a >> _U32, a & _LOW, b >> _U32, b & _LOW]
        return pd.DataFrame({**{k: v.astype(np.int64) for k, v in zip(_KEY, ids, strict=True)}, "a": counts})

    def add_pairs(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        own = _unpacked(frame["first"], "<u8")
        a, b, c = _added(own, np.zeros_like(own), _unpacked(frame["counts"], "<i8"))
        return as_rows(a[c >= least], b[c >= least], c[c >= least])

    def unpack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for first, rest, counts in zip(frame["first"], frame["rest"], frame["counts"], strict=True):
                yield as_rows(_unpacked([first], "<u8"), _unpacked([rest], "<u8"), _unpacked([counts], "<i8"))

    pairs = flows.where("bucket >= 0").repartition(buckets, "bucket").groupBy("bucket").applyInPandas(add_pairs, row)
    longer = flows.where("bucket = -1").mapInPandas(unpack, row)
    zero = F.lit(0).cast("long")
    single = frequent.select(F.col("id").alias("w1"), zero.alias("w2"), zero.alias("w3"), zero.alias("w4"), F.col("n").alias("a"))
    return Graph(frequent, totals, saved(pairs.unionByName(longer).unionByName(single)), least)


# --- paths --------------------------------------------------------------------------------------


def _id(*columns: str) -> Column:
    return F.concat_ws(" ", *columns)


def paths(graph: Graph) -> DataFrame:
    """(words: array of ids, a): the graph's edges with unary paths compacted.

    A node is inside a path if one edge brings its whole flow and one edge takes it, so that all edges of a path have
    one weight. Edges point to the next one of their path; pointers are followed twice as far each
    round, each round is written out, and the rounds are the logarithm of the longest path, which
    lies within a piece of some text. Every edge is on one path; edges without such neighbours are paths themselves.
    """
    edges = graph.of_length(4)
    nodes = graph.of_length(3)
    into = edges.join(nodes.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("w3").alias("w4"), F.col("a")), ["w2", "w3", "w4", "a"])
    out = edges.join(nodes.select("w1", "w2", "w3", "a"), ["w1", "w2", "w3", "a"])
    into = into.select(_id("w2", "w3", "w4").alias("node"), _id(*_KEY).alias("id"))
    out = out.select(_id("w1", "w2", "w3").alias("node"), _id(*_KEY).alias("next"))
    links = saved(into.join(out, "node").where("id <> next").select("id", "next"))
    ends = links.select(F.col("next").alias("id")).join(links.select("id"), "id", "left_anti")
    state = links.withColumn("hops", F.lit(1).cast("long")).unionByName(ends.select("id", F.col("id").alias("next"), F.lit(0).cast("long").alias("hops")))
    state = saved(state)
    while True:
        ahead = state.select(F.col("id").alias("next"), F.col("next").alias("_next"), F.col("hops").alias("_hops"))
        further = saved(state.join(ahead, "next").select("id", F.col("_next").alias("next"), (F.col("hops") + F.col("_hops")).alias("hops"), (F.col("_hops") > 0).alias("_moved")))
        state = further.select("id", "next", "hops")
        if not further.where("_moved").limit(1).count():
            break
    placed = edges.withColumn("id", _id(*_KEY)).join(state, "id", "left")
    path = placed.groupBy(F.coalesce("next", "id").alias("path"), "a").agg(F.array_sort(F.collect_list(F.struct((-F.coalesce("hops", F.lit(0))).alias("at"), *_KEY))).alias("e"))
    head = F.col("e")[0]
    words = F.concat(F.array(head["w1"], head["w2"], head["w3"]), F.transform("e", lambda e: e["w4"]))
    return path.select(words.alias("words"), "a")


def _inside(words: Column, size: int) -> Column:
    """All stretches of ``size`` neighbours of an array, as structs of four ids."""
    places = F.sequence(F.lit(0), F.size(words) - size)
    return F.transform(places, lambda i: F.struct(*[(F.get(words, i + k) if k < size else F.lit(0).cast("long")).alias(n) for k, n in enumerate(_KEY)]))


def _contained(graph: Graph) -> DataFrame:
    """(w1..w4, most): pairs and nodes that lie inside longer phrases, with the greatest count of such."""
    array = F.array(*_KEY[:3])
    found = [saved(paths(graph)).select(F.explode(F.concat(_inside(F.col("words"), 2), _inside(F.col("words"), 3))).alias("p"), "a")]
    found.append(graph.of_length(3).select(array.alias("words"), "a").select(F.explode(_inside(F.col("words"), 2)).alias("p"), "a"))
    every = found[0].unionByName(found[1])
    return every.groupBy(*[F.col(f"p.{k}").alias(k) for k in _KEY]).agg(F.max("a").alias("most"))


def _decimal(column: Column) -> Column:
    return column.cast("decimal(19,0)")


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, graph: Graph | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of two to four words.

    ``a`` is the phrase's count, ``l`` and ``r`` those of its parts at the cut with the lowest score (of equal ones the
    first), score = floor(2000000 a / (l + r)), and n the number of words of the language. Phrases
    with fewer than ``least`` occurrences, or inside a longer phrase that has 80 % of their
    count or more, are left out. Ranked by score, count, then phrase in byte order.

    Null text is empty, a null lang is ``und``. Equal rows count each; doc_id is not read. An empty table gives no
    rows; other columns are ignored, whatever their names.
    """
    graph = graph or build(docs, least)
    phrases = graph.counts.where("w2 > 0").join(_contained(graph), _KEY, "left")
    phrases = saved(phrases.where(F.col("most").isNull() | (100 * _decimal(F.col("most")) < 80 * _decimal(F.col("a")))).drop("most"))

    w, zero = [F.col(k) for k in _KEY], F.lit(0).cast("long")
    cuts = []
    for k in (1, 2, 3):
        left = [c.alias(f"x{i}") for i, c in enumerate([*w[:k], *[zero] * (4 - k)][:3])]
        right = [c.alias(f"y{i}") for i, c in enumerate([*w[k:], *[zero] * k][:3])]
        cuts.append(F.when(w[k] > 0, F.struct(F.lit(k).alias("k"), *left, *right)))
    parts = phrases.select(*_KEY, "a", F.explode(F.array_compact(F.array(*cuts))).alias("c")).select(*_KEY, "a", "c.*")
    shorter = graph.counts.where("w4 = 0")
    for side, name in (("x", "l"), ("y", "r")):
        key = [f"{side}{i}" for i in range(3)]
        dim = shorter.select(*[F.col(k).alias(n) for k, n in zip(_KEY, key, strict=False)], F.col("a").alias(name))
        parts = spread_lookup(parts, dim, key, [*_KEY, "k"])
    product = F.lit(2_000_000).cast("decimal(7,0)") * _decimal(F.col("a"))
    parts = parts.withColumn("product", product).withColumn("both", _decimal(F.col("l")) + _decimal(F.col("r")))
    worst = F.min(F.struct(F.expr("product div both").alias("score"), "k", "l", "r")).alias("m")
    scored = parts.groupBy(*_KEY, "a").agg(worst).select(*_KEY, "a", "m.l", "m.r", "m.score")

    named = scored.join(graph.words.select(F.col("id").alias("w1"), "lang", F.col("word").alias("t1")), "w1")
    order = [F.desc("score"), F.desc("a")]
    # Ties at the last place stay until their texts are known.
    named = named.withColumn("_place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("_place") <= top)
    for k in (2, 3, 4):
        named = named.join(graph.words.select(F.col("id").alias(f"w{k}"), F.col("word").alias(f"t{k}")), f"w{k}", "left")
    named = named.withColumn("phrase", F.concat_ws(" ", "t1", "t2", "t3", "t4"))
    named = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long")).where(F.col("rank") <= top)
    return named.join(graph.totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
