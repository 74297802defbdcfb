"""An interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted arrays, mapped by workers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.arrays import get, new_folder, put
from postmill.llm.common import mix, saved, slices_of, text_or_empty, word_hashes

END = np.uint64(0x5E0FBEEF5E0FBEEF)  # the hash of the end token
SLICE = 4 << 20  # bytes of text that a worker handles at once
FLUSH = 1_500_000  # n-grams, distinct in their slices, that a worker gathers before it passes them on
WORD_BUCKET, PAIR_BUCKET = 64 << 20, 16 << 20  # bytes of training text for each bucket of words, of pairs
IDS = 1 << 18  # words whose statistics one group gathers

_BLOBS = "bucket int, keys binary, counts binary"


def tokens_of(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all tokens, number of tokens of each text): its words, lower-cased, then the end token."""
    hashes, counts = word_hashes(raw)
    return np.insert(hashes, np.cumsum(counts), END), counts + 1


def held_out() -> Column:
    """Documents that the model does not learn from: CRC-32 of the id as text is 1 modulo 5."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def _dealt(keys: np.ndarray, counts: np.ndarray, bucket: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """Sorted (key, count) runs, one per bucket; none without keys."""
    if not len(keys):
        return
    order = np.argsort(bucket, kind="stable")
    keys, counts, bucket = keys[order], counts[order].astype("<u4"), bucket[order]
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(keys)], strict=True):
        yield int(bucket[a]), keys[a:b].tobytes(), counts[a:b].tobytes()


def _counted(docs: DataFrame, keys_of: Callable[[], Callable[[list[bytes]], tuple[np.ndarray, Callable]]]) -> DataFrame:
    """Runs of n-gram counts per bucket: summed in the worker, then passed on as binary rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract, bucket_of = keys_of()
        pending: list[tuple[np.ndarray, np.ndarray]] = []

        def rows() -> pa.RecordBatch:
            keys, counts = _summed(*(np.concatenate(x) for x in zip(*pending, strict=True)))
            pending.clear()
            runs = list(_dealt(keys, counts, bucket_of(keys)))
            columns = [pa.array([r[i] for r in runs], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, names=["bucket", "keys", "counts"])

        for batch in batches:
            for _, raw in slices_of(batch.column(0), SLICE):
                pending.append(np.unique(extract(raw), return_counts=True))
                if sum(len(k) for k, _ in pending) >= FLUSH:
                    yield rows()
        if pending:
            yield rows()

    return docs.select("text").mapInArrow(count, _BLOBS)


def _merged(frame: pd.DataFrame, dtype: str = "<u8") -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([np.frombuffer(k, dtype=dtype) for k in frame["keys"]])
    counts = np.concatenate([np.frombuffer(c, dtype="<u4") for c in frame["counts"]]).astype(np.int64)
    return _summed(keys, counts)


def _discounts(n: np.ndarray) -> np.ndarray:
    """Discounts of n-grams seen 0, 1, 2, 3 or more times, from the numbers of those seen 1, 2, 3, 4 times.

    Where such a number is 0 the discount of the count below holds (0.5 for the first).
    """
    out = np.array([0.0, 0.5, 0.5, 0.5])
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    for k in (1, 2, 3):
        out[k] = min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.0), k) if n[k - 1] and n[k] else out[k - 1] if k > 1 else 0.5
    return out


@dataclass
class Model:
    """Where the arrays are, and the few numbers that go with them. Word ids follow the order of hashes."""

    folder: str
    word_bits: int
    pair_buckets: int
    word_base: np.ndarray  # id of each word bucket's first word
    texts: int  # training documents
    tokens: int
    hot: int  # words at least so frequent have their pairs dealt over all buckets
    pair_types: int = 0
    pair_discounts: np.ndarray | None = None
    word_discounts: np.ndarray | None = None
    word_left: float = 0.0  # mass left for unseen words

    @property
    def words(self) -> int:
        return int(self.word_base[-1])

    def pair_bucket(self, pairs: np.ndarray, frequency: np.ndarray) -> np.ndarray:
        """Pairs are dealt by their first word, those of a frequent first word by both."""
        return (mix(np.where(frequency >= self.hot, pairs, pairs >> np.uint64(32)) + np.uint64(1)) % np.uint64(self.pair_buckets)).astype(np.int32)


class Reader:
    """A worker's view of the model: look-ups of sorted distinct keys in mapped arrays."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.open: dict[str, np.ndarray] = {}

    def array(self, name: str, dtype: str) -> np.ndarray:
        if name not in self.open:
            self.open[name] = get(self.model.folder, name, dtype)
        return self.open[name]

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id or -1, training count) of sorted distinct word hashes."""
        model = self.model
        ids, counts = np.full(len(hashes), -1, dtype=np.int64), np.zeros(len(hashes), dtype=np.int64)
        for bucket, (a, b) in _ranges(hashes >> np.uint64(64 - model.word_bits)):
            if model.word_base[bucket] == model.word_base[bucket + 1]:
                continue
            at, hit = _find(self.array(f"words-{bucket}", "<u8"), hashes[a:b])
            ids[a:b][hit] = model.word_base[bucket] + at[hit]
            counts[a:b][hit] = self.array(f"counts-{bucket}", "<i8")[at[hit]]
        return ids, counts

    def pairs(self, pairs: np.ndarray, frequency: np.ndarray) -> np.ndarray:
        """Training counts of distinct pairs; frequency is that of the first word."""
        bucket = self.model.pair_bucket(pairs, frequency)
        order = np.lexsort((pairs, bucket))
        out = np.zeros(len(pairs), dtype=np.int64)
        for b, (i, j) in _ranges(bucket[order]):
            keys = self.array(f"pairs-{b}", "<u8")
            if len(keys):
                at, hit = _find(keys, pairs[order[i:j]])
                out[order[i:j][hit]] = self.array(f"pair-counts-{b}", "<u4")[at[hit]]
        return out

    def statistics(self, name: str, ids: np.ndarray) -> np.ndarray:
        """A per-word statistic at sorted ids."""
        out = np.zeros(len(ids), dtype=np.int64)
        for part, (a, b) in _ranges(ids // IDS):
            out[a:b] = self.array(f"{name}-{part}", "<u4")[ids[a:b] % IDS]
        return out


def _ranges(sorted_keys: np.ndarray) -> Iterator[tuple[int, tuple[int, int]]]:
    if len(sorted_keys):
        first = np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1]))).tolist()
        for a, b in zip(first, [*first[1:], len(sorted_keys)], strict=True):
            yield int(sorted_keys[a]), (a, b)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, np.flatnonzero(keys[at] == wanted)


def _pairs_of(reader: Reader, raw: list[bytes]) -> tuple[np.ndarray, ...]:
    """(first word id, second word id, count of the first, count of the second) per token; ids of unknown words are -1."""
    model = reader.model
    hashes, counts = tokens_of(raw)
    own, inverse = np.unique(hashes, return_inverse=True)
    ids, known = reader.ids(own)
    second, frequency = ids[inverse], known[inverse]
    first, first_frequency = np.empty_like(second), np.empty_like(frequency)
    first[1:], first_frequency[1:] = second[:-1], frequency[:-1]
    begin = np.cumsum(counts) - counts
    first[begin], first_frequency[begin] = model.words, model.texts  # the id after the last word begins a text
    return first, second, first_frequency, frequency, counts


def train(docs: DataFrame) -> Model:
    """Count words, then pairs, then the statistics of each word as first and as second of a pair.

    Each pass sums in the workers and shuffles sorted binary runs per bucket of hashes, so frequent
    n-grams cost one entry per run. A bucket's group writes its arrays to the shared folder. Only
    one row of sums per bucket comes to the driver.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_or_empty())), F.count(F.lit(1))).first()
    bits = max(3, int(np.ceil(np.log2(max(1, (size[0] or 0) / WORD_BUCKET)))))
    folder = new_folder(spark, "ngrams")

    def word_keys():
        return (lambda raw: tokens_of(raw)[0]), (lambda keys: (keys >> np.uint64(64 - bits)).astype(np.int32))

    def write_words(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        keys, counts = _merged(frame)
        put(folder, f"words-{key[0]}", keys)
        put(folder, f"counts-{key[0]}", counts.astype("<i8"))
        return pd.DataFrame({"bucket": [int(key[0])], "types": [len(keys)], "tokens": [int(counts.sum())]})

    words = saved(_counted(docs, word_keys).groupBy("bucket").applyInPandas(write_words, "bucket int, types long, tokens long"))
    types = np.zeros(1 << bits, dtype=np.int64)
    tokens = 0
    for row in words.collect():
        types[row["bucket"]] = row["types"]
        tokens += row["tokens"]
    base = np.concatenate(([0], np.cumsum(types)))
    if base[-1] >= 2**32 - 1:
        raise ValueError("more than four billion distinct words")
    buckets = max(8, int((size[0] or 0) // PAIR_BUCKET) + 1)
    model = Model(folder, bits, buckets, base, int(size[1]), tokens, max(1000, tokens // (8 * buckets)))

    def pair_keys():
        reader = Reader(model)
        seen: dict[str, np.ndarray] = {}

        def extract(raw: list[bytes]) -> np.ndarray:
            first, second, _, _, _ = _pairs_of(reader, raw)
            return (first.astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)

        def bucket_of(pairs: np.ndarray) -> np.ndarray:
            return model.pair_bucket(pairs, _frequency(reader, (pairs >> np.uint64(32)).astype(np.int64)))

        return extract, bucket_of

    def write_pairs(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        pairs, counts = _merged(frame)
        put(folder, f"pairs-{key[0]}", pairs)
        put(folder, f"pair-counts-{key[0]}", counts.astype("<u4"))
        out = [(-1, np.array([(counts == k).sum() for k in (1, 2, 3, 4)] + [len(pairs)], dtype="<i8").tobytes(), b"")]
        first, second = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        for kind, ids in ((0, first[counts == 1]), (1, first[counts == 2]), (2, first[counts > 2]), (3, second)):
            own, times = np.unique(ids, return_counts=True)
            for part, (a, b) in _ranges(own // IDS):
                steps = np.diff(own[a:b], prepend=part * IDS).astype("<u4")  # small numbers, which compress
                out.append((4 * part + kind, steps.tobytes(), times[a:b].astype("<u4").tobytes()))
        return pd.DataFrame(out, columns=["bucket", "keys", "counts"])

    found = saved(_counted(docs, pair_keys).groupBy("bucket").applyInPandas(write_pairs, _BLOBS))
    sums = np.zeros(5, dtype=np.int64)
    for row in found.where("bucket = -1").collect():
        sums += np.frombuffer(row["keys"], dtype="<i8")
    model.pair_discounts, model.pair_types = _discounts(sums[:4]), int(sums[4])

    def write_statistics(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        part, kind = divmod(int(key[0]), 4)
        dense = np.zeros(IDS, dtype="<u4")
        for steps, times in zip(frame["keys"], frame["counts"], strict=True):
            ids = np.cumsum(np.frombuffer(steps, dtype="<u4").astype(np.int64))
            dense[ids] += np.frombuffer(times, dtype="<u4")
        put(folder, f"{('once', 'twice', 'more', 'left')[kind]}-{part}", dense)
        return pd.DataFrame({"kind": [kind], "numbers": [[int((dense == k).sum()) for k in (1, 2, 3, 4)] + [int((dense > 2).sum())]]})

    gathered = saved(found.where("bucket >= 0").groupBy("bucket").applyInPandas(write_statistics, "kind int, numbers array<long>"))
    numbers = np.zeros(5, dtype=np.int64)
    for row in gathered.where("kind = 3").collect():
        numbers += np.array(row["numbers"])
    have = {r["bucket"] for r in found.where("bucket >= 0").select("bucket").distinct().collect()}
    for part in range((model.words + 1 + IDS - 1) // IDS):  # a part without such pairs
        for kind, name in enumerate(("once", "twice", "more", "left")):
            if 4 * part + kind not in have:
                put(folder, f"{name}-{part}", np.zeros(IDS, dtype="<u4"))
    for bucket in range(buckets):  # an empty bucket
        _touch(folder, bucket)
    model.word_discounts = _discounts(numbers[:4])
    model.word_left = float(model.word_discounts[1:] @ np.array([numbers[0], numbers[1], numbers[4]])) / max(model.pair_types, 1)
    return model


def _touch(folder: str, bucket: int) -> None:
    try:
        get(folder, f"pairs-{bucket}", "<u8")
    except (FileNotFoundError, OSError):
        put(folder, f"pairs-{bucket}", np.zeros(0, dtype="<u8"))


def _frequency(reader: Reader, ids: np.ndarray) -> np.ndarray:
    """Training counts of word ids (sorted, not distinct); that of the begin is the number of texts."""
    model = reader.model
    out = np.full(len(ids), model.texts, dtype=np.int64)
    inside = np.flatnonzero(ids < model.words)
    bucket = np.searchsorted(model.word_base, ids[inside], "right") - 1
    for b, (i, j) in _ranges(bucket):
        out[inside[i:j]] = reader.array(f"counts-{b}", "<i8")[ids[inside[i:j]] - model.word_base[b]]
    return out


def _score(reader: Reader, raw: list[bytes]) -> tuple[np.ndarray, ...]:
    """(tokens, known tokens, base score, score) of each text."""
    model = reader.model
    first, second, first_frequency, frequency, counts = _pairs_of(reader, raw)
    begin = np.cumsum(counts) - counts
    base = np.log10((frequency + 0.5) / (model.tokens + 0.5 * (model.words + 1)))

    own, at = np.unique(second, return_inverse=True)
    inside = own >= 0
    left = np.zeros(len(own), dtype=np.int64)
    left[inside] = reader.statistics("left", own[inside])
    types = max(model.pair_types, 1)
    lower = (np.maximum(left - model.word_discounts[np.minimum(left, 3)], 0) / types + max(model.word_left, 0.0) / (model.words + 1))
    if not model.pair_types:
        lower[:] = 1 / (model.words + 1)
    lower = lower[at]

    known = first_frequency > 0
    p = lower.copy()
    if known.any():
        context, which = np.unique(first[known], return_inverse=True)
        counted = [reader.statistics(n, context) for n in ("once", "twice", "more")]
        left_mass = sum(d * c for d, c in zip(model.pair_discounts[1:], counted, strict=True))[which]
        pair = (first[known].astype(np.uint64) << np.uint64(32)) | second[known].astype(np.uint64) & np.uint64(0xFFFFFFFF)
        unknown = second[known] < 0
        distinct, some, back = np.unique(pair, return_index=True, return_inverse=True)
        seen = reader.pairs(distinct, first_frequency[known][some])[back]
        seen[unknown] = 0
        p[known] = (np.maximum(seen - model.pair_discounts[np.minimum(seen, 3)], 0) + left_mass * lower[known]) / first_frequency[known]
    return counts, np.add.reduceat((frequency > 0).astype(np.int64), begin), np.add.reduceat(base, begin), np.add.reduceat(np.log10(p), begin)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity for every row."""
    plain = docs.select("doc_id", held_out().alias("held_out"), "text")
    schema = plain.select("doc_id", "held_out").schema
    for name, kind in (("n_tokens", "long"), ("n_known", "long"), ("train_tokens", "long"), ("base_score", "double"), ("score", "double"), ("perplexity", "double")):
        schema = schema.add(name, kind)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for batch in batches:
            for part, raw in slices_of(batch.column(2), SLICE):
                tokens, known, base, total = _score(reader, raw)
                kept = [batch.column(i).slice(part.start, part.stop - part.start) for i in (0, 1)]
                own = [tokens, known, np.full(len(tokens), model.tokens), base, total, 10.0 ** (-total / tokens)]
                yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, own)], names=schema.names)

    return plain.mapInArrow(scored, schema)


def train_and_score(docs: DataFrame) -> DataFrame:
    """Scores of all whole texts by the model of those that are not held out.

    Null text is empty: its end token alone is scored. A null doc_id is hashed as an empty id; rows
    are scored each, so repeated rows get equal scores. An empty table gives no rows; without
    training documents every token is unknown. Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    return score(docs, train(docs.where(~held_out())))
