"""Helpers that several operators share: reading, saving, hashing of words, gapless numbers, skew-safe look-ups."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postmill.sources.checkpoints import checkpointed

SEPARATORS = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
WORD_SPLIT = r"[\x20\x09-\x0D]+"
BLOCK_BYTES = 2 << 20
MAX_BLOCKS = 100_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


saved = checkpointed


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query run inside go when it ends, not when the driver next collects garbage; for steps that are saved."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


# --- gapless numbers ----------------------------------------------------------------------------


def blocks_for(rows: int, block_rows: int) -> int:
    """How many blocks hold ``rows``; at most ``MAX_BLOCKS``, beyond which blocks grow (and a task sorts more)."""
    return max(1, min(MAX_BLOCKS, math.ceil(rows / block_rows)))


def numbered(df: DataFrame, groups: Sequence[str], block: str, order: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each group from 0 without gaps, ordered by block, then by ``order``.

    No task sees a whole group: a row's number is the count of the group's earlier blocks plus its
    rank in its own block. Groups and block must not be null. ``df`` is read twice.
    """
    keys = [*groups, block]
    before = Window.partitionBy(*groups).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_count"))
    offsets = counts.select(*keys, F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    ranked = df.withColumn("_rank", rank).join(offsets, keys)
    return ranked.withColumn(name, (F.col("_before") + F.col("_rank") - 1).cast("long")).drop("_before", "_rank")


# --- arrays in expressions ----------------------------------------------------------------------

CHUNK = 256


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often a lambda in it asks for it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def folded(items: Column, zero: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """(last, out): a state carried over the items, and what every step gives out, an array of ``kind`` each, flattened.

    Output is gathered per CHUNK items and the chunks are flattened at the end, so that no long array grows item by item.
    """
    none, no_parts = F.array().cast(f"array<{kind}>"), F.array().cast(f"array<array<{kind}>>")

    def add(s: Column, x: Column) -> Column:
        last, out = step(s["last"], x)
        return F.struct(last.alias("last"), F.concat(s["out"], out).alias("out"))

    def add_chunk(s: Column, chunk: Column) -> Column:
        part = F.aggregate(chunk, F.struct(s["last"].alias("last"), none.alias("out")), add)
        return once(part, lambda p: F.struct(p["last"].alias("last"), F.concat(s["parts"], F.array(p["out"])).alias("parts")))

    def over(every: Column) -> Column:
        places = F.when(F.size(every) > 0, F.sequence(F.lit(1), F.size(every), F.lit(CHUNK))).otherwise(F.array().cast("array<int>"))
        start = F.struct(zero.alias("last"), no_parts.alias("parts"))
        finish = lambda s: F.struct(s["last"].alias("last"), F.flatten(s["parts"]).alias("out"))
        return F.aggregate(F.transform(places, lambda i: F.slice(every, i, F.lit(CHUNK))), start, add_chunk, finish)

    return once(items, over)


# --- look-ups -----------------------------------------------------------------------------------


def spread_lookup(facts: DataFrame, dim: DataFrame, key: Sequence[str], spread: Sequence[Column]) -> DataFrame:
    """``facts`` left-joined with ``dim`` (one row per key) so that no key's rows meet in one task.

    Every fact gets a salt from a hash of ``spread``. The distinct (key, salt) pairs, at most one per
    salt and key and combined before they are shuffled, fetch the ``dim`` row; the facts then join
    these pairs on key and salt. Salts are eight times the shuffle partitions, so that a key with any
    share of the rows fills all partitions; no list of hot keys is needed.
    """
    spark = facts.sparkSession
    salts = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = [c for c in dim.columns if c not in key]
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    pairs = salted.select(*key, "_salt").distinct().join(dim, list(key))
    return salted.join(pairs, [*key, "_salt"], "left").select(*facts.columns, *values)


# --- words --------------------------------------------------------------------------------------

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SEPARATOR = np.zeros(256, dtype=bool)
_IS_SEPARATOR[list(SEPARATORS)] = True
_BYTE_VALUES = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Tables:
    """Powers of the base and of its inverse, as long as the longest block seen in this process."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_Tables.up) < n:
        size = max(n, BLOCK_BYTES + 4096)
        _Tables.up, _Tables.down = _powers(_BASE, size), _powers(_BASE_INVERSE, size)
    return _Tables.up, _Tables.down


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that scatters its argument (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i], times the base to the power of -i, a hash of data[i:j]; one longer than data."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=out[1:])
    return out


def _pieces(texts: Iterable[bytes]) -> Iterable[tuple[int, bytes]]:
    """(document, piece): texts over the block size are cut at separators; a longer single word stays whole."""
    for i, text in enumerate(texts):
        start = 0
        while len(text) - start > BLOCK_BYTES:
            cut = max(text.rfind(bytes([s]), start, start + BLOCK_BYTES) for s in SEPARATORS)
            if cut <= start:
                ahead = [p for p in (text.find(bytes([s]), start + BLOCK_BYTES) for s in SEPARATORS) if p >= 0]
                if not ahead:
                    break
                cut = min(ahead)
            yield i, text[start:cut]
            start = cut + 1
        yield i, text[start:]


def word_hashes(texts: Sequence[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all words in order, number of words of each text); vectorised over blocks of 2 MB."""
    counts = np.zeros(len(texts), dtype=np.int64)
    found: list[np.ndarray] = []

    def flush(block: list[tuple[int, bytes]]) -> None:
        data = np.frombuffer(b" ".join(p for _, p in block) + b" ", dtype=np.uint8)
        inside = ~_IS_SEPARATOR[data]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if inside[0]:
            edge = np.concatenate(([0], edge))
        starts, ends = edge[::2], edge[1::2]
        sums = prefix_hash(_LOWER[data] if lower else data)
        down = powers(len(data))[1]
        found.append(mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)))
        begin = np.cumsum([0] + [len(p) + 1 for _, p in block[:-1]])
        which = np.array([i for i, _ in block])[np.searchsorted(begin, starts, "right") - 1]
        counts[:] += np.bincount(which, minlength=len(texts)) if len(which) else 0

    block: list[tuple[int, bytes]] = []
    size = 0
    for piece in _pieces(texts):
        if block and size + len(piece[1]) > BLOCK_BYTES:
            flush(block)
            block, size = [], 0
        block.append(piece)
        size += len(piece[1]) + 1
    if block:
        flush(block)
    return (np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)), counts


def bytes_of(column) -> list[bytes]:
    """A string column of an Arrow batch as UTF-8 bytes; null becomes empty."""
    import pyarrow as pa

    return [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()]


def slices_of(column, limit: int = 4 * BLOCK_BYTES) -> Iterable[tuple[slice, list[bytes]]]:
    """Runs of a batch's texts with about ``limit`` bytes each (one row at least), to bound a task's memory.

    Memory is given back to the system after every run, as a worker lives on from task to task.
    """
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, size = 0, 0
    for i, own in enumerate([*sizes.tolist(), None]):
        if own is None or (i > start and size + own > limit):
            if i > start:
                yield slice(start, i), bytes_of(column.slice(start, i - start))
                give_back()
            start, size = i, 0
        size += own or 0


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
