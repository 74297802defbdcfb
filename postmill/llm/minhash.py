"""Near duplicates by banded MinHash candidates, checked first by odd sketches and then on full shingle sets."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from postmill.llm.common import mix, saved, slices_of, spread_lookup, word_hashes
from postmill.llm.graph import components

LONGS = ArrayType(LongType())
WORDS = 5
SIMILAR = 75  # per cent of the union
BANDS, ROWS = 32, 4  # a pair at the threshold meets in no band with a probability of 5e-6
SKETCH_BITS = 512
#: Members of one bucket that meet in one group; larger buckets are compared block by block.
BLOCK = 500

_FACTORS = np.random.default_rng(99).integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _most_odd_bits() -> int:
    """Pairs with more differing sketch bits are rejected.

    Of k samples, a pair at the threshold has a binomial number that differ; each such sample flips
    two random bits. The bound lies five standard deviations above the mean of both steps.
    """
    k, n = BANDS * ROWS, SKETCH_BITS
    differ = k * (1 - SIMILAR / 100)
    flips = 2 * (differ + 5 * math.sqrt(differ * SIMILAR / 100))
    mean = n / 2 * (1 - (1 - 2 / n) ** flips)
    return math.ceil(mean + 5 * math.sqrt(mean * (1 - mean / n)))


MOST_ODD_BITS = _most_odd_bits()


def shingle_sets(texts: Sequence[bytes]) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its 5-word shingles.

    A text with one to four words has its whole sequence as one shingle, one without words none.
    """
    hashes, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    windows = np.zeros(0, dtype=np.uint64)
    if len(hashes) >= WORDS:
        windows = np.full(len(hashes) - WORDS + 1, WORDS, dtype=np.uint64)
        for k in range(WORDS):
            windows = mix(windows * np.uint64(0xD6E8FEB86659FD93) + hashes[k : len(hashes) - WORDS + 1 + k])
    out = []
    for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
        if n >= WORDS:
            out.append(np.unique(windows[end - n : end - WORDS + 1]))
        elif n:
            whole = np.full(1, n, dtype=np.uint64)
            for h in hashes[end - n : end]:
                whole = mix(whole * np.uint64(0xD6E8FEB86659FD93) + h)
            out.append(whole)
        else:
            out.append(hashes[:0])
    return out


def samples(sets: Sequence[np.ndarray]) -> np.ndarray:
    """MinHash samples, one row per (non-empty) set."""
    sizes = np.array([len(s) for s in sets])
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    every = np.concatenate(sets)
    out = np.empty((len(sets), len(_FACTORS)), dtype=np.uint64)
    for i, factor in enumerate(_FACTORS):
        out[:, i] = np.minimum.reduceat(every * factor, begin)
    return out


def bands_of(sample: np.ndarray) -> np.ndarray:
    """One bucket per band: a hash of the band's number and its samples."""
    grouped = sample.reshape(len(sample), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sample), BANDS)).copy()
    for r in range(ROWS):
        key = mix(key * np.uint64(0x9FB21C651E98DF25) + grouped[:, :, r])
    return key


def odd_sketches(sample: np.ndarray) -> np.ndarray:
    """Parity bitmaps: every sample, hashed with its number, flips one bit. Equal samples cancel in the XOR."""
    number = np.arange(1, sample.shape[1] + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
    bit = (mix(sample ^ mix(number)[None, :]) % np.uint64(SKETCH_BITS)).astype(np.int64)
    parity = np.zeros((len(sample), SKETCH_BITS), dtype=np.uint8)
    np.add.at(parity, (np.arange(len(sample))[:, None], bit), 1)
    return np.packbits(parity & 1, axis=1, bitorder="little").view("<u8")


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands, sketch) per row; the key names the shingle set, null if empty."""
    schema = docs.select("doc_id").schema.add("n_shingles", "long").add("set_key", "binary").add("bands", LONGS).add("sketch", LONGS)

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw in slices_of(batch.column(1), 4 << 20):
                sets = shingle_sets(raw)
                full = [i for i, s in enumerate(sets) if len(s)]
                keys, bands, sketch = [None] * len(sets), [None] * len(sets), [None] * len(sets)
                if full:
                    sample = samples([sets[i] for i in full])
                    own_bands, own_sketch = bands_of(sample).view(np.int64), odd_sketches(sample).view(np.int64)
                    for k, i in enumerate(full):
                        keys[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                        bands[i], sketch[i] = own_bands[k], own_sketch[k]
                columns = [batch.column(0).slice(part.start, part.stop - part.start), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(signed, schema)


def odd_bits(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def plausible(a: Column, b: Column) -> Column:
    """Neither the sizes nor the sketches of two classes rule out the similarity."""
    sizes = 100 * F.least(a["n"], b["n"]) >= SIMILAR * F.greatest(a["n"], b["n"])
    return sizes & (odd_bits(a["sketch"], b["sketch"]) <= MOST_ODD_BITS)


def similar(common, n, m):
    """Whether sets of n and m shingles with so many in common are linked; numbers or arrays."""
    return 100 * common >= SIMILAR * (n + m - common)


def _linked_to_hubs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between members and the hubs of their stars. Every star's rows come together, its hub first."""
    hub = np.zeros(0, dtype=np.uint64)
    for batch in batches:
        hub_ids, ids, is_hub = (batch.column(name).to_pylist() for name in ("hub", "id", "is_hub"))
        found = []
        for part, raw in slices_of(batch.column("text"), 4 << 20):
            for i, own in enumerate(shingle_sets(raw), part.start):
                if is_hub[i]:
                    hub = own
                elif similar(len(np.intersect1d(own, hub, assume_unique=True)), len(own), len(hub)):
                    found.append(i)
        columns = [pa.array([ids[i] for i in found], pa.int64()), pa.array([hub_ids[i] for i in found], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _apart(frame: pd.DataFrame) -> np.ndarray:
    """Which pairs of rows have different components, come from the two sides, are plausible, and meet here first.

    A pair that shares several split buckets is looked at in the smallest of them only.
    """
    sketch = np.array(frame["sketch"].tolist(), dtype=np.int64).view(np.uint64)
    comp, n, side = frame["comp"].to_numpy(), frame["n"].to_numpy(), frame["side"].to_numpy()
    both = frame["same"].iloc[0]  # one block against itself
    out = np.zeros((len(frame), len(frame)), dtype=bool)
    for i in range(len(frame)):
        odd = np.bitwise_count(sketch ^ sketch[i]).sum(1)
        out[i] = (odd <= MOST_ODD_BITS) & (comp != comp[i]) & (100 * np.minimum(n, n[i]) >= SIMILAR * np.maximum(n, n[i]))
        if not both:
            out[i] &= side != side[i]
    lists = frame["buckets"].to_list()
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    bucket = np.concatenate(lists)
    row, bucket = row[bucket < frame["bucket"].iloc[0]], bucket[bucket < frame["bucket"].iloc[0]]
    _, which, count = np.unique(bucket, return_inverse=True, return_counts=True)
    row, which = row[count[which] > 1], which[count[which] > 1]
    row, which = row[np.argsort(which, kind="stable")], np.sort(which)
    for members in np.split(row, np.flatnonzero(np.diff(which)) + 1):
        out[np.ix_(members, members)] = False
    return out


def _worth_reading(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.loc[_apart(frame).any(1)]


def _linked_in_block(frame: pd.DataFrame) -> pd.DataFrame:
    """Links that join different components, found on full sets; pairs already joined are skipped."""
    frame = frame.sort_values("id", ignore_index=True)
    sets, ids = shingle_sets(list(frame["text"])), frame["id"].to_numpy()
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    every = np.concatenate(sets) if len(sets) else np.zeros(0, dtype=np.uint64)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    open_pairs, comp = _apart(frame), frame["comp"].to_numpy().copy()
    found = []
    for i, own in enumerate(sets):
        rest = np.flatnonzero(open_pairs[i] & (comp != comp[i]))
        if not len(rest):
            continue
        low, high = np.searchsorted(every, own, "left"), np.searchsorted(every, own, "right")
        width = high - low
        at = np.repeat(low - np.concatenate(([0], np.cumsum(width)[:-1])), width) + np.arange(width.sum())
        common = np.bincount(owner[at], minlength=len(sets))
        for j in rest[similar(common[rest], len(own), sizes[rest])]:
            if comp[j] != comp[i]:
                found.append((ids[i], ids[j]))
                comp[comp == comp[j]] = comp[i]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between classes (id, n, bands, sketch) that connect all similar pairs of candidates.

    1. Classes meet in the buckets of their bands; buckets with the same members count once.
    2. In each bucket every member is compared with the smallest one, its hub.
    3. Where a bucket's other members still belong to different components, all pairs across components
       are compared, in blocks, inside tasks. Pairs within a component need no comparison, so the
       blocks of the bucket's largest component meet those of the rest, and never each other.
    So a group of copies of any size costs one comparison per member and per member outside its
    component, and a task returns no more links than it has members.

    Texts are fetched by a merge join at every size: the ids that need one grow with the corpus.
    """
    spark = docs.sparkSession
    rows = classes.select(F.explode("bands").alias("bucket"), "id")
    met = rows.groupBy("bucket").agg(F.min("id").alias("hub"), F.max("id").alias("_last"), F.count(F.lit(1)).alias("members"), F.sum(F.xxhash64("id") % (1 << 40)).alias("_sum"))
    met = met.where("hub < _last").groupBy("hub", "_last", "members", "_sum").agg(F.min("bucket").alias("bucket"))
    multi = saved(rows.join(met.select("bucket", "hub"), "bucket"))

    sketched = classes.select("id", F.struct("n", "sketch").alias("s"))
    pairs = multi.where("id <> hub").select("id", "hub").distinct()
    pairs = pairs.join(sketched, "id").join(sketched.select(F.col("id").alias("hub"), F.col("s").alias("h")), "hub")
    pairs = saved(pairs.where(plausible(F.col("s"), F.col("h"))).select("id", "hub"))

    wanted = multi.select("id").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    texts = saved(texts.join(wanted.hint("merge"), "id", "left_semi").groupBy("id").agg(F.first("text").alias("text")))

    # Stars are cut into parts of about BLOCK members by a hash; every part gets its hub.
    parts = pairs.groupBy("hub").agg((F.count(F.lit(1)) / BLOCK).cast("int").alias("_parts"))
    members = pairs.join(parts, "hub").select("hub", F.pmod(F.xxhash64("id"), F.col("_parts") + 1).cast("int").alias("part"), "id", F.lit(False).alias("is_hub"))
    hubs = parts.select("hub", F.explode(F.sequence(F.lit(0), F.col("_parts"))).alias("part"), F.col("hub").alias("id"), F.lit(True).alias("is_hub"))
    stars = members.unionByName(hubs).join(texts, "id")
    stars = stars.repartition(_few(spark), "hub", "part").sortWithinPartitions("hub", "part", F.desc("is_hub"))
    first = saved(stars.mapInArrow(_linked_to_hubs, "a long, b long"))

    known = components(first).withColumnRenamed("component", "_comp")
    others = multi.where("id <> hub")  # every pair with a hub has been compared
    placed = saved(others.join(known, "id", "left").select("bucket", "id", F.coalesce("_comp", "id").alias("comp")))
    counts = placed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("_n"))
    split = counts.groupBy("bucket").agg(F.max(F.struct("_n", "comp")).alias("_most"), F.sum("_n").alias("_all"), F.count(F.lit(1)).alias("_comps"))
    split = split.where("_comps > 1").select("bucket", "_all", F.col("_most.comp").alias("_main"), F.col("_most._n").alias("_main_n"))
    # The rest's blocks are 0, 1, ...; those of the largest component follow. A small bucket is one block.
    rest = F.when(F.col("_all") <= BLOCK, 1).otherwise(((F.col("_all") - F.col("_main_n")) / BLOCK).cast("int") + 1)
    main = F.when(F.col("_all") <= BLOCK, 0).otherwise((F.col("_main_n") / BLOCK).cast("int") + 1)
    placed = saved(placed.join(split.select("bucket", "_main", rest.alias("_rest"), main.alias("_blocks")), "bucket"))
    inside = (F.col("comp") == F.col("_main")) & (F.col("_blocks") > 0)
    own = F.when(inside, F.col("_rest") + F.pmod(F.xxhash64("id"), F.col("_blocks"))).otherwise(F.pmod(F.xxhash64("id"), F.col("_rest"))).cast("int")
    last = F.col("_rest") + F.when(inside, 0).otherwise(F.col("_blocks")) - 1
    dealt = placed.withColumn("_own", own).select("*", F.explode(F.sequence(F.lit(0), last)).alias("_other")).select(
        "bucket", F.least("_own", "_other").alias("low"), F.greatest("_own", "_other").alias("high"), "id", "comp",
        (F.col("_own") < F.col("_other")).alias("side"), (F.col("_own") == F.col("_other")).alias("same"),
    )
    met = placed.groupBy("id").agg(F.collect_list("bucket").alias("buckets"))  # at most one per band
    dealt = dealt.join(sketched.join(met, "id"), "id").select(*dealt.columns, "s.n", "s.sketch", "buckets")
    keys = ["bucket", "low", "high"]
    dealt = dealt.repartition(_few(spark), *keys)  # small in bytes, but each group is work
    worth = saved(dealt.groupBy(*keys).applyInPandas(_worth_reading, dealt.schema))
    doubtful = worth.join(texts, "id")
    second = doubtful.repartition(_few(spark), *keys).groupBy(*keys).applyInPandas(_linked_in_block, "a long, b long")
    return first.unionByName(saved(second))


def _few(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Documents are linked if 100 * intersection >= 75 * union of their sets of distinct 5-word
    shingles (words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; fewer words make one shingle). Equal
    sets form a class first, so copies cost nothing further. Every link is confirmed on full sets.

    Null or wordless text: an empty set, linked with nothing. Rows with one doc_id are one document.
    A null doc_id is grouped only by equal sets: its component is the smallest doc_id of its class's
    component, or null, and such a row is kept if there is none. Other columns are ignored; an empty
    table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    signed = saved(signatures(docs))
    shared = F.first(F.struct(F.col("n_shingles").alias("n"), "bands", "sketch")).alias("_s")
    classes = signed.where("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").cast("long").alias("id"), shared)
    classes = saved(classes.where("id is not null").select("set_key", "id", "_s.*"))
    found = components(links(docs, classes)).withColumnRenamed("component", "_component")
    reached = classes.join(found, "id", "left").select("set_key", F.coalesce("_component", "id").alias("_component"))
    reached = saved(reached)
    out = spread_lookup(signed.select("doc_id", "n_shingles", "set_key"), reached, ["set_key"], [F.col("doc_id")])
    component = F.coalesce("_component", F.col("doc_id")).alias("component_id")
    out = out.select("doc_id", "n_shingles", component)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
