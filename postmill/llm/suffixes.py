"""Removal of repeated 100-byte strings: suffix arrays by induced sorting over shards of anchored passages."""

from __future__ import annotations


from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.arrays import get, new_folder, put
from postmill.llm.common import give_back, mix, powers, prefix_hash, saved, slices_of, text_or_empty
from postmill.llm.ngrams import _counted, _find, _merged, _ranges

LENGTH = 100
GRAM = 32  # an anchor is the least hash of a 32-byte string within 100 bytes
WINDOW = LENGTH - GRAM + 1
SLICE = 1 << 20
GROUP = 8 << 20  # bytes of text whose passages one group gathers
SHARD = 1 << 19  # bytes of passages in one suffix array; sorting needs about a hundred times as much
PASS_ON = 6 << 20  # bytes of passages that a worker gathers before it passes them on
#: An anchor that occurs more often is split: its 100-byte strings are compared one by one, dealt by their hashes.
HOT = 500

# --- induced sorting ----------------------------------------------------------------------------


def _smaller(s: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their right neighbour; the last one, the sentinel, is."""
    step = np.sign(np.diff(s.astype(np.int32), append=0))
    step[-1] = 1
    at = np.where(step != 0, np.arange(len(s)), len(s) - 1)
    return step[np.minimum.accumulate(at[::-1])[::-1]] > 0


def _induced(s: np.ndarray, smaller: np.ndarray, seeds: list[np.ndarray]) -> np.ndarray:
    """All suffixes in order, induced from the leftmost-smaller ones (``seeds``, per first character, in order).

    Characters are scanned upwards for the larger suffixes, then downwards for the smaller ones. A
    scan takes all suffixes of a character that are known so far at once and appends their left
    neighbours, stably, to the queues of their characters.
    """
    size = len(seeds)
    larger: list[list[np.ndarray]] = [[] for _ in range(size)]

    def spread(items: np.ndarray, wanted: np.ndarray, queues: list[list[np.ndarray]], own: int) -> np.ndarray:
        before = items[items > 0] - 1
        before = before[smaller[before] == wanted]
        first = s[before]
        here = first == own
        again, other = before[here], ~here
        before, first = before[other], first[other]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        cut = np.flatnonzero(first[1:] != first[:-1]) + 1
        for part, c in zip(np.split(before, cut), first[np.concatenate(([0], cut))].tolist() if len(first) else [], strict=False):
            queues[c].append(part)
        return again

    for c in range(size):
        done = 0
        while done < len(larger[c]):
            batch = np.concatenate(larger[c][done:])
            done = len(larger[c])
            again = spread(batch, False, larger, c)
            if len(again):
                larger[c].append(again)
        if len(seeds[c]):
            spread(seeds[c], False, larger, c)
    down: list[list[np.ndarray]] = [[] for _ in range(size)]
    down[0].append(np.array([len(s) - 1], dtype=np.int32))
    for c in range(size - 1, -1, -1):
        done = 0
        while done < len(down[c]):
            batch = np.concatenate(down[c][done:])
            done = len(down[c])
            again = spread(batch, True, down, c)
            if len(again):
                down[c].append(again)
        if larger[c]:
            spread(np.concatenate(larger[c])[::-1], True, down, c)
    out = []
    for c in range(size):
        out += larger[c]
        out += [p[::-1] for p in down[c][::-1]]
    return np.concatenate(out)


def _seeds(s: np.ndarray, positions: np.ndarray, size: int) -> list[np.ndarray]:
    first = s[positions]
    order = np.argsort(first, kind="stable")
    return np.split(positions[order], np.searchsorted(first[order], np.arange(1, size)))


def suffix_array(s: np.ndarray, size: int, depth: int = LENGTH) -> np.ndarray:
    """The suffix array of ``s`` (characters below ``size``, the last one 0 and the only 0).

    Suffixes that agree in their first ``depth`` characters may stand in any order. Leftmost-smaller
    substrings are sorted by one induction and named; the string of names, which has up to a third of
    the length but a large alphabet, is ranked by doubling; a second induction gives the array.
    """
    smaller = _smaller(s)
    leftmost = (np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1).astype(np.int32)
    if len(leftmost) > 1:
        order = _induced(s, smaller, _seeds(s, leftmost, size))
        mark = np.zeros(len(s), dtype=bool)
        mark[leftmost] = True
        order = order[mark[order]]
        follow = np.append(leftmost[1:], leftmost[-1]) + 1  # each substring ends with the next one's first character
        sums, down = _plain_hash(s), powers(len(s) + 1)[1]
        number = np.zeros(len(s), dtype=np.int32)
        number[leftmost] = np.arange(len(leftmost))
        k = number[order]
        name_hash = mix((sums[follow[k]] - sums[order]) * down[order] + (follow[k] - order).astype(np.uint64))
        names = np.empty(len(leftmost), dtype=np.int64)
        names[k] = np.concatenate(([0], np.cumsum(name_hash[1:] != name_hash[:-1])))
        leftmost = leftmost[_ranked(names, depth)]
    return _induced(s, smaller, _seeds(s, leftmost, size))


def _plain_hash(s: np.ndarray) -> np.ndarray:
    up, _ = powers(len(s) + 1)
    out = np.zeros(len(s) + 1, dtype=np.uint64)
    np.cumsum(mix(s.astype(np.uint64) + np.uint64(7)) * up[: len(s)], out=out[1:])
    return out


def _ranked(names: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of a string of names in order, up to ``depth`` names, by doubling the compared length."""
    rank, h = names, 1
    while True:
        order = np.argsort(rank, kind="stable")
        if h >= depth or rank[order[-1]] == len(rank) - 1:
            return order
        shifted = np.concatenate((rank[h:] + 1, np.zeros(min(h, len(rank)), dtype=np.int64)))[: len(rank)]
        key = rank * (len(rank) + 1) + shifted
        order = np.argsort(key, kind="stable")
        rank = np.empty_like(rank)
        rank[order] = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        h *= 2


def common_prefixes(data: np.ndarray, order: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """In text order: does a suffix share its first 100 characters with the one before it in the array?

    This is the permuted common-prefix array cut at 100, as that is all that removal needs.
    ``inside`` says where 100 characters lie within one passage.
    """
    before = np.full(len(data), -1, dtype=np.int32)
    before[order[1:]] = order[:-1]
    sums, down = _plain_hash(data), powers(len(data) + 1)[1]
    hashes = np.zeros(len(data), dtype=np.uint64)
    whole = np.flatnonzero(inside).astype(np.int32)
    hashes[whole] = mix((sums[whole + LENGTH] - sums[whole]) * down[whole])
    return inside & (before >= 0) & inside[before] & (hashes == hashes[before])


# --- anchors ------------------------------------------------------------------------------------


def _sliding(op: np.ufunc, x: np.ndarray, w: int, fill: int) -> np.ndarray:
    """op over every w neighbours, from running values of blocks in both directions."""
    padded = np.full(-(-len(x) // w) * w, fill, dtype=x.dtype)
    padded[: len(x)] = x
    blocks = padded.reshape(-1, w)
    ahead = op.accumulate(blocks, axis=1).ravel()
    behind = np.ascontiguousarray(op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1]).ravel()
    n = len(x) - w + 1
    return op(behind[:n], ahead[w - 1 : w - 1 + n])


def _anchors(raw: list[bytes]) -> tuple[np.ndarray, ...]:
    """(bytes, begins of texts, their ends, positions of anchors, anchors' hashes, anchors' texts).

    A position is an anchor if its 32-byte string has the least hash of some 100 bytes around it. The
    choice depends on these bytes alone, so equal 100-byte strings hold equal anchors.
    """
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    size = np.array([len(t) for t in raw], dtype=np.int64)
    end = np.cumsum(size)
    none = np.zeros(0, dtype=np.int64)
    if len(data) < LENGTH:
        return data, end - size, end, none, none.astype(np.uint64), none
    sums, down = prefix_hash(data), powers(len(data) + 1)[1]
    n = len(data) - GRAM + 1
    grams = mix((sums[GRAM:] - sums[:n]) * down[:n])
    least = _sliding(np.minimum, grams, WINDOW, np.iinfo(np.uint64).max)
    padded = np.concatenate((np.zeros(WINDOW - 1, dtype=np.uint64), least, np.zeros(WINDOW - 1, dtype=np.uint64)))
    at = np.flatnonzero(_sliding(np.maximum, padded, WINDOW, 0) == grams)
    text = np.searchsorted(end, at, "right")
    keep = (at + GRAM <= end[text]) & (size[text] >= LENGTH)
    at, text = at[keep], text[keep]
    return data, end - size, end, at, grams[at], text


def _ordered(docs: DataFrame) -> DataFrame:
    """(ord, doc_id, text): ``ord`` is unique and in the order of doc_id, nulls last, then of the text."""
    plain = docs.select("doc_id", "text")
    found = plain.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.count(F.when(F.col("doc_id").isNull(), 1))).first()
    whole = dict(plain.dtypes)["doc_id"] in ("bigint", "int", "smallint", "tinyint")
    if whole and (found[0] or 0) <= 1 and not found[1]:
        return plain.select(F.col("doc_id").cast("long").alias("ord"), "doc_id", "text")
    return saved(plain.orderBy(F.asc_nulls_last("doc_id"), "text").select(F.monotonically_increasing_id().alias("ord"), "doc_id", "text"))


def _repeated_anchors(texts: DataFrame, folder: str, buckets: int) -> None:
    """Write the anchors that occur twice or more: sorted hashes and counts, per bucket."""

    def keys():
        return (lambda raw: _anchors(raw)[4]), (lambda k: (k % np.uint64(buckets)).astype(np.int32))

    def write(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        hashes, counts = _merged(frame)
        put(folder, f"anchors-{key[0]}", hashes[counts > 1])
        put(folder, f"times-{key[0]}", counts[counts > 1].astype("<i8"))
        return pd.DataFrame({"bucket": [int(key[0])], "n": [int((counts > 1).sum())]})

    have = {r["bucket"] for r in saved(_counted(texts, keys).repartition(buckets, "bucket").groupBy("bucket").applyInPandas(write, "bucket int, n long")).collect()}
    for bucket in set(range(buckets)) - have:
        put(folder, f"anchors-{bucket}", np.zeros(0, dtype="<u8"))
        put(folder, f"times-{bucket}", np.zeros(0, dtype="<i8"))


_PASSAGE = np.dtype([("hash", "<u8"), ("content", "<u8"), ("ord", "<i8"), ("begin", "<i8"), ("size", "<i4")])
_PLACE = np.dtype([("hash", "<u8"), ("more", "<u8"), ("ord", "<i8"), ("begin", "<i8")])
_SHARDS = "shard int, kind int, places binary, text binary"


def _first_of_each(keys: list[np.ndarray], places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indices of the earliest place of each key, indices of all later ones)."""
    order = np.lexsort((places["begin"], places["ord"], *keys))
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    return order[new], order[~new]


def _passages(texts: DataFrame, folder: str, buckets: int, shards: int) -> DataFrame:
    """Passages around repeated anchors, dealt to shards by the anchor; copies within a slice are settled here.

    A passage holds every 100-byte string around its anchor. Of equal passages only the earliest is
    passed on, the later ones are removed whole (kind 2). The strings of hot anchors are passed on
    one by one as hashes of 128 bits (kind 1), the earliest of each.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, np.ndarray] = {}
        passages, content_of, alone, gone, gathered = [], [], [], [], 0

        def rows() -> pa.RecordBatch:
            out = []
            texts_ = [t for part in content_of for t in part]
            for kind, parts in ((0, passages), (1, alone), (2, gone)):
                items = np.concatenate(parts) if parts else np.zeros(0, dtype=_PASSAGE)
                # What is settled needs no partner and goes by its text, so that no anchor gathers its copies.
                own = items["hash"] if kind < 2 else mix(items["ord"].astype(np.uint64))
                shard = (own % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                for s, (i, j) in _ranges(shard[order]):
                    out.append((s, kind, items[order[i:j]].tobytes(), b"".join(texts_[k] for k in order[i:j].tolist()) if kind == 0 else b""))
            for parts in (passages, content_of, alone, gone):
                parts.clear()
            columns = [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "kind", "places", "text"])

        def array(name: str, dtype: str) -> np.ndarray:
            if name not in known:
                known[name] = get(folder, name, dtype)
            return known[name]

        for batch in batches:
            ords = batch.column(0).to_numpy()
            for part, raw in slices_of(batch.column(1), SLICE):
                data, first, end, at, hashes, text = _anchors(raw)
                times = np.zeros(len(at), dtype=np.int64)
                bucket = (hashes % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort((hashes, bucket))
                for b, (i, j) in _ranges(bucket[order]):
                    keys = array(f"anchors-{b}", "<u8")
                    if len(keys):
                        where, hit = _find(keys, hashes[order[i:j]])
                        times[order[i:j][hit]] = array(f"times-{b}", "<i8")[where[hit]]
                some = times > 1
                at, hashes, text, times = at[some], hashes[some], text[some], times[some]
                if not len(at):
                    continue
                low, high = np.maximum(at + GRAM - LENGTH, first[text]), np.minimum(at + LENGTH, end[text])
                own = np.zeros(len(at), dtype=_PASSAGE)
                own["hash"], own["ord"], own["begin"], own["size"] = hashes, ords[part][text], low - first[text], high - low
                sums, down = prefix_hash(data), powers(len(data) + 1)[1]
                content = mix((sums[high] - sums[low]) * down[low] + (high - low).astype(np.uint64))
                own["content"] = content
                early, late = _first_of_each([content, hashes], own)
                gone.append(own[late])
                calm = early[times[early] <= HOT]
                passages.append(own[calm])
                content_of.append([data[a:b].tobytes() for a, b in zip(low[calm].tolist(), high[calm].tolist(), strict=True)])
                gathered += int(own["size"][calm].sum()) + 20 * len(late)
                hot = early[times[early] > HOT]
                if len(hot):
                    count = high[hot] - low[hot] - LENGTH + 1
                    which = np.repeat(hot, count)
                    start = low[which] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    start, keep = np.unique(start, return_index=True)
                    strings = np.zeros(len(start), dtype=_PLACE)
                    plain = (sums[start + LENGTH] - sums[start]) * down[start]
                    strings["hash"], strings["ord"], strings["begin"] = mix(plain), own["ord"][which[keep]], start - first[text[which[keep]]]
                    strings["more"] = _second_hash(data, start)
                    early_, late_ = _first_of_each([strings["more"], strings["hash"]], strings)
                    more = np.zeros(len(late_), dtype=_PASSAGE)
                    more["hash"], more["ord"], more["begin"], more["size"] = strings["hash"][late_], strings["ord"][late_], strings["begin"][late_], LENGTH
                    gone.append(more)
                    alone.append(strings[early_])
                    gathered += 32 * len(early_) + 20 * len(late_)
                if gathered >= PASS_ON:
                    yield rows()
                    gathered = 0
        if gathered:
            yield rows()

    return texts.select("ord", "text").mapInArrow(cut, _SHARDS)


def _second_hash(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Another hash of 100-byte strings: of their bytes eight by eight, read as numbers."""
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    out = np.zeros(len(start), dtype=np.uint64)
    for offset in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + np.ascontiguousarray(words[start + offset]).view("<u8").ravel())
    return out


def _intervals(ords: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pd.DataFrame:
    """Byte ranges of each text, with those that touch or overlap merged."""
    order = np.lexsort((begin, ords))
    ords, begin, end = ords[order], begin[order], end[order]
    if len(ords):
        top = int(end.max()) + 1
        text = np.cumsum(np.concatenate(([0], ords[1:] != ords[:-1])))
        reach = np.maximum.accumulate(text * top + end)
        new = np.concatenate(([True], (text * top + begin)[1:] > reach[:-1]))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(ords)) - 1
        ords, begin, end = ords[first], begin[first], reach[last] - text[last] * top
    return pd.DataFrame({"ord": ords.astype(np.int64), "begin": begin.astype(np.int64), "end": end.astype(np.int64)})


def _settled(frame: pd.DataFrame) -> pd.DataFrame:
    """One shard: which bytes have an earlier copy within the shard's passages."""
    found = [np.zeros((3, 0), dtype=np.int64)]
    by_kind = {k: f for k, f in frame.groupby("kind")}
    if 2 in by_kind:
        gone = np.concatenate([np.frombuffer(p, dtype=_PASSAGE) for p in by_kind[2]["places"]])
        found.append(np.stack([gone["ord"], gone["begin"], gone["begin"] + gone["size"]]))
    if 1 in by_kind:
        strings = np.concatenate([np.frombuffer(p, dtype=_PLACE) for p in by_kind[1]["places"]])
        _, late = _first_of_each([strings["more"], strings["hash"]], strings)
        found.append(np.stack([strings["ord"][late], strings["begin"][late], strings["begin"][late] + LENGTH]))
    if 0 in by_kind:
        places = np.concatenate([np.frombuffer(p, dtype=_PASSAGE) for p in by_kind[0]["places"]])
        data = np.frombuffer(b"".join(by_kind[0]["text"]), dtype=np.uint8)
        size = places["size"].astype(np.int64)
        begin = np.cumsum(size) - size
        early, late = _first_of_each([places["content"], places["hash"]], places)
        found.append(np.stack([places["ord"][late], places["begin"][late], places["begin"][late] + size[late]]))
        # Anchors that have one passage left need no array.
        _, where, times = np.unique(places["hash"][early], return_inverse=True, return_counts=True)
        early = early[times[where] > 1]
        shards = int(size[early].sum()) // SHARD + 1
        shard = mix(places["hash"][early]) % np.uint64(shards)
        for k in range(shards):
            own = early[shard == k]
            if len(own):
                found.append(_by_suffixes(data, begin[own], places[own]))
                give_back()
    whole = np.concatenate(found, axis=1)
    give_back()
    return _intervals(*whole)


def _by_suffixes(data: np.ndarray, begin: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Ranges of passages whose 100-byte strings start earlier elsewhere, from the shard's suffix array."""
    size = places["size"].astype(np.int64)
    width = size + 1  # a separator after each passage
    at = np.cumsum(width) - width
    s = np.ones(int(width.sum()) + 1, dtype=np.int16)
    offset = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    s[np.repeat(at, size) + offset] = data[np.repeat(begin, size) + offset].astype(np.int16) + 2
    s[-1] = 0
    inside = np.zeros(len(s), dtype=bool)
    starts = np.repeat(at, size) + offset
    inside[starts[offset <= np.repeat(size, size) - LENGTH]] = True
    order = suffix_array(s, 258)
    same = common_prefixes(s, order, inside)
    order = order[inside[order]]
    _, text = np.unique(places["ord"], return_inverse=True)
    passage = np.searchsorted(at, order, "right") - 1
    # text and place as one number, so that the earliest of a class is a minimum
    when = (text[passage].astype(np.uint64) << np.uint64(40)) + (places["begin"][passage] + order - at[passage]).astype(np.uint64)
    first = np.flatnonzero(~same[order])
    least = np.repeat(np.minimum.reduceat(when, first), np.diff(np.append(first, len(order))))
    gone = when > least
    passage, start = passage[gone], (places["begin"][passage] + order - at[passage])[gone]
    return np.stack([places["ord"][passage], start, start + LENGTH])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes) for every row of ``docs``.

    Removed is each byte of a 100-byte string that also starts earlier: in a smaller doc_id, or
    earlier in the same document. Strings are judged on the input.

    1. Anchors are picked from all texts and counted; those that occur once need no more work.
    2. Passages around repeated anchors are dealt to groups by the anchor, and so to shards
       within them, so all copies of a 100-byte string meet in a shard. Equal passages collapse first.
    3. In shards of about SHARD bytes, suffix arrays are induced, and neighbours that share 100 bytes form classes, of
       which the earliest place stays.
    4. The ranges found are merged per document and cut out.

    Null text is empty. Rows with equal doc_id are separate documents, in the order of their texts; null
    ids come last. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    texts = _ordered(docs)
    size = texts.agg(F.sum(F.octet_length(text_or_empty()))).first()[0] or 0
    folder = new_folder(spark, "anchors")
    buckets = max(8, size // (16 << 20) + 1)
    shards = max(8, size // GROUP + 1)
    _repeated_anchors(texts, folder, buckets)
    ranges = saved(_passages(texts, folder, buckets, shards).repartition(shards, "shard").groupBy("shard").applyInPandas(_settled, "ord long, begin long, end long"))
    per_text = ranges.groupBy("ord").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    joined = texts.join(per_text, "ord", "left").select("doc_id", "text", "ranges.begin", "ranges.end")
    schema = docs.select("doc_id").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw in slices_of(batch.column(1)):
                own = batch.slice(part.start, part.stop - part.start)
                removed, spans, kept = [], [], []
                for text, begin, end in zip(raw, own.column(2), own.column(3), strict=True):
                    if not begin.is_valid:
                        removed.append(0)
                        spans.append(0)
                        kept.append(text)
                        continue
                    cut = _intervals(np.zeros(len(begin), dtype=np.int64), begin.values.to_numpy(), end.values.to_numpy())
                    left, at = [], 0
                    for a, b in zip(cut["begin"].tolist(), cut["end"].tolist(), strict=True):
                        left.append(text[at:a])
                        at = b
                    left.append(text[at:])
                    kept.append(b"".join(left))
                    removed.append(len(text) - len(kept[-1]))
                    spans.append(len(cut))
                numbers = [pa.array(v, pa.int64()) for v in ([len(t) for t in raw], removed, spans)]
                yield pa.RecordBatch.from_arrays([own.column(0), *numbers, pa.array(kept, pa.binary())], names=schema.names)

    return joined.mapInArrow(apply, schema)
