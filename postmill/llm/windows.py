"""Removal of repeated windows of words: merged count-min sketches as prefilter, exact grouping of what they leave."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postmill.llm.arrays import get, new_folder, put
from postmill.llm.common import give_back, mix, powers, saved, slices_of, text_or_empty, word_hashes
from postmill.llm.suffixes import _first_of_each, _intervals, _ordered, _ranges

SLICE = 4 << 20  # bytes of text that a partial sketch counts
SEGMENT = 16 << 20  # bytes of text for each segment of the sketch, about 2.6 million windows
COLUMNS = 1 << 23  # counters of a segment in each of the sketch's two rows
GROUP = 16 << 20  # bytes of text whose repeated windows one group compares
FLUSH = 600_000  # windows that a worker gathers before it passes them on

_PLACE = np.dtype([("hash", "<u8"), ("more", "<u8"), ("ord", "<i8"), ("begin", "<i8")])
_SPAN = np.dtype([("ord", "<i8"), ("begin", "<i8"), ("end", "<i8")])
_SALTS = (np.uint64(0x3C6EF372FE94F82B), np.uint64(0xA54FF53A5F1D36F1))

# --- windows ------------------------------------------------------------------------------------


def _rolled(words: np.ndarray, size: int, at: np.ndarray) -> np.ndarray:
    """Hashes of the windows that start at ``at``."""
    up, down = powers(len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up[: len(words)], out=sums[1:])
    return mix((sums[at + size] - sums[at]) * down[at])


class Windows:
    """All windows of a slice of texts: where they start, their texts and their hashes."""

    def __init__(self, raw: list[bytes], size: int) -> None:
        self.words, counts = word_hashes(raw, lower=False)
        self.size = size
        text = np.repeat(np.arange(len(raw)), counts)
        n = max(len(self.words) - size + 1, 0)
        self.at = np.flatnonzero(text[:n] == text[size - 1 :][:n])
        self.text = text[self.at]
        self.begin = self.at - (np.cumsum(counts) - counts)[self.text]
        self.hash = _rolled(self.words, size, self.at)

    def second_hash(self, chosen: np.ndarray) -> np.ndarray:
        return _rolled(mix(self.words ^ np.uint64(0x9B05688C2B3E6C1F)), self.size, self.at[chosen])

    def cells(self, row: int, segments: int) -> np.ndarray:
        """The counter of each window in one row of the sketch: its segment, then its column there."""
        return (self.hash % np.uint64(segments)) * np.uint64(COLUMNS) + mix(self.hash ^ _SALTS[row]) % np.uint64(COLUMNS)


def _slice_key(first: int, cells: np.ndarray) -> int:
    """Names a slice by its first text and the counters it touches, so that no other slice is taken for it."""
    digest = hashlib.blake2b(cells.tobytes(), digest_size=8, salt=int(first).to_bytes(8, "little", signed=True))
    return int.from_bytes(digest.digest(), "little", signed=True)


def _planes(values: np.ndarray) -> bytes:
    """Rising numbers as their steps, all low bytes first: the high ones are mostly zero and compress."""
    steps = np.diff(values.astype(np.int64), prepend=0).astype("<u4")
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()
    return np.cumsum(steps.astype(np.int64))


# --- sketch -------------------------------------------------------------------------------------


def _partial_sketches(texts: DataFrame, size: int, segments: int) -> DataFrame:
    """Per slice and segment: the counters that its windows touch, in both rows, and which of them twice or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ords = batch.column(0).to_numpy()
            for part, raw in slices_of(batch.column(1), SLICE):
                windows, touched = Windows(raw, size), []
                for row in range(2):
                    cells, times = np.unique(windows.cells(row, segments), return_counts=True)
                    if row == 0:
                        key = _slice_key(ords[part][0], cells)
                    marked = ((cells % np.uint64(COLUMNS)) << np.uint64(1)) | (times > 1)
                    touched.append({s: _planes(marked[i:j]) for s, (i, j) in _ranges(cells // np.uint64(COLUMNS))})
                if touched[0]:
                    names = sorted(touched[0])
                    columns = [pa.array(names, pa.int32()), pa.array([key] * len(names), pa.int64())]
                    columns += [pa.array([t[s] for s in names], pa.binary()) for t in touched]
                    yield pa.RecordBatch.from_arrays(columns, names=["segment", "slice", "first", "second"])

    return texts.select("ord", "text").mapInArrow(count, "segment int, slice long, first binary, second binary")


def _merged(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """One segment of the merged sketch, told back to each slice: which of the counters it touched reach two."""
    out = {"slice": frame["slice"], "segment": frame["segment"]}
    for name in ("first", "second"):
        counters = np.zeros(COLUMNS, dtype=np.uint8)
        for data in frame[name]:
            marked = _from_planes(data)
            columns = marked >> 1
            counters[columns] = np.minimum(counters[columns] + 1 + (marked & 1), 2)
        told = [counters[_from_planes(data) >> 1] > 1 for data in frame[name]]
        out[f"n_{name}"], out[name] = [len(t) for t in told], [np.packbits(t).tobytes() for t in told]
    give_back()
    return pd.DataFrame(out)


_TOLD = "slice long, segment int, n_first int, first binary, n_second int, second binary"


def _write_answers(folder: str):
    """Write what all segments tell one slice to a file of its own: two numbers, then the bits of both rows."""

    def write(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("segment")
        rows = []
        for name in ("first", "second"):
            bits = [np.unpackbits(np.frombuffer(b, dtype=np.uint8), count=n) for b, n in zip(frame[name], frame[f"n_{name}"], strict=True)]
            rows.append(np.concatenate(bits))
        sizes = np.array([len(r) for r in rows], dtype="<i8").view(np.uint8)
        put(folder, f"slice-{key[0]}", np.concatenate([sizes, *(np.packbits(r) for r in rows)]))
        return pd.DataFrame({"slice": [key[0]]})

    return write


def _may_repeat(windows: Windows, folder: str, segments: int, first: int) -> np.ndarray:
    """Which windows the merged sketch estimates to occur twice or more: both of their counters reach two.

    Where a slice is cut otherwise than when it was counted there is no answer, and all its windows go on.
    """
    cells = [np.unique(windows.cells(row, segments), return_inverse=True) for row in range(2)]
    try:
        answer = np.asarray(get(folder, f"slice-{_slice_key(first, cells[0][0])}", "u1"))
    except FileNotFoundError:
        return np.ones(len(windows.at), dtype=bool)
    sizes = np.frombuffer(answer[:16].tobytes(), dtype="<i8").tolist()
    middle = 16 + -(-sizes[0] // 8)
    out = np.ones(len(windows.at), dtype=bool)
    for bits, n, (own, inverse) in zip((answer[16:middle], answer[middle:]), sizes, cells, strict=True):
        if n == len(own):
            out &= np.unpackbits(bits, count=n).astype(bool)[inverse]
    return out


# --- exact grouping -----------------------------------------------------------------------------


def _candidates(texts: DataFrame, size: int, folder: str, segments: int, groups: int) -> DataFrame:
    """Windows estimated repeated, the earliest of each kind in what a worker gathers; later ones are settled.

    Windows (kind 0) go to groups by their hashes, settled ranges (kind 1) by their texts.
    """

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[np.ndarray] = []

        def rows() -> pa.RecordBatch:
            places = np.concatenate(gathered)
            gathered.clear()
            early, late = _first_of_each([places["more"], places["hash"]], places)
            early, late = places[early], _spans(places[late], size)
            out = []
            for kind, items, key in ((0, early, early["hash"]), (1, late, mix(late["ord"].astype(np.uint64)))):
                group = (key % np.uint64(groups)).astype(np.int64)
                order = np.argsort(group, kind="stable")
                out += [(g, kind, items[order[i:j]].tobytes()) for g, (i, j) in _ranges(group[order])]
            columns = [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, names=["group", "kind", "items"])

        for batch in batches:
            ords = batch.column(0).to_numpy()
            for part, raw in slices_of(batch.column(1), SLICE):
                windows = Windows(raw, size)
                if not len(windows.at):
                    continue
                chosen = np.flatnonzero(_may_repeat(windows, folder, segments, ords[part][0]))
                own = np.empty(len(chosen), dtype=_PLACE)
                own["hash"], own["more"] = windows.hash[chosen], windows.second_hash(chosen)
                own["ord"], own["begin"] = ords[part][windows.text[chosen]], windows.begin[chosen]
                gathered.append(own)
                if sum(map(len, gathered)) >= FLUSH:
                    yield rows()
        if gathered:
            yield rows()

    return texts.select("ord", "text").mapInArrow(choose, "group int, kind int, items binary")


def _spans(places: np.ndarray, size: int) -> np.ndarray:
    """Ranges of words that windows cover, by text, with those that touch merged."""
    merged = _intervals(places["ord"], places["begin"], places["begin"] + size)
    out = np.empty(len(merged), dtype=_SPAN)
    for name in _SPAN.names:
        out[name] = merged[name]
    return out


def _settled(size: int, groups: int):
    """Of equal windows the earliest stays; the ranges of all later ones go on by their texts."""

    def settle(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        spans = [np.frombuffer(d, dtype=_SPAN) for d in frame["items"][frame["kind"] == 1]]
        found = [np.frombuffer(d, dtype=_PLACE) for d in frame["items"][frame["kind"] == 0]]
        if found:
            places = np.concatenate(found)
            spans.append(_spans(places[_first_of_each([places["more"], places["hash"]], places)[1]], size))
        every = np.concatenate(spans)
        group = (mix(every["ord"].astype(np.uint64)) % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        out = [(g, every[order[i:j]].tobytes()) for g, (i, j) in _ranges(group[order])]
        give_back()
        return pd.DataFrame(out, columns=["group", "items"])

    return settle


def _per_text(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    every = np.concatenate([np.frombuffer(d, dtype=_SPAN) for d in frame["items"]])
    merged = _intervals(every["ord"], every["begin"], every["end"])
    both = np.stack([merged["begin"], merged["end"]], axis=1)
    out = [(o, both[i:j].tobytes()) for o, (i, j) in _ranges(merged["ord"].to_numpy())]
    return pd.DataFrame(out, columns=["ord", "ranges"])


def remove_repeats(docs: DataFrame, size: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed, kept (string) for every row of ``docs``.

    Removed is each word of a window of ``size`` words that also starts earlier: in a smaller doc_id, or earlier
    in the same document. Windows are judged on the input, and never cross documents.

    1. Every slice of texts makes a partial count-min sketch of its windows: two rows of counters, in segments.
    2. Segments are merged, each in one group, and tell every slice which of its counters reach two. Sketch and answers
       grow with the text and are dealt out with it; no worker holds more than a segment, or the answer to one slice.
    3. A second pass over the texts takes the windows whose counters both reach two. That is every repeated window, as a
       sketch never counts too little, and a few others.
    4. These are grouped exactly, by 128 bits of two hashes of their words; the earliest of each stays.
       A frequent window costs a group one entry per ``FLUSH`` windows of a task. There are as many partitions as groups.
    5. The ranges found are merged per document and cut out.

    Two windows are taken for equal if both 64-bit hashes agree: 1e-38 for each pair of windows, and 5e-20 for
    each pair of words that a shared hash could confuse.

    Null text has no words. Rows with equal doc_id are separate documents, in the order of their texts; null ids
    come last. An empty table gives no rows; other columns are ignored, whatever their names.
    """
    texts = _ordered(docs)
    n_bytes = texts.agg(F.sum(F.octet_length(text_or_empty()))).first()[0] or 0
    segments, groups = n_bytes // SEGMENT + 8, n_bytes // GROUP + 8
    folder = new_folder(docs.sparkSession, "sketch")
    told = _partial_sketches(texts, size, segments).repartition(segments, "segment").groupBy("segment").applyInPandas(_merged, _TOLD)
    told.repartition(groups, "slice").groupBy("slice").applyInPandas(_write_answers(folder), "slice long").agg(F.count("slice")).first()
    chosen = _candidates(texts, size, folder, segments, groups)
    settled = chosen.repartition(groups, "group").groupBy("group").applyInPandas(_settled(size, groups), "group int, items binary")
    ranges = saved(settled.repartition(groups, "group").groupBy("group").applyInPandas(_per_text, "ord long, ranges binary"))
    joined = texts.join(ranges, "ord", "left").select("doc_id", "text", "ranges")
    schema = StructType([*docs.select("doc_id").schema, *StructType.fromDDL("n_words long, n_removed long, kept string")])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw in slices_of(batch.column(1)):
                own = batch.slice(part.start, part.stop - part.start)
                n_words, removed, kept = [], [], []
                for text, data in zip(raw, own.column(2).to_pylist(), strict=True):
                    words = text.split()
                    left, at = [], 0
                    for begin, end in np.frombuffer(data or b"", dtype="<i8").reshape(-1, 2).tolist():
                        left += words[at:begin]
                        at = end
                    left += words[at:]
                    n_words.append(len(words))
                    removed.append(len(words) - len(left))
                    kept.append(b" ".join(left))
                numbers = [pa.array(v, pa.int64()) for v in (n_words, removed)]
                yield pa.RecordBatch.from_arrays([own.column(0), *numbers, pa.array(kept, pa.binary()).cast(pa.string())], names=schema.names)

    return joined.mapInArrow(apply, schema)
