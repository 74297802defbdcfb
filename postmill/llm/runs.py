"""Periodic runs of words: Lyndon arrays under both orders by Baier's grouping, roots extended through common extensions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from postmill.llm.common import mix, powers, slices_of, word_hashes

SLICE = 4 << 20  # bytes of text that a worker handles at once

# --- grouping -----------------------------------------------------------------------------------


def lyndon_array(ranks: Sequence[int], size: int) -> list[int]:
    """Length of the longest Lyndon word that starts at each place; characters are ranks below ``size``.

    This is the first phase of Baier's suffix sorter. Suffixes are grouped by a common prefix, at first
    their first character. Groups are taken from the greatest down. Every suffix of the group names the
    nearest suffix before it that is still in a lower group, and those named are moved out of
    their group into one right above it, one per number of times named, with a prefix that much
    longer. When a group is taken, its prefix is the longest Lyndon word of its suffixes.
    """
    n = len(ranks)
    group = list(ranks)
    members: list[list[int]] = [[] for _ in range(size)]
    for i, c in enumerate(ranks):
        members[c].append(i)
    length = [1] * size
    above, below = [*range(1, size), -1], list(range(-1, size - 1))
    taken, jump, out = bytearray(n), list(range(-1, n - 1)), [0] * n
    g = size - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        members[g] = []
        width = length[g]
        for i in own:
            taken[i] = 1
            out[i] = width
        named: dict[int, int] = {}
        for i in own:
            j = jump[i]
            while j >= 0 and taken[j]:
                j = jump[j]
            k = i
            while jump[k] != j:  # what was passed is never open again
                jump[k], k = j, jump[k]
            if j >= 0:
                named[j] = named.get(j, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for j, times in named.items():
            moved.setdefault((times, group[j]), []).append(j)
        for times, old in sorted(moved, reverse=True):
            new, places = len(length), moved[times, old]
            length.append(length[old] + times * width)
            members.append(places)
            above.append(above[old])
            below.append(old)
            if above[old] >= 0:
                below[above[old]] = new
            above[old] = new
            for j in places:
                group[j] = new
        g = below[g]
    return out


# --- runs ---------------------------------------------------------------------------------------


def _reach(sums: np.ndarray, one: np.ndarray, two: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
    """How many characters agree from ``one`` and ``two`` on (one < two), or before them, up to ``most``; by bisection over hashes."""
    _, down = powers(len(sums))
    low, high = np.zeros_like(most), most.copy()
    while (open_ := low < high).any():
        middle = (low + high + 1) // 2
        a, b = (one - middle, two - middle) if back else (one, two)
        equal = (sums[a + middle] - sums[a]) * down[a] == (sums[b + middle] - sums[b]) * down[b]
        low = np.where(open_ & equal, middle, low)
        high = np.where(open_ & ~equal, middle - 1, high)
    return low


def find_runs(s: np.ndarray, least: int = 12) -> np.ndarray:
    """(start, length, period) of every maximal run with at least two periods and ``least`` characters, in order.

    ``s`` holds ranks. The root of a run is the longest Lyndon word at some place of it in one of the
    two orders of the alphabet, so extending all Lyndon words of both orders finds all runs. Characters are
    compared through 64-bit hashes, about 40 comparisons per character: a chance of 2e-18 each for a wrong one.
    """
    n, size = len(s), int(s.max()) + 1 if len(s) else 0
    if n < least:
        return np.zeros((0, 3), dtype=np.int64)
    up, _ = powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(mix(s.astype(np.uint64) + np.uint64(7)) * up[:n], out=sums[1:])
    found = []
    for ranks in (s, size - 1 - s):
        p = np.array(lyndon_array(ranks.tolist(), size), dtype=np.int64)
        i = np.arange(n)
        right = _reach(sums, i, np.minimum(i + p, n), n - i - p, False)
        left = _reach(sums, i, i + p, i, True)
        run = np.stack([i - left, left + p + right, p], axis=1)
        found.append(run[run[:, 1] >= np.maximum(least, 2 * p)])
    runs = np.unique(np.concatenate(found), axis=0)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _worth(words: np.ndarray, text: np.ndarray, gram: int) -> np.ndarray:
    """Words covered by ``gram`` words that come twice in one text; no other word can lie in a run.

    A run of length L and period q has L - q >= max(least - q, q) >= least / 2, so with grams of that
    size its first L - q words are covered by grams that come again q words on, and its last ones by these.
    """
    n = len(words) - gram + 1
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    if n > 0:
        up, down = powers(len(words) + 1)
        sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(words * up[: len(words)], out=sums[1:])
        at = np.flatnonzero(text[:n] == text[gram - 1 :])
        keys = mix((sums[at + gram] - sums[at]) * down[at]) ^ mix(text[at].astype(np.uint64) + np.uint64(1))
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(at), dtype=bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        np.add.at(cover, at[twice], 1)
        np.add.at(cover, at[twice] + gram, -1)
    return np.cumsum(cover[:-1]) > 0


def runs_of_texts(raw: list[bytes], least: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(runs, the text of each, number of words of each text); by text, start and period.

    All stretches of words that may hold a run are searched at once, each followed by a character of its own.
    """
    words, counts = word_hashes(raw, lower=False)
    text = np.repeat(np.arange(len(raw)), counts)
    at = np.flatnonzero(_worth(words, text, (least + 1) // 2))
    if not len(at):
        return np.zeros((0, 3), dtype=np.int64), np.zeros(0, dtype=np.int64), counts
    stretch = np.cumsum(np.concatenate(([0], (at[1:] != at[:-1] + 1) | (text[at[1:]] != text[at[:-1]]))))
    place = np.arange(len(at)) + stretch
    distinct, ranks = np.unique(words[at], return_inverse=True)
    s = np.empty(len(at) + int(stretch[-1]) + 1, dtype=np.int64)
    s[place] = ranks
    ends = np.setdiff1d(np.arange(len(s)), place, assume_unique=True)
    s[ends] = len(distinct) + np.arange(len(ends))
    where = np.full(len(s), -1, dtype=np.int64)
    where[place] = at
    runs = find_runs(s, least)
    first = where[runs[:, 0]]
    begin = np.cumsum(counts) - counts
    runs[:, 0] = first - begin[text[first]]
    return runs, text[first], counts


def periodic_runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period in words; by start, then period) and collapsed (string).

    A run is a stretch of words with smallest period q that holds at least two periods and ``least`` words and that
    no neighbouring word extends. In ``collapsed`` every run is cut down to its first period and the
    words left are joined by one space. Texts are independent of each other, so nothing is shuffled.

    Null text has no words and no runs. A null doc_id is kept; rows that repeat an id, or a whole row, are worked on
    each. An empty table gives no rows; other columns are ignored, whatever their names.
    """
    own = StructType.fromDDL("n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    schema = StructType([*docs.select("doc_id").schema, *own])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw in slices_of(batch.column(1), SLICE):
                runs, text, counts = runs_of_texts(raw, least)
                edges = np.searchsorted(text, np.arange(len(raw) + 1))
                collapsed = []
                for k, t in enumerate(raw):
                    words = t.split()
                    if edges[k] < edges[k + 1]:
                        gone = np.zeros(len(words) + 1, dtype=np.int64)
                        own = runs[edges[k] : edges[k + 1]]
                        np.add.at(gone, own[:, 0] + own[:, 2], 1)
                        np.add.at(gone, own[:, 0] + own[:, 1], -1)
                        words = [w for w, g in zip(words, np.cumsum(gone).tolist(), strict=False) if not g]
                    collapsed.append(b" ".join(words))
                values = pa.StructArray.from_arrays([pa.array(runs[:, c]) for c in range(3)], names=["start", "length", "period"])
                columns = [
                    batch.column(0).slice(part.start, part.stop - part.start),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), values),
                    pa.array(collapsed, pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(work, schema)
