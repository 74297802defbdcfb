"""Quality rules: rule statistics of whole texts, and an isolation forest that judges them."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import slices_of, mix, word_hashes

#: At most so many labelled rows fit the forest and its threshold: those with the smallest hashes of doc_id.
FIT_ROWS = 20_000
TREES = 200
TREE_ROWS = 256
#: The threshold rejects at most this share of the labelled good rows.
GOOD_REJECTED = 0.001

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_chars_all", "n_lines", "n_upper", "n_marks", "n_digits", "n_distinct_words", "n_bars", "n_marked_words")

_SYMBOLS = re.compile(r"[#*$%&|<>]")
_WORD = re.compile(r"[^\x20\x09-\x0D]")
_MARKS = re.compile(r"[!?]")
_DIGITS = re.compile(r"[0-9]")
_UPPER = re.compile(r"[^\W\d_a-zà-öø-ÿ]")
_BARS = re.compile(r"[|{}\[\]=;/\\_~^]")
_MARKED_END = re.compile(r"[^\w\s.,;:'\"()-](?=[\x20\x09-\x0D]|\Z)")
_SEPARATORS = re.compile(r"[\x20\x09-\x0D]")


def _repeated(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: words that lie in a 5-word window found twice or more in it, and distinct words."""
    n_docs, n = len(counts), len(hashes)
    repeat = np.zeros(n_docs, dtype=np.int64)
    doc = np.repeat(np.arange(n_docs), counts)
    salt = mix(doc.astype(np.uint64) + np.uint64(1))
    distinct = np.bincount((np.unique(np.stack([doc.astype(np.uint64), hashes], 1), axis=0)[:, 0]).astype(np.int64), minlength=n_docs) if n else repeat.copy()
    if n >= 5:
        window = salt[: n - 4].copy()
        for k in range(5):
            window = mix(window + hashes[k : n - 4 + k] * np.uint64(2 * k + 3))
        whole = np.flatnonzero(doc[: n - 4] == doc[4:])
        _, inverse, times = np.unique(window[whole], return_inverse=True, return_counts=True)
        begin = whole[times[inverse] >= 2]
        cover = np.zeros(n + 1, dtype=np.int64)
        np.add.at(cover, begin, 1)
        np.add.at(cover, begin + 5, -1)
        repeat = np.bincount(doc[np.cumsum(cover[:n]) > 0], minlength=n_docs)
    return repeat, distinct


def _statistics(raw: Sequence[bytes]) -> dict[str, np.ndarray]:
    hashes, n_words = word_hashes(raw, lower=False)
    repeat, distinct = _repeated(hashes, n_words)
    out = {name: np.zeros(len(raw), dtype=np.int64) for name in (*COUNTS, *MORE)}
    out["n_words"], out["n_repeat_words"], out["n_distinct_words"] = n_words, repeat, distinct
    for i, data in enumerate(raw):
        text = data.decode("utf-8", "surrogatepass")
        seen: set[str] = set()
        dup = lines = 0
        for line in text.split("\n"):
            if _WORD.search(line):
                lines += 1
                if line in seen:
                    dup += 1
                seen.add(line)
        out["word_chars"][i] = len(text) - len(_SEPARATORS.findall(text))
        out["n_dup_lines"][i], out["n_lines"][i], out["n_chars_all"][i] = dup, lines, len(text)
        for name, pattern in (("n_symbols", _SYMBOLS), ("n_marks", _MARKS), ("n_digits", _DIGITS), ("n_upper", _UPPER), ("n_bars", _BARS), ("n_marked_words", _MARKED_END)):
            out[name][i] = len(pattern.findall(text))
    return out


def statistics(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and the rule statistics of each row's whole text; no shuffle.

    Words are ``[^\\x20\\x09-\\x0D]+``. Null text counts as empty, so every count is 0. Rows are
    judged one by one: repeated rows give equal results, an empty table none, and other columns of
    ``docs`` do not matter. Names in ``keep`` that clash with a statistic give way to it.
    """
    names = (*COUNTS, *MORE)
    return _measured(docs, keep, [(name, "long") for name in names], lambda counts: [counts[name] for name in names])


def _measured(docs: DataFrame, keep: Sequence[str], results: Sequence[tuple[str, str]], of: Callable[[dict[str, np.ndarray]], list[np.ndarray]]) -> DataFrame:
    """``keep`` and the results ``of`` every row's statistics, in one Python step that gets each text once.

    Two steps in a row would keep a second Python worker for every core of an executor.
    """
    keep = [c for c in keep if c not in (*COUNTS, *MORE)]
    sent = [*keep, *(["text"] if "text" not in keep else [])]
    schema = docs.select(*keep).schema
    for name, kind in results:
        schema = schema.add(name, kind)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw in slices_of(batch.column(sent.index("text")), 2 << 20):
                kept = [batch.column(i).slice(part.start, part.stop - part.start) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(kept + [pa.array(x) for x in of(_statistics(raw))], names=schema.names)

    return docs.select(*sent).mapInArrow(measured, schema)


# --- forest -------------------------------------------------------------------------------------


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Rates of the rules that fired, one column each; lengths enter only through them."""
    c = {k: np.asarray(v, dtype=float) for k, v in counts.items()}
    words, chars = np.maximum(c["n_words"], 1), np.maximum(c["word_chars"], 1)
    return np.stack(
        [
            c["n_symbols"] / words,
            c["n_marks"] / words,
            c["n_upper"] / chars,
            c["n_repeat_words"] / words,
            c["n_dup_lines"] / np.maximum(c["n_lines"], 1),
            c["n_bars"] / words,
            c["n_marked_words"] / words,
            np.maximum(0, 1.0 - c["n_distinct_words"] / words - 0.5),
        ],
        axis=1,
    )


@dataclass
class Forest:
    """Random trees as arrays: feature (-1 at leaves), cut, left child (the right one follows), leaf depth."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    rows: int
    threshold: float = 1.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 to the power of minus the mean path length over the expected one: 1 is most anomalous."""
        total = np.zeros(len(x))
        for feature, cut, child, depth in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            while True:
                inner = np.flatnonzero(feature[at] >= 0)
                if not len(inner):
                    break
                node = at[inner]
                at[inner] = child[node] + (x[inner, feature[node]] > cut[node])
            total += depth[at]
        return 2.0 ** (-total / len(self.trees) / _expected(self.rows)) if self.trees else np.zeros(len(x))


def _expected(n: int) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 1.0 if n <= 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


def grow(x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 11) -> Forest:
    """An isolation forest over the rows: each tree splits its own draw at random until rows stand alone.

    A split's cut is uniform over the range of a random feature, widened beyond the draw towards 0
    and the range of all rows, so that values no draw has seen can be isolated as well.
    """
    if not len(x):
        return Forest([], 2)
    random = np.random.default_rng(seed)
    most = math.ceil(math.log2(max(2, min(rows, len(x)))))
    lowest, highest = x.min(0), np.maximum(x.max(0), 1.0)
    out = []
    for _ in range(trees):
        draw = x[random.choice(len(x), min(rows, len(x)), replace=False)]
        feature, cut, child, depth = [], [], [], []

        def add() -> int:
            for column, value in ((feature, -1), (cut, 0.0), (child, 0), (depth, 0.0)):
                column.append(value)
            return len(feature) - 1

        todo = [(add(), draw, 0, lowest.copy(), highest.copy())]
        while todo:
            node, part, level, low, high = todo.pop()
            if level >= most or len(part) <= 1:
                depth[node] = level + (_expected(len(part)) if len(part) > 1 else 0.0)
                continue
            f = int(random.integers(x.shape[1]))
            # Half of the cuts fall within the draw's own range, which is often a small part of the space.
            a, b = (part[:, f].min(), part[:, f].max()) if random.random() < 0.5 else (low[f], high[f])
            c = random.uniform(a, b) if b > a else a
            feature[node], cut[node], child[node] = f, c, add()
            add()
            above = part[:, f] > c
            under, over = high.copy(), low.copy()
            under[f] = over[f] = c
            todo += [(child[node], part[~above], level + 1, low, under), (child[node] + 1, part[above], level + 1, over, high)]
        out.append((np.array(feature), np.array(cut), np.array(child), np.array(depth)))
    return Forest(out, min(rows, len(x)))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Forest:
    """Grow the forest on labelled rows of good quality and set the threshold by all labelled rows.

    At most ``fit_rows`` labelled rows are used, those with the smallest hashes of doc_id. Thresholds that reject at most
    ``GOOD_REJECTED`` of the good rows are allowed; of those that then reject the most bad rows, the threshold is the
    middle one, halfway between the last good score kept and the first bad score above it, which leaves unseen rows of
    both kinds the same margin. Without bad rows above, it lies at the last good score kept. Rows that fail a base
    rule take no part, as they are rejected anyway. Without good rows nothing is rejected. Null ids and null labels
    are left out; a document with two labels counts as bad.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "quality", "text")
    rows = statistics(texts, ["doc_id", "quality"]).orderBy(F.xxhash64("doc_id"), "doc_id", *COUNTS).limit(fit_rows).toPandas()
    failed = base_failed(rows["n_words"].to_numpy(), rows["n_repeat_words"].to_numpy()) if len(rows) else np.zeros(0, dtype=bool)
    rows = rows[~failed]
    x, good = features({n: rows[n].to_numpy() for n in (*COUNTS, *MORE)}), rows["quality"].to_numpy() == 1
    forest = grow(x[good])
    if good.any():
        forest.threshold = threshold(forest.score(x[good]), forest.score(x[~good]))
    return forest


def threshold(good: np.ndarray, bad: np.ndarray) -> float:
    """The middle of the thresholds that reject most bad scores and at most ``GOOD_REJECTED`` of the good ones."""
    last = np.sort(good)[-1 - int(GOOD_REJECTED * len(good))]
    above = bad[bad > last]
    return float((last + above.min()) / 2 if len(above) else last + 1e-9)


def base_failed(n_words: np.ndarray, n_repeat_words: np.ndarray) -> np.ndarray:
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


VERDICT = ("base_failed", "anomaly", "kept")


def judge(docs: DataFrame, forest: Forest, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep``, the base counts, base_failed, anomaly (the score) and kept for every row.

    Null and empty texts have no words and fail a base rule; repeated rows are judged each, alike; an empty table gives no
    rows. A column of ``keep`` that is named like a result is replaced by it.
    """

    def judged(counts: dict[str, np.ndarray]) -> list[np.ndarray]:
        score = forest.score(features(counts))
        failed = base_failed(counts["n_words"], counts["n_repeat_words"])
        return [*(counts[name] for name in COUNTS), failed, score, ~failed & (score <= forest.threshold)]

    results = [*((name, "long") for name in COUNTS), ("base_failed", "boolean"), ("anomaly", "double"), ("kept", "boolean")]
    return _measured(docs, [c for c in keep if c not in VERDICT], results, judged)
