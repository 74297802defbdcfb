"""Charset detection: byte pairs counted in bodies of known charset, scored on bodies that name none."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BEGIN, _END = 1 << 16, (1 << 16) + 256  # codes of the first and the last byte of a body follow those of the pairs
PAIRS = _END + 256
#: Charsets that a model tells apart unless it is given others. UTF-8 is not among them: a body is UTF-8 if it is valid.
CANDIDATES = ("windows-1252", "windows-1251", "windows-1253", "windows-1255", "windows-1256", "iso-8859-2", "koi8-r", "shift_jis", "euc-jp", "euc-kr", "gb18030", "big5", "utf-16-le", "utf-16-be")
FALLBACK = ("windows-1252",)
_PRIOR = 0.05  # added to the count of each byte
_BACKOFF = 5.0  # weight of the bytes' own shares in the shares of what follows a byte
_CONTROLS = re.compile(rb"[\x00-\x08\x0e-\x1f]")


def _pairs(body: bytes, marks: bool = True) -> np.ndarray:
    """The pairs of neighbouring bytes and the codes of the first and last one; without marks the body stands between blanks."""
    data = np.frombuffer(body if marks else b" " + body + b" ", dtype=np.uint8).astype(np.int64)
    pairs = data[:-1] << 8 | data[1:]
    return np.concatenate((pairs, _BEGIN + data[:1], _END + data[-1:])) if marks else pairs


@dataclass(frozen=True)
class CharsetModel:
    """Log-likelihoods of a byte after another, first or last, a row of 66,048 for each charset: a few megabytes, whatever it was trained on."""

    names: tuple[str, ...]
    logs: np.ndarray

    def ranked(self, body: bytes) -> list[str]:
        """The charsets, the likeliest first; equal ones by name."""
        distinct, times = np.unique(_pairs(body), return_counts=True)
        scores = self.logs[:, distinct].astype(np.float64) @ times
        return [self.names[i] for i in np.argsort(-scores, kind="stable")]


def pair_counts(bodies: DataFrame, candidates: Sequence[str] = CANDIDATES, body: str = "body", charset: str = "charset", marks: bool = False) -> DataFrame:
    """(charset, pair, n): how often each byte pair occurs in the bodies that declare one of the candidates.

    Bodies that do not decode as declared teach nothing. Each body also counts in capitals, as some charsets have the
    small letters where others have the capital ones. Counts are summed per batch in the workers, so a charset that
    most bodies declare costs at most 66,048 rows per batch. Save the result, with ``marks`` of the first and last
    bytes, to train again with more bodies.
    """
    names = [n.lower() for n in candidates]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for data, name in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                raw = data.as_py()
                try:
                    forms = raw, raw.decode(name).upper().encode(name, "ignore")
                except (LookupError, ValueError):
                    continue
                own = sums.setdefault(name, np.zeros(PAIRS, dtype=np.int64))
                for form in forms:
                    pairs, times = np.unique(_pairs(form, marks), return_counts=True)
                    own[pairs] += times
            for name, own in sums.items():
                seen = np.flatnonzero(own)
                columns = [pa.array([name] * len(seen)), pa.array(seen, pa.int32()), pa.array(own[seen])]
                yield pa.RecordBatch.from_arrays(columns, names=["charset", "pair", "n"])

    known = bodies.select(F.col(body).cast("binary"), F.lower(charset)).where(F.col(body).isNotNull() & F.lower(charset).isin(names))
    counts = known.mapInArrow(count, "charset string, pair int, n long")
    return counts.groupBy("charset", "pair").agg(F.sum("n").alias("n"))


def model_of(counts: DataFrame) -> CharsetModel:
    """The model of pair counts. They have at most 66,048 rows per charset, so they fit the driver whatever was counted.

    It holds the shares of what follows a byte, not those of pairs, which would weigh every byte of a body twice.
    """
    rows = counts.toPandas()
    names = tuple(sorted(rows["charset"].unique()))
    logs = np.zeros((len(names), PAIRS), dtype=np.float32)
    for i, name in enumerate(names):
        own = rows[rows["charset"] == name]
        n = np.zeros(PAIRS)
        n[own["pair"].to_numpy(dtype=np.int64)] = own["n"].to_numpy(dtype=np.float64)
        follows = np.zeros((257, 257))  # the last row: the body begins; the last column: it ends
        follows[:256, :256], follows[256, :256], follows[:256, 256] = n[:_BEGIN].reshape(256, 256), n[_BEGIN:_END], n[_END:]
        share = follows.sum(0) + _PRIOR
        share = np.log((follows + _BACKOFF * share / share.sum()) / (follows.sum(1)[:, None] + _BACKOFF))
        logs[i] = np.concatenate((share[:256, :256].ravel(), share[256, :256], share[:256, 256]))
    return CharsetModel(names, logs)


def train(bodies: DataFrame, candidates: Sequence[str] = CANDIDATES, body: str = "body", charset: str = "charset") -> CharsetModel:
    """Learn from bodies that declare their charset, as most mails do; null bodies and charsets are left out."""
    return model_of(pair_counts(bodies, candidates, body, charset, marks=True))


def decode(body: bytes, declared: str | None, model: CharsetModel | None = None) -> tuple[str, str]:
    """(charset, text) of a body that is not empty; never fails.

    The declared charset comes first if it is known and fits the bytes, then UTF-8 (a body with a NUL is not
    taken for it unless declared), then the model's charsets by likelihood, the first that fits. If none does, the first one
    is used and what it cannot read is replaced. Control characters are letters' halves in UTF-16 beyond Latin: a body that
    has some and is likeliest UTF-16 is taken for it before UTF-8.
    """
    others = model.ranked(body) if model and model.names else list(FALLBACK)
    tried = [declared] if declared else []
    tried += others[:1] if others[0].startswith("utf-16") and _CONTROLS.search(body) else []
    tried += ["utf-8"] if b"\0" not in body else []
    for name in [*tried, *others]:
        try:
            return name.lower(), body.decode(name)
        except (LookupError, ValueError):
            continue
    return others[0], body.decode(others[0], errors="replace")


_UTF8 = ("utf-8", "utf8", "us-ascii", "ascii")


def is_plain_utf8(body: Column, charset: Column) -> Column:
    """Bodies that need no Python: declared UTF-8 or nothing, and valid; undeclared ones hold no control characters but blanks."""
    valid = F.is_valid_utf8(body.cast("string"))
    fits = F.when(charset.isNull(), ~body.cast("string").rlike(r"[\x00-\x08\x0e-\x1f]")).otherwise(F.lower(charset).isin(*_UTF8))
    return F.coalesce(fits & valid, F.lit(False))


def detected(body: Column, charset: Column, model: CharsetModel | None = None) -> Column:
    """(charset, text) of a binary body, null where it is null or empty. UTF-8 stays native, the rest goes to Python."""
    @F.pandas_udf("charset string, text string")
    def other(bodies: pd.Series, declared: pd.Series) -> pd.DataFrame:
        found = [decode(b, d, model) if b else (None, None) for b, d in zip(bodies, declared, strict=True)]
        return pd.DataFrame(found, columns=["charset", "text"], dtype=object)

    plain = is_plain_utf8(body, charset)
    native = F.struct(F.lit("utf-8").alias("charset"), body.cast("string").alias("text"))
    rest = other(F.when(~plain, body), F.when(~plain, charset))
    return F.when(F.length(body) > 0, F.when(plain, native).otherwise(rest))


def joined_text(parts: Column, model: CharsetModel | None = None) -> Column:
    """The text of an array of (body, charset) parts, each decoded by itself; null where there is none."""
    @F.pandas_udf("string")
    def other(bodies: pd.Series, declared: pd.Series) -> pd.Series:
        texts = [
            None if own is None else "".join(decode(b, d, model)[1] for b, d in zip(own, names, strict=True) if b)
            for own, names in zip(bodies, declared, strict=True)
        ]
        return pd.Series(texts, dtype=object)

    plain = F.forall(parts, lambda p: (F.length(p["body"]) == 0) | is_plain_utf8(p["body"], p["charset"]))
    native = F.array_join(F.transform(parts, lambda p: p["body"].cast("string")), "")
    rest = other(F.when(~plain, parts["body"]), F.when(~plain, parts["charset"]))
    return F.nullif(F.when(plain, native).otherwise(rest), F.lit(""))
