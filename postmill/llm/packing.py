"""Best-fit-decreasing packing of tokenised documents, by a segment tree over remaining capacities."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict, deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import blocks_for, mix, numbered, powers, prefix_hash, saved, slices_of

CAPACITY = 1024
END = 2
#: Encoded chunks that a task remembers at most; beyond, it starts anew.
CACHED = 600_000

# Places where the tokenizer's own pre-split always cuts: around white space that stands alone.
_TWO_SPACES = re.compile(r"\s\s")
_SAFE = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")
# Chunks in Latin letters without white space at their ends but one leading space: both libraries agree on them.
_PLAIN = re.compile(r" ?[^\s\u0250-\U0010FFFF](?:[^\u0250-\U0010FFFF]*[^\s\u0250-\U0010FFFF])?")


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes, equal to ``encode(text, add_special_tokens=False)``.

    A text is cut where the tokenizer's pre-split cuts in any case, before a single space and around
    a single line end, and every distinct chunk is encoded once. ``ranks`` names the same vocabulary
    as a rank file, with which plain chunks are encoded several times faster; the ids are the same.
    A text that holds an added token, such as an end mark, goes to the tokenizer whole.
    """

    def __init__(self, path: str, ranks: str | None = None) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache: dict[str, bytes] = {"": b""}
        self.fast = None
        if ranks:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                own = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own, special_tokens={})
            self.sizes = np.zeros(max(own.values()) + 1, dtype=np.int64)
            for token, rank in own.items():
                self.sizes[rank] = len(token)
            self.line_end = np.array(self.fast.encode_ordinary("\n"), dtype="<u4")
            self.words = Words(self)

    @staticmethod
    def chunks(text: str) -> list[str]:
        if "\0" in text or _TWO_SPACES.search(text):
            return _SAFE.split(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def learn(self, chunks: list[str]) -> None:
        """Encode new chunks: plain ones as lines of one text, the others one by one."""
        plain = [c for c in chunks if _PLAIN.fullmatch(c)] if self.fast else []
        if plain:
            ids = np.array(self.fast.encode_ordinary("\n".join(plain)), dtype="<u4")
            ends = np.cumsum([len(c.encode()) + 1 for c in plain])
            at = np.concatenate(([0], np.searchsorted(np.cumsum(self.sizes[ids]), ends - 1, "left") + 1))
            data = ids.tobytes()
            # a chunk's last token ends one byte before its line end, which is a token of its own
            for chunk, begin, stop in zip(plain, [0, *(at[1:-1] + 1).tolist()], at[1:].tolist(), strict=True):
                self.cache[chunk] = data[4 * begin : 4 * stop]
        rest = [c for c in chunks if c not in self.cache]
        for chunk, encoded in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            self.cache[chunk] = np.array(encoded.ids, dtype="<u4").tobytes()

    def encode(self, raw: Sequence[bytes]) -> list[bytes]:
        """Ids of UTF-8 texts: in blocks of words where a rank file is given, or else by chunks."""
        whole = [i for i, t in enumerate(raw) if any(a in t for a in self.added)]
        if not whole:
            return self.encode_parts(raw)
        out = self.encode_parts([t for t in raw if not any(a in t for a in self.added)])
        for i in whole:  # in ascending order, so that each lands at its own place
            ids = self.tokenizer.encode(raw[i].decode("utf-8"), add_special_tokens=False).ids
            out.insert(i, np.array(ids, dtype="<u4").tobytes())
        return out

    def encode_parts(self, raw: Sequence[bytes]) -> list[bytes]:
        if self.fast is None or not raw:
            return self.encode_chunks([t.decode("utf-8") for t in raw])
        return self.words.encode(raw, self.encode_chunks)

    def encode_chunks(self, texts: Sequence[str]) -> list[bytes]:
        if len(self.cache) > CACHED:
            self.cache = {"": b""}
        cut = [self.chunks(t) for t in texts]
        new: set[str] = set()
        for c in cut:
            new.update(c)
        self.learn(list(new - self.cache.keys()))
        get = self.cache.__getitem__
        return [b"".join(map(get, c)) for c in cut]


class Words:
    """Encodes blocks of plain texts, each distinct word once; words are told apart by 64-bit hashes.

    A text is plain if single spaces and line ends are its only white space, none at its ends, and its
    letters are Latin. All steps but the encoding of new words are array operations.
    """

    def __init__(self, encoder: Encoder) -> None:
        self.encoder = encoder
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)  # sorted
        self.at = np.zeros((0, 2), dtype=np.int64)  # begin and length in store
        self.store = np.zeros(0, dtype="<u4")

    def learn(self, keys: np.ndarray, chunks: list[str], line_first: np.ndarray) -> None:
        encoder = self.encoder
        ids = np.array(encoder.fast.encode_ordinary("\n".join(chunks)), dtype="<u4")
        # Every chunk after the first begins behind its line end; a chunk after a line end keeps that id.
        ends = np.cumsum([len(c.encode()) + 1 for c in chunks]) - 1
        stop = np.searchsorted(np.cumsum(encoder.sizes[ids]), ends, "left") + 1
        begin = np.concatenate(([0], stop[:-1] + 1))
        if line_first[0]:  # no line end stands before the first chunk: give it one
            ids = np.concatenate((encoder.line_end, ids))
            begin, stop = begin + 1, stop + 1
        begin = begin - line_first
        place = np.stack([begin + len(self.store), stop - begin], 1)
        self.store = np.concatenate((self.store, ids))
        merged = np.concatenate((self.keys, keys))
        order = np.argsort(merged, kind="stable")
        self.keys, self.at = merged[order], np.concatenate((self.at, place))[order]

    def encode(self, raw: Sequence[bytes], otherwise) -> list[bytes]:
        if len(self.keys) > CACHED:
            self.forget()
        joined = b" ".join(raw) + b" "
        data = np.frombuffer(joined, dtype=np.uint8)
        size = np.array([len(t) + 1 for t in raw])
        first = np.concatenate(([0], np.cumsum(size)[:-1]))
        space = (data == 32) | (data == 10)
        odd = ((data >= 9) & (data <= 13) & (data != 10)) | (data >= 0xCA) | (data < 9)
        odd[1:] |= space[1:] & space[:-1]
        odd[1:] |= (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
        odd[0] |= space[0]
        plain = np.add.reduceat(odd, first) == 0
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        edge = edge if space[0] else np.concatenate(([0], edge))
        starts, ends = edge[::2], edge[1::2]
        doc = np.searchsorted(first, starts, "right") - 1
        use = plain[doc]
        starts, ends, doc = starts[use], ends[use], doc[use]
        kind = np.where(starts == first[doc], 0, np.where(data[starts - 1] == 32, 1, 2))
        sums, down = prefix_hash(data), powers(len(data))[1]
        hashes = mix((sums[ends] - sums[starts]) * down[starts] + (4 * (ends - starts) + kind).astype(np.uint64))
        own, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(own):
            hit = np.minimum(np.searchsorted(self.keys, own), max(len(self.keys) - 1, 0))
            new = np.flatnonzero(self.keys[hit] != own) if len(self.keys) else np.arange(len(own))
            if len(new):
                w = where[new]
                chunks = [(" " if k == 1 else "") + joined[a:b].decode() for a, b, k in zip(starts[w].tolist(), ends[w].tolist(), kind[w].tolist(), strict=True)]
                self.learn(own[new], chunks, (kind[w] == 2).astype(np.int64))
            at = self.at[np.searchsorted(self.keys, own)][inverse]
            before = np.concatenate(([0], np.cumsum(at[:, 1])))
            ids = self.store[np.repeat(at[:, 0] - before[:-1], at[:, 1]) + np.arange(before[-1])].tobytes()
            last = np.searchsorted(doc, np.arange(len(raw)), "right")
            cut = np.concatenate(([0], before[last])) * 4
        out = [ids[cut[i] : cut[i + 1]] if ok else b"" for i, ok in enumerate(plain.tolist())] if len(own) else [b""] * len(raw)
        rest = np.flatnonzero(~plain)
        for i, encoded in zip(rest, otherwise([raw[i].decode("utf-8") for i in rest]), strict=True):
            out[i] = encoded
        return out


def pieces(docs: DataFrame, tokenizer: str, ranks: str | None = None, capacity: int = CAPACITY, end: int = END, keep_ids: bool = False, keep: Sequence[str] = (), narrow: bool = False) -> DataFrame:
    """(doc_id[, keep], piece, start, length, ids_crc32[, ids]): documents as ids and an end id, cut only if too long.

    Pieces of a longer document hold ``capacity`` ids each, but for the first, which may be shorter.
    ``ids`` (little-endian 32-bit) is filled on request. Null text is empty and gives a piece with
    the end id alone. Columns named in ``keep`` go with every piece. With ``narrow``, ids take 16 bits each
    in pieces where all of them fit, for ``widened`` to undo.
    """
    own_columns = ["doc_id", *keep]
    schema = docs.select(*own_columns).schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")
    schema = schema.add("ids", "binary") if keep_ids else schema
    tail = np.array([end], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, ranks)
        for batch in batches:
            for part, raw in slices_of(batch.column(len(own_columns)), 1 << 20):
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, encoded in enumerate(encoder.encode(raw), part.start):
                    encoded += tail
                    n = len(encoded) // 4
                    stop, begin, number = (n - 1) % capacity + 1, 0, 0
                    while begin < n:
                        own = encoded[4 * begin : 4 * stop]
                        row.append(i)
                        piece.append(number)
                        start.append(begin)
                        length.append(stop - begin)
                        crc.append(zlib.crc32(own))
                        ids.append(None if not keep_ids else narrowed(own) if narrow else own)
                        begin, stop, number = stop, stop + capacity, number + 1
                at = pa.array(row, pa.int64())
                columns = [*[batch.column(k).take(at) for k in range(len(own_columns))], pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                columns += [pa.array(ids, pa.binary())] if keep_ids else []
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(*own_columns, "text").mapInArrow(cut, schema)


def narrowed(ids: bytes) -> bytes:
    """32-bit ids as 16-bit ones, or unchanged if one does not fit."""
    wide = np.frombuffer(ids, dtype="<u4")
    return wide.astype("<u2").tobytes() if wide.max(initial=0) < 1 << 16 else ids


def widened(ids: bytes, length: int) -> bytes:
    """The ``length`` 32-bit ids that ``narrowed`` was given."""
    return np.frombuffer(ids, dtype="<u2").astype("<u4").tobytes() if len(ids) == 2 * length else ids


class CapacityTree:
    """A segment tree over remaining capacities: which one at or above a size is the least with open bins."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, remaining: int, bins: int) -> None:
        node = remaining + self.leaves
        while node:
            self.count[node] += bins
            node //= 2

    def tightest(self, size: int) -> int:
        """The least remaining capacity >= size that a bin has, or -1."""
        node = size + self.leaves
        if self.count[node]:
            return size
        while node > 1:
            if node % 2 == 0 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return -1


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing for ``histogram`` (length to number of pieces).

    Pieces of one length are alike, so they are placed in runs: (length, first rank, pieces, first
    bin, pieces per bin, offset) puts the run's r-th piece in bin ``first + r // per`` at ``offset +
    (r % per) * length``. Placing pieces one by one gives the same: after a piece is placed, its bin
    is the tightest one for the next of that length, as long as it has room. Runs number at most
    capacity squared, whatever the number of pieces.
    """
    tree = CapacityTree(capacity)
    open_bins: dict[int, deque[tuple[int, int]]] = defaultdict(deque)  # remaining -> (first bin, bins)
    runs: list[tuple[int, int, int, int, int, int]] = []
    n_bins = 0

    def put_back(remaining: int, first: int, bins: int) -> None:
        if remaining and bins:
            open_bins[remaining].append((first, bins))
            tree.add(remaining, bins)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            remaining = tree.tightest(length)
            if remaining < 0:
                first, bins, remaining = n_bins, -(-left // (capacity // length)), capacity
                n_bins += bins
            else:
                first, bins = open_bins[remaining].popleft()
                tree.add(remaining, -bins)
            per = remaining // length
            full = min(bins, left // per)
            offset = capacity - remaining
            if full:
                runs.append((length, rank, full * per, first, per, offset))
                put_back(remaining - per * length, first, full)
                left, rank = left - full * per, rank + full * per
            if full < bins:
                some = min(left, per)
                if some:
                    runs.append((length, rank, some, first + full, per, offset))
                    left, rank = 0, rank + some
                    put_back(remaining - some * length, first + full, 1)
                    put_back(remaining, first + full + 1, bins - full - 1)
                else:
                    put_back(remaining, first + full, bins - full)
    return runs


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False, block_rows: int = 2000, keep: Sequence[str] = ()) -> DataFrame:
    """The pieces of all documents with sequence_id and offset, as best-fit decreasing packs them.

    Best fit needs the lengths only, and there are at most ``capacity`` of them: the driver gets one
    count per length, computes the runs of the whole table's packing, and tasks find every piece's
    place from its rank among the pieces of its length. Ranks are counted in blocks, so a length that
    most pieces share does not gather in one task.

    With ``keep_ids`` the ids are saved and shuffled once, in 16 bits each where they fit.

    Null text: a piece with the end id alone. Null doc_id and repeated rows: documents like any
    other. An empty table gives no rows; columns of ``docs`` that ``keep`` does not name are ignored.
    """
    cut = saved(pieces(docs, tokenizer, ranks, capacity, keep_ids=keep_ids, keep=keep, narrow=True))
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    runs = np.array(best_fit(histogram, capacity), dtype=np.int64).reshape(-1, 6)
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    top = int(runs[:, 1].max() + runs[:, 2].max() + 1) if len(runs) else 1
    keys = runs[:, 0] * top + runs[:, 1] if capacity * top < 2**62 else None
    blocks = blocks_for(max(histogram.values(), default=1), block_rows)
    block = F.pmod(F.xxhash64("doc_id", *keep, "piece", "ids_crc32", F.spark_partition_id()), F.lit(blocks)).cast("int")
    ranked = numbered(cut.withColumn("_block", block), ["length"], "_block", ["doc_id", "piece", "ids_crc32", *keep], "_rank_")
    names = cut.columns
    schema = cut.schema.add("sequence_id", "long").add("offset", "long")
    if keys is None:
        raise ValueError("too many pieces to number in 62 bits")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank, length = batch.column(batch.num_columns - 1).to_numpy(), batch.column(names.index("length")).to_numpy()
            run = runs[np.searchsorted(keys, length * top + rank, "right") - 1]
            r = rank - run[:, 1]
            own = [pa.array(run[:, 3] + r // run[:, 4]), pa.array(run[:, 5] + r % run[:, 4] * length)]
            columns = [batch.column(i) for i in range(len(names))] + own
            if not keep_ids:
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                continue
            at = names.index("ids")
            for part, raw in slices_of(columns[at], 1 << 20):
                some = [c.slice(part.start, part.stop - part.start) for c in columns]
                some[at] = pa.array(map(widened, raw, length[part].tolist()), pa.binary())
                yield pa.RecordBatch.from_arrays(some, names=schema.names)

    return ranked.select(*names, "_rank_").mapInArrow(placed, schema)
