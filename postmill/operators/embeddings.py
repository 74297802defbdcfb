"""Embeddings: encode, keep a store up to date, reduce by truncated SVD, normalise."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.functions.text import tokens
from postmill.functions.vectors import l2_normalise
from postmill.sources.checkpoints import checkpointed, path_exists

Encoder = Callable[[list[str]], np.ndarray]
STORE_SCHEMA = "message_id string, embedding array<float>"
BUCKETS = 256  # folders of the embedding store
PART = "strip int, lane int, matrix binary"
COMPONENTS = 50
MAX_DIMENSIONS = 4096  # up to here the driver holds the Gram matrix of the SVD, beyond it a sketch of the row space
OVERSAMPLE = 10  # directions of the sketch beyond those asked for
PASSES = 3  # times the sketch is multiplied by the Gram matrix
LANES = 64  # partial results are merged in so many groups before the last merge
STRIP = 256  # dimensions per partial sum
BLOCK = 256  # rows per matrix product


def encode(docs: DataFrame, key: str, text: str, factory: Callable[[], Encoder]) -> DataFrame:
    """(key, embedding) by a user's encoder, built once per task and fed Arrow batches."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = factory()
        for batch in batches:
            yield pd.Series(list(np.asarray(encoder(batch.tolist()), dtype=np.float32)))

    scorer = F.pandas_udf(run, "array<float>").asNondeterministic()
    return docs.select(key, scorer(F.coalesce(F.col(text), F.lit(""))).alias("embedding"))


def hashed_embeddings(docs: DataFrame, key: str, text: str, dimensions: int = 256, idf: bool = True) -> DataFrame:
    """Default encoder: hashed token counts, weighted by inverse document frequency, unit length.

    ``idf=False`` gives vectors that do not depend on the other documents, as a store needs that
    grows over time.
    """
    counted = HashingTF(numFeatures=dimensions, inputCol="_t", outputCol="_v").transform(
        docs.select(key, tokens(F.coalesce(F.col(text), F.lit(""))).alias("_t"))
    )
    if idf:
        counted = IDF(inputCol="_v", outputCol="_w").fit(counted).transform(counted).drop("_v").withColumnRenamed("_w", "_v")
    unit = Normalizer(p=2.0, inputCol="_v", outputCol="_u").transform(counted)
    return unit.select(key, vector_to_array("_u", "float32").alias("embedding"))


def bucket_of(key: Column) -> Column:
    """The store's folder for an id."""
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def read_store(spark: SparkSession, path: str, buckets: list[int] | None = None) -> DataFrame:
    """The embedding store, or only the folders of the given buckets; empty when it does not exist yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], STORE_SCHEMA)
    stored = spark.read.schema(f"{STORE_SCHEMA}, bucket int").parquet(path)
    if buckets is not None:
        stored = stored.where(F.col("bucket").isin(buckets))
    return stored.drop("bucket")


def not_embedded(docs: DataFrame, store: DataFrame, key: str = "message_id") -> DataFrame:
    """The documents whose id the store lacks."""
    return docs.join(store.select(key), key, "left_anti")


def populate(docs: DataFrame, path: str, embed: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Embed the documents the store lacks, append them, and return the documents with embeddings.

    ``docs`` has one row per ``message_id``. Running it again embeds nothing new, so a repeated
    batch does no harm. The store has one folder per bucket of ids, and only the folders that the documents' ids fall in are
    read (at most ``BUCKETS`` numbers reach the driver), so a small batch reads a small share of a large store. Rows
    are gathered by bucket before they are written, where Spark splits the large buckets and joins the small ones.
    """
    spark = docs.sparkSession
    touched = docs.select(bucket_of(F.col("message_id")).alias("bucket")).where("bucket IS NOT NULL").distinct()
    buckets = sorted(r["bucket"] for r in touched.collect())
    fresh = embed(not_embedded(docs, read_store(spark, path, buckets)))
    typed = fresh.select("message_id", F.col("embedding").cast("array<float>"), bucket_of(F.col("message_id")).alias("bucket"))
    typed.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(path)
    return docs.join(read_store(spark, path, buckets), "message_id")


def truncated_svd(rows: DataFrame, key: str, vector: str, k: int = COMPONENTS) -> DataFrame:
    """(key, reduced): rows projected on the top ``k`` right singular vectors, without centring.

    Up to ``MAX_DIMENSIONS`` one pass adds up the d × d Gram matrix, whose eigenvectors the driver takes; beyond, a
    randomised range finder takes four passes (see :func:`wide_basis`). Rows stay distributed
    and only d × k numbers return to the tasks. The vectors are written out first, so that no
    pass computes them again, in row groups of few megabytes, so that a task holds few of them whatever their width. Each component's sign makes its largest entry positive.
    """
    typed = checkpointed(rows.select(key, F.col(vector).cast("array<double>").alias("_a")), wide=True)
    width = typed.select(F.max(F.size("_a"))).first()[0]
    if width is None:
        return typed.select(key, F.col("_a").alias("reduced"))
    right = wide_basis(typed, "_a", width, k) if width > MAX_DIMENSIONS else _gram_basis(typed, width, k)
    largest = right[np.abs(right).argmax(axis=0), np.arange(right.shape[1])]
    basis = right * np.where(largest < 0, -1.0, 1.0)

    @F.pandas_udf("array<double>")
    def project(batch: pd.Series) -> pd.Series:
        return pd.Series(list(np.stack(batch.to_list()) @ basis)) if len(batch) else pd.Series([], dtype=object)

    return typed.select(key, project("_a").alias("reduced"))


def _gram_basis(typed: DataFrame, width: int, k: int) -> np.ndarray:
    vectors = MLUtils.convertVectorColumnsFromML(typed.select(array_to_vector("_a").alias("_v")), "_v")
    gram = RowMatrix(vectors, numCols=width).computeGramianMatrix().toArray()
    return np.linalg.eigh(gram)[1][:, ::-1][:, : min(k, width)]


def wide_basis(rows: DataFrame, vector: str, width: int, k: int, seed: int = 0) -> np.ndarray:
    """The top ``k`` right singular vectors of wide rows, as the columns of a width × k matrix.

    A random basis of k + ``OVERSAMPLE`` directions is multiplied by the Gram matrix and made orthonormal again ``PASSES`` times,
    then the rows in its coordinates give the rotation, by a QR of tall blocks whose triangles are merged, so that small
    singular values are not squared away. Exact up to rounding where the rank is at most k + ``OVERSAMPLE``; otherwise the angle
    between a component and the sketch falls with the sixth power of (first singular value beyond the sketch / its own). Tasks and the driver hold width × (k + 10) numbers;
    a task sends its sums in strips of dimensions, which are merged in ``LANES`` groups first.
    """
    rank = min(k + OVERSAMPLE, width)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, rank)))[0]
    for _ in range(PASSES):
        basis = np.linalg.qr(_gram_times(rows.select(vector), basis))[0]
    triangle = _triangle(rows.select(vector), basis)
    return basis @ np.linalg.svd(triangle)[2].T[:, : min(k, width)]


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
    """The vectors of a task as matrices of at most ``BLOCK`` rows; null vectors are left out."""
    for batch in batches:
        vectors = batch.iloc[:, 0].dropna()
        for start in range(0, len(vectors), BLOCK):
            yield np.stack(vectors.iloc[start : start + BLOCK].to_list())


def _merged(parts: DataFrame, merge: Callable[[list[np.ndarray]], np.ndarray], shape: tuple[int, int]) -> DataFrame:
    """Parts (strip, lane, matrix) merged per strip, within the lanes first; a matrix has ``shape[1]`` columns."""

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        matrix = merge([np.frombuffer(m).reshape(-1, shape[1]) for m in group["matrix"]])
        return pd.DataFrame({"strip": group["strip"].iloc[:1], "lane": [0], "matrix": [matrix.tobytes()]})

    return parts.groupBy("strip", "lane").applyInPandas(merged, PART).groupBy("strip").applyInPandas(merged, PART)


def _gram_times(rows: DataFrame, basis: np.ndarray) -> np.ndarray:
    """AᵀA · basis in one pass over the rows of A."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen = np.zeros(basis.shape), False
        for block in _blocks(batches):
            total += block.T @ (block @ basis)
            seen = True
        lane = TaskContext.get().partitionId() % LANES
        for start in range(0, len(total) if seen else 0, STRIP):
            yield pd.DataFrame({"strip": [start // STRIP], "lane": [lane], "matrix": [total[start : start + STRIP].tobytes()]})

    strips = _merged(rows.mapInPandas(sums, PART), lambda parts: np.sum(parts, axis=0), basis.shape).collect()
    found = sorted(strips, key=lambda r: r["strip"])
    return np.concatenate([np.frombuffer(r["matrix"]).reshape(-1, basis.shape[1]) for r in found]) if found else np.zeros(basis.shape)


def _triangle(rows: DataFrame, basis: np.ndarray) -> np.ndarray:
    """The triangle R of a QR decomposition of A · basis, from those of blocks of rows."""

    def stacked(parts: list[np.ndarray]) -> np.ndarray:
        return np.linalg.qr(np.concatenate(parts), mode="r")

    def triangles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = None
        for block in _blocks(batches):
            r = stacked([block @ basis] if r is None else [r, block @ basis])
        if r is not None:
            yield pd.DataFrame({"strip": [0], "lane": [TaskContext.get().partitionId() % LANES], "matrix": [r.tobytes()]})

    found = _merged(rows.mapInPandas(triangles, PART), stacked, basis.shape).collect()  # one triangle
    return np.frombuffer(found[0]["matrix"]).reshape(-1, basis.shape[1]) if found else np.zeros((1, basis.shape[1]))


def normalised(rows: DataFrame, key: str, vector: str, out: str = "unit") -> DataFrame:
    """(key, out): unit-length vectors."""
    return rows.select(key, l2_normalise(F.col(vector)).alias(out))
