"""The ten tables: load, reject, stub parents, read, CSV in and out."""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from postmill.functions.headers import joined
from postmill.operators.skew import lookup
from postmill.schemas import ADDRESS_TYPES, KEYS, LONG_TEXT, MAX_LENGTH, PARENTS, TABLES, UNIQUE

from postmill.sources.checkpoints import checkpointed, path_exists, remove

log = logging.getLogger(__name__)


def null_normalise(df: DataFrame) -> DataFrame:
    """NaN and blank text become null in every column."""
    plain = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            c = F.when(~F.isnan(c), c)
        elif kind == "string":
            c = F.when(F.trim(c) != "", c)
        plain.append(c.alias(name))
    return df.select(*plain)


def project(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in order, cast to its types; columns the frame lacks are null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TABLES[table].fields
        ]
    )


def problem(table: str) -> Column:
    """Why a row cannot be loaded, or null: missing key, text over the limit, unknown address type."""
    checks = [F.when(F.col(k).isNull(), f"{k} is null") for k in KEYS[table] if k not in ("entity_type", "entity_value", "category", "product")]
    for f in TABLES[table].fields:
        if isinstance(f.dataType, StringType) and f.name not in LONG_TEXT:
            checks.append(F.when(F.length(f.name) > MAX_LENGTH, f"{f.name} is too long"))
    if table == "addresses":
        checks.append(F.when(~F.col("address_type").isin(ADDRESS_TYPES), "address_type is unknown"))
    return F.coalesce(*checks)


def split_rejects(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(rows to load, rejected rows with their ``reject_reason``)."""
    checked = project(null_normalise(df), table).withColumn("reject_reason", problem(table))
    good = checked.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, checked.where(F.col("reject_reason").isNotNull())


def mark_conflicts(rows: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """The distinct rows with a ``reject_reason``: their key is stored already, or repeated.

    Of different rows with one key, the one with the smallest digest stays. Minima combine
    map-side and reach the rows through the skew-safe look-up.
    """
    digest = F.sha2(F.to_json(F.struct(*rows.columns)), 256)
    hashed = rows.distinct().withColumn("_digest", digest)
    first = hashed.groupBy(key).agg(F.min("_digest").alias("_first"))
    known = first.join(stored.select(key).distinct().withColumn("_stored", F.lit(True)), key, "left")
    judged = lookup(hashed, known, key, ["_digest"])
    reason = F.when(F.col("_stored"), f"{key} is stored already").when(F.col("_digest") != F.col("_first"), f"{key} is repeated")
    return judged.select(*rows.columns, reason.alias("reject_reason"))


def missing_parents(child: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Stub rows (key set, other columns null) for the child keys that have no parent.

    Keys are made distinct map-side before the anti join, so a key that a third of the children
    share arrives as one row per task.
    """
    keys = child.select(key).where(F.col(key).isNotNull()).distinct()
    stubs = keys.join(parents.select(key), key, "left_anti")
    return stubs.select(
        *[(F.col(f.name) if f.name == key else F.lit(None).cast(f.dataType)).alias(f.name) for f in parents.schema]
    )


def ensure_parents(child: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """The parents plus a stub for every child key without one."""
    return parents.unionByName(missing_parents(child, parents, key))


def with_surrogate_id(df: DataFrame, table: str) -> DataFrame:
    """Add ``id``: a stable hash of the natural key, equal in every run."""
    return df.select(F.xxhash64(*KEYS[table]).alias("id"), "*")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash a frame over the cores when its files give fewer splits than there are cores.

    Only a small source is shuffled this way; one with enough splits is returned as it is. Steps
    that group by the keys reuse the partitioning.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


class TableStore:
    """The ten tables as Parquet datasets below one base path, one folder per load."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark = spark
        self.base = base.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def read(self, table: str) -> DataFrame:
        """The table; an empty frame when nothing has been loaded. A full row hides the stub of its key."""
        return self._with_stubs(table, F.lit(True)).select(*TABLES[table].names)

    def _with_stubs(self, table: str, chosen: Column) -> DataFrame:
        """The full rows, and of the ``chosen`` stubs those without a full row, one per key."""
        full = self._stored(table, self.path(table), "load_id").select(*TABLES[table].names)
        if not path_exists(self.spark, self.stub_path(table)):
            return full
        stubs = self._stored(table, self.stub_path(table), "load_id", "child").where(chosen).select(*TABLES[table].names)
        return full.unionByName(stubs.dropDuplicates(KEYS[table]).join(full.select(KEYS[table]), KEYS[table], "left_anti"))

    def stub_path(self, table: str) -> str:
        return f"{self.path(table)}_stubs"

    def _stored(self, table: str, path: str, *folders: str) -> DataFrame:
        schema = StructType([*TABLES[table].fields, *[StructField(f, StringType()) for f in folders]])
        if path_exists(self.spark, path):
            return self.spark.read.schema(schema).parquet(path)
        return self.spark.createDataFrame([], schema)

    def read_all(self) -> dict[str, DataFrame]:
        """Every table by name."""
        return {table: self.read(table) for table in TABLES}

    def load(self, df: DataFrame, table: str, load_id: str | None = None) -> DataFrame | None:
        """Add a frame to its table under a load's name; returns the rejected rows.

        The rows of one ``load_id`` (letters, digits, ``.``, ``_``, ``-``) lie in one folder of each table, which the same load
        replaces when it runs again, also with other rows or none, however far it came the last time; files become visible as the
        write commits. So each row of a load is stored once. Without a name every load is a new one.

        An unknown table name is logged and nothing is written. Parents that do not exist yet are
        added as stubs first. In the parent tables, whose key is unique, rows whose key another load stored, or that
        repeats, are rejected, so a load under a new name adds nothing to them. Expects a frame that was written out before, if it
        is costly: it is read once for the parents and once for the rows.
        """
        if table not in TABLES:
            log.error("table %r is unknown", table)
            return None
        load_id = uuid.uuid4().hex if load_id is None else load_id
        if not re.fullmatch(r"[\w.-]+", load_id, re.ASCII):
            raise ValueError(f"{load_id!r} cannot name a load")
        good, rejected = split_rejects(df, table)
        if table in UNIQUE:
            others = self._stored(table, self.path(table), "load_id").where(F.col("load_id") != load_id)
            judged = checkpointed(mark_conflicts(good, others, KEYS[table][0]))  # judged before the rows are stored
            good = judged.where(F.col("reject_reason").isNull()).drop("reject_reason")
            rejected = rejected.unionByName(judged.where(F.col("reject_reason").isNotNull()))
        if table in PARENTS:
            parent, key = PARENTS[table]
            others = (F.col("load_id") != load_id) | (F.col("child") != table)  # this load's own stubs are written anew
            stubs = checkpointed(missing_parents(good, self._with_stubs(parent, others), key))
            self._replace(stubs, self.stub_path(parent), load_id=load_id, child=table)
        self._replace(good, self.path(table), load_id=load_id)
        return rejected

    def _replace(self, rows: DataFrame, path: str, **folders: str) -> None:
        """Write the rows as the one content of a folder below the path; other folders stay."""
        folder = "/".join([path, *[f"{name}={value}" for name, value in folders.items()]])
        if path_exists(self.spark, folder) and rows.isEmpty():  # no row would replace nothing
            remove(self.spark, folder)
        named = rows.withColumns({name: F.lit(value) for name, value in folders.items()})
        writer = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*folders).parquet(path)


def write_jdbc(df: DataFrame, table: str, url: str, properties: dict[str, str]) -> None:
    """The accepted rows of a frame appended to an external database table."""
    good, _ = split_rejects(df, table)
    good.write.jdbc(url, table, mode="append", properties=properties)


# --- CSV ----------------------------------------------------------------------------------------


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with header, quoted line breaks and doubled quotes; empty text reads as null."""
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True)
    return reader.option("escape", '"').option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path)


def to_text(df: DataFrame) -> DataFrame:
    """Arrays become ``", "``-joined text, the form that CSV can hold."""
    return df.select(*[joined(F.col(n)).alias(n) if t == "array<string>" else F.col(n) for n, t in df.dtypes])


def export_csv(frames: Mapping[str, DataFrame], base: str, day: date) -> dict[str, str]:
    """One CSV dataset ``{table}_{date}`` per frame; returns the paths."""
    paths = {name: f"{base.rstrip('/')}/{name}_{day:%Y-%m-%d}" for name in frames}
    for name, df in frames.items():
        writer = to_text(df).write.mode("overwrite").option("header", True).option("quoteAll", True)
        writer.option("escape", '"').option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(paths[name])
    return paths
