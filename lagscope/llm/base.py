"""What several operators share: tables, cut lineage, words."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import xxhash
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space inside texts, in Java's and DuckDB's notation.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]+"
#: A word: digits, letters and every character beyond ASCII, after A-Z became a-z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_RE = re.compile(WORD)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class WordHashes(dict):
    """Hashes of words, remembered for a bounded number of them."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def mixed(h: np.ndarray) -> np.ndarray:
    """64-bit numbers whose bits all depend on all bits of ``h``, which is overwritten."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    return h


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that all machines share, as the session names it.

    A local session without one gets a temporary folder; a cluster must name it.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="checkpoints-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The rows of ``df``, kept in the shared folder. Lost executors don't lose
    them, and they don't change when they are read again. Spark removes the files
    once the frame is no longer used."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def freed(spark: SparkSession) -> None:
    """Shuffles of frames that are no longer used leave the disks now, not when the driver
    happens to collect its garbage."""
    # Spark refers to what ran last, so that something else must run.
    spark.range(1).count()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Bytes of a table that a broadcast may hold, and bytes of a row besides its values.
BROADCAST_BYTES = 16 << 20
_ROW_BYTES = 16


def _size_of(value: Column, kind: T.DataType) -> Column:
    """Bytes of a value, eight for a number or a null."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value)
    elif isinstance(kind, T.StructType):
        size = sum((_size_of(value[f.name], f.dataType) for f in kind.fields), F.lit(0))
    elif isinstance(kind, T.ArrayType):
        each = F.transform(value, lambda x: _size_of(x, kind.elementType).cast("long"))
        size = F.aggregate(each, F.lit(0).cast("long"), lambda a, b: a + b)
    else:
        size = F.lit(0)
    return F.coalesce(size, F.lit(0)) + 8


def bytes_of(df: DataFrame) -> int:
    """Bytes of all rows, counted now."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    row = sum((_size_of(F.col(f"`{n}`"), k) for n, k in kinds.items()), F.lit(_ROW_BYTES))
    return df.agg(F.sum(row.cast("long"))).first()[0] or 0


def bounded(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a hint to broadcast it if it has at most ``most`` bytes, counted now. A
    larger one is joined by a shuffle, whose skewed partitions Spark splits."""
    return F.broadcast(df) if bytes_of(df) <= most else df


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """A join in which null equals null. The keys are those of ``left``."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [left[k].eqNullSafe(other[f"_right_{k}"]) for k in keys]
    return left.join(other, on, how).drop(*(f"_right_{k}" for k in keys))


def numbered(df: DataFrame, *order: str, name: str = "no") -> DataFrame:
    """``df`` with ``name``, 0 to n - 1 in the order of the columns. The rows are dealt
    by ranges; only the sizes of the ranges pass the driver. Rows that are equal in
    all of ``order`` are in one range."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = cut(dealt.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = dealt.groupBy(part.alias("_part")).count().orderBy("_part").collect()
    starts, start = [], 0
    for size in sizes:
        starts.append((size["_part"], start))
        start += size["count"]
    before = df.sparkSession.createDataFrame(starts, "_part long, _start long")
    at = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    joined = dealt.withColumn("_part", part).join(F.broadcast(before), "_part")
    return joined.withColumn(name, at).drop("_part", "_at", "_start")


@contextmanager
def small_batches(spark: SparkSession, most: int = 8 << 20) -> Iterator[None]:
    """Jobs inside send tasks in Python at most so many bytes at once, on either side."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Spill:
    """Wide intermediate tables in the shared folder, or on the executors' disks; removed on leaving."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
        self.kept: list[DataFrame] = []

    def __enter__(self) -> Spill:
        return self

    def __exit__(self, *_: object) -> None:
        self.drop()
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        folder.getFileSystem(conf).delete(folder, True)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep(self, df: DataFrame) -> DataFrame:
        """``df``, kept on the executors' disks from its first use on, for what may be made anew
        where an executor is lost: the rows may come in another order then. Unlike a file, it is
        written and read a few MB at once, and Hadoop starts no process to set its permissions."""
        kept = df.persist(StorageLevel.DISK_ONLY)
        self.kept.append(kept)
        return kept

    def drop(self, *but: DataFrame) -> None:
        """Gives up what is kept on the executors' disks, but for these."""
        for df in self.kept:
            if not any(df is x for x in but):
                df.unpersist()
        self.kept = [df for df in self.kept if any(df is x for x in but)]


def lowered(text: Column) -> Column:
    """A-Z as a-z, all else as it is. ``lower`` does the same to pure ASCII, faster."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def text_hash() -> Column:
    """Of the column text; null counts as empty. Together with the id it tells documents apart."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


#: Stands for a null id where frames of numbers go to Python: a null would turn the
#: ids beside it into floats.
NO_ID = -(1 << 63)


def without_null(name: str) -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID)).alias(name)


def with_id(df: DataFrame, name: str = "doc_id") -> DataFrame:
    """``df`` with null for ``NO_ID``."""
    return df.withColumn(name, F.nullif(F.col(name), F.lit(NO_ID)))


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """The whole rows as ``_row``, beside the columns an operator looks at. Whatever
    names the operator uses, they don't clash with those of the rows."""
    return docs.select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("_row"), *columns)


def words(text: Column) -> Column:
    """The words of a text in order; null has none."""
    found = F.split(lowered(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.filter(found, lambda w: w != "")
