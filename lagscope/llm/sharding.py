"""Shards of near-equal size: longest processing time first.

Rows of equal text form a group that stays together. Groups go by falling size
to the least loaded shard, which a heap yields. The heap sees a bounded number of
items, at most ``2 * FINE * shards``: every group of at least 1/(FINE * shards)
of all bytes is an item (there cannot be more than FINE * shards of those), and
the smaller groups are gathered by a hash into FINE * shards bins, each an item.
Loads then differ by about one bin, far below a percent, unless one group alone
exceeds a shard's share.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .base import cut, packed

FINE = 256
#: An item's rows are numbered in parts of at most this many, and of at most this
#: share of all rows.
SLOT_ROWS = 1_000_000
SLOT_PARTS = 1024


def least_loaded(items: Iterable[tuple[str, int]], shards: int) -> dict[str, int]:
    """Items (name, size), largest first, each to the shard with the least so far.
    Equal sizes go by name, equal loads by shard number."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for name, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        placed[name] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with size (UTF-8 bytes plus 1), text_crc32 and ``_group``, equal
    for equal texts. Null has size 1 and forms a group apart from the empty text.
    Columns of these names are replaced."""
    text = F.col("text")
    return docs.withColumns(
        {
            "size": F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1,
            "text_crc32": F.crc32(F.coalesce(text, F.lit("")).cast("binary")),
            "_group": F.coalesce(F.md5(text.cast("binary")), F.lit("null")),
        }
    )


def shard(rows: DataFrame, shards: int = 16) -> DataFrame:
    """Measured ``rows`` with law ("bytes"), shard, slot and grown_shard (null).

    A slot is the row's place in its shard, without gaps. Equal rows, ties and
    nulls are placed like others; an empty table gives an empty result. Columns
    of the new names are replaced; ``_group`` is dropped. ``rows`` is read twice
    and must give the same rows each time.
    """
    spark = rows.sparkSession
    n_items = FINE * shards
    groups = cut(
        rows.groupBy("_group").agg(
            F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")
        )
    )
    total = groups.agg(F.sum("_bytes")).first()[0] or 0
    bin_of = F.concat(F.lit("bin "), F.pmod(F.xxhash64("_group"), F.lit(n_items)).cast("string"))
    large = F.col("_bytes") * n_items >= total
    items = (
        groups.groupBy(F.when(large, F.col("_group")).otherwise(bin_of).alias("_item"))
        .agg(F.sum("_bytes").alias("_bytes"), F.sum("_rows").alias("_rows"))
        .collect()
    )
    placed = least_loaded(((r["_item"], r["_bytes"]) for r in items), shards)
    n_rows = sum(r["_rows"] for r in items)

    def parts(n: int) -> int:
        return 1 + max(n // SLOT_ROWS, n * SLOT_PARTS // n_rows)

    # At most 2 * FINE * shards rows, so both joins may broadcast them.
    schema = T.StructType(
        [
            T.StructField("_item", T.StringType()),
            T.StructField("shard", T.IntegerType()),
            T.StructField("_salts", T.LongType()),
        ]
    )
    where = F.broadcast(
        spark.createDataFrame(
            [(r["_item"], placed[r["_item"]], parts(r["_rows"])) for r in items], schema
        )
    )
    own = where.filter(~F.startswith("_item", F.lit("bin "))).select(
        F.col("_item").alias("_group"), F.lit(True).alias("_own")
    )
    put = (
        rows.drop("shard", "slot", "law", "grown_shard")
        .join(own, "_group", "left")
        .withColumn("_item", F.when(F.col("_own"), F.col("_group")).otherwise(bin_of))
        .join(where, "_item")
        .withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.col("_salts")))
    )
    part = ["shard", "_item", "_salt"]
    before = Window.partitionBy("shard").orderBy("_item", "_salt")
    starts = (
        put.groupBy(*part)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.sum("_n").over(before) - F.col("_n"))
        .drop("_n")
    )
    within = Window.partitionBy(*part).orderBy("_group", "doc_id")
    return (
        put.withColumn("_place", F.row_number().over(within))
        .join(starts, part)
        .withColumns(
            {
                "law": F.lit("bytes"),
                "slot": (F.col("_start") + F.col("_place") - 1).cast("long"),
                "grown_shard": F.lit(None).cast("int"),
            }
        )
        .drop("_group", "_own", "_item", "_salts", "_salt", "_start", "_place")
    )


def shard_digest(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Where each document goes, without its text."""
    sized = measured(docs.select("doc_id", "text")).drop("text")
    return shard(cut(sized), shards).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


def sharded(docs: DataFrame, shards: int = 16) -> DataFrame:
    """``docs`` with the columns of ``shard_digest``, which replace others of their names."""
    put = shard(measured(packed(docs, "doc_id", "text")).drop("text"), shards)
    new = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    taken = {c.lower() for c in new}
    return put.select(*(f"_row.`{c}`" for c in docs.columns if c.lower() not in taken), *new)
