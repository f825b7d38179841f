"""Exact deduplication by Grace hashing.

Records are partitioned by a hash of their content until what a task holds fits
an open-addressing table, which compares complete contents. The spill files are
tables in the shared folder:

1. Each task replaces the copies it meets by one record with a count and the
   smallest id, so that a content held by a third of all rows leaves a task once.
2. Records are partitioned by hash, one table per partition. A full table takes no
   new contents: records that equal an entry are merged, all others are spilled.
3. The spilled records are partitioned again, by other bits of the hash, until
   none are left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import SPACE, Spill, cut

#: Bytes of content that a table holds; a partition is planned for a quarter of it.
TABLE_BYTES = 128 << 20
_BATCH = 2000

_RECORDS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("rep", pa.int64()),
        ("sha", pa.string()),
        ("content", pa.string()),
        ("low", pa.int64()),
        ("n", pa.int64()),
    ]
)
_DDL = "doc_id long, rep long, sha string, content string, low long, n long"


class OpenTable:
    """Contents by linear probing; a hash that is equal proves nothing, contents are compared."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[str] = []
        self.bytes = 0

    def find(self, hashed: int, content: str) -> tuple[int, int]:
        """The entry that equals the content, or -1, and the slot where it ends."""
        mask = len(self.slots) - 1
        at = hashed & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == hashed and self.contents[entry] == content:
                return entry, at
            at = (at + 1) & mask
        return -1, at

    def add(self, hashed: int, content: str, at: int) -> int:
        entry = len(self.contents)
        self.slots[at] = entry
        self.hashes.append(hashed)
        self.contents.append(content)
        self.bytes += 2 * len(content) + 100
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return entry

    def _grow(self) -> None:
        self.slots = [-1] * (4 * len(self.slots))
        mask = len(self.slots) - 1
        for entry, hashed in enumerate(self.hashes):
            at = hashed & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def _bits(sha: str, level: int) -> int:
    """Bits of the hash for a table; partitions use others (see _bucket)."""
    return int(sha[32 + level % 16 : 47 + level % 16], 16)


def _bucket(level: int) -> F.Column:
    return F.substring(F.col("sha"), 1 + 4 * (level % 7), 7)


def _least(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def _emitted(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_RECORDS)
    return pa.record_batch(
        [pa.array(c, f.type) for c, f in zip(columns, _RECORDS, strict=True)], schema=_RECORDS
    )


def _in_batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    """Batches that are bounded in rows and in text."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[3] or "")
        if len(held) >= _BATCH or size > 8 << 20:
            yield _emitted(held)
            held, size = [], 0
    if held:
        yield _emitted(held)


def combine(limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Step 1: a member row for each document, a record for each content met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        table, lows, counts, shas = OpenTable(), [], [], []

        def flushed() -> Iterator[pa.RecordBatch]:
            return _in_batches(
                (None, base + made + i, shas[i], content, lows[i], counts[i])
                for i, content in enumerate(table.contents)
            )

        for batch in batches:
            members = []
            for doc_id, sha, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashed = _bits(sha, 0)
                entry, at = table.find(hashed, content)
                if entry < 0:
                    entry = table.add(hashed, content, at)
                    lows.append(doc_id)
                    counts.append(1)
                    shas.append(sha)
                else:
                    lows[entry] = _least(lows[entry], doc_id)
                    counts[entry] += 1
                members.append((doc_id, base + made + entry, None, None, None, None))
            yield from _in_batches(members)
            if table.bytes > limit:
                yield from flushed()
                made += len(table.contents)
                table, lows, counts, shas = OpenTable(), [], [], []
        yield from flushed()

    return run


def build(level: int, limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Step 2: for each record of the partition its group (content null), or the
    record again if the table is full."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = OpenTable()
        lows: list[int | None] = []
        counts: list[int] = []
        shas: list[str] = []
        reps: list[tuple[int, int]] = []
        for batch in batches:
            full = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                _, rep, sha, content, low, n = row
                hashed = _bits(sha, level)
                entry, at = table.find(hashed, content)
                if entry < 0 and table.bytes > limit:
                    full.append(row)
                    continue
                if entry < 0:
                    entry = table.add(hashed, content, at)
                    lows.append(low)
                    counts.append(n)
                    shas.append(sha)
                else:
                    lows[entry] = _least(lows[entry], low)
                    counts[entry] += n
                reps.append((rep, entry))
            yield from _in_batches(full)
        yield from _in_batches((None, r, shas[e], None, lows[e], counts[e]) for r, e in reps)

    return run


def exact_dedup(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are after each run of white space became one space;
    null counts as empty. The smallest id of a group stays. A null id is larger
    than any other; of rows with the same smallest id all count as kept, and so do
    the rows of a group without any id. An empty table gives an empty result.
    Other columns are not looked at.
    """
    spark = docs.sparkSession
    content = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), SPACE, " ")
    rows = docs.select(F.col("doc_id").cast("long"), content.alias("content"))
    rows = rows.select("doc_id", F.sha2("content", 256).alias("sha"), "content")
    with Spill(spark, "grace") as spill:
        first = spill.write(rows.mapInArrow(combine(table_bytes), _DDL), "combined")
        members = first.filter("content is null").select("doc_id", "rep")
        records, level, groups = first.filter("content is not null"), 0, []
        while True:
            size = records.agg(F.sum(F.octet_length("content")), F.count(F.lit(1))).first()
            if not size[1]:
                break
            buckets = 1 + max(
                size[0] * 4 // table_bytes, spark.sparkContext.defaultParallelism * 2
            )
            dealt = records.repartition(int(buckets), _bucket(level))
            out = spill.write(dealt.mapInArrow(build(level, table_bytes), _DDL), f"level{level}")
            groups.append(out.filter("content is null"))
            records, level = out.filter("content is not null"), level + 1
        found = records.filter("false") if not groups else groups[0]
        for more in groups[1:]:
            found = found.unionByName(more)
        found = found.select(
            "rep",
            F.col("low").alias("keep_id"),
            F.col("n").alias("group_size"),
            F.col("sha").alias("text_sha256"),
        )
        return cut(
            members.join(found, "rep").select(
                "doc_id",
                "keep_id",
                "group_size",
                F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                "text_sha256",
            )
        )
