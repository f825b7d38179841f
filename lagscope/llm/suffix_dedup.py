"""Removal of repeated passages, by run-length compressed Burrows-Wheeler indexes.

A window is a string of ``WINDOW`` bytes; a byte goes if a window over it also starts
anywhere else.

1. Each window has an anchor: the n-gram in it with the smallest hash. Consecutive
   windows with the same anchor are a segment. Equal windows have equal anchors, so
   segments that meet by the anchor's hash decide about all their windows.
2. Anchors that occur once are done. Segments of an anchor with equal contents
   are copies, whole. Only the different contents of an anchor are fetched, once each.
3. Contents of many anchors make one index: the Burrows-Wheeler transform of all of
   them, of which only the run ends are sampled. The longest match of a position
   with its neighbour in suffix order is one byte shorter than that of the position
   before, unless a run starts there. So the matches at run ends, streamed along the
   text, give the matching statistics of all positions, and those of ``WINDOW`` bytes
   or more are marked.
4. An anchor with too many contents for an index is dealt anew by longer n-grams; the
   last ones are the windows themselves, of which equal ones are copies by then.
5. Marked passages of all copies of a segment are merged and left out of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import NO_ID, Spill, bounded, cut, mixed, text_hash, without_null

#: Bytes of a window.
WINDOW = 200
#: Bytes of an anchor, for all windows, and for those of anchors that have too many contents.
ANCHORS = (64, 128, WINDOW)
#: Bytes of contents in an index, and of one anchor in any.
INDEX_BYTES = 3 << 20
#: Bytes that are hashed at once; bits of the places of anchors among them.
_CHUNK = 1 << 20
_PLACE_BITS = 23
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
#: Symbols of nine bits in the first sort key of a suffix.
_FIRST = 7

_SEGMENTS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("doc", pa.int64()),
        ("start", pa.int32()),
        ("n", pa.int32()),
        ("h", pa.int64()),
        ("s", pa.int64()),
    ]
)
_SEGMENTS_DDL = "doc_id long, doc long, start int, n int, h long, s long"
_PLACE = ("doc_id", "doc", "start", "n")


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers, out=powers)


def _least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of each ``width`` neighbouring hashes, the first of equal ones."""
    low = np.uint64((1 << _PLACE_BITS) - 1)
    keys = hashes & ~low | np.arange(len(hashes), dtype=np.uint64)
    padded = np.full(-(-len(keys) // width) * width, np.uint64((1 << 64) - 1))
    padded[: len(keys)] = keys
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(keys) - width + 1
    return (np.minimum(behind[:n], ahead[width - 1 : width - 1 + n]) & low).astype(np.int64)


def segments_of(pieces: list[bytes], window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(piece, start, n, h, s) of the segments of pieces that hold a window each."""
    data = b"".join(pieces)
    octets = np.frombuffer(data, np.uint8)
    sums = np.zeros(len(octets) + 1, np.uint64)
    np.cumsum((octets + np.uint64(1)) * _powers(_BASE, len(octets)), out=sums[1:])
    # Each sum begins at another power of the base; divided by it, equal n-grams have equal sums.
    inverse = _powers(_BASE_INVERSE, len(octets) - anchor + 1)
    hashes = mixed((sums[anchor:] - sums[:-anchor]) * inverse)
    places = _least_places(hashes, window - anchor + 1)
    ends = np.cumsum([len(p) for p in pieces])
    piece = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])[: len(places)]
    at = np.flatnonzero(np.arange(len(places)) + window <= ends[piece])
    own, home = places[at], piece[at]
    new = np.ones(len(at), bool)
    new[1:] = (own[1:] != own[:-1]) | (home[1:] != home[:-1])
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(at)))
    begin, home = at[first], home[first]
    contents = zip(begin.tolist(), (begin + sizes + window - 1).tolist(), strict=True)
    digests = np.fromiter((xxhash.xxh3_64_intdigest(data[a:b]) for a, b in contents), np.uint64, len(first))
    starts = begin - (ends - [len(p) for p in pieces])[home]
    return home, starts, sizes, hashes[own[first]].view(np.int64), digests.view(np.int64)


def segmenter(window: int, anchor: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(doc_id, doc, text, ranges) to a row for each segment; ranges are windows
    (start, n), or null for all of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[tuple[int, int, int]] = []
        pieces: list[bytes] = []
        size = 0

        def flushed() -> pa.RecordBatch:
            home, start, n, h, s = segments_of(pieces, window, anchor)
            ids, docs, offsets = (np.array(c, np.int64) for c in zip(*keys, strict=True))
            start = (start + offsets[home]).astype(np.int32)
            columns = (ids[home], docs[home], start, n.astype(np.int32), h, s)
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_SEGMENTS)

        for batch in batches:
            for doc_id, doc, text, ranges in zip(*batch.columns, strict=True):
                octets = (text.as_py() or "").encode()
                whole = [{"start": 0, "n": len(octets) - window + 1}]
                for r in whole if ranges.as_py() is None else ranges.as_py():
                    for at in range(r["start"], r["start"] + r["n"], _CHUNK):
                        end = min(at + _CHUNK, r["start"] + r["n"]) + window - 1
                        keys.append((doc_id.as_py(), doc.as_py(), at))
                        pieces.append(octets[at:end])
                        size += end - at
                        if size >= _CHUNK:
                            yield flushed()
                            keys.clear()
                            pieces.clear()
                            size = 0
        if pieces:
            yield flushed()

    return run


def suffix_order(symbols: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Places of the suffixes in order. Zeros end the texts, in order of place; ``left``
    is the distance to the next one."""
    n = len(symbols)
    key = np.zeros(n, np.int64)
    padded = np.append(symbols, np.zeros(_FIRST, symbols.dtype))
    for i in range(_FIRST):
        key = key << 9 | np.where(left >= i, padded[i : i + n], 0)
    order = np.argsort(key, kind="stable")
    new = np.ones(n, bool)
    # A suffix that ends within the key is alone, as its end has a place.
    new[1:] = (key[order[1:]] != key[order[:-1]]) | (left[order[1:]] < _FIRST)
    heads = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = heads
    done = _FIRST
    alone = new & np.append(new[1:], True)
    open_rows = np.flatnonzero(~alone)
    while len(open_rows):
        places = order[open_rows]
        key = rank[places] << 32 | rank[places + done]
        by = np.argsort(key, kind="stable")
        places, key = places[by], key[by]
        order[open_rows] = places
        new = np.ones(len(places), bool)
        new[1:] = key[1:] != key[:-1]
        rank[places] = np.maximum.accumulate(np.where(new, open_rows, 0))
        open_rows = open_rows[~(new & np.append(new[1:], True))]
        done *= 2
    return order


def common(octets: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Bytes that the suffixes at a and b begin with alike, at most ``most``."""
    padded = np.append(octets, np.zeros(8, np.uint8))
    eights = np.zeros(len(octets) + 1, np.uint64)
    for i in range(8):
        eights = eights << np.uint64(8) | padded[i : i + len(eights)]
    same = np.zeros(len(a), np.int64)
    todo = np.flatnonzero(most > 0)
    while len(todo):
        at = same[todo]
        apart = eights[a[todo] + at] ^ eights[b[todo] + at]
        # The first byte that differs is the highest one.
        alike = np.full(len(todo), 8)
        for i in range(8):
            alike[(apart >> np.uint64(8 * i) & np.uint64(255)) != 0] = 7 - i
        same[todo] = np.minimum(at + alike, most[todo])
        todo = todo[(alike == 8) & (same[todo] < most[todo])]
    return same


def repeats(contents: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(content, start, end) of the passages whose windows also start elsewhere in ``contents``."""
    octets = np.frombuffer(b"".join(c + b"\0" for c in contents), np.uint8)
    sizes = np.array([len(c) + 1 for c in contents])
    ends = np.cumsum(sizes) - 1
    left = np.repeat(ends, sizes) - np.arange(len(octets))
    symbols = np.where(left > 0, octets.astype(np.int64) + 1, 0)
    order = suffix_order(symbols, left)
    # The transform: what stands before each suffix. The end of a text equals no other.
    before = symbols[order - 1]
    bounds = np.flatnonzero((before[1:] != before[:-1]) | (before[1:] == 0))
    # Samples: the last row of a run and the first of the next one.
    a, b = order[bounds], order[bounds + 1]
    most = np.minimum(left[a], left[b])
    long = most >= window
    a, b, most = a[long], b[long], most[long]
    same = common(octets, a, b, most)
    long = same >= window
    starts = np.concatenate([a[long], b[long]])
    # Streamed along the text: how many matches are open at each byte.
    opened = np.bincount(starts, minlength=len(octets) + 1)
    opened -= np.bincount(starts + np.tile(same[long], 2), minlength=len(octets) + 1)
    marked = np.diff(np.cumsum(opened) > 0, prepend=False).nonzero()[0].reshape(-1, 2)
    home = np.searchsorted(ends, marked[:, 0])
    base = (ends - sizes + 1)[home]
    return home, marked[:, 0] - base, marked[:, 1] - base


_MARKS = pa.schema([("h", pa.int64()), ("s", pa.int64()), ("a", pa.int32()), ("b", pa.int32())])


def indexer(window: int, limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(h, s, content), sorted by h, to the repeated passages of each content. An index
    holds whole anchors, up to ``limit`` bytes and one anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[tuple[int, int]] = []
        contents: list[bytes] = []
        size = 0

        def flushed() -> pa.RecordBatch:
            home, a, b = repeats(contents, window)
            h, s = (np.array(c, np.int64) for c in zip(*keys, strict=True))
            columns = (h[home], s[home], a.astype(np.int32), b.astype(np.int32))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_MARKS)

        for batch in batches:
            for h, s, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= limit and h != keys[-1][0]:
                    yield flushed()
                    keys.clear()
                    contents.clear()
                    size = 0
                keys.append((h, s))
                contents.append(content)
                size += len(content)
        if keys:
            yield flushed()

    return run


def _fetched(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(text, wanted) to (h, s, content) of the wanted segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, wanted in zip(*batch.columns, strict=True):
                octets = text.as_py().encode()
                rows = [
                    (w["h"], w["s"], octets[w["start"] : w["start"] + w["n"] + window - 1])
                    for w in wanted.as_py()
                ]
                h, s, contents = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, pa.int64()), pa.array(s, pa.int64()), pa.array(contents, pa.binary())],
                    names=["h", "s", "content"],
                )

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(without_null("doc_id"), text_hash().alias("doc"), "text")


def _of_documents(docs: DataFrame, rows: DataFrame, name: str, *columns: str) -> DataFrame:
    """Documents (doc_id, doc, text) that have ``rows``, which are an array ``name`` of ``columns``."""
    lists = rows.groupBy("doc_id", "doc").agg(F.collect_list(F.struct(*columns)).alias(name))
    return _keyed(docs).join(lists, ["doc_id", "doc"])


def _level(
    docs: DataFrame, ranges: DataFrame | None, window: int, anchor: int, limit: int, spill: Spill
) -> tuple[list[DataFrame], DataFrame]:
    """Marks (doc_id, doc, start, end) and what is left: windows (doc_id, doc, start, n) of
    anchors with too many contents."""
    if ranges is None:
        texts = _keyed(docs).withColumn("ranges", F.lit(None).cast("array<struct<start:int,n:int>>"))
    else:
        texts = _of_documents(docs, ranges, "ranges", "start", "n")
    texts = texts.select("doc_id", "doc", "text", "ranges")
    found = spill.write(texts.mapInArrow(segmenter(window, anchor), _SEGMENTS_DDL), f"segments{anchor}")
    anchors = found.groupBy("h").agg(
        F.count("*").alias("times"), F.min("s").alias("low"), F.max("s").alias("high")
    )
    anchors = cut(anchors.filter("times > 1").select("h", (F.col("low") != F.col("high")).alias("several")))
    met = spill.write(found.join(anchors, "h"), f"met{anchor}")
    end = F.col("start") + F.col("n") + (window - 1)
    whole = met.filter("not several").select("doc_id", "doc", "start", end.alias("end"))
    several = met.filter("several")
    # The last anchors are whole windows: only a clash of their hashes has several contents.
    variants = several.groupBy("h", "s").agg(
        F.count("*").alias("times"), F.min(F.struct(*_PLACE)).alias("place")
    )
    variants = cut(variants.select("h", "s", "times", "place.*"))
    sizes = variants.groupBy("h").agg(F.sum(F.col("n").cast("long") + (window - 1)).alias("size"))
    large = cut(sizes.filter(F.col("size") > limit).select("h"))
    small = variants.join(bounded(large), "h", "left_anti") if anchor < window else variants
    again = variants.join(bounded(large), "h", "left_semi") if anchor < window else variants.filter("false")
    wanted = _of_documents(docs, small, "wanted", "h", "s", "start", "n").select("text", "wanted")
    contents = wanted.mapInArrow(_fetched(window), "h long, s long, content binary")
    # Rows of the same id and text give the same contents.
    contents = spill.write(contents.dropDuplicates(["h", "s"]), f"contents{anchor}")
    total = contents.agg(F.sum(F.length("content"))).first()[0] or 0
    parts = 1 + max(total // limit, docs.sparkSession.sparkContext.defaultParallelism)
    dealt = contents.repartition(int(parts), "h").sortWithinPartitions("h")
    marks = cut(dealt.mapInArrow(indexer(window, limit), "h long, s long, a int, b int"))
    inner = several.join(marks, ["h", "s"]).select(
        "doc_id",
        "doc",
        (F.col("start") + F.col("a")).alias("start"),
        (F.col("start") + F.col("b")).alias("end"),
    )
    copies = several.join(variants.filter("times > 1").select("h", "s"), ["h", "s"])
    copies = copies.select("doc_id", "doc", "start", end.alias("end"))
    return [whole, inner, copies], again.select(*_PLACE)


_KEPT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
    ]
)


def kept_parts(octets: bytes, spans: list[dict]) -> list[bytes]:
    """What stands between the spans, which are merged and in order."""
    edges = [0, *(x for span in spans for x in (span["start"], span["end"])), len(octets)]
    return [octets[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, spans in zip(*batch.columns, strict=True):
            octets, cuts = (text.as_py() or "").encode(), spans.as_py() or []
            kept, sha = 0, hashlib.sha256()
            for part in kept_parts(octets, cuts):
                kept += len(part)
                sha.update(part)
            rows.append((doc_id.as_py(), len(octets), len(octets) - kept, len(cuts), sha.hexdigest()))
        columns = list(zip(*rows, strict=True)) or [()] * len(_KEPT)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, _KEPT, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, schema=_KEPT)


def repeated_spans(
    docs: DataFrame,
    window: int = WINDOW,
    anchors: tuple[int, ...] = ANCHORS,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """(doc_id, doc, spans) of the documents with repeated passages: spans is an array of
    (start, end) in bytes, merged and in order; doc is the hash of the text, and a null
    id is ``NO_ID``."""
    if anchors[-1] != window:
        raise ValueError("the last anchors must be the windows")
    with Spill(docs.sparkSession, "passages") as spill:
        marks: list[DataFrame] = []
        ranges = None
        for anchor in anchors:
            found, ranges = _level(docs, ranges, window, anchor, index_bytes, spill)
            marks += found
            ranges = cut(ranges)
            if ranges.isEmpty():
                break
        rows = reduce(DataFrame.union, marks)
        by_start = Window.partitionBy("doc_id", "doc").orderBy("start", "end")
        so_far = by_start.rowsBetween(Window.unboundedPreceding, -1)
        opens = F.coalesce(F.col("start") > F.max("end").over(so_far), F.lit(True)).cast("int")
        rows = rows.withColumn("opens", opens).withColumn("span", F.sum("opens").over(by_start))
        merged = rows.groupBy("doc_id", "doc", "span").agg(F.min("start").alias("start"), F.max("end").alias("end"))
        spans = merged.groupBy("doc_id", "doc").agg(
            F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")
        )
        return cut(spans)


def passage_digest(
    docs: DataFrame,
    window: int = WINDOW,
    anchors: tuple[int, ...] = ANCHORS,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 (of what is left).

    Texts are UTF-8; null counts as empty. A removed run may begin or end inside a
    character. Rows with the same id and text, with or without an id, are documents
    that repeat each other. Texts shorter than a window stay as they are. Without
    documents the result is empty. Other columns are not looked at.
    """
    spans = repeated_spans(docs, window, anchors, index_bytes)
    rows = _keyed(docs).join(spans, ["doc_id", "doc"], "left").select("doc_id", "text", "spans")
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    found = cut(rows.mapInArrow(_digests, ddl))
    return found.withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(NO_ID)))
