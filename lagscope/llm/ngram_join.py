"""Near copies by n-gram Jaccard similarity, found through MinHash bands.

1. Documents with equal text form a class; each class has one signature.
2. Bands of the signature are hashed, and classes that share a band hash meet.
   Bands and rows are chosen so that a pair at the threshold meets with the
   target recall.
3. Where classes meet, the signatures' estimate of the similarity drops chance
   meetings. Its margin is six standard errors, so it loses no link. What is left
   connects classes to clusters.
4. In each cluster all pairs are verified on their full n-gram sets.

Copies are never expanded into pairs, and pairs never become rows: tasks return
counts of links and the few links that connect a group. Large buckets and
clusters are divided into blocks, and every two blocks meet in a task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import WORD_RE, WordHashes, bounded, cut, mixed, null_safe_join, packed, with_id, without_null
from .blocks import blocks_of, dealt, grouped, slices
from .components import Forest, components

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.9999
#: Members of a bucket or cluster that one task compares with as many others.
BUCKET_BLOCK = 2048
CLUSTER_BLOCK = 256
_MAX_ROWS = 12
#: n-grams that are compared at once.
_COLUMNS = 8192


def choose_bands(threshold: float, recall: float) -> tuple[int, int]:
    """(bands, rows): the fewest hashes per false meeting that reach the recall.

    A pair of similarity s meets with probability ``1 - (1 - s**rows)**bands``.
    More rows mean fewer meetings by chance and more bands; the choice is the
    largest number of rows that needs at most 128 hashes. If not even one row does, it
    raises an error.
    """
    best = None
    for rows in range(1, _MAX_ROWS + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if bands * rows <= 128:
            best = (bands, rows)
    if best is None:
        raise ValueError(f"128 hashes don't find pairs of similarity {threshold} with a recall of {recall}")
    return best


def ngrams(text: str | None, hashes: dict, n: int = NGRAM) -> np.ndarray:
    """Sorted 64-bit hashes of the text's word n-grams. A text of fewer words has
    one n-gram of all of them, a text without words none."""
    found = WORD_RE.findall((text or "").lower())
    if not found:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    count = max(1, len(w) - n + 1)
    h = np.zeros(count, np.uint64)
    for i in range(min(n, len(w))):
        h = h * np.uint64(0x9E3779B97F4A7C15) + w[i : i + count]
    return np.unique(mixed(h))


def _coefficients(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20170414)
    a = rng.integers(1 << 62, (1 << 63) - 1, hashes, dtype=np.uint64) | np.uint64(1)
    return a, rng.integers(0, (1 << 63) - 1, hashes, dtype=np.uint64)


def signer(bands: int, rows: int, n: int) -> Callable:
    """(key, doc_id, text) to (key, doc_id, bands, sketch); the sketch is a byte of each hash."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = _coefficients(bands * rows)
        weights = np.arange(1, rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        weights |= np.uint64(1)
        hashes = WordHashes()
        for frame in frames:
            band_hashes, sketches = [], []
            for text in frame["text"]:
                grams = ngrams(text, hashes, n)
                if not len(grams):
                    band_hashes.append([])
                    sketches.append(b"")
                    continue
                low = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
                for at in range(0, len(grams), 1024):
                    low = np.minimum(low, (grams[at : at + 1024, None] * a + b).min(axis=0))
                low = mixed(low)
                joined = mixed((low.reshape(bands, rows) * weights).sum(axis=1, dtype=np.uint64))
                band_hashes.append(joined.view(np.int64))
                sketches.append((low & np.uint64(255)).astype(np.uint8).tobytes())
            yield pd.DataFrame(
                {
                    "key": frame["key"],
                    "doc_id": frame["doc_id"],
                    "bands": band_hashes,
                    "sketch": sketches,
                }
            )

    return run


def meeting(hashes: int, least: float) -> Callable:
    """Links (a, b) that connect what a bucket's members with an estimate of at
    least ``least`` form. Byte sketches agree by chance once in 256."""
    need = hashes * (least + (1 - least) / 256)

    def linked(ids: np.ndarray, sketches: np.ndarray) -> list[tuple[int, int]]:
        forest, links = Forest(len(ids)), []
        todo = np.arange(len(ids))
        while len(todo) > 1:
            # All that are near to the first are one group; the rest is compared with
            # that group until it has no more of its own.
            front, rest = todo[:1], todo[1:]
            while len(front) and len(rest):
                near = np.zeros(len(rest), bool)
                after = []
                for x in front:
                    same = (sketches[rest] == sketches[x]).sum(axis=1) >= need
                    new = same & ~near
                    for y in rest[new]:
                        if forest.join(int(x), int(y)):
                            links.append((int(ids[x]), int(ids[y])))
                    near |= new
                    if near.all():
                        break
                after = rest[near]
                rest = rest[~near]
                front = after
            todo = rest
        return links

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = ["band", "hash", "i", "j"]
        for frame in grouped(frames, keys):
            links: list[tuple[int, int]] = []
            ids = frame["id"].to_numpy()
            sketches = np.frombuffer(b"".join(frame["sketch"]), np.uint8).reshape(len(frame), -1)
            for start, end in slices(frame, keys):
                if end - start == 2:
                    if (sketches[start] == sketches[start + 1]).sum() >= need:
                        links.append((ids[start], ids[start + 1]))
                elif end - start > 2:
                    links += linked(ids[start:end], sketches[start:end])
            yield pd.DataFrame(sorted(set(links)), columns=["a", "b"], dtype="int64")

    return run


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each two sets share."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    grams, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.full(len(grams), -1)
    column[count > 1] = np.arange(int((count > 1).sum()))
    at = column[inverse]
    owner, at = owner[at >= 0], at[at >= 0]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    width = int(at[-1]) + 1 if len(at) else 0
    for low in range(0, width, _COLUMNS):
        left, right = np.searchsorted(at, [low, low + _COLUMNS])
        block = np.zeros((len(sets), min(_COLUMNS, width - low)), np.float32)
        block[owner[left:right], at[left:right] - low] = 1
        shared += block @ block.T
    return shared


def verifying(threshold: float, n: int) -> Callable:
    """For each member of a cluster's blocks its links (id, links, linked_docs, other = id),
    and links (id, other) that connect those that are linked."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = ["root", "i", "j"]
        hashes = WordHashes()
        for frame in grouped(frames, keys):
            out: list[tuple] = []
            for start, end in slices(frame, keys):
                part = frame.iloc[start:end]
                ids, side = part["id"].to_numpy(), part["side"].to_numpy()
                copies = part["copies"].to_numpy()
                sets = [ngrams(t, hashes, n) for t in part["text"]]
                sizes = np.array([len(s) for s in sets], np.float32)
                both = shared_counts(sets)
                union = sizes[:, None] + sizes[None, :] - both
                # In doubles, so that a similarity of exactly the threshold counts.
                linked = both.astype(np.float64) >= threshold * union.astype(np.float64) - 1e-9
                np.fill_diagonal(linked, False)
                if part["i"].iloc[0] != part["j"].iloc[0]:
                    # Pairs within a block belong to the task of that block alone.
                    linked &= side[:, None] != side[None, :]
                forest = Forest(len(ids))
                for x in np.flatnonzero(linked.any(axis=1)):
                    others = np.flatnonzero(linked[x])
                    out.append((ids[x], len(others), copies[others].sum(), ids[x]))
                    out += [(ids[x], 0, 0, ids[y]) for y in others if forest.join(int(x), int(y))]
            yield pd.DataFrame(out, columns=["id", "links", "linked_docs", "other"], dtype="int64")

    return run


def _key() -> F.Column:
    return F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("null")).alias("key")


def _classes(docs: DataFrame, threshold: float, n: int, recall: float) -> tuple[DataFrame, DataFrame]:
    """The documents (key of the text, doc_id), and their classes: key, class_id,
    class_size, links, linked_docs, id, root (the same within a group)."""
    bands, rows = choose_bands(threshold, recall)
    hashes = bands * rows
    keyed = docs.select(without_null("doc_id"), _key(), "text")
    signed = keyed.mapInPandas(
        signer(bands, rows, n), "key string, doc_id long, bands array<long>, sketch binary"
    )
    signed = cut(with_id(signed))
    # A class has a number of its own, as ids may be null or repeated.
    classes = cut(
        signed.groupBy("key")
        .agg(
            F.min("doc_id").alias("class_id"),
            F.count(F.lit(1)).alias("class_size"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
        )
        .withColumn("id", F.monotonically_increasing_id())
    )
    buckets = classes.select("id", F.posexplode("bands").alias("band", "hash"))
    met = blocks_of(buckets, ["band", "hash"], BUCKET_BLOCK)
    met = met.join(classes.select("id", "sketch"), "id").drop("side")
    margin = 6 * math.sqrt(threshold * (1 - threshold) / hashes)
    candidates = dealt(met, ["band", "hash", "i", "j"]).mapInPandas(
        meeting(hashes, threshold - margin), "a long, b long"
    )
    clusters = cut(components(candidates))
    members = clusters.join(classes.select("id", "key", F.col("class_size").alias("copies")), "id")
    members = blocks_of(members, ["root"], CLUSTER_BLOCK)
    # One text for each class that has a candidate.
    wanted = clusters.join(classes.select("id", "key"), "id").select("key")
    texts = (
        keyed.select("key", "text")
        .join(bounded(wanted), "key", "left_semi")
        .groupBy("key")
        .agg(F.first("text").alias("text"))
    )
    work = members.join(texts, "key").select("root", "i", "j", "side", "id", "copies", "text")
    verified = cut(
        dealt(work, ["root", "i", "j"]).mapInPandas(
            verifying(threshold, n), "id long, links long, linked_docs long, other long"
        )
    )
    counts = ("links", "linked_docs")
    links = verified.groupBy("id").agg(*(F.sum(c).alias(c) for c in counts))
    roots = components(verified.select(F.col("id").alias("a"), F.col("other").alias("b")))
    named = classes.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    named = named.join(links, "id", "left")
    numbers = (F.coalesce(c, F.lit(0)).alias(c) for c in counts)
    named = named.select("key", "class_id", "class_size", *numbers, "id", "root")
    return signed.select("key", "doc_id"), named


def near_copies(
    docs: DataFrame, threshold: float = THRESHOLD, n: int = NGRAM, recall: float = RECALL
) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, links, linked_docs, group_id.

    class_id is the smallest id of the documents with the same text, links the number
    of other classes with a similarity of at least ``threshold``, linked_docs their
    documents, and group_id the smallest id of the classes that are connected by
    links. Words are lower-cased and free of punctuation. A text of fewer than ``n``
    words is one n-gram; null and wordless texts have no links, and are classes
    of their own (null apart from empty). Classes without any id have class_id null.
    Rows with the same id count one by one. Without documents the result is empty.
    """
    documents, classes = _classes(docs, threshold, n, recall)
    groups = classes.groupBy("root").agg(F.min("class_id").alias("group_id"))
    return documents.join(classes.join(groups, "root"), "key").select(
        "doc_id", "class_id", "class_size", "links", "linked_docs", "group_id"
    )


def one_of_each_group(
    docs: DataFrame, threshold: float = THRESHOLD, n: int = NGRAM, recall: float = RECALL
) -> DataFrame:
    """``docs`` with one document of each group of linked classes, the one with the
    smallest id (null last). Of equal rows one stays. All columns are kept."""
    documents, classes = _classes(docs, threshold, n, recall)
    order = F.struct(F.col("class_id").isNull().alias("none"), "class_id", "id")
    best = classes.groupBy("root").agg(F.min(order).alias("best")).select("best.*")
    keepers = best.select("id", F.lit(True).alias("_best"))
    judged = classes.join(keepers, "id", "left").select("key", "class_id", "_best")
    pairs = documents.groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("_rows"))
    stays = F.coalesce("_best", F.lit(False)) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    pairs = cut(pairs.join(judged, "key").select("key", "doc_id", "_rows", stays.alias("_stays")))
    keyed = packed(docs, F.col("doc_id").cast("long"), _key())
    gone = bounded(pairs.filter("not _stays").select("key", "doc_id"))
    kept = null_safe_join(keyed, gone, ["key", "doc_id"], "left_anti")
    if not pairs.filter("_stays and _rows > 1").isEmpty():
        kept = kept.groupBy("key", "doc_id").agg(F.first("_row").alias("_row"))
    return kept.select("_row.*")
