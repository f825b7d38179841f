"""Frequent phrases, counted pair by pair in tiles that are addressed directly.

1. Words that occur often enough get numbers by frequency, the most frequent one 0, over
   all languages. Texts become blocks of numbers; anything else is a gap.
2. Two neighbouring numbers are a pair. Cut by their leading bits, all pairs form
   tiles of ``TILE`` x ``TILE`` cells. A tile with many pairs is counted by addressing its
   cells (bincount), others as sorted cells with counts. Tasks sum up what they meet
   before anything is shuffled; a tile that many tasks fill is merged in two rounds.
3. Frequent pairs are numbered by frequency again, and blocks become blocks of their
   numbers. Two neighbours, which overlap in all but one word, are a pair of the next
   level: phrases of three words, and so on.
4. Numbers travel as a broadcast table while they are few; else each block asks for
   the numbers of what it holds, by a join.

A phrase is as frequent as its rarest part at most, so no frequent one is missed.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import Spill, bounded, bytes_of, cut, numbered, small_batches

#: Words of the longest phrase, occurrences of a candidate, phrases of a language.
LONGEST = 5
AT_LEAST = 100
FIRST = 2000
#: A phrase goes if a longer one has so many percent of its occurrences.
INSIDE = 100
#: Numbers on a side of a tile: two to the power of this.
_SIDE_BITS = 10
_CELL_BITS = 2 * _SIDE_BITS
_CELLS = 1 << _CELL_BITS
#: Numbers are below two to the power of this, so that tile and cell fit 64 bits.
_ID_BITS = 31
#: Pairs of a block from which a tile is counted by addressing its cells.
_DENSE = _CELLS // 32
#: Dense tiles and sparse cells that a task holds, cells of a row and of a step of merging.
_HELD_TILES = 6
_HELD_CELLS = 1 << 20
_ROW_CELLS = 1 << 14
_STEP_CELLS = 1 << 20
#: Cells of a tile that one task merges.
_MERGED_CELLS = 1 << 22
#: Numbers of a block, numbers whose pairs are counted at once, distinct words of a partial
#: count. Writers hold a hundred rows at least, so that blocks are small.
_BLOCK = 1 << 16
_COUNTED = 1 << 19
_HELD_WORDS = 300_000
#: Bytes of numbers that are broadcast.
LOOKUP_BYTES = 32 << 20

#: Ends of pieces as a byte that UTF-8 doesn't have.
_GAP = b"\xff"
_PIECES = bytes(0xFF if b in b".,;:!?\x0a\x0b\x0c\x0d" else b for b in range(256))


def tokens(text: str | None) -> list[bytes]:
    """The words of a text, A-Z as a-z, with ``_GAP`` between pieces."""
    marked = (text or "").encode().lower().translate(_PIECES)
    return marked.replace(_GAP, b" \xff ").split()


class Numbers(dict):
    """Numbers of words; unknown ones are a gap, or get the next number if ``open``."""

    def __init__(self, known: dict[bytes, int] | None = None):
        super().__init__(known or {})
        self.open = known is None
        self.words: list[bytes] = []
        self[_GAP] = -1

    def __missing__(self, word: bytes) -> int:
        if not self.open:
            return -1
        self[word] = number = len(self.words)
        self.words.append(word)
        return number


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, word, f); of all words together where the word is null."""
    counts: dict[str, Counter] = {}

    def flushed() -> Iterator[pa.RecordBatch]:
        for lang, found in counts.items():
            found.pop(_GAP, None)
            words = [None, *found]
            sizes = [sum(found.values()), *found.values()]
            columns = [pa.array([lang] * len(words)), pa.array(words, pa.string()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "f"])
        counts.clear()

    for batch in batches:
        for lang, text in zip(*batch.columns, strict=True):
            counts.setdefault(lang.as_py(), Counter()).update(tokens(text.as_py()))
            if sum(map(len, counts.values())) > _HELD_WORDS:
                yield from flushed()
    yield from flushed()


def _blocks(names: tuple[str, ...]) -> Callable[..., pa.RecordBatch]:
    """Makes rows with a block number of their own."""
    base = [TaskContext.get().partitionId() << 32]

    def row(*values: pa.Array) -> pa.RecordBatch:
        base[0] += 1
        return pa.RecordBatch.from_arrays([pa.array([base[0]]), *values], names=["block", *names])

    return row


def _binary(numbers: np.ndarray) -> pa.Array:
    """Numbers of a block, compressed after their size in bytes."""
    plain = numbers.astype(np.int32).tobytes()
    found = pa.compress(plain, codec="zstd", asbytes=True)
    return pa.array([len(plain).to_bytes(8, "little") + found], pa.binary())


def _codes(block: pa.BinaryScalar) -> np.ndarray:
    found = memoryview(block.as_buffer())
    size = int.from_bytes(found[:8], "little")
    return np.frombuffer(pa.decompress(found[8:], size, codec="zstd"), np.int32)


def word_blocks(lookup) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(lang, text) to blocks of numbers: (block, codes) with a broadcast ``lookup`` by
    language, else (block, codes, lang, words), whose numbers are places in words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = _blocks(("codes",) if lookup else ("codes", "lang", "words"))
        fixed = {k: Numbers(v) for k, v in lookup.value.items()} if lookup else {}
        held: dict[str, tuple[Numbers, array]] = {}

        def flushed(lang: str) -> pa.RecordBatch:
            numbers, codes = held.pop(lang)
            found = _binary(np.array(codes))
            if lookup:
                return row(found)
            return row(found, pa.array([lang]), pa.array([numbers.words], pa.list_(pa.string())))

        for batch in batches:
            for lang, text in zip(*batch.columns, strict=True):
                lang = lang.as_py()
                if lang not in held:
                    own = fixed.setdefault(lang, Numbers({})) if lookup else Numbers()
                    held[lang] = own, array("q")
                numbers, codes = held[lang]
                codes.extend(map(numbers.__getitem__, tokens(text.as_py())))
                codes.append(-1)
                if len(codes) >= _BLOCK:
                    yield flushed(lang)
        for lang in list(held):
            yield flushed(lang)

    return run


def _pairs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of neighbours without a gap, and each of them as one number."""
    at = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0))
    return at, codes[at].astype(np.int64) << _ID_BITS | codes[at + 1]


def pair_blocks(lookup) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks (block, codes) of numbers to blocks of the numbers of pairs: (block, codes)
    with a broadcast ``lookup``, else (block, codes, pairs), as for words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, codes in zip(*batch.columns, strict=True):
                codes = _codes(codes)
                at, pairs = _pairs(codes)
                out = np.full(max(len(codes) - 1, 0), -1, np.int64)
                columns = [pa.array([block.as_py()])]
                if lookup:
                    keys, numbers = lookup.value
                    found = np.searchsorted(keys, pairs)
                    found[found == len(keys)] = 0
                    out[at] = np.where(keys[found] == pairs, numbers[found], -1) if len(keys) else -1
                    if (out < 0).all():
                        continue
                    yield pa.RecordBatch.from_arrays([*columns, _binary(out)], names=["block", "codes"])
                    continue
                keys, out[at] = np.unique(pairs, return_inverse=True)
                columns += [_binary(out), pa.array([keys], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "codes", "pairs"])

    return run


def _renumbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, codes, found) to (block, codes): places become the numbers found for them."""
    for batch in batches:
        for block, codes, found in zip(*batch.columns, strict=True):
            codes = _codes(codes)
            numbers = np.full(codes.max(initial=-1) + 2, -1, np.int64)
            for pair in found.as_py() or ():
                numbers[pair["at"]] = pair["id"]
            # A gap is -1, the last place, which keeps its -1.
            columns = [pa.array([block.as_py()]), _binary(numbers[codes])]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "codes"])


def _by_join(local: DataFrame, asked: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    """Blocks of numbers, which each block asks for by ``asked`` (block, at and ``on``)."""
    found = asked.join(known.select("id", *on), on).groupBy("block")
    found = found.agg(F.collect_list(F.struct("at", "id")).alias("found"))
    rows = local.join(found, "block", "left").select("block", "codes", "found")
    return rows.mapInArrow(_renumbered, "block long, codes binary")


class Tiles:
    """Counts of pairs, some tiles by cell, the rest as sorted cells."""

    def __init__(self) -> None:
        self.dense: dict[int, np.ndarray] = {}
        self.sparse: list[tuple[np.ndarray, np.ndarray]] = []
        self.cells = 0

    def add(self, codes: np.ndarray) -> None:
        at, _ = _pairs(codes)
        x, y = codes[at].astype(np.int64), codes[at + 1].astype(np.int64)
        tile = x >> _SIDE_BITS << (_ID_BITS - _SIDE_BITS) | y >> _SIDE_BITS
        side = (1 << _SIDE_BITS) - 1
        cell = (x & side) << _SIDE_BITS | y & side
        # Only tiles of frequent numbers can be full, and those have small numbers.
        near = np.flatnonzero((x < 4 << _SIDE_BITS) & (y < 4 << _SIDE_BITS))
        names, sizes = np.unique(tile[near], return_counts=True)
        rest = np.ones(len(tile), bool)
        for name in names[sizes >= _DENSE].tolist():
            if name not in self.dense and len(self.dense) >= _HELD_TILES:
                continue
            own = tile == name
            counts = np.bincount(cell[own], minlength=_CELLS)
            self.dense[name] = self.dense[name] + counts if name in self.dense else counts
            rest &= ~own
        keys, counts = np.unique(tile[rest] << _CELL_BITS | cell[rest], return_counts=True)
        self.sparse.append((keys, counts))
        self.cells += len(keys)
        if self.cells > _HELD_CELLS:
            self.sparse = [summed(*map(np.concatenate, zip(*self.sparse, strict=True)))]
            self.cells = len(self.sparse[0][0])

    @property
    def full(self) -> bool:
        return self.cells > _HELD_CELLS // 2

    def flushed(self) -> Iterator[pa.RecordBatch]:
        for name, counts in self.dense.items():
            some = np.flatnonzero(counts)
            yield _tile_rows(np.int64(name) << _CELL_BITS | some, counts[some])
        if self.sparse:
            yield _tile_rows(*summed(*map(np.concatenate, zip(*self.sparse, strict=True))))
        self.dense, self.sparse, self.cells = {}, [], 0


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, with the sum of its counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    firsts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[firsts], np.add.reduceat(counts, firsts) if len(keys) else counts


def _tile_rows(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Rows (tile, n, cells, counts) for each tile of sorted keys, of a bounded size."""
    tiles = keys >> _CELL_BITS
    new = np.append(True, tiles[1:] != tiles[:-1])[: len(tiles)]
    new[::_ROW_CELLS] = True
    firsts = np.flatnonzero(new)
    edges = np.append(firsts, len(keys))

    def packed(values: np.ndarray) -> pa.Array:
        offsets = pa.py_buffer((edges * values.itemsize).astype(np.int64).tobytes())
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(firsts), [None, offsets, pa.py_buffer(values.tobytes())]
        ).cast(pa.binary())

    cells = packed((keys & (_CELLS - 1)).astype(np.int32))
    # As narrow as the counts of all rows.
    counts = counts.astype(np.min_scalar_type(int(counts.max(initial=0))))
    columns = [pa.array(tiles[firsts]), pa.array(np.diff(edges)), cells, packed(counts)]
    return pa.RecordBatch.from_arrays(columns, names=["tile", "n", "cells", "counts"])


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks (codes) to partial counts of tiles."""
    tiles, gap = Tiles(), np.array([-1], np.int32)
    held, size = [], 0
    for batch in batches:
        for codes in batch.column("codes"):
            held += [_codes(codes), gap]
            size += len(held[-2]) + 1
            if size >= _COUNTED:
                tiles.add(np.concatenate(held))
                held, size = [], 0
                if tiles.full:
                    yield from tiles.flushed()
    if held:
        tiles.add(np.concatenate(held))
    yield from tiles.flushed()


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    tiles, sizes = batch.column("tile").to_numpy(), batch.column("n").to_numpy()
    cells = np.frombuffer(b"".join(batch.column("cells").to_pylist()), np.int32)
    counts, found = np.empty(len(cells), np.int64), batch.column("counts")
    widths = pc.binary_length(found).to_numpy() // np.maximum(sizes, 1)
    for width in np.unique(widths):
        own = np.flatnonzero(widths == width)
        values = np.frombuffer(b"".join(found.take(pa.array(own)).to_pylist()), f"u{width}")
        counts[np.repeat(widths == width, sizes)] = values
    return np.repeat(tiles, sizes) << _CELL_BITS | cells, counts


def merged(emit: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums up partial counts that are sorted by tile. A tile of many cells is summed up by
    addressing them, so that what is held doesn't grow with the number of parts."""

    def added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        tile = int(keys[0]) >> _CELL_BITS if len(keys) else -1
        if len(keys) >= _DENSE and int(keys[-1]) >> _CELL_BITS == tile:
            cells = np.zeros(_CELLS, np.int64)
            np.add.at(cells, keys & (_CELLS - 1), counts)
            some = np.flatnonzero(cells)
            return np.int64(tile) << _CELL_BITS | some, cells[some]
        return summed(keys, counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            step = np.cumsum(batch.column("n").to_numpy()) // _STEP_CELLS
            edges = [0, *np.flatnonzero(np.diff(step)) + 1, len(batch)]
            for a, b in zip(edges, edges[1:], strict=False):
                keys, counts = _unpacked(batch.slice(a, b - a))
                keys, counts = added(np.append(held[0], keys), np.append(held[1], counts))
                last = np.searchsorted(keys, keys[-1] >> _CELL_BITS << _CELL_BITS) if len(keys) else 0
                held = keys[last:], counts[last:]
                if last:
                    yield emit(keys[:last], counts[:last])
        if len(held[0]):
            yield emit(*held)

    return run


def _frequent(at_least: int) -> Callable[[np.ndarray, np.ndarray], pa.RecordBatch]:
    def emit(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        some = counts >= at_least
        keys, side = keys[some], (1 << _SIDE_BITS) - 1
        tiles = keys >> _CELL_BITS
        across = _ID_BITS - _SIDE_BITS
        x = tiles >> across << _SIDE_BITS | keys >> _SIDE_BITS & side
        y = (tiles & ((1 << across) - 1)) << _SIDE_BITS | keys & side
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (x, y, counts[some])], names=["x", "y", "f"])

    return emit


def frequent_pairs(
    blocks: DataFrame, at_least: int, spill: Spill, merged_cells: int = _MERGED_CELLS
) -> DataFrame:
    """(x, y, f) of the neighbours in blocks that occur at least so often."""
    ddl = "tile long, n long, cells binary, counts binary"
    parts = spill.keep(blocks.mapInArrow(_tiled, ddl))
    # A tile that many tasks fill is summed up in parts, and these again, until one task
    # can take what is left.
    settled, left = [], None
    while True:
        sizes = parts.groupBy("tile").agg(F.sum("n").alias("size"))
        large = cut(sizes.filter(F.col("size") > merged_cells))
        size = large.agg(F.sum("size")).first()[0]
        if not size or left is not None and size >= left:
            break
        left = size
        own = F.pmod(F.xxhash64("cells", "counts"), F.ceil(F.col("size") / merged_cells))
        hot = parts.join(bounded(large), "tile").withColumn("part", own)
        hot = hot.repartition("tile", "part").sortWithinPartitions("tile", "part")
        hot = hot.select(parts.columns).mapInArrow(merged(_tile_rows), ddl)
        settled.append(parts.join(bounded(large.select("tile")), "tile", "left_anti").select(parts.columns))
        parts = spill.keep(hot)
    dealt = reduce(DataFrame.union, settled, parts).repartition("tile").sortWithinPartitions("tile")
    return dealt.mapInArrow(merged(_frequent(at_least)), "x long, y long, f long")


def _by_frequency(found: DataFrame, spill: Spill, *ties: str) -> DataFrame:
    """``found`` with id, from 0, by frequency."""
    ranked = numbered(found.withColumn("less", -F.col("f")), "less", *ties, name="id")
    ranked = spill.keep(ranked.drop("less"))
    top = ranked.agg(F.max("id")).first()[0] or 0
    if top >> _ID_BITS:
        raise ValueError(f"more than {1 << _ID_BITS} frequent phrases: raise at_least")
    return ranked


def phrases(
    docs: DataFrame,
    spill: Spill,
    at_least: int = AT_LEAST,
    longest: int = LONGEST,
    lookup_bytes: int = LOOKUP_BYTES,
    merged_cells: int = _MERGED_CELLS,
) -> tuple[DataFrame, list[DataFrame]]:
    """Words of each language (lang, n), and the phrases of one word, two words, ...: id,
    lang, words, f, ahead and behind, the frequencies of its first and last 1, 2, ... words,
    and, beyond one word, x and y, the phrases without the last and the first word."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    counted = texts.mapInArrow(_counted, "lang string, word string, f long")
    counted = counted.groupBy("lang", "word").agg(F.sum("f").alias("f"))
    counted = spill.keep(counted.filter((F.col("f") >= at_least) | F.col("word").isNull()))
    # Few rows of many partitions, brought together before they become files.
    totals = cut(counted.filter("word is null").select("lang", F.col("f").alias("n")).repartition("lang"))
    known = _by_frequency(counted.filter("word is not null"), spill, "lang", "word")
    if bytes_of(known) <= lookup_bytes:
        by_lang: dict[str, dict[bytes, int]] = {}
        for lang, word, number in known.select("lang", "word", "id").toLocalIterator():
            by_lang.setdefault(lang, {})[word.encode()] = number
        lookup = spark.sparkContext.broadcast(by_lang)
        blocks = texts.mapInArrow(word_blocks(lookup), "block long, codes binary")
    else:
        ddl = "block long, codes binary, lang string, words array<string>"
        local = spill.write(texts.mapInArrow(word_blocks(None), ddl), "words")
        asked = local.select("block", "lang", F.posexplode("words").alias("at", "word"))
        blocks = _by_join(local.select("block", "codes"), asked, known, ["lang", "word"])
    blocks, ranked = spill.keep(blocks), [known]
    none = F.array().cast("array<long>")
    levels = [
        known.select("id", "lang", F.array("word").alias("words"), "f", none.alias("ahead"), none.alias("behind"))
    ]
    for level in range(2, longest + 1):
        found = frequent_pairs(blocks, at_least, spill, merged_cells)
        known = _by_frequency(found, spill, "x", "y")
        ranked.append(known)
        spill.drop(blocks, *ranked)
        below = levels[-1]
        without_last = below.select(
            F.col("id").alias("x"), "lang", "words", F.concat("ahead", F.array("f")).alias("ahead")
        )
        without_first = below.select(
            F.col("id").alias("y"),
            F.slice("words", -1, 1).alias("last"),
            F.concat("behind", F.array("f")).alias("behind"),
        )
        joined = known.join(without_last, "x").join(without_first, "y").select(
            "id", "lang", F.concat("words", "last").alias("words"), "f", "ahead", "behind", "x", "y"
        )
        levels.append(cut(joined))
        if level == longest:
            break
        # A key of eight bytes and a number of four.
        if known.count() * 12 <= lookup_bytes:
            rows = known.select((F.shiftleft("x", _ID_BITS).bitwiseOR(F.col("y"))).alias("key"), "id").toArrow()
            keys, numbers = rows["key"].to_numpy(), rows["id"].to_numpy().astype(np.int32)
            order = np.argsort(keys)
            lookup = spark.sparkContext.broadcast((keys[order], numbers[order]))
            blocks = blocks.mapInArrow(pair_blocks(lookup), "block long, codes binary")
        else:
            ddl = "block long, codes binary, pairs array<long>"
            local = spill.write(blocks.mapInArrow(pair_blocks(None), ddl), f"pairs{level}")
            asked = local.select("block", F.posexplode("pairs").alias("at", "pair")).select(
                "block",
                "at",
                F.shiftright("pair", _ID_BITS).alias("x"),
                F.col("pair").bitwiseAND(F.lit((1 << _ID_BITS) - 1)).alias("y"),
            )
            blocks = _by_join(local.select("block", "codes"), asked, known, ["x", "y"])
        blocks = spill.keep(blocks)
    return totals, levels


def _lowest_cut(n: Column) -> Column:
    """Score, first words, and frequencies of both parts where the score is lowest."""
    wide = lambda c: c.cast("decimal(19,0)")
    above = wide(F.col("f") * 1000) * wide(n)

    def at(k: Column) -> Column:
        left, right = F.element_at("ahead", k), F.element_at("behind", F.size("ahead") - k + 1)
        score = F.call_function("div", above, wide(left) * wide(right))
        return F.struct(score.alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    return F.array_min(F.transform(F.sequence(F.lit(1), F.size("ahead")), at))


def collocations(
    docs: DataFrame,
    at_least: int = AT_LEAST,
    longest: int = LONGEST,
    inside: int = INSIDE,
    first: int = FIRST,
    lookup_bytes: int = LOOKUP_BYTES,
    merged_cells: int = _MERGED_CELLS,
) -> DataFrame:
    """The ``first`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A null language is ``und``, a null text is empty. Ties of the score go by a, then
    by the phrase's bytes. A language without candidates has no row, and so has a
    corpus without documents. Rows count as often as they are there. Other columns
    are not looked at. More than two to the power of 31 frequent phrases raise an error.
    """
    spark = docs.sparkSession
    with Spill(spark, "phrases") as spill, small_batches(spark):
        totals, levels = phrases(docs, spill, at_least, longest, lookup_bytes, merged_cells)
        candidates = []
        for level, above in zip(levels[1:], [*levels[2:], None], strict=True):
            level = level.drop("x", "y")
            if above is not None:
                # The most frequent phrase with one more word. Longer ones aren't more frequent.
                longer = above.select(F.col("x").alias("id"), "f").union(above.select("y", "f"))
                longer = longer.groupBy("id").agg(F.max("f").alias("longer"))
                level = level.join(longer, "id", "left").filter(
                    F.coalesce(F.col("longer") * 100 < F.col("f") * inside, F.lit(True))
                )
            candidates.append(level.select("lang", "words", "f", "ahead", "behind"))
        rows = reduce(DataFrame.union, candidates).join(bounded(totals), "lang")
        rows = rows.withColumn("lowest", _lowest_cut(F.col("n"))).select(
            "lang",
            F.array_join("words", " ").alias("phrase"),
            F.col("f").alias("a"),
            "lowest.l",
            "lowest.r",
            "n",
            "lowest.score",
        )
        # Parts of a language are cut to its first phrases before they meet.
        order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
        part = F.pmod(F.xxhash64("phrase"), F.lit(64))
        rows = rows.withColumn("part", part)
        for keys in (["lang", "part"], ["lang"]):
            place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
            rows = rows.withColumn("rank", place.cast("long")).filter(F.col("rank") <= first)
        return cut(rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
