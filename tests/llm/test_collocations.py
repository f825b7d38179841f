"""Collocations against plain counts of all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lagscope.llm.collocations import Tiles, collocations, merged, tokens
from tests.llm.cases import no_documents, odd_documents

LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain(rows, at_least, first=2000, inside=100):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, 6):
                counts[lang].update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    found = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) >= 2 and a >= at_least}
        gone = set()
        for q, a in candidates.items():
            parts = {q[i : i + k] for k in range(2, len(q)) for i in range(len(q) - k + 1)}
            gone |= {p for p in parts if 100 * a >= inside * candidates[p]}
        scored = []
        for p, a in candidates.items():
            cuts = [(f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min((1000 * a * n[lang] // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
            if p not in gone:
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:first], 1):
            found.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(found)


def compared(docs, at_least, **options):
    got = sorted(map(tuple, collocations(docs, at_least, **options).collect()))
    limits = {k: v for k, v in options.items() if k in ("first", "inside")}
    assert got == plain(map(tuple, docs.select("lang", "text").collect()), at_least, **limits)
    return got


def random_documents(spark, seed):
    r = random.Random(seed)
    words = ["The", "of", "A", "é", "東", "\x00", "\x1f", "x\xa0y", "c"] + [f"w{i}" for i in range(30)]
    ends = [" "] * 8 + ["\t", ". ", "\n", "  "]
    rows = [
        (
            r.choice(["en", None, "und", ""]),
            "".join(r.choice(words[:6] if r.random() < 0.6 else words) + r.choice(ends) for _ in range(r.randint(0, 200))),
        )
        for _ in range(60)
    ]
    return spark.createDataFrame(rows, "lang string, text string").repartition(5)


def test_tokens():
    assert tokens("Ab\tC  d.É,\x00;e") == [b"ab", b"c", b"d", b"\xff", "É".encode(), b"\xff", b"\0", b"\xff", b"e"]
    assert tokens(None) == tokens(" \t") == []


def test_odd_documents(spark):
    compared(odd_documents(spark), 2)


def test_no_documents(spark):
    assert collocations(no_documents(spark)).collect() == []


@pytest.mark.parametrize("seed", range(2))
def test_random_documents(spark, seed):
    docs = random_documents(spark, seed)
    compared(docs, 5, first=50)


def test_blocks_and_tiles_are_not_files(spark, monkeypatch):
    """Each file that a task makes costs a process beside a local executor."""
    from lagscope.llm.base import Spill

    kept, real = [], Spill.keep
    monkeypatch.setattr(Spill, "write", None)
    monkeypatch.setattr(Spill, "keep", lambda self, df: kept.append(df) or real(self, df))
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    compared(random_documents(spark, 3), 5)
    # Counts and numbers of words; blocks, tiles and numbers of four levels; none is left.
    assert len(kept) == 2 + 4 * 3
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_packed_numbers():
    from lagscope.llm import collocations as module

    for numbers in (np.array([], np.int64), np.array([-1, 3, 2**31 - 1]), np.zeros(70_000, np.int64)):
        packed = module._binary(numbers)
        assert module._codes(packed[0]).tolist() == numbers.tolist()
    assert len(packed[0].as_py()) < 1000
    # Rows whose counts are of one, two and eight bytes, in one batch.
    import pyarrow as pa

    keys = np.array([3, 9, (1 << 20) + 1])
    batches = [module._tile_rows(keys, np.array([1, top, 2])) for top in (255, 256, 1 << 40)]
    assert [len(b.column("counts")[0].as_py()) for b in batches] == [2, 4, 16]
    together = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
    found_keys, counts = module._unpacked(together)
    assert found_keys.tolist() == keys.tolist() * 3
    assert counts.tolist() == [1, 255, 2, 1, 256, 2, 1, 1 << 40, 2]


def test_numbers_by_join_and_tiles_in_parts(spark):
    """As beyond the size of a broadcast, and with tiles that many tasks fill."""
    compared(random_documents(spark, 7), 3, lookup_bytes=0, merged_cells=50, inside=70)


def test_scores_beyond_64_bits(spark):
    docs = spark.createDataFrame([("en", "a b " * 30)], "lang string, text string")
    from lagscope.llm.collocations import _lowest_cut
    from pyspark.sql import functions as F

    big = 3_000_000_000_000_000
    row = docs.limit(1).select(
        F.lit(big).alias("f"), F.array(F.lit(big + 7)).alias("ahead"), F.array(F.lit(big * 2 + 1)).alias("behind")
    )
    score = row.select(_lowest_cut(F.lit(big * 9 + 5)).alias("c")).first()["c"]
    assert score["score"] == 1000 * big * (big * 9 + 5) // ((big + 7) * (big * 2 + 1))


@pytest.mark.parametrize("top", [40, 3000, 200_000])
def test_tiles_count_pairs(top, monkeypatch):
    from lagscope.llm import collocations as module

    monkeypatch.setattr(module, "_HELD_CELLS", 5000)
    monkeypatch.setattr(module, "_DENSE", 300)
    rng = np.random.default_rng(top)
    tiles, expected, parts = Tiles(), Counter(), []
    for _ in range(6):
        codes = np.minimum(rng.zipf(1.3, 4000), top).astype(np.int32) - 2
        expected.update((int(a), int(b)) for a, b in zip(codes, codes[1:], strict=False) if a >= 0 and b >= 0)
        tiles.add(codes)
        if tiles.full:
            parts += tiles.flushed()
    parts += tiles.flushed()
    rows = sorted((row for part in parts for row in part.to_pylist()), key=lambda r: r["tile"])
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pylist(rows[i : i + 70], parts[0].schema) for i in range(0, len(rows), 70)]
    found = Counter()
    for batch in merged(module._frequent(1))(iter(batches)):
        for row in batch.to_pylist():
            assert (row["x"], row["y"]) not in found
            found[row["x"], row["y"]] = row["f"]
    assert found == expected
