import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from lagscope.llm import line_dedup, ngram_join
from lagscope.llm.base import WORD_RE, table
from lagscope.llm.components import Forest

from .cases import LONG, ODD, no_documents, odd_documents, rows_of, plain

SF = "/root/testdata/sf0.001"


def sets(text):
    words = WORD_RE.findall((text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def expected(rows):
    """(doc_id, class_id, class_size, links, linked_docs, group_id) by comparing all pairs."""
    texts = list(dict.fromkeys(t for _, t in rows))
    ids = [[i for i, t in rows if t == text] for text in texts]
    low = [min((i for i in own if i is not None), default=None) for own in ids]
    grams = [sets(t) for t in texts]
    forest, linked = Forest(len(texts)), [set() for _ in texts]
    for a in range(len(texts)):
        for b in range(a):
            both = len(grams[a] & grams[b])
            if both and both >= 0.8 * len(grams[a] | grams[b]):
                linked[a].add(b)
                linked[b].add(a)
                forest.join(a, b)
    out = []
    for a, own in enumerate(ids):
        group = [low[b] for b in range(len(texts)) if forest.root(b) == forest.root(a)]
        first = min((g for g in group if g is not None), default=None)
        docs = sum(len(ids[b]) for b in linked[a])
        out += [(i, low[a], len(own), len(linked[a]), docs, first) for i in own]
    return sorted(out, key=repr)


def mutated(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(999)}"
    return " ".join(words)


def some_documents():
    rng = random.Random(5)
    rows = [r[:2] for r in ODD]
    for group in range(12):
        words = [f"g{group}x{rng.randrange(400)}" for _ in range(rng.choice([6, 40, 120]))]
        rows += [(100 + group * 20 + k, mutated(rng, words, rng.choice([0, 0, 1, 2, 9]))) for k in range(8)]
    return rows


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_near_copies_like_all_pairs(spark):
    rows = some_documents()
    docs = odd_documents(spark, [(*r, None) for r in rows])
    got = found(ngram_join.near_copies(docs))
    assert got == expected(rows)
    # One of each group stays.
    kept = ngram_join.one_of_each_group(docs)
    assert kept.columns == docs.columns
    groups = {(r[0], r[5]) for r in got}
    texts = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(texts) == len(set(texts)) and {i for i, _ in texts} >= {g for _, g in groups if g is not None}
    named = [i for i, _ in texts if i is not None]
    assert sorted(named) == sorted({g for _, g in groups if g is not None})


def test_many_members_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BUCKET_BLOCK", 8)
    monkeypatch.setattr(ngram_join, "CLUSTER_BLOCK", 8)
    rng = random.Random(6)
    words = [f"x{i}" for i in range(60)]
    rows = [(i, mutated(rng, words, 1)) for i in range(60)]
    docs = odd_documents(spark, [(*r, None) for r in rows])
    assert found(ngram_join.near_copies(docs)) == expected(rows)


def test_whole_table(spark):
    docs = table(spark, SF, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(ngram_join.near_copies(docs)) == expected(rows)


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.9999), (0.5, 0.99), (0.9, 0.999)):
        bands, rows = ngram_join.choose_bands(threshold, recall)
        assert 1 - (1 - threshold**rows) ** bands >= recall and bands * rows <= 128


def test_bands_that_cannot_reach_the_recall_raise():
    with pytest.raises(ValueError, match="recall"):
        ngram_join.choose_bands(0.05, 0.9999)


def test_nothing(spark):
    assert ngram_join.near_copies(no_documents(spark)).count() == 0
    assert ngram_join.one_of_each_group(no_documents(spark)).count() == 0
    assert line_dedup.duplicate_lines(no_documents(spark)).count() == 0


# Lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(2000):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 12))) for _ in "ab")
        assert line_dedup.edit_distance(a, b) == distance(a, b)


def test_pairs_compared_many_at_a_time(monkeypatch):
    monkeypatch.setattr(line_dedup, "_SHORT_LINE", 600)
    rng = random.Random(3)
    pairs = [("", ""), ("a", ""), ("", "b"), ("a", "b")]
    for _ in range(1500):
        a = "".join(rng.choices("abcd\u4e2d ", k=rng.choice([1, 3, 10, 63, 64, 65, 128, 129, 200, 500, 700])))
        edited = rng.choice([0.05, 0.2, 0.3, 0.5])
        b = "".join(c if rng.random() > edited else rng.choice(["", "x", c + "y"]) for c in a)
        pairs.append((a, b if rng.random() < 0.8 else b[len(b) // 5 :] + b[: len(b) // 5]))
    want = [line_dedup.similar(a, b, 0.8) for a, b in pairs]
    assert 300 < sum(want) < 1300
    for lefts, rights in (zip(*pairs, strict=True), zip(*(p[::-1] for p in pairs), strict=True)):
        assert line_dedup.similar_pairs(lefts, rights, 0.8).tolist() == want


def test_lines_equal_but_for_some_words_need_no_distance(monkeypatch):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(3, 9)))
    pairs = []
    for size in (20, 60, 300, 3000):
        words = [word() for _ in range(size)]
        other = list(words)
        for at in rng.sample(range(size), size // 20):
            other[at : at + 1] = rng.choice([[word()], [], [word(), words[at]]])
        pairs.append((" ".join(words), " ".join(other)))
    for a, b in pairs:
        most = line_dedup.edit_distance(a, b)
        assert not line_dedup._laid(a, b, most - 1) and line_dedup._laid(a, b, 3 * most)
    # Any distance that is counted ends the test.
    monkeypatch.setattr(line_dedup, "edit_distance", None)
    monkeypatch.setattr(line_dedup, "_within", None)
    assert line_dedup.similar_pairs(*zip(*pairs, strict=True), 0.8).all()


def test_pairs_of_many_frames_are_compared_together(monkeypatch):
    import pandas as pd

    frames = [pd.DataFrame({"a": [i], "b": [i + 1], "left": ["abcdefghij"], "right": ["abcdefghi"[: i + 1]]}) for i in range(10)]
    calls, real = [], line_dedup.similar_pairs
    monkeypatch.setattr(line_dedup, "_STEP_PAIRS", 4)
    monkeypatch.setattr(line_dedup, "similar_pairs", lambda a, b, least: calls.append(len(a)) or real(a, b, least))
    found = pd.concat(line_dedup.comparing(0.8)(iter(frames)))
    assert found["a"].tolist() == [7, 8, 9] and calls == [4, 4, 2]


def test_word_hashes():
    lines = [b"a bc a", b"bc", ("é" * 300).encode() + b" cb a"]
    a, bc, again, other, long, cb, last = line_dedup.word_hashes(lines).tolist()
    assert a == again == last and bc == other and len({a, bc, long, cb}) == 4


def test_samples_of_all_kinds_are_moved_once():
    assert sum(line_dedup._MOVED, ()) == line_dedup._KINDS_OF_BLOCKS


def test_packed_blocks():
    # Rows of a key and an id took 16 bytes a block, before they were compressed.
    rng = random.Random(8)
    base = [mutated(rng, [f"w{rng.randrange(99)}" for _ in range(30)], 0).encode() for _ in range(400)]
    lines = base + [x + b" more" for x in base[:60]]
    plan, ids = line_dedup.block_plan(len(lines)), np.arange(len(lines), dtype=np.int64) * 3 + (5 << 33)
    ids[200:] += 1 << 34
    marks = {k: line_dedup._marks(k, lines) for k in line_dedup._SAMPLES}
    simhash = pa.array(np.arange(len(lines), dtype=np.int64) % 350)
    batch = pa.RecordBatch.from_arrays([pa.array(ids), simhash, *marks.values()], ["id", "simhash", *marks])
    parts = pa.Table.from_batches(list(line_dedup.in_blocks(4, plan)(iter([batch])))).to_pandas()
    n, size = parts["n"].sum(), parts["keys"].str.len().sum() + parts["ids"].str.len().sum()
    assert n > 25 * len(lines) and size <= 9 * n
    members = {}
    for kind in line_dedup._KINDS_OF_BLOCKS:
        column = batch.column(kind)
        own = ids[column.is_valid().to_numpy(zero_copy_only=False)]
        found = column.to_numpy().view(np.uint64) if kind == "simhash" else np.array(
            [list(x) for x in column.drop_null().to_pylist()], np.uint8
        )
        for i, keys in zip(own.tolist(), line_dedup.block_keys(kind, found, plan).tolist() if len(own) else (), strict=True):
            for key in keys:
                members.setdefault(key, []).append(i)
    want = sorted(sorted(x) for x in members.values() if len(x) > 1)
    frame = parts.sort_values("part", kind="stable").reset_index(drop=True)
    got = pd.concat(line_dedup.repeated(2048)(iter([frame])))
    assert sorted(sorted(g["id"].tolist()) for _, g in got.groupby("key")) == want
    # Lines of a large block meet in pairs of its parts.
    got = pd.concat(line_dedup.repeated(1)(iter([frame])))
    sizes = got.groupby("key").apply(lambda g: len(g) == g["id"].nunique() ** 2, include_groups=False)
    assert sizes.all() and (got["i"] <= got["j"]).all()


@pytest.mark.parametrize("lines", [1_000, 40_000, 410_000, 120_000_000])
def test_lines_meet_few_others_by_chance(lines):
    # In four sets of 16 bits each of 410,000 lines met 25 others and moved its sample.
    plan = line_dedup.block_plan(lines)
    assert len(plan) <= 20
    assert sum(lines / 2 ** sum(width for _, width in parts) for parts in plan) < 1


def test_block_plans_find_every_near_simhash():
    rng = random.Random(2)
    for lines in (10, 10**6, 10**9, 10**12):
        plan = line_dedup.block_plan(lines)
        for _ in range(200):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), line_dedup.BITS):
                b ^= 1 << bit
            same = [all((a ^ b) >> s & (1 << w) - 1 == 0 for s, w in parts) for parts in plan]
            assert any(same)


def removed_by_pairs(rows):
    """By comparing all pairs of lines by edit similarity alone."""
    first, places = {}, []
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for doc_id, text in order:
        for at, line in enumerate((text or "").split("\n")):
            words = line_dedup.normalised(line)
            if len(words) >= line_dedup.MIN_WORDS:
                key = " ".join(words)
                first.setdefault(key, (doc_id, at))
                places.append((doc_id, at, key))
    keys = list(first)
    forest = Forest(len(keys))
    for a in range(len(keys)):
        for b in range(a):
            if line_dedup.similar(keys[a], keys[b], line_dedup.SIMILARITY):
                forest.join(a, b)
    kept = {}
    for i, key in enumerate(keys):
        spot = first[key]
        root = forest.root(i)
        better = (spot[0] is None, spot[0] or 0, spot[1])
        if root not in kept or better < kept[root]:
            kept[root] = better
    gone = {}
    for doc_id, at, key in places:
        if kept[forest.root(keys.index(key))] != (doc_id is None, doc_id or 0, at):
            gone.setdefault(doc_id, set()).add(at)
    return gone


def test_lines_like_all_pairs(spark):
    rng = random.Random(4)
    base = [[f"l{k}w{rng.randrange(200)}" for _ in range(30)] for k in range(12)]
    rows = []
    for i in range(60):
        lines = [mutated(rng, rng.choice(base), rng.choice([0, 1, 1, 2])) for _ in range(3)]
        rows.append((i, "\n".join([*lines, "short one", lines[0].upper() if i % 9 == 0 else ""])))
    rows += [(200, None), (201, ""), (None, "\n".join([rows[0][1], "five words of its own"])), (202, LONG)]
    docs = odd_documents(spark, [(*r, None) for r in rows])
    duplicates = line_dedup.duplicate_lines(docs)
    got = {r.doc_id: set(r.removed) for r in duplicates.collect() if r.n_removed}
    assert got == removed_by_pairs(rows)
    whole = line_dedup.without(docs, duplicates)
    assert whole.columns == docs.columns
    texts = {r.doc_id: r.text for r in whole.collect()}
    for doc_id, text in rows:
        lines = None if text is None else [x for at, x in enumerate(text.split("\n")) if at not in got.get(doc_id, ())]
        assert texts[doc_id] == (None if lines is None else "\n".join(lines))


def test_large_clusters_are_compared_in_parts(spark, monkeypatch):
    # Parts of a few lines, so that lines of one group are found by all three comparisons.
    monkeypatch.setattr(line_dedup, "_BUCKET_BLOCK", 4)
    monkeypatch.setattr(line_dedup, "_CLUSTER_BLOCK", 3)
    rng = random.Random(5)
    base = [f"l0w{rng.randrange(200)}" for _ in range(40)]
    # The same words in another order have the same SimHash, but other characters.
    orders = [base, base[::-1], sorted(base), [*base[20:], *base[:20]]]
    rows = [(i, mutated(rng, rng.choice(orders), rng.choice([0, 1, 1]))) for i in range(60)]
    docs = odd_documents(spark, [(*r, None) for r in rows])
    got = {r.doc_id: set(r.removed) for r in line_dedup.duplicate_lines(docs).collect() if r.n_removed}
    assert got == removed_by_pairs(rows)
    assert 20 < len(got) < 60


def test_lines_of_dense_blocks(spark, monkeypatch):
    # Blocks whose lines agree with too many others are connected by clusters, not by all pairs.
    assert not [pairs for dense, pairs in dense_blocks() if dense]
    monkeypatch.setattr(line_dedup, "_SMALL", 2)
    monkeypatch.setattr(line_dedup, "_PAIRS_OF_LINE", 0)
    assert all(dense and len(pairs) == 19 for dense, pairs in dense_blocks())
    monkeypatch.setattr(line_dedup, "_CLUSTER_BLOCK", 3)
    rng = random.Random(6)
    base = [f"l0w{rng.randrange(200)}" for _ in range(40)]
    orders = [base, base[::-1], sorted(base)]
    rows = [(i, mutated(rng, rng.choice(orders), rng.choice([0, 1, 1]))) for i in range(40)]
    docs = odd_documents(spark, [(*r, None) for r in rows])
    got = {r.doc_id: set(r.removed) for r in line_dedup.duplicate_lines(docs).collect() if r.n_removed}
    assert got == removed_by_pairs(rows)


def dense_blocks():
    """(dense, pairs) of a block of twenty lines with the same SimHash."""
    frame = pd.DataFrame({"key": 0, "i": 0, "j": 0, "id": np.arange(20), "sample": [bytes(8)] * 20})
    found = pd.concat(line_dedup.agreeing(line_dedup.BITS)(iter([frame])))
    return [(dense, g) for dense, g in found.groupby("dense")]


def test_odd_lines(spark):
    rows = line_dedup.duplicate_lines(odd_documents(spark)).collect()
    assert len(rows) == len(ODD)
    assert rows_of(plain(line_dedup.duplicate_lines(odd_documents(spark).repartition(4))), ["doc_id", "n_removed"]) == sorted(
        ((r.doc_id, r.n_removed) for r in rows), key=repr
    )
