"""Repeated passages against a count of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lagscope.llm.suffix_dedup import passage_digest, repeats, segments_of, suffix_order
from tests.llm.cases import LONG, no_documents, odd_documents


def spans_of(texts, window):
    starts = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    found = []
    for t in texts:
        spans = []
        for i in range(len(t) - window + 1):
            if starts[t[i : i + window]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + window
                else:
                    spans.append([i, i + window])
        found.append([tuple(s) for s in spans])
    return found


def plain(rows, window):
    texts = [(text or "").encode() for _, text in rows]
    found = []
    for (doc_id, _), text, spans in zip(rows, texts, spans_of(texts, window), strict=True):
        edges = [0, *(x for s in spans for x in s), len(text)]
        kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
        sha = hashlib.sha256(kept).hexdigest()
        found.append((doc_id, len(text), len(text) - len(kept), len(spans), sha))
    return sorted(found, key=repr)


def compared(docs, window, **options):
    got = sorted(map(tuple, passage_digest(docs, window, **options).collect()), key=repr)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got == plain(rows, window)
    return got


def random_texts(r, letters):
    base = [bytes(r.choice(letters) for _ in range(r.randint(1, 60))) for _ in range(6)]
    return [
        b"".join(r.choice(base)[r.randint(0, 5) :] for _ in range(r.randint(0, 6)))
        for _ in range(r.randint(1, 12))
    ]


@pytest.mark.parametrize("seed", range(60))
def test_index_marks_what_counting_marks(seed):
    r = random.Random(seed)
    texts, window = random_texts(r, b"ab\0\xff"), r.choice([1, 3, 8, 15])
    got = [[] for _ in texts]
    for home, a, b in zip(*repeats(texts, window), strict=True):
        got[home].append((int(a), int(b)))
    assert got == spans_of(texts, window)


@pytest.mark.parametrize("seed", range(20))
def test_suffixes_are_in_order(seed):
    r = random.Random(seed)
    texts = random_texts(r, b"ab")
    symbols = np.array([x for t in texts for x in (*(c + 1 for c in t), 0)])
    ends = np.flatnonzero(symbols == 0)
    left = ends[np.searchsorted(ends, np.arange(len(symbols)))] - np.arange(len(symbols))
    # Ends are smaller than any letter, and among them the place decides.
    keys = [
        [(s, 0) if s else (0, i + k) for k, s in enumerate(symbols[i : i + left[i] + 1].tolist())]
        for i in range(len(symbols))
    ]
    assert suffix_order(symbols, left).tolist() == sorted(range(len(keys)), key=keys.__getitem__)


def test_segments_hold_each_window_once_and_equal_windows_share_an_anchor():
    r = random.Random(1)
    passage = bytes(r.choice(b"abc") for _ in range(300))
    texts = [bytes(r.choice(b"abc") for _ in range(r.randint(20, 200))) + passage for _ in range(5)] + [b"a" * 90]
    window, seen, anchors = 20, Counter(), {}
    for home, start, n, h, _ in zip(*segments_of(texts, window, 6), strict=True):
        for i in range(start, start + n):
            seen[int(home), int(i)] += 1
            assert anchors.setdefault(texts[home][i : i + window], h) == h
    assert set(seen.values()) == {1}
    assert len(seen) == sum(len(t) - window + 1 for t in texts)


def test_anchors_don_t_depend_on_what_is_hashed_together():
    text = bytes(random.Random(2).choice(b"abcdef") for _ in range(400))
    alone = segments_of([text], 50, 9)
    beside = segments_of([b"x" * 77, text, b"y" * 60], 50, 9)
    mine = beside[0] == 1
    assert all((a == b[mine]).all() for a, b in zip(alone[1:], beside[1:], strict=True))


@pytest.mark.parametrize("anchors", [(5, 12, 20), (20,)])
def test_odd_documents(spark, anchors):
    compared(odd_documents(spark), 20, anchors=anchors, index_bytes=500)


def test_no_documents(spark):
    assert passage_digest(no_documents(spark)).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_random_documents(spark, seed):
    r = random.Random(seed)
    words = ["alpha", "bé", "c", "delta", "東京", "eps ", "\n"]
    base = ["".join(r.choice(words) for _ in range(r.randint(1, 60))) for _ in range(30)]
    rows = [
        (r.choice([None, *range(60)]), "".join(r.choice(base) for _ in range(r.randint(0, 6)))) for _ in range(80)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    compared(docs, 24, anchors=(6, 12, 24), index_bytes=r.choice([300, 10000]))


def test_an_anchor_of_many_contents_is_dealt_anew(spark):
    line = "a line that stands in every document of this table"
    rows = [(i, f"{i} {i * i} {line} {i * 7} {i % 3}") for i in range(400)]
    found = compared(spark.createDataFrame(rows, "doc_id long, text string"), 40, anchors=(16, 40), index_bytes=2000)
    assert all(row[2] >= len(line) for row in found)


def test_texts_longer_than_a_chunk(spark, monkeypatch):
    from lagscope.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "_CHUNK", 5000)
    rows = [(1, LONG), (2, "x" + LONG[500:60_000]), (3, "z" * 3000)]
    compared(spark.createDataFrame(rows, "doc_id long, text string"), 200)
