"""The manifest against a plain tree, with proofs folded by hand."""

import hashlib
import zlib
from collections import defaultdict

import pytest

from lagscope.llm.merkle import manifest
from tests.llm.cases import no_documents, odd_documents

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([digest(*last[i : i + 16]) for i in range(0, len(last), 16)])
    return levels


def sides(levels, at):
    found = []
    for level in levels[:-1]:
        run = at // 16 * 16
        found.append((level[run:at], level[at + 1 : run + 16]))
        at //= 16
    return found


def plain(rows):
    sources = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        leaf = lambda t: digest(*map(field, (doc_id, source, lang, n_chars, t)))  # noqa: E731, B023
        chosen = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        now = leaf(text.translate(UPPER) if chosen and text is not None else text)
        order = (doc_id is not None, doc_id or 0, leaf(text))
        sources[source].append((order, doc_id, leaf(text), now))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source, leaves in sources.items():
        leaves.sort(key=lambda x: x[0])
        trees[source] = levels_of([x[2] for x in leaves])
    top = levels_of([trees[s][-1][0] for s in order])
    found = []
    for place, source in enumerate(order):
        for at, (_, doc_id, leaf, node) in enumerate(sources[source]):
            path = sides(trees[source], at) + sides(top, place)
            for left, right in path:
                node = digest(*left, node, *right)
            proof = digest(*(x for left, right in path for x in left + right))
            root = top[-1][0]
            found.append((doc_id, leaf, trees[source][-1][0], root, proof, node, node == root))
    return sorted(found, key=repr)


def compared(docs):
    got = sorted(map(tuple, manifest(docs).collect()), key=repr)
    rows = docs.select("doc_id", "source", "lang", "n_chars", "text").collect()
    assert got == plain(map(tuple, rows))
    return got


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")


def test_odd_documents(spark):
    compared(odd_documents(spark))


def test_no_documents(spark):
    assert manifest(no_documents(spark)).collect() == []


def test_one_document(spark):
    (row,) = compared(documents(spark, [(1, "a", "en", 3, "Abc")]))
    assert row[1] == row[2] == row[3] and row[4] == digest()


@pytest.mark.parametrize("n", [16, 17, 257, 600])
def test_levels_of_runs(spark, n):
    rows = [(i * 7919, "s", "en", None, f"Text {i}") for i in range(n)]
    compared(documents(spark, rows).repartition(3))


def test_ids_of_any_size_and_rows_that_repeat(spark):
    ids = [-(1 << 63), -(1 << 40), -65, -64, -1, 0, 63, 64, 1 << 22, 1 << 38, 1 << 54, (1 << 63) - 1]
    rows = [(i, "s", None, 1, f"A{i}") for i in ids] + [(i, None, "de", 2, "B") for i in ids]
    rows += [(None, "s", None, None, t) for t in (None, "", "x", "x", "y")] * 5
    rows += [(5, "s", "en", 4, f"same id {i % 9}") for i in range(40)]
    found = compared(documents(spark, rows).repartition(4))
    assert len(found) == len(rows)


def test_many_sources(spark):
    rows = [(i, f"host{i % 290}é", "en", 1, "T") for i in range(700)] + [(1, "", "en", 1, "T"), (2, None, "en", 1, "T")]
    compared(documents(spark, rows))


def test_tampering_is_found_where_letters_change(spark):
    rows = [(i, "s", "en", 1, "upper CASE" if i % 2 else "lower case") for i in range(300)]
    for doc_id, *_, verified in compared(documents(spark, rows)):
        chosen = zlib.crc32(str(doc_id).encode()) % 5 == 0
        assert verified == (not chosen or doc_id % 2 == 0)
