from collections import Counter

from lagscope.llm import mixing
from lagscope.llm.base import table
from lagscope.llm.oracle import MIXING

from .cases import documents_frame, in_duckdb, no_documents, odd_documents, plain, rows_of

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "size", "source_size", "target", "taken", "copies", "source"]


def filled(sizes: dict, weights=(5, 2, 1), share=1.5, most=2.0) -> dict:
    """Targets round by round: what is over the limits is divided again."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= most * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_targets_like_rounds(spark):
    sizes = {"a": 100, "b": 5000, "c": 70, "d": 1, "e": 0, "Ω": 900, None: 300}
    rows = [(s, n) for s, n in sizes.items()]
    sources = spark.createDataFrame(rows, "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(sources).collect()}
    expected = filled(sizes)
    assert found.keys() == expected.keys()
    assert all(abs(found[s] - expected[s]) < 1e-6 for s in found)


def test_takes_near_the_targets(spark):
    rows = mixing.mix_digest(table(spark, SF, "documents")).collect()
    taken, goal, largest = Counter(), {}, Counter()
    for r in rows:
        taken[r.source] += r.taken
        goal[r.source] = r.target
        largest[r.source] = max(largest[r.source], r["size"])
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 2
    assert all(abs(taken[s] - goal[s]) <= largest[s] / 2 + 1 for s in goal)


def test_odd_documents_like_sql(spark):
    docs = odd_documents(spark)
    expected = in_duckdb(MIXING, documents=documents_frame(docs))
    found = plain(mixing.mix_digest(docs))
    assert rows_of(found, COLUMNS) == rows_of(expected, COLUMNS)
    assert plain(mixing.mix_digest(docs.repartition(5))).pipe(rows_of, COLUMNS) == rows_of(found, COLUMNS)


def test_chances_are_unequal_and_kept(spark):
    """Over many sources, documents are taken as often as their words say."""
    rows = [(i, "w " * (10 if i % 2 else 30), f"s{i // 40}") for i in range(8000)]
    taken = Counter()
    mixed = mixing.mix(odd_documents(spark, rows), weights=(1,), share=0.5)
    for r in mixed.select("doc_id", "copies").collect():
        taken[r.doc_id % 2] += r.copies
    # 20 * (10 * k) * 10 + 20 * (30 * k) * 30 words are half of 800: chances 0.2 and 0.6.
    assert abs(taken[1] / 4000 - 0.2) < 0.03 and abs(taken[0] / 4000 - 0.6) < 0.03


def test_certain_documents(spark):
    rows = [(i, "w " * 10, "s") for i in range(20)] + [(99, "w " * 400, "s")]
    mixed = mixing.mix_digest(odd_documents(spark, rows)).collect()
    assert abs(sum(r.taken for r in mixed) - 900) <= 200
    half = mixing.mix(odd_documents(spark, rows), share=0.8).collect()
    assert {r.copies for r in half if r.doc_id == 99} == {1}
    assert abs(sum(r.taken for r in half) - 480) <= 5


def test_the_mixture_repeats_whole_rows(spark):
    docs = odd_documents(spark)
    copies = Counter()
    for r in mixing.mix_digest(docs).collect():
        copies[r.doc_id] += r.copies
    whole = mixing.mixture(docs)
    assert whole.columns == docs.columns
    assert Counter(r.doc_id for r in whole.collect()) == +copies


def test_no_documents(spark):
    assert mixing.mix_digest(no_documents(spark)).count() == 0
    assert mixing.mixture(no_documents(spark)).count() == 0
