import subprocess

from pyspark.sql import functions as F

from lagscope.llm import base
from lagscope.llm.components import Forest, components


def test_words(spark):
    texts = ["Äpfel, A-Z 09_x", "", None, "É\x7fé`b{c", "  a  "]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = [r[0] for r in df.select(base.words(F.col("text"))).collect()]
    assert found == [["Äpfel", "a", "z", "09", "x"], [], [], ["É", "é", "b", "c"], ["a"]]


def test_bounded_broadcasts_by_bytes(spark):
    plan = lambda df: df._jdf.queryExecution().logical().toString()
    row = 16 + 8
    assert "broadcast" in plan(base.bounded(spark.range(10), 10 * row))
    assert "broadcast" not in plan(base.bounded(spark.range(10), 10 * row - 1))
    rows = [("ab", [1, 2, 3], [("é", None)], None)]
    df = spark.createDataFrame(rows, "s string, a array<long>, b array<struct<x:string,y:long>>, `n.n` string")
    sizes = (2 + 8) + (3 * 8 + 8) + (2 + 8 + 8 + 8 + 8) + 8
    assert base.bytes_of(df) == 16 + sizes
    assert base.bytes_of(df.limit(0)) == 0


def test_numbered(spark):
    rows = [(i * 37 % 101, "x" * (i % 3)) for i in range(101)] + [(None, "y"), (5, "z"), (5, "z")]
    df = spark.createDataFrame(rows, "a long, b string").repartition(5)
    found = sorted((r["no"], r["a"], r["b"]) for r in base.numbered(df, "a", "b").collect())
    assert [r[0] for r in found] == list(range(len(rows)))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [r[1:] for r in found] == order
    assert base.numbered(df.limit(0), "a").count() == 0


def test_null_safe_join(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k long, v string")
    right = spark.createDataFrame([(None, "x"), (2, "y")], "k long, w string")
    rows = base.null_safe_join(left, right, ["k"], "left").collect()
    assert sorted(map(tuple, rows), key=str) == [(1, "a", None), (None, "b", "x")]


def test_spill_is_removed_also_after_a_failure(spark):
    try:
        with base.Spill(spark, "spill") as spill:
            assert spill.write(spark.range(3), "x").count() == 3
            path = spill.path
            raise KeyError
    except KeyError:
        pass
    local = path.removeprefix("file:")
    assert subprocess.run(["ls", local], capture_output=True, check=False).returncode != 0


def test_components(spark):
    links = [(5, 3), (3, 9), (20, 10), (9, 1), (7, 7), (None, 4)]
    links += [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    forest = Forest(300)
    for a, b in links:
        if a is not None and a != b:
            forest.join(a, b)
    expected = {x: forest.root(x) for a, b in links if a is not None and a != b for x in (a, b)}
    assert found == expected


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
