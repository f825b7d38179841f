"""Merkle manifest of a corpus, its leaves placed by the ranks of bitmaps.

1. The ids of a source form a bitmap, kept as its words of 64 bits that are not
   empty. Each task combines the words it meets; words of all tasks are then merged.
2. A directory gives the number of leaves before each word. It is built like a
   trie: words are summed up by the next 16 bits of their number, and so on, so that
   prefix sums run over at most 65,536 entries of one node. The rank of an id is
   the directory's count and the population count of the lower bits of its word:
   the place of a leaf, without sorting the leaves.
3. Leaves with the same place divided by 16 form an array of slots, by the
   remainder; its hash is a node of the next level, and so on to the root.
4. From the root down each node gets its path: what stands left and right of it on
   every level. The proof of a leaf and its folding are expressions over its path.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import cut, lowered, numbered

#: Children of a node.
FAN = 16
#: Columns of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Number of the word of rows without an id: before that of any id.
_NO_WORD = -(1 << 57) - 1
_PATH = "array<struct<l:string,r:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _field(value: Column) -> Column:
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.when(text.isNull(), F.lit("-")).otherwise(sized)


def leaf_hash(text: Column | None = None) -> Column:
    """Of a document's fields, with ``text`` in place of its own text if given."""
    fields = {c: F.col(c) for c in FIELDS} | ({} if text is None else {"text": text})
    return digest(*(_field(fields[c]) for c in FIELDS))


def tampered_leaf() -> Column:
    """The leaf after A-Z of the text became a-z, for every fifth id by its hash; else null."""
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return F.when(chosen, leaf_hash(lowered(F.col("text"))))


def directory(words: DataFrame) -> DataFrame:
    """(src, word, start, total) for ``words`` (src, word, n): the leaves before the word
    and those of the source."""
    levels = [words.select("src", F.col("word").alias("k"), "n")]
    for _ in range(3):
        upper = levels[-1].groupBy("src", F.shiftright("k", 16).alias("k"))
        levels.append(upper.agg(F.sum("n").alias("n")))
    # The last 10 of 58 bits make the top.
    whole = Window.partitionBy("src")
    found = None
    for level in reversed(levels):
        top = found is None
        within = whole if top else Window.partitionBy("src", F.shiftright("k", 16))
        so_far = within.orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
        level = level.withColumn("start", F.coalesce(F.sum("n").over(so_far), F.lit(0)))
        if top:
            found = level.withColumn("total", F.sum("n").over(whole)).drop("n")
            continue
        above = found.select("src", F.col("k").alias("up"), F.col("start").alias("base"), "total")
        found = (
            level.withColumn("up", F.shiftright("k", 16))
            .join(above, ["src", "up"])
            .select("src", "k", (F.col("start") + F.col("base")).alias("start"), "total")
        )
    return found.withColumnRenamed("k", "word")


def placed(leaves: DataFrame) -> DataFrame:
    """``leaves`` (src, doc_id, leaf, ...) with at, the rank within the source, and n, the
    source's leaves. Rows without an id come first; rows of one id go by their hash."""
    bit = F.expr("shiftleft(1L, cast(doc_id & 63 as int))")
    lower = F.expr("~shiftleft(-1L, cast(doc_id & 63 as int))")
    rows = leaves.withColumn("word", F.coalesce(F.shiftright("doc_id", 6), F.lit(_NO_WORD)))
    words = cut(rows.groupBy("src", "word").agg(F.bit_or(bit).alias("bits"), F.count("*").alias("n")))
    # A bitmap can't tell rows of the same id, or rows without one, from each other.
    several = F.col("n") > F.coalesce(F.bit_count("bits"), F.lit(0))
    known = words.join(directory(words), ["src", "word"])
    known = cut(known.select("src", "word", "bits", several.alias("several"), "start", "total"))
    rows = rows.join(known, ["src", "word"])
    below = F.col("bits").bitwiseAND(lower)
    plain = rows.filter("not several").withColumn("at", F.col("start") + F.bit_count(below))
    kept = [*leaves.columns, "at", F.col("total").alias("n")]
    if known.filter("several").isEmpty():
        return plain.select(*kept)
    tied = numbered(
        rows.filter("several").withColumn("_row", F.monotonically_increasing_id()),
        "src", "doc_id", "leaf", "_row",
    )
    firsts = tied.groupBy("src", "word").agg(F.min("no").alias("first"))
    tied = tied.join(firsts, ["src", "word"]).withColumn("at", F.col("start") + F.col("no") - F.col("first"))
    return plain.select(*kept).unionByName(tied.select(*kept))


def _slots(nodes: DataFrame, *payload: str) -> DataFrame:
    """Runs (src, at, n, slots) of nodes (src, at, n, digest): n counts the nodes of the
    level, slots is ordered by place."""
    slot = F.struct(F.pmod("at", F.lit(FAN)).alias("slot"), "digest", *payload)
    return nodes.groupBy("src", F.expr(f"at div {FAN}").alias("at")).agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list(slot)).alias("slots")
    )


def _parents(runs: DataFrame) -> DataFrame:
    """The next level. The only node of its level stays as it is."""
    joined = F.array_join(F.transform("slots", lambda s: s["digest"]), "")
    return runs.select(
        "src",
        "at",
        F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"),
        F.when(F.col("n") > 1, F.sha2(joined, 256)).otherwise(F.col("slots")[0]["digest"]).alias("digest"),
    )


def _built(nodes: DataFrame, largest: int, *payload: str) -> tuple[list[DataFrame], DataFrame]:
    """The runs of each level, from the lowest, and (src, digest) of the last nodes."""
    levels, ends = [], []
    while True:
        runs = cut(_slots(nodes, *payload))
        levels.append(runs)
        above, payload = _parents(runs), ()
        ends.append(above.filter("n = 1").select("src", "digest"))
        if largest <= FAN:
            return levels, reduce(DataFrame.union, ends)
        nodes, largest = above.filter("n > 1"), -(-largest // FAN)


def _children(runs: DataFrame) -> DataFrame:
    """A row for each slot of runs with a path: its place in order and its own path."""
    own = F.transform("slots", lambda s: s["digest"])
    rows = runs.select("src", "at", "n", "path", "slots", F.posexplode("slots").alias("pos", "slot"))
    sides = F.struct(
        F.array_join(F.slice(own, 1, F.col("pos")), "").alias("l"),
        F.array_join(F.slice(own, F.col("pos") + 2, F.lit(FAN)), "").alias("r"),
    )
    path = F.when(F.col("n") > 1, F.concat(F.array(sides), "path")).otherwise(F.col("path"))
    return rows.withColumn("path", path)


def _paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The runs of the lowest level with the path of each run's node; ``tops`` has
    that (src, path) of each last node."""
    above = None
    for runs in reversed(levels):
        last = runs.filter(f"n <= {FAN}").join(tops, "src")
        if above is None:
            found = last
        else:
            below = runs.filter(f"n > {FAN}").join(above, ["src", "at"])
            found = last.select(below.columns).union(below)
        if runs is levels[0]:
            return found
        place = F.col("at") * FAN + F.col("pos")
        above = cut(_children(found).select("src", place.alias("at"), "path"))


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256 (hash of the siblings
    of the path, from the leaf up), folded_root (from the leaf, tampered where the id's
    hash says so, and the siblings), verified.

    Leaves ascend by id within a source. Rows without an id come first; rows of one
    id go by their leaf hash, and equal rows are leaves of their own, whose proofs differ
    by place. A null source comes before all others; fields that are null count as
    ``-``. Without documents the result is empty. Other columns are not looked at.
    """
    # An order of sources without null: the empty string stands for it.
    src = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("+"), F.col("source")))
    leaves = docs.select(
        src.alias("src"),
        F.col("doc_id").cast("long"),
        leaf_hash().alias("leaf"),
        tampered_leaf().alias("tampered"),
    )
    leaves = cut(placed(cut(leaves)).withColumn("digest", F.col("leaf")))
    largest = leaves.agg(F.max("n")).first()[0] or 0
    levels, subroots = _built(leaves, largest, "doc_id", "tampered")
    sources = cut(numbered(subroots, "src"))
    n = sources.count()
    nodes = sources.select(F.lit("").alias("src"), F.col("no").alias("at"), F.lit(n).alias("n"), "digest")
    upper, roots = _built(nodes, n)
    root = roots.first()
    tops = _paths(upper, roots.select("src", F.array().cast(_PATH).alias("path")))
    tops = _children(tops).select((F.col("at") * FAN + F.col("pos")).alias("no"), "path")
    tops = cut(sources.join(tops, "no").select("src", F.col("digest").alias("subroot"), "path"))
    runs = _paths(levels, tops.select("src", "path"))
    rows = _children(runs).join(tops.select("src", "subroot"), "src")
    fold = F.aggregate(
        "path",
        F.coalesce("slot.tampered", "slot.digest"),
        lambda node, side: digest(side["l"], node, side["r"]),
    )
    siblings = F.transform("path", lambda side: F.concat(side["l"], side["r"]))
    root_hash = F.lit(root["digest"] if root else None).cast("string")
    return cut(
        rows.select(
            "slot.doc_id",
            F.col("slot.digest").alias("leaf"),
            "subroot",
            root_hash.alias("root"),
            F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
            fold.alias("folded_root"),
        ).withColumn("verified", F.col("folded_root") == F.col("root"))
    )
