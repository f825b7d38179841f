"""Benchmark passages in training documents, by a positional inverted index.

1. Documents are read into words once. The postings of all words that benchmark items
   hold (document, term, position) are stored in the shared folder.
2. The index counts its terms, and each passage orders its terms from the rarest on.
3. The postings of the rarest term, moved by its offset, are the starts where a passage
   may be. They are intersected with the moved postings of the second rarest term,
   and what is left with those of all others: what remains are exact phrases.
4. Passages are near a place where their rarest words stand close together in any
   order: the postings of the rarest one, intersected with those of the others within
   a reach, by stretches of as many positions.

Only postings near those of a rarest term are looked at again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import Spill, bounded, cut, null_safe_join, packed, text_hash, words

WIDTH = 10
#: Rare words of a passage that must stand near each other.
NEAR_TERMS = 3
_DOC = ["doc_id", "_text"]
#: Number of the posting that each document has.
_HEADER = -1


def windows(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item_id, terms, wid): ``width`` consecutive words of an item. A shorter item
    that has words is one window; null and wordless items have none. Ids are
    strings, a null id is "null"; rows with the same id are one item."""
    split = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"),
        words(F.col("text")).alias("_words"),
    ).filter(F.size("_words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("_words") - width, F.lit(0)))
    return (
        split.withColumn("_start", F.explode(starts))
        .select("item_id", F.slice("_words", F.col("_start") + 1, width).alias("terms"))
        .withColumn("wid", F.md5(F.array_join("terms", " ").cast("binary")))
        .distinct()
    )


def _numbered(passages: DataFrame) -> DataFrame:
    """(term, t): the words of passages with numbers."""
    terms = passages.select(F.explode("terms").alias("term")).distinct()
    return cut(terms.withColumn("t", F.monotonically_increasing_id()))


def build_index(docs: DataFrame, terms: DataFrame, spill: Spill) -> DataFrame:
    """Postings of ``terms`` (term, t) in all documents, stored: doc_id, _text (hash of the
    text), n_words, t, pos. Each document also has a posting of its own, so that
    documents without any are known."""
    header = terms.sparkSession.range(1).select(F.lit("").alias("term"), F.lit(_HEADER).cast("long").alias("t"))
    tokens = docs.select("doc_id", text_hash().alias("_text"), words(F.col("text")).alias("_words"))
    tokens = tokens.select(
        *_DOC,
        F.size("_words").alias("n_words"),
        F.posexplode(F.concat(F.array(F.lit("")), F.col("_words"))).alias("pos", "term"),
    ).withColumn("pos", F.col("pos") - 1)
    known = bounded(cut(terms.select("term", "t").union(header)))
    # A word that is no term of an item is dropped where it is read, while they are few.
    return spill.write(tokens.join(known, "term").select(*_DOC, "n_words", "t", "pos"), "index")


def by_rarity(passages: DataFrame, terms: DataFrame, index: DataFrame) -> DataFrame:
    """Distinct ``passages`` (wid, terms) as (wid, length, others): their terms (count,
    offset, t) from the rarest on. A passage with a term that no document has is left out."""
    counts = index.filter(f"t <> {_HEADER}").groupBy("t").count().join(terms, "t")
    split = passages.select(
        "wid", F.size("terms").alias("length"), F.posexplode("terms").alias("offset", "term")
    )
    ordered = F.array_sort(F.collect_list(F.struct("count", "offset", "t")))
    return (
        split.join(counts, "term")
        .groupBy("wid", "length")
        .agg(ordered.alias("others"))
        .filter(F.size("others") == F.col("length"))
    )


def _stretch(reach: int, d: Column | int = 0) -> Column:
    """A hash of a stretch of ``reach`` + 1 positions of a document, or of the d-th one after it."""
    return F.xxhash64(*_DOC, F.expr(f"pos div {reach + 1}") + d)


class Search:
    """Passages (by_rarity) in an index, and the postings about ``reach`` positions or
    less away from the rarest term of any."""

    def __init__(self, index: DataFrame, passages: DataFrame, spill: Spill, reach: int = WIDTH - 1):
        first = passages.select("wid", "length", F.col("others")[0].alias("_rarest"))
        first = first.select("wid", "length", F.col("_rarest.t").alias("t"), F.col("_rarest.offset").alias("offset"))
        self.passages, self.reach = passages, reach
        self.starts = cut(
            index.join(bounded(first), "t").select(
                *_DOC, "wid", "pos", (F.col("pos") - F.col("offset")).alias("start"), "length", "n_words"
            )
        )
        # Most postings are far from any place to look at. Hashes of stretches tell them:
        # what they let pass by a clash does no harm.
        around = F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda d: _stretch(reach, d))
        about = cut(self.starts.select(F.explode(around).alias("_about")).distinct())
        own = index.filter(f"t <> {_HEADER}").withColumn("_about", _stretch(reach))
        own = own.join(about, "_about", "left_semi")
        self.own = spill.write(own.select(*_DOC, "t", "pos"), "own")

    def _kept(self, found: DataFrame, start: int, n: int) -> DataFrame:
        """Those of ``found`` (wid, start) that the moved postings of some of the
        passage's terms hold as well."""
        terms = self.passages.select("wid", F.slice("others", start + 1, n).alias("_terms"))
        asked = found.join(bounded(terms), "wid").withColumn("_n", F.size("_terms"))
        alone = asked.filter("_n = 0").select(*_DOC, "wid", "start", "length")
        asked = asked.withColumn("_term", F.explode("_terms")).select(
            *_DOC, "wid", "start", "length", "_n", F.col("_term.t").alias("t"),
            (F.col("start") + F.col("_term.offset")).alias("pos"),
        )
        met = null_safe_join(asked, self.own, [*_DOC, "t", "pos"], "left_semi")
        met = met.groupBy(*_DOC, "wid", "start", "length", "_n").count().filter("count = _n")
        return met.select(*_DOC, "wid", "start", "length").union(alone)

    def phrases(self) -> DataFrame:
        """Where each passage occurs: doc_id, _text, wid, start, length."""
        fits = (F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words"))
        found = self.starts.filter(fits).select(*_DOC, "wid", "start", "length").distinct()
        # The second rarest term leaves few; the others are intersected at once.
        return cut(self._kept(cut(self._kept(found, 1, 1)), 2, 1 << 20))

    def near(self, terms: int = NEAR_TERMS, reach: int | None = None) -> DataFrame:
        """Where the ``terms`` rarest words of a passage stand, in any order, each at most
        ``reach`` words (that of the search at most) from the rarest one: doc_id, _text,
        wid, pos (of the rarest)."""
        reach = self.reach if reach is None else min(reach, self.reach)
        # Neighbouring passages have the same rare words, which are looked for once.
        rare = self.passages.select("wid", F.transform(F.slice("others", 1, terms), lambda o: o["t"]).alias("_rare"))
        rare = cut(rare.withColumn("_set", F.md5(F.array_join("_rare", ",").cast("binary"))))
        sets = rare.select("_set", "_rare").distinct()
        places = self.starts.join(bounded(rare.select("wid", "_set")), "wid").select(*_DOC, "_set", "pos").distinct()
        asked = (
            places.join(bounded(cut(sets)), "_set")
            .withColumn("_t", F.array_distinct(F.slice("_rare", 2, terms)))
            .withColumn("_n", F.size("_t"))
        )
        stretch = F.expr(f"pos div {reach + 1}")
        around = F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda d: stretch + d)
        others = asked.withColumn("t", F.explode("_t")).withColumn("_stretch", F.explode(around))
        held = self.own.select(*_DOC, "t", stretch.alias("_stretch"), F.col("pos").alias("_at"))
        met = null_safe_join(others, held, [*_DOC, "t", "_stretch"], "inner")
        met = met.filter(F.abs(F.col("_at") - F.col("pos")) <= reach)
        met = met.groupBy(*_DOC, "_set", "pos", "_n").agg(F.count_distinct("t").alias("_met"))
        found = met.filter("_met = _n").select(*_DOC, "_set", "pos")
        found = found.union(asked.filter("_n = 0").select(*_DOC, "_set", "pos"))
        return found.join(bounded(rare.select("wid", "_set")), "_set").select(*_DOC, "wid", "pos")


def _searched(docs: DataFrame, found: DataFrame, spill: Spill, width: int = WIDTH) -> tuple[DataFrame, Search]:
    """The index of documents for windows ``found``, and the search for them."""
    passages = found.select("wid", "terms").distinct()
    terms = _numbered(passages)
    index = build_index(docs, terms, spill)
    return index, Search(index, cut(by_rarity(passages, terms, index)), spill, width - 1)


def _items(places: DataFrame, found: DataFrame) -> DataFrame:
    """The sorted ids of the items of each document's windows: doc_id, _text, _items."""
    named = places.select(*_DOC, "wid").distinct().join(bounded(found.select("wid", "item_id")), "wid")
    return named.groupBy(*_DOC).agg(F.array_sort(F.collect_set("item_id")).alias("_items"))


def decontaminate(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated,
    n_near (items with a window whose three rarest words stand near each other).

    A word is hit if it lies in an occurrence of a window of an item. Null and
    empty texts have no words. Rows with equal id and text get equal results, one
    each; a null id is an id. Without documents the result is empty, without items
    nothing is hit. Other columns of the inputs are not looked at.
    """
    with Spill(docs.sparkSession, "decontam") as spill:
        return cut(_decontaminate(docs, items, width, spill))


def _decontaminate(docs: DataFrame, items: DataFrame, width: int, spill: Spill) -> DataFrame:
    found = cut(windows(items, width))
    index, search = _searched(docs, found, spill, width)
    matches = search.phrases()
    span = F.struct("start", "length")
    none = F.lit(None).cast("int")
    rows = (
        index.filter(f"t = {_HEADER}")
        .select(*_DOC, "n_words", none.alias("start"), none.alias("length"))
        .unionByName(matches.drop("wid").withColumn("n_words", none))
    )
    # Spans in order: what reaches beyond those before it is new.
    hit = F.aggregate(
        F.array_sort("_spans"),
        F.struct(F.lit(0).alias("upto"), F.lit(0).alias("hit")),
        lambda a, s: F.struct(
            F.greatest(a["upto"], s["start"] + s["length"]).alias("upto"),
            (
                a["hit"]
                + F.greatest(
                    F.lit(0), s["start"] + s["length"] - F.greatest(a["upto"], s["start"])
                )
            ).alias("hit"),
        ),
        lambda a: a["hit"],
    )
    per_doc = rows.groupBy(*_DOC).agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.count("n_words").cast("int").alias("_copies"),
        F.collect_set(F.when(F.col("start").isNotNull(), span)).alias("_spans"),
    )
    near = _items(search.near(), found).select(*_DOC, F.size("_items").alias("_near"))
    listed = F.coalesce(F.col("_items"), F.array().cast("array<string>"))
    judged = null_safe_join(per_doc, _items(matches, found), _DOC, "left")
    return (
        null_safe_join(judged, near, _DOC, "left")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select(
            "doc_id",
            "n_words",
            hit.cast("long").alias("n_hit"),
            F.size(listed).cast("long").alias("n_items"),
            F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"),
            (F.size("_spans") > 0).alias("contaminated"),
            F.coalesce("_near", F.lit(0)).cast("long").alias("n_near"),
        )
    )


def clean(docs: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` without the documents that hold a window of an item. Same defined
    cases as ``decontaminate``; all columns are kept."""
    with Spill(docs.sparkSession, "decontam") as spill:
        _, search = _searched(docs, cut(windows(items, width)), spill, width)
        bad = cut(search.phrases().select(*_DOC).distinct())
    rows = packed(docs, "doc_id", text_hash().alias("_text"))
    return null_safe_join(rows, bounded(bad), _DOC, "left_anti").select("_row.*")
