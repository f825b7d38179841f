"""A mix of sources by weight, drawn by Pareto order sampling.

Every source gets a target in words. Whole copies of all its documents come
first; the rest of the target is drawn without replacement, a document's chance
being in proportion to its words. A document whose chance would exceed one is
taken for certain. The others are ranked by ``odds(u) / odds(chance)``, with u
from a keyed hash of the document, and are taken in that order until their words
reach the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import NOT_SPACE, bounded, cut, null_safe_join, packed

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = "mix-1"
#: Cells of the ranking, per source: words are summed by cell, and only the cell
#: in which the target is reached is sorted.
CELLS = 1 << 16


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with size, the number of words between white space; null has 0.
    A column of that name is replaced."""
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(NOT_SPACE))
    return docs.withColumn("size", size.cast("long"))


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) that depends on the id and the seed alone."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    head = F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("long")
    return (head.cast("double") + 0.5) / F.lit(float(1 << 48))


def targets(
    sources: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """``sources`` (source, source_size) with target.

    Sources in code point order, null last, take the weights in turn. They divide
    ``share`` times all words by weight; a target stops at ``most`` times its
    source, and what is left over is divided again among the rest. Sources reach
    their limit in the order of limit over weight, which settles all rounds at
    once: a source stops if its share of what those before it leave is too much.
    The table has a row for each source, so one task handles it.
    """
    named = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.pmod(F.row_number().over(named) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int") + 1)
    limits = (
        sources.withColumn("_w", weight)
        .withColumn("_cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("_all", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share)))
    )
    order = Window.orderBy(
        F.col("_cap") / F.col("_w"), F.col("source").isNull(), F.col("source")
    ).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(
        F.col("_cap") / F.col("_w"), F.col("source").isNull(), F.col("source")
    ).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("_all") - F.coalesce(F.sum("_cap").over(order), F.lit(0.0))
    level = left / F.sum("_w").over(after)
    leveled = limits.withColumn("_level", level)
    # The first source that doesn't reach its limit sets the level of all later ones.
    free = F.first(
        F.when(F.col("_level") * F.col("_w") < F.col("_cap"), F.col("_level")), ignorenulls=True
    ).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("_cap"), F.coalesce(free * F.col("_w"), F.col("_cap")))
    return leveled.withColumn("target", target).select("source", "source_size", "target")


def _chances(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """``goals`` with copies (whole ones of every document), rest (words still to
    draw), top (larger documents are certain) and k, the chance per word of the
    others.

    Works on counts by source and size: at most sqrt(2 * words) different sizes
    fit into a source.
    """
    cells = rows.filter("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    wanted = goals.withColumn(
        "copies", F.floor(F.try_divide(F.col("target"), F.col("source_size"))).cast("long")
    ).withColumn(
        "rest", F.greatest(F.lit(0.0), F.col("target") - F.col("copies") * F.col("source_size"))
    )
    big_first = Window.partitionBy("source").orderBy(F.col("size").desc())
    above = big_first.rowsBetween(Window.unboundedPreceding, -1)
    from_here = big_first.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    squares = (F.col("n") * F.col("size")).cast("decimal(38,0)") * F.col("size")
    ks = (
        null_safe_join(cells, wanted, ["source"], "inner")
        .withColumn("_above", F.coalesce(F.sum(F.col("n") * F.col("size")).over(above), F.lit(0)))
        .withColumn("_squares", F.sum(squares).over(from_here).cast("double"))
        .withColumn("_k", (F.col("rest") - F.col("_above")) / F.col("_squares"))
        # The certain sizes end where a chance falls below one.
        .filter(F.col("_k") * F.col("size") < 1)
        .groupBy("source")
        .agg(F.max("size").alias("top"), F.max_by("_k", "size").alias("k"))
    )
    return null_safe_join(wanted, ks, ["source"], "left")


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken (words).

    Documents without words are never taken; a null source is a source of its own
    and comes last. Equal ids draw the same number; ties go by id and size. An
    empty table gives an empty result. Columns of the new names are replaced. The
    frame is read several times and must give the same rows each time.
    """
    return mix_sized(sized(docs), weights, share, most, seed)


def mix_sized(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = SEED,
) -> DataFrame:
    """``mix`` of documents whose size is known; no text is needed."""
    rows = docs.drop("source_size", "target", "copies", "taken")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = cut(_chances(rows, targets(sources, weights, share, most)))
    chance = F.col("k") * F.col("size")
    u = uniform(F.col("doc_id"), seed)
    q = F.try_divide((u / (1 - u)) * (1 - chance), chance)
    drawn = (
        null_safe_join(rows, bounded(goals), ["source"], "left")
        .withColumn(
            "_certain", (F.col("rest") > 0) & F.coalesce(F.col("size") > F.col("top"), F.lit(False))
        )
        .withColumn("_q", F.when((chance > 0) & ~F.col("_certain"), q))
        .withColumn("_cell", F.floor(F.col("_q") / (1 + F.col("_q")) * CELLS).cast("int"))
    )
    # Words by cell, and before each cell: the cell that reaches the target is found
    # on sums, and only its documents are ranked one by one.
    cells = drawn.groupBy("source", "rest", "_cell").agg(
        F.sum(F.when(F.col("_certain") | F.col("_cell").isNotNull(), F.col("size"))).alias("_words"),
        F.sum(F.when(F.col("_certain"), F.col("size")).otherwise(0)).alias("_sure"),
    )
    sure = F.sum("_sure").over(Window.partitionBy("source"))
    upto = F.sum(F.when(F.col("_cell").isNotNull(), F.col("_words")).otherwise(0)).over(
        Window.partitionBy("source").orderBy(F.col("_cell").asc_nulls_first())
    )
    reached = (
        cells.withColumn("_upto", upto + sure)
        .filter(F.col("_cell").isNotNull())
        .withColumn("_before", F.col("_upto") - F.col("_words"))
        .filter((F.col("_before") < F.col("rest")) & (F.col("_upto") >= F.col("rest")))
        .groupBy("source")
        .agg(F.min("_cell").alias("_last"), F.min_by("_before", "_cell").alias("_before"))
    )
    reached = bounded(cut(reached))
    ranked = Window.partitionBy("source", "_cell", "_edge").orderBy("_q", "doc_id", "size")
    edge = F.col("_cell") == F.col("_last")
    with_edge = null_safe_join(drawn, reached, ["source"], "left").withColumn(
        "_edge", F.coalesce(edge, F.lit(False))
    )
    # Rows beside the edge are told apart by their cell alone.
    sides = with_edge.filter(~F.col("_edge")).withColumn(
        "_in",
        F.col("_certain")
        | (F.col("_cell").isNotNull() & (F.col("_last").isNull() | (F.col("_cell") < F.col("_last")))),
    )
    cum = F.sum("size").over(ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # The last document is taken if that brings the sum nearer to the target.
    half = F.col("_before") + cum - F.col("size") / 2
    edges = with_edge.filter(F.col("_edge")).withColumn("_in", half <= F.col("rest"))
    taken = F.col("copies") + F.coalesce(F.col("_in"), F.lit(False)).cast("long")
    return (
        sides.unionByName(edges)
        .withColumn("copies", F.when(F.col("size") > 0, F.coalesce(taken, F.lit(0))).otherwise(0))
        .withColumn("copies", F.col("copies").cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .withColumn("target", F.coalesce(F.col("target"), F.lit(0.0)))
        .drop("rest", "k", "top", "_certain", "_q", "_cell", "_last", "_before", "_edge", "_in")
    )


def mix_digest(docs: DataFrame) -> DataFrame:
    """Words taken of each document, without its text."""
    rows = cut(sized(docs.select("doc_id", "source", "text")).drop("text"))
    return mix_sized(rows).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def mixture(docs: DataFrame) -> DataFrame:
    """The mix itself: ``docs`` with each document as often as it is taken."""
    mixed = mix(packed(docs, "doc_id", "source", "text"))
    copies = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return (
        mixed.filter("copies > 0").withColumn("_copy", F.explode(copies)).select("_row.*")
    )
