"""Block and allow rules for urls, by a range join over sorted keys.

A rule's canonical key is its host with the labels reversed, followed by its path:
``net.example/en/``. What the rule covers is the interval of keys that begin with
it. A url has a key for its host and for each parent domain. Rules and url keys
are range-partitioned and sorted together; a sweep passes them in order. Intervals
nest or are apart, so a stack of open rules suffices: where a rule opens it is the
top, where it closes its enclosing rule is the top again. Each event carries the
top that holds after it, and a url key takes the last one before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import bounded, cut, lowered

#: (host, path, verdict)
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: For urls that no rule fits.
DEFAULT = "allow"


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#``; empty without one."""
    return lowered(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)://[^/?#]*([^?#]*)", 1)


def _key(labels: Column, path: Column) -> Column:
    # A host has no "#", so that no host's key begins with that of a shorter label.
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit("#"), path)


def _events(rules: DataFrame) -> tuple[DataFrame, int]:
    """(key, kind, top) where a rule opens and where it closes, and the most labels
    of a rule's host. Rules without a host or with a null path fit nothing; an empty path
    fits all paths. Of rules for the
    same host and path a blocking one holds."""
    keyed = (
        rules.withColumn("host", lowered(F.col("host")))
        .filter("host <> '' and path is not null")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("_labels", F.split("host", r"\."))
        .withColumn("_key", _key(F.col("_labels"), F.col("path")))
        .withColumn("_size", F.char_length("host") + F.char_length("path"))
    )
    keyed = cut(keyed)
    labels = keyed.agg(F.max(F.size("_labels"))).first()[0] or 0
    rule = F.struct(
        F.col("_size").alias("size"),
        F.concat("host", "path").alias("rule"),
        F.col("verdict").alias("verdict"),
    )
    opens = keyed.select("_key", rule.alias("top"))
    # The enclosing rule: the longest rule among the proper prefixes of the key.
    prefixes = keyed.select(
        F.col("_key").alias("_own"),
        F.explode(F.sequence(F.lit(0), F.char_length("_key") - 1)).alias("_n"),
    ).withColumn("_key", F.expr("substring(_own, 1, _n)"))
    parents = (
        prefixes.join(opens, "_key")
        .groupBy("_own")
        .agg(F.max_by("top", "_n").alias("top"))
        .withColumnRenamed("_own", "_key")
    )
    none = F.struct(
        F.lit(0).alias("size"),
        F.lit(None).cast("string").alias("rule"),
        F.lit(None).cast("string").alias("verdict"),
    )
    closes = (
        keyed.select("_key")
        .join(parents, "_key", "left")
        .select(
            # 0xFF is no byte of UTF-8: this comes after every key with the prefix.
            F.concat(F.col("_key").cast("binary"), F.unhex(F.lit("FF"))).alias("key"),
            F.coalesce("top", none).alias("top"),
        )
    )
    starts = opens.select(F.col("_key").cast("binary").alias("key"), "top")
    return cut(starts.unionByName(closes).withColumn("kind", F.lit(0))), labels


def judge(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    The longest rule that fits holds; ``default`` where none does, as for null urls
    and such without ``://``. Rows with equal id and url get equal results, one
    each. Without pages the result is empty. Other columns are not looked at.
    """
    events, labels = _events(rules)
    parsed = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    split = F.split("host", r"\.")
    # A parent domain with more labels than any rule's host fits no rule.
    most = F.when(F.col("host") == "", 0).otherwise(F.least(F.size(split), F.lit(labels)))
    levels = F.sequence(F.least(most, F.lit(1)), most)
    suffix = F.slice(split, F.size(split) - F.col("_level") + 1, F.col("_level"))
    key = F.when(F.col("_level") == 0, F.lit("")).otherwise(_key(suffix, F.col("path")))
    points = parsed.withColumn("_level", F.explode(levels)).withColumns(
        {"key": key.cast("binary"), "kind": F.lit(1)}
    )
    # Equal keys, such as a url that a third of all pages have, are told apart by a
    # hash of the page, so that ranges can divide them.
    swept = cut(
        points.unionByName(events, allowMissingColumns=True)
        .withColumn("_tie", F.xxhash64("page_id", "host", "path"))
        .repartitionByRange("key", "kind", "_tie")
        .withColumn("_part", F.spark_partition_id())
    )
    # What is open where a range begins: the last event before it.
    event_key = F.when(F.col("kind") == 0, F.col("key"))
    last = swept.groupBy("_part").agg(F.max_by("top", event_key).alias("_last"))
    carried = last.select(
        "_part",
        F.last("_last", ignorenulls=True)
        .over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
        .alias("_open"),
    )
    sweep = (
        Window.partitionBy("_part")
        .orderBy("key", "kind", "_tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    judged = (
        swept.join(bounded(cut(carried)), "_part")
        .withColumn("_top", F.last("top", ignorenulls=True).over(sweep))
        .filter("kind = 1")
        .withColumn("_top", F.coalesce("_top", "_open"))
        .groupBy("page_id", "host", "path")
        .agg(
            F.max(F.when(F.col("_level") > 0, F.col("_top"))).alias("_best"),
            F.sum((F.col("_level") <= 1).cast("int")).cast("int").alias("_copies"),
        )
    )
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("_best.rule").alias("rule"),
        F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy"),
    ).drop("_copy")
