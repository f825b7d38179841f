"""Rollups: the log read once, every report answered from small tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagscope.functions import dims
from lagscope.functions.labels import LATENCY_RANGES
from lagscope.functions.measures import any_nonzero, total
from lagscope.operators.grouping import grouped
from lagscope.operators.views import CONNECT, STALL
from lagscope.settings import Settings, dates_in
from lagscope.sinks.shared import exists, remove
from lagscope.sources.exports import within

DIM_KEYS = (
    "export_day",
    "event_date",
    "kind",
    "evening",
    "cdn",
    "platform",
    "country",
    "province",
    "isp",
)
NODE_KEYS = ("export_day", "event_date", "kind", "cdn", "v2")
ROLLUP_SCHEMA = """export_day DATE, event_date DATE, kind STRING, evening BOOLEAN, cdn STRING,
 platform BIGINT, country STRING, province STRING, isp STRING, v2 STRING, level STRING,
 value_sum BIGINT, value_n BIGINT, row_n BIGINT"""
RECORD_SCHEMA = """export_day DATE, blocked_ips STRING, first_max_ms INT, evening_hour INT,
 log_rows BIGINT, no_time_rows BIGINT, other_day_rows BIGINT"""
POINT_KEYS = ("cdn", "platform", "province", "isp", "cdn_ip")


def report_rollup(facts: DataFrame) -> DataFrame:
    """Daily sums by viewer dimensions and, apart from them, by node.

    Both key sets come from one pass. Nodes stay out of the first set: crossed
    with the other dimensions they would leave the map side little to combine.
    """
    keys = [*DIM_KEYS, "v2"]
    measures = [F.expr(total(m)).alias(m) for m in ("value_sum", "value_n", "row_n")]
    rolled = facts.groupingSets([list(DIM_KEYS), list(NODE_KEYS)], *keys).agg(
        F.expr("if(grouping(v2) = 1, 'dims', 'node')").alias("level"), *measures
    )
    return rolled.filter(f"level = 'dims' OR kind = '{STALL}'")


def level(rolled: DataFrame, name: str, kind: str) -> DataFrame:
    """Facts of one key set (``dims`` or ``node``) and kind."""
    return rolled.filter((F.col("level") == name) & (F.col("kind") == kind))


def _made_with(s: Settings) -> dict[str, str | int]:
    """What a rollup depends on besides the log."""
    return {
        "blocked_ips": " ".join(sorted(s.blocked_ips)),
        "first_max_ms": s.first_max_ms,
        "evening_hour": s.evening_hour,
    }


def write_days(
    rolled: DataFrame, counts: DataFrame, s: Settings, window: tuple[date, date], store: str
) -> None:
    """Writes the days of a window into a store. A day written again is replaced, also
    by no rows at all.

    Each day has a record of its row counts and of the settings. It is removed first
    and written last, so a day whose run broke off counts as missing. The rebalance
    gathers the rows of a day, so that a day is a few files.
    """
    spark, days = rolled.sparkSession, dates_in(window)
    for part in ("days", "rollup"):
        for day in days:
            remove(spark, f"{store}/{part}/export_day={day}")
    in_days = rolled.filter(within("export_day", window))
    (
        in_days.hint("rebalance", "export_day")
        .write.mode("append")
        .partitionBy("export_day")
        .parquet(f"{store}/rollup")
    )
    records = spark.createDataFrame([(d,) for d in days], "export_day DATE").join(
        counts, "export_day", "left"
    )
    made = {k: F.lit(v) for k, v in _made_with(s).items()}
    (
        records.na.fill(0)
        .withColumns(made)
        .coalesce(1)
        .write.mode("append")
        .partitionBy("export_day")
        .parquet(f"{store}/days")
    )


def read_records(spark: SparkSession, store: str, window: tuple[date, date]) -> DataFrame:
    """The records of the days of a window, as far as they were written."""
    path = f"{store}/days"
    if not exists(spark, path):
        return spark.createDataFrame([], RECORD_SCHEMA)
    return spark.read.schema(RECORD_SCHEMA).parquet(path).filter(within("export_day", window))


def read_store(
    spark: SparkSession, store: str, window: tuple[date, date], s: Settings
) -> DataFrame:
    """The days of a window from a store; a day may have no rows.

    A day that was never written raises, and so does one that was written with
    another blocklist, latency bound or evening hour.
    """
    # One record per day of the window comes to the driver.
    found = {r["export_day"]: r for r in read_records(spark, store, window).collect()}
    missing = [f"{d}" for d in dates_in(window) if d not in found]
    if missing:
        raise ValueError(f"rollup store {store} lacks {', '.join(missing)}")
    made = _made_with(s)
    other = [f"{d}" for d, r in sorted(found.items()) if any(r[k] != v for k, v in made.items())]
    if other:
        raise ValueError(f"rollup store {store} was written with other settings: {', '.join(other)}")
    path = f"{store}/rollup"
    if not exists(spark, path):
        return spark.createDataFrame([], ROLLUP_SCHEMA)
    return spark.read.schema(ROLLUP_SCHEMA).parquet(path).filter(within("export_day", window))


def viewer_counts(facts: DataFrame) -> DataFrame:
    """Viewers and affected viewers by vendor and platform, all day and evening.

    A viewer is affected when any of the viewer's rows stalled. The first
    aggregate spreads by viewer, so no vendor or platform gathers in one task.
    """
    viewers = grouped(
        facts,
        {"cdn": "cdn", "platform1": dims.fold_platform("platform"), "device": "device"},
        {
            "hit": any_nonzero("value_sum"),
            "evening_hit": "max(CASE WHEN evening THEN if(value_sum != 0, 1, 0) END)",
        },
    )
    return grouped(
        viewers,
        ["cdn", "platform1"],
        {
            "lag_person": "sum(hit)",
            "total_person": "count(hit)",
            "evening_lag_person": "sum(evening_hit)",
            "evening_total_person": "count(evening_hit)",
        },
    )


def point_groups(facts: DataFrame) -> DataFrame:
    """One row per group of the points, with the sums of every kind side by side.

    Rows of no kind are counted in a row of their node alone. All point reports
    and the valid nodes follow from these rows, those by node without a shuffle.
    """
    sums = {"row_n": total("row_n")}
    for name, kind in (("connect", CONNECT), ("lag", STALL)):
        sums[f"{name}_sum"] = total("value_sum", f"kind = '{kind}'")
        sums[f"{name}_point"] = total("row_n", f"kind = '{kind}'")
    for bucket in LATENCY_RANGES:
        sums[f"first{bucket}_sum"] = total("value_sum", f"first_range = {bucket}")
        sums[f"first{bucket}_point"] = total("row_n", f"first_range = {bucket}")
    return grouped(facts, POINT_KEYS, sums)
