"""Scans of the player log: one day, several days, time windows."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagscope.sources.schema import PARTITION_COLUMN, conform


def export_path(root: str, day: date) -> str:
    """Pattern of the parquet parts exported for one day."""
    return f"{root.rstrip('/')}/export_{day:%Y-%m-%d}-*"


def read_log(spark: SparkSession, *paths: str) -> DataFrame:
    """A player log from any parquet paths, checked against its schema."""
    return conform(spark.read.parquet(*paths))


def read_days(spark: SparkSession, root: str, days: Iterable[date]) -> DataFrame:
    """The exports of several days in one scan; only their folders are listed.

    Each row carries the day of its export, whatever its own time is.
    """
    parts = spark.read.parquet(*[export_path(root, d) for d in days])
    name = F.regexp_extract("_metadata.file_path", r".*export_(\d{4}-\d{2}-\d{2})-", 1)
    columns = [c for c in parts.columns if c != PARTITION_COLUMN]
    return conform(parts.select(*columns, F.to_date(name).alias(PARTITION_COLUMN)))


def read_day(spark: SparkSession, root: str, day: date) -> DataFrame:
    return read_days(spark, root, [day])


def in_window(log: DataFrame, window: tuple[date, date]) -> DataFrame:
    """Rows of a half-open window of days.

    A log that is cut by day keeps all rows of the days of the window, also those
    stamped outside their day or not at all; folders of other days are not read. Any
    other log is cut by time, with literal bounds that reach the scan.
    """
    if PARTITION_COLUMN in log.columns:
        return log.filter(within(PARTITION_COLUMN, window))
    start, end = window
    return log.filter(
        f"time >= TIMESTAMP_NTZ '{start} 00:00:00' AND time < TIMESTAMP_NTZ '{end} 00:00:00'"
    )


def export_day(log: DataFrame) -> str:
    """The day a row was exported with, or else that of its time."""
    return PARTITION_COLUMN if PARTITION_COLUMN in log.columns else "CAST(time AS DATE)"


def row_counts(log: DataFrame) -> DataFrame:
    """Rows of each export day, those without a time, and those of another day."""
    day = export_day(log)
    return log.groupBy(F.expr(day).alias("export_day")).agg(
        F.expr("count(*)").alias("log_rows"),
        F.expr("count_if(time IS NULL)").alias("no_time_rows"),
        F.expr(f"count_if(CAST(time AS DATE) != {day})").alias("other_day_rows"),
    )


def within(day: str, window: tuple[date, date]) -> str:
    """Condition that a date falls in a half-open window."""
    start, end = window
    return f"({day} >= DATE '{start}' AND {day} < DATE '{end}')"
