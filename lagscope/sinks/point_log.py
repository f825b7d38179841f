"""Metric points as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_points(points: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One record per row; a field that is NULL is left out."""
    points.write.mode(mode).option("ignoreNullFields", True).json(path)


def all_points(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two kinds of points for one destination, written as one output."""
    return first.unionByName(second, allowMissingColumns=True)


def read_points(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
