"""Report tables as CSV files that spreadsheets open."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lagscope.functions import dims

BOM = "\ufeff"


def fixed_point(value: str) -> str:
    """Six decimals as text; NULL stays NULL."""
    return f"if({value} IS NULL, NULL, format_string('%f', {value}))"


def report_text(report: DataFrame, headings: Mapping[str, str], full: bool = False) -> DataFrame:
    """The printed form: headings as names, fixed decimals or all digits, client names.

    A heading whose key is not a column makes an empty column.
    """
    types = dict(report.dtypes)
    columns = []
    for name, heading in headings.items():
        column = f"`{name}`"
        if name not in types:
            column = "CAST(NULL AS STRING)"
        elif types[name] == "double":
            column = f"CAST({column} AS STRING)" if full else fixed_point(column)
        elif name == "platform1":
            column = dims.device_name(column)
        columns.append(f"{column} AS `{heading}`")
    return report.selectExpr(*columns)


def write_report(
    report: DataFrame,
    path: str,
    headings: Mapping[str, str],
    mode: str = "errorifexists",
    full: bool = False,
) -> None:
    """One file with a byte order mark and a header line.

    Meant for finished reports, which hold a few rows in one partition.
    """
    text = report_text(report, headings, full)
    first = text.columns[0]
    (
        text.withColumnRenamed(first, BOM + first)
        .coalesce(1)
        .write.mode(mode)
        .option("header", True)
        .option("encoding", "UTF-8")
        .csv(path)
    )


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Reads a written report with the names and types of ``schema``."""
    return spark.read.schema(schema).option("header", True).option("encoding", "UTF-8").csv(path)
