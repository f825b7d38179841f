"""A player log derived from the order tables, for tests and the benchmark."""

from __future__ import annotations

import atexit
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagscope.sinks.shared import exists, remove, shared_root
from lagscope.sources.schema import PARTITION_COLUMN, PLAYLOG_SCHEMA

# Every column as an expression over lineitem, orders, customer and nation. The
# text is valid in Spark SQL and in other SQL engines alike.
SAMPLE_COLUMNS = {
    "tag": """CASE WHEN l_linenumber <= 4 THEN 'monitor' WHEN l_linenumber = 5 THEN 'first'
        WHEN l_linenumber = 6 THEN 'connect' ELSE 'other' END""",
    "room_id": "CASE WHEN l_partkey % 50 = 0 THEN CAST(-1 AS BIGINT) ELSE l_partkey % 200 END",
    "device": "o_custkey",
    "client_ip": """CASE WHEN o_custkey % 100 = 0 THEN '192.0.2.1'
        ELSE concat('198.51.100.', CAST(o_custkey % 250 AS STRING)) END""",
    "platform": """CASE o_custkey % 6 WHEN 0 THEN CAST(1 AS BIGINT) WHEN 1 THEN 2 WHEN 2 THEN 5
        WHEN 3 THEN 9 WHEN 4 THEN 14 ELSE 3 END""",
    "country": "CASE WHEN n_regionkey = 0 THEN '海外' ELSE '中国' END",
    "province": "CASE WHEN n_nationkey = 24 THEN '中国' ELSE n_name END",
    "isp": """CASE o_orderkey % 8 WHEN 0 THEN '电信' WHEN 1 THEN '移动' WHEN 2 THEN '联通'
        WHEN 3 THEN '教育网' WHEN 4 THEN '铁通' WHEN 5 THEN '鹏博士' WHEN 6 THEN '中国电信' END""",
    "v1": """CASE l_suppkey % 10 WHEN 0 THEN 'bd' WHEN 1 THEN 'baidu' WHEN 2 THEN 'qn'
        WHEN 3 THEN 'tx' WHEN 4 THEN 'al' WHEN 5 THEN 'ali' WHEN 6 THEN 'ws' WHEN 7 THEN 'yf'
        WHEN 8 THEN 'js' ELSE 'zz' END""",
    "v2": """CASE WHEN l_partkey % 40 = 1 THEN ''
        ELSE concat('203.0.113.', CAST(l_suppkey AS STRING)) END""",
    "v4": """CASE WHEN l_quantity = 1 THEN NULL WHEN l_quantity >= 45 THEN CAST(1 AS BIGINT)
        WHEN l_quantity = 44 THEN 2 ELSE 0 END""",
    "v5": """CASE WHEN l_partkey % 97 = 0 THEN CAST(0 AS BIGINT)
        ELSE CAST(floor(l_extendedprice * l_extendedprice / 300000) AS BIGINT) END""",
}

# Seconds after the first of the fourteen days.
SAMPLE_OFFSET = "(l_orderkey * 7919 + l_partkey * 104729 + l_linenumber * 1299709) % 1209600"

_TIME = f"TIMESTAMP_NTZ '2017-04-01 00:00:00' + INTERVAL '1' SECOND * ({SAMPLE_OFFSET})"

_TABLES = {
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE"
    ),
    "orders": "o_orderkey BIGINT, o_custkey BIGINT",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
}


def sample_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as a query over the tables in ``sf_dir``."""
    table = {
        name: spark.read.schema(ddl).parquet(f"{sf_dir}/{name}.parquet")
        for name, ddl in _TABLES.items()
    }
    # Merged at any size, so that what is shuffled grows as the tables do. Orders get their
    # customer first: narrow rows of lineitem are moved once, and no joined ones.
    buyers = table["orders"].join(
        table["customer"].hint("merge"), table["orders"]["o_custkey"] == table["customer"]["c_custkey"]
    )
    joined = (
        table["lineitem"]
        .join(buyers.hint("merge"), table["lineitem"]["l_orderkey"] == buyers["o_orderkey"])
        .join(table["nation"], buyers["c_nationkey"] == table["nation"]["n_nationkey"])
    )
    columns = {"tag": SAMPLE_COLUMNS["tag"], "time": _TIME, **SAMPLE_COLUMNS}
    return joined.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])


def write_sample_log(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Lays the log out as exports are: parquet, one folder per day.

    Each task has a file open for each of the days, fourteen at most: rows are neither
    gathered nor sorted by day, which would move or spill the whole log once more.
    """
    log = sample_log(spark, sf_dir).withColumn(PARTITION_COLUMN, F.to_date("time"))
    with _open_files(spark, 16):
        log.write.option("compression", "zstd").partitionBy(PARTITION_COLUMN).parquet(path)


@contextmanager
def _open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """Tasks that write folders by a column keep so many files open, before they sort rows."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Exports of this application, which it removes at its end.
_WRITTEN: set[str] = set()


def exported_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log read from its export, which is written once per application.

    The number of rows is recorded when the export is complete. It is compared each
    time; an export that lost or gained rows is written again. It is removed when the
    application ends.
    """
    name = f"playlog-{spark.sparkContext.applicationId}-{zlib.crc32(sf_dir.encode()):08x}"
    path = f"{shared_root(spark)}/{name}"
    if not _is_complete(spark, path):
        for part in ("rows", "log"):
            remove(spark, f"{path}/{part}")
        if path not in _WRITTEN:
            _WRITTEN.add(path)
            atexit.register(_forget, spark, path)
        write_sample_log(spark, sf_dir, f"{path}/log")
        _read_export(spark, path).selectExpr("count(*) AS n").write.json(f"{path}/rows")
    return _read_export(spark, path)


def _forget(spark: SparkSession, path: str) -> None:
    # A session that was stopped before can't remove anything.
    if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
        remove(spark, path)


def _is_complete(spark: SparkSession, path: str) -> bool:
    if not (exists(spark, f"{path}/rows/_SUCCESS") and exists(spark, f"{path}/log")):
        return False
    recorded = spark.read.schema("n BIGINT").json(f"{path}/rows").first()
    # Counted from the footers of the files.
    return recorded is not None and recorded["n"] == _read_export(spark, path).count()


def _read_export(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([*PLAYLOG_SCHEMA, T.StructField(PARTITION_COLUMN, T.DateType())])
    return spark.read.schema(schema).parquet(f"{path}/log")
