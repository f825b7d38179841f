"""A log of any size with a third of its rows on one vendor, node, province and viewer.

``python -m tests.skewed_log ROWS FOLDER`` writes one and times the reports on it.
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SECONDS = 14 * 24 * 3600


def _one_of(name: str, *values: str) -> str:
    """One of SQL literals by a hash of the row."""
    return f"element_at(array({', '.join(values)}), cast(pmod(xxhash64(id, '{name}'), {len(values)}) + 1 AS INT))"


def _numbered(name: str, n: int) -> str:
    return f"pmod(xxhash64(id, '{name}'), {n})"


COLUMNS = {
    "tag": _one_of("tag", *["'monitor'"] * 7, "'first'", "'first'", "'connect'", "'other'"),
    "time": f"timestampadd(SECOND, cast({_numbered('time', _SECONDS)} AS INT), timestamp_ntz '2017-04-01 00:00:00')",
    "room_id": f"if({_numbered('room', 50)} = 0, -1L, {_numbered('room', 50)})",
    "device": f"if(hot, 7L, {_numbered('device', 20_000)})",
    "client_ip": f"if({_numbered('ip', 100)} = 0, '192.0.2.1', '198.51.100.1')",
    "platform": _one_of("platform", "1L", "2L", "3L", "5L", "9L", "14L"),
    "country": f"if({_numbered('country', 20)} = 0, '海外', '中国')",
    "province": f"if(hot, 'P0', concat('P', {_numbered('province', 30)}))",
    "isp": _one_of("isp", "'电信'", "'移动'", "'联通'", "'教育网'", "'铁通'", "'鹏博士'", "'中国电信'", "NULL"),
    "v1": "if(hot, 'ws', " + _one_of("v1", "'bd'", "'qn'", "'tx'", "'ali'", "'ws'", "'yf'", "'js'", "'zz'") + ")",
    "v2": f"if(hot, 'n0', if({_numbered('node', 40)} = 0, '', concat('n', {_numbered('node', 500)})))",
    "v4": _one_of("v4", *["0L"] * 16, "1L", "1L", "2L", "NULL"),
    "v5": f"if({_numbered('v5', 97)} = 0, 0L, {_numbered('v5', 197)} * {_numbered('v5', 197)})",
}


def skewed_log(spark: SparkSession, rows: int) -> DataFrame:
    log = spark.range(rows).withColumn("hot", F.expr("pmod(xxhash64(id), 3) = 0"))
    return log.selectExpr(*[f"{text} AS {name}" for name, text in COLUMNS.items()])


def minima(rows: int) -> dict[str, int]:
    """Thresholds that some groups of such a log reach and others don't."""
    return {"province": rows // 40_000, "node": rows // 30_000, "weekly_province": rows // 90, "point_node": rows // 1_200}


def main(rows: int, folder: str) -> None:
    from lagscope.operators import rollup, views
    from lagscope.plans import daily, points, weekly
    from lagscope.session import build_session
    from lagscope.sources.exports import in_window
    from tests.micro import SETTINGS as s

    spark = build_session("skewed log", "local[8]", spark__ui__enabled="false", spark__driver__memory="8g")
    skewed_log(spark, rows).repartition(32).write.parquet(f"{folder}/log")
    log = spark.read.parquet(f"{folder}/log")
    both = in_window(log, s.both_weeks())
    steps = {
        "stall ratio by vendor, 14 days": lambda: daily.lag_by_cdn(views.stall_facts(both, s)),
        "affected viewers, 14 days": lambda: daily.lag_viewers(rollup.viewer_counts(views.stall_facts(both, s))),
        "report rollup, 14 days": lambda: rollup.report_rollup(views.report_facts(both, s)),
        "trend by vendor": lambda: weekly.cdn_trend(views.stall_facts(both, s), s),
        "best provinces by vendor": lambda: weekly.best_provinces_by_cdn(
            views.stall_facts(in_window(log, s.this_week()), s), s
        ),
        "valid nodes of a week": lambda: points.valid_nodes(views.point_facts(in_window(log, s.this_week()), s), s),
    }
    for name, step in steps.items():
        began = time.time()
        step().write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.time() - began:.1f} s")


if __name__ == "__main__":
    main(int(sys.argv[1]), sys.argv[2])
