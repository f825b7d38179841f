"""Reports as a user writes them, in SQL over the named views and functions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lagscope.operators.views import register_views
from lagscope.settings import Settings

#: Viewers that stalled, by vendor, kind of client and whether the carrier's name holds 电信.
VIEWERS_BY_CARRIER = """
SELECT cdn, client, telecom, count(*) AS viewers, sum(hit) AS lag_viewers, sum(rows) AS rows
FROM (
  SELECT playback_cdn(v1) AS cdn, playback_device(platform) AS client,
         coalesce(playback_contains(isp, '电信'), false) AS telecom, device,
         max(playback_hit(v4)) AS hit, count(*) AS rows
  FROM playback_stall GROUP BY ALL
)
GROUP BY cdn, client, telecom
"""

#: First frames by carrier and bucket of latency.
FIRST_BY_ISP = """
SELECT playback_isp(isp) AS isp, playback_isp_class(isp) AS isp_class, playback_range(v5) AS first_range,
       count(*) AS n, sum(v5) AS v5_sum
FROM playback_first GROUP BY ALL
"""


def viewers_by_carrier(log: DataFrame, s: Settings) -> DataFrame:
    register_views(log, s)
    return log.sparkSession.sql(VIEWERS_BY_CARRIER)


def first_by_isp(log: DataFrame, s: Settings) -> DataFrame:
    register_views(log, s)
    return log.sparkSession.sql(FIRST_BY_ISP)
