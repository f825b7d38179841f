"""The derived dimensions as functions of their own, for reports written as SQL text."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lagscope.functions import dims

#: Name, parameters, type of the result and the expression, which the optimizer puts in
#: place of the call.
_FUNCTIONS = (
    ("playback_contains", "value STRING, part STRING", "BOOLEAN", "contains(value, part)"),
    ("playback_hit", "value BIGINT", "INT", "CASE WHEN value != 0 THEN 1 ELSE 0 END"),
    ("playback_cdn", "code STRING", "STRING", dims.cdn_name("code")),
    ("playback_device", "platform BIGINT", "STRING", dims.device_name("platform")),
    ("playback_isp_class", "isp STRING", "STRING", dims.isp_class("isp")),
    ("playback_isp", "isp STRING", "STRING", dims.isp_canonical("isp")),
    ("playback_range", "ms BIGINT", "INT", dims.latency_range("ms")),
    ("playback_arrow", "this DOUBLE, last DOUBLE", "STRING", dims.trend_arrow("this", "last")),
)


def register_functions(spark: SparkSession) -> None:
    """Names the functions in the session, beside the views of the log."""
    for name, parameters, result, expression in _FUNCTIONS:
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {expression}"
        )
