"""Schema of the player log and the check made on load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PLAYLOG_SCHEMA = T.StructType(
    [
        T.StructField("tag", T.StringType()),
        T.StructField("time", T.TimestampNTZType()),
        T.StructField("room_id", T.LongType()),
        T.StructField("device", T.LongType()),
        T.StructField("client_ip", T.StringType()),
        T.StructField("platform", T.LongType()),
        T.StructField("country", T.StringType()),
        T.StructField("province", T.StringType()),
        T.StructField("isp", T.StringType()),
        T.StructField("v1", T.StringType()),
        T.StructField("v2", T.StringType()),
        T.StructField("v4", T.LongType()),
        T.StructField("v5", T.LongType()),
    ]
)

# Names the views add; a log that already has one would make them ambiguous.
DERIVED_COLUMNS = ("cdn", "platform1", "isp1", "first_range", "connect_range")

# Day column of a log laid out by day.
PARTITION_COLUMN = "event_date"


def conform(df: DataFrame) -> DataFrame:
    """Checks a loaded log against the schema and keeps its columns.

    Narrower integers are widened. Anything else that differs raises.
    """
    found = {f.name: f.dataType for f in df.schema}
    problems = [f"column {name} is reserved" for name in DERIVED_COLUMNS if name in found]
    columns = []
    for field in PLAYLOG_SCHEMA:
        actual = found.get(field.name)
        if actual is None:
            problems.append(f"column {field.name} is missing")
        elif not _accepts(field.dataType, actual):
            problems.append(
                f"column {field.name} is {actual.simpleString()}, not {field.dataType.simpleString()}"
            )
        elif isinstance(actual, T.IntegralType) and actual != field.dataType:
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
        else:
            columns.append(F.col(field.name))
    if problems:
        raise ValueError("player log: " + "; ".join(problems))
    if PARTITION_COLUMN in found:
        columns.append(F.col(PARTITION_COLUMN))
    return df.select(*columns)


def _accepts(wanted: T.DataType, actual: T.DataType) -> bool:
    if isinstance(wanted, T.LongType):
        return isinstance(actual, T.IntegralType)
    if isinstance(wanted, T.TimestampNTZType):
        return isinstance(actual, (T.TimestampNTZType, T.TimestampType))
    return actual == wanted
