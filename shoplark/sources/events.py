"""Adapter from the events table (event_id, ts, user_id, event_type, value, props) to behaviour logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import windows_of

#: Windows that fit the 30 days of the test tables.
EVENT_WINDOWS = windows_of(("train", "2024-01-01", "2024-01-19", "2024-01-20"), ("validation", "2024-01-21", "2024-01-26", "2024-01-27"), ("test", "2024-01-28", "2024-01-29", "2024-01-30"))
#: What event types stand for; "error" is no valid behaviour, so cleaning has something to reject.
EVENT_BEHAVIORS = {"view": 1, "click": 2, "signup": 3, "purchase": 4, "error": 9}


def raw_log(events: DataFrame) -> DataFrame:
    """Raw rows as text, with event_id as source order. Times are cut to the hour, as the contract has them."""
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    kind = F.lit(None).cast("int")
    for name, number in EVENT_BEHAVIORS.items():
        kind = F.when(F.col("event_type") == name, number).otherwise(kind)
    return events.select(
        F.date_format("ts", "yyyy-MM-dd HH").alias("time"),
        (F.col("user_id") + 1).cast("string").alias("user_id"),
        (k + 1).cast("string").alias("item_id"),
        (k % 10 + 1).cast("string").alias("item_category"),
        kind.cast("string").alias("behavior_type"),
        F.col("event_id").alias("source_order"),
    )


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")
