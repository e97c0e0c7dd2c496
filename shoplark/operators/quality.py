"""Quality report of a raw log: scale, completeness, validity, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import BEHAVIORS, RAW_COLUMNS, TIME_PATTERN, need_columns
from ..functions.scalars import stripped

IDS = RAW_COLUMNS[1:4]
SUSPECT_KEY = ("time", "user_id", "item_id", "behavior_type")


def quality_metrics(raw: DataFrame) -> DataFrame:
    """One row; every column is judged on its own non-missing values, which differs from cleaning on purpose."""
    need_columns(raw, RAW_COLUMNS, "raw log")
    text = raw.select(*(stripped(F.col(c).cast("string")).alias(c) for c in RAW_COLUMNS))
    missing = {c: F.col(c).isNull() | (F.col(c) == "") for c in RAW_COLUMNS}
    good = {c: F.col(c).rlike("^[1-9][0-9]*$") & F.col(c).try_cast("bigint").isNotNull() for c in IDS}
    good["behavior_type"] = F.col("behavior_type").isin(*map(str, BEHAVIORS))
    at = F.try_to_timestamp(F.col("time"), F.lit(TIME_PATTERN)).cast("timestamp_ntz")
    good["time"] = at.isNotNull()
    anything = missing["time"]
    for c in RAW_COLUMNS[1:]:
        anything = anything | missing[c]
    return text.agg(
        F.count("*").alias("row_count"),
        F.count_if(anything).alias("rows_with_any_missing"),
        *(F.count_if(missing[c]).alias(f"missing_{c}") for c in RAW_COLUMNS),
        *(F.count_if(~missing[c] & ~F.coalesce(good[c], F.lit(False))).alias(f"invalid_{c}") for c in RAW_COLUMNS),
        *(F.count_distinct(F.when(good[c], F.col(c))).alias(f"unique_{c}") for c in IDS),
        *(F.count_if(F.col("behavior_type") == str(k)).alias(f"behavior_{k}_count") for k in BEHAVIORS),
        F.date_format(F.min(at), "yyyy-MM-dd HH").alias("valid_time_min"),
        F.date_format(F.max(at), "yyyy-MM-dd HH").alias("valid_time_max"),
    )


def duplicate_summary(raw: DataFrame, key: tuple[str, ...], prefix: str) -> DataFrame:
    """Groups of rows that are equal as they stand (untrimmed, nulls alike), their rows, and the rows beyond the first."""
    sizes = raw.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("long")
    return sizes.agg(F.count("*").alias(f"{prefix}_groups"), total.alias(f"{prefix}_records"), (total - F.count("*")).alias(f"{prefix}_excess"))


def quality_report(raw: DataFrame) -> DataFrame:
    """All of it in one row; status is PASS without any missing, invalid or exactly repeated rows. Suspected repeats do not count."""
    exact, suspected = duplicate_summary(raw, RAW_COLUMNS, "exact"), duplicate_summary(raw, SUSPECT_KEY, "suspected")
    whole = quality_metrics(raw).crossJoin(F.broadcast(exact)).crossJoin(F.broadcast(suspected))  # one row each
    issues = F.col("exact_records")
    for c in RAW_COLUMNS:
        issues = issues + F.col(f"missing_{c}") + F.col(f"invalid_{c}")
    return whole.withColumn("status", F.when(issues == 0, "PASS").otherwise("REVIEW"))
