"""Cleaning: row rejection with reasons, derived columns, and the rule for repeated behaviours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..contracts import BEHAVIORS, CLEAN_COLUMNS, RAW_COLUMNS, TIME_PATTERN, need_columns
from ..functions.scalars import numeric_id, stripped

REASONS = ("missing", "invalid_id", "invalid_behavior", "invalid_time")
#: Repeats of one behaviour in one hour from which only the first stays.
THRESHOLD = 60
REPEAT_KEY = ("user_id", "item_id", "behavior_type", "time")


def judged(raw: DataFrame) -> DataFrame:
    """Typed rows with reject_reason: the first of REASONS that applies, null for rows that stay."""
    need_columns(raw, RAW_COLUMNS, "raw log")
    others = [c for c in raw.columns if c not in RAW_COLUMNS]
    # A generated row of one is a bound for the optimiser: filters and casts above refer to texts that are made once,
    # where a projection would be written out anew in each of them.
    text = raw.select(*others, F.inline(F.array(F.struct(*(stripped(F.col(c).cast("string")).alias(c) for c in RAW_COLUMNS)))))
    blank = [F.col(c).isNull() | (F.col(c) == "") for c in RAW_COLUMNS]
    missing = blank[0]
    for x in blank[1:]:
        missing = missing | x
    typed = text.select(
        F.col("time"),
        *(numeric_id(F.col(c)).alias(c) for c in RAW_COLUMNS[1:4]),
        F.col("behavior_type").try_cast("double").alias("kind"),
        F.try_to_timestamp(F.col("time"), F.lit(TIME_PATTERN)).cast("timestamp_ntz").alias("event_time"),
        missing.alias("missing"),
        *others,
    )
    no_id = F.col("user_id").isNull() | F.col("item_id").isNull() | F.col("item_category").isNull()
    reason = (
        F.when(F.col("missing"), "missing")
        .when(no_id, "invalid_id")
        .when(F.col("kind").isNull() | ~F.col("kind").isin(*map(float, BEHAVIORS)), "invalid_behavior")
        .when(F.col("event_time").isNull(), "invalid_time")
    )
    return typed.withColumn("reject_reason", reason)


def behavior_name(number: Column) -> Column:
    names = F.lit(None).cast("string")
    for k, name in BEHAVIORS.items():
        names = F.when(number == k, name).otherwise(names)
    return names


def clean_rows(raw: DataFrame) -> DataFrame:
    """The clean columns, event_time, and whatever else raw has (such as source_order)."""
    others = [c for c in raw.columns if c not in RAW_COLUMNS]
    kept = judged(raw).where("reject_reason is null")
    at = F.col("event_time")
    kind = F.col("kind").cast("byte")
    return kept.select(
        F.date_format(at, "yyyy-MM-dd HH").alias("time"),
        "user_id",
        "item_id",
        F.col("item_category").alias("category_id"),
        kind.alias("behavior_type"),
        behavior_name(kind).alias("behavior_name"),
        F.date_format(at, "yyyy-MM-dd").alias("behavior_date"),
        F.hour(at).cast("byte").alias("behavior_hour"),
        F.weekday(at).cast("byte").alias("weekday"),
        "event_time",
        *others,
    )


def rejected_counts(raw: DataFrame) -> DataFrame:
    """Rows in, rows rejected by reason, rows kept: one row, one pass."""
    reason = F.col("reject_reason")
    return judged(raw).agg(F.count("*").alias("input_rows"), *(F.count_if(reason == r).alias(f"removed_{r}_rows") for r in REASONS), F.count_if(reason.isNull()).alias("kept_rows"))


def limit_repeats(clean: DataFrame, *, key: Sequence[str] = REPEAT_KEY, threshold: int = THRESHOLD, order: str = "source_order") -> DataFrame:
    """Groups of fewer than threshold rows stay whole; of larger ones the first row in source order stays.

    First rows come from an aggregate that combines before the shuffle, so a key with very many repeats is one row a task.
    """
    groups = clean.groupBy(*key).agg(F.count("*").alias("repeats"), F.min(order).alias("first_order"))
    heavy = groups.where(F.col("repeats") >= threshold).select(*(F.col(k).alias(f"_{k}") for k in key), "first_order")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    joined = clean.join(heavy, same, "left")
    return joined.where(F.col("first_order").isNull() | (F.col(order) == F.col("first_order"))).select(*clean.columns)


def repeat_report(clean: DataFrame, *, key: Sequence[str] = REPEAT_KEY, threshold: int = THRESHOLD) -> DataFrame:
    """Groups and rows in the bands 2 to threshold - 1 and threshold or more, and the rows that limit_repeats removes."""
    sizes = clean.groupBy(*key).agg(F.count("*").alias("n"))
    normal, heavy = (F.col("n") >= 2) & (F.col("n") < threshold), F.col("n") >= threshold
    total = lambda c, x: F.coalesce(F.sum(F.when(c, x)), F.lit(0)).cast("long")
    return sizes.agg(
        F.count_if(normal).alias("normal_frequency_groups"),
        total(normal, F.col("n")).alias("normal_frequency_records"),
        F.count_if(heavy).alias("high_frequency_groups"),
        total(heavy, F.col("n")).alias("high_frequency_records"),
        total(heavy, F.col("n") - 1).alias("removed_rows"),
    )


def clean_log(raw: DataFrame, *, key: Sequence[str] = REPEAT_KEY, threshold: int = THRESHOLD, order: str = "source_order") -> DataFrame:
    """The whole cleaning: rejection, derivation, repeats."""
    return limit_repeats(clean_rows(raw), key=key, threshold=threshold, order=order)


def contract_columns(clean: DataFrame) -> DataFrame:
    return clean.select(*CLEAN_COLUMNS)
