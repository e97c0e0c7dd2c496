"""Intermediate tables and the eight feature tables, over history windows.

All tables of all splits come from one pass over the history rows each; behaviour counts are conditional counts in
the same aggregate, so no table joins its own parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..contracts import ARROW, NAMES, ContractError, HistoryWindow, check_windows, need_dependency
from ..functions.scalars import days_between, dense_rank_desc, ratio
from ..plans.windows import in_windows

WINDOW = ("history_start", "history_end", "label_date")
SEQUENCE = 10


def counts(prefix: str = "") -> list[Column]:
    """The four behaviour counts."""
    return [F.count_if(F.col("behavior_name") == n).alias(f"{prefix}{n}_count") for n in NAMES]


def carried() -> list[Column]:
    """Columns that depend on the split alone."""
    return [F.first(c).alias(c) for c in WINDOW]


def days() -> Column:
    return F.count_distinct("day")


# ---- intermediate tables ----


def user_intermediate(history: DataFrame) -> DataFrame:
    return history.groupBy("dataset_split", "user_id").agg(
        *carried(),
        F.count("*").alias("event_count"),
        F.count_distinct("item_id").alias("unique_item_count"),
        F.count_distinct("category_id").alias("unique_category_count"),
        days().alias("active_day_count"),
        F.min("event_time").alias("first_event_time"),
        F.max("event_time").alias("last_event_time"),
        *counts(),
    )


def item_intermediate(history: DataFrame) -> DataFrame:
    return history.groupBy("dataset_split", "item_id").agg(
        *carried(),
        F.min("category_id").alias("category_id"),
        F.count("*").alias("event_count"),
        F.count_distinct("user_id").alias("unique_user_count"),
        days().alias("active_day_count"),
        F.min("event_time").alias("first_event_time"),
        F.max("event_time").alias("last_event_time"),
        *counts(),
    )


def category_intermediate(history: DataFrame) -> DataFrame:
    return history.groupBy("dataset_split", "category_id").agg(
        *carried(), F.count("*").alias("event_count"), F.count_distinct("user_id").alias("unique_user_count"), F.count_distinct("item_id").alias("unique_item_count"), days().alias("active_day_count"), *counts()
    )


def time_intermediate(history: DataFrame) -> DataFrame:
    return history.groupBy("dataset_split", "behavior_date", "behavior_hour").agg(
        *carried(), F.min("weekday").alias("weekday"), F.count("*").alias("event_count"), F.count_distinct("user_id").alias("unique_user_count"), F.count_distinct("item_id").alias("unique_item_count"), *counts()
    )


def intermediate_tables(clean: DataFrame, windows: Sequence[HistoryWindow]) -> dict[str, DataFrame]:
    check_windows(windows, apart=True)
    history = in_windows(clean, windows)
    return {"user": user_intermediate(history), "item": item_intermediate(history), "category": category_intermediate(history), "time": time_intermediate(history)}


# ---- feature tables ----


def user_basic(history: DataFrame) -> DataFrame:
    return history.groupBy("dataset_split", "user_id").agg(*carried(), F.count("*").alias("event_count"), *counts())


def user_activity_base(history: DataFrame) -> DataFrame:
    """Everything but the level; ratios of the window's length, four digits, halves to even."""
    grouped = history.groupBy("dataset_split", "user_id").agg(
        *carried(),
        F.first("window_days").cast("long").alias("window_days"),
        F.count("*").alias("event_count"),
        days().alias("active_day_count"),
        F.max("event_time").alias("last"),
        F.count_distinct("item_id").alias("unique_item_count"),
        F.count_distinct("category_id").alias("unique_category_count"),
        *counts(),
    )
    per = lambda a, b: F.bround(ratio(F.col(a), F.col(b)), 4)
    return grouped.select(
        "dataset_split",
        "user_id",
        *WINDOW,
        "window_days",
        "event_count",
        "active_day_count",
        per("active_day_count", "window_days").alias("active_day_ratio"),
        per("event_count", "window_days").alias("avg_daily_event_count"),
        per("event_count", "active_day_count").alias("avg_active_day_event_count"),
        F.bround(days_between(F.col("label_date").cast("timestamp_ntz"), F.col("last")), 4).alias("days_since_last_event"),
        "unique_item_count",
        "unique_category_count",
        *(per(f"{n}_count", "window_days").alias(f"{n}_count_per_day") for n in NAMES),
    )


def activity_bounds(activity: DataFrame) -> tuple[float, float]:
    """25th and 75th percentile (linear) of the rounded daily average of training users: two numbers on the driver."""
    row = activity.where("dataset_split = 'train'").agg(F.percentile("avg_daily_event_count", F.array(F.lit(0.25), F.lit(0.75))).alias("q")).first()
    if row.q is None:
        raise ContractError("no training users to take the activity bounds from")
    return float(row.q[0]), float(row.q[1])


def user_activity(history: DataFrame) -> DataFrame:
    base = user_activity_base(history)
    bounds = base.where("dataset_split = 'train'").agg(F.percentile("avg_daily_event_count", F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
    x = F.col("avg_daily_event_count")
    level = F.when(x <= F.col("q")[0], "low").when(x <= F.col("q")[1], "medium").otherwise("high")
    return base.crossJoin(F.broadcast(bounds)).withColumn("activity_level", level).drop("q")  # bounds is one row


def user_sequence(history: DataFrame) -> DataFrame:
    """The last behaviour of each user and item and the last ten, by time and source order.

    The limit by row number is applied before the shuffle too, so no group collects more than ten rows.
    """
    pair = ("dataset_split", "user_id", "item_id")
    latest = Window.partitionBy(*pair).orderBy(F.desc("event_time"), F.desc("source_order"))
    rows = history.withColumn("place", F.row_number().over(latest)).where(F.col("place") <= SEQUENCE)
    rows = rows.groupBy(*pair).agg(
        *carried(),
        F.min("category_id").alias("category_id"),
        F.array_sort(F.collect_list(F.struct((-F.col("place")).alias("p"), F.col("event_time").alias("t"), F.col("behavior_name").alias("n")))).alias("all"),
    )
    last = F.element_at("all", -1)
    return rows.select(
        "dataset_split",
        "user_id",
        "item_id",
        "category_id",
        *WINDOW,
        last["n"].alias("last_behavior_type"),
        F.hour(last["t"]).cast("byte").alias("last_behavior_hour"),
        F.bround(days_between(F.col("label_date").cast("timestamp_ntz"), last["t"]), 4).alias("last_behavior_days_ago"),
        F.array_join(F.transform("all", lambda x: x["n"]), ARROW).alias("last_10_behavior_sequence"),
    )


def item_behavior(history: DataFrame) -> DataFrame:
    return history.groupBy("dataset_split", "item_id").agg(
        *carried(),
        F.min("category_id").alias("category_id"),
        F.count("*").alias("item_total_count"),
        *counts("item_"),
        F.count_distinct("user_id").alias("item_unique_user_count"),
        F.count_distinct(F.when(F.col("behavior_name") == "buy", F.col("user_id"))).alias("item_unique_buyer_count"),
        days().alias("item_active_day_count"),
    )


RANKED = ("item_total_count", "item_unique_user_count", "item_active_day_count", "item_buy_count")


def item_popularity(items: DataFrame) -> DataFrame:
    """From item_behavior: four dense ranks within the split, 1 for the largest. Only distinct values are ranked."""
    out = items
    for name in RANKED:
        out = dense_rank_desc(out, ["dataset_split"], name, f"{name}_rank")
    return out.select("dataset_split", "item_id", "category_id", *WINDOW, "item_total_count", *(f"item_{n}_count" for n in NAMES), "item_unique_user_count", "item_active_day_count", *(f"{x}_rank" for x in RANKED))


def category_behavior(history: DataFrame) -> DataFrame:
    return history.groupBy("dataset_split", "category_id").agg(
        *carried(),
        F.count("*").alias("category_total_count"),
        F.count_distinct("user_id").alias("category_unique_user_count"),
        F.count_distinct("item_id").alias("category_unique_item_count"),
        days().alias("category_active_day_count"),
        F.min("event_time").alias("category_first_event_time"),
        F.max("event_time").alias("category_last_event_time"),
        *counts("category_"),
    )


def time_behavior(history: DataFrame) -> DataFrame:
    return history.groupBy("dataset_split", "behavior_date", "behavior_hour").agg(
        *carried(),
        F.min("weekday").alias("weekday"),
        F.count("*").alias("time_total_count"),
        F.count_distinct("user_id").alias("time_unique_user_count"),
        F.count_distinct("item_id").alias("time_unique_item_count"),
        F.count_distinct("category_id").alias("time_unique_category_count"),
        *counts("time_"),
    )


def conversion_chain(items: DataFrame) -> DataFrame:
    """From item_behavior: purchases per view, favourite and cart; null without any."""
    per = lambda n: ratio(F.col("item_buy_count"), F.col(f"item_{n}_count")).alias(f"buy_per_{n}")
    return items.select("dataset_split", "item_id", "category_id", *WINDOW, *(f"item_{n}_count" for n in NAMES), per("pv"), per("fav"), per("cart"))


def feature_tables(clean: DataFrame, windows: Sequence[HistoryWindow]) -> dict[str, DataFrame]:
    """All eight. item_behavior feeds two others, so callers that write all of them may persist it."""
    history = in_windows(clean, check_windows(windows))
    items = item_behavior(history)
    return {
        "user_basic": user_basic(history),
        "user_activity": user_activity(history),
        "user_sequence": user_sequence(history),
        "item_behavior": items,
        "item_popularity": item_popularity(items),
        "category_behavior": category_behavior(history),
        "time_behavior": time_behavior(history),
        "conversion_chain": conversion_chain(items),
    }


def need_one_category(history: DataFrame) -> None:
    """An item has one category in a window."""
    need_dependency(history, ["dataset_split", "item_id"], "category_id")


def window_metadata(table: DataFrame) -> DataFrame:
    """The distinct windows of a table; a split with several is an error of the table."""
    return table.select("dataset_split", *WINDOW).distinct()
