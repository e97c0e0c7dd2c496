"""Descriptive statistics of clean logs: nine tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import BEHAVIORS, NAMES
from ..functions.scalars import percent2

STAGES = (("PV", "pv"), ("Favorite", "fav"), ("Cart", "cart"), ("Purchase", "buy"))


def _four_counts() -> list:
    return [F.count_if(F.col("behavior_name") == n).alias(f"{n}_count") for n in NAMES]


def _one_row(clean: DataFrame) -> DataFrame:
    return clean.agg(*_four_counts())


def behavior_distribution(clean: DataFrame) -> DataFrame:
    """Four rows, also for behaviours that do not occur; null percentages without any row."""
    rows = F.array(*(F.struct(F.lit(k).alias("behavior_type"), F.lit(n).alias("behavior_name"), F.col(f"{n}_count").alias("behavior_count")) for k, n in BEHAVIORS.items()))
    total = sum((F.col(f"{n}_count") for n in NAMES), F.lit(0))
    out = _one_row(clean).select(total.alias("total"), F.explode(rows).alias("r"))
    return out.select("r.*", percent2(F.col("r.behavior_count"), F.col("total")).alias("percentage"))


def user_purchase_summary(clean: DataFrame) -> DataFrame:
    """Rows, purchases, buyers, others, and buyers of two or more purchases."""
    users = clean.groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("behavior_name") == "buy").alias("b"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return users.agg(
        total("n").alias("total_behavior_count"), total("b").alias("purchase_count"), F.count_if(F.col("b") > 0).alias("purchase_users"), F.count_if(F.col("b") == 0).alias("non_purchase_users"), F.count_if(F.col("b") >= 2).alias("repeat_purchase_users")
    )


def item_statistics(clean: DataFrame) -> DataFrame:
    return clean.groupBy("item_id").agg(*_four_counts())


def top_items(clean: DataFrame, n: int = 10) -> DataFrame:
    """The items of most purchases; of equal ones the smallest id."""
    return item_statistics(clean).orderBy(F.desc("buy_count"), "item_id").limit(n)


def category_statistics(clean: DataFrame) -> DataFrame:
    """Rows and purchases, and the share of all purchases."""
    by = clean.groupBy("category_id").agg(F.count("*").alias("behavior_count"), F.count_if(F.col("behavior_name") == "buy").alias("buy_count"))
    total = clean.agg(F.count_if(F.col("behavior_name") == "buy").alias("total"))
    return by.crossJoin(F.broadcast(total)).select("category_id", "behavior_count", "buy_count", percent2(F.col("buy_count"), F.col("total")).alias("buy_percentage"))  # total is one row


def top_categories(clean: DataFrame, n: int = 10) -> DataFrame:
    return category_statistics(clean).orderBy(F.desc("buy_count"), "category_id").limit(n)


def daily_behavior(clean: DataFrame) -> DataFrame:
    return clean.groupBy("behavior_date").agg(*_four_counts())


def hourly_behavior(clean: DataFrame) -> DataFrame:
    return clean.groupBy(F.col("behavior_hour").cast("int").alias("behavior_hour")).agg(*_four_counts())


def descriptive_funnel(clean: DataFrame) -> DataFrame:
    """Counts of the four stages and their percentage of views; 0 without views."""
    rows = F.array(*(F.struct(F.lit(s).alias("stage"), F.col(f"{n}_count").alias("behavior_count")) for s, n in STAGES))
    out = _one_row(clean).select("pv_count", F.explode(rows).alias("r"))
    share = F.when(F.col("pv_count") > 0, percent2(F.col("r.behavior_count"), F.col("pv_count"))).otherwise(0.0)
    return out.select("r.*", share.alias("relative_to_pv_percentage"))


def long_counts(table: DataFrame, key: str) -> DataFrame:
    """Daily or hourly counts as one row a behaviour, as plots take them."""
    return table.unpivot([key], [f"{n}_count" for n in NAMES], "behavior_name", "behavior_count").withColumn("behavior_name", F.regexp_replace("behavior_name", "_count$", ""))


TABLES = {
    "behavior_distribution": behavior_distribution,
    "user_purchase_summary": user_purchase_summary,
    "item_statistics": item_statistics,
    "top10_items": top_items,
    "category_statistics": category_statistics,
    "top10_categories": top_categories,
    "daily_behavior": daily_behavior,
    "hourly_behavior": hourly_behavior,
    "behavior_funnel": descriptive_funnel,
}


def eda_tables(clean: DataFrame) -> dict[str, DataFrame]:
    return {name: build(clean) for name, build in TABLES.items()}
