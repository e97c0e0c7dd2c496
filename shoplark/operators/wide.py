"""The wide table: one row a split, user and item, with everything that is known of them before the label day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import ARROW, NAMES, RATIOS, WIDE_KEY, ContractError, HistoryWindow, need_key, need_rules, violations
from ..plans.windows import window_table
from .features import RANKED, WINDOW

USER_BASIC = ("event_count", "pv_count", "fav_count", "cart_count", "buy_count")
USER_ACTIVITY = (
    "window_days",
    "active_day_count",
    "active_day_ratio",
    "avg_daily_event_count",
    "avg_active_day_event_count",
    "days_since_last_event",
    "unique_item_count",
    "unique_category_count",
    "pv_count_per_day",
    "fav_count_per_day",
    "cart_count_per_day",
    "buy_count_per_day",
    "activity_level",
)
ITEM = ("item_total_count", "item_pv_count", "item_fav_count", "item_cart_count", "item_buy_count", "item_unique_user_count", "item_unique_buyer_count", "item_active_day_count")
CATEGORY = tuple(f"category_{x}" for x in ("active_day_count", "buy_count", "cart_count", "fav_count", "first_event_time", "last_event_time", "pv_count", "total_count", "unique_item_count", "unique_user_count"))
TIME = ("time_buy_count", "time_cart_count", "time_fav_count", "time_pv_count", "time_total_count", "time_unique_category_count", "time_unique_item_count", "time_unique_user_count", "time_weekday")
SEQUENCE = ("last_behavior_type", "last_behavior_hour", "last_behavior_days_ago", "last_10_behavior_sequence")
WIDE_COLUMNS = (
    *WIDE_KEY,
    "category_id",
    *WINDOW,
    "last_behavior_date",
    *SEQUENCE,
    *(f"user_{c}" for c in USER_BASIC),
    *(f"user_{c}" for c in USER_ACTIVITY),
    *ITEM,
    *(f"{x}_rank" for x in RANKED),
    *RATIOS,
    *CATEGORY,
    *TIME,
)


def uncovered(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """The keys of one side only, with the side that has them."""
    a, b = left.select(*key, F.lit(True).alias("_l")), right.select(*key, F.lit(True).alias("_r"))
    both = a.join(b, key, "full_outer").where("_l is null or _r is null")
    return both.select(*key, F.when(F.col("_l"), "left").otherwise("right").alias("side"))


def need_coverage(left: DataFrame, right: DataFrame, key: list[str], what: str) -> None:
    """Both sides have the same keys."""
    if not uncovered(left, right, key).isEmpty():
        raise ContractError(f"{what}: the tables do not cover the same keys")


def _disagreement(left: DataFrame, right: DataFrame, key: list[str], columns: list[str]) -> tuple[DataFrame, dict[str, Column]]:
    b = right.select(*key, *(F.col(c).alias(f"_{c}") for c in columns))
    return left.join(b, key), {f"inconsistent {c}": ~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns}


def disagreements(left: DataFrame, right: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """One row: for each column that both sides carry, the keys where it differs."""
    return violations(*_disagreement(left, right, key, columns))


def need_agreement(left: DataFrame, right: DataFrame, key: list[str], columns: list[str], what: str) -> None:
    """Columns that both sides carry are equal."""
    need_rules(*_disagreement(left, right, key, columns), what)


def window_disagreements(table: DataFrame, windows: Sequence[HistoryWindow]) -> DataFrame:
    """A row a split of the table or of the windows: its rows, and those whose window is not the split's, or that have no known split."""
    known = window_table(table.sparkSession, windows).select("dataset_split", *(F.col(c).alias(f"_{c}") for c in WINDOW))
    same = F.lit(True)
    for c in WINDOW:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    spans = table.groupBy("dataset_split", *WINDOW).agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return spans.join(F.broadcast(known), "dataset_split", "full_outer").groupBy("dataset_split").agg(F.sum(n).alias("rows"), F.sum(F.when(F.col("_label_date").isNotNull() & same, 0).otherwise(n)).alias("wrong_rows"))


def need_windows(table: DataFrame, windows: Sequence[HistoryWindow], what: str) -> None:
    """Every split has rows, and each row the window of its split."""
    bad = [r for r in window_disagreements(table, windows).collect() if r.wrong_rows or not r.rows]  # a row a split
    if bad:
        raise ContractError(f"{what}: " + ", ".join(f"{r.dataset_split}: {r.rows} rows, {r.wrong_rows} of another window" for r in bad))


def user_lookup(tables: Mapping[str, DataFrame]) -> DataFrame:
    key = ["dataset_split", "user_id"]
    basic = tables["user_basic"].select(*key, *(F.col(c).alias(f"user_{c}") for c in USER_BASIC))
    return basic.join(tables["user_activity"].select(*key, *(F.col(c).alias(f"user_{c}") for c in USER_ACTIVITY)), key)


def item_lookup(tables: Mapping[str, DataFrame]) -> DataFrame:
    key = ["dataset_split", "item_id"]
    ranks = tables["item_popularity"].select(*key, *(f"{x}_rank" for x in RANKED))
    return tables["item_behavior"].select(*key, *ITEM).join(ranks, key).join(tables["conversion_chain"].select(*key, *RATIOS), key)


def category_lookup(tables: Mapping[str, DataFrame]) -> DataFrame:
    return tables["category_behavior"].select("dataset_split", "category_id", *CATEGORY)


def time_lookup(tables: Mapping[str, DataFrame]) -> DataFrame:
    named = tables["time_behavior"].withColumnRenamed("weekday", "time_weekday")
    return named.select("dataset_split", F.col("behavior_date").cast("date").alias("last_behavior_date"), F.col("behavior_hour").alias("last_behavior_hour"), *TIME)


def wide_table(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The 64 columns in order. Left joins keep every pair; wide_gate rejects those without a match."""
    days = F.ceil("last_behavior_days_ago").cast("int")
    anchor = tables["user_sequence"].withColumn("last_behavior_date", F.date_sub("label_date", days))
    joined = (
        anchor.join(user_lookup(tables), ["dataset_split", "user_id"], "left")
        .join(item_lookup(tables), ["dataset_split", "item_id"], "left")
        .join(category_lookup(tables), ["dataset_split", "category_id"], "left")
        .join(time_lookup(tables), ["dataset_split", "last_behavior_date", "last_behavior_hour"], "left")
    )
    return joined.select(*WIDE_COLUMNS)


def check_wide_inputs(tables: Mapping[str, DataFrame], windows: Sequence[HistoryWindow] | None = None) -> None:
    """Unique keys, equal coverage, agreement of what several tables carry and, if the windows are given, with them."""
    for name, table in tables.items() if windows else ():
        need_windows(table, windows, name)
    user, item = ["dataset_split", "user_id"], ["dataset_split", "item_id"]
    for name, key in (("user_basic", user), ("user_activity", user), ("user_sequence", list(WIDE_KEY)), ("item_behavior", item), ("item_popularity", item), ("conversion_chain", item)):
        need_key(tables[name], key, name)
    need_key(tables["category_behavior"], ["dataset_split", "category_id"], "category_behavior")
    need_key(tables["time_behavior"], ["dataset_split", "behavior_date", "behavior_hour"], "time_behavior")
    need_coverage(tables["user_basic"], tables["user_activity"], user, "users")
    need_agreement(tables["user_basic"], tables["user_activity"], user, ["event_count", *WINDOW], "users")
    for other in ("item_popularity", "conversion_chain"):
        need_coverage(tables["item_behavior"], tables[other], item, "items")
        need_agreement(tables["item_behavior"], tables[other], item, ["category_id", *(f"item_{n}_count" for n in NAMES), *WINDOW], "items")
    spans = tables["user_sequence"].select("dataset_split", *WINDOW).distinct()
    for name in ("category_behavior", "time_behavior", "user_basic"):
        need_agreement(tables[name].select("dataset_split", *WINDOW).distinct(), spans, ["dataset_split"], list(WINDOW), name)


def quality_rules() -> dict[str, Column]:
    """What must not be, by column or relation."""
    col = F.col
    rules: dict[str, Column] = {}
    suffixes, exempt = ("_count", "_rank", "_ratio", "_days", "_days_ago"), {"last_behavior_type"}
    for c in WIDE_COLUMNS:
        if (c.endswith(suffixes) or c in RATIOS) and c not in exempt:
            rules[f"negative_{c}"] = F.coalesce(col(c) < 0, F.lit(False))
    for c in WIDE_COLUMNS:
        if c in RATIOS or c.endswith(("_ratio", "_per_day", "_days_ago")) or c.startswith("user_avg_") or c == "user_days_since_last_event":
            rules[f"infinite_{c}"] = F.coalesce(F.abs(col(c).cast("double")) == float("inf"), F.lit(False))
    for c in ("user_id", "item_id", "category_id", *(f"{x}_rank" for x in RANKED)):
        rules[f"not_positive_{c}"] = F.coalesce(col(c) <= 0, F.lit(False))
    name = "(?:pv|fav|cart|buy)"
    rules["bad_last_behavior_type"] = ~col("last_behavior_type").isin(*NAMES)
    rules["bad_sequence"] = ~col("last_10_behavior_sequence").rlike(f"^{name}(?:{ARROW}{name}){{0,9}}$")
    rules["sequence_tail"] = F.element_at(F.split("last_10_behavior_sequence", ARROW), -1) != col("last_behavior_type")
    rules["bad_activity_level"] = ~col("user_activity_level").isin("low", "medium", "high")
    rules["active_ratio_range"] = ~col("user_active_day_ratio").between(0, 1)
    rules["hour_range"] = ~col("last_behavior_hour").between(0, 23)
    rules["weekday_range"] = ~col("time_weekday").between(0, 6)
    rules["weekday_of_date"] = col("time_weekday") != F.weekday("last_behavior_date")
    first, last = F.to_date("category_first_event_time"), F.to_date("category_last_event_time")
    rules["category_times"] = (first > last) | (first < col("history_start")) | (last > col("history_end"))
    rules["last_date_in_window"] = ~col("last_behavior_date").between(col("history_start"), col("history_end"))
    return rules


def wide_quality(wide: DataFrame) -> DataFrame:
    """One row: rows, nulls by column and broken rules, in a single aggregate."""
    return wide.agg(F.count("*").alias("rows"), *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in WIDE_COLUMNS), *(F.count_if(F.coalesce(r, F.lit(False))).alias(n) for n, r in quality_rules().items()))


def wide_gate(wide: DataFrame, anchor_rows: int) -> dict[str, int]:
    """The metrics of wide_quality; raises if a row is lost, a key repeats, a column but the ratios has nulls, or a rule is broken."""
    if "label" in wide.columns:
        raise ContractError("a wide table has no label")
    found = wide_quality(wide).first().asDict()
    if found["rows"] != anchor_rows:
        raise ContractError(f"wide table has {found['rows']} rows; its anchor has {anchor_rows}")
    bad = {k: v for k, v in found.items() if v and k != "rows" and k not in {f"null_{c}" for c in RATIOS}}
    if bad:
        raise ContractError("wide table: " + ", ".join(f"{k}={v}" for k, v in bad.items()))
    need_key(wide, list(WIDE_KEY), "wide table")
    return found
