"""The data contract: columns, behaviours, history windows, and checks that raise ContractError."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the data contract.
RAW_COLUMNS = ("time", "user_id", "item_id", "item_category", "behavior_type")
CLEAN_COLUMNS = ("time", "user_id", "item_id", "category_id", "behavior_type", "behavior_name", "behavior_date", "behavior_hour", "weekday")
BEHAVIORS = {1: "pv", 2: "fav", 3: "cart", 4: "buy"}
NAMES = ("pv", "fav", "cart", "buy")
SPLITS = ("train", "validation", "test")
MAX_ID = 2**63 - 1
TIME_PATTERN = "yyyy-M-d H"
ARROW = "→"
WIDE_KEY = ("dataset_split", "user_id", "item_id")
WIDE_TRACKING = ("category_id", "history_start", "history_end", "label_date", "last_behavior_date")
RATIOS = ("buy_per_pv", "buy_per_fav", "buy_per_cart")
PROTECTED = ("dataset_split", "user_id", "item_id", "category_id", "label", "is_synthetic", "history_start", "history_end", "label_date", "last_behavior_date")

RAW_SCHEMA = T.StructType([T.StructField("time", T.StringType()), *(T.StructField(x, T.LongType()) for x in RAW_COLUMNS[1:4]), T.StructField("behavior_type", T.ByteType())])
TEXT_SCHEMA = T.StructType([T.StructField(x, T.StringType()) for x in RAW_COLUMNS])


class ContractError(ValueError):
    """Data or configuration that breaks the contract."""


@dataclass(frozen=True)
class HistoryWindow:
    dataset_split: str
    history_start: date
    history_end: date
    label_date: date

    @property
    def days(self) -> int:
        return (self.history_end - self.history_start).days + 1


def windows_of(*rows: tuple[str, str, str, str]) -> tuple[HistoryWindow, ...]:
    return tuple(HistoryWindow(r[0], *map(date.fromisoformat, r[1:])) for r in rows)


#: The published calendar windows.
DEFAULT_WINDOWS = windows_of(("train", "2025-11-18", "2025-12-07", "2025-12-08"), ("validation", "2025-12-09", "2025-12-14", "2025-12-15"), ("test", "2025-12-16", "2025-12-17", "2025-12-18"))


def check_windows(windows: Sequence[HistoryWindow], *, apart: bool = False) -> tuple[HistoryWindow, ...]:
    """Non-empty, unique names, start <= end < label; apart also forbids a window that begins before the label day before it is over."""
    if not windows:
        raise ContractError("no history windows")
    if len({w.dataset_split for w in windows}) < len(windows):
        raise ContractError("dataset_split names are not unique")
    for w in windows:
        if not w.history_start <= w.history_end < w.label_date:
            raise ContractError(f"{w.dataset_split}: history_start <= history_end < label_date does not hold")
    ordered = sorted(windows, key=lambda w: w.history_start)
    if apart and any(b.history_start <= a.label_date for a, b in zip(ordered, ordered[1:])):
        raise ContractError("history windows overlap with a label day")
    return tuple(windows)


def evenly_spaced(begin: date, lengths: Iterable[int]) -> tuple[HistoryWindow, ...]:
    """Windows of the given days one after the other, each followed by its label day."""
    out, at = [], begin
    for name, n in zip(SPLITS, lengths):
        out.append(HistoryWindow(name, at, at + timedelta(days=n - 1), at + timedelta(days=n)))
        at += timedelta(days=n + 1)
    return tuple(out)


def need_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ContractError(f"{what}: missing columns {', '.join(missing)}")


def need_header(df: DataFrame, columns: Sequence[str] = RAW_COLUMNS) -> None:
    """Names and their order, exactly."""
    if tuple(df.columns) != tuple(columns):
        raise ContractError(f"header is {df.columns}; expected {list(columns)}")


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row with the number of rows that break each rule; a single pass."""
    return df.agg(*(F.count_if(F.coalesce(broken, F.lit(True))).alias(name) for name, broken in rules.items()))


def need_rules(df: DataFrame, rules: Mapping[str, Column], what: str = "input") -> None:
    counts = violations(df, rules).first().asDict()
    broken = {k: v for k, v in counts.items() if v}
    if broken:
        raise ContractError(f"{what}: " + ", ".join(f"{k} ({v} rows)" for k, v in broken.items()))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1")


def need_key(df: DataFrame, key: Sequence[str], what: str = "input") -> None:
    """Unique and not null."""
    need_rules(df, {f"null {k}": F.col(k).isNull() for k in key}, what)
    if not duplicate_keys(df, key).isEmpty():
        raise ContractError(f"{what}: {', '.join(key)} is not unique")


def need_dependency(df: DataFrame, key: Sequence[str], value: str) -> None:
    """value is a function of the key."""
    if not df.groupBy(*key).agg(F.min(value).alias("low"), F.max(value).alias("high")).where("low <> high").isEmpty():
        raise ContractError(f"{value} is not unique for {', '.join(key)}")


def raw_rules() -> dict[str, Column]:
    """Of typed raw rows."""
    rules = {"time": F.try_to_timestamp(F.col("time"), F.lit(TIME_PATTERN)).isNull(), "behavior_type": F.col("behavior_type").isNull() | ~F.col("behavior_type").isin(*BEHAVIORS)}
    return rules | {x: F.col(x).isNull() | (F.col(x) <= 0) for x in RAW_COLUMNS[1:4]}


def clean_rules(*, strict: bool = True) -> dict[str, Column]:
    """Derived columns agree with the time; strict also looks at hour and weekday."""
    at = F.try_to_timestamp(F.col("time"), F.lit(TIME_PATTERN))
    rules = {x: F.col(x).isNull() for x in ("user_id", "item_id", "category_id")}
    rules |= {"time": at.isNull(), "behavior_date": F.col("behavior_date").cast("string") != F.date_format(at, "yyyy-MM-dd"), "behavior_name": F.col("behavior_name").isNull() | ~F.col("behavior_name").isin(*NAMES)}
    if strict:
        rules |= {"behavior_hour": F.col("behavior_hour") != F.hour(at), "weekday": F.col("weekday") != F.weekday(at)}
    return rules


def field_roles(columns: Sequence[str]) -> dict[str, list[str]]:
    """Wide columns by role. What identifies or tracks a row, and what says its answer, must not be a model's input."""
    key = [c for c in WIDE_KEY if c in columns]
    tracking = [c for c in WIDE_TRACKING if c in columns]
    prohibited = [*key, *tracking, *(c for c in ("label", "is_synthetic") if c in columns)]
    return {"primary_key": key, "tracking": tracking, "candidate": [c for c in columns if c not in prohibited], "prohibited": prohibited}


def need_features(names: Sequence[str]) -> list[str]:
    """A feature list: non-empty strings, unique, none of them protected."""
    if not names or any(not isinstance(x, str) or not x for x in names):
        raise ContractError("feature names must be non-empty strings")
    if len(set(names)) < len(names):
        raise ContractError("feature names are not unique")
    if bad := sorted(set(names) & set(PROTECTED)):
        raise ContractError(f"protected columns among the features: {', '.join(bad)}")
    return list(names)
