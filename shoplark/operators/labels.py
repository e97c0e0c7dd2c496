"""Next-day purchase labels and time-ordered splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import SPLITS, ContractError, HistoryWindow, need_rules

LABEL_TRACKING = ("dataset_split", "user_id", "item_id", "category_id", "history_start", "history_end", "label_date")


def purchases(clean: DataFrame, windows: Sequence[HistoryWindow] | None = None) -> DataFrame:
    """Distinct (user_id, item_id, label_date) bought; with windows, on their label days only, which reaches the scan."""
    bought = clean.where(F.col("behavior_type") == 4)
    if windows is not None:
        bought = bought.where(F.col("behavior_date").cast("string").isin(sorted({str(w.label_date) for w in windows})))
    return bought.select("user_id", "item_id", F.to_date("behavior_date").alias("label_date")).distinct()


def purchase_labels(wide: DataFrame, clean: DataFrame, windows: Sequence[HistoryWindow] | None = None) -> DataFrame:
    """Every wide row with label 1 if exactly this user bought exactly this item on the label day, whatever days there are.

    windows, if they are known, only spare the purchases of other days the way to the join. The check is a pass of its
    own over two columns, so wide should be a stored table.
    """
    if windows is not None:
        known = [str(w.label_date) for w in windows]
        need_rules(wide, {"label_date of no window": ~F.col("label_date").cast("string").isin(known)}, "wide table")
    need_rules(wide, {"label_date after history_end": F.col("label_date") <= F.col("history_end"), "dataset_split": ~F.col("dataset_split").isin(*SPLITS)}, "wide table")
    bought = purchases(clean, windows).withColumn("_bought", F.lit(1))
    return wide.join(bought, ["user_id", "item_id", "label_date"], "left").select(*wide.columns, F.coalesce("_bought", F.lit(0)).cast("byte").alias("label"))


def label_summary(labeled: DataFrame) -> DataFrame:
    """Samples, positives, negatives and their ratio by split, and of all splits (dataset_split null), in one aggregate."""
    out = labeled.rollup("dataset_split").agg(F.count("*").alias("sample_count"), F.coalesce(F.sum("label"), F.lit(0)).cast("long").alias("positive_count"))
    return out.withColumns({"negative_count": F.col("sample_count") - F.col("positive_count"), "positive_ratio": F.coalesce(F.try_divide(F.col("positive_count").cast("double"), F.col("sample_count").cast("double")), F.lit(0.0))})


def time_ordered_splits(labeled: DataFrame) -> dict[str, DataFrame]:
    """The rows of each split, without chance; each history ends before the next begins."""
    spans = labeled.groupBy("dataset_split").agg(F.min("history_start").alias("start"), F.max("label_date").alias("label")).limit(10).collect()
    if {r.dataset_split for r in spans} != set(SPLITS):
        raise ContractError(f"splits are {sorted(str(r.dataset_split) for r in spans)}; expected {sorted(SPLITS)}")
    ordered = sorted(spans, key=lambda r: SPLITS.index(r.dataset_split))
    if any(a.label >= b.start for a, b in zip(ordered, ordered[1:])):
        raise ContractError("splits are not in the order of time")
    return {s: labeled.where(F.col("dataset_split") == s) for s in SPLITS}


def write_splits(labeled: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """One folder a split, so a reader of one split reads no other."""
    labeled.write.mode(mode).partitionBy("dataset_split").parquet(path)
