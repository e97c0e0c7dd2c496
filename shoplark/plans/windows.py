"""History windows as a small dimension, and the rows that lie in them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import HistoryWindow, check_windows

WINDOW_COLUMNS = ("dataset_split", "history_start", "history_end", "label_date")


def window_table(spark: SparkSession, windows: Sequence[HistoryWindow]) -> DataFrame:
    check_windows(windows)
    rows = [(w.dataset_split, w.history_start, w.history_end, w.label_date, w.days) for w in windows]
    return spark.createDataFrame(rows, "dataset_split string, history_start date, history_end date, label_date date, window_days int")


def in_windows(clean: DataFrame, windows: Sequence[HistoryWindow]) -> DataFrame:
    """Clean rows with the columns of each window that their day lies in; label days are in none of their own.

    The windows are a handful of rows on the driver, so the range join is a broadcast without a shuffle.
    """
    dimension = F.broadcast(window_table(clean.sparkSession, windows))
    day = F.to_date(F.col("event_time"))
    low, high = min(w.history_start for w in windows), max(w.history_end for w in windows)
    some = clean.withColumn("day", day).where(F.col("day").between(F.lit(low), F.lit(high)))
    return some.join(dimension, F.col("day").between(F.col("history_start"), F.col("history_end")) & (F.col("day") < F.col("label_date")))
