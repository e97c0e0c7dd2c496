"""Summaries of feature tables for one split: activity, depth, popularity, traffic, funnel, transitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..contracts import ARROW, NAMES, need_columns
from ..functions.scalars import BAND_LABELS, band_number, percent
from .eda import STAGES


def of_split(table: DataFrame, split: str) -> DataFrame:
    return table.where(F.col("dataset_split") == split)


def available_splits(table: DataFrame) -> DataFrame:
    return table.where("dataset_split is not null").select("dataset_split").distinct().orderBy("dataset_split")


def inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    parts = [t.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count", F.lit(len(t.columns)).cast("long").alias("column_count")) for name, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def placed(df: DataFrame, value: str, tie: str) -> DataFrame:
    """Adds place (1 for the smallest value, ties by the second column) and rows.

    Counts by value give each value's first place; only rows of one value are numbered together.
    """
    sizes = df.groupBy(value).agg(F.count("*").alias("n"))
    before = Window.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(value, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))  # one row a distinct value
    total = df.agg(F.count("*").alias("rows"), F.count_distinct(value).alias("values"))
    numbered = df.withColumn("within", F.row_number().over(Window.partitionBy(value).orderBy(tie)))
    return numbered.join(starts, value).withColumn("place", F.col("start") + F.col("within")).drop("start", "within").crossJoin(F.broadcast(total))  # total is one row


def banded(df: DataFrame, value: str, tie: str, name: str, *, high_first: bool = False) -> DataFrame:
    """Adds name: the label of the equal-frequency band of value, of at most five."""
    bands = F.least(F.lit(5), F.col("values"), F.col("rows")).cast("int")
    number = band_number(F.col("place"), F.col("rows"), bands)
    labels = F.lit("All")
    for n in range(2, 6):
        ordered = BAND_LABELS[n][::-1] if high_first else BAND_LABELS[n]
        labels = F.when(bands == n, F.element_at(F.array(*map(F.lit, ordered)), number)).otherwise(labels)
    return placed(df, value, tie).withColumn(name, labels)


def _rate() -> Column:
    return percent(F.col("buy_per_day"), F.col("pv_per_day")).alias("buy_to_pv_rate")


def activity_summary(activity: DataFrame) -> DataFrame:
    grouped = activity.groupBy("activity_level").agg(F.count_distinct("user_id").alias("user_count"), F.avg("avg_daily_event_count").alias("avg_daily_events"), F.sum("pv_count_per_day").alias("pv_per_day"), F.sum("buy_count_per_day").alias("buy_per_day"))
    return grouped.select("*", _rate())


def depth_summary(activity: DataFrame) -> DataFrame:
    grouped = (
        banded(activity, "event_count", "user_id", "depth_band")
        .groupBy("depth_band")
        .agg(F.count_distinct("user_id").alias("user_count"), F.avg("event_count").alias("avg_event_count"), F.sum("pv_count_per_day").alias("pv_per_day"), F.sum("buy_count_per_day").alias("buy_per_day"))
    )
    return grouped.select("*", _rate())


def _traffic(df: DataFrame, band: str, key: str, prefix: str) -> DataFrame:
    grouped = df.groupBy(band).agg(
        F.count_distinct(f"{prefix}_id").alias(key), F.sum(f"{prefix}_total_count").alias("total_events"), F.sum(f"{prefix}_pv_count").alias("pv_count"), F.sum(f"{prefix}_buy_count").alias("buy_count")
    )
    return grouped.select("*", percent(F.col("buy_count"), F.col("pv_count")).alias("buy_to_pv_rate"))


def popularity_summary(popularity: DataFrame) -> DataFrame:
    """Bands of the rank; rank 1 is the most popular, so low ranks are the high band."""
    return _traffic(banded(popularity, "item_total_count_rank", "item_id", "popularity_band", high_first=True), "popularity_band", "item_count", "item")


def popular_items(popularity: DataFrame, n: int = 10) -> DataFrame:
    top = popularity.orderBy("item_total_count_rank", "item_id").limit(n)
    return top.select("item_id", "item_total_count_rank", "item_total_count", "item_pv_count", "item_buy_count", percent(F.col("item_buy_count"), F.col("item_pv_count")).alias("buy_to_pv_rate"))


def traffic_summary(category: DataFrame) -> DataFrame:
    return _traffic(banded(category, "category_total_count", "category_id", "traffic_band"), "traffic_band", "category_count", "category")


def conversion_funnel(conversion: DataFrame) -> DataFrame:
    """Sums of the four stages, percentages of views and of the stage before."""
    need_columns(conversion, [f"item_{n}_count" for n in NAMES], "conversion chain")
    sums = conversion.agg(*(F.sum(f"item_{n}_count").cast("double").alias(n) for n in NAMES))
    rows = []
    for i, (stage, n) in enumerate(STAGES):
        previous = F.lit(100.0) if i == 0 else percent(F.col(n), F.col(STAGES[i - 1][1]))
        rows.append(F.struct(F.lit(stage).alias("stage"), F.col(n).alias("behavior_count"), percent(F.col(n), F.col("pv")).alias("relative_to_pv_percentage"), previous.alias("from_previous_percentage")))
    return sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def transitions(sequences: DataFrame, column: str = "last_10_behavior_sequence", *, most: int | None = None) -> DataFrame:
    """16 rows: how often each behaviour follows each, and its share of what follows; 0 where nothing does.

    With most, only the first sequences by user and item are looked at, for a quick view.
    """
    sequences = sequences if most is None else sequences.orderBy("user_id", "item_id").limit(most)
    parts = F.filter(F.transform(F.split(column, ARROW), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    pairs = F.transform(F.sequence(F.lit(1), F.size("b") - 1), lambda i: F.struct(F.element_at("b", i).alias("from_behavior"), F.element_at("b", i + 1).alias("to_behavior")))
    seen = sequences.where(F.col(column).isNotNull()).select(parts.alias("b")).where(F.size("b") > 1).select(F.explode(pairs).alias("p")).select("p.*")
    counted = seen.groupBy("from_behavior", "to_behavior").agg(F.count("*").alias("n"))
    names = F.array(*map(F.lit, NAMES))
    grid = sequences.sparkSession.range(1).select(F.explode(names).alias("from_behavior")).select("from_behavior", F.explode(names).alias("to_behavior"))
    full = grid.join(counted, ["from_behavior", "to_behavior"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = F.sum("n").over(Window.partitionBy("from_behavior"))
    return full.select("from_behavior", "to_behavior", F.col("n").alias("transition_count"), F.coalesce(F.try_divide(F.col("n").cast("double"), total.cast("double")) * 100, F.lit(0.0)).alias("transition_probability"))


def summaries(tables: Mapping[str, DataFrame], split: str) -> dict[str, DataFrame]:
    """All seven of one split."""
    t = {k: of_split(v, split) for k, v in tables.items()}
    return {
        "activity": activity_summary(t["user_activity"]),
        "depth": depth_summary(t["user_activity"]),
        "popularity": popularity_summary(t["item_popularity"]),
        "top_items": popular_items(t["item_popularity"]),
        "category": traffic_summary(t["category_behavior"]),
        "funnel": conversion_funnel(t["conversion_chain"]),
        "transitions": transitions(t["user_sequence"]),
    }


def with_splits(by_split: Mapping[str, Mapping[str, DataFrame]]) -> dict[str, DataFrame]:
    """Summaries of several splits as one table each, with their split."""
    out: dict[str, DataFrame] = {}
    for split, tables in by_split.items():
        for name, t in tables.items():
            row = t.select(F.lit(split).alias("dataset_split"), "*")
            out[name] = out[name].unionByName(row) if name in out else row
    return out


def split_frame(summary: DataFrame) -> DataFrame:
    """Of label_summary(): a row a split."""
    rows = summary.where("dataset_split is not null")
    return rows.select(F.initcap("dataset_split").alias("Split"), F.col("sample_count").alias("Samples"), F.col("positive_count").alias("Positives"), F.col("negative_count").alias("Negatives"), F.col("positive_ratio").alias("Positive rate"))


def imbalance_frame(spark, manifest: Mapping) -> DataFrame:
    """Of the manifest of training sets: a row a strategy."""
    rows = [(s, v["sample_count"], v["positive_count"], v["positive_ratio"]) for s, v in manifest["training_strategy_statistics"].items()]
    return spark.createDataFrame(rows, "`Training strategy` string, Samples long, Positives long, `Positive rate` double")


def performance_view(measures: DataFrame, measure: str, split: str) -> DataFrame:
    """Candidates of one split by one measure, best first."""
    return of_split(measures, split).select("candidate", measure).orderBy(F.desc(measure), "candidate")


def threshold_view(thresholds: DataFrame, candidate: str) -> DataFrame:
    """One candidate's precision, recall and f1 at each threshold, a row a measure."""
    return thresholds.where(F.col("candidate") == candidate).unpivot("threshold", ["precision", "recall", "f1"], "metric", "value").orderBy("metric", "threshold")


def segment_view(segments: DataFrame) -> DataFrame:
    """Precision, recall and f1 of all segments but the whole, a row a measure."""
    return segments.where("segment <> 'all'").unpivot("segment", ["precision", "recall", "f1"], "metric", "value")


def attribution_view(summary: DataFrame, n: int = 10) -> DataFrame:
    """The n features of the highest mean absolute attribution."""
    return summary.orderBy(F.desc("mean_abs"), "feature").limit(n)


def report_frame(spark, rows: Sequence[Mapping], schema: str) -> DataFrame:
    """A frame of a parsed report's rows, for views of splits and imbalance."""
    names = [x.split()[0] for x in schema.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
