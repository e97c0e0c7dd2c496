"""One query an operator over the test tables: callables of (spark, sf_dir)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import RAW_COLUMNS, clean_rules, field_roles, raw_rules, violations
from ..functions.ordering import chance
from ..operators import cleaning, dashboard, eda, explain, features, imbalance, inference, labels, metrics, preprocess, quality, screening, wide
from ..sources import files
from ..sources.events import EVENT_WINDOWS, events_table, raw_log
from ..sources.shared import shared_path, stored
from .windows import in_windows, window_table

#: In the test tables no behaviour repeats within an hour, so the rule for repeats is applied to days here.
DAY_KEY, DAY_THRESHOLD = ("behavior_date", "user_id", "behavior_type"), 3
#: Numeric columns of the screening and preprocessing queries.
NUMERIC = ("user_event_count", "user_active_day_ratio", "user_unique_item_count", "item_total_count", "item_buy_count", "item_total_count_rank", "buy_per_pv", "category_total_count", "time_total_count", "last_behavior_days_ago", "user_window_days")
CATEGORICAL = ("last_behavior_type", "user_activity_level")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return raw_log(events_table(spark, sf))


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_rows(raw(spark, sf))


def history(spark: SparkSession, sf: str) -> DataFrame:
    return in_windows(clean(spark, sf), EVENT_WINDOWS)


def tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return features.feature_tables(clean(spark, sf), EVENT_WINDOWS)


def wide_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Eight tables read the clean log, so it is kept first."""
    return wide.wide_table(features.feature_tables(stored(clean(spark, sf), "clean"), EVENT_WINDOWS))


def labeled(spark: SparkSession, sf: str) -> DataFrame:
    """Kept, as a pipeline of stages keeps it: checks, fits and scores read it again."""
    log = stored(clean(spark, sf), "clean")
    rows = stored(wide.wide_table(features.feature_tables(log, EVENT_WINDOWS)), "wide")
    return stored(labels.purchase_labels(rows, log, EVENT_WINDOWS), "labeled")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Sums of doubles depend on their order in the last digits."""
    return df.select(*(F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def train_rows(spark: SparkSession, sf: str) -> DataFrame:
    return labeled(spark, sf).where("dataset_split = 'train'")


SMOTE_FEATURES = ("user_event_count", "item_total_count", "last_code")


def smote_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Training rows with two continuous features and a code."""
    rows = train_rows(spark, sf)
    return rows.select("user_id", "item_id", "category_id", "label", *(F.col(c).cast("double").alias(c) for c in SMOTE_FEATURES[:2]), F.length("last_behavior_type").alias("last_code"))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled training rows with a made-up score that has ties."""
    points = (F.col("user_event_count") * 7 + F.col("item_total_count") * 3 + F.col("user_id") + F.col("item_id") * 5) % 97
    return train_rows(spark, sf).select("user_id", "item_id", "user_event_count", "item_total_count", F.col("label").cast("int").alias("label"), (points.cast("double") / 97.0).alias("score"))


# ---- contract checks, cleaning, quality ----


@query
def v2_contract_violations(spark: SparkSession, sf: str) -> DataFrame:
    typed = raw(spark, sf).select("time", *(F.col(c).try_cast("bigint").alias(c) for c in ("user_id", "item_id", "item_category")), F.col("behavior_type").try_cast("int").alias("behavior_type"))
    return violations(typed, {f"bad_{k}": r for k, r in raw_rules().items()})


@query
def v7_items_of_several_categories(spark: SparkSession, sf: str) -> DataFrame:
    by = history(spark, sf).groupBy("dataset_split", "item_id").agg(F.count_distinct("category_id").alias("categories"))
    return by.groupBy("categories").agg(F.count("*").alias("items"))


@query
def v9_duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    from ..contracts import duplicate_keys

    return duplicate_keys(clean(spark, sf), ["user_id", "item_id", "behavior_date"])


@query
def v16_field_roles(spark: SparkSession, sf: str) -> DataFrame:
    roles = field_roles([*wide.WIDE_COLUMNS, "label"])
    return spark.createDataFrame([(r, c) for r, names in roles.items() for c in names], "role string, field string")


@query
def d1_clean_rows(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.contract_columns(clean(spark, sf))


@query
def d1_rejected_counts(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.rejected_counts(raw(spark, sf))


@query
def d2_clean_log(spark: SparkSession, sf: str) -> DataFrame:
    kept = cleaning.limit_repeats(clean(spark, sf), key=DAY_KEY, threshold=DAY_THRESHOLD)
    return kept.select(*(c for c in cleaning.CLEAN_COLUMNS), "source_order")


@query
def d2_repeat_report(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.repeat_report(clean(spark, sf), key=DAY_KEY, threshold=DAY_THRESHOLD)


@query
def d3_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_report(raw(spark, sf))


# ---- intermediate and feature tables ----


@query
def p4_history_rows(spark: SparkSession, sf: str) -> DataFrame:
    return history(spark, sf).groupBy("dataset_split", "history_start", "history_end", "label_date").agg(F.count("*").alias("rows"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


@query
def d4_user_intermediate(spark: SparkSession, sf: str) -> DataFrame:
    return features.user_intermediate(history(spark, sf))


@query
def d5_item_intermediate(spark: SparkSession, sf: str) -> DataFrame:
    return features.item_intermediate(history(spark, sf))


@query
def d6_category_intermediate(spark: SparkSession, sf: str) -> DataFrame:
    return features.category_intermediate(history(spark, sf))


@query
def d7_time_intermediate(spark: SparkSession, sf: str) -> DataFrame:
    return features.time_intermediate(history(spark, sf))


@query
def d9_user_basic(spark: SparkSession, sf: str) -> DataFrame:
    return features.user_basic(history(spark, sf))


@query
def d11_user_activity(spark: SparkSession, sf: str) -> DataFrame:
    return features.user_activity(history(spark, sf))


@query
def d12_user_sequence(spark: SparkSession, sf: str) -> DataFrame:
    return features.user_sequence(history(spark, sf))


@query
def d13_item_behavior(spark: SparkSession, sf: str) -> DataFrame:
    return features.item_behavior(history(spark, sf))


@query
def d14_item_popularity(spark: SparkSession, sf: str) -> DataFrame:
    return features.item_popularity(features.item_behavior(history(spark, sf)))


@query
def d15_category_behavior(spark: SparkSession, sf: str) -> DataFrame:
    return features.category_behavior(history(spark, sf))


@query
def d16_time_behavior(spark: SparkSession, sf: str) -> DataFrame:
    return features.time_behavior(history(spark, sf))


@query
def d17_conversion_chain(spark: SparkSession, sf: str) -> DataFrame:
    return features.conversion_chain(features.item_behavior(history(spark, sf)))


@query
def d18_window_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return window_table(spark, EVENT_WINDOWS)


@query
def d21_wide_table(spark: SparkSession, sf: str) -> DataFrame:
    return wide_rows(spark, sf)


@query
def d22_wide_quality(spark: SparkSession, sf: str) -> DataFrame:
    found = wide.wide_quality(wide_rows(spark, sf))
    broken = sum((F.col(n) for n in wide.quality_rules()), F.lit(0))
    nulls = sum((F.col(f"null_{c}") for c in wide.WIDE_COLUMNS if c not in wide.RATIOS), F.lit(0))
    return found.select("rows", broken.cast("long").alias("broken_rules"), nulls.cast("long").alias("unexpected_nulls"), *(f"null_{c}" for c in wide.RATIOS))


@query
def d22_broken_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The rules on a wide table with planted faults, one row a rule that is broken."""
    faults = {
        "item_total_count": F.when(F.col("user_id") % 10 == 3, -F.col("item_total_count")).otherwise(F.col("item_total_count")),
        "last_behavior_hour": F.when(F.col("item_id") % 11 == 0, 25).otherwise(F.col("last_behavior_hour")),
        "buy_per_pv": F.when(F.col("user_id") % 7 == 0, float("inf")).otherwise(F.col("buy_per_pv")),
        "user_active_day_ratio": F.when(F.col("user_id") % 13 == 0, 1.5).otherwise(F.col("user_active_day_ratio")),
        "last_behavior_type": F.when(F.col("item_id") % 17 == 0, "other").otherwise(F.col("last_behavior_type")),
        "item_buy_count_rank": F.when(F.col("item_id") % 19 == 0, 0).otherwise(F.col("item_buy_count_rank")),
    }
    one = wide.wide_quality(wide_rows(spark, sf).withColumns(faults))
    names = list(wide.quality_rules())
    rows = one.select(F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.col(n).alias("rows")) for n in names))).alias("r")).select("r.*")
    return rows.where("rows > 0")


# ---- descriptive statistics ----


@query
def e1_behavior_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return eda.behavior_distribution(clean(spark, sf))


@query
def e2_user_purchase_summary(spark: SparkSession, sf: str) -> DataFrame:
    return eda.user_purchase_summary(clean(spark, sf))


@query
def e3_item_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return eda.item_statistics(clean(spark, sf))


@query
def e4_top_items(spark: SparkSession, sf: str) -> DataFrame:
    return eda.top_items(clean(spark, sf))


@query
def e5_category_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return eda.category_statistics(clean(spark, sf))


@query
def e6_top_categories(spark: SparkSession, sf: str) -> DataFrame:
    return eda.top_categories(clean(spark, sf))


@query
def e7_daily_behavior(spark: SparkSession, sf: str) -> DataFrame:
    return eda.daily_behavior(clean(spark, sf))


@query
def e8_hourly_behavior(spark: SparkSession, sf: str) -> DataFrame:
    return eda.hourly_behavior(clean(spark, sf))


@query
def e9_descriptive_funnel(spark: SparkSession, sf: str) -> DataFrame:
    return eda.descriptive_funnel(clean(spark, sf))


@query
def p12_daily_long(spark: SparkSession, sf: str) -> DataFrame:
    return eda.long_counts(eda.daily_behavior(clean(spark, sf)), "behavior_date")


@query
def b1_activity_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(dashboard.activity_summary(dashboard.of_split(features.user_activity(history(spark, sf)), "train")))


@query
def b2_depth_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(dashboard.depth_summary(dashboard.of_split(features.user_activity(history(spark, sf)), "train")))


@query
def b3_popularity_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(dashboard.popularity_summary(dashboard.of_split(d14_item_popularity(spark, sf), "train")))


@query
def b3_popular_items(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(dashboard.popular_items(dashboard.of_split(d14_item_popularity(spark, sf), "train")))


@query
def b4_traffic_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(dashboard.traffic_summary(dashboard.of_split(d15_category_behavior(spark, sf), "train")))


@query
def b5_conversion_funnel(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(dashboard.conversion_funnel(dashboard.of_split(d17_conversion_chain(spark, sf), "train")))


@query
def b6_transitions(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(dashboard.transitions(dashboard.of_split(d12_user_sequence(spark, sf), "train")))


@query
def b8_available_splits(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.available_splits(d9_user_basic(spark, sf))


@query
def s8_feature_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.inventory(tables(spark, sf))


# ---- labels, preprocessing, screening, balance ----


@query
def l1_purchase_labels(spark: SparkSession, sf: str) -> DataFrame:
    return labeled(spark, sf).select("dataset_split", "user_id", "item_id", "label_date", "label")


@query
def l1_label_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(labels.label_summary(labeled(spark, sf)))


@query
def l2_time_ordered_splits(spark: SparkSession, sf: str) -> DataFrame:
    parts = labels.time_ordered_splits(labeled(spark, sf))
    rows = [d.agg(F.count("*").alias("rows"), F.sum(F.col("label").cast("long")).alias("positives")).select(F.lit(s).alias("dataset_split"), "rows", "positives") for s, d in parts.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def pp2_fitted_moments(spark: SparkSession, sf: str) -> DataFrame:
    one = preprocess.moments(train_rows(spark, sf), list(NUMERIC))
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"{c}__n").alias("valid"), F.col(f"{c}__mean").alias("mean"), F.sqrt(F.col(f"{c}__var") * F.col(f"{c}__n") / F.col("n_rows")).alias("scale")) for c in NUMERIC]
    return rounded(one.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))


@query
def pp4_preprocessed(spark: SparkSession, sf: str) -> DataFrame:
    rows = labeled(spark, sf).select("dataset_split", "user_id", "item_id", "category_id", "label", *NUMERIC, *CATEGORICAL)
    rules = preprocess.fit_rules(rows.where("dataset_split = 'train'"))
    out = preprocess.apply_rules(rows.where("dataset_split = 'validation'"), rules)
    return out.select("user_id", "item_id", "label", *(F.round(F.col(c).cast("double"), 3).alias(c) for c in NUMERIC), *(f"{c}_code" for c in CATEGORICAL))


@query
def fs1_column_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(screening.column_statistics(train_rows(spark, sf), list(NUMERIC)))


@query
def fs1_correlations(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(screening.correlations(train_rows(spark, sf), list(NUMERIC)), 5)


@query
def fs2_selected_features(spark: SparkSession, sf: str) -> DataFrame:
    found = screening.screen(train_rows(spark, sf), list(NUMERIC))
    rows = [(c, c in found.selected, ";".join(x.split(":abs=")[0] for x in found.removed.get(c, []))) for c in NUMERIC]
    return spark.createDataFrame(rows, "feature string, selected boolean, reasons string")


@query
def ci2_smote(spark: SparkSession, sf: str) -> DataFrame:
    rows = train_rows(spark, sf).select("user_id", "item_id", "category_id", "label", F.col("user_event_count").cast("double").alias("user_event_count"), F.col("item_total_count").cast("double").alias("item_total_count"))
    made = imbalance.oversampled(rows, ["user_event_count", "item_total_count"])
    return made.groupBy("label", "is_synthetic").agg(F.count("*").alias("rows"), F.count_if(F.col("user_id") == -1).alias("without_ids"))


@query
def ci3_undersampled(spark: SparkSession, sf: str) -> DataFrame:
    return imbalance.undersampled(train_rows(spark, sf).select("user_id", "item_id", "category_id", "label"))


@query
def ci4_class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(imbalance.class_weights(train_rows(spark, sf)))


# ---- evaluation ----


@query
def ev1_ranking_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.ranking_metrics(scored(spark, sf)))


@query
def ev6_confusion(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.confusion(scored(spark, sf), 0.8))


@query
def ev7_threshold_grid(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.threshold_grid(scored(spark, sf)))


@query
def ev8_curve_points(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.curve_points(scored(spark, sf)))


@query
def ix4_best_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.best_threshold(metrics.threshold_grid(scored(spark, sf))))


@query
def ix5_worst_errors(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.worst_errors(scored(spark, sf).drop("user_event_count", "item_total_count"), 0.5, 25))


@query
def ix5_error_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.error_summary(scored(spark, sf), 0.5))


@query
def ix6_segments(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(metrics.segment_metrics(scored(spark, sf), 0.5))


# ---- models: no SQL can express them; tests hold them against properties ----


MODEL_FEATURES = ("user_event_count", "user_buy_count", "item_total_count", "item_buy_count", "last_behavior_days_ago")


def model_rows(rows: DataFrame, split: str) -> DataFrame:
    """Of labelled rows."""
    return rows.where(F.col("dataset_split") == split).select("user_id", "item_id", "category_id", F.col("label").cast("int").alias("label"), *(F.col(c).cast("double").alias(c) for c in MODEL_FEATURES))


def _model_query(model: str, params: dict) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        from ..operators import models

        rows, names = labeled(spark, sf), list(MODEL_FEATURES)
        train = models.load_matrix(model_rows(rows, "train"), names).persist()
        try:
            fitted = models.fit(models.training_set(train, names, "class_weight"), names, model, params)
        finally:
            train.unpersist()
        return models.predictions(fitted, model_rows(rows, "validation"), f"class_weight__{model}", "validation")

    return run


QUERIES["m2_logistic_regression"] = _model_query("logistic_regression", {})
QUERIES["m3_random_forest"] = _model_query("random_forest", {"trees": 20})
QUERIES["m4_boosted_trees"] = _model_query("xgboost", {"trees": 10})


@query
def m13_folds(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import models

    parted = models.folds(train_rows(spark, sf).select("user_id", "item_id", "category_id", "label"))
    return parted.groupBy("fold", "label").agg(F.count("*").alias("rows"), F.sum("user_id").alias("user_ids"))


@query
def f10_chance(spark: SparkSession, sf: str) -> DataFrame:
    users = events_table(spark, sf).select("user_id").distinct()
    return users.select("user_id", F.round(chance(F.lit(42), F.col("user_id")), 9).alias("drawn"))


# ---- files and tables ----


def written_log(spark: SparkSession, sf: str, *, valid: bool) -> str:
    """The path of the raw log (its valid rows) as CSV files."""
    rows = raw(spark, sf).where("behavior_type <> '9'") if valid else raw(spark, sf)
    path = shared_path(spark, "log")
    files.write_csv(rows.select(*RAW_COLUMNS), path)
    return path


@query
def s2_text_log(spark: SparkSession, sf: str) -> DataFrame:
    return files.read_log_text(spark, written_log(spark, sf, valid=False)).drop("source_order")


@query
def s3_typed_parquet(spark: SparkSession, sf: str) -> DataFrame:
    target = shared_path(spark, "typed")
    files.csv_to_parquet(spark, written_log(spark, sf, valid=True), target)
    return spark.read.parquet(target)


@query
def s5_split_read(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "splits")
    labels.write_splits(labeled(spark, sf), path)
    return files.read_columns(spark, path, ["user_id", "item_id", "last_behavior_date", "label"], "validation")


@query
def s14_json_report(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{shared_path(spark, 'report')}.json"
    files.write_json(spark, {r.stage: r.behavior_count for r in eda.descriptive_funnel(clean(spark, sf)).collect()}, path)  # four stages
    return spark.createDataFrame(list(files.read_json(spark, path).items()), "stage string, behavior_count long")


@query
def s18_behavior_table(spark: SparkSession, sf: str) -> DataFrame:
    """A catalog table with two appended parts; it is dropped again, so its rows are stored first."""
    name = f"behavior_{uuid.uuid4().hex}"
    files.create_behavior_table(spark, name)
    try:
        rows = raw(spark, sf).where("behavior_type <> '9'")
        typed = rows.select("time", *(F.col(c).cast("bigint").alias(c) for c in RAW_COLUMNS[1:4]), F.col("behavior_type").cast("tinyint").alias("behavior_type"))
        for part in ("behavior_type = 4", "behavior_type <> 4"):
            files.append_behavior(typed.where(part), name)
        return stored(spark.table(name), "behavior")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


# ---- checks on planted faults ----


@query
def v6_broken_clean_rows(spark: SparkSession, sf: str) -> DataFrame:
    faults = {
        "behavior_date": F.when(F.col("user_id") % 7 == 0, "2024-02-30").otherwise(F.col("behavior_date")),
        "behavior_hour": F.when(F.col("item_id") % 5 == 0, (F.col("behavior_hour") + 1) % 24).otherwise(F.col("behavior_hour")),
        "weekday": F.when(F.col("user_id") % 11 == 0, (F.col("weekday") + 1) % 7).otherwise(F.col("weekday")),
        "behavior_name": F.when(F.col("item_id") % 13 == 0, None).otherwise(F.col("behavior_name")),
        "category_id": F.when(F.col("user_id") % 17 == 0, None).otherwise(F.col("category_id")),
    }
    return violations(clean(spark, sf).withColumns(faults), {f"bad_{k}": r for k, r in clean_rules().items()})


@query
def v8_wrong_windows(spark: SparkSession, sf: str) -> DataFrame:
    moved = F.when((F.col("dataset_split") == "validation") & (F.col("user_id") % 5 == 0), F.date_add("history_start", 1)).otherwise(F.col("history_start"))
    rows = features.user_basic(history(spark, sf)).where("dataset_split <> 'test'").withColumn("history_start", moved)
    return wide.window_disagreements(rows, EVENT_WINDOWS)


@query
def v10_disagreements(spark: SparkSession, sf: str) -> DataFrame:
    rows = history(spark, sf)
    other = features.user_activity(rows).withColumn("event_count", F.col("event_count") + (F.col("user_id") % 9 == 0).cast("int")).withColumn("label_date", F.when(F.col("user_id") % 4 != 0, F.col("label_date")))
    return wide.disagreements(features.user_basic(rows), other, ["dataset_split", "user_id"], ["event_count", *features.WINDOW])


@query
def j5_uncovered_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of user and item that were put in the cart but not bought (left), and the other way round (right)."""
    rows = history(spark, sf)
    of = lambda name: rows.where(F.col("behavior_name") == name).select(*key).distinct()
    key = ["dataset_split", "user_id", "item_id"]
    return wide.uncovered(of("cart"), of("buy"), key)


@query
def v12_gate_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """What the gate lets pass: rows, and the nulls that are allowed."""
    rows = stored(wide_rows(spark, sf), "wide")
    anchor = features.user_sequence(history(spark, sf)).count()
    found = wide.wide_gate(rows, anchor)
    return spark.createDataFrame([(k, v) for k, v in found.items() if v], "metric string, value long")


@query
def pp1_feature_roles(spark: SparkSession, sf: str) -> DataFrame:
    numeric, categorical, dropped = preprocess.feature_roles(wide.wide_table(tables(spark, sf)).schema)
    rows = [(c, r) for r, names in (("numeric", numeric), ("categorical", categorical), ("dropped", dropped)) for c in names]
    return spark.createDataFrame(rows, "field string, role string")


# ---- stages over all splits ----


@query
def d8_intermediate_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return dashboard.inventory(features.intermediate_tables(clean(spark, sf), EVENT_WINDOWS))


@query
def b7_funnel_of_splits(spark: SparkSession, sf: str) -> DataFrame:
    """By way of CSV files, as dashboards read them."""
    made = tables(spark, sf)
    whole = dashboard.with_splits({w.dataset_split: dashboard.summaries(made, w.dataset_split) for w in EVENT_WINDOWS})["funnel"]
    (path,) = files.write_tables({"funnel": whole}, shared_path(spark, "dashboard"), kind="csv")
    return rounded(spark.read.schema(whole.schema).option("header", True).csv(path))


@query
def b9_split_frame(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(dashboard.split_frame(labels.label_summary(labeled(spark, sf))))


@query
def b10_threshold_view(spark: SparkSession, sf: str) -> DataFrame:
    grid = metrics.threshold_grid(scored(spark, sf)).withColumn("candidate", F.lit("made"))
    return rounded(dashboard.threshold_view(grid.unionByName(grid.withColumn("candidate", F.lit("other"))), "made"))


@query
def o9_transitions_of_first(spark: SparkSession, sf: str) -> DataFrame:
    """The limit is the operator's own: a quick view of the first 500 sequences."""
    return rounded(dashboard.transitions(dashboard.of_split(d12_user_sequence(spark, sf), "train"), most=500))


@query
def pp5_applied_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rules fitted on training rows, applied to all splits: rows out, filled values and unseen categories."""
    rows = labeled(spark, sf).select("dataset_split", "user_id", "item_id", "category_id", "label", *NUMERIC, "last_behavior_type", F.concat_ws("-", "last_behavior_type", "last_behavior_hour").alias("type_hour"))
    rules, out = preprocess.preprocess({w.dataset_split: rows.where(F.col("dataset_split") == w.dataset_split) for w in EVENT_WINDOWS})
    counted = None
    for split, made in out.items():
        seen = preprocess.applied_counts(rows.where(F.col("dataset_split") == split), rules)
        one = made.agg(F.count("*").alias("rows_out"), F.count_if(F.col("type_hour_code") == preprocess.UNSEEN).alias("unseen_codes")).crossJoin(seen).select(F.lit(split).alias("dataset_split"), "*")  # one row each
        counted = one if counted is None else counted.unionByName(one)
    return counted


@query
def f21_raw_values(spark: SparkSession, sf: str) -> DataFrame:
    """Standardised and turned back; the floats between have about seven digits."""
    names = ["user_event_count", "item_total_count", "time_total_count"]
    rows = labeled(spark, sf).select("dataset_split", "user_id", "item_id", "category_id", "label", *names)
    rules = preprocess.fit_rules(rows.where("dataset_split = 'train'"))
    back = explain.raw_values(preprocess.apply_rules(rows.where("dataset_split = 'test'"), rules), rules.numeric, names)
    return back.select("user_id", "item_id", *(F.round(c).cast("long").alias(c) for c in names))


@query
def in3_frozen_features(spark: SparkSession, sf: str) -> DataFrame:
    """Test rows from a Parquet file through the frozen contract, without a model."""
    rows = labeled(spark, sf).select("dataset_split", "user_id", "item_id", "category_id", "label", *NUMERIC, *CATEGORICAL)
    rules = preprocess.fit_rules(rows.where("dataset_split = 'train'"))
    names = [*NUMERIC, *(f"{c}_code" for c in CATEGORICAL)]
    frozen = inference.InferenceContract.checked({"candidate": "a", "validation_leader": "a", "features": names, "threshold": 0.5}, rules)
    path = f"{shared_path(spark, 'inference')}.parquet"
    rows.where("dataset_split = 'test'").drop("dataset_split", "label").write.parquet(path)
    out = inference.transform_features(inference.read_input(spark, path, frozen), frozen)
    return out.select("user_id", "item_id", "category_id", *(F.round(F.col(c).cast("double"), 3).alias(c) for c in NUMERIC), *(f"{c}_code" for c in CATEGORICAL))


@query
def ci2_synthetic_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = imbalance.synthetic_positives(smote_rows(spark, sf), list(SMOTE_FEATURES))
    return rows.select("label", "is_synthetic", "user_id", *(F.round(c, 6).alias(c) for c in SMOTE_FEATURES[:2]), "last_code")


@query
def ci5_variant_statistics(spark: SparkSession, sf: str) -> DataFrame:
    made = imbalance.variants(smote_rows(spark, sf), list(SMOTE_FEATURES))
    parts = [imbalance.class_statistics(d).select(F.lit(s).alias("strategy"), "*") for s, d in made.items()]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]))


@query
def ix2_explanation_sample(spark: SparkSession, sf: str) -> DataFrame:
    """500 rows, which is the operator's own limit, in which all positives are."""
    return explain.explanation_sample(scored(spark, sf), 500).select("user_id", "item_id", "label")


def made_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """Measures of made-up candidates, with ties in the first."""
    from ..operators import models

    at = lambda names, c: F.element_at(F.array(*map(F.lit, names)), (F.col(c) % 4 + 1).cast("int"))
    named = clean(spark, sf).select(at(models.STRATEGIES, "user_id").alias("strategy"), at(models.MODELS, "item_id").alias("model"), "behavior_hour", "weekday", "behavior_type")
    return named.groupBy("strategy", "model").agg((F.sum("behavior_hour") % 3 / 4).alias("roc_auc"), (F.sum("weekday") % 5 / 8).alias("average_precision"), (F.sum("behavior_type") % 7 / 8).alias("log_loss"))


@query
def m11_candidate_ranks(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import models

    return models.ranked(made_comparison(spark, sf))


@query
def m12_base_models(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import models

    return models.distinct_families(made_comparison(spark, sf))


@query
def m9_merged_comparisons(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs; the later one has some of the candidates again."""
    from ..operators import runs

    whole = made_comparison(spark, sf)
    again = whole.where("model in ('xgboost', 'lightgbm')").withColumn("roc_auc", F.col("roc_auc") + 0.125)
    folders = [shared_path(spark, "run") for _ in range(2)]
    for path, rows in zip(folders, (whole, again)):
        rows.write.parquet(f"{path}/comparison")
    return runs.comparisons(spark, folders)


@query
def j12_improvement(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators import runs

    whole = made_comparison(spark, sf)
    return runs.improvement(whole.where("strategy <> 'smote'").withColumn("log_loss", F.col("log_loss") / 2), whole)
