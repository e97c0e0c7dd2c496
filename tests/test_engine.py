"""Hand-made rows with known answers, contract errors, leakage, balance, models and inference."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoplark.cli import main
from shoplark.contracts import CLEAN_COLUMNS, RAW_COLUMNS, ContractError, check_windows, need_features, windows_of
from shoplark.functions import ordering
from shoplark.operators import cleaning, dashboard, eda, explain, features, imbalance, inference, labels, metrics, models, preprocess, quality, runs, screening, wide
from shoplark.plans.windows import in_windows
from shoplark.sources import files
from shoplark.streaming.cleaning import clean_stream

TEXT = ", ".join(f"{c} string" for c in RAW_COLUMNS) + ", source_order long"


def raw(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], TEXT)


def test_rejections_are_in_order_and_exclusive(spark):
    rows = [
        ("2025-11-18 09", "1", "10", "3001", "1"),
        ("2025-11-18 9", " 007 ", "1e3", "1.0", "4"),
        ("bad", "1", "10", "1", "1"),
        ("2025-02-30 01", "1", "10", "1", "1"),
        ("2025-11-18 24", "1", "10", "1", "1"),
        ("bad", "-1", "10", "1", "9"),
        ("2025-11-18 09", "1", "10", "1", "9"),
        ("2025-11-18 09", "1", "", "1", "9"),
        ("2025-11-18 09", None, "10", "1", "1"),
        ("2025-11-18 09", "1.5", "10", "1", "1"),
        ("2025-11-18 09", "9223372036854775807", "10", "1", "2"),
    ]
    counts = cleaning.rejected_counts(raw(spark, rows)).first().asDict()
    assert counts == {"input_rows": 11, "removed_missing_rows": 2, "removed_invalid_id_rows": 2, "removed_invalid_behavior_rows": 1, "removed_invalid_time_rows": 3, "kept_rows": 3}
    kept = {r.source_order: r for r in cleaning.clean_rows(raw(spark, rows)).collect()}
    assert (kept[1].time, kept[1].user_id, kept[1].item_id, kept[1].category_id, kept[1].behavior_name, kept[1].behavior_hour, kept[1].weekday) == ("2025-11-18 09", 7, 1000, 1, "buy", 9, 1)
    assert kept[10].user_id == 2**63 - 1
    assert cleaning.contract_columns(cleaning.clean_rows(raw(spark, rows))).columns == list(CLEAN_COLUMNS)


def test_repeats_at_the_threshold(spark):
    rows = []
    for user, n in ((1, 2), (2, 59), (3, 60), (4, 61)):
        rows += [("2025-11-18 09", str(user), "10", "7001" if user == 3 else "8001" if k == 0 else "9999", "1") for k in range(n)]
    clean = cleaning.clean_rows(raw(spark, rows).repartition(3))
    kept = cleaning.limit_repeats(clean)
    assert {r.user_id: r["count"] for r in kept.groupBy("user_id").count().collect()} == {1: 2, 2: 59, 3: 1, 4: 1}
    assert {r.user_id: r.category_id for r in kept.where("user_id > 2").collect()} == {3: 7001, 4: 8001}
    assert tuple(cleaning.repeat_report(clean).first()) == (2, 61, 2, 121, 119)


def test_quality_report(spark):
    ok = ("2025-11-18 09", "1", "10", "3001", "1")
    rows = [ok, ok, ("2025-11-18 09", "1", "10", "3002", "1"), ("2025-11-18 09", "1", "", "3001", "1"), ("2025-11-18 09", "-1", "10", "3001", "1"), ("2025-11-18 09", "2", "10", "3001", "9"), ("bad", "3", "10", "3001", "1")]
    r = quality.quality_report(raw(spark, rows)).first()
    assert (r.row_count, r.missing_item_id, r.invalid_user_id, r.invalid_behavior_type, r.invalid_time) == (7, 1, 1, 1, 1)
    assert (r.exact_groups, r.exact_records, r.exact_excess, r.suspected_groups, r.suspected_records, r.suspected_excess, r.status) == (1, 2, 1, 1, 3, 2, "REVIEW")
    assert quality.quality_report(raw(spark, [ok, ("2025-11-18 10", "2", "10", "3001", "4")])).first().status == "PASS"


WINDOWS = windows_of(("train", "2025-11-18", "2025-12-07", "2025-12-08"), ("validation", "2025-12-09", "2025-12-14", "2025-12-15"), ("test", "2025-12-16", "2025-12-17", "2025-12-18"))
EVENTS = [
    ("2025-11-17 10", "1", "10", "100", "1"),
    ("2025-11-18 09", "1", "10", "100", "1"),
    ("2025-12-07 22", "1", "10", "100", "3"),
    ("2025-12-01 10", "2", "20", "200", "4"),
    ("2025-12-08 10", "1", "10", "100", "4"),
    ("2025-12-09 10", "1", "10", "100", "1"),
    ("2025-12-14 10", "3", "20", "200", "2"),
    ("2025-12-15 10", "3", "20", "200", "4"),
    ("2025-12-16 10", "1", "10", "100", "1"),
    ("2025-12-17 23", "2", "20", "200", "4"),
    ("2025-12-18 01", "2", "20", "200", "4"),
]


def test_features_wide_table_and_labels(spark):
    clean = cleaning.clean_rows(raw(spark, EVENTS))
    tables = {k: t.persist() for k, t in features.feature_tables(clean, WINDOWS).items()}
    wide.check_wide_inputs(tables, WINDOWS)
    table = wide.wide_table(tables).persist()
    assert table.count() == 6 and len(table.columns) == 64
    wide.wide_gate(table, 6)
    r = table.where("dataset_split = 'train' and user_id = 1").first()
    assert (r.category_id, str(r.last_behavior_date), r.last_behavior_hour, r.time_total_count, r.last_behavior_type, r.last_10_behavior_sequence) == (100, "2025-12-07", 22, 1, "cart", "pv→cart")
    assert (r.user_event_count, r.user_window_days, r.buy_per_pv, r.buy_per_fav) == (2, 20, 0.0, None)
    got = {(x.dataset_split, x.user_id): x.label for x in labels.purchase_labels(table, clean).collect()}
    assert got == {("train", 1): 1, ("train", 2): 0, ("validation", 1): 0, ("validation", 3): 1, ("test", 1): 0, ("test", 2): 1}
    changed = cleaning.clean_rows(raw(spark, [e if not e[0].startswith(("2025-12-08", "2025-12-15", "2025-12-18")) else (e[0], e[1], e[2], e[3], "1") for e in EVENTS]))
    same = wide.wide_table(features.feature_tables(changed, WINDOWS))
    assert same.exceptAll(table).isEmpty() and table.exceptAll(same).isEmpty()
    broken = dict(tables, category_behavior=tables["category_behavior"].withColumn("history_end", F.date_add("history_end", 1)))
    with pytest.raises(ContractError, match="inconsistent history_end"):
        wide.check_wide_inputs(broken)
    with pytest.raises(ContractError, match="category_behavior: .*of another window"):
        wide.check_wide_inputs(broken, WINDOWS)
    with pytest.raises(ContractError, match="test: 0 rows"):
        wide.need_windows(tables["user_basic"].where("dataset_split <> 'test'"), WINDOWS, "user_basic")
    with pytest.raises(ContractError):
        wide.wide_gate(table, 7)


def test_window_and_feature_contracts(spark):
    with pytest.raises(ContractError):
        check_windows(windows_of(("a", "2025-01-02", "2025-01-01", "2025-01-03")))
    with pytest.raises(ContractError):
        check_windows(windows_of(("a", "2025-01-01", "2025-01-05", "2025-01-06"), ("b", "2025-01-06", "2025-01-07", "2025-01-08")), apart=True)
    for bad in ([], ["a", "a"], ["label"], [""]):
        with pytest.raises(ContractError):
            need_features(bad)
    history = in_windows(cleaning.clean_rows(raw(spark, [("2025-12-01 10", "1", "5", "1", "1"), ("2025-12-01 11", "1", "5", "2", "1")])), WINDOWS)
    with pytest.raises(ContractError, match="category_id"):
        features.need_one_category(history)


def test_preprocessing_rules(spark):
    schema = "user_id long, item_id long, category_id long, x double, constant double, name string, label int"
    train = spark.createDataFrame([(1, 1, 1, 1.0, 5.0, "pv", 0), (2, 1, 1, 3.0, 5.0, None, 1), (3, 1, 1, None, 5.0, "cart", 0)], schema)
    other = spark.createDataFrame([(4, 1, 1, float("nan"), 6.0, "buy", 0), (5, 1, 1, float("inf"), None, None, 0)], schema)
    rules, out = preprocess.preprocess({"train": train, "validation": other})
    assert rules.numeric["x"]["mean"] == 2.0 and abs(rules.numeric["x"]["scale"] - (2 / 3) ** 0.5) < 1e-12 and rules.numeric["constant"]["scale"] == 1.0
    assert preprocess.Rules.from_json(rules.to_json()) == rules
    got = {r.user_id: (r.x, r.constant, r.name_code) for r in out["validation"].collect()}
    assert got == {4: (0.0, 1.0, -1), 5: (0.0, 0.0, 0)}
    counts = preprocess.applied_counts(other, rules).first()
    assert (counts.filled_x, counts.filled_constant, counts.unseen_name) == (2, 1, 1)


def test_screening(spark):
    rows = [(i, i % 2, float(i * i % 7), float(i * i % 7) * 2, 1.0, float(i), float("inf") if i == 1 else 1.0 * i, 100.0 if i == 3 else float(-i % 3)) for i in range(8)]
    df = spark.createDataFrame(rows, "user_id long, label int, strong double, duplicate double, constant double, future_signal double, nonfinite double, outlier double")
    found = screening.screen(df)
    assert found.selected == ["strong", "outlier"] and found.outliers["outlier"] == 1
    assert found.removed["duplicate"] == ["high_correlation_with:strong:abs=1.000000"]
    assert found.removed["constant"] == ["low_variance"] and found.removed["nonfinite"] == ["nonfinite_values_in_training"] and found.removed["future_signal"][0].startswith("suspected_future")


def train_frame(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, i % 17, 1, int(y), float(y * 1.5 + rng.normal()), float(rng.normal()), int(rng.integers(0, 3))) for i, y in enumerate(rng.random(n) < 0.15)]
    return spark.createDataFrame(rows, "user_id long, item_id long, category_id long, label int, a double, b double, kind_code int")


def test_balance_variants(spark):
    train, names = train_frame(spark), ["a", "b", "kind_code"]
    positives, negatives = imbalance.check_balance(train)
    made = imbalance.oversampled(train, names).persist()
    s = imbalance.class_statistics(made).first()
    assert s.positive_count == s.negative_count == negatives
    new = made.where("is_synthetic").toPandas()
    old = train.where("label = 1").toPandas()
    assert (new.user_id == -1).all() and (new.label == 1).all() and set(new.kind_code) <= set(old.kind_code)
    assert new.a.min() >= old.a.min() and new.a.max() <= old.a.max() and new.a.nunique() > positives
    assert imbalance.oversampled(train.repartition(5), names).exceptAll(made).isEmpty()
    few = imbalance.undersampled(train)
    assert imbalance.class_statistics(few).first().sample_count == 2 * positives
    weights = {r.label: r.weight for r in imbalance.class_weights(spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "label int")).collect()}
    assert abs(weights[0] - 2 / 3) < 1e-12 and weights[1] == 2.0
    near = imbalance.nearest_positives(train.where("label = 1").withColumn("n", F.col("user_id")), names, k=3, block=20).groupBy("n").count().collect()
    assert {r["count"] for r in near} == {3}
    with pytest.raises(ContractError):
        imbalance.undersampled(train.where("label = 0").union(train.where("label = 1").limit(1)))


@pytest.mark.parametrize("tied", [False, True])
def test_neighbours_are_exact_over_many_blocks(spark, tied):
    rng = np.random.default_rng(7)
    x = rng.integers(0, 4, (230, 2)).astype(float) if tied else rng.normal(size=(230, 3)) * [1, 30, 5]
    if tied:
        x[:150] = 0
    names = list("abc"[: x.shape[1]])
    rows = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["n", *names])
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    want = {(i, r, int(j)) for i in range(len(x)) for r, j in enumerate(np.argsort(d[i], kind="stable")[:5])}
    for block in (20, 1000):
        got = imbalance.nearest_positives(rows, names, block=block).collect()
        assert {(r.n, r.rank, r.neighbour) for r in got} == want and len(got) == len(want)


def test_no_synthetic_row_is_lost(spark, monkeypatch):
    train, names = train_frame(spark), ["a", "b", "kind_code"]
    near = imbalance.nearest_positives
    monkeypatch.setattr(imbalance, "nearest_positives", lambda *a, **o: near(*a, **o | {"block": 4}))
    s = imbalance.class_statistics(imbalance.oversampled(train, names)).first()
    assert s.positive_count == s.negative_count
    monkeypatch.setattr(imbalance, "nearest_positives", lambda *a, **o: near(*a, **o).where("rank < 2"))
    with pytest.raises(Exception, match="fewer neighbours"):
        imbalance.oversampled(train, names).collect()


def test_metrics_against_definitions(spark):
    rng = np.random.default_rng(1)
    y, p = rng.integers(0, 2, 300), np.round(rng.random(300), 1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "label int, score double")
    r = metrics.ranking_metrics(df).first()
    pairs = [(1.0 if a > b else 0.5 if a == b else 0.0) for a in p[y == 1] for b in p[y == 0]]
    assert abs(r.roc_auc - np.mean(pairs)) < 1e-9
    order = sorted(set(p), reverse=True)
    ap = sum(((p == t) & (y == 1)).sum() / y.sum() * (y[p >= t] == 1).mean() for t in order)
    assert abs(r.average_precision - ap) < 1e-9
    grid = {round(x.threshold, 2): x for x in metrics.threshold_grid(df).collect()}
    assert len(grid) == 19 and grid[0.5].tp == int(((p >= 0.5) & (y == 1)).sum()) and grid[0.95].fn == int(((p < 0.95) & (y == 1)).sum())
    assert metrics.confusion(df.where("label = 0"), 2.0).first().precision == 0.0


def test_skewed_scores_fall_into_even_ranges(spark):
    rng = np.random.default_rng(2)
    p = np.concatenate([rng.random(4000) ** 9 * 1e-3, rng.random(50), np.full(900, 0.25)])
    y = (rng.random(len(p)) < 0.1 + 0.5 * (p > 1e-4)).astype(int)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "label int, score double").persist()
    sizes = df.where("score <> 0.25").withColumn("range", metrics.score_range(df)).groupBy("range").agg(F.count_distinct("score").alias("n"), F.min("score").alias("low"), F.max("score").alias("high")).orderBy("range").collect()
    assert max(r.n for r in sizes) < 30 and all(a.high < b.low for a, b in zip(sizes, sizes[1:]))
    for r in metrics.curve(df).collect():
        assert (r.tp, r.fp) == (int(((p >= r.score) & (y == 1)).sum()), int(((p >= r.score) & (y == 0)).sum()))
    assert metrics.curve(df.where("score > 2")).collect() == []


@pytest.mark.parametrize("n", [0, 1, 40, 900, 5000])
def test_the_first_by_digest_are_those_of_a_sort(spark, n):
    order = ordering.chance_order(F.lit(7), F.col("id"))
    df = spark.range(5000)
    want = {r.id for r in df.orderBy(order).limit(n).collect()}
    assert {r.id for r in ordering.first_of(df, order, n, 5000).collect()} == want


def test_the_first_by_digest_of_repeated_rows(spark):
    """All have one digest that no low bound lets through."""
    df = spark.range(3000).select(F.lit(5).alias("id"))
    order = ordering.chance_order(F.lit(1), F.col("id"))
    assert df.select(order.alias("o")).first().o > "1"
    assert ordering.first_of(df, order, 10, 3000).count() == 10


def test_models_stack_attributions_and_inference(spark, tmp_path):
    train, names = train_frame(spark).persist(), ["a", "b", "kind_code"]
    validation = train_frame(spark, 200, 9)
    few = {"trees": 5, "depth": 3}
    pool = [models.Candidate("baseline", "logistic_regression"), models.Candidate("class_weight", "xgboost", tuple(few.items()))]
    fitted, comparison = models.train_matrix(train, validation, names, pool)
    rows = comparison.collect()
    assert [r.candidate_rank for r in rows] == [1, 2] and min(r.roc_auc for r in rows) > 0.7
    assert models.Candidate.parse("smote__random_forest").model == "random_forest"
    assert models.distinct_families(comparison, 1).count() == 1
    made = models.stack(train, names, pool, k=2)
    assert made.score(validation).where("score between 0 and 1").count() == 200
    boosted = models.fit(train, names, "xgboost", few)
    values = explain.attributions(boosted, validation, names).toPandas().sort_values("user_id")
    margin = boosted.transform(validation).select("user_id", models.vector_to_array("rawPrediction")[1].alias("m")).toPandas().sort_values("user_id").m.to_numpy()
    # Attributions add up to the ensemble's sum less its mean; Spark's raw prediction is once or twice that sum.
    parts = values[names].sum(axis=1).to_numpy()
    assert min(np.ptp(margin / k - parts) for k in (1, 2)) < 1e-6
    assert explain.attribution_summary(explain.attributions(boosted, validation, names), names).orderBy(F.desc("mean_abs")).first().feature == "a"
    assert explain.importances(boosted, names).first().feature == "a"
    sample = explain.explanation_sample(train, 100)
    assert sample.count() == 100 and sample.where("label = 1").count() == train.where("label = 1").count()

    rules = preprocess.fit_rules(train.select("user_id", "item_id", "category_id", "label", "a", "b"))
    path = str(tmp_path / "model")
    model = models.fit(preprocess.apply_rules(train.select("user_id", "item_id", "category_id", "label", "a", "b"), rules), ["a", "b"], "logistic_regression")
    models.save(model, path)
    manifest = {"candidate": "baseline__logistic_regression", "validation_leader": "baseline__logistic_regression", "features": ["a", "b"], "threshold": 0.5, "test_data_read": False}
    contract = inference.InferenceContract.checked(manifest, rules)
    source = str(tmp_path / "rows.parquet")
    validation.write.parquet(source)
    summary = inference.run_inference(spark, source, str(tmp_path / "out"), models.load(path), contract)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert summary["rows"] == out.count() == 200 and tuple(out.columns) == inference.OUTPUT
    assert out.where("(purchase_probability >= 0.5) <> (predicted_purchase = 1)").isEmpty()
    for key, value in (("threshold", 2), ("test_data_read", True), ("validation_leader", "x"), ("features", ["nope"])):
        with pytest.raises(ContractError):
            inference.InferenceContract.checked(manifest | {key: value}, rules)


def test_files_cli_and_stream(spark, tmp_path):
    log = tmp_path / "log.csv"
    log.write_text("﻿" + ",".join(RAW_COLUMNS) + "\n" + "\n".join(",".join(e) for e in EVENTS) + "\n", encoding="utf-8")
    out = str(tmp_path / "typed")
    assert files.csv_to_parquet(spark, str(log), out) == len(EVENTS)
    assert dict(spark.read.parquet(out).dtypes)["behavior_type"] == "tinyint"
    bad = tmp_path / "bad.csv"
    bad.write_text(",".join(RAW_COLUMNS) + "\nnope,1,1,1,1\n")
    with pytest.raises(ContractError, match="time"):
        files.csv_to_parquet(spark, str(bad), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    assert main(["clean", str(log), str(tmp_path / "clean")]) == 0
    assert main(["features", str(tmp_path / "clean"), str(tmp_path / "features")]) == 0
    assert main(["wide", str(tmp_path / "features"), str(tmp_path / "wide")]) == 0
    assert main(["labels", str(tmp_path / "wide"), str(tmp_path / "clean"), str(tmp_path / "labeled")]) == 0
    assert main(["quality", str(log), str(tmp_path / "report.json")]) == 0 and json.loads((tmp_path / "report.json").read_text())["row_count"] == len(EVENTS)
    wrong = tmp_path / "wrong.csv"
    wrong.write_text("a,b\n1,2\n")
    assert main(["quality", str(wrong), str(tmp_path / "r2.json")]) == 2
    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(2):
        (folder / f"{k}.csv").write_text(",".join(RAW_COLUMNS) + "\n" + ",".join(EVENTS[k]) + "\nbad,1,1,1,1\n")
        clean_stream(spark, str(folder), str(tmp_path / "streamed"), str(tmp_path / "state")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "streamed")).count() == k + 1


def test_funnel_without_views(spark):
    clean = cleaning.clean_rows(raw(spark, [("2025-11-18 09", "1", "10", "1", "4")]))
    assert {r.stage: r.relative_to_pv_percentage for r in eda.descriptive_funnel(clean).collect()} == {"PV": 0.0, "Favorite": 0.0, "Cart": 0.0, "Purchase": 0.0}
    assert [r.percentage for r in eda.behavior_distribution(clean.limit(0)).collect()] == [None] * 4


def test_labels_of_any_number_of_days(spark):
    from datetime import date, timedelta

    from shoplark.operators.labels import purchase_labels

    days = [date(2025, 1, 1) + timedelta(days=2 * i) for i in range(130)]
    wide = spark.createDataFrame([("train", i, 1, d - timedelta(days=1), d) for i, d in enumerate(days)], "dataset_split string, user_id long, item_id long, history_end date, label_date date")
    clean = spark.createDataFrame([(i, 1, 4, str(d)) for i, d in enumerate(days)] + [(0, 1, 4, str(days[1])), (1, 1, 1, str(days[1]))], "user_id long, item_id long, behavior_type int, behavior_date string")
    assert {r.label for r in purchase_labels(wide, clean).collect()} == {1}


def test_columns_of_many_categories_have_the_same_codes(spark):
    from shoplark.operators.preprocess import apply_rules, fit_rules

    rows = [(i, 1, 2, float(i), f"v{i * 7 % 50}" if i % 9 else None, "ab"[i % 2]) for i in range(120)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, category_id long, x double, kind string, side string").repartition(5)
    unseen = spark.createDataFrame([(900, 1, 2, None, "new", "a")], df.schema)
    few, many = fit_rules(df), fit_rules(df, most_values=10)
    assert set(many.tables) == {"kind"} and set(few.categories) == {"kind", "side"}
    both = [sorted(map(tuple, apply_rules(df.unionByName(unseen), r).collect())) for r in (few, many)]
    assert both[0] == both[1] and both[0][-1][-2:] == (-1, 0)
    assert apply_rules(df, few).columns == apply_rules(df, many).columns


def test_correlations_of_rows_that_have_both(spark):
    import numpy as np
    import pandas as pd

    from shoplark.operators.screening import correlations

    rng = np.random.default_rng(4)
    x = pd.DataFrame(rng.normal(size=(500, 6)), columns=list("abcdef"))
    x["b"] = 1e9 + x["a"] * 3
    x["c"] = 7.0
    x.loc[rng.random(500) < 0.3, "d"] = np.nan
    x.loc[rng.random(500) < 0.5, "e"] = np.nan
    x["f"] = x["d"] + x["e"]
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x.to_numpy()]
    got = {(r.feature_a, r.feature_b): r.r for r in correlations(spark.createDataFrame(rows, list("abcdef")).repartition(3), list("abcdef")).collect()}
    want = x.corr()
    for (a, b), r in got.items():
        assert abs(r - (0.0 if np.isnan(want.loc[a, b]) else want.loc[a, b])) < 1e-6
    assert len(got) == 15


def test_runs_from_training_to_inference(spark, tmp_path):
    """The commands one after another, each from the files of those before."""
    at = lambda *p: str(tmp_path.joinpath(*p))
    raw_rows = {s: train_frame(spark, n, seed) for s, n, seed in (("train", 300, 3), ("validation", 150, 9), ("test", 150, 11))}
    raw_rows = {s: d.withColumns({"user_event_count": F.col("user_id") % 4 + 1, "item_total_count": F.col("item_id") % 3 + 1}).drop("kind_code") for s, d in raw_rows.items()}
    for s, d in raw_rows.items():
        d.write.parquet(at("splits", f"dataset_split={s}"))
    assert main(["preprocess", at("splits"), at("made"), at("rules.json")]) == 0
    assert main(["select", at("made"), at("chosen")]) == 0
    assert json.loads((tmp_path / "chosen" / "features.json").read_text())["selected_features"] == ["a", "b", "user_event_count", "item_total_count"]
    assert main(["balance", at("chosen", "train"), at("balanced")]) == 0
    manifest = json.loads((tmp_path / "balanced" / "manifest.json").read_text())
    smote = manifest["training_strategy_statistics"]["smote"]
    assert smote["positive_count"] == smote["negative_count"]
    assert dashboard.imbalance_frame(spark, manifest).count() == 4
    assert main(["train", at("chosen"), at("matrix"), "--candidates", "baseline__logistic_regression,undersampled__logistic_regression"]) == 0
    assert main(["tune", at("chosen"), at("tuned"), "--candidates", "baseline__logistic_regression", "--trials", "2", "--earlier", at("matrix")]) == 0
    gained = spark.read.parquet(at("tuned", "improvement")).collect()
    assert [r.strategy for r in gained] == ["baseline"] and gained[0].roc_auc_change >= -1e-12
    both = runs.comparisons(spark, [at("matrix"), at("tuned")]).collect()
    assert [(r.candidate_rank, r.strategy) for r in both] in ([(1, "baseline"), (2, "undersampled")], [(1, "undersampled"), (2, "baseline")])
    assert main(["stack", at("chosen"), at("tuned"), at("none")]) == 2  # one family only

    train, validation = (models.load_matrix(spark.read.parquet(at("chosen", s)), ["a", "b", "user_event_count", "item_total_count"]) for s in ("train", "validation"))
    bases = [models.Candidate("baseline", "logistic_regression"), models.Candidate("class_weight", "random_forest", (("trees", 4), ("depth", 3)))]
    found = runs.run_stacking(train, validation, ["a", "b", "user_event_count", "item_total_count"], bases, at("stacked"), k=2)
    assert set(found["candidates"]) == {bases[0].name, bases[1].name, models.STACK} and found["test_data_read"] is False
    again = models.load(at("stacked", "model"))
    kept = {(r.user_id, r.item_id): r[models.STACK] for r in spark.read.parquet(at("stacked", "validation_predictions")).collect()}
    assert len(kept) == 150 and all(abs(kept[r.user_id, r.item_id] - r.score) < 1e-12 for r in again.score(validation).collect())

    assert main(["final", at("chosen"), at("stacked"), at("final")]) == 0
    assert main(["final", at("chosen"), at("stacked"), at("final")]) == 2  # test rows are read once
    measures, thresholds = spark.read.parquet(at("final", "metrics")), spark.read.parquet(at("final", "thresholds"))
    assert measures.count() == 6 and thresholds.count() == 3 * 19 and "roc_auc" in (tmp_path / "final" / "report.md").read_text()
    own = metrics.ranking_metrics(spark.read.parquet(at("final", "predictions")).select("label", F.col(models.STACK).alias("score"))).first().roc_auc
    assert dashboard.performance_view(measures, "roc_auc", "test").where(F.col("candidate") == models.STACK).first().roc_auc == own
    assert dashboard.threshold_view(thresholds, models.STACK).count() == 57

    forest = at("stacked", "model", "bases", bases[1].name)
    assert main(["explain", at("chosen", "test"), forest, at("rules.json"), at("explained")]) == 0
    assert dashboard.attribution_view(spark.read.parquet(at("explained", "attributions")), 1).first().feature == "a"
    cold = raw_rows["test"].where("user_event_count <= 1").count()
    segments = spark.read.parquet(at("explained", "segments"))
    assert {r.segment: r.sample_count for r in segments.collect()}["cold_start_user"] == cold and dashboard.segment_view(segments).count() == 15

    config = {"final_candidate": found["validation_leader"], "model_artifact": "stacked/model", "preprocessing_rules": "rules.json", "feature_list": "chosen/features.json", "selection_manifest": "stacked/manifest.json", "evaluation_summary": "final/summary.json", "prediction_threshold": 0.5}
    config |= {"model_bundle_key": found["validation_leader"]} if found["validation_leader"] != models.STACK else {}
    raw_rows["test"].write.parquet(at("input.parquet"))
    (tmp_path / "config.json").write_text(json.dumps(config))
    assert main(["infer", at("config.json"), at("input.parquet"), at("scored")]) == 0
    want = {(r.user_id, r.item_id): r[found["validation_leader"]] for r in spark.read.parquet(at("final", "predictions")).collect()}
    got = spark.read.parquet(at("scored")).collect()
    assert len(got) == 150 and all(abs(want[r.user_id, r.item_id] - r.purchase_probability) < 1e-9 for r in got)
    summary = json.loads((tmp_path / "final" / "summary.json").read_text())
    for name, change in (("selection_manifest", found | {"test_data_read": True}), ("evaluation_summary", summary | {"test_evaluation_count": 2}), ("evaluation_summary", summary | {"candidates": []}), ("selection_manifest", found | {"validation_leader": "other"})):
        (tmp_path / "changed.json").write_text(json.dumps(change))
        (tmp_path / "bad.json").write_text(json.dumps(config | {name: "changed.json"}))
        with pytest.raises(ContractError):
            inference.load_contract(spark, at("bad.json"))


def test_splits_frame_limit_and_byte_order_mark(spark, tmp_path):
    rows = spark.createDataFrame([("train", 1), ("train", 0), ("test", 0)], "dataset_split string, label int")
    frame = {r.Split: (r.Samples, r.Positives, r["Positive rate"]) for r in dashboard.split_frame(labels.label_summary(rows)).collect()}
    assert frame == {"Train": (2, 1, 0.5), "Test": (1, 0, 0.0)}
    sequences = spark.createDataFrame([(2, 1, "pv→buy"), (1, 1, "pv→cart")], "user_id long, item_id long, last_10_behavior_sequence string")
    first = dashboard.transitions(sequences, most=1).where("transition_count > 0").collect()
    assert [(r.from_behavior, r.to_behavior) for r in first] == [("pv", "cart")]
    files.write_csv(rows, str(tmp_path / "out"), one_file=True, bom=True)
    (made,) = (tmp_path / "out").glob("part-*")
    assert made.read_bytes().startswith("﻿dataset_split,label".encode())
