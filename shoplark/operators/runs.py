"""Model runs that leave files: training matrix, tuning, stacking, the one final evaluation, interpretation.

A run is a folder of models, Parquet tables and JSON. Test rows are taken by final_evaluation and interpretation only,
which fit nothing. Measures are taken from the predictions as written.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..contracts import ContractError
from ..sources import files
from ..sources.shared import forget, stored
from . import explain, metrics
from .models import SEED, STACK, Candidate, Stack, fit, load, load_matrix, need_families, out_of_fold, predictions, ranked, save, score, stack, training_set, tune
from .preprocess import Rules

THRESHOLD = 0.5


def _mode(overwrite: bool) -> str:
    return "overwrite" if overwrite else "errorifexists"


def measured(scored: DataFrame, **names: str) -> DataFrame:
    """The names and the evaluation of (label, score): one row."""
    return metrics.evaluate(scored, THRESHOLD).select(*(F.lit(v).alias(k) for k, v in names.items()), "*")


def _rows(parts: Sequence[DataFrame]) -> DataFrame:
    """One-row frames, worked out one after another, so that no plan holds them all."""
    found: list[Row] = [p.first() for p in parts]
    return parts[0].sparkSession.createDataFrame(found, parts[0].schema)


def run_matrix(train: DataFrame, validation: DataFrame, features: Sequence[str], candidates: Sequence[Candidate], out: str, *, overwrite: bool = False) -> DataFrame:
    """Writes models/, validation_predictions/ (a folder a candidate) and comparison, which is returned, best first.

    A training set is made once for all models of its strategy.
    """
    spark, parts = train.sparkSession, []
    for strategy in dict.fromkeys(c.strategy for c in candidates):
        rows = stored(training_set(train, features, strategy), "training")
        for c in (c for c in candidates if c.strategy == strategy):
            model, path = fit(rows, features, c.model, dict(c.params)), f"{out}/validation_predictions/{c.name}"
            save(model, f"{out}/models/{c.name}", overwrite=overwrite)
            predictions(model, validation, c.name, "validation").write.mode(_mode(overwrite)).parquet(path)
            parts.append(measured(spark.read.parquet(path), strategy=c.strategy, model=c.model))
        forget(rows)
    ranked(_rows(parts)).write.mode(_mode(overwrite)).parquet(f"{out}/comparison")
    return spark.read.parquet(f"{out}/comparison").orderBy("candidate_rank")


def comparisons(spark, folders: Sequence[str]) -> DataFrame:
    """Those of several runs as one, ranked anew; of a candidate's rows the one of the last folder stands."""
    tables = [spark.read.parquet(f"{p}/comparison").drop("candidate_rank").withColumn("_run", F.lit(i)) for i, p in enumerate(folders)]
    if not tables:
        raise ContractError("no runs to compare")
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t, allowMissingColumns=True)
    last = rows.groupBy("strategy", "model").agg(F.max("_run").alias("_run"))
    return ranked(rows.join(last, ["strategy", "model", "_run"]).drop("_run"))


def improvement(tuned: DataFrame, earlier: DataFrame) -> DataFrame:
    """By strategy and model, the measures of both runs and their differences."""
    names = ("roc_auc", "average_precision", "log_loss")
    before = earlier.select("strategy", "model", *(F.col(n).alias(f"{n}_before") for n in names))
    return tuned.join(before, ["strategy", "model"]).select("strategy", "model", *(x for n in names for x in (n, f"{n}_before", (F.col(n) - F.col(f"{n}_before")).alias(f"{n}_change"))))


def run_tuning(train: DataFrame, validation: DataFrame, features: Sequence[str], candidates: Sequence[Candidate], out: str, *, trials: int = 5, seed: int = SEED, earlier: str | None = None, overwrite: bool = False) -> DataFrame:
    """The best parameters of each candidate on validation rows, refitted: parameters.json beside what run_matrix writes,
    and improvement over the run in the folder earlier if there is one."""
    best, _ = tune(train, validation, features, candidates, trials, seed)
    found = run_matrix(train, validation, features, list(best.values()), out, overwrite=overwrite)
    if earlier:
        improvement(found, train.sparkSession.read.parquet(f"{earlier}/comparison")).write.mode(_mode(overwrite)).parquet(f"{out}/improvement")
    files.write_json(train.sparkSession, {name: dict(c.params) for name, c in best.items()}, f"{out}/parameters.json", overwrite=overwrite)
    return found


def run_stacking(train: DataFrame, validation: DataFrame, features: Sequence[str], bases: Sequence[Candidate], out: str, *, k: int = 5, seed: int = SEED, overwrite: bool = False) -> dict:
    """Writes oof, model, validation_predictions, comparison and, last, manifest.json, which is returned.

    The manifest names the leader on validation rows among the bases and the stack.
    """
    spark, names = train.sparkSession, [c.name for c in bases]
    need_families(bases)
    if k < 2:
        raise ContractError("stacking takes two folds at least")
    for what, rows in (("training", train), ("validation", validation)):
        if rows.agg(F.count_distinct("label").alias("n")).first().n != 2:
            raise ContractError(f"{what} rows do not hold both labels")
    out_of_fold(train, features, bases, k, seed).write.mode(_mode(overwrite)).parquet(f"{out}/oof")
    made = stack(train, features, bases, k, seed, oof=spark.read.parquet(f"{out}/oof"))
    save(made, f"{out}/model", overwrite=overwrite)
    made.scores(validation).select("user_id", "item_id", "label", *names, STACK).write.mode(_mode(overwrite)).parquet(f"{out}/validation_predictions")
    wide = spark.read.parquet(f"{out}/validation_predictions")
    one = lambda name: wide.select("label", F.col(name).alias("score"))
    parts = [measured(one(c.name), candidate=c.name, strategy=c.strategy, model=c.model) for c in bases]
    parts.append(measured(one(STACK), candidate=STACK, strategy="stacking", model="logistic_regression"))
    ranked(_rows(parts)).write.mode(_mode(overwrite)).parquet(f"{out}/comparison")
    order = [r.candidate for r in spark.read.parquet(f"{out}/comparison").orderBy("candidate_rank").select("candidate").collect()]
    manifest = {
        "selection_split": "validation",
        "selection_metric": "roc_auc",
        "base_candidates": names,
        "base_model_parameters": {c.name: dict(c.params) for c in bases},
        "features": list(features),
        "folds": k,
        "seed": seed,
        "candidates": order,
        "validation_leader": order[0],
        "test_data_read": False,
        "test_used_for_training_or_selection": False,
    }
    files.write_json(spark, manifest, f"{out}/manifest.json", overwrite=overwrite)
    return manifest


def final_evaluation(test: DataFrame, run: str, out: str) -> dict:
    """Test rows scored once by the models of a stacking run; nothing is fitted, chosen or overwritten.

    Writes predictions, metrics (of both splits), confusion, thresholds, curves, report.md and, last, summary.json. A
    folder that holds predictions is refused, as the test rows have been read for it.
    """
    spark, began = test.sparkSession, time.perf_counter()
    manifest, model = files.read_json(spark, f"{run}/manifest.json"), load(f"{run}/model")
    for field in ("test_data_read", "test_used_for_training_or_selection"):
        if manifest.get(field) is not False:
            raise ContractError(f"the manifest does not state that {field} is false")
    if not isinstance(model, Stack) or list(model.bases) != manifest["base_candidates"]:
        raise ContractError("the models are not those of the manifest")
    if files.exists(spark, f"{out}/predictions"):
        raise ContractError(f"{out} holds an evaluation of test rows already")
    names = [*manifest["base_candidates"], STACK]
    scored = model.scores(load_matrix(test, manifest["features"]))
    scored.select("user_id", "item_id", "label", *names, *((F.col(n) >= THRESHOLD).cast("byte").alias(f"label_{n}") for n in names)).write.parquet(f"{out}/predictions")
    wide = {"validation": spark.read.parquet(f"{run}/validation_predictions"), "test": spark.read.parquet(f"{out}/predictions")}
    one = lambda split, n: wide[split].select("label", F.col(n).alias("score"))
    _rows([measured(one(s, n), candidate=n, dataset_split=s) for s in wide for n in names]).write.parquet(f"{out}/metrics")
    for table, of in (("confusion", metrics.confusion), ("thresholds", metrics.threshold_grid), ("curves", metrics.curve_points)):
        for n in names:
            of(one("test", n)).select(F.lit(n).alias("candidate"), "*").write.mode("append").parquet(f"{out}/{table}")
    rows = spark.read.parquet(f"{out}/metrics").orderBy("dataset_split", F.desc("roc_auc"), F.desc("average_precision"), "candidate").collect()
    files.write_text(spark, report(rows, manifest), f"{out}/report.md")
    summary = {
        "candidates": names,
        "selection_split": "validation",
        "validation_leader": manifest["validation_leader"],
        "test_evaluation_count": 1,
        "test_used_for_tuning_or_selection": False,
        "prediction_threshold": THRESHOLD,
        "tables": {t: f"{out}/{t}" for t in ("predictions", "metrics", "confusion", "thresholds", "curves")},
        "report": f"{out}/report.md",
        "seconds": time.perf_counter() - began,
    }
    files.write_json(spark, summary, f"{out}/summary.json")
    return summary


def report(rows: Sequence[Row], manifest: dict) -> str:
    """The final evaluation in Markdown."""
    names = ("candidate", "dataset_split", "roc_auc", "accuracy", "average_precision", "precision", "recall", "f1", "log_loss")
    cell = lambda v: f"{v:.6f}" if isinstance(v, float) else str(v)
    table = [f"| {' | '.join(names)} |", f"| {' | '.join('---' for _ in names)} |", *(f"| {' | '.join(cell(r[n]) for n in names)} |" for r in rows)]
    text = ["# Final evaluation", "", f"The candidates and the leader (`{manifest['validation_leader']}`) were chosen on validation rows. Test rows were read once, for the figures below.", "", *table]
    return "\n".join(text) + "\n"


def interpretation(model: PipelineModel, rows: DataFrame, rules: Rules, out: str, *, sample: int = explain.SAMPLE, worst: int = 100, mode: str = "errorifexists") -> dict:
    """Writes importances, errors, worst errors, attributions of tree models, and segments where both count columns are features.

    The threshold is the best of the rows given: a diagnostic, not one to predict with.
    """
    if isinstance(model, Stack):
        raise ContractError("a stack has no features of its own; name one of its bases")
    features, spark = model.stages[0].getInputCols(), rows.sparkSession
    scored = stored(score(model, load_matrix(rows, features)), "scored")
    threshold = metrics.best_threshold(metrics.threshold_grid(scored)).first().threshold
    tables = {
        "importances": explain.importances(model, features),
        "errors": metrics.error_summary(scored, threshold),
        "worst_errors": metrics.worst_errors(scored.select("user_id", "item_id", "label", "score"), threshold, worst),
    }
    if hasattr(model.stages[-1], "trees"):
        values = stored(explain.attributions(model, explain.explanation_sample(load_matrix(rows, features), sample), features), "attributions")
        tables["attributions"] = explain.attribution_summary(values, features)
    counts = ("user_event_count", "item_total_count")
    if set(counts) <= set(scored.columns):
        # Counts are whole; standardised ones have been floats.
        raw = explain.raw_values(scored, rules.numeric, counts).withColumns({c: F.round(c) for c in counts})
        tables["segments"] = metrics.segment_metrics(raw, threshold)
    files.write_tables(tables, out, mode=mode)
    summary = {"threshold": threshold, "threshold_is_test_informed": True, "rows": scored.count(), "tables": sorted(tables)}
    files.write_json(spark, summary, f"{out}/summary.json", overwrite=mode == "overwrite")
    return summary
