"""Command line: one subcommand a stage, files in and files out."""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .contracts import DEFAULT_WINDOWS, ContractError, windows_of
from .operators import cleaning, dashboard, eda, features, imbalance, inference, labels, metrics, models, preprocess, quality, runs, screening, wide
from .sources import files


def session() -> SparkSession:
    return SparkSession.builder.appName("shoplark").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()


def _windows(text: str | None):
    return windows_of(*(tuple(x.split(":")) for x in text.split(","))) if text else DEFAULT_WINDOWS


def _clean_events(spark: SparkSession, path: str):
    df = spark.read.parquet(path)
    df = df if "event_time" in df.columns else df.withColumn("event_time", F.try_to_timestamp(F.col("time"), F.lit("yyyy-M-d H")).cast("timestamp_ntz"))
    return df if "source_order" in df.columns else df.withColumn("source_order", F.monotonically_increasing_id())


def _feature_tables(spark: SparkSession, folder: str) -> dict:
    names = ("user_basic", "user_activity", "user_sequence", "item_behavior", "item_popularity", "category_behavior", "time_behavior", "conversion_chain")
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}


def convert(spark, a):
    return {"rows": files.csv_to_parquet(spark, a.input, a.output, overwrite=a.overwrite)}


def check(spark, a):
    return files.write_report(quality.quality_report(files.read_log_text(spark, a.input)), a.output)


def clean(spark, a):
    raw = files.read_log_text(spark, a.input)
    cleaning.clean_log(raw, threshold=a.threshold).write.mode(a.mode).parquet(a.output)
    return cleaning.rejected_counts(raw).first().asDict()


def describe(spark, a):
    return {"written": files.write_tables(eda.eda_tables(spark.read.parquet(a.input)), a.output, kind="csv", mode=a.mode, bom=True)}


def intermediate(spark, a):
    return {"written": files.write_tables(features.intermediate_tables(_clean_events(spark, a.input), _windows(a.windows)), a.output, mode=a.mode)}


def build_features(spark, a):
    return {"written": files.write_tables(features.feature_tables(_clean_events(spark, a.input), _windows(a.windows)), a.output, mode=a.mode)}


def build_wide(spark, a):
    tables = _feature_tables(spark, a.input)
    wide.check_wide_inputs(tables, _windows(a.windows))
    wide.wide_table(tables).write.mode(a.mode).parquet(a.output)
    return wide.wide_gate(spark.read.parquet(a.output), tables["user_sequence"].count())


def dashboard_statistics(spark, a):
    tables = _feature_tables(spark, a.input)
    splits = [r[0] for r in dashboard.available_splits(tables["user_activity"]).collect()]
    return {"written": files.write_tables(dashboard.with_splits({s: dashboard.summaries(tables, s) for s in splits}), a.output, kind="csv", mode=a.mode)}


def label(spark, a):
    labels.purchase_labels(spark.read.parquet(a.input), spark.read.parquet(a.clean)).write.mode(a.mode).parquet(a.output)
    return {"splits": [r.asDict() for r in labels.label_summary(spark.read.parquet(a.output)).collect()]}


def split(spark, a):
    labeled = spark.read.parquet(a.input)
    labels.time_ordered_splits(labeled)
    labels.write_splits(labeled, a.output, mode=a.mode)
    return {"rows": need_rows(labeled, spark.read.parquet(a.output), "splits")}


def need_rows(before, after, what: str) -> int:
    had, has = before.count(), after.count()
    if had != has:
        raise ContractError(f"{what}: {had} rows went in, {has} came out")
    return has


def prepare(spark, a):
    splits = {s: spark.read.parquet(f"{a.input}/dataset_split={s}") for s in ("train", "validation", "test")}
    rules, out = preprocess.preprocess(splits)
    files.write_text(spark, rules.to_json(), a.rules, overwrite=True)
    written = files.write_tables(out, a.output, mode=a.mode)
    return {"written": written, "rows": {s: need_rows(d, spark.read.parquet(f"{a.output}/{s}"), s) for s, d in splits.items()}}


def select(spark, a):
    splits = {s: spark.read.parquet(f"{a.input}/{s}") for s in ("train", "validation", "test")}
    found = screening.screen(splits["train"])
    files.write_tables({s: screening.apply_selection(d, found.selected) for s, d in splits.items()}, a.output, mode=a.mode)
    files.write_json(spark, {"selected_features": found.selected, "removed": found.removed}, f"{a.output}/features.json", overwrite=a.mode == "overwrite")
    return {"selected": found.selected, "removed": found.removed}


def balance(spark, a):
    train = spark.read.parquet(a.input)
    files.write_tables(imbalance.variants(train, screening.candidates(train)), a.output, mode=a.mode)
    made = {s: imbalance.class_statistics(spark.read.parquet(f"{a.output}/{s}")).first().asDict() for s in models.STRATEGIES}
    manifest = {"training_strategy_statistics": made, "paths": {s: f"{a.output}/{s}" for s in made}, "seed": imbalance.SEED, "splits_changed": ["train"]}
    files.write_json(spark, manifest, f"{a.output}/manifest.json", overwrite=a.mode == "overwrite")
    return manifest


def evaluate(spark, a):
    return metrics.evaluate(spark.read.parquet(a.input), a.threshold).first().asDict()


def _fitting_rows(spark, folder: str):
    """Training and validation rows and their features; test rows are not touched."""
    train, validation = spark.read.parquet(f"{folder}/train"), spark.read.parquet(f"{folder}/validation")
    names = screening.candidates(train)
    return models.load_matrix(train, names), models.load_matrix(validation, names), names


def _candidates(text: str | None):
    names = text.split(",") if text else [f"{s}__{m}" for s in models.STRATEGIES for m in models.MODELS]
    return [models.Candidate.parse(n) for n in names]


def train(spark, a):
    return {"comparison": [r.asDict() for r in runs.run_matrix(*_fitting_rows(spark, a.input), _candidates(a.candidates), a.output, overwrite=a.mode == "overwrite").collect()]}


def tune(spark, a):
    found = runs.run_tuning(*_fitting_rows(spark, a.input), _candidates(a.candidates), a.output, trials=a.trials, earlier=a.earlier, overwrite=a.mode == "overwrite")
    return {"comparison": [r.asDict() for r in found.collect()]}


def stack(spark, a):
    best = models.distinct_families(spark.read.parquet(f"{a.tuned}/comparison"), a.bases).collect()
    params = files.read_json(spark, f"{a.tuned}/parameters.json")
    bases = [models.Candidate(r.strategy, r.model, tuple(params[f"{r.strategy}__{r.model}"].items())) for r in best]
    return runs.run_stacking(*_fitting_rows(spark, a.input), bases, a.output, k=a.folds, overwrite=a.mode == "overwrite")


def final(spark, a):
    return runs.final_evaluation(spark.read.parquet(f"{a.input}/test"), a.run_folder, a.output)


def explain(spark, a):
    model = models.load(a.model)
    rules = preprocess.Rules(**files.read_json(spark, a.rules))
    return runs.interpretation(model, spark.read.parquet(a.input), rules, a.output, mode=a.mode)


def infer(spark, a):
    contract, model = inference.load_contract(spark, a.config)
    return inference.run_inference(spark, a.input, a.output, model, contract, mode=a.mode)


def setup(spark, a):
    return {"tables": files.create_behavior_table(spark, a.name or "user_behavior")}


COMMANDS = {
    "convert": (convert, ("input", "output", "--overwrite")),
    "quality": (check, ("input", "output")),
    "clean": (clean, ("input", "output", "--threshold=60")),
    "eda": (describe, ("input", "output")),
    "intermediate": (intermediate, ("input", "output", "--windows")),
    "features": (build_features, ("input", "output", "--windows")),
    "wide": (build_wide, ("input", "output", "--windows")),
    "dashboard": (dashboard_statistics, ("input", "output")),
    "labels": (label, ("input", "clean", "output")),
    "splits": (split, ("input", "output")),
    "preprocess": (prepare, ("input", "output", "rules")),
    "select": (select, ("input", "output")),
    "balance": (balance, ("input", "output")),
    "evaluate": (evaluate, ("input", "--threshold=0.5")),
    "train": (train, ("input", "output", "--candidates")),
    "tune": (tune, ("input", "output", "--candidates", "--earlier", "--trials=5")),
    "stack": (stack, ("input", "tuned", "output", "--bases=3", "--folds=5")),
    "final": (final, ("input", "run_folder", "output")),
    "explain": (explain, ("input", "model", "rules", "output")),
    "infer": (infer, ("config", "input", "output")),
    "setup": (setup, ("--name",)),
}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="shoplark")
    commands = out.add_subparsers(dest="command", required=True)
    for name, (run, arguments) in COMMANDS.items():
        sub = commands.add_parser(name, help=run.__name__.replace("_", " "))
        sub.set_defaults(run=run)
        sub.add_argument("--mode", default="errorifexists", choices=("errorifexists", "overwrite"))
        for x in arguments:
            flag, _, default = x.partition("=")
            if flag == "--overwrite":
                sub.add_argument(flag, action="store_true")
            elif default:
                sub.add_argument(flag, type=float if "." in default else int, default=float(default) if "." in default else int(default))
            else:
                sub.add_argument(flag)
    return out


def main(arguments: Sequence[str] | None = None) -> int:
    a = parser().parse_args(arguments)
    try:
        print(json.dumps(a.run(session(), a), ensure_ascii=False, default=str))
    except ContractError as error:
        print(f"error: {error}", file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
