"""Batch inference with frozen rules: read, transform, score, write."""

from __future__ import annotations

import resource
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import ContractError, need_columns, need_features, need_rules
from ..sources import files
from .models import Stack, load, score
from .preprocess import Rules, coded, standardized

#: Fixed keys of the configuration file.
CONFIG = ("final_candidate", "model_artifact", "preprocessing_rules", "feature_list", "selection_manifest", "evaluation_summary", "prediction_threshold")
OUTPUT = ("user_id", "item_id", "category_id", "purchase_probability", "predicted_purchase")


@dataclass(frozen=True)
class InferenceContract:
    """What is frozen: the model's name, its features in order, the rules, the threshold."""

    candidate: str
    features: tuple[str, ...]
    rules: Rules
    threshold: float

    @classmethod
    def checked(cls, manifest: Mapping, rules: Rules) -> InferenceContract:
        """From a manifest with candidate, validation_leader, features, threshold, test_data_read and test_evaluations."""
        if manifest["candidate"] != manifest["validation_leader"]:
            raise ContractError("the candidate is not the leader on validation rows")
        if manifest.get("test_data_read"):
            raise ContractError("test rows were read before the final evaluation")
        if manifest.get("test_evaluations", 0) > 1:
            raise ContractError("test rows were evaluated more than once")
        if not 0 <= manifest["threshold"] <= 1:
            raise ContractError("the threshold is not in [0, 1]")
        features = tuple(need_features(manifest["features"]))
        raw_inputs(features, rules)
        if any(not r["scale"] > 0 for r in rules.numeric.values()):
            raise ContractError("a scale is not positive")
        return cls(manifest["candidate"], features, rules, float(manifest["threshold"]))


def load_contract(spark: SparkSession, path: str) -> tuple[InferenceContract, PipelineModel | Stack]:
    """The contract and the model that a configuration file names, after its files have been held against each other.

    Paths that are not absolute begin at the configuration's folder. Of a stack, model_bundle_key names the base that
    scores; it must be the final candidate. Without it the whole stack scores.
    """
    config = files.read_json(spark, path)
    if missing := sorted(set(CONFIG) - set(config)):
        raise ContractError(f"{path} has no {', '.join(missing)}")
    folder = path.rpartition("/")[0]
    at = {k: v if v.startswith("/") or "://" in v or not folder else f"{folder}/{v}" for k, v in config.items() if k in CONFIG[1:6]}
    candidate, key = config["final_candidate"], config.get("model_bundle_key")
    selection, evaluation = files.read_json(spark, at["selection_manifest"]), files.read_json(spark, at["evaluation_summary"])
    for name, payload, field in (("selection", selection, "test_data_read"), ("selection", selection, "test_used_for_training_or_selection"), ("evaluation", evaluation, "test_used_for_tuning_or_selection")):
        if payload.get(field) is not False:
            raise ContractError(f"the {name} does not state that {field} is false")
    if candidate not in (evaluation.get("candidates") or []):
        raise ContractError(f"{candidate} is not among the evaluated candidates")
    if evaluation.get("test_evaluation_count") != 1:
        raise ContractError("test rows were not evaluated exactly once")
    if key is not None and key != candidate:
        raise ContractError("model_bundle_key is not the final candidate")
    manifest = {"candidate": candidate, "validation_leader": selection.get("validation_leader"), "features": files.read_json(spark, at["feature_list"]).get("selected_features"), "threshold": config["prediction_threshold"]}
    contract = InferenceContract.checked(manifest, Rules(**files.read_json(spark, at["preprocessing_rules"])))
    if not files.exists(spark, at["model_artifact"]):
        raise ContractError(f"{at['model_artifact']} does not exist")
    model = load(at["model_artifact"])
    if isinstance(model, Stack) and key is not None:
        if key not in model.bases:
            raise ContractError(f"the stack has no base {key}")
        model = model.bases[key]
    return contract, model


def raw_inputs(features: Sequence[str], rules: Rules) -> dict[str, str]:
    """The raw column of each processed feature."""
    out = {}
    for f in features:
        raw = f.removesuffix("_code")
        if f in rules.numeric:
            out[f] = f
        elif f.endswith("_code") and raw in rules.categories:
            out[f] = raw
        else:
            raise ContractError(f"{f}: no rule makes this feature")
    return out


def read_input(spark: SparkSession, path: str, contract: InferenceContract) -> DataFrame:
    """Parquet or CSV by the suffix; only the columns that are needed."""
    if path.endswith(".parquet"):
        df = spark.read.parquet(path)
    elif path.endswith(".csv"):
        text = spark.read.option("header", True).csv(path)
        numeric = set(contract.rules.numeric)
        df = text.select(*(F.col(c).try_cast("double").alias(c) if c in numeric else F.col(c).try_cast("bigint").alias(c) if c in OUTPUT[:3] else F.col(c) for c in text.columns))
    else:
        raise ContractError(f"{path}: expected .parquet or .csv")
    wanted = [*OUTPUT[:3], *dict.fromkeys(raw_inputs(contract.features, contract.rules).values())]
    need_columns(df, wanted, path)
    return df.select(*wanted)


def transform_features(df: DataFrame, contract: InferenceContract) -> DataFrame:
    raw = raw_inputs(contract.features, contract.rules)
    made = [standardized(f, contract.rules.numeric[f]) if raw[f] == f else coded(raw[f], contract.rules.categories[raw[f]]) for f in contract.features]
    return df.select(*OUTPUT[:3], *made)


def predict(df: DataFrame, model: PipelineModel | Stack, contract: InferenceContract) -> DataFrame:
    need_rules(df, {f"null {c}": F.col(c).isNull() for c in OUTPUT[:3]}, "inference input")
    made = transform_features(df, contract)
    scored = score(model, made.select(*OUTPUT[:3], *(F.col(c).cast("double").alias(c) for c in contract.features)), "purchase_probability")
    return scored.select(*OUTPUT[:3], "purchase_probability", (F.col("purchase_probability") >= contract.threshold).cast("byte").alias("predicted_purchase"))


def run_inference(spark: SparkSession, source: str, target: str, model: PipelineModel | Stack, contract: InferenceContract, *, mode: str = "errorifexists") -> dict:
    """Scores a file and writes Parquet or CSV by the target's suffix; the summary counts one column of what was written."""
    df = read_input(spark, source, contract)
    if df.isEmpty():
        raise ContractError(f"{source} has no rows")
    began = time.perf_counter()
    out = predict(df, model, contract)
    if target.endswith(".csv"):
        out.write.mode(mode).option("header", True).csv(target)
        written = spark.read.schema(out.schema).option("header", True).csv(target)
    else:
        out.write.mode(mode).parquet(target)
        written = spark.read.parquet(target)
    took = time.perf_counter() - began
    # No Observation: a session that made one cannot send models that hold their training summary to executors.
    seen = written.agg(F.count("*").alias("rows"), F.count_if(F.col("predicted_purchase") == 1).alias("positive")).first()
    return {"rows": seen.rows, "predicted_positive": seen.positive, "seconds": took, "peak_driver_rss_bytes": resource.getrusage(resource.RUSAGE_SELF).ru_maxrss * 1024, "rows_per_second": seen.rows / took, "candidate": contract.candidate, "threshold": contract.threshold}
