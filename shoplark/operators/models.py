"""Training, tuning and stacking on Spark ML.

XGBoost and LightGBM are not at hand; two profiles of gradient-boosted trees stand for them, and scores differ from
theirs. Tuning draws seeded random candidates from the same kinds of spaces. No function here takes test rows but
score() and what evaluates its result.
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..contracts import ContractError, need_features, need_rules
from ..functions.ordering import chance_order
from ..sources import files
from .imbalance import class_weights, oversampled, undersampled
from .metrics import evaluate

SEED = 42
MODELS = ("logistic_regression", "random_forest", "xgboost", "lightgbm")
STRATEGIES = ("baseline", "class_weight", "smote", "undersampled")
IDS = ("user_id", "item_id", "category_id")
STACK = "stacking_logistic_regression"


@dataclass(frozen=True)
class Candidate:
    strategy: str
    model: str
    params: tuple[tuple[str, float], ...] = ()

    @property
    def name(self) -> str:
        return f"{self.strategy}__{self.model}"

    @classmethod
    def parse(cls, name: str) -> Candidate:
        strategy, _, model = name.partition("__")
        if not model:
            raise ContractError(f"{name}: expected strategy__model")
        return cls(strategy, model)


def load_matrix(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Ids, label and features; every feature is finite, every label 0 or 1."""
    need_features(features)
    rules = {f"{c} is not finite": F.col(c).isNull() | F.isnan(F.col(c).cast("double")) | (F.abs(F.col(c).cast("double")) == float("inf")) for c in features}
    if "label" in df.columns:
        rules["label"] = ~F.col("label").isin(0, 1)
    need_rules(df, rules, "feature matrix")
    return df.select(*(c for c in (*IDS, "label", "weight", "is_synthetic") if c in df.columns), *(F.col(c).cast("double").alias(c) for c in features))


def estimator(model: str, params: Mapping[str, float], rows: int, weight: str | None):
    """Of one family; params override the fixed ones."""
    p = dict(params)
    if model == "logistic_regression":
        c = p.get("C", 1.0)
        out = LogisticRegression(maxIter=int(p.get("max_iter", 200)), regParam=1.0 / (c * max(1, rows)), elasticNetParam=0.0, standardization=False)
    elif model == "random_forest":
        out = RandomForestClassifier(numTrees=int(p.get("trees", 100)), maxDepth=int(p.get("depth", 12)), minInstancesPerNode=int(p.get("leaf", 10)), seed=SEED)
    elif model in ("xgboost", "lightgbm"):
        depth = 6 if model == "xgboost" else 5  # 5 levels have the 32 leaves of the leaf-wise profile
        out = GBTClassifier(maxIter=int(p.get("trees", 100)), maxDepth=int(p.get("depth", depth)), stepSize=p.get("rate", 0.1), subsamplingRate=p.get("subsample", 0.8), featureSubsetStrategy=str(p.get("columns", 0.8)), seed=SEED)
    else:
        raise ContractError(f"{model}: expected one of {', '.join(MODELS)}")
    out = out.setFeaturesCol("features").setLabelCol("label")
    return out.setWeightCol(weight) if weight else out


def fit(train: DataFrame, features: Sequence[str], model: str, params: Mapping[str, float] | None = None) -> PipelineModel:
    """Weighted if train has a weight column."""
    weight = "weight" if "weight" in train.columns else None
    rows = train.count()
    stages = [VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error"), estimator(model, params or {}, rows, weight)]
    return Pipeline(stages=stages).fit(train.withColumn("label", F.col("label").cast("double")))


def with_score(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    """df and the probability of a purchase."""
    return model.transform(df).withColumn(name, vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def score(model: PipelineModel | Stack, df: DataFrame, name: str = "score") -> DataFrame:
    """Ids, label if any, and the probability of a purchase."""
    keep = [c for c in (*IDS, "label", "user_event_count", "item_total_count") if c in df.columns]
    scored = model.scores(df, name) if isinstance(model, Stack) else with_score(model, df, name)
    return scored.select(*keep, name)


def predictions(model: PipelineModel, df: DataFrame, candidate: str, split: str, threshold: float = 0.5) -> DataFrame:
    return score(model, df).select("*", (F.col("score") >= threshold).cast("byte").alias("predicted"), F.lit(candidate).alias("candidate"), F.lit(split).alias("dataset_split"))


def training_set(train: DataFrame, features: Sequence[str], strategy: str, seed: int = SEED) -> DataFrame:
    if strategy == "baseline":
        return train
    if strategy == "class_weight":
        return train.join(F.broadcast(class_weights(train)), "label")
    if strategy == "smote":
        return oversampled(train, features, seed=seed).drop("is_synthetic")
    if strategy == "undersampled":
        return undersampled(train, seed=seed).drop("is_synthetic")
    raise ContractError(f"{strategy}: expected one of {', '.join(STRATEGIES)}")


def train_matrix(train: DataFrame, validation: DataFrame, features: Sequence[str], candidates: Sequence[Candidate]) -> tuple[dict[str, PipelineModel], DataFrame]:
    """A model for each candidate, and their comparison on validation rows, best first."""
    models, rows = {}, None
    for c in candidates:
        models[c.name] = fit(training_set(train, features, c.strategy), features, c.model, dict(c.params))
        row = evaluate(score(models[c.name], validation)).select(F.lit(c.strategy).alias("strategy"), F.lit(c.model).alias("model"), "*")
        rows = row if rows is None else rows.unionByName(row)
    return models, ranked(rows)


def ranked(comparison: DataFrame) -> DataFrame:
    """Adds candidate_rank: auc and average precision descending, then log loss, then names."""
    order = Window.orderBy(F.desc("roc_auc"), F.desc("average_precision"), "log_loss", "strategy", "model")
    return comparison.withColumn("candidate_rank", F.row_number().over(order).cast("long"))  # one row a candidate


def random_params(model: str, rng: random.Random) -> tuple[tuple[str, float], ...]:
    spaces = {
        "logistic_regression": {"C": lambda: 10 ** rng.uniform(-3, 1)},
        "random_forest": {"trees": lambda: rng.choice((50, 100, 150)), "depth": lambda: rng.randint(4, 14), "leaf": lambda: rng.randint(5, 50)},
        "xgboost": {"trees": lambda: rng.choice((50, 100, 150)), "depth": lambda: rng.randint(3, 8), "rate": lambda: 10 ** rng.uniform(-2, -0.5), "subsample": lambda: rng.uniform(0.6, 1.0)},
        "lightgbm": {"trees": lambda: rng.choice((50, 100, 150)), "depth": lambda: rng.randint(3, 7), "rate": lambda: 10 ** rng.uniform(-2, -0.5), "subsample": lambda: rng.uniform(0.6, 1.0)},
    }
    return tuple((k, draw()) for k, draw in spaces[model].items())


def tune(train: DataFrame, validation: DataFrame, features: Sequence[str], candidates: Sequence[Candidate], trials: int = 5, seed: int = SEED) -> tuple[dict[str, Candidate], DataFrame]:
    """For each candidate the parameters of the best validation auc among its trials (the fixed ones are the first)."""
    best, rows = {}, None
    for i, c in enumerate(candidates):
        rng, top = random.Random(seed + i), (-1.0, None)
        data = training_set(train, features, c.strategy).persist()
        try:
            for t in range(trials):
                params = () if t == 0 else random_params(c.model, rng)
                row = evaluate(score(fit(data, features, c.model, dict(params)), validation)).first()
                auc = row.roc_auc if row.roc_auc is not None else 0.5
                if auc > top[0]:
                    top = (auc, Candidate(c.strategy, c.model, params), row)
        finally:
            data.unpersist()
        best[c.name] = top[1]
        line = train.sparkSession.createDataFrame([(c.strategy, c.model, top[2].roc_auc, top[2].average_precision, top[2].log_loss)], "strategy string, model string, roc_auc double, average_precision double, log_loss double")
        rows = line if rows is None else rows.unionByName(line)
    return best, ranked(rows)


def distinct_families(comparison: DataFrame, k: int = 3) -> DataFrame:
    """The best candidate of each model family, then the best k of those."""
    order = [F.desc("roc_auc"), F.desc("average_precision"), "log_loss", "strategy"]
    first = comparison.withColumn("_n", F.row_number().over(Window.partitionBy("model").orderBy(*order))).where("_n = 1").drop("_n")
    return first.orderBy(*order[:3], "model").limit(k)


def folds(train: DataFrame, k: int = 5, seed: int = SEED) -> DataFrame:
    """Adds fold: within each label, rows take the folds in turn in the order of an md5 of seed and ids."""
    from ..functions.ordering import numbered

    order = chance_order(F.lit(seed), *(F.col(c) for c in IDS if c in train.columns))
    parts = [numbered(train.where(F.col("label") == y), order, "_place") for y in (0, 1)]
    return parts[0].unionByName(parts[1]).withColumn("fold", (F.col("_place") % k).cast("int")).drop("_place")


def out_of_fold(train: DataFrame, features: Sequence[str], bases: Sequence[Candidate], k: int = 5, seed: int = SEED) -> DataFrame:
    """Each row's score by each base from models that did not see it; resampling and weights apply to the fitting part only."""
    parted, out = folds(train, k, seed), None
    for c in bases:
        scores = None
        for fold in range(k):
            seen, held = parted.where(F.col("fold") != fold).drop("fold"), parted.where(F.col("fold") == fold).drop("fold")
            part = score(fit(training_set(seen, features, c.strategy), features, c.model, dict(c.params)), held, c.name).select("user_id", "item_id", "label", c.name)
            scores = part if scores is None else scores.unionByName(part)
        out = scores if out is None else out.join(scores.drop("label"), ["user_id", "item_id"])
    return out


@dataclass
class Stack:
    bases: dict[str, PipelineModel]
    meta: PipelineModel

    def scores(self, df: DataFrame, name: str = STACK) -> DataFrame:
        """df, the score of each base under its name, and that of the stack: one pass, no join."""
        for base, model in self.bases.items():
            df = with_score(model, df, base)
        return with_score(self.meta, df, name)

    def score(self, df: DataFrame) -> DataFrame:
        return score(self, df)


def need_families(bases: Sequence[Candidate]) -> None:
    if len({c.model for c in bases}) < 2:
        raise ContractError("stacking takes two distinct model families at least")


def stack(train: DataFrame, features: Sequence[str], bases: Sequence[Candidate], k: int = 5, seed: int = SEED, *, oof: DataFrame | None = None) -> Stack:
    """A logistic model over out-of-fold scores (made here unless given), and the bases refitted on all training rows."""
    need_families(bases)
    oof = out_of_fold(train, features, bases, k, seed) if oof is None else oof
    meta = fit(oof, [c.name for c in bases], "logistic_regression", {"max_iter": 1000})
    return Stack({c.name: fit(training_set(train, features, c.strategy), features, c.model, dict(c.params)) for c in bases}, meta)


def save(model: PipelineModel | Stack, path: str, *, overwrite: bool = False) -> None:
    """A stack is a folder of its models; the file that names them is written last."""
    if isinstance(model, Stack):
        for name, base in model.bases.items():
            save(base, f"{path}/bases/{name}", overwrite=overwrite)
        save(model.meta, f"{path}/meta", overwrite=overwrite)
        files.write_json(SparkSession.active(), {"bases": list(model.bases)}, f"{path}/stack.json", overwrite=overwrite)
        return
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def load(path: str) -> PipelineModel | Stack:
    spark = SparkSession.active()
    if not files.exists(spark, f"{path}/stack.json"):
        return PipelineModel.load(path)
    names = files.read_json(spark, f"{path}/stack.json")["bases"]
    return Stack({n: PipelineModel.load(f"{path}/bases/{n}") for n in names}, PipelineModel.load(f"{path}/meta"))
