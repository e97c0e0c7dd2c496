"""Explaining models: importances, path-dependent tree attributions, samples, errors and segments."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordering import chance_order, first_of

SAMPLE = 10_000


def importances(model: PipelineModel, features: Sequence[str], n: int = 10) -> DataFrame:
    """The n features of the highest importance (absolute coefficients of linear models)."""
    last = model.stages[-1]
    values = last.featureImportances.toArray() if hasattr(last, "featureImportances") else np.abs(last.coefficients.toArray())
    spark = SparkSession.active()
    rows = sorted(zip(features, map(float, values)), key=lambda x: (-x[1], x[0]))[:n]
    return spark.createDataFrame(rows, "feature string, importance double")


def explanation_sample(df: DataFrame, rows: int = SAMPLE, seed: int = 42) -> DataFrame:
    """All positives, and negatives in the order of an md5 of seed and ids until there are rows of them."""
    sizes = df.agg(F.count_if(F.col("label") == 1).alias("positives"), F.count_if(F.col("label") == 0).alias("negatives")).first()
    left = max(0, rows - sizes.positives)
    return df.where("label = 1").unionByName(first_of(df.where("label = 0"), chance_order(F.lit(seed), F.col("user_id"), F.col("item_id")), left, sizes.negatives))


def flat_trees(model: PipelineModel) -> list[tuple[float, dict[str, np.ndarray]]]:
    """(weight, arrays) of the trees of a fitted ensemble: feature (-1 in leaves), threshold, left, right, value, cover."""
    last = model.stages[-1]
    out = []
    for tree, weight in zip(last.trees, last.treeWeights):
        rows: list[list[float]] = []

        def walk(node, rows=rows) -> int:
            at = len(rows)
            rows.append([-1, 0.0, -1, -1, node.prediction(), float(node.impurityStats().count())])
            if node.numDescendants() > 0:
                split = node.split()
                rows[at][0], rows[at][1] = split.featureIndex(), split.threshold()
                rows[at][2] = walk(node.leftChild())
                rows[at][3] = walk(node.rightChild())
            return at

        walk(tree._call_java("rootNode"))
        a = np.array(rows, float)
        names = ("feature", "threshold", "left", "right", "value", "cover")
        out.append((float(weight), {n: a[:, i].astype(np.int64) if n in ("feature", "left", "right") else a[:, i] for i, n in enumerate(names)}))
    return out


def tree_attributions(tree: Mapping[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Shapley values of each row and feature for one tree, where features that are not known follow the training rows' shares.

    For each leaf, the features on its path with the row's agreement (0 or 1) and the share of rows that went that way
    give a game whose Shapley values follow from the coefficients of a product of (share + agreement * t).
    """
    n, width = x.shape
    out = np.zeros((n, width))

    def leaves(node: int, path: dict[int, list]) -> None:
        f = tree["feature"][node]
        if f < 0:
            used = list(path)
            m = len(used)
            if not m:
                return
            share = np.array([path[u][0] for u in used])
            agree = np.stack([path[u][1] for u in used], 1).astype(float)
            for k in range(m):
                poly = np.zeros((n, m))
                poly[:, 0] = 1.0
                for j in range(m):
                    if j != k:
                        poly[:, 1:] = poly[:, 1:] * share[j] + poly[:, :-1] * agree[:, j : j + 1]
                        poly[:, 0] *= share[j]
                weight = np.array([_weight(s, m) for s in range(m)])
                out[:, used[k]] += tree["value"][node] * (agree[:, k] - share[k]) * (poly @ weight)
            return
        left, right = tree["left"][node], tree["right"][node]
        goes = x[:, f] <= tree["threshold"][node]
        for child, hit in ((left, goes), (right, ~goes)):
            part = tree["cover"][child] / tree["cover"][node]
            old = path.get(f)
            leaves(child, path | {f: [part * old[0], hit & old[1]] if old else [part, hit]})

    leaves(0, {})
    return out


def _weight(s: int, m: int) -> float:
    """s! (m - s - 1)! / m!"""
    value = 1.0 / m
    for i in range(1, s + 1):
        value *= i / (m - i)
    return value


def attributions(model: PipelineModel, sample: DataFrame, features: Sequence[str]) -> DataFrame:
    """user_id, item_id, label and a value a feature, on the scale of the ensemble's margin."""
    sent = sample.sparkSession.sparkContext.broadcast(flat_trees(model))
    keep, names = ["user_id", "item_id", "label"], list(features)

    def step(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = frame[names].to_numpy(float)
            total = sum(w * tree_attributions(t, x) for w, t in sent.value)
            yield pd.concat([frame[keep].reset_index(drop=True), pd.DataFrame(total, columns=names)], axis=1)

    schema = "user_id long, item_id long, label int, " + ", ".join(f"`{c}` double" for c in names)
    return sample.select("user_id", "item_id", F.col("label").cast("int").alias("label"), *(F.col(c).cast("double").alias(c) for c in names)).mapInPandas(step, schema)


def attribution_summary(values: DataFrame, features: Sequence[str]) -> DataFrame:
    """feature, mean_abs, mean, and the means over positives and negatives."""
    parts = [F.struct(F.lit(c).alias("feature"), F.avg(F.abs(c)).alias("mean_abs"), F.avg(c).alias("mean"), F.avg(F.when(F.col("label") == 1, F.col(c))).alias("mean_positive"), F.avg(F.when(F.col("label") == 0, F.col(c))).alias("mean_negative")) for c in features]
    return values.agg(F.array(*parts).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")


def raw_values(df: DataFrame, rules: Mapping[str, Mapping[str, float]], columns: Sequence[str]) -> DataFrame:
    """Undoes standardisation of the columns."""
    return df.withColumns({c: F.col(c).cast("double") * F.lit(float(rules[c]["scale"])) + F.lit(float(rules[c]["mean"])) for c in columns if c in rules})
