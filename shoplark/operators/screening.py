"""Feature screening on training rows: leakage names, non-finite values, missing rates, variance, correlation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import ContractError, need_features
from ..functions.scalars import finite
from .preprocess import IDS

# Fixed values of the screening rules.
LEAKAGE_TOKENS = ("label", "target", "future", "history_start", "history_end", "label_date", "timestamp")
MOST_MISSING = 0.95
LEAST_VARIANCE = 1e-12
MOST_CORRELATION = 0.98
OUTLIER = 5.0


@dataclass
class Screening:
    selected: list[str]
    removed: dict[str, list[str]] = field(default_factory=dict)
    outliers: dict[str, int] = field(default_factory=dict)


def candidates(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (*IDS, "label", "is_synthetic", "dataset_split")]


def column_statistics(train: DataFrame, names: list[str]) -> DataFrame:
    """One row a column: missing, non-finite and outlying values, mean and population variance; one pass."""
    parts = [F.count("*").alias("rows")]
    for c in names:
        x = F.col(c).cast("double")
        bad = F.isnan(x) | (F.abs(x) == float("inf"))
        usable = F.when(~bad, x)
        parts.append(F.struct(F.lit(c).alias("feature"), F.count_if(x.isNull()).alias("missing_count"), F.count_if(F.coalesce(bad, F.lit(False))).alias("nonfinite_count"), F.count_if(F.abs(usable) > OUTLIER).alias("outlier_count"), F.avg(usable).alias("mean"), F.var_pop(usable).alias("variance")).alias(c))
    wide = train.agg(*parts)
    return wide.select("rows", F.explode(F.array(*(F.col(f"`{c}`") for c in names))).alias("s")).select("s.*", "rows")


def correlations(train: DataFrame, names: list[str]) -> DataFrame:
    """feature_a, feature_b, r of every pair in column order over the rows that have both; 0 where one does not vary.

    Each task adds up its rows' products as matrices (of shifted values, so that large means cost no digits) and gives
    one row a pair; these are summed, so the work is one pass whatever the number of columns.
    """
    k = len(names)
    if k < 2:
        return train.sparkSession.createDataFrame([], "feature_a string, feature_b string, r double")
    rows = train.select(*(F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)))
    means = rows.agg(*(F.avg(finite(F.col(f"x{i}"))).alias(f"x{i}") for i in range(k))).first()
    shift = np.array([m or 0.0 for m in means])
    first, second = np.triu_indices(k, 1)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, k, k))
        for batch in batches:
            valid = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns], 1).astype(float)
            x = np.stack([c.fill_null(0.0).to_numpy() for c in batch.columns], 1)
            with np.errstate(invalid="ignore", over="ignore"):
                x = (x - shift) * valid
                sums, squares = x.T @ valid, (x * x).T @ valid
                total += np.stack([valid.T @ valid, sums, sums.T, squares, squares.T, x.T @ x])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(first))), *(pa.array(t[first, second]) for t in total)], names=["pair", "n", "a", "b", "aa", "bb", "ab"])

    parts = rows.mapInArrow(step, "pair long, n double, a double, b double, aa double, bb double, ab double")
    s = parts.groupBy("pair").agg(*(F.sum(c).alias(c) for c in ("n", "a", "b", "aa", "bb", "ab")))
    of = lambda x, y, xy: F.col(xy) - F.try_divide(F.col(x) * F.col(y), F.col("n"))
    # What rounding leaves of a column without variance is no variance.
    varies = lambda x, xx: F.when(of(x, x, xx) > F.col(xx) * 1e-12, of(x, x, xx))
    r = F.try_divide(of("a", "b", "ab"), F.sqrt(varies("a", "aa")) * F.sqrt(varies("b", "bb")))
    label = F.array(*map(F.lit, names))
    pairs = train.sparkSession.createDataFrame([(p, int(a), int(b)) for p, (a, b) in enumerate(zip(first, second))], "pair long, i int, j int")
    return s.join(F.broadcast(pairs), "pair").select(F.get(label, F.col("i")).alias("feature_a"), F.get(label, F.col("j")).alias("feature_b"), F.when(r.isNull() | F.isnan(r), 0.0).otherwise(r).alias("r"))


def screen(train: DataFrame, names: list[str] | None = None) -> Screening:
    """The rules in order; of two columns that correlate, the later one in schema order goes. Statistics of at most some tens of columns reach the driver."""
    names = need_features(names or candidates(train))
    stats = {r.feature: r for r in column_statistics(train, names).collect()}
    found = Screening([], {}, {c: s.outlier_count for c, s in stats.items() if s.outlier_count})
    for c in names:
        s, why = stats[c], []
        if tokens := [t for t in LEAKAGE_TOKENS if t in c.lower()]:
            why.append("suspected_future_information:" + ",".join(tokens))
        if s.nonfinite_count:
            why.append("nonfinite_values_in_training")
        if s.missing_count > MOST_MISSING * s.rows:
            why.append("missing_rate_above_0.95")
        if (s.variance or 0.0) <= LEAST_VARIANCE:
            why.append("low_variance")
        if why:
            found.removed[c] = why
    left = [c for c in names if c not in found.removed]
    r = {(p.feature_a, p.feature_b): abs(p.r) for p in correlations(train, left).collect()}
    for c in left:
        like = next((k for k in found.selected if r[k, c] >= MOST_CORRELATION), None)
        if like is None:
            found.selected.append(c)
        else:
            found.removed[c] = [f"high_correlation_with:{like}:abs={r[like, c]:.6f}"]
    if not found.selected:
        raise ContractError("all candidate features were removed")
    return found


def apply_selection(df: DataFrame, selected: list[str]) -> DataFrame:
    return df.select(*(c for c in (*IDS, "label") if c in df.columns), *selected)
