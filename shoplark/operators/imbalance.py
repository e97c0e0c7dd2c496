"""Class-imbalance variants of the training set: as it is, weighted, undersampled, and oversampled with synthetic rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..contracts import ContractError
from ..functions.ordering import chance, chance_order, first_of, numbered
from .preprocess import IDS

SEED = 42
NEIGHBOURS = 5
#: Positives that are compared at a time; more are cut into blocks along a random direction.
BLOCK = 20_000


def class_statistics(df: DataFrame) -> DataFrame:
    out = df.agg(F.count("*").alias("sample_count"), F.count_if(F.col("label") == 1).alias("positive_count"), F.count_if(F.col("label") == 0).alias("negative_count"))
    return out.withColumn("positive_ratio", F.coalesce(F.try_divide(F.col("positive_count").cast("double"), F.col("sample_count").cast("double")), F.lit(0.0)))


def baseline(train: DataFrame) -> DataFrame:
    return train.withColumn("is_synthetic", F.lit(False))


def class_weights(train: DataFrame) -> DataFrame:
    """label, weight: n / (2 * n of the class)."""
    sizes = train.groupBy("label").agg(F.count("*").alias("n"))
    total = train.agg(F.count("*").alias("total"))
    return sizes.crossJoin(F.broadcast(total)).select("label", (F.col("total") / (F.lit(2.0) * F.col("n"))).alias("weight"))  # total is one row


def weighted(train: DataFrame) -> DataFrame:
    """Adds each row's class weight."""
    return train.join(F.broadcast(class_weights(train)), "label").select(*train.columns, "weight")


def check_balance(train: DataFrame) -> tuple[int, int]:
    """(positives, negatives); positives must be the minority and at least two."""
    s = class_statistics(train).first()
    if s.positive_count < 2 or s.positive_count > s.negative_count:
        raise ContractError(f"{s.positive_count} positives and {s.negative_count} negatives: positives must be the minority, and two at least")
    return s.positive_count, s.negative_count


def row_key(df: DataFrame, seed: int, *more: object) -> list:
    """What chance is drawn from: the ids, and the whole row where ids repeat."""
    return [F.lit(seed), *(F.col(c) for c in IDS if c in df.columns), *map(F.lit, more)]


def undersampled(train: DataFrame, *, seed: int = SEED) -> DataFrame:
    """All positives and as many negatives, those first in the order of an md5 of seed and ids."""
    positives, negatives = check_balance(train)
    chosen = first_of(train.where("label = 0"), chance_order(*row_key(train, seed)), positives, negatives)
    return train.where("label = 1").unionByName(chosen).withColumn("is_synthetic", F.lit(False))


def nearest_of(rows: pd.DataFrame, among: pd.DataFrame, features: Sequence[str], k: int) -> pd.DataFrame:
    """n, d, neighbour: the k rows of among that are nearest to each of rows but itself, ties by number; missing values are infinitely far."""
    among = among.sort_values("n")
    x, y, n, m = rows[features].to_numpy(float), among[features].to_numpy(float), rows["n"].to_numpy(), among["n"].to_numpy()
    out = [pd.DataFrame({"n": n[:0], "d": np.zeros(0), "neighbour": m[:0]})]
    for a in range(0, len(n), 200):
        d = np.zeros((len(n[a : a + 200]), len(m)))
        for j in range(len(features)):
            d += (x[a : a + 200, j, None] - y[None, :, j]) ** 2
        d[np.isnan(d)] = np.inf
        d[n[a : a + 200, None] == m[None, :]] = np.nan
        if len(m) > k:
            row, at = np.nonzero(d <= np.partition(d, k - 1, axis=1)[:, k - 1, None])
        else:
            row, at = np.nonzero(~np.isnan(d))
        order = np.lexsort((at, d[row, at], row))
        row, at = row[order], at[order]
        keep = np.arange(len(row)) - np.searchsorted(row, row) < k
        row, at = row[keep], at[keep]
        out.append(pd.DataFrame({"n": n[a + row], "d": d[row, at], "neighbour": m[at]}))
    return pd.concat(out)


def nearest_positives(positives: DataFrame, features: Sequence[str], *, k: int = NEIGHBOURS, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """n, rank, neighbour: the k nearest of each positive (by its number n), ties by number; exact at every size.

    Positives are cut into blocks of near rows along a random direction; blocks of many ties are dealt out by number.
    The k nearest of its own block bound how far a row has to look, and no two rows are nearer to each other than
    along the direction, so it is compared with the blocks that its bound reaches. A group holds two blocks at most.
    """
    continuous = [c for c in features if not c.endswith("_code")] or list(features)
    rows = positives.select("n", *(F.col(c).cast("double") for c in continuous))
    total = rows.count()
    found = "n long, d double, neighbour long"
    ranked = Window.partitionBy("n").orderBy("d", "neighbour")
    ranks = lambda near: near.withColumn("rank", F.row_number().over(ranked).cast("long") - 1).where(F.col("rank") < k).select("n", "rank", "neighbour")
    if total <= block:
        return ranks(rows.withColumn("_block", F.lit(0)).groupBy("_block").applyInPandas(lambda frame: nearest_of(frame, frame, continuous, k), found))
    w = np.random.default_rng(seed).normal(size=len(continuous))
    along = sum((F.col(c) * float(x) for c, x in zip(continuous, w / np.sqrt((w**2).sum()))), F.lit(0.0))
    rows = rows.withColumn("_along", F.coalesce(F.nanvl(along, F.lit(0.0)), F.lit(0.0)))
    cuts = rows.approxQuantile("_along", np.linspace(0, 1, -(-total // block) + 1)[1:-1].tolist(), 0.001)
    rows = rows.withColumn("_cut", F.size(F.filter(F.array(*map(F.lit, cuts)), lambda x: x < F.col("_along"))))
    parts = rows.groupBy("_cut").agg(F.ceil(F.count("*") / block).alias("_parts"))  # a row for each cut
    rows = rows.join(F.broadcast(parts), "_cut").withColumn("_block", F.shiftleft(F.col("_cut").cast("long"), 32) + F.pmod(F.xxhash64("n"), F.col("_parts"))).drop("_cut", "_parts")
    blocks = rows.groupBy("_block").agg(F.min("_along").alias("_low"), F.max("_along").alias("_high")).withColumnRenamed("_block", "_with")
    own = rows.groupBy("_block").applyInPandas(lambda frame: nearest_of(frame, frame, continuous, k), found)
    # Rows with less than k others in their block have no bound. The margins are far above the rounding of sums and roots.
    far = own.groupBy("n").agg(F.when(F.count("*") == k, F.sqrt(F.max("d"))).otherwise(float("inf")).alias("_far"))
    reach = rows.join(far, "n", "left").withColumn("_far", F.coalesce("_far", F.lit(float("inf"))) * (1 + 1e-6))
    slack = F.col("_far") + 1e-9 * sum((F.abs(F.coalesce(F.nanvl(F.col(c), F.lit(0.0)), F.lit(0.0))) for c in continuous), F.abs("_low") + F.abs("_high"))
    meets = (F.col("_along") - slack <= F.col("_high")) & (F.col("_along") + slack >= F.col("_low"))
    reach = reach.join(F.broadcast(blocks), meets).drop("_along", "_far", "_low", "_high").persist()
    pairs = reach.select(F.col("_block").alias("_to"), F.col("_with").alias("_of")).distinct()
    # Names of their own, as a cogroup cannot tell the columns of two sides of one origin apart.
    among = rows.select(F.col("n").alias("_n"), *(F.col(c).alias(f"_{c}") for c in continuous), F.col("_block").alias("_of")).join(pairs, "_of")
    compared = reach.groupBy("_block", "_with").cogroup(among.groupBy("_to", "_of"))
    return ranks(compared.applyInPandas(lambda x, y: nearest_of(x, y.rename(columns={f"_{c}": c for c in ("n", *continuous)}), continuous, k), found))


def synthetic_positives(train: DataFrame, features: Sequence[str], *, k: int = NEIGHBOURS, seed: int = SEED) -> DataFrame:
    """As many rows as positives lack: the i-th starts from positive i mod P, goes part of the way to one of its
    neighbours in each continuous feature, takes each code from either, and has ids -1, label 1."""
    positives, negatives = check_balance(train)
    base = numbered(train.where("label = 1"), chance_order(*row_key(train, seed)), "n")
    near = nearest_positives(base, features, k=k, seed=seed)
    most = min(k, positives - 1)
    plan = train.sparkSession.range(negatives - positives).select(
        F.col("id").alias("i"), (F.col("id") % positives).alias("n"), F.floor(chance(F.lit(seed), F.col("id"), F.lit("neighbour")) * most).cast("long").alias("rank")
    )
    a = base.select("n", *(F.col(c).alias(f"a_{c}") for c in features))
    b = base.select(F.col("n").alias("neighbour"), *(F.col(c).alias(f"b_{c}") for c in features))
    lost = F.raise_error(F.lit("a positive has fewer neighbours than planned")).cast("long")
    met = plan.join(near, ["n", "rank"], "left").withColumn("neighbour", F.coalesce("neighbour", lost)).join(a, "n").join(b, "neighbour")
    out = []
    for f in train.schema:
        c = f.name
        if c in IDS:
            value = F.lit(-1)
        elif c == "label":
            value = F.lit(1)
        elif c.endswith("_code"):
            value = F.when(chance(F.lit(seed), F.col("i"), F.lit(c)) < 0.5, F.col(f"a_{c}")).otherwise(F.col(f"b_{c}"))
        elif c in features:
            value = F.col(f"a_{c}") + chance(F.lit(seed), F.col("i"), F.lit(c)) * (F.col(f"b_{c}") - F.col(f"a_{c}"))
        else:
            value = F.lit(None)
        out.append(value.cast(f.dataType).alias(c))
    return met.select(*out, F.lit(True).alias("is_synthetic"))


def oversampled(train: DataFrame, features: Sequence[str], *, k: int = NEIGHBOURS, seed: int = SEED) -> DataFrame:
    """The training rows and the synthetic ones: both classes are of one size."""
    return baseline(train).unionByName(synthetic_positives(train, features, k=k, seed=seed))


def variants(train: DataFrame, features: Sequence[str], *, seed: int = SEED) -> dict[str, DataFrame]:
    """The four training sets; validation and test rows are never touched."""
    check_balance(train)
    return {"baseline": baseline(train), "class_weight": weighted(train).withColumn("is_synthetic", F.lit(False)), "smote": oversampled(train, features, seed=seed), "undersampled": undersampled(train, seed=seed)}
