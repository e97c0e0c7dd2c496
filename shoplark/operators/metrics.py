"""Evaluation of scored rows (label, score) by aggregates: ranking metrics, thresholds, curves, confusion."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GRID = tuple(round(0.05 * i, 2) for i in range(1, 20))
#: Score ranges within which running totals are made are cut twice into as many; ranges themselves are summed on few rows.
CUTS = 32
CLIP = 1e-15


def score_range(scored: DataFrame) -> Column:
    """The number of the range of score, higher for higher scores; ranges hold about as many rows, however skewed scores are.

    The bounds are at most 1,023 numbers on the driver: coarse ones, and the finer ones between them.
    """
    bounds = scored.approxQuantile("score", [i / CUTS**2 for i in range(1, CUTS**2)], 1 / CUTS**2 / 4)
    if not bounds:
        return F.lit(0).cast("long")
    coarse, fine = bounds[CUTS - 1 :: CUTS], [bounds[i : i + CUTS - 1] for i in range(0, len(bounds), CUTS)]
    reached = lambda array: F.size(F.filter(array, lambda x: x <= F.col("score")))
    step = reached(F.from_json(F.lit(json.dumps(coarse)), "array<double>"))
    return (step * CUTS + reached(F.get(F.from_json(F.lit(json.dumps(fine)), "array<array<double>>"), step))).cast("long")


def curve(scored: DataFrame) -> DataFrame:
    """score, pos, neg, tp, fp (rows with at least that score), positives, negatives of every distinct score.

    Running totals are made in two steps, within ranges of scores and over the ranges, so no task sorts all scores.
    The bounds of the ranges are a pass of its own over the scores, so scored should be a stored table.
    """
    by = scored.groupBy("score").agg(F.sum(F.col("label").cast("long")).alias("pos"), F.sum((1 - F.col("label")).cast("long")).alias("neg"))
    by = by.withColumn("range", score_range(scored))
    sums = by.groupBy("range").agg(F.sum("pos").alias("range_pos"), F.sum("neg").alias("range_neg"))
    above = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    sums = sums.select("range", zero("range_pos", above).alias("pos_above"), zero("range_neg", above).alias("neg_above"), zero("range_pos", whole).alias("positives"), zero("range_neg", whole).alias("negatives"))
    upto = Window.partitionBy("range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return by.join(F.broadcast(sums), "range").select("score", "pos", "neg", (F.col("pos_above") + F.sum("pos").over(upto)).alias("tp"), (F.col("neg_above") + F.sum("neg").over(upto)).alias("fp"), "positives", "negatives")


def curve_points(scored: DataFrame) -> DataFrame:
    """ROC and precision-recall points, one a distinct score."""
    safe = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    c = F.col
    return curve(scored).select(c("score").alias("threshold"), c("tp"), c("fp"), safe(c("tp"), c("positives")).alias("tpr"), safe(c("fp"), c("negatives")).alias("fpr"), safe(c("tp"), c("tp") + c("fp")).alias("precision"))


def ranking_metrics(scored: DataFrame) -> DataFrame:
    """roc_auc (ties count half), average_precision (steps, no interpolation), log_loss, positive_prediction_ratio at 0.5: one row."""
    c = F.col
    area = F.sum(c("neg") * (c("tp") - c("pos") / 2.0))
    steps = F.sum(c("pos").cast("double") * c("tp") / (c("tp") + c("fp")))
    ranked = curve(scored).agg(
        F.try_divide(area, F.max(c("positives").cast("double") * c("negatives"))).alias("roc_auc"),
        F.try_divide(steps, F.max(c("positives").cast("double"))).alias("average_precision"),
    )
    p = F.least(F.greatest(c("score"), F.lit(CLIP)), F.lit(1 - CLIP))
    y = c("label").cast("double")
    other = scored.agg((-F.avg(y * F.ln(p) + (1 - y) * F.ln(1 - p))).alias("log_loss"), F.avg((c("score") >= 0.5).cast("double")).alias("positive_prediction_ratio"), F.count("*").alias("sample_count"))
    return ranked.crossJoin(other)  # one row each


def rates(tp: Column, fp: Column, fn: Column, tn: Column) -> list[Column]:
    safe = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    return [
        safe(tp, tp + fp).alias("precision"),
        safe(tp, tp + fn).alias("recall"),
        safe(2 * tp, 2 * tp + fp + fn).alias("f1"),
        safe(tp + tn, tp + fp + fn + tn).alias("accuracy"),
    ]


def confusion(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """tn, fp, fn, tp and the rates at a threshold; a score equal to it is positive; rates without cases are 0."""
    yes, real = F.col("score") >= threshold, F.col("label") == 1
    out = scored.agg(F.count_if(~yes & ~real).alias("tn"), F.count_if(yes & ~real).alias("fp"), F.count_if(~yes & real).alias("fn"), F.count_if(yes & real).alias("tp"))
    return out.select("*", *rates(*(F.col(x) for x in ("tp", "fp", "fn", "tn"))))


def threshold_grid(scored: DataFrame, grid: tuple[float, ...] = GRID) -> DataFrame:
    """The confusion and rates at each threshold. Rows are counted by how many thresholds they reach, not once a threshold."""
    reached = F.size(F.filter(F.array(*map(F.lit, grid)), lambda t: t <= F.col("score"))).alias("reached")
    counts = scored.groupBy(reached).agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n"))
    steps = scored.sparkSession.createDataFrame(list(enumerate(grid, 1)), "step int, threshold double")
    met = F.broadcast(steps).crossJoin(counts)  # 19 rows by 20
    at = F.col("reached") >= F.col("step")
    total = lambda cond, c: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0)).cast("long")
    out = met.groupBy("threshold").agg(total(at, "p").alias("tp"), total(at, "n").alias("fp"), total(~at, "p").alias("fn"), total(~at, "n").alias("tn"))
    return out.select("*", *rates(*(F.col(x) for x in ("tp", "fp", "fn", "tn"))))


def best_threshold(grid: DataFrame) -> DataFrame:
    """The row of the highest f1, the lowest threshold of equals. On test rows it is a diagnostic only."""
    return grid.orderBy(F.desc("f1"), "threshold").limit(1)


def evaluate(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    return ranking_metrics(scored).crossJoin(confusion(scored, threshold))  # one row each


def error_summary(scored: DataFrame, threshold: float) -> DataFrame:
    """Rows by kind of outcome."""
    return scored.groupBy(error_type(threshold).alias("error_type")).agg(F.count("*").alias("sample_count"), F.avg("score").alias("mean_score"))


def error_type(threshold: float) -> Column:
    yes, real = F.col("score") >= threshold, F.col("label") == 1
    return F.when(yes & real, "true_positive").when(yes, "false_positive").when(real, "false_negative").otherwise("true_negative")


def worst_errors(scored: DataFrame, threshold: float, n: int = 100) -> DataFrame:
    """The n false positives of the highest and the n false negatives of the lowest scores."""
    kinds = scored.withColumn("error_type", error_type(threshold))
    keys = ["user_id", "item_id"]
    high = kinds.where("error_type = 'false_positive'").orderBy(F.desc("score"), *keys).limit(n)
    return high.unionByName(kinds.where("error_type = 'false_negative'").orderBy("score", *keys).limit(n))


def segment_metrics(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Counts and rates of six segments by user_event_count and item_total_count (raw values, 1 or less is cold or long-tail)."""
    cold, tail = F.coalesce(F.col("user_event_count") <= 1, F.lit(False)), F.coalesce(F.col("item_total_count") <= 1, F.lit(False))
    names = F.array(F.lit("all"), F.when(cold, "cold_start_user").otherwise("non_cold_start_user"), F.when(tail, "long_tail_item").otherwise("non_long_tail_item"), F.when(cold & tail, "cold_start_user_and_long_tail_item"))
    rows = scored.select("label", "score", F.explode(F.filter(names, lambda x: x.isNotNull())).alias("segment"))
    yes, real = F.col("score") >= threshold, F.col("label") == 1
    out = rows.groupBy("segment").agg(F.count("*").alias("sample_count"), F.count_if(real).alias("positive_count"), F.count_if(yes & real).alias("tp"), F.count_if(yes & ~real).alias("fp"), F.count_if(~yes & real).alias("fn"), F.count_if(~yes & ~real).alias("tn"))
    return out.select("*", *rates(*(F.col(x) for x in ("tp", "fp", "fn", "tn"))))


def report_text(name: str, row: dict) -> str:
    """A short Markdown report of an evaluation row."""
    lines = [f"# Evaluation of {name}", "", "| metric | value |", "| --- | ---: |"]
    return "\n".join(lines + [f"| {k} | {v:.6f} |" if isinstance(v, float) else f"| {k} | {v} |" for k, v in row.items()]) + "\n"
