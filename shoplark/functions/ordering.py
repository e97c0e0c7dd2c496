"""Row numbers and reproducible chance without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def chance(*parts: Column) -> Column:
    """A number in [0, 1) from an md5 of the parts: the same in any engine and for any partitioning."""
    digest = F.md5(F.concat_ws("|", *(p.cast("string") for p in parts)).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(2**32)


def chance_order(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *(p.cast("string") for p in parts)).cast("binary"))


#: Rows that are sorted together, about.
TOGETHER = 50_000


def numbered(df: DataFrame, order: Column, name: str, *, digits: int = 4) -> DataFrame:
    """Adds the place (from 0) of each row in the order of a text column, such as a digest.

    Rows are counted by the first characters; only rows that share them are sorted together.
    """
    head = F.substring(order, 1, digits)
    rows = df.withColumn("_order", order).withColumn("_head", head)
    before = Window.orderBy("_head").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("_head").agg(F.count("*").alias("_n")).select("_head", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))  # 16**digits rows at most
    within = F.row_number().over(Window.partitionBy("_head").orderBy("_order"))
    return rows.join(F.broadcast(starts), "_head").withColumn(name, F.col("_start") + within - 1).drop("_order", "_head", "_start")


def first_of(df: DataFrame, order: Column, n: int, rows: int) -> DataFrame:
    """The first n of df's rows (their number is rows) in the order of a digest.

    Only rows below a bound are numbered, under which n are expected with a margin; where it holds fewer, as it may
    if rows repeat, all are.
    """
    share = (n + 8 * n**0.5 + 64) / max(1, rows)
    digits = 3
    while 16**digits * TOGETHER < rows:
        digits += 1
    if share < 1:
        below = df.where(order < f"{int(share * 2**32):08x}")
        if below.count() >= n:
            return numbered(below, order, "_place", digits=digits).where(F.col("_place") < n).drop("_place")
    return numbered(df, order, "_place", digits=min(digits, 5)).where(F.col("_place") < n).drop("_place")
