"""Column functions: rounding, ratios, dates and buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Labels of equal-frequency bands.
BAND_LABELS = {1: ("All",), 2: ("Low", "High"), 3: ("Low", "Medium", "High"), 4: ("Very Low", "Low", "High", "Very High"), 5: ("Very Low", "Low", "Medium", "High", "Very High")}


def stripped(c: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(c, F.lit(" \t\n\x0b\f\r"))


def ratio(a: Column, b: Column) -> Column:
    """Null where the denominator is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def percent(a: Column, b: Column) -> Column:
    return ratio(a, b) * 100


def percent2(a: Column, b: Column) -> Column:
    """Percentage, two digits, halves to even."""
    return F.bround(F.try_divide(a.cast("double"), b.cast("double")) * 100, 2)


def days_between(later: Column, earlier: Column) -> Column:
    return F.timestamp_diff("SECOND", earlier, later).cast("double") / 86400.0


def finite(c: Column) -> Column:
    """Null for NaN and infinities."""
    x = c.cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def numeric_id(c: Column) -> Column:
    """A positive whole number of up to 63 bits from text: exact where the text is an integer, else by way of a double ("1.0", "1e3")."""
    exact, approx = c.try_cast("bigint"), c.try_cast("double")
    usable = (approx == F.floor(approx)) & (approx > 0) & (approx < 2.0**63)
    return F.nullif(F.greatest(F.coalesce(exact, F.when(usable, approx.cast("bigint"))), F.lit(0)), F.lit(0))


def dense_rank_desc(df: DataFrame, by: Sequence[str], value: str, name: str) -> DataFrame:
    """Adds the dense rank (1 for the largest) within by. Only distinct values are ranked, so no task sorts all rows."""
    values = df.select(*by, value).distinct()
    ranked = values.withColumn(name, F.dense_rank().over(Window.partitionBy(*by).orderBy(F.desc(value))).cast("long"))
    return df.join(ranked, [*by, value])


def band_number(place: Column, rows: Column, bands: Column) -> Column:
    """Equal-frequency bucket of the place (from 1) among rows: edges at equal steps between the first and the last."""
    step = F.ceil((place - 1) * bands / F.greatest(rows - 1, F.lit(1)))
    return F.greatest(step, F.lit(1)).cast("int")
