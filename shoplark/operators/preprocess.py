"""Preprocessing: rules are fitted on training rows only and applied to all splits as generated expressions."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..contracts import PROTECTED, ContractError
from ..functions.scalars import finite
from ..sources.shared import stored

#: Stands for a missing category; it has a code only if training rows had one.
MISSING = "\u0000__MISSING__"
UNSEEN = -1
IDS = ("user_id", "item_id", "category_id")
#: Distinct values of a categorical column that are kept as a literal map; the codes of larger ones are a joined table.
MOST_VALUES = 10_000


def feature_roles(schema: T.StructType) -> tuple[list[str], list[str], list[str]]:
    """(numeric, categorical, dropped) columns by their types; times and dates are dropped, other types are errors."""
    numeric, categorical, dropped = [], [], []
    for f in schema:
        if f.name in PROTECTED:
            continue
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            dropped.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            categorical.append(f.name)
        elif isinstance(f.dataType, (T.IntegralType, T.FractionalType)) and not isinstance(f.dataType, T.DecimalType):
            numeric.append(f.name)
        else:
            raise ContractError(f"{f.name}: {f.dataType.simpleString()} is no feature type")
    return numeric, categorical, dropped


@dataclass
class Rules:
    """Mean, scale and fill of numeric columns; codes of categorical ones, or the Parquet table (value, code) of those
    with many values."""

    numeric: dict[str, dict[str, float]] = field(default_factory=dict)
    categories: dict[str, dict[str, int]] = field(default_factory=dict)
    tables: dict[str, str] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self), ensure_ascii=False, sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> Rules:
        return cls(**json.loads(text))


def moments(train: DataFrame, numeric: list[str]) -> DataFrame:
    """Rows, and for each column its finite values, their mean and population variance: one row, one pass."""
    parts = [F.count("*").alias("n_rows")]
    for c in numeric:
        x = finite(F.col(c))
        parts += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"), F.var_pop(x).alias(f"{c}__var")]
    return train.agg(*parts)


def fit_rules(train: DataFrame, *, most_values: int = MOST_VALUES) -> Rules:
    """scale is the population deviation after filling with the mean: sqrt(variance * finite / rows); 1 where it is 0. All missing: 0, 0, 1."""
    numeric, categorical, _ = feature_roles(train.schema)
    row = moments(train, numeric).first()
    if not row["n_rows"]:
        raise ContractError("no training rows to fit rules on")
    rules = Rules()
    for c in numeric:
        n, mean, var = row[f"{c}__n"], row[f"{c}__mean"], row[f"{c}__var"]
        scale = (var * n / row["n_rows"]) ** 0.5 if n else 1.0
        rules.numeric[c] = {"fill": mean if n else 0.0, "mean": mean if n else 0.0, "scale": scale if scale > 0 else 1.0}
    if categorical:
        pairs = F.array(*(F.struct(F.lit(c).alias("c"), F.coalesce(F.col(c), F.lit(MISSING)).alias("value")) for c in categorical))
        values = stored(train.select(F.explode(pairs).alias("p")).select(F.col("p")["c"].alias("c"), F.col("p")["value"].alias("value")).distinct(), "categories")
        sizes = {r.c: r.n for r in values.groupBy("c").agg(F.count("*").alias("n")).collect()}
        small = sorted(c for c in categorical if sizes[c] <= most_values)
        found = values.where(F.col("c").isin(small)).collect() if small else []
        for c in categorical:
            if c in small:
                rules.categories[c] = {v: i for i, v in enumerate(sorted(r.value for r in found if r.c == c))}
            else:
                rules.tables[c] = code_table(values.where(F.col("c") == c).select("value"))
    return rules


def code_table(values: DataFrame) -> str:
    """The path of a table of distinct values and their places in sorted order, counted by ranges."""
    n = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = stored(values.repartitionByRange(n, "value").sortWithinPartitions("value").withColumn("id", F.monotonically_increasing_id()), "ordered")
    ordered = ordered.withColumn("part", F.shiftright("id", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ordered.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))  # a row a range
    coded = ordered.join(F.broadcast(starts), "part").select("value", (F.col("start") + F.col("id").bitwiseAND((1 << 33) - 1)).alias("code"))
    return stored(coded, "codes").stored_at


def standardized(c: str, rule: Mapping[str, float]) -> Column:
    filled = F.coalesce(finite(F.col(c)), F.lit(float(rule["fill"])))
    return ((filled - F.lit(float(rule["mean"]))) / F.lit(float(rule["scale"]))).cast("float").alias(c)


def coded(c: str, codes: Mapping[str, int]) -> Column:
    """From a literal map; unseen values get UNSEEN."""
    value = F.coalesce(F.col(c), F.lit(MISSING))
    pairs = [F.lit(x) for pair in codes.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), value) if pairs else F.lit(None)
    return F.coalesce(found, F.lit(UNSEEN)).cast("int").alias(f"{c}_code")


def apply_rules(df: DataFrame, rules: Rules) -> DataFrame:
    """Ids, label if there is one, standardised numeric columns (float) and codes (int); no shuffle and no join but for
    columns with many values."""
    head = [c for c in (*IDS, "label") if c in df.columns]
    out = df
    for i, (c, path) in enumerate(rules.tables.items()):
        codes = df.sparkSession.read.parquet(path).select(F.col("value").alias(f"_value{i}"), F.col("code").cast("int").alias(f"_code{i}"))
        out = out.join(codes, F.coalesce(F.col(c), F.lit(MISSING)) == F.col(f"_value{i}"), "left")
    joined = {c: F.coalesce(f"_code{i}", F.lit(UNSEEN)).cast("int").alias(f"{c}_code") for i, c in enumerate(rules.tables)}
    order = [c for c in feature_roles(df.schema)[1] if c in rules.categories or c in joined]
    order += [c for c in rules.categories if c not in order]
    return out.select(*head, *(standardized(c, r) for c, r in rules.numeric.items()), *(joined[c] if c in joined else coded(c, rules.categories[c]) for c in order))


def applied_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """How many values were filled and how many categories were unseen, by column."""
    filled = [F.count_if(finite(F.col(c)).isNull()).alias(f"filled_{c}") for c in rules.numeric]
    return df.agg(F.count("*").alias("rows"), *filled, *(F.count_if(coded(c, m) == UNSEEN).alias(f"unseen_{c}") for c, m in rules.categories.items()))


def preprocess(splits: Mapping[str, DataFrame]) -> tuple[Rules, dict[str, DataFrame]]:
    schemas = {tuple((f.name, f.dataType.simpleString()) for f in d.schema) for d in splits.values()}
    if len(schemas) > 1:
        raise ContractError("the splits' schemas differ")
    rules = fit_rules(splits["train"])
    return rules, {k: apply_rules(d, rules) for k, d in splits.items()}
