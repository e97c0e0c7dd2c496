"""Files: CSV logs in, Parquet, CSV and JSON out, tables in a catalog."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import RAW_COLUMNS, RAW_SCHEMA, TEXT_SCHEMA, ContractError, need_header, need_rules, raw_rules


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """The first line's names, without a byte order mark."""
    first = spark.read.text(path).limit(1).collect()
    return first[0][0].lstrip("﻿").split(",") if first else []


def read_log_text(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, with source_order: the place of a row in its file."""
    if tuple(csv_header(spark, path)) != RAW_COLUMNS:
        raise ContractError(f"{path}: header is {csv_header(spark, path)}; expected {list(RAW_COLUMNS)}")
    return spark.read.schema(TEXT_SCHEMA).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE").csv(path).withColumn("source_order", F.monotonically_increasing_id())


def read_log_typed(spark: SparkSession, path: str) -> DataFrame:
    """Typed columns; a value that does not fit its type fails the read."""
    if tuple(csv_header(spark, path)) != RAW_COLUMNS:
        raise ContractError(f"{path}: header is not {list(RAW_COLUMNS)}")
    return spark.read.schema(RAW_SCHEMA).option("header", True).option("enforceSchema", True).option("mode", "FAILFAST").csv(path)


def csv_to_parquet(spark: SparkSession, source: str, target: str, *, compression: str = "snappy", overwrite: bool = False) -> int:
    """Typed Parquet of a log, not cleaned; rows that break the contract fail before anything is written. Returns the rows."""
    df = read_log_typed(spark, source)
    need_header(df)
    need_rules(df, raw_rules(), source)
    df.write.mode("overwrite" if overwrite else "errorifexists").option("compression", compression).parquet(target)
    return spark.read.parquet(target).count()


def read_columns(spark: SparkSession, path: str, columns: Sequence[str] | None = None, split: str | None = None) -> DataFrame:
    """A projected read, of one split if named; both reach the scan."""
    df = spark.read.parquet(path)
    df = df.where(F.col("dataset_split") == split) if split else df
    return df.select(*columns) if columns else df


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def write_text(spark: SparkSession, text: str, path: str, *, overwrite: bool = False) -> None:
    """One file, on whatever file system the path names."""
    system, place = _place(spark, path)
    if not overwrite and system.exists(place):
        raise ContractError(f"{path} exists")
    out = system.create(place, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_json(spark: SparkSession, payload: object, path: str, *, overwrite: bool = False) -> None:
    write_text(spark, json.dumps(payload, ensure_ascii=False, indent=2, default=str) + "\n", path, overwrite=overwrite)


def read_json(spark: SparkSession, path: str) -> dict:
    if not exists(spark, path):
        raise ContractError(f"{path} does not exist")
    try:
        out = json.loads(spark.read.text(path, wholetext=True).first()[0])
    except ValueError as error:
        raise ContractError(f"{path} is not JSON: {error}") from error
    if not isinstance(out, dict):
        raise ContractError(f"{path} holds no object")
    return out


def write_csv(df: DataFrame, path: str, *, mode: str = "errorifexists", one_file: bool = False, bom: bool = False) -> None:
    """With bom, each file begins with a byte order mark, as spreadsheet programs want it."""
    df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0]) if bom else df
    (df.coalesce(1) if one_file else df).write.mode(mode).option("header", True).csv(path)


def write_tables(tables: Mapping[str, DataFrame], folder: str, *, kind: str = "parquet", mode: str = "errorifexists", bom: bool = False) -> list[str]:
    """Each table in a folder of its own; the committer puts a folder in place as a whole."""
    out = []
    for name, df in tables.items():
        path = f"{folder.rstrip('/')}/{name}"
        write_csv(df, path, mode=mode, one_file=bom, bom=bom) if kind == "csv" else df.write.mode(mode).parquet(path)
        out.append(path)
    return out


def write_report(df: DataFrame, path: str) -> dict:
    """A one-row frame as JSON on the driver's disk."""
    row = df.first().asDict(recursive=True)
    with open(path, "w", encoding="utf-8") as file:
        json.dump(row, file, ensure_ascii=False, indent=2, default=str)
    return row


BEHAVIOR_TABLE = "CREATE TABLE IF NOT EXISTS {name} (time STRING NOT NULL, user_id BIGINT NOT NULL, item_id BIGINT NOT NULL, item_category BIGINT NOT NULL, behavior_type TINYINT NOT NULL) USING parquet"


def create_behavior_table(spark: SparkSession, name: str = "user_behavior") -> list[str]:
    """Creates the table if it is not there; the names of all tables, sorted."""
    spark.sql(BEHAVIOR_TABLE.format(name=name))
    return sorted(t.name for t in spark.catalog.listTables())


def append_behavior(df: DataFrame, name: str = "user_behavior") -> None:
    """Appends rows that keep the table's constraints (positive ids, behaviour 1 to 4, no nulls)."""
    need_rules(df, raw_rules(), name)
    df.select(*RAW_COLUMNS).write.mode("append").insertInto(name)
