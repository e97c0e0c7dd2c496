"""Cleaning of a growing folder of raw logs: the row rules of operators.cleaning on a stream.

Rejection and derived columns look at single rows, so they run unchanged on a stream. The rule for repeats needs
whole groups and stays with the batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..contracts import TEXT_SCHEMA
from ..operators.cleaning import clean_rows


def read_log_stream(spark: SparkSession, folder: str, *, files_a_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(TEXT_SCHEMA).option("header", True).option("maxFilesPerTrigger", files_a_trigger).csv(folder)


def clean_stream(spark: SparkSession, folder: str, target: str, checkpoint: str) -> StreamingQuery:
    """Cleans what is there and ends; called again, it takes up the files that are new."""
    cleaned = clean_rows(read_log_stream(spark, folder))
    return cleaned.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
