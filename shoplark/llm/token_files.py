"""Token-ID files: sorted Parquet list columns with dictionary and delta encoding, small row groups and page indexes.

Null texts count as empty, a document is its ids and the end id. Rows with a null doc_id sort first, equal
doc_ids by their text; repeated rows are repeated documents; an empty table gives empty files; other columns
are not read, whatever they are called.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import hold_memory, shared_path, array_slices
from .tokens import encoder

FILE_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("part_start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    ]
)


def writer_options(row_group_bytes: int, page_rows: int, page_bytes: int) -> dict[str, str]:
    """Ids take a dictionary; sorted and running numbers take DELTA_BINARY_PACKED (writer version 2, no dictionary)."""
    numbers = ("doc_id", "part_start", "n_tokens")
    return {
        "compression": "zstd",
        "parquet.writer.version": "v2",
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.size": str(page_bytes),
        "parquet.page.row.count.limit": str(page_rows),
        "parquet.page.write-checksum.enabled": "true",
        **{f"parquet.enable.dictionary#{x}": "false" for x in numbers},
    }


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    *,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    partitions: int | None = None,
    row_group_bytes: int = 16 << 20,
    page_rows: int = 5_000,
    page_bytes: int = 256 << 10,
) -> None:
    """Write one row a document, in ascending doc_id order over files and within them.

    Texts, not ids, are dealt out by ranges, so that nothing is encoded twice (a range exchange reads its
    input once for the bounds). A text hash parts equal doc_ids.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_memory("encoder", encoder.cache_clear)
        own, at, part = encoder(tokenizer), 0, TaskContext.get().partitionId()
        for rows, texts in array_slices(batches, "text"):
            ids, sizes = own.encode(texts)
            ends = np.cumsum(sizes + 1)
            lists = np.full(int(ends[-1]), end_id, np.int32)
            keep = np.ones(len(lists), bool)
            keep[ends - 1] = False
            lists[keep] = ids
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    pa.array(np.full(len(sizes), part, np.int32)),
                    pa.array(at + offsets[:-1].astype(np.int64)),
                    pa.array(sizes + 1),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(lists)),
                ],
                names=FILE_SCHEMA.fieldNames(),
            )
            at += int(ends[-1])

    tie = F.xxhash64("text")
    dealt = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first(), tie).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
    dealt.mapInArrow(encode, FILE_SCHEMA).write.options(**writer_options(row_group_bytes, page_rows, page_bytes)).parquet(path)


def read_token_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start and n_tokens of each document; the ids are not read."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    return _with_start(files.select("doc_id", "part", "part_start", "n_tokens"), files)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids; a filter on doc_id reaches row groups and pages through their statistics."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    return _with_start(files, files)


def _with_start(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Adds what the files before a row's file hold; there are as many sums as files, so they are small."""
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    joined = rows.join(F.broadcast(bases), "part", "left")
    return joined.withColumn("start", F.col("base") + F.col("part_start")).drop("part", "part_start", "base")


def crc_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        words = values.astype("<u4")
        crcs = [zlib.crc32(words[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        others = [batch.column(x) for x in ("doc_id", "start", "n_tokens")]
        yield pa.RecordBatch.from_arrays([*others, pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def token_file_digest(docs: DataFrame, tokenizer: str, *, end_id: int, **options) -> DataFrame:
    """Write the files into the shared folder, read them back, one row of digests a document."""
    path = shared_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer, end_id=end_id, **options)
    rows = read_tokens(docs.sparkSession, path).select("doc_id", "start", "n_tokens", "ids")
    return rows.mapInArrow(crc_of, "doc_id long, start long, n_tokens long, ids_crc32 long")
