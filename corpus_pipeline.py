"""From raw documents to packed training windows: five stages, each written as Parquet and read again.

Rows keep all their columns, whatever they are called, up to the last stage. Null and empty texts have no words, so the
base rules of the second stage take them out; later stages keep them, and packing gives them one end id each. Null ids
and repeated rows are judged each; near_dedup says what stays of them. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplark.llm.common import stored, table
from shoplark.llm.decontaminate import find_benchmark_spans
from shoplark.llm.near_dup import near_duplicates
from shoplark.llm.packing import pack
from shoplark.llm.quality_classifier import classify, train_classifier
from shoplark.llm.quality_rules import judge_quality
from shoplark.llm.tokens import tokenizer_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps: of good quality and not toxic."""
    model = train_classifier(docs, table(spark, sf_dir, "labels"))
    return classify(docs, model, carry=True).where("kept").select("row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fertility bands."""
    return judge_quality(docs, tokenizer_path("piece_bpe_32k.model"), carry=True).where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near duplicates; rows without an id stay.

    Different texts under one id are documents of their own; of rows with equal id and text one stays.
    """
    rows, key = docs.where("doc_id is not null"), "doc_id"
    if not rows.groupBy("doc_id").agg(F.count("*").alias("copies")).where("copies > 1").isEmpty():
        # Keys in the order of ids, written so that they are the same wherever they are read.
        order, key = [F.col("doc_id"), F.xxhash64("text")], "_row"
        rows = rows.dropDuplicates(["doc_id", "text"]).repartitionByRange(*order).sortWithinPartitions(*order, "text")
        rows = stored(rows.withColumn(key, F.monotonically_increasing_id()), "rows")
    kept = stored(near_duplicates(rows, id_col=key).where("kept").select(F.col("doc_id").alias(key)), "kept")
    # The keys that stay grow with the corpus, so they are never broadcast, however few they are on small inputs.
    out = rows.join(kept.hint("merge"), key, "left_semi").select(*docs.columns)
    return out.unionByName(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return find_benchmark_spans(docs, table(spark, sf_dir, "benchmark"), carry=True).where("size(spans) = 0").select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return pack(docs, tokenizer_path("byte_bpe_50k.json"), end_id=1, capacity=2048)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Models, tokenizers and sketches are beyond SQL; tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
