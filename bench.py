"""Times headline queries and prints one JSON line: BENCH_SF_DIR is the data, BENCH_CPUS the cores."""

import json
import os
import time

from pyspark.sql import SparkSession

from shoplark.plans.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "d3_quality_report",
    "d2_clean_log",
    "e3_item_statistics",
    "e9_descriptive_funnel",
    "d11_user_activity",
    "d12_user_sequence",
    "d14_item_popularity",
    "d21_wide_table",
    "l1_label_summary",
    "pp4_preprocessed",
    "fs1_correlations",
    "ci3_undersampled",
    "ev1_ranking_metrics",
    "m2_logistic_regression",
)


def main() -> None:
    builder = SparkSession.builder.master(f"local[{CPUS}]").config("spark.sql.shuffle.partitions", CPUS).config("spark.driver.memory", "8g")
    spark = builder.config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["e9_descriptive_funnel"](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    took = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": SF_DIR.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
