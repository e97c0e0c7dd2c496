"""Tables kept in the folder that all executors share, so that a plan that is read more than once runs once."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in spark.checkpoint.dir. Where none is set, a temporary folder serves, but only if all tasks run on this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; executors need a folder that they share")
        own = tempfile.mkdtemp(prefix="shoplark-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        base = f"file://{own}"
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage in a way that survives lost executors."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def forget(df: DataFrame) -> None:
    """Remove what stored() wrote for df; nothing may read it any more."""
    jvm, path = df.sparkSession._jvm, df.stored_at
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)
