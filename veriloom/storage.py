"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or, where that is unset and all runs in one process, a temporary folder."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        context = spark.sparkContext
        current = context._jsc.sc().getCheckpointDir()
        if current.isDefined():
            where = current.get()
        elif not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        else:
            where = f"file://{tempfile.mkdtemp(prefix='veriloom-')}"
            context.setCheckpointDir(where)
    return where.rstrip("/")


def scratch(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/veriloom/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str, path: str | None = None) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = path or scratch(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table of the shared folder that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
