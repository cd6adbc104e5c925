"""Tables written to the folder that all executors share, to cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` where the cluster names it; else, on a local master only, a temporary folder that is made and set."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = f"file://{tempfile.mkdtemp(prefix='threadloom-')}"
        context.setCheckpointDir(named)
    return named.rstrip("/")


def materialise(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet to the shared folder and read again, and where."""
    path = f"{shared_dir(df.sparkSession)}/threadloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a table that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
