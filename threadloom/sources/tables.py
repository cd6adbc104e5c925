"""Relational scan of the Parquet tables (S05, S06), and the spreading of small ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` below ``sf_dir``; a single file or a folder of files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes for each core under which a table is spread before its texts are worked on.
SPREAD_BYTES = 8 << 20


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores if it is so small that its files may hold fewer row groups than there are cores; else as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df.repartition(cores) if size < cores * SPREAD_BYTES else df
