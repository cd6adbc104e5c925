"""Incremental ingestion with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from threadloom.operators.relational import new_rows


def stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at ``path`` with the number of each row's batch; empty before the first batch."""
    schema = StructType([*like.schema.fields, StructField("batch", IntegerType())])
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def append_new(path: str, key: str, sequence: str, gate: Callable[[DataFrame], DataFrame] = lambda df: df) -> Callable[[DataFrame, int], None]:
    """A batch's gated rows, the last of each key, appended unless the key is stored: the first discovery wins.

    Each batch writes to a folder of its own number and replaces it when it runs again, so a batch is stored once.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = stored(spark, path, batch).filter(F.col("batch") != number)
        new_rows(gate(batch), key, before, key, sequence).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def run(rows: DataFrame, path: str, checkpoint: str, key: str, sequence: str, gate: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Reads a stream to its present end into the table at ``path`` and stops; a later run goes on from the checkpoint."""
    query = rows.writeStream.foreachBatch(append_new(path, key, sequence, gate)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def attempt(status: dict[str, dict], source: str, work: Callable[[], int]) -> dict:
    """One source's passage from pending over running to success or failed; a failure stays with its source."""
    entry = status[source] = {"status": "running", "error": None, "documents": 0}
    try:
        entry |= {"documents": work(), "status": "success"}
    except Exception as e:  # noqa: BLE001  the reason is recorded and the other sources go on
        entry |= {"status": "failed", "error": f"{type(e).__name__}: {e}"[:500]}
    return entry


def retry_failed(status: dict[str, dict], work: Callable[[str], int]) -> int:
    """Failed sources again, one by one; how many succeed."""
    failed = [s for s, e in status.items() if e["status"] == "failed"]
    return sum(attempt(status, s, lambda s=s: work(s))["status"] == "success" for s in failed)


def daily(events: DataFrame, late: str = "1 day") -> DataFrame:
    """T08, an extension: counts per day and type; on a stream, days close once the watermark has passed."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    counts = rows.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counts.select(F.col("window.start").alias("day"), "event_type", "n", "total")
