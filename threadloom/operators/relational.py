"""Relational reads of the operational half."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A dimension table is broadcast up to this many rows; beyond, the planner chooses.
BROADCAST_ROWS = 100_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if a bounded count proves that it is small. Runs one action that reads at most ``rows`` + 1 rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def contains_any(columns: list[Column], term: str) -> Column:
    """Case-insensitive contains on any of the columns; % and _ in the term keep their meaning in patterns."""
    return reduce(lambda a, b: a | b, [c.ilike(f"%{term}%") for c in columns])


def since(ts: Column, now: str, days: int | None) -> Column:
    """Within the last days before a fixed now; None is all time."""
    return F.lit(True) if days is None else ts >= F.to_timestamp(F.lit(now)) - F.make_dt_interval(F.lit(days))


def with_child_count(parents: DataFrame, key: str, children: DataFrame, child_key: str, name: str) -> DataFrame:
    """Every parent with the number of its children, zero kept. Children are counted before the join, so one row per key moves."""
    counts = children.groupBy(F.col(child_key).alias("_key")).agg(F.count("*").alias(name))
    return parents.join(counts, F.col(key) == F.col("_key"), "left").drop("_key").withColumn(name, F.coalesce(name, F.lit(0)))


def new_rows(batch: DataFrame, key: str, stored: DataFrame, stored_key: str, sequence: str | None = None) -> DataFrame:
    """The last row of each key in the batch, where the key isn't stored yet."""
    order = F.col(sequence).desc() if sequence else F.lit(0)
    last = batch.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).filter("_n = 1").drop("_n")
    return last.join(stored.select(F.col(stored_key).alias("_k")), F.col(key) == F.col("_k"), "left_anti")


def page(df: DataFrame, order: list[Column], offset: int, limit: int, total: str = "total") -> DataFrame:
    """A page in a total order with the number of all rows beside; the count is an aggregate, not a window over all rows."""
    n = df.agg(F.count("*").alias(total))
    return df.orderBy(*order).offset(offset).limit(limit).crossJoin(F.broadcast(n))  # one row


def stale(df: DataFrame, status: str, started: str, running: str, now: str, minutes: int = 30) -> DataFrame:
    """Running rows without a start, or with one too long ago, become failed."""
    cutoff = F.to_timestamp(F.lit(now)) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    old = (F.col(status) == running) & (F.col(started).isNull() | (F.col(started) < cutoff))
    return df.withColumn(status, F.when(old, "failed").otherwise(F.col(status)))


def largest_first(df: DataFrame, label: str) -> DataFrame:
    """(label, n, place), the largest first, ties by label; a row per label is all that is put in order."""
    sizes = df.groupBy(label).agg(F.count("*").alias("n"))
    return sizes.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), label)))


def trial(df: DataFrame, index: str, n: int) -> DataFrame:
    """The rows of the first n places, by place, so that a trial is the same each time."""
    return df.filter(F.col(index) < n)
