"""Group-safe splits and deterministic samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import scalars as S
from threadloom.functions import text as T
from threadloom.operators.cleaning import informative
from threadloom.sources.shared import materialise
from threadloom.sources.tables import spread

SPLITS = ("development", "validation", "test")


def assigned(df: DataFrame, group: Column, seed: int = 42) -> DataFrame:
    """The split of a row's group; an expression, so no lookup join."""
    return df.withColumn("split", S.split_of(seed, group))


def owned(df: DataFrame, text_col: str) -> DataFrame:
    """``written`` is false where an informative text belongs to a split of higher priority.

    The owner of a text is an aggregate over (text hash); repeated texts are
    folded before they move, then joined back. Keys are made once and written
    with the other columns; the text itself is not kept.
    """
    key = T.leakage_key(F.col(text_col))
    rank = F.array_position(F.array(*[F.lit(s) for s in SPLITS]), F.col("split"))
    keyed = spread(df).withColumn("_key", key).withColumn("informative", informative(F.col("_key"))).withColumn("text_hash", F.sha2("_key", 256)).withColumn("_rank", rank)
    rows, _ = materialise(keyed.drop("_key", text_col), "owned")
    owner = rows.filter("informative").groupBy("text_hash").agg(F.min("_rank").alias("_owner"))
    joined = rows.join(owner, "text_hash", "left")
    return joined.withColumn("written", ~F.col("informative") | (F.col("_rank") == F.col("_owner"))).drop("_rank", "_owner")


def split_statistics(df: DataFrame, group_col: str) -> DataFrame:
    """Per split the groups, records, written and removed, and the texts under no constraint that also stand in another split."""
    shared = df.filter("NOT informative").groupBy("text_hash").agg(F.count_distinct("split").alias("_n")).filter("_n > 1").select("text_hash")
    overlaps = df.join(shared, "text_hash", "left_semi").groupBy("split").agg(F.count_distinct("text_hash").alias("ignored"))
    counts = df.groupBy("split").agg(F.count_distinct(group_col).alias("groups"), F.count("*").alias("assigned"), F.count_if("written").alias("written"), F.count_if(~F.col("written")).alias("removed"))
    return counts.join(overlaps, "split", "left").withColumn("ignored", F.coalesce("ignored", F.lit(0)))


def capped_sample(df: DataFrame, group: Column, rank: Column, line: str, per_group: int, size: int) -> DataFrame:
    """The ``per_group`` lowest ranks of each group, and of those the ``size`` lowest overall."""
    by = Window.partitionBy("_group").orderBy("_rank", line)
    kept = df.withColumn("_group", group).withColumn("_rank", rank).withColumn("_n", F.row_number().over(by)).filter(F.col("_n") <= per_group)
    return kept.orderBy("_rank", line).limit(size).drop("_group", "_rank", "_n")


def whole_groups(df: DataFrame, group: Column, seed: int, target: int) -> DataFrame:
    """Whole groups in hash order until ``target`` rows are reached, the group that crosses it included.

    Only one row per group is put in order. Each holds at least one row, so no
    more than ``target`` groups can be needed and the window runs over those.
    """
    keyed = df.withColumn("_group", group)
    counts = keyed.groupBy("_group").agg(F.count("*").alias("_c")).withColumn("_hash", F.sha2(F.concat(F.lit(f"{seed}{S.SEP}"), F.col("_group")), 256))
    first = counts.orderBy("_hash").limit(target)
    before = F.sum("_c").over(Window.orderBy("_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_c")
    chosen = first.withColumn("_before", before).filter(F.col("_before") < target).select("_group")
    return keyed.join(chosen, "_group", "left_semi").drop("_group")


def hash_sample(df: DataFrame, rank: Column, line: str, size: int) -> DataFrame:
    """The ``size`` rows of the lowest hash ranks."""
    return df.withColumn("_rank", rank).orderBy("_rank", line).limit(size).drop("_rank")
