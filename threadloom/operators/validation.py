"""Checks of whole inputs, each one aggregate of counts, and the warnings that follow from aggregates.

A check never gathers offending rows; ``demand`` raises on the driver if any of a check's counts isn't zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import scalars as S


def demand(faults: DataFrame, what: str) -> None:
    """Raises ValueError with the counts of ``faults`` (one row of numbers) that aren't zero."""
    found = {k: v for k, v in faults.first().asDict().items() if v}
    if found:
        raise ValueError(f"{what}: {', '.join(f'{v} {k}' for k, v in found.items())}")


def matrix_faults(df: DataFrame, vector: str, dims: int) -> DataFrame:
    """Vectors that are missing or of another length, not finite, or zero; each counts where it fails first."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kind = F.when(v.isNull() | (F.size(v) != dims), "shape").when(odd, "not_finite").when(F.forall(v, lambda x: x == 0), "zero")
    return df.select(kind.alias("k")).agg(*[F.count_if(F.col("k") == k).alias(k) for k in ("shape", "not_finite", "zero")])


def clusterer_faults(df: DataFrame, label: str, probability: str) -> DataFrame:
    """Labels that are missing or under -1, and probabilities that are missing, not finite or outside [0, 1]."""
    p = F.col(probability)
    return df.agg(F.count_if(F.col(label).isNull() | (F.col(label) < -1)).alias("bad_labels"), F.count_if(p.isNull() | F.isnan(p) | (p < 0) | (p > 1)).alias("bad_probabilities"))


def label_gaps(df: DataFrame, label: str) -> DataFrame:
    """Clusters, the numbers missing between 0 and the highest, and whether there are none."""
    inside = df.filter(F.col(label) >= 0).agg(F.count_distinct(label).alias("clusters"), (F.coalesce(F.max(label), F.lit(-1)) + 1 - F.count_distinct(label)).alias("missing"))
    return inside.withColumn("contiguous", F.col("missing") == 0)


def keep_faults(df: DataFrame, index: str, rows: int | Column, order: str | None = None) -> DataFrame:
    """Kept places that are missing or out of range, repeated, or lower than the one before in ``order``."""
    at = F.col(index)
    counts = df.groupBy(index).agg(F.count("*").alias("_n"))
    range_faults = counts.agg(F.coalesce(F.sum(F.when(at.isNull() | (at < 0) | (at >= rows), F.col("_n"))), F.lit(0)).alias("out_of_range"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeated"))
    if order is None:
        return range_faults
    fallen = df.withColumn("_b", F.lag(index).over(Window.orderBy(order))).agg(F.count_if(at < F.col("_b")).alias("falling"))
    return range_faults.crossJoin(fallen)  # one row each


GROUP = "struct<representative:bigint,members:array<bigint>>"


def parsed_groups(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """Duplicate groups (representative, members) from JSON lines; the first line that isn't one raises."""
    parsed = F.from_json(raw, GROUP)
    bad = parsed["representative"].isNull() | parsed["members"].isNull()
    told = F.raise_error(F.concat(F.lit("a line is no group: sha256 "), F.sha2(F.col(raw), 256)))
    return lines.select(F.from_json(F.when(bad, told.cast("string")).otherwise(F.col(raw)), GROUP).alias("g")).select("g.*")


def id_faults(df: DataFrame, key: str) -> DataFrame:
    """Blank ids, ids beyond the first of equal ones, and whether there are no rows at all."""
    counts = df.groupBy(key).agg(F.count("*").alias("_n"))
    blank = F.trim(F.coalesce(F.col(key).cast("string"), F.lit(""))) == ""
    return counts.agg(F.coalesce(F.sum(F.when(blank, F.col("_n"))), F.lit(0)).alias("blank"), F.coalesce(F.sum(F.when(~blank, F.col("_n") - 1)), F.lit(0)).alias("repeated"), F.when(F.count("*") == 0, 1).otherwise(0).alias("empty"))


def manifest_check(rows: DataFrame, manifest: DataFrame, key: str, count: str = "rows") -> DataFrame:
    """(key, expected, actual, matches) of a manifest's counts against what is there; either side may lack a key."""
    actual = rows.groupBy(key).agg(F.count("*").alias("actual"))
    both = manifest.select(key, F.col(count).alias("expected")).join(actual, key, "full_outer").fillna(0, ["expected", "actual"])
    return both.withColumn("matches", F.col("expected") == F.col("actual"))


def export_faults(df: DataFrame, label: str, confidence: str, topics: DataFrame, topic: str) -> DataFrame:
    """Rows of unknown topics, and confidences outside [0, 1]."""
    c = F.col(confidence)
    unknown = df.filter(F.col(label) >= 0).join(topics.select(F.col(topic).alias("_t")), F.col(label) == F.col("_t"), "left_anti").agg(F.count("*").alias("unknown_topics"))
    return unknown.crossJoin(df.agg(F.count_if(c.isNull() | F.isnan(c) | (c < 0) | (c > 1)).alias("bad_confidences")))  # one row each


def messages(*pairs: tuple[Column, str]) -> Column:
    """The texts whose conditions hold, in order, as an array."""
    return F.filter(F.array(*[F.when(F.coalesce(when, F.lit(False)), F.lit(text)) for when, text in pairs]), lambda x: x.isNotNull())


def inspection_verdict(counts: DataFrame, expected: int | None = None, tolerance: float = 0.1, error_rate: float = 0.01, formats_match: bool = True) -> DataFrame:
    """``counts`` (valid, invalid) with ``critical``, the reasons for which an input isn't usable, and ``usable``."""
    rate = F.when(F.col("valid") + F.col("invalid") > 0, F.col("invalid") / (F.col("valid") + F.col("invalid"))).otherwise(0.0)
    off = F.lit(False) if expected is None else F.abs(F.col("valid") - expected) / expected > tolerance
    critical = messages((F.lit(not formats_match), "unexpected format"), (F.col("valid") == 0, "no valid record"), (rate > error_rate, "too many bad records"), (off, "unexpected number of records"))
    return counts.withColumn("critical", critical).withColumn("usable", F.size("critical") == 0)


def row_digest(*columns: str) -> Column:
    """V13."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def clustering_warnings(outlier_share: float = 0.5, dominant_share: float = 0.5, mean_probability: float = 0.5, micro_share: float = 0.2) -> Column:
    """V14, over columns of A17 and mean_probability."""
    c = F.col
    return messages(
        (c("outlier_share") > outlier_share, "many outliers"),
        (c("dominant_share") > dominant_share, "one cluster dominates"),
        (c("mean_probability") < mean_probability, "low mean probability"),
        (F.try_divide(c("n_micro"), c("n_clusters")) > micro_share, "many small clusters"),
        (c("n_clusters") == 0, "outliers only"),
    )


def topic_warnings(similar: int = 0) -> Column:
    """V15, over columns of A24, the number of similar pairs and of truncated documents."""
    c = F.col
    return messages((c("empty_topics") > 0, "topics without terms"), (c("similar_pairs") > similar, "similar topics"), (c("duplicate_names") > 0, "names that repeat"), (c("truncated") > 0, "truncated documents"))


def reassignment_warnings(share: float = 0.2, margin: float = 0.08, dominant: float = 0.5) -> Column:
    """V16, over reassigned_share, mean_margin, dominant_share and excluded_topics."""
    c = F.col
    return messages((c("reassigned_share") > share, "many reassigned"), (c("mean_margin") < margin, "low mean margin"), (c("dominant_share") > dominant, "one topic receives most"), (c("excluded_topics") > 0, "topics excluded"))


def split_warnings(stats: DataFrame, targets: dict[str, float], points: float = 0.05, retention: float = 0.2) -> DataFrame:
    """Splits (split, assigned, written) with their warnings: more than ``points`` off the target, or fewer than ``retention`` written."""
    total = stats.agg(F.sum("assigned").alias("_all"))
    target = F.lit(None).cast("double")
    for name, share in targets.items():
        target = F.when(F.col("split") == name, share).otherwise(target)
    rows = stats.crossJoin(F.broadcast(total))  # one row
    found = messages((F.abs(F.col("assigned") / F.col("_all") - target) > points, "off its target"), (F.col("written") / F.col("assigned") < retention, "few kept"))
    return rows.withColumn("warnings", found).drop("_all")


def representative_similarity(candidates: DataFrame, label: str, similarity: str) -> DataFrame:
    """(label, representatives, mean_similarity)."""
    return candidates.groupBy(label).agg(F.count("*").alias("representatives"), F.round(F.avg(similarity), 6).alias("mean_similarity"))


def zipped(left: DataFrame, right: DataFrame, index: str) -> DataFrame:
    """Rows of equal place joined; unequal lengths, or places that don't match, raise. Runs one aggregate over both."""
    place = left.select(F.col(index).alias("_l")).join(right.select(F.col(index).alias("_r")), F.col("_l") == F.col("_r"), "full_outer")
    demand(place.agg(F.count_if(F.col("_r").isNull()).alias("only left"), F.count_if(F.col("_l").isNull()).alias("only right"), (F.count("_l") - F.count_distinct("_l")).alias("places twice")), "tables of unequal length")
    return left.join(right, index)


def norms(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, dims, norm): what a check of a written matrix reads back."""
    return df.select(key, F.size(vector).alias("dims"), F.round(S.norm(F.col(vector)), 6).alias("norm"))
