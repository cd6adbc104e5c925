"""Conservative reassignment of outliers to topics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import scalars as S
from threadloom.operators.topics import centroid_pairs, centroids


@dataclass(frozen=True)
class Rules:
    enabled: bool = True
    similarity: float = 0.85
    single_similarity: float = 0.90
    margin: float = 0.05
    expansion: float = 0.25
    per_topic: int | None = None
    global_share: float = 0.25
    topic_size: int = 2
    topic_probability: float = 0.5
    member_probability: float = 0.7
    members: int = 2
    cohesion: float = 0.5
    centroid_similarity: float = 0.95

    def __post_init__(self) -> None:
        """Shares lie within [0, 1], similarities within [-1, 1], and one topic is held to no less than several."""
        for name in ("expansion", "global_share", "topic_probability", "member_probability", "margin"):
            if not 0 <= getattr(self, name) <= 1:
                raise ValueError(f"{name} is within [0, 1]")
        for name in ("similarity", "single_similarity", "cohesion", "centroid_similarity"):
            if not -1 <= getattr(self, name) <= 1:
                raise ValueError(f"{name} is within [-1, 1]")
        if self.single_similarity < self.similarity or self.topic_size < 1 or self.members < 1 or (self.per_topic is not None and self.per_topic < 0):
            raise ValueError("a single topic needs no less similarity, and counts are positive")


def eligibility(df: DataFrame, label: str, probability: str, vector: str, rules: Rules, described: Column | None = None) -> DataFrame:
    """(label, size, centroid, cohesion, reason) per topic; ``reason`` is the first rule it fails, or null.

    ``described`` says whether a topic (column ``label``) has keywords. Pairs of too similar centroids are looked for
    among topics that pass all other rules.
    """
    members = df.filter(F.col(label) >= 0)
    sizes = members.groupBy(label).agg(F.count("*").alias("size"), F.avg(probability).alias("mean_probability"))
    good = members.filter(F.col(probability) >= rules.member_probability)
    found = centroids(good, label, vector, at_unit=True)
    cohesion = good.join(F.broadcast(found), label).groupBy(label).agg(F.avg(S.dot(S.unit(F.col(vector)), F.col("centroid"))).alias("cohesion"))
    topics = sizes.join(found, label, "left").join(cohesion, label, "left")
    topics = topics.withColumn(
        "reason",
        F.when(F.col("size") < rules.topic_size, "topic_too_small")
        .when(F.col("mean_probability") < rules.topic_probability, "low_topic_probability")
        .when(F.lit(False) if described is None else ~described, "empty_topic_representation")
        .when(F.coalesce("members", F.lit(0)) < rules.members, "insufficient_centroid_members")
        .when(F.col("centroid").isNull(), "zero_centroid")
        .when(F.col("cohesion") < rules.cohesion, "low_centroid_cohesion"),
    )
    close = centroid_pairs(topics.filter("reason IS NULL"), label).filter(F.col("similarity") > rules.centroid_similarity)
    both = close.select(F.explode(F.array("left", "right")).alias("_l")).distinct()
    marked = topics.join(F.broadcast(both), F.col(label) == F.col("_l"), "left")
    return marked.withColumn("reason", F.when(F.col("_l").isNotNull(), "ambiguous_centroid").otherwise(F.col("reason"))).drop("_l")


def scored(outliers: DataFrame, order: str, vector: str, topics: DataFrame, label: str, rules: Rules) -> DataFrame:
    """J10, W10, M12 without limits: best and second topic of each outlier, margin and reason; of equal similarities the higher topic is first.

    The eligible centroids, a row per topic, are gathered into one array that
    goes along with every row, so no row is multiplied or shuffled.
    """
    listed = topics.filter("reason IS NULL").agg(F.collect_list(F.struct(F.col(label).alias("topic"), "centroid")).alias("_c"))
    sims = F.transform("_c", lambda c: F.struct(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), S.dot(F.col("_u"), c["centroid"]))).alias("s"), c["topic"].alias("t")))
    rows = outliers.withColumn("_u", S.unit(F.col(vector))).crossJoin(F.broadcast(listed))  # one row
    rows = rows.withColumn("_r", F.reverse(F.array_sort(sims)))
    rows = rows.withColumn("best_topic", F.get("_r", F.lit(0))["t"]).withColumn("similarity", F.get("_r", F.lit(0))["s"]).withColumn("second_topic", F.get("_r", F.lit(1))["t"]).withColumn("margin", F.col("similarity") - F.get("_r", F.lit(1))["s"])
    single = F.size("_r") == 1
    reason = (
        F.when(F.lit(not rules.enabled), "disabled")
        .when(F.size("_r") == 0, "no_eligible_topic")
        .when(single & (F.col("similarity") >= rules.single_similarity), "reassigned")
        .when(single | (F.col("similarity") < rules.similarity), "below_similarity")
        .when(F.col("margin") < rules.margin, "insufficient_margin")
        .otherwise("reassigned")
    )
    return rows.withColumn("reason", reason).select(order, "best_topic", "similarity", "second_topic", "margin", "reason")


def limited(decisions: DataFrame, order: str, sizes: DataFrame, label: str, outliers: int, rules: Rules) -> DataFrame:
    """The limits per topic and over all, as two rankings instead of a loop.

    The first ranks within topics. Only rows under their topic's limit can count
    towards the global one, and only the first ``cap`` of those matter, so the global ranking takes that many rows.
    """
    cap = -(-int(outliers * rules.global_share * 1_000_000) // 1_000_000)
    by = [F.desc("similarity"), F.desc(F.coalesce("margin", F.lit(0.0))), F.col(order)]
    accepted = decisions.filter("reason = 'reassigned'").join(F.broadcast(sizes.select(F.col(label).alias("best_topic"), "size")), "best_topic")
    limit = F.ceil(F.col("size") * rules.expansion)
    if rules.per_topic is not None:
        limit = F.least(limit, F.lit(rules.per_topic))
    ranked = accepted.withColumn("_over", F.row_number().over(Window.partitionBy("best_topic").orderBy(*by)) > limit)
    key = F.struct((-F.col("similarity")).alias("s"), (-F.coalesce("margin", F.lit(0.0))).alias("m"), F.col(order).alias("o"))
    # the place of the last row that still fits: what comes after it is over the global limit
    fits = ranked.filter("NOT _over").withColumn("_k", key).orderBy("_k").limit(cap)
    last = fits.agg(F.max("_k").alias("_last"), F.count("*").alias("_n"))
    judged = ranked.withColumn("_k", key).crossJoin(F.broadcast(last))
    full = (F.col("_n") >= cap) & (F.lit(cap == 0) | (F.col("_k") > F.col("_last")))
    judged = judged.select(order, F.when(full, "global_limit").when(F.col("_over"), "topic_limit").otherwise("reassigned").alias("_r"))
    return decisions.join(judged, order, "left").withColumn("reason", F.coalesce("_r", "reason")).drop("_r")


def final_labels(df: DataFrame, order: str, label: str, probability: str, decisions: DataFrame) -> DataFrame:
    """``df`` with final_label and confidence."""
    done = decisions.filter("reason = 'reassigned'").select(F.col(order).alias("_o"), "best_topic", "similarity")
    joined = df.join(done, F.col(order) == F.col("_o"), "left")
    return joined.withColumn("final_label", F.coalesce("best_topic", F.col(label).cast("long"))).withColumn("confidence", F.coalesce("similarity", probability)).withColumn("reassigned", F.col("_o").isNotNull()).drop("_o", "best_topic", "similarity")


def final_summary(df: DataFrame) -> DataFrame:
    """A20."""
    inside = df.filter("final_label >= 0")
    return inside.groupBy("final_label").agg(F.count_if(~F.col("reassigned")).alias("original"), F.count_if("reassigned").alias("reassigned"), F.round(F.count_if("reassigned") / F.greatest(F.count_if(~F.col("reassigned")), F.lit(1)), 6).alias("expansion"), F.round(F.avg(F.when(F.col("reassigned"), F.col("confidence"))), 6).alias("mean_similarity"), F.round(F.min(F.when(F.col("reassigned"), F.col("confidence"))), 6).alias("min_similarity"))


def metrics(decisions: DataFrame, topics: DataFrame) -> DataFrame:
    """Outliers, reassigned, their share, mean margin, the share of the topic that receives most, and topics that were excluded; one row."""
    done = decisions.filter("reason = 'reassigned'")
    largest = done.groupBy("best_topic").agg(F.count("*").alias("n")).agg(F.max("n").alias("largest"))
    counts = decisions.agg(F.count("*").alias("outliers"), F.count_if(F.col("reason") == "reassigned").alias("reassigned"), F.round(F.avg(F.when(F.col("reason") == "reassigned", F.col("margin"))), 6).alias("mean_margin"))
    excluded = topics.agg(F.count_if(F.col("reason").isNotNull()).alias("excluded_topics"))
    one = counts.crossJoin(largest).crossJoin(excluded)  # one row each
    share = lambda a, b: F.round(F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0)), 6)
    return one.select("outliers", "reassigned", share("reassigned", "outliers").alias("reassigned_share"), "mean_margin", share("largest", "reassigned").alias("dominant_share"), "excluded_topics")


def reasons(decisions: DataFrame) -> DataFrame:
    """A21."""
    return decisions.groupBy("reason").agg(F.count("*").alias("n"))
