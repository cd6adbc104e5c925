"""Quality evaluation and privacy-safe export."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import scalars as S
from threadloom.functions import text as T
from threadloom.operators.topics import PARTS, centroid_pairs, centroids


def silhouette(df: DataFrame, label: str, vector: str) -> DataFrame:
    """Mean cosine silhouette, outliers dropped. The mean distance to a cluster is one less the product with its mean unit vector, so a row meets each cluster once."""
    rows = df.filter(F.col(label) >= 0).select(F.col(label).alias("l"), S.unit(F.col(vector)).alias("u"))
    each = rows.select("l", F.posexplode("u").alias("i", "x")).groupBy("l", "i").agg(F.sum("x").alias("x"), F.count("*").alias("n"))
    sums = each.groupBy("l").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda t: t["x"]).alias("s"), F.max("n").alias("n"))
    listed = sums.agg(F.collect_list(F.struct("l", "s", "n")).alias("c"))
    joined = rows.crossJoin(F.broadcast(listed))  # one row with an entry per cluster
    own = F.get(F.filter("c", lambda c: c["l"] == F.col("l")), F.lit(0))
    inner = F.when(own["n"] > 1, (own["n"] - S.dot(F.col("u"), own["s"])) / (own["n"] - 1))
    outer = F.array_min(F.transform(F.filter("c", lambda c: c["l"] != F.col("l")), lambda c: 1 - S.dot(F.col("u"), c["s"]) / c["n"]))
    values = joined.select(inner.alias("a"), outer.alias("b"))
    return values.agg(F.round(F.avg(F.when(F.col("a").isNull(), 0.0).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))), 6).alias("silhouette"))


def geometry(df: DataFrame, label: str, vector: str) -> DataFrame:
    """Cosine silhouette, Calinski-Harabasz and Davies-Bouldin of the raw vectors, mean similarity within clusters and largest between centroids; null under two clusters."""
    rows = df.filter(F.col(label) >= 0).select(F.col(label).alias("l"), F.transform(vector, lambda x: x.cast("double")).alias("v"))
    each = rows.select("l", F.posexplode("v").alias("i", "x"))
    means = each.groupBy("l", "i").agg(F.avg("x").alias("m"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"), F.count("*").alias("n"))
    total = means.groupBy("i").agg((F.sum("s") / F.sum("n")).alias("g"))
    per = means.join(F.broadcast(total), "i").groupBy("l").agg(F.max("n").alias("n"), F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("within"), (F.max("n") * F.sum((F.col("m") - F.col("g")) * (F.col("m") - F.col("g")))).alias("between"))
    sizes = per.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("within").alias("w"), F.sum("between").alias("b"))
    calinski = sizes.select(F.round((F.col("b") / (F.col("k") - 1)) / (F.col("w") / (F.col("n") - F.col("k"))), 6).alias("calinski_harabasz"))
    mean_vectors = means.groupBy("l").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda t: t["m"]).alias("c"))
    apart = lambda a, b: F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    spread = rows.join(F.broadcast(mean_vectors), "l").groupBy("l").agg(F.avg(apart(F.col("v"), F.col("c"))).alias("d"), F.first("c").alias("c"))
    a, b = spread.select(F.col("l").alias("a"), F.col("d").alias("da"), F.col("c").alias("ca")), spread.select(F.col("l").alias("b"), F.col("d").alias("db"), F.col("c").alias("cb"))
    worst = a.join(F.broadcast(b), F.col("a") != F.col("b")).groupBy("a").agg(F.max((F.col("da") + F.col("db")) / apart(F.col("ca"), F.col("cb"))).alias("r"))
    davies = worst.agg(F.round(F.avg("r"), 6).alias("davies_bouldin"))
    found = centroids(df.filter(F.col(label) >= 0), label, vector, at_unit=True).drop("members")
    within = df.filter(F.col(label) >= 0).select(label, S.unit(F.col(vector)).alias("u")).join(F.broadcast(found), label).agg(F.round(F.avg(S.dot(F.col("u"), F.col("centroid"))), 6).alias("mean_intra_similarity"))
    nearest = centroid_pairs(found, label).agg(F.round(F.max("similarity"), 6).alias("max_centroid_similarity"))
    return silhouette(df, label, vector).crossJoin(calinski).crossJoin(davies).crossJoin(within).crossJoin(nearest)  # one row each


def contingency(df: DataFrame, left: str, right: str) -> DataFrame:
    """(left, right, n) with shares of either side and flags: split if no right holds half of the left, merge if no left holds half of the right."""
    n = df.groupBy(left, right).agg(F.count("*").alias("n"))
    a, b = n.groupBy(left).agg(F.sum("n").alias("_a"), F.max("n").alias("_ma")), n.groupBy(right).agg(F.sum("n").alias("_b"), F.max("n").alias("_mb"))
    x = n.join(F.broadcast(a), left).join(F.broadcast(b), right)
    return x.select(left, right, "n", F.round(F.col("n") / F.col("_a"), 6).alias("left_share"), F.round(F.col("n") / F.col("_b"), 6).alias("right_share"), (F.col("_ma") * 2 < F.col("_a")).alias("split"), (F.col("_mb") * 2 < F.col("_b")).alias("merged"))


def agreement(df: DataFrame, left: str, right: str) -> DataFrame:
    """Adjusted Rand index and normalised mutual information (arithmetic mean), from the contingency table. Two labellings of one label each, or of none equal, agree wholly (1.0); no rows give nulls."""
    n = df.groupBy(F.col(left).alias("_l"), F.col(right).alias("_r")).agg(F.count("*").cast("double").alias("n"))
    pairs = lambda c: F.sum(F.col(c) * (F.col(c) - 1) / 2)
    a, b = n.groupBy("_l").agg(F.sum("n").alias("a")), n.groupBy("_r").agg(F.sum("n").alias("b"))
    total = n.agg(F.sum("n").alias("t"), pairs("n").alias("pn"))
    x = n.join(F.broadcast(a), "_l").join(F.broadcast(b), "_r").crossJoin(F.broadcast(total))
    mutual = x.agg(F.sum(F.col("n") / F.col("t") * F.log(F.col("n") * F.col("t") / (F.col("a") * F.col("b")))).alias("mi"))
    sides = [s.crossJoin(F.broadcast(total)).agg(pairs(c).alias(f"p{c}"), (-F.sum(F.col(c) / F.col("t") * F.log(F.col(c) / F.col("t")))).alias(f"h{c}")) for s, c in ((a, "a"), (b, "b"))]
    one = mutual.crossJoin(sides[0]).crossJoin(sides[1]).crossJoin(total)
    chance = F.when(F.col("t") > 1, F.try_divide(F.col("pa") * F.col("pb"), F.col("t") * (F.col("t") - 1) / 2)).otherwise(0.0)
    ratio = lambda a, b: F.when(F.col("t").isNotNull(), F.when(b == 0, 1.0).otherwise(F.try_divide(a, b)))
    ari = ratio(F.col("pn") - chance, (F.col("pa") + F.col("pb")) / 2 - chance)
    return one.select(F.round(ari, 6).alias("ari"), F.round(ratio(2 * F.col("mi"), F.col("ha") + F.col("hb")), 6).alias("nmi"))


def assignment(cost: np.ndarray) -> list[tuple[int, int]]:
    """The one-to-one matching of least cost, by shortest augmenting paths with potentials; for matrices as small as the number of topics."""
    flip = cost.shape[0] > cost.shape[1]
    c = cost.T if flip else cost
    n, m = c.shape
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        match[0], j, least, way, seen = i, 0, np.full(m + 1, np.inf), np.zeros(m + 1, int), np.zeros(m + 1, bool)
        while match[j]:
            seen[j] = True
            row, open_ = match[j], ~seen
            open_[0] = False
            reduced = np.append(np.inf, c[row - 1] - u[row] - v[1:])
            better = open_ & (reduced < least)
            least[better], way[better] = reduced[better], j
            nxt = int(np.flatnonzero(open_)[np.argmin(least[open_])])
            step = least[nxt]
            u[match[seen]] += step
            v[seen] -= step
            least[open_] -= step
            j = nxt
        while j:
            match[j], j = match[way[j]], way[j]
    out = [(int(match[j]) - 1, j - 1) for j in range(1, m + 1) if match[j]]
    return sorted((b, a) for a, b in out) if flip else sorted(out)


def matched(contingent: DataFrame, left: str, right: str) -> DataFrame:
    """(left, right, overlap, retention) of the one-to-one matching of clusters with the largest overlap, outliers apart. A row per pair of clusters reaches the driver."""
    rows = contingent.filter((F.col(left) >= 0) & (F.col(right) >= 0)).select(left, right, "n").collect()
    a, b = sorted({r[left] for r in rows}), sorted({r[right] for r in rows})
    overlap = np.zeros((len(a), len(b)))
    for r in rows:
        overlap[a.index(r[left]), b.index(r[right])] = r["n"]
    size = overlap.sum(axis=1)
    out = [(a[i], b[j], int(overlap[i, j]), round(float(overlap[i, j] / size[i]), 6)) for i, j in (assignment(-overlap) if rows else []) if overlap[i, j]]
    return contingent.sparkSession.createDataFrame(out, "left long, right long, overlap long, retention double")


def suspicious(keywords: Column) -> Column:
    """How many keywords look like an address or a phone number."""
    return F.size(F.filter(keywords, lambda k: T.has_email(k) | T.has_phone(k)))


def export_counts(final: DataFrame) -> DataFrame:
    """(final_label, records, reassigned)."""
    return final.filter("final_label >= 0").groupBy("final_label").agg(F.count("*").alias("records"), F.count_if("reassigned").alias("reassigned"))


def research_assignments(final: DataFrame, key: str, public: list[Column], provenance: DataFrame, provenance_key: str) -> DataFrame:
    """The public columns with each record's id and what ``provenance`` says of it; only for who asks for it."""
    known = provenance.withColumnRenamed(provenance_key, "record_id")
    return final.select(F.col(key).alias("record_id"), *public).join(known, "record_id")


def verdict(failures: list[str], warnings: list[str], preliminary: bool) -> str:
    """M17."""
    return "fail" if failures else "pass_with_warnings" if warnings or preliminary else "pass"


def manual_metrics(df: DataFrame, matches: Column, sensitive: Column) -> DataFrame:
    """Shares over the reviewed rows, precision over those with a verdict."""
    return df.agg(F.count("*").alias("reviewed"), F.round(F.avg(matches.cast("double")), 6).alias("precision"), F.round(F.avg(F.when(sensitive, 1.0).otherwise(0.0)), 6).alias("sensitive_share"))


def review_sample(df: DataFrame, label: str, order: str, reassigned: Column, per_topic: int = 5, topics: int = 20, outliers: int = 20) -> DataFrame:
    """The first rows of each topic, one of them reassigned if the topic has any, and the first outliers.

    The first reassigned row replaces the candidate before it even where there is room; where it comes first, it is simply kept.
    Of each of ``PARTS`` parts of a topic only the first rows and the first reassigned one can matter, so no task sorts a whole topic.
    """
    part = Window.partitionBy(label, F.pmod(F.xxhash64(order), F.lit(PARTS)))
    inside = df.filter((F.col(label) >= 0) & (F.col(label) < topics)).withColumn("_r", reassigned)
    inside = inside.withColumn("_k", F.row_number().over(part.orderBy(order))).withColumn("_p", F.min(F.when(F.col("_r"), F.col("_k"))).over(part))
    inside = inside.filter((F.col("_k") <= per_topic + 1) | (F.col("_k") == F.col("_p"))).drop("_k", "_p")
    p = F.min(F.when(F.col("_r"), F.col("_n"))).over(Window.partitionBy(label))
    ranked = inside.withColumn("_n", F.row_number().over(Window.partitionBy(label).orderBy(order)))
    kept = ranked.withColumn("_p", p).withColumn("_drop", F.when(F.col("_p") > 1, F.least(F.col("_p") - 1, F.lit(per_topic))))
    kept = kept.filter(F.col("_drop").isNull() | (F.col("_n") != F.col("_drop")))
    place = F.when(F.col("_n") == F.col("_p"), F.least("_n", F.lit(per_topic))).otherwise(F.col("_n"))
    first = kept.withColumn("_f", F.row_number().over(Window.partitionBy(label).orderBy(place, "_n")))
    chosen = first.filter(F.col("_f") <= per_topic).select(*df.columns)
    return chosen.unionByName(df.filter(F.col(label) == -1).orderBy(order).limit(outliers))


def public_assignments(df: DataFrame, record: Column, label: Column, confidence: Column, reassigned: Column) -> DataFrame:
    """A hashed id, the topic or null, and where it comes from; nothing else."""
    source = F.when(label < 0, "outlier").when(reassigned, "reassigned").otherwise("original")
    return df.select(F.sha2(record, 256).alias("record_hash"), F.when(label >= 0, label).alias("topic_id"), F.round(confidence, 6).alias("confidence"), source.alias("source"))


def safe_keywords(keywords: Column, maximum: int = 10) -> Column:
    """Keywords without what looks like an address or a phone number, then cut."""
    return F.slice(F.filter(keywords, lambda k: ~T.has_email(k) & ~T.has_phone(k)), 1, maximum)


def safe_name(name: Column, keywords: Column, topic: Column) -> Column:
    """The name, or one made of the safe keywords, or of the number."""
    unsafe = T.has_email(name) | T.has_phone(name)
    return F.when(~unsafe, name).when(F.size(keywords) > 0, S.topic_name(keywords)).otherwise(F.concat(F.lit("Topic "), topic.cast("string")))


def reference_errors(annotations: DataFrame, key: str, rows: DataFrame, row_key: str) -> DataFrame:
    """Annotations of rows that aren't there, and rows annotated twice."""
    lost = annotations.join(rows.select(F.col(row_key).alias("_k")), F.col(key) == F.col("_k"), "left_anti").agg(F.count("*").alias("unknown"))
    twice = annotations.groupBy(key).agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("repeated"))
    return lost.crossJoin(twice)  # one row each


def uncovered(decisions: DataFrame, key: str, outliers: DataFrame, outlier_key: str) -> DataFrame:
    """Outliers without a decision and decisions about no outlier."""
    both = decisions.select(F.col(key).alias("a")).join(outliers.select(F.col(outlier_key).alias("b")), F.col("a") == F.col("b"), "full_outer")
    return both.agg(F.count_if(F.col("a").isNull()).alias("undecided"), F.count_if(F.col("b").isNull()).alias("stray"))


