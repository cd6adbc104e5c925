"""Topics over clustered vectors and texts."""

from __future__ import annotations

import pandas as pd
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from threadloom.functions import scalars as S
from threadloom.sources.shared import materialise
from threadloom.sources.tables import spread

#: Parts of a topic that are ordered apart before the whole is.
PARTS = 64
TERM = r"[\p{L}\p{N}_][\p{L}\p{N}_-]*[\p{L}\p{N}_]"


def label_order(df: DataFrame, label: str, order: str) -> DataFrame:
    """(label, new_label): clusters by size, then first row, then label, numbered from 0; -1 stays. A row per label is all that is sorted."""
    sizes = df.filter(F.col(label) >= 0).groupBy(label).agg(F.count("*").alias("_n"), F.min(order).alias("_first"))
    numbered = sizes.withColumn("new_label", (F.row_number().over(Window.orderBy(F.desc("_n"), "_first", label)) - 1).cast("long")).select(label, "new_label")
    return numbered.union(df.filter(F.col(label) < 0).select(label, F.lit(-1).cast("long").alias("new_label")).distinct())


def centroids(df: DataFrame, label: str, vector: str, at_unit: bool = False) -> DataFrame:
    """(label, centroid, members): summed vectors (or unit vectors) at length one. Sums are partial per task, by label and dimension."""
    v = S.unit(F.col(vector)) if at_unit else F.col(vector)
    each = df.select(label, F.posexplode(v).alias("_i", "_x")).groupBy(label, "_i").agg(F.sum(F.col("_x").cast("double")).alias("_x"), F.count("*").alias("_n"))
    whole = each.groupBy(label).agg(F.sort_array(F.collect_list(F.struct("_i", "_x"))).alias("_v"), F.max("_n").alias("members"))
    return whole.select(label, S.unit(F.transform("_v", lambda x: x["_x"])).alias("centroid"), "members")


def with_probability(df: DataFrame, label: str, vector: str) -> DataFrame:
    """A membership probability for given labels: the cosine to the own centroid, within [0, 1]."""
    c = centroids(df, label, vector).drop("members")
    return df.join(F.broadcast(c), label).withColumn("probability", F.greatest(F.lit(0.0), F.least(F.lit(1.0), S.cosine(F.col(vector), F.col("centroid"))))).drop("centroid")


def cluster_summary(df: DataFrame, label: str, probability: str, order: str, total: int) -> DataFrame:
    """A16."""
    return df.filter(F.col(label) >= 0).groupBy(label).agg(
        F.count("*").alias("size"),
        F.round(F.count("*") / total, 6).alias("share"),
        F.round(F.avg(probability), 6).alias("mean_probability"),
        F.round(F.percentile(probability, 0.5), 6).alias("median_probability"),
        F.round(F.min(probability), 6).alias("min_probability"),
        F.min(order).alias("first_row"),
    )


def cluster_metrics(df: DataFrame, label: str, probability: str, min_size: int, low: float) -> DataFrame:
    """An aggregate of the per-cluster aggregate."""
    sizes = df.groupBy(label).agg(F.count("*").alias("n"), F.count_if(F.col(probability) < low).alias("low"))
    inside = F.col(label) >= 0
    size = F.when(inside, F.col("n"))
    return sizes.agg(
        F.count(size).alias("n_clusters"),
        F.round(F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)) / F.sum("n"), 6).alias("outlier_share"),
        F.min(size).alias("min_size"),
        F.max(size).alias("max_size"),
        F.percentile(size, 0.5).alias("median_size"),
        F.round(F.max(size) / F.sum(size), 6).alias("dominant_share"),
        F.count_if(inside & (F.col("n") < 2 * min_size)).alias("n_micro"),
        F.sum("low").alias("n_low"),
    )


def centroid_pairs(c: DataFrame, label: str) -> DataFrame:
    """(left, right, similarity) of different centroids; as many rows as pairs of topics."""
    a, b = c.select(F.col(label).alias("left"), F.col("centroid").alias("_a")), c.select(F.col(label).alias("right"), F.col("centroid").alias("_b"))
    return a.join(F.broadcast(b), F.col("left") < F.col("right")).select("left", "right", S.dot(F.col("_a"), F.col("_b")).alias("similarity"))


def stop_words(*languages: str) -> list[str]:
    """M10."""
    return sorted({w for lang in languages for w in StopWordsRemover.loadDefaultStopWords(lang)})


def topic_terms(df: DataFrame, topic: str, text: str, stop: list[str], ngrams: int = 2) -> DataFrame:
    """(topic, term, tf): counts of 1- to n-grams of the words that aren't stop words."""
    kept = F.filter(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)), lambda w: ~w.isin(stop))
    rows = spread(df.select(topic, text)).select(F.col(topic).alias("topic"), kept.alias("w"))
    # a gram of n words is one of n - 1 words and the word behind it; slicing at each place would copy the array each time
    grams = [F.col("w")]
    for n in range(2, ngrams + 1):
        size = F.greatest(F.size("w") - n + 1, F.lit(0))
        grams.append(F.zip_with(F.slice(grams[-1], F.lit(1), size), F.slice("w", F.lit(n), size), lambda a, b: F.concat(a, F.lit(" "), b)))
    return rows.filter(F.size("w") > 0).select("topic", F.explode(F.concat(*grams)).alias("term")).groupBy("topic", "term").agg(F.count("*").alias("tf"))


def ctfidf(terms: DataFrame, min_df: int = 1, max_df: float = 0.95, max_features: int = 50_000, bm25: bool = True, damped: bool = True) -> DataFrame:
    """(topic, term, weight). Documents are topics; features are the most frequent terms within the bounds on document frequency. Writes the terms, which are read five times, once."""
    terms, _ = materialise(terms, "terms")
    topics = terms.agg(F.count_distinct("topic").alias("n_topics"))
    per_term = terms.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("f")).crossJoin(F.broadcast(topics))
    bound = F.when(F.col("n_topics") == 1, F.lit(1.0)).otherwise(F.lit(max_df)) * F.col("n_topics")
    features = per_term.filter((F.col("df") >= min_df) & (F.col("df") <= bound)).orderBy(F.desc("f"), "term").limit(max_features).select("term", "f")
    used = terms.join(features, "term")
    sums = used.groupBy("topic").agg(F.sum("tf").alias("total"))
    mean = sums.agg(F.floor(F.avg("total")).alias("a"))
    x = used.join(F.broadcast(sums), "topic").crossJoin(F.broadcast(mean))
    idf = F.log(1 + (F.col("a") - F.col("f") + 0.5) / (F.col("f") + 0.5)) if bm25 else F.log(F.col("a") / F.col("f") + 1)
    tf = F.col("tf") / F.col("total")
    return x.select("topic", "term", ((F.sqrt(tf) if damped else tf) * idf).alias("weight"))


def top_terms(weights: DataFrame, n: int = 10) -> DataFrame:
    """The n heaviest terms of a topic, weight above zero, ties by term."""
    by = Window.partitionBy("topic").orderBy(F.desc("weight"), "term")
    return weights.filter("weight > 0").withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= n)


def keyword_sets(top: DataFrame) -> DataFrame:
    """(topic, keywords) in rank order, and the topic's name."""
    each = top.groupBy("topic").agg(F.sort_array(F.collect_list(F.struct("rank", "term"))).alias("_k"))
    return each.select("topic", F.transform("_k", lambda x: x["term"]).alias("keywords")).withColumn("name", S.topic_name(F.col("keywords")))


def keyword_pairs(sets: DataFrame) -> DataFrame:
    """Jaccard index of the keywords of each pair of topics."""
    a, b = sets.select(F.col("topic").alias("left"), F.col("keywords").alias("_a")), sets.select(F.col("topic").alias("right"), F.col("keywords").alias("_b"))
    return a.join(F.broadcast(b), F.col("left") < F.col("right")).select("left", "right", S.jaccard(F.col("_a"), F.col("_b")).alias("jaccard"))


def topic_quality(sets: DataFrame) -> DataFrame:
    """A24."""
    terms = sets.select("topic", F.explode_outer("keywords").alias("term"))
    names = sets.filter(F.size("keywords") > 0).groupBy("name").agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("duplicate_names"))
    found = terms.agg(F.round(F.count_distinct("term") / F.greatest(F.count("term"), F.lit(1)), 6).alias("diversity"), F.count_distinct("topic").alias("n_topics"), F.count_distinct(F.when(F.col("term").isNull(), F.col("topic"))).alias("empty_topics"))
    return found.crossJoin(names)


def topic_documents(df: DataFrame, topic: str, text: str, order: str, budget: int) -> DataFrame:
    """(topic, document, truncated): texts joined by newlines until the budget of characters runs out.

    A text counts only while the sum before it is under the budget, and at most ``budget`` texts of one
    character or more can; empty ones cost nothing. A topic is first cut in ``PARTS`` parts of its rows, each by the
    same rule, as what a part's own rows push out is out of the whole; so no task sorts a whole topic.
    """
    length = F.char_length(text)
    running = lambda *by: F.coalesce(F.sum("_len").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    narrow = df.select(topic, order, F.expr(f"left({text}, {budget})").alias(text), length.alias("_len")).withColumn("_part", F.pmod(F.xxhash64(order), F.lit(PARTS)))
    first = narrow.withColumn("_before", running(topic, "_part")).filter(F.col("_before") < budget)
    before = running(topic)
    cut = first.withColumn("_before", before).withColumn("_cut", F.expr(f"left({text}, cast(greatest(0, {budget} - _before) as int))"))
    total = df.groupBy(topic).agg((F.sum(F.char_length(text)) > budget).alias("truncated"))
    parts = cut.filter((F.col("_before") < budget) & (F.col("_cut") != "")).groupBy(topic).agg(F.sort_array(F.collect_list(F.struct(order, "_cut"))).alias("_p"))
    return parts.join(total, topic).select(topic, F.array_join(F.transform("_p", lambda x: x["_cut"]), "\n").alias("document"), "truncated")


def candidates(df: DataFrame, label: str, probability: str, similarity: Column, order: str, least: float, n: int) -> DataFrame:
    """W09, first half: the n best rows of a topic by the mean of probability and similarity."""
    scored = df.filter((F.col(label) >= 0) & (F.col(probability) >= least)).withColumn("score", F.round((F.col(probability) + similarity) / 2, 9))
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy(label).orderBy(F.desc("score"), order))).filter(F.col("rank") <= n)


def representatives(df: DataFrame, label: str, video: str, author: str, k: int = 5) -> DataFrame:
    """W09, second half: greedy choice among a topic's candidates (at most k x 20 rows); used videos and authors are passed over, then gaps are filled by score."""
    schema = df.select(label, "rank").schema.add("position", IntegerType())

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rank")
        chosen, videos, authors = [], set(), set()
        for r in rows.itertuples():
            if len(chosen) < k and getattr(r, video) not in videos and getattr(r, author) not in authors:
                chosen.append(r.rank)
                videos.add(getattr(r, video))
                authors.add(getattr(r, author))
        chosen += [r for r in rows["rank"] if r not in chosen][: k - len(chosen)]
        return pd.DataFrame({label: rows[label].iloc[0], "rank": chosen, "position": range(1, len(chosen) + 1)})

    return df.select(label, "rank", video, author).groupBy(label).applyInPandas(run, schema)
