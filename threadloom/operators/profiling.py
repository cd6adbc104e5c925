"""Profiles of a table of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import text as T
from threadloom.operators import cleaning as C
from threadloom.sources.tables import spread

LENGTHS = (20, 50, 100, 200, 500, 1000)
DUPLICATES = (2, 3, 5, 10, 50, 100)


def inspection(df: DataFrame, id_col: str, text_col: str, distinct: list[str]) -> DataFrame:
    """Rows, distinct ids, texts and other columns, and the groups of equal texts. Each distinct count is two aggregates."""
    key = T.leakage_key(F.col(text_col))
    groups = spread(df.select(text_col)).groupBy(F.sha2(key, 256).alias("k")).agg(F.count("*").alias("n"))
    of_texts = groups.agg(F.count("*").alias("n_texts"), F.count_if(F.col("n") > 1).alias("n_groups"), F.max("n").alias("largest"), F.sum(F.col("n") - 1).alias("n_duplicates"))
    of_rows = df.agg(F.count("*").alias("n_rows"), F.count_distinct(id_col).alias("n_ids"), *[F.count_distinct(c).alias(f"n_{c}") for c in distinct])
    return of_rows.crossJoin(of_texts)  # one row each


def conflicting_ids(df: DataFrame, id_col: str, text_col: str, order: str) -> DataFrame:
    """Ids that come again with a text other than at their first place."""
    digest = F.sha2(text_col, 256)
    first = df.groupBy(id_col).agg(F.min_by(digest, order).alias("_first"))
    return df.join(first, id_col).filter(digest != F.col("_first")).select(id_col).distinct()


def ranked_values(df: DataFrame, value: str, fractions: tuple[float, ...]) -> DataFrame:
    """The values at the nearest ranks, half-even, of the whole column: (fraction, value).

    Equal values are counted first; the running count over distinct values is
    all that is put in order, so memory follows the distinct values only.
    """
    counts = df.groupBy(F.col(value).alias("v")).agg(F.count("*").alias("c")).filter("v IS NOT NULL")
    total = counts.agg(F.sum("c").alias("n"))
    running = counts.withColumn("upto", F.sum("c").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    wanted = total.select(F.explode(F.array(*[F.struct(F.lit(f).alias("fraction"), (F.rint((F.col("n") - 1) * f) + 1).cast("long").alias("rank")) for f in fractions])).alias("w")).select("w.*")
    met = running.join(F.broadcast(wanted), (F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("c") < F.col("rank")))
    return met.select("fraction", F.col("v").alias("value"))


def _with_quantiles(df: DataFrame, value: str, fractions: tuple[float, ...], aggregates: list[Column]) -> DataFrame:
    wide = ranked_values(df, value, fractions).agg(*[F.max(F.when(F.col("fraction") == f, F.col("value"))).alias(f"p{int(f * 100)}") for f in fractions])
    return df.agg(*aggregates).crossJoin(wide)  # one row each


def length_statistics(df: DataFrame, value: str, fractions: tuple[float, ...]) -> DataFrame:
    """A08."""
    v = F.col(value)
    return _with_quantiles(df, value, fractions, [F.count("*").alias("n"), F.min(v).alias("min_len"), F.max(v).alias("max_len"), F.round(F.avg(v), 6).alias("mean_len"), F.count_if(v < 5).alias("below_5"), F.count_if(v < 20).alias("below_20"), F.count_if(v > 1000).alias("above_1000"), F.count_if(v > 10000).alias("above_10000")])


def number_summary(df: DataFrame, value: str, fractions: tuple[float, ...]) -> DataFrame:
    """A09."""
    v = F.col(value)
    return _with_quantiles(df, value, fractions, [F.count("*").alias("n"), F.min(v).alias("min_n"), F.max(v).alias("max_n"), F.round(F.avg(v), 6).alias("mean_n")])


def bucket(value: Column, bounds: tuple[int, ...]) -> Column:
    """A10: the first bound that isn't exceeded, or beyond the last."""
    chain = None
    for b in bounds:
        chain = F.when(value <= b, f"<={b}") if chain is None else chain.when(value <= b, f"<={b}")
    return chain.otherwise(f">{bounds[-1]}")


def noise_categories(df: DataFrame, text_col: str, wanted: list[str] | None = None) -> DataFrame:
    """(category, n); a text may count in several."""
    text = F.col(text_col)
    tests = {
        "empty": T.strip(text) == "",
        "acknowledgement": C.acknowledgement(text),
        "pipeline_noise": C.noise(text),
        "contains_url": text.rlike(r"(?i)https?://|www\."),
        "repeated_characters": text.rlike(C.REPEATED),
        "mostly_uppercase": C.mostly_uppercase(text),
    }
    tests = {k: v for k, v in tests.items() if wanted is None or k in wanted}
    counts = df.agg(*[F.count_if(v).alias(k) for k, v in tests.items()])
    return counts.selectExpr(f"stack({len(tests)}, {', '.join(f'{k!r}, {k}' for k in tests)}) AS (category, n)")


def missing(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, n) of values that are null or blank."""
    counts = df.agg(*[F.count_if(F.trim(F.coalesce(F.col(f).cast("string"), F.lit(""))) == "").alias(f) for f in fields])
    return counts.selectExpr(f"stack({len(fields)}, {', '.join(f'{f!r}, {f}' for f in fields)}) AS (field, n)")


def top_counts(df: DataFrame, key: str, order: str, k: int) -> DataFrame:
    """The k most frequent keys, ties by first appearance."""
    return df.groupBy(key).agg(F.count("*").alias("n"), F.min(order).alias("_first")).orderBy(F.desc("n"), "_first").limit(k).drop("_first")


def corpus_statistics(df: DataFrame, language: str, source: str) -> DataFrame:
    """(measure, value, n): rows, rows per language, and distinct sources that aren't blank."""
    blank = F.when(F.col(source) != "", F.col(source))
    whole = df.agg(F.count("*").alias("rows"), F.count_distinct(blank).alias("sources")).selectExpr("stack(2, 'rows', '', rows, 'sources', '', sources) AS (measure, value, n)")
    return whole.unionByName(df.groupBy(F.col(language).alias("value")).agg(F.count("*").alias("n")).withColumn("measure", F.lit("language")))
