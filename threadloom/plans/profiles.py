"""Profiling queries."""

from pyspark.sql import functions as F

from threadloom.functions import scalars as S
from threadloom.functions import text as T
from threadloom.operators import profiling as O
from threadloom.plans.registry import query
from threadloom.plans.texts import fold, squeeze
from threadloom.sources.tables import table

KEY = squeeze(fold("text"))
QUANTILES = (0.25, 0.5, 0.75, 0.9, 0.95)


def quantile(values: str, f: float) -> str:
    return f"{values}[round_even((len({values}) - 1) * {f}, 0)::INTEGER + 1]"


@query(f"""WITH k AS (SELECT doc_id, source, lang, {KEY} AS key FROM documents), g AS (SELECT key, count(*) AS n FROM k GROUP BY key)
SELECT (SELECT count(*) FROM k) AS n_rows, (SELECT count(DISTINCT doc_id) FROM k) AS n_ids, count(*) AS n_texts, count(*) FILTER (WHERE n > 1) AS n_groups, max(n) AS largest, sum(n - 1)::BIGINT AS n_duplicates,
(SELECT count(DISTINCT source) FROM k) AS n_sources, (SELECT count(DISTINCT lang) FROM k) AS n_langs FROM g""")
def a07_inspection_profile(spark, d):
    return O.inspection(table(spark, d, "documents"), "doc_id", "text", ["source", "lang"]).withColumnsRenamed({"n_source": "n_sources", "n_lang": "n_langs"})


@query(f"""WITH v AS (SELECT list(length(text) ORDER BY length(text)) AS l FROM documents)
SELECT len(l) AS n, l[1] AS min_len, l[-1] AS max_len, round(list_avg(l), 6) AS mean_len, {', '.join(f"{quantile('l', f)} AS p{int(f * 100)}" for f in QUANTILES)},
len(list_filter(l, lambda x: x < 5)) AS below_5, len(list_filter(l, lambda x: x < 20)) AS below_20, len(list_filter(l, lambda x: x > 1000)) AS above_1000, len(list_filter(l, lambda x: x > 10000)) AS above_10000 FROM v""")
def a08_length_stats(spark, d):
    return O.length_statistics(table(spark, d, "documents").select(F.char_length("text").cast("long").alias("n")), "n", QUANTILES)


@query(f"""WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY 1), v AS (SELECT list(n ORDER BY n) AS l FROM c)
SELECT len(l) AS n, l[1] AS min_n, l[-1] AS max_n, round(list_avg(l), 6) AS mean_n, {', '.join(f"{quantile('l', f)} AS p{int(f * 100)}" for f in QUANTILES)} FROM v""")
def a09_per_group_summary(spark, d):
    counts = table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return O.number_summary(counts, "n", QUANTILES)


@query("""SELECT CASE WHEN length(text) <= 20 THEN '<=20' WHEN length(text) <= 50 THEN '<=50' WHEN length(text) <= 100 THEN '<=100' WHEN length(text) <= 200 THEN '<=200' WHEN length(text) <= 500 THEN '<=500'
WHEN length(text) <= 1000 THEN '<=1000' ELSE '>1000' END AS bucket, count(*) AS n FROM documents GROUP BY 1""")
def a10_length_histogram(spark, d):
    return table(spark, d, "documents").groupBy(O.bucket(F.char_length("text"), O.LENGTHS).alias("bucket")).agg(F.count("*").alias("n"))


@query("SELECT strftime(ts, '%Y-%m') AS month, event_type, count(*) AS n FROM events GROUP BY ALL")
def a11_monthly(spark, d):
    """A11, T08, F17."""
    return table(spark, d, "events").groupBy(S.month(F.col("ts")).alias("month"), "event_type").agg(F.count("*").alias("n"))


@query(r"""SELECT category, n FROM (SELECT count(*) FILTER (WHERE trim(text) = '') AS empty, count(*) FILTER (WHERE regexp_matches(text, '(?i)https?://|www\.')) AS contains_url,
count(*) FILTER (WHERE length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) / nullif(length(regexp_replace(text, '[^\p{L}]', '', 'g')), 0) > 0.8) AS mostly_uppercase FROM documents) UNPIVOT (n FOR category IN (empty, contains_url, mostly_uppercase))""")
def a11_noise_categories(spark, d):
    """Overlapping categories in one pass."""
    return O.noise_categories(table(spark, d, "documents"), "text", ["empty", "contains_url", "mostly_uppercase"])


@query("""SELECT field, n FROM (SELECT count(*) FILTER (WHERE coalesce(trim(lang), '') = '') AS lang, count(*) FILTER (WHERE coalesce(trim(source), '') = '') AS source, count(*) FILTER (WHERE coalesce(trim(text), '') = '') AS text FROM documents)
UNPIVOT (n FOR field IN (lang, source, text))""")
def p09_missing_fields(spark, d):
    return O.missing(table(spark, d, "documents"), ["lang", "source", "text"])


@query("""SELECT sha256(source) AS key, n FROM (SELECT source, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY 1 ORDER BY n DESC, first LIMIT 5)""")
def w05_top_groups(spark, d):
    top = O.top_counts(table(spark, d, "documents"), "source", "doc_id", 5)
    return top.select(F.sha2("source", 256).alias("key"), "n")


@query(r"""SELECT lang, sum(len(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')))::BIGINT AS n_tokens, count(*) AS n FROM documents GROUP BY 1""")
def f10_token_counts(spark, d):
    return table(spark, d, "documents").groupBy("lang").agg(F.sum(F.size(T.tokens(F.lower("text")))).alias("n_tokens"), F.count("*").alias("n"))


@query("""SELECT (SELECT count(*) FROM documents) AS actual, abs((SELECT count(*) FROM documents) - 1000) / 1000.0 <= 0.1 AS within_tolerance""")
def f27_expected_count(spark, d):
    n = table(spark, d, "documents").agg(F.count("*").alias("actual"))
    return n.select("actual", S.within(F.col("actual"), F.lit(1000), F.lit(0.1)).alias("within_tolerance"))
