"""Relational read queries."""

from pyspark.sql import functions as F

from threadloom.functions import scalars as S
from threadloom.operators import relational as R
from threadloom.plans.registry import NOW, query
from threadloom.sources.tables import table


@query("""SELECT c_custkey, c_name, count(o_orderkey) AS n_documents, CASE WHEN count(o_orderkey) > 0 THEN 'processed' ELSE 'pending' END AS status
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL""")
def j01_source_document_count(spark, d):
    counted = R.with_child_count(table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", table(spark, d, "orders"), "o_custkey", "n_documents")
    return counted.withColumn("status", F.when(F.col("n_documents") > 0, "processed").otherwise("pending"))  # V18


@query("""SELECT o_orderkey, o_orderdate, c_name FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderdate >= TIMESTAMP '1998-01-01'""")
def j02_documents_with_source(spark, d):
    orders = table(spark, d, "orders").filter(F.col("o_orderdate") >= F.to_timestamp(F.lit("1998-01-01"))).select("o_orderkey", "o_custkey", "o_orderdate")
    customers = R.small(table(spark, d, "customer").select("c_custkey", "c_name"))
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderdate", "c_name")


@query("""SELECT max(doc_id) AS doc_id, lower(text) AS text_key FROM documents WHERE lower(text) NOT IN (SELECT lower(text) FROM benchmark) GROUP BY lower(text)""")
def j03_new_external_ids(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.lower("text").alias("text_key"))
    return R.new_rows(docs, "text_key", table(spark, d, "benchmark").select(F.lower("text").alias("known")), "known", "doc_id").select("doc_id", "text_key")


@query("""SELECT doc_id, n_chars, (SELECT count(*) FROM documents WHERE text ILIKE '%the%') AS total
FROM documents WHERE text ILIKE '%the%' ORDER BY n_chars DESC, doc_id LIMIT 20 OFFSET 20""")
def p03_search_page(spark, d):
    found = table(spark, d, "documents").filter(R.contains_any([F.col("text")], "the")).select("doc_id", "n_chars")
    return R.page(found, [F.col("n_chars").desc(), F.col("doc_id")], 20, 20)


@query("""SELECT event_id, event_type, json_extract_string(props, '$.k') AS k FROM events WHERE event_type ILIKE '%pur%' OR json_extract_string(props, '$.k') ILIKE '%9%'""")
def p04_name_or_json_search(spark, d):
    k = F.get_json_object("props", "$.k")
    events = table(spark, d, "events").select("event_id", "event_type", k.alias("k"))
    return events.filter(F.col("event_type").ilike("%pur%") | R.contains_any([F.col("k")], "9"))


@query(f"""SELECT days, count(*) FILTER (WHERE days = 0 OR ts >= TIMESTAMP '{NOW}' - to_days(CAST(days AS INTEGER))) AS n
FROM events, (VALUES (0), (1), (7), (30)) v(days) GROUP BY days""")
def p06_recent_events(spark, d):
    events = table(spark, d, "events")
    counts = [F.count_if(R.since(F.col("ts"), NOW, days or None)).alias(f"d{days}") for days in (0, 1, 7, 30)]
    return events.agg(*counts).selectExpr("stack(4, 0, d0, 1, d1, 7, d7, 30, d30) AS (days, n)")


@query(f"""SELECT count(*) AS n_all, count(*) FILTER (WHERE event_type = 'error') AS n_failed, count(*) FILTER (WHERE ts >= TIMESTAMP '{NOW}' - INTERVAL 7 DAY) AS n_recent,
count(*) FILTER (WHERE event_type IN ('view', 'click') AND value IS NOT NULL) AS n_read FROM events""")
def a02_dashboard_counts(spark, d):
    """The counts of a dashboard in one pass."""
    return table(spark, d, "events").agg(
        F.count("*").alias("n_all"),
        F.count_if(F.col("event_type") == "error").alias("n_failed"),
        F.count_if(R.since(F.col("ts"), NOW, 7)).alias("n_recent"),
        F.count_if(F.col("event_type").isin("view", "click") & F.col("value").isNotNull()).alias("n_read"),
    )


@query("SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT event_type) AS n_types FROM events")
def a03_distinct_active(spark, d):
    return table(spark, d, "events").agg(F.count_distinct("user_id").alias("n_users"), F.count_distinct("event_type").alias("n_types"))


@query("SELECT c_custkey, count(o_orderkey) AS n FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1 HAVING count(o_orderkey) > 5")
def a04_having_processed(spark, d):
    counted = R.with_child_count(table(spark, d, "customer").select("c_custkey"), "c_custkey", table(spark, d, "orders"), "o_custkey", "n")
    return counted.filter("n > 5")


@query("SELECT c_custkey, CAST(0 AS BIGINT) AS n FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def a04_having_pending(spark, d):
    counted = R.with_child_count(table(spark, d, "customer").select("c_custkey"), "c_custkey", table(spark, d, "orders"), "o_custkey", "n")
    return counted.filter("n = 0")


@query("""SELECT json_extract_string(props, '$.k') AS k, count(*) AS n, max(ts) AS last_ts FROM events
WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY 1 ORDER BY last_ts DESC, k""")
def a05_query_history(spark, d):
    """A05, P08."""
    events = table(spark, d, "events").select(F.get_json_object("props", "$.k").alias("k"), "ts").filter("k IS NOT NULL")
    return events.groupBy("k").agg(F.count("*").alias("n"), F.max("ts").alias("last_ts")).orderBy(F.desc("last_ts"), "k")


@query("SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def u06_last_value_wins(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.max("event_id").alias("event_id"), F.max_by("event_type", "event_id").alias("event_type"))


@query("SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders) AS total FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 25 OFFSET 50")
def w06_paginated_total(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return R.page(orders, [F.col("o_orderdate").desc(), F.col("o_orderkey")], 50, 25).drop("o_orderdate")


@query("""SELECT s_suppkey, s_acctbal > 0 AS is_active FROM supplier ORDER BY CASE WHEN s_acctbal > 0 THEN 0 ELSE 1 END, s_suppkey LIMIT 10""")
def w14_active_first(spark, d):
    rows = table(spark, d, "supplier").select("s_suppkey", (F.col("s_acctbal") > 0).alias("is_active"))
    return rows.orderBy(F.when(F.col("is_active"), 0).otherwise(1), "s_suppkey").limit(10)


@query(f"""SELECT event_id, CASE WHEN event_type = 'view' AND (ts IS NULL OR ts < TIMESTAMP '{NOW}' - INTERVAL 30 MINUTE) THEN 'failed' ELSE event_type END AS status FROM events""")
def t04_stale_reaper(spark, d):
    events = table(spark, d, "events").select("event_id", F.col("event_type").alias("status"), "ts")
    return R.stale(events, "status", "ts", "view", NOW).drop("ts")


@query("""SELECT s_suppkey, left(s_name, 4) || repeat('•', 12) || right(s_name, 4) AS masked FROM supplier""")
def p10_masked_secret(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", S.masked(F.col("s_name")).alias("masked"))


@query("""SELECT c_custkey, n, n / max(n) OVER () AS bar FROM (SELECT o_custkey AS c_custkey, count(*) AS n FROM orders GROUP BY 1)""")
def w17_relative_bars(spark, d):
    counts = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    top = counts.agg(F.max("n").alias("top"))  # one row
    return counts.crossJoin(F.broadcast(top)).select("c_custkey", "n", (F.col("n") / F.col("top")).alias("bar"))


@query("""SELECT DISTINCT page_id, url, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page FROM pages""")
def f16_url_param(spark, d):
    return table(spark, d, "pages").select("page_id", "url", S.url_parameter(F.col("url"), "page").alias("page"))


@query(f"""SELECT event_id, CASE WHEN s < 60 THEN 'just now' WHEN s < 3600 THEN (s // 60) || ' min ago' WHEN s < 86400 THEN (s // 3600) || ' h ago'
WHEN s < 604800 THEN (s // 86400) || ' d ago' ELSE strftime(ts, '%d.%m.%Y') END AS label, format('{{:,}}', event_id * 1000) AS shown
FROM (SELECT *, epoch(TIMESTAMP '{NOW}')::BIGINT - floor(epoch(ts))::BIGINT AS s FROM events)""")
def f18_age_labels(spark, d):
    """F18, F19."""
    return table(spark, d, "events").select("event_id", S.age_label(F.col("ts"), F.to_timestamp(F.lit(NOW))).alias("label"), S.thousands(F.col("event_id") * 1000).alias("shown"))


@query("""SELECT c_name AS source_name, n_name AS source_channel, 'https://video.example/watch?v=' || c_custkey AS source_url, c_custkey::VARCHAR AS source_id, c_mktsegment AS search_query, o_orderkey AS comment_id, o_orderpriority AS comment_text, o_orderstatus AS comment_author,
count(*) FILTER (WHERE l_returnflag = 'R') AS comment_like_count, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS comment_published_at, count(l_linenumber) AS comment_total_reply_count, coalesce(list(l_linenumber::BIGINT ORDER BY l_linenumber) FILTER (WHERE l_linenumber IS NOT NULL), []) AS comment_replies
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY ALL ORDER BY comment_id""")
def k08_export_rows(spark, d):
    """The twelve fields that an export writes as JSON lines: documents with their source, its link and their replies, in order."""
    orders = table(spark, d, "orders").filter(F.col("o_orderdate") >= F.to_timestamp(F.lit("1998-01-01"))).select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    # replies are gathered before the join; an order has a handful
    replies = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count_if(F.col("l_returnflag") == "R").alias("likes"), F.sort_array(F.collect_list(F.col("l_linenumber").cast("long"))).alias("replies"))
    sources = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment").join(R.small(table(spark, d, "nation").select("n_nationkey", "n_name")), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = orders.join(R.small(sources), F.col("o_custkey") == F.col("c_custkey")).join(replies, "o_orderkey", "left")
    none = F.array().cast("array<bigint>")
    return rows.select(
        F.col("c_name").alias("source_name"),
        F.col("n_name").alias("source_channel"),
        F.concat(F.lit("https://video.example/watch?v="), F.col("c_custkey").cast("string")).alias("source_url"),
        F.col("c_custkey").cast("string").alias("source_id"),
        F.col("c_mktsegment").alias("search_query"),
        F.col("o_orderkey").alias("comment_id"),
        F.col("o_orderpriority").alias("comment_text"),
        F.col("o_orderstatus").alias("comment_author"),
        F.coalesce("likes", F.lit(0)).alias("comment_like_count"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("comment_published_at"),
        F.size(F.coalesce("replies", none)).cast("long").alias("comment_total_reply_count"),
        F.coalesce("replies", none).alias("comment_replies"),
    ).orderBy("comment_id")
