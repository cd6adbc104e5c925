"""Queries of checks, warnings, languages and small reads. Those over sound tables are joined by damaged copies, so that a fault has to be found."""

from pyspark.sql import functions as F

from threadloom.functions import text as T
from threadloom.operators import evaluation as E
from threadloom.operators import languages as L
from threadloom.operators import profiling as P
from threadloom.operators import relational as R
from threadloom.operators import topics as O
from threadloom.operators import validation as V
from threadloom.plans.registry import query
from threadloom.plans.texts import SPACE
from threadloom.plans.topics import CLUSTERED, TERMS, _candidates, _top, centroid_sql, clustered, embeddings
from threadloom.sources import sinks
from threadloom.sources.shared import materialise, shared_dir
from threadloom.sources.tables import table


@query("""SELECT 'as it is' AS input, CAST(0 AS BIGINT) AS shape, CAST(0 AS BIGINT) AS not_finite, count(*) FILTER (WHERE list_dot_product(embedding, embedding) = 0) AS zero FROM embeddings UNION ALL
SELECT 'damaged', count(*) FILTER (WHERE vec_id % 7 = 0), count(*) FILTER (WHERE vec_id % 7 = 1), count(*) FILTER (WHERE vec_id % 7 = 2) FROM embeddings""")
def v01_matrix_faults(spark, d):
    rows = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    dims = rows.agg(F.max(F.size("v"))).first()[0]
    kind = F.col("vec_id") % 7
    cut = F.when(kind == 0, F.slice("v", 1, 3)).when(kind == 1, F.transform("v", lambda x, i: F.when(i == 0, float("nan")).otherwise(x))).when(kind == 2, F.transform("v", lambda x: x * 0)).otherwise(F.col("v"))
    each = [V.matrix_faults(rows, "v", dims).withColumn("input", F.lit("as it is")), V.matrix_faults(rows.withColumn("v", cut), "v", dims).withColumn("input", F.lit("damaged"))]
    return each[0].unionByName(each[1])


@query("""SELECT count(*) FILTER (WHERE event_id % 9 - 2 < -1) AS bad_labels, count(*) FILTER (WHERE value IS NULL OR value < 0 OR value > 1) AS bad_probabilities FROM events""")
def v02_clusterer_faults(spark, d):
    rows = table(spark, d, "events").select((F.col("event_id") % 9 - 2).alias("label"), "value")
    return V.clusterer_faults(rows, "label", "value")


@query("""SELECT 'as it is' AS input, count(DISTINCT label) AS clusters, (max(label) + 1 - count(DISTINCT label))::BIGINT AS missing, max(label) + 1 = count(DISTINCT label) AS contiguous FROM embeddings WHERE label >= 0 UNION ALL
SELECT 'damaged', count(DISTINCT label), (max(label) + 1 - count(DISTINCT label))::BIGINT, max(label) + 1 = count(DISTINCT label) FROM embeddings WHERE label >= 0 AND label <> 3""")
def v03_label_gaps(spark, d):
    """V03, V09."""
    rows = embeddings(spark, d)
    whole, lost = V.label_gaps(rows, "label"), V.label_gaps(rows.filter("label <> 3"), "label")
    return whole.withColumn("input", F.lit("as it is")).unionByName(lost.withColumn("input", F.lit("damaged")))


@query("""WITH n AS (SELECT count(*) AS n FROM documents), k AS (SELECT CASE WHEN doc_id % 101 = 0 THEN doc_id + 1000000 ELSE doc_id END AS i FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id FROM documents WHERE doc_id % 30 = 0)
SELECT count(*) FILTER (WHERE i < 0 OR i >= n) AS out_of_range, count(*) - count(DISTINCT i) AS repeated FROM k, n""")
def v04_keep_faults(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    kept = docs.filter("doc_id % 3 = 0").select(F.when(F.col("doc_id") % 101 == 0, F.col("doc_id") + 1_000_000).otherwise(F.col("doc_id")).alias("i"))
    return V.keep_faults(kept.union(docs.filter("doc_id % 30 = 0")), "i", docs.count())


@query("""SELECT vec_id // 50 AS representative, count(*) AS members, sum(vec_id)::BIGINT AS total FROM embeddings GROUP BY 1""")
def v05_parsed_groups(spark, d):
    groups = embeddings(spark, d).groupBy(F.floor(F.col("vec_id") / 50).alias("representative")).agg(F.collect_list("vec_id").alias("members"))  # fifty
    lines = groups.select(F.to_json(F.struct("representative", "members")).alias("raw"))
    return V.parsed_groups(lines).select("representative", F.size("members").cast("long").alias("members"), F.aggregate("members", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@query("""SELECT count(*) FILTER (WHERE coalesce(trim(source), '') = '') AS blank, (count(*) FILTER (WHERE trim(source) <> '') - count(DISTINCT source) FILTER (WHERE trim(source) <> ''))::BIGINT AS repeated, CAST(0 AS INTEGER) AS empty FROM documents""")
def v06_id_faults(spark, d):
    return V.id_faults(table(spark, d, "documents").select("source"), "source")


@query("""WITH m AS (SELECT source, count(*) AS expected FROM documents WHERE source <> 'src3' GROUP BY 1), a AS (SELECT source, count(*) AS actual FROM documents WHERE doc_id % 97 <> 0 GROUP BY 1)
SELECT source, coalesce(expected, 0) AS expected, coalesce(actual, 0) AS actual, coalesce(expected, 0) = coalesce(actual, 0) AS matches FROM m FULL JOIN a USING (source)""")
def v08_manifest_check(spark, d):
    """A manifest that lacks a source, against a table that has lost rows."""
    docs = table(spark, d, "documents").select("doc_id", "source")
    manifest = docs.filter("source <> 'src3'").groupBy("source").agg(F.count("*").alias("rows"))
    return V.manifest_check(docs.filter("doc_id % 97 <> 0"), manifest, "source")


@query(f"""WITH {CLUSTERED} SELECT count(*) FILTER (WHERE label = 3) AS unknown_topics, count(*) FILTER (WHERE p < 0.05) AS bad_confidences FROM cl""")
def v10_export_faults(spark, d):
    """Against topics that lack one, with confidences lowered so that some fall under zero."""
    rows, _ = clustered(spark, d)
    topics = rows.filter("label >= 0 AND label <> 3").select(F.col("label").alias("topic")).distinct()
    return V.export_faults(rows.withColumn("confidence", F.col("probability") - 0.05), "label", "confidence", topics, "topic")


@query("""WITH c AS (SELECT count(*) FILTER (WHERE trim(text, E' \\n\\t\\r') <> '') AS valid, count(*) FILTER (WHERE trim(text, E' \\n\\t\\r') = '') AS invalid FROM documents)
SELECT valid, invalid, list_filter([CASE WHEN valid = 0 THEN 'no valid record' END, CASE WHEN invalid / (valid + invalid) > 0.01 THEN 'too many bad records' END, CASE WHEN abs(valid - 260000) / 260000 > 0.1 THEN 'unexpected number of records' END], lambda x: x IS NOT NULL) AS critical, false AS usable FROM c""")
def v11_inspection_verdict(spark, d):
    """Against the design corpus of 260,000 records, which no test table has."""
    valid = T.strip(F.coalesce("text", F.lit(""))) != ""
    counts = table(spark, d, "documents").agg(F.count_if(valid).alias("valid"), F.count_if(~valid).alias("invalid"))
    return V.inspection_verdict(counts, 260_000)


@query("""SELECT conv_id, turn, sha256(to_json({'conv_id': conv_id, 'turn': turn, 'role': role})::VARCHAR) AS digest FROM conversations""")
def v13_row_digests(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", V.row_digest("conv_id", "turn", "role").alias("digest"))


@query(f"""WITH {CLUSTERED}, s AS (SELECT label, count(*) AS n FROM cl GROUP BY 1), m AS (SELECT sum(n) FILTER (WHERE label < 0) / sum(n) AS o, max(n) FILTER (WHERE label >= 0) / sum(n) FILTER (WHERE label >= 0) AS d, count(*) FILTER (WHERE label >= 0) AS k, count(*) FILTER (WHERE label >= 0 AND n < 50) AS micro FROM s), p AS (SELECT avg(p) AS p FROM cl)
SELECT list_filter([CASE WHEN o > 0.05 THEN 'many outliers' END, CASE WHEN d > 0.5 THEN 'one cluster dominates' END, CASE WHEN p < 0.5 THEN 'low mean probability' END, CASE WHEN micro / k > 0.2 THEN 'many small clusters' END, CASE WHEN k = 0 THEN 'outliers only' END], lambda x: x IS NOT NULL) AS warnings FROM m, p""")
def v14_clustering_warnings(spark, d):
    rows, _ = clustered(spark, d)
    metrics = O.cluster_metrics(rows, "label", "probability", 25, 0.1).crossJoin(rows.agg(F.avg("probability").alias("mean_probability")))  # one row each
    return metrics.select(V.clustering_warnings(outlier_share=0.05).alias("warnings"))


@query(f"""WITH {TERMS}, n AS (SELECT array_to_string(keywords[1:3], ' / ') AS name, count(*) AS n FROM ks GROUP BY 1), j AS (SELECT count(*) FILTER (WHERE len(list_intersect(a.keywords, b.keywords)) / len(list_distinct(list_concat(a.keywords, b.keywords))) > 0.5) AS n_similar FROM ks a JOIN ks b ON a.topic < b.topic),
t AS (SELECT count(*) AS truncated FROM (SELECT lang FROM documents GROUP BY 1 HAVING sum(length(text)) > 20000))
SELECT list_filter([CASE WHEN n_similar > 0 THEN 'similar topics' END, CASE WHEN (SELECT count(*) FILTER (WHERE n > 1) FROM n) > 0 THEN 'names that repeat' END, CASE WHEN truncated > 0 THEN 'truncated documents' END], lambda x: x IS NOT NULL) AS warnings FROM j, t""")
def v15_topic_warnings(spark, d):
    sets, _ = materialise(O.keyword_sets(_top(spark, d)), "keywords")
    similar = O.keyword_pairs(sets).agg(F.count_if(F.col("jaccard") > 0.5).alias("similar_pairs"))
    cut = O.topic_documents(table(spark, d, "documents").select("doc_id", "lang", "text"), "lang", "text", "doc_id", 20_000).agg(F.count_if("truncated").alias("truncated"))
    return O.topic_quality(sets).crossJoin(similar).crossJoin(cut).select(V.topic_warnings().alias("warnings"))  # one row each


@query("""WITH s AS (SELECT CASE WHEN doc_id % 10 < 8 THEN 'development' WHEN doc_id % 10 = 8 THEN 'validation' ELSE 'test' END AS split, count(*) AS assigned, count(*) FILTER (WHERE doc_id % 10 <> 9 OR doc_id % 100 = 9) AS written FROM documents GROUP BY 1), t AS (SELECT sum(assigned) AS n FROM s)
SELECT split, assigned, written, list_filter([CASE WHEN abs(assigned / n - CASE split WHEN 'development' THEN 0.7 ELSE 0.15 END) > 0.05 THEN 'off its target' END, CASE WHEN written / assigned < 0.2 THEN 'few kept' END], lambda x: x IS NOT NULL) AS warnings FROM s, t""")
def v17_split_warnings(spark, d):
    last = F.col("doc_id") % 10
    rows = table(spark, d, "documents").select("doc_id", F.when(last < 8, "development").when(last == 8, "validation").otherwise("test").alias("split"))
    stats = rows.groupBy("split").agg(F.count("*").alias("assigned"), F.count_if((F.col("doc_id") % 10 != 9) | (F.col("doc_id") % 100 == 9)).alias("written"))
    return V.split_warnings(stats, {"development": 0.7, "validation": 0.15, "test": 0.15})


@query(f"""WITH {CLUSTERED}, {centroid_sql('cl', 'c2')}, s AS (SELECT label, vec_id, list_cosine_similarity(v, c) AS s, round((p + list_cosine_similarity(v, c)) / 2, 9) AS score FROM cl JOIN c2 USING (label) WHERE p >= 0.1),
k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM s) SELECT label, count(*) AS representatives, round(avg(s), 6) AS mean_similarity FROM k WHERE rank <= 5 GROUP BY 1""")
def v19_representative_similarity(spark, d):
    best = _candidates(spark, d).filter("rank <= 5").withColumn("similarity", F.col("score") * 2 - F.col("probability"))
    return V.representative_similarity(best, "label", "similarity")


@query("""SELECT vec_id, label::BIGINT AS label, len(embedding) AS dims, round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm FROM embeddings""")
def j05_positional_join(spark, d):
    rows = embeddings(spark, d)
    return V.zipped(rows.select("vec_id", "label"), V.norms(rows, "vec_id", "embedding").withColumn("dims", F.col("dims").cast("long")), "vec_id")


@query("""SELECT vec_id, len(embedding) AS dims, round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm FROM embeddings""")
def k03_matrix_round_trip(spark, d):
    """A checked matrix written in order of its rows and read again."""
    rows = table(spark, d, "embeddings").select("vec_id", "embedding")
    path = sinks.write_matrix(rows, f"{shared_dir(spark)}/threadloom", "vec_id", "embedding", rows.agg(F.max(F.size("embedding"))).first()[0])
    return V.norms(spark.read.parquet(path), "vec_id", "embedding").withColumn("dims", F.col("dims").cast("long"))


def _label_sql(text: str) -> str:
    lists = ", ".join(f"{{'n': len(list_filter(w, lambda x: x IN ({', '.join(repr(x) for x in words.split())}))), 'i': {-i}, 'name': '{name}'}}" for i, (name, words) in enumerate(L.MARKERS.items()))
    return f"""WITH s AS (SELECT *, regexp_replace(regexp_replace({text}, '^{SPACE}', ''), '{SPACE}$', '') AS t FROM documents), w AS (SELECT doc_id, t, regexp_extract_all(lower(t), '[\\p{{L}}\\p{{N}}]+') AS w FROM s),
b AS (SELECT doc_id, t, list_max([{lists}]) AS best FROM w), l AS (SELECT doc_id, t, CASE WHEN best.n > 0 THEN best.name END AS lang FROM b)"""


@query(_label_sql("text") + " SELECT doc_id, CASE WHEN length(t) < 20 THEN 'unknown_short' ELSE coalesce(lang, 'unknown') END AS label FROM l")
def g10_language_labels(spark, d):
    return table(spark, d, "documents").select("doc_id", L.label(F.col("text")).alias("label"))


@query(_label_sql("source || ' ' || text") + " SELECT doc_id, length(t) < 20 OR coalesce(lang = 'french', false) AS kept FROM l")
def g09_language_gate(spark, d):
    return table(spark, d, "documents").select("doc_id", L.probably("french", F.col("source"), F.col("text")).alias("kept"))


@query("""SELECT 'rows' AS measure, '' AS value, count(*) AS n FROM documents UNION ALL SELECT 'language', lang, count(*) FROM documents GROUP BY lang UNION ALL SELECT 'sources', '', count(DISTINCT source) FILTER (WHERE source <> '') FROM documents""")
def a15_corpus_statistics(spark, d):
    return P.corpus_statistics(table(spark, d, "documents"), "lang", "source")


@query("""WITH k AS (SELECT conv_id, turn, list_filter(string_split(text, ' '), lambda x: x <> '') AS k FROM conversations)
SELECT conv_id, turn, len(k) AS keyword_count, len(list_filter(k, lambda x: regexp_matches(x, '[^\\s@]+@[^\\s@]+\\.[^\\s@]+') OR regexp_matches(x, '(^|[^0-9])(\\+?[0-9][\\s().-]?){7,}[0-9]($|[^0-9])'))) AS suspicious_count FROM k""")
def a25_suspicious_terms(spark, d):
    words = table(spark, d, "conversations").select("conv_id", "turn", F.array_remove(F.split("text", " "), "").alias("w"))
    return words.select("conv_id", "turn", F.size("w").cast("long").alias("keyword_count"), E.suspicious(F.col("w")).cast("long").alias("suspicious_count"))


@query("""WITH w AS (SELECT conv_id, turn, list_filter(string_split(text, ' '), lambda x: x <> '') AS w FROM conversations) SELECT conv_id, turn, list_filter(w, lambda x, i: list_position(w, x) = i) AS words FROM w""")
def u05_ordered_distinct(spark, d):
    """The first of equal words stays in its place."""
    words = table(spark, d, "conversations").select("conv_id", "turn", F.array_remove(F.split("text", " "), "").alias("w"))
    return words.select("conv_id", "turn", F.array_distinct("w").alias("words"))


@query("""SELECT label, n, row_number() OVER (ORDER BY n DESC, label) AS place FROM (SELECT label::BIGINT AS label, count(*) AS n FROM embeddings GROUP BY ALL)""")
def w16_largest_first(spark, d):
    """Cluster cards, the largest first; a row per cluster is all that is put in order."""
    return R.largest_first(embeddings(spark, d), "label")


@query("""SELECT page_id, url FROM pages""")
def p07_summaries(spark, d):
    """A list without the heavy column, which the scan doesn't read."""
    return table(spark, d, "pages").select("page_id", "url")


@query("""SELECT doc_id, lang FROM documents WHERE doc_id < 100""")
def s15_trial(spark, d):
    """A trial run over the first places, by place and not by whatever comes first."""
    return R.trial(table(spark, d, "documents").select("doc_id", "lang"), "doc_id", 100)
