"""Queries over vectors, topics, reassignment, evaluation and export."""

from pyspark.sql import functions as F

from threadloom.functions import scalars as S
from threadloom.operators import evaluation as E
from threadloom.operators import reassignment as A
from threadloom.operators import topics as O
from threadloom.operators import validation as X
from threadloom.operators import vectors as V
from threadloom.plans.registry import query
from threadloom.sources.shared import materialise
from threadloom.sources.tables import table

#: The synthetic vectors lie far apart; with the usual 0.95 nothing would be near.
NEAR = 0.35
SHARE = 10
RULES = A.Rules(similarity=0.1, single_similarity=0.9, margin=0.01, topic_probability=0.05, member_probability=0.1, members=3, cohesion=0.1, centroid_similarity=0.6)


def embeddings(spark, d):
    return table(spark, d, "embeddings").select("vec_id", "embedding", F.col("label").cast("long").alias("label"))


def clustered(spark, d):
    """The vectors with a probability; the tenth of the lowest become outliers."""
    rows, _ = materialise(O.with_probability(embeddings(spark, d), "label", "embedding"), "probabilities")
    n = rows.count() // SHARE
    low = rows.orderBy(F.round("probability", 9), "vec_id").limit(n).select(F.col("vec_id").alias("_v"))
    marked = rows.join(low, F.col("vec_id") == F.col("_v"), "left").withColumn("label", F.when(F.col("_v").isNotNull(), F.lit(-1)).otherwise(F.col("label")).cast("long")).drop("_v")
    return materialise(marked, "clustered")[0], n


def _decided(spark, d):
    rows, n = clustered(spark, d)
    topics, _ = materialise(A.eligibility(rows, "label", "probability", "embedding", RULES), "topics")
    found, _ = materialise(A.scored(rows.filter("label = -1"), "vec_id", "embedding", topics, "label", RULES), "decisions")
    return rows, A.limited(found, "vec_id", topics, "label", n, RULES), topics


def decided(spark, d):
    return _decided(spark, d)[:2]


def cos(a: str, b: str) -> str:
    return f"list_cosine_similarity({a}, {b})"


def centroid_sql(source: str, name: str, vector: str = "v") -> str:
    return f"""{name}_e AS (SELECT label, unnest({vector}) AS x, generate_subscripts({vector}, 1) AS i FROM {source} WHERE label >= 0), {name}_s AS (SELECT label, i, sum(x) AS x FROM {name}_e GROUP BY 1, 2),
{name}_n AS (SELECT label, sqrt(sum(x * x)) AS n FROM {name}_s GROUP BY 1), {name} AS (SELECT label, list(x / n ORDER BY i) AS c FROM {name}_s JOIN {name}_n USING (label) GROUP BY label)"""


BASE = f"v AS (SELECT vec_id, label::BIGINT AS label, embedding::DOUBLE[] AS v FROM embeddings), {centroid_sql('v', 'ct')}, pr AS (SELECT v.*, greatest(0, least(1, {cos('v', 'c')})) AS p FROM v JOIN ct USING (label))"
CLUSTERED = f"""{BASE}, rk AS (SELECT *, row_number() OVER (ORDER BY round(p, 9), vec_id) AS k FROM pr), cl AS (SELECT vec_id, v, p, CASE WHEN k <= (SELECT count(*) // {SHARE} FROM v) THEN -1 ELSE label END AS label FROM rk)"""
DECIDED = f"""{CLUSTERED}, un AS (SELECT *, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM cl), gm AS (SELECT * FROM un WHERE label >= 0 AND p >= {RULES.member_probability}),
{centroid_sql('gm', 'rc', 'u')}, sz AS (SELECT label, count(*) AS size, avg(p) AS mp FROM cl WHERE label >= 0 GROUP BY 1), co AS (SELECT label, avg(list_dot_product(u, c)) AS co, count(*) AS m FROM gm JOIN rc USING (label) GROUP BY 1),
e1 AS (SELECT label, size, c FROM sz JOIN rc USING (label) JOIN co USING (label) WHERE size >= {RULES.topic_size} AND mp >= {RULES.topic_probability} AND m >= {RULES.members} AND co >= {RULES.cohesion}),
am AS (SELECT DISTINCT a.label FROM e1 a JOIN e1 b ON a.label <> b.label AND list_dot_product(a.c, b.c) > {RULES.centroid_similarity}), el AS (SELECT * FROM e1 WHERE label NOT IN (SELECT label FROM am)),
sc AS (SELECT vec_id, el.label AS t, list_dot_product(u, c) AS s FROM un, el WHERE un.label = -1), ra AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, t DESC) AS k FROM sc),
bs AS (SELECT a.vec_id, a.t AS best_topic, a.s AS similarity, b.t AS second_topic, a.s - b.s AS margin FROM ra a JOIN ra b ON a.vec_id = b.vec_id AND a.k = 1 AND b.k = 2),
d0 AS (SELECT *, CASE WHEN similarity < {RULES.similarity} THEN 'below_similarity' WHEN margin < {RULES.margin} THEN 'insufficient_margin' ELSE 'reassigned' END AS r0 FROM bs),
a1 AS (SELECT d0.vec_id, similarity, margin, ceil(size * {RULES.expansion}) AS cap, row_number() OVER (PARTITION BY best_topic ORDER BY similarity DESC, margin DESC, vec_id) AS k FROM d0 JOIN el ON el.label = best_topic WHERE r0 = 'reassigned'),
a2 AS (SELECT *, coalesce(sum(CASE WHEN k <= cap THEN 1 ELSE 0 END) OVER (ORDER BY similarity DESC, margin DESC, vec_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM a1),
de AS (SELECT d0.*, CASE WHEN r0 <> 'reassigned' THEN r0 WHEN before >= ceil((SELECT count(*) // {SHARE} FROM v) * {RULES.global_share}) THEN 'global_limit' WHEN k > cap THEN 'topic_limit' ELSE r0 END AS reason FROM d0 LEFT JOIN a2 USING (vec_id)),
fl AS (SELECT cl.vec_id, cl.v, cl.label, p, CASE WHEN reason = 'reassigned' THEN best_topic ELSE label END AS final_label, CASE WHEN reason = 'reassigned' THEN similarity ELSE p END AS confidence, coalesce(reason = 'reassigned', false) AS re FROM cl LEFT JOIN de USING (vec_id))"""


@query(f"""WITH q AS (SELECT a.vec_id AS query, b.vec_id AS id, {cos('a.embedding::DOUBLE[]', 'b.embedding::DOUBLE[]')} AS s FROM embeddings a JOIN embeddings b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY s DESC, id) AS rank FROM q) SELECT query, id, round(s, 6) AS similarity, rank FROM r WHERE rank <= 5""")
def f24_cosine_topk(spark, d):
    rows = embeddings(spark, d)
    found = V.nearest(rows, rows.filter("vec_id % 50 = 0"), "vec_id", "embedding", 5)
    return found.select("query", "id", F.round("similarity", 6).alias("similarity"), "rank")


PAIRS = f"pairs AS (SELECT a.vec_id AS l, b.vec_id AS r, {cos('a.embedding::DOUBLE[]', 'b.embedding::DOUBLE[]')} AS s FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id AND {cos('a.embedding::DOUBLE[]', 'b.embedding::DOUBLE[]')} >= {NEAR})"


def _pairs(spark, d):
    return V.block_pairs(embeddings(spark, d), "vec_id", "embedding", NEAR, block=V.EXHAUSTIVE)


def _roots(spark, d):
    return V.components(V.block_links(embeddings(spark, d), "vec_id", "embedding", NEAR))


@query(f'WITH {PAIRS} SELECT l AS "left", r AS "right", round(s, 6) AS similarity FROM pairs')
def j08_near_duplicates(spark, d):
    return _pairs(spark, d).withColumn("similarity", F.round("similarity", 6))


ROOTS = f"{PAIRS}, ed AS (SELECT l, r FROM pairs UNION ALL SELECT r, l FROM pairs), lb(v, root) AS (SELECT l, l FROM ed UNION SELECT ed.r, root FROM lb JOIN ed ON ed.l = v), rt AS (SELECT v, min(root) AS root FROM lb GROUP BY v)"
GROUPED = "gr AS (SELECT vec_id, coalesce(root, vec_id) AS representative FROM embeddings LEFT JOIN rt ON v = vec_id)"


@query(f"WITH RECURSIVE {ROOTS} SELECT v, root FROM rt")
def m02_components(spark, d):
    return _roots(spark, d)


@query(f"WITH RECURSIVE {ROOTS}, {GROUPED} SELECT vec_id, representative, count(*) OVER (PARTITION BY representative) - 1 AS semantic_duplicate_count FROM gr")
def m03_groups(spark, d):
    return V.grouped(embeddings(spark, d).select("vec_id"), "vec_id", _roots(spark, d)).select("vec_id", "representative", "semantic_duplicate_count")


@query(f"WITH RECURSIVE {ROOTS}, {GROUPED} SELECT representative AS vec_id, 'corpus:' || sha256(representative::VARCHAR) AS corpus_id, count(*) - 1 AS semantic_duplicate_count FROM gr GROUP BY 1")
def j04_final_corpus(spark, d):
    groups = V.grouped(embeddings(spark, d).select("vec_id"), "vec_id", _roots(spark, d))
    return V.corpus(groups, "vec_id").select("vec_id", "corpus_id", "semantic_duplicate_count")


@query(f"""WITH RECURSIVE {ROOTS}, {GROUPED}, c AS (SELECT vec_id, representative, count(*) OVER (PARTITION BY representative) - 1 AS k FROM gr),
f AS (SELECT * FROM c WHERE vec_id % 11 <> 3 UNION ALL SELECT * FROM c WHERE vec_id % 13 = 5 AND vec_id % 11 <> 3)
SELECT 'as grouped' AS input, CAST(0 AS BIGINT) AS ungrouped, CAST(0 AS BIGINT) AS repeated, CAST(0 AS BIGINT) AS uncovered UNION ALL
SELECT 'damaged', (SELECT count(*) FROM embeddings) - count(*), count(*) - count(DISTINCT vec_id), (SELECT count(*) FROM embeddings) - count(*) FILTER (WHERE vec_id = representative) - coalesce(sum(k) FILTER (WHERE vec_id = representative), 0)::BIGINT FROM f""")
def m05_group_violations(spark, d):
    """None in the groups as made; and those in a copy from which every eleventh row was taken and in which every thirteenth stands twice."""
    rows = embeddings(spark, d).select("vec_id")
    groups, _ = materialise(V.grouped(rows, "vec_id", _roots(spark, d)), "groups")
    lost = groups.filter("vec_id % 11 <> 3")
    damaged = lost.unionByName(lost.filter("vec_id % 13 = 5"))
    return V.invalid_groups(groups, rows, "vec_id").withColumn("input", F.lit("as grouped")).unionByName(V.invalid_groups(damaged, rows, "vec_id").withColumn("input", F.lit("damaged")))


@query("""SELECT label::BIGINT AS label, row_number() OVER (ORDER BY n DESC, f, label) - 1 AS new_label FROM (SELECT label, count(*) AS n, min(vec_id) AS f FROM embeddings GROUP BY 1)""")
def w12_label_order(spark, d):
    return O.label_order(embeddings(spark, d), "label", "vec_id")


@query(f"""WITH {CLUSTERED} SELECT label, count(*) AS size, round(count(*) / (SELECT count(*) FROM v), 6) AS share, round(avg(p), 6) AS mean_probability, round(median(p), 6) AS median_probability, round(min(p), 6) AS min_probability, min(vec_id) AS first_row FROM cl WHERE label >= 0 GROUP BY label""")
def a16_cluster_summary(spark, d):
    rows, _ = clustered(spark, d)
    return O.cluster_summary(rows, "label", "probability", "vec_id", rows.count())


@query(f"""WITH {CLUSTERED}, s AS (SELECT label, count(*) AS n, count(*) FILTER (WHERE p < 0.1) AS low FROM cl GROUP BY 1)
SELECT count(*) FILTER (WHERE label >= 0) AS n_clusters, round(sum(n) FILTER (WHERE label < 0) / sum(n), 6) AS outlier_share, min(n) FILTER (WHERE label >= 0) AS min_size, max(n) FILTER (WHERE label >= 0) AS max_size, median(n) FILTER (WHERE label >= 0) AS median_size,
round(max(n) FILTER (WHERE label >= 0) / sum(n) FILTER (WHERE label >= 0), 6) AS dominant_share, count(*) FILTER (WHERE label >= 0 AND n < 50) AS n_micro, sum(low)::BIGINT AS n_low FROM s""")
def a17_cluster_metrics(spark, d):
    return O.cluster_metrics(clustered(spark, d)[0], "label", "probability", 25, 0.1)


@query(f"WITH {BASE}, x AS (SELECT label, unnest(c) AS x, generate_subscripts(c, 1) - 1 AS i FROM ct) SELECT label, i AS dim, round(x, 6) AS value FROM x")
def a18_centroids(spark, d):
    return O.centroids(embeddings(spark, d), "label", "embedding").select("label", F.posexplode("centroid").alias("dim", "value")).select("label", F.col("dim").cast("long").alias("dim"), F.round("value", 6).alias("value"))


@query(f'WITH {BASE} SELECT a.label AS "left", b.label AS "right", round(list_dot_product(a.c, b.c), 6) AS similarity FROM ct a JOIN ct b ON a.label < b.label')
def j11_centroid_pairs(spark, d):
    return O.centroid_pairs(O.centroids(embeddings(spark, d), "label", "embedding"), "label").withColumn("similarity", F.round("similarity", 6))


TERMS = r"""w AS (SELECT lang AS topic, doc_id, list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}_][\p{L}\p{N}_-]*[\p{L}\p{N}_]'), lambda x: x NOT IN ('the', 'and', 'of', 'to', 'in')) AS w FROM documents),
g AS (SELECT topic, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM w WHERE len(w) > 0), tf AS (SELECT topic, term, count(*) AS tf FROM g GROUP BY ALL),
df AS (SELECT term, count(*) AS df, sum(tf)::DOUBLE AS f FROM tf GROUP BY 1), ft AS (SELECT term, f FROM df WHERE df <= 0.95 * (SELECT count(DISTINCT topic) FROM tf) ORDER BY f DESC, term LIMIT 50000),
us AS (SELECT topic, term, tf, f FROM tf JOIN ft USING (term)), su AS (SELECT topic, sum(tf)::DOUBLE AS total FROM us GROUP BY 1), av AS (SELECT floor(avg(total)) AS a FROM su),
we AS (SELECT topic, term, sqrt(tf / total) * ln(1 + (a - f + 0.5) / (f + 0.5)) AS weight FROM us JOIN su USING (topic), av),
tp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS rank FROM we WHERE weight > 0) WHERE rank <= 10),
ks AS (SELECT topic, list(term ORDER BY rank) AS keywords FROM tp GROUP BY topic)"""


def _top(spark, d):
    docs = table(spark, d, "documents").select("lang", "text")
    return O.top_terms(O.ctfidf(O.topic_terms(docs, "lang", "text", ["the", "and", "of", "to", "in"])))


@query(f"WITH {TERMS} SELECT topic, term, round(weight, 6) AS weight, rank, CASE WHEN contains(term, ' ') THEN 'ngram' ELSE 'unigram' END AS kind FROM tp")
def m09_ctfidf_top_terms(spark, d):
    """M09, F23; a short stop list, which the oracle repeats."""
    return _top(spark, d).select("topic", "term", F.round("weight", 6).alias("weight"), "rank", S.keyword_kind(F.col("term")).alias("kind"))


@query(f"WITH {TERMS} SELECT topic, array_to_string(keywords[1:3], ' / ') AS name, len(keywords) AS n FROM ks")
def w08_topic_names(spark, d):
    """W08, F22."""
    return O.keyword_sets(_top(spark, d)).select("topic", "name", F.size("keywords").cast("long").alias("n"))


@query(f'WITH {TERMS} SELECT a.topic AS "left", b.topic AS "right", len(list_intersect(a.keywords, b.keywords)) / len(list_distinct(list_concat(a.keywords, b.keywords))) AS jaccard FROM ks a JOIN ks b ON a.topic < b.topic')
def j12_keyword_jaccard(spark, d):
    return O.keyword_pairs(O.keyword_sets(_top(spark, d)))


@query(f"""WITH {TERMS}, n AS (SELECT array_to_string(keywords[1:3], ' / ') AS name, count(*) AS n FROM ks GROUP BY 1)
SELECT round((SELECT count(DISTINCT term) / count(*) FROM tp), 6) AS diversity, (SELECT count(*) FROM ks) AS n_topics, CAST(0 AS BIGINT) AS empty_topics, (SELECT count(*) FILTER (WHERE n > 1) FROM n) AS duplicate_names""")
def a24_topic_quality(spark, d):
    return O.topic_quality(O.keyword_sets(_top(spark, d)))


@query("""WITH r AS (SELECT lang, doc_id, text, coalesce(sum(length(text)) OVER (PARTITION BY lang ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(length(text)) OVER (PARTITION BY lang) AS total FROM documents),
k AS (SELECT lang, string_agg(left(text, greatest(0, 20000 - before)::BIGINT), chr(10) ORDER BY doc_id) AS document, any_value(total) > 20000 AS truncated FROM r WHERE before < 20000 AND text <> '' GROUP BY lang)
SELECT lang, length(document) AS n, sha256(document) AS document_sha256, truncated FROM k""")
def a22_topic_documents(spark, d):
    docs = O.topic_documents(table(spark, d, "documents").select("doc_id", "lang", "text"), "lang", "text", "doc_id", 20_000)
    return docs.select("lang", F.char_length("document").cast("long").alias("n"), F.sha2("document", 256).alias("document_sha256"), "truncated")


def _candidates(spark, d):
    rows, _ = clustered(spark, d)
    c = O.centroids(rows.filter("label >= 0"), "label", "embedding").drop("members")
    return O.candidates(rows.join(F.broadcast(c), "label"), "label", "probability", S.cosine(F.col("embedding"), F.col("centroid")), "vec_id", 0.1, 20)


@query(f"""WITH {CLUSTERED}, {centroid_sql('cl', 'c2')}, s AS (SELECT label, vec_id, round((p + {cos('v', 'c')}) / 2, 9) AS score FROM cl JOIN c2 USING (label) WHERE p >= 0.1),
k AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM s) SELECT label, vec_id, round(score, 6) AS score, rank FROM k WHERE rank <= 20""")
def w09_representative_candidates(spark, d):
    return _candidates(spark, d).select("label", "vec_id", F.round("score", 6).alias("score"), "rank")


@query()
def w09_representatives(spark, d):
    """The greedy choice; videos and authors are stood in for by remainders of the id."""
    rows = _candidates(spark, d).withColumn("video", F.col("vec_id") % 7).withColumn("author", F.col("vec_id") % 11)
    return O.representatives(rows, "label", "video", "author")


@query(f"WITH {DECIDED} SELECT vec_id, best_topic, round(similarity, 6) AS similarity, second_topic, round(margin, 6) AS margin, reason FROM de")
def m12_outlier_decisions(spark, d):
    """J10, M11, M12, W10, W11."""
    found = decided(spark, d)[1]
    return found.select("vec_id", "best_topic", F.round("similarity", 6).alias("similarity"), "second_topic", F.round("margin", 6).alias("margin"), "reason")


@query(f"WITH {DECIDED} SELECT reason, count(*) AS n FROM de GROUP BY 1")
def a21_rejection_reasons(spark, d):
    return A.reasons(decided(spark, d)[1])


METRICS = f"""WITH {DECIDED}, x AS (SELECT count(*) AS outliers, count(*) FILTER (WHERE reason = 'reassigned') AS reassigned, round(avg(margin) FILTER (WHERE reason = 'reassigned'), 6) AS mean_margin FROM de), l AS (SELECT max(n) AS largest FROM (SELECT count(*) AS n FROM de WHERE reason = 'reassigned' GROUP BY best_topic)),
m AS (SELECT outliers, reassigned, round(coalesce(reassigned / nullif(outliers, 0), 0), 6) AS reassigned_share, mean_margin, round(coalesce(largest / nullif(reassigned, 0), 0), 6) AS dominant_share, (SELECT count(*) FROM sz) - (SELECT count(*) FROM el) AS excluded_topics FROM x, l)"""


@query(f"{METRICS} SELECT * FROM m")
def a21_reassignment_metrics(spark, d):
    _, decisions, topics = _decided(spark, d)
    return A.metrics(decisions, topics)


@query(f"""{METRICS} SELECT list_filter([CASE WHEN reassigned_share > 0.2 THEN 'many reassigned' END, CASE WHEN mean_margin < 0.08 THEN 'low mean margin' END, CASE WHEN dominant_share > 0.5 THEN 'one topic receives most' END, CASE WHEN excluded_topics > 0 THEN 'topics excluded' END], lambda x: x IS NOT NULL) AS warnings FROM m""")
def v16_reassignment_warnings(spark, d):
    _, decisions, topics = _decided(spark, d)
    return A.metrics(decisions, topics).select(X.reassignment_warnings().alias("warnings"))


def _final(spark, d):
    rows, decisions = decided(spark, d)
    return A.final_labels(rows, "vec_id", "label", "probability", decisions)


@query(f"""WITH {DECIDED} SELECT final_label, count(*) FILTER (WHERE NOT re) AS original, count(*) FILTER (WHERE re) AS reassigned, round(count(*) FILTER (WHERE re) / greatest(count(*) FILTER (WHERE NOT re), 1), 6) AS expansion,
round(avg(confidence) FILTER (WHERE re), 6) AS mean_similarity, round(min(confidence) FILTER (WHERE re), 6) AS min_similarity FROM fl WHERE final_label >= 0 GROUP BY 1""")
def a20_final_summary(spark, d):
    """A20, M13."""
    return A.final_summary(_final(spark, d))


@query(f"""WITH {DECIDED} SELECT sha256(vec_id::VARCHAR) AS record_hash, CASE WHEN final_label >= 0 THEN final_label END AS topic_id, round(confidence, 6) AS confidence, CASE WHEN final_label < 0 THEN 'outlier' WHEN re THEN 'reassigned' ELSE 'original' END AS source FROM fl""")
def p11_public_assignments(spark, d):
    return E.public_assignments(_final(spark, d), F.col("vec_id").cast("string"), F.col("final_label"), F.col("confidence"), F.col("reassigned"))


@query(f"""WITH {DECIDED}, r AS (SELECT *, row_number() OVER (PARTITION BY final_label ORDER BY vec_id) AS n FROM fl WHERE final_label >= 0 AND final_label < 20), q AS (SELECT *, min(n) FILTER (WHERE re) OVER (PARTITION BY final_label) AS fr FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY final_label ORDER BY CASE WHEN n = fr THEN least(n, 5) ELSE n END, n) AS f FROM q WHERE NOT coalesce(fr > 1 AND n = least(fr - 1, 5), false)),
o AS (SELECT vec_id, final_label FROM fl WHERE final_label = -1 ORDER BY vec_id LIMIT 20) SELECT vec_id, final_label FROM k WHERE f <= 5 UNION ALL SELECT * FROM o""")
def w13_review_sample(spark, d):
    return E.review_sample(_final(spark, d).select("vec_id", "final_label", "reassigned"), "final_label", "vec_id", F.col("reassigned")).select("vec_id", "final_label")


@query(f"""WITH {DECIDED}, n AS (SELECT label, final_label, count(*) AS n FROM fl GROUP BY ALL) SELECT label, final_label, n, round(n / sum(n) OVER (PARTITION BY label), 6) AS left_share, round(n / sum(n) OVER (PARTITION BY final_label), 6) AS right_share,
max(n) OVER (PARTITION BY label) * 2 < sum(n) OVER (PARTITION BY label) AS split, max(n) OVER (PARTITION BY final_label) * 2 < sum(n) OVER (PARTITION BY final_label) AS merged FROM n""")
def m16_contingency(spark, d):
    return E.contingency(_final(spark, d), "label", "final_label")


@query(f"""WITH {DECIDED}, n AS (SELECT label, final_label, count(*) AS n FROM fl WHERE label >= 0 GROUP BY ALL) SELECT label AS "left", final_label AS "right", n AS overlap, round(n / sum(n) OVER (PARTITION BY label), 6) AS retention FROM n""")
def m16_matching(spark, d):
    """Only outliers change their label, so each topic is matched with itself."""
    return E.matched(E.contingency(_final(spark, d), "label", "final_label"), "label", "final_label")


@query(f"""WITH {DECIDED} SELECT final_label, count(*) AS records, count(*) FILTER (WHERE re) AS reassigned FROM fl WHERE final_label >= 0 GROUP BY 1""")
def a26_export_counts(spark, d):
    return E.export_counts(_final(spark, d))


@query(f"""WITH {DECIDED} SELECT vec_id AS record_id, CASE WHEN final_label >= 0 THEN final_label END AS topic_id, round(confidence, 6) AS confidence, lang, source, sha256(text) AS text_sha256 FROM fl JOIN documents ON doc_id = vec_id""")
def p12_research_assignments(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", F.sha2("text", 256).alias("text_sha256"))
    public = [F.when(F.col("final_label") >= 0, F.col("final_label")).alias("topic_id"), F.round("confidence", 6).alias("confidence")]
    return E.research_assignments(_final(spark, d), "vec_id", public, docs, "doc_id")


@query(f"""WITH {DECIDED}, n AS (SELECT label AS l, final_label AS r, count(*)::DOUBLE AS n FROM fl GROUP BY ALL), a AS (SELECT l, sum(n) AS a FROM n GROUP BY 1), b AS (SELECT r, sum(n) AS b FROM n GROUP BY 1), t AS (SELECT sum(n) AS t, sum(n * (n - 1) / 2) AS pn FROM n),
x AS (SELECT sum(n / t * ln(n * t / (a * b))) AS mi FROM n JOIN a USING (l) JOIN b USING (r), t), y AS (SELECT sum(a * (a - 1) / 2) AS pa, -sum(a / t * ln(a / t)) AS ha FROM a, t), z AS (SELECT sum(b * (b - 1) / 2) AS pb, -sum(b / t * ln(b / t)) AS hb FROM b, t)
SELECT round((pn - pa * pb / (t * (t - 1) / 2)) / ((pa + pb) / 2 - pa * pb / (t * (t - 1) / 2)), 6) AS ari, round(2 * mi / (ha + hb), 6) AS nmi FROM x, y, z, t""")
def m15_agreement(spark, d):
    return E.agreement(_final(spark, d), "label", "final_label")


@query(f"""WITH v AS (SELECT vec_id, label::BIGINT AS label, embedding::DOUBLE[] AS v FROM embeddings), u AS (SELECT *, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS u FROM v),
{centroid_sql('u', 'ic', 'u')}, s AS (SELECT label, list(x ORDER BY i) AS s, max(n) AS n FROM (SELECT label, i, sum(x) AS x, count(*) AS n FROM (SELECT label, unnest(u) AS x, generate_subscripts(u, 1) AS i FROM u) GROUP BY 1, 2) GROUP BY label),
d AS (SELECT u.vec_id, u.label = s.label AS own, CASE WHEN u.label = s.label THEN (n - list_dot_product(u, s)) / (n - 1) ELSE 1 - list_dot_product(u, s) / n END AS d FROM u, s),
sil AS (SELECT avg((b - a) / greatest(a, b)) AS silhouette FROM (SELECT min(d) FILTER (WHERE own) AS a, min(d) FILTER (WHERE NOT own) AS b FROM d GROUP BY vec_id)),
e AS (SELECT label, vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM v), m AS (SELECT label, i, avg(x) AS m, count(*) AS n FROM e GROUP BY 1, 2), g AS (SELECT i, avg(x) AS g FROM e GROUP BY 1),
w AS (SELECT sum((x - m) ^ 2) AS w FROM e JOIN m USING (label, i)), b AS (SELECT sum(n * (m - g) ^ 2) AS b FROM m JOIN g USING (i)),
sp AS (SELECT label, avg(dist) AS d FROM (SELECT label, vec_id, sqrt(sum((x - m) ^ 2)) AS dist FROM e JOIN m USING (label, i) GROUP BY 1, 2) GROUP BY 1),
mm AS (SELECT a.label AS a, b.label AS b, sqrt(sum((a.m - b.m) ^ 2)) AS dist FROM m a JOIN m b ON a.i = b.i AND a.label <> b.label GROUP BY 1, 2),
db AS (SELECT avg(r) AS davies FROM (SELECT mm.a, max((x.d + y.d) / dist) AS r FROM mm JOIN sp x ON x.label = mm.a JOIN sp y ON y.label = mm.b GROUP BY 1))
SELECT (SELECT round(avg(list_dot_product(u.u, ic.c)), 6) FROM u JOIN ic USING (label)) AS mean_intra_similarity, (SELECT round(max(list_dot_product(x.c, y.c)), 6) FROM ic x JOIN ic y ON x.label < y.label) AS max_centroid_similarity,
round(silhouette, 6) AS silhouette, round((b / ((SELECT count(*) FROM s) - 1)) / (w / ((SELECT count(*) FROM v) - (SELECT count(*) FROM s))), 6) AS calinski_harabasz, round(davies, 6) AS davies_bouldin FROM sil, w, b, db""")
def m14_geometry(spark, d):
    return E.geometry(embeddings(spark, d), "label", "embedding")


@query("SELECT count(*) AS reviewed, round(avg(quality), 6) AS precision, round(avg(toxic), 6) AS sensitive_share FROM labels")
def a23_manual_metrics(spark, d):
    return E.manual_metrics(table(spark, d, "labels"), F.col("quality"), F.col("toxic") == 1)


@query("""SELECT count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM documents)) AS "unknown", (SELECT count(*) FROM (SELECT doc_id FROM labels GROUP BY 1 HAVING count(*) > 1)) AS repeated FROM labels""")
def j13_annotation_errors(spark, d):
    return E.reference_errors(table(spark, d, "labels"), "doc_id", table(spark, d, "documents"), "doc_id")


@query("""SELECT conv_id, turn, list_filter(string_split(text, ' '), lambda k: k <> '' AND NOT regexp_matches(k, '[^\\s@]+@[^\\s@]+\\.[^\\s@]+') AND NOT regexp_matches(k, '(^|[^0-9])(\\+?[0-9][\\s().-]?){7,}[0-9]($|[^0-9])'))[1:10] AS keywords FROM conversations""")
def p13_safe_keywords(spark, d):
    words = table(spark, d, "conversations").select("conv_id", "turn", F.array_remove(F.split("text", " "), "").alias("w"))
    return words.select("conv_id", "turn", E.safe_keywords(F.col("w")).alias("keywords"))
