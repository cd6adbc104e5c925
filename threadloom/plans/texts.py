"""Queries over texts: preparation, gates, deduplication, splits, samples, threads."""

from pyspark.sql import functions as F

from threadloom.functions import scalars as S
from threadloom.functions import text as T
from threadloom.operators import cleaning as C
from threadloom.operators import splitting as P
from threadloom.operators import threads as H
from threadloom.plans.registry import query
from threadloom.sources.tables import table

#: The SQL replaces whole entities only, so one that a page's title breaks off stays.
GATES = C.Gates(closed_entities=True)
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]+"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACE}', ' ', 'g'))"


def fold(x: str) -> str:
    return f"replace(lower({x}), 'ß', 'ss')"


def entities(x: str) -> str:
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")):
        x = f"replace({x}, '{name}', '{char}')"
    return x


def prepared(table_name: str, row: str, text: str) -> str:
    """DuckDB CTEs p(row, text, base, clean_text, url_only, text_key)."""
    url = r"(?i)(?:https?://|www\.)[^\s<]+"
    return f"""b AS (SELECT *, regexp_replace({entities(text)}, '<[^>]*>', ' ', 'g') AS base FROM {table_name}),
c AS (SELECT *, {squeeze(rf"regexp_replace(regexp_replace(base, '{url}', ' <URL> ', 'g'), '\p{{C}}', ' ', 'g')")} AS clean_text,
  regexp_matches(base, '{url}') AND NOT regexp_matches(regexp_replace(base, '{url}', ' ', 'g'), '[\\p{{L}}\\p{{N}}]') AS url_only FROM b),
p AS (SELECT *, {squeeze(rf"regexp_replace({fold('clean_text')}, '[^\p{{L}}\p{{N}}]', ' ', 'g')")} AS text_key FROM c)"""


def run_of_six(x: str) -> str:
    """RE2 has no back-references: a run of each character of ASCII and Latin-1, which is what the driver tables hold."""
    each = "|".join(rf"\x{{{c:02X}}}{{6}}" for c in [*range(9, 14), *range(32, 127), *range(0xA0, 0x100)])
    return f"regexp_matches({x}, '{each}')"


#: The words of thanks are Cyrillic, of which the driver tables have none.
GATE = f"""CASE WHEN clean_text = '' THEN 'empty' WHEN url_only THEN 'url_only' WHEN length(clean_text) < 20 THEN 'too_short'
WHEN NOT regexp_matches(clean_text, '[\\p{{L}}\\p{{N}}]') THEN 'no_alphanumeric' WHEN {run_of_six('source_text')} THEN 'repeated_characters' ELSE 'keep' END"""


@query(f"WITH s AS (SELECT doc_id, text AS source_text, lang FROM documents), {prepared('s', 'doc_id', 'source_text')} SELECT lang, {GATE} AS reason, count(*) AS n FROM p GROUP BY ALL")
def g01_cleaning_reasons(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    return C.classified(C.prepare(docs, "text", GATES), "text", GATES).groupBy("lang", "reason").agg(F.count("*").alias("n"))


CLEANED = f"""s AS (SELECT doc_id, text AS source_text, lang FROM documents), {prepared('s', 'doc_id', 'source_text')},
g AS (SELECT *, {GATE} AS gate FROM p),
w AS (SELECT *, min(doc_id) FILTER (WHERE gate = 'keep') OVER (PARTITION BY text_key) AS rep, count(*) FILTER (WHERE gate = 'keep') OVER (PARTITION BY text_key) AS dups FROM g)"""


@query(f"""WITH {CLEANED} SELECT lang, CASE WHEN gate = 'keep' AND doc_id <> rep THEN 'exact_duplicate' ELSE gate END AS reason, count(*) AS n FROM w GROUP BY ALL""")
def a12_document_cleaning(spark, d):
    """The flagship: prepare, classify, deduplicate, count."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "text", F.lit("comment").alias("kind"))
    return C.cleaned(docs, "text", "kind", "doc_id", GATES, keep=("lang",)).groupBy("lang", "reason").agg(F.count("*").alias("n"))


@query(f"""WITH {CLEANED} SELECT doc_id, rep AS representative, dups AS duplicate_count, sha256(text_key) AS key_sha256 FROM w WHERE gate = 'keep'""")
def w01_exact_dedup(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text", F.lit("comment").alias("kind"))
    rows = C.cleaned(docs, "text", "kind", "doc_id", GATES).filter(F.col("reason").isin("keep", "exact_duplicate"))
    return rows.select("doc_id", "representative", "duplicate_count", "key_sha256")


@query(f"""WITH s AS (SELECT conv_id, turn, CASE WHEN turn = 0 THEN 'comment' ELSE 'reply' END AS kind, text AS source_text, conv_id * 1000 + turn AS row_index FROM conversations),
{prepared('s', 'row_index', 'source_text')}, g AS (SELECT *, {GATE} AS gate FROM p),
w AS (SELECT *, min(row_index) FILTER (WHERE gate = 'keep') OVER (PARTITION BY kind, text_key) AS rep FROM g)
SELECT kind, CASE WHEN gate = 'keep' AND row_index <> rep THEN 'exact_duplicate' ELSE gate END AS reason, count(*) AS n FROM w GROUP BY ALL""")
def a12_cleaning_stats(spark, d):
    turns = table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("row_index"), F.when(F.col("turn") == 0, "comment").otherwise("reply").alias("kind"), "text")
    return C.cleaned(turns, "text", "kind", "row_index", GATES).groupBy("kind", "reason").agg(F.count("*").alias("n"))


@query(r"""SELECT doc_id, CASE WHEN trim(text) = '' THEN 'empty' WHEN length(trim(text, E' \n\t\r')) < 20 THEN 'too_short' WHEN NOT regexp_matches(lower(text), '[а-яёa-z]') THEN 'too_short'
WHEN length(regexp_replace(text, '(?i)[^а-яё]', '', 'g')) < 0.5 * length(regexp_replace(text, '(?i)[^а-яёa-z]', '', 'g')) THEN 'foreign_language' ELSE 'keep' END AS reason FROM documents""")
def g02_legacy_gate(spark, d):
    return table(spark, d, "documents").select("doc_id", C.legacy_reason(F.col("text"), 20).alias("reason"))


NOISE = r"""SELECT {key}, is_noise FROM (SELECT {key}, s, list_transform(regexp_extract_all(lower(s), '[а-яёa-z]+'), lambda w: length(w)) AS l,
 length(regexp_replace(s, '[\p{{L}}\p{{N}}.,!?;:—–«»"“”''’‘`(){{}}…%№/+*=@#_|~<>$ \t\n\r\\\[\]\^\-&]', '', 'g')) / length(s) AS share FROM (SELECT {key}, trim({text}, E' \n\t\r') AS s FROM {table}))
, LATERAL (SELECT s = '' OR coalesce(share > 0.2, false) OR coalesce(list_avg(l) > 14 OR list_max(l) > 25, false) AS is_noise)"""


@query(NOISE.format(key="doc_id", text="text", table="documents"))
def g05_noise_flags(spark, d):
    return table(spark, d, "documents").select("doc_id", C.noise(F.col("text")).alias("is_noise"))


@query(NOISE.format(key="page_id", text="html", table="pages"))
def g05_page_noise(spark, d):
    return table(spark, d, "pages").select("page_id", C.noise(F.col("html")).alias("is_noise"))


@query(f"""WITH {prepared('pages', 'page_id', 'html')} SELECT page_id, url_only, sha256(clean_text) AS clean_sha256, sha256(text_key) AS key_sha256 FROM p""")
def f11_prepared_text(spark, d):
    rows = C.prepare(table(spark, d, "pages").select("page_id", "html"), "html", GATES)
    return rows.select("page_id", "url_only", F.sha2("clean_text", 256).alias("clean_sha256"), F.sha2("text_key", 256).alias("key_sha256"))


@query(f"""SELECT conv_id, turn, {run_of_six('text')} AS repeated, coalesce(length(regexp_replace(text, '[^\\p{{Lu}}]', '', 'g')) / nullif(length(regexp_replace(text, '[^\\p{{L}}]', '', 'g')), 0) > 0.8, false) AS uppercase,
regexp_matches(text, '[^\\s@]+@[^\\s@]+\\.[^\\s@]+') AS email FROM conversations""")
def g06_turn_flags(spark, d):
    """G06, G07, F20."""
    return table(spark, d, "conversations").select("conv_id", "turn", F.col("text").rlike(C.REPEATED).alias("repeated"), C.mostly_uppercase(F.col("text")).alias("uppercase"), T.has_email(F.col("text")).alias("email"))


LEAK = squeeze(fold("text"))
SPLIT = f"""a AS (SELECT doc_id, source, {LEAK} AS k, ('0x' || left(sha256('42' || chr(31) || 'video_id:' || source), 16))::UBIGINT::DOUBLE / 18446744073709551616.0 AS x FROM documents),
s AS (SELECT *, CASE WHEN x < 0.7 THEN 'development' WHEN x < 0.85 THEN 'validation' ELSE 'test' END AS split, CASE WHEN x < 0.7 THEN 1 WHEN x < 0.85 THEN 2 ELSE 3 END AS r,
 length(k) >= 20 AND len(regexp_extract_all(k, '[\\p{{L}}\\p{{N}}]+')) >= 4 AS informative FROM a),
o AS (SELECT *, NOT informative OR r = min(r) FILTER (WHERE informative) OVER (PARTITION BY k) AS written FROM s)"""


def _owned(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    group = S.group_key(F.col("source"), F.lit(""), F.lit(""), F.lit(""), F.col("doc_id").cast("string"), F.lit(""))
    return P.owned(P.assigned(docs, group), "text")


@query(f"WITH {SPLIT} SELECT doc_id, split FROM s")
def f14_split_assignment(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.concat(F.lit("video_id:"), "source").alias("g"))
    return P.assigned(docs, F.col("g")).select("doc_id", "split")


@query(f"WITH {SPLIT} SELECT doc_id, split, informative, written FROM o")
def j07_content_ownership(spark, d):
    return _owned(spark, d).select("doc_id", "split", "informative", "written")


@query(f"""WITH {SPLIT}, sh AS (SELECT k FROM o WHERE NOT informative GROUP BY k HAVING count(DISTINCT split) > 1)
SELECT split, count(DISTINCT source) AS groups, count(*) AS assigned, count(*) FILTER (WHERE written) AS written, count(*) FILTER (WHERE NOT written) AS removed,
count(DISTINCT k) FILTER (WHERE NOT informative AND k IN (SELECT k FROM sh)) AS ignored FROM o GROUP BY split""")
def a13_split_stats(spark, d):
    return P.split_statistics(_owned(spark, d), "source")


RANK = f"('0x' || left(sha256('42' || chr(31) || doc_id || chr(31) || source || chr(31) || doc_id || chr(31) || {LEAK}), 16))::UBIGINT"


@query(f"""WITH r AS (SELECT doc_id, source, {RANK} AS rank FROM documents WHERE trim(text) <> ''),
n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY rank, doc_id) AS k FROM r) SELECT doc_id, source FROM n WHERE k <= 3 ORDER BY rank, doc_id LIMIT 40""")
def w02_capped_sample(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "text").filter(T.strip(F.col("text")) != "")
    key = F.concat_ws(S.SEP, F.lit("42"), F.col("doc_id").cast("string"), "source", F.col("doc_id").cast("string"), T.collapse(T.casefold(F.col("text"))))
    return P.capped_sample(docs, F.col("source"), S.digest_head(key), "doc_id", 3, 40).select("doc_id", "source")


@query("""WITH c AS (SELECT source, count(*) AS n, sha256('42' || chr(31) || 'video_id:' || source) AS h FROM documents GROUP BY 1),
w AS (SELECT *, sum(n) OVER (ORDER BY h) - n AS before FROM c) SELECT doc_id, source FROM documents WHERE source IN (SELECT source FROM w WHERE before < 200)""")
def w04_group_sample(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    return P.whole_groups(docs, F.concat(F.lit("video_id:"), "source"), 42, 200)


@query("""WITH r AS (SELECT doc_id, ('0x' || left(sha256('42' || chr(31) || doc_id), 16))::UBIGINT AS rank FROM documents) SELECT doc_id FROM r ORDER BY rank, doc_id LIMIT 100""")
def w03_hash_sample(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    return P.hash_sample(docs, S.digest_head(F.concat(F.lit(f"42{S.SEP}"), F.col("doc_id").cast("string"))), "doc_id", 100)


THREADS = "t AS (SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn) AS turns FROM conversations GROUP BY conv_id)"


@query("""SELECT conv_id || ':' || turn AS record_id, CASE WHEN turn = 0 THEN 'comment' ELSE 'reply' END AS text_kind, CASE WHEN turn > 0 THEN conv_id || ':0' END AS parent_record_id, sha256(text) AS text_sha256 FROM conversations""")
def p01_thread_flatten(spark, d):
    """P01, R01."""
    flat = H.flatten(H.threads(table(spark, d, "conversations")))
    return flat.select("record_id", "text_kind", "parent_record_id", F.sha2("text", 256).alias("text_sha256"))


@query(f"WITH {THREADS}, f AS (SELECT conv_id, list_filter(turns, lambda x: contains(lower(x.text), 'the')) AS m FROM t) SELECT conv_id, len(m) AS n_matches, list_transform(m[1:2], lambda x: x.turn) AS first_turns FROM f WHERE len(m) > 0")
def r02_array_search(spark, d):
    """R02, R03, W07."""
    found = H.search(H.threads(table(spark, d, "conversations")), "the")
    return found.select("conv_id", F.size("matches").cast("long").alias("n_matches"), F.transform(F.slice("matches", 1, 2), lambda x: x["turn"]).alias("first_turns"))


@query(f"WITH {THREADS} SELECT conv_id, len(turns) = (SELECT max(turn) + 1 FROM conversations c WHERE c.conv_id = t.conv_id) AS valid FROM t")
def r04_array_count(spark, d):
    threads = H.threads(table(spark, d, "conversations"))
    return threads.select("conv_id", (F.size("turns") == F.array_max(F.transform("turns", lambda x: x["turn"])) + 1).alias("valid"))


@query("SELECT count(DISTINCT coalesce(role, '')) AS n_roles, count(DISTINCT coalesce(text, '')) AS n_texts, count(*) AS n_turns FROM conversations")
def r05_distinct_nested(spark, d):
    threads = H.threads(table(spark, d, "conversations"))
    each = threads.select(F.explode("turns").alias("t"))
    return each.agg(F.count_distinct(F.coalesce("t.role", F.lit(""))).alias("n_roles"), F.count_distinct(F.sha2(F.coalesce("t.text", F.lit("")), 256)).alias("n_texts"), F.count("*").alias("n_turns"))


@query("""SELECT role, count(*) AS n FROM conversations GROUP BY 1""")
def r06_count_map(spark, d):
    counts = table(spark, d, "conversations").groupBy("role").agg(F.count("*").alias("n"))
    mapped = counts.agg(F.map_from_entries(F.collect_list(F.struct("role", "n"))).alias("m"))  # as many entries as roles
    return mapped.select(F.explode("m").alias("role", "n"))


@query("""SELECT conv_id, to_json({'conv_id': conv_id, 'turn': turn, 'role': role})::VARCHAR AS line FROM conversations""")
def r07_json_lines(spark, d):
    turns = table(spark, d, "conversations")
    return turns.select("conv_id", F.to_json(F.struct("conv_id", "turn", "role")).alias("line"))
