"""Benchmark decontamination with a broadcast hash set of benchmark windows.

Native: DataFrame functions only. A document is split into normalised words
once; each word position becomes a row inside one code-generated stage, where
the 64-bit hash of the window that starts there probes the benchmark's hash
table. Only positions that hit leave the stage, after the words themselves were
compared, so a hash collision is never a hit.

Defined results: a null or empty text has no words and no hits; repeated rows
give one result row each; a null item id counts as the item ''; an empty
benchmark or an empty document table gives no hits or no rows; columns beside
the named ones are ignored by ``scan`` and kept by ``decontaminate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import lower_ascii, unused

N = 8
#: A benchmark of more distinct windows than this is joined by shuffle instead of being broadcast.
BROADCAST_WINDOWS = 400_000
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-cased words: runs of ASCII letters and digits and of anything outside ASCII; null has none."""
    return F.coalesce(F.array_remove(F.split(lower_ascii(text), _GAP), ""), F.array().cast("array<string>"))


def windows(benchmark: DataFrame, item_col: str, text_col: str, n: int = N) -> DataFrame:
    """Distinct windows: (len, words, hash, items). An item of fewer than ``n`` words, but not none, is one window."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), words_of(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(n))
    starts = items.select("item", "w", size.alias("len"), F.explode(F.sequence(F.lit(1), F.size("w") - size + 1)).alias("at"))
    each = starts.select("item", "len", F.slice("w", F.col("at"), F.col("len")).alias("words"))
    return each.groupBy("len", "words").agg(F.sort_array(F.collect_set("item")).alias("items")).withColumn("hash", F.xxhash64(F.transform("words", lambda w: F.xxhash64(w))))


def scan(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = N, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """A row per document row: (id, text_hash, n_words, spans, items).

    ``spans`` are the (start, len) word windows that hit, ordered; ``items`` the
    sorted ids of the items whose windows occur. Runs one small action over the
    benchmark, to know the window lengths and whether the set may be broadcast.
    """
    wanted = windows(benchmark, item_col, item_text_col, n)
    sizes = {r["len"]: r["count"] for r in wanted.groupBy("len").count().collect()}  # at most n rows
    small = sum(sizes.values()) <= broadcast_windows

    docs = documents.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), words_of(F.col(text_col)).alias("w"))
    docs = docs.select("id", "text_hash", "w", F.size("w").alias("n_words"), F.transform("w", lambda w: F.xxhash64(w)).alias("h"))

    def window_hash(size: int) -> Column:
        parts = [F.get("h", F.col("at") + i) for i in range(size)]
        return F.when((F.col("at") >= 0) & (F.col("at") + size <= F.col("n_words")), F.xxhash64(F.array(*parts)))

    def probes(at: DataFrame) -> DataFrame:
        if list(sizes) in ([], [n]):
            return at.select("*", F.lit(n).alias("len"), window_hash(n).alias("hash"))
        each = F.array(*[F.struct(F.lit(s).alias("len"), window_hash(s).alias("hash")) for s in sorted(sizes)])
        return at.select("*", F.inline(each)).filter((F.col("at") < 0) | F.col("hash").isNotNull())

    build = wanted.select(F.col("len").alias("b_len"), F.col("hash").alias("b_hash"), F.col("words").alias("b_words"), "items")
    met = (F.col("hash") == F.col("b_hash")) & (F.col("len") == F.col("b_len"))
    same = F.coalesce(F.slice("w", F.greatest(F.col("at") + 1, F.lit(1)), F.col("len")) == F.col("b_words"), F.lit(False))
    found = [
        F.sort_array(F.collect_set(F.when(F.col("ok"), F.struct(F.col("at").alias("at"), F.col("len").alias("len"))))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("ok"), F.col("items")))))).alias("items"),
    ]
    if not small:
        return _shuffled(docs, probes, build, met, same, found)
    # position -1 stands for the document itself, so that one without hits keeps its row
    at = docs.select("id", "text_hash", "n_words", "w", "h", F.explode(F.sequence(F.lit(-1), F.col("n_words") - 1)).alias("at"))
    hit = probes(at).join(F.broadcast(build), met, "left")
    hit = hit.select("id", "text_hash", "n_words", "at", "len", "items", same.alias("ok")).filter((F.col("at") < 0) | F.col("ok"))
    # equal rows fall into one group; the marks of position -1 count them
    marks = 1 if list(sizes) in ([], [n]) else len(sizes)
    grouped = hit.groupBy("id", "text_hash").agg(F.max("n_words").alias("n_words"), (F.count_if(F.col("at") < 0) / marks).cast("int").alias("copies"), *found)
    return grouped.select("id", "text_hash", "n_words", "spans", "items", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("_")).drop("_")


def _shuffled(docs: DataFrame, probes, build: DataFrame, met: Column, same: Column, found: list[Column]) -> DataFrame:
    """``scan`` against a benchmark too large to broadcast: what moves per position is (id, text hash, place, window hash), no words; those are fetched for documents with a hit."""
    one = docs.select("id", "text_hash", "n_words", "h", F.explode(F.sequence(F.lit(0), F.greatest(F.col("n_words") - 1, F.lit(0)))).alias("at"))
    narrow = probes(one).select("id", "text_hash", "at", "len", "hash").filter("hash IS NOT NULL")
    hits = narrow.join(build, met).select("id", "text_hash", "at", "len", "b_words", "items").distinct()
    key = F.xxhash64("id")
    keyed = hits.select("*", key.alias("k")).drop("id")
    texts = docs.select(key.alias("k"), "text_hash", "w").join(keyed.select("k", "text_hash").distinct(), ["k", "text_hash"], "left_semi").dropDuplicates(["k", "text_hash"])
    verified = keyed.join(texts, ["k", "text_hash"]).select("k", "text_hash", "at", "len", "items", same.alias("ok")).groupBy("k", "text_hash").agg(*found)
    rows = docs.select("id", key.alias("k"), "text_hash", "n_words").join(verified, ["k", "text_hash"], "left")
    none = F.array()
    return rows.select("id", "text_hash", "n_words", F.coalesce("spans", none.cast("array<struct<at:int,len:int>>")).alias("spans"), F.coalesce("items", none.cast("array<string>")).alias("items"))


def covered(spans: Column) -> Column:
    """How many words lie inside any of the ordered spans."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))

    def step(acc: Column, s: Column) -> Column:
        end = s["at"] + s["len"]
        return F.struct(
            F.greatest(acc["end"], end).alias("end"),
            (acc["total"] + F.greatest(F.lit(0), end - F.greatest(acc["end"], s["at"]))).alias("total"),
        )

    return F.aggregate(spans, start, step, lambda acc: acc["total"])


def decontaminate(documents: DataFrame, benchmark: DataFrame, mode: str = "documents", min_items: int = 2, drop_items: int | None = None, id_col: str = "doc_id", text_col: str = "text", **names) -> DataFrame:
    """``documents`` without what is in the benchmark.

    ``mode="documents"`` drops each document with windows of at least
    ``min_items`` items; ``mode="spans"`` keeps all documents and cuts the hit
    words, with what follows each up to the next word, out of those. With
    ``drop_items``, it drops documents with windows of at least so many items
    and cuts the others.
    """
    i, h, s, m = (unused(documents.columns, c) for c in ("id", "hash", "spans", "items"))
    found = scan(documents, benchmark, id_col, text_col, **names).filter(F.size("items") >= min_items).select(F.col("id").alias(i), F.col("text_hash").alias(h), F.col("spans").alias(s), F.size("items").alias(m)).dropDuplicates([i, h])
    same = F.col(id_col).eqNullSafe(F.col(i)) & (F.xxhash64(text_col) == F.col(h))
    if mode == "documents":
        return documents.join(found, same, "left_anti")
    if mode != "spans":
        raise ValueError(f"mode is documents or spans, not {mode}")
    # the first piece is what precedes the first word; each other piece is a word and what follows it
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(f"{word}[^0-9A-Za-z\\x{{80}}-\\x{{10FFFF}}]*"), F.lit(0))
    head = F.regexp_extract(F.col(text_col), r"^[^0-9A-Za-z\x{80}-\x{10FFFF}]*", 0)
    inside = lambda at: F.exists(s, lambda x: (at >= x["at"]) & (at < x["at"] + x["len"]))
    kept = F.concat(head, F.array_join(F.filter(pieces, lambda _, at: ~inside(at)), ""))
    joined = documents.join(found, same, "left")
    if drop_items is not None:
        joined = joined.filter(F.coalesce(F.col(m) < drop_items, F.lit(True)))
    joined = joined.withColumn(text_col, F.when(F.col(s).isNull(), F.col(text_col)).otherwise(kept))
    return joined.select(*documents.columns)


def report(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest of ``scan`` that query op4 returns."""
    found = scan(documents, benchmark)
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("n_words").cast("long").alias("n_words"),
        covered(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("items") >= 2).alias("contaminated"),
    )
