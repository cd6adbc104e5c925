"""Threads and nested data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def threads(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of a thread as one array, in order."""
    each = F.struct("turn", "role", "text")
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(each)).alias("turns"))


def flatten(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """The first turn as a comment and each later one as its reply; ids are made of the thread's and the turn's."""
    each = rows.select(key, F.posexplode("turns").alias("pos", "t"))
    record = lambda turn: F.concat_ws(":", F.col(key).cast("string"), turn.cast("string"))
    return each.select(
        record(F.col("t.turn")).alias("record_id"),
        F.when(F.col("t.turn") == 0, "comment").otherwise("reply").alias("text_kind"),
        F.when(F.col("t.turn") > 0, record(F.lit(0))).alias("parent_record_id"),
        F.col("t.role").alias("author"),
        F.col("t.text").alias("text"),
    )


def flatten_export(comments: DataFrame) -> DataFrame:
    """P01 for exported comments: one row per comment and per reply, missing ids made of digests."""
    cid = F.when(F.coalesce("comment_id", F.lit("")) != "", F.col("comment_id")).otherwise(F.concat(F.lit("comment:"), F.sha2(F.to_json(F.struct("*")), 256)))
    base = comments.withColumn("_cid", cid)
    first = base.select(F.col("_cid").alias("record_id"), F.lit("comment").alias("text_kind"), F.lit(None).cast("string").alias("parent_record_id"), F.col("comment_text").alias("text"), F.col("comment_author").alias("author"), F.col("comment_like_count").alias("like_count"), "video_id")
    each = base.select("_cid", "video_id", F.posexplode("comment_replies").alias("pos", "r"))
    ident = F.concat_ws(chr(31), "_cid", F.col("pos").cast("string"), F.col("r.text"), F.coalesce(F.col("r.published_at").cast("string"), F.lit("")))
    rid = F.when(F.coalesce("r.reply_id", F.lit("")) != "", F.col("r.reply_id")).otherwise(F.concat(F.lit("reply:"), F.sha2(ident, 256)))
    replies = each.select(rid.alias("record_id"), F.lit("reply").alias("text_kind"), F.col("_cid").alias("parent_record_id"), F.col("r.text").alias("text"), F.col("r.author_display_name").alias("author"), F.col("r.like_count").alias("like_count"), "video_id")
    return first.unionByName(replies)


def search(rows: DataFrame, term: str) -> DataFrame:
    """Threads with ``matches``, the turns whose text contains the term in any case."""
    found = F.filter("turns", lambda x: F.contains(F.lower(x["text"]), F.lit(term.lower())))
    return rows.withColumn("matches", found).filter(F.size("matches") > 0)


def haystack(keywords: Column, texts: Column) -> Column:
    """What a full-text search over a topic looks into."""
    return F.lower(F.concat_ws(" ", F.array_join(keywords, " "), F.array_join(texts, " ")))


def with_array(json: Column, path: str = "$.comments") -> Column:
    """Whether a JSON object holds an array at the path."""
    return F.json_array_length(F.get_json_object(json, path)).isNotNull()
