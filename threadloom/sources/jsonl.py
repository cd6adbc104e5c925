"""Line-wise JSON sources with validation, and format detection."""

from __future__ import annotations

import csv
import io
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.functions.text import without_bom

REPLY = "struct<text:string,reply_id:string,author_display_name:string,like_count:bigint,published_at:timestamp>"
COMMENT = f"comment_text string, comment_id string, comment_author string, comment_published_at timestamp, comment_like_count bigint, comment_total_reply_count bigint, video_id string, video_title string, video_channel string, video_url string, search_query string, comment_replies array<{REPLY}>"
_TEXT = ("comment_id", "comment_author", "video_id", "video_title", "video_channel", "video_url", "search_query")
HEAD = 128 * 1024


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, raw): the lines of a file or folder, numbered from 1 within each file.

    A file is numbered by one task; the number must be the line's true place.
    """
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\n")).alias("pos", "raw"))
    return whole.select("file", (F.col("pos") + 1).cast("long").alias("line"), F.regexp_replace(without_bom(F.col("raw")), "\r$", "").alias("raw"))


def _class(raw: Column, parsed: Column) -> Column:
    """First class that fits: blank, invalid_json, not_an_object, invalid_record, empty_text, valid."""
    value = F.try_parse_json(raw)
    is_object = F.schema_of_variant(value).startswith("OBJECT")
    return (
        F.when(F.trim(raw) == "", "blank")
        .when(value.isNull(), "invalid_json")
        .when(~is_object, "not_an_object")
        .when(parsed["comment_text"].isNull() | (F.coalesce(parsed["comment_like_count"], F.lit(0)) < 0) | (F.coalesce(parsed["comment_total_reply_count"], F.lit(0)) < 0), "invalid_record")
        .when(F.exists(F.coalesce(parsed["comment_replies"], F.array().cast(f"array<{REPLY}>")), lambda r: r["text"].isNull()), "invalid_record")
        .when(F.trim(parsed["comment_text"]) == "", "empty_text")
        .otherwise("valid")
    )


def inspected(rows: DataFrame) -> DataFrame:
    """``lines`` with the parsed record and the line's class; a bad line is classified, never fatal."""
    parsed = rows.withColumn("record", F.from_json("raw", COMMENT))
    return parsed.withColumn("class", _class(F.col("raw"), F.col("record")))


def comments(rows: DataFrame, strict: bool = False) -> DataFrame:
    """The valid records with defaults for what is missing. Strict: the first bad line raises, with its number and class only."""
    checked = inspected(rows).filter("class <> 'blank'")
    if strict:
        bad = ~F.col("class").isin("valid", "empty_text")
        told = F.raise_error(F.concat(F.lit("invalid record at line "), F.col("line").cast("string"), F.lit(": "), F.col("class")))
        checked = checked.withColumn("class", F.when(bad, told.cast("string")).otherwise(F.col("class")))
    kept = checked.filter(F.col("class").isin("valid", "empty_text"))
    out = kept.select("file", "line", "record.*")
    for c in _TEXT:
        out = out.withColumn(c, F.coalesce(c, F.lit("")))
    for c in ("comment_like_count", "comment_total_reply_count"):
        out = out.withColumn(c, F.coalesce(c, F.lit(0)))
    return out.withColumn("comment_replies", F.coalesce("comment_replies", F.array().cast(f"array<{REPLY}>")))


def error_samples(rows: DataFrame, n: int = 100) -> DataFrame:
    """The first bad lines by place: number, class and digest, never a value."""
    bad = inspected(rows).filter(~F.col("class").isin("blank", "valid", "empty_text"))
    return bad.select("file", "line", "class", F.sha2("raw", 256).alias("sha256")).orderBy("file", "line").limit(n)


def detect_format(head: bytes, name: str = "") -> str:
    """The physical format told by a file's first 128 KiB."""
    head = head[:HEAD]
    if not head.strip():
        return "empty"
    if head[:4] == b"PK\x03\x04":
        return "zip"
    if head[:2] == b"\x1f\x8b":
        return "gzip"
    text = None
    for cut in range(4 if len(head) == HEAD else 1):  # the cut may split a character
        try:
            text = head[: len(head) - cut].decode("utf-8-sig")
            break
        except UnicodeDecodeError:
            continue
    if text is None or "\0" in text:
        return "binary"
    body = text.lstrip()
    if body[:200].lower().startswith(("<!doctype html", "<html")):
        return "html"
    if body.startswith("["):
        return "json_array"
    if body.startswith("{"):
        rows = [x for x in text.splitlines() if x.strip()]
        if len(rows) == 1 and name.endswith(".json"):
            return "json_object"
        good = 0
        for x in rows:
            try:
                good += isinstance(json.loads(x), dict)
            except ValueError:
                pass
        if good * 2 >= len(rows):
            return "jsonl"
        return "json_object"
    for delimiter, kind in (("\t", "tsv"), (",", "csv"), (";", "csv")):
        table = [r for r in csv.reader(io.StringIO(text), delimiter=delimiter)][:20]
        if len(table) >= 2 and len(table[0]) >= 2 and len({len(r) for r in table[:-1]}) == 1:
            return kind
    return "text"


def formats(spark: SparkSession, path: str) -> DataFrame:
    """S04 over a folder: (path, length, format); only heads leave the files."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", F.substring("content", 1, HEAD).alias("head"))
    tell = F.udf(lambda head, name: detect_format(bytes(head or b""), name), T.StringType())
    return files.select("path", "length", tell("head", "path").alias("format"))
