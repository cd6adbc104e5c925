"""A paged service as a source behind an injected client."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TRANSIENT = (500, 502, 503, 504)
PAGE, BATCH, THREADS = 50, 50, 100


class ApiError(Exception):
    """A failed call: HTTP status, and a reason such as quota or disabled."""

    def __init__(self, status: int, reason: str = ""):
        super().__init__(f"{status} {reason}")
        self.status, self.reason = status, reason


class Client(Protocol):
    """What a source needs of a service; each call returns (items, next page token)."""

    def search(self, query: str, size: int, token: str | None, key: str) -> tuple[list[dict], str | None]: ...

    def details(self, ids: list[str], key: str) -> list[dict]: ...

    def threads(self, video: str, size: int, token: str | None, key: str) -> tuple[list[dict], str | None]: ...


class Caller:
    """Retries transient failures with doubling waits, and goes to the next key when a quota is used up."""

    def __init__(self, keys: list[str], tries: int = 4, sleep: Callable[[float], None] = time.sleep):
        self.keys, self.at, self.tries, self.sleep = keys, 0, tries, sleep

    def __call__(self, call: Callable[[str], object]):
        attempt = 0
        while True:
            try:
                return call(self.keys[self.at])
            except (ApiError, ConnectionError) as e:
                if isinstance(e, ApiError) and e.reason == "quota":
                    if self.at + 1 == len(self.keys):
                        raise
                    self.at += 1
                    continue
                attempt += 1
                if attempt == self.tries or (isinstance(e, ApiError) and e.status not in TRANSIENT):
                    raise
                self.sleep(2.0 ** (attempt - 1))


def pages(call: Callable[[str | None], tuple[list[dict], str | None]], limit: int) -> Iterator[dict]:
    """Items page by page until the limit or the last token; disabled comments end what was read."""
    token, n = None, 0
    while n < limit:
        try:
            items, token = call(token)
        except ApiError as e:
            if e.reason == "disabled":
                return
            raise
        for item in items[: limit - n]:
            yield item
            n += 1
        if not token:
            return


def search(client: Client, caller: Caller, query: str, limit: int) -> list[dict]:
    """Found items with their details, in batches of ids."""
    found = list(pages(lambda t: caller(lambda k: client.search(query, min(PAGE, limit), t, k)), limit))
    more = {}
    for i in range(0, len(found), BATCH):
        ids = [x["id"] for x in found[i : i + BATCH]]
        more |= {d["id"]: d for d in caller(lambda k, ids=ids: client.details(ids, k))}
    return [x | more.get(x["id"], {}) for x in found]


def threads(client: Client, caller: Caller, video: str, limit: int) -> list[dict]:
    """S10."""
    return list(pages(lambda t: caller(lambda k: client.threads(video, min(THREADS, limit), t, k)), limit))


def source_rows(spark: SparkSession, payloads: list[str]) -> DataFrame:
    """JSON payloads of found items as rows."""
    schema = "id string, title string, channel string, statistics struct<viewCount:string,likeCount:string,commentCount:string>, duration string"
    rows = spark.createDataFrame([(p,) for p in payloads], "raw string").select(F.from_json("raw", schema).alias("p"))
    number = lambda c: F.col(f"p.statistics.{c}").try_cast("bigint")
    return rows.select(F.col("p.id").alias("external_id"), F.concat(F.lit("https://video.example/watch?v="), "p.id").alias("url"), F.col("p.title").alias("name"), F.col("p.channel").alias("channel_title"), number("viewCount").alias("views"), number("likeCount").alias("likes"), number("commentCount").alias("comments"), F.col("p.duration").alias("duration"))


def document_rows(threads: DataFrame, video: Column, inline: int = 5) -> DataFrame:
    """Threads (id, text, author, published_at, replies) as document rows with their first replies inline."""
    return threads.select(F.col("id").alias("external_id"), video.alias("video_id"), "text", "author", F.try_to_timestamp("published_at").alias("created_at"), F.slice("replies", 1, inline).alias("replies"))
