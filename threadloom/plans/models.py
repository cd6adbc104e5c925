"""Queries of models and streams."""

import uuid

from pyspark.sql import functions as F

from threadloom.operators import clustering as M
from threadloom.operators import evaluation as E
from threadloom.operators import vectors as V
from threadloom.plans.registry import query
from threadloom.plans.topics import NEAR, PAIRS, embeddings
from threadloom.sources.shared import shared_dir
from threadloom.sources.tables import table
from threadloom.streaming import ingest


@query(f'WITH {PAIRS} SELECT l AS "left", r AS "right", round(s, 6) AS similarity FROM pairs')
def j09_lsh_candidates(spark, d):
    """At this threshold hashing would need about a thousand tables, so all pairs are compared and the recall is 1."""
    return V.candidate_pairs(embeddings(spark, d), "vec_id", "embedding", NEAR).withColumn("similarity", F.round("similarity", 6))


@query()
def m01_embedded_texts(spark, d):
    rows = table(spark, d, "benchmark").select("item_id", "text")
    return M.embedded(rows, "text").select("item_id", "embedding")


@query()
def m06_pca_reduction(spark, d):
    return M.reduced(embeddings(spark, d), "vec_id", "embedding", 5)


@query()
def m07_reduction_quality(spark, d):
    rows = embeddings(spark, d)
    coords = M.reduced(rows, "vec_id", "embedding", 5)
    return M.reduction_quality(coords, "vec_id").crossJoin(M.trust(rows, coords, "vec_id", "embedding"))


#: Cluster size and core neighbours at which the synthetic vectors, which lie far apart, show clusters.
SMALLEST, CORE = 8, 1


def _dense(rows):
    return M.clustered(M.reduced(rows, "vec_id", "embedding", 5), "vec_id", SMALLEST, CORE)


@query()
def m08_density_clusters(spark, d):
    return _dense(embeddings(spark, d))


@query()
def m15_bootstrap(spark, d):
    """Agreement of the clusters of the whole with those of a resample of four fifths."""
    rows = embeddings(spark, d)
    part = rows.filter(F.pmod(F.xxhash64(F.lit(42), "vec_id"), F.lit(5)) > 0)
    again = _dense(part).select("vec_id", F.col("label").alias("label_again"))
    return E.agreement(_dense(rows).join(again, "vec_id"), "label", "label_again")


@query("SELECT user_id AS external_id, max(event_id) AS event_id FROM events GROUP BY 1")
def t01_incremental_ingest(spark, d):
    """A stream read to its end into a table that is then read back."""
    target = f"{shared_dir(spark)}/threadloom/ingest-{uuid.uuid4().hex}"
    source = table(spark, d, "events")
    stream = spark.readStream.schema(source.schema).parquet(f"{d}/events.parquet*")
    rows = stream.select(F.col("user_id").alias("external_id"), "event_id")
    ingest.run(rows, f"{target}/table", f"{target}/checkpoint", "external_id", "event_id")
    return spark.read.parquet(f"{target}/table").select("external_id", "event_id")


@query("""SELECT time_bucket(INTERVAL 1 DAY, ts) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def t08_daily_counts(spark, d):
    """T08; the batch twin of ``ingest.daily``."""
    return ingest.daily(table(spark, d, "events")).select("day", "event_type", "n", F.round("total", 4).alias("total"))
