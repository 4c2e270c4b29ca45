"""Test adapter: the given tables read as items, trends and keyword tables.

Everything is plain integer arithmetic on the table's own columns over all rows, so that SQL can
rebuild the same inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import Settings
from tidemark.functions import vectors as vec
from tidemark.operators import ranking, rollup
from tidemark.runtime import spread, utc

NOW = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf: str, name: str, heavy: bool = False) -> DataFrame:
    """A given table; ``heavy`` deals its rows out for work that is dear per row."""
    df = utc(spark).read.parquet(f"{sf}/{name}.parquet")
    return spread(df) if heavy else df


def _mix(d: Column, factor: int, modulus: int) -> Column:
    return (d * F.lit(factor)) % F.lit(modulus)


def content_items(spark: SparkSession, sf: str, heavy: bool = False) -> DataFrame:
    """``documents`` as unified items; ``lang`` stands in for the cluster where one is needed."""
    doc = table(spark, sf, "documents", heavy)
    d = F.col("doc_id")
    source = (
        F.when(d % 3 == 0, "tiktok").when(d % 3 == 1, "youtube").otherwise("vnexpress"))
    video, short = (d % 3) != 2, (d % 3) == 0
    hours = F.make_dt_interval(hours=(d % 720).cast("int"))
    return doc.select(
        d.cast("string").alias("content_id"), source.alias("source"),
        F.lit(NOW).cast("timestamp").alias("collected_at"), "text",
        F.lit(None).cast("string").alias("url"), F.array("lang", "source").alias("hashtags"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp") + hours).alias("published_at"),
        F.when(video, _mix(d, 7919, 100000)).alias("views"),
        F.when(video, _mix(d, 104729, 5000)).alias("likes"),
        F.when(video, _mix(d, 1299709, 800)).alias("comments"),
        F.when(short, _mix(d, 15485863, 400)).alias("shares"),
        F.when(short, _mix(d, 32452843, 300)).alias("collects"),
        F.when(short, _mix(d, 49979687, 5000)).alias("author_followers"),
        F.concat(F.lit("a"), (d % 97).cast("string")).alias("author_name"),
        F.col("lang").alias("language"), d.alias("ingest_seq"), F.col("lang").alias("cluster_id"),
        F.col("source").alias("channel"),
    )


def unit_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id"), vec.as_doubles(F.col("embedding")).alias("embedding"), "label")


def trends(spark: SparkSession, sf: str, with_vectors: bool = False) -> DataFrame:
    """All documents rolled up by language, group and side; both sides hold every other 500 ids.

    Each thousand ids has 50 groups of its own, so the number of trends grows with the table.  Side ``s``
    plays the stored trends, side ``n`` the new ones.  The vectors are dealt round to the documents.
    """
    seq = F.col("ingest_seq")
    items = content_items(spark, sf).withColumn("g", F.floor(seq / 1000) * 50 + seq % 50).withColumn(
        "side", F.when(F.floor(F.col("ingest_seq") / 500) % 2 == 0, "s").otherwise("n"))
    items = items.withColumn("cluster_id", F.concat_ws("-", "side", "language", "g"))
    groups = items.groupBy("cluster_id", "language", "g", "side").agg(
        F.count(F.lit(1)).alias("video_count"),
        F.sum(F.coalesce("views", F.lit(0))).alias("total_views"),
        F.sum(F.coalesce("likes", F.lit(0))).alias("total_likes"),
        F.max("published_at").alias("timestamp"),
        F.sort_array(F.collect_set("channel")).alias("keywords"),
    )
    counts = rollup.source_counts(items)
    samples = ranking.samples(items, Settings().sample_top)
    g = F.col("g")
    pick = lambda names, m: F.element_at(
        F.array(*[F.lit(x) for x in names]), (m + 1).cast("int"))
    out = (
        groups.join(counts, "cluster_id").join(samples, "cluster_id")
        .select(
            F.col("cluster_id").alias("trend_id"), "side", "timestamp",
            F.col("timestamp").alias("last_updated"),
            F.concat(F.lit("Topic "), F.col("language"), F.lit(" "), g.cast("string")).alias("topic"),
            F.concat(F.lit("About "), F.col("cluster_id")).alias("summary"),
            pick(("positive", "negative", "neutral"), g % 3).alias("sentiment"),
            "keywords", "video_count", "total_views", "total_likes", "sample_videos",
            "source_counts",
            pick(("entertainment", "drama", "dangerous", "social_issue", "commercial"),
                 g % 5).alias("content_type"),
            pick(("safe", "cautious", "high_risk", "dangerous"), g % 4).alias("risk_level"),
            F.lit(None).cast("string").alias("guidelines"),
        )
    )
    if not with_vectors:
        return out
    vectors = unit_vectors(spark, sf).select(
        F.col("vec_id").alias("v"), "embedding")
    many = F.lit(max(1, vectors.count()))
    members = items.select("cluster_id", (seq % many).alias("v")).join(vectors, "v")
    means = rollup.centroids(members).select(
        F.col("cluster_id").alias("trend_id"), F.col("centroid").alias("vector"))
    return out.join(means, "trend_id")
