"""Ranking, top-k and de-duplication with explicit, total orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import engagement as eng
from tidemark.functions import text as tx
from tidemark.operators import normalize
from tidemark.operators.ordering import positions


def by_engagement() -> list[Column]:
    """Score descending; equal scores keep arrival order."""
    return [eng.item_score().desc(), F.col("ingest_seq").asc()]


def top_k(df: DataFrame, k: int, key: str = "cluster_id",
          order: list[Column] | None = None) -> DataFrame:
    """First ``k`` rows per key with their rank.

    ``rank <= k`` lets Spark place a limit per group *before* the exchange, so a hot key sends at
    most ``k`` rows per task and never meets in one task as a whole.
    """
    w = Window.partitionBy(key).orderBy(*(order or by_engagement()))
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def rank_items(df: DataFrame, key: str = "cluster_id") -> DataFrame:
    """Full 1-based rank of every item in its cluster, whatever the size of the cluster."""
    placed = positions(df, [F.col(key).asc(), *by_engagement()], "_pos")
    first = placed.groupBy(key).agg(F.min("_pos").alias("_first"))
    return (
        placed.join(first, key)
        .withColumn("rank", F.col("_pos") - F.col("_first") + 1)
        .drop("_pos", "_first")
    )


def first_per_key(df: DataFrame, key: str | Column, order: list[Column]) -> DataFrame:
    """One row a key: the first in the given order (``dropDuplicates`` has no order)."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def samples(df: DataFrame, k: int = 5, key: str = "cluster_id") -> DataFrame:
    """Per cluster an array of the top ``k`` samples in rank order."""
    # texts are shortened before the sort, so whole texts never travel
    slim = df.select(key, "ingest_seq", eng.item_score().alias("_score"),
                     normalize.sample().alias("s"))
    best = top_k(slim, k, key, [F.col("_score").desc(), F.col("ingest_seq").asc()])
    packed = F.sort_array(F.collect_list(F.struct("rank", "s")))  # at most k rows a group
    return best.groupBy(key).agg(F.transform(packed, lambda x: x["s"]).alias("sample_videos"))


def merge_samples(df: DataFrame, key: str, old: str, new: str, k: int = 10) -> DataFrame:
    """Old then new samples, first occurrence of each id, best ``k`` by score.

    Samples carry neither shares nor saves, so the score is likes + 2 comments.
    Both arrays hold at most ``k`` entries, so this stays inside the row.
    """
    both = F.coalesce(F.concat(old, new), F.col(old), F.col(new))
    return df.withColumn("sample_videos", merged(both, k))


def merged(both: Column, k: int = 10) -> Column:
    """De-duplicate and re-rank one array of samples."""
    ids = F.transform(both, lambda s: F.coalesce(s["content_id"], F.lit("")))
    at = F.transform(both, lambda s, i: F.struct(
        (-eng.score(s["likes"], s["comments"])).alias("o"), i.alias("i"), s.alias("s")))
    fresh = F.filter(at, lambda x: F.array_position(
        ids, F.coalesce(x["s"]["content_id"], F.lit(""))) == x["i"] + 1)
    ordered = F.array_sort(fresh, lambda a, b: (
        F.when(a["o"] < b["o"], -1).when(a["o"] > b["o"], 1)
        .when(a["i"] < b["i"], -1).when(a["i"] > b["i"], 1).otherwise(0)))
    return F.slice(F.transform(ordered, lambda x: x["s"]), 1, k)


def listing(df: DataFrame, limit: int = 100, sentiments=None, risks=None,
            types=None) -> DataFrame:
    """Newest ``limit`` first, *then* facets, then views and likes descending."""
    from tidemark.operators.quality import facet

    newest = df.orderBy(F.col("timestamp").desc(), F.col("trend_id")).limit(limit)
    return facet(newest, sentiments, risks, types).orderBy(*by_views())


def by_views() -> list[Column]:
    return [F.coalesce("total_views", F.lit(0)).desc(), F.coalesce("total_likes", F.lit(0)).desc(),
            F.col("trend_id")]


def top_chart(df: DataFrame, k: int = 10) -> DataFrame:
    return df.orderBy(*by_views()).limit(k)


def admin_listing(df: DataFrame, query: str | None = None, limit: int = 200) -> DataFrame:
    """Newest ``limit``, text search, order by views, 1-based row number."""
    from tidemark.operators.quality import search

    newest = df.orderBy(F.col("timestamp").desc(), F.col("trend_id")).limit(limit)
    found = search(newest, query) if query else newest
    # at most `limit` rows reach this single-partition window
    return found.withColumn("row_no", F.row_number().over(Window.orderBy(*by_views())))


def queue(df: DataFrame, status: str = "pending", limit: int = 100,
          at: str = "created_at", tie: str = "id") -> DataFrame:
    """Newest-first review queue."""
    from tidemark.operators.quality import by_status

    return by_status(df, status).orderBy(F.col(at).desc(), F.col(tie)).limit(limit)


def detail(df: DataFrame, trend_id: str, k: int = 3, chars: int = 150) -> DataFrame:
    """One trend with its first ``k`` samples, texts shortened."""
    short = F.transform(
        F.slice("sample_videos", 1, k),
        lambda s: s.withField("text", tx.cut(s["text"], chars)))
    return df.filter(F.col("trend_id") == trend_id).withColumn("sample_videos", short)
