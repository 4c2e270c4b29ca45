"""Aggregations over items, clusters, trends and run metrics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import engagement as eng
from tidemark.functions import times
from tidemark.functions import vectors as vec


def trend_rollup(df: DataFrame, key: str = "cluster_id") -> DataFrame:
    """Item count, views and likes over all items of a cluster (partial sums before the shuffle)."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("video_count"),
        F.sum(eng.zero(F.col("views"))).alias("total_views"),
        F.sum(eng.zero(F.col("likes"))).alias("total_likes"),
    )


def source_rows(df: DataFrame, key: str = "cluster_id") -> DataFrame:
    return df.groupBy(key, "source").agg(F.count(F.lit(1)).alias("n"))


def source_counts(df: DataFrame, key: str = "cluster_id") -> DataFrame:
    """Map source -> count per cluster: counted first, then one small entry a source."""
    entries = F.sort_array(F.collect_list(F.struct("source", "n")))
    return source_rows(df, key).groupBy(key).agg(F.map_from_entries(entries).alias("source_counts"))


def centroids(df: DataFrame, key: str = "cluster_id", vector: str = "embedding") -> DataFrame:
    """Element-wise mean vector per cluster; the mean merges, so no group is gathered."""
    v = array_to_vector(vec.as_doubles(F.col(vector)))
    return df.groupBy(key).agg(
        vector_to_array(Summarizer.mean(v)).alias("centroid"), F.count(F.lit(1)).alias("size"))


def trend_totals(df: DataFrame) -> DataFrame:
    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).alias(name)

    return df.agg(
        F.count(F.lit(1)).alias("total_trends"), total("video_count").alias("total_videos"),
        total("total_views"), total("total_likes"))


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def batch_summary(trends: DataFrame) -> DataFrame:
    """(facet, value, n): trend counts by sentiment, risk and type; item totals by source."""
    facets = F.array(*[
        F.struct(F.lit(name).alias("facet"), F.coalesce(F.col(name), F.lit("unknown")).alias("value"),
                 F.lit(1).cast("long").alias("n"))
        for name in ("sentiment", "risk_level", "content_type")])
    sources = F.transform(
        F.map_entries(F.coalesce("source_counts", F.create_map().cast("map<string,bigint>"))),
        lambda e: F.struct(F.lit("source").alias("facet"), e["key"].alias("value"),
                           e["value"].alias("n")))
    return (
        trends.select(F.explode(F.concat(facets, sources)).alias("x")).select("x.*")
        .groupBy("facet", "value").agg(F.sum("n").alias("n"))
    )


def cluster_sizes(df: DataFrame, key: str = "cluster_id") -> DataFrame:
    """Clusters without noise, largest first."""
    return (
        df.filter(F.col(key) != -1).groupBy(key).agg(F.count(F.lit(1)).alias("size"))
        .orderBy(F.col("size").desc(), F.col(key))
    )


def cluster_stats(df: DataFrame, key: str = "cluster_id") -> DataFrame:
    """Count, average, least and greatest size, noise count and rate in percent (1 decimal)."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("size"))
    real = F.col(key) != -1
    noise = F.coalesce(F.sum(F.when(~real, F.col("size"))), F.lit(0))
    inside = F.coalesce(F.sum(F.when(real, F.col("size"))), F.lit(0))
    return sizes.agg(
        F.count(F.when(real, 1)).alias("cluster_count"),
        F.avg(F.when(real, F.col("size"))).alias("avg_size"),
        F.min(F.when(real, F.col("size"))).alias("min_size"),
        F.max(F.when(real, F.col("size"))).alias("max_size"),
        noise.alias("noise_count"),
        F.round(F.coalesce(eng.ratio(noise * 100.0, inside + noise), F.lit(0.0)), 1).alias(
            "noise_rate"),
    )


def share(df: DataFrame, key: str = "source", count: str = "n") -> DataFrame:
    """Percent of the total per key (1 decimal); takes counted rows, one a key."""
    total = F.sum(count).over(Window.partitionBy())
    return df.withColumn("pct", F.round(F.coalesce(
        eng.ratio(F.col(count) * 100.0, total), F.lit(0.0)), 1))


def keyword_union(a: Column, b: Column) -> Column:
    return F.sort_array(F.array_union(
        F.coalesce(a, F.array().cast("array<string>")), F.coalesce(b, F.array().cast("array<string>"))))


def stage_counts(df: DataFrame, reached: Column, stages: list[str]) -> DataFrame:
    """In, out and dropped per stage in one pass.

    ``reached`` is the number of stages a row passed (0 = stopped at the first).
    """
    tallied = df.select(reached.alias("r")).groupBy("r").agg(F.count(F.lit(1)).alias("n"))
    rows = F.explode(F.array(*[
        F.struct(F.lit(i).alias("stage_no"), F.lit(s).alias("stage")) for i, s in enumerate(stages)]))
    entered = F.sum(F.when(F.col("r") >= F.col("x.stage_no"), F.col("n")).otherwise(0))
    left = F.sum(F.when(F.col("r") > F.col("x.stage_no"), F.col("n")).otherwise(0))
    return (
        tallied.select("r", "n", rows.alias("x"))
        .groupBy(F.col("x.stage_no").alias("stage_no"), F.col("x.stage").alias("stage"))
        .agg(entered.alias("input_count"), left.alias("output_count"))
        .withColumn("dropped", F.col("input_count") - F.col("output_count"))
    )


def observed_stages(df: DataFrame, reached: Column, stages: list[str]) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """(rows, counts): the stage counts come from the pass that writes the rows, not from a pass of their own.

    ``counts()`` is called after that write and has the columns of :func:`stage_counts`, zeros for no rows.  The
    rows must go to their write without a further shuffle: a task of a write that runs again counts once, one of
    a shuffle may count twice.
    """
    seen = Observation()
    observed = df.observe(seen, *[F.count_if(reached >= i).alias(f"s{i}") for i in range(len(stages) + 1)])

    def counts() -> DataFrame:
        n = [seen.get[f"s{i}"] for i in range(len(stages) + 1)]
        return df.sparkSession.createDataFrame(
            [(i, s, n[i], n[i + 1], n[i] - n[i + 1]) for i, s in enumerate(stages)],
            "stage_no int, stage string, input_count long, output_count long, dropped long")
    return observed, counts


_STAGE = schemas.RUN_METRICS["stages"].dataType.valueType


def _stage(**known: Column) -> Column:
    return F.struct(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in _STAGE.fields])


def _tally(df: DataFrame, key: str) -> Column:
    """Map from value to rows, rows without a value left out, as a scalar."""
    counted = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.map_from_entries(F.collect_list(F.struct(key, "n")))).scalar()


def run_record(counts: DataFrame, items: DataFrame, trends: DataFrame, now, key: str = "cluster_id") -> DataFrame:
    """One row in the layout of the metrics files.

    ``counts`` are stage counts, ``items`` the clustered items, ``trends`` the merged and new ones (``is_merged``).
    """
    stages = counts.agg(F.map_from_entries(F.collect_list(F.struct("stage", _stage(
        input_count=F.col("input_count"), output_count=F.col("output_count")))))).scalar()
    groups = cluster_sizes(items, key).agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("size"), asc=False).alias("sizes"))
    noise = cluster_stats(items, key)
    merged = trends.agg(F.struct(F.count_if("is_merged").alias("old"), F.count_if(~F.col("is_merged")).alias("new"),
                                 F.count(F.lit(1)).alias("all"))).scalar()
    cluster = groups.agg(F.first(F.struct("n", "sizes"))).scalar()
    noisy = noise.agg(F.first(F.struct("noise_count", "noise_rate"))).scalar()
    late = F.create_map(
        F.lit("ClusteringStage"), _stage(
            cluster_count=cluster["n"], cluster_sizes=cluster["sizes"], noise_count=noisy["noise_count"],
            noise_rate=F.concat(noisy["noise_rate"].cast("string"), F.lit("%"))),
        F.lit("DeduplicationStage"), _stage(new_trends=merged["new"], merged_trends=merged["old"]),
        F.lit("StorageStage"), _stage(saved_count=merged["all"]))
    return items.sparkSession.range(1).select(
        F.date_format(times.clock(now), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.map_concat(stages, late).alias("stages"),
        F.struct(_tally(items, "source").alias("source_distribution"), *[
            _tally(trends, name).alias(name) for name in ("sentiment", "risk_level", "content_type")]).alias("summary"))


def summarize_runs(runs: DataFrame) -> DataFrame:
    """(metric, value, n) over all batches: totals, mean cluster size, merged facet counts."""
    def stage(name: str, field: str) -> Column:
        return F.coalesce(F.col("stages")[name][field], F.lit(0)).cast("double")

    def total(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("metric"), F.lit("").alias("value"), value.alias("n"))

    totals = F.array(
        total("total_batches", F.lit(1.0)),
        total("total_items_processed", stage("NormalizationStage", "input_count")),
        total("total_clusters_detected", stage("ClusteringStage", "cluster_count")),
        total("total_trends_saved", stage("StorageStage", "saved_count")),
    )
    sums = runs.select(F.explode(totals).alias("x")).select("x.*").groupBy("metric", "value").agg(
        F.sum("n").alias("n"))
    sizes = runs.select(
        F.explode(F.col("stages")["ClusteringStage"]["cluster_sizes"]).alias("size"))
    mean = sizes.agg(F.coalesce(F.avg("size"), F.lit(0.0)).alias("n")).select(
        F.lit("avg_cluster_size").alias("metric"), F.lit("").alias("value"), "n")
    out = sums.unionByName(mean)
    for facet in ("sentiment", "risk_level", "source_distribution"):
        counts = runs.select(F.explode(F.col("summary")[facet]).alias("value", "c")).groupBy(
            "value").agg(F.sum("c").cast("double").alias("n"))
        out = out.unionByName(counts.select(F.lit(facet).alias("metric"), "value", "n"))
    return out
