"""Queries that run Structured Streaming over the given tables to completion."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tidemark.catalog.base import ITEMS, query
from tidemark.operators import rollup
from tidemark.runtime import scratch_path
from tidemark.sources import fixtures as fx
from tidemark.streaming import intake


# rows of a message file, so that what a micro-batch reads does not grow with the table
FILE_ROWS = 50_000


def _landing(spark, sf, copies=1, least=4):
    """All items as message files, each delivered ``copies`` times, in ``least`` files or more."""
    root = scratch_path(spark, "landing")
    items = fx.content_items(spark, sf).select(
        "source", "content_id", "collected_at", F.length("text").cast("long").alias("chars"))
    repeated = items.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")
    files = max(least, math.ceil(copies * items.count() / FILE_ROWS))
    repeated.repartition(files).write.json(root)
    return root, items.schema


def _finish(query_):
    query_.awaitTermination()
    if query_.exception() is not None:
        raise query_.exception()


@query("stream_without_replays", f"""WITH {ITEMS} SELECT source, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars
FROM items GROUP BY source""")
def stream_without_replays(spark, sf):
    """Every message delivered twice, counted once."""
    root, schema = _landing(spark, sf, copies=2)
    out = scratch_path(spark, "stream-out")
    stream = intake.without_replays(intake.stream_files(spark, root, schema, max_files=2))
    _finish(stream.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", scratch_path(spark, "stream-ckpt")).trigger(availableNow=True).start())
    return spark.read.parquet(out).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))


@query("stream_hold_back", f"""WITH {ITEMS} SELECT source, count(*) AS n FROM items GROUP BY source""")
def stream_hold_back(spark, sf):
    """Twelve micro-batches or more of one file; rows wait until enough are there, then one run takes them."""
    root, schema = _landing(spark, sf, least=12)
    base = scratch_path(spark, "hold")
    total = spark.read.schema(schema).json(root).count()

    def process(batch, run):
        batch.write.mode("overwrite").parquet(f"{base}/out/run={run}")

    # a quarter of all rows: no single file is enough, several runs each take the files that wait
    target = intake.HoldBack(base, process, min_rows=max(1, total // 4))
    stream = intake.stream_files(spark, root, schema, max_files=1)
    _finish(target.start(stream, f"{base}/checkpoint"))
    left = target.waiting(spark, schema).select("source")
    return rollup.count_by(spark.read.parquet(f"{base}/out").select("source").unionByName(left), "source")


@query("stream_restart", f"""WITH {ITEMS}, p AS (SELECT unnest([0, 1]) AS pass)
SELECT pass, source, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM items, p GROUP BY 1, 2""")
def stream_restart(spark, sf):
    """Everything read once, then again from the earliest message: both passes take every row, under names of their own."""
    root, schema = _landing(spark, sf)
    base = scratch_path(spark, "again")

    def process(batch, run):
        batch.write.mode("overwrite").parquet(f"{base}/out/run={run}")

    target = intake.HoldBack(base, process, min_rows=1)
    for begin in (target.start, target.restart):
        _finish(begin(intake.stream_files(spark, root, schema, max_files=2), f"{base}/checkpoint"))
    again = F.col("run").startswith("run-1-") & (F.size(F.split("run", "-")) == 3)
    return spark.read.parquet(f"{base}/out").groupBy(again.cast("int").alias("pass"), "source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))


@query("stream_events_by_type", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type")
def stream_events_by_type(spark, sf):
    """The events table read as a stream lands the same rows as the batch read."""
    schema = fx.table(spark, sf, "events").schema
    out = scratch_path(spark, "events-out")
    stream = intake.stream_files(spark, sf, schema, "parquet", name="events.parquet")
    _finish(stream.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", scratch_path(spark, "events-ckpt")).trigger(availableNow=True).start())
    return spark.read.parquet(out).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))
