"""Incremental intake: resume, commit after success, hold-back of small batches, replay safety."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import store


def stream_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json",
                 max_files: int | None = None, name: str | None = None) -> DataFrame:
    """Files of a folder as a stream; ``name`` picks files by pattern, ``max_files`` caps the rate
    per micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if name is not None:
        reader = reader.option("pathGlobFilter", name)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def without_replays(stream: DataFrame, at: str = "collected_at", delay: str = "3 days",
                    keys=("source", "content_id")) -> DataFrame:
    """Messages may be delivered twice; the first of each key within the delay is kept."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))


def unread(messages: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows at or after the stored next offset of their partition; unknown partitions from start.

    The manifest has one row a topic partition.
    """
    return messages.join(manifest, ["topic", "partition"], "left").filter(
        F.col("offset") >= F.coalesce("next_offset", F.lit(0))).drop("next_offset")


def advance(manifest: DataFrame, read: DataFrame) -> DataFrame:
    """Next manifest: greatest offset read + 1 per partition, never backwards."""
    seen = read.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))
    return manifest.unionByName(seen).groupBy("topic", "partition").agg(
        F.max("next_offset").alias("next_offset"))


def gate(df: DataFrame, min_rows: int = 40) -> bool:
    """Run decision: are there enough rows?  Reads at most ``min_rows`` of them."""
    return df.limit(min_rows).count() >= min_rows


def gated(df: DataFrame, min_rows: int = 40) -> DataFrame:
    """All rows if there are at least ``min_rows``, else none - as one lazy plan."""
    enough = df.agg((F.count(F.lit(1)) >= min_rows).alias("ok")).scalar()
    return df.filter(enough)


class HoldBack:
    """``foreachBatch`` target: land each micro-batch, process once enough rows are waiting.

    Layout below ``root``: ``landed/batch=<n>`` one folder a micro-batch, rewritten when the batch is
    replayed and dropped once taken, and ``taken`` a versioned table of one row, the last batch processed.  Batches come in
    order and a run takes all that wait, so that number tells which ones wait; it is a literal filter on
    the partition column, and what was taken is not read again.  An exception from ``process`` leaves
    both the stream's offsets and ``taken`` as they were, so the batch comes again; ``process`` gets a
    run name that is the same on a replay and should write by it.
    """

    def __init__(self, root: str, process: Callable[[DataFrame, str], None], min_rows: int = 40):
        self.root, self.process, self.min_rows = root, process, min_rows

    def _taken(self, spark: SparkSession) -> tuple[int, int]:
        """Last batch processed, and how often the stream was started anew."""
        taken = store.load(spark, f"{self.root}/taken")
        row = {} if taken is None else taken.first().asDict()
        return row.get("batch", -1), row.get("restarts", 0)

    def _mark(self, spark: SparkSession, batch: int, restarts: int) -> None:
        store.publish(spark.createDataFrame([(batch, restarts)], "batch long, restarts long"), f"{self.root}/taken")

    def last_taken(self, spark: SparkSession) -> int:
        return self._taken(spark)[0]

    def waiting(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        landed = spark.read.schema(
            T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        ).option("basePath", f"{self.root}/landed").parquet(f"{self.root}/landed")
        return landed.filter(F.col("batch") > self.last_taken(spark))

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        last, restarts = self._taken(spark)
        if batch_id <= last:
            return  # replay of a batch that was processed completely
        df.write.mode("overwrite").parquet(f"{self.root}/landed/batch={batch_id}")
        waiting = self.waiting(spark, df.schema)
        if not gate(waiting, self.min_rows):
            return
        self.process(waiting.drop("batch"), f"run-{restarts}-{batch_id}" if restarts else f"run-{batch_id}")
        self._mark(spark, batch_id, restarts)
        store.drop_numbered(spark, f"{self.root}/landed", "batch", batch_id)  # what this leaves, the next run drops

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Read everything available, then stop."""
        return (
            stream.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )

    def restart(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """Read everything again from the earliest message; nothing counts as taken or waiting.

        Run names differ from those of the former passes.  Cut short, it loses no message: calling it again completes it.
        """
        spark = stream.sparkSession
        self._mark(spark, -1, self._taken(spark)[1] + 1)
        store.drop_folder(spark, checkpoint)
        store.drop_folder(spark, f"{self.root}/landed")
        return self.start(stream, checkpoint)
