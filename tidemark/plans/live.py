"""Trend detection over a stream: messages wait, a run detects, the next trend table is published."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.config import Settings
from tidemark.operators import rollup, store
from tidemark.operators.ordering import positions
from tidemark import runtime
from tidemark.plans import detect
from tidemark.sources import snapshots
from tidemark.streaming.intake import HoldBack


@dataclass
class DetectionRun:
    """Target of :class:`HoldBack`: payload rows in, a new version of the trend table out.

    Each version carries the name of the run that wrote it.  A run that was published but not yet
    marked as taken comes again under the same name and is then left alone, so no batch counts twice.
    """

    trend_root: str
    clock: Callable[[], datetime]
    payload: str = "payload"
    order: tuple[str, ...] = ("payload",)
    cfg: Settings = field(default_factory=Settings)
    embedder: Callable | None = None
    annotator: Callable[[str], str] | None = None
    metrics_root: str | None = None  # where each run leaves its metrics
    records_root: str | None = None  # where it leaves them as one record in the layout of the metrics files
    audit_root: str | None = None    # where each run leaves a copy of its items

    def trends(self, spark: SparkSession) -> DataFrame:
        table = store.load(spark, self.trend_root)
        return spark.createDataFrame([], schemas.TREND) if table is None else table.drop("run")

    def __call__(self, batch: DataFrame, run: str) -> None:
        spark = batch.sparkSession
        table = store.load(spark, self.trend_root)
        if table is not None and not table.filter(F.col("run") == run).isEmpty():
            return
        with runtime.run(spark):  # its scratch tables go at the end, also after a failure
            self._detect(batch, run)

    def _detect(self, batch: DataFrame, run: str) -> None:
        spark = batch.sparkSession
        arrived = positions(batch, [F.col(c).asc() for c in self.order], "ingest_seq")
        now = self.clock()
        # a message may be delivered again in a later batch of the same run: its first arrival counts
        items, counts = rollup.observed_stages(first_arrivals(detect.from_payloads(arrived, self.payload, now)),
                                               detect.stages_passed(self.cfg), detect.STAGES[:3])
        items = runtime.cut(items)
        if self.audit_root is not None:
            snapshots.try_write_snapshot(items, self.audit_root, run, now)
        found = detect.detect(items, self.trends(spark), now, self.cfg, self.embedder, self.annotator)
        if self.metrics_root is not None:
            snapshots.write_run_metrics(detect.run_metrics(items, found, self.cfg, counts()), self.metrics_root, run)
        if self.records_root is not None:
            snapshots.write_run_metrics(rollup.run_record(counts(), found.items, found.trends, now), self.records_root, run)
        store.publish(found.stored.withColumn("run", F.lit(run)), self.trend_root)


def first_arrivals(items: DataFrame) -> DataFrame:
    """One row per source and content id, the one that came first; rows without an id all stay."""
    order = Window.partitionBy("source", "content_id").orderBy("ingest_seq")
    known = F.col("source").isNotNull() & F.col("content_id").isNotNull()
    first = items.filter(known).withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").drop("_rn")
    return first.unionByName(items.filter(~known))


def watch(stream: DataFrame, root: str, checkpoint: str, run: DetectionRun) -> StreamingQuery:
    """Process what is available: batches below the least size wait for the next call."""
    return HoldBack(root, run, run.cfg.min_batch).start(stream, checkpoint)
