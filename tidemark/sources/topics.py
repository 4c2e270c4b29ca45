"""Topic reads and writes, and the envelope around each payload."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import times

# Messages by which a feed that does not exist yet is told from any other failure.
MISSING_FEED = ("UnknownTopicOrPartitionException", "PATH_NOT_FOUND")


def offsets_json(topic: str, offsets: dict[int, int] | None) -> str:
    """Stored next offsets as a range start, or ``earliest`` when there are none."""
    if not offsets:
        return "earliest"
    return json.dumps({topic: {str(p): o for p, o in offsets.items()}})


def read_topic(spark: SparkSession, servers: str, topic: str,
               start: dict[int, int] | None = None, end: str = "latest") -> DataFrame:
    """Bounded read of one topic: key, value, partition, offset."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", offsets_json(topic, start)).option("endingOffsets", end)
        .load().select("key", "value", "topic", "partition", "offset")
    )


def stream_topic(spark: SparkSession, servers: str, topics: str,
                 max_offsets: int | None = None) -> DataFrame:
    """Streaming twin; use with ``trigger(availableNow=True)``.  The rate cap is optional."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("subscribe", topics)
        .option("startingOffsets", "earliest")
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select("key", "value", "topic", "partition", "offset")


def read_feeds(readers: dict[str, Callable[[], DataFrame]]) -> DataFrame | None:
    """Union of all feeds.  A feed that does not exist is skipped, any other failure stops."""
    frames = []
    for feed, reader in readers.items():
        try:
            df = reader()
            _ = df.schema
        except Exception as error:  # the two readers raise different classes for "missing"
            missing = any(mark in str(error) for mark in MISSING_FEED)
            if isinstance(error, AnalysisException):
                missing = missing or error.getCondition() in MISSING_FEED
            if not missing:
                raise
            continue
        frames.append(df.withColumn("feed", F.lit(feed)))
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def decode(df: DataFrame, source: str, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(decoded, rejected): decoded rows have a payload; rejected rows keep all input columns.

    Offsets are read from the *input*, so unreadable messages still advance them.
    """
    body = F.col(value).cast("string")
    parsed = df.withColumn("_m", F.from_json(body, schemas.envelope(schemas.PAYLOADS[source])))
    usable = F.coalesce(F.col("_m.data").isNotNull(), F.lit(False))
    good = parsed.filter(usable).select(
        *[c for c in df.columns if c not in (value, "source", "collected_at", "content_id", "data")],
        "_m.*")
    return good, df.filter(~F.coalesce(
        F.from_json(body, schemas.envelope(schemas.PAYLOADS[source]))["data"].isNotNull(),
        F.lit(False)))


def next_offsets(df: DataFrame) -> DataFrame:
    """Next offset to read per topic partition: greatest seen + 1."""
    return df.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def to_envelope(df: DataFrame, source: str, id_col: str | Column, now) -> DataFrame:
    """Key and JSON value of one message per row."""
    ident = F.col(id_col) if isinstance(id_col, str) else id_col
    data = F.struct(*[f.name for f in schemas.PAYLOADS[source].fields])
    stamp = F.date_format(times.clock(now), "yyyy-MM-dd'T'HH:mm:ss")
    message = F.struct(
        F.lit(source).alias("source"), stamp.alias("collected_at"),
        ident.alias("content_id"), data.alias("data"))
    return df.select(
        ident.alias("key"),
        F.to_json(message, {"ignoreNullFields": "false"}).alias("value"))


def write_topic(df: DataFrame, servers: str, topic: str) -> None:
    """All-replica acknowledgement, gzip, three retries."""
    (
        df.select("key", "value").write.format("kafka")
        .option("kafka.bootstrap.servers", servers).option("topic", topic)
        .option("kafka.acks", "all").option("kafka.compression.type", "gzip")
        .option("kafka.retries", "3").save()
    )
