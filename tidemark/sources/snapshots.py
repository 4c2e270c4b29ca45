"""Raw snapshots, the per-source aggregate and run metrics files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas


class EmptySnapshot(ValueError):
    """A snapshot of nothing is a collection fault, not a result."""


def read_snapshots(spark: SparkSession, path: str, schema: T.StructType,
                   array_files: bool = True) -> DataFrame:
    """JSON array files as dumped by collectors, or our own line files; with the file of each row.

    Line files are split across tasks, an array file is one task's work.
    """
    return (
        spark.read.option("multiLine", array_files).schema(schema).json(path)
        .withColumn("_file", F.col("_metadata.file_name"))
    )


def write_snapshot(df: DataFrame, root: str, source: str, now: datetime) -> str:
    """One folder a source and batch.  Empty input is an error."""
    if df.isEmpty():
        raise EmptySnapshot(f"snapshot of {source} at {now} has no rows")
    target = f"{root}/source={source}/batch_ts={now:%Y-%m-%d_%H-%M-%S}"
    df.write.mode("errorifexists").option("ignoreNullFields", False).json(target)
    return target


def try_write_snapshot(df: DataFrame, root: str, source: str, now: datetime) -> str | None:
    """Audit copy: a failure must not stop the batch.  Returns the folder or None."""
    try:
        return write_snapshot(df, root, source, now)
    except Exception:
        return None


def record_id(df: DataFrame, id_cols=("video_id", "article_id", "query")) -> Column:
    """First non-empty id of the columns the frame has; null when there is none."""
    present = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in id_cols if c in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def fresh_rows(existing: DataFrame, new: DataFrame, order: str = "ingest_seq",
               id_cols=("video_id", "article_id", "query")) -> DataFrame:
    """New rows to add: first of each id in the batch, not stored yet; rows without id all stay.

    The first row per id is picked by a limit per group before the exchange, so an id repeated in
    a third of the batch sends one row a task.
    """
    tagged = new.withColumn("_id", record_id(new, id_cols))
    anonymous = tagged.filter(F.col("_id").isNull())
    w = Window.partitionBy("_id").orderBy(order)
    first = (
        tagged.filter(F.col("_id").isNotNull())
        .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    )
    known = existing.select(record_id(existing, id_cols).alias("_id")).filter(
        F.col("_id").isNotNull()).distinct()  # stored ids may repeat any number of times
    return first.join(known, "_id", "left_anti").unionByName(anonymous).drop("_id")


def append_unique(existing: DataFrame, new: DataFrame, order: str = "ingest_seq",
                  id_cols=("video_id", "article_id", "query")) -> DataFrame:
    """Stored rows as they are, then the fresh ones."""
    return existing.unionByName(
        fresh_rows(existing, new, order, id_cols), allowMissingColumns=True)


def write_run_metrics(df: DataFrame, root: str, batch_id: str) -> None:
    """One record a batch; writing the same batch again replaces it."""
    df.write.mode("overwrite").json(f"{root}/batch_id={batch_id}")


def read_run_metrics(spark: SparkSession, path: str, array_files: bool = True) -> DataFrame:
    """All readable metrics files, by name; a broken one becomes no row.  One record a run."""
    schema = T.StructType([*schemas.RUN_METRICS.fields, T.StructField("_bad", T.StringType())])
    return (
        spark.read.schema(schema).option("multiLine", array_files).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad").option("recursiveFileLookup", True).json(path)
        .withColumn("file", F.col("_metadata.file_path"))
        .filter(F.col("_bad").isNull() & F.col("stages").isNotNull()).drop("_bad").orderBy("file")
    )
