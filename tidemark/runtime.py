"""Session helpers: the shared scratch folder, runs, and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import tidemark

# task code travels with the job, so executors need no installed copy of this package
cloudpickle.register_pickle_by_value(tidemark)

# the folder of the run a thread is in; runs of other threads do not see it
_RUN = "tidemark.run"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor sees, as named by the cluster in ``spark.checkpoint.dir``.

    Only in local mode, where all tasks share one machine, a temporary folder stands in.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        master = spark.sparkContext.master
        if named is None and not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        current = spark.sparkContext.getCheckpointDir()
    return named or current


@contextmanager
def run(spark: SparkSession) -> Iterator[str]:
    """All scratch tables made inside belong to one folder, which goes at the end.

    Results that are still needed have to be written elsewhere before.
    """
    context = spark.sparkContext
    outer = context.getLocalProperty(_RUN)
    folder = scratch_path(spark, "run")
    context.setLocalProperty(_RUN, folder)
    try:
        yield folder
    finally:
        context.setLocalProperty(_RUN, outer)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the current run's folder, or of the shared one outside any run."""
    base = spark.sparkContext.getLocalProperty(_RUN) or shared_dir(spark).rstrip("/")
    return f"{base}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and go on from there.

    Ends the lineage, survives the loss of any executor, and - unlike ``checkpoint`` - computes the
    plan once.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """The written rows of ``make()``; the scratch tables it made on the way are gone."""
    path = scratch_path(spark, "cut")
    with run(spark):
        df = make()
        df.write.parquet(path)
        schema = df.schema
    return spark.read.schema(schema).parquet(path)


def utc(spark: SparkSession) -> SparkSession:
    """All instants in the engine are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out where a scan has fewer splits than there are cores; else change nothing.

    For work that is heavy per row.  Large inputs have splits enough and are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame, key: str, tasks: int | None = None) -> DataFrame:
    """Rows dealt by key to ``tasks`` tasks, as many as there are cores if none are named.

    For remote calls: their number at a time is the caller's to bound, and adaptive execution, which counts bytes,
    does not leave all of them to one task.
    """
    return df.repartition(tasks or df.sparkSession.sparkContext.defaultParallelism, key)
