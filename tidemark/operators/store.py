"""Trend table: versions on plain files, or folders by day; upsert, expiry, replace-by-status.

In the day layout a row lies in the folder of the day of its last update (rows without one in a folder of
their own).  An append adds files.  An upsert rewrites the days that lose or get a row, by Spark's dynamic partition
overwrite, and no others; expiry drops whole folders and rewrites the one that the limit cuts.  Each change is written
beside the store first, and repeating one that was cut short gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.runtime import cut


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def drop_numbered(spark: SparkSession, root: str, name: str, last: int) -> None:
    """Drop the folders ``name=<n>`` below ``root`` with n up to ``last``."""
    fs, pattern = _fs(spark, f"{root}/{name}=*")
    for status in fs.globStatus(pattern) or []:
        if int(status.getPath().getName().split("=")[1]) <= last:
            fs.delete(status.getPath(), True)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions, oldest first.  A folder counts once its success mark is there."""
    fs, base = _fs(spark, root)
    if not fs.exists(base):
        return []
    found = []
    for status in fs.listStatus(base):
        name = status.getPath().getName()
        done = status.getPath().suffix("/_SUCCESS")
        if name.startswith("v") and name[1:].isdigit() and fs.exists(done):
            found.append(int(name[1:]))
    return sorted(found)


def publish(df: DataFrame, root: str, partition_by: tuple[str, ...] = ()) -> int:
    """Write the next version; readers keep the former one until the success mark appears."""
    spark = df.sparkSession
    current = versions(spark, root)
    nxt = (current[-1] if current else 0) + 1
    # a half-written folder of a failed run has no success mark and is overwritten
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{root}/v{nxt}")
    return nxt


def load(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    current = versions(spark, root)
    if not current:
        return None
    return spark.read.parquet(f"{root}/v{version or current[-1]}")


def append_trends(store: DataFrame, new: DataFrame) -> DataFrame:
    return store.unionByName(new, allowMissingColumns=True)


def append(new: DataFrame, root: str) -> int:
    """Write the stored rows and the new ones as the next version."""
    old = load(new.sparkSession, root)
    return publish(new if old is None else append_trends(old, new), root)


def upsert_trends(store: DataFrame, incoming: DataFrame, key: str = "trend_id") -> DataFrame:
    """Incoming rows replace stored rows of the same id, the others are added."""
    kept = store.join(incoming.select(key), key, "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def is_expired(now, days: int = 3):
    return F.col("last_updated") < times.clock(now) - F.make_dt_interval(F.lit(days))


def expire(df: DataFrame, now, days: int = 3) -> tuple[DataFrame, DataFrame]:
    """(kept, expired) by last update; a row without one is kept.  Both filters reach the scan."""
    gone = is_expired(now, days)
    return df.filter(F.col("last_updated").isNull() | ~gone), df.filter(gone)


def replace_pending(store: DataFrame, new: DataFrame) -> DataFrame:
    """Pending rows are swapped for the new set, all others stay, those without a status too; an
    empty set changes nothing.

    The emptiness test is a scalar subquery of the same plan.
    """
    any_new = new.agg((F.count(F.lit(1)) > 0).alias("any")).scalar()
    kept = store.filter(~F.col("status").eqNullSafe("pending") | ~any_new)
    return kept.unionByName(new, allowMissingColumns=True)


def delete_trend(store: DataFrame, ids: DataFrame, key: str = "trend_id") -> DataFrame:
    return store.join(ids.select(key), key, "left_anti")


# --------------------------------------------------------------------------- folders by day

DAY = "day"


def _by_day(df: DataFrame) -> DataFrame:
    return df.withColumn(DAY, F.to_date("last_updated"))


def append_days(new: DataFrame, root: str) -> None:
    """Add the rows as further files of their days."""
    _by_day(new).write.mode("append").partitionBy(DAY).parquet(root)


def _has_days(spark: SparkSession, root: str) -> bool:
    fs, path = _fs(spark, f"{root}/{DAY}=*")
    return bool(fs.globStatus(path))


def load_days(spark: SparkSession, root: str, schema=None) -> DataFrame:
    """All rows with their ``day``; a filter on it reads only those folders.  ``schema`` is that of a store without rows."""
    if schema is not None and not _has_days(spark, root):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(root)


def _folder(root: str, day) -> str:
    return f"{root}/{DAY}={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"


def _drop_days(spark: SparkSession, root: str, days) -> None:
    for day in days:
        fs, path = _fs(spark, _folder(root, day))
        fs.delete(path, True)


def _rewrite(spark: SparkSession, rows: DataFrame, root: str, days: list) -> None:
    """Make ``rows`` all that the ``days`` hold."""
    held = cut(rows)  # read from the folders that are about to change
    held.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(root)
    left = {r[DAY] for r in held.select(DAY).distinct().collect()}
    _drop_days(spark, root, [d for d in days if d not in left])  # days that lost their last row


def _of_days(store: DataFrame, days: list) -> DataFrame:
    named = F.col(DAY).isin([d for d in days if d is not None])
    return store.filter(F.coalesce(named, F.lit(False)) | F.col(DAY).isNull() if None in days else named)


def upsert_days(incoming: DataFrame, root: str, key: str = "trend_id") -> list:
    """Incoming rows replace stored rows of the same id, the others are added; returns the days rewritten.

    The days, at most one a day of the store's span, are what the driver sees.
    """
    spark = incoming.sparkSession
    fresh = cut(_by_day(incoming))
    store = load_days(spark, root, fresh.schema)
    keys = fresh.select(key)
    touched = store.select(key, DAY).join(keys, key, "left_semi").select(DAY).unionByName(fresh.select(DAY))
    days = [r[DAY] for r in touched.distinct().collect()]
    kept = _of_days(store, days).join(keys, key, "left_anti")
    _rewrite(spark, kept.unionByName(fresh, allowMissingColumns=True), root, days)
    return sorted(days, key=str)


def expire_days(spark: SparkSession, root: str, now, days: int = 3) -> list:
    """Remove rows last updated more than ``days`` before ``now``; returns the days that were dropped or rewritten."""
    if not _has_days(spark, root):
        return []
    store = load_days(spark, root)
    # the filter reaches the partition column, so only folder names are listed for whole days
    limit = F.to_date(times.clock(now) - F.make_dt_interval(F.lit(days)))
    old = [r[DAY] for r in store.filter(F.col(DAY) < limit).select(DAY).distinct().collect()]
    edge = store.filter(F.col(DAY) == limit)
    cut_by = [r[DAY] for r in edge.filter(is_expired(now, days)).select(DAY).distinct().collect()]
    _drop_days(spark, root, old)
    if cut_by:
        _rewrite(spark, edge.filter(~is_expired(now, days)), root, cut_by)
    return sorted(old + cut_by)
