"""Keyword lifecycle.  Batches of command rows in, new table rows and history rows out.

A command is checked against the tables as they were before its batch.  Where two commands of one
batch compete for a keyword, the one with the smaller ``seq`` wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.functions import times

ALL_FEEDS = ("tiktok", "news", "youtube")


def _first(df: DataFrame, key: str) -> DataFrame:
    """First command per key: a limit per group, so repeats do not travel."""
    w = Window.partitionBy(key).orderBy("seq")
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def _trimmed(name: str) -> Column:
    return tx.strip(F.col(name))


def _history(df: DataFrame, action: str, by: str, now, details: Column | None = None,
             keyword: str = "keyword") -> DataFrame:
    empty = F.lit(None).cast("map<string,string>")
    return df.select(
        F.col(keyword).alias("keyword"), F.lit(action).alias("action"),
        F.col(by).alias("performed_by"), times.clock(now).alias("performed_at"),
        (empty if details is None else details).alias("details"))


def _origin_details(origin: str) -> Column:
    return F.create_map(F.lit("origin"), F.lit(origin), F.lit("sources"),
                        F.array_join("sources", ","))


def submit(commands: DataFrame, submissions: DataFrame, active: DataFrame, now) -> DataFrame:
    """New pending rows.  Refused: same keyword already pending, or already active.

    commands: seq, id, keyword, reason, submitted_by
    """
    asked = _first(commands.withColumn("keyword", _trimmed("keyword")), "keyword")
    pending = submissions.filter(F.col("status") == "pending").select("keyword").distinct()
    admitted = asked.join(pending, "keyword", "left_anti").join(
        active.select("keyword"), "keyword", "left_anti")
    who = F.nullif(F.col("submitted_by"), F.lit(""))
    return admitted.select(
        "id", "keyword", tx.strip(F.nullif(F.col("reason"), F.lit(""))).alias("reason"),
        F.coalesce(tx.strip(who), F.lit("Anonymous")).alias("submitted_by"),
        F.lit("pending").alias("status"), times.clock(now).alias("created_at"),
        F.lit(None).cast("timestamp").alias("reviewed_at"),
        F.lit(None).cast("string").alias("reviewed_by"), F.lit(None).cast("string").alias("notes"))


def _active_rows(df: DataFrame, by: str, origin: str, now) -> DataFrame:
    return df.select(
        "keyword", "sources", F.lit("active").alias("status"), times.clock(now).alias("added_at"),
        F.col(by).alias("added_by"), F.lit(origin).alias("origin"))


def approve(commands: DataFrame, submissions: DataFrame, active: DataFrame,
            now) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(submissions, active, history rows).  A keyword that is active already is not approved.

    commands: seq, id, sources, reviewed_by
    """
    asked = commands.join(submissions.select("id", "keyword"), "id")
    done = _first(asked.join(active.select("keyword"), "keyword", "left_anti"), "keyword")
    return (
        _review(submissions, done.select("id", F.col("reviewed_by").alias("_by")), "approved", now),
        active.unionByName(_active_rows(done, "reviewed_by", "user_submission", now)),
        _history(done, "approved", "reviewed_by", now, _origin_details("user_submission")),
    )


def _review(submissions: DataFrame, done: DataFrame, status: str, now,
            note: Column | None = None) -> DataFrame:
    joined = submissions.join(done, "id", "left")
    hit = F.col("_by").isNotNull()
    out = (
        joined.withColumn("status", F.when(hit, F.lit(status)).otherwise(F.col("status")))
        .withColumn("reviewed_at", F.when(hit, times.clock(now)).otherwise(F.col("reviewed_at")))
        .withColumn("reviewed_by", F.when(hit, F.col("_by")).otherwise(F.col("reviewed_by")))
    )
    if note is not None:
        out = out.withColumn("notes", F.when(hit, note).otherwise(F.col("notes")))
    return out.select(*submissions.columns)


def reject(commands: DataFrame, submissions: DataFrame, now) -> DataFrame:
    """Submissions with the named ids rejected.  No history row.

    commands: seq, id, note, reviewed_by
    """
    done = _first(commands, "id").select(
        "id", F.col("reviewed_by").alias("_by"), F.col("note").alias("_note"))
    return _review(submissions, done, "rejected", now, F.col("_note"))


def add(commands: DataFrame, active: DataFrame, now) -> tuple[DataFrame, DataFrame]:
    """(active, history rows).  Refused when the keyword is there in any status.

    commands: seq, keyword, sources, added_by
    """
    asked = _first(commands.withColumn("keyword", _trimmed("keyword")), "keyword")
    fresh = asked.join(active.select("keyword"), "keyword", "left_anti")
    return (
        active.unionByName(_active_rows(fresh, "added_by", "manual", now)),
        _history(fresh, "added", "added_by", now, _origin_details("manual")),
    )


def rename(commands: DataFrame, active: DataFrame, now) -> tuple[DataFrame, DataFrame]:
    """(active, history rows).  The old keyword must exist, the new one must be free.

    commands: seq, old_keyword, new_keyword, updated_by
    """
    names = active.select("keyword")
    asked = commands.withColumn("new_keyword", _trimmed("new_keyword")).filter(
        F.col("old_keyword") != F.col("new_keyword"))
    valid = (
        asked.join(names.withColumnRenamed("keyword", "old_keyword"), "old_keyword", "left_semi")
        .join(names.withColumnRenamed("keyword", "new_keyword"), "new_keyword", "left_anti")
    )
    done = _first(_first(valid, "old_keyword"), "new_keyword")
    renamed = active.join(
        done.select(F.col("old_keyword").alias("keyword"), F.col("new_keyword").alias("_to")),
        "keyword", "left")
    out = renamed.withColumn("keyword", F.coalesce("_to", "keyword")).select(*active.columns)
    details = F.create_map(F.lit("old_keyword"), F.col("old_keyword"),
                           F.lit("new_keyword"), F.col("new_keyword"))
    return out, _history(done, "updated", "updated_by", now, details, "new_keyword")


def remove(commands: DataFrame, active: DataFrame, now) -> tuple[DataFrame, DataFrame]:
    """(active, history rows).  commands: seq, keyword, removed_by"""
    done = _first(commands, "keyword").join(active.select("keyword"), "keyword", "left_semi")
    return (
        active.join(done.select("keyword"), "keyword", "left_anti"),
        _history(done, "removed", "removed_by", now),
    )


def approve_extracted(commands: DataFrame, extracted: DataFrame, active: DataFrame,
                      now) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(extracted, active, history rows): mark approved, then add for all feeds.

    commands: seq, id, approved_by
    """
    done = _first(commands, "id").join(extracted.select("id", "keyword"), "id")
    marked = _mark(extracted, done.select("id", F.col("approved_by").alias("_by"),
                                          F.lit(None).cast("string").alias("_why")), "approved", now)
    feeds = F.array(*[F.lit(f) for f in ALL_FEEDS])
    to_add = done.select("seq", "keyword", feeds.alias("sources"), F.concat(
        F.col("approved_by"), F.lit(" (extractor)")).alias("added_by"))
    return (marked, *add(to_add, active, now))


def reject_extracted(commands: DataFrame, extracted: DataFrame, now) -> DataFrame:
    """commands: seq, id, rejected_by, reason"""
    done = _first(commands, "id").select(
        "id", F.col("rejected_by").alias("_by"), F.col("reason").alias("_why"))
    return _mark(extracted, done, "rejected", now)


def _mark(extracted: DataFrame, done: DataFrame, status: str, now) -> DataFrame:
    hit = F.col("_by").isNotNull()
    return (
        extracted.join(done, "id", "left")
        .withColumn("status", F.when(hit, F.lit(status)).otherwise(F.col("status")))
        .withColumn("reviewed_at", F.when(hit, times.clock(now)).otherwise(F.col("reviewed_at")))
        .withColumn("reviewed_by", F.when(hit, F.col("_by")).otherwise(F.col("reviewed_by")))
        .withColumn("rejection_reason",
                    F.when(hit, F.col("_why")).otherwise(F.col("rejection_reason")))
        .select(*extracted.columns)
    )


def import_config(config: DataFrame, active: DataFrame, now) -> DataFrame:
    """Config rows (feed, keyword) merged in: feeds are added to a keyword's set, new ones inserted.

    A keyword's set holds at most one entry a feed, so the grouping stays small whatever repeats.
    """
    wanted = (
        config.select("keyword", "feed").distinct()
        .groupBy("keyword").agg(F.sort_array(F.collect_set("feed")).alias("_feeds"))
    )
    joined = active.join(wanted, "keyword", "full_outer")
    none = F.array().cast("array<string>")
    merged = F.array_union(F.coalesce("sources", none), F.coalesce("_feeds", none))
    return (
        joined.withColumn("sources", merged)
        .withColumn("status", F.coalesce("status", F.lit("active")))
        .withColumn("added_at", F.coalesce("added_at", times.clock(now)))
        .withColumn("added_by", F.coalesce("added_by", F.lit("migration")))
        .withColumn("origin", F.coalesce("origin", F.lit("manual")))
        .select(*active.columns)
    )


def check_config(config: DataFrame, feeds=ALL_FEEDS) -> DataFrame:
    """(feed, keywords, ok): every feed must have at least one non-empty keyword."""
    named = config.filter(~tx.blank(_trimmed("keyword"))).groupBy("feed").agg(
        F.count(F.lit(1)).alias("keywords"))
    wanted = config.sparkSession.createDataFrame([(f,) for f in feeds], "feed string")
    return wanted.join(named, "feed", "left").select(
        "feed", F.coalesce("keywords", F.lit(0)).alias("keywords"),
        (F.coalesce("keywords", F.lit(0)) > 0).alias("ok"))


def sorted_keywords(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == "active").orderBy("keyword")
