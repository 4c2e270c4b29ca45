"""Best match, merge and de-duplication of trends."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.config import MatchConfig
from tidemark.operators import matching, store

NOW = datetime(2024, 1, 31)
COLUMNS = ("trend_id string, timestamp timestamp, last_updated timestamp, topic string, summary string,"
           " sentiment string, keywords array<string>, video_count long, total_views long, total_likes long,"
           " sample_videos array<struct<content_id:string,source:string,text:string,url:string,views:long,"
           "likes:long,comments:long,author_name:string>>, source_counts map<string,long>,"
           " content_type string, risk_level string, guidelines string, vector array<double>")


def trend(ident, vector, words=("a",), hours=1, sources=(("tiktok", 2),), count=10, topic=None):
    at = NOW - timedelta(hours=hours)
    sample = [(f"{ident}-{i}", "tiktok", "t", None, 1, i, 0, "x") for i in range(3)]
    return (ident, at, at, topic or ident, f"about {ident}", "neutral", list(words), count, 100, 10, sample,
            dict(sources), "drama", "safe", None, [float(v) for v in vector])


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def brute_best(new, old, cfg=MatchConfig()):
    out = {}
    for n in new:
        best, where = 0.0, None
        for o in sorted(old, key=lambda o: (o[1], o[0])):
            a, b = np.array(n[15]), np.array(o[15])
            topic = a @ b / (np.linalg.norm(a) * np.linalg.norm(b))
            words = len(set(n[6]) & set(o[6])) / len(set(n[6]) | set(o[6])) if n[6] and o[6] else float(not n[6] and not o[6])
            time = max(0.0, 1 - abs((n[1] - o[1]).total_seconds()) / 3600 / 24)
            feeds = len(set(n[11]) & set(o[11])) / len(set(n[11]) | set(o[11]))
            score = .6 * topic + .2 * words + .1 * time + .1 * feeds
            if score > best:
                best, where = score, o[0]
        if best >= cfg.threshold:
            out[n[0]] = where
    return out


@pytest.mark.parametrize("rows_per_block", [2048, 8])
def test_best_match(spark, rows_per_block):
    rng = np.random.default_rng(1)
    make = lambda p, n: [trend(f"{p}{i}", rng.normal(0, 1, 5), tuple(rng.choice(list("abcd"), rng.integers(0, 3))),
                               float(rng.uniform(0, 30)), (((("tiktok", "youtube")[i % 2]), 1),)) for i in range(n)]
    new, old = make("n", 40), make("s", 60)
    left = matching.numbered(frame(spark, new), "new_seq", [F.col("trend_id").asc()])
    right = matching.numbered(frame(spark, old), "store_seq", [F.col("timestamp").asc(), F.col("trend_id").asc()])
    got = matching.best_match(left, right, MatchConfig(rows_per_block=rows_per_block))
    named = got.join(left.select("new_seq", F.col("trend_id").alias("n")), "new_seq").join(
        right.select("store_seq", F.col("trend_id").alias("s")), "store_seq")
    assert {r["n"]: r["s"] for r in named.collect()} == brute_best(new, old)


def test_first_stored_wins_ties(spark):
    old = [trend("s2", [1, 0], hours=1), trend("s1", [1, 0], hours=1), trend("s3", [1, 0], hours=1)]
    out = matching.dedup(frame(spark, [trend("n", [1, 0], hours=1)]), frame(spark, old), NOW)
    assert [(r["trend_id"], r["is_merged"]) for r in out.collect()] == [("s1", True)]


def test_two_new_on_one_stored_are_folded(spark):
    store_rows = frame(spark, [trend("s", [1, 0], ("old",), count=5, topic="kept")])
    new = frame(spark, [trend("n1", [1, 0], ("x",), count=1), trend("n2", [1, 0.01], ("y", "old"), count=2),
                        trend("far", [-1, 0], ("z",), count=7)])
    rows = {r["trend_id"]: r for r in matching.dedup(new, store_rows, NOW).collect()}
    assert set(rows) == {"s", "far"} and rows["far"]["is_merged"] is False
    s = rows["s"]
    assert (s["video_count"], s["total_views"], s["topic"], s["summary"]) == (8, 300, "kept", "about n2")
    assert s["keywords"] == ["old", "x", "y"] and s["timestamp"] == NOW and s["last_updated"] == NOW
    assert s["source_counts"] == {"tiktok": 2} and len(s["sample_videos"]) == 9
    last = {r["trend_id"]: r for r in matching.dedup(new, store_rows, NOW, fold="last").collect()}
    assert last["s"]["video_count"] == 7


def test_source_counts_can_be_summed(spark):
    old = frame(spark, [trend("s", [1, 0])])
    new = frame(spark, [trend("n", [1, 0], sources=(("tiktok", 1), ("youtube", 4)))])
    matched = new.drop("trend_id", "vector").withColumn("match_id", F.lit("s")).withColumn("new_seq", F.lit(1).cast("long"))
    out = matching.merge_trends(old.drop("vector"), matched, NOW, sources="sum").first()
    assert out["source_counts"] == {"tiktok": 3, "youtube": 4}


def test_window_and_empty_store(spark):
    new = frame(spark, [trend("n", [1, 0])])
    old = frame(spark, [trend("s", [1, 0], hours=24.01)])
    assert [r["is_merged"] for r in matching.dedup(new, old, NOW).collect()] == [False]
    edge = frame(spark, [trend("s", [1, 0], hours=24)])
    assert [r["is_merged"] for r in matching.dedup(new, edge, NOW).collect()] == [True]
    assert matching.dedup(new, old.limit(0), NOW).count() == 1


def test_failing_embedder_keeps_all_new(spark):
    def fail(texts):
        raise RuntimeError("down")

    new, old = frame(spark, [trend("n", [1, 0])]).drop("vector"), frame(spark, [trend("s", [1, 0])]).drop("vector")
    assert [r["is_merged"] for r in matching.dedup(new, old, NOW, fn=fail).collect()] == [False]
    merged = matching.dedup(new.withColumn("topic", F.lit("same words")), old.withColumn("topic", F.lit("same words")), NOW)
    assert [r["is_merged"] for r in merged.collect()] == [True]


def test_spark_failures_are_not_swallowed(spark):
    new, old = frame(spark, [trend("n", [1, 0])]).drop("vector"), frame(spark, [trend("s", [1, 0])]).drop("vector")
    broken = old.withColumn("topic", F.raise_error(F.lit("disk gone")))
    with pytest.raises(Exception, match="disk gone"):
        matching.dedup(new, broken, NOW, fn=lambda texts: [[1.0] for _ in texts]).collect()


def test_nothing_to_match(spark):
    none = frame(spark, []).withColumn("new_seq", F.lit(1).cast("long")).withColumn("store_seq", F.lit(1).cast("long"))
    some = frame(spark, [trend("s", [1, 0])]).withColumn("new_seq", F.lit(1).cast("long")).withColumn(
        "store_seq", F.lit(1).cast("long"))
    assert matching.best_match(none, some).isEmpty() and matching.best_match(some, none).isEmpty()


def test_rows_without_time_or_status_stay(spark):
    rows = spark.createDataFrame([("a", None), ("b", NOW), ("c", NOW - timedelta(days=4))], "trend_id string, last_updated timestamp")
    kept, gone = store.expire(rows, NOW)
    assert {r[0] for r in kept.collect()} == {"a", "b"} and {r[0] for r in gone.collect()} == {"c"}
    old = spark.createDataFrame([("x", None), ("y", "pending"), ("z", "approved")], "keyword string, status string")
    new = spark.createDataFrame([("n", "pending")], "keyword string, status string")
    assert {r[0] for r in store.replace_pending(old, new).collect()} == {"x", "z", "n"}
    assert store.replace_pending(old, new.limit(0)).count() == 3


def test_upsert_and_expiry(spark):
    old = frame(spark, [trend("a", [1, 0]), trend("b", [1, 0], hours=72), trend("c", [1, 0], hours=72.1)])
    inc = frame(spark, [trend("a", [1, 0], count=99), trend("d", [1, 0])])
    out = store.upsert_trends(old, inc)
    assert {r["trend_id"]: r["video_count"] for r in out.collect()} == {"a": 99, "b": 10, "c": 10, "d": 10}
    again = store.upsert_trends(out, inc)
    assert again.count() == 4
    kept, gone = store.expire(out, NOW)
    assert {r["trend_id"] for r in gone.collect()} == {"c"} and kept.count() == 3


def test_store_versions(spark, tmp_path):
    root = str(tmp_path / "t")
    assert store.load(spark, root) is None
    assert store.publish(spark.range(3), root) == 1
    (tmp_path / "t" / "v2").mkdir()  # a run that died while writing
    assert store.load(spark, root).count() == 3
    assert store.publish(spark.range(5), root) == 2
    assert (store.load(spark, root).count(), store.load(spark, root, 1).count()) == (5, 3)
