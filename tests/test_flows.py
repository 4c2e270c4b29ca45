"""Keyword lifecycle, streaming intake, snapshots, pluggable functions, the whole batch."""

import os
import random
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import runtime, schemas
from tidemark.config import ClusterConfig, Settings
from tidemark.operators import annotate, embed, keywords as kw, rollup, store
from tidemark.plans import detect, discover
from tidemark.sources import fixtures as fx
from tidemark.sources import snapshots
from tidemark.streaming import intake

NOW = "2024-01-31 00:00:00"
SF = "/root/testdata/sf0.001"


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def submit_rows(spark, *rows):
    return spark.createDataFrame(rows, "seq long, id string, keyword string, reason string, submitted_by string")


def test_keyword_lifecycle(spark):
    subs, active = empty(spark, schemas.SUBMISSION), empty(spark, schemas.ACTIVE_KEYWORD)
    got = kw.submit(submit_rows(spark, (1, "a", " phở ", None, "Lan"), (2, "b", "phở", None, None),
                                (3, "c", "bún", " why ", "")), subs, active, NOW)
    rows = {r["id"]: r for r in got.collect()}
    assert set(rows) == {"a", "c"} and rows["c"]["submitted_by"] == "Anonymous" and rows["c"]["reason"] == "why"
    subs = subs.unionByName(got)
    assert kw.submit(submit_rows(spark, (4, "d", "phở", None, None)), subs, active, NOW).isEmpty()

    cmd = spark.createDataFrame([(1, "a", ["tiktok"], "admin")], "seq long, id string, sources array<string>, reviewed_by string")
    subs, active, history = kw.approve(cmd, subs, active, NOW)
    assert {r["id"]: r["status"] for r in subs.collect()} == {"a": "approved", "c": "pending"}
    assert [(r["keyword"], r["origin"]) for r in active.collect()] == [("phở", "user_submission")]
    assert [r["action"] for r in history.collect()] == ["approved"]
    assert kw.submit(submit_rows(spark, (5, "e", "phở", None, None)), subs, active, NOW).isEmpty()

    subs = kw.reject(spark.createDataFrame([(1, "c", "dull", "admin")], "seq long, id string, note string, reviewed_by string"), subs, NOW)
    assert subs.filter("id = 'c'").first()["notes"] == "dull"

    add = spark.createDataFrame([(1, "cơm ", ["news"], "admin"), (2, "phở", ["news"], "admin")],
                                "seq long, keyword string, sources array<string>, added_by string")
    active, history = kw.add(add, active, NOW)
    assert {r["keyword"] for r in active.collect()} == {"phở", "cơm"} and history.count() == 1

    ren = spark.createDataFrame([(1, "cơm", "phở", "x"), (2, "cơm", " cơm tấm ", "x"), (3, "none", "new", "x"), (4, "phở", "phở ", "x")],
                                "seq long, old_keyword string, new_keyword string, updated_by string")
    active, history = kw.rename(ren, active, NOW)
    assert {r["keyword"] for r in active.collect()} == {"phở", "cơm tấm"}
    assert [(r["keyword"], r["details"]["old_keyword"]) for r in history.collect()] == [("cơm tấm", "cơm")]

    rem = spark.createDataFrame([(1, "phở", "x"), (2, "none", "x")], "seq long, keyword string, removed_by string")
    active, history = kw.remove(rem, active, NOW)
    assert {r["keyword"] for r in active.collect()} == {"cơm tấm"} and history.count() == 1


def test_config_check(spark):
    cfg = spark.createDataFrame([("tiktok", "a"), ("news", " ")], "feed string, keyword string")
    assert {r["feed"]: r["ok"] for r in kw.check_config(cfg).collect()} == {"tiktok": True, "news": False, "youtube": False}


def test_gate(spark):
    assert not intake.gate(spark.range(39)) and intake.gate(spark.range(40))
    assert intake.gated(spark.range(39)).isEmpty() and intake.gated(spark.range(40)).count() == 40


def test_offsets_never_go_back(spark):
    cols = "topic string, partition int, offset long"
    manifest = spark.createDataFrame([("t", 0, 5), ("t", 1, 3)], "topic string, partition int, next_offset long")
    rows = spark.createDataFrame([("t", 0, 4), ("t", 0, 5), ("t", 1, 3), ("t", 2, 0)], cols)
    fresh = intake.unread(rows, manifest)
    assert sorted((r["partition"], r["offset"]) for r in fresh.collect()) == [(0, 5), (1, 3), (2, 0)]
    nxt = {r["partition"]: r["next_offset"] for r in intake.advance(manifest, rows.limit(1)).collect()}
    assert nxt == {0: 5, 1: 3}


def _files(spark, path, start, n):
    spark.range(start, start + n).coalesce(1).write.mode("append").json(path)


def test_hold_back_and_commit_after_success(spark, tmp_path):
    src, root, ckpt = (str(tmp_path / p) for p in ("in", "work", "ckpt"))
    seen, fail = [], {"on": True}

    def process(df, run):
        if fail["on"]:
            raise RuntimeError("downstream is away")
        seen.append((run, sorted(r["id"] for r in df.collect())))

    hold = intake.HoldBack(root, process, min_rows=40)

    def run():
        q = hold.start(intake.stream_files(spark, src, spark.range(1).schema), ckpt)
        q.awaitTermination()

    _files(spark, src, 0, 30)
    run()
    assert seen == []                      # 30 rows wait
    _files(spark, src, 30, 9)
    run()
    assert seen == []                      # 39 rows wait
    _files(spark, src, 39, 1)
    with pytest.raises(Exception):
        run()                              # 40 rows, but processing fails
    fail["on"] = False
    run()                                  # the same batch comes again
    assert [rows for _, rows in seen] == [list(range(40))]
    run()
    _files(spark, src, 40, 39)
    run()
    assert len(seen) == 1                  # nothing is processed twice
    assert hold.waiting(spark, spark.range(1).schema).count() == 39
    assert len(os.listdir(f"{root}/landed")) <= 2  # what was taken is gone: the waiting batch, maybe an empty one


def test_restart_reads_from_the_earliest(spark, tmp_path):
    src, root, ckpt = (str(tmp_path / p) for p in ("in", "work", "ckpt"))
    seen = []
    hold = intake.HoldBack(root, lambda df, run: seen.append((run, sorted(r["id"] for r in df.collect()))), min_rows=2)
    stream = lambda: intake.stream_files(spark, src, spark.range(1).schema)
    _files(spark, src, 0, 3)
    hold.start(stream(), ckpt).awaitTermination()
    _files(spark, src, 3, 1)                # waits
    hold.start(stream(), ckpt).awaitTermination()
    hold.restart(stream(), ckpt).awaitTermination()
    assert [rows for _, rows in seen] == [[0, 1, 2], [0, 1, 2, 3]]
    assert len({run for run, _ in seen}) == 2
    assert hold.waiting(spark, spark.range(1).schema).count() == 0


def test_runs_of_threads_do_not_meet(spark):
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    meet = Barrier(2)

    def work(n):
        with runtime.run(spark) as folder:
            meet.wait(60)
            inside = runtime.cut(spark.range(n))
            meet.wait(60)
            assert all(path.startswith(f"file:{folder}") or folder in path for path in inside.inputFiles())
            return inside.count()

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(work, (3, 5))) == [3, 5]


def test_settled_leaves_the_result_only(spark):
    made = []

    def make():
        made.append(runtime.cut(spark.range(7)))
        return made[0].filter("id > 2")

    kept = runtime.settled(spark, make)
    assert kept.count() == 4
    assert not any(os.path.exists(p.removeprefix("file:")) for p in made[0].inputFiles())


def test_observed_stages(spark):
    stages = ["a", "b", "c"]
    for rows in (spark.range(10), spark.range(0)):
        observed, counts = rollup.observed_stages(rows, (F.col("id") % 3 + 1).cast("int"), stages)
        written = runtime.cut(observed)
        got = [(r["stage"], r["input_count"], r["output_count"], r["dropped"]) for r in counts().collect()]
        many = written.count() > 0
        assert got == ([("a", 10, 10, 0), ("b", 10, 6, 4), ("c", 6, 3, 3)] if many else [(s, 0, 0, 0) for s in stages])


def test_snapshots(spark, tmp_path):
    root, at = str(tmp_path), datetime(2024, 1, 31)
    with pytest.raises(snapshots.EmptySnapshot):
        snapshots.write_snapshot(spark.range(0), root, "x", at)
    assert snapshots.try_write_snapshot(spark.range(0), root, "x", at) is None
    path = snapshots.write_snapshot(spark.range(3), root, "x", at)
    assert snapshots.read_snapshots(spark, path, spark.range(1).schema, array_files=False).count() == 3
    (tmp_path / "a.json").write_text('[{"id": 1},\n {"id": 2}]')
    assert snapshots.read_snapshots(spark, str(tmp_path / "a.json"), spark.range(1).schema).count() == 2


def test_embedding_function_sees_texts_once(spark):
    def fn(texts):
        assert len(texts) == len(set(texts)) and len(texts) <= 2
        return [[float(len(t))] for t in texts]

    df = spark.createDataFrame([(i, "abc" if i % 3 else f"t{i}") for i in range(12)], "id long, embed_text string")
    out = embed.embed(df, fn=fn, batch=2)
    assert out.count() == 12 and out.filter("embedding[0] <> length(embed_text)").isEmpty()


def test_attach_needs_a_partner(spark):
    a, b = spark.range(3), spark.range(2).withColumn("x", F.lit(1))
    assert embed.attach(b.drop("x"), a.withColumn("y", F.lit(1)), "id").count() == 2
    with pytest.raises(Exception, match="no partner for 2"):
        embed.attach(a, b, "id").collect()


def test_rejected_annotations(spark):
    req = spark.createDataFrame([(1, "ok"), (2, "fail"), (3, "partial")], "cluster_id long, request string")

    def fn(request):
        if request == "fail":
            raise RuntimeError
        return '{"topic":"t"}' if request == "partial" else '{"topic":"t","summary":"s","sentiment":"neutral","keywords":[]}'

    good, bad = annotate.annotate(req, fn)
    assert [r["cluster_id"] for r in good.collect()] == [1] and sorted(r["cluster_id"] for r in bad.collect()) == [2, 3]


def test_calls_are_dealt_by_key_and_made_once(spark, tmp_path):
    req = spark.range(200).select(F.col("id").alias("cluster_id"), F.lit("q").alias("request")).coalesce(1)

    def fn(request):
        from pyspark import TaskContext

        (tmp_path / f"{TaskContext.get().partitionId()}-{uuid.uuid4().hex}").touch()
        return '{"topic":"t","summary":"s","sentiment":"neutral","keywords":[]}'

    good, bad = annotate.annotate(req, fn, calls=5)
    assert good.count() == 200 and bad.count() == 0
    made = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert len(made) == 200 and len(set(made)) == 5 and max(map(made.count, made)) < 100


@pytest.mark.parametrize("n", [1, 2, 5, 30, 1000])
def test_top_phrases_against_all_phrases(spark, n):
    rng = random.Random(n)
    rows = [[rng.choice("aabbcde") for _ in range(rng.randrange(9))] for _ in range(60)]
    rows += [None, [], ["war"], ["a", "war", "b", "a"] * 3, ["x", "y", "z"], ["x", "y", "z"]]
    hits = {}
    for row in rows:
        found = {tuple(row[i:i + k]) for k in range(2, 6) for i in range(len(row) - k + 1)} if row else ()
        for phrase in found:
            if "war" not in phrase:
                hits[phrase] = hits.get(phrase, 0) + 1
    want = sorted(hits.items(), key=lambda x: (-x[1], -len(x[0]), " ".join(x[0])))[:n]
    got = annotate.top_phrases(spark.createDataFrame([(r,) for r in rows], "words array<string>"), n)
    assert sorted(map(tuple, got.collect())) == sorted((" ".join(k), v) for k, v in want)
    assert annotate.top_phrases(got.select(F.split("keyword", " ").alias("words")).limit(0), n).isEmpty()


def test_failed_vectors_are_data(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "t string").coalesce(1)

    def fn(texts):
        if "b" in texts:
            raise ValueError("no")
        return [[1.0] for _ in texts]

    got = {r.t: r.embedding for r in embed.embed(df, "t", fn, batch=1, keep_failed=True).collect()}
    assert got == {"a": [1.0], "b": None, "c": [1.0]}
    with pytest.raises(Exception, match="no"):
        embed.embed(df, "t", fn, batch=1).collect()


def test_discovery_with_function(spark):
    entries = spark.createDataFrame([(1, " one "), (2, ""), (3, "two")], "ingest_seq long, title string")
    old = empty(spark, schemas.EXTRACTED)
    fn = lambda request: '{"keywords":[{"keyword":"k","category":"c","reason":"%d"}]}' % request.count("- ")
    row = discover.discover(entries, old, NOW, fn=fn).first()
    assert (row["keyword"], row["reason"], row["num_headlines"], row["status"]) == ("k", "2", 2, "pending")
    fails = lambda request: "nonsense"
    pending = discover.discover(entries, old, NOW)
    assert discover.discover(entries, pending, NOW, fn=fails).count() == pending.count()


def test_batch_run_is_repeatable(spark):
    """The same batch on the same store gives the same trends; a second upsert changes nothing."""
    items = fx.content_items(spark, SF).drop("cluster_id", "channel")
    cfg = Settings(cluster=ClusterConfig(min_cluster_size=5, min_samples=5))
    none = empty(spark, schemas.TREND)
    first, second = (detect.detect(items, none, NOW, cfg) for _ in range(2))
    key = lambda df: sorted((r["trend_id"], r["topic"], r["video_count"]) for r in df.collect())
    assert key(first.trends) == key(second.trends)
    assert key(store.upsert_trends(first.stored, first.trends.drop("is_merged"))) == key(first.stored)
    assert first.expired.isEmpty()


def test_live_detection(spark, tmp_path):
    """A stream run equals a batch run; a replayed run changes nothing."""
    from tidemark.catalog.feeds import mixed_payloads
    from tidemark.operators.ordering import positions
    from tidemark.plans import live

    src = str(tmp_path / "in")
    payloads = mixed_payloads(spark, SF).select("payload")
    payloads.unionByName(payloads).coalesce(1).write.parquet(src)  # every message comes twice
    at = datetime(2024, 1, 31)
    cfg = Settings(cluster=ClusterConfig(min_cluster_size=5, min_samples=5))
    scratch = runtime.shared_dir(spark)
    before = set(os.listdir(scratch.removeprefix("file:")))
    run = live.DetectionRun(str(tmp_path / "trends"), lambda: at, cfg=cfg, records_root=str(tmp_path / "records"),
                            metrics_root=str(tmp_path / "metrics"), audit_root=str(tmp_path / "audit"))
    stream = intake.stream_files(spark, src, payloads.schema, "parquet")
    live.watch(stream, str(tmp_path / "work"), str(tmp_path / "ckpt"), run).awaitTermination()
    assert set(os.listdir(scratch.removeprefix("file:"))) == before  # nothing of the run is left
    record = snapshots.read_run_metrics(spark, str(tmp_path / "records"), array_files=False).first()
    assert record["stages"]["StorageStage"]["saved_count"] == run.trends(spark).count()
    arrived = positions(payloads.unionByName(payloads), [F.col("payload").asc()], "ingest_seq")
    items = live.first_arrivals(detect.from_payloads(arrived, "payload", at))
    assert items.count() == detect.from_payloads(arrived, "payload", at).dropDuplicates(["source", "content_id"]).count()
    batch = detect.detect(items, empty(spark, schemas.TREND), at, cfg)
    key = lambda df: sorted((r["trend_id"], r["topic"], r["video_count"]) for r in df.collect())
    assert key(run.trends(spark)) == key(batch.stored)
    assert not run.trends(spark).isEmpty()
    run(payloads, "run-0")
    assert store.versions(spark, run.trend_root) == [1]
    stages = {r["stage"] for r in spark.read.json(str(tmp_path / "metrics")).collect()}
    assert {"CleaningStage", "FilteringStage", "ClusteringStage"} <= stages
    assert spark.read.json(str(tmp_path / "audit")).count() == items.count()


def test_hopeless_batch_does_not_stop_the_stream(spark, tmp_path):
    """A batch of which cleaning leaves nothing ends without an error and is taken."""
    from tidemark.plans import live

    src = str(tmp_path / "in")
    spark.createDataFrame([("{}",), ("nonsense",), (None,)], "payload string").write.parquet(src)
    run = live.DetectionRun(str(tmp_path / "trends"), lambda: datetime(2024, 1, 31), cfg=Settings(min_batch=2))
    stream = intake.stream_files(spark, src, spark.read.parquet(src).schema, "parquet")
    live.watch(stream, str(tmp_path / "work"), str(tmp_path / "ckpt"), run).awaitTermination()
    assert run.trends(spark).isEmpty() and store.versions(spark, str(tmp_path / "work/taken")) == [1]
