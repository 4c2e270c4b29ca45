"""Hand-made edge rows for the row-level rules."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import runtime, schemas
from tidemark.config import MatchConfig
from tidemark.functions import engagement as eng
from tidemark.functions import repair, similarity as sim, text as tx, times, urls
from tidemark.operators import annotate, normalize, quality, ranking, rollup, store
from tidemark.sources import feeds, snapshots, topics
from tidemark.sources import fixtures as fx

NOW = "2024-01-31 00:00:00"
ITEM = ("content_id string, source string, text string, hashtags array<string>, views long, likes long,"
        " comments long, shares long, collects long, author_followers long, ingest_seq long")


def items(spark, **overrides):
    base = dict(content_id="1", source="tiktok", text="long enough text", hashtags=["a"], views=1000,
                likes=100, comments=10, shares=5, collects=5, author_followers=1000, ingest_seq=1)
    rows = overrides.pop("rows", [{}])
    return spark.createDataFrame([tuple({**base, **overrides, **r}.values()) for r in rows], ITEM)


def col(df, name="content_id"):
    return sorted(r[name] for r in df.collect())


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_clean_counts_stripped_characters(spark):
    df = items(spark, rows=[
        {"content_id": "9", "text": "\t\n 123456789 \xa0"}, {"content_id": "10", "text": "\t1234567890 "},
        {"content_id": None}, {"content_id": "", "text": "long enough text"}, {"content_id": "n", "text": None},
        {"content_id": "s", "source": ""}, {"content_id": "h", "hashtags": None}])
    out = quality.clean(df)
    assert col(out) == ["10", "h"]
    assert out.filter("content_id = 'h'").first()["hashtags"] == []


@pytest.mark.parametrize("field,val,reason", [
    ("views", 499, "views"), ("views", 500, None), ("views", 0, None), ("views", None, None),
    ("author_followers", 99, "followers"), ("author_followers", 100, None),
    ("author_followers", 0, None), ("collects", 0, "saves"), ("collects", None, "saves"),
])
def test_short_video_quality(spark, field, val, reason):
    out = items(spark, **{field: val}).select(quality.reject_reason().alias("r")).first()["r"]
    assert out == reason


def test_quality_rates_and_sources(spark):
    df = items(spark, rows=[
        {"content_id": "e", "likes": 0, "comments": 0, "shares": 0, "views": 100000},
        {"content_id": "y", "source": "youtube", "shares": None, "collects": None, "author_followers": None},
        {"content_id": "z", "source": "youtube", "likes": 0, "comments": 0},
        {"content_id": "v", "source": "vnexpress", "views": None},
        {"content_id": "o", "source": "other", "views": 1}])
    assert col(quality.quality_filter(df)) == ["o", "v", "y"]


def test_engagement(spark):
    df = items(spark, rows=[{"views": 0}, {"views": 1000, "shares": 20}])
    rate = eng.engagement_rate(F.col("views"), F.col("likes"), F.col("comments"), F.col("shares"))
    got = df.select(rate.alias("r"), eng.is_viral(F.col("shares"), F.col("views")).alias("v"),
                    eng.item_score().alias("s")).collect()
    assert [(r["r"], r["v"]) for r in got] == [(0.0, False), (0.13, True)]
    assert got[0]["s"] == 100 + 20 + 15 + 20


def test_null_title_is_no_word(spark):
    df = spark.createDataFrame([("1", None, "summary")], "article_id string, title string, summary string")
    for name in ("url", "category", "published_at", "thumbnail", "author"):
        df = df.withColumn(name, F.lit(None).cast("string"))
    row = normalize.from_article(df, NOW).first()
    assert row["text"] == ". summary" and row["author_name"] == "VNExpress" and row["views"] is None


def test_defaults_only_for_absent_keys(spark):
    got = value(spark, normalize.apply_defaults(F.lit('{"title":null,"url":"u"}'), "vnexpress"))
    assert got["title"] is None and got["url"] == "u" and got["summary"] == "" and got["author"] == "VNExpress"
    assert got["thumbnail"] is None


def test_shape_and_routing(spark):
    df = spark.createDataFrame([
        ('{"video_id":1,"author_fans":null}', "tiktok"), ('{"article_id":1,"channel_id":2}', "vnexpress"),
        ('{"video_id":1,"channel_id":2}', "youtube"), ('{"video_id":1}', None), ("nonsense", None)], "p string, k string")
    assert all(r["g"] == r["k"] for r in df.select("k", normalize.detect_source(F.col("p")).alias("g")).collect())
    with pytest.raises(Exception, match="Unknown source: news"):
        value(spark, normalize.route(F.lit("news")))


@pytest.mark.parametrize("text,seconds", [
    ("PT15M33S", 933), ("P1DT2H", 93600), ("PT0S", 0), ("P1W", 604800), ("PT1.5S", 1), ("P", 0), ("PT", 0),
    ("live", 0), ("", 0)])
def test_duration(spark, text, seconds):
    assert value(spark, times.duration_seconds(F.lit(text))) == seconds


def test_times(spark):
    zulu = value(spark, times.parse_iso(F.lit("2024-01-01T07:00:00Z"), NOW))
    offset = value(spark, times.parse_iso(F.lit("2024-01-01T14:00:00+07:00"), NOW))
    assert zulu == offset
    assert value(spark, times.parse_iso(F.lit("yesterday"), NOW)) == value(spark, times.clock(NOW))
    decay = lambda h: value(spark, times.linear_decay(
        times.clock(NOW), times.clock(NOW) + F.make_dt_interval(hours=F.lit(h))))
    assert [decay(h) for h in (0, 12, 24, 30)] == [1.0, 0.5, 0.0, 0.0]
    assert value(spark, times.linear_decay(times.clock(NOW), F.lit(None).cast("timestamp"))) == 0.5
    assert value(spark, sim.time_factor(times.clock(NOW), times.clock(NOW), MatchConfig(time_decay="constant"))) == 0.5
    assert value(spark, times.daily_id(F.lit("phở"), NOW)) == "phở_20240131"


@pytest.mark.parametrize("url,category", [
    ("https://vnexpress.net/rss/tin-xem-nhieu.rss", "Xe"),            # the fragment "xe" hits "xem"
    ("https://vtcnews.vn/rss/khoa-hoc-cong-nghe.rss", "Khoa học"),    # the earlier rule wins
    ("https://thanhnien.vn/rss/cong-nghe.rss", "Công nghệ"), ("https://THANHNIEN.vn/rss/HOME.rss", "Tin mới nhất"),
    ("https://vnexpress.net/rss/startup.rss", "Tổng hợp")])
def test_category(spark, url, category):
    assert value(spark, urls.category(F.lit(url))) == category


def test_article_ids(spark):
    get = lambda i, l: value(spark, urls.article_id(F.lit(i).cast("string"), F.lit(l)))
    assert get("x", "https://a/b.c.html") == "x"
    assert get("", "https://a/b.c.html") == "b" and get(None, "https://a/") == ""


def test_overlap_rules(spark):
    arr = lambda v: F.lit(v).cast("array<string>") if v is None else F.array(*[F.lit(x) for x in v]).cast("array<string>")
    got = [value(spark, sim.jaccard(arr(a), arr(b))) for a, b in (
        ([], []), (["a"], []), (None, ["a"]), (["a", "a", "b"], ["b", "c"]))]
    assert got[:3] == [1.0, 0.0, 0.0] and got[3] == pytest.approx(1 / 3)


@pytest.mark.parametrize("text,usable", [
    ('{"topic":"a"}', True), ('Sure:\n```json\n{"topic":"a"}\n```', True), ('```\n{"topic":"a"}\n```', True),
    ('{"topic":"a","keywords":["x"', True), ('{"topic":"a","keywords":["x', False),
    ('```json\nnothing\n```', False), ("sorry", False)])
def test_repair(spark, text, usable):
    fixed = value(spark, repair.repair_json(F.lit(text)))
    assert (fixed is not None) == usable
    if usable:
        got = value(spark, repair.read_annotation(F.lit(fixed)))
        assert got["topic"] == "a" and got["content_type"] == "entertainment" and got["risk_level"] == "safe"


def test_scrub(spark):
    got = value(spark, tx.scrub(F.lit("<p>Hi <b>all</b></p><script>x</script> see https://a.b/c by @me  now")))
    assert got == "Hi all see by now"


def test_recent_is_inclusive(spark):
    now = datetime(2024, 1, 31)
    df = spark.createDataFrame([(1, now - timedelta(hours=24)), (2, now - timedelta(hours=24, seconds=1))],
                               "id long, timestamp timestamp")
    assert col(quality.recent(df, NOW), "id") == [1]


def test_keyword_match(spark):
    df = spark.createDataFrame([
        (1, "Phở Anh Hai", "x"), (2, None, "see the ANH hai"), (3, "nothing", None), (4, "a" * 700 + "needle", ""),
        (None, "needle", None), (None, None, None)],
        "id long, title string, summary string")
    kw = spark.createDataFrame([("anh HAI",), ("needle",), ("ở",), (None,)], "keyword string")
    for gram in (1, 2, 4, 6):  # a row without an id is matched like any other
        got = quality.match_keywords(df, kw, gram=gram).collect()
        assert sorted(str(r["id"]) for r in got) == ["1", "2", "4", "None"]
    assert quality.match_keywords(df, kw.limit(0)).count() == 6
    assert quality.match_keywords(df, spark.createDataFrame([("",)], "keyword string")).count() == 6


def test_ranking_ties_keep_arrival_order(spark):
    df = items(spark, rows=[{"content_id": c, "ingest_seq": i} for i, c in enumerate("cab")]).withColumn("cluster_id", F.lit(1))
    assert [(r["content_id"], r["rank"]) for r in ranking.rank_items(df).orderBy("rank").collect()] == [("c", 1), ("a", 2), ("b", 3)]
    assert [r["content_id"] for r in ranking.top_k(df, 2).orderBy("rank").collect()] == ["c", "a"]


def test_rank_of_a_hot_cluster(spark):
    df = spark.range(5000).select(
        F.col("id").alias("ingest_seq"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7).alias("cluster_id"),
        (F.col("id") % 11).alias("likes"), *[F.lit(0).alias(c) for c in ("comments", "shares", "collects")])
    got = ranking.rank_items(df).select("ingest_seq", "cluster_id", "rank", "likes").collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["cluster_id"], -r["likes"], r["ingest_seq"])):
        by[r["cluster_id"]] = by.get(r["cluster_id"], 0) + 1
        assert r["rank"] == by[r["cluster_id"]]


def test_sample_merge(spark):
    s = lambda i, likes, comments=0: (i, "tiktok", f"t{i}", None, 1, likes, comments, "a")
    schema = schemas.SAMPLE.simpleString()
    df = spark.createDataFrame(
        [("k", [s("a", 1), s("b", 5)], [s("b", 99), s("c", 5), s("d", 1, 4)]), ("n", None, [s("x", 1)])],
        f"k string, old array<{schema}>, new array<{schema}>")
    got = {r["k"]: [x["content_id"] for x in r["sample_videos"]] for r in ranking.merge_samples(df, "k", "old", "new", 3).collect()}
    assert got["k"] == ["d", "b", "c"]  # the first occurrence of b counts, equal scores keep order
    assert got["n"] == ["x"]


def test_listing_limits_before_filtering(spark):
    rows = [(f"t{i}", datetime(2024, 1, i + 1), "positive" if i < 3 else "neutral", None, None, i, 0) for i in range(6)]
    df = spark.createDataFrame(rows, "trend_id string, timestamp timestamp, sentiment string, risk_level string,"
                                     " content_type string, total_views long, total_likes long")
    assert col(ranking.listing(df, 4, ("positive",)), "trend_id") == ["t2"]
    assert ranking.listing(df, 4, risks=("safe",), types=("entertainment",)).count() == 4


def test_wide_csv_row(spark):
    df = spark.createDataFrame([("1", "", "x", None, "true", "bad")], "id string, `hashtags/0/name` string,"
                               " `hashtags/27/name` string, playCount string, `authorMeta/verified` string, createTimeISO string")
    row = feeds.from_wide_csv(df, NOW).first()
    assert row["hashtags"] == ["x"] and row["views"] == 0 and row["author_verified"] is True
    assert row["timestamp"] == "2024-01-31T00:00:00" and row["text"] == "" and row["language"] is None


def test_append_unique(spark):
    old = spark.createDataFrame([("a", 1), ("a", 2)], "video_id string, ingest_seq long")
    new = spark.createDataFrame([("b", 3), ("b", 4), ("a", 5), ("", 6), (None, 7)], "video_id string, ingest_seq long")
    assert col(snapshots.append_unique(old, new), "ingest_seq") == [1, 2, 3, 6, 7]


def test_decode_keeps_offsets_of_unreadable_rows(spark):
    df = spark.createDataFrame([
        ("t", 0, 0, '{"source":"tiktok","data":{"video_id":"1"}}'), ("t", 0, 1, "broken"), ("t", 0, 2, '{"source":"tiktok"}')],
        "topic string, partition int, offset long, value string")
    good, bad = topics.decode(df, "tiktok")
    assert (good.count(), bad.count()) == (1, 2)
    assert topics.next_offsets(df).first()["next_offset"] == 3
    assert topics.offsets_json("t", {0: 3}) == '{"t": {"0": 3}}' and topics.offsets_json("t", None) == "earliest"


def test_missing_feed_is_skipped_other_failures_stop(spark):
    df = spark.range(3)

    def gone():
        return spark.read.parquet("/tmp/no-such-feed-folder")

    def broken():
        raise RuntimeError("boom")

    assert topics.read_feeds({"a": lambda: df, "b": gone}).count() == 3
    with pytest.raises(RuntimeError):
        topics.read_feeds({"a": lambda: df, "b": broken})


def test_recorded_batches(spark, tmp_path):
    """Numbers of two recorded runs."""
    one = ('{"timestamp":"a","stages":{"NormalizationStage":{"input_count":2024},"ClusteringStage":{"cluster_count":12,'
           '"cluster_sizes":[260,86,188,190,49,248,138,42,45,138,40,201]},"StorageStage":{"saved_count":12}},'
           '"summary":{"sentiment":{"positive":8,"neutral":3,"negative":1},"source_distribution":{"tiktok":212,"youtube":1411}}}')
    (tmp_path / "batch_1.json").write_text(one)
    (tmp_path / "batch_2.json").write_text("{broken")
    runs = snapshots.read_run_metrics(spark, str(tmp_path))
    got = {(r["metric"], r["value"]): r["n"] for r in rollup.summarize_runs(runs).collect()}
    assert got["total_batches", ""] == 1 and got["total_items_processed", ""] == 2024
    assert got["avg_cluster_size", ""] == pytest.approx(1625 / 12) and got["sentiment", "positive"] == 8
    assert got["total_trends_saved", ""] == 12 and got["source_distribution", "youtube"] == 1411


def test_empty_totals(spark):
    df = spark.createDataFrame([], "video_count long, total_views long, total_likes long")
    assert tuple(rollup.trend_totals(df).first()) == (0, 0, 0, 0)


def test_keyword_match_of_a_long_list(spark):
    """100,000 keywords, copies of a text, columns of any name, characters beyond the basic plane."""
    kw = spark.range(100_000).selectExpr("concat('word', id, '-') as keyword")
    rows = [(i, f"Title WORD{i * 37}", f"{'filler ' * 30} {'-' if i % 3 else ''} \U0001F600 end", "k", 1, i) for i in range(3000)]
    rows += [(9000 + i, "copy", "has word77- in it", "k", 1, i) for i in range(500)] + [(1, "wor", "d5-", "k", 1, 0)]
    df = spark.createDataFrame(rows, "id long, title string, summary string, k string, g int, _digest int").repartition(4)
    extra = spark.createDataFrame([("\U0001F600 end",)], "keyword string")
    got = quality.match_keywords(df, kw)
    assert got.columns == df.columns
    assert sorted(r["id"] for r in got.collect()) == [9000 + i for i in range(500)]
    both = quality.match_keywords(df, kw.unionByName(extra)).count()
    assert both == 3500
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_unknown_source_is_an_error(spark):
    df = spark.createDataFrame([('{"video_id":"a"}', "tiktok"), ('{"video_id":"b"}', "elsewhere")], "payload string, source string")
    good = df.filter("source = 'tiktok'").select(normalize.typed(F.col("payload"), F.col("source")).alias("r")).first()["r"]
    assert good["tiktok"]["video_id"] == "a" and good["tiktok"]["views"] == 0
    assert good["vnexpress"] is None and good["youtube"] is None and good["google_trends"] is None
    for bad in ("source = 'elsewhere'",):
        with pytest.raises(Exception, match="Unknown source: elsewhere"):
            df.filter(bad).select(normalize.typed(F.col("payload"), F.col("source")).alias("r")).collect()


def test_days_of_a_store(spark, tmp_path):
    """Only the days that lose or get a row are rewritten; expiry drops folders."""
    root = str(tmp_path / "days")
    rows = [(f"t{i}", datetime(2024, 1, 1 + i % 10, 6 + i % 12), i) for i in range(100)] + [("none", None, -1)]
    schema = "trend_id string, last_updated timestamp, n long"
    store.append_days(spark.createDataFrame(rows, schema).repartition(2), root)

    def files():
        return {p: p.stat().st_mtime_ns for p in (tmp_path / "days").rglob("*.parquet")}

    before = files()
    store.append_days(spark.createDataFrame([("late", datetime(2024, 1, 3), 5)], schema), root)
    after = files()
    assert set(before.items()) <= set(after.items()) and len(after) == len(before) + 1
    # t12 moves from day 3 to day 20, all of day 5 moves away, a new one comes to day 7
    moved = [("t12", datetime(2024, 1, 20), 1012)] + [(f"t{i}", datetime(2024, 1, 21), i) for i in range(4, 100, 10)] + [
        ("new", datetime(2024, 1, 7), 7)]
    days = store.upsert_days(spark.createDataFrame(moved, schema), root)
    assert [str(d) for d in days] == ["2024-01-03", "2024-01-05", "2024-01-07", "2024-01-20", "2024-01-21"]
    now = files()
    untouched = {p for p in after if not any(f"day={d}" in str(p) for d in days)}
    assert all(now.get(p) == after[p] for p in untouched) and not any("day=2024-01-05" in str(p) for p in now)
    want = {r[0]: r for r in rows} | {"late": ("late", datetime(2024, 1, 3), 5)} | {m[0]: m for m in moved}
    read = lambda: {r["trend_id"]: (r["trend_id"], r["last_updated"], r["n"]) for r in store.load_days(spark, root).collect()}
    assert read() == want
    gone = store.expire_days(spark, root, "2024-01-09 12:00:00")
    limit = datetime(2024, 1, 6, 12)
    assert read() == {k: v for k, v in want.items() if v[1] is None or v[1] >= limit}
    assert [str(d) for d in gone] == [f"2024-01-0{d}" for d in (1, 2, 3, 4, 6)]
    last = files()
    assert all(last.get(p) == now[p] for p in now if not any(f"day={d}" in str(p) for d in gone))
    plan = store.load_days(spark, root).filter(F.col("day") < F.lit("2024-01-03").cast("date"))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_learnt_words(spark):
    rows = [(i, f"fine sunny day w{i % 7}", "positive") for i in range(20)] + [
        (i, f"awful rainy day w{i % 7}", "negative") for i in range(20, 50)] + [(99, "awful", None), (98, None, "positive")]
    labelled = spark.createDataFrame(rows, "id long, text string, label string")
    words = annotate.learn_words(labelled, least=2.0)
    found = {(r["label"], r["term"]): r["weight"] for r in words.collect()}
    assert found["positive", "fine"] > 0 and found["negative", "awful"] > 0
    texts = spark.createDataFrame([(1, "A FINE day"), (2, "awful, awful"), (3, "nothing known"), (4, ""), (5, None)],
                                  "cluster_id long, text string")
    said = {r["cluster_id"]: r["label"] for r in annotate.judge(annotate.terms(texts), words).collect()}
    assert said[1] == "positive" and said[2] == "negative" and not {3, 4, 5} & set(said)
    tone = {r["cluster_id"]: r["sentiment"] for r in annotate.annotate_offline(texts, tone_words=words).collect()}
    assert tone == {1: "positive", 2: "negative", 3: "neutral", 4: "neutral", 5: "neutral"}
    assert annotate.learn_words(labelled.filter("label = 'positive'")).isEmpty()
    assert annotate.learn_words(labelled.limit(0)).isEmpty()


def test_learnt_words_on_held_out_texts(spark):
    """Learnt on two thirds of the labelled documents, judged on the rest: better than the most frequent label."""
    sf = "/root/testdata/sf0.1"
    docs = fx.table(spark, sf, "documents").join(fx.table(spark, sf, "labels"), "doc_id").withColumn(
        "label", F.when(F.col("toxic") == 1, "toxic").otherwise("calm"))
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    words = runtime.cut(annotate.learn_words(docs.filter(~held)))
    judged = annotate.judge(annotate.terms(docs.filter(held), "doc_id"), words, "doc_id").select("doc_id", F.col("label").alias("said"))
    said = F.coalesce("said", F.lit("calm"))
    row = docs.filter(held).join(judged, "doc_id", "left").agg(
        F.avg((F.col("label") == said).cast("int")).alias("right"), F.avg((F.col("label") == "calm").cast("int")).alias("calm"),
        F.avg(F.when(F.col("label") == "toxic", (said == "toxic").cast("int"))).alias("found")).first()
    print("accuracy", row)
    assert row["right"] > row["calm"] + 0.03 and row["found"] > 0.7
