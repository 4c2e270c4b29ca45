"""Queries on trends: serving, totals, matching, merging, storing."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.catalog.base import CHECKED, ITEMS, MEMBERS, NOW, SCORED, TRENDS, VECTORS, joined, query, stamp
from tidemark.functions import similarity as sim
from tidemark.operators import matching, normalize, quality, ranking, rollup, store
from tidemark.sources import fixtures as fx
from tidemark.runtime import cut, scratch_path

_BY_VIEWS = "total_views DESC, total_likes DESC, trend_id"


# ------------------------------------------------------------------ serving

@query("trend_listing", f"""WITH {TRENDS}, newest AS (SELECT * FROM trends ORDER BY ts DESC, trend_id LIMIT 100)
SELECT trend_id, topic, sentiment, video_count, total_views, total_likes FROM newest
WHERE sentiment IN ('positive','neutral') AND coalesce(risk_level,'safe') IN ('safe','cautious','high_risk')""")
def trend_listing(spark, sf):
    """Newest 100, then facets, then views: the serving query."""
    return ranking.listing(fx.trends(spark, sf), 100, ("positive", "neutral"),
                           ("safe", "cautious", "high_risk")).select(
        "trend_id", "topic", "sentiment", "video_count", "total_views", "total_likes")


@query("top_chart", f"""WITH {TRENDS} SELECT trend_id, total_views FROM trends ORDER BY {_BY_VIEWS} LIMIT 10""")
def top_chart(spark, sf):
    return ranking.top_chart(fx.trends(spark, sf), 10).select("trend_id", "total_views")


@query("admin_listing", f"""WITH {TRENDS}, newest AS (SELECT * FROM trends ORDER BY ts DESC, trend_id LIMIT 200),
 hit AS (SELECT * FROM newest WHERE contains(lower(topic),'en 1')
  OR len(list_filter(keywords, lambda k: contains(lower(k),'en 1'))) > 0)
SELECT row_number() OVER (ORDER BY {_BY_VIEWS}) AS row_no, trend_id, total_views FROM hit""")
def admin_listing(spark, sf):
    return ranking.admin_listing(fx.trends(spark, sf), "EN 1").select(
        F.col("row_no").cast("long").alias("row_no"), "trend_id", "total_views")


@query("facet_filter", f"""WITH {TRENDS} SELECT trend_id, sentiment, risk_level, content_type FROM trends
WHERE sentiment IN ('negative') AND risk_level IN ('safe','dangerous') AND content_type IN ('drama','commercial','entertainment')""")
def facet_filter(spark, sf):
    return quality.facet(fx.trends(spark, sf), ("negative",), ("safe", "dangerous"),
                         ("drama", "commercial", "entertainment")).select(
        "trend_id", "sentiment", "risk_level", "content_type")


@query("trend_search", f"""WITH {TRENDS} SELECT trend_id, topic FROM trends
WHERE contains(lower(topic),'src1') OR len(list_filter(keywords, lambda k: contains(lower(k),'src1'))) > 0""")
def trend_search(spark, sf):
    return quality.search(fx.trends(spark, sf), "SRC1").select("trend_id", "topic")


@query("trend_detail", f"""WITH {MEMBERS}, s AS (SELECT *, coalesce(likes,0)*1.0::DOUBLE + coalesce(comments,0)*2.0::DOUBLE
  + coalesce(shares,0)*3.0::DOUBLE + coalesce(collects,0)*4.0::DOUBLE AS score FROM members WHERE trend_id = 's-en-1'),
 r AS (SELECT *, row_number() OVER (ORDER BY score DESC, ingest_seq) AS rank FROM s)
SELECT trend_id, rank, content_id, md5(substring(text,1,150)) AS text_md5 FROM r WHERE rank <= 3""")
def trend_detail(spark, sf):
    one = ranking.detail(fx.trends(spark, sf), "s-en-1")
    return one.select("trend_id", F.posexplode("sample_videos").alias("i", "s")).select(
        "trend_id", (F.col("i") + 1).cast("long").alias("rank"), "s.content_id",
        F.md5("s.text").alias("text_md5"))


@query("facet_labels", f"""WITH {TRENDS} SELECT trend_id, CASE content_type WHEN 'entertainment' THEN 'Giải trí'
 WHEN 'drama' THEN 'Drama' WHEN 'dangerous' THEN 'Nguy hiểm' WHEN 'social_issue' THEN 'Vấn đề XH'
 WHEN 'commercial' THEN 'Thương mại' END AS type_label, CASE risk_level WHEN 'safe' THEN 'An toàn'
 WHEN 'cautious' THEN 'Cẩn trọng' WHEN 'high_risk' THEN 'Rủi ro cao' WHEN 'dangerous' THEN 'Nguy hiểm' END
 AS risk_label FROM trends""")
def facet_labels(spark, sf):
    return fx.trends(spark, sf).select(
        "trend_id",
        normalize.label(F.col("content_type"), normalize.TYPE_LABELS).alias("type_label"),
        normalize.label(F.col("risk_level"), normalize.RISK_LABELS).alias("risk_label"))


# ------------------------------------------------------------------ totals

@query("trend_totals", f"""WITH {TRENDS} SELECT count(*) AS total_trends,
 CAST(coalesce(sum(video_count),0) AS BIGINT) AS total_videos, CAST(coalesce(sum(total_views),0) AS BIGINT) AS total_views,
 CAST(coalesce(sum(total_likes),0) AS BIGINT) AS total_likes FROM trends""")
def trend_totals(spark, sf):
    return rollup.trend_totals(fx.trends(spark, sf))


@query("sentiment_counts", f"WITH {TRENDS} SELECT sentiment, count(*) AS n FROM trends GROUP BY sentiment")
def sentiment_counts(spark, sf):
    return rollup.count_by(fx.trends(spark, sf), "sentiment")


@query("event_type_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def event_type_counts(spark, sf):
    return rollup.count_by(fx.table(spark, sf, "events"), "event_type")


@query("batch_summary", f"""WITH {TRENDS}
SELECT 'sentiment' AS facet, sentiment AS value, count(*) AS n FROM trends GROUP BY 2
UNION ALL SELECT 'risk_level', risk_level, count(*) FROM trends GROUP BY 2
UNION ALL SELECT 'content_type', content_type, count(*) FROM trends GROUP BY 2
UNION ALL SELECT 'source', source, count(*) FROM members GROUP BY 2""")
def batch_summary(spark, sf):
    return rollup.batch_summary(fx.trends(spark, sf))


_RUNS_SQL = f"""{ITEMS}, lang_sizes AS (SELECT channel, language, count(*) AS size FROM items GROUP BY 1, 2),
 tones AS (SELECT channel, (['positive','negative','neutral'])[ingest_seq % 3 + 1] AS tone, count(*) AS n
  FROM items GROUP BY 1, 2), srcs AS (SELECT channel, source, count(*) AS n FROM items GROUP BY 1, 2)"""


@query("run_summary", f"""WITH {_RUNS_SQL}
SELECT 'total_batches' AS metric, '' AS value, CAST(count(DISTINCT channel) AS DOUBLE) AS n FROM items
UNION ALL SELECT 'total_items_processed', '', CAST(count(*) AS DOUBLE) FROM items
UNION ALL SELECT 'total_clusters_detected', '', CAST(count(*) AS DOUBLE) FROM lang_sizes
UNION ALL SELECT 'total_trends_saved', '', CAST(count(*) AS DOUBLE) FROM lang_sizes
UNION ALL SELECT 'avg_cluster_size', '', avg(size) FROM lang_sizes
UNION ALL SELECT 'sentiment', tone, CAST(sum(n) AS DOUBLE) FROM tones GROUP BY tone
UNION ALL SELECT 'risk_level', 'safe', CAST(count(DISTINCT channel) AS DOUBLE) FROM items
UNION ALL SELECT 'source_distribution', source, CAST(sum(n) AS DOUBLE) FROM srcs GROUP BY source""")
def run_summary(spark, sf):
    return rollup.summarize_runs(run_records(spark, sf))


def run_records(spark, sf):
    """One metrics record per channel, shaped like a batch's metrics file."""
    items = fx.content_items(spark, sf)

    def entries(df, name, value="n"):
        return df.groupBy("channel").agg(F.map_from_entries(F.sort_array(F.collect_list(
            F.struct(name, value)))).alias(name))

    langs = items.groupBy("channel", "language").agg(F.count(F.lit(1)).alias("size"))
    sizes = langs.groupBy("channel").agg(
        F.sort_array(F.collect_list("size")).alias("sizes"), F.count(F.lit(1)).alias("k"),
        F.sum("size").alias("total"))
    tone = F.element_at(F.array(*[F.lit(x) for x in ("positive", "negative", "neutral")]),
                        (F.col("ingest_seq") % 3 + 1).cast("int")).alias("sentiment")
    tones = items.groupBy("channel", tone).agg(F.count(F.lit(1)).alias("n"))
    srcs = items.groupBy("channel", "source").agg(F.count(F.lit(1)).alias("n"))
    stage = lambda **kw: F.struct(*[
        kw.get(f, F.lit(None)).cast(t).alias(f) for f, t in (
            ("input_count", "long"), ("cluster_count", "long"), ("cluster_sizes", "array<long>"),
            ("saved_count", "long"))])
    return (
        sizes.join(entries(tones, "sentiment"), "channel").join(entries(srcs, "source"), "channel")
        .select(
            F.col("channel").alias("timestamp"),
            F.create_map(
                F.lit("NormalizationStage"), stage(input_count=F.col("total")),
                F.lit("ClusteringStage"), stage(cluster_count=F.col("k"), cluster_sizes=F.col("sizes")),
                F.lit("StorageStage"), stage(saved_count=F.col("k"))).alias("stages"),
            F.struct(F.col("source").alias("source_distribution"), "sentiment",
                     F.create_map(F.lit("safe"), F.lit(1).cast("long")).alias("risk_level"),
                     F.create_map(F.lit("drama"), F.lit(1).cast("long")).alias("content_type")
                     ).alias("summary"))
    )


@query("run_metrics_files", f"""WITH {_RUNS_SQL}, t AS (SELECT channel, count(*) AS n FROM items GROUP BY channel)
SELECT t.channel AS batch, n AS items, (SELECT count(*) FROM lang_sizes l WHERE l.channel = t.channel) AS clusters FROM t""")
def run_metrics_files(spark, sf):
    """Metrics written as files, a broken file beside them, all readable ones loaded back."""
    from tidemark.runtime import scratch_path
    from tidemark.sources import snapshots

    root = scratch_path(spark, "metrics")
    run_records(spark, sf).write.json(f"{root}/batch_id=all")
    spark.range(1).select(F.lit("{not json").alias("value")).write.text(f"{root}/batch_id=bad")
    back = snapshots.read_run_metrics(spark, root, array_files=False)
    return back.select(
        F.col("timestamp").alias("batch"),
        F.col("stages")["NormalizationStage"]["input_count"].alias("items"),
        F.col("stages")["ClusteringStage"]["cluster_count"].alias("clusters"))


@query("run_metrics_objects", f"""WITH {_RUNS_SQL}, t AS (SELECT channel, count(*) AS n FROM items GROUP BY channel)
SELECT t.channel AS batch, n AS items, (SELECT count(*) FROM lang_sizes l WHERE l.channel = t.channel) AS clusters,
 row_number() OVER (ORDER BY channel) AS place FROM t""")
def run_metrics_objects(spark, sf):
    """One pretty-printed object a file, read in the order of the file names."""
    from tidemark.runtime import scratch_path
    from tidemark.sources import snapshots

    root = scratch_path(spark, "objects")
    runs = run_records(spark, sf).select(F.col("timestamp").alias("batch_id"), F.to_json(
        F.struct("*"), {"pretty": "true"}).alias("value"))
    runs.repartition("batch_id").write.partitionBy("batch_id").text(root)
    back = snapshots.read_run_metrics(spark, root)
    place = F.row_number().over(Window.orderBy("file")).cast("long")  # a row a run
    return back.select(
        F.col("timestamp").alias("batch"),
        F.col("stages")["NormalizationStage"]["input_count"].alias("items"),
        F.col("stages")["ClusteringStage"]["cluster_count"].alias("clusters"), place.alias("place"))


@query("run_metrics_written", f"""WITH {CHECKED}, kept AS (SELECT * FROM checked WHERE ok_clean AND reason IS NULL),
 l AS (SELECT source, language, count(*) AS size FROM kept GROUP BY 1, 2)
SELECT 'total_batches' AS metric, '' AS value, CAST(3 AS DOUBLE) AS n
UNION ALL SELECT 'total_items_processed', '', CAST(count(*) AS DOUBLE) FROM checked
UNION ALL SELECT 'total_clusters_detected', '', CAST(count(*) AS DOUBLE) FROM l
UNION ALL SELECT 'total_trends_saved', '', CAST(count(*) AS DOUBLE) FROM l
UNION ALL SELECT 'avg_cluster_size', '', round(avg(size), 6) FROM l
UNION ALL SELECT 'sentiment', (['positive','negative','neutral'])[size % 3 + 1], CAST(count(*) AS DOUBLE) FROM l GROUP BY 2
UNION ALL SELECT 'risk_level', 'safe', CAST(count(*) AS DOUBLE) FROM l
UNION ALL SELECT 'source_distribution', source, CAST(count(*) AS DOUBLE) FROM kept GROUP BY source""")
def run_metrics_written(spark, sf):
    """A batch a feed: its rows are written, its record comes from that write, and the records are summarised."""
    from tidemark.plans import detect
    from tidemark.sources import snapshots

    root = scratch_path(spark, "written")
    codes = F.ascii("language") * 256 + F.ascii(F.substring("language", 2, 1))
    for source in ("tiktok", "youtube", "vnexpress"):
        rows = fx.content_items(spark, sf).filter(F.col("source") == source).withColumn("cluster_id", codes)
        observed, counts = rollup.observed_stages(rows, detect.stages_passed(), detect.STAGES[:3])
        kept = cut(detect.prepare(cut(observed)))
        topics = kept.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size")).select(
            (F.col("size") % 2 == 0).alias("is_merged"),
            F.element_at(F.array(*[F.lit(x) for x in ("positive", "negative", "neutral")]),
                         (F.col("size") % 3 + 1).cast("int")).alias("sentiment"),
            F.lit("safe").alias("risk_level"), F.lit("drama").alias("content_type"))
        snapshots.write_run_metrics(rollup.run_record(counts(), kept, topics, NOW), root, source)
    back = snapshots.read_run_metrics(spark, root, array_files=False)
    return rollup.summarize_runs(back).withColumn("n", F.round("n", 6))


# ------------------------------------------------------------------ similarity and matching

@query("set_overlap", f"""WITH {TRENDS}, p AS (SELECT n.trend_id AS new_id, s.trend_id AS old_id,
  n.keywords AS a, s.keywords AS b, n.sources AS sa, s.sources AS sb
  FROM trends n JOIN trends s ON n.topic = s.topic AND n.side='n' AND s.side='s')
SELECT new_id, old_id, round(len(list_intersect(a,b))/len(list_distinct(a||b))::DOUBLE, 6) AS words,
 round(len(list_intersect(sa,sb))/len(list_distinct(sa||sb))::DOUBLE, 6) AS feeds FROM p""")
def set_overlap(spark, sf):
    pairs = _pairs(spark, sf)
    return pairs.select(
        F.col("n.trend_id").alias("new_id"), F.col("s.trend_id").alias("old_id"),
        F.round(sim.jaccard(F.col("n.keywords"), F.col("s.keywords")), 6).alias("words"),
        F.round(sim.jaccard(F.map_keys("n.source_counts"), F.map_keys("s.source_counts")), 6).alias("feeds"))


def _pairs(spark, sf, vectors=False):
    t = fx.trends(spark, sf, vectors)
    return t.filter("side = 'n'").alias("n").join(
        t.filter("side = 's'").alias("s"), F.col("n.topic") == F.col("s.topic"))


_SCORE = """0.6 * list_dot_product(n.vector, s.vector)
  / (sqrt(list_dot_product(n.vector, n.vector)) * sqrt(list_dot_product(s.vector, s.vector)))
 + 0.2 * len(list_intersect(n.keywords, s.keywords))/len(list_distinct(n.keywords||s.keywords))::DOUBLE
 + 0.1 * greatest(0.0, 1.0 - abs(epoch_us(n.ts) - epoch_us(s.ts)) / 3.6e9 / 24.0)
 + 0.1 * len(list_intersect(n.sources, s.sources))/len(list_distinct(n.sources||s.sources))::DOUBLE"""

_FULL = f"{VECTORS}, full_t AS (SELECT t.*, v.vector FROM trends t JOIN vectors v USING (trend_id))"


@query("topic_cosine", f"""WITH {_FULL} SELECT n.trend_id AS new_id, round(list_dot_product(n.vector, s.vector)
 / (sqrt(list_dot_product(n.vector, n.vector)) * sqrt(list_dot_product(s.vector, s.vector))), 6) AS cosine
FROM full_t n JOIN full_t s ON n.topic = s.topic AND n.side='n' AND s.side='s'""")
def topic_cosine(spark, sf):
    from tidemark.functions import vectors as vec

    return _pairs(spark, sf, True).select(
        F.col("n.trend_id").alias("new_id"),
        F.round(vec.cosine(F.col("n.vector"), F.col("s.vector")), 6).alias("cosine"))


@query("trend_pair_score", f"""WITH {_FULL} SELECT n.trend_id AS new_id, round({_SCORE}, 6) AS score
FROM full_t n JOIN full_t s ON n.topic = s.topic AND n.side='n' AND s.side='s'""")
def trend_pair_score(spark, sf):
    return _pairs(spark, sf, True).select(
        F.col("n.trend_id").alias("new_id"),
        F.round(matching.pair_score("n", "s"), 6).alias("score"))


_BEST = f"""{_FULL}, pairs AS (SELECT n.trend_id AS new_id, s.trend_id AS match_id, s.ts AS s_ts, {_SCORE} AS score
  FROM full_t n, full_t s WHERE n.side='n' AND s.side='s'),
 best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY new_id ORDER BY score DESC, s_ts, match_id) AS rn
  FROM pairs) WHERE rn = 1 AND score >= 0.5)"""


def _sides(spark, sf):
    t = fx.trends(spark, sf, True)
    new = matching.numbered(t.filter("side = 'n'"), "new_seq", [F.col("trend_id").asc()])
    old = matching.numbered(t.filter("side = 's'"), "store_seq",
                            [F.col("timestamp").asc(), F.col("trend_id").asc()])
    return new, old


@query("best_match", f"WITH {_BEST} SELECT new_id, match_id, round(score, 6) AS score FROM best")
def best_match(spark, sf):
    """Every new trend against every stored one; only the best match leaves a task."""
    new, old = _sides(spark, sf)
    found = matching.best_match(new, old)
    return found.join(new.select("new_seq", F.col("trend_id").alias("new_id")), "new_seq").join(
        old.select("store_seq", F.col("trend_id").alias("match_id")), "store_seq").select(
        "new_id", "match_id", F.round("score", 6).alias("score"))


_MERGED = f"""{_BEST}, m AS (SELECT n.*, b.match_id, row_number() OVER (PARTITION BY b.match_id ORDER BY n.trend_id DESC) AS latest
  FROM best b JOIN trends n ON n.trend_id = b.new_id),
 sums AS (SELECT match_id, sum(video_count) AS c, sum(total_views) AS v, sum(total_likes) AS l,
  flatten(list(keywords)) AS kw FROM m GROUP BY match_id),
 merged AS (SELECT s.trend_id, s.topic, x.summary, x.sentiment, x.content_type, x.risk_level,
  CAST(s.video_count + c AS BIGINT) AS video_count, CAST(s.total_views + v AS BIGINT) AS total_views,
  CAST(s.total_likes + l AS BIGINT) AS total_likes,
  array_to_string(list_sort(list_distinct(s.keywords || kw)), ',') AS keywords,
  array_to_string(list_sort(x.sources), ',') AS sources
  FROM sums JOIN trends s ON s.trend_id = sums.match_id JOIN m x ON x.match_id = sums.match_id AND x.latest = 1)"""

_MERGED_COLUMNS = ("trend_id", "topic", "summary", "sentiment", "content_type", "risk_level",
                   "video_count", "total_views", "total_likes")


@query("merge_trends", f"WITH {_MERGED} SELECT * FROM merged")
def merge_trends(spark, sf):
    """All matches of a stored trend folded into it."""
    new, old = _sides(spark, sf)
    links = matching.best_match(new, old).join(
        old.select("store_seq", F.col("trend_id").alias("match_id")), "store_seq")
    matched = new.join(links.select("new_seq", "match_id"), "new_seq").drop("trend_id", "vector")
    merged = matching.merge_trends(old.drop("vector", "store_seq"), matched, NOW)
    return merged.select(*_MERGED_COLUMNS, joined("keywords"),
                         F.array_join(F.sort_array(F.map_keys("source_counts")), ",").alias("sources"))


@query("merge_samples", f"""WITH {MEMBERS}, sc AS (SELECT *, coalesce(likes,0)*1.0::DOUBLE + coalesce(comments,0)*2.0::DOUBLE
   + coalesce(shares,0)*3.0::DOUBLE + coalesce(collects,0)*4.0::DOUBLE AS score,
   coalesce(likes,0)*1.0::DOUBLE + coalesce(comments,0)*2.0::DOUBLE AS small FROM members),
 r AS (SELECT *, row_number() OVER (PARTITION BY trend_id ORDER BY score DESC, ingest_seq) AS pos FROM sc),
 top5 AS (SELECT *, 'Topic ' || language || ' ' || CAST(g AS VARCHAR) AS topic FROM r WHERE pos <= 5),
 both_sides AS (SELECT topic FROM top5 GROUP BY topic HAVING count(DISTINCT side) = 2),
 o AS (SELECT t.topic, content_id, small, row_number() OVER (PARTITION BY t.topic
   ORDER BY small DESC, CASE WHEN side='s' THEN 0 ELSE 1 END, pos) AS rank FROM top5 t JOIN both_sides b USING (topic))
SELECT topic, string_agg(content_id, ',' ORDER BY rank) AS ids FROM o WHERE rank <= 10 GROUP BY topic""")
def merge_samples(spark, sf):
    pairs = _pairs(spark, sf).select(
        F.col("n.topic").alias("topic"), F.col("s.sample_videos").alias("old"),
        F.col("n.sample_videos").alias("new"))
    return ranking.merge_samples(pairs, "topic", "old", "new").select(
        "topic", F.array_join(F.transform("sample_videos", lambda s: s["content_id"]), ",").alias("ids"))


_DEDUP = f"""{_MERGED}
SELECT trend_id, true AS is_merged, sentiment, video_count, total_views, keywords FROM merged
UNION ALL SELECT trend_id, false, sentiment, video_count, total_views, array_to_string(keywords, ',')
FROM trends WHERE side='n' AND trend_id NOT IN (SELECT new_id FROM best)"""


@query("dedup_trends", f"WITH {_DEDUP}")
def dedup_trends(spark, sf):
    """The whole stage: recent trends, best match, merge or keep."""
    t = fx.trends(spark, sf, True)
    # the stored side counts as recent as a whole: the window reaches back over all of it
    from tidemark.config import MatchConfig

    out = matching.dedup(t.filter("side = 'n'").drop("side"), t.filter("side = 's'").drop("side"),
                         NOW, MatchConfig(window_hours=24 * 60))
    return out.select("trend_id", "is_merged", "sentiment", "video_count", "total_views",
                      joined("keywords"))


@query("merge_counts", f"""WITH {_MERGED} SELECT true AS is_merged, count(*) AS n FROM merged HAVING count(*) > 0
UNION ALL SELECT false, count(*) FROM trends WHERE side='n' AND trend_id NOT IN (SELECT new_id FROM best) HAVING count(*) > 0""")
def merge_counts(spark, sf):
    return rollup.count_by(dedup_trends(spark, sf), "is_merged")


@query("keyword_union", f"""WITH {TRENDS} SELECT n.topic, array_to_string(list_sort(list_distinct(n.keywords || s.keywords)), ',') AS keywords
FROM trends n JOIN trends s ON n.topic = s.topic AND n.side='n' AND s.side='s'""")
def keyword_union(spark, sf):
    return _pairs(spark, sf).select("n.topic", F.array_join(
        rollup.keyword_union(F.col("n.keywords"), F.col("s.keywords")), ",").alias("keywords"))


# ------------------------------------------------------------------ storing

@query("upsert_trends", f"""WITH {TRENDS}, inc AS (SELECT CASE WHEN g % 2 = 0 THEN 's-' || language || '-' || CAST(g AS VARCHAR)
  ELSE trend_id END AS trend_id, topic, total_views FROM trends WHERE side='n')
SELECT trend_id, topic, total_views FROM inc
UNION ALL SELECT trend_id, topic, total_views FROM trends WHERE side='s' AND trend_id NOT IN (SELECT trend_id FROM inc)""")
def upsert_trends(spark, sf):
    """Published as two versions of the stored table and read back."""
    from tidemark.runtime import scratch_path

    t = fx.trends(spark, sf)
    old = t.filter("side = 's'").select("trend_id", "topic", "total_views")
    g = F.element_at(F.split("trend_id", "-"), -1).cast("long")
    new = t.filter("side = 'n'").select(F.when(g % 2 == 0, F.regexp_replace(
        "trend_id", "^n", "s")).otherwise(F.col("trend_id")).alias("trend_id"), "topic", "total_views")
    root = scratch_path(spark, "trend-store")
    store.publish(old, root)
    store.publish(store.upsert_trends(store.load(spark, root), new), root)
    return store.load(spark, root)


@query("append_trends", f"""WITH {TRENDS} SELECT trend_id, topic FROM trends""")
def append_trends(spark, sf):
    """Published, appended to as the next version, and read back."""
    from tidemark.runtime import scratch_path

    t = fx.trends(spark, sf).select("trend_id", "topic", "side")
    root = scratch_path(spark, "appended")
    for side in ("s", "n"):
        store.append(t.filter(F.col("side") == side).drop("side"), root)
    return store.load(spark, root)


_CUT = "2024-01-25 00:00:00"


@query("store_by_day", f"""WITH {TRENDS}, inc AS (SELECT CASE WHEN g % 2 = 0 THEN 's-' || language || '-' || CAST(g AS VARCHAR)
  ELSE trend_id END AS trend_id, topic, total_views, ts FROM trends WHERE side='n'),
 alls AS (SELECT * FROM inc
  UNION ALL SELECT trend_id, topic, total_views, ts FROM trends WHERE side='s' AND trend_id NOT IN (SELECT trend_id FROM inc))
SELECT trend_id, topic, total_views, strftime(ts, '%Y-%m-%d') AS day FROM alls
WHERE ts >= TIMESTAMP '{_CUT}' - INTERVAL 3 DAY""")
def store_by_day(spark, sf):
    """Appended, upserted and expired in folders by day, and read back."""
    t = fx.trends(spark, sf)
    g = F.element_at(F.split("trend_id", "-"), -1).cast("long")
    columns = ["trend_id", "topic", "total_views", "last_updated"]
    new = t.filter("side = 'n'").withColumn("trend_id", F.when(
        g % 2 == 0, F.regexp_replace("trend_id", "^n", "s")).otherwise(F.col("trend_id")))
    root = scratch_path(spark, "days")
    store.append_days(t.filter("side = 's'").select(*columns), root)
    store.upsert_days(new.select(*columns), root)
    store.expire_days(spark, root, _CUT)
    empty = new.select(*columns, F.to_date("last_updated").alias("day")).schema
    return store.load_days(spark, root, empty).select("trend_id", "topic", "total_views", F.date_format("day", "yyyy-MM-dd").alias("day"))


@query("expire_trends", f"""WITH {TRENDS} SELECT trend_id, ts >= TIMESTAMP '{_CUT}' - INTERVAL 3 DAY AS kept FROM trends""")
def expire_trends(spark, sf):
    kept, gone = store.expire(fx.trends(spark, sf), _CUT)
    return kept.select("trend_id", F.lit(True).alias("kept")).unionByName(
        gone.select("trend_id", F.lit(False).alias("kept")))


@query("expire_null_times", f"""WITH {TRENDS}, t AS (SELECT trend_id, CASE WHEN g % 3 <> 0 THEN ts END AS ts FROM trends)
SELECT trend_id, coalesce(ts >= TIMESTAMP '{_CUT}' - INTERVAL 3 DAY, true) AS kept FROM t""")
def expire_null_times(spark, sf):
    """A third of the trends has no time of its last update: those stay."""
    t = fx.trends(spark, sf)
    g = F.element_at(F.split("trend_id", "-"), -1).cast("long")
    kept, gone = store.expire(t.withColumn("last_updated", F.when(g % 3 != 0, F.col("last_updated"))), _CUT)
    return kept.select("trend_id", F.lit(True).alias("kept")).unionByName(
        gone.select("trend_id", F.lit(False).alias("kept")))


@query("expire_events", f"""SELECT event_type, count(*) AS n FROM events
WHERE ts >= TIMESTAMP '{_CUT}' - INTERVAL 3 DAY GROUP BY event_type""")
def expire_events(spark, sf):
    events = fx.table(spark, sf, "events").withColumnRenamed("ts", "last_updated")
    return rollup.count_by(store.expire(events, _CUT)[0], "event_type")


@query("delete_trends", f"""WITH {TRENDS} SELECT trend_id, topic FROM trends WHERE sentiment <> 'negative'""")
def delete_trends(spark, sf):
    t = fx.trends(spark, sf)
    return store.delete_trend(t, t.filter("sentiment = 'negative'")).select("trend_id", "topic")


@query("newest_active_by_day", f"""WITH {TRENDS} SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM trends GROUP BY 1""")
def newest_active_by_day(spark, sf):
    """Trends per last-update day: the layout expiry prunes by."""
    return fx.trends(spark, sf).groupBy(
        F.date_format("last_updated", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))
