"""Queries on items: normalisation, filters, scalar functions, ranking, rollups."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.base import CHECKED, ITEMS, NOW, SCORED, WS, joined, query, stamp
from tidemark.functions import engagement as eng
from tidemark.functions import text as tx
from tidemark.functions import times, urls
from tidemark.operators import normalize, quality, ranking, rollup
from tidemark.plans import detect
from tidemark.sources import fixtures as fx


def _digest(col):
    """Whole texts compared by digest, so that results stay small."""
    return F.md5(col)


# ------------------------------------------------------------------ filters

@query("clean_items", f"""WITH {CHECKED}
SELECT content_id, source, md5(text) AS text_md5, 2 AS n_tags FROM checked WHERE ok_clean""")
def clean_items(spark, sf):
    return quality.clean(fx.content_items(spark, sf)).select(
        "content_id", "source", _digest(F.col("text")).alias("text_md5"),
        F.size("hashtags").alias("n_tags"))


@query("quality_short_video", f"""WITH {CHECKED}
SELECT content_id, views, author_followers FROM checked WHERE source='tiktok' AND reason IS NULL""")
def quality_short_video(spark, sf):
    return quality.quality_short(fx.content_items(spark, sf).filter("source = 'tiktok'")).select(
        "content_id", "views", "author_followers")


@query("quality_long_video", f"""WITH {CHECKED}
SELECT content_id, views, likes FROM checked WHERE source='youtube' AND reason IS NULL""")
def quality_long_video(spark, sf):
    return quality.quality_long(fx.content_items(spark, sf).filter("source = 'youtube'")).select(
        "content_id", "views", "likes")


@query("quality_by_source", f"""WITH {CHECKED}
SELECT source, coalesce(reason,'kept') AS outcome, count(*) AS n FROM checked GROUP BY 1, 2""")
def quality_by_source(spark, sf):
    return fx.content_items(spark, sf).select(
        "source", F.coalesce(quality.reject_reason(), F.lit("kept")).alias("outcome")
    ).groupBy("source", "outcome").agg(F.count(F.lit(1)).alias("n"))


@query("engagement_flags", f"""WITH {ITEMS}, r AS (
 SELECT *, CASE WHEN coalesce(views,0)=0 THEN 0.0 ELSE
   (coalesce(likes,0)+coalesce(comments,0)+coalesce(shares,0))/views::DOUBLE END AS rate FROM items)
SELECT content_id, round(rate,6) AS rate, rate >= 0.01 AS is_quality,
 CASE WHEN coalesce(views,0)=0 THEN false ELSE coalesce(shares,0)/views::DOUBLE >= 0.02 END AS is_viral
FROM r""")
def engagement_flags(spark, sf):
    rate = eng.engagement_rate(F.col("views"), F.col("likes"), F.col("comments"), F.col("shares"))
    return fx.content_items(spark, sf).select(
        "content_id", F.round(rate, 6).alias("rate"), eng.is_quality(rate).alias("is_quality"),
        eng.is_viral(F.col("shares"), F.col("views")).alias("is_viral"))


# the longest word of every benchmark text, so that few documents hold one
_KEYWORD_SQL = """words AS (
 SELECT DISTINCT lower(list_min([{'n': -length(x), 'x': x} for x in string_split(text, ' ')]).x) AS k FROM benchmark)"""


@query("keyword_match", f"""WITH {_KEYWORD_SQL}
SELECT doc_id, md5(text) AS text_md5 FROM documents d
WHERE EXISTS (SELECT 1 FROM words WHERE contains(lower(lang || ' ' || text), k))""")
def keyword_match(spark, sf):
    return _keyword_match(spark, sf, 4)


@query("keyword_match_long_list", f"""WITH {_KEYWORD_SQL}
SELECT doc_id, md5(text) AS text_md5 FROM documents d
WHERE EXISTS (SELECT 1 FROM words WHERE contains(lower(lang || ' ' || text), k))""")
def keyword_match_long_list(spark, sf):
    """Shorter substrings: more pairs meet and are compared in full."""
    return _keyword_match(spark, sf, 2)


def _keyword_match(spark, sf, gram):
    words = fx.table(spark, sf, "benchmark").select(F.array_min(F.transform(
        F.split("text", " "), lambda x: F.struct((-F.length(x)).alias("n"), x.alias("x"))))["x"].alias("keyword"))
    docs = fx.table(spark, sf, "documents", heavy=True).select(
        "doc_id", F.col("lang").alias("title"), F.col("text").alias("summary"))
    return quality.match_keywords(docs, words, gram=gram).select(
        "doc_id", _digest(F.col("summary")).alias("text_md5"))


@query("recent_window", f"""SELECT event_id, event_type FROM events
WHERE ts >= TIMESTAMP '{'2024-01-30 00:00:00'}' - INTERVAL 24 HOUR""")
def recent_window(spark, sf):
    return quality.recent(fx.table(spark, sf, "events"), "2024-01-30 00:00:00", 24, "ts").select(
        "event_id", "event_type")


@query("headline_feed", f"""WITH t AS (
 SELECT doc_id, trim(unnest(string_split(text, chr(10))), {WS}) AS title FROM documents)
SELECT doc_id, md5(title) AS title_md5 FROM t WHERE title <> ''""")
def headline_feed(spark, sf):
    return quality.headlines(_titles(spark, sf), "doc_id").select(
        "doc_id", _digest(F.col("title")).alias("title_md5"))


def _titles(spark, sf):
    """Every line of every text as a title."""
    return fx.table(spark, sf, "documents", heavy=True).select(
        "doc_id", F.explode(F.split("text", "\n")).alias("title"))


@query("batch_gate", """SELECT source, count(*) AS n FROM documents GROUP BY source
HAVING (SELECT count(*) FROM documents) >= 40""")
def batch_gate(spark, sf):
    from tidemark.streaming.intake import gated

    return rollup.count_by(gated(fx.table(spark, sf, "documents")), "source")


# ------------------------------------------------------------------ scalar functions

@query("engagement_score", f"WITH {SCORED} SELECT content_id, score FROM scored")
def engagement_score(spark, sf):
    return fx.content_items(spark, sf).select("content_id", eng.item_score().alias("score"))


def _category_sql() -> str:
    out = "CASE"
    for name, parts in urls.CATEGORY_RULES:
        test = " OR ".join(f"contains(u,'{p}')" for p in parts)
        out += f" WHEN {test} THEN '{name}'"
    return out + f" ELSE '{urls.CATEGORY_OTHER}' END"


# addresses from the pages table, carried into the feed vocabulary by page number
_FEED_URL_SQL = """'https://' || (['vnexpress.net','tuoitre.vn','vtcnews.vn','thanhnien.vn','example.org'])
 [page_id % 5 + 1] || '/rss/' || (['tin-moi-nhat','thoi-su','giai-tri','kinh-te','the-gioi','the-thao',
 'phap-luat','giao-duc','suc-khoe','doi-song','du-lich','khoa-hoc','so-hoa','Oto-Xe-May','gioi-tre',
 'van-hoa','dia-oc','can-biet','startup'])[page_id % 19 + 1] || '.rss?from=' || url"""


def feed_urls(spark, sf):
    hosts = ("vnexpress.net", "tuoitre.vn", "vtcnews.vn", "thanhnien.vn", "example.org")
    parts = ("tin-moi-nhat", "thoi-su", "giai-tri", "kinh-te", "the-gioi", "the-thao", "phap-luat",
             "giao-duc", "suc-khoe", "doi-song", "du-lich", "khoa-hoc", "so-hoa", "Oto-Xe-May",
             "gioi-tre", "van-hoa", "dia-oc", "can-biet", "startup")

    def pick(values):
        at = (F.col("page_id") % len(values)).cast("int") + 1
        return F.element_at(F.array(*[F.lit(v) for v in values]), at)

    return fx.table(spark, sf, "pages").withColumn("feed_url", F.concat(
        F.lit("https://"), pick(hosts), F.lit("/rss/"), pick(parts), F.lit(".rss?from="),
        F.col("url")))


@query("feed_category", f"""WITH f AS (SELECT page_id, lower({_FEED_URL_SQL}) AS u FROM pages)
SELECT page_id, {_category_sql()} AS category FROM f""")
def feed_category(spark, sf):
    return feed_urls(spark, sf).select("page_id", urls.category(F.col("feed_url")).alias("category"))


@query("feed_publisher", f"""WITH f AS (SELECT page_id, lower({_FEED_URL_SQL}) AS u FROM pages)
SELECT page_id, CASE WHEN contains(u,'vnexpress.net') THEN 'VNExpress'
 WHEN contains(u,'tuoitre.vn') THEN 'Tuổi Trẻ' WHEN contains(u,'vtcnews.vn') THEN 'VTC News'
 WHEN contains(u,'thanhnien.vn') THEN 'Thanh Niên' ELSE 'Unknown' END AS publisher FROM f""")
def feed_publisher(spark, sf):
    return feed_urls(spark, sf).select(
        "page_id", urls.publisher(F.col("feed_url")).alias("publisher"))


@query("iso_duration", """SELECT event_id,
 CASE WHEN event_id % 7 = 0 THEN 0
  ELSE (event_id % 3) * 86400 + (event_id % 24) * 3600 + (event_id % 60) * 60 + user_id % 60 END AS seconds
FROM events""")
def iso_duration(spark, sf):
    e = F.col("event_id")

    def part(value, unit):
        return F.concat(value.cast("string"), F.lit(unit))

    text = F.when(e % 7 == 0, F.concat(F.lit("broken "), e.cast("string"))).otherwise(F.concat(
        F.lit("P"), part(e % 3, "D"), F.lit("T"), part(e % 24, "H"), part(e % 60, "M"),
        part(F.col("user_id") % 60, "S")))
    return fx.table(spark, sf, "events").select(
        "event_id", times.duration_seconds(text).alias("seconds"))


@query("iso_time", f"""SELECT event_id, strftime(CASE WHEN event_id % 5 = 0 THEN TIMESTAMP '{NOW}'
 ELSE date_trunc('second', ts) END, '%Y-%m-%d %H:%M:%S') AS at FROM events""")
def iso_time(spark, sf):
    zulu = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    offset = F.concat(F.date_format(F.col("ts").cast("timestamp") + F.expr("INTERVAL 7 HOURS"),
                                    "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+07:00"))
    text = F.when(F.col("event_id") % 5 == 0, "not a time").when(
        F.col("event_id") % 2 == 0, zulu).otherwise(offset)
    return fx.table(spark, sf, "events").withColumn("at", times.parse_iso(text, NOW)).select(
        "event_id", stamp("at"))


@query("time_decay", f"""SELECT event_id, round(greatest(0.0,
 1.0 - abs(epoch_us(ts) - epoch_us(TIMESTAMP '{'2024-01-29 12:00:00'}')) / 3.6e9 / 24.0), 6) AS decay FROM events""")
def time_decay(spark, sf):
    at = F.lit("2024-01-29 12:00:00").cast("timestamp")
    return fx.table(spark, sf, "events").select("event_id", F.round(
        times.linear_decay(F.col("ts").cast("timestamp"), at), 6).alias("decay"))


@query("text_cut", """SELECT doc_id, md5(substring(text,1,150)) AS c150, md5(substring(text,1,300)) AS c300,
 md5(substring(text,1,500)) AS c500 FROM documents""")
def text_cut(spark, sf):
    t = F.col("text")
    return fx.table(spark, sf, "documents").select(
        "doc_id", *[F.md5(tx.cut(t, n)).alias(f"c{n}") for n in (150, 300, 500)])


@query("text_strip", f"""SELECT doc_id, md5(trim(chr(9)||chr(160)||text||chr(10)||' ', {WS})) AS text_md5,
 length(trim(text, {WS})) AS chars FROM documents""")
def text_strip(spark, sf):
    padded = F.concat(F.lit("\t\xa0"), F.col("text"), F.lit("\n "))
    return fx.table(spark, sf, "documents").select(
        "doc_id", F.md5(tx.strip(padded)).alias("text_md5"),
        F.length(tx.strip(F.col("text"))).cast("long").alias("chars"))


@query("daily_id", f"""SELECT content_id, 'q' || author_name || '_' || '20240131' AS daily_id
FROM (WITH {ITEMS} SELECT * FROM items)""")
def daily_id(spark, sf):
    return fx.content_items(spark, sf).select("content_id", times.daily_id(
        F.concat(F.lit("q"), F.col("author_name")), NOW).alias("daily_id"))


@query("text_scrub", r"""SELECT page_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
 regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'),
 '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), 'https?://[^\s]+', ' ', 'g'),
 '@[A-Za-z0-9_.]+', ' ', 'g'), '[\s\x0B]+', ' ', 'g'), """ + WS + """)) AS text_md5 FROM pages""")
def text_scrub(spark, sf):
    return fx.table(spark, sf, "pages", heavy=True).select(
        "page_id", F.md5(tx.scrub(F.col("html"))).alias("text_md5"))


# ------------------------------------------------------------------ projections

@query("sample_projection", f"""WITH {ITEMS} SELECT content_id, source, md5(substring(text,1,500)) AS text_md5,
 views, likes, comments, author_name FROM items""")
def sample_projection(spark, sf):
    return fx.content_items(spark, sf).select(normalize.sample().alias("s")).select(
        "s.content_id", "s.source", F.md5("s.text").alias("text_md5"), "s.views", "s.likes",
        "s.comments", "s.author_name")


@query("embedding_text", f"""WITH {ITEMS} SELECT content_id,
 md5(text || ' ' || language || ' ' || channel) AS text_md5 FROM items""")
def embedding_text(spark, sf):
    return fx.content_items(spark, sf).select(
        "content_id", F.md5(normalize.embedding_text()).alias("text_md5"))


@query("source_labels", f"""WITH {ITEMS} SELECT content_id, CASE source WHEN 'tiktok' THEN 'TikTok'
 WHEN 'vnexpress' THEN 'VNExpress' WHEN 'youtube' THEN 'YouTube' END AS label,
 CASE source WHEN 'tiktok' THEN 'TikTok' WHEN 'vnexpress' THEN 'Tin tức' WHEN 'youtube' THEN 'YouTube' END
 AS sample_label FROM items""")
def source_labels(spark, sf):
    s = F.col("source")
    return fx.content_items(spark, sf).select(
        "content_id", normalize.label(s, normalize.SOURCE_LABELS, F.upper(s)).alias("label"),
        normalize.label(s, normalize.SAMPLE_SOURCE_LABELS).alias("sample_label"))


# ------------------------------------------------------------------ ranking

@query("rank_items", f"""WITH {SCORED} SELECT content_id, cluster_id,
 row_number() OVER (PARTITION BY cluster_id ORDER BY score DESC, ingest_seq) AS rank FROM scored""")
def rank_items(spark, sf):
    slim = fx.content_items(spark, sf).drop("text", "hashtags")
    return ranking.rank_items(slim).select("content_id", "cluster_id", "rank")


@query("top_items", f"""WITH {SCORED} SELECT * FROM (SELECT cluster_id, content_id, score,
 row_number() OVER (PARTITION BY cluster_id ORDER BY score DESC, ingest_seq) AS rank FROM scored)
WHERE rank <= 10""")
def top_items(spark, sf):
    return ranking.top_k(fx.content_items(spark, sf), 10).select(
        "cluster_id", "content_id", eng.item_score().alias("score"),
        F.col("rank").cast("long").alias("rank"))


@query("top_samples", f"""WITH {SCORED}, r AS (SELECT *,
 row_number() OVER (PARTITION BY cluster_id ORDER BY score DESC, ingest_seq) AS rank FROM scored)
SELECT cluster_id, string_agg(content_id, ',' ORDER BY rank) AS ids,
 CAST(sum(length(substring(text,1,500))) AS BIGINT) AS chars FROM r WHERE rank <= 5 GROUP BY cluster_id""")
def top_samples(spark, sf):
    s = ranking.samples(fx.content_items(spark, sf), 5)
    return s.select(
        "cluster_id", F.array_join(F.transform("sample_videos", lambda x: x["content_id"]), ",").alias("ids"),
        F.aggregate("sample_videos", F.lit(0).cast("long"),
                    lambda a, x: a + F.length(x["text"])).alias("chars"))


@query("first_per_key", f"""WITH {ITEMS} SELECT * FROM (SELECT author_name, content_id,
 row_number() OVER (PARTITION BY author_name ORDER BY ingest_seq) AS rn FROM items) WHERE rn = 1""")
def first_per_key(spark, sf):
    return ranking.first_per_key(
        fx.content_items(spark, sf), "author_name", [F.col("ingest_seq")]).select(
        "author_name", "content_id", F.lit(1).cast("long").alias("rn"))


# ------------------------------------------------------------------ rollups

@query("trend_rollup", f"""WITH {ITEMS} SELECT cluster_id, count(*) AS video_count,
 CAST(sum(coalesce(views,0)) AS BIGINT) AS total_views, CAST(sum(coalesce(likes,0)) AS BIGINT) AS total_likes
FROM items GROUP BY cluster_id""")
def trend_rollup(spark, sf):
    return rollup.trend_rollup(fx.content_items(spark, sf))


@query("source_counts", f"""WITH {ITEMS} SELECT cluster_id, source, count(*) AS n
FROM items GROUP BY cluster_id, source""")
def source_counts(spark, sf):
    return rollup.source_counts(fx.content_items(spark, sf)).select(
        "cluster_id", F.explode("source_counts").alias("source", "n"))


@query("source_distribution", f"""WITH {ITEMS}, c AS (SELECT source, count(*) AS n FROM items GROUP BY source)
SELECT source, n, round(n * 100.0::DOUBLE / sum(n) OVER (), 1) AS pct FROM c""")
def source_distribution(spark, sf):
    return rollup.share(rollup.count_by(fx.content_items(spark, sf), "source"))


@query("stage_counts", f"""WITH {CHECKED}, r AS (SELECT CASE WHEN NOT ok_clean THEN 1
  WHEN reason IS NOT NULL THEN 2 ELSE 3 END AS r FROM checked),
 s AS (SELECT * FROM (VALUES (0,'NormalizationStage'),(1,'CleaningStage'),(2,'FilteringStage')) v(stage_no, stage))
SELECT stage, count(*) FILTER (WHERE r >= stage_no) AS input_count,
 count(*) FILTER (WHERE r > stage_no) AS output_count,
 count(*) FILTER (WHERE r >= stage_no) - count(*) FILTER (WHERE r > stage_no) AS dropped
FROM r, s GROUP BY stage""")
def stage_counts(spark, sf):
    return rollup.stage_counts(
        fx.content_items(spark, sf), detect.stages_passed(), detect.STAGES[:3]).drop("stage_no")


@query("cluster_stats", """WITH l AS (SELECT CASE WHEN label = 0 THEN -1 ELSE label END AS c FROM embeddings),
 s AS (SELECT c, count(*) AS n FROM l GROUP BY c)
SELECT count(*) FILTER (WHERE c <> -1) AS cluster_count, avg(n) FILTER (WHERE c <> -1) AS avg_size,
 min(n) FILTER (WHERE c <> -1) AS min_size, max(n) FILTER (WHERE c <> -1) AS max_size,
 CAST(coalesce(sum(n) FILTER (WHERE c = -1), 0) AS BIGINT) AS noise_count,
 round(coalesce(sum(n) FILTER (WHERE c = -1), 0) * 100.0::DOUBLE / sum(n), 1) AS noise_rate FROM s""")
def cluster_stats(spark, sf):
    return rollup.cluster_stats(_labelled(spark, sf))


def _labelled(spark, sf):
    """Given labels as first-pass clusters; label 0 plays the noise."""
    return fx.unit_vectors(spark, sf).withColumn("cluster_id", F.when(
        F.col("label") == 0, -1).otherwise(F.col("label")).cast("long"))


@query("cluster_sizes", """SELECT CAST(label AS BIGINT) AS cluster_id, count(*) AS size FROM embeddings
WHERE label <> 0 GROUP BY label""")
def cluster_sizes(spark, sf):
    return rollup.cluster_sizes(_labelled(spark, sf))


@query("small_cluster_filter", """WITH n AS (SELECT count(*) AS n FROM documents),
 s AS (SELECT doc_id % 7 * (doc_id % 11) AS c, count(*) AS size FROM documents GROUP BY 1)
SELECT d.doc_id, d.doc_id % 7 * (d.doc_id % 11) AS cluster_id FROM documents d
JOIN s ON s.c = d.doc_id % 7 * (d.doc_id % 11), n WHERE s.size >= greatest(15, n.n // 60)""")
def small_cluster_filter(spark, sf):
    from tidemark.operators import clustering

    d = F.col("doc_id")
    docs = fx.table(spark, sf, "documents").select(
        "doc_id", (d % 7 * (d % 11)).alias("cluster_id"))
    return clustering.filter_small(docs).select("doc_id", "cluster_id")


@query("label_attach", """SELECT d.doc_id, l.quality, l.toxic, d.lang FROM documents d JOIN labels l USING (doc_id)""")
def label_attach(spark, sf):
    from tidemark.operators.embed import attach

    docs = fx.table(spark, sf, "documents").select("doc_id", "lang")
    labels = fx.table(spark, sf, "labels")
    return attach(labels, docs, "doc_id").select("doc_id", "quality", "toxic", "lang")
