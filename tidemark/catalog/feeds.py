"""Queries on sources and sinks: decoding, raw dumps, envelopes, snapshots, aggregates."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.catalog.base import ITEMS, NOW, joined, query, stamp
from tidemark.catalog.items import _FEED_URL_SQL, _titles, feed_urls
from tidemark.functions import repair, times
from tidemark.operators import annotate, normalize, rollup
from tidemark.runtime import scratch_path
from tidemark.sources import feeds, snapshots, topics
from tidemark.sources import fixtures as fx

_SECONDS = "%Y-%m-%dT%H:%M:%S"


def _iso(col):
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")


def short_videos(spark, sf):
    """All documents as short-video payloads."""
    return fx.content_items(spark, sf, heavy=True).select(
        F.col("content_id").alias("video_id"), "text", "hashtags",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("views", "likes", "comments", "shares", "collects")],
        F.col("author_name").alias("author_username"),
        F.coalesce("author_followers", F.lit(0)).alias("author_fans"),
        (F.col("ingest_seq") % 2 == 0).alias("author_verified"),
        _iso(F.col("published_at")).alias("timestamp"), "language",
        F.concat(F.lit("https://video.example/"), "content_id").alias("video_url"),
        "ingest_seq", "source")


def articles(spark, sf):
    return fx.content_items(spark, sf, heavy=True).select(
        F.col("content_id").alias("article_id"),
        F.concat(F.lit("Title "), "content_id").alias("title"), F.col("text").alias("summary"),
        F.concat(F.lit("https://news.example/"), "content_id").alias("url"),
        F.lit("Thời sự").alias("category"), _iso(F.col("published_at")).alias("published_at"),
        F.lit(None).cast("string").alias("thumbnail"), F.lit("VNExpress").alias("author"),
        "ingest_seq", "source")


def long_videos(spark, sf):
    return fx.content_items(spark, sf, heavy=True).select(
        F.col("content_id").alias("video_id"),
        F.concat(F.lit("Title "), "content_id").alias("title"), F.col("text").alias("description"),
        F.concat(F.lit("https://long.example/"), "content_id").alias("url"),
        F.col("hashtags").alias("tags"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("views", "likes", "comments")],
        F.col("author_name").alias("channel_name"), F.concat(F.lit("ch"), "author_name").alias("channel_id"),
        _iso(F.col("published_at")).alias("published_at"),
        (F.col("ingest_seq") % 3600).alias("duration_seconds"),
        F.lit("").alias("thumbnail"), F.lit(None).cast("string").alias("category"),
        "ingest_seq", "source")


def _json(df, kind):
    names = [f.name for f in schemas.PAYLOADS[kind].fields]
    return df.withColumn("payload", F.to_json(F.struct(*names), {"ignoreNullFields": "false"}))


def mixed_payloads(spark, sf):
    """Every document in the payload shape of its source; every 50th in no known shape."""
    parts = [
        _json(short_videos(spark, sf), "tiktok").filter("source = 'tiktok'"),
        _json(articles(spark, sf), "vnexpress").filter("source = 'vnexpress'"),
        _json(long_videos(spark, sf), "youtube").filter("source = 'youtube'"),
    ]
    rows = [p.select("ingest_seq", "payload") for p in parts]
    known = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return known.withColumn("payload", F.when(
        F.col("ingest_seq") % 50 == 49, F.lit('{"video_id":"x"}')).otherwise(F.col("payload")))


_ODD = "ingest_seq % 50 <> 49"
_NORM_TEXT = """CASE source WHEN 'tiktok' THEN text ELSE trim('Title ' || content_id || '. ' || text,
 chr(9)||chr(10)||chr(13)||' '||chr(160)) END"""


@query("detect_shape", f"""WITH {ITEMS} SELECT ingest_seq, CASE WHEN {_ODD} THEN source ELSE 'unknown' END AS kind FROM items""")
def detect_shape(spark, sf):
    return mixed_payloads(spark, sf).select("ingest_seq", F.coalesce(
        normalize.detect_source(F.col("payload")), F.lit("unknown")).alias("kind"))


@query("normalize_items", f"""WITH {ITEMS} SELECT ingest_seq, source, content_id, md5({_NORM_TEXT}) AS text_md5,
 CASE source WHEN 'vnexpress' THEN 0 ELSE 2 END AS n_tags, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at,
 views, likes, comments, shares, collects, author_followers,
 CASE source WHEN 'vnexpress' THEN 'VNExpress' ELSE author_name END AS author_name,
 CASE WHEN source='youtube' THEN ingest_seq % 3600 END AS duration_seconds
FROM items WHERE {_ODD}""")
def normalize_items(spark, sf):
    items, _ = normalize.normalize(mixed_payloads(spark, sf), "payload", NOW, ("ingest_seq",))
    return items.select(
        "ingest_seq", "source", "content_id", F.md5("text").alias("text_md5"),
        F.size("hashtags").alias("n_tags"), stamp("published_at"), "views", "likes", "comments",
        "shares", "collects", "author_followers", "author_name", "duration_seconds")


@query("from_short_video", f"""WITH {ITEMS} SELECT content_id, 'tiktok' AS source, md5(text) AS text_md5,
 'https://video.example/' || content_id AS url, coalesce(views,0) AS views, coalesce(collects,0) AS collects,
 ingest_seq % 2 = 0 AS author_verified, language FROM items""")
def from_short_video(spark, sf):
    return normalize.from_short_video(short_videos(spark, sf), NOW).select(
        "content_id", "source", F.md5("text").alias("text_md5"), "url", "views", "collects",
        "author_verified", "language")


@query("from_article", f"""WITH {ITEMS} SELECT content_id, 'vnexpress' AS source,
 md5(trim('Title ' || content_id || '. ' || text, chr(9)||chr(10)||chr(13)||' '||chr(160))) AS text_md5,
 CAST(NULL AS BIGINT) AS views, 0 AS n_tags, 'Thời sự' AS category FROM items""")
def from_article(spark, sf):
    return normalize.from_article(articles(spark, sf), NOW).select(
        "content_id", "source", F.md5("text").alias("text_md5"), "views",
        F.size("hashtags").alias("n_tags"), "category")


@query("from_long_video", f"""WITH {ITEMS} SELECT content_id, 'youtube' AS source,
 md5(trim('Title ' || content_id || '. ' || text, chr(9)||chr(10)||chr(13)||' '||chr(160))) AS text_md5,
 coalesce(views,0) AS views, CAST(NULL AS BIGINT) AS shares, 'ch' || author_name AS channel_id FROM items""")
def from_long_video(spark, sf):
    return normalize.from_long_video(long_videos(spark, sf), NOW).select(
        "content_id", "source", F.md5("text").alias("text_md5"), "views", "shares", "channel_id")


@query("route_by_source", f"WITH {ITEMS} SELECT source, count(*) AS n FROM items GROUP BY source")
def route_by_source(spark, sf):
    return fx.content_items(spark, sf).select(
        normalize.route(F.col("source")).alias("source")).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"))


_LAYOUTS = ("tiktok", "vnexpress", "youtube", "google_trends")


@query("route_records", """WITH d AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS i, md5(text) AS text_md5,
  (['tiktok', 'vnexpress', 'youtube', 'google_trends'])[doc_id % 4 + 1] AS kind FROM documents)
SELECT doc_id, kind, CASE kind WHEN 'vnexpress' THEN 'a' || i WHEN 'google_trends' THEN 'q' || i ELSE 'v' || i END AS record,
 CASE kind WHEN 'tiktok' THEN text_md5 WHEN 'youtube' THEN md5('') END AS text_md5,
 CASE kind WHEN 'tiktok' THEN doc_id % 1000 WHEN 'youtube' THEN 0 END AS views,
 CASE kind WHEN 'vnexpress' THEN 'VNExpress' WHEN 'tiktok' THEN '' END AS author,
 CASE kind WHEN 'youtube' THEN 'c' || i END AS channel_id, CASE kind WHEN 'youtube' THEN doc_id % 3600 END AS duration_seconds,
 CASE kind WHEN 'google_trends' THEN 'VN' END AS region, CASE kind WHEN 'google_trends' THEN doc_id % 100 END AS latest
FROM d""")
def route_records(spark, sf):
    """Envelopes of all four layouts as typed records by their declared source; absent keys take defaults."""
    d, i = F.col("doc_id"), F.col("doc_id").cast("string")
    kind = F.element_at(F.array(*map(F.lit, _LAYOUTS)), (d % 4 + 1).cast("int"))
    payload = F.when(d % 4 == 0, F.to_json(F.struct(
        F.concat(F.lit("v"), i).alias("video_id"), "text", (d % 1000).alias("views")))).when(d % 4 == 1, F.to_json(
            F.struct(F.concat(F.lit("a"), i).alias("article_id")))).when(d % 4 == 2, F.to_json(F.struct(
                F.concat(F.lit("v"), i).alias("video_id"), F.concat(F.lit("c"), i).alias("channel_id"),
                (d % 3600).alias("duration_seconds")))).otherwise(F.to_json(F.struct(
                    F.concat(F.lit("q"), i).alias("query"), F.array(F.struct(
                        F.lit("2024-01-01").alias("date"), (d % 100).alias("value"))).alias("interest_over_time"))))
    rows = fx.table(spark, sf, "documents").select("doc_id", kind.alias("kind"), payload.alias("payload"))
    r = rows.select("doc_id", "kind", normalize.typed(F.col("payload"), F.col("kind")).alias("r"))
    return r.select(
        "doc_id", "kind", F.coalesce("r.tiktok.video_id", "r.vnexpress.article_id", "r.youtube.video_id",
                                     "r.google_trends.query").alias("record"),
        F.md5(F.coalesce("r.tiktok.text", "r.youtube.description")).alias("text_md5"),
        F.coalesce("r.tiktok.views", "r.youtube.views").alias("views"),
        F.coalesce("r.vnexpress.author", "r.tiktok.author_username").alias("author"),
        "r.youtube.channel_id", "r.youtube.duration_seconds", "r.google_trends.region",
        F.element_at("r.google_trends.interest_over_time.value", -1).alias("latest"))


@query("missing_field_defaults", """SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN CAST(doc_id AS VARCHAR) ELSE '' END AS video_id,
 CASE WHEN doc_id % 3 = 0 THEN NULL ELSE 0 END AS views, 0 AS n_tags, false AS verified, CAST(NULL AS VARCHAR) AS language
FROM documents""")
def missing_field_defaults(spark, sf):
    """Absent keys take the default, present nulls stay null."""
    d = F.col("doc_id")
    payload = F.concat(
        F.lit("{"), F.when(d % 2 == 0, F.concat(F.lit('"video_id":"'), d.cast("string"), F.lit('",')))
        .otherwise(""), F.when(d % 3 == 0, '"views":null,').otherwise(""), F.lit('"likes":1}'))
    out = fx.table(spark, sf, "documents").select(
        "doc_id", normalize.apply_defaults(payload, "tiktok").alias("p"))
    return out.select("doc_id", "p.video_id", F.col("p.views").alias("views"),
                      F.size("p.hashtags").alias("n_tags"),
                      F.col("p.author_verified").alias("verified"), "p.language")


def _sparse_record(kind: str, nulled: bool) -> str:
    """The record of a payload without keys, or with its layout's first key null, as JSON text."""
    first = next(iter(schemas.DEFAULTS[kind]))
    return json.dumps({f.name: None if nulled and f.name == first else schemas.DEFAULTS[kind].get(f.name)
                       for f in schemas.PAYLOADS[kind].fields}, ensure_ascii=False, separators=(",", ":"))


@query("layout_defaults", f"""SELECT doc_id, CASE doc_id % 8 {' '.join(
    f"WHEN {i + 4 * nulled} THEN '{_sparse_record(kind, bool(nulled))}'" for nulled in (0, 1) for i, kind in enumerate(_LAYOUTS))}
 END AS record FROM documents""")
def layout_defaults(spark, sf):
    """All fields of all four layouts: defaults of absent keys, nulls of present ones and of fields without a default."""
    d = F.col("doc_id")
    kind = F.element_at(F.array(*map(F.lit, _LAYOUTS)), (d % 4 + 1).cast("int"))
    first = F.element_at(F.array(*[F.lit(next(iter(schemas.DEFAULTS[k]))) for k in _LAYOUTS]), (d % 4 + 1).cast("int"))
    payload = F.when(d % 8 < 4, "{}").otherwise(F.concat(F.lit('{"'), first, F.lit('":null}')))
    typed = fx.table(spark, sf, "documents").select("doc_id", normalize.typed(payload, kind).alias("r"))
    return typed.select("doc_id", F.coalesce(*[F.when(F.col(f"r.{k}").isNotNull(), F.to_json(
        f"r.{k}", {"ignoreNullFields": "false"})) for k in _LAYOUTS]).alias("record"))


# ------------------------------------------------------------------ decoding and envelopes

def _messages(spark, sf):
    """Topic rows from all documents: envelope JSON, one partition in four, some unreadable."""
    short = short_videos(spark, sf)
    sent = topics.to_envelope(short, "tiktok", "video_id", NOW)
    seq = F.col("key").cast("long")
    return sent.select(
        "key", F.when(seq % 10 == 9, F.substring("value", 1, 40)).otherwise(F.col("value")).alias("value"),
        F.lit("short-raw").alias("topic"), (seq % 4).cast("int").alias("partition"),
        F.floor(seq / 4).alias("offset"))


@query("decode_messages", f"""WITH {ITEMS} SELECT content_id, 'tiktok' AS source, md5(text) AS text_md5,
 coalesce(likes,0) AS likes, ingest_seq // 4 AS "offset" FROM items WHERE ingest_seq % 10 <> 9""")
def decode_messages(spark, sf):
    good, _ = topics.decode(_messages(spark, sf), "tiktok")
    return good.select("content_id", "source", F.md5("data.text").alias("text_md5"),
                       "data.likes", "offset")


@query("decode_rejected", "SELECT CAST(doc_id AS VARCHAR) AS key, doc_id // 4 AS \"offset\" FROM documents WHERE doc_id % 10 = 9")
def decode_rejected(spark, sf):
    return topics.decode(_messages(spark, sf), "tiktok")[1].select("key", "offset")


@query("event_props", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def event_props(spark, sf):
    return fx.table(spark, sf, "events").select(
        "event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("next_offsets", """SELECT 'short-raw' AS topic, CAST(doc_id % 4 AS INTEGER) AS partition,
 max(doc_id // 4) + 1 AS next_offset FROM documents GROUP BY 2""")
def next_offsets(spark, sf):
    return topics.next_offsets(_messages(spark, sf))


@query("resume_from_offsets", """WITH m AS (SELECT doc_id % 4 AS p, max(doc_id // 4) // 2 AS upto FROM documents GROUP BY 1)
SELECT CAST(d.doc_id AS VARCHAR) AS key FROM documents d LEFT JOIN m ON m.p = d.doc_id % 4 AND m.p <> 3
WHERE d.doc_id // 4 >= coalesce(m.upto, 0)""")
def resume_from_offsets(spark, sf):
    from tidemark.streaming.intake import unread

    rows = _messages(spark, sf)
    # partition 3 has no stored offset and is read from the start
    manifest = rows.filter("partition <> 3").groupBy("topic", "partition").agg(
        F.floor(F.max("offset") / 2).alias("next_offset"))
    return unread(rows, manifest).select("key")


@query("envelope_rows", f"""WITH {ITEMS} SELECT content_id AS key, 'tiktok' AS source, '2024-01-31T00:00:00' AS collected_at,
 md5(text) AS text_md5, language || ',' || channel AS tags FROM items""")
def envelope_rows(spark, sf):
    sent = topics.to_envelope(short_videos(spark, sf), "tiktok", "video_id", NOW)
    v = F.from_json("value", schemas.envelope(schemas.SHORT_VIDEO))
    return sent.select("key", v.alias("m")).select(
        "key", "m.source", "m.collected_at", F.md5("m.data.text").alias("text_md5"),
        F.array_join("m.data.hashtags", ",").alias("tags"))


@query("feed_union", f"WITH {ITEMS} SELECT source AS feed, count(*) AS n FROM items GROUP BY source")
def feed_union(spark, sf):
    """Three feeds from files, a fourth that does not exist."""
    root = scratch_path(spark, "feeds")
    items = fx.content_items(spark, sf).select("source", "content_id", "text", "views")
    items.write.partitionBy("source").parquet(root)
    readers = {s: (lambda s=s: spark.read.parquet(f"{root}/source={s}"))
               for s in ("tiktok", "vnexpress", "youtube", "google_trends")}
    return rollup.count_by(topics.read_feeds(readers), "feed")


# ------------------------------------------------------------------ raw dumps

@query("wide_csv", f"""WITH {ITEMS} SELECT content_id AS video_id, md5(text) AS text_md5, language || ',' || channel AS tags,
 coalesce(views,0) AS views, coalesce(shares,0) AS shares, ingest_seq % 2 = 0 AS author_verified,
 CASE WHEN ingest_seq % 5 = 0 THEN '2024-01-31T00:00:00' ELSE strftime(published_at, '{_SECONDS}') END AS timestamp FROM items""")
def wide_csv(spark, sf):
    """Written as a wide export, read back and mapped."""
    path = scratch_path(spark, "wide")
    v = short_videos(spark, sf)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = v.select(
        F.col("video_id").alias("id"), "text",
        F.col("hashtags")[0].alias("hashtags/0/name"), F.lit("").alias("hashtags/1/name"),
        F.col("hashtags")[1].alias("hashtags/27/name"),
        F.when(F.col("views") == 0, "").otherwise(text("views")).alias("playCount"),
        text("likes").alias("diggCount"), text("comments").alias("commentCount"),
        text("shares").alias("shareCount"), text("collects").alias("collectCount"),
        F.col("author_username").alias("authorMeta/name"), text("author_fans").alias("authorMeta/fans"),
        F.when(F.col("author_verified"), "True").otherwise("false").alias("authorMeta/verified"),
        F.when(F.col("ingest_seq") % 5 == 0, "no time").otherwise(F.col("timestamp")).alias("createTimeISO"),
        F.col("language").alias("textLanguage"), F.col("video_url").alias("webVideoUrl"))
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    out = feeds.from_wide_csv(feeds.read_wide_csv(spark, path), NOW)
    return out.select("video_id", F.md5("text").alias("text_md5"), joined("hashtags", "tags"),
                      "views", "shares", "author_verified", "timestamp")


@query("raw_short_video", f"""WITH {ITEMS} SELECT content_id AS video_id, md5(text) AS text_md5, language || ',' || channel AS tags,
 coalesce(likes,0) AS likes, author_name AS author_username, coalesce(author_followers,0) AS author_fans,
 ingest_seq % 2 = 0 AS author_verified, strftime(published_at, '{_SECONDS}') AS timestamp, language FROM items""")
def raw_short_video(spark, sf):
    v = short_videos(spark, sf)
    lang, channel = F.col("hashtags")[0], F.col("hashtags")[1]
    # hashtags as one object and one string in the same array
    head = F.to_json(F.struct(
        F.col("video_id").alias("id"), "text", F.col("views").alias("playCount"),
        F.col("likes").cast("string").alias("diggCount"), F.col("comments").alias("commentCount"),
        F.struct(F.col("author_username").alias("name"), F.col("author_fans").alias("fans"),
                 F.col("author_verified").alias("verified")).alias("authorMeta"),
        F.concat("timestamp", F.lit(".000Z")).alias("createTimeISO"),
        F.array(F.struct(F.col("language").alias("languageCode"))).alias("textExtra")))
    tags = F.concat(F.lit(',"hashtags":[{"name":"'), lang, F.lit('"},"'), channel, F.lit('"]}'))
    raw = v.select(F.concat(F.substring(head, F.lit(1), F.length(head) - 1), tags).alias("raw"))
    return feeds.flatten_short_video(raw, "raw", NOW).select(
        "video_id", F.md5("text").alias("text_md5"), joined("hashtags", "tags"), "likes",
        "author_username", "author_fans", "author_verified", "timestamp", "language")


@query("raw_long_video", f"""WITH {ITEMS} SELECT content_id AS video_id, md5(text) AS text_md5,
 'https://www.youtube.com/watch?v=' || content_id AS url, coalesce(views,0) AS views, language || ',' || channel AS tags,
 ingest_seq % 60 * 60 + ingest_seq % 7 AS duration_seconds,
 CASE ingest_seq % 4 WHEN 0 THEN 'h' WHEN 1 THEN 'm' WHEN 2 THEN 'd' ELSE '' END AS thumbnail FROM items""")
def raw_long_video(spark, sf):
    v = long_videos(spark, sf)
    kind = F.col("ingest_seq") % 4
    thumb = lambda code, value: F.when(kind == code, F.struct(F.lit(value).alias("url")))
    raw = v.select(F.to_json(F.struct(
        F.col("video_id").alias("id"),
        F.struct("title", "description", "tags", F.col("channel_name").alias("channelTitle"),
                 F.col("channel_id").alias("channelId"), F.col("published_at").alias("publishedAt"),
                 F.struct(thumb(0, "h").alias("high"), thumb(1, "m").alias("medium"),
                          thumb(2, "d").alias("default")).alias("thumbnails")).alias("snippet"),
        F.struct(F.col("views").cast("string").alias("viewCount"),
                 F.col("likes").cast("string").alias("likeCount")).alias("statistics"),
        F.struct(F.concat(F.lit("PT"), (F.col("ingest_seq") % 60).cast("string"), F.lit("M"),
                          (F.col("ingest_seq") % 7).cast("string"), F.lit("S")).alias("duration")
                 ).alias("contentDetails"))).alias("raw"))
    return feeds.flatten_long_video(raw, "raw", NOW).select(
        "video_id", F.md5("description").alias("text_md5"), "url", "views", joined("tags"),
        "duration_seconds", "thumbnail")


@query("feed_entries", f"""WITH f AS (SELECT *, lower({_FEED_URL_SQL}) AS u FROM pages)
SELECT CASE WHEN page_id % 2 = 0 THEN 'id-' || CAST(page_id AS VARCHAR)
  ELSE string_split(list_last(string_split(url, '/')), '.')[1] END AS article_id, url,
 CASE WHEN contains(u,'vnexpress.net') THEN 'VNExpress' WHEN contains(u,'tuoitre.vn') THEN 'Tuổi Trẻ'
 WHEN contains(u,'vtcnews.vn') THEN 'VTC News' WHEN contains(u,'thanhnien.vn') THEN 'Thanh Niên' ELSE 'Unknown' END AS author,
 md5(html) AS summary_md5, CASE WHEN page_id % 3 = 0 THEN 'thumb' ELSE 'content' END AS thumbnail FROM f""")
def feed_entries(spark, sf):
    p = F.col("page_id")
    entries = feed_urls(spark, sf).select(
        F.when(p % 2 == 0, F.concat(F.lit("id-"), p.cast("string"))).alias("id"),
        F.lit("t").alias("title"), F.col("html").alias("summary"), F.col("url").alias("link"),
        F.lit(NOW).cast("timestamp").alias("published"),
        F.when(p % 3 == 0, "thumb").alias("thumbnail"), F.lit("content").alias("content"), "feed_url")
    return feeds.flatten_article(entries, NOW).select(
        "article_id", "url", "author", F.md5("summary").alias("summary_md5"), "thumbnail")


@query("feed_xml", """SELECT page_id AS id, 'Page ' || CAST(page_id AS VARCHAR) AS title, url AS link,
 '2024-01-15 10:30:00' AS published FROM pages""")
def feed_xml(spark, sf):
    """Entries written as feed XML and read back."""
    path = scratch_path(spark, "xml")
    fx.table(spark, sf, "pages").select(
        F.col("page_id").cast("string").alias("guid"),
        F.concat(F.lit("Page "), F.col("page_id").cast("string")).alias("title"),
        F.lit("d").alias("description"), F.col("url").alias("link"),
        F.lit("Mon, 15 Jan 2024 10:30:00 +0000").alias("pubDate")).write.format("xml").option(
        "rowTag", "item").option("rootTag", "channel").save(path)
    return feeds.read_feed_xml(spark, path).select(
        F.col("id").cast("long").alias("id"), "title", "link", stamp("published"))


@query("interest_series", """WITH d AS (SELECT date_trunc('day', ts) AS day, event_type, count(*) AS v FROM events GROUP BY 1, 2)
SELECT event_type AS query, strftime(day, '%Y-%m-%d') AS day, v AS value FROM d""")
def interest_series(spark, sf):
    """One column a keyword -> one row a keyword and day."""
    return feeds.interest_long(_matrix(spark, sf), "day", list(_TYPES)).select(
        "query", F.date_format("date", "yyyy-MM-dd").alias("day"), "value")


_TYPES = ("click", "signup", "purchase", "view", "error")


def _matrix(spark, sf):
    return fx.table(spark, sf, "events").groupBy(
        F.date_trunc("day", F.col("ts").cast("timestamp")).alias("day")).pivot(
        "event_type", list(_TYPES)).agg(F.count(F.lit(1)))


@query("interest_payloads", """WITH d AS (SELECT date_trunc('day', ts) AS day, event_type, count(*) AS v FROM events GROUP BY 1, 2),
 u AS (SELECT event_type, user_id % 10 AS q, count(*) AS v FROM events GROUP BY 1, 2)
SELECT event_type AS query, count(*) AS points, CAST(sum(v) AS BIGINT) AS total, 'VN' AS region, 'now 7-d' AS timeframe,
 (SELECT count(*) FROM u WHERE u.event_type = d.event_type) AS top_n,
 (SELECT count(*) FROM u WHERE u.event_type = d.event_type) AS rising_n FROM d GROUP BY event_type""")
def interest_payloads(spark, sf):
    related = fx.table(spark, sf, "events").groupBy(
        F.col("event_type").alias("keyword"), (F.col("user_id") % 10).cast("string").alias("query")
    ).agg(F.count(F.lit(1)).alias("value"))
    rising = related.withColumn("value", F.lit("Breakout"))
    out = feeds.flatten_interest(_matrix(spark, sf), "day", list(_TYPES), related, rising)
    kinds = lambda k: F.size(F.filter("related_queries", lambda r: r["type"] == k)).cast("long")
    return out.select(
        "query", F.size("interest_over_time").cast("long").alias("points"),
        F.aggregate("interest_over_time", F.lit(0).cast("long"), lambda a, x: a + x["value"]).alias("total"),
        "region", "timeframe", kinds("top").alias("top_n"), kinds("rising").alias("rising_n"))


# ------------------------------------------------------------------ snapshots and aggregate

@query("snapshot_replay", f"WITH {ITEMS} SELECT content_id, md5(text) AS text_md5, views FROM items")
def snapshot_replay(spark, sf):
    root = scratch_path(spark, "snapshots")
    items = fx.content_items(spark, sf).select("content_id", "text", "views")
    path = snapshots.write_snapshot(items, root, "items", datetime(2024, 1, 31))
    back = snapshots.read_snapshots(spark, path, items.schema, array_files=False)
    return back.select("content_id", F.md5("text").alias("text_md5"), "views")


@query("audit_copy", f"""WITH {ITEMS} SELECT source, content_id, md5(text) AS text_md5, views, likes, author_followers,
 strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published FROM items""")
def audit_copy(spark, sf):
    """Items saved for audit and read back; a second copy of the same batch fails and stops nothing."""
    root, at = scratch_path(spark, "audit"), datetime(2024, 1, 31)
    items = fx.content_items(spark, sf).drop("cluster_id", "channel")
    path = snapshots.try_write_snapshot(items, root, "items", at)
    if snapshots.try_write_snapshot(items, root, "items", at) is not None:
        raise RuntimeError("a batch was saved twice")
    back = snapshots.read_snapshots(spark, path, items.schema, array_files=False)
    return back.select("source", "content_id", F.md5("text").alias("text_md5"), "views", "likes", "author_followers",
                       stamp("published_at", "published"))


@query("snapshot_array_files", f"WITH {ITEMS} SELECT content_id, md5(text) AS text_md5, views FROM items")
def snapshot_array_files(spark, sf):
    """Pretty-printed JSON array files, as collectors dump them: two hundred rows a file."""
    root = scratch_path(spark, "arrays")
    items = fx.content_items(spark, sf).select("content_id", "text", "views", "ingest_seq")
    row = F.to_json(F.struct("content_id", "text", "views"), {"pretty": "true"})
    files = items.withColumn("file", F.floor(F.col("ingest_seq") / 200)).groupBy("file").agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list(row), ",\n"), F.lit("\n]")).alias("value"))
    files.repartition("file").write.partitionBy("file").text(root)
    schema = items.drop("ingest_seq").schema
    back = snapshots.read_snapshots(spark, f"{root}/*/*.txt", schema)
    return back.select("content_id", F.md5("text").alias("text_md5"), "views")


_AGGREGATE = """WITH e AS (SELECT CAST(doc_id // 2 AS VARCHAR) AS id, doc_id FROM documents WHERE lang = 'en'),
 n AS (SELECT CASE WHEN doc_id % 9 = 0 THEN '' ELSE CAST(doc_id // 3 AS VARCHAR) END AS id, doc_id FROM documents WHERE lang <> 'en'),
 fresh AS (SELECT id, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY doc_id) AS rn FROM n WHERE id <> '')
  WHERE rn = 1 AND id NOT IN (SELECT id FROM e) UNION ALL SELECT id, doc_id FROM n WHERE id = '')"""


def _aggregate_sides(spark, sf):
    d = F.col("doc_id")
    docs = fx.table(spark, sf, "documents")
    old = docs.filter("lang = 'en'").select(
        F.floor(d / 2).cast("string").alias("video_id"), d.alias("ingest_seq"))
    new = docs.filter("lang <> 'en'").select(
        F.when(d % 9 == 0, "").otherwise(F.floor(d / 3).cast("string")).alias("video_id"),
        d.alias("ingest_seq"))
    return old, new


@query("append_unique", _AGGREGATE + """ SELECT id AS video_id, doc_id AS ingest_seq FROM e
UNION ALL SELECT id, doc_id FROM fresh""")
def append_unique(spark, sf):
    """Stored rows stay as they are, the first new row of each unseen id and all rows without id join."""
    return snapshots.append_unique(*_aggregate_sides(spark, sf))


@query("fresh_rows", _AGGREGATE + " SELECT id AS video_id, doc_id AS ingest_seq FROM fresh")
def fresh_rows(spark, sf):
    return snapshots.fresh_rows(*_aggregate_sides(spark, sf))


# ------------------------------------------------------------------ annotation JSON

_JSON_KINDS = """CASE conv_id % 4 WHEN 0 THEN 'plain' WHEN 1 THEN 'fenced' WHEN 2 THEN 'cut' ELSE 'lost' END"""


def answers(spark, sf):
    """Annotation answers with every conversation text as summary: plain, fenced, cut off, hopeless."""
    plain = F.to_json(F.struct(
        F.concat(F.lit("conv "), F.col("conv_id").cast("string")).alias("topic"),
        F.col("text").alias("summary"), F.lit("neutral").alias("sentiment"),
        F.array("role").alias("keywords")))
    kind = F.col("conv_id") % 4
    # cut: the closing bracket and brace are gone; lost: the text ends inside a string
    answer = (
        F.when(kind == 0, plain)
        .when(kind == 1, F.concat(F.lit("Here you are:\n```json\n"), plain, F.lit("\n```\n")))
        .when(kind == 2, F.substring(plain, F.lit(1), F.length(plain) - 2))
        .otherwise(F.substring(plain, F.lit(1), F.length(plain) - 4)))
    return fx.table(spark, sf, "conversations", heavy=True).select("conv_id", "turn", "text", answer.alias("answer"))


@query("repair_json", f"""SELECT conv_id, turn, {_JSON_KINDS} <> 'lost' AS usable,
 CASE WHEN {_JSON_KINDS} <> 'lost' THEN md5(text) END AS text_md5 FROM conversations""")
def repair_json(spark, sf):
    fixed = answers(spark, sf).withColumn("fixed", repair.repair_json(F.col("answer")))
    return fixed.select("conv_id", "turn", F.col("fixed").isNotNull().alias("usable"),
                        F.md5(F.get_json_object("fixed", "$.summary")).alias("text_md5"))


@query("read_annotations", f"""SELECT conv_id, turn, 'conv ' || CAST(conv_id AS VARCHAR) AS topic, md5(text) AS text_md5,
 'entertainment' AS content_type, 'safe' AS risk_level, role AS keywords FROM conversations WHERE {_JSON_KINDS} <> 'lost'""")
def read_annotations(spark, sf):
    keyed = answers(spark, sf).withColumn("key", F.struct("conv_id", "turn"))
    good, _ = annotate.read_answers(keyed, "key")
    return good.select("key.conv_id", "key.turn", "topic", F.md5("summary").alias("text_md5"),
                       "content_type", "risk_level", joined("keywords"))
