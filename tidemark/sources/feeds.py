"""Raw dumps of each feed to payload rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.functions import times, urls

WIDE_HASHTAGS = 28


def _number(col: Column) -> Column:
    return F.coalesce(col.try_cast("long"), F.lit(0).cast("long"))


def _iso(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")


def read_wide_csv(spark: SparkSession, path: str) -> DataFrame:
    """Wide export, all columns as text; captions may span lines."""
    return spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')


def from_wide_csv(df: DataFrame, now) -> DataFrame:
    """Wide export row to short-video payload; column names contain slashes."""
    names = set(df.columns)

    def field(name: str) -> Column:
        return F.col(f"`{name}`") if name in names else F.lit(None).cast("string")

    tags = F.array(*[field(f"hashtags/{i}/name") for i in range(WIDE_HASHTAGS)])
    return df.select(
        F.coalesce(field("id"), F.lit("")).alias("video_id"),
        F.coalesce(field("text"), F.lit("")).alias("text"),
        F.filter(tags, lambda t: ~tx.blank(t)).alias("hashtags"),
        _number(field("playCount")).alias("views"),
        _number(field("diggCount")).alias("likes"),
        _number(field("commentCount")).alias("comments"),
        _number(field("shareCount")).alias("shares"),
        _number(field("collectCount")).alias("collects"),
        F.coalesce(field("authorMeta/name"), F.lit("")).alias("author_username"),
        _number(field("authorMeta/fans")).alias("author_fans"),
        (F.lower(F.coalesce(field("authorMeta/verified"), F.lit("false"))) == "true").alias(
            "author_verified"),
        _iso(times.parse_iso(field("createTimeISO"), now)).alias("timestamp"),
        field("textLanguage").alias("language"),
        field("webVideoUrl").alias("video_url"),
    )


def flatten_short_video(df: DataFrame, raw: str, now) -> DataFrame:
    """Raw collector JSON to short-video payload.  Hashtags come as objects or as strings."""
    v = F.try_parse_json(raw)

    def at(path: str, kind: str = "string") -> Column:
        return F.try_variant_get(F.col("_v"), path, kind)

    def tag(h: Column) -> Column:
        return F.when(F.schema_of_variant(h) == "STRING", F.try_variant_get(h, "$", "string")
                      ).otherwise(F.try_variant_get(h, "$.name", "string"))

    tags = F.coalesce(at("$.hashtags", "array<variant>"), F.array().cast("array<variant>"))
    # an empty primary time falls through to the secondary one
    when = F.coalesce(F.nullif(at("$.createTimeISO"), F.lit("")), at("$.createTime"))
    return df.withColumn("_v", v).filter(F.col("_v").isNotNull()).select(
        F.coalesce(at("$.id"), F.lit("")).alias("video_id"),
        F.coalesce(at("$.text"), F.lit("")).alias("text"),
        F.filter(F.transform(tags, tag), lambda t: t.isNotNull()).alias("hashtags"),
        _number(at("$.playCount")).alias("views"),
        _number(at("$.diggCount")).alias("likes"),
        _number(at("$.commentCount")).alias("comments"),
        _number(at("$.shareCount")).alias("shares"),
        _number(at("$.collectCount")).alias("collects"),
        F.coalesce(at("$.authorMeta.name"), F.lit("")).alias("author_username"),
        _number(at("$.authorMeta.fans")).alias("author_fans"),
        F.coalesce(at("$.authorMeta.verified", "boolean"), F.lit(False)).alias("author_verified"),
        _iso(times.parse_iso(when, now)).alias("timestamp"),
        at("$.textExtra[0].languageCode").alias("language"),
        F.coalesce(at("$.webVideoUrl"), F.lit("")).alias("video_url"),
    )


_LONG_VIDEO_RAW = """
struct<id:string,
  snippet:struct<title:string,description:string,tags:array<string>,channelTitle:string,
    channelId:string,publishedAt:string,categoryId:string,
    thumbnails:struct<high:struct<url:string>,medium:struct<url:string>,`default`:struct<url:string>>>,
  statistics:struct<viewCount:string,likeCount:string,commentCount:string>,
  contentDetails:struct<duration:string>>
"""


def flatten_long_video(df: DataFrame, raw: str, now) -> DataFrame:
    """Raw interface JSON to long-video payload; counts arrive as text.  No id, no row."""
    r = F.col("_r")
    text = lambda c: F.coalesce(c, F.lit(""))
    thumbs = r["snippet"]["thumbnails"]
    picks = [F.nullif(thumbs[size]["url"], F.lit("")) for size in ("high", "medium", "default")]
    return (
        df.withColumn("_r", F.from_json(raw, _LONG_VIDEO_RAW))
        .filter(r["id"].isNotNull())
        .select(
            r["id"].alias("video_id"),
            text(r["snippet"]["title"]).alias("title"),
            text(r["snippet"]["description"]).alias("description"),
            F.concat(F.lit("https://www.youtube.com/watch?v="), r["id"]).alias("url"),
            F.coalesce(r["snippet"]["tags"], F.array().cast("array<string>")).alias("tags"),
            _number(r["statistics"]["viewCount"]).alias("views"),
            _number(r["statistics"]["likeCount"]).alias("likes"),
            _number(r["statistics"]["commentCount"]).alias("comments"),
            text(r["snippet"]["channelTitle"]).alias("channel_name"),
            text(r["snippet"]["channelId"]).alias("channel_id"),
            F.coalesce(r["snippet"]["publishedAt"], _iso(times.clock(now))).alias("published_at"),
            times.duration_seconds(F.coalesce(r["contentDetails"]["duration"], F.lit("PT0S"))).alias(
                "duration_seconds"),
            F.coalesce(*picks, F.lit("")).alias("thumbnail"),
            r["snippet"]["categoryId"].alias("category"),
        )
    )


def _mail_date(col: Column) -> Column:
    """``Mon, 15 Jan 2024 10:30:00 +0700`` (or GMT); the weekday carries no information."""
    plain = F.regexp_replace(F.regexp_replace(col, r"^\s*[A-Za-z]{3},\s*", ""), r"\bGMT$", "+0000")
    return F.try_to_timestamp(plain, F.lit("d MMM yyyy HH:mm:ss Z"))


def read_feed_xml(spark: SparkSession, path: str) -> DataFrame:
    """Entries of feed dumps; one row an ``item`` element."""
    schema = ("guid string, title string, description string, link string, pubDate string, "
              "thumbnail string, content string")
    return spark.read.format("xml").option("rowTag", "item").schema(schema).load(path).select(
        F.col("guid").alias("id"), "title", F.col("description").alias("summary"), "link",
        _mail_date(F.col("pubDate")).alias("published"),
        "thumbnail", "content")


def flatten_article(df: DataFrame, now, feed_url: str = "feed_url") -> DataFrame:
    """Feed entry (id, title, summary, link, published, thumbnail, content, feed_url) to payload."""
    text = lambda name: F.coalesce(F.col(name), F.lit(""))
    return df.select(
        urls.article_id(F.col("id"), F.col("link")).alias("article_id"),
        text("title").alias("title"), text("summary").alias("summary"), text("link").alias("url"),
        urls.category(F.col(feed_url)).alias("category"),
        _iso(F.coalesce("published", times.clock(now))).alias("published_at"),
        F.coalesce("thumbnail", "content").alias("thumbnail"),
        urls.publisher(F.col(feed_url)).alias("author"),
    )


def interest_long(df: DataFrame, date: str, keywords: list[str]) -> DataFrame:
    """One column a keyword -> (query, date, value)."""
    return df.unpivot([date], list(keywords), "query", "value").select(
        "query", F.col(date).alias("date"), F.col("value").cast("long").alias("value"))


def related_long(top: DataFrame, rising: DataFrame) -> DataFrame:
    """Related queries of both kinds; a rising value may be a word, so values are text."""
    def tagged(df: DataFrame, kind: str) -> DataFrame:
        return df.select("keyword", "query", F.col("value").cast("string").alias("value"),
                         F.lit(kind).alias("type"))
    return tagged(top, "top").unionByName(tagged(rising, "rising"))


def flatten_interest(matrix: DataFrame, date: str, keywords: list[str], top: DataFrame,
                     rising: DataFrame, region: str = "VN",
                     timeframe: str = "now 7-d") -> DataFrame:
    """One payload row per keyword.  The arrays are a keyword's own series, as the payload asks."""
    order = F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss")
    series = interest_long(matrix, date, keywords).groupBy("query").agg(
        F.sort_array(F.collect_list(F.struct(order.alias("date"), "value"))).alias(
            "interest_over_time"))
    related = related_long(top, rising).groupBy(F.col("keyword").alias("query")).agg(
        F.sort_array(F.collect_list(F.struct(
            F.when(F.col("type") == "top", 0).otherwise(1).alias("o"), "query", "value", "type"))
        ).alias("r"))
    strip_order = F.transform("r", lambda x: F.struct(x["query"], x["value"], x["type"]))
    empty = F.array().cast("array<struct<query:string,value:string,type:string>>")
    return series.join(related, "query", "left").select(
        "query", "interest_over_time", F.coalesce(strip_order, empty).alias("related_queries"),
        F.lit(region).alias("region"), F.lit(timeframe).alias("timeframe"))


def active_keywords(df: DataFrame, feed: str | None = None) -> DataFrame:
    """Tracked keywords, of one feed or of all."""
    active = df.filter(F.col("status") == "active")
    return active if feed is None else active.filter(F.array_contains("sources", feed))
