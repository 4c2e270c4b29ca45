"""Row filters: cleaning, per-source quality, keyword match, recency, facets."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import QualityConfig
from tidemark.functions import engagement as eng
from tidemark.functions import text as tx
from tidemark.functions import times
from tidemark.runtime import cut


def is_clean(min_chars: int = 10) -> Column:
    return (
        ~tx.blank(F.col("content_id")) & ~tx.blank(F.col("text")) & ~tx.blank(F.col("source"))
        & (F.length(tx.strip(F.coalesce("text", F.lit("")))) >= min_chars)
    )


def clean(df: DataFrame, min_chars: int = 10) -> DataFrame:
    """Drop rows without id, text or source, or with too little text; null hashtags become []."""
    return df.filter(is_clean(min_chars)).withColumn(
        "hashtags", F.coalesce("hashtags", F.array().cast("array<string>")))


def _below(value: Column, minimum) -> Column:
    """Known (neither null nor 0) and below the minimum."""
    return F.coalesce((value != 0) & (value < minimum), F.lit(False))


def _rate_below(part: Column, minimum: float) -> Column:
    """Rate over views below the minimum; unknown views never fail."""
    views = F.when(F.col("views") > 0, F.col("views"))
    return F.coalesce(part / views < minimum, F.lit(False))


def short_video_reason(cfg: QualityConfig = QualityConfig()) -> Column:
    """First rule a short video fails, null when it passes all."""
    acts = eng.zero(F.col("likes")) + eng.zero(F.col("comments")) + eng.zero(F.col("shares"))
    return (
        F.when(_below(F.col("views"), cfg.min_views), "views")
        .when(_rate_below(acts, cfg.min_engagement_rate), "engagement")
        .when(_below(F.col("author_followers"), cfg.min_followers), "followers")
        .when(_rate_below(eng.zero(F.col("collects")), cfg.min_save_ratio), "saves")
    )


def long_video_reason(min_views: int = 500, min_rate: float = 0.001) -> Column:
    acts = eng.zero(F.col("likes")) + eng.zero(F.col("comments"))
    return (
        F.when(_below(F.col("views"), min_views), "views")
        .when(_rate_below(acts, min_rate), "engagement")
    )


def quality_short(df: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    return df.filter(short_video_reason(cfg).isNull())


def quality_long(df: DataFrame) -> DataFrame:
    return df.filter(long_video_reason().isNull())


def reject_reason(cfg: QualityConfig = QualityConfig()) -> Column:
    """Rule by source; articles and unknown sources always pass."""
    return (
        F.when(F.col("source") == "tiktok", short_video_reason(cfg))
        .when(F.col("source") == "youtube", long_video_reason())
    )


def quality_filter(df: DataFrame, cfg: QualityConfig = QualityConfig()) -> DataFrame:
    return df.filter(reject_reason(cfg).isNull())


def recent(df: DataFrame, now, hours: int = 24, column: str = "timestamp") -> DataFrame:
    """Rows from the last ``hours``.  A plain comparison on the column, so it reaches the scan."""
    return df.filter(F.col(column) >= times.clock(now) - F.make_dt_interval(hours=F.lit(hours)))


def facet(df: DataFrame, sentiments=None, risks=None, types=None) -> DataFrame:
    """Chosen values per facet; ``None`` leaves a facet open."""
    if sentiments is not None:
        df = df.filter(F.col("sentiment").isin(*sentiments))
    if risks is not None:
        df = df.filter(F.coalesce("risk_level", F.lit("safe")).isin(*risks))
    if types is not None:
        df = df.filter(F.coalesce("content_type", F.lit("entertainment")).isin(*types))
    return df


def search(df: DataFrame, query: str) -> DataFrame:
    """Topic or any keyword contains the text, whatever the case."""
    q = F.lit(query)
    hit = tx.contains_ci(F.coalesce("topic", F.lit("")), q) | F.coalesce(
        F.exists("keywords", lambda k: tx.contains_ci(k, q)), F.lit(False))
    return df.filter(hit)


def by_status(df: DataFrame, status: str) -> DataFrame:
    return df if status == "all" else df.filter(F.col("status") == status)


def headlines(df: DataFrame, order: str, cap: int | None = None) -> DataFrame:
    """The non-empty stripped titles; with ``cap`` the first so many in feed order (a plan-level top-k)."""
    titles = df.withColumn("title", tx.strip(F.col("title"))).filter(~tx.blank(F.col("title")))
    return titles if cap is None else titles.orderBy(order).limit(cap)


def _grams(text: Column, n: int) -> Column:
    """The distinct substrings of ``n`` characters, as 64-bit hashes: what they name is compared in full later."""
    found = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
    return F.transform(F.array_distinct(found), lambda g: F.xxhash64(F.lit(n), g))


def match_keywords(df: DataFrame, keywords: DataFrame, keyword: str = "keyword",
                   title: str = "title", summary: str = "summary", gram: int = 4) -> DataFrame:
    """Rows whose ``title + ' ' + summary`` contains any keyword, whatever the case.

    An inverted filter: each keyword is filed under that of its ``gram``-character substrings that the fewest texts
    hold (shorter keywords under themselves).  The texts' substrings meet the files in one join, and a
    pair that meets is a match if the text contains the whole keyword.  So the work follows the texts
    and the pairs that share a rare substring, not texts times keywords.  The list stays on the executors.

    Texts are told apart by digest, so rows need no id and equal texts are looked at once.  No keywords:
    every row is kept; so it is if the empty keyword is among them.
    """
    low = keywords.select(F.lower(keyword).alias("k")).filter(F.col("k").isNotNull()).distinct()
    lengths = [r["n"] for r in low.select(F.least(F.length("k"), F.lit(gram)).alias("n")).distinct().collect()]
    if not lengths or 0 in lengths:  # the empty string is in every text
        return df
    haystack = F.lower(F.concat(
        F.coalesce(F.col(title), F.lit("")), F.lit(" "), F.coalesce(F.col(summary), F.lit(""))))
    digest = F.substring(F.unhex(F.sha2(haystack, 256)), 1, 16)
    texts = df.select(digest.alias("_digest"), haystack.alias("_text"))
    own = F.coalesce(*[F.when(F.least(F.length("k"), F.lit(gram)) == n, _grams(F.col("k"), n)) for n in sorted(lengths)])
    filed = cut(low.select("k", F.explode(own).alias("g")))
    every = F.concat(*[_grams(F.col("_text"), n) for n in sorted(lengths)])
    met = cut(texts.dropDuplicates(["_digest"]).select("_digest", F.explode(every).alias("g")).join(
        filed.select("g").distinct(), "g"))
    held = met.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    # a substring that no text holds rules its keyword out
    rarest = filed.join(held, "g", "left").groupBy("k").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "g")).alias("m")).filter("m.n > 0").select("k", "m.g")
    pairs = met.join(rarest, "g").select("_digest", "k")
    hits = texts.dropDuplicates(["_digest"]).join(pairs, "_digest").filter(
        F.contains("_text", "k")).select("_digest").distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    return df.select(row, digest.alias("_digest")).join(cut(hits), "_digest", "left_semi").select("_row.*")
