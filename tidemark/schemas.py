"""Record layouts: wire payloads, the unified item, trends and keyword tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _B, _D, _TS = T.StringType(), T.LongType(), T.BooleanType(), T.DoubleType(), T.TimestampType()
_AS = T.ArrayType(T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


SHORT_VIDEO = _struct(
    video_id=_S, text=_S, hashtags=_AS,
    views=_L, likes=_L, comments=_L, shares=_L, collects=_L,
    author_username=_S, author_fans=_L, author_verified=_B,
    timestamp=_S, language=_S, video_url=_S,
)
ARTICLE = _struct(
    article_id=_S, title=_S, summary=_S, url=_S,
    category=_S, published_at=_S, thumbnail=_S, author=_S,
)
LONG_VIDEO = _struct(
    video_id=_S, title=_S, description=_S, url=_S, tags=_AS,
    views=_L, likes=_L, comments=_L, channel_name=_S, channel_id=_S,
    published_at=_S, duration_seconds=_L, thumbnail=_S, category=_S,
)
INTEREST = _struct(
    query=_S,
    interest_over_time=T.ArrayType(_struct(date=_S, value=_L)),
    related_queries=T.ArrayType(_struct(query=_S, value=_S, type=_S)),
    region=_S, timeframe=_S,
)

PAYLOADS = {
    "tiktok": SHORT_VIDEO,
    "vnexpress": ARTICLE,
    "youtube": LONG_VIDEO,
    "google_trends": INTEREST,
}

# Values an absent key takes; a key that is missing here stays null.
DEFAULTS = {
    "tiktok": {
        "video_id": "", "text": "", "hashtags": [], "views": 0, "likes": 0, "comments": 0,
        "shares": 0, "collects": 0, "author_username": "", "author_fans": 0,
        "author_verified": False, "timestamp": "",
    },
    "vnexpress": {
        "article_id": "", "title": "", "summary": "", "url": "", "category": "",
        "published_at": "", "author": "VNExpress",
    },
    "youtube": {
        "video_id": "", "title": "", "description": "", "url": "", "tags": [], "views": 0,
        "likes": 0, "comments": 0, "channel_name": "", "channel_id": "", "published_at": "",
        "duration_seconds": 0, "thumbnail": "",
    },
    "google_trends": {
        "query": "", "interest_over_time": [], "related_queries": [],
        "region": "VN", "timeframe": "now 7-d",
    },
}


def envelope(payload: T.StructType) -> T.StructType:
    return _struct(source=_S, collected_at=_S, content_id=_S, data=payload)


ITEM = _struct(
    content_id=_S, source=_S, collected_at=_TS, text=_S, url=_S, hashtags=_AS, published_at=_TS,
    views=_L, likes=_L, comments=_L, shares=_L, author_name=_S, author_followers=_L,
    collects=_L, author_verified=_B, language=_S, category=_S, thumbnail=_S, channel_id=_S,
    duration_seconds=_L,
)

SAMPLE = _struct(
    content_id=_S, source=_S, text=_S, url=_S, views=_L, likes=_L, comments=_L, author_name=_S,
)
GUIDELINES = _struct(
    for_marketers=_struct(
        should_participate=_B, summary=_S, recommendations=_AS, warnings=_AS, detailed_advice=_S),
    for_social_managers=_struct(
        intervention_needed=_B, summary=_S, actions=_AS, monitoring_points=_AS,
        detailed_analysis=_S),
)
ANNOTATION = _struct(
    topic=_S, summary=_S, sentiment=_S, keywords=_AS, content_type=_S, risk_level=_S,
    guidelines=GUIDELINES,
)
TREND = _struct(
    trend_id=_S, timestamp=_TS, last_updated=_TS, topic=_S, summary=_S, sentiment=_S, keywords=_AS,
    video_count=_L, total_views=_L, total_likes=_L, sample_videos=T.ArrayType(SAMPLE),
    source_counts=T.MapType(_S, _L), content_type=_S, risk_level=_S, guidelines=GUIDELINES,
)

SUBMISSION = _struct(
    id=_S, keyword=_S, reason=_S, submitted_by=_S, status=_S, created_at=_TS,
    reviewed_at=_TS, reviewed_by=_S, notes=_S,
)
ACTIVE_KEYWORD = _struct(
    keyword=_S, sources=_AS, status=_S, added_at=_TS, added_by=_S, origin=_S,
)
HISTORY = _struct(
    keyword=_S, action=_S, performed_by=_S, performed_at=_TS, details=T.MapType(_S, _S),
)
EXTRACTED = _struct(
    id=_S, keyword=_S, category=_S, reason=_S, extracted_at=_TS, status=_S, source=_S,
    num_headlines=_L, reviewed_at=_TS, reviewed_by=_S, rejection_reason=_S,
)

RUN_METRICS = _struct(
    timestamp=_S,
    stages=T.MapType(_S, _struct(
        input_count=_L, output_count=_L, cluster_count=_L, cluster_sizes=T.ArrayType(_L),
        noise_count=_L, noise_rate=_S, new_trends=_L, merged_trends=_L, saved_count=_L,
    )),
    summary=_struct(
        source_distribution=T.MapType(_S, _L), sentiment=T.MapType(_S, _L),
        risk_level=T.MapType(_S, _L), content_type=T.MapType(_S, _L),
    ),
)
