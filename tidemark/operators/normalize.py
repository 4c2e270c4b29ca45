"""Payload records to the unified content item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import text as tx
from tidemark.functions import times


def _str(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _strings(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast("array<string>"))


def _as_item(df: DataFrame, columns: dict[str, Column], carry: tuple[str, ...]) -> DataFrame:
    """Project to the item layout; fields a source lacks become typed nulls."""
    out = [columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
           for f in schemas.ITEM.fields]
    return df.select(*out, *carry)


def _short_video(now) -> dict[str, Column]:
    return {
        "content_id": _str("video_id"), "source": F.lit("tiktok"), "collected_at": times.clock(now),
        "text": _str("text"), "url": F.col("video_url"), "hashtags": _strings("hashtags"),
        "published_at": times.iso(F.col("timestamp")),
        "views": F.col("views"), "likes": F.col("likes"), "comments": F.col("comments"),
        "shares": F.col("shares"), "author_name": F.col("author_username"),
        "author_followers": F.col("author_fans"), "collects": F.coalesce("collects", F.lit(0)),
        "author_verified": F.col("author_verified"), "language": F.col("language"),
    }


def _article(now) -> dict[str, Column]:
    return {
        "content_id": _str("article_id"), "source": F.lit("vnexpress"),
        "collected_at": times.clock(now),
        "text": tx.strip(F.concat(_str("title"), F.lit(". "), _str("summary"))),
        "url": F.col("url"), "hashtags": F.array().cast("array<string>"),
        "published_at": times.iso(F.col("published_at")),
        "author_name": F.coalesce("author", F.lit("VNExpress")),
        "category": F.col("category"), "thumbnail": F.col("thumbnail"),
    }


def _long_video(now) -> dict[str, Column]:
    return {
        "content_id": _str("video_id"), "source": F.lit("youtube"),
        "collected_at": times.clock(now),
        "text": tx.strip(F.concat(_str("title"), F.lit(". "), _str("description"))),
        "url": F.col("url"), "hashtags": _strings("tags"),
        "published_at": times.iso(F.col("published_at")),
        "views": F.col("views"), "likes": F.col("likes"), "comments": F.col("comments"),
        "author_name": F.col("channel_name"), "channel_id": F.col("channel_id"),
        "duration_seconds": F.col("duration_seconds"), "thumbnail": F.col("thumbnail"),
        "category": F.col("category"),
    }


_MAPPINGS = {"tiktok": _short_video, "vnexpress": _article, "youtube": _long_video}


def from_short_video(df: DataFrame, now, carry: tuple[str, ...] = ()) -> DataFrame:
    return _as_item(df, _short_video(now), carry)


def from_article(df: DataFrame, now, carry: tuple[str, ...] = ()) -> DataFrame:
    """Articles have no counts and no hashtags."""
    return _as_item(df, _article(now), carry)


def from_long_video(df: DataFrame, now, carry: tuple[str, ...] = ()) -> DataFrame:
    """Long videos have no share count and no follower count."""
    return _as_item(df, _long_video(now), carry)


def detect_source(payload: Column) -> Column:
    """Which record kind a JSON payload is, by the keys it has; null when unknown."""
    keys = F.json_object_keys(payload)

    def has(key: str) -> Column:
        return F.coalesce(F.array_contains(keys, key), F.lit(False))

    return (
        F.when(has("video_id") & has("author_fans"), F.lit("tiktok"))
        .when(has("article_id"), F.lit("vnexpress"))
        .when(has("channel_id"), F.lit("youtube"))
    )


def _any_payload() -> T.StructType:
    """All fields of the three payload layouts; fields of one name have one type."""
    fields = {f.name: f for kind in _MAPPINGS for f in schemas.PAYLOADS[kind].fields}
    return T.StructType(list(fields.values()))


def normalize(df: DataFrame, payload: str, now,
              carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Mixed JSON payloads to items.  Returns (items, payloads of unknown shape).

    One pass: each payload is read once with the fields of all layouts and mapped by its kind.
    """
    tagged = df.withColumn("_kind", detect_source(F.col(payload)))
    parsed = tagged.filter(F.col("_kind").isNotNull()).select(
        *carry, "_kind", F.from_json(payload, _any_payload()).alias("_p")).select(
        *carry, "_kind", "_p.*")
    mapped = {kind: mapping(now) for kind, mapping in _MAPPINGS.items()}
    columns = {}
    for field in schemas.ITEM.fields:
        cases = F
        for kind, mapping in mapped.items():
            value = mapping.get(field.name, F.lit(None)).cast(field.dataType)
            cases = cases.when(F.col("_kind") == kind, value)
        columns[field.name] = cases
    return _as_item(parsed, columns, carry), tagged.filter(F.col("_kind").isNull()).drop("_kind")


def route(source: Column) -> Column:
    """Record kind by declared source name; an unknown name is an error."""
    known = F.col("source") if source is None else source
    return F.when(known.isin(*schemas.PAYLOADS), known).otherwise(
        F.raise_error(F.concat(F.lit("Unknown source: "), F.coalesce(known, F.lit("null"))))
        .cast("string"))


def _default(value, kind: T.DataType) -> Column:
    if isinstance(value, list):
        return F.array().cast(kind)
    return F.lit(value).cast(kind)


def apply_defaults(payload: Column, source: str) -> Column:
    """Typed payload in which an *absent* key takes its default; a null stays null."""
    schema, defaults = schemas.PAYLOADS[source], schemas.DEFAULTS[source]
    keys, parsed = F.json_object_keys(payload), F.from_json(payload, schema)
    fields = []
    for field in schema.fields:
        value = parsed[field.name]
        if field.name in defaults:
            present = F.coalesce(F.array_contains(keys, field.name), F.lit(False))
            value = F.when(present, value).otherwise(_default(defaults[field.name], field.dataType))
        fields.append(value.alias(field.name))
    return F.struct(*fields)


def typed(payload: Column, source: Column) -> Column:
    """The payload as the record its declared source has: a struct with one member a layout, of which one is set.

    Absent keys take their defaults.  An unknown or missing source is an error.
    """
    kind = route(source)
    return F.struct(*[F.when(kind == name, apply_defaults(payload, name)).alias(name) for name in schemas.PAYLOADS])


def sample(max_chars: int = 500) -> Column:
    """The eight fields kept of a sample item."""
    return F.struct(
        "content_id", "source", tx.cut(F.col("text"), max_chars).alias("text"), "url",
        "views", "likes", "comments", "author_name")


def embedding_text() -> Column:
    return tx.embedding_input(F.col("text"), F.col("hashtags"))


# Display names.
SOURCE_LABELS = {
    "tiktok": "TikTok", "vnexpress": "VNExpress", "youtube": "YouTube",
    "google_trends": "Google Trends",
}
SAMPLE_SOURCE_LABELS = {
    "tiktok": "TikTok", "vnexpress": "Tin tức", "youtube": "YouTube", "google_trends": "Tìm kiếm",
}


def label(col: Column, names: dict[str, str], other: Column | None = None) -> Column:
    """Display name of a code; a constant map, so no join is needed."""
    pairs = [F.lit(part) for pair in names.items() for part in pair]
    found = F.element_at(F.create_map(*pairs), col)
    return F.coalesce(found, col if other is None else other)


# Display names of the facets.
TYPE_LABELS = {
    "entertainment": "Giải trí", "drama": "Drama", "dangerous": "Nguy hiểm",
    "social_issue": "Vấn đề XH", "commercial": "Thương mại",
}
RISK_LABELS = {
    "safe": "An toàn", "cautious": "Cẩn trọng", "high_risk": "Rủi ro cao", "dangerous": "Nguy hiểm",
}
