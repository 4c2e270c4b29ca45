"""Set and trend similarity expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import MatchConfig
from tidemark.functions import times


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two arrays read as sets: both empty 1, exactly one empty 0."""
    left, right = F.coalesce(a, F.array().cast("array<string>")), F.coalesce(
        b, F.array().cast("array<string>"))
    union = F.size(F.array_union(left, right))
    return (
        F.when((F.size(left) == 0) & (F.size(right) == 0), F.lit(1.0))
        .when((F.size(left) == 0) | (F.size(right) == 0), F.lit(0.0))
        .otherwise(F.size(F.array_intersect(left, right)) / union)
    )


def trend_score(topic: Column, keywords: Column, time: Column, source: Column,
                cfg: MatchConfig = MatchConfig()) -> Column:
    """Weighted sum of the four factors."""
    return (topic * cfg.w_topic + keywords * cfg.w_keywords
            + time * cfg.w_time + source * cfg.w_source)


def time_factor(a: Column, b: Column, cfg: MatchConfig = MatchConfig()) -> Column:
    if cfg.time_decay == "constant":
        return F.lit(0.5)
    return times.linear_decay(a, b, cfg.decay_hours)
