"""Engagement scores and rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weight of one like, comment, share and save.
WEIGHTS = {"likes": 1.0, "comments": 2.0, "shares": 3.0, "collects": 4.0}


def zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def score(likes: Column, comments: Column, shares: Column | None = None,
          collects: Column | None = None) -> Column:
    """Weighted engagement; a missing count weighs nothing."""
    total = zero(likes) * WEIGHTS["likes"] + zero(comments) * WEIGHTS["comments"]
    if shares is not None:
        total = total + zero(shares) * WEIGHTS["shares"]
    if collects is not None:
        total = total + zero(collects) * WEIGHTS["collects"]
    return total


def item_score() -> Column:
    return score(F.col("likes"), F.col("comments"), F.col("shares"), F.col("collects"))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, null when whole is null or 0 (ANSI mode raises on a zero divisor)."""
    return part / F.nullif(whole, F.lit(0))


def engagement_rate(views: Column, likes: Column, comments: Column, shares: Column) -> Column:
    return F.coalesce(ratio(zero(likes) + zero(comments) + zero(shares), views), F.lit(0.0))


def is_quality(rate: Column, minimum: float = 0.01) -> Column:
    return rate >= minimum


def is_viral(shares: Column, views: Column, minimum: float = 0.02) -> Column:
    return F.coalesce(ratio(zero(shares), views) >= minimum, F.lit(False))
