"""Serving queries over the trend table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators import ranking, rollup


def overview(trends: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Totals and sentiment counts."""
    return rollup.trend_totals(trends), rollup.count_by(trends, "sentiment")


def board(trends: DataFrame, limit: int = 100, sentiments=None, risks=None,
          types=None) -> tuple[DataFrame, DataFrame]:
    """The filtered listing and its top-10 chart."""
    listed = ranking.listing(trends, limit, sentiments, risks, types)
    return listed, ranking.top_chart(listed, 10)
