"""Keyword discovery: feed entries to the next table of extracted keywords."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import Settings
from tidemark.operators import annotate, quality, store


def discover(entries: DataFrame, extracted: DataFrame, now, order: str = "ingest_seq",
             cfg: Settings = Settings(), fn: Callable[[str], str] | None = None) -> DataFrame:
    """Titles -> keywords -> replace the pending rows.  Counting reads all titles; a caller's function
    gets as many as fit into one request."""
    titles = quality.headlines(entries.select(order, "title"), order)
    if fn is None:
        found = annotate.extract_keywords(titles, now, cfg.keyword_count)
    else:
        found = annotate.extract_with(titles, now, fn, order, cfg.keyword_count, cfg.request_titles)
    stamp = F.date_format("extracted_at", "yyyyMMddHHmmss")
    rows = found.withColumn("id", F.concat_ws("-", stamp, F.sha2("keyword", 256)))
    return store.replace_pending(extracted, rows)
