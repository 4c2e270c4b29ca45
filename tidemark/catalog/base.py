"""Registry of named queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


def stamp(col: str, out: str | None = None):
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(out or col)


def joined(col: str, out: str | None = None):
    return F.array_join(col, ",").alias(out or col)


WS = (
    "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)"
    "||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)"
    "||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)"
    "||chr(8239)||chr(8287)||chr(12288)"
)

ITEMS = """items AS (
 SELECT d.doc_id AS ingest_seq, CAST(d.doc_id AS VARCHAR) AS content_id,
  CASE WHEN d.doc_id % 3 = 0 THEN 'tiktok' WHEN d.doc_id % 3 = 1 THEN 'youtube'
       ELSE 'vnexpress' END AS source,
  d.text, d.lang AS language, d.lang AS cluster_id, d.source AS channel,
  TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(d.doc_id % 720 AS INTEGER)) AS published_at,
  CASE WHEN d.doc_id % 3 <> 2 THEN (d.doc_id * 7919) % 100000 END AS views,
  CASE WHEN d.doc_id % 3 <> 2 THEN (d.doc_id * 104729) % 5000 END AS likes,
  CASE WHEN d.doc_id % 3 <> 2 THEN (d.doc_id * 1299709) % 800 END AS comments,
  CASE WHEN d.doc_id % 3 = 0 THEN (d.doc_id * 15485863) % 400 END AS shares,
  CASE WHEN d.doc_id % 3 = 0 THEN (d.doc_id * 32452843) % 300 END AS collects,
  CASE WHEN d.doc_id % 3 = 0 THEN (d.doc_id * 49979687) % 5000 END AS author_followers,
  'a' || CAST(d.doc_id % 97 AS VARCHAR) AS author_name
 FROM documents d)"""

SCORED = ITEMS + """, scored AS (
 SELECT *, coalesce(likes,0)*1.0::DOUBLE + coalesce(comments,0)*2.0::DOUBLE
   + coalesce(shares,0)*3.0::DOUBLE + coalesce(collects,0)*4.0::DOUBLE AS score FROM items)"""

CHECKED = ITEMS + f""", checked AS (
 SELECT *, length(trim(coalesce(text,''), {WS})) >= 10 AS ok_clean,
  CASE WHEN source='tiktok' THEN
    CASE WHEN views <> 0 AND views < 500 THEN 'views'
         WHEN views > 0 AND (coalesce(likes,0)+coalesce(comments,0)+coalesce(shares,0))/views::DOUBLE < 0.001
           THEN 'engagement'
         WHEN author_followers <> 0 AND author_followers < 100 THEN 'followers'
         WHEN views > 0 AND coalesce(collects,0)/views::DOUBLE < 0.0001 THEN 'saves' END
   WHEN source='youtube' THEN
    CASE WHEN views <> 0 AND views < 500 THEN 'views'
         WHEN views > 0 AND (coalesce(likes,0)+coalesce(comments,0))/views::DOUBLE < 0.001
           THEN 'engagement' END
  END AS reason FROM items)"""

MEMBERS = ITEMS + """, members AS (
 SELECT *, 50 * (ingest_seq // 1000) + ingest_seq % 50 AS g,
  CASE WHEN (ingest_seq // 500) % 2 = 0 THEN 's' ELSE 'n' END AS side,
  (CASE WHEN (ingest_seq // 500) % 2 = 0 THEN 's' ELSE 'n' END) || '-' || language || '-'
    || CAST(50 * (ingest_seq // 1000) + ingest_seq % 50 AS VARCHAR) AS trend_id FROM items)"""

TRENDS = MEMBERS + """, trends AS (
 SELECT trend_id, any_value(side) AS side, any_value(language) AS language, any_value(g) AS g,
  count(*) AS video_count, CAST(sum(coalesce(views,0)) AS BIGINT) AS total_views,
  CAST(sum(coalesce(likes,0)) AS BIGINT) AS total_likes, max(published_at) AS ts,
  list_sort(list(DISTINCT channel)) AS keywords,
  list_sort(list(DISTINCT source)) AS sources,
  'Topic ' || any_value(language) || ' ' || CAST(any_value(g) AS VARCHAR) AS topic,
  'About ' || trend_id AS summary,
  (['positive','negative','neutral'])[any_value(g) % 3 + 1] AS sentiment,
  (['entertainment','drama','dangerous','social_issue','commercial'])[any_value(g) % 5 + 1]
    AS content_type,
  (['safe','cautious','high_risk','dangerous'])[any_value(g) % 4 + 1] AS risk_level
 FROM members GROUP BY trend_id)"""

VECTORS = TRENDS + """, parts AS (
 SELECT m.trend_id, generate_subscripts(e.embedding, 1) AS pos, unnest(e.embedding::DOUBLE[]) AS x
 FROM members m JOIN embeddings e ON e.vec_id = m.ingest_seq % (SELECT count(*) FROM embeddings)),
 means AS (SELECT trend_id, pos, avg(x) AS x FROM parts GROUP BY trend_id, pos),
 vectors AS (SELECT trend_id, list(x ORDER BY pos) AS vector FROM means GROUP BY trend_id)"""

NOW = "2024-01-31 00:00:00"
