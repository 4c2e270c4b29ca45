"""Queries on the keyword lifecycle.  Users of the events table play keywords: user_id % 5 gives the
role (0 active, 1 pending, 2 rejected, 3 and 4 unknown), every event of a type plays a command."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.catalog.base import NOW, joined, query, stamp
from tidemark.operators import keywords as kw
from tidemark.operators import quality, ranking, store
from tidemark.plans import discover
from tidemark.sources import feeds
from tidemark.sources import fixtures as fx

_USERS = """u AS (SELECT user_id, 'kw' || CAST(user_id AS VARCHAR) AS keyword, 'u' || CAST(user_id AS VARCHAR) AS id,
  user_id % 5 AS role, min(ts) AS first_ts, count(*) AS events FROM events GROUP BY user_id)"""


def _users(spark, sf):
    return fx.table(spark, sf, "events").groupBy("user_id").agg(
        F.min("ts").cast("timestamp").alias("first_ts"), F.count(F.lit(1)).alias("events")).select(
        "user_id", "first_ts", "events", (F.col("user_id") % 5).alias("role"),
        F.concat(F.lit("kw"), F.col("user_id").cast("string")).alias("keyword"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("id"))


def _shape(df, schema, **columns):
    return df.select(*[columns.get(f.name, F.col(f.name) if f.name in df.columns else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in schema.fields])


def submissions(spark, sf):
    return _shape(_users(spark, sf).filter("role in (1, 2)"), schemas.SUBMISSION,
                  submitted_by=F.lit("Anonymous"), created_at=F.col("first_ts"),
                  status=F.when(F.col("role") == 1, "pending").otherwise("rejected"))


def active(spark, sf):
    feeds_of = F.when(F.col("user_id") % 2 == 0, F.array(F.lit("tiktok"))).otherwise(
        F.array(F.lit("news"), F.lit("youtube")))
    return _shape(_users(spark, sf).filter("role = 0"), schemas.ACTIVE_KEYWORD, sources=feeds_of,
                  status=F.when(F.col("user_id") % 3 == 0, "paused").otherwise("active"),
                  added_at=F.col("first_ts"), added_by=F.lit("admin"), origin=F.lit("manual"))


def extracted(spark, sf):
    return _shape(_users(spark, sf), schemas.EXTRACTED, category=F.lit("khác"), reason=F.lit("r"),
                  extracted_at=F.col("first_ts"), source=F.lit("news"), num_headlines=F.col("events"),
                  status=F.element_at(F.array(*[F.lit(s) for s in (
                      "approved", "pending", "rejected", "pending", "pending")]),
                      (F.col("role") + 1).cast("int")))


def _commands(spark, sf, kind):
    e = fx.table(spark, sf, "events").filter(F.col("event_type") == kind)
    user = F.col("user_id").cast("string")
    return e.select(F.col("event_id").alias("seq"), "user_id",
                    F.concat(F.lit("u"), user).alias("id"), F.concat(F.lit("kw"), user).alias("keyword"))


def _first_sql(kind):
    return (f"(SELECT user_id, min(event_id) AS seq FROM events WHERE event_type='{kind}' GROUP BY user_id)")


@query("submit_keywords", f"""WITH {_USERS} SELECT 's' || CAST(f.seq AS VARCHAR) AS id, u.keyword,
 CASE WHEN f.seq % 3 = 0 THEN 'Anonymous' ELSE 'user ' || CAST(f.seq AS VARCHAR) END AS submitted_by, 'pending' AS status
FROM u JOIN {_first_sql('click')} f USING (user_id) WHERE role NOT IN (0, 1)""")
def submit_keywords(spark, sf):
    """Every click submits, padded; repeats, pending and active keywords are refused."""
    seq = F.col("seq")
    commands = _commands(spark, sf, "click").select(
        "seq", F.concat(F.lit("s"), seq.cast("string")).alias("id"),
        F.concat(F.lit("\t "), "keyword", F.lit(" ")).alias("keyword"),
        F.lit(None).cast("string").alias("reason"),
        F.when(seq % 3 == 0, "").otherwise(F.concat(F.lit(" user "), seq.cast("string"))).alias("submitted_by"))
    return kw.submit(commands, submissions(spark, sf), active(spark, sf), NOW).select(
        "id", "keyword", "submitted_by", "status")


def _approved(spark, sf):
    commands = _commands(spark, sf, "signup").select(
        "seq", "id", F.array(F.lit("youtube")).alias("sources"),
        F.concat(F.lit("r"), (F.col("seq") % 3).cast("string")).alias("reviewed_by"))
    return kw.approve(commands, submissions(spark, sf), active(spark, sf), NOW)


@query("approve_submissions", f"""WITH {_USERS}, f AS {_first_sql('signup')}
SELECT u.id, CASE WHEN f.seq IS NOT NULL THEN 'approved' WHEN role = 1 THEN 'pending' ELSE 'rejected' END AS status,
 'r' || CAST(f.seq % 3 AS VARCHAR) AS reviewed_by FROM u LEFT JOIN f USING (user_id) WHERE role IN (1, 2)""")
def approve_submissions(spark, sf):
    return _approved(spark, sf)[0].select("id", "status", "reviewed_by")


@query("approve_activates", f"""WITH {_USERS}, f AS {_first_sql('signup')}
SELECT keyword, 'user_submission' AS origin, 'youtube' AS sources FROM u JOIN f USING (user_id) WHERE role IN (1, 2)
UNION ALL SELECT keyword, 'manual', CASE WHEN user_id % 2 = 0 THEN 'tiktok' ELSE 'news,youtube' END FROM u WHERE role = 0""")
def approve_activates(spark, sf):
    return _approved(spark, sf)[1].select("keyword", "origin", joined("sources"))


@query("approve_history", f"""WITH {_USERS}, f AS {_first_sql('signup')}
SELECT keyword, 'approved' AS action, 'r' || CAST(f.seq % 3 AS VARCHAR) AS performed_by, 'youtube' AS sources
FROM u JOIN f USING (user_id) WHERE role IN (1, 2)""")
def approve_history(spark, sf):
    return _approved(spark, sf)[2].select(
        "keyword", "action", "performed_by", F.col("details")["sources"].alias("sources"))


@query("reject_submissions", f"""WITH {_USERS}, f AS {_first_sql('error')}
SELECT u.id, CASE WHEN f.seq IS NOT NULL OR role = 2 THEN 'rejected' ELSE 'pending' END AS status,
 'note ' || CAST(f.seq AS VARCHAR) AS notes FROM u LEFT JOIN f USING (user_id) WHERE role IN (1, 2)""")
def reject_submissions(spark, sf):
    commands = _commands(spark, sf, "error").select(
        "seq", "id", F.concat(F.lit("note "), F.col("seq").cast("string")).alias("note"),
        F.lit("admin").alias("reviewed_by"))
    return kw.reject(commands, submissions(spark, sf), NOW).select("id", "status", "notes")


@query("add_keywords", f"""WITH {_USERS}, f AS {_first_sql('purchase')}
SELECT keyword, 'manual' AS origin, CASE WHEN role = 0 THEN 'admin' ELSE 'a' || CAST(f.seq AS VARCHAR) END AS added_by
FROM u LEFT JOIN f USING (user_id) WHERE role = 0 OR f.seq IS NOT NULL""")
def add_keywords(spark, sf):
    return _added(spark, sf)[0].select("keyword", "origin", "added_by")


@query("add_history", f"""WITH {_USERS}, f AS {_first_sql('purchase')}
SELECT keyword, 'added' AS action, 'a' || CAST(f.seq AS VARCHAR) AS performed_by FROM u JOIN f USING (user_id) WHERE role <> 0""")
def add_history(spark, sf):
    return _added(spark, sf)[1].select("keyword", "action", "performed_by")


def _added(spark, sf):
    commands = _commands(spark, sf, "purchase").select(
        "seq", F.concat("keyword", F.lit("\xa0")).alias("keyword"),
        F.array(F.lit("tiktok")).alias("sources"),
        F.concat(F.lit("a"), F.col("seq").cast("string")).alias("added_by"))
    return kw.add(commands, active(spark, sf), NOW)


# each view renames its user's keyword to that of user_id + 5 * (event_id % 3): an active one (refused),
# itself (no change), or - for the greatest ids - a free one
_RENAMES = f"""{_USERS}, v AS (SELECT event_id AS seq, 'kw' || CAST(user_id AS VARCHAR) AS old_k,
  'kw' || CAST(user_id + 5 * (event_id % 3) AS VARCHAR) || CASE WHEN event_id % 4 = 0 THEN 'x' ELSE '' END AS new_k
  FROM events WHERE event_type='view'),
 ok AS (SELECT * FROM v WHERE old_k <> new_k AND old_k IN (SELECT keyword FROM u WHERE role = 0)
  AND new_k NOT IN (SELECT keyword FROM u WHERE role = 0)),
 one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY old_k ORDER BY seq) AS rn FROM ok) WHERE rn = 1),
 two AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY new_k ORDER BY seq) AS rn2 FROM one) WHERE rn2 = 1)"""


def _renamed(spark, sf):
    e = fx.table(spark, sf, "events").filter("event_type = 'view'")
    target = (F.col("user_id") + 5 * (F.col("event_id") % 3)).cast("string")
    commands = e.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("kw"), F.col("user_id").cast("string")).alias("old_keyword"),
        F.concat(F.lit(" kw"), target, F.when(F.col("event_id") % 4 == 0, "x").otherwise("")).alias("new_keyword"),
        F.lit("admin").alias("updated_by"))
    return kw.rename(commands, active(spark, sf), NOW)


@query("rename_keywords", f"""WITH {_RENAMES} SELECT coalesce(two.new_k, u.keyword) AS keyword,
 CASE WHEN u.user_id % 2 = 0 THEN 'tiktok' ELSE 'news,youtube' END AS sources
FROM u LEFT JOIN two ON two.old_k = u.keyword WHERE role = 0""")
def rename_keywords(spark, sf):
    return _renamed(spark, sf)[0].select("keyword", joined("sources"))


@query("rename_history", f"""WITH {_RENAMES} SELECT new_k AS keyword, 'updated' AS action, old_k AS old_keyword FROM two""")
def rename_history(spark, sf):
    return _renamed(spark, sf)[1].select(
        "keyword", "action", F.col("details")["old_keyword"].alias("old_keyword"))


@query("remove_keywords", f"""WITH {_USERS}, f AS (SELECT user_id, min(event_id) AS seq FROM events WHERE event_type='error' AND value > 200 GROUP BY user_id)
SELECT keyword, f.seq IS NOT NULL AS removed FROM u LEFT JOIN f USING (user_id) WHERE role = 0""")
def remove_keywords(spark, sf):
    strong = fx.table(spark, sf, "events").filter("event_type = 'error' and value > 200")
    commands = strong.select(
        F.col("event_id").alias("seq"), F.concat(F.lit("kw"), F.col("user_id").cast("string")).alias("keyword"),
        F.lit("admin").alias("removed_by"))
    kept, history = kw.remove(commands, active(spark, sf), NOW)
    return kept.select("keyword", F.lit(False).alias("removed")).unionByName(
        history.select("keyword", F.lit(True).alias("removed")))


@query("approve_extracted", f"""WITH {_USERS}, f AS {_first_sql('click')}
SELECT u.id, CASE WHEN f.seq IS NOT NULL THEN 'approved' ELSE (['approved','pending','rejected','pending','pending'])[role + 1] END AS status
FROM u LEFT JOIN f USING (user_id)""")
def approve_extracted(spark, sf):
    return _extracted_approved(spark, sf)[0].select("id", "status")


@query("approve_extracted_adds", f"""WITH {_USERS}, f AS {_first_sql('click')}
SELECT keyword, 'admin' AS added_by, CASE WHEN user_id % 2 = 0 THEN 'tiktok' ELSE 'news,youtube' END AS sources FROM u WHERE role = 0
UNION ALL SELECT keyword, 'admin (extractor)', 'tiktok,news,youtube' FROM u JOIN f USING (user_id) WHERE role <> 0""")
def approve_extracted_adds(spark, sf):
    return _extracted_approved(spark, sf)[1].select("keyword", "added_by", joined("sources"))


def _extracted_approved(spark, sf):
    commands = _commands(spark, sf, "click").select("seq", "id", F.lit("admin").alias("approved_by"))
    return kw.approve_extracted(commands, extracted(spark, sf), active(spark, sf), NOW)


@query("reject_extracted", f"""WITH {_USERS}, f AS {_first_sql('error')}
SELECT u.id, CASE WHEN f.seq IS NOT NULL THEN 'rejected' ELSE (['approved','pending','rejected','pending','pending'])[role + 1] END AS status,
 CASE WHEN f.seq IS NOT NULL THEN 'dull' END AS rejection_reason FROM u LEFT JOIN f USING (user_id)""")
def reject_extracted(spark, sf):
    commands = _commands(spark, sf, "error").select(
        "seq", "id", F.lit("admin").alias("rejected_by"), F.lit("dull").alias("reason"))
    return kw.reject_extracted(commands, extracted(spark, sf), NOW).select("id", "status", "rejection_reason")


_CONFIG = """c AS (SELECT DISTINCT 'kw' || CAST(user_id AS VARCHAR) AS keyword,
  CASE event_type WHEN 'click' THEN 'tiktok' WHEN 'view' THEN 'news' ELSE 'youtube' END AS feed FROM events)"""


def _config(spark, sf):
    kind = F.col("event_type")
    return fx.table(spark, sf, "events").select(
        F.concat(F.lit("kw"), F.col("user_id").cast("string")).alias("keyword"),
        F.when(kind == "click", "tiktok").when(kind == "view", "news").otherwise("youtube").alias("feed"))


@query("import_keywords", f"""WITH {_USERS}, {_CONFIG},
 s AS (SELECT keyword, feed FROM c UNION SELECT keyword, unnest(CASE WHEN user_id % 2 = 0 THEN ['tiktok'] ELSE ['news','youtube'] END)
  FROM u WHERE role = 0)
SELECT s.keyword, string_agg(feed, ',' ORDER BY feed) AS sources,
 CASE WHEN any_value(u.role) = 0 THEN 'admin' ELSE 'migration' END AS added_by FROM s JOIN u USING (keyword) GROUP BY s.keyword""")
def import_keywords(spark, sf):
    """Feeds join a keyword's set, unseen keywords are inserted."""
    out = kw.import_config(_config(spark, sf), active(spark, sf), NOW)
    return out.select("keyword", F.array_join(F.sort_array("sources"), ",").alias("sources"), "added_by")


@query("check_config", f"""WITH {_CONFIG.replace('DISTINCT ', '')} SELECT feed, count(*) AS keywords, count(*) > 0 AS ok FROM c GROUP BY feed""")
def check_config(spark, sf):
    return kw.check_config(_config(spark, sf))


@query("tracked_keywords", f"""WITH {_USERS} SELECT keyword FROM u WHERE role = 0 AND user_id % 3 <> 0 AND user_id % 2 = 0""")
def tracked_keywords(spark, sf):
    return feeds.active_keywords(active(spark, sf), "tiktok").select("keyword")


@query("sorted_keywords", f"""WITH {_USERS} SELECT keyword, strftime(first_ts, '%Y-%m-%d %H:%M:%S') AS added_at FROM u
WHERE role = 0 AND user_id % 3 <> 0""")
def sorted_keywords(spark, sf):
    return kw.sorted_keywords(active(spark, sf)).select("keyword", stamp("added_at"))


@query("pending_queue", f"""WITH {_USERS} SELECT id, keyword FROM u WHERE role = 1 ORDER BY first_ts DESC, id LIMIT 100""")
def pending_queue(spark, sf):
    return ranking.queue(submissions(spark, sf), "pending", 100).select("id", "keyword")


@query("extracted_queue", f"""WITH {_USERS} SELECT id, keyword FROM u ORDER BY first_ts DESC, id LIMIT 50""")
def extracted_queue(spark, sf):
    return ranking.queue(extracted(spark, sf), "all", 50, "extracted_at").select("id", "keyword")


@query("status_filter", f"""WITH {_USERS} SELECT id FROM u WHERE role = 2""")
def status_filter(spark, sf):
    return quality.by_status(extracted(spark, sf), "rejected").select("id")


@query("replace_pending", f"""WITH {_USERS} SELECT keyword, (['approved','pending','rejected','pending','pending'])[role + 1] AS status
FROM u WHERE role IN (0, 2) UNION ALL SELECT 'new ' || keyword, 'pending' FROM u WHERE role = 3""")
def replace_pending(spark, sf):
    new = extracted(spark, sf).filter(F.substring("id", 2, 20).cast("long") % 5 == 3).withColumn(
        "keyword", F.concat(F.lit("new "), "keyword")).withColumn("status", F.lit("pending"))
    return store.replace_pending(extracted(spark, sf), new).select("keyword", "status")


@query("replace_pending_null_status", f"""WITH {_USERS}, old AS (SELECT keyword, role,
 CASE WHEN role <> 4 THEN (['approved','pending','rejected','pending','pending'])[role + 1] END AS status FROM u)
SELECT keyword, status FROM old WHERE status IS NULL OR status <> 'pending' UNION ALL SELECT 'new ' || keyword, 'pending' FROM u WHERE role = 3""")
def replace_pending_null_status(spark, sf):
    """Rows without a status are not pending and stay."""
    role = F.substring("id", 2, 20).cast("long") % 5
    old = extracted(spark, sf).withColumn("status", F.when(role != 4, F.col("status")))
    new = extracted(spark, sf).filter(role == 3).withColumn(
        "keyword", F.concat(F.lit("new "), "keyword")).withColumn("status", F.lit("pending"))
    return store.replace_pending(old, new).select("keyword", "status")


@query("replace_pending_with_nothing", f"""WITH {_USERS} SELECT keyword,
 (['approved','pending','rejected','pending','pending'])[role + 1] AS status FROM u""")
def replace_pending_with_nothing(spark, sf):
    none = extracted(spark, sf).filter("status = 'unheard of'")
    return store.replace_pending(extracted(spark, sf), none).select("keyword", "status")


_PHRASES = """t AS (SELECT doc_id, trim(unnest(string_split(text, chr(10))), chr(9)||chr(13)||' '||chr(160)) AS title FROM documents),
 h AS (SELECT * FROM t WHERE title <> ''),
 w AS (SELECT list_filter(regexp_split_to_array(lower(title), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS t FROM h),
 g AS (SELECT unnest(list_distinct(flatten([
   [array_to_string(t[i:i+1],' ') for i in range(1, len(t))],
   [array_to_string(t[i:i+2],' ') for i in range(1, len(t)-1)],
   [array_to_string(t[i:i+3],' ') for i in range(1, len(t)-2)],
   [array_to_string(t[i:i+4],' ') for i in range(1, len(t)-3)]]))) AS keyword FROM w),
 p AS (SELECT keyword, count(*) AS hits, len(string_split(keyword,' ')) AS size FROM g GROUP BY keyword)"""


@query("headline_keywords", f"""WITH {_PHRASES} SELECT keyword, 'in ' || CAST(hits AS VARCHAR) || ' headlines' AS reason,
 'pending' AS status, (SELECT count(*) FROM h) AS num_headlines FROM p ORDER BY hits DESC, size DESC, keyword LIMIT 30""")
def headline_keywords(spark, sf):
    return _discovered(spark, sf).filter("status = 'pending'").select(
        "keyword", "reason", "status", "num_headlines")


def _discovered(spark, sf):
    """The discovery plan: titles, keywords, swap of the pending rows."""
    from tidemark.catalog.items import _titles

    entries = _titles(spark, sf).withColumnRenamed("doc_id", "ingest_seq")
    return discover.discover(entries, extracted(spark, sf), NOW)


@query("discover_keywords", f"""WITH {_USERS}, {_PHRASES}, best AS (SELECT keyword FROM p ORDER BY hits DESC, size DESC, keyword LIMIT 30)
SELECT keyword, 'pending' AS status FROM best
UNION ALL SELECT keyword, CASE role WHEN 0 THEN 'approved' ELSE 'rejected' END FROM u WHERE role IN (0, 2)""")
def discover_keywords(spark, sf):
    return _discovered(spark, sf).select("keyword", "status")
