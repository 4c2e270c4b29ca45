"""The registered query of each operator, and its SQL twin where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    audit, bpe, decontaminate, lm, periodic, pii, secrets, shards, simhash, substrings, topk, toxicity, warc)
from tidemark.llm.base import table

ORACLES: dict[str, str] = {}
VOCABULARY = "byte_bpe_50k.json"


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(table(spark, sf_dir, "documents"))


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.report(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.report(table(spark, sf_dir, "embeddings"))


def op11_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.report(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = ("regexp_extract_all(" + _LOWER.format("coalesce(text, '')")
               + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

ORACLES["op2_decontaminate"] = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS} AS w FROM benchmark),
bm AS (SELECT item, w, least(13, len(w)) AS m FROM b WHERE len(w) > 0),
bi AS (SELECT item, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM bm),
bw AS (SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS win FROM bi),
dm AS (SELECT doc_id, w, m FROM d, (SELECT DISTINCT m FROM bw) WHERE len(w) >= m),
di AS (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i FROM dm),
dw AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS win FROM di),
hit AS (SELECT doc_id, m, i, item FROM dw JOIN bw USING (m, win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS p FROM hit) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (
    SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(covered.n, 0) AS n_hit,
    coalesce(listed.n, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)"""

ORACLES["op5_substrings"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d WHERE len(w) >= 50),
n AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k FROM s),
f AS (SELECT k, min(doc_id) AS m FROM n GROUP BY k HAVING min(doc_id) < max(doc_id)),
c AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p FROM n JOIN f USING (k) WHERE doc_id > m),
t AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d),
r AS (SELECT doc_id, count(c.p) AS gone, string_agg(word, ' ' ORDER BY p) FILTER (c.p IS NULL) AS kept
    FROM t LEFT JOIN c USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(gone, 0) AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)"""

ORACLES["op8_warc"] = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n,
    sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h, n) AS first FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
        (CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS BIGINT), 5) AS INTEGER)
         >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS BIGINT) + 1, 1)), '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM f"""

ORACLES["op10_topk"] = """
WITH v AS (SELECT vec_id, list_transform(embedding,
        lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_sum(list_transform(
        list_zip(q.e, v.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (
    PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5"""




def _scrambled_sql(cell: str, source: str) -> str:
    """Rounds of the permutation over ``cell`` of ``source``, one sub-query a round."""
    sql = f"SELECT num, n, hh, ww, {cell} // ww AS l, {cell} % ww AS r FROM {source}"
    for i in range(shards.ROUNDS):
        half, modulus, other = ("r", "hh", "l") if i % 2 == 0 else ("l", "ww", "r")
        moved = (f"({other} + CAST('0x' || substr(md5('{shards.KEY}:{i}:' || CAST({half} AS VARCHAR)), 1, 15) AS BIGINT)"
                 f" % {modulus}) % {modulus} AS {other}")
        sql = f"SELECT num, n, hh, ww, {moved}, {half} FROM ({sql})"
    return f"SELECT num, n, hh, ww, l * ww + r AS cell FROM ({sql})"


ORACLES["op11_shards"] = f"""
WITH RECURSIVE crc_table AS (SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i))),
raw AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS size, hex(encode(coalesce(text, ''))) AS x,
    sha256(coalesce(text, '')) AS digest FROM documents),
summed AS (SELECT doc_id, digest, CAST(size + {shards.ROW_BYTES} AS BIGINT) AS size, CAST(xor(list_reduce(
    list_concat([4294967295], list_transform(range(size), lambda i:
        CAST('0x' || substr(x, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
    lambda a, v: xor(a >> 8, tab[(xor(a, v) & 255) + 1])), 4294967295) AS BIGINT) AS text_crc32 FROM raw, crc_table),
numbered AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, digest) - 1 AS num FROM summed),
sides AS (SELECT n, ww, CAST(ceil(n / ww) AS BIGINT) AS hh FROM (
    SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS ww FROM documents)),
walk AS (
    ({_scrambled_sql("num", "(SELECT num, n, hh, ww FROM numbered, sides)")})
    UNION ALL ({_scrambled_sql("cell", "walk WHERE cell >= n")}))
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(cell % {shards.SHARDS} AS INTEGER) AS shard,
    cell // {shards.SHARDS} AS slot, CAST(NULL AS INTEGER) AS grown_shard, num AS row_number
FROM numbered JOIN walk USING (num) WHERE cell < n"""

ORACLES["op13_filter_audit"] = r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents),
e AS (SELECT text, min(doc_id) AS first FROM w GROUP BY text),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
    max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, list_filter([
    CASE WHEN len(w) < 200 THEN 'A' END,
    CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
    CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' END,
    CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
    CASE WHEN w.doc_id > first THEN 'E' END], lambda x: x IS NOT NULL) AS bad
    FROM w JOIN e USING (text) LEFT JOIN l USING (doc_id)),
c AS (SELECT part, bad, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
k AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
o AS (SELECT a.k || b.k || c.k || d.k || e.k AS filter_order FROM k AS a, k AS b, k AS c, k AS d, k AS e
    WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS letter, string_split(filter_order[1:step - 1], '') AS earlier
    FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT part, filter_order, step, letter,
    sum(n) FILTER (NOT list_has_any(bad, earlier) AND NOT list_contains(bad, letter)) AS kept,
    sum(n) FILTER (NOT list_has_any(bad, earlier) AND list_contains(bad, letter)) AS removed,
    sum(n) FILTER (list_has_any(bad, earlier) AND list_contains(bad, letter)) AS redundant,
    sum(n) FILTER (bad = [letter]) AS unique_fails,
    sum(good) FILTER (NOT list_has_any(bad, earlier) AND list_contains(bad, letter)) AS good_lost,
    sum(toxic) FILTER (NOT list_has_any(bad, earlier) AND list_contains(bad, letter)) AS toxic_lost
    FROM c, s GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
    CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
    CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
    CAST(coalesce(sum(removed) OVER (PARTITION BY part, letter), 0) AS BIGINT) AS shapley
FROM r"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_bpe, op2_decontaminate, op3_pii, op4_toxicity, op5_substrings, op6_lm, op7_secret_scan, op8_warc, op9_simhash, op10_topk,
        op11_shards, op12_periodic_runs, op13_filter_audit)}


def oracles() -> dict[str, str]:
    return dict(ORACLES)
