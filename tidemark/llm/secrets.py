"""Secrets in all historical versions of texts, with built-in functions only.

An incremental ledger: each version is addressed by the SHA-256 of its content (the blob).  The ledger
holds which rule versions have scanned a blob and what they found.  A run scans only blob and rule
version pairs that the ledger does not have, appends them, and joins the findings back to all paths.
So a content that a third of all paths share is scanned once.

A null content reads as empty.  Null paths, repeated rows and extra columns come through; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.base import count_of, located, scratch_path, spans_digest, spans_text, whole_text


class Rule(NamedTuple):
    """One pattern; a change of the pattern needs a new version."""

    name: str
    pattern: str
    value_group: int = 0
    min_length: int = 1
    version: int = 1

    @property
    def tag(self) -> str:
        return f"{self.name}@{self.version}"


# The base rules in their order, then added ones.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                   r"""([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}+"),
)
ADDED_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("hosted_token", r"(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36,}+"),
    Rule("chat_token", r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{10,}+"),
)
RULES = BASE_RULES + ADDED_RULES

LEDGER = ("blob binary, scanned array<string>, "
          "findings array<struct<kind:string,start:int,end:int,tag:string>>")
_EMPTY = "cast(array() as array<struct<kind:string,start:int,end:int,tag:string>>)"


def _scan(text: Column, rule: Rule) -> Column:
    def strong(span: Column) -> Column:
        value = span["value"]
        part = F.regexp_extract(value, rule.pattern, rule.value_group) if rule.value_group else value
        return F.length(part) >= rule.min_length

    kept = F.filter(located(text, rule.pattern), strong) if rule.min_length > 1 else located(
        text, rule.pattern)
    return F.transform(kept, lambda s: F.struct(
        F.lit(rule.name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        F.lit(rule.tag).alias("tag")))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All entries; a run appends one entry a blob, so a blob may have several."""
    return spark.read.schema(LEDGER).parquet(ledger)


def open_ledger(spark: SparkSession, ledger: str) -> None:
    """Make an empty ledger at a path where there is none."""
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(ledger)


def scan_unseen(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES) -> None:
    """Append what the ledger lacks.  ``versions`` has ``blob`` and ``content``.

    The files of one run become visible together when its job commits.  A run that dies leaves the
    ledger as it was; the next one scans the same pairs.
    """
    spark = versions.sparkSession
    tags = [r.tag for r in rules]
    wanted = F.array(*map(F.lit, tags))
    seen = (read_ledger(spark, ledger).select("blob", F.explode("scanned").alias("tag"))
            .filter(F.col("tag").isin(tags)).groupBy("blob").agg(F.collect_set("tag").alias("seen")))
    blobs = versions.groupBy("blob").agg(F.first("content").alias("content"))
    todo = (blobs.join(seen, "blob", "left")
            .withColumn("todo", F.when(F.col("seen").isNull(), wanted).otherwise(
                F.array_except(wanted, F.coalesce("seen", F.expr("cast(array() as array<string>)")))))
            .filter(F.size("todo") > 0))
    text = F.col("content")
    found = [F.when(F.array_contains("todo", r.tag), _scan(text, r)).otherwise(F.expr(_EMPTY))
             for r in rules]
    (todo.select("blob", F.col("todo").alias("scanned"), F.concat(*found).alias("findings"))
     .write.mode("append").parquet(ledger))


def scan(paths: DataFrame, content: str, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``paths`` with ``blob`` and ``findings`` (by start, then rule order) in place of the content.

    Columns of these two names are replaced, all others come through.
    """
    spark = paths.sparkSession
    open_ledger(spark, ledger)
    kept = [c for c in paths.columns if c.lower() not in (content.lower(), "blob", "findings")]
    row = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.lit(0)
    named = paths.select(row.alias("row"), whole_text(f"`{content}`").alias("content")).withColumn(
        "blob", F.unhex(F.sha2("content", 256)))
    scan_unseen(named.select("blob", "content"), ledger, rules)
    order = F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (r.name, i)))
    current = F.filter("findings", lambda f: f["tag"].isin([r.tag for r in rules]))
    known = (read_ledger(spark, ledger).withColumn("findings", current)
             .filter(F.size("findings") > 0)
             .groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias("findings")))
    ranked = F.array_sort(F.transform("findings", lambda f: F.struct(
        f["start"].alias("start"), order[f["kind"]].alias("rank"), f["end"].alias("end"),
        f["kind"].alias("kind"), f["tag"].alias("tag"))))
    known = known.select("blob", ranked.alias("findings"))
    empty = "cast(array() as array<struct<start:int,rank:int,end:int,kind:string,tag:string>>)"
    return named.drop("content").join(known, "blob", "left").select(
        *[F.col(f"row.`{c}`") for c in kept], "blob", F.coalesce("findings", F.expr(empty)).alias("findings"))


def report(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """Counts per base rule, the digest of the base spans and all spans, a row per document."""
    place = ledger or scratch_path(docs.sparkSession, "ledger")
    found = scan(docs.select("doc_id", "text"), "text", place)
    names = [r.name for r in BASE_RULES]
    base = F.filter("findings", lambda s: s["kind"].isin(names))
    counts = [count_of("findings", k).alias(f"n_{k}")
              for k in names]
    return found.select("doc_id", *counts, spans_digest(base).alias("base_sha256"),
                        spans_text(F.col("findings")).alias("spans"))
