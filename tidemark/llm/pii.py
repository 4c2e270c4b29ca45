"""Personal data in texts, with built-in functions only.

Regular expressions propose spans, checksums and range rules confirm them (Luhn for cards, mod 97 for
IBANs, 255 for address parts, digit counts for phones), and words nearby raise or lower the score.
Spans of the base kinds (email, ip, card, phone) stay whatever their score; spans of the added kinds
need ``MIN_SCORE``.

Nulls and empty texts have no span.  Rows are mapped one by one: repeated rows, null ids and extra
columns come through as they are.  A text of any length is searched whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import count_of, located, spans_digest, spans_text, whole_text

# The kinds in their order, their patterns (look-behinds and possessive counts change no
# match; they keep long runs linear), and the prior score of a confirmed span.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "national_id")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.85, "phone": 0.7, "iban": 0.85, "national_id": 0.3}
# Words that speak for a kind or against any.
CONTEXT = {
    "email": r"\b(?:e-?mail|contact|write|correo|courriel)\b",
    "ip": r"\b(?:ip|host|server|address|login)\b",
    "card": r"\b(?:card|visa|credit|debit|karte|carte|tarjeta|payment)\b",
    "phone": r"\b(?:phone|tel|call|mobile|fax|telefon)\b",
    "iban": r"\b(?:iban|bank|account|konto|compte|cuenta)\b",
    "national_id": r"\b(?:ssn|social security|national id|tax id)\b",
}
AGAINST = r"\b(?:version|isbn|serial|part no|build|sample)\b"
BEFORE, AFTER, LIFT, DROP, MIN_SCORE = 48, 24, 0.3, 0.2, 0.5

_EMPTY = "cast(array() as array<struct<kind:string,start:int,end:int,value:string,score:double>>)"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    backwards = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = backwards.substr(i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return (F.length(digits) > 0) & (total % 10 == 0)


def mod97(value: Column) -> Column:
    """Whether an account number (spaces allowed) leaves 1 when divided by 97."""
    flat = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(flat.substr(F.lit(5), F.length(flat)), flat.substr(F.lit(1), F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(turned.substr(i, F.lit(1)))
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.rlike(
            "^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    if kind == "iban":
        return mod97(value)
    return F.lit(True)


def scored(text: Column, kind: str) -> Column:
    """Confirmed spans of one kind, each with its score."""

    def judge(span: Column) -> Column:
        at = F.greatest(span["start"] - BEFORE, F.lit(0))
        before = text.substr(at + 1, span["start"] - at)
        after = text.substr(span["end"] + 1, F.lit(AFTER))
        near = F.lower(F.concat_ws(" ", before, after))
        score = (F.lit(PRIOR[kind]) + F.when(near.rlike(CONTEXT[kind]), LIFT).otherwise(0.0)
                 - F.when(near.rlike(AGAINST), DROP).otherwise(0.0))
        return F.struct(F.lit(kind).alias("kind"), span["start"].alias("start"),
                        span["end"].alias("end"), span["value"].alias("value"),
                        F.least(F.lit(1.0), score).alias("score"))

    kept = F.filter(located(text, PATTERNS[kind]), lambda s: confirmed(kind, s["value"]))
    spans = F.transform(kept, judge)
    return spans if kind in BASE_KINDS else F.filter(spans, lambda s: s["score"] >= MIN_SCORE)


def find(docs: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with ``out``: array of (kind, start, end, value, score), by kind then start."""
    body = whole_text(text)
    return docs.withColumn(out, F.concat(
        F.expr(_EMPTY), *(scored(body, kind) for kind in BASE_KINDS + ADDED_KINDS)))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets.

    Overlapping spans become one, named after the first.  A null text stays null, a text without a span
    stays as it is.
    """
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("body"))
    found = find(own, "body", "spans").withColumn("spans", F.array_sort(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))))
    body = F.col("body")
    zero = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["pos"]
        piece = F.concat(body.substr(acc["pos"] + 1, s["start"] - acc["pos"]),
                         F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"),
                        F.when(fresh, F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate("spans", zero, step, lambda acc: F.concat(
        acc["out"], body.substr(acc["pos"] + 1, F.length(body))))
    masked = F.when(F.size("spans") > 0, clean).otherwise(body)
    return found.select(*[masked.alias(c) if c.lower() == text.lower() else F.col(f"row.`{c}`") for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """Counts per base kind, the digest of the base spans and all spans, a row per document."""
    found = find(docs.select("doc_id", "text")).drop("text")
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))
    counts = [count_of("pii", k).alias(f"n_{k}")
              for k in BASE_KINDS]
    return found.select("doc_id", *counts, spans_digest(base).alias("base_sha256"),
                        spans_text(F.col("pii")).alias("spans"))
