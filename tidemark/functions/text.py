"""Text expressions.  All are built-in column functions, so they stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every character a Unicode-aware strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(col: Column) -> Column:
    """``trim`` alone leaves tabs, line ends and non-breaking blanks in place."""
    return F.btrim(col, F.lit(WHITESPACE))


def blank(col: Column) -> Column:
    """True for null and for the empty string."""
    return F.coalesce(col, F.lit("")) == ""


def cut(col: Column, n: int) -> Column:
    """First ``n`` code points."""
    return F.substring(col, 1, n)


def contains_ci(text: Column, needle: Column) -> Column:
    return F.contains(F.lower(text), F.lower(needle))


def scrub(col: Column) -> Column:
    """Optional text scrub: markup, links, mentions, repeated blanks.  Off by default."""
    out = F.regexp_replace(col, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    out = F.regexp_replace(out, r"(?s)<!--.*?-->", " ")
    out = F.regexp_replace(out, r"<[^>]*>", " ")
    out = F.regexp_replace(out, r"https?://[^\s]+", " ")
    out = F.regexp_replace(out, r"@[A-Za-z0-9_.]+", " ")
    out = F.regexp_replace(out, r"\s+", " ")
    return strip(out)


def pieces(col: Column) -> Column:
    """Text cut at everything that is no letter or digit of any script; may hold empty strings."""
    return F.split(F.lower(col), r"[^\p{L}\p{N}]+")


def tokens(col: Column) -> Column:
    """Lower-case word tokens."""
    return F.array_remove(pieces(col), "")


def embedding_input(text: Column, hashtags: Column) -> Column:
    return F.concat(text, F.lit(" "), F.array_join(hashtags, " "))
