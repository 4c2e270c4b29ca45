"""How filters of a cleaning chain interact: what each removes in every order they could run in.

Each document becomes a mask of the filters it fails, in the scan.  Documents fall into cells of (part, mask) with their
count and how many of them are labelled good or toxic; there are at most 32 cells a part.  Each cell then folds across
the array of all 120 orders, which stands in the plan as a constant: ``transform`` goes through the orders,
``aggregate`` through the letters of one, with what became of the cell so far as its state.  That gives 600 structs a
cell, weighted by its counts; the cells of a part are merged by elementwise sums.  Nothing is read once an order.

Filter E asks for the smallest id of each text.  Texts meet as SHA-256 digests in an aggregate with a map-side half, and the
winner is joined back by digest and id together, so a text that a third of all rows repeat is no hot key.

A null text is empty: it fails A only, and E if a smaller id's text is empty too.  A null id is no id: such a row neither
fails E nor makes others fail.  Rows that repeat an id with one text do not fail E by each other.  A null source is
the empty one.  Of several labels for one id, one that says 1 is enough; labels without a document do nothing.
Only the named columns are read, so further ones cannot clash.  No documents give no rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import whole_text

FILTERS = "ABCDE"
#: A text passes with so many words, this share of different words, at most this share of capitals.
LEAST_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT = 200, 50, 2
ODD_CHARACTERS = "[#$%&*|]"
SPACE = "[\\x20\\x09-\\x0D]+"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")

_STEP = "struct<filter_order:string,step:int,letter:string," + ",".join(f"{c}:bigint" for c in COUNTS) + ">"


def orders() -> list[str]:
    return ["".join(p) for p in permutations(FILTERS)]


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, mask of the filters A to D) of each document."""
    text = whole_text()
    rows = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"),
                       F.array_remove(F.split(text, SPACE, -1), "").alias("words"))
    sized = rows.select("doc_id", "part", "text", F.size("words").cast("long").alias("n"),
                        F.size(F.array_distinct("words")).cast("long").alias("different"))
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long")
    fails = {"A": F.col("n") < LEAST_WORDS, "B": 100 * F.col("different") < DISTINCT_PERCENT * F.col("n"),
             "C": 100 * capitals > CAPITALS_PERCENT * F.length("text").cast("long"), "D": F.col("text").rlike(ODD_CHARACTERS)}
    mask = sum((F.when(c, _bit(k)).otherwise(0) for k, c in fails.items()), F.lit(0))
    return sized.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters they fail."""
    rows = failures(docs).groupBy("digest", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).filter("doc_id IS NOT NULL").select(
        "digest", "doc_id", F.lit(True).alias("first"))
    marked = rows.join(first, ["digest", "doc_id"], "left").select(
        "doc_id", "part", "n", (F.col("mask") + F.when(
            F.col("doc_id").isNotNull() & F.col("first").isNull(), _bit("E")).otherwise(0)).alias("mask"))
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    return marked.join(known, "doc_id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))


def _fold(cell: Column, all_orders: Column) -> Column:
    """The 600 structs of one cell."""
    def letter_of(order: Column, i: Column) -> Column:
        return F.substring(order, i, F.lit(1))

    def follow(order: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            letter = letter_of(order, i)
            bit = F.shiftleft(F.lit(1), 0) * F.element_at(
                F.create_map(*[x for f in FILTERS for x in (F.lit(f), F.lit(_bit(f)))]), letter)
            fails = cell["mask"].bitwiseAND(bit) != 0
            gone, zero = state["gone"], F.lit(0).cast("long")
            here = fails & ~gone
            row = F.struct(
                order.alias("filter_order"), i.alias("step"), letter.alias("letter"),
                F.when(~gone & ~fails, cell["n"]).otherwise(zero).alias("kept"),
                F.when(here, cell["n"]).otherwise(zero).alias("removed"),
                F.when(fails & gone, cell["n"]).otherwise(zero).alias("redundant"),
                F.when(cell["mask"] == bit, cell["n"]).otherwise(zero).alias("unique_fails"),
                F.when(here, cell["good"]).otherwise(zero).alias("good_lost"),
                F.when(here, cell["toxic"]).otherwise(zero).alias("toxic_lost"))
            return F.struct((gone | fails).alias("gone"),
                            F.concat(state["rows"], F.array(row)).cast(f"array<{_STEP}>").alias("rows"))

        start = F.struct(F.lit(False).alias("gone"), F.expr(f"cast(array() as array<{_STEP}>)").alias("rows"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(len(FILTERS))), start, step, lambda s: s["rows"])

    return F.flatten(F.transform(all_orders, follow))


def _added(a: Column, b: Column) -> Column:
    """Elementwise sums of two arrays of 600 structs."""
    return F.zip_with(a, b, lambda x, y: F.struct(
        x["filter_order"].alias("filter_order"), x["step"].alias("step"), x["letter"].alias("letter"),
        *[(x[c] + y[c]).alias(c) for c in COUNTS]).cast(_STEP))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step."""
    all_orders = F.array(*[F.lit(o) for o in orders()])
    # at most 32 cells a part, so the list is bounded
    parts = cells(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    nothing = F.struct(F.lit(0).alias("mask"), *[F.lit(0).cast("long").alias(c) for c in ("n", "good", "toxic")])
    merged = parts.select("part", F.aggregate(
        "cells", _fold(nothing, all_orders), lambda total, cell: _added(total, _fold(cell, all_orders))).alias("rows"))
    letters = F.array(*[F.lit(f) for f in FILTERS])
    shares = F.map_from_arrays(letters, F.transform(letters, lambda f: F.aggregate(
        "rows", F.lit(0).cast("long"), lambda s, r: s + F.when(r["letter"] == f, r["removed"]).otherwise(F.lit(0).cast("long")))))
    return merged.select("part", "rows", shares.alias("shares")).select(
        "part", "shares", F.explode("rows").alias("row")).select(
        "part", "row.filter_order", "row.step", *[f"row.{c}" for c in COUNTS],
        F.element_at("shares", F.col("row.letter")).alias("shapley"))
