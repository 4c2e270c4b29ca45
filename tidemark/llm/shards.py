"""Reproducible shuffle of all rows into shards by a Feistel permutation of their row numbers.

Rows get global numbers 0..n-1 in the order of id, text digest and a hash of the whole row, so the numbers do not
depend on files or partitions.  The permutation works on pairs (left, right) of a rectangle with at least n cells and
less than a row of them to spare: rounds add keyed digests of one half to the other, which is one to one, and a number that
lands on a spare cell is sent through again until it lands below n (cycle walking).  With p the permuted number,
the shard is p modulo the number of shards and the slot is p divided by it, so counts differ by one at most, slots
have no gaps, and anyone who knows n and a row's number can compute its place (``place``).

How often the walk must be repeated at most is not guessed: the spare cells, fewer than the square root of n, are walked
beforehand until none is left.  Numbers come from one range-partitioned sort of slim rows, written once, plus what
the partitions before hold; rows equal in all that are split by their place in the scan, so a hot group of copies
is no hot partition.  Only built-in functions run.

A null id comes first, a null text is empty (size 8), repeated rows get different places, no rows give no rows.
Columns named ``row_number``, ``shard`` or ``slot`` are replaced, all others come through.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.base import cut, whole_text

SHARDS = 24
ROUNDS = 8
KEY = "corpus-shuffle-1"
#: Bytes that a row takes beside its text.
ROW_BYTES = 8

_LOCAL = (1 << 33) - 1  # monotonically_increasing_id: partition above, row below


def sides(n: int) -> tuple[int, int]:
    """Height and width of the smallest near-square rectangle that holds n cells."""
    width = max(1, int(n ** 0.5))
    while width * width < n:
        width += 1
    return max(1, -(-n // width)), width


def _digest(round_no: Column, half: Column, key: str, modulus: int) -> Column:
    """A keyed digest of a half, below the modulus (60 bits of MD5, which other engines have too)."""
    text = F.concat_ws(":", F.lit(key), round_no.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % F.lit(modulus)


def scrambled(number: Column, n: int, key: str = KEY, rounds: int = ROUNDS) -> Column:
    """One pass of all rounds over a cell number of the rectangle."""
    height, width = sides(n)

    def step(halves: Column, i: Column) -> Column:
        left, right = halves["left"], halves["right"]
        return F.when(i % 2 == 0, F.struct(
            ((left + _digest(i, right, key, height)) % F.lit(height)).alias("left"), right.alias("right"))).otherwise(
            F.struct(left.alias("left"), ((right + _digest(i, left, key, width)) % F.lit(width)).alias("right")))

    start = F.struct(F.floor(number / F.lit(width)).cast("long").alias("left"), (number % F.lit(width)).alias("right"))
    if n > 1 << 52:  # division of longs goes through doubles
        raise ValueError("row numbers beyond 2^52")
    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, step,
                       lambda h: h["left"] * F.lit(width) + h["right"])


def walks(spark: SparkSession, n: int, key: str = KEY, rounds: int = ROUNDS) -> int:
    """How many passes any number below n needs at most."""
    height, width = sides(n)
    passes, left = 1, height * width - n
    cells = spark.range(n, height * width).select(F.col("id").alias("cell"))
    while n and left:
        cells = cut(cells.select(scrambled(F.col("cell"), n, key, rounds).alias("cell")).filter(F.col("cell") >= n))
        passes, before, left = passes + 1, left, cells.count()
        if left == before:  # the rest go round among themselves, no number below n enters there
            break
    return passes


def permuted(number: Column, n: int, passes: int, key: str = KEY, rounds: int = ROUNDS) -> Column:
    """The number's image among 0..n-1."""
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(passes)), number.cast("long"),
        lambda at, i: F.when((i == 1) | (at >= n), scrambled(at, n, key, rounds)).otherwise(at))


def place(number: int, n: int, shards: int = SHARDS, key: str = KEY, rounds: int = ROUNDS) -> tuple[int, int]:
    """Shard and slot of one row number, without Spark."""
    height, width = sides(n)
    while True:
        left, right = divmod(number, width)
        for i in range(rounds):
            half, modulus = (right, height) if i % 2 == 0 else (left, width)
            add = int(hashlib.md5(f"{key}:{i}:{half}".encode()).hexdigest()[:15], 16) % modulus
            left, right = ((left + add) % height, right) if i % 2 == 0 else (left, (right + add) % width)
        number = left * width + right
        if number < n:
            return number % shards, number // shards


def _digest_of(text: Column) -> Column:
    """128 bits, since sampled keys go to the driver for the ranges."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _numbered(rows: DataFrame, order: list[Column]) -> tuple[DataFrame, int]:
    """(row, number) for a table of (row, ...), and how many there are."""
    order = [*order, F.monotonically_increasing_id()]
    keyed = rows.select("row", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)]).alias("key"))
    spread = keyed.repartitionByRange("key").sortWithinPartitions("key")
    placed = cut(spread.select("row", F.monotonically_increasing_id().alias("mono")))
    part = F.shiftright("mono", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("held"))
    # one row a partition
    before = counts.select("part", (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("before"))
    n = counts.agg(F.coalesce(F.sum("held"), F.lit(0)).alias("n")).first()["n"]
    numbered = placed.withColumn("part", part).join(F.broadcast(before), "part").select(
        "row", (F.col("before") + F.col("mono").bitwiseAND(F.lit(_LOCAL))).alias("number"))
    return numbered, n


def _dealt(rows: DataFrame, order: list[Column], shards: int, key: str, rounds: int) -> DataFrame:
    """(row, number, shard, slot)."""
    if shards < 1 or rounds < 1:
        raise ValueError("at least one shard and one round")
    numbered, n = _numbered(rows, order)
    passes = walks(rows.sparkSession, n, key, rounds)
    at = numbered.select("row", "number", permuted(F.col("number"), n, passes, key, rounds).alias("at"))
    return at.select("row", "number", (F.col("at") % shards).cast("int").alias("shard"),
                     F.floor(F.col("at") / shards).cast("long").alias("slot"))


def assign(docs: DataFrame, shards: int = SHARDS, key: str = KEY, rounds: int = ROUNDS,
           id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All rows with their ``row_number``, ``shard`` and ``slot``."""
    kept = [c for c in docs.columns if c.lower() not in ("row_number", "shard", "slot")]
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{id_column}`").alias("id"),
                       _digest_of(whole_text(f"`{text_column}`")).alias("digest"), F.xxhash64(*hashed).alias("hash"))
    dealt = _dealt(rows, [F.col("id"), F.col("digest"), F.col("hash")], shards, key, rounds)
    return dealt.select(*[F.col(f"row.`{c}`") for c in kept], F.col("number").alias("row_number"), "shard", "slot")


def write(assigned: DataFrame, path: str) -> None:
    """One folder a shard, its files sorted by slot; a hot shard cannot be, all hold equally many rows."""
    assigned.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard").parquet(path)


def report(docs: DataFrame, shards: int = SHARDS, key: str = KEY) -> DataFrame:
    """The place of each document, without its text."""
    text = whole_text()
    slim = F.struct("doc_id", (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
                    F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = docs.select(slim.alias("row"), "doc_id", _digest_of(text).alias("digest"))
    dealt = _dealt(rows, [F.col("doc_id"), F.col("digest")], shards, key, ROUNDS)
    return dealt.select("row.*", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"), F.col("number").alias("row_number"))
