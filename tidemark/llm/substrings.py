"""Removal of long passages that stand in an earlier document, by recompression.

Texts are sequences of words.  Rounds of recompression name what stands together: the first names runs of one
word, each round names pairs whose first symbol has coin 0 and whose second has coin 1.  Names and coins are
hashes of the content, so all tasks name alike without exchanging dictionaries, and equal substrings get equal
symbols except near their ends.  Which symbols of a window cannot depend on what stands around it follows from
the window alone; the smallest of those of the highest level that has any is the window's anchor.  Equal windows
thus have equal anchors.

1. Every text yields its whole name, of all its words, and the distinct anchors of its windows.
2. Texts of one whole name: all but the smallest id are copies and lose everything.
3. Anchors that stand in two documents or more go back to their documents.  Only windows under such an anchor
   are named as a whole (128 bits from 128 bits a word), and the smallest id of each window's name is found.
4. Windows named in a smaller document cover the words that go.

Only sums with a map-side half and joins of written tables are shuffled, so a passage in a third of all
documents is split over tasks.  No copies are paired.

A null text has no words.  Rows without an id keep all their words and take none from others.  Repeated rows
are one document each time: rows of the same id take nothing from one another.  Extra columns do no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import add_columns, cut, slices
from tidemark.llm.words import SOLID, combine, mix, wide_words

WINDOW = 50
#: Rounds of pair naming; symbols of this many words or more are not joined further.
ROUNDS, FULL = 7, 8
#: Words that are parsed at once; longer texts go in overlapping parts.
AT_ONCE = 1 << 18

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The smallest value in each range low..high (inclusive)."""
    width = high - low + 1
    level = np.frexp(width.astype(np.float64))[1] - 1
    out = np.zeros(len(low), dtype=values.dtype)
    table = values
    for k in range(int(level.max(initial=-1)) + 1):
        if k:
            step = 1 << (k - 1)
            table = np.minimum(table[:-step], table[step:])
        mine = level == k
        out[mine] = np.minimum(table[low[mine]], table[high[mine] - (1 << k) + 1])
    return out


def anchors(rows: np.ndarray, symbols: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Start and anchor of every window that lies within one row."""
    n = len(symbols)
    if n < window:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    starts = np.flatnonzero(rows[:n - window + 1] == rows[window - 1:])
    out = np.zeros(len(starts), dtype=np.uint64)
    left = np.arange(len(starts))            # windows whose anchor is not found yet
    low, high = starts, starts + window - 1  # their certain symbols
    size = np.ones(n, dtype=np.int64)

    def settle(level, keep, new_low, new_high):
        """Anchor the windows that have no certain symbol on the next level."""
        nonlocal left, low, high
        ends = np.flatnonzero(~keep)
        found = _least(mix(symbols), low[ends], high[ends])
        out[left[ends]] = combine(found, np.full(len(ends), level, dtype=np.uint64))
        left, low, high = left[keep], new_low[keep], new_high[keep]

    # runs: the first and the last run of a window may go on outside
    begins = np.ones(n, dtype=bool)
    begins[1:] = (symbols[1:] != symbols[:-1]) | (rows[1:] != rows[:-1])
    group = np.cumsum(begins) - 1
    new_low, new_high = group[low] + 1, group[high] - 1
    settle(0, new_low <= new_high, new_low, new_high)
    at = np.flatnonzero(begins)
    size = np.diff(np.append(at, n))
    rows, symbols = rows[at], np.where(
        size > 1, combine(symbols[at], size.astype(np.uint64)), symbols[at])
    for level in range(1, ROUNDS + 1):
        coin = (mix(symbols + np.uint64(level)) >> np.uint64(63)).astype(bool)
        free = size < FULL
        pair = np.zeros(len(symbols), dtype=bool)
        pair[:-1] = free[:-1] & free[1:] & (rows[:-1] == rows[1:]) & ~coin[:-1] & coin[1:]
        begins = np.ones(len(symbols), dtype=bool)
        begins[1:] = ~pair[:-1]
        group = np.cumsum(begins) - 1
        # a free symbol at the edge may belong to a pair with what stands outside
        new_low = group[low] + (free[low] & coin[low])
        new_high = group[high] - (free[high] & ~coin[high])
        settle(level, new_low <= new_high, new_low, new_high)
        at = np.flatnonzero(begins)
        joined = pair[at]
        after = np.minimum(at + 1, len(symbols) - 1)
        rows, size, symbols = rows[at], size[at] + np.where(joined, size[after], 0), np.where(
            joined, combine(symbols[at], symbols[after]), symbols[at])
    settle(ROUNDS + 1, np.zeros(len(left), dtype=bool), low, high)
    return starts, out


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n + 1, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


def window_names(lanes: tuple[np.ndarray, np.ndarray], starts: np.ndarray,
                 window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for the windows at ``starts``, of at most ``AT_ONCE`` + ``window`` words: one name from each lane
    of the words' hashes."""
    out = []
    most = AT_ONCE + window
    for symbols, base in zip(lanes, _BASES):
        powers = _powers(base, most)
        sums = np.zeros(len(symbols) + 1, dtype=np.uint64)
        np.cumsum(mix(symbols ^ np.uint64(base)) * powers[:len(symbols)], out=sums[1:])
        # one power for all places, so that a name does not tell where its window stood
        out.append(mix((sums[starts + window] - sums[starts]) * powers[most - starts]))
    return out[0], out[1]


def _parts(rows: np.ndarray, window: int) -> Iterator[slice]:
    """Overlapping stretches of words such that each window lies in one of them."""
    at = 0
    while at == 0 or at + window - 1 < len(rows):
        yield slice(at, at + AT_ONCE + window - 1)
        at += AT_ONCE


_NAMED = "n_words long, whole binary, anchors array<long>"


def _named(docs: DataFrame, window: int) -> DataFrame:
    """``id, n_words, whole`` (SHA-256 of the words) and distinct ``anchors`` of each document."""

    def make():
        def work(texts: pa.Array) -> list[pa.Array]:
            values = texts.to_pylist()
            rows, hashes, _ = wide_words(values, SOLID)
            keys = [[] for _ in values]
            for part in _parts(rows, window):
                here = rows[part]
                starts, found = anchors(here, hashes[part], window)
                of = here[starts]
                change = np.ones(len(found), dtype=bool)
                change[1:] = (found[1:] != found[:-1]) | (of[1:] != of[:-1])
                of, found = of[change], found[change]
                cuts = np.searchsorted(of, np.arange(len(values) + 1))
                for i in np.unique(of):
                    keys[i].append(found[cuts[i]:cuts[i + 1]])
            distinct = [np.unique(np.concatenate(k)) if k else np.zeros(0, dtype=np.uint64) for k in keys]
            ends = np.concatenate([[0], np.cumsum([len(d) for d in distinct])]).astype(np.int32)
            flat = np.concatenate(distinct) if distinct else np.zeros(0, dtype=np.uint64)
            return [pa.array(np.bincount(rows, minlength=len(values)), pa.int64()),
                    pa.array([hashlib.sha256(b" ".join((v or b"").split())).digest() for v in values], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))]

        return work

    return add_columns(docs, "body", _NAMED, make, False)


def _packed(docs: DataFrame) -> DataFrame:
    """``id, packed``: texts as compressed bytes, for the way through shuffles."""

    def make():
        press = zstandard.ZstdCompressor(level=1)
        return lambda texts: [pa.array([press.compress(t or b"") for t in texts.to_pylist()], pa.binary())]

    return add_columns(docs, "body", "packed binary", make, False)


def _unpacked(batch: pa.RecordBatch, column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    press = zstandard.ZstdDecompressor()
    for part in slices(batch, column, 1 << 18):
        yield part, [press.decompress(t) for t in part.column(column).to_pylist()]


def _windows(candidates: DataFrame, window: int) -> DataFrame:
    """``w1, w2, id, mark, start`` of every window under one of the document's shared anchors.

    ``mark`` stands for ``whole``: it tells apart texts of one id, in eight bytes a window.
    """

    def run(batches):
        names = ["w1", "w2", "id", "mark", "start"]
        for batch in batches:
            for part, texts in _unpacked(batch, 3):
                ids, wholes, marks = part.column(0), part.column(1), part.column(4)
                shared = part.column(2)
                rows, hashes, second = wide_words(texts, SOLID)
                own = [np.sort(np.asarray(s.values).view(np.uint64)) for s in shared]
                first = np.searchsorted(rows, np.arange(len(texts)))
                true = [hashlib.sha256(b" ".join(t.split())).digest() == wholes[i].as_py()
                        for i, t in enumerate(texts)]
                for piece in _parts(rows, window):
                    here = rows[piece]
                    starts, found = anchors(here, hashes[piece], window)
                    of = here[starts]
                    kept = np.zeros(len(starts), dtype=bool)
                    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
                    for i in np.unique(of):
                        if true[i]:  # else the text of another row of this id
                            a, b = cuts[i], cuts[i + 1]
                            at = np.searchsorted(own[i], found[a:b]).clip(max=len(own[i]) - 1)
                            kept[a:b] = own[i][at] == found[a:b]
                    starts, of = starts[kept], of[kept]
                    if len(starts):
                        w1, w2 = window_names((hashes[piece], second[piece]), starts, window)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), ids.take(pa.array(of)),
                             marks.take(pa.array(of)),
                             pa.array((starts + piece.start - first[of]).astype(np.int32))], names)

    return candidates.select("id", "whole", "shared", "packed", "mark").mapInArrow(
        run, "w1 long, w2 long, id long, mark long, start int")


def _kept(hit: DataFrame, window: int) -> DataFrame:
    """``id, whole, n_removed, kept`` from the texts and the starts of the windows that go."""

    def run(batches):
        for batch in batches:
            for part, texts in _unpacked(batch, 3):
                removed, kept, good = [], [], []
                for i, text in enumerate(texts):
                    found = text.split()
                    good.append(hashlib.sha256(b" ".join(found)).digest() == part.column(1)[i].as_py())
                    steps = np.zeros(len(found) + window + 1, dtype=np.int64)
                    starts = np.asarray(part.column(2)[i].values)
                    if good[-1]:
                        np.add.at(steps, starts, 1)
                        np.add.at(steps, starts + window, -1)
                    goes = np.cumsum(steps)[:len(found)] > 0
                    removed.append(int(goes.sum()))
                    kept.append(b" ".join(w for w, g in zip(found, goes.tolist()) if not g))
                mask = pa.array(good, pa.bool_())
                out = pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                    ["id", "whole", "n_removed", "kept"])
                yield out.filter(mask)

    return hit.select("id", "whole", "starts", "packed").mapInArrow(
        run, "id long, whole binary, n_removed long, kept binary")


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``key, n_words, whole, n_removed, kept``: the words kept, joined by one space, as bytes.

    ``kept`` is null where nothing goes; ``whole`` is the SHA-256 of all words joined by one space.
    """
    bodies = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("body"))
    named = cut(_named(bodies, window))
    firsts = cut(named.filter("id is not null").groupBy("whole")
                 .agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
                 .select("whole", "first"))
    marked = cut(named.join(firsts, "whole", "left").withColumn("copy", F.coalesce(
        F.col("id") > F.col("first"), F.lit(False))).drop("first"))
    keys = (marked.filter("id is not null and not copy and size(anchors) > 0").select("id", "whole", "anchors")
            .select("id", "whole", F.explode("anchors").alias("anchor")))
    shared = cut(keys.groupBy("anchor").agg(F.min("id").alias("first"), F.max("id").alias("last"))
                 .filter("first < last").select("anchor"))
    wanted = keys.join(shared, "anchor").groupBy("id", "whole").agg(F.collect_set("anchor").alias("shared"))
    candidates = cut(_packed(bodies.filter("id is not null")).join(cut(wanted), "id").withColumn(
        "mark", F.xxhash64("whole")))
    windows = _windows(candidates, window)
    twice = cut(windows.groupBy("w1", "w2").agg(F.min("id").alias("first"), F.max("id").alias("last"))
                .filter("first < last").select("w1", "w2", "first"))
    starts = cut(windows.join(twice, ["w1", "w2"]).filter("id > first").groupBy("id", "mark")
                 .agg(F.collect_set("start").alias("starts")))
    gone = cut(_kept(candidates.drop("shared").join(starts, ["id", "mark"]), window).distinct())
    all_gone = F.col("copy") & (F.col("n_words") >= window)
    return (marked.drop("anchors").join(gone, ["id", "whole"], "left")
            .select(F.col("id").alias(key), "n_words", "whole",
                    F.when(all_gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
                    .cast("long").alias("n_removed"),
                    F.when(all_gone, F.lit(b"")).otherwise(F.col("kept")).alias("kept")))


def report(docs: DataFrame) -> DataFrame:
    found = dedup(docs)
    return found.select("doc_id", "n_words", "n_removed", F.when(
        F.col("kept").isNull(), F.lower(F.hex("whole"))).otherwise(F.sha2("kept", 256)).alias("kept_sha256"))
