"""Runs of repeated words: maximal stretches whose words come back at a smallest distance, four times at least.

At each scale B (a power of two) the words are cut into blocks of B.  A run of period q, four periods long, holds a whole
block and its next occurrence q words on if 3q >= 2B - 1, so scale B looks for periods from (2B - 1)/3 to (4B - 1)/3 and the
scales together for all.  For each block the sum of squared differences to every shift of the window after it is
x.x + y.y - 2 x.y, whose last term is a convolution, done by number-theoretic transforms of length 2B in whole numbers.
Word numbers are dense in each document, so the sum has a known bound, and as many prime moduli are used as make
their product exceed it: a sum that vanishes modulo each is zero, and the block stands there word by word.

Shifts that fit are seeds.  Neighbouring blocks with one distance make a chain, and as the blocks beside a chain do not
fit, each end needs less than B direct comparisons.  Stretches of four periods and six words stay, but those inside a run
whose period divides theirs.  A block with a word that does not come back within the window cannot fit and is left out
of the transforms; that is counted from the words' next places and drops no run.

All texts of a slice are worked on together.  Words are told apart by their bytes (a dictionary), not by hashes.  The
transforms take bounded memory, and a long text costs n log n for each of log n scales.  Blocks of up to 2^24 words have
roots, which is enough for periods in texts of 80 million words; a longer text that repeats at that distance raises.

A null or empty text, or one of white space, has no words and no runs.  Repeated rows get equal results.  The columns
``n_words``, ``runs`` and ``collapsed`` are new and replace old ones of these names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import add_columns, whole_text
from tidemark.llm.words import SOLID, joined, spans

LEAST_PERIODS, LEAST_WORDS = 4, 6
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
#: Primes below 2^31 with roots of order 2^25 or more, and a generator of each.
PRIMES = ((2013265921, 31), (2113929217, 5), (469762049, 3), (167772161, 3))
#: Numbers that one step of the transforms holds.
HELD = 1 << 18


def _mul(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    out = a * b
    out -= (out // np.uint64(p)) * np.uint64(p)
    return out


def _roots(size: int, p: int, g: int) -> list[np.ndarray]:
    """Powers of the root of order 2h, h = size/2, size/4 .. 1."""
    out, h = [], size // 2
    while h:
        w, powers = pow(g, (p - 1) // (2 * h), p), np.ones(1, dtype=np.uint64)
        while len(powers) < h:
            powers = np.concatenate([powers, _mul(powers, np.uint64(pow(w, len(powers), p)), p)])
        out.append(powers)
        h //= 2
    return out


class Transform:
    """Transforms of many rows of one length modulo a prime; the order in between does not matter."""

    def __init__(self, size: int, p: int, g: int) -> None:
        if (p - 1) % size:
            raise ValueError("texts of so many words need primes with longer roots")
        self.size, self.p = size, np.uint64(p)
        self.prime = p
        self.forward = _roots(size, p, g)
        self.back = _roots(size, p, pow(g, p - 2, p))
        self.scale = np.uint64(pow(size, p - 2, p))

    def _less(self, a: np.ndarray) -> np.ndarray:
        return np.minimum(a, a - self.p)  # a - p wraps to a large number where a < p

    def there(self, a: np.ndarray) -> np.ndarray:
        for w in self.forward:
            a = a.reshape(len(a), -1, 2, len(w))
            low, high = a[:, :, 0], a[:, :, 1]
            a = np.stack([self._less(low + high), _mul(low + (self.p - high), w, self.prime)], axis=2)
            a = a.reshape(len(a), -1)
        return a

    def again(self, a: np.ndarray) -> np.ndarray:
        for w in reversed(self.back):
            a = a.reshape(len(a), -1, 2, len(w))
            low, high = a[:, :, 0], _mul(a[:, :, 1], w, self.prime)
            a = np.stack([self._less(low + high), self._less(low + (self.p - high))], axis=2)
            a = a.reshape(len(a), -1)
        return _mul(a, self.scale, self.prime)


_TRANSFORMS: dict[tuple[int, int], Transform] = {}


def _transform(size: int, which: int) -> Transform:
    if (size, which) not in _TRANSFORMS:
        _TRANSFORMS[size, which] = Transform(size, *PRIMES[which])
    return _TRANSFORMS[size, which]


def least_distance(block: int) -> int:
    """The first distance a scale looks for; the next scale's first one ends it."""
    return max(1, -(-(2 * block - 1) // 3))


def zero_shifts(blocks: np.ndarray, windows: np.ndarray, shifts: int) -> np.ndarray:
    """Where each block (a row) stands in its window without a mismatch: rows x shifts, booleans.

    Numbers are not negative.  Exact: the moduli's product exceeds any sum of squared differences.
    """
    rows, b = blocks.shape
    most = int(max(blocks.max(initial=0), windows.max(initial=0)))
    bound, product, moduli = b * most * most + 1, 1, 0
    while product < bound:
        if moduli == len(PRIMES):
            raise ValueError("too many different words for the moduli")
        product *= PRIMES[moduli][0]
        moduli += 1
    moduli = max(moduli, 1)
    size = 1
    while size < windows.shape[1]:
        size *= 2
    squares = np.zeros((rows, windows.shape[1] + 1), dtype=np.uint64)
    fits = np.ones((rows, shifts), dtype=bool)
    for which in range(moduli):
        t, p = _transform(size, which), PRIMES[which][0]
        x, y = (np.zeros((rows, size), dtype=np.uint64) for _ in range(2))
        x[:, :b] = blocks[:, ::-1] % p
        y[:, :windows.shape[1]] = windows % p
        product_ = t.again(_mul(t.there(x), t.there(y), p))[:, b - 1:b - 1 + shifts]
        own = (_mul(x, x, p).sum(axis=1) % np.uint64(p))[:, None]
        np.cumsum(_mul(y[:, :windows.shape[1]], y[:, :windows.shape[1]], p), axis=1, out=squares[:, 1:])
        theirs = (squares[:, b:b + shifts] - squares[:, :shifts]) % np.uint64(p)
        fits &= (own + theirs) % np.uint64(p) == (product_ * np.uint64(2)) % np.uint64(p)
    return fits


def _seeds(ids: np.ndarray, ends: np.ndarray, following: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """(distance, block number) of all blocks of a scale that come back in their document, by distance and block."""
    low, high = least_distance(b), least_distance(2 * b)
    none = np.zeros(0, dtype=np.int64)
    late = np.concatenate([[0], np.cumsum(following >= high)])
    starts = np.arange(0, len(ids) - b + 1, b)
    starts = starts[(late[starts + b] == late[starts]) & (starts + b + low <= ends[starts])] if high > low else none
    if not len(starts):
        return none, none
    shifts = high - low
    padded = np.concatenate([ids, np.zeros(b + high, dtype=ids.dtype)])
    found = []
    step = max(1, HELD // (2 * b))
    for i in range(0, len(starts), step):
        at = starts[i:i + step]
        blocks = padded[at[:, None] + np.arange(b)]
        windows = padded[at[:, None] + np.arange(low, high + b - 1)]
        row, shift = np.nonzero(zero_shifts(blocks, windows, shifts))
        inside = at[row] + shift + low + b <= ends[at[row]]
        found.append((shift[inside] + low, at[row[inside]] // b))
    distance, block = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((block, distance))
    return distance[order], block[order]


def _reach(ids: np.ndarray, at: np.ndarray, d: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``at`` on, going by ``step``, equal those ``d`` further, ``most`` at most."""
    out = np.zeros(len(at), dtype=np.int64)
    open_ = np.flatnonzero(most > 0)
    width = 8
    while len(open_):
        goes = []
        lot = max(1, HELD // width)
        for i in range(0, len(open_), lot):
            k = open_[i:i + lot]
            t = out[k][:, None] + np.arange(width)
            here = at[k][:, None] + step * t
            valid = t < most[k][:, None]
            here = np.where(valid, here, at[k][:, None])
            same = valid & (ids[here] == ids[np.minimum(here + d[k][:, None], len(ids) - 1)])
            stop = ~same
            run = np.where(stop.any(axis=1), stop.argmax(axis=1), width)
            out[k] += run
            goes.append(k[(run == width) & (out[k] < most[k])])
        open_ = np.concatenate(goes)
        width = min(2 * width, HELD)
    return out


def runs_of(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in a row of documents; ``starts`` and ``ends`` are each word's document's."""
    if not len(ids):
        return []
    order = np.lexsort((np.arange(len(ids)), ids, starts))
    following = np.full(len(ids), len(ids) + 1, dtype=np.int64)
    nearer = (starts[order][1:] == starts[order][:-1]) & (ids[order][1:] == ids[order][:-1])
    following[order[:-1][nearer]] = (order[1:] - order[:-1])[nearer]
    longest = int((ends - starts).max())
    found: list[tuple[int, int, int]] = []
    by_start: dict[int, list[tuple[int, int, int]]] = {}

    def covered(at: int, end: int, d: int) -> bool:
        return any(d % q == 0 and s <= at and end <= e for s, e, q in by_start.get(int(starts[at]), ()))

    b = 2
    while LEAST_PERIODS * least_distance(b) <= longest:
        distance, block = _seeds(ids, ends, following, b)
        new = np.ones(len(block), dtype=bool)
        new[1:] = (distance[1:] != distance[:-1]) | (block[1:] != block[:-1] + 1) | (
            starts[block[1:] * b] != starts[block[:-1] * b])
        first = np.flatnonzero(new)
        if len(first):
            last = np.append(first[1:], len(block)) - 1
            d, left, right = distance[first], block[first] * b, block[last] * b + b
            todo = np.array([not covered(x, y + z, z) for x, y, z in zip(
                left.tolist(), right.tolist(), d.tolist(), strict=True)], dtype=bool)
            d, left, right = d[todo], left[todo], right[todo]
            more = _reach(ids, np.minimum(right, len(ids) - 1), d, ends[left] - right - d, 1)
            less = _reach(ids, np.maximum(left - 1, 0), d, left - starts[left], -1)
            lows, highs = left - less, right + more + d
            good = np.flatnonzero(highs - lows >= np.maximum(LEAST_WORDS, LEAST_PERIODS * d))
            for low, high, period in sorted({(int(lows[i]), int(highs[i]), int(d[i])) for i in good}, key=lambda r: r[2]):
                if not covered(low, high, period):
                    by_start.setdefault(int(starts[low]), []).append((low, high, period))
                    found.append((low, high - low, period))
        b *= 2
    return sorted(found, key=lambda r: (r[0], r[2]))


def _numbers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every word in order: its number within its document, its row, and its place in the data; the data."""
    data, text_ends = joined(texts.to_pylist(), lower=False)
    at, to = spans(data, SOLID)
    rows = np.searchsorted(text_ends, at, side="right")
    lengths = to - at
    solid = data[SOLID[data]]
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(solid)])
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    keys, ids = np.unique(rows * (int(codes.max(initial=0)) + 1) + codes, return_inverse=True)
    of_row = keys // (int(codes.max(initial=0)) + 1)
    ids = ids.astype(np.int64) - np.searchsorted(of_row, rows)
    return ids, rows, at, to, data


def _worked(texts: pa.Array) -> list[pa.Array]:
    ids, rows, at, to, data = _numbers(texts)
    count = len(texts)
    first = np.searchsorted(rows, np.arange(count + 1))
    starts, ends = first[rows], first[rows + 1]
    runs = runs_of(ids, starts, ends)
    dropped = np.zeros(len(ids) + 1, dtype=np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    gone = np.cumsum(dropped[:-1]) > 0 if len(ids) else np.zeros(0, dtype=bool)
    lists: list[list[dict]] = [[] for _ in range(count)]
    for start, length, period in runs:
        row = int(rows[start])
        lists[row].append({"start": int(start - first[row]), "length": length, "period": period})
    kept = np.flatnonzero(~gone)
    collapsed = _joined(data, at[kept], to[kept], np.searchsorted(rows[kept], np.arange(count + 1)))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    return [pa.array(np.diff(first), pa.int64()), pa.array(lists, kind), collapsed]


def _joined(data: np.ndarray, at: np.ndarray, to: np.ndarray, first: np.ndarray) -> pa.Array:
    """Words of each row joined by one space, gathered without a step a word."""
    lengths = to - at + 1  # with a space after each
    places = np.concatenate([[0], np.cumsum(lengths)])
    take = np.arange(places[-1]) - np.repeat(places[:-1] - at, lengths)
    out = data[np.minimum(take, len(data) - 1)] if len(data) else np.zeros(0, dtype=np.uint8)
    out = out.copy()
    out[places[1:] - 1] = 0x20
    raw = out.tobytes()
    bounds = places[first]
    return pa.array([raw[a:max(a, z - 1)].decode("utf-8", "replace") for a, z in zip(
        bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], pa.string())


def find(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """All rows with their number of words, their runs by start and period, and the text without repeats.

    The last drops every word that a run holds after its first period.
    """
    return add_columns(docs, text_column, f"n_words bigint, runs {RUNS}, collapsed string", lambda: _worked)


def planted(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The contract's texts: from word a on, those of every tenth id (by CRC-32) repeat their next p words.

    A null id is no id and leaves its text alone.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split(whole_text(text_column), "[\\x20\\x09-\\x0D]+", -1), "")

    def repeated(w: Column) -> Column:
        n, g = F.size(w).cast("long"), F.floor(h / 10)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(
            w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    bound = F.transform(F.filter(F.array(words), lambda w: F.size(w) > 0), repeated)  # binds the words once
    return docs.withColumn(text_column, F.when(h % 10 == 0, F.coalesce(F.get(bound, F.lit(0)), F.lit(""))).otherwise(
        whole_text(text_column)))


def strongest(runs: str = "runs") -> Column:
    """The run with the greatest length over period; the earlier, then shorter-period one of equals."""
    def better(best: Column, r: Column) -> Column:
        left, right = r["length"] * best["period"], best["length"] * r["period"]
        return F.when(best.isNull() | (left > right), r).otherwise(best)
    return F.aggregate(runs, F.expr("cast(null as struct<start:bigint,length:bigint,period:bigint>)"), better)


def report(docs: DataFrame) -> DataFrame:
    """Runs and digests of each document of the contract."""
    found = find(planted(docs.select("doc_id", "text"))).withColumn("best", strongest())
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    ended = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.lit(1000).cast("long") * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(ended, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
