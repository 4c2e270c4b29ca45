"""Scores of texts by an interpolated modified Kneser-Ney model of word pairs.

Training, three shuffles of sorted runs: a task counts what it reads, cuts the sorted counts into shards and
sends each shard one block a flush; a shard's blocks are merged, and the shards of a file, one after the other,
are written as sorted arrays.  Shards follow the order of their keys, so that a file is one sorted array, and
their number grows with the texts (what is merged at a time is bounded) while that of the files does not (a
look-up visits every file).

1. Words, by hash: a word's number is its place in the sorted hashes of all files.
2. Pairs of numbers, in their order, cut where the occurrences of the first words add up to a shard; the pairs
   of a word that is very frequent are cut by the second word as well.  A file yields the pair arrays, the
   counts of counts, and for each word how many successors it has once, twice and more, and before how many
   words it stands.
3. These sums, by word.

The arrays are files in the shared folder; workers map them into memory (a copy of them, already unlinked,
where the folder is not a mounted one) and look up whole batches by binary search.  Nothing but a row a file and
a few totals reaches the driver.

A null text reads as empty and has one token, its end.  Rows without an id are learned from and not held out.
Repeated rows count each.  Without training rows every token has the probability of an unknown word.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import ExitStack
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import add_columns, scratch_path, slices
from tidemark.llm.words import SOLID, mix, words

#: Bytes of text a shard, least number of shards, distinct entries that a task gathers before it sends them, and
#: occurrences from which a word's pairs are cut into several shards.
SHARD_TEXT, LEAST_SHARDS, HELD, FREQUENT = 8 << 20, 16, 1 << 22, 1 << 15
#: Files an array, twice the cores between these bounds (one a shard where shards are fewer), and blocks a batch.
FILES, MOST_FILES, TOGETHER = 64, 1024, 64
#: What the base score adds to each count.
ADDED = 0.1

_START, _END = (np.uint64(x) for x in mix(np.array([0x5357, 0x454E], dtype=np.uint64)))
_BLOCK = "shard int, n int, data binary"


# ---- files

def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace(":", "://", 1))


def _store(folder: str, name: str, array: np.ndarray) -> None:
    """Write an array under its final name in one step, so that a repeated task does no harm."""
    system, path = _place(folder)
    system.create_dir(path, recursive=True)
    fresh = f"{path}/{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(fresh) as out:
        out.write(np.ascontiguousarray(array).tobytes())
    system.move(fresh, f"{path}/{name}")


class _Growing:
    """Files of one folder, written piece by piece; they get their final names together when all is written."""

    def __init__(self, folder: str, names: list[str]) -> None:
        self.system, self.path = _place(folder)
        self.system.create_dir(self.path, recursive=True)
        self.fresh = {name: f"{self.path}/{name}.{uuid.uuid4().hex}" for name in names}
        self.open = ExitStack()
        self.out = [self.open.enter_context(self.system.open_output_stream(x)) for x in self.fresh.values()]

    def write(self, *arrays: np.ndarray) -> None:
        for out, array in zip(self.out, arrays, strict=True):
            out.write(np.ascontiguousarray(array).tobytes())

    def __enter__(self) -> _Growing:
        return self

    def __exit__(self, kind, *_) -> None:
        self.open.close()
        if kind is None:
            for name, fresh in self.fresh.items():
                self.system.move(fresh, f"{self.path}/{name}")


@lru_cache(maxsize=16 * MOST_FILES)
def _mapped(folder: str, name: str, kind: str) -> np.ndarray:
    system, path = _place(folder)
    full = f"{path}/{name}"
    if not system.get_file_info(full).size:
        return np.zeros(0, dtype=kind)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(full, dtype=kind, mode="r")
    with tempfile.NamedTemporaryFile() as copy, system.open_input_stream(full) as source:
        while part := source.read(1 << 20):
            copy.write(part)
        copy.flush()
        return np.memmap(copy.name, dtype=kind, mode="r")  # the map outlives the name


# ---- sorted runs

def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side; the shuffle's compression then drops the zeros."""
    width = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), width).T).tobytes()


def _from_planes(data: bytes, n: int, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    flat = np.frombuffer(data, dtype=np.uint8).reshape(width, n)
    return np.ascontiguousarray(flat.T).view(kind).reshape(n)


def _pack(keys: np.ndarray, sums: list[np.ndarray]) -> bytes:
    # counts take four bytes unless one of the block needs eight, which the first byte says
    kind = "<u4" if max((int(s.max(initial=0)) for s in sums), default=0) < 1 << 32 else "<u8"
    return kind[-1:].encode() + _planes(np.diff(keys, prepend=np.uint64(0))) + b"".join(
        _planes(s.astype(kind)) for s in sums)


def _unpack(data: bytes, n: int) -> tuple[np.ndarray, list[np.ndarray]]:
    width, kind, data = int(data[:1]), f"<u{data[:1].decode()}", data[1:]
    keys = np.cumsum(_from_planes(data[:8 * n], n, "<u8"), dtype=np.uint64)
    return keys, [_from_planes(data[i:i + width * n], n, kind).astype(np.int64)
                  for i in range(8 * n, len(data), width * n)]


def _merge(keys: np.ndarray, sums: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Equal keys as one, sorted, their sums added."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), dtype=bool), keys[1:] != keys[:-1]]))
    if not len(first):
        return keys, [s.astype(np.int64) for s in sums]
    return keys[first], [np.add.reduceat(s[order], first) for s in sums]


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards in the order of the hashes."""
    return (((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


class Runs:
    """What a task has counted, sent as one block a shard whenever it gets large."""

    def __init__(self, shard_of: Callable[[np.ndarray], np.ndarray], held: int = HELD) -> None:
        self.shard_of, self.most = shard_of, held
        self.keys: list[np.ndarray] = []
        self.sums: list[list[np.ndarray]] = []
        self.n = 0

    def add(self, keys: np.ndarray, sums: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        self.keys.append(keys)
        self.sums.append(sums)
        self.n += len(keys)
        if self.n > self.most:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        keys, sums = _merge(np.concatenate(self.keys), [np.concatenate(x) for x in zip(*self.sums)])
        self.keys, self.sums, self.n = [], [], 0
        shard = self.shard_of(keys)
        order = np.argsort(shard, kind="stable")  # keys stay sorted within a shard
        shard, keys, sums = shard[order], keys[order], [s[order] for s in sums]
        cuts = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
        for i in range(0, len(cuts) - 1, TOGETHER):
            some = [(a, b) for a, b in zip(cuts[i:i + TOGETHER], cuts[i + 1:i + TOGETHER + 1])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard[a] for a, _ in some], pa.int32()), pa.array([b - a for a, b in some], pa.int32()),
                 pa.array([_pack(keys[a:b], [s[a:b] for s in sums]) for a, b in some], pa.binary())], ["shard", "n", "data"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """(shard, keys, sums) of the merged blocks of one shard after the other."""
    blocks = ((batch.column(0)[i].as_py(), batch, i) for batch in batches for i in range(batch.num_rows))
    for shard, own in groupby(blocks, lambda x: x[0]):
        parts = [_unpack(batch.column(2)[i].as_py(), batch.column(1)[i].as_py()) for _, batch, i in own]
        yield shard, *_merge(np.concatenate([k for k, _ in parts]),
                             [np.concatenate(x) for x in zip(*(s for _, s in parts))])


def _gathered(blocks: DataFrame, files: int, parts: int, schema: str,
              reduce: Callable[[int, Iterator[tuple[int, np.ndarray, list[np.ndarray]]]], Iterator[pa.RecordBatch]]
              ) -> DataFrame:
    """``reduce(file, its shards)`` of every file, whose ``parts`` shards are merged one at a time, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, shards in groupby(_merged(batches), lambda x: x[0] // parts):
            yield from reduce(file, shards)

    file = F.floor(F.col("shard") / parts).cast("int")
    return blocks.repartitionById(files, file).sortWithinPartitions("shard").mapInArrow(run, schema)


def _cuts(sorted_values: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(i, from, to) of the values from ``bounds[i]`` up to the next bound, where there are some."""
    at = np.append(np.searchsorted(sorted_values, bounds), len(sorted_values))
    for i in np.flatnonzero(np.diff(at)):
        yield int(i), int(at[i]), int(at[i + 1])


# ---- the model

class Model(NamedTuple):
    """Where the arrays are, and the totals."""

    folder: str
    files: int
    offsets: np.ndarray  # first word number of each file, and the number of all
    tokens: int          # training tokens
    distinct: int        # distinct ones
    discounts: np.ndarray = np.zeros(4)        # of pair counts 0, 1, 2, 3 and more
    word_discounts: np.ndarray = np.zeros(4)   # of the numbers of predecessors
    pairs: int = 0       # distinct pairs
    rest: float = 1.0    # weight of the uniform part of the lowest order
    edges: np.ndarray = np.zeros(1, dtype=np.uint64)  # first pair of each file, from the second on

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each of the sorted, distinct hashes; -1 for unknown ones."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        for f, a, b in _cuts(_shard(hashes, self.files), np.arange(self.files)):
            keys = _mapped(self.folder, f"word-{f}", "<u8")
            if len(keys):
                at = np.searchsorted(keys, hashes[a:b]).clip(max=len(keys) - 1)
                out[a:b] = np.where(keys[at] == hashes[a:b], at + self.offsets[f], -1)
        return out

    def of_words(self, name: str, numbers: np.ndarray) -> np.ndarray:
        """Entries of a word array for sorted numbers; 0 for unknown words."""
        out = np.zeros(len(numbers), dtype=np.int64)
        for f, a, b in _cuts(numbers, self.offsets[:-1]):
            array = _mapped(self.folder, f"{name}-{f}", "<u8" if name in ("count", "upto") else "<u4")
            if len(array):
                out[a:b] = array[numbers[a:b] - self.offsets[f]]
        return out

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Training counts of sorted pairs."""
        out = np.zeros(len(keys), dtype=np.int64)
        for f, a, b in _cuts(keys, self.edges):
            known = _mapped(self.folder, f"pair-{f}", "<u8")
            if len(known):
                at = np.searchsorted(known, keys[a:b]).clip(max=len(known) - 1)
                count = _mapped(self.folder, f"pairs-{f}", "<u8")
                out[a:b] = np.where(known[at] == keys[a:b], count[at], 0)
        return out


def sequences(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of START, the words and END of every text, in order."""
    rows, hashes = words(texts, SOLID, lower=True)
    n = len(texts)
    many = np.bincount(rows, minlength=n)
    start = np.cumsum(many + 2) - many - 2
    out = np.empty(len(hashes) + 2 * n, dtype=np.uint64)
    out[start], out[start + many + 1] = _START, _END
    out[np.arange(len(hashes)) + 2 * rows + 1] = hashes
    return np.repeat(np.arange(n), many + 2), out


def _pairs(rows: np.ndarray, hashes: np.ndarray, model: Model):
    """For each token but START: its row, and the places of itself and its predecessor among the distinct words;
    and the numbers of those."""
    distinct, place = np.unique(hashes, return_inverse=True)
    token = np.flatnonzero(hashes != _START)
    return rows[token], place[token], place[token - 1], model.numbers(distinct)


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and 3 or more, from the counts of counts.

    Where a count of counts is missing or gives a discount out of range, half the count's step stands in.
    """
    out = np.array([0.0, 0.5, 1.0, 1.5])
    if n1 and n2:
        y = n1 / (n1 + 2.0 * n2)
        for i, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1):
            if a:
                d = i - (i + 1) * y * b / a
                if 0.0 < d < i:
                    out[i] = d
    return out


def train(docs: DataFrame, learn: Column, text: str = "text", shard_text: int = SHARD_TEXT,
          frequent: int = FREQUENT) -> Model:
    """Count the texts that ``learn`` names and write the arrays."""
    spark = docs.sparkSession
    texts = docs.filter(learn).select(F.col(text).cast("binary").alias("text"))
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    least = max(LEAST_SHARDS, -(-size // shard_text))
    files = min(least, MOST_FILES, max(FILES, 2 * spark.sparkContext.defaultParallelism))
    parts = -(-least // files)
    shards = files * parts
    folder = scratch_path(spark, "model")

    def count_words(batches):
        runs = Runs(lambda keys: _shard(keys, shards))
        for batch in batches:
            for part in slices(batch, 0):
                _, hashes = sequences(part.column(0).to_pylist())
                keys, n = np.unique(hashes, return_counts=True)
                yield from runs.add(keys, [n])
        yield from runs.flush()

    def keep_words(file, merged):
        n = seen = starts = 0
        with _Growing(folder, [f"{name}-{file}" for name in ("word", "count", "upto")]) as out:
            for _, keys, (count,) in merged:
                # occurrences of the words of the file that come before each
                out.write(keys, count.astype("<u8"), (seen + np.cumsum(count) - count).astype("<u8"))
                n, seen, starts = n + len(keys), seen + int(count.sum()), starts + int(count[keys == _START].sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array([file], pa.int32()), *(pa.array([x], pa.int64()) for x in (n, seen, starts))],
            ["file", "n", "tokens", "starts"])

    found = _gathered(texts.mapInArrow(count_words, _BLOCK), files, parts,
                      "file int, n long, tokens long, starts long", keep_words).collect()  # a row a file
    sizes, upto = np.zeros(files + 1, dtype=np.int64), np.zeros(files + 1, dtype=np.int64)
    for r in found:
        sizes[r.file + 1], upto[r.file + 1] = r.n, r.tokens
    sizes, upto, starts = np.cumsum(sizes), np.cumsum(upto), sum(r.starts for r in found)
    model = Model(folder, files, sizes, int(upto[-1]) - starts, int(sizes[-1]) - (starts > 0))
    if model.offsets[-1] >= 1 << 32:
        raise ValueError("more than 2^32 distinct words")
    shared = spark.sparkContext.broadcast(model)
    a_shard = max(1, -(-int(upto[-1]) // shards))

    def pair_shard(keys):
        """Shards of sorted pairs, in their order."""
        held = shared.value
        first, place = np.unique((keys >> np.uint64(32)).astype(np.int64), return_inverse=True)
        count = held.of_words("count", first)
        before = held.of_words("upto", first) + upto[np.searchsorted(held.offsets, first, side="right") - 1]
        share = (keys & np.uint64(0xFFFFFFFF)) / max(1, held.offsets[-1])  # below 1
        within = (np.where(count >= frequent, count, 0)[place] * share).astype(np.int64)
        return np.minimum((before[place] + within) // a_shard, shards - 1)

    def count_pairs(batches):
        held, runs = shared.value, Runs(pair_shard)
        for batch in batches:
            for part in slices(batch, 0):
                _, own, last, numbers = _pairs(*sequences(part.column(0).to_pylist()), held)
                keys = (numbers[last].astype(np.uint64) << np.uint64(32)) | numbers[own].astype(np.uint64)
                keys, n = np.unique(keys, return_counts=True)
                yield from runs.add(keys, [n])
        yield from runs.flush()

    def word_shard(keys):
        """Equal parts of each file's words."""
        offsets, numbers = shared.value.offsets, keys.astype(np.int64)
        file = np.searchsorted(offsets, numbers, side="right") - 1
        return file * parts + (numbers - offsets[file]) * parts // np.diff(offsets)[file]

    def keep_pairs(file, merged):
        # n and how many pairs occur once, twice, three and four times
        runs, lowest, of = Runs(word_shard, HELD // 2), None, np.zeros(5, dtype=np.int64)

        def row(shard, n, data, of, lowest):
            return pa.RecordBatch.from_arrays([
                shard, n, data, pa.array([of] * len(shard), pa.list_(pa.int64())),
                pa.array([lowest] * len(shard), pa.int64()), pa.array([file] * len(shard), pa.int32())], _SUMS)

        with _Growing(folder, [f"{name}-{file}" for name in ("pair", "pairs")]) as out:
            for _, keys, (count,) in merged:
                out.write(keys, count.astype("<u8"))
                lowest = int(keys[:1].view(np.int64)[0]) if lowest is None else lowest
                of += [len(keys), *(int((count == i).sum()) for i in range(1, 5))]
                kind = np.minimum(count, 3)
                none = np.zeros(len(keys), dtype=np.int64)
                for words_, values in ((keys >> np.uint64(32), [kind == 1, kind == 2, kind == 3, none]),
                                       (keys & np.uint64(0xFFFFFFFF), [none, none, none, none + 1])):
                    # merged before they are held: a shard has far fewer words than pairs
                    for batch in runs.add(*_merge(words_, [x.astype(np.int64) for x in values])):
                        yield row(*batch.columns, None, None)
        for batch in runs.flush():
            yield row(*batch.columns, None, None)
        yield row(pa.array([-1], pa.int32()), pa.array([0], pa.int32()), pa.array([b""], pa.binary()), of.tolist(), lowest)

    # the sums are written once: they are read for the totals and for the arrays
    path, schema = scratch_path(spark, "sums"), _BLOCK + ", of array<long>, lowest long, file int"
    _gathered(texts.mapInArrow(count_pairs, _BLOCK), files, parts, schema, keep_pairs).write.parquet(path)
    sums = spark.read.schema(schema).parquet(path)
    total = sums.filter("shard < 0").select("file", "lowest", "of").collect()  # a row a file
    edges = np.full(files, (1 << 64) - 1, dtype=np.uint64)
    for r in total:
        edges[r.file] = r.lowest % (1 << 64)
    # a file without pairs begins where the next one does
    edges = np.minimum.accumulate(edges[::-1])[::-1]

    def keep_sums(file, merged):
        first, last = (int(x) for x in shared.value.offsets[file:file + 2])
        names, done, of = ("once", "twice", "more", "before"), first, np.zeros(5, dtype=np.int64)
        with _Growing(folder, [f"{name}-{file}" for name in names]) as out:
            for shard, keys, values in merged:
                # where the next part begins
                end = first - (-(shard % parts + 1) * (last - first) // parts)
                whole = [np.zeros(end - done, dtype="<u4") for _ in names]
                for array, value in zip(whole, values):
                    array[keys.astype(np.int64) - done] = value
                out.write(*whole)
                done = end
                of += [*(int((values[3] == i).sum()) for i in range(1, 5)), int((values[3] > 2).sum())]
            out.write(*[np.zeros(last - done, dtype="<u4")] * 4)
        yield pa.RecordBatch.from_arrays([pa.array([of.tolist()], pa.list_(pa.int64()))], ["of"])

    of = _gathered(sums.filter("shard >= 0").select("shard", "n", "data"), files, parts, "of array<long>", keep_sums)
    low = of.agg(*(F.coalesce(F.sum(F.col("of")[i]), F.lit(0)).alias(f"n{i}") for i in range(5))).first()
    pairs, *some = (sum(r.of[i] for r in total) for i in range(5))
    d = discounts(*some)
    e = discounts(*(low[f"n{i}"] for i in range(4)))
    rest = (e[1] * low.n0 + e[2] * low.n1 + e[3] * low.n4) / pairs if pairs else 1.0
    return model._replace(discounts=d, word_discounts=e, pairs=pairs, rest=float(rest), edges=edges)


_SUMS = ["shard", "n", "data", "of", "lowest", "file"]


def score(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = True,
          frequent: int = FREQUENT) -> DataFrame:
    """``docs`` with ``n_tokens, n_known, base_score, score`` and ``perplexity``.

    Look-ups follow the order of the pairs, so that ``frequent`` no longer matters here.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def work(texts: pa.Array) -> list[pa.Array]:
            n = len(texts)
            rows, own, last, numbers = _pairs(*sequences(texts.to_pylist()), m)
            # word arrays are read once a distinct word, in the order of the numbers
            order = np.argsort(numbers, kind="stable")
            back = np.empty_like(order)
            back[order] = np.arange(len(order))
            once, twice, more, before, count = (
                m.of_words(name, numbers[order])[back] for name in ("once", "twice", "more", "before", "count"))
            d, e = m.discounts, m.word_discounts
            lowest = m.rest / (m.distinct + 1) + np.maximum(
                before - e[np.minimum(before, 3)], 0.0) / max(1, m.pairs)
            history = np.maximum(count, 1)
            kept = np.where(count > 0, (d[1] * once + d[2] * twice + d[3] * more) / history, 1.0)
            both = (numbers[last].astype(np.uint64) << np.uint64(32)) | (
                numbers[own].astype(np.uint64) & np.uint64(0xFFFFFFFF))
            known = (numbers[own] >= 0) & (numbers[last] >= 0)
            keys, place = np.unique(both[known], return_inverse=True)
            seen = np.zeros(len(own), dtype=np.int64)
            seen[known] = m.pair_counts(keys)[place]
            p = np.maximum(seen - d[np.minimum(seen, 3)], 0.0) / history[last] + kept[last] * lowest[own]
            base = np.log10((count + ADDED) / (m.tokens + ADDED * (m.distinct + 1)))
            tokens = np.bincount(rows, minlength=n)
            scores = np.bincount(rows, np.log10(p), n)
            return [pa.array(tokens, pa.int64()),
                    pa.array(np.bincount(rows, count[own] > 0, n).astype(np.int64)),
                    pa.array(np.bincount(rows, base[own], n)), pa.array(scores),
                    pa.array(10.0 ** np.minimum(-scores / np.maximum(tokens, 1), 300.0))]

        return work

    return add_columns(docs, text, "n_tokens long, n_known long, base_score double, score double, "
                       "perplexity double", make, keep_text)


def report(docs: DataFrame) -> DataFrame:
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    model = train(docs, ~held)
    found = score(docs.select("doc_id", "text"), model, "text", False)
    return found.select("doc_id", held.alias("held_out"), "n_tokens", "n_known",
                        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", "perplexity")
