"""Test passages in training texts, by Wu-Manber search over words.

Words are runs of digits, letters a-z (A-Z lowered) and characters beyond ASCII.  A window is 13
consecutive words of an item; an item of fewer, but not none, is one window.  For each window length
the tables of Wu and Manber hold, per block of two words, how far a search may skip; where it may not,
the bucket of that block and the window's first block give the windows that direct comparison checks.

The items are cut into pieces of bounded size that hold each window once, equal pieces of an item as one, and
the pieces are dealt by hash to shards of bounded size, written to the shared folder.  A task takes a group of
texts of bounded size and searches it with the tables of one shard after the other, so documents are read once,
any number of items of any length is searched exactly, and a task holds one group and one shard.  It is the same
plan for every benchmark; nothing of it passes through the driver or is broadcast.

A null text has no words and stays, uncontaminated.  Null ids and repeated rows are judged row by row.
Items that are null or have no words occur nowhere; an item without an id makes hits but is not listed;
an id on several rows is one item.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.base import scratch_path, slices

WINDOW = 13
#: Bytes of item text in one shard; its tables take about a hundred times as much in a worker.
SHARD_BYTES = 1 << 20
#: Bytes of a piece of an item, and of the rows that a task holds while the shards pass by.
PIECE_BYTES, GROUP_BYTES = 1 << 15, 1 << 25

# Fixed value: a word, in UTF-8 with A-Z lowered.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: bytes | None) -> list[bytes]:
    return _WORD.findall(text.lower()) if text else []


class Tables:
    """Shift and bucket tables for windows of one length."""

    def __init__(self, length: int) -> None:
        self.length, self.block = length, min(2, length)
        self.skip = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list[tuple[tuple, set]]]] = {}
        self._ids: dict[tuple, set] = defaultdict(set)

    def add(self, window: tuple, item: str | None) -> None:
        if window not in self._ids:
            for j in range(self.skip):
                part = window[j:j + self.block]
                self.shift[part] = min(self.shift.get(part, self.skip), self.skip - 1 - j)
            (self.buckets.setdefault(window[-self.block:], {})
             .setdefault(window[:self.block], []).append((window, self._ids[window])))
        self._ids[window].add(item)

    def find(self, text: list[bytes], hits: list, items: set) -> None:
        """Append (start, end) of each occurrence to ``hits``, the ids to ``items``."""
        length, block, skip, shift = self.length, self.block, self.skip, self.shift
        i, n = length, len(text)
        while i <= n:
            tail = tuple(text[i - block:i])
            step = shift.get(tail, skip)
            if step:
                i += step
                continue
            start = i - length
            near = self.buckets[tail].get(tuple(text[start:start + block]))
            if near:
                here = tuple(text[start:i])
                for window, ids in near:
                    if window == here:
                        hits.append((start, i))
                        items.update(ids)
            i += 1


def build(rows: Iterable[tuple[str | None, bytes | None]], window: int = WINDOW) -> list[Tables]:
    """Tables per window length from (item id, text) rows."""
    by_length: dict[int, Tables] = {}
    for item, text in rows:
        found = words(text)
        if found:
            m = min(window, len(found))
            tables = by_length.setdefault(m, Tables(m))
            for i in range(len(found) - m + 1):
                tables.add(tuple(found[i:i + m]), item)
    return list(by_length.values())


def merged(hits: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching stretches as one, by start."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(hits):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def pieces(found: list[bytes], window: int = WINDOW, most: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """Stretches of about ``most`` bytes, a window at least, of which exactly one holds each window."""
    if found and len(found) <= window:
        yield found
        return
    start = held = 0
    for end, word in enumerate(found, 1):
        held += len(word) + 1
        if held >= most and end - start >= window:
            yield found[start:end]
            start = end - window + 1
            held = sum(len(w) + 1 for w in found[start:end])
    if len(found) - start >= window:
        yield found[start:]


def _cut_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1):
            ids, texts = [], []
            for item, text in zip(part.column(0).to_pylist(), part.column(1)):
                for piece in pieces(words(text.as_py())):
                    ids.append(item)
                    texts.append(b" ".join(piece))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), pa.array(texts, pa.binary())], ["item", "piece"])


def _shards(benchmark: DataFrame, shard_bytes: int) -> tuple[str, int]:
    """Folder of the pieces, a sub-folder a shard, and the number of shards."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"),
                             F.col("text").cast("binary").alias("text")).filter(F.length("text") > 0)
    held = items.agg(F.sum(F.length("text") + 16)).first()[0] or 0
    shards, folder = max(1, math.ceil(held / shard_bytes)), scratch_path(benchmark.sparkSession, "shards")
    cut = items.mapInArrow(_cut_items, "item string, piece binary").distinct()
    cut.withColumn("shard", F.pmod(F.xxhash64("item", "piece"), F.lit(shards))).repartition(
        "shard").write.partitionBy("shard").parquet(folder)
    return folder, shards


def _read(folder: str, shard: int) -> Iterator[tuple[str | None, bytes]]:
    uri = folder if "://" in folder or folder.startswith("/") else folder.replace(":", "://", 1)
    system, path = fs.FileSystem.from_uri(uri)
    for info in system.get_file_info(fs.FileSelector(f"{path}/shard={shard}", allow_not_found=True)):
        if info.path.endswith(".parquet"):
            with system.open_input_file(info.path) as source:
                held = pq.ParquetFile(source).read(["item", "piece"])
                yield from zip(held["item"].to_pylist(), held["piece"].to_pylist())


_FOUND = "n_words long, hits array<struct<start:int,end:int>>, items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _search(docs: DataFrame, text: str, folder: str, shards: int, keep: bool = True) -> DataFrame:
    """``docs`` with what all shards find in each row; new columns replace old ones of the same name."""
    new = T.StructType.fromDDL(_FOUND)
    taken = {name.lower() for name in new.names} | (set() if keep else {text.lower()})
    kept = [f for f in docs.schema.fields if f.name.lower() not in taken]
    schema = T.StructType([*kept, *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, loaded, tables = list(range(shards)), -1, []

        def found_in(group: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal loaded, tables
            rows = [([], [], set()) for part in group for _ in range(part.num_rows)]  # word count, hits, ids
            for k in order:
                if k != loaded:
                    tables = []  # the shard before goes first
                    tables, loaded = build(_read(folder, k)), k
                values = (v.as_py() for part in group for v in part.column(part.num_columns - 1))
                for value, (count, hits, ids) in zip(values, rows):
                    here = words(value)
                    count[:] = [len(here)]
                    for t in tables:
                        t.find(here, hits, ids)
            order.reverse()  # the next group begins with the shard that is loaded
            at = 0
            for part in group:
                here, at = rows[at:at + part.num_rows], at + part.num_rows
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:-1],
                    pa.array([count[0] for count, _, _ in here], pa.int64()),
                    pa.array([[{"start": a, "end": b} for a, b in merged(hits)] for _, hits, _ in here], _SPANS),
                    pa.array([sorted(ids - {None}) for _, _, ids in here], pa.list_(pa.string()))], schema.names)

        group, held = [], 0
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1):
                group.append(part)
                held += part.nbytes
                if held >= GROUP_BYTES:
                    yield from found_in(group)
                    group, held = [], 0
        if group:
            yield from found_in(group)

    last = "_source"
    while last in {f.name.lower() for f in kept}:
        last += "_"
    return docs.select(*[F.col(f"`{f.name}`") for f in kept],
                       F.col(f"`{text}`").cast("binary").alias(last)).mapInArrow(run, schema)


def _covered(hits: Column) -> Column:
    """Words inside any stretch of a sorted array of (start, end)."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(hits, zero, lambda acc, h: F.struct(
        F.greatest(acc["end"], h["end"]).alias("end"),
        (acc["n"] + F.greatest(F.lit(0), h["end"] - F.greatest(acc["end"], h["start"]))).alias("n")),
        lambda acc: acc["n"])


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text",
         shard_bytes: int = SHARD_BYTES, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (stretches of words), ``items`` (ids as sorted strings),
    ``n_hit`` and ``contaminated`` (at least one word in twenty hit)."""
    found = _search(docs, text, *_shards(benchmark, shard_bytes), keep_text)
    return (found.withColumn("n_hit", _covered(F.col("hits")))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))


def report(docs: DataFrame, benchmark: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    found = find(docs.select("doc_id", "text"), benchmark, "text", shard_bytes, False)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns."""
    own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_own"),
                      F.col("text").alias("_text"))
    kept = find(own, benchmark, "_text", keep_text=False).filter(~F.col("contaminated"))
    return kept.select("_own.*")
