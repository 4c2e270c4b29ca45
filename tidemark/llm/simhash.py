"""Near copies by SimHash, compared in bit-sliced blocks.

A fingerprint bit is 1 if it is set in over half of the hashes of the text's word shingles.  Fingerprints of
at most ``radius`` differing bits are linked; links and their chains make the components.

Equal fingerprints become one row.  The 64 bits are cut into ``radius + agree`` blocks; two fingerprints within
the radius agree in at least ``agree`` of them, so each choice of so many is a table, and its buckets hold all links.
Rows alone in their bucket go.  Buckets beyond ``BUCKET_ROWS`` are cut into chunks and each two chunks meet in
one task, so no task holds more than two chunks, whatever the bucket's size, and no link is lost.

Within a task the bits are stored as vertical planes of 64 rows a word.  For each query row the planes that
differ are added by carry-save counters, and words in which every counter is beyond the radius are
abandoned.  Only a spanning star of the rows that belong together leaves the task.

A null or empty text has fingerprint zero.  Rows without an id have a fingerprint and take the component of
their equals, but no component comes from them.  Repeated rows come through.

Dropping copies calls the same components, with the same shingles and radius: of each, the document with the smallest
id stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import add_columns, cut, slices
from tidemark.llm.components import components
from tidemark.runtime import settled

SHINGLE, RADIUS, SEED = 3, 3, 42
#: Rows of a chunk of a large bucket, and rows of small buckets that are compared together.
BUCKET_ROWS, TOGETHER = 2048, 1024
#: Blocks that must agree in a table: more make more tables with smaller buckets (10 of 25 bits).
AGREE = 2
#: Planes that are added before full words are looked for.
PLANES_A_STEP = 8

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _hashes(words: list[bytes], shingle: int) -> list[int]:
    """The hash of each shingle; fewer words are one shingle."""
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    spans = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in spans]


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a text; A-Z are lowered, words end at ASCII white space."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    hashes = np.array(_hashes(words, shingle), dtype=">u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE,
                 keep_text: bool = True) -> DataFrame:
    """``docs`` with ``fp``: the fingerprint as a signed long."""

    def make():
        def work(texts: pa.Array) -> list[pa.Array]:
            made = np.array([fingerprint(t.as_py(), shingle) for t in texts], dtype=np.uint64)
            return [pa.array(made.view(np.int64), pa.int64())]

        return work

    return add_columns(docs, text, "fp long", make, keep_text)


def planes(prints: np.ndarray) -> np.ndarray:
    """Vertical bit planes: 64 rows of words, bit i of a word for row i of its 64."""
    words = -(-len(prints) // 64)
    bits = np.zeros((words * 64, 64), dtype=np.uint8)
    bits[:len(prints)] = np.unpackbits(prints.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def neighbours(prints: np.ndarray, radius: int) -> np.ndarray:
    """For each row the set of rows within the radius, as words of 64 bits."""
    n = len(prints)
    sliced = planes(prints)
    words = sliced.shape[1]
    full = np.full(words, _ALL)
    if n % 64:
        full[-1] = np.uint64((1 << (n % 64)) - 1)
    counters = max(1, int(radius).bit_length())
    out = np.zeros((n, words), dtype=np.uint64)
    q, w = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(words), indexing="ij"))
    count = [np.zeros(len(q), dtype=np.uint64) for _ in range(counters)]
    over = np.zeros(len(q), dtype=np.uint64)
    for j in range(64):
        mine = (prints[q] >> np.uint64(63 - j)) & np.uint64(1)
        carry = sliced[j][w] ^ (np.uint64(0) - mine)
        for c in count:
            carry, c[:] = c & carry, c ^ carry
        over |= carry
        if (j + 1) % PLANES_A_STEP == 0:
            beyond = over if j < 63 or radius == (1 << counters) - 1 else over | _above(count, radius)
            open_ = np.flatnonzero(beyond & full[w] != full[w])
            q, w, over = q[open_], w[open_], beyond[open_]
            count = [c[open_] for c in count]
    out[q, w] = ~over & full[w]
    return out


def _above(count: list[np.ndarray], limit: int) -> np.ndarray:
    """Where the counters, lowest first, hold more than ``limit``."""
    more, same = np.zeros_like(count[0]), np.full_like(count[0], _ALL)
    for k in reversed(range(len(count))):
        if limit >> k & 1:
            same &= count[k]
        else:
            more |= same & count[k]
            same &= ~count[k]
    return more


def stars(near: np.ndarray) -> Iterator[tuple[int, int]]:
    """(root, member) pairs that span the components of a symmetric neighbour table."""
    n, words = near.shape
    left = np.zeros(words * 64, dtype=bool)
    left[:n] = True
    for root in range(n):
        if not left[root]:
            continue
        left[root] = False
        edge = np.array([root])
        while len(edge):
            reached = np.bitwise_or.reduce(near[edge], axis=0)
            bits = np.unpackbits(reached.view(np.uint8), bitorder="little").astype(bool) & left
            edge = np.flatnonzero(bits)
            left[edge] = False
            for member in edge.tolist():
                yield root, member


def _buckets(fp: Column, radius: int, agree: int) -> Column:
    """The buckets of a fingerprint, one for each ``agree`` of ``radius + agree`` blocks of bits."""
    count = radius + agree
    cuts = [round(64 * i / count) for i in range(count + 1)]
    blocks = [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1))
              for a, b in zip(cuts, cuts[1:])]
    out = []
    for t, chosen in enumerate(combinations(range(count), agree)):
        bits = F.lit(0).cast("long")
        for i in chosen:
            bits = F.shiftleft(bits, cuts[i + 1] - cuts[i]).bitwiseOR(blocks[i])
        out.append(bits.bitwiseOR(F.lit(t << 48)))
    return F.array(*out)


def links(prints: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS,
          agree: int = AGREE) -> DataFrame:
    """``a, b``: a spanning set of the links between different fingerprints.

    ``prints`` has ``fp`` (distinct) and ``id``; the links name ids.
    """
    # without a bit for each block there is one bucket
    keyed = (prints.withColumn("bucket", F.explode(_buckets(F.col("fp"), radius, agree)))
             if radius + agree <= 64 else prints.withColumn("bucket", F.lit(0).cast("long")))
    crowded = cut(keyed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"))
    chunks = F.ceil(F.col("n") / bucket_rows)
    met = (keyed.join(crowded, "bucket").withColumn("chunks", chunks)
           .withColumn("mine", F.pmod(F.xxhash64("fp", "bucket"), "chunks"))
           .withColumn("theirs", F.explode(F.when(F.col("chunks") == 1, F.array(F.lit(0).cast("long")))
                       .otherwise(F.array_remove(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1),
                                                 F.col("mine")))))
           .select("bucket", F.least("mine", "theirs").alias("low"),
                   F.greatest("mine", "theirs").alias("high"), "fp", "id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(rows: np.ndarray) -> pa.RecordBatch:
            found = list(stars(neighbours(rows[:, 0].view(np.uint64), radius)))
            pairs = np.array(found, dtype=np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays(
                [pa.array(rows[pairs[:, 0], 1]), pa.array(rows[pairs[:, 1], 1])], ["a", "b"])

        held = np.zeros((0, 2), dtype=np.int64)
        last = None
        for batch in batches:
            key = np.stack([np.asarray(batch.column(i)) for i in range(3)], axis=1)
            rows = np.stack([np.asarray(batch.column(i)) for i in (3, 4)], axis=1)
            fresh = np.ones(len(rows), dtype=bool)
            fresh[1:] = (key[1:] != key[:-1]).any(axis=1)
            if last is not None and len(rows):
                fresh[0] = bool((key[0] != last).any())
            last = key[-1] if len(rows) else last
            begins = np.flatnonzero(fresh)
            # rows of several small buckets are compared at once: what is near is a link anyway
            for part in np.split(np.arange(len(rows)), begins):
                if len(part) and fresh[part[0]] and len(held) >= TOGETHER:
                    yield linked(held)
                    held = held[:0]
                held = np.concatenate([held, rows[part]])
        if len(held):
            yield linked(held)

    dealt = met.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    return dealt.mapInArrow(run, "a long, b long")


def _roots(prints: DataFrame, radius: int, bucket_rows: int, agree: int) -> DataFrame:
    """``fp, component_id`` of each fingerprint, joined by fingerprints, not by ids, which may repeat."""
    distinct = cut(prints.groupBy("fp").agg(F.min("id").alias("id")))
    nodes = distinct.filter(F.col("id").isNotNull()).select("fp", F.col("fp").alias("id"))
    found = cut(components(links(nodes, radius, bucket_rows, agree)))
    rooted = distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "fp", "id", F.coalesce("component", "fp").alias("root"))
    least = cut(rooted.groupBy("root").agg(F.min("id").alias("component_id")))
    return cut(rooted.join(least, "root").select("fp", "component_id"))


def group(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE,
          radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS, agree: int = AGREE) -> DataFrame:
    """``key``, ``fp`` and ``component_id`` (the smallest key that links reach), a row per document."""
    prints = cut(fingerprints(docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("body")),
                              "body", shingle, False))
    of_print = _roots(prints, radius, bucket_rows, agree)
    return prints.join(of_print, "fp").select(F.col("id").alias(key), "fp", "component_id")


def _content(text: str) -> Column:
    """A digest of the text, null read as empty."""
    whole = F.coalesce(F.col(text).cast("binary"), F.lit(bytearray()))
    return F.substring(F.unhex(F.sha2(whole, 256)), 1, 16)


def copies(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE,
           radius: int = RADIUS) -> DataFrame:
    """``id, digest`` of each document that is not the one of its component that stays.

    That one has the smallest id; of rows that share it and the fingerprint but not the text, the smallest
    digest.  Rows of one id and one text are one document; rows of one id with different fingerprints are
    different documents, each in its own component.  Rows without an id belong to no group.
    """
    told = docs.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), _content(text).alias("digest"), F.col(text).alias("body"))
    prints = cut(fingerprints(told, "body", shingle, False))
    rows = prints.distinct()
    roots = _roots(prints, radius, BUCKET_ROWS, AGREE)
    first = prints.groupBy("fp", "id").agg(F.min("digest").alias("first"))
    marked = rows.join(first, ["fp", "id"]).join(roots, "fp")
    return marked.filter((F.col("id") != F.col("component_id")) | (F.col("digest") != F.col("first"))).select("id", "digest")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are no copies, with their own columns."""
    gone = settled(docs.sparkSession, lambda: copies(docs))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.col("doc_id").cast("long").alias("id"), _content("text").alias("digest"))
    # one plan for every size: what goes is never broadcast
    return own.join(gone.hint("merge"), ["id", "digest"], "left_anti").select("row.*")


def report(docs: DataFrame) -> DataFrame:
    found = group(docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
