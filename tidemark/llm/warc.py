"""Web archives: write page records, read them back, put segments together again.

Of pages with equal payloads the one with the smallest id becomes a response record, the others revisit
records that name it.  A response block is an HTTP message in chunked framing; a block longer than a
segment is split into the record and its continuation records.  Spark's text writer lays the records down
compressed, a bounded number a file, so an archive file has a bounded size and one task reads it.

The reader parses whole files, groups continuation records by the identifier of their origin, orders
them by segment number, checks the total length and the digests, and decodes the chunked framing.

A null payload is an empty one.  Rows without an id are records too: they revisit a page that has an
id, or are responses if there is none.  Repeated rows of the smallest id are all responses.  Only the
columns page_id, url and html are read; an empty table gives an archive without records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.base import scratch_path

#: Bytes of a block in one record, of a chunk in the framing, and records in one file.
SEGMENT_BYTES, CHUNK_BYTES, FILE_RECORDS = 32 << 10, 8 << 10, 512
#: Payloads of fewer bytes are never revisits.
LEAST_BYTES = 0

# Fixed values of the format: version line, line end, what follows a record, the names of pages.
_VERSION, _EOL, _AFTER = b"WARC/1.1", b"\r\n", "\r\n\r\n"
_PAGE = "urn:tidemark:page:"
_DATE = "2024-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """A body in chunked transfer framing."""
    parts = []
    for i in range(0, len(payload), size):
        piece = payload[i:i + size]
        parts.append(b"%x\r\n%b\r\n" % (len(piece), piece))
    return b"".join(parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; raises ValueError on broken framing."""
    parts, at = [], 0
    while True:
        end = body.index(_EOL, at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if len(body) < at + size + 2 or body[at + size:at + size + 2] != _EOL:
            raise ValueError("a chunk ends early")
        parts.append(body[at:at + size])
        at += size + 2


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record without the two line ends that follow it."""
    head = _EOL.join([_VERSION, *(f"{k}: {v}".encode() for k, v in fields),
                      b"Content-Length: %d" % len(block)])
    return head + _EOL + _EOL + block


def page_records(name: str, uri: str, payload: bytes, refers_to: int | None,
                 segment_bytes: int) -> list[bytes]:
    """The records of one page: a revisit, or a response with its continuations."""
    common = [("WARC-Target-URI", re.sub("[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)),
              ("WARC-Date", _DATE), ("WARC-Payload-Digest", "sha1:" + base32_sha1(payload))]
    kind = ("Content-Type", "application/http;msgtype=response")
    if refers_to is not None:
        return [record([("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{name}>"), *common, kind,
                        ("WARC-Profile",
                         "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                        ("WARC-Refers-To", f"<{_PAGE}{refers_to}>"),
                        ("X-Payload-Length", str(len(payload)))], _HTTP)]
    block = _HTTP + chunked(payload)
    pieces = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    out = []
    for n, piece in enumerate(pieces, 1):
        digest = ("WARC-Block-Digest", "sha1:" + base32_sha1(piece))
        segment = [("WARC-Segment-Number", str(n))] if len(pieces) > 1 else []
        if n == 1:
            fields = [("WARC-Type", "response"), ("WARC-Record-ID", f"<{name}>"), *common, kind]
        else:
            fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{name}:{n}>"), *common[:2],
                      ("WARC-Segment-Origin-ID", f"<{name}>")]
            if n == len(pieces):
                segment.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(record([*fields, *segment, digest], piece))
    return out


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields with lower-case names, block) of every record of a file, compressed or not."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    at = 0
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        lines = content[at:end].split(_EOL)
        if end < 0 or not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {}
        for line in lines[1:]:
            key, _, value = line.partition(b":")
            fields[key.decode().strip().lower()] = value.decode("utf-8", "replace").strip()
        start = end + 4
        at = start + int(fields["content-length"])
        if at > len(content):
            raise ValueError("a block ends early")
        yield fields, content[start:at]
        at += 4


def write_archives(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES,
                   segment_bytes: int = SEGMENT_BYTES, file_records: int = FILE_RECORDS) -> None:
    """Write a record per row below ``path``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string"),
                        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    copies = (rows.filter(F.length("payload") >= least_bytes).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
              .filter("n > 1").select("digest", "first"))  # a lone payload needs no partner
    rows = (rows.join(copies, "digest", "left")
            .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
            .withColumn("name", F.concat_ws(":", F.lit(_PAGE[:-1]),
                                            F.coalesce(F.col("page_id").cast("string"), F.lit("null")),
                                            F.monotonically_increasing_id().cast("string")))
            .select("name", "url", "refers_to", "payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes] = []
            held = 0
            for i in range(batch.num_rows):
                name, url, refers, payload = (batch.column(c)[i].as_py() for c in range(4))
                made = page_records(name, url or name, payload, refers, segment_bytes)
                out += made
                held += sum(map(len, made))
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    (rows.mapInArrow(run, "record binary").select(F.col("record").cast("string"))
     .write.option("lineSep", _AFTER).option("maxRecordsPerFile", file_records)
     .option("compression", "gzip").text(path))


_RECORD = ("record_id string, origin string, type string, uri string, number int, total long, "
           "digest string, refers_to string, length long, sound boolean, block binary")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives, segments apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _RECORD.split(", ")]
        types = [pa.string()] * 4 + [pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(),
                                     pa.bool_(), pa.binary()]
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for f, block in parse(content.as_py()):
                    bare = {k: f[k].strip("<>") for k in f}
                    told = f.get("warc-block-digest")
                    number = f.get("warc-segment-number")
                    total, length = f.get("warc-segment-total-length"), f.get("x-payload-length")
                    rows.append((
                        bare["warc-record-id"], bare.get("warc-segment-origin-id", bare["warc-record-id"]),
                        f["warc-type"], f.get("warc-target-uri"), number and int(number),
                        total and int(total), f.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                        bare.get("warc-refers-to"), length and int(length),
                        told is None or told == "sha1:" + base32_sha1(block), block))
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(columns, types)], names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, _RECORD)


_WHOLE = ("record_id string, type string, uri string, digest string, refers_to string, length long, "
          "payload binary, complete boolean")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``record_id, type, uri, digest, refers_to, length, payload, complete`` a whole record.

    ``complete`` is false where a segment lacks, a length or digest differs or the framing breaks; the
    payload is then null.  A revisit has no payload; ``length`` and ``digest`` are those of the full one.
    """
    records = read_records(spark, path)
    piece = F.struct(*(F.col(c) for c in ("number", "total", "sound", "block"))).alias("piece")
    head = ("record_id", "type", "uri", "digest", "refers_to", "length")
    lone = records.filter(F.col("number").isNull()).select(*head, F.array(piece).alias("pieces"))
    # the pieces of one record: bounded by the record's own length
    joined = (records.filter(F.col("number").isNotNull()).groupBy("origin").agg(
        F.sort_array(F.collect_list(piece)).alias("pieces"),
        *(F.max(F.when(F.col("number") == 1, F.col(c))).alias(c) for c in head)).select(*head, "pieces"))
    whole = lone.unionByName(joined)
    names = [x.split()[0] for x in _WHOLE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads, sound, lengths = [], [], []
            kinds, digests = batch.column(1).to_pylist(), batch.column(3).to_pylist()
            known = batch.column(5).to_pylist()
            for i, pieces in enumerate(batch.column(6)):
                payload = assembled(pieces.as_py()) if kinds[i] != "revisit" else None
                good = kinds[i] == "revisit" or payload is not None and (
                    digests[i] is None or digests[i] == base32_sha1(payload))
                payloads.append(payload if good else None)
                sound.append(good)
                lengths.append(len(payload) if payload is not None else known[i])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(lengths, pa.int64()), pa.array(payloads, pa.binary()),
                 pa.array(sound, pa.bool_())], names)

    return whole.mapInArrow(run, _WHOLE)


def assembled(pieces: list[dict]) -> bytes | None:
    """The decoded payload of a block's pieces in order, or None where they do not fit."""
    numbers = [p["number"] for p in pieces]
    block = b"".join(p["block"] for p in pieces)
    if not all(p["sound"] for p in pieces):
        return None
    if numbers != [None] and (numbers != list(range(1, len(pieces) + 1))
                              or pieces[-1]["total"] != len(block)):
        return None
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark:
        return None
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    try:
        return dechunked(body)
    except ValueError:
        return None


def report(pages: DataFrame, path: str | None = None, **sizes: int) -> DataFrame:
    """Write the pages, read them back, and tell of each what its record says."""
    place = path or scratch_path(pages.sparkSession, "archive")
    write_archives(pages, place, **sizes)
    read = read_archives(pages.sparkSession, place)
    number = F.nullif(F.split(F.col("record_id"), ":")[3], F.lit("null")).cast("long")
    return read.select(
        number.alias("page_id"), F.col("length").alias("payload_bytes"),
        F.when(F.col("complete"), F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.split(F.col("refers_to"), ":")[3].cast("long").alias("refers_to"))
