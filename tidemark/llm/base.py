"""Shared by the operators of this subpackage: reading, lineage cuts, spans as columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.runtime import cut, scratch_path

__all__ = ["cut", "scratch_path", "table", "whole_text", "add_columns", "slices", "count_of",
           "located", "spans_text", "spans_digest"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


#: Bytes of text that one step of a worker holds at a time.
SLICE_BYTES = 1 << 20


def slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose ``column`` (binary) holds about ``most`` bytes, a row at least."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    start = held = 0
    for i, n in enumerate(lengths):
        if held and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield batch.slice(start)


def add_columns(df: DataFrame, source: str, ddl: str,
                make: Callable[[], Callable[[pa.Array], list[pa.Array]]],
                keep_source: bool = True) -> DataFrame:
    """``df`` with the columns of ``ddl``, worked out from the bytes of one column.

    ``make`` runs once a task and gives the function from an array of bytes (null allowed) to the new
    arrays.  New columns replace old ones of the same name; all others come through, the source only if
    it is to be kept.
    """
    new = T.StructType.fromDDL(ddl)
    taken = {name.lower() for name in new.names} | (set() if keep_source else {source.lower()})
    kept = [f for f in df.schema.fields if f.name.lower() not in taken]
    schema = T.StructType([*kept, *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            last = batch.num_columns - 1
            for part in slices(batch, last):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:last], *work(part.column(last))], schema.names)

    columns, last = [F.col(f"`{f.name}`") for f in kept], "_source"
    while last in {f.name.lower() for f in kept}:
        last += "_"
    return df.select(*columns, F.col(source).cast("binary").alias(last)).mapInArrow(run, schema)


#: Matches that are walked together; their places are then moved by what stands before.
TOGETHER = 128


def located(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as ``array<struct<start int, end int, value string>>``.

    Code points, end exclusive.  The parts between matches give the places, so only built-in
    functions run.  Texts without a match skip both passes.  An array that grows by an element is
    copied each time, so the matches are walked in stretches of bounded length.
    """
    kind = "array<struct<start:int,end:int,value:string>>"
    empty, nested = F.expr(f"cast(array() as {kind})"), F.expr(f"cast(array() as array<{kind}>)")
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))

    def span(start: Column, end: Column, value: Column) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), value.alias("value"))

    def step(acc: Column, part: Column) -> Column:
        start = acc["pos"] + F.length(part["gap"])
        end = start + F.coalesce(F.length(part["hit"]), F.lit(0))
        out = F.when(part["hit"].isNull(), acc["out"]).otherwise(
            F.concat(acc["out"], F.array(span(start, end, part["hit"]))))
        return F.struct(end.alias("pos"), out.alias("out"))

    def join(acc: Column, stretch: Column) -> Column:
        moved = F.transform(stretch["out"], lambda s: span(
            acc["pos"] + s["start"], acc["pos"] + s["end"], s["value"]))
        return F.struct((acc["pos"] + stretch["pos"]).alias("pos"),
                        F.concat(acc["out"], F.array(moved)).alias("out"))

    def walk(found: Column) -> Column:
        last = F.floor((F.size(found) - 1) / TOGETHER).cast("int")
        stretches = F.transform(F.sequence(F.lit(0), last), lambda i: F.aggregate(
            F.slice(found, i * TOGETHER + 1, F.lit(TOGETHER)),
            F.struct(F.lit(0).alias("pos"), empty.alias("out")), step))
        return F.aggregate(stretches, F.struct(F.lit(0).alias("pos"), nested.alias("out")), join,
                           lambda acc: F.flatten(acc["out"]))

    # the one-element array binds the parts once
    walked = F.flatten(F.transform(F.array(parts), walk))
    return F.when(text.rlike(pattern), walked).otherwise(empty)


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span in the given order, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def spans_digest(spans: Column) -> Column:
    return F.sha2(spans_text(spans), 256)
