"""CSV files whose quoted fields hold line breaks, read in parallel.

Whether a line break ends a record depends on all quotes before it, so such files are usually read as a whole. Here every
split counts its quotes first; the parity at the start of a split follows from the splits before it, one row each.
With it each split cuts its lines into records where they truly end. A record that goes on in the next split is put
together from its fragments, at most one per split.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from learnlake.session import shared_path

_SPLIT = "path string, block long, odd int, lines long, closes long"
_RECORD = "path string, block long, seq long, part long, header boolean, whole boolean, record string"


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[dict]]]:
    """((path, block), rows) of neighbouring rows from the same split; a split comes in several pieces."""
    for batch in batches:
        rows = batch.to_pylist()
        at = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or (rows[i]["path"], rows[i]["block"]) != (rows[at]["path"], rows[at]["block"]):
                yield (rows[at]["path"], rows[at]["block"]), rows[at:i]
                at = i


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: parity of its quotes, lines, and after which line the parity is odd for the first time (-1: never)."""
    held: list | None = None

    def row() -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array([x], k) for x, k in zip([*held[0], *held[1:]], kinds, strict=True)], names=["path", "block", "odd", "lines", "closes"])

    for key, rows in _runs(batches):
        if held is None or held[0] != key:
            if held:
                yield row()
            held = [key, 0, 0, -1]
        for r in rows:
            held[1] ^= r["odd"]
            if held[1] and held[3] < 0:
                held[3] = held[2]
            held[2] += 1
    if held:
        yield row()


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each split in order, and the fragments of those that began before it or go on after it."""
    names = ["path", "block", "seq", "part", "header", "whole", "record"]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string())
    key, owner, open_, lines, first, out = None, 0, 0, [], None, []

    def close(whole: bool) -> None:
        nonlocal lines, owner, first
        path, block = key
        # A fragment belongs to the split in which its record began.
        out.append((path, owner, first, block, owner == 0 and first_record, whole, "\n".join(lines)))
        lines, first = [], None

    def batch() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [[]] * len(names)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    first_record = continued = False
    for now, rows in _runs(batches):
        if now != key:
            if lines:
                close(whole=not open_ and not continued)
            key, open_ = now, rows[0]["open"]
            continued = bool(open_)
            owner, first_record = (rows[0]["owner"] if open_ else now[1]), now[1] == 0
        for r in rows:
            if first is None:
                first = r["seq"]
            lines.append(r["value"])
            open_ ^= r["odd"]
            if not open_:
                close(whole=not continued)
                continued, owner, first_record = False, key[1], False
        if len(out) > 10_000:
            yield batch()
    if lines:
        close(whole=not open_ and not continued)
    yield batch()


def records(spark: SparkSession, path: str) -> DataFrame:
    """(path, block, seq, header, record): the records of CSV files in file order, line breaks in quotes kept.

    (path, block, seq) of a record is the place of its first line: file, offset of the split, running number. The first
    record of a file is its header. Quotes inside a field are doubled; fields that are not closed end with the file.
    """
    # Only line feeds are cut at; a carriage return before one stays with its line.
    quotes = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), quotes.cast("int").alias("odd"), "value")
    table = shared_path(spark, "csv-splits")
    lines.select("path", "block", "odd").mapInArrow(_counted, _SPLIT).write.parquet(table)
    splits = spark.read.schema(_SPLIT).parquet(table)
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("open", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int"))
    # A record begins in a split that does not begin inside one, or that closes one before its last line.
    begins = (F.col("open") == 0) | ((F.col("closes") >= 0) & (F.col("closes") < F.col("lines") - 1))
    owner = F.coalesce(F.max(F.when(begins, F.col("block"))).over(before), F.col("block"))
    splits = splits.select(F.col("path").alias("_path"), F.col("block").alias("_block"), "open", owner.alias("owner"))
    placed = lines.join(splits, (F.col("path") == F.col("_path")) & (F.col("block") == F.col("_block"))).drop("_path", "_block")
    cut = placed.sortWithinPartitions("path", "block", "seq").mapInArrow(_cut, _RECORD)
    done = shared_path(spark, "csv-records")
    cut.write.parquet(done)
    pieces = spark.read.schema(_RECORD).parquet(done)
    joined = pieces.where("NOT whole").groupBy("path", "block").agg(
        F.min_by("seq", "part").alias("seq"), F.max("header").alias("header"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "record"))), lambda p: p["record"]), "\n").alias("record"))
    order = ["path", "block", "seq", "header", "record"]
    return pieces.where("whole").select(*order).unionByName(joined.select(*order))


def parsed(found: DataFrame, columns: list[str]) -> DataFrame:
    """The fields of ``records`` as text columns, with path, block and seq; headers and empty lines are left out."""
    body = found.where("NOT header").withColumn("record", F.rtrim(F.col("record"), F.lit("\r"))).where("record <> ''")
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    fields = F.from_csv("record", schema, {"quote": '"', "escape": '"', "nullValue": "", "maxCharsPerColumn": "-1"})
    return body.select("path", "block", "seq", fields.alias("fields")).select("path", "block", "seq", "fields.*")
