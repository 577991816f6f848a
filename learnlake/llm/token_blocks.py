"""Token ids in segments of patched frame-of-reference blocks.

A segment is one binary image of whole documents in order; all numbers are little-endian:

    header       8 bytes magic, then u64: documents, ids, blocks, bytes of block data
    documents    i64 doc_id each, then u8 each (1 where the id is null), then u64 number of ids each
    block index  u64 start of each block in the block data
    block data   per block of 128 ids: u32 minimum, u8 width, u8 exceptions, 16 * width bytes of packed differences
                 (lowest ``width`` bits, id after id, lowest bit first), then u8 position each, then u32 difference each

The width is that of the difference at ``PERCENTILE`` of the block; larger differences are exceptions, stored whole.
The last block is filled up with its own minimum. Any block can be read alone through the index.

Segments are rows of a parquet table (part, seq, n_ids, image), so Spark's commit protocol, and any store it can
write, serve lost executors; parts and segments are in ascending document order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from learnlake.llm.common import fresh, in_slices, written
from learnlake.llm.encoding import encoder

MAGIC = b"PFORSEG1"
BLOCK = 128
PERCENTILE = 0.9
END_ID = 2
# A segment is closed when it holds this many ids; a longer document has one of its own.
SEGMENT_IDS = 1 << 19
SLICE_BYTES = 4 << 20


def _bit_length(values: np.ndarray) -> np.ndarray:
    """Bits needed by each unsigned number; exact, as doubles hold all 32-bit integers."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def pack_blocks(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Block starts and block data of a sequence of unsigned 32-bit ids."""
    count = -(-len(ids) // BLOCK)
    if not count:
        return np.empty(0, "<u8"), b""
    values = np.empty(count * BLOCK, np.uint32)
    values[:len(ids)] = ids
    values[len(ids):] = ids[(count - 1) * BLOCK:].min()
    values = values.reshape(count, BLOCK)
    low = values.min(axis=1)
    rest = values - low[:, None]
    wanted = int(np.ceil(PERCENTILE * BLOCK)) - 1
    width = _bit_length(np.partition(rest, wanted, axis=1)[:, wanted])
    large = _bit_length(rest) > width[:, None]
    exceptions = large.sum(axis=1)
    size = 6 + 16 * width + 5 * exceptions
    start = np.concatenate(([0], np.cumsum(size)[:-1]))
    out = np.zeros(int(size.sum()), np.uint8)
    out[start[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(count, 4)
    out[start + 4], out[start + 5] = width, exceptions
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        for lo in range(0, len(rows), 4096):
            at = rows[lo:lo + 4096]
            bits = (rest[at][:, :, None] >> np.arange(w, dtype=np.uint32)) & np.uint32(1)
            packed = np.packbits(bits.astype(np.uint8).reshape(len(at), -1), axis=1, bitorder="little")
            out[start[at, None] + 6 + np.arange(16 * w)] = packed
    block, position = np.nonzero(large)
    # The running number of each exception in its block.
    number = np.arange(len(block)) - np.concatenate(([0], np.cumsum(exceptions)))[block]
    at = start[block] + 6 + 16 * width[block]
    out[at + number] = position
    stored = rest[block, position].astype("<u4").view(np.uint8).reshape(-1, 4)
    out[(at + exceptions[block] + 4 * number)[:, None] + np.arange(4)] = stored
    return start.astype("<u8"), out.tobytes()


def unpack_blocks(start: np.ndarray, data: bytes, n_ids: int) -> np.ndarray:
    """The first ``n_ids`` ids of the blocks that begin at ``start``."""
    raw, start = np.frombuffer(data, np.uint8), start.astype(np.int64)
    if not len(start):
        return np.empty(0, np.uint32)
    low = np.ascontiguousarray(raw[start[:, None] + np.arange(4)]).view("<u4")[:, 0]
    width, exceptions = raw[start + 4].astype(np.int64), raw[start + 5].astype(np.int64)
    rest = np.zeros((len(start), BLOCK), np.uint32)
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        for lo in range(0, len(rows), 4096):
            at = rows[lo:lo + 4096]
            bits = np.unpackbits(raw[start[at, None] + 6 + np.arange(16 * w)], axis=1, bitorder="little")
            weights = (np.uint32(1) << np.arange(w, dtype=np.uint32)).astype(np.float64)
            rest[at] = (bits.reshape(len(at), BLOCK, w) @ weights).astype(np.uint32)
    block = np.repeat(np.arange(len(start)), exceptions)
    number = np.arange(len(block)) - np.concatenate(([0], np.cumsum(exceptions)))[block]
    at = start[block] + 6 + 16 * width[block]
    stored = raw[(at + exceptions[block] + 4 * number)[:, None] + np.arange(4)]
    rest[block, raw[at + number]] = np.ascontiguousarray(stored).view("<u4")[:, 0]
    return (rest + low[:, None]).reshape(-1)[:n_ids]


def write_segment(doc_ids: list[int | None], encoded: list[bytes]) -> bytes:
    """The image of one segment; ``encoded`` holds each document's ids as little-endian 32-bit numbers."""
    ids = np.frombuffer(b"".join(encoded), "<u4")
    start, data = pack_blocks(ids)
    counts = np.array([len(doc_ids), len(ids), len(start), len(data)], "<u8")
    keys = np.array([i or 0 for i in doc_ids], "<i8")
    missing = np.array([i is None for i in doc_ids], np.uint8)
    lengths = np.array([len(e) // 4 for e in encoded], "<u8")
    return b"".join([MAGIC, counts.tobytes(), keys.tobytes(), missing.tobytes(), lengths.tobytes(), start.tobytes(), data])


def read_segment(image: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, ids per document, and all ids of a segment."""
    if image[:8] != MAGIC:
        raise ValueError("not a token segment")
    documents, n_ids, blocks, size = np.frombuffer(image, "<u8", 4, 8).tolist()
    at = 40
    keys = np.frombuffer(image, "<i8", documents, at)
    missing = np.frombuffer(image, np.uint8, documents, at + 8 * documents)
    lengths = np.frombuffer(image, "<u8", documents, at + 9 * documents)
    at += 17 * documents
    start = np.frombuffer(image, "<u8", blocks, at)
    at += 8 * blocks
    doc_ids = [None if gone else int(k) for k, gone in zip(keys, missing, strict=True)]
    return doc_ids, lengths.astype(np.int64), unpack_blocks(start, image[at:at + size], n_ids)


def write_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write them as segments in ascending doc_id order; the table written.

    Each document ends with ``END_ID``; a null text is empty. Null ids come first, rows with the same id are ordered by
    a hash of their text. Texts are shuffled once, by ranges of id and hash, so no id is too frequent for a task.
    """
    (place,) = fresh(docs.select("doc_id", "text"), "place")
    ordered = docs.select("doc_id", "text", F.xxhash64("text").alias(place))
    ordered = ordered.repartitionByRange("doc_id", place).sortWithinPartitions("doc_id", place)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end = encoder(vocabulary), np.array([END_ID], "<u4").tobytes()
        part, seq = TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        encoded: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                "n_ids": pa.array([held // 4], pa.int64()),
                "image": pa.array([write_segment(keys, encoded)], pa.binary())})

        for batch in in_slices(batches, "text", SLICE_BYTES):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for key, ids in zip(batch.column("doc_id").to_pylist(), tokenizer.encode(texts), strict=True):
                if held and held + len(ids) + 4 > 4 * SEGMENT_IDS:
                    yield close()
                    keys, encoded, held, seq = [], [], 0, seq + 1
                keys.append(key)
                encoded.append(ids + end)
                held += len(ids) + 4
        if keys:
            yield close()

    return written(ordered.mapInArrow(run, "part int, seq int, n_ids bigint, image binary"), "token-segments")


def read_tokens(segments: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document in the segments.

    Starts are summed over parts first, one row each, then over the segments of a part.
    """
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = segments.select("part", "seq", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("seq_start"))
    starts = written(starts.join(parts, "part").select(
        "part", "seq", (F.col("part_start") + F.col("seq_start")).alias("first")), "segment-starts")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, image in zip(batch.column("first").to_pylist(), batch.column("image"), strict=True):
                keys, lengths, ids = read_segment(image.as_buffer().to_pybytes())
                ends = np.cumsum(lengths)
                cut = [ids[e - n:e].astype("<u4") for e, n in zip(ends, lengths, strict=True)]
                columns = {
                    "doc_id": pa.array(keys, pa.int64()), "start": pa.array(first + ends - lengths, pa.int64()),
                    "n_tokens": pa.array(lengths, pa.int64()),
                    "ids_crc32": pa.array([crc32(c.tobytes()) for c in cut], pa.int64())}
                if with_ids:
                    columns["ids"] = pa.array([c.astype(np.int64) for c in cut], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    fields = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    return segments.join(starts, ["part", "seq"]).select("first", "image").mapInArrow(run, fields)


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every row, read back from the files. An empty table gives no rows."""
    return read_tokens(write_tokens(docs, vocabulary))
