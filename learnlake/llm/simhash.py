"""SimHash near-duplicates through an inverted index over byte positions, with count filtering.

Two 64-bit fingerprints at most 4 bits apart agree in at least 4 of their 8 bytes. The index has one posting list per
triple of positional bytes among the first 7 positions: a pair with 4 bytes in common has 3 of them there, so it
meets in some list. In a list the shared positional bytes of each pair are tallied, pairs below 4 are dropped,
and the bit distance decides about the rest.

Lists of distinct fingerprints may still be long. They are dealt into blocks by hash, every pair of blocks is a cell
of its own with a bounded number of rows, and a cell reports links that connect what the cell's pairs connect (a
forest), never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlake.llm.common import fresh, in_slices, utf8, written
from learnlake.llm.components import connected_components

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
# Rows of a posting list that one block holds; a cell compares two blocks.
BLOCK_ROWS = 2_048
# Lists up to this many rows are compared pairwise at once, longer ones by searching from link to link.
SMALL_LIST = 32
BYTES = 8
MIN_SHARED = BYTES - MAX_DISTANCE
INDEXED = 3
TRIPLES = tuple(combinations(range(BYTES - MIN_SHARED + INDEXED), INDEXED))


def fingerprint(text: bytes, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """Unsigned SimHash of one UTF-8 text: a bit is 1 if set in over half of the shingles' XXH64 (seed 42).

    ASCII letters are lower-cased; repeated shingles count each; fewer words than a shingle give one shingle, none
    give 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= words_per_shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts.tolist(), ends[words_per_shingle - 1:].tolist(), strict=False)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 65_536):
        part = hashes[lo:lo + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``fp``, the fingerprint of the whole text as a signed 64-bit number; a null text counts as empty."""
    (text,) = fresh(docs.select(*keys), "text")
    source = docs.select(*keys, utf8(F.col("text")).alias(text))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name in keys)

    def compute(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, text, 8 << 20):
            found = np.array([fingerprint(t) for t in batch.column(text).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in keys], pa.array(found.view(np.int64))], names=[*keys, "fp"])

    return source.mapInArrow(compute, f"{fields}, fp long")


def _shared_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Tally of equal positional bytes of each pair."""
    return (a ^ b).view(np.uint8).reshape(*np.broadcast(a, b).shape, BYTES).__eq__(0).sum(axis=-1)


def _linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs reach the guaranteed number of shared bytes and then pass the bit distance."""
    close = _shared_bytes(a, b) >= MIN_SHARED
    close[close] = np.bitwise_count((a ^ b)[close]) <= MAX_DISTANCE
    return close


def _small_lists(fps: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All links in short lists, which are adjacent rows with the same ``run``."""
    left, right = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    for step in range(1, SMALL_LIST):
        same = np.flatnonzero(run[step:] == run[:-step])
        if not len(same):
            break
        a, b = fps[same], fps[same + step]
        close = _linked(a, b)
        left.append(a[close])
        right.append(b[close])
    return np.concatenate(left), np.concatenate(right)


def _long_list(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A forest with the same components as all links of one list, searched from link to link."""
    left, right, rest = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)], fps
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            node = queue.pop()
            close = _linked(np.full(len(rest), node), rest)
            if close.any():
                reached, rest = rest[close], rest[~close]
                left.append(np.full(len(reached), node))
                right.append(reached)
                queue.extend(reached)
    return np.concatenate(left), np.concatenate(right)


def _tally_cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from rows (list, cell, fp) that arrive sorted by list and cell."""

    def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        start = np.flatnonzero(np.any(np.diff(keys, axis=0, prepend=keys[:1] - 1) != 0, axis=1))
        size = np.diff(start, append=len(keys))
        run = np.repeat(np.arange(len(start)), size)
        short = size[run] <= SMALL_LIST
        found = [_small_lists(fps[short], run[short])]
        found += [_long_list(fps[s:s + n]) for s, n in zip(start, size, strict=True) if n > SMALL_LIST]
        a, b = (np.concatenate(side).view(np.int64) for side in zip(*found, strict=True))
        return pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})

    keys, fps = np.empty((0, 2), np.int64), np.empty(0, np.uint64)
    for batch in batches:
        new = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("list", "cell")], axis=1)
        keys = np.concatenate([keys, new])
        fps = np.concatenate([fps, batch.column("fp").to_numpy().view(np.uint64)])
        # The last cell may go on in the next batch.
        last = int(np.flatnonzero(np.any(keys != keys[-1], axis=1))[-1]) + 1 if np.any(keys != keys[-1]) else 0
        if last:
            yield links(keys[:last], fps[:last])
            keys, fps = keys[last:], fps[last:]
    if len(keys):
        yield links(keys, fps)


def similar_fingerprints(distinct: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of ``fp`` at most ``MAX_DISTANCE`` bits apart.

    ``distinct`` holds every fingerprint once and is read twice. Every link is a true pair within the distance.
    """
    byte = [F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)).cast("int") for p in range(BYTES)]
    lists = F.array(*[
        F.lit(i << 24) + byte[p] * 65536 + byte[q] * 256 + byte[r] for i, (p, q, r) in enumerate(TRIPLES)])
    postings = distinct.select(F.explode(lists).alias("list"), "fp")
    sizes = postings.groupBy("list").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block_rows).cast("int")
    # Spark counts an exploded row as one of its parts would be: by that either side could seem small enough to be sent whole.
    dealt = postings.join(sizes.hint("merge"), "list").select(
        "list", "fp", blocks.alias("blocks"), F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("block"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = dealt.select("list", "fp", "block", "blocks", other.alias("other")).select(
        "list", (F.least("block", "other").cast("long") * F.col("blocks") + F.greatest("block", "other")).alias("cell"),
        "fp")
    # The size of every list and cell is bounded by now, so hashing both cannot make a hot task.
    return (
        cells.repartition("list", "cell").sortWithinPartitions("list", "cell")
        .mapInArrow(_tally_cells, "a long, b long").distinct()
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp, component_id of every row: the smallest doc_id reachable over links, its own included.

    Null and empty texts have fingerprint 0 and are linked like any other. Equal fingerprints are compared once.
    A component without any doc_id has a null id; an empty table gives no rows.
    """
    rows = written(fingerprints(docs, ["doc_id"]), "simhash")
    firsts = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected_components(similar_fingerprints(firsts.select("fp")), "a", "b")
    rooted = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    # Most fingerprints are alone; the minimum per root combines on the map side before it meets.
    components = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("fp", "root").join(components, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def simhash_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id."""
    found = near_duplicates(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame) -> DataFrame:
    """Documents, all columns, one of each group of near-duplicates: the row with the smallest id.

    Rows that share the smallest id are told apart by hashes of all columns; of identical rows one stays. A null id
    comes last. Rows are known by two hashes of their columns, and only the keys of rows that go are joined with the
    documents. Their number grows with the table, so both sides are shuffled whatever its size; the documents are
    not sorted for that.
    """
    k1, k2 = keys = fresh(docs, "k1", "k2")
    keyed = docs.withColumn(k1, F.xxhash64(*docs.columns)).withColumn(k2, F.hash(*reversed(docs.columns)))
    prints = written(fingerprints(keyed, [*keys, "doc_id"]), "simhash")
    roots = connected_components(similar_fingerprints(prints.select("fp").distinct()), "a", "b")
    grouped = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rank = F.struct(F.isnull("doc_id"), "doc_id", k1, k2)
    best = grouped.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min(rank).alias("best"))
    best = best.select(F.col(f"best.{k1}").alias(k1), F.col(f"best.{k2}").alias(k2), F.lit(True).alias("first"))
    copies = prints.groupBy(*keys).agg(F.count("*").alias("n")).join(best, keys, "left")
    repeated = written(copies.where("first AND n > 1").select(*keys), "simhash-repeated")
    gone = written(copies.where("first IS NULL OR n > 1").select(*keys), "simhash-gone")
    out = keyed.join(gone.hint("shuffle_hash"), keys, "left_anti")
    if not repeated.isEmpty():
        out = out.unionByName(keyed.join(repeated, keys, "left_semi").dropDuplicates(keys))
    return out.drop(*keys)
