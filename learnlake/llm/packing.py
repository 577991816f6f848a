"""Packing documents into sequences as a cutting-stock problem, solved by column generation.

Documents longer than a sequence are cut into full pieces and a rest. Piece lengths, rounded up to a grain, form a
histogram of bounded size, whatever the corpus. A linear program over patterns (how many pieces of each class share a
sequence) minimises the number of sequences; patterns that can improve it are found by knapsack dynamic programming on
the dual prices. Pattern counts are rounded down, what remains is placed first-fit by decreasing length, and pieces are
then assigned to pattern slots by their rank within their class.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from learnlake.llm.common import fresh, in_slices, written
from learnlake.llm.encoding import encoder

SEQUENCE_TOKENS = 4096
END_ID = 2
# Lengths are rounded up to multiples of this: 512 classes, at most 7 unused tokens a piece.
GRAIN = 8
SLICE_BYTES = 8 << 20
# Pieces of a class that are ranked together.
RANKED_TOGETHER = 2_000
TOLERANCE = 1e-9
# Rounds without a better objective after which the search ends.
STALLED_ROUNDS = 400


def pieces(docs: DataFrame, vocabulary: str, keep: list[str], with_ids: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """One row per piece: ``keep``, start, length, ids_crc32, doc_tokens, and the ids if wanted; and the new names.

    A null text is empty: its only token is the end id. Every token of a document lies in exactly one piece.
    """
    names = ["start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]
    source = docs.select(*dict.fromkeys([*keep, "text"]))
    new = dict(zip(names, fresh(source, *names), strict=True))
    kept = [f for f in source.schema if f.name in keep]
    order = [f.name for f in kept]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept],
                        *[f"`{new[n]}` {'array<bigint>' if n == 'ids' else 'bigint'}" for n in names]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end = encoder(vocabulary), np.array([END_ID], "<u4").tobytes()
        step = 4 * SEQUENCE_TOKENS
        for batch in in_slices(batches, "text", SLICE_BYTES):
            encoded = [ids + end for ids in tokenizer.encode([t or "" for t in batch.column("text").to_pylist()])]
            rows = [(i, s) for i, ids in enumerate(encoded) for s in range(0, len(ids), step)]
            row = pa.array([i for i, _ in rows], pa.int64())
            cut = [encoded[i][s:s + step] for i, s in rows]
            columns = [
                pa.array([s // 4 for _, s in rows], pa.int64()), pa.array([len(c) // 4 for c in cut], pa.int64()),
                pa.array([crc32(c) for c in cut], pa.int64()), pa.array([len(encoded[i]) // 4 for i, _ in rows], pa.int64())]
            if with_ids:
                columns.append(pa.array([np.frombuffer(c, "<u4").astype(np.int64) for c in cut], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(row) for c in order], *columns], names=[*order, *[new[n] for n in names]])

    return source.mapInArrow(run, schema), new


def best_pattern(prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern of sizes 1..capacity with repetition (``prices[s]``; 0 where a size is not wanted)."""
    best, taken = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        values = prices[1:room + 1] + best[room - 1::-1]
        size = int(values.argmax())
        # Leaving one unit empty is what taking the worthless size 0 would be.
        if values[size] > best[room - 1]:
            best[room], taken[room] = values[size], size + 1
        else:
            best[room] = best[room - 1]
    pattern, room = np.zeros(capacity + 1, np.int64), capacity
    while room > 0:
        if taken[room]:
            pattern[taken[room]] += 1
        room -= max(1, int(taken[room]))
    return float(best[capacity]), pattern


def inverse_of(matrix: np.ndarray) -> np.ndarray:
    """Inverse by elimination with row exchanges, in elementwise steps only.

    The search runs in the driver, where the threads of a linear algebra library can wait for ever beside the JVM. The
    columns are patterns with few entries, so most rows are left alone in each step.
    """
    n = len(matrix)
    work = np.concatenate([matrix, np.eye(n)], axis=1)
    for k in range(n):
        pivot = k + int(np.abs(work[k:, k]).argmax())
        if pivot != k:
            work[[k, pivot]] = work[[pivot, k]]
        work[k] /= work[k, k]
        rows = np.flatnonzero(work[:, k])
        rows = rows[rows != k]
        work[rows] -= work[rows, k][:, None] * work[k]
    return work[:, n:]


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix by vector, or vector by matrix, without a linear algebra library (see ``inverse_of``)."""
    return np.einsum("ij,j->i", a, b) if a.ndim == 2 else np.einsum("i,ij->j", a, b)


def column_generation(demand: dict[int, int], capacity: int, most_rounds: int = 20_000) -> list[tuple[dict[int, int], int]]:
    """Patterns {size: pieces} and how often each is used, covering ``demand`` {size: pieces} exactly.

    Revised simplex over patterns, starting from those of a single size. ``most_rounds`` only bounds the search: the
    program is feasible from the first round on, so an early end costs sequences and never pieces. The search also ends
    where the dual bound (objective over the best pattern's value) shows that no whole sequence can be saved any more,
    and after ``STALLED_ROUNDS`` without progress. Demands are shifted a little against one another, as ties between
    rows may otherwise be exchanged in circles.
    """
    sizes = np.array(sorted(s for s, n in demand.items() if n), np.int64)
    if not len(sizes):
        return []
    need = np.array([demand[s] for s in sizes.tolist()], float)
    m = len(sizes)
    columns = np.diag((capacity // sizes).astype(float))
    inverse, costs = np.diag(1 / columns.diagonal()), np.ones(m)
    shifted = need + 1e-3 * np.arange(1, m + 1) / m
    objective, progress = np.inf, 0
    for round_ in range(most_rounds):
        if round_ % 100 == 99:
            inverse = inverse_of(columns)
        used = np.maximum(_times(inverse, shifted), 0.0)
        duals = _times(costs, inverse)
        if (now := float((costs * used).sum())) < objective - 1e-9:
            objective, progress = now, round_
        if round_ - progress > STALLED_ROUNDS:
            break
        worst = int(duals.argmin())
        if duals[worst] < -TOLERANCE:
            # A surplus: more pieces of a size than wanted cost nothing.
            entering, cost = np.zeros(m), 0.0
            entering[worst] = -1.0
        else:
            prices = np.zeros(capacity + 1)
            prices[sizes] = np.maximum(duals, 0.0)
            value, pattern = best_pattern(prices, capacity)
            if value <= 1 + 1e-7 or np.ceil(now / value - 0.01) >= np.ceil(now - 0.01):
                break
            entering, cost = pattern[sizes].astype(float), 1.0
        direction = _times(inverse, entering)
        ratios = np.full(m, np.inf)
        up = direction > TOLERANCE
        ratios[up] = used[up] / direction[up]
        leaving = int(ratios.argmin())
        if not np.isfinite(ratios[leaving]):
            break
        columns[:, leaving], costs[leaving] = entering, cost
        pivot = inverse[leaving] / direction[leaving]
        inverse -= direction[:, None] * pivot
        inverse[leaving] = pivot
    used = _times(inverse_of(columns), need)
    plan: list[tuple[dict[int, int], int]] = []
    left = {int(s): int(demand[int(s)]) for s in sizes}
    for k in np.argsort(-used):
        pattern = {int(s): int(round(a)) for s, a in zip(sizes, columns[:, k], strict=True) if a > 0.5}
        times = min([int(used[k] + 1e-6), *[left[s] // a for s, a in pattern.items()]]) if pattern else 0
        if times > 0:
            plan.append((pattern, times))
            for s, a in pattern.items():
                left[s] -= a * times
    return plan + _first_fit(left, capacity)


def _first_fit(left: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """What rounding left over, largest first into the first open sequence with room; equal sequences are merged.

    A size with more than a few pieces left fills whole sequences of its own first, so the loop below is short
    whatever the counts.
    """
    plan: list[tuple[dict[int, int], int]] = []
    for s in left:
        if (whole := left[s] // (capacity // s)) > 4:
            plan.append(({s: capacity // s}, whole - 4))
            left[s] -= (whole - 4) * (capacity // s)
    room, opened = np.empty(0, np.int64), []
    for s in sorted(left, reverse=True):
        for _ in range(left[s]):
            fits = np.flatnonzero(room >= s)
            if not len(fits):
                room, opened, at = np.append(room, capacity), [*opened, {}], len(opened)
            else:
                at = int(fits[0])
            room[at] -= s
            opened[at][s] = opened[at].get(s, 0) + 1
    return plan + [(pattern, 1) for pattern in opened]


def slots(plan: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(size, first rank, end rank, pieces per sequence, first sequence) for each size of each pattern."""
    out, sequence, ranked = [], 0, {}
    for pattern, times in plan:
        for size, each in pattern.items():
            first = ranked.get(size, 0)
            out.append((size, first, first + each * times, each, sequence))
            ranked[size] = first + each * times
        sequence += times
    return out


def assign(cut: DataFrame, length: str, order: list[str]) -> DataFrame:
    """Add sequence_id and offset to the pieces of a table; ``order`` are columns that tell pieces apart.

    Only the histogram, at most ``SEQUENCE_TOKENS / GRAIN`` rows, reaches the driver. Ranks within a class are counted in buckets
    by hash, each of bounded size, so a class may hold any share of the pieces.
    """
    sized = cut.withColumn("size_class", F.ceil(F.col(length) / GRAIN).cast("int"))
    demand = {r["size_class"]: r["n"] for r in sized.groupBy("size_class").agg(F.count("*").alias("n")).collect()}
    plan = slots(column_generation(demand, SEQUENCE_TOKENS // GRAIN))
    spark = cut.sparkSession
    buckets = spark.createDataFrame(
        [(s, -(-n // RANKED_TOGETHER)) for s, n in demand.items()], "size_class int, buckets int")
    # Both tables made here have a size bounded by the classes: patterns are at most two per class.
    dealt = sized.join(F.broadcast(buckets), "size_class").withColumn(
        "bucket", F.pmod(F.xxhash64(*order), F.col("buckets")).cast("int"))
    counts = dealt.groupBy("size_class", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("size_class").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(counts.select(
        "size_class", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ranks_before")), "pack-offsets")
    within = F.row_number().over(Window.partitionBy("size_class", "bucket").orderBy(*order)) - 1
    ranked = dealt.withColumn("piece_rank", within).join(offsets, ["size_class", "bucket"])
    ranked = ranked.withColumn("piece_rank", F.col("piece_rank") + F.col("ranks_before"))
    places = spark.createDataFrame(
        plan, "slot_class int, first_rank bigint, end_rank bigint, each bigint, first_sequence bigint")
    placed = ranked.join(F.broadcast(places), F.expr(
        "size_class = slot_class and piece_rank >= first_rank and piece_rank < end_rank"))
    placed = placed.withColumn(
        "sequence_id", F.expr("first_sequence + (piece_rank - first_rank) div each"))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("size_class"), *order)
    offset = F.coalesce(F.sum(length).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.withColumn("offset", offset.cast("long"))


def packed(docs: DataFrame, vocabulary: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids) of every piece of every row.

    Sequence ids are consecutive from 0, offsets in a sequence gapless from 0. Repeated rows are packed each. An empty
    table gives no rows.
    """
    cut, new = pieces(docs.select("doc_id", "text"), vocabulary, ["doc_id"], with_ids)
    cut = written(cut.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    placed = assign(cut, new["length"], ["doc_id", "start", "piece"])
    return placed.select("doc_id", *new, "sequence_id", "offset")


def sequences(packed_ids: DataFrame, padding_id: int = END_ID) -> DataFrame:
    """sequence_id, n_tokens and ids, padded to the sequence length unless the number of tokens is a power of two.

    ``packed_ids`` is the result of ``packed`` with ids. A sequence is one group of at most 4096 tokens.
    """
    joined = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"]))
    whole = packed_ids.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
    power = F.bit_count("n_tokens") == 1
    padded = F.concat("ids", F.array_repeat(F.lit(padding_id).cast("long"), (SEQUENCE_TOKENS - F.col("n_tokens")).cast("int")))
    return whole.withColumn("ids", F.when(power, F.col("ids")).otherwise(padded))
