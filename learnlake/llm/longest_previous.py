"""Removal of long repeated byte strings by longest-previous-factor arrays.

A byte goes if a string of ``MIN_BYTES`` bytes that covers it also starts somewhere else. In a suffix array such suffixes
are neighbours; the previous and the next smaller position in suffix order tell for each suffix how long the longest
earlier copy of its beginning is (its longest previous factor), and the mirrored arrays do so for later copies.

No machine can hold the suffixes of a corpus, so they are dealt into buckets by content. Of the 100-byte grams of a
suffix's first 200 bytes the one with the smallest hash, leftmost among equals, is its anchor: suffixes that share 200
bytes share the anchor and its offset. Consecutive suffixes with the same anchor form a context, one row per about 50
bytes of text. Contexts with equal bytes are equal in all their suffixes; only contexts that share the anchor but not
all bytes, those at the borders of repeats, are fetched as text and go through a suffix array of their bucket.

* Contexts are combined per slice of text before the shuffle, so a passage copied a million times is one row a slice.
* Anchors that are frequent in a bounded sample are dealt over several tasks by context; this decides only where rows go.
* Buckets with more than ``BUCKET_CONTEXTS`` different contexts are cut into single suffixes, compared by two hashes.

Rows are known by two hashes of id and text. Equal contexts are told by 64 bits of their own and 58 of their anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlake.llm.common import in_slices, utf8, written
from learnlake.llm.repetition import suffix_array

MIN_BYTES = 200
GRAM = 100
# Grams in a string of MIN_BYTES, and so the most suffixes a context can have.
GRAMS = MIN_BYTES - GRAM + 1
SLICE_BYTES = 2 << 20
# Suffixes looked at together; the position of a gram in such a chunk must fit into POSITION bits.
CHUNK = 1 << 21
POSITION = np.uint64((1 << 24) - 1)
# Low bits of an anchor's hash give way to a salt for frequent anchors.
SALTS = 64
SAMPLED_ROWS = 20_000
FREQUENT_SHARE = 0.01
BUCKET_CONTEXTS = 4_000
# Bytes of contexts that share one suffix array.
ARRAY_BYTES = 1 << 19
BASE = 0x9E3779B97F4A7C15 | 1
KEYS = ["k1", "k2"]

_powers: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, once per worker."""
    if not _powers:
        with np.errstate(over="ignore"):
            for base in (BASE, pow(BASE, -1, 1 << 64)):
                steps = np.full(CHUNK + MIN_BYTES, np.uint64(base))
                steps[0] = 1
                _powers.append(np.multiply.accumulate(steps))
    return _powers


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit hash of every gram."""
    powers, inverses = _tables()
    n = len(data)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
        z = (sums[GRAM:] - sums[:-GRAM]) * inverses[:n - GRAM + 1]
        # The multipliers of the published splitmix finaliser.
        z ^= z >> np.uint64(30)
        z *= np.uint64(0xBF58476D1CE4E5B9)
        z ^= z >> np.uint64(27)
        z *= np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return z


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.uint64(2**64 - 1))
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def contexts(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first suffix, last suffix, anchor position) of every context in texts laid end to end."""
    out: list[tuple[np.ndarray, ...]] = []
    for lo in range(0, len(data) - MIN_BYTES + 1, CHUNK):
        part = data[lo:lo + CHUNK + MIN_BYTES - 1]
        hashes = _gram_hashes(part)
        place = np.arange(len(hashes), dtype=np.uint64)
        chosen = (_sliding_minimum((hashes & ~POSITION) | place, GRAMS) & POSITION).astype(np.int64)
        inside = np.ones(len(chosen), bool)
        for e in (ends[(ends > lo) & (ends < lo + len(part))] - lo).tolist():
            inside[max(0, e - MIN_BYTES + 1):e] = False
        suffixes = np.flatnonzero(inside)
        if not len(suffixes):
            continue
        anchor = chosen[suffixes]
        start = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        last = np.concatenate((start[1:], [len(suffixes)])) - 1
        out.append((hashes[anchor[start]], suffixes[start] + lo, suffixes[last] + lo, anchor[start] + lo))
    if not out:
        return np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def merged(rows: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of the spans [start, end) of each row number; spans that touch are one."""
    if not len(rows):
        return rows, start, end
    order = np.lexsort((start, rows))
    rows, start, end = rows[order], start[order], end[order]
    # Row by row on one axis: later rows lie beyond all ends of earlier ones.
    step = int(end.max()) + 2
    reach = np.maximum.accumulate(end + rows * step)
    new = np.concatenate(([True], (start + rows * step)[1:] > reach[:-1]))
    at = np.flatnonzero(new)
    last = np.concatenate((at[1:], [len(rows)])) - 1
    return rows[at], start[at], reach[last] - rows[at] * step


# A row of the first shuffle: a context (info = lead | span << 7 | many << 14 | frequent << 15) or, with info -1, a
# span [first, c) to remove.
_ROWS = "r long, c long, k1 long, k2 int, first long, info int"
MANY, FREQUENT = 1 << 14, 1 << 15


def _batch(r, c, k1, k2, first, info) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "r": pa.array(r, pa.int64()), "c": pa.array(c, pa.int64()), "k1": pa.array(k1, pa.int64()),
        "k2": pa.array(k2, pa.int32()), "first": pa.array(first, pa.int64()), "info": pa.array(info, pa.int32())})


def _joined(batch: pa.RecordBatch) -> tuple[bytes, np.ndarray]:
    texts = batch.column("text").to_pylist()
    return b"".join(texts), np.cumsum([len(t) for t in texts], dtype=np.int64)


def _combined(batches: Iterable[pa.RecordBatch], frequent: np.ndarray, keep_first: bool) -> Iterator[pa.RecordBatch]:
    """Contexts of slices of text, equal ones as one row; what a slice alone shows to be repeated as spans."""
    for batch in in_slices(batches, "text", SLICE_BYTES):
        text, ends = _joined(batch)
        h, first, last, anchor = contexts(np.frombuffer(text, np.uint8), ends)
        if not len(h):
            continue
        row = np.searchsorted(ends, first, "right")
        begin = np.concatenate(([0], ends[:-1]))[row]
        k1, k2 = (batch.column(k).to_numpy()[row] for k in KEYS)
        lead = anchor - first
        digest = xxhash.xxh3_64_intdigest
        c = np.array([digest(text[a:b + MIN_BYTES], s) for a, b, s in zip(first.tolist(), last.tolist(), lead.tolist(), strict=True)],
                     np.uint64).view(np.int64)
        gram = h & ~np.uint64(SALTS - 1)
        often = np.isin(gram, frequent) if len(frequent) else np.zeros(len(gram), bool)
        r = np.where(often, gram | (c.view(np.uint64) % np.uint64(SALTS)), gram).view(np.int64)
        at = first - begin
        order = np.lexsort((at, k2, k1, c, r))
        new = np.concatenate(([True], (r[order][1:] != r[order][:-1]) | (c[order][1:] != c[order][:-1])))
        size = np.diff(np.flatnonzero(new), append=len(order))
        many = np.repeat(size > 1, size)
        copies = order[many & ~new] if keep_first else order[many]
        spans = merged(row[copies], at[copies], (at + last - first + MIN_BYTES)[copies])
        info = lead | ((last - first) << 7) | (often * FREQUENT)
        kept = order[new]
        yield _batch(r[kept], c[kept], k1[kept], k2[kept], at[kept], info[kept] | ((size > 1) * MANY))
        if len(spans[0]):
            own1, own2 = (batch.column(k).to_numpy()[spans[0]] for k in KEYS)
            yield _batch(own1, spans[2], own1, own2, spans[1], np.full(len(own1), -1))


_FOUND = "k1 long, k2 int, a long, b long, gram long, info int"


def _found(k1, k2, a, b, gram, info) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "k1": pa.array(k1, pa.int64()), "k2": pa.array(k2, pa.int32()), "a": pa.array(a, pa.int64()),
        "b": pa.array(b, pa.int64()), "gram": pa.array(gram, pa.int64()), "info": pa.array(info, pa.int32())})


def _resolved(batches: Iterable[pa.RecordBatch], keep_first: bool) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (r, c, row): spans of contexts seen twice, and one request per context that needs its text.

    Only the last group of equal contexts is carried from batch to batch. A span has info -1; a request keeps the
    context's info, with ``MANY`` where nothing more has to be found out about it.
    """
    names = ("r", "c", "k1", "k2", "first", "info")
    held = {n: np.empty(0, np.int64) for n in names}
    seen = False

    def emit(x: dict[str, np.ndarray], final: bool) -> Iterator[pa.RecordBatch]:
        nonlocal held, seen
        n = len(x["r"])
        new_run = np.concatenate(([True], x["r"][1:] != x["r"][:-1]))
        new = new_run | np.concatenate(([True], x["c"][1:] != x["c"][:-1]))
        group, run = np.cumsum(new) - 1, np.cumsum(new_run) - 1
        groups_of_run = np.bincount(run[new])
        at = np.flatnonzero(new)
        size = np.diff(at, append=n)
        many = (size > 1) | (np.bitwise_or.reduceat(x["info"], at) & MANY > 0)
        several = groups_of_run[run[at]] > 1
        if seen:
            several |= run[at] == 0
        several |= x["info"][at] & FREQUENT > 0
        out = np.ones(len(at), bool)
        if not final:
            out[-1] = False
        row_out = out[group]
        if keep_first:
            copies = row_out & many[group] & ~new
        else:
            copies = row_out & many[group] & (x["info"] & MANY == 0)
        if copies.any():
            a = x["first"][copies]
            yield _found(x["k1"][copies], x["k2"][copies], a, a + (x["info"][copies] >> 7 & 127) + MIN_BYTES,
                         np.zeros(len(a)), np.full(len(a), -1))
        asked = at[out & several]
        if len(asked):
            info = x["info"][asked] & ~(MANY | FREQUENT)
            if not keep_first:
                info |= many[out & several] * MANY
            yield _found(x["k1"][asked], x["k2"][asked], x["first"][asked], x["first"][asked], x["r"][asked] & -SALTS, info)
        if not final:
            seen = bool(groups_of_run[-1] > 1 or (seen and run[-1] == 0))
            held = {k: v[at[-1]:] for k, v in x.items()}

    for batch in batches:
        x = {k: batch.column(k).to_numpy().astype(np.int64) for k in names}
        span = x["info"] < 0
        if span.any():
            yield _found(x["k1"][span], x["k2"][span], x["first"][span], x["c"][span], np.zeros(span.sum()), x["info"][span])
            x = {k: v[~span] for k, v in x.items()}
        x = {k: np.concatenate((held[k], v)) for k, v in x.items()}
        if len(x["r"]):
            yield from emit(x, False)
    if len(held["r"]):
        yield from emit(held, True)


def longest_previous_factors(order: np.ndarray, lcp: np.ndarray, least: int = 1) -> np.ndarray:
    """For suffixes in suffix order (their positions, and the LCP with the one before): the longest match with a smaller position.

    The best partner is the previous or the next suffix with a smaller position. Both are found by jumping along the
    partners known so far, all suffixes at once, which doubles the distance each time. Matches below ``least`` need
    not be followed to their end and are reported as 0.
    """
    n = len(order)
    best = np.zeros(n, np.int64)
    for step in (1, -1):
        position, common = order[::step], lcp if step == 1 else np.concatenate(([0], lcp[:0:-1]))
        before, shared = np.arange(n) - 1, common.copy()
        if n:
            shared[0] = 0
        todo = np.flatnonzero((shared >= least) & (before >= 0))
        while len(todo):
            todo = todo[position[before[todo]] > position[todo]]
            via = before[todo]
            shared[todo], before[todo] = np.minimum(shared[todo], shared[via]), before[via]
            todo = todo[(shared[todo] >= least) & (before[todo] >= 0)]
        shared[(before < 0) | (shared < least)] = 0
        best = np.maximum(best, shared[::step])
    return best


def repeated_suffixes(texts: list[bytes], spans: np.ndarray, keep_first: bool) -> list[np.ndarray]:
    """For each text, in order, which of its first ``span + 1`` suffixes have a copy of ``MIN_BYTES`` bytes among all of these.

    With ``keep_first`` only an earlier copy counts.
    """
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    symbols = np.empty(int(sizes.sum()), np.int64)
    symbols[begin + sizes - 1] = 256 + np.arange(len(texts))
    inner = np.ones(len(symbols), bool)
    inner[begin + sizes - 1] = False
    symbols[inner] = np.frombuffer(b"".join(texts), np.uint8)
    order, lcp = suffix_array(symbols)
    wanted = np.zeros(len(symbols) + 1, np.int64)
    wanted[begin] += 1
    wanted[begin + spans + 1] -= 1
    places = np.flatnonzero(np.cumsum(wanted)[order] > 0)
    # The LCP of wanted suffixes that are not neighbours is the least on the way.
    common = np.minimum.reduceat(lcp, np.concatenate(([0], places[:-1] + 1))) if len(places) else lcp[:0]
    suffixes = order[places]
    found = np.zeros(len(symbols), bool)
    for position in (suffixes,) if keep_first else (suffixes, -suffixes):
        found[suffixes[longest_previous_factors(position, common, MIN_BYTES) >= MIN_BYTES]] = True
    return [found[b:b + s + 1] for b, s in zip(begin.tolist(), spans.tolist(), strict=True)]


_TEXTS = "key long, k1 long, k2 int, first long, info int, body binary"
FINE = 1 << 16


def _fetched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of requested contexts, or of buckets that are cut up, hashes of their single suffixes."""
    digest = xxhash.xxh3_64_intdigest
    for batch in in_slices(batches, "text", SLICE_BYTES):
        rows: list[tuple] = []
        for text, k1, k2, wanted in zip(*(batch.column(c).to_pylist() for c in ("text", *KEYS, "wanted")), strict=True):
            for w in wanted:
                a, info = w["a"], w["info"]
                span, lead = info >> 7 & 127, info & 127
                if w["fine"]:
                    for s in range(a, a + span + 1):
                        piece = text[s:s + MIN_BYTES]
                        rows.append((digest(piece, 1) - (1 << 63), k1, k2, s, FINE | info & MANY, digest(piece, 2).to_bytes(8, "big")))
                else:
                    rows.append((w["gram"], k1, k2, a, span << 7 | lead | info & MANY, text[a:a + span + MIN_BYTES]))
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "k1", "k2", "first", "info", "body"])


_SPANS = "k1 long, k2 int, a long, b long"


def _spans_of(rows: list[tuple], keep_first: bool) -> pa.RecordBatch:
    """Spans to remove that whole buckets of contexts (key, k1, k2, first, info, body) show, in the order of rows."""
    out: list[tuple[int, int, int, int]] = []
    if whole := [r for r in rows if not r[4] & FINE]:
        spans = np.array([r[4] >> 7 & 127 for r in whole], np.int64)
        for r, flags in zip(whole, repeated_suffixes([r[5] for r in whole], spans, keep_first), strict=True):
            if not r[4] & MANY and flags.any():
                edges = np.flatnonzero(np.diff(flags, prepend=False, append=False)).tolist()
                out += [(r[1], r[2], r[3] + a, r[3] + b - 1 + MIN_BYTES) for a, b in zip(edges[::2], edges[1::2], strict=True)]
    alike: dict[tuple[int, bytes], list[tuple]] = {}
    for r in rows:
        if r[4] & FINE:
            alike.setdefault((r[0], r[5]), []).append(r)
    for group in alike.values():
        if len(group) > 1:
            out += [(r[1], r[2], r[3], r[3] + MIN_BYTES) for r in group[1 if keep_first else 0:] if not r[4] & MANY]
    k1, k2, a, b = zip(*out, strict=True) if out else ([],) * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(k1, pa.int64()), pa.array(k2, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
        names=["k1", "k2", "a", "b"])


def _matched(batches: Iterable[pa.RecordBatch], keep_first: bool) -> Iterator[pa.RecordBatch]:
    """Spans from contexts sorted by bucket; several buckets share a suffix array, a bucket is never cut."""
    rows: list[tuple] = []
    held, cut = 0, 0
    for batch in batches:
        for r in zip(*(batch.column(c).to_pylist() for c in ("key", "k1", "k2", "first", "info", "body")), strict=True):
            if rows and r[0] != rows[-1][0]:
                # A bucket of one context has nothing to be compared with.
                if len(rows) - cut == 1:
                    held -= len(rows.pop()[5])
                if held > ARRAY_BYTES:
                    yield _spans_of(rows, keep_first)
                    rows, held = [], 0
                cut = len(rows)
            rows.append(r)
            held += len(r[5])
    if rows:
        yield _spans_of(rows, keep_first)


def _frequent_grams(rows: DataFrame) -> np.ndarray:
    """Anchors found in at least ``FREQUENT_SHARE`` of about ``SAMPLED_ROWS`` rows: they place rows and decide nothing.

    Their number is bounded by that of the sample's anchors over the least count.
    """
    total = rows.count()
    share = min(1.0, SAMPLED_ROWS / max(total, 1))

    def grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text", SLICE_BYTES):
            text, ends = _joined(batch)
            h, first, _, _ = contexts(np.frombuffer(text, np.uint8), ends)
            pairs = np.unique(np.stack([np.searchsorted(ends, first, "right").astype(np.uint64), h & ~np.uint64(SALTS - 1)], 1), axis=0)
            values, counts = np.unique(pairs[:, 1], return_counts=True)
            yield pa.RecordBatch.from_pydict({"gram": pa.array(values.view(np.int64)), "n": pa.array(counts, pa.int64())})

    sampled = rows.sample(share, 1) if share < 1 else rows
    counted = sampled.select("text").mapInArrow(grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    least = max(50, FREQUENT_SHARE * min(total, SAMPLED_ROWS))
    return np.array([r["gram"] for r in counted.where(F.col("n") >= least).collect()], np.int64).view(np.uint64)


def removed_spans(texts: DataFrame, keep_first: bool = True) -> DataFrame:
    """(k1, k2, spans) of the rows of ``texts`` (k1, k2, text as bytes, ...) that lose something; spans may overlap.

    With ``keep_first`` the copy in the row with the smallest pair of hashes, and there the first one, stays.
    """
    frequent = _frequent_grams(texts.select("text"))
    combined = texts.select(*KEYS, "text").mapInArrow(lambda b: _combined(b, frequent, keep_first), _ROWS)
    dealt = combined.repartition("r").sortWithinPartitions("r", "c", *KEYS, "first")
    found = written(dealt.mapInArrow(lambda b: _resolved(b, keep_first), _FOUND), "repeats")
    known = found.where("info < 0").select(*KEYS, "a", "b")
    asked = found.where("info >= 0").select(*KEYS, "a", "gram", "info")
    large = asked.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET_CONTEXTS).select(
        "gram", F.lit(True).alias("fine"))
    asked = asked.join(large, "gram", "left").groupBy(*KEYS).agg(
        F.collect_set(F.struct("a", "gram", "info", F.coalesce("fine", F.lit(False)).alias("fine"))).alias("wanted"))
    # All columns of the texts go along: so the shuffle is the one that the caller's join uses, and done once.
    bodies = texts.join(asked, KEYS).mapInArrow(_fetched, _TEXTS)
    buckets = bodies.repartition("key").sortWithinPartitions("key", *KEYS, "first")
    matched = buckets.mapInArrow(lambda b: _matched(b, keep_first), _SPANS)
    return known.unionByName(matched).groupBy(*KEYS).agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def without_repeats(docs: DataFrame, keep: list[str], keep_first: bool = True, with_bytes: bool = True) -> DataFrame:
    """``keep`` of every row of ``docs`` (doc_id, text, ...), n_bytes, n_removed, n_spans, kept_sha256 and, if wanted,
    the remaining bytes as ``kept``.

    A null text is empty. Rows with the same id and text lose the same spans; with ``keep_first`` all of them, or none,
    keep a string. Bytes may be cut inside a character. An empty table gives no rows.
    """
    out = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes
    names = [f.split()[0] for f in out.split(", ")]
    texts = docs.select(
        F.xxhash64("doc_id", "text").alias("k1"), F.hash("text", "doc_id").alias("k2"), utf8(F.col("text")).alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("own"))
    joined = texts.join(removed_spans(texts, keep_first), KEYS, "left")

    def strip(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text", 4 * SLICE_BYTES):
            pairs = zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True)
            results = [_stripped(t, s) for t, s in pairs]
            columns = [pa.array([r[i] for r in results], pa.int64()) for i in range(3)]
            columns.append(pa.array([hashlib.sha256(r[3]).hexdigest() for r in results], pa.string()))
            if with_bytes:
                columns.append(pa.array([r[3] for r in results], pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column("own"), *columns], names=["own", *names])

    stripped = joined.mapInArrow(strip, f"own {joined.schema['own'].dataType.simpleString()}, {out}")
    return stripped.select("own.*", *names)


def _stripped(text: bytes, spans: list[dict] | None) -> tuple[int, int, int, bytes]:
    """Bytes, removed bytes, removed runs and the rest."""
    if not spans:
        return len(text), 0, 0, text
    a, b = (np.array([s[k] for s in spans], np.int64) for k in ("a", "b"))
    _, a, b = merged(np.zeros(len(a), np.int64), a, b)
    edges = [0, *np.stack([a, b], 1).reshape(-1).tolist(), len(text)]
    rest = b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True))
    return len(text), len(text) - len(rest), len(a), rest


def deduplicated_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: every byte of a string that also starts elsewhere goes."""
    return without_repeats(docs.select("doc_id", "text"), ["doc_id"], keep_first=False, with_bytes=False)
