"""Hard negatives by inner product, searched in cover trees over norm-augmented vectors.

A coordinate that fills every candidate up to the largest norm M puts them all on one sphere, and leaves inner products
with queries (whose extra coordinate is 0) as they are. A node of the tree covers its points within a radius, and radii
halve from level to level. On the sphere a covering radius is an angle, so the inner products of all points below a
node lie between those at the smallest and the largest possible angle to the query. Children are visited best bound
first; nodes whose bounds miss every wanted window, or that hold no wanted label, are skipped, and what is left is
verified with exact integers.

Candidates are dealt by hash into trees of about ``TREE_ROWS`` rows, trees into groups. A task holds one block of
queries with the best rows found so far and takes the trees of a group one by one, so its memory is bounded, and what
one tree yields prunes the next. Queries meet all candidates, block by block; the result of a task is a few rows per
query. Labels are only looked at inside trees: a frequent one makes no large task.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnlake.llm.common import written

SCALE = 256
ANCHOR_EVERY, RELABEL_EVERY, LABELS = 100, 7, 10
BEST = 5
MIN_PERCENT, MAX_PERCENT = 80, 100
TREE_ROWS = 2_048
LEAF_ROWS = 16
TREES_TOGETHER = 64
# Queries that meet the trees of a group in one task, and those whose bounds are computed at once.
BLOCK_QUERIES = 8_192
QUERIES_AT_ONCE = 256
# Sums of integer products up to this are exact in doubles.
EXACT = 2.0**53


class Tree:
    """A cover tree; points are stored in the order of its leaves. Any column of ``arrays`` is one array."""

    def __init__(self, arrays: dict[str, np.ndarray]) -> None:
        self.__dict__.update(arrays)
        self.arrays = arrays

    @classmethod
    def build(cls, uid: np.ndarray, ids: np.ndarray, known: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Tree:
        """``ids`` counts only where ``known``; ``vectors`` are integers, one row per point."""
        x = vectors.astype(np.float64)
        squares = np.einsum("ij,ij->i", x, x)
        norm = float(np.sqrt(squares.max(initial=0.0)))
        lifted = np.concatenate([x, np.sqrt(np.maximum(norm * norm - squares, 0.0))[:, None]], axis=1)
        nodes: list[list[float]] = []
        # Breadth first, so that the children of a node are neighbours: (members, center).
        queue: list[tuple[np.ndarray, int]] = [(np.arange(len(x)), 0)] if len(x) else []
        at = 0
        while at < len(queue):
            members, center = queue[at]
            gaps = lifted[members] - lifted[center]
            distance = np.sqrt(np.einsum("ij,ij->i", gaps, gaps))
            radius = float(distance.max())
            nodes.append([center, radius, 0, 0])
            if len(members) > LEAF_ROWS and radius > 0:
                nodes[at][2] = len(queue)
                queue.extend(_covered(lifted, members, center, distance <= radius / 2, radius / 2))
                nodes[at][3] = len(queue)
            at += 1
        # Leaves one after the other; every node's points are then a stretch of this order.
        order: list[int] = []
        place = np.empty(len(x), np.int64)
        low, high = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64)
        stack = [(0, False)] if nodes else []
        while stack:
            k, done = stack.pop()
            first, last = int(nodes[k][2]), int(nodes[k][3])
            if last > first and not done:
                low[k] = len(order)
                stack.append((k, True))
                stack.extend((c, False) for c in reversed(range(first, last)))
            elif last > first:
                high[k] = len(order)
            else:
                low[k] = len(order)
                order.extend(queue[k][0].tolist())
                high[k] = len(order)
        by = np.array(order, np.int64)
        place[by] = np.arange(len(by))
        table = np.array(nodes, np.float64).reshape(-1, 4)
        angle = 2 * np.arcsin(np.clip(table[:, 1] / (2 * norm), 0.0, 1.0)) if norm else np.zeros(len(table))
        ranges = [labels[by[a:b]] for a, b in zip(low.tolist(), high.tolist(), strict=True)]
        least, most = np.array([r.min() for r in ranges], np.int64), np.array([r.max() for r in ranges], np.int64)
        return cls({
            "uid": uid[by], "ids": ids[by], "known": known[by], "labels": labels[by], "vectors": vectors[by],
            "norm": np.array(norm), "center": place[table[:, 0].astype(np.int64)], "angle": angle,
            "first": table[:, 2].astype(np.int64), "last": table[:, 3].astype(np.int64), "low": low, "high": high,
            "least": least, "most": most})

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.arrays)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as arrays:
            return cls({k: arrays[k] for k in arrays.files})


def _covered(lifted, members, center, near, radius) -> list[tuple[np.ndarray, int]]:
    """Groups of ``members`` within ``radius`` of their centers, which are farther than that from one another.

    The first group is that of the node's own center, so every level's centers are among those of the next.
    """
    out = [(members[near], center)]
    rest = members[~near]
    if not len(rest):
        return out
    points = lifted[rest]
    squares = np.einsum("ij,ij->i", points, points)
    close = squares[:, None] + squares[None, :] - 2 * (points @ points.T) <= radius * radius
    free = np.ones(len(rest), bool)
    while True:
        pick = int(free.argmax())
        if not free[pick]:
            return out
        own = close[pick] & free
        own[pick] = True
        out.append((rest[own], int(rest[pick])))
        free &= ~own


class Wanted:
    """What one query looks for: its best rows in each window [low, high] of scores, a few at most."""

    def __init__(self, uid: int, label: int, same_label: bool, windows: list[tuple[float, float]]) -> None:
        self.uid, self.label, self.same = uid, label, same_label
        self.windows = windows
        # Per window (-score, id is unknown, id, uid) in ascending order: the smaller, the better.
        self.best: list[list[tuple[int, bool, int, int]]] = [[] for _ in windows]
        self.ceiling = max((h for _, h in windows), default=-np.inf)

    def floor(self, window: int) -> float:
        """The least score that can still count in a window."""
        low, found = self.windows[window][0], self.best[window]
        return max(low, -found[-1][0]) if len(found) == BEST else low

    def offer(self, score: int, unknown: bool, row_id: int, uid: int) -> None:
        if uid == self.uid:
            return
        for (low, high), found in zip(self.windows, self.best, strict=True):
            if low <= score <= high:
                entry = (-score, unknown, row_id, uid)
                if len(found) < BEST or entry < found[-1]:
                    found.append(entry)
                    found.sort()
                    del found[BEST:]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < EXACT:
        return a.astype(np.float64) @ b.astype(np.float64).T
    return a @ b.T


def search(tree: Tree, wanted: list[Wanted], queries: np.ndarray) -> None:
    """Offer to every query the rows of ``tree`` that may be among its best; ``queries`` are integers, row by row."""
    if not len(tree.uid) or not wanted:
        return
    q = queries.astype(np.float64)
    reach = np.sqrt(np.einsum("ij,ij->i", q, q)) * float(tree.norm)
    # Rounding must never skip a row.
    slack = 1e-7 * reach + 1
    root = _products(queries, tree.vectors[tree.center[:1]])
    scored: dict[int, np.ndarray] = {}
    for i, w in enumerate(wanted):
        if not w.windows:
            continue
        heap: list[tuple[float, float, int]] = []
        _push(heap, tree, w, np.array([0]), root[i], reach[i], slack[i])
        while heap:
            upper, lower, node = heapq.heappop(heap)
            if -upper < min(map(w.floor, range(len(w.windows)))):
                break
            if not any(-upper >= w.floor(k) and lower <= w.windows[k][1] for k in range(len(w.windows))):
                continue
            first, last = int(tree.first[node]), int(tree.last[node])
            if last > first:
                # Once a node is opened its children are scored for all queries.
                if node not in scored:
                    scored[node] = _products(queries, tree.vectors[tree.center[first:last]])
                _push(heap, tree, w, np.arange(first, last), scored[node][i], reach[i], slack[i])
            else:
                a, b = int(tree.low[node]), int(tree.high[node])
                if -1 - node not in scored:
                    scored[-1 - node] = _products(queries, tree.vectors[a:b])
                _verify(tree, w, np.arange(a, b), scored[-1 - node][i])


def _push(heap: list, tree: Tree, w: Wanted, nodes: np.ndarray, scores: np.ndarray, reach: float, slack: float) -> None:
    """Put nodes that may hold something on the heap; those of a single point are verified at once."""
    single = tree.high[nodes] - tree.low[nodes] == 1
    if single.any():
        # The score of such a node is that of its point.
        _verify(tree, w, tree.low[nodes[single]], scores[single])
        nodes, scores = nodes[~single], scores[~single]
    if not len(nodes):
        return
    least, most = tree.least[nodes], tree.most[nodes]
    right = (least <= w.label) & (w.label <= most) if w.same else (least != w.label) | (most != w.label)
    nodes, scores = nodes[right], np.asarray(scores[right], np.float64)
    middle = np.arccos(np.clip(scores / reach, -1, 1)) if reach else np.zeros(len(nodes))
    upper = reach * np.cos(np.maximum(middle - tree.angle[nodes], 0)) + slack
    lower = reach * np.cos(np.minimum(middle + tree.angle[nodes], np.pi)) - slack
    good = (upper >= min(map(w.floor, range(len(w.windows))))) & (lower <= w.ceiling)
    for k in np.flatnonzero(good).tolist():
        heapq.heappush(heap, (-upper[k], lower[k], int(nodes[k])))


def _verify(tree: Tree, w: Wanted, points: np.ndarray, scores: np.ndarray) -> None:
    floor = min(map(w.floor, range(len(w.windows))))
    right = (tree.labels[points] == w.label) == w.same
    hits = np.flatnonzero(right & (scores >= floor) & (scores <= w.ceiling))
    if len(hits) > 4 * BEST and len(w.windows) == 1:
        # Of many rows only those at or above the last wanted place matter.
        hits = hits[scores[hits] >= np.partition(scores[hits], -BEST - 1)[-BEST - 1]]
    # Best first, so that most of the rest is turned away at once.
    for k in hits[np.argsort(-scores[hits], kind="stable")].tolist():
        p = int(points[k])
        w.offer(int(scores[k]), not tree.known[p], int(tree.ids[p]), int(tree.uid[p]))


# ------------------------------------------------------------------ tables

_ROW = "uid long, vec_id long, label long, v array<long>"
_TREE = "shard int, tree binary"


def candidates(vectors: DataFrame) -> DataFrame:
    """(uid, vec_id, label, v) of the rows that take part, in the shared folder: labels changed, components whole numbers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % RELABEL_EVERY == 0, F.pmod(label + 1, F.lit(LABELS))).otherwise(label)
    whole = F.transform("embedding", lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("long"))
    rows = vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    return written(rows.select(
        F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long"), label.alias("label"), whole.alias("v")),
        "vectors")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column; shorter ones are filled up with zeros."""
    flat, ends = column.flatten().to_numpy(), np.cumsum(column.value_lengths().to_numpy())
    lengths = np.diff(ends, prepend=0)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(ends - lengths, lengths)] = flat
    return out


def build_trees(rows: DataFrame, shards: int, width: int) -> DataFrame:
    """(shard, tree): the rows dealt by hash into ``shards`` trees, written to the shared folder."""
    shard = F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int").alias("shard")
    dealt = rows.select(shard, "*").repartition("shard").sortWithinPartitions("shard", "uid")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            ids = whole.column("vec_id")
            tree = Tree.build(
                whole.column("uid").to_numpy(), ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False),
                whole.column("label").to_numpy(), _matrix(whole.column("v"), width))
            return pa.RecordBatch.from_pydict({
                "shard": whole.column("shard").slice(0, 1), "tree": pa.array([tree.dump()], pa.binary())})

        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if held and held[-1].column("shard")[0].as_py() != numbers[a]:
                    yield close()
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield close()

    return written(dealt.mapInArrow(run, _TREE), "cover-trees")


_FOUND = "uid long, window int, row_uid long, row_id long, score long"


def best_rows(queries: DataFrame, trees: DataFrame, shards: int, blocks: int, width: int, same_label: bool) -> DataFrame:
    """(uid, window, row_uid, row_id, score): the best rows of every query and window, with their rank from 1.

    ``queries`` has uid, label, v and windows (array of low, high); ties go to the smaller id, unknown ids last.
    """
    groups = -(-shards // TREES_TOGETHER)
    windows = "array<struct<low:double,high:double>>"
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    asked = queries.select(
        F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int").alias("block"), every.alias("part"), F.lit(-1).alias("shard"),
        "uid", "label", "v", "windows", F.lit(None).cast("binary").alias("tree"))
    offered = trees.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod("shard", F.lit(groups)).cast("int").alias("part"), "shard", F.lit(None).cast("long").alias("uid"),
        F.lit(None).cast("long").alias("label"), F.lit(None).cast("array<long>").alias("v"),
        F.lit(None).cast(windows).alias("windows"), "tree")
    # Queries come before the trees of their cell.
    cells = asked.unionByName(offered).repartition("block", "part").sortWithinPartitions("block", "part", "shard", "uid")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, wanted, vectors = None, [], []
        queries_: np.ndarray | None = None

        def close() -> pa.RecordBatch:
            rows = [(w.uid, k, e[3], None if e[1] else e[2], -e[0]) for w in wanted for k, best in enumerate(w.best) for e in best]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["uid", "window", "row_uid", "row_id", "score"])

        for batch in batches:
            places = list(zip(batch.column("block").to_pylist(), batch.column("part").to_pylist(), strict=True))
            for i, place in enumerate(places):
                if place != cell:
                    if wanted:
                        yield close()
                    cell, wanted, vectors, queries_ = place, [], [], None
                image = batch.column("tree")[i]
                if image.is_valid:
                    if queries_ is None:
                        queries_ = np.concatenate(vectors) if vectors else np.empty((0, width), np.int64)
                    tree = Tree.load(image.as_buffer().to_pybytes())
                    for at in range(0, len(wanted), QUERIES_AT_ONCE):
                        search(tree, wanted[at:at + QUERIES_AT_ONCE], queries_[at:at + QUERIES_AT_ONCE])
                else:
                    spans = [(s["low"], s["high"]) for s in batch.column("windows")[i].as_py()]
                    wanted.append(Wanted(batch.column("uid")[i].as_py(), batch.column("label")[i].as_py(), same_label, spans))
                    vectors.append(_matrix(batch.column("v").slice(i, 1), width))
        if wanted:
            yield close()

    found = cells.mapInArrow(run, _FOUND)
    # A few rows per group of trees meet per query and window.
    order = Window.partitionBy("uid", "window").orderBy(F.desc("score"), F.asc_nulls_last("row_id"), "row_uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= BEST)


def _window(score: Column) -> Column:
    """The scores a hard negative may have beside a positive's; empty below 0."""
    low = F.ceil(F.lit(MIN_PERCENT) * score / F.lit(100)).cast("double")
    return F.struct(low.alias("low"), (F.lit(MAX_PERCENT / 100) * score).alias("high"))


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and embedding. Rows without a label or a vector, or with a null or non-finite
    component, take no part. A row without an id is no anchor and comes last among equal scores; repeated ids are rows
    of their own, each an anchor if the id says so. Missing components of shorter vectors are 0. Scores must fit into 63 bits.
    Anchors without positives, or without negatives in the window, give no rows; an empty table gives none.
    """
    rows = candidates(vectors.select("vec_id", "label", "embedding"))
    anchor = F.coalesce(F.col("vec_id") % ANCHOR_EVERY == 0, F.lit(False))
    size = rows.agg(
        F.count("*").alias("n"), F.count_if(anchor).alias("anchors"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("width")).first()
    shards, blocks = max(1, -(-size["n"] // TREE_ROWS)), max(1, -(-size["anchors"] // BLOCK_QUERIES))
    trees = build_trees(rows, shards, size["width"])
    everything = F.array(F.struct(F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high")))
    anchors = rows.where(anchor).withColumn("windows", everything)
    positives = written(best_rows(anchors, trees, shards, blocks, size["width"], True), "positives")
    ranked = positives.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("rank", "row_id", "score"))).alias("positives"))
    asked = written(rows.where(anchor).join(ranked, "uid").withColumn(
        "windows", F.transform("positives", lambda p: _window(p["score"]))), "anchors")
    negatives = best_rows(asked.drop("positives"), trees, shards, blocks, size["width"], False)
    return negatives.join(asked.select("uid", "vec_id", "positives"), "uid").select(
        F.col("vec_id").alias("anchor_id"), F.col("positives")[F.col("window")]["row_id"].alias("positive_id"), "rank",
        F.col("row_id").alias("negative_id"), F.col("positives")[F.col("window")]["score"].alias("positive_score"),
        F.col("score").alias("negative_score"))


SQL = f"""
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other_id,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % {ANCHOR_EVERY} = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {BEST})
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND {MIN_PERCENT} * positive_score <= 100 * score AND 100 * score <= {MAX_PERCENT} * positive_score
QUALIFY rank <= {BEST}
"""
