"""Gradient-boosted trees over binned columns, grown from histograms.

Rows are binned once and packed into blocks. Trees grow from histograms of gradient, Hessian and row count per (model,
node, feature, bin); of two children only the smaller one is counted, the other follows by subtraction. Columns of few
bins share a byte and are counted together. Gradients are multiples of a power of two, so that sums do not depend on
their order: rows in one task and spread ones give the same trees.

Few rows fit one task: it holds all blocks and grows up to ``ROUNDS_PER_JOB`` rounds a job. Otherwise the rows stay
spread over cached partitions with their margins; per step a small job adds up the partitions' histograms and the driver
decides on the splits. What travels depends on the number of nodes, columns and bins, never on that of the rows. The
margins are cached anew every round; every ``ROUNDS_PER_LINEAGE`` rounds they are built from the blocks and the trees
found so far, so that a lost partition is found again by few steps.

Several models that share the binned rows and differ in the rows they train on, such as those of the folds of a cross
validation, grow side by side: one job serves all of them, and where the rows fit one task each model has its own.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnlake.functions.ordering import cut_points
from learnlake.session import shared_path

ROUNDS_PER_JOB = 100
ROUNDS_PER_LINEAGE = 40
# Rows of a block, rows that a task of its own is started for, and rows of a task from which on tasks may outnumber slots.
BLOCK_ROWS = 16_384
ROWS_PER_TASK = 131_072
MOST_ROWS_PER_TASK = 1_048_576
# Rows of so many tasks stay in one, level by level and leaf by leaf: a job a step takes longer, of which the latter has many.
HELD_TASKS, HELD_TASKS_BY_LEAF = 2, 8
# Partitions whose histograms meet in the driver; those of more are added up in tasks first.
SUMMED_AT_ONCE = 32
# Open leaves whose children are counted in one exchange when growing by gain.
LOOK_AHEAD = 8
# Steps of gradients and Hessians: sums below 2**53 steps are exact.
SLOPE_STEPS = 2.0 ** 30
# Rows from which on columns are counted one by one.
MANY_ROWS = 4_096
TRAIN, VALIDATE = 1, 2


@dataclass(frozen=True)
class Boosting:
    """Settings of one fit. ``max_leaves`` grows by gain, leaf by leaf; without it trees grow level by level."""

    rounds: int = 800
    step: float = 0.05
    max_depth: int = 7
    max_leaves: int | None = None
    row_share: float = 0.85
    bag_every: int = 1
    feature_share: float = 0.85
    l1: float = 0.0
    l2: float = 1.0
    min_hessian: float = 1.0
    min_rows: int = 1
    patience: int = 50
    max_bins: int = 64
    seed: int = 42


@dataclass
class Tree:
    """Nodes in an order with parents before children; ``left`` < 0 marks a leaf. Values are steps on the log-odds."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    count: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def margins(self, bins: np.ndarray | Binned) -> np.ndarray:
        """The value of each row (a column of ``bins``)."""
        out = np.empty(bins.shape[1])
        for k, rows in self.leaves(bins, np.arange(bins.shape[1])):
            out[rows] = self.value[k]
        return out

    def leaves(self, bins: np.ndarray | Binned, rows: np.ndarray, wanted: Iterable[int] | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, those of ``rows`` that end in it), of all leaves or the ``wanted`` ones."""
        pending, asked = [(0, rows)], set(range(len(self.left)) if wanted is None else wanted)
        for k in range(len(self.left) - 1, -1, -1):
            if self.left[k] >= 0 and (self.left[k] in asked or self.right[k] in asked):
                asked.add(k)
        while pending:
            k, rows = pending.pop()
            if k not in asked:
                continue
            if self.left[k] < 0:
                yield k, rows
                continue
            low = _at(bins, self.feature[k], rows) <= self.bin[k]
            pending += [(self.left[k], rows[low]), (self.right[k], rows[~low])]

    @property
    def depth(self) -> int:
        levels = [0] * len(self.left)
        for k, (a, b) in enumerate(zip(self.left, self.right, strict=True)):
            if a >= 0:
                levels[a] = levels[b] = levels[k] + 1
        return max(levels)


# ------------------------------------------------------------------ binned columns


class Packing:
    """Where each column's bins lie in the bytes of a row; columns of few bins share one."""

    def __init__(self, sizes: Sequence[int]) -> None:
        self.sizes = [int(n) for n in sizes]
        wide = [(n - 1).bit_length() for n in self.sizes]
        # Columns per byte, the last in the lowest bits.
        self.columns: list[list[int]] = []
        room: list[int] = []
        for f in sorted(range(len(wide)), key=lambda f: -wide[f]):
            at = next((k for k, free in enumerate(room) if free >= wide[f]), len(room))
            if at == len(room):
                room.append(8)
                self.columns.append([])
            room[at] -= wide[f]
            self.columns[at].append(f)
        self.bits = [[wide[f] for f in columns] for columns in self.columns]
        self.place = {
            f: (byte, sum(bits[k + 1:]), (1 << bits[k]) - 1)
            for byte, (columns, bits) in enumerate(zip(self.columns, self.bits, strict=True)) for k, f in enumerate(columns)}

    def packed(self, bins: np.ndarray) -> Binned:
        """Rows of ``bins``, which has a row per column."""
        codes = np.zeros((len(self.columns), bins.shape[1]), np.uint8)
        for f, (byte, shift, _) in self.place.items():
            codes[byte] |= bins[f].astype(np.uint8) << np.uint8(shift)
        return Binned(self, codes)


@dataclass
class Binned:
    """Bins of rows as bytes (byte, row)."""

    packing: Packing
    codes: np.ndarray

    @property
    def shape(self) -> tuple[int, int]:
        return len(self.packing.sizes), self.codes.shape[1]


def _at(bins: np.ndarray | Binned, feature: int, rows: np.ndarray) -> np.ndarray:
    """The bins of some rows in a column."""
    if not isinstance(bins, Binned):
        return bins[feature][rows]
    byte, shift, mask = bins.packing.place[feature]
    return (bins.codes[byte][rows] >> np.uint8(shift)) & np.uint8(mask)


def _marginals(cells: np.ndarray, bits: Sequence[int]) -> list[np.ndarray]:
    """Sums (..., bin) per column of the counts (..., code) of the columns' joint codes."""
    if len(bits) == 1:
        return [cells]
    half = len(bits) // 2
    both = cells.reshape(*cells.shape[:-1], 1 << sum(bits[:half]), 1 << sum(bits[half:]))
    return _marginals(both.sum(axis=-1), bits[:half]) + _marginals(both.sum(axis=-2), bits[half:])


# ------------------------------------------------------------------ hashes that decide rows and columns


def _uniform(keys: np.ndarray, *salts: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on nothing but key and salts (SplitMix64)."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.uint64)
        for salt in salts:
            z = (z ^ np.uint64(salt & 0xFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)).astype(np.float64) / 2**53


def bagged(keys: np.ndarray, settings: Boosting, round_: int) -> np.ndarray:
    """Which rows a round uses; bags are drawn anew every ``bag_every`` rounds."""
    if settings.row_share >= 1:
        return np.ones(len(keys), bool)
    return _uniform(keys, settings.seed, round_ // settings.bag_every, 1) < settings.row_share


def chosen_features(width: int, settings: Boosting, round_: int) -> np.ndarray:
    """The columns of a round's trees: the wanted share of them, those with the smallest hashes."""
    drawn = _uniform(np.arange(width), settings.seed, round_, 2)
    wanted = max(1, round(settings.feature_share * width))
    return np.sort(np.argsort(drawn, kind="stable")[:wanted])


# ------------------------------------------------------------------ growing


def _soft(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def _score(g: np.ndarray, h: np.ndarray, s: Boosting) -> np.ndarray:
    return _soft(g, s.l1) ** 2 / (h + s.l2 + 1e-300)


def best_splits(
    hist: np.ndarray, features: np.ndarray, s: Boosting, sizes: np.ndarray | None = None,
) -> list[tuple[float, int, int]]:
    """(gain, feature, bin) per histogram (node, feature, bin, 3): the regularised gain's maximum, -1 where none is positive.

    ``sizes`` are the numbers of bins of all columns: those with two, such as categories, need one border only.
    """
    small = sizes[features] <= 2 if sizes is not None and hist.shape[2] > 2 else np.zeros(len(features), bool)
    if small.any():
        parts = [best_splits(hist[:, small, :2], features[small], s)]
        if not small.all():
            parts.append(best_splits(hist[:, ~small], features[~small], s))
        return [min(found, key=lambda x: (-x[0], x[1])) for found in zip(*parts, strict=True)]
    left = hist.cumsum(axis=2)[:, :, :-1]
    whole = hist.sum(axis=2)[:, :, None]
    right = whole - left
    good = (left[..., 1] >= s.min_hessian) & (right[..., 1] >= s.min_hessian)
    good &= (left[..., 2] >= s.min_rows - 0.5) & (right[..., 2] >= s.min_rows - 0.5)
    gain = (_score(left[..., 0], left[..., 1], s) + _score(right[..., 0], right[..., 1], s)
            - _score(whole[..., 0], whole[..., 1], s)) / 2
    gain = np.where(good, gain, -1.0).reshape(len(hist), -1)
    at = gain.argmax(axis=1)
    bins = hist.shape[2] - 1
    return [(float(gain[k, i]), int(features[i // bins]), int(i % bins)) for k, i in enumerate(at)]


class _Node:
    """A leaf that may be split: its rows here, its histogram over all tasks and what is known about its children."""

    def __init__(self, place: int, depth: int, rows: np.ndarray) -> None:
        self.place, self.depth, self.rows = place, depth, rows
        self.hist: np.ndarray | None = None
        self.sums: np.ndarray | None = None
        self.split: tuple[float, int, int] = (-1.0, -1, -1)
        self.children: tuple[_Node, _Node] | None = None


class _Growth:
    """One tree in the making."""

    def __init__(self, rows: np.ndarray, features: np.ndarray, settings: Boosting) -> None:
        self.settings, self.features, self.tree = settings, features, Tree()
        self.root = self._leaf(0, rows)
        self.open: list[_Node] = []
        self.leaves = 1

    def _leaf(self, depth: int, rows: np.ndarray) -> _Node:
        t = self.tree
        for column, empty in ((t.feature, -1), (t.bin, -1), (t.left, -1), (t.right, -1), (t.value, 0.0), (t.count, 0.0), (t.gain, -1.0)):
            column.append(empty)
        return _Node(len(t.left) - 1, depth, rows)

    def halves(self, node: _Node) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the two children, which the node's own histogram tells."""
        low = node.hist[np.searchsorted(self.features, node.split[1]), :node.split[2] + 1].sum(axis=0)
        return low, node.sums - low

    def place(self, node: _Node) -> None:
        g, h, n = node.sums
        s = self.settings
        self.tree.value[node.place] = float(-s.step * _soft(np.array(g), s.l1) / (h + s.l2 + 1e-300))
        self.tree.count[node.place] = float(n)
        if node.split[0] > 1e-12:
            self.open.append(node)

    def wanted(self) -> list[_Node]:
        """Leaves whose children are to be counted next; none when the tree is done."""
        s = self.settings
        if s.max_leaves is None:
            return self.open
        room = s.max_leaves - self.leaves
        if room <= 0:
            return []
        by_gain = sorted(self.open, key=lambda n: (-n.split[0], n.place))
        return [n for n in by_gain[:min(room, LOOK_AHEAD)] if n.children is None]

    def divide(self, node: _Node, bins: Binned) -> tuple[np.ndarray, np.ndarray]:
        low = _at(bins, node.split[1], node.rows) <= node.split[2]
        return node.rows[low], node.rows[~low]

    def commit(self) -> None:
        """Split leaves whose children are known: all of them, or the best as long as it is one of these."""
        s = self.settings
        while self.open:
            if s.max_leaves is None:
                node = next((n for n in self.open if n.children), None)
            else:
                node = min(self.open, key=lambda n: (-n.split[0], n.place)) if self.leaves < s.max_leaves else None
            if node is None or node.children is None:
                return
            self.open.remove(node)
            t, (gain, feature, bin_) = self.tree, node.split
            t.feature[node.place], t.bin[node.place], t.gain[node.place] = feature, bin_, gain
            sides = []
            for child in node.children:
                made = self._leaf(node.depth + 1, child.rows)
                made.hist, made.sums, made.split = child.hist, child.sums, child.split
                sides.append(made.place)
                self.place(made)
            t.left[node.place], t.right[node.place] = sides
            node.hist = node.children = None
            self.leaves += 1


def known(nodes: Sequence[_Node], hists: np.ndarray, features: np.ndarray, s: Boosting, sizes: np.ndarray | None = None) -> None:
    """Take the histograms of nodes: their sums and best splits follow."""
    splits = best_splits(hists, features, s, sizes)
    for node, hist, split in zip(nodes, hists, splits, strict=True):
        node.hist, node.sums = hist, hist[0].sum(axis=0)
        if node.depth < s.max_depth:
            node.split = split


def _count(bins: Binned, groups: Sequence[tuple[np.ndarray, np.ndarray, np.ndarray]], features: np.ndarray, n_bins: int) -> np.ndarray:
    """Histograms (group, feature, bin, 3) of groups (rows, gradient, Hessian), all in one pass over their rows."""
    packing, n = bins.packing, len(groups)
    rows = np.concatenate([r for r, _, _ in groups])
    g, h = (np.concatenate([x[k][x[0]] for x in groups]) for k in (1, 2))
    group = np.repeat(np.arange(n), [len(r) for r, _, _ in groups])
    out, at = np.zeros((n, len(features), n_bins, 3)), {int(f): i for i, f in enumerate(features)}
    bytes_ = [k for k, columns in enumerate(packing.columns) if any(f in at for f in columns)]
    if len(rows) < MANY_ROWS:
        # One call for all bytes.
        cells = (bins.codes[bytes_][:, rows] + (np.arange(len(bytes_))[:, None] * n + group) * 256).ravel()
        joint = [np.bincount(cells, w, len(bytes_) * n * 256).reshape(-1, n, 256)
                 for w in (np.tile(g, len(bytes_)), np.tile(h, len(bytes_)), None)]
    for i, byte in enumerate(bytes_):
        columns, bits = packing.columns[byte], packing.bits[byte]
        codes = 1 << sum(bits)
        if len(rows) < MANY_ROWS:
            found = np.stack([channel[i, :, :codes] for channel in joint])
        else:
            cells = bins.codes[byte][rows] + group * codes
            found = np.stack([np.bincount(cells, w, n * codes).reshape(n, codes) for w in (g, h, None)])
        for f, one in zip(columns, _marginals(found, bits), strict=True):
            if f in at:
                size = packing.sizes[f]
                out[:, at[f], :size] = one[:, :, :size].transpose(1, 2, 0)
    return out


class _Model:
    """What is known about one model: margins of the rows, unless these are spread, and losses so far."""

    def __init__(self, number: int, role: np.ndarray | None, margin: np.ndarray | None, losses: list[float]) -> None:
        self.number, self.role, self.margin, self.losses = number, role, margin, losses
        self.growth: _Growth | None = None
        self.g = self.h = margin


def rounds_wanted(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """Rounds up to the smallest loss, and whether ``patience`` rounds after it brought no better one.

    ``losses`` begins with the loss before the first round.
    """
    best = int(np.argmin(losses)) if len(losses) else 0
    return best, len(losses) - 1 - best >= patience


def _loss(label: np.ndarray, margin: np.ndarray, held: np.ndarray) -> tuple[float, int]:
    """Sum of the logistic losses of the held rows, and their number."""
    sign = np.where(label[held] > 0, 1.0, -1.0)
    return np.logaddexp(0.0, -sign * margin[held]).sum(), held.sum()


def _slopes(label: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of the logistic loss, rounded so that their sums are exact."""
    p = 1 / (1 + np.exp(-margin))
    return np.round((p - label) * SLOPE_STEPS) / SLOPE_STEPS, np.round(p * (1 - p) * SLOPE_STEPS) / SLOPE_STEPS


class _Held:
    """Rows in memory; ``add`` sums an array over all that hold rows."""

    def __init__(self, bins: Binned, label: np.ndarray, keys: np.ndarray, n_bins: int, settings: Boosting,
                 add: Callable[[np.ndarray], np.ndarray]) -> None:
        self.bins, self.label, self.keys, self.n_bins, self.settings, self.add = bins, label, keys, n_bins, settings, add

    def roots(self, active: Sequence[_Model], round_: int, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Validation losses (model, sum and number) and histograms of the roots."""
        losses = np.array([_loss(self.label, m.margin, m.role == VALIDATE) for m in active], float)
        bag = bagged(self.keys, self.settings, round_)
        for m in active:
            m.g, m.h = _slopes(self.label, m.margin)
            m.growth.root.rows = np.flatnonzero((m.role == TRAIN) & bag)
        roots = _count(self.bins, [(m.growth.root.rows, m.g, m.h) for m in active], features, self.n_bins)
        summed = self.add(np.concatenate([losses.ravel(), roots.ravel()]))
        return summed[:losses.size].reshape(losses.shape), summed[losses.size:].reshape(roots.shape)

    def divide(self, m: _Model, node: _Node) -> None:
        """Give the children of a node their rows."""
        for child, rows in zip(node.children, m.growth.divide(node, self.bins), strict=True):
            child.rows = rows

    def halves(self, wanted: Sequence[tuple[_Model, _Node, int]], round_: int, features: np.ndarray) -> np.ndarray:
        """Histograms of the wanted children (model, node, 0 or 1)."""
        return self.add(_count(self.bins, [(node.children[k].rows, m.g, m.h) for m, node, k in wanted], features, self.n_bins))

    def moved(self, m: _Model) -> None:
        """Add the grown tree to the margins."""
        m.margin = m.margin + m.growth.tree.margins(self.bins)


def grow(
    bins: np.ndarray | Binned, label: np.ndarray, keys: np.ndarray, models: list[_Model], begin: int, end: int, n_bins: int,
    settings: Boosting, add: Callable[[np.ndarray], np.ndarray], validated: bool, sizes: np.ndarray | None = None,
) -> Iterator[tuple[int, int, float, Tree]]:
    """``grown`` for rows in memory; ``bins`` has a row per column, ``add`` sums an array over all that hold rows."""
    packed = bins if isinstance(bins, Binned) else Packing([n_bins] * len(bins)).packed(bins)
    return grown(_Held(packed, label, keys, n_bins, settings, add), len(packed.packing.sizes), models, begin, end, settings, validated, sizes)


def grown(
    held: _Held | _Spread, width: int, models: list[_Model], begin: int, end: int, settings: Boosting, validated: bool,
    sizes: np.ndarray | None = None,
) -> Iterator[tuple[int, int, float, Tree]]:
    """(model, round, loss before it, tree) of rounds ``begin`` to ``end``.

    The last loss of each model comes with its last round's successor, without a tree.
    """
    active = list(models)
    for round_ in range(begin, end + 1):
        if not active:
            return
        features = chosen_features(width, settings, round_)
        for m in active:
            m.growth = _Growth(np.empty(0, np.int64), features, settings)
        losses, roots = held.roots(active, round_, features)
        going = []
        for k, m in enumerate(active):
            loss = losses[k, 0] / losses[k, 1] if losses[k, 1] else float("nan")
            m.losses.append(loss)
            if round_ == end or (validated and rounds_wanted(m.losses, settings.patience)[1]):
                yield m.number, round_, loss, Tree()
                continue
            known([m.growth.root], roots[k:k + 1], features, settings, sizes)
            m.growth.place(m.growth.root)
            going.append(m)
        active = going
        while tasks := [(m, node) for m in active for node in m.growth.wanted()]:
            counted = []
            for m, node in tasks:
                node.children = (_Node(-1, node.depth + 1, node.rows), _Node(-1, node.depth + 1, node.rows))
                held.divide(m, node)
                for child, sums in zip(node.children, m.growth.halves(node), strict=True):
                    child.sums = sums
                if node.depth + 1 < settings.max_depth:
                    counted.append((m, node, int(node.children[0].sums[2] > node.children[1].sums[2])))
            if counted:
                smaller = held.halves(counted, round_, features)
                larger = np.stack([node.hist for _, node, _ in counted]) - smaller
                known([node.children[k] for _, node, k in counted], smaller, features, settings, sizes)
                known([node.children[1 - k] for _, node, k in counted], larger, features, settings, sizes)
            for m in active:
                m.growth.commit()
        for m in active:
            yield m.number, round_, m.losses[-1], m.growth.tree
            held.moved(m)


# ------------------------------------------------------------------ Spark


_NODES = (
    "treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, "
    "gain double, leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, "
    "numCategories int>>")
_BLOCK = "n int, bins binary, label binary, roles binary, keys binary"
_TREE = (
    "model int, round int, loss double, feature array<int>, bin array<int>, left array<int>, right array<int>, "
    "value array<double>, count array<double>, gain array<double>")


def bin_edges(rows: DataFrame, vector: str, width: int, max_bins: int) -> list[np.ndarray]:
    """Per position of an array column the borders of its bins: approximate quantiles, each value once.

    Borders that part nothing are left out: the next larger number after another border, and the largest value.
    """
    names = [f"f{i}" for i in range(width)]
    columns = rows.select(*[F.col(vector)[i].alias(n) for i, n in enumerate(names)])
    points = cut_points(columns, names, [i / max_bins for i in range(1, max_bins)])
    edges = [np.unique(np.array(points[n], float)) for n in names]
    most = rows.agg(*[F.max(F.col(vector)[i]).alias(n) for i, n in enumerate(names)]).first()
    # NaN, the largest value where there is any, lies above all borders.
    return [e[~(e >= (np.inf if most[n] is None else most[n])) & ~np.isin(e, np.nextafter(e, np.inf))] for e, n in zip(edges, names, strict=True)]


def binned_blocks(rows: DataFrame, vector: str, label: str, roles: list[str], edges: list[np.ndarray]) -> DataFrame:
    """Blocks of binned rows in the shared folder; ``roles`` are columns with 1 for training and 2 for validation rows."""
    source = rows.select(
        F.col(vector).alias("x"), F.col(label).cast("double").alias("y"),
        F.array(*[F.col(r).cast("byte") for r in roles]).alias("roles"), F.xxhash64(vector, label).alias("key"))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                n = part.num_rows
                x = part.column("x").flatten().to_numpy().reshape(n, len(edges))
                bins = np.stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(edges)]).astype(np.uint8)
                role = part.column("roles").flatten().to_numpy().reshape(n, len(roles)).T.astype(np.int8)
                yield pa.RecordBatch.from_pydict({
                    "n": pa.array([n], pa.int32()), "bins": [bins.tobytes()],
                    "label": [part.column("y").to_numpy().tobytes()], "roles": [np.ascontiguousarray(role).tobytes()],
                    "keys": [part.column("key").to_numpy().tobytes()]})

    path = shared_path(rows.sparkSession, "boosting-blocks")
    source.mapInArrow(pack, _BLOCK).write.parquet(path)
    return rows.sparkSession.read.schema(_BLOCK).parquet(path)


# Binned rows of a partition: bins, label, roles, keys, and margins per model.
Part = tuple[Binned, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _part(rows: Iterable, packing: Packing, models: int) -> Part | None:
    """The blocks of a partition put together, margins 0."""
    width = len(packing.sizes)
    blocks = [(
        packing.packed(np.frombuffer(r["bins"], np.uint8).reshape(width, r["n"])).codes, np.frombuffer(r["label"]),
        np.frombuffer(r["roles"], np.int8).reshape(models, r["n"]), np.frombuffer(r["keys"], np.int64)) for r in rows]
    if not blocks:
        return None
    codes, label, roles, keys = (np.concatenate(x, axis=-1) for x in zip(*blocks, strict=True))
    return Binned(packing, codes), label, roles, keys, np.zeros((models, len(label)))


def _advanced(part: Part, trees: Mapping[int, Sequence[Tree]]) -> Part:
    """Add trees per model to the margins."""
    if not trees:
        return part
    margins = part[4].copy()
    for m, forest in trees.items():
        for tree in forest:
            margins[m] += tree.margins(part[0])
    return *part[:4], margins


def _root_sums(part: Part, models: Sequence[int], round_: int, features: np.ndarray, used: np.ndarray, s: Boosting) -> np.ndarray:
    """Losses and root histograms of a partition, one after the other; ``used`` marks the bins a column has."""
    bins, label, roles, keys, margins = part
    losses = np.array([_loss(label, margins[m], roles[m] == VALIDATE) for m in models], float)
    bag = bagged(keys, s, round_)
    groups = [(np.flatnonzero((roles[m] == TRAIN) & bag), *_slopes(label, margins[m])) for m in models]
    return np.concatenate([losses.ravel(), _count(bins, groups, features, used.shape[1])[:, used].ravel()])


def _half_sums(part: Part, wanted: Sequence[tuple[int, Tree, dict[int, tuple[int, int, int]]]], round_: int, features: np.ndarray,
               used: np.ndarray, s: Boosting) -> np.ndarray:
    """Histograms of one child per wanted leaf; per model its tree so far and leaf -> (feature, bin, 0 or 1)."""
    bins, label, roles, keys, margins = part
    bag, groups = bagged(keys, s, round_), []
    for m, tree, splits in wanted:
        g, h = _slopes(label, margins[m])
        at = dict(tree.leaves(bins, np.flatnonzero((roles[m] == TRAIN) & bag), splits))
        for leaf, (feature, bin_, side) in splits.items():
            rows = at[leaf]
            groups.append((rows[(_at(bins, feature, rows) > bin_) == side], g, h))
    return _count(bins, groups, features, used.shape[1])[:, used].ravel()


class _Spread:
    """Rows in cached partitions: the counterpart of ``_Held`` by one small job per step."""

    def __init__(self, parts: RDD, forests: Mapping[int, Sequence[Tree]], n_bins: int, sizes: np.ndarray, settings: Boosting) -> None:
        self.sizes, self.n_bins, self.settings = sizes, n_bins, settings
        # Trees that are not in the cached margins yet.
        self.pending: dict[int, list[Tree]] = {}
        self.state = parts.map(lambda part: _advanced(part, forests)).persist(StorageLevel.MEMORY_AND_DISK_DESER)

    def _added(self, sums: Callable[[Part], np.ndarray]) -> np.ndarray:
        trees = self.pending
        each = self.state.map(lambda part: sums(_advanced(part, trees)))
        if each.getNumPartitions() > SUMMED_AT_ONCE:
            return each.treeReduce(np.add)
        return sum(each.collect())

    def _spread_out(self, flat: np.ndarray, used: np.ndarray) -> np.ndarray:
        """Histograms (group, feature, bin, 3) from those of the used bins."""
        flat = flat.reshape(-1, int(used.sum()), 3)
        out = np.zeros((len(flat), *used.shape, 3))
        out[:, used] = flat
        return out

    def _used(self, features: np.ndarray) -> np.ndarray:
        return np.arange(self.n_bins) < self.sizes[features][:, None]

    def roots(self, active: Sequence[_Model], round_: int, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        before, s, used, numbers = self.state, self.settings, self._used(features), [m.number for m in active]
        trees = self.pending
        if trees:
            self.state, self.pending = before.map(lambda part: _advanced(part, trees)).persist(StorageLevel.MEMORY_AND_DISK_DESER), {}
        flat = self._added(lambda part: _root_sums(part, numbers, round_, features, used, s))
        if self.state is not before:
            before.unpersist()
        n = 2 * len(active)
        return flat[:n].reshape(-1, 2), self._spread_out(flat[n:], used)

    def divide(self, m: _Model, node: _Node) -> None:
        """Rows are found by the tree when they are counted."""

    def halves(self, wanted: Sequence[tuple[_Model, _Node, int]], round_: int, features: np.ndarray) -> np.ndarray:
        s, used = self.settings, self._used(features)
        by_model: dict[int, tuple[int, Tree, dict[int, tuple[int, int, int]]]] = {}
        for m, node, side in wanted:
            by_model.setdefault(m.number, (m.number, m.growth.tree, {}))[2][node.place] = (*node.split[1:], side)
        asked = list(by_model.values())
        return self._spread_out(self._added(lambda part: _half_sums(part, asked, round_, features, used, s)), used)

    def moved(self, m: _Model) -> None:
        self.pending = self.pending | {m.number: [*self.pending.get(m.number, []), m.growth.tree]}


def fit_many(
    rows: DataFrame, vector: str, label: str, roles: list[str], width: int, settings: Boosting,
) -> tuple[list[list[Tree]], list[np.ndarray], list[list[float]]]:
    """Forests of the models whose training and validation rows ``roles`` mark, bin borders, and losses.

    Each model keeps the rounds up to its smallest validation loss; one without validation rows keeps all rounds.
    ``losses`` hold the mean validation loss before the first round and after each.
    """
    edges = bin_edges(rows, vector, width, settings.max_bins)
    blocks = binned_blocks(rows, vector, label, roles, edges)
    n_bins = max((len(e) for e in edges if len(e)), default=1) + 1
    sizes = blocks.agg(F.sum("n").alias("n"), F.count("*").alias("blocks")).first()
    if not sizes["n"]:
        return [[] for _ in roles], edges, [[] for _ in roles]
    held = rows.agg(*[F.count_if(F.col(r) == VALIDATE).alias(r) for r in roles]).first()
    validated = all(held[r] for r in roles)
    column_bins = np.array([len(e) + 1 for e in edges])
    spark = rows.sparkSession
    slots = max(spark.sparkContext.defaultParallelism, -(-sizes["n"] // MOST_ROWS_PER_TASK))
    tasks = max(1, min(slots, sizes["blocks"], -(-sizes["n"] // ROWS_PER_TASK)))
    if sizes["n"] <= ROWS_PER_TASK * (HELD_TASKS if settings.max_leaves is None else HELD_TASKS_BY_LEAF):
        tasks = 1
    packing = Packing(column_bins)
    forests: list[list[Tree]] = [[] for _ in roles]
    losses: list[list[float]] = [[] for _ in roles]
    open_, done, n_models = list(range(len(roles))), 0, len(roles)

    def held_by_one(begin: int, end: int) -> list[tuple[int, int, float, Tree]]:
        """The rows fit one task, so nothing is exchanged, and every model gets a task of its own."""
        before = {m: (forests[m], losses[m][:-1]) for m in open_}

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts: dict[int, list] = {}
            for batch in batches:
                for row in batch.to_pylist():
                    parts.setdefault(row["model"], []).append(row)
            if not parts:
                return
            # Each model came with the same blocks; a task that got several of them needs these once.
            blocks_ = next(iter(parts.values()))
            bins, y, role, keys, margins = _advanced(_part(blocks_, packing, n_models), {m: before[m][0] for m in parts})
            models = [_Model(m, role[m], margins[m], list(before[m][1])) for m in sorted(parts)]
            for m, round_, loss, tree in grow(
                    bins, y, keys, models, begin, end, n_bins, settings, lambda array: array, validated, column_bins):
                yield pa.RecordBatch.from_pydict({
                    "model": pa.array([m], pa.int32()), "round": pa.array([round_], pa.int32()), "loss": pa.array([loss], pa.float64()),
                    **{c: pa.array([getattr(tree, c)], pa.list_(pa.int32())) for c in ("feature", "bin", "left", "right")},
                    **{c: pa.array([getattr(tree, c)], pa.list_(pa.float64())) for c in ("value", "count", "gain")}})

        each = blocks.withColumn("model", F.explode(F.array(*[F.lit(m) for m in open_])))
        found = each.repartitionByRange(len(open_), "model").mapInArrow(run, _TREE).collect()
        return [(r["model"], r["round"], r["loss"], Tree(*(
            list(r[c]) for c in ("feature", "bin", "left", "right", "value", "count", "gain")))) for r in found]

    def put_together(rows: Iterable) -> list[Part]:
        part = _part(rows, packing, n_models)
        return [] if part is None else [part]

    # Dealt anew, so that parts are alike.
    parts = blocks.repartition(tasks).rdd.mapPartitions(put_together).persist(StorageLevel.MEMORY_AND_DISK_DESER) if tasks > 1 else None

    def spread(begin: int, end: int) -> list[tuple[int, int, float, Tree]]:
        state = _Spread(parts, {m: forests[m] for m in open_}, n_bins, column_bins, settings)
        models = [_Model(m, None, None, losses[m][:-1]) for m in open_]
        found = list(grown(state, width, models, begin, end, settings, validated, column_bins))
        state.state.unpersist()
        return found

    while open_ and done < settings.rounds:
        end = min(done + (ROUNDS_PER_LINEAGE if tasks > 1 else ROUNDS_PER_JOB), settings.rounds)
        answered = (spread if tasks > 1 else held_by_one)(done, end)
        for m, round_, loss, tree in sorted(answered, key=lambda r: r[:2]):
            losses[m] = losses[m][:round_] + [loss]
            if tree.left:
                forests[m].append(tree)
        stopped = {m for m, round_, _, tree in answered if not tree.left and round_ < end}
        open_, done = [m for m in open_ if m not in stopped], end
    if parts is not None:
        parts.unpersist()
    if validated:
        forests = [f[:max(1, rounds_wanted(lost, settings.patience)[0])] for f, lost in zip(forests, losses, strict=True)]
    return forests, edges, losses


def fit(rows: DataFrame, vector: str, label: str, role: str, width: int, settings: Boosting) -> tuple[list[Tree], list[np.ndarray], list[float]]:
    """One forest; see ``fit_many``."""
    forests, edges, losses = fit_many(rows, vector, label, [role], width, settings)
    return forests[0], edges, losses[0]


# ------------------------------------------------------------------ as a model of Spark ML


def spark_model(spark: SparkSession, forest: Sequence[Tree], edges: Sequence[np.ndarray], width: int) -> GBTClassificationModel:
    """The forest as Spark's own model, which scores in the JVM, by way of the files that such a model is saved in.

    Spark's probability is that of twice the trees' sum, so values are halved.
    """
    path = shared_path(spark, "forest")
    uid, now = f"forest_{uuid.uuid4().hex[:12]}", int(time.time() * 1000)

    def described(kind: str, name: str, **more) -> str:
        return json.dumps({"class": f"org.apache.spark.ml.{kind}", "timestamp": now, "sparkVersion": spark.version,
                           "uid": name, "paramMap": {}, "defaultParamMap": {"impurity": "variance"}, **more})

    nodes = [
        (i, (k, t.value[k] / 2, 0.0, [t.count[k], 0.0, 0.0], round(t.count[k]), t.gain[k], t.left[k], t.right[k],
             (t.feature[k], [float(edges[t.feature[k]][t.bin[k]])] if t.left[k] >= 0 else [], -1)))
        for i, t in enumerate(forest) for k in range(len(t.left))]
    trees = [(i, described("regression.DecisionTreeRegressionModel", f"{uid}_{i}"), 1.0) for i in range(len(forest))]
    whole = described("classification.GBTClassificationModel", uid, numFeatures=width, numTrees=len(forest))
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(nodes, _NODES).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)
