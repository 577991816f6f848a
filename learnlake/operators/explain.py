"""Attribution of scores to features: boosted trees, linear scores, top contributions, global importance.

An explained frame has the row's keys, ``base_value`` and ``contributions``: an array of (feature,
contribution). Sorting and top-k work inside that array, so no row leaves its partition.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from learnlake.operators.train import SCORE

CONTRIBUTIONS = "array<struct<feature: string, contribution: double>>"
# Conditions of leaves that are looked up together: their truth values fit a byte.
CONDITIONS = 8
# Bytes of looked-up values that a task keeps; those of larger models are computed anew for every batch.
KEPT_BYTES = 128 << 20
# Rows of a batch that are worth computing the values of all groups; fewer are looked up leaf by leaf.
GROUPED_ROWS = 8_192


class Leaf(NamedTuple):
    """A leaf's value and, per feature on its path, the accepted range (low, high] and the cover share."""

    value: float
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    cover: np.ndarray


# ------------------------------------------------------------------ linear scores


def explain_linear(
    df: DataFrame, weights: Mapping[str, float], keys: Sequence[str], intercept: float = 0.0
) -> DataFrame:
    """Exact attribution of a linear score: weight times distance from the mean, nulls counting as 0."""
    def value(c: str) -> Column:
        return F.coalesce(F.col(c).cast("double"), F.lit(0.0))

    means = df.agg(*[F.avg(value(c)).alias(c) for c in weights]).first()
    base = intercept + sum(w * (means[c] or 0.0) for c, w in weights.items())
    items = [
        F.struct(F.lit(c).alias("feature"), (F.lit(float(w)) * (value(c) - F.lit(means[c] or 0.0))).alias("contribution"))
        for c, w in weights.items()
    ]
    return df.select(*keys, F.lit(base).alias("base_value"), F.array(*items).alias("contributions"))


# ------------------------------------------------------------------ boosted trees


def load_leaves(spark: SparkSession, model_dir: str) -> list[Leaf]:
    """Leaves of a saved boosted model, values on the log-odds scale. Model-sized: trees x leaves rows."""
    stage = _booster_path(spark, model_dir)
    weights = {r[0]: r[1] for r in spark.read.parquet(f"{stage}/treesMetadata").select("_1", "_3").collect()}
    trees: dict[int, dict[int, object]] = defaultdict(dict)
    for row in spark.read.parquet(f"{stage}/data").select("treeID", "nodeData.*").collect():
        trees[row.treeID][row.id] = row
    # A boosted classifier's probability is sigmoid(2 F), so the log-odds are twice the sum of the trees.
    return [leaf for tree, nodes in trees.items() for leaf in _leaves(nodes, 2.0 * weights[tree])]


def _booster_path(spark: SparkSession, model_dir: str) -> str:
    last = PipelineModel.load(model_dir).stages
    return f"{model_dir}/stages/{str(len(last) - 1).zfill(len(str(len(last))))}_{last[-1].uid}"


def _goes_left(split) -> tuple[float, bool]:
    """(border, whether values up to the border go left)."""
    if split.numCategories == -1:
        return split.leftCategoriesOrThreshold[0], True
    if split.numCategories != 2:
        raise ValueError("only numeric and 0/1 features can be attributed")
    return 0.5, list(split.leftCategoriesOrThreshold) == [0.0]


def _leaves(nodes: Mapping[int, object], scale: float) -> Iterator[Leaf]:
    pending = [(nodes[0], {})]
    while pending:
        node, path = pending.pop()
        if node.leftChild < 0:
            used = sorted(path)
            ranges = np.array([path[f] for f in used]).reshape(len(used), 3)
            yield Leaf(scale * node.prediction, np.array(used, dtype=int), ranges[:, 0], ranges[:, 1], ranges[:, 2])
            continue
        feature, (border, low_left) = node.split.featureIndex, _goes_left(node.split)
        low, high, cover = path.get(feature, (-np.inf, np.inf, 1.0))
        for child, is_left in ((nodes[node.leftChild], True), (nodes[node.rightChild], False)):
            below = is_left == low_left
            narrowed = (low, min(high, border)) if below else (max(low, border), high)
            pending.append((child, path | {feature: (*narrowed, cover * child.rawCount / node.rawCount)}))


def _patterns(leaf: Leaf, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the leaf's ranges hold a row: patterns of bits, and the place of every row's pattern among them.

    A path with few features has all its patterns listed; of a long one only those that occur.
    """
    used = len(leaf.features)
    code = np.zeros(columns.shape[1], np.uint8 if used <= 8 else np.int64)
    for j, (f, low, high) in enumerate(zip(leaf.features, leaf.low, leaf.high, strict=True)):
        # A NaN is above every border, as in the model.
        inside = columns[f] <= high if high < np.inf else ~(columns[f] <= low)
        if high < np.inf and low > -np.inf:
            inside &= columns[f] > low
        code |= inside.astype(code.dtype) << code.dtype.type(j)
    if used <= 8:
        return np.arange(1 << used), code
    return np.unique(code, return_inverse=True)


def _attribute(leaf: Leaf, columns: np.ndarray, nodes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Shapley values (feature, row) of one leaf's features; ``columns`` has a row per feature.

    With the leaf's features present at rate t, the others' product is a polynomial in t, and the Shapley
    average over coalitions is its integral over [0, 1], which Gauss-Legendre nodes give exactly.
    """
    patterns, row_of = _patterns(leaf, columns)
    return np.take(_pattern_values(leaf, patterns, nodes, weights), row_of, axis=1)


def _pattern_values(leaf: Leaf, patterns: np.ndarray, nodes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Shapley values (feature, pattern) of one leaf's features; bit j of a pattern tells whether range j holds the row."""
    hit = (patterns[:, None] >> np.arange(len(leaf.features))) & 1
    factor = hit[:, :, None] * nodes + leaf.cover[None, :, None] * (1.0 - nodes)
    ones = np.ones_like(factor[:, :1])
    before = np.cumprod(np.concatenate([ones, factor[:, :-1]], axis=1), axis=1)
    after = np.cumprod(np.concatenate([ones, factor[:, :0:-1]], axis=1), axis=1)[:, ::-1]
    values = leaf.value * (hit - leaf.cover) * ((before * after) @ weights)
    return np.ascontiguousarray(values.T)


class Group(NamedTuple):
    """Leaves with few conditions ``feature <= border`` between them, whose values are looked up at once."""

    leaves: list[Leaf]
    conditions: list[tuple[int, float]]


def _conditions(leaf: Leaf) -> set[tuple[int, float]]:
    ranges = zip(leaf.features.tolist(), leaf.low.tolist(), leaf.high.tolist(), strict=True)
    return {(f, border) for f, low, high in ranges for border in (low, high) if abs(border) < np.inf}


def grouped(leaves: Sequence[Leaf]) -> tuple[list[Group], list[Leaf]]:
    """Groups of leaves that follow each other, as those of a subtree do, and leaves with more conditions than a byte has bits."""
    groups, long = [], []
    for leaf in leaves:
        own = _conditions(leaf)
        if len(own) > CONDITIONS:
            long.append(leaf)
        elif groups and len(own.union(groups[-1].conditions)) <= CONDITIONS:
            groups[-1].leaves.append(leaf)
            groups[-1].conditions.extend(sorted(own.difference(groups[-1].conditions)))
        else:
            groups.append(Group([leaf], sorted(own)))
    return groups, long


def _group_values(group: Group, nodes: np.ndarray, weights: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Features of a group, and the sums of its leaves' Shapley values (feature, code); bit k tells whether condition k is met."""
    features = sorted({f for f, _ in group.conditions})
    codes = np.arange(1 << len(group.conditions))
    met = {c: (codes >> k & 1).astype(bool) for k, c in enumerate(group.conditions)}
    met |= {(f, border): np.full(len(codes), border > 0) for f in features for border in (-np.inf, np.inf)}
    out = np.zeros((len(features), len(codes)))
    for leaf in group.leaves:
        pattern = np.zeros(len(codes), np.int64)
        for j, (f, low, high) in enumerate(zip(leaf.features.tolist(), leaf.low.tolist(), leaf.high.tolist(), strict=True)):
            pattern |= (met[f, high] & ~met[f, low]).astype(np.int64) << j
        values = _pattern_values(leaf, np.arange(1 << len(leaf.features)), nodes, weights)
        out[np.searchsorted(features, leaf.features)] += values[:, pattern]
    return features, out


class _Attribution:
    """Contributions of all leaves to rows."""

    def __init__(self, leaves: Sequence[Leaf], nodes: np.ndarray, weights: np.ndarray) -> None:
        self.nodes, self.weights = nodes, weights
        self.leaves = [leaf for leaf in leaves if len(leaf.features)]
        self.groups, self.long = grouped(self.leaves)
        borders = sorted({c for g in self.groups for c in g.conditions})
        self.borders = {f: np.array([b for g, b in borders if g == f]) for f in {f for f, _ in borders}}
        self.places = {(f, b): k for f, found in self.borders.items() for k, b in enumerate(found.tolist())}
        self.kept: dict[int, tuple[list[int], np.ndarray]] = {}
        self.room = KEPT_BYTES

    def _values(self, k: int) -> tuple[list[int], np.ndarray]:
        if k in self.kept:
            return self.kept[k]
        found = _group_values(self.groups[k], self.nodes, self.weights)
        if found[1].nbytes <= self.room:
            self.kept[k], self.room = found, self.room - found[1].nbytes
        return found

    def of(self, columns: np.ndarray) -> np.ndarray:
        """Contributions (feature, row) to rows given by ``columns``, which has a row per feature."""
        total, n = np.zeros(columns.shape), columns.shape[1]
        if n < GROUPED_ROWS and not self.kept:
            return self._by_leaf(self.leaves, columns, total)
        # A value is at most the k-th border where its place is at most k.
        rank = {f: np.searchsorted(b, columns[f], "left").astype(np.min_scalar_type(len(b))) for f, b in self.borders.items()}
        one, found = np.empty(n, np.uint8), np.empty(n)
        for k, group in enumerate(self.groups):
            code = np.zeros(n, np.uint8)
            for bit, (f, border) in enumerate(group.conditions):
                np.left_shift((rank[f] <= rank[f].dtype.type(self.places[f, border])).view(np.uint8), np.uint8(bit), out=one)
                code |= one
            place, (features, values) = code.astype(np.intp), self._values(k)
            for f, by_code in zip(features, values, strict=True):
                total[f] += np.take(by_code, place, out=found, mode="clip")
        return self._by_leaf(self.long, columns, total)

    def _by_leaf(self, leaves: Sequence[Leaf], columns: np.ndarray, total: np.ndarray) -> np.ndarray:
        for leaf in leaves:
            for f, values in zip(leaf.features, _attribute(leaf, columns, self.nodes, self.weights), strict=True):
                total[f] += values
        return total


def explain_tree(
    df: DataFrame, model_dir: str, names: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """Path-dependent tree attribution for every row, on the log-odds scale, next to the row's risk score.

    Narrow: each task works on its own batches. The leaves travel in the task closure; their number is
    fixed by the model's tree count and depth, not by the data.
    """
    spark = df.sparkSession
    model, leaves, keys = PipelineModel.load(model_dir), load_leaves(spark, model_dir), list(keys)
    base = float(sum(leaf.value * leaf.cover.prod() for leaf in leaves))
    longest = max((len(leaf.features) for leaf in leaves), default=0)
    nodes, weights = np.polynomial.legendre.leggauss(longest // 2 + 1)
    nodes, weights = (nodes + 1) / 2, weights / 2
    width = len(names)

    def attribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attribution = _Attribution(leaves, nodes, weights)
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, width)
            total = np.ascontiguousarray(attribution.of(np.ascontiguousarray(x.T)).T)
            values = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * width, total.ravel())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in (*keys, SCORE)], values], names=[*keys, SCORE, "values"])

    rows = model.transform(df).select(
        *keys, vector_to_array("probability")[1].alias(SCORE), vector_to_array("features").alias("x"))
    schema = ", ".join([
        *(f"`{c}` {kind}" for c, kind in df.select(*keys).dtypes), f"{SCORE} double, values array<double>"])
    named = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), F.col("values").alias("contribution"))
    explained = rows.mapInArrow(attribute, schema)
    return explained.select(
        *keys, SCORE, F.lit(base).alias("base_value"), named.cast(CONTRIBUTIONS).alias("contributions"))


def attribution_gap(explained: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, gap): base value plus contributions, minus the log-odds of the score. Zero up to rounding."""
    total = F.aggregate("contributions", F.col("base_value"), lambda acc, c: acc + c["contribution"])
    return explained.select(*keys, (total - F.ln(F.col(SCORE) / (1 - F.col(SCORE)))).alias("gap"))


# ------------------------------------------------------------------ reports


def top_contributions(explained: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` largest absolute contributions of every row with their rank, ties by feature name.

    Sorted inside the row's array: no shuffle and no window.
    """
    rest = [c for c in explained.columns if c != "contributions"]
    keyed = F.transform("contributions", lambda c: F.struct(
        (-F.abs(c["contribution"])).alias("order"), c["feature"].alias("feature"),
        c["contribution"].alias("contribution")))
    top = F.slice(F.sort_array(keyed), 1, k)
    return explained.select(*rest, F.posexplode(top).alias("_pos", "_c")).select(
        *rest, (F.col("_pos") + 1).alias("rank"), F.col("_c.feature").alias("feature"),
        F.col("_c.contribution").alias("contribution"))


def long_contributions(explained: DataFrame) -> DataFrame:
    """One line per row and feature."""
    rest = [c for c in explained.columns if c != "contributions"]
    return explained.select(*rest, F.inline("contributions"))


def global_importance(explained: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature over all rows."""
    return long_contributions(explained).groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance"))
