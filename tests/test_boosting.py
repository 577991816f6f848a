"""Histogram boosting against trees found by trying every split, and its properties as a Spark job."""

import time

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from learnlake.operators import boosting
from learnlake.operators.boosting import TRAIN, VALIDATE, Boosting, Tree


def soft(g, l1):
    return np.sign(g) * max(abs(g) - l1, 0.0)


def plain_split(bins, g, h, rows, features, s):
    """The best (gain, feature, bin) of a set of rows; the first among equals."""
    def score(part):
        return soft(g[part].sum(), s.l1) ** 2 / (h[part].sum() + s.l2)

    best = (1e-12, -1, -1)
    for f in features:
        for b in range(bins[f].max()):
            low = bins[f, rows] <= b
            left, right = rows[low], rows[~low]
            if min(len(left), len(right)) < s.min_rows or min(h[left].sum(), h[right].sum()) < s.min_hessian:
                continue
            gain = (score(left) + score(right) - score(rows)) / 2
            if gain > best[0] + 1e-9:
                best = (gain, f, b)
    return best


def plain_tree(bins, g, h, rows, features, s):
    """Leaves as (value, rows), splitting level by level or, with ``max_leaves``, the leaf with the largest gain."""
    leaves = [(rows, 0, plain_split(bins, g, h, rows, features, s))]
    while True:
        can = [(leaf, k) for k, leaf in enumerate(leaves) if leaf[2][1] >= 0 and leaf[1] < s.max_depth]
        if not can or (s.max_leaves and len(leaves) >= s.max_leaves):
            break
        leaf, k = max(can, key=lambda c: c[0][2][0])
        part, depth, (_, f, b) = leaf
        low = bins[f, part] <= b
        leaves[k:k + 1] = [(x, depth + 1, plain_split(bins, g, h, x, features, s)) for x in (part[low], part[~low])]
    return [(-s.step * soft(g[r].sum(), s.l1) / (h[r].sum() + s.l2), r) for r, _, _ in leaves]


def problem(seed, n, width, n_bins):
    rnd = np.random.default_rng(seed)
    bins = rnd.integers(0, n_bins, (width, n))
    logit = sum(rnd.normal() * (bins[f] - n_bins / 2) / 3 for f in range(width)) + rnd.normal(size=n)
    return bins, (logit > 0).astype(float), rnd.integers(0, 1 << 62, n)


@pytest.mark.parametrize("settings", [
    Boosting(max_depth=4, l1=0.3, l2=1.5, row_share=0.8, feature_share=0.6, min_hessian=2.0),
    Boosting(max_depth=62, max_leaves=63, l2=0.0, row_share=0.85, bag_every=5, feature_share=1.0, min_rows=4, min_hessian=1e-3),
])
def test_trees_equal_trying_every_split(settings):
    bins, label, keys = problem(1, 900, 5, 12)
    # Random margins to begin with: with equal gradients many splits would be equally good.
    margin = np.random.default_rng(9).normal(size=900)
    model = boosting._Model(0, np.full(900, TRAIN, np.int8), margin.copy(), [])
    found = list(boosting.grow(bins, label, keys, [model], 0, 7, 12, settings, lambda a: a, False))
    assert [len(t.left) > 0 for _, _, _, t in found] == [True] * 7 + [False]
    for _, r, _, tree in found[:-1]:
        p = 1 / (1 + np.exp(-margin))
        rows = np.flatnonzero(boosting.bagged(keys, settings, r))
        expected = np.empty(900)
        leaves = plain_tree(bins, p - label, p * (1 - p), rows, boosting.chosen_features(5, settings, r), settings)
        for value, part in leaves:
            expected[part] = value
        got = tree.margins(bins)
        assert np.allclose(got[rows], expected[rows], atol=1e-9)
        assert sum(a < 0 for a in tree.left) == len(leaves)
        margin += got
    if settings.max_leaves:
        assert len(leaves) == 63 and tree.depth > 6
        bags = [boosting.bagged(keys, settings, r) for r in range(6)]
        assert all((b == bags[0]).all() for b in bags[:5]) and (bags[5] != bags[0]).any()


def table(spark, seed=2, n=3000, width=6):
    bins, label, _ = problem(seed, n, width, 40)
    rows = [(i, [float(x) * 1.5 for x in bins[:, i]], int(label[i])) for i in range(n)]
    frame = spark.createDataFrame(rows, "id long, x array<double>, label int")
    return frame.withColumn("role", F.when(F.col("id") % 5 == 0, VALIDATE).otherwise(TRAIN)).cache()


def same(a, b):
    return len(a) == len(b) and all(
        x.feature == y.feature and x.bin == y.bin and np.allclose(x.value, y.value, atol=1e-9) for x, y in zip(a, b, strict=True))


SHORT = Boosting(rounds=300, step=0.2, max_depth=3, patience=10)


def test_fit_goes_on_over_jobs_and_tasks(spark, monkeypatch):
    rows = table(spark)
    one, edges, losses = boosting.fit(rows, "x", "label", "role", 6, SHORT)
    best = int(np.argmin(losses))
    assert 1 < len(one) == best < 300 and len(losses) == best + 11
    assert losses[best] < losses[1] < losses[0] == pytest.approx(np.log(2))
    monkeypatch.setattr(boosting, "ROUNDS_PER_JOB", 60)
    again, _, more = boosting.fit(rows, "x", "label", "role", 6, SHORT)
    assert same(one, again) and np.allclose(losses, more)
    monkeypatch.setattr(boosting, "ROWS_PER_TASK", 1000)
    spread, _, _ = boosting.fit(rows.repartition(6), "x", "label", "role", 6, Boosting(rounds=3, step=0.2, max_depth=3))
    alone, _, _ = boosting.fit(rows, "x", "label", "role", 6, Boosting(rounds=3, step=0.2, max_depth=3))
    assert len(spread) == 3 and same(alone, spread)


def test_models_grown_together_equal_models_grown_alone(spark):
    rows = table(spark, 3, 1500)
    roles = [f"r{k}" for k in range(3)]
    rows = rows.withColumns({r: F.when(F.col("id") % 3 == k, 0).otherwise(F.col("role")) for k, r in enumerate(roles)})
    settings = Boosting(rounds=40, step=0.3, max_depth=3, patience=5)
    together, _, losses = boosting.fit_many(rows, "x", "label", roles, 6, settings)
    for k, r in enumerate(roles):
        alone, _, own = boosting.fit(rows, "x", "label", r, 6, settings)
        assert same(alone, together[k]) and np.allclose(own, losses[k])
    assert len({len(f) for f in together}) > 1


@pytest.mark.parametrize("settings", [SHORT, Boosting(rounds=12, step=0.3, max_depth=62, max_leaves=31, min_rows=5, min_hessian=0.0)])
def test_spark_model_scores_as_the_forest(spark, settings):
    rows = table(spark, 4, 800)
    forest, edges, _ = boosting.fit(rows, "x", "label", "role", 6, settings)
    model = boosting.spark_model(spark, forest, edges, 6)
    assert model.getNumTrees == len(forest)
    scored = model.transform(rows.withColumn("features", array_to_vector("x")))
    for r in scored.select("x", vector_to_array("probability")[1].alias("p")).limit(50).collect():
        bins = np.array([[np.searchsorted(e, v, "left")] for e, v in zip(edges, r.x, strict=True)])
        margin = sum(t.margins(bins)[0] for t in forest)
        assert r.p == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-9)


def test_no_rows_constant_columns_and_no_validation(spark):
    rows = table(spark, 5, 200).withColumn("x", F.array(F.lit(1.0), F.lit(2.0))).withColumn("role", F.lit(TRAIN))
    forest, _, losses = boosting.fit(rows, "x", "label", "role", 2, Boosting(rounds=3, patience=2))
    assert len(forest) == 3 and all(t.left == [-1] for t in forest) and all(np.isnan(losses))
    assert boosting.fit(rows.limit(0), "x", "label", "role", 2, SHORT)[0] == []


def test_tree_margins():
    tree = Tree([0, -1, 1, -1, -1], [2, -1, 0, -1, -1], [1, -1, 3, -1, -1], [2, -1, 4, -1, -1], [0.0, 1.0, 0.0, 2.0, 3.0], [1.0] * 5, [1.0] * 5)
    assert tree.depth == 2
    assert tree.margins(np.array([[2, 3, 3], [0, 0, 1]])).tolist() == [1.0, 2.0, 3.0]


@pytest.mark.parametrize("settings", [
    Boosting(rounds=20, step=0.2, max_depth=3),
    Boosting(rounds=6, step=0.3, max_depth=62, max_leaves=15, min_rows=5, min_hessian=0.0),
])
def test_spread_models_equal_held_ones_without_waiting(spark, monkeypatch, settings):
    rows = table(spark, 6)
    roles = ["r0", "r1"]
    rows = rows.withColumns({r: F.when(F.col("id") % 3 == k, 0).otherwise(F.col("role")) for k, r in enumerate(roles)})
    # A category: its two bins are looked at apart from the other columns.
    rows = rows.withColumn("x", F.concat("x", F.array((F.col("id") % 2).cast("double")))).repartition(6).cache()
    held, _, losses = boosting.fit_many(rows, "x", "label", roles, 7, settings)
    monkeypatch.setattr(boosting, "ROWS_PER_TASK", 1000)
    monkeypatch.setattr(boosting, "ROUNDS_PER_LINEAGE", 11)
    start = time.monotonic()
    spread, _, more = boosting.fit_many(rows, "x", "label", roles, 7, settings)
    seconds = time.monotonic() - start
    assert all(same(a, b) for a, b in zip(held, spread, strict=True)) and np.allclose(losses, more)
    # At least 60 exchanges of the first setting, a second each when barrier tasks waited for one another.
    assert seconds < 50


def test_splits_of_two_bins_equal_those_of_padded_columns():
    rnd = np.random.default_rng(7)
    sizes, features = np.array([2, 9, 2, 2, 5]), np.arange(5)
    hist = np.abs(rnd.normal(size=(12, 5, 9, 3))) * 5
    hist[..., 0] -= 3
    for f, n in enumerate(sizes):
        hist[:, f, n:] = 0
    s = Boosting(min_hessian=0.0)
    found, plain = boosting.best_splits(hist, features, s, sizes), boosting.best_splits(hist, features, s)
    assert found == plain and {f for _, f, _ in found} - {1, 4}


def test_columns_of_few_bins_are_counted_together():
    rnd = np.random.default_rng(8)
    sizes = [2] * 17 + [64, 1, 5, 256]
    bins = np.stack([rnd.integers(0, n, 9000) for n in sizes])
    packed = boosting.Packing(sizes).packed(bins)
    assert len(packed.codes) == 5 and packed.shape == bins.shape
    g, h = boosting._slopes(rnd.integers(0, 2, 9000), rnd.normal(size=9000))
    features = np.array([0, 3, 16, 17, 18, 19, 20])
    for rows in (rnd.permutation(9000), rnd.permutation(9000)[:500]):
        groups = [(rows[:300], g, h), (rows[300:], g, h)]
        found = boosting._count(packed, groups, features, 256)
        for k, (part, _, _) in enumerate(groups):
            for i, f in enumerate(features):
                assert (boosting._at(packed, f, part) == bins[f, part]).all()
                plain = [np.bincount(bins[f, part], w, 256) for w in (g[part], h[part], None)]
                # To the last bit, whatever the order of the rows.
                assert (found[k, i] == np.stack(plain, axis=1)).all()


def test_borders_that_part_nothing_are_left_out(spark):
    rows = spark.range(2000).select(F.array(
        (F.col("id") % 2).cast("double"), (F.col("id") % 200 == 0).cast("double"), F.lit(7.0), F.col("id").cast("double"),
        F.when(F.col("id") % 2 == 0, float("nan")).otherwise(1.0)).alias("x"))
    edges = boosting.bin_edges(rows, "x", 5, 16)
    assert [e.tolist() for e in edges[:3]] == [[0.0], [0.0], []]
    assert len(edges[3]) == 15
    # NaN lies above the border.
    assert edges[4].tolist() == [1.0]


@pytest.mark.parametrize("most, settings", [
    (1500, Boosting(rounds=4, step=0.3, max_depth=4)),
    (400, Boosting(rounds=4, step=0.3, max_depth=62, max_leaves=31, min_rows=5)),
])
def test_rows_of_few_tasks_stay_together(spark, monkeypatch, most, settings):
    """A job a step takes longer than the rows, most of all when trees grow leaf by leaf."""
    used, spread = [], boosting._Spread
    monkeypatch.setattr(boosting, "_Spread", lambda *args: used.append(1) or spread(*args))
    rows = table(spark, 9).repartition(6)
    alone, _, _ = boosting.fit(rows, "x", "label", "role", 6, settings)
    monkeypatch.setattr(boosting, "ROWS_PER_TASK", most)
    assert same(alone, boosting.fit(rows, "x", "label", "role", 6, settings)[0]) and not used
    monkeypatch.setattr(boosting, "ROWS_PER_TASK", most // 2)
    apart, _, _ = boosting.fit(rows, "x", "label", "role", 6, settings)
    # To the last bit.
    assert used and [t.value for t in apart] == [t.value for t in alone] and [t.bin for t in apart] == [t.bin for t in alone]
