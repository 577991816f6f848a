"""Hard negatives against all inner products."""

import math
import random
import sys
from pathlib import Path

import numpy as np
import pytest

from learnlake.llm import cover_tree
from learnlake.llm.cover_tree import Tree, Wanted, search
from learnlake.llm.queries import ORACLES, QUERIES

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from oracle_check import compare, duck  # noqa: E402


def brute(rows):
    usable = []
    for uid, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        usable.append((uid, i, label, [math.floor(256 * x) for x in v]))
    out = []
    for uid, i, label, v in usable:
        if i is None or i % 100:
            continue
        scored = sorted((-sum(map(int.__mul__, v, w)), j is None, j or 0, j, m) for k, j, m, w in usable if k != uid)
        for s, _, _, j, _ in [r for r in scored if r[4] == label][:5]:
            near = [r for r in scored if r[4] != label and -80 * s <= -100 * r[0] <= -100 * s][:5]
            out += [(i, j, rank, r[3], -s, -r[0]) for rank, r in enumerate(near, 1)]
    return out


def vectors(seed, n, width, spread=0.2):
    """Vectors around a few centers, with repeated ones, short ones and rows that take no part."""
    rnd = random.Random(seed)
    centers = [[rnd.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = rnd.choice(centers)
        rows.append((i * 10, [x + rnd.gauss(0, spread) for x in c], rnd.randrange(4)))
    rows += [(r[0] + 1, r[1], 3 - r[2]) for r in rows[::7]]
    rows += [(400, None, 1), (500, rows[1][1], None), (600, [float("nan")] * width, 1), (700, [None] * width, 1),
             (800, [float("inf")] * width, 2), (901, [0.0] * width, 2), (1000, [0.0] * width, 2), (None, rows[2][1], 1),
             (1100, rows[3][1][:1], 1), (1200, [], 2), (200, rows[4][1], 2), (200, rows[4][1], 2)]
    return rows


def table(spark, rows):
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return docs.selectExpr("*", "1 AS uid", "2 AS shard", "'x' AS v", "3 AS score")


@pytest.mark.parametrize(("rows", "width", "tree_rows"), [(300, 3, 40), (200, 8, 2_048)])
def test_equals_all_inner_products(spark, monkeypatch, rows, width, tree_rows):
    monkeypatch.setattr(cover_tree, "TREE_ROWS", tree_rows)
    monkeypatch.setattr(cover_tree, "BLOCK_QUERIES", 10)
    data = vectors(rows, rows, width)
    got = [tuple(r) for r in cover_tree.hard_negatives(table(spark, data).repartition(5)).collect()]
    expected = brute(data)
    assert expected
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_empty_and_nothing_usable(spark):
    empty = table(spark, vectors(1, 5, 3)).limit(0)
    assert cover_tree.hard_negatives(empty).collect() == []
    assert cover_tree.hard_negatives(table(spark, [(100, None, 1), (200, [1.0], None)])).collect() == []


def test_search_skips_and_loses_nothing(monkeypatch):
    rnd = np.random.default_rng(3)
    centers = rnd.normal(size=(12, 6)) * 300
    points = np.floor(centers[rnd.integers(0, 12, 3000)] + rnd.normal(size=(3000, 6)) * 12).astype(np.int64)
    labels = rnd.integers(0, 5, 3000)
    ids = rnd.integers(0, 800, 3000)
    tree = Tree.load(Tree.build(np.arange(3000), ids, np.ones(3000, bool), labels, points).dump())
    # Levels: every point lies within its node's radius, every child below its parent.
    assert sorted(tree.uid.tolist()) == list(range(3000))
    for k in range(len(tree.first)):
        for c in range(tree.first[k], tree.last[k]):
            assert tree.low[k] <= tree.low[c] < tree.high[c] <= tree.high[k]
    looked = []
    plain = cover_tree._verify
    monkeypatch.setattr(cover_tree, "_verify", lambda t, w, p, s: (looked.append(len(p)), plain(t, w, p, s)))
    queries = points[:40]
    scores = queries @ points.T
    for same in (True, False):
        windows = [[(-np.inf, np.inf)] if same else [(0.5 * s.max(), 0.8 * s.max()), (0.8 * s.max(), 0.9 * s.max())] for s in scores]
        wanted = [Wanted(i, int(labels[i]), same, w) for i, w in enumerate(windows)]
        search(tree, wanted, queries)
        for i, w in enumerate(wanted):
            for (low, high), best in zip(w.windows, w.best, strict=True):
                fits = [(-int(scores[i, p]), False, int(ids[p]), p) for p in range(3000)
                        if p != i and (labels[p] == labels[i]) == same and low <= scores[i, p] <= high]
                assert best == sorted(fits)[:5]
    assert sum(looked) < 0.5 * 2 * 40 * 3000


def test_query_equals_sql(spark):
    sf, name = "/root/testdata/sf0.01", "op13_hard_negatives"
    assert compare(spark, duck(sf), sf, QUERIES[name], ORACLES[name]) == ""
