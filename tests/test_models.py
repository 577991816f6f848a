import itertools
import math
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from learnlake import KEYS
from learnlake.operators import boosting, explain, score, train
from learnlake.operators.metrics import classification_metrics

SETTINGS = {"rounds": 6, "max_depth": 3, "step": 0.3, "feature_share": 1.0}


@pytest.fixture(scope="module")
def gold(spark):
    """Planted signal: students with few clicks are at risk, with some noise."""
    return spark.range(600).selectExpr(
        "id AS id_student", "concat('M', id % 2) AS code_module", "'P' AS code_presentation",
        "CASE WHEN id % 7 = 0 THEN NULL WHEN id % 2 = 0 THEN 'M' ELSE 'F' END AS gender",
        "CAST(id * 37 % 101 AS BIGINT) AS total_clicks", "CASE WHEN id % 5 > 0 THEN CAST(id % 11 AS DOUBLE) END AS active_days",
        "CASE WHEN id * 37 % 101 < 50 AND id % 9 > 0 THEN 1 ELSE 0 END AS final_result_binary").cache()


@pytest.fixture(scope="module")
def trained(spark, gold, tmp_path_factory):
    model, manifest, rows, scored = train.train_and_report(gold, settings=SETTINGS)
    root = str(tmp_path_factory.mktemp("artifacts"))
    run = train.save_model(spark, model, manifest, f"{root}/run_{manifest.run_id}")
    return model, manifest, root, run


def test_planted_signal_is_found(trained):
    _, manifest, _, _ = trained
    assert manifest.metrics["roc_auc"] > 0.9
    assert manifest.training_seconds > 0 and len(manifest.dataset_hash) == 12


def test_feature_names_one_hot_inside_the_model(trained):
    names = trained[1].feature_columns
    assert {"gender_F", "gender_M", "gender_UNK", "code_module_M0", "total_clicks", "active_days"} <= set(names)
    assert not any("final_result" in n or "id_student" in n for n in names)


def test_save_promote_load(spark, gold, trained):
    model, manifest, root, run = trained
    with pytest.raises(FileNotFoundError):
        train.latest(spark, root)
    assert [train.promote(spark, r, root) for r in (f"{root}/earlier", run)] == [1, 2]
    assert train.latest(spark, root) == run
    # A promotion that dies half-way leaves files nobody reads.
    started = Path(root, "promotions", "_temporary", "0", "task")
    started.mkdir(parents=True)
    started.joinpath("part-00000.json").write_text('{"number": 3, "directory": "half"')
    assert train.latest(spark, root) == run
    again, loaded = train.load_model(spark, run)
    assert loaded == manifest
    a = train.predict_proba(model, gold).orderBy("id_student").select("risk_score").limit(20).collect()
    b = train.predict_proba(again, gold).orderBy("id_student").select("risk_score").limit(20).collect()
    assert a == b
    assert train.manifest_frame(spark, loaded).first().run_id == manifest.run_id


def test_score_fills_missing_inputs_and_unseen_categories(spark, trained):
    model, manifest, _, _ = trained
    raw = spark.createDataFrame([(1, "ZZZ", "P", "X")], "id_student long, code_module string, code_presentation string, gender string")
    row = score.score(raw, model, manifest).first()
    assert 0 <= row.risk_score <= 1 and row.model_version == manifest.run_id
    assert row.risk_label == ("at_risk" if row.risk_score >= 0.5 else "on_track")


def test_predict_uses_inclusive_threshold(gold, trained):
    out = train.predict(trained[0], gold, 0.5)
    assert out.filter((F.col("risk_score") >= 0.5).cast("int") != F.col("prediction")).count() == 0


def test_record_defaults_and_alignment(spark):
    df = spark.createDataFrame([(1, "A", None)], "id_student long, code_module string, disability string")
    row = score.complete_record(df).first()
    assert (row.disability, row.num_of_prev_attempts, row.total_clicks, row.imd_band) == ("N", 0, 0.0, None)
    assert len(row) == 28
    assert score.align_features(df.select(F.lit(2).alias("b")), ["a", "b"]).first() == (0.0, 2.0)


def test_attributions_add_up_to_the_margin(spark, gold, trained):
    model, manifest, _, run = trained
    explained = explain.explain_tree(gold, f"{run}/model", manifest.feature_columns, KEYS)
    gaps = explain.attribution_gap(explained, KEYS)
    assert gaps.count() == 600
    assert gaps.agg(F.max(F.abs("gap"))).first()[0] < 1e-6
    same = explained.join(train.predict_proba(model, gold).withColumnRenamed("risk_score", "s"), KEYS)
    assert same.filter("abs(s - risk_score) > 1e-12").count() == 0


def _tree_game(leaves, x, present):
    total = 0.0
    for leaf in leaves:
        p = leaf.value
        for f, low, high, cover in zip(leaf.features, leaf.low, leaf.high, leaf.cover):
            p *= float(low < x[f] <= high) if f in present else cover
        total += p
    return total


def test_attribution_equals_shapley_definition(spark, gold, trained):
    """Against the sum over all coalitions, on a few rows."""
    model, manifest, _, run = trained
    leaves = explain.load_leaves(spark, f"{run}/model")
    used = sorted({int(f) for leaf in leaves for f in leaf.features})
    few = gold.filter("id_student IN (3, 70, 501)")
    from pyspark.ml.functions import vector_to_array
    xs = {r.id_student: r.x for r in model.transform(few).select("id_student", vector_to_array("features").alias("x")).collect()}
    got = {r.id_student: {c.feature: c.contribution for c in r.contributions} for r in
           explain.explain_tree(few, f"{run}/model", manifest.feature_columns, KEYS).collect()}
    n = len(used)
    assert 2 <= n <= 12
    for student, x in xs.items():
        for f in used:
            rest = [u for u in used if u != f]
            value = sum(
                math.factorial(k) * math.factorial(n - k - 1) / math.factorial(n)
                * (_tree_game(leaves, x, {*s, f}) - _tree_game(leaves, x, set(s)))
                for k in range(n) for s in itertools.combinations(rest, k))
            assert got[student][manifest.feature_columns[f]] == pytest.approx(value, abs=1e-9)


def test_linear_attribution_and_reports(spark):
    df = spark.createDataFrame([(1, 1.0, 4.0), (2, 3.0, None)], "id long, a double, b double")
    explained = explain.explain_linear(df, {"a": 2.0, "b": -1.0}, ["id"], intercept=0.5)
    rows = {(r.id, r.feature): r.contribution for r in explain.long_contributions(explained).collect()}
    assert rows == {(1, "a"): -2.0, (1, "b"): -2.0, (2, "a"): 2.0, (2, "b"): 2.0}
    assert explained.first().base_value == 0.5 + 2 * 2.0 - 2.0
    top = [(r.id, r["rank"], r.feature) for r in explain.top_contributions(explained, 1).collect()]
    assert sorted(top) == [(1, 1, "a"), (2, 1, "a")]
    assert {r.feature: r.importance for r in explain.global_importance(explained).collect()} == {"a": 2.0, "b": 2.0}


def test_kfold(gold):
    rows = train.kfold_eval(gold, {"rounds": 6, "max_depth": 3, "step": 0.3, "feature_share": 1.0}, folds=3).collect()
    assert sorted(r.fold for r in rows) == [1, 2, 3] and sum(r.n for r in rows) == 600
    assert min(r.roc_auc for r in rows) > 0.8


def test_sequence_model(spark):
    clicks = spark.range(400).selectExpr(
        "id % 100 AS id_student", "'A' AS code_module", "'P' AS code_presentation", "1 AS id_site",
        "CAST(id * 13 % 28 AS BIGINT) AS date", "CASE WHEN id % 100 < 50 THEN 9 ELSE 1 END AS sum_click")
    labels = spark.range(110).selectExpr("id AS id_student", "'A' AS code_module", "'P' AS code_presentation",
                                         "CASE WHEN id < 50 THEN 0 ELSE 1 END AS final_result_binary")
    frame = train.sequence_frame(clicks, labels, 4)
    assert frame.count() == 110
    model, epochs = train.fit_sequence(frame, {"length": 4, "hidden": 8, "dense": 8, "step": 0.02, "epochs": 40})
    assert 1 <= epochs <= 40
    row = classification_metrics(train.predict_proba(model, frame), "final_result_binary", "risk_score").first()
    assert row.roc_auc > 0.9


def test_fused_score(spark):
    a = spark.createDataFrame([(1, 0.2), (2, 0.4)], "id long, risk_score double")
    b = spark.createDataFrame([(2, 0.8), (3, 0.6)], "id long, risk_score double")
    rows = {r.id: r.risk_score for r in score.fused_score(a, b, ["id"], (3.0, 1.0)).collect()}
    assert rows == {1: pytest.approx(0.2), 2: pytest.approx(0.5), 3: pytest.approx(0.6)}


def test_leaf_ranges_partition_the_space(spark, trained):
    """Every row falls into exactly one leaf of each tree."""
    leaves = explain.load_leaves(spark, f"{trained[3]}/model")
    x = np.random.default_rng(0).normal(50, 40, size=len(trained[1].feature_columns))
    hits = sum(all(lo < x[f] <= hi for f, lo, hi in zip(leaf.features, leaf.low, leaf.high)) for leaf in leaves)
    assert hits == len(trained[0].stages[-1].trees)
    assert Path(trained[3]).name.startswith("run_")


def test_rounds_up_to_the_smallest_loss():
    assert boosting.rounds_wanted([3.0, 2.0, 1.0, 1.5, 1.2], 2) == (2, True)
    assert boosting.rounds_wanted([3.0, 2.0, 1.0, 1.5], 2) == (2, False)
    assert boosting.rounds_wanted([1.0], 1) == (0, False)


def test_boosting_keeps_many_rounds_on_a_weak_additive_signal(spark):
    import math
    import random

    rnd = random.Random(6)
    rows = []
    for i in range(3000):
        x = [rnd.gauss(0, 1) for _ in range(8)]
        rows.append((i, "M", "P", *x, int(rnd.random() < 1 / (1 + math.exp(-1.2 * sum(x) / 2)))))
    columns = ", ".join(f"x{k} double" for k in range(8))
    frame = spark.createDataFrame(
        rows, f"id_student long, code_module string, code_presentation string, {columns}, final_result_binary int")
    marked = train.with_validation(frame, share=0.2).cache()
    model = train.fit_boosted(marked, {"max_depth": 2, "step": 0.1}, patience=10)
    rounds = model.stages[-1].getNumTrees
    assert rounds > 20

    def loss(fitted):
        p = train.predict_proba(fitted, marked.filter(train.VALIDATION)).select("risk_score", "final_result_binary").collect()
        return -sum(math.log(r[0] if r[1] else 1 - r[0]) for r in p) / len(p)

    one = train.fit_boosted(marked.drop(train.VALIDATION), {"max_depth": 2, "step": 0.1, "rounds": 1})
    assert loss(model) < loss(one) - 0.02


@pytest.mark.parametrize("used", [3, 8, 11])
def test_attribution_of_a_leaf_by_patterns(used):
    """Listed patterns of a short path and found ones of a long path, against every row's own product."""
    rnd = np.random.default_rng(used)
    low = np.where(rnd.random(used) < 0.5, -np.inf, -0.5)
    high = np.where(low == -np.inf, 0.8, np.where(rnd.random(used) < 0.5, np.inf, 0.9))
    leaf = explain.Leaf(1.5, np.arange(used), low, high, rnd.uniform(0.2, 0.9, used))
    columns = rnd.normal(size=(used, 40))
    nodes, weights = np.polynomial.legendre.leggauss(used // 2 + 1)
    nodes, weights = (nodes + 1) / 2, weights / 2
    found = explain._attribute(leaf, columns, nodes, weights)
    for i in range(40):
        hit = (columns[:, i] > low) & (columns[:, i] <= high)
        factor = hit[:, None] * nodes + leaf.cover[:, None] * (1 - nodes)
        for j in range(used):
            rest = np.delete(factor, j, axis=0).prod(axis=0) @ weights
            assert found[j, i] == pytest.approx(1.5 * (hit[j] - leaf.cover[j]) * rest, abs=1e-12)


def test_leaves_are_looked_up_in_groups(monkeypatch):
    """A whole tree's leaves, eight conditions at a time, against leaf by leaf; kept or computed anew."""
    rnd = np.random.default_rng(12)
    leaves = []

    def grow(depth, path):
        if depth == 7:
            used = sorted(path)
            ranges = np.array([path[f] for f in used])
            leaves.append(explain.Leaf(rnd.normal(), np.array(used), ranges[:, 0], ranges[:, 1], ranges[:, 2]))
            return
        f, border, share = int(rnd.integers(0, 12)), float(rnd.normal()), rnd.uniform(0.2, 0.8)
        low, high, cover = path.get(f, (-np.inf, np.inf, 1.0))
        border = border if low < border < high else (low + min(high, low + 1) if low > -np.inf else high - 1) / (2 if low > -np.inf else 1)
        grow(depth + 1, path | {f: (low, border, cover * share)})
        grow(depth + 1, path | {f: (border, high, cover * (1 - share))})

    grow(0, {})
    nodes, weights = np.polynomial.legendre.leggauss(5)
    nodes, weights = (nodes + 1) / 2, weights / 2
    columns = rnd.normal(size=(12, 500))
    columns[3, :40] = np.nan
    expected = np.zeros((12, 500))
    for leaf in leaves:
        for f, values in zip(leaf.features, explain._attribute(leaf, columns, nodes, weights), strict=True):
            expected[f] += values
    groups, long = explain.grouped(leaves)
    assert not long and len(leaves) == 128 and len(groups) <= 40
    for rows, kept in ((501, 1 << 30), (0, 1 << 30), (0, 0)):
        monkeypatch.setattr(explain, "GROUPED_ROWS", rows)
        monkeypatch.setattr(explain, "KEPT_BYTES", kept)
        assert np.allclose(explain._Attribution(leaves, nodes, weights).of(columns), expected, atol=1e-12)
    monkeypatch.setattr(explain, "CONDITIONS", 5)
    assert explain.grouped(leaves)[1]
    assert np.allclose(explain._Attribution(leaves, nodes, weights).of(columns), expected, atol=1e-12)
