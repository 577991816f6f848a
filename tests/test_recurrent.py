"""Recurrent classifier: gradients against differences, masking, and order that carries the label."""

import time

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from learnlake.operators import recurrent, train
from learnlake.operators.metrics import classification_metrics
from learnlake.operators.recurrent import Recurrent

SMALL = Recurrent(length=5, hidden=4, dense=3)


def sequences(seed, n, length, features):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, length, features)) * (rnd.random((n, length, 1)) < 0.7)
    return x, rnd.integers(0, 2, n).astype(float)


@pytest.mark.parametrize("dropped", [False, True])
def test_gradient_equals_differences(dropped):
    x, y = sequences(1, 6, 5, 2)
    # No zero biases: where all inputs are dropped they would put the dense layer on its kink.
    rnd = np.random.default_rng(8)
    w = {k: v + 0.3 * rnd.normal(size=v.shape) for k, v in recurrent.initial_weights(2, SMALL).items()}
    masks = {k: v.astype(float) for k, v in recurrent._masks(np.random.default_rng(2), 6, 2, SMALL).items()} if dropped else None
    _, g = recurrent.gradient(w, x, y, masks)
    for name, values in w.items():
        for at in list(np.ndindex(values.shape))[:40]:
            sides = []
            for step in (1e-5, -1e-5):
                moved = {k: v.copy() for k, v in w.items()}
                moved[name][at] += step
                sides.append(recurrent.gradient(moved, x, y, masks)[0])
            assert g[name][at] == pytest.approx((sides[0] - sides[1]) / 2e-5, rel=1e-4, abs=1e-6), (name, at)


def test_masked_steps_change_nothing():
    x, _ = sequences(3, 4, 5, 1)
    x[:, 3:] = 0
    w = recurrent.initial_weights(1, SMALL)
    assert np.allclose(recurrent.forward(w, x), recurrent.forward(w, x[:, :3]))


def test_binned_auc():
    rnd = np.random.default_rng(4)
    y, bins = rnd.integers(0, 2, 300), rnd.integers(0, 20, 300)
    pairs = [(a > b) + (a == b) / 2 for a in bins[y == 1] for b in bins[y == 0]]
    counts = [np.bincount(bins[y == k], minlength=20).astype(float) for k in (1, 0)]
    assert recurrent.binned_auc(*counts) == pytest.approx(np.mean(pairs))
    assert recurrent.binned_auc(np.zeros(3), np.ones(3)) == 0.5


def test_order_is_learned_and_the_model_is_saved(spark, tmp_path):
    """Every sequence holds the same numbers; whether the large one comes before the small one is the label."""
    rnd = np.random.default_rng(5)
    rows = []
    for i in range(1500):
        x = [0.0] * 8
        a, b = sorted(rnd.choice(8, 2, replace=False).tolist())
        first = int(rnd.integers(0, 2))
        x[a], x[b] = (2.0, 1.0) if first else (1.0, 2.0)
        rows.append((i, "A", "P", x, first))
    table = spark.createDataFrame(rows, "id_student long, code_module string, code_presentation string, x array<double>, final_result_binary int")
    frame = table.withColumn("features", array_to_vector("x")).drop("x")
    model, manifest, _, scored = train.train_and_report(
        frame, "sequence", {"length": 8, "hidden": 16, "dense": 8, "step": 0.01, "epochs": 30, "dropout": 0.1})
    assert manifest.metrics["roc_auc"] > 0.9 and 1 <= manifest.rounds <= 30
    run = train.save_model(spark, model, manifest, str(tmp_path / "run"))
    again, loaded = train.load_model(spark, run)
    assert loaded == manifest and isinstance(again, PipelineModel)
    both = scored.select("id_student", "risk_score").join(
        train.predict_proba(again, scored.drop("risk_score")).select("id_student", F.col("risk_score").alias("s")), "id_student")
    assert both.where("abs(risk_score - s) > 1e-12").count() == 0 and both.count() == scored.count()
    row = classification_metrics(scored, "final_result_binary", "risk_score").first()
    assert row.roc_auc == pytest.approx(manifest.metrics["roc_auc"])


def test_two_tasks_train_one_model(spark, monkeypatch):
    monkeypatch.setattr(recurrent, "ROWS_PER_TASK", 100)
    rows = spark.range(200).selectExpr("transform(sequence(1, 3), i -> double(id % (i + 1))) AS x", "int(id % 2) AS y", "1 AS role")
    model, history = recurrent.fit(rows, "x", "y", "role", Recurrent(length=3, hidden=4, dense=4, epochs=2, most_steps=2))
    assert len(history) == 2
    out = model.transform(rows.withColumn("features", array_to_vector("x"))).select("probability").collect()
    assert len(out) == 200 and all(abs(sum(r.probability) - 1) < 1e-6 for r in out)


def test_no_sequences(spark):
    rows = spark.range(0).selectExpr("array(double(1)) AS x", "1 AS y", "1 AS role")
    with pytest.raises(ValueError, match="no sequences"):
        recurrent.fit(rows, "x", "y", "role", Recurrent(length=1))


def test_many_steps_of_several_tasks_take_no_second_each(spark, monkeypatch):
    monkeypatch.setattr(recurrent, "ROWS_PER_TASK", 200)
    rows = spark.range(600).selectExpr(
        "transform(sequence(1, 4), i -> double(if(i = 1 + id % 2, 1, if(i = 4, 0, 0.5)))) AS x", "int(id % 2) AS y",
        "if(id % 5 = 0, 2, 1) AS role")
    start = time.monotonic()
    _, history = recurrent.fit(rows, "x", "y", "role", Recurrent(
        length=4, hidden=8, dense=4, epochs=4, batch=20, most_steps=25, step=0.02, dropout=0.0, recurrent_dropout=0.0))
    # 96 steps, a second each when barrier tasks waited for one another.
    assert time.monotonic() - start < 60 and history[-1] > 0.9


def test_only_active_steps_are_computed():
    x, _ = sequences(6, 9, 5, 2)
    x[0], x[1, 1:] = 0, 0
    w, kept = recurrent.initial_weights(2, SMALL), []
    alone = [recurrent.forward(w, x[i:i + 1][:, (x[i] != 0).any(axis=1)])[0] for i in range(9)]
    assert np.allclose(recurrent.forward(w, x, keep=kept), alone)
    # Rows computed over all steps: those that are active, of nine times five.
    assert sum(step[0] for step in kept[:-1]) == (x != 0).any(axis=2).sum() < 45
