import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from learnlake.functions import ordering
from learnlake.operators import drift, metrics, split


def brute_auc(y, s):
    pairs = [(a > b) + 0.5 * (a == b) for a, p in zip(s, y) if p for b, q in zip(s, y) if not q]
    return sum(pairs) / len(pairs) if pairs else None


def brute_ap(y, s):
    total, last, out = sum(y), 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        above = [p for p, v in zip(y, s) if v >= t]
        recall, precision = sum(above) / total, sum(above) / len(above)
        out += (recall - last) * precision
        last = recall
    return out


def scored(spark, y, s):
    return spark.createDataFrame(list(zip(map(int, y), map(float, s))), "y int, s double")


def test_metrics_toy(spark):
    row = metrics.classification_metrics(scored(spark, [0, 1, 1, 0, 1], [.1, .9, .8, .3, .7]), "y", "s").first()
    assert row.roc_auc == 1.0 and row.accuracy == 1.0 and row.f1 == 1.0 and row.pr_auc == pytest.approx(1.0)
    assert row.brier == pytest.approx((.01 + .01 + .04 + .09 + .09) / 5)


def test_metrics_against_brute_force_with_ties_and_hot_slice(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        g = "hot" if i % 3 else rng.choice("abcdef")
        s = 0.5 if rng.random() < 0.3 else round(rng.random(), 2)
        rows.append((g, int(rng.random() < s), s))
    df = spark.createDataFrame(rows, "g string, y int, s double")
    got = {r.slice_value: r for r in metrics.fairness_metrics(df, "y", "s", ["g"]).collect()}
    for g in {r[0] for r in rows}:
        y, s = zip(*[(r[1], r[2]) for r in rows if r[0] == g])
        assert got[g].n == len(y)
        assert got[g].roc_auc == pytest.approx(brute_auc(y, s), abs=1e-12)
        assert got[g].pr_auc == pytest.approx(brute_ap(y, s), abs=1e-12)
        hits = [v >= 0.5 for v in s]
        assert got[g].accuracy == pytest.approx(np.mean([h == bool(p) for h, p in zip(hits, y)]))
        assert got[g].precision == pytest.approx(sum(p for h, p in zip(hits, y) if h) / sum(hits))
        assert got[g].brier == pytest.approx(np.mean([(v - p) ** 2 for v, p in zip(s, y)]))


def test_auc_of_negated_scores(spark):
    rng = random.Random(1)
    y, s = [rng.randint(0, 1) for _ in range(500)], [rng.random() for _ in range(500)]
    a = metrics.classification_metrics(scored(spark, y, s), "y", "s").first().roc_auc
    b = metrics.classification_metrics(scored(spark, y, [-v for v in s]), "y", "s").first().roc_auc
    assert a + b == pytest.approx(1.0)


def test_single_class_slice(spark):
    rows = [(0, .2, "M"), (1, .8, "M"), (0, .4, "F"), (0, .6, "F"), (1, .3, None)]
    df = spark.createDataFrame(rows, "y int, s double, g string")
    got = {r.slice_value: r for r in metrics.fairness_metrics(df, "y", "s", ["g"]).collect()}
    assert set(got) == {"M", "F"}
    assert got["F"].roc_auc is None and got["F"].pr_auc == 0.0 and got["F"].recall == 0.0 and got["F"].n == 2


def test_fairness_fixture(spark):
    df = spark.createDataFrame(
        list(zip([0, 1, 1, 0, 1, 0], [.2, .8, .7, .4, .6, .3], "MMMFFF")), "y int, s double, g string")
    assert {r.slice_value for r in metrics.fairness_metrics(df, "y", "s", ["g"]).collect()} == {"M", "F"}


def test_calibration(spark):
    df = scored(spark, [0, 1] * 50, [i / 100 for i in range(100)])
    for strategy in ("quantile", "uniform"):
        rows = metrics.calibration_table(df, "y", "s", 10, strategy).collect()
        assert sorted(r.bin for r in rows) == list(range(1, 11)) and {r.n for r in rows} == {10}


def test_cv_summary(spark):
    per_fold = spark.createDataFrame([(1, 0.5), (2, 0.7)], "fold int, accuracy double")
    row = metrics.cv_summary(per_fold, ["accuracy"]).first()
    assert (row.metric, row["mean"]) == ("accuracy", pytest.approx(0.6)) and row["std"] == pytest.approx(0.02 ** 0.5)


# ------------------------------------------------------------------ quantiles and drift


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6) | st.sampled_from([0.0, 1.0, 1.0]), min_size=1, max_size=60))
def test_exact_quantiles_equal_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    probs = [0, 0.1, 0.25, 0.5, 0.77, 1]
    got = ordering.exact_quantiles(df, ["x"], probs)["x"]
    assert got == pytest.approx(np.quantile(values, probs), rel=1e-12, abs=1e-9)


def test_exact_quantiles_refine_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", 50)
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.sqrt("id")).alias("a"), F.log1p("id").alias("b"),
        F.lit(None).cast("double").alias("c"))
    pdf = df.toPandas()
    got = ordering.exact_quantiles(df, ["a", "b", "c"], [0.1, 0.5, 0.9])
    for c in "ab":
        assert got[c] == pytest.approx(np.quantile(pdf[c], [0.1, 0.5, 0.9]))
    assert got["c"] == [None, None, None]


def test_exact_quantiles_with_one_very_frequent_value(spark, monkeypatch):
    """A third of the rows share one value, far more than a bucket may hold: few rounds, exact result."""
    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", 100)
    rounds, refine = [], ordering._refine
    monkeypatch.setattr(ordering, "_refine", lambda *a: rounds.append(1) or refine(*a))
    df = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, 0.25).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000003)) / 1000003).alias("x"))
    values = df.toPandas()["x"]
    probs = [0.1, 0.25, 0.4, 0.5, 0.9]
    assert ordering.exact_quantiles(df, ["x"], probs)["x"] == pytest.approx(np.quantile(values, probs))
    assert len(rounds) <= 4


def test_quantiles_skip_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    assert ordering.exact_quantiles(df, ["x"], [0.5])["x"] == [2.0]


def numpy_psi(expected, actual, bins=10):
    edges = np.quantile(expected, np.linspace(0, 1, bins + 1))
    inner = edges[1:-1]
    place = lambda v: np.bincount(np.searchsorted(inner, v, side="right"), minlength=bins)
    e, a = place(expected) / len(expected) + 1e-9, place(actual) / len(actual) + 1e-9
    return float(np.sum((a - e) * np.log(a / e)))


def test_psi_same_law_is_small_and_matches_numpy(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=5000), rng.normal(size=5000)
    tied_a, tied_b = rng.integers(0, 4, 5000).astype(float), rng.integers(0, 5, 5000).astype(float)
    frame = lambda x, y: spark.createDataFrame([(float(i), float(j)) for i, j in zip(x, y)], "x double, t double")
    train, serve = frame(a, tied_a), frame(b, tied_b)
    got = {r.feature: r.psi for r in drift.psi(train, serve, ["x", "t"]).collect()}
    assert got["x"] < 0.1
    assert got["x"] == pytest.approx(numpy_psi(a, b)) and got["t"] == pytest.approx(numpy_psi(tied_a, tied_b))
    same = {r.feature: r.psi for r in drift.psi(train, train, ["x", "t"]).collect()}
    assert same == {"x": pytest.approx(0), "t": pytest.approx(0)}


def test_drift_report(spark):
    train = spark.range(1000).selectExpr("id AS a", "cast(id % 10 as double) AS b", "cast(null as double) AS c", "'x' AS s")
    serve = spark.range(1000).selectExpr("id + 900 AS a", "cast(id % 10 as double) AS b", "1.0D AS c")
    rows = drift.drift_report(train, serve).collect()
    assert [(r.feature, r.drifted) for r in rows] == [("a", True), ("b", False), ("c", False)]
    assert rows[2].psi is None


# ------------------------------------------------------------------ splits


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(1003).selectExpr("id", "CASE WHEN id % 10 < 3 THEN 1 ELSE 0 END AS y").cache()


def test_split_is_exact_per_class_and_reproducible(labelled):
    sizes = {r.y: r.n for r in labelled.groupBy("y").agg(F.count("*").alias("n")).collect()}
    out = split.stratified_split(labelled, "y", 0.2, 1, ["id"])
    got = {r.y: r.n for r in out.filter("is_test").groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert got == {y: round(n * 0.2) for y, n in sizes.items()} and out.count() == 1003
    again = split.stratified_split(labelled.repartition(5), "y", 0.2, 1, ["id"])
    assert {r.id for r in again.filter("is_test").collect()} == {r.id for r in out.filter("is_test").collect()}
    other = split.stratified_split(labelled, "y", 0.2, 2, ["id"])
    assert {r.id for r in other.filter("is_test").collect()} != {r.id for r in out.filter("is_test").collect()}


def test_split_of_share_too_small_for_a_row(spark):
    df = spark.createDataFrame([(1, 0), (2, 1)], "id long, y int")
    assert split.stratified_split(df, "y", 0.2, 1, ["id"]).filter("is_test").count() == 0


@pytest.mark.parametrize("folds", [2, 5, 7])
def test_folds_are_balanced(labelled, folds):
    out = split.stratified_folds(labelled, "y", folds, 4, ["id"])
    sizes = {}
    for r in out.groupBy("y", "fold").agg(F.count("*").alias("n")).collect():
        sizes.setdefault(r.y, {})[r.fold] = r.n
    for per_fold in sizes.values():
        assert set(per_fold) == set(range(1, folds + 1)) and max(per_fold.values()) - min(per_fold.values()) <= 1


def test_many_classes(spark):
    df = spark.range(2000).selectExpr("id", "id % 200 AS y")
    out = split.stratified_folds(df, "y", 2, 0, ["id"])
    assert {r.n for r in out.groupBy("y", "fold").agg(F.count("*").alias("n")).collect()} == {5}


@pytest.mark.parametrize("n", [0, 1, 100, 1003, 5000])
def test_sample_size(labelled, n):
    assert split.seeded_sample(labelled, n, 0, ["id"]).count() == min(n, 1003)


def test_sample_has_exactly_n_rows_on_equal_keys(spark):
    from learnlake.operators.split import seeded_sample

    frame = spark.createDataFrame([(1, "a", "p", i) for i in range(5)],
                                  "id_student long, code_module string, code_presentation string, v int")
    assert seeded_sample(frame, 2).count() == 2 and seeded_sample(frame, 9).count() == 5


def test_fingerprint_tells_nulls_and_separators_apart(spark):
    from learnlake.operators.profile import fingerprint

    a = spark.createDataFrame([("a|b", "c"), ("\\N", "x")], "p string, q string")
    b = spark.createDataFrame([("a", "b|c"), (None, "x")], "p string, q string")
    assert fingerprint(a).first().digest != fingerprint(b).first().digest
    assert fingerprint(a).first() == fingerprint(a.orderBy("q")).first()


def test_sketches_of_all_tasks_never_meet(spark):
    """Quantile sketches are merged per group of tasks, then per column: no exchange goes to a single partition."""
    df = spark.range(0, 100_000, 1, 40).selectExpr("double(id % 5000) AS a", "double(id) AS b", "CAST(NULL AS DOUBLE) AS c")
    plans = []
    plain = type(df).collect

    def watched(frame):
        rows = plain(frame)
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return rows

    type(df).collect = watched
    try:
        cuts = ordering.cut_points(df, ["a", "b", "c"], [0.25, 0.5, 0.75])
    finally:
        type(df).collect = plain
    assert plans and "kll" in plans[0] and "SinglePartition" not in plans[0]
    assert cuts["c"] == [] and all(abs(x - q * 5000) < 60 for x, q in zip(cuts["a"], (0.25, 0.5, 0.75), strict=True))
    assert ordering.cut_points(df.limit(0), ["a"], [0.5]) == {"a": []}
