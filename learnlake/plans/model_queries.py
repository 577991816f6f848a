"""Model queries: training, scoring, fusion and attribution."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake import KEYS
from learnlake.functions.ordering import exact_quantiles
from learnlake.operators import explain, score, train
from learnlake.operators.metrics import METRICS, classification_metrics
from learnlake.operators.registry import LABEL
from learnlake.plans.feature_queries import gold, gold_sql
from learnlake.plans.register import Views, query
from learnlake.session import shared_path
from learnlake.streaming import bronze, scoring

K = ", ".join(KEYS)
# One fit per application, tables and preset serves all queries that look at the same model.
_FITS: dict[tuple[str, str, str], tuple] = {}
# Features the planted label depends on, each through the side of its median.
PLANTED = ("total_clicks", "studied_credits", "mean_assessment_score", "num_of_prev_attempts", "median_days_to_submission")


def planted_gold(v: Views) -> DataFrame:
    """Gold with a label that can be learned in part: the log-odds add up over five features, the rest is chance."""
    rows = gold(v)
    values = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in PLANTED}
    numeric = train.materialise(rows.withColumns({f"in_{c}": x for c, x in values.items()}), "gold-planted")
    middle = exact_quantiles(numeric, [f"in_{c}" for c in PLANTED], [0.5])
    odds = sum((F.col(f"in_{c}") <= middle[f"in_{c}"][0]).cast("int") for c in PLANTED) * 1.6 - 4.0
    # A number in [0, 1) per student that follows from the keys alone.
    chance = F.pmod(F.xxhash64(F.lit("planted"), *KEYS), F.lit(1 << 30)) / float(1 << 30)
    label = (chance < 1 / (1 + F.exp(-odds))).cast("int")
    return numeric.withColumn(LABEL, label).drop(*[f"in_{c}" for c in PLANTED])


def _trained(v: Views, name: str) -> tuple:
    """(rows, model, manifest) of a preset, in full."""
    key = (v.spark.sparkContext.applicationId, v.sf_dir, name)
    if key not in _FITS:
        rows = train.materialise(planted_gold(v), "gold-for-training")
        model, manifest, _, _ = train.train_and_report(rows, name)
        _FITS[key] = rows, model, manifest
    return _FITS[key]


def _score_facts(scores: DataFrame, manifest: train.Manifest) -> DataFrame:
    """Per student: a probability, the label that follows from it, and whether the model found the planted signal."""
    follows = (F.col("risk_label") == "at_risk") == (F.col("risk_score") >= F.col("threshold"))
    return scores.select(
        *KEYS, F.col("risk_score").between(0, 1).alias("in_range"), follows.alias("label_follows"),
        F.lit(manifest.metrics["roc_auc"] > 0.7).alias("signal_found"))


_SCORE_FACTS = f"SELECT {K}, true AS in_range, true AS label_follows, true AS signal_found FROM v_student_info"


@query("train_gbt_score", _SCORE_FACTS)
def train_gbt_score(v: Views) -> DataFrame:
    rows, model, manifest = _trained(v, "boosted_a")
    return _score_facts(score.score(rows, model, manifest, KEYS), manifest)


@query("train_alt_score", _SCORE_FACTS)
def train_alt_score(v: Views) -> DataFrame:
    rows, model, manifest = _trained(v, "boosted_b")
    return _score_facts(score.score(rows, model, manifest, KEYS), manifest)


_TRACKS = "id_student * 10 + coalesce(id_site, 0) % 10"


@query("train_seq_score", f"""
    SELECT DISTINCT {_TRACKS} AS id_student, code_module, code_presentation, true AS in_range, true AS signal_found
    FROM v_student_vle""")
def train_seq_score(v: Views) -> DataFrame:
    """Daily clicks of a student on a group of sites; the label is whether the last active day has more than the first.

    So their order carries it, not their sum; one label in twenty is turned.
    """
    # The clicks span a month: a day takes the place of a week.
    clicks = v.student_vle.withColumn("id_student", F.expr(_TRACKS)).withColumn("date", 7 * F.col("date"))
    days = train.sequence_frame(clicks, clicks.select(*KEYS).distinct())
    steps = days.select(*KEYS, "features", F.filter(vector_to_array("features"), lambda x: x > 0).alias("x"))
    rises = F.coalesce(F.try_element_at("x", F.lit(-1)) > F.try_element_at("x", F.lit(1)), F.lit(False))
    turned = F.pmod(F.xxhash64(F.lit("order"), *KEYS), F.lit(20)) == 0
    label = rises != turned
    frame = train.materialise(steps.withColumn(LABEL, label.cast("int")).drop("x"), "sequences")
    model, manifest, _, _ = train.train_and_report(frame, "sequence", {"batch": 16, "step": 0.01})
    scored = train.predict_proba(model, frame)
    return scored.select(
        *KEYS, F.col(train.SCORE).between(0, 1).alias("in_range"),
        F.lit(manifest.metrics["roc_auc"] > 0.7).alias("signal_found"))


@query("kfold_eval", """
    SELECT CAST(i AS INT) AS fold, true AS in_range, true AS signal_found FROM generate_series(1, 5) AS t(i)""")
def kfold_eval(v: Views) -> DataFrame:
    rows = train.materialise(planted_gold(v), "gold-for-folds")
    found = train.kfold_eval(rows)
    inside = reduce(Column.__and__, [F.col(m).between(0, 1) for m in METRICS])
    return found.select(
        F.col("fold").cast("int").alias("fold"), inside.alias("in_range"), (F.col("roc_auc") > 0.7).alias("signal_found"))


@query("model_manifest", """
    SELECT 'boosted_a' AS model_name, true AS same_as_saved, true AS rounds_kept, true AS stopped_early, true AS signal_found""")
def model_manifest(v: Views) -> DataFrame:
    """What is loaded through the promoted pointer, against what was saved."""
    _, model, manifest = _trained(v, "boosted_a")
    root = shared_path(v.spark, "artifacts")
    run = train.save_model(v.spark, model, manifest, f"{root}/run_{manifest.run_id}")
    train.promote(v.spark, run, root)
    loaded = train.load_manifest(v.spark, train.latest(v.spark, root))
    kept = 1 < loaded.rounds == model.stages[-1].getNumTrees
    return train.manifest_frame(v.spark, loaded).select(
        "model_name", F.lit(loaded == manifest).alias("same_as_saved"), F.lit(kept).alias("rounds_kept"),
        F.lit(loaded.rounds < loaded.hyperparameters["rounds"]).alias("stopped_early"),
        F.lit(loaded.metrics["roc_auc"] > 0.7).alias("signal_found"))


@query("stream_score", f"SELECT {K}, true AS same_as_batch FROM v_student_info")
def stream_score(v: Views) -> DataFrame:
    """Scores of a drained stream of JSON records against those of the same records as a batch."""
    rows, model, manifest = _trained(v, "boosted_a")
    inbox, target = shared_path(v.spark, "records"), shared_path(v.spark, "scores")
    records = score.complete_record(rows)
    records.select(F.to_json(F.struct("*")).alias("value")).write.text(inbox)
    stream = scoring.score_stream(bronze.file_source(v.spark, inbox), model, manifest)
    bronze.land(stream, target, shared_path(v.spark, "score-checkpoint"), available_now=True).awaitTermination()
    batch = score.score(records, model, manifest, KEYS).select(*KEYS, F.col("risk_score").alias("batch_score"))
    both = v.spark.read.parquet(target).where("quarantined IS NULL").join(batch, KEYS, "full")
    same = F.coalesce(F.abs(F.col("risk_score") - F.col("batch_score")) < 1e-9, F.lit(False))
    return both.select(*KEYS, same.alias("same_as_batch"))


@query("stream_score_quarantine", f"""
    SELECT id_student % 3 = 0 AS quarantined, count(*) AS n FROM v_student_info GROUP BY 1""")
def stream_score_quarantine(v: Views) -> DataFrame:
    """Messages that lack a required field come out unscored instead of vanishing: here every third student."""
    rows, model, manifest = _trained(v, "boosted_a")
    inbox, target = shared_path(v.spark, "records"), shared_path(v.spark, "scores")
    records = score.complete_record(rows).withColumn(
        "region", F.when(F.col("id_student") % 3 != 0, F.coalesce("region", F.lit("unknown"))))
    filled = records.withColumns({c: F.coalesce(c, F.lit("unknown")) for c in score.REQUIRED[1:] if c != "region"})
    filled.select(F.to_json(F.struct("*")).alias("value")).write.text(inbox)
    stream = scoring.score_stream(bronze.file_source(v.spark, inbox), model, manifest)
    bronze.land(stream, target, shared_path(v.spark, "score-checkpoint"), available_now=True).awaitTermination()
    out = v.spark.read.parquet(target)
    bad = F.col("quarantined").isNotNull() & F.col("risk_score").isNull()
    return out.groupBy(bad.alias("quarantined")).agg(F.count("*").alias("n"))


def _explained(v: Views) -> DataFrame:
    rows, model, manifest = _trained(v, "boosted_a")
    run = train.save_model(v.spark, model, manifest, shared_path(v.spark, "explained"))
    return explain.explain_tree(rows, f"{run}/model", manifest.feature_columns, KEYS)


@query("explain_tree", f"""
    SELECT {K}, CAST(10 AS BIGINT) AS n_features, true AS ordered FROM v_student_info""")
def explain_tree(v: Views) -> DataFrame:
    """The ten largest contributions of every student: ten distinct features, falling in size with the rank."""
    top = train.materialise(explain.top_contributions(_explained(v), 10), "attribution")
    sizes = F.transform(F.array_sort(F.collect_list(F.struct("rank", F.abs("contribution").alias("size")))), lambda x: x["size"])
    return top.groupBy(*KEYS).agg(
        F.count_distinct("feature").alias("n_features"),
        (sizes == F.reverse(F.array_sort(sizes))).alias("ordered"))


@query("explain_tree_adds_up", f"SELECT {K}, true AS adds_up FROM v_student_info")
def explain_tree_adds_up(v: Views) -> DataFrame:
    """For every student, base value and contributions sum to the log-odds of the score."""
    gaps = train.materialise(explain.attribution_gap(_explained(v), KEYS), "attribution")
    return gaps.select(*KEYS, (F.abs("gap") < 1e-6).alias("adds_up"))


@query("score_labelled", """
    SELECT doc_id, round(s, 6) AS risk_score, CASE WHEN s >= 0.25 THEN 'at_risk' ELSE 'on_track' END AS risk_label,
      CAST(0.25 AS DOUBLE) AS threshold, 'v1' AS model_version FROM v_scored""")
def score_labelled(v: Views) -> DataFrame:
    return score.label_scores(v.scored, "s", 0.25, "v1", ["doc_id"])


@query("fused_score", """
    WITH a AS (SELECT doc_id, s FROM v_scored WHERE toxic = 0), b AS (SELECT doc_id, 1 - s AS s FROM v_scored WHERE y = 1)
    SELECT doc_id, round(CASE WHEN a.s IS NULL THEN b.s WHEN b.s IS NULL THEN a.s
      ELSE (0.7 * a.s + 0.3 * b.s) / (0.7 + 0.3) END, 6) AS risk_score
    FROM a FULL JOIN b USING (doc_id)""")
def fused_score(v: Views) -> DataFrame:
    first = v.scored.filter("toxic = 0").selectExpr("doc_id", "s AS risk_score")
    second = v.scored.filter("y = 1").selectExpr("doc_id", "1 - s AS risk_score")
    return score.fused_score(first, second, ["doc_id"], (0.7, 0.3))


_ALIGNED = ["total_clicks", "days_to_unregistration", "not_a_column", "clicks_week_2", "mean_assessment_score"]


@query("align_features", gold_sql(f"""
    SELECT {K}, CAST(coalesce(total_clicks, 0) AS DOUBLE) AS total_clicks,
      CAST(coalesce(days_to_unregistration, 0) AS DOUBLE) AS days_to_unregistration, CAST(0 AS DOUBLE) AS not_a_column,
      CAST(coalesce(clicks_week_2, 0) AS DOUBLE) AS clicks_week_2,
      coalesce(mean_assessment_score, 0) AS mean_assessment_score FROM gold"""))
def align_features(v: Views) -> DataFrame:
    return score.align_features(gold(v), _ALIGNED, KEYS)


WEIGHTS = {"l_quantity": 0.02, "l_extendedprice": -0.00001, "l_discount": 1.5, "l_tax": -2.0}


def _linear_lines(v: Views) -> DataFrame:
    lines = v.spark.read.parquet(f"{v.sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_shipdate", *WEIGHTS)
    return explain.explain_linear(lines, WEIGHTS, ["l_orderkey", "l_partkey", "l_shipdate"])


def _linear_sql(select: str) -> str:
    means = ", ".join(f"avg({c}) AS m_{c}" for c in WEIGHTS)
    base = " + ".join(f"CAST({w} AS DOUBLE) * m_{c}" for c, w in WEIGHTS.items())
    parts = " UNION ALL ".join(
        f"SELECT id, l_orderkey, l_partkey, l_shipdate, {base} AS base_value, '{c}' AS feature, "
        f"CAST({w} AS DOUBLE) * ({c} - m_{c}) AS contribution FROM numbered CROSS JOIN means" for c, w in WEIGHTS.items())
    return f"""
    WITH means AS (SELECT {means} FROM lineitem),
    numbered AS (SELECT *, row_number() OVER () AS id FROM lineitem), parts AS ({parts}) {select}"""


@query("explain_linear", _linear_sql("""
    SELECT l_orderkey, l_partkey, l_shipdate, round(base_value, 6) AS base_value, feature,
      round(contribution, 6) AS contribution FROM parts"""))
def explain_linear(v: Views) -> DataFrame:
    return explain.long_contributions(_linear_lines(v))


@query("top_contributions", _linear_sql("""
    , ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY abs(contribution) DESC, feature) AS rank FROM parts)
    SELECT l_orderkey, l_partkey, l_shipdate, round(base_value, 6) AS base_value, CAST(rank AS INT) AS rank, feature,
      round(contribution, 6) AS contribution FROM ranked WHERE rank <= 2"""))
def top_contributions(v: Views) -> DataFrame:
    return explain.top_contributions(_linear_lines(v), 2)


@query("global_importance", _linear_sql("""
    SELECT feature, round(avg(abs(contribution)), 6) AS importance FROM parts GROUP BY feature"""))
def global_importance(v: Views) -> DataFrame:
    return explain.global_importance(_linear_lines(v))
