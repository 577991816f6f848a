"""Batch and streaming scoring of student records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake.operators.train import SCORE, Manifest, predict_proba, with_inputs

# Fields of a scoring record with their types, and the defaults of optional ones.
RECORD_SCHEMA = (
    "id_student long, code_module string, code_presentation string, gender string, region string, "
    "highest_education string, imd_band string, age_band string, num_of_prev_attempts int, studied_credits int, "
    "disability string, total_clicks double, active_days double, mean_clicks_per_day double, "
    "max_clicks_in_day double, n_assessments_submitted double, n_assessments_missed double, "
    "mean_assessment_score double, std_assessment_score double, median_days_to_submission double, "
    "late_submission_ratio double, clicks_week_1 double, clicks_week_2 double, clicks_week_3 double, "
    "clicks_week_4 double, click_growth_rate double, days_since_last_activity double, "
    "session_duration_variance double"
)
RECORD_DEFAULTS: dict[str, object] = {"num_of_prev_attempts": 0, "studied_credits": 0, "disability": "N"}
REQUIRED = ("id_student", "code_module", "code_presentation", "gender", "region", "highest_education", "age_band")


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the wanted numeric features, in order, as doubles; absent columns and nulls become 0."""
    def value(c: str):
        return F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in df.columns else F.lit(0.0)

    return df.select(*keep, *[value(c).alias(c) for c in features])


def complete_record(
    df: DataFrame, defaults: Mapping[str, object] = RECORD_DEFAULTS, keep: Mapping[str, Column] | None = None
) -> DataFrame:
    """All fields of a scoring record, with its defaults where a column is absent or null, and the columns in ``keep``."""
    columns = []
    for declaration in RECORD_SCHEMA.split(", "):
        name, kind = declaration.split(" ")
        default = defaults.get(name, 0.0 if kind == "double" else None)
        missing = F.lit(default).cast(kind)
        columns.append((F.coalesce(F.col(name).cast(kind), missing) if name in df.columns else missing).alias(name))
    return df.select(*columns, *[c.alias(n) for n, c in (keep or {}).items()])


def label_scores(
    df: DataFrame, score: str = SCORE, threshold: float = 0.5, version: str = "unknown", keep: Sequence[str] = ("id_student",)
) -> DataFrame:
    """(id, risk_score, risk_label, threshold, model_version)."""
    label = F.when(F.col(score) >= threshold, "at_risk").otherwise("on_track")
    return df.select(
        *keep, F.col(score).alias(SCORE), label.alias("risk_label"),
        F.lit(float(threshold)).alias("threshold"), F.lit(version).alias("model_version"),
    )


def score(df: DataFrame, model: PipelineModel, manifest: Manifest, keep: Sequence[str] = ("id_student",)) -> DataFrame:
    """Score any number of rows, batch or stream: a narrow transformation without a shuffle."""
    scored = predict_proba(model, with_inputs(df, manifest.input_columns))
    return label_scores(scored, SCORE, manifest.threshold, manifest.run_id, keep)


def fused_score(
    left: DataFrame, right: DataFrame, keys: Sequence[str], weights: tuple[float, float] = (0.5, 0.5), column: str = SCORE
) -> DataFrame:
    """Late fusion: weighted mean of two models' scores per key; a row only one model scored keeps that score."""
    keys = list(keys)
    both = left.select(*keys, F.col(column).alias("_a")).join(
        right.select(*keys, F.col(column).alias("_b")), keys, "full")
    a, b = (F.when(F.col(c).isNotNull(), F.lit(w)).otherwise(0.0) for c, w in zip(("_a", "_b"), weights))
    total = a * F.coalesce("_a", F.lit(0.0)) + b * F.coalesce("_b", F.lit(0.0))
    return both.select(*keys, F.try_divide(total, a + b).alias(column))
