"""Names of the Gold features, by group."""

from __future__ import annotations

from pyspark.sql import DataFrame

from learnlake import KEYS
from learnlake.functions.columns import present

# The published feature names of each group.
FEATURE_GROUPS = {
    "demographic": ["gender", "region", "highest_education", "imd_band", "age_band", "disability"],
    "registration": ["num_of_prev_attempts", "studied_credits", "days_to_registration", "days_to_unregistration"],
    "assessment_history": [
        "n_assessments_submitted", "n_assessments_missed", "mean_assessment_score", "std_assessment_score",
        "median_days_to_submission", "late_submission_ratio",
    ],
    "vle_activity": ["total_clicks", "active_days", "mean_clicks_per_day", "max_clicks_in_day", "n_resource_types"],
    "temporal_dynamics": [
        "clicks_week_1", "clicks_week_2", "clicks_week_3", "clicks_week_4", "click_growth_rate",
        "days_since_last_activity", "session_duration_variance",
    ],
}

CATEGORICAL = [*FEATURE_GROUPS["demographic"], "code_module", "code_presentation"]
LABEL = "final_result_binary"
# Missing counts mean "none happened"; columns with these prefixes are zero-filled in Gold.
ZERO_FILLED_PREFIXES = ("n_", "clicks_", "total_")


def select_groups(gold: DataFrame, groups: list[str], label: bool = True) -> DataFrame:
    """Keys, the features of the named groups that exist, and the label."""
    unknown = [g for g in groups if g not in FEATURE_GROUPS]
    if unknown:
        raise ValueError(f"unknown feature groups {unknown}; known: {list(FEATURE_GROUPS)}")
    wanted = [f for g in groups for f in FEATURE_GROUPS[g]]
    return gold.select(*present(gold, [*KEYS, *wanted, *([LABEL] if label else [])]))
