"""Feature queries: clicks, assessments, registration and Gold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlake import KEYS
from learnlake.operators import features as ft
from learnlake.operators.clean import encode_label
from learnlake.operators.registry import CATEGORICAL, select_groups
from learnlake.plans.register import Views, query

K = ", ".join(KEYS)

VLE_SQL = f"""
    SELECT {K}, CAST(coalesce(sum(sum_click), 0) AS BIGINT) AS total_clicks,
      count(DISTINCT date) AS active_days, round(avg(sum_click), 6) AS mean_clicks_per_day,
      max(sum_click) AS max_clicks_in_day, count(DISTINCT activity_type) AS n_resource_types
    FROM v_student_vle LEFT JOIN v_vle USING (id_site) GROUP BY {K}"""


def _week_sums(weeks: int) -> str:
    return ", ".join(
        f"CAST(coalesce(sum(CASE WHEN floor(date / 7.0) + 1 = {w} THEN sum_click END), 0) AS BIGINT) AS clicks_week_{w}"
        for w in range(1, weeks + 1)
    )


TEMPORAL_SQL = f"""
    WITH weeks AS (
      SELECT {K}, {_week_sums(4)}, max(date) AS last_day, stddev_samp(sum_click) AS spread
      FROM v_student_vle WHERE date >= 0 GROUP BY {K}),
    growth AS (
      SELECT *,
        (clicks_week_2 - clicks_week_1) / nullif(CAST(clicks_week_1 AS DOUBLE), 0) AS g2,
        (clicks_week_3 - clicks_week_2) / nullif(CAST(clicks_week_2 AS DOUBLE), 0) AS g3,
        (clicks_week_4 - clicks_week_3) / nullif(CAST(clicks_week_3 AS DOUBLE), 0) AS g4
      FROM weeks)
    SELECT {K}, clicks_week_1, clicks_week_2, clicks_week_3, clicks_week_4,
      round((coalesce(g2, 0) + coalesce(g3, 0) + coalesce(g4, 0)) / nullif(
        CASE WHEN g2 IS NULL THEN 0 ELSE 1 END + CASE WHEN g3 IS NULL THEN 0 ELSE 1 END
        + CASE WHEN g4 IS NULL THEN 0 ELSE 1 END, 0), 6) AS click_growth_rate,
      greatest(28 - last_day, 0) AS days_since_last_activity, round(spread, 6) AS session_duration_variance
    FROM growth"""

ASSESSMENT_SQL = f"""
    WITH joined AS (
      SELECT sa.id_student, a.code_module, a.code_presentation, sa.id_assessment, sa.score,
        sa.date_submitted - a.date AS late_days
      FROM v_student_assessment sa LEFT JOIN v_assessments a ON sa.id_assessment = a.id_assessment),
    agg AS (
      SELECT {K}, count(id_assessment) AS n_assessments_submitted, avg(score) AS m, stddev_samp(score) AS sd,
        median(late_days) AS med, avg(CASE WHEN late_days > 0 THEN 1 ELSE 0 END) AS late
      FROM joined
      WHERE id_student IS NOT NULL AND code_module IS NOT NULL AND code_presentation IS NOT NULL GROUP BY {K}),
    expected AS (
      SELECT code_module, code_presentation, count(id_assessment) AS expected
      FROM v_assessments GROUP BY code_module, code_presentation)
    SELECT {K}, n_assessments_submitted, round(m, 6) AS mean_assessment_score, round(sd, 6) AS std_assessment_score,
      round(med, 6) AS median_days_to_submission, round(late, 6) AS late_submission_ratio,
      greatest(expected - n_assessments_submitted, 0) AS n_assessments_missed
    FROM agg LEFT JOIN expected USING (code_module, code_presentation)"""

REGISTRATION_SQL = f"""
    SELECT {K}, date_registration AS days_to_registration, date_unregistration AS days_to_unregistration
    FROM (SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY ord) AS rn FROM v_registration) WHERE rn = 1"""

GOLD_FEATURES = [
    "days_to_registration", "days_to_unregistration", "n_assessments_submitted", "mean_assessment_score",
    "std_assessment_score", "median_days_to_submission", "late_submission_ratio", "n_assessments_missed",
    "total_clicks", "active_days", "mean_clicks_per_day", "max_clicks_in_day", "n_resource_types",
    "clicks_week_1", "clicks_week_2", "clicks_week_3", "clicks_week_4", "click_growth_rate",
    "days_since_last_activity", "session_duration_variance",
]
_FILLED = ", ".join(
    f"coalesce({c}, 0) AS {c}" if c.startswith(("n_", "total_", "clicks_")) else c for c in GOLD_FEATURES
)
_BASE = "gender, region, highest_education, imd_band, age_band, disability, num_of_prev_attempts, studied_credits"
_LABEL = "CASE WHEN final_result IN ('Fail', 'Withdrawn') THEN 1 ELSE 0 END AS final_result_binary"


def gold_sql(select: str) -> str:
    """``select`` over ``gold``, the feature matrix spelled out in SQL."""
    return f"""
    WITH reg AS ({REGISTRATION_SQL}),
    asmt AS ({ASSESSMENT_SQL}),
    click AS ({VLE_SQL}),
    temporal AS ({TEMPORAL_SQL}),
    gold AS (
      SELECT {K}, {_BASE}, {_LABEL}, {_FILLED}
      FROM v_student_info LEFT JOIN reg USING ({K}) LEFT JOIN asmt USING ({K})
        LEFT JOIN click USING ({K}) LEFT JOIN temporal USING ({K}))
    {select}"""


def gold(v: Views) -> DataFrame:
    return ft.build_gold(
        encode_label(v.student_info), v.registration, v.assessments, v.student_assessment, v.vle, v.student_vle,
        registration_order=["ord"],
    )


query("gold_features", gold_sql("SELECT * FROM gold"))(gold)


@query("vle_features", VLE_SQL)
def vle_features(v: Views) -> DataFrame:
    return ft.vle_features(v.student_vle, v.vle)


@query("temporal_features", TEMPORAL_SQL)
def temporal_features(v: Views) -> DataFrame:
    return ft.temporal_features(v.student_vle)


@query("assessment_features", ASSESSMENT_SQL)
def assessment_features(v: Views) -> DataFrame:
    return ft.assessment_features(v.assessments, v.student_assessment)


@query("assessments_missed", f"""
    WITH a AS ({ASSESSMENT_SQL}) SELECT {K}, n_assessments_submitted, n_assessments_missed FROM a""")
def assessments_missed(v: Views) -> DataFrame:
    return ft.assessment_features(v.assessments, v.student_assessment).select(
        *KEYS, "n_assessments_submitted", "n_assessments_missed")


@query("registration_features", REGISTRATION_SQL)
def registration_features(v: Views) -> DataFrame:
    return ft.registration_features(v.registration, ["ord"])


@query("base_projection", f"SELECT {K}, {_BASE}, {_LABEL} FROM v_student_info")
def base_projection(v: Views) -> DataFrame:
    return ft.base_projection(encode_label(v.student_info))


@query("weekly_clicks", f"""
    SELECT {K}, CAST(floor(date / 7.0) AS INT) + 1 AS week, CAST(coalesce(sum(sum_click), 0) AS BIGINT) AS clicks
    FROM v_student_vle WHERE date >= 0 GROUP BY ALL""")
def weekly_clicks(v: Views) -> DataFrame:
    return ft.weekly_clicks(v.student_vle)


@query("rolling_clicks", f"""
    WITH weekly AS (
      SELECT {K}, CAST(floor(date / 7.0) AS INT) + 1 AS week, sum(sum_click) AS clicks
      FROM v_student_vle WHERE date >= 0 GROUP BY ALL)
    SELECT {K}, week,
      CAST(sum(clicks) OVER (PARTITION BY {K} ORDER BY week RANGE BETWEEN 0 PRECEDING AND CURRENT ROW) AS BIGINT) AS clicks_last_1_weeks,
      CAST(sum(clicks) OVER (PARTITION BY {K} ORDER BY week RANGE BETWEEN 1 PRECEDING AND CURRENT ROW) AS BIGINT) AS clicks_last_2_weeks,
      CAST(sum(clicks) OVER (PARTITION BY {K} ORDER BY week RANGE BETWEEN 3 PRECEDING AND CURRENT ROW) AS BIGINT) AS clicks_last_4_weeks
    FROM weekly""")
def rolling_clicks(v: Views) -> DataFrame:
    return ft.rolling_clicks(v.student_vle)


@query("activity_frequency", f"""
    SELECT {K}, count(DISTINCT date) / CAST(4 AS DOUBLE) AS active_days_per_week
    FROM v_student_vle WHERE date BETWEEN 0 AND 27 GROUP BY {K}""")
def activity_frequency(v: Views) -> DataFrame:
    return ft.activity_frequency(v.student_vle)


@query("weekly_sequence", f"""
    WITH students AS (SELECT DISTINCT {K} FROM v_student_vle WHERE date >= 0),
    weekly AS (
      SELECT {K}, CAST(floor(date / 7.0) AS INT) + 1 AS step, sum(sum_click) AS clicks
      FROM v_student_vle WHERE date >= 0 GROUP BY ALL)
    SELECT {K}, CAST(r.step AS INT) AS step, CAST(coalesce(clicks, 0) AS DOUBLE) AS clicks
    FROM students CROSS JOIN range(1, 31) r(step) LEFT JOIN weekly w USING ({K}, step)""")
def weekly_sequence(v: Views) -> DataFrame:
    return ft.weekly_sequence(v.student_vle).select(
        *KEYS, F.posexplode("clicks").alias("pos", "clicks")).select(
        *KEYS, (F.col("pos") + 1).alias("step"), "clicks")


@query("cumulative_score", f"""
    WITH daily AS (
      SELECT sa.id_student, a.code_module, a.code_presentation, sa.date_submitted,
        sum(coalesce(a.weight, 1) * sa.score) AS points, sum(coalesce(a.weight, 1)) AS weights
      FROM v_student_assessment sa JOIN v_assessments a ON sa.id_assessment = a.id_assessment
      WHERE sa.score IS NOT NULL GROUP BY ALL)
    SELECT {K}, date_submitted,
      round(sum(points) OVER w / nullif(sum(weights) OVER w, 0), 6) AS cumulative_score
    FROM daily WINDOW w AS (PARTITION BY {K} ORDER BY date_submitted)""")
def cumulative_score(v: Views) -> DataFrame:
    return ft.cumulative_score(v.assessments, v.student_assessment)


@query("feature_group_select", gold_sql(f"""
    SELECT {K}, n_assessments_submitted, n_assessments_missed, mean_assessment_score, std_assessment_score,
      median_days_to_submission, late_submission_ratio, clicks_week_1, clicks_week_2, clicks_week_3, clicks_week_4,
      click_growth_rate, days_since_last_activity, session_duration_variance, final_result_binary FROM gold"""))
def feature_group_select(v: Views) -> DataFrame:
    return select_groups(gold(v), ["assessment_history", "temporal_dynamics"])


@query("model_matrix", gold_sql(f"""
    SELECT {K}, {', '.join(c for c in CATEGORICAL if c not in KEYS)}, num_of_prev_attempts, studied_credits,
      final_result_binary, {', '.join(f'coalesce({c}, 0) AS {c}' for c in GOLD_FEATURES)} FROM gold"""))
def model_matrix(v: Views) -> DataFrame:
    return ft.model_matrix(gold(v))
