from statistics import stdev

import pytest
from pyspark.sql import functions as F

from conftest import ASSESSMENTS, SUBMISSIONS
from learnlake import KEYS
from learnlake.operators import features as ft
from learnlake.operators.clean import encode_label
from learnlake.operators.registry import FEATURE_GROUPS, select_groups


def by_student(df):
    return {r.id_student: r for r in df.collect()}


@pytest.fixture(scope="module")
def gold(student_info, registration, no_assessments, no_submissions, vle, student_vle):
    return ft.build_gold(
        encode_label(student_info), registration, no_assessments, no_submissions, vle, student_vle).cache()


def test_gold_values(gold):
    rows = by_student(gold)
    one, two, three = rows[1], rows[2], rows[3]
    assert (one.total_clicks, one.active_days, one.max_clicks_in_day, one.n_resource_types) == (10, 3, 5, 1)
    assert one.mean_clicks_per_day == pytest.approx(10 / 3)
    assert [one[f"clicks_week_{w}"] for w in range(1, 5)] == [8, 2, 0, 0]
    assert one.click_growth_rate == pytest.approx(-0.875)
    assert one.days_since_last_activity == 19
    assert one.session_duration_variance == pytest.approx(1.527525, abs=1e-6)
    assert [two[f"clicks_week_{w}"] for w in range(1, 5)] == [8, 4, 0, 0]
    assert (two.total_clicks, two.click_growth_rate, two.days_since_last_activity) == (12, pytest.approx(-0.75), 16)
    assert two.session_duration_variance == pytest.approx(3.0)
    assert (three.total_clicks, three.n_resource_types, three.clicks_week_1) == (0, 0, 0)
    assert three.active_days is None and three.click_growth_rate is None and three.days_since_last_activity is None
    assert {r.days_to_registration for r in rows.values()} == {-30}
    assert [rows[i].final_result_binary for i in (1, 2, 3)] == [0, 1, 0]


def test_gold_keeps_every_base_row_and_all_features(gold, student_info):
    assert gold.count() == student_info.count()
    assert set(sum(FEATURE_GROUPS.values(), [])) <= set(gold.columns)


def test_registration_without_dates(student_info, registration, no_assessments, no_submissions, vle, student_vle):
    gold = ft.build_gold(
        student_info, registration.select(*KEYS), no_assessments, no_submissions, vle, student_vle)
    assert "days_to_registration" not in gold.columns
    assert [f"clicks_week_{w}" for w in range(1, 5)] == [c for c in gold.columns if c.startswith("clicks_week")]
    assert gold.count() == 3


def test_first_registration_wins_whole_row(spark):
    rows = spark.createDataFrame(
        [(1, "A", "P", 5, None, 1), (1, "A", "P", 9, 40, 0), (1, "A", "P", 1, 7, 2)],
        "id_student long, code_module string, code_presentation string, date_registration long, "
        "date_unregistration long, ord long")
    first = ft.registration_features(rows, ["ord"]).first()
    assert (first.days_to_registration, first.days_to_unregistration) == (9, 40)


def test_horizon_one_has_no_growth(student_vle):
    assert {r.click_growth_rate for r in ft.temporal_features(student_vle, 1).collect()} == {None}


def test_pre_start_days_count_only_in_totals(spark, vle):
    clicks = spark.createDataFrame(
        [("A", "P", 1, 100, -3, 4)], "code_module string, code_presentation string, id_student long, id_site long, "
                                     "date long, sum_click long")
    assert ft.temporal_features(clicks).count() == 0
    row = ft.activity_features(clicks, vle).first()
    assert (row.total_clicks, row.clicks_week_1, row.days_since_last_activity) == (4, 0, None)


def test_duplicate_site_does_not_multiply_clicks(student_vle, vle):
    doubled = vle.union(vle.withColumn("activity_type", F.lit("quiz")))
    assert by_student(ft.vle_features(student_vle, doubled))[1].total_clicks == 10


def test_vle_without_activity_type_counts_sites(student_vle, vle):
    rows = by_student(ft.vle_features(student_vle, vle.select("id_site")))
    assert (rows[1].n_resource_types, rows[2].n_resource_types) == (3, 2)


def test_as_of_day_limits_facts(student_vle, vle):
    assert by_student(ft.vle_features(student_vle, vle, as_of_day=4))[1].total_clicks == 8


@pytest.fixture(scope="module")
def assessed(spark):
    assessments = spark.createDataFrame(
        [("A", "P", 1, "TMA", 10, 20.0), ("A", "P", 2, "TMA", 20, 80.0), ("A", "P", 3, "Exam", None, 0.0)], ASSESSMENTS)
    submissions = spark.createDataFrame(
        [(1, 7, 11, 0, 50.0), (2, 7, 24, 0, 70.0), (3, 8, 30, 0, None), (99, 8, 3, 0, 10.0), (1, None, 3, 0, 10.0)],
        SUBMISSIONS)
    return assessments, submissions


def test_assessment_values(assessed):
    rows = by_student(ft.assessment_features(*assessed))
    assert set(rows) == {7, 8}
    seven, eight = rows[7], rows[8]
    assert (seven.n_assessments_submitted, seven.n_assessments_missed) == (2, 1)
    assert seven.mean_assessment_score == 60 and seven.std_assessment_score == pytest.approx(200 ** 0.5)
    assert seven.median_days_to_submission == 2.5 and seven.late_submission_ratio == 1.0
    # No due day: not late by default, left out on request. The orphan submission has no course.
    assert (eight.n_assessments_submitted, eight.late_submission_ratio) == (1, 0.0)
    assert eight.std_assessment_score is None
    ignored = by_student(ft.assessment_features(*assessed, null_due="ignore"))
    assert ignored[8].late_submission_ratio is None


def test_missed_for_inactive_students(spark, assessed):
    students = spark.createDataFrame([(7, "A", "P"), (9, "A", "P")], "id_student long, code_module string, code_presentation string")
    rows = by_student(ft.assessment_features(*assessed, missed_for_inactive=True, students=students))
    assert (rows[7].n_assessments_missed, rows[9].n_assessments_missed) == (1, 3)


def test_cumulative_score_weights(assessed):
    rows = {r.date_submitted: r.cumulative_score for r in ft.cumulative_score(*assessed).filter("id_student = 7").collect()}
    assert rows == {11: 50.0, 24: pytest.approx((20 * 50 + 80 * 70) / 100)}


def test_weekly_sequence_and_rolling(student_vle):
    assert by_student(ft.weekly_sequence(student_vle, 3))[1].clicks == [8.0, 2.0, 0.0]
    last = {r.week: r.clicks_last_2_weeks for r in ft.rolling_clicks(student_vle).filter("id_student = 2").collect()}
    assert last == {1: 8, 2: 12}


def test_select_groups(gold):
    assert select_groups(gold, ["vle_activity"]).columns == [*KEYS, *FEATURE_GROUPS["vle_activity"], "final_result_binary"]
    with pytest.raises(ValueError):
        select_groups(gold, ["nope"])


def test_hot_student_equals_uniform_computation(spark, vle):
    """A third of all rows on one student: same totals as plain Python."""
    rows = [("A", "P", 0 if i % 3 == 0 else i, 100 + i % 4, i % 30 - 2, i % 7) for i in range(6000)]
    clicks = spark.createDataFrame(rows, "code_module string, code_presentation string, id_student long, id_site long, date long, sum_click long")
    got = by_student(ft.activity_features(clicks, vle))
    mine = [r for r in rows if r[2] == 0]
    assert got[0].total_clicks == sum(r[5] for r in mine)
    assert got[0].active_days == len({r[4] for r in mine})
    assert len(got) == len({r[2] for r in rows})


@pytest.mark.parametrize("types", [1, 64, 65, 150])
def test_day_level_equals_row_level(spark, types):
    """Bits over one or several words against plain distinct counts; null days, clicks and types included."""
    clicks = spark.range(5000).selectExpr(
        "'A' AS code_module", "'P' AS code_presentation", "id % 40 AS id_student", "id * 31 % 200 AS id_site",
        "CASE WHEN id % 17 > 0 THEN CAST(id % 35 - 3 AS INT) END AS date",
        "CASE WHEN id % 13 > 0 THEN CAST(id * id % 1000 AS INT) END AS sum_click")
    sites = spark.range(190).selectExpr("id AS id_site", f"CASE WHEN id % 19 > 0 THEN concat('t', id % {types}) END AS activity_type")
    days = by_student(ft._from_days(clicks, sites, 4))
    rows = by_student(ft._from_rows(clicks, sites, 4, False))
    assert set(days) == set(rows)
    for student, row in rows.items():
        assert days[student].asDict() == pytest.approx(row.asDict(), nan_ok=True)


def test_fractional_clicks(spark, vle):
    clicks = spark.createDataFrame(
        [("A", "P", 1, 100, d, c) for d, c in ((0, 0.5), (1, 1.25), (1, 4.0))],
        "code_module string, code_presentation string, id_student long, id_site long, date long, sum_click double")
    row = ft.activity_features(clicks, vle).first()
    assert row.total_clicks == 5.75 and row.session_duration_variance == pytest.approx(stdev([0.5, 1.25, 4.0]))


def test_a_type_per_site(spark, student_vle, vle):
    own = vle.withColumn("activity_type", F.col("id_site").cast("string"))
    rows = by_student(ft.activity_features(student_vle, own))
    assert (rows[1].n_resource_types, rows[2].n_resource_types) == (3, 2)



def test_gold_plan_is_jvm_only_without_cross_joins_or_windows(gold):
    plan = gold._jdf.queryExecution().optimizedPlan().toString()
    assert not any(word in plan for word in ("PythonUDF", "Window", "Cross"))


def test_as_of_day_hides_later_registration_days(spark):
    from learnlake.operators.features import registration_features

    rows = [("AAA", "2014J", 1, -5, 120), ("AAA", "2014J", 2, 20, 3)]
    frame = spark.createDataFrame(
        rows, "code_module string, code_presentation string, id_student long, date_registration long, "
              "date_unregistration long")
    got = {r.id_student: (r.days_to_registration, r.days_to_unregistration)
           for r in registration_features(frame, as_of_day=14).collect()}
    assert got == {1: (-5, None), 2: (None, 3)}


def test_any_number_of_activity_types(spark):
    """600 types, once the limit of another plan: distinct ones are counted per student."""
    sites = spark.range(1200).selectExpr("id AS id_site", "CASE WHEN id % 10 <> 0 THEN concat('t', id % 600) END AS activity_type")
    clicks = spark.range(20_000).selectExpr(
        "id % 7 AS id_student", "'A' AS code_module", "'P' AS code_presentation", "(id * 31) % 1300 AS id_site",
        "id % 40 AS date", "1L AS sum_click")
    got = {r.id_student: r.n_resource_types for r in ft.vle_features(clicks, sites).collect()}
    plain = clicks.join(sites, "id_site", "left").groupBy("id_student").agg(F.count_distinct("activity_type").alias("n"))
    assert got == {r.id_student: r.n for r in plain.collect()} and max(got.values()) > 500
    untyped = ft.vle_features(clicks, sites.select("id_site")).collect()
    assert {r.id_student for r in untyped} == set(got)


def test_no_object_aggregate_over_submissions(spark, no_assessments, no_submissions):
    """The only object aggregate, the median's, reads counts of equal days."""
    plan = ft.assessment_features(no_assessments, no_submissions)._jdf.queryExecution().executedPlan().toString()
    objects = [line for line in plan.splitlines() if "ObjectHashAggregate" in line]
    assert objects and all("percentile(late_days" in line and ", n#" in line for line in objects)
