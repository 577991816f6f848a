"""Student-level features: one aggregate per fact table, joined on the student-course key.

Every fact table is read once and shuffled once, on the three key columns; the left joins that build
Gold then reuse that partitioning. All aggregates combine on the map side, so a student or course that
owns a large part of the rows arrives at its reducer as a few partial rows per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnlake import KEYS
from learnlake.functions.columns import dense_week, known, mean_of_present, non_negative, present
from learnlake.operators.registry import FEATURE_GROUPS, LABEL, ZERO_FILLED_PREFIXES
from learnlake.session import shared_path

COURSE = ["code_module", "code_presentation"]


def with_known_keys(df: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Rows whose keys are all present: a null key is no group. Plain null tests reach the parquet scan."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def _up_to(df: DataFrame, day: str, as_of_day: int | None) -> DataFrame:
    return df if as_of_day is None else df.filter(F.col(day) <= as_of_day)


# ------------------------------------------------------------------ base and registration


def base_projection(student_info: DataFrame) -> DataFrame:
    """Keys, demographics, attempts, credits and label, as far as the table has them."""
    wanted = [*KEYS, *FEATURE_GROUPS["demographic"], "num_of_prev_attempts", "studied_credits", LABEL]
    return student_info.select(*present(student_info, wanted))


def registration_features(
    registration: DataFrame, order_by: list[str] | None = None, as_of_day: int | None = None
) -> DataFrame:
    """Days to (un)registration of the first row per key, first by ``order_by``; a day after ``as_of_day`` is null.

    ``min`` over a struct keeps one candidate per key and map task, where a window would sort whole groups.
    """
    renamed = {"date_registration": "days_to_registration", "date_unregistration": "days_to_unregistration"}
    values = present(registration, renamed)
    known = with_known_keys(registration)
    if not values:
        return known.select(*KEYS).distinct()
    first = F.min(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_by or [])], *values))
    def seen(c: str) -> Column:
        day = F.col(f"first.{c}")
        return day if as_of_day is None else F.when(day <= as_of_day, day)

    return (
        known.groupBy(*KEYS).agg(first.alias("first"))
        .select(*KEYS, *[seen(c).alias(renamed[c]) for c in values])
    )


# ------------------------------------------------------------------ assessments


def submissions(student_assessment: DataFrame, assessments: DataFrame, *extra: str) -> DataFrame:
    """Each submission with the course and due day of its assessment, and its lateness.

    No join hint: Spark broadcasts ``assessments`` while it is small and splits skewed keys when it is not.
    """
    due = assessments.select("id_assessment", *COURSE, "date", *extra)
    return (
        student_assessment.join(due, "id_assessment", "left")
        .withColumn("late_days", F.col("date_submitted") - F.col("date"))
    )


def assessment_features(
    assessments: DataFrame,
    student_assessment: DataFrame,
    null_due: str = "not_late",
    as_of_day: int | None = None,
    missed_for_inactive: bool = False,
    students: DataFrame | None = None,
) -> DataFrame:
    """Submission counts, score statistics, lateness and missed assessments per student and course.

    A submission without due day counts as on time, or with ``null_due="ignore"`` not at all. Students
    without submissions have no row here, unless ``missed_for_inactive`` and their key frame are given.
    The exact median keeps one counter per distinct day offset of a student, a number bounded by the calendar.
    """
    if null_due not in ("not_late", "ignore"):
        raise ValueError("null_due must be 'not_late' or 'ignore'")
    expected = expected_assessments(assessments)
    # The expected count rides along with the dimension row, which saves a join after the aggregate.
    dimension = assessments.join(expected, COURSE, "left")
    late = (F.col("late_days") > 0).cast("int")
    facts = _up_to(submissions(student_assessment, dimension, "expected"), "date_submitted", as_of_day)
    facts = facts.withColumn("score", known(F.col("score"), dict(facts.dtypes)["score"]))
    submitted = (
        with_known_keys(facts).groupBy(*KEYS).agg(
            F.count("id_assessment").alias("n_assessments_submitted"),
            F.avg("score").alias("mean_assessment_score"),
            F.stddev_samp("score").alias("std_assessment_score"),
            F.avg(F.coalesce(late, F.lit(0)) if null_due == "not_late" else late).alias("late_submission_ratio"),
            F.max("expected").alias("expected"),
        )
        .withColumn("n_assessments_missed", non_negative(F.col("expected") - F.col("n_assessments_submitted")))
        .drop("expected").join(_median_lateness(facts), KEYS, "left")
    )
    if not missed_for_inactive:
        return submitted
    if students is None:
        raise ValueError("missed_for_inactive needs the frame of student keys")
    missed = F.coalesce("n_assessments_missed", "expected").alias("n_assessments_missed")
    rest = [c for c in submitted.columns if c not in (*KEYS, "n_assessments_missed")]
    return (
        students.select(*KEYS).distinct().join(submitted, KEYS, "left").join(expected, COURSE, "left")
        .select(*KEYS, *rest, missed)
    )


def _median_lateness(facts: DataFrame) -> DataFrame:
    """Median of the days late per student and course.

    Equal days are counted first, which combines per task in plain numbers; the median is then taken over few rows.
    """
    days = with_known_keys(facts).filter(F.col("late_days").isNotNull()).groupBy(*KEYS, "late_days").agg(F.count("*").alias("n"))
    return days.groupBy(*KEYS).agg(F.percentile("late_days", 0.5, F.col("n")).alias("median_days_to_submission"))


def expected_assessments(assessments: DataFrame) -> DataFrame:
    """Number of assessments set per course presentation."""
    return with_known_keys(assessments, COURSE).groupBy(*COURSE).agg(F.count("id_assessment").alias("expected"))


def cumulative_score(
    assessments: DataFrame, student_assessment: DataFrame, default_weight: float = 1.0
) -> DataFrame:
    """Weight-averaged score of a student up to and including each submission day.

    Submissions of one day enter together, so the running sum has one row per student and day, not per submission.
    """
    weight = F.coalesce("weight", F.lit(default_weight))
    daily = (
        with_known_keys(submissions(student_assessment, assessments, "weight"), [*KEYS, "date_submitted", "score"])
        .groupBy(*KEYS, "date_submitted")
        .agg(F.sum(weight * F.col("score")).alias("points"), F.sum(weight).alias("weights"))
    )
    so_far = Window.partitionBy(*KEYS).orderBy("date_submitted").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(
        *KEYS, "date_submitted",
        F.try_divide(F.sum("points").over(so_far), F.sum("weights").over(so_far)).alias("cumulative_score"),
    )


# ------------------------------------------------------------------ clicks


def _sites(vle: DataFrame) -> DataFrame:
    """One activity type per site, so that no click is counted twice."""
    return vle.groupBy("id_site").agg(F.min("activity_type").alias("activity_type"))


def with_activity_type(student_vle: DataFrame, vle: DataFrame) -> DataFrame:
    """Clicks with the activity type of their site, where the site table has types."""
    return student_vle.join(_sites(vle), "id_site", "left") if "activity_type" in vle.columns else student_vle


def _clicks_in_week(week: int, clicks: str = "sum_click") -> Column:
    """Clicks of one week as a conditional sum: no pivot, no second shuffle."""
    inside = F.col("date").between(7 * (week - 1), 7 * week - 1)
    return F.coalesce(F.sum(F.when(inside, F.col(clicks))), F.lit(0))


def _temporal_aggregates(horizon: int, clicks: str, spread: Column) -> list[Column]:
    return [
        *[_clicks_in_week(w, clicks).alias(f"clicks_week_{w}") for w in range(1, horizon + 1)],
        F.max(F.when(F.col("date") >= 0, F.col("date"))).alias("last_day"),
        spread.alias("session_duration_variance"),
    ]


def _temporal_columns(horizon: int) -> list[Column]:
    weeks = [F.col(f"clicks_week_{w}") for w in range(1, horizon + 1)]
    growth = mean_of_present(F.try_divide(now - before, before) for before, now in zip(weeks, weeks[1:]))
    return [
        *weeks,
        growth.alias("click_growth_rate"),
        non_negative(F.lit(7 * horizon) - F.col("last_day")).alias("days_since_last_activity"),
        F.col("session_duration_variance"),
    ]


def _numbered_sites(clicks: DataFrame, vle: DataFrame) -> DataFrame:
    """(id_site, word, bits): each activity type has a bit of its own in some 64-bit word.

    Types are numbered in a written table, so that every use sees the same numbers; the numbers need not be dense. A
    site without a type has none; where the site table has no types at all, every site met is one.
    """
    typed = "activity_type" in vle.columns
    sites = _sites(vle) if typed else clicks.select("id_site").distinct()
    column = "activity_type" if typed else "id_site"
    path = shared_path(vle.sparkSession, "activity-types")
    types = sites.select(F.col(column).alias("type")).filter(F.col("type").isNotNull()).distinct()
    types.withColumn("number", F.monotonically_increasing_id()).write.parquet(path)
    numbered = vle.sparkSession.read.parquet(path)
    return sites.join(numbered, F.col(column) == F.col("type")).select(
        "id_site", F.expr("number div 64").alias("word"), F.expr("shiftleft(1L, int(number % 64))").alias("bits"))


def _resource_types(clicks: DataFrame, vle: DataFrame) -> DataFrame:
    """Distinct activity types per student and course, for any number of types.

    The types met are bits, OR-ed per word before the shuffle, and counted; a student has one row per word at most.
    """
    words = with_known_keys(clicks).join(_numbered_sites(clicks, vle), "id_site").groupBy(*KEYS, "word").agg(F.bit_or("bits").alias("bits"))
    return words.groupBy(*KEYS).agg(F.sum(F.bit_count("bits")).cast("bigint").alias("n_resource_types"))


def _by_day(student_vle: DataFrame) -> DataFrame:
    """Clicks per student, course and day: what all click features need, in fixed-size numbers."""
    click = F.col("sum_click").cast("bigint")
    return with_known_keys(student_vle).groupBy(*KEYS, "date").agg(
        F.sum(click).alias("clicks"), F.count(click).alias("rows"), F.max("sum_click").alias("most"),
        F.sum(click * click).alias("squares"))


def _whole_clicks(student_vle: DataFrame) -> bool:
    return dict(student_vle.dtypes)["sum_click"] in ("tinyint", "smallint", "int", "bigint")


def _spread() -> Column:
    """Sample standard deviation of the clicks since the first day, from sums per day.

    For whole clicks ``n * squares - sum * sum`` is exact in decimals, so nothing cancels.
    """
    def total(c: str) -> Column:
        return F.sum(F.when(F.col("date") >= 0, F.col(c)))

    n, clicks, squares = (total(c).cast("decimal(19,0)") for c in ("rows", "clicks", "squares"))
    scatter = (n * squares - clicks * clicks).cast("double")
    rows = total("rows").cast("double")
    return F.when(rows > 1, F.sqrt(scatter / (rows * (rows - 1))))


def _from_days(student_vle: DataFrame, vle: DataFrame, horizon: int) -> DataFrame:
    """All click features in two aggregates: by day, then by student and course.

    Distinct days become a count, where ``count_distinct`` would send every row again. The first shuffle spreads a busy
    student over all days; the second one gets a single partial row per key and task.
    """
    aggregates = [
        F.coalesce(F.sum("clicks"), F.lit(0)).alias("total_clicks"),
        F.count("date").alias("active_days"),
        F.try_divide(F.sum("clicks"), F.sum("rows")).alias("mean_clicks_per_day"),
        F.max("most").alias("max_clicks_in_day"),
        *_temporal_aggregates(horizon, "clicks", _spread()),
    ]
    days = _by_day(student_vle).groupBy(*KEYS).agg(*aggregates)
    return days.join(_resource_types(student_vle, vle), KEYS, "left").withColumn(
        "n_resource_types", F.coalesce("n_resource_types", F.lit(0).cast("bigint")))


def _from_rows(student_vle: DataFrame, vle: DataFrame, horizon: int, approx: bool) -> DataFrame:
    """The same features straight from the rows: for approximate counts and fractional clicks."""
    clicks = with_activity_type(student_vle, vle)
    resource = "activity_type" if "activity_type" in clicks.columns else "id_site"
    distinct = F.approx_count_distinct if approx else F.count_distinct
    spread = F.stddev_samp(F.when(F.col("date") >= 0, F.col("sum_click")))
    return with_known_keys(clicks).groupBy(*KEYS).agg(
        F.coalesce(F.sum("sum_click"), F.lit(0)).alias("total_clicks"),
        distinct("date").alias("active_days"),
        F.avg("sum_click").alias("mean_clicks_per_day"),
        F.max("sum_click").alias("max_clicks_in_day"),
        distinct(resource).alias("n_resource_types"),
        *_temporal_aggregates(horizon, "sum_click", spread),
    )


def activity_features(
    student_vle: DataFrame, vle: DataFrame, horizon: int = 4, approx: bool = False, as_of_day: int | None = None
) -> DataFrame:
    """``vle_features`` and ``temporal_features`` in one pass over the clicks, for Gold."""
    clicks = _up_to(student_vle, "date", as_of_day)
    by_day = _whole_clicks(clicks) and not approx
    grouped = _from_days(clicks, vle, horizon) if by_day else _from_rows(clicks, vle, horizon, approx)
    return grouped.select(*KEYS, *FEATURE_GROUPS["vle_activity"], *_temporal_columns(horizon))


def vle_features(
    student_vle: DataFrame, vle: DataFrame, approx: bool = False, as_of_day: int | None = None
) -> DataFrame:
    """Click totals, active days and resource variety per student and course, over all days.

    Aggregates of columns that are not selected are pruned by the optimizer.
    """
    return activity_features(student_vle, vle, 1, approx, as_of_day).select(*KEYS, *FEATURE_GROUPS["vle_activity"])


def temporal_features(student_vle: DataFrame, horizon: int = 4, as_of_day: int | None = None) -> DataFrame:
    """Weekly clicks, growth, recency and click spread, for students active since the first day."""
    clicks = with_known_keys(_up_to(student_vle, "date", as_of_day)).filter("date >= 0")
    aggregates = _temporal_aggregates(horizon, "sum_click", F.stddev_samp("sum_click"))
    return clicks.groupBy(*KEYS).agg(*aggregates).select(*KEYS, *_temporal_columns(horizon))


def weekly_clicks(student_vle: DataFrame) -> DataFrame:
    """Clicks per student, course and week since the first day."""
    started = with_known_keys(student_vle).filter("date >= 0")
    return (
        started.groupBy(*KEYS, dense_week(F.col("date")).alias("week"))
        .agg(F.coalesce(F.sum("sum_click"), F.lit(0)).alias("clicks"))
    )


def rolling_clicks(student_vle: DataFrame, window_weeks: tuple[int, ...] = (1, 2, 4)) -> DataFrame:
    """Trailing click sums over the last W weeks; the window sees one row per student and week."""
    def trailing(weeks: int) -> Column:
        span = Window.partitionBy(*KEYS).orderBy("week").rangeBetween(-(weeks - 1), 0)
        return F.sum("clicks").over(span).alias(f"clicks_last_{weeks}_weeks")

    return weekly_clicks(student_vle).select(*KEYS, "week", *[trailing(w) for w in window_weeks])


def activity_frequency(student_vle: DataFrame, horizon: int = 4) -> DataFrame:
    """Active days per elapsed week within the horizon."""
    inside = with_known_keys(student_vle).filter(F.col("date").between(0, 7 * horizon - 1))
    days = inside.select(*KEYS, "date").distinct()
    return days.groupBy(*KEYS).agg((F.count("*") / F.lit(horizon)).alias("active_days_per_week"))


def weekly_sequence(student_vle: DataFrame, length: int = 30) -> DataFrame:
    """Clicks of weeks 1..length as one array per student and course, absent weeks 0."""
    started = with_known_keys(student_vle).filter("date >= 0")
    steps = [_clicks_in_week(w).cast("double") for w in range(1, length + 1)]
    return started.groupBy(*KEYS).agg(F.array(*steps).alias("clicks"))


# ------------------------------------------------------------------ Gold


def fill_counts(df: DataFrame) -> DataFrame:
    """Zero for every missing count; averages and dates stay null."""
    return df.fillna(0, subset=[c for c in df.columns if c.startswith(ZERO_FILLED_PREFIXES)])


def build_gold(
    student_info: DataFrame,
    registration: DataFrame,
    assessments: DataFrame,
    student_assessment: DataFrame,
    vle: DataFrame,
    student_vle: DataFrame,
    horizon: int = 4,
    registration_order: list[str] | None = None,
    null_due: str = "not_late",
    as_of_day: int | None = None,
    missed_for_inactive: bool = False,
    approx: bool = False,
) -> DataFrame:
    """The feature matrix: one row per row of ``student_info``.

    ``as_of_day`` cuts all facts at a day; by default only the weekly columns are limited by ``horizon``.
    """
    base = base_projection(student_info)
    parts = [
        registration_features(registration, registration_order, as_of_day),
        assessment_features(
            assessments, student_assessment, null_due, as_of_day, missed_for_inactive,
            base if missed_for_inactive else None,
        ),
        activity_features(student_vle, vle, horizon, approx, as_of_day),
    ]
    gold = base
    for part in parts:
        gold = gold.join(part, KEYS, "left")
    features = [c for part in parts for c in part.columns if c not in KEYS]
    return fill_counts(gold.select(*base.columns, *features))


def model_matrix(gold: DataFrame) -> DataFrame:
    """Gold with every remaining numeric null set to 0, as models need it."""
    return gold.fillna(0)
