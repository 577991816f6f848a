import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from learnlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# The hand-made student, click, site and registration rows the expected results refer to.
@pytest.fixture(scope="session")
def student_info(spark):
    return spark.createDataFrame(
        [
            ("AAA", "2014J", 1, "M", "Scotland", "A Level or Equivalent", "0-10%", "0-35", 0, 60, "N", "Pass"),
            ("AAA", "2014J", 2, "F", "London Region", "HE Qualification", "10-20", "35-55", 1, 120, "N", "Withdrawn"),
            ("BBB", "2014B", 3, "M", "North Region", "Lower Than A Level", "20-30%", "0-35", 0, 60, "Y", "Distinction"),
        ],
        "code_module string, code_presentation string, id_student long, gender string, region string, "
        "highest_education string, imd_band string, age_band string, num_of_prev_attempts long, "
        "studied_credits long, disability string, final_result string",
    )


@pytest.fixture(scope="session")
def student_vle(spark):
    rows = [(1, 100, 1, 3), (1, 101, 4, 5), (1, 102, 9, 2), (2, 100, 2, 7), (2, 100, 5, 1), (2, 103, 12, 4)]
    return spark.createDataFrame(
        [("AAA", "2014J", *r) for r in rows],
        "code_module string, code_presentation string, id_student long, id_site long, date long, sum_click long")


@pytest.fixture(scope="session")
def vle(spark):
    return spark.createDataFrame([(s, "url") for s in range(100, 104)], "id_site long, activity_type string")


@pytest.fixture(scope="session")
def registration(spark):
    rows = [(1, "AAA", "2014J", -30, None), (2, "AAA", "2014J", -30, None), (3, "BBB", "2014B", -30, None)]
    return spark.createDataFrame(
        rows, "id_student long, code_module string, code_presentation string, date_registration long, "
              "date_unregistration long")


ASSESSMENTS = ("code_module string, code_presentation string, id_assessment long, assessment_type string, "
               "date long, weight double")
SUBMISSIONS = "id_assessment long, id_student long, date_submitted long, is_banked long, score double"


@pytest.fixture(scope="session")
def no_assessments(spark):
    return spark.createDataFrame([], ASSESSMENTS)


@pytest.fixture(scope="session")
def no_submissions(spark):
    return spark.createDataFrame([], SUBMISSIONS)
