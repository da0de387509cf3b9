from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from studytrace.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


LOG_SCHEMA = (
    "row_id bigint, uuid string, ucid string, upid string, level int, is_correct boolean,"
    " user_grade int, female int, male int, unspecified int, problem_number int,"
    " exercise_problem_repeat_session int"
)
RAW_SCHEMA = (
    "row_id bigint, timestamp_TW timestamp_ntz, uuid string, ucid string, upid string,"
    " problem_number int, exercise_problem_repeat_session int, is_correct boolean,"
    " total_sec_taken int, is_hint_used boolean, is_downgrade int, is_upgrade int,"
    " level int"
)


@pytest.fixture(scope="session")
def short_log(spark):
    """Two attempts of one user at one problem, then one of another user."""
    return spark.createDataFrame(
        [
            (0, "u1", "c1", "p1", 1, True, 5, 1, 0, 0, 1, 0),
            (1, "u1", "c1", "p1", 2, False, 5, 1, 0, 0, 2, 1),
            (2, "u2", "c2", "p2", 3, True, 6, 0, 0, 1, 1, 0),
        ],
        LOG_SCHEMA,
    )


@pytest.fixture(scope="session")
def stage_log(spark):
    return spark.createDataFrame(
        [
            (0, "u1", "c1", "p1", 1, True, 5, 1, 0, 0, 1, 0),
            (1, "u1", "c2", "p2", 2, False, 5, 1, 0, 0, 2, 1),
            (2, "u2", "c1", "p1", 3, True, 6, 0, 1, 0, 1, 0),
        ],
        LOG_SCHEMA,
    )


@pytest.fixture(scope="session")
def two_content(spark):
    return spark.createDataFrame(
        [("c1", "l1"), ("c2", "l2")], "ucid string, level4_id string"
    )


def user_frame(spark, *rows):
    return spark.createDataFrame(
        list(rows), "uuid string, user_grade int, gender string"
    )


@pytest.fixture(scope="session")
def raw_log(spark):
    def day(n):
        return datetime(2024, 1, n)

    return spark.createDataFrame(
        [
            (0, day(1), "u1", "c1", "p1", 1, 0, True, 11, False, 0, 0, 1),
            (1, day(2), "u1", "c2", "p2", 2, 1, False, 12, True, 0, 1, 2),
            (2, day(3), "u2", "c1", "p1", 1, 0, True, 13, False, 1, 0, 3),
            (3, day(4), "u2", "c2", "p2", 2, 1, False, 14, True, 0, 0, 4),
            (4, day(5), "u3", "c1", "p1", 3, 0, True, 15, False, 0, 0, 5),
        ],
        RAW_SCHEMA,
    )


@pytest.fixture(scope="session")
def three_users(spark):
    return user_frame(spark, ("u1", 5, "female"), ("u2", 6, "male"), ("u3", 7, None))
