"""Declared schemas, domains and keys of the three source tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and types of the source tables' columns, in order.
LOG_PROBLEM = T.StructType(
    [
        T.StructField("timestamp_TW", T.TimestampNTZType()),
        T.StructField("uuid", T.StringType()),
        T.StructField("ucid", T.StringType()),
        T.StructField("upid", T.StringType()),
        T.StructField("problem_number", T.ShortType()),
        T.StructField("exercise_problem_repeat_session", T.ShortType()),
        T.StructField("is_correct", T.BooleanType()),
        T.StructField("total_sec_taken", T.IntegerType()),
        T.StructField("total_attempt_cnt", T.ShortType()),
        T.StructField("used_hint_cnt", T.ShortType()),
        T.StructField("is_hint_used", T.BooleanType()),
        T.StructField("is_downgrade", T.BooleanType()),
        T.StructField("is_upgrade", T.BooleanType()),
        T.StructField("level", T.ByteType()),
    ]
)

USER_PROFILE = T.StructType(
    [
        T.StructField("uuid", T.StringType(), False),
        T.StructField("gender", T.StringType()),
        T.StructField("points", T.IntegerType(), False),
        T.StructField("badges_cnt", T.IntegerType(), False),
        T.StructField("first_login_date_TW", T.DateType(), False),
        T.StructField("user_grade", T.IntegerType(), False),
        T.StructField("user_city", T.StringType(), False),
        T.StructField("has_teacher_cnt", T.IntegerType(), False),
        T.StructField("is_self_coach", T.BooleanType(), False),
        T.StructField("has_student_cnt", T.IntegerType(), False),
        T.StructField("belongs_to_class_cnt", T.IntegerType(), False),
        T.StructField("has_class_cnt", T.IntegerType(), False),
    ]
)

INFO_CONTENT = T.StructType(
    [
        T.StructField("ucid", T.StringType(), False),
        T.StructField("content_pretty_name", T.StringType(), False),
        T.StructField("content_kind", T.StringType(), False),
        T.StructField("difficulty", T.StringType(), False),
        T.StructField("subject", T.StringType(), False),
        T.StructField("learning_stage", T.StringType(), False),
        T.StructField("level1_id", T.StringType(), False),
        T.StructField("level2_id", T.StringType(), False),
        T.StructField("level3_id", T.StringType(), False),
        T.StructField("level4_id", T.StringType(), False),
    ]
)

SCHEMAS = {
    "log_problem": LOG_PROBLEM,
    "user_profile": USER_PROFILE,
    "info_content": INFO_CONTENT,
}

# The declared keys.
PRIMARY_KEYS = {
    "log_problem": ("timestamp_TW", "uuid", "upid"),
    "user_profile": ("uuid",),
    "info_content": ("ucid",),
}

# (table, column) -> (referenced table, referenced column)
FOREIGN_KEYS = {("log_problem", "ucid"): ("info_content", "ucid")}

# The domains of the enumerated columns.
DIFFICULTIES = ("easy", "hard", "normal", "unset")
LEARNING_STAGES = ("elementary", "junior", "senior")

DOMAINS = {
    "info_content": {"difficulty": DIFFICULTIES, "learning_stage": LEARNING_STAGES},
    "log_problem": {},
    "user_profile": {},
}

# Upgrade and downgrade flags arrive in several spellings; see functions.columns.
FLAG_COLUMNS = ("is_downgrade", "is_upgrade")

# Numeric codes for the exploratory queries.
GENDER_CODES = {"unspecified": 0, "male": 1, "female": 2}
DIFFICULTY_CODES = {"unset": 0, "easy": 1, "normal": 2, "hard": 3}
LEARNING_STAGE_CODES = {"elementary": 0, "junior": 1, "senior": 2}

# Gender indicator columns, in feature order.
GENDER_FLAGS = ("female", "male", "unspecified")

# Columns only known after the attempt.
LEAKAGE_COLUMNS = ("total_sec_taken", "is_hint_used", "is_downgrade", "is_upgrade")

# Scalar model features, in feature order.
SCALAR_FEATURES = (
    "user_grade",
    "female",
    "male",
    "unspecified",
    "v_upid_acc",
    "level",
    "problem_number",
    "exercise_problem_repeat_session",
)

# Label first, then the ten benchmark features.
BENCHMARK_COLUMNS = (
    "is_correct",
    "level",
    "difficulty",
    "learning_stage",
    "gender",
    "user_grade",
    "has_teacher_cnt",
    "is_self_coach",
    "has_student_cnt",
    "belongs_to_class_cnt",
    "has_class_cnt",
)

# Columns of the exploratory frame (label, attempt, user, content).
EXPLORE_COLUMNS = (
    "is_correct",
    "total_attempt_cnt",
    "user_grade",
    "used_hint_cnt",
    "level",
    "difficulty",
    "learning_stage",
    "gender",
    "has_teacher_cnt",
    "is_self_coach",
    "has_student_cnt",
    "belongs_to_class_cnt",
    "has_class_cnt",
)
