"""The same results as ``queries`` in SQL over the test tables."""

from __future__ import annotations

LOG = """log AS (
  SELECT event_id AS row_id, ts AS "timestamp_TW", CAST(user_id AS VARCHAR) AS uuid,
    CAST(k % 20 AS VARCHAR) AS ucid, CAST(k AS VARCHAR) AS upid,
    CAST(1 + event_id % 7 AS SMALLINT) AS problem_number,
    CAST(event_id % 3 AS SMALLINT) AS exercise_problem_repeat_session,
    CASE WHEN event_id % 97 <> 0 THEN event_type IN ('click', 'view', 'purchase') END
      AS is_correct,
    CAST(floor(value) AS INTEGER) AS total_sec_taken,
    CAST(1 + event_id % 4 AS SMALLINT) AS total_attempt_cnt,
    CAST(event_id % 3 AS SMALLINT) AS used_hint_cnt,
    event_id % 3 > 0 AS is_hint_used,
    CASE WHEN event_id % 11 <> 0 THEN event_id % 17 = 0 END AS is_downgrade,
    CASE WHEN event_id % 11 <> 0 THEN event_id % 13 = 0 AND event_id % 5 >= 1 END
      AS is_upgrade,
    CAST(event_id % 5 AS TINYINT) AS level
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events)
)"""

USERS = """users AS (
  SELECT CASE WHEN c_acctbal >= 0 THEN '' ELSE 'x-' END || c_custkey AS uuid,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'female' WHEN 'MACHINERY' THEN 'male'
      WHEN 'AUTOMOBILE' THEN 'other' WHEN 'FURNITURE' THEN NULL ELSE 'unspecified' END
      AS gender,
    CAST(floor(c_acctbal) AS INTEGER) AS points,
    CAST(c_custkey % 30 AS INTEGER) AS badges_cnt,
    '2018-' || lpad(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0') || '-'
      || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') AS "first_login_date_TW",
    CAST(1 + c_nationkey % 12 AS INTEGER) AS user_grade,
    'city ' || c_nationkey AS user_city,
    CAST(c_custkey % 3 AS INTEGER) AS has_teacher_cnt,
    c_custkey % 7 = 0 AS is_self_coach,
    CAST(c_custkey % 5 AS INTEGER) AS has_student_cnt,
    CAST(c_custkey % 4 AS INTEGER) AS belongs_to_class_cnt,
    CAST(c_custkey % 2 AS INTEGER) AS has_class_cnt
  FROM customer
)"""

CONTENT = """content AS (
  SELECT CAST(n AS VARCHAR) AS ucid, 'exercise ' || n AS content_pretty_name,
    'Exercise' AS content_kind,
    CASE n % 4 WHEN 0 THEN 'unset' WHEN 1 THEN 'easy' WHEN 2 THEN 'normal'
      ELSE 'hard' END AS difficulty,
    'math' AS subject,
    CASE n % 3 WHEN 0 THEN 'elementary' WHEN 1 THEN 'junior' ELSE 'senior' END
      AS learning_stage,
    'L1' AS level1_id, 'L2-' || n % 2 AS level2_id, 'L3-' || n % 2 AS level3_id,
    'L4-' || n % 4 AS level4_id
  FROM (SELECT DISTINCT CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 20 AS n
    FROM events)
)"""

# Cleaned log.
CLEAN = """clean AS (
  SELECT log.row_id, log."timestamp_TW", log.uuid, log.ucid, log.upid,
    log.problem_number, log.exercise_problem_repeat_session, log.is_correct,
    log.total_attempt_cnt, log.used_hint_cnt,
    CAST(log.level + coalesce(CAST(log.is_downgrade AS INTEGER), 0)
      - coalesce(CAST(log.is_upgrade AS INTEGER), 0) AS TINYINT) AS level,
    users.user_grade,
    CAST(coalesce(users.gender, 'unspecified') = 'female' AS INTEGER) AS female,
    CAST(coalesce(users.gender, 'unspecified') = 'male' AS INTEGER) AS male,
    CAST(coalesce(users.gender, 'unspecified') = 'unspecified' AS INTEGER) AS unspecified
  FROM log LEFT JOIN users ON log.uuid = users.uuid
)"""

INDEX = """content_index AS (
  SELECT ucid, level4_id,
    CAST(row_number() OVER (ORDER BY ucid) - 1 AS INTEGER) AS concept_idx,
    CAST(dense_rank() OVER (ORDER BY level4_id) - 1 AS INTEGER) AS level4_idx
  FROM content
)"""


def prior_accuracy(keys: str, order: str) -> str:
    """Expression for the prior accuracy over a log relation ``r``."""
    own_key = " OR ".join(f"r.{key.strip()} IS NULL" for key in keys.split(","))
    window = (
        f"(PARTITION BY {keys} ORDER BY {order}"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
    return f"""CASE WHEN r.is_correct IS NULL OR {own_key} THEN ga.v ELSE coalesce(
      CAST(coalesce(sum(CAST(r.is_correct AS INTEGER)) OVER {window}, 0) AS DOUBLE)
      / nullif(CAST(count(*) OVER {window} AS DOUBLE), 0), ga.v) END"""


ORDER = '"timestamp_TW", uuid, upid, row_id'
MEAN = "ga AS (SELECT avg(CAST(is_correct AS DOUBLE)) AS v FROM log)"


def with_(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


def proficiency(source: str, order: str) -> str:
    """Two window steps: change of the latest level, then its running total."""
    return f"""stepped AS (
  SELECT *, CAST(coalesce(level, 0) AS INTEGER) - coalesce(lag(CAST(coalesce(level, 0)
      AS INTEGER)) OVER (PARTITION BY uuid, ucid ORDER BY {order}), 0) AS change
  FROM {source}
), summed AS (
  SELECT * EXCLUDE (change), CAST(sum(change) OVER (PARTITION BY uuid, level4_id
      ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT)
      AS level4_proficiency
  FROM stepped
)"""


INDEXED = """indexed AS (
  SELECT clean.*, content_index.* EXCLUDE (ucid)
  FROM clean LEFT JOIN content_index ON clean.ucid = content_index.ucid
)"""

BASE = (LOG, USERS, CONTENT, CLEAN, INDEX, INDEXED, MEAN)

FEATURES = (
    *BASE,
    proficiency("indexed", ORDER),
    f"""features AS (
  SELECT r.*, {prior_accuracy("uuid, upid", ORDER)} AS v_uuid_upid_acc,
    {prior_accuracy("upid", ORDER)} AS v_upid_acc
  FROM summed r CROSS JOIN ga
)""",
)

# Complete rows with the exact 80/20 split by hash order.
SPLIT = (
    *FEATURES,
    """complete AS (
  SELECT *, level AS concept_level FROM features
  WHERE user_grade IS NOT NULL AND is_correct IS NOT NULL
), hashed AS (
  SELECT *, row_number() OVER (ORDER BY md5('760:' || CAST(row_id AS VARCHAR)), row_id)
    AS place, count(*) OVER () AS n
  FROM complete
), split AS (
  SELECT * EXCLUDE (place, n),
    place <= floor(n * CAST(0.8 AS DOUBLE)) AS is_train
  FROM hashed
)""",
)

SCALARS = (
    "user_grade",
    "female",
    "male",
    "unspecified",
    "v_upid_acc",
    "level",
    "problem_number",
    "exercise_problem_repeat_session",
)


def scaled(value: str, low: str, high: str) -> str:
    return (
        f"CASE WHEN {high} = {low} THEN 0.0::DOUBLE ELSE"
        f" (CAST({value} AS DOUBLE) - {low}) / ({high} - {low}) END"
    )


def scaled_scalars(bounds_of: str = "PARTITION BY is_train", only: str = "") -> str:
    """Relation ``scalars``: every scalar scaled by its window bounds."""
    items = []
    for name in SCALARS:
        number = f"CAST({name} AS DOUBLE)"
        low = f"(min({number}) {only} OVER ({bounds_of}))"
        high = f"(max({number}) {only} OVER ({bounds_of}))"
        items.append(f"{scaled(name, low, high)} AS {name}")
    return f"scalars AS (SELECT row_id, is_train, {', '.join(items)} FROM split)"


def scaled_entries(index: str, value: str, name: str) -> str:
    """Relation of scaled entries, bounds including implicit zeros."""
    return f"""{name}_bounds AS (
  SELECT is_train, {index},
    CASE WHEN count(*) < any_value(n) THEN least(min({value}), 0) ELSE min({value}) END
      AS low,
    CASE WHEN count(*) < any_value(n) THEN greatest(max({value}), 0)
      ELSE max({value}) END AS high
  FROM (SELECT is_train, {index}, CAST({value} AS DOUBLE) AS {value},
      count(*) OVER (PARTITION BY is_train) AS n FROM split)
  WHERE {index} IS NOT NULL GROUP BY is_train, {index}
), {name} AS (
  SELECT split.row_id, split.is_train, split.{index},
    {scaled(f'split.{value}', 'low', 'high')} AS {value}
  FROM split JOIN {name}_bounds b
    ON split.is_train = b.is_train AND split.{index} = b.{index}
)"""


CONCEPTS = scaled_entries("concept_idx", "concept_level", "concepts")
GROUPS = scaled_entries("level4_idx", "level4_proficiency", "groups")


def vector_rows(*parts: str) -> str:
    return " UNION ALL ".join(f"SELECT * FROM ({part}) WHERE value <> 0" for part in parts)


SCALAR_PARTS = [
    f"SELECT row_id, {i} AS feature_idx, {name} AS value FROM scalars"
    for i, name in enumerate(SCALARS)
]
CONCEPT_PART = (
    "SELECT row_id, CAST(8 + concept_idx AS INTEGER) AS feature_idx,"
    " concept_level AS value FROM concepts"
)
GROUP_PART = (
    "SELECT row_id, CAST(8 + (SELECT count(*) FROM content) + level4_idx AS INTEGER)"
    " AS feature_idx, level4_proficiency AS value FROM groups"
)

# Levels that fall below zero: where zero is not a column's minimum, rows without an
# entry hold the scaled zero.
FALLEN = (
    *FEATURES[:-1],
    FEATURES[-1].replace("features AS (", "risen AS (", 1),
    """features AS (
  SELECT * REPLACE (level - CASE WHEN concept_idx % 3 = 0 THEN 2 ELSE 0 END AS level,
    level4_proficiency - 3 AS level4_proficiency) FROM risen
)""",
    *SPLIT[len(FEATURES) :],
)


def shifted_entries(index: str, value: str, name: str, offset: str) -> str:
    """Rows of all columns whose zero does not scale to zero, but the own one."""
    return f"""SELECT split.row_id, CAST({offset} + b.{index} AS INTEGER) AS feature_idx,
    CAST(-b.low AS DOUBLE) / (b.high - b.low) AS value
  FROM split JOIN {name}_bounds b ON split.is_train = b.is_train
    AND split.{index} IS DISTINCT FROM b.{index}
  WHERE b.low < 0 AND b.high > b.low"""


BENCHMARK = (
    LOG,
    USERS,
    CONTENT,
    CLEAN,
    """joined AS (
  SELECT clean.*, users.* EXCLUDE (uuid, user_grade), content.* EXCLUDE (ucid)
  FROM clean JOIN users ON clean.uuid = users.uuid AND clean.user_grade = users.user_grade
  JOIN content ON clean.ucid = content.ucid
)""",
)
BENCHMARK_ITEMS = """row_id, is_correct, level, difficulty, learning_stage, gender,
  user_grade, has_teacher_cnt, is_self_coach, has_student_cnt, belongs_to_class_cnt,
  has_class_cnt"""
# The only columns of the joined frame that can be null.
NULL_FREE = "is_correct IS NOT NULL AND gender IS NOT NULL"

CODES = """CASE gender WHEN 'unspecified' THEN 0 WHEN 'male' THEN 1 WHEN 'female' THEN 2
    END AS gender,
  CASE difficulty WHEN 'unset' THEN 0 WHEN 'easy' THEN 1 WHEN 'normal' THEN 2
    WHEN 'hard' THEN 3 END AS difficulty,
  CASE learning_stage WHEN 'elementary' THEN 0 WHEN 'junior' THEN 1 WHEN 'senior' THEN 2
    END AS learning_stage"""

EXPLORE = """explore AS (
  SELECT * FROM (
    SELECT row_id, is_correct, total_attempt_cnt, user_grade, used_hint_cnt, level,
      has_teacher_cnt, is_self_coach, has_student_cnt, belongs_to_class_cnt,
      has_class_cnt, """ + CODES + """
    FROM joined)
  WHERE is_correct IS NOT NULL AND gender IS NOT NULL
)"""
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
CORRELATIONS = " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, CASE WHEN"
    f" stddev_pop(CAST({a} AS DOUBLE)) > 0 AND stddev_pop(CAST({b} AS DOUBLE)) > 0 THEN"
    f" round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) END AS correlation"
    " FROM explore"
    for a in EXPLORE_COLUMNS
    for b in EXPLORE_COLUMNS
)

# Columns of the cleaned log and their types.
CLEAN_COLUMNS = {
    "uuid": "string",
    "row_id": "bigint",
    "timestamp_TW": "timestamp_ntz",
    "ucid": "string",
    "upid": "string",
    "problem_number": "smallint",
    "exercise_problem_repeat_session": "smallint",
    "is_correct": "boolean",
    "total_attempt_cnt": "smallint",
    "used_hint_cnt": "smallint",
    "level": "tinyint",
    "user_grade": "int",
    "female": "int",
    "male": "int",
    "unspecified": "int",
}
PROFILE = " UNION ALL ".join(
    f"SELECT {i} AS position, '{name}' AS column_name, '{kind}' AS data_type,"
    f" count(\"{name}\") AS non_null_count, count(*) AS row_count FROM clean"
    for i, (name, kind) in enumerate(CLEAN_COLUMNS.items())
)


def codes(column: str, relation: str) -> str:
    """Relation of category codes: the rank in the sorted domain."""
    return (
        f"{column}_codes AS (SELECT {column}, dense_rank() OVER (ORDER BY {column}) - 1"
        f" AS code FROM (SELECT DISTINCT {column} FROM {relation}"
        f" WHERE {column} IS NOT NULL))"
    )


# The event log as text with bad values.
TEXT = """text_log AS (
  SELECT row_id, "timestamp_TW", uuid, ucid, upid,
    CASE WHEN row_id % 29 = 0 THEN '40000' ELSE CAST(problem_number AS VARCHAR) END
      AS problem_number,
    exercise_problem_repeat_session, is_correct,
    CASE WHEN row_id % 23 = 0 THEN 'abc' ELSE CAST(total_sec_taken AS VARCHAR) END
      AS total_sec_taken,
    total_attempt_cnt, used_hint_cnt, is_hint_used,
    CASE row_id % 4 WHEN 0 THEN 'True' WHEN 1 THEN 'false' WHEN 2 THEN 'None' ELSE '1'
      END AS is_downgrade,
    is_upgrade,
    CASE WHEN row_id % 31 = 0 THEN '300' ELSE CAST(level AS VARCHAR) END AS level
  FROM log
)"""
FAILED = """concat_ws(',',
    CASE WHEN TRY_CAST(problem_number AS SMALLINT) IS NULL THEN 'problem_number' END,
    CASE WHEN TRY_CAST(total_sec_taken AS INTEGER) IS NULL THEN 'total_sec_taken' END,
    CASE WHEN TRY_CAST(level AS TINYINT) IS NULL THEN 'level' END)"""

# The raw files of the seed job, before they are written.
RAW_USERS = """raw_users AS (
  SELECT * REPLACE ('the "city",' || chr(10) || user_city AS user_city,
    CASE WHEN points % 13 <> 0 THEN points END AS points,
    CASE WHEN badges_cnt <> 7 THEN CAST("first_login_date_TW" AS DATE) END
      AS "first_login_date_TW")
  FROM users
)"""
RAW_LOG = """raw_log AS (
  SELECT * REPLACE (CAST(row_id AS VARCHAR) AS upid,
    CASE WHEN row_id % 37 <> 0 THEN ucid END AS ucid) FROM text_log
)"""
SEEDED_LOG = """"timestamp_TW", uuid, ucid, upid,
    CAST(problem_number AS SMALLINT) AS problem_number, exercise_problem_repeat_session,
    is_correct, CAST(total_sec_taken AS INTEGER) AS total_sec_taken, total_attempt_cnt,
    used_hint_cnt, is_hint_used,
    CASE is_downgrade WHEN 'True' THEN true WHEN '1' THEN true WHEN 'false' THEN false END
      AS is_downgrade,
    is_upgrade, CAST(level AS TINYINT) AS level"""

ORDER_LOG = """order_log AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate AS "timestamp_TW",
    o_custkey AS uuid, l_partkey AS ucid, l_partkey * 10 + l_linenumber AS upid,
    l_returnflag <> 'R' AS is_correct, l_linenumber % 5 AS level, p_brand AS level4_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN part ON l_partkey = p_partkey
), ga AS (SELECT avg(CAST(is_correct AS DOUBLE)) AS v FROM order_log)"""
LINE_ORDER = '"timestamp_TW", uuid, upid, l_orderkey, l_linenumber, l_extendedprice'

IN_SLICE = (
    "\"timestamp_TW\" >= TIMESTAMP '2024-01-08' AND \"timestamp_TW\" < TIMESTAMP '2024-01-22'"
)

ACCURACY_ITEMS = 'row_id, "timestamp_TW", uuid, upid, is_correct'


def _accuracy_query(keys: str, name: str, items: str = ACCURACY_ITEMS) -> str:
    return (
        with_(LOG, MEAN)
        + f"SELECT {items}, {prior_accuracy(keys, ORDER)} AS {name}"
        + " FROM log r CROSS JOIN ga"
    )


REPEATED = """repeated AS (
  SELECT date_trunc('day', "timestamp_TW")::TIMESTAMP AS "timestamp_TW",
    CAST(CAST(uuid AS BIGINT) % 2 AS VARCHAR) AS uuid, 'p' AS upid, level, problem_number
  FROM log
)"""
# Rows that share a key follow one another by their other columns.
TIES = "level, problem_number"
TRAIN_TEST = """SELECT row_id, row_number() OVER (ORDER BY md5('760:' || CAST(row_id AS VARCHAR)),
    row_id) <= floor(count(*) OVER () * CAST(0.8 AS DOUBLE)) AS is_train FROM log"""
PREFIX = f"""SELECT row_id, "timestamp_TW", uuid, upid FROM log ORDER BY {ORDER}
    LIMIT (SELECT CAST(round_even(count(*) / 100.0, 0) AS BIGINT) FROM log)"""

LATER = """SELECT row_id, concept_idx, level, level4_proficiency, v_uuid_upid_acc,
    v_upid_acc FROM features WHERE "timestamp_TW" >= TIMESTAMP '2024-01-22'"""

# A linear model whose weights follow a rule, applied to the feature entries.
FIXED_LINEAR = (
    *SPLIT,
    scaled_scalars(),
    CONCEPTS,
    GROUPS,
    "entries AS (" + vector_rows(*SCALAR_PARTS, CONCEPT_PART, GROUP_PART) + ")",
    """scored AS (
  SELECT row_id, sum(value * (feature_idx * 37 % 19 - 9) / CAST(8 AS DOUBLE))
    + CAST(-37 % 19 - 9 AS DOUBLE) / 8 AS margin
  FROM entries GROUP BY row_id
)""",
)

ORACLE = {
    "log_time_slice": with_(LOG)
    + 'SELECT row_id, "timestamp_TW", uuid, ucid, upid, is_correct FROM log'
    + f" WHERE {IN_SLICE}",
    "users_in_slice": with_(LOG, USERS)
    + "SELECT * FROM users WHERE EXISTS (SELECT 1 FROM log"
    + f" WHERE log.uuid = users.uuid AND {IN_SLICE})",
    "log_with_user_attrs": with_(LOG, USERS)
    + "SELECT row_id, log.uuid, user_grade, coalesce(gender, 'unspecified') AS gender"
    + " FROM log LEFT JOIN users ON log.uuid = users.uuid",
    "gender_flags": with_(LOG, USERS, CLEAN)
    + "SELECT row_id, female, male, unspecified FROM clean",
    "level_before_attempt": with_(LOG, USERS, CLEAN) + "SELECT row_id, level FROM clean",
    "preprocess_log": with_(LOG, USERS, CLEAN)
    + f"SELECT * FROM clean ORDER BY {ORDER}",
    "global_accuracy": with_(LOG, MEAN) + "SELECT v AS overall_accuracy FROM ga",
    "problem_prior_accuracy": _accuracy_query("upid", "v_upid_acc"),
    "problem_prior_accuracy_in_blocks": with_(
        LOG,
        MEAN,
        "thirds AS (SELECT row_id, \"timestamp_TW\", uuid, CAST(upid AS BIGINT) % 3 AS upid,"
        " is_correct FROM log)",
    )
    + f"SELECT {ACCURACY_ITEMS}, {prior_accuracy('upid', ORDER)} AS v_upid_acc"
    + " FROM thirds r CROSS JOIN ga",
    "user_problem_prior_accuracy": _accuracy_query("uuid, upid", "v_uuid_upid_acc"),
    "concept_prior_accuracy": _accuracy_query(
        "ucid", "v_ucid_acc", ACCURACY_ITEMS + ", ucid"
    ),
    "concept_level_entries": with_(*BASE) + "SELECT row_id, concept_idx, level FROM indexed",
    "level4_members": with_(LOG, CONTENT, INDEX)
    + "SELECT level4_id, string_agg(CAST(concept_idx AS VARCHAR), ','"
    + " ORDER BY concept_idx) AS concept_indices FROM content_index GROUP BY level4_id",
    "level4_proficiency": with_(*BASE, proficiency("indexed", ORDER))
    + "SELECT row_id, level4_idx, level4_proficiency FROM summed",
    "level4_proficiency_in_blocks": with_(
        LOG,
        CONTENT,
        "one_user AS (SELECT row_id, \"timestamp_TW\", 'all' AS uuid, log.ucid, upid, level,"
        " level4_id FROM log LEFT JOIN content ON log.ucid = content.ucid)",
        proficiency("one_user", ORDER),
    )
    + "SELECT row_id, level4_id, level4_proficiency FROM summed",
    "order_history_scale": with_(ORDER_LOG, proficiency("order_log", LINE_ORDER))
    + f"""SELECT "timestamp_TW", uuid, upid, l_orderkey, l_linenumber, l_extendedprice,
    level4_proficiency, {prior_accuracy("uuid, upid", LINE_ORDER)} AS v_uuid_upid_acc,
    {prior_accuracy("upid", LINE_ORDER)} AS v_upid_acc
    FROM summed r CROSS JOIN ga""",
    "feature_stage": with_(*FEATURES) + "SELECT * FROM features",
    "feature_stage_in_blocks": with_(
        "crowded_" + LOG,
        "log AS (SELECT * REPLACE (CAST(CAST(uuid AS BIGINT) % 3 AS VARCHAR) AS uuid)"
        " FROM crowded_log)",
        *FEATURES[1:],
    )
    + "SELECT row_id, level4_proficiency, v_uuid_upid_acc, v_upid_acc FROM features",
    "dimension_ordinals": with_(LOG, USERS, CONTENT)
    + """SELECT dimension, id, CAST(dense_rank() OVER (PARTITION BY dimension ORDER BY id)
    - 1 AS INTEGER) AS idx FROM (
    SELECT DISTINCT 'concept' AS dimension, ucid AS id FROM content
    UNION ALL SELECT DISTINCT 'level4', level4_id FROM content
    UNION ALL SELECT DISTINCT 'user', uuid FROM users)""",
    "log_positions": with_(LOG)
    + f"SELECT row_id, row_number() OVER (ORDER BY {ORDER}) - 1 AS position FROM log",
    "train_test_split": with_(LOG) + TRAIN_TEST,
    "train_test_split_in_slots": with_(LOG) + TRAIN_TEST,
    "train_test_split_repeated_keys": with_(LOG, REPEATED)
    + f"""SELECT *, row_number() OVER (ORDER BY md5('760:'
      || strftime("timestamp_TW", '%Y-%m-%d %H:%M:%S') || ':' || uuid || ':' || upid),
      "timestamp_TW", uuid, upid, {TIES}) <= floor(count(*) OVER () * CAST(0.8 AS DOUBLE))
      AS is_train FROM repeated""",
    "sample_prefix": with_(LOG) + PREFIX,
    "sample_prefix_in_slots": with_(LOG) + PREFIX,
    "sample_prefix_repeated_keys": with_(LOG, REPEATED)
    + f"""SELECT * FROM repeated ORDER BY "timestamp_TW", uuid, upid, {TIES}
    LIMIT (SELECT CAST(round_even(count(*) * 0.3, 0) AS BIGINT) FROM repeated)""",
    "minmax_scaled_scalars": with_(*SPLIT, scaled_scalars()) + "SELECT * FROM scalars",
    "minmax_scaled_scalars_train_fit": with_(
        *SPLIT, scaled_scalars("", "FILTER (WHERE is_train)")
    )
    + "SELECT * FROM scalars",
    "minmax_scaled_concept_entries": with_(*SPLIT, CONCEPTS) + "SELECT * FROM concepts",
    "assembled_features": with_(*SPLIT, scaled_scalars(), CONCEPTS, GROUPS)
    + vector_rows(*SCALAR_PARTS, CONCEPT_PART, GROUP_PART),
    "assembled_features_negative_levels": with_(*FALLEN, scaled_scalars(), CONCEPTS, GROUPS)
    + vector_rows(
        *SCALAR_PARTS,
        CONCEPT_PART,
        GROUP_PART,
        shifted_entries("concept_idx", "concept_level", "concepts", "8"),
        shifted_entries(
            "level4_idx", "level4_proficiency", "groups", "8 + (SELECT count(*) FROM content)"
        ),
    ),
    "assembled_features_without_level4": with_(*SPLIT, scaled_scalars(), CONCEPTS)
    + vector_rows(*SCALAR_PARTS, CONCEPT_PART),
    "level4_one_hot_entries": with_(*FEATURES)
    + "SELECT row_id, level4_idx AS feature_idx, CAST(1 AS DOUBLE) AS value FROM features",
    "level4_interaction_entries": with_(*FEATURES)
    + "SELECT row_id, level4_idx AS feature_idx, CAST(level4_proficiency AS DOUBLE) AS"
    + " value FROM features WHERE level4_proficiency <> 0",
    "benchmark_frame": with_(*BENCHMARK)
    + f"SELECT {BENCHMARK_ITEMS} FROM joined WHERE {NULL_FREE}",
    "category_codes": with_(
        *BENCHMARK,
        codes("gender", "users"),
        codes("difficulty", "content"),
        codes("learning_stage", "content"),
    )
    + f"""SELECT row_id, is_correct, level, d.code AS difficulty, s.code AS learning_stage,
    g.code AS gender, user_grade, has_teacher_cnt, is_self_coach, has_student_cnt,
    belongs_to_class_cnt, has_class_cnt
    FROM (SELECT * FROM joined WHERE {NULL_FREE}) j
    JOIN gender_codes g ON j.gender = g.gender
    JOIN difficulty_codes d ON j.difficulty = d.difficulty
    JOIN learning_stage_codes s ON j.learning_stage = s.learning_stage""",
    "user_category_codes": with_(USERS, codes("gender", "users"))
    + "SELECT uuid, coalesce(code, -1) AS gender FROM users"
    + " LEFT JOIN gender_codes ON users.gender = gender_codes.gender",
    "ordinal_recode": with_(LOG, USERS, CONTENT)
    + f"SELECT row_id, {CODES} FROM log JOIN users ON log.uuid = users.uuid"
    + " JOIN content ON log.ucid = content.ucid",
    "exploratory_frame": with_(*BENCHMARK, EXPLORE) + "SELECT * FROM explore",
    "correlation_matrix": with_(*BENCHMARK, EXPLORE) + CORRELATIONS,
    "column_profile": with_(LOG, USERS, CLEAN) + PROFILE,
    "distinct_values": with_(LOG, USERS, CONTENT)
    + """SELECT DISTINCT 'difficulty' AS column_name, difficulty AS value FROM content
    UNION ALL SELECT DISTINCT 'learning_stage', learning_stage FROM content
    UNION ALL SELECT DISTINCT 'level4_id', level4_id FROM content
    UNION ALL SELECT DISTINCT 'gender', gender FROM users
    UNION ALL SELECT DISTINCT 'user_city', user_city FROM users""",
    "enum_coercion": """SELECT p_partkey AS ucid,
    CASE p_size % 5 WHEN 0 THEN 'easy' WHEN 1 THEN 'hard' WHEN 2 THEN 'normal'
      WHEN 3 THEN 'unset' END AS difficulty,
    CASE p_size % 4 WHEN 0 THEN 'elementary' WHEN 1 THEN 'junior' WHEN 2 THEN 'senior' END
      AS learning_stage FROM part""",
    "validation_rejects": with_(LOG, TEXT)
    + f"SELECT row_id, {FAILED} AS failed_columns FROM text_log WHERE {FAILED} <> ''",
    "validation_accepted": with_(LOG, TEXT)
    + f"""SELECT "timestamp_TW", uuid, ucid, upid,
    CAST(problem_number AS SMALLINT) AS problem_number, exercise_problem_repeat_session,
    is_correct, CAST(total_sec_taken AS INTEGER) AS total_sec_taken, total_attempt_cnt,
    used_hint_cnt, is_hint_used,
    CASE is_downgrade WHEN 'True' THEN true WHEN '1' THEN true WHEN 'false' THEN false END
      AS is_downgrade,
    is_upgrade, CAST(level AS TINYINT) AS level
    FROM text_log WHERE {FAILED} = ''""",
    "seeded_log": with_(LOG, TEXT, RAW_LOG)
    + f"SELECT {SEEDED_LOG} FROM raw_log WHERE {FAILED} = ''",
    "seeded_users": with_(USERS, RAW_USERS)
    + """SELECT * FROM raw_users WHERE points IS NOT NULL
    AND "first_login_date_TW" IS NOT NULL""",
    "seed_rejects": with_(LOG, TEXT, RAW_LOG, USERS, RAW_USERS, CONTENT)
    + f"""SELECT 'log_problem' AS table_name, upid AS row_key, {FAILED} AS failed_columns
    FROM raw_log WHERE {FAILED} <> ''
    UNION ALL SELECT 'user_profile', uuid, concat_ws(',',
      CASE WHEN points IS NULL THEN 'points' END,
      CASE WHEN "first_login_date_TW" IS NULL THEN 'first_login_date_TW' END)
    FROM raw_users WHERE points IS NULL OR "first_login_date_TW" IS NULL
    UNION ALL SELECT 'info_content', ucid, 'difficulty' FROM content WHERE ucid = '3'""",
    "csv_missing_words": with_(USERS, RAW_USERS)
    + 'SELECT uuid, points, user_city, "first_login_date_TW" FROM raw_users',
    "log_preview": with_(LOG)
    + f"""SELECT row_id, "timestamp_TW", uuid, ucid, upid, level FROM log
    ORDER BY {ORDER} LIMIT 5""",
    "orphan_concepts": with_(LOG)
    + "SELECT ucid, count(*) AS row_count FROM log WHERE CAST(ucid AS INTEGER) % 5 = 0"
    + " GROUP BY ucid",
    "first_login_date": with_(USERS)
    + 'SELECT uuid, CAST("first_login_date_TW" AS DATE) AS "first_login_date_TW" FROM users',
    "duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem"
    + " GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
    "duplicate_primary_keys": with_(LOG)
    + 'SELECT "timestamp_TW", uuid, upid, count(*) AS row_count FROM log'
    + ' GROUP BY "timestamp_TW", uuid, upid HAVING count(*) > 1',
    "orphan_keys": with_(LOG, USERS)
    + "SELECT uuid, count(*) AS row_count FROM log"
    + " WHERE uuid NOT IN (SELECT uuid FROM users) GROUP BY uuid",
    "stage_summary": with_(LOG, USERS, CONTENT)
    + f"""SELECT (SELECT count(*) FROM log WHERE {IN_SLICE}) AS log_rows,
    (SELECT count(*) FROM users WHERE uuid IN (SELECT uuid FROM log WHERE {IN_SLICE}))
      AS user_rows,
    (SELECT count(*) FROM content) AS content_rows,
    '2024-01-08T00:00:00' AS start_date, '2024-01-22T00:00:00' AS end_date""",
    "csv_roundtrip": with_(LOG) + "SELECT * EXCLUDE (row_id) FROM log",
    "parquet_roundtrip": with_(USERS) + "SELECT * FROM users",
    "prefix_roundtrip": with_(LOG) + "SELECT row_id, uuid, upid, is_correct FROM log",
    "fixed_linear_predictions": with_(*FIXED_LINEAR)
    + """SELECT row_id, round(margin, 9) AS margin, CAST(margin > 0 AS DOUBLE) AS prediction
    FROM scored""",
    "fixed_rule_accuracies": with_(*FIXED_LINEAR)
    + """SELECT is_train, avg(CAST((margin > 0) = is_correct AS DOUBLE)) AS score
    FROM scored JOIN split USING (row_id) GROUP BY is_train""",
    "prefix_training_features": with_(*FEATURES)
    + f"""SELECT row_id, concept_idx, level, level4_proficiency, v_uuid_upid_acc, v_upid_acc
    FROM features ORDER BY {ORDER} LIMIT 2000""",
    "later_slice_features": with_(*FEATURES) + LATER,
    "advanced_history_features": with_(*FEATURES) + LATER,
    "feature_store_roundtrip": with_(*FEATURES) + "SELECT * FROM features",
}
