from __future__ import annotations

import os
from datetime import date, datetime

import pytest
from pyspark.sql import types as T

from studytrace import session
from studytrace.layout import Layout
from studytrace.operators.validation import prepare_users, validate, with_enum_domains
from studytrace.plans.features import build_features
from studytrace.plans.jobs import seed_warehouse
from studytrace.plans.tables import Tables
from studytrace.schemas import FOREIGN_KEYS, PRIMARY_KEYS, SCHEMAS
from studytrace.session import durable, scratch_path, scratch_scope, shared_dir
from studytrace.sources.files import (
    CORRUPT,
    PERMISSIVE,
    has_broken_lines,
    publish,
    read_csv_table,
    read_feature_store,
    read_parquet,
    read_prefix,
    read_raw_tables,
    write_feature_store,
)
from studytrace.sources.jdbc import Warehouse

LOG_HEADER = (
    "timestamp_TW,uuid,ucid,upid,problem_number,exercise_problem_repeat_session,"
    "is_correct,total_sec_taken,total_attempt_cnt,used_hint_cnt,is_hint_used,level"
)
LOG_LINE = "2024-01-01,u1,c1,p1,1,0,True,10,1,0,False,1"


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture
def raw_files(tmp_path):
    return (
        write(tmp_path / "log.csv", LOG_HEADER, LOG_LINE),
        write(tmp_path / "user.csv", "uuid,gender,user_grade", "u1,female,5"),
        write(
            tmp_path / "content.csv",
            "ucid,level4_id,difficulty,learning_stage",
            "c1,l1,easy,elementary",
        ),
    )


def test_raw_tables(spark, raw_files):
    tables = read_raw_tables(spark, *raw_files)
    shapes = [(df.count(), len(df.columns)) for df in (tables.log, tables.user, tables.content)]
    assert shapes == [(1, 12), (1, 3), (1, 4)]
    row = tables.log.first()
    assert row["timestamp_TW"] == datetime(2024, 1, 1)
    assert row["is_correct"] is True and row["level"] == 1
    assert isinstance(tables.log.schema["level"].dataType, T.ByteType)


def test_empty_log_is_an_error(spark, raw_files, tmp_path):
    empty = write(tmp_path / "empty.csv", LOG_HEADER)
    with pytest.raises(ValueError, match="Log data is empty"):
        read_raw_tables(spark, empty, *raw_files[1:])


def test_columns_are_matched_by_name(spark, tmp_path):
    path = write(
        tmp_path / "log.csv",
        "level,extra,is_upgrade,uuid,is_downgrade,timestamp_TW",
        "3,x,True,u1,,2018-11-12 22:45:00 UTC",
        "4,y,None,u2,0,2018-11-12 22:45:01.250000",
    )
    rows = read_csv_table(spark, path, "log_problem").orderBy("level").collect()
    assert [r["uuid"] for r in rows] == ["u1", "u2"]
    assert [r["extra"] for r in rows] == ["x", "y"]
    assert [r["is_upgrade"] for r in rows] == [True, None]
    assert [r["is_downgrade"] for r in rows] == [None, False]
    assert rows[0]["timestamp_TW"] == datetime(2018, 11, 12, 22, 45)
    assert rows[1]["timestamp_TW"] == datetime(2018, 11, 12, 22, 45, 1, 250000)


def test_bad_values_fail_or_stay_visible(spark, tmp_path):
    path = write(
        tmp_path / "log.csv", "uuid,problem_number", "u1,40000", "u2,abc", "u3,7"
    )
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv_table(spark, path, "log_problem").collect()
    rows = read_csv_table(spark, path, "log_problem", PERMISSIVE).orderBy("uuid").collect()
    assert [r["problem_number"] for r in rows] == [None, None, 7]
    assert [r[CORRUPT] for r in rows] == ["u1,40000", "u2,abc", None]


def test_parquet_and_prefix(spark, raw_log, tmp_path):
    root = str(tmp_path)
    publish(raw_log.filter("row_id < 2"), root, "log/a")
    publish(raw_log.filter("row_id >= 2"), root, "log/deep/b")
    assert read_parquet(spark, f"{root}/log/a").count() == 2
    assert read_prefix(spark, f"file://{root}/log", "*.parquet").count() == 5


def test_feature_store(spark, raw_log, three_users, two_content, tmp_path):
    path = str(tmp_path / "store")
    stage = build_features(Tables(raw_log, three_users, two_content))
    write_feature_store(stage, path)
    stored = read_feature_store(spark, path)
    assert (stored.dimensions.concepts, stored.dimensions.level4_groups) == (2, 2)
    columns = sorted(stage.log.columns)
    assert sorted(stored.log.select(*columns).collect()) == sorted(
        stage.log.select(*columns).collect()
    )
    files = [f for f in stored.log.inputFiles() if f.endswith(".gz.parquet")]
    assert files and len(files) == len(stored.log.inputFiles())


def test_layout():
    layout = Layout("gs://bucket/root/")
    assert layout.raw == "gs://bucket/root/data/raw"
    assert layout.log_file == "gs://bucket/root/data/raw/Log_Problem.csv"
    assert layout.user_file == "gs://bucket/root/data/raw/Info_UserData.csv"
    assert layout.content_file == "gs://bucket/root/data/raw/Info_Content.csv"
    assert Layout().feature_store == "artifacts/data/feature_store"
    names = [layout.output, layout.experiment, layout.test, layout.demo, layout.model]
    assert len(set(names)) == 5


def test_declared_keys_exist_in_their_schemas():
    for table, key in PRIMARY_KEYS.items():
        assert set(key) <= set(SCHEMAS[table].fieldNames())
    for (table, column), (other, target) in FOREIGN_KEYS.items():
        assert column in SCHEMAS[table].fieldNames()
        assert (target,) == PRIMARY_KEYS[other]


USER_TEXT = (
    "uuid string, gender string, points string, badges_cnt int, first_login_date_TW string,"
    " user_grade double, user_city string, has_teacher_cnt int, is_self_coach boolean,"
    " has_student_cnt int, belongs_to_class_cnt int, has_class_cnt int"
)


def user_row(uuid, points="1", grade=5.0, login="2018-01-02"):
    return (uuid, None, points, 1, login, grade, "city", 0, False, 0, 0, 0)


def test_users_are_validated_and_rejects_kept(spark):
    users = spark.createDataFrame(
        [user_row("u1"), user_row("u2", points="abc"), user_row("u3", grade=float("nan"))],
        USER_TEXT,
    )
    result = validate(prepare_users(users), "user_profile")
    valid = result.valid.collect()
    assert [r["uuid"] for r in valid] == ["u1"]
    assert valid[0]["first_login_date_TW"] == date(2018, 1, 2)
    assert [f.dataType for f in result.valid.schema] == [
        f.dataType for f in SCHEMAS["user_profile"]
    ]
    assert {r["uuid"]: r["failed_columns"] for r in result.rejected.collect()} == {
        "u2": ["points"],
        "u3": ["user_grade"],
    }


def test_log_flags_survive_and_optional_columns_may_lack(spark):
    log = spark.createDataFrame(
        [("u1", "True", "40000"), ("u2", "None", "3"), ("u3", "odd", None)],
        "uuid string, is_upgrade string, problem_number string",
    )
    result = validate(log, "log_problem")
    assert {r["uuid"]: r["is_upgrade"] for r in result.valid.collect()} == {
        "u2": None,
        "u3": None,
    }
    assert [r["failed_columns"] for r in result.rejected.collect()] == [["problem_number"]]


def test_enum_values_outside_the_domain(spark):
    content = spark.createDataFrame(
        [("a", "easy"), ("b", "extreme"), ("c", None)], "ucid string, difficulty string"
    )
    coerced = with_enum_domains(content, {"difficulty": ("easy",), "absent": ("x",)})
    assert {r["ucid"]: r["difficulty"] for r in coerced.collect()} == {
        "a": "easy",
        "b": None,
        "c": None,
    }
    with pytest.raises(ValueError, match="content_kind"):
        validate(content, "info_content")


def test_seeding_writes_content_users_then_log(spark, tmp_path):
    layout = Layout(str(tmp_path))
    raw = tmp_path / "data" / "raw"
    raw.mkdir(parents=True)
    write(raw / "Log_Problem.csv", LOG_HEADER, LOG_LINE)
    names = SCHEMAS["user_profile"].fieldNames()
    write(raw / "Info_UserData.csv", ",".join(names), "u1,female,3,1,2018-01-02,5,c,0,true,0,0,0")
    names = SCHEMAS["info_content"].fieldNames()
    write(
        raw / "Info_Content.csv",
        ",".join(names),
        "c1,n,k,easy,math,junior,a,b,c,d",
        "c2,n,k,extreme,math,junior,a,b,c,d",
    )
    written = []
    done = seed_warehouse(spark, layout, lambda df, table: written.append((table, df.count())))
    assert written == [("info_content", 1), ("user_profile", 1), ("log_problem", 1)]
    assert [r["failed_columns"] for r in done["info_content"].rejected.collect()] == [
        ["difficulty"]
    ]


def test_jdbc_options():
    """Options only: no database is opened here."""
    warehouse = Warehouse("jdbc:postgresql://host/db", {"user": "reader"}, partitions=4)
    sliced = warehouse.slice_options(
        "log_problem", "timestamp_TW", datetime(2019, 6, 1), datetime(2019, 6, 10)
    )
    assert sliced == {
        "url": "jdbc:postgresql://host/db",
        "dbtable": "log_problem",
        "preferTimestampNTZ": "true",
        "user": "reader",
        "partitionColumn": "timestamp_TW",
        "lowerBound": "2019-06-01 00:00:00",
        "upperBound": "2019-06-10 00:00:00",
        "numPartitions": "4",
    }
    assert "partitionColumn" not in warehouse.scan_options("user_profile")
    assert warehouse.write_options("log_problem")["batchsize"] == "100000"


def test_jdbc_slice_reads_three_tables(monkeypatch, raw_log, three_users, two_content):
    tables = {
        "log_problem": raw_log,
        "user_profile": three_users,
        "info_content": two_content,
    }
    monkeypatch.setattr(
        "studytrace.sources.jdbc._load", lambda spark, options: tables[options["dbtable"]]
    )
    cut = Warehouse("jdbc:x").read_slice(None, datetime(2024, 1, 1), datetime(2024, 1, 3))
    assert cut.log.count() == 2
    assert [r["uuid"] for r in cut.user.collect()] == ["u1"]
    assert cut.content.count() == 2


def test_shared_folder_comes_from_the_session(spark, monkeypatch, tmp_path):
    class Conf:
        def get(self, key, default):
            return str(tmp_path) if key == "spark.checkpoint.dir" else default

    class Named:
        conf = Conf()

    assert shared_dir(Named()) == str(tmp_path)
    assert scratch_path(Named(), "t").startswith(f"{tmp_path}/t-")

    class Unnamed:
        class conf:
            @staticmethod
            def get(key, default):
                return default

        class sparkContext:
            master = "yarn"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(ValueError, match="shared folder"):
        shared_dir(Unnamed())
    assert session.CHECKPOINT_DIR == "spark.checkpoint.dir"


def test_scratch_tables_go_with_their_job(raw_log, spark):
    root = shared_dir(spark).removeprefix("file:")

    def tables():
        return {name for name in os.listdir(root) if name.startswith("table-")}

    before = tables()
    with pytest.raises(RuntimeError), scratch_scope(spark):
        outer = durable(raw_log)
        with scratch_scope(spark):
            durable(raw_log)
        # The inner job's table is gone, the outer one's is not.
        assert len(tables() - before) == 1 and outer.count() == raw_log.count()
        raise RuntimeError("stopped")
    assert tables() == before
    durable(raw_log)
    assert len(tables() - before) == 1


def test_durable_cuts_lineage(raw_log, capsys):
    stored = durable(raw_log.filter("row_id > 1"), "is_correct")
    assert stored.count() == 3
    stored.explain()
    assert "FileScan parquet" in capsys.readouterr().out


def test_quoted_text_and_missing_words(spark, tmp_path):
    path = tmp_path / "content.csv"
    path.write_text(
        "ucid,content_pretty_name,content_kind\n"
        'c1,"Say ""x, y"" now",Exercise\nc2,NaN,NA\nc3,"two\nlines",Exercise\n'
    )
    rows = read_csv_table(spark, str(path), "info_content", multi_line=True).collect()
    assert [tuple(r) for r in rows] == [
        ("c1", 'Say "x, y" now', "Exercise"),
        ("c2", None, None),
        ("c3", "two\nlines", "Exercise"),
    ]


def test_missing_words_and_broken_lines_by_default(spark, tmp_path):
    path = tmp_path / "user.csv"
    path.write_text('uuid,points,user_city\nu1,NA,"a\nb"\nu2,7,"c, ""d"""\nu3,nan,null\n')
    rows = read_csv_table(spark, str(path), "user_profile").orderBy("uuid").collect()
    assert [tuple(r) for r in rows] == [("u1", None, "a\nb"), ("u2", 7, 'c, "d"'), ("u3", None, None)]
    plain = write(tmp_path / "plain.csv", "uuid,points", "u1,1")
    assert has_broken_lines(spark, str(path)) and not has_broken_lines(spark, plain)


def test_feature_files_grow_with_rows_and_features_run_once(
    spark, raw_log, three_users, two_content, tmp_path
):
    stage = build_features(Tables(raw_log, three_users, two_content))
    write_feature_store(stage, str(tmp_path / "a"), file_rows=1)
    write_feature_store(stage, str(tmp_path / "b"), file_rows=100)
    files = [len(read_feature_store(spark, str(tmp_path / n)).log.inputFiles()) for n in "ab"]
    assert files[0] > files[1] == 1


def test_missing_flags_do_not_count(spark):
    from studytrace.functions.columns import as_flag

    df = spark.createDataFrame([(float("nan"),), (0.0,), (1.0,), (None,)], "f double")
    assert [r[0] for r in df.select(as_flag(df, "f")).collect()] == [None, False, True, None]
