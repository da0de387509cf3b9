from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from studytrace.operators.assemble import feature_assembler
from studytrace.plans import training
from studytrace.plans.jobs import train_from_feature_store, train_on_slice
from studytrace.plans.features import build_features
from studytrace.plans.preprocess import preprocess
from studytrace.plans.tables import Tables
from studytrace.plans.training import (
    LINEAR_SVM,
    MODEL_TYPES,
    classifier,
    labelled_vectors,
    load_model,
    score_activity,
    train_all,
    train_and_score,
    train_benchmark,
    train_benchmark_fixed_codes,
)
from studytrace.sources.files import write_feature_store


@pytest.fixture(scope="module")
def binary(spark):
    """The label equals the first coordinate."""
    rows = [
        (Vectors.dense(0, 0), 0.0, True),
        (Vectors.dense(1, 1), 1.0, True),
        (Vectors.dense(0, 1), 0.0, True),
        (Vectors.dense(1, 0), 1.0, True),
        (Vectors.dense(0, 0), 0.0, False),
        (Vectors.dense(1, 1), 1.0, False),
    ]
    return spark.createDataFrame(rows, ["features", "label", "is_train"])


@pytest.fixture(scope="module")
def signal(spark):
    """A log whose label follows the level, so that every model can learn it."""
    log = spark.range(300).select(
        F.col("id").alias("row_id"),
        (F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz") + F.expr("make_dt_interval(0, id)")).alias(
            "timestamp_TW"
        ),
        F.concat(F.lit("u"), F.col("id") % 7).alias("uuid"),
        F.concat(F.lit("c"), F.col("id") % 5).alias("ucid"),
        F.concat(F.lit("p"), F.col("id") % 11).alias("upid"),
        (F.col("id") % 3).cast("int").alias("problem_number"),
        (F.col("id") % 2).cast("int").alias("exercise_problem_repeat_session"),
        (F.col("id") % 4 >= 2).alias("is_correct"),
        F.lit(1).alias("total_sec_taken"),
        F.lit(1).alias("total_attempt_cnt"),
        F.lit(0).alias("used_hint_cnt"),
        F.lit(False).alias("is_hint_used"),
        F.lit(False).alias("is_downgrade"),
        F.lit(False).alias("is_upgrade"),
        (F.col("id") % 4).cast("int").alias("level"),
    )
    user = spark.range(7).select(
        F.concat(F.lit("u"), F.col("id")).alias("uuid"),
        (5 + F.col("id") % 2).cast("int").alias("user_grade"),
        F.when(F.col("id") % 2 == 0, "female").otherwise("male").alias("gender"),
        F.lit(1).alias("has_teacher_cnt"),
        (F.col("id") % 2 == 0).alias("is_self_coach"),
        F.lit(0).alias("has_student_cnt"),
        F.lit(1).alias("belongs_to_class_cnt"),
        F.lit(1).alias("has_class_cnt"),
    )
    content = spark.range(5).select(
        F.concat(F.lit("c"), F.col("id")).alias("ucid"),
        F.concat(F.lit("l"), F.col("id") % 2).alias("level4_id"),
        F.when(F.col("id") % 2 == 0, "easy").otherwise("hard").alias("difficulty"),
        F.when(F.col("id") % 2 == 0, "elementary").otherwise("junior").alias(
            "learning_stage"
        ),
    )
    return Tables(log, user, content)


@pytest.fixture(scope="module")
def vectors(signal):
    return labelled_vectors(build_features(signal))


ALL_DAYS = (datetime(2024, 1, 1), datetime(2026, 1, 1))


def test_tree_learns_the_binary_fixture(binary):
    _, scores = train_and_score(binary, "DecisionTreeClassifier")
    assert scores["train_score"] >= 0.5 and scores["test_score"] >= 0.5


def test_unknown_model_type(binary):
    with pytest.raises(ValueError, match="Unsupported model_type: Nothing"):
        train_and_score(binary, "Nothing")


def test_penalty_strength_follows_the_row_count():
    ridge = classifier("LogisticRegression_L2", 400)
    lasso = classifier("LogisticRegression_L1", 400)
    assert ridge.getRegParam() == lasso.getRegParam() == 1 / 400
    assert (ridge.getElasticNetParam(), lasso.getElasticNetParam()) == (0.0, 1.0)
    assert classifier("GradientBoostingClassifier", 1).getMaxIter() == 100


def test_tree_statistics_of_all_tasks_fit_an_executor(spark, binary, monkeypatch):
    made = []

    def kept(*settings):
        made.append(classifier(*settings))
        return made[-1]

    monkeypatch.setattr(training, "classifier", kept)
    train_and_score(binary, "DecisionTreeClassifier")
    heap = spark._jvm.java.lang.Runtime.getRuntime().maxMemory() / 2**20
    held = made[0].getMaxMemoryInMB() * spark.sparkContext.defaultParallelism
    # A fifth of the heap: half of what cached rows cannot fill.
    assert 0 < held <= 0.2 * heap


def test_passes_over_few_nodes_grow_the_same_tree(vectors):
    noisy = feature_assembler().transform(vectors.filter("row_id < 80")).withColumn(
        "label", (F.xxhash64("row_id") % 2 == 0).cast("double")
    )
    wide, narrow = (
        classifier("DecisionTreeClassifier", 1, node_memory=mb).fit(noisy) for mb in (1024, 0)
    )
    assert wide.numNodes > 20
    assert wide.toDebugString.splitlines()[1:] == narrow.toDebugString.splitlines()[1:]


def test_all_models_learn(signal):
    got = train_on_slice(signal, *ALL_DAYS, num_samples=None, boosting_stages=3)
    scores = {r["model_type"]: r for r in got.collect()}
    assert tuple(scores) == MODEL_TYPES
    assert scores["DecisionTreeClassifier"]["train_score"] == 1.0
    for row in scores.values():
        assert row["test_score"] >= 0.9


def test_fit_is_reproducible(vectors):
    kinds = ["DecisionTreeClassifier", "LogisticRegression_L1"]
    assert train_all(vectors, kinds).collect() == train_all(vectors, kinds).collect()


def test_sample_size_limits_the_rows(signal):
    stage = build_features(signal)
    vectors = labelled_vectors(stage, num_samples=50)
    assert vectors.count() == 50
    assert vectors.filter("is_train").count() == 40
    assert vectors.agg(F.max("row_id")).first()[0] == 49


def test_saved_model_scores_activity(vectors, tmp_path):
    train_all(vectors, ["DecisionTreeClassifier"], model_root=str(tmp_path))
    model = load_model(str(tmp_path), "DecisionTreeClassifier")
    scored = score_activity(model, vectors).join(vectors, "row_id")
    assert scored.count() == 300
    hits = scored.filter("prediction = label").count()
    assert hits >= 290


def test_training_from_the_feature_store(spark, signal, vectors, tmp_path):
    path = str(tmp_path / "store")
    write_feature_store(build_features(signal), path)
    stored = train_from_feature_store(spark, path, model_types=MODEL_TYPES[:1])
    assert stored.collect() == train_all(vectors, MODEL_TYPES[:1]).collect()


def test_linear_svm_without_level4(vectors):
    row = train_all(vectors, [LINEAR_SVM], include_level4=False).first()
    assert row["test_score"] >= 0.9


def test_incomplete_rows(signal):
    holed = Tables(
        signal.log.withColumn(
            "is_correct", F.when(F.col("row_id") % 3 != 0, F.col("is_correct"))
        ),
        signal.user,
        signal.content,
    )
    stage = build_features(holed)
    assert labelled_vectors(stage, drop_incomplete=True).count() == 200
    assert labelled_vectors(stage).count() == 300


@pytest.fixture(scope="module")
def benchmark_tables(spark):
    ids = range(10)
    log = spark.createDataFrame(
        [(i, f"u{i}", 5 + i % 2, f"c{i}", i % 2, 1 + i % 2) for i in ids],
        "row_id bigint, uuid string, user_grade int, ucid string, is_correct int, level int",
    )
    user = spark.createDataFrame(
        [
            (f"u{i}", 5 + i % 2, ("female", "male")[i % 2], 1, bool(i % 2), 0, 1, 1)
            for i in ids
        ],
        "uuid string, user_grade int, gender string, has_teacher_cnt int,"
        " is_self_coach boolean, has_student_cnt int, belongs_to_class_cnt int,"
        " has_class_cnt int",
    )
    content = spark.createDataFrame(
        [(f"c{i}", ("easy", "hard")[i % 2], ("elementary", "junior")[i % 2]) for i in ids],
        "ucid string, difficulty string, learning_stage string",
    )
    return Tables(log, user, content)


def test_benchmark_model(spark, benchmark_tables):
    tables = benchmark_tables
    model, score = train_benchmark(tables.log, tables.user, tables.content)
    assert 0.0 <= score <= 1.0
    logistic = model.stages[-1]
    assert logistic.numFeatures == 10
    # Constant columns scale to zero and get no weight.
    assert logistic.coefficients[5] == 0.0


def test_benchmark_with_fixed_codes(signal):
    done = preprocess(signal)
    model, score = train_benchmark_fixed_codes(done.log, done.user, done.content)
    assert 0.0 <= score <= 1.0
    assert model.stages[-1].numFeatures == 8
