"""One query per operator over the test tables; see ``oracle`` for the SQL."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrace.checks.adapters import (
    event_content,
    event_log,
    event_tables,
    event_text_log,
    event_user,
    order_tables,
    part_content,
    table,
)
from studytrace.functions.columns import between, log_order
from studytrace.layout import Layout
from studytrace.operators.assemble import (
    LEVEL4_BLOCK,
    feature_assembler,
    interaction,
    one_hot,
    vector_entries,
)
from studytrace.operators.explore import (
    column_profile,
    correlation_matrix,
    distinct_values,
    preview,
    with_category_codes,
    with_fixed_codes,
)
from studytrace.operators.history import (
    level4_proficiency,
    overall_accuracy,
    prior_accuracy,
)
from studytrace.operators.joins import (
    duplicate_keys,
    orphan_keys,
    users_of,
    with_level4,
    with_user_attributes,
)
from studytrace.operators.ordered import ordinals, positions
from studytrace.operators.scaling import entry_bounds, scale_entries, scale_scalars
from studytrace.operators import selection
from studytrace.operators.selection import head_in_order, head_percent, train_test_split
from studytrace.operators.validation import prepare_users, validate, with_enum_domains
from studytrace.plans.features import (
    FeatureStage,
    build_features,
    content_dimensions,
    feature_stage,
    level4_members,
    with_content_index,
)
from studytrace.plans.jobs import (
    preprocess_summary,
    seed_warehouse,
    train_from_feature_store,
    train_on_slice,
)
from studytrace.plans.preprocess import (
    in_log_order,
    preprocess,
    preprocess_log,
    with_gender_flags,
    with_level_before_attempt,
)
from studytrace.plans.scoring import (
    advanced,
    features_after,
    history_of,
    read_history,
    score_later_activity,
    train_for_scoring,
    write_history,
)
from studytrace.plans.tables import Tables, log_slice
from studytrace.plans.training import (
    LINEAR_SVM,
    apply_linear,
    benchmark_rows,
    explore_rows,
    labelled_vectors,
    scaled_vectors,
    shares_right,
    split_rows,
    train_all,
    train_benchmark,
    train_benchmark_fixed_codes,
    training_rows,
)
from studytrace.schemas import (
    BENCHMARK_COLUMNS,
    DOMAINS,
    EXPLORE_COLUMNS,
    FOREIGN_KEYS,
    PRIMARY_KEYS,
    SCALAR_FEATURES,
)
from studytrace.session import durable, scratch_path
from studytrace.sources.files import (
    PERMISSIVE,
    publish,
    read_csv_table,
    read_feature_store,
    read_parquet,
    read_prefix,
    read_raw_tables,
    write_feature_store,
)

SLICE = (datetime(2024, 1, 8), datetime(2024, 1, 22))
ALL_TIME = (datetime(2000, 1, 1), datetime(2100, 1, 1))
# Group size above which the block plan is taken in the queries that check it.
SMALL_BLOCK_ROWS = 500


def clean_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preprocess_log(event_log(spark, sf_dir), event_user(spark, sf_dir))


def preprocessed(spark: SparkSession, sf_dir: str) -> Tables:
    return preprocess(event_tables(spark, sf_dir))


def event_features(spark: SparkSession, sf_dir: str) -> FeatureStage:
    return build_features(event_tables(spark, sf_dir), strict=False)


# Scans, filters and joins


def log_time_slice(spark, sf_dir):
    log = event_log(spark, sf_dir)
    log = log.filter(between(log, "timestamp_TW", *SLICE))
    return log.select("row_id", "timestamp_TW", "uuid", "ucid", "upid", "is_correct")


def users_in_slice(spark, sf_dir):
    log = event_log(spark, sf_dir)
    log = log.filter(between(log, "timestamp_TW", *SLICE))
    return users_of(log, event_user(spark, sf_dir))


def log_with_user_attrs(spark, sf_dir):
    joined = with_user_attributes(event_log(spark, sf_dir), event_user(spark, sf_dir))
    gender = F.coalesce("gender", F.lit("unspecified"))
    return joined.select("row_id", "uuid", "user_grade", gender.alias("gender"))


def gender_flags(spark, sf_dir):
    joined = with_user_attributes(event_log(spark, sf_dir), event_user(spark, sf_dir))
    return with_gender_flags(joined).select("row_id", "female", "male", "unspecified")


def level_before_attempt(spark, sf_dir):
    return with_level_before_attempt(event_log(spark, sf_dir)).select("row_id", "level")


def preprocessed_log(spark, sf_dir):
    return in_log_order(clean_log(spark, sf_dir))


# History features


def global_accuracy(spark, sf_dir):
    return overall_accuracy(event_log(spark, sf_dir))


def problem_prior_accuracy(spark, sf_dir):
    log = event_log(spark, sf_dir).select(
        "row_id", "timestamp_TW", "uuid", "upid", "is_correct"
    )
    return prior_accuracy(log, ["upid"], "v_upid_acc")


def problem_prior_accuracy_in_blocks(spark, sf_dir):
    log = event_log(spark, sf_dir).select(
        "row_id", "timestamp_TW", "uuid", "upid", "is_correct"
    )
    groups = log.withColumn("upid", F.col("upid") % 3)
    return prior_accuracy(groups, ["upid"], "v_upid_acc", block_rows=SMALL_BLOCK_ROWS)


def user_problem_prior_accuracy(spark, sf_dir):
    log = event_log(spark, sf_dir).select(
        "row_id", "timestamp_TW", "uuid", "upid", "is_correct"
    )
    return prior_accuracy(log, ["uuid", "upid"], "v_uuid_upid_acc")


def concept_prior_accuracy(spark, sf_dir):
    log = event_log(spark, sf_dir).select(
        "row_id", "timestamp_TW", "uuid", "upid", "ucid", "is_correct"
    )
    return prior_accuracy(log, ["ucid"], "v_ucid_acc")


def concept_level_entries(spark, sf_dir):
    tables = preprocessed(spark, sf_dir)
    indexed = with_content_index(tables.log, content_dimensions(tables.content))
    return indexed.select("row_id", "concept_idx", "level")


def level4_member_lists(spark, sf_dir):
    members = level4_members(content_dimensions(event_content(spark, sf_dir)))
    listed = F.array_join(F.transform("concept_indices", lambda i: i.cast("string")), ",")
    return members.select("level4_id", listed.alias("concept_indices"))


def level4_proficiency_values(spark, sf_dir):
    log = event_features(spark, sf_dir).log
    return log.select("row_id", "level4_idx", "level4_proficiency")


def level4_proficiency_in_blocks(spark, sf_dir):
    log = with_level4(event_log(spark, sf_dir), event_content(spark, sf_dir))
    one_user = log.withColumn("uuid", F.lit("all"))
    return level4_proficiency(one_user, block_rows=SMALL_BLOCK_ROWS).select(
        "row_id", "level4_id", "level4_proficiency"
    )


def order_history_scale(spark, sf_dir):
    stage = feature_stage(order_tables(spark, sf_dir), strict=False)
    return stage.log.select(
        "timestamp_TW",
        "uuid",
        "upid",
        "row_id.*",
        "level4_proficiency",
        "v_uuid_upid_acc",
        "v_upid_acc",
    )


def feature_table_in_blocks(spark, sf_dir):
    """The feature stage with every large user and problem handled in blocks."""
    tables = event_tables(spark, sf_dir)
    few_users = tables.log.withColumn("uuid", (F.col("uuid").cast("bigint") % 3).cast("string"))
    crowded = Tables(few_users, tables.user, tables.content)
    stage = build_features(crowded, strict=False, block_rows=SMALL_BLOCK_ROWS)
    return stage.log.select(
        "row_id", "level4_proficiency", "v_uuid_upid_acc", "v_upid_acc"
    )


def feature_table(spark, sf_dir):
    return event_features(spark, sf_dir).log


def dimension_ordinals(spark, sf_dir):
    tables = event_tables(spark, sf_dir)
    parts = [
        ("concept", tables.content, "ucid"),
        ("level4", tables.content, "level4_id"),
        ("user", tables.user, "uuid"),
    ]
    numbered = [
        ordinals(df, column, "idx").select(
            F.lit(name).alias("dimension"), F.col(column).alias("id"), "idx"
        )
        for name, df, column in parts
    ]
    return numbered[0].unionByName(numbered[1]).unionByName(numbered[2])


def log_positions(spark, sf_dir):
    log = event_log(spark, sf_dir).select("row_id", "timestamp_TW", "uuid", "upid")
    placed = positions(log, log_order(log), "position", block_rows=SMALL_BLOCK_ROWS)
    return placed.select("row_id", "position")


# Data set


def train_test_rows(spark, sf_dir):
    log = event_log(spark, sf_dir).select("row_id", "timestamp_TW", "uuid", "upid")
    return split_rows(log).select("row_id", "is_train")


def sample_prefix(spark, sf_dir):
    log = event_log(spark, sf_dir)
    return head_percent(log, 1.0).select("row_id", "timestamp_TW", "uuid", "upid")


@contextmanager
def small_slots():
    """Search rounds that go on to the last key, as they do on very large logs."""
    kept = selection.FINISH_ROWS
    selection.FINISH_ROWS = 1
    try:
        yield
    finally:
        selection.FINISH_ROWS = kept


def sample_prefix_in_slots(spark, sf_dir):
    with small_slots():
        return sample_prefix(spark, sf_dir)


def train_test_rows_in_slots(spark, sf_dir):
    with small_slots():
        return train_test_rows(spark, sf_dir)


def repeated_key_log(spark, sf_dir):
    """A log where some two hundred rows share a time, a user and a problem."""
    day = F.date_trunc("day", "timestamp_TW").cast("timestamp_ntz")
    return event_log(spark, sf_dir).select(
        day.alias("timestamp_TW"),
        (F.col("uuid").cast("bigint") % 2).cast("string").alias("uuid"),
        F.lit("p").alias("upid"),
        "level",
        "problem_number",
    )


def sample_prefix_repeated_keys(spark, sf_dir):
    return head_percent(repeated_key_log(spark, sf_dir), 30.0)


def train_test_rows_repeated_keys(spark, sf_dir):
    return train_test_split(repeated_key_log(spark, sf_dir))


def complete_split(spark, sf_dir):
    """Complete feature rows with their split, and the matrix widths."""
    stage = event_features(spark, sf_dir)
    rows = durable(training_rows(stage, drop_incomplete=True))
    return split_rows(rows), stage.dimensions


def minmax_scaled_scalars(spark, sf_dir):
    split, _ = complete_split(spark, sf_dir)
    scaled = scale_scalars(split, SCALAR_FEATURES)
    return scaled.select("row_id", "is_train", *SCALAR_FEATURES)


def minmax_scaled_scalars_train_fit(spark, sf_dir):
    split, _ = complete_split(spark, sf_dir)
    scaled = scale_scalars(split, SCALAR_FEATURES, fit_on="train")
    return scaled.select("row_id", "is_train", *SCALAR_FEATURES)


def minmax_scaled_concept_entries(spark, sf_dir):
    split, dims = complete_split(spark, sf_dir)
    bounds = entry_bounds(split, {"concept_idx": "concept_level"})
    scaled = scale_entries(split, bounds, "concept_idx", "concept_level", dims.concepts)
    return scaled.select("row_id", "is_train", "concept_idx", "concept_level")


def assembled_features(spark, sf_dir):
    split, dims = complete_split(spark, sf_dir)
    vectors = scaled_vectors(split, dims.concepts, dims.level4_groups)
    return vector_entries(feature_assembler().transform(vectors), ["row_id"], "features")


def assembled_features_without_level4(spark, sf_dir):
    split, dims = complete_split(spark, sf_dir)
    vectors = scaled_vectors(
        split, dims.concepts, dims.level4_groups, include_level4=False
    )
    assembled = feature_assembler(include_level4=False).transform(vectors)
    return vector_entries(assembled, ["row_id"], "features")


def assembled_features_negative_levels(spark, sf_dir):
    """As ``assembled_features``, from levels that fall below zero in some concepts."""
    stage = event_features(spark, sf_dir)
    fallen = F.col("level") - F.when(F.col("concept_idx") % 3 == 0, F.lit(2)).otherwise(F.lit(0))
    log = stage.log.withColumns(
        {"level": fallen.cast("int"), "level4_proficiency": F.col("level4_proficiency") - 3}
    )
    rows = durable(training_rows(FeatureStage(log, stage.dimensions), drop_incomplete=True))
    dims = stage.dimensions
    vectors = scaled_vectors(split_rows(rows), dims.concepts, dims.level4_groups)
    return vector_entries(feature_assembler().transform(vectors), ["row_id"], "features")


def level4_one_hot_entries(spark, sf_dir):
    stage = event_features(spark, sf_dir)
    hot = one_hot(stage.log, "level4_idx", stage.dimensions.level4_groups, LEVEL4_BLOCK)
    return vector_entries(hot, ["row_id"], LEVEL4_BLOCK)


def level4_interaction_entries(spark, sf_dir):
    stage = event_features(spark, sf_dir)
    hot = one_hot(stage.log, "level4_idx", stage.dimensions.level4_groups, "hot")
    product = interaction(hot, "level4_proficiency", "hot", "product")
    return vector_entries(product, ["row_id"], "product")


# Exploration


def benchmark_frame(spark, sf_dir):
    tables = preprocessed(spark, sf_dir)
    return benchmark_rows(tables.log, tables.user, tables.content)


def category_codes(spark, sf_dir):
    tables = preprocessed(spark, sf_dir)
    rows = benchmark_rows(tables.log, tables.user, tables.content)
    domains = {
        "gender": tables.user,
        "difficulty": tables.content,
        "learning_stage": tables.content,
    }
    return with_category_codes(rows, domains).select("row_id", *BENCHMARK_COLUMNS)


def user_category_codes(spark, sf_dir):
    user = event_user(spark, sf_dir)
    return with_category_codes(user, {"gender": user}).select("uuid", "gender")


def ordinal_recode(spark, sf_dir):
    tables = event_tables(spark, sf_dir)
    joined = tables.log.join(tables.user, "uuid").join(tables.content, "ucid")
    return with_fixed_codes(joined).select(
        "row_id", "gender", "difficulty", "learning_stage"
    )


def exploratory_frame(spark, sf_dir):
    tables = preprocessed(spark, sf_dir)
    return explore_rows(tables.log, tables.user, tables.content)


def log_preview(spark, sf_dir):
    log = event_log(spark, sf_dir)
    return preview(log).select("row_id", "timestamp_TW", "uuid", "ucid", "upid", "level")


def correlations(spark, sf_dir):
    tables = preprocessed(spark, sf_dir)
    rows = explore_rows(tables.log, tables.user, tables.content)
    return correlation_matrix(rows, EXPLORE_COLUMNS).select(
        "column_a", "column_b", F.round("correlation", 6).alias("correlation")
    )


def column_profiles(spark, sf_dir):
    return column_profile(clean_log(spark, sf_dir))


def domain_values(spark, sf_dir):
    tables = event_tables(spark, sf_dir)
    stages = distinct_values(tables.content, ["difficulty", "learning_stage", "level4_id"])
    return stages.unionByName(distinct_values(tables.user, ["gender", "user_city"]))


# Validation and keys


def enum_coercion(spark, sf_dir):
    content = with_enum_domains(part_content(spark, sf_dir), DOMAINS["info_content"])
    return content.select("ucid", "difficulty", "learning_stage")


def validation_rejects(spark, sf_dir):
    rejected = validate(event_text_log(spark, sf_dir), "log_problem").rejected
    return rejected.select(
        "row_id", F.array_join("failed_columns", ",").alias("failed_columns")
    )


def validation_accepted(spark, sf_dir):
    return validate(event_text_log(spark, sf_dir), "log_problem").valid


def first_login_date(spark, sf_dir):
    return prepare_users(event_user(spark, sf_dir)).select("uuid", "first_login_date_TW")


def duplicate_line_keys(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return duplicate_keys(lines, ("l_orderkey", "l_linenumber"))


def duplicate_primary_keys(spark, sf_dir):
    return duplicate_keys(event_log(spark, sf_dir), PRIMARY_KEYS["log_problem"])


def orphan_users(spark, sf_dir):
    return orphan_keys(event_log(spark, sf_dir), event_user(spark, sf_dir), "uuid")


def orphan_concepts(spark, sf_dir):
    """The declared foreign key, against a content table that lacks some concepts."""
    (table_name, column), (other, target) = next(iter(FOREIGN_KEYS.items()))
    tables = {"log_problem": event_log(spark, sf_dir), "info_content": event_content(spark, sf_dir)}
    held = tables[other].filter(F.col(target).cast("int") % 5 != 0)
    return orphan_keys(tables[table_name], held, column)


def stage_summary(spark, sf_dir):
    return preprocess_summary(event_tables(spark, sf_dir), *SLICE)


# Sources and sinks


def csv_roundtrip(spark, sf_dir):
    layout = Layout(scratch_path(spark, "raw"))
    tables = event_tables(spark, sf_dir)
    named = (
        (tables.log.drop("row_id"), layout.log_file),
        (tables.user, layout.user_file),
        (tables.content, layout.content_file),
    )
    for df, path in named:
        # Text keeps microseconds, which the CSV writer's default format cuts.
        texts = df.select(*[F.col(name).cast("string") for name in df.columns])
        texts.write.csv(path, header=True)
    return read_raw_tables(
        spark, layout.log_file, layout.user_file, layout.content_file
    ).log


def raw_csv_files(spark, sf_dir) -> Layout:
    """CSV files with bad values, words for missing ones, quotes and broken lines."""
    layout = Layout(scratch_path(spark, "raw"))
    log = event_text_log(spark, sf_dir)
    log = log.withColumn("ucid", F.when(F.col("row_id") % 37 == 0, "NA").otherwise(F.col("ucid")))
    # The problem id keeps the row number, to name rejected rows by.
    log = log.withColumn("upid", F.col("row_id").cast("string")).drop("row_id")
    user = event_user(spark, sf_dir)
    user = user.select(*[F.col(name).cast("string") for name in user.columns]).withColumns(
        {
            "user_city": F.concat(F.lit('the "city",\n'), F.col("user_city")),
            "points": F.when(F.col("points").cast("int") % 13 == 0, "#N/A").otherwise(F.col("points")),
            "first_login_date_TW": F.when(
                F.col("badges_cnt").cast("int") == 7, "soon"
            ).otherwise(F.col("first_login_date_TW")),
        }
    )
    content = event_content(spark, sf_dir)
    content = content.withColumn(
        "difficulty", F.when(F.col("ucid") == "3", "extreme").otherwise(F.col("difficulty"))
    )
    for df, path in ((log, layout.log_file), (user, layout.user_file), (content, layout.content_file)):
        df.write.csv(path, header=True, quote='"', escape='"')
    return layout


def seed_rejects(spark, sf_dir):
    """What the seed job rejects of every table, with the columns that failed."""
    root = scratch_path(spark, "seeded")
    done = seed_warehouse(
        spark, raw_csv_files(spark, sf_dir), lambda df, name: publish(df, root, name)
    )
    keys = {"info_content": "ucid", "user_profile": "uuid", "log_problem": "upid"}
    parts = [
        done[name].rejected.select(
            F.lit(name).alias("table_name"),
            F.col(key).alias("row_key"),
            F.array_join("failed_columns", ",").alias("failed_columns"),
        )
        for name, key in keys.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _seeded(spark, sf_dir, name) -> DataFrame:
    root = scratch_path(spark, "seeded")
    seed_warehouse(spark, raw_csv_files(spark, sf_dir), lambda df, table: publish(df, root, table))
    return read_parquet(spark, f"{root}/{name}")


def seeded_log(spark, sf_dir):
    return _seeded(spark, sf_dir, "log_problem")


def seeded_users(spark, sf_dir):
    return _seeded(spark, sf_dir, "user_profile")


def csv_missing_words(spark, sf_dir):
    """Typed reading: words for a missing value give null in number and text columns."""
    layout = raw_csv_files(spark, sf_dir)
    users = read_csv_table(spark, layout.user_file, "user_profile", PERMISSIVE)
    return users.select("uuid", "points", "user_city", "first_login_date_TW")


def parquet_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "published")
    publish(event_user(spark, sf_dir), root, "user_profile")
    return read_parquet(spark, f"{root}/user_profile")


def prefix_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "prefix")
    log = event_log(spark, sf_dir).select("row_id", "uuid", "upid", "is_correct")
    publish(log.filter("is_correct"), root, "log/correct")
    publish(log.filter("NOT is_correct OR is_correct IS NULL"), root, "log/others")
    return read_prefix(spark, f"{root}/log", "*.parquet")


def feature_store_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "features")
    write_feature_store(event_features(spark, sf_dir), path)
    return read_feature_store(spark, path).log


# Models


def model_scores(spark, sf_dir):
    return train_on_slice(
        event_tables(spark, sf_dir),
        *ALL_TIME,
        num_samples=None,
        strict=False,
        drop_incomplete=True,
    )


def feature_store_training(spark, sf_dir):
    path = scratch_path(spark, "features")
    write_feature_store(event_features(spark, sf_dir), path)
    return train_from_feature_store(spark, path, drop_incomplete=True)


def linear_svm_score(spark, sf_dir):
    vectors = labelled_vectors(event_features(spark, sf_dir), drop_incomplete=True)
    return train_all(vectors, [LINEAR_SVM])


def split_by_time(spark, sf_dir) -> tuple[Tables, Tables]:
    """The tables up to the end of the slice, and those of the rows after it."""
    tables = event_tables(spark, sf_dir)
    return log_slice(tables, ALL_TIME[0], SLICE[1]), log_slice(tables, SLICE[1], ALL_TIME[1])


HISTORY_COLUMNS = (
    "row_id",
    "concept_idx",
    "level",
    "level4_proficiency",
    "v_uuid_upid_acc",
    "v_upid_acc",
)


def later_slice_features(spark, sf_dir):
    """Features of the later rows from the stored totals of the earlier ones."""
    earlier, later = split_by_time(spark, sf_dir)
    stage = build_features(earlier, strict=False)
    root = scratch_path(spark, "history")
    write_history(history_of(stage.log), root)
    done = features_after(later, stage.dimensions, read_history(spark, root), strict=False)
    return done.log.select(*HISTORY_COLUMNS)


def advanced_history_features(spark, sf_dir):
    """The same, where the totals were brought forward by a slice in between."""
    tables = event_tables(spark, sf_dir)
    first, second = (log_slice(tables, a, b) for a, b in ((ALL_TIME[0], SLICE[0]), SLICE))
    later = log_slice(tables, SLICE[1], ALL_TIME[1])
    stage = build_features(first, strict=False)
    between_log = with_content_index(preprocess_log(second.log, second.user), stage.dimensions)
    root = scratch_path(spark, "history")
    write_history(advanced(history_of(stage.log), between_log), root)
    done = features_after(later, stage.dimensions, read_history(spark, root), strict=False)
    return done.log.select(*HISTORY_COLUMNS)


def scored_activity(spark, sf_dir):
    """Later rows, scored from their raw log by all models of the earlier rows."""
    root = scratch_path(spark, "models")
    earlier, later = split_by_time(spark, sf_dir)
    train_for_scoring(earlier, root, strict=False)
    return score_later_activity(later, root, strict=False)


def fixed_linear_scores(spark, sf_dir) -> DataFrame:
    """Split rows scored by a linear model whose weights follow a rule."""
    split, dims = complete_split(spark, sf_dir)
    split = durable(split)
    vectors = scaled_vectors(split, dims.concepts, dims.level4_groups)
    entries = vector_entries(feature_assembler().transform(vectors), ["row_id"], "features")
    size = len(SCALAR_FEATURES) + dims.concepts + dims.level4_groups
    # Eighths, so that sums differ little between engines.
    rule = (F.col("id") * 37 % 19 - 9) / 8
    model = spark.range(-1, size).select(F.col("id").cast("int").alias("feature_idx"), rule.alias("weight"))
    labels = split.select("row_id", "is_train", F.col("is_correct").cast("double").alias("label"))
    return apply_linear(entries, ["row_id"], model, size).join(labels, "row_id")


def fixed_linear_predictions(spark, sf_dir):
    scored = fixed_linear_scores(spark, sf_dir)
    return scored.select("row_id", F.round("margin", 9).alias("margin"), "prediction")


def fixed_rule_accuracies(spark, sf_dir):
    return shares_right(fixed_linear_scores(spark, sf_dir))


def prefix_training_features(spark, sf_dir):
    """Features of a training prefix from the prefix alone, whole-slice accuracy."""
    tables = event_tables(spark, sf_dir)
    first = Tables(head_in_order(tables.log, 2_000), tables.user, tables.content)
    overall = overall_accuracy(tables.log).scalar()
    stage = build_features(first, strict=False, overall=overall)
    return stage.log.select(*HISTORY_COLUMNS)


def _benchmark(spark, sf_dir, train) -> DataFrame:
    tables = preprocessed(spark, sf_dir)
    _, score = train(tables.log, tables.user, tables.content)
    return spark.createDataFrame([(score,)], "test_score double")


def benchmark_score(spark, sf_dir):
    return _benchmark(spark, sf_dir, train_benchmark)


def benchmark_score_fixed_codes(spark, sf_dir):
    return _benchmark(spark, sf_dir, train_benchmark_fixed_codes)


QUERIES = {
    "log_time_slice": log_time_slice,
    "users_in_slice": users_in_slice,
    "log_with_user_attrs": log_with_user_attrs,
    "gender_flags": gender_flags,
    "level_before_attempt": level_before_attempt,
    "preprocess_log": preprocessed_log,
    "global_accuracy": global_accuracy,
    "problem_prior_accuracy": problem_prior_accuracy,
    "problem_prior_accuracy_in_blocks": problem_prior_accuracy_in_blocks,
    "user_problem_prior_accuracy": user_problem_prior_accuracy,
    "concept_prior_accuracy": concept_prior_accuracy,
    "concept_level_entries": concept_level_entries,
    "level4_members": level4_member_lists,
    "level4_proficiency": level4_proficiency_values,
    "level4_proficiency_in_blocks": level4_proficiency_in_blocks,
    "order_history_scale": order_history_scale,
    "feature_stage": feature_table,
    "feature_stage_in_blocks": feature_table_in_blocks,
    "dimension_ordinals": dimension_ordinals,
    "log_positions": log_positions,
    "train_test_split": train_test_rows,
    "train_test_split_in_slots": train_test_rows_in_slots,
    "train_test_split_repeated_keys": train_test_rows_repeated_keys,
    "sample_prefix": sample_prefix,
    "sample_prefix_in_slots": sample_prefix_in_slots,
    "sample_prefix_repeated_keys": sample_prefix_repeated_keys,
    "minmax_scaled_scalars": minmax_scaled_scalars,
    "minmax_scaled_scalars_train_fit": minmax_scaled_scalars_train_fit,
    "minmax_scaled_concept_entries": minmax_scaled_concept_entries,
    "assembled_features": assembled_features,
    "assembled_features_negative_levels": assembled_features_negative_levels,
    "assembled_features_without_level4": assembled_features_without_level4,
    "level4_one_hot_entries": level4_one_hot_entries,
    "level4_interaction_entries": level4_interaction_entries,
    "benchmark_frame": benchmark_frame,
    "category_codes": category_codes,
    "user_category_codes": user_category_codes,
    "ordinal_recode": ordinal_recode,
    "exploratory_frame": exploratory_frame,
    "log_preview": log_preview,
    "correlation_matrix": correlations,
    "column_profile": column_profiles,
    "distinct_values": domain_values,
    "enum_coercion": enum_coercion,
    "validation_rejects": validation_rejects,
    "validation_accepted": validation_accepted,
    "first_login_date": first_login_date,
    "duplicate_keys": duplicate_line_keys,
    "duplicate_primary_keys": duplicate_primary_keys,
    "orphan_keys": orphan_users,
    "orphan_concepts": orphan_concepts,
    "stage_summary": stage_summary,
    "csv_roundtrip": csv_roundtrip,
    "csv_missing_words": csv_missing_words,
    "seed_rejects": seed_rejects,
    "seeded_log": seeded_log,
    "seeded_users": seeded_users,
    "parquet_roundtrip": parquet_roundtrip,
    "prefix_roundtrip": prefix_roundtrip,
    "feature_store_roundtrip": feature_store_roundtrip,
    "model_scores": model_scores,
    "feature_store_training": feature_store_training,
    "linear_svm_score": linear_svm_score,
    "later_slice_features": later_slice_features,
    "advanced_history_features": advanced_history_features,
    "scored_activity": scored_activity,
    "fixed_linear_predictions": fixed_linear_predictions,
    "fixed_rule_accuracies": fixed_rule_accuracies,
    "prefix_training_features": prefix_training_features,
    "benchmark_score": benchmark_score,
    "benchmark_score_fixed_codes": benchmark_score_fixed_codes,
}
