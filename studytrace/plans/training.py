"""Training stage: dataset, four classifiers, benchmark model, accuracies."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from studytrace.functions.columns import row_key
from studytrace.operators.assemble import (
    CONCEPT_BLOCK,
    LEVEL4_BLOCK,
    feature_assembler,
    shifted_block,
    sparse_block,
)
from studytrace.operators.explore import with_category_codes, with_fixed_codes
from studytrace.operators.joins import log_user_content
from studytrace.operators.ordered import bounded_broadcast
from studytrace.operators.scaling import (
    FIT_EACH,
    entry_bounds,
    implicit_values,
    scalar_bounds,
    scale_entries,
    scale_scalars,
)
from studytrace.operators.selection import SPLIT_SEED, head_in_order, train_test_split
from studytrace.plans.features import FeatureStage
from studytrace.schemas import BENCHMARK_COLUMNS, EXPLORE_COLUMNS, SCALAR_FEATURES
from studytrace.session import durable

# The model types a training run covers, in order.
MODEL_TYPES = (
    "DecisionTreeClassifier",
    "GradientBoostingClassifier",
    "LogisticRegression_L2",
    "LogisticRegression_L1",
)
LINEAR_SVM = "LinearSVM"

SCORE_SCHEMA = "model_type string, train_score double, test_score double"

#: Most MB of node statistics in a task that grows a tree: Spark's default.
NODE_MEMORY_MB = 256

_ENTRIES = ("concept_idx", "concept_level", "level4_idx", "level4_proficiency")


def training_rows(
    stage: FeatureStage, drop_incomplete: bool = False, labelled: bool = True
) -> DataFrame:
    """Row key, scalar features, matrix entries and label of every log row.

    With ``drop_incomplete``, rows lacking a scalar feature go, and with
    ``labelled`` those lacking a label.
    """
    log = stage.log.withColumn("concept_level", F.col("level"))
    names = [*SCALAR_FEATURES, "is_correct"]
    # The key and order columns stay along; dict keeps each name once.
    keep = dict.fromkeys(
        [*row_key(log), *[c for c in ("timestamp_TW", "uuid", "upid") if c in log.columns]]
    )
    rows = log.select(*keep, *names, *_ENTRIES)
    needed = names if labelled else list(SCALAR_FEATURES)
    return rows.dropna(subset=needed) if drop_incomplete else rows


def split_rows(
    rows: DataFrame, num_samples: int | None = None, seed: int = SPLIT_SEED
) -> DataFrame:
    """Exact 80/20 split of the first ``num_samples`` rows in log order."""
    chosen = rows if num_samples is None else head_in_order(rows, num_samples)
    return train_test_split(chosen, seed=seed)


@dataclass(frozen=True)
class Scaling:
    """Fitted bounds: of scalar features, and of the matrices' columns."""

    scalars: DataFrame
    entries: DataFrame


_MATRICES = {"concept_idx": "concept_level", "level4_idx": "level4_proficiency"}


def fit_scaling(split: DataFrame, fit_on: str = FIT_EACH) -> Scaling:
    """Bounds of every feature per split; those of the matrices, read twice, written out."""
    return Scaling(
        scalar_bounds(split, SCALAR_FEATURES, fit_on),
        durable(entry_bounds(split, _MATRICES, fit_on)),
    )


def scaled_vectors(
    split: DataFrame,
    concepts: int,
    level4_groups: int,
    fit_on: str = FIT_EACH,
    include_level4: bool = True,
    scaling: Scaling | None = None,
) -> DataFrame:
    """Min-max scaled rows with their concept and level4 blocks.

    ``scaling`` holds bounds fitted before; by default the rows' own are taken.
    """
    scaling = scaling or fit_scaling(split, fit_on)
    scaled = scale_scalars(split, SCALAR_FEATURES, bounds=scaling.scalars)
    widths = {"concept_idx": (concepts, CONCEPT_BLOCK)}
    if include_level4:
        widths["level4_idx"] = (level4_groups, LEVEL4_BLOCK)
    implicit = implicit_values(scaling.entries)
    for index, (width, name) in widths.items():
        value = _MATRICES[index]
        scaled = scale_entries(scaled, scaling.entries, index, value, width)
        shifts = [cell[1:] for cell in implicit if cell[0] == index]
        if shifts:
            scaled = shifted_block(scaled, index, value, width, name, shifts)
        else:
            scaled = sparse_block(scaled, index, value, width, name)
    return scaled


def labelled_vectors(
    stage: FeatureStage,
    num_samples: int | None = None,
    drop_incomplete: bool = False,
    seed: int = SPLIT_SEED,
    fit_on: str = FIT_EACH,
    include_level4: bool = True,
    keep_scaling: Callable[[Scaling], None] | None = None,
) -> DataFrame:
    """The data set of a training run: key, blocks, scalars, label, is_train.

    Features are computed once; splitting and scaling read the durable copy.
    ``keep_scaling`` gets the fitted bounds, for instance to store them.
    """
    rows = durable(training_rows(stage, drop_incomplete))
    split = split_rows(rows, num_samples, seed)
    scaling = fit_scaling(split, fit_on)
    if keep_scaling:
        keep_scaling(scaling)
    vectors = scaled_vectors(
        split,
        stage.dimensions.concepts,
        stage.dimensions.level4_groups,
        fit_on,
        include_level4,
        scaling,
    )
    return vectors.withColumn("label", F.col("is_correct").cast("double"))


def node_memory_mb(spark: SparkSession) -> int:
    """MB of node statistics that a task may hold while a tree grows.

    Every task has its own, as plain objects that Spark can neither count nor
    spill. Cached rows fill the memory that it does manage once there are enough
    of them, so all tasks of an executor together get half of the rest.
    """
    context = spark.sparkContext
    conf, size = context.getConf(), context._jvm.org.apache.spark.network.util.JavaUtils
    if context.master.split("[")[0] == "local":
        heap = context._jvm.java.lang.Runtime.getRuntime().maxMemory() // 2**20
    else:
        heap = size.byteStringAsMb(conf.get("spark.executor.memory", "1g"))
    # The driver is listed too, and is the only one in a local session.
    executors = max(context._jsc.sc().getExecutorMemoryStatus().size() - 1, 1)
    tasks = math.ceil(context.defaultParallelism / executors)
    # 300 MB are Spark's own.
    rest = (heap - 300) * (1 - float(conf.get("spark.memory.fraction", "0.6")))
    return max(1, min(NODE_MEMORY_MB, int(rest / 2 / tasks)))


def classifier(
    model_type: str,
    train_rows: int,
    boosting_stages: int = 100,
    node_memory: int = NODE_MEMORY_MB,
) -> Estimator:
    """An unfitted classifier.

    Logistic penalties are given as an inverse strength of 1 on the summed
    loss; Spark averages the loss, hence 1 / ``train_rows``. A tree grows in
    passes over as many nodes as fit ``node_memory``, which does not change it.
    """
    if model_type == "DecisionTreeClassifier":
        # 30 is the deepest tree Spark grows. Rows that remember their node need
        # not be sent the tree in every pass.
        return DecisionTreeClassifier(
            impurity="entropy",
            maxDepth=30,
            maxBins=64,
            seed=0,
            maxMemoryInMB=node_memory,
            cacheNodeIds=True,
        )
    if model_type == "GradientBoostingClassifier":
        return GBTClassifier(maxIter=boosting_stages, stepSize=0.1, maxDepth=3, seed=0)
    if model_type in ("LogisticRegression_L2", "LogisticRegression_L1"):
        return LogisticRegression(
            maxIter=1000,
            regParam=1.0 / train_rows,
            elasticNetParam=1.0 if model_type.endswith("L1") else 0.0,
            standardization=False,
        )
    if model_type == LINEAR_SVM:
        return LinearSVC(maxIter=1000, regParam=1.0 / train_rows, standardization=False)
    raise ValueError(f"Unsupported model_type: {model_type}")


def shares_right(scored: DataFrame) -> DataFrame:
    """(is_train, score): the share of rows whose ``prediction`` is their ``label``."""
    hit = (F.col("prediction") == F.col("label")).cast("double")
    return scored.groupBy("is_train").agg(F.avg(hit).alias("score"))


def accuracies(model: Model, data: DataFrame) -> dict[str, float | None]:
    """Share of right predictions on train and test rows, from one pass."""
    found = {row["is_train"]: row["score"] for row in shares_right(model.transform(data)).collect()}
    return {"train_score": found.get(True), "test_score": found.get(False)}


INTERCEPT = -1


def linear_rows(spark: SparkSession, model: Model) -> DataFrame:
    """A fitted linear model as rows (feature_idx, weight), the intercept at -1.

    Any SQL engine can apply it to stored feature entries.
    """
    cells = [(i, float(w)) for i, w in enumerate(model.coefficients.toArray()) if w]
    return spark.createDataFrame(
        [(INTERCEPT, float(model.intercept)), *cells], "feature_idx int, weight double"
    )


def apply_linear(entries: DataFrame, key: Sequence[str], model: DataFrame, size: int) -> DataFrame:
    """(key, margin, prediction) of feature entries by a linear model in rows.

    ``entries`` are (key, feature_idx, value) with at least one entry per row,
    and the model has at most ``size`` rows. Margins are summed on the map side.
    """
    intercept = model.filter(F.col("feature_idx") == INTERCEPT).agg(F.sum("weight")).scalar()
    weights = bounded_broadcast(model.filter(F.col("feature_idx") != INTERCEPT), size)
    summed = (
        entries.join(weights, "feature_idx", "left")
        .groupBy(*key)
        .agg(F.sum(F.col("value") * F.coalesce("weight", F.lit(0.0))).alias("margin"))
    )
    margin = F.col("margin") + F.coalesce(intercept, F.lit(0.0))
    return summed.withColumn("margin", margin).withColumn(
        "prediction", (F.col("margin") > 0).cast("double")
    )


def train_and_score(
    data: DataFrame, model_type: str, boosting_stages: int = 100, train_rows: int | None = None
) -> tuple[Model, dict[str, float | None]]:
    """Fit one model on rows with ``features``, ``label``, ``is_train``.

    ``train_rows`` is the number of training rows where it is known.
    """
    train = data.filter("is_train")
    rows = train.count() if train_rows is None else train_rows
    memory = node_memory_mb(data.sparkSession)
    model = classifier(model_type, max(rows, 1), boosting_stages, memory).fit(train)
    return model, accuracies(model, data)


def train_all(
    vectors: DataFrame,
    model_types: Sequence[str] = MODEL_TYPES,
    boosting_stages: int = 100,
    include_level4: bool = True,
    model_root: str | None = None,
) -> DataFrame:
    """Fit every model type; one row of scores each.

    With ``model_root``, each fitted model is saved below it together with the
    assembler, so that it can score blocks-and-scalars rows later.
    """
    assembler = feature_assembler(include_level4)
    data = (
        assembler.transform(vectors)
        .select("features", "label", "is_train")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        rows = []
        train_rows = data.filter("is_train").count()
        for model_type in model_types:
            model, scores = train_and_score(data, model_type, boosting_stages, train_rows)
            if model_root:
                save_model(PipelineModel([assembler, model]), model_root, model_type)
            rows.append((model_type, scores["train_score"], scores["test_score"]))
    finally:
        data.unpersist()
    return vectors.sparkSession.createDataFrame(rows, SCORE_SCHEMA)


def save_model(model: PipelineModel, root: str, model_type: str) -> None:
    """Persist a fitted pipeline, one folder per model type."""
    model.write().overwrite().save(f"{root.rstrip('/')}/{model_type}")


def load_model(root: str, model_type: str) -> PipelineModel:
    """Load a fitted pipeline."""
    return PipelineModel.load(f"{root.rstrip('/')}/{model_type}")


def score_activity(model: PipelineModel, vectors: DataFrame) -> DataFrame:
    """Predict the label of scaled rows with blocks."""
    keep = [*row_key(vectors), "prediction"]
    return model.transform(vectors).select(*keep)


def benchmark_rows(log: DataFrame, user: DataFrame, content: DataFrame) -> DataFrame:
    """Log ⋈ user ⋈ content without rows holding any null, benchmark columns."""
    joined = log_user_content(log, user, content).dropna(how="any")
    return joined.select(*row_key(joined), *BENCHMARK_COLUMNS)


def fit_benchmark(
    rows: DataFrame, features: Sequence[str], seed: int = SPLIT_SEED
) -> tuple[PipelineModel, float | None]:
    """Logistic regression on the named numeric columns; returns test accuracy."""
    numbers = rows.select(
        *row_key(rows),
        F.col("is_correct").cast("double").alias("label"),
        *[F.col(name).cast("double").alias(name) for name in features],
    )
    split = train_test_split(durable(numbers), seed=seed)
    scaled = scale_scalars(split, features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train = scaled.filter("is_train")
        logistic = LogisticRegression(
            maxIter=100, regParam=1.0 / max(train.count(), 1), standardization=False
        )
        assembler = VectorAssembler(inputCols=list(features), outputCol="features")
        model = Pipeline(stages=[assembler, logistic]).fit(train)
        return model, accuracies(model, scaled)["test_score"]
    finally:
        scaled.unpersist()


def train_benchmark(
    log: DataFrame, user: DataFrame, content: DataFrame, seed: int = SPLIT_SEED
) -> tuple[PipelineModel, float | None]:
    """The benchmark model: ten features, categories coded in sorted order."""
    domains = {"gender": user, "difficulty": content, "learning_stage": content}
    rows = with_category_codes(benchmark_rows(log, user, content), domains)
    return fit_benchmark(rows, BENCHMARK_COLUMNS[1:], seed)


def explore_rows(log: DataFrame, user: DataFrame, content: DataFrame) -> DataFrame:
    """Log ⋈ user ⋈ content in fixed codes, null-free, exploratory columns."""
    joined = with_fixed_codes(log_user_content(log, user, content)).dropna(how="any")
    return joined.select(*row_key(joined), *EXPLORE_COLUMNS)


def train_benchmark_fixed_codes(
    log: DataFrame, user: DataFrame, content: DataFrame, seed: int = SPLIT_SEED
) -> tuple[PipelineModel, float | None]:
    """The exploratory benchmark: eight features, from difficulty onwards."""
    features = EXPLORE_COLUMNS[EXPLORE_COLUMNS.index("difficulty") :]
    return fit_benchmark(explore_rows(log, user, content), features, seed)
