"""Time-ordered split, random forest, cross-validation and metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from straitflow.config import MODEL_INPUTS

# The forest and the grid that is searched.
NUM_TREES, MAX_DEPTH, SEED = 100, 8, 42
GRID_TREES, GRID_DEPTHS, FOLDS = (50, 100), (5, 8), 3

# Trading days that a label looks ahead.
LABEL_HORIZON = 5

# Partitions of training rows; part of what makes a seeded forest repeatable.
PARTITIONS = 4


def assembler(inputs: Sequence[str] = MODEL_INPUTS) -> VectorAssembler:
    return VectorAssembler(inputCols=list(inputs), outputCol="features", handleInvalid="skip")


def assembled_rows(features: DataFrame, inputs: Sequence[str] = MODEL_INPUTS) -> DataFrame:
    """The assembled vector as an array column ``vector``; rows with a null input are skipped."""
    rows = assembler(inputs).transform(features)
    return rows.select("event_date", "chokepoint", vector_to_array("features").alias("vector"))


def time_split(
    features: DataFrame,
    train: float = 0.6,
    validation: float = 0.2,
    embargo_days: int = 0,
) -> DataFrame:
    """Adds ``split``: train, validation and test follow each other in time.

    The two cut dates are fractions of the covered days, rounded down, and are computed
    inside the plan. ``embargo_days`` removes the last days before each cut, whose
    labels look across it.
    """
    ends = features.agg(F.struct(F.min("event_date").alias("mn"), F.max("event_date").alias("mx")))
    day = F.col("event_date")

    def cut(share: float):
        days = F.date_diff(F.col("_ends.mx"), F.col("_ends.mn"))
        return F.date_add(F.col("_ends.mn"), F.floor(days * F.lit(share)).cast("int"))

    out = (
        features.withColumn("_ends", ends.scalar())
        .withColumn("_cut1", cut(train))
        .withColumn("_cut2", cut(train + validation))
        .withColumn(
            "split",
            F.when(day < F.col("_cut1"), "train")
            .when(day < F.col("_cut2"), "validation")
            .otherwise("test"),
        )
    )
    if embargo_days:
        for c in ("_cut1", "_cut2"):
            out = out.filter(~((day < F.col(c)) & (day >= F.date_sub(F.col(c), embargo_days))))
    return out.drop("_ends", "_cut1", "_cut2")


def forest(num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol="label",
        featuresCol="features",
        numTrees=num_trees,
        maxDepth=max_depth,
        seed=SEED,
    )


def stable_rows(rows: DataFrame, partitions: int = PARTITIONS) -> DataFrame:
    """Fixed placement and order, on which the sampling of a seeded forest depends.

    A feature table has one row per day and box; with many boxes, take more partitions, and
    the same number whenever a forest is to be repeated.
    """
    return rows.repartition(partitions, "event_date", "chokepoint").sortWithinPartitions(
        "event_date", "chokepoint"
    )


def f1_evaluator() -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(
        labelCol="label", predictionCol="prediction", metricName="f1"
    )


def with_time_folds(train: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Adds ``fold``: contiguous blocks of days of equal length, never interleaved."""
    ends = train.agg(F.struct(F.min("event_date").alias("mn"), F.max("event_date").alias("mx")))
    span = F.date_diff(F.col("_ends.mx"), F.col("_ends.mn")) + 1
    position = F.date_diff(F.col("event_date"), F.col("_ends.mn"))
    return (
        train.withColumn("_ends", ends.scalar())
        .withColumn("fold", F.floor(position * folds / span).cast("int"))
        .drop("_ends")
    )


def walk_forward_folds(rows: DataFrame, folds: int = FOLDS, purge_rows: int = LABEL_HORIZON) -> DataFrame:
    """The rows of each of some folds, with ``fold`` (from 1) and ``role``: train or validation.

    The days that have rows are cut into folds + 1 blocks of equal number. Fold k is validated on block k + 1 and trained on
    all blocks before it, without the last ``purge_rows`` days ahead of it: their labels look that many
    rows on, into the days that they would be judged by. So no row is trained on that is later than one it is judged by.
    """
    days = rows.select("event_date").where("event_date IS NOT NULL").distinct()
    # One row per calendar day: bounded, though in one task.
    position = F.row_number().over(Window.orderBy("event_date")) - 1
    numbered = days.withColumn("_day", position)
    total = numbered.agg(F.count("*").alias("n")).scalar()
    numbered = numbered.withColumn("_days", total)
    fold = F.explode(F.sequence(F.lit(1), F.lit(folds)))
    start, stop = (F.floor(F.col("_days") * (F.col("fold") + i) / (folds + 1)) for i in (0, 1))
    roles = (
        numbered.withColumn("fold", fold)
        .withColumn(
            "role",
            F.when((F.col("_day") >= start) & (F.col("_day") < stop), "validation").when(
                F.col("_day") < start - purge_rows, "train"
            ),
        )
        .filter("role IS NOT NULL")
        .select("event_date", "fold", "role")
    )
    return rows.join(roles, "event_date")


def walk_forward_scores(
    spark: SparkSession,
    train: DataFrame,
    inputs: Sequence[str] = MODEL_INPUTS,
    trees: Sequence[int] = GRID_TREES,
    depths: Sequence[int] = GRID_DEPTHS,
    folds: int = FOLDS,
    purge_rows: int = LABEL_HORIZON,
    partitions: int = PARTITIONS,
) -> DataFrame:
    """num_trees, max_depth, fold, train_rows, validation_rows, f1, accuracy: every grid point in every fold.

    A fold without training or validation rows is an error.
    """
    members = walk_forward_folds(train, folds, purge_rows).persist()
    out = []
    try:
        for fold in range(1, folds + 1):
            own = members.filter(F.col("fold") == fold).drop("fold")
            earlier, later = (own.filter(F.col("role") == role).drop("role") for role in ("train", "validation"))
            n_train, n_later = earlier.count(), later.count()
            if not n_train or not n_later:
                raise ValueError(f"fold {fold} has {n_train} rows to train on and {n_later} to judge by")
            for n_trees in trees:
                for depth in depths:
                    model = fit_forest(earlier, inputs, n_trees, depth, partitions)
                    score = metrics(model.transform(later)).first()
                    out.append((n_trees, depth, fold, n_train, n_later, float(score["f1"]), float(score["accuracy"])))
    finally:
        members.unpersist()
    return spark.createDataFrame(
        out, "num_trees int, max_depth int, fold int, train_rows long, validation_rows long, f1 double, accuracy double"
    )


def train_walk_forward(
    spark: SparkSession, train: DataFrame, inputs: Sequence[str] = MODEL_INPUTS, **options
) -> tuple[PipelineModel, DataFrame]:
    """The grid point with the best mean F1 over folds that walk forward, fitted on all rows; and the scores."""
    scores = walk_forward_scores(spark, train, inputs, **options)
    best = (
        scores.groupBy("num_trees", "max_depth")
        .agg(F.avg("f1").alias("f1"))
        .orderBy(F.col("f1").desc(), "num_trees", "max_depth")
        .first()
    )
    partitions = options.get("partitions", PARTITIONS)
    return fit_forest(train, inputs, best["num_trees"], best["max_depth"], partitions), scores


def cross_validate(
    train: DataFrame,
    inputs: Sequence[str] = MODEL_INPUTS,
    trees: Sequence[int] = GRID_TREES,
    depths: Sequence[int] = GRID_DEPTHS,
    time_folds: bool = False,
    parallelism: int = 4,
    partitions: int = PARTITIONS,
) -> CrossValidatorModel:
    """A forest per grid point and fold; fewer rows than folds are an error."""
    if train.limit(FOLDS).count() < FOLDS:
        raise ValueError(f"{FOLDS} folds need as many rows; fit without cross-validation instead")
    rf = forest()
    grid = (
        ParamGridBuilder()
        .addGrid(rf.numTrees, list(trees))
        .addGrid(rf.maxDepth, list(depths))
        .build()
    )
    cv = CrossValidator(
        estimator=Pipeline(stages=[assembler(inputs), rf]),
        estimatorParamMaps=grid,
        evaluator=f1_evaluator(),
        numFolds=FOLDS,
        seed=SEED,
        parallelism=parallelism,
    )
    if time_folds:
        train = with_time_folds(train)
        cv = cv.setFoldCol("fold")
    return cv.fit(stable_rows(train, partitions))


def fit_forest(
    train: DataFrame,
    inputs: Sequence[str] = MODEL_INPUTS,
    num_trees: int = NUM_TREES,
    max_depth: int = MAX_DEPTH,
    partitions: int = PARTITIONS,
) -> PipelineModel:
    stages = [assembler(inputs), forest(num_trees, max_depth)]
    # A copy has no training summary: that of two classes holds the session, which can't be sent to tasks once it has observed a frame.
    return Pipeline(stages=stages).fit(stable_rows(train, partitions)).copy()


def train_best(
    train: DataFrame, inputs: Sequence[str] = MODEL_INPUTS, search: bool = True, **grid
) -> PipelineModel:
    """The winner of the cross-validated grid, or with ``search=False`` a direct fit."""
    return cross_validate(train, inputs, **grid).bestModel if search else fit_forest(train, inputs)


def grid_scores(spark: SparkSession, fitted: CrossValidatorModel) -> DataFrame:
    """Mean F1 of each grid point."""
    rows = []
    for params, score in zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics):
        by_name = {p.name: v for p, v in params.items()}
        rows.append((int(by_name["numTrees"]), int(by_name["maxDepth"]), float(score)))
    return spark.createDataFrame(rows, "num_trees int, max_depth int, mean_f1 double")


def importances(
    spark: SparkSession, model: PipelineModel, inputs: Sequence[str] = MODEL_INPUTS
) -> DataFrame:
    """Inputs by falling importance."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(inputs, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )


def confusion_matrix(predictions: DataFrame, *by: str) -> DataFrame:
    return (
        predictions.groupBy(*by, "label", F.col("prediction").cast("int").alias("prediction"))
        .agg(F.count("*").alias("row_count"))
        .orderBy(*by, "label", "prediction")
    )


def metrics(predictions: DataFrame, *by: str) -> DataFrame:
    """Rows, accuracy and weighted F1, as aggregates over the confusion matrix.

    Per class F1 is 2*hits / (actual + predicted), weighted by the actual rows.
    """
    cells = predictions.groupBy(
        *by, F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")
    ).agg(F.count("*").alias("n"))
    # Each cell counts once for its actual and once for its predicted class.
    classes = (
        cells.select(
            *by,
            F.explode(
                F.array(
                    F.struct(
                        F.col("label").alias("class"),
                        F.col("n").alias("actual"),
                        F.lit(0).cast("long").alias("predicted"),
                        F.when(F.col("label") == F.col("prediction"), F.col("n"))
                        .otherwise(0)
                        .alias("hits"),
                    ),
                    F.struct(
                        F.col("prediction").alias("class"),
                        F.lit(0).cast("long").alias("actual"),
                        F.col("n").alias("predicted"),
                        F.lit(0).cast("long").alias("hits"),
                    ),
                )
            ).alias("c"),
        )
        .groupBy(*by, "c.class")
        .agg(
            F.sum("c.actual").alias("actual"),
            F.sum("c.predicted").alias("predicted"),
            F.sum("c.hits").alias("hits"),
        )
    )
    f1 = 2.0 * F.col("hits") / (F.col("actual") + F.col("predicted"))
    return classes.groupBy(*by).agg(
        F.sum("actual").alias("row_count"),
        (F.sum("hits").cast("double") / F.sum("actual")).alias("accuracy"),
        (F.sum(f1 * F.col("actual")) / F.sum("actual")).alias("f1"),
    )


def momentum_rule(features: DataFrame, band: float = 0.05) -> DataFrame:
    """A fixed predictor to compare a model with: the last 5-row return repeats itself."""
    r = F.col("return_5d")
    rule = F.when(r > band, F.lit(2.0)).when(r < -band, F.lit(0.0)).otherwise(F.lit(1.0))
    return features.withColumn("prediction", rule)


def ablation(
    split: DataFrame,
    subsets: Mapping[str, Sequence[str]],
    num_trees: int = NUM_TREES,
    max_depth: int = MAX_DEPTH,
) -> DataFrame:
    """Metrics of a forest trained on each subset of the inputs, on validation and test rows."""
    train = split.filter(F.col("split") == "train")
    held_out = split.filter(F.col("split") != "train")
    parts = [
        metrics(fit_forest(train, inputs, num_trees, max_depth).transform(held_out), "split").withColumn(
            "inputs", F.lit(name)
        )
        for name, inputs in subsets.items()
    ]
    return reduce(DataFrame.unionByName, parts)
