"""Decision tree and logistic regression: fit, cross-validate, report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from orderloom.ml.metrics import curves, rank_sum_area
from orderloom.ml.split import split_bucket
from orderloom.session import cut_lineage, shared_path

# The searched grid.
CV_DEPTHS = (2, 5)
CV_FOLDS = 2
CV_SEED = 121


def fit_tree(train: DataFrame, **params) -> DecisionTreeClassificationModel:
    return DecisionTreeClassifier(**params).fit(train)


def fit_logistic(train: DataFrame, **params) -> LogisticRegressionModel:
    return LogisticRegression(**params).fit(train)


def cross_validate_tree(
    train: DataFrame,
    depths: Sequence[int] = CV_DEPTHS,
    folds: int = CV_FOLDS,
    seed: int = CV_SEED,
    parallelism: int = 2,
    key: str = "order_id",
) -> CrossValidatorModel:
    """Choose the tree depth by area under ROC; the best is refitted on all rows.

    Folds go by a hash of the key, so they hold whole orders and are the same under any
    partitioning.
    """
    tree = DecisionTreeClassifier(seed=seed)
    return CrossValidator(
        estimator=tree,
        evaluator=BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0),
        estimatorParamMaps=ParamGridBuilder().addGrid(tree.maxDepth, list(depths)).build(),
        numFolds=folds,
        seed=seed,
        parallelism=parallelism,
        foldCol="fold",
        collectSubModels=True,
    ).fit(with_fold(train, folds, seed, key))


def with_fold(train: DataFrame, folds: int = CV_FOLDS, seed: int = CV_SEED, key: str = "order_id") -> DataFrame:
    return train.withColumn("fold", (split_bucket(F.col(key), seed) % folds).cast("int"))


def fold_predictions(fitted: CrossValidatorModel, train: DataFrame, key: str = "order_id") -> DataFrame:
    """(key, fold, max_depth, label, score) of every row by the models that did not see it, as a table.

    The score is what the folds were evaluated by: the positive rows of the leaf.
    """
    folds, seed = fitted.getNumFolds(), fitted.getSeed()
    folded = with_fold(train, folds, seed, key)
    parts = [
        model.transform(folded.where(F.col("fold") == fold)).select(
            key, "fold", F.lit(depth).alias("max_depth"), "label", vector_to_array("rawPrediction")[1].alias("score")
        )
        for fold, models in enumerate(fitted.subModels) for depth, model in zip(_depths(fitted), models)
    ]
    return cut_lineage(reduce(DataFrame.unionByName, parts))


def recomputed_averages(predictions: DataFrame, folds: int = CV_FOLDS) -> dict[int, float]:
    """Average area under ROC per depth, from stored predictions alone."""
    depths = sorted(r[0] for r in predictions.select("max_depth").distinct().collect())
    own = lambda depth, fold: predictions.where((F.col("max_depth") == depth) & (F.col("fold") == fold))
    return {depth: sum(rank_sum_area(own(depth, fold)) for fold in range(folds)) / folds for depth in depths}


def _depths(fitted: CrossValidatorModel) -> list[int]:
    return [next(value for param, value in grid.items() if param.name == "maxDepth") for grid in fitted.getEstimatorParamMaps()]


def cross_validation_report(fitted: CrossValidatorModel, spark: SparkSession) -> DataFrame:
    """(max_depth, average_auc, best) for every point of the grid."""
    points = _depths(fitted)
    best = max(fitted.avgMetrics)
    rows = [(depth, float(auc), bool(auc == best)) for depth, auc in zip(points, fitted.avgMetrics)]
    return spark.createDataFrame(rows, "max_depth int, average_auc double, best boolean")


def slot_names(df: DataFrame, features: str = "features") -> list[tuple[int, str]]:
    """(position, name) of the vector's slots, from the column's metadata."""
    attributes = df.schema[features].metadata["ml_attr"]["attrs"]
    return sorted((slot["idx"], slot["name"]) for group in attributes.values() for slot in group)


def feature_importance(
    model: DecisionTreeClassificationModel, train: DataFrame, top: int = 30
) -> DataFrame:
    """(idx, name, score) of the strongest features; equal scores by position."""
    weights = model.featureImportances
    rows = [(idx, name, float(weights[idx])) for idx, name in slot_names(train)]
    scored = train.sparkSession.createDataFrame(rows, "idx int, name string, score double")
    return scored.orderBy(F.desc("score"), "idx").limit(top)


def tree_splits(model: DecisionTreeClassificationModel, train: DataFrame) -> DataFrame:
    """(node, idx, name, threshold, gain, rows) of a fitted tree's inner nodes.

    Read from the stored model; threshold is null for a split by categories.
    """
    spark = train.sparkSession
    path = shared_path(spark, "tree")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "nodeData" in nodes.columns:
        nodes = nodes.select("nodeData.*")
    names = spark.createDataFrame(slot_names(train), "idx int, name string")
    rows = F.aggregate("impurityStats", F.lit(0.0), lambda acc, x: acc + x)
    return nodes.where("leftChild >= 0").select(
        F.col("id").alias("node"), F.col("split.featureIndex").alias("idx"),
        F.when(F.col("split.numCategories") < 0, F.element_at("split.leftCategoriesOrThreshold", 1)).alias("threshold"),
        "gain", rows.alias("rows"),
    ).join(F.broadcast(names), "idx")


def importance_of_splits(splits: DataFrame) -> DataFrame:
    """(idx, name, score): the gain of a slot's splits, weighted by their rows, as a share of all."""
    won = splits.groupBy("idx", "name").agg(F.sum(F.col("gain") * F.col("rows")).alias("won"))
    return won.select("idx", "name", F.try_divide("won", F.sum("won").over(Window.partitionBy())).alias("score"))


def score_equations(model: LogisticRegressionModel, train: DataFrame) -> DataFrame:
    """(idx, name, gradient): the derivative of the mean loss by each coefficient, in units of the slot's spread.

    One aggregate over all rows; without a penalty each is zero at the optimum. The
    intercept has idx -1.
    """
    scored = with_score(model, train).select((F.col("score") - F.col("label")).alias("miss"), vector_to_array("features").alias("x"))
    slots = scored.select("miss", F.posexplode(F.concat(F.array(F.lit(1.0)), "x")).alias("at", "value"))
    summed = slots.groupBy("at").agg(F.avg(F.col("miss") * F.col("value")).alias("slope"), F.stddev_pop("value").alias("spread"), F.max(F.abs("value")).alias("most"))
    named = train.sparkSession.createDataFrame([(-1, "intercept"), *slot_names(train)], "idx int, name string")
    spread = F.when(F.col("spread") > 1e-9 * F.col("most"), F.col("spread")).otherwise(1.0)  # a constant slot has none
    return summed.select((F.col("at") - 1).alias("idx"), (F.col("slope") / spread).alias("gradient")).join(F.broadcast(named), "idx").select("idx", "name", "gradient")


def logistic_report(model: LogisticRegressionModel, train: DataFrame) -> DataFrame:
    """(part, idx, name, value): intercept, coefficients and the loss of every iteration."""
    rows = [("intercept", 0, "", float(model.intercept))]
    rows += [
        ("coefficient", idx, name, float(model.coefficients[idx])) for idx, name in slot_names(train)
    ]
    rows += [
        ("objective", step, "", float(loss))
        for step, loss in enumerate(model.summary.objectiveHistory)
    ]
    return train.sparkSession.createDataFrame(rows, "part string, idx int, name string, value double")


def with_score(model: LogisticRegressionModel, rows: DataFrame) -> DataFrame:
    """Rows with the probability of the positive class as ``score``."""
    return model.transform(rows).withColumn("score", vector_to_array("probability")[1])


def logistic_curves(model: LogisticRegressionModel, rows: DataFrame) -> DataFrame:
    """(curve, threshold, x, y): the ROC and precision-recall points of some rows, none thinned out."""
    return curves(with_score(model, rows))


def training_summary(model: LogisticRegressionModel, spark: SparkSession) -> DataFrame:
    """(metric, value): accuracy and area under ROC on the training rows."""
    rows = [
        ("accuracy", float(model.summary.accuracy)),
        ("area_under_roc", float(model.summary.areaUnderROC)),
    ]
    return spark.createDataFrame(rows, "metric string, value double")
