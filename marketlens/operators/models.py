"""Supervised models M1-M4 on ``pyspark.ml`` and model persistence S15.

Every model is a ``Pipeline(VectorAssembler, estimator)``; fitting is
distributed by Spark ML (tree learners aggregate split statistics per
partition; linear models use normal equations / L-BFGS over partition sums).
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = "features"

# The two boosted-tree presets of the reference (rounds, depth, rate, row/column sampling).
BOOSTED_PRESETS = {
    "xgboost": {"maxIter": 200, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8,
                "featureSubsetStrategy": "0.8"},
    "lightgbm": {"maxIter": 200, "maxDepth": 8, "stepSize": 0.05, "subsamplingRate": 0.8,
                 "featureSubsetStrategy": "0.8"},
}


#: Rows of a partition of a training frame: each level of each tree is a job with a task for each partition.
ROWS_A_TASK = 50_000


def sized(df: DataFrame, rows: int = ROWS_A_TASK) -> DataFrame:
    """A training frame written down once, in no more partitions than its rows need."""
    from marketlens.session import cut_lineage
    d = cut_lineage(df)
    return cut_lineage(d.coalesce(max(1, -(-d.count() // rows)))) if d.rdd.getNumPartitions() > 1 else d


def fit_all(jobs: dict, parallelism: int = 8) -> dict:
    """{name: (estimator, training frame)} -> {name: model}; that many fits run at a time, so their small jobs fill each other's gaps."""
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()

    def fit(job):
        return job[0].fit(job[1])

    pool = ThreadPool(max(1, min(parallelism, len(jobs))))
    try:
        return dict(zip(jobs, pool.map(inheritable_thread_target(spark)(fit), list(jobs.values()), chunksize=1)))
    finally:
        pool.close()


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="keep")


def boosted_regressor(features: Sequence[str], label: str = "y", preset: str = "xgboost", seed: int = 42,
                      validation_col: str | None = None, **overrides) -> Pipeline:
    """M1: gradient-boosted trees; ``validation_col`` enables Spark's own early stopping on a validation flag.

    That one stops when the validation error improves by less than ``validationTol``; ``boosting.fit_with_patience``
    waits a number of rounds instead. No L1/L2 leaf penalties, depth-wise growth only.
    """
    params = dict(BOOSTED_PRESETS[preset], **overrides)
    gbt = GBTRegressor(featuresCol=FEATURES, labelCol=label, seed=seed, **params)
    if validation_col:
        gbt.setValidationIndicatorCol(validation_col)
    return Pipeline(stages=[_assembler(features), gbt])


def forest_regressor(features: Sequence[str], label: str = "y", num_trees: int = 200, max_depth: int = 10,
                     min_leaf: int = 2, seed: int = 42) -> Pipeline:
    """M2: random forest, sqrt feature subsampling."""
    rf = RandomForestRegressor(featuresCol=FEATURES, labelCol=label, numTrees=num_trees, maxDepth=max_depth,
                               minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt", seed=seed)
    return Pipeline(stages=[_assembler(features), rf])


# The classifier defaults of the reference (boosted trees; forest).
BOOSTED_CLASSIFIER = {"maxIter": 200, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
FOREST_CLASSIFIER = {"numTrees": 200, "maxDepth": 10, "minInstancesPerNode": 2}


def forest_classifier(features: Sequence[str], label: str, seed: int = 42, **params) -> Pipeline:
    """M3: random forest on numeric class labels 0, 1, ..."""
    return Pipeline(stages=[_assembler(features), RandomForestClassifier(featuresCol=FEATURES, labelCol=label, seed=seed, **{**FOREST_CLASSIFIER, **params})])


def direction_classifier(features: Sequence[str], label: str = "label", kind: str = "forest",
                         num_classes: int = 2, seed: int = 42, string_labels: bool = False, **params) -> Pipeline:
    """M3: up/down (binary) or Up/Down/Neutral (string labels indexed) classifiers.

    Boosted trees are binary in Spark: of more classes, each has an ensemble against the rest, and the surest one wins.
    """
    stages = [_assembler(features)]
    lab = label
    if string_labels:
        stages.append(StringIndexer(inputCol=label, outputCol="_label_idx", stringOrderType="alphabetAsc", handleInvalid="keep"))
        lab = "_label_idx"
    if kind == "forest":
        est = RandomForestClassifier(featuresCol=FEATURES, labelCol=lab, seed=seed, **{**FOREST_CLASSIFIER, **params})
    else:
        gbt = GBTClassifier(featuresCol=FEATURES, labelCol=lab, seed=seed, **{**BOOSTED_CLASSIFIER, **params})
        est = gbt if num_classes == 2 else OneVsRest(classifier=gbt, featuresCol=FEATURES, labelCol=lab, parallelism=num_classes)
    stages.append(est)
    return Pipeline(stages=stages)


def ridge(features: Sequence[str], label: str = "y", alpha: float = 1.0, n: int | None = None,
          y_std: float | None = None) -> Pipeline:
    """M4: sklearn-style ridge (sum of squares + alpha * ||w||^2, intercept unpenalised).

    Spark's objective is 1/(2n) * sum of squares + regParam/2 * ||w||^2 with the
    label scaled by its population std, so regParam = alpha / n * std(y).
    """
    if n is None or y_std is None:
        raise ValueError("ridge needs the training row count n and the label's population std")
    lr = LinearRegression(featuresCol=FEATURES, labelCol=label, solver="normal", standardization=False,
                          elasticNetParam=0.0, regParam=alpha / n * y_std, fitIntercept=True)
    return Pipeline(stages=[_assembler(features), lr])


def fit_ridge(df: DataFrame, features: Sequence[str], label: str = "y", alpha: float = 1.0) -> PipelineModel:
    st = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("s")).first()
    return ridge(features, label, alpha, int(st["n"]), float(st["s"] or 1.0)).fit(df)


def save_model(model: PipelineModel, path: str, metadata: dict) -> None:
    """Spark ML writer plus a one-row metadata JSON next to it."""
    from pyspark.sql import SparkSession
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(metadata, default=str),)], "metadata string") \
        .coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load_model(spark, path: str) -> tuple[PipelineModel, dict]:
    """Load the pipeline and its metadata."""
    meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    return PipelineModel.load(f"{path}/model"), meta
