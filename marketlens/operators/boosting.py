"""M1 early stopping with patience: all prefixes of a boosted ensemble scored in one pass over the validation rows.

A boosted ensemble's prediction after round r is the weighted sum of its first r trees, so one pass that adds the trees one
by one gives every round's error: each task returns one row a round, whatever the number of rows. The ensemble is
then cut after the best round, which is the last one to improve before ``patience`` rounds went by without a gain.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)")


class Trees:
    """Regression trees as arrays: feature and threshold of each node, its two children, its value (feature -1: a leaf)."""

    def __init__(self, text: str, weights: Sequence[float]):
        self.weights, self.trees = list(weights), []
        lines = [x.strip() for x in text.splitlines()]
        starts = [i for i, x in enumerate(lines) if x.startswith("Tree ")] + [len(lines)]
        for a, b in zip(starts, starts[1:]):
            nodes: list[list] = []
            self._node(iter(x for x in lines[a + 1:b] if x), nodes)
            self.trees.append(tuple(np.array(c, k) for c, k in zip(zip(*nodes), (int, float, int, int, float))))
        if len(self.trees) != len(self.weights):
            raise ValueError("the ensemble's text and its weights differ in length")

    @classmethod
    def of(cls, model) -> Trees:
        return cls(model.toDebugString, model.treeWeights)

    def _node(self, lines: Iterator[str], nodes: list) -> int:
        line, at = next(lines), len(nodes)
        nodes.append([-1, 0.0, 0, 0, 0.0])
        if line.startswith("Predict:"):
            nodes[at][4] = float(line.split(":")[1])
            return at
        split = _SPLIT.fullmatch(line)
        if not split:
            raise ValueError(f"only splits of numbers are read, not {line}")
        nodes[at][:2] = [int(split[1]), float(split[2])]
        nodes[at][2] = self._node(lines, nodes)
        next(lines)  # Else
        nodes[at][3] = self._node(lines, nodes)
        return at

    def stages(self, x: np.ndarray) -> Iterator[np.ndarray]:
        """The prediction for the rows of ``x`` after each round. A missing number goes right, as Spark sends it."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for (feature, threshold, left, right, value), w in zip(self.trees, self.weights):
            node = np.zeros(len(x), int)
            inner = feature[node] >= 0
            while inner.any():
                go = x[rows, feature[node]] <= threshold[node]
                node = np.where(inner, np.where(go, left[node], right[node]), node)
                inner = feature[node] >= 0
            total = total + w * value[node]
            yield total


def staged_errors(model: GBTRegressionModel, df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """round (from 1), mse, n: the squared error of every prefix of the ensemble, in one pass. Rows without a label do not count."""
    trees = Trees.of(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sse, n = np.zeros(len(trees.trees)), 0
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]
            x, y = np.column_stack(cols[:-1]), cols[-1]
            n += len(y)
            for i, p in enumerate(trees.stages(x)):
                sse[i] += ((y - p) ** 2).sum()
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(1, len(sse) + 1)), pa.array(sse), pa.array(np.full(len(sse), n))], names=["round", "sse", "n"])

    d = df.select(*[F.col(c).cast("double") for c in features], F.col(label).cast("double").alias("_label")).filter("_label IS NOT NULL")
    parts = d.mapInArrow(run, "round long, sse double, n long")
    return parts.groupBy("round").agg((F.sum("sse") / F.sum("n")).alias("mse"), F.sum("n").alias("n"))


def stopping_round(errors: Sequence[float], patience: int) -> int:
    """The best round (from 1) when training stops: the first of the least errors before ``patience`` rounds brought no gain."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def truncated(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The ensemble of the first ``rounds`` trees."""
    sc = model._sc if hasattr(model, "_sc") else None
    if sc is None:
        from pyspark.sql import SparkSession
        sc = SparkSession.getActiveSession().sparkContext
    java, gateway = model._java_obj, sc._gateway
    trees, weights = java.trees(), java.treeWeights()
    cls = sc._jvm.org.apache.spark.ml.regression
    some = gateway.new_array(cls.DecisionTreeRegressionModel, rounds)
    w = gateway.new_array(gateway.jvm.double, rounds)
    for i in range(rounds):
        some[i], w[i] = trees[i], float(weights[i])
    out = GBTRegressionModel(cls.GBTRegressionModel(f"{model.uid}_{rounds}", some, w, java.numFeatures()))
    return out.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())


def fit_with_patience(pipeline, train: DataFrame, validation: DataFrame, features: Sequence[str], label: str,
                      patience: int = 20) -> tuple[PipelineModel, DataFrame, int]:
    """(the pipeline's model cut after its best round, the error of every round, that round).

    pipeline: an assembler and a boosted regressor, as ``models.boosted_regressor`` builds it.
    """
    model = pipeline.fit(train)
    boosted = model.stages[-1]
    errors = staged_errors(boosted, validation, features, label)
    rows = sorted((r["round"], r["mse"]) for r in errors.collect())  # a row for each round
    # without validation rows nothing tells the rounds apart: all stay
    best = stopping_round([e for _, e in rows], patience) if rows else boosted.getNumTrees
    return PipelineModel([*model.stages[:-1], truncated(boosted, best)]), errors, best
