"""K-means clusters on z-scored (population std) features with best-of-n starts."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators.models import fit_all


def standardize_array(df: DataFrame, col: str, out: str = "_z") -> DataFrame:
    """Per-dimension (x - mean) / population std of an array column (ddof 0, as the reference).

    ``ml.StandardScaler`` uses the sample std, so the scaling is done with one
    aggregate of per-dimension moments and an array ``transform``.
    """
    dim = len(df.select(col).first()[0])
    st = df.agg(*[x for i in range(dim) for x in (F.avg(F.col(col)[i]).alias(f"m{i}"),
                                                   F.stddev_pop(F.col(col)[i]).alias(f"s{i}"))]).first()
    means = F.array(*[F.lit(float(st[f"m{i}"])) for i in range(dim)])
    stds = F.array(*[F.lit(float(st[f"s{i}"]) if st[f"s{i}"] else 1.0) for i in range(dim)])
    z = F.transform(F.col(col), lambda x, i: (x.cast("double") - F.element_at(means, i + 1)) / F.element_at(stds, i + 1))
    return df.withColumn(out, array_to_vector(z))


def kmeans_clusters(df: DataFrame, col: str, k: int = 5, max_iter: int = 300, n_init: int = 10,
                    seed: int = 42, tol: float = 1e-4) -> tuple[DataFrame, dict]:
    """Best of ``n_init`` seeded runs by training cost (inertia); silhouette on all rows.

    The runs go side by side over one cached frame, which is given back at the end. ``tol`` 0 runs to the fixed point.

    Spark's evaluator reports the silhouette with squared Euclidean distance
    (named accordingly); it runs in O(n * k), so no sample is needed.
    """
    d = standardize_array(df, col).persist()
    try:
        models = fit_all({i: (KMeans(k=k, maxIter=max_iter, tol=tol, seed=seed + i, featuresCol="_z", predictionCol="cluster"), d)
                          for i in range(n_init)})
        cost, i = min((m.summary.trainingCost, i) for i, m in models.items())
        pred = models[i].transform(d)
        sil = ClusteringEvaluator(featuresCol="_z", predictionCol="cluster", metricName="silhouette",
                                  distanceMeasure="squaredEuclidean").evaluate(pred)
    finally:
        d.unpersist()
    return pred.drop("_z"), {"inertia": cost, "silhouette_squared_euclidean": sil, "k": k}


def cluster_sizes(pred: DataFrame) -> DataFrame:
    return pred.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))

