"""Feature selection F1-F7.

F1 has two estimators. The nearest-neighbour one (``knn_mi``) is exact at any size. The binned one is cheaper:
both variables are cut into equal-frequency bins (boundaries from one quantile aggregate), all features
are unpivoted into one long (feature, x_bin, y_bin) frame, and one grouped
count gives every contingency table at once; it shares rankings, not values, with the other.  F2 runs its correlations in Spark (A11) and
only the p x p greedy step on the driver; F4/F5 are driver loops over Spark
ML fits.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators import clean as cl
from marketlens.operators import corr as co
from marketlens.operators import ensembles as en
from marketlens.operators import splits as sp
from marketlens.operators.quantiles import exact_quantiles

N_BINS = 10


def _bin_expr(x: str, bounds: list[float]):
    """Bin index = number of boundaries strictly below x (0..len(bounds))."""
    arr = F.array(*[F.lit(float(b)) for b in bounds])
    return F.size(F.filter(arr, lambda b: b < F.col(x)))


def quantile_bounds(df: DataFrame, cols: Sequence[str], n_bins: int = N_BINS, exact: bool = True) -> dict:
    probs = [i / n_bins for i in range(1, n_bins)]
    if exact:
        row = exact_quantiles(df, cols, probs).first()
        return {c: sorted({row[f"q_{c}_{j}"] for j in range(len(probs))} - {None}) for c in cols}
    row = df.agg(*[F.percentile_approx(c, probs, 10000).alias(c) for c in cols]).first()
    return {c: sorted(set(row[c] or [])) for c in cols}


def mutual_information(df: DataFrame, features: Sequence[str], target: str, task: str = "regression",
                       n_bins: int = N_BINS) -> DataFrame:
    """F1 (binned): MI(feature; target) in nats for every feature, one grouped count."""
    d = cl.median_impute(df, [*features, target] if task == "regression" else list(features))
    bounds = quantile_bounds(d, [*features, target] if task == "regression" else list(features), n_bins)
    yb = _bin_expr(target, bounds[target]) if task == "regression" else F.col(target).cast("string")
    stack = ", ".join(f"'{f}', CAST(_b_{i} AS INT)" for i, f in enumerate(features))
    binned = d.select(yb.cast("string").alias("_yb"),
                      *[_bin_expr(f, bounds[f]).alias(f"_b_{i}") for i, f in enumerate(features)])
    long = binned.selectExpr("_yb", f"stack({len(features)}, {stack}) AS (feature, _xb)")
    joint = long.groupBy("feature", "_xb", "_yb").agg(F.count(F.lit(1)).alias("_nxy"))
    from pyspark.sql import Window
    wf = Window.partitionBy("feature")
    j = joint.withColumns({"_n": F.sum("_nxy").over(wf),
                           "_nx": F.sum("_nxy").over(Window.partitionBy("feature", "_xb")),
                           "_ny": F.sum("_nxy").over(Window.partitionBy("feature", "_yb"))})
    term = F.col("_nxy") / F.col("_n") * F.log(F.col("_nxy") * F.col("_n") / (F.col("_nx") * F.col("_ny")))
    return j.groupBy("feature").agg(F.sum(term).alias("score"))


def _rank(scores: DataFrame, n: int) -> list[str]:
    return [r["feature"] for r in scores.orderBy(F.desc("score"), "feature").limit(n).collect()]


def select_mutual_info(df, features, target, n_features=20, task="regression", estimator: str = "binned", order: str = "date"):
    """F1 selection: top n by mutual information, ``binned`` or by nearest neighbours (``knn``)."""
    if estimator == "knn":
        from marketlens.operators.knn_mi import knn_mutual_information
        scores = knn_mutual_information(df, features, target, task, order=order)
    else:
        scores = mutual_information(df, features, target, task)
    return _rank(scores, n_features), scores


def select_correlation(df, features, target, n_features=20, threshold=0.95):
    """drop inter-correlated groups keeping the most target-correlated, then top n by |r(target)|."""
    strength = {r["feature"]: abs(r["correlation"] or 0.0) for r in co.target_correlations(df, features, target).collect()}
    place = {f: i for i, f in enumerate(features)}
    # feature -> the earlier features it moves with; both tables have at most one row for each pair of feature columns
    twins: dict[str, list[str]] = {}
    for r in co.feature_correlations(df, features).collect():
        if abs(r["correlation"] or 0.0) > threshold:
            first, second = sorted((r["feature1"], r["feature2"]), key=place.get)
            if first != second and first not in twins.get(second, ()):
                twins.setdefault(second, []).append(first)
    # of a feature and its twins all but the strongest (the earliest, if equal) are redundant
    redundant = {f for late, early in twins.items()
                 for f in sorted([late, *early], key=lambda c: (-strength.get(c, 0.0), place[c]))[1:]}
    kept = [f for f in features if f not in redundant]
    spark = df.sparkSession
    scores = spark.createDataFrame([(f, float(strength.get(f, 0.0))) for f in kept], "feature string, score double")
    return _rank(scores, n_features), scores


def select_variance(df, features, target, n_features=20, threshold=0.01, task="regression"):
    """z-score, drop columns whose variance is <= threshold (the constant ones), then F1."""
    st = df.agg(*[F.stddev_samp(f).alias(f) for f in features]).first()
    kept = [f for f in features if st[f] is not None and st[f] > 0]
    return select_mutual_info(df, kept, target, n_features, task)


def _lasso(m: tuple, alpha: float, w: np.ndarray) -> tuple[np.ndarray, float]:
    """Coordinate descent for 1/(2n) * squared error + alpha * |w| from moments, started at ``w``; returns (w, intercept)."""
    n, sy, _, sx, sxy, sxx = m
    gram, cross = sxx / n - np.outer(sx, sx) / n ** 2, sxy / n - sx * sy / n ** 2
    w = w.copy()
    for _ in range(1000):
        moved = 0.0
        for j in range(len(w)):
            if gram[j, j] <= 0:
                continue
            r = cross[j] - gram[j] @ w + gram[j, j] * w[j]
            new = np.sign(r) * max(abs(r) - alpha, 0.0) / gram[j, j]
            moved = max(moved, abs(new - w[j]))
            w[j] = new
        if moved <= 1e-10 * (np.abs(w).max() + 1e-300):
            break
    return w, (sy - sx @ w) / n


def select_lasso(df, features, target, n_features=20, n_alphas: int = 100, eps: float = 1e-3, k: int = 5,
                 order: str = "date"):
    """median-impute, z-score (ddof 1), k-fold CV over an alpha path, keep non-zero coefficients ranked by size.

    The path starts at the least alpha that leaves no coefficient and falls to ``eps`` of it, so it follows the
    scale of the target. All fits of all folds use the folds' moments: one aggregate over the rows, whatever the number of alphas.
    """
    feats = list(features)
    d = cl.median_impute(df, [*feats, target])
    d = cl.zscore(d, feats, ddof=1).fillna(0.0, feats)  # a constant column is 0 everywhere
    d = sp.contiguous_folds(d, k, ts=order, keys=[c for c in ("symbol",) if c in d.columns])
    moments, _ = en.fold_moments(d, feats, target)
    total = en._add(list(moments.values()))
    n, sy, _, sx, sxy, _ = total
    top = float(np.abs(sxy / n - sx * sy / n ** 2).max())
    path = top * np.logspace(0, np.log10(eps), n_alphas) if top > 0 else np.zeros(1)
    error = np.zeros(len(path))
    for fold, own in moments.items():
        rest = en._add([m for f, m in moments.items() if f != fold])
        w = np.zeros(len(feats))
        for i, a in enumerate(path):
            w, b = _lasso(rest, a, w)
            error[i] += en._sse(own, w, b) / own[0]
    w = np.zeros(len(feats))
    for a in path[:int(error.argmin()) + 1]:
        w, _ = _lasso(total, a, w)
    scores = df.sparkSession.createDataFrame([(f, float(abs(c))) for f, c in zip(feats, w) if abs(c) > 0],
                                             "feature string, score double")
    return _rank(scores, n_features), scores


def _eliminated(jobs, features: list[str], least: int, step: int):
    """One elimination: yields (features, model) from all features down to ``least``; ``jobs(features)`` fits."""
    current = list(features)
    while True:
        model = jobs(current)
        yield current, model
        if len(current) <= least:
            return
        weight = model.stages[-1].featureImportances.toArray()
        weakest = sorted(range(len(current)), key=lambda i: weight[i])[:min(step, len(current) - least)]
        current = [c for i, c in enumerate(current) if i not in weakest]


def select_rfecv(df, features, target, min_features: int = 5, step: int = 1, k: int = 5,
                 num_trees: int = 50, max_depth: int = 5, seed: int = 42, order: str = "date", task: str = "regression"):
    """recursive elimination with k-fold CV (forest importances); returns the best subset and ranking.

    Each fold eliminates on its own training rows and scores every size on its test rows: by negative squared error, or, with
    ``task="classification"``, by accuracy over stratified folds (labels of any type; rows without one are left out). The size of the
    best mean score (the least such size) is then reached by an elimination on all rows. Folds run side by side.
    """
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target

    from marketlens.operators import models as md
    feats, classes = list(features), task == "classification"
    keys = [c for c in ("symbol",) if c in df.columns]
    least = min(min_features, len(feats))
    if classes:
        d = sp.stratified_folds(cl.median_impute(df, feats), target, k, order, keys)
        names = [r[0] for r in d.select(target).distinct().orderBy(target).collect()]  # the classes
        number = F.array_position(F.array(*[F.lit(n) for n in names]), F.col(target)) - 1
        d, label = d.withColumn("_class", number.cast("double")), "_class"
        score = F.avg((F.col("prediction") == F.col(label)).cast("double"))
    else:
        d, label = sp.contiguous_folds(cl.median_impute(df, [*feats, target]), k, order, keys), target
        score = -F.avg((F.col("prediction") - F.col(label)) ** 2)
    d = md.sized(d)

    def forest(cols, rows):
        if classes:
            return md.forest_classifier(cols, label, seed, numTrees=num_trees, maxDepth=max_depth, minInstancesPerNode=1).fit(rows)
        return md.forest_regressor(cols, label, num_trees, max_depth, 1, seed).fit(rows)

    def fold_scores(f: int) -> dict[int, float]:
        train, test = d.where(F.col("fold") != f), d.where(F.col("fold") == f)
        return {len(cols): float(m.transform(test).agg(score).first()[0] or 0.0)
                for cols, m in _eliminated(lambda c: forest(c, train), feats, least, step)}

    pool = ThreadPool(k)
    try:
        folds = pool.map(inheritable_thread_target(df.sparkSession)(fold_scores), range(k), chunksize=1)
    finally:
        pool.close()
    mean = {n: sum(f[n] for f in folds) / k for n in folds[0]}
    size = min(mean, key=lambda n: (-mean[n], n))
    chosen, dropped = feats, []
    for cols, _ in _eliminated(lambda c: forest(c, d), feats, size, step):
        dropped.append([c for c in chosen if c not in cols])
        chosen = cols
    ranking = {c: 1 for c in chosen}
    for i, gone in enumerate(reversed([x for x in dropped if x]), 2):
        ranking |= {c: i for c in gone}
    scores = df.sparkSession.createDataFrame([(f, float(-ranking[f])) for f in feats], "feature string, score double")
    return list(chosen), scores


def select_combined(df, features, target, n_features=20, correlation_threshold=0.95, task="regression"):
    """variance filter -> correlation filter -> mutual information."""
    st = df.agg(*[F.stddev_samp(f).alias(f) for f in features]).first()
    kept = [f for f in features if st[f] is not None and st[f] > 0]
    after_corr, _ = select_correlation(df, kept, target, len(kept), correlation_threshold)
    return select_mutual_info(df, after_corr, target, n_features, task)


def importance_table(scores: DataFrame, selected: Sequence[str]) -> DataFrame:
    """feature, importance, selected flag, sorted by importance."""
    sel = F.array(*[F.lit(s) for s in selected]) if selected else F.array().cast("array<string>")
    return scores.select("feature", F.col("score").alias("importance"),
                         F.array_contains(sel, F.col("feature")).alias("selected")) \
        .orderBy(F.desc("importance"), "feature")
