"""Ensembles M5-M8 over ``pyspark.ml`` pipelines.

Base models are fitted by Spark ML; the ensemble logic (folds, out-of-fold
predictions, the ridge meta-learner, averaging) is DataFrame plumbing: fold ids
come from positions, and predictions are columns that a chain of transforms adds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators import models as md
from marketlens.operators import splits as sp
from marketlens.session import cut_lineage

BaseFactory = Callable[[Sequence[str], str], Pipeline]
META_ALPHAS = (0.01, 0.1, 1.0, 10.0, 100.0)
BLEND_ALPHAS = (0.01, 0.1, 1.0, 10.0)


def default_bases(seed: int = 42, light: bool = False) -> dict[str, BaseFactory]:
    """Boosted trees in two presets, forest and ridge, 100 trees or rounds each; ``light`` shrinks them for tests."""
    n = 10 if light else 100
    return {
        "gradient_boosting": lambda f, y: md.boosted_regressor(f, y, "xgboost", seed=seed, maxIter=n, maxDepth=3 if light else 6,
                                                               stepSize=0.1),
        "lightgbm_preset": lambda f, y: md.boosted_regressor(f, y, "lightgbm", seed=seed, maxIter=n, maxDepth=3 if light else 6,
                                                             stepSize=0.1),
        "random_forest": lambda f, y: md.forest_regressor(f, y, num_trees=n, max_depth=4 if light else 10, seed=seed),
        "ridge": lambda f, y: Ridge(f, y, 1.0),
    }


def _with_prediction(model, df: DataFrame, name: str) -> DataFrame:
    """``df`` with the model's prediction as ``name``: a chain of transforms, no join back."""
    return model.transform(df).select(*df.columns, F.col("prediction").alias(name))


def _with_predictions(models: dict, df: DataFrame) -> DataFrame:
    for name, model in models.items():
        df = _with_prediction(model, df, name)
    return df


def _moment_columns(cols: Sequence[str], y: str, shift: dict[str, float]) -> list:
    """Count, sums and cross products (upper triangle) of the columns less ``shift``, which keeps them from cancelling."""
    xs = [F.col(c) - F.lit(shift[c]) for c in cols]
    t = F.col(y) - F.lit(shift[y])
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(t).alias("sy"), F.sum(t * t).alias("syy")]
    aggs += [F.sum(x).alias(f"sx{i}") for i, x in enumerate(xs)]
    aggs += [F.sum(x * t).alias(f"sxy{i}") for i, x in enumerate(xs)]
    aggs += [F.sum(xs[i] * xs[j]).alias(f"sxx{i}_{j}") for i in range(len(xs)) for j in range(i, len(xs))]
    return aggs


def moment_shift(df: DataFrame, cols: Sequence[str], y: str) -> dict[str, float]:
    """The columns' means: what moments are taken around."""
    row = df.agg(*[F.avg(c).alias(c) for c in [*cols, y]]).first()
    return {c: float(row[c] or 0.0) for c in [*cols, y]}


def moments_of(r, p: int) -> tuple:
    """Moments of a row of ``_moment_columns``."""
    return (float(r["n"]), float(r["sy"]), float(r["syy"]), np.array([r[f"sx{i}"] for i in range(p)], float),
            np.array([r[f"sxy{i}"] for i in range(p)], float),
            np.array([[r[f"sxx{min(i, j)}_{max(i, j)}"] for j in range(p)] for i in range(p)], float))


def fold_moments(df: DataFrame, cols: Sequence[str], y: str, fold: str = "fold") -> tuple[dict, dict]:
    """(per-fold moments around the means, the means) in one grouped aggregate; one row for each fold comes back."""
    shift = moment_shift(df, cols, y)
    rows = df.groupBy(fold).agg(*_moment_columns(cols, y, shift)).collect()
    return {r[fold]: moments_of(r, len(cols)) for r in rows}, shift


def _add(moments) -> tuple:
    return tuple(sum(x[1:], x[0]) for x in zip(*moments))


def _ridge_solve(m, alpha: float):
    """sklearn ridge (intercept unpenalised) from moments: (w, b) in the moments' own coordinates."""
    n, sy, _, sx, sxy, sxx = m
    xbar, ybar = sx / n, sy / n
    cxx = sxx - n * np.outer(xbar, xbar)
    cxy = sxy - n * xbar * ybar
    w = np.linalg.solve(cxx + alpha * np.eye(len(sx)), cxy)
    return w, ybar - xbar @ w


def unshifted(w, b: float, cols: Sequence[str], y: str, shift: dict[str, float]) -> tuple:
    """Coefficients for the columns themselves."""
    return w, b + shift[y] - float(w @ np.array([shift[c] for c in cols]))


def ridge_from_moments(df: DataFrame, cols: Sequence[str], y: str, alpha: float) -> MomentRidge:
    """Ridge of all rows from one aggregate."""
    moments, shift = fold_moments(df.withColumn("_one", F.lit(0)), cols, y, "_one")
    return MomentRidge(cols, *unshifted(*_ridge_solve(moments[0], alpha), cols, y, shift))


def _sse(m, w, b) -> float:
    n, sy, syy, sx, sxy, sxx = m
    return float(syy - 2 * b * sy - 2 * w @ sxy + n * b * b + 2 * b * w @ sx + w @ sxx @ w)


def _meta_cv(moments: dict, alphas=META_ALPHAS) -> float:
    """Pick the ridge alpha by k-fold CV computed exactly from per-fold moments."""
    best = None
    for a in alphas:
        sse = 0.0
        for f, mf in moments.items():
            w, b = _ridge_solve(_add([m for g, m in moments.items() if g != f]), a)
            sse += _sse(mf, w, b)
        if best is None or sse < best[1]:
            best = (a, sse)
    return best[0]


class MomentRidge:
    """Fitted ridge meta-learner applied as a column expression."""

    def __init__(self, cols, w, b):
        self.cols, self.w, self.b = list(cols), w, b

    def transform(self, df: DataFrame) -> DataFrame:
        e = F.lit(float(self.b))
        for c, wi in zip(self.cols, self.w):
            e = e + F.col(c) * F.lit(float(wi))
        return df.withColumn("prediction", e)


class Ridge:
    """Ridge as a base learner: one aggregate, whatever the number of rows. Rows with a missing value are not learned from."""

    def __init__(self, features: Sequence[str], y: str, alpha: float = 1.0):
        self.features, self.y, self.alpha = list(features), y, alpha

    def fit(self, df: DataFrame) -> MomentRidge:
        return ridge_from_moments(df.dropna(subset=[*self.features, self.y]), self.features, self.y, self.alpha)


class Expression:
    """A base model that is a column expression: nothing to fit."""

    def __init__(self, column: str):
        self.column = column

    def fit(self, df: DataFrame) -> "Expression":
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", F.expr(self.column))


def _ridge_cv(df: DataFrame, names: Sequence[str], y: str, alphas) -> tuple[MomentRidge, float]:
    """Ridge over base predictions; alpha by cross-validation over the column ``fold``, exactly, from one aggregate."""
    moments, shift = fold_moments(df, names, y)
    alpha = _meta_cv(moments, alphas)
    return MomentRidge(names, *unshifted(*_ridge_solve(_add(list(moments.values())), alpha), names, y, shift)), alpha


class Stacking:
    """M5: out-of-fold base predictions (contiguous, unshuffled folds) -> ridge-CV meta-learner.

    ``time_aware=True`` uses expanding folds (K5) instead, so a base model never
    sees rows after the ones it predicts.
    """

    def __init__(self, features: Sequence[str], y: str = "y", key: str = "_row", bases=None, k: int = 5,
                 time_aware: bool = False, alphas=META_ALPHAS, parallelism: int = 8):
        self.features, self.y, self.key, self.k, self.parallelism = list(features), y, key, k, parallelism
        self.bases = bases or default_bases()
        self.time_aware, self.alphas = time_aware, alphas

    def fit(self, df: DataFrame) -> "Stacking":
        """All folds' fits and the final ones run side by side."""
        d = md.sized(sp.contiguous_folds(df, self.k, ts=self.key, keys=[]))
        folds = range(1 if self.time_aware else 0, self.k)
        jobs = {}
        for f in folds:
            tr = md.sized(d.where(F.col("fold") < f) if self.time_aware else d.where(F.col("fold") != f))
            jobs |= {(f, n): (make(self.features, self.y), tr) for n, make in self.bases.items()}
        jobs |= {(None, n): (make(self.features, self.y), d) for n, make in self.bases.items()}
        fitted = md.fit_all(jobs, self.parallelism)
        oof = None
        for f in folds:
            preds = _with_predictions({n: fitted[f, n] for n in self.bases}, d.where(F.col("fold") == f))
            oof = preds if oof is None else oof.unionByName(preds)
        self.oof_ = cut_lineage(oof)
        self.meta_, self.alpha_ = _ridge_cv(self.oof_, list(self.bases), self.y, self.alphas)
        self.models_ = {n: fitted[None, n] for n in self.bases}
        return self

    def base_scores(self, n_splits: int = 5, df: DataFrame | None = None) -> DataFrame:
        """M9 per base model: mean and population std of the rmse over expanding folds (K5)."""
        return base_model_scores(df, self.features, self.y, self.key, self.bases, n_splits, self.parallelism)

    def base_predictions(self, df: DataFrame) -> DataFrame:
        return _with_predictions(self.models_, df)

    def predict(self, df: DataFrame) -> DataFrame:
        return self.meta_.transform(self.base_predictions(df))


def base_model_scores(df: DataFrame, features: Sequence[str], y: str = "y", key: str = "_row", bases=None, n_splits: int = 5,
                      parallelism: int = 8) -> DataFrame:
    """M9: model, mean_rmse, std_rmse (population) of each base model over expanding folds; all fits run side by side."""
    bases = bases or default_bases()
    d, n = sp.with_positions(df, key, [])
    d, pos = md.sized(d), F.col(sp.POS)
    bounds = sp.fold_bounds(n, n_splits)
    trains = {i: md.sized(d.where((pos >= first) & (pos < end))) for i, first, end, _, _ in bounds}
    fitted = md.fit_all({(i, m): (make(features, y), trains[i]) for i in trains for m, make in bases.items()}, parallelism)
    errors = None
    for i, _, _, start, end in bounds:
        test = _with_predictions({m: fitted[i, m] for m in bases}, d.where((pos >= start) & (pos < end)))
        e = test.select(F.lit(i).alias("fold"), F.explode(F.create_map(*[x for m in bases for x in (F.lit(m), F.col(y) - F.col(m))])).alias("model", "e"))
        errors = e if errors is None else errors.unionByName(e)
    per = errors.groupBy("model", "fold").agg(F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"))
    return per.groupBy("model").agg(F.avg("rmse").alias("mean_rmse"), F.stddev_pop("rmse").alias("std_rmse"))


class Voting:
    """M6: (weighted) mean of the base predictions."""

    def __init__(self, features, y="y", key="_row", bases=None, weights: dict | None = None, parallelism: int = 8):
        self.features, self.y, self.key, self.parallelism = list(features), y, key, parallelism
        self.bases = bases or default_bases()
        self.weights = weights

    def fit(self, df: DataFrame) -> "Voting":
        d = md.sized(df)
        self.models_ = md.fit_all({n: (make(self.features, self.y), d) for n, make in self.bases.items()}, self.parallelism)
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        out = _with_predictions(self.models_, df)
        w = self.weights or {n: 1.0 for n in self.models_}
        tot = sum(w.values())
        return out.withColumn("prediction", sum(F.col(n) * F.lit(w[n]) for n in self.models_) / F.lit(tot))


class Blending:
    """M7: bases on the first 80 % of rows, ridge meta-learner on the last 20 % (alpha by cross-validation there)."""

    def __init__(self, features, y="y", key="_row", bases=None, holdout: float = 0.2, alphas=BLEND_ALPHAS, k: int = 5,
                 parallelism: int = 8):
        self.features, self.y, self.key, self.parallelism = list(features), y, key, parallelism
        self.bases = bases or default_bases()
        self.holdout, self.alphas, self.k = holdout, alphas, k

    def fit(self, df: DataFrame) -> "Blending":
        d, n = sp.with_positions(df, self.key, [])
        cut = int(n * (1 - self.holdout))
        tr, ho = md.sized(d.where(F.col(sp.POS) < cut)), d.where(F.col(sp.POS) >= cut)
        self.models_ = md.fit_all({n: (make(self.features, self.y), tr) for n, make in self.bases.items()}, self.parallelism)
        size = max(1, -(-(n - cut) // self.k))
        hp = _with_predictions(self.models_, ho).withColumn("fold", F.floor((F.col(sp.POS) - cut) / size).cast("int"))
        self.meta_, self.alpha_ = _ridge_cv(hp, list(self.models_), self.y, self.alphas)
        return self

    def predict(self, df: DataFrame) -> DataFrame:
        return self.meta_.transform(_with_predictions(self.models_, df))


def create_ensemble(kind: str = "stacking", **kw):
    """M8: factory by name."""
    kinds = {"stacking": Stacking, "voting": Voting, "blending": Blending}
    if kind not in kinds:
        raise ValueError(f"no ensemble {kind}; there are {sorted(kinds)}")
    return kinds[kind](**kw)
