"""Metrics and validation loops: A16, A17, M9-M11, M16-M18.

Metrics are single aggregates over (y, yhat).  Directional accuracy needs the
previous row in a total order: positions come from ``splits.with_positions`` and the
previous row is an equi-join on position, so no global sort lands in one task.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.operators import splits as sp


def regression_metrics(df: DataFrame, y: str = "y", yhat: str = "prediction", ts: str = "date",
                       keys: Sequence[str] = ("symbol",), group: Sequence[str] = ()) -> DataFrame:
    """Rmse, mae, r2, mape (x/0 skipped), directional accuracy x100 over successive pairs.

    Successive pairs follow the total (ts, keys) order; with ``group`` (e.g. a
    fold column) a pair counts when both rows belong to the same group.
    """
    e = F.col(y) - F.col(yhat)
    m = df.groupBy(*group).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(F.lit(1)))).alias("r2"),
        (F.avg(F.abs(F.try_divide(e, F.col(y)))) * 100).alias("mape"))
    d, _ = sp.with_positions(df, ts, keys)
    prev = d.select(*group, (F.col(sp.POS) + 1).alias(sp.POS), F.col(y).alias("_py"), F.col(yhat).alias("_pp"))
    pairs = d.join(prev, [*group, sp.POS], "inner")
    same = F.signum(F.col(y) - F.col("_py")) == F.signum(F.col(yhat) - F.col("_pp"))
    da = pairs.groupBy(*group).agg((F.lit(100.0) * F.count_if(same) / F.count(F.lit(1))).alias("directional_accuracy"))
    if group:
        out = m.join(da, list(group), "left")
    else:  # two one-row aggregates: the second is fetched as a scalar
        r = da.first()
        out = m.withColumn("directional_accuracy", F.lit(float(r[0]) if r and r[0] is not None else 0.0))
    return out.select(*group, "rmse", "mae", "r2", "mape",
                      F.coalesce("directional_accuracy", F.lit(0.0)).alias("directional_accuracy"))


def classification_metrics(df: DataFrame, label: str = "label", pred: str = "prediction",
                           group: Sequence[str] = ()) -> DataFrame:
    """Accuracy and support-weighted precision / recall / F1 (zero division -> 0)."""
    conf = df.groupBy(*group, F.col(label).alias("_l"), F.col(pred).alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    tp = conf.where(F.col("_l") == F.col("_p")).select(*group, F.col("_l").alias("_k"), F.col("_c").alias("_tp"))
    sup = conf.groupBy(*group, F.col("_l").alias("_k")).agg(F.sum("_c").alias("_sup"))
    prd = conf.groupBy(*group, F.col("_p").alias("_k")).agg(F.sum("_c").alias("_np"))
    per = sup.join(prd, [*group, "_k"], "full").join(tp, [*group, "_k"], "left").fillna(0, ["_tp", "_sup", "_np"])
    prec = F.when(F.col("_np") > 0, F.col("_tp") / F.col("_np")).otherwise(F.lit(0.0))
    rec = F.when(F.col("_sup") > 0, F.col("_tp") / F.col("_sup")).otherwise(F.lit(0.0))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    per = per.withColumns({"_prec": prec, "_rec": rec, "_f1": f1})
    return per.groupBy(*group).agg(
        (F.sum("_tp") / F.sum("_sup")).alias("accuracy"),
        (F.sum(F.col("_prec") * F.col("_sup")) / F.sum("_sup")).alias("precision"),
        (F.sum(F.col("_rec") * F.col("_sup")) / F.sum("_sup")).alias("recall"),
        (F.sum(F.col("_f1") * F.col("_sup")) / F.sum("_sup")).alias("f1"))


def per_class_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """A17 per-class precision / recall / F1 / support."""
    conf = df.groupBy(F.col(label).alias("_l"), F.col(pred).alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    tp = conf.where(F.col("_l") == F.col("_p")).select(F.col("_l").alias("cls"), F.col("_c").alias("tp"))
    sup = conf.groupBy(F.col("_l").alias("cls")).agg(F.sum("_c").alias("support"))
    prd = conf.groupBy(F.col("_p").alias("cls")).agg(F.sum("_c").alias("predicted"))
    per = sup.join(prd, "cls", "full").join(tp, "cls", "left").fillna(0, ["tp", "support", "predicted"])
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    return per.select("cls", prec.alias("precision"), rec.alias("recall"),
                      F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0)).alias("f1"),
                      "support")


# ---------------------------------------------------------------- validation loops
def _fold_predictions(df: DataFrame, fit_predict, n_splits: int, test_size: int | None, gap: int, ts: str,
                      keys: Sequence[str]) -> DataFrame:
    """Predictions of every expanding fold with its id: each fold is two ranges of positions, rows are not copied."""
    d, n = sp.with_positions(df, ts, keys)
    preds = None
    for i, first, train_end, start, end in sp.fold_bounds(n, n_splits, test_size, gap):
        pos = F.col(sp.POS)
        train = d.where((pos >= first) & (pos < train_end)).drop(sp.POS)
        test = d.where((pos >= start) & (pos < end)).drop(sp.POS).withColumn("fold", F.lit(i))
        p = fit_predict(train, test)
        preds = p if preds is None else preds.unionByName(p)
    return preds


def time_series_cv(df: DataFrame, fit_predict: Callable[[DataFrame, DataFrame], DataFrame], y: str = "y",
                   n_splits: int = 5, ts: str = "date", keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """M9: expanding folds (K5); one fit per fold; mean and population std of rmse / mae / r2.

    ``fit_predict(train, test)`` returns ``test`` with a ``prediction`` column.
    """
    allp = _fold_predictions(df, fit_predict, n_splits, None, 0, ts, keys)
    e = F.col(y) - F.col("prediction")
    per = allp.groupBy("fold").agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                                   (F.lit(1.0) - F.sum(e * e) / (F.var_pop(y) * F.count(F.lit(1)))).alias("r2"))
    return per.agg(*[x for m in ("rmse", "mae", "r2") for x in (F.avg(m).alias(f"cv_{m}_mean"),
                                                                  F.stddev_pop(m).alias(f"cv_{m}_std"))])


def walk_forward(df: DataFrame, fit_predict: Callable[[DataFrame, DataFrame], DataFrame], y: str = "y",
                 n_splits: int = 5, test_size: int = 30, gap: int = 0, ts: str = "date",
                 keys: Sequence[str] = ("symbol",)) -> tuple[DataFrame, DataFrame]:
    """Per-fold fits on expanding windows; returns (predictions with ``fold``, per-fold metrics)."""
    preds = _fold_predictions(df, fit_predict, n_splits, test_size, gap, ts, keys)
    e = F.col(y) - F.col("prediction")
    met = preds.groupBy("fold").agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                                    F.count(F.lit(1)).alias("n"))
    return preds, met


def expanding_backtest(df: DataFrame, fit_predict: Callable[[DataFrame, DataFrame], DataFrame],
                       initial_train_size: int = 100, retrain_frequency: int = 20, ts: str = "date",
                       keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Refit every ``retrain_frequency`` rows from ``initial_train_size``; each block of rows
    [i, i + freq) is scored by the model fitted on [0, i) - the same predictions as one-row steps."""
    d, n = sp.with_positions(df, ts, keys)
    out = None
    for start in range(initial_train_size, n, retrain_frequency):
        tr = d.where(F.col(sp.POS) < start).drop(sp.POS)
        te = d.where((F.col(sp.POS) >= start) & (F.col(sp.POS) < start + retrain_frequency))
        p = fit_predict(tr, te)
        out = p if out is None else out.unionByName(p)
    return out


# ---------------------------------------------------------------- importance, champion, card
def feature_importance(model, features: Sequence[str], spark) -> DataFrame:
    """``featureImportances`` (or |coefficients|) as (feature, importance), sorted."""
    stage = model.stages[-1] if hasattr(model, "stages") else model
    if hasattr(stage, "featureImportances"):
        vals = stage.featureImportances.toArray().tolist()
    elif hasattr(stage, "coefficients"):
        vals = [abs(v) for v in stage.coefficients.toArray().tolist()]
    else:
        raise ValueError("model has no importances")
    df = spark.createDataFrame(list(zip(features, [float(v) for v in vals])), "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature")


def mean_importance(tables: Sequence[DataFrame]) -> DataFrame:
    """M16 ensemble: mean importance per feature over the tree models."""
    u = tables[0]
    for t in tables[1:]:
        u = u.unionByName(t)
    return u.groupBy("feature").agg(F.avg("importance").alias("importance")).orderBy(F.desc("importance"), "feature")


def champion(metrics: DataFrame, by: str = "rmse") -> str:
    """Lowest test rmse (DAG rule) or highest r2 (script rule)."""
    pick = F.min_by("model", by) if by in ("rmse", "mae", "mape") else F.max_by("model", by)
    return metrics.agg(pick.alias("m")).first()["m"]


def model_card(metrics: DataFrame, importance: DataFrame, n_train: int, n_test: int, champion_name: str,
               limitations: Sequence[str] = ("Synthetic or historical data; past performance does not imply "
                                             "future results.",)) -> str:
    """Metrics, top 10 features, counts and limitations as one JSON document."""
    card = {"champion": champion_name,
            "metrics": [r.asDict() for r in metrics.collect()],
            "top_features": [r.asDict() for r in importance.limit(10).collect()],
            "n_train": n_train, "n_test": n_test, "limitations": list(limitations)}
    return json.dumps(card, default=str, allow_nan=False if all(
        not (isinstance(v, float) and math.isnan(v)) for m in card["metrics"] for v in m.values()) else True)


def expanding_ridge_backtest(df: DataFrame, features: Sequence[str], y: str = "y", alpha: float = 1.0,
                             initial_train_size: int = 100, retrain_frequency: int = 20, ts: str = "date",
                             keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """M11 for ridge, exactly, without a fit per refit.

    Rows are numbered in (ts, keys) order; rows from ``initial_train_size`` on are cut into scoring blocks of
    ``retrain_frequency`` rows. One grouped aggregate gives each block's moments; the model for block b is the ridge
    solution on the sum of the earlier blocks. Sums are running sums over the block table in two levels
    (inside runs of ``RUN`` blocks, then over the runs' totals), the small systems are solved in Arrow batches of blocks,
    and coefficients meet their rows by a join: nothing per block comes to the driver.
    """
    from marketlens.operators import ensembles as en

    feats = list(features)
    d, _ = sp.with_positions(df, ts, keys)
    blk = F.when(F.col(sp.POS) < initial_train_size, F.lit(-1)).otherwise(
        F.floor((F.col(sp.POS) - initial_train_size) / retrain_frequency)).cast("long")
    d = d.withColumn("_blk", blk)
    known = d.dropna(subset=[*feats, y])
    shift = en.moment_shift(known, feats, y)
    sums = en._moment_columns(feats, y, shift)
    # blocks without a complete row still need a model: an empty moment row for each
    m = d.select("_blk").distinct().join(known.groupBy("_blk").agg(*sums), "_blk", "left").fillna(0)
    names = [c for c in m.columns if c != "_blk"]
    m = m.withColumn("_run", F.floor(F.col("_blk") / RUN))
    inside = Window.partitionBy("_run").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    totals = m.groupBy("_run").agg(*[F.sum(c).alias(f"_t_{c}") for c in names])
    ahead = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)  # a row for each RUN blocks
    totals = totals.select("_run", *[F.sum(f"_t_{c}").over(ahead).alias(f"_t_{c}") for c in names])
    before = m.join(totals, "_run").select("_blk", *[
        (F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.coalesce(F.col(f"_t_{c}"), F.lit(0))).alias(c) for c in names])
    p = len(feats)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.to_dict("records"):
                if r["n"] > 0:
                    w, b = en.unshifted(*en._ridge_solve(en.moments_of(r, p), alpha), feats, y, shift)
                    rows.append((r["_blk"], float(b), [float(v) for v in w]))
            yield pd.DataFrame(rows, columns=["_blk", "_b0", "_w"])

    coef = before.where("_blk >= 0").mapInPandas(solve, "_blk long, _b0 double, _w array<double>")
    out = d.where(F.col("_blk") >= 0).join(coef, "_blk", "inner")
    pred = F.col("_b0")
    for i, f in enumerate(feats):
        pred = pred + F.col(f) * F.col("_w")[i]
    return out.withColumn("prediction", pred).withColumn("refit", F.col("_blk").cast("int")).drop("_b0", "_w", "_blk", sp.POS)


#: Blocks summed inside one run.
RUN = 4096
