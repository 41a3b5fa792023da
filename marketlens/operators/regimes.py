"""Market regimes: W26-W27, A12-A14, M14-M15.

Rule-based regimes and regime features are window expressions per key;
statistics and transition matrices are grouped aggregates; the mixture model
(``mixture``) is fitted on the pooled, z-scored features of all keys.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.panel import Panel, col, sdiv
from marketlens.operators.recurrence import _with_panel

_P = Panel()


def rule_regime(df: DataFrame, panel: Panel = _P, price: str = "close", fast: int = 20, slow: int = 50,
                vol_window: int = 20, out: str = "regime") -> DataFrame:
    """Bull if sma_fast > sma_slow and vol < 1.5 * mean50(vol); bear if below; else sideways."""
    p = panel

    def run(d, p):
        d = d.withColumn("_r", sdiv(col(price), p.lag(price)) - F.lit(1.0))
        d = d.withColumns({"_f": p.roll(F.avg, price, fast), "_s": p.roll(F.avg, price, slow),
                           "_v": p.roll(F.stddev_samp, "_r", vol_window)})
        d = d.withColumn("_vm", p.roll(F.avg, "_v", 50))
        calm = F.col("_v") < F.col("_vm") * 1.5
        reg = (F.when((F.col("_f") > F.col("_s")) & calm, F.lit("bull"))
               .when((F.col("_f") < F.col("_s")) & calm, F.lit("bear")).otherwise(F.lit("sideways")))
        return d.withColumn(out, reg).drop("_r", "_f", "_s", "_v", "_vm")
    return _with_panel(df, p, run)


REGIME_FEATURES = ["returns", "returns_lag1", "returns_lag2", "volatility", "volatility_change",
                   "momentum_5d", "momentum_20d"]


def regime_features(df: DataFrame, panel: Panel = _P, returns: str = "returns", volatility: str | None = None,
                    volume_ratio: str | None = None) -> DataFrame:
    """Returns, lags 1-2, volatility (given or std20), its pct change, 5/20 means; rows with NULL dropped."""
    p = panel

    def run(d, p):
        vol = col(volatility) if volatility else p.roll(F.stddev_samp, returns, 20)
        d = d.withColumns({"returns_lag1": p.lag(returns, 1), "returns_lag2": p.lag(returns, 2),
                           "volatility": vol})
        d = d.withColumns({"volatility_change": sdiv(F.col("volatility"), p.lag("volatility")) - F.lit(1.0),
                           "momentum_5d": p.roll(F.avg, returns, 5), "momentum_20d": p.roll(F.avg, returns, 20)})
        return d
    feats = REGIME_FEATURES[1:] + ([volume_ratio] if volume_ratio else [])
    out = _with_panel(df.withColumnRenamed(returns, "returns") if returns != "returns" else df, p, run)
    return out.dropna(subset=["returns", *feats])


def regime_statistics(df: DataFrame, regime: str = "regime", returns: str = "returns",
                      keys: Sequence[str] = ()) -> DataFrame:
    """Count, frequency %, mean/std/max/min return x100, Sharpe (0 when std <= 0)."""
    tot = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    g = df.groupBy(*keys, regime).agg(
        F.count(F.lit(1)).alias("count"), F.avg(returns).alias("_m"), F.stddev_samp(returns).alias("_s"),
        F.max(returns).alias("_mx"), F.min(returns).alias("_mn"))
    return g.select(
        *keys, regime, "count",
        (F.lit(100.0) * F.col("count") / F.sum("count").over(tot)).alias("frequency"),
        (F.col("_m") * 100).alias("mean_return"), (F.col("_s") * 100).alias("std_return"),
        F.when(F.col("_s") > 0, F.col("_m") / F.col("_s") * F.lit(math.sqrt(252))).otherwise(F.lit(0.0)).alias("sharpe"),
        (F.col("_mx") * 100).alias("max_return"), (F.col("_mn") * 100).alias("min_return"))


REGIME_LABELS = ["bear", "sideways", "bull"]


def transition_matrix(df: DataFrame, panel: Panel = _P, regime: str = "regime",
                      labels: Sequence[str] = REGIME_LABELS) -> DataFrame:
    """A13 per key: P(to | from) = transitions / (n_from - 1), the last occurrence of ``from`` dropped.

    Long rows (key, from_regime, to_regime, probability) for every observed
    ``from`` and every label in ``labels`` as ``to``; 0 where no transition
    happened (the fixed label list is exploded - no self-join).
    """
    keys = list(panel.keys)
    def follow(d, p):
        return d.withColumn("to_regime", p.lead(regime))
    d = panel.run(df, follow) if panel.sharded else follow(df, panel)
    d = d.select(*keys, F.col(panel.ts).alias("_t"), F.col(regime).alias("from_regime"), "to_regime")
    n_from = d.groupBy(*keys, "from_regime").agg(F.count(F.lit(1)).alias("_n"), F.max("_t").alias("_end"))
    trans = d.join(n_from.drop("_n"), [*keys, "from_regime"]).where(F.col("_t") < F.col("_end")).groupBy(*keys, "from_regime", "to_regime").agg(F.count(F.lit(1)).alias("_c"))
    grid = n_from.drop("_end").withColumn("to_regime", F.explode(F.array(*[F.lit(x) for x in labels])))
    out = grid.join(trans, [*keys, "from_regime", "to_regime"], "left")
    prob = F.when(F.col("_n") > 1, F.coalesce(F.col("_c"), F.lit(0)) / (F.col("_n") - 1)).otherwise(F.lit(0.0))
    return out.select(*keys, "from_regime", "to_regime", prob.alias("probability"))


def name_regimes(df: DataFrame, cluster: str = "cluster", returns: str = "returns", out: str = "regime") -> DataFrame:
    """Rank clusters by mean return: bear/sideways/bull (3), bear/bull (2), else regime_i."""
    means = df.groupBy(cluster).agg(F.avg(returns).alias("_m"))
    ranked = means.select(cluster, (F.row_number().over(Window.orderBy("_m", cluster)) - 1).alias("_rank"))
    n = ranked.count()                                 # number of clusters: tiny
    names = {3: ["bear", "sideways", "bull"], 2: ["bear", "bull"]}.get(n)
    name = F.concat(F.lit("regime_"), F.col("_rank").cast("string"))
    if names:
        name = F.element_at(F.array(*[F.lit(x) for x in names]), F.col("_rank") + 1)
    lookup = ranked.select(cluster, name.alias(out))
    return df.join(F.broadcast(lookup), cluster, "left")  # one row per cluster: size bounded by k


def gmm_regimes(df: DataFrame, features: Sequence[str] = REGIME_FEATURES, k: int = 3, starts: int = 10,
                max_iter: int = 200, returns: str = "returns", seed: int = 42) -> DataFrame:
    """M14 + M15: z-score (ddof 0) -> full-covariance mixture (the best of ``starts`` by log-likelihood, all fitted together)
    -> A14 names -> regime, regime_prob_<name>, is_<name> columns. Rows with a missing feature are left out."""
    from marketlens.operators.clean import zscore
    from marketlens.operators.mixture import Mixture
    from marketlens.operators.models import sized
    names = [f + "_z" for f in features]
    z = sized(zscore(df, list(features), ddof=0, suffix="_z").dropna(subset=names), 200_000)
    model = Mixture.fit(z, names, k, starts, max_iter, seed)
    pred = model.transform(z, "_pa", "cluster").drop(*names)
    named = name_regimes(pred, "cluster", returns)
    lab_of = {r["cluster"]: r["regime"] for r in named.select("cluster", "regime").distinct().collect()}
    labels = sorted(lab_of)
    probs = {f"regime_prob_{lab_of[c]}": F.col("_pa")[c] for c in labels}
    flags = {f"is_{lab_of[c]}": (F.col("regime") == lab_of[c]).cast("int") for c in labels}
    return named.withColumns(probs).withColumns(flags).drop("_pa")
