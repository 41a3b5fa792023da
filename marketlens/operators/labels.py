"""Targets W28-W32: forward returns, direction classes, triple barrier, meta labels.

All look-aheads are ``lead`` / forward frames per key, so labels never mix
symbols (the reference's stacked-frame call does).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.panel import Panel, col, on_shards, sdiv
from marketlens.operators.recurrence import _with_panel

_P = Panel()


@on_shards
def forward_returns(df: DataFrame, panel: Panel = _P, close: str = "close",
                    horizons=(1, 5, 10, 20)) -> DataFrame:
    """return_{h}d = x[t+h]/x[t] - 1; vol_20d; risk_adj_return_5d (zero vol -> NULL)."""
    p = panel
    d = df.withColumns({f"return_{h}d": sdiv(p.lead(close, h), col(close)) - F.lit(1.0) for h in horizons})
    d = d.withColumn("_r1", sdiv(col(close), p.lag(close)) - F.lit(1.0))
    d = d.withColumn("vol_20d", p.roll(F.stddev_samp, "_r1", 20)).drop("_r1")
    if 5 in horizons:
        d = d.withColumn("risk_adj_return_5d", sdiv(F.col("return_5d"), F.col("vol_20d")))
    return d


def direction_labels(df: DataFrame, threshold: float = 0.005) -> DataFrame:
    """direction_1d/5d (missing -> 0) and direction_class_5d in {-1, 0, 1}."""
    out = {}
    for h in (1, 5):
        if f"return_{h}d" in df.columns:
            out[f"direction_{h}d"] = F.when(F.col(f"return_{h}d") > 0, F.lit(1)).otherwise(F.lit(0))
    if "return_5d" in df.columns:
        r = F.col("return_5d")
        out["direction_class_5d"] = (F.when(r > threshold, F.lit(1)).when(r < -threshold, F.lit(-1))
                                     .otherwise(F.lit(0)))
    return df.withColumns(out)


def target_direction(ret, threshold: float = 0.005):
    """W29 string form: Up / Down / Neutral (missing -> Neutral)."""
    r = col(ret)
    return F.when(r > threshold, F.lit("Up")).when(r < -threshold, F.lit("Down")).otherwise(F.lit("Neutral"))


@on_shards
def triple_barrier(df: DataFrame, panel: Panel = _P, close: str = "close", take_profit: float = 0.02,
                   stop_loss: float = 0.01, max_holding: int = 10, out: str = "triple_barrier") -> DataFrame:
    """First barrier hit within the next ``max_holding`` rows: +1 / -1 / 0.

    The next rows come from one bounded forward frame per row (O(rows * h)),
    evaluated with array functions; NULL when fewer than h rows follow or the
    row itself has no value.
    """
    p = panel
    x = col(close)
    # structs keep their place where the value is NULL: such a row hits nothing and still counts as held
    p._reach(ahead=max_holding)
    fut = F.collect_list(F.struct(x.alias("x"))).over(p.w().rowsBetween(1, max_holding))
    rets = F.transform(fut, lambda f: F.try_divide(f["x"] - x, x))
    tp = F.array_position(F.transform(rets, lambda r: r >= F.lit(take_profit)), True)
    sl = F.array_position(F.transform(rets, lambda r: r <= F.lit(-stop_loss)), True)
    d = df.withColumns({"_fut_n": F.size(fut), "_tp": tp, "_sl": sl})
    lab = (F.when((F.col("_fut_n") < max_holding) | x.isNull(), F.lit(None).cast("int"))
           .when((F.col("_tp") > 0) & (F.col("_sl") > 0),
                 F.when(F.col("_tp") <= F.col("_sl"), F.lit(1)).otherwise(F.lit(-1)))
           .when(F.col("_tp") > 0, F.lit(1)).when(F.col("_sl") > 0, F.lit(-1)).otherwise(F.lit(0)))
    return d.withColumn(out, lab).drop("_fut_n", "_tp", "_sl")


def meta_labels(df: DataFrame, prediction: str, actual: str, out: str = "meta_label") -> DataFrame:
    """1 when sign(prediction) == sign(actual) (missing -> 0)."""
    eq = F.signum(col(prediction)) == F.signum(col(actual))
    return df.withColumn(out, F.when(eq, F.lit(1)).otherwise(F.lit(0)))


def create_targets(df: DataFrame, panel: Panel = _P, close: str = "close") -> DataFrame:
    """W28 + W29 + W30 in one pass."""
    def run(d, panel):
        d = forward_returns(d, panel, close)
        d = direction_labels(d)
        return triple_barrier(d, panel, close)
    return _with_panel(df, panel, run)


def supervised_targets(df: DataFrame, panel: Panel = _P, close: str = "close", horizon: int = 5) -> DataFrame:
    """Features -> drop incomplete rows -> 5-row forward return -> class -> drop unlabelled.

    The forward return is taken on the rows that survive the null filter, per key.
    """
    from marketlens.operators.features import engineer_features
    feats = engineer_features(df, panel).dropna()

    def run(d, panel):
        d = d.withColumn("target_return", sdiv(panel.lead(close, horizon), col(close)) - F.lit(1.0))
        return d.withColumn("target_direction", target_direction("target_return"))
    return _with_panel(feats, panel, run).where(F.col("target_return").isNotNull())
