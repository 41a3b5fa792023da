"""Batch scoring P1-P4 and latest-row selection K3."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.panel import Panel

_P = Panel()


def latest(df: DataFrame, panel: Panel = _P, count_as: str | None = "n_rows") -> DataFrame:
    """K3: last row per key (``iloc[-1]``) as one grouped aggregate.

    ``max_by(struct, ts)`` aggregates partially before the shuffle, so a hot key
    costs one row per task, not its whole history.
    """
    order = F.struct(*panel.order())
    cols = [c for c in df.columns if c not in panel.keys]
    aggs = [F.max_by(F.struct(*cols), order).alias("_last")]
    if count_as:
        aggs.append(F.count(F.lit(1)).alias(count_as))
    out = df.groupBy(*panel.keys).agg(*aggs)
    return out.select(*panel.keys, "_last.*", *([count_as] if count_as else []))


def rule_score(df: DataFrame, rsi="rsi", macd="macd", macd_signal="macd_signal", sma="sma_20",
               close="close", sentiment="sentiment_score", n_rows="n_rows", min_rows: int = 20,
               out: str = "prediction") -> DataFrame:
    """Mean of the available signals on each key's latest row; 0 for short keys.

    RSI < 30 +0.02 / > 70 -0.02 (missing RSI counts as 50); MACD above signal
    +0.01 else -0.01; close above SMA +0.01 else -0.01; sentiment * 0.02.
    """
    r = F.coalesce(F.col(rsi), F.lit(50.0)) if rsi in df.columns else F.lit(50.0)
    sigs = [F.when(r < 30, F.lit(0.02)).when(r > 70, F.lit(-0.02))]
    if macd in df.columns and macd_signal in df.columns:
        sigs.append(F.when(F.col(macd).isNotNull() & F.col(macd_signal).isNotNull(),
                           F.when(F.col(macd) > F.col(macd_signal), F.lit(0.01)).otherwise(F.lit(-0.01))))
    if sma in df.columns:
        sigs.append(F.when(F.col(sma).isNotNull(),
                           F.when(F.col(close) > F.col(sma), F.lit(0.01)).otherwise(F.lit(-0.01))))
    if sentiment in df.columns:
        sigs.append(F.col(sentiment) * F.lit(0.02))
    arr = F.filter(F.array(*[s.cast("double") for s in sigs]), lambda x: x.isNotNull())
    mean = F.aggregate(arr, F.lit(0.0), lambda a, x: a + x) / F.size(arr)
    score = F.when(F.size(arr) == 0, F.lit(0.0)).otherwise(mean)
    if n_rows in df.columns:
        score = F.when(F.col(n_rows) < min_rows, F.lit(0.0)).otherwise(score)
    return df.withColumn(out, score)


def prediction_record(df: DataFrame, prediction="prediction", close="close", ts="date",
                      feature_cols: Sequence[str] = ()) -> DataFrame:
    """Direction, confidence, current/target price (rounded 2) and an optional features map."""
    p = F.col(prediction)
    cols = {
        "direction": F.when(p >= 0, F.lit("bullish")).otherwise(F.lit("bearish")),
        "confidence": F.when(p != 0, F.least(F.abs(p) * 10, F.lit(1.0))).otherwise(F.lit(0.5)),
        "current_price": F.round(F.col(close), 2),
        "target_price": F.round(F.col(close) * (F.lit(1.0) + p), 2),
        "timestamp": F.col(ts),
    }
    if feature_cols:
        present = [c for c in feature_cols if c in df.columns]
        keys = F.array(*[F.lit(c) for c in present])
        vals = F.array(*[F.col(c).cast("double") for c in present])
        zipped = F.map_from_arrays(keys, vals)
        cols["features"] = F.map_filter(zipped, lambda k, v: v.isNotNull() & ~F.isnan(v))
    return df.withColumns(cols)


def batch_predict(bars: DataFrame, panel: Panel = _P, sentiment: float | None = 0.0) -> DataFrame:
    """One job scoring every key: W22 indicators -> latest row -> P1 -> P2."""
    from marketlens.operators.indicators import serving_indicators
    feats = serving_indicators(bars, panel)
    if sentiment is not None:
        feats = feats.withColumn("sentiment_score", F.lit(float(sentiment)))
    last = latest(feats, panel)
    scored = rule_score(last)
    rec = prediction_record(scored, ts=panel.ts)
    return rec.select(*panel.keys, "prediction", "direction", "confidence", "current_price",
                      "target_price", "timestamp", "rsi", "macd", "macd_signal", "sma_20", "n_rows")


def model_summary(metrics: DataFrame, champion: str | None = None) -> DataFrame:
    """Per-model score = accuracy, else max(0, r2); champion first, then by score."""
    score = F.coalesce(F.col("accuracy"), F.greatest(F.col("r2"), F.lit(0.0))) \
        if "accuracy" in metrics.columns else F.greatest(F.col("r2"), F.lit(0.0))
    out = metrics.withColumn("score", score)
    if champion is None:
        return out.orderBy(F.desc("score"), "model")
    return out.withColumn("is_champion", F.col("model") == F.lit(champion)) \
              .orderBy(F.desc("is_champion"), F.desc("score"), "model")


__all__ = ["latest", "rule_score", "prediction_record", "batch_predict", "model_summary", "Window"]
