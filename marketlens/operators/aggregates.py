"""Grouped aggregates and keyed joins: A1, A15, A18, A19, J2, J3, J6, U1-U2.

J5 (pairs of assets per date) is not built as a join: correlations use one
aggregate over a pivot (``operators/corr.py``), so no pair rows are emitted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.panel import Panel

_P = Panel()


def group_stats(df: DataFrame, key: str = "symbol", close: str = "close", volume: str = "volume") -> DataFrame:
    """A1: close mean/std/min/max, volume mean/sum per key (map-side partial aggregation)."""
    return df.groupBy(key).agg(
        F.avg(close).alias("close_mean"), F.stddev_samp(close).alias("close_std"),
        F.min(close).alias("close_min"), F.max(close).alias("close_max"),
        F.avg(volume).alias("volume_mean"), F.sum(volume).alias("volume_sum"))


def first_per_key(df: DataFrame, panel: Panel = _P, value: str = "close", out: str = "first_close") -> DataFrame:
    """First value per key in time order, as a partial aggregate (``min_by`` on the order struct)."""
    return df.groupBy(*panel.keys).agg(F.min_by(value, F.struct(*panel.order())).alias(out))


def merge_first_close(df: DataFrame, panel: Panel = _P, value: str = "close") -> DataFrame:
    """Fact x one-row-per-key dimension on the key.

    The dimension has exactly one row per key; the join is left to the planner,
    which broadcasts it when AQE measures it under the broadcast threshold and
    falls back to a shuffled join otherwise.
    """
    dim = first_per_key(df, panel, value)
    return df.join(dim, list(panel.keys), "inner")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """``value_counts`` of a label column."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence, out_keep_first: bool = True) -> DataFrame:
    """Keep the first row per key under a total order (deterministic, unlike dropDuplicates).

    ``max_by``/``min_by`` on a struct is a partial aggregate, so a key with many
    duplicates is reduced before the shuffle instead of landing whole in one task.
    """
    cols = [c for c in df.columns if c not in keys]
    ordk = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    pick = F.min_by if out_keep_first else F.max_by
    return df.groupBy(*keys).agg(pick(F.struct(*cols), ordk).alias("_r")).select(*keys, "_r.*")


def day_gaps(df: DataFrame, panel: Panel = _P) -> DataFrame:
    """Histogram of day differences between consecutive rows per key."""
    gapped = panel.run(df, lambda d, p: d.withColumn("gap_days", F.datediff(F.col(p.ts), p.lag(p.ts)))) if panel.sharded else \
        df.withColumn("gap_days", F.datediff(F.col(panel.ts), panel.lag(panel.ts)))
    return (gapped.select("gap_days").where(F.col("gap_days").isNotNull())
            .groupBy("gap_days").agg(F.count(F.lit(1)).alias("count")))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, missing columns filled with NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def union_dedup(frames: Sequence[DataFrame], key: str = "url", order: Sequence = ("publishedAt",)) -> DataFrame:
    """Union, then first row per key."""
    return distinct_on(union_all(frames), [key], order)


def calendar_spine(df: DataFrame, ts: str, unit: str = "day", keys: Sequence[str] = ()) -> DataFrame:
    """Every period between the first and last one (per key), for a left join."""
    step = {"day": "1 day", "week": "7 days"}[unit]
    g = df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    return g.select(*keys, F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL {step}"))).alias(ts))


def left_attach(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Attach columns by key; absent keys give NULL."""
    return df.join(other, list(on), "left")


__all__ = ["group_stats", "first_per_key", "merge_first_close", "class_balance", "distinct_on",
           "day_gaps", "union_all", "union_dedup", "calendar_spine", "left_attach", "Window"]
