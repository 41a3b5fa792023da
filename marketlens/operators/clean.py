"""Projection and cleaning C1-C11.

Statistics that a rule needs (medians, means, stds) are computed by one
aggregate and fetched as a single row; the row-wise rule is then a column
expression, so cleaning never moves data to the driver.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.functions.panel import HALO, RN, SHARD, Panel
from marketlens.operators.quantiles import exact_quantiles

log = logging.getLogger(__name__)

# Columns that are never model features (targets and metadata).
EXCLUDE_COLS = [
    "date", "symbol", "target_return", "target_direction",
    "return_1d", "return_5d", "return_10d", "return_20d",
    "direction_1d", "direction_5d", "direction_class_5d",
    "triple_barrier", "risk_adj_return_5d", "vol_20d",
]
_FEATURE_TYPES = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType)


def feature_columns(df: DataFrame, exclude: Sequence[str] = EXCLUDE_COLS) -> list[str]:
    """Numeric columns (double, float, bigint, int) not in the exclude list."""
    return [f.name for f in df.schema.fields
            if f.name not in exclude and isinstance(f.dataType, _FEATURE_TYPES)]


def select_existing(df: DataFrame, selected: Sequence[str]) -> DataFrame:
    """Keep the selected columns that exist, in the given order."""
    return df.select(*[c for c in selected if c in df.columns])


def align_to_schema(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exact model column order; missing -> 0.0, NULL / NaN / inf -> 0.0."""
    out = []
    for c in columns:
        if c in df.columns:
            x = F.col(c).cast("double")
            out.append(F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0))
                       .otherwise(F.coalesce(x, F.lit(0.0))).alias(c))
        else:
            out.append(F.lit(0.0).alias(c))
    return df.select(*[F.col(k) for k in keep], *out)


def drop_sparse_rows(df: DataFrame, fraction: float = 0.5) -> DataFrame:
    """C4: keep rows with at least int(ncols * fraction) non-null values."""
    return df.dropna(thresh=int(len(df.columns) * fraction))


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """``dropna()`` / ``dropna(subset=..)``."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def replace_inf_fill(df: DataFrame, cols: Sequence[str] | None = None, value: float = 0.0) -> DataFrame:
    """+-inf and NaN -> missing -> constant."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(F.isnan(c) | (F.abs(F.col(c)) == float("inf")), F.lit(value))
                           .otherwise(F.coalesce(F.col(c), F.lit(value))) for c in cols})


def ffill_then_zero(df: DataFrame, panel: Panel | None = None, cols: Sequence[str] | None = None) -> DataFrame:
    """Forward fill within each key (not across keys), then 0."""
    p = panel or Panel()
    skip = set(p.keys) | {p.ts}
    cols = cols or [f.name for f in df.schema.fields
                    if f.name not in skip and isinstance(f.dataType, (T.DoubleType, T.FloatType,
                                                                      T.LongType, T.IntegerType))]

    def run(d: DataFrame, p: Panel) -> DataFrame:
        w = p.w().rowsBetween(Window.unboundedPreceding, 0)
        d = d.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
        if p.sharded:
            # a shard whose first rows have no value takes the last one of the shards before (one row for each key and shard)
            ends = d.where(~F.col(HALO)).groupBy(*p.part).agg(*[F.max_by(c, RN).alias(c) for c in cols])
            before = Window.partitionBy(*p.keys).orderBy(SHARD).rowsBetween(Window.unboundedPreceding, -1)
            ends = ends.select(*p.part, *[F.last(c, ignorenulls=True).over(before).alias(f"_last_{c}") for c in cols])
            d = d.join(ends, p.part, "left")
            d = d.withColumns({c: F.coalesce(c, f"_last_{c}") for c in cols}).drop(*[f"_last_{c}" for c in cols])
        return d.withColumns({c: F.coalesce(c, F.lit(0).cast(types[c])) for c in cols})
    types = {c: df.schema[c].dataType for c in cols}
    return p.run(df, run) if p.sharded else run(df, p)


def median_impute(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """``X.fillna(X.median())``; one aggregate row of medians."""
    if exact:
        row = exact_quantiles(df, cols, (0.5,)).first()
        med = {c: row[f"q_{c}_0"] for c in cols}
    else:
        med = df.agg(*[F.percentile_approx(c, 0.5, 10000).alias(c) for c in cols]).first().asDict()
    return df.fillna({c: float(m) for c, m in med.items() if m is not None})


def zscore(df: DataFrame, cols: Sequence[str], ddof: int = 1, suffix: str = "") -> DataFrame:
    """(x - mean) / std with ddof 1 (selection) or 0 (clustering, regimes)."""
    sd = F.stddev_samp if ddof == 1 else F.stddev_pop
    row = df.agg(*[x for c in cols for x in (F.avg(c).alias(f"m_{c}"), sd(c).alias(f"s_{c}"))]).first()
    out = {}
    for c in cols:
        m, s = row[f"m_{c}"], row[f"s_{c}"]
        out[c + suffix] = F.try_divide(F.col(c) - F.lit(m), F.lit(s)) if s else F.lit(None).cast("double")
    return df.withColumns(out)


def augment(df: DataFrame, keys: Sequence[str], noise_level: float = 0.01, n_augmentations: int = 1, seed: int = 42,
            cols: Sequence[str] | None = None) -> DataFrame:
    """C11: original rows (copy 0) plus n noisy copies; noise N(0, level * std) where std > 0.

    The noise of a cell is a function of the row's ``keys``, the copy, the column and the seed alone (two uniform numbers from
    one md5, turned normal by Box and Muller), so it is the same however rows are partitioned or recomputed.
    """
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, _FEATURE_TYPES) and f.name not in keys]
    row = df.agg(*[F.stddev_samp(c).alias(c) for c in cols]).first()
    d = df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(n_augmentations))))
    out = {}
    for c in cols:
        s = row[c]
        if s and s > 0:
            h = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.col("copy").cast("string"), F.lit(c), F.lit(str(seed)))
                      .cast("binary"))
            u, v = (F.conv(F.substring(h, at, 12), 16, 10).cast("double") / F.lit(float(1 << 48)) for at in (1, 13))
            noise = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u)) * F.cos(F.lit(2.0 * math.pi) * v)
            out[c] = F.when(F.col("copy") == 0, F.col(c)).otherwise(F.col(c).cast("double") + noise * F.lit(noise_level * s))
    return d.withColumns(out)
