"""Registered feature, label, split and benchmark queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.functions.panel import Panel
from marketlens.operators import features as fe
from marketlens.operators import labels as lb
from marketlens.operators import splits as sp
from marketlens.plans.registry import query, rounded
from marketlens.plans.sqlkit import BARS, LEVEL, B, R, div, lag, lead, roll
from marketlens.sources.tables import daily_bars, level_bars, table, tick_panel

P = Panel()
# 25 brands hold all of lineitem: their histories are cut into shards, at every size alike
TICK = Panel(keys=("symbol",), ts="date", tiebreak=("l_orderkey", "l_linenumber"), shard_rows=50_000, halo_back=32, halo_fwd=1)

_PCT = f"(close / nullif({lag('close')}, 0) - 1)"


def _w9_select(src: str = "b") -> str:
    """SQL for the 47 W9 columns over a CTE with symbol, date, rn, OHLCV."""
    ret = "ret"
    parts = []
    parts += [R(lag("close", k), f"close_lag_{k}") for k in (1, 2, 3, 5, 7)]
    parts += [R(roll(fn, "close", n), f"close_rolling_{n}_{nm}") for n in (5, 10, 20)
              for nm, fn in (("mean", "avg"), ("std", "stddev_samp"))]
    for p in (5, 10, 20):
        parts += [R(f"close - {lag('close', p)}", f"momentum_{p}"),
                  R(f"100.0 * {div(f'close - {lag("close", p)}', lag('close', p))}", f"roc_{p}"),
                  R(f"close / nullif({lag('close', p)}, 0) - 1", f"return_{p}")]
    for n in (5, 10, 20):
        parts += [R(roll("stddev_samp", ret, n), f"volatility_{n}"),
                  R(div(roll("stddev_samp", ret, n), f"abs({roll('avg', ret, n)})"), f"cv_{n}"),
                  R(roll("avg", "hl", n), f"hl_range_{n}")]
    pc = lag("close")
    parts += [R(div("close - low", "high - low"), "price_position"), R(div("close", "open"), "co_ratio"),
              R(div("high", "low"), "hl_ratio"), R(div("close - open", "open"), "oc_spread"),
              R(div(f"CASE WHEN {pc} IS NOT NULL THEN greatest(high - low, abs(high - {pc}), abs(low - {pc})) END",
                    "close"), "tr_ratio")]
    run = "OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    parts += [R(div(roll("avg", "volume", 5), roll("avg", "volume", 20)), "volume_ma_ratio_5_20"),
              R(f"CASE WHEN pv IS NOT NULL THEN sum(pv) {run} END", "pvt"),
              R(f"sum(CASE WHEN close - pc0 > 0 THEN volume WHEN close - pc0 < 0 THEN -volume ELSE 0.0 END) {run}",
                "obv"),
              R(f"100.0 * {div(roll('sum', 'pmf', 14), roll('sum', 'pmf', 14) + ' + ' + roll('sum', 'nmf', 14))}",
                "money_flow_index")]
    parts += [f"CASE WHEN close > {lag('close', k)} THEN 1 ELSE -1 END AS trend_{k}" for k in (1, 5, 20)]
    parts += [f"CASE WHEN close - {pc} > 0 THEN 1 ELSE 0 END AS up_down",
              f"CAST(CASE WHEN close - {pc} > 0 THEN rn - max(CASE WHEN NOT (close - pc0 > 0) OR pc0 IS NULL "
              f"THEN rn END) {run} ELSE 0 END AS INTEGER) AS consecutive_up"]
    for nm, ref in (("close_pct_from_ma20", roll("avg", "close", 20)), ("close_pct_from_ma50", roll("avg", "close", 50)),
                    ("close_52w_high_pct", roll("max", "close", 252)), ("close_52w_low_pct", roll("min", "close", 252))):
        parts.append(R(f"100.0 * {div(f'close - {ref}', ref)}", nm))
    inner = (f"SELECT *, {_PCT} AS ret, (high - low) / nullif(close, 0) AS hl, {_PCT} * volume AS pv, "
             f"CASE WHEN tp - lag(tp) OVER (PARTITION BY symbol ORDER BY date) > 0 THEN tp * volume ELSE 0.0 END AS pmf, "
             f"CASE WHEN tp - lag(tp) OVER (PARTITION BY symbol ORDER BY date) < 0 THEN tp * volume ELSE 0.0 END AS nmf "
             f"FROM (SELECT *, (high + low + close) / 3 AS tp, "
             f"lag(close) OVER (PARTITION BY symbol ORDER BY date) AS pc0 FROM {src})")
    return f"({inner})", ", ".join(parts)


_W9_FROM, _W9_COLS = _w9_select()


@query("w9_feature_set", f"""WITH {BARS}, {B}
SELECT symbol, date, {R('close', 'close')}, {_W9_COLS} FROM {_W9_FROM}""")
def w9_feature_set(spark, sf):
    """W1-W8 composed: 47 engineered columns per bar."""
    d = fe.engineer_features(daily_bars(spark, sf), P)
    return rounded(d.select("symbol", "date", "close", *fe.FEATURES_47))


@query("w1_w2_lag_rolling", f"""WITH {BARS}
SELECT symbol, date, {R('volume', 'volume')},
  {', '.join(R(lag('volume', k), f'volume_lag_{k}') for k in (1, 2, 3, 5, 7, 14))},
  {', '.join(R(roll(fn, 'volume', n), f'volume_rolling_{n}_{nm}') for n in (5, 10, 20)
             for nm, fn in (('mean', 'avg'), ('std', 'stddev_samp'), ('min', 'min'), ('max', 'max')))}
FROM bars""")
def w1_w2_lag_rolling(spark, sf):
    """W1 with the DAG's extra lag 14 and W2 with all four functions, on volume."""
    d = daily_bars(spark, sf)
    d = fe.lag_features(d, P, ["volume", "missing_col"], [1, 2, 3, 5, 7, 14])
    d = fe.rolling_features(d, P, ["volume"], [5, 10, 20], ["mean", "std", "min", "max", "median"])
    cols = [f"volume_lag_{k}" for k in (1, 2, 3, 5, 7, 14)] + \
        [f"volume_rolling_{n}_{f}" for n in (5, 10, 20) for f in ("mean", "std", "min", "max")]
    return rounded(d.select("symbol", "date", "volume", *cols))


@query("w7_trend_level", f"""WITH {BARS}, {LEVEL}
SELECT symbol, date, {R('close', 'close')},
  CASE WHEN close > {lag('close', 1)} THEN 1 ELSE -1 END AS trend_1,
  CASE WHEN close - {lag('close')} > 0 THEN 1 ELSE 0 END AS up_down,
  CAST(CASE WHEN close - {lag('close')} > 0 THEN rn - max(CASE WHEN NOT (close - pc0 > 0)
       OR pc0 IS NULL THEN rn END) OVER (PARTITION BY symbol ORDER BY date
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) ELSE 0 END AS INTEGER) AS consecutive_up
FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS pc0 FROM lb)""")
def w7_trend_level(spark, sf):
    """W7 on the trending level series (long up-runs)."""
    d = fe.trend_features(level_bars(spark, sf), P)
    return rounded(d.select("symbol", "date", "close", "trend_1", "up_down", "consecutive_up"))


# ------------------------------------------------------------------ labels
@query("w28_w30_targets", f"""WITH {BARS}, {LEVEL},
f AS (SELECT *, list(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING) AS fut,
      close / nullif({lag('close')}, 0) - 1 AS r1 FROM lb),
g AS (SELECT *, coalesce(len(fut), 0) AS nf,
      list_position([(x - close) / close >= 0.02 FOR x IN fut], true) AS tp,
      list_position([(x - close) / close <= -0.01 FOR x IN fut], true) AS sl,
      {', '.join(f"{lead('close', h)} / nullif(close, 0) - 1 AS return_{h}d" for h in (1, 5, 10, 20))},
      {roll('stddev_samp', 'r1', 20)} AS vol_20d FROM f)
SELECT symbol, date, {R('close', 'close')},
  {', '.join(R(f'return_{h}d', f'return_{h}d', 6) for h in (1, 5, 10, 20))},
  {R('vol_20d', 'vol_20d', 6)}, {R(div('return_5d', 'vol_20d'), 'risk_adj_return_5d', 6)},
  CASE WHEN return_1d > 0 THEN 1 ELSE 0 END AS direction_1d,
  CASE WHEN return_5d > 0 THEN 1 ELSE 0 END AS direction_5d,
  CASE WHEN return_5d > 0.005 THEN 1 WHEN return_5d < -0.005 THEN -1 ELSE 0 END AS direction_class_5d,
  CASE WHEN nf < 10 THEN NULL WHEN tp IS NOT NULL AND sl IS NOT NULL THEN CASE WHEN tp <= sl THEN 1 ELSE -1 END
       WHEN tp IS NOT NULL THEN 1 WHEN sl IS NOT NULL THEN -1 ELSE 0 END AS triple_barrier
FROM g""")
def w28_w30_targets(spark, sf):
    """W28 forward returns + W29 direction classes + W30 triple barrier on the level series."""
    d = lb.create_targets(level_bars(spark, sf), P)
    cols = ["symbol", "date", "close", "return_1d", "return_5d", "return_10d", "return_20d", "vol_20d",
            "risk_adj_return_5d", "direction_1d", "direction_5d", "direction_class_5d", "triple_barrier"]
    return rounded(d.select(*cols), 6, {"close": 4})


@query("w31_meta_labels", f"""WITH {BARS}, {LEVEL}
SELECT symbol, date, {R('momentum', 'momentum')}, {R('fwd', 'fwd')},
  CASE WHEN sign(momentum) = sign(fwd) THEN 1 ELSE 0 END AS meta_label
FROM (SELECT *, close - {lag('close', 5)} AS momentum, {lead('close', 5)} / close - 1 AS fwd FROM lb)""")
def w31_meta_labels(spark, sf):
    """W31 with a 5-row momentum as the primary signal and the 5-row forward return as truth."""
    d = level_bars(spark, sf)
    d = d.withColumns({"momentum": F.col("close") - P.lag("close", 5),
                       "fwd": F.try_divide(P.lead("close", 5), F.col("close")) - 1})
    d = lb.meta_labels(d, "momentum", "fwd")
    return rounded(d.select("symbol", "date", "momentum", "fwd", "meta_label"))


@query("w32_supervised_set", f"""WITH {BARS}, {LEVEL},
feat AS (SELECT symbol, date, rn, close, {_w9_select('lb')[1]} FROM {_w9_select('lb')[0]}),
ok AS (SELECT * FROM feat WHERE {' AND '.join(f'{c} IS NOT NULL' for c in fe.FEATURES_47)}),
t AS (SELECT *, {lead('close', 5)} / nullif(close, 0) - 1 AS target_return FROM ok)
SELECT symbol, date, {R('close', 'close')}, {R('close_rolling_20_std', 'close_rolling_20_std')},
  {R('target_return', 'target_return')},
  CASE WHEN target_return > 0.005 THEN 'Up' WHEN target_return < -0.005 THEN 'Down' ELSE 'Neutral' END AS target_direction
FROM t WHERE target_return IS NOT NULL""")
def w32_supervised_set(spark, sf):
    """W9 features -> drop rows with any NULL -> 5-row forward target -> class."""
    d = lb.supervised_targets(level_bars(spark, sf), P)
    return rounded(d.select("symbol", "date", "close", "close_rolling_20_std", "target_return", "target_direction"))


# ------------------------------------------------------------------ splits
@query("k4_ordered_split", f"""WITH {BARS}
SELECT symbol, date, {R('close', 'close')},
  CASE WHEN pos < floor(n * 0.7) THEN 'train' WHEN pos < floor(n * 0.85) THEN 'val' ELSE 'test' END AS split,
  CAST(pos AS BIGINT) AS pos
FROM (SELECT *, row_number() OVER (ORDER BY date, symbol) - 1 AS pos, count(*) OVER () AS n FROM bars)""")
def k4_ordered_split(spark, sf):
    """K4: 70/15/15 split in (date, symbol) order."""
    d = sp.ordered_split(daily_bars(spark, sf), (0.7, 0.15, 0.15), ("train", "val", "test"))
    return rounded(d.select("symbol", "date", "close", "split", F.col(sp.POS).alias("pos")))


@query("k5_expanding_folds", f"""WITH {BARS},
p AS (SELECT *, row_number() OVER (ORDER BY date, symbol) - 1 AS pos, count(*) OVER () AS n FROM bars),
f AS (SELECT *, n // 6 AS size FROM p),
folds AS (SELECT range AS fold FROM range(5))
SELECT symbol, date, CAST(fold AS INTEGER) AS fold,
  CASE WHEN pos < n - (5 - fold) * size - 3 THEN 'train' ELSE 'test' END AS role
FROM f, folds
WHERE pos < n - (5 - fold) * size - 3 OR (pos >= n - (5 - fold) * size AND pos < n - (4 - fold) * size)""")
def k5_expanding_folds(spark, sf):
    """K5: 5 expanding folds with a gap of 3 rows; one row per (bar, fold) membership."""
    d = sp.expanding_folds(daily_bars(spark, sf), n_splits=5, gap=3)
    return d.select("symbol", "date", F.col("fold").cast("int").alias("fold"), "role")


@query("k1_sort_by_time", f"""WITH {BARS}
SELECT date, symbol, {R('close', 'close')}, row_number() OVER (ORDER BY date, symbol) AS ord FROM bars""")
def k1_sort_by_time(spark, sf):
    """K1: total (date, symbol) order, materialised as an explicit position column."""
    d, _ = sp.with_positions(daily_bars(spark, sf))
    return rounded(d.select("date", "symbol", "close", (F.col(sp.POS) + 1).alias("ord")))


# ------------------------------------------------------------------ the reference's benchmark operations
_TICK_SQL = """ticks AS (SELECT p_brand AS symbol, l_shipdate AS date, l_orderkey, l_linenumber,
  l_extendedprice AS close, l_quantity AS volume FROM lineitem JOIN part ON l_partkey = p_partkey)"""
_TW = "PARTITION BY symbol ORDER BY date, l_orderkey, l_linenumber"


def _troll(fn: str, x: str, n: int) -> str:
    w = f"OVER ({_TW} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"(CASE WHEN count({x}) {w} = {n} THEN {fn}({x}) {w} END)"


@query("s1_parquet_scan", """SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_shipdate
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_quantity > 10""")
def s1_parquet_scan(spark, sf):
    """Projected, filtered scan; the filter reaches the parquet reader (PushedFilters)."""
    from marketlens.sources.files import load_data
    return load_data(spark, f"{sf}/lineitem.parquet",
                     columns=["l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_shipdate"],
                     filters=(F.col("l_shipdate") >= F.lit("1995-01-01").cast("timestamp_ntz"))
                     & (F.col("l_quantity") > 10))


@query("a1_group_aggregate", f"""WITH {_TICK_SQL}
SELECT symbol, {R('avg(close)', 'close_mean')}, {R('stddev_samp(close)', 'close_std')},
  {R('min(close)', 'close_min')}, {R('max(close)', 'close_max')},
  {R('avg(volume)', 'volume_mean')}, {R('sum(volume)', 'volume_sum')} FROM ticks GROUP BY symbol""")
def a1_group_aggregate(spark, sf):
    """A1: per-symbol close mean/std/min/max and volume mean/sum (partial + final aggregate)."""
    from marketlens.operators.aggregates import group_stats
    return rounded(group_stats(tick_panel(spark, sf)))


@query("w33_grouped_rolling", f"""WITH {_TICK_SQL}
SELECT symbol, date, l_orderkey, l_linenumber, {R('close', 'close')},
  {R(_troll('avg', 'close', 5), 'rolling_mean_5')}, {R(_troll('stddev_samp', 'close', 20), 'rolling_std_20')}
FROM ticks""")
def w33_grouped_rolling(spark, sf):
    """Rolling mean 5 / std 20 per symbol over the tick panel."""
    d = fe.benchmark_rolling(tick_panel(spark, sf), TICK)
    return rounded(d.select("symbol", "date", "l_orderkey", "l_linenumber", "close",
                            "rolling_mean_5", "rolling_std_20"))


@query("j2_merge_first_close", f"""WITH {_TICK_SQL},
firsts AS (SELECT symbol, arg_min(close, (date, l_orderkey, l_linenumber)) AS first_close FROM ticks GROUP BY symbol)
SELECT t.symbol, t.date, t.l_orderkey, t.l_linenumber, {R('t.close', 'close')}, {R('f.first_close', 'first_close')}
FROM ticks t JOIN firsts f ON t.symbol = f.symbol""")
def j2_merge_first_close(spark, sf):
    """Inner join of the tick fact with a one-row-per-symbol dimension (first close)."""
    from marketlens.operators.aggregates import merge_first_close
    d = merge_first_close(tick_panel(spark, sf), TICK)
    return rounded(d.select("symbol", "date", "l_orderkey", "l_linenumber", "close", "first_close"))


@query("w34_grouped_features", f"""WITH {_TICK_SQL}
SELECT symbol, date, l_orderkey, l_linenumber, {R('close', 'close')},
  {R(f'lag(close, 1) OVER ({_TW})', 'close_lag_1')}, {R(f'lag(close, 5) OVER ({_TW})', 'close_lag_5')},
  {R(_troll('avg', 'close', 20), 'close_ma_20')}, {R(_troll('stddev_samp', 'close', 20), 'close_std_20')},
  {R(f'close / nullif(lag(close, 1) OVER ({_TW}), 0) - 1', 'returns')},
  {R(f'close - lag(close, 5) OVER ({_TW})', 'momentum_5')}
FROM ticks""")
def w34_grouped_features(spark, sf):
    """Lags 1/5, ma20, std20, return, momentum_5 per symbol over the tick panel."""
    d = fe.benchmark_features(tick_panel(spark, sf), TICK)
    return rounded(d.select("symbol", "date", "l_orderkey", "l_linenumber", "close", "close_lag_1",
                            "close_lag_5", "close_ma_20", "close_std_20", "returns", "momentum_5"))


__all__ = ["table"]
