"""Registered correlation and regime queries: A10, A11, K2, W26, W27, A12-A14, M14-M15."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.functions.panel import Panel, sdiv
from marketlens.operators import corr as co
from marketlens.operators import regimes as rg
from marketlens.plans.registry import query, rounded
from marketlens.plans.sqlkit import BARS, LEVEL, R, lag, lead, roll
from marketlens.session import cut_lineage
from marketlens.sources.tables import daily_bars, level_bars, table

P = Panel()

_RET = f"""{BARS}, r AS (SELECT symbol, date, close / nullif({lag('close')}, 0) - 1 AS ret FROM bars),
pairs AS (SELECT a.symbol AS asset1, b.symbol AS asset2, corr(a.ret, b.ret) AS c
          FROM r a JOIN r b ON a.date = b.date AND a.symbol < b.symbol GROUP BY 1, 2)"""


@query("a10_cross_asset_correlation", f"""WITH {_RET} SELECT asset1, asset2, {R('c', 'correlation')} FROM pairs""")
def a10_cross_asset_correlation(spark, sf):
    """A10: pairwise-complete return correlation per symbol pair (pivot + one corr aggregate)."""
    return rounded(co.return_correlations(daily_bars(spark, sf), P))


@query("k2_top_correlations", f"""WITH {_RET}
SELECT asset1, asset2, {R('c', 'correlation')} FROM pairs ORDER BY abs(c) DESC, asset1, asset2 LIMIT 5""")
def k2_top_correlations(spark, sf):
    """K2: the 5 strongest pairs by absolute correlation (a top-k report)."""
    return rounded(co.top_k(co.return_correlations(daily_bars(spark, sf), P), 5))


@query("a10_correlation_matrix", f"""WITH {_RET},
full_ AS (SELECT asset1, asset2, c FROM pairs UNION ALL SELECT asset2, asset1, c FROM pairs
          UNION ALL SELECT DISTINCT symbol, symbol, 1.0 FROM bars)
SELECT asset1, {', '.join(R(f"max(CASE WHEN asset2 = '{s}' THEN c END)", f'"{s}"') for s in
                          ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'])}
FROM full_ GROUP BY asset1""")
def a10_correlation_matrix(spark, sf):
    """A10 wide form: symmetric matrix, 1 on the diagonal."""
    return rounded(co.correlation_matrix(co.return_correlations(daily_bars(spark, sf), P)))


@query("a10_supplier_correlations", f"""WITH m AS (SELECT l_suppkey AS symbol, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
  sum(l_extendedprice) / sum(l_quantity) AS close FROM lineitem GROUP BY 1, 2),
r AS (SELECT symbol, date, close / nullif({lag('close')}, 0) - 1 AS ret FROM m)
SELECT CAST(a.symbol AS VARCHAR) AS asset1, CAST(b.symbol AS VARCHAR) AS asset2, {R('corr(a.ret, b.ret)', 'correlation')}
FROM r a JOIN r b ON a.date = b.date AND a.symbol < b.symbol GROUP BY 1, 2""")
def a10_supplier_correlations(spark, sf):
    """A10 for many assets (every supplier's monthly unit price): masked Gram matrices instead of an expression for each pair."""
    m = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("symbol"), F.to_date(F.date_trunc("month", "l_shipdate")).alias("date")) \
        .agg((F.sum("l_extendedprice") / F.sum("l_quantity")).alias("close"))
    out = co.return_correlations(m, P)
    return rounded(out.select(F.col("asset1").cast("string").alias("asset1"), F.col("asset2").cast("string").alias("asset2"), "correlation"))


_A11 = f"""{BARS}, {LEVEL}, f AS (SELECT symbol, date,
  close / nullif({lag('close')}, 0) - 1 AS ret_1, close / nullif({lag('close', 5)}, 0) - 1 AS ret_5,
  (high - low) / nullif(close, 0) AS hl, volume / nullif({lag('volume')}, 0) - 1 AS vol_chg,
  {lead('close', 5)} / nullif(close, 0) - 1 AS target FROM lb)"""
_FEATS = ["ret_1", "ret_5", "hl", "vol_chg"]


def _a11_frame(spark, sf):
    d = level_bars(spark, sf)
    return d.select("symbol", "date",
                    (sdiv(F.col("close"), P.lag("close")) - 1).alias("ret_1"),
                    (sdiv(F.col("close"), P.lag("close", 5)) - 1).alias("ret_5"),
                    sdiv(F.col("high") - F.col("low"), F.col("close")).alias("hl"),
                    (sdiv(F.col("volume"), P.lag("volume")) - 1).alias("vol_chg"),
                    (sdiv(P.lead("close", 5), F.col("close")) - 1).alias("target"))


@query("a11_feature_correlations", f"""WITH {_A11}
""" + " UNION ALL ".join(f"SELECT '{a}' AS feature1, '{b}' AS feature2, {R(f'corr({a}, {b})', 'correlation', 6)} FROM f"
                         for i, a in enumerate(_FEATS) for b in _FEATS[i + 1:]))
def a11_feature_correlations(spark, sf):
    """Feature x feature pairwise-complete correlations in one aggregate."""
    return rounded(co.feature_correlations(_a11_frame(spark, sf), _FEATS), 6)


@query("a11_target_correlations", f"""WITH {_A11}
""" + " UNION ALL ".join(f"SELECT '{a}' AS feature, {R(f'corr({a}, target)', 'correlation', 6)} FROM f" for a in _FEATS))
def a11_target_correlations(spark, sf):
    """``corrwith(target)`` of each feature (5-row forward return)."""
    return rounded(co.target_correlations(_a11_frame(spark, sf), _FEATS, "target"), 6)


# ------------------------------------------------------------------ regimes
_W26 = f"""{BARS}, {LEVEL},
r1 AS (SELECT *, close / nullif({lag('close')}, 0) - 1 AS ret FROM lb),
r2 AS (SELECT *, {roll('avg', 'close', 20)} AS f, {roll('avg', 'close', 50)} AS s,
              {roll('stddev_samp', 'ret', 20)} AS v FROM r1),
r3 AS (SELECT *, {roll('avg', 'v', 50)} AS vm FROM r2),
rg AS (SELECT symbol, date, close, ret, CASE WHEN f > s AND v < vm * 1.5 THEN 'bull'
            WHEN f < s AND v < vm * 1.5 THEN 'bear' ELSE 'sideways' END AS regime FROM r3)"""


def _w26(spark, sf):
    d = level_bars(spark, sf)
    d = d.withColumn("ret", sdiv(F.col("close"), P.lag("close")) - 1)
    return rg.rule_regime(d, P)


@query("w26_rule_regime", f"""WITH {_W26} SELECT symbol, date, {R('close', 'close')}, regime FROM rg""")
def w26_rule_regime(spark, sf):
    """Moving-average crossover and volatility rule per symbol on the level series."""
    return rounded(_w26(spark, sf).select("symbol", "date", "close", "regime"))


@query("a12_regime_statistics", f"""WITH {_W26}
SELECT symbol, regime, count(*) AS count,
  {R('100.0 * count(*) / sum(count(*)) OVER (PARTITION BY symbol)', 'frequency')},
  {R('avg(ret) * 100', 'mean_return')}, {R('stddev_samp(ret) * 100', 'std_return')},
  {R(f'CASE WHEN stddev_samp(ret) > 0 THEN avg(ret) / stddev_samp(ret) * sqrt(252) ELSE 0.0 END', 'sharpe')},
  {R('max(ret) * 100', 'max_return')}, {R('min(ret) * 100', 'min_return')}
FROM rg GROUP BY symbol, regime""")
def a12_regime_statistics(spark, sf):
    """A12 per (symbol, regime) on the W26 labels."""
    return rounded(rg.regime_statistics(_w26(spark, sf), "regime", "ret", keys=["symbol"]))


@query("a13_transition_matrix", f"""WITH {_W26},
d AS (SELECT symbol, regime AS from_regime, {lead('regime')} AS to_regime,
        row_number() OVER (PARTITION BY symbol, regime ORDER BY date DESC) AS k FROM rg),
n AS (SELECT symbol, from_regime, count(*) AS nf FROM d GROUP BY 1, 2),
t AS (SELECT symbol, from_regime, to_regime, count(*) AS c FROM d WHERE k > 1 GROUP BY 1, 2, 3),
g AS (SELECT symbol, from_regime, nf, unnest(['bear', 'sideways', 'bull']) AS to_regime FROM n)
SELECT g.symbol, g.from_regime, g.to_regime,
  {R('CASE WHEN nf > 1 THEN coalesce(c, 0) / (nf - 1) ELSE 0.0 END', 'probability')}
FROM g LEFT JOIN t ON g.symbol = t.symbol AND g.from_regime = t.from_regime AND g.to_regime = t.to_regime""")
def a13_transition_matrix(spark, sf):
    """A13 per symbol: P(next regime | regime), the last occurrence of each regime dropped."""
    return rounded(rg.transition_matrix(_w26(spark, sf), P))


_W27 = f"""{BARS}, {LEVEL},
q1 AS (SELECT symbol, date, close / nullif({lag('close')}, 0) - 1 AS returns FROM lb),
q2 AS (SELECT *, {lag('returns', 1)} AS returns_lag1, {lag('returns', 2)} AS returns_lag2,
         {roll('stddev_samp', 'returns', 20)} AS volatility, {roll('avg', 'returns', 5)} AS momentum_5d,
         {roll('avg', 'returns', 20)} AS momentum_20d FROM q1),
q3 AS (SELECT *, volatility / nullif({lag('volatility')}, 0) - 1 AS volatility_change FROM q2),
w27 AS (SELECT * FROM q3 WHERE returns IS NOT NULL AND returns_lag1 IS NOT NULL AND returns_lag2 IS NOT NULL
        AND volatility IS NOT NULL AND volatility_change IS NOT NULL AND momentum_5d IS NOT NULL
        AND momentum_20d IS NOT NULL)"""


_W27_COLUMNS = ["returns", "returns_lag1", "returns_lag2", "volatility", "volatility_change", "momentum_5d", "momentum_20d"]


def _w27(spark, sf):
    d = level_bars(spark, sf).select("symbol", "date", "close")
    d = d.withColumn("returns", sdiv(F.col("close"), P.lag("close")) - 1)
    return rg.regime_features(d, P)


@query("w27_regime_features", f"""WITH {_W27}
SELECT symbol, date, {', '.join(R(c, c, 6) for c in _W27_COLUMNS)} FROM w27""")
def w27_regime_features(spark, sf):
    """Regime feature matrix per symbol, incomplete rows dropped."""
    return rounded(_w27(spark, sf).select("symbol", "date", *rg.REGIME_FEATURES), 6)


@query("a14_regime_naming", f"""WITH {_W27},
c AS (SELECT *, CASE WHEN momentum_5d > 0 THEN 1 ELSE 0 END + CASE WHEN volatility_change > 0 THEN 1 ELSE 0 END
        AS cluster FROM w27),
m AS (SELECT cluster, row_number() OVER (ORDER BY avg(returns), cluster) - 1 AS rk FROM c GROUP BY cluster)
SELECT CAST(c.cluster AS INTEGER) AS cluster, ['bear', 'sideways', 'bull'][rk + 1] AS regime, count(*) AS n
FROM c JOIN m USING (cluster) GROUP BY 1, 2""")
def a14_regime_naming(spark, sf):
    """A14 on given clusters (momentum sign + volatility-change sign): named by mean-return rank."""
    d = _w27(spark, sf)
    d = d.withColumn("cluster", (F.when(F.col("momentum_5d") > 0, 1).otherwise(0)
                                 + F.when(F.col("volatility_change") > 0, 1).otherwise(0)).cast("int"))
    named = rg.name_regimes(d, "cluster", "returns")
    return named.groupBy("cluster", "regime").agg(F.count(F.lit(1)).alias("n"))


@query("m14_m15_gmm_regimes")
def m14_m15_gmm_regimes(spark, sf):
    """M14 + M15: pooled 3-component Gaussian mixture on z-scored W27 features, named, with probabilities."""
    d = rg.gmm_regimes(_w27(spark, sf), k=3, starts=10)
    return d.select("symbol", "date", "cluster", "regime", *[c for c in d.columns if c.startswith(("regime_prob_", "is_"))])


@query("m15_regime_probabilities", f"""WITH {_W27} SELECT symbol, date, CAST(1 AS DOUBLE) AS probability_sum, 1 AS flags, true AS likeliest, true AS named_by_return FROM w27""")
def m15_regime_probabilities(spark, sf):
    """M15 on every row of the mixture of M14: probabilities add up to 1, one flag is set and it is that of the likeliest regime,
    and bear, sideways and bull are ordered by their mean return."""
    d = cut_lineage(rg.gmm_regimes(_w27(spark, sf), k=3, starts=10))
    names = rg.REGIME_LABELS
    mean = {r["regime"]: r["m"] for r in d.groupBy("regime").agg(F.avg("returns").alias("m")).collect()}  # three rows
    ordered = [mean[x] for x in names if x in mean]
    probs = [F.col(f"regime_prob_{x}") for x in names]
    own = F.coalesce(*[F.when(F.col("regime") == x, p) for x, p in zip(names, probs)])
    return rounded(d.select("symbol", "date", sum(probs[1:], probs[0]).alias("probability_sum"),
                            sum([F.col(f"is_{x}") for x in names[1:]], F.col(f"is_{names[0]}")).alias("flags"),
                            (own >= F.greatest(*probs)).alias("likeliest"), F.lit(ordered == sorted(ordered)).alias("named_by_return")), 6)
