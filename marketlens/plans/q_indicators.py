"""Registered indicator and scoring queries (W10-W23, K3, P1-P3) on daily bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.functions.panel import Panel
from marketlens.operators import indicators as ind
from marketlens.operators import recurrence, score
from marketlens.plans.registry import query, rounded
from marketlens.plans.sqlkit import BARS, B, R, W, div, ema, lag, roll
from marketlens.sources.tables import daily_bars

P = Panel()


def _bars(spark, sf):
    return daily_bars(spark, sf)


# ------------------------------------------------------------------ flagship
_SERVE_SQL = f"""WITH RECURSIVE {BARS}, {B},
{ema('e', 'b', 'close', {'e12': 12, 'e26': 26})},
m AS (SELECT b.*, e.e12 - e.e26 AS macd FROM b JOIN e USING (symbol, rn)),
{ema('s', 'm', 'macd', {'macd_signal': 9})},
f AS (
  SELECT m.*, s.macd_signal,
    CASE WHEN count(*) OVER (PARTITION BY m.symbol) < 20 THEN m.close
         ELSE {roll('avg', 'm.close', 20, 'm.symbol', 'm.date')} END AS sma_20,
    m.close - lag(m.close) OVER (PARTITION BY m.symbol ORDER BY m.date) AS d
  FROM m JOIN s USING (symbol, rn)),
g AS (
  SELECT *, {roll('avg', 'CASE WHEN d > 0 THEN d ELSE 0.0 END', 14)} AS gain,
            {roll('avg', 'CASE WHEN d < 0 THEN -d ELSE 0.0 END', 14)} AS loss
  FROM f),
h AS (SELECT *, 100.0 - 100.0 / (1.0 + gain / (CASE WHEN loss = 0 THEN 1.0 ELSE loss END)) AS rsi,
             count(*) OVER (PARTITION BY symbol) AS n_rows FROM g),
l AS (SELECT * FROM h WHERE rn = n_rows - 1),
sg AS (
  SELECT *,
    CASE WHEN coalesce(rsi, 50) < 30 THEN 0.02 WHEN coalesce(rsi, 50) > 70 THEN -0.02 END AS s1,
    CASE WHEN macd IS NOT NULL AND macd_signal IS NOT NULL
         THEN CASE WHEN macd > macd_signal THEN 0.01 ELSE -0.01 END END AS s2,
    CASE WHEN sma_20 IS NOT NULL THEN CASE WHEN close > sma_20 THEN 0.01 ELSE -0.01 END END AS s3,
    0.0 * 0.02 AS s4
  FROM l),
p AS (
  SELECT *, CASE WHEN n_rows < 20 THEN 0.0 ELSE
    (coalesce(s1, 0) + coalesce(s2, 0) + coalesce(s3, 0) + s4) /
    ((s1 IS NOT NULL)::INT + (s2 IS NOT NULL)::INT + (s3 IS NOT NULL)::INT + 1) END AS prediction
  FROM sg)
SELECT symbol, {R('prediction', 'prediction')},
  CASE WHEN prediction >= 0 THEN 'bullish' ELSE 'bearish' END AS direction,
  {R('CASE WHEN prediction <> 0 THEN least(abs(prediction) * 10, 1.0) ELSE 0.5 END', 'confidence')},
  {R('round(close, 2)', 'current_price')}, {R('round(close * (1 + prediction), 2)', 'target_price')},
  date AS timestamp, {R('rsi', 'rsi')}, {R('macd', 'macd')}, {R('macd_signal', 'macd_signal')},
  {R('sma_20', 'sma_20')}, n_rows
FROM p"""


@query("p3_batch_predict", _SERVE_SQL)
def p3_batch_predict(spark, sf):
    """Flagship: bars -> W22 indicators -> latest row per symbol -> P1 rule score -> P2 record."""
    return rounded(score.batch_predict(_bars(spark, sf), P))


# ------------------------------------------------------------------ W10-W20
def _ind_sql(select: str, extra_ctes: str = "", recursive: bool = False) -> str:
    head = "WITH RECURSIVE" if recursive else "WITH"
    ctes = f"{BARS}, {B}" + (f", {extra_ctes}" if extra_ctes else "")
    return f"{head} {ctes} {select}"


@query("w10_sma", _ind_sql(f"""SELECT symbol, date, {R('close', 'close')},
  {R(f"coalesce({roll('avg', 'close', 20)}, close)", 'sma_20')},
  {R(f"coalesce({roll('avg', 'close', 50)}, close)", 'sma_50')} FROM b"""))
def w10_sma(spark, sf):
    d = _bars(spark, sf)
    d = ind.sma(d, P, period=20)
    d = ind.sma(d, P, period=50)
    return rounded(d.select("symbol", "date", "close", "sma_20", "sma_50"))


@query("w11_ema", _ind_sql(f"""SELECT b.symbol, b.date, {R('b.close', 'close')}, {R('e.ema_12', 'ema_12')},
  {R('e.ema_26', 'ema_26')}, {R('e.ema_200', 'ema_200')} FROM b JOIN e USING (symbol, rn)""",
    ema('e', 'b', 'close', {'ema_12': 12, 'ema_26': 26, 'ema_200': 200}), recursive=True))
def w11_ema(spark, sf):
    d = P.prepare(_bars(spark, sf))
    d = recurrence.ema_columns(d, P, {"ema_12": ("close", 12), "ema_26": ("close", 26),
                                      "ema_200": ("close", 200)})
    return rounded(P.finish(d).select("symbol", "date", "close", "ema_12", "ema_26", "ema_200"))


def _gap_ema_sql(spans: dict[str, float]) -> str:
    """pandas' rule row by row: a value k rows after the last one weighs a against q^k."""
    seed = ", ".join(f"CAST(x AS DOUBLE) AS {o}" for o in spans)
    step = ", ".join(
        f"CASE WHEN s.x IS NULL THEN e.{o} WHEN e.{o} IS NULL THEN s.x ELSE "
        f"(pow({1 - 2 / (n + 1)!r}, e.k) * e.{o} + {2 / (n + 1)!r} * s.x) / (pow({1 - 2 / (n + 1)!r}, e.k) + {2 / (n + 1)!r}) END"
        for o, n in spans.items())
    return (f"WITH RECURSIVE {BARS}, b AS (SELECT symbol, date, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS rn, "
            "CASE WHEN day(date) % 5 = 3 OR month(date) = 7 THEN NULL ELSE close END AS x FROM bars), "
            f"e AS (SELECT symbol, rn, 1 AS k, {seed} FROM b WHERE rn = 0 UNION ALL "
            f"SELECT s.symbol, s.rn, CASE WHEN s.x IS NULL THEN e.k + 1 ELSE 1 END, {step} FROM e JOIN b s "
            "ON s.symbol = e.symbol AND s.rn = e.rn + 1) SELECT b.symbol, b.date, "
            + ", ".join(R(o, o) for o in spans) + " FROM b JOIN e USING (symbol, rn)")


@query("w11_ema_gaps", _gap_ema_sql({"ema_12": 12, "ema_26": 26, "ema_200": 200}))
def w11_ema_gaps(spark, sf):
    """W11 over a series with missing days and a missing month each year: the average carries over gaps."""
    gone = (F.dayofmonth("date") % 5 == 3) | (F.month("date") == 7)
    d = daily_bars(spark, sf).withColumn("close", F.when(~gone, F.col("close")))
    d = P.prepare(d)
    d = recurrence.ema_columns(d, P, {f"ema_{n}": ("close", n) for n in (12, 26, 200)})
    return rounded(P.finish(d).select("symbol", "date", "ema_12", "ema_26", "ema_200"))


_MACD_CTES = (ema('e', 'b', 'close', {'e12': 12, 'e26': 26}) +
              ", m AS (SELECT b.symbol, b.date, b.rn, b.close, e.e12 - e.e26 AS macd_line "
              "FROM b JOIN e USING (symbol, rn)), " + ema('s', 'm', 'macd_line', {'macd_signal': 9}))


@query("w12_macd", _ind_sql(f"""SELECT m.symbol, m.date, {R('m.close', 'close')}, {R('m.macd_line', 'macd_line')},
  {R('s.macd_signal', 'macd_signal')}, {R('m.macd_line - s.macd_signal', 'macd_histogram')}
  FROM m JOIN s USING (symbol, rn)""", _MACD_CTES, recursive=True))
def w12_macd(spark, sf):
    d = ind.macd(_bars(spark, sf), P)
    return rounded(d.select("symbol", "date", "close", "macd_line", "macd_signal", "macd_histogram"))


@query("w13_rsi", _ind_sql(f"""SELECT symbol, date, {R('close', 'close')},
  {R("CASE WHEN n < 14 THEN NULL ELSE coalesce(100.0 * g / nullif(g + l, 0), 50.0) END", 'rsi_14')}
  FROM (SELECT *, {roll('avg', 'CASE WHEN d > 0 THEN d ELSE 0.0 END', 14)} AS g,
                  {roll('avg', 'CASE WHEN d < 0 THEN -d ELSE 0.0 END', 14)} AS l
        FROM (SELECT *, close - {lag('close')} AS d, count(*) OVER (PARTITION BY symbol) AS n FROM b))"""))
def w13_rsi(spark, sf):
    d = ind.rsi(_bars(spark, sf), P)
    return rounded(d.select("symbol", "date", "close", "rsi_14"))


@query("w14_bollinger", _ind_sql(f"""SELECT symbol, date, {R('close', 'close')},
  {R(f"coalesce(m + 2 * s, close)", 'bb_upper')}, {R('coalesce(m, close)', 'bb_middle')},
  {R(f"coalesce(m - 2 * s, close)", 'bb_lower')}
  FROM (SELECT *, {roll('avg', 'close', 20)} AS m, {roll('stddev_samp', 'close', 20)} AS s FROM b)"""))
def w14_bollinger(spark, sf):
    d = ind.bollinger(_bars(spark, sf), P)
    return rounded(d.select("symbol", "date", "close", "bb_upper", "bb_middle", "bb_lower"))


_TR = f"greatest(high - low, abs(high - {lag('close')}), abs(low - {lag('close')}))"


@query("w15_atr", _ind_sql(f"""SELECT symbol, date, {R('close', 'close')},
  {R(f"coalesce({roll('avg', 'tr', 14)}, avg(tr) OVER (PARTITION BY symbol))", 'atr_14')}
  FROM (SELECT *, {_TR} AS tr FROM b)"""))
def w15_atr(spark, sf):
    d = ind.atr(_bars(spark, sf), P)
    return rounded(d.select("symbol", "date", "close", "atr_14"))


@query("w16_w17_momentum_roc", _ind_sql(f"""SELECT symbol, date, {R('close', 'close')},
  {R(f"coalesce(close - {lag('close', 10)}, 0.0)", 'momentum_10')},
  {R(f"coalesce(100.0 * {div(f'close - {lag("close", 12)}', lag('close', 12))}, 0.0)", 'roc_12')} FROM b"""))
def w16_w17_momentum_roc(spark, sf):
    d = ind.roc(ind.momentum(_bars(spark, sf), P), P)
    return rounded(d.select("symbol", "date", "close", "momentum_10", "roc_12"))


@query("w18_stochastic", _ind_sql(f"""SELECT symbol, date, {R('close', 'close')},
  {R('coalesce(ks, 50.0)', 'stoch_k')}, {R(f"coalesce({roll('avg', 'ks', 3)}, 50.0)", 'stoch_d')}
  FROM (SELECT *, {roll('avg', 'k', 3)} AS ks FROM (
    SELECT *, 100.0 * {div(f"close - {roll('min', 'low', 14)}", f"{roll('max', 'high', 14)} - {roll('min', 'low', 14)}")} AS k
    FROM b))"""))
def w18_stochastic(spark, sf):
    d = ind.stochastic(_bars(spark, sf), P)
    return rounded(d.select("symbol", "date", "close", "stoch_k", "stoch_d"))


@query("w19_williams_r", _ind_sql(f"""SELECT symbol, date, {R('close', 'close')},
  {R(f"coalesce(-100.0 * {div(f"{roll('max', 'high', 14)} - close", f"{roll('max', 'high', 14)} - {roll('min', 'low', 14)}")}, -50.0)", 'williams_r')}
  FROM b"""))
def w19_williams_r(spark, sf):
    d = ind.williams_r(_bars(spark, sf), P)
    return rounded(d.select("symbol", "date", "close", "williams_r"))


@query("w20_adx", _ind_sql(f"""SELECT symbol, date, {R('close', 'close')},
  {R(f"coalesce({roll('avg', 'dx', 14)}, 20.0)", 'adx_14')}
  FROM (SELECT *, 100.0 * {div('abs(pdi - mdi)', 'pdi + mdi')} AS dx FROM (
    SELECT *, 100.0 * {div(roll('avg', 'pdm', 14), 'atr')} AS pdi, 100.0 * {div(roll('avg', 'mdm', 14), 'atr')} AS mdi
    FROM (SELECT *, {roll('avg', 'tr', 14)} AS atr FROM (
      SELECT *, {_TR} AS tr,
        CASE WHEN high - {lag('high')} < 0 THEN 0.0 ELSE high - {lag('high')} END AS pdm,
        CASE WHEN {lag('low')} - low < 0 THEN 0.0 ELSE {lag('low')} - low END AS mdm FROM b))))"""))
def w20_adx(spark, sf):
    d = ind.adx(_bars(spark, sf), P)
    return rounded(d.select("symbol", "date", "close", "adx_14"))


# ------------------------------------------------------------------ W21
COARSE: dict[str, int] = {}


def _w21_sql() -> str:
    fills = dict.fromkeys(
        ["sma_5", "sma_10", "sma_20", "sma_50", "ema_12", "ema_26", "ema_20", "bb_middle", "bb_upper", "bb_lower", "bb_width",
         "macd_line", "macd_signal", "macd_histogram", "momentum_10", "roc_12", "atr_14", "volume_sma_20", "volume_ratio",
         "obv", "vwap", "price_vs_sma_20", "price_vs_sma_50"], 0.0)
    fills |= {"bb_pct": 0.5, "rsi_14": 50.0, "stoch_k": 50.0, "stoch_d": 50.0, "williams_r": -50.0, "adx_14": 20.0,
              "plus_di": 20.0, "minus_di": 20.0}
    ctes = (ema('e', 'b', 'close', {'ema_12': 12, 'ema_26': 26, 'ema_20': 20}) + ", " +
            f"""x1 AS (SELECT b.*, e.ema_12, e.ema_26, e.ema_20, e.ema_12 - e.ema_26 AS macd_line,
      {roll('avg', 'close', 5, 'b.symbol', 'b.date')} AS sma_5, {roll('avg', 'close', 10, 'b.symbol', 'b.date')} AS sma_10,
      {roll('avg', 'close', 20, 'b.symbol', 'b.date')} AS sma_20, {roll('avg', 'close', 50, 'b.symbol', 'b.date')} AS sma_50,
      {roll('stddev_samp', 'close', 20, 'b.symbol', 'b.date')} AS std20,
      close - lag(close) OVER (PARTITION BY b.symbol ORDER BY b.date) AS d,
      {_TR.replace('symbol', 'b.symbol').replace('date', 'b.date')} AS tr,
      CASE WHEN high - lag(high) OVER (PARTITION BY b.symbol ORDER BY b.date) > 0
           THEN high - lag(high) OVER (PARTITION BY b.symbol ORDER BY b.date) ELSE 0.0 END AS pdm,
      CASE WHEN lag(low) OVER (PARTITION BY b.symbol ORDER BY b.date) - low > 0
           THEN lag(low) OVER (PARTITION BY b.symbol ORDER BY b.date) - low ELSE 0.0 END AS mdm,
      {roll('min', 'low', 14, 'b.symbol', 'b.date')} AS ll, {roll('max', 'high', 14, 'b.symbol', 'b.date')} AS hh,
      close - lag(close, 10) OVER (PARTITION BY b.symbol ORDER BY b.date) AS momentum_10,
      100.0 * (close - lag(close, 12) OVER (PARTITION BY b.symbol ORDER BY b.date))
            / nullif(lag(close, 12) OVER (PARTITION BY b.symbol ORDER BY b.date), 0) AS roc_12,
      CASE WHEN close > lag(close) OVER (PARTITION BY b.symbol ORDER BY b.date) THEN 1.0
           WHEN close < lag(close) OVER (PARTITION BY b.symbol ORDER BY b.date) THEN -1.0 ELSE 0.0 END AS dir
      FROM b JOIN e USING (symbol, rn)), """ +
            ema('s', 'x1', 'macd_line', {'macd_signal': 9}) + ", " +
            f"""x2 AS (SELECT x1.*, s.macd_signal, x1.macd_line - s.macd_signal AS macd_histogram,
      x1.sma_20 AS bb_middle, x1.sma_20 + 2 * std20 AS bb_upper, x1.sma_20 - 2 * std20 AS bb_lower,
      100.0 * {div(roll('avg', 'CASE WHEN d > 0 THEN d ELSE 0.0 END', 14), roll('avg', 'CASE WHEN d > 0 THEN d ELSE 0.0 END', 14) + ' + ' + roll('avg', 'CASE WHEN d < 0 THEN -d ELSE 0.0 END', 14))} AS rsi_14,
      100.0 * {div('close - ll', 'hh - ll')} AS stoch_k, -100.0 * {div('hh - close', 'hh - ll')} AS williams_r,
      {roll('avg', 'tr', 14)} AS atr_14,
      {roll('avg', 'volume', 20)} AS volume_sma_20,
      sum(volume * dir) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS obv,
      {div(roll('sum', 'close * volume', 20), roll('sum', 'volume', 20))} AS vwap,
      {roll('avg', 'pdm', 14)} AS apdm, {roll('avg', 'mdm', 14)} AS amdm
      FROM x1 JOIN s USING (symbol, rn)),
x3 AS (SELECT *, {div('bb_upper - bb_lower', 'bb_middle')} AS bb_width,
      {div('close - bb_lower', 'bb_upper - bb_lower')} AS bb_pct,
      {roll('avg', 'stoch_k', 3)} AS stoch_d,
      100.0 * {div('apdm', 'atr_14')} AS plus_di, 100.0 * {div('amdm', 'atr_14')} AS minus_di,
      {div('volume', 'volume_sma_20')} AS volume_ratio,
      100.0 * {div('close - sma_20', 'sma_20')} AS price_vs_sma_20,
      100.0 * {div('close - sma_50', 'sma_50')} AS price_vs_sma_50 FROM x2),
x4 AS (SELECT *, {roll('avg', '100.0 * ' + div('abs(plus_di - minus_di)', 'plus_di + minus_di'), 14)} AS adx_14 FROM x3)""")
    cols = ", ".join(R(f"coalesce({n}, {fills[n]!r})", n, COARSE.get(n, 4)) for n in ind.ALL_INDICATORS)
    return f"WITH RECURSIVE {BARS}, {B}, {ctes} SELECT symbol, date, {R('close', 'close')}, {cols} FROM x4"


@query("w21_all_indicators", _w21_sql())
def w21_all_indicators(spark, sf):
    d = ind.all_indicators(_bars(spark, sf), P)
    return rounded(d.select("symbol", "date", "close", *ind.ALL_INDICATORS), coarse=COARSE)


@query("w22_w23_serving_features", f"""WITH RECURSIVE {BARS}, {B}, {_MACD_CTES.replace('macd_signal', 'sig')},
f AS (SELECT m.symbol, m.date, m.rn, m.close, m.macd_line AS macd, s.sig AS macd_signal FROM m JOIN s USING (symbol, rn)),
g AS (SELECT f.*, b.volume, f.close - lag(f.close) OVER (PARTITION BY f.symbol ORDER BY f.date) AS d,
  count(*) OVER (PARTITION BY f.symbol) AS n FROM f JOIN b USING (symbol, rn))
SELECT symbol, date, {R('close', 'close')},
  {R(f"CASE WHEN n < 20 THEN close ELSE {roll('avg', 'close', 20)} END", 'sma_20')},
  {R(f"100.0 - 100.0 / (1.0 + {roll('avg', 'CASE WHEN d > 0 THEN d ELSE 0.0 END', 14)} / CASE WHEN {roll('avg', 'CASE WHEN d < 0 THEN -d ELSE 0.0 END', 14)} = 0 THEN 1.0 ELSE {roll('avg', 'CASE WHEN d < 0 THEN -d ELSE 0.0 END', 14)} END)", 'rsi')},
  {R('macd', 'macd')}, {R('macd_signal', 'macd_signal')},
  {', '.join(R(lag('close', k), f'close_lag_{k}') for k in (1, 2, 3, 5, 10))},
  {', '.join(R(lag('volume', k), f'volume_lag_{k}') for k in (1, 2, 3))}
FROM g""")
def w22_w23_serving_features(spark, sf):
    d = ind.serving_lags(ind.serving_indicators(_bars(spark, sf), P), P)
    cols = ["symbol", "date", "close", "sma_20", "rsi", "macd", "macd_signal",
            *[f"close_lag_{k}" for k in (1, 2, 3, 5, 10)], *[f"volume_lag_{k}" for k in (1, 2, 3)]]
    return rounded(d.select(*cols))


@query("k3_latest_per_symbol", f"""WITH {BARS}
SELECT symbol, date, {R('open', 'open')}, {R('high', 'high')}, {R('low', 'low')}, {R('close', 'close')},
  {R('volume', 'volume')}, n_rows FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS r,
         count(*) OVER (PARTITION BY symbol) AS n_rows FROM bars) WHERE r = 1""")
def k3_latest_per_symbol(spark, sf):
    return rounded(score.latest(_bars(spark, sf), P))


__all__ = ["W", "F"]
