"""Registered data-quality, cleaning, payload and set queries (V*, A5-A9, A15, A18, A19, C*, S6-S10, U*, J6)."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlens.functions.panel import Panel
from marketlens.operators import aggregates as ag
from marketlens.operators import checks as ck
from marketlens.operators import clean as cl
from marketlens.operators import features as fe
from marketlens.plans.registry import query, rounded
from marketlens.plans.sqlkit import BARS, LEVEL, R, lag, lead, roll
from marketlens.sources import payloads as pl
from marketlens.sources.tables import daily_bars, hourly_bars, level_bars, news_articles, table

P = Panel()

# ------------------------------------------------------------------ V1 / A8
_V1_SQL = f"""WITH {BARS},
q AS (SELECT symbol, quantile_cont(close, 0.25) AS q1c, quantile_cont(close, 0.75) AS q3c,
             quantile_cont(volume, 0.25) AS q1v, quantile_cont(volume, 0.75) AS q3v FROM bars GROUP BY symbol),
f AS (SELECT b.*,
        coalesce(close < q1c - 1.5 * (q3c - q1c) OR close > q3c + 1.5 * (q3c - q1c), false)
        OR coalesce(volume < q1v - 1.5 * (q3v - q1v) OR volume > q3v + 1.5 * (q3v - q1v), false) AS is_outlier,
        date_diff('day', lag(date) OVER (PARTITION BY symbol ORDER BY date), date) AS gap
      FROM bars b JOIN q USING (symbol)),
g AS (SELECT symbol, count(*) AS n_rows, count_if(high < low) AS high_lt_low, count_if(volume = 0) AS zero_volume,
        count_if(open IS NULL) + count_if(high IS NULL) + count_if(low IS NULL) + count_if(close IS NULL)
          + count_if(volume IS NULL) AS null_cells,
        count_if(is_outlier) AS outliers,
        count_if(open < 0) + count_if(high < 0) + count_if(low < 0) + count_if(close < 0) + count_if(volume < 0)
          AS negative_values,
        count_if(symbol IS NULL OR length(symbol) < 1 OR length(symbol) > 5) AS bad_symbol,
        max(CASE WHEN gap = 1 THEN 1 ELSE 0 END) AS has_step FROM f GROUP BY symbol),
r AS (SELECT *,
  concat_ws('; ',
    CASE WHEN high_lt_low > 0 THEN printf('high below low: %d rows', high_lt_low) END,
    CASE WHEN zero_volume > n_rows * 0.1 THEN printf('volume is zero: %d rows', zero_volume) END,
    CASE WHEN null_cells > 0 THEN printf('empty cells: %d', null_cells) END,
    CASE WHEN outliers > 0 THEN printf('close or volume outside the quartile fences: %d rows', outliers) END,
    CASE WHEN n_rows > 1 AND has_step = 0 THEN 'no two rows are one day apart' END) AS warnings_text,
  (CASE WHEN high_lt_low > 0 THEN 1 ELSE 0 END) + (CASE WHEN zero_volume > n_rows * 0.1 THEN 1 ELSE 0 END)
    + (CASE WHEN null_cells > 0 THEN 1 ELSE 0 END) + (CASE WHEN outliers > 0 THEN 1 ELSE 0 END)
    + (CASE WHEN n_rows > 1 AND has_step = 0 THEN 1 ELSE 0 END) AS n_warnings,
  (CASE WHEN negative_values > 0 THEN 1 ELSE 0 END) + (CASE WHEN bad_symbol > 0 THEN 1 ELSE 0 END) AS n_errors
  FROM g)"""


def _v1(spark, sf):
    rep = ck.stock_contract(daily_bars(spark, sf))
    return rep.withColumn("warnings_text", F.concat_ws("; ", "warnings"))


@query("v1_stock_contract", _V1_SQL + """
SELECT symbol, n_rows, CAST(high_lt_low AS BIGINT) AS high_lt_low, CAST(zero_volume AS BIGINT) AS zero_volume,
  CAST(null_cells AS BIGINT) AS null_cells, CAST(outliers AS BIGINT) AS outliers,
  CAST(negative_values AS BIGINT) AS negative_values, CAST(bad_symbol AS BIGINT) AS bad_symbol,
  warnings_text, CAST(n_warnings AS INTEGER) AS n_warnings, CAST(n_errors AS INTEGER) AS n_errors,
  n_errors = 0 AS is_valid FROM r""")
def v1_stock_contract(spark, sf):
    """V1 per symbol in one grouped aggregate (plus per-symbol quartiles for the IQR rule)."""
    return _v1(spark, sf).select("symbol", "n_rows", "high_lt_low", "zero_volume", "null_cells", "outliers",
                                 "negative_values", "bad_symbol", "warnings_text", "n_warnings", "n_errors",
                                 "is_valid")


@query("a8_validation_summary", _V1_SQL + f"""
SELECT count(*) AS total_validations, CAST(count_if(n_errors = 0) AS BIGINT) AS passed,
  CAST(count_if(n_errors > 0) AS BIGINT) AS failed,
  {R('100.0 * count_if(n_errors = 0) / count(*)', 'success_rate')},
  CAST(sum(n_warnings) AS BIGINT) AS total_warnings, CAST(sum(n_errors) AS BIGINT) AS total_errors FROM r""")
def a8_validation_summary(spark, sf):
    """A8 over the V1 report rows."""
    return rounded(ck.validation_summary(ck.stock_contract(daily_bars(spark, sf))))


_FX = """fx AS (SELECT upper(substr(event_type, 1, 3)) || 'USD' AS pair, date_trunc('hour', ts) AS date,
  arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low, arg_max(value, event_id) AS close
  FROM events GROUP BY 1, 2)"""


@query("v2_forex_contract", f"""WITH {_FX}
SELECT pair, count(*) AS n_rows, CAST(count_if(high < low) AS BIGINT) AS high_lt_low,
  CAST(count_if(close < 0.01 OR close > 500) AS BIGINT) AS unusual_close,
  CAST(count_if(open IS NULL) + count_if(high IS NULL) + count_if(low IS NULL) + count_if(close IS NULL) AS BIGINT) AS null_cells,
  CAST(count_if(high < low) > 0 AS INTEGER) + CAST(count_if(close < 0.01 OR close > 500) > 0 AS INTEGER)
    + CAST(count_if(open IS NULL) + count_if(high IS NULL) + count_if(low IS NULL) + count_if(close IS NULL) > 0 AS INTEGER)
    AS n_warnings,
  count_if(open < 0) + count_if(high < 0) + count_if(low < 0) + count_if(close < 0) = 0
    AND count_if(length(pair) <> 6) = 0 AS is_valid
FROM fx GROUP BY pair""")
def v2_forex_contract(spark, sf):
    """V2 per pair on hourly FX-style bars derived from events."""
    b = hourly_bars(spark, sf).withColumn("pair", F.concat(F.upper(F.substring("symbol", 1, 3)), F.lit("USD")))
    rep = ck.forex_contract(b.drop("symbol"))
    return rep.select("pair", "n_rows", "high_lt_low", "unusual_close", "null_cells", "n_warnings", "is_valid")


_CRYPTO = """cr AS (SELECT event_type AS coin_id, date_trunc('hour', ts) AS timestamp,
  arg_max(value, event_id) AS price, arg_max(value, event_id) * count(*) AS market_cap, CAST(count(*) AS DOUBLE) AS volume
  FROM events GROUP BY 1, 2)"""


@query("v3_crypto_contract", f"""WITH {_CRYPTO},
q AS (SELECT coin_id, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM cr GROUP BY 1)
SELECT coin_id, count(*) AS n_rows, CAST(count_if(price <= 0) AS BIGINT) AS non_positive_price,
  CAST(count_if(price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS outliers,
  count_if(price <= 0) = 0 AND count_if(price < 0 OR market_cap < 0 OR volume < 0) = 0 AS is_valid
FROM cr JOIN q USING (coin_id) GROUP BY coin_id""")
def v3_crypto_contract(spark, sf):
    """V3 per coin (the DAG validates each coin) on hourly ticks derived from events."""
    hb = hourly_bars(spark, sf)
    c = hb.select(F.col("symbol").alias("coin_id"), F.col("date").alias("timestamp"), F.col("close").alias("price"),
                  (F.col("close") * F.col("volume")).alias("market_cap"), "volume")
    rep = ck.crypto_contract(c)
    return rep.select("coin_id", "n_rows", "non_positive_price", "outliers", "is_valid")


@query("v4_news_contract", """SELECT count(*) AS n_rows,
  CAST(count_if(title IS NULL OR ts IS NULL) AS BIGINT) AS missing_required,
  CAST(count_if(trim(title) = '') AS BIGINT) AS empty_titles,
  CAST(count_if(ts > TIMESTAMP '2024-01-20 00:00:00') AS BIGINT) AS future_dates,
  count_if(title IS NULL OR ts IS NULL) = 0 AS is_valid
FROM (SELECT CASE event_type WHEN 'purchase' THEN 'a' WHEN 'signup' THEN 'b' WHEN 'error' THEN 'c'
  WHEN 'click' THEN 'd' WHEN 'view' THEN 'e' END AS title, ts FROM events)""")
def v4_news_contract(spark, sf):
    """V4 over all articles; dates after the as-of date count as future."""
    rep = ck.news_contract(news_articles(spark, sf), as_of="2024-01-20 00:00:00")
    return rep.select("n_rows", "missing_required", "empty_titles", "future_dates", "is_valid")


@query("v5_v6_range_completeness", """SELECT count(*) AS n_rows, min(o_orderdate) AS min_date, max(o_orderdate) AS max_date,
  min(o_orderdate) >= TIMESTAMP '1992-01-01' AND max(o_orderdate) <= TIMESTAMP '1998-12-31' AS range_ok,
  count(*) >= 1000 AS complete_ok FROM orders""")
def v5_v6_range_completeness(spark, sf):
    """V5 date-range and V6 completeness checks on ``orders``."""
    o = table(spark, sf, "orders")
    r = ck.date_range_check(o, "o_orderdate", "1992-01-01", "1998-12-31")
    req = ["o_orderkey", "o_orderdate", "o_totalprice"]
    present = all(c in o.columns for c in req)     # V6 schema part; the row count comes from V5's aggregate
    return r.select("n_rows", F.col("min_date").cast("timestamp_ntz").alias("min_date"),
                    F.col("max_date").cast("timestamp_ntz").alias("max_date"), F.col("is_valid").alias("range_ok"),
                    (F.lit(present) & (F.col("n_rows") >= 1000)).alias("complete_ok"))


@query("v6_completeness", """SELECT count(*) AS n_rows, CAST(1 AS INTEGER) AS missing_columns, 'dividend' AS missing, false AS is_valid FROM orders""")
def v6_completeness(spark, sf):
    """V6: required columns and least number of rows; orders have no dividend."""
    o = table(spark, sf, "orders").withColumnRenamed("o_totalprice", "close")
    out = ck.completeness_check(o, ["o_orderdate", "close", "dividend"], 100)
    return out.select("n_rows", "missing_columns", F.array_join("missing", ",").alias("missing"), "is_valid")


@query("v7_validate", f"""WITH {BARS}, h AS (SELECT event_type AS coin_id, value AS price FROM events),
st AS (SELECT symbol, count(*) AS n, length(symbol) NOT BETWEEN 1 AND 5 OR min(least(open, high, low, close, volume)) < 0 AS bad FROM bars GROUP BY symbol),
cr AS (SELECT coin_id, count(*) AS n, min(price) <= 0 AS bad FROM h GROUP BY coin_id),
nw AS (SELECT count(*) AS n, bool_or(title IS NULL) AS bad FROM (SELECT CASE WHEN event_type IN ('purchase', 'signup', 'error', 'click', 'view') THEN 'x' END AS title FROM events)),
al AS (SELECT 'stocks' AS data_type, n, bad FROM st UNION ALL SELECT 'crypto', n, bad FROM cr UNION ALL SELECT 'news', n, bad FROM nw
  UNION ALL SELECT 'bonds', 0, true)
SELECT data_type, count(*) AS reports, CAST(sum(n) AS BIGINT) AS n_rows, CAST(count_if(NOT bad) AS BIGINT) AS valid FROM al GROUP BY data_type""")
def v7_validate(spark, sf):
    """V7: one dispatch for all contracts; a type without a contract is a report that is not valid."""
    events = table(spark, sf, "events")
    frames = {"stocks": daily_bars(spark, sf), "crypto": events.select(F.col("event_type").alias("coin_id"), F.col("value").alias("price")),
              "news": news_articles(spark, sf), "bonds": events}
    out = None
    for kind, d in frames.items():
        r = ck.validate(d, kind)
        r = r.select(F.lit(kind).alias("data_type"), (F.col("n_rows") if "n_rows" in r.columns else F.lit(0)).cast("long").alias("n"), "is_valid")
        out = r if out is None else out.unionByName(r)
    return out.groupBy("data_type").agg(F.count(F.lit(1)).alias("reports"), F.sum("n").alias("n_rows"), F.count_if("is_valid").alias("valid"))


# ------------------------------------------------------------------ A5 - A7, A9, A15, A19
def _wide_profile_sql() -> str:
    """All columns of lineitem; numbers have statistics, other types their counts."""
    cols = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double"),
            ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"), ("l_shipdate", "other")]
    parts = []
    for c, t in cols:
        num = t in ("bigint", "int", "double")
        stats = [R(f"{fn}({c})" if num else "NULL", n) for n, fn in (("min", "min"), ("max", "max"), ("mean", "avg"), ("std", "stddev_samp"))]
        parts.append(f"SELECT '{c}' AS \"column\", count({c}) AS non_null_count, count(*) - count({c}) AS null_count, {', '.join(stats)}, "
                     f"count(DISTINCT {c}) AS unique_values FROM lineitem")
    return " UNION ALL ".join(parts)


@query("a5_wide_profile", _wide_profile_sql())
def a5_wide_profile(spark, sf):
    """A5 of a wide table: distinct values of all columns by (column, hash), without a copy of each row for each column."""
    d = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                                            "l_tax", "l_returnflag", "l_shipdate")
    return rounded(ck.profile(d).drop("dtype", "null_percentage"))


def _profile_sql() -> str:
    cols = [("c_custkey", "bigint", True), ("c_name", "string", False), ("c_nationkey", "int", True),
            ("c_acctbal", "double", True), ("c_mktsegment", "string", False)]
    parts = []
    for c, t, num in cols:
        stats = (f"{R(f'min({c})', 'min')}, {R(f'max({c})', 'max')}, {R(f'avg({c})', 'mean')}, "
                 f"{R(f'stddev_samp({c})', 'std')}") if num else \
            "CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std"
        parts.append(f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null_count, "
                     f"CAST(count_if({c} IS NULL) AS BIGINT) AS null_count, {R(f'100.0 * count_if({c} IS NULL) / count(*)', 'null_percentage')}, "
                     f"{stats}, count(DISTINCT {c}) AS unique_values FROM customer")
    return " UNION ALL ".join(parts)


@query("a5_column_profile", _profile_sql())
def a5_column_profile(spark, sf):
    """A5: one aggregate over all columns of ``customer``, stacked to one row per column."""
    return rounded(ck.profile(table(spark, sf, "customer")))


@query("a6_iqr_outliers", """WITH q AS (SELECT quantile_cont(l_quantity, 0.25) AS a1, quantile_cont(l_quantity, 0.75) AS a3,
  quantile_cont(l_extendedprice, 0.25) AS b1, quantile_cont(l_extendedprice, 0.75) AS b3 FROM lineitem)
SELECT l_orderkey, l_linenumber FROM lineitem, q
WHERE l_quantity < a1 - 1.5 * (a3 - a1) OR l_quantity > a3 + 1.5 * (a3 - a1)
   OR l_extendedprice < b1 - 1.5 * (b3 - b1) OR l_extendedprice > b3 + 1.5 * (b3 - b1)""")
def a6_iqr_outliers(spark, sf):
    """Global linear quartiles (one aggregate row), then a filter over every row."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return ck.iqr_outliers(li, ["l_quantity", "l_extendedprice"]).where("is_outlier") \
        .select("l_orderkey", "l_linenumber")


@query("a7_zscore_outliers", """SELECT o_orderkey, o_orderpriority FROM (
  SELECT *, abs(o_totalprice - avg(o_totalprice) OVER (PARTITION BY o_orderpriority))
            / stddev_samp(o_totalprice) OVER (PARTITION BY o_orderpriority) AS z FROM orders) WHERE z > 3""")
def a7_zscore_outliers(spark, sf):
    """A7 per priority group: |z| > 3 with the sample std (group stats joined by key)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return ck.zscore_outliers(o, ["o_totalprice"], keys=["o_orderpriority"]).where("is_outlier") \
        .select("o_orderkey", "o_orderpriority")


@query("a9_feature_quality", f"""WITH {BARS}, f AS (SELECT symbol, date, volume,
  {lag('volume', 1)} AS volume_lag_1, {roll('avg', 'volume', 20)} AS volume_rolling_20_mean FROM bars)
SELECT count(*) AS n_rows, 5 AS n_columns,
  {R('100.0 * (count_if(volume_lag_1 IS NULL) + count_if(volume_rolling_20_mean IS NULL)) / (count(*) * 5)', 'null_percentage')},
  CAST(0 AS BIGINT) AS inf_values,
  CAST(stddev_samp(volume) = 0 AS INTEGER) + CAST(stddev_samp(volume_lag_1) = 0 AS INTEGER)
    + CAST(stddev_samp(volume_rolling_20_mean) = 0 AS INTEGER) AS constant_columns,
  CASE WHEN 100.0 * (count_if(volume_lag_1 IS NULL) + count_if(volume_rolling_20_mean IS NULL)) / (count(*) * 5) < 5
       THEN 'passed' ELSE 'failed' END AS status FROM f""")
def a9_feature_quality(spark, sf):
    """A9 on a small feature frame (lag and rolling mean of volume)."""
    d = daily_bars(spark, sf).select("symbol", "date", "volume")
    d = fe.rolling_features(fe.lag_features(d, P, ["volume"], [1]), P, ["volume"], [20], ["mean"])
    return rounded(ck.feature_quality(d))


@query("a15_class_balance", f"""WITH {BARS}, {LEVEL}
SELECT direction_class_5d, count(*) AS count FROM (
  SELECT CASE WHEN r > 0.005 THEN 1 WHEN r < -0.005 THEN -1 ELSE 0 END AS direction_class_5d
  FROM (SELECT {lead('close', 5)} / nullif(close, 0) - 1 AS r FROM lb)) GROUP BY 1""")
def a15_class_balance(spark, sf):
    """Value counts of the 5-row direction class on the level series."""
    from marketlens.operators import labels as lb
    d = lb.direction_labels(lb.forward_returns(level_bars(spark, sf), P, horizons=(5,)))
    return ag.class_balance(d, "direction_class_5d")


@query("a19_day_gaps", f"""WITH {BARS}
SELECT gap_days, count(*) AS count FROM (
  SELECT date_diff('day', lag(date) OVER (PARTITION BY symbol ORDER BY date), date) AS gap_days FROM bars)
WHERE gap_days IS NOT NULL GROUP BY 1""")
def a19_day_gaps(spark, sf):
    """Histogram of day steps between consecutive bars of each symbol."""
    return ag.day_gaps(daily_bars(spark, sf), P).select(F.col("gap_days").cast("bigint").alias("gap_days"), "count")


# ------------------------------------------------------------------ cleaning
_SPINE_SQL = f"""{BARS},
sp AS (SELECT symbol, unnest(generate_series(min(date), max(date), INTERVAL 1 DAY))::DATE AS date FROM bars GROUP BY symbol),
j AS (SELECT sp.symbol, sp.date, b.close, b.volume FROM sp LEFT JOIN bars b USING (symbol, date))"""


@query("c7_ffill_calendar", f"""WITH {_SPINE_SQL}
SELECT symbol, date,
  {R("coalesce(last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0)", 'close')},
  {R("coalesce(last_value(volume IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0)", 'volume')}
FROM j""")
def c7_ffill_calendar(spark, sf):
    """J6 calendar spine per symbol + C7 forward fill within the symbol, then 0."""
    b = daily_bars(spark, sf).select("symbol", "date", "close", "volume")
    spine = ag.calendar_spine(b, "date", "day", ["symbol"]).withColumn("date", F.to_date("date"))
    j = ag.left_attach(spine, b, ["symbol", "date"])
    return rounded(cl.ffill_then_zero(j, P, ["close", "volume"]))


_FEAT_SQL = f"""{BARS}, f AS (SELECT symbol, date, close, {lag('close', 1)} AS l1, {lag('close', 7)} AS l7,
  {roll('avg', 'close', 20)} AS m20 FROM bars)"""


@query("c4_c5_drop_rows", f"""WITH {_FEAT_SQL}
SELECT symbol, date, {R('close', 'close')}, 'sparse' AS rule FROM f
WHERE (CASE WHEN l1 IS NULL THEN 0 ELSE 1 END) + (CASE WHEN l7 IS NULL THEN 0 ELSE 1 END)
    + (CASE WHEN m20 IS NULL THEN 0 ELSE 1 END) + 3 >= 4
UNION ALL SELECT symbol, date, {R('close', 'close')}, 'any' AS rule FROM f
WHERE l1 IS NOT NULL AND l7 IS NOT NULL AND m20 IS NOT NULL""")
def c4_c5_drop_rows(spark, sf):
    """C4 (thresh = int(6 * 0.7)) and C5 (any NULL) on a small feature frame."""
    d = daily_bars(spark, sf).select("symbol", "date", "close")
    d = d.withColumns({"l1": P.lag("close", 1), "l7": P.lag("close", 7),
                       "m20": P.roll(F.avg, "close", 20)})
    a = cl.drop_sparse_rows(d, 0.7).select("symbol", "date", "close", F.lit("sparse").alias("rule"))
    b = cl.drop_null_rows(d).select("symbol", "date", "close", F.lit("any").alias("rule"))
    return rounded(a.unionByName(b))


@query("c6_c8_c9_fill_scale", f"""WITH {_FEAT_SQL},
g AS (SELECT *, close / nullif(l7 - l7, 0) AS ratio FROM f),
s AS (SELECT median(m20) AS med, avg(close) AS mc, stddev_samp(close) AS sc, stddev_pop(close) AS pc FROM g)
SELECT symbol, date, {R('coalesce(ratio, 0.0)', 'ratio')}, {R('coalesce(m20, med)', 'm20')},
  {R('(close - mc) / sc', 'z1')}, {R('(close - mc) / pc', 'z0')} FROM g, s""")
def c6_c8_c9_fill_scale(spark, sf):
    """C6 (x/0 -> missing -> 0), C8 median imputation, C9 z-score with ddof 1 and 0."""
    d = daily_bars(spark, sf).select("symbol", "date", "close")
    d = d.withColumns({"l7": P.lag("close", 7), "m20": P.roll(F.avg, "close", 20)})
    d = d.withColumn("ratio", F.try_divide(F.col("close"), F.col("l7") - F.col("l7")))
    d = cl.replace_inf_fill(d, ["ratio"])
    d = cl.median_impute(d, ["m20"])
    d = cl.zscore(d, ["close"], ddof=1, suffix="_z1")
    d = cl.zscore(d, ["close"], ddof=0, suffix="_z0")
    return rounded(d.select("symbol", "date", "ratio", "m20", F.col("close_z1").alias("z1"),
                            F.col("close_z0").alias("z0")))


@query("c1_c2_c3_feature_projection", f"""WITH {BARS}
SELECT symbol, {R('close', 'close')}, {R('volume', 'volume')}, CAST(0.0 AS DOUBLE) AS missing_feature FROM bars""")
def c1_c2_c3_feature_projection(spark, sf):
    """C1 numeric feature columns, C2 keep existing selected, C3 align to a model column list."""
    b = daily_bars(spark, sf)
    feats = cl.feature_columns(b)                       # open, high, low, close, volume
    sel = cl.select_existing(b, ["symbol", "close", "volume", "not_there"])
    aligned = cl.align_to_schema(sel, [c for c in ("close", "volume", "missing_feature")
                                       if c in feats or c == "missing_feature"], keep=["symbol"])
    return rounded(aligned)


def _c11_noise(c: str) -> str:
    h = f"md5(symbol || '|' || CAST(date AS VARCHAR) || '|' || CAST(copy AS VARCHAR) || '|{c}|7')"
    u, v = (f"CAST(CAST('0x' || substr({h}, {at}, 12) AS BIGINT) AS DOUBLE) / 281474976710656.0" for at in (1, 13))
    return f"sqrt(-2.0 * ln(1.0 - {u})) * cos({2.0 * math.pi!r} * ({v})) * (0.01 * (SELECT stddev_samp({c}) FROM bars))"


@query("c11_augmentation", f"""WITH {BARS}, k AS (SELECT symbol, date, close, volume, unnest([0, 1]) AS copy FROM bars)
SELECT symbol, date, CAST(copy AS INTEGER) AS copy,
  {R(f"CASE WHEN copy = 0 THEN close ELSE close + {_c11_noise('close')} END", 'close')},
  {R(f"CASE WHEN copy = 0 THEN volume ELSE volume + {_c11_noise('volume')} END", 'volume')} FROM k""")
def c11_augmentation(spark, sf):
    """C11: original bars (copy 0) plus one copy with Gaussian noise drawn from hashes of the row's key."""
    b = daily_bars(spark, sf).select("symbol", "date", "close", "volume")
    return rounded(cl.augment(b, ["symbol", "date"], 0.01, 1, seed=7, cols=["close", "volume"]))


# ------------------------------------------------------------------ payloads
@query("s6_bars_payload_roundtrip", f"""WITH {BARS}
SELECT symbol, date, {R('open', 'open')}, {R('high', 'high')}, {R('low', 'low')}, {R('close', 'close')},
  {R('volume', 'volume')} FROM bars""")
def s6_bars_payload_roundtrip(spark, sf):
    """Bars -> vendor JSON payloads (one per symbol-month) -> normalised bars."""
    payload = pl.bars_to_payload(daily_bars(spark, sf))
    return rounded(pl.bars_from_payload(payload))


@query("s7_fx_payload", f"""WITH {_FX.replace('fx AS', 'fxb AS')}
SELECT pair, date, {R('open', 'open')}, {R('high', 'high')}, {R('low', 'low')}, {R('close', 'close')} FROM fxb""")
def s7_fx_payload(spark, sf):
    """FX payloads keyed by (from, to) currency; pair = from + to, no volume."""
    hb = hourly_bars(spark, sf).withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))
    fields = F.create_map(*[x for i, c in enumerate(["open", "high", "low", "close"], 1)
                            for x in (F.lit(f"{i}. {c}"), F.col(c).cast("string"))])
    ent = F.struct(F.col("date").alias("k"), fields.alias("v"))
    g = hb.groupBy("symbol", F.substring("date", 1, 10).alias("_d")).agg(
        F.map_from_entries(F.collect_list(ent)).alias("_s"))
    payload = g.select(F.upper(F.substring("symbol", 1, 3)).alias("from_currency"), F.lit("USD").alias("to_currency"),
                       F.to_json(F.create_map(F.lit("Time Series FX (60min)"), F.col("_s"))).alias("payload"))
    rows = pl.fx_from_payload(payload, ts_type="timestamp")
    return rounded(rows.select("pair", F.col("date").cast("timestamp_ntz").alias("date"), "open", "high", "low", "close"))


@query("s8_indicator_payload", f"""WITH {BARS}
SELECT symbol, 'RSI' AS indicator, date, 'RSI' AS field,
  {R(f"coalesce(100.0 * g / nullif(g + l, 0), 50.0)", 'value')}
FROM (SELECT *, {roll('avg', 'CASE WHEN d > 0 THEN d ELSE 0.0 END', 14)} AS g,
                {roll('avg', 'CASE WHEN d < 0 THEN -d ELSE 0.0 END', 14)} AS l
      FROM (SELECT *, close - {lag('close')} AS d FROM bars))""")
def s8_indicator_payload(spark, sf):
    """RSI served as an indicator payload, normalised by picking the Technical Analysis key."""
    from marketlens.operators import indicators as ind
    r = ind.rsi(daily_bars(spark, sf), P)
    ent = F.struct(F.date_format("date", "yyyy-MM-dd").alias("k"),
                   F.create_map(F.lit("RSI"), F.col("rsi_14").cast("string")).alias("v"))
    g = r.groupBy("symbol", F.date_trunc("month", "date").alias("_m")).agg(
        F.map_from_entries(F.collect_list(ent)).alias("_s"))
    payload = g.select("symbol", F.to_json(F.create_map(
        F.lit("Meta Data"), F.create_map(F.lit("1"), F.create_map(F.lit("x"), F.lit("y"))),
        F.lit("Technical Analysis: RSI"), F.col("_s"))).alias("payload"))
    return rounded(pl.indicator_from_payload(payload))


@query("s9_j1_crypto_payload", f"""WITH {_CRYPTO}
SELECT coin_id, timestamp, {R('price', 'price')}, {R('market_cap', 'market_cap')}, {R('volume', 'volume')} FROM cr""")
def s9_j1_crypto_payload(spark, sf):
    """S9 + J1: chart payload (prices, caps, volumes as [ms, v]) -> rows joined on timestamp."""
    hb = hourly_bars(spark, sf)
    ms = F.unix_millis(F.col("date").cast("timestamp")).cast("double")
    g = hb.groupBy("symbol", F.to_date("date").alias("_d")).agg(
        F.collect_list(F.array(ms, F.col("close"))).alias("prices"),
        F.collect_list(F.array(ms, F.col("close") * F.col("volume"))).alias("market_caps"),
        F.collect_list(F.array(ms, F.col("volume"))).alias("total_volumes"))
    payload = g.select(F.col("symbol").alias("coin_id"),
                       F.to_json(F.struct("prices", "market_caps", "total_volumes")).alias("payload"))
    rows = pl.crypto_from_payload(payload)
    return rounded(rows.select("coin_id", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
                               "price", "market_cap", "volume"))


@query("s10_news_payload", """SELECT CASE event_type WHEN 'purchase' THEN 'Shares rally as strong growth beats the outlook'
  WHEN 'signup' THEN 'Analysts upgrade the stock on positive momentum'
  WHEN 'error' THEN 'Stocks tumble after weak results and a downgrade'
  WHEN 'click' THEN 'Market slides into decline as losses mount'
  WHEN 'view' THEN 'Trading session with mixed signals' END AS title,
  'https://news.example/' || event_type || '/' || CAST(user_id AS VARCHAR) AS url,
  'events' AS source, ts AS publishedAt FROM events""")
def s10_news_payload(spark, sf):
    """News payloads (status ok, articles array) per symbol-day -> article rows."""
    n = news_articles(spark, sf)
    art = F.struct("title", "description", "url", F.struct(F.lit(None).cast("string").alias("id"),
                                                             F.col("source").alias("name")).alias("source"),
                   F.date_format("publishedAt", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("publishedAt"))
    # the API delivers pages of at most 100 articles
    page = F.floor((F.row_number().over(Window.partitionBy("symbol", F.to_date("publishedAt")).orderBy("event_id")) - 1) / 100)
    g = n.withColumn("_page", page).groupBy("symbol", F.to_date("publishedAt").alias("_d"), "_page").agg(
        F.collect_list(art).alias("articles"))
    payload = g.select(F.to_json(F.struct(F.lit("ok").alias("status"), "articles")).alias("payload"))
    rows = pl.news_from_payload(payload)
    return rows.select("title", "url", "source", F.col("publishedAt").cast("timestamp_ntz").alias("publishedAt"))


# ------------------------------------------------------------------ sets / distinct
_NEWS_SQL = """news AS (SELECT event_id, event_type, ts AS publishedAt,
  'https://news.example/' || event_type || '/' || CAST(user_id AS VARCHAR) AS url FROM events)"""


@query("a18_first_per_url", f"""WITH {_NEWS_SQL}
SELECT url, arg_min(event_id, (publishedAt, event_id)) AS event_id, min(publishedAt) AS publishedAt
FROM news GROUP BY url""")
def a18_first_per_url(spark, sf):
    """Keep the first article per url (publishedAt, then event id) - deterministic."""
    n = news_articles(spark, sf).select("url", "event_id", "publishedAt")
    return ag.distinct_on(n, ["url"], ["publishedAt", "event_id"]).select("url", "event_id", "publishedAt")


@query("u1_u2_union_dedup", f"""WITH {_NEWS_SQL},
u AS (SELECT * FROM news WHERE event_type IN ('purchase', 'signup', 'view')
      UNION ALL SELECT * FROM news WHERE event_type IN ('view', 'error', 'click'))
SELECT url, arg_min(event_id, (publishedAt, event_id)) AS event_id, count(*) AS n_copies FROM u GROUP BY url""")
def u1_u2_union_dedup(spark, sf):
    """U1 union of two overlapping article queries, U2 de-duplicated by url (copies counted)."""
    n = news_articles(spark, sf).select("event_id", "symbol", "publishedAt", "url")
    a = n.where(F.col("symbol").isin("purchase", "signup", "view"))
    b = n.where(F.col("symbol").isin("view", "error", "click"))
    u = ag.union_all([a, b])
    cnt = u.groupBy("url").agg(F.count(F.lit(1)).alias("n_copies"))
    first = ag.union_dedup([a, b], "url", ["publishedAt", "event_id"])
    return first.join(cnt, "url").select("url", "event_id", "n_copies")


__all__ = ["R"]
