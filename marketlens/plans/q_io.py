"""Registered source/sink round trips: S2, S3, S4, S5, S11-S15.

Each query writes data derived from the driver tables into the shared
checkpoint folder (a fresh sub-folder per call), reads it back through the
source under test and returns what was read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marketlens.operators import checks as ck
from marketlens.operators import models as md
from marketlens.plans.registry import query, rounded
from marketlens.plans.sqlkit import BARS, R
from marketlens.session import checkpoint_dir
from marketlens.sources import files as fs
from marketlens.sources.tables import NEWS_TITLES, daily_bars, news_articles


def _scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/io/{name}-{uuid.uuid4().hex[:8]}"


@query("s4_s2_partitioned_roundtrip", f"""WITH {BARS}
SELECT symbol, date, {R('open', 'open')}, {R('high', 'high')}, {R('low', 'low')}, {R('close', 'close')},
  {R('volume', 'volume')} FROM bars""")
def s4_s2_partitioned_roundtrip(spark, sf):
    """S4 date-partitioned Parquet sink (every symbol kept) read back by S2 partition discovery."""
    base = _scratch(spark, "s4")
    fs.save_partitioned(daily_bars(spark, sf), base, "stocks")
    back = fs.load_panel_tree(spark, base, "stocks", merge_schema=False)
    return rounded(back.select("symbol", F.col("date").cast("date").alias("date"), "open", "high", "low",
                               "close", "volume"))


_NEWS_SQL = "SELECT CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in NEWS_TITLES.items()) + \
    " END AS title, 'https://news.example/' || event_type || '/' || CAST(user_id AS VARCHAR) AS url, ts FROM events"


@query("s5_s3_news_json_roundtrip", f"""SELECT title, url, title || ' value ' || CAST(round(value, 2) AS VARCHAR) AS text
FROM (SELECT *, CASE event_type {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in NEWS_TITLES.items())} END AS title,
  'https://news.example/' || event_type || '/' || CAST(user_id AS VARCHAR) AS url FROM events)""")
def s5_s3_news_json_roundtrip(spark, sf):
    """S5 date-partitioned JSON sink, then S3 JSON scan (schema, PERMISSIVE, text = title + description)."""
    base = _scratch(spark, "s5")
    n = news_articles(spark, sf).select("title", "description", "url", "source", "publishedAt")
    n = n.withColumn("date", F.to_date("publishedAt")).withColumn("publishedAt", F.col("publishedAt").cast("string"))
    fs.save_partitioned(n, base, "news", fmt="json")
    back = fs.load_news_json(spark, f"{base}/news", lines=True)
    return back.select("title", "url", "text")


@query("s11_s12_s13_feature_store", f"""WITH {BARS}
SELECT symbol, date, {R('open', 'open')}, {R('high', 'high')}, {R('low', 'low')}, {R('close', 'close')},
  {R('volume', 'volume')}, CAST(1 AS BIGINT) AS reports_written, (SELECT count(DISTINCT symbol) FROM bars) AS symbols_checked
FROM bars WHERE date >= DATE '1995-01-01'""")
def s11_s12_s13_feature_store(spark, sf):
    """S11 dated + latest feature sets (the second run replaces the first), S12 read with fallback to latest, S13 report sink."""
    base = _scratch(spark, "store")
    bars = daily_bars(spark, sf)
    fs.write_feature_store(bars, base, "2024-01-02")
    fs.write_feature_store(bars.where("date >= DATE '1995-01-01'"), base, "2024-01-03")
    got = fs.read_feature_store(spark, base, "2030-01-01")          # missing date -> latest
    first = fs.read_feature_store(spark, base, "2024-01-02")
    fs.write_report(ck.validation_summary(ck.stock_contract(first)), f"{base}/reports/validation", "json")
    rep = spark.read.json(f"{base}/reports/validation")
    return rounded(got.select("symbol", "date", "open", "high", "low", "close", "volume")).withColumns({
        "reports_written": F.lit(rep.count()).cast("long"), "symbols_checked": F.lit(rep.first()["total_validations"]).cast("long")})


@query("s14_validate_file_tree", f"""WITH {BARS},
f AS (SELECT symbol, count(*) AS n_rows, count_if(high < low) AS high_lt_low, count_if(close < 0) AS negative_values,
  length(symbol) > 5 AS long_name FROM bars GROUP BY symbol)
SELECT symbol AS folder, n_rows, CAST(high_lt_low AS BIGINT) AS high_lt_low, CAST(negative_values AS BIGINT) AS negative_values,
  CASE WHEN long_name THEN n_rows ELSE 0 END AS bad_symbol, NOT long_name AND negative_values = 0 AS is_valid FROM f
UNION ALL SELECT 'TEXT', count(*), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), false FROM bars WHERE symbol LIKE '1%'""")
def s14_validate_file_tree(spark, sf):
    """One scan of a tree with one Parquet file per symbol; each file's row follows the stock contract.

    A second tree whose prices are no numbers gives a row with schema errors.
    """
    base = _scratch(spark, "tree")
    bars = daily_bars(spark, sf)
    bars.repartition("symbol").write.partitionBy("symbol").parquet(f"{base}/stocks")
    bars.where("symbol LIKE '1%'").withColumns({"symbol": F.lit("TEXT"), "close": F.lit("none")}).coalesce(1) \
        .write.partitionBy("symbol").parquet(f"{base}/text")
    rep = ck.validate_files(spark, f"{base}/stocks").unionByName(ck.validate_files(spark, f"{base}/text"))
    folder = F.url_decode(F.regexp_extract("file", "symbol=([^/]+)/", 1))
    return rep.select(folder.alias("folder"), "n_rows", "high_lt_low", "negative_values", "bad_symbol", "is_valid")


_S15 = f"""WITH {BARS}, d AS (SELECT symbol, date, close, open AS x1, high - low AS x2, volume AS x3 FROM bars),
m AS (SELECT avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3, avg(close) AS my FROM d),
c AS (SELECT sum((x1 - m1) * (x1 - m1)) + 1.0 AS a, sum((x1 - m1) * (x2 - m2)) AS b, sum((x1 - m1) * (x3 - m3)) AS c,
  sum((x2 - m2) * (x2 - m2)) + 1.0 AS e, sum((x2 - m2) * (x3 - m3)) AS f, sum((x3 - m3) * (x3 - m3)) + 1.0 AS i,
  sum((x1 - m1) * (close - my)) AS p, sum((x2 - m2) * (close - my)) AS q, sum((x3 - m3) * (close - my)) AS r FROM d, m),
w AS (SELECT a * (e * i - f * f) - b * (b * i - f * c) + c * (b * f - e * c) AS det,
  p * (e * i - f * f) - b * (q * i - f * r) + c * (q * f - e * r) AS d1,
  a * (q * i - f * r) - p * (b * i - f * c) + c * (b * r - q * c) AS d2,
  a * (e * r - q * f) - b * (b * r - q * c) + p * (b * f - e * c) AS d3 FROM c)
SELECT symbol, date, {R('close', 'close')}, {R('my + d1 / det * (x1 - m1) + d2 / det * (x2 - m2) + d3 / det * (x3 - m3)', 'prediction', 2)},
  'close' AS target FROM d, m, w"""


@query("s15_model_save_load", _S15)
def s15_model_save_load(spark, sf):
    """Fit ridge (M4), save (Spark ML writer + metadata), load, and score with the loaded model."""
    base = _scratch(spark, "model")
    d = daily_bars(spark, sf).withColumn("range", F.col("high") - F.col("low"))
    m = md.fit_ridge(d, ["open", "range", "volume"], "close", 1.0)
    md.save_model(m, base, {"features": ["open", "range", "volume"], "target": "close", "alpha": 1.0})
    loaded, meta = md.load_model(spark, base)
    out = loaded.transform(d).select("symbol", "date", "close", "prediction", F.lit(meta["target"]).alias("target"))
    return rounded(out, coarse={"prediction": 2})
