"""Registered streaming queries ST1-ST3: each drains the events stream with ``availableNow``."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens.plans.registry import query, rounded
from marketlens.plans.q_text import NEWS_SCORED
from marketlens.plans.sqlkit import R
from marketlens.sources.tables import as_news
from marketlens.streaming import streams as st


@query("st1_windowed_bars", f"""SELECT event_type AS symbol, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
  time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
  {R('arg_min(value, event_id)', 'open')}, {R('max(value)', 'high')}, {R('min(value)', 'low')},
  {R('arg_max(value, event_id)', 'close')}, count(*) AS n
FROM events GROUP BY 1, 2
HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def st1_windowed_bars(spark, sf):
    """ST1: hourly OHLC per event type, 10-minute watermark, append mode (open windows not emitted)."""
    return rounded(st.run_to_table(st.windowed_bars(st.event_stream(spark, sf, max_files=1)), "st1"))


_DAYS = ", ".join([R("avg(sentiment_score)", "sentiment_score_mean"), R("stddev_samp(sentiment_score)", "sentiment_score_std"),
                   R("min(sentiment_score)", "sentiment_score_min"), R("max(sentiment_score)", "sentiment_score_max"),
                   "count(sentiment_score) AS sentiment_score_count",
                   *[R(f"avg(sentiment_{c})", f"sentiment_{c}_mean") for c in ("positive", "negative", "neutral")]])


@query("st1_sentiment_windows", f"""WITH {NEWS_SCORED}, k AS (SELECT *, CAST(regexp_extract(url, '[0-9]+$') AS BIGINT) % 200 AS reader,
  CAST(publishedAt AS DATE) AS period FROM scored),
day AS (SELECT reader, period, {_DAYS} FROM k GROUP BY reader, period
  HAVING period + INTERVAL 1 DAY <= (SELECT max(publishedAt) FROM k) - INTERVAL 1 HOUR),
spine AS (SELECT reader, CAST(unnest(generate_series(min(period), max(period), INTERVAL 1 DAY)) AS DATE) AS period FROM day GROUP BY reader)
SELECT reader, period, * EXCLUDE (reader, period, sentiment_score_count), coalesce(sentiment_score_count, 0) AS sentiment_score_count
FROM spine LEFT JOIN day USING (reader, period)""")
def st1_sentiment_windows(spark, sf):
    """ST1 of A2: sentiment per group of readers and day, closed by the watermark, with the days without news between."""
    news = as_news(st.event_stream(spark, sf, max_files=1))
    news = news.withColumn("reader", F.regexp_extract("url", "[0-9]+$", 0).cast("long") % 200)
    return rounded(st.run_to_table(st.sentiment_windows(news, keys=["reader"]), "st1s"))


@query("st2_first_article", """WITH n AS (SELECT 'https://news.example/' || event_type || '/' || CAST(user_id AS VARCHAR) AS url, event_id, ts, value FROM events),
f AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY ts, event_id) AS r FROM n)
SELECT url, event_id, ts AS publishedAt, 'value ' || CAST(round(value, 2) AS VARCHAR) AS description FROM f
WHERE r = 1 AND epoch_ms(ts) < (SELECT max(epoch_ms(ts)) - 3600000 FROM events)""")
def st2_first_article(spark, sf):
    """ST2: the earliest article of each url, held until the watermark has passed it."""
    out = st.run_to_table(st.first_articles(as_news(st.event_stream(spark, sf, max_files=1))), "st2f")
    return out.select("url", "event_id", F.col("publishedAt").cast("timestamp_ntz").alias("publishedAt"), "description")


@query("st2_url_dedup", """SELECT DISTINCT 'https://news.example/' || event_type || '/' || CAST(user_id AS VARCHAR) AS url
FROM events""")
def st2_url_dedup(spark, sf):
    """ST2: one article per url within the watermark (the kept copy is not order-defined, so only urls are compared)."""
    ev = st.event_stream(spark, sf, max_files=1)
    news = ev.select(F.concat(F.lit("https://news.example/"), F.col("event_type"), F.lit("/"),
                              F.col("user_id").cast("string")).alias("url"), F.col("ts").alias("publishedAt"))
    out = st.run_to_table(st.dedup_urls(news, delay="30 days"), "st2")
    return out.select("url")


@query("st3_running_ema", f"""WITH RECURSIVE e0 AS (SELECT event_type, ts, event_id, value,
  row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS rn FROM events),
e AS (SELECT event_type, rn, value AS ema FROM e0 WHERE rn = 0
  UNION ALL SELECT s.event_type, s.rn, {1 - 2.0 / 13!r} * e.ema + {2.0 / 13!r} * s.value
  FROM e JOIN e0 s ON s.event_type = e.event_type AND s.rn = e.rn + 1)
SELECT e0.event_type, e0.ts, e0.event_id, {R('e0.value', 'value')}, {R('e.ema', 'ema')}
FROM e0 JOIN e USING (event_type, rn)
WHERE epoch_ms(e0.ts) < (SELECT max(epoch_ms(ts)) - 600000 FROM events)""")
def st3_running_ema(spark, sf):
    """ST3: EMA(12) per event type carried in streaming state; rows that the watermark has passed."""
    out = st.run_to_table(st.running_ema(st.event_stream(spark, sf, max_files=1)), "st3")
    return rounded(out.select("event_type", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id", "value", "ema"))

