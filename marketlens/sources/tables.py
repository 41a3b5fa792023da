"""Driver tables and the market panels derived from them.

All derivations are lazy DataFrame plans over the given parquet tables, so their
work grows with the tables.  Scans project only the columns used, letting the
parquet reader prune columns and push filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV bars from ``orders``: symbol = order priority, one bar per order date.

    open/close = price of the lowest/highest order key that day; a partial
    aggregate runs before the shuffle, so only one row per (symbol, day, task)
    crosses the network.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    return (o.groupBy(F.col("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("date"))
            .agg(F.min_by("o_totalprice", "o_orderkey").alias("open"),
                 F.max("o_totalprice").alias("high"),
                 F.min("o_totalprice").alias("low"),
                 F.max_by("o_totalprice", "o_orderkey").alias("close"),
                 F.count(F.lit(1)).cast("double").alias("volume")))


# Fixed values of the level series (FIXTURES 6): drift per standardised close,
# base level, and the high/low widening fraction.
LEVEL_STEP = 0.005
LEVEL_BASE = 100.0
LEVEL_WIDEN = 0.002


def level_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trending OHLC level series derived from the daily bars.

    close = 100 * exp(running sum of 0.005 * z(close)), z over all bars; open =
    previous level (first: own close); high/low = max/min(open, close) widened
    by 0.2 %.  The global mean/std is a one-row aggregate fetched once.
    """
    bars = daily_bars(spark, sf_dir)
    st = bars.agg(F.avg("close").alias("m"), F.stddev_samp("close").alias("s")).first()
    m, s = float(st["m"]), float(st["s"] or 1.0)
    w = Window.partitionBy("symbol").orderBy("date")
    z = F.lit(LEVEL_STEP) * (F.col("close") - F.lit(m)) / F.lit(s)
    lvl = bars.select("symbol", "date", "volume",
                      (F.lit(LEVEL_BASE) * F.exp(F.sum(z).over(w.rowsBetween(Window.unboundedPreceding, 0))))
                      .alias("close"))
    lvl = lvl.withColumn("open", F.coalesce(F.lag("close").over(w), F.col("close")))
    return lvl.select(
        "symbol", "date", "open",
        (F.greatest("open", "close") * F.lit(1 + LEVEL_WIDEN)).alias("high"),
        (F.least("open", "close") * F.lit(1 - LEVEL_WIDEN)).alias("low"),
        "close", "volume")


def tick_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tick-level benchmark panel from ``lineitem``: symbol = brand of the part.

    ``part`` is a dimension (one row per part key); it is joined by key and the
    planner picks broadcast or shuffle from its measured size (AQE).
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber",
                                                 "l_quantity", "l_extendedprice", "l_shipdate")
    pt = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return (li.join(pt, li.l_partkey == pt.p_partkey, "inner")
            .select(F.col("p_brand").alias("symbol"), F.col("l_shipdate").alias("date"),
                    "l_orderkey", "l_linenumber",
                    F.col("l_extendedprice").alias("close"), F.col("l_quantity").alias("volume")))


def hourly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars from ``events``: symbol = event type, price = event value."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return (e.groupBy(F.col("event_type").alias("symbol"), F.date_trunc("hour", "ts").alias("date"))
            .agg(F.min_by("value", "event_id").alias("open"), F.max("value").alias("high"),
                 F.min("value").alias("low"), F.max_by("value", "event_id").alias("close"),
                 F.count(F.lit(1)).cast("double").alias("volume")))


# Fixed headline words used to turn ``events`` into news articles; each maps an
# event type to a title containing lexicon words (bullish / bearish / mixed).
NEWS_TITLES = {
    "purchase": "Shares rally as strong growth beats the outlook",
    "signup": "Analysts upgrade the stock on positive momentum",
    "error": "Stocks tumble after weak results and a downgrade",
    "click": "Market slides into decline as losses mount",
    "view": "Trading session with mixed signals",
}


def news_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News stand-in from ``events``: title by event type, url per (type, user), publishedAt = ts.

    Several events share a url, which gives the url de-duplication (A18/U2) real work.
    """
    return as_news(table(spark, sf_dir, "events"))


def as_news(e: DataFrame) -> DataFrame:
    """Articles of a table (or stream) of events."""
    title = F.lit(None).cast("string")
    for k, v in NEWS_TITLES.items():
        title = F.when(F.col("event_type") == k, F.lit(v)).otherwise(title)
    return e.select(
        title.alias("title"),
        F.concat(F.lit("value "), F.round("value", 2).cast("string")).alias("description"),
        F.concat(F.lit("https://news.example/"), F.col("event_type"), F.lit("/"),
                 F.col("user_id").cast("string")).alias("url"),
        F.lit("events").alias("source"),
        F.col("ts").alias("publishedAt"),
        F.col("event_type").alias("symbol"),
        "event_id")
