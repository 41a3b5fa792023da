"""Vendor payload normalisers S6-S10: nested JSON strings -> typed rows.

Each function takes a DataFrame with a JSON string column (one payload per
row, plus request parameters such as the symbol) and returns long rows, using
``from_json`` with an explicit schema, ``explode`` and map/array functions.
No payload is parsed on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SERIES_SCHEMA = "map<string, map<string, string>>"


def _strip_numbering(m: Column) -> Column:
    """Field names "1. open" -> "open" (text after the first '. ')."""
    return F.transform_keys(m, lambda k, v: F.when(F.instr(k, ". ") > 0,
                                                   F.substring_index(k, ". ", -1)).otherwise(k))


def bars_from_payload(df: DataFrame, payload: str = "payload", series_key: str | None = None,
                      symbol: str = "symbol", ts_type: str = "date") -> DataFrame:
    """{"Time Series (...)": {"2024-01-02": {"1. open": "..", ...}}} -> OHLCV rows.

    ``series_key`` names the series; by default the first key starting with
    "Time Series" is used.  Values are cast to double, rows sorted by time.
    """
    top = F.from_json(F.col(payload), f"map<string, {SERIES_SCHEMA}>")
    d = df.withColumn("_top", top)
    if series_key is None:
        keys = F.filter(F.map_keys("_top"), lambda k: k.startswith("Time Series"))
        series = F.element_at("_top", F.element_at(keys, 1))
    else:
        series = F.element_at("_top", F.lit(series_key))
    d = d.select(F.col(symbol), F.explode(series).alias("_ts", "_fields"))
    d = d.withColumn("_fields", _strip_numbering(F.col("_fields")))
    ts = F.to_date("_ts") if ts_type == "date" else F.to_timestamp("_ts")
    cols = ["open", "high", "low", "close", "volume"]
    return d.select(F.col(symbol), ts.alias("date"),
                    *[F.element_at("_fields", F.lit(c)).cast("double").alias(c) for c in cols])


def fx_from_payload(df: DataFrame, payload: str = "payload", from_col: str = "from_currency",
                    to_col: str = "to_currency", ts_type: str = "date") -> DataFrame:
    """FX series -> rows with ``pair = from + to`` and no volume."""
    d = df.withColumn("pair", F.concat(F.col(from_col), F.col(to_col)))
    rows = bars_from_payload(d, payload, None, symbol="pair", ts_type=ts_type)
    return rows.drop("volume")


def indicator_from_payload(df: DataFrame, payload: str = "payload", symbol: str = "symbol") -> DataFrame:
    """Pick the key containing "Technical Analysis"; one column per indicator field."""
    top = F.from_json(F.col(payload), f"map<string, {SERIES_SCHEMA}>")
    d = df.withColumn("_ta", F.map_filter(top, lambda k, v: k.contains("Technical Analysis")))
    d = d.select(F.col(symbol), F.explode("_ta").alias("indicator_key", "_series"))
    d = d.select(symbol, F.regexp_replace("indicator_key", r"^Technical Analysis:\s*", "").alias("indicator"),
                 F.explode("_series").alias("_ts", "_fields"))
    return d.select(symbol, "indicator", F.to_date("_ts").alias("date"),
                    F.explode("_fields").alias("field", "_v")).withColumn("value", F.col("_v").cast("double")).drop("_v")


CHART_SCHEMA = ("struct<prices: array<array<double>>, market_caps: array<array<double>>, "
                "total_volumes: array<array<double>>>")


def crypto_from_payload(df: DataFrame, payload: str = "payload", coin: str = "coin_id") -> DataFrame:
    """S9 + J1: three [ms, value] arrays inner-joined on (coin, timestamp).

    Market caps and volumes are optional: a missing array keeps prices only.
    """
    d = df.select(F.col(coin), F.from_json(F.col(payload), CHART_SCHEMA).alias("_c"))
    d = d.withColumns({"_hc": F.size(F.coalesce(F.col("_c.market_caps"), F.array())) > 0,
                       "_hv": F.size(F.coalesce(F.col("_c.total_volumes"), F.array())) > 0})

    def series(name: str, out: str, keep=()) -> DataFrame:
        e = d.select(F.col(coin), *keep, F.explode(F.col(f"_c.{name}")).alias("_p"))
        return e.select(coin, *keep, F.timestamp_millis(F.col("_p")[0].cast("long")).alias("timestamp"),
                        F.col("_p")[1].alias(out))
    prices = series("prices", "price", ("_hc", "_hv"))
    caps = series("market_caps", "market_cap")
    vols = series("total_volumes", "volume")
    out = prices.join(caps, [coin, "timestamp"], "left").join(vols, [coin, "timestamp"], "left")
    # inner-join semantics for each optional series the payload carries
    out = out.where((~F.col("_hc") | F.col("market_cap").isNotNull()) & (~F.col("_hv") | F.col("volume").isNotNull()))
    return out.drop("_hc", "_hv")


ARTICLE = ("struct<title: string, description: string, url: string, "
           "source: struct<id: string, name: string>, publishedAt: string>")


def news_from_payload(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Keep status "ok" payloads, explode articles, parse publishedAt; empty -> no rows."""
    d = df.select(F.from_json(F.col(payload), f"struct<status: string, articles: array<{ARTICLE}>>").alias("_n"))
    d = d.where(F.col("_n.status") == "ok").select(F.explode("_n.articles").alias("a"))
    return d.select(F.col("a.title").alias("title"), F.col("a.description").alias("description"),
                    F.col("a.url").alias("url"), F.col("a.source.name").alias("source"),
                    F.to_timestamp("a.publishedAt").alias("publishedAt"))


# ---------------------------------------------------------------- payload builders
def bars_to_payload(bars: DataFrame, series_key: str = "Time Series (Daily)", symbol: str = "symbol",
                    group=None) -> DataFrame:
    """Inverse of S6 for round-trip checks: one payload per (symbol, month) group."""
    grp = group if group is not None else F.date_trunc("month", "date")
    fields = F.create_map(*[x for i, c in enumerate(["open", "high", "low", "close", "volume"], 1)
                            for x in (F.lit(f"{i}. {c}"), F.col(c).cast("string"))])
    entry = F.struct(F.date_format("date", "yyyy-MM-dd").alias("k"), fields.alias("v"))
    g = bars.groupBy(symbol, grp.alias("_g")).agg(F.map_from_entries(F.collect_list(entry)).alias("_s"))
    return g.select(symbol, F.to_json(F.create_map(F.lit(series_key), F.col("_s"))).alias("payload"))
