"""Contracts, cleaning, text, splits, labels and regimes against brute force (reference test style)."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlens.functions.panel import Panel, nan_to_null
from marketlens.operators import aggregates as ag
from marketlens.operators import checks as ck
from marketlens.operators import clean as cl
from marketlens.operators import features as fe
from marketlens.operators import labels as lb
from marketlens.operators import regimes as rg
from marketlens.operators import splits as sp
from marketlens.operators import text as tx

from conftest import ohlcv

P = Panel()


def test_valid_stock_data_passes(spark):
    d = spark.createDataFrame(ohlcv(100, "AAPL"))
    r = ck.stock_contract(d).first()
    assert r["is_valid"] and r["high_lt_low"] == 0 and r["null_cells"] == 0


def test_stock_warnings(spark):
    pdf = ohlcv(100, "AAPL")
    pdf.loc[10, "high"], pdf.loc[10, "low"] = 50.0, 100.0
    pdf.loc[:15, "volume"] = 0.0
    pdf.loc[5, "close"] = 1000.0
    pdf.loc[20, "close"] = np.nan
    r = ck.stock_contract(spark.createDataFrame(pdf).withColumn("close", nan_to_null("close"))).first()
    text = " | ".join(r["warnings"])
    assert "high below low: 1 rows" in text and "volume is zero: 16 rows" in text and "quartile fences" in text
    assert r["is_valid"]


def test_missing_column_is_error(spark):
    d = spark.createDataFrame(ohlcv(30)).drop("volume")
    r = ck.stock_contract(d).first()
    assert not r["is_valid"] and any("no column volume" in e for e in r["errors"])


def test_profile_counts(spark):
    pdf = ohlcv(50)
    pdf.loc[3, "open"] = None
    prof = ck.profile(spark.createDataFrame(pdf)).toPandas().set_index("column")
    assert prof.loc["open", "null_count"] == 1 and prof.loc["symbol", "unique_values"] == 1
    assert prof.loc["symbol", "mean"] is None or np.isnan(prof.loc["symbol", "mean"])


def test_sentiment_fixture_titles(spark):
    titles = ["Stock market surges as bullish sentiment takes hold", "Market crashes after negative earnings report",
              "Trading session with mixed signals", "Tech stocks rally on positive growth outlook",
              "Economic data shows weak performance"]
    d = spark.createDataFrame(pd.DataFrame({"i": range(5), "title": titles}))
    got = tx.keyword_sentiment(d, "title").orderBy("i").toPandas()["sentiment_label"].tolist()
    assert got == ["positive", "negative", "neutral", "positive", "negative"]


def test_sentiment_null_and_case(spark):
    d = spark.createDataFrame(pd.DataFrame({"i": [0, 1], "title": [None, "BULLISH #rally @GAIN"]}))
    r = tx.keyword_sentiment(d, "title").orderBy("i").toPandas()
    assert r.loc[0, "sentiment_neutral"] == 1.0 and r.loc[1, "sentiment_score"] == 1.0


def test_triple_barrier_brute_force(spark):
    pdf = ohlcv(300, "X", 9)
    pdf["close"] = 100 * np.exp(np.cumsum(np.random.default_rng(3).normal(0, 0.01, 300)))
    got = lb.triple_barrier(spark.createDataFrame(pdf), P).orderBy("date").toPandas()["triple_barrier"]
    c = pdf["close"].to_numpy()
    exp = []
    for i in range(len(c)):
        if i + 10 >= len(c):
            exp.append(None)
            continue
        r = (c[i + 1:i + 11] - c[i]) / c[i]
        tp = np.flatnonzero(r >= 0.02)
        sl = np.flatnonzero(r <= -0.01)
        if tp.size and sl.size:
            exp.append(1 if tp[0] <= sl[0] else -1)
        else:
            exp.append(1 if tp.size else -1 if sl.size else 0)
    assert [None if pd.isna(v) else int(v) for v in got] == exp


def test_positions_match_global_sort(spark, bars_pdf):
    d, n = sp.with_positions(spark.createDataFrame(bars_pdf))
    got = d.orderBy(sp.POS).toPandas()[["date", "symbol"]]
    exp = bars_pdf.sort_values(["date", "symbol"])[["date", "symbol"]].reset_index(drop=True)
    assert n == len(bars_pdf)
    pd.testing.assert_frame_equal(got.reset_index(drop=True), exp)


def test_folds_disjoint_and_ordered(spark, bars_pdf):
    f = sp.expanding_folds(spark.createDataFrame(bars_pdf), n_splits=3, gap=2).toPandas()
    for k, g in f.groupby("fold"):
        tr, te = g[g.role == "train"][sp.POS], g[g.role == "test"][sp.POS]
        assert tr.max() + 2 < te.min()


def test_features_47_and_missing_volume(spark):
    d = spark.createDataFrame(ohlcv(300))
    assert len(fe.engineer_features(d, P).columns) - len(d.columns) == 47
    close_only = d.select("symbol", "date", "close")
    assert "pvt" not in fe.engineer_features(close_only, P).columns


def test_consecutive_up_brute_force(spark):
    pdf = ohlcv(200, "X", 4)
    got = fe.trend_features(spark.createDataFrame(pdf), P).orderBy("date").toPandas()["consecutive_up"].tolist()
    up = (pdf["close"].diff() > 0).astype(int)
    exp = up.groupby((up != up.shift()).cumsum()).cumsum().tolist()
    assert got == exp


def test_transition_matrix_brute_force(spark):
    regs = ["bull", "bull", "bear", "sideways", "bull", "bear", "bear", "bull"]
    pdf = pd.DataFrame({"symbol": "S", "date": pd.date_range("2024-01-01", periods=len(regs)).date, "regime": regs})
    got = rg.transition_matrix(spark.createDataFrame(pdf), P).toPandas()
    s = pd.Series(regs)
    for fr in set(regs):
        idx = list(s[s == fr].index)
        for to in ["bear", "sideways", "bull"]:
            cnt = sum(1 for i in idx[:-1] if s[i + 1] == to)
            exp = cnt / (len(idx) - 1) if len(idx) > 1 else 0
            row = got[(got.from_regime == fr) & (got.to_regime == to)]
            assert abs(float(row["probability"].iloc[0]) - exp) < 1e-12


def test_ffill_stays_within_symbol(spark):
    pdf = pd.DataFrame({"symbol": ["A", "A", "B", "B"], "date": pd.to_datetime(["2024-01-01", "2024-01-02"] * 2).date,
                        "x": [1.0, None, None, 2.0]})
    got = cl.ffill_then_zero(spark.createDataFrame(pdf), P, ["x"]).orderBy("symbol", "date").toPandas()["x"].tolist()
    assert got == [1.0, 1.0, 0.0, 2.0]


def test_distinct_on_keeps_first(spark):
    pdf = pd.DataFrame({"url": ["u", "u", "v"], "t": [3, 1, 2], "id": [1, 2, 3]})
    got = ag.distinct_on(spark.createDataFrame(pdf), ["url"], ["t"]).orderBy("url").toPandas()
    assert got["id"].tolist() == [2, 3]


@pytest.mark.parametrize("column", ["open", "high", "low", "close", "volume", "symbol", "date"])
def test_stock_contract_reports_each_missing_column(spark, column):
    r = ck.stock_contract(spark.createDataFrame(ohlcv(30)).drop(column)).first()
    assert not r["is_valid"] and f"schema: no column {column}" in r["errors"] and r["n_rows"] == 30


def test_contracts_report_what_cannot_be_read(spark):
    d = spark.createDataFrame(ohlcv(30)).withColumn("close", F.lit("n/a")).withColumn("pair", F.lit("EURUSD"))
    r = ck.stock_contract(d).first()
    assert not r["is_valid"] and "schema: 30 cells are not numbers" in r["errors"]
    r = ck.forex_contract(d.drop("high")).first()
    assert not r["is_valid"] and "schema: no column high" in r["errors"] and "schema: 30 cells are not numbers" in r["errors"]
    r = ck.crypto_contract(spark.createDataFrame([("btc", "x")], "coin_id string, price string")).first()
    assert not r["is_valid"] and r["n_rows"] == 1
    r = ck.news_contract(spark.createDataFrame([("a title", "2024-01-01")], "title string, publishedAt string"), "2024-06-01").first()
    assert not r["is_valid"] and "schema: no column url" in r["errors"]


def test_file_tree_has_a_row_for_each_file_and_type(spark, tmp_path):
    good, bad = ohlcv(30, "GOOD"), ohlcv(30, "GOOD")
    bad["close"] = -1.0
    for kind, frames in {"stocks": {"a": good, "b": bad}}.items():
        for name, pdf in frames.items():
            spark.createDataFrame(pdf).coalesce(1).write.parquet(f"{tmp_path}/{kind}/{name}")
    rep = ck.validate_files(spark, f"{tmp_path}/stocks/*").collect()
    assert sorted((r["file"].split("/")[-2], r["is_valid"]) for r in rep) == [("a", True), ("b", False)]
    fx = spark.createDataFrame(good.drop(columns=["symbol", "volume"]).assign(pair="EURUSD"))
    fx.coalesce(1).write.parquet(f"{tmp_path}/forex/a")
    fx.withColumn("pair", F.lit("EUR")).coalesce(1).write.parquet(f"{tmp_path}/forex/b")
    rep = ck.validate_files(spark, f"{tmp_path}/forex/*", "forex").collect()
    assert sorted((r["file"].split("/")[-2], r["is_valid"]) for r in rep) == [("a", True), ("b", False)]
    (tmp_path / "empty").mkdir()
    for where in ("empty", "nowhere"):
        r = ck.validate_files(spark, f"{tmp_path}/{where}").first()
        assert not r["is_valid"] and "no files under" in r["errors"][0]


def test_cache_tells_functions_of_one_name_apart(spark, tmp_path):
    from marketlens.operators.cache import FeatureCache

    def make(k):
        def f(df, **kw):
            return df.withColumn("x", F.lit(k))
        return f
    cache = FeatureCache(str(tmp_path))
    d = spark.range(3)
    assert cache.get_or_compute(d, make(1)).first()["x"] == 1 and cache.get_or_compute(d, make(2)).first()["x"] == 2
    assert cache.get_or_compute(d, make(1)).first()["x"] == 1 and cache.stats()["hits"] == 1
    assert cache.get_or_compute(d, make(1), n=2).count() == 3 and cache.stats()["misses"] == 3
    assert cache.invalidate(spark, "f/*") == 3
    cache.get_or_compute(d, make(1))
    cache.ttl = -1
    cache.get_or_compute(d, make(1))
    assert cache.stats()["misses"] == 5


def test_noise_does_not_depend_on_partitions(spark):
    d = spark.createDataFrame(ohlcv(200))
    a = cl.augment(d.repartition(7), ["symbol", "date"], cols=["close"]).orderBy("date", "copy").toPandas()
    b = cl.augment(d.coalesce(1), ["symbol", "date"], cols=["close"]).orderBy("date", "copy").toPandas()
    assert (a["close"] == b["close"]).all()
    noise = a[a["copy"] == 1]["close"].to_numpy() - a[a["copy"] == 0]["close"].to_numpy()
    assert 0.7 < noise.std() / (0.01 * a[a["copy"] == 0]["close"].std()) < 1.3


def test_feature_store_replaces_latest_whole(spark, tmp_path):
    from marketlens.sources import files as fs
    fs.write_feature_store(spark.range(5), str(tmp_path), "2024-01-01")
    fs.write_feature_store(spark.range(2), str(tmp_path), "2024-01-02")
    assert fs.read_feature_store(spark, str(tmp_path)).count() == 2
    assert fs.read_feature_store(spark, str(tmp_path), "2024-01-01").count() == 5
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper()
    fs.save_partitioned(spark.createDataFrame(ohlcv(5)), str(tmp_path), "stocks")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == mode == "STATIC"
