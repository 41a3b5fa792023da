"""Streaming forms and model helpers on small inputs."""
from pathlib import Path

import numpy as np
import pandas as pd

from marketlens.operators import anomaly as an
from marketlens.operators import ensembles as en
from marketlens.streaming import streams as st

SF = "/root/testdata/sf0.001"


def _averages(pdf, until):
    pdf = pdf.sort_values(["event_type", "ts", "event_id"])
    pdf["ema"] = pdf.groupby("event_type")["value"].transform(lambda s: s.ewm(span=12, adjust=False).mean())
    return pdf[pdf["ts"].astype("datetime64[ms]") < until.floor("ms") - pd.Timedelta(minutes=10)]


def test_running_ema_matches_pandas(spark):
    out = st.run_to_table(st.running_ema(st.event_stream(spark, SF)), "t_st3").toPandas()
    ev = spark.read.parquet(f"{SF}/events.parquet").toPandas()
    exp = _averages(ev, ev["ts"].max())
    out = out.sort_values(["event_type", "ts", "event_id"])
    assert out["event_id"].tolist() == exp["event_id"].tolist() and len(exp) > 900
    np.testing.assert_allclose(out["ema"].to_numpy(), exp["ema"].to_numpy(), rtol=1e-12)


def test_streams_over_files_out_of_order_and_a_restart(spark, tmp_path):
    """Rows up to the delay late take their place; a second run goes on from the checkpoint."""
    ev = spark.read.parquet(f"{SF}/events.parquet").toPandas().sort_values("ts").reset_index(drop=True)
    step = (np.arange(len(ev)) // 100)
    # within the delay: a few rows of each slice move to the next file
    late = (np.arange(len(ev)) % 100 >= 97) & (step < step.max())
    near = ev["ts"] > ev.groupby(step)["ts"].transform("max") - pd.Timedelta(minutes=9)
    ev["file"] = np.where(late & near, step + 1, step)
    src, base = tmp_path / "in", str(tmp_path / "run")
    src.mkdir()

    def put(files):
        for f in files:
            ev[ev["file"] == f].drop(columns="file").to_parquet(src / f"f{f:03d}.parquet", index=False, coerce_timestamps="us")
    put(range(5))
    stream = spark.readStream.schema(spark.read.parquet(f"{SF}/events.parquet").schema).option("maxFilesPerTrigger", 1)
    first = st.run_to_table(st.running_ema(stream.parquet(str(src))), "x", base=base).count()
    put(range(5, int(step.max()) + 1))
    out = st.run_to_table(st.running_ema(stream.parquet(str(src))), "x", base=base).toPandas()
    exp = _averages(ev, ev["ts"].max())
    out = out.sort_values(["event_type", "ts", "event_id"])
    assert 0 < first < len(out) and out["event_id"].tolist() == exp["event_id"].tolist()
    np.testing.assert_allclose(out["ema"].to_numpy(), exp["ema"].to_numpy(), rtol=1e-12)


def test_windowed_bars_drop_open_windows(spark):
    out = st.run_to_table(st.windowed_bars(st.event_stream(spark, SF)), "t_st1").toPandas()
    mx = spark.read.parquet(f"{SF}/events.parquet").agg({"ts": "max"}).first()[0]
    assert (pd.to_datetime(out["window_end"]) <= pd.Timestamp(mx) - pd.Timedelta(minutes=10)).all()
    assert len(out) > 0


def _files(src, frames):
    src.mkdir(exist_ok=True)
    for i, f in enumerate(frames):
        f.to_parquet(src / f"f{i:03d}.parquet", index=False, coerce_timestamps="us")


def test_a_key_of_a_million_waiting_rows(spark, tmp_path):
    """Rows ahead of the watermark wait in chunks by minute; a batch adds chunks, a timer takes the minutes that have passed."""
    rng = np.random.default_rng(3)
    n = 1_000_000
    t = pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 3_600_000_000, n), unit="us")
    big = pd.DataFrame({"event_type": "hot", "ts": t, "event_id": np.arange(n), "value": rng.normal(size=n)})
    last = pd.DataFrame({"event_type": ["cold"], "ts": [pd.Timestamp("2024-01-01 03:00:00")], "event_id": [n], "value": [1.0]})
    _files(tmp_path / "in", [big.iloc[:400_000], big.iloc[400_000:], last])
    schema = "event_type string, ts timestamp_ntz, event_id long, value double"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = st.run_to_table(st.running_ema(stream, delay="2 hours"), "hot").toPandas().sort_values(["ts", "event_id"])
    exp = big[big["ts"].astype("datetime64[ms]") < pd.Timestamp("2024-01-01 01:00:00")].sort_values(["ts", "event_id"])
    assert out["event_id"].tolist() == exp["event_id"].tolist()
    np.testing.assert_allclose(out["ema"], exp["value"].ewm(span=12, adjust=False).mean(), rtol=1e-12)


def test_first_article_is_the_earliest_whatever_the_order_of_files(spark, tmp_path):
    at = lambda m: pd.Timestamp("2024-01-01") + pd.Timedelta(minutes=m)
    rows = [[("a", 50, 1), ("b", 60, 2), (None, 55, 9)], [("a", 40, 3), ("a", 40, 4), ("c", 45, 5)],  # out of order, within the delay
            [("d", 300, 6), ("a", 310, 7)], [("a", 301, 8), ("z", 1, 10)],  # a was emitted; z is late
            [("e", 60 * 30, 11)], [("a", 60 * 31, 12), ("f", 60 * 31, 13)], [("g", 60 * 60, 14)]]  # after a day, a counts as new
    frames = [pd.DataFrame([(u, at(m), i, f"text {i}") for u, m, i in r], columns=["url", "publishedAt", "event_id", "title"]) for r in rows]
    _files(tmp_path / "in", frames)
    schema = "url string, publishedAt timestamp_ntz, event_id long, title string"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = st.run_to_table(st.first_articles(stream, ttl_seconds=86400), "first").toPandas()
    assert sorted(out["event_id"]) == [2, 3, 5, 6, 9, 11, 12, 13]
    assert (out["title"] == "text " + out["event_id"].astype(str)).all()


def test_first_articles_of_many_urls_make_few_state_calls(spark, tmp_path):
    """State goes by buckets of urls; over many batches the kept rows are those of a state for each url."""
    rng = np.random.default_rng(8)
    n, day, hour = 3000, 86_400_000, 3_600_000
    order = np.sort(rng.integers(0, 12 * day, n)) - rng.integers(0, 2 * hour, n)  # out of order, some late
    order[-1] = 40 * day
    pdf = pd.DataFrame({"url": rng.choice([*(f"u{i}" for i in range(400)), None], n), "ms": order // 60_000 * 60_000, "event_id": rng.permutation(n)})
    pdf["publishedAt"], pdf["title"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(pdf["ms"], unit="ms"), "text " + pdf["event_id"].astype(str)
    origin = int(pd.Timestamp("2024-01-01").value // 10**6)
    files = [pdf.iloc[i:i + 250] for i in range(0, n - 1, 250)]
    files[-1] = files[-1].iloc[:-1]
    files.append(pdf.iloc[-1:])

    def plain(ttl):
        waiting, until, out, top = {}, {}, [], 0
        for frame in [*files, None]:
            now = max(0, top - hour)  # the watermark after the batch before
            for u, ms, i in ([] if frame is None else frame[["url", "ms", "event_id"]].itertuples(index=False)):
                u = u if isinstance(u, str) else None
                at = (ms + origin, i)
                if at[0] >= now and not until.get(u, 0) > now:
                    waiting[u] = min(waiting.get(u, at), at)
            for u in [u for u, at in waiting.items() if at[0] < now]:
                ms, i = waiting.pop(u)
                until[u] = ms + ttl
                out.append(i)
            if frame is not None:
                top = max(top, int(frame["ms"].max()) + origin)
        return sorted(out)

    def drained(name, **kw):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        return st.run_to_table(st.first_articles(stream, **kw), name)

    _files(tmp_path / "in", [f.drop(columns="ms") for f in files])
    schema = "url string, event_id long, publishedAt timestamp_ntz, title string"
    for ttl in (2 * 86400, 30 * 86400):
        out = drained(f"first{ttl}", ttl_seconds=ttl, buckets=7).toPandas()
        assert sorted(out["event_id"]) == plain(ttl * 1000)
        assert (out["title"] == "text " + out["event_id"].astype(str)).all()
        assert pdf.set_index("event_id")["publishedAt"].loc[out["event_id"]].tolist() == out["publishedAt"].tolist()
    # the state's keys are buckets, not urls
    drained("first_keys", ttl_seconds=86400 * 60, buckets=7)
    base = max((p for p in (Path(st.checkpoint_dir(spark).removeprefix("file:")) / "streams").glob("first_keys-*")), key=lambda p: p.stat().st_mtime)
    keys = spark.read.format("statestore").option("path", f"{base}/_checkpoint").option("stateVarName", "emitted").load()
    assert 0 < keys.count() <= 7


def test_sentiment_windows_equal_the_batch_form(spark, tmp_path):
    from pyspark.sql import functions as F

    from marketlens.operators import text as tx
    rng = np.random.default_rng(5)
    days = np.sort(rng.choice(40, 90) * 1440 + rng.integers(0, 1440, 90))
    n = pd.DataFrame({"symbol": rng.choice(["x", "y", "z"], 90), "publishedAt": pd.Timestamp("2024-02-01") + pd.to_timedelta(days, unit="min"),
                      "title": rng.choice(["gain and loss", "strong growth", "weak", "nothing"], 90)})
    _files(tmp_path / "in", [n.iloc[i:i + 30] for i in (0, 30, 60)])
    stream = spark.readStream.schema("symbol string, publishedAt timestamp_ntz, title string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = st.run_to_table(st.sentiment_windows(stream), "sw").toPandas().sort_values(["symbol", "period"], ignore_index=True)
    closed = pd.Timestamp(n["publishedAt"].max() - pd.Timedelta(hours=1)).normalize()
    batch = spark.createDataFrame(n[n["publishedAt"] < closed])
    exp = tx.aggregate_by_period(tx.keyword_sentiment(batch), keys=["symbol"]).orderBy("symbol", "period").select(*out.columns).toPandas()
    assert (out["sentiment_score_count"] == 0).any()
    pd.testing.assert_frame_equal(out, exp, check_dtype=False)


def test_model_failures_are_shown(spark):
    from marketlens.operators import text as tx

    def factory():
        def predict(texts):
            if any("bad" in t for t in texts):
                raise ValueError("no word")
            return [("POSITIVE", 0.5)] * len(texts)
        return predict
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["good", "a bad one", None, " ", "fine"])], "i int, t string").coalesce(1)
    d = tx.model_sentiment(df, "t", factory)
    got = [tuple(r)[2:] for r in d.orderBy("i").collect()]
    assert got == [("positive", 0.5, 0.5, None), ("neutral", 1.0, 0.0, "ValueError: no word"), ("neutral", 1.0, 0.0, None), ("neutral", 1.0, 0.0, None),
                   ("positive", 0.5, 0.5, None)]
    assert {r.error: r.n for r in tx.model_failures(d).collect()} == {None: 4, "ValueError: no word": 1}


def test_isolation_forest_flags_contamination(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    x[:10] += 8.0
    df = spark.createDataFrame(pd.DataFrame({"id": range(400), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2]}))
    out = an.isolation_forest(df, ["a", "b", "c"], "id", n_trees=50).toPandas()
    assert abs((out["anomaly"] == -1).mean() - 0.1) < 0.02
    assert (out.sort_values("id")["anomaly"].iloc[:10] == -1).sum() >= 9


def test_moment_ridge_equals_closed_form(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(300, 2))
    y = X @ [1.5, -0.5] + rng.normal(0, 0.1, 300)
    df = spark.createDataFrame(pd.DataFrame({"a": X[:, 0], "b": X[:, 1], "y": y, "fold": np.arange(300) // 60}))
    m, _ = en.fold_moments(df, ["a", "b"], "y")
    w, b = en._ridge_solve(en._add(list(m.values())), 10.0)
    xc = X - X.mean(0)
    w2 = np.linalg.solve(xc.T @ xc + 10.0 * np.eye(2), xc.T @ (y - y.mean()))
    np.testing.assert_allclose(w, w2, rtol=1e-10)


def test_moment_ridge_equals_spark_linear_regression(spark):
    from marketlens.operators import models as md
    rng = np.random.default_rng(5)
    X = rng.normal(size=(250, 3))
    y = X @ [0.5, -1.0, 2.0] + rng.normal(0, 0.2, 250)
    df = spark.createDataFrame(pd.DataFrame({"a": X[:, 0], "b": X[:, 1], "c": X[:, 2], "y": y, "f": 0}))
    fitted = en.ridge_from_moments(df, ["a", "b", "c"], "y", 3.0)
    w, b = fitted.w, fitted.b
    spark_pred = md.fit_ridge(df, ["a", "b", "c"], "y", 3.0).transform(df).toPandas()["prediction"].to_numpy()
    np.testing.assert_allclose(X @ w + b, spark_pred, atol=1e-10)


def test_ridge_keeps_digits_at_price_scale(spark):
    """Columns near 1e8 with unit spread: raw moments would cancel."""
    rng = np.random.default_rng(9)
    X = rng.normal(size=(400, 2)) + [1e8, -3e7]
    y = (X - [1e8, -3e7]) @ [2.0, 1.0] + 5e6
    df = spark.createDataFrame(pd.DataFrame({"a": X[:, 0], "b": X[:, 1], "y": y}))
    w = en.ridge_from_moments(df, ["a", "b"], "y", 1e-6).w
    np.testing.assert_allclose(w, [2.0, 1.0], rtol=1e-6)


def test_expanding_ridge_backtest_equals_refits(spark, monkeypatch):
    from marketlens.operators import evaluate as ev
    monkeypatch.setattr(ev, "RUN", 3)  # several runs of blocks
    rng = np.random.default_rng(4)
    n = 260
    X = rng.normal(size=(n, 2))
    y = X @ [1.0, -2.0] + rng.normal(0, 0.3, n)
    pdf = pd.DataFrame({"symbol": "A", "date": pd.date_range("2024-01-01", periods=n), "a": X[:, 0], "b": X[:, 1], "y": y})
    got = ev.expanding_ridge_backtest(spark.createDataFrame(pdf), ["a", "b"], "y", 1.0, 100, 20).toPandas().sort_values("date")
    want = []
    for i in range(100, n):
        m = 100 + (i - 100) // 20 * 20
        xm, ym = X[:m].mean(0), y[:m].mean()
        w = np.linalg.solve((X[:m] - xm).T @ (X[:m] - xm) + np.eye(2), (X[:m] - xm).T @ (y[:m] - ym))
        want.append(ym + (X[i] - xm) @ w)
    np.testing.assert_allclose(got["prediction"], want, rtol=1e-9)


def test_positions_are_a_total_order(spark):
    from marketlens.operators import splits as sp
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"date": rng.integers(0, 3, 5000), "symbol": rng.permutation(5000)})
    d, n = sp.with_positions(spark.createDataFrame(pdf).repartition(7))
    got = d.toPandas().sort_values("_pos")
    assert n == 5000 and got["_pos"].tolist() == list(range(5000))
    assert got[["date", "symbol"]].values.tolist() == pdf.sort_values(["date", "symbol"]).values.tolist()


def test_lasso_path_follows_the_scale_of_the_target(spark):
    from marketlens.operators import select as se
    rng = np.random.default_rng(6)
    n = 300
    X = rng.normal(size=(n, 4))
    for scale in (1e-4, 1.0, 1e6):
        y = scale * (3 * X[:, 0] - X[:, 2] + rng.normal(0, 0.1, n))
        pdf = pd.DataFrame(X, columns=list("abcd")).assign(y=y, date=pd.date_range("2024-01-01", periods=n), symbol="A")
        sel, scores = se.select_lasso(spark.createDataFrame(pdf), list("abcd"), "y", 2)
        assert sel == ["a", "c"], (scale, sel)
