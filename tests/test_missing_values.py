"""Gaps in the series: averages as pandas computes them, barriers that keep their place."""
import numpy as np
import pandas as pd
import pytest

from marketlens.functions.panel import Panel
from marketlens.operators import labels as lb
from marketlens.operators import recurrence

from conftest import ohlcv


def _holes(kind: str, n: int = 700) -> pd.DataFrame:
    frames = []
    for symbol, seed in (("AAA", 1), ("BBB", 2)):
        pdf = ohlcv(n, symbol, seed)
        rng = np.random.default_rng(seed)
        gone = {"one": rng.random(n) < 0.0, "some": rng.random(n) < 0.3, "most": rng.random(n) < 0.9,
                "runs": (np.arange(n) // 150) % 2 == 1, "start": np.arange(n) < 90, "none": np.zeros(n, bool)}[kind].copy()
        if kind == "one":
            gone[100] = True
        pdf.loc[gone, "close"] = np.nan
        frames.append(pdf)
    return pd.concat(frames, ignore_index=True)


@pytest.mark.parametrize("kind", ["none", "one", "some", "most", "runs", "start"])
def test_ema_over_gaps_equals_pandas(spark, kind):
    pdf = _holes(kind)
    spans = {"e1": 1, "e2": 2, "e12": 12, "e26": 26, "e200": 200}
    p = Panel()
    d = spark.createDataFrame(pdf)  # NaN stays NaN: a gap, as NULL is
    out = p.finish(recurrence.ema_columns(p.prepare(d), p, {k: ("close", s) for k, s in spans.items()})).toPandas()
    out = out.sort_values(["symbol", "date"]).reset_index(drop=True)
    pdf = pdf.sort_values(["symbol", "date"]).reset_index(drop=True)
    for k, s in spans.items():
        want = pdf.groupby("symbol")["close"].transform(lambda c, s=s: c.ewm(span=s, adjust=False).mean())
        np.testing.assert_allclose(out[k].to_numpy(float), want.to_numpy(float), rtol=1e-9, err_msg=f"{kind} {k}")


def test_null_is_a_gap_too(spark):
    d = spark.createDataFrame([("A", i, None if i in (0, 3, 4) else float(i)) for i in range(8)], "symbol string, date int, close double")
    p = Panel()
    got = [r.e for r in p.finish(recurrence.ema_columns(p.prepare(d), p, {"e": ("close", 12)})).orderBy("date").collect()]
    want = pd.Series([np.nan, 1, 2, np.nan, np.nan, 5, 6, 7]).ewm(span=12, adjust=False).mean()
    assert got[0] is None and np.allclose(got[1:], want[1:])


def test_short_halo_is_refused(spark):
    p = Panel(shard_rows=1100)
    with pytest.raises(ValueError, match="halo_back"):
        recurrence.ema(spark.createDataFrame(ohlcv(50)), p, period=400).count()


def test_barrier_counts_rows_without_a_value(spark):
    closes = [100.0, None, 100.5, 103.0, 100.0] + [100.0] * 10 + [98.0, None, 97.0]
    d = spark.createDataFrame([("A", i, c) for i, c in enumerate(closes)], "symbol string, date int, close double")
    got = {r.date: r.triple_barrier for r in lb.triple_barrier(d).collect()}

    def plain(i, h=10):
        if closes[i] is None or i + h >= len(closes):
            return None
        for f in closes[i + 1:i + h + 1]:
            if f is not None and f / closes[i] - 1 >= 0.02:
                return 1
            if f is not None and f / closes[i] - 1 <= -0.01:
                return -1
        return 0
    assert got == {i: plain(i) for i in range(len(closes))}
