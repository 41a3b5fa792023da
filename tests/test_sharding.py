"""The sharded panel (hot keys split across tasks with halos) must equal the plain panel."""
import numpy as np
import pandas as pd

from marketlens.functions.panel import Panel
from marketlens.operators import features as fe
from marketlens.operators import indicators as ind
from marketlens.operators import labels as lb

from conftest import ohlcv

PLAIN = Panel()
SHARD = Panel(shard_rows=1100, halo_back=1024, halo_fwd=32)


def _big(spark):
    pdf = pd.concat([ohlcv(3500, "HOT", 5), ohlcv(300, "COLD", 6)], ignore_index=True)
    return spark.createDataFrame(pdf)


def _cmp(a, b, cols):
    a = a.toPandas().sort_values(["symbol", "date"]).reset_index(drop=True)
    b = b.toPandas().sort_values(["symbol", "date"]).reset_index(drop=True)
    assert len(a) == len(b)
    for c in cols:
        np.testing.assert_allclose(a[c].to_numpy(dtype=float), b[c].to_numpy(dtype=float), rtol=1e-9, atol=1e-9,
                                   err_msg=c)


def test_sharded_indicators(spark):
    d = _big(spark)
    _cmp(ind.all_indicators(d, PLAIN), ind.all_indicators(d, SHARD), ind.ALL_INDICATORS)


def test_sharded_features(spark):
    d = _big(spark)
    _cmp(fe.engineer_features(d, PLAIN), fe.engineer_features(d, SHARD), fe.FEATURES_47)


def test_sharded_labels(spark):
    d = _big(spark)
    cols = ["return_1d", "return_20d", "vol_20d", "triple_barrier", "direction_class_5d"]
    _cmp(lb.create_targets(d, PLAIN), lb.create_targets(d, SHARD), cols)


def test_shards_split_the_hot_key(spark):
    d = SHARD.prepare(_big(spark))
    per = d.where("NOT _halo").groupBy("symbol", "_shard").count().toPandas()
    hot = per[per.symbol == "HOT"]
    assert hot["_shard"].nunique() == 4 and hot["count"].max() == 1100


def test_single_operators_on_shards(spark):
    from marketlens.operators import aggregates as ag
    from marketlens.operators import clean as cl
    from marketlens.operators import recurrence as rc
    d = _big(spark)
    long = Panel(shard_rows=2100, halo_back=2050, halo_fwd=32)
    cases = [(lambda p: ind.sma(d, p), ["sma_20"]), (lambda p: ind.bollinger(d, p), ["bb_upper", "bb_lower"]),
             (lambda p: ind.momentum(d, p), ["momentum_10"]), (lambda p: ind.roc(d, p), ["roc_12"]),
             (lambda p: ind.williams_r(d, p), ["williams_r"]), (lambda p: fe.lag_features(d, p), ["close_lag_7"]),
             (lambda p: fe.benchmark_rolling(d, p), ["rolling_std_20"]), (lambda p: fe.benchmark_features(d, p), ["close_ma_20", "momentum_5"]),
             (lambda p: fe.relative_features(d, p), ["close_52w_high_pct"]), (lambda p: lb.forward_returns(d, p), ["return_20d", "vol_20d"]),
             (lambda p: lb.triple_barrier(d, p), ["triple_barrier"])]
    for fn, cols in cases:
        _cmp(fn(PLAIN), fn(SHARD), cols)
    _cmp(rc.ema(d, PLAIN, period=50), rc.ema(d, SHARD, period=50), ["ema_50"])
    _cmp(rc.ema(d, PLAIN, period=120), rc.ema(d, long, period=120), ["ema_120"])
    roll = fe.rolling_features
    _cmp(roll(d, PLAIN, windows=(2000,), functions=("mean",)), roll(d, long, windows=(2000,), functions=("mean",)), ["close_rolling_2000_mean"])
    holes = d.selectExpr("symbol", "date", "CASE WHEN day(date) = 3 AND month(date) = 2 THEN close END AS close")
    _cmp(cl.ffill_then_zero(holes, PLAIN), cl.ffill_then_zero(holes, SHARD), ["close"])
    assert sorted(map(tuple, ag.day_gaps(d, PLAIN).collect())) == sorted(map(tuple, ag.day_gaps(d, SHARD).collect()))


def test_looks_beyond_the_halo_are_refused(spark):
    import pytest
    with pytest.raises(ValueError):
        fe.rolling_features(_big(spark), SHARD, windows=(2000,))
    with pytest.raises(ValueError):
        lb.forward_returns(_big(spark), SHARD, horizons=(50,))
