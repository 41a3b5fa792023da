import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketlens.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", shuffle_partitions=4)
    yield s


def ohlcv(n: int, symbol: str = "AAPL", seed: int = 42, start: str = "2024-01-01", trend=(100.0, 150.0)):
    """FX1-style bars: linear trend + N(0,1), high/low widened to contain open and close (seeded)."""
    rng = np.random.default_rng(seed)
    base = np.linspace(trend[0], trend[1], n) + rng.normal(0, 1, n)
    op = base + rng.normal(0, 0.5, n)
    high = np.maximum(np.maximum(base + 5, op), base)
    low = np.minimum(np.minimum(base - 5, op), base)
    return pd.DataFrame({"symbol": symbol, "date": pd.date_range(start, periods=n, freq="D").date,
                         "open": op, "high": high, "low": low, "close": base,
                         "volume": rng.uniform(1e6, 1e7, n)})


@pytest.fixture(scope="session")
def bars_pdf():
    return pd.concat([ohlcv(400, "AAA", 1), ohlcv(400, "BBB", 2, trend=(50.0, 20.0))], ignore_index=True)


@pytest.fixture(scope="session")
def bars(spark, bars_pdf):
    return spark.createDataFrame(bars_pdf)
