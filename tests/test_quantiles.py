"""Exact quantiles against pandas, with ties, few values, groups and several rounds."""
import numpy as np
import pandas as pd
import pytest

from marketlens.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("few", [10, 100_000])
@pytest.mark.parametrize("keys", [(), ("k",)])
def test_equals_pandas(spark, few, keys):
    rng = np.random.default_rng(1)
    n = 6000
    pdf = pd.DataFrame({"k": rng.choice(["a", "b", "c"], n, p=[0.8, 0.19, 0.01]), "u": rng.normal(size=n),
                        "t": rng.integers(0, 4, n).astype(float), "s": np.exp(rng.normal(0, 5, n))})
    pdf.loc[rng.random(n) < 0.1, "u"] = np.nan
    pdf.loc[pdf.k == "c", "t"] = np.nan
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(spark.createDataFrame(pdf), ["u", "t", "s"], probs, keys, few).toPandas()
    groups = [((), pdf)] if not keys else [((k,), g) for k, g in pdf.groupby("k")]
    assert len(got) == len(groups)
    for k, g in groups:
        row = got.iloc[0] if not keys else got[got.k == k[0]].iloc[0]
        for c in ("u", "t", "s"):
            for j, p in enumerate(probs):
                want = g[c].quantile(p)
                have = row[f"q_{c}_{j}"]
                assert (np.isnan(want) and (have is None or np.isnan(have))) or np.isclose(have, want, rtol=1e-12), (k, c, p, have, want)


def test_small_and_empty(spark):
    for values in ([1.0], [2.0, 1.0], [3.0, 1.0, 2.0], [5.0] * 7 + [6.0]):
        d = spark.createDataFrame([(v,) for v in values], "x double")
        r = exact_quantiles(d, ["x"], [0.25, 0.5, 0.75], few=1).first()
        assert np.allclose([r[0], r[1], r[2]], pd.Series(values).quantile([0.25, 0.5, 0.75]))
    r = exact_quantiles(spark.createDataFrame([], "x double"), ["x"], [0.5]).first()
    assert r[0] is None
