"""Stratified folds, recursive elimination for classes, nearest-neighbour mutual information, all against plain versions."""
import numpy as np
import pandas as pd
import pytest

from marketlens.operators import knn_mi as km
from marketlens.operators import select as se
from marketlens.operators import splits as sp


def plain_folds(y, k):
    """The rule as it is described: classes in order of first row, rows dealt round as if sorted by class."""
    order = list(dict.fromkeys(y))
    code = np.array([order.index(v) for v in y])
    dealt = np.sort(code)
    fold = np.zeros(len(y), int)
    for c in range(len(order)):
        sizes = [int((dealt[i::k] == c).sum()) for i in range(k)]
        fold[code == c] = np.repeat(np.arange(k), sizes)
    return fold


@pytest.mark.parametrize("weights", [(0.7, 0.25, 0.05), (0.02, 0.01, 0.97)])
def test_stratified_folds(spark, weights):
    rng = np.random.default_rng(1)
    y = rng.choice(["up", "down", "flat"], 503, p=weights)
    pdf = pd.DataFrame({"date": pd.date_range("2020-01-01", periods=503, freq="h"), "symbol": "s", "y": y})
    df = spark.createDataFrame(pdf.sample(frac=1, random_state=2))
    got = sp.stratified_folds(df, "y", 5).orderBy("date").toPandas()
    assert got["fold"].tolist() == plain_folds(list(y), 5).tolist()
    none = spark.createDataFrame(pdf.assign(y=pd.Series([None] * 500 + ["a", "b", "a"])))
    assert sp.stratified_folds(none, "y", 2).count() == 3


def test_rfecv_finds_the_classes_features(spark):
    rng = np.random.default_rng(2)
    n = 600
    x = rng.normal(size=(n, 6))
    y = np.where(x[:, 0] + x[:, 2] > 0.4, "up", np.where(x[:, 0] + x[:, 2] < -0.4, "down", "flat"))
    pdf = pd.DataFrame(x, columns=[f"f{i}" for i in range(6)]).assign(y=y, date=pd.date_range("2020-01-01", periods=n), symbol="s")
    df = spark.createDataFrame(pdf)
    best, scores = se.select_rfecv(df, [f"f{i}" for i in range(6)], "y", 2, k=3, num_trees=15, max_depth=5, task="classification")
    rank = {r.feature: -r.score for r in scores.collect()}
    assert {"f0", "f2"} <= set(best) and all(rank[f] == 1 for f in best)
    assert sorted(set(rank.values())) == list(range(1, 1 + len(set(rank.values()))))


def plain_mi(x, y, k=3):
    n = len(x)
    dist = np.maximum(np.abs(x[:, None] - x), np.abs(y[:, None] - y))
    r = np.nextafter(np.sort(dist, axis=1)[:, k], 0)
    nx = (np.abs(x[:, None] - x) <= r[:, None]).sum(axis=1)
    ny = (np.abs(y[:, None] - y) <= r[:, None]).sum(axis=1)
    psi = km.digamma
    return max(0.0, float(psi(np.array([n]))[0] + psi(np.array([k]))[0] - psi(nx).mean() - psi(ny).mean()))


def plain_class_mi(x, y, k=3):
    r, ks, sizes = np.zeros(len(x)), np.zeros(len(x), int), np.zeros(len(x), int)
    for c in set(y):
        at = np.flatnonzero(y == c)
        sizes[at], ks[at] = len(at), min(k, len(at) - 1)
        if len(at) > 1:
            r[at] = np.nextafter(np.sort(np.abs(x[at][:, None] - x[at]), axis=1)[:, ks[at[0]]], 0)
    on = sizes > 1
    m = (np.abs(x[on][:, None] - x[on]) <= r[on][:, None]).sum(axis=1)
    psi = km.digamma
    return max(0.0, float(psi(np.array([on.sum()]))[0] + psi(ks[on]).mean() - psi(sizes[on]).mean() - psi(m).mean()))


def test_digamma():
    # digamma(n) = harmonic(n - 1) - gamma
    for n in (1, 2, 63, 64, 65, 1000):
        assert km.digamma(np.array([n]))[0] == pytest.approx(sum(1 / i for i in range(1, n)) - 0.5772156649015329, abs=1e-10)


def _scaled(v):
    return v / v.std()


def test_nearest_neighbour_information(spark, monkeypatch):
    monkeypatch.setattr(km, "CELL", 20)  # many cells and bins on a small table
    monkeypatch.setattr(km, "BIN", 50)
    monkeypatch.setattr(km, "STRIP", 4)
    rng = np.random.default_rng(3)
    n = 700
    y = rng.normal(size=n)
    cols = {"same": 2 * y + 0.01 * rng.normal(size=n), "noisy": y + rng.normal(size=n), "none": rng.normal(size=n), "square": y ** 2, "heavy": rng.standard_cauchy(n)}
    pdf = pd.DataFrame(cols).assign(y=y, date=pd.date_range("2020-01-01", periods=n), symbol="s")
    got = {r.feature: r.score for r in km.knn_mutual_information(spark.createDataFrame(pdf), list(cols), "y").collect()}
    for c, v in cols.items():
        assert got[c] == pytest.approx(plain_mi(_scaled(v), _scaled(y)), abs=2e-4), c
    assert got["same"] > got["square"] > got["noisy"] > got["none"]


def test_nearest_neighbour_information_of_classes(spark, monkeypatch):
    monkeypatch.setattr(km, "BIN", 40)
    rng = np.random.default_rng(4)
    n = 600
    x = rng.normal(size=n)
    y = np.where(x > 0.5, "up", np.where(x < -2.3, "rare", "down"))
    y[0] = "once"
    cols = {"x": x, "none": rng.normal(size=n)}
    pdf = pd.DataFrame(cols).assign(y=y, date=pd.date_range("2020-01-01", periods=n), symbol="s")
    got = {r.feature: r.score for r in km.knn_mutual_information(spark.createDataFrame(pdf), list(cols), "y", "classification").collect()}
    for c, v in cols.items():
        assert got[c] == pytest.approx(plain_class_mi(_scaled(v), y), abs=2e-4), c


def test_edges_of_information(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, None], "c": [5.0] * 3, "y": [1.0, 2.0, 3.0], "date": pd.date_range("2020-01-01", periods=3)})
    assert [r.score for r in km.knn_mutual_information(spark.createDataFrame(pdf), ["a", "c"], "y").collect()] == [0.0, 0.0]
