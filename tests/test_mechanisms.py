"""Gram correlations, mergeable profiles, batched mixtures, file identities, stops and quantiles under adverse sketches."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlens.operators import boosting as bo
from marketlens.operators import checks as ck
from marketlens.operators import gram
from marketlens.operators import mixture as mx
from marketlens.operators import models as md
from marketlens.operators import quantiles as qt
from marketlens.operators.cache import FeatureCache, fingerprint, scan_identity


def _holes(rng, n, p):
    x = rng.normal(size=(n, p)) + 1e6  # far from zero: moments must not cancel
    x[:, 1] = x[:, 0] + rng.normal(size=n)
    x[:, 2] = 7.0
    x[rng.random((n, p)) < 0.3] = np.nan
    x[:, 3] = np.nan
    return pd.DataFrame(x, columns=[f"c{i:02d}" for i in range(p)])


def _pairs(pdf):
    return {(a, b): pdf[[a, b]].dropna() for i, a in enumerate(pdf.columns) for b in pdf.columns[i + 1:]}


def _check(got, pdf):
    assert len(got) == len(_pairs(pdf))
    for (a, b), both in _pairs(pdf).items():
        r = np.corrcoef(both[a], both[b])[0, 1] if len(both) > 1 and both[a].nunique() > 1 and both[b].nunique() > 1 else None
        have, n = got[a, b]
        assert n == len(both) and (have is None if r is None else have == pytest.approx(r, abs=1e-6)), (a, b)


def test_gram_correlations_are_pairwise_complete(spark, monkeypatch):
    monkeypatch.setattr(gram, "BLOCK", 5)
    monkeypatch.setattr(gram, "CELLS", 400)
    pdf = _holes(np.random.default_rng(0), 300, 13)
    wide = spark.createDataFrame(pdf.reset_index())
    _check({(r.a, r.b): (r.correlation, r.n) for r in gram.wide_correlations(wide, list(pdf.columns)).collect()}, pdf)
    pdf = pdf.drop(columns="c03")  # a column without a value is no column of the long form
    long = pdf.reset_index().melt("index").dropna()
    got = gram.long_correlations(spark.createDataFrame(long), "index", "variable", "value").collect()
    _check({(r.a, r.b): (r.correlation, r.n) for r in got}, pdf)


def test_long_gram_tasks_hold_one_pair_of_blocks(spark, monkeypatch):
    """No task makes the products of all pairs of blocks of its rows: with many columns those are larger than the input squared."""
    def whole(*_):
        raise AssertionError("all pairs of blocks at once")
    monkeypatch.setattr(gram, "_blocks", whole)
    monkeypatch.setattr(gram, "LONG_BLOCK", 4)
    pdf = _holes(np.random.default_rng(4), 60, 14).drop(columns="c03")
    pdf.iloc[:55, 5:9] = np.nan  # blocks that share few or no rows of a bucket
    pdf.iloc[30:, 9:] = np.nan
    long = spark.createDataFrame(pdf.reset_index().melt("index").dropna())
    for cells, side in ((1 << 20, 64), (40, 1), (40, 1000)):  # one bucket, several in one split, several splits
        monkeypatch.setattr(gram, "CELLS", cells)
        monkeypatch.setattr(gram, "SIDE_BY_SIDE", side)
        got = gram.long_correlations(long, "index", "variable", "value").collect()
        _check({(r.a, r.b): (r.correlation, r.n) for r in got}, pdf)


def test_long_gram_sends_parts_to_groups_of_blocks(spark, monkeypatch):
    """With many blocks of columns a part goes to each group of blocks, not to each block: what is shuffled does not grow with the square of the columns."""
    monkeypatch.setattr(gram, "LONG_BLOCK", 2)
    monkeypatch.setattr(gram, "SIDE_BY_SIDE", 1)
    monkeypatch.setattr(gram, "GROUPS", 7, raising=False)
    pdf = _holes(np.random.default_rng(5), 40, 64).drop(columns="c03")  # 32 blocks, the last of one column
    pdf.iloc[:35, 40:50] = np.nan  # groups that share few or no rows of a bucket
    pdf.iloc[20:, 50:] = np.nan
    long = spark.createDataFrame(pdf.reset_index().melt("index").dropna())
    for cells, held in ((1 << 20, 1 << 22), (20, 1 << 22), (20, 200), (20, 1)):  # one bucket, several, narrower groups, one block each
        monkeypatch.setattr(gram, "CELLS", cells)
        monkeypatch.setattr(gram, "HELD", held, raising=False)
        got = gram.long_correlations(long, "index", "variable", "value").collect()
        _check({(r.a, r.b): (r.correlation, r.n) for r in got}, pdf)

    def counts(*_):
        def run(batches):
            import pyarrow as pa
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array(["sent"]), pa.array([""]), pa.array([0.0]), pa.array([b.num_rows])], names=["a", "b", "correlation", "n"])
        return run

    monkeypatch.setattr(gram, "CELLS", 1 << 20)
    monkeypatch.setattr(gram, "HELD", 1 << 22, raising=False)
    monkeypatch.setattr(gram, "_products", counts)
    monkeypatch.setattr(gram, "_grouped", counts, raising=False)
    sent = gram.long_correlations(long, "index", "variable", "value").agg(F.sum("n")).first()[0]
    assert sent <= 32 * 9  # 32 parts, groups of four blocks or more


def test_profiles_merge(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"day": np.repeat([1, 2, 3], 400), "x": rng.normal(5, 2, 1200), "k": rng.integers(0, 900, 1200), "s": rng.choice(list("abcde"), 1200)})
    pdf.loc[pdf.index % 7 == 0, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x"))).withColumn("none", F.lit(None).cast("double"))
    states = None
    for d in (1, 2, 3):  # kept apart, as for partitions that never change
        s = ck.profile_state(df.where(F.col("day") == d).drop("day"))
        states = s if states is None else states.unionByName(s)
    got = {r.column: r for r in ck.profile_of(states).collect()}
    want = {r.column: r for r in ck.profile(df.drop("day")).collect()}
    assert set(got) == set(want) == {"x", "k", "s", "none"}
    for c in want:
        assert (got[c].non_null_count, got[c].null_count, got[c].min, got[c].max) == (want[c].non_null_count, want[c].null_count, want[c].min, want[c].max)
        for f in ("mean", "std"):
            a, b = getattr(got[c], f), getattr(want[c], f)
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-9))
        assert got[c].unique_values == pytest.approx(want[c].unique_values, rel=0.05)
    assert want["k"].unique_values == pdf["k"].nunique() and want["x"].unique_values == pdf["x"].nunique()
    by_day = ck.profile_state(df, ["day"])
    assert {r.column: r.unique_values for r in ck.profile_of(by_day).collect()} == {c: pytest.approx(got[c].unique_values, rel=0.05) for c in got}
    assert {r.column: (r.non_null_count, r.unique_values) for r in ck.profile(df.limit(0)).collect()} == {c: (0, 0) for c in df.columns}


def test_distinct_zero_and_nan(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (None,), (1.0,)], "v double")
    assert ck.profile(df).first().unique_values == df.agg(F.countDistinct("v")).first()[0] == 3


def _plain_em(x, k, centres, rounds):
    """One start, as a loop over rows and components."""
    own = ((x[:, None] - centres) ** 2).sum(-1).argmin(axis=1)
    r, last = np.eye(k)[own], -np.inf
    for _ in range(rounds + 1):
        n = r.sum(axis=0) + 10 * np.finfo(float).eps
        w, m = n / n.sum(), (r.T @ x) / n[:, None]
        c = [((r[:, i, None] * (x - m[i])).T @ (x - m[i])) / n[i] + 1e-6 * np.eye(x.shape[1]) for i in range(k)]
        logs = np.stack([np.log(w[i]) - 0.5 * np.log(np.linalg.det(2 * np.pi * c[i])) - 0.5 * np.einsum("nd,de,ne->n", x - m[i], np.linalg.inv(c[i]), x - m[i])
                         for i in range(k)], axis=1)
        ll = np.log(np.exp(logs).sum(axis=1)).mean()
        if abs(ll - last) < mx.TOLERANCE:
            break
        last, r = ll, np.exp(logs) / np.exp(logs).sum(axis=1, keepdims=True)
    return ll, w, m


def test_mixture_of_all_starts_equals_one_after_another(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal((0, 0), 1, (150, 2)), rng.normal((6, 1), (0.5, 2), (200, 2)), rng.normal((-4, 5), 1, (80, 2))])
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"])).repartition(3)
    m = mx.Mixture.fit(df, ["a", "b"], 3, starts=4, seed=7)
    order = F.xxhash64(F.lit(7), F.col("a"), F.col("b"))
    sample = np.array([list(r) for r in df.orderBy(order).limit(mx.SAMPLE).collect()])
    draw = np.random.default_rng(7)
    runs = [_plain_em(x, 3, mx._centres(sample, 3, draw), 200) for _ in range(4)]
    best = max(runs, key=lambda r: r[0])
    assert m.log_likelihood / len(x) == pytest.approx(best[0], abs=1e-9)
    np.testing.assert_allclose(sorted(m.weights), sorted(best[1]), atol=1e-6)
    assert all(b >= a - 1e-9 for h in m.history for a, b in zip(h, h[1:]))  # each round gains
    got = m.transform(df).collect()
    assert all(sum(r.probability) == pytest.approx(1) and r.cluster == int(np.argmax(r.probability)) for r in got)
    assert len({(r.a > 3, r.a < -2) for r in got if r.cluster == got[0].cluster}) <= 2


def test_stop_with_patience():
    assert bo.stopping_round([5, 4, 3, 4, 4, 4, 1], 3) == 3  # the gain after three rounds without one is not seen
    assert bo.stopping_round([5, 4, 3, 4, 4, 2, 1], 3) == 7
    assert bo.stopping_round([1], 20) == 1 and bo.stopping_round([2, 2, 2], 2) == 1


def test_prefixes_of_an_ensemble(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    pdf = pd.DataFrame(x, columns=list("abc")).assign(y=np.nan_to_num(x[:, 0]) * 2 + (np.nan_to_num(x[:, 1]) > 0) + rng.normal(0, 1, 400))
    df = spark.createDataFrame(pdf)
    train, val = df.limit(250), df.subtract(df.limit(250))
    model, errors, rounds = bo.fit_with_patience(md.boosted_regressor(list("abc"), "y", maxIter=25, maxDepth=3, stepSize=0.5), train, val, list("abc"), "y", 4)
    whole = md.boosted_regressor(list("abc"), "y", maxIter=25, maxDepth=3, stepSize=0.5).fit(train)
    want = whole.stages[-1].evaluateEachIteration(whole.stages[0].transform(val), "squared")
    got = [r.mse for r in errors.orderBy("round").collect()]
    np.testing.assert_allclose(got, want, rtol=1e-9)
    assert rounds == bo.stopping_round(want, 4) < 25 and model.stages[-1].getNumTrees == rounds
    mse = model.transform(val).agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0]
    assert mse == pytest.approx(got[rounds - 1])
    assert bo.staged_errors(whole.stages[-1], df.limit(0), list("abc"), "y").count() == 0


def test_cache_knows_files_without_a_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).withColumn("v", F.col("id") * 2).repartition(3).write.parquet(path)
    df = spark.read.parquet(path)
    first = scan_identity(df)
    assert first and first == scan_identity(spark.read.parquet(path)) and fingerprint(df) == first
    assert scan_identity(df.select("v")) not in (None, first)
    assert scan_identity(df.where("v > 4")) is None and scan_identity(spark.range(3)) is None and scan_identity(df.withColumn("w", F.lit(1))) is None
    cache = FeatureCache(str(tmp_path / "cache"))

    def twice(d):
        return d.withColumn("v", F.col("v") * 2)
    jobs = spark.sparkContext.statusTracker()
    cache.get_or_compute(df, twice)
    spark.sparkContext.setJobGroup("hit", "a hit")
    again = cache.get_or_compute(spark.read.parquet(path), twice)
    spark.sparkContext.setJobGroup("rest", "")
    # the only jobs of a hit read the schemas of the two tables
    assert cache.hits == 1 and len(jobs.getJobIdsForGroup("hit")) <= 2 and again.count() == 1000
    spark.range(5).withColumn("v", F.col("id")).write.mode("append").parquet(path)
    assert cache.get_or_compute(spark.read.parquet(path), twice).count() == 1005 and cache.misses == 2


def test_quantiles_narrow_whatever_the_sketch(spark, monkeypatch):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 6000), "x": np.concatenate([rng.normal(size=3000), 10.0 ** rng.uniform(-200, 200, 2000), np.full(1000, 0.25)])})
    df = spark.createDataFrame(pdf)
    rounds = []
    drawn = qt._drawn
    monkeypatch.setattr(qt, "_drawn", lambda *a: rounds.append(1) or drawn(*a))

    def useless(d, state, keys, at, rank):  # the old bounds, whatever the values
        return state.select(*keys, *[c for i, j in at for c in (f"lo{i}_{j}", f"hi{i}_{j}")])
    monkeypatch.setattr(qt, "_sketched", useless)
    got = {r.g: r for r in qt.exact_quantiles(df, ["x"], [0.25, 0.5, 0.9], ["g"], few=50).collect()}
    for g, own in pdf.groupby("g"):
        np.testing.assert_allclose([got[g][f"q_x_{j}"] for j in range(3)], own["x"].quantile([0.25, 0.5, 0.9]), rtol=1e-12)
    assert 2 <= len(rounds) < 20


def test_day_steps(spark):
    rows = [("a", "2024-01-01 23:00:00"), ("a", "2024-01-02 01:00:00"), ("b", "2024-01-01 00:00:00"), ("b", "2024-01-03 00:00:00"), (None, "2024-01-05 00:00:00"),
            (None, "2024-01-06 00:00:00"), ("c", None)]
    days = spark.createDataFrame(rows, "k string, t string").select("k", F.to_date(F.col("t").cast("timestamp")).alias("_day"))
    assert {r.k for r in ck._day_steps(days, ["k"]).collect()} == {"a", None}
