"""F1 by nearest neighbours: mutual information of each feature and the target without binning, exact at any size.

For two continuous variables (Kraskov et al., 2004): the distance of a point to its k-th neighbour in the plane (the larger of the
two differences) bounds an interval on either axis, and the numbers of points in these intervals give the estimate. For a
class target (Ross, 2014) the neighbour is looked for among the points of the same class, and the interval is counted among all.

How it runs, for all features at once, in tasks of bounded size:

* The plane of a feature is cut into strips of equal numbers of points by x, and strips into cells by y. A point's k-th
  neighbour in its own cell bounds its search; cells that the bound reaches (a halo, found from the table of cell edges) are asked for closer
  points, and the least k of all answers are the neighbours.
* Counts in an interval are differences of ranks. Each axis is cut into bins of equal numbers of points; a rank is the bin's
  first rank and a place among the bin's points, so an end of an interval is one row sent to one bin.

Tables of cell and bin edges are broadcast; cells and bins grow with the rows once there are ``EDGES`` of them, so the tables do not.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators import clean as cl
from marketlens.operators import splits as sp
from marketlens.session import cut_lineage

#: Points of a cell and of a bin, cells of a strip, and how many cells or bins a feature may have before they grow.
CELL, BIN, STRIP, EDGES = 256, 4096, 16, 1 << 18


def digamma(n: np.ndarray) -> np.ndarray:
    """Digamma of whole numbers above 0."""
    small = np.concatenate([[np.nan, 0.0], np.cumsum(1 / np.arange(1, 64))]) - 0.57721566490153286
    x = np.maximum(n, 64).astype(float)
    large = np.log(x) - 1 / (2 * x) - 1 / (12 * x ** 2) + 1 / (120 * x ** 4)
    return np.where(n < 64, small[np.minimum(n, 63).astype(int)], large)


def _spread(df: DataFrame, cols: Sequence[str], seed: int) -> DataFrame:
    """Columns scaled by their standard deviation, with a noise of 1e-10 that tells equal values apart (a function of the row's place)."""
    st = df.agg(*[x for i, c in enumerate(cols) for x in (F.stddev_pop(c).alias(f"s{i}"), F.avg(F.abs(F.col(c))).alias(f"m{i}"))]).first()
    out = {}
    for i, c in enumerate(cols):
        s = st[f"s{i}"] or 1.0
        noise = (F.xxhash64(F.lit(seed + i), F.col(sp.POS)).cast("double") / F.lit(float(1 << 63))) * F.lit(1e-10 * max(1.0, (st[f"m{i}"] or 0.0) / s))
        out[c] = F.col(c) / F.lit(float(s)) + noise
    return df.withColumns(out)


def _cut(d: DataFrame, by: list[str], value: str, size: int, out: str) -> DataFrame:
    """``out``: the number of the run of ``size`` rows of the group that a row is in, by rising ``value``."""
    placed = sp.positions_within(d, by, [value], "_place")
    return placed.withColumn(out, F.floor(F.col("_place") / size).cast("long")).drop("_place")


def _edges(d: DataFrame, by: list[str], value: str) -> pd.DataFrame:
    return d.groupBy(*by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(F.lit(1)).alias("n")).toPandas().sort_values(by)


def _counts(points: DataFrame, ends: DataFrame, n: int) -> DataFrame:
    """points: f, v; ends: f, id, v, r, side -> f, id, n: the points at most r from v (side 1 counts up to v + r, -1 takes off those below v - r).

    Distances are compared, not the rounded ends: the neighbour that set the radius lies just outside.
    """
    size = max(BIN, -(-n // EDGES))
    binned = _cut(points, ["f"], "v", size, "bin")
    edges = _edges(binned, ["f", "bin"], "v")
    table = {f: e["lo"].to_numpy() for f, e in edges.groupby("f")}
    shared = points.sparkSession.sparkContext.broadcast(table)

    def place(batches):
        for pdf in batches:
            at = np.zeros(len(pdf), np.int64)
            for f, own in pdf.groupby("f").indices.items():
                end = (pdf["v"] + pdf["side"] * pdf["r"]).to_numpy()[own]
                at[own] = np.maximum(np.searchsorted(shared.value[f], end, side="right") - 1, 0)
            yield pdf.assign(bin=at)

    asked = ends.mapInPandas(place, "f int, id long, v double, r double, side int, bin long")

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        known = np.sort(pdf["v"].to_numpy()[pdf["side"].to_numpy() == 0])
        q = pdf[pdf["side"] != 0]
        v, r, side = (q[c].to_numpy() for c in ("v", "r", "side"))
        at, last = np.searchsorted(known, v + side * r), len(known) - 1

        def before(i):
            """Whether the point i (a place in the bin) lies before the end: at most r above v, or more than r below it."""
            d = side * (known[np.clip(i, 0, max(last, 0))] - v)
            return np.where(side > 0, d <= r, d > r)
        while len(known):  # rounding moves an end by a place or two
            up = (at <= last) & before(at)
            down = (at > 0) & ~before(at - 1)
            if not (up | down).any():
                break
            at = at + up - (down & ~up)
        return pd.DataFrame({"f": q["f"], "id": q["id"], "n": side * (q["bin"].to_numpy() * size + at)}).astype({"f": "int32", "n": "int64"})

    both = binned.select("f", F.lit(-1).cast("long").alias("id"), "v", F.lit(0.0).alias("r"), F.lit(0).alias("side"), "bin").unionByName(asked)
    return both.groupBy("f", "bin").applyInPandas(count, "f int, id long, n long").groupBy("f", "id").agg(F.sum("n").alias("n"))


def _within(d: DataFrame, radius: DataFrame, axis: str, n: int) -> DataFrame:
    """f, id, n: points of the feature within the radius on ``axis``, the point itself too."""
    r = d.join(radius, ["f", "id"])
    ends = r.select("f", "id", F.col(axis).alias("v"), "r", F.explode(F.array(F.lit(1), F.lit(-1))).alias("side"))
    return _counts(d.select("f", F.col(axis).alias("v")), ends, n)


def _nearest(x, y, qx, qy, k: int) -> np.ndarray:
    """The k least distances of each query to the points (rows: queries), infinite where there are fewer points."""
    out = np.full((len(qx), k), np.inf)
    step = max(1, (1 << 22) // max(1, len(x)))
    for i in range(0, len(qx), step):
        dist = np.maximum(np.abs(qx[i:i + step, None] - x), np.abs(qy[i:i + step, None] - y))
        m = min(k, dist.shape[1])
        out[i:i + step, :m] = np.sort(np.partition(dist, m - 1, axis=1)[:, :m], axis=1)
    return out


def _plane_radius(d: DataFrame, k: int, n: int) -> DataFrame:
    """f, id, r: just under the distance to the k-th neighbour in the plane."""
    cell = max(CELL, -(-n // EDGES))
    d = _cut(d, ["f"], "x", cell * STRIP, "strip")
    d = cut_lineage(_cut(d, ["f", "strip"], "y", cell, "cell"))

    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf["x"].to_numpy(), pdf["y"].to_numpy()
        near = _nearest(x, y, x, y, k + 1)[:, 1:]  # the nearest is the point itself
        return pdf.assign(near=pd.Series(list(near), index=pdf.index, dtype=object))

    schema = "f int, id long, x double, y double, strip long, cell long, near array<double>"
    mine = cut_lineage(d.select("f", "id", "x", "y", "strip", "cell").groupBy("f", "strip", "cell").applyInPandas(own, schema))
    e = d.groupBy("f", "strip", "cell").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).toPandas()
    shared = d.sparkSession.sparkContext.broadcast({f: g.to_numpy(float) for f, g in e.set_index("f").groupby(level=0)})

    def reach(batches):
        """A row for each cell (not the point's own) that a point's bound reaches."""
        for pdf in batches:
            rows = []
            for f, at in pdf.groupby("f").indices.items():
                table = shared.value[f]
                for i in at:
                    x, y, r = pdf["x"].iat[i], pdf["y"].iat[i], pdf["near"].iat[i][-1]
                    hit = (table[:, 2] < x + r) & (table[:, 3] > x - r) & (table[:, 4] < y + r) & (table[:, 5] > y - r)
                    hit &= (table[:, 0] != pdf["strip"].iat[i]) | (table[:, 1] != pdf["cell"].iat[i])
                    rows += [(f, pdf["id"].iat[i], x, y, int(s), int(c), [r]) for s, c in table[hit, :2]]
            if rows:
                yield pd.DataFrame(rows, columns=["f", "id", "x", "y", "strip", "cell", "near"])

    asked = mine.mapInPandas(reach, schema)

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        q, p = pdf[pdf["asks"]], pdf[~pdf["asks"]]
        near = _nearest(p["x"].to_numpy(), p["y"].to_numpy(), q["x"].to_numpy(), q["y"].to_numpy(), k)
        bound = np.array([b[0] for b in q["near"]]) if len(q) else np.zeros(0)
        near = [row[row < b].tolist() for row, b in zip(near, bound)]
        return pd.DataFrame({"f": q["f"], "id": q["id"], "near": pd.Series(near, index=q.index, dtype=object)})

    both = asked.withColumn("asks", F.lit(True)).unionByName(mine.withColumn("asks", F.lit(False)))
    found = both.groupBy("f", "strip", "cell").applyInPandas(answer, "f int, id long, near array<double>")
    every = mine.select("f", "id", "near").unionByName(found).groupBy("f", "id").agg(F.array_sort(F.flatten(F.collect_list("near"))).alias("near"))
    return every.select("f", "id", F.element_at("near", k).alias("r"))


def _class_radius(d: DataFrame, k: int) -> DataFrame:
    """f, id, r, k, n_class: just under the distance to the k-th neighbour of the same class (fewer if the class is smaller)."""
    placed = sp.positions_within(d, ["f", "y"], ["x"], "_place")
    sizes = d.groupBy("f", "y").agg(F.count(F.lit(1)).alias("n_class"))
    # rows near an end of their run of BIN rows are in the neighbouring run too
    run = F.floor(F.col("_place") / BIN)
    runs = F.array_distinct(F.array(run, F.floor((F.col("_place") - k) / BIN), F.floor((F.col("_place") + k) / BIN)))
    spread = placed.withColumn("run", F.explode(runs)).withColumn("own", F.col("run") == run)

    def nearest(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_place")
        x, m = pdf["x"].to_numpy(), int(min(k, pdf["n_class"].iloc[0] - 1))
        near = np.full((len(x), 2 * k), np.inf)
        for i in range(1, min(k, len(x) - 1) + 1):
            step = x[i:] - x[:-i]
            near[i:, 2 * i - 2], near[:-i, 2 * i - 1] = step, step
        near.sort(axis=1)
        r = near[:, m - 1] if m else np.full(len(x), np.nan)
        return pd.DataFrame({"f": pdf["f"], "id": pdf["id"], "r": r, "k": m, "n_class": pdf["n_class"]})[pdf["own"]]

    rows = spread.join(sizes, ["f", "y"]).groupBy("f", "y", "run").applyInPandas(nearest, "f int, id long, r double, k int, n_class long")
    return rows.where("n_class > 1")  # a class of one row says nothing


def _mean_digamma(counts: DataFrame, cols: Sequence[str]) -> DataFrame:
    """f and the mean digamma of each column."""
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"f": pdf["f"], **{c: digamma(pdf[c].to_numpy()) for c in cols}})
    d = counts.select("f", *cols).mapInPandas(run, "f int, " + ", ".join(f"{c} double" for c in cols))
    return d.groupBy("f").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in cols])


def _just_under(r: DataFrame) -> DataFrame:
    def run(batches):
        for pdf in batches:
            yield pdf.assign(r=np.nextafter(pdf["r"].to_numpy(float), 0))
    return r.mapInPandas(run, r.schema)


def knn_mutual_information(df: DataFrame, features: Sequence[str], target: str, task: str = "regression", k: int = 3,
                           order: str = "date", seed: int = 42) -> DataFrame:
    """F1: feature, score (nats, 0 at least) of every feature. Missing numbers are the column's median; rows without a class are left out.

    Ties are broken by a noise of 1e-10 that depends on the row's place by (``order``, symbol). Fewer than k + 1 rows score 0.
    """
    feats, classes = list(features), task == "classification"
    d = cl.median_impute(df, feats if classes else [*feats, target])
    d = d.where(F.col(target).isNotNull())
    d, n = sp.with_positions(d, order, [c for c in ("symbol",) if c in d.columns])
    spark = df.sparkSession
    names = spark.createDataFrame(list(enumerate(feats)), "f int, feature string")
    if n <= k + 1:
        return names.select("feature", F.lit(0.0).alias("score"))
    d = _spread(d, feats if classes else [*feats, target], seed)
    y = F.col(target).cast("string") if classes else F.col(target)
    long = cut_lineage(d.select(F.col(sp.POS).alias("id"), y.alias("y"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("f"), F.col(c).alias("x")) for i, c in enumerate(feats)])).alias("p")).select("p.f", "id", "p.x", "y"))
    if classes:
        radius = cut_lineage(_just_under(_class_radius(long, k)))
        # only points whose class has two rows are among all
        pairs = radius.select("f", "id", "k", "n_class")
        kept = long.join(pairs.select("f", "id"), ["f", "id"])
        counts = _within(kept, radius.select("f", "id", "r"), "x", n).withColumnRenamed("n", "m").join(pairs, ["f", "id"])
        mean = _mean_digamma(counts, ["k", "n_class", "m"])
        total = F.col("k") - F.col("n_class") - F.col("m")
    else:
        radius = cut_lineage(_just_under(_plane_radius(long, k, n)))
        nx, ny = (_within(long, radius, a, n).withColumnRenamed("n", f"n{a}") for a in ("x", "y"))
        mean = _mean_digamma(nx.join(ny, ["f", "id"]), ["nx", "ny"])
        total = F.lit(float(digamma(np.array([k]))[0])) - F.col("nx") - F.col("ny")
    psi_n = F.udf(lambda v: float(digamma(np.array([v]))[0]), "double")  # a row for each feature
    got = mean.select("f", F.greatest(F.lit(0.0), psi_n("n") + total).alias("score"))
    return names.join(got, "f", "left").select("feature", F.coalesce("score", F.lit(0.0)).alias("score"))
