"""Isolation-forest anomaly flags, built and scored on Spark.

1. Tree samples: every row draws a hash-based uniform per tree (deterministic,
   so a recomputed partition draws the same values); each tree keeps the
   ``max_samples`` rows with the smallest draws - a window per tree over about
   twice that many candidates, never over the data.
2. Trees: ``groupBy(tree).applyInPandas`` grows one isolation tree per group
   (random feature, uniform split between the node's min and max, depth limit
   ceil(log2(max_samples))).
3. The forest (trees x <= 2*max_samples nodes, a bounded model) is sent to the
   workers and ``mapInPandas`` scores Arrow batches with vectorised traversal.
4. The score threshold is the (1 - contamination) quantile of the scores:
   rows above it are flagged -1, others 1.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators.quantiles import exact_quantiles
from marketlens.session import cut_lineage

_EULER = 0.5772156649015329


def _c(n: float) -> float:
    """Average path length of an unsuccessful search in a BST of n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + _EULER) - 2.0 * (n - 1) / n


NODE_SCHEMA = ("tree int, node int, feature int, threshold double, left int, right int, "
               "leaf_path double")


def _grow(pdf: pd.DataFrame, n_features: int, max_depth: int, seed: int) -> pd.DataFrame:
    tree = int(pdf["_tree"].iloc[0])
    x = np.array(pdf["_x"].tolist(), dtype=float).reshape(len(pdf), n_features)
    rng = np.random.default_rng([seed, tree])
    rows = []

    def build(idx: np.ndarray, depth: int) -> int:
        node = len(rows)
        rows.append(None)
        sub = x[idx]
        lo, hi = (sub.min(axis=0), sub.max(axis=0)) if len(idx) else (None, None)
        usable = np.flatnonzero(hi > lo) if len(idx) > 1 else np.array([], dtype=int)
        if depth >= max_depth or len(idx) <= 1 or usable.size == 0:
            rows[node] = (tree, node, -1, 0.0, -1, -1, depth + _c(len(idx)))
            return node
        f = int(rng.choice(usable))
        t = float(rng.uniform(lo[f], hi[f]))
        go_left = sub[:, f] < t
        left = build(idx[go_left], depth + 1)
        right = build(idx[~go_left], depth + 1)
        rows[node] = (tree, node, f, t, left, right, 0.0)
        return node

    build(np.arange(len(x)), 0)
    return pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "left", "right", "leaf_path"])


def isolation_forest(df: DataFrame, features: Sequence[str] | str, id_col: str, n_trees: int = 100,
                     max_samples: int = 256, contamination: float = 0.1, seed: int = 42) -> DataFrame:
    """Adds ``anomaly_score`` (higher = more isolated) and ``anomaly`` (-1 outlier / 1 inlier).

    ``features``: numeric columns, or the name of one array column, whose vectors must have one length.
    """
    vector = F.col(features).cast("array<double>") if isinstance(features, str) else F.array(*[F.col(f).cast("double") for f in features])
    d = df.withColumn("_x", vector)
    sizes = d.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("_x")).alias("a"), F.max(F.size("_x")).alias("b")).first()
    if sizes["a"] != sizes["b"]:
        raise ValueError(f"vectors of {sizes['a']} to {sizes['b']} entries")
    n, nf = sizes["n"], sizes["a"] or 0
    m = min(max_samples, n)
    p = min(1.0, 2.0 * m / max(n, 1) + 20.0 / max(n, 1))

    def u(t):  # uniform in [0, 1] from all 64 bits of a hash of (seed, tree, row id)
        return F.xxhash64(F.lit(seed), t, F.col(id_col)).cast("double") / F.lit(2.0 ** 64) + F.lit(0.5)

    cand = d.select("_x", F.col(id_col), F.explode(F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)),
                                                          lambda t: u(t) < p)).alias("_tree"))
    cand = cand.withColumn("_u", u(F.col("_tree")))
    from pyspark.sql import Window
    keep = cand.withColumn("_r", F.row_number().over(Window.partitionBy("_tree").orderBy("_u", id_col))) \
        .where(F.col("_r") <= m).select("_tree", "_x")
    max_depth = int(math.ceil(math.log2(max(m, 2))))
    nodes = keep.groupBy("_tree").applyInPandas(lambda pdf: _grow(pdf, nf, max_depth, seed), NODE_SCHEMA)
    forest = nodes.toPandas().sort_values(["tree", "node"])   # bounded: n_trees x <= 2 * max_samples nodes
    trees = [g[["feature", "threshold", "left", "right", "leaf_path"]].to_numpy() for _, g in forest.groupby("tree")]
    cm = _c(m)

    def score(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            x = np.array(pdf["_x"].tolist(), dtype=float).reshape(len(pdf), nf) if len(pdf) else np.zeros((0, nf))
            depth_sum = np.zeros(len(pdf))
            for t in trees:
                node = np.zeros(len(pdf), dtype=int)
                for _ in range(max_depth + 1):
                    f = t[node, 0].astype(int)
                    inner = f >= 0
                    if not inner.any():
                        break
                    go_left = x[np.arange(len(pdf)), np.where(inner, f, 0)] < t[node, 1]
                    nxt = np.where(go_left, t[node, 2], t[node, 3]).astype(int)
                    node = np.where(inner, nxt, node)
                depth_sum += t[node, 4]
            out = pdf.drop(columns=["_x"])
            out["anomaly_score"] = np.power(2.0, -(depth_sum / len(trees)) / cm) if cm > 0 else 0.5
            yield out
    schema = d.drop("_x").schema.add("anomaly_score", "double")
    scored = d.mapInPandas(score, schema)
    scored = cut_lineage(scored)  # scored once, read by the quantile's rounds and the caller
    thr = exact_quantiles(scored, ["anomaly_score"], [1.0 - contamination]).first()[0]
    return scored.withColumn("anomaly", F.when(F.col("anomaly_score") > F.lit(thr), F.lit(-1)).otherwise(F.lit(1)))


def anomaly_summary(scored: DataFrame) -> DataFrame:
    """M12 summary: anomaly count and ratio."""
    return scored.agg(F.count_if(F.col("anomaly") == -1).alias("n_anomalies"),
                      (F.count_if(F.col("anomaly") == -1) / F.count(F.lit(1))).alias("anomaly_ratio"))
