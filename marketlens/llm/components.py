"""Connected components of an edge table by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import discard, written


def _with_least(edges: DataFrame) -> DataFrame:
    """edges (u, v) plus m: the least of u and all its neighbours; combined map-side, so a hub costs one row a task."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    e = _with_least(both).filter("v > u")
    return e.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")  # repeats go after the small star


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    e = _with_least(down)
    out = e.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(e.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, class) for every node of an edge; class is the least node of its component.

    edges: two long columns u, v; loops and repeats are allowed. Each round is written to the shared folder; only a
    count and a checksum come to the driver. Stops when a round changes nothing (a logarithmic number of rounds).
    """
    edges = written(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    state = _state(edges)
    while state[0]:
        before, edges = edges, written(_small_star(_large_star(edges)), "stars")
        last, state = state, _state(edges)
        discard(before)
        if state == last:
            break
    inner = edges.select(F.col("u").alias("node"), F.col("v").alias("class"))
    return inner.unionByName(inner.select(F.col("class").alias("node"), "class").distinct())
