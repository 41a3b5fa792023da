"""Exact quantiles without a task that holds a group's values.

A quantile is a rank. Each round one aggregate with small state counts, for every group, column and probability,
the values below and inside a bracket around the rank and sketches the inside; the sketch's cells around the rank are the next bracket.
When brackets hold few values, only these are grouped by value and counted up to the rank. The number of rounds
grows with the logarithm of the rows; results are exact whatever the sketch says, because ranks are counted. Where a
sketch does not narrow its bracket, values drawn from the bracket by a hash are the next cuts, which narrows any bracket of many different values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells of a round's sketch, and values that a bracket may hold in the end.
CELLS, FEW = 50, 100_000
#: Values drawn from a bracket where the sketch fails.
PIVOTS = 8


def _inside(x: Column, lo: Column, hi: Column) -> Column:
    return (x >= lo) & (x <= hi)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], keys: Sequence[str] = (),
                    few: int = FEW) -> DataFrame:
    """keys, then ``q_{column}_{i}`` for each column and each probability: linear interpolation, as pandas ``quantile``.

    NULL and NaN are left out; a group without a value has NULL quantiles; without keys there is one row. One row per group
    is joined to the rows in each round.
    """
    keys, cols, probs = list(keys), list(cols), list(probs)
    at = [(i, j) for i in range(len(cols)) for j in range(len(probs))]
    d = df.select(*keys, *[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"x{i}") for i, c in enumerate(cols)])
    state = d.groupBy(*keys).agg(*[e for i in range(len(cols)) for e in (
        F.count(f"x{i}").alias(f"n{i}"), F.min(f"x{i}").alias(f"a{i}"), F.max(f"x{i}").alias(f"b{i}"))])
    state = state.select(*keys, *[f"n{i}" for i in range(len(cols))], *[e for i, j in at for e in (
        F.col(f"a{i}").alias(f"lo{i}_{j}"), F.col(f"b{i}").alias(f"hi{i}_{j}"), F.lit(0).cast("long").alias(f"below{i}_{j}"),
        F.col(f"n{i}").alias(f"in{i}_{j}"))])
    state, most = _fixed(state, at)
    rank = {(i, j): F.col(f"n{i}") * probs[j] - probs[j] for i, j in at}
    turn = 0
    while most > few:
        narrow, now = _fixed(_counted(d, state, _sketched(d, state, keys, at, rank), keys, at, rank), at)
        if now > most // 2:  # the sketch was of little use
            turn += 1
            narrow, now = _fixed(_counted(d, narrow, _drawn(d, narrow, keys, at, rank, turn), keys, at, rank), at)
        state = narrow
        if now >= most:  # the values left are few, whatever the rows: the rest is counted by value
            break
        most = now
    j_rows = _joined(d, state, keys)
    hits = F.array_compact(F.array(*[F.when(_inside(F.col(f"x{i}"), F.col(f"lo{i}_{j}"), F.col(f"hi{i}_{j}")),
                                            F.struct(F.lit(f"{i}_{j}").alias("q"), F.col(f"x{i}").alias("x"))) for i, j in at]))
    values = j_rows.select(*keys, F.explode(hits).alias("h")).groupBy(*keys, "h.q", "h.x").agg(F.count("*").alias("c"))
    flat = state.select(*keys, F.explode(F.array(*[F.struct(F.lit(f"{i}_{j}").alias("q"), rank[i, j].alias("rank"),
                                                             F.col(f"below{i}_{j}").alias("below")) for i, j in at])).alias("s"))
    ranks = flat.select(*keys, "s.q", "s.rank", "s.below")
    upto = F.sum("c").over(Window.partitionBy(*keys, "q").orderBy("x").rowsBetween(Window.unboundedPreceding, 0))
    v = values.join(ranks, [*keys, "q"]).withColumn("end", F.col("below") + upto)
    # the value at a rank is the first one whose running count passes it
    low, high = F.floor("rank"), F.ceil("rank")
    picked = v.groupBy(*keys, "q", "rank").agg(F.min(F.when(F.col("end") > low, F.col("x"))).alias("a"),
                                                F.min(F.when(F.col("end") > high, F.col("x"))).alias("b"))
    value = F.col("a") + (F.col("rank") - F.floor("rank")) * (F.col("b") - F.col("a"))
    wide = picked.groupBy(*keys).pivot("q", [f"{i}_{j}" for i, j in at]).agg(F.first(value))
    names = [F.col(f"`{i}_{j}`").alias(f"q_{cols[i]}_{j}") for i, j in at]
    groups = state.select(*keys, F.lit(1).alias("_one"))
    if keys:
        return groups.drop("_one").join(wide.select(*keys, *names), keys, "left")
    return groups.join(wide.select(F.lit(1).alias("_one"), *names), "_one", "left").drop("_one")


def _sketched(d: DataFrame, state: DataFrame, keys, at, rank) -> DataFrame:
    """keys, then lo and hi of each bracket: the cells of a sketch of its values around the rank."""
    sketch = _joined(d, state, keys).groupBy(*keys).agg(*[F.percentile_approx(
        F.when(_inside(F.col(f"x{i}"), F.col(f"lo{i}_{j}"), F.col(f"hi{i}_{j}")), F.col(f"x{i}")), [k / CELLS for k in range(CELLS + 1)], 10_000)
        .alias(f"grid{i}_{j}") for i, j in at])
    cuts = {}
    for i, j in at:
        share = F.try_divide(rank[i, j] - F.col(f"below{i}_{j}"), F.col(f"in{i}_{j}"))
        cell = F.least(F.greatest(F.floor(share * CELLS), F.lit(0)), F.lit(CELLS)).cast("int")
        cuts[f"lo{i}_{j}"] = F.element_at(f"grid{i}_{j}", F.greatest(cell, F.lit(1)))
        cuts[f"hi{i}_{j}"] = F.element_at(f"grid{i}_{j}", F.least(cell + 3, F.lit(CELLS + 1)))
    return _joined(state, sketch, keys).select(*keys, *[c.alias(n) for n, c in cuts.items()])


def _drawn(d: DataFrame, state: DataFrame, keys, at, rank, turn: int) -> DataFrame:
    """keys, then lo and hi of each bracket: of ``PIVOTS`` of its values, drawn by hash, those around the rank (else the old bounds)."""
    draws, rows = [(i, j, t) for i, j in at for t in range(PIVOTS)], _joined(d, state, keys)
    inside = {(i, j): F.when(_inside(F.col(f"x{i}"), F.col(f"lo{i}_{j}"), F.col(f"hi{i}_{j}")), F.col(f"x{i}")) for i, j in at}
    pivots = rows.groupBy(*keys).agg(*[F.min_by(inside[i, j], F.when(inside[i, j].isNotNull(), F.xxhash64(F.lit(turn * PIVOTS + t), F.col(f"x{i}"))))
                                       .alias(f"p{i}_{j}_{t}") for i, j, t in draws])
    s = _joined(state, pivots, keys)
    counts = _joined(d, s, keys).groupBy(*keys).agg(*[e for i, j, t in draws for e in (
        F.count_if(F.col(f"x{i}") < F.col(f"p{i}_{j}_{t}")).alias(f"lt{i}_{j}_{t}"), F.count_if(F.col(f"x{i}") <= F.col(f"p{i}_{j}_{t}")).alias(f"le{i}_{j}_{t}"))])
    both, cuts = _joined(s, counts, keys), {}
    for i, j in at:
        low = [F.when(F.col(f"lt{i}_{j}_{t}") <= F.floor(rank[i, j]), F.col(f"p{i}_{j}_{t}")) for t in range(PIVOTS)]
        high = [F.when(F.col(f"le{i}_{j}_{t}") > F.ceil(rank[i, j]), F.col(f"p{i}_{j}_{t}")) for t in range(PIVOTS)]
        cuts[f"lo{i}_{j}"] = F.greatest(F.col(f"lo{i}_{j}"), *low)
        cuts[f"hi{i}_{j}"] = F.least(F.col(f"hi{i}_{j}"), *high)
    return both.select(*keys, *[c.alias(n) for n, c in cuts.items()])


def _counted(d: DataFrame, state: DataFrame, cuts: DataFrame, keys, at, rank) -> DataFrame:
    """The bracket table with the new bounds and their counts; a bracket that lost its rank keeps its old ones."""
    counts = _joined(d, cuts, keys).groupBy(*keys).agg(*[e for i, j in at for e in (
        F.count_if(F.col(f"x{i}") < F.col(f"lo{i}_{j}")).alias(f"below{i}_{j}"),
        F.count_if(_inside(F.col(f"x{i}"), F.col(f"lo{i}_{j}"), F.col(f"hi{i}_{j}"))).alias(f"in{i}_{j}"))])
    old = state.select(*keys, *[f"n{i}" for i in sorted({i for i, _ in at})], *[F.col(c).alias(f"old_{c}") for i, j in at for c in _names(i, j)])
    both = _joined(_joined(cuts, counts, keys), old, keys)
    for i, j in at:
        good = (F.col(f"below{i}_{j}") <= F.floor(rank[i, j])) & (F.col(f"below{i}_{j}") + F.col(f"in{i}_{j}") > F.ceil(rank[i, j]))
        both = both.withColumns({c: F.when(good, F.col(c)).otherwise(F.col(f"old_{c}")) for c in _names(i, j)})
    return both.select(state.columns)


def _names(i: int, j: int) -> list[str]:
    return [f"lo{i}_{j}", f"hi{i}_{j}", f"below{i}_{j}", f"in{i}_{j}"]


def _joined(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``a`` with their group's row of ``b``; without keys ``b`` is one row."""
    if keys:
        return a.join(b, list(keys))
    return a.withColumn("_one", F.lit(1)).join(F.broadcast(b.withColumn("_one", F.lit(1))), "_one").drop("_one")


def _fixed(state: DataFrame, at) -> tuple[DataFrame, int]:
    """The bracket table with its lineage cut, and the most values that a bracket still open holds."""
    from marketlens.session import cut_lineage
    state = cut_lineage(state)
    still = [F.max(F.when(F.col(f"lo{i}_{j}") < F.col(f"hi{i}_{j}"), F.col(f"in{i}_{j}"))) for i, j in at]
    row = state.agg(*[c.alias(f"m{k}") for k, c in enumerate(still)]).first()
    return state, max((x or 0 for x in row), default=0)
