"""Ordering and positional splits K1, K4, K5 without a one-partition sort.

Rows are range-partitioned by (time, keys) and sorted inside their partitions; a row's position is the number of rows in
earlier partitions plus its rank in its own. Ranges are cut by sampled values of time and keys together, so neither a hot
instant nor a fine-grained clock makes a large partition. The partitioned frame is checkpointed, which fixes the positions;
the table of partition sizes has one row for each partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.session import cut_lineage

POS = "_pos"


def sort_by_time(df: DataFrame, ts: str = "date", keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """K1: total order by time, ties broken by key (range-partitioned sort)."""
    return df.orderBy(F.col(ts), *[F.col(k) for k in keys])


def with_positions(df: DataFrame, ts: str = "date", keys: Sequence[str] = ("symbol",)) -> tuple[DataFrame, int]:
    """Global 0-based position in (ts, keys) order, plus the total row count."""
    order = [F.col(ts), *[F.col(k) for k in keys]]
    d = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # the id counts rows inside a partition in its lower 33 bits
    d = d.withColumns({"_pid": F.spark_partition_id(), "_rank": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)})
    d = cut_lineage(d)
    sizes = {r["_pid"]: r["n"] for r in d.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, total = [], 0
    for pid in sorted(sizes):
        offsets.append((pid, total))
        total += sizes[pid]
    small = df.sparkSession.createDataFrame(offsets, "_pid int, _off long")  # a row for each partition
    d = d.join(F.broadcast(small), "_pid")
    return d.withColumn(POS, F.col("_off") + F.col("_rank")).drop("_pid", "_off", "_rank"), total


def ordered_split(df: DataFrame, fractions: Sequence[float] = (0.8, 0.2),
                  names: Sequence[str] = ("train", "test"), ts: str = "date",
                  keys: Sequence[str] = ("symbol",), out: str = "split") -> DataFrame:
    """K4: ordered fraction split; boundary k = int(n * cumulative fraction)."""
    d, n = with_positions(df, ts, keys)
    bounds, acc = [], 0.0
    for f in fractions[:-1]:
        acc += f
        bounds.append(int(n * acc))
    lab = F.lit(names[-1])
    for b, name in reversed(list(zip(bounds, names))):
        lab = F.when(F.col(POS) < b, F.lit(name)).otherwise(lab)
    return d.withColumn(out, lab)


def tail_split(df: DataFrame, fraction: float = 0.2, **kw) -> DataFrame:
    """K4 variant: last ``fraction`` of rows is validation."""
    return ordered_split(df, (1.0 - fraction, fraction), ("train", "validation"), **kw)


def fold_bounds(n: int, n_splits: int = 5, test_size: int | None = None, gap: int = 0):
    """K5 bounds: test blocks end at n; train = [0, start - gap)."""
    size = test_size or n // (n_splits + 1)
    starts = [n - (n_splits - i) * size for i in range(n_splits)]
    return [(i, 0, max(0, s - gap), s, s + size) for i, s in enumerate(starts)]


def expanding_folds(df: DataFrame, n_splits: int = 5, test_size: int | None = None, gap: int = 0,
                    ts: str = "date", keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """K5: one row per (row, fold) membership with role train / test.

    Fold bounds are computed on the driver from the row count; membership is a
    generator expression per row (explode), no join.
    """
    d, n = with_positions(df, ts, keys)
    folds = fold_bounds(n, n_splits, test_size, gap)
    pos = F.col(POS)
    members = F.array(*[
        F.when(pos < tr_end, F.struct(F.lit(i).alias("fold"), F.lit("train").alias("role")))
        .when((pos >= te_start) & (pos < te_end), F.struct(F.lit(i).alias("fold"), F.lit("test").alias("role")))
        for i, _, tr_end, te_start, te_end in folds])
    return (d.withColumn("_m", F.explode(F.filter(members, lambda m: m.isNotNull())))
            .select("*", "_m.fold", "_m.role").drop("_m"))


def contiguous_folds(df: DataFrame, k: int = 5, ts: str = "date", keys: Sequence[str] = ("symbol",),
                     out: str = "fold") -> DataFrame:
    """Unshuffled k-fold ids (sklearn KFold): first n % k folds get one extra row."""
    d, n = with_positions(df, ts, keys)
    base, extra = divmod(n, k)
    big = extra * (base + 1)
    pos = F.col(POS)
    fold = F.when(pos < big, F.floor(pos / (base + 1))).otherwise(
        F.lit(extra) + F.floor((pos - big) / max(base, 1)))
    return d.withColumn(out, fold.cast("int"))


def positions_within(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], out: str) -> DataFrame:
    """``df`` (checkpointed) plus each row's 0-based place in its group (``by``, no nulls) in the order of ``order``.

    Rows are dealt by ranges of group and order together, so a group that holds most rows is spread over tasks; what is
    summed per group is a row for each range.
    """
    cols = [*[F.col(c) for c in by], *[F.col(c) if isinstance(c, str) else c for c in order]]
    d = df.repartitionByRange(*cols).sortWithinPartitions(*cols)
    d = cut_lineage(d.withColumns({"_pid": F.spark_partition_id(), "_rank": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}))
    ahead = Window.partitionBy(*by).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = d.groupBy("_pid", *by).agg(F.min("_rank").alias("_lo"), F.count(F.lit(1)).alias("_n"))
    parts = parts.select("_pid", *by, "_lo", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    return d.join(parts, ["_pid", *by]).withColumn(out, F.col("_before") + F.col("_rank") - F.col("_lo")) \
        .drop("_pid", "_rank", "_lo", "_before")


def stratified_folds(df: DataFrame, label: str, k: int = 5, ts: str = "date", keys: Sequence[str] = ("symbol",),
                     out: str = "fold") -> DataFrame:
    """Unshuffled stratified k-fold ids (sklearn StratifiedKFold): classes keep their shares in every fold.

    Classes count in order of their first row. If all rows stood sorted by class, row i would be dealt to fold i mod k; that
    gives how many rows of a class each fold has, and a class fills its folds in row order. Rows without a label have no fold.
    """
    known = df.where(F.col(label).isNotNull())
    d = positions_within(known, [label], [ts, *keys], "_place")
    first = d.groupBy(label).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(ts, *keys)).alias("_first"))
    start = Window.orderBy("_first", label).rowsBetween(Window.unboundedPreceding, -1)  # a row for each class
    first = first.select(label, "_n", F.coalesce(F.sum("_n").over(start), F.lit(0)).alias("_start"))

    def dealt(i: int) -> Column:
        """Rows of the class in fold i: the numbers from _start to _start + _n - 1 that leave i when divided by k."""
        return F.floor((F.col("_start") + F.col("_n") - 1 - i) / k) - F.floor((F.col("_start") - 1 - i) / k)
    total, fold = F.lit(0), F.lit(0)
    for i in range(k - 1):
        total = total + dealt(i)
        fold = fold + (F.col("_place") >= total).cast("int")
    return d.join(F.broadcast(first), label).withColumn(out, fold.cast("int")).drop("_place", "_n", "_start")
