"""Operator 13: mixing sources to target weights by systematic sampling.

Each source has a target in words: its weight's share of the whole mix, at most a multiple of what the source holds (the
excess goes to the others by weight). Within a source, documents stand in a line, longest first, and each has the same
expected number of copies, target / size. The line's prefix sums of expected copies start at one random offset, and a
document is emitted once for each integer that its stretch crosses: every document has the expected number of copies
rounded up or down, and, as neighbours in the line are of like size, the words taken differ from the target by less than
the longest document.

The line of a source is never in one task: prefix sums are taken by ranges and joined by the sums of the ranges before. The
water level of the targets is found the same way, over a row for each source.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import WORD_BREAK, fresh, running, text_of, written

#: Weights of the sources in order (repeating), share of all words that the mix holds, greatest number of copies, seed of the offset.
WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), (3, 2), 2, 20240817
_WORD = "[^" + WORD_BREAK[1:]


def offset(seed: int = SEED) -> float:
    """The random start of every line, in [0, 1)."""
    return float(np.random.default_rng(seed).random())


def _targets(sources: DataFrame, weights: tuple[int, ...], share: tuple[int, int], most: int) -> DataFrame:
    """none, src, source_size, target: sources (none, src, source_size) by code point, null last."""
    ranked = running(sources.withColumn("one", F.lit(1)), [], [F.col("none"), F.col("src")], {"rank": "one"}, "sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1).cast("long")
    t = ranked.select("none", "src", "source_size", weight.alias("w"), (F.col("source_size") * most).alias("cap"))
    # filled in the order in which sources reach their cap as the level rises: room for each unit of weight
    t = running(t.withColumn("room", F.col("cap") / F.col("w")), [], [F.col("room"), F.col("none"), F.col("src")], {"full": "cap", "used": "w"}, "levels")
    total = t.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0))).first()
    # the level if the sources before are full: what is left of the mix for each unit of the weights left
    level = (F.lit(share[0] * total[0]) - share[1] * F.col("full")).cast("double") / (share[1] * (F.lit(total[1]) - F.col("used"))).cast("double")
    first = t.withColumn("level", level).filter("level <= room").agg(F.min(F.struct("room", "none", "src", "level"))).first()[0]
    target = F.least(F.col("cap").cast("double"), F.lit(float(first.level) if first else 0.0) * F.col("w"))
    return t.select("none", "src", "source_size", target.alias("target"))


def _sized(df: DataFrame, id_col: str, source: str, text: str) -> DataFrame:
    """id, none, src, size, h: a row for each row; h tells apart what an id repeats."""
    t = text_of(df[text])
    return df.select(F.col(id_col).alias("id"), F.col(source).isNull().alias("none"), F.coalesce(F.col(source), F.lit("")).alias("src"),
                     F.regexp_count(t, F.lit(_WORD)).cast("long").alias("size"), F.xxhash64(t).alias("h"))


def _copies(df: DataFrame, id_col: str, source: str, text: str, weights, share, most: int, seed: int) -> DataFrame:
    rows = written(_sized(df, id_col, source, text).withColumn("row", F.monotonically_increasing_id()), "sized")
    targets = _targets(rows.groupBy("none", "src").agg(F.sum("size").cast("long").alias("source_size")), weights, share, most)
    line = running(rows.withColumn("one", F.lit(1)), ["none", "src"],
                   [F.col("size").desc(), F.col("id").asc_nulls_last(), F.col("h"), F.col("row")], {"place": "one"}, "lines")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(F.lit(0.0))

    def crossed(place: Column) -> Column:
        return F.floor(place.cast("double") * each + F.lit(offset(seed)))

    copies = F.least(crossed(F.col("place") + 1) - crossed(F.col("place")), F.lit(most)).cast("long")
    return line.join(targets, ["none", "src"]).withColumn("copies", copies)


def mixture(df: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[int, ...] = WEIGHTS,
            share: tuple[int, int] = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken: a row for each input row; taken is copies * size.

    Null text is empty and has size 0; a null source is a source, the last one; null ids stand last in their size. Repeated
    rows are rows of their own. A mix of nothing (no rows, or no words) takes nothing. Other columns are ignored. Reruns agree:
    rows that differ in nothing but their place in the table may swap copies among themselves.
    """
    c = _copies(df, id_col, source, text, weights, share, most, seed)
    return c.select(F.col("id").alias("doc_id"), F.when(~F.col("none"), F.col("src")).alias("source"), "size", "source_size", "target",
                    "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(df: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text", weights: tuple[int, ...] = WEIGHTS,
        share: tuple[int, int] = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """The rows of ``df`` as the mix holds them, with all their columns: each once for each of its copies.

    Rows that repeat id, source and text are emitted from one of them, as often as all of them together.
    """
    c = _copies(df, id_col, source, text, weights, share, most, seed)
    names = fresh(df, "id", "none", "src", "size", "h", "n", "rows")
    i, none, src, size, h, n, rows = names
    want = c.groupBy("id", "none", "src", "size", "h").agg(F.sum("copies").alias(n), F.count("*").alias(rows)).filter(F.col(n) > 0)
    want = want.select(*[F.col(a).alias(f"want_{b}") for a, b in zip(("id", "none", "src", "size", "h"), names)], n, rows)
    t = text_of(df[text])
    mine = df.withColumns({i: F.col(id_col), none: F.col(source).isNull(), src: F.coalesce(F.col(source), F.lit("")), h: F.xxhash64(t)})
    got = mine.join(want, F.col(i).eqNullSafe(F.col(f"want_{i}")) & (F.col(none) == F.col(f"want_{none}")) & (F.col(src) == F.col(f"want_{src}"))
                    & (F.col(h) == F.col(f"want_{h}")))
    once = got.filter(F.col(rows) == 1)
    again = got.filter(F.col(rows) > 1).dropDuplicates([i, none, src, h])
    out = once.unionByName(again)
    return out.withColumn(n, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n)))).select(*[F.col(f"`{x}`") for x in df.columns])


#: DuckDB SQL for the digest over the table documents.
MIX_SQL = rf"""
WITH d AS (SELECT doc_id, source, source IS NULL AS none, coalesce(source, '') AS src,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT none, src, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY none, src) - 1 AS rank FROM d GROUP BY none, src),
w AS (SELECT *, CASE rank % 3 WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END AS w, {MOST} * source_size AS cap FROM s),
r AS (SELECT *, CAST(cap AS DOUBLE) / w AS room FROM w),
f AS (SELECT *, coalesce(sum(cap) OVER before, 0) AS full_caps, coalesce(sum(w) OVER before, 0) AS used,
    sum(source_size) OVER () AS all_size, sum(w) OVER () AS all_w FROM r
  WINDOW before AS (ORDER BY room, none, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, CAST({SHARE[0]} * all_size - {SHARE[1]} * full_caps AS DOUBLE) / CAST({SHARE[1]} * (all_w - used) AS DOUBLE) AS level FROM f),
k AS (SELECT level AS water FROM l WHERE level <= room ORDER BY room, none, src LIMIT 1),
t AS (SELECT none, src, source_size, least(CAST(cap AS DOUBLE), coalesce((SELECT water FROM k), 0) * w) AS target FROM l),
p AS (SELECT d.*, row_number() OVER (PARTITION BY none, src ORDER BY size DESC, doc_id NULLS LAST) - 1 AS place FROM d),
e AS (SELECT p.doc_id, p.size, t.source_size, t.target, p.place,
    CASE WHEN t.source_size > 0 THEN t.target / CAST(t.source_size AS DOUBLE) ELSE 0 END AS each FROM p JOIN t ON p.none = t.none AND p.src = t.src)
SELECT doc_id, size, source_size, target,
  CAST(size * least(floor((place + 1) * each + {offset()!r}) - floor(place * each + {offset()!r}), {MOST}) AS BIGINT) AS taken FROM e
"""
