"""Operator 9 [native]: exact dedup by 128-bit content hash with a comparison of the bytes.

Three passes of built-in functions only. (1) md5 of every text, counted per
hash: a hash met once is a text met once. The hashes that repeat are written,
8 bytes each. (2) Only texts whose hash repeats move: where the list is within
a million keys it is broadcast and texts are filtered where they lie, beyond
that texts meet it by a shuffle. Grouping by (hash, text) compares bytes, so
two texts with one hash become two groups; counts and the staying id are
combined map-side, so a group that holds a third of all rows shuffles one row
for each task. (3) Rows look up their group by hash, and by SHA-256 as well, so
a collision of md5 falls to the right group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import few, fresh, text_of, written


def _hashes(text) -> tuple:
    """md5 (16 bytes) and SHA-256 of a text; declared not null, so both uses of a join on them share one shuffle."""
    data = text.cast("binary")
    return F.coalesce(F.unhex(F.md5(data)), F.lit(b"")), F.coalesce(F.sha2(data, 256), F.lit(""))


def _keyed(df: DataFrame, id_col: str, text: str) -> DataFrame:
    t = df.select(F.col(id_col).alias("id"), text_of(text).alias("t"))
    return t.withColumn("h", F.unhex(F.md5(F.col("t").cast("binary"))))


def _repeated(keyed: DataFrame, k: str = "k") -> DataFrame:
    """The 64-bit keys of hashes that more than one row has, one row a key."""
    repeated = keyed.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1")
    return written(repeated.select(F.xxhash64("h").alias(k)).distinct(), "repeated")


def _groups(keyed: DataFrame) -> DataFrame:
    """(h, sha, keep_id, group_size) of texts that occur more than once; keyed: id, t, h of rows whose hash may repeat."""
    by_text = keyed.groupBy("h", "t").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    return by_text.filter("group_size > 1").select(
        "h", F.sha2(F.col("t").cast("binary"), 256).alias("sha"), "keep_id", "group_size")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each input row: doc_id, keep_id, group_size, kept, text_sha256.

    Null text equals the empty text. Of equal texts the largest id stays; null ids stay only in
    a group that has no other (keep_id is then null). Rows that repeat both id and text all carry
    that id, so each says kept; ``exact_dedup`` leaves one of them. Other columns are ignored.
    """
    t = _keyed(df, id_col, text)
    keys = _repeated(t)
    texts = t.join(few(keys) or keys, F.xxhash64("h") == F.col("k"), "left_semi")
    rows = t.select("id", "h", F.sha2(F.col("t").cast("binary"), 256).alias("sha"))
    out = rows.join(_groups(texts), ["h", "sha"], "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("id")).otherwise(F.col("keep_id"))
    return out.select(F.col("id").alias("doc_id"), keep.alias("keep_id"),
                      F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                      F.col("id").eqNullSafe(keep).alias("kept"), F.col("sha").alias("text_sha256"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns: for equal texts the row with the largest id.

    Rows that repeat id and text leave one: such rows alone are reduced by id and hash. Texts met once never move while
    the hashes that repeat are few enough for a broadcast; beyond that every row meets its group by a shuffle.
    """
    h, sha, keep, size, n, k = fresh(df, "h", "sha", "keep_id", "group_size", "n", "k")
    keys = _repeated(_keyed(df, id_col, text), k)
    listed = few(keys)
    if listed is None:
        return _stay(df, keys, id_col, text, h, sha, keep, size, n, k)
    meets = F.xxhash64(_hashes(text_of(df[text]))[0]) == F.col(k)
    some = written(df.join(listed, meets, "left_semi"), "copies")
    return df.join(listed, meets, "left_anti").unionByName(_stay(some, None, id_col, text, h, sha, keep, size, n, k))


def _stay(df: DataFrame, keys: DataFrame | None, id_col: str, text: str, h: str, sha: str, keep: str, size: str, n: str, k: str) -> DataFrame:
    """The rows that stay; ``keys`` None: the hash of every row may repeat."""
    t = _keyed(df, id_col, text)
    if keys is not None:
        t = t.join(keys, F.xxhash64("h") == F.col(k), "left_semi")
    groups = _groups(t)
    twice = t.groupBy("id", "h").agg(F.count("*").alias("n")).filter("n > 1").select(
        F.col("id").alias(keep), F.col("h").alias(h), F.col("n").alias(n))
    g = groups.select(F.col("h").alias(h), F.col("sha").alias(sha), F.col("keep_id").alias(keep),
                      F.col("group_size").alias(size)).join(
        twice.withColumnRenamed(keep, "k2").withColumnRenamed(h, "h2"),
        (F.col(h) == F.col("h2")) & F.col(keep).eqNullSafe(F.col("k2")), "left").drop("k2", "h2")
    mine = _hashes(text_of(df[text]))
    kept = df.withColumns({h: mine[0], sha: mine[1]}).join(g, [h, sha], "left")
    kept = kept.filter(F.col(size).isNull() | F.col(id_col).eqNullSafe(F.col(keep)))
    once = kept.filter(F.col(n).isNull()).select(*[F.col(f"`{c}`") for c in df.columns])
    again = kept.filter(F.col(n).isNotNull()).dropDuplicates([id_col, h, sha]).select(*[F.col(f"`{c}`") for c in df.columns])
    return once.unionByName(again)


#: DuckDB SQL for exact_groups over the table documents.
GROUPS_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size,
       d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
