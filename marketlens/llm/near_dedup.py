"""Operator 10: near duplicates by BagMinHash, banding and verified multiset overlap.

1. One Arrow pass signs every whole text (130 registers, 26 bands of 5). Equal texts share one node: the least id.
2. Band keys met by two or more nodes make buckets. A node's centrality is the sum of its bucket sizes (the original
   of a group of edited copies shares more bands than any copy does), and each bucket's most central node is its
   pivot. Every node is verified against the pivot that its signature agrees with best: one row for each node, so a
   bucket of n nodes costs n comparisons, and links are joined to classes.
3. Nodes that are still in another class than most of a bucket are its outliers, and an outlier may have a link to
   any member. Outliers are compared with all members, exactly, in cells of bounded size: (group, block of
   outliers, block of members). Only links leave a cell. No bucket is capped and no pair of a bucket is skipped
   unless both are in one class already.

Links are exact: weighted Jaccard of the multisets of 5-word shingles >= 0.8. Banding finds a pair of similarity 0.8
with probability 1 - (1 - 0.8^5)^26 > 0.9999; signatures only order the candidates of step 2.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from marketlens.llm.bagminhash import band_keys, shingle_sets, signatures
from marketlens.llm.common import batch_bytes, few, fresh, lean, ship, text_of, written
from marketlens.llm.components import components
from marketlens.llm.hashing import buffers, slices

THRESHOLD = 0.8
#: Outliers and members of a cell of step 3, and bytes of text of either.
CELL_OUTLIERS, CELL_MEMBERS, CELL_BYTES = 256, 1024, 8 << 20


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for texts in slices(batch.column(1)):
            n = len(texts)
            raw, offsets = buffers(texts)
            h, w, first = shingle_sets(raw, offsets)
            sig = signatures(h, w, first)
            some = np.diff(first) > 0
            keys = band_keys(sig).view(np.int64)
            width = keys.shape[1]
            data = memoryview(raw)
            md5 = [hashlib.md5(data[a:b]).digest() for a, b in zip(offsets[:-1], offsets[1:])]
            # documents without words have no bands: they are near nothing
            bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some * width)]), pa.int32()),
                                             pa.array(keys[some].reshape(-1), pa.int64()))
            short = [s.tobytes() for s in (sig & np.uint64(0xFFFF)).astype("<u2")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, n), pa.array(md5, pa.binary()), bands, pa.array(short, pa.binary())],
                names=["id", "h", "bands", "sig"])
            at += n


def sign(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, md5 of the text, band keys and 16-bit registers of every row with an id."""
    ship(df.sparkSession)
    t = df.select(F.col(id_col).cast("long").alias("id"), text_of(text).alias("text")).filter("id IS NOT NULL")
    return t.mapInArrow(lean(_sign), "id long, h binary, bands array<long>, sig binary")


@F.pandas_udf(DoubleType())
def _agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([float(np.mean(np.frombuffer(x, "<u2") == np.frombuffer(y, "<u2"))) for x, y in zip(a, b)], dtype=float)


def _verify(threshold: float):
    """Rows (u, v, text, text2) whose multisets of shingles overlap by ``threshold``, as (u, v)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = (np.asarray(batch.column(i)) for i in (0, 1))
            near, at = np.zeros(len(u), bool), 0
            for texts in slices(batch.column(2)):
                n = len(texts)
                pivot = v[at:at + n]
                new = np.concatenate([[True], pivot[1:] != pivot[:-1]])  # rows of one pivot come together
                h, w, first = shingle_sets(*buffers(texts))
                h2, w2, first2 = shingle_sets(*buffers(batch.column(3).slice(at, n).take(pa.array(np.flatnonzero(new)))))
                for i, j in enumerate((np.cumsum(new) - 1).tolist()):
                    near[at + i] = _similar(h, w, first[i], first[i + 1], h2, w2, first2[j], first2[j + 1]) >= threshold
                at += n
            yield pa.RecordBatch.from_arrays([pa.array(u[near], pa.int64()), pa.array(v[near], pa.int64())], names=["u", "v"])

    return run


def _similar(h: np.ndarray, w: np.ndarray, a: int, b: int, h2: np.ndarray, w2: np.ndarray, a2: int, b2: int) -> float:
    """Weighted Jaccard similarity of entries a to b and a2 to b2 of two lists of sorted shingles with their counts."""
    if a == b or a2 == b2:
        return 0.0
    at = np.minimum(np.searchsorted(h2[a2:b2], h[a:b]), b2 - a2 - 1) + a2
    common = int(np.minimum(w[a:b], w2[at])[h2[at] == h[a:b]].sum())
    return common / (int(w[a:b].sum()) + int(w2[a2:b2].sum()) - common)


def _multiset(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    h, w, _ = shingle_sets(raw, np.array([0, len(raw)]))
    return np.repeat(h, w)


def _cell(threshold: float):
    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        outliers, members = pdf[pdf.side == 0], pdf[pdf.side == 1]
        sets = [_multiset(t) for t in members.text]
        ids, labels = members.node.to_numpy(), members.label.to_numpy()
        sizes = np.array([len(s) for s in sets], np.int64)
        # distinct shingles of all members, the members that hold them, and how often
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), sizes)
        order = np.lexsort((owner, flat))
        flat, owner = flat[order], owner[order]
        new = np.ones(len(flat), bool)
        new[1:] = (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        flat, owner, times = flat[at], owner[at], np.diff(at, append=len(new))
        got = []
        for node, label, text in zip(outliers.node, outliers.label, outliers.text):
            mine, n = np.unique(_multiset(text), return_counts=True)
            lo, hi = np.searchsorted(flat, mine, "left"), np.searchsorted(flat, mine, "right")
            span = hi - lo
            at = np.arange(int(span.sum())) + np.repeat(lo - np.cumsum(span) + span, span)
            common = np.bincount(owner[at], np.minimum(times[at], np.repeat(n, span)), len(sets))
            total = int(n.sum()) + sizes - common
            near = (common >= threshold * total) & (labels != label) & (total > 0)
            got += [(int(node), int(v)) for v in ids[near]]
        return pd.DataFrame(got, columns=["u", "v"]).astype("int64")

    return compare


def _pivots(members: DataFrame) -> DataFrame:
    """(key, pivot): the most central node of each bucket; ties go to the least id."""
    central = members.groupBy("node").agg(F.sum("size").alias("score"))
    best = members.join(central, "node").groupBy("key").agg(F.max(F.struct("score", -F.col("node"))).alias("b"))
    return best.select("key", (-F.col("b.col2")).alias("pivot"), F.col("b.score").alias("score"))


def _links_to_pivots(members: DataFrame, pivots: DataFrame, sigs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(u, v): each node and the pivot it agrees with best, where the overlap holds."""
    pairs = members.join(pivots, "key").filter("node <> pivot").select("node", "pivot").distinct()
    s = sigs.select("node", "sig")
    pairs = pairs.join(s, "node").join(s.select(F.col("node").alias("pivot"), F.col("sig").alias("sig2")), "pivot")
    pairs = pairs.select("node", "pivot", _agreement("sig", "sig2").alias("est"))
    best = pairs.groupBy("node").agg(F.max(F.struct("est", -F.col("pivot"))).alias("b"))
    best = best.select("node", (-F.col("b.col2")).alias("pivot"))
    texts = texts.select("node", "text")
    two = best.join(texts, "node").join(texts.select(F.col("node").alias("pivot"), F.col("text").alias("text2")), "pivot")
    return two.select("node", "pivot", "text", "text2").mapInArrow(lean(_verify(threshold)), "u long, v long")


def _links_of_outliers(members: DataFrame, pivots: DataFrame, classes: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(u, v): links between classes that share a bucket, outliers against all members in cells."""
    m = members.join(classes, "node", "left").select("key", "node", F.coalesce("class", "node").alias("label"))
    m = written(m, "labelled")
    by_label = m.groupBy("key", "label").agg(F.count("*").alias("n"))
    most = by_label.groupBy("key").agg(F.max(F.struct("n", "label")).alias("b"), F.count("*").alias("labels"))
    mixed = most.filter("labels > 1").select("key", F.col("b.label").alias("main"))
    m = written(m.join(mixed, "key").join(pivots, "key"), "mixed")
    # an outlier's group: the most central pivot of its buckets; the group's members: all that share a bucket with one
    out = m.filter("label <> main")
    group = out.groupBy("node", "label").agg(F.max(F.struct("score", "pivot")).alias("b")) \
        .select("node", "label", F.col("b.pivot").alias("grp"))
    group = written(group, "outliers")
    keys = out.select("node", "key").join(group.select("node", "grp"), "node").select("grp", "key").distinct()
    others = keys.join(m.select("key", "node", "label"), "key").select("grp", "node", "label").distinct()
    others = written(others, "others")
    sizes = texts.select("node", "bytes")

    def block(rows: DataFrame, most: int, name: str) -> DataFrame:
        need = F.greatest(F.ceil(F.count("*") / most), F.ceil(F.sum("bytes") / CELL_BYTES))
        return rows.join(sizes, "node").groupBy("grp").agg(need.alias(name))

    blocks = block(group, CELL_OUTLIERS, "ub").join(block(others, CELL_MEMBERS, "vb"), "grp")

    def cells(side: int, rows: DataFrame) -> DataFrame:
        own, other = ("ub", "vb") if side == 0 else ("vb", "ub")
        at = rows.join(blocks, "grp").withColumn("own", F.pmod(F.xxhash64("node"), F.col(own)))
        at = at.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))
        u, v = ("own", "other") if side == 0 else ("other", "own")
        return at.select("grp", F.col(u).alias("u"), F.col(v).alias("v"), F.lit(side).alias("side"), "node", "label")

    rows = cells(0, group).unionByName(cells(1, others)).join(texts.select("node", "text"), "node")
    return rows.groupBy("grp", "u", "v").applyInPandas(_cell(threshold), "u long, v long")


def _between(links: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (u, v) of nodes as links of their classes; a node without a class is its own."""
    for side in ("u", "v"):
        c = classes.select(F.col("node").alias(side), F.col("class").alias("c"))
        links = links.join(c, side, "left").withColumn(side, F.coalesce("c", side)).drop("c")
    return links


def near_classes(df: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each input row: doc_id, class_id, class_size.

    class_id is the least doc_id of the class: texts joined by links (weighted Jaccard of 5-word shingles >= threshold,
    words unchanged) and equal texts. A text of 1 to 4 words has one shingle of all its words; texts without words
    (and null ones, which count as empty) are near nothing, but equal ones are one class. Rows with one id are one document; rows
    without an id get null for both. class_size counts rows. Other columns are ignored; an empty table gives none.
    """
    with batch_bytes(df.sparkSession):
        return _classes(df, id_col, text, threshold)


def _classes(df: DataFrame, id_col: str, text: str, threshold: float) -> DataFrame:
    signed = written(sign(df, id_col, text), "signed")
    least = signed.groupBy("h").agg(F.min("id").alias("node"))
    who = written(signed.select("id", "h").join(least, "h").select("id", "node"), "nodes")
    reps = signed.join(least.select("h", "node"), "h").filter("id = node").select("node", "bands", "sig")
    banded = reps.select("node", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b"), F.count("*").alias("size")).filter("a < b")
    members = written(banded.join(shared.select("key", "size"), "key").select("key", "node", "size").distinct(), "buckets")
    nodes = written(members.select("node").distinct(), "members")
    nodes = few(nodes) or nodes  # texts that are near nothing do not move
    texts = df.select(F.col(id_col).cast("long").alias("node"), text_of(text).alias("text")) \
        .join(nodes, "node", "left_semi").dropDuplicates(["node"])
    texts = written(texts.withColumn("bytes", F.octet_length("text").cast("long")), "texts")
    sigs = written(reps.select("node", "sig").join(nodes, "node", "left_semi").dropDuplicates(["node"]), "sigs")
    pivots = written(_pivots(members), "pivots")
    links = written(_links_to_pivots(members, pivots, sigs, texts, threshold), "links")
    classes = written(components(links), "classes")
    more = _links_of_outliers(members, pivots, classes, texts, threshold)
    # an id met with several texts is one document: its nodes belong together
    same = who.filter("id <> node").select(F.col("id").alias("u"), F.col("node").alias("v"))
    own = who.filter("id = node").select(F.col("id").alias("u")).distinct()
    # what is left to join are classes, far fewer than nodes
    joined = components(_between(more.unionByName(same.join(own, "u", "left_semi")), classes))
    joined = joined.select(F.col("node").alias("class"), F.col("class").alias("last"))
    by_node = classes.join(joined, "class", "left").select("node", F.coalesce("last", "class").alias("class"))
    alone = joined.join(classes.select(F.col("class")).distinct(), "class", "left_anti")
    by_node = by_node.unionByName(alone.select(F.col("class").alias("node"), F.col("last").alias("class")))
    by_id = who.join(by_node, "node", "left").groupBy("id").agg(F.min(F.coalesce("class", "node")).alias("class_id"))
    ids = df.select(F.col(id_col).cast("long").alias("doc_id"))
    rows = ids.join(by_id.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    sizes = rows.groupBy("class_id").agg(F.count("*").alias("class_size"))
    return rows.join(sizes, "class_id", "left").select("doc_id", "class_id", "class_size")


def near_dedup(df: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``df`` that stay, with all columns: of each class the least id; rows without an id stay.

    Rows that repeat the staying id with the same text stay together (exact dedup goes first).
    """
    key, = fresh(df, "stays")
    stays = near_classes(df, id_col, text, threshold).filter("doc_id <> class_id").select(F.col("doc_id").alias(key)).distinct()
    return df.join(stays, df[id_col].cast("long") == F.col(key), "left_anti")
