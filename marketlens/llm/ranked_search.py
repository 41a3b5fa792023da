"""Operator 12: ranked lexical search by bag deduplication.

Documents are reduced to their bags: counts of the terms that any item has (``m`` depends on the document's length as well).
Documents of equal bag and m score alike for every item, so they are one class: classes are scored once, and only the classes
that reach an item's top ranks are expanded to their members, by ascending id.

How it runs, for each shard of items (cut by running bytes, so a shard's vocabulary and postings have a bounded size):

1. One Arrow pass splits whole texts and writes (id, number of terms, bag). Terms are found by hash and confirmed by their bytes.
2. Classes: rows are grouped by the bag's hash, m and the bag itself, which verifies that equal hashes are equal bags; counts
   and the least id combine map-side, so a class that holds a third of all rows shuffles one row a task. Document
   frequencies are sums over classes.
3. Classes stream past the shard's postings; each task keeps the best ``k`` classes of each item (by score, then least id: a
   document of a class beyond them has k documents before it).
4. Members of the best classes, at most k of each (the least ids, kept before the shuffle), are ranked for each item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import discard, running, ship, text_of, written
from marketlens.llm.hashing import buffers, slices, word_hashes, words

#: Documents of each item, bytes of a shard of items, and bytes that an item counts beside its text (so a shard holds at most 65,536).
TOP, SHARD_BYTES, ITEM_BYTES = 10, 4 << 20, 64
_ALNUM = np.array([i >= 128 or chr(i).isalnum() for i in range(256)])
#: A-Z in lower case; every ASCII character that is neither letter nor digit is a space.
_PLAIN = np.where(_ALNUM, np.arange(256), 32).astype(np.uint8)
_PLAIN[65:91] += 32
#: Postings that a run of classes is expanded to at once; sums that single floats hold exactly.
_EXPANDED, _EXACT = 1 << 22, 1 << 53


def split(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, first byte and one past the last of each term, first term of each text and one past the last)."""
    raw, offsets = buffers(column)
    raw = _PLAIN[raw]
    return raw, *words(raw, offsets)


def _spread(first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(run, position) of every position of runs that start at ``first``."""
    run = np.repeat(np.arange(len(first)), length)
    return run, np.arange(len(run)) + np.repeat(first - np.cumsum(length) + length, length)


@dataclass
class Vocabulary:
    """The terms of a shard's items: sorted hashes, and each one's bytes. Terms of one hash stand side by side."""

    hashes: np.ndarray
    raw: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, terms: set[bytes]) -> Vocabulary:
        kept = sorted(terms)
        raw = np.frombuffer(b"".join(kept), np.uint8)
        at = np.concatenate([[0], np.cumsum([len(t) for t in kept])]).astype(np.int64)
        h = word_hashes(raw, at[:-1], at[1:])
        order = np.argsort(h, kind="stable")
        ordered = [kept[i] for i in order.tolist()]
        return cls(h[order], np.frombuffer(b"".join(ordered), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in ordered])]).astype(np.int64))

    def numbers(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each term in the vocabulary, -1 if it has none: looked up by hash, confirmed by the bytes."""
        out = np.full(len(starts), -1, np.int64)
        if not len(self.hashes):
            return out
        h = word_hashes(raw, starts, ends)
        slot = np.searchsorted(self.hashes, h)
        open_ = np.flatnonzero(self.hashes[np.minimum(slot, len(self.hashes) - 1)] == h)
        slot = slot[open_]
        while len(open_):
            size = ends[open_] - starts[open_]
            same = self.at[slot + 1] - self.at[slot] == size
            run, mine = _spread(starts[open_], np.where(same, size, 0))
            theirs = _spread(self.at[slot], np.where(same, size, 0))[1]
            same &= np.bincount(run, raw[mine] != self.raw[theirs], len(open_)) == 0
            out[open_[same]] = slot[same]
            slot = slot + 1  # other bytes: the next term of the same hash, if there is one
            more = ~same & (slot < len(self.hashes))
            more[more] = self.hashes[slot[more]] == h[open_[more]]
            open_, slot = open_[more], slot[more]
        return out


def bags(column: pa.Array, vocabulary: Vocabulary) -> tuple[np.ndarray, list[bytes]]:
    """(number of terms, bag) of each text; a bag is the numbers of its terms in rising order, then their counts (32 bits each)."""
    raw, starts, ends, first = split(column)
    number = vocabulary.numbers(raw, starts, ends)
    row = np.repeat(np.arange(len(column)), np.diff(first))
    width = max(1, len(vocabulary.hashes))
    key, tf = np.unique((row * width + number)[number >= 0], return_counts=True)
    row, term, tf = key // width, (key % width).astype("<u4"), tf.astype("<u4")
    at = np.searchsorted(row, np.arange(len(column) + 1))
    return np.diff(first), [term[a:b].tobytes() + tf[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]


@dataclass
class Shard:
    """Items (rows of the benchmark) and postings: the items that hold a term, and how often."""

    items: list
    vocabulary: Vocabulary
    at: np.ndarray
    item: np.ndarray
    times: np.ndarray
    most: int  # terms of the longest item

    @classmethod
    def of(cls, items: list, texts: list[str]) -> Shard:
        raw, starts, ends, first = split(pa.array(texts, pa.string()))
        whole = raw.tobytes()
        vocabulary = Vocabulary.of({whole[a:b] for a, b in zip(starts.tolist(), ends.tolist())})
        number = vocabulary.numbers(raw, starts, ends)
        owner = np.repeat(np.arange(len(texts)), np.diff(first))
        key, times = np.unique(number * max(1, len(texts)) + owner, return_counts=True)
        term, item = key // max(1, len(texts)), key % max(1, len(texts))
        return cls(items, vocabulary, np.searchsorted(term, np.arange(len(vocabulary.hashes) + 1)), item, times, int(np.diff(first).max(initial=0)))

    def scores(self, rows: np.ndarray, term: np.ndarray, gain: np.ndarray, weight: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, item, score) of every row and item that share a term of some weight; rows rise and are below n."""
        run, at = _spread(self.at[term], self.at[term + 1] - self.at[term])
        key = rows[run] * len(self.items) + self.item[at]
        value = (weight[term] * gain)[run] * self.times[at]
        if self.most * int(weight.max(initial=0)) * 10 ** 6 < _EXACT:  # a term gains at most a million of its weight
            total = np.bincount(key, value.astype(float), n * len(self.items)).astype(np.int64)
        else:
            total = np.zeros(n * len(self.items), np.int64)
            np.add.at(total, key, value)
        hit = np.flatnonzero(total)
        return hit // len(self.items), hit % len(self.items), total[hit]


def _bag_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                n, found = bags(texts, shared.value.vocabulary)
                some = np.flatnonzero(n > 0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)).take(pa.array(some)), pa.array(n[some], pa.int64()),
                                                  pa.array([found[i] for i in some.tolist()], pa.binary())], names=["id", "n", "bag"])
                at += len(texts)
    return run


def _flat(bags_: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of the entries of a column of bags."""
    raw, offsets = buffers(bags_)
    values = raw.view("<u4") if len(raw) else np.zeros(0, "<u4")
    half = np.diff(offsets) // 8
    row, at = _spread(offsets[:-1] // 4, half)
    return row, values[at].astype(np.int64), values[at + half[row]].astype(np.int64)


def _frequencies(size: int):
    """(term, documents) of the classes of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            row, term, _ = _flat(batch.column(0))
            np.add.at(df, term, batch.column(1).to_numpy()[row])
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(df[seen])], names=["term", "df"])
    return run


def _gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _best(shared, weight, k: int):
    """(item, score, least, h, m, bag): the best k classes of each item among the classes of a task (h, m, bag, least)."""
    none = np.iinfo(np.int64).max

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, w = shared.value, weight.value
        kept = None  # item, score, no id, least, place; by item, best first
        rows: dict[int, tuple] = {}  # place -> class
        floor = np.zeros(len(shard.items), np.int64)  # the score of each item's k-th class so far
        count = 0
        for batch in batches:
            row, term, tf = _flat(batch.column(2))
            gain = _gain(tf, batch.column(1).to_numpy()[row])
            spread = np.concatenate([[0], np.cumsum(shard.at[term + 1] - shard.at[term])])
            ends = np.searchsorted(row, np.arange(batch.num_rows + 1))
            least, lacking = batch.column(3).fill_null(none).to_numpy(), batch.column(3).is_null().to_numpy(zero_copy_only=False)
            at = 0
            step = max(1, _EXPANDED // max(1, len(shard.items)))
            while at < batch.num_rows:
                to = int(np.searchsorted(spread[ends[1:]], spread[ends[at]] + _EXPANDED, side="right"))
                to = min(max(to, at + 1), at + step, batch.num_rows)
                own = slice(ends[at], ends[to])
                r, item, score = shard.scores(row[own] - at, term[own], gain[own], w, to - at)
                ok = (score >= floor[item]) & (score > 0)
                r, item, score = r[ok] + at, item[ok], score[ok]
                new = [item, score, lacking[r], least[r], count + r]
                kept = new if kept is None else [np.concatenate(x) for x in zip(kept, new)]
                order = np.lexsort((kept[3], kept[2], -kept[1], kept[0]))
                kept = [x[order] for x in kept]
                start = np.searchsorted(kept[0], kept[0])
                top = np.arange(len(start)) - start < k
                kept = [x[top] for x in kept]
                full, times = np.unique(kept[0], return_counts=True)
                last = np.searchsorted(kept[0], full, side="right") - 1
                floor[full[times == k]] = kept[1][last[times == k]]
                at = to
            places = set(kept[4].tolist()) if kept else set()
            for p in places - rows.keys():
                rows[p] = tuple(batch.column(i)[p - count].as_py() for i in range(3))
            rows = {p: rows[p] for p in places}
            count += batch.num_rows
        if kept is not None and len(kept[0]):
            own = [rows[p] for p in kept[4].tolist()]
            ids = pa.array(kept[3], mask=kept[2].astype(bool))
            yield pa.RecordBatch.from_arrays([pa.array(kept[0]), pa.array(kept[1]), ids, pa.array([x[0] for x in own], pa.binary()),
                                              pa.array([x[1] for x in own], pa.int64()), pa.array([x[2] for x in own], pa.binary())],
                                             names=["item", "score", "least", "h", "m", "bag"])
    return run


def _shards(items: DataFrame, item_id: str, text: str, limit: int) -> Iterator[pd.DataFrame]:
    """The items' ids and texts in shards of at most ``limit`` bytes (an item longer than that is a shard of its own)."""
    t = items.select(F.col(item_id).alias("item"), text_of(items[text]).alias("text")).withColumn("row", F.monotonically_increasing_id())
    t = t.withColumn("bytes", F.octet_length("text").cast("long") + ITEM_BYTES)
    t = running(written(t, "items"), [], [F.col("row")], {"before": "bytes"}, "sharded")
    t = t.withColumn("shard", F.floor((F.col("before") + F.col("bytes")) / limit))
    t = written(t, "shards")
    for r in t.select("shard").distinct().orderBy("shard").toLocalIterator():
        yield t.filter(F.col("shard") == r.shard).orderBy("row").select("item", "text").toPandas()


def ranked(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
           k: int = TOP, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item with a score above 0, equal scores by ascending id (null last).

    Null texts have no terms, on either side; an item without terms, or none of whose terms is met, has no row. Each row of
    ``df`` is a document, repeated ones too. Each row of ``items`` is ranked; rows of one id give their rows under that id.
    Other columns are ignored; an empty table on either side gives no row.
    """
    spark = df.sparkSession
    ship(spark)
    kind, item_kind = dict(df.dtypes)[id_col], dict(items.dtypes)[item_id]
    t = df.select(F.col(id_col).cast("long").alias("id"), text_of(df[text]).alias("text"))
    out = None
    for pdf in _shards(items, item_id, item_text, shard_bytes):
        shard = Shard.of(pdf["item"].tolist(), pdf["text"].tolist())
        shared = spark.sparkContext.broadcast(shard)
        bagged = written(t.mapInArrow(_bag_rows(shared), "id long, n long, bag binary").withColumn("h", F.unhex(F.md5("bag"))), "bags")
        n_docs, n_terms = bagged.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        # no document has a term: m is not needed
        m = F.lit(25).cast("long") + F.expr(f"(75L * n * {n_docs}L) div {max(1, n_terms)}L")
        docs = bagged.filter(F.octet_length("bag") > 0).withColumn("m", m).drop("n")
        classes = written(docs.groupBy("h", "m", "bag").agg(F.count("*").alias("size"), F.min("id").alias("least")), "classes")
        size = len(shard.vocabulary.hashes)
        frequencies = classes.select("bag", "size").mapInArrow(_frequencies(size), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
        weight = np.zeros(size, np.int64)
        for r in frequencies.toLocalIterator():  # a row for each term of the shard
            weight[r.term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r.df + 1)))
        weights = spark.sparkContext.broadcast(weight)
        best = classes.select("h", "m", "bag", "least").mapInArrow(_best(shared, weights, k), "item long, score long, least long, h binary, m long, bag binary")
        of_item = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("least").asc_nulls_last(), "h")
        best = written(best.withColumn("r", F.row_number().over(of_item)).filter(F.col("r") <= k).drop("r", "least"), "best")
        # the least ids of the classes that any item needs (k hashes an item of the shard are broadcast, 16 MB at most); a class of
        # many members gives k rows a task
        chosen = best.select("h", "m").distinct()
        first = Window.partitionBy("h", "m", "bag").orderBy(F.col("id").asc_nulls_last())
        members = docs.join(F.broadcast(chosen), ["h", "m"], "left_semi").withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k).drop("r")
        found = best.join(members, ["h", "m", "bag"]).select("item", "score", "id")
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
        found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame(pd.DataFrame({"item": np.arange(len(pdf)), "item_id": pdf["item"]}), f"item long, item_id {item_kind}")
        found = written(found.join(F.broadcast(names), "item").select("item_id", "rank", F.col("id").cast(kind).alias("doc_id"), "score"), "ranked")
        shared.destroy()
        weights.destroy()
        discard(bagged, classes, best)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {kind}, score long")


#: DuckDB SQL for the ranking over the tables documents and benchmark.
RANKED_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT row_number() OVER () AS irow, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
i AS (SELECT irow, item_id, term, count(*) AS times FROM q GROUP BY irow, item_id, term),
c AS (SELECT row, doc_id, term, count(*) AS tf FROM d GROUP BY row, doc_id, term),
n AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM c GROUP BY row),
s AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * s.docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM c, s WHERE term IN (SELECT term FROM i) GROUP BY term, s.docs),
g AS (SELECT c.row, c.doc_id, c.term, w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (25 + (75 * n.n * s.docs) // s.terms))) AS gain
  FROM c JOIN w ON w.term = c.term JOIN n ON n.row = c.row, s),
r AS (SELECT i.irow, i.item_id, g.row, g.doc_id, CAST(sum(i.times * g.gain) AS BIGINT) AS score FROM i JOIN g ON g.term = i.term GROUP BY ALL),
o AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY irow ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM r WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 10
"""
