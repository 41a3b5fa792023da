"""Operator 8: benchmark decontamination with a BM25 index of the test items and block-max WAND.

The index holds the test items; every passage of every training document is a query against it. An item's
score is the BM25 weight of its terms that the passage has, as a share of the item's own whole weight, so one
threshold serves all items. Passages are as long as two of the longest items and overlap by half, so each
occurrence of an item lies whole inside one. Upper bounds (per block of 4 items) are summed for many passages at
once; the items of those that can reach the threshold are scored, which gives every
item above it. A hit counts when both the item's question and its answer overlap with the passage.

Block maxima are postings like the items' own (a term's blocks and its greatest impact in each), so the index grows with the
items' words. A passage's terms of least impact, which together stay under a share of the threshold, are set aside: the
postings of the others alone say which blocks can still reach it (the pivot of WAND, for all passages of a run at once), and only
in those the terms set aside are looked up.

An item of few words has no such score that means anything: it is found where all its words stand together in order, by the hash of the
run. Characters of scripts that put no spaces between words (Chinese, Japanese, Thai, Lao, Burmese, Khmer) are words of their own.

The benchmark is cut into shards by running bytes; each shard's index is built in a task and broadcast, and the documents stream
past each shard in turn. Nothing is shuffled but the benchmark's own terms.
"""

from __future__ import annotations

import pickle
import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import discard, fresh, lean, running, ship, text_of, written
from marketlens.llm.hashing import buffers, grams, slices, word_hashes, words

K1, B = 1.2, 0.75
#: Share of an item's BM25 weight, and of the 3-word shingles of its question and of its answer, that a passage must have.
SCORE, OVERLAP, GRAM = 0.6, 0.5, 3
BLOCK = 4
#: Part of the threshold that the terms set aside may reach, and postings that a run of passages is expanded to at once.
ASIDE, EXPANDED = 0.5, 1 << 21
#: Rounding of the bounds.
SLACK = 1e-6
#: Bytes of item texts in a shard (what is broadcast is proportional), and words that an item needs to be scored: shorter ones are
#: looked for as they stand.
SHARD_BYTES, MIN_WORDS = 2 << 20, 8

_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[ord(c) for c in string.punctuation]] = 32


#: Code points that are words of their own (scripts without spaces): first and one past the last.
_UNSPACED = ((0x0E00, 0x10A0), (0x1780, 0x1800), (0x1950, 0x1AB0), (0x1B00, 0x1B80), (0x2E80, 0x3130), (0x31A0, 0x3200), (0x3400, 0x4DC0),
             (0x4E00, 0xA000), (0xA980, 0xAAE0), (0xF900, 0xFB00), (0xFF00, 0xFFA0), (0x1AFF0, 0x1B170), (0x20000, 0x40000))
_OWN = np.zeros(0x200000, bool)
for _a, _b in _UNSPACED:
    _OWN[_a:_b] = True


def _unspaced(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, one past the last) of the characters in _UNSPACED; all of them have three or four bytes of UTF-8."""
    at = np.flatnonzero(raw >= 0xE0)
    lead, b, c, d = (raw[np.minimum(at + i, len(raw) - 1)].astype(np.int64) for i in range(4))
    four = lead >= 0xF0
    point = (lead & 0x0F) << 12 | (b & 0x3F) << 6 | c & 0x3F
    point = np.where(four, (point & 0x7FFF) << 6 | d & 0x3F, point)
    own = _OWN[point]
    return at[own], (at + np.where(four, 4, 3))[own]


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every lower-case word without ASCII punctuation, first word of each text and one past the last)."""
    raw, offsets = buffers(pc.utf8_lower(column))
    raw = _PLAIN[raw]
    starts, ends, first = words(raw, offsets)
    if len(raw) and raw.max() >= 0xE0:
        a, b = _unspaced(raw)
        starts, ends = (np.unique(np.concatenate([starts, a, b[~np.isin(b, ends)]])),
                        np.unique(np.concatenate([ends, b, a[~np.isin(a, starts)]])))
        first = np.searchsorted(starts, offsets, side="left")
    return word_hashes(raw, starts, ends), first


@dataclass
class Index:
    """Postings of one shard: CSR by term over item numbers, impacts as shares of the item's own weight."""

    items: list = field(default_factory=list)
    parts: list = field(default_factory=list)  # (question grams, answer grams) of each item
    vocab: np.ndarray = None
    at: np.ndarray = None
    docs: np.ndarray = None
    impact: np.ndarray = None
    block_at: np.ndarray = None  # blocks of each term: CSR by term
    block: np.ndarray = None
    block_impact: np.ndarray = None  # greatest impact of the term in the block
    longest: int = 0
    short: dict = field(default_factory=dict)  # number of words -> (hashes of whole items in order, their item numbers)

    def __post_init__(self):
        if self.vocab is not None:
            self.maybe = np.zeros(1 << 16, bool)
            self.maybe[(self.vocab >> np.uint64(48)).astype(np.int64)] = True
            self.most = np.maximum.reduceat(self.block_impact, self.block_at[:-1])  # of each term; none is without a posting
            self.key = np.repeat(np.arange(len(self.vocab)), np.diff(self.block_at)) * self.n_blocks + self.block
            self.term = np.repeat(np.arange(len(self.vocab)), np.diff(self.at))
            self.own = np.argsort(self.docs // BLOCK, kind="stable")  # postings by block
            self.own_at = np.searchsorted(self.docs[self.own] // BLOCK, np.arange(self.n_blocks + 1))

    @property
    def n_blocks(self) -> int:
        return -(-len(self.parts) // BLOCK)

    def tops(self, term: np.ndarray, block: np.ndarray) -> np.ndarray:
        """The greatest impact of each term in each block, 0 where the block has none."""
        want = term * self.n_blocks + block
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where(self.key[at] == want, self.block_impact[at], 0.0)

    def candidates(self, passage: np.ndarray, term: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(passage, block), rising, of all pairs whose bound reaches the threshold. Input: distinct (passage, term), by passage."""
        order = np.lexsort((self.most[term], passage))
        passage, term = passage[order], term[order]
        first = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
        own = np.repeat(np.arange(len(first)), np.diff(first, append=len(passage)))
        total = np.cumsum(self.most[term])
        total = total - (total[first] - self.most[term[first]])[own]  # running sum inside the passage, least impact first
        aside = total < ASIDE * threshold
        rest = np.bincount(own, np.where(aside, self.most[term], 0.0), len(first))  # what the terms set aside can add at most
        p, t = own[~aside], term[~aside]
        n = self.block_at[t + 1] - self.block_at[t]
        ends = np.concatenate([[0], np.cumsum(n)])
        got = []
        at = 0
        while at < len(p):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + EXPANDED, side="right")) - 1)
            to = int(np.searchsorted(p, p[to - 1], side="right"))  # a passage's terms stay together
            m = n[at:to]
            place = np.arange(int(m.sum())) + np.repeat(self.block_at[t[at:to]] - np.cumsum(m) + m, m)
            key, slot = np.unique(np.repeat(p[at:to], m) * self.n_blocks + self.block[place], return_inverse=True)
            bound = np.bincount(slot, self.block_impact[place], len(key))
            got.append(key[bound + rest[key // self.n_blocks] >= threshold - SLACK])
            at = to
        key = np.concatenate(got) if got else np.zeros(0, np.int64)
        q, block = key // self.n_blocks, key % self.n_blocks
        # the terms set aside, looked up in what is left
        size = np.diff(first, append=len(passage))
        out = np.zeros(len(key), bool)
        step = max(1, EXPANDED // int(size.max(initial=1)))
        for i in range(0, len(key), step):
            m = size[q[i:i + step]]
            run = np.repeat(np.arange(len(m)), m)
            place = np.arange(len(run)) + np.repeat(first[q[i:i + step]] - np.cumsum(m) + m, m)
            bound = np.bincount(run, self.tops(term[place], block[i:i + step][run]), len(m))
            out[i:i + step] = bound >= threshold - SLACK
        return passage[first][q[out]], block[out]

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, term numbers) of the hashes that are terms of the index."""
        at = np.flatnonzero(self.maybe[(hashes >> np.uint64(48)).astype(np.int64)])
        t = np.searchsorted(self.vocab, hashes[at])
        t[t == len(self.vocab)] = 0
        ok = self.vocab[t] == hashes[at]
        return at[ok], t[ok]

    def scored(self, key: np.ndarray, passage: np.ndarray, block: np.ndarray, threshold: float) -> Iterator[tuple[int, int, float]]:
        """Every (passage, item number, score) with score >= threshold among the items of the pairs (passage, block).

        key: the passages' terms as passage * terms + term, rising. A pair adds up the postings of its block whose term the passage has.
        """
        size = self.own_at[block + 1] - self.own_at[block]
        step = max(1, EXPANDED // int(size.max(initial=1)))
        for i in range(0, len(block), step):
            m = size[i:i + step]
            run = np.repeat(np.arange(len(m)), m)
            place = self.own[np.arange(len(run)) + np.repeat(self.own_at[block[i:i + step]] - np.cumsum(m) + m, m)]
            want = passage[i:i + step][run] * len(self.vocab) + self.term[place]
            at = np.minimum(np.searchsorted(key, want), len(key) - 1)
            ok = key[at] == want
            total = np.bincount((run * BLOCK + self.docs[place] % BLOCK)[ok], self.impact[place[ok]], len(m) * BLOCK)
            for hit in np.flatnonzero(total >= threshold).tolist():
                pair = i + hit // BLOCK
                yield int(passage[pair]), int(block[pair]) * BLOCK + hit % BLOCK, float(total[hit])

    def whole(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, float, int, float, float]]:
        """As hits, for the items of few words."""
        for n, (keys, numbers) in self.short.items():
            g = grams(hashes, n)
            lo = np.searchsorted(keys, g)
            at = np.flatnonzero(keys[np.minimum(lo, len(keys) - 1)] == g)
            row = np.searchsorted(first, at, side="right") - 1
            inside = at + n <= first[row + 1]
            at, row = at[inside], row[inside]
            for i in np.unique(row * len(keys) + lo[at], return_index=True)[1].tolist():
                p, r = int(at[i]), int(row[i])
                for item in numbers[lo[p]:np.searchsorted(keys, g[p], side="right")].tolist():
                    yield r, item, 1.0, p - int(first[r]), 1.0, 1.0

    def hits(self, column: pa.Array, score: float, overlap: float) -> Iterator[tuple[int, int, float, int, float, float]]:
        """(row, item number, score, first word, question share, answer share): the best passage of each row and item.

        For an item of few words, that is the first place where all of it stands.
        """
        hashes, first = terms(column)
        yield from self.whole(hashes, first)
        if self.vocab is None:
            return
        stride = self.longest
        n = np.diff(first)
        count = np.maximum(1, -(-n // stride) - 1)  # passages of each row
        base = np.concatenate([[0], np.cumsum(count)])
        at, term = self.lookup(hashes)
        row = np.searchsorted(first, at, side="right") - 1
        q = (at - first[row]) // stride
        own = np.minimum(q, count[row] - 1)
        before = (q >= 1) & (q - 1 < own)
        passage = np.concatenate([base[row] + own, (base[row] + q - 1)[before]])
        term = np.concatenate([term, term[before]])
        key = np.unique(passage * len(self.vocab) + term)
        passage, term = key // len(self.vocab), key % len(self.vocab)
        best: dict[tuple[int, int], tuple] = {}
        hit, block = self.candidates(passage, term, score) if len(key) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for p, item, s in self.scored(key, hit, block, score):
            r = int(np.searchsorted(base, p, side="right")) - 1
            if s > best.get((r, item), (0, 0.0))[1]:
                start = int(first[r]) + (p - int(base[r])) * stride
                seen = np.unique(grams(hashes[start:min(start + 2 * stride, int(first[r + 1]))], GRAM))
                share = [float(np.isin(g, seen).mean()) for g in self.parts[item]]
                if min(share) >= overlap:
                    best[r, item] = (item, s, start - int(first[r]), *share)
        for (r, item), found in best.items():
            yield (r, *found)


def _postings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words of each item in order, where its answer begins, and its terms with their counts."""
    for pdf in batches:
        rows = []
        for item, question, answer in zip(pdf["item"], pdf["question"], pdf["answer"]):
            h, first = terms(pa.array([question, answer]))
            seen, tf = np.unique(h.view(np.int64), return_counts=True)
            # without an answer of its own, the last quarter of an item is its answer
            split = int(first[1]) if first[2] > first[1] else len(h) - max(GRAM, len(h) // 4)
            if len(h):
                rows.append((item, h.view(np.int64).tolist(), split, seen.tolist(), tf.tolist()))
        yield pd.DataFrame(rows, columns=["item", "words", "split", "terms", "tfs"])


def _ids(frame: pd.DataFrame) -> list[str | None]:
    return [x if isinstance(x, str) else None for x in frame.item]


def _short(frame: pd.DataFrame, number: int) -> dict:
    """Index.short of the frame's items, which are numbered from ``number``."""
    runs: dict[int, list[tuple[int, int]]] = {}
    for i, w in enumerate(frame.words, number):
        h = np.asarray(w, np.int64).view(np.uint64)
        runs.setdefault(len(h), []).append((int(grams(h, len(h))[0]), i))
    return {n: (np.array([k for k, _ in sorted(x)], np.uint64), np.array([i for _, i in sorted(x)], np.int64)) for n, x in runs.items()}


def _weights(frame: pd.DataFrame, n_items: int, mean: float) -> Index | None:
    """The index of one shard's items; frame has a row for each item with lists terms, tfs and dfs."""
    if not len(frame):
        return None
    few = frame.words.map(len) < MIN_WORDS
    few, frame = frame[few], frame[~few]
    short = _short(few, len(frame))
    if not len(frame):
        return Index(_ids(few), short=short)
    # items of like vocabulary stand together, which keeps block bounds low: order by the most frequent term
    frame = frame.assign(lead=[t[int(np.argmax(d))] for t, d in zip(frame.terms, frame.dfs)]).sort_values(["lead", "item"])
    vocab = np.unique(np.concatenate([np.asarray(t, np.int64) for t in frame.terms]).view(np.uint64))
    term, doc, impact, parts = [], [], [], []
    for i, (w, split, t, tf, df) in enumerate(zip(frame.words, frame.split, frame.terms, frame.tfs, frame.dfs)):
        tf, df, n = np.asarray(tf, float), np.asarray(df, float), len(w)
        idf = np.log1p((n_items - df + 0.5) / (df + 0.5))
        weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * n / mean))
        term.append(np.searchsorted(vocab, np.asarray(t, np.int64).view(np.uint64)))
        doc.append(np.full(len(t), i))
        impact.append(weight / weight.sum())
        h = np.asarray(w, np.int64).view(np.uint64)
        parts.append(tuple(grams(x, min(GRAM, len(x))) if len(x) >= GRAM else grams(h, GRAM) for x in (h[:split], h[split:])))
    term, doc, impact = np.concatenate(term), np.concatenate(doc), np.concatenate(impact)
    order = np.lexsort((doc, term))
    term, doc, impact = term[order], doc[order], impact[order]
    blocks = -(-len(frame) // BLOCK)
    key, slot = np.unique(term * blocks + doc // BLOCK, return_inverse=True)
    top = np.zeros(len(key))
    np.maximum.at(top, slot, impact)
    return Index(_ids(frame) + _ids(few), parts, vocab, np.searchsorted(term, np.arange(len(vocab) + 1)), doc, impact,
                 np.searchsorted(key // blocks, np.arange(len(vocab) + 1)), key % blocks, top, max(max(map(len, frame.words)), GRAM), short)


def indexes(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", answer: str | None = None,
            shard_bytes: int | None = None) -> Iterator[bytes]:
    """One pickled index for each shard of the benchmark, one at a time; document frequencies and the mean length are over all
    items of 8 words or more.

    Null texts are empty and not looked for; items under 8 words are looked for whole; rows that repeat an item (id and words)
    count once. A shard holds items of at most ``shard_bytes`` (``SHARD_BYTES`` if not given; 16 bytes a word), or one longer item; its index is built in a task.
    """
    ship(benchmark.sparkSession)
    shard_bytes = shard_bytes or SHARD_BYTES
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), text_of(text).alias("question"),
                             (text_of(answer) if answer else F.lit("")).alias("answer"))
    rows = items.mapInPandas(_postings, "item string, words array<long>, split int, terms array<long>, tfs array<int>")
    # rows of equal words are one item, whatever their case and punctuation
    rows = rows.groupBy("item", "words", "split").agg(F.first("terms").alias("terms"), F.first("tfs").alias("tfs"))
    rows = rows.withColumns({"bytes": F.size("words").cast("long") * 16 + 64, "h": F.xxhash64("words")})
    rows = running(written(rows, "items"), [], [F.col("h"), F.col("item"), F.col("split")], {"before": "bytes"}, "items")
    rows = written(rows.withColumn("shard", F.floor((F.col("before") + F.col("bytes")) / shard_bytes)).drop("before", "bytes", "h"), "items")
    few = rows.filter(F.size("words") < MIN_WORDS).select(
        "item", "shard", "words", "split", *[F.array().cast(f"array<{t}>").alias(c) for c, t in (("terms", "long"), ("tfs", "int"), ("dfs", "long"))])
    many = rows.filter(F.size("words") >= MIN_WORDS)
    n_items, mean = many.agg(F.count("*"), F.avg(F.size("words"))).first()
    df = many.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    flat = many.select("item", "shard", "words", "split", F.explode(F.arrays_zip("terms", "tfs")).alias("z")) \
        .select("item", "shard", "words", "split", F.col("z.terms").alias("term"), F.col("z.tfs").alias("tf")).join(df, "term")
    per = flat.groupBy("item", "shard", "words", "split").agg(F.array_sort(F.collect_list(F.struct("term", "tf", "df"))).alias("z")) \
        .select("item", "shard", "words", "split", *[F.col(f"z.{c}").alias(c + "s") for c in ("term", "tf", "df")]).unionByName(few)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "index": [pickle.dumps(_weights(pdf, n_items, mean or 1.0))]})

    built = written(per.groupBy("shard").applyInPandas(build, "shard long, index binary"), "indexes")
    for (shard,) in built.select("shard").orderBy("shard").collect():  # a number for each shard
        yield built.filter(F.col("shard") == shard).first()["index"]
    discard(built, rows)


class Held:
    """An index as it is broadcast: bytes, read once in each Python worker that needs it."""

    def __init__(self, data: bytes):
        self.data = data

    @property
    def index(self) -> Index:
        if "_index" not in self.__dict__:
            self._index = pickle.loads(self.data)
        return self._index

    def __getstate__(self) -> dict:
        return {"data": self.data}


def contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", answer: str | None = None, score: float = SCORE, overlap: float = OVERLAP) -> DataFrame:
    """doc_id, item_id, score, passage_start, question_overlap, answer_overlap: a row for each document row and item it holds.

    passage_start counts words. An item under 8 words counts where it stands whole and in order. Documents without a hit have no row, nor have null and empty ones; repeated rows are
    reported each; a null id is reported as null. Other columns are ignored. An empty table on either side gives none.
    """
    spark = df.sparkSession
    ship(spark)
    kind = dict(benchmark.dtypes)[item_id]
    schema = f"doc_id {dict(df.dtypes)[id_col]}, item_id string, score double, passage_start long, question_overlap double, answer_overlap double"
    kinds = [pa.string(), pa.float64(), pa.int64(), pa.float64(), pa.float64()]
    t = df.select(F.col(id_col).alias("doc_id"), text_of(text).alias("text"))
    found = None
    for index in indexes(benchmark, item_id, item_text, answer):
        shared = spark.sparkContext.broadcast(Held(index))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value.index
            for batch in batches:
                at, got = 0, []
                for texts in slices(batch.column(1)):
                    got += [(at + r, index.items[i], *rest) for r, i, *rest in index.hits(texts, score, overlap)]
                    at += len(texts)
                if got:
                    rows, *cols = zip(*got)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *[pa.array(c, k) for c, k in zip(cols, kinds)]],
                                                     names=["doc_id", "item_id", "score", "passage_start", "question_overlap", "answer_overlap"])

        part = t.mapInArrow(lean(run), schema)
        found = part if found is None else found.unionByName(part)
    found = found if found is not None else spark.createDataFrame([], schema)
    return found.withColumn("item_id", F.col("item_id").cast(kind))


def _leaks(shared, score: float, overlap: float):
    def leaks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            bad, at = np.zeros(len(batch), bool), 0
            for texts in slices(pa.array(batch, pa.string())):
                for r, *_ in shared.value.index.hits(texts, score, overlap):
                    bad[at + r] = True
                at += len(texts)
            yield pd.Series(bad)

    return leaks


def decontaminate(df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  answer: str | None = None, score: float = SCORE, overlap: float = OVERLAP) -> DataFrame:
    """The rows of ``df`` that hold no item of the benchmark, with all their columns; no shuffle and no join."""
    spark = df.sparkSession
    ship(spark)
    columns = df.columns
    for index in indexes(benchmark, item_id, item_text, answer):
        shared = spark.sparkContext.broadcast(Held(index))

        name, = fresh(df, "leaks")
        df = df.withColumn(name, F.pandas_udf(lean(_leaks(shared, score, overlap)), "boolean")(text_of(df[text]))).filter(~F.col(name))
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    return df
