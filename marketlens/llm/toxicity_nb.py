"""Operator 3: toxicity by a character n-gram linear classifier scaled with naive Bayes log-count ratios.

Features are the distinct character 4- to 6-grams of a text (lower case, runs of anything but letters and digits read
as one space). For each n-gram the log ratio of its document counts in the toxic and the clean class scales the feature; a logistic
regression on the scaled features is trained on a bounded labelled sample. The counts are exact and are taken by Spark: tasks
count the n-grams of their texts, and counts are summed by n-gram; only the entries of the kept n-grams come to the driver.
Scoring is vectorised: rolling hashes of all n-grams of many texts at once, a bitmap that rules most of them out, then an exact
look-up of the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import byte_batches, discard, fresh, held_out, lean, ship, text_of, written
from marketlens.llm.labelled import training_rows

THRESHOLD = 0.7
SIZES = (4, 5, 6)
#: Documents an n-gram must be in, the least log ratio, the most features (by ratio times root of count: the bound of what is
#: broadcast, 16 MB), ridge. Only n-grams that speak for the toxic class are features: with those that speak against it as well, fewer
#: held-out toxic texts were found, scaled by the text's length or not (figures in the README).
MIN_DOCS, MIN_RATIO, FEATURES, RIDGE = 4, 1.5, 1 << 20, 1e-3
#: Labelled texts of each class.
ROWS = 1500
_A = np.uint64(0xD6E8FEB86659FD93)
_M = np.uint64(0x9E3779B97F4A7C15)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, each with a space on both sides, offsets): anything but letters and digits is one space."""
    joined = [f" {t.lower()} " for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in joined])])
    c = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    word = (c >= 128) | _ASCII_WORD[np.minimum(c, 127).astype(np.int64)]
    keep = word.copy()
    keep[1:] |= word[:-1]  # the first separator after a word stays
    keep[offsets[:-1]] = True
    c = np.where(word, c, np.uint64(32))
    return c[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


_ASCII_WORD = np.array([chr(i).isalnum() for i in range(128)])


def _ngrams(codes: np.ndarray, sizes: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray]]:
    """(n, hash of the n-gram that starts at each code point)."""
    with np.errstate(over="ignore"):
        h = codes.copy()
        for n in range(2, max(sizes) + 1):
            h = h[:-1] * _A + codes[n - 1:] if len(h) > 1 else h[:0]
            if n in sizes:
                x = (h + np.uint64(n)) * _M
                yield n, x ^ (x >> np.uint64(29))


def _every(texts: list[str], sizes: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, hash) of all n-grams of each text, repeats included, size by size."""
    codes, offsets = _codes(texts)
    own = np.repeat(np.arange(len(texts)), np.diff(offsets))
    for n, h in _ngrams(codes, sizes):
        ok = own[:len(h)] == own[n - 1:]
        yield own[:len(h)][ok], h[ok]


@dataclass
class Model:
    """Weights (coefficient times log-count ratio) of the kept n-grams, sorted by hash."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float
    sizes: tuple[int, ...] = SIZES

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_maybe"}

    @property
    def maybe(self) -> np.ndarray:
        """Whether an n-gram with these top bits may be a feature; made where it is used, not sent."""
        if "_maybe" not in self.__dict__:
            self._maybe = np.zeros(1 << 22, bool)
            self._maybe[(self.hashes >> np.uint64(42)).astype(np.int64)] = True
        return self._maybe

    def scores(self, texts: list[str]) -> np.ndarray:
        z = np.full(len(texts), self.bias)
        if not len(self.hashes):
            return 1 / (1 + np.exp(-z))
        codes, offsets = _codes(texts)
        docs, found = [], []
        for n, h in _ngrams(codes, self.sizes):
            at = np.flatnonzero(self.maybe[(h >> np.uint64(42)).astype(np.int64)])
            f = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
            doc = np.searchsorted(offsets, at, side="right") - 1
            ok = (self.hashes[f] == h[at]) & (at + n <= offsets[doc + 1])
            docs.append(doc[ok])
            found.append(f[ok])
        key = np.unique(np.concatenate(docs) * len(self.hashes) + np.concatenate(found))
        z += np.bincount(key // len(self.hashes), self.weights[key % len(self.hashes)], len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _distinct(texts: list[str], sizes: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(document, hash, number of documents before) of the distinct n-grams of each text, run by run and size by size."""
    at = 0
    for run in byte_batches(texts, 1 << 18):
        for d, h in _every(run, sizes):
            order = np.lexsort((h, d))
            d, h = d[order], h[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
            yield d[new], h[new], at
        at += len(run)


def _counted(sizes: tuple[int, ...]):
    """(h, n, toxic): documents and toxic documents of each n-gram of a run of texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(1).to_numpy().astype(float)
            for d, h, at in _distinct(batch.column(0).to_pylist(), sizes):
                vocab, f, n = np.unique(h, return_inverse=True, return_counts=True)
                toxic = np.bincount(f, y[d + at], len(vocab)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(vocab.view(np.int64)), pa.array(n), pa.array(toxic)], names=["h", "n", "toxic"])
    return run


def _entries(shared, sizes: tuple[int, ...]):
    """(y, f): a text's class and the places of its n-grams among the kept ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = shared.value
        for batch in batches:
            own: list[list[np.ndarray]] = [[] for _ in range(batch.num_rows)]
            for d, h, at in _distinct(batch.column(0).to_pylist(), sizes):
                f = np.minimum(np.searchsorted(kept, h), len(kept) - 1)
                ok = kept[f] == h
                d, f = d[ok] + at, f[ok]
                for i, part in zip(*_groups(d, f)):
                    own[i].append(part)
            cols = [np.sort(np.concatenate(x)).astype(np.int32) if x else np.zeros(0, np.int32) for x in own]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(cols, pa.list_(pa.int32()))], names=["y", "f"])
    return run


def _groups(d: np.ndarray, f: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    ids, first = np.unique(d, return_index=True)
    return ids.tolist(), np.split(f, first[1:])


def _regression(doc: np.ndarray, col: np.ndarray, ratio: np.ndarray, y: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """(coefficients times ratios, bias) of the ridge logistic regression with balanced classes, by Adam; (doc, col) are the ones."""
    n1, n0 = y.sum(), len(y) - y.sum()
    w, b = np.ones(len(ratio)) * 0.05, 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    weight = np.where(y > 0, 0.5 / n1, 0.5 / n0)
    for t in range(1, rounds + 1):
        z = np.bincount(doc, (w * ratio)[col], len(y)) + b
        e = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        g = np.bincount(col, e[doc], len(ratio)) * ratio + RIDGE * w
        gb = e.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        fix = np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)
        w -= 0.02 * fix * m / (np.sqrt(v) + 1e-8)
        b -= 0.02 * fix * mb / (np.sqrt(vb) + 1e-8)
    return w * ratio, float(b)


def train(rows: DataFrame, sizes: tuple[int, ...] = SIZES, rounds: int = 300) -> Model:
    """Fit on ``rows`` (text, y: a bounded sample, written down); without both classes the model says 0 for every text."""
    spark = rows.sparkSession
    ship(spark)
    n, n1 = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < n1 < n:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -30.0, sizes)
    t = rows.select("text", F.col("y").cast("long").alias("y"))
    counts = t.mapInArrow(lean(_counted(sizes)), "h long, n long, toxic long").groupBy("h").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    ratio = F.log((F.col("toxic") + 0.5) / (n1 + 1)) - F.log((F.col("n") - F.col("toxic") + 0.5) / (n - n1 + 1))
    good = counts.filter(F.col("n") >= MIN_DOCS).withColumn("ratio", ratio).filter(F.col("ratio") >= MIN_RATIO)
    kept = good.orderBy((F.col("ratio") * F.sqrt("n")).desc(), "h").limit(FEATURES).select("h", "ratio").toPandas()
    if not len(kept):
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(n1 / (n - n1))), sizes)
    h = kept["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(h)
    h, r = h[order], kept["ratio"].to_numpy()[order]
    shared = spark.sparkContext.broadcast(h)
    entries = t.mapInArrow(lean(_entries(shared, sizes)), "y long, f array<int>").orderBy("y", "f").toPandas()
    shared.destroy()
    doc = np.repeat(np.arange(len(entries)), entries["f"].map(len).to_numpy(int))
    weights, bias = _regression(doc, np.concatenate(entries["f"].tolist()).astype(np.int64), r, entries["y"].to_numpy(float), rounds)
    return Model(h, weights, bias, sizes)


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Train on the bounded sample of ``training_rows``; labels of held-out ids are never read."""
    sample = written(training_rows(df, labels, label, id_col, text, ROWS), "sample")
    model = train(sample)
    discard(sample)
    return model


def score_column(model: Model, text, spark):
    """Column of scores of whole texts (null: empty)."""
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    @lean
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            runs = [shared.value.scores(run) for run in byte_batches(batch, 1 << 18)]
            yield pd.Series(np.concatenate(runs) if runs else np.zeros(0))

    return score(text_of(text))


def toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
             threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row.

    Null and empty texts get the score of a text without n-grams (the bias); repeated rows are scored each; a null id
    is not held out; other columns are ignored; an empty table gives none; labels without both classes give score 0.
    """
    model = fit(df, labels, id_col, text, label)
    t = df.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    t = t.withColumn("score", score_column(model, "text", df.sparkSession))
    return t.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
               threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` with a score under the threshold, with all their columns."""
    model = fit(df, labels, id_col, text, label)
    name, = fresh(df, "score")
    scored = df.withColumn(name, score_column(model, df[text], df.sparkSession))
    return scored.filter(F.col(name) < threshold).select(*[F.col(f"`{c}`") for c in df.columns])
