"""Operator 2: quality by a byte-level convolutional network in numpy.

Bytes are embedded; filters 16 bytes wide slide over the whole document in steps of 4. The
document is covered by chunks of 256 bytes that overlap by half. Each filter's
rectified responses are max-pooled in every chunk, and a document is described by the mean, the greatest and the least of
its chunks' maxima; a linear layer combines them into one probability. Embedding, filters and output layer are learned together
by back-propagation (Adam) on a bounded labelled sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import fresh, held_out, ship, text_of
from marketlens.llm.hashing import buffers, slices
from marketlens.llm.labelled import training_sample

THRESHOLD = 0.5
EMBED, WIDTH, STEP, FILTERS = 6, 16, 4, 32
#: Positions of half a chunk (32 x 4 bytes = 128) - a chunk is two halves.
HALF = 32
#: Rows of each class learned from, passes over them, documents and bytes of a step, rate.
ROWS, EPOCHS, BATCH, STEP_BYTES, RATE = 1200, 10, 64, 1 << 18, 4e-3
PAD = 256
#: Scale of the feature that tells a text shorter than one chunk.
EMPTY = 10.0


def _layout(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all documents, each padded to whole halves and one half of guard; first half of each and one past the last).

    Every document has at least two halves besides its guard, so even an empty one is one chunk (of padding), and no
    filter looks from one document into the next.
    """
    n = np.diff(offsets)
    halves = np.maximum(2, -(-n // (HALF * STEP))) + 1
    first = np.concatenate([[0], np.cumsum(halves)])
    out = np.full(int(first[-1]) * HALF * STEP + WIDTH, PAD, np.int16)
    at = np.repeat(first[:-1] * HALF * STEP - offsets[:-1], n) + np.arange(len(raw))
    out[at] = raw
    return out, first


@dataclass
class Network:
    embed: np.ndarray  # 257 x EMBED
    filters: np.ndarray  # WIDTH * EMBED x FILTERS
    bias: np.ndarray
    out: np.ndarray  # 3 * FILTERS + 1
    out_bias: float

    def _responses(self, data: np.ndarray, halves: int) -> tuple[np.ndarray, np.ndarray]:
        """(inputs of the filters, responses) at every position."""
        e = self.embed[data]
        x = np.lib.stride_tricks.as_strided(e, (halves * HALF, WIDTH * EMBED), (STEP * EMBED * e.itemsize, e.itemsize))
        return x, x @ self.filters + self.bias

    def _pool(self, chunk: np.ndarray, first: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(documents, 3 * FILTERS + 1): mean, max and min of each document's chunks; how much a short text leaves empty of one."""
        at = first[:-1] - 2 * np.arange(len(first) - 1)  # a document has two chunks less than halves
        count = np.diff(first)[:, None] - 2
        empty = EMPTY * np.maximum(0, 1 - np.diff(offsets) / (2 * HALF * STEP)).astype(np.float32)
        return np.concatenate([np.add.reduceat(chunk, at) / count, np.maximum.reduceat(chunk, at),
                               np.minimum.reduceat(chunk, at), empty[:, None]], axis=1)

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if len(offsets) < 2:
            return np.zeros(0)
        data, first = _layout(raw, offsets)
        halves = int(first[-1])
        best = np.empty((halves, FILTERS), np.float32)
        for a in range(0, halves, 512):  # bounded memory for long documents
            b = min(a + 512, halves)
            _, r = self._responses(data[a * HALF * STEP:b * HALF * STEP + WIDTH], b - a)
            best[a:b] = r.reshape(b - a, HALF, FILTERS).max(axis=1)
        chunk = np.maximum(np.maximum(best[:-1], best[1:]), 0)
        keep = np.ones(halves, bool)
        keep[first[1:] - 1] = keep[first[1:] - 2] = False  # chunks with a guard
        z = self._pool(chunk[keep[:-1]], first, offsets) @ self.out + self.out_bias
        return 1 / (1 + np.exp(-np.clip(z.astype(float), -30, 30)))

    def gradients(self, raw: np.ndarray, offsets: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Loss and its gradients for one batch."""
        data, first = _layout(raw, offsets)
        halves, docs = int(first[-1]), len(offsets) - 1
        x, r = self._responses(data, halves)
        r = r.reshape(halves, HALF, FILTERS)
        arg = r.argmax(axis=1)
        best = np.take_along_axis(r, arg[:, None, :], 1)[:, 0]
        keep = np.ones(halves, bool)
        keep[first[1:] - 1] = keep[first[1:] - 2] = False
        left = np.flatnonzero(keep)
        later = best[left + 1] > best[left]
        chunk = np.where(later, best[left + 1], best[left])
        live = chunk > 0
        chunk = np.maximum(chunk, 0)
        pooled = self._pool(chunk, first, offsets)
        z = pooled @ self.out + self.out_bias
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        loss = float(-(weight * (y * np.log(p + 1e-9) + (1 - y) * np.log(1 - p + 1e-9))).sum())
        dz = (weight * (p - y)).astype(np.float32)
        d_out, d_out_bias = pooled.T @ dz, dz.sum()
        back = dz[:, None] * self.out[None]
        at = first[:-1] - 2 * np.arange(docs)
        doc = np.repeat(np.arange(docs), np.diff(first) - 2)
        d_chunk = back[doc, :FILTERS] / (np.diff(first)[doc, None] - 2)
        for part, extreme in ((1, pooled[:, FILTERS:2 * FILTERS]), (2, pooled[:, 2 * FILTERS:3 * FILTERS])):
            hit = chunk == extreme[doc]
            hit = hit / np.add.reduceat(hit, at)[doc]
            d_chunk = d_chunk + back[doc, part * FILTERS:(part + 1) * FILTERS] * hit
        d_chunk = np.where(live, d_chunk, 0)
        d_best = np.zeros((halves, FILTERS), np.float32)
        np.add.at(d_best, left, np.where(later, 0, d_chunk))
        np.add.at(d_best, left + 1, np.where(later, d_chunk, 0))
        # only the position of each half's greatest response carries a gradient
        h, f = np.nonzero(d_best)
        pos, g = h * HALF + arg[h, f], d_best[h, f]
        order = np.argsort(f, kind="stable")
        pos, f, g = pos[order], f[order], g[order]
        rows = x[pos] * g[:, None]
        cut = np.searchsorted(f, np.arange(FILTERS))
        d_filters = np.zeros_like(self.filters)
        d_bias = np.bincount(f, g, FILTERS).astype(np.float32)
        ends = np.append(cut[1:], len(f))
        for k in range(FILTERS):
            if ends[k] > cut[k]:
                d_filters[:, k] = rows[cut[k]:ends[k]].sum(axis=0)
        seen = data[(pos[:, None] * STEP + np.arange(WIDTH)).reshape(-1)]
        to = (self.filters.T[f] * g[:, None]).reshape(-1, EMBED)
        d_embed = np.stack([np.bincount(seen, to[:, j], PAD + 1) for j in range(EMBED)], axis=1).astype(np.float32)
        return loss, [d_embed, d_filters, d_bias, d_out, np.array([d_out_bias], np.float32)]


def _steps(order: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Runs of at most BATCH documents and about STEP_BYTES bytes."""
    out, run, size = [], [], 0
    for i in order.tolist():
        if run and (len(run) == BATCH or size + sizes[i] > STEP_BYTES):
            out.append(np.array(run))
            run, size = [], 0
        run.append(i)
        size += sizes[i]
    return [*out, np.array(run)]


def train(texts: list[str], y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Fit the network; without both classes its score is 0.5 for every text."""
    rng = np.random.default_rng(seed)
    p = [rng.normal(0, 0.5, (PAD + 1, EMBED)), rng.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)),
         np.zeros(FILTERS), rng.normal(0, 0.1, 3 * FILTERS + 1), np.zeros(1)]
    p = [a.astype(np.float32) for a in p]
    y = np.asarray(y, np.float32)
    if not len(y) or y.min() == y.max():
        return Network(p[0], p[1], p[2], np.zeros(3 * FILTERS + 1, np.float32), 0.0)
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum())).astype(np.float32) * len(y)
    docs = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    # documents of like length share a step: batches of equal bytes, visited in random order
    order = np.argsort([len(d) for d in docs], kind="stable")
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    sizes, total = np.array([len(d) for d in docs]), 0
    for _ in range(epochs):
        mixed = order[np.argsort(np.arange(len(order)) // (BATCH * 8) * 1.0 + rng.random(len(order)), kind="stable")]
        steps = _steps(mixed, sizes)
        total = total or epochs * len(steps)
        for k in rng.permutation(len(steps)):
            take = steps[k]
            net = Network(p[0], p[1], p[2], p[3], p[4][0])
            raw = np.concatenate([docs[i] for i in take])
            offsets = np.concatenate([[0], np.cumsum([len(docs[i]) for i in take])])
            _, grads = net.gradients(raw, offsets, y[take], share[take] / len(take))
            t += 1
            rate = RATE * max(0.1, 1 - 0.9 * t / total)
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] = (p[i] - rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-7)).astype(np.float32)
    return Network(p[0], p[1], p[2], p[3], float(p[4][0]))


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality") -> Network:
    """Train on the bounded sample of ``training_sample``; labels of held-out ids are never read."""
    sample = training_sample(df, labels, label, id_col, text, ROWS)
    return train(sample.text.tolist(), sample.y.to_numpy())


def score_column(model: Network, text, spark):
    """Column of scores of whole texts (null: empty)."""
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            runs = [shared.value.scores(*buffers(s)) for s in slices(pa.array(batch, pa.string()))]
            yield pd.Series(np.concatenate(runs) if runs else np.zeros(0))

    return score(text_of(text))


def quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
            threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row.

    Null and empty texts are scored as one chunk of padding; repeated rows are scored each; a null id is not held out;
    other columns are ignored; an empty table gives none; labels without both classes give score 0.5 to every text.
    """
    model = fit(df, labels, id_col, text, label)
    t = df.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    t = t.withColumn("score", score_column(model, "text", df.sparkSession))
    return t.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` with a score of the threshold or more, with all their columns."""
    model = fit(df, labels, id_col, text, label)
    name, = fresh(df, "score")
    scored = df.withColumn(name, score_column(model, df[text], df.sparkSession))
    return scored.filter(F.col(name) >= threshold).select(*[F.col(f"`{c}`") for c in df.columns])
