"""Classifiers: scores against plain re-computation, accuracy on held-out labels, defined results for odd rows."""
import math
from collections import Counter
import zlib

import numpy as np
import pytest

from marketlens.llm import quality_cnn, toxicity_nb
from edge_rows import edges, nothing  # noqa: F401

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def outcome(frame, labels, label):
    """(true positives, false positives, false negatives, true negatives) on held-out rows."""
    got = frame.join(labels, "doc_id").filter("held_out").select("predicted", label).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in frame.limit(500).collect())
    return [sum(r[0] == p and r[1] == y for r in got) for p, y in ((1, 1), (1, 0), (0, 1), (0, 0))]


def test_toxicity_on_held_out_labels(tables):
    tp, fp, fn, tn = outcome(toxicity_nb.toxicity(*tables), tables[1], "toxic")
    assert tp / (tp + fn) > 0.85 and fp / (fp + tn) < 0.005, (tp, fp, fn, tn)


def test_toxicity_scores_equal_plain_sums(spark):
    texts = ["You are an idiot", "a fine day, really", "", "idiot idiot IDIOT!", "the day was fine", "x" * 40, "ß漢字 idiots of the day"] * 6
    y = np.array([1, 0, 0, 1, 0, 0, 1] * 6)
    m = toxicity_nb.train(spark.createDataFrame(list(zip(texts, y.tolist())), "text string, y int").repartition(3))
    weight = dict(zip(m.hashes.tolist(), m.weights.tolist()))
    assert weight

    def plain(text):
        words = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text.lower()).split()
        padded = " " + "".join(w + " " for w in words)
        seen = set()
        for n in m.sizes:
            for i in range(len(padded) - n + 1):
                h = 0
                for k, c in enumerate(padded[i:i + n]):
                    h = ord(c) if k == 0 else (h * 0xD6E8FEB86659FD93 + ord(c)) % 2 ** 64
                h = (h + n) * 0x9E3779B97F4A7C15 % 2 ** 64
                seen.add(h ^ (h >> 29))
        return 1 / (1 + math.exp(-m.bias - sum(weight.get(h, 0) for h in seen)))
    assert np.allclose(m.scores(texts), [plain(t) for t in texts])
    assert ((m.scores(texts) >= 0.5) == y).all()


def test_every_ngram_that_qualifies_is_a_feature(spark, tables):
    rows = toxicity_nb.training_rows(*tables, "toxic", rows=300).collect()
    n, toxic, y = Counter(), Counter(), {1: 0, 0: 0}
    for r in rows:
        y[r.y] += 1
        seen = set()
        for _, h in toxicity_nb._every([r.text], toxicity_nb.SIZES):
            seen |= set(h.tolist())
        n.update(seen)
        if r.y:
            toxic.update(seen)
    ratio = {h: math.log((toxic[h] + 0.5) / (y[1] + 1)) - math.log((c - toxic[h] + 0.5) / (y[0] + 1)) for h, c in n.items() if c >= toxicity_nb.MIN_DOCS}
    m = toxicity_nb.train(spark.createDataFrame(rows))
    assert set(m.hashes.tolist()) == {h for h, r in ratio.items() if r >= toxicity_nb.MIN_RATIO} and len(m.hashes) > 500


def test_toxicity_edge_rows(spark, edges, nothing, tables):
    labels = tables[1]
    got = toxicity_nb.toxicity(edges, labels.limit(0)).collect()
    assert len(got) == edges.count() and all(r.score < 1e-9 and r.predicted == 0 for r in got)
    kept = toxicity_nb.drop_toxic(edges, labels)
    assert kept.columns == edges.columns and kept.count() == edges.count()
    assert toxicity_nb.toxicity(nothing, labels).count() == 0
    odd = spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 7, 7)], "doc_id long, quality int, toxic int")
    assert toxicity_nb.toxicity(edges, odd).count() == edges.count()


def test_quality_on_held_out_labels(tables):
    tp, fp, fn, tn = outcome(quality_cnn.quality(*tables), tables[1], "quality")
    assert tp / (tp + fn) > 0.97 and tn / (fp + tn) > 0.85, (tp, fp, fn, tn)


def _plain_score(net, text):
    """The network on one text, position by position."""
    q, data = quality_cnn, list(text.encode())
    halves = max(2, -(-len(data) // (q.HALF * q.STEP)))
    data = data + [q.PAD] * (halves * q.HALF * q.STEP - len(data)) + [q.PAD] * q.WIDTH
    best = []
    for h in range(halves):
        r = [net.embed[data[p * q.STEP:p * q.STEP + q.WIDTH]].reshape(-1) @ net.filters + net.bias
             for p in range(h * q.HALF, (h + 1) * q.HALF)]
        best.append(np.maximum(np.max(r, axis=0), 0))
    chunks = [np.maximum(a, b) for a, b in zip(best, best[1:])]
    empty = q.EMPTY * max(0, 1 - len(text.encode()) / (2 * q.HALF * q.STEP))
    z = np.concatenate([np.mean(chunks, axis=0), np.max(chunks, axis=0), np.min(chunks, axis=0), [empty]]) @ net.out + net.out_bias
    return 1 / (1 + math.exp(-z))


def test_quality_scores_equal_a_plain_network():
    rng = np.random.default_rng(0)
    texts = ["", "a", "short é text", "x" * 128, "y" * 129, "z" * 256, "some words " * 90, "é" * 700]
    net = quality_cnn.train(texts, np.array([0, 1] * 4), epochs=3)
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    got = net.scores(raw, offsets)
    alone = [net.scores(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0] for t in texts]
    assert np.allclose(alone, [_plain_score(net, t) for t in texts], atol=1e-5)
    assert np.allclose(got, alone, atol=1e-5)
    y, w = rng.integers(0, 2, len(texts)).astype(np.float32), np.ones(len(texts), np.float32)
    _, grads = net.gradients(raw, offsets, y, w)
    for name, g in zip(("embed", "filters", "bias", "out"), grads):
        a = getattr(net, name)
        at = np.unravel_index(np.abs(g).argmax(), a.shape)
        was, sides = a[at], []
        for step in (1e-3, -1e-3):
            a[at] = was + step
            sides.append(net.gradients(raw, offsets, y, w)[0])
        a[at] = was
        assert abs((sides[0] - sides[1]) / 2e-3 - g[at]) < 0.02 * abs(g[at]) + 1e-3


def test_quality_edge_rows(spark, edges, nothing, tables):
    got = quality_cnn.quality(edges, tables[1].limit(0)).collect()
    assert len(got) == edges.count() and all(r.score == 0.5 and r.predicted == 1 for r in got)
    assert quality_cnn.quality(nothing, tables[1]).count() == 0
    kept = quality_cnn.keep_good(edges, tables[1].limit(0))
    assert kept.columns == edges.columns and kept.count() == edges.count()
