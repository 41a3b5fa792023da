"""Decontamination against an exhaustive BM25 score of every passage and item."""
import math
import random
import string
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from marketlens.llm.decontam_wand import K1, MIN_WORDS, B, contaminated, decontaminate, indexes
from edge_rows import edges, nothing  # noqa: F401

SF = "/root/testdata/sf0.001"


def plain(text):
    return (text or "").lower().translate(str.maketrans(string.punctuation, " " * len(string.punctuation))).encode().split()


def brute(docs, items, threshold=0.6, need=0.5):
    terms = {i: plain(t) for i, t in items}
    terms = {i: w for i, w in terms.items() if len(w) >= MIN_WORDS}
    df = Counter(t for w in terms.values() for t in set(w))
    n, mean = len(terms), sum(map(len, terms.values())) / len(terms)
    stride = max(map(len, terms.values()))
    weight = {}
    for i, w in terms.items():
        weight[i] = {t: math.log1p((n - df[t] + .5) / (df[t] + .5)) * f * (K1 + 1) / (f + K1 * (1 - B + B * len(w) / mean))
                     for t, f in Counter(w).items()}
    out = {}
    for d, text in docs:
        w = plain(text)
        for p in range(max(1, -(-len(w) // stride) - 1)):
            part = w[p * stride:(p + 2) * stride]
            have, seen = set(part), {tuple(part[k:k + 3]) for k in range(len(part) - 2)}
            for i, x in weight.items():
                s = sum(v for t, v in x.items() if t in have) / sum(x.values())
                if s >= threshold:
                    cut = len(terms[i]) - max(3, len(terms[i]) // 4)
                    share = []
                    for h in (terms[i][:cut], terms[i][cut:]):
                        g = [tuple(h[k:k + 3]) for k in range(len(h) - 2)]
                        share.append(sum(q in seen for q in g) / len(g))
                    if min(share) >= need:
                        out[d, i] = max(out.get((d, i), 0), s)
    return out


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")


def pairs(frame):
    return [(r[0], r[1]) for r in frame.collect()]


@pytest.mark.parametrize("score", [0.6, 0.25])
def test_whole_table(spark, tables, score):
    docs, bench = tables
    items = pairs(bench)
    rows = pairs(docs)
    rng = random.Random(1)
    for k, (i, t) in enumerate(items):  # items inside other text: edited, upper case, cut
        w = t.split()
        for _ in range(len(w) // 12):
            w[rng.randrange(len(w))] = "changed"
        rows.append((9000 + k, rows[k][1][:300] + " " + (" ".join(w).upper() if k % 2 else " ".join(w[:len(w) // 2])) + " " + rows[k + 1][1]))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, items, score)
    got = {(r.doc_id, r.item_id): r.score for r in contaminated(frame, bench, score=score).collect()}
    assert len(want) > 15 and set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    left = {r.doc_id for r in decontaminate(frame, bench, score=score).collect()}
    assert left == {i for i, _ in rows} - {d for d, _ in want}


def test_shards_find_the_same(spark, tables, monkeypatch):
    docs, bench = tables
    one = sorted(map(tuple, contaminated(docs, bench).collect()))
    import marketlens.llm.decontam_wand as m
    monkeypatch.setattr(m, "SHARD_BYTES", 2000)
    assert len(list(indexes(bench))) > 2
    # passages follow each shard's longest item, so their starts may differ
    assert [r[:2] for r in sorted(map(tuple, contaminated(docs, bench).collect()))] == [r[:2] for r in one]


def test_edge_rows(spark, edges, nothing, tables):
    _, bench = tables
    assert contaminated(edges, bench).count() == 0
    kept = decontaminate(edges, bench)
    assert kept.columns == edges.columns and kept.count() == edges.count()
    assert contaminated(nothing, bench).count() == 0
    assert contaminated(edges, bench.limit(0)).count() == 0 and decontaminate(edges, bench.limit(0)).count() == edges.count()
    odd = spark.createDataFrame([(1, None), (None, "a b c d e f g h i"), (2, ""), (3, "short one")], "item_id long, text string")
    leaked = spark.createDataFrame([(5, "x A b, c d e! f g h i y"), (None, "a b c d e f g h i")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.item_id) for r in contaminated(leaked, odd).collect()) == [(0, None), (5, None)]


def test_repeated_items_are_one_item(spark):
    item = "which river flows through the old town and where does it meet the sea"
    other = [(f"o{k}", f"another question number {k} about things that nobody ever wrote in any text {k}") for k in range(5)]
    docs = spark.createDataFrame([(1, "before " + item + " after"), (2, "nothing of the kind is said here at all")], "doc_id long, text string")
    want = None
    for rows in ([("a", item)], [("a", item)] * 2, [("a", item)] * 3, [("a", item), ("a", item.title() + "?")], [(None, item)] * 3):
        bench = spark.createDataFrame(rows + other, "item_id string, text string")
        got = [(r.doc_id, r.item_id, r.score) for r in contaminated(docs, bench).collect()]
        assert got == [(1, rows[0][0], got[0][2])]
        want = want or got[0][2]
        assert abs(got[0][2] - want) < 1e-9
        assert [r.doc_id for r in decontaminate(docs, bench).collect()] == [2]


def test_short_items_are_found_whole(spark):
    bench = [("five", "Who wrote the first opera?"), ("again", "who wrote the first opera"), ("one", "Zanzibar"), ("none", "?!"), ("long", "a b c d e f g h i")]
    docs = [(1, "asked: who wrote, the FIRST opera? nobody"), (2, "who wrote the very first opera"), (3, "to zanzibar and zanzibar"),
            (4, "who wrote the first"), (5, "opera who wrote the first"), (6, ""), (7, "A b c d e f g h i who wrote the first opera")]
    docs = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    for items in (bench, bench[:4], bench + bench):
        items = spark.createDataFrame(items, "item_id string, text string")
        got = sorted((r.doc_id, r.item_id, r.passage_start) for r in contaminated(docs, items).collect() if r.item_id != "long")
        assert got == [(1, "again", 1), (1, "five", 1), (3, "one", 1), (7, "again", 9), (7, "five", 9)]
        assert sorted(r.doc_id for r in decontaminate(docs, items).collect()) == [2, 4, 5, 6]
    pairs_of = spark.createDataFrame([("q", "Capital of France?", "Paris")], "item_id string, text string, answer string")
    texts = spark.createDataFrame([(1, "the capital of france Paris is old"), (2, "capital of france is lyon")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in contaminated(texts, pairs_of, answer="answer").collect()] == [(1, "q")]


def test_scripts_without_spaces(spark):
    rng = random.Random(3)

    def run(first, last, n):
        return "".join(chr(rng.randrange(first, last)) for _ in range(n))
    items = [("han", run(0x4E00, 0x9FA0, 200)), ("kana", run(0x3041, 0x3097, 90) + "。" + run(0x30A1, 0x30FB, 60)), ("thai", run(0x0E01, 0x0E2F, 150)),
             ("rare", run(0x20000, 0x2A6D0, 60)), ("few", "\u6f22\u5b57\u304b")]
    docs = [(k, f"{run(0x4E00, 0x9FA0, 120)}{t}{run(0x0E01, 0x0E2F, 90)} plain\u00e9words after") for k, (_, t) in enumerate(items)]
    docs += [(10, items[0][1][:60] + run(0x4E00, 0x9FA0, 500)), (11, "\u6f22\u5b57 \U0001f600 abc"), (12, run(0x0E01, 0x0E2F, 400))]
    got = contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string"))
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(k, i) for k, (i, _) in enumerate(items)]


def test_words_of_mixed_texts():
    import pyarrow as pa
    from marketlens.llm.decontam_wand import terms
    texts = ["ab\u6f22\u5b57cd \u00e9\u6f22", "\u6f22", "", "\U00020000x\U0001f600", "x"]
    want = [["ab", "\u6f22", "\u5b57", "cd", "\u00e9", "\u6f22"], ["\u6f22"], [], ["\U00020000", "x\U0001f600"], ["x"]]
    h, first = terms(pa.array(texts))
    one = {w: int(terms(pa.array([w]))[0][0]) for x in want for w in x}
    assert [h[a:b].tolist() for a, b in zip(first, first[1:])] == [[one[w] for w in x] for x in want] and len(set(one.values())) == len(one)


def _zipf_items(n, words, rng):
    """Items of 15 to 44 words drawn by Zipf's law, as rows of ``_weights``."""
    out, df = [], {}
    for i in range(n):
        w = np.minimum(rng.zipf(1.3, rng.integers(15, 45)), words).astype(np.int64) * 7919
        t, tf = np.unique(w, return_counts=True)
        out.append((f"{i:06d}", w.tolist(), len(w) - 4, t.tolist(), tf.tolist()))
        for x in t.tolist():
            df[x] = df.get(x, 0) + 1
    frame = pd.DataFrame(out, columns=["item", "words", "split", "terms", "tfs"])
    return frame.assign(dfs=[[df[x] for x in t] for t in frame.terms])


def test_candidates_are_the_blocks_whose_bound_reaches_the_threshold(monkeypatch):
    import marketlens.llm.decontam_wand as m
    monkeypatch.setattr(m, "EXPANDED", 500)  # many runs
    rng = np.random.default_rng(0)
    frame = _zipf_items(200, 3000, rng)
    index = m._weights(frame, 200, 30.0)
    dense = np.zeros((len(index.vocab), index.n_blocks))
    dense[np.repeat(np.arange(len(index.vocab)), np.diff(index.block_at)), index.block] = index.block_impact
    passage, term = [], []
    for p in range(60):  # some passages hold a whole item and more
        some = rng.integers(0, len(index.vocab), rng.integers(1, 40))
        if p % 2:
            own = np.searchsorted(index.vocab, np.unique(np.array(frame.words[p], np.int64).view(np.uint64)))
            some = np.concatenate([some, own])
        some = np.unique(some)
        passage += [p] * len(some)
        term += some.tolist()
    passage, term = np.array(passage), np.array(term)
    got = set(zip(*(x.tolist() for x in index.candidates(passage, term, 0.6))))
    want = {(p, b) for p in range(60) for b in np.flatnonzero(dense[term[passage == p]].sum(axis=0) >= 0.6 - m.SLACK).tolist()}
    assert got == want and len(want) >= 30


def test_a_full_shard_is_small():
    import pickle

    import marketlens.llm.decontam_wand as m
    rng = np.random.default_rng(1)
    index = m._weights(_zipf_items(4400, 60_000, rng), 4400, 30.0)  # about SHARD_BYTES at 16 bytes a word
    assert len(pickle.dumps(index)) < 20 << 20 and index.n_blocks * len(index.vocab) * 4 > 4 * len(pickle.dumps(index))
