"""Ranked search against a plain scoring of every document for every item."""
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from marketlens.llm import ranked_search as S
from edge_rows import edges, nothing  # noqa: F401

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    big_n, total, df = len(bags), sum(n for _, _, n in bags), Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        want, got = Counter(terms(text)), []
        for i, b, n in bags:
            m = 25 + (75 * n * big_n) // total
            score = sum(times * math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * b[t]) // (1000 * b[t] + 8 * m))
                        for t, times in want.items() if t in b)
            if score > 0:
                got.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(got)[:k], 1)]
    return sorted(out, key=repr)


def check(spark, docs, items, **more):
    df = spark.createDataFrame([(i, t, b"h", 1, "i", 2) for i, t in docs], "doc_id long, text string, h binary, m long, item string, rank int")
    it = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, row int")
    got = [tuple(r) for r in S.ranked(df, it, **more).collect()]
    assert sorted(got, key=repr) == brute(docs, items)


def made(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


def test_ranks_equal_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["Ünï", "漢字", "A1b", "x-y", "é", "É", "the", "THE"]
    copies = [made(rng, 30, words) for _ in range(12)]
    docs = [(i, made(rng, rng.randint(0, 60), words)) for i in range(250)] + [(1000 - i, rng.choice(copies)) for i in range(400)]
    docs += [(7, "w1 w1"), (7, "w1 w1"), (None, copies[0]), (None, None), (8, ""), (9, " .,; "), (10, "w2 " * 60_000), (11, "\x00w3\x7fw3\x80")]
    items = [(i, made(rng, rng.randint(1, 25), words)) for i in range(15)] + [(20, copies[0]), (20, copies[1]), (21, None), (22, "..."), (23, "absent"), (None, "w4 W4"), (24, "w5 w5 w5")]
    check(spark, docs, items)
    check(spark, docs, items, shard_bytes=300)  # many shards


def test_edge_rows(spark, edges, nothing):
    items = spark.createDataFrame([(1, "same words, HERE"), (2, "é 漢字"), (3, "word")], "item_id long, text string")
    got = sorted((tuple(r) for r in S.ranked(edges, items).collect()), key=repr)
    assert got == brute([(r.doc_id, r.text) for r in edges.collect()], [(1, "same words, HERE"), (2, "é 漢字"), (3, "word")])
    assert S.ranked(nothing, items).count() == 0
    assert S.ranked(edges, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(S, "word_hashes", lambda raw, starts, ends: (ends - starts).astype(np.uint64))  # every pair of one length collides
    texts = ["aa bb cc", "bb bb dd", "abc xyz", ""]
    shard = S.Shard.of([0, 1], ["aa cc abc", "bb zz"])
    n, found = S.bags(pa.array(texts), shard.vocabulary)
    names = [shard.vocabulary.raw[a:b].tobytes().decode() for a, b in zip(shard.vocabulary.at, shard.vocabulary.at[1:])]
    row, term, tf = S._flat(pa.array(found, pa.binary()))
    got = {(int(r), names[t], int(x)) for r, t, x in zip(row, term, tf)}
    assert n.tolist() == [3, 3, 2, 0] and got == {(0, "aa", 1), (0, "bb", 1), (0, "cc", 1), (1, "bb", 2), (2, "abc", 1)}


def test_scores_beyond_single_floats_are_exact():
    shard = S.Shard.of([0], ["a " * 3])
    big = np.array([1 << 50], np.int64)
    row, item, score = shard.scores(np.array([0]), np.array([0]), np.array([3]), big, 1)
    assert (row.tolist(), item.tolist(), score.tolist()) == ([0], [0], [9 << 50])
