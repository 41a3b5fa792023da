"""Repeated passages against a comparison of all windows."""
import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from marketlens.llm import phrase_automata as pa
from marketlens.llm.hashing import grams, word_hashes, words
from marketlens.llm.phrase_automata import remove_repeats
from edge_rows import edges, nothing  # noqa: F401

SF = "/root/testdata/sf0.01"


def brute(rows, window=50):
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in docs:
        if i is None:
            continue
        for s in range(len(w) - window + 1):
            k = b" ".join(w[s:s + window])
            first[k] = min(first.get(k, i), i)
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if i is not None and first[b" ".join(w[s:s + window])] < i:
                gone[s:s + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def check(df, **options):
    got = remove_repeats(df, **options).drop("kept")
    assert sorted(map(tuple, got.collect()), key=repr) == brute([(r.doc_id, r.text) for r in df.collect()],
                                                              options.get("window", 50))


def test_whole_table(spark):
    check(spark.read.parquet(f"{SF}/documents.parquet"))


def test_overlaps_repeats_and_periodic_texts(spark):
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(400)]
    rows = []
    for i in range(60):
        a = rng.randrange(350)
        w = [f"x{rng.randrange(9999)}" for _ in range(rng.randrange(60))] + passage[a:a + rng.randrange(40, 140)]
        w += ["loop", "of", "words"] * rng.randrange(0, 40) + [f"y{rng.randrange(9999)}" for _ in range(rng.randrange(30))]
        rows.append((i * 3 % 61, rng.choice([" ", "\n", " \t "]).join(w)))
    rows += [(7, rows[0][1]), (200, rows[3][1]), (200, rows[3][1])]
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_edge_rows(spark, edges, nothing):
    check(edges)
    assert remove_repeats(nothing).count() == 0


def test_short_windows(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(40)))) for i in range(40)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), window=12, phrase=4)


def _least_phrase(rng) -> list[str]:
    """Four words whose hash is so small that they are the seed of every window that holds them."""
    w = [f"c{rng.randrange(10 ** 6)}" for _ in range(50_000)]
    raw = np.frombuffer(" ".join(w).encode(), np.uint8)
    starts, ends, _ = words(raw, np.array([0, len(raw)]))
    at = int(np.argmin(grams(word_hashes(raw, starts, ends), 4)))
    return w[at:at + 4]


def test_a_seed_of_many_passages_is_split(spark, monkeypatch):
    """One phrase stands in 120 different passages, each of them in several documents."""
    rng = random.Random(5)
    phrase = _least_phrase(rng)
    around = [([f"a{i}x{j}" for j in range(11)], [f"b{i}x{j}" for j in range(11)]) for i in range(120)]
    rows = []
    for i in range(400):
        a, b = around[i % 120] if i < 240 else rng.choice(around)
        cut = rng.randrange(4)
        rows.append((i, " ".join([f"u{i}x{j}" for j in range(rng.randrange(5))] + a[cut:] + phrase + b[:11 - cut])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(pa, "SHARD_PATTERNS", 10)
    monkeypatch.setattr(pa, "SALT_STRETCHES", 7)
    seen = []
    whole = pa._split_hot

    def split(found, window, size):
        before = found.filter("side = 0").groupBy("seed").count().agg(F.max("count")).first()[0]
        out = whole(found, window, size)
        seen.append((before, out.filter("side = 0").groupBy("seed", "part").count().agg(F.max("count")).first()[0]))
        return out

    monkeypatch.setattr(pa, "_split_hot", split)
    check(df, window=12, phrase=4)
    assert seen[0][0] > 100 and seen[0][1] < 10


def test_all_seeds_split(spark, monkeypatch):
    """Periodic texts and overlaps, every seed of more than one passage split."""
    monkeypatch.setattr(pa, "SHARD_PATTERNS", 1)
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(60)))) for i in range(60)] + [(90 + i, "a " * 40) for i in range(3)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), window=12, phrase=4)
