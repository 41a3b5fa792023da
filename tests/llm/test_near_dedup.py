"""Near duplicates against a comparison of all pairs."""
import random
from collections import Counter

import numpy as np

from marketlens.llm import common, near_dedup as operator
from marketlens.llm.bagminhash import overlap, shingle_sets, signatures
from marketlens.llm.components import components
from marketlens.llm.near_dedup import near_classes, near_dedup
from edge_rows import edges, nothing  # noqa: F401

SF = "/root/testdata/sf0.001"


def bag(text):
    w = (text or "").encode().split()
    if not w:
        return Counter()
    return Counter([tuple(w[i:i + 5]) for i in range(len(w) - 4)] or [tuple(w)])


def jaccard(a, b):
    both = sum((a & b).values())
    return both / max(1, sum((a | b).values()))


def brute(rows):
    """doc_id -> least doc_id of its class."""
    ids, bags = [r[0] for r in rows], [bag(r[1]) for r in rows]
    top = {i: i for i in ids}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or jaccard(bags[i], bags[j]) >= 0.8:
                a, b = find(ids[i]), find(ids[j])
                top[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_classes_equal_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r.class_id for r in near_classes(docs).collect()}
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_chain_of_edits_with_hidden_links(spark):
    """Copies of one base at falling similarity, and copies of copies that are near only each other."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(150)]
    rows = []
    for i in range(60):
        words = list(rows[rng.randrange(len(rows))][1].split()) if rows and i % 3 == 0 else list(base)
        for _ in range(rng.randrange(8)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.class_id for r in near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_lists_beyond_a_broadcast_and_cells_of_few_bytes(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_KEYS", 0)
    monkeypatch.setattr(operator, "CELL_BYTES", 4000)
    rng = random.Random(8)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(120)]
    rows = [(i, " ".join(base[:60] + [f"e{rng.randrange(3)}" if rng.random() < 0.05 else w for w in base[60:]])) for i in range(40)]
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    got = {r.doc_id: r.class_id for r in near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows) and spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before


def test_similarity_of_sorted_lists_equals_overlap():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a, b = (np.sort(rng.integers(0, 12, rng.integers(0, 15)).astype(np.uint64)) for _ in range(2))
        (h, w), (h2, w2) = (np.unique(x, return_counts=True) for x in (a, b))
        assert abs(operator._similar(h, w, 0, len(h), h2, w2, 0, len(h2)) - overlap(a, b)) < 1e-12


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(3)
    common = [f"c{i}" for i in rng.integers(0, 40, 300)]
    a, b = " ".join(common + ["x", "y", "x", "y", "x", "z"] * 12), " ".join(common + ["x", "y"] * 10)
    both = []
    for k in (1, 2, 5):
        raws = [np.frombuffer(t.encode(), np.uint8) for t in (a, b)]
        sets = [shingle_sets(r, np.array([0, len(r)]), k) for r in raws]
        sig = [signatures(h, w, f, 2000)[0] for h, w, f in sets]
        exact = overlap(*[np.repeat(h, w) for h, w, _ in sets])
        both.append((float(np.mean(sig[0] == sig[1])), exact))
    assert all(abs(x - y) < 0.05 for x, y in both), both
    assert max(w.max() for _, w, _ in sets) > 1


def test_overlap_counts_multiplicity():
    a, b = np.array([1, 1, 1, 2, 3], np.uint64), np.array([1, 1, 2, 4], np.uint64)
    assert overlap(a, b) == 3 / 6


def test_edge_rows(spark, edges, nothing):
    rows = near_classes(edges).collect()
    got = {r.doc_id: (r.class_id, r.class_size) for r in rows if r.doc_id is not None}
    assert len(rows) == edges.count()
    assert got[1] == got[2] == (1, 2) and got[3] == got[4] == (3, 3) and got[6] == (6, 1) and got[5] == (5, 1)
    assert all(r.class_id is None for r in rows if r.doc_id is None)
    kept = near_dedup(edges)
    assert kept.columns == edges.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 3, 5, 6, 7]
    assert near_classes(nothing).count() == 0 and near_dedup(nothing).count() == 0


def test_components_of_a_path_and_a_star(spark):
    e = [(i + 1, i) for i in range(40)] + [(1000, i) for i in range(1001, 1100)] + [(7, 7), (1, 0)]
    got = {r.node: r["class"] for r in components(spark.createDataFrame(e, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 1000 for i in range(1000, 1100))
