"""The pipeline against brute force, stage by stage; packing by an exact round trip."""
import zlib
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from marketlens.llm import toxicity_nb
from marketlens.llm import common
from marketlens.llm.exact_dedup import exact_dedup, exact_groups
from marketlens.llm.packing_kk import CAPACITY, karmarkar_karp, pack, pack_documents
from marketlens.llm.token_counts import PieceEncoder, token_counts, tokenizer_path
from test_decontam import brute as leaks
from test_near_dedup import brute as near
from edge_rows import edges, nothing  # noqa: F401

SF = "/root/testdata/sf0.001"


def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path())


def round_trip(rows, pieces):
    """Every id of every document in exactly one piece, sequences gapless and within capacity; returns the share of padding."""
    lib = library()
    want = Counter()
    for i, t in rows:
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want[(i, len(ids))] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    text = {i: t for i, t in rows}
    for i, got in by_doc.items():
        ids = np.array(lib.encode(text[i] or "", add_special_tokens=False).ids + [2], "<u4")
        copies = sum(n for (d, _), n in want.items() if d == i)
        spread = np.zeros(len(ids) + 1, int)
        for p in got:
            spread[p.start] += 1
            spread[p.start + p.length] -= 1
            assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[p.start:p.start + p.length].tobytes())
        assert (np.cumsum(spread)[:-1] == copies).all()
    assert set(by_doc) == set(text)
    padding = total = 0
    for got in by_sequence.values():
        at = 0
        for p in sorted(got, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= CAPACITY
        total += at
        padding += 0 if at & (at - 1) == 0 else CAPACITY - at
    return padding / total


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    model = toxicity_nb.fit(docs, labels)
    score = model.scores([t or "" for _, t in rows])
    rows = [r for r, s in zip(rows, score) if s < 0.7]
    last = {}
    for i, t in rows:
        last[t] = max(i, last.get(t, i))
    rows = [(i, t) for i, t in rows if last[t] == i]
    keep = near(rows)
    rows = [(i, t) for i, t in rows if keep[i] == i]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d for d, _ in leaks(rows, bench)}
    rows = [(i, t) for i, t in rows if i not in bad]
    assert bad and len(rows) < len(keep)
    padding = round_trip(rows, corpus_pipeline.run(spark, SF).collect())
    assert padding < 0.02


def test_stages_keep_the_columns(spark, edges):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).dtypes == docs.dtypes, name
        out = stage(spark, edges, SF)
        assert out.columns == edges.columns and out.count() > 0, name


def test_exact_dedup_meets_more_hashes_than_a_broadcast_by_a_shuffle(spark, edges, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(spark.read.parquet(f"{SF}/documents.parquet"))
    few = {name: f(docs).select("doc_id").collect() for name, f in (("groups", exact_groups), ("stay", exact_dedup))}
    odd = sorted(exact_dedup(edges).collect(), key=repr)
    monkeypatch.setattr(common, "BROADCAST_KEYS", 0)
    assert sorted(exact_groups(docs).select("doc_id").collect()) == sorted(few["groups"])
    assert sorted(exact_dedup(docs).select("doc_id").collect()) == sorted(few["stay"])
    assert sorted(exact_dedup(edges).collect(), key=repr) == odd


def test_exact_dedup(spark, edges, nothing):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    top, size = {}, Counter(t for _, t in rows)
    for i, t in rows:
        top[t] = max(i, top.get(t, i))
    got = {r.doc_id: r for r in exact_groups(docs).collect()}
    assert all(got[i].keep_id == top[t] and got[i].group_size == size[t] and got[i].kept == (top[t] == i) for i, t in rows)
    assert sorted(r.doc_id for r in exact_dedup(docs).collect()) == sorted(top.values())
    assert exact_groups(edges).count() == edges.count()
    kept = exact_dedup(edges)
    assert kept.columns == edges.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [2, 4, 5, 6, 7]
    assert exact_dedup(nothing).count() == 0 and exact_groups(nothing).count() == 0


def test_token_counts_equal_the_library(spark, edges, nothing):
    odd = ["", "a<|endoftext|>b", "<|startoftext|>", "it's we'll THEY'RE 'dx ''s", "x²³½ 12,345.67%", "é́ ΑΣΣ ς İstanbul ﬁne", "漢字かな交じり文",
           "\U0001f600\U0001f600 !!??", "a b c\x1cd\x85e", "long" * 3000, "\r\n\t x \x0b y", "'" * 50 + "s", "naïve œuvre ŻÓŁĆ", "<| x |>"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [r.text for r in docs.collect()] + odd
    lib = library()
    want = [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
    enc = PieceEncoder(tokenizer_path(), max_chars=5000)  # forgets often
    got = [ids.tolist() for t in texts for ids in enc.ids([t])]
    assert got == want and enc.counts(texts) == [len(w) for w in want]
    rows = {r.doc_id: r for r in token_counts(docs).collect()}
    assert all(rows[r.doc_id].n_tokens == len(w) and rows[r.doc_id].n_bytes == len(r.text.encode()) for r, w in zip(docs.collect(), want))
    assert token_counts(edges).count() == edges.count() and token_counts(nothing).count() == 0


def test_packing(spark, edges, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert round_trip([(r.doc_id, r.text) for r in docs.collect()], pack_documents(docs).collect()) < 0.01
    unique = edges.filter("doc_id IS NOT NULL")
    round_trip([(r.doc_id, r.text) for r in unique.collect()], pack_documents(unique).collect())
    assert pack_documents(nothing).count() == 0
    assert pack_documents(edges).filter("doc_id IS NULL").count() == 2


def test_differencing_levels_windows():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 2000, 300)
    at = karmarkar_karp(sizes, 40)
    sums = np.bincount(at, sizes, 40)
    assert sums.sum() == sizes.sum() and sums.max() - sums.min() < 600
    at, k = pack(np.array([3000, 3000, 3000, 1500]), 4096)
    assert k == 4 and np.bincount(at, [3000, 3000, 3000, 1500], 4).max() <= 4096  # the total needs 3, the pieces need 4
    at = karmarkar_karp(np.array([8, 7, 6, 5, 4]), 2)
    assert sorted(np.bincount(at, [8, 7, 6, 5, 4])) == [14, 16]  # two-way differencing leaves 2 here
