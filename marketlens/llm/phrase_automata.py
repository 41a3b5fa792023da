"""Operator 7: repeated passages removed with sharded Aho-Corasick automata.

A window is 50 consecutive words; its seed is the 8-word phrase of least hash inside it, so equal windows have
equal seeds wherever they stand, and about one phrase in 22 is a seed.

1. One Arrow pass over all texts emits each document's seeds. Seeds met in two or more documents are recurring;
   documents without one hold no repeated window and take no further part, and of equal texts only the
   least id does (the others repeat it wholly).
2. Windows with recurring seeds are confirmed by 128-bit hash: the least doc_id of each, combined map-side. A window met
   in two documents belongs to its least document, whose words around the seed are the source passage.
3. Source passages are compiled to Aho-Corasick automata, sharded by seed, and the other documents' stretches with
   the same seeds stream through their shard's automaton. Where a phrase is found, the windows around it are
   compared with the shard's source windows word for word. A shard that many documents share is salted: its patterns are repeated for
   each salt, its stretches dealt out by document. A phrase that is the seed of more source passages than a shard takes is split:
   its passages and stretches are cut into runs of one second seed (the least of the window's other phrases in another order), and
   each pair of seeds has a shard of its own. A task holds the patterns of one shard, never a group of documents.
4. Covered words are united for each document and removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import discard, few, ship, text_of, written
from marketlens.llm.hashing import buffers, grams, slices, word_hashes, words

WINDOW, PHRASE = 50, 8
#: Patterns of a shard, and stretches that one salt of a shard takes.
SHARD_PATTERNS, SALT_STRETCHES = 2_000, 5_000
#: Odd factor that puts phrase hashes in another order.
REORDER = np.uint64(0x9E3779B97F4A7C15)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _window_seeds(hashes: np.ndarray, window: int, phrase: int) -> np.ndarray:
    """Least phrase hash of the window that starts at each word (len - window + 1 of them)."""
    return _least(grams(hashes, phrase), window - phrase + 1)


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """Least of each n neighbours."""
    if len(x) < n:
        return np.zeros(0, np.uint64)
    span = 1
    while span * 2 <= n:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    if span < n:
        x = np.minimum(x[:span - n], x[n - span:])
    return x


def _scanner(window: int, phrase: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1)):
                raw, offsets = buffers(texts)
                starts, ends, first = words(raw, offsets)
                seeds = _window_seeds(word_hashes(raw, starts, ends), window, phrase)
                n = np.diff(first)
                # windows inside one document; a seed is listed where it changes
                inside = np.zeros(len(seeds) + 1, np.int64)
                has = n >= window
                inside[first[:-1][has]] += 1
                np.subtract.at(inside, first[1:][has] - window + 1, 1)
                ok = np.cumsum(inside)[:-1] > 0
                new = ok.copy()
                new[1:] &= ~ok[:-1] | (seeds[1:] != seeds[:-1])
                new[first[:-1][has]] = True
                where = np.flatnonzero(new)
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(where, first), pa.int32()),
                                                 pa.array(seeds[where].view(np.int64), pa.int64()))
                data = raw.tobytes()
                docs = [data[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(texts)), pa.array([hashlib.md5(d).digest() for d in docs], pa.binary()),
                    pa.array(n, pa.int64()), pa.array([hashlib.sha256(b" ".join(d.split())).hexdigest() for d in docs]),
                    lists], names=["id", "h", "n_words", "sha", "seeds"])
                at += len(texts)

    return scan


def _document(text: str, window: int, phrase: int, seeds) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]:
    """(window hashes, window seeds, is the seed recurring, first window of each run of one seed, words)."""
    raw = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = words(raw, np.array([0, len(raw)]))
    hashes = word_hashes(raw, starts, ends)
    mine = _window_seeds(hashes, window, phrase)
    recurring = np.isin(mine, np.asarray(seeds, np.int64).view(np.uint64))
    return hashes, mine, recurring, raw, starts


def _windows(window: int, phrase: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, seeds in zip(*(batch.column(i).to_pylist() for i in range(3))):
                hashes, _, on, raw, starts = _document(text, window, phrase, seeds)
                if not on.any():
                    continue
                ends = words(raw, np.array([0, len(raw)]))[1]
                one = grams(hashes, window, 1)[on]
                two = grams(word_hashes(raw, starts, ends, 77), window, 2)[on]
                yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                                                  pa.array(np.full(len(one), doc, np.int64))], names=["w1", "w2", "id"])

    return emit


def _stretches(window: int, phrase: int):
    """Source passages (side 0) and stretches to search (side 1) of each document, one for each run of a recurring seed."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got: list[tuple] = []
            for doc, h, text, seeds, owned in zip(*(batch.column(i).to_pylist() for i in range(5))):
                hashes, mine, on, _, _ = _document(text, window, phrase, seeds)
                own = np.isin(grams(hashes, window, 1).view(np.int64), np.asarray(owned or [], np.int64)) & on
                parts = text.encode().split()
                edge = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]])) if len(mine) else np.zeros(0, int)
                for a, b in zip(edge.tolist(), np.append(edge[1:], len(mine)).tolist()):
                    if not on[a]:
                        continue
                    seed = int(mine[a:a + 1].view(np.int64)[0])
                    held = np.flatnonzero(own[a:b])
                    if len(held):
                        lo, hi = a + int(held[0]), a + int(held[-1]) + window
                        got.append((seed, 0, doc, h, lo, b" ".join(parts[lo:hi]).decode()))
                    if len(held) < b - a:
                        got.append((seed, 1, doc, h, a, b" ".join(parts[a:b + window - 1]).decode()))
            if got:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*got), (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.string()))],
                    names=["seed", "side", "id", "h", "lo", "stretch"])

    return emit


def _splitter(window: int, phrase: int):
    """Passages and stretches of one seed, cut into runs of windows with one second seed (part)."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got: list[tuple] = []
            for seed, side, doc, h, lo, text in zip(*(batch.column(i).to_pylist() for i in range(6))):
                raw = np.frombuffer(text.encode(), np.uint8)
                starts, ends, _ = words(raw, np.array([0, len(raw)]))
                x = grams(word_hashes(raw, starts, ends), phrase)
                other = np.where(x.view(np.int64) == seed, ~np.uint64(0), x * REORDER)
                second = _least(other, window - phrase + 1).view(np.int64)
                parts = text.encode().split()
                edge = np.flatnonzero(np.concatenate([[True], second[1:] != second[:-1]]))
                for a, b in zip(edge.tolist(), np.append(edge[1:], len(second)).tolist()):
                    got.append((seed, int(second[a]), side, doc, h, lo + a, b" ".join(parts[a:b + window - 1]).decode()))
            if got:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*got), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.string()))],
                    names=["seed", "part", "side", "id", "h", "lo", "stretch"])

    return split


def _split_hot(found: DataFrame, window: int, phrase: int) -> DataFrame:
    """``found`` (of ``written``), the rows of seeds with more than SHARD_PATTERNS source passages split; part is 0 in the others."""
    hot = found.filter("side = 0").groupBy("seed").agg(F.count("*").alias("n")).filter(F.col("n") > SHARD_PATTERNS)
    hot = written(hot.select("seed"), "hot")
    if hot.isEmpty():
        discard(hot)
        return found
    seeds = few(hot)
    seeds = hot if seeds is None else seeds
    parts = found.join(seeds, "seed", "left_semi").select("seed", "side", "id", "h", "lo", "stretch").mapInArrow(
        _splitter(window, phrase), "seed long, part long, side int, id long, h binary, lo long, stretch string")
    out = written(found.drop("part").join(seeds, "seed", "left_anti").withColumn("part", F.lit(0).cast("long")).unionByName(parts), "parts")
    discard(found, hot)
    return out


def _word_starts(text: str) -> list[int]:
    out, at = [0], text.find(" ")
    while at >= 0:
        out.append(at + 1)
        at = text.find(" ", at + 1)
    out.append(len(text) + 1)
    return out


class _Shard:
    """Automaton of the seed phrases of one shard's source passages, and the passages' windows."""

    def __init__(self, window: int, phrase: int):
        self.window, self.phrase = window, phrase
        self.sources: list[tuple[int, int, str]] = []
        self.automaton = None

    def _phrases(self, text: str, seed: int) -> set[str]:
        """The phrases of a stretch whose hash is the seed."""
        raw = np.frombuffer(text.encode(), np.uint8)
        starts, ends, _ = words(raw, np.array([0, len(raw)]))
        at = np.flatnonzero(grams(word_hashes(raw, starts, ends), self.phrase).view(np.int64) == seed)
        data = raw.tobytes()
        return {data[starts[i]:ends[i + self.phrase - 1]].decode() for i in at.tolist()}

    def compile(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.first: dict[str, int] = {}
        for seed, doc, text in self.sources:
            for p in self._phrases(text, seed):
                self.automaton.add_word(f" {p} ", True)
            at = _word_starts(text)
            for i in range(len(at) - self.window):
                w = text[at[i]:at[i + self.window] - 1]
                if self.first.get(w, doc) >= doc:
                    self.first[w] = doc
        if len(self.automaton):
            self.automaton.make_automaton()
        self.sources = []

    def covered(self, doc: int, text: str) -> list[tuple[int, int]]:
        """Word ranges (from, to) of the stretch that lie in windows of documents with a smaller id."""
        if not len(self.automaton):
            return []
        ends = [e for e, _ in self.automaton.iter(f" {text} ")]
        if not ends:
            return []
        at = _word_starts(text)
        n = len(at) - self.window  # windows
        last = np.searchsorted(np.array(at), np.array(ends) - 1, side="left") - 1  # last word of each phrase found
        test = np.zeros(n + 1, np.int64)
        np.add.at(test, np.clip(last - self.window + 1, 0, n), 1)
        np.subtract.at(test, np.clip(last - self.phrase + 2, 0, n), 1)
        out: list[tuple[int, int]] = []
        for i in np.flatnonzero(np.cumsum(test)[:n] > 0).tolist():
            if self.first.get(text[at[i]:at[i + self.window] - 1], doc) < doc:
                if out and i <= out[-1][1]:
                    out[-1] = (out[-1][0], i + self.window)
                else:
                    out.append((i, i + self.window))
        return out


def _search(window: int, phrase: int):
    """Rows sorted by (shard, salt, side): each shard's passages come before the stretches that stream through them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, shard = None, None
        for pdf in batches:
            got: list[tuple] = []
            for k, salt, seed, side, doc, h, lo, text in zip(*(pdf[c].tolist() for c in (
                    "shard", "salt", "seed", "side", "id", "h", "lo", "stretch"))):
                if (k, salt) != key:
                    key, shard = (k, salt), _Shard(window, phrase)
                if side == 0:
                    shard.sources.append((seed, doc, text))
                    continue
                if shard.automaton is None:
                    shard.compile()
                got += [(doc, h, lo + a, lo + b) for a, b in shard.covered(doc, text)]
            if got:
                yield pd.DataFrame(got, columns=["id", "h", "a", "b"])

    return run


def _remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for doc, h, text, ranges in zip(pdf["id"], pdf["h"], pdf["text"], pdf["ranges"]):
            parts = text.encode().split()
            gone = np.zeros(len(parts) + 1, np.int64)
            for r in ranges:
                gone[r["a"]] += 1
                gone[r["b"]] -= 1
            out = np.cumsum(gone)[:-1] > 0
            kept = b" ".join([w for w, x in zip(parts, out.tolist()) if not x])
            rows.append((doc, h, int(out.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
        yield pd.DataFrame(rows, columns=["id", "h", "n_gone", "kept_sha", "kept_text"])


def repeated_passages(df: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW,
                      phrase: int = PHRASE) -> tuple[DataFrame, DataFrame]:
    """(all documents: id, h, n_words, sha, node; the ranges to remove with their texts: id, h, text, ranges).

    node is the least id of the documents with an equal text. Ranges are of word positions, end exclusive.
    """
    spark = df.sparkSession
    ship(spark)
    t = df.select(F.col(id_col).cast("long").alias("id"), text_of(text).alias("text"))
    scanned = t.mapInArrow(_scanner(window, phrase), "id long, h binary, n_words long, sha string, seeds array<long>")
    scanned = written(scanned, "scanned")
    least = scanned.filter("id IS NOT NULL").groupBy("h").agg(F.min("id").alias("node"))
    rows = written(scanned.select("id", "h", "n_words", "sha").join(least, "h", "left"), "rows")
    reps = scanned.join(least, "h").filter("id = node")
    listed = reps.select("id", F.explode("seeds").alias("seed"))
    recurring = listed.groupBy("seed").agg(F.min("id").alias("x"), F.max("id").alias("y")).filter("x < y").select("seed")
    mine = listed.join(recurring, "seed").groupBy("id").agg(F.collect_set("seed").alias("seeds"))
    own = reps.select("id", "h").distinct()
    wanted = written(mine.join(own, "id"), "wanted")
    ids = few(wanted.select("id"))  # texts without a recurring seed stay where they lie
    near = t if ids is None else t.join(ids, "id", "left_semi")
    texts = near.withColumn("h", F.unhex(F.md5(F.col("text").cast("binary")))).join(wanted, ["id", "h"]).dropDuplicates(["id", "h"])
    texts = written(texts.select("id", "h", "text", "seeds"), "candidates")
    discard(scanned, wanted)
    seen = texts.select("id", "text", "seeds").mapInArrow(_windows(window, phrase), "w1 long, w2 long, id long")
    firsts = seen.groupBy("w1", "w2").agg(F.min("id").alias("id"), F.max("id").alias("y")).filter("id < y")
    owned = firsts.groupBy("id").agg(F.collect_list("w1").alias("owned"))
    found = texts.join(owned, "id", "left").select("id", "h", "text", "seeds", "owned") \
        .mapInArrow(_stretches(window, phrase), "seed long, side int, id long, h binary, lo long, stretch string")
    found = found.withColumn("part", F.lit(0).cast("long"))
    stretches = _split_hot(written(found, "stretches"), window, phrase)
    shards = max(1, -(-stretches.filter("side = 0").count() // SHARD_PATTERNS))
    found = stretches.withColumn("shard", F.pmod(F.xxhash64("seed", "part"), F.lit(shards)))
    salts = found.filter("side = 1").groupBy("shard").agg(F.ceil(F.count("*") / SALT_STRETCHES).alias("salts"))
    found = found.join(salts, "shard")
    one = found.filter("side = 1").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")))
    each = found.filter("side = 0").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    dealt = each.unionByName(one).drop("salts").repartition("shard", "salt").sortWithinPartitions("shard", "salt", "side")
    ranges = dealt.mapInPandas(_search(window, phrase), "id long, h binary, a long, b long")
    ranges = ranges.groupBy("id", "h").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    ranges = written(ranges, "ranges")
    discard(stretches)
    return rows, texts.select("id", "h", "text").join(ranges, ["id", "h"])


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW,
                   phrase: int = PHRASE) -> DataFrame:
    """One row for each input row: doc_id, n_words, n_removed, kept_sha256, kept (the text; null where nothing was removed).

    Words are runs without ASCII white space. A word goes if a window of ``window`` words that covers it also starts in
    a document with a smaller id, judged on the input. Null texts have no words; texts under ``window`` words keep all.
    Rows with equal ids are no smaller than each other; rows without an id lose nothing and make nothing go.
    Other columns are ignored; an empty table gives none.
    """
    rows, ranges = repeated_passages(df, id_col, text, window, phrase)
    gone = ranges.mapInPandas(_remove, "id long, h binary, n_gone long, kept_sha string, kept_text string")
    r = rows.join(gone, ["id", "h"], "left")
    copy = (F.col("id") > F.col("node")) & (F.col("n_words") >= window)
    copy = F.coalesce(copy, F.lit(False))
    return r.select(F.col("id").alias("doc_id"), "n_words",
                    F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_gone", F.lit(0).cast("long"))).alias("n_removed"),
                    F.when(copy, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
                    F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept"))
