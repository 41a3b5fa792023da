"""Operator 1: token counts by batch encoding, lengths only.

A byte-pair tokenizer splits a text into pre-tokens that never span white space
and encodes each on its own, so white space is a safe boundary: ids(a + " " + b) = ids(a) + ids(b).
Each Arrow batch is cut into runs of about equal bytes; long texts are cut at
safe boundaries into their pieces, the distinct pieces not seen before by this
task go to the library in one batch, and only lengths (or ids) come back.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import byte_batches, keep, lean, ship, text_of

#: The pre-token rule of word_bpe_49k.json, narrowed to Latin text. Other text goes to the library whole.
_LETTER = "a-zªµºÀ-ÖØ-öø-ſ"
_NUMBER = "0-9²³¹¼½¾"
_PRETOKEN = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\\s{_LETTER}{_NUMBER}]+")
_LATIN = re.compile("[\t-\r\x20-~\xa1-įı-ſ]*")
_SPACE = re.compile("[ \t-\r]+")

TOKENIZER = "word_bpe_49k.json"
RAW = "\x00"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class _Index(dict):
    """Piece -> position; an unseen piece gets the next position and waits in ``pending``."""

    def __init__(self):
        super().__init__()
        self.pending: list[str] = []

    def __missing__(self, piece: str) -> int:
        i = self[piece] = len(self)
        self.pending.append(piece)
        return i


class PieceEncoder:
    """Encodes texts piece by piece through the tokenizers library and remembers the pieces' ids.

    ``max_chars`` bounds the memory of remembered pieces; beyond it they are
    forgotten and encoded anew when met again (results do not change).
    """

    def __init__(self, path: str, max_chars: int = 6_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        vocab = self.lib.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocab.values()) + 1, bool)
        self.ends_word[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.split_rule = self.ends_word.any()  # else every piece is encoded by the library on its own
        self.max_chars = max_chars
        self._clear()

    def _clear(self) -> None:
        self.index, self.chars = _Index(), 0
        self.lens = np.zeros(1 << 12, np.int64)
        self.offs = np.zeros(1 << 12, np.int64)
        self.pool = np.zeros(1 << 14, np.uint32)
        self.known = self.used = 0

    def _pieces(self, text: str) -> list[str]:
        if self.split_rule and "<|" not in text and _LATIN.fullmatch(text):
            return _PRETOKEN.findall(text.lower())
        out: list[str] = []
        for chunk in _SPACE.split(text):
            if chunk:
                if self.split_rule and "<|" not in chunk and _LATIN.fullmatch(chunk):
                    out += _PRETOKEN.findall(chunk.lower())
                else:
                    out.append(RAW + chunk)
        return out

    def _learn(self) -> None:
        """Encode the pieces that wait: pre-tokens joined by spaces (each ends in one word-end token), others one by one."""
        pending, self.index.pending = self.index.pending, []
        if not pending:
            return
        plain = [w for w in pending if w[0] != RAW]
        got: dict[str, np.ndarray] = {}
        if plain:
            ids = np.array(self.lib.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, np.uint32)
            cuts = np.flatnonzero(self.ends_word[ids]) + 1
            if len(cuts) == len(plain) and cuts[-1] == len(ids):
                flat, lens = ids, np.diff(cuts, prepend=0)
            else:
                each = [e.ids for e in self.lib.encode_batch_fast(plain, add_special_tokens=False)]
                flat, lens = np.array([i for e in each for i in e], np.uint32), np.array([len(e) for e in each], np.int64)
        if len(plain) < len(pending):
            if plain:
                got = dict(zip(plain, np.split(flat, np.cumsum(lens)[:-1])))
            raw = [w for w in pending if w[0] == RAW]
            for w, e in zip(raw, self.lib.encode_batch_fast([w[1:] for w in raw], add_special_tokens=False)):
                got[w] = np.array(e.ids, np.uint32)
            flat = np.concatenate([got[w] for w in pending])
            lens = np.array([len(got[w]) for w in pending], np.int64)
        n, m = self.known + len(pending), self.used + len(flat)
        if n > len(self.lens):
            self.lens, self.offs = (np.concatenate([a, np.zeros(n, np.int64)]) for a in (self.lens, self.offs))
        if m > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(m, np.uint32)])
        self.lens[self.known:n] = lens
        self.offs[self.known:n] = self.used + np.cumsum(lens) - lens
        self.pool[self.used:m] = flat
        self.known, self.used = n, m
        self.chars += sum(map(len, pending))

    def _positions(self, texts: list[str]) -> list[np.ndarray]:
        if self.chars > self.max_chars:
            self._clear()
        get = self.index.__getitem__
        out = []
        for t in texts:
            pieces = self._pieces(t)
            out.append(np.fromiter(map(get, pieces), np.int64, len(pieces)))
        self._learn()
        return out

    def counts(self, texts: list[str]) -> list[int]:
        return [int(self.lens[at].sum()) for at in self._positions(texts)]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        out = []
        for at in self._positions(texts):
            lens = self.lens[at]
            ends = np.cumsum(lens)
            total = int(ends[-1]) if len(ends) else 0
            out.append(self.pool[np.arange(total) + np.repeat(self.offs[at] - ends + lens, lens)])
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One encoder for each Python worker, kept between its tasks until another operator's begin."""
    keep("tokens", encoder.cache_clear)
    return PieceEncoder(path)


def token_count_column(text, path: str):
    """Column of token counts of whole texts (null: 0)."""

    @F.pandas_udf("long")
    @partial(lean, owner="tokens")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(path)
        for batch in batches:
            out: list[int] = []
            for run in byte_batches(batch):
                out += enc.counts(run)
            yield pd.Series(out, dtype="int64")

    return count(text_of(text))


def token_counts(df: DataFrame, text: str = "text", id_col: str = "doc_id", path: str | None = None,
                 limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row; no shuffle.

    Null and empty texts have 0 bytes and 0 tokens; repeated rows come back as
    often as they are; other columns are ignored; an empty table gives none.
    """
    ship(df.sparkSession)
    t = df.select(F.col(id_col).alias("doc_id"), text_of(text).alias("text"))
    t = t.withColumn("n_tokens", token_count_column("text", path or tokenizer_path()))
    return t.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "n_tokens",
                    (F.col("n_tokens") > limit).alias("over_limit"))
