"""Operator 4: personal data with a skip-chain conditional random field.

Pattern matches (e-mail, IP address, card, phone) are evidence that stays. Words that hold a digit or an @, and
words that are similar to one inside a pattern match of the same document, are the nodes of a field over the labels none, email, ip,
card, phone. Chain edges join neighbouring words; skip edges join
words of a document that are the same or similar (equal local part, or equal last seven digits), each to one hidden node of its
group, so a word repeated n times has n edges and any two repeats are two edges apart. A group that holds a pattern match has that
match's label as observed, however many repeats outweigh it. Loopy sum-product message passing spreads the evidence until no message
changes, and words whose most likely label is an entity are added as spans: a number given once as +1 (736) 555-2678 is found
again as 5552678.

Weights are learned by pseudo-likelihood on a bounded sample of texts, the pattern matches being the labels; the agreement of
skip edges has a floor, since words that the patterns miss count as none in training. All documents of an Arrow batch are one
graph without edges between documents, so messages are passed for all of them at once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import byte_batches, ship, text_of

#: Kinds in the order in which they are listed, and their patterns (e-mail is scanned from its @).
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_EVIDENCE = re.compile(r"[0-9@]")
_DIGITS = re.compile(r"[0-9]+")
_PLAIN = re.compile(r"[^A-Za-z0-9]+")
_WORD = re.compile(r"[^ \t-\r]+")
#: Words before a token that speak for a kind.
CUES = {"email": 0, "mail": 0, "contact": 0, "ip": 1, "host": 1, "server": 1, "card": 2, "visa": 2, "credit": 2,
        "phone": 3, "tel": 3, "call": 3, "fax": 3, "mobile": 3}
#: Local parts that name a role, not a person: as words they are no personal data.
ROLES = {"account", "accounts", "admin", "billing", "contact", "feedback", "hello", "help", "helpdesk", "info", "jobs", "mail", "marketing", "news",
         "newsletter", "noreply", "office", "postmaster", "press", "root", "sales", "security", "service", "support", "team", "webmaster"}
LABELS = 1 + len(KINDS)
FEATURES = 1 + 8 + 9 + len(KINDS)
#: Training texts, their greatest size in bytes; weight of a pattern match; least weight of agreement.
SAMPLE, SAMPLE_BYTES, CLAMP, AGREE = 1500, 20_000, 10.0, 8.0
#: Messages of a document are passed until none changes by more; rounds after which one that never settles is left; rounds between looks.
TOLERANCE, ROUNDS, LOOK = 1e-7, 2000, 8


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the pattern matches, by kind, then start; leftmost and non-overlapping within a kind."""
    out = []
    done, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        start = at
        if m:
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
        if m and start < at:
            out.append((0, start, m.end()))
            done = m.end()
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)
    if _DIGITS.search(text):
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text)
                if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                d = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(d) <= 19 and _luhn(d):
                    out.append((2, m.start(), m.end()))
        if "+" in text:
            out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= sum(map(len, _DIGITS.findall(m[0]))) <= 15]
    return out


def _tokens(text: str, also: frozenset[int] = frozenset()) -> list[tuple[int, int, str]]:
    """(start, end, word before) of the words with a digit or an @ or that start at ``also``, edge punctuation cut off."""
    out, at = [], 0
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = (points == 32) | ((points >= 9) & (points <= 13))
    holds = ((points >= 48) & (points <= 57)) | (points == 64)
    cut = np.concatenate([[-1], np.flatnonzero(space), [len(points)]])
    at = np.concatenate([np.flatnonzero(holds), np.array(sorted(also), np.int64)])
    word = np.unique(np.searchsorted(cut, at) - 1)
    for w in word.tolist():
        a, b = int(cut[w]) + 1, int(cut[w + 1])
        # the word before, at most 12 letters of it: enough for a cue
        before = text[max(int(cut[w - 1]) + 1, a - 13):a].strip(" \t\n\r\x0b\x0c:.,=(").lower() if w else ""
        while a < b and text[a] in ".,;:!?\"'()[]<>{}|":
            a += 1
        while a < b and text[b - 1] in ".,;:!?\"'()[]<>{}|":
            b -= 1
        if a < b:
            out.append((a, b, before))
    return out


def _features(token: str, before: str) -> list[int]:
    """Numbers of the features that hold."""
    digits = sum(c.isdigit() for c in token)
    on = [0, 1 + int(np.searchsorted((1, 3, 5, 8, 12, 16, 20), digits, side="right"))]
    tests = ("@" in token, "@" in token and "." in token[token.find("@"):], token.count(".") == 3, token[0] == "+", "-" in token,
             any(c.isalpha() for c in token), token.isdigit(), "=" in token, "(" in token)
    on += [9 + i for i, x in enumerate(tests) if x]
    if before in CUES:
        on.append(18 + CUES[before])
    return on


def _key(token: str) -> str:
    """Equal for similar tokens: the local part of an address, the last seven digits of a number, else the letters and digits."""
    if "@" in token:
        return "a" + _PLAIN.sub("", token[:token.find("@")]).lower()
    plain = _PLAIN.sub("", token).lower()
    if plain.isdigit():
        return "d" + plain[-7:] if len(plain) >= 7 else ("s" + plain if len(plain) >= 5 else "")
    return "a" + plain if len(plain) >= 4 else ""


def _repeats(text: str, tokens: list[tuple[int, int, str]], found: list[tuple[int, int, int]]) -> frozenset[int]:
    """Starts of the words without a digit or an @ that are similar to a word inside a pattern match."""
    inside = [(a, b) for k, a, b in found if k == 0]  # what the other kinds match holds a digit, and so does what is similar to it
    if not inside:
        return frozenset()
    starts = [a for a, _ in inside]
    keys = set()
    for a, b, _ in tokens:
        i = int(np.searchsorted(starts, b)) - 1
        if i >= 0 and inside[i][1] > a:
            keys.add(_key(text[a:b]))
    keys = {k for k in keys if len(k) > 4 and k[0] == "a" and not _DIGITS.search(k)}
    if not keys:
        return frozenset()
    same = {w for w in set(_WORD.findall(text)) if not _EVIDENCE.search(w) and _key(w) in keys}
    return frozenset(m.start() for m in _WORD.finditer(text) if m[0] in same) if same else frozenset()


@dataclass
class Graph:
    """Nodes and edges of many documents."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    base: np.ndarray  # label of the pattern match that the node lies in, 0: none
    features: np.ndarray  # nodes x FEATURES
    chain: np.ndarray  # edges x 2, left to right
    skip: np.ndarray  # edges x 2, word and hidden node of its group; hidden nodes are numbered after the words


def graph(texts: list[str], spans: list[list[tuple[int, int, int]]], repeats: bool = True) -> Graph:
    """repeats: with words that have no digit or @ but are similar to one in a pattern match (in training they would count as none)."""
    doc, start, end, base, on, chain, groups = [], [], [], [], [], [], []
    for i, (text, found) in enumerate(zip(texts, spans)):
        if not _EVIDENCE.search(text):
            continue
        by_start = sorted((a, b, k + 1) for k, a, b in found)
        alike: dict[str, list[int]] = {}
        p, reach = 0, []
        before_end = -9
        tokens = _tokens(text)
        also = _repeats(text, tokens, found) if repeats else frozenset()
        for a, b, before in _tokens(text, also) if also else tokens:
            node = len(doc)
            while p < len(by_start) and by_start[p][0] < b:
                reach.append(by_start[p])
                p += 1
            reach = [s for s in reach if s[1] > a]
            doc.append(i)
            start.append(a)
            end.append(b)
            base.append(min((s[2] for s in reach), default=0))
            on.append(_features(text[a:b], before))
            if a - before_end <= 3:
                chain.append((node - 1, node))
            before_end = b
            key = _key(text[a:b])
            if key:
                alike.setdefault(key, []).append(node)
        groups += [g for g in alike.values() if len(g) > 1]
    skip = [(node, len(doc) + h) for h, g in enumerate(groups) for node in g]
    x = np.zeros((len(doc), FEATURES), np.float32)
    for i, f in enumerate(on):
        x[i, f] = 1

    def pairs(e):
        return np.array(e, np.int64).reshape(-1, 2)
    return Graph(np.array(doc, np.int64), np.array(start, np.int64), np.array(end, np.int64), np.array(base, np.int64), x, pairs(chain), pairs(skip))


@dataclass
class Field:
    unary: np.ndarray  # FEATURES x LABELS
    chain: np.ndarray  # LABELS x LABELS, left label by right label
    agree: float

    def marginals(self, g: Graph, clamp: float = CLAMP, rounds: int = ROUNDS) -> np.ndarray:
        """(nodes, LABELS) beliefs of the words after loopy message passing."""
        n = len(g.doc)
        own = np.zeros((max(n, int(g.skip.max(initial=-1)) + 1), LABELS))
        own[:n] = g.features @ self.unary
        own[np.arange(n), g.base] += np.where(g.base > 0, clamp, 0)
        # a group has the labels of its pattern matches as observed: more than its words together can say against them
        node, hub = g.skip[g.skip[:, 1] >= n].T
        size = np.bincount(hub, minlength=len(own))
        hit = np.unique(np.stack([hub, g.base[node]], axis=1)[g.base[node] > 0], axis=0)
        own[hit[:, 0], hit[:, 1]] += clamp + self.agree * size[hit[:, 0]]
        same = self.agree * np.eye(LABELS)
        source = np.concatenate([g.chain[:, 0], g.chain[:, 1], g.skip[:, 0], g.skip[:, 1]])
        target = np.concatenate([g.chain[:, 1], g.chain[:, 0], g.skip[:, 1], g.skip[:, 0]])
        c, s = len(g.chain), len(g.skip)
        back = np.concatenate([np.arange(c) + c, np.arange(c), np.arange(s) + 2 * c + s, np.arange(s) + 2 * c]).astype(np.int64)
        factor = np.repeat(np.arange(3), [c, c, 2 * s])
        doc = g.doc[np.concatenate([g.chain[:, 0], g.chain[:, 0], g.skip[:, 0], g.skip[:, 0]])]
        message = np.zeros((len(source), LABELS))

        def beliefs(own: np.ndarray, target: np.ndarray, message: np.ndarray) -> np.ndarray:
            return own + np.stack([np.bincount(target, message[:, k], len(own)) for k in range(LABELS)], axis=1)
        live = np.arange(len(source))  # edges of documents whose messages still change
        done = 0
        while len(live) and done < rounds:
            # nodes of these documents alone, in numbers of their own; a chain's or group's edges are kept or left together
            nodes, ends = np.unique(np.concatenate([source[live], target[live]]), return_inverse=True)
            src, dst = ends[:len(live)], ends[len(live):]
            here, rev = own[nodes], np.searchsorted(live, back[live])
            c1, c2 = np.searchsorted(factor[live], [1, 2])
            m = message[live]
            for _ in range(min(LOOK, rounds - done)):
                out = (beliefs(here, dst, m)[src] - m[rev])[:, :, None] + 0
                out = np.concatenate([out[:c1] + self.chain, out[c1:c2] + self.chain.T, out[c2:] + same])
                top = out.max(axis=1, keepdims=True)
                new = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
                new = 0.5 * m + 0.5 * (new - new.max(axis=1, keepdims=True))
                change = np.abs(new - m).max(axis=1)
                m, done = new, done + 1
            message[live] = m
            moving = np.zeros(int(doc.max()) + 1, bool)
            moving[doc[live][change > TOLERANCE]] = True
            live = live[moving[doc[live]]]
        b = beliefs(own, target, message)[:n]
        b = np.exp(b - b.max(axis=1, keepdims=True))
        return b / b.sum(axis=1, keepdims=True)

    def added(self, g: Graph) -> list[tuple[int, int, int, int]]:
        """(document, kind, start, end) of entity nodes outside pattern matches; neighbours of one kind are one span."""
        if not len(g.doc):
            return []
        p = self.marginals(g)
        label = p.argmax(axis=1)
        linked = set(map(tuple, g.chain.tolist()))
        out: list[list[int]] = []
        last = -2
        for i in np.flatnonzero((g.base == 0) & (label > 0) & (p.max(axis=1) >= 0.5)).tolist():
            if last == i - 1 and (last, i) in linked and label[last] == label[i]:
                out[-1][3] = int(g.end[i])
            else:
                out.append([int(g.doc[i]), int(label[i]) - 1, int(g.start[i]), int(g.end[i])])
            last = i
        return [tuple(o) for o in out]


def train(texts: list[str], rounds: int = 250, rate: float = 0.1, ridge: float = 1e-3) -> Field:
    """Weights by pseudo-likelihood: each node's label given those of its neighbours, the pattern matches being the labels."""
    g = graph(texts, [base_spans(t) for t in texts], repeats=False)
    unary, chain, agree = np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros(1)
    if not len(g.doc):
        unary[0, 0] = 1.0
        return Field(unary, chain, AGREE)
    y = np.eye(LABELS)[g.base]
    a, b = g.chain.T
    # in training, a group's words are joined each to the next, as labels of its hidden node are not observed
    word, hub = g.skip.T
    next_one = hub[1:] == hub[:-1]
    u, v = word[:-1][next_one], word[1:][next_one]

    def gather(at, rows):
        return np.stack([np.bincount(at, rows[:, k], len(y)) for k in range(LABELS)], axis=1)
    same = gather(u, y[v]) + gather(v, y[u])
    params = [unary, chain, agree]
    m, w = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, rounds + 1):
        z = g.features @ unary + gather(a, y[b] @ chain.T) + gather(b, y[a] @ chain) + agree[0] * same
        e = np.exp(z - z.max(axis=1, keepdims=True))
        e = (e / e.sum(axis=1, keepdims=True) - y) / len(y)
        grads = [g.features.T @ e + ridge * unary, e[a].T @ y[b] + y[a].T @ e[b] + ridge * chain,
                 np.array([(e * same).sum()]) + ridge * agree]
        for i, d in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * d
            w[i] = 0.999 * w[i] + 0.001 * d * d
            params[i] -= rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(w[i] / (1 - 0.999 ** t)) + 1e-8)
    return Field(unary, chain, max(AGREE, float(agree[0])))


def fit(df: DataFrame, text: str = "text", sample: int = SAMPLE, max_bytes: int = SAMPLE_BYTES) -> Field:
    """Train on about ``sample`` texts with a digit or an @ and at most ``max_bytes`` bytes, the same ones every time.

    The sample is the texts of least hash: the hashes alone are ordered first, and only texts under the cut are fetched.
    """
    t = df.select(text_of(text).alias("text")).filter(F.col("text").rlike("[0-9@]") & (F.octet_length("text") <= max_bytes))
    t = t.select("text", F.xxhash64("text").alias("h"))  # equal texts count once
    hashes = [r.h for r in t.select("h").distinct().orderBy("h").limit(sample).collect()]
    if not hashes:
        return train([])
    rows = t.filter(F.col("h") <= max(hashes)).dropDuplicates(["h"]).toPandas()
    return train(sorted(rows.text.tolist()))


def _line(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def repeats(kind: int, word: str, match: str) -> bool:
    """Whether a word repeats a pattern match of a kind, told by what makes up that kind.

    An address: the letters and digits of its local part, at least four, unless that names a role. An ip: the same with its dots.
    A card: all its digits. A phone: at least seven digits that end it, or its last nine. Words that stand together may each repeat it.
    """
    several = _WORD.findall(word)
    if len(several) > 1 and all(repeats(kind, w, match) for w in several):
        return True
    word = word.strip(".,;:!?()[]<>{}\"'")
    if kind == 0:
        local, own = (_PLAIN.sub("", x.split("@")[0]).lower() for x in (match, word))
        return own == local and len(local) >= 4 and local not in ROLES
    if kind == 1:
        return word == match
    digits, own = "".join(_DIGITS.findall(match)), "".join(_DIGITS.findall(word))
    if _PLAIN.sub("", word) != own:
        return False
    if kind == 2:
        return own == digits
    return 7 <= len(own) <= 15 and (digits.endswith(own) or len(own) >= 9 and own[-9:] == digits[-9:])


def find(field: Field, texts: list[str]) -> pd.DataFrame:
    base = [base_spans(t) if _EVIDENCE.search(t) else [] for t in texts]
    more: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for i, *span in field.added(graph(texts, base)):
        kind, a, b = span
        if any(k == kind and repeats(kind, texts[i][a:b], texts[i][c:d]) for k, c, d in base[i]):
            more[i].append((kind, a, b))
    rows = [(*[sum(s[0] == k for s in b) for k in range(len(KINDS))], hashlib.sha256(_line(b).encode()).hexdigest(),
             _line(b + m), len(m)) for b, m in zip(base, more)]
    return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])


def personal_data(df: DataFrame, id_col: str = "doc_id", text: str = "text", field: Field | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added for each row; no shuffle.

    Counts and base_sha256 are of the pattern matches; spans also has the n_added words that the field adds, as
    kind:start:end in code points, end exclusive, by kind, then start. Null texts count as empty and have none; repeated rows are
    reported each, null ids as null; other columns are ignored; an empty table gives none.
    """
    spark = df.sparkSession
    ship(spark)
    field = field or fit(df, text)
    shared = spark.sparkContext.broadcast(field)

    @F.pandas_udf("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            runs = [find(shared.value, run) for run in byte_batches(batch, 4 << 20)]
            yield pd.concat(runs, ignore_index=True) if runs else find(shared.value, [])

    t = df.select(F.col(id_col).alias("doc_id"), scan(text_of(text)).alias("p"))
    return t.select("doc_id", "p.*")
