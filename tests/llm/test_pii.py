"""Personal data: pattern matches against plain re, message passing against enumeration, repeated entities found again."""
import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from marketlens.llm import pii_crf
from marketlens.llm.pii_crf import KINDS, LABELS, Field, Graph, base_spans, graph, personal_data, train
from edge_rows import edges, nothing  # noqa: F401

SF = "/root/testdata/sf0.01"
PLAIN = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
         r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute(text):
    out = []
    for k, p in enumerate(PLAIN):
        for m in re.finditer(p, text or ""):
            d = re.sub(r"[^0-9]", "", m[0])
            digits = [int(c) for c in d][::-1]
            luhn = sum(digits[::2]) + sum(sum(divmod(2 * x, 10)) for x in digits[1::2])
            if (True, all(int(x) <= 255 for x in m[0].split(".")) if k == 1 else 0, 16 <= len(d) <= 19 and luhn % 10 == 0, 8 <= len(d) <= 15)[k]:
                out.append((k, m.start(), m.end()))
    return out


def check(df):
    got = personal_data(df).collect()
    want = []
    for r in df.collect():
        b = brute(r.text)
        line = ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in b)
        want.append((r.doc_id, *[sum(x[0] == k for x in b) for k in range(4)], hashlib.sha256(line.encode()).hexdigest(), line))
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted((w[:6] for w in want), key=repr)
    lines = {w[5]: set(w[6].split(",")) for w in want}
    assert all(lines[r.base_sha256] - {""} <= set(r.spans.split(",")) for r in got)
    return got


def test_whole_table(spark):
    got = check(spark.read.parquet(f"{SF}/documents.parquet"))
    assert all(sum(r[c] for r in got) for c in ("n_email", "n_ip", "n_card", "n_phone"))


def test_patterns_on_made_texts():
    rng = random.Random(8)
    alphabet = "0123456789" * 3 + "..@@+- ()aZ_%é漢\U0001f600\n,"
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(80)))
        assert base_spans(text) == brute(text), text
    for text in ("4111 1111 1111 1111", "a@b.c@d.e", "x@y..z", "1.2.3.4.5.6.7.8", "+12 (345) 678-90.", "256.1.1.1 0000255.1.1.1", "a@b@c.de", "@a.b"):
        assert base_spans(text) == brute(text)
    assert base_spans("9" * 200_000 + "." + "a" * 200_000 + "@") == []


def test_messages_are_exact_on_trees():
    rng = np.random.default_rng(0)
    n = 5
    g = Graph(np.zeros(n, int), np.zeros(n, int), np.zeros(n, int), np.array([0, 2, 0, 0, 0]), rng.random((n, pii_crf.FEATURES)).astype(np.float32),
              np.array([[0, 1], [1, 2]]), np.array([[0, 3], [2, 4]]))
    f = Field(rng.normal(0, .4, (pii_crf.FEATURES, LABELS)), rng.normal(0, 1, (LABELS, LABELS)), 1.3)
    p = np.zeros((n, LABELS))
    own = g.features @ f.unary
    own[1, 2] += 2.0
    for labels in itertools.product(range(LABELS), repeat=n):
        z = sum(own[i, k] for i, k in enumerate(labels)) + sum(f.chain[labels[a], labels[b]] for a, b in g.chain)
        z += sum(f.agree * (labels[a] == labels[b]) for a, b in g.skip)
        for i, k in enumerate(labels):
            p[i, k] += np.exp(z)
    assert np.allclose(f.marginals(g, clamp=2.0, rounds=200), p / p.sum(axis=1, keepdims=True), atol=1e-6)


def test_repeated_entities_are_found_again(spark):
    docs = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    f = train([t for t in docs if re.search("[0-9@]", t)])
    text = "write to jo.smith77@mail.example.com or call +1 (736) 555-2678 now. " + "filler words here " * 60 + "ask for jo.smith77 or 7365552678; room 12"
    out = pii_crf.find(f, [text]).iloc[0]
    more = set(out.spans.split(",")) - {f"{KINDS[k]}:{a}:{b}" for k, a, b in base_spans(text)}
    words = {(s.split(":")[0], text[int(s.split(":")[1]):int(s.split(":")[2])]) for s in more}
    assert words == {("email", "jo.smith77"), ("phone", "7365552678")}, words
    alone = pii_crf.find(f, ["ask for jo.smith77 or 7365552678; room 12"]).iloc[0]
    assert alone.n_added == 0


def added(f, text):
    """(kind, word) of the spans beside the pattern matches, in the order of the text."""
    base = base_spans(text)
    more = sorted(f.added(graph([text], [base])), key=lambda s: s[2])
    assert pii_crf.find(f, [text]).iloc[0].n_added == len(more)
    return [(KINDS[k], text[a:b]) for _, k, a, b in more]


@pytest.fixture(scope="module")
def field(spark):
    docs = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    return train([t for t in docs if re.search("[0-9@]", t)])


def test_repeat_after_plain_words_alone(field):
    plain = " and so on with plain words" * 10
    assert added(field, "call +1 (736) 555-2678" + plain + " then 5552678 again") == [("phone", "5552678")]
    assert added(field, "write to jo.smith77@mail.example.com" + plain + " ask jo.smith77 again") == [("email", "jo.smith77")]


def test_fifty_repeats_of_one_entity(field):
    plain = " and so on with plain words" * 3 + " "
    for at in (0, 25, 50):  # the whole form stands first, in the middle, last
        for whole, short, kind in (("+1 (736) 555-2678", "5552678", "phone"), ("jo.smith77@mail.example.com", "jo.smith77", "email")):
            words = [short] * 50
            words.insert(at, whole)
            assert added(field, plain.join(words)) == [(kind, short)] * 50
    assert added(field, plain.join(["5552678"] * 51)) == []


def test_repeated_local_part_without_a_digit(field):
    plain = " and so on with plain words" * 10
    text = "write to john.smith@mail.example.com" + plain + "; ask john.smith, or (John_Smith)." + plain
    assert added(field, text) == [("email", "john.smith"), ("email", "John_Smith")]
    assert added(field, text + " john.smith" * 30)[2:] != []
    assert added(field, (plain + " ").join([text] + ["john.smith"] * 30)) == [("email", "john.smith"), ("email", "John_Smith")] + [("email", "john.smith")] * 30
    assert added(field, "ask john.smith, or John_Smith") == []
    assert added(field, "\u6f22\U0001f600 jane@a.example.com " + plain + " \U0001f600 <jane> ") == [("email", "jane")]


def test_look_alikes_add_nothing(field):
    for text in ("server 10.0.0.1 is up; order 10001, zip 10001", "ip 192.168.1.10 was seen; call 5552168110 or part 2168110",
                 "visa 4111111111111111 was used; ref 1111111 code 9991111111", "write to info@example.com for info, more info",
                 "ask sales@example.com why sales rose", "card 4111111111111111 not 4111111111111112 nor 4111111111111113",
                 "numbers 1234567812345678 and 4000000000000001 fail"):
        assert pii_crf.find(field, [text]).iloc[0].n_added == 0, text


def test_every_added_span_repeats_an_entity_of_its_document(spark, field):
    rows = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    for text, spans in zip(rows, pii_crf.find(field, rows).spans):
        base = base_spans(text)
        for s in set(spans.split(",")) - {f"{KINDS[k]}:{a}:{b}" for k, a, b in base} - {""}:
            kind, a, b = s.split(":")
            assert any(KINDS[k] == kind and pii_crf.repeats(k, text[int(a):int(b)], text[c:d]) for k, c, d in base), (s, text[int(a):int(b)])


def test_edges_are_linear_in_repeats():
    text = " ".join(["5552678"] * 500)
    g = graph([text + " x " + text.replace(" ", " word word ")], [[]])
    assert len(g.skip) + len(g.chain) < 2 * len(g.doc)


def test_edge_rows(spark, edges, nothing):
    check(edges)
    assert personal_data(nothing).count() == 0
