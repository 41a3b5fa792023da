"""Conversation repair against a plain dynamic program over strings, and that one against all edit sequences."""
import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

from marketlens.llm import repair as R
from marketlens.llm.audit_paths import Paths

SF = "/root/testdata/sf0.01"
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
SPACE = " \t\n\x0b\x0c\r"


def plain(rows):
    """(cost, audit, repaired) of rows (initial, must go, truncated, role, text), by strings."""
    def inserts(best):
        for _ in range(3):
            for q, (c, w, out) in list(best.items()):
                new, name = ("a", "assistant") if q == "u" else ("u", "user")
                best[new] = min(best.get(new, (1 << 60, "", ())), (c + 2, w + "I", (*out, f"{name}:")))
        return best
    best = inserts({"": (0, "", ())})
    for initial, gone, cut, role, text in rows:
        after = {}
        for q, (c, w, out) in best.items():
            after[q] = min(after.get(q, (1 << 60, "", ())), (c + 3, w + "D", out))
            if gone:
                continue
            to = STEP.get((q, initial))
            if to:
                after[to] = min(after.get(to, (1 << 60, "", ())), (c + cut, w + "K", (*out, f"{role}:{text}")))
            new, name = ("a", "assistant") if q == "u" else ("u", "user")
            after[new] = min(after.get(new, (1 << 60, "", ())), (c + 2 + cut, w + "R", (*out, f"{name}:{text}")))
        best = inserts(after)
    return min(best[q] for q in ("", "a") if q in best)


def every(rows):
    """(cost, audit) by trying all edit sequences with at most 2 inserted rows in a place."""
    got = []
    insert = ["", "u", "a", "ua", "au"]
    edits = [["D"] if gone else ["D", "K", "Ru", "Ra"] for _, gone, *_ in rows]
    for choice in itertools.product(*edits):
        for holes in itertools.product(insert, repeat=len(rows) + 1):
            out = w = ""
            cost = 0
            for hole, e, row in zip(holes, [*choice, None], [*rows, None]):
                out, w, cost = out + hole, w + "I" * len(hole), cost + 2 * len(hole)
                if e is None:
                    continue
                w += e[0]
                cost += {"D": 3, "K": 0, "R": 2}[e[0]] + (row[2] if e != "D" else 0)
                out += "" if e == "D" else row[0] if e == "K" else e[1]
            if re.fullmatch("(s?(ua)+)?", out):
                got.append((cost, w))
    return min(got)


def damaged(rows):
    """{conv: rows after damage in order}; rows are (conv, turn, role, text)."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv]
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        h = hashlib.md5(text.encode()).hexdigest()
        new = ("user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        convs[conv] += [((turn is not None, turn or 0, role, h, i), turn, *new) for i in range((1, 2)[kind == 3] if kind else 0)]
    return {c: [x[1:] for x in sorted(got, key=lambda x: x[0])] for c, got in convs.items()}


def report(rows):
    blank = duplicate = truncated = illegal = 0
    seen, codes = set(), []
    for _, role, text in rows:
        left = text.rstrip(SPACE)
        first = "blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else ""
        seen.add((role, text))
        blank, duplicate, truncated = blank + (first == "blank"), duplicate + (first == "duplicate"), truncated + (first == "truncated")
        codes.append((role[:1], first in ("blank", "duplicate"), int(first == "truncated"), role, text))
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(codes, codes[1:]))
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit, out = plain(codes)
    return gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def check(spark, rows, schema="conv_id long, turn long, role string, text string"):
    got = {r.conv_id: r for r in R.audit(spark.createDataFrame(rows, schema), damage=True).collect()}
    want = damaged([r[:4] for r in rows])
    assert set(got) == set(want)
    for conv, own in want.items():
        r = got[conv]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) == report(own), (conv, own)


def test_plain_program_finds_the_cheapest_of_all_edits():
    rng = random.Random(4)
    for _ in range(150):
        rows = [(rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.3, "", "") for _ in range(rng.randint(0, 3))]
        assert plain(rows)[:2] == every(rows)


def letters(rows):
    return "".join("d" if gone else i.upper() if cut else i for i, gone, cut, *_ in rows)


def test_paths_and_segments_equal_the_plain_program(monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(R, "SETTLE", 60)
    for n in [*range(0, 30)] * 6 + [400]:
        rows = [(rng.choice("ssuuuuaaax"), rng.random() < 0.15, rng.random() < 0.3, "", "") for _ in range(n)]
        want, text, joined = plain(rows)[:2], letters(rows), R.Joined()
        ends = R.solve(text)
        assert min(ends[q] for q in "0a" if q in ends) == want
        at = 0
        while at < n:
            step = rng.randint(1, 40)
            joined.add(text[at:at + step], {"0": R.solve(text[at:at + step], "0")} if rng.random() < 0.5 else {})
            at += step
        assert joined.result() == want


def test_comparison_survives_colliding_hashes():
    rng = random.Random(6)
    for mod in ((1 << 61) - 1, 2, 3):
        paths = Paths(base=5, mod=mod)
        nodes, texts = [0], [""]
        for _ in range(300):
            i, piece = rng.randrange(len(nodes)), "".join(rng.choice("DIK") for _ in range(rng.randint(1, 4)))
            nodes.append(paths.add(nodes[i], piece))
            texts.append(texts[i] + piece)
        for _ in range(3000):
            i, j = rng.randrange(len(nodes)), rng.randrange(len(nodes))
            assert paths.less(nodes[i], nodes[j]) == (texts[i] < texts[j])
            n = rng.randint(0, len(texts[i]))
            assert paths.text(nodes[i], n) == texts[i][n:]


def test_the_whole_table(spark):
    check(spark, [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()])


def test_odd_rows(spark):
    rng = random.Random(7)
    texts = ["Yes.", "No", "  ", "", None, "What? ", "é!", "x ", "line\nbreak.", "..."]
    rows = [(rng.randint(0, 40) if i % 9 else None, rng.randint(-3, 4) if i % 7 else None, rng.choice(["user", "assistant", "system", "tool", "u", "Sys", None]),
             rng.choice(texts), "clash", i, 0) for i in range(700)]
    rows += rows[:60] + [(77, 0, "user", "long. " * 50_000, "x", 1, 1), (2**40, 2**40, "assistant", "a.", "x", 1, 1)]
    schema = "conv_id long, turn long, role string, text string, audit string, bucket long, copy int"
    check(spark, rows, schema)
    assert R.audit(spark.createDataFrame([], schema), damage=True).count() == 0
    assert R.repair(spark.createDataFrame([], schema)).count() == 0


def test_a_long_conversation_is_cut_into_segments(spark):
    rng = random.Random(8)
    rows = [(5, t, rng.choice(["user", "assistant"]), rng.choice(["So.", "Is it", f"n {t}.", f"m {t}"])) for t in range(1700)]
    rows += [(5, 900, "user", f"same turn {i}") for i in range(700)] + [(5, None, "system", "s."), (6, 2000, "user", "q?"), (6, 2001, "assistant", "a.")]
    check(spark, rows)


def test_repaired_rows(spark):
    df = spark.createDataFrame([("c", 1, "user", "q?"), ("c", 2, "user", "r?"), ("c", 3, "assistant", "a."), ("d", 1, "assistant", " ")],
                               "conv_id string, turn int, role string, text string")
    got = [tuple(r) for r in R.repair(df).orderBy("conv_id", "place").collect()]
    assert got == [("c", 0, "K", "user", "q?"), ("c", 1, "I", "assistant", ""), ("c", 2, "K", "user", "r?"), ("c", 3, "K", "assistant", "a.")]
