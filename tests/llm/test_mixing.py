"""The mix against a plain reading of its rules: targets by resharing, copies near the target, odd rows."""
import re
from collections import defaultdict

import pytest

from marketlens.llm.mixing import MOST, mix, mixture
from edge_rows import edges, nothing  # noqa: F401

SCHEMA = "doc_id long, source string, text string, n long, place long, one int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def reshared(sizes: dict, weights=(3, 1, 2)):
    """Targets by sharing the rest again until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(sizes.values())
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        above = [s for s in free if share[s] > 2 * sizes[s]]
        if not above:
            return target | share
        for s in above:
            target[s] = 2 * sizes[s]
            left -= target[s]
            free.discard(s)
    return target


def check(spark, rows):
    df = spark.createDataFrame([(i, s, t, 1, 2, 3) for i, s, t in rows], SCHEMA)
    got = mixture(df).collect()
    sizes, longest = defaultdict(int), defaultdict(int)
    for _, s, t in rows:
        n = len(WORD.findall(t or ""))
        sizes[s] += n
        longest[s] = max(longest[s], n)
    target = reshared(sizes)
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        each = r.target / r.source_size if r.source_size else 0
        assert int(each - 1e-9) <= r.copies <= min(MOST, int(each) + 1) and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= longest[s]
    again = mixture(df).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    out = mix(df)
    assert out.columns == df.columns
    emitted = out.collect()
    assert sum(len(WORD.findall(r.text or "")) for r in emitted) == sum(taken.values())
    assert len(emitted) == sum(r.copies for r in got)


def test_targets_and_copies(spark):
    rows = []
    for s, (n, each) in {"a": (60, 7), "b": (5, 3), None: (40, 11), "": (1, 500), "é": (9, 1), "z": (30, 0)}.items():
        rows += [(len(rows) + i, s, " ".join(["w"] * (each + i % 5 if each else 0))) for i in range(n)]
    rows += [(None, "a", "x y z"), (None, None, None), (3, "a", "same"), (3, "a", "same"), (3, "a", "same"), (9, "a", "long " * 20_000)]
    check(spark, rows)


def test_one_source_and_hot_source(spark):
    check(spark, [(i, "only", "w " * (i % 13)) for i in range(300)])  # 150 % of everything, under its cap of 200 %
    check(spark, [(i, "hot" if i % 3 else f"s{i}", "w " * (i % 13)) for i in range(600)])


def test_edge_rows(spark, edges, nothing):
    assert mixture(edges, source="key").count() == edges.count() and mixture(nothing, source="key").count() == 0
    assert mix(edges, source="key").columns == edges.columns and mix(nothing, source="key").count() == 0
    blank = spark.createDataFrame([(1, "a", None, 0, 0, 0), (2, None, " ", 0, 0, 0)], SCHEMA)
    assert [(r.size, r.target, r.taken) for r in mixture(blank).collect()] == [(0, 0.0, 0)] * 2
