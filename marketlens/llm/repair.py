"""Operator 11: conversation structure repair by a dynamic program over persistent edit paths.

A conversation's rows are kept, given another role, deleted, or preceded by inserted empty rows, so that the roles read
``(s?(ua)+)?``; the cheapest edits win, and among equally cheap ones the least audit string (the edits' initials).

The program walks over row classes (role initial and first fault) and holds, for each state of the role pattern, the least
cost and the best path to it. Paths are linked nodes (audit_paths.Paths): equal costs are decided by a longest-common-prefix
search. That two paths of equal cost to one state never are prefixes of each other makes the choice of each step final:
a path's letters tell its cost and its number of kept and inserted rows, so a longer one with the same rows costs more.

How it runs. A conversation is cut into segments of at most 512 turns and 512 rows. Segments are solved apart, for each state
that they may begin in, and joined in order by a second program over their results, so a conversation that holds a
third of all rows is spread over many tasks, and no task holds more of it than a segment and the paths that still compete.
Rows travel to the segments as one letter each, without texts. Texts are shuffled once, to be hashed in order beside the
audit string (the hash of a conversation is sequential by its nature; it is streamed).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.audit_paths import Paths
from marketlens.llm.common import ship, written

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Turns (as a power of two) and rows of a segment.
TURN_BITS, SEGMENT_ROWS = 9, 512
#: Letters of the paths that ``Joined`` holds before it sets aside what they share.
SETTLE = 8 * SEGMENT_ROWS
#: States of the role pattern: nothing yet, after s, after u, after a. The first and the last may end a conversation.
_STATES, _NEXT = "0sua", {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
_LEGAL = {"su", "ua", "au"}
#: Letters of row classes: the role's initial (x: any other), in upper case if truncated; d: must be deleted.
_BLANK = "\t\n\x0b\x0c\r "


def _relax(paths: Paths, best: dict, state: str, cost: int, parent: int, piece: str) -> None:
    """Offer the path (parent, piece) to ``state``."""
    known = best.get(state)
    if known is not None and cost > known[0]:
        return
    node = paths.add(parent, piece) if piece else parent
    if known is None or cost < known[0] or paths.less(node, known[1]):
        best[state] = (cost, node)


def _inserted(paths: Paths, best: dict) -> None:
    """Offer inserted rows: user after nothing, s or a, assistant after u; each costs, so a state is left at most once."""
    for state in sorted(best, key=lambda q: best[q][0]):
        at = state
        cost, node = best[state]
        for _ in range(2):  # a third insertion would come back to a state already reached
            after = "a" if at == "u" else "u"
            cost, node = cost + INSERT, paths.add(node, "I")
            known = best.get(after)
            if known is not None and (cost > known[0] or cost == known[0] and not paths.less(node, known[1])):
                break
            best[after] = (cost, node)
            at = after


@lru_cache(maxsize=1 << 13)
def solve(classes: str, start: str = "0") -> dict[str, tuple[int, str]]:
    """end state -> (least cost, least audit string) of a segment of row classes entered in ``start``."""
    paths = Paths()
    best = {start: (0, 0)}
    _inserted(paths, best)
    for c in classes:
        after: dict[str, tuple[int, int]] = {}
        extra = TRUNCATED if c.isupper() else 0
        for state, (cost, node) in best.items():
            _relax(paths, after, state, cost + DELETE, node, "D")
            if c == "d":
                continue
            kept = _NEXT.get((state, c.lower()))
            if kept:
                _relax(paths, after, kept, cost + extra, node, "K")
            # another role is never cheaper where the row's own role would do, and never the same edit
            other = "a" if state == "u" else "u"
            if other != kept:
                _relax(paths, after, other, cost + REROLE + extra, node, "R")
        best = after
        _inserted(paths, best)
    return {q: (cost, paths.text(node)) for q, (cost, node) in best.items()}


class Joined:
    """Segments of one conversation in order: the best path to each state so far."""

    def __init__(self):
        self.paths, self.best, self.done = Paths(), {"0": (0, 0)}, []

    def add(self, classes: str, table: dict[str, dict[str, tuple[int, str]]]) -> None:
        """table: start state -> what ``solve`` gives for it, as far as it has been solved."""
        after: dict[str, tuple[int, int]] = {}
        for state, (cost, node) in self.best.items():
            for end, (more, piece) in (table.get(state) or solve(classes, state)).items():
                _relax(self.paths, after, end, cost + more, node, piece)
        self.best = after
        if max(self.paths.end[node] for _, node in after.values()) > SETTLE:
            self.settle()

    def settle(self) -> None:
        """Set aside what all paths begin with, so that only their different ends are held."""
        nodes = [node for _, node in self.best.values()]
        first = nodes[0]
        n = min([self.paths.end[first], *(self.paths.common(first, x) for x in nodes[1:])])
        if all(self.paths.same(first, x, n) for x in nodes[1:]):
            self.done.append(self.paths.text(first)[:n])
            fresh = Paths()
            self.best = {q: (cost, fresh.add(0, piece) if (piece := self.paths.text(node, n)) else 0) for q, (cost, node) in self.best.items()}
            self.paths = fresh

    def result(self) -> tuple[int, str]:
        """(cost, audit) of the whole conversation."""
        ends = [self.best[q] for q in "0a" if q in self.best]
        cost = min(c for c, _ in ends)
        return cost, "".join(self.done) + min(self.paths.text(node) for c, node in ends if c == cost)


def _damaged(df: DataFrame, conv_id: str, turn: str, role: str, text: str, damage: bool) -> DataFrame:
    """conv, turn, role, text, order columns (r, h, copy) and gone: rows after damage; a dropped row stays as ``gone``."""
    blank = F.lit(" ")
    d = df.select(F.col(conv_id).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(role, blank).alias("r"), F.coalesce(text, blank).alias("t"))
    key = F.concat(F.coalesce(F.col("conv").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20 if damage else F.lit(99)
    d = d.withColumn("kind", kind).withColumn("h", F.md5(F.col("t").cast("binary")))
    role_, text_ = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("r")), F.when(F.col("kind") == 1, F.lit("")).when(
        F.col("kind") == 2, F.translate("t", ".!?", "")).otherwise(F.col("t"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return d.select("conv", "turn", role_.alias("role"), text_.alias("text"), "r", "h", F.explode(copies).alias("copy"), (F.col("kind") == 0).alias("gone"))


def _classes(rows: DataFrame) -> DataFrame:
    """conv, bucket, turn, r, h, copy, class (empty: the row is gone), blank, duplicate, truncated."""
    content = F.md5(F.col("text").cast("binary"))
    left = F.rtrim(F.col("text"), F.lit(_BLANK))
    d = rows.select("conv", "turn", "role", "r", "h", "copy", "gone", content.alias("c"), (F.length(left) == 0).alias("blank"),
                    (~F.right(left, F.lit(1)).isin(".", "!", "?")).alias("open"), F.struct("turn", "r", "h", "copy").alias("place"))
    # the first place of each (role, text) of a conversation that occurs more than once
    firsts = d.filter("NOT gone AND NOT blank").groupBy("conv", "role", "c").agg(F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1") \
        .select(F.col("conv").alias("conv2"), F.col("role").alias("role2"), F.col("c").alias("c2"), "first")
    d = d.join(firsts, F.col("conv").eqNullSafe(F.col("conv2")) & (F.col("role") == F.col("role2")) & (F.col("c") == F.col("c2")), "left")
    again = F.coalesce(~F.col("place").eqNullSafe(F.col("first")), F.lit(False)) & F.col("first").isNotNull()
    initial = F.when(F.left("role", F.lit(1)).isin("s", "u", "a"), F.left("role", F.lit(1))).otherwise(F.lit("x"))
    return d.select("conv", F.shiftright("turn", TURN_BITS).alias("bucket"), "turn", "r", "h", "copy", "gone", initial.alias("initial"),
                    "blank", again.alias("again"), "open")


_SEGMENT = "conv {0}, bucket long, cut long, rows long, first string, last string, illegal long, blank long, duplicate long, truncated long, " \
    "low long, high long, turns long, classes string, states map<string,map<string,struct<cost:long,audit:string>>>"


def _segments(kind: pa.DataType):
    names = [x.split()[0] for x in _SEGMENT.split(", ")]
    states = pa.map_(pa.string(), pa.map_(pa.string(), pa.struct([("cost", pa.int64()), ("audit", pa.string())])))
    kinds = [kind, *[pa.int64()] * 3, *[pa.string()] * 2, *[pa.int64()] * 7, pa.string(), states]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, cut, before, at = [], None, 0, None, None

        def close():
            if now is not None:
                # what is likely a conversation's first segment is solved from nothing; ``Joined`` solves it again if it is not
                starts = "0" if at[1] in (None, 0) and not cut else _STATES
                classes = "".join(now[-1])
                solved = [(q, [(e, {"cost": c, "audit": t}) for e, (c, t) in solve(classes, q).items()]) for q in starts]
                out.append([at[0], at[1], cut, *now[:-1], classes, solved])

        for batch in batches:
            for conv, bucket, turn, r, h, copy, gone, initial, blank, again, is_open in zip(*(c.to_pylist() for c in batch.columns)):
                if at != (conv, bucket):
                    close()
                    now, cut, before, at = None, 0, None, (conv, bucket)
                elif now is not None and now[0] >= SEGMENT_ROWS:
                    close()
                    now, cut = None, cut + 1
                if now is None:
                    now = [0, "", "", 0, 0, 0, 0, None, None, 0, []]
                if gone:
                    continue
                place = (turn, r, h, copy)
                # rows that repeat a row in all respects stand together and share its first place
                again = again or (place == before and not blank)
                if turn is not None:
                    now[9] += before is None or before[0] != turn
                    now[7] = turn if now[7] is None else now[7]
                    now[8] = turn
                before = place
                now[0] += 1
                now[1] = now[1] or initial
                now[3] += bool(now[2]) and now[2] + initial not in _LEGAL
                now[2] = initial
                now[4] += blank
                now[5] += again and not blank
                now[6] += is_open and not blank and not again
                now[10].append("d" if blank or again else initial.upper() if is_open else initial)
            if len(out) >= 4096:
                yield _batch(out, names, kinds)
                out = []
        close()
        if out:
            yield _batch(out, names, kinds)

    return run


def _batch(rows: list, names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


_REPORT = "conv {0}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _reports(kind: pa.DataType):
    names = [x.split()[0] for x in _REPORT.split(", ")]
    kinds = [kind, *[pa.int64()] * 6, pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, joined, sums, last, low, high, turns = [], (), None, None, "", None, None, 0

        def close():
            if joined is not None:
                gaps = high - low + 1 - turns if low is not None else 0
                out.append([at[0], gaps, *sums, *joined.result()])

        for batch in batches:
            for x in batch.to_pylist():
                if at != (x["conv"],):
                    close()
                    at, joined, sums, last, low, high, turns = (x["conv"],), Joined(), [0, 0, 0, 0], "", None, None, 0
                if not x["rows"]:
                    continue
                joined.add(x["classes"], {q: {e: (v["cost"], v["audit"]) for e, v in ends} for q, ends in x["states"]})
                for i, c in enumerate(("blank", "duplicate", "truncated", "illegal")):
                    sums[i] += x[c]
                sums[3] += bool(last) and last + x["first"] not in _LEGAL
                last = x["last"]
                if x["low"] is not None:
                    low, high = x["low"] if low is None else low, x["high"]
                    turns += x["turns"]
            if len(out) >= 4096:
                yield _batch(out, names, kinds)
                out = []
        close()
        if out:
            yield _batch(out, names, kinds)

    return run


def _repaired(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the rows that the edits leave; takes as many rows as the audit has."""
    state = "0"
    for edit in audit:
        new = "a" if state == "u" else "u"
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "K":
            state = role[0]
        elif edit != "D":
            role, state = {"u": "user", "a": "assistant"}[new], new
        if edit != "D":
            yield edit, role, text


def _followed(names: list[str], kinds: list[pa.DataType], give):
    """Rows of ``give(head, repaired rows)``: each head row (columns ``names``) is followed by its conversation's rows (role, text)."""
    n = len(names)
    audit = names.index("audit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        out, size = [], 0
        for head in rows:
            own = ((r[n], r[n + 1]) for r in islice(rows, len(head[audit]) - head[audit].count("I")))
            for row in give(head[:n], _repaired(head[audit], own)):
                out.append(row)
                size += sum(len(x) for x in row if isinstance(x, str)) + 64
                if size > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[f"c{i}" for i in range(len(kinds))])
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[f"c{i}" for i in range(len(kinds))])

    return run


def _digest(head: tuple, rows: Iterator[tuple[str, str, str]]) -> Iterator[tuple]:
    digest, joint = hashlib.sha256(), ""
    for _, role, text in rows:
        digest.update(f"{joint}{role}:{text}".encode())
        joint = "\n"
    yield (*head, digest.hexdigest())


def _listed(head: tuple, rows: Iterator[tuple[str, str, str]]) -> Iterator[tuple]:
    for i, (edit, role, text) in enumerate(rows):
        yield head[0], i, edit, role, text


def _streamed(df: DataFrame, conv_id: str, turn: str, role: str, text: str, damage: bool, give, schema: str, kinds: list) -> DataFrame:
    spark = df.sparkSession
    ship(spark)
    sql, kind = dict(df.dtypes)[conv_id], {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[dict(df.dtypes)[conv_id]]
    rows = _damaged(df, conv_id, turn, role, text, damage)
    letters = _classes(rows).repartition("conv", "bucket").sortWithinPartitions("conv", "bucket", "turn", "r", "h", "copy")
    segments = written(letters.mapInArrow(_segments(kind), _SEGMENT.format(sql)), "segments")
    reports = segments.repartition("conv").sortWithinPartitions("conv", "bucket", "cut").mapInArrow(_reports(kind), _REPORT.format(sql))
    body = rows.filter("NOT gone").select("conv", F.lit(1).alias("side"), "turn", "r", "h", "copy", "role", "text")
    both = reports.withColumn("side", F.lit(0)).unionByName(body, allowMissingColumns=True)
    names = [x.split()[0] for x in _REPORT.split(", ")]
    both = both.repartition("conv").sortWithinPartitions("conv", "side", "turn", "r", "h", "copy").select(*names, "role", "text")
    return both.mapInArrow(_followed(names, [kind, *kinds], give), schema.format(sql))


def audit(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", damage: bool = False) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: a row for each conversation.

    Null roles and texts are one space (so a null text is blank); null turns come first; rows of one turn stand by role and by the
    hash of their text; rows without a conversation id are one conversation. A role that begins with none of s, u, a (the empty
    role too) can only be given another role or deleted. Rows that repeat another in all columns are duplicates. Other columns
    are ignored; an empty table gives none. ``damage`` applies the contract's damage first; conversations that lose all rows
    are reported with zeros, an empty audit and the hash of the empty string.
    """
    schema = "conv_id {0}, " + _REPORT.split(", ", 1)[1] + ", repaired_sha256 string"
    return _streamed(df, conv_id, turn, role, text, damage, _digest, schema, [*[pa.int64()] * 6, pa.string(), pa.string()])


def repair(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, place, edit, role, text: the rows of each repaired conversation in order (edit: K kept, R given a role, I inserted)."""
    return _streamed(df, conv_id, turn, role, text, False, _listed, "conv_id {0}, place long, edit string, role string, text string",
                     [pa.int64(), pa.string(), pa.string(), pa.string()])
