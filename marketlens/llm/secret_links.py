"""Operator 5 [native]: secrets and multipart credentials, with built-in functions only.

Strong patterns are reported wherever they match. Weak ones (account names, random-looking tokens, addresses) are parts of
a credential, and a part is reported only if a part that completes it stands within a scope of 200 code points: a name or an
address needs a secret, a secret needs a name or an address. Strong spans count as parts too.

Texts are scanned in place; only those with a match go on, as (hash of the text, kind, lengths of gaps and matches). Positions
are running sums of those lengths. The interval join cuts positions into bins as wide as a scope: each bin keeps
its first and last position of each part, and a candidate looks up its own bin and the two beside it, so it meets
three rows whatever the number of parts, and no pairs are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import text_of, written

SCOPE = 200
#: Strong patterns, in the order in which kinds are listed. Matches that fail _strong are dropped.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
STRONG = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
#: Weak patterns, listed after the strong ones: parts of a credential.
WEAK = {
    "name": r"""(?i)(?:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""",
    "key": r"""(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{16,}""",
    "address": r"""(?i)(?:\b[a-z][a-z0-9+.-]{1,20}://[^\s"'<>]+|\b(?:host|endpoint|server|url)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.:/_-]{3,})""",
}
KINDS = [*STRONG, *WEAK]
#: The part that each kind is: 0 a name, 1 a secret, 2 an address.
PART = {"assign": 1, "access": 0, "hex": 1, "name": 0, "key": 1, "address": 2}
EMPTY_SHA = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def _marks(text: Column, pattern: str) -> Column:
    """Array of (gap, size, ok) for each match in order: code points before it since the last one, its own, and if it counts."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if pattern == ASSIGN:
        sizes = F.transform(found, lambda m: F.struct(F.length(m).alias("n"), (F.length(F.regexp_extract(m, pattern, 2)) >= 6).alias("ok")))
    else:
        sizes = F.transform(found, lambda m: F.struct(F.length(m).alias("n"), F.lit(True).alias("ok")))
    both = F.zip_with(gaps, sizes, lambda g, m: F.struct(g.alias("gap"), m["n"].alias("n"), m["ok"].alias("ok")))
    return F.when(text.rlike(pattern), F.filter(both, lambda m: m["n"].isNotNull()))


def _spans(df: DataFrame) -> DataFrame:
    """h, kind (number), start, end of every strong and weak match of the distinct texts (column t, its hash h)."""
    kinds = {**STRONG, **WEAK}
    marks = F.filter(F.array(*[F.struct(F.lit(i).alias("kind"), _marks(F.col("t"), p).alias("m")) for i, p in enumerate(kinds.values())]),
                     lambda x: x["m"].isNotNull())
    found = df.select("h", marks.alias("marks")).filter(F.size("marks") > 0)
    found = found.groupBy("h").agg(F.first("marks").alias("marks"))  # equal texts have equal marks
    flat = found.select("h", F.explode("marks").alias("x")).select("h", "x.kind", F.posexplode("x.m").alias("pos", "m"))
    before = Window.partitionBy("h", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    at = flat.withColumn("end", F.sum(F.col("m.gap") + F.col("m.n")).over(before))
    return at.filter("m.ok").select("h", "kind", (F.col("end") - F.col("m.n")).alias("start"), "end")


def _linked(spans: DataFrame, scope: int) -> DataFrame:
    """Weak spans that stand within ``scope`` of a completing part and touch no strong span."""
    part = F.element_at(F.array(*[F.lit(PART[k]) for k in KINDS]), F.col("kind") + 1)
    p = spans.withColumn("part", part).withColumn("bin", F.floor(F.col("start") / scope))
    side = F.when(F.col("part") == 1, 1).otherwise(0)  # secrets complete names and addresses, and the other way round
    bins = p.withColumn("side", side).groupBy("h", "bin", "side").agg(F.min("start").alias("lo"), F.max("start").alias("hi"))
    weak = p.filter(F.col("kind") >= len(STRONG)).withColumn("need", 1 - side)
    near = weak.withColumn("there", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)))
    b = bins.select(F.col("h").alias("h2"), F.col("bin").alias("bin2"), "side", "lo", "hi")
    met = near.join(b, (F.col("h") == F.col("h2")) & (F.col("there") == F.col("bin2")) & (F.col("need") == F.col("side")))
    inside = F.when(F.col("there") == F.col("bin"), True).when(F.col("there") < F.col("bin"), F.col("start") - F.col("hi") <= scope) \
        .otherwise(F.col("lo") - F.col("start") <= scope)
    met = met.filter(inside).select("h", "kind", "start", "end").distinct()
    # strong spans that end after all earlier starts: the greatest end so far tells whether a weak span is covered
    order = Window.partitionBy("h").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("h").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    strong = F.col("kind") < len(STRONG)
    both = spans.filter(strong).unionByName(met)
    both = both.withColumn("over", F.max(F.when(strong, F.col("end"))).over(order)) \
        .withColumn("next", F.min(F.when(strong, F.col("start"))).over(later))
    free = (F.coalesce("over", F.lit(0)) <= F.col("start")) & (F.coalesce("next", F.lit(1 << 62)) >= F.col("end"))
    return both.filter(~strong & free).select("h", "kind", "start", "end")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def _count(kind: int) -> Column:
    return F.size(F.filter("s", lambda s: s["kind"] == kind)).cast("long")


def secrets(df: DataFrame, id_col: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked for each row.

    Counts and base_sha256 are of the strong spans; spans also has the linked weak ones (n_linked of them), as
    kind:start:end in code points, end exclusive, by start, then kind. Null texts count as empty and have none; repeated rows are
    reported each, null ids as null; other columns are ignored; an empty table gives none.
    """
    t = df.select(F.col(id_col).alias("doc_id"), text_of(text).alias("t")).withColumn("h", F.unhex(F.md5(F.col("t").cast("binary"))))
    spans = written(_spans(t), "marks")  # read several times below, the texts only once
    every = spans.filter(F.col("kind") < len(STRONG)).unionByName(_linked(spans, scope))
    per = every.groupBy("h").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("s"))
    base = F.filter("s", lambda s: s["kind"] < len(STRONG))
    count = [_count(i).alias(f"n_{k}") for i, k in enumerate(STRONG)]
    per = per.select("h", *count, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("s")).alias("spans"),
                     (F.size("s") - F.size(base)).cast("long").alias("n_linked"))
    out = t.select("doc_id", "h").join(per, "h", "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_assign", "n_access", "n_hex")]
    return out.select("doc_id", *zero, F.coalesce("base_sha256", F.lit(EMPTY_SHA)).alias("base_sha256"),
                      F.coalesce("spans", F.lit("")).alias("spans"), F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"))
