"""Exponential moving averages as a two-level block scan (no per-key loop).

pandas ``ewm(span, adjust=False)`` with a = 2/(span+1), q = 1-a: the first value starts the average; a value k rows after
the last one gives  y = (q^k * y_prev + a * x) / (q^k + a);  a row without a value repeats y. With
A = q^k / (q^k + a) this is the linear recurrence  y_t = A_t * y_prev + (1 - A_t) * x_t, and rows without a value have A = 1 and
nothing to add. Without gaps k = 1 and A = q. Positions inside a partition are cut into blocks of B rows:

1. S_t = running sum of ln A in the block; in-block partial p_t = e^(S_t) * sum_{j<=t} (1-A_j) x_j e^(-S_j)
   (-S stays below B*|ln q| + 45: terms beyond a jump of 45 are under double precision and are cut there)
2. block totals E_b (the partial at its end) and P_b = e^(S at its end): unordered windows over the same (partition, block)
3. carry  Y_{b-1} = E_{b-1} + P_{b-1} * (E_{b-2} + P_{b-2} * (...)): the row B*k positions back sits in block b-k, so
   both are lags, combined by doubling until they reach over the slowest decay that gaps can cause.
4. y_t = p_t + e^(S_t) * Y_{b-1};  rows without a value take the last y.

All of it runs in Window operators over the existing hash partitioning and one sort; no join, no union, no aggregate.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.panel import BLK, BLOCK as BLOCK_P, LP, Panel, col, ema_memory

BLOCK = BLOCK_P
_UNB = Window.unboundedPreceding


def _alpha(span: float) -> float:
    return 2.0 / (span + 1.0)


def slowest_decay(span: float) -> float:
    """Least -ln A per row over all gap lengths: how fast an average surely forgets."""
    a = _alpha(span)
    q = 1.0 - a
    if q <= 0:
        return math.inf
    top = int(8 / a) + 2
    return min(math.log1p(a * q ** -k) / k for k in range(1, min(top, 5000)))


def carry_blocks(span: float, block: int = BLOCK, tol: float = 1e-12) -> int:
    """Blocks of history needed before the carry is surely below ``tol`` relative, whatever the gaps."""
    rate = slowest_decay(span)
    return 1 if math.isinf(rate) else max(1, math.ceil(-math.log(tol) / (rate * block)) + 1)


def _carried(d: DataFrame, blocks: dict[str, int], block: int, w) -> tuple[DataFrame, dict, list[str]]:
    """(frame, carry of each name, helper columns) from the block totals ``_e_`` and ``_g_``; each level doubles the reach of all."""
    made: list[str] = []
    at = {n: n for n in blocks}
    for j in range(math.ceil(math.log2(max(blocks.values(), default=1)))):
        level = {}
        for n, need in blocks.items():
            if (1 << j) < need:
                e, g, back = "_e_" + at[n], "_g_" + at[n], block << j
                level |= {f"_e_{j}_{n}": F.col(e) + F.col(g) * F.coalesce(F.lag(e, back).over(w), F.lit(0.0)),
                          f"_g_{j}_{n}": F.col(g) * F.coalesce(F.lag(g, back).over(w), F.lit(0.0))}
        d = d.withColumns(level)
        at |= {n: f"{j}_{n}" for n, need in blocks.items() if (1 << j) < need}
        made += list(level)
    return d, {n: F.coalesce(F.lag("_e_" + at[n], block).over(w), F.lit(0.0)) for n in blocks}, made


def ema_columns(df: DataFrame, panel: Panel, specs: dict[str, tuple[str, float]],
                block: int = BLOCK) -> DataFrame:
    """Add one EMA column per ``name -> (source column, span)``; all share one block pass.

    ``df`` must carry ``_rn`` (``panel.prepare``). NULL and NaN values are gaps, as in pandas. A sharded panel whose halo is
    shorter than an average's memory is refused: its values would be cut.
    """
    if not specs:
        return df
    p = panel
    if p.sharded:
        longest = max(ema_memory(s, 1e-12) for _, s in specs.values())
        if longest > p.halo_back:
            raise ValueError(f"an average over these spans reaches back {longest} rows; halo_back is {p.halo_back}")
    base = list(df.columns)
    d = df if LP in df.columns else p.add_positions(df)
    if block != BLOCK_P:
        raise ValueError(f"block size must be the panel block {BLOCK_P}")
    w_run = Window.partitionBy(*p.part, BLK).orderBy(LP).rowsBetween(_UNB, 0)
    w_blk = Window.partitionBy(*p.part, BLK)
    w_lag = Window.partitionBy(*p.part).orderBy(BLK, LP)   # = the positional panel order
    sources = {src: i for i, src in enumerate(dict.fromkeys(src for src, _ in specs.values()))}
    x = {src: F.when(~F.isnan(col(src).cast("double")), col(src).cast("double")) for src in sources}
    last = {src: F.last(F.when(x[src].isNotNull(), F.col(LP)), ignorenulls=True).over(w_lag.rowsBetween(_UNB, -1)) for src in sources}
    d = d.withColumns({f"_k_{i}": F.col(LP) - last[src] for src, i in sources.items()})
    decay, partial, total, cols, tmp = {}, {}, {}, {}, [f"_k_{i}" for i in sources.values()]
    cols |= {f"_y_{n}": x[src] for n, (src, span) in specs.items() if span <= 1}  # span 1: the value itself
    tmp += list(cols)
    every, specs = specs, {n: v for n, v in specs.items() if v[1] > 1}
    for name, (src, span) in specs.items():
        a = _alpha(span)
        # -ln A = ln(1 + a / q^k)
        k = F.col(f"_k_{sources[src]}").cast("double")
        step = F.when(k == 1, F.lit(math.log(1.0 - a))).otherwise(
            -F.log1p(F.lit(a) * F.exp(F.least(k * F.lit(-math.log(1.0 - a)), F.lit(200.0)))))
        decay[f"_a_{name}"] = F.when(x[src].isNull() | k.isNull(), F.lit(0.0)).otherwise(F.greatest(step, F.lit(-45.0)))
        tmp += [f"_a_{name}", f"_s_{name}", f"_p_{name}", f"_e_{name}", f"_g_{name}"]
    d = d.withColumns(decay)
    d = d.withColumns({f"_s_{n}": F.sum(f"_a_{n}").over(w_run) for n in specs})
    for name, (src, _) in specs.items():
        first = F.col(f"_k_{sources[src]}").isNull()
        part = F.when(first, F.lit(1.0)).otherwise(-F.expm1(f"_a_{name}"))
        v = F.coalesce(part * x[src], F.lit(0.0)) * F.exp(-F.col(f"_s_{name}"))
        partial[f"_p_{name}"] = F.exp(f"_s_{name}") * F.sum(v).over(w_run)
        end = F.sum(f"_a_{name}").over(w_blk)
        total |= {f"_e_{name}": F.exp(end) * F.sum(v).over(w_blk), f"_g_{name}": F.exp(end)}
    d = d.withColumns(partial).withColumns(total)
    d, carry, made = _carried(d, {n: carry_blocks(span, block) for n, (_, span) in specs.items()}, block, w_lag)
    tmp += made
    for name, (src, span) in specs.items():
        y = F.col(f"_p_{name}") + F.exp(f"_s_{name}") * carry[name]
        cols[f"_y_{name}"] = F.when(x[src].isNotNull(), y)
        tmp.append(f"_y_{name}")
    d = d.withColumns(cols)
    d = d.withColumns({n: F.last(f"_y_{n}", ignorenulls=True).over(w_lag.rowsBetween(_UNB, 0)) for n in every}).drop(*tmp)
    return d.select(*base, *[c for c in every if c not in base])


def ema(df: DataFrame, panel: Panel | None = None, col_name: str = "close", period: int = 20,
        fillna: bool = True, out: str | None = None) -> DataFrame:
    """W11 standalone EMA (``fillna`` keeps the source value where the EMA is NULL)."""
    panel = panel or Panel()
    out = out or f"ema_{period}"

    def run(d, panel):
        d = ema_columns(d, panel, {out: (col_name, period)})
        if fillna:
            d = d.withColumn(out, F.coalesce(F.col(out), F.col(col_name)))
        return d
    return _with_panel(df, panel, run, positional=True)


def _with_panel(df: DataFrame, panel: Panel, fn, positional: bool = False):
    """Run ``fn(prepared_df, panel)``; see ``Panel.run``."""
    return panel.run(df, fn, positional)
