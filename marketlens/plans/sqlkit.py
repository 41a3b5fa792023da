"""Builders for the DuckDB oracle SQL (independent of the Spark plans).

Only strings are produced here; the driver runs them on its DuckDB views.
"""

from __future__ import annotations

BARS = """bars AS (
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
         CAST(count(*) AS DOUBLE) AS volume
  FROM orders GROUP BY 1, 2)"""

B = "b AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS rn FROM bars)"

# level series (FIXTURES 6): 100 * exp(running sum of 0.005 * z(close))
LEVEL = """lstat AS (SELECT avg(close) AS m, stddev_samp(close) AS s FROM bars),
lraw AS (
  SELECT symbol, date, volume,
         100.0 * exp(sum(0.005 * (close - m) / s) OVER (PARTITION BY symbol ORDER BY date
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS close
  FROM bars, lstat),
lo AS (SELECT *, coalesce(lag(close) OVER (PARTITION BY symbol ORDER BY date), close) AS open FROM lraw),
lvl AS (SELECT symbol, date, open, greatest(open, close) * 1.002 AS high,
               least(open, close) * 0.998 AS low, close, volume FROM lo),
lb AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS rn FROM lvl)"""


def W(part: str = "symbol", order: str = "date", frame: str | None = None) -> str:
    f = f" {frame}" if frame else ""
    return f"OVER (PARTITION BY {part} ORDER BY {order}{f})"


def rows(n: int) -> str:
    return f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"


def roll(fn: str, x: str, n: int, part: str = "symbol", order: str = "date") -> str:
    w = W(part, order, rows(n))
    return f"(CASE WHEN count({x}) {w} = {n} THEN {fn}({x}) {w} END)"


def lag(x: str, k: int = 1, part: str = "symbol", order: str = "date") -> str:
    return f"lag({x}, {k}) {W(part, order)}"


def lead(x: str, k: int = 1, part: str = "symbol", order: str = "date") -> str:
    return f"lead({x}, {k}) {W(part, order)}"


def div(a: str, b: str) -> str:
    return f"(({a}) / nullif({b}, 0))"


def R(expr: str, name: str, places: int = 4) -> str:
    """Round half away from zero on the binary value (same IEEE steps as the Spark side)."""
    k = float(10 ** places)
    v = f"CAST({expr} AS DOUBLE)"
    return f"CAST(sign({v}) * floor(abs({v}) * {k!r} + 0.501) / {k!r} + 0.0 AS DOUBLE) AS {name}"


def ema(name: str, src: str, x: str, spans: dict[str, float], part: str = "symbol") -> str:
    """Recursive CTE computing EMAs (adjust=False, y0 = x0) of ``x`` over ``src`` (needs rn)."""
    seeds = ", ".join(f"CAST({x} AS DOUBLE) AS {o}" for o in spans)
    steps = ", ".join(f"{1 - 2.0 / (s + 1)!r} * e.{o} + {2.0 / (s + 1)!r} * s.{x} AS {o}"
                      for o, s in spans.items())
    return (f"{name} AS (SELECT {part}, rn, {seeds} FROM {src} WHERE rn = 0 "
            f"UNION ALL SELECT s.{part}, s.rn, {steps} FROM {name} e JOIN {src} s "
            f"ON s.{part} = e.{part} AND s.rn = e.rn + 1)")
