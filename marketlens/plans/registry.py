"""Registered queries: one per SURVEY section 2 operator, each with its oracle SQL.

Every callable takes (spark, sf_dir) and returns a lazy DataFrame over the
driver's tables.  Doubles are rounded to 4 places on both sides so the value
hash compares results, not floating-point noise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def fixed_round(c, places: int = 4):
    """Round half away from zero on the binary value: the same IEEE steps as the SQL side.

    A nudge of 1e-3 of the last place breaks exact decimal ties (sums of cents
    over 20 rows land on x.xxxx5) the same way whatever the summation order.
    """
    k = float(10 ** places)
    return F.signum(c) * F.floor(F.abs(c) * F.lit(k) + F.lit(0.501)).cast("double") / F.lit(k) + F.lit(0.0)


def rounded(df: DataFrame, places: int = 4, coarse: dict[str, int] | None = None) -> DataFrame:
    """Round every double column (the oracle SQL applies the same rounding).

    ``coarse`` gives fewer places for large-magnitude sums whose last digits
    depend on summation order.
    """
    coarse = coarse or {}
    return df.select(*[
        fixed_round(F.col(f.name), coarse.get(f.name, places)).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def load_all() -> None:
    """Import the modules that register queries."""
    from marketlens.plans import q_indicators, q_data, q_features, q_text, q_analytics, q_models, q_stream, q_io  # noqa: F401
