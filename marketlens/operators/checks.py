"""Data contracts and profiles: V1-V7, A5-A9.

A contract is a set of column rules compiled to boolean/count expressions and
evaluated in ONE grouped aggregate per key (plus one pass for quartile-based
outliers).  Reports are DataFrames - one row per key - so thousands of
symbols are validated by one job, never by a driver loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.operators.quantiles import exact_quantiles

NUMERIC = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.DecimalType)


def _is_num(dt) -> bool:
    return isinstance(dt, NUMERIC)


def iqr_bounds(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), k: float = 1.5,
               exact: bool = True) -> DataFrame:
    """Per-key (or global) Q1 - k*IQR / Q3 + k*IQR for each column.

    Quartiles are exact (linear interpolation) and counted by rank in rounds; ``exact=False`` takes
    one ``percentile_approx`` sketch instead.
    """
    if exact:
        b = exact_quantiles(df, cols, (0.25, 0.75), keys)
    else:
        b = df.groupBy(*keys).agg(*[F.percentile_approx(c, p, 10000).alias(f"q_{c}_{j}") for c in cols for j, p in enumerate((0.25, 0.75))])

    def fence(c: str, j: int, sign: int) -> Column:
        return F.col(f"q_{c}_{j}") + F.lit(sign * k) * (F.col(f"q_{c}_1") - F.col(f"q_{c}_0"))
    return b.select(*keys, *[x for c in cols for x in (fence(c, 0, -1).alias(f"_lo_{c}"), fence(c, 1, 1).alias(f"_hi_{c}"))])


def _attach(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach per-key statistics (one row per key) - a keyed join the planner sizes."""
    if keys:
        return df.join(stats, list(keys), "left")
    # global statistics: a single aggregate row, fetched once
    row = stats.first()
    return df.withColumns({c: F.lit(row[c]) for c in stats.columns})


def iqr_outliers(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), k: float = 1.5,
                 exact: bool = True) -> DataFrame:
    """Rows where any column is outside the IQR fences (flag column ``is_outlier``)."""
    d = _attach(df, iqr_bounds(df, cols, keys, k, exact), keys)
    flag = F.lit(False)
    for c in cols:
        flag = flag | F.coalesce((F.col(c) < F.col(f"_lo_{c}")) | (F.col(c) > F.col(f"_hi_{c}")), F.lit(False))
    return d.withColumn("is_outlier", flag).drop(*[f"_{s}_{c}" for c in cols for s in ("lo", "hi")])


def zscore_outliers(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), z: float = 3.0) -> DataFrame:
    """Rows where any |x - mean| / std (ddof 1) exceeds ``z``."""
    st = df.groupBy(*keys).agg(*[x for c in cols for x in (F.avg(c).alias(f"_m_{c}"),
                                                           F.stddev_samp(c).alias(f"_s_{c}"))])
    d = _attach(df, st, keys)
    flag = F.lit(False)
    for c in cols:
        zc = F.abs(F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")
        flag = flag | F.coalesce(zc > z, F.lit(False))
    return d.withColumn("is_outlier", flag).drop(*[f"_{s}_{c}" for c in cols for s in ("m", "s")])


def _report(d: DataFrame, keys, warn: list[tuple[Column, Column]], err: list[tuple[Column, Column]]) -> DataFrame:
    """Assemble warnings / errors arrays from (condition, message) pairs."""
    def arr(pairs):
        return F.filter(F.array(*[F.when(c, m) for c, m in pairs]), lambda x: x.isNotNull()) if pairs \
            else F.array().cast("array<string>")
    d = d.withColumns({"warnings": arr(warn), "errors": arr(err)})
    return d.withColumns({"n_warnings": F.size("warnings"), "n_errors": F.size("errors"),
                          "is_valid": F.size("errors") == 0})


def _typed(df: DataFrame, numeric: Sequence[str]) -> tuple[DataFrame, Column]:
    """The frame with ``numeric`` columns as doubles (whatever is no number becomes NULL) and the count of such cells."""
    present = [c for c in numeric if c in df.columns]
    text = [c for c in present if not _is_num(df.schema[c].dataType)]
    d = df.withColumns({f"_raw_{c}": F.col(c) for c in text}).withColumns(
        {c: F.expr(f"try_cast(`{c}` AS double)") for c in text})
    bad = sum([F.count_if(F.col(f"_raw_{c}").isNotNull() & F.col(c).isNull()) for c in text] or [F.lit(0)])
    return d, bad.cast("long").alias("not_numbers")


def _grouped(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """A key column that is absent is reported, and all rows are one group under a NULL key."""
    gone = [k for k in keys if k not in df.columns]
    return df.withColumns({k: F.lit(None).cast("string") for k in gone}), gone


def _cells(cols: Sequence[str], rule) -> Column:
    """Number of cells of ``cols`` for which the rule holds."""
    return sum([F.count_if(rule(F.col(c))) for c in cols] or [F.lit(0)]).cast("long")


def _schema_errors(missing: Sequence[str]) -> list[tuple[Column, Column]]:
    out = [(F.col("not_numbers") > 0, F.format_string("schema: %d cells are not numbers", F.col("not_numbers")))]
    if missing:
        out.append((F.lit(True), F.lit("schema: no column " + ", ".join(missing))))
    return out


def _day_steps(days: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys and _has_step for the groups with rows on two days that follow one another.

    Each day is put down for itself and for the day after; a day put down both ways ends a step. Two aggregates that combine
    before the shuffle, so a group of many rows is in no single task.
    """
    marks = F.array(F.struct(F.col("_day").alias("day"), F.lit(0).alias("after")), F.struct(F.date_add("_day", 1).alias("day"), F.lit(1).alias("after")))
    d = days.where("_day IS NOT NULL").distinct().select(*keys, F.explode(marks).alias("m"))
    both = d.groupBy(*keys, "m.day").agg(F.min("m.after").alias("lo"), F.max("m.after").alias("hi")).where("lo < hi")
    return both.groupBy(*keys).agg(F.lit(1).alias("_has_step"))


def stock_contract(df: DataFrame, keys: Sequence[str] = ("symbol",), ts: str = "date",
                   exact_quartiles: bool = True, symbol: str = "symbol") -> DataFrame:
    """V1 per key: schema errors, high<low, zero volume > 10 %, nulls, IQR outliers, no 1-day step.

    Missing columns, and cells that are no numbers, are errors of the report; nothing is raised. The length rule
    is about the ``symbol`` column, whatever the report is grouped by.
    """
    cols = ["open", "high", "low", "close", "volume"]
    present = [c for c in cols if c in df.columns]
    df, gone = _grouped(df, keys)
    missing = [c for c in (*cols, ts, *([symbol] if symbol not in keys else [])) if c not in df.columns] + gone
    df, not_numbers = _typed(df, present)
    out_cols = [c for c in ("close", "volume") if c in present]
    d = iqr_outliers(df, out_cols, keys, exact=exact_quartiles) if out_cols else df.withColumn("is_outlier", F.lit(False))
    if ts in df.columns:
        at = F.col(ts) if dict(df.dtypes)[ts] in ("date", "timestamp", "timestamp_ntz") else F.expr(f"try_cast(`{ts}` AS timestamp)")
        steps = _day_steps(df.select(*keys, F.to_date(at).alias("_day")), keys)
    else:
        steps = None
    sym = F.col(symbol).cast("string") if symbol in df.columns else None
    bad_symbol = F.count_if(sym.isNull() | (F.length(sym) < 1) | (F.length(sym) > 5)) if sym is not None and symbol not in gone else F.lit(0)
    g = d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), not_numbers,
        (F.count_if(F.col("high") < F.col("low")) if {"high", "low"} <= set(present) else F.lit(0)).cast("long").alias("high_lt_low"),
        (F.count_if(F.col("volume") == 0) if "volume" in present else F.lit(0)).cast("long").alias("zero_volume"),
        _cells(present, lambda c: c.isNull()).alias("null_cells"),
        F.count_if(F.col("is_outlier")).cast("long").alias("outliers"),
        _cells(present, lambda c: c < 0).alias("negative_values"),
        bad_symbol.cast("long").alias("bad_symbol"))
    if steps is not None:
        same = F.lit(True)
        for k in keys:
            same = same & F.col(f"g.{k}").eqNullSafe(F.col(f"s.{k}"))
        g = g.alias("g").join(steps.alias("s"), same, "left").select("g.*", F.coalesce("s._has_step", F.lit(0)).alias("_has_step"))
    else:
        g = g.withColumn("_has_step", F.lit(0))
    n = F.col("n_rows")
    warn = [(F.col("high_lt_low") > 0, F.format_string("high below low: %d rows", F.col("high_lt_low"))),
            (F.col("zero_volume") > n * 0.1, F.format_string("volume is zero: %d rows", F.col("zero_volume"))),
            (F.col("null_cells") > 0, F.format_string("empty cells: %d", F.col("null_cells"))),
            (F.col("outliers") > 0, F.format_string("close or volume outside the quartile fences: %d rows", F.col("outliers"))),
            ((n > 1) & (F.col("_has_step") == 0), F.lit("no two rows are one day apart"))]
    err = [(F.col("negative_values") > 0, F.format_string("schema: %d cells below zero", F.col("negative_values"))),
           (F.col("bad_symbol") > 0, F.lit("schema: a symbol needs 1 to 5 characters")), *_schema_errors(missing)]
    return _report(g, keys, warn, err).drop("_has_step")


def forex_contract(df: DataFrame, keys: Sequence[str] = ("pair",), pair: str = "pair") -> DataFrame:
    """V2 per pair: non-null OHLC >= 0, pair length 6; W high<low, close outside 0.01-500, nulls; schema errors as in V1."""
    cols = ["open", "high", "low", "close"]
    ohlc = [c for c in cols if c in df.columns]
    df, gone = _grouped(df, keys)
    missing = [c for c in (*cols, *([pair] if pair not in keys else [])) if c not in df.columns] + gone
    df, not_numbers = _typed(df, ohlc)
    name = F.col(pair).cast("string") if pair in df.columns and pair not in gone else None
    g = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), not_numbers,
        (F.count_if(F.col("high") < F.col("low")) if {"high", "low"} <= set(ohlc) else F.lit(0)).cast("long").alias("high_lt_low"),
        (F.count_if((F.col("close") < 0.01) | (F.col("close") > 500)) if "close" in ohlc else F.lit(0)).cast("long").alias("unusual_close"),
        _cells(ohlc, lambda c: c.isNull()).alias("null_cells"),
        _cells(ohlc, lambda c: c < 0).alias("negative_values"),
        (F.count_if(name.isNull() | (F.length(name) != 6)) if name is not None else F.lit(0)).cast("long").alias("bad_pair"))
    warn = [(F.col("high_lt_low") > 0, F.format_string("high below low: %d rows", F.col("high_lt_low"))),
            (F.col("unusual_close") > 0, F.format_string("close outside 0.01 to 500: %d rows", F.col("unusual_close"))),
            (F.col("null_cells") > 0, F.format_string("empty cells: %d", F.col("null_cells")))]
    err = [(F.col("negative_values") + F.col("null_cells") > 0, F.lit("schema: prices must be given and not below zero")),
           (F.col("bad_pair") > 0, F.lit("schema: a pair needs 6 characters")), *_schema_errors(missing)]
    return _report(g, keys, warn, err)


def crypto_contract(df: DataFrame, keys: Sequence[str] = ("coin_id",), exact_quartiles: bool = True) -> DataFrame:
    """V3 per coin: E negative values, E price <= 0, W price outliers, W nulls; schema errors as in V1."""
    df, gone = _grouped(df, keys)
    num = [c for c in ("price", "market_cap", "volume") if c in df.columns]
    missing = [c for c in ("price",) if c not in df.columns] + gone
    df, not_numbers = _typed(df, num)
    d = iqr_outliers(df, ["price"], keys, exact=exact_quartiles) if "price" in num else df.withColumn("is_outlier", F.lit(False))
    g = d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), not_numbers,
        (F.count_if(F.col("price") <= 0) if "price" in num else F.lit(0)).cast("long").alias("non_positive_price"),
        _cells(num, lambda c: c < 0).alias("negative_values"),
        F.count_if(F.col("is_outlier")).cast("long").alias("outliers"),
        _cells(num, lambda c: c.isNull()).alias("null_cells"))
    warn = [(F.col("outliers") > 0, F.format_string("price outside the quartile fences: %d rows", F.col("outliers"))),
            (F.col("null_cells") > 0, F.format_string("empty cells: %d", F.col("null_cells")))]
    err = [(F.col("negative_values") > 0, F.lit("schema: cells below zero")),
           (F.col("non_positive_price") > 0, F.format_string("price is zero or less: %d rows", F.col("non_positive_price"))),
           *_schema_errors(missing)]
    return _report(g, keys, warn, err)


def news_contract(df: DataFrame, as_of=None, date_col: str = "publishedAt", keys: Sequence[str] = ()) -> DataFrame:
    """V4 over all articles (or per key): required fields, empty titles, future and unparseable dates; missing columns are errors."""
    as_of = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    missing = [c for c in ("title", "url", date_col) if c not in df.columns]
    given = [c for c in df.columns if c not in keys]
    df = df.withColumns({c: F.lit(None).cast("string") for c in missing})
    raw = F.col(date_col)
    parsed = raw if dict(df.dtypes).get(date_col, "").startswith("timestamp") else F.try_to_timestamp(raw.cast("string"))
    required = [F.col(c).isNull() for c in ("title", "url", date_col) if c not in missing]
    lacking = F.lit(False)
    for r in required:
        lacking = lacking | r
    g = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(0).cast("long").alias("not_numbers"),
        F.count_if(lacking).cast("long").alias("missing_required"),
        F.count_if(F.trim(F.col("title")) == "").cast("long").alias("empty_titles"),
        F.count_if(parsed > as_of).cast("long").alias("future_dates"),
        F.count_if(raw.isNotNull() & parsed.isNull()).cast("long").alias("unparseable_dates"),
        _cells(given, lambda c: c.isNull()).alias("null_cells"))
    warn = [(F.col("empty_titles") > 0, F.format_string("blank titles: %d", F.col("empty_titles"))),
            (F.col("future_dates") > 0, F.format_string("dated after the check: %d articles", F.col("future_dates"))),
            (F.col("null_cells") > 0, F.format_string("empty cells: %d", F.col("null_cells")))]
    err = [(F.col("missing_required") > 0, F.format_string("without title, url or date: %d articles", F.col("missing_required"))),
           (F.col("unparseable_dates") > 0, F.format_string("dates that cannot be read: %d", F.col("unparseable_dates"))),
           *_schema_errors(missing)]
    return _report(g, keys, warn, err)


def date_range_check(df: DataFrame, date_col: str, start=None, end=None) -> DataFrame:
    """V5: min/max of a date column against [start, end]; missing or unparseable -> invalid."""
    if date_col not in df.columns:
        return df.sparkSession.createDataFrame(
            [(0, None, None, [f"no column {date_col}"], False)],
            "n_rows bigint, min_date timestamp, max_date timestamp, errors array<string>, is_valid boolean")
    t = F.try_to_timestamp(F.col(date_col).cast("string"))
    g = df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(t).alias("min_date"), F.max(t).alias("max_date"),
               F.count_if(F.col(date_col).isNotNull() & t.isNull()).alias("_bad"))
    errs = [(F.col("_bad") > 0, F.lit("dates that cannot be read"))]
    if start is not None:
        errs.append((F.col("min_date") < F.lit(start).cast("timestamp"), F.lit(f"first date is before {start}")))
    if end is not None:
        errs.append((F.col("max_date") > F.lit(end).cast("timestamp"), F.lit(f"last date is after {end}")))
    arr = F.filter(F.array(*[F.when(c, m) for c, m in errs]), lambda x: x.isNotNull())
    return g.select("n_rows", "min_date", "max_date", arr.alias("errors"), (F.size(arr) == 0).alias("is_valid"))


def completeness_check(df: DataFrame, required: Sequence[str], min_rows: int = 0) -> DataFrame:
    """V6: missing required columns and a minimum row count."""
    missing = [c for c in required if c not in df.columns]
    g = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return g.select("n_rows", F.lit(len(missing)).alias("missing_columns"),
                    F.array(*[F.lit(c) for c in missing]).cast("array<string>").alias("missing"),
                    ((F.lit(len(missing)) == 0) & (F.col("n_rows") >= min_rows)).alias("is_valid"))


CONTRACTS = {"stocks": stock_contract, "forex": forex_contract, "crypto": crypto_contract, "news": news_contract}


def validate(df: DataFrame, data_type: str, **kw) -> DataFrame:
    """V7: dispatch by data type; unknown types give an error report row."""
    fn = CONTRACTS.get(data_type)
    if fn is None:
        return df.sparkSession.createDataFrame(
            [([f"no contract for {data_type}"], False)], "errors array<string>, is_valid boolean")
    return fn(df, **kw)


def validate_files(spark, path: str, data_type: str = "stocks", **kw) -> DataFrame:
    """One scan of every Parquet file under ``path``; one report row per file (its path is the key ``file``).

    Partition folders (``symbol=AAA``) count as columns. A tree without files, or a path that does not exist, gives
    one error row; any other failure to read is raised.
    """
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([(path, 0, [], [f"no files under {path}"], 0, 1, False)],
                                     "file string, n_rows long, warnings array<string>, errors array<string>, "
                                     "n_warnings int, n_errors int, is_valid boolean")
    return CONTRACTS[data_type](df.withColumn("file", F.col("_metadata.file_path")), keys=("file",), **kw)


def validation_summary(reports: DataFrame) -> DataFrame:
    """Total / passed / failed / success rate / warnings / errors over report rows."""
    return reports.agg(
        F.count(F.lit(1)).alias("total_validations"),
        F.count_if(F.col("is_valid")).alias("passed"),
        F.count_if(~F.col("is_valid")).alias("failed"),
        (F.lit(100.0) * F.count_if(F.col("is_valid")) / F.count(F.lit(1))).alias("success_rate"),
        F.sum(F.size("warnings")).cast("long").alias("total_warnings"),
        F.sum(F.size("errors")).cast("long").alias("total_errors"))


def _distinct_counts(df: DataFrame) -> DataFrame:
    """i, unique_values: distinct values of every column, exactly, in one pass.

    Each row gives its columns' 128-bit hashes, one short row a column; these are made distinct before and after a shuffle by
    (column, hash), so neither a column nor a value is one task's, and then counted by column. (A ``count(DISTINCT)`` of each column
    in one aggregate would copy the row whole for every column.)
    """
    cells = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        c = c + F.lit(0).cast(f.dataType) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else c  # -0.0 is 0.0
        cells.append(F.when(c.isNotNull(), F.struct(F.lit(i).alias("i"), F.xxhash64(c).alias("h1"), F.xxhash64(F.lit(_SECOND), c).alias("h2"))))
    rows = df.select(F.explode(F.array_compact(F.array(*cells))).alias("c")).select("c.i", "c.h1", "c.h2")
    return rows.distinct().groupBy("i").agg(F.count(F.lit(1)).alias("unique_values"))


#: Seed of the second hash.
_SECOND = 0x5BD1E995


def profile(df: DataFrame, exact_distinct: bool = True) -> DataFrame:
    """A5: per-column dtype, non-null / null counts, null %, min, max, mean, std, distinct.

    One aggregate computes the statistics of every column; distinct values are counted by ``_distinct_counts``, or, with
    ``exact_distinct=False``, by the sketches of ``profile_state``.
    """
    if not exact_distinct:
        return profile_of(profile_state(df))
    aggs, rows = [], []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        num = _is_num(f.dataType)
        aggs += [F.count(c).alias(f"nn{i}"),
                 (F.min(c).cast("double") if num else F.lit(None).cast("double")).alias(f"mi{i}"),
                 (F.max(c).cast("double") if num else F.lit(None).cast("double")).alias(f"ma{i}"),
                 (F.avg(c) if num else F.lit(None)).cast("double").alias(f"me{i}"),
                 (F.stddev_samp(c) if num else F.lit(None)).cast("double").alias(f"sd{i}")]
        rows.append(f"{i}, '{f.name}', '{f.dataType.simpleString()}', nn{i}, _n - nn{i}, mi{i}, ma{i}, me{i}, sd{i}")
    wide = df.agg(*aggs, F.count(F.lit(1)).alias("_n"))
    long = wide.selectExpr("_n", f"stack({len(rows)}, {', '.join(rows)}) AS (i, column, dtype, non_null_count, null_count, min, max, mean, std)")
    long = long.join(_distinct_counts(df), "i", "left")  # a row for each column
    return _profile_columns(long.withColumn("unique_values", F.coalesce("unique_values", F.lit(0).cast("long"))))


def _profile_columns(long: DataFrame) -> DataFrame:
    share = F.when(F.col("_n") > 0, F.lit(100.0) * F.col("null_count") / F.col("_n")).otherwise(F.lit(0.0))
    return long.select("column", "dtype", "non_null_count", "null_count", share.alias("null_percentage"), "min", "max", "mean", "std", "unique_values")


def profile_state(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """What a profile needs to know of some rows, in a form that merges: a row for each column (and each group of ``keys``).

    Counts, least and greatest value, mean and sum of squared deviations, and a sketch of the distinct values. States of
    partitions that never change can be kept, joined by ``unionByName`` and read by ``profile_of``, without the rows.
    """
    fields = [f for f in df.schema.fields if f.name not in keys]
    aggs, rows = [F.count(F.lit(1)).alias("_n")], []
    for i, f in enumerate(fields):
        c, num = F.col(f"`{f.name}`"), _is_num(f.dataType)
        x = c.cast("double") if num else F.lit(None).cast("double")
        sketched = c if isinstance(f.dataType, (T.LongType, T.IntegerType, T.StringType)) else c.cast("string")
        aggs += [F.count(c).alias(f"nn{i}"), F.min(x).alias(f"mi{i}"), F.max(x).alias(f"ma{i}"), F.avg(x).alias(f"me{i}"),
                 (F.var_pop(x) * F.count(x)).alias(f"dd{i}"), F.hll_sketch_agg(sketched).alias(f"sk{i}")]
        rows.append(f"{i}, '{f.name}', '{f.dataType.simpleString()}', nn{i}, mi{i}, ma{i}, me{i}, dd{i}, sk{i}")
    wide = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    names = ", ".join([*[f"`{k}`" for k in keys], "_n AS n"])
    return wide.selectExpr(*names.split(", "), f"stack({len(rows)}, {', '.join(rows)}) AS (i, column, dtype, non_null_count, min, max, mean, deviation, sketch)")


def profile_of(states: DataFrame) -> DataFrame:
    """A5 from states: distinct counts are estimates (a few per cent), the rest is exact up to rounding."""
    all_mean = F.sum(F.col("mean") * F.col("non_null_count")).over(Window.partitionBy("i")) / F.sum("non_null_count").over(Window.partitionBy("i"))
    d = states.withColumn("_m", F.when(F.col("mean").isNotNull(), all_mean))  # rows: states, not data
    # squared deviations from the mean of all: those inside each state, and those of the states' means
    inside = F.col("deviation") + F.col("non_null_count") * (F.col("mean") - F.col("_m")) ** 2
    g = d.groupBy("i", "column", "dtype").agg(
        F.sum("n").alias("_n"), F.sum("non_null_count").alias("non_null_count"), (F.sum("n") - F.sum("non_null_count")).alias("null_count"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.max("_m").alias("mean"),
        F.when(F.sum("non_null_count") > 1, F.sqrt(F.sum(inside) / (F.sum("non_null_count") - 1))).alias("std"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_values"))
    return _profile_columns(g)


def feature_quality(df: DataFrame, exclude: Sequence[str] = ("symbol", "date")) -> DataFrame:
    """Overall null %, infinite values, constant columns, shape; null % < 5 passes."""
    feats = [f.name for f in df.schema.fields if _is_num(f.dataType) and f.name not in exclude]
    dbl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
           and f.name not in exclude]
    n_cols = len(df.columns)
    g = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        sum([F.count_if(F.col(c).isNull() | F.isnan(F.col(c)) if c in dbl else F.col(c).isNull())
             for c in df.columns] or [F.lit(0)]).cast("long").alias("null_cells"),
        sum([F.count_if(F.abs(F.col(c)) == float("inf")) for c in dbl] or [F.lit(0)]).cast("long").alias("inf_values"),
        sum([F.when(F.stddev_samp(c) == 0, 1).otherwise(0) for c in feats] or [F.lit(0)]).alias("constant_columns"))
    pct = F.when(F.col("n_rows") > 0, F.lit(100.0) * F.col("null_cells") / (F.col("n_rows") * n_cols)) \
        .otherwise(F.lit(0.0))
    return g.select("n_rows", F.lit(n_cols).alias("n_columns"), pct.alias("null_percentage"), "inf_values",
                    "constant_columns", F.when(pct < 5, F.lit("passed")).otherwise(F.lit("failed")).alias("status"))
