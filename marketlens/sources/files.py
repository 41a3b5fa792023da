"""File sources and sinks S1-S5, S11-S14.

Readers take explicit schemas where the layout is known and let the Parquet
reader prune columns and push filters; writers partition by column instead of
writing one file per symbol in a loop.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

NEWS_SCHEMA = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("publishedAt", T.StringType()),
    T.StructField("_corrupt_record", T.StringType()),
])


def load_data(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
              filters: Column | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan with projection and a filter that reaches the reader."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    if columns:
        df = df.select(*columns)
    if filters is not None:
        df = df.where(filters)
    return df


def load_panel_tree(spark: SparkSession, base: str, data_type: str, merge_schema: bool = True) -> DataFrame:
    """Every file under ``{base}/{data_type}``; ``date=`` folders become a column.

    Partition discovery keeps the date (the reference drops it) and lets date
    filters prune folders.
    """
    return (spark.read.option("basePath", f"{base}/{data_type}").option("mergeSchema", merge_schema)
            .parquet(f"{base}/{data_type}"))


def load_news_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """S3: article objects; malformed records go to ``_corrupt_record``.

    Vendor files hold one JSON array each (``lines=False``: a file is one task); our own sink writes a record a line,
    which is split like any text. text = title + " " + description, as the reference builds it.
    """
    df = (spark.read.schema(NEWS_SCHEMA).option("multiLine", not lines).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    df = df.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    return df.withColumn("text", F.concat_ws(" ", F.coalesce("title", F.lit("")),
                                             F.coalesce("description", F.lit(""))))


def save_partitioned(df: DataFrame, base: str, data_type: str, date_col: str = "date",
                     fmt: str = "parquet") -> str:
    """``{base}/{data_type}/date=.../`` with every symbol kept; only the dates present in ``df`` are replaced.

    The frame is rebalanced by date: small dates share tasks and a hot date is split over several.
    JSON is one record a line.
    """
    out = f"{base}/{data_type}"
    d = df.withColumn("date", F.to_date(F.col(date_col))) if date_col != "date" else df
    w = d.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date")
    if fmt == "parquet":
        w.option("compression", "snappy").parquet(out)
    else:
        w.json(out)
    return out


def write_feature_store(df: DataFrame, base: str, run_date: str) -> tuple[str, str]:
    """Write ``features/run_date=...`` and replace ``features/latest``.

    The new ``latest`` is written beside the old one and moved into its place when complete, so a failed write
    leaves the old one.
    """
    spark = df.sparkSession
    dated = f"{base}/features/run_date={run_date}"
    latest, new, old = (f"{base}/features/{n}" for n in ("latest", "_latest_new", "_latest_old"))
    df.write.mode("overwrite").parquet(dated)
    spark.read.parquet(dated).write.mode("overwrite").parquet(new)
    fs, at = _hadoop(spark, base)
    fs.delete(at(old), True)
    if fs.exists(at(latest)):
        fs.rename(at(latest), at(old))
    if not fs.rename(at(new), at(latest)):
        fs.rename(at(old), at(latest))
        raise OSError(f"{new} could not be moved to {latest}")
    fs.delete(at(old), True)
    return dated, latest


def _hadoop(spark: SparkSession, path: str):
    """The file system of ``path`` and a maker of its paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _exists(spark: SparkSession, path: str) -> bool:
    fs, at = _hadoop(spark, path)
    return bool(fs.exists(at(path)))


def read_feature_store(spark: SparkSession, base: str, run_date: str | None = None) -> DataFrame:
    """Dated features if present, else ``latest`` (existence checked through Hadoop FS)."""
    cands = ([f"{base}/features/run_date={run_date}"] if run_date else []) + [f"{base}/features/latest"]
    for c in cands:
        if _exists(spark, c):
            return spark.read.parquet(c)
    raise FileNotFoundError(f"no feature set under {base}/features")


def write_report(df: DataFrame, path: str, fmt: str = "json") -> str:
    """Small report tables as one file (``coalesce(1)`` of an aggregate-sized frame)."""
    w = df.coalesce(1).write.mode("overwrite")
    {"json": w.json, "parquet": w.parquet, "csv": lambda p: w.option("header", True).csv(p)}[fmt](path)
    return path
