"""Bounded labelled samples for the classifiers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import held_out, text_of

#: Bounds of a training sample: texts of each class, and bytes of a text (longer ones are not learned from, but are scored).
SAMPLE_ROWS, SAMPLE_BYTES = 3000, 20_000


def training_rows(df: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text: str = "text",
                  rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """i, text, y of up to ``rows`` labelled rows of each class whose id is not held out, the same rows every time.

    At most ``2 * rows`` ids are chosen from the labels first (by a hash of the id), so the join with the texts
    broadcasts a list of bounded size and shuffles only their texts. Of an id with several texts the least counts; of one with both
    labels, 1.
    """
    known = labels.select(F.col(id_col).alias("i"), F.col(label).cast("int").alias("y")) \
        .filter(F.col("i").isNotNull() & F.col("y").isin(0, 1) & ~held_out("i"))
    known = known.groupBy("i").agg(F.max("y").alias("y"))
    order = F.xxhash64(F.col("i").cast("string"))
    chosen = known.filter("y = 1").orderBy(order, "i").limit(rows).unionByName(
        known.filter("y = 0").orderBy(order, "i").limit(rows))
    t = df.select(F.col(id_col).alias("i"), text_of(text).alias("text")).filter(F.octet_length("text") <= max_bytes)
    return t.join(F.broadcast(chosen), "i").groupBy("i").agg(F.min("text").alias("text"), F.max("y").alias("y"))


def training_sample(df: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text: str = "text",
                    rows: int = SAMPLE_ROWS, max_bytes: int = SAMPLE_BYTES) -> pd.DataFrame:
    """``training_rows`` in the driver."""
    return training_rows(df, labels, label, id_col, text, rows, max_bytes).toPandas().sort_values("i", ignore_index=True)
