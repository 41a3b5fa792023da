"""Training-corpus pipeline: toxic documents go, then exact copies, near copies and benchmark leaks; what is left is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read again as the next
stage's docs, so a lost executor costs no more than the running stage. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlens.llm.common import delete, shared_folder
from marketlens.llm.decontam_wand import decontaminate
from marketlens.llm.exact_dedup import exact_dedup
from marketlens.llm.near_dedup import near_dedup
from marketlens.llm.packing_kk import pack_documents
from marketlens.llm.toxicity_nb import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.7 (operator 3). Null and empty texts have the score of no words, which is under it; repeated rows
    are scored each; without labels of both classes nothing goes."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id (operator 9). Null equals empty; a null id stays only where there is no other;
    of rows that repeat id and text one stays."""
    return exact_dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies, the document with the least id (operator 10). Texts without words are near nothing; rows without an id stay."""
    return near_dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (operator 8). Null and empty texts hold none; without items all stay."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens (operator 6). Null and empty texts are one token, the end."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity), ("exact_duplicates", exact_duplicates), ("near_duplicates", near_duplicates),
    ("decontamination", decontamination), ("packing", packing)]

#: Trained scores, signatures and packing are beyond SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again; the rows of the last one.

    A stage's table is deleted when the next one has been written. An empty table goes through all stages and gives no row.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder, last = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}", None
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            delete(spark, last)
        last = path
    return docs
