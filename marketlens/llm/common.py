"""Small helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Word characters of the shingle and passage operators: everything but ASCII white space.
WORD_BREAK = r"[\x20\x09-\x0D]+"

#: Most keys (8 bytes each) that are broadcast to rows where they lie; more keys meet the rows by a shuffle.
BROADCAST_KEYS = 1 << 20

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers (once an application), so that they need no install of it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="ship-")) / f"{top.name}-{sc.applicationId}.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Column names that no column of ``df`` has (compared without case, as Spark resolves them)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for base in bases:
        name = base
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_of(column: str | Column) -> Column:
    """Null text counts as the empty text."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c, F.lit(""))


def held_out(column: str | Column) -> Column:
    """The labelled third that no model may learn from: crc32(doc_id as text) mod 3 = 1."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a folder is only made up for local sessions that leave it unset."""
    from marketlens.session import checkpoint_dir
    return (spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)).rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a table in the shared folder: survives a lost executor, read again by any task."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def few(keys: DataFrame, limit: int | None = None) -> DataFrame | None:
    """``keys`` marked for broadcast if it has at most BROADCAST_KEYS rows (counted; a table of ``written``), else None."""
    return F.broadcast(keys) if keys.count() <= (BROADCAST_KEYS if limit is None else limit) else None


@contextmanager
def batch_bytes(spark: SparkSession, limit: int = 8 << 20) -> Iterator[None]:
    """Arrow batches of about ``limit`` bytes at most, whatever the length of the texts, for jobs that run inside."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(limit))
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: What a Python worker keeps between its tasks: the operator that keeps it, and how it is forgotten.
_KEPT: dict[str, Callable[[], None]] = {}


def keep(owner: str, forget: Callable[[], None]) -> None:
    _KEPT[owner] = forget


def _begin(owner: str) -> None:
    for other in [k for k in _KEPT if k != owner]:
        _KEPT.pop(other)()


def _end() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def lean(run: Callable[[Iterator], Iterator], owner: str = "") -> Callable[[Iterator], Iterator]:
    """``run``, a function of a partition's batches, for workers that live on from task to task and operator to operator.

    What another operator keeps is forgotten first, and freed memory goes back to the system after the last batch.
    """
    @wraps(run)
    def inner(batches):
        _begin(owner)
        try:
            yield from run(batches)
        finally:
            _end()

    return inner


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing reads any more."""
    for t in tables:
        delete(t.sparkSession, t._written)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def running(df: DataFrame, by: list[str], order: list[Column], totals: dict[str, str], name: str) -> DataFrame:
    """``df`` plus a long column for each of ``totals`` (new name: column): its sum over the rows before, within ``by``.

    No task holds a whole group: rows are dealt by ranges of (by, order), summed inside each range, and the sums of the
    ranges before (a row for each range and group) are added. The columns of ``by`` hold no nulls; ``order`` tells rows apart.
    """
    part, = fresh(df, "part")
    dealt = written(df.repartitionByRange(*by, *order).withColumn(part, F.spark_partition_id()), name)
    start = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    own = Window.partitionBy(part, *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    first = {new: f"{new}_first" for new in totals}
    sums = dealt.groupBy(part, *by).agg(*[F.sum(c).cast("long").alias(new) for new, c in totals.items()])
    sums = sums.select(part, *by, *[F.coalesce(F.sum(new).over(start), F.lit(0)).alias(f) for new, f in first.items()])
    inner = dealt.select("*", *[F.coalesce(F.sum(c).over(own), F.lit(0)).alias(new) for new, c in totals.items()])
    out = inner.join(sums, [part, *by])
    return out.select(*df.columns, *[(F.col(new) + F.col(f)).cast("long").alias(new) for new, f in first.items()])


def byte_batches(texts: Iterable[str], limit: int = 1 << 20) -> Iterator[list[str]]:
    """Runs of texts of about ``limit`` bytes (UTF-8) each (one long text may be a run of its own)."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += (len(t) if t.isascii() else len(t.encode("utf-8", "surrogatepass"))) + 16
        if size >= limit:
            yield run
            run, size = [], 0
    if run:
        yield run
