"""Materialise-once feature cache on a shared file system.

Key = function (name, code and closure) + fingerprint of the input + hash of the arguments.  Where the input is a plain
scan of files, the fingerprint is their list with length and modification time: a hit reads no row.  Otherwise it
is one aggregate, ``sum(xxhash64(all columns))`` as a decimal plus the row count, order-independent and computed in parallel.  Results are written as Parquet under ``{base}/{function}/{key}``
and reused while younger than the TTL; stale or missing entries are
recomputed.  Written tables also cut lineage for long plans.
"""

from __future__ import annotations

import fnmatch
import functools
import hashlib
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scan_identity(df: DataFrame) -> str | None:
    """Hash of the files that a frame reads: schema, and path, length and modification time of each; no job runs.

    None where the frame is more than a scan of whole files with some of their columns (a filter, a join, rows from memory):
    its content is then what tells it apart.
    """
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "SubqueryAlias"):
        if plan.nodeName() == "Project":
            columns = plan.projectList()
            if any(columns.apply(i).getClass().getSimpleName() != "AttributeReference" for i in range(columns.size())):
                return None
        plan = plan.child()
    if plan.getClass().getSimpleName() != "LogicalRelation" or not plan.relation().getClass().getSimpleName().startswith("HadoopFsRelation"):
        return None
    files = sorted(df.inputFiles())
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    h = hashlib.sha256(df.schema.simpleString().encode())
    folders: dict[str, dict[str, str]] = {}
    for f in files:
        folder = f.rsplit("/", 1)[0]
        if folder not in folders:  # one listing for each folder
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            folders[folder] = {s.getPath().getName(): f"{s.getLen()}:{s.getModificationTime()}" for s in path.getFileSystem(conf).listStatus(path)}
        name = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).getName()
        if name not in folders[folder]:
            return None  # gone or renamed meanwhile
        h.update(f"{f}:{folders[folder][name]};".encode())
    return f"files-{h.hexdigest()[:24]}"


def fingerprint(df: DataFrame) -> str:
    """Identity of a DataFrame's content: of its files if it is a scan, else an order-independent content hash (one aggregate)."""
    files = scan_identity(df)
    if files:
        return files
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    r = df.agg(F.sum(h).alias("h"), F.count(F.lit(1)).alias("n")).first()
    return hashlib.sha256(f"{r['h']}:{r['n']}:{df.schema.simpleString()}".encode()).hexdigest()[:24]


def identity(fn: Callable) -> str:
    """Hash of what a function is: module, qualified name, code, defaults and the values it closes over.

    Two closures of one name with other constants differ; nested functions count with their own code and closures.
    """
    h = hashlib.sha256()

    def feed(x, seen: frozenset = frozenset()) -> None:
        if id(x) in seen:
            return
        seen = seen | {id(x)}
        if isinstance(x, functools.partial):
            feed((x.func, x.args, sorted(x.keywords.items())), seen)
        elif hasattr(x, "__code__"):
            h.update(f"{x.__module__}.{x.__qualname__}".encode())
            feed(x.__code__, seen)
            feed((x.__defaults__, x.__kwdefaults__), seen)
            for cell in x.__closure__ or ():
                feed(cell.cell_contents, seen)
        elif hasattr(x, "co_code"):
            h.update(x.co_code + repr(x.co_names).encode())
            for c in x.co_consts:
                feed(c, seen)
        elif isinstance(x, (tuple, list)):
            h.update(b"(")
            for y in x:
                feed(y, seen)
            h.update(b")")
        else:
            h.update(f"{type(x).__qualname__}:{x!r};".encode())
    feed(fn)
    return h.hexdigest()[:16]


class FeatureCache:
    def __init__(self, base: str, ttl_seconds: int = 86400):
        self.base, self.ttl = base.rstrip("/"), ttl_seconds
        self.hits = self.misses = 0

    def _fs(self, spark):
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.base)
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm

    def key(self, df: DataFrame, fn: Callable, **kwargs) -> str:
        args = hashlib.sha256(repr(sorted(kwargs.items())).encode()).hexdigest()[:12]
        return f"{fn.__name__}/{fingerprint(df)}-{identity(fn)}-{args}"

    def _fresh(self, spark, path: str) -> bool:
        fs, jvm = self._fs(spark)
        ok = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if not fs.exists(ok):
            return False
        age = time.time() - fs.getFileStatus(ok).getModificationTime() / 1000.0
        return age < self.ttl

    def get_or_compute(self, df: DataFrame, fn: Callable[..., DataFrame], **kwargs) -> DataFrame:
        """Return the cached result of ``fn(df, **kwargs)`` or compute, write and return it."""
        spark = df.sparkSession
        path = f"{self.base}/{self.key(df, fn, **kwargs)}"
        if self._fresh(spark, path):
            self.hits += 1
            return spark.read.parquet(path)
        self.misses += 1
        fn(df, **kwargs).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    def invalidate(self, spark, pattern: str = "*") -> int:
        """Delete entries whose ``function/key`` matches a glob pattern; returns the count."""
        fs, jvm = self._fs(spark)
        root = jvm.org.apache.hadoop.fs.Path(self.base)
        if not fs.exists(root):
            return 0
        n = 0
        for fdir in fs.listStatus(root):
            for entry in fs.listStatus(fdir.getPath()):
                name = f"{fdir.getPath().getName()}/{entry.getPath().getName()}"
                if fnmatch.fnmatch(name, pattern):
                    fs.delete(entry.getPath(), True)
                    n += 1
        return n

    def stats(self) -> dict:
        total = self.hits + self.misses
        return {"hits": self.hits, "misses": self.misses, "hit_rate": self.hits / total if total else 0.0}
