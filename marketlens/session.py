"""SparkSession helpers shared by tests, bench and the driver entry."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # call-site capture for error messages costs a stack walk per expression built in Python
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "marketlens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library assumes."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("MARKETLENS_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared file system folder and is used as
    is.  Only when it is unset (local tests) a scratch folder is created.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="marketlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df, spark: SparkSession | None = None):
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    spark = spark or df.sparkSession
    checkpoint_dir(spark)
    return df.checkpoint(eager=True)
