"""Session helpers.

The cluster names a shared folder in ``spark.checkpoint.dir``; iterative
plans (crawl levels) cut their lineage there.  Only when the setting is
absent (tests, local runs) do we set one of our own.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Pages are wide rows (whole HTML documents); keep scan splits moderate.
    "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
}


def get_spark(master: str | None = None, app: str = "sitegraph",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings our plans assume."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("SITEGRAPH_DRIVER_MEM", "8g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.master.startswith("local[") and spark.conf.get("sitegraph.scan.partitions", None) is None:
        spark.conf.set("sitegraph.scan.partitions", str(spark.sparkContext.defaultParallelism))  # small files, many cores
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a folder on a shared file
    system and is used as is; without it this raises, as executors would write
    to disks of their own.  Only a local master gets a temporary folder.
    """
    conf = spark.sparkContext.getConf()
    d = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="sitegraph-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - a core conf may be read-only at runtime
            pass
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d
