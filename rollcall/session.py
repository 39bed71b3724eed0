"""Spark session helpers.

Settings that matter at scale: AQE (runtime coalescing, skew-join splitting and
broadcast conversion from measured sizes), UTC session time zone (dates derived
from timestamps must not depend on the host), no UI server.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # size post-shuffle partitions by the advisory size, not by maximal parallelism
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    # broadcast decisions are taken by AQE from the measured shuffle size
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# fixed value: rows of a parquet table take about so many times its bytes in memory: a key of hex text takes 48 bytes there, 16 in a file
IN_MEMORY = "3"
_FACTOR = "spark.sql.sources.fileCompressionFactor"


def size_tables_in_memory(spark: SparkSession) -> None:
    """Let Spark plan with the size that tables have in memory, not in their files:
    by the latter it would broadcast, through the driver, tables of millions of
    keys as if they were small.  A factor that the deployment has set stays."""
    if float(spark.conf.get(_FACTOR)) == 1.0:
        spark.conf.set(_FACTOR, IN_MEMORY)


def build_session(master: str | None = None, app: str = "rollcall",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("ROLLCALL_DRIVER_MEMORY", "8g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment (a shared filesystem path) and
    is only read here; there it is an error if it is unset, as executors don't
    share a folder of the driver's.  In local mode a scratch folder is made.
    """
    conf = spark.sparkContext.getConf()
    d = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        d = tempfile.mkdtemp(prefix="rollcall-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d
