"""Session helpers.

Cluster jobs get their session from the platform; these helpers only fill
in settings that are *unset* (tests, local runs) and never override what
the cluster configured.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    # broadcast only from measured sizes: no static (estimate-based) broadcast,
    # AQE broadcasts a join side whose materialised shuffle is under 64 MB
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "marquee", driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the configured checkpoint folder; set a local one only when unset.

    A machine-local folder is only acceptable in local mode (tests), so the
    fallback refuses to run against a cluster master.
    """
    d = checkpoint_dir(spark)
    if d:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        return d
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):     # local-cluster[...] is a cluster
        raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder for the cluster")
    d = tempfile.mkdtemp(prefix="marquee-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(d)
    return d
